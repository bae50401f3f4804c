"""Intermediate tables that outlive an executor.

A small table that decides the next plan (group averages, rank offsets), or a
layer that several queries read, is written once as Parquet to the shared
folder the cluster names in ``spark.checkpoint.dir``. Reading it back is
columnar and prunes, and a lost executor costs no recomputation.
"""

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_local_dirs: dict[str, str] = {}

#: For tables that are large: files are small, and shuffle files go when their query ends; otherwise they
#: go when the driver's memory is cleaned, which may be long after.
LEAN = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one only in local mode."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    application = spark.sparkContext.applicationId
    if application not in _local_dirs:
        own = tempfile.mkdtemp(prefix="tasador-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        _local_dirs[application] = own
    return _local_dirs[application]


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; what is written there goes when the application ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    return path


@contextmanager
def with_settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Spark's settings for the queries that run in this block."""
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def _size_columns(df: DataFrame) -> list[Column]:
    """Aggregates for the size of the rows in memory: fixed parts and text lengths."""
    row = F.lit(16 + 16 * len(df.columns))
    for name, dtype in df.dtypes:
        if dtype in ("string", "binary"):
            row = row + F.coalesce(F.octet_length(F.col(name)), F.lit(0))
        elif dtype.startswith(("array", "map", "struct")):
            row = row + F.coalesce(F.octet_length(F.to_json(F.struct(name))), F.lit(0)) * 2
    return [F.coalesce(F.sum(row), F.lit(0)).alias("bytes")]


def measured_bytes(df: DataFrame) -> int:
    """Size of a table as rows in memory."""
    return df.agg(*_size_columns(df)).first()["bytes"]


def materialize(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` as a table in the shared folder and return the scan of it."""
    return materialize_measured(df, name, partition_by)[0]


def materialize_measured(
    df: DataFrame, name: str, partition_by: tuple[str, ...] = ()
) -> tuple[DataFrame, int]:
    """``materialize``, with the size of the rows measured by the write itself."""
    path, size = store(df, name, partition_by)
    return read_stored(df.sparkSession, path, df.schema), size


def store(
    df: DataFrame, name: str, partition_by: tuple[str, ...] = (), laid_out: bool = False
) -> tuple[str, int]:
    """Write ``df`` to the shared folder; returns its path and the size of its rows. Rows that
    are ``laid_out`` already lie together by ``partition_by`` and are not shuffled."""
    path = fresh_path(df.sparkSession, name)
    size = Observation()
    rows = df.hint("rebalance", *partition_by) if partition_by and not laid_out else df
    rows.observe(size, *_size_columns(df)).write.partitionBy(*partition_by).parquet(path)
    return path, size.get["bytes"]


def read_stored(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())
