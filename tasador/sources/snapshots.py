"""Versions of a table that is partitioned by date, and the switch between them.

A version is a manifest: the folder of every date. Writing one writes the dates
that changed to a new folder, and takes the folders of all other dates from the
version before, so nothing that exists is touched and an unchanged date is not
copied. Manifests are numbered, and the file of a number can be created once;
of two writers at a time the second takes the first one's version as the one
before it.

Publishing makes a catalog table over the folders of a version and then replaces
one view by a view of that table. Readers see the old version or the new one at
any moment, and a running query keeps the files it started with. Going back is
publishing an older version. ``drop_versions`` removes what no kept version uses.
"""

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tasador.schemas import GOLD
from tasador.sources.batches import Folder

DATE = "scrape_date"
_MANIFESTS, _DATA, _PUBLISHED = "_versions", "data", "_published"
#: Partitions that are added to a table with one statement.
_AT_ONCE = 200


def _numbers(folder: Folder, name: str) -> list[int]:
    return sorted(int(n.removesuffix(".json")) for n in folder.names(name) if re.fullmatch(r"[0-9]+\.json", n))


def versions(spark: SparkSession, root: str) -> list[int]:
    return _numbers(Folder(spark, root), _MANIFESTS)


def published_version(spark: SparkSession, root: str) -> int | None:
    """The version that was published last."""
    folder = Folder(spark, root)
    numbers = _numbers(folder, _PUBLISHED)
    return json.loads(folder.read(f"{_PUBLISHED}/{numbers[-1]}.json"))["version"] if numbers else None


def _dates(folder: Folder, version: int) -> dict[str, str]:
    return json.loads(folder.read(f"{_MANIFESTS}/{version}.json"))["dates"] if version else {}


def _numbered(folder: Folder, name: str, text) -> int:
    """Create the file of the next number; ``text`` gives its content from the last number."""
    while True:
        last = (_numbers(folder, name) or [0])[-1]
        if folder.create(f"{name}/{last + 1}.json", text(last)):
            return last + 1


def write_version(
    rows: DataFrame, root: str, replace_all: bool = False, removed: tuple[str, ...] = (),
    order: tuple[str, ...] = (DATE, "rank", "url"),
) -> int:
    """Write a version in which the dates of ``rows`` are replaced; returns its number.

    ``replace_all`` keeps no other date, ``removed`` names dates that go.
    """
    folder = Folder(rows.sparkSession, root)
    data = f"{_DATA}/{uuid.uuid4().hex}"
    rows.hint("rebalance", DATE).sortWithinPartitions(*order).write.partitionBy(DATE).parquet(
        f"{folder.path}/{data}"
    )
    written = {n: f"{data}/{n}" for n in folder.names(data) if n.startswith(f"{DATE}=")}
    gone = {f"{DATE}={d}" for d in removed}

    def manifest(last: int) -> str:
        kept = {} if replace_all else _dates(folder, last)
        dates = {d: f for d, f in {**kept, **written}.items() if d not in gone or d in written}
        return json.dumps({"before": last, "dates": dates})

    return _numbered(folder, _MANIFESTS, manifest)


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _unescaped(partition: str) -> str:
    """The value of ``scrape_date=value`` as a folder is named."""
    value = partition.partition("=")[2]
    return re.sub("%([0-9A-Fa-f]{2})", lambda m: chr(int(m[1], 16)), value)


def _make_table(
    spark: SparkSession, table: str, schema: StructType, location: str, dates: dict[str, str]
) -> None:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(
        f"CREATE TABLE {table} ({columns}) USING parquet PARTITIONED BY ({DATE}) "
        f"LOCATION {_quoted(location)}"
    )
    items = sorted(dates.items())
    for i in range(0, len(items), _AT_ONCE):
        parts = " ".join(
            f"PARTITION ({DATE}={_quoted(_unescaped(name))}) LOCATION {_quoted(where)}"
            for name, where in items[i : i + _AT_ONCE]
        )
        spark.sql(f"ALTER TABLE {table} ADD {parts}")


def point_view(spark: SparkSession, name: str, table: str) -> None:
    """Let ``name`` show a table, in one step."""
    spark.catalog.dropTempView(name)
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        spark.sql(f"DROP TABLE {name}")  # of the time before there were versions
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {table}")


def table_of(name: str, version: int) -> str:
    return f"{name}__v{version}"


def publish_version(
    spark: SparkSession, root: str, name: str, version: int | None = None, schema: StructType = GOLD
) -> int:
    """Show a version, else the newest one, under ``name``; returns its number."""
    folder = Folder(spark, root)
    version = versions(spark, root)[-1] if version is None else version
    dates = {d: f"{folder.path}/{f}" for d, f in _dates(folder, version).items()}
    table = table_of(name, version)
    if not spark.catalog.tableExists(table):
        _make_table(spark, table, schema, f"{folder.path}/{_DATA}/_none", dates)
    point_view(spark, name, table)
    _numbered(folder, _PUBLISHED, lambda _: json.dumps({"version": version, "name": name}))
    return version


def publish_folder(spark: SparkSession, path: str, name: str, schema: StructType) -> None:
    """Show the dates that a folder holds now under ``name``."""
    folder = Folder(spark, path)
    dates = {d: f"{folder.path}/{d}" for d in folder.names("") if d.startswith(f"{DATE}=")}
    table = f"{name}__{uuid.uuid4().hex}"
    _make_table(spark, table, schema, f"{folder.path}/_none", dates)
    before = [t.name for t in spark.catalog.listTables() if re.fullmatch(rf"{re.escape(name)}__[0-9a-f]{{32}}", t.name)]
    point_view(spark, name, table)
    for old in before:
        if old != table:
            spark.sql(f"DROP TABLE IF EXISTS {old}")


def drop_versions(spark: SparkSession, root: str, name: str, keep: int = 2) -> list[int]:
    """Remove all but the newest versions and the published one, with the folders that only
    they use; returns the numbers removed. Give running queries time to end before."""
    folder, known = Folder(spark, root), versions(spark, root)
    kept = set(known[-keep:]) | {published_version(spark, root)}
    used = {f for v in known if v in kept for f in _dates(folder, v).values()}
    gone = [v for v in known if v not in kept]
    for version in gone:
        for path in _dates(folder, version).values():
            if path not in used:
                folder.delete(path)
        spark.sql(f"DROP TABLE IF EXISTS {table_of(name, version)}")
        folder.delete(f"{_MANIFESTS}/{version}.json")
    return gone


def newest_date(spark: SparkSession, table: str) -> DataFrame:
    """One row: the newest date among the partitions that the catalog knows of a table; no
    file is opened."""
    value = F.regexp_extract("partition", f"(?:^|/){DATE}=([^/]*)", 1)
    text = F.url_decode(F.replace(value, F.lit("+"), F.lit("%2B")))
    return spark.sql(f"SHOW PARTITIONS {table}").agg(F.max(text).alias(DATE))


def latest_snapshot(spark: SparkSession, table: str) -> DataFrame:
    """Rows of a table's newest date, found in the catalog; only its files are read."""
    newest = newest_date(spark, table).first()[DATE]
    return spark.table(table).filter(F.col(DATE) == F.lit(newest))
