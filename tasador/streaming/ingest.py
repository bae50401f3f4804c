"""The Bronze ingest as a stream, for runs that take only what is new.

A scheduled run starts the query with ``availableNow``: it reads the files
that arrived since the last run and stops. Each micro-batch is checked once and
ingested as a batch of its own id, so one that is repeated after a failure
leaves no row twice, in Bronze or in quarantine.
"""

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tasador.schemas import INCOMING
from tasador.sources.writers import ingest


def incoming_stream(spark: SparkSession, path: str) -> DataFrame:
    """Parquet files of incoming records as they arrive."""
    return spark.readStream.schema(INCOMING).parquet(path)


def start_ingest(
    incoming: DataFrame,
    bronze_path: str,
    rejected_path: str,
    checkpoint_path: str,
    scrape_date: str | None = None,
) -> StreamingQuery:
    """Start the writes, good records to Bronze and the others to quarantine.

    A stream's batches are numbered from its checkpoint, whose path names them;
    batch ingests may write to the same folders.
    """
    stream = hashlib.sha256(checkpoint_path.encode()).hexdigest()[:16]

    def write(rows: DataFrame, number: int) -> None:
        ingest(rows, bronze_path, rejected_path, scrape_date=scrape_date,
               batch_id=f"stream-{stream}-{number}", allow_empty=True)

    return (
        incoming.writeStream.option("checkpointLocation", checkpoint_path)
        .foreachBatch(write)
        .trigger(availableNow=True)
        .start()
    )
