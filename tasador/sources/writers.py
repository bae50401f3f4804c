"""Sinks. Rows are counted while they are written, never by a second run.

Files are laid out by a rebalance on the partition keys: small days share a
task and a day with a third of all rows is split over several.
"""

import uuid
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tasador.functions.geo import place_key
from tasador.functions.parsing import source_slug
from tasador.operators.radius import mappable
from tasador.operators.validation import TYPE_PROBLEM, check_records
from tasador.plans.workspace import materialize
from tasador.schemas import BRONZE, GOLD, INCOMING, SILVER
from tasador.sources import snapshots
from tasador.sources.batches import Batch, complete

GOLD_TABLE = "gold_listings"


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    # The observation sits in the writing stage, whose tasks count once even
    # when an earlier stage is repeated.
    observation = Observation()
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation


def _counted_by(df: DataFrame, condition: str) -> tuple[DataFrame, Observation]:
    """The same, with the rows that meet a condition."""
    seen = Observation()
    return df.observe(
        seen, F.count(F.lit(1)).alias("rows"), F.count_if(condition).alias("hits")
    ), seen


def bronze_rows(checked: DataFrame, date: Column) -> DataFrame:
    """Checked records in Bronze's columns, with the directory keys."""
    keyed = checked.withColumns({"source": source_slug(F.col("source")), "date": date})
    return keyed.select(*BRONZE.fieldNames())


def ingest(
    incoming: DataFrame,
    bronze_path: str,
    rejected_path: str,
    source: str | None = None,
    scrape_date: str | None = None,
    batch_id: str | None = None,
    allow_empty: bool = False,
) -> dict[str, int]:
    """Check records and add the good ones to Bronze and the others to quarantine, as one
    batch: both or neither, and once however often a batch of that id is ingested.

    The directory key is ``source`` (else each record's own) and ``scrape_date``
    (else today, UTC). Returns the counts of both writes; fails when there is no
    good record, unless ``allow_empty``, and then leaves both folders as they
    were. Without ``batch_id`` each call is a batch of its own: a second ingest of
    the same day adds to the first, and Silver keeps the latest copy of a
    listing. The input is read once: checked records are stored in the shared
    folder.
    """
    spark = incoming.sparkSession
    targets = {"good": bronze_path, "bad": rejected_path}
    complete(spark, targets)
    batch = Batch(spark, batch_id or uuid.uuid4().hex, targets)
    done = batch.counts()
    if done is not None:
        return done
    today = datetime.now(timezone.utc).strftime("%Y-%m-%d")
    date = F.lit(scrape_date or today)
    tested, seen = _counted_by(check_records(incoming), "is_valid")
    checked = materialize(tested, "checked")
    counts = {"valid": seen.get["hits"], "rejected": seen.get["rows"] - seen.get["hits"]}
    if not counts["valid"] and not allow_empty:
        raise ValueError(f"no valid record to ingest, {counts['rejected']} rejected")
    if counts["rejected"]:
        bad = checked.filter(~F.col("is_valid")).drop("is_valid").withColumn("date", date)
        batch.stage("bad", bad, ("date",))
    if counts["valid"]:
        good = checked.filter("is_valid")
        if source is not None:
            good = good.withColumn("source", F.lit(source))
        batch.stage("good", bronze_rows(good, date).hint("rebalance", "source", "date"), ("source", "date"))
    return batch.commit(counts)


#: Fields that need not be text.
_NUMBERS, _TIMES = ("latitude", "longitude"), ("scraped_at",)


def _type_problem(record: dict) -> str | None:
    """Fields whose value has a type that Bronze does not take."""
    problems = []
    for name in INCOMING.fieldNames():
        value = record.get(name)
        number = isinstance(value, (int, float)) and not isinstance(value, bool)
        if not (
            value is None or isinstance(value, str) or name in _NUMBERS and number
            or name in _TIMES and isinstance(value, datetime)
        ):
            problems.append(f"{name} not a {'number' if name in _NUMBERS else 'text'}")
    return "; ".join(problems) or None


def ingest_records(
    spark: SparkSession,
    records: list[dict],
    bronze_path: str,
    rejected_path: str,
    source: str,
    scrape_date: str | None = None,
    batch_id: str | None = None,
) -> dict[str, int]:
    """``ingest`` for a batch of dicts; keys that Bronze does not know are ignored."""
    names = INCOMING.fieldNames()
    texts = [
        (*(None if r.get(n) is None else str(r[n]) for n in names), _type_problem(r))
        for r in records
    ]
    schema = StructType([*INCOMING.fields, StructField(TYPE_PROBLEM, StringType())])
    incoming = spark.createDataFrame(texts, schema)
    return ingest(incoming, bronze_path, rejected_path, source, scrape_date, batch_id)


def write_silver(silver: DataFrame, path: str, replace_all: bool = False) -> int:
    """Replace the written (source, scrape_date) partitions, or after a full rebuild all of
    them; returns the row count."""
    laid_out = silver.select(*SILVER.fieldNames()).hint("rebalance", "source", "scrape_date")
    rows, written = _counted(laid_out)
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if replace_all else "dynamic")
        .partitionBy("source", "scrape_date")
        .parquet(path)
    )
    return written.get["rows"]


def write_gold(
    gold: DataFrame, path: str, tasks: int | None = None, replace_all: bool = False,
    laid_out: bool = False,
) -> int:
    """Replace the written dates, or after a full rebuild all of them, files ordered by rank;
    returns the row count.

    Small days share a task and a large one is split. With ``tasks`` the rows are
    cut into that many ranges, the url included; then the plan runs a second
    time for the ranges' bounds, so pass stored rows. Rows that are ``laid_out`` already
    lie together by date, as in a stored layer, and are not shuffled.
    """
    order = ["scrape_date", "rank", "url"]
    rows = gold.select(*GOLD.fieldNames())
    if tasks is not None:
        dealt = rows.repartitionByRange(tasks, *order)
    else:
        dealt = rows if laid_out else rows.hint("rebalance", "scrape_date")
    rows, written = _counted(dealt.sortWithinPartitions(*order))
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if replace_all else "dynamic")
        .partitionBy("scrape_date")
        .parquet(path)
    )
    return written.get["rows"]


def write_gold_by_place(gold: DataFrame, path: str, tasks: int, group_bytes: int = 8 << 20) -> int:
    """A copy of the mappable Gold rows for searches around a point: files and row groups hold
    ranges of ``place_key``, so their statistics of latitude and longitude are narrow and a
    search reads few of them. Returns the row count.

    Pass stored rows: the plan runs a second time for the ranges' bounds.
    """
    key = place_key(F.col("latitude"), F.col("longitude"))
    placed = mappable(gold.select(*GOLD.fieldNames())).withColumn("_place", key)
    dealt = placed.repartitionByRange(tasks, "_place", "url", "scrape_date").sortWithinPartitions(
        "_place", "url", "scrape_date"
    ).drop("_place")
    rows, written = _counted(dealt)
    rows.write.mode("overwrite").option("parquet.block.size", group_bytes).parquet(path)
    return written.get["rows"]


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def publish(spark: SparkSession, gold_path: str, name: str = GOLD_TABLE) -> int:
    """Serve the Gold files under ``name`` in the catalog, for all sessions; returns the row
    count, from file footers.

    ``name`` is a view that is replaced in one step, so a reader never misses it.
    The files are named, not copied; how long the catalog lasts is up to it:
    with a metastore, other applications see the view, too. ``sources.snapshots``
    keeps versions of the files as well.
    """
    snapshots.publish_folder(spark, gold_path, name, GOLD)
    return spark.table(name).count()


def save_rows(rows: DataFrame, name: str) -> int:
    """Create or replace a table of rows; returns their number."""
    written, count = _counted(rows)
    written.write.mode("overwrite").saveAsTable(name)
    return count.get["rows"]


def save(spark: SparkSession, records: list[dict], name: str, schema: StructType | None = None) -> int:
    """``save_rows`` for records of the program; none leaves the table as it is."""
    return save_rows(spark.createDataFrame(records, schema), name) if records else 0
