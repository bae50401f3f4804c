"""Bronze to Silver: parse, keep valid rows, normalise, keep the latest copy."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasador.functions import parsing as P
from tasador.plans.joins import DEFAULT_LIMITS, lookup_join
from tasador.plans.workspace import materialize_measured
from tasador.schemas import SILVER

LISTING_KEY = ("url", "scrape_date")

#: Buckets of keys that are counted to find keys with very many copies.
KEY_BUCKETS = 4096
#: Rows of one date that a file takes, before copies are removed.
PART_ROWS = 100_000


def parse_values(raw: DataFrame) -> DataFrame:
    return raw.withColumns({
        "price_eur": P.parse_price(F.col("raw_price")),
        "area_sqm": P.parse_area(F.col("raw_area")),
        "rooms": P.parse_rooms(F.col("raw_rooms")),
    })


def keep_valid(parsed: DataFrame) -> DataFrame:
    return parsed.filter((F.col("price_eur") > 0) & (F.col("area_sqm") > 0))


def normalize_names(df: DataFrame) -> DataFrame:
    return df.withColumns({
        name: P.normalize_text(F.col(name)) for name in ("title", "neighborhood", "district")
    })


def _crowded(df: DataFrame, bucket: Column, hot_rows: int) -> list[int]:
    """Buckets with more rows than twice an even share and those of a hot key; at most
    ``KEY_BUCKETS`` counts reach the driver."""
    counts = df.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n")).collect()
    usual = 2 * sum(r["n"] for r in counts) // KEY_BUCKETS
    return sorted(r["bucket"] for r in counts if r["n"] > usual + hot_rows)


def latest_copy(
    df: DataFrame, keys: tuple[str, ...] = LISTING_KEY, latest: str = "scraped_at",
    hot_rows: int = DEFAULT_LIMITS.hot_rows, lay_out_by: str | None = None,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """One row per key: the one with the greatest ``latest``, then the greatest values.

    The order covers every column, so the survivor never depends on the
    partitioning. Rows are sorted once, after their shuffle, where a task's share
    is bounded; sorted before it, whole splits of well compressed files would
    spill. Keys that may have more than ``hot_rows`` copies, found by counting
    buckets of keys, are combined before their shuffle: such a key sends one row
    per task. The keys are read once more for the count, so pass rows that are cheap to read.

    With ``lay_out_by``, one of the keys, the rows of its values leave the same shuffle
    together and in order, ``part_rows`` of a value in a task, ready to be written by it.
    """
    columns = df.columns
    rest = [c for c in columns if c not in (*keys, latest)]
    shuffle, group = list(keys), list(keys)
    if lay_out_by is not None:
        others = [k for k in keys if k != lay_out_by]
        parts, size = materialize_measured(df.groupBy(lay_out_by).agg(
            F.ceil(F.count(F.lit(1)) / part_rows).cast("int").alias("_parts")
        ), "parts")
        df = in_parts(df, parts, [lay_out_by], others, size)
        # The part follows from the key, so it divides no group.
        shuffle, group = [lay_out_by, "_part"], [lay_out_by, "_part", *others]
    chosen = F.max(F.struct(latest, *rest)).alias("_row")
    return combined(df, keys, shuffle, group, [chosen], hot_rows).select(*keys, "_row.*").select(*columns)


def in_parts(
    df: DataFrame, parts: DataFrame, values: list[str], others: list[str], parts_bytes: int | None = None
) -> DataFrame:
    """Rows with their ``_part``: which of the ``_parts`` of their ``values`` takes them, by a
    hash of ``others``."""
    # Left: no row goes if a second reading of ``df`` has a value that the first had not.
    known = F.coalesce("_parts", F.lit(1))
    return lookup_join(df, parts, values, others, "left", lookup_bytes=parts_bytes).withColumn(
        "_part", F.pmod(F.xxhash64(*others), known).cast("int")
    ).drop("_parts")


def combined(
    df: DataFrame, keys: tuple[str, ...], shuffle: list[str], group: list[Column | str], aggregates: list[Column],
    hot_rows: int = DEFAULT_LIMITS.hot_rows,
) -> DataFrame:
    """``aggregates`` of every group, which is one of ``keys``, after a shuffle by ``shuffle``;
    only keys that may have more than ``hot_rows`` rows are combined before it."""
    bucket = F.pmod(F.xxhash64(*keys), F.lit(KEY_BUCKETS)).cast("int")
    crowded = _crowded(df, bucket, hot_rows)
    if not crowded:
        return df.repartition(*shuffle).groupBy(*group).agg(*aggregates)
    hot = bucket.isin(crowded)
    return df.filter(~hot).repartition(*shuffle).groupBy(*group).agg(*aggregates).unionAll(
        df.filter(hot).groupBy(*group).agg(*aggregates)
    )


def copy_counts(df: DataFrame, keys: tuple[str, ...] = LISTING_KEY) -> DataFrame:
    """One row: rows before, rows remaining after and rows removed by ``latest_copy``."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("before"),
        F.count(F.lit(1)).alias("remaining"),
    ).withColumn("removed", F.col("before") - F.col("remaining"))


def clean(raw: DataFrame) -> DataFrame:
    """Valid, normalised rows before the copies are removed, in Silver's columns."""
    valid = normalize_names(keep_valid(parse_values(raw)))
    return valid.withColumn(
        "price_per_sqm", P.price_per_sqm(F.col("price_eur"), F.col("area_sqm"))
    ).select(*SILVER.fieldNames())


def silver(raw: DataFrame, lay_out_by: str | None = None) -> DataFrame:
    return latest_copy(clean(raw), lay_out_by=lay_out_by)
