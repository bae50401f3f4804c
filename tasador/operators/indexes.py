"""The three opportunity indexes and the deal rank.

Group statistics are aggregated and joined back rather than computed as
windows: the aggregate combines before its shuffle, so only partial sums move,
and a neighbourhood or day with a third of all rows is never one task.

``listings`` must be a stored Silver table (one row per url and scrape_date):
it is read once per pass, each time with the few columns the pass needs.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tasador.functions import scoring
from tasador.functions.parsing import synthetic_url
from tasador.operators.cleaning import LISTING_KEY, PART_ROWS
from tasador.operators.lookups import one_each
from tasador.plans.joins import DEFAULT_LIMITS, Limits, lookup_join
from tasador.plans.workspace import materialize_measured
from tasador.schemas import GOLD

GROUP = ["neighborhood", "scrape_date"]

#: Millionths of the index in a range that is counted as one; the range of rows without an index.
STEP_UNITS, NO_INDEX = 500, 1 << 40
#: Size of an index value's row among the ranks (87), and 30 % for the estimate of their number.
VALUE_BYTES = 113


def group_averages(listings: DataFrame) -> DataFrame:
    """Average price per m² and listing count per neighbourhood and day."""
    return listings.groupBy(*GROUP).agg(
        F.avg("price_per_sqm").alias("neighborhood_avg_price_per_sqm"),
        F.count(F.lit(1)).alias("listing_count"),
    )


def _with_group_average(listings: DataFrame, limits: Limits) -> tuple[DataFrame, int]:
    stats, size = materialize_measured(group_averages(listings), "group-averages")
    return lookup_join(
        listings, stats, GROUP, list(LISTING_KEY), "inner", limits,
        key_counts=stats.select(*GROUP, F.col("listing_count").alias("n")), lookup_bytes=size,
    ), size


def with_group_average(listings: DataFrame, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    return _with_group_average(listings, limits)[0]


def _score(listings: DataFrame, limits: Limits) -> tuple[DataFrame, int]:
    """``score``, and the size of the averages."""
    averaged, size = _with_group_average(listings, limits)
    return averaged.withColumn(
        "opportunity_index",
        scoring.discount_to_average(
            F.col("price_per_sqm"), F.col("neighborhood_avg_price_per_sqm")
        ),
    ), size


def score(listings: DataFrame, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    """Add the group's average, its listing count and index A."""
    return _score(listings, limits)[0]


def rank_offsets(scored: DataFrame) -> DataFrame:
    """Rank of every index value on its day, from value counts.

    A rounded index in [-1, 1] has at most 2,000,001 values, which bounds the
    rows of a day in the running sum however many listings the day has.
    """
    counts = scored.groupBy("scrape_date", "opportunity_index").agg(
        F.count(F.lit(1)).alias("listing_count")
    )
    better = (
        Window.partitionBy("scrape_date")
        .orderBy(F.desc_nulls_last("opportunity_index"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    ahead = F.coalesce(F.sum("listing_count").over(better), F.lit(0))
    return counts.withColumn("rank", ahead + 1)


def with_deal_rank(scored: DataFrame, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    """Add ``rank``: 1 + the number of listings of the day with a larger index."""
    keys = ["scrape_date", "opportunity_index"]
    offsets, size = materialize_measured(rank_offsets(scored), "rank-offsets")
    return lookup_join(
        scored, offsets.select(*keys, "rank"), keys, ["url"], "inner", limits,
        key_counts=offsets.select(*keys, F.col("listing_count").alias("n")), lookup_bytes=size,
    )


def _steps(
    scored: DataFrame, part_rows: int, limits: Limits, counts: DataFrame | None = None
) -> tuple[DataFrame, list[str], DataFrame, int]:
    """``scored`` with the key of each row's step, the key, the steps and their size.

    A step is a range of a day's index values, or a single value where a range has more
    than ``part_rows`` rows. A step knows the rows before it (``_ahead``), and its stretch:
    steps of about ``part_rows`` rows that follow each other, with the rows before them (``_base``).
    ``counts``, the ``listings`` of each day and value, are read for the steps where they are known.
    """
    rows_of = F.count(F.lit(1)) if counts is None else F.sum("listings")
    units = F.rint(F.col("opportunity_index") * 10.0**scoring.INDEX_DIGITS).cast("long")
    # Best first; a missing index is last.
    cut = F.coalesce(F.floor((F.lit(10**scoring.INDEX_DIGITS) - units) / STEP_UNITS), F.lit(NO_INDEX))
    cutted, day = scored.withColumn("_cut", cut), ["scrape_date", "_cut"]
    known = cutted if counts is None else counts.withColumn("_cut", cut)
    ranges, size = materialize_measured(known.groupBy(*day).agg(
        rows_of.alias("_n"), (F.min(units) < F.max(units)).alias("_mixed"),
    ), "index-ranges")
    wide = (F.col("_n") > part_rows) & F.coalesce("_mixed", F.lit(False))
    steps = ranges.filter(~wide).select(*day, F.lit(None).cast("long").alias("_value"), "_n")
    if ranges.filter(wide).isEmpty():
        cutted = cutted.withColumn("_value", F.lit(None).cast("long"))
    else:
        # At most rows / part_rows ranges, each with the values of one step.
        marks = ranges.filter(wide).select(*day, F.lit(True).alias("_wide"))

        def marked(rows: DataFrame, spread_by: str) -> DataFrame:
            return lookup_join(rows, marks, day, [spread_by], "left", limits, lookup_bytes=size).withColumn(
                "_value", F.when(F.col("_wide"), units)
            ).drop("_wide")

        cutted = marked(cutted, "url")
        known = cutted if counts is None else marked(known, "opportunity_index")
        values = known.filter(F.col("_value").isNotNull()).groupBy(*day, "_value")
        steps = steps.unionAll(values.agg(rows_of.alias("_n")))
    before = Window.partitionBy("scrape_date").orderBy("_cut", F.desc("_value"))
    ahead = F.coalesce(F.sum("_n").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = steps.withColumn("_ahead", ahead).withColumn("_stretch", F.floor(F.col("_ahead") / part_rows))
    stored, size = materialize_measured(placed.withColumn(
        "_base", F.min("_ahead").over(Window.partitionBy("scrape_date", "_stretch"))
    ), "index-steps")
    return cutted, [*day, "_value"], stored, size


def laid_out_by_rank(
    scored: DataFrame, part_rows: int = PART_ROWS, limits: Limits = DEFAULT_LIMITS,
    counts: DataFrame | None = None,
) -> DataFrame:
    """``with_deal_rank`` for rows that are written by day: they leave one shuffle in parts of
    a day, each in rank order. The ``listings`` of each day and index value are ``counts``, if known.

    Ranks are the rows before a part and the rank within it. A value with more than
    ``part_rows`` rows is a step of its own; its rank is known, so its rows are dealt out.
    """
    scored, keys, steps, size = _steps(scored, part_rows, limits, counts)
    known = steps.select(
        *keys, "_stretch", "_base", F.when(F.col("_n") > part_rows, F.col("_ahead") + 1).alias("_rank"),
        F.ceil(F.col("_n") / part_rows).alias("_deals"),
    )
    joined = lookup_join(
        scored, known, keys, ["url"], "inner", limits, key_counts=steps.select(*keys, F.col("_n").alias("n")),
        lookup_bytes=size,
    )
    dealt = joined.withColumn("_deal", F.pmod(F.xxhash64("url"), F.col("_deals")))
    part = ["scrape_date", "_stretch", "_deal"]
    within = F.rank().over(Window.partitionBy(*part).orderBy(F.desc_nulls_last("opportunity_index")))
    return dealt.repartition(*part).withColumn(
        "rank", F.coalesce("_rank", F.col("_base") + within).cast("long")
    )


def _few_values(scored: DataFrame, limits: Limits) -> bool:
    """Whether the ranks of all index values of all days can be broadcast, with a margin for
    the estimate of their number."""
    values = scored.agg(F.approx_count_distinct(F.struct("scrape_date", "opportunity_index"))).first()[0]
    return values * VALUE_BYTES <= limits.broadcast_bytes


def index_a(
    listings: DataFrame, rank_after_filter: bool = False, limits: Limits = DEFAULT_LIMITS,
    lay_out: bool = False,
) -> DataFrame:
    """Gold: index A and rank, without neighbourhoods that have a single listing.

    Ranks count all listings of the day, so the published ones have gaps;
    ``rank_after_filter`` ranks the published rows alone. With ``lay_out`` the rows
    are ready to be written by day: where both lookup tables are broadcast they lie as
    ``listings`` do, which must lie by day, and are not shuffled; else one shuffle ranks them.
    """
    scored, size = _score(listings, limits)
    many = F.col("listing_count") > 1
    scored = scored.filter(many) if rank_after_filter else scored
    if lay_out and (size > limits.broadcast_bytes or not _few_values(scored, limits)):
        ranked = laid_out_by_rank(scored, limits=limits)
    else:
        ranked = with_deal_rank(scored, limits)
    return ranked.filter(many).select(*GOLD.fieldNames())


def neighborhood_average_price(listings: DataFrame, price: str = "price_eur") -> DataFrame:
    return listings.groupBy("neighborhood").agg(
        F.avg(price).alias("avg_neighborhood_price"),
        F.count(F.lit(1)).alias("listing_count"),
    )


def index_b(
    listings: DataFrame,
    price: str = "price_eur",
    area: str = "area_sqm",
    source: str = "synthetic",
    url_prefix: str = "https://listings.example/inmueble/",
    row_key: tuple[str, ...] = LISTING_KEY,
    limits: Limits = DEFAULT_LIMITS,
) -> DataFrame:
    """Index B: share below the neighbourhood's average price over all days."""
    stats, size = materialize_measured(
        neighborhood_average_price(listings, price), "neighborhood-averages"
    )
    joined = lookup_join(
        listings, stats.drop("listing_count"), ["neighborhood"], list(row_key), "inner", limits,
        key_counts=stats.select("neighborhood", F.col("listing_count").alias("n")),
        lookup_bytes=size,
    )
    return joined.withColumns({
        "opportunity_index": scoring.relative_to_average_price(
            F.col(price), F.col("avg_neighborhood_price")
        ),
        "price_eur": F.col(price),
        "area_sqm": F.col(area),
        "area_m2": F.col(area),
        "price_per_sqm": F.try_divide(F.col(price), F.col(area)),
        "source": F.lit(source),
        "url": synthetic_url(url_prefix, *[F.col(k) for k in row_key]),
    })


def index_c(
    listings: DataFrame,
    districts: DataFrame,
    is_deal: Column | None = None,
    limits: Limits = DEFAULT_LIMITS,
) -> DataFrame:
    """Index C: percent below the reference price of the listing's district."""
    reference = one_each(districts, "avg_price_sqm").withColumnRenamed(
        "avg_price_sqm", "reference_price_sqm"
    )
    joined = lookup_join(
        listings, reference, ["district"], list(LISTING_KEY), "left", limits
    )
    return joined.withColumn(
        "opportunity_index",
        scoring.percent_below_reference(
            F.col("price_per_sqm"), F.col("reference_price_sqm"), is_deal
        ),
    )
