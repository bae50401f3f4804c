"""Queries on the published Gold table."""

import re
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tasador.functions.parsing import iso_date
from tasador.functions.scoring import average_index, tidy
from tasador.operators.radius import DEFAULT_RADIUS_KM, within_radius

# How many deals a caller may ask for, and the defaults.
DEAL_COUNT_BOUNDS = (1, 100)
DEFAULT_TOP = 10
DEFAULT_NEARBY = 50
CHART_BARS = 20
ALL_DISTRICTS = "All Districts"

DEAL_COLUMNS = (
    "source", "url", "title", "price_eur", "area_sqm", "rooms", "price_per_sqm",
    "neighborhood", "district", "latitude", "longitude",
)
AVERAGE_COLUMNS = ("neighborhood_avg_price_per_sqm", "avg_neighborhood_price")


def _check_count(n: int) -> None:
    low, high = DEAL_COUNT_BOUNDS
    if not low <= n <= high:
        raise ValueError(f"n must be between {low} and {high}")


def _deal_columns(gold: DataFrame) -> list[str]:
    averages = [c for c in AVERAGE_COLUMNS if c in gold.columns]
    return [*DEAL_COLUMNS, *averages, "opportunity_index", "scrape_date"]


def _best_first(deals: DataFrame, n: int) -> DataFrame:
    """The n best; the key decides between equal indexes."""
    _check_count(n)
    return deals.orderBy(F.desc_nulls_last("opportunity_index"), "url", "scrape_date").limit(n)


def latest_date(gold: DataFrame) -> Column:
    """The newest scrape_date as a scalar subquery, evaluated before the scan."""
    return gold.select(F.max("scrape_date")).scalar()


def snapshot(gold: DataFrame, scrape_date: str | None = None) -> DataFrame:
    """Rows of the given date, else of the newest one."""
    wanted = latest_date(gold) if scrape_date is None else F.lit(scrape_date)
    return gold.filter(F.col("scrape_date") == wanted)


def positive_deals(gold: DataFrame, scrape_date: str | None = None) -> DataFrame:
    return snapshot(gold, scrape_date).filter(F.col("opportunity_index") > 0)


def top_deals(gold: DataFrame, n: int = DEFAULT_TOP, scrape_date: str | None = None) -> DataFrame:
    deals = positive_deals(gold, scrape_date)
    return _best_first(deals.select(*_deal_columns(gold)), n)


def nearby_deals(
    gold: DataFrame,
    lat: float,
    lon: float,
    radius_km: float = DEFAULT_RADIUS_KM,
    n: int = DEFAULT_NEARBY,
    scrape_date: str | None = None,
) -> DataFrame:
    """Best listings within the radius, of all dates unless one is given."""
    scope = gold if scrape_date is None else snapshot(gold, scrape_date)
    near = within_radius(scope, lat, lon, radius_km)
    columns = [*_deal_columns(gold), tidy(F.col("distance_km"), 2).alias("distance_km")]
    return _best_first(near.select(*columns), n)


def apply_filters(
    deals: DataFrame,
    max_price: float | None = None,
    min_area: float | None = None,
    min_rooms: int = 0,
    district: str = ALL_DISTRICTS,
) -> DataFrame:
    if max_price is not None:
        deals = deals.filter(F.col("price_eur") <= max_price)
    if min_area is not None:
        deals = deals.filter(F.col("area_sqm") >= min_area)
    if min_rooms > 0:
        deals = deals.filter(F.coalesce(F.col("rooms"), F.lit(0)) >= min_rooms)
    if district != ALL_DISTRICTS:
        deals = deals.filter(F.col("district") == district)
    return deals


def search_deals(
    gold: DataFrame, n: int = DEFAULT_NEARBY, scrape_date: str | None = None, **filters: Any
) -> DataFrame:
    """The n best deals that pass the filters (filtered before the limit)."""
    deals = apply_filters(positive_deals(gold, scrape_date), **filters)
    return _best_first(deals.select(*_deal_columns(gold)), n)


def neighborhood_stats(gold: DataFrame, scrape_date: str | None = None) -> DataFrame:
    """Per neighbourhood of one snapshot, best average index first."""
    return (
        snapshot(gold, scrape_date)
        .groupBy("neighborhood", "district", "scrape_date")
        .agg(
            F.avg("price_per_sqm").alias("avg_price_per_sqm"),
            average_index(F.col("opportunity_index")).alias("avg_opportunity_index"),
            F.count(F.lit(1)).alias("listing_count"),
            F.min("price_eur").alias("min_price_eur"),
            F.max("price_eur").alias("max_price_eur"),
        )
        .orderBy(F.desc("avg_opportunity_index"), "neighborhood", "district")
    )


def kpis(deals: DataFrame) -> DataFrame:
    return deals.agg(
        F.max("opportunity_index").alias("best_opportunity_index"),
        F.avg("price_eur").alias("avg_price_eur"),
        F.avg("price_per_sqm").alias("avg_price_per_sqm"),
        F.count(F.lit(1)).alias("total_listings"),
    )


def top_neighborhoods(deals: DataFrame, n: int = CHART_BARS) -> DataFrame:
    """The chart: neighbourhoods by average price per m², highest first."""
    return (
        deals.groupBy("neighborhood")
        .agg(F.avg("price_per_sqm").alias("avg_price_per_sqm"))
        .orderBy(F.desc("avg_price_per_sqm"), "neighborhood")
        .limit(n)
    )


def districts(listings: DataFrame) -> DataFrame:
    return listings.select("district").distinct().orderBy("district")


def dataset_summary(listings: DataFrame) -> DataFrame:
    """Rows, distinct places, deals and their share, and the average price per m².

    Counting per place first keeps the distinct counts on the small table.
    """
    per_place = listings.groupBy("district", "neighborhood").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("opportunity_index") > 0).alias("deals"),
        F.sum("price_per_sqm").alias("sqm_sum"),
        F.count("price_per_sqm").alias("sqm_n"),
    )
    summary = per_place.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("listings"),
        F.count_distinct("district").alias("districts"),
        F.count_distinct("neighborhood").alias("neighborhoods"),
        F.coalesce(F.sum("deals"), F.lit(0)).alias("opportunity_deals"),
        F.try_divide(F.sum("sqm_sum"), F.sum("sqm_n")).alias("avg_price_per_sqm"),
    )
    share = F.try_divide(F.col("opportunity_deals") * 100.0, F.col("listings"))
    return summary.withColumn("opportunity_share_pct", tidy(share, 1))


def deals_envelope(deals: DataFrame, n: int = DEAL_COUNT_BOUNDS[1]) -> DataFrame:
    """One row: total, date used and the list of the n best deals, best first."""
    deals = _best_first(deals, n)
    coerced = deals.withColumn("scrape_date", iso_text(deals, "scrape_date"))
    ordered = coerced.select(
        F.struct(
            (-F.col("opportunity_index")).alias("_order"), F.col("url").alias("_url"),
            F.struct(*coerced.columns).alias("deal"),
        ).alias("item"),
        "scrape_date",
    )
    items = F.array_sort(F.collect_list("item"))
    return ordered.agg(
        F.count(F.lit(1)).alias("total"),
        F.get(items, F.lit(0))["deal"]["scrape_date"].alias("scrape_date"),
        F.transform(items, lambda item: item["deal"]).alias("deals"),
    )


def iso_text(df: DataFrame, name: str) -> Column:
    """A date column as ISO text; text stays as it is."""
    return F.col(name) if dict(df.dtypes)[name] == "string" else iso_date(F.col(name))


def query(
    spark: SparkSession, sql: str, params: Mapping[str, Any] | Sequence[Any] | None = None
) -> DataFrame:
    """Ad-hoc SQL; ``?`` markers take the values in order, ``:name`` takes by name.

    A mapping goes by name unless the SQL has ``?`` outside quotes.
    """
    if not params:
        return spark.sql(sql)
    if isinstance(params, Mapping):
        bare = re.sub(r"'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\"|`[^`]*`|--[^\n]*", "", sql)
        return spark.sql(sql, args=list(params.values()) if "?" in bare else dict(params))
    return spark.sql(sql, args=list(params))


def deals(
    gold: DataFrame, n: int, lat: float | None = None, lon: float | None = None,
    radius_km: float = DEFAULT_RADIUS_KM, scrape_date: str | None = None,
) -> DataFrame:
    """The envelope of the deals around a point, or of the top deals without one."""
    if lat is not None and lon is not None:
        return deals_envelope(nearby_deals(gold, lat, lon, radius_km, n, scrape_date), n)
    return deals_envelope(top_deals(gold, n, scrape_date), n)
