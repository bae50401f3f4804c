"""Gazetteer lookups. The gazetteer is an input table and may have any size."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasador.operators.cleaning import LISTING_KEY
from tasador.plans.joins import DEFAULT_LIMITS, Limits, lookup_join

# The price range of a district around its average price.
DISTRICT_RANGE = (0.85, 1.15)


def place_names(districts: DataFrame, barrios: DataFrame) -> DataFrame:
    """One row per lower-case place name; a barrio comes before a district.

    Of barrios with the same name the one of the greatest (district, ...) is
    kept, so that a lookup never multiplies rows.
    """
    columns = ["district", "lat", "lon", "price_min", "price_max"]
    named_barrios = (
        barrios.groupBy(F.lower("barrio").alias("place"))
        .agg(F.max(F.struct(*columns)).alias("_row"))
        .select("place", "_row.*")
    )
    low, high = [
        (F.col("avg_price_sqm") * factor).cast("int") for factor in DISTRICT_RANGE
    ]
    named_districts = districts.select(
        F.lower("district").alias("place"), "district", "lat", "lon",
        low.alias("price_min"), high.alias("price_max"),
    )
    return named_barrios.unionByName(
        named_districts.join(named_barrios, "place", "left_anti")
    )


def locate(
    named: DataFrame,
    places: DataFrame,
    name: str,
    spread_by: list[str],
    limits: Limits = DEFAULT_LIMITS,
) -> DataFrame:
    """Add the place's district, centre and price range; null when unknown.

    The columns are ``place_district``, ``place_lat``, ``place_lon``,
    ``price_min`` and ``price_max``.
    """
    renamed = places.withColumnsRenamed(
        {"place": "_place", "district": "place_district", "lat": "place_lat", "lon": "place_lon"}
    )
    keyed = named.withColumn("_place", F.lower(F.col(name)))
    return lookup_join(keyed, renamed, ["_place"], spread_by, "left", limits).drop("_place")


def one_each(districts: DataFrame, *columns: str) -> DataFrame:
    """A row for each district, with the greatest values of a name that is there twice."""
    return districts.groupBy("district").agg(
        F.max(F.struct(*columns)).alias("_row")
    ).select("district", "_row.*")


def all_barrios(barrios: DataFrame) -> DataFrame:
    return barrios.select("barrio", "district").distinct().orderBy("barrio", "district")


def all_districts(districts: DataFrame) -> DataFrame:
    return districts.select("district").distinct().orderBy("district")


def district_center(
    named: DataFrame,
    districts: DataFrame,
    spread_by: list[str],
    limits: Limits = DEFAULT_LIMITS,
) -> DataFrame:
    """Add ``center_lat`` and ``center_lon`` of the exactly named district."""
    centers = one_each(districts, "lat", "lon").select(
        "district", F.col("lat").alias("center_lat"), F.col("lon").alias("center_lon")
    )
    return lookup_join(named, centers, ["district"], spread_by, "left", limits)


def price_band(
    listings: DataFrame, places: DataFrame, limits: Limits = DEFAULT_LIMITS
) -> DataFrame:
    """Add ``price_band``: below, in or above the place's range; null when unknown."""
    located = locate(listings, places, "neighborhood", list(LISTING_KEY), limits)
    per_sqm = F.col("price_per_sqm")
    return located.withColumn(
        "price_band",
        F.when(per_sqm < F.col("price_min"), "below")
        .when(per_sqm > F.col("price_max"), "above")
        .when(per_sqm.between(F.col("price_min"), F.col("price_max")), "in"),
    )
