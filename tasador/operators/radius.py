"""Radius search around one centre, and around many at once."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasador.functions.geo import Grid, distance_km, in_bounding_box
from tasador.operators.cleaning import LISTING_KEY
from tasador.plans.joins import DEFAULT_LIMITS, Limits, grid_join, lookup_join
from tasador.plans.workspace import materialize_measured

# Bounds and defaults of the search.
RADIUS_BOUNDS_KM = (0.1, 50.0)
DEFAULT_RADIUS_KM = 2.0


def check_radius(radius_km: float) -> None:
    low, high = RADIUS_BOUNDS_KM
    if not low <= radius_km <= high:
        raise ValueError(f"radius_km must be between {low} and {high}")


def mappable(df: DataFrame) -> DataFrame:
    return df.dropna(subset=["latitude", "longitude"])


def within_radius(
    listings: DataFrame, lat: float, lon: float, radius_km: float = DEFAULT_RADIUS_KM
) -> DataFrame:
    """Listings within the radius, with the unrounded ``distance_km``.

    The box lets the scan skip files; the exact distance decides.
    """
    check_radius(radius_km)
    lat_col, lon_col = F.col("latitude"), F.col("longitude")
    near = mappable(listings).filter(in_bounding_box(lat_col, lon_col, (lat, lon), radius_km))
    distance = distance_km(F.lit(lat), F.lit(lon), lat_col, lon_col)
    return near.withColumn("distance_km", distance).filter(F.col("distance_km") <= radius_km)


def radius_join(
    listings: DataFrame,
    centers: DataFrame,
    radius_km: float,
    limits: Limits = DEFAULT_LIMITS,
) -> DataFrame:
    """Pairs of a centre and a listing within the radius.

    ``centers`` has ``center_lat`` and ``center_lon``. Each centre is repeated
    for the cells its circle can touch, which are stored, and meets only the
    listings of those cells. Few centres are broadcast. Of many, a cell where
    listings and centres crowd is cut on both sides, by the pairs it makes.
    """
    check_radius(radius_km)
    grid = Grid(radius_km)
    row, column = grid.cell(F.col("latitude"), F.col("longitude"))
    placed = mappable(listings).withColumns({"_row": row, "_column": column})
    rows, columns = grid.cells_around(F.col("center_lat"), F.col("center_lon"))
    reach, size = materialize_measured(
        centers.dropna(subset=["center_lat", "center_lon"])
        .withColumn("_row", F.explode(rows))
        .withColumn("_column", F.explode(columns)),
        "radius-cells",
    )
    cell = ["_row", "_column"]
    if size <= limits.broadcast_bytes:
        pairs = lookup_join(placed, reach, cell, list(LISTING_KEY), "inner", limits, lookup_bytes=size)
    else:
        pairs = grid_join(placed, reach, cell, list(LISTING_KEY), centers.columns, limits)
    distance = distance_km(
        F.col("center_lat"), F.col("center_lon"), F.col("latitude"), F.col("longitude")
    )
    return (
        pairs.withColumn("distance_km", distance)
        .filter(F.col("distance_km") <= radius_km)
        .drop(*cell)
    )
