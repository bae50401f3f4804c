"""Distances, jitter, bounding boxes and grid cells."""

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from tasador.functions.hashing import gaussian_pair

# Mean Earth radius in km and metres per degree of latitude.
EARTH_RADIUS_KM = 6371.0
METRES_PER_DEGREE = 111_320.0

# Added to the radius of a prefilter so that rounding never drops a row.
PREFILTER_SLACK_KM = 0.01


def distance_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance by the spherical law of cosines.

    The cosine can leave [-1, 1] by rounding, where acos is NaN.
    """
    cosine = F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.cos(
        F.radians(lon2) - F.radians(lon1)
    ) + F.sin(F.radians(lat1)) * F.sin(F.radians(lat2))
    limited = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine))
    return F.when(cosine.isNotNull(), F.lit(EARTH_RADIUS_KM) * F.acos(limited))


def jitter(
    lat: Column, lon: Column, key: Column, radius_m: float = 200, salt: str = ""
) -> tuple[Column, Column]:
    """Shift a point by Gaussian noise of ``radius_m`` metres, fixed per key."""
    north, east = gaussian_pair(key, salt)
    step = F.lit(radius_m / METRES_PER_DEGREE)
    return lat + north * step, lon + east * step / F.cos(F.radians(lat))


def in_bounding_box(lat: Column, lon: Column, center: tuple[float, float], radius_km: float) -> Column:
    """Range predicate around a circle; files and row groups outside are skipped."""
    reach = (radius_km + PREFILTER_SLACK_KM) / EARTH_RADIUS_KM
    dlat = math.degrees(reach)
    box = lat.between(center[0] - dlat, center[0] + dlat)
    ratio = math.sin(min(reach, math.pi / 2)) / max(math.cos(math.radians(center[0])), 1e-12)
    if abs(center[0]) + dlat < 90 and ratio < 1:
        dlon = math.degrees(math.asin(ratio))
        if abs(center[1]) + dlon <= 180:
            box = box & lon.between(center[1] - dlon, center[1] + dlon)
    return box


#: Bits of each coordinate in a place key: cells of about 600 m by 300 m.
_PLACE_BITS = 16


def place_key(lat: Column, lon: Column) -> Column:
    """Latitude and longitude with their bits interleaved: what is near in both is mostly
    near in the key. Null without coordinates."""
    def spread(share):
        top = (1 << _PLACE_BITS) - 1
        bits = F.greatest(F.lit(0), F.least(F.lit(top), F.floor(share * (top + 1)))).cast("bigint")
        # Binary digits read in base 4: every bit moves to twice its place.
        return F.conv(F.bin(bits), 4, 10).cast("bigint")

    key = F.shiftleft(spread((lat + 90) / 180), 1).bitwiseOR(spread((lon + 180) / 360))
    return F.when(lat.isNotNull() & lon.isNotNull(), key)


class Grid:
    """Square cells in degrees. 360 is a whole number of cells, so cells wrap."""

    def __init__(self, radius_km: float):
        self.reach = (radius_km + PREFILTER_SLACK_KM) / EARTH_RADIUS_KM
        self.dlat = math.degrees(self.reach)
        self.columns = max(1, int(360 // (2 * self.dlat)))
        self.size = 360.0 / self.columns

    def cell(self, lat: Column, lon: Column) -> tuple[Column, Column]:
        """Row and column of the cell that holds a point."""
        row = F.floor((lat + 90) / self.size)
        column = F.floor((lon + 180) / self.size)
        return row.cast("bigint"), F.pmod(column, F.lit(self.columns)).cast("bigint")

    def cells_around(self, lat: Column, lon: Column) -> tuple[Column, Column]:
        """Arrays of the rows and the columns that the circle around a point can touch."""
        rows = F.sequence(
            F.floor((lat + 90 - self.dlat) / self.size).cast("bigint"),
            F.floor((lat + 90 + self.dlat) / self.size).cast("bigint"),
        )
        ratio = F.lit(math.sin(min(self.reach, math.pi / 2))) / F.greatest(
            F.cos(F.radians(lat)), F.lit(1e-12)
        )
        covers_pole = (F.abs(lat) + self.dlat >= 90) | (ratio >= 1)
        dlon = F.degrees(F.asin(F.least(ratio, F.lit(1.0))))
        first = F.floor((lon + 180 - dlon) / self.size).cast("bigint")
        last = F.floor((lon + 180 + dlon) / self.size).cast("bigint")
        every = covers_pole | (last - first >= self.columns - 1)
        columns = F.when(every, F.sequence(F.lit(0).cast("bigint"), F.lit(self.columns - 1).cast("bigint"))) \
            .otherwise(F.transform(F.sequence(first, last), lambda c: F.pmod(c, F.lit(self.columns))))
        return rows, columns
