"""Declared schemas of every table.

Prices, areas and indexes are DOUBLE: a 32-bit float loses cents above 16.7
million and turns distinct indexes into ties. ``scrape_date`` stays an ISO
string, whose order is the date order, so partition values need no inference.
``rank`` is BIGINT: a day may hold more rows than an int counts.
"""

from pyspark.sql import types as T

STR, INT, BIG, DBL = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()


def _struct(*fields):
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


# What a portal delivers, before validation: every value is still text.
INCOMING = _struct(
    ("source", STR), ("url", STR), ("title", STR), ("raw_price", STR), ("raw_area", STR),
    ("raw_rooms", STR), ("neighborhood", STR), ("district", STR),
    ("latitude", STR), ("longitude", STR), ("scraped_at", STR), ("scrape_date", STR),
)

# Bronze: texts kept raw, coordinates and time typed. ``source`` and ``date``
# are directory keys.
BRONZE = _struct(
    ("url", STR), ("title", STR), ("raw_price", STR), ("raw_area", STR), ("raw_rooms", STR),
    ("neighborhood", STR), ("district", STR), ("latitude", DBL), ("longitude", DBL),
    ("scraped_at", T.TimestampNTZType()), ("scrape_date", STR),
    ("source", STR), ("date", STR),
)

BRONZE_CSV = _struct(
    ("title", STR), ("price", INT), ("price_per_sqm", DBL), ("area_sqm", INT), ("rooms", INT),
    ("bathrooms", INT), ("neighborhood", STR), ("district", STR), ("latitude", DBL),
    ("longitude", DBL), ("opportunity_index", DBL), ("scrape_date", STR),
)

SILVER = _struct(
    ("source", STR), ("url", STR), ("title", STR), ("price_eur", DBL), ("area_sqm", DBL),
    ("rooms", INT), ("price_per_sqm", DBL), ("neighborhood", STR), ("district", STR),
    ("latitude", DBL), ("longitude", DBL), ("scraped_at", T.TimestampNTZType()),
    ("scrape_date", STR),
)

GOLD = _struct(
    ("source", STR), ("url", STR), ("title", STR), ("price_eur", DBL), ("area_sqm", DBL),
    ("rooms", INT), ("price_per_sqm", DBL), ("neighborhood", STR), ("district", STR),
    ("latitude", DBL), ("longitude", DBL), ("neighborhood_avg_price_per_sqm", DBL),
    ("opportunity_index", DBL), ("rank", BIG), ("scrape_date", STR),
)

# The gazetteer is input, not code.
GAZETTEER_DISTRICT = _struct(
    ("district", STR), ("lat", DBL), ("lon", DBL), ("avg_price_sqm", DBL),
)
GAZETTEER_BARRIO = _struct(
    ("barrio", STR), ("district", STR), ("lat", DBL), ("lon", DBL),
    ("price_min", INT), ("price_max", INT),
)
