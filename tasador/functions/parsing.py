"""Text to values: prices, areas, rooms, names, locations, links and dates.

All functions take and return Columns and stay inside generated code.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tasador.functions.markup import strip

# Fixed value: the name given to a missing place or title.
UNKNOWN = "Desconocido"


def parse_price(raw: Column) -> Column:
    """``350.000 €`` -> 350000.0: digits and the decimal comma are all that counts."""
    kept = F.regexp_replace(raw, "[^0-9,]", "")
    return F.translate(kept, ",", ".").try_cast("double")


def parse_area(raw: Column) -> Column:
    """``85,5 m²`` -> 85.5: the first run of digits and commas.

    A thousands point ends the run, so ``1.200 m²`` is 1.0.
    """
    return F.translate(F.regexp_extract(raw, "[0-9,]+", 0), ",", ".").try_cast("double")


def parse_rooms(raw: Column) -> Column:
    """``3 hab.`` -> 3: the first run of digits, null beyond the int range."""
    return F.regexp_extract(raw, "[0-9]+", 0).try_cast("int")


def price_per_sqm(price: Column, area: Column) -> Column:
    return F.try_divide(price, area)


def blank_to_null(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def normalize_text(text: Column) -> Column:
    """Trim, capitalise each word, and name what is missing or blank."""
    return F.initcap(F.coalesce(blank_to_null(text), F.lit(UNKNOWN)))


def split_location(text: Column) -> tuple[Column, Column]:
    """``Barrio, District`` -> (neighborhood, district)."""
    parts = F.split(text, ",")

    def part(i):
        return F.coalesce(F.nullif(strip(F.get(parts, F.lit(i))), F.lit("")), F.lit(UNKNOWN))

    return part(0), part(1)


def absolute_url(link: Column, host: str | Column) -> Column:
    """Prefix the host to a link that starts with a slash; null becomes empty."""
    link = F.coalesce(link, F.lit(""))
    host = F.lit(host) if isinstance(host, str) else host
    return F.when(link.startswith("/"), F.concat(host, link)).otherwise(link)


def synthetic_url(prefix: str, *key: Column) -> Column:
    """A URL made of a row key, the same under any partitioning or retry."""
    return F.concat(F.lit(prefix), F.concat_ws("-", *[k.cast("string") for k in key]), F.lit("/"))


def source_slug(source: Column) -> Column:
    """A source name that is safe as a directory key; letters and digits of any script stay."""
    return F.regexp_replace(F.lower(source), r"[^\p{L}\p{N}_\-]", "_")


def utc_now() -> Column:
    """The time of the query in UTC, whatever the session's zone."""
    return F.convert_timezone(None, F.lit("UTC"), F.localtimestamp())


def iso_date(value: Column) -> Column:
    """Date or timestamp to ``YYYY-MM-DD``."""
    return value.cast("date").cast("string")


def default_date(scrape_date: Column, scraped_at: Column) -> Column:
    """The given date text, else the day of the scrape."""
    return F.coalesce(F.nullif(scrape_date, F.lit("")), iso_date(scraped_at))


# Area limits in m² and the room range of each band.
ROOM_BANDS = ((45, 0, 1), (70, 1, 2), (100, 2, 3), (140, 3, 4))
ROOM_BAND_TOP = (4, 5)


def room_band(area: Column) -> tuple[Column, Column]:
    """Smallest and largest room count that fits an area."""
    low, high = F.lit(ROOM_BAND_TOP[0]), F.lit(ROOM_BAND_TOP[1])
    for limit, lo, hi in reversed(ROOM_BANDS):
        low = F.when(area < limit, F.lit(lo)).otherwise(low)
        high = F.when(area < limit, F.lit(hi)).otherwise(high)
    return F.when(area.isNotNull(), low), F.when(area.isNotNull(), high)


def bathrooms(rooms: Column) -> Column:
    """One bathroom per two rooms, at least one."""
    return F.when(rooms.isNotNull(), F.greatest(F.lit(1), F.floor(rooms / 2).cast("int")))
