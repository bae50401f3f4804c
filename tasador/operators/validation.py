"""Record checks: which rows may enter Bronze, and which cleaned rows break a bound."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasador.functions.parsing import default_date, utc_now

REQUIRED = ("source", "url", "title", "raw_price", "raw_area")
COORDINATES = ("latitude", "longitude")


#: What was wrong with a record's types before it became texts; null if nothing.
TYPE_PROBLEM = "type_problem"


def _reasons(*checks: tuple[Column, str | Column]) -> Column:
    return F.concat_ws("; ", *[
        F.when(failed, text if isinstance(text, Column) else F.lit(text)) for failed, text in checks
    ])


def utc_time(text: Column) -> Column:
    """The time of a text in UTC: with an offset or zone it is converted, without one it
    counts as UTC. Null when unreadable."""
    zoned = text.rlike(r"[0-9]:[0-9]{2}.*(?:[zZ]|[+-][0-9]{1,2}(?::?[0-9]{2})?|[A-Za-z]/?[A-Za-z_]+)\s*$")
    seconds = (F.unix_micros(text.try_cast("timestamp")).cast("decimal(20,0)") * F.lit("0.000001").cast(
        "decimal(7,6)")).cast("decimal(18,6)")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.when(zoned, epoch + F.make_dt_interval(secs=seconds)).otherwise(
        text.try_cast("timestamp_ntz")
    )


def check_records(incoming: DataFrame, now: Column | None = None) -> DataFrame:
    """Type the incoming texts and add ``is_valid`` and ``reject_reason``.

    A record needs its required texts, and what it gives as coordinates or time
    must be readable. An absent time is the time of the ingest.
    """
    now = utc_now() if now is None else now
    typed = {name: F.col(name).try_cast("double") for name in COORDINATES}
    at = utc_time(F.col("scraped_at"))
    checks = [(F.col(name).isNull(), f"{name} missing") for name in REQUIRED]
    checks += [
        (F.col(name).isNotNull() & value.isNull(), f"{name} not a number")
        for name, value in typed.items()
    ]
    checks.append((F.col("scraped_at").isNotNull() & at.isNull(), "scraped_at not a time"))
    if TYPE_PROBLEM in incoming.columns:
        checks.append((F.col(TYPE_PROBLEM).isNotNull(), F.col(TYPE_PROBLEM)))
    checked = incoming.withColumn("reject_reason", _reasons(*checks)).drop(TYPE_PROBLEM)
    checked = checked.withColumns(
        {**typed, "scraped_at": F.when(F.col("scraped_at").isNull(), now).otherwise(at)}
    )
    return checked.withColumns({
        "scrape_date": default_date(F.col("scrape_date"), F.col("scraped_at")),
        "is_valid": F.col("reject_reason") == "",
    })


def check_cleaned(silver: DataFrame) -> DataFrame:
    """Add ``is_valid`` and ``reject_reason`` for the bounds of cleaned values."""
    def broken(name, bound, text):
        return [
            (F.col(name).isNull(), f"{name} missing"),
            (F.coalesce(bound, F.lit(False)), f"{name} {text}"),
        ]

    reason = _reasons(
        *broken("price_eur", F.col("price_eur") < 0, "below 0"),
        *broken("area_sqm", F.col("area_sqm") <= 0, "not above 0"),
        (F.coalesce(F.col("rooms") < 0, F.lit(False)), "rooms below 0"),
        *broken("price_per_sqm", F.col("price_per_sqm") < 0, "below 0"),
    )
    return silver.withColumn("reject_reason", reason).withColumn(
        "is_valid", F.col("reject_reason") == ""
    )
