"""Index arithmetic. Each formula returns null when an input is null."""

from pyspark.sql import Column
from pyspark.sql import functions as F

INDEX_DIGITS = 6


def clamp(value: Column, low: float, high: float) -> Column:
    """Limit to [low, high]. ``least`` and ``greatest`` skip nulls, hence the guard."""
    limited = F.greatest(F.lit(low), F.least(F.lit(high), value))
    return F.when(value.isNotNull(), limited)


def tidy(value: Column, digits: int = INDEX_DIGITS) -> Column:
    """Round (halves to even) and turn a negative zero into zero.

    Plain double arithmetic; ``round`` on doubles goes through decimal objects.
    """
    return F.rint(value * F.lit(10.0**digits)) / F.lit(10.0**digits) + F.lit(0.0)


def average_index(index: Column) -> Column:
    """Average of rounded indexes, summed as integers.

    The sum is exact, so an average of zero is zero in any order of rows.
    """
    scale = 10.0**INDEX_DIGITS
    units = F.sum(F.rint(index * scale).cast("bigint"))
    return F.try_divide(F.try_divide(units, F.count(index)), F.lit(scale))


def discount_to_average(price_per_sqm: Column, average: Column) -> Column:
    """Index A: share below the group's price per m², within [-1, 1]."""
    return tidy(clamp(F.lit(1.0) - F.try_divide(price_per_sqm, average), -1.0, 1.0))


def relative_to_average_price(price: Column, average: Column) -> Column:
    """Index B: share below the group's average price, not limited."""
    return tidy(F.try_divide(average - price, average))


def percent_below_reference(
    price_per_sqm: Column, reference: Column, is_deal: Column | None = None
) -> Column:
    """Index C: percent below a reference price, zero for what is not a deal."""
    percent = (F.lit(1.0) - F.try_divide(price_per_sqm, reference)) * 100
    deal = percent > 0 if is_deal is None else is_deal
    return F.when(percent.isNotNull(), F.when(deal, tidy(percent, 2)).otherwise(F.lit(0.0)))


def opportunity_color(index: Column) -> Column:
    """Red to green as ``#rrgg50``."""
    share = clamp(index, 0.0, 1.0)

    def byte(value):
        return F.lpad(F.lower(F.hex(value.cast("int"))), 2, "0")

    return F.concat(F.lit("#"), byte((1 - share) * 255), byte(share * 200), F.lit("50"))
