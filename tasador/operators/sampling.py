"""Samples of an exact size."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tasador.functions.hashing import HASH_BITS, hash60
from tasador.plans.workspace import materialize

_HASHES = 1 << HASH_BITS
#: Half the window's width, in standard deviations of the chosen rows' share.
_DEVIATIONS = 6


def sample_size(rows: int, fraction: float) -> int:
    """At least one; halves round to even."""
    return max(1, round(rows * fraction))


def tag_exact_sample(
    df: DataFrame, key: str, fraction: float, tag: str = "is_sampled", salt: str = ""
) -> DataFrame:
    """Add ``tag``, true for exactly ``sample_size`` rows chosen at random.

    ``key`` must be unique; rows without one are not counted and not chosen. The
    rows with the smallest hashes are chosen, so the last hash is close to the
    chosen share of all hashes. One aggregate counts all rows, those below a
    window around that place, and those of each hash inside: a few square
    roots of the number of rows. The tag is a comparison with the hash found,
    so the data is not sorted and not shuffled. Where the last hash is outside
    the window (once in 10^8 times, or where many rows have no key), a wider one
    is counted. The number of rows, for the window's width, comes from the
    files' footers where ``df`` is a scan.
    """
    rows = df.count()
    own = hash60(F.col(key), salt)
    hashed = df.filter(F.col(key).isNotNull()).select(F.col(key).alias("key"), own.alias("hash"))
    deviations = _DEVIATIONS
    while True:
        if not rows:
            return df.withColumn(tag, F.lit(False))
        share = min(1.0, sample_size(rows, fraction) / rows)
        reach = deviations * ((share * (1 - share) / rows) ** 0.5 + 1 / rows)
        low, high = (int(min(1.0, max(0.0, share + s * reach)) * _HASHES) for s in (-1, 1))
        inside = F.col("hash").between(low, high)
        place = F.when(inside, F.col("hash")).when(F.col("hash") < low, -1).otherwise(_HASHES)
        counts = materialize(hashed.groupBy(place.alias("hash")).agg(
            F.count(F.lit(1)).alias("n"),
            F.sort_array(F.collect_list(F.when(inside, F.col("key")))).alias("keys"),
        ), "sample-window")
        seen = counts.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
            F.coalesce(F.sum(F.when(F.col("hash") < 0, F.col("n"))), F.lit(0)).alias("below"),
        ).first()
        rows = seen["rows"]
        wanted = min(rows, sample_size(rows, fraction)) - seen["below"]
        upto = F.sum("n").over(Window.orderBy("hash"))
        last = counts.filter((F.col("hash") >= 0) & (F.col("hash") < _HASHES)).withColumn(
            "upto", upto
        ).filter(F.col("upto") >= wanted).orderBy("hash").first() if wanted > 0 else None
        if last is not None:
            break
        deviations *= 16
    upper = last["keys"][wanted - (last["upto"] - last["n"]) - 1]
    chosen = (own < last["hash"]) | ((own == last["hash"]) & (F.col(key) <= F.lit(upper)))
    return df.withColumn(tag, F.coalesce(chosen, F.lit(False)))
