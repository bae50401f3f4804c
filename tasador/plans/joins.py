"""Lookup joins that keep their shape when the data grows or one key is hot.

``lookup_join`` measures the lookup side. Within the limit it is broadcast and
the big side is not shuffled at all. Beyond it the join shuffles, and every key
with more than ``hot_rows`` rows on the big side is spread over several parts:
its rows get a part number from a hash, and its lookup rows are repeated once
per part. All rows are kept and the result equals that of the plain join.

``grid_join`` is for two sides of any size that both have hot keys: it counts
the pairs of a key and cuts both sides.
"""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasador.plans.workspace import materialize, measured_bytes


@dataclass(frozen=True)
class Limits:
    """``broadcast_bytes``: largest lookup table sent to every executor.
    ``hot_rows``: rows of one key that a single task may take.
    ``hot_pairs``: pairs of rows of one key that a single task may make."""

    broadcast_bytes: int = 64 << 20
    hot_rows: int = 4_000_000
    hot_pairs: int = 200_000_000


DEFAULT_LIMITS = Limits()


def _on(left_names, right_names) -> Column:
    pairs = [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left_names, right_names)]
    return reduce(lambda a, b: a & b, pairs)


def _prefixed(df: DataFrame, keys, prefix: str) -> tuple[DataFrame, list[str]]:
    names = [f"{prefix}{k}" for k in keys]
    return df.withColumnsRenamed(dict(zip(keys, names))), names


def lookup_join(
    big: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    spread_by: list[str],
    how: str = "left",
    limits: Limits = DEFAULT_LIMITS,
    key_counts: DataFrame | None = None,
    lookup_bytes: int | None = None,
) -> DataFrame:
    """Join ``lookup`` to ``big`` on ``keys``; null matches null.

    ``lookup`` is read more than once, so pass a stored table. ``spread_by``
    names columns of ``big`` that tell the rows of one key apart. What is
    already known saves a pass: ``key_counts`` (keys and ``n``) of ``big`` and
    ``lookup_bytes``, the measured size of ``lookup`` or more.
    """
    if lookup_bytes is None:
        lookup_bytes = measured_bytes(lookup)
    if lookup_bytes <= limits.broadcast_bytes:
        right, names = _prefixed(lookup, keys, "_lookup_")
        return big.join(F.broadcast(right), _on(keys, names), how).drop(*names)
    return spread_join(big, lookup, keys, spread_by, how, limits, key_counts)


def spread_join(
    big: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    spread_by: list[str],
    how: str = "left",
    limits: Limits = DEFAULT_LIMITS,
    key_counts: DataFrame | None = None,
) -> DataFrame:
    """The shuffled form of ``lookup_join``."""
    if key_counts is None:
        key_counts = big.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    # At most (rows of big / hot_rows) keys can be hot, so this table is small
    # however many keys there are; that bound allows the two broadcasts below.
    hot = materialize(
        key_counts.filter(F.col("n") > limits.hot_rows).select(
            *keys, F.ceil(F.col("n") / limits.hot_rows).cast("int").alias("_parts")
        ),
        "hot-keys",
    )
    right, names = _prefixed(lookup, keys, "_lookup_")
    if hot.isEmpty():
        return big.join(right, _on(keys, names), how).drop(*names)

    hot, hot_names = _prefixed(hot, keys, "_hot_")
    parts = F.coalesce(F.col("_parts"), F.lit(1))
    spread = big.join(F.broadcast(hot), _on(keys, hot_names), "left").withColumn(
        "_part", F.pmod(F.xxhash64(*spread_by), parts).cast("int")
    ).drop(*hot_names, "_parts")
    repeated = right.join(F.broadcast(hot), _on(names, hot_names), "left").withColumn(
        "_lookup_part", F.explode(F.sequence(F.lit(0), parts - 1))
    ).drop(*hot_names, "_parts")
    return spread.join(
        repeated, _on([*keys, "_part"], [*names, "_lookup_part"]), how
    ).drop(*names, "_part", "_lookup_part")


def grid_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    left_spread: list[str],
    right_spread: list[str],
    limits: Limits = DEFAULT_LIMITS,
) -> DataFrame:
    """Inner join on ``keys`` whose hot keys are dealt out on both sides.

    A key with n and m rows makes n * m pairs. Where these are more than
    ``limits.hot_pairs``, or one side has more than ``limits.hot_rows``, its left rows are
    cut into a parts and its right rows into b, by a hash of the spread columns,
    and each of the a * b tasks joins one part with one part. A left row is sent
    b times, a right row a times; the parts are as square as the sides allow.
    Both sides are read twice, so pass stored tables.
    """
    counts = [
        side.groupBy(*keys).agg(F.count(F.lit(1)).alias(n)) for side, n in ((left, "_n"), (right, "_m"))
    ]
    n, m = F.col("_n").cast("double"), F.col("_m").cast("double")
    both, names = _prefixed(counts[1], keys, "_right_")
    met = counts[0].join(both, _on(keys, names)).drop(*names)
    side = F.sqrt(F.lit(float(limits.hot_pairs)))
    hot_rows = F.lit(float(limits.hot_rows))
    # Every key here holds more than hot_rows rows or hot_pairs pairs of the input.
    hot = materialize(met.filter((n * m > limits.hot_pairs) | (n > limits.hot_rows) | (m > limits.hot_rows)).select(
        *keys,
        F.ceil(F.greatest(n / hot_rows, F.least(n / side, n * m / F.lit(float(limits.hot_pairs))))).cast("int").alias("_a"),
        F.ceil(F.greatest(m / hot_rows, F.least(m / side, n * m / F.lit(float(limits.hot_pairs))))).cast("int").alias("_b"),
    ), "hot-pairs")
    other, names = _prefixed(right, keys, "_right_")
    if hot.isEmpty():
        return left.join(other, _on(keys, names)).drop(*names)

    small = measured_bytes(hot) <= limits.broadcast_bytes
    hot, hot_names = _prefixed(hot, keys, "_hot_")
    hot = F.broadcast(hot) if small else hot
    a, b = F.coalesce("_a", F.lit(1)), F.coalesce("_b", F.lit(1))

    def dealt(rows, own_keys, own, own_parts, other, other_parts, spread):
        marked = rows.join(hot, _on(own_keys, hot_names), "left")
        return marked.withColumn(own, F.pmod(F.xxhash64(*spread), own_parts).cast("int")).withColumn(
            other, F.explode(F.sequence(F.lit(0), other_parts - 1))
        ).drop(*hot_names, "_a", "_b")

    lefts = dealt(left, keys, "_row_part", a, "_col_part", b, left_spread)
    rights = dealt(other, names, "_right_col", b, "_right_row", a, right_spread)
    return lefts.join(
        rights, _on([*keys, "_row_part", "_col_part"], [*names, "_right_row", "_right_col"])
    ).drop(*names, "_row_part", "_col_part", "_right_row", "_right_col")
