"""Connected components of links, by alternating stars of joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasador.plans.workspace import materialize



def components(links: DataFrame) -> DataFrame:
    """``id`` and ``component``, the smallest id reachable, of every id in ``a``, ``b``.

    Every round hangs neighbours on the smallest one around (first the larger,
    then the smaller neighbours), which keeps all links' connections. Rounds
    are written to the shared folder. The number of rounds grows with the
    logarithm of the components' size.
    """
    edges = links.select(
        F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")
    ).filter("u < v").distinct()
    edges = materialize(edges, "component-edges")
    while True:
        # Large star: every larger neighbour of a node goes to the least neighbour.
        both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(
            F.col("v"), F.col("m").alias("u")
        ).distinct()
        # Small star: a node and its smaller neighbours go to the least of them.
        low = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(low, "v").select(
            F.explode(F.array(F.col("v"), F.col("u"))).alias("v"), F.col("m").alias("u")
        ).filter("u < v").distinct()
        after = materialize(small, "component-edges")
        # Done when every node hangs on one node that hangs on nothing.
        deep = after.select("u").distinct().join(
            after.select(F.col("v").alias("u")).distinct(), "u", "left_semi"
        )
        twice = after.groupBy("v").count().filter("count > 1")
        edges = after
        if deep.isEmpty() and twice.isEmpty():
            break
    return edges.select(F.col("v").alias("id"), F.col("u").alias("component")).unionAll(
        edges.select(F.col("u").alias("id"), F.col("u").alias("component")).distinct()
    )
