"""Nearest neighbours by inner product, through stable projections and a kd-tree.

Vectors get one more component that makes all of them equally long, and
queries are scaled to that length; then the largest inner product is the least
Euclidean distance. Points are projected to ``width`` dimensions by Gaussian
(2-stable) vectors, so a squared projected distance is the squared distance
times a chi-square variable. A kd-tree over the projected points deals them to
leaves. A query takes the points of a leaf by projected distance and verifies
them on the original vectors, until the projected distance exceeds the
distance of its ``k``-th neighbour by so much that a nearer point would have
been met before with probability ``sure``. It starts in its own leaf and then
visits the other leaves that this radius reaches, nearest first and twice as
many in each round; so the expected recall is ``sure``.

Equal vectors are one point that keeps its ``k + 1`` smallest ids, all that a
result can need; equal queries are answered once. The tree's splits come from
a sample of at most about ``sample_rows`` points, every point is indexed, and a
leaf is cut into blocks of about ``block_rows`` points.

Defined results: rows with a null id, and vectors that are null, zero, or hold
a null or non-finite component, take no part, and neither do vectors whose
length isn't the most frequent one. Ties go to the smaller id. A query with
fewer than ``k`` candidates gets all of them. Repeated rows count once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tasador.plans.workspace import materialize


@dataclass(frozen=True)
class Settings:
    k: int = 20
    width: int = 16
    sure: float = 0.98
    sample_rows: int = 20_000
    block_rows: int = 2_048
    queries: int = 4_096
    step: int = 256
    seed: int = 5

    def radius(self) -> float:
        """Quantile of chi-square with ``width`` degrees, by Wilson and Hilferty."""
        part = 2 / (9 * self.width)
        return self.width * (1 - part + NormalDist().inv_cdf(self.sure) * part**0.5) ** 3


@dataclass(frozen=True)
class _Index:
    settings: Settings
    longest: float
    directions: np.ndarray  # (components + 1, width)
    axes: np.ndarray  # of inner nodes in heap order; -1 at leaves
    cuts: np.ndarray
    low: np.ndarray  # boxes of leaves
    high: np.ndarray
    leaf: np.ndarray  # number of each leaf node
    blocks: np.ndarray | None = None


def _matrix(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype("f8")
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _points(vectors: np.ndarray, longest: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(longest**2 - np.einsum("ij,ij->i", vectors, vectors), 0))
    return np.hstack([vectors, rest[:, None]])


def _queries(vectors: np.ndarray, longest: float) -> np.ndarray:
    size = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
    return np.hstack([vectors * (longest / size)[:, None], np.zeros((len(vectors), 1))])


def _tree(points: np.ndarray, depth: int, width: int):
    """Axes and cuts of a kd-tree by medians, in heap order, and the boxes of its leaves."""
    nodes = (1 << (depth + 1)) - 1
    axes, cuts = np.full(nodes, -1, "i8"), np.zeros(nodes)
    low, high = np.full((nodes, width), -np.inf), np.full((nodes, width), np.inf)
    own = {0: np.arange(len(points))}
    for node in range((1 << depth) - 1):
        rows = own.pop(node, None)
        if rows is None or len(rows) < 2:
            continue
        spread = np.ptp(points[rows], axis=0)
        axis = int(spread.argmax())
        cut = float(np.median(points[rows, axis]))
        left = points[rows, axis] <= cut
        if left.all() or not left.any():
            continue
        axes[node], cuts[node] = axis, cut
        for child, part in ((2 * node + 1, rows[left]), (2 * node + 2, rows[~left])):
            own[child] = part
            low[child], high[child] = low[node], high[node]
        high[2 * node + 1, axis] = cut
        low[2 * node + 2, axis] = cut
    used = np.zeros(nodes, bool)
    used[0] = True
    for node in range(nodes):
        if used[node] and axes[node] >= 0:
            used[2 * node + 1] = used[2 * node + 2] = True
    leaves = np.flatnonzero(used & (axes < 0))
    number = np.full(nodes, -1, "i8")
    number[leaves] = np.arange(len(leaves))
    return axes, cuts, low[leaves], high[leaves], number


def _leaves(projected: np.ndarray, index: _Index) -> np.ndarray:
    node = np.zeros(len(projected), "i8")
    while True:
        axis = index.axes[node]
        inner = np.flatnonzero(axis >= 0)
        if not len(inner):
            return index.leaf[node]
        at = node[inner]
        right = projected[inner, index.axes[at]] > index.cuts[at]
        node[inner] = 2 * at + 1 + right


def _reach(projected: np.ndarray, index: _Index) -> np.ndarray:
    """Squared distance of each point (rows) to each leaf's box (columns)."""
    out = np.zeros((len(projected), len(index.low)))
    for axis in range(projected.shape[1]):
        x = projected[:, axis : axis + 1]
        out += np.maximum(0, np.maximum(index.low[:, axis] - x, x - index.high[:, axis])) ** 2
    return out


def _place(batches: Iterator[pa.RecordBatch], index: _Index) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        projected = _points(_matrix(batch.column("vector")), index.longest) @ index.directions
        yield pa.RecordBatch.from_arrays([
            batch.column("id"), batch.column("vector"), pa.array(_leaves(projected, index)),
        ], names=["id", "vector", "leaf"])


_VISIT = "query long, vector array<double>, leaf long, block long, least double"


def _visits(
    batches: Iterator[pa.RecordBatch], index: _Index, start_at: int, stop_at: int
) -> Iterator[pa.RecordBatch]:
    """Where queries go: to their leaves number ``start_at`` up to ``stop_at``, nearest first,
    of those within their radius. The own leaf has number 0.

    ``least`` is the score that the k-th neighbour has at least, so far.
    """
    for batch in batches:
        vectors = _matrix(batch.column("vector"))
        for start in range(0, len(vectors), 1024):
            part = vectors[start : start + 1024]
            projected = _queries(part, index.longest) @ index.directions
            least = batch.column("least").to_numpy(zero_copy_only=False)[start : start + 1024]
            radius = index.settings.radius() * _distances(least, part, index)
            reach = _reach(projected, index)
            reach[np.arange(len(part)), _leaves(projected, index)] = -1
            turn = np.argsort(reach, axis=1, kind="stable")[:, start_at:stop_at]
            inside = np.take_along_axis(reach, turn, axis=1) <= radius[:, None]
            row, leaf = np.nonzero(inside)[0], turn[inside]
            times = index.blocks[leaf]
            row, leaf = np.repeat(row, times), np.repeat(leaf, times)
            block = np.arange(len(leaf)) - np.repeat(np.cumsum(times) - times, times)
            yield pa.RecordBatch.from_arrays([
                batch.column("id").slice(start, len(part)).take(pa.array(row)),
                batch.column("vector").slice(start, len(part)).take(pa.array(row)),
                pa.array(leaf), pa.array(block), pa.array(least[row]),
            ], names=["query", "vector", "leaf", "block", "least"])


def _distances(scores: np.ndarray, queries: np.ndarray, index: _Index) -> np.ndarray:
    """Squared distances of the scaled queries to points with these inner products."""
    size = np.sqrt(np.einsum("ij,ij->i", queries, queries))
    with np.errstate(invalid="ignore"):
        found = 2 * index.longest**2 - 2 * scores * index.longest / size
    return np.where(np.isfinite(scores), np.maximum(found, 0), np.inf)


_FOUND = "query long, id long, score double, verified long"


def _verify(points: pa.Table, visits: pa.Table, index: _Index) -> pa.Table:
    """The best ``k + 1`` points of a block for each query that visits it."""
    s, out = index.settings, ([], [], [], [])
    if points.num_rows and visits.num_rows:
        ids, vectors = points.column("id").to_numpy(), _matrix(points.column("vector"))
        projected = _points(vectors, index.longest) @ index.directions
        asked = _matrix(visits.column("vector"))
        theirs = _queries(asked, index.longest) @ index.directions
        sizes = np.sqrt(np.einsum("ij,ij->i", asked, asked))
        norms = np.einsum("ij,ij->i", projected, projected)
        names = visits.column("query").to_numpy()
        least = visits.column("least").to_numpy()
        radius, scale = s.radius(), 2 * index.longest
        for q in range(len(asked)):
            near = norms - 2 * (projected @ theirs[q]) + theirs[q] @ theirs[q]
            order = np.argsort(near, kind="stable")
            bound, scores, done = least[q], np.zeros(0), 0
            while done < len(order):
                away = max(0.0, index.longest * scale - scale * bound / sizes[q])
                if near[order[done]] > radius * away:
                    break
                part = order[done : done + s.step]
                scores = np.concatenate([scores, vectors[part] @ asked[q]])
                done += len(part)
                if len(scores) > s.k:
                    # The point itself may be among them, so one more than k.
                    bound = max(bound, np.partition(scores, -s.k - 1)[-s.k - 1])
            # Ties at the edge stay; the ids decide between them later.
            edge = least[q]
            if done > s.k + 1:
                edge = max(edge, np.partition(scores, -s.k - 1)[-s.k - 1])
            best = order[:done]
            if np.isfinite(edge):
                best = best[scores >= edge - 1e-9 * max(1.0, abs(edge))]
            exact = np.einsum("ij,j->i", vectors[best], asked[q])
            for column, values in zip(out, (
                np.full(len(best), names[q]), ids[best], exact, np.full(len(best), done)
            )):
                column.append(values)
    kinds = ("i8", "i8", "f8", "i8")
    return pa.table([
        pa.array(np.concatenate(c).astype(k) if c else np.zeros(0, k)) for c, k in zip(out, kinds)
    ], names=["query", "id", "score", "verified"])


def _usable(rows: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    vector = F.transform(F.col(vector_column), lambda x: x.cast("double"))
    rows = rows.select(F.col(id_column).cast("long").alias("id"), vector.alias("vector")).filter(
        "id IS NOT NULL AND vector IS NOT NULL"
    )
    # Zeros of either sign are one value.
    rows = rows.withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0)))

    def finite(x):
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    rows = rows.filter(F.forall("vector", finite) & F.exists("vector", lambda x: x != 0))
    return rows


def _best(found: DataFrame, n: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= n)


def nearest(
    rows: DataFrame, is_query: Column, s: Settings = Settings(),
    id_column: str = "vec_id", vector_column: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the nearest rows of all rows that are queries.

    ``is_query`` is a condition on the column ``id``.
    """
    spark = rows.sparkSession
    empty = "query_id long, rank int, vec_id long, score double"
    usable = _usable(rows, id_column, vector_column)
    sizes = usable.groupBy(F.size("vector").alias("size")).agg(F.count("*").alias("n"))
    common = sizes.orderBy(F.desc("n"), "size").limit(1).collect()
    if not common:
        return spark.createDataFrame([], empty)
    components = common[0]["size"]
    usable = usable.filter(F.size("vector") == components).distinct()

    # One point for each vector, with its smallest ids.
    order = Window.partitionBy("vector").orderBy("id")
    few = usable.withColumn("at", F.row_number().over(order)).filter(F.col("at") <= s.k + 1)
    points = materialize(few.groupBy("vector").agg(
        F.array_sort(F.collect_list("id")).alias("ids")
    ).select(F.col("ids")[0].alias("id"), "ids", "vector"), "points")
    squares = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x)
    figures = points.agg(F.count("*").alias("n"), F.max(F.sqrt(squares)).alias("longest")).first()
    longest = figures["longest"] * (1 + 1e-12)
    directions = np.random.default_rng(s.seed).standard_normal((components + 1, s.width))

    place = F.pmod(F.xxhash64("id", F.lit("tree")), F.lit(1 << 30)) / float(1 << 30)
    sample = points.filter(place < s.sample_rows / figures["n"]).select("vector").toArrow()
    projected = _points(_matrix(sample.column("vector")), longest) @ directions if (
        sample.num_rows) else np.zeros((0, s.width))
    # No more leaves than the sample can split well.
    most = max(1, min(figures["n"] // s.block_rows, len(projected) // 16))
    index = _Index(s, longest, directions, *_tree(projected, most.bit_length() - 1, s.width))

    placed = materialize(points.select("id", "vector").mapInArrow(
        lambda batches: _place(batches, index), "id long, vector array<double>, leaf long"
    ), "points-placed")
    counts = {r["leaf"]: r["n"] for r in placed.groupBy("leaf").agg(F.count("*").alias("n")).collect()}
    blocks = np.asarray([-(-counts.get(i, 0) // s.block_rows) for i in range(len(index.low))], "i8")
    index = _Index(*[getattr(index, f) for f in index.__dataclass_fields__ if f != "blocks"], blocks)

    # A distinct vector is asked for if any of its rows is a query.
    asking = usable.filter(is_query)
    heads = points.select("vector", F.col("id").alias("head"))
    asking = asking.join(heads, "vector").select("id", "head")
    asked = materialize(points.select("id", "vector").join(
        asking.select(F.col("head").alias("id")).distinct(), "id", "left_semi"
    ), "points-asked")
    parts = max(1, -(-asked.count() // s.queries))
    where = F.element_at(F.array(*[F.lit(int(b)) for b in np.maximum(blocks, 1)]),
                         F.col("leaf").cast("int") + 1)
    held = placed.withColumn("block", F.pmod(F.xxhash64("id"), where).cast("long")).withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    )

    def visit(queries: DataFrame, start: int, stop: int) -> DataFrame:
        visits = queries.mapInArrow(
            lambda batches: _visits(batches, index, start, stop), _VISIT
        )
        visits = visits.withColumn("part", F.pmod(F.xxhash64("query"), F.lit(parts)).cast("int"))
        keys = ["leaf", "block", "part"]
        return held.groupBy(*keys).cogroup(visits.groupBy(*keys)).applyInArrow(
            lambda points, visits: _verify(points, visits, index), _FOUND
        )

    # Twice as many leaves in each round, so that a query brings back no more than about k
    # points of each, and the radius shrinks in between.
    unknown = F.lit(float("-inf"))
    told, found = asked.withColumn("least", unknown), None
    start, stop = 0, 1
    while start < len(index.low):
        new = visit(told, start, stop)
        every = new if found is None else found.unionAll(new)
        found = materialize(_best(every, s.k + 1).drop("place"), "near")
        kth = found.groupBy("query").agg(F.count("*").alias("n"), F.min("score").alias("least"))
        kth = kth.filter(F.col("n") > s.k).select(F.col("query").alias("id"), "least")
        told = asked.join(kth, "id", "left").withColumn("least", F.coalesce("least", unknown))
        start, stop = stop, 2 * stop
    ids = points.select("id", "ids")
    single = found.join(ids, "id").select("query", F.explode("ids").alias("id"), "score")
    lists = _best(single, s.k + 1).groupBy("query").agg(
        F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("away"), "id"))).alias("near")
    )
    answered = asking.join(lists, asking["head"] == lists["query"]).select(
        F.col("id").alias("query_id"),
        F.slice(F.filter("near", lambda x: x["id"] != F.col("id")), 1, s.k).alias("near"),
    )
    return answered.select("query_id", F.posexplode("near").alias("place", "hit")).select(
        "query_id", (F.col("place") + 1).cast("int").alias("rank"),
        F.col("hit.id").alias("vec_id"), (-F.col("hit.away")).alias("score"),
    )
