"""Ranked lexical search: exact inner products of sparse vectors, by ball trees.

A document is the sparse vector of its terms' impacts, an item that of its
terms' weights, and a score is their inner product in whole numbers (the
formulas are in ``impacts`` and ``weights``). Components outside the terms of all
items never count, so vectors are kept in the items' terms.

Documents are dealt to cells of near vectors and each task builds ball trees
over blocks of them: a node holds the centroid c and the radius r of its
documents, and no document x in it scores more than q.c + |q| r for an item q.
Centroids are floating-point numbers, so radii and bounds are rounded up by more
than their error. For each item a tree is searched best-first: the node with the
largest bound is opened next, and the search of a tree ends when that bound is
less than the k-th best score so far. Leaves are scored exactly, in 64-bit
integers. A task carries the k best of each item from block to block, starting
with a floor: the k-th best score in a sample of documents.

The sample (``sample`` rows, by a hash of their place) fits the cells and the
floors only; every document is in a tree, and the result does not depend on it.
Items are searched in sets of about ``set_terms`` terms, each in one pass over
the documents. A task holds a block; the driver holds one set of items, its
terms' document frequencies, and the sample.

Rows of one item_id are one item with all their terms. A repeated doc_id is a
document each time. Null texts and texts without a term are no documents, items
without a term have no result. A null doc_id comes after all others of its score.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tasador.llm.texts import chunks, flat, mix, prefix_hashes, span_hashes
from tasador.plans.workspace import materialize


@dataclass(frozen=True)
class Settings:
    k: int = 10
    leaf: int = 64
    block_rows: int = 4096
    block_terms: int = 2_000_000
    sample: int = 4096
    set_terms: int = 200_000


# --- Terms ------------------------------------------------------------------

_INSIDE = np.zeros(256, bool)
_INSIDE[list(range(48, 58)) + list(range(65, 91)) + list(range(97, 123)) + list(range(128, 256))] = True


def term_spans(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes with A-Z lower-cased, begin and end of every term, and the text it is in."""
    lower = np.where((data >= 65) & (data <= 90), data | np.uint8(32), data)
    inside = _INSIDE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[starts] = True
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1] | edge[1:-1]
    closes[:-1] &= ~inside[1:] | edge[1:-1]
    begin, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return lower, begin, end, np.searchsorted(starts, begin, "right") - 1


class Vocabulary:
    """Numbers of known terms, found by hash and compared byte by byte."""

    def __init__(self, terms: list[str]):
        data, starts = flat(pa.array(terms, pa.string()))
        hashes = span_hashes(prefix_hashes(data), starts[:-1], starts[1:])
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.number = hashes[order], order
        if len(terms) and (np.diff(self.hashes) == 0).any():
            raise ValueError("two terms have one hash")
        self.data, self.starts = data, starts

    def __len__(self) -> int:
        return len(self.number)

    def find(self, lower: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The number of each term, or -1."""
        if not len(begin) or not len(self):
            return np.full(len(begin), -1)
        hashes = span_hashes(prefix_hashes(lower), begin, end)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self) - 1)
        number = self.number[at]
        length = end - begin
        hit = np.flatnonzero(
            (self.hashes[at] == hashes) & (np.diff(self.starts)[number] == length)
        )
        if len(hit):
            n = length[hit]
            first = np.cumsum(n) - n
            step = np.arange(n.sum()) - np.repeat(first, n)
            same = lower[np.repeat(begin[hit], n) + step] == self.data[
                np.repeat(self.starts[number[hit]], n) + step
            ]
            hit = hit[np.logical_and.reduceat(same, first)]
        found = np.full(len(begin), -1)
        found[hit] = number[hit]
        return found


def _counted(batches: Iterator[pa.RecordBatch], known: Vocabulary) -> Iterator[pa.RecordBatch]:
    """Documents with their numbers of terms, and the known terms with their frequencies."""
    row = TaskContext.get().partitionId() << 40
    for batch in chunks(batches):
        lower, begin, end, of = term_spans(*flat(batch.column("text")))
        total = np.bincount(of, minlength=batch.num_rows)
        number = known.find(lower, begin, end)
        hit = number >= 0
        cell, tf = np.unique(of[hit] * max(1, len(known)) + number[hit], return_counts=True)
        bounds = np.searchsorted(cell, np.arange(batch.num_rows + 1) * max(1, len(known)))
        ends = pa.array(bounds.astype("i4"))
        out = pa.RecordBatch.from_arrays([
            pa.array(np.arange(row, row + batch.num_rows)), batch.column("doc_id"),
            pa.array(total.astype("i8")),
            pa.ListArray.from_arrays(ends, pa.array((cell % max(1, len(known))).astype("i4"))),
            pa.ListArray.from_arrays(ends, pa.array(tf.astype("i4"))),
        ], names=["row", "doc_id", "n", "terms", "tf"])
        row += batch.num_rows
        yield out.filter(pa.array(total > 0))


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches):
        lower, begin, end, of = term_spans(*flat(batch.column("text")))
        raw = lower.tobytes()
        yield pa.RecordBatch.from_arrays([
            batch.column("item_id").take(pa.array(of)),
            pa.array([raw[a:b].decode() for a, b in zip(begin, end)], pa.string()),
        ], names=["item_id", "term"])


# --- Scores -----------------------------------------------------------------


@dataclass(frozen=True)
class Corpus:
    """Documents with a term, and all their terms with repeats."""

    documents: int
    terms: int


def weights(df: np.ndarray, corpus: Corpus) -> np.ndarray:
    n = 2 * corpus.documents + 2
    return np.array([math.floor(1000 * math.log(n / (2 * int(d) + 1))) for d in df], "i8")


def impacts(tf: np.ndarray, n: np.ndarray, corpus: Corpus) -> np.ndarray:
    """Of terms with frequency ``tf`` in documents of ``n`` terms."""
    m = 100 - 90 + (90 * n.astype("i8") * corpus.documents) // corpus.terms
    tf = tf.astype("i8")
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


# --- Trees ------------------------------------------------------------------

#: Relative error allowed for sums of floating-point products; above that of 100,000 terms.
_SLACK = 1e-10


@dataclass
class Docs:
    """Sparse vectors: terms and impacts of document i lie in start[i]:start[i+1]."""

    ids: np.ndarray
    start: np.ndarray
    terms: np.ndarray
    values: np.ndarray

    def __len__(self) -> int:
        return len(self.ids)

    def take(self, at: np.ndarray) -> Docs:
        n = np.diff(self.start)[at]
        start = np.concatenate([[0], np.cumsum(n)])
        places = np.repeat(self.start[:-1][at] - start[:-1], n) + np.arange(start[-1])
        return Docs(self.ids[at], start, self.terms[places], self.values[places])

    def dot(self, dense: np.ndarray) -> np.ndarray:
        """Inner products with a dense vector; no document is empty."""
        return np.add.reduceat(self.values * dense[self.terms], self.start[:-1])

    def dense(self, i: int, width: int) -> np.ndarray:
        out = np.zeros(width)
        span = slice(self.start[i], self.start[i + 1])
        out[self.terms[span]] = self.values[span]
        return out


def ball(docs: Docs, width: int) -> tuple[np.ndarray, float, np.ndarray]:
    """Centroid, radius (rounded up), and the squared distances to the centroid."""
    centre = np.bincount(docs.terms, weights=docs.values, minlength=width) / len(docs)
    values = docs.values.astype("f8")
    squares = np.add.reduceat(values * values, docs.start[:-1])
    size = float(centre @ centre)
    far = squares - 2 * docs.dot(centre) + size
    return centre, math.sqrt(float((far + _SLACK * (squares + size)).max())), far


def halves(docs: Docs, far: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Which documents are nearer to the second of two distant ones; the direction between
    them and the bound on it."""
    values = docs.values.astype("f8")
    squares = np.add.reduceat(values * values, docs.start[:-1])
    one = int(far.argmax())
    first = docs.dense(one, width)
    along = docs.dot(first)
    two = int((squares - 2 * along).argmax())
    direction = docs.dense(two, width) - first
    place = docs.dot(direction)
    at = (squares[two] - squares[one]) / 2
    side = place > at
    if min(side.sum(), len(side) - side.sum()) * 32 < len(side):
        # Nearly all on one side: cut in the middle, so that trees stay shallow.
        side = np.zeros(len(docs), bool)
        side[np.argsort(place, kind="stable")[len(docs) // 2 :]] = True
        at = float(np.median(place))
    return side, direction, at


@dataclass
class Items:
    """Weights of items, sparse, with their lengths rounded up."""

    start: np.ndarray
    terms: np.ndarray
    weights: np.ndarray
    norms: np.ndarray = field(init=False)

    def __post_init__(self):
        w = self.weights.astype("f8")
        squares = [float((w[a:b] * w[a:b]).sum()) for a, b in zip(self.start[:-1], self.start[1:])]
        self.norms = np.sqrt(np.array(squares)) * (1 + _SLACK)

    def __len__(self) -> int:
        return len(self.start) - 1

    def bounds(self, centre: np.ndarray, radius: float) -> np.ndarray:
        """The most that any document in a ball may score, for every item."""
        inner = np.add.reduceat(self.weights * centre[self.terms], self.start[:-1])
        return (inner + self.norms * radius) * (1 + _SLACK)


@dataclass
class Tree:
    """Leaves hold documents; ``bounds`` are the items' bounds of every node."""

    bounds: list[np.ndarray]
    children: list[tuple[int, int] | None]
    leaves: list[Docs | None]


def build(docs: Docs, items: Items, width: int, leaf: int) -> Tree:
    tree = Tree([], [], [])

    def add(own: Docs) -> tuple[int, np.ndarray]:
        centre, radius, far = ball(own, width)
        tree.bounds.append(items.bounds(centre, radius))
        tree.children.append(None)
        tree.leaves.append(own)
        return len(tree.leaves) - 1, far

    open_ = [add(docs)]
    while open_:
        node, far = open_.pop()
        own = tree.leaves[node]
        if len(own) <= leaf:
            continue
        side, _, _ = halves(own, far, width)
        children = [add(own.take(np.flatnonzero(part))) for part in (~side, side)]
        tree.children[node], tree.leaves[node] = (children[0][0], children[1][0]), None
        open_ += children
    return tree


class Best:
    """The k best documents of every item so far."""

    def __init__(self, floors: np.ndarray, k: int):
        self.k, self.floors = k, floors.astype("i8")
        self.scores = [np.zeros(0, "i8") for _ in floors]
        self.ids = [np.zeros(0, "i8") for _ in floors]
        self.opened = self.all = 0

    def least(self, item: int) -> int:
        """A document with a smaller score is not among the k best."""
        own = self.scores[item]
        full = int(own[-1]) if len(own) == self.k else 0
        return max(1, int(self.floors[item]), full)

    def add(self, item: int, scores: np.ndarray, ids: np.ndarray) -> None:
        keep = scores >= self.least(item)
        if keep.any():
            scores = np.concatenate([self.scores[item], scores[keep]])
            ids = np.concatenate([self.ids[item], ids[keep]])
            order = np.lexsort((ids, -scores))[: self.k]
            self.scores[item], self.ids[item] = scores[order], ids[order]


def search(tree: Tree, items: Items, width: int, best: Best) -> None:
    """Best-first search of a tree for every item."""
    bounds = np.array(tree.bounds)
    weight = np.zeros(width, "i8")
    leaves = sum(own is not None for own in tree.leaves)
    for item in range(len(items)):
        best.all += leaves
        if bounds[0, item] < best.least(item):
            continue
        span = slice(items.start[item], items.start[item + 1])
        weight[items.terms[span]] = items.weights[span]
        own = bounds[:, item].tolist()
        queue = [(-own[0], 0)]
        while queue:
            bound, node = heapq.heappop(queue)
            if -bound < best.least(item):
                break
            docs = tree.leaves[node]
            if docs is None:
                for child in tree.children[node]:
                    if own[child] >= best.least(item):
                        heapq.heappush(queue, (-own[child], child))
            else:
                best.opened += 1
                best.add(item, docs.dot(weight), docs.ids)
        weight[items.terms[span]] = 0


# --- On Spark ---------------------------------------------------------------

_NO_ID = np.iinfo("i8").max


def _docs(columns: dict[str, pa.Array], corpus: Corpus) -> Docs:
    n = columns["terms"].value_lengths().to_numpy(zero_copy_only=False)
    start = np.concatenate([[0], np.cumsum(n)])
    terms = columns["terms"].flatten().to_numpy(zero_copy_only=False)
    tf = columns["tf"].flatten().to_numpy(zero_copy_only=False)
    totals = np.repeat(columns["n"].to_numpy(zero_copy_only=False), n)
    ids = columns["doc_id"].fill_null(_NO_ID).to_numpy(zero_copy_only=False)
    return Docs(ids, start, terms, impacts(tf, totals, corpus))


_COLUMNS = ("row", "doc_id", "n", "terms", "tf")


@dataclass
class Cells:
    """Cuts fitted on a sample: node -> (terms, direction, bound, lower, upper); a negative
    child is a cell. ``parts`` is the number of parts of each cell."""

    cuts: list[tuple[np.ndarray, np.ndarray, float, int, int]]
    parts: np.ndarray

    def of(self, docs: Docs, width: int) -> np.ndarray:
        cell = np.zeros(len(docs), "i4")
        waiting = [(0, np.arange(len(docs)))] if self.cuts else []
        while waiting:
            node, at = waiting.pop()
            if not len(at):
                continue
            terms, values, bound, *children = self.cuts[node]
            direction = np.zeros(width)
            direction[terms] = values
            side = docs.take(at).dot(direction) > bound
            for child, own in zip(children, (at[~side], at[side])):
                if child < 0:
                    cell[own] = -child - 1
                else:
                    waiting.append((child, own))
        return cell


def fit_cells(sample: Docs, width: int, documents: int, s: Settings) -> Cells:
    """Cells of up to ``leaf`` documents of the sample, in parts of about a block each."""
    cuts, sizes = [], []

    def add(own: Docs) -> int:
        if len(own) <= s.leaf:
            sizes.append(len(own))
            return -len(sizes)
        side, direction, bound = halves(own, ball(own, width)[2], width)
        place = len(cuts)
        cuts.append(())
        children = [add(own.take(np.flatnonzero(part))) for part in (~side, side)]
        terms = np.flatnonzero(direction)
        cuts[place] = terms.astype("i4"), direction[terms], bound, *children
        return place

    if len(sample):
        add(sample)
    share = np.array(sizes or [1]) / max(1, sum(sizes))
    return Cells(cuts, np.maximum(1, np.ceil(share * documents / s.block_rows)).astype("i8"))


def _dealt(batches: Iterator[pa.RecordBatch], cells: Cells, corpus: Corpus, width: int):
    for batch in batches:
        if not batch.num_rows:
            continue
        cell = cells.of(_docs({c: batch.column(c) for c in _COLUMNS}, corpus), width)
        row = batch.column("row").to_numpy().astype("u8")
        part = (mix(row) % cells.parts[cell].astype("u8")).astype("i8")
        yield pa.RecordBatch.from_arrays(
            [pa.array(cell), pa.array(part), *[batch.column(c) for c in _COLUMNS]],
            names=["cell", "part", *_COLUMNS],
        )


def _blocks(batches: Iterator[pa.RecordBatch], s: Settings) -> Iterator[dict[str, pa.Array]]:
    """Rows in blocks of bounded numbers of rows and terms."""
    kept: list[pa.RecordBatch] = []
    rows = terms = 0
    for batch in batches:
        n = np.cumsum(batch.column("terms").value_lengths().to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            done = n[start - 1] if start else 0
            stop = min(start + s.block_rows - rows, batch.num_rows,
                       max(start + 1, int(np.searchsorted(n, done + s.block_terms - terms, "right"))))
            kept.append(batch.slice(start, stop - start))
            rows, terms = rows + stop - start, terms + n[stop - 1] - done
            start = stop
            if rows >= s.block_rows or terms >= s.block_terms:
                yield _joined(kept)
                kept, rows, terms = [], 0, 0
    if kept:
        yield _joined(kept)


def _joined(kept: list[pa.RecordBatch]) -> dict[str, pa.Array]:
    return {c: pa.concat_arrays([b.column(c) for b in kept]) for c in _COLUMNS}


def _searched(
    batches: Iterator[pa.RecordBatch], items: Items, floors: np.ndarray, corpus: Corpus,
    width: int, s: Settings,
) -> Iterator[pa.RecordBatch]:
    best = Best(floors, s.k)
    for block in _blocks(batches, s):
        search(build(_docs(block, corpus), items, width, s.leaf), items, width, best)
    n = [len(x) for x in best.scores]
    ids = np.concatenate(best.ids) if n else np.zeros(0, "i8")
    yield pa.RecordBatch.from_arrays([
        pa.array(np.repeat(np.arange(len(n)), n).astype("i4")),
        pa.array(ids, pa.int64(), mask=ids == _NO_ID),
        pa.array(np.concatenate(best.scores) if n else ids),
    ], names=["item", "doc_id", "score"])


def _search_set(docs: DataFrame, terms: DataFrame, s: Settings) -> DataFrame:
    """``item_id, doc_id, score``: candidates of each task for one set of items."""
    spark = docs.sparkSession
    rows = terms.orderBy(F.col("item_id").asc_nulls_first(), "term").collect()
    vocabulary = sorted({r["term"] for r in rows})
    number = {t: i for i, t in enumerate(vocabulary)}
    names = list(dict.fromkeys(r["item_id"] for r in rows))
    known, width = Vocabulary(vocabulary), len(vocabulary)
    counted = materialize(docs.select("doc_id", "text").mapInArrow(
        partial(_counted, known=known),
        "row long, doc_id long, n long, terms array<int>, tf array<int>",
    ), "lexical-terms")
    totals = counted.agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("terms")).first()
    schema = f"item_id {terms.schema['item_id'].dataType.simpleString()}, doc_id long, score long"
    if not totals["n"]:
        return spark.createDataFrame([], schema)
    corpus = Corpus(totals["n"], totals["terms"])
    # One count for each term of the set.
    df = np.zeros(width, "i8")
    for r in counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        df[r["term"]] = r["count"]
    weight = weights(df, corpus)
    of = np.array([number[r["term"]] for r in rows], "i8")
    place = {name: i for i, name in enumerate(names)}
    item_of = np.array([place[r["item_id"]] for r in rows], "i8")
    items = Items(np.searchsorted(item_of, np.arange(len(names) + 1)), of, weight[of])

    vectors = counted.filter(F.size("terms") > 0)
    picked = vectors.orderBy(F.xxhash64("row"), "row").limit(s.sample).toArrow()
    sample = _docs({c: picked.column(c).combine_chunks() for c in _COLUMNS}, corpus)
    floors = Best(np.zeros(len(items)), s.k)
    if len(sample):
        search(build(sample, items, width, s.leaf), items, width, floors)
    lows = np.array([x[-1] if len(x) == s.k else 0 for x in floors.scores], "i8")
    cells = fit_cells(sample, width, corpus.documents, s)
    dealt = vectors.mapInArrow(
        partial(_dealt, cells=cells, corpus=corpus, width=width),
        "cell int, part long, row long, doc_id long, n long, terms array<int>, tf array<int>",
    ).repartition("cell", "part").sortWithinPartitions("cell", "part", "row")
    found = dealt.select(*_COLUMNS).mapInArrow(
        partial(_searched, items=items, floors=lows, corpus=corpus, width=width, s=s),
        "item int, doc_id long, score long",
    )
    # As many names as the set has items.
    named = spark.createDataFrame(
        [(i, name) for i, name in enumerate(names)],
        f"item int, item_id {terms.schema['item_id'].dataType.simpleString()}",
    )
    return found.join(F.broadcast(named), "item").select("item_id", "doc_id", "score")


def rank(docs: DataFrame, items: DataFrame, s: Settings = Settings()) -> DataFrame:
    """``item_id, rank, doc_id, score``: the best documents (``doc_id, text``) of every item
    (``item_id, text``)."""
    kind = items.schema["item_id"].dataType.simpleString()
    terms = materialize(items.select("item_id", "text").mapInArrow(
        _item_terms, f"item_id {kind}, term string"
    ).distinct(), "lexical-items")
    sets = max(1, math.ceil(terms.count() / s.set_terms))
    own = F.pmod(F.xxhash64("item_id"), F.lit(sets))
    found = reduce(DataFrame.unionAll, [
        _search_set(docs, terms.filter(own == i), s) for i in range(sets)
    ])
    order = Window.partitionBy("item_id").orderBy(
        F.col("score").desc(), F.col("doc_id").asc_nulls_last()
    )
    return found.withColumn("rank", F.row_number().over(order)).filter(
        F.col("rank") <= s.k
    ).select("item_id", "rank", "doc_id", "score")


#: The same for DuckDB, with every score computed.
ORACLE = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents),
tf AS MATERIALIZED (SELECT doc_id, term, count(*)::BIGINT AS tf FROM words GROUP BY ALL),
lengths AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY doc_id),
total AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM lengths),
weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w
  FROM tf, total GROUP BY term),
items AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
impacts AS (
  SELECT doc_id, term,
    (1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // terms)) AS impact
  FROM tf JOIN lengths USING (doc_id), total),
scores AS (
  SELECT item_id, doc_id, sum(w * impact)::BIGINT AS score
  FROM items JOIN weights USING (term) JOIN impacts USING (term) GROUP BY ALL),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank,
    doc_id, score FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
