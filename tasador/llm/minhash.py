"""Near duplicates by fast similarity sketches, banding and exact verification.

A sketch has ``bands * rows`` coordinates. In round i every shingle is thrown
into one random coordinate with a value between i and i + 1, and a coordinate
keeps its least value; after as many rounds as coordinates, shingles go to each
empty coordinate in turn. So every coordinate fills, and coordinates of two
sets agree as often as the sets overlap. Sketches that agree in a band are
candidates, and candidates are verified on the full sets.

Documents with equal sets are one class with one sketch, so copies never meet
in pairs. A bucket of up to ``direct`` classes is compared pair by pair. In a
larger one, all classes are compared with one pivot: the class that shares most
with the others, as the text has that they were derived from. Classes that are
not linked with it can only be linked with each other where they differ from it
in the same shingles, and in so many of them that a lookup of the rarest few
finds every pair (``_candidates``). So no candidate is left out, and a bucket of near
copies of one text, each with changes of its own, costs about one comparison for
each. Of other pairs, those whose whole sketches differ too
much are not verified; full sets are read only for documents that are compared.

With similarity 0.85, 4 rows and 30 bands, a pair at the threshold shares no
band with probability (1 - 0.85**4)**30, about 2e-10, and has a sketch that
differs too much (``sure`` standard deviations) about as rarely.

Defined results: null and blank texts have an empty set and are linked with
nothing; a text of fewer words than a shingle has one shingle. A row without
doc_id is linked with nothing, its component is null, and it is kept. Rows
that share a doc_id count as one document.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tasador.llm.components import components
from tasador.llm.texts import chunks, flat, give_back, mix, powers, row_starts, signed, words
from tasador.plans.joins import lookup_join
from tasador.plans.workspace import materialize

_STEP = np.uint64(0x9E3779B97F4A7C15)
_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)
_LOW = np.uint64(0xFFFFFFFF)
#: Bytes of text worked on at once: a dozen arrays have eight bytes for each.
_TOGETHER = 512 << 10


@dataclass(frozen=True)
class Settings:
    shingle: int = 5
    percent: int = 85
    bands: int = 30
    rows: int = 4
    direct: int = 8
    sure: float = 6.5

    def difference(self, size: int) -> int:
        """Shingles in which a set of this size differs at most from one linked with it."""
        return (100 - self.percent) * (size + size * 100 // self.percent + 1) // (100 + self.percent)

    @property
    def agreeing(self) -> int:
        """Coordinates in which the sketches of a pair worth verifying agree, at least."""
        n, p = self.bands * self.rows, self.percent / 100
        return max(0, int(n * p - self.sure * (n * p * (1 - p)) ** 0.5))


def shingle_sets(data: np.ndarray, starts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of every text, sorted within the text, and the row of each."""
    h, rows = words(data, starts)
    n = len(starts) - 1
    bounds = row_starts(rows, n)
    size = np.diff(bounds)
    scale = powers(np.uint64(0xD1342543DE82EF95), k)
    count = max(0, len(h) - k + 1)
    sums = np.zeros(count, "u8")
    for i in range(k):
        sums += h[i : i + count] * scale[i]
    inside = rows[:count] == rows[k - 1 :] if count else np.zeros(0, bool)
    found, of = mix(sums[inside]), rows[:count][inside]
    for row in np.flatnonzero((size > 0) & (size < k)):
        own = h[bounds[row] : bounds[row + 1]]
        whole = mix(np.sum(own * scale[: len(own)], dtype="u8", keepdims=True) + np.uint64(len(own)))
        at = np.searchsorted(of, row)
        found, of = np.insert(found, at, whole), np.insert(of, at, row)
    edges = row_starts(of, n)
    for a, b in zip(edges[:-1], edges[1:]):
        found[a:b].sort()
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (of[1:] != of[:-1])
    return found[new], of[new]


def sketch(sets: np.ndarray, rows: np.ndarray, n: int, size: int) -> np.ndarray:
    """Coordinates (n, size) of the sets; those of an empty set are all full."""
    cells = np.full(n * size, _FULL)
    salts = mix(np.arange(1, 2 * size + 1, dtype="u8"))
    for i in range(2 * size):
        if not len(sets):
            break
        h = mix(sets + salts[i])
        if i < size:
            place = ((h >> np.uint64(32)) * np.uint64(size)) >> np.uint64(32)
            slot = rows * size + place.astype("i8")
        else:
            slot = rows * size + (i - size)
        np.minimum.at(cells, slot, (np.uint64(i) << np.uint64(32)) | (h & _LOW))
        open_ = (cells.reshape(n, size) == _FULL).any(axis=1)[rows]
        if not open_.all():
            sets, rows = sets[open_], rows[open_]
    return cells.reshape(n, size)


def _signatures(batches: Iterator[pa.RecordBatch], s: Settings) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches, limit=_TOGETHER):
        data, starts = flat(batch.column("text"))
        n = batch.num_rows
        sets, rows = shingle_sets(data, starts, s.shingle)
        bounds = row_starts(rows, n)
        totals = [np.zeros(len(sets) + 1, "u8") for _ in range(2)]
        np.cumsum(mix(sets + _STEP), out=totals[0][1:])
        np.cumsum(mix(sets ^ _STEP), out=totals[1][1:])
        prints = [signed(t[bounds[1:]] - t[bounds[:-1]]) for t in totals]
        cells = sketch(sets, rows, n, s.bands * s.rows).reshape(n, s.bands, s.rows)
        keys = np.zeros((n, s.bands), "u8") + mix(np.arange(1, s.bands + 1, dtype="u8"))
        for i in range(s.rows):
            keys = mix(keys + cells[:, :, i])
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id"), pa.array(np.diff(bounds).astype("i8")),
            pa.array(prints[0]), pa.array(prints[1]),
            pa.ListArray.from_arrays(
                np.arange(0, n * s.bands + 1, s.bands, dtype="i4"), pa.array(signed(keys.reshape(-1)))
            ),
            pa.array([x.tobytes() for x in mix(cells).astype("u1").reshape(n, -1)], pa.binary()),
        ], names=["doc_id", "n_shingles", "set_a", "set_b", "bands", "sketch"])
    give_back()


def _sets(batches: Iterator[pa.RecordBatch], s: Settings) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches, limit=_TOGETHER):
        sets, rows = shingle_sets(*flat(batch.column("text")), s.shingle)
        bounds = row_starts(rows, batch.num_rows)
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id"),
            pa.array([sets[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])], pa.binary()),
        ], names=["doc_id", "shingles"])
    give_back()


def _verified(batches: Iterator[pa.RecordBatch], s: Settings) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for x, y in zip(batch.column("set_x"), batch.column("set_y")):
            x, y = (np.frombuffer(v.as_buffer(), "u8") for v in (x, y))
            at = np.searchsorted(x, y)
            both = np.count_nonzero(x[np.minimum(at, len(x) - 1)] == y) if len(x) else 0
            keep.append(100 * both >= s.percent * (len(x) + len(y) - both))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _alike(batches: Iterator[pa.RecordBatch], s: Settings) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x, y = (
            np.frombuffer(b"".join(batch.column(c).to_pylist()), "u1").reshape(batch.num_rows, -1)
            for c in ("sketch_x", "sketch_y")
        )
        keep = (x == y).sum(axis=1) >= s.agreeing
        yield batch.select(["a", "b"]).filter(pa.array(keep))


#: Bits of the filter for documents whose sets are read: 4 MB at most.
_FILTER_BITS = 1 << 25


def _split(docs: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows whose doc_id may be in ``ids``, and rows whose doc_id is surely not, by a bitmap
    of bounded size."""
    bit = F.pmod(F.xxhash64("doc_id"), F.lit(_FILTER_BITS))
    maps = ids.select(bit.alias("_near_bit")).groupBy(F.bitmap_bucket_number("_near_bit").alias("_near_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_near_bit")).alias("_near_bitmap")
    )
    at = F.bitmap_bit_position(bit).cast("int")
    byte = F.conv(F.hex(F.substring("_near_bitmap", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10)
    hit = F.call_function("shiftright", byte.cast("int"), at % 8).bitwiseAND(1) == 1
    marked = docs.join(
        F.broadcast(maps), F.bitmap_bucket_number(bit) == F.col("_near_bucket"), "left"
    ).withColumn("_near_hit", F.coalesce(hit, F.lit(False))).drop("_near_bucket", "_near_bitmap")
    return marked.filter("_near_hit").drop("_near_hit"), marked.filter("NOT _near_hit").drop("_near_hit")


@contextmanager
def _few_rows(spark):
    """Small Arrow batches while rows carry two full sets."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "500")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _set_table(docs: DataFrame, ids: DataFrame, s: Settings) -> DataFrame:
    """The full sets of some documents."""
    ids = ids.distinct()
    some, _ = _split(docs, ids)
    return materialize(some.join(ids, "doc_id", "left_semi").mapInArrow(
        lambda batches: _sets(batches, s), "doc_id long, shingles binary"
    ), "near-sets")


def _links(docs: DataFrame, sketches: DataFrame, pairs: DataFrame, s: Settings) -> DataFrame:
    """Those pairs (a, b) whose full sets are as similar as asked."""
    x = sketches.select(F.col("doc_id").alias("a"), F.col("sketch").alias("sketch_x"))
    y = sketches.select(F.col("doc_id").alias("b"), F.col("sketch").alias("sketch_y"))
    pairs = materialize(pairs.join(x, "a").join(y, "b").mapInArrow(
        lambda batches: _alike(batches, s), "a long, b long"
    ), "near-pairs")
    if pairs.isEmpty():
        return pairs
    sets = _set_table(docs, pairs.select(F.explode(F.array("a", "b")).alias("doc_id")), s)
    x = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("set_x"))
    y = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("set_y"))
    verified = pairs.join(x, "a").join(y, "b").select("a", "b", "set_x", "set_y").mapInArrow(
        lambda batches: _verified(batches, s), "a long, b long"
    )
    with _few_rows(docs.sparkSession):
        return materialize(verified, "near-links")


def _similar_size(s: Settings):
    """Sets that differ more in size cannot be as similar as asked."""
    return F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * s.percent


def _pairs(left: DataFrame, right: DataFrame, s: Settings, where, key: str = "key") -> DataFrame:
    """Pairs (a, b) of rows of both sides with one key, a condition and similar sizes."""
    x, y = (side.select(key, *[F.col(c).alias(f"{c}_{tag}") for c in side.columns if c != key])
            for side, tag in ((left, "a"), (right, "b")))
    x, y = x.withColumnRenamed("doc_id_a", "a"), y.withColumnRenamed("doc_id_b", "b")
    x, y = x.withColumnRenamed("n_shingles_a", "n_a"), y.withColumnRenamed("n_shingles_b", "n_b")
    return x.join(y, key).filter(where & _similar_size(s)).select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    ).filter("a < b").distinct()


#: Members whose differences are held at once.
_ROWS_AT_ONCE = 32


def _slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
        give_back()


def _compared(batches: Iterator[pa.RecordBatch], s: Settings) -> Iterator[pa.RecordBatch]:
    """Members against their pivots: whether they link, and how they differ from the pivot.

    Shingles that only the pivot has are left out where the others fill the longest prefix.
    Few rows are answered at a time, as long texts may differ in all their shingles.
    """
    for batch in _slices(batches, _ROWS_AT_ONCE):
        linked, counts, added_, gone_ = [], [], [], []
        for x, y in zip(batch.column("set_x"), batch.column("set_y")):
            pivot, own = (np.frombuffer(v.as_buffer(), "u8") for v in (x, y))
            added = own[~_inside(own, pivot)]
            gone = pivot[~_inside(pivot, own)]
            both, differ = len(own) - len(added), len(added) + len(gone)
            linked.append(100 * both >= s.percent * (len(pivot) + len(own) - both))
            counts.append((differ, len(added)))
            longest = differ - max(1, (differ + 2 - s.difference(len(own))) // 2) + 1
            added_.append(signed(added))
            gone_.append(signed(gone if longest > len(added) else gone[:0]))
        differ, n_added = zip(*counts) if counts else ((), ())
        yield pa.RecordBatch.from_arrays([
            batch.column("pivot"), batch.column("doc_id"), batch.column("n_shingles"),
            pa.array(linked, pa.bool_()), pa.array(differ, pa.int64()), pa.array(n_added, pa.int64()),
            pa.array(added_, pa.list_(pa.int64())), pa.array(gone_, pa.list_(pa.int64())),
        ], names=["pivot", "doc_id", "n_shingles", "linked", "differ", "n_added", "added", "gone"])


def _inside(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x


def _large_links(
    docs: DataFrame, sketches: DataFrame, large: DataFrame, links: DataFrame, s: Settings
) -> DataFrame:
    """Links within large buckets, without their pairs.

    Every member is compared with its bucket's pivot. Let D(x) be the shingles in
    which x and the pivot differ. Two members b, c differ in as many shingles as
    D(b) and D(c) do. If those have fewer elements together than linked texts may
    differ in, both are linked with the pivot. Else linked members share elements
    of D, which ``_candidates`` looks up.
    """
    heads = large.groupBy("key").agg(F.min(F.struct("weight", "doc_id")).alias("head"))
    pairs = materialize(
        large.join(heads.select("key", F.col("head.doc_id").alias("pivot")), "key")
        .select("pivot", "doc_id", "n_shingles").filter("pivot <> doc_id").distinct(),
        "near-pivots",
    )
    sets = _set_table(docs, pairs.select(F.explode(F.array("pivot", "doc_id")).alias("doc_id")), s)
    x = sets.select(F.col("doc_id").alias("pivot"), F.col("shingles").alias("set_x"))
    y = sets.select("doc_id", F.col("shingles").alias("set_y"))
    both = pairs.join(y, "doc_id").join(x, "pivot").select(
        "pivot", "doc_id", "n_shingles", "set_x", "set_y"
    )
    with _few_rows(docs.sparkSession):
        compared = materialize(both.mapInArrow(
            lambda batches: _compared(batches, s),
            "pivot long, doc_id long, n_shingles long, linked boolean, differ long, n_added long, "
            "added array<long>, gone array<long>",
        ), "near-compared")
    near = compared.filter("linked").select(
        F.least("pivot", "doc_id").alias("a"), F.greatest("pivot", "doc_id").alias("b")
    )
    # Where all members are linked with the pivot there is nothing more to find.
    least = compared.filter("NOT linked").groupBy("pivot").agg(F.min("differ").alias("least"))
    groups = components(materialize(links.unionAll(near), "near-links"))
    rest = compared.join(least, "pivot").join(
        groups.withColumnRenamed("id", "doc_id"), "doc_id", "left"
    ).withColumn("component", F.coalesce("component", "doc_id"))
    return near.unionAll(_links(docs, sketches, _candidates(rest, s), s))


def _candidates(rest: DataFrame, s: Settings) -> DataFrame:
    """Pairs (a, b) of members of one pivot, of two components, that may be linked.

    With t the most that both may differ in, linked members b, c share at least
    o = (|D(b)| + |D(c)| - t) / 2 elements of D. So in any order that is the same
    for all members of a pivot, one of the first |D(b)| - o + 1 elements of D(b) is
    one of the first |D(c)| - o + 1 of D(c) (prefix filtering). The order is: what
    the pivot lacks before what only the pivot has, and rare elements before
    frequent ones. An element that one member has takes its place in the order
    but is never looked up; in near copies with words of their own changed, these fill
    nearly all prefixes. The side with the smaller D is the index; of a member
    that is linked with the pivot, only members that are not are partners, and
    those have at least ``least`` elements.
    """
    d, p = F.col("differ"), s.percent
    # The same as Settings.difference, in whole numbers.
    most = F.expr(f"((100 - {p}) * (n_shingles + n_shingles * 100 div {p} + 1)) div (100 + {p})")
    kept = ["pivot", "doc_id", "n_shingles", "differ", "n_added", "linked", "least", "component"]

    def half_up(x):
        return F.floor((x + 1) / 2).cast("long")

    def marked(column, gone):
        return F.transform(column, lambda e: F.struct(F.lit(gone).alias("gone"), e.alias("element")))

    elements = rest.select(*kept, F.inline(F.concat(marked("added", 0), marked("gone", 1))))
    counts = materialize(elements.groupBy("pivot", "element").agg(
        F.count(F.lit(1)).alias("n")
    ).filter("n > 1"), "near-elements")
    shared = lookup_join(
        elements, counts.withColumnRenamed("n", "held"), ["pivot", "element"], ["doc_id"], "inner",
        key_counts=counts,
    )
    own = Window.partitionBy("pivot", "doc_id", "gone")
    before = F.when(F.col("gone") == 0, F.col("n_added")).otherwise(d) - F.count(F.lit(1)).over(own)
    placed = shared.withColumn(
        "place", before + F.row_number().over(own.orderBy("held", "element"))
    )
    partner = F.greatest(d, F.when(F.col("linked"), F.col("least")).otherwise(d))
    in_index = F.col("place") <= d - F.greatest(F.lit(1), half_up(d + partner - most)) + 1
    in_probe = F.col("place") <= d - F.greatest(F.lit(1), half_up(d + 1 - most)) + 1
    key = F.xxhash64("pivot", "element").alias("key")
    columns = [key, "doc_id", "n_shingles", "differ", "component", "place"]
    placed = materialize(placed.select(
        *columns, in_index.alias("in_index"), in_probe.alias("in_probe")
    ).filter("in_index OR in_probe"), "near-prefixes")
    index = placed.filter("in_index").drop("in_index", "in_probe")
    probe = placed.filter("in_probe").drop("in_index", "in_probe")
    least = F.expr(f"ceil((differ_a + differ_b - (n_a + n_b) * (100 - {p}) div (100 + {p})) / 2)")
    return _pairs(index, probe, s, (F.col("component_a") != F.col("component_b")) & (
        (F.col("differ_a") < F.col("differ_b"))
        | ((F.col("differ_a") == F.col("differ_b")) & (F.col("a") < F.col("b")))
    ) & (F.col("place_a") <= F.col("differ_a") - least + 1) & (
        F.col("place_b") <= F.col("differ_b") - least + 1
    ))


def near_links(docs: DataFrame, s: Settings = Settings()) -> tuple[DataFrame, DataFrame]:
    """Signatures of all rows, and links between representatives of classes."""
    docs = docs.select("doc_id", "text")
    signs = materialize(docs.mapInArrow(
        lambda batches: _signatures(batches, s),
        "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>, "
        "sketch binary",
    ), "signatures")
    full = signs.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    first = full.groupBy("set_a", "set_b", "n_shingles").agg(F.min("doc_id").alias("doc_id"))
    kept = ["doc_id", "set_a", "set_b", "n_shingles"]
    heads = full.join(first, kept, "left_semi").dropDuplicates(kept)
    sketches = heads.select("doc_id", "sketch")
    members = heads.select("doc_id", "n_shingles", F.explode("bands").alias("key"))
    sizes = members.groupBy("key").agg(F.count("*").alias("members")).filter("members > 1")
    members = materialize(members.join(sizes, "key"), "near-members")
    # A text that others were derived from shares more buckets with them than they do with
    # each other. So the class with the fullest buckets is the best pivot.
    weights = members.groupBy("doc_id").agg((-F.sum("members")).alias("weight"))
    members = materialize(members.join(weights, "doc_id"), "near-members")
    small = members.filter(F.col("members") <= s.direct)
    links = _links(docs, sketches, _pairs(small, small, s, F.col("a") < F.col("b")), s)
    large = members.filter(F.col("members") > s.direct)
    if not large.isEmpty():
        links = materialize(
            links.unionAll(_large_links(docs, sketches, large, links, s)), "near-links"
        )
    return signs, links


def near_duplicates(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row."""
    return _labelled(*near_links(docs, s))


def without_near_duplicates(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """The rows of one document of each component, with all their columns.

    Rows without doc_id stay; of several rows with one doc_id one stays. Only
    rows whose ids are concerned are shuffled.
    """
    found = _labelled(*near_links(docs, s))
    per_id = found.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.count("*").alias("_near_rows"), F.max("kept").alias("kept")
    ).filter("_near_rows > 1 OR NOT kept")
    concerned = materialize(per_id, "near-dropped")
    some, others = _split(docs, concerned.select("doc_id"))
    names = docs.columns
    some = some.join(concerned.select("doc_id", "_near_rows", F.col("kept").alias("_near_stays")), "doc_id", "left")
    stays = some.filter(F.coalesce("_near_stays", F.lit(True)))
    once = stays.filter("_near_rows > 1").dropDuplicates(["doc_id"]).select(names)
    rest = stays.filter("_near_rows IS NULL OR _near_rows = 1").select(names)
    return others.select(names).unionByName(rest).unionByName(once)


def _labelled(signs: DataFrame, links: DataFrame) -> DataFrame:
    groups = components(links)
    keys = ["set_a", "set_b", "n_shingles"]
    classes = signs.filter("n_shingles > 0 AND doc_id IS NOT NULL").groupBy(*keys).agg(
        F.min("doc_id").alias("id")
    ).join(groups, "id", "left").select(
        *keys, F.coalesce("component", "id").alias("class_component")
    )
    found = signs.select("doc_id", *keys).join(classes, keys, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("class_component", "doc_id"))
    return found.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"),
    )


#: The same for DuckDB, from all pairs of texts that share a shingle.
ORACLE = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(
      range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM words),
sized AS (SELECT doc_id, len(s) AS n, s FROM sets),
flat AS MATERIALIZED (SELECT doc_id, n, unnest(s) AS shingle FROM sized),
pairs AS MATERIALIZED (
  SELECT a.doc_id AS x, b.doc_id AS y FROM flat a JOIN flat b USING (shingle)
  WHERE a.doc_id < b.doc_id GROUP BY x, y
  HAVING 100 * count(*) >= 85 * (any_value(a.n) + any_value(b.n) - count(*))),
links AS MATERIALIZED (SELECT x, y FROM pairs UNION ALL SELECT y, x FROM pairs),
reach AS (
  SELECT doc_id, doc_id AS other FROM sized
  UNION SELECT r.doc_id, l.y FROM reach r JOIN links l ON r.other = l.x)
SELECT doc_id, any_value(n)::BIGINT AS n_shingles, min(other) AS component_id,
       doc_id = min(other) AS kept
FROM reach JOIN sized USING (doc_id) GROUP BY doc_id
"""
