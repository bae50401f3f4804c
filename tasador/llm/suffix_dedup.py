"""Removal of repeated byte strings: every byte of a string of ``length`` bytes that
also starts earlier (a smaller doc_id, or earlier in the same text).

Windows that can be repeated are found first, over all texts. The least hash of
the 32-byte grams in a window is its anchor; equal windows have equal anchors.
Runs of windows with one anchor are pieces of a text (at most 168 bytes for
windows of 100). A piece that equals an earlier one is covered, a piece whose
anchor has no other piece is not, and only the rest is compared by suffixes.

Those pieces are dealt to shards by anchor, so all equal windows meet. A shard
reads its pieces in order of their texts, in batches. A batch gets a suffix
array by prefix doubling that refines only groups not yet sorted (Larsson and
Sadakane), common prefixes of neighbours in text order (Kasai: only irreducible
ones are compared), and classes of neighbours that share a window. Classes are
merged with those of the shard's earlier batches by binary search in their
sorted hashes. An anchor with more than ``hot_pieces`` different pieces is dealt
by window instead, so that a passage shared by many texts is no single task.

Texts are shuffled once, by doc_id. Defined results: null text is empty.
Texts shorter than a window lose nothing. Rows with one doc_id come in the
order of their texts' hashes, the earlier first; null ids come last.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tasador.llm.texts import chunks, flat, mix, prefix_hashes, signed, span_hashes


@dataclass(frozen=True)
class Settings:
    """``batch_bytes``: bytes of pieces in one suffix array."""

    length: int = 100
    gram: int = 32
    hot_pieces: int = 2_000
    batch_bytes: int = 2 << 20

    def __post_init__(self):
        if not 8 <= self.gram <= self.length <= self.gram + 254:
            raise ValueError("a window must be at most 254 bytes longer than a gram")


_LOW_BITS = np.uint64(28)


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` neighbours, from running minima of blocks."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo("u8").max, "u8")
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def pieces(data: np.ndarray, starts: np.ndarray, s: Settings):
    """Row, first window, number of windows, anchor and content hash of every piece."""
    none = np.zeros(0, "i8")
    if len(data) < s.length:
        return none, none, none, none.view("u8"), none.view("u8")
    sums = prefix_hashes(data)
    at = np.arange(len(data) - s.gram + 1)
    grams = span_hashes(sums, at, at + s.gram)
    # Equal hashes go to the first one: the position fills the low bits.
    tagged = (grams >> _LOW_BITS << _LOW_BITS) | at.astype("u8")
    least = _sliding_least(tagged, s.length - s.gram + 1) & np.uint64((1 << int(_LOW_BITS)) - 1)
    ends = np.repeat(starts[1:], np.diff(starts))
    rows = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    whole = np.flatnonzero(np.arange(len(least)) + s.length <= ends[: len(least)])
    if not len(whole):
        return none, none, none, none.view("u8"), none.view("u8")
    anchor, row = least[whole].astype("i8"), rows[whole]
    new = np.ones(len(whole), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    size = np.diff(first, append=len(whole))
    begin = whole[first]
    content = span_hashes(sums, begin, begin + size - 1 + s.length)
    return row[first], begin - starts[row[first]], size, grams[anchor[first]], content


#: ``place`` holds the first window, the copy, the number of windows and whether the piece is
#: covered, in 32, 23, 8 and one bit.
_PIECES = "key long, place long, anchor long, content long"


def _find(batches: Iterator[pa.RecordBatch], s: Settings) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches):
        data, starts = flat(batch.column("text"))
        row, first, windows, anchor, content = pieces(data, starts, s)
        # Rows come in order, so of equal pieces in a batch all but the first are covered.
        _, earliest = np.unique(mix(anchor ^ mix(content)), return_index=True)
        covered = np.ones(len(row), bool)
        covered[earliest] = False
        # Covered pieces need no comparison; they are dealt evenly.
        spread = mix(content + np.arange(len(row), dtype="u8"))
        key, copy = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "copy"))
        yield pa.RecordBatch.from_arrays([
            pa.array(key[row]),
            pa.array((copy[row].astype("i8") << 41) | (first << 9) | (windows << 1) | covered),
            pa.array(signed(np.where(covered, spread, anchor))),
            pa.array(np.where(covered, 0, signed(content))),
        ], names=["key", "place", "anchor", "content"])


_SHARD = "shard long, key long, copy int, first int, windows int, piece binary"
_SHARD_KINDS = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
_SHARD_NAMES = [part.split()[0] for part in _SHARD.split(", ")]


def _cut(batches: Iterator[pa.RecordBatch], s: Settings) -> Iterator[pa.RecordBatch]:
    """The bytes of pieces that have to be compared."""
    for batch in batches:
        rows: list[tuple] = []
        for key, copy, text, found in zip(*(batch.column(c).to_pylist() for c in (
            "key", "copy", "text", "found"
        ))):
            raw = (text or "").encode()
            for piece in found:
                if piece["copy"] != copy or piece["covered"]:
                    continue
                first, windows = piece["first"], piece["windows"]
                if not piece["hot"]:
                    rows.append((piece["anchor"], key, copy, first, windows,
                                 raw[first : first + windows - 1 + s.length]))
                    continue
                for at in range(first, first + windows):
                    own = raw[at : at + s.length]
                    shard = int.from_bytes(hashlib.blake2b(own, digest_size=8).digest(), "big", signed=True)
                    rows.append((shard, key, copy, at, 1, own))
            if len(rows) > 20_000:
                yield _batch(rows, _SHARD_KINDS, _SHARD_NAMES)
                rows = []
        yield _batch(rows, _SHARD_KINDS, _SHARD_NAMES)


def _batch(rows, kinds, names) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on, as a number; zeros follow the end."""
    padded = np.concatenate([data, np.zeros(8, "u1")])
    return np.ndarray((len(data),), ">u8", padded, strides=(1,)).astype("u8")


def suffix_array(data: np.ndarray, ends: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions sorted by their first ``depth`` bytes up to the end of their piece, and ranks.

    Equal ranks are equal prefixes. A step doubles the sorted length, and sorts
    only positions whose group has several members.
    """
    n = len(data)
    left = np.minimum(ends - np.arange(n), 7)
    # Seven bytes of each suffix, and how many of them are its own.
    masks = np.asarray([((1 << 8 * k) - 1) << 8 * (8 - k) for k in range(8)], "u8")
    keys = (_words(data) & masks[left]) | left.astype("u8")
    left = ends - np.arange(n)
    order = np.argsort(keys)
    new = np.ones(n, bool)
    new[1:] = keys[order][1:] != keys[order][:-1]
    done = 7
    rank = np.empty(n, "i8")
    heads = np.flatnonzero(new)
    rank[order] = np.repeat(heads, np.diff(heads, append=n))
    while done < depth:
        alone = new & np.append(new[1:], True)
        todo = np.flatnonzero(~alone)  # places in the order whose group isn't sorted yet
        if not len(todo):
            break
        at = order[todo]
        after = np.where(left[at] > done, rank[np.minimum(at + done, n - 1)] + 1, 0)
        # Groups stay in place: sort by group, then by the rank of what follows.
        within = np.argsort(rank[at] * np.int64(n + 2) + after)
        order[todo] = at = at[within]
        after = after[within]
        group = rank[at]
        step = np.ones(len(todo), bool)
        step[1:] = (group[1:] != group[:-1]) | (after[1:] != after[:-1])
        new[todo] = step
        first = np.flatnonzero(step)
        rank[at] = np.repeat(todo[first], np.diff(first, append=len(todo)))
        done *= 2
    return order, rank


def common_prefixes(data: np.ndarray, ends: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """Of each place in the order but the first: bytes shared with the place before, capped.

    In text order a value is one less than its left neighbour's where both
    suffixes continue the same pair; the others, the irreducible ones, are
    compared eight bytes at a time.
    """
    n = len(data)
    before = np.full(n, -1, "i8")
    before[order[1:]] = order[:-1]
    at = np.arange(n)
    reducible = np.zeros(n, bool)
    reducible[1:] = (before[1:] > 0) & (before[:-1] >= 0) & (before[1:] - 1 == before[:-1])
    reducible[1:] &= (ends[1:] == ends[:-1]) & (
        ends[np.maximum(before[1:], 0)] == ends[np.maximum(before[:-1], 0)])
    shared = np.zeros(n, "i8")
    open_ = np.flatnonzero(~reducible & (before >= 0))
    longest = np.minimum(ends[open_] - open_, ends[before[open_]] - before[open_])
    words, done = np.append(_words(data), np.uint64(0)), 0
    while len(open_):
        differ = words[np.minimum(open_ + done, n)] ^ words[np.minimum(before[open_] + done, n)]
        equal = np.full(len(open_), 8)
        for k in range(1, 9):  # leading equal bytes
            equal[differ >= np.uint64(1 << 8 * (k - 1))] = 8 - k
        shared[open_] = np.minimum(done + equal, longest)
        done += 8
        on = (equal == 8) & (longest > done)
        open_, longest = open_[on], longest[on]
    last = np.maximum.accumulate(np.where(reducible, 0, at))
    plcp = np.where(reducible, np.maximum(shared[last] - (at - last), 0), shared)
    return np.minimum(plcp[order[1:]], most)


_RUNS = "key long, copy int, first int, windows int"
_RUN_NAMES = [part.split()[0] for part in _RUNS.split(", ")]
_RUN_KINDS = [pa.int64(), pa.int32(), pa.int32(), pa.int32()]


class _Merge:
    """Window classes of a shard's batches so far: sorted runs of hashes, few and growing."""

    def __init__(self):
        self.runs: list[np.ndarray] = []

    def known(self, hashes: np.ndarray) -> np.ndarray:
        found = np.zeros(len(hashes), bool)
        for run in self.runs:
            at = np.minimum(np.searchsorted(run, hashes), len(run) - 1)
            found |= run[at] == hashes
        return found

    def add(self, hashes: np.ndarray) -> None:
        if not len(hashes):
            return
        self.runs.append(np.sort(hashes))
        while len(self.runs) > 1 and len(self.runs[-2]) < 2 * len(self.runs[-1]):
            last = self.runs.pop()
            self.runs[-1] = np.sort(np.concatenate([self.runs[-1], last]))


def repeated_windows(raw: list[bytes], windows: np.ndarray, merge: _Merge, s: Settings) -> np.ndarray:
    """Of all windows of a batch's pieces, in order: whether an equal one came before."""
    data = np.frombuffer(b"".join(raw), "u1")
    sizes = np.asarray([len(x) for x in raw], "i8")
    stops = np.cumsum(sizes)
    ends = np.repeat(stops, sizes)
    order, _ = suffix_array(data, ends, s.length)
    shared = common_prefixes(data, ends, order, s.length)
    first = np.repeat(stops - sizes, windows)
    inside = np.arange(len(first)) - np.repeat(np.cumsum(windows) - windows, windows)
    at = first + inside  # positions of all windows
    group = np.empty(len(data), "i8")
    group[order] = np.cumsum(np.concatenate([[True], shared < s.length]))
    # The order of positions is the order of texts, so the first of a class is its least.
    _, earliest, back = np.unique(group[at], return_index=True, return_inverse=True)
    hashes = span_hashes(prefix_hashes(data), at[earliest], at[earliest] + s.length)
    old = merge.known(hashes)
    merge.add(hashes[~old])
    covered = np.ones(len(at), bool)
    covered[earliest] = old
    return covered


def _shards(batches: Iterator[pa.RecordBatch], s: Settings) -> Iterator[pa.RecordBatch]:
    merge = _Merge()
    for batch in chunks(batches, "piece", s.batch_bytes):
        raw = batch.column("piece").to_pylist()
        windows = batch.column("windows").to_numpy().astype("i8")
        covered = repeated_windows(raw, windows, merge, s)
        piece = np.repeat(np.arange(len(raw)), windows)
        inside = np.arange(len(piece)) - np.repeat(np.cumsum(windows) - windows, windows)
        at = np.flatnonzero(covered)
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] != at[:-1] + 1) | (piece[at[1:]] != piece[at[:-1]])
        begin = np.flatnonzero(new)
        size = np.diff(begin, append=len(at))
        of = piece[at[begin]]
        key, copy, first = (batch.column(c).to_numpy() for c in ("key", "copy", "first"))
        yield pa.RecordBatch.from_arrays([
            pa.array(key[of]), pa.array(copy[of]),
            pa.array((first[of] + inside[at[begin]]).astype("i4")), pa.array(size.astype("i4")),
        ], names=_RUN_NAMES)


_RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
_RESULT_KINDS = [*[pa.int64()] * 4, pa.string(), pa.binary()]
_RESULT_NAMES = [part.split()[0] for part in _RESULT.split(", ")]


def _remove(batches: Iterator[pa.RecordBatch], s: Settings, keep: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc_id, copy, text, found, runs in zip(*(batch.column(c).to_pylist() for c in (
            "doc_id", "copy", "text", "found", "runs"
        ))):
            raw = (text or "").encode()
            spans = sorted((x["first"], x["first"] + x["windows"] - 1 + s.length) for x in [
                *(p for p in found or () if p["covered"]), *(runs or ())
            ] if x["copy"] == copy)
            merged: list[list[int]] = []
            for a, b in spans:
                if merged and a <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], b)
                else:
                    merged.append([a, b])
            kept, at = [], 0
            for a, b in merged:
                kept.append(raw[at:a])
                at = b
            left = b"".join([*kept, raw[at:]])
            rows.append((doc_id, len(raw), len(raw) - len(left), len(merged),
                         hashlib.sha256(left).hexdigest(), left if keep else None))
            if len(rows) >= 2_000:
                yield _batch(rows, _RESULT_KINDS, _RESULT_NAMES)
                rows = []
        yield _batch(rows, _RESULT_KINDS, _RESULT_NAMES)


def remove_repeats(docs: DataFrame, s: Settings = Settings(), keep_bytes: bool = False) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` and, if asked for, the bytes left."""
    key = F.coalesce("doc_id", F.lit((1 << 63) - 1))
    rows = docs.select(key.alias("key"), "doc_id", "text")
    copies = Window.partitionBy("key").orderBy(F.col("doc_id").asc_nulls_last(), F.xxhash64("text"))
    rows = rows.withColumn("copy", F.row_number().over(copies))
    found = rows.select("key", "copy", "text").mapInArrow(lambda batches: _find(batches, s), _PIECES)

    # Copies and positions are in the high bits of a place, so it sorts by them. Dealt by
    # anchor once, for both windows.
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = found.repartition(parts, "anchor").select(
        "key", F.shiftright("place", 41).cast("int").alias("copy"),
        F.shiftright("place", 9).bitwiseAND(0xFFFFFFFF).cast("int").alias("first"),
        F.shiftright("place", 1).bitwiseAND(0xFF).cast("int").alias("windows"),
        (F.col("place").bitwiseAND(1) == 1).alias("covered"), "anchor", "content",
    )
    same = Window.partitionBy("anchor", "content").orderBy("key", "copy", "first")
    anchors = Window.partitionBy("anchor")
    ranked = found.withColumn("covered", F.col("covered") | (F.row_number().over(same) > 1))
    counted = ranked.withColumn("different", F.count(F.when(~F.col("covered"), 1)).over(anchors))
    relevant = counted.filter(F.col("covered") | (F.col("different") > 1))
    per_text = relevant.groupBy("key").agg(F.collect_list(F.struct(
        "copy", "first", "windows", "anchor", "covered",
        (F.col("different") > s.hot_pieces).alias("hot"),
    )).alias("found"))

    cut = rows.join(per_text, "key").select("key", "copy", "text", "found").mapInArrow(
        lambda batches: _cut(batches, s), _SHARD
    )
    runs = cut.repartition(parts, "shard").sortWithinPartitions("key", "copy", "first").mapInArrow(
        lambda batches: _shards(batches, s), _RUNS
    )
    runs = runs.groupBy("key").agg(F.collect_list(F.struct("copy", "first", "windows")).alias("runs"))
    joined = rows.join(per_text, "key", "left").join(runs, "key", "left")
    result = joined.select("doc_id", "copy", "text", "found", "runs").mapInArrow(
        lambda batches: _remove(batches, s, keep_bytes), _RESULT
    )
    return result if keep_bytes else result.drop("kept")
