"""An interpolated modified Kneser-Ney bigram model, counted and applied in Spark.

Tokens are words (A-Z in lower case, between ASCII white space) and one end per
text; a text's first token follows a start mark. With c the counts in the
training texts, D the three discounts of modified Kneser-Ney and N1+ the number
of different neighbours:

    p(w | v) = max(c(vw) - D, 0) / c(v.) + g(v) p(w)
    p(w)     = max(N1+(.w) - D', 0) / N1+(..) + g' / (V + 1)

Everything is keyed by 64-bit hashes. A task cuts its texts into blocks and
sends each shard one cell of a block: its pairs, their training counts and the
texts they occur in, as arrays. Shards are ranges of the first word's hash. A
shard adds up its pairs, asks the shards of the second words for their totals,
and gets them back in its own order. Then it holds its part of the model as
sorted hash arrays, which it maps into memory and searches for every cell, and
returns one row of packed sums for each block, which the block's task adds up.
Nothing but a few constants is the same for all
shards, so no vocabulary is ever collected or broadcast.

Words and pairs that make up more than a shard in a bounded sample are hot. A
hot word's pairs are spread by pair, and the occurrences of a hot pair by
block, so a shard's size is bounded; what shards must know of hot keys, at most
a few numbers for each shard, goes to all. The sample decides only where rows
are worked on, not what they give.

Defined results: null text is empty and is its end token alone. Rows are scored
row by row, also with equal or null doc_id. Without training tokens all words
are unknown: N and V are 0 and the model is uniform over one word.
"""

from __future__ import annotations

import mmap
import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasador.llm.texts import chunks, flat, give_back, mix, words

_END, _START = np.uint64(0xE2D0000000000001), np.uint64(0x57A2700000000001)
_PAIR = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Settings:
    """``shards``: 0 takes the session's shuffle partitions; a task holds
    one shard at a time. ``block_tokens``: tokens of a
    block, at most 30,000 texts. ``sample_docs``: about so many texts tell hot keys."""

    shards: int = 0
    block_tokens: int = 1_500_000
    sample_docs: int = 4_000


@dataclass(frozen=True)
class _Plan:
    shards: int
    block_tokens: int
    hot_words: np.ndarray
    hot_pairs: np.ndarray


def pair_keys(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    return mix(v * _PAIR + w)


def shard_of(h: np.ndarray, shards: int) -> np.ndarray:
    return ((h >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)


def _among(h: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are in a sorted array."""
    if not len(known):
        return np.zeros(len(h), bool)
    return known[np.minimum(np.searchsorted(known, h), len(known) - 1)] == h


def bigrams(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First words, second words and rows of all pairs; a text's last word is the end."""
    h, rows = words(*flat(batch.column("text")))
    n = batch.num_rows
    after = np.searchsorted(rows, np.arange(n), "right")
    w = np.insert(h, after, _END)
    rows = np.insert(rows, after, np.arange(n))
    v = np.empty_like(w)
    v[1:] = w[:-1]
    v[np.searchsorted(rows, np.arange(n))] = _START
    return v, w, rows


# --- Cells ------------------------------------------------------------------

_CELL = (
    "shard long, block long, v binary, vn binary, w binary, n binary, pn binary, docs binary, "
    "ids binary, nulls binary, tokens binary"
)
_CELL_NAMES = [part.split()[0] for part in _CELL.split(", ")]


def _runs(values: np.ndarray) -> np.ndarray:
    """Where runs of equal values start."""
    return np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else (
        np.zeros(0, "i8"))


class _Block:
    """Pairs of a block of texts, cut into a cell for each shard."""

    def __init__(self, plan: _Plan, number: int):
        self.plan, self.number = plan, number
        self.parts, self.ids, self.train, self.nulls, self.tokens = [], [], [], [], []
        self.rows = self.size = 0

    def add(self, batch: pa.RecordBatch) -> None:
        v, w, rows = bigrams(batch)
        self.parts.append((v, w, rows + self.rows))
        ids = batch.column("doc_id")
        self.nulls.append(ids.is_null().to_numpy(zero_copy_only=False))
        self.ids.append(ids.fill_null(0).to_numpy(zero_copy_only=False).astype("i8"))
        self.train.append(batch.column("train").to_numpy(zero_copy_only=False).astype(bool))
        self.tokens.append(np.bincount(rows, minlength=batch.num_rows).astype("u4"))
        self.rows += batch.num_rows
        self.size += len(w)

    def cells(self) -> pa.RecordBatch:
        v, w, rows = (np.concatenate(x) for x in zip(*self.parts))
        train, shards = np.concatenate(self.train), self.plan.shards
        key = pair_keys(v, w)
        where = shard_of(np.where(_among(v, self.plan.hot_words), key, v), shards)
        where = where.astype("u4")
        # By shard, first word, pair; stable, so texts are in order.
        order = np.argsort(key, kind="stable")
        order = order[np.argsort(v[order], kind="stable")]
        order = order[np.argsort(where[order], kind="stable")]
        v, w, key, rows, where = v[order], w[order], key[order], rows[order], where[order]
        types = _runs(key)
        times = np.diff(types, append=len(key))
        counts = np.add.reduceat(train[rows].astype("u4"), types)
        out: dict[str, list] = {name: [] for name in _CELL_NAMES}
        hot = _among(key[types], self.plan.hot_pairs)
        tag = (rows.astype("u2") << 1) | train[rows]
        edges = np.searchsorted(where[types], np.arange(shards + 1))
        spare = []
        for shard, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
            if a == b:
                continue
            at, end = types[a], types[b] if b < len(types) else len(key)
            keep = ~hot[a:b]
            # A hot pair's count stays here, its occurrences go to a shard of the block's.
            posted = np.repeat(keep, times[a:b])
            self._cell(out, shard, v[types[a:b]], w[types[a:b]], counts[a:b],
                       np.where(keep, times[a:b], 0), tag[at:end][posted])
            for i in np.flatnonzero(~keep) + a:
                spare.append((v[types[i]], w[types[i]], tag[types[i] : types[i] + times[i]]))
        for first, second, tags in spare:
            spread = mix(np.asarray([first ^ second], "u8") + np.uint64(self.number))
            self._cell(out, int(shard_of(spread, shards)[0]), np.asarray([first], "u8"),
                       np.asarray([second], "u8"), np.zeros(1, "u4"), np.asarray([len(tags)]), tags)
        # What the block's texts are, in a cell without pairs.
        empty = np.zeros(0, "u8")
        self._cell(out, self.number % shards, empty, empty, empty, empty, empty,
                   np.concatenate(self.ids), np.concatenate(self.nulls), np.concatenate(self.tokens))
        return pa.RecordBatch.from_arrays([
            pa.array(out[c], pa.int64() if c in ("shard", "block") else pa.binary())
            for c in _CELL_NAMES
        ], names=_CELL_NAMES)

    def _cell(self, out, shard, v, w, n, pn, docs, ids=(), nulls=(), tokens=()) -> None:
        first = _runs(v)
        for name, value in zip(_CELL_NAMES, (
            shard, self.number, v[first].tobytes(),
            np.diff(first, append=len(v)).astype("u4").tobytes(), w.tobytes(),
            n.astype("u4").tobytes(), np.asarray(pn).astype("u4").tobytes(),
            np.asarray(docs).astype("u2").tobytes(), np.asarray(ids, "i8").tobytes(),
            np.asarray(nulls, "u1").tobytes(), np.asarray(tokens, "u4").tobytes(),
        )):
            out[name].append(value)


def _cells(batches: Iterator[pa.RecordBatch], plan: _Plan) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 32
    block = _Block(plan, number)
    for batch in chunks(batches):
        for start in range(0, batch.num_rows, 8192):
            part = batch.slice(start, 8192)
            if block.rows and (
                block.size >= plan.block_tokens or block.rows + part.num_rows > 30_000
            ):
                yield block.cells()
                block = None
                give_back()
                number += 1
                block = _Block(plan, number)
            block.add(part)
    if block.rows:
        yield block.cells()


class _Shard:
    """The cells of one shard as flat arrays, by block."""

    def __init__(self, table: pa.Table):
        blocks = table.column("block").to_numpy()
        order = np.argsort(blocks)

        def column(name, kind):
            cells = table.column(name)
            parts = [np.frombuffer(cells[i].as_buffer(), kind) for i in order.tolist()]
            return np.concatenate(parts) if parts else np.zeros(0, kind)

        self.blocks = blocks[order]
        self.v = np.repeat(column("v", "u8"), column("vn", "u4"))
        self.w, self.n = column("w", "u8"), column("n", "u4")
        self.key = pair_keys(self.v, self.w)
        self.pn, self.docs = column("pn", "u4"), column("docs", "u2")
        # Where the pairs and the occurrences of each cell start.
        self.edges, self.posted = (
            np.cumsum([0, *(len(table.column(c)[i].as_buffer()) // size for i in order.tolist())])
            for c, size in (("w", 8), ("docs", 2))
        )
        self.heads = [
            (self.blocks[at], *(np.frombuffer(table.column(c)[i].as_buffer(), kind) for c, kind in (
                ("ids", "i8"), ("nulls", "u1"), ("tokens", "u4"))))
            for at, i in enumerate(order.tolist()) if len(table.column("ids")[i].as_buffer())
        ]

    def pairs(self):
        """Distinct pairs sorted by key: keys, first words, second words, training counts.

        A hot pair occurs here without its count unless its home is here. Only
        the cells' keys stay afterwards.
        """
        order = np.argsort(self.key)
        starts = _runs(self.key[order])
        first = order[starts]
        counts = np.add.reduceat(self.n[order], starts, dtype="i8") if len(starts) else np.zeros(0, "i8")
        found = self.key[first], self.v[first], self.w[first], counts
        del self.v, self.w, self.n
        return found


# --- What shards ask, and what they are told --------------------------------

_ASK = "target long, shard long, kind int, key binary, a binary, b binary"
_ASK_NAMES = [part.split()[0] for part in _ASK.split(", ")]
_WORDS, _COUNTS, _HOT_WORDS, _HOT_PAIRS = range(4)


def _row(target, shard, kind, key=(), a=(), b=()):
    arrays = [np.asarray(key, "u8"), np.asarray(a, "f8" if kind else "u4"), np.asarray(b, "u4")]
    return (target, shard, kind, *(x.tobytes() for x in arrays))


def _table(rows, names, kinds) -> pa.Table:
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


_ASK_KINDS = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]


def _discount_counts(counts: np.ndarray) -> np.ndarray:
    return np.asarray([np.count_nonzero(counts == k) for k in (1, 2, 3, 4)], "f8")


def _asks(table: pa.Table, plan: _Plan) -> pa.Table:
    """Of each second word: its count and first words here. Target -1: for all shards."""
    give_back()
    number = table.column("shard")[0].as_py()
    shard = _Shard(table)
    keys, v, w, c = shard.pairs()
    del shard, table
    rows = []
    seen = np.argsort(w, kind="stable")
    starts = _runs(w[seen])
    names = w[seen][starts]
    if len(names):
        count = np.add.reduceat(c[seen], starts)
        firsts = np.add.reduceat((c[seen] > 0).astype("i8"), starts)
        edges = np.searchsorted(shard_of(names, plan.shards), np.arange(plan.shards + 1))
        for target, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
            if a < b:
                rows.append(_row(target, number, _WORDS, names[a:b], count[a:b], firsts[a:b]))
    rows.append(_row(-1, number, _COUNTS, a=[*_discount_counts(c), 0, 0, 0, 0, 0, 0]))
    hot = np.flatnonzero(_among(v, plan.hot_words) & (c > 0))
    if len(hot):
        own, sums = _contexts(v[hot], c[hot])
        rows.append(_row(-1, number, _HOT_WORDS, own, sums.reshape(-1)))
    pairs = _among(keys, plan.hot_pairs) & (c > 0)
    if pairs.any():
        rows.append(_row(-1, number, _HOT_PAIRS, keys[pairs], c[pairs]))
    return _table(rows, _ASK_NAMES, _ASK_KINDS)


def _contexts(v: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each first word: total count, and number of pairs with count 1, 2, 3 or more."""
    order = np.argsort(v, kind="stable")
    v, c = v[order], c[order]
    starts = _runs(v)
    sums = [np.add.reduceat(x, starts) if len(starts) else np.zeros(0) for x in (
        c, c == 1, c == 2, c > 2)]
    return v[starts], np.stack([np.asarray(x, "f8") for x in sums], axis=1)


_TOLD = "shard long, target long, kind int, key binary, a binary, b binary"


def _totals(table: pa.Table, plan: _Plan) -> pa.Table:
    """Totals of this shard's second words, to each that asked, in the order of its words."""
    target = table.column("target")[0].as_py()
    if target < 0:  # for all shards; added up later
        return table.select(["target", "shard", "kind", "key", "a", "b"]).rename_columns(
            ["shard", "target", "kind", "key", "a", "b"]
        )
    asked = [
        (s, *(np.frombuffer(x.as_buffer(), k) for x, k in ((key, "u8"), (a, "u4"), (b, "u4"))))
        for s, key, a, b in zip(
            table.column("shard").to_pylist(),
            *(table.column(c).combine_chunks() for c in ("key", "a", "b")))
    ]
    sizes = [len(k) for _, k, _, _ in asked]
    names, back = np.unique(np.concatenate([k for _, k, _, _ in asked]), return_inverse=True)
    count, firsts = (
        np.bincount(back, weights=np.concatenate([x[i] for x in asked]), minlength=len(names))
        for i in (2, 3)
    )
    rows, at = [], 0
    for (shard, *_), size in zip(asked, sizes):
        own = back[at : at + size]
        at += size
        # Counts beyond 32 bits do not occur in a shard's range of words in practice; doubles do.
        rows.append((shard, target, _WORDS, b"", count[own].astype("f8").tobytes(),
                     firsts[own].astype("f8").tobytes()))
    figures = [0, 0, 0, 0, *_discount_counts(firsts), count.sum(), np.count_nonzero(count)]
    rows.append((-1, target, _COUNTS, b"", np.asarray(figures, "f8").tobytes(),
                 np.asarray([firsts.sum()], "f8").tobytes()))
    return _table(rows, ["shard", "target", "kind", "key", "a", "b"], _ASK_KINDS)


def _common(table: pa.Table, shards: int) -> pa.Table:
    """Adds up what all shards must know, and addresses it to each."""
    counts, pairs = np.zeros(11), []
    hot: dict[int, np.ndarray] = {}
    for kind, key, a, b in zip(table.column("kind").to_pylist(),
                               *(table.column(c).to_pylist() for c in ("key", "a", "b"))):
        values = np.frombuffer(a, "f8")
        if kind == _COUNTS:
            counts[:10] += values
            counts[10] += np.frombuffer(b, "f8").sum() if len(b) == 8 else 0
        elif kind == _HOT_WORDS:
            for name, row in zip(np.frombuffer(key, "u8"), values.reshape(-1, 4)):
                hot[int(name)] = hot.get(int(name), 0) + row
        else:
            pairs += zip(np.frombuffer(key, "u8"), values)
    words_ = sorted(hot)
    pairs.sort()
    told = [
        (_COUNTS, b"", counts.tobytes()),
        (_HOT_WORDS, np.asarray(words_, "u8").tobytes(),
         np.asarray([hot[x] for x in words_], "f8").tobytes()),
        (_HOT_PAIRS, np.asarray([k for k, _ in pairs], "u8").tobytes(),
         np.asarray([c for _, c in pairs], "f8").tobytes()),
    ]
    rows = [(s, -1, kind, key, a, b"") for s in range(shards) for kind, key, a in told]
    return _table(rows, ["shard", "target", "kind", "key", "a", "b"], _ASK_KINDS)


# --- The model --------------------------------------------------------------


def discounts(n: np.ndarray) -> np.ndarray:
    """Discounts of counts 0, 1, 2 and 3 or more, from how many counts are 1, 2, 3 and 4."""
    n1, n2, n3, n4 = (float(x) for x in n)
    if not n1 or not n2:
        return np.asarray([0.0, 0.5, 0.75, 0.75])
    y = n1 / (n1 + 2 * n2)
    found = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.0]
    return np.asarray([0.0, *(min(max(d, 0.05), k - 0.05) for k, d in zip((1, 2, 3), found))])


def mapped(values: np.ndarray) -> np.ndarray:
    """A copy of an array in a mapped anonymous file; the workers' forks share its pages."""
    if not values.nbytes:
        return values
    handle = os.memfd_create("ngrams")
    try:
        os.truncate(handle, values.nbytes)
        view = np.frombuffer(mmap.mmap(handle, values.nbytes), values.dtype)
    finally:
        os.close(handle)
    view[:] = values
    return view


def _look_up(keys: np.ndarray, values: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Values of sorted keys; 0 where a key isn't there."""
    if not len(keys):
        return np.zeros((len(of), *values.shape[1:]), values.dtype)
    at = np.minimum(np.searchsorted(keys, of), len(keys) - 1)
    hit = keys[at] == of
    return np.where(hit.reshape(-1, *[1] * (values.ndim - 1)), values[at], 0)


#: What a shard knows of a block's texts: their places and sums, packed. The cell with the
#: block's ids gives a row of its own.
_PART = (
    "block long, shard long, total long, texts binary, known binary, base binary, score binary, "
    "ids binary, nulls binary, tokens binary"
)
_PART_NAMES = [part.split()[0] for part in _PART.split(", ")]
_PART_TYPES = [pa.int64()] * 3 + [pa.binary()] * 7
_SCORED = (
    "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)


def _scores(table: pa.Table, told: pa.Table, plan: _Plan) -> pa.Table:
    give_back()
    shard, number = _Shard(table), table.column("shard")[0].as_py()
    keys, v, w, c = shard.pairs()
    del table
    common, words_ = {}, []
    for kind, target, key, a, b in zip(
        *(told.column(x).to_pylist() for x in ("kind", "target", "key", "a", "b"))
    ):
        if kind == _WORDS:
            words_.append((target, np.frombuffer(a, "f8"), np.frombuffer(b, "f8")))
        else:
            common[kind] = np.frombuffer(key, "u8"), np.frombuffer(a, "f8")
    counts = common[_COUNTS][1]
    total, known, pair_types = counts[8], counts[9], counts[10]
    d2, d1 = discounts(counts[:4]), discounts(counts[4:8])
    words_.sort(key=lambda x: x[0])
    names = np.unique(w)  # sorted by hash, so by target shard
    count = np.concatenate([x[1] for x in words_]) if words_ else np.zeros(0)
    firsts = np.concatenate([x[2] for x in words_]) if words_ else np.zeros(0)

    # Second words: share of pairs, interpolated with equal shares and one unknown word.
    free = (d1[1] * counts[4] + d1[2] * counts[5]
            + d1[3] * max(0.0, _types(counts) - counts[4] - counts[5]))
    level = np.minimum(firsts, 3).astype("i8")
    if pair_types:
        single = (np.maximum(firsts - d1[level], 0) + free / (known + 1)) / pair_types
    else:
        single = np.full(len(names), 1 / (known + 1))

    # First words: what their pairs leave; hot ones are known from all shards.
    own, sums = _contexts(v[c > 0], c[c > 0])
    hot_words, hot_sums = common[_HOT_WORDS][0], common[_HOT_WORDS][1].reshape(-1, 4)
    cold = ~_among(own, plan.hot_words)
    own, sums = np.concatenate([own[cold], hot_words]), np.concatenate([sums[cold], hot_sums])
    order = np.argsort(own)
    own, sums = mapped(own[order]), sums[order]
    left = mapped((sums[:, 1:] @ d2[1:]) / np.maximum(sums[:, 0], 1))
    totals = mapped(sums[:, 0].copy())

    # Pairs: probabilities, in the order of their keys.
    hot_keys, hot_counts = common[_HOT_PAIRS]
    c = np.where(_among(keys, plan.hot_pairs), _look_up(hot_keys, hot_counts, keys), c)
    total_v, left_v = _look_up(own, totals, v), _look_up(own, left, v)
    at_w = np.searchsorted(names, w)
    discounted = np.maximum(c - d2[np.minimum(c, 3).astype("i8")], 0)
    p = np.where(total_v > 0, discounted / np.maximum(total_v, 1) + left_v * single[at_w], single[at_w])
    del total_v, left_v, discounted, v, w, c
    logs = np.log10(np.maximum(p, 1e-300))
    base = np.log10((count[at_w] + 1) / (total + known + 1))
    index = mapped(keys)
    logs, base, is_known = mapped(logs), mapped(base), mapped((count[at_w] > 0).astype("f8"))

    # Every occurrence: its pair's values, summed by text, cell by cell.
    rows: list[list] = [[] for _ in _PART_NAMES]

    def add(block, texts=(), known=(), base=(), score=(), ids=(), nulls=(), tokens=()):
        for column, value in zip(rows, (
            int(block), number, int(total), np.asarray(texts, "u2").tobytes(),
            np.asarray(known, "u4").tobytes(), np.asarray(base, "f8").tobytes(),
            np.asarray(score, "f8").tobytes(), np.asarray(ids, "i8").tobytes(),
            np.asarray(nulls, "u1").tobytes(), np.asarray(tokens, "u4").tobytes(),
        )):
            column.append(value)

    values = (is_known, base, logs)
    for i, block in enumerate(shard.blocks):
        own, posts = slice(*shard.edges[i : i + 2]), slice(*shard.posted[i : i + 2])
        if posts.start == posts.stop:
            continue
        at = np.searchsorted(index, shard.key[own])
        times, docs = shard.pn[own], shard.docs[posts] >> 1
        here = np.flatnonzero(np.bincount(docs))
        sums = [np.bincount(docs, weights=np.repeat(x[at], times))[here] for x in values]
        add(block, here, np.rint(sums[0]), sums[1], sums[2])
    for block, ids, nulls, tokens in shard.heads:
        add(block, ids=ids, nulls=nulls, tokens=tokens)
    return pa.table([pa.array(c, k) for c, k in zip(rows, _PART_TYPES)], names=_PART_NAMES)


def _added_up(table: pa.Table) -> pa.Table:
    """Scores of a block's texts, from what all shards know of them, in the order of shards.

    A block has at most 30,000 texts and its tokens bound what the shards send.
    """
    table = table.sort_by([("shard", "ascending")])
    columns = {name: table.column(name).to_pylist() for name in _PART_NAMES}
    head = max(range(table.num_rows), key=lambda i: len(columns["ids"][i]))
    ids = np.frombuffer(columns["ids"][head], "i8")
    nulls = np.frombuffer(columns["nulls"][head], "u1").astype(bool)
    tokens = np.frombuffer(columns["tokens"][head], "u4").astype("i8")
    known, base, score = np.zeros(len(ids), "i8"), np.zeros(len(ids)), np.zeros(len(ids))
    for texts, k, b, s in zip(*(columns[c] for c in ("texts", "known", "base", "score"))):
        at = np.frombuffer(texts, "u2")
        known[at] += np.frombuffer(k, "u4")
        base[at] += np.frombuffer(b, "f8")
        score[at] += np.frombuffer(s, "f8")
    return pa.table([
        pa.array(ids, mask=nulls), pa.array(tokens), pa.array(known),
        pa.array(np.full(len(ids), columns["total"][head], "i8")), pa.array(base), pa.array(score),
    ], names=[part.split()[0] for part in _SCORED.split(", ")])


def _types(counts: np.ndarray) -> float:
    """Second words with a training pair; the same as known words, which all follow something."""
    return float(counts[9])


# --- The operator -----------------------------------------------------------


def _hot(docs: DataFrame, shards: int, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Words and pairs that make up more than a shard in a sample: at most ``shards`` of each."""
    n = docs.count()
    place = F.pmod(F.xxhash64("doc_id", F.lit("hot")), F.lit(1 << 30)) / float(1 << 30)
    sample = docs.filter(place < min(1.0, s.sample_docs / max(n, 1)))

    def count(batches):
        for batch in chunks(batches):
            v, w, _ = bigrams(batch)
            for kind, h in enumerate((v, pair_keys(v, w))):
                found, times = np.unique(h, return_counts=True)
                keep = times * 4 * shards >= len(h)  # rarer ones cannot be hot on the whole
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(keep.sum() + 1, kind, "i4")),
                    pa.array(np.concatenate([found[keep].view("i8"), [0]])),
                    pa.array(np.concatenate([times[keep], [0]]).astype("i8")),
                    pa.array(np.concatenate([np.zeros(keep.sum(), "i8"), [len(h)]]).astype("i8")),
                ], names=["kind", "key", "n", "total"])

    counted = sample.mapInArrow(count, "kind int, key long, n long, total long")
    sums = counted.groupBy("kind", "key").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    total = sums.groupBy("kind").agg(F.sum("total").alias("of"))
    hot = sums.join(F.broadcast(total), "kind").filter(F.col("n") * shards > F.col("of"))
    found: tuple[list, list] = ([], [])
    for kind, key in hot.select("kind", "key").collect():
        found[kind].append(key)
    return tuple(np.sort(np.asarray(keys, "i8").view("u8")) for keys in found)


def score(docs: DataFrame, train, s: Settings = Settings()) -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score`` of every row.

    ``train`` is a condition on ``docs``; null counts as false.
    """
    spark = docs.sparkSession
    texts = docs.select("doc_id", "text", F.coalesce(train, F.lit(False)).alias("train"))
    shards = s.shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    plan = _Plan(shards, s.block_tokens, *_hot(texts, shards, s))
    cells = texts.mapInArrow(lambda batches: _cells(batches, plan), _CELL)
    asks = cells.groupBy("shard").applyInArrow(lambda table: _asks(table, plan), _ASK)
    told = asks.groupBy("target").applyInArrow(lambda table: _totals(table, plan), _TOLD)
    common = told.filter("shard < 0").groupBy(F.lit(0).alias("all")).applyInArrow(
        lambda table: _common(table, shards), _TOLD
    )
    answers = told.filter("shard >= 0").unionAll(common)
    parts = cells.groupBy("shard").cogroup(answers.groupBy("shard")).applyInArrow(
        lambda own, told: _scores(own, told, plan) if own.num_rows
        else _table([], _PART_NAMES, _PART_TYPES), _PART
    )
    return parts.groupBy("block").applyInArrow(_added_up, _SCORED)
