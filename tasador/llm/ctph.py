"""Context-triggered piecewise hashing of whole texts.

A rolling hash over the last seven bytes ends a piece wherever it is ``b - 1``
modulo the block size ``b``, so pieces follow the content and an insertion
changes only the pieces around it. The signature is one sign for each piece.
The block size starts as the least of 3, 6, 12, ... with at most ``64 b``
bytes. It is doubled while a signature has more than ``most`` pieces, and else
halved while it has fewer than ``few`` and half as large blocks don't give more
than ``most``. A fingerprint holds the signatures for ``b`` and ``2 b``, so that texts whose
block sizes differ by up to twice can be compared at a common one. Likeness is one less the edit distance of two
signatures (insertions and deletions) as a share of their signs; 0 without a
common block size.

Every sign stands for a piece's bytes to its end. A text that repeats one short
passage may have too many pieces with any block size up to its length; then the
last of ``most`` signs stands for all the rest. So every byte counts and a
comparison is bounded. Equal texts have equal fingerprints.

Defined results: null text is empty, and an empty text has one empty
signature, like that of other empty texts (likeness 1). ``edited_pairs`` takes
documents by descending doc_id, null ids last and equal ids by text; with one
document, the next is the document itself.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_WINDOW = 7
_LEAST = 3
#: Signs of a signature: two of these for each piece.
_SIGNS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"


@dataclass(frozen=True)
class Settings:
    """``pieces``: pieces aimed at, at most. ``few``: pieces below which blocks become
    smaller. ``most``: signs of a signature, at most."""

    pieces: int = 64
    few: int = 16
    most: int = 160


def rolling(data: np.ndarray) -> np.ndarray:
    """Of each byte, a hash of it and the six before it (fewer at the start)."""
    total = np.zeros(len(data), "u4")
    shifted = np.zeros(len(data), "u4")
    for i in range(min(_WINDOW, len(data))):
        part = data[: len(data) - i].astype("u4") + np.uint32(1)
        total[i:] += part * np.uint32(_WINDOW - i + 1)
        shifted[i:] ^= part << np.uint32(5 * i % 32)
    return ((total + shifted) * np.uint32(0x9E3779B1)) >> np.uint32(4)


def _signature(raw: memoryview, ends: np.ndarray, most: int) -> tuple[int, ...]:
    """A number of 12 bits for each piece."""
    cuts = ends[: most - 1].tolist()
    if not cuts or cuts[-1] < len(raw):
        cuts.append(len(raw))
    start, signs = 0, []
    for end in cuts:
        signs.append(zlib.crc32(raw[start:end]) >> 20)
        start = end
    return tuple(signs)


def block_size(n: int, pieces: int) -> int:
    size = _LEAST
    while size * pieces < n:
        size *= 2
    return size


Print = tuple[int, tuple[int, ...], tuple[int, ...]]


def fingerprint(text: bytes, s: Settings = Settings()) -> Print:
    """Block size, and the signatures for it and for twice as much."""
    size = block_size(len(text), s.pieces)
    if not text:
        return size, (), ()
    hashes = rolling(np.frombuffer(text, "u1"))

    def cuts(b: int) -> np.ndarray:
        return np.flatnonzero(hashes % np.uint32(b) == b - 1) + 1

    def pieces(ends: np.ndarray) -> int:
        return len(ends) + (not len(ends) or ends[-1] < len(text))

    ends = cuts(size)
    if pieces(ends) > s.most:
        larger = size
        while pieces(ends) > s.most and larger < len(text):
            larger *= 2
            ends = cuts(larger)
        if pieces(ends) <= s.most:
            size = larger
        else:
            ends = cuts(size)  # no block size avoids it
    else:
        while size > _LEAST and pieces(ends) < s.few and pieces(more := cuts(size // 2)) <= s.most:
            size, ends = size // 2, more
    # What ends a piece of the double size ends one of the single size, too.
    twice = ends[hashes[ends - 1] % np.uint32(2 * size) == 2 * size - 1]
    raw = memoryview(text)
    return size, _signature(raw, ends, s.most), _signature(raw, twice, s.most)


def as_text(found: Print) -> str:
    def signs(signature):
        return "".join(_SIGNS[x >> 6] + _SIGNS[x & 63] for x in signature)

    return f"{found[0]}:{signs(found[1])}:{signs(found[2])}"


def _common(x: tuple[int, ...], y: tuple[int, ...]) -> int:
    """Length of the longest common subsequence, bit-parallel over ``x``."""
    places: dict[int, int] = {}
    for i, sign in enumerate(x):
        places[sign] = places.get(sign, 0) | 1 << i
    full = (1 << len(x)) - 1
    row = full
    for sign in y:
        match = row & places.get(sign, 0)
        if match:
            row = ((row + match) | (row - match)) & full
    return len(x) - row.bit_count()


def _likeness(x: tuple[int, ...], y: tuple[int, ...]) -> float:
    """One less the edit distance, as a share of all signs."""
    return 2 * _common(x, y) / (len(x) + len(y)) if x or y else 1.0


def likeness(x: Print, y: Print) -> float:
    if x == y:
        return 1.0
    if x[0] == y[0]:
        return max(_likeness(x[1], y[1]), _likeness(x[2], y[2]))
    if x[0] == 2 * y[0]:
        return _likeness(x[1], y[2])
    if y[0] == 2 * x[0]:
        return _likeness(x[2], y[1])
    return 0.0


# --- Fingerprints of documents and of their edited texts --------------------


def _edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)
_NAMES = [part.split()[0] for part in _SCHEMA.split(", ")]
_KINDS = [pa.int64(), pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64()]


def _follow(batches: Iterator[pa.RecordBatch], s: Settings) -> Iterator[pa.RecordBatch]:
    """Rows are sorted by part and rank; the last row of a part is only there to follow."""
    before, rows = None, []
    for batch in batches:
        for part, copy, doc_id, text in zip(*(
            batch.column(c).to_pylist() for c in ("part", "copy", "doc_id", "text")
        )):
            text = text or ""
            own = text.encode("utf-8", "surrogatepass")
            found = fingerprint(own, s)
            if before is not None and before[0] == part:
                rows.append(_row(*before[1:], text, found, s))
            before = None if copy else (part, doc_id, text, found)
        yield _batch(rows)
        rows = []


def _row(doc_id, text, found, following, next_found, s):
    edited = _edited(text, following).encode("utf-8", "surrogatepass")
    changed = fingerprint(edited, s)
    return (
        doc_id, len(text), hashlib.sha256(edited).hexdigest(), as_text(found), as_text(changed),
        likeness(found, changed), likeness(found, next_found),
    )


def _batch(rows) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(_NAMES)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, _KINDS)], names=_NAMES
    )


def edited_pairs(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Fingerprints of all texts and of their edited texts, with their likeness.

    The order of the ids is cut into parts, a few for each shuffle partition;
    the first document of a part is also sent to the part before, where it
    follows the last one. So texts are shuffled once, and no task holds more
    than a row and its follower.
    """
    spark = docs.sparkSession
    # Descending ids; null ids come after all others.
    rank = F.coalesce(F.bitwise_not(F.col("doc_id")), F.lit((1 << 63) - 1))
    rows = docs.select("doc_id", "text", rank.alias("rank"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = rows.select(F.percentile_approx(
        F.col("rank").cast("double"), [i / parts for i in range(1, parts)] or [0.5], 10_000
    )).first()[0] or []
    cuts = sorted(set(cuts))
    part = F.lit(0)
    if cuts:
        part = F.array_size(F.filter(
            F.array(*[F.lit(float(c)) for c in cuts]), lambda c: c < F.col("rank").cast("double")
        ))
    tie = F.coalesce(F.sha2(F.col("text"), 256), F.lit(""))
    # The first row of each part: as many rows as parts.
    first = rows.groupBy(part.alias("part")).agg(F.min(F.struct("rank")).alias("first"))
    starts = sorted((r["part"], r["first"]["rank"]) for r in first.collect())
    if not starts:
        return spark.createDataFrame([], _SCHEMA)
    # The last part precedes the first one.
    opening = spark.createDataFrame(
        [(p, start, starts[i - 1][0]) for i, (p, start) in enumerate(starts)],
        "part int, rank long, target int",
    )
    placed = rows.withColumn("part", part).withColumn("tie", tie)
    # Of rows with the first rank only the least by text opens the part.
    heads = placed.join(F.broadcast(opening), ["part", "rank"]).groupBy("target").agg(
        F.min(F.struct("rank", "tie", "doc_id", "text")).alias("head")
    ).select(F.col("target").alias("part"), F.lit(True).alias("copy"), "head.*")
    own = placed.select("part", F.lit(False).alias("copy"), "rank", "tie", "doc_id", "text")
    dealt = own.unionByName(heads).repartition(parts, "part").sortWithinPartitions(
        "part", "copy", "rank", "tie"
    )
    return dealt.select("part", "copy", "doc_id", "text").mapInArrow(
        lambda batches: _follow(batches, s), _SCHEMA
    )
