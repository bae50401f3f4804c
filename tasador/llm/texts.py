"""Texts of an Arrow batch as flat numpy arrays, and 64-bit hashes of their words."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text worked on at once. Arrays of eight bytes per byte stay small.
CHUNK_BYTES = 2 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: dict[int, np.ndarray] = {}


def chunks(
    batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = CHUNK_BYTES
) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``limit`` bytes of text; a longer text is one slice."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(size.to_numpy(zero_copy_only=False).astype("i8"))
        start = 0
        while start < batch.num_rows:
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def give_back() -> None:
    """Return freed memory to the system; a worker that is used again keeps it otherwise."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes, and where each text starts (one more entry at the end). Null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    _, offsets, data = texts.buffers()
    starts = np.frombuffer(offsets, "i8")[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, "u1") if data is not None else np.zeros(0, "u1")
    return raw[starts[0] : starts[-1]], starts - starts[0]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose results look random."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def powers(base: np.uint64, n: int) -> np.ndarray:
    """``base`` to the power 0 .. n-1, modulo 2 to the 64."""
    known = _powers.get(int(base))
    if known is None or len(known) < n:
        # As many as are asked for, and some more: a worker keeps them.
        row = np.full(max(n + n // 8, 1 << 16), base, "u8")
        row[0] = 1
        known = np.cumprod(row, dtype="u8")
        if len(known) <= 8 * CHUNK_BYTES:
            _powers[int(base)] = known
    return known[:n]


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Polynomial prefix sums; ``span_hashes`` takes hashes of any span from them."""
    sums = np.zeros(len(data) + 1, "u8")
    np.cumsum((data.astype("u8") + np.uint64(1)) * powers(_BASE, len(data)), out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of ``data[start:end]``; equal bytes give equal hashes wherever they stand."""
    return mix((sums[ends] - sums[starts]) * powers(_INVERSE, len(sums))[starts])


def words(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (A-Z in lower case, between white space) and the row of each.

    White space is the six ASCII characters 0x20 and 0x09 to 0x0D.
    """
    if not len(data):
        return np.zeros(0, "u8"), np.zeros(0, "i8")
    lower = np.where((data >= 65) & (data <= 90), data | np.uint8(32), data)
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    first = np.zeros(len(data) + 1, bool)
    first[starts] = True
    opens = inside.copy()
    opens[1:] &= ~inside[:-1] | first[1:-1]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:] | first[1:-1]
    begin, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    rows = np.searchsorted(starts, begin, "right") - 1
    return span_hashes(prefix_hashes(lower), begin, end), rows


def row_starts(rows: np.ndarray, n: int) -> np.ndarray:
    """Where each of ``n`` rows starts in a sorted array of row numbers."""
    return np.searchsorted(rows, np.arange(n + 1))


def signed(h: np.ndarray) -> np.ndarray:
    return h.view("i8")
