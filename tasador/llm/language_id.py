"""Language identification with bit-sliced Bloom filters of character n-grams.

Training counts the n-grams of each language and keeps those that are typical
of it. All languages share one Bloom filter whose cells are bit masks, one bit
per language: the AND of an n-gram's cells is the set of languages that
contain it. A text goes to the language with the most n-grams, after the
expected false positives of the language's slice have been taken off.

Defined results: null text, and text without a letter, is ``und`` with score
0. Equal counts go to the first language by name. Training ignores rows
without text or language; without any training row every text is ``und``.
Whole texts are used, also very long ones. Extra columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from tasador.llm.texts import chunks, give_back, mix, powers, signed
from tasador.plans.workspace import materialize

UNKNOWN = "und"

#: Bytes of text worked on at once: a dozen arrays have eight bytes for each sign.
_TOGETHER = 512 << 10


@dataclass(frozen=True)
class Settings:
    """``orders``: n-gram lengths. ``sample_docs``: at most about so many training
    rows of each language are read for the fit. ``least_share``: an n-gram
    belongs to a language if it makes up this share of its n-grams, and
    ``least_ratio`` of the largest share in any language. ``cells``: size of the
    filter, a power of two up to 2**20; ``hashes``: cells for an n-gram, up to 3."""

    orders: tuple[int, ...] = (3, 4)
    sample_docs: int = 4_000
    least_share: float = 1e-5
    least_ratio: float = 0.2
    cells: int = 1 << 18
    hashes: int = 3


@dataclass(frozen=True)
class Model:
    """``masks`` has a row of cells for every 64 languages."""

    languages: tuple[str, ...]
    masks: np.ndarray
    settings: Settings

    def false_positives(self) -> np.ndarray:
        """Chance that an n-gram which isn't in a language seems to be in it."""
        fill = [
            np.mean((self.masks[i // 64] >> np.uint64(i % 64)) & np.uint64(1))
            for i in range(len(self.languages))
        ]
        return np.asarray(fill) ** self.settings.hashes


@cache
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """Of every code point: whether it is a letter, and its lower case."""
    letter, lower = np.zeros(0x110000, bool), np.arange(0x110000, dtype="u4")
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            letter[i] = True
            low = c.lower()
            if len(low) == 1:
                lower[i] = ord(low)
    return letter, lower


def _signs(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Letters in lower case with single gaps around words, and the row of each; texts without a letter have none."""
    letter, lower = _letters()
    sizes = [len(t) if t else 0 for t in texts]
    joined = "".join(t for t in texts if t).encode("utf-32-le", "surrogatepass")
    points = np.frombuffer(joined, "u4")
    rows = np.repeat(np.arange(len(texts)), sizes)
    real = letter[points]
    first = np.ones(len(points), bool)
    first[1:] = rows[1:] != rows[:-1]
    keep = real.copy()
    keep[1:] |= real[:-1] & ~first[1:]  # the gap after a word
    signs = np.where(real, lower[points], 32)[keep].astype("u8")
    rows = rows[keep]
    # A gap also stands before the first word of a text, and after a word at its end.
    starts = np.flatnonzero(np.diff(rows, prepend=-1))
    last = np.flatnonzero(np.diff(rows, append=len(texts)))
    last = last[signs[last] != 32]
    at, of = np.concatenate([last + 1, starts]), rows[np.concatenate([last, starts])]
    return np.insert(signs, at, np.uint64(32)), np.insert(rows, at, of)


def _grams(signs: np.ndarray, rows: np.ndarray, orders: tuple[int, ...]):
    """Yields (order, hashes, row of each)."""
    for order in orders:
        if len(signs) < order:
            continue
        n = len(signs) - order + 1
        h = np.full(n, np.uint64(order))
        for i, p in enumerate(powers(np.uint64(0xD1342543DE82EF95), order + 1)[1:]):
            h += (signs[i : i + n] + np.uint64(1)) * p
        same = rows[:n] == rows[order - 1 :]
        yield order, mix(h[same]), rows[:n][same]


def _count(batches: Iterator[pa.RecordBatch], orders) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches, limit=_TOGETHER):
        langs = batch.column("lang").to_pylist()
        names = sorted(set(langs))
        code = np.asarray([names.index(x) for x in langs])
        for order, h, rows in _grams(*_signs(batch.column("text").to_pylist()), orders):
            for k, name in enumerate(names):
                found, n = np.unique(h[code[rows] == k], return_counts=True)
                yield pa.RecordBatch.from_pydict({
                    "lang": pa.array([name] * len(found), pa.string()),
                    "gram_order": pa.array(np.full(len(found), order, "i4")),
                    "gram": pa.array(signed(found)),
                    "n": pa.array(n.astype("i8")),
                })
    give_back()


def train(labelled: DataFrame, settings: Settings = Settings()) -> Model:
    """Fit on rows with ``doc_id``, ``text`` and ``lang``.

    Rows are taken by a hash of ``doc_id``, so the sample is the same in every
    run. The number of n-grams in the sample is bounded by its size; the model
    has ``cells`` masks.
    """
    spark = labelled.sparkSession
    rows = labelled.select("doc_id", "text", "lang").filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull()
    )
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = tuple(sorted(sizes))
    words = max(1, -(-len(languages) // 64))
    masks = np.zeros((words, settings.cells), "u8")
    if not languages:
        return Model(languages, masks, settings)

    def per_language(values: dict):
        return F.try_element_at(
            F.create_map(*[F.lit(x) for pair in values.items() for x in pair]), F.col("lang")
        )

    share = per_language({k: min(1.0, settings.sample_docs / n) for k, n in sizes.items()})
    place = F.pmod(F.xxhash64("doc_id", F.lit("language")), F.lit(1 << 30)) / float(1 << 30)
    sample = rows.filter(place < share).select("text", "lang")
    orders = settings.orders
    counted = sample.mapInArrow(
        lambda batches: _count(batches, orders), "lang string, gram_order int, gram long, n long"
    ).groupBy("gram", "gram_order", "lang").agg(F.sum("n").alias("n"))
    counted = materialize(counted, "language-grams")
    totals = counted.groupBy("lang", "gram_order").agg(F.sum("n").alias("total"))
    shares = counted.join(F.broadcast(totals), ["lang", "gram_order"]).withColumn(
        "share", F.col("n") / F.col("total")
    ).filter(F.col("share") >= settings.least_share)
    top = shares.groupBy("gram").agg(F.max("share").alias("top"))
    typical = shares.join(top, "gram").filter(F.col("share") >= settings.least_ratio * F.col("top"))
    bit = per_language({name: i for i, name in enumerate(languages)})
    cells = F.array(*[
        F.shiftrightunsigned("gram", 21 * j).bitwiseAND(settings.cells - 1)
        for j in range(settings.hashes)
    ])
    filled = typical.select(F.explode(cells).alias("cell"), bit.alias("bit")).groupBy(
        "cell", F.floor(F.col("bit") / 64).alias("word")
    ).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit") % 64)).alias("mask"))
    # At most one row for each cell and 64 languages: bounded by the settings.
    for cell, word, mask in filled.collect():
        masks[word, cell] = np.uint64(mask & 0xFFFFFFFFFFFFFFFF)
    return Model(languages, masks, settings)


def _scores(texts: list[str | None], model: Model, expected: np.ndarray):
    """Of each text: n-grams of every language, all n-grams, and whether it has a letter."""
    n, langs = len(texts), len(model.languages)
    hits, total, lettered = np.zeros((n, langs)), np.zeros(n), np.zeros(n, bool)
    signs, of = _signs(texts)
    lettered[of] = True
    last = np.uint64(model.settings.cells - 1)
    for _, h, rows in _grams(signs, of, model.settings.orders):
        if not len(rows):
            continue
        starts = np.flatnonzero(np.diff(rows, prepend=-1))
        here = rows[starts]
        total[here] += np.diff(starts, append=len(rows))
        cells = [(h >> np.uint64(21 * j)) & last for j in range(model.settings.hashes)]
        for word in range(len(model.masks)):
            found = model.masks[word][cells[0]]
            for c in cells[1:]:
                found &= model.masks[word][c]
            for i in range(64 * word, min(langs, 64 * word + 64)):
                has = (found >> np.uint64(i % 64)) & np.uint64(1)
                hits[here, i] += np.add.reduceat(has, starts)
    rest = np.maximum(1e-12, 1 - expected)
    true = np.clip((hits - total[:, None] * expected) / rest, 0, total[:, None])
    return true, total, lettered


def _predict(batches: Iterator[pa.RecordBatch], model: Model, names) -> Iterator[pa.RecordBatch]:
    expected = model.false_positives()
    for batch in chunks(batches, limit=_TOGETHER):
        texts = batch.column("text").to_pylist()
        pred, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
        covered = np.zeros(len(texts))
        if model.languages:
            true, total, lettered = _scores(texts, model, expected)
            best = true.argmax(axis=1)
            top = true[np.arange(len(texts)), best]
            score = np.where(total > 0, top / np.maximum(true.sum(axis=1), 1e-9), 0.0)
            covered = top / np.maximum(total, 1)
            pred = [model.languages[b] if has else UNKNOWN for b, has in zip(best, lettered)]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(pred, pa.string()), pa.array(np.clip(score, 0.0, 1.0)),
             pa.array(np.clip(covered, 0.0, 1.0))], names=names,
        )
    give_back()


def identify(docs: DataFrame, model: Model, prefix: str = "") -> DataFrame:
    """Add ``lang_pred``, ``score`` (share of the winner among all languages' n-grams)
    and ``covered`` (share of the text's n-grams that the winner contains)."""
    added = [f"{prefix}lang_pred", f"{prefix}score", f"{prefix}covered"]
    docs = docs.drop(*added)
    schema = StructType([
        *docs.schema.fields, StructField(added[0], StringType()),
        StructField(added[1], DoubleType()), StructField(added[2], DoubleType()),
    ])
    names = schema.fieldNames()
    return docs.mapInArrow(lambda batches: _predict(batches, model, names), schema)


def fold(modulus: int):
    """crc32 of the id's text, as a remainder."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus
