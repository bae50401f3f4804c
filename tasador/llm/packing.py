"""Hierarchical packing of tokenised documents into sequences of several lengths.

A document is its token ids and one end id. Full windows of the longest length
are cut off and are sequences of their own. The rest of a document is routed
to the tier of the shortest window that holds it. Tiers are packed from long to
short: a window takes its document and fills the gap with the largest rests
that fit, of shorter tiers first of all since longer ones are used up; what is
then left of the gap is filled by cutting a rest. Windows have power-of-two
lengths and are filled exactly, so there is nothing to pad; the last window of
a group is cut into powers of two. The sequences of a group are dealt to step
groups of equal size, largest first, in a snake order.

A task packs its own rows in groups of bounded size, so nothing is shuffled
and memory doesn't grow with the input. Sequence numbers carry the partition's
number. Every id lies in exactly one piece.

Defined results: a null or empty text is its end id alone; rows with equal
doc_id are packed row by row; an empty table gives no piece. Extra columns are
not used.
"""

from __future__ import annotations

import base64
import bisect
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tasador.llm.texts import chunks, give_back


@dataclass(frozen=True)
class Settings:
    """``tiers``: window lengths, powers of two. ``group_tokens``: tokens of rests that
    are packed together. ``step_tokens``: about the size of a step group."""

    vocabulary: str
    pattern: str
    specials: tuple[tuple[str, int], ...] = (("<|endoftext|>", 50256),)
    end: int = 1
    tiers: tuple[int, ...] = (256, 512, 1024, 2048)
    group_tokens: int = 1 << 20
    step_tokens: int = 1 << 17


def public_settings(**changes) -> Settings:
    """With the public byte-level vocabulary of 50,257 ids."""
    import public_tokenizers

    return Settings(
        str(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN, **changes
    )


@cache
def _encoder(s: Settings):
    import tiktoken

    with open(s.vocabulary, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=s.pattern, mergeable_ranks=ranks,
                             special_tokens=dict(s.specials))


#: A single space between signs that aren't white space always begins a new
#: piece of the vocabulary's pattern, so such texts are encoded word by word.
_IRREGULAR = r"(^ )|( $)|( [\s\pZ\x{85}\x0b\x1c-\x1f])|([\s\pZ\x{85}\x0b\x1c-\x1f] )"
#: Bytes of text that share a vocabulary of distinct words; arrays of ids grow with it.
_TOGETHER = 1 << 20


@cache
def _begins_with_space(s: Settings) -> np.ndarray:
    encoder = _encoder(s)
    found = np.zeros(encoder.n_vocab, bool)
    for token in encoder.token_byte_values():
        if token[:1] == b" ":
            found[encoder.encode_single_token(token)] = True
    return found


def encode(texts: pa.Array, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts with their end ids, and where each text starts (and ends).

    Distinct words of the batch are encoded once.
    """
    encoder, n = _encoder(s), len(texts)
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    special = pc.match_substring_regex(texts, _IRREGULAR)
    for name, _ in s.specials:
        special = pc.or_(special, pc.match_substring(texts, name))
    whole = special.to_numpy(zero_copy_only=False)
    lists = pc.split_pattern(pc.if_else(special, "", texts), " ")
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    offsets = lists.offsets.to_numpy()
    coded = lists.flatten().dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    offsets = offsets - offsets[0]
    vocabulary = coded.dictionary
    real = pc.greater(pc.binary_length(vocabulary), 0).to_numpy(zero_copy_only=False)
    # One call for all distinct words: a word begins at every id that begins with a space.
    listed = vocabulary.filter(pa.array(real))
    together = pa.ListArray.from_arrays(pa.array([0, len(listed)], pa.int32()), listed)
    words = pc.binary_join(together, pa.scalar(" ", pa.large_string()))[0].as_py()
    flat = np.asarray(encoder.encode_ordinary(" " + words) if words else [], "u4")
    sizes = np.zeros(len(vocabulary), "i8")
    begin = np.flatnonzero(_begins_with_space(s)[flat])
    sizes[real] = np.diff(begin, append=len(flat))
    codes = coded.indices.to_numpy().astype("i8")
    first = offsets[:-1]
    opening = vocabulary.take(pa.array(codes[first])).to_pylist() if n else []
    # The first word of a text has no space; irregular texts are one word.
    codes[first] = len(sizes) + np.arange(n)
    names = {name for name, _ in s.specials}
    own = [
        encoder.encode(texts[i].as_py(), allowed_special=names) if whole[i]
        else encoder.encode_ordinary(word) for i, word in enumerate(opening)
    ] + [[s.end]]
    ids = np.concatenate([flat, *[np.asarray(x, "u4") for x in own]])
    sizes = np.concatenate([sizes, [len(x) for x in own]]).astype("i8")
    # The end id follows every text's words.
    codes = np.insert(codes, offsets[1:], len(sizes) - 1)
    starts = offsets + np.arange(n + 1)
    places = np.cumsum(sizes) - sizes
    length = sizes[codes]
    ends = np.cumsum(length)
    total = int(length.sum())
    # Four bytes for each place, unless one text alone is longer than they count.
    kind = "i4" if max(total, len(ids)) < 1 << 31 else "i8"
    at = np.repeat((places[codes] - (ends - length)).astype(kind), length)
    at += np.arange(total, dtype=kind)
    return ids[at], np.concatenate([[0], ends])[starts]


class Rests:
    """Rests by length; a list of places for each length in use."""

    def __init__(self):
        self.lengths: list[int] = []
        self.places: dict[int, list] = {}

    def add(self, length: int, item) -> None:
        if length not in self.places:
            bisect.insort(self.lengths, length)
            self.places[length] = []
        self.places[length].append(item)

    def _take(self, i: int):
        length = self.lengths[i]
        items = self.places[length]
        item = items.pop()
        if not items:
            del self.places[length], self.lengths[i]
        return length, item

    def largest(self, most: int | None = None):
        """The longest rest, of at most ``most`` ids; None if there is none."""
        i = len(self.lengths) if most is None else bisect.bisect_right(self.lengths, most)
        return self._take(i - 1) if i else None

    def least_over(self, length: int):
        i = bisect.bisect_right(self.lengths, length)
        return self._take(i) if i < len(self.lengths) else None


def pack(lengths: list[int], tiers: tuple[int, ...]) -> list[list[tuple[int, int, int]]]:
    """Sequences of pieces (rest, start in it, length) for rests up to the longest tier."""
    rests = Rests()
    for i, length in enumerate(lengths):
        rests.add(length, (i, 0))
    sequences = []
    while (found := rests.largest()) is not None:
        length, (i, start) = found
        window = tiers[bisect.bisect_left(tiers, length)]
        pieces, gap = [(i, start, length)], window - length
        while gap and (found := rests.largest(gap)) is not None:
            length, (i, start) = found
            pieces.append((i, start, length))
            gap -= length
        if gap and (found := rests.least_over(gap)) is not None:
            length, (i, start) = found
            pieces.append((i, start, gap))
            rests.add(length - gap, (i, start + gap))
            gap = 0
        if not gap:
            sequences.append(pieces)
            continue
        # Nothing is left to fill this window: cut it into powers of two.
        todo = sum(p[2] for p in pieces)
        room, own = 1 << (todo.bit_length() - 1), []
        for i, start, length in pieces:
            while length:
                part = min(length, room)
                own.append((i, start, part))
                start, length, room, todo = start + part, length - part, room - part, todo - part
                if not room:
                    sequences.append(own)
                    room, own = (1 << (todo.bit_length() - 1)) if todo else 0, []
    return sequences


def step_groups(sizes: list[int], step_tokens: int) -> list[int]:
    """A step group for every sequence: largest first, dealt to and fro."""
    groups = max(1, sum(sizes) // step_tokens)
    found = [0] * len(sizes)
    for at, i in enumerate(sorted(range(len(sizes)), key=lambda i: -sizes[i])):
        turn, place = divmod(at, groups)
        found[i] = place if turn % 2 == 0 else groups - 1 - place
    return found


SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
    "offset long, sequence_length long, step_group long"
)
_NAMES = [part.split()[0] for part in SCHEMA.split(", ")]


class _Pieces:
    """Packs the rests of one task, group by group."""

    def __init__(self, s: Settings, partition: int):
        self.s, self.base = s, partition << 36
        self.sequence = self.step = 0
        self.rests, self.tokens, self.rows = [], 0, []

    def _sequence(self, pieces, size, group) -> None:
        offset = 0
        for doc_id, doc_tokens, start, ids in pieces:
            self.rows.append((
                doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), doc_tokens,
                self.base + self.sequence, offset, size, self.base + group,
            ))
            offset += len(ids)
        self.sequence += 1

    def document(self, doc_id, ids) -> None:
        longest, n = self.s.tiers[-1], len(ids)
        full = n - n % longest
        for start in range(0, full, longest):
            self.rests.append((doc_id, n, start, ids[start : start + longest]))
        if full < n:
            self.rests.append((doc_id, n, full, ids[full:].copy()))
        self.tokens += n

    def pack(self) -> None:
        if not self.rests:
            return
        sequences = pack([len(r[3]) for r in self.rests], self.s.tiers)
        sizes = [sum(p[2] for p in pieces) for pieces in sequences]
        groups = step_groups(sizes, self.s.step_tokens)
        for pieces, size, group in zip(sequences, sizes, groups):
            self._sequence([
                (*self.rests[i][:2], self.rests[i][2] + a, self.rests[i][3][a : a + n])
                for i, a, n in pieces
            ], size, self.step + group)
        self.step += max(groups) + 1
        self.rests, self.tokens = [], 0

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) or [()] * len(_NAMES)
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=_NAMES)


def _pack_rows(batches: Iterator[pa.RecordBatch], s: Settings) -> Iterator[pa.RecordBatch]:
    own = _Pieces(s, TaskContext.get().partitionId())
    for batch in chunks(batches, limit=_TOGETHER):
        ids, starts = encode(batch.column("text"), s)
        for doc_id, a, b in zip(batch.column("doc_id").to_pylist(), starts[:-1], starts[1:]):
            own.document(doc_id, ids[a:b])
            if own.tokens >= s.group_tokens:
                own.pack()
                yield own.batch()
        # The next text's arrays are made before these names take them.
        del ids, starts
    own.pack()
    yield own.batch()
    # The worker is used again; what it has freed goes back to the executor.
    give_back()


def pack_documents(docs: DataFrame, s: Settings) -> DataFrame:
    """A row for every piece; see the contract of ``SCHEMA``'s columns in the README."""
    return docs.select("doc_id", "text").mapInArrow(lambda batches: _pack_rows(batches, s), SCHEMA)
