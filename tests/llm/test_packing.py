import tracemalloc
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import pyarrow as pa
from tasador.llm import packing as P


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids_of(reference, text):
    return reference.encode(text or "", add_special_tokens=False).ids + [1]


ODD = ["", "  two  spaces", " lead", "trail ", "a\n b", "x \ny", "<|endoftext|> hi", "foo\tbar\r\nqux",
       "a b c", "a  b", "1234 5678'll don't", "日本語 テスト", None, "x\x0b y", "a\x1c b",
       "a\x85 b", "\n", "naïve café"]


def test_ids_equal_the_tokenizer(reference, corpus):
    s = P.public_settings()
    texts = ODD + [r[1] for r in corpus]
    ids, starts = P.encode(pa.array(texts, pa.string()), s)
    for text, a, b in zip(texts, starts[:-1], starts[1:]):
        assert ids[a:b].tolist() == ids_of(reference, text)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(" ab\n\té .1'", max_size=30), min_size=1, max_size=8))
def test_ids_of_random_texts(reference, texts):
    ids, starts = P.encode(pa.array(texts, pa.string()), P.public_settings())
    for text, a, b in zip(texts, starts[:-1], starts[1:]):
        assert ids[a:b].tolist() == ids_of(reference, text)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 32), max_size=60))
def test_packing_is_a_partition_without_padding(lengths):
    sequences = P.pack(lengths, (4, 8, 16, 32))
    covered = defaultdict(list)
    for pieces in sequences:
        size = sum(p[2] for p in pieces)
        assert size & (size - 1) == 0 and size <= 32
        for i, start, n in pieces:
            covered[i].append((start, n))
    assert sorted(covered) == list(range(len(lengths)))
    for i, n in enumerate(lengths):
        at = 0
        for start, size in sorted(covered[i]):
            assert start == at and size > 0
            at += size
        assert at == n


def test_whole_tables(docs, no_docs, corpus, reference):
    s = P.public_settings(group_tokens=20_000, step_tokens=8_192)
    rows = P.pack_documents(docs, s).collect()
    texts = defaultdict(list)
    for r in corpus:
        texts[r[0]].append(r[1])
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    assert set(by_doc) == set(texts)
    for doc_id, pieces in by_doc.items():
        ids = ids_of(reference, texts[doc_id][0])
        assert sum(p["length"] for p in pieces) == len(ids) * len(texts[doc_id])
        for p in pieces:
            own = np.asarray(ids[p["start"] : p["start"] + p["length"]], "<u4")
            assert p["ids_crc32"] == zlib.crc32(own.tobytes()) and p["doc_tokens"] == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at == pieces[0]["sequence_length"] <= 2048 and at & (at - 1) == 0
    assert P.pack_documents(no_docs, s).count() == 0


def test_step_groups_are_balanced():
    sizes = [2048] * 64 + [1024] * 30 + [512] * 17
    groups = P.step_groups(sizes, 16_384)
    sums = np.bincount(groups, weights=sizes)
    assert sums.max() - sums.min() <= 2048


def test_memory_of_a_batch_is_bounded(monkeypatch):
    """8 MB of text in one batch: the arrays of ids are made for a part of it at a time."""
    rng = np.random.default_rng(5)
    word = np.char.mod("w%d", rng.integers(0, 30_000, 400_000))
    text = " ".join(word.tolist())
    rows = [text[i : i + 2_000] for i in range(0, len(text), 2_000)] * 4
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(len(rows)), pa.int64()), pa.array(rows, pa.string())], names=["doc_id", "text"]
    )
    assert sum(map(len, rows)) > 8 << 20
    monkeypatch.setattr(P.TaskContext, "get", classmethod(lambda cls: type("T", (), {"partitionId": lambda self: 0})()))
    s = P.public_settings()
    P.encode(batch.column("text").slice(0, 1), s)
    tracemalloc.start()
    packed = sum(sum(b.column("length").to_pylist()) for b in P._pack_rows(iter([batch]), s))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert packed == sum(len(ids) for ids in map(P._encoder(s).encode_ordinary, rows)) + len(rows)
    assert peak < 64 << 20, peak >> 20
