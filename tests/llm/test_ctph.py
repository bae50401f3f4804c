import hashlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tasador.llm import ctph as C

from .conftest import DOC_SCHEMA, prose


def lcs(x, y):
    row = [0] * (len(y) + 1)
    for a in x:
        before = 0
        for j, b in enumerate(y):
            before, row[j + 1] = row[j + 1], before + 1 if a == b else max(row[j], row[j + 1])
    return row[-1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=70), st.lists(st.integers(0, 5), max_size=70))
def test_edit_distance_equals_the_table(x, y):
    assert C._common(tuple(x), tuple(y)) == lcs(x, y)


def test_rolling_hash_depends_on_seven_bytes_only():
    rng = np.random.default_rng(0)
    a, b = rng.integers(0, 256, 100).astype("u1"), rng.integers(0, 256, 300).astype("u1")
    joined = C.rolling(np.concatenate([b, a]))
    assert (joined[-94:] == C.rolling(a)[6:]).all()


def test_likeness_of_edits():
    rng = np.random.default_rng(4)
    text = prose("en", 900, rng)
    found = C.fingerprint(text.encode())
    assert C.likeness(found, C.fingerprint(text.encode())) == 1.0
    inserted = text[:2_000] + " some new words " + text[2_000:]
    assert C.likeness(found, C.fingerprint(inserted.encode())) > 0.8
    other = C.fingerprint(prose("en", 900, rng).encode())
    assert C.likeness(found, other) < 0.1
    assert C.likeness(C.fingerprint(b""), C.fingerprint(b"")) == 1.0
    assert C.likeness(found, C.fingerprint(b"x" * 5)) == 0.0
    # The last byte counts, also of a text with more pieces than signs.
    long = (text * 40).encode()
    assert C.as_text(C.fingerprint(long)) != C.as_text(C.fingerprint(long[:-1] + b"#"))


def test_whole_tables(spark, docs, no_docs, odd_columns, corpus):
    rows = sorted(corpus, key=lambda r: -r[0])
    found = C.edited_pairs(docs).collect()
    assert len(found) == len(corpus)
    by_id = {}
    for r in found:
        by_id.setdefault(r["doc_id"], []).append(r)
    texts = [r[1] or "" for r in rows]
    for i, (doc_id, *_) in enumerate(rows):
        half = len(texts[i]) // 2
        edited = texts[i][: len(texts[i]) - half] + texts[(i + 1) % len(texts)][:half]
        r = next(x for x in by_id[doc_id] if x["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest())
        own = C.fingerprint(texts[i].encode())
        assert r["n_chars"] == len(texts[i]) and r["fingerprint"] == C.as_text(own)
        assert r["near_edited"] == C.likeness(own, C.fingerprint(edited.encode()))
        assert r["near_next"] == C.likeness(own, C.fingerprint(texts[(i + 1) % len(texts)].encode()))
    assert C.edited_pairs(no_docs).count() == 0
    assert C.edited_pairs(odd_columns).count() == len(corpus)
    one = spark.createDataFrame([(None, "abcd", "", "", 1)], DOC_SCHEMA)
    assert C.edited_pairs(one).first()["edited_sha256"] == hashlib.sha256(b"abab").hexdigest()


def test_block_size_follows_the_pieces():
    s = C.Settings()
    rng = np.random.default_rng(5)
    # The cuts of a repeated line are as dense as those of the line.
    many = few = 0
    for _ in range(300):
        line = prose("en", 6, rng).encode() + b" "
        text = line * (6_000 // len(line))
        first = C.block_size(len(text), s.pieces)
        hashes = C.rolling(np.frombuffer(text, "u1"))
        counts = {b: int((hashes % b == b - 1).sum()) + 1 for b in (first // 2, first, *(first << i for i in range(1, 8)))}
        found = C.fingerprint(text)
        if counts[first] > s.most + 1 and min(counts.values()) < s.most:
            many += 1
            assert found[0] > first and len(found[1]) <= s.most
            changed = text[: len(text) // 2] + prose("de", 900, rng).encode()[: len(text) // 2]
            assert C.likeness(found, C.fingerprint(changed)) < 0.9
        elif counts[first] < s.few and counts[first // 2] < s.most:
            few += 1
            assert found[0] < first
    assert many > 3 and few > 3
