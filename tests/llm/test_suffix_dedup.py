import hashlib

import numpy as np
import pytest

from tasador.llm import suffix_dedup as S

from .conftest import DOC_SCHEMA


def brute(rows, length=100):
    seen, out = set(), []
    for doc_id, text in rows:
        raw = (text or "").encode()
        covered = np.zeros(len(raw) + 1, int)
        for i in range(len(raw) - length + 1):
            w = raw[i : i + length]
            if w in seen:
                covered[i] += 1
                covered[i + length] -= 1
            seen.add(w)
        gone = np.cumsum(covered)[:-1] > 0
        kept = bytes(np.frombuffer(raw, "u1")[~gone])
        spans = int(np.sum(gone & ~np.concatenate([[False], gone[:-1]]))) if len(raw) else 0
        out.append((doc_id, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def result(table, s=S.Settings()):
    return sorted(tuple(r) for r in S.remove_repeats(table, s).collect())


@pytest.mark.parametrize("s", [
    S.Settings(), S.Settings(hot_pieces=1), S.Settings(batch_bytes=3_000), S.Settings(length=40, gram=16),
])
def test_equals_brute_force(docs, corpus, s):
    rows = sorted((r[:2] for r in corpus), key=lambda r: r[0])
    assert result(docs, s) == brute(rows, s.length)


def test_odd_tables(spark, no_docs, odd_columns, corpus):
    assert result(no_docs) == []
    assert len(result(odd_columns)) == len(corpus)
    text = "ab" * 90 + "é" * 80
    table = spark.createDataFrame([(2, text, "", "", 1), (None, text, "", "", 1), (1, None, "", "", 1),
                                   (3, "a" * 100, "", "", 1), (4, "a" * 300, "", "", 1)], DOC_SCHEMA)
    found = {r[0]: r for r in S.remove_repeats(table).collect()}
    assert found[None]["n_removed"] == len(text.encode())
    assert found[3]["n_removed"] == 0 and found[4]["n_removed"] == 300 and found[4]["n_spans"] == 1


def test_bytes_left(docs):
    row = S.remove_repeats(docs, keep_bytes=True).filter("doc_id = 157").first()
    assert hashlib.sha256(row["kept"]).hexdigest() == row["kept_sha256"]
    assert len(row["kept"]) == row["n_bytes"] - row["n_removed"]


def test_suffix_array_and_common_prefixes():
    rng = np.random.default_rng(0)
    raw = [bytes(rng.integers(97, 99, int(n)).astype("u1")) for n in rng.integers(1, 60, 30)]
    data = np.frombuffer(b"".join(raw), "u1")
    sizes = np.asarray([len(x) for x in raw])
    ends = np.repeat(np.cumsum(sizes), sizes)
    order, _ = S.suffix_array(data, ends, 100)
    whole = data.tobytes()
    suffixes = [whole[i : ends[i]] for i in order]
    assert suffixes == sorted(suffixes)
    shared = S.common_prefixes(data, ends, order, 100)
    for a, b, n in zip(suffixes, suffixes[1:], shared):
        expected = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert n == expected
