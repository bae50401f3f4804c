import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tasador.llm import components, minhash
from tasador.llm import texts as T
from tasador.llm.texts import mix

from .conftest import DOC_SCHEMA, lower_words, prose


def shingles(text):
    w = lower_words(text)
    return ({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)}) if w else set()


def brute(rows):
    sets = {}
    for doc_id, text in rows:
        sets.setdefault(doc_id, shingles(text))
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 85 * len(x | y):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {i: (len(sets[i]), root(i)) for i in ids}


@pytest.mark.parametrize("direct", [8, 1])
def test_equals_brute_force(docs, corpus, direct):
    found = minhash.near_duplicates(docs, minhash.Settings(direct=direct)).collect()
    expected = brute([r[:2] for r in corpus])
    assert len(found) == len(corpus)
    for r in found:
        assert (r["n_shingles"], r["component_id"]) == expected[r["doc_id"]]
        assert r["kept"] == (r["doc_id"] == r["component_id"])


def test_odd_rows(spark, no_docs, odd_columns, corpus):
    assert minhash.near_duplicates(no_docs).count() == 0
    assert minhash.near_duplicates(odd_columns).count() == len(corpus)
    rows = spark.createDataFrame(
        [(None, "a b c d e f", None, None, None), (3, "a b c d e f", None, None, None),
         (None, None, None, None, None), (4, "", None, None, None)], DOC_SCHEMA)
    found = minhash.near_duplicates(rows).collect()
    assert all(r["kept"] for r in found)
    assert sorted((r["doc_id"] or -1, r["n_shingles"]) for r in found) == [
        (-1, 0), (-1, 2), (3, 2), (4, 0)]


def test_one_row_of_each_group_stays(docs, odd_columns, corpus):
    kept = minhash.without_near_duplicates(odd_columns)
    assert kept.columns == odd_columns.columns
    expected = brute([r[:2] for r in corpus])
    ids = [r["doc_id"] for r in kept.select("doc_id").collect()]
    assert sorted(ids) == sorted(i for i, (_, c) in expected.items() if i == c)


def test_sketches_fill_and_agree_like_the_sets():
    rng = np.random.default_rng(1)
    size = 2_000
    both = mix(rng.integers(1, 1 << 60, 600).astype("u8"))
    x = np.concatenate([both, mix(rng.integers(1, 1 << 60, 200).astype("u8"))])
    y = np.concatenate([both, mix(rng.integers(1, 1 << 60, 200).astype("u8"))])
    rows = np.repeat([0, 1, 2], [len(x), len(y), 1])
    cells = minhash.sketch(np.concatenate([x, y, both[:1]]), rows, 4, size)
    assert (cells[:3] != np.iinfo("u8").max).all() and (cells[3] == np.iinfo("u8").max).all()
    assert abs((cells[0] == cells[1]).mean() - 0.6) < 0.05


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    found = components.components(spark.createDataFrame(links, "a long, b long"))
    expected = {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)}
    assert {r["id"]: r["component"] for r in found.collect()} == expected
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_no_pairs_within_a_large_group(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = spark.range(400).select(
        F.col("id").alias("doc_id"),
        F.concat(F.lit(text), F.lit(" x"), F.col("id").cast("string")).alias("text"))
    _, links = minhash.near_links(rows)
    assert links.count() < 2_000
    assert minhash.near_duplicates(rows).filter("kept").count() == 1


def edited(n, seed, changes=(2, 7), words=200, shared=0):
    """Copies of one text with words of their own; ``shared`` words are the same in all but the first."""
    rng = np.random.default_rng(seed)
    base = [f"w{i}" for i in range(words)]
    rows = [(0, " ".join(base))]
    for i in range(1, n):
        own = base + [f"s{k}" for k in range(shared)]
        for at in rng.choice(words, int(rng.integers(changes[0], changes[1] + 1)), replace=False):
            own[at] = f"x{rng.integers(0, 3_000)}"
        rows.append((i, " ".join(own)))
    return rows


@pytest.mark.parametrize("shared, percent", [(0, 85), (0, 80), (40, 85)])
def test_no_link_is_lost_in_a_large_group(spark, shared, percent):
    """Components of 600 near copies, many just at the threshold, against all pairs."""
    rows = edited(600, 1, shared=shared)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = 0
    for i, x in enumerate(sets):
        for j in range(i):
            same = len(x & sets[j])
            if 100 * same >= percent * (len(x) + len(sets[j]) - same):
                low, high = sorted((root(i), root(j)))
                parent[high], links = low, links + 1
    found = minhash.near_duplicates(docs, minhash.Settings(percent=percent)).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == {i: root(i) for i in range(len(rows))}
    assert links > 100 and len({root(i) for i in range(len(rows))}) > 10


def test_candidates_grow_with_the_group(spark, monkeypatch):
    """Four times as many near copies give about four times as many candidates."""
    counts = []
    whole = minhash._candidates
    monkeypatch.setattr(minhash, "_candidates", lambda rest, s: _counted(whole(rest, s), counts))

    def _counted(pairs, out):
        out.append(pairs.count())
        return pairs

    for n in (400, 1_600):
        minhash.near_duplicates(spark.createDataFrame(edited(n, 2), "doc_id long, text string")).count()
    small, large = counts
    assert large < 8 * max(small, 400) and large < 1_600 * 1_599 / 2 / 50


def test_memory_of_a_batch_is_bounded():
    """4 MB of text in one batch, in parts: signatures of single rows, and few powers kept."""
    rng = np.random.default_rng(6)
    texts = [prose("de", 150, rng) for _ in range(20)] * 250
    settings = minhash.Settings()

    def signed_rows(rows):
        batch = pa.RecordBatch.from_arrays(
            [pa.array(range(len(rows)), pa.int64()), pa.array(rows, pa.string())], names=["doc_id", "text"]
        )
        return [
            {k: v for k, v in r.items() if k != "doc_id"}
            for b in minhash._signatures(iter([batch]), settings) for r in b.to_pylist()
        ]

    T._powers.clear()
    single = [signed_rows([t])[0] for t in texts[:20]]
    assert sum(p.nbytes for p in T._powers.values()) <= 2 << 20
    tracemalloc.start()
    found = signed_rows(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == single * 250
    assert peak < 64 << 20, peak >> 20
