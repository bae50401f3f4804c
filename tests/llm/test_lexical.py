import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tasador.llm import lexical as L, queries

from .conftest import DOC_SCHEMA, prose

SMALL = L.Settings(leaf=8, block_rows=40, sample=50, set_terms=100_000)


def terms_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def plain(docs, items, k=10):
    """Scores of all documents for all items, with Python integers."""
    bags = [(i, Counter(terms_of(t))) for i, t in docs]
    bags = [(i, b, sum(b.values())) for i, b in bags if b]
    n, total = len(bags), sum(s for _, _, s in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(terms_of(text))
    out = {}
    for item, words in wanted.items():
        scores = []
        for doc, bag, size in bags:
            m = 10 + 90 * size * n // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                * (1_000_000_000 * bag[t] // (1000 * bag[t] + 8 * m)) for t in words if t in bag)
            if score > 0:
                scores.append((-score, doc is None, doc))
        best = sorted(scores)[:k]
        if best:
            out[item] = [(d, -s) for s, _, d in best]
    return out


def answers(frame):
    out = {}
    for r in sorted(frame.collect(), key=lambda r: r["rank"]):
        own = out.setdefault(r["item_id"], [])
        assert r["rank"] == len(own) + 1
        own.append((r["doc_id"], r["score"]))
    return out


@pytest.fixture(scope="module")
def items(corpus):
    rng = np.random.default_rng(8)
    rows = [(i, " ".join(r[1].split()[:12])) for i, r in enumerate(corpus[:40])]
    rows += [(100, None), (101, ""), (102, " .,- "), (103, "THE the"), (104, "nowhere-to-be found"),
             (105, "naïve日本 café"), (106, corpus[90][1]), (107, "x" * 30_000),
             (None, prose("fr", 30, rng)), (3, prose("de", 5, rng)), (0, rows[0][1])]
    return rows


@pytest.mark.parametrize("settings", [
    L.Settings(), SMALL, L.Settings(leaf=4, block_rows=16, block_terms=300, sample=12, set_terms=150)])
def test_equals_brute_force(spark, docs, corpus, items, settings):
    table = spark.createDataFrame(items, "item_id long, text string")
    found = answers(L.rank(docs, table, settings))
    assert found == plain([r[:2] for r in corpus], items)


def test_trees_prune():
    """Clustered vectors: an item near one cluster opens few leaves of the others."""
    rng = np.random.default_rng(4)
    vectors, width = [], 400
    for i in range(2_000):
        group = i % 20
        own = rng.choice(np.arange(group * 20, group * 20 + 20), 12, replace=False)
        vectors.append((i, np.sort(own), rng.integers(800_000, 1_000_000, 12)))
    docs = L.Docs(np.array([v[0] for v in vectors]), np.arange(0, 24_001, 12),
                  np.concatenate([v[1] for v in vectors]), np.concatenate([v[2] for v in vectors]))
    terms = np.concatenate([np.arange(g * 20, g * 20 + 20) for g in range(20)])
    items = L.Items(np.arange(0, 401, 20), terms, rng.integers(1_000, 9_000, 400))
    tree = L.build(docs, items, width, 32)
    best = L.Best(np.zeros(20), 10)
    L.search(tree, items, width, best)
    for g in range(20):
        dense = np.zeros(width, "i8")
        dense[items.terms[g * 20 : g * 20 + 20]] = items.weights[g * 20 : g * 20 + 20]
        scores = sorted(((-int(s), i) for s, i in zip(docs.dot(dense), docs.ids)))[:10]
        assert [(-int(s), int(i)) for s, i in zip(best.scores[g], best.ids[g])] == scores
    assert best.opened < 0.2 * best.all


def test_bounds_hold():
    rng = np.random.default_rng(5)
    n, width = 300, 1_000
    terms = np.concatenate([np.sort(rng.choice(width, 30, replace=False)) for _ in range(n)])
    docs = L.Docs(np.arange(n), np.arange(0, 30 * n + 1, 30), terms, rng.integers(1, 10**6, 30 * n))
    items = L.Items(np.arange(0, 1_001, 100), rng.integers(0, width, 1_000), rng.integers(0, 20_000, 1_000))
    items.terms = np.concatenate([rng.choice(width, 100, replace=False) for _ in range(10)])
    for at in (np.arange(n), np.arange(7), np.array([5]), np.array([5, 5, 5])):
        own = docs.take(at)
        centre, radius, _ = L.ball(own, width)
        bounds = items.bounds(centre, radius)
        for i in range(10):
            dense = np.zeros(width, "i8")
            dense[items.terms[i * 100 : i * 100 + 100]] = items.weights[i * 100 : i * 100 + 100]
            assert own.dot(dense).max() <= bounds[i]


def test_odd_tables(spark, docs, no_docs, odd_columns, corpus, items):
    table = spark.createDataFrame(items, "item_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert L.rank(no_docs, table).count() == 0
    assert L.rank(docs, none).count() == 0 and L.rank(no_docs, none).count() == 0
    odd = table.withColumns({c: F.lit("mine") for c in ("rank", "term", "item", "score", "doc_id")})
    assert answers(L.rank(odd_columns, odd, SMALL)) == plain([r[:2] for r in corpus], items)
    # Ties and copies, also without a doc_id.
    rows = [(None if i == 5 else i, "one two three", None, None, None) for i in range(300)] + [
        (7, "one two three", None, None, None), (900, "other", None, None, None)]
    same = spark.createDataFrame(rows, DOC_SCHEMA).repartition(6)
    asked = [(1, "Two one"), (2, "OTHER")]
    found = answers(L.rank(same, spark.createDataFrame(asked, "item_id long, text string"), SMALL))
    assert found == plain([r[:2] for r in rows], asked)
    assert [d for d, _ in found[1]] == [0, 1, 2, 3, 4, 6, 7, 7, 8, 9]


def test_registered_query(spark, sf_dir, duck):
    out = queries.op13_lexical_search(spark, sf_dir)
    assert out.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    expected = duck.execute(
        f"SELECT {', '.join(out.columns)} FROM ({queries.ORACLES['op13_lexical_search']})").fetchall()
    assert sorted(map(tuple, out.collect())) == sorted(expected) and len(expected) > 300
