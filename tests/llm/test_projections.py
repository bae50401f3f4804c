import numpy as np
import pytest
from pyspark.sql import functions as F

from tasador.llm import projections as P

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(vectors, k):
    out = {}
    for q, x in vectors.items():
        if q % 20 == 0:
            scores = sorted((-float(np.dot(x, y)), i) for i, y in vectors.items() if i != q)
            out[q] = [(i, -s) for s, i in scores[:k]]
    return out


def answers(table, **changes):
    s = P.Settings(**{"block_rows": 64, "sample_rows": 400} | changes)
    rows = P.nearest(table, F.col("id") % 20 == 0, s).collect()
    out = {}
    for r in sorted(rows, key=lambda r: r["rank"]):
        own = out.setdefault(r["query_id"], [])
        assert r["rank"] == len(own) + 1
        own.append((r["vec_id"], r["score"]))
    return out


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(2)
    own = {i: rng.standard_normal(24).astype("f4") * (1 + i % 5) for i in range(1_000)}
    own |= {i: own[7] for i in range(1_000, 1_300)}  # many copies, some of them queries
    return {i: v.astype("f8") for i, v in own.items()}


def table_of(spark, vectors):
    return spark.createDataFrame([(i, v.tolist(), 0) for i, v in vectors.items()], SCHEMA)


def test_recall_and_scores(spark, vectors):
    expected, found = brute(vectors, 20), answers(table_of(spark, vectors))
    assert set(found) == set(expected)
    hits = 0
    for q, near in expected.items():
        assert len(found[q]) == 20 and q not in dict(found[q])
        hits += len(set(dict(found[q])) & set(dict(near)))
        for i, score in found[q]:
            assert abs(score - float(np.dot(vectors[q], vectors[i]))) < 1e-9
    assert hits / (20 * len(expected)) >= 0.95


def test_exact_when_sure(spark, vectors):
    found = answers(table_of(spark, vectors), sure=1 - 1e-12, queries=16)
    for q, near in brute(vectors, 20).items():
        assert [i for i, _ in found[q]] == [i for i, _ in near]


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 0), (20, None, 0), (40, [0.0, 0.0], 0), (60, [nan, 1.0], 0),
            (80, [inf, 1.0], 0), (100, [None, 1.0], 0), (120, [1.0], 0), (None, [1.0, 1.0], 0),
            (3, [0.5, 1.0], 0), (4, [0.5, -1.0], 0), (0, [1.0, 0.0], 0), (5, [-0.0, 1.0], 0)]
    found = answers(spark.createDataFrame(rows, SCHEMA))
    assert found == {0: [(3, 0.5), (4, 0.5), (5, 0.0)]}
    assert answers(spark.createDataFrame([], SCHEMA)) == {}
    alone = spark.createDataFrame([(0, [1.0, 2.0], 0)], SCHEMA)
    assert answers(alone) == {}


def test_chi_square_quantile():
    rng = np.random.default_rng(0)
    s = P.Settings()
    draws = (rng.standard_normal((200_000, s.width)) ** 2).sum(axis=1)
    assert abs((draws <= s.radius()).mean() - s.sure) < 0.002
