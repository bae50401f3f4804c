import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tasador.llm import ngram_lm as N

from .conftest import DOC_SCHEMA, lower_words


class Plain:
    """The same model, with dictionaries."""

    def __init__(self, texts):
        tokens = [lower_words(t) + ["</s>"] for t in texts]
        self.c = Counter(w for t in tokens for w in t)
        self.pairs = Counter(p for t in tokens for p in zip(["<s>", *t[:-1]], t))
        self.n, self.known = sum(self.c.values()), len(self.c)
        self.firsts = Counter(w for _, w in self.pairs)
        self.d2, self.d1 = (N.discounts([sum(x == k for x in c.values()) for k in (1, 2, 3, 4)])
                            for c in (self.pairs, self.firsts))
        self.total, self.left = Counter(), Counter()
        for (v, _), x in self.pairs.items():
            self.total[v] += x
            self.left[v] += self.d2[min(x, 3)]
        self.free = sum(self.d1[min(x, 3)] for x in self.firsts.values())

    def single(self, w):
        if not self.pairs:
            return 1 / (self.known + 1)
        x = self.firsts.get(w, 0)
        return (max(x - self.d1[min(x, 3)], 0) + self.free / (self.known + 1)) / len(self.pairs)

    def pair(self, v, w):
        if not self.total[v]:
            return self.single(w)
        x = self.pairs.get((v, w), 0)
        return (max(x - self.d2[min(x, 3)], 0) + self.left[v] * self.single(w)) / self.total[v]

    def row(self, text):
        t = lower_words(text) + ["</s>"]
        return (len(t), sum(self.c[w] > 0 for w in t), self.n,
                sum(math.log10((self.c[w] + 1) / (self.n + self.known + 1)) for w in t),
                sum(math.log10(self.pair(v, w)) for v, w in zip(["<s>", *t[:-1]], t)))


def rows_of(table, train, s=N.Settings()):
    return [(r["doc_id"], (r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]))
            for r in N.score(table, train, s).collect()]


@pytest.mark.parametrize("s", [N.Settings(), N.Settings(shards=200, block_tokens=500)])
def test_equals_plain_model(docs, corpus, s):
    """With 200 shards, frequent words and pairs are hot."""
    model = Plain([r[1] for r in corpus if r[0] % 3])
    texts = {r[0]: r[1] for r in corpus}
    found = rows_of(docs, F.col("doc_id") % 3 != 0, s)
    assert len(found) == len(corpus)
    for doc_id, values in found:
        assert np.allclose(values, model.row(texts[doc_id]), rtol=1e-9, atol=1e-9)


def test_hot_keys_are_found(docs):
    words, pairs = N._hot(docs.select("doc_id", "text"), 200, N.Settings())
    assert len(words) and len(pairs) and len(words) <= 200 and len(pairs) <= 200


def test_probabilities_sum_to_one(corpus):
    model = Plain([r[1] for r in corpus])
    for v in ("the", "<s>", "nowhere"):
        assert abs(sum(model.pair(v, w) for w in model.c) + model.pair(v, "unknown") - 1) < 1e-9


def test_better_than_the_base_on_held_out_texts(docs, corpus):
    found = rows_of(docs, F.col("doc_id") % 3 != 0)
    held = [v for i, v in found if i % 3 == 0 and v[0] > 5]
    assert sum(v[4] for v in held) > sum(v[3] for v in held)


def test_odd_tables(spark, no_docs, odd_columns, corpus):
    assert N.score(no_docs, F.lit(True)).count() == 0
    assert N.score(odd_columns, F.col("doc_id") % 3 != 0).count() == len(corpus)
    rows = [(None, "a b a b", "", "", 1), (None, None, "", "", 1), (7, "a", "", "", 1), (7, "a", "", "", 1)]
    table = spark.createDataFrame(rows, DOC_SCHEMA)
    found = rows_of(table, F.lit(False))
    assert sorted(v[0] for _, v in found) == [1, 2, 2, 5]
    assert all(v[1:3] == (0, 0) and abs(v[3]) < 1e-12 and abs(v[4]) < 1e-12 for _, v in found)
