import math
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tasador.llm import mixing as M

from .conftest import DOC_SCHEMA, lower_words


def totals(rows, corpus):
    own = Counter()
    for r in corpus:
        own[r[3]] += len(lower_words(r[1])) + 1
    return own


def test_keeps_every_document_and_the_repetition_limit(docs, corpus):
    s = M.Settings(budget=None, repeats=2.0, entropy=1.0)
    rows = M.mix(docs, s).collect()
    own = totals(rows, corpus)
    used = Counter()
    for r in rows:
        used[r["source"]] += r["mix_tokens"]
    first = Counter((r["doc_id"], r["text"]) for r in rows if r["mix_pass"] == 0)
    assert first == Counter((r[0], r[1]) for r in corpus)
    for source, n in own.items():
        assert n <= used[source] <= 2 * n + 1
    rare = min(own, key=own.get)
    assert used[rare] > 1.4 * own[rare]


def test_budgets_follow_the_weights(docs, corpus):
    s = M.Settings(entropy=0.97, repeats=3.0, block_tokens=500, bucket_rows=4)
    rows = M.mix(docs, s).collect()
    own = totals(rows, corpus)
    total, used, weight, longest = sum(own.values()), Counter(), {}, defaultdict(int)
    for r in rows:
        used[r["source"]] += r["mix_tokens"]
        weight[r["source"]] = r["mix_weight"]
        longest[r["source"]] = max(longest[r["source"]], r["mix_tokens"])
    assert abs(sum(weight.values()) - 1) < 1e-6
    for source in own:
        budget = weight[source] * total
        assert used[source] <= budget + 1
        assert budget <= 3 * own[source] + 1
    entropy = -sum(w * math.log(w) for w in weight.values())
    assert entropy <= 0.97 * math.log(len(own)) + 1e-6
    blocks = defaultdict(Counter)
    for r in rows:
        blocks[r["mix_block"]][r["source"]] += r["mix_tokens"]
    assert len(blocks) >= 2


def test_equals_sql_and_does_not_depend_on_buckets(spark, docs):
    own = docs.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    table = own.select("doc_id", "source", "text").toArrow()
    duck = duckdb.connect()
    duck.register("documents", table)
    for s in (M.Settings(block_tokens=700, entropy=0.95), M.Settings(block_tokens=700, entropy=0.95, bucket_rows=3)):
        slots = Window.partitionBy("mix_block").orderBy("mix_order")
        rows = M.mix(own, s).select(
            "doc_id", "source", F.col("mix_tokens").alias("n_tokens"), "mix_pass", "mix_weight",
            "mix_block", F.row_number().over(slots).cast("long").alias("mix_slot"))
        expected = duck.execute(M.oracle(s))
        names = [d[0] for d in expected.description]
        assert Counter(tuple(r) for r in rows.select(names).collect()) == Counter(expected.fetchall())


@pytest.mark.parametrize("entropy", [0.9, 0.97])
def test_the_exponent_meets_the_target(docs, entropy):
    s = M.Settings(entropy=entropy, repeats=1e9)
    rows = docs.withColumns({"mix_source": F.coalesce("source", F.lit("")), "mix_tokens": M.tokens(F.col("text"))})
    stats = M.source_stats(rows)
    alpha = M.exponent(stats, s)
    shares = [r["share"] for r in stats.collect()]
    if 0 < alpha < 1:
        powers = [p**alpha for p in shares]
        own = [p / sum(powers) for p in powers]
        assert abs(-sum(w * math.log(w) for w in own) - entropy * math.log(len(own))) < 1e-6


def test_odd_tables(no_docs, odd_columns, corpus, spark):
    assert M.mix(no_docs).count() == 0
    s = M.Settings(budget=None, repeats=1.0)
    found = M.mix(odd_columns.drop("mix_pass"), s)
    assert found.count() == len(corpus) and "rank" in found.columns
    one = spark.createDataFrame([(1, "a b", None, None, 1), (1, "a b", None, None, 1)], DOC_SCHEMA)
    assert M.mix(one, s).count() == 2
