import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tasador.llm import language_id as L

from .conftest import DOC_SCHEMA, prose


def test_held_out_accuracy(spark):
    rng = np.random.default_rng(9)
    rows = [(i, prose(lang, 60, rng), lang, "s", 1) for i, lang in enumerate(["en", "de", "fr"] * 60)]
    table = spark.createDataFrame(rows, DOC_SCHEMA)
    held = L.fold(4) == 2
    model = L.train(table.filter(~held))
    assert model.languages == ("de", "en", "fr")
    found = L.identify(table.filter(held), model).collect()
    assert len(found) > 20
    assert np.mean([r["lang_pred"] == r["lang"] for r in found]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in found)


def test_odd_rows(docs, no_docs, odd_columns, corpus):
    model = L.train(docs)
    found = {r["doc_id"]: r for r in L.identify(docs, model).collect()}
    for doc_id in (150, 151, 152, 153):
        assert (found[doc_id]["lang_pred"], found[doc_id]["score"]) == ("und", 0.0)
    assert found[154]["lang_pred"] in model.languages
    assert L.identify(no_docs, model).count() == 0
    named = L.identify(odd_columns, model)
    assert named.count() == len(corpus) and named.columns.count("score") == 1
    assert all(r["lang_pred"] == "und" for r in L.identify(docs, L.train(no_docs)).collect())


def test_filters_hold_all_members_and_correct_false_positives(docs):
    model = L.train(docs, L.Settings(cells=1 << 12))
    expected = model.false_positives()
    assert (expected > 0).all() and (expected < 1).all()
    roomy = L.train(docs, L.Settings(cells=1 << 18)).false_positives()
    assert (roomy < expected).all()


def test_more_than_64_languages(spark):
    rows = [(i, f"{chr(0x4E00 + i) * 6} {chr(0x4E00 + i)}", f"l{i:03d}", "s", 1) for i in range(70)]
    table = spark.createDataFrame(rows, DOC_SCHEMA)
    found = L.identify(table, L.train(table)).collect()
    assert all(r["lang_pred"] == r["lang"] for r in found)


def test_prediction_ignores_language_and_id(docs):
    model = L.train(docs)
    plain = {r["text"]: r["lang_pred"] for r in L.identify(docs, model).collect()}
    other = L.identify(docs.withColumns({"lang": F.lit("xx"), "doc_id": -F.col("doc_id")}), model)
    assert {r["text"]: r["lang_pred"] for r in other.collect()} == plain


def test_one_letter_at_the_end_is_a_text(spark, docs):
    texts = ["a", "7 b", "日", "x y", "no", "7", "", None]
    rows = spark.createDataFrame([(i, t, None, "s", 1) for i, t in enumerate(texts)], DOC_SCHEMA)
    for settings in (L.Settings(), L.Settings(orders=(5,))):
        model = L.train(docs, settings)
        found = {r["doc_id"]: r for r in L.identify(rows, model).collect()}
        assert all((r["lang_pred"] in model.languages) == (i < 5) for i, r in found.items())
    signs, of = L._signs(["", "a", None, "é 1", "b c"])
    assert "".join(map(chr, signs)) == " a  é  b c " and of.tolist() == [1] * 3 + [3] * 3 + [4] * 5
    # A word at the end of a text counts like any other.
    train = [(1, "za be", "p", "s", 1), (2, "ze ba", "q", "s", 1)]
    model = L.train(spark.createDataFrame(train * 2, DOC_SCHEMA))
    ends = spark.createDataFrame([(1, "ba", None, "s", 1), (2, "be", None, "s", 1)], DOC_SCHEMA)
    assert {r["doc_id"]: r["lang_pred"] for r in L.identify(ends, model).collect()} == {1: "q", 2: "p"}


def test_memory_of_a_batch_is_bounded():
    """4 MB of text in one batch: worked on in parts, with the results of single rows."""
    rng = np.random.default_rng(4)
    model = L.Model(("p", "q"), rng.integers(0, 4, (1, 1 << 18)).astype("u8"), L.Settings())
    texts = [prose("de", 150, rng) for _ in range(20)] * 250
    names = ["text", "lang_pred", "score", "covered"]

    def predicted(rows):
        batch = pa.RecordBatch.from_arrays([pa.array(rows, pa.string())], names=["text"])
        return [r for b in L._predict(iter([batch]), model, names) for r in b.to_pylist()]

    single = [predicted([t])[0] for t in texts[:20]]
    assert sum(len(t) for t in texts) > 4 << 20
    tracemalloc.start()
    found = predicted(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == single * 250
    assert peak < 100 << 20, peak >> 20
