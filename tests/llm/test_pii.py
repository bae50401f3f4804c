import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tasador.llm import pii

from .conftest import DOC_SCHEMA

PLAIN = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def brute(text):
    found = []
    for kind, pattern in enumerate(PLAIN):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if (
                kind == 0
                or kind == 1 and all(int(p) <= 255 for p in m[0].split("."))
                or kind == 2 and 14 <= len(digits) <= 19 and luhn(digits)
                or kind == 3 and 10 <= len(digits) <= 15
            ):
                found.append((m.start(), kind, m.end()))
    return ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in sorted(found))


def base(table, model):
    spans = pii.annotate(table, model)
    return {r["doc_id"]: r["s"] for r in spans.select(
        "doc_id", pii.digest(pii.base_only(F.col("pii"))).alias("s")).collect()}


@pytest.fixture(scope="module")
def model(docs):
    return pii.fit(docs)


def test_equals_plain_patterns(docs, corpus, model):
    found = base(docs, model)
    assert all(found[r[0]] == brute(r[1] or "") for r in corpus)


HARD = [
    "a@b.cc%x@y.zz", "a@b@c.d", "é@x.de ü", "1.2.3.4.5.6.7.8", "001.02.3.0255", "1.2.3.999.1.2.3.4",
    "4111 1111 1111 1111 1", "4111-1111-1111-1111", "+1 (988) 555-2485.", "+49 30 1234567 +1", "++12345678901",
    "日本4041894974608795é", "1" * 5_000, "a" * 20_000 + "@b.c", "0.0.0.0", "x@y", "@a.b", ".@a.b.", "",
]


def test_hard_texts(spark, model):
    rows = [(i, t, None, None, None) for i, t in enumerate(HARD)]
    found = base(spark.createDataFrame(rows, DOC_SCHEMA), model)
    assert found == {i: brute(t) for i, t in enumerate(HARD)}


@settings(max_examples=12, deadline=None)
@given(st.lists(st.text("ab@.+-() 0123459é\n", max_size=60), min_size=20, max_size=20))
def test_random_texts(spark, model, texts):
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)]
    assert base(spark.createDataFrame(rows, DOC_SCHEMA), model) == {
        i: brute(t) for i, t in enumerate(texts)}


def test_secrets_are_added_and_redacted(docs, model):
    row = pii.redact(pii.annotate(docs.filter("doc_id = 155"), model)).first()
    kinds = [pii.KINDS[s["kind"]] for s in row["pii"]]
    assert kinds == ["email", "phone", "card", "ip", "secret"]
    assert row["text"] == (
        "Mail <EMAIL> or <PHONE>, <CARD> at 10.0.0.256 and <IP>. password=<SECRET>")
    clean = docs.filter("doc_id < 150")
    assert pii.annotate(clean, model).filter(F.size("pii") > 0).count() == 0


def test_reliable_labelers_are_found():
    # Two labelers agree with the truth, one votes at random.
    patterns = [((1, 1, 1, 1), 40), ((1, 1, -1, 1), 40), ((-1, -1, 1, -1), 30), ((-1, -1, -1, -1), 30)]
    posteriors, hits = pii._em(patterns)
    assert posteriors[0] > 0.9 and posteriors[1] > 0.9 and posteriors[2] < 0.1
    assert hits[0][0] > 0.9 and hits[0][1] < 0.2
    assert abs(hits[2][0] - hits[2][1]) < 0.15


def test_odd_tables(no_docs, odd_columns, corpus, model):
    assert pii.annotate(no_docs, pii.fit(no_docs)).count() == 0
    found = pii.redact(pii.annotate(odd_columns, model, "_spans"), "_spans")
    assert found.count() == len(corpus)
    assert found.filter("doc_id = 150").first()["text"] is None
    assert found.filter("doc_id = 154").first()["pii"] == "mine"
