import re
from collections import Counter, defaultdict

import corpus_pipeline as C
from tasador.llm import queries

from .conftest import DOC_SCHEMA, lower_words
from .test_near_duplicates import brute
from .test_pii import PLAIN


def test_stages_in_order(spark, docs, corpus, tmp_path):
    """Every stage against a plain version of it, on its predecessor's rows."""
    rows, previous = docs, None
    texts = {r[0]: r[1] for r in corpus}
    for name, stage in C.STAGES:
        path = str(tmp_path / name)
        stage(spark, rows, None).write.parquet(path)
        previous, rows = rows, spark.read.parquet(path)
        if name != "packing":
            assert rows.columns == docs.columns
        ids = Counter(r["doc_id"] for r in rows.select("doc_id").collect())
        before = Counter(r["doc_id"] for r in previous.select("doc_id").collect())
        if name == "language_id":
            letters = {i for i, t in texts.items() if re.search(r"[^\W\d_]", t or "")}
            assert set(ids) <= letters and set(range(150)) <= set(ids)
        elif name == "minhash_near_dedup":
            own = brute([(i, texts[i]) for i in before])
            assert ids == Counter(i for i, (_, c) in own.items() if c == i)
        elif name == "pii":
            assert ids == before
            for r in rows.collect():
                assert not re.search(PLAIN[0], r["text"]) and r["n_chars"] == len(r["text"])
                if r["doc_id"] != 155:
                    assert r["text"] == texts[r["doc_id"]]
        elif name == "mixing":
            assert set(ids) == set(before) and max(ids.values()) <= 2
            own = defaultdict(int)
            for r in rows.collect():
                own[r["source"]] += len(lower_words(r["text"])) + 1
            assert max(own.values()) > 0
        else:
            pieces = defaultdict(int)
            whole = {}
            for r in rows.collect():
                pieces[r["doc_id"]] += r["length"]
                whole[r["doc_id"]] = r["doc_tokens"]
            assert all(pieces[i] == n * whole[i] for i, n in before.items())


def test_empty_table(spark, no_docs):
    rows = no_docs
    for _, stage in C.STAGES:
        rows = stage(spark, rows, None)
        assert rows.count() == 0


def test_run_equals_its_stages_and_all_are_registered(spark, sf_dir):
    import __spark_entry__ as contract

    registered = contract.queries()
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in registered) == 1
    assert registered["pipeline"] is C.run
    assert set(queries.ORACLES) <= set(queries.QUERIES)
    packed = C.run(spark, sf_dir)
    assert {"doc_id", "sequence_id", "offset"} <= set(packed.columns) and packed.count() > 900


def test_near_duplicates_from_four_fifths(spark):
    """Pairs at 0.80, 0.82 and just below 0.80."""
    rows = []
    for i, (same, a, b) in enumerate([(40, 5, 5), (41, 4, 5), (39, 5, 5)]):
        words = [f"w{i}x{k}" for k in range(same + 4)]
        x, y = words + [f"a{i}x{k}" for k in range(a)], words + [f"b{i}x{k}" for k in range(b)]
        rows += [(2 * i, " ".join(x), "en", "s", 1), (2 * i + 1, " ".join(y), "en", "s", 1)]
    kept = C.remove_near_duplicates(spark, spark.createDataFrame(rows, DOC_SCHEMA), None)
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 2, 4, 5]
