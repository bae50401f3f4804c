"""The registered queries on a small data folder: columns, types and rows."""

import hashlib

import pytest

from tasador.llm import queries

SF = "/root/testdata/sf0.001"
TABLES = {
    "op2_pii": ("documents", "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"),
    "op3_ctph": ("documents", "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"),
    "op6_wrappers": ("pages", "page_id long, url string, text string, n_chars long"),
    "op7_ngram_lm": ("documents", "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"),
    "op8_minhash_near_dedup": ("documents", "doc_id long, n_shingles long, component_id long, kept boolean"),
    "op9_suffix_array_dedup": ("documents", "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"),
    "op10_language_id": ("documents", "doc_id long, held_out boolean, lang_pred string, score double"),
    "op11_vector_codes": ("embeddings", "vec_id long, code string, error long, label_error long, codebooks_sha256 string"),
}


def types(frame):
    names = {"bigint": "long"}
    return {c: names.get(t, t) for c, t in frame.dtypes}


@pytest.mark.parametrize("name", sorted(TABLES))
def test_one_row_for_each_input_row(spark, name):
    table, columns = TABLES[name]
    out = queries.QUERIES[name](spark, SF)
    expected = dict(c.rsplit(" ", 1) for c in columns.split(", "))
    assert expected.items() <= types(out).items()
    source = spark.read.parquet(f"{SF}/{table}.parquet")
    key = out.columns[0]
    assert sorted(r[0] for r in out.select(key).collect()) == sorted(r[0] for r in source.select(key).collect())


def test_edited_texts_have_their_hashes(spark):
    """op3: the second half of a text gives way to the head of the next one down."""
    rows = {r["doc_id"]: r["text"] or "" for r in
            spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    order = sorted(rows, reverse=True)
    following = dict(zip(order, [*order[1:], order[0]]))
    for r in queries.op3_ctph(spark, SF).collect():
        text = rows[r["doc_id"]]
        half = len(text) // 2
        edited = text[: len(text) - half] + rows[following[r["doc_id"]]][:half]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1


def test_neighbours_and_pieces(spark):
    found = queries.op1_projected_neighbours(spark, SF)
    assert {"query_id": "long", "rank": "int", "vec_id": "long", "score": "double"}.items() <= types(found).items()
    n = spark.read.parquet(f"{SF}/embeddings.parquet").count()
    assert found.count() == 20 * ((n + 19) // 20)
    pieces = queries.op5_packing(spark, SF)
    expected = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
    assert {c: "long" for c in expected}.items() <= types(pieces).items()
    whole = {}
    for r in pieces.collect():
        whole.setdefault(r["doc_id"], []).append((r["start"], r["length"], r["doc_tokens"]))
    for own in whole.values():
        at = 0
        for start, length, total in sorted(own):
            assert start == at and length > 0
            at += length
        assert at == total
    assert len(whole) == spark.read.parquet(f"{SF}/documents.parquet").count()
