import string

import numpy as np
import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

_LETTERS = {
    "en": "the and of to in that with for thing ring ent ion ly er",
    "de": "der die und ein sch zu auf mit ung keit ich ver ge ö ü",
    "fr": "le la les de une des pour dans eau tion ment que é è ç",
}


def prose(lang, n, rng):
    """Invented words of a language's syllables."""
    parts = _LETTERS[lang].split()
    return " ".join(
        "".join(rng.choice(parts, rng.integers(1, 4))) for _ in range(n)
    )


@pytest.fixture(scope="session")
def corpus():
    """Documents with copies, near copies, shared passages, odd rows and repeated rows."""
    rng = np.random.default_rng(3)
    rows, langs = [], list(_LETTERS)
    for i in range(90):
        lang = langs[i % 3]
        rows.append([i, prose(lang, int(rng.integers(3, 160)), rng), lang, f"s{min(i % 7, 3)}"])
    shared = prose("en", 60, rng)
    for i in range(90, 110):
        words = (shared + " " + prose("en", 20, rng)).split()
        rows.append([i, " ".join(words), "en", "s0"])
    for i in range(110, 150):  # near copies of one text, some of them equal
        words = rows[1][1].split() * 3
        words[int(rng.integers(0, 5))] = "changed"
        rows.append([i, " ".join(words), "de", "s0"])
    rows += [
        [150, None, None, None], [151, "", "en", "s1"], [152, " \t\n ", None, "s1"],
        [153, "12345 !!", "en", None], [154, "word", "en", "s1"],
        [155, "Mail a.b@example.com or +1 (988) 555-2485, 4041894974608795 at 10.0.0.256 "
              "and 42.144.35.254. password=b7db7aa4a5fcc78305", "en", "s1"],
        [156, "x" * 30_000 + " " + prose("en", 4_000, rng), "en", "s2"],
        [157, "THE THE the The " * 60, "en", "s2"],
        [158, "naïve  café\u00a0日本 <|endoftext|> a\x00b", "fr", "s2"],
    ]
    rows.append(list(rows[5]))  # a repeated row
    return [(*r, len(r[1]) if r[1] is not None else None) for r in rows]


@pytest.fixture(scope="session")
def docs(spark, corpus):
    return spark.createDataFrame(corpus, DOC_SCHEMA).repartition(4).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


@pytest.fixture(scope="session")
def odd_columns(docs):
    """The documents with more columns, named like those that operators add."""
    from pyspark.sql import functions as F

    return docs.withColumns({
        c: F.lit("mine") for c in ("key", "copy", "score", "lang_pred", "pii", "bands", "rank",
                                   "mix_pass", "component", "shard", "train", "hit", "rows")
    })


def lower_words(text):
    lower = "".join(chr(ord(c) + 32) if c in string.ascii_uppercase else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        lower = lower.replace(c, " ")
    return [w for w in lower.split(" ") if w]
