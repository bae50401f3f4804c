"""The corpus pipeline: from documents to packed training sequences.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the
last return the columns of ``docs``. ``run`` writes each stage's rows as Parquet
to the shared folder and gives the next stage the scan of them.
"""

from pyspark.sql import functions as F

from tasador.llm import language_id, minhash, mixing, packing, pii
from tasador.plans.workspace import materialize

#: A text is rejected if its language contains less than this share of its n-grams.
LEAST_COVERED = 0.25
#: Documents that share 80 % of their shingles of five words are near duplicates.
NEAR = minhash.Settings(percent=80)


def identify_language(spark, docs, sf_dir):
    """Drop texts without a letter and texts in none of the learned languages.

    Without labelled rows only texts without a letter are dropped.
    """
    model = language_id.train(docs)
    if not model.languages:
        return docs.filter(F.coalesce(F.col("text"), F.lit("")).rlike(r"\p{L}"))
    found = language_id.identify(docs, model, prefix="_")
    return found.filter(
        (F.col("_lang_pred") != language_id.UNKNOWN) & (F.col("_covered") >= LEAST_COVERED)
    ).select(docs.columns)


def remove_near_duplicates(spark, docs, sf_dir):
    """Keep the document with the smallest id of every group of near duplicates."""
    return minhash.without_near_duplicates(docs, NEAR)


def redact_personal_data(spark, docs, sf_dir):
    """Replace personal data by the name of its kind; ``n_chars`` follows the text."""
    clean = pii.redact(pii.annotate(docs, pii.fit(docs), "_pii"), "_pii").drop("_pii")
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        clean = clean.withColumn("n_chars", F.char_length("text").cast(kind))
    return clean.select(docs.columns)


def mix_sources(spark, docs, sf_dir):
    """Repeat documents of rare sources, up to twice; every document stays."""
    settings = mixing.Settings(budget=None, repeats=2.0, entropy=1.0)
    return mixing.mix(docs, settings).select(docs.columns)


def pack_sequences(spark, docs, sf_dir):
    """Pieces of all documents in sequences of up to 2048 tokens."""
    return packing.pack_documents(docs, packing.public_settings())


STAGES = [
    ("language_id", identify_language),
    ("minhash_near_dedup", remove_near_duplicates),
    ("pii", redact_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Packing cuts token sequences, which SQL cannot express.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
