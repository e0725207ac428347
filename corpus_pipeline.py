"""A training corpus from ``documents``: language, near copies, secrets, mixture, sequences.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame, and ``run`` writes each stage's rows and reads them again
as the next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.llm import language_id, ngram_jaccard, packing, secret_scan, source_mixing
from riskflow.llm._tables import numbered, passing_tables, saved, table

#: SQL cannot express these stages; the tests hold them against brute force.
ORACLE_SQL = None


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is accepted; null and letterless texts and strange ones go."""
    return language_id.accepted(docs, language_id.learn(docs))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked word shingle sets: the one with the least doc_id."""
    return ngram_jaccard.one_of_each(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mask; n_chars follows."""
    return secret_scan.masked(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents as often as the mixture takes them: a row for each time.

    A document without words has no size; it stays as it is.
    """
    rows, number = numbered(docs, "numbered")
    quality = source_mixing.label_quality(table(spark, sf_dir, "labels"))
    with passing_tables(spark):
        taken = source_mixing.mixed(rows, quality, whole=True, keep=(number,))
        times = F.when(F.col("size") > 0, (F.col("taken") / F.col("size")).cast("int")).otherwise(1)
        copy = F.explode(F.sequence(F.lit(1), times))
        copies = taken.filter((F.col("size") == 0) | (F.col("taken") > 0)).select(number, copy).select(number)
        copies = saved(copies, "copies", keep=True)
    return rows.join(copies.hint("merge"), number).select(*docs.columns)  # one plan at every size


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of tokenized documents with their sequence and place."""
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", known_language),
    ("ngram_jaccard", without_near_copies),
    ("secret_scan", without_secrets),
    ("source_mixing", mixed_sources),
    ("packing", packed_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
