"""From raw documents to token ids: five stages, each over all that the one before kept.

SQL cannot express a trained network or fingerprints, so ORACLE_SQL is None; tests compare near
duplicates, decontamination and tokens with brute force, language with the labels, and secrets with
the patterns and a plain sum of the models' scores.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from recordlake.llm import language, secrets, simhash, string_tiling, word_bpe
from recordlake.llm.batches import stored
from recordlake.llm.queries import table, vocabulary

ORACLE_SQL = None


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is certain; the network learns from a bounded sample of labels."""
    return language.in_known_languages(docs, language.fitted(docs))


def near_duplicates_removed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints of four-word shingles link at four bits."""
    return simhash.one_of_each(docs, shingle=4, max_bits=4)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that give no item of the benchmark away."""
    return string_tiling.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secrets_removed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents with a mark in place of every secret."""
    return secrets.without_secrets(docs, secrets.train(secrets.labelled_samples(docs)))


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the text that they decode to."""
    path = vocabulary("word_bpe_49k.json")
    return word_bpe.encoded(docs, path, keep=["doc_id", "lang", "source"], with_decoded=True)


STAGES = [
    ("language", known_language),
    ("near duplicates", near_duplicates_removed),
    ("decontamination", decontaminated),
    ("secrets", secrets_removed),
    ("tokens", tokenized),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each is written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
