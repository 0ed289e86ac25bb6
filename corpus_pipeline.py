"""The cleaning of a corpus in stages, each written as Parquet and read by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from basketry.llm import decontaminate, languages, ngram_join, sentencepieces, toxicity
from basketry.llm.common import new_folder, table


def clean_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic."""
    return toxicity.keep_clean(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with text in a language that the labelled ones teach."""
    return languages.keep_identified(docs, languages.train(docs))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word n-grams, similarity 0.8 or more."""
    return ngram_join.keep_one(docs, ngram_join.Measure(words=5, num=80))


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a 10-word window of a benchmark item."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each document's pieces."""
    import public_tokenizers

    return sentencepieces.encode(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("toxicity", clean_language),
    ("language_id", known_language),
    ("ngram_jaccard_join", one_of_each),
    ("benchmark_decontamination", no_benchmark),
    ("sentencepiece_encoding", encoded),
]

#: trained models and similarity joins of whole texts are beyond SQL; the tests cover the operators one by one
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_folder(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
