"""The corpus pipeline: clean ``documents`` and encode what is left.

Stages, each written as Parquet and read again by the next: language ID, toxicity, near duplicates by n-gram Jaccard,
benchmark decontamination, BPE encoding. Every stage judges all rows that the one before kept; all but the last give
back the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marquee.llm import decontaminate, language, ngram_join, token_codec, toxicity
from marquee.llm.common import fold, table, written


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the model tells clearly better than by guessing; the others go, as do those without
    letters."""
    model = language.train(docs, fold("doc_id", language.FOLDS) != language.HELD_OUT)
    return language.keep_identified(docs, model)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model does not call toxic, learnt from the labels of those at hand."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"), fold("doc_id", toxicity.FOLDS) != toxicity.HELD_OUT)
    return toxicity.keep_harmless(docs, model)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one of the smallest id."""
    return ngram_join.keep_one(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of what is left, with the digests of ids and decoded text."""
    return token_codec.encode_documents(docs, keep=("ids",))


STAGES = [
    ("language", language_stage),
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", benchmark_stage),
    ("bpe_encoding", encode_stage),
]

#: The trained models have no SQL form; the tests compare the other stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents`` in turn."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
