"""A corpus pipeline: quality rules, near duplicates, repeated passages, benchmark passages, tokens.

Every stage takes (spark, docs, sf_dir) and works on all its predecessor kept. All but the last return
the columns of `docs`, so stages can be written, reread and put in another order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.llm import common, decontaminate, near_duplicates, quality, sentencepiece_dropout, suffix_dedup
from creditloom.llm.registry import query
from creditloom.session import Scope


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the tokeniser bands of their language."""
    common.small_batches(spark)
    return quality.keep_good(docs)


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest doc_id."""
    common.small_batches(spark)
    return near_duplicates.keep_one(docs)


def without_repetitions(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the strings of 100 bytes that an earlier one has; empty ones go."""
    common.small_batches(spark)
    return suffix_dedup.remove(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    common.small_batches(spark)
    return decontaminate.clean(docs, common.table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids and n_tokens: SentencePiece ids with seeded merge-dropout."""
    common.small_batches(spark)
    return sentencepiece_dropout.encode(docs).select("doc_id", "ids", F.size("ids").alias("n_tokens"))


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard_join", one_of_near_duplicates),
    ("suffix_array_dedup", without_repetitions),
    ("benchmark_decontamination", without_benchmark),
    ("sentencepiece_encoding", tokens),
]

# Fertility, MinHash and merge agendas cannot be said in SQL; tests compare with a brute-force version.
ORACLE_SQL = None


@query("pipeline", ORACLE_SQL)
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on `documents`; each result is written as Parquet before the next stage reads it."""
    docs = common.table(spark, sf_dir, "documents")
    with Scope(spark, "pipeline") as scope:
        for name, stage in STAGES[:-1]:
            docs = scope.table(stage(spark, docs, sf_dir), name)
        return scope.keep(STAGES[-1][1](spark, docs, sf_dir), STAGES[-1][0])
