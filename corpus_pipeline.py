"""Documents to packed training sequences: quality rules, line dedup, near duplicates, source mix, packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from carelake.llm import line_dedup, mixing, packing, quality, shingle_join
from carelake.llm.queries import WORD_VOCABULARY, table
from carelake.session import ship_package, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the trees keep; the trees are fitted to the labels beside the documents."""
    ship_package(spark)
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier line repeats to within one word."""
    ship_package(spark)
    return line_dedup.deduped_documents(docs, line_dedup.MIN_WORDS, line_dedup.NEAR_WORDS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of five-word-shingle similarity of 0.8 or more."""
    ship_package(spark)
    return shingle_join.one_of_each(docs, width=5, percent=80)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target takes them: not at all, once or twice."""
    ship_package(spark)
    return mixing.mixed_documents(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequence and place."""
    ship_package(spark)
    return packing.pack_documents(docs, WORD_VOCABULARY)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup_stage),
    ("ngram_jaccard", near_duplicates),
    ("source_mixing", source_mix),
    ("best_fit_packing", packed_sequences),
]

#: Trees, shingle groups and token ids have no SQL form; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed sequences of ``documents``; each stage is written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
