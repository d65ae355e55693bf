"""The operators as queries over the test tables, by the names and columns of their contracts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship_package
from . import (
    bpe_count, conversation_repair, graph_search, html_main, line_dedup, merkle, mixing, packing, quality, secret_scan, shingle_join, spot_signatures, twins, url_reputation,
)

WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
#: The url rules of the contract.
URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.judge(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_main.extract_pages(table(spark, sf_dir, "pages"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents"), line_dedup.MIN_WORDS, line_dedup.NEAR_WORDS)


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    outcomes = url_reputation.page_outcomes(pages, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return url_reputation.judge_urls(pages, outcomes, URL_RULES)


def op5_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = graph_search.written(graph_search.valid_vectors(table(spark, sf_dir, "embeddings")), "vectors")
    index, shards = graph_search.build_index(vectors)
    return graph_search.search(index, shards, vectors.where(F.col("vec_id") % 50 == 0))


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingle_join.join_groups(table(spark, sf_dir, "documents"))


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), WORD_VOCABULARY)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_count.count_tokens(table(spark, sf_dir, "documents"), BYTE_VOCABULARY)


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_documents(table(spark, sf_dir, "documents"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair(table(spark, sf_dir, "conversations"))


def op12_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spot_signatures.edited_documents(table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return merkle.manifest(docs, merkle.lowered, merkle.every_fifth(docs["doc_id"]))


_QUERIES = (
    op1_quality_rules, op2_html_extraction, op3_line_dedup, op4_url_filters, op5_nearest_neighbours,
    op6_ngram_jaccard, op7_source_mixing, op8_best_fit_packing, op9_token_counts, op10_secret_scan,
    op11_conversation_repair, op12_document_fingerprints, op13_merkle_manifest,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)

        return run

    return {fn.__name__: bind(fn) for fn in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return {
        "op6_ngram_jaccard": NGRAM_JACCARD, "op11_conversation_repair": twins.CONVERSATION_REPAIR,
        "op12_document_fingerprints": twins.SPOT_SIGNATURES, "op13_merkle_manifest": twins.MERKLE_MANIFEST,
    }


NGRAM_JACCARD = """
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w
    FROM documents
), sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_distinct(list_transform(range(1, greatest(len(w) - 3, 1) + 1), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s
    FROM words
), tokens AS (
    SELECT doc_id, len(s) AS n, unnest(s) AS t FROM sets
), pairs AS (
    SELECT a.doc_id AS x, b.doc_id AS y, any_value(a.n) AS nx, any_value(b.n) AS ny, count(*) AS c
    FROM tokens a JOIN tokens b ON a.t = b.t AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
    SELECT x, y FROM pairs WHERE 100 * c >= 85 * (nx + ny - c)
), reach(doc_id, other) AS (
    SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.y FROM reach r JOIN links l ON r.other = l.x
)
SELECT sets.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, (SELECT min(other) FROM reach WHERE reach.doc_id = sets.doc_id) AS component_id
FROM sets
"""
