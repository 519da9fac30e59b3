"""The registered queries of the training-data operators, each over its whole table with production
parameters, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.llm import oracles
from tracewright.llm.common import table
from tracewright.llm.fingerprints import document_fingerprints
from tracewright.llm.minhash_dedup import minhash_dedup
from tracewright.llm.mixing import mix_sources
from tracewright.llm.packing import pack_documents
from tracewright.llm.quality_rules import quality_rules
from tracewright.llm.sharding import minimax_shards
from tracewright.llm.substring_dedup import substring_dedup
from tracewright.llm.suffix_dedup import suffix_dedup
from tracewright.llm.token_output import token_round_trip
from tracewright.llm.url_filters import url_filters
from tracewright.llm.vector_codes import vector_codes
from tracewright.llm.warc import page_records, warc_round_trip
from tracewright.llm.whitening import whiten

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {"op7_quality_rules": oracles.QUALITY_RULES, "op8_url_filters": oracles.URL_FILTERS,
                           "op10_source_mixing": oracles.SOURCE_MIXING, "op11_warc": oracles.WARC, "op12_vector_codes": oracles.VECTOR_CODES}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


@query
def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "n_removed", "kept_sha256", F.size("spans").cast("long").alias("n_spans"))


@query
def op3_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_fingerprints(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op4_minimax_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minimax_shards(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op5_bin_completion_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"), special=True)


@query
def op6_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query
def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters(table(spark, sf_dir, "pages").select("page_id", "url")).select(
        "page_id", "host", "path", "rule", "verdict", "pattern")


@query
def op9_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"), special=True)


@query
def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents").select("doc_id", "source", "text")).select(
        "doc_id", "size", "source_size", "target", "taken")


@query
def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_records(warc_round_trip(table(spark, sf_dir, "pages").select("page_id", "url", "html"))).drop("digest_holds")


@query
def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")).drop("label")


@query
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
