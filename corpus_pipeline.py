"""Training-data pipeline over the ``documents`` table.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next
one's ``docs``. All stages but the last return the columns they were given, by value: columns beside OWN go through a stage
under private names, so none of them meets a column that an operator makes.

quality_rules    lines that fail a rule go, documents that lose too much or fail a base rule go
near_dedup       of each group of near-duplicates the document with the least id stays
substring_dedup  passages of 20 words or more that stand earlier in the corpus go, and documents left without words
mixing           sources are taken to their target weights: documents drawn several times are repeated, others go
packing          documents become pieces of at most 2048 tokens with a place in a sequence
"""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.llm.common import order_value, saved, table, text_key
from tracewright.llm.minhash_dedup import minhash_dedup
from tracewright.llm.mixing import mix_sources
from tracewright.llm.packing import pack_documents
from tracewright.llm.quality_rules import quality_rules
from tracewright.llm.substring_dedup import substring_dedup

TOKENIZER = "byte_bpe_50k.json"


OWN = ("doc_id", "text", "source", "n_chars")


def carrying(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """The stage with all columns but OWN renamed on the way in and named as before on the way out."""
    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        inside = [c.lower() if c.lower() in OWN else f"__carried_{i}" for i, c in enumerate(docs.columns)]
        return stage(spark, docs.toDF(*inside), sf_dir).select(*inside).toDF(*docs.columns)
    return run_stage


def _as(docs: DataFrame, out: DataFrame, text: str) -> DataFrame:
    """``out`` with the columns of ``docs``; ``text`` names the column that holds the new text."""
    new = {"text": F.col(text), "n_chars": F.char_length(F.col(text)).cast("long")}
    return out.select(*[new.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])


@carrying
def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document of which no line failed keeps its text as it is."""
    return _as(docs, quality_rules(docs).where("kept"), "clean_text")


@carrying
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that repeat both id and text are copies as well: one stays."""
    kept = minhash_dedup(docs.select("doc_id", "text")).where("kept").select(order_value(F.col("doc_id")).alias("__ord")).distinct()
    rows = docs.withColumn("__ord", order_value(F.col("doc_id"))).join(kept, "__ord", "left_semi")
    once = rows.withColumn("__k", text_key(F.coalesce("text", F.lit("")))).dropDuplicates(["__ord", "__k"])
    return once.select(*[F.col(f"`{c}`") for c in docs.columns])


@carrying
def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    carried = tuple(c for c in docs.columns if c not in ("doc_id", "text", "n_chars"))
    out = substring_dedup(docs, with_text=True, carry=carried)
    return _as(docs, out.where("n_removed = 0 or n_removed < n_words"), "kept_text")


@carrying
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    taken = mix_sources(docs).where("taken > 0")
    times = F.sequence(F.lit(1), (F.col("taken") / F.col("size")).cast("int"))
    return taken.withColumn("__nth", F.explode(times)).select(*[F.col(f"`{c}`") for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs.select("doc_id", "text"), public_tokenizers.path(TOKENIZER), special=True)


STAGES = [("quality_rules", clean), ("near_dedup", near_dedup), ("substring_dedup", cut_repeats), ("mixing", mix), ("packing", pack)]

# Tokenization is beyond SQL; tests/llm/test_pipeline.py holds the stages against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
