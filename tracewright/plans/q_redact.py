"""Redaction queries (R1-R10) over whole documents, pages and conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewright.functions.patterns import SECRET_TOKEN, SOURCE_PII_PATTERNS, SOURCE_SECRET_PATTERNS
from tracewright.operators.redact import redact, redaction_audit
from tracewright.plans.registry import query
from tracewright.schemas import MAX_BLOB_BYTES
from tracewright.sources import bindings as B

TRUNC_BYTES = 1000  # small cap so truncation (and code-point splits) is exercised


def _corpus(spark, sf) -> DataFrame:
    """Every text item: documents, page html, conversation turns, benchmark items."""
    docs = B.table(spark, sf, "documents").select(F.lit("document").alias("source_table"),
                                                  F.col("doc_id").cast("string").alias("item_key"), F.col("text"))
    pages = B.table(spark, sf, "pages").select(F.lit("page").alias("source_table"),
                                               F.col("page_id").cast("string").alias("item_key"), F.col("html").alias("text"))
    conv = B.table(spark, sf, "conversations").select(
        F.lit("conversation").alias("source_table"),
        F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("item_key"), "text")
    bench = B.table(spark, sf, "benchmark").select(F.lit("benchmark").alias("source_table"),
                                                   F.col("item_id").cast("string").alias("item_key"), "text")
    return docs.unionByName(pages).unionByName(conv).unionByName(bench)


_CORPUS_SQL = """
SELECT 'document' AS source_table, CAST(doc_id AS VARCHAR) AS item_key, text FROM documents
UNION ALL SELECT 'page', CAST(page_id AS VARCHAR), html FROM pages
UNION ALL SELECT 'conversation', concat(conv_id, ':', turn), text FROM conversations
UNION ALL SELECT 'benchmark', CAST(item_id AS VARCHAR), text FROM benchmark"""


def _q(s: str) -> str:
    return s.replace("'", "''")


def _duck_redact(src: str, rules: tuple[str, ...], max_bytes: int) -> str:
    """DuckDB oracle: the same rule chain with the source patterns (RE2)."""
    steps = []
    if "secret_scan" in rules:
        steps += [("s", p, SECRET_TOKEN) for p in SOURCE_SECRET_PATTERNS]
    if "pii_mask" in rules:
        steps += [("p", p, r) for p, r in SOURCE_PII_PATTERNS]
    sql = f"SELECT *, text AS t0 FROM ({src}) src"
    for i, (_, p, r) in enumerate(steps, 1):
        sql = (f"SELECT *, regexp_matches(t{i-1}, '{_q(p)}') AS h{i}, "
               f"regexp_replace(t{i-1}, '{_q(p)}', '{_q(r)}', 'g') AS t{i} FROM ({sql}) s{i}")
    n = len(steps)
    sec = " OR ".join(f"h{i}" for i, (k, _, _) in enumerate(steps, 1) if k == "s") or "false"
    pii = " OR ".join(f"h{i}" for i, (k, _, _) in enumerate(steps, 1) if k == "p") or "false"
    body = f"encode(t{n})"
    trunc = f"(octet_length({body}) > {max_bytes})" if "truncate_large" in rules else "false"
    return f"""
SELECT source_table, item_key, ({sec}) AS secret_hit, ({pii}) AS pii_hit, {trunc} AS was_truncated,
       ({sec}) OR ({pii}) OR {trunc} AS was_modified,
       CAST(octet_length(encode(text)) AS BIGINT) AS original_length,
       concat_ws(',', CASE WHEN {sec} THEN 'secret_scan' END, CASE WHEN {pii} THEN 'pii_mask' END,
                 CASE WHEN {trunc} THEN 'truncate_large' END) AS rules_applied,
       sha256(CASE WHEN {trunc} THEN {body}[1:{max_bytes}] ELSE {body} END) AS content_sha256
FROM ({sql}) r"""


def _spark_redact(df: DataFrame, rules, max_bytes: int) -> DataFrame:
    r = redact(df, "text", rules=rules, max_bytes=max_bytes)
    ra = F.col("r_rules_applied")
    return r.select("source_table", "item_key",
                    F.array_contains(ra, "secret_scan").alias("secret_hit"),
                    F.array_contains(ra, "pii_mask").alias("pii_hit"),
                    F.col("r_was_truncated").alias("was_truncated"),
                    F.col("r_was_modified").alias("was_modified"),
                    F.col("r_original_length").alias("original_length"),
                    F.array_join(ra, ",").alias("rules_applied"),
                    F.sha2(F.col("r_content"), 256).alias("content_sha256"))


ALL = ("secret_scan", "pii_mask", "truncate_large")


@query("secret_scan", _duck_redact(_CORPUS_SQL, ("secret_scan",), MAX_BLOB_BYTES))
def secret_scan(spark, sf):
    return _spark_redact(_corpus(spark, sf), ["secret_scan"], MAX_BLOB_BYTES)


@query("pii_mask", _duck_redact(_CORPUS_SQL, ("pii_mask",), MAX_BLOB_BYTES))
def pii_mask(spark, sf):
    return _spark_redact(_corpus(spark, sf), ["pii_mask"], MAX_BLOB_BYTES)


@query("redact_all", _duck_redact(_CORPUS_SQL, ALL, MAX_BLOB_BYTES))
def redact_all(spark, sf):
    return _spark_redact(_corpus(spark, sf), None, MAX_BLOB_BYTES)


@query("redact_truncate", _duck_redact(_CORPUS_SQL, ALL, TRUNC_BYTES))
def redact_truncate(spark, sf):
    return _spark_redact(_corpus(spark, sf), list(reversed(ALL)), TRUNC_BYTES)


@query("redaction_audit", f"""
SELECT source_table, rule, CAST(count(*) AS BIGINT) AS n_items, CAST(sum(original_length) AS BIGINT) AS bytes_in
FROM (SELECT source_table, original_length, unnest(string_split(rules_applied, ',')) AS rule
      FROM ({_duck_redact(_CORPUS_SQL, ALL, TRUNC_BYTES)}) x WHERE rules_applied <> '') y
GROUP BY source_table, rule""")
def redaction_audit_q(spark, sf):
    r = redact(_corpus(spark, sf), "text", rules=None, max_bytes=TRUNC_BYTES)
    return redaction_audit(r, ["source_table"]).withColumn("bytes_in", F.col("bytes_in").cast("long"))
