"""Blob store queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tracewright.functions import hashing as H
from tracewright.functions.patterns import JAVA_BLOB_ID_PATTERN, SOURCE_BLOB_ID_PATTERN
from tracewright.operators import blobs as BL
from tracewright.operators.lookup import lookup, write_lookup
from tracewright.operators.redact import redact
from tracewright.plans.oracle_views import with_views
from tracewright.plans.registry import query
from tracewright.schemas import MAX_BLOB_BYTES
from tracewright.session import scratch_path
from tracewright.sources import bindings as B
from tracewright.sources.binary import decoded_preview

ROOT = BL.DEFAULT_ROOT


@query("blob_ingest", with_views(f"""
SELECT blob_id, source_key, coalesce(nullif(content_type, ''), 'application/octet-stream') AS content_type,
       CAST(octet_length(encode(content)) AS BIGINT) AS byte_length,
       concat('file://{ROOT}/sha256/', substring(blob_id, 8, 2), '/', substring(blob_id, 8)) AS storage_uri,
       substring(blob_id, 8, 2) AS shard
FROM tel_blobs""", "tel_blobs"))
def blob_ingest(spark, sf):
    return BL.blob_rows(B.tel_blobs(spark, sf), root=ROOT).select(
        "blob_id", "source_key", "content_type", "byte_length", "storage_uri", "shard")


@query("blob_dedup_first_writer", with_views("""
SELECT blob_id, arg_min(content_type, source_key) AS content_type, min(source_key) AS source_key,
       CAST(arg_min(octet_length(encode(content)), source_key) AS BIGINT) AS byte_length, CAST(count(*) AS BIGINT) AS n_writes
FROM tel_blobs GROUP BY blob_id""", "tel_blobs"))
def blob_dedup_first_writer(spark, sf):
    rows = BL.blob_rows(B.tel_blobs(spark, sf), root=ROOT)
    return BL.dedup_first_writer(rows, ["source_key"], ["content_type", "source_key", "byte_length"])


@query("blob_lookup", with_views("""
SELECT e.event_id, e.blob_id, b.blob_id IS NOT NULL AS exists, b.byte_length
FROM tel_events e LEFT JOIN (SELECT blob_id, CAST(arg_min(octet_length(encode(content)), source_key) AS BIGINT) AS byte_length
                             FROM tel_blobs GROUP BY blob_id) b ON e.blob_id = b.blob_id""", "tel_events", "tel_blobs"))
def blob_lookup(spark, sf):
    """Every event's blob reference resolved against the store; dangling refs kept."""
    stored = BL.dedup_first_writer(BL.blob_rows(B.tel_blobs(spark, sf), root=ROOT), ["source_key"], ["byte_length"])
    refs = B.tel_events(spark, sf).select("event_id", "blob_id")
    return (refs.join(stored.select(F.col("blob_id").alias("_b"), "byte_length"), F.col("blob_id") == F.col("_b"), "left")
            .select("event_id", "blob_id", F.col("_b").isNotNull().alias("exists"), "byte_length"))


@query("blob_new_only", with_views("""
SELECT source_key, blob_id FROM tel_blobs b
WHERE NOT EXISTS (SELECT 1 FROM tel_events e WHERE e.blob_id = b.blob_id AND e.type = 'thought')""", "tel_blobs", "tel_events"))
def blob_new_only(spark, sf):
    """Uploads (all documents) whose content is not already stored (blobs that thoughts refer to)."""
    stored = B.tel_events(spark, sf).where(F.col("type") == "thought").select("blob_id")
    return BL.new_only(B.tel_blobs(spark, sf).select("source_key", "blob_id"), stored)


@query("blob_shard_profile", with_views("""
SELECT substring(blob_id, 8, 2) AS shard, CAST(count(DISTINCT blob_id) AS BIGINT) AS n_blobs,
       CAST(count(*) AS BIGINT) AS n_rows, CAST(sum(octet_length(encode(content))) AS BIGINT) AS n_bytes
FROM tel_blobs GROUP BY 1""", "tel_blobs"))
def blob_shard_profile(spark, sf):
    rows = BL.blob_rows(B.tel_blobs(spark, sf), root=ROOT)
    return rows.groupBy("shard").agg(F.countDistinct("blob_id").alias("n_blobs"),
                                     F.count(F.lit(1)).alias("n_rows"),
                                     F.sum("byte_length").cast("long").alias("n_bytes"))


_CAND_SPARK = """CASE WHEN n % 7 = 0 THEN upper(blob_id) WHEN n % 11 = 0 THEN substring(blob_id, 8)
     WHEN n % 13 = 0 THEN concat(blob_id, '\\n') WHEN n % 17 = 0 THEN concat('md5:', substring(blob_id, 8, 32))
     ELSE blob_id END"""


@query("blob_id_check", with_views(f"""
SELECT event_id, candidate,
       CASE WHEN starts_with(candidate, 'sha256:') THEN substring(candidate, 8) END AS hex_part,
       starts_with(candidate, 'sha256:') AS prefix_ok,
       regexp_matches(candidate, '{SOURCE_BLOB_ID_PATTERN}') AS pattern_ok,
       CASE WHEN starts_with(candidate, 'sha256:') THEN concat('file://{ROOT}/sha256/', substring(candidate, 8, 2), '/', substring(candidate, 8)) END AS storage_uri
FROM (SELECT event_id, CASE WHEN n % 7 = 0 THEN upper(blob_id) WHEN n % 11 = 0 THEN substring(blob_id, 8)
     WHEN n % 13 = 0 THEN concat(blob_id, chr(10)) WHEN n % 17 = 0 THEN concat('md5:', substring(blob_id, 8, 32))
     ELSE blob_id END AS candidate
      FROM (SELECT *, CAST(substring(event_id, 4) AS BIGINT) AS n FROM tel_events) e) c""", "tel_events"))
def blob_id_check(spark, sf):
    """P4 + V11 + P2: prefix parse, strict pattern and URI over every event's
    blob reference, with malformed variants derived per event id."""
    ev = B.tel_events(spark, sf).withColumn("n", F.substring("event_id", 4, 1 << 20).cast("bigint"))
    c = ev.select("event_id", F.expr(_CAND_SPARK).alias("candidate"))
    cand = F.col("candidate")
    return c.select("event_id", "candidate", H.parse_blob_id(cand).alias("hex_part"),
                    cand.startswith("sha256:").alias("prefix_ok"),
                    cand.rlike(JAVA_BLOB_ID_PATTERN).alias("pattern_ok"),
                    F.when(cand.startswith("sha256:"), H.storage_uri(cand, ROOT)).alias("storage_uri"))


_LARGE = "token=abcdefgh12345678 "
_COPIES = 48_000  # 1,104,000 bytes, more than a blob keeps


@query("binary_uploads", f"""
SELECT doc_id, concat('sha256:', sha256(content)) AS blob_id, octet_length(content)::BIGINT AS byte_length, doc_id % 200 <> 0 AND doc_id % 3 <> 0 AS is_text,
       octet_length(content) > {MAX_BLOB_BYTES} AS was_truncated,
       CASE WHEN doc_id % 200 = 0 THEN sha256(encode(left(repeat('{_LARGE}', {_COPIES}), {MAX_BLOB_BYTES}))) WHEN doc_id % 3 = 0 THEN sha256(content) END AS kept_sha256,
       CASE WHEN doc_id % 200 = 0 THEN concat(left(repeat('{_LARGE}', 20), 200), '...') WHEN doc_id % 3 = 0 AND length(text) > 200 THEN concat(substring(text, 1, 200), '...')
            WHEN doc_id % 3 = 0 THEN concat(substring(text, 1, 200), chr(65533)[:CASE WHEN length(text) = 200 THEN 0 ELSE 1 END], CASE WHEN length(text) = 200 THEN '...' ELSE '' END) END AS preview
FROM (SELECT doc_id, text, CASE WHEN doc_id % 200 = 0 THEN encode(repeat('{_LARGE}', {_COPIES})) || '\\xFF'::BLOB
                                WHEN doc_id % 3 = 0 THEN encode(text) || '\\xFF'::BLOB ELSE encode(text) END AS content FROM documents) d""")
def binary_uploads(spark, sf):
    """Uploads as bytes, some of them not UTF-8 and some over a mebibyte: text rules pass the undecodable ones by,
    truncation cuts bytes, previews decode with replacement."""
    n, text = F.col("doc_id"), F.col("text").cast("binary")
    bad = F.lit(b"\xff")
    large = F.concat(F.repeat(F.lit(_LARGE), _COPIES).cast("binary"), bad)
    docs = B.table(spark, sf, "documents").select(
        "doc_id", F.when(n % 200 == 0, large).when(n % 3 == 0, F.concat(text, bad)).otherwise(text).alias("content"), F.lit(None).cast("string").alias("content_type"))
    r = redact(BL.blob_rows(docs), "content")
    odd = (n % 200 == 0) | (n % 3 == 0)
    return r.select("doc_id", "blob_id", "byte_length", F.expr("is_valid_utf8(cast(content as string))").alias("is_text"), F.col("r_was_truncated").alias("was_truncated"),
                    F.when(odd, F.sha2("r_content", 256)).alias("kept_sha256"), F.when(odd, decoded_preview("content", 200)).alias("preview"))


@query("blob_point_lookup", with_views("""
SELECT DISTINCT b.blob_id, CAST(octet_length(encode(b.content)) AS BIGINT) AS byte_length, b.content FROM tel_blobs b
WHERE b.blob_id IN (SELECT blob_id FROM tel_blobs ORDER BY source_key LIMIT 50)""", "tel_blobs"))
def blob_point_lookup(spark, sf):
    """A request for fifty blobs (those uploaded first) against the stored table of all, by equalities pushed to the scan."""
    rows = BL.first_writer_rows(BL.blob_rows(B.tel_blobs(spark, sf)), ["source_key"])
    path = scratch_path(spark, f"tw-lookup-{uuid.uuid4().hex}")
    write_lookup(rows.select("blob_id", "byte_length", "content"), path, "blob_id", ["blob_id"])
    asked = [r["blob_id"] for r in B.tel_blobs(spark, sf).select("source_key", "blob_id").orderBy("source_key").limit(50).collect()]
    return lookup(spark, path, "blob_id", asked).select("blob_id", "byte_length", "content")
