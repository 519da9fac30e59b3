"""Data-model queries: key/width constraints (V17), event normalization
(P7-P10, V23) and the sharded blob store round trip (S6, S7)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tracewright.functions.hashing import shard_of
from tracewright.operators import blobs as BL
from tracewright.plans.oracle_views import with_views
from tracewright.plans.registry import query
from tracewright.session import scratch_path
from tracewright.sources import bindings as B

# Column widths of the stored tables.
WIDTHS = {"events.type": 30, "traces.status": 20, "traces.trace_version": 10, "blobs.blob_id": 80,
          "blobs.content_type": 50}


@query("key_constraints", with_views(f"""
SELECT 'events' AS table_name, concat(trace_id, '/', event_id) AS key, 'unique_trace_event' AS constraint_name
FROM tel_submissions GROUP BY trace_id, event_id HAVING count(*) > 1
UNION ALL
SELECT DISTINCT 'events', trace_id, 'fk_trace' FROM tel_submissions s
WHERE NOT EXISTS (SELECT 1 FROM tel_traces t WHERE t.trace_id = s.trace_id)
UNION ALL
SELECT 'events', concat(trace_id, '/', event_id), 'width_type' FROM tel_submissions WHERE length(type) > {WIDTHS['events.type']}
UNION ALL
SELECT 'traces', trace_id, 'width_status' FROM tel_traces WHERE length(status) > {WIDTHS['traces.status']}
UNION ALL
SELECT 'blobs', blob_id, 'pk_blob_id' FROM tel_blobs GROUP BY blob_id HAVING count(*) > 1
UNION ALL
SELECT 'blobs', blob_id, 'width_blob_id' FROM tel_blobs WHERE length(blob_id) > {WIDTHS['blobs.blob_id']}
UNION ALL
SELECT 'blobs', blob_id, 'width_content_type' FROM tel_blobs WHERE length(content_type) > {WIDTHS['blobs.content_type']}""",
                                      "tel_submissions", "tel_traces", "tel_blobs"))
def key_constraints(spark, sf):
    """PK/UNIQUE (group-by-having), FK (anti join) and width checks."""
    subs, traces, blobs = B.tel_submissions(spark, sf), B.tel_traces(spark, sf), B.tel_blobs(spark, sf)
    def rows(df, table, key, name):
        return df.select(F.lit(table).alias("table_name"), key.alias("key"), F.lit(name).alias("constraint_name"))
    ev_key = F.concat(F.col("trace_id"), F.lit("/"), F.col("event_id"))
    uniq = subs.groupBy("trace_id", "event_id").count().where(F.col("count") > 1)
    fk = subs.select("trace_id").distinct().join(traces.select("trace_id"), "trace_id", "left_anti")
    pk = blobs.groupBy("blob_id").count().where(F.col("count") > 1)
    return (rows(uniq, "events", ev_key, "unique_trace_event")
            .unionByName(rows(fk, "events", F.col("trace_id"), "fk_trace"))
            .unionByName(rows(subs.where(F.length("type") > WIDTHS["events.type"]), "events", ev_key, "width_type"))
            .unionByName(rows(traces.where(F.length("status") > WIDTHS["traces.status"]), "traces",
                              F.col("trace_id"), "width_status"))
            .unionByName(rows(pk, "blobs", F.col("blob_id"), "pk_blob_id"))
            .unionByName(rows(blobs.where(F.length("blob_id") > WIDTHS["blobs.blob_id"]), "blobs",
                              F.col("blob_id"), "width_blob_id"))
            .unionByName(rows(blobs.where(F.length("content_type") > WIDTHS["blobs.content_type"]), "blobs",
                              F.col("blob_id"), "width_content_type")))


# payload fields with a default (applied only when the key is absent) per type
_DEFAULTS = {"patch_format": ("file_edit", "unified_diff"), "shell": ("terminal_command", "bash"),
             "is_truncated": ("terminal_output", "false")}


def _duck_default(p: str, t: str, d: str) -> str:
    return (f"CASE WHEN type <> '{t}' THEN NULL WHEN json_type(payload_json, '$.{p}') IS NULL THEN '{d}' "
            f"ELSE CAST(json_extract(payload_json, '$.{p}') AS VARCHAR) END AS {p}")


@query("event_normalize", with_views(f"""
SELECT trace_id, coalesce(event_id, concat('ev-', sha256(concat(trace_id, '/', seq)))) AS event_id, seq, actor_kind,
       CAST(NULL AS VARCHAR) AS actor_id, payload_json,
       {", ".join(_duck_default(p, t, d) for p, (t, d) in _DEFAULTS.items())},
       CASE WHEN type = 'thought' THEN CAST(coalesce(json_array_length(payload_json, '$.links_to'), 0) AS BIGINT) END AS n_links
FROM tel_events""", "tel_events"))
def event_normalize(spark, sf):
    """Envelope normalized (actor defaults, deterministic id when
    absent), payload kept raw, typed defaults read only where the key is
    absent (explicit null is not absent)."""
    ev = B.tel_events(spark, sf).withColumn("_v", F.expr("try_parse_json(payload_json)"))
    cols = []
    for p, (t, d) in _DEFAULTS.items():
        j = F.to_json(F.expr(f"try_variant_get(_v, '$.{p}', 'variant')"))
        cols.append(F.when(F.col("type") != t, F.lit(None).cast("string"))
                    .when(j.isNull(), F.lit(d))
                    .otherwise(F.when(F.substring(j, 1, 1) == '"', F.expr(f"try_variant_get(_v, '$.{p}', 'string')"))
                               .otherwise(j)).alias(p))
    links = F.when(F.col("type") == "thought",
                   F.coalesce(F.size(F.expr("try_variant_get(_v, '$.links_to', 'array<variant>')")), F.lit(0)).cast("long"))
    eid = F.coalesce(F.col("event_id"), F.concat(F.lit("ev-"), F.sha2(F.concat_ws("/", "trace_id", F.col("seq").cast("string")), 256)))
    return ev.select("trace_id", eid.alias("event_id"), "seq", "actor_kind", F.lit(None).cast("string").alias("actor_id"),
                     "payload_json", *cols, links.alias("n_links"))


@query("blob_store_roundtrip", with_views("""
SELECT e.event_id, e.blob_id, substring(e.blob_id, 8, 2) AS shard, CAST(octet_length(encode(b.content)) AS BIGINT) AS byte_length
FROM tel_events e JOIN (SELECT blob_id, min(content) AS content FROM tel_blobs GROUP BY blob_id) b USING (blob_id)""",
                                            "tel_events", "tel_blobs"))
def blob_store_roundtrip(spark, sf):
    """Write deduplicated blobs to the shard-partitioned store, then
    fetch the content every event references (partition-pruned by shard)."""
    rows = BL.blob_rows(B.tel_blobs(spark, sf))
    first = BL.first_writer_rows(rows, ["source_key"])
    path = scratch_path(spark, f"tw-blobstore-{uuid.uuid4().hex}")
    BL.write_store(first, path, mode="overwrite")
    ev = B.tel_events(spark, sf).select("event_id", "blob_id")
    found = BL.read_content(spark, path, ev).select("blob_id", "byte_length")
    return ev.join(found, "blob_id").select("event_id", "blob_id", shard_of(F.col("blob_id")).alias("shard"),
                                            "byte_length")
