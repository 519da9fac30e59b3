"""Timeline queries: session_timeline (flagship), timeline_parts, lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracewright.operators import timeline as TL
from tracewright.plans.oracle_views import with_views
from tracewright.plans.registry import query
from tracewright.sources import bindings as B


@query("session_timeline", with_views("""
SELECT trace_id, CAST(count(*) AS BIGINT) AS n_events, CAST(coalesce(max(seq), 0) AS INT) AS seq_high,
       min(ts_ms) AS first_ts_ms, max(ts_ms) AS last_ts_ms, CAST(count(DISTINCT type) AS BIGINT) AS n_types,
       CAST(sum(CASE WHEN type = 'test_run' THEN 1 ELSE 0 END) AS BIGINT) AS n_test_runs
FROM tel_events GROUP BY trace_id""", "tel_events"))
def session_timeline(spark, sf):
    return TL.session_summary(B.tel_events(spark, sf))


@query("timeline_parts", with_views(f"""
SELECT trace_id, CAST((seq - 1) // {TL.PART_EVENTS} AS INT) AS part_no, CAST(count(*) AS BIGINT) AS n_events,
       min(seq) AS seq_lo, max(seq) AS seq_hi, string_agg(concat(seq, ':', type), ',' ORDER BY seq) AS timeline
FROM tel_events GROUP BY trace_id, (seq - 1) // {TL.PART_EVENTS}""", "tel_events"))
def timeline_parts(spark, sf):
    return TL.timeline_parts(B.tel_events(spark, sf))


@query("trace_lookup", with_views("""
SELECT trace_id, status, created_at_ms, bug_title, repro_steps FROM tel_traces WHERE trace_id = 't-42'""", "tel_traces"))
def trace_lookup(spark, sf):
    """F1/O3 on the stored trace table: the key filter reaches the scan."""
    return TL.trace_lookup(B.trace_table(spark, sf), "t-42")


@query("trace_event_slice", with_views("""
SELECT trace_id, event_id, seq, ts_ms, type, actor_kind, payload_json FROM tel_events WHERE trace_id = 't-42' AND seq BETWEEN 5 AND 30""", "tel_events"))
def trace_event_slice(spark, sf):
    """A trace's events by sequence from the stored event table; both filters reach the scan."""
    ev = B.event_table(spark, sf).where((F.col("trace_id") == "t-42") & F.col("seq").between(5, 30))
    return ev.select("trace_id", "event_id", "seq", "ts_ms", "type", "actor_kind", "payload_json")


@query("trace_events", with_views("""
SELECT e.trace_id, e.event_id, e.seq, e.ts_ms, e.type, e.actor_kind, e.payload_json
FROM tel_events e WHERE e.trace_id IN (SELECT trace_id FROM tel_traces WHERE status = 'collecting')""",
                                  "tel_events", "tel_traces"))
def trace_events(spark, sf):
    """F3 for every collecting trace (a set lookup, a semi join)."""
    ids = B.tel_traces(spark, sf).where(F.col("status") == "collecting")
    return TL.trace_events(B.tel_events(spark, sf), ids).select(
        "trace_id", "event_id", "seq", "ts_ms", "type", "actor_kind", "payload_json")
