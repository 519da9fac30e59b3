"""Judge packet queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracewright.operators import lifecycle as LC
from tracewright.operators import packet as PK
from tracewright.operators.popular import join_references
from tracewright.plans.oracle_views import with_views
from tracewright.plans.q_validate import _duck_explode, duck_doc_array
from tracewright.plans.registry import query
from tracewright.schemas import FINALIZE_RULES, TRACE_CREATE_RULES
from tracewright.sources import bindings as B
from tracewright.operators.timeline import PART_EVENTS


def _pv(p: str, default: str) -> str:
    j = f"json_extract(payload_json, '$.{p}')"
    t = f"json_type(payload_json, '$.{p}')"
    return (f"(CASE WHEN {j} IS NULL THEN '{default}' WHEN {t} = 'NULL' THEN 'None' "
            f"WHEN {t} = 'BOOLEAN' THEN CASE WHEN json_extract_string(payload_json, '$.{p}') = 'true' THEN 'True' ELSE 'False' END "
            f"WHEN {t} = 'VARCHAR' THEN json_extract_string(payload_json, '$.{p}') ELSE CAST({j} AS VARCHAR) END)")


def _prev(n: int) -> str:
    return f"CASE WHEN length(b.content) > {n} THEN concat(substring(b.content, 1, {n}), '...') ELSE b.content END"


_PREVIEWS = """
SELECT blob_id, min(content) AS content FROM tel_blobs WHERE content <> '' GROUP BY blob_id"""

_LINES = f"""
SELECT e.trace_id, e.seq, CASE e.type
  WHEN 'file_edit' THEN concat(pre, '**file_edit**: `', {_pv('file_path', 'N/A')}, '` (', {_pv('edit_kind', 'N/A')}, ')')
  WHEN 'thought' THEN concat(pre, '**thought** (', {_pv('kind', 'N/A')}, '): ',
                             coalesce({_prev(500)}, concat('[blob: ', {_pv('content_blob_id', '')}, ']')))
  WHEN 'test_run' THEN concat(pre, '**test_run**: `', {_pv('command', 'N/A')}, '` (exit_code=', {_pv('exit_code', 'N/A')},
                              ', passed=', {_pv('passed', 'False')}, ', duration=', {_pv('duration_ms', '0')}, 'ms)')
  WHEN 'terminal_command' THEN concat(pre, '**terminal_command**: `', {_pv('command', 'N/A')}, '` (cwd: ', {_pv('cwd', 'N/A')}, ')')
  WHEN 'terminal_output' THEN concat(pre, '**terminal_output** (', {_pv('stream', 'N/A')}, '): ',
                                     coalesce({_prev(200)}, concat('[truncated=', {_pv('is_truncated', 'False')}, ']')))
  WHEN 'commit' THEN concat(pre, '**commit**: ', substring({_pv('commit_sha', 'N/A')}, 1, 12), ' - ', substring({_pv('message', '')}, 1, 100))
  WHEN 'error' THEN concat(pre, '**error**: ', {_pv('error_type', 'N/A')}, ': ', substring({_pv('message', '')}, 1, 100))
  END AS line
FROM (SELECT *, concat('[seq=', seq, ', ts=', ts_ms, '] ') AS pre,
             CASE WHEN type = 'thought' AND json_type(payload_json, '$.content_blob_id') = 'VARCHAR' THEN json_extract_string(payload_json, '$.content_blob_id')
                  WHEN type = 'terminal_output' AND json_type(payload_json, '$.chunk_blob_id') = 'VARCHAR' THEN json_extract_string(payload_json, '$.chunk_blob_id') END AS bkey
      FROM tel_events WHERE type IN ('file_edit', 'thought', 'test_run', 'terminal_command', 'terminal_output', 'commit', 'error')) e
LEFT JOIN pk_previews b ON b.blob_id = e.bkey"""

_REG = f"""
SELECT t.trace_id, json_extract_string(b.body_json, '$.task.bug_report.title') AS title,
       json_extract_string(b.body_json, '$.task.bug_report.description') AS description,
       json_extract_string(b.body_json, '$.task.bug_report.repro_steps') AS repro_steps,
       json_extract_string(b.body_json, '$.task.bug_report.expected') AS expected,
       json_extract_string(b.body_json, '$.task.bug_report.actual') AS actual
FROM tel_traces t JOIN tel_trace_bodies b USING (trace_id)
WHERE b.trace_id NOT IN (SELECT trace_id FROM ({_duck_explode("tel_trace_bodies", "trace_id", duck_doc_array(TRACE_CREATE_RULES, "body_json"))}) v)"""

_FINALS = f"""
SELECT trace_id, json_extract_string(body_json, '$.final_state.commit_head') AS commit_head,
       coalesce(json_type(body_json, '$.final_state.pr') = 'OBJECT', false) AS pr_present,
       json_extract_string(body_json, '$.final_state.pr.title') AS pr_title,
       json_extract_string(body_json, '$.final_state.pr.description') AS pr_description,
       json_extract_string(body_json, '$.final_state.pr.diff_blob_id') AS pr_diff_blob_id
FROM tel_finalize_bodies
WHERE trace_id NOT IN (SELECT trace_id FROM ({_duck_explode("tel_finalize_bodies", "trace_id", duck_doc_array(FINALIZE_RULES, "body_json"))}) v)"""

_TESTS = """
SELECT trace_id, concat_ws(chr(10), concat('**Runner:** ', arg_max(command, (ts_ms, invocation_id))),
                           concat('**Final passed:** ', CASE WHEN arg_max(exit_code = 0, (ts_ms, invocation_id)) THEN 'True' ELSE 'False' END),
                           string_agg(CASE WHEN rk <= 5 THEN concat('- Invocation ', rk, ': command=`', command, '`, exit_code=', exit_code,
                                                                   ', passed=', CASE WHEN exit_code = 0 THEN 'True' ELSE 'False' END,
                                                                   ', duration_ms=', duration_ms) END, chr(10) ORDER BY rk)) AS tests_text
FROM (SELECT *, row_number() OVER (PARTITION BY trace_id ORDER BY ts_ms, invocation_id) AS rk FROM tel_test_runs) r
GROUP BY trace_id"""

_PARTS = f"""
SELECT trace_id, 0 AS part_no,
       concat_ws(chr(10), '## Bug Report', concat('**Title:** ', coalesce(title, 'N/A')), concat('**Description:** ', coalesce(description, 'N/A')),
                 CASE WHEN coalesce(repro_steps, '') <> '' THEN concat('**Repro Steps:** ', repro_steps) END,
                 CASE WHEN coalesce(expected, '') <> '' THEN concat('**Expected:** ', expected) END,
                 CASE WHEN coalesce(actual, '') <> '' THEN concat('**Actual:** ', actual) END,
                 '', '## Developer Actions (ordered by sequence)') AS text
FROM pk_reg
UNION ALL
SELECT l.trace_id, CAST((seq - 1) // {PART_EVENTS} + 1 AS INT), string_agg(line, chr(10) ORDER BY seq)
FROM pk_lines l WHERE l.trace_id IN (SELECT trace_id FROM pk_reg) GROUP BY l.trace_id, (seq - 1) // {PART_EVENTS}
UNION ALL
SELECT r.trace_id, {PK.LAST_PART},
       concat_ws(chr(10), '', '## Final State',
                 CASE WHEN f.trace_id IS NULL THEN 'No final state recorded.'
                      ELSE nullif(concat_ws(chr(10),
                          CASE WHEN coalesce(f.commit_head, '') <> '' THEN concat('**Final commit:** ', f.commit_head) END,
                          CASE WHEN f.pr_present AND coalesce(f.pr_title, '') <> '' THEN concat('**PR Title:** ', f.pr_title) END,
                          CASE WHEN f.pr_present AND coalesce(f.pr_description, '') <> '' THEN concat('**PR Description:** ', f.pr_description) END,
                          CASE WHEN f.pr_present AND coalesce(f.pr_diff_blob_id, '') <> '' THEN concat('**Diff blob:** ', f.pr_diff_blob_id) END), '') END,
                 '', '## Test Results', coalesce(t.tests_text, 'No test results recorded.'))
FROM pk_reg r LEFT JOIN pk_finals f USING (trace_id) LEFT JOIN pk_tests t USING (trace_id)"""

_EXTRA = {"pk_previews": _PREVIEWS, "pk_lines": _LINES, "pk_reg": _REG, "pk_finals": _FINALS, "pk_tests": _TESTS}
_NEEDS = ("tel_events", "tel_blobs", "tel_traces", "tel_trace_bodies", "tel_finalize_bodies", "tel_test_runs")


def _packet_sql(body: str) -> str:
    return with_views(body, *_NEEDS, extra=_EXTRA)


def registered(spark, sf):
    """Stored traces: valid create bodies, normalized (written once)."""
    def build():
        tr = B.tel_traces(spark, sf).select("trace_id", "created_at_ms")
        return LC.register_traces(B.tel_trace_bodies(spark, sf), tr)
    return B.materialized(spark, sf, "registered_traces", build)


def finals(spark, sf):
    """Stored final states: valid finalize bodies, normalized (written once)."""
    return B.materialized(spark, sf, "final_states", lambda: LC.final_states(B.tel_finalize_bodies(spark, sf)))


def _runs(spark, sf):
    return LC.test_invocations(B.tel_test_runs(spark, sf))


@query("event_blob_preview", _packet_sql("""
SELECT e.event_id, e.blob_id, CASE WHEN length(b.content) > 500 THEN concat(substring(b.content, 1, 500), '...') ELSE b.content END AS p500,
       CASE WHEN length(b.content) > 200 THEN concat(substring(b.content, 1, 200), '...') ELSE b.content END AS p200
FROM tel_events e JOIN pk_previews b ON b.blob_id = e.blob_id WHERE e.type IN ('thought', 'terminal_output')"""))
def event_blob_preview(spark, sf):
    """Previews of the blobs thought and terminal_output events point at."""
    ev = B.tel_events(spark, sf).where(F.col("type").isin("thought", "terminal_output"))
    pv = PK.blob_previews(B.tel_blobs(spark, sf), ev.select("blob_id"))
    return ev.join(pv, "blob_id").select("event_id", "blob_id", "p500", "p200")


@query("popular_blob_preview", _packet_sql("""
SELECT e.event_id, e.blob_id, CASE WHEN length(b.content) > 200 THEN concat(substring(b.content, 1, 200), '...') ELSE b.content END AS p200
FROM (SELECT event_id, CASE WHEN CAST(substring(event_id, 4) AS BIGINT) % 3 = 0 THEN (SELECT arg_min(blob_id, source_key) FROM tel_blobs) ELSE blob_id END AS blob_id
      FROM tel_events) e LEFT JOIN pk_previews b ON b.blob_id = e.blob_id"""))
def popular_blob_preview(spark, sf):
    """J2 where every third event refers to one blob (the first uploaded): its preview is broadcast, the others meet by key."""
    blobs = B.tel_blobs(spark, sf)
    first = blobs.agg(F.min_by("blob_id", "source_key"))
    n = F.substring("event_id", 4, 1 << 20).cast("bigint")
    refs = B.tel_events(spark, sf).select("event_id", F.when(n % 3 == 0, first.scalar()).otherwise(F.col("blob_id")).alias("blob_id"))
    return join_references(refs, PK.blob_previews(blobs, refs).select("blob_id", "p200"), "blob_id", "event_id")


@query("packet_event_lines", _packet_sql("SELECT trace_id, seq, line FROM pk_lines"))
def packet_event_lines(spark, sf):
    ev = B.tel_events(spark, sf)
    refs = ev.select(F.coalesce(F.get_json_object("payload_json", "$.content_blob_id"),
                                F.get_json_object("payload_json", "$.chunk_blob_id")).alias("blob_id"))
    return PK.event_lines(ev, PK.blob_previews(B.tel_blobs(spark, sf), refs))


@query("judge_packet", _packet_sql(_PARTS))
def judge_packet(spark, sf):
    """Packet parts for every registered trace."""
    return PK.packet_parts(registered(spark, sf), B.tel_events(spark, sf), B.tel_blobs(spark, sf),
                           finals(spark, sf), _runs(spark, sf))


@query("packet_tests_section", _packet_sql("SELECT trace_id, tests_text FROM pk_tests"))
def packet_tests_section(spark, sf):
    """K11 + W2/O2 + A9: rendered test section (first five invocations)."""
    return PK.test_section(_runs(spark, sf))
