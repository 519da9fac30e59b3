"""Lifecycle queries: registration, finalize, QA stages, gate, trace documents
(S1, S3, S8, S10, P8, P12, Q1-Q8, T1-T5, J1, J6, A7, A9)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tracewright.operators import lifecycle as LC
from tracewright.operators.qa_store import QaStore, apply_judge, apply_tests
from tracewright.operators.timeline import PART_EVENTS, ordered_join, part_no
from tracewright.plans import q_judge, q_packet
from tracewright.plans.oracle_views import with_views
from tracewright.plans.q_validate import _duck_explode, duck_doc_array
from tracewright.plans.registry import query
from tracewright.schemas import FINALIZE_RULES, SCORE_NAMES
from tracewright.session import scratch_path
from tracewright.sources import bindings as B

NOW_MS = 1_800_000_000_000  # finalize time stamp used in replay (a plan parameter)

_REGISTERED = q_packet._REG.replace(
    "SELECT t.trace_id,",
    "SELECT t.trace_id, t.created_at_ms, b.body_json,")

_TESTS = """
SELECT trace_id, arg_max(command, (ts_ms, invocation_id)) AS runner, CAST(count(*) AS BIGINT) AS n_invocations,
       arg_max(exit_code = 0, (ts_ms, invocation_id)) AS final_passed,
       CAST(sum(CASE WHEN exit_code = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_passed
FROM tel_test_runs GROUP BY trace_id"""

_PIPE = """
SELECT t.trace_id, t.status AS status_before,
       CASE WHEN t.status <> 'finalizing' THEN t.status
            WHEN q.trace_id IS NULL OR coalesce(j.outcome, '') <> 'ok' THEN 'failed' ELSE 'complete' END AS status,
       q.trace_id IS NOT NULL AS has_tests, j.outcome AS judge_outcome,
       CASE WHEN t.status <> 'finalizing' THEN NULL WHEN q.trace_id IS NULL THEN 'tests'
            WHEN coalesce(j.outcome, '') <> 'ok' THEN 'judge' END AS failed_stage,
       CASE WHEN t.status = 'finalizing' THEN q.trace_id IS NOT NULL END AS schema_valid,
       CASE WHEN t.status <> 'finalizing' THEN NULL WHEN q.trace_id IS NULL THEN 'no test invocations'
            WHEN j.outcome IS NULL THEN 'no judge response' WHEN j.outcome <> 'ok' THEN concat('judge ', j.outcome) END AS error
FROM tel_traces t LEFT JOIN lc_tests q USING (trace_id) LEFT JOIN jg_out j USING (trace_id)"""

_EXTRA = dict(q_judge._EXTRA)
_EXTRA.update({"pk_reg": _REGISTERED, "pk_finals": q_packet._FINALS, "lc_tests": _TESTS, "lc_stages": _PIPE})


def _sql(body: str) -> str:
    return with_views(body, "tel_traces", "tel_trace_bodies", "tel_test_runs", "tel_judge_raw", "tel_events",
                      "tel_finalize_bodies", extra=_EXTRA)


def _tests(spark, sf):
    return LC.qa_tests(LC.test_invocations(B.tel_test_runs(spark, sf)))


def _judge(spark, sf):
    return q_judge._parsed(spark, sf).select("trace_id", "outcome")


@query("trace_register", _sql("""
SELECT trace_id, '1.0' AS trace_version, 'collecting' AS status, created_at_ms,
       json_extract_string(body_json, '$.repo.repo_id') AS repo_id, json_extract_string(body_json, '$.repo.commit_base') AS commit_base,
       title, description, repro_steps, json_extract_string(body_json, '$.developer.developer_id') AS developer_id,
       coalesce(json_extract_string(body_json, '$.developer.experience_level'), 'unknown') AS experience_level,
       json_extract_string(body_json, '$.environment.ide.name') AS ide_name,
       coalesce(CAST(json_extract(body_json, '$.environment.containerized') AS BOOLEAN), false) AS containerized
FROM pk_reg"""))
def trace_register(spark, sf):
    """Valid create bodies become normalized trace rows."""
    return q_packet.registered(spark, sf).select(
        "trace_id", "trace_version", "status", "created_at_ms", "repo_id", "commit_base", "title", "description",
        "repro_steps", "developer_id", "experience_level", "ide_name", "containerized")


@query("finalize_apply", _sql(f"""
SELECT f.trace_id, o AS outcome, CASE o WHEN 'schema' THEN 400 WHEN 'missing' THEN 404 WHEN 'state' THEN 409 ELSE 200 END AS http_status,
       CASE WHEN o = 'ok' THEN 'finalizing' ELSE t_status END AS status,
       CASE WHEN o = 'ok' THEN CAST({NOW_MS} AS BIGINT) END AS finalized_at_ms,
       CASE WHEN o = 'ok' THEN json_extract_string(body_json, '$.final_state.commit_head') END AS commit_head,
       CASE WHEN o = 'ok' THEN coalesce(json_type(body_json, '$.final_state.pr') = 'OBJECT', false) END AS pr_present
FROM (SELECT f.*, t.status AS t_status,
             CASE WHEN f.trace_id IN (SELECT trace_id FROM ({_duck_explode("tel_finalize_bodies", "trace_id", duck_doc_array(FINALIZE_RULES, "body_json"))}) v) THEN 'schema'
                  WHEN t.trace_id IS NULL THEN 'missing' WHEN t.status <> 'collecting' THEN 'state' ELSE 'ok' END AS o
      FROM tel_finalize_bodies f LEFT JOIN tel_traces t USING (trace_id)) f"""))
def finalize_apply(spark, sf):
    """Finalize requests -> outcome, new status, final state."""
    r = LC.finalize_outcomes(B.tel_finalize_bodies(spark, sf), B.tel_traces(spark, sf), NOW_MS)
    return r.select("trace_id", "outcome", "http_status", "status", "finalized_at_ms", "commit_head", "pr_present")


@query("test_invocation_records", _sql("""
SELECT trace_id, invocation_id, exit_code = 0 AS passed, duration_ms,
       CASE WHEN coalesce(stdout, '') <> '' THEN concat('sha256:', sha256(stdout)) END AS stdout_blob_id,
       CASE WHEN coalesce(stderr, '') <> '' THEN concat('sha256:', sha256(stderr)) END AS stderr_blob_id
FROM tel_test_runs"""))
def test_invocation_records(spark, sf):
    """Invocation records with outputs as content-addressed blobs."""
    return LC.test_invocations(B.tel_test_runs(spark, sf)).select(
        "trace_id", "invocation_id", "passed", "duration_ms", "stdout_blob_id", "stderr_blob_id")


@query("test_results", _sql("SELECT trace_id, runner, n_invocations, final_passed, n_passed FROM lc_tests"))
def test_results(spark, sf):
    """QA test section per trace."""
    return _tests(spark, sf).select("trace_id", "runner", "n_invocations", "final_passed", "n_passed")


@query("qa_stages", _sql("SELECT * FROM lc_stages"))
def qa_stages(spark, sf):
    """Q5/Q6/Q8: run_tests -> run_judge -> finalize_qa over every trace."""
    return LC.qa_stages(B.tel_traces(spark, sf), _tests(spark, sf), _judge(spark, sf))


@query("status_transitions", _sql("""
SELECT status_before, status, CAST(count(*) AS BIGINT) AS n FROM lc_stages GROUP BY status_before, status"""))
def status_transitions(spark, sf):
    """Q6: counts of status moves made by the QA stages."""
    p = LC.qa_stages(B.tel_traces(spark, sf), _tests(spark, sf), _judge(spark, sf))
    return p.groupBy("status_before", "status").agg(F.count(F.lit(1)).alias("n"))


@query("completeness_gate", _sql("""
SELECT t.trace_id, CASE WHEN q.trace_id IS NOT NULL AND j.trace_id IS NOT NULL THEN 'complete' ELSE 'finalizing' END AS status,
       CASE WHEN q.trace_id IS NULL AND j.trace_id IS NULL THEN 'has no QA data' WHEN q.trace_id IS NULL THEN 'missing qa.tests'
            WHEN j.trace_id IS NULL THEN 'missing qa.judge' END AS gate_error
FROM tel_traces t LEFT JOIN lc_tests q USING (trace_id) LEFT JOIN (SELECT trace_id FROM jg_out WHERE outcome = 'ok') j USING (trace_id)
WHERE t.status = 'finalizing'"""))
def completeness_gate(spark, sf):
    """Q4: the gate alone, in its error order."""
    return LC.completeness_gate(B.tel_traces(spark, sf), _tests(spark, sf), _judge(spark, sf))


@query("qa_merge", _sql(f"""
SELECT t.trace_id, q.runner, q.final_passed, r.overall AS judge_overall, array_to_string(r.flags, ',') AS judge_flags,
       CASE WHEN r.trace_id IS NOT NULL THEN '1.0' END AS rubric_version
FROM tel_traces t LEFT JOIN lc_tests q USING (trace_id) LEFT JOIN jg_results r USING (trace_id)"""))
def qa_merge(spark, sf):
    """Tests and judge sections upserted into one QA record per trace."""
    r = q_judge._results(spark, sf)
    return (B.tel_traces(spark, sf).select("trace_id")
            .join(_tests(spark, sf).select("trace_id", "runner", "final_passed"), "trace_id", "left")
            .join(r.select("trace_id", F.col("overall").alias("judge_overall"),
                           F.array_join("flags", ",").alias("judge_flags"), "rubric_version"), "trace_id", "left"))


def _doc_spark(spark, sf, include_events: bool, include_qa: bool):
    tr = q_packet.registered(spark, sf).join(B.tel_traces(spark, sf).select("trace_id", F.col("status").alias("_st")),
                                             "trace_id").withColumn("status", F.col("_st")).drop("_st")
    judge = q_judge._results(spark, sf).withColumn("outcome", F.lit("ok"))
    return LC.trace_documents(tr, B.tel_events(spark, sf), q_packet.finals(spark, sf), _tests(spark, sf), judge,
                              include_events=include_events, include_qa=include_qa)


_DOC_BASE = """
SELECT r.trace_id, '1.0' AS trace_version, t.status, r.created_at_ms, r.title, f.commit_head AS final_commit_head"""


@query("trace_document", _sql(_DOC_BASE + """,
       CAST(coalesce(e.n, 0) AS BIGINT) AS n_events, e.seq_high, q.final_passed, q.n_invocations, j.overall AS judge_overall
FROM pk_reg r JOIN tel_traces t USING (trace_id) LEFT JOIN pk_finals f USING (trace_id)
LEFT JOIN (SELECT trace_id, count(*) AS n, max(seq) AS seq_high FROM tel_events GROUP BY trace_id) e USING (trace_id)
LEFT JOIN lc_tests q USING (trace_id) LEFT JOIN jg_results j USING (trace_id)"""))
def trace_document(spark, sf):
    """Trace header with event count, final state and QA."""
    return _doc_spark(spark, sf, True, True)


@query("trace_document_no_events", _sql(_DOC_BASE + """,
       CAST(0 AS BIGINT) AS n_events, CAST(NULL AS INT) AS seq_high, CAST(NULL AS BOOLEAN) AS final_passed,
       CAST(NULL AS BIGINT) AS n_invocations, CAST(NULL AS DOUBLE) AS judge_overall
FROM pk_reg r JOIN tel_traces t USING (trace_id) LEFT JOIN pk_finals f USING (trace_id)"""))
def trace_document_no_events(spark, sf):
    """include_events=false, include_qa=false (no events scan, no QA joins)."""
    return _doc_spark(spark, sf, False, False)


@query("trace_event_parts", _sql(f"""
SELECT e.trace_id, CAST((seq - 1) // {PART_EVENTS} AS INT) AS part_no, CAST(count(*) AS BIGINT) AS n_events,
       string_agg(concat_ws('|', seq, event_id, ts_ms, type, actor_kind, payload_json), chr(10) ORDER BY seq) AS events_text
FROM tel_events e WHERE e.trace_id IN (SELECT trace_id FROM pk_reg) GROUP BY e.trace_id, (seq - 1) // {PART_EVENTS}"""))
def trace_event_parts(spark, sf):
    """The document's ordered event list, in bounded parts."""
    ev = B.tel_events(spark, sf).join(q_packet.registered(spark, sf).select("trace_id"), "trace_id", "left_semi")
    line = F.concat_ws("|", F.col("seq").cast("string"), "event_id", F.col("ts_ms").cast("string"), "type",
                       "actor_kind", "payload_json")
    return (ev.withColumn("part_no", part_no(F.col("seq"))).groupBy("trace_id", "part_no")
            .agg(F.count(F.lit(1)).alias("n_events"), ordered_join(line, F.col("seq")).alias("events_text")))


_ACCEPT = " ".join(f"WHEN NOT (r.{n} BETWEEN 0 AND 5) THEN 'score {n} out of range'" for n in SCORE_NAMES)


@query("trace_acceptance", _sql(f"""
SELECT p.trace_id, CASE WHEN q.trace_id IS NULL THEN 'missing qa.tests' WHEN r.trace_id IS NULL THEN 'missing qa.judge'
            WHEN q.final_passed IS NULL THEN 'final_passed not boolean' {_ACCEPT}
            WHEN NOT (r.overall BETWEEN 0 AND 5) THEN 'overall out of range'
            WHEN r.rationale_blob_id IS NULL THEN 'missing rationale blob' ELSE 'ok' END AS verdict
FROM lc_stages p LEFT JOIN lc_tests q USING (trace_id) LEFT JOIN jg_results r USING (trace_id)
WHERE p.status = 'complete'"""))
def trace_acceptance(spark, sf):
    """T5: acceptance checks on traces the QA stages completed; first failing rule."""
    tests, res = _tests(spark, sf), q_judge._results(spark, sf)
    done = LC.qa_stages(B.tel_traces(spark, sf), tests, _judge(spark, sf)).where(F.col("status") == "complete")
    x = done.select("trace_id").join(tests, "trace_id", "left").join(
        res.select("trace_id", *SCORE_NAMES, "overall", "rationale_blob_id", F.lit(True).alias("_j")), "trace_id", "left")
    v = F.when(F.col("n_invocations").isNull(), "missing qa.tests").when(F.col("_j").isNull(), "missing qa.judge") \
         .when(F.col("final_passed").isNull(), "final_passed not boolean")
    for n in SCORE_NAMES:
        v = v.when(~F.col(n).between(0, 5), f"score {n} out of range")
    v = v.when(~F.col("overall").between(0, 5), "overall out of range") \
         .when(F.col("rationale_blob_id").isNull(), "missing rationale blob").otherwise("ok")
    return x.select("trace_id", v.alias("verdict"))


_NO = "CAST(NULL AS VARCHAR)"
_BOOL = "coalesce(lower(json_extract_string(body_json, '$.{p}')) IN ('1', 'on', 't', 'true', 'y', 'yes'), {d})"
_DOC_FLAT = f"""
SELECT r.trace_id, '1.0' AS trace_version, t.status, r.created_at_ms,
       json_extract_string(body_json, '$.repo.repo_id') AS repo_id, json_extract_string(body_json, '$.repo.remote_url') AS remote_url,
       json_extract_string(body_json, '$.repo.repo_fingerprint.tree_hash') AS tree_hash, json_extract_string(body_json, '$.task.task_id') AS task_id,
       r.title, r.expected, coalesce(array_to_string(json_extract_string(body_json, '$.task.bug_report.links[*]'), ','), '') AS links,
       array_to_string(json_extract_string(body_json, '$.task.labels[*]'), ',') AS labels,
       {_BOOL.format(p='developer.consent_flags.store_raw_code', d='true')} AS store_raw_code,
       {_BOOL.format(p='developer.consent_flags.allow_llm_judge', d='true')} AS allow_llm_judge,
       json_extract_string(body_json, '$.environment.os') AS os, json_extract_string(body_json, '$.environment.ide.version') AS ide_version,
       json_extract_string(body_json, '$.environment.timezone') AS timezone, f.commit_head, f.pr_title, q.runner, q.n_invocations, q.final_passed,
       j.overall, j.clarity, j.rationale_blob_id, true AS ingestion_null,
       CASE WHEN q.trace_id IS NOT NULL OR j.trace_id IS NOT NULL OR s.schema_valid IS NOT NULL THEN coalesce(s.schema_valid, true) END AS schema_valid
FROM pk_reg r JOIN tel_traces t USING (trace_id) LEFT JOIN pk_finals f USING (trace_id) LEFT JOIN lc_tests q USING (trace_id) LEFT JOIN jg_results j USING (trace_id)
LEFT JOIN lc_stages s USING (trace_id)"""


@query("trace_document_store", _sql(_DOC_FLAT))
def trace_document_store(spark, sf):
    """Nested documents written to the shared folder and read back, sections flattened for comparison."""
    tr = (q_packet.registered(spark, sf).drop("status").join(B.tel_traces(spark, sf).select("trace_id", "status"), "trace_id"))
    path = scratch_path(spark, f"tw-documents-{uuid.uuid4().hex}")
    valid = LC.qa_stages(B.tel_traces(spark, sf), _tests(spark, sf), _judge(spark, sf)).select("trace_id", "schema_valid")
    LC.nested_documents(tr, q_packet.finals(spark, sf), _tests(spark, sf), q_judge._results(spark, sf), valid).write.parquet(path)
    d = spark.read.parquet(path)
    return d.select("trace_id", "trace_version", "status", "created_at_ms", "repo.repo_id", "repo.remote_url", "repo.repo_fingerprint.tree_hash",
                    "task.task_id", "task.bug_report.title", "task.bug_report.expected", F.array_join("task.bug_report.links", ",").alias("links"),
                    F.array_join("task.labels", ",").alias("labels"), "developer.consent_flags.store_raw_code", "developer.consent_flags.allow_llm_judge",
                    "environment.os", F.col("environment.ide.version").alias("ide_version"), "environment.timezone", "final_state.commit_head",
                    F.col("final_state.pr.title").alias("pr_title"), "qa.tests.runner", "qa.tests.n_invocations", "qa.tests.final_passed", "qa.judge.overall",
                    F.col("qa.judge.scores.clarity").alias("clarity"), "qa.judge.rationale_blob_id", F.col("ingestion").isNull().alias("ingestion_null"), "qa.schema_valid")


@query("trace_event_arrays", _sql(f"""
SELECT trace_id, CAST((seq - 1) // {PART_EVENTS} AS INT) AS part_no, CAST(row_number() OVER (PARTITION BY trace_id, (seq - 1) // {PART_EVENTS} ORDER BY seq) - 1 AS INT) AS nth,
       seq, event_id, ts_ms, type, actor_kind, payload_json FROM tel_events"""))
def trace_event_arrays(spark, sf):
    """Events as arrays of typed structs in bounded parts, exploded with their positions for comparison."""
    p = LC.event_parts(B.tel_events(spark, sf))
    return p.select("trace_id", "part_no", F.posexplode("events").alias("nth", "e")).select(
        "trace_id", "part_no", "nth", "e.seq", "e.event_id", "e.ts_ms", "e.type", F.col("e.actor.kind").alias("actor_kind"), F.col("e.payload").alias("payload_json"))


@query("qa_upsert", _sql("""
SELECT t.trace_id, CASE WHEN q.trace_id IS NOT NULL THEN q.runner WHEN n % 4 = 0 THEN 'stored' END AS runner,
       CASE WHEN q.trace_id IS NOT NULL THEN q.n_invocations WHEN n % 4 = 0 THEN CAST(1 AS BIGINT) END AS n_invocations,
       CASE WHEN j.trace_id IS NOT NULL THEN j.overall WHEN n % 3 = 0 THEN CAST(1.5 AS DOUBLE) END AS overall
FROM (SELECT *, CAST(substring(trace_id, 3) AS BIGINT) AS n FROM tel_traces) t LEFT JOIN lc_tests q USING (trace_id) LEFT JOIN jg_results j USING (trace_id)"""))
def qa_upsert(spark, sf):
    """New test and judge sections upserted onto stored ones (kept where no new one came)."""
    n = F.substring("trace_id", 3, 1 << 20).cast("bigint")
    section = lambda runner, count: F.struct(runner.alias("runner"), count.alias("n_invocations"))
    tr = B.tel_traces(spark, sf)
    stored = tr.select("trace_id", F.when(n % 4 == 0, section(F.lit("stored"), F.lit(1).cast("long"))).alias("tests"),
                       F.when(n % 3 == 0, F.struct(F.lit(1.5).alias("overall"))).alias("judge"))
    tests = _tests(spark, sf).select("trace_id", section(F.col("runner"), F.col("n_invocations")).alias("tests"))
    judge = q_judge._results(spark, sf).select("trace_id", F.struct("overall").alias("judge"))
    return (LC.upsert_qa(stored, tests, judge).join(tr.select("trace_id"), "trace_id", "left_semi")
            .select("trace_id", "tests.runner", "tests.n_invocations", "judge.overall"))


@query("qa_stored_stages", _sql("""
SELECT s.trace_id, s.status, s.schema_valid, s.error, CASE WHEN s.has_tests AND s.status_before = 'finalizing' THEN q.runner END AS runner,
       CASE WHEN s.has_tests AND s.status_before = 'finalizing' THEN q.n_invocations END AS n_invocations,
       CASE WHEN s.has_tests AND s.status_before = 'finalizing' AND s.judge_outcome = 'ok' THEN j.overall END AS overall
FROM lc_stages s LEFT JOIN lc_tests q USING (trace_id) LEFT JOIN jg_results j USING (trace_id)"""))
def qa_stored_stages(spark, sf):
    """The test stage and then the judge stage change the stored QA records, which are read back."""
    store = QaStore(spark, scratch_path(spark, f"tw-qa-{uuid.uuid4().hex}")).create(B.tel_traces(spark, sf))
    apply_tests(store, _tests(spark, sf).select("trace_id", "runner", "n_invocations", "final_passed"))
    section = F.struct("model", "rubric_version", "overall", "rationale_blob_id", "flags")
    apply_judge(store, _judge(spark, sf).join(q_judge._results(spark, sf).select("trace_id", section.alias("judge")), "trace_id", "left"))
    return store.records().select("trace_id", "status", "schema_valid", "error", "tests.runner", "tests.n_invocations", "judge.overall")


@query("judge_rationale_blobs", _sql("""
SELECT DISTINCT rationale_blob_id AS blob_id, rationale AS content, 'text/plain' AS content_type, CAST(octet_length(encode(rationale)) AS BIGINT) AS byte_length
FROM jg_results WHERE rationale_blob_id NOT IN (SELECT concat('sha256:', sha256(text)) FROM documents)"""))
def judge_rationale_blobs(spark, sf):
    """Rationales as blobs to append, those not stored yet (first writer per content)."""
    from tracewright.operators import blobs as BL
    texts = q_judge._results(spark, sf).select("trace_id", F.col("rationale").alias("content"), F.lit("text/plain").alias("content_type"))
    rows = BL.first_writer_rows(BL.blob_rows(texts), ["trace_id"])
    return BL.new_only(rows, B.tel_blobs(spark, sf)).select("blob_id", "content", "content_type", "byte_length")
