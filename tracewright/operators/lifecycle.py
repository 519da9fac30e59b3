"""Trace lifecycle.

Registration, finalize, the QA stages and the completeness gate are
DataFrame stages chained per trace: a table of traces moves through
``run_tests -> run_judge -> finalize_qa`` as joins and ``when`` chains,
not a task queue.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.functions.hashing import content_address
from tracewright.functions.jsonrules import TRUE_WORDS
from tracewright.operators.timeline import PART_EVENTS
from tracewright.operators.validate import document_violations
from tracewright.schemas import FINALIZE_RULES, SCORE_NAMES, STORED_EVENT, TRACE_CREATE_RULES, TRACE_VERSION

INGESTION_TYPE = "struct<mode:string,client_session_id:string,seq_last:int,dedupe_policy:string,clock_skew_ms_est:int>"


def _js(doc: str, path: str) -> Column:
    """String field of a JSON document (NULL when absent or null)."""
    return F.get_json_object(F.col(doc), f"$.{path}")


def register_traces(bodies: DataFrame, created: DataFrame) -> DataFrame:
    """S1 + V1 + P8: valid trace-create bodies -> normalized trace rows.

    ``bodies``: (trace_id, body_json); ``created``: (trace_id, created_at_ms).
    Ids are the given keys (deterministic replay). Defaults are filled and
    unknown keys dropped, as the stored documents are normalized."""
    bad = document_violations(bodies, ["trace_id"], "body_json", TRACE_CREATE_RULES).select("trace_id").distinct()
    ok = bodies.join(bad, "trace_id", "left_anti")
    b = "body_json"
    doc = ok.join(created, "trace_id").withColumn("_v", F.expr(f"try_parse_json({b})"))

    def flag(path: str, default: bool) -> Column:
        """Booleans as the rules read them: true/false, 0/1 and the usual words."""
        word = F.lower(F.trim(F.expr(f"try_variant_get(_v, '$.{path}', 'string')")))
        return F.coalesce(word.isin(*TRUE_WORDS, "1.0"), F.lit(default))

    def strings(path: str) -> Column:
        return F.coalesce(F.expr(f"try_variant_get(_v, '$.{path}', 'array<string>')"), F.array().cast("array<string>"))

    return doc.select(
        "trace_id", F.lit(TRACE_VERSION).alias("trace_version"), F.lit("collecting").alias("status"),
        "created_at_ms",
        _js(b, "repo.repo_id").alias("repo_id"), _js(b, "repo.commit_base").alias("commit_base"),
        _js(b, "repo.remote_url").alias("remote_url"), _js(b, "repo.default_branch").alias("default_branch"),
        _js(b, "repo.repo_fingerprint.tree_hash").alias("tree_hash"),
        _js(b, "repo.repo_fingerprint.dependencies_lock_hash").alias("dependencies_lock_hash"),
        _js(b, "task.task_id").alias("task_id"),
        _js(b, "task.bug_report.title").alias("title"), _js(b, "task.bug_report.description").alias("description"),
        _js(b, "task.bug_report.repro_steps").alias("repro_steps"),
        _js(b, "task.bug_report.expected").alias("expected"), _js(b, "task.bug_report.actual").alias("actual"),
        strings("task.bug_report.links").alias("links"), strings("task.labels").alias("labels"),
        _js(b, "developer.developer_id").alias("developer_id"),
        F.coalesce(_js(b, "developer.experience_level"), F.lit("unknown")).alias("experience_level"),
        flag("developer.consent_flags.store_raw_code", True).alias("store_raw_code"),
        flag("developer.consent_flags.store_terminal_output", True).alias("store_terminal_output"),
        flag("developer.consent_flags.allow_llm_judge", True).alias("allow_llm_judge"),
        _js(b, "environment.os").alias("os"), _js(b, "environment.ide.name").alias("ide_name"),
        _js(b, "environment.ide.version").alias("ide_version"), strings("environment.language").alias("language"),
        flag("environment.containerized", False).alias("containerized"), _js(b, "environment.timezone").alias("timezone"))


def nested_documents(traces: DataFrame, finals: DataFrame, tests: DataFrame, judge: DataFrame, validity: DataFrame | None = None) -> DataFrame:
    """One nested document per trace: repo, task, developer,
    environment, final_state, qa, and null ingestion and artifacts, each
    section a typed struct. Events and invocations of a trace may be many and
    stand beside it in bounded parts (``event_parts``, ``invocation_parts``).
    ``validity``: (trace_id, schema_valid) as stored, false after a failed test
    stage; a QA section that says nothing of it is valid."""
    f = finals.select("trace_id", F.struct("commit_head", F.when(F.col("pr_present"), F.struct(
        F.col("pr_title").alias("title"), F.col("pr_description").alias("description"),
        F.col("pr_diff_blob_id").alias("diff_blob_id"))).alias("pr")).alias("final_state"))
    t = tests.select("trace_id", F.struct("runner", "container_image", "n_invocations", "final_passed").alias("tests"))
    j = judge.select("trace_id", F.struct("model", "rubric_version", F.struct(*SCORE_NAMES).alias("scores"), "overall",
                                          "rationale_blob_id", "flags").alias("judge"))
    doc = traces.join(f, "trace_id", "left").join(t, "trace_id", "left").join(j, "trace_id", "left")
    if validity is None:
        doc = doc.withColumn("_valid", F.lit(None).cast("boolean"))
    else:
        doc = doc.join(validity.select("trace_id", F.col("schema_valid").alias("_valid")), "trace_id", "left")
    qa = F.when(F.col("tests").isNotNull() | F.col("judge").isNotNull() | F.col("_valid").isNotNull(),
                F.struct(F.coalesce("_valid", F.lit(True)).alias("schema_valid"), "tests", "judge"))
    return doc.select(
        "trace_version", "trace_id", "created_at_ms", "status",
        F.struct("repo_id", "remote_url", "default_branch", "commit_base", F.struct("tree_hash", "dependencies_lock_hash").alias("repo_fingerprint")).alias("repo"),
        F.struct("task_id", F.struct("title", "description", "repro_steps", "expected", "actual", "links").alias("bug_report"), "labels").alias("task"),
        F.struct("developer_id", "experience_level", F.struct("store_raw_code", "store_terminal_output", "allow_llm_judge").alias("consent_flags")).alias("developer"),
        F.struct("os", F.struct(F.col("ide_name").alias("name"), F.col("ide_version").alias("version")).alias("ide"), "language", "containerized", "timezone").alias("environment"),
        F.lit(None).cast(INGESTION_TYPE).alias("ingestion"), F.lit(None).cast("map<string,string>").alias("artifacts"), "final_state", qa.alias("qa"))


def event_parts(events: DataFrame, size: int = PART_EVENTS) -> DataFrame:
    """A document's events as arrays of typed structs in the order of
    ``seq``, ``size`` sequence numbers a part: (trace_id, part_no, events).
    Stored events carry their actor and context; others have a kind only."""
    stored = "actor" in events.columns
    actor = F.col("actor") if stored else F.struct(F.col("actor_kind").alias("kind"), F.lit(None).cast("string").alias("id"))
    context = F.col("context") if stored else F.lit(None).cast(STORED_EVENT["context"].dataType)
    one = F.struct("seq", "event_id", "ts_ms", "type", actor.alias("actor"), context.alias("context"), F.col("payload_json").alias("payload"))
    return (events.withColumn("part_no", ((F.col("seq") - 1) / size).cast("int"))
            .groupBy("trace_id", "part_no").agg(F.array_sort(F.collect_list(one)).alias("events")))


def invocation_parts(invocations: DataFrame, width_ms: int = 3_600_000) -> DataFrame:
    """Q2: a trace's invocations as arrays of structs in the order of
    (ts_ms, invocation_id), an hour of time a part: (trace_id, part_no, invocations)."""
    one = F.struct("ts_ms", "invocation_id", "command", "exit_code", "duration_ms", "passed", "stdout_blob_id", "stderr_blob_id")
    return (invocations.withColumn("part_no", F.floor(F.col("ts_ms") / width_ms).cast("long"))
            .groupBy("trace_id", "part_no").agg(F.array_sort(F.collect_list(one)).alias("invocations")))


def upsert_qa(existing: DataFrame, tests: DataFrame, judge: DataFrame) -> DataFrame:
    """QA sections merged by trace: a new section replaces the stored
    one, a missing one leaves it as it is. ``existing`` has (trace_id, tests,
    judge) structs, either may be null; ``tests`` and ``judge`` have (trace_id,
    tests) and (trace_id, judge)."""
    new = tests.withColumnRenamed("tests", "_t").join(judge.withColumnRenamed("judge", "_j"), "trace_id", "full")
    return existing.join(new, "trace_id", "full").select(
        "trace_id", F.coalesce("_t", "tests").alias("tests"), F.coalesce("_j", "judge").alias("judge"))


def finalize_outcomes(requests: DataFrame, traces: DataFrame, now_ms: int) -> DataFrame:
    """Q7 + S3 + V2 + V15 + V16: finalize requests against trace status.

    Outcome precedence: schema (400) > missing (404) > state (409) > ok (200).
    On ok: status -> finalizing, final_state normalized, finalized_at_ms."""
    bad = document_violations(requests, ["trace_id"], "body_json", FINALIZE_RULES) \
        .select("trace_id").distinct().withColumn("_bad", F.lit(True))
    r = (requests.join(bad, "trace_id", "left")
         .join(traces.select("trace_id", F.col("status").alias("_status")), "trace_id", "left"))
    outcome = (F.when(F.col("_bad"), F.lit("schema")).when(F.col("_status").isNull(), F.lit("missing"))
               .when(F.col("_status") != "collecting", F.lit("state")).otherwise(F.lit("ok")))
    ok = outcome == "ok"
    b = "body_json"
    pr_kind = F.expr(f"substring(to_json(try_variant_get(try_parse_json({b}), '$.final_state.pr', 'variant')), 1, 1)")
    return r.select(
        "trace_id", outcome.alias("outcome"),
        F.create_map(*[x for k, v in {"schema": 400, "missing": 404, "state": 409, "ok": 200}.items()
                       for x in (F.lit(k), F.lit(v))])[outcome].alias("http_status"),
        F.when(ok, F.lit("finalizing")).otherwise(F.col("_status")).alias("status"),
        F.when(ok, F.lit(now_ms).cast("long")).alias("finalized_at_ms"),
        F.when(ok, _js(b, "final_state.commit_head")).alias("commit_head"),
        F.when(ok, F.coalesce(pr_kind == "{", F.lit(False))).alias("pr_present"),
        F.when(ok, _js(b, "final_state.pr.title")).alias("pr_title"),
        F.when(ok, _js(b, "final_state.pr.description")).alias("pr_description"),
        F.when(ok, _js(b, "final_state.pr.diff_blob_id")).alias("pr_diff_blob_id"))


def final_states(requests: DataFrame) -> DataFrame:
    """Stored final states: valid finalize bodies, normalized."""
    bad = document_violations(requests, ["trace_id"], "body_json", FINALIZE_RULES).select("trace_id").distinct()
    ok = requests.join(bad, "trace_id", "left_anti")
    b = "body_json"
    pr_kind = F.expr(f"substring(to_json(try_variant_get(try_parse_json({b}), '$.final_state.pr', 'variant')), 1, 1)")
    return ok.select("trace_id", _js(b, "final_state.commit_head").alias("commit_head"),
                     F.coalesce(pr_kind == "{", F.lit(False)).alias("pr_present"),
                     _js(b, "final_state.pr.title").alias("pr_title"),
                     _js(b, "final_state.pr.description").alias("pr_description"),
                     _js(b, "final_state.pr.diff_blob_id").alias("pr_diff_blob_id"))


def test_invocations(runs: DataFrame) -> DataFrame:
    """Q1: run results -> invocation records. passed = (exit_code == 0);
    stdout/stderr become content-addressed blob ids, NULL when empty; P12
    duration as given, else ended_ms - started_ms where the runs have these."""
    def blob(c: str) -> Column:
        return F.when(F.col(c).isNotNull() & (F.length(c) > 0), content_address(F.col(c)))
    spent = F.col("duration_ms")
    if {"started_ms", "ended_ms"} <= set(runs.columns):
        spent = F.coalesce(spent, F.col("ended_ms") - F.col("started_ms"))
    return runs.select("trace_id", "invocation_id", "ts_ms", "command", "exit_code", spent.cast("long").alias("duration_ms"),
                       (F.col("exit_code") == 0).alias("passed"),
                       blob("stdout").alias("stdout_blob_id"), blob("stderr").alias("stderr_blob_id"))


def qa_tests(invocations: DataFrame, image: str | None = None) -> DataFrame:
    """Q2 + A9: per trace QA test section: runner, image, count, final_passed
    (passed of the latest invocation; a partial aggregate, skew-safe)."""
    order = F.struct("ts_ms", "invocation_id")
    return invocations.groupBy("trace_id").agg(
        F.max_by("command", order).alias("runner"),
        F.lit(image).cast("string").alias("container_image"),
        F.count(F.lit(1)).alias("n_invocations"),
        F.max_by("passed", order).alias("final_passed"),
        F.sum(F.when(F.col("passed"), 1).otherwise(0)).cast("long").alias("n_passed"))


def qa_stages(traces: DataFrame, tests: DataFrame, judge: DataFrame) -> DataFrame:
    """Q4/Q5/Q6/Q8: run_tests -> run_judge -> finalize_qa per finalizing trace,
    as chained column stages.

    ``tests``: traces with a QA test section; ``judge``: (trace_id, outcome).
    A test-stage failure (no invocation) marks the trace failed with
    schema_valid=false; a judge failure marks it failed and keeps
    schema_valid; otherwise the gate checks qa -> tests -> judge and sets
    complete. Traces not in ``finalizing`` are left unchanged."""
    t = traces.select("trace_id", "status")
    j = judge.select("trace_id", F.col("outcome").alias("judge_outcome"))
    x = (t.join(tests.select("trace_id", F.lit(True).alias("_t")), "trace_id", "left")
         .join(j, "trace_id", "left"))
    has_tests = F.coalesce(F.col("_t"), F.lit(False))
    in_qa = F.col("status") == "finalizing"
    judge_ok = F.coalesce(F.col("judge_outcome") == "ok", F.lit(False))
    failed_stage = (F.when(~in_qa, F.lit(None).cast("string"))
                    .when(~has_tests, F.lit("tests"))
                    .when(~judge_ok, F.lit("judge")))
    error = (F.when(~in_qa, F.lit(None).cast("string"))
             .when(~has_tests, F.lit("no test invocations"))
             .when(F.col("judge_outcome").isNull(), F.lit("no judge response"))
             .when(~judge_ok, F.concat(F.lit("judge "), F.col("judge_outcome"))))
    status = (F.when(~in_qa, F.col("status")).when(failed_stage.isNotNull(), F.lit("failed"))
              .otherwise(F.lit("complete")))
    return x.select("trace_id", F.col("status").alias("status_before"), status.alias("status"),
                    has_tests.alias("has_tests"), "judge_outcome", failed_stage.alias("failed_stage"),
                    F.when(in_qa, failed_stage.isNull() | (failed_stage != "tests")).alias("schema_valid"),
                    error.alias("error"))


def completeness_gate(traces: DataFrame, tests: DataFrame, judge: DataFrame) -> DataFrame:
    """Q4 alone: for finalizing traces, the first missing QA piece in the order
    qa -> tests -> judge; none missing -> complete. A gate error changes
    nothing (the trace stays finalizing)."""
    t = traces.where(F.col("status") == "finalizing").select("trace_id")
    x = (t.join(tests.select("trace_id", F.lit(True).alias("_t")), "trace_id", "left")
         .join(judge.where(F.col("outcome") == "ok").select("trace_id", F.lit(True).alias("_j")), "trace_id", "left"))
    has_t, has_j = F.col("_t").isNotNull(), F.col("_j").isNotNull()
    err = (F.when(~has_t & ~has_j, F.lit("has no QA data")).when(~has_t, F.lit("missing qa.tests"))
           .when(~has_j, F.lit("missing qa.judge")))
    return x.select("trace_id", F.when(err.isNull(), F.lit("complete")).otherwise(F.lit("finalizing")).alias("status"),
                    err.alias("gate_error"))


def trace_documents(traces: DataFrame, events: DataFrame, finals: DataFrame, tests: DataFrame,
                    judge: DataFrame, include_events: bool = True, include_qa: bool = True) -> DataFrame:
    """T1-T4 + J1 + S8: one document row per trace (header fields and counts;
    the ordered event array itself is emitted in bounded parts by
    ``event_parts``). ``include_events=False`` builds the plan without the
    events scan; ``include_qa=False`` without the QA joins (T2/T3)."""
    doc = traces.select("trace_id", "trace_version", "status", "created_at_ms", "title")
    doc = doc.join(finals.select("trace_id", F.col("commit_head").alias("final_commit_head")), "trace_id", "left")
    if include_events:
        ev = events.groupBy("trace_id").agg(F.count(F.lit(1)).alias("n_events"), F.max("seq").alias("seq_high"))
        doc = (doc.join(ev, "trace_id", "left")
               .withColumn("n_events", F.coalesce(F.col("n_events"), F.lit(0)).cast("long")))
    else:
        doc = doc.withColumn("n_events", F.lit(0).cast("long")).withColumn("seq_high", F.lit(None).cast("int"))
    if include_qa:
        doc = (doc.join(tests.select("trace_id", "final_passed", "n_invocations"), "trace_id", "left")
               .join(judge.where(F.col("outcome") == "ok").select("trace_id", F.col("overall").alias("judge_overall")),
                     "trace_id", "left"))
    else:
        doc = (doc.withColumn("final_passed", F.lit(None).cast("boolean"))
               .withColumn("n_invocations", F.lit(None).cast("long"))
               .withColumn("judge_overall", F.lit(None).cast("double")))
    return doc
