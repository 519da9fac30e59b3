"""Ingestion queries over tel_submissions."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tracewright.functions.jsonrules import DuckDialect, compile_rules, enum_message
from tracewright.operators import ingest as I
from tracewright.operators.event_store import EventStore
from tracewright.plans.oracle_views import with_views
from tracewright.plans.q_validate import duck_payload_array
from tracewright.plans.registry import query
from tracewright.schemas import ENUMS, ENVELOPE_RULES, STORED_EVENT
from tracewright.session import scratch_path
from tracewright.sources import bindings as B
from tracewright.sources import jsonlines as JL


def _in(vals) -> str:
    return ", ".join(f"'{v}'" for v in vals)


def _s(idx: int, field: str, code: str, msg: str) -> str:
    return f"{{'idx': {idx}, 'field': concat('events.', pos, '.{field}'), 'code': '{code}', 'message': '{msg}'}}"


_ENV = f"""[
  CASE WHEN seq IS NULL THEN {_s(1, 'seq', 'missing', 'Field required')}
       WHEN seq < 1 THEN {_s(1, 'seq', 'greater_than_equal', 'Input should be greater than or equal to 1')} END,
  CASE WHEN ts_ms IS NULL THEN {_s(2, 'ts_ms', 'missing', 'Field required')}
       WHEN ts_ms < 0 THEN {_s(2, 'ts_ms', 'greater_than_equal', 'Input should be greater than or equal to 0')} END,
  CASE WHEN type IS NULL OR type NOT IN ({_in(ENUMS['event_type'])}) THEN {_s(3, 'type', 'enum', enum_message('event_type').replace("'", "''"))} END,
  CASE WHEN actor_kind IS NULL OR actor_kind NOT IN ({_in(ENUMS['actor_kind'])}) THEN {_s(4, 'actor.kind', 'enum', enum_message('actor_kind').replace("'", "''"))} END,
  CASE WHEN payload_json IS NULL THEN {_s(6, 'payload', 'missing', 'Field required')}
       WHEN NOT (json_valid(payload_json) AND json_type(payload_json) = 'OBJECT') THEN {_s(6, 'payload', 'dict_type', 'Input should be a valid dictionary')} END
]"""

_ROWS = f"""
SELECT *, len(list_filter(env, lambda x: x IS NOT NULL)) AS n_env, len(list_filter(pay, lambda x: x IS NOT NULL)) AS n_pay,
       coalesce(seq <= lag(seq) OVER (PARTITION BY trace_id, batch_no ORDER BY pos), false) AS seq_step_bad,
       coalesce(lag(event_id) OVER (PARTITION BY trace_id, batch_no ORDER BY event_id, pos) = event_id, false) AS id_rep
FROM (SELECT s.*, {_ENV} AS env,
             CASE WHEN json_valid(payload_json) AND json_type(payload_json) = 'OBJECT'
                  THEN {duck_payload_array(prefix="concat('events.', pos, '.payload.')")} ELSE [] END AS pay
      FROM tel_submissions s) x"""

_SUMM = """
SELECT r.trace_id, r.batch_no, count(*) AS n_events, sum(n_env) AS n_env, sum(n_pay) AS n_pay,
       arg_min(seq, pos) AS lo, max(seq) AS hi, bool_or(seq_step_bad) AS internal_bad, bool_or(id_rep) AS dup_in_batch,
       false AS dup_stored,
       coalesce(list_sort(list(r.event_id) FILTER (WHERE rep.event_id IS NOT NULL)), []) AS rep_ids
FROM sub_rows r LEFT JOIN (SELECT trace_id, event_id FROM tel_submissions GROUP BY 1, 2 HAVING min(batch_no) < max(batch_no)) rep
     USING (trace_id, event_id)
GROUP BY r.trace_id, r.batch_no"""

_SUMM2 = """
SELECT s.*, t.status,
       CASE WHEN n_env > 0 OR n_pay > 0 OR n_events > 100 THEN 'schema' WHEN t.status IS NULL THEN 'missing'
            WHEN t.status <> 'collecting' THEN 'state' END AS pre,
       row_number() OVER (PARTITION BY s.trace_id ORDER BY s.batch_no) AS rn
FROM sub_summ s LEFT JOIN tel_traces t USING (trace_id)"""


def _oc(f: str = "f", s: str = "s") -> str:
    return (f"coalesce({s}.pre, CASE WHEN {s}.internal_bad OR {s}.lo <= {f}.high THEN 'seq' "
            f"WHEN {s}.dup_stored OR list_has_any({s}.rep_ids, {f}.claimed) THEN 'duplicate' "
            f"WHEN {s}.dup_in_batch THEN 'duplicate_in_batch' ELSE 'accepted' END)")


_FOLD = f"""
SELECT DISTINCT trace_id, 0 AS rn, 0 AS high, CAST([] AS VARCHAR[]) AS claimed, CAST(NULL AS INT) AS batch_no,
       CAST(NULL AS VARCHAR) AS outcome, CAST(NULL AS INT) AS high_before, CAST([] AS VARCHAR[]) AS dup_ids
FROM sub_summ2
UNION ALL
SELECT s.trace_id, s.rn,
       CASE WHEN {_oc()} = 'accepted' THEN s.hi ELSE f.high END,
       CASE WHEN {_oc()} = 'accepted' THEN list_distinct(list_concat(f.claimed, s.rep_ids)) ELSE f.claimed END,
       s.batch_no, {_oc()}, f.high, list_intersect(s.rep_ids, f.claimed)
FROM sub_fold f JOIN sub_summ2 s ON s.trace_id = f.trace_id AND s.rn = f.rn + 1"""

_OUTCOMES = """
SELECT s.trace_id, s.batch_no, s.n_events, f.outcome,
       CASE f.outcome WHEN 'schema' THEN 400 WHEN 'missing' THEN 404 WHEN 'state' THEN 409 WHEN 'seq' THEN 400
            WHEN 'accepted' THEN 202 ELSE 409 END AS http_status,
       CAST(CASE WHEN f.outcome = 'accepted' THEN s.n_events ELSE 0 END AS BIGINT) AS accepted,
       CASE WHEN f.outcome = 'accepted' THEN s.hi END AS seq_high, f.high_before, s.lo, s.status, f.dup_ids
FROM sub_summ2 s JOIN sub_fold f ON s.trace_id = f.trace_id AND s.rn = f.rn"""

_EXTRA = {"sub_rows": _ROWS, "sub_summ": _SUMM, "sub_summ2": _SUMM2, "sub_fold": _FOLD, "sub_outcomes": _OUTCOMES}


def _ingest_sql(body: str) -> str:
    return with_views(body, "tel_submissions", "tel_traces", extra=_EXTRA, recursive=True)


def _outcomes(spark, sf):
    return I.batch_outcomes(B.tel_submissions(spark, sf), B.tel_traces(spark, sf))


ORACLE_BATCH_OUTCOMES = _ingest_sql("""
SELECT trace_id, batch_no, CAST(n_events AS BIGINT) AS n_events, outcome, http_status, accepted, seq_high, high_before
FROM sub_outcomes""")


@query("batch_outcomes", ORACLE_BATCH_OUTCOMES)
def batch_outcomes(spark, sf):
    return _outcomes(spark, sf).select("trace_id", "batch_no", "n_events", "outcome", "http_status", "accepted",
                                       "seq_high", "high_before")


@query("outcome_counts", _ingest_sql("""
SELECT outcome, CAST(count(*) AS BIGINT) AS n_batches, CAST(sum(n_events) AS BIGINT) AS n_events FROM sub_outcomes GROUP BY outcome"""))
def outcome_counts(spark, sf):
    return (_outcomes(spark, sf).groupBy("outcome")
            .agg(F.count(F.lit(1)).alias("n_batches"), F.sum("n_events").cast("long").alias("n_events")))


@query("accepted_events", _ingest_sql("""
SELECT s.trace_id, s.event_id, s.seq, s.ts_ms, s.type, s.actor_kind, s.payload_json
FROM tel_submissions s JOIN sub_outcomes o ON s.trace_id = o.trace_id AND s.batch_no = o.batch_no
WHERE o.outcome = 'accepted'"""))
def accepted_events(spark, sf):
    subs = B.tel_submissions(spark, sf)
    out = I.batch_outcomes(subs, B.tel_traces(spark, sf))
    return I.accepted_events(subs, out).select("trace_id", "event_id", "seq", "ts_ms", "type", "actor_kind",
                                               "payload_json")


@query("ingestion_fold", _ingest_sql("""
SELECT trace_id, CAST(count(*) AS BIGINT) AS n_batches,
       CAST(count(*) FILTER (WHERE outcome = 'accepted') AS BIGINT) AS n_accepted_batches,
       CAST(coalesce(sum(accepted), 0) AS BIGINT) AS n_accepted_events,
       CAST(coalesce(max(seq_high), 0) AS INT) AS final_high
FROM sub_outcomes GROUP BY trace_id"""))
def ingestion_fold(spark, sf):
    o = _outcomes(spark, sf)
    return o.groupBy("trace_id").agg(
        F.count(F.lit(1)).alias("n_batches"),
        F.count(F.when(F.col("outcome") == "accepted", 1)).alias("n_accepted_batches"),
        F.coalesce(F.sum("accepted"), F.lit(0)).cast("long").alias("n_accepted_events"),
        F.coalesce(F.max("seq_high"), F.lit(0)).cast("int").alias("final_high"))


@query("seq_monotonic", _ingest_sql("""
SELECT trace_id, batch_no, pos, seq, prev, concat('events.', pos, '.seq') AS field,
       concat('seq must be > ', prev, ' (monotonically increasing), got ', seq) AS message
FROM (SELECT s.trace_id, s.batch_no, s.pos, s.seq,
             coalesce(lag(s.seq) OVER (PARTITION BY s.trace_id, s.batch_no ORDER BY s.pos), o.high_before) AS prev
      FROM tel_submissions s JOIN sub_outcomes o ON s.trace_id = o.trace_id AND s.batch_no = o.batch_no
      WHERE o.outcome NOT IN ('schema', 'missing', 'state')) x
WHERE seq <= prev"""))
def seq_monotonic(spark, sf):
    """V12/W1 for every batch that reached the sequence check, against the
    high-water mark the fold left before it: ``seq <= lag(seq, 1, high)``."""
    subs = B.tel_submissions(spark, sf)
    o = I.batch_outcomes(subs, B.tel_traces(spark, sf)).where(~F.col("outcome").isin("schema", "missing", "state"))
    prev = subs.select("trace_id", "batch_no", (F.col("pos") + 1).alias("pos"), F.col("seq").alias("_p"))
    x = (subs.join(o.select("trace_id", "batch_no", "high_before"), ["trace_id", "batch_no"])
         .join(prev, ["trace_id", "batch_no", "pos"], "left")
         .withColumn("prev", F.coalesce(F.col("_p"), F.col("high_before"))))
    return x.where(F.col("seq") <= F.col("prev")).select(
        "trace_id", "batch_no", "pos", "seq", "prev",
        F.concat(F.lit("events."), F.col("pos").cast("string"), F.lit(".seq")).alias("field"),
        F.concat(F.lit("seq must be > "), F.col("prev").cast("string"), F.lit(" (monotonically increasing), got "),
                 F.col("seq").cast("string")).alias("message"))


@query("duplicate_events", _ingest_sql("""
SELECT trace_id, batch_no, outcome, concat('Duplicate event_id(s): ', array_to_string(list_sort(ids), ', ')) AS detail
FROM (SELECT o.trace_id, o.batch_no, o.outcome,
             CASE WHEN o.outcome = 'duplicate' THEN o.dup_ids
                  ELSE (SELECT list_sort(list(DISTINCT x.event_id)) FROM (SELECT event_id FROM tel_submissions s
                        WHERE s.trace_id = o.trace_id AND s.batch_no = o.batch_no GROUP BY event_id HAVING count(*) > 1) x) END AS ids
      FROM sub_outcomes o WHERE o.outcome IN ('duplicate', 'duplicate_in_batch')) y"""))
def duplicate_events(spark, sf):
    """Batches rejected for ids already stored (claimed by an
    earlier accepted batch) or repeated inside the batch, with the id list."""
    subs = B.tel_submissions(spark, sf)
    o = I.batch_outcomes(subs, B.tel_traces(spark, sf)).where(F.col("outcome").isin("duplicate", "duplicate_in_batch"))
    in_batch = (subs.groupBy("trace_id", "batch_no", "event_id").count().where(F.col("count") > 1)
                .groupBy("trace_id", "batch_no").agg(F.sort_array(F.collect_set("event_id")).alias("_ib")))
    j = o.join(in_batch, ["trace_id", "batch_no"], "left")
    ids = F.when(F.col("outcome") == "duplicate", F.col("dup_ids")).otherwise(F.col("_ib"))
    return j.select("trace_id", "batch_no", "outcome",
                    F.concat(F.lit("Duplicate event_id(s): "), F.array_join(F.sort_array(ids), ", ")).alias("detail"))


@query("state_conflicts", _ingest_sql("""
SELECT trace_id, batch_no, status, concat('Trace status is ''', status, ''', expected ''collecting''') AS detail
FROM sub_outcomes WHERE outcome = 'state'"""))
def state_conflicts(spark, sf):
    """Non-schema batches for traces that are no longer collecting."""
    o = I.state_conflicts(B.tel_submissions(spark, sf), B.tel_traces(spark, sf))
    return o.select(
        "trace_id", "batch_no", "status",
        F.concat(F.lit("Trace status is '"), F.col("status"), F.lit("', expected 'collecting'")).alias("detail"))


@query("orphan_events", with_views("""
SELECT s.trace_id, CAST(count(*) AS BIGINT) AS n_events, CAST(count(DISTINCT s.batch_no) AS BIGINT) AS n_batches
FROM tel_submissions s WHERE NOT EXISTS (SELECT 1 FROM tel_traces t WHERE t.trace_id = s.trace_id) GROUP BY s.trace_id""",
                                   "tel_submissions", "tel_traces"))
def orphan_events(spark, sf):
    """Submissions for traces that do not exist (left anti join)."""
    subs = B.tel_submissions(spark, sf)
    orphans = subs.join(B.tel_traces(spark, sf).select("trace_id"), "trace_id", "left_anti")
    return orphans.groupBy("trace_id").agg(F.count(F.lit(1)).alias("n_events"),
                                           F.countDistinct("batch_no").alias("n_batches"))


@query("batch_size_check", with_views("""
SELECT trace_id, batch_no, CAST(count(*) AS BIGINT) AS n_events, count(*) BETWEEN 1 AND 100 AS size_ok
FROM tel_submissions GROUP BY trace_id, batch_no""", "tel_submissions"))
def batch_size_check(spark, sf):
    """V4: batch size 1..100."""
    return (B.tel_submissions(spark, sf).groupBy("trace_id", "batch_no")
            .agg(F.count(F.lit(1)).alias("n_events"))
            .withColumn("size_ok", F.col("n_events").between(1, 100)))


@query("envelope_violations", _ingest_sql("""
SELECT trace_id, batch_no, pos, v.idx AS idx, v.field AS field, v.code AS code, v.message AS message
FROM (SELECT trace_id, batch_no, pos, unnest(env) AS v FROM sub_rows) x WHERE v IS NOT NULL"""))
def envelope_violations(spark, sf):
    """V3: envelope errors per event (seq, ts_ms, type, actor.kind, payload)."""
    e = I.envelope_violations(B.tel_submissions(spark, sf))
    return (e.select("trace_id", "batch_no", "pos", F.explode_outer("env").alias("v")).where(F.col("v").isNotNull())
            .select("trace_id", "batch_no", "pos", "v.idx", "v.field", "v.code", "v.message"))


@query("violation_report", _ingest_sql("""
SELECT trace_id, batch_no, CAST(count(*) AS BIGINT) AS n_errors, concat(count(*), ' validation error(s)') AS summary,
       concat('{"detail":"Validation failed","errors":[',
              string_agg(CASE WHEN value IS NULL OR value = 'null' THEN to_json({'field': field, 'message': message})
                              ELSE to_json({'field': field, 'message': message, 'value': value}) END, ',' ORDER BY pos, idx, field), ']}') AS body
FROM (SELECT *, min(phase) OVER (PARTITION BY trace_id, batch_no) AS min_phase
      FROM (SELECT trace_id, batch_no, pos, 0 AS phase, v.idx AS idx, v.field AS field, v.message AS message,
                   CASE v.idx WHEN 1 THEN CAST(seq AS VARCHAR) WHEN 2 THEN CAST(ts_ms AS VARCHAR) WHEN 3 THEN CAST(to_json(type) AS VARCHAR)
                        WHEN 4 THEN CAST(to_json(actor_kind) AS VARCHAR) WHEN 6 THEN payload_json END AS value
            FROM (SELECT *, unnest(env) AS v FROM sub_rows) a WHERE v IS NOT NULL
            UNION ALL
            SELECT trace_id, batch_no, pos, 1, v.idx, v.field, v.message,
                   CASE WHEN v.code <> 'missing' THEN CAST(json_extract(payload_json, concat('$.', regexp_replace(regexp_extract(v.field, 'payload[.](.*)$', 1), '[.]([0-9]+)$', '[\\1]'))) AS VARCHAR)
                        WHEN contains(regexp_extract(v.field, 'payload[.](.*)$', 1), '.') THEN CAST(json_extract(payload_json, concat('$.', regexp_replace(regexp_extract(v.field, 'payload[.](.*)$', 1), '[.][^.]+$', ''))) AS VARCHAR)
                        ELSE payload_json END
            FROM (SELECT *, unnest(pay) AS v FROM sub_rows) b WHERE v IS NOT NULL) u) w
WHERE phase = min_phase GROUP BY trace_id, batch_no"""))
def violation_report(spark, sf):
    return I.violation_report(B.tel_submissions(spark, sf))


@query("ingestion_rounds", ORACLE_BATCH_OUTCOMES)
def ingestion_rounds(spark, sf):
    """V20 with every trace replayed batch by batch; must equal the plan that
    replays only traces with conflicts (``batch_outcomes``)."""
    out = I.batch_outcomes(B.tel_submissions(spark, sf), B.tel_traces(spark, sf), replay_all=True)
    return out.select("trace_id", "batch_no", "n_events", "outcome", "http_status", "accepted", "seq_high",
                      "high_before")


@query("event_json_violations", with_views(f"""
SELECT trace_id, batch_no, pos, v.idx AS idx, v.field AS field, v.code AS code, v.message AS message
FROM (SELECT trace_id, batch_no, pos, unnest({compile_rules(DuckDialect('event_json'), ENVELOPE_RULES, "concat('events.', pos, '.')")}) AS v
      FROM tel_event_json) x WHERE v IS NOT NULL""", "tel_event_json"))
def event_json_violations(spark, sf):
    """V3: envelope rules on events as they are sent (lax numbers, actor, context, event_id)."""
    return I.event_json_violations(B.tel_event_json(spark, sf), ["trace_id", "batch_no", "pos"])


@query("event_json_typed", with_views("""
SELECT trace_id, batch_no, pos, coalesce(json_extract_string(event_json, '$.event_id'), concat('ev-', sha256(concat(trace_id, '/', batch_no, '/', pos)))) AS event_id,
       CASE WHEN json_type(event_json, '$.seq') = 'BOOLEAN' THEN 1 ELSE CAST(trunc(CAST(json_extract_string(event_json, '$.seq') AS DOUBLE)) AS BIGINT) END AS seq,
       TRY_CAST(json_extract_string(event_json, '$.ts_ms') AS BIGINT) AS ts_ms, json_extract_string(event_json, '$.actor.id') AS actor_id,
       json_extract_string(event_json, '$.context.branch') AS branch, json_type(event_json, '$.context') IS NOT NULL AS has_context
FROM tel_event_json""", "tel_event_json"))
def event_json_typed(spark, sf):
    """Envelope JSON to typed columns, ids made where absent."""
    t = I.typed_events(B.tel_event_json(spark, sf))
    return t.select("trace_id", "batch_no", "pos", "event_id", "seq", "ts_ms", "actor_id", "context.branch", F.col("context").isNotNull().alias("has_context"))


_TYPED_SQL = """
SELECT trace_id, coalesce(json_extract_string(event_json, '$.event_id'), concat('ev-', sha256(concat(trace_id, '/', batch_no, '/', pos)))) AS event_id,
       CASE WHEN json_type(event_json, '$.seq') = 'BOOLEAN' THEN 1 ELSE CAST(trunc(CAST(json_extract_string(event_json, '$.seq') AS DOUBLE)) AS BIGINT) END AS seq,
       json_extract_string(event_json, '$.actor.kind') AS actor_kind, json_extract_string(event_json, '$.actor.id') AS actor_id,
       json_type(event_json, '$.context') IS NOT NULL AS has_context, json_extract_string(event_json, '$.context.branch') AS branch,
       json_extract_string(event_json, '$.context.commit_head') AS commit_head
FROM tel_event_json"""


@query("event_store_by_trace", with_views("""
SELECT e.*, t.status FROM typed e LEFT JOIN tel_traces t USING (trace_id)""", "tel_event_json", "tel_traces", extra={"typed": _TYPED_SQL}))
def event_store_by_trace(spark, sf):
    """Submitted events typed, stored in buckets of their trace with actor and context, read back and joined
    with the trace's status where they lie."""
    t = I.typed_events(B.tel_event_json(spark, sf))
    actor = F.when(F.col("actor_kind").isNotNull(), F.struct(F.col("actor_kind").alias("kind"), F.col("actor_id").alias("id")))
    store = EventStore(spark, scratch_path(spark, f"tw-events-{uuid.uuid4().hex}")).write(t.withColumn("actor", actor))
    e = store.with_traces(B.tel_traces(spark, sf).select("trace_id", "status"), "left")
    return e.select("trace_id", "event_id", "seq", F.col("actor.kind").alias("actor_kind"), F.col("actor.id").alias("actor_id"),
                    F.col("context").isNotNull().alias("has_context"), "context.branch", "context.commit_head", "status")


@query("event_store_marks", with_views("""
SELECT trace_id, CAST(count(*) AS BIGINT) AS n_events, CAST(max(seq) AS BIGINT) AS seq_high FROM tel_events GROUP BY trace_id""", "tel_events"))
def event_store_marks(spark, sf):
    """Marks per trace from the bucketed event table, aggregated where the events lie."""
    none = F.lit(None).cast(STORED_EVENT["context"].dataType)
    ev = B.tel_events(spark, sf).withColumn("actor", F.struct(F.col("actor_kind").alias("kind"), F.lit(None).cast("string").alias("id"))).withColumn("context", none).withColumn("seq", F.col("seq").cast("long"))
    store = EventStore(spark, scratch_path(spark, f"tw-events-{uuid.uuid4().hex}")).write(ev)
    return store.per_trace(F.count(F.lit(1)).alias("n_events"), F.max("seq").alias("seq_high"))


# JSON of seq, the violation of it, and what it is typed as
_WIDE = (("3000000000", None, "3000000000"), ("1e300", "int_parsing_size", None), ('"5."', "int_parsing", None), ("1e20", "int_parsing_size", None),
         ("1" + "0" * 30, None, None), ('"\\u00a05"', None, "5"), ('"5.0"', None, "5"), ('"1_000"', None, "1000"), ("true", None, "1"),
         ("9007199254740993", None, "9007199254740993"), ("-1", "greater_than_equal", "-1"), ("5.5", "int_from_float", "5"), ('"nan"', "int_parsing", None))


def _wide(k: int) -> str:
    cases = " ".join(f"WHEN {i} THEN " + ("NULL" if w[k] is None else f"'{w[k]}'") for i, w in enumerate(_WIDE))
    return f"CASE n % {len(_WIDE)} {cases} END"


@query("event_wide_numbers", f"""
SELECT event_id, {_wide(1)} AS seq_code, {_wide(2)} AS seq, CAST(NULL AS VARCHAR) AS ts_ms
FROM (SELECT event_id, event_id AS n FROM events) e""")
def event_wide_numbers(spark, sf):
    """Integers of any size, written in every way, are judged and typed without ending the job; ts_ms is 1e300 throughout."""
    cases = F.array(*[F.lit(w[0].replace("\\\\", "\\")) for w in _WIDE])
    doc = F.concat(F.lit('{"event_id":"e","seq":'), F.element_at(cases, (F.col("event_id") % len(_WIDE) + 1).cast("int")), F.lit(
        ',"ts_ms":1e300,"type":"commit","actor":{"kind":"human"},"payload":{}}'))
    e = B.table(spark, sf, "events").select(F.col("event_id").cast("string").alias("trace_id"), F.lit(0).alias("batch_no"), F.lit(0).alias("pos"), doc.alias("event_json"))
    bad = I.event_json_violations(e, ["trace_id"]).where("field = 'events.0.seq'").select("trace_id", F.col("code").alias("seq_code"))
    t = I.typed_events(e).select("trace_id", "seq", "ts_ms")
    return t.join(bad, "trace_id", "left").select(F.col("trace_id").cast("long").alias("event_id"), "seq_code", F.col("seq").cast("string").alias("seq"), F.col("ts_ms").cast("string").alias("ts_ms"))


@query("jsonl_submissions", with_views("""
SELECT trace_id, batch_no, pos, event_id, seq, CAST(NULL AS VARCHAR) AS reason
FROM (SELECT trace_id, batch_no, pos, json_extract_string(event_json, '$.event_id') AS event_id, event_json,
             CASE WHEN json_type(event_json, '$.seq') = 'BOOLEAN' THEN 1 ELSE CAST(trunc(CAST(json_extract_string(event_json, '$.seq') AS DOUBLE)) AS BIGINT) END AS seq
      FROM tel_event_json) e WHERE batch_no % 10 NOT IN (3, 7, 9)
UNION ALL
SELECT trace_id, batch_no, NULL, NULL, NULL, CASE batch_no % 10 WHEN 3 THEN 'malformed' WHEN 7 THEN 'missing events' ELSE 'not an object' END
FROM (SELECT DISTINCT trace_id, batch_no FROM tel_event_json) b WHERE batch_no % 10 IN (3, 7, 9)""", "tel_event_json"))
def jsonl_submissions(spark, sf):
    """Requests written as JSON lines and read back as typed events; broken lines (cut off, without events, a list) go to
    quarantine, where the text still tells which request it was."""
    ev = B.tel_event_json(spark, sf)
    events = F.transform(F.sort_array(F.collect_list(F.struct("pos", "event_json"))), lambda e: e["event_json"])
    r = ev.groupBy("trace_id", "batch_no").agg(F.array_join(events, ",").alias("events"))
    head = F.concat(F.lit('{"trace_id":"'), "trace_id", F.lit('","batch_no":'), F.col("batch_no").cast("string"))
    n = F.col("batch_no") % 10
    line = (F.when(n == 3, F.concat(head, F.lit(',"events":[{"event_id"'))).when(n == 7, F.concat(head, F.lit("}"))).when(n == 9, F.concat(F.lit("["), head, F.lit("}]")))
            .otherwise(F.concat(head, F.lit(',"events":['), "events", F.lit("]}"))))
    path = scratch_path(spark, f"tw-jsonl-{uuid.uuid4().hex}")
    r.select(line.alias("value")).write.text(path)
    found = JL.parsed(JL.lines(spark, path), "submissions")
    good = JL.submitted_events(JL.requests(found, "submissions"))
    t = I.typed_events(good).select("trace_id", "batch_no", "pos", F.when(~F.col("event_id").rlike("^ev-[0-9a-f]{64}$"), F.col("event_id")).alias("event_id"), "seq")
    bad = JL.quarantined(found).select(
        F.regexp_extract("line", '"trace_id":"([^"]*)"', 1).alias("trace_id"), F.regexp_extract("line", '"batch_no":([0-9]+)', 1).cast("int").alias("batch_no"),
        F.lit(None).cast("int").alias("pos"), F.lit(None).cast("string").alias("event_id"), F.lit(None).cast("long").alias("seq"), "reason")
    return t.withColumn("reason", F.lit(None).cast("string")).unionByName(bad)


@query("request_size_check", """
WITH r AS (SELECT DISTINCT event_id // 101 AS request_id FROM events UNION SELECT max(event_id) // 101 + 1 FROM events),
n AS (SELECT event_id // 101 AS request_id, count(*) AS n FROM events GROUP BY 1)
SELECT request_id, coalesce(n, 0) AS n_events, CASE WHEN n IS NULL THEN 'List should have at least 1 item after validation, not 0'
       WHEN n > 100 THEN 'List should have at most 100 items after validation, not 101' END AS error FROM r LEFT JOIN n USING (request_id)""")
def request_size_check(spark, sf):
    """V4 with requests of 101 events and one without any."""
    ev = B.table(spark, sf, "events").select(F.expr("event_id div 101").alias("request_id"))
    last = ev.agg((F.max("request_id") + 1).alias("request_id"))
    return I.request_sizes(ev.unionByName(last), ev, "request_id")
