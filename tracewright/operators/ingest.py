"""Batch ingestion: envelope and payload validation, all-or-nothing batches,
outcome precedence and the acceptance fold (V3-V5, V12-V21, A1-A3, W4, S5, U3).

A *submission* row is one event of one request batch:
``(trace_id, batch_no, pos, event_id, seq, ts_ms, type, actor_kind, payload_json)``.
Outcome of a batch, first that applies (V19):

  schema (400) > missing (404) > state (409) > seq (400) > duplicate (409)
  > duplicate_in_batch (409) > accepted (202)

``seq`` and ``duplicate`` depend on what *earlier accepted* batches of the same
trace left behind (high-water mark, stored ids): an id seen only in a rejected
batch is not a duplicate. Batch summaries are written once; traces are cut into
segments that no dependency crosses, and segments are replayed side by side.

No windows over events: a summary is one aggregate over (trace_id, batch_no)
that gathers a bounded number of positions, combined map-side, so neither a
hot trace nor an oversized batch lands in one task; after that only per-batch
summaries move.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.functions.jsonrules import SparkDialect, enum_message
from tracewright.operators.common import written
from tracewright.operators.fold import folded, replayed_outcomes
from tracewright.operators.validate import any_violation, explode_violations, offending_value, violations_array
from tracewright.schemas import ENUMS, ENVELOPE_RULES, MAX_EVENTS_PER_BATCH, PAYLOAD_RULES

OUTCOME_STATUS = {
    "schema": 400, "missing": 404, "state": 409, "seq": 400,
    "duplicate": 409, "duplicate_in_batch": 409, "accepted": 202,
}
BATCH_KEYS = ["trace_id", "batch_no"]
_JSON_OBJECT = r"^[ \t\n\r]*\{"


def _viol(idx: int, field: Column, code: str, message: str) -> Column:
    return F.struct(F.lit(idx).alias("idx"), field.alias("field"), F.lit(code).alias("code"),
                    F.lit(message).alias("message"))


def envelope_violations(subs: DataFrame) -> DataFrame:
    """V3: typed envelope checks per event -> ``env`` array (NULL slots = ok)."""
    at = lambda name: F.concat(F.lit("events."), F.col("pos").cast("string"), F.lit("." + name))
    payload_obj = F.expr("try_parse_json(payload_json)").isNotNull() & F.col("payload_json").rlike(_JSON_OBJECT)
    env = F.array(
        F.when(F.col("seq").isNull(), _viol(1, at("seq"), "missing", "Field required"))
         .when(F.col("seq") < 1, _viol(1, at("seq"), "greater_than_equal", "Input should be greater than or equal to 1")),
        F.when(F.col("ts_ms").isNull(), _viol(2, at("ts_ms"), "missing", "Field required"))
         .when(F.col("ts_ms") < 0, _viol(2, at("ts_ms"), "greater_than_equal", "Input should be greater than or equal to 0")),
        F.when(F.col("type").isNull() | ~F.col("type").isin(*ENUMS["event_type"]),
               _viol(3, at("type"), "enum", enum_message("event_type"))),
        F.when(F.col("actor_kind").isNull() | ~F.col("actor_kind").isin(*ENUMS["actor_kind"]),
               _viol(4, at("actor.kind"), "enum", enum_message("actor_kind"))),
        F.when(F.col("payload_json").isNull(), _viol(6, at("payload"), "missing", "Field required"))
         .when(~payload_obj, _viol(6, at("payload"), "dict_type", "Input should be a valid dictionary")),
    )
    return subs.withColumn("env", env)


def event_json_violations(events: DataFrame, keys: list[str], doc_col: str = "event_json") -> DataFrame:
    """V3 on events as they are sent: envelope rules over the JSON of each event, with lax coercion."""
    at = F.concat(F.lit("events."), F.col("pos").cast("string"), F.lit("."))
    return explode_violations(violations_array(events, doc_col, {None: ENVELOPE_RULES}, prefix=at), keys)


def typed_events(events: DataFrame, doc_col: str = "event_json") -> DataFrame:
    """The envelope of each event's JSON as typed columns. Numbers are
    read as the rules accept them ("5", 5.0, true); an absent event_id becomes a
    digest of (trace_id, batch_no, pos); context is a struct, the payload stays JSON.
    Numbers are exact 64-bit integers; one that does not fit, or is no number, is null and never ends the job."""
    d = SparkDialect("_v")
    x = events.withColumn("_v", F.expr(f"try_parse_json(`{doc_col}`)"))
    whole = lambda p: F.expr(d.whole(p))
    text = lambda p: F.expr(d.text(p))
    own = F.concat(F.lit("ev-"), F.sha2(F.concat_ws("/", "trace_id", F.col("batch_no").cast("string"), F.col("pos").cast("string")), 256))
    context = F.struct(*[text(f"context.{n}").alias(n) for n in ("workspace_root", "branch", "commit_head", "correlation_id", "parent_event_id")])
    has_context = F.coalesce(F.expr(f"{d.kind_expr('context')} = 'object'"), F.lit(False))
    return x.select("trace_id", "batch_no", "pos", F.coalesce(text("event_id"), own).alias("event_id"), whole("seq").alias("seq"),
                    whole("ts_ms").alias("ts_ms"), text("type").alias("type"), text("actor.kind").alias("actor_kind"), text("actor.id").alias("actor_id"),
                    F.when(has_context, context).alias("context"), F.to_json(F.expr(d.sub("payload"))).alias("payload_json"))


def request_sizes(requests: DataFrame, events: DataFrame, key: str) -> DataFrame:
    """V4: events per request, requests without any included: (key, n_events, error)."""
    n = events.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    out = requests.select(key).distinct().join(n, key, "left").withColumn("n_events", F.coalesce("_n", F.lit(0)).cast("long"))
    error = (F.when(F.col("n_events") == 0, F.lit("List should have at least 1 item after validation, not 0"))
             .when(F.col("n_events") > MAX_EVENTS_PER_BATCH, F.concat(F.lit(f"List should have at most {MAX_EVENTS_PER_BATCH} items after validation, not "),
                                                                      F.lit(str(MAX_EVENTS_PER_BATCH + 1)))))
    return out.select(key, "n_events", error.alias("error"))


def _non_null(arr: str) -> Column:
    return F.size(F.filter(F.col(arr), lambda x: x.isNotNull()))


def batch_rows(subs: DataFrame) -> DataFrame:
    """Per-event flags: envelope/payload violations and the in-batch seq step.

    The step check compares each event with the one at ``pos - 1`` (request
    positions are dense from 0) by an equi-join on (trace_id, batch_no, pos):
    no window, so even an oversized batch is spread over tasks by position.
    """
    x = envelope_violations(subs)
    x = violations_array(x, "payload_json", PAYLOAD_RULES, gate_col="type", out="pay",
                         prefix=F.concat(F.lit("events."), F.col("pos").cast("string"), F.lit(".payload.")))
    x = x.withColumn("n_env", _non_null("env")).withColumn("n_pay", _non_null("pay"))
    prev = subs.select(*BATCH_KEYS, (F.col("pos") + 1).alias("pos"), F.col("seq").alias("prev_seq"))
    return (x.join(prev, [*BATCH_KEYS, "pos"], "left")
             .withColumn("seq_step_bad", F.coalesce(F.col("seq") <= F.col("prev_seq"), F.lit(False))))


def id_counts(subs: DataFrame) -> DataFrame:
    """Occurrences per (trace_id, event_id, batch_no): a partial aggregate."""
    return subs.groupBy("trace_id", "event_id", "batch_no").agg(F.count(F.lit(1)).alias("_n"))


def repeated_ids(counts: DataFrame) -> DataFrame:
    """(trace_id, event_id) pairs that occur in two or more batches of a trace."""
    return (counts.groupBy("trace_id", "event_id")
            .agg(F.min("batch_no").alias("_b0"), F.max("batch_no").alias("_b1"))
            .where(F.col("_b0") < F.col("_b1"))
            .select("trace_id", "event_id", F.lit(True).alias("_rep")))


def in_batch_duplicates(counts: DataFrame) -> DataFrame:
    """Batches holding one event id twice (small: only such batches)."""
    return counts.where(F.col("_n") > 1).select(*BATCH_KEYS).distinct().withColumn("_dib", F.lit(True))


def flag_ids(subs: DataFrame, stored: DataFrame | None = None, counts: DataFrame | None = None) -> DataFrame:
    """Per event: ``_rep`` (id occurs in another batch of the trace) and
    ``_in_store`` (id already stored, V13). Joins keyed by (trace_id, event_id);
    the repeated-id side is small and AQE broadcasts it at runtime."""
    counts = counts if counts is not None else id_counts(subs)
    r = subs.join(repeated_ids(counts), ["trace_id", "event_id"], "left")
    if stored is not None:
        st_ids = stored.select("trace_id", "event_id").distinct().withColumn("_in_store", F.lit(True))
        return r.join(st_ids, ["trace_id", "event_id"], "left")
    return r.withColumn("_in_store", F.lit(None).cast("boolean"))


def batch_summaries(rows: DataFrame, traces: DataFrame, stored: DataFrame | None = None,
                    dups: DataFrame | None = None) -> DataFrame:
    """One row per batch with everything the outcome needs except the fold.
    ``rows`` = ``batch_rows(flag_ids(subs))``; all partial aggregates, so a
    hot batch is combined map-side. ``rep_ids`` holds only ids repeated across
    batches (bounded by the batch size)."""
    r = rows
    summ = (r.groupBy(*BATCH_KEYS)
            .agg(F.count(F.lit(1)).alias("n_events"),
                 F.sum("n_env").alias("n_env"), F.sum("n_pay").alias("n_pay"),
                 F.min_by("seq", "pos").alias("lo"), F.max("seq").alias("hi"),
                 F.max("seq_step_bad").alias("internal_bad"),
                 F.coalesce(F.max("_in_store"), F.lit(False)).alias("dup_stored"),
                 F.sort_array(F.collect_list(F.when(F.col("_rep"), F.col("event_id")))).alias("rep_ids")))
    if dups is not None:
        summ = (summ.join(dups, BATCH_KEYS, "left")
                .withColumn("dup_in_batch", F.coalesce(F.col("_dib"), F.lit(False))).drop("_dib"))
    else:
        summ = summ.withColumn("dup_in_batch", F.lit(False))
    status = traces.select("trace_id", F.col("status").alias("_status"))
    summ = summ.join(status, "trace_id", "left")
    if stored is not None:
        high = stored.groupBy("trace_id").agg(F.max("seq").alias("_high0"))  # A1
        summ = summ.join(high, "trace_id", "left")
    else:
        summ = summ.withColumn("_high0", F.lit(None).cast("int"))
    schema_bad = (F.col("n_env") > 0) | (F.col("n_pay") > 0) | (F.col("n_events") > MAX_EVENTS_PER_BATCH)
    pre = (F.when(schema_bad, F.lit("schema"))
           .when(F.col("_status").isNull(), F.lit("missing"))
           .when(F.col("_status") != "collecting", F.lit("state")))
    return summ.withColumn("pre", pre).withColumn("high0", F.coalesce(F.col("_high0"), F.lit(0)).cast("int"))


def fold_outcomes(summ: DataFrame, replay_all: bool = False, stored: DataFrame | None = None, large: list[DataFrame] | None = None) -> DataFrame:
    """The outcome of each batch against what its trace has accepted (``operators/fold.py``) and against ids
    ``stored`` before (V13). ``replay_all`` replays every trace whole, however many batches it has. ``large``: its
    large traces, if they are known."""
    if stored is None:
        return replayed_outcomes(summ) if replay_all else folded(summ, summ, large)
    return folded(summ, mark_stored(summ, stored), large)


def request_summaries(subs: DataFrame, traces: DataFrame, stored_high: DataFrame | None = None) -> DataFrame:
    """One row per batch with everything its outcome needs but the fold, by one shuffle of the events: the JSON rules run
    in the map stage, and the first ``MAX_EVENTS_PER_BATCH`` + 1 positions of a batch are gathered as (pos, seq, event_id).
    A longer batch is refused for its size, so a request that holds a third of all events is no large row.
    ``stored_high``: (trace_id, high0) of stored events (A1). ``dup_stored`` is false here; ``rep_ids`` has all the batch's ids."""
    payload_obj = F.expr("try_parse_json(payload_json)").isNotNull() & F.col("payload_json").rlike(_JSON_OBJECT)
    envelope_ok = ((F.col("seq") >= 1) & (F.col("ts_ms") >= 0) & F.col("type").isin(*ENUMS["event_type"])
                   & F.col("actor_kind").isin(*ENUMS["actor_kind"]) & payload_obj)
    x = any_violation(subs, "payload_json", PAYLOAD_RULES, "type", "_pay")
    entry = F.when(F.col("pos") <= MAX_EVENTS_PER_BATCH, F.struct("pos", "seq", "event_id"))
    b = x.groupBy(*BATCH_KEYS).agg(F.count(F.lit(1)).alias("n_events"), F.max(F.col("_pay") | ~F.coalesce(envelope_ok, F.lit(False))).alias("_bad"),
                                   F.max("seq").alias("hi"), F.sort_array(F.collect_list(entry)).alias("_events"))
    b = b.join(traces.select("trace_id", F.col("status").alias("_status")), "trace_id", "left")
    if stored_high is not None:
        b = b.join(stored_high, "trace_id", "left")
    seqs, ids = F.col("_events.seq"), F.col("_events.event_id")
    steps = F.zip_with(F.slice(seqs, 2, MAX_EVENTS_PER_BATCH), F.slice(seqs, 1, F.greatest(F.size(seqs) - 1, F.lit(0))), lambda now, was: now <= was)
    pre = (F.when(F.col("_bad") | (F.col("n_events") > MAX_EVENTS_PER_BATCH), F.lit("schema")).when(F.col("_status").isNull(), F.lit("missing"))
           .when(F.col("_status") != "collecting", F.lit("state")))
    return b.select(*BATCH_KEYS, "n_events", pre.alias("pre"), F.get(seqs, F.lit(0)).alias("lo"), "hi",
                    F.coalesce(F.exists(steps, lambda bad: F.coalesce(bad, F.lit(False))), F.lit(False)).alias("internal_bad"),
                    F.lit(False).alias("dup_stored"), (F.size(F.array_distinct(ids)) < F.size(ids)).alias("dup_in_batch"), F.array_distinct(ids).alias("rep_ids"),
                    (F.lit(0) if stored_high is None else F.coalesce("high0", F.lit(0))).alias("high0"))


def respond(summ: DataFrame, outcomes: DataFrame) -> DataFrame:
    """V19 + A2/A3: the response fields of each batch."""
    status = F.create_map(*[x for k, v in OUTCOME_STATUS.items() for x in (F.lit(k), F.lit(v))])
    acc = F.col("outcome") == "accepted"
    return (summ.select(*BATCH_KEYS, "n_events", "lo", "hi").join(outcomes, BATCH_KEYS)
            .select(*BATCH_KEYS, "n_events", "outcome", status[F.col("outcome")].alias("http_status"),
                    F.when(acc, F.col("n_events")).otherwise(F.lit(0)).cast("long").alias("accepted"),
                    F.when(acc, F.col("hi")).alias("seq_high"), "high_before", "lo", "dup_ids"))


def batch_outcomes(subs: DataFrame, traces: DataFrame, stored: DataFrame | None = None, replay_all: bool = False) -> DataFrame:
    """V18/V19/V20 + A2/A3: one row per batch with outcome and response fields. The batch summaries are written once and
    folded from there. ``stored``: events accepted before (trace_id, event_id, seq)."""
    if replay_all:
        counts = id_counts(subs)
        summ = batch_summaries(batch_rows(flag_ids(subs, stored, counts)), traces, stored, in_batch_duplicates(counts))
        return respond(summ, fold_outcomes(summ, True))
    high = None if stored is None else stored.groupBy("trace_id").agg(F.max("seq").cast("int").alias("high0"))
    summ = written(request_summaries(subs, traces, high), "batch-summaries")
    return respond(summ, fold_outcomes(summ, stored=stored))


def mark_stored(summ: DataFrame, stored: DataFrame) -> DataFrame:
    """``dup_stored`` of batches with an id that ``stored`` (trace_id, event_id) holds."""
    ids = summ.where(F.col("pre").isNull()).select(*BATCH_KEYS, F.explode("rep_ids").alias("event_id"))
    hit = ids.join(stored.select("trace_id", "event_id"), ["trace_id", "event_id"], "left_semi").select(*BATCH_KEYS).distinct()
    return summ.drop("dup_stored").join(hit.withColumn("_hit", F.lit(True)), BATCH_KEYS, "left").withColumn("dup_stored", F.coalesce("_hit", F.lit(False))).drop("_hit")


def state_conflicts(subs: DataFrame, traces: DataFrame) -> DataFrame:
    """Batches refused for their trace's status, from their own rows (no fold)."""
    summ = batch_summaries(batch_rows(subs.withColumn("_rep", F.lit(None).cast("boolean")).withColumn("_in_store", F.lit(None).cast("boolean"))), traces)
    return summ.where(F.col("pre") == "state").select(*BATCH_KEYS, F.col("_status").alias("status"))


def accepted_events(subs: DataFrame, outcomes: DataFrame) -> DataFrame:
    """The events of accepted batches, ready to append to the event table."""
    ok = outcomes.where(F.col("outcome") == "accepted").select(*BATCH_KEYS)
    return subs.join(ok, BATCH_KEYS, "left_semi")


def _envelope_value(field: Column) -> Column:
    """JSON text of the typed envelope column that a violation names; NULL if it is null."""
    name = F.regexp_extract(field, r"^events\.[0-9]+\.(.*)$", 1)
    quoted = lambda c: F.when(F.col(c).isNotNull(), F.to_json(F.struct(F.col(c).alias("v"))))
    text = lambda c: F.regexp_extract(quoted(c), r"^\{\"v\":(.*)\}$", 1)
    return (F.when(name == "seq", F.col("seq").cast("string")).when(name == "ts_ms", F.col("ts_ms").cast("string")).when(name == "type", text("type"))
            .when(name == "actor.kind", text("actor_kind")).when(name == "payload", F.nullif(F.trim("payload_json"), F.lit("null"))))


def violation_report(subs: DataFrame) -> DataFrame:
    """Per batch with schema errors, ``{detail, errors[]}`` as in the API, each error with its field, message and
    the offending value (left out when null).

    Envelope errors win; payload errors are reported only when the whole
    batch passed the envelope phase. Errors ordered by (pos, rule)."""
    rows = batch_rows(subs).select(*BATCH_KEYS, "pos", "seq", "ts_ms", "type", "actor_kind", "payload_json", "env", "pay")
    kept = [*BATCH_KEYS, "pos", "seq", "ts_ms", "type", "actor_kind", "payload_json"]
    items = rows.select(*kept, F.explode_outer("env").alias("e"), F.lit(0).alias("phase")) \
        .unionByName(rows.select(*kept, F.explode_outer("pay").alias("e"), F.lit(1).alias("phase"))) \
        .where(F.col("e").isNotNull())
    inner = F.regexp_extract("e.field", r"^events\.[0-9]+\.payload\.(.*)$", 1)
    value = F.when(F.col("phase") == 0, _envelope_value(F.col("e.field"))).otherwise(offending_value(F.col("payload_json"), inner, F.col("e.code")))
    per = (items.groupBy(*BATCH_KEYS)
           .agg(F.min("phase").alias("_phase"),
                F.sort_array(F.collect_list(F.struct("phase", "pos", F.col("e.idx").alias("idx"),
                                                     F.col("e.field").alias("field"),
                                                     F.col("e.message").alias("message"), value.alias("value")))).alias("_errs")))
    errs = F.filter("_errs", lambda e: e["phase"] == F.col("_phase"))
    err_json = F.transform(errs, lambda e: F.to_json(F.struct(e["field"].alias("field"), e["message"].alias("message"), e["value"].alias("value"))))
    return per.select(*BATCH_KEYS, F.size(errs).cast("long").alias("n_errors"),
                      F.concat(F.size(errs).cast("string"), F.lit(" validation error(s)")).alias("summary"),
                      F.concat(F.lit('{"detail":"Validation failed","errors":['), F.array_join(err_json, ","),
                               F.lit("]}")).alias("body"))
