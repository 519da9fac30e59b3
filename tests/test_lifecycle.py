"""Lifecycle and blob cases that the given tables do not hold."""

import json

from pyspark.sql import functions as F

from tracewright.operators import ingest as I
from tracewright.operators import lifecycle as LC
from tracewright.operators.judge import parse_responses
from tracewright.operators.packet import blob_previews


def test_duration_is_given_or_end_minus_start(spark):
    df = spark.createDataFrame([("t", "a", 1, "c", 0, 5, 100, 400, "o", ""), ("t", "b", 2, "c", 1, None, 100, 400, None, "e")],
                               "trace_id string, invocation_id string, ts_ms long, command string, exit_code int, duration_ms long, "
                               "started_ms long, ended_ms long, stdout string, stderr string")
    got = {r.invocation_id: (r.duration_ms, r.passed, r.stdout_blob_id is None, r.stderr_blob_id is None) for r in LC.test_invocations(df).collect()}
    assert got == {"a": (5, True, False, True), "b": (300, False, True, False)}
    assert LC.test_invocations(df.drop("started_ms")).where("duration_ms is null").count() == 1


def test_judge_envelope_outcomes(spark):
    rows = [("a", "", False, None), ("b", "", True, "I cannot"), ("c", None, True, "I cannot"), ("d", "", True, ""), ("e", "{}", True, "ignored")]
    df = spark.createDataFrame(rows, "trace_id string, response_text string, has_choices boolean, refusal string")
    assert {r.trace_id: r.outcome for r in parse_responses(df).collect()} == {
        "a": "no_choices", "b": "refused", "c": "refused", "d": "invalid_json", "e": "failed_validation"}


def test_previews_of_bad_bytes_are_cut_below_the_join(spark):
    blobs = spark.createDataFrame([("b1", bytearray(b"ok \xff\xfe end")), ("b2", bytearray("é".encode() * 600)), ("b3", bytearray(b""))], "blob_id string, content binary")
    refs = spark.createDataFrame([("b1",), ("b2",), ("b2",), ("b3",), (None,)], "blob_id string")
    got = {r.blob_id: r for r in blob_previews(blobs, refs).collect()}
    assert got["b1"].p500 == b"ok \xff\xfe end".decode("utf-8", errors="replace") and "b3" not in got
    assert got["b2"].p500 == "é" * 500 + "..." and got["b2"].p200 == "é" * 200 + "..."
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = blob_previews(blobs, refs)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    below = plan[plan.index("SortMergeJoin"):]
    assert "substring" in below[below.index("Exchange"):]  # the cut stands under the join and its shuffle


def test_event_json_envelope(spark):
    good = {"event_id": "x", "seq": "5", "ts_ms": 1.0, "type": "commit", "actor": {"kind": "human", "id": None}, "context": {"branch": "b"}, "payload": {}}
    docs = [good, {**good, "seq": True}, {**good, "seq": 5.5}, {k: v for k, v in good.items() if k != "event_id"}, {**good, "event_id": None}, {**good, "actor": "human"},
            {**good, "context": {"branch": 1, "parent_event_id": []}}, {**good, "ts_ms": -1, "type": "nope", "payload": []}, {**good, "context": None}]
    df = spark.createDataFrame([("t", 0, i, json.dumps(d)) for i, d in enumerate(docs)], "trace_id string, batch_no int, pos int, event_json string")
    bad = {}
    for r in I.event_json_violations(df, ["pos"]).collect():
        bad.setdefault(r.pos, []).append((r.field.split(".", 2)[2], r.code))
    assert {k: sorted(v) for k, v in bad.items()} == {
        2: [("seq", "int_from_float")], 4: [("event_id", "string_type")], 5: [("actor", "dict_type")],
        6: [("context.branch", "string_type"), ("context.parent_event_id", "string_type")],
        7: [("payload", "dict_type"), ("ts_ms", "greater_than_equal"), ("type", "enum")]}
    got = {r.pos: r for r in I.typed_events(df).collect()}
    assert (got[0].seq, got[0].ts_ms, got[0].context.branch, got[0].payload_json) == (5, 1, "b", "{}") and got[1].seq == 1
    assert got[3].event_id.startswith("ev-") and len(got[3].event_id) == 67 and got[8].context is None


def test_upsert_keeps_or_replaces_sections(spark):
    schema = "trace_id string, tests struct<runner:string>, judge struct<overall:double>"
    old = spark.createDataFrame([("a", ("o",), (1.0,)), ("b", ("o",), None), ("c", None, (1.0,))], schema)
    tests = spark.createDataFrame([("a", ("n",)), ("c", ("n",)), ("d", ("n",))], "trace_id string, tests struct<runner:string>")
    judge = spark.createDataFrame([("b", (2.0,)), ("c", (2.0,))], "trace_id string, judge struct<overall:double>")
    got = {r.trace_id: (r.tests and r.tests.runner, r.judge and r.judge.overall) for r in LC.upsert_qa(old, tests, judge).collect()}
    assert got == {"a": ("n", 1.0), "b": ("o", 2.0), "c": ("n", 2.0), "d": ("n", None)}


def test_invocations_and_events_in_parts(spark):
    ev = spark.range(600).select(F.lit("t").alias("trace_id"), (F.col("id") + 1).cast("int").alias("seq"), F.col("id").cast("string").alias("event_id"),
                                 F.col("id").alias("ts_ms"), F.lit("commit").alias("type"), F.lit("human").alias("actor_kind"), F.lit("{}").alias("payload_json"))
    parts = {r.part_no: [e.seq for e in r.events] for r in LC.event_parts(ev).collect()}
    assert parts == {0: list(range(1, 257)), 1: list(range(257, 513)), 2: list(range(513, 601))}


def test_lookups_by_key_reach_the_scan(spark):
    import __spark_entry__ as E
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plans = {n: E.queries()[n](spark, E.SMOKE_DIR)._jdf.queryExecution().executedPlan().toString() for n in ("trace_lookup", "trace_event_slice")}
    assert "EqualTo(trace_id,t-42)" in plans["trace_lookup"]
    assert all(x in plans["trace_event_slice"] for x in ("EqualTo(trace_id,t-42)", "GreaterThanOrEqual(seq,5)", "LessThanOrEqual(seq,30)"))
