"""The bucketed event store and the stored QA records."""

import tempfile

import pytest
from pyspark.sql import functions as F

from tracewright.operators.event_store import EventStore
from tracewright.operators.qa_store import JUDGE, TESTS, QaStore, apply_judge, apply_tests

EVENT = "trace_id string, event_id string, seq int, ts_ms long, type string, actor struct<kind:string,id:string>, context struct<workspace_root:string,branch:string,commit_head:string,correlation_id:string,parent_event_id:string>, payload_json string"


def events(spark, n=3000):
    """A third of all events in one trace."""
    rows = [("hot" if i % 3 == 0 else f"t{i % 40}", f"e{i}", i, i, "commit", ("human", f"a{i % 5}"), ("/w", "main", None, None, f"e{i - 1}") if i % 2 else None, "{}") for i in range(n)]
    return spark.createDataFrame(rows, EVENT)


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange ")


def test_events_come_back_whole_and_joins_by_trace_move_no_event(spark):
    path = tempfile.mkdtemp(prefix="tw-es-")
    ev = events(spark)
    store = EventStore(spark, path, 16).write(ev)
    assert sorted(map(str, store.events().collect())) == sorted(map(str, ev.collect()))
    assert [r.trace_id for r in store.hot_ids().collect()] == ["hot"] and store.hot().count() == 1000
    other = EventStore(spark, tempfile.mkdtemp(prefix="tw-es-"), 16)
    traces = ev.select("trace_id").distinct().withColumn("status", F.concat(F.lit("s-"), "trace_id"))
    joined = store.main().join(traces.hint("merge"), "trace_id")
    plan = joined._jdf.queryExecution().sparkPlan().toString() + joined._jdf.queryExecution().executedPlan().toString()
    event_side = plan[plan.index("Bucketed: true") - 3000 if plan.index("Bucketed: true") > 3000 else 0:]
    assert "Bucketed: true" in event_side
    marks = store.main().groupBy("trace_id").agg(F.max("seq"))
    assert exchanges(marks) == 0  # an aggregate by trace needs none at all
    bucketed = spark.table(store.table).alias("a").join(spark.table(store.table).groupBy("trace_id").agg(F.max("seq").alias("high")).hint("merge"), "trace_id")
    assert exchanges(bucketed) == 0  # nor a join of two sides in the same buckets
    got = store.with_traces(traces).groupBy("status").count().collect()
    assert {r.status: r["count"] for r in got} == {f"s-{r.trace_id}": r["count"] for r in ev.groupBy("trace_id").count().collect()}
    assert store.with_traces(traces.where("trace_id <> 'hot'"), "left").where("status is null").count() == 1000
    assert store.with_traces(traces.where("trace_id in ('hot', 't1')"), "left_semi").select("trace_id").distinct().count() == 2
    assert {r.trace_id: r.h for r in store.per_trace(F.max("seq").alias("h")).collect()} == {r.trace_id: r.h for r in ev.groupBy("trace_id").agg(F.max("seq").alias("h")).collect()}
    assert other.table != store.table


def test_only_the_event_side_of_a_foreign_join_stays_in_place(spark):
    store = EventStore(spark, tempfile.mkdtemp(prefix="tw-es-"), 16).write(events(spark))
    traces = spark.range(40).select(F.concat(F.lit("t"), "id").alias("trace_id"), F.lit("x").alias("status"))
    plan = store.main().join(traces.hint("merge"), "trace_id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1  # the traces are brought to the buckets


def test_another_session_opens_the_table_and_one_trace_reads_one_bucket(spark):
    path = tempfile.mkdtemp(prefix="tw-es-")
    ev = events(spark)
    EventStore(spark, path, 16).write(ev)
    store = EventStore(spark.newSession(), path, 16)
    store.spark.sql(f"DROP TABLE IF EXISTS {store.table}")
    store.open()
    one = store.of_trace("t7")
    assert store.main().where("trace_id = 't7'").rdd.getNumPartitions() == 1 < store.main().rdd.getNumPartitions()  # one bucket's file is read
    assert sorted(r.event_id for r in one.collect()) == sorted(r.event_id for r in ev.where("trace_id = 't7'").collect())
    assert store.of_trace("hot").count() == 1000 and store.of_trace("none").count() == 0


def test_an_empty_event_table(spark):
    store = EventStore(spark, tempfile.mkdtemp(prefix="tw-es-"), 4).write(events(spark).limit(0))
    assert store.events().count() == 0 and store.per_trace(F.count(F.lit(1)).alias("n")).count() == 0


def staged(spark, path):
    store = QaStore(spark, path, 8).create(spark.createDataFrame(
        [("a", "finalizing"), ("b", "finalizing"), ("c", "finalizing"), ("d", "collecting"), ("e", "finalizing")], "trace_id string, status string"))
    tests = spark.createDataFrame([("a", "pytest", 2, True), ("b", "pytest", 1, False), ("d", "pytest", 1, True), ("e", "pytest", 3, True)], "trace_id string, runner string, n_invocations long, final_passed boolean")
    judged = spark.createDataFrame([("a", "ok", ("m", "1.0", 4.5, "sha256:1", ["exemplary_trace"])), ("b", "invalid_json", None), ("c", "ok", ("m", "1.0", 1.0, "sha256:2", []))],
                                   f"trace_id string, outcome string, judge {JUDGE}")
    return store, tests, judged


WANT = {("a", "complete", True, "pytest", 4.5, None), ("b", "failed", True, "pytest", None, "judge invalid_json"), ("c", "failed", False, None, None, "no test invocations"),
        ("d", "collecting", None, None, None, None), ("e", "failed", True, "pytest", None, "no judge response")}


def rows(store):
    return {tuple(r) for r in store.records().select("trace_id", "status", "schema_valid", "tests.runner", "judge.overall", "error").collect()}


def test_stages_change_the_stored_records(spark):
    store, tests, judged = staged(spark, tempfile.mkdtemp(prefix="tw-qa-"))
    apply_tests(store, tests)
    assert ("c", "failed", False, None, None, "no test invocations") in rows(store) and ("a", "finalizing", True, "pytest", None, None) in rows(store)
    apply_judge(store, judged)
    assert rows(store) == WANT


@pytest.mark.parametrize("broken", ["before", "half"])
def test_a_failed_upsert_is_repeated(spark, monkeypatch, broken):
    """The write fails before any bucket is replaced, or after some are: the stage run again gives the same records."""
    store, tests, judged = staged(spark, tempfile.mkdtemp(prefix="tw-qa-"))
    put = QaStore._put

    def fails(self, rows_, mode):
        if broken == "half":
            put(self, rows_.where("bucket % 2 = 0"), mode)
        raise OSError("lost")

    update = tests.where("trace_id <> 'd'").select("trace_id", F.struct("runner", F.lit(None).cast("string").alias("container_image"), "n_invocations", "final_passed").cast(TESTS).alias("tests"))
    monkeypatch.setattr(QaStore, "_put", fails)
    with pytest.raises(OSError):
        store.upsert(update)
    monkeypatch.setattr(QaStore, "_put", put)
    for _ in range(2):
        store.upsert(update)
    apply_tests(store, tests)
    apply_judge(store, judged)
    assert rows(store) == WANT


def test_an_upsert_touches_its_buckets_only_and_adds_new_traces(spark):
    store, tests, _ = staged(spark, tempfile.mkdtemp(prefix="tw-qa-"))
    seen = lambda: {r.f for r in spark.read.parquet(store.path).select(F.input_file_name().alias("f")).collect()}
    before = seen()
    store.upsert(spark.createDataFrame([("a", "failed")], "trace_id string, status string"))
    assert len(before - seen()) == 1
    store.upsert(spark.createDataFrame([("new", "collecting")], "trace_id string, status string"))
    assert {r.trace_id: r.status for r in store.records().collect()}["new"] == "collecting"
    store.upsert(spark.createDataFrame([], "trace_id string, status string"))
    assert store.records().count() == 6


def test_documents_carry_actor_and_context_of_stored_events(spark):
    from tracewright.operators.lifecycle import event_parts
    store = EventStore(spark, tempfile.mkdtemp(prefix="tw-es-"), 4).write(events(spark, 600))
    parts = event_parts(store.events(), 100)
    assert parts.select(F.max(F.size("events"))).first()[0] <= 100
    got = {e.event_id: e for r in parts.collect() for e in r.events}
    assert len(got) == 600 and got["e7"].actor.id == "a2" and got["e7"].context.parent_event_id == "e6" and got["e8"].context is None
    assert all([e.seq for e in r.events] == sorted(e.seq for e in r.events) for r in parts.collect())
