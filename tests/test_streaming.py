"""A retried micro-batch rewrites its own rows instead of rejecting them."""

import json
import tempfile

from tracewright.streaming.incremental import ingest_epoch

CMD = json.dumps({"cwd": "/w", "command": "ls"})


def test_retried_epoch_is_idempotent(spark):
    work = tempfile.mkdtemp(prefix="tw-x3-")
    subs = spark.createDataFrame(
        [("t0", 0, 0, "e1", 1, 10, "terminal_command", "human", CMD),
         ("t0", 0, 1, "e2", 2, 11, "terminal_command", "human", CMD),
         ("t0", 1, 0, "e3", 3, 12, "terminal_command", "human", CMD)],
        "trace_id string, batch_no int, pos int, event_id string, seq int, ts_ms long, type string, "
        "actor_kind string, payload_json string")
    traces = spark.createDataFrame([("t0", "collecting")], "trace_id string, status string")
    ev, out = f"{work}/events", f"{work}/outcomes"
    for _ in range(2):  # the same epoch twice, as after a failure
        ingest_epoch(spark, subs, 0, traces, ev, out)
    assert sorted(r.event_id for r in spark.read.parquet(ev).collect()) == ["e1", "e2", "e3"]
    assert {r.outcome for r in spark.read.parquet(out).collect()} == {"accepted"}
    # the next epoch sees them as stored: a replayed batch is now a duplicate
    late = subs.where("batch_no = 1").selectExpr("trace_id", "2 AS batch_no", "pos", "event_id", "4 AS seq", "ts_ms",
                                                  "type", "actor_kind", "payload_json")
    ingest_epoch(spark, late, 1, traces, ev, out)
    assert [r.outcome for r in spark.read.parquet(out).where("epoch = 1").collect()] == ["duplicate"]


def test_epochs_meet_late_batches_stored_duplicates_and_finalized_traces(spark):
    from tracewright.streaming.incremental import arrive, run_incremental
    work = tempfile.mkdtemp(prefix="tw-x4-")
    schema = ("trace_id string, batch_no int, pos int, event_id string, seq int, ts_ms long, type string, "
              "actor_kind string, payload_json string")
    row = lambda t, b, p, e, s: (t, b, p, e, s, 10 + s, "terminal_command", "human", CMD)
    epochs = [
        [row("t0", 0, 0, "e1", 1), row("t0", 0, 1, "e2", 2), row("t1", 0, 0, "f1", 1)],
        [row("t0", 1, 0, "e5", 5), row("t1", 1, 0, "f2", 2)],
        [row("t0", 2, 0, "e3", 3), row("t1", 2, 0, "f3", 3)],      # t0: late, below the stored high-water mark
        [row("t0", 3, 0, "e1", 6), row("t1", 3, 0, "f4", 4)],      # t0: an id stored three epochs ago; t1: finalized meanwhile
        [row("t0", 4, 0, "e6", 6), row("t1", 4, 0, "f5", 5)],
    ]
    for i, rows in enumerate(epochs):
        traces = spark.createDataFrame([("t0", "collecting"), ("t1", "collecting" if i < 3 else "complete")], "trace_id string, status string")
        arrive(spark.createDataFrame(rows, schema), f"{work}/in")
        ev, out = run_incremental(spark, f"{work}/in", traces, work)
    got = {(r.trace_id, r.batch_no): (r.outcome, r.epoch) for r in spark.read.parquet(out).collect()}
    assert got == {("t0", 0): ("accepted", 0), ("t1", 0): ("accepted", 0), ("t0", 1): ("accepted", 1), ("t1", 1): ("accepted", 1),
                   ("t0", 2): ("seq", 2), ("t1", 2): ("accepted", 2), ("t0", 3): ("duplicate", 3), ("t1", 3): ("state", 3),
                   ("t0", 4): ("accepted", 4), ("t1", 4): ("state", 4)}
    assert sorted(r.event_id for r in spark.read.parquet(ev).collect()) == ["e1", "e2", "e5", "e6", "f1", "f2", "f3"]


SUBS = "trace_id string, batch_no int, pos int, event_id string, seq int, ts_ms long, type string, actor_kind string, payload_json string"


def test_index_finds_exactly_the_stored_ids_over_compactions(spark, monkeypatch):
    """Ten epochs of ids, a third of them in one trace; small filters, so that many foreign ids pass them."""
    from tracewright.streaming import state as S
    monkeypatch.setattr(S, "COMPACT", 3)
    index = S.StateIndex(spark, tempfile.mkdtemp(prefix="tw-idx-"), buckets=16, bits=256)
    row = lambda i: ("hot" if i % 3 == 0 else f"t{i % 7}", f"e{i}")
    ids = lambda lo, hi: spark.createDataFrame([row(i) for i in range(lo, hi)], "trace_id string, event_id string")
    assert index.highs(0) is None and index.stored_ids(ids(0, 5), 0) is None
    for e in range(10):
        for _ in range(1 + e % 2):  # every second epoch is retried
            index.add_ids(ids(100 * e, 100 * e + 100), e)
            index.add_highs(spark.createDataFrame([("hot", 10 * e), (f"t{e}", 5)], "trace_id string, high0 int"), e)
    for before, stored in ((1, 100), (4, 400), (10, 1000)):
        got = index.stored_ids(ids(50, 3000), before)
        assert {tuple(r) for r in got.collect()} == {row(i) for i in range(50, stored)}
    other = index.stored_ids(spark.createDataFrame([("hot", f"e{i}") for i in range(1, 999, 3)], "trace_id string, event_id string"), 10)
    assert other.count() == 0  # ids of other traces: let through by full filters, not found
    assert {r.trace_id: r.high0 for r in index.highs(10).collect()} == {"hot": 90} | {f"t{e}": 5 for e in range(10)}
    assert len(index._parts("highs", 10)) == 2 and index._parts("filters", 10)[0].endswith("base=8")
    names = lambda before: [p.rsplit("/", 1)[1] for p in index._id_parts(0, before)]
    assert names(2) == ["epoch=0", "epoch=1"] and names(5) == ["run1=2", "epoch=3", "epoch=4"]
    assert names(8) == ["run1=2", "run1=5", "epoch=6", "epoch=7"] and names(10) == ["run2=8", "epoch=9"]
    assert spark.read.parquet(f"{index.path}/ids/run2=8").count() == 900  # retried epochs are merged once


def test_an_epoch_reads_marks_and_filters_but_no_ids_without_a_hit(spark, monkeypatch):
    from tracewright.streaming import state as S
    index = S.StateIndex(spark, tempfile.mkdtemp(prefix="tw-idx-"))
    frame = lambda rows: spark.createDataFrame(rows, "trace_id string, event_id string")
    sizes = []
    for e in range(8):
        index.add_ids(frame([(f"t{i % 50}", f"e{e}-{i}") for i in range(2000)]), e)
        index.add_highs(spark.createDataFrame([(f"t{i}", e + 1) for i in range(50)], "trace_id string, high0 int"), e)
        sizes.append(spark.read.schema(S._FILTERS).parquet(*index._parts("filters", e + 1)).count() / len(index._parts("filters", e + 1)))
    assert max(sizes) <= S.BUCKETS  # a part has a row per bucket at most, however much is stored
    assert index._parts("filters", 8) == [f"{index.path}/filters/base=7"]
    monkeypatch.setattr(S.StateIndex, "_committed", lambda *a: (_ for _ in ()).throw(AssertionError("ids were read")))
    assert index.stored_ids(frame([("t1", "new-1"), ("t2", "new-2")]), 8) is None


def test_a_hot_trace_is_written_by_many_tasks(spark, monkeypatch):
    from tracewright.streaming import incremental as N
    monkeypatch.setattr(N, "STRETCH", 50)
    work = tempfile.mkdtemp(prefix="tw-hot-")
    rows = [("hot", i // 50, i % 50, f"e{i}", i + 1, 10, "terminal_command", "human", CMD) for i in range(2000)]
    N.ingest_epoch(spark, spark.createDataFrame(rows, SUBS), 0, spark.createDataFrame([("hot", "collecting")], "trace_id string, status string"), f"{work}/events", f"{work}/out")
    got = spark.read.parquet(f"{work}/events").selectExpr("event_id", "input_file_name() AS f").collect()
    assert len(got) == 2000
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        N.ingest_epoch(spark, spark.createDataFrame(rows, SUBS), 0, spark.createDataFrame([("hot", "collecting")], "trace_id string, status string"), f"{work}/events", f"{work}/out")
        assert len({r.f for r in spark.read.parquet(f"{work}/events").selectExpr("input_file_name() AS f").collect()}) > 4
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_epochs_have_about_equally_many_rows(spark):
    from tracewright.streaming.incremental import epoch_bounds
    rows = [(b,) for b in range(1000) for _ in range(20 if b < 10 else 1)]
    bounds = epoch_bounds(spark.createDataFrame(rows, "batch_no int"), 6)
    sizes = [sum(1 for (b,) in rows if lo < b <= hi) for lo, hi in zip([-1, *bounds], [*bounds, 10**9])]
    assert len(sizes) == 6 and max(sizes) < 1.3 * min(sizes)
    assert epoch_bounds(spark.createDataFrame([], "batch_no int"), 6) == []
