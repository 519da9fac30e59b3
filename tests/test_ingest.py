"""Acceptance fold vs a sequential plain-Python model of the ingestion API."""

import json
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tracewright.operators.ingest import batch_outcomes
from tracewright.operators.ranking import position_in_group

GOOD = json.dumps({"cwd": "/w", "command": "ls"})


def model(batches, status):
    """batches: list of (trace, batch_no, [(event_id, seq, payload_ok)]) in order."""
    high, stored, out = {}, {}, {}
    for trace, bno, evs in sorted(batches, key=lambda b: (b[0], b[1])):
        if not all(ok for _, _, ok in evs) or any(s < 1 for _, s, _ in evs) or len(evs) > 100:
            out[(trace, bno)] = "schema"; continue
        if trace not in status:
            out[(trace, bno)] = "missing"; continue
        if status[trace] != "collecting":
            out[(trace, bno)] = "state"; continue
        prev, bad = high.get(trace, 0), False
        for _, s, _ in evs:
            bad |= s <= prev
            prev = s
        if bad:
            out[(trace, bno)] = "seq"; continue
        ids = [e for e, _, _ in evs]
        if set(ids) & stored.get(trace, set()):
            out[(trace, bno)] = "duplicate"; continue
        if len(set(ids)) < len(ids):
            out[(trace, bno)] = "duplicate_in_batch"; continue
        out[(trace, bno)] = "accepted"
        high[trace] = max(s for _, s, _ in evs)
        stored.setdefault(trace, set()).update(ids)
    return out


def test_fold_matches_sequential_model(spark):
    rnd = random.Random(11)
    status = {"t0": "collecting", "t1": "collecting", "t2": "complete"}
    batches, rows = [], []
    for trace in ["t0", "t1", "t2", "t9"]:
        seq = 0
        for bno in range(25):
            evs = []
            for pos in range(rnd.randint(1, 4)):
                seq += rnd.choice([1, 1, 1, 2, 0, -1])
                eid = f"e{rnd.randint(0, 40)}" if rnd.random() < 0.3 else f"{trace}-{bno}-{pos}"
                ok = rnd.random() > 0.05
                evs.append((eid, seq, ok))
                rows.append((trace, bno, pos, eid, seq, 1000 + seq, "terminal_command", "human",
                             GOOD if ok else "{}"))
            batches.append((trace, bno, evs))
    subs = spark.createDataFrame(rows, "trace_id string, batch_no int, pos int, event_id string, seq int, "
                                       "ts_ms long, type string, actor_kind string, payload_json string")
    traces = spark.createDataFrame(list(status.items()), "trace_id string, status string")
    want = model(batches, status)
    for replay_all in (False, True):
        got = {(r.trace_id, r.batch_no): r.outcome for r in batch_outcomes(subs, traces, replay_all=replay_all).collect()}
        assert got == want


@pytest.mark.parametrize("conflict", [False, True])
def test_one_trace_of_100_000_batches(spark, conflict):
    """The fold of a hot trace is linear: with and without a conflict that makes it be replayed."""
    from tracewright.operators.ingest import fold_outcomes
    n = 100_000
    summ = spark.range(n).select(
        F.lit("hot").alias("trace_id"), F.col("id").cast("int").alias("batch_no"), F.lit(None).cast("string").alias("pre"),
        (F.col("id") * 2 + 1).cast("int").alias("lo"), (F.col("id") * 2 + 2).cast("int").alias("hi"), F.lit(False).alias("internal_bad"),
        F.lit(False).alias("dup_stored"), F.lit(False).alias("dup_in_batch"),
        F.when(F.col("id").isin(*([10, 70_000] if conflict else [])), F.array(F.lit("x"))).otherwise(F.array().cast("array<string>")).alias("rep_ids"),
        F.lit(0).alias("high0"))
    got = fold_outcomes(summ).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"), F.max("high_before").alias("h")).collect()
    assert {r.outcome: (r.n, r.h) for r in got} == ({"accepted": (n - 1, 2 * n - 2), "duplicate": (1, 140_000)} if conflict else {"accepted": (n, 2 * n - 2)})


@pytest.mark.parametrize("aqe,partitions", [("true", 8), ("true", 16), ("true", 200), ("false", 8), ("false", 16), ("false", 200)])
def test_position_in_group_with_a_hot_key(spark, tmp_path, aqe, partitions):
    """Written in full, with a wide column, equal to row_number at every setting."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", aqe)
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        n = 210_000
        df = spark.range(n).select(
            F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 97)).alias("k"),
            "id", (F.col("id") * 7919 % 50_021).alias("ts"), F.repeat(F.col("id").cast("string"), 40).alias("wide"))
        position_in_group(df, ["k"], ["ts", "id"]).write.parquet(str(tmp_path / "got"))
        got = spark.read.parquet(str(tmp_path / "got"))
        want = df.withColumn("want", F.row_number().over(Window.partitionBy("k").orderBy("ts", "id")))
        assert got.count() == n
        assert got.join(want.select("id", "want"), "id").where("pos <> want").count() == 0
        assert got.agg(F.countDistinct("id")).first()[0] == n and got.where("length(wide) = 0").count() == 0
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_position_in_group_nulls_and_empty(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, 5), ("a", 3, None), ("b", 4, -10**15), ("b", 5, 10**15)], "k string, id int, ts long")
    assert sorted((r.k, r.id, r.pos) for r in position_in_group(df, ["k"], ["ts", "id"]).collect()) == [
        ("a", 1, 1), ("a", 2, 3), ("a", 3, 2), ("b", 4, 1), ("b", 5, 2)]
    assert position_in_group(df.limit(0), ["k"], ["ts", "id"]).count() == 0


def random_trace(rnd, trace, n, far):
    """Batches with repeated ids near and far, lowered and equal seqs, and bad payloads."""
    rows, batches, seq, ids = [], [], 0, []
    for bno in range(n):
        evs = []
        for pos in range(rnd.randint(1, 3)):
            seq += rnd.choice([1, 1, 1, 1, 2, 0, -1, -4 if far else 1])
            new = f"{trace}-{bno}-{pos}"
            eid = rnd.choice(ids[-6:] if not far or rnd.random() < 0.5 else ids) if ids and rnd.random() < 0.15 else new
            ids.append(eid)
            ok = rnd.random() > 0.03
            evs.append((eid, seq, ok))
            rows.append((trace, bno, pos, eid, seq, 1000, "terminal_command", "human", GOOD if ok else "{}"))
        batches.append((trace, bno, evs))
    return rows, batches


SUBS = "trace_id string, batch_no int, pos int, event_id string, seq int, ts_ms long, type string, actor_kind string, payload_json string"


@pytest.mark.parametrize("seed,run", [(1, 256), (2, 4), (3, 2)])
def test_segments_match_the_sequential_model(spark, monkeypatch, seed, run):
    from tracewright.operators import fold
    monkeypatch.setattr(fold, "RUN", run)
    monkeypatch.setattr(fold, "WHOLE", 0 if seed < 3 else 39)
    rnd = random.Random(seed)
    rows, batches = [], []
    for t in range(12):
        r, b = random_trace(rnd, f"t{t}", 40 if t % 3 else 39, far=t % 2 == 0)
        rows += r
        batches += b
    status = {f"t{t}": "collecting" for t in range(11)}
    out = batch_outcomes(spark.createDataFrame(rows, SUBS), spark.createDataFrame(list(status.items()), "trace_id string, status string"))
    got = {(r.trace_id, r.batch_no): r for r in out.collect()}
    want = model(batches, status)
    assert {k: r.outcome for k, r in got.items()} == want
    assert set(want.values()) >= {"accepted", "seq", "duplicate", "schema", "missing"}
    for t in status:  # the mark before each batch, and the ids that refused it
        high, stored = 0, set()
        for _, bno, evs in sorted(b for b in batches if b[0] == t):
            r = got[t, bno]
            assert r.high_before == high
            if r.outcome == "duplicate":
                assert set(r.dup_ids) == stored & {e for e, _, _ in evs}
            if r.outcome == "accepted":
                high = evs[-1][1]
                stored |= {e for e, _, _ in evs}


def test_a_hot_trace_is_cut_into_many_segments(spark):
    """A third of all batches in one trace, with conflicts everywhere, falls into small segments of independent work."""
    from tracewright.operators import fold
    rows, _ = random_trace(random.Random(5), "hot", 900, far=False)
    for t in range(60):
        rows += random_trace(random.Random(t), f"t{t}", 30, far=False)[0]
    traces = spark.createDataFrame([("hot", "collecting")] + [(f"t{t}", "collecting") for t in range(60)], "trace_id string, status string")
    from tracewright.operators.ingest import request_summaries
    cut = fold.segments(request_summaries(spark.createDataFrame(rows, SUBS), traces)).where("trace_id = 'hot'")
    n, most = cut.groupBy("segment").count().agg(F.count(F.lit(1)), F.max("count")).first()
    assert n > 200 and most < 60


def test_an_oversized_batch_is_refused_by_its_size(spark):
    rows = [("t", 0, i, f"e{i % 50}", i + 1, 1000, "terminal_command", "human", GOOD) for i in range(5000)] + [("t", 1, 0, "e0", 1, 1000, "terminal_command", "human", GOOD)]
    got = batch_outcomes(spark.createDataFrame(rows, SUBS), spark.createDataFrame([("t", "collecting")], "trace_id string, status string"))
    assert sorted((r.batch_no, r.outcome, r.n_events, r.high_before) for r in got.collect()) == [(0, "schema", 5000, 0), (1, "accepted", 1, 0)]
