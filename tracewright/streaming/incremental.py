"""Incremental ingestion with Structured Streaming.

Submissions arrive as files; each micro-batch runs the batch ingestion
operators against a compact index of what earlier epochs stored
(``streaming/state.py``), never against the stored events themselves:

* high-water mark per trace from the index's marks (A1), stored ids from its
  Bloom filters and, for the ids they let through, its id lists (V13);
* accepted events go to the stored table under ``epoch=<id>``, outcomes to an
  outcome table and the index's parts likewise; a retried epoch overwrites its
  own parts instead of rejecting its rows as duplicates (X3), and reads only
  what earlier epochs wrote;
* late / out-of-order events are rejected by the seq rule (X4); finalized
  traces refuse events through the status check (X5). No watermark and no
  unbounded operator state are needed.

An epoch is written by as many tasks as the shuffle has: events are dealt by
trace and stretch of seq, so a hot trace is no single task, and sorted by
(trace_id, seq).
"""

from __future__ import annotations

import os
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.operators import ingest as I
from tracewright.operators.common import written
from tracewright.operators.fold import large_traces
from tracewright.schemas import SUBMISSION_TABLE
from tracewright.session import scratch_path
from tracewright.streaming.state import StateIndex

EVENT_COLS = ["trace_id", "event_id", "seq", "ts_ms", "type", "actor_kind", "payload_json"]
STRETCH = 4096  # seq values of a trace that one task writes


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def stored_events(spark: SparkSession, table: str, before_epoch: int | None = None) -> DataFrame | None:
    if not _exists(spark, table):
        return None
    df = spark.read.parquet(table)
    if before_epoch is not None:
        df = df.where(F.col("epoch") < before_epoch)  # partition pruning on epoch
    return df


def ingest_epoch(spark: SparkSession, batch: DataFrame, epoch_id: int, traces: DataFrame,
                 events_table: str, outcomes_table: str) -> None:
    """One micro-batch: fold its request batches onto the state that earlier epochs left. The index stands beside the event
    table. What needs only the batch (summaries, the look-up of its ids, its large traces) runs side by side, and so do the writes."""
    index = StateIndex(spark, os.path.join(os.path.dirname(events_table), "state"))
    with ThreadPoolExecutor(3) as pool:
        summaries = pool.submit(lambda: written(I.request_summaries(batch, traces, index.highs(epoch_id)), "epoch-summaries"))
        stored = pool.submit(index.stored_ids, batch.select("trace_id", "event_id"), epoch_id)
        large = pool.submit(large_traces, batch.select("trace_id", "batch_no").distinct())
        summ = summaries.result()
        outcomes = I.fold_outcomes(summ, stored=stored.result(), large=large.result())
    out = I.respond(summ, outcomes).select("trace_id", "batch_no", "n_events", "outcome", "http_status", "accepted", "seq_high", "high_before")
    at = f"{outcomes_table}/epoch={epoch_id}"
    out.write.mode("overwrite").parquet(at)
    done = spark.read.schema(out.schema).parquet(at).where(F.col("outcome") == "accepted")

    def events() -> None:
        acc = I.accepted_events(batch, done).select(*EVENT_COLS).withColumn("_stretch", F.floor(F.col("seq") / STRETCH))
        (acc.repartition("trace_id", "_stretch").sortWithinPartitions("trace_id", "seq").drop("_stretch")
         .write.mode("overwrite").parquet(f"{events_table}/epoch={epoch_id}"))

    def marks() -> None:
        index.add_highs(done.groupBy("trace_id").agg(F.max("seq_high").alias("high0")), epoch_id)

    def claims() -> None:
        accepted = summ.join(done.select("trace_id", "batch_no"), ["trace_id", "batch_no"], "left_semi")
        index.add_ids(accepted.select("trace_id", F.explode("rep_ids").alias("event_id")), epoch_id)

    with ThreadPoolExecutor(3) as pool:  # three independent writes
        for f in [pool.submit(w) for w in (events, marks, claims)]:
            f.result()


def run_incremental(spark: SparkSession, source_dir: str, traces: DataFrame, work_dir: str,
                    files_per_trigger: int | None = None) -> tuple[str, str]:
    """Process what has arrived since the last run (``availableNow``) and return
    the paths of the stored event table and the outcome table. Without
    ``files_per_trigger`` all new files are one epoch. ``traces`` is the trace table as it stands now."""
    events_table = os.path.join(work_dir, "events")
    outcomes_table = os.path.join(work_dir, "outcomes")
    reader = spark.readStream.schema(SUBMISSION_TABLE)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    q = (reader.parquet(source_dir).writeStream
         .foreachBatch(lambda df, eid: ingest_epoch(spark, df, eid, traces, events_table, outcomes_table))
         .option("checkpointLocation", os.path.join(work_dir, "checkpoint"))
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    return events_table, outcomes_table


def arrive(subs: DataFrame, source_dir: str) -> None:
    """Append submissions to the source folder, by as many tasks as the shuffle has."""
    subs.select(*SUBMISSION_TABLE.names).repartition("trace_id", "batch_no").write.mode("append").parquet(source_dir)


def epoch_bounds(subs: DataFrame, epochs: int) -> list[int]:
    """Last batch number of each epoch but the last, so that epochs hold about equally many rows: fewer than ``epochs`` numbers."""
    cuts = subs.agg(F.percentile_approx("batch_no", [i / epochs for i in range(1, epochs)], 10_000)).first()[0]
    return sorted(set(cuts or []))


def replay_incremental(spark: SparkSession, subs: DataFrame, traces: DataFrame, epochs: int = 6) -> DataFrame:
    """Replay submissions through the stream: ranges of batch_no with about equally many rows arrive one after
    another, however many batches a trace has, and each is an epoch against what the earlier ones stored. Returns the
    stored (accepted) events. Uses a fresh folder under the shared checkpoint folder per run."""
    work = scratch_path(spark, f"tw-stream-{uuid.uuid4().hex}")
    source = os.path.join(work, "incoming")
    bounds = epoch_bounds(subs, epochs)
    no = F.col("batch_no")
    for lo, hi in zip([None, *bounds], [*bounds, None]):
        arrive(subs.where((F.lit(True) if lo is None else no > lo) & (F.lit(True) if hi is None else no <= hi)), source)
        run_incremental(spark, source, traces, work)
    stored = stored_events(spark, os.path.join(work, "events"))
    return stored if stored is not None else spark.createDataFrame([], SUBMISSION_TABLE)
