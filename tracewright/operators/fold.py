"""The acceptance fold of a trace's batches, cut into segments that are replayed side by side.

Whether a batch is accepted depends on the earlier *accepted* batches of its trace: on the high-water mark they left
and on the event ids they claimed. Most of that is known without a replay:

* A batch that its own rows rule out (``pre``, or a bad step inside) never counts: it is decided at once.
* The others are *open*. The ``hi`` of all earlier open batches bounds the mark from above. An open batch whose ``lo`` is
  above that bound, which repeats no id of an earlier open batch, no stored id and none of its own is *sure*: it is
  accepted whatever happened before it, and leaves exactly its ``hi`` as the mark.
* An id that a sure batch claims makes every later open batch with that id a duplicate (or a sequence error): known as well.
* Only an id whose first open batch is not sure links that batch to the later ones.

A sure batch begins a new segment if no such link spans it. Inside a segment the replay needs nothing from before but
the ids claimed by sure batches, which it is given; so segments of one trace are replayed in parallel, each in the
order of batch_no and in memory bounded by the segment's unsettled ids. The mark before a batch is then the running
maximum over accepted batches, in slices of batch numbers. A trace that holds a third of all batches is spread over
tasks in every step; only a stretch of batches that all contradict each other is one task's work.

Cutting takes a dozen shuffles of the summaries, so it is done for traces of more than ``WHOLE`` batches only. A trace
within that bound is one small group: it is replayed whole after a single shuffle. Both ways give the same rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracewright.operators.common import written

KEYS = ["trace_id", "batch_no"]
SUMMARY = ["pre", "lo", "hi", "internal_bad", "dup_stored", "dup_in_batch", "rep_ids", "high0"]
WHOLE = 1024  # batches of a trace that are replayed in one group
RUN = 256  # batch numbers in a slice of a running maximum


def running_max(df: DataFrame, col: str, out: str, including: bool = False) -> DataFrame:
    """Add ``out``: the greatest ``col`` of the trace's earlier batches (``including`` the batch itself). The maximum runs
    inside slices of ``RUN`` batch numbers and over slice maxima, so a trace with very many batches is spread over tasks."""
    x = df.withColumn("_slice", F.floor(F.col("batch_no") / RUN).cast("int"))
    slices = Window.partitionBy("trace_id").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    tops = x.groupBy("trace_id", "_slice").agg(F.max(col).alias("_top"))
    tops = tops.select("trace_id", "_slice", F.max("_top").over(slices).alias("_sliced"))
    inside = Window.partitionBy("trace_id", "_slice").orderBy("batch_no").rowsBetween(Window.unboundedPreceding, 0 if including else -1)
    x = x.withColumn("_within", F.max(col).over(inside)).join(tops, ["trace_id", "_slice"])
    return x.withColumn(out, F.greatest("_within", "_sliced")).drop("_slice", "_within", "_sliced")


def _segment_replay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Open batches in the order of (trace, segment, batch_no): outcome and repeated ids of each. The first batch of a
    segment is sure, but in the segment before the trace's first sure batch, which starts from the stored mark."""
    segment, high, claimed = None, 0, set()
    for b in batches:
        out, dups = [], []
        cols = [b.column(b.schema.get_field_index(c)).to_pylist() for c in ("trace_id", "segment", "batch_no", "lo", "hi", "high0", "known", "twice", "ids")]
        for trace, seg, no, lo, hi, high0, known, twice, ids in zip(*cols):
            if (trace, seg) != segment:
                segment, high, claimed = (trace, seg), high0, set()
            again = [i for i in ids if i in claimed]
            outcome = ("accepted" if seg == no else "seq" if lo <= high else "duplicate" if known or again
                       else "duplicate_in_batch" if twice else "accepted")
            if outcome == "accepted":
                high = hi
                claimed.update(ids)
            out.append(outcome)
            dups.append(again)
        yield pa.RecordBatch.from_arrays([*(b.column(b.schema.get_field_index(c)) for c in KEYS), pa.array(out, pa.string()), pa.array(dups, pa.list_(pa.string()))],
                                         [*KEYS, "outcome", "again"])


def segments(summ: DataFrame) -> DataFrame:
    """The open batches with what their replay needs: ``segment`` (batch_no of the sure batch that begins it, -1 before the
    first), ``sure_ids`` (their ids that a sure batch claimed earlier) and ``ids`` (their unsettled ids)."""
    open_ = summ.where(F.col("pre").isNull() & ~F.col("internal_bad"))
    marked = running_max(open_, "hi", "_bound")
    occurs = open_.select(*KEYS, F.explode(F.array_distinct("rep_ids")).alias("id"))
    # `fo` and `last`: first and last open batch of an id that occurs in several
    ids = occurs.groupBy("trace_id", "id").agg(F.min("batch_no").alias("fo"), F.max("batch_no").alias("last")).where("fo < last")
    links = written(occurs.join(ids, ["trace_id", "id"]), "fold-links")
    repeats = links.groupBy(*KEYS).agg(F.max(F.col("fo") < F.col("batch_no")).alias("_repeats"))
    sure = ((F.col("lo") > F.greatest("high0", F.coalesce("_bound", F.lit(0)))) & ~F.col("dup_stored") & ~F.col("dup_in_batch")
            & ~F.coalesce("_repeats", F.lit(False)))
    marked = written(marked.join(repeats, KEYS, "left").select(*KEYS, "lo", "hi", "high0", "dup_stored", "dup_in_batch", sure.alias("sure")), "fold-open")
    firsts = marked.where("sure").select("trace_id", F.col("batch_no").alias("fo"), F.lit(True).alias("_settled"))
    unsettled = F.col("_settled").isNull()
    held = links.join(firsts, ["trace_id", "fo"], "left").groupBy(*KEYS).agg(
        F.collect_list(F.when(~unsettled & (F.col("fo") < F.col("batch_no")), F.col("id"))).alias("sure_ids"),
        F.collect_list(F.when(unsettled, F.col("id"))).alias("ids"), F.max(F.when(unsettled, F.col("last"))).alias("_reach"))
    x = running_max(marked.join(held, KEYS, "left"), "_reach", "_spans")
    x = x.withColumn("_cut", F.when(F.col("sure") & (F.coalesce("_spans", F.lit(-1)) < F.col("batch_no")), F.col("batch_no")))
    none = F.array().cast("array<string>")
    return running_max(x, "_cut", "_from", including=True).select(
        *KEYS, "lo", "hi", "high0", "dup_stored", "dup_in_batch", F.coalesce("_from", F.lit(-1)).alias("segment"),
        F.coalesce("sure_ids", none).alias("sure_ids"), F.coalesce("ids", none).alias("ids"))


def _replay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batch summaries in the order of (trace, batch_no): outcome of each, with the trace's mark and claimed ids as the only state."""
    trace, high, claimed = None, 0, set()
    for b in batches:
        out, before, dups = [], [], []
        cols = [b.column(b.schema.get_field_index(c)).to_pylist() for c in ["trace_id", *SUMMARY]]
        for t, pre, lo, hi, internal, stored, twice, ids, high0 in zip(*cols):
            if t != trace:
                trace, high, claimed = t, high0, set()
            again = [i for i in dict.fromkeys(ids) if i in claimed]
            outcome = pre or ("seq" if internal or lo <= high else "duplicate" if stored or again
                              else "duplicate_in_batch" if twice else "accepted")
            out.append(outcome)
            before.append(high)
            dups.append(again)
            if outcome == "accepted":
                high = hi
                claimed.update(ids)
        yield pa.RecordBatch.from_arrays(
            [*(b.column(b.schema.get_field_index(c)) for c in KEYS), pa.array(out, pa.string()), pa.array(before, pa.int32()), pa.array(dups, pa.list_(pa.string()))],
            [*KEYS, "outcome", "high_before", "dup_ids"])


def replayed_outcomes(summ: DataFrame) -> DataFrame:
    """The outcomes of ``summ``, each trace replayed whole in order of batch_no."""
    return (summ.select(*KEYS, *SUMMARY).repartition("trace_id").sortWithinPartitions(*KEYS)
            .mapInArrow(_replay, "trace_id string, batch_no int, outcome string, high_before int, dup_ids array<string>"))


def segmented_outcomes(summ: DataFrame) -> DataFrame:
    """The outcomes of ``summ`` by segments. ``summ`` is read several times: pass a written table."""
    open_ = written(segments(summ), "fold-segments")
    replayed = (open_.select("trace_id", "segment", "batch_no", "lo", "hi", "high0", (F.col("dup_stored") | (F.size("sure_ids") > 0)).alias("known"),
                             F.col("dup_in_batch").alias("twice"), "ids")
                .repartition("trace_id", "segment").sortWithinPartitions("trace_id", "segment", "batch_no")
                .mapInArrow(_segment_replay, "trace_id string, batch_no int, outcome string, again array<string>"))
    decided = written(replayed, "fold-replayed")
    fixed = F.coalesce("pre", F.when(F.col("internal_bad"), F.lit("seq")))
    x = (summ.select(*KEYS, "hi", "high0", fixed.alias("_fixed")).join(decided, KEYS, "left")
         .join(open_.where("size(sure_ids) > 0").select(*KEYS, "sure_ids"), KEYS, "left")
         .withColumn("outcome", F.coalesce("outcome", "_fixed")))
    x = running_max(x.withColumn("_accepted", F.when(F.col("outcome") == "accepted", F.col("hi"))), "_accepted", "_mark")
    none = F.array().cast("array<string>")
    return x.select(*KEYS, "outcome", F.greatest("high0", F.coalesce("_mark", F.lit(0))).cast("int").alias("high_before"),
                    F.array_distinct(F.concat(F.coalesce("sure_ids", none), F.coalesce("again", none))).alias("dup_ids"))


def large_traces(batches: DataFrame) -> list[DataFrame]:
    """The traces with more than ``WHOLE`` rows in ``batches`` (one row per batch), as one written table; no table if there are none."""
    large = batches.groupBy("trace_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > WHOLE).select("trace_id")
    return [] if large.isEmpty() else [written(large, "fold-large")]


def folded(summ: DataFrame, marked: DataFrame, large: list[DataFrame] | None = None) -> DataFrame:
    """(trace_id, batch_no, outcome, high_before, dup_ids) for each batch summary: pre, lo, hi, internal_bad, dup_stored,
    dup_in_batch, rep_ids (ids that may occur in other batches of the trace), high0. ``summ`` is a written table,
    ``marked`` has the same rows with ``dup_stored`` as it is to be. ``large``: ``large_traces`` of these batches, if known."""
    found = large_traces(summ) if large is None else large
    if not found:
        return replayed_outcomes(marked)
    large = found[0]
    rest, cut = marked.join(large, "trace_id", "left_anti"), written(marked.join(large, "trace_id", "left_semi"), "fold-cut")
    return replayed_outcomes(rest).unionByName(segmented_outcomes(cut))
