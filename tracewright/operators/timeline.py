"""Per-trace timelines and point lookups.

Whole-trace aggregates use only combinable aggregates (count, min, max), so a
hot trace is pre-aggregated map-side. Ordered text is built per bounded
*part* of a trace (``PART_EVENTS`` consecutive seq values), never for the whole
trace in one group: concatenating parts by ``part_no`` gives the full text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PART_EVENTS = 256  # events per ordered text part (bounds every group)


def part_no(seq: Column) -> Column:
    return ((seq - 1) / PART_EVENTS).cast("int")


def ordered_join(line: Column, order: Column, sep: str = "\n") -> Column:
    """Aggregate: lines joined in ``order`` (array sort of (order, line) pairs)."""
    pairs = F.sort_array(F.collect_list(F.struct(order.alias("k"), line.alias("v"))))
    return F.array_join(F.transform(pairs, lambda x: x["v"]), sep)


def session_summary(events: DataFrame) -> DataFrame:
    """A1/A3 per trace: event count, high-water mark, first/last timestamp, types seen."""
    return (events.groupBy("trace_id")
            .agg(F.count(F.lit(1)).alias("n_events"),
                 F.coalesce(F.max("seq"), F.lit(0)).alias("seq_high"),
                 F.min("ts_ms").alias("first_ts_ms"),
                 F.max("ts_ms").alias("last_ts_ms"),
                 F.countDistinct("type").alias("n_types"),
                 F.sum(F.when(F.col("type") == "test_run", 1).otherwise(0)).alias("n_test_runs")))


def timeline_parts(events: DataFrame) -> DataFrame:
    """Ordered ``seq:type`` text per bounded part of each trace."""
    return (events.withColumn("part_no", part_no(F.col("seq")))
            .groupBy("trace_id", "part_no")
            .agg(F.count(F.lit(1)).alias("n_events"),
                 F.min("seq").alias("seq_lo"), F.max("seq").alias("seq_hi"),
                 ordered_join(F.concat_ws(":", F.col("seq").cast("string"), F.col("type")), F.col("seq"), ",")
                 .alias("timeline")))


def trace_lookup(traces: DataFrame, trace_id: str) -> DataFrame:
    """F1/O3: point lookup by primary key (pushed down as a parquet filter)."""
    return traces.where(F.col("trace_id") == trace_id)


def trace_events(events: DataFrame, trace_ids: DataFrame) -> DataFrame:
    """events of a set of traces (left-semi join), ordered by (trace_id, seq)."""
    return events.join(trace_ids.select("trace_id").distinct(), "trace_id", "left_semi")
