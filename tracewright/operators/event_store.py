"""The stored event table, bucketed by trace.

Events lie in ``buckets`` hash buckets of trace_id, sorted by (trace_id, seq). A join or aggregate by trace reads them where
they lie: no exchange on the event side, nor on the other side if that is stored in the same buckets. Actor and
context are stored as the normalized structs of the event model, the payload as it was sent.

A bucket is read by one task, so a trace must not outgrow one: traces of more than ``HOT`` times an even bucket's share
(fewer than ``buckets`` / ``HOT`` by that definition) stand in a table of their own, ranged by (trace_id, seq) over many files,
and meet the other side by a broadcast of the rows of these traces alone.

Bucket numbers are part of the file names; the table's definition is kept by the session's catalog under a name made
from the path, and ``open`` defines it again for another session.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.schemas import STORED_EVENT

BUCKETS = 64
HOT = 4


class EventStore:
    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS) -> None:
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets
        self.table = "tw_events_" + hashlib.sha1(f"{self.path}|{buckets}".encode()).hexdigest()[:16]

    def write(self, events: DataFrame) -> EventStore:
        """Store ``events`` (the columns of STORED_EVENT), replacing what the path holds."""
        events = events.select(*STORED_EVENT.fieldNames())
        per_trace = events.groupBy("trace_id").agg(F.count(F.lit(1)).alias("n"))
        total = per_trace.agg(F.sum("n")).first()[0] or 0
        hot = per_trace.where(F.col("n") * self.buckets > F.lit(HOT * total)).select("trace_id")
        hot.write.mode("overwrite").parquet(f"{self.path}/hot_ids")
        hot = F.broadcast(self.hot_ids())
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")
        (events.join(hot, "trace_id", "left_anti").repartition(self.buckets, "trace_id").sortWithinPartitions("trace_id", "seq")
         .write.mode("overwrite").option("path", f"{self.path}/main").bucketBy(self.buckets, "trace_id").sortBy("trace_id", "seq").saveAsTable(self.table))
        (events.join(hot, "trace_id", "left_semi").repartitionByRange("trace_id", "seq").sortWithinPartitions("trace_id", "seq")
         .write.mode("overwrite").parquet(f"{self.path}/hot"))
        return self

    def open(self) -> EventStore:
        """Define the table of a path that another session wrote."""
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in STORED_EVENT.fields)
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.table} ({columns}) USING parquet CLUSTERED BY (trace_id) SORTED BY (trace_id, seq) "
                       f"INTO {self.buckets} BUCKETS LOCATION '{self.path}/main'")
        return self

    def hot_ids(self) -> DataFrame:
        return self.spark.read.schema("trace_id string").parquet(f"{self.path}/hot_ids")

    def main(self) -> DataFrame:
        return self.spark.table(self.table)

    def hot(self) -> DataFrame:
        return self.spark.read.schema(STORED_EVENT).parquet(f"{self.path}/hot")

    def events(self) -> DataFrame:
        return self.main().unionByName(self.hot())

    def of_trace(self, trace_id: str) -> DataFrame:
        """one trace's events; the bucket of the id alone is read, and of the hot table the row groups that may hold it."""
        return self.main().where(F.col("trace_id") == trace_id).unionByName(self.hot().where(F.col("trace_id") == trace_id))

    def with_traces(self, traces: DataFrame, how: str = "inner") -> DataFrame:
        """Events joined with per-trace rows (unique ``trace_id``); ``how`` is inner, left or left_semi, events on the left."""
        hot = F.broadcast(traces.join(F.broadcast(self.hot_ids()), "trace_id", "left_semi"))
        return self.main().join(traces.hint("merge"), "trace_id", how).unionByName(self.hot().join(hot, "trace_id", how))

    def per_trace(self, *aggregates) -> DataFrame:
        """Aggregates by trace: inside each bucket without a shuffle, and of hot traces map-side first."""
        return self.main().groupBy("trace_id").agg(*aggregates).unionByName(self.hot().groupBy("trace_id").agg(*aggregates))
