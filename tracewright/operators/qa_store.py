"""Stored QA records, changed by upserts.

One row per trace: (trace_id, status, schema_valid, tests, judge, error), partitioned by hash bucket of the trace. An upsert
rewrites the buckets that its updates touch and no other, by dynamic partition overwrite: the merged rows are written
aside first and the buckets then replaced from there. Applying the same updates again gives the same rows, so an upsert
that failed at any point is simply repeated: a half-replaced table has some buckets new and the others old, and both
lead to the same result.

Stages, as columns of an update: ``tests`` or ``judge`` replaces that section and leaves the other; ``status``, ``error`` and
``schema_valid`` replace what is stored where they are not null. A failed test stage stores schema_valid = false, a failed
judge stage leaves it as it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.operators.common import written

BUCKETS = 64
TESTS = "struct<runner:string,container_image:string,n_invocations:bigint,final_passed:boolean>"
JUDGE = ("struct<model:string,rubric_version:string,overall:double,rationale_blob_id:string,flags:array<string>>")
RECORD = f"trace_id string, status string, schema_valid boolean, tests {TESTS}, judge {JUDGE}, error string"
_COLUMNS = ["trace_id", "status", "schema_valid", "tests", "judge", "error"]


class QaStore:
    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS) -> None:
        self.spark, self.path, self.buckets = spark, path, buckets

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64("trace_id"), F.lit(self.buckets)).cast("int")

    def _put(self, rows: DataFrame, mode: str) -> None:
        """Rows to their buckets, a bucket by one task: rows are one per trace, so buckets are even."""
        (rows.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy("bucket").parquet(self.path))

    def create(self, traces: DataFrame) -> QaStore:
        """A record per trace (trace_id, status) without any QA yet."""
        null = lambda kind: F.lit(None).cast(kind)
        rows = traces.select("trace_id", "status", null("boolean").alias("schema_valid"), null(TESTS).alias("tests"), null(JUDGE).alias("judge"), null("string").alias("error"))
        self._put(rows.withColumn("bucket", self._bucket()), "static")
        return self

    def records(self) -> DataFrame:
        return self.spark.read.schema(f"{RECORD}, bucket int").parquet(self.path).select(*_COLUMNS)

    def upsert(self, updates: DataFrame) -> None:
        """``updates``: trace_id (unique) and any of status, schema_valid, tests, judge, error. Traces without a record get one."""
        new = written(updates.withColumn("bucket", self._bucket()), "qa-updates")
        touched = [r["bucket"] for r in new.select("bucket").distinct().collect()]  # at most `buckets` numbers
        if not touched:
            return
        old = self.spark.read.schema(f"{RECORD}, bucket int").parquet(self.path).where(F.col("bucket").isin(touched))
        named = new.select("trace_id", "bucket", *[F.col(c).alias(f"_{c}") for c in updates.columns if c != "trace_id"])
        x = old.join(named, ["trace_id", "bucket"], "full")
        merged = [F.coalesce(f"_{c}", c).alias(c) if c in updates.columns else F.col(c) for c in _COLUMNS[1:]]
        self._put(written(x.select("trace_id", *merged, "bucket"), "qa-merged"), "dynamic")


def apply_tests(store: QaStore, tests: DataFrame, image: str | None = None) -> None:
    """Q2/Q5/Q8: the test sections of finalizing traces; a trace without a run fails with schema_valid = false."""
    x = store.records().where("status = 'finalizing'").select("trace_id").join(tests, "trace_id", "left")
    ran = F.col("n_invocations").isNotNull()
    section = F.struct("runner", F.lit(image).cast("string").alias("container_image"), "n_invocations", "final_passed")
    store.upsert(x.select("trace_id", F.when(ran, section).cast(TESTS).alias("tests"), F.when(ran, F.lit(True)).otherwise(F.lit(False)).alias("schema_valid"),
                          F.when(~ran, F.lit("failed")).alias("status"), F.when(~ran, F.lit("no test invocations")).alias("error")))


def apply_judge(store: QaStore, judged: DataFrame) -> None:
    """Q3/Q4/Q5: the judge sections of finalizing traces, then the gate: complete, or failed with the stored schema_valid.
    ``judged``: (trace_id, outcome, judge), the section null where the outcome is not ok."""
    x = store.records().where("status = 'finalizing'").select("trace_id").join(judged, "trace_id", "left")
    ok = F.coalesce(F.col("outcome") == "ok", F.lit(False))
    error = F.when(ok, F.lit(None)).when(F.col("outcome").isNull(), F.lit("no judge response")).otherwise(F.concat(F.lit("judge "), F.col("outcome")))
    store.upsert(x.select("trace_id", F.when(ok, F.col("judge")).cast(JUDGE).alias("judge"), F.when(ok, F.lit("complete")).otherwise(F.lit("failed")).alias("status"), error.cast("string").alias("error")))
