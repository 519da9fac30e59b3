"""Request bodies as JSON lines, in batch and as a stream.

One request per line: ``traces`` (trace_id, created_at_ms, body), ``submissions`` (trace_id, batch_no, events) and ``responses``
(trace_id, model, response_text). Bodies and events stay JSON text as they were sent; the rules judge them later.

A line that cannot be a request goes to quarantine with its file, its text and a reason, and ends no job: it is no JSON
object, a value has not the type of its column, or a required column is absent or null. Blank lines are skipped. The
stream writes requests and quarantine of an epoch to folders of their own, so a retried epoch rewrites them.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# columns of a kind, the required ones
KINDS = {
    "traces": ("trace_id string, created_at_ms long, body string", ("trace_id", "body")),
    "submissions": ("trace_id string, batch_no int, events array<string>", ("trace_id", "batch_no", "events")),
    "responses": ("trace_id string, model string, response_text string", ("trace_id", "response_text")),
}


def columns(kind: str) -> list[str]:
    return [c.split()[0] for c in KINDS[kind][0].split(", ")]


def lines(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """(file, line) of the text files under ``path``."""
    reader = spark.readStream if stream else spark.read
    return reader.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"))


def parsed(raw: DataFrame, kind: str) -> DataFrame:
    """``raw`` with the columns of the kind and ``reason``, null where the line is a request. No shuffle; batch and stream alike."""
    schema, required = KINDS[kind]
    got = F.from_json("line", f"{schema}, _corrupt string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    x = raw.where(F.trim("line") != "").withColumn("_r", got)
    reason = F.when(~F.col("line").rlike(r"^\s*\{") | F.col("_r").isNull(), F.lit("not an object"))
    reason = reason.when(F.col("_r._corrupt").isNotNull(), F.lit("malformed"))
    for c in required:
        reason = reason.when(F.col(f"_r.{c}").isNull(), F.lit(f"missing {c}"))
    return x.select("file", "line", reason.alias("reason"), *[F.col(f"_r.{c}").alias(c) for c in columns(kind)])


def requests(found: DataFrame, kind: str) -> DataFrame:
    return found.where("reason is null").select(*columns(kind))


def quarantined(found: DataFrame) -> DataFrame:
    return found.where("reason is not null").select("file", "line", "reason")


def submitted_events(submissions: DataFrame) -> DataFrame:
    """One row per event: (trace_id, batch_no, pos, event_json)."""
    return submissions.select("trace_id", "batch_no", F.posexplode("events").alias("pos", "event_json"))


def run_lines(spark: SparkSession, source: str, out: str, kind: str) -> tuple[str, str]:
    """Read what has arrived since the last run; returns the folders of requests and quarantine, an ``epoch=N`` each run."""
    good, bad = os.path.join(out, kind), os.path.join(out, f"{kind}-quarantine")

    def epoch(batch: DataFrame, n: int) -> None:
        found = parsed(batch, kind)
        requests(found, kind).write.mode("overwrite").parquet(f"{good}/epoch={n}")
        quarantined(found).write.mode("overwrite").parquet(f"{bad}/epoch={n}")

    (lines(spark, source, stream=True).writeStream.foreachBatch(epoch).option("checkpointLocation", os.path.join(out, f"{kind}-checkpoint"))
     .trigger(availableNow=True).start().awaitTermination())
    return good, bad
