"""Joins of rows with figures of their group where one group may hold a large share of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_KEYS = 1024
SALTS = 1 << 16


def attach(rows: DataFrame, per_key: DataFrame, key: str, spread: Column) -> DataFrame:
    """``rows`` left-joined with ``per_key`` (one row per non-null ``key``, with ``n``, how many rows have it, and the columns
    to attach). Keys of over a ``HOT_KEYS``th of the counted rows are broadcast, fewer than ``HOT_KEYS`` by that definition. The
    others meet their rows by key; rows of hot keys are dealt out there by ``spread`` (a hash of the row) and match nothing.
    ``per_key`` is read several times: pass a written table, whose size the planner then knows."""
    new = [c for c in per_key.columns if c not in (key, "n")]
    total = per_key.agg(F.sum("n").alias("n")).first().n or 0
    hot = F.col("n") * HOT_KEYS > F.lit(total)
    first = per_key.where(hot).select(F.col(key).alias("__hot"), *[F.col(c).alias(f"__h_{c}") for c in new])
    rest = per_key.where(~hot).select(F.col(key).alias("__cold"), F.lit(0).alias("__none"), *[F.col(c).alias(f"__c_{c}") for c in new])
    r = rows.join(F.broadcast(first), rows[key] == F.col("__hot"), "left")
    open_ = F.col("__hot").isNull() & F.col(key).isNotNull()
    r = r.withColumn("__open", F.when(open_, F.col(key))).withColumn(
        "__salt", F.when(open_, F.lit(0)).otherwise(1 + F.pmod(spread, F.lit(SALTS)).cast("int")))
    r = r.join(rest, (F.col("__open") == F.col("__cold")) & (F.col("__salt") == F.col("__none")), "left")
    return r.select(*[F.col(f"`{c}`") for c in rows.columns], *[F.coalesce(F.col(f"__h_{c}"), F.col(f"__c_{c}")).alias(c) for c in new])
