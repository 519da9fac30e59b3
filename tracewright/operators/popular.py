"""Left joins of references with what they refer to, where a few keys hold a large share of all references.

Popular keys are counted first (map-side, so a hot key is a row per task). Their rows of the other side are broadcast: keys
of over a ``POPULAR``th of the references, fewer than ``POPULAR`` by that definition. All other references meet the other side by a
shuffle on the key; popular ones pass through that join spread over its tasks, under a key of their own that nothing has.
So no task gathers a popular key, with or without adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewright.operators.common import written

POPULAR = 256
SPREAD = 4096


def join_references(refs: DataFrame, targets: DataFrame, key: str, unique: str, popular: int = POPULAR) -> DataFrame:
    """``refs`` left-joined with ``targets`` (one row per ``key``); ``unique`` names a column of ``refs`` that tells rows apart. References
    whose key is null or unknown keep their row, with nulls."""
    values = [c for c in targets.columns if c != key]
    counts = refs.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = refs.count()
    hot = written(targets.join(counts.where(F.col("_n") * popular > F.lit(total)).select(key), key, "left_semi"), "popular")
    near = hot.select(F.col(key).alias("_hot"), *[F.col(c).alias(f"_h_{c}") for c in values])
    x = refs.join(F.broadcast(near), F.col(key) == F.col("_hot"), "left")
    aside = F.concat(F.lit("\u0000"), F.pmod(F.xxhash64(unique), F.lit(SPREAD)).cast("string"))
    x = x.withColumn("_to", F.when(F.col("_hot").isNotNull() | F.col(key).isNull(), aside).otherwise(F.col(key)))
    far = targets.select(F.col(key).alias("_key"), *[F.col(c).alias(f"_f_{c}") for c in values])
    x = x.join(far, F.col("_to") == F.col("_key"), "left")
    return x.select(*refs.columns, *[F.when(F.col("_hot").isNotNull(), F.col(f"_h_{c}")).otherwise(F.col(f"_f_{c}")).alias(c) for c in values])
