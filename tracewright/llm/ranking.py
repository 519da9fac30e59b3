"""Gapless numbers within keys, without gathering a key in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SLICE_ROWS = 1024


def number_within(df: DataFrame, key: str, order: list[str], out: str, most: int) -> DataFrame:
    """Add ``out``: 0, 1, 2, ... within each ``key``. ``most`` is the number of rows of the most frequent key: keys are
    cut into slices of about ``SLICE_ROWS`` by a hash of the ``order`` columns, slices are counted, and rows are
    numbered inside their slice. Rows equal in key and order columns may swap numbers, others never."""
    slices = max(1, -(-most // SLICE_ROWS))
    cut = df.withColumn("__slice", F.pmod(F.xxhash64(*order), F.lit(slices)).cast("int"))
    counts = cut.groupBy(key, "__slice").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(key).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select(key, "__slice", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"))
    inside = Window.partitionBy(key, "__slice").orderBy(*order)
    numbered = cut.withColumn("__nth", F.row_number().over(inside) - 1)
    return (numbered.join(base, [key, "__slice"]).withColumn(out, (F.col("__base") + F.col("__nth")).cast("long"))
            .drop("__slice", "__base", "__nth"))
