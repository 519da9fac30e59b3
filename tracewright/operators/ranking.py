"""Skew-proof positional numbering.

``row_number() OVER (PARTITION BY k ORDER BY o)`` puts every row of one key in
one task. When a single key may hold a third of the table that task is the
whole job. ``position_in_group`` computes the same number without that:

1. the range of the first order column is cut into equal slices; the bounds are
   literals, so a row's slice is a function of the row alone, whatever the
   partitioning, and recomputed tasks agree;
2. rows are counted per (key, slice) by a partial aggregate; a window over these
   counts (at most ``slices + 2`` rows per key) gives the rows in earlier slices;
3. ``row_number`` inside (key, slice), plus the rows in earlier slices.

The order columns must make a total order within a key (add a unique tie
breaker). A key whose rows all share one value of the first order column stays in
one slice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICES = 1024


def position_in_group(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "pos",
                      by: Column | None = None, slices: int = SLICES) -> DataFrame:
    """Add ``out``: 1, 2, ... within each key. ``by`` is a long that never falls
    along the first order column (that column itself unless given)."""
    value = F.col(order[0]).cast("long") if by is None else by
    lo, hi = df.agg(F.min(value), F.max(value)).first()
    width = 1 if lo is None else (hi - lo) // slices + 1
    # nulls sort first, in a slice of their own
    cut = df.withColumn("_slice", F.coalesce(F.floor((value - F.lit(lo or 0)) / F.lit(width)).cast("int"), F.lit(-1)))
    counts = cut.groupBy(*keys, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(*keys, "_slice", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*keys, "_slice").orderBy(*order)
    return (cut.withColumn("_nth", F.row_number().over(inside))
            .join(before, [*keys, "_slice"])
            .withColumn(out, (F.col("_before") + F.col("_nth")).cast("int"))
            .drop("_slice", "_nth", "_before"))
