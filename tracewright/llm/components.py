"""Connected components of links between 16-byte keys, by alternating large-star and small-star rounds.

A large star links every greater neighbour of a node to the node's least neighbour (a minimum per node and a
join, so a node with very many links is no single task). A small star links a node and its lesser neighbours to the
least of them (a window over a node's lesser neighbours, few after a large star). Links are written to the shared
checkpoint folder between rounds, so lineage stays short. Rounds end when every node hangs on one root; their
number grows with the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracewright.llm.common import saved


def _are_stars(links: DataFrame) -> bool:
    """Whether every ``a`` hangs on one ``b`` and no ``b`` hangs on anything."""
    seen = links.select(F.col("a").alias("s"), F.lit(1).alias("up"), F.lit(0).alias("root")).unionByName(
        links.select(F.col("b").alias("s"), F.lit(0).alias("up"), F.lit(1).alias("root")))
    return seen.groupBy("s").agg(F.sum("up").alias("up"), F.max("root").alias("root")).where("up > 1 or (up > 0 and root > 0)").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(a, b) links in any direction -> (s, root): each linked node and the least key of its component."""
    one_way = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    now = saved(one_way, "links")
    while not _are_stars(now):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min(F.least("a", "b")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        hung = large.withColumn("m", F.min("b").over(Window.partitionBy("a")))
        small = hung.select("a", F.col("m").alias("b")).unionByName(hung.select(F.col("b").alias("a"), F.col("m").alias("b")))
        now = saved(small.where("a <> b").distinct(), "links")
    roots = now.select(F.col("b").alias("s")).distinct().select("s", F.col("s").alias("root"))
    return now.select(F.col("a").alias("s"), F.col("b").alias("root")).unionByName(roots)
