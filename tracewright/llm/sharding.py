"""Sharding by a minimax contiguous partition.

Equal texts stay together: a text's hash picks one of ``ATOMS`` atomic groups, and the groups' order is that of
their numbers. Spark sums sizes and counts per group; the driver holds those ``ATOMS`` numbers, whatever the corpus.
The smallest capacity that ``shards`` contiguous shards can keep is found by binary search with a greedy check.
Cuts are then laid, within that capacity, as near to even shares of what is left as the capacity of the
later shards allows (where one group outweighs a share, greedy cuts alone would leave later shards empty).

Rows get their place in the shard from counts per group and a numbering inside slices of a group, so a text that
a third of the rows have does not meet in one task.

A very long text is a size like any other; a shard that
holds it may be larger than the rest.

Defined cases: a null text has size ``OVERHEAD`` and the CRC of no bytes; null ids come first in their group and repeated
rows are rows like any other; columns other than id and text are not read; an empty table gives an empty
result; a shard may be empty if there are fewer groups than shards.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewright.llm.common import saved
from tracewright.llm.ranking import number_within

ATOMS = 1 << 16
OVERHEAD = 16


def _greedy(upto: np.ndarray, capacity: int, shards: int) -> list[int] | None:
    """Ends of shards that are filled as far as the capacity allows; None if the groups do not fit. ``upto``: prefix
    sums with a leading 0."""
    ends, at, n = [], 0, len(upto) - 1
    for _ in range(shards):
        at = int(np.searchsorted(upto, upto[at] + capacity, side="right")) - 1
        ends.append(at)
        if at == n:
            return ends
    return None


def smallest_capacity(sizes: np.ndarray, shards: int) -> int:
    """Least capacity with which ``shards`` contiguous shards hold the groups."""
    upto = np.concatenate(([0], np.cumsum(sizes)))
    total = int(upto[-1])
    lo, hi = max(-(-total // shards), int(sizes.max(initial=0))), total
    while lo < hi:
        mid = (lo + hi) // 2
        lo, hi = (lo, mid) if _greedy(upto, mid, shards) else (mid + 1, hi)
    return lo


def minimax_cuts(sizes: np.ndarray, shards: int) -> np.ndarray:
    """End of each shard (exclusive index of a group): no shard above the smallest capacity, and shares as even as
    that allows."""
    upto = np.concatenate(([0], np.cumsum(sizes)))
    n, capacity = len(sizes), smallest_capacity(sizes, shards)
    # least end of each shard such that the shards after it can hold the rest
    least = np.zeros(shards, dtype=np.int64)
    at = n
    for j in range(shards - 1, -1, -1):
        least[j] = at
        at = int(np.searchsorted(upto, upto[at] - capacity, side="left"))
    ends, at = [], 0
    for j in range(shards):
        share = upto[at] + (upto[-1] - upto[at]) / (shards - j)
        near = int(np.searchsorted(upto, share, side="left"))
        if near > at and share - upto[near - 1] < upto[near] - share:
            near -= 1
        most = int(np.searchsorted(upto, upto[at] + capacity, side="right")) - 1
        at = min(max(near, int(least[j]), at), most)
        ends.append(at)
    return np.array(ends, dtype=np.int64)


def minimax_shards(df: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text", atoms: int = ATOMS) -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard) for each row."""
    text = F.col(f"`{text_col}`").cast("string")
    rows = saved(df.select(
        F.col(f"`{id_col}`").alias("id"), (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.pmod(F.xxhash64(F.coalesce(text, F.lit(""))), F.lit(atoms)).cast("int").alias("atom")), "shard-rows")
    got = rows.groupBy("atom").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).collect()  # at most `atoms` rows
    size, count = np.zeros(atoms, dtype=np.int64), np.zeros(atoms, dtype=np.int64)
    for r in got:
        size[r["atom"]], count[r["atom"]] = r["size"], r["n"]
    ends = minimax_cuts(size, shards)
    shard = np.searchsorted(ends, np.arange(atoms), side="right")
    before = np.cumsum(count) - count
    lead = np.searchsorted(shard, np.arange(shards), side="left")
    base = before - before[np.minimum(lead, atoms - 1)][np.minimum(shard, shards - 1)]
    spark = df.sparkSession
    present = np.flatnonzero(count)
    where = spark.createDataFrame([(int(a), int(shard[a]), int(base[a])) for a in present], "atom int, shard int, base long")
    numbered = number_within(rows, "atom", ["id", "size", "text_crc32"], "nth", int(count.max(initial=1)))
    return numbered.join(where, "atom").select(
        F.col("id").alias(id_col), "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("base") + F.col("nth")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
