"""Point lookups by key on stored tables.

A table is written sorted, in small row groups, with a Parquet Bloom filter on its lookup key. A lookup of listed keys is
pushed to the scan as equalities: row groups whose statistics, dictionary or Bloom filter exclude every key are
skipped. So a key that the sort scatters (event_id in a table sorted by trace and seq) is found as cheaply as the sort key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MOST_KEYS = 1000
ROW_GROUP = 8 << 20


def write_lookup(df: DataFrame, path: str, key: str, sort: Sequence[str], row_group: int = ROW_GROUP, partition: Sequence[str] = (), rows_per_group: int = 100_000) -> None:
    """Write ``df`` ranged and sorted by ``sort`` for lookups by ``key``; ``row_group`` in bytes, ``rows_per_group`` the distinct keys a filter is made for."""
    out = df.repartitionByRange(*partition, *sort).sortWithinPartitions(*partition, *sort)
    w = (out.write.mode("overwrite").option("parquet.block.size", row_group).option(f"parquet.bloom.filter.enabled#{key}", "true")
         .option(f"parquet.bloom.filter.expected.ndv#{key}", rows_per_group))
    (w.partitionBy(*partition) if partition else w).parquet(path)


def lookup(spark: SparkSession, path: str, key: str, keys: Sequence[str]) -> DataFrame:
    """The rows of the listed keys. At most ``MOST_KEYS``: a longer list is a table, to be joined."""
    wanted = sorted(set(keys))
    if len(wanted) > MOST_KEYS:
        raise ValueError(f"{len(wanted)} keys in a lookup of at most {MOST_KEYS}; join them as a table")
    table = spark.read.parquet(path)
    if not wanted:
        return table.where(F.lit(False))

    def any_of(part: Sequence[str]):
        """A balanced tree of equalities: IN of more than ten values would be pushed as a range."""
        half = len(part) // 2
        return F.col(key) == part[0] if len(part) == 1 else any_of(part[:half]) | any_of(part[half:])

    # a disjunction stays one, so every equality reaches the Parquet reader
    return table.where(any_of(wanted))
