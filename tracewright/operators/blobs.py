"""Content-addressed blob store as tables.

Blob metadata and content live in one Parquet table partitioned by ``shard``
(two hex characters, 256 values) instead of one file per blob. Dedup is
first-writer-wins expressed as a ``min`` over an ordered struct: a partial
aggregate, so a hot content hash (many copies of one text) is combined
map-side and never gathered into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.functions.hashing import byte_length, content_address, shard_of, storage_uri
from tracewright.schemas import DEFAULT_CONTENT_TYPE

DEFAULT_ROOT = "/data/blobs"
SHARDS = 256


def content_type_or_default(ct: Column) -> Column:
    """A missing or empty content type defaults (Python ``or`` semantics)."""
    return F.coalesce(F.nullif(ct, F.lit("")), F.lit(DEFAULT_CONTENT_TYPE))


def blob_rows(uploads: DataFrame, content: str = "content", content_type: str = "content_type",
              root: str = DEFAULT_ROOT) -> DataFrame:
    """Uploads -> blob rows (id, type, length, uri, shard), content kept."""
    bid = content_address(F.col(content))
    return (uploads.withColumn("blob_id", bid)
            .withColumn("content_type", content_type_or_default(F.col(content_type)))
            .withColumn("byte_length", byte_length(F.col(content)))
            .withColumn("storage_uri", storage_uri(F.col("blob_id"), root))
            .withColumn("shard", shard_of(F.col("blob_id"))))


def dedup_first_writer(blobs: DataFrame, order: list[str], keep: list[str]) -> DataFrame:
    """One row per blob_id, fields of the first writer by ``order``.

    ``order`` must be a total order within a blob id (add a unique key).
    """
    first = F.min(F.struct(*[F.col(c) for c in order], *[F.col(c).alias(f"_k_{c}") for c in keep]))
    agg = blobs.groupBy("blob_id").agg(first.alias("_w"), F.count(F.lit(1)).alias("n_writes"))
    return agg.select("blob_id", *[F.col(f"_w._k_{c}").alias(c) for c in keep], "n_writes")


def first_writer_rows(blobs: DataFrame, order: list[str]) -> DataFrame:
    """The first writer's whole row per blob_id, by ``order`` (a total order).

    Only the order columns are aggregated; content is fetched by a join on
    the winning key, so no text stands in an aggregation buffer."""
    first = blobs.groupBy("blob_id").agg(F.min(F.struct(*[F.col(c) for c in order])).alias("_w"))
    won = first.select(F.col("blob_id").alias("_b"), *[F.col(f"_w.{c}").alias(f"_w_{c}") for c in order])
    same = F.col("blob_id") == F.col("_b")
    for c in order:
        same = same & F.col(c).eqNullSafe(F.col(f"_w_{c}"))
    return blobs.join(won, same, "left_semi")


def new_only(incoming: DataFrame, stored: DataFrame) -> DataFrame:
    """Uploads whose content is not stored yet (left anti join on the id)."""
    return incoming.join(stored.select("blob_id"), "blob_id", "left_anti")


def exists(refs: DataFrame, stored: DataFrame, ref_col: str = "blob_id") -> DataFrame:
    """flag each reference with whether its blob is stored.

    The stored side is reduced to distinct ids first; the join is a left join
    so dangling references survive (``exists = false``).
    """
    ids = stored.select(F.col("blob_id").alias("_bid")).distinct().withColumn("_hit", F.lit(True))
    return (refs.join(ids, F.col(ref_col) == F.col("_bid"), "left")
            .withColumn("exists", F.coalesce(F.col("_hit"), F.lit(False))).drop("_bid", "_hit"))


def write_store(blobs: DataFrame, path: str, mode: str = "append") -> None:
    """Sharded sink, ``partitionBy(shard)``; readers prune by shard. A shard
    is written by one task up to 256 shuffle partitions, beyond that by as
    many as there are partitions per shard."""
    splits = max(1, int(blobs.sparkSession.conf.get("spark.sql.shuffle.partitions")) // SHARDS)
    part = F.pmod(F.xxhash64("blob_id"), F.lit(splits))
    (blobs.repartition(F.col("shard"), part).write.mode(mode).partitionBy("shard").parquet(path))


def read_content(spark, path: str, ids: DataFrame) -> DataFrame:
    """Content for a set of ids. The shard column is derived from the id so
    the scan prunes partitions (dynamic partition pruning on ``shard``)."""
    store = spark.read.parquet(path)
    want = ids.select("blob_id").distinct().withColumn("shard", shard_of(F.col("blob_id")))
    return store.join(want, ["shard", "blob_id"], "left_semi")
