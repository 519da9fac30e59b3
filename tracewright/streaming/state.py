"""State of the incremental ingestion: what an epoch must know of all epochs before it.

Three tables of parts, a part per epoch, written under ``<path>/<kind>/epoch=N`` and complete once committed:

highs    (trace_id, high0): the mark of each trace that the epoch raised
filters  (bucket, bits): a Bloom filter of the event ids that the epoch stored, for each of ``buckets`` hash buckets
ids      (bucket, trace_id, event_id): those ids, sorted by bucket, so a read of some buckets skips the other row groups

Ids are dealt by the hash of (trace_id, event_id), so a trace that holds a third of all events fills all buckets alike.
An epoch probes the filters with its own ids and looks up in ``ids`` only what the filters let through, in the buckets
concerned: the marks and filters it reads follow the number of traces and buckets, not the events stored.

Every ``COMPACT`` epochs the marks are merged to one row per trace and the filters to as few rows per bucket as keep each
at most half full, into a part ``base=N``; an epoch reads the last base before it and the parts since. The id lists are
merged in tiers: ``COMPACT`` parts that end with epoch N become one ``run<tier>=N``, sorted by bucket again, and so do
``COMPACT`` of those; an id is rewritten once a tier, and after E epochs fewer than ``COMPACT`` parts of each of log E tiers
are read. A retried epoch writes its own parts and merges again and never reads them.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.operators.common import written

BUCKETS = 256
BITS = 1 << 16   # of a filter: 8 KB a bucket
PROBES = 8       # bits of an id
COMPACT = 8
_HIGHS = "trace_id string, high0 int"
_FILTERS = "bucket int, bits binary"
_IDS = "bucket int, trace_id string, event_id string"


def _hashes() -> tuple[Column, Column]:
    return F.xxhash64("trace_id", "event_id"), F.xxhash64("event_id", "trace_id")


def _positions(t: pa.Table, size: int) -> np.ndarray:
    """(rows, PROBES) places of each row's id in a filter of ``size`` bits, a power of two."""
    a, b = (t.column(c).to_numpy().astype(np.int64).view(np.uint64) for c in ("a", "b"))
    step = np.arange(PROBES, dtype=np.uint64)[None, :]
    return ((a >> np.uint64(20))[:, None] + step * (b | np.uint64(1))[:, None]) & np.uint64(size - 1)


def _filter_of(t: pa.Table, size: int) -> pa.Table:
    bits = np.zeros(size, dtype=np.uint8)
    bits[_positions(t, size).ravel()] = 1
    return pa.table({"bucket": t.column("bucket").slice(0, 1), "bits": pa.array([np.packbits(bits).tobytes()], pa.binary())})


def _let_through(ids: pa.Table, filters: pa.Table) -> pa.Table:
    """The ids that one of the bucket's filters may hold."""
    names = ["bucket", "trace_id", "event_id"]
    if not ids.num_rows or not filters.num_rows:
        return ids.select(names).slice(0, 0)
    hit = np.zeros(ids.num_rows, dtype=bool)
    for x in filters.column("bits").to_pylist():
        at = _positions(ids, 8 * len(x)).astype(np.int64)
        hit |= np.unpackbits(np.frombuffer(x, dtype=np.uint8))[at].all(axis=1)
    return ids.select(names).filter(pa.array(hit))


def _merged(t: pa.Table) -> pa.Table:
    """A bucket's filters joined as long as each stays at most half full."""
    out: list[np.ndarray] = []
    for x in t.column("bits").to_pylist():
        bits = np.unpackbits(np.frombuffer(x, dtype=np.uint8))
        joined = out[-1] | bits if out else bits
        if out and joined.sum() * 2 <= len(joined):
            out[-1] = joined
        else:
            out.append(bits)
    return pa.table({"bucket": pa.array([t.column("bucket")[0].as_py()] * len(out), pa.int32()), "bits": pa.array([np.packbits(b).tobytes() for b in out], pa.binary())})


class StateIndex:
    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS, bits: int = BITS) -> None:
        self.spark, self.path, self.buckets, self.bits = spark, path, buckets, bits

    def _parts(self, kind: str, before: int) -> list[str]:
        """Committed parts that hold what ``kind`` was before the epoch: the last base and the epochs since."""
        jvm = self.spark.sparkContext._jvm
        root = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{kind}")
        fs = root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(root):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(root)]
        found = {(kind_, int(n)) for kind_, _, n in (x.partition("=") for x in names) if kind_ in ("epoch", "base") and n.isdigit()}
        done = {x for x in found if x[1] < before and fs.exists(jvm.org.apache.hadoop.fs.Path(f"{self.path}/{kind}/{x[0]}={x[1]}/_SUCCESS"))}
        base = max((n for k, n in done if k == "base"), default=-1)
        keep = [("base", base)] * (base >= 0) + sorted(x for x in done if x[0] == "epoch" and x[1] > base)
        return [f"{self.path}/{kind}/{k}={n}" for k, n in keep]

    def _read(self, kind: str, schema: str, before: int) -> DataFrame | None:
        parts = self._parts(kind, before)
        return self.spark.read.schema(schema).parquet(*parts) if parts else None

    def highs(self, before: int) -> DataFrame | None:
        """(trace_id, high0) of all traces with stored events before the epoch; None if there are none."""
        got = self._read("highs", _HIGHS, before)
        return None if got is None else got.groupBy("trace_id").agg(F.max("high0").alias("high0"))

    def keyed(self, ids: DataFrame) -> DataFrame:
        a, b = _hashes()
        return ids.select(F.pmod(a, F.lit(self.buckets)).cast("int").alias("bucket"), "trace_id", "event_id", a.alias("a"), b.alias("b"))

    def stored_ids(self, ids: DataFrame, before: int) -> DataFrame | None:
        """Of ``ids`` (trace_id, event_id) those stored before the epoch; None if there are none. The bucket numbers of ids that
        pass the filters reach the driver, at most as many as there are buckets."""
        filters = self._read("filters", _FILTERS, before)
        if filters is None:
            return None
        passed = written(self.keyed(ids).distinct().groupBy("bucket").cogroup(filters.groupBy("bucket")).applyInArrow(_let_through, _IDS), "state-passed")
        buckets = [r["bucket"] for r in passed.select("bucket").distinct().collect()]
        if not buckets:
            return None
        held = self.spark.read.schema(_IDS).parquet(*self._id_parts(0, before)).where(F.col("bucket").isin(buckets))
        return passed.join(held, ["bucket", "trace_id", "event_id"], "left_semi").select("trace_id", "event_id")

    def _committed(self, part: str) -> bool:
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{part}/_SUCCESS")
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(p)

    def _id_parts(self, first: int, before: int, top: int = 64) -> list[str]:
        """The fewest committed parts, of tiers up to ``top``, that hold the id lists of epochs ``first`` to ``before`` - 1.
        A merged part is used only if it ends before ``before``; an epoch without a committed part stored nothing."""
        parts, at = [], first
        while at < before:
            tier = 0
            while tier < top and at % COMPACT ** (tier + 1) == 0 and at + COMPACT ** (tier + 1) <= before:
                tier += 1
            while tier and not self._committed(f"ids/run{tier}={at + COMPACT ** tier - 1}"):
                tier -= 1
            last = at + COMPACT ** tier - 1
            part = f"ids/run{tier}={last}" if tier else f"ids/epoch={at}"
            if tier or self._committed(part):
                parts.append(f"{self.path}/{part}")
            at = last + 1
        return parts

    def _list(self, ids: DataFrame, path: str) -> None:
        ids.repartition("bucket").sortWithinPartitions("bucket").select("bucket", "trace_id", "event_id").write.mode("overwrite").parquet(path)

    def _merge_ids(self, epoch: int) -> None:
        """The merges that ``epoch`` completes, the least tier first, each from parts of the tier below."""
        tier = 1
        while (epoch + 1) % COMPACT ** tier == 0:
            parts = self._id_parts(epoch + 1 - COMPACT ** tier, epoch + 1, tier - 1)
            if parts:
                self._list(self.spark.read.schema(_IDS).parquet(*parts), f"{self.path}/ids/run{tier}={epoch}")
            tier += 1

    def add_highs(self, highs: DataFrame, epoch: int) -> None:
        """``highs``: (trace_id, high0) that the epoch's accepted batches leave."""
        highs.write.mode("overwrite").parquet(f"{self.path}/highs/epoch={epoch}")
        if (epoch + 1) % COMPACT == 0:
            self.highs(epoch + 1).write.mode("overwrite").parquet(f"{self.path}/highs/base={epoch}")

    def add_ids(self, ids: DataFrame, epoch: int) -> None:
        """``ids``: (trace_id, event_id) that the epoch stored."""
        size, keyed = self.bits, self.keyed(ids)

        def lists() -> None:
            self._list(keyed, f"{self.path}/ids/epoch={epoch}")
            self._merge_ids(epoch)

        def filters() -> None:
            made = keyed.select("bucket", "a", "b").groupBy("bucket").applyInArrow(lambda t: _filter_of(t, size), _FILTERS)
            made.write.mode("overwrite").parquet(f"{self.path}/filters/epoch={epoch}")
            if (epoch + 1) % COMPACT == 0:
                merged = self._read("filters", _FILTERS, epoch + 1).groupBy("bucket").applyInArrow(_merged, _FILTERS)
                merged.write.mode("overwrite").parquet(f"{self.path}/filters/base={epoch}")

        with ThreadPoolExecutor(2) as pool:
            for f in [pool.submit(w) for w in (lists, filters)]:
                f.result()
