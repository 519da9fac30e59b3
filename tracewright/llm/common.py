"""Helpers shared by the training-data operators.

Text is handled as UTF-8 bytes. A word is a maximal run of bytes outside
``[\\x20\\x09-\\x0D]``; these are single-byte characters, so splitting on bytes
equals splitting on characters.

Hashes here only gather candidates or stand for long keys; where a contract
needs exact equality the operators say which width they use.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.session import scratch_path

WORD_BREAK = "[\\x20\\x09-\\x0D]+"
HASH_BYTES = 1 << 18  # bytes of text whose prefix hashes are held at once
LEAST = -(1 << 63)  # order value of a null id: before every other id

U64 = np.uint64
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
BYTE_VALUE = np.random.default_rng(20240229).integers(1, 2**64 - 1, 256, dtype=np.uint64) | U64(1)
_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh folder under the cluster's shared checkpoint folder and read it back:
    computed once, lineage cut, whole after the loss of executors."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm/{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def order_value(col: Column) -> Column:
    """The id as a long that sorts null first."""
    return F.coalesce(col.cast("long"), F.lit(LEAST))


def text_key(text: Column) -> Column:
    """128-bit digest that stands for a whole text. Never null, so that joins on it put no filter below a shuffle
    that several branches of a plan can share."""
    return F.coalesce(F.unhex(F.md5(text.cast("binary"))), F.lit(b""))


def n_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def distinct_texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(k, text, ord, copies): one row per different text, with its digest, its smallest id (as an
    order value) and how many rows have it. Copies meet in the map-side aggregate, so a text that
    fills a third of the table costs one row per map task."""
    t = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return (df.select(order_value(F.col(f"`{id_col}`")).alias("ord"), t.alias("text")).withColumn("k", text_key(F.col("text")))
            .groupBy("k").agg(F.first("text").alias("text"), F.min("ord").alias("ord"), F.count(F.lit(1)).alias("copies")))


def rows_by_key(df: DataFrame, id_col: str, text_col: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """(id, ord, k) of every row, without its text; the columns in ``carry`` follow as __c0, __c1, ..."""
    t = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    more = [F.col(f"`{c}`").alias(f"__c{i}") for i, c in enumerate(carry)]
    return df.select(F.col(f"`{id_col}`").alias("id"), order_value(F.col(f"`{id_col}`")).alias("ord"), text_key(t).alias("k"), *more)


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer: spreads every input bit over the 64 bits."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(27)
    h *= U64(0x94D049BB133111EB)
    h ^= h >> U64(31)
    return h


def _power(name: str, base: int, n: int) -> np.ndarray:
    p = _powers.get(name)
    if p is None or len(p) < n:
        size = max(n, 1 << 16)
        p = np.full(size, base, dtype=np.uint64)
        p[0] = 1
        p = np.cumprod(p, dtype=np.uint64)
        _powers[name] = p
    return p[:n]


def prefix_hash(buf: np.ndarray) -> np.ndarray:
    """P with P[j] - P[i] a polynomial in the bytes i..j-1, times base ** i."""
    p = np.empty(len(buf) + 1, dtype=np.uint64)
    p[0] = 0
    np.cumsum(BYTE_VALUE[buf] * _power("base", _BASE, len(buf)), out=p[1:])
    return p


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of bytes, equal for equal bytes wherever they stand."""
    if not len(start):
        return np.zeros(0, dtype=np.uint64)
    inv = _power("inverse", _BASE_INV, int(start.max()) + 1)
    return mix((prefix[end] - prefix[start]) * inv[start] + (end - start).astype(np.uint64))


def span_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """``span_hash`` of ascending spans of ``buf``, about ``HASH_BYTES`` of it at a time: prefix hashes take eight bytes
    and more for each byte of text. A longer span is hashed in one."""
    out = np.empty(len(start), dtype=np.uint64)
    a = 0
    while a < len(start):
        b = max(a + 1, int(np.searchsorted(end, start[a] + HASH_BYTES, side="right")))
        out[a:b] = span_hash(prefix_hash(buf[start[a]:end[b - 1]]), start[a:b] - start[a], end[a:b] - start[a])
        a = b
    return out


def word_spans(buf: np.ndarray, doc_start: np.ndarray, doc_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words; the documents lie in ``buf`` one after another, words never cross them."""
    if not len(buf):
        z = np.zeros(0, dtype=np.int64)
        return z, z
    inside = ~_SPACE[buf]
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    full = doc_end > doc_start
    before[doc_start[full]] = False
    start = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    after[doc_end[full] - 1] = False
    end = np.flatnonzero(inside & ~after) + 1
    return start, end


def grams(h: np.ndarray, n: int, salt: int = 0) -> np.ndarray:
    """Hash of every ``n`` consecutive entries of ``h`` (length len(h) - n + 1)."""
    if len(h) < n:
        return np.zeros(0, dtype=np.uint64)
    m = len(h) - n + 1
    factor = (0xD6E8FEB86659FD93 + 2 * salt) & (2**64 - 1)
    out, have, power, step = None, 0, h, 1
    f = factor
    rest = n
    while rest:  # binary decomposition of n: blocks of 1, 2, 4, ... entries
        if rest & 1:
            part = power[have:have + m]
            out = part.copy() if out is None else mix(out * U64(f | 1) + part)
            have += step
        rest >>= 1
        if rest:
            power = mix(power[:-step] * U64((f * 0x2545F4914F6CDD1D + 1) & (2**64 - 1) | 1) + power[step:])
            step *= 2
            f = (f * f + 0x632BE59BD9B4E019) & (2**64 - 1)
    return out


def text_chunks(batches: Iterator[pa.RecordBatch], columns: list[str], most: int) -> Iterator[tuple]:
    """Arrow batches regrouped to chunks of about ``most`` bytes of text: (list of one array per
    column, joined bytes, document starts, ends). A single longer text makes a chunk of its own."""
    held: list[pa.RecordBatch] = []
    size = 0

    def out():
        t = pa.Table.from_batches(held).combine_chunks()
        cols = [t.column(c).combine_chunks() if t.column(c).num_chunks != 1 else t.column(c).chunk(0) for c in columns]
        text = t.column("text").combine_chunks() if t.column("text").num_chunks != 1 else t.column("text").chunk(0)
        return cols, *joined(text)

    for b in batches:
        if not b.num_rows:
            continue
        lengths = np.diff(_offsets(b.column(b.schema.get_field_index("text"))))
        lo = 0
        total = np.cumsum(lengths)
        while lo < b.num_rows:
            base = total[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(total, base + most - size, side="right")))
            held.append(b.slice(lo, hi - lo))
            size += int(total[hi - 1] - base)
            lo = hi
            if size >= most or lo < b.num_rows:
                yield out()
                held, size = [], 0
    if held:
        yield out()


def _offsets(a: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_string(a.type) or pa.types.is_large_binary(a.type) else np.int32
    return np.frombuffer(a.buffers()[1], dtype=kind)[a.offset:a.offset + len(a) + 1].astype(np.int64)


def joined(a: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of a string or binary column without nulls, with each value's start and end in them."""
    off = _offsets(a)
    data = a.buffers()[2]
    buf = np.frombuffer(data, dtype=np.uint8)[off[0]:off[-1]] if data is not None and len(off) else np.zeros(0, np.uint8)
    off = off - off[0]
    return buf, off[:-1], off[1:]


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], mask.astype(np.int8), [0]))))
    return edge[::2], edge[1::2]


def range_buckets(df: DataFrame, order_col: str, n: int) -> tuple[DataFrame, int]:
    """Add ``bucket``: the index of the row's range among at most ``n`` ranges of ``order_col`` (a long) that
    hold about equally many rows. The bounds are literals, so the bucket is a function of the row:
    recomputed tasks agree. At most ``n`` numbers reach the driver."""
    if n > 1:
        got = df.agg(F.percentile_approx(order_col, [i / n for i in range(1, n)], max(10_000, 20 * n)).alias("q")).first()[0]
        bounds = np.unique(np.array(got or [], dtype=np.int64))
    else:
        bounds = np.zeros(0, dtype=np.int64)

    @F.pandas_udf("int")
    def bucket(s):
        import pandas as pd
        return pd.Series(np.searchsorted(bounds, s.to_numpy(), side="left").astype(np.int32))

    return df.withColumn("bucket", bucket(F.col(order_col))), len(bounds) + 1
