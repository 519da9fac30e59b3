"""Token ids in fixed-width bit packing: each id takes the least bits that the vocabulary needs.

Layout. Documents are cut into ranges of ascending ids; a range is written by one task in order. A record holds
consecutive whole documents of one range (about ``RECORD_IDS`` ids): range, ``local`` (ids of the range before the
record), ``n_ids``, ``bits``, ``payload``, ``block_offsets``, and per document its id and number of ids. The payload is
a row of blocks of ``BLOCK_IDS`` ids (the last may be shorter); a block starts on a whole byte, so its offset is
known and any ids are unpacked from the few blocks that hold them. Inside a block id i stands at bits
i * bits, least significant first.

Records are rows of Parquet files, file n holding range n: the writer commits whole files on any store that
Spark reaches, and a lost executor's files are written anew. A record's global start is its range's start (a sum of
at most ``MOST_RANGES`` totals) plus ``local``.

A text longer than a record makes a
record of its own.

Defined cases: a null text is empty and gives the end id alone; a null id comes before all others; documents of
equal ids are ordered by their texts; repeated rows are written each; other columns are not read; an empty
table gives no records and an empty result.
"""

from __future__ import annotations

import math
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.llm.common import LEAST, n_partitions, order_value, range_buckets, text_chunks
from tracewright.llm.tokens import ENCODE_BYTES, encode, vocabulary_size
from tracewright.session import scratch_path

BLOCK_IDS = 4096
RECORD_IDS = 1 << 20
RANGE_BYTES = 1 << 24
MOST_RANGES = 8192
RECORD = ("bucket int, local long, n_ids long, bits int, payload binary, block_offsets array<long>, "
          "doc_ords array<long>, doc_lengths array<long>")


def bits_for(vocabulary: int) -> int:
    return max(1, int(vocabulary - 1).bit_length())


def pack_block(ids: np.ndarray, bits: int) -> bytes:
    """Up to ``BLOCK_IDS`` ids to bits, least significant first."""
    planes = ((ids[:, None].astype(np.uint32) >> np.arange(bits, dtype=np.uint32)) & 1).astype(np.uint8)
    return np.packbits(planes.ravel(), bitorder="little").tobytes()


def pack(ids: np.ndarray, bits: int) -> tuple[bytes, list[int]]:
    """(payload, block offsets)."""
    if bits in (8, 16, 32):  # whole bytes: the same layout without going through single bits
        data = ids.astype(f"<u{bits // 8}").tobytes()
        return data, list(range(0, max(1, len(data)), BLOCK_IDS * bits // 8))
    blocks = [pack_block(ids[i:i + BLOCK_IDS], bits) for i in range(0, len(ids), BLOCK_IDS)] or [b""]
    return b"".join(blocks), [0, *np.cumsum([len(b) for b in blocks])[:-1].tolist()]


def unpack(payload: bytes, offsets: list[int], bits: int, lo: int, hi: int) -> np.ndarray:
    """Ids lo..hi-1 of a record, from the blocks that hold them."""
    if hi <= lo:
        return np.zeros(0, dtype=np.uint32)
    raw = np.concatenate((np.frombuffer(payload, dtype=np.uint8), np.zeros(8, dtype=np.uint8)))
    at = np.arange(lo, hi, dtype=np.int64)
    bit = np.asarray(offsets, dtype=np.int64)[at // BLOCK_IDS] * 8 + at % BLOCK_IDS * bits
    byte = bit >> 3
    word = np.zeros(len(at), dtype=np.uint64)
    for j in range((bits + 14) // 8):
        word |= raw[byte + j].astype(np.uint64) << np.uint64(8 * j)
    return ((word >> (bit & 7).astype(np.uint64)) & np.uint64((1 << bits) - 1)).astype(np.uint32)


def _record_batches(path: str, cuts: str | None, end_id: int, bits: int, special: bool):
    """Rows in the order of (bucket, ord, text) to records."""
    schema = pa.schema([("bucket", pa.int32()), ("local", pa.int64()), ("n_ids", pa.int64()), ("bits", pa.int32()), ("payload", pa.binary()),
                        ("block_offsets", pa.list_(pa.int64())), ("doc_ords", pa.list_(pa.int64())), ("doc_lengths", pa.list_(pa.int64()))])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, local = None, 0
        for (buckets, ords), buf, start, end in text_chunks(batches, ["bucket", "ord"], ENCODE_BYTES):
            token, first = encode(buf, start, end, path, cuts, special)
            size = np.diff(first) + 1
            ids = np.full(int(size.sum()), end_id, dtype=np.uint32)
            ids[np.arange(len(token)) + np.repeat(np.arange(len(size)), size - 1)] = token
            b, o = buckets.to_numpy(), ords.to_numpy()
            upto = np.concatenate(([0], np.cumsum(size)))
            i = 0
            while i < len(b):
                if b[i] != now:
                    now, local = b[i], 0
                j = int(np.searchsorted(b, now, side="right"))
                j = min(j, max(i + 1, int(np.searchsorted(upto, upto[i] + RECORD_IDS, side="right")) - 1))
                payload, offsets = pack(ids[upto[i]:upto[j]], bits)
                n = int(upto[j] - upto[i])
                yield pa.RecordBatch.from_pylist([{"bucket": int(now), "local": local, "n_ids": n, "bits": bits, "payload": payload, "block_offsets": offsets,
                                                   "doc_ords": o[i:j].tolist(), "doc_lengths": size[i:j].tolist()}], schema=schema)
                local += n
                i = j
    return emit


def write_tokens(df: DataFrame, out_path: str, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 cuts: str | None = "word", end_id: int = 1, special: bool = False) -> str:
    """Encode, append the end id to each document, and write in ascending order of ids. ``special`` is as in tokens.py.
    Returns ``out_path``."""
    spark = df.sparkSession
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = df.select(order_value(F.col(f"`{id_col}`")).alias("ord"), text.alias("text"))
    total = rows.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    ranged, n = range_buckets(rows, "ord", min(MOST_RANGES, max(n_partitions(spark), math.ceil(total / RANGE_BYTES))))
    bits = bits_for(max(vocabulary_size(tokenizer_path), end_id + 1))
    (ranged.repartitionById(n, F.col("bucket")).sortWithinPartitions("bucket", "ord", "text")
     .select("bucket", "ord", "text").mapInArrow(_record_batches(tokenizer_path, cuts, end_id, bits, special), RECORD)
     .write.parquet(out_path))
    return out_path


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Records with ``first``, the ids of all documents before the record."""
    records = spark.read.schema(RECORD).parquet(path)
    totals = dict(records.groupBy("bucket").agg(F.sum("n_ids").alias("n")).collect())  # at most MOST_RANGES rows
    base, starts = 0, []
    for bucket in sorted(totals):
        starts.append((bucket, base))
        base += totals[bucket]
    at = spark.createDataFrame(starts, "bucket int, base long")
    return records.join(F.broadcast(at), "bucket").withColumn("first", F.col("base") + F.col("local")).drop("base")


def read_ids(spark: SparkSession, path: str, start: int, length: int) -> np.ndarray:
    """Random access: ids start..start+length-1 of the corpus, from the records and blocks that hold them. They come
    to the driver, so ask for what it can hold."""
    rec = read_tokens(spark, path).where((F.col("first") < start + length) & (F.col("first") + F.col("n_ids") > start)).orderBy("first")
    got = [unpack(r.payload, r.block_offsets, r.bits, max(0, start - r["first"]), min(r.n_ids, start + length - r["first"])) for r in rec.collect()]
    return np.concatenate(got) if got else np.zeros(0, dtype=np.uint32)


def _document_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for r in b.to_pylist():
            ids = unpack(r["payload"], r["block_offsets"], r["bits"], 0, r["n_ids"]).astype("<u4")
            at = np.concatenate(([0], np.cumsum(r["doc_lengths"]))).astype(np.int64)
            raw = ids.tobytes()
            yield pa.RecordBatch.from_arrays([
                pa.array(r["doc_ords"], pa.int64()), pa.array(at[:-1] + r["first"]), pa.array(r["doc_lengths"], pa.int64()),
                pa.array([zlib.crc32(raw[4 * x:4 * y]) for x, y in zip(at[:-1].tolist(), at[1:].tolist())], pa.int64())],
                ["ord", "start", "n_tokens", "ids_crc32"])


def read_documents(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of every document, from the files."""
    got = read_tokens(spark, path).mapInArrow(_document_batches, "ord long, start long, n_tokens long, ids_crc32 long")
    return got.select(F.when(F.col("ord") != LEAST, F.col("ord")).alias(id_col), "start", "n_tokens", "ids_crc32")


def token_round_trip(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                     cuts: str | None = "word", end_id: int = 1, special: bool = False) -> DataFrame:
    """Write to a fresh folder under the shared checkpoint folder and read the files back."""
    spark = df.sparkSession
    out = scratch_path(spark, f"llm/tokens-{uuid.uuid4().hex}")
    return read_documents(spark, write_tokens(df, out, tokenizer_path, id_col, text_col, cuts, end_id, special), id_col)
