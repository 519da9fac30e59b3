"""Substring dedup by fixed-block anchors: remove every word covered by a window of ``WINDOW`` words whose sequence
also starts earlier (smaller id, or the same document and an earlier start).

1. Every text indexes its non-overlapping blocks of ``BLOCK`` words and probes with each rolling window of ``BLOCK``
   words. A window of 20 words holds a whole block of 10 wherever it starts, so of two equal windows the one's
   block is hit by the other's probe at the same offset. Blocks and probes meet in hash buckets as short
   codes (one byte of position, a few of hash); a chunk of texts sends one row per bucket. Hits are sequences
   that are a block somewhere and stand in at least two places; the width of the codes follows the
   corpus so that about one probe in 256 hits by chance, which only costs work.
2. Hits are extended: all windows of 20 words around a hit are compared in full, by 128-bit hashes. Within a
   chunk the first one stays, later ones are repeats at once; first ones meet in buckets, where the earliest
   of the corpus stays. A sequence that a third of the documents hold costs one entry per chunk.
   Consecutive repeated windows join to maximal exact repeats, which are removed.
3. Words are removed once per different text; further documents with the same text are repeats as a whole.

Results are exact but for collisions of 128-bit hashes.

Defined cases: a null text has no words; texts under 20 words lose nothing; a text longer than a chunk makes a chunk of its
own, so the longest text bounds a task's memory; null ids come before all others; texts of
equal ids are ordered by their digests; rows that repeat id and text are one document; other columns are not
read; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewright.llm.common import (
    U64, distinct_texts, grams, n_partitions, rows_by_key, runs, span_hashes, text_chunks, word_spans,
)

WINDOW = 20
BLOCK = 10
GRANULE = 8              # positions of hits are kept to this many words
CHUNK = 1 << 22          # bytes of text in a chunk
BUCKET_BYTES = 1 << 22   # bytes of text per bucket, about
ROUND = 1 << 25          # bytes of starts that a task gathers before it emits them


def _words(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, and the index of each text's first word (one more at the end)."""
    ws, we = word_spans(buf, start, end)
    h = span_hashes(buf, ws, we)
    return h, np.append(np.searchsorted(ws, start, side="left"), len(ws))


def _inside(first: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of the ``n`` words start a window of ``width`` words within their text."""
    size = np.diff(first)
    left = np.repeat(first[1:], size) - np.arange(n)
    return left >= width


_HITS = pa.schema([("bucket", pa.int32()), ("chunk", pa.binary()), ("codes", pa.binary()), ("gaps", pa.binary()),
                   ("keys", pa.binary()), ("firsts", pa.binary())])
HITS = "bucket int, chunk binary, codes binary, gaps binary, keys binary, firsts binary"


def _by_bucket(bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order that gathers the buckets and keeps positions ascending; first index and size of each bucket there."""
    bits = max(1, int(len(bucket)).bit_length())
    key = (bucket.astype(np.uint64) << U64(bits)) | np.arange(len(bucket), dtype=np.uint64)
    key.sort()
    order = (key & U64((1 << bits) - 1)).astype(np.int64)
    got = bucket[order]
    first = np.flatnonzero(np.concatenate(([True], got[1:] != got[:-1]))) if len(got) else np.zeros(0, dtype=np.int64)
    return order, first, np.diff(np.append(first, len(got)))


def _codes_to_bytes(codes: np.ndarray, width: int) -> bytes:
    return np.ascontiguousarray(codes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def _bytes_to_codes(data: bytes, width: int) -> np.ndarray:
    raw = np.frombuffer(data, dtype=np.uint8).reshape(-1, width)
    out = np.zeros((len(raw), 8), dtype=np.uint8)
    out[:, :width] = raw
    return out.view("<u8").ravel()


def _probe_batches(n_buckets: int, width: int):
    """Each chunk's probes by bucket, blocks marked, and one row that names its texts."""
    filler = U64((1 << (8 * width)) - 1)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (keys,), buf, start, end in text_chunks(batches, ["k"], CHUNK):
            h, first = _words(buf, start, end)
            named = b"".join(keys.to_pylist())
            chunk = hashlib.blake2b(named, digest_size=16).digest()
            g = grams(h, BLOCK)
            at = np.flatnonzero(_inside(first, BLOCK, len(h)))
            g = g[at]
            size = np.diff(first)
            aligned = ((at - np.repeat(first[:-1], size)[at]) % BLOCK == 0).astype(np.uint64)
            bucket = (g % U64(n_buckets)).astype(np.int64)
            code = ((g // U64(n_buckets)) << U64(1) | aligned) & filler
            code = np.where(code >= filler - U64(1), code - U64(2), code)  # the filler's own code stays free
            order, lead, count = _by_bucket(bucket)
            code, granule = code[order], at[order] // GRANULE
            rows = []
            for a, c in zip(lead.tolist(), count.tolist()):
                gap = np.diff(granule[a:a + c], prepend=0)
                fill = gap // 255
                if fill.any():
                    n = fill + 1
                    codes = np.full(int(n.sum()), filler)
                    gaps = np.full(len(codes), 255)
                    last = np.cumsum(n) - 1
                    codes[last], gaps[last] = code[a:a + c], gap % 255
                else:
                    codes, gaps = code[a:a + c], gap
                rows.append((int(bucket[order[a]]), _codes_to_bytes(codes, width), gaps.astype(np.uint8).tobytes()))
            n = len(rows)
            yield pa.RecordBatch.from_arrays([
                pa.array([r[0] for r in rows] + [int.from_bytes(chunk[:4], "little") % n_buckets], pa.int32()), pa.array([chunk] * (n + 1), pa.binary()),
                pa.array([r[1] for r in rows] + [None], pa.binary()), pa.array([r[2] for r in rows] + [None], pa.binary()),
                pa.array([None] * n + [named], pa.binary()), pa.array([None] * n + [first.astype("<u4").tobytes()], pa.binary())], schema=_HITS)
    return emit


def live_granules(codes: list[bytes], gaps: list[bytes], width: int) -> list[np.ndarray]:
    """One bucket: for each chunk's row the granules of its hits."""
    sizes = [len(x) for x in gaps]
    code = np.concatenate([_bytes_to_codes(x, width) for x in codes])
    row = np.repeat(np.arange(len(sizes)), sizes)
    granule = np.concatenate([np.cumsum(np.frombuffer(x, dtype=np.uint8), dtype=np.int64) for x in gaps])
    real = np.flatnonzero(code != U64((1 << (8 * width)) - 1))
    value, block = code[real] >> U64(1), (code[real] & U64(1)).astype(np.uint8)
    bits = max(1, int(len(real)).bit_length())
    if 8 * width - 1 + bits <= 64:
        key = (value << U64(bits)) | np.arange(len(real), dtype=np.uint64)
        key.sort()
        order = (key & U64((1 << bits) - 1)).astype(np.int64)
    else:
        order = np.argsort(value, kind="stable")
    value, block = value[order], block[order]
    first = np.flatnonzero(np.concatenate(([True], value[1:] != value[:-1]))) if len(value) else np.zeros(0, dtype=np.int64)
    count = np.diff(np.append(first, len(value)))
    hit = np.repeat((count > 1) & (np.maximum.reduceat(block, first) > 0), count) if len(first) else np.zeros(0, dtype=bool)
    live = np.sort(real[order[hit]])
    edge = np.searchsorted(row[live], np.arange(len(sizes) + 1))
    return [np.unique(granule[live[a:b]]) for a, b in zip(edge[:-1], edge[1:])]


def _hit_batches(width: int):
    """Rows in the order of bucket to (chunk, granules); rows that name a chunk's texts pass."""
    def match(held: list[tuple]) -> pa.RecordBatch:
        got = live_granules([x[1] for x in held], [x[2] for x in held], width)
        rows = [(x[0], g.astype("<u4").tobytes()) for x, g in zip(held, got) if len(g)]
        n = len(rows)
        return pa.RecordBatch.from_arrays([pa.nulls(n, pa.int32()), pa.array([r[0] for r in rows], pa.binary()), pa.nulls(n, pa.binary()),
                                           pa.array([r[1] for r in rows], pa.binary()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary())], schema=_HITS)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for b in batches:
            codes = b.column(b.schema.get_field_index("codes"))
            naming = b.filter(codes.is_null())
            if naming.num_rows:
                yield naming
            cols = [b.column(b.schema.get_field_index(c)).to_pylist() for c in ("bucket", "chunk", "codes", "gaps")]
            for bucket, chunk, code, gap in zip(*cols):
                if code is None:
                    continue
                if bucket != now:
                    if held:
                        yield match(held)
                    now, held = bucket, []
                held.append((chunk, code, gap))
        if held:
            yield match(held)
    return emit


def _region_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in the order of chunk: a chunk's granules laid back on its texts, as word positions where granules begin."""
    def lay(keys: bytes, firsts: bytes, granules: list[bytes]) -> pa.RecordBatch:
        g = np.unique(np.concatenate([np.frombuffer(x, dtype="<u4") for x in granules])).astype(np.int64) * GRANULE
        first = np.frombuffer(firsts, dtype="<u4").astype(np.int64)
        lo = np.searchsorted(g, first[:-1] - GRANULE, side="right")
        hi = np.searchsorted(g, first[1:], side="left")
        some = np.flatnonzero(hi > lo)
        return pa.RecordBatch.from_arrays([
            pa.array([keys[16 * i:16 * i + 16] for i in some.tolist()], pa.binary()),
            pa.array([(g[lo[i]:hi[i]] - first[i]).astype("<i4").tobytes() for i in some.tolist()], pa.binary())], ["k", "near"])

    now, named, granules = None, None, []
    for b in batches:
        cols = [b.column(b.schema.get_field_index(c)).to_pylist() for c in ("chunk", "gaps", "keys", "firsts")]
        for chunk, gaps, keys, firsts in zip(*cols):
            if chunk != now:
                if named and granules:
                    yield lay(*named, granules)
                now, named, granules = chunk, None, []
            if keys is not None:
                named = (keys, firsts)
            else:
                granules.append(gaps)
    if named and granules:
        yield lay(*named, granules)


_SEEN = pa.schema([("bucket", pa.int32()), ("chunk", pa.binary()), ("hashes", pa.binary()), ("places", pa.binary()), ("docs", pa.binary())])
SEEN = "bucket int, chunk binary, hashes binary, places binary, docs binary"
_DOC = np.dtype([("ord", "<i8"), ("k", "V16"), ("first", "<u4")])


def _planes(x: np.ndarray) -> bytes:
    """Ascending positions as byte planes of their differences: the upper planes are mostly zeros and pack well."""
    return np.ascontiguousarray(np.diff(x, prepend=0).astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(data, dtype=np.uint8).reshape(4, -1).T).view("<u4").ravel(), dtype=np.int64)


def _split(values: np.ndarray, which: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Values by the (ascending) index they belong to."""
    edge = np.flatnonzero(np.concatenate(([True], which[1:] != which[:-1]))) if len(which) else []
    for a, b in zip(edge, np.append(edge[1:], len(which)) if len(which) else []):
        yield int(which[a]), values[a:b]


def _later(h1: np.ndarray, h2: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Marks the entries whose hash another entry with a lesser place has."""
    order = np.lexsort((place, h2, h1))
    a, b = h1[order], h2[order]
    out = np.zeros(len(order), dtype=bool)
    out[order[1:][(a[1:] == a[:-1]) & (b[1:] == b[:-1])]] = True
    return out


def _window_batches(n_buckets: int):
    """All windows around a chunk's hits. Repeats within the chunk are final; first ones go to buckets."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (keys, ords, near), buf, start, end in text_chunks(batches, ["k", "ord", "near"], CHUNK):
            h, first = _words(buf, start, end)
            n = len(h)
            step = np.zeros(n + 1, dtype=np.int32)
            for i, x in enumerate(near.to_pylist()):
                at = np.frombuffer(x, dtype="<i4").astype(np.int64) + first[i]
                np.add.at(step, np.clip(at - BLOCK, first[i], first[i + 1]), 1)
                np.add.at(step, np.clip(at + GRANULE, first[i], first[i + 1]), -1)
            at = np.flatnonzero((np.cumsum(step[:-1]) > 0) & _inside(first, WINDOW, n))
            if not len(at):
                continue
            h1, h2 = grams(h, WINDOW)[at], grams(h, WINDOW, 1)[at] >> U64(32)
            k, o = keys.to_pylist(), ords.to_pylist()
            chunk = hashlib.blake2b(b"".join(k), digest_size=16).digest()
            table = np.zeros(len(k), dtype=_DOC)
            table["ord"], table["first"], table["k"] = o, first[:-1], np.frombuffer(b"".join(k), dtype="V16")
            order_of = np.zeros(len(k), dtype=np.int64)
            order_of[sorted(range(len(k)), key=lambda i: (o[i], k[i]))] = np.arange(len(k))
            doc = np.searchsorted(first, at, side="right") - 1
            later = _later(h1, h2, (order_of[doc] << 32) | (at - first[doc]))
            rows = [(int.from_bytes(chunk[:4], "little") % n_buckets, None, _planes(at[later]), table.tobytes())]
            h1, h2, at, doc = h1[~later], h2[~later], at[~later], doc[~later]
            bucket = (h1 % U64(n_buckets)).astype(np.int64)
            order, lead, count = _by_bucket(bucket)
            for a, c in zip(lead.tolist(), count.tolist()):
                i = order[a:a + c]
                rows.append((int(bucket[i[0]]), h1[i].astype("<u8").tobytes() + h2[i].astype("<u4").tobytes(), _planes(at[i]), table[np.unique(doc[i])].tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([chunk] * len(rows), pa.binary()),
                                              *(pa.array([r[j] for r in rows], pa.binary()) for j in (1, 2, 3))], schema=_SEEN)
    return emit


def later_windows(hashes: list[bytes], places: list[bytes], docs: list[bytes]) -> list[np.ndarray]:
    """One bucket: of each chunk's row the places of windows that are not the first of their sequence."""
    h1, h2, doc, at, table, base = [], [], [], [], [], 0
    place = [_from_planes(p) for p in places]
    for x, p, d in zip(hashes, place, docs):
        n = len(x) // 12
        h1.append(np.frombuffer(x, dtype="<u8", count=n))
        h2.append(np.frombuffer(x, dtype="<u4", offset=8 * n))
        t = np.frombuffer(d, dtype=_DOC)
        which = np.searchsorted(t["first"], p, side="right") - 1
        doc.append(which + base)
        at.append(p - t["first"][which])
        table.append(t)
        base += len(t)
    t = np.concatenate(table)
    raw = np.ascontiguousarray(t["k"]).view(">u8").reshape(-1, 2).astype(np.uint64)
    rank = np.empty(len(t), dtype=np.int64)
    rank[np.lexsort((raw[:, 1], raw[:, 0], t["ord"]))] = np.arange(len(t))
    later = _later(np.concatenate(h1), np.concatenate(h2).astype(np.uint64), (rank[np.concatenate(doc)] << 32) | np.concatenate(at))
    edge = np.cumsum([0, *map(len, place)])
    return [p[later[a:b]] for p, a, b in zip(place, edge, edge[1:])]


_SETTLED = pa.schema([("chunk", pa.binary()), ("places", pa.binary()), ("docs", pa.binary())])


def _settle_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in the order of bucket to (chunk, places of later windows); rows that name a chunk's texts pass. A task gathers
    what its buckets find in a chunk before it emits it, in rounds of about ``ROUND`` bytes: texts cost nothing here, a
    chunk costs a row per task and round, and never more than one per repeated window."""
    found: dict[bytes, list[np.ndarray]] = {}
    size = 0

    def out() -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array([_planes(np.sort(np.concatenate(x))) for x in found.values()], pa.binary()),
                                           pa.nulls(len(found), pa.binary())], schema=_SETTLED)
        found.clear()
        return made

    def settle(held: list[tuple]) -> int:
        n = 0
        for (chunk, *_), p in zip(held, later_windows(*(list(x) for x in list(zip(*held))[1:]))):
            if len(p):
                found.setdefault(chunk, []).append(p)
                n += 8 * len(p) + 100
        return n

    now, held = None, []
    for b in batches:
        naming = b.filter(b.column(b.schema.get_field_index("hashes")).is_null())
        if naming.num_rows:
            yield naming.select(["chunk", "places", "docs"])
        cols = [b.column(b.schema.get_field_index(c)).to_pylist() for c in ("bucket", "chunk", "hashes", "places", "docs")]
        for bucket, chunk, hashes, places, docs in zip(*cols):
            if hashes is None:
                continue
            if bucket != now:
                if held:
                    size += settle(held)
                now, held = bucket, []
            held.append((chunk, hashes, places, docs))
        if size >= ROUND:
            yield out()
            size = 0
    if held:
        settle(held)
    if found:
        yield out()


def _start_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in the order of chunk: a chunk's places laid back on its texts, one row per text with repeats."""
    def lay(docs: bytes, places: list[bytes]) -> pa.RecordBatch:
        at = np.sort(np.concatenate([_from_planes(p) for p in places]))
        t = np.frombuffer(docs, dtype=_DOC)
        which = np.searchsorted(t["first"], at, side="right") - 1
        got = [(t["k"][d].tobytes(), x.astype("<u4").tobytes()) for d, x in _split(at - t["first"][which], which)]
        return pa.RecordBatch.from_arrays([pa.array([x for x, _ in got], pa.binary()), pa.array([x for _, x in got], pa.binary())], ["k", "starts"])

    now, named, held = None, None, []
    for b in batches:
        cols = [b.column(b.schema.get_field_index(c)).to_pylist() for c in ("chunk", "places", "docs")]
        for chunk, places, docs in zip(*cols):
            if chunk != now:
                if named is not None:
                    yield lay(named, held)
                now, named, held = chunk, None, []
            named = docs if docs is not None else named
            held.append(places)
    if named is not None:
        yield lay(named, held)


def _cut_batches(window: int, with_text: bool):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (keys, ords, starts), buf, start, end in text_chunks(batches, ["k", "ord", "starts"], CHUNK):
            out = {"k": keys.to_pylist(), "first_ord": ords.to_pylist(), "n_words": [], "n_removed": [], "spans": [], "kept_sha256": []}
            if with_text:
                out["kept_text"] = []
            for s, e, lists in zip(start.tolist(), end.tolist(), starts.to_pylist()):
                words = buf[s:e].tobytes().split()
                n = len(words)
                spans, removed = [], 0
                if lists:
                    at = np.frombuffer(lists, dtype="<u4").astype(np.int64)
                    step = np.zeros(n + 1, dtype=np.int32)
                    np.add.at(step, at, 1)
                    np.add.at(step, at + window, -1)
                    gone = np.cumsum(step[:-1]) > 0
                    removed = int(gone.sum())
                    spans = [{"start": int(a), "end": int(b)} for a, b in zip(*runs(gone))]
                    words = list(compress(words, (~gone).tolist()))
                kept = b" ".join(words)
                out["n_words"].append(n)
                out["n_removed"].append(removed)
                out["spans"].append(spans)
                out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                if with_text:
                    out["kept_text"].append((kept if removed else buf[s:e].tobytes()).decode())
            fields = [("k", pa.binary()), ("first_ord", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                      ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept_sha256", pa.string())]
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema(fields + [("kept_text", pa.string())] * with_text))
    return emit


def substring_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False,
                    carry: tuple[str, ...] = ()) -> DataFrame:
    """(id, n_words, n_removed, spans, kept_sha256) for each row; ``spans`` are the removed runs of words. With
    ``with_text`` also kept_text: the text itself if nothing was removed, else the kept words joined by one space.
    ``carry``: further columns of the rows to return as they are."""
    spark = df.sparkSession
    total = df.agg(F.sum(F.octet_length(F.col(f"`{text_col}`").cast("string"))).alias("n")).first().n or 0
    n_buckets = max(n_partitions(spark), math.ceil(total / BUCKET_BYTES))
    blocks = max(1, total // (6 * BLOCK))
    width = min(7, max(3, math.ceil((math.log2(blocks / n_buckets + 1) + 8 + 1) / 8)))
    # every use of `texts` takes all its columns, so that the uses share one shuffle
    texts = distinct_texts(df, id_col, text_col).select("k", F.col("text").cast("binary").alias("text"), "ord")
    hits = (texts.mapInArrow(_probe_batches(n_buckets, width), HITS)
            .repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_hit_batches(width), HITS))
    near = (hits.select("chunk", "gaps", "keys", "firsts").repartition("chunk").sortWithinPartitions("chunk")
            .mapInArrow(_region_batches, "k binary, near binary"))
    starts = (texts.join(near, "k").select("k", "ord", "text", "near")
              .mapInArrow(_window_batches(n_buckets), SEEN)
              .repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_settle_batches, "chunk binary, places binary, docs binary")
              .repartition("chunk").sortWithinPartitions("chunk").mapInArrow(_start_batches, "k binary, starts binary"))
    more = ", kept_text string" if with_text else ""
    done = texts.join(starts, "k", "left").select("k", "ord", "text", F.coalesce("starts", F.lit(b"")).alias("starts")).mapInArrow(
        _cut_batches(WINDOW, with_text),
        f"k binary, first_ord long, n_words long, n_removed long, spans array<struct<start:bigint,end:bigint>>, kept_sha256 string{more}")
    copy = (F.col("ord") != F.col("first_ord")) & (F.col("n_words") >= WINDOW)
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_words").alias("end")))
    out = rows_by_key(df, id_col, text_col, carry).join(done, "k")
    cols = [F.col("id").alias(id_col), "n_words", F.when(copy, F.col("n_words")).otherwise(F.col("n_removed")).alias("n_removed"),
            F.when(copy, whole).otherwise(F.col("spans")).alias("spans"),
            F.when(copy, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.col("kept_sha256")).alias("kept_sha256")]
    if with_text:
        cols.append(F.when(copy, F.lit("")).otherwise(F.col("kept_text")).alias("kept_text"))
    return out.select(*cols, *[F.col(f"__c{i}").alias(c) for i, c in enumerate(carry)])
