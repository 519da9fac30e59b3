"""Near-duplicate documents by b-bit MinHash, links confirmed on full shingle sets.

1. Every text gives its set of 5-word shingles (64-bit hashes of lower-cased words), ``BANDS * ROWS`` minima,
   a key per band of ``ROWS`` minima, and a packed signature of the low ``LOW_BITS`` bits of every minimum. Texts with
   equal sets are one node from here on.
2. Band keys meet in buckets. A chunk sends one node per key and keeps the others as local links, so a key that a
   third of the documents have costs a bucket one entry per chunk. Each node is linked to the least node of its
   key: links grow with the nodes, not with the square of a group.
3. Packed signatures of linked nodes are compared by bit counts; the share of equal minima is corrected for
   chance collisions of the stored bits: each minimum is mixed with constants of its own function before, so
   collisions of two functions are independent. Links above ``GATE``, and all links of sets under ``SMALL``
   shingles, are confirmed on full sets, 100 * common >= 75 * union.
4. Components of the confirmed links. A key whose nodes all lie in one component is settled. In every other key
   with three nodes or more, nodes outside the key's largest component are compared with the key's nodes in other
   components. Both sides are cut into blocks of about ``BLOCK`` nodes and every two blocks meet in a group of their own:
   first by signature (and by size alone below ``SMALL``), without texts; only nodes that have a similar one in their group come again with their texts
   and are compared on full sets. A pair is compared in the first key it shares. So every pair
   that shares a key is either inside one component or has been compared: no link that would join components
   is lost but by the bands (5e-9 at similarity 0.75, less above) or the gate (over 5 standard deviations).
   Signatures compared grow with the square of an unsettled key, spread over its pairs of blocks.

Only links between nodes are followed; copies are never expanded into pairs.

A text longer than a chunk makes a
chunk of its own, so the longest text bounds a task's memory.

Defined cases: null or empty text, or text without words, has an empty set, is linked with nothing and is its
own component; fewer than five words give one shingle; null ids order before all others, and a component
whose least id is null has a null component_id; rows that repeat an id share its component's fate; other
columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewright.llm.common import (
    LEAST, U64, grams, joined, mix, n_partitions, order_value, saved, span_hashes, text_chunks, text_key,
    word_spans,
)
from tracewright.llm.components import components

SHINGLE = 5
PERCENT = 75
BANDS, ROWS = 50, 4
LOW_BITS = 2
GATE = 0.55           # estimated similarity below which a pair is not confirmed on full sets
SMALL = 32            # shingles of the smaller set below which a pair is confirmed whatever its estimate
SET_BYTES = 1 << 19   # bytes of text whose shingles are made at once
BLOCK = 1024          # nodes of one unsettled key on either side of a group
_rng = np.random.default_rng(20240731)
_FACTOR = _rng.integers(0, 2**32, BANDS * ROWS, dtype=np.uint32) | np.uint32(1)
_FLIP = _rng.integers(0, 2**32, BANDS * ROWS, dtype=np.uint32)
_MIX = _rng.integers(0, 2**32, (2, BANDS * ROWS), dtype=np.uint32) | np.uint32(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_POPCOUNT = np.array([bin(i).count("1") for i in range(256)], dtype=np.uint8)


def shingle_sets(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, shingle) pairs, distinct, in the order of document and shingle. About ``SET_BYTES`` of text are worked on
    at a time, whatever the documents hold together; a longer document is worked on alone."""
    docs, hashes = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.uint64)]
    a = 0
    while a < len(start):
        b = max(a + 1, int(np.searchsorted(end, start[a] + SET_BYTES, side="right")))
        d, h = _shingles(buf[start[a]:end[b - 1]], start[a:b] - start[a], end[a:b] - start[a])
        docs.append(d + a)
        hashes.append(h)
        a = b
    return np.concatenate(docs), np.concatenate(hashes)


def _shingles(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    low = _LOWER[buf]
    ws, we = word_spans(low, start, end)
    if not len(ws):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    words = span_hashes(low, ws, we)
    doc = np.searchsorted(start, ws, side="right") - 1
    full = grams(words, SHINGLE)
    same = doc[:len(full)] == doc[SHINGLE - 1:] if len(full) else np.zeros(0, dtype=bool)
    docs, hashes = [doc[:len(full)][same]], [full[same]]
    count = np.bincount(doc, minlength=len(start))
    first = np.cumsum(count) - count
    for n in range(1, SHINGLE):
        few = np.flatnonzero(count == n)
        if len(few):
            h = np.full(len(few), n, dtype=np.uint64)
            for j in range(n):
                h = mix(h * U64(0x9E3779B97F4A7C15) + words[first[few] + j])
            docs.append(few)
            hashes.append(h)
    d, h = np.concatenate(docs), np.concatenate(hashes)
    order = np.lexsort((h, d))
    d, h = d[order], h[order]
    new = np.ones(len(d), dtype=bool)
    new[1:] = (d[1:] != d[:-1]) | (h[1:] != h[:-1])
    return d[new], h[new]


def minima(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Least value of each of the hash functions over each set: (sets, functions)."""
    x = (hashes >> U64(32)).astype(np.uint32)
    out = np.empty((len(first), BANDS * ROWS), dtype=np.uint32)
    work = np.empty_like(x)
    for i in range(BANDS * ROWS):
        np.bitwise_xor(x, _FLIP[i], out=work)
        np.multiply(work, _FACTOR[i], out=work)
        out[:, i] = np.minimum.reduceat(work, first)
    return out


def band_keys(m: np.ndarray) -> np.ndarray:
    wide = m.reshape(len(m), BANDS, ROWS).astype(np.uint64)
    h = np.broadcast_to(np.arange(BANDS, dtype=np.uint64) + U64(1), wide.shape[:2]).copy()
    for j in range(ROWS):
        h = mix(h * U64(0x9E3779B97F4A7C15) + wide[:, :, j])
    return h


def pack_low_bits(m: np.ndarray) -> np.ndarray:
    """``LOW_BITS`` bits of each minimum, packed: bit planes one after another. The low bits of the minimum itself depend
    on the shingle's low bits alone, in every function alike, so it is mixed once more and gives high bits."""
    x = (m ^ (m >> np.uint32(16))) * _MIX[0]
    x = (x ^ (x >> np.uint32(15))) * _MIX[1]
    planes = [np.packbits((x >> np.uint32(31 - b)).astype(np.uint8) & 1, axis=1) for b in range(LOW_BITS)]
    return np.concatenate(planes, axis=1)


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarity from packed signatures (rows of bytes), corrected for low bits that agree by chance."""
    x = a ^ b
    width = x.shape[-1] // LOW_BITS
    differ = x[..., :width]
    for i in range(1, LOW_BITS):
        differ = differ | x[..., i * width:(i + 1) * width]
    equal = 1 - _POPCOUNT[differ].sum(axis=-1, dtype=np.int64) / (BANDS * ROWS)
    chance = 0.5 ** LOW_BITS
    return (equal - chance) / (1 - chance)


def passes(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Whether pairs are to be compared on full sets, from signatures and sizes."""
    least, most = np.minimum(size_a, size_b), np.maximum(size_a, size_b)
    return (100 * least >= PERCENT * most) & ((least < SMALL) | (estimate(a, b) >= GATE))


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per row: size of the set, its digest, and - for the first row of a digest in the chunk - band keys and signature."""
    for (ords, keys), buf, start, end in text_chunks(batches, ["ord", "k"], 1 << 20):
        d, h = shingle_sets(buf, start, end)
        n = np.bincount(d, minlength=len(start))
        first = np.cumsum(n) - n
        sets: list[bytes | None] = [hashlib.blake2b(h[a:a + c].tobytes(), digest_size=16).digest() if c else None
                                    for a, c in zip(first.tolist(), n.tolist())]
        lead = list({s: i for i, s in reversed(list(enumerate(sets))) if s is not None}.values())[::-1]
        bands: list[bytes | None] = [None] * len(sets)
        bits: list[bytes | None] = [None] * len(sets)
        if lead:
            size = n[lead]
            at = np.repeat(first[lead] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
            m = minima(h[at], np.cumsum(size) - size)
            for i, b, s in zip(lead, band_keys(m), pack_low_bits(m)):
                bands[i], bits[i] = b.tobytes(), s.tobytes()
        yield pa.RecordBatch.from_arrays(
            [ords, keys, pa.array(n.astype(np.int64)), pa.array(sets, pa.binary()), pa.array(bands, pa.binary()), pa.array(bits, pa.binary())],
            ["ord", "k", "n", "s", "bands", "bits"])


def _runs_of(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First index and length of each run in a sorted array."""
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return first, np.diff(np.append(first, len(keys)))


_ENTRY = np.dtype([("key", "<u8"), ("hi", "<u8"), ("lo", "<u8"), ("several", "u1")])


def _sorted_entries(e: np.ndarray) -> np.ndarray:
    return e[np.lexsort((e["lo"], e["hi"], e["key"]))]


def _node(e: np.ndarray) -> list[bytes]:
    """16-byte keys of entries; (hi, lo) hold them so that their numeric order is the order of the bytes."""
    raw = np.empty((len(e), 2), dtype=">u8")
    raw[:, 0], raw[:, 1] = e["hi"], e["lo"]
    data = raw.tobytes()
    return [data[i:i + 16] for i in range(0, len(data), 16)]


_MEMBERS = pa.schema([("bucket", pa.int32()), ("entries", pa.binary()), ("key", pa.int64()), ("s", pa.binary()), ("center", pa.binary())])


def _members_batch(key: np.ndarray, s: list[bytes], center: list[bytes], bucket: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(bucket.astype(np.int32)), pa.nulls(len(s), pa.binary()), pa.array(key.view(np.int64)),
                                       pa.array(s, pa.binary()), pa.array(center, pa.binary())], schema=_MEMBERS)


def _band_chunks(n_buckets: int, rows: int):
    """Nodes to bucket entries: one per key and chunk. Further nodes of a key in the chunk become members at once."""
    def flush(nodes: list[bytes], bands: list[bytes]) -> Iterator[pa.RecordBatch]:
        raw = np.frombuffer(b"".join(nodes), dtype=">u8").reshape(-1, 2).astype(np.uint64)
        keys = np.frombuffer(b"".join(bands), dtype=np.uint64)
        e = np.zeros(len(keys), dtype=_ENTRY)
        e["key"], e["hi"], e["lo"] = keys, np.repeat(raw[:, 0], BANDS), np.repeat(raw[:, 1], BANDS)
        e = _sorted_entries(e)
        first, n = _runs_of(e["key"])
        lead = np.zeros(len(e), dtype=bool)
        lead[first] = True
        e["several"][first] = n > 1
        bucket = (e["key"] % U64(n_buckets)).astype(np.int64)
        rest = ~lead
        if rest.any():
            center = np.repeat(first, n)[rest]
            yield _members_batch(e["key"][rest], _node(e[rest]), _node(e[center]), bucket[rest])
        e, bucket = e[lead], bucket[lead]
        order = np.argsort(bucket, kind="stable")
        e, bucket = e[order], bucket[order]
        first, n = _runs_of(bucket)
        yield pa.RecordBatch.from_arrays(
            [pa.array(bucket[first].astype(np.int32)), pa.array([e[a:a + c].tobytes() for a, c in zip(first, n)], pa.binary()),
             pa.nulls(len(first), pa.int64()), pa.nulls(len(first), pa.binary()), pa.nulls(len(first), pa.binary())], schema=_MEMBERS)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes: list[bytes] = []
        bands: list[bytes] = []
        for b in batches:
            nodes += b.column(0).to_pylist()
            bands += b.column(1).to_pylist()
            while len(nodes) >= rows:
                yield from flush(nodes[:rows], bands[:rows])
                nodes, bands = nodes[rows:], bands[rows:]
        if nodes:
            yield from flush(nodes, bands)
    return emit


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in the order of bucket: members pass, the entries of a bucket are joined by key."""
    def match(bucket: int, held: list[bytes]) -> pa.RecordBatch | None:
        e = _sorted_entries(np.frombuffer(b"".join(held), dtype=_ENTRY))
        first, n = _runs_of(e["key"])
        # a run of one entry counts if its chunk had several nodes of the key
        many = np.repeat((n > 1) | (np.maximum.reduceat(e["several"], first) > 0), n)
        if not many.any():
            return None
        center = np.repeat(first, n)[many]
        return _members_batch(e["key"][many], _node(e[many]), _node(e[center]), np.full(int(many.sum()), bucket))

    now, held = None, []
    for b in batches:
        entries = b.column(b.schema.get_field_index("entries"))
        ready = b.filter(entries.is_null())
        if ready.num_rows:
            yield ready
        at = b.column(b.schema.get_field_index("bucket")).to_pylist()
        for bucket, x in zip(at, entries.to_pylist()):
            if x is None:
                continue
            if bucket != now:
                if held and (got := match(now, held)) is not None:
                    yield got
                now, held = bucket, []
            held.append(x)
    if held and (got := match(now, held)) is not None:
        yield got


def _similar(t: pa.Table) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """One group of an unsettled key: for each row of the outer block the rows of the inner block that it is compared
    with on full sets, the most similar first, and each row's component. A pair passes in the first key that it
    shares and there only, and if both its nodes are outside the main component, in the order of their keys."""
    key = np.uint64(t.column("key")[0].as_py() & (2**64 - 1))
    s, size = t.column("s").to_pylist(), t.column("n").to_numpy()
    outer, core = (np.array(t.column(c).to_pylist(), dtype=bool) for c in ("outside", "core"))
    names: dict[bytes, int] = {}
    part = np.array([names.setdefault(r, len(names)) for r in t.column("root").to_pylist()])
    place = {x: i for i, x in enumerate(sorted(set(s)))}
    nth = np.array([place[x] for x in s])
    bits = np.frombuffer(b"".join(t.column("bits").to_pylist()), dtype=np.uint8).reshape(len(s), -1)
    bands = np.frombuffer(b"".join(t.column("bands").to_pylist()), dtype=np.uint64).reshape(len(s), -1)
    inner = np.flatnonzero(~outer)
    for i in np.flatnonzero(outer):
        near = inner[(part[inner] != part[i]) & (core[inner] | (nth[inner] > nth[i]))]
        near = near[passes(bits[near], bits[i], size[near], size[i])]
        near = near[bands[i][(bands[near] == bands[i]).argmax(axis=1)] == key]
        if len(near):
            yield i, near[np.argsort(-estimate(bits[near], bits[i]), kind="stable")], part


def _needed(t: pa.Table) -> pa.Table:
    """The rows of a group that have a similar one on its other side."""
    need = np.zeros(t.num_rows, dtype=bool)
    for i, near, _ in _similar(t):
        need[i] = True
        need[near] = True
    return t.filter(pa.array(need))


def _links_across(t: pa.Table) -> pa.Table:
    """The needed rows of a group with their texts: links between components, confirmed on full sets."""
    s, text = t.column("s").to_pylist(), t.column("text")
    d, h = shingle_sets(*joined(text.combine_chunks() if text.num_chunks != 1 else text.chunk(0)))
    at = np.searchsorted(d, np.arange(len(s) + 1))
    size = np.diff(at)
    a, b = [], []
    for i, near, part in _similar(t):
        mine, linked = h[at[i]:at[i + 1]], set()
        for j in near.tolist():
            if part[j] in linked:
                continue
            common = len(np.intersect1d(mine, h[at[j]:at[j + 1]], assume_unique=True))
            if 100 * common >= PERCENT * (size[i] + size[j] - common):
                linked.add(part[j])
                a.append(s[i])
                b.append(s[j])
    return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})


def _gate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if not b.num_rows:
            continue
        x = [np.frombuffer(b"".join(b.column(b.schema.get_field_index(c)).to_pylist()), dtype=np.uint8).reshape(b.num_rows, -1) for c in ("bits_a", "bits_b")]
        n = [b.column(b.schema.get_field_index(c)).to_numpy() for c in ("n_a", "n_b")]
        yield b.select(["a", "b"]).filter(pa.array(passes(*x, *n)))


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs with both texts: those whose full sets are similar enough."""
    def one(b: pa.RecordBatch) -> pa.RecordBatch:
        texts = pa.concat_arrays([b.column(b.schema.get_field_index(c)) for c in ("text_a", "text_b")])
        d, h = shingle_sets(*joined(texts))
        n = b.num_rows
        size = np.bincount(d, minlength=2 * n)
        pair = d % n
        order = np.lexsort((h, pair))
        pair, h = pair[order], h[order]
        twice = (pair[1:] == pair[:-1]) & (h[1:] == h[:-1])
        common = np.bincount(pair[1:][twice], minlength=n)
        return b.select(["a", "b"]).filter(pa.array(100 * common >= PERCENT * (size[:n] + size[n:] - common)))

    for b in batches:
        for at in range(0, b.num_rows, 256):
            yield one(b.slice(at, 256))


_GROUP = "key long, s binary, root binary, n long, bits binary, bands binary, core boolean, outer int, inner int, outside boolean"


def _blocked(opened: DataFrame) -> DataFrame:
    """Nodes of unsettled keys in groups (key, outer, inner): nodes outside the main component are dealt over
    ``outer_blocks``, all nodes over ``blocks``, and every two blocks meet once; ``outside`` tells the sides apart."""
    nth = lambda n: F.pmod(F.xxhash64("s"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    marked = opened.withColumn("core", F.col("root") == F.col("main"))
    inner = marked.withColumn("outer", every("outer_blocks")).withColumn("inner", nth("blocks")).withColumn("outside", F.lit(False))
    outer = marked.where("not core").withColumn("outer", nth("outer_blocks")).withColumn("inner", every("blocks")).withColumn("outside", F.lit(True))
    cols = [f.split()[0] for f in _GROUP.split(", ")]
    return inner.select(*cols).unionByName(outer.select(*cols))


def minhash_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK,
                  chunk_nodes: int = 5_000) -> DataFrame:
    """(id, n_shingles, component_id, kept) for each row."""
    spark = df.sparkSession
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = df.select(order_value(F.col(f"`{id_col}`")).alias("ord"), text.alias("text")).withColumn("k", text_key(F.col("text")))
    sketch = saved(rows.select("ord", "k", "text").mapInArrow(_sketch, "ord long, k binary, n long, s binary, bands binary, bits binary"), "sketch")
    nodes = saved(sketch.where("s is not null").groupBy("s").agg(
        F.min("ord").alias("ord"), F.min("k").alias("k"), F.first("n").alias("n"), F.first("bits", True).alias("bits"), F.first("bands", True).alias("bands")), "nodes")
    n_buckets = 8 * n_partitions(spark)
    members = saved(nodes.select("s", "bands").mapInArrow(_band_chunks(n_buckets, chunk_nodes), "bucket int, entries binary, key long, s binary, center binary")
                    .repartition("bucket").sortWithinPartitions("bucket")
                    .mapInArrow(_meet, "bucket int, entries binary, key long, s binary, center binary").select("key", "s", "center"), "members")
    # texts of all nodes that share a key with another
    needed = members.select("s").distinct().join(nodes.select("s", "k"), "s")
    texts = saved(rows.select("k", "text").join(needed, "k").groupBy("s").agg(F.first("text").alias("text")), "texts")

    def side(t: DataFrame, name: str, *values: str) -> DataFrame:
        return t.select(F.col("s").alias(name), *[F.col(v).alias(f"{v}_{name}") for v in values])

    def confirmed(pairs: DataFrame) -> DataFrame:
        both = pairs.join(side(texts, "a", "text"), "a").join(side(texts, "b", "text"), "b")
        return both.select("a", "b", "text_a", "text_b").mapInArrow(_confirm, "a binary, b binary")

    star = members.where("s <> center").select(F.greatest("s", "center").alias("a"), F.least("s", "center").alias("b")).distinct()
    gated = (star.join(side(nodes, "a", "bits", "n"), "a").join(side(nodes, "b", "bits", "n"), "b")
             .select("a", "b", "bits_a", "bits_b", "n_a", "n_b").mapInArrow(_gate, "a binary, b binary"))
    links = saved(confirmed(gated), "confirmed")
    roots = saved(components(links), "roots")
    # keys that are not settled
    placed = members.select("key", "s").join(roots, "s", "left").select("key", "s", F.coalesce("root", "s").alias("root"))
    counts = placed.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"))
    most = lambda n: F.ceil(F.col(n) / block).cast("int")
    unsettled = (counts.groupBy("key").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("roots"), F.max(F.struct("n", "root")).alias("top"))
                 .where("roots > 1 and n > 2").withColumn("rest", F.col("n") - F.col("top.n"))
                 .select("key", most("n").alias("blocks"), most("rest").alias("outer_blocks"), F.col("top.root").alias("main")))
    opened = placed.join(unsettled, "key").join(nodes.select("s", "n", "bits", "bands"), "s")
    group = ["key", "outer", "inner"]
    needed = _blocked(opened).groupBy(*group).applyInArrow(_needed, _GROUP)
    more = saved(needed.join(texts, "s").groupBy(*group).applyInArrow(_links_across, "a binary, b binary"), "across")
    if not more.isEmpty():
        roots = saved(components(roots.select(F.col("s").alias("a"), F.col("root").alias("b")).unionByName(more)), "roots")
    found = nodes.select("s", "ord").join(roots, "s")
    least = found.groupBy("root").agg(F.min("ord").alias("component"))
    component = found.join(least, "root").select("s", "component")
    own = nodes.select("s", F.col("ord").alias("own"))
    out = (sketch.select("ord", "n", "s").join(own, "s", "left").join(component, "s", "left")
           .withColumn("c", F.coalesce("component", "own", "ord")))
    back = lambda c: F.when(F.col(c) != LEAST, F.col(c))
    return out.select(back("ord").alias(id_col), F.col("n").alias("n_shingles"), back("c").alias("component_id"),
                      (F.col("c") == F.col("ord")).alias("kept"))
