"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A paragraph is what line feeds and sentence ends (``. ! ?`` before a space) part; a repeated one counts again, its
digest taken with its number. Each digest falls in one cell of each of ``HASHES`` subtables; a cell holds a count, a sum
of digests and a sum of check values, all modulo a power of two. The sketch of one version minus that of another
holds only paragraphs that differ, and peeling cells with a single digest recovers them. If something is
left, both sketches are made again ``GROWTH`` times as large, with other hashes, until all is recovered.

A fingerprint is the number of paragraphs and the cells of the smallest sketch, in hexadecimal; equal texts have equal
fingerprints. The likeness of two is common / all paragraphs (1 for two empty ones), from the recovered difference.

Neighbours: documents are cut into ranges of ids and sorted inside them, one shuffle of the texts; the first document
of each range is sent to the range before it as well, so every document meets the next one.

All sketches of a chunk are built and peeled together, cells of all documents in one array.

A very long text is fingerprinted whole in the task
that holds its row.

Defined cases: a null text is empty; null ids come last in descending order; documents of equal ids are ordered by
descending digests of their texts; repeated rows are rows like any other; one document alone is its own next;
other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewright.llm.common import LEAST, U64, mix, n_partitions, order_value, prefix_hash, range_buckets, span_hash, text_key

HASHES = 3
CELLS = 18               # of the smallest sketch; a multiple of HASHES
GROWTH = 4
RANGE_BYTES = 1 << 24
MOST_RANGES = 8192
CHUNK = 1 << 20          # bytes of text handled together


def paragraph_digests(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, digest) of each paragraph of the texts in ``buf``; digests differ within a text."""
    n = len(buf)
    if not n:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    gap = buf == 0x0A
    stop = (buf == 0x2E) | (buf == 0x21) | (buf == 0x3F)
    gap[1:] |= (buf[1:] == 0x20) & stop[:-1]
    full = end > start
    gap[start[full]] = buf[start[full]] == 0x0A  # a text's first space follows nothing
    inside = ~gap
    before = np.zeros(n, dtype=bool)
    before[1:] = inside[:-1]
    before[start[full]] = False
    after = np.zeros(n, dtype=bool)
    after[:-1] = inside[1:]
    after[end[full] - 1] = False
    s, e = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    h = span_hash(prefix_hash(buf), s, e)
    doc = np.searchsorted(start, s, side="right") - 1
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    at = np.arange(len(h))
    nth = at - np.maximum.accumulate(np.where(new, at, 0))
    return doc, mix(h + nth.astype(np.uint64) * U64(0x9E3779B97F4A7C15))


def _cells_of(digest: np.ndarray, cells: int, level: int) -> list[np.ndarray]:
    each = cells // HASHES
    return [(mix(digest + U64((level * HASHES + t + 1) * 0xD1342543DE82EF95 & (2**64 - 1))) % U64(each)).astype(np.int64) + t * each
            for t in range(HASHES)]


def _check(digest: np.ndarray) -> np.ndarray:
    return mix(digest ^ U64(0x5851F42D4C957F2D)) >> U64(32)


class Sketches:
    """Invertible Bloom lookup sketches of ``n`` documents, one array per field of a cell."""

    def __init__(self, n: int, cells: int, level: int = 0):
        self.cells, self.level = cells, level
        self.count = np.zeros(n * cells, dtype=np.int64)
        self.key = np.zeros(n * cells, dtype=np.uint64)
        self.check = np.zeros(n * cells, dtype=np.uint64)

    def add(self, doc: np.ndarray, digest: np.ndarray, sign: int | np.ndarray = 1) -> Sketches:
        by = np.broadcast_to(np.asarray(sign, dtype=np.int64), digest.shape)
        times = by.astype(np.uint64)  # -1 is 2**64 - 1: sums are modulo 2**64
        check = _check(digest) * times
        for cell in _cells_of(digest, self.cells, self.level):
            at = doc * self.cells + cell
            np.add.at(self.count, at, by)
            np.add.at(self.key, at, digest * times)
            np.add.at(self.check, at, check)
        return self

    def minus(self, other: Sketches, doc: np.ndarray, other_doc: np.ndarray) -> Sketches:
        """The sketches of ``doc`` here less those of ``other_doc`` there."""
        out = Sketches(len(doc), self.cells, self.level)
        pick = lambda x, d: x.reshape(-1, self.cells)[d].ravel()
        out.count = pick(self.count, doc) - pick(other.count, other_doc)
        out.key = pick(self.key, doc) - pick(other.key, other_doc)
        out.check = pick(self.check, doc) - pick(other.check, other_doc)
        return out

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Recovered (document, digest, sign), and which documents were emptied. Consumes the sketches."""
        docs, digests, signs = [], [], []
        at = np.flatnonzero(np.abs(self.count) == 1)
        while len(at):
            sign = self.count[at]
            times = sign.astype(np.uint64)
            digest = self.key[at] * times
            pure = (np.abs(sign) == 1) & (self.check[at] * times == _check(digest))
            # a digest alone in a cell stands in the one cell of that subtable it belongs to
            own = np.zeros(len(at), dtype=bool)
            for cell in _cells_of(digest, self.cells, self.level):
                own |= cell == at % self.cells
            pure &= own
            doc, digest, sign = at[pure] // self.cells, digest[pure], sign[pure]
            order = np.lexsort((digest, doc))
            doc, digest, sign = doc[order], digest[order], sign[order]
            new = np.ones(len(doc), dtype=bool)
            new[1:] = (doc[1:] != doc[:-1]) | (digest[1:] != digest[:-1])
            doc, digest, sign = doc[new], digest[new], sign[new]
            if not len(doc):
                break
            docs.append(doc)
            digests.append(digest)
            signs.append(sign)
            self.add(doc, digest, -sign)
            touched = np.unique(np.concatenate([doc * self.cells + c for c in _cells_of(digest, self.cells, self.level)]))
            at = touched[np.abs(self.count[touched]) == 1]
        left = (self.count != 0) | (self.key != 0) | (self.check != 0)
        empty = ~left.reshape(-1, self.cells).any(axis=1)
        cat = lambda x, t: np.concatenate(x) if x else np.zeros(0, dtype=t)
        return cat(docs, np.int64), cat(digests, np.uint64), cat(signs, np.int64), empty

    def text(self, i: int, n: int) -> str:
        row = slice(i * self.cells, (i + 1) * self.cells)
        return (n.to_bytes(4, "little") + self.count[row].astype("<i4").tobytes() + self.key[row].tobytes()
                + self.check[row].astype("<u4").tobytes()).hex()


class Paragraphs:
    """Paragraph digests of a chunk's documents, and their smallest sketches."""

    def __init__(self, texts: list[bytes]):
        size = np.array([len(t) for t in texts], dtype=np.int64)
        end = np.cumsum(size)
        self.doc, self.digest = paragraph_digests(np.frombuffer(b"".join(texts), dtype=np.uint8), end - size, end)
        self.n = np.bincount(self.doc, minlength=len(texts)).astype(np.int64)
        self.first = np.cumsum(self.n) - self.n
        self.base = Sketches(len(texts), CELLS).add(self.doc, self.digest)

    def of(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position in ``docs``, digest) of the paragraphs of ``docs``."""
        n = self.n[docs]
        at = np.repeat(self.first[docs] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        return np.repeat(np.arange(len(docs)), n), self.digest[at]

    def fingerprints(self) -> list[str]:
        return [self.base.text(i, n) for i, n in enumerate(self.n.tolist())]


def difference_sizes(a: Paragraphs, a_doc: np.ndarray, b: Paragraphs, b_doc: np.ndarray) -> np.ndarray:
    """How many paragraphs differ in each pair of documents, recovered by peeling."""
    out = np.zeros(len(a_doc), dtype=np.int64)
    rest = np.arange(len(a_doc))
    cells, level = CELLS, 0
    while len(rest):
        if level:
            pos, digest = a.of(a_doc[rest])
            diff = Sketches(len(rest), cells, level).add(pos, digest)
            pos, digest = b.of(b_doc[rest])
            diff.add(pos, digest, -1)
        else:
            diff = a.base.minus(b.base, a_doc, b_doc)
        doc, _, _, done = diff.peel()
        out[rest[done]] = np.bincount(doc, minlength=len(rest))[done]
        rest = rest[~done]
        level += 1
        if cells < 8 * (CELLS + int((a.n[a_doc[rest]] + b.n[b_doc[rest]]).max(initial=0))):
            cells *= GROWTH
    return out


def likeness(a: Paragraphs, a_doc: np.ndarray, b: Paragraphs, b_doc: np.ndarray) -> np.ndarray:
    differ = difference_sizes(a, a_doc, b, b_doc)
    total = a.n[a_doc] + b.n[b_doc]
    return np.where(total > 0, (total - differ) / np.maximum(total + differ, 1), 1.0)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, str, str]]:
    """(ord, text, next text) from rows in the order of (bucket, tail, descending documents)."""
    now, prev, tail = None, None, False
    for b in batches:
        for bucket, is_tail, ord_, text in zip(*(b.column(b.schema.get_field_index(c)).to_pylist() for c in ("bucket", "tail", "ord", "text"))):
            if bucket != now:
                now, prev, tail = bucket, None, False
            if tail:       # copies of a repeated first row
                continue
            if prev is not None:
                yield prev[0], prev[1], text
            tail = bool(is_tail)
            prev = None if tail else (ord_, text)


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def out(held: list[tuple[int, str, str]]) -> pa.RecordBatch:
        texts = [t.encode() for _, t, _ in held]
        edited = [(t[:len(t) - len(t) // 2] + nxt[:len(t) // 2]).encode() for _, t, nxt in held]
        # the next document of a row is mostly the row after it; where it is not, it is appended
        extra = [(i, held[i][2].encode()) for i in range(len(held)) if i + 1 == len(held) or held[i][2] != held[i + 1][1]]
        nxt = np.arange(1, len(held) + 1)
        for j, (i, _) in enumerate(extra):
            nxt[i] = len(held) + j
        a, e = Paragraphs(texts + [t for _, t in extra]), Paragraphs(edited)
        own = np.arange(len(held))
        return pa.RecordBatch.from_arrays([
            pa.array([o for o, _, _ in held], pa.int64()), pa.array([len(t) for _, t, _ in held], pa.int64()),
            pa.array([hashlib.sha256(t).hexdigest() for t in edited]), pa.array(a.fingerprints()[:len(held)]), pa.array(e.fingerprints()),
            pa.array(likeness(a, own, e, own)), pa.array(likeness(a, own, a, nxt)), pa.array(a.n[:len(held)])],
            ["ord", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "n_paragraphs"])

    held, size = [], 0
    for row in _pairs(batches):
        held.append(row)
        size += len(row[1])
        if size >= CHUNK:
            yield out(held)
            held, size = [], 0
    if held:
        yield out(held)


def document_fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_paragraphs) for each row;
    the edited text has its last half replaced by the beginning of the next document in descending order of ids."""
    spark = df.sparkSession
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = df.select(order_value(F.col(f"`{id_col}`")).alias("ord"), text.alias("text"))
    total = rows.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    rows, n = range_buckets(rows, "ord", min(MOST_RANGES, max(n_partitions(spark), math.ceil(total / RANGE_BYTES))))
    rows = rows.withColumn("k", text_key(F.col("text")))
    firsts = rows.groupBy("bucket").agg(F.max(F.struct("ord", "k")).alias("top")).collect()  # at most MOST_RANGES rows
    order = sorted(r["bucket"] for r in firsts)
    above = {b: order[(i + 1) % len(order)] for i, b in enumerate(order)}  # the first of a range ends the range above
    lead = spark.createDataFrame([(r["top"]["ord"], r["top"]["k"], above[r["bucket"]]) for r in firsts], "f_ord long, f_k binary, to int")
    tails = (rows.join(F.broadcast(lead), (F.col("ord") == F.col("f_ord")) & (F.col("k") == F.col("f_k")))
             .select(F.col("to").alias("bucket"), F.lit(1).alias("tail"), "ord", "k", "text"))
    every = rows.select("bucket", F.lit(0).alias("tail"), "ord", "k", "text").unionByName(tails)
    sorted_rows = every.repartitionById(n, F.col("bucket")).sortWithinPartitions("bucket", "tail", F.desc("ord"), F.desc("k"))
    got = sorted_rows.select("bucket", "tail", "ord", "text").mapInArrow(
        _fingerprint_batches, "ord long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double, n_paragraphs long")
    return got.select(F.when(F.col("ord") != LEAST, F.col("ord")).alias(id_col), *got.columns[1:])
