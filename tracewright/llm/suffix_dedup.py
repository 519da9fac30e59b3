"""Suffix-array dedup: remove every byte covered by a ``width``-byte string that also starts anywhere else.

1. Anchors. In each text every start of a ``width``-byte string is given to the least hash among the
   ``GRAM``-byte strings inside it. Starts that follow one another with the same least hash form a window.
   Equal strings have the same least hash, so they meet in windows of one hash, and each start stands in
   exactly one window. Only hashes that at least two windows have, or that stand at several places of one
   window, go on: no repeat is lost.
2. Windows of such hashes are cut from the texts. Equal windows become one with a multiplicity (map-side).
3. Shards. Windows go to shards by hash; a hash with more than ``SHARD_WINDOWS`` windows is salted over
   several. A task lays whole (hash, salt) groups into shards of about ``SHARD_BYTES``, sorts the shard's
   suffixes by Larsson-Sadakane refinement, takes common prefixes by Kasai's walk, and reads off the classes
   of starts that share ``width`` bytes. A class with two starts, or one of a multiple window, is repeated.
4. Cross-shard merging, for salted hashes only: each shard sends its classes as sorted 128-bit digests, one per
   class, in ranges; per range every shard's digests are looked up in all others' by binary search, and
   starts that were alone in their shard but not in the corpus come back.
5. Starts return to the texts, bytes are removed and the rest is hashed, once per different text.

Results are exact but for collisions of 128-bit digests (texts, windows, merged classes).

A text longer than a piece makes a piece of its own, so the longest text bounds a task's memory.

Defined cases: a null text is empty; texts shorter than ``width`` lose nothing unless covered (they cannot be);
rows with equal texts are each other's copies, so all their bytes go if they are long enough; repeated
rows and ids are rows like any other; other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewright.llm.common import U64, BYTE_VALUE, distinct_texts, mix, rows_by_key, runs, text_chunks

WIDTH = 400
GRAM = 32                # bytes hashed at once for anchors (a power of two)
PIECE = 1 << 19          # starts handled at once
BLOCK = 1 << 15          # of these, hashed at once
POSITION_BITS = 20       # of a hash's 64, given to the place in a piece
SHARD_BYTES = 1 << 21
SORT_BYTES = (1 << 16) - 1  # of a shard sorted at once, so that three ranks and a place fit 64 bits
LANE = 256               # positions that follow from one comparison in Kasai's walk
SHARD_WINDOWS = 1500     # windows of one hash in one shard
_BYTE_ENDS = U64(0x80) << (U64(8) * np.arange(8, dtype=np.uint64))  # top bit of each byte of a word


def _gram_hash(buf: np.ndarray) -> np.ndarray:
    h, n, f = BYTE_VALUE[buf], 1, 0x9E3779B97F4A7C15
    while n < GRAM:
        h = h[:-n] * U64(f) + h[n:]
        n *= 2
        f = (f * f * 0x9E3779B97F4A7C15 | 1) & (2**64 - 1)
    return mix(h)


def _sliding_min(h: np.ndarray, w: int) -> np.ndarray:
    n = 1
    while n * 2 <= w:
        h = np.minimum(h[:-n], h[n:])
        n *= 2
    return np.minimum(h[:len(h) - (w - n)], h[w - n:]) if n < w else h


def _least(buf: np.ndarray, first: int, width: int) -> np.ndarray:
    """Least hash with its place, of each ``width``-byte string; ``first`` is the place of the first byte."""
    h = _gram_hash(buf)
    h >>= U64(POSITION_BITS)
    h <<= U64(POSITION_BITS)
    h |= np.arange(first, first + len(h), dtype=np.uint64)
    return _sliding_min(h, width - GRAM + 1)


def anchors_of(buf: np.ndarray, start: np.ndarray, end: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """(hash, first start, end of starts, whether the least hash stands at several places) of each window of the
    texts that lie one after another in ``buf``."""
    found = []
    full = end > start
    cut = np.zeros(len(buf) + 1, dtype=np.int32)  # positions whose string would leave its text
    np.add.at(cut, np.maximum(start[full], end[full] - width + 1), 1)
    np.add.at(cut, end[full], -1)
    inside = np.cumsum(cut[:-1]) == 0
    for at in range(0, len(buf) - width + 1, PIECE):
        part = buf[at:at + PIECE + width - 1]
        placed = np.concatenate([_least(part[a:a + BLOCK + width - 1], a, width) for a in range(0, len(part) - width + 1, BLOCK)])
        ok = inside[at:at + len(placed)]
        step = placed[1:] ^ placed[:-1]
        other = step >= U64(1 << POSITION_BITS)
        fresh = np.ones(len(placed), dtype=bool)
        fresh[1:] = other | ~ok[:-1]
        stop = np.append(np.flatnonzero(fresh | ~ok), len(placed))
        lo = np.flatnonzero(fresh & ok)
        hi = stop[np.searchsorted(stop, lo, side="right")]
        several = np.zeros(len(lo), dtype=bool)
        moved = np.flatnonzero((step != 0) & ~other & ok[:-1] & ok[1:])
        several[np.searchsorted(lo, moved, side="right") - 1] = True
        found.append((placed[lo] >> U64(POSITION_BITS), lo + at, hi + at, several))
    if not found:
        z = np.zeros(0, dtype=np.int64)
        return np.zeros(0, dtype=np.uint64), z, z, z.astype(bool)
    return tuple(np.concatenate(x) for x in zip(*found))


def _anchor_batches(width: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (keys, copies), buf, start, end in text_chunks(batches, ["k", "copies"], PIECE):
            h, lo, hi, several = anchors_of(buf, start, end, width)
            which = np.searchsorted(start, lo, side="right") - 1
            row = pa.array(which)
            yield pa.RecordBatch.from_arrays(
                [pa.array(h.view(np.int64)), keys.take(row),
                 pa.array(np.where(several, 2, copies.take(row).to_numpy())), pa.array(lo - start[which]),
                 pa.array(hi - start[which])], ["h", "k", "copies", "lo", "hi"])
    return emit


def _window_batches(width: int):
    """Windows of the wanted anchors: their digest, and their bytes."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (keys, copies, wanted), buf, start, _ in text_chunks(batches, ["k", "copies", "wanted"], 1 << 22):
            s = wanted.flatten()
            n = np.diff(wanted.offsets.to_numpy())
            row = np.repeat(np.arange(len(keys)), n)
            lo, hi = s.field("lo").to_numpy(), s.field("hi").to_numpy()
            a, b = start[row] + lo, start[row] + hi + width - 1
            data = [buf[x:y].tobytes() for x, y in zip(a.tolist(), b.tolist())]
            ids = [hashlib.blake2b(x, digest_size=16).digest() for x in data]
            yield pa.RecordBatch.from_arrays(
                [s.field("h"), s.field("n"), pa.array(ids, pa.binary()), keys.take(pa.array(row)), copies.take(pa.array(row)),
                 pa.array(lo), pa.array(data, pa.binary())], ["h", "n", "w", "k", "copies", "base", "data"])
    return emit


def suffix_array(text: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The suffixes of the strings in ``text``, sorted; ``left`` is how many bytes each has up to the end of its
    string (an end sorts before any byte; equal suffixes keep their order in ``text``).

    Larsson-Sadakane: sort by a few bytes, then double the sorted length by the ranks of the suffixes that
    far ahead, within groups that are not sorted yet. Ranks are packed into 64 bits with the place in the group's
    order: two of them, or three where they have at most 16 bits, which triples the sorted length."""
    n = len(text)
    if not n:
        return np.zeros(0, dtype=np.int64)
    kind = np.int32 if n < 1 << 30 else np.int64
    bits = n.bit_length()
    low = U64((1 << bits) - 1)
    code = np.cumsum(np.bincount(text, minlength=256) > 0)  # bytes that occur, numbered from 1; 0 is an end
    width = int(code[-1]).bit_length()
    have = (64 - bits) // width
    sym = np.concatenate((code.astype(np.uint64)[text], np.zeros(have, dtype=np.uint64)))
    left = left.astype(kind)
    key = sym[:n].copy()
    for j in range(1, have):
        key <<= U64(width)
        key |= sym[j:n + j] * (left > j)
    key <<= U64(bits)
    key |= np.arange(n, dtype=np.uint64)
    key.sort()
    sa = (key & low).astype(kind)
    first = np.ones(n + 1, dtype=bool)
    key >>= U64(bits)
    first[1:n] = key[1:] != key[:-1]
    rank = np.empty(n, dtype=kind)
    slot = np.arange(n, dtype=kind)
    rank[sa] = np.maximum.accumulate(slot * first[:n])
    at, suffix, tied = slot, sa, ~(first[:n] & first[1:])
    while True:
        go = np.flatnonzero(tied & (left[suffix] >= have))
        if not len(go):
            return sa.astype(np.int64)
        at, suffix = at[go], suffix[go]
        rest = left[suffix]
        steps = 2 if 4 * bits <= 64 else 1
        ranks = [rank[suffix]] + [np.where(rest > have * j, rank[np.minimum(suffix + have * j, n - 1)] + 1, 0)
                                  for j in range(1, steps + 1)]
        new = np.ones(len(at) + 1, dtype=bool)
        if bits * (steps + 2) <= 64:
            key = ranks[0].astype(np.uint64)
            for r in ranks[1:]:
                key <<= U64(bits)
                key |= r.astype(np.uint64)
            key <<= U64(bits)
            key |= np.arange(len(at), dtype=np.uint64)
            key.sort()
            order = (key & low).astype(kind)
            key >>= U64(bits)
            new[1:-1] = key[1:] != key[:-1]
        else:
            order = np.lexsort(ranks[::-1])
            major, minor = ranks[0][order], ranks[1][order]
            new[1:-1] = (major[1:] != major[:-1]) | (minor[1:] != minor[:-1])
        suffix = suffix[order]
        sa[at] = suffix
        rank[suffix] = at[np.maximum.accumulate(np.arange(len(at)) * new[:-1])]
        tied = ~(new[:-1] & new[1:])
        have *= steps + 1


def common_prefixes(text: np.ndarray, start: np.ndarray, left: np.ndarray, sa: np.ndarray, most: int) -> np.ndarray:
    """Kasai's walk: length (up to ``most``) of the prefix that each suffix in ``sa`` shares with the one before.

    From one position to the next, while the suffix before moves one position ahead as well, the prefix shrinks by
    exactly one. So only the first suffix of such a run (of at most ``LANE`` positions) is compared, eight bytes at a
    time and no further than the run needs; the others follow from it."""
    n = len(text)
    if not n:
        return np.zeros(0, dtype=np.int64)
    kind = np.int32 if n < 1 << 30 else np.int64
    left = left.astype(kind)
    padded = np.append(text, np.zeros(8, dtype=np.uint8))
    word = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(padded, 8)).view("<u8").reshape(-1)
    before = np.empty(n, dtype=kind)
    before[sa[1:]] = sa[:-1]
    before[sa[0]] = -1
    head = np.ones(n, dtype=bool)
    head[1:] = (before[1:] != before[:-1] + 1) | (before[:-1] < 0) | (text[:-1] != text[before[:-1]])
    head[1:] |= (left[:-1] == 1) | (left[before[:-1]] == 1)
    slot = np.arange(n, dtype=kind)
    into = slot - np.maximum.accumulate(slot * head)
    i = np.flatnonzero(into % LANE == 0).astype(kind)
    j = before[i]
    size = np.diff(i, append=n).astype(kind)
    limit = np.where(j >= 0, np.minimum(np.minimum(left[i], left[j]), most + size - 1), 0).astype(kind)
    shared = np.zeros(len(i), dtype=kind)
    act = np.flatnonzero(limit > 0)
    x, y = i[act], j[act]
    done = 0
    while len(act):
        diff = word[x + done] ^ word[y + done]
        same = diff == 0
        ends = ~same | (limit[act] <= done + 8)
        stop = act[ends]
        d = diff[ends]
        d &= ~d + U64(1)
        shared[stop] = done + np.where(d == 0, 8, np.searchsorted(_BYTE_ENDS, d, side="left"))
        act, x, y = act[~ends], x[~ends], y[~ends]
        done += 8
    shared = np.minimum(shared, limit)
    flat = np.minimum(np.repeat(shared + i, size) - slot, most)
    return flat[sa].astype(np.int64)


def _sorted_by_hash(text: np.ndarray, left: np.ndarray, edge: np.ndarray) -> np.ndarray:
    """Suffixes of the text, sorted apart in each stretch of about ``SORT_BYTES`` between two of the ``edge`` positions."""
    found, a = [], 0
    while a < len(edge) - 1:
        b = max(a + 1, int(np.searchsorted(edge, edge[a] + SORT_BYTES, side="right")) - 1)
        found.append(suffix_array(text[edge[a]:edge[b]], left[edge[a]:edge[b]]) + edge[a])
        a = b
    return np.concatenate(found)


def shard_repeats(windows: list[bytes], copies: np.ndarray, width: int, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """One shard, its windows in the order of their hashes ``h``: equal starts have one hash, so suffixes of different
    hashes need no common order. Returns (text, window start, classes' first suffix, repeated starts, starts alone in
    their class)."""
    sizes = np.array([len(w) for w in windows], dtype=np.int64)
    text = np.frombuffer(b"".join(windows), dtype=np.uint8)
    begin = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    owner = np.repeat(np.arange(len(windows)), sizes)
    left = np.repeat(begin + sizes, sizes) - np.arange(len(text))
    fresh = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
    sa = _sorted_by_hash(text, left, np.append(begin[fresh], len(text)))
    lcp = common_prefixes(text, begin, left, sa, width)
    is_start = left[sa] >= width
    label = np.cumsum(lcp < width)
    s, c = sa[is_start], label[is_start]
    new = np.flatnonzero(np.concatenate(([True], c[1:] != c[:-1]))) if len(c) else np.zeros(0, dtype=np.int64)
    total = np.add.reduceat(copies[owner[s]], new) if len(new) else np.zeros(0, dtype=np.int64)
    twice = np.repeat(total > 1, np.diff(np.append(new, len(s))))
    return text, begin, s[new], np.sort(s[twice]), s[new][total == 1]


STARTS = "w binary, lo array<int>, hi array<int>"
SOLVED = "w binary, lo array<int>, hi array<int>, h long, part int, digests binary, places binary"
_SOLVED_TYPE = pa.schema([("w", pa.binary()), ("lo", pa.list_(pa.int32())), ("hi", pa.list_(pa.int32())), ("h", pa.int64()),
                          ("part", pa.int32()), ("digests", pa.binary()), ("places", pa.binary())])
_PLACE = 20  # bytes: window digest and start in the window; zeros for a class with several starts


def solve_shard(rows: list[tuple], width: int) -> list[dict]:
    """``rows``: (h, salt, salts, w, copies, data). Rows of the answer without digests hold repeated starts of a
    window, as runs; rows with digests hold one range of a salted hash's classes in this shard."""
    h = np.array([r[0] for r in rows], dtype=np.int64)
    text, begin, heads, twice, single = shard_repeats(
        [r[5] for r in rows], np.array([r[4] for r in rows], dtype=np.int64), width, h)
    out = []
    owner = np.searchsorted(begin, twice, side="right") - 1
    edge = np.append(np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1]))), len(owner)) if len(owner) else [0]
    for a, b in zip(edge[:-1], edge[1:]):
        row = rows[owner[a]]
        at = twice[a:b] - begin[owner[a]]
        cut = np.flatnonzero(np.diff(at) > 1)
        out.append({"w": row[3], "lo": at[np.append(0, cut + 1)].tolist(), "hi": (at[np.append(cut, len(at) - 1)] + 1).tolist(),
                    "h": int.from_bytes(row[3][:8], "little", signed=True), "part": 0})
    salts = np.array([r[2] for r in rows], dtype=np.int64)
    head_owner = np.searchsorted(begin, heads, side="right") - 1
    for value in np.unique(h[salts > 1]):
        mine = heads[h[head_owner] == value]
        parts = int(salts[h == value][0])
        alone = np.isin(mine, single)
        ranges: dict[int, list[tuple]] = {}
        raw = text.tobytes()
        for at, lone in zip(mine.tolist(), alone.tolist()):
            digest = hashlib.blake2b(raw[at:at + width], digest_size=16).digest()
            o = int(np.searchsorted(begin, at, side="right")) - 1
            place = rows[o][3] + (at - int(begin[o])).to_bytes(4, "little") if lone else bytes(_PLACE)
            ranges.setdefault(int.from_bytes(digest[:4], "big") * parts >> 32, []).append((digest, place))
        for part, got in ranges.items():
            got.sort()
            out.append({"h": int(value), "part": part, "digests": b"".join(d for d, _ in got),
                        "places": b"".join(p for _, p in got)})
    return out


def _shard_batches(width: int, shard_bytes: int):
    """Rows in the order of (h, salt), laid into shards of whole (h, salt) groups."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard: list[tuple] = []
        group: list[tuple] = []
        out: list[dict] = []
        size = 0

        def close(group: list[tuple]) -> None:
            """Lay a whole group into the shard. A hash whose one window has copies has nothing to sort."""
            nonlocal shard, size
            if len(group) == 1 and group[0][2] == 1 and group[0][4] > 1:
                _, _, _, w, _, data = group[0]
                out.append({"w": w, "lo": [0], "hi": [len(data) - width + 1],
                            "h": int.from_bytes(w[:8], "little", signed=True), "part": 0})
                return
            grown = sum(len(r[5]) for r in group)
            if shard and size + grown > shard_bytes:
                out.extend(solve_shard(shard, width))
                shard, size = [], 0
            shard += group
            size += grown

        for b in batches:
            cols = [b.column(b.schema.get_field_index(c)).to_pylist() for c in ("h", "salt", "salts", "w", "copies", "data")]
            for row in zip(*cols):
                if group and group[0][:2] != row[:2]:
                    close(group)
                    group = []
                group.append(row)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=_SOLVED_TYPE)
                out = []
        if group:
            close(group)
        if shard:
            out.extend(solve_shard(shard, width))
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=_SOLVED_TYPE)
    return emit


def merge_ranges(digests: list[bytes], places: list[bytes]) -> tuple[list[bytes], list[int]]:
    """One range of a salted hash, a sorted digest list from each shard. Starts that are alone in their shard
    are looked up in all lists by binary search: (window, start) of those found more than once."""
    lists = [np.frombuffer(x, dtype=">u8").astype(np.uint64).reshape(-1, 2) for x in digests]
    every = np.concatenate(lists)
    every = every[np.lexsort((every[:, 1], every[:, 0]))]
    head = np.ascontiguousarray(every[:, 0])
    ws, at = [], []
    for one, place in zip(lists, places):
        lo, hi = np.searchsorted(head, one[:, 0], side="left"), np.searchsorted(head, one[:, 0], side="right")
        for i in np.flatnonzero(hi - lo > 1).tolist():
            p = place[_PLACE * i:_PLACE * (i + 1)]
            if p != bytes(_PLACE) and int((every[lo[i]:hi[i], 1] == one[i, 1]).sum()) > 1:
                ws.append(p[:16])
                at.append(int.from_bytes(p[16:], "little"))
    return ws, at


def _merge_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in the order of (h, part): starts pass, ranges of digests are merged."""
    key, digests, places = None, [], []
    ws: list[bytes] = []
    los: list[list[int]] = []
    his: list[list[int]] = []

    def merge() -> None:
        if len(digests) > 1:
            w, at = merge_ranges(digests, places)
            ws.extend(w)
            los.extend([x] for x in at)
            his.extend([x + 1] for x in at)

    for b in batches:
        for r in b.to_pylist():
            if r["digests"] is None:
                ws.append(r["w"])
                los.append(r["lo"])
                his.append(r["hi"])
                continue
            if key != (r["h"], r["part"]):
                merge()
                key, digests, places = (r["h"], r["part"]), [], []
            digests.append(r["digests"])
            places.append(r["places"])
        if ws:
            yield pa.RecordBatch.from_arrays([pa.array(ws, pa.binary()), pa.array(los, pa.list_(pa.int32())), pa.array(his, pa.list_(pa.int32()))], ["w", "lo", "hi"])
            ws, los, his = [], [], []
    merge()
    if ws:
        yield pa.RecordBatch.from_arrays([pa.array(ws, pa.binary()), pa.array(los, pa.list_(pa.int32())), pa.array(his, pa.list_(pa.int32()))], ["w", "lo", "hi"])


def _cut_batches(width: int):
    """Texts with the starts of repeats in them: what is left, its hash, and the removed spans."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (keys, spans), buf, start, end in text_chunks(batches, ["k", "spans"], 1 << 22):
            n = np.diff(spans.offsets.to_numpy())
            lo_all, hi_all = spans.flatten().field("lo").to_numpy(), spans.flatten().field("hi").to_numpy()
            at = np.concatenate(([0], np.cumsum(n)))
            out = {"k": keys.to_pylist(), "n_bytes": (end - start).tolist(), "n_removed": [], "spans": [], "kept_sha256": []}
            for i, (s, e) in enumerate(zip(start.tolist(), end.tolist())):
                a, b = at[i], at[i + 1]
                if a == b:
                    out["n_removed"].append(0)
                    out["spans"].append([])
                    out["kept_sha256"].append(hashlib.sha256(buf[s:e].tobytes()).hexdigest())
                    continue
                step = np.zeros(e - s + 1, dtype=np.int32)
                np.add.at(step, lo_all[a:b], 1)
                np.add.at(step, hi_all[a:b] + width - 1, -1)
                gone = np.cumsum(step[:-1]) > 0
                x, y = runs(gone)
                out["n_removed"].append(int(gone.sum()))
                out["spans"].append([{"start": int(p), "end": int(q)} for p, q in zip(x, y)])
                out["kept_sha256"].append(hashlib.sha256(buf[s:e][~gone].tobytes()).hexdigest())
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([
                ("k", pa.binary()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept_sha256", pa.string())]))
    return emit


def suffix_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
                 shard_bytes: int = SHARD_BYTES, shard_windows: int = SHARD_WINDOWS) -> DataFrame:
    """(id, n_bytes, n_removed, spans, kept_sha256) for each row; ``spans`` are the removed runs of bytes."""
    # every use of `texts` takes all its columns, so that the uses share one shuffle
    texts = (distinct_texts(df, id_col, text_col)
             .select("k", F.col("text").cast("binary").alias("text"), F.least("copies", F.lit(2)).alias("copies")))
    anchors = texts.mapInArrow(_anchor_batches(width), "h long, k binary, copies long, lo long, hi long")
    often = anchors.groupBy("h").agg(F.sum("copies").alias("n")).where("n > 1")
    wanted = anchors.join(often, "h").groupBy("k").agg(F.collect_list(F.struct("h", "n", "lo", "hi")).alias("wanted"))
    windows = texts.join(wanted, "k").select("k", "copies", "text", "wanted").mapInArrow(
        _window_batches(width), "h long, n long, w binary, k binary, copies long, base long, data binary")
    shards = (windows.groupBy("w", "h", "n").agg(F.sum("copies").alias("copies"), F.first("data").alias("data"))
              .withColumn("salts", F.ceil(F.col("n") / shard_windows).cast("int"))
              .withColumn("salt", F.pmod(F.xxhash64("w"), F.col("salts")).cast("int"))
              .repartition("h", "salt").sortWithinPartitions("h", "salt", "w")
              .select("h", "salt", "salts", "w", "copies", "data"))
    starts = (shards.mapInArrow(_shard_batches(width, shard_bytes), SOLVED)
              .repartition("h", "part").sortWithinPartitions("h", "part").mapInArrow(_merge_batches, STARTS)
              .select("w", F.explode(F.arrays_zip(F.col("lo").alias("a"), F.col("hi").alias("b"))).alias("x")).select("w", "x.a", "x.b"))
    spans = (windows.select("w", "k", "base").join(starts, "w")
             .groupBy("k").agg(F.collect_list(F.struct((F.col("base") + F.col("a")).alias("lo"), (F.col("base") + F.col("b")).alias("hi"))).alias("spans")))
    none = F.array().cast("array<struct<lo:bigint,hi:bigint>>")
    done = texts.join(spans, "k", "left").select("k", "copies", "text", F.coalesce("spans", none).alias("spans")).mapInArrow(
        _cut_batches(width), "k binary, n_bytes long, n_removed long, spans array<struct<start:bigint,end:bigint>>, kept_sha256 string")
    return rows_by_key(df, id_col, text_col).join(done, "k").select(
        F.col("id").alias(id_col), "n_bytes", "n_removed", "spans", "kept_sha256")
