"""Best-fit packing of documents into sequences by bin completion.

Only the lengths of the pieces decide a packing, and there are at most ``capacity`` of them, so Spark counts the
pieces per length and the driver packs the counts: a packing is a list of patterns (how many pieces of which
lengths) with multiplicities. Best-fit decreasing gives the incumbent. If it stands above the lower bound,
bin completion looks for better: around the largest length left it enumerates undominated fillings
(no left-out length could replace a smaller one in them, none fits besides), takes fuller ones first,
and drops a branch once its waste leaves no room to beat the incumbent. A filling is taken as often as counts
allow, then half as often and so on down to once; limits are the same for any number of pieces. The search stops at the
lower bound, or after ``nodes`` fillings or ``WORK`` choices for each of them, and then keeps the best packing found.

Pieces are numbered within their length without gathering a length in one task, and each number falls on a place
in a pattern: sequences are filled without moving texts.

A text longer than a sequence is cut into
pieces, however long; it is encoded whole in the task that holds its row.

Defined cases: a null text is empty and gives one piece, the end id; ids play no part in the packing, so
null and repeated ones and repeated rows are pieces like any other; other columns are not read; an empty
table gives an empty result.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewright.llm.common import saved, text_chunks
from tracewright.llm.ranking import number_within
from tracewright.llm.tokens import ENCODE_BYTES, encode

CAPACITY = 2048
NODES = 20_000   # fillings that a search may take
TRIES = 4096
KEPT = 40        # fillings that a step may branch to
WORK = 400       # choices that a search may try, per filling it may take
Pattern = tuple[int, tuple[tuple[int, int], ...]]  # times, ((length, pieces), ...) from long to short


def best_fit(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Best-fit decreasing on counts: equal bins are handled together."""
    groups: dict[tuple, int] = {}       # pattern -> bins
    rooms: dict[int, set] = {}          # room left -> patterns
    order: list[int] = []               # rooms in use, ascending

    def add(pattern: tuple, bins: int) -> None:
        room = capacity - sum(a * b for a, b in pattern)
        if room not in rooms:
            rooms[room] = set()
            order.insert(bisect_left(order, room), room)
        rooms[room].add(pattern)
        groups[pattern] = groups.get(pattern, 0) + bins

    def take(pattern: tuple, room: int, bins: int) -> None:
        groups[pattern] -= bins
        if not groups[pattern]:
            del groups[pattern]
            rooms[room].discard(pattern)
            if not rooms[room]:
                del rooms[room]
                order.pop(bisect_left(order, room))

    for length in sorted(counts, reverse=True):
        n = counts[length]
        while n:
            i = bisect_left(order, length)
            if i == len(order):
                each = capacity // length
                if n >= each:
                    add(((length, each),), n // each)
                if n % each:
                    add(((length, n % each),), 1)
                break
            room = order[i]
            pattern = min(rooms[room])
            each = room // length
            bins = min(groups[pattern], n // each)
            if not bins:
                each, bins = n, 1
            take(pattern, room, bins)
            add((*pattern, (length, each)), bins)
            n -= each * bins
    return [(bins, pattern) for pattern, bins in groups.items()]


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """The greater of the volume bound and the bound by lengths that cannot share (Martello and Toth)."""
    best = -(-sum(a * b for a, b in counts.items()) // capacity)
    lengths = sorted(counts)
    size = np.array(lengths, dtype=np.int64)
    n = np.array([counts[a] for a in lengths], dtype=np.int64)
    for k in {0, *(a for a in lengths if 2 * a <= capacity)}:
        alone = int(n[size > capacity - k].sum())
        half = (size <= capacity - k) & (2 * size > capacity)
        small = (2 * size <= capacity) & (size >= k)
        spare = int(n[half].sum()) * capacity - int((n * size)[half].sum())
        best = max(best, alone + int(n[half].sum()) + max(0, -(-(int((n * size)[small].sum()) - spare) // capacity)))
    return best


def fillings(counts: dict[int, int], lengths: list[int], room: int, waste: int) -> tuple[list[tuple[int, tuple]], int]:
    """Undominated fillings of ``room`` with waste up to ``waste``, fuller and longer first, of the first ``TRIES``
    choices, and how many choices that took. ``lengths`` ascends and holds the lengths left."""
    found: list[tuple[int, tuple]] = []
    chosen: list[int] = []
    used: dict[int, int] = {}
    tried = 1

    def undominated(left: int) -> bool:
        for x in {0, *chosen}:  # the greatest length that could stand in for x
            i = bisect_left(lengths, x + left + 1) - 1
            while i >= 0 and lengths[i] > x:
                if counts[lengths[i]] > used.get(lengths[i], 0):
                    return False
                i -= 1
        return True

    stack = [[bisect_left(lengths, room + 1) - 1, room, False]]  # per choice: next length to try, room left, whether one fitted
    while stack:
        frame = stack[-1]
        i, left, branched = frame
        if i >= 0 and tried < TRIES and (not found or found[-1][0] or len(found) < 8):
            frame[0] -= 1
            x = lengths[i]
            if counts[x] > used.get(x, 0):
                frame[2] = True
                tried += 1
                chosen.append(x)
                used[x] = used.get(x, 0) + 1
                stack.append([min(i, bisect_left(lengths, left - x + 1) - 1), left - x, False])
            continue
        if (not branched or not left) and left <= waste and undominated(left):
            found.append((left, tuple(chosen)))
        stack.pop()
        if chosen:
            used[chosen.pop()] -= 1
    return sorted(set(found), key=lambda f: (f[0], [-x for x in f[1]])), tried


def complete(counts: dict[int, int], capacity: int, below: int, nodes: int) -> list[Pattern] | None:
    """A packing in fewer than ``below`` bins, if the search finds one within ``nodes`` fillings and ``WORK`` choices
    a filling on average. One search for inputs of any size: a filling is taken as often as counts and waste allow, then
    half as often, and so on down to once, so what single fillings reach stays within reach."""
    volume = sum(a * b for a, b in counts.items())
    left = dict(counts)
    spent = tried = 0

    def take(filling: tuple, times: int) -> None:
        for x in filling:
            left[x] -= times
            if not left[x]:
                del left[x]

    def give(filling: tuple, times: int) -> None:
        for x in filling:
            left[x] = left.get(x, 0) + times

    path: list[Pattern] = []
    stack: list[list] = []   # per depth: [(waste, filling, most times) still to try, (waste, filling, times) now taken]

    def options(waste: int) -> list[tuple]:
        nonlocal tried
        top = max(left)
        left[top] -= 1
        if not left[top]:
            del left[top]
        got, n = fillings(left, sorted(left), capacity - top, waste)
        left[top] = left.get(top, 0) + 1
        tried += n
        return [(w, (top, *f), left[top]) for w, f in got][:KEPT]

    budget = (below - 1) * capacity - volume   # waste that still beats the incumbent
    if budget < 0:
        return None
    used = 0
    stack.append([options(budget), None])
    while stack:
        frame = stack[-1]
        if frame[1]:
            w, filling, times = frame[1]
            give(filling, times)
            path.pop()
            used -= w * times
            frame[1] = None
        if not frame[0] or spent >= nodes or tried >= nodes * WORK:
            stack.pop()
            continue
        w, filling, most = frame[0].pop(0)
        spent += 1
        times = min(most, *(left[x] // filling.count(x) for x in set(filling)))
        if w:
            times = min(times, (budget - used) // w)
        if times < 1:
            continue
        if times > 1:
            frame[0].insert(0, (w, filling, times // 2))
        take(filling, times)
        used += w * times
        path.append((times, tuple((x, filling.count(x)) for x in sorted(set(filling), reverse=True))))
        frame[1] = (w, filling, times)
        if not left:
            return path
        stack.append([options(budget - used), None])
    return None


def pack_counts(counts: dict[int, int], capacity: int = CAPACITY, nodes: int = NODES) -> list[Pattern]:
    """Patterns with multiplicities that hold each length exactly as often as counted, in few bins."""
    counts = {a: b for a, b in counts.items() if b}
    if not counts:
        return []
    best = best_fit(counts, capacity)
    least = lower_bound(counts, capacity)
    while (n := sum(t for t, _ in best)) > least:
        better = complete(counts, capacity, n, nodes)
        if better is None:
            break
        best = better
    return best


def _piece_batches(path: str, cuts: str | None, end_id: int, capacity: int, with_ids: bool, special: bool):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (ids,), buf, start, end in text_chunks(batches, ["id"], ENCODE_BYTES):
            token, first = encode(buf, start, end, path, cuts, special)
            row, piece, begin, length, crc, data = [], [], [], [], [], []
            for i, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
                mine = np.append(token[a:b], end_id).astype("<u4")
                head = (len(mine) - 1) % capacity + 1
                at = [0, *range(head, len(mine), capacity)]
                for j, (x, y) in enumerate(zip(at, [*at[1:], len(mine)])):
                    part = mine[x:y].tobytes()
                    row.append(i)
                    piece.append(j)
                    begin.append(x)
                    length.append(y - x)
                    crc.append(zlib.crc32(part))
                    data.append(part)
            cols = [ids.take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(begin, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = ["id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                cols, names = [*cols, pa.array(data, pa.binary())], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(cols, names)
    return emit


def _places(patterns: list[Pattern]) -> tuple[np.ndarray, ...]:
    """For numbers of a length from ``rank`` on: first sequence, pieces of that length in a sequence, first offset."""
    used: dict[int, int] = {}
    rows = []
    base = 0
    for times, pattern in patterns:
        offset = 0
        for length, each in pattern:
            rows.append((length, used.get(length, 0), base, each, offset))
            used[length] = used.get(length, 0) + times * each
            offset += length * each
        base += times
    rows.sort()
    return tuple(np.array(x, dtype=np.int64) for x in zip(*rows)) if rows else tuple(np.zeros(0, dtype=np.int64) for _ in range(5))


def _place_batches(places: tuple[np.ndarray, ...]):
    lengths, ranks, bases, each, offsets = places
    key = (lengths << 44) | ranks

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length = b.column(b.schema.get_field_index("length")).to_numpy()
            rank = b.column(b.schema.get_field_index("rank")).to_numpy()
            i = np.searchsorted(key, (length << 44) | rank, side="right") - 1
            nth = rank - ranks[i]
            yield pa.RecordBatch.from_arrays(
                [*b.drop_columns(["rank"]).columns, pa.array(bases[i] + nth // each[i]), pa.array(offsets[i] + nth % each[i] * length)],
                [*(n for n in b.schema.names if n != "rank"), "sequence_id", "offset"])
    return emit


def pack_documents(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", cuts: str | None = "byte",
                   end_id: int = 0, capacity: int = CAPACITY, with_ids: bool = False, special: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset) for each piece; ``with_ids`` adds its ids as
    little-endian unsigned 32-bit integers; ``special`` is as in tokens.py."""
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    fields = "id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    pieces = saved(rows.mapInArrow(_piece_batches(path, cuts, end_id, capacity, with_ids, special), fields), "pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most `capacity` rows
    patterns = pack_counts(counts, capacity)
    ranked = number_within(pieces, "length", ["id", "piece", "start", "ids_crc32"], "rank", max(counts.values(), default=1))
    return (ranked.select(*pieces.columns, "rank").mapInArrow(_place_batches(_places(patterns)), f"{fields}, sequence_id long, offset long")
            .withColumnRenamed("id", id_col))


def sequences(packed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(sequence_id, ids, length, documents) from pieces packed ``with_ids``: whole sequences, at most a capacity each."""
    part = F.struct("offset", F.col(id_col).alias("id"), "length", "ids")
    parts = F.sort_array(F.collect_list(part))
    joined = F.aggregate("parts", F.lit(b"").cast("binary"), lambda acc, x: F.concat(acc, x["ids"]))
    return packed.groupBy("sequence_id").agg(parts.alias("parts"), F.sum("length").alias("length")).select(
        "sequence_id", joined.alias("ids"), "length", F.transform("parts", lambda x: F.struct(x["id"], x["offset"], x["length"])).alias("documents"))
