"""Vector codes by product quantisation, trained with member-resident Lloyd rounds.

A vector's components become integers floor(4096 * x) and are cut into ``PARTS`` consecutive parts; each part position has a
codebook of ``ENTRIES`` entries, at first the parts of the vectors with the least ids.

Members. A part lives with the owner of its (position, entry, salt): a table of members per round, shuffled and written by
that key. The salt spreads an entry over owners, so an entry that a third of all parts choose is no single task.
Round r reads the members where they lie and assigns them to the codebook of the round:

* parts that stay are summed where they lie, and only the sums (one row per task and entry) go to the owners;
* parts that change entry migrate: they alone go through the shuffle, into the table of round r.

A part of an earlier table is still resident if every codebook since its arrival gave it the same entry, which a task
checks from the codebooks (``ENTRIES * dimension`` numbers a round), so tables are never rewritten. Owners then sum the
arrivals and the sums they got, and the driver makes the next codebook from ``ENTRIES * dimension`` totals. All of it is
integer arithmetic: the results do not depend on partitions or retries.

Codes and errors come from one pass over the vectors with the final codebooks; no part travels back to its row.

Defined cases: vectors that are null or hold null or non-finite components are dropped. The dimension is the length that most
kept rows have (of several the least); rows of another length come back with null code and error. Parts of a dimension
that ``PARTS`` does not divide differ by one component; an empty vector's parts are all equal. Null ids count as the
greatest, equal ids are ordered by their vectors; repeated rows are members each. Fewer rows than entries give a codebook of as
many. Integers are kept within +-2**26 (components beyond +-16384), so every sum is an exact long; a sum
of errors beyond a long is null. An empty table gives an empty result. Columns besides id, vector and label are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewright.llm.common import n_partitions, saved
from tracewright.llm.skew import attach
from tracewright.llm.vectors import common_dimension, floored, lists, matrix, usable

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
LIMIT = 1 << 26
OWNER_PARTS = 1 << 17  # members of an owner, about, if a position's entries are chosen alike
STEP = 1 << 14         # vectors handled at a time inside a batch
MEMBER = "born int, position int, entry int, salt int, n long, part array<long>"
_MEMBER = pa.schema([("born", pa.int32()), ("position", pa.int32()), ("entry", pa.int32()), ("salt", pa.int32()), ("n", pa.int64()), ("part", pa.list_(pa.int64()))])


def part_cuts(d: int) -> list[int]:
    return [d * i // PARTS for i in range(PARTS + 1)]


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry of each row and its squared distance, exact; of equally near ones the lower."""
    most = max(np.abs(x).max(initial=0), np.abs(book).max(initial=0))
    kind = np.float64 if most < 1 << 20 and x.shape[1] <= 1 << 10 else np.int64  # below 2**53 doubles are exact and fast
    a, c = x.astype(kind), book.astype(kind)
    d = (a * a).sum(1)[:, None] - 2 * (a @ c.T) + (c * c).sum(1)[None, :]
    at = d.argmin(1)
    return at, d[np.arange(len(x)), at].astype(np.int64)


def _member_rows(born: int, position: int, entry: np.ndarray, salt: np.ndarray, part: np.ndarray) -> pa.RecordBatch:
    n = len(entry)
    return pa.RecordBatch.from_arrays([pa.array(np.full(n, born), pa.int32()), pa.array(np.full(n, position), pa.int32()), pa.array(entry, pa.int32()),
                                       pa.array(salt, pa.int32()), pa.nulls(n, pa.int64()), lists(part)], schema=_MEMBER)


def _add(sums: dict, position: int, entry: np.ndarray, part: np.ndarray, weight: np.ndarray | None = None) -> None:
    for e in np.unique(entry).tolist():
        mine = entry == e
        have = sums.setdefault((position, e), [0, np.zeros(part.shape[1], dtype=np.int64)])
        have[0] += int(mine.sum() if weight is None else weight[mine].sum())
        have[1] = have[1] + part[mine].sum(0)


def _sum_rows(born: int, sums: dict) -> pa.RecordBatch:
    keys = list(sums)
    return pa.RecordBatch.from_arrays([
        pa.array([born] * len(keys), pa.int32()), pa.array([p for p, _ in keys], pa.int32()), pa.array([e for _, e in keys], pa.int32()),
        pa.array([0] * len(keys), pa.int32()), pa.array([sums[k][0] for k in keys], pa.int64()), pa.array([sums[k][1].tolist() for k in keys], pa.list_(pa.int64()))],
        schema=_MEMBER)


def _place(books: list[np.ndarray], d: int, salts: int):
    """Round 1: every part to its owner."""
    cuts = part_cuts(d)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = 0
        for b in batches:
            for lo in range(0, b.num_rows, STEP):
                x = floored(matrix(b.column(0).slice(lo, STEP), d), SCALE, LIMIT)
                salt = (at + np.arange(len(x))) % salts
                at += len(x)
                for p in range(PARTS):
                    part = x[:, cuts[p]:cuts[p + 1]]
                    yield _member_rows(1, p, nearest(part, books[p])[0], salt, part)
    return emit


def _migrate(books: dict[int, list[np.ndarray]], now: int, salts: int):
    """Members to the parts that change entry in round ``now`` and the sums of those that stay."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict = {}
        at = 0
        for b in batches:
            born, position, entry = (b.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            size = b.column(3).value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            value = b.column(3).flatten().to_numpy(zero_copy_only=False)
            first = np.cumsum(size) - size
            for g, p in sorted(set(zip(born.tolist(), position.tolist()))):
                every = np.flatnonzero((born == g) & (position == p))
                for lo in range(0, len(every), STEP):
                    i = every[lo:lo + STEP]
                    x = value[first[i][:, None] + np.arange(size[i[0]])]
                    e = entry[i]
                    for k in range(g + 1, now):  # left before this round: lives in a later table
                        here = nearest(x, books[k][p])[0] == e
                        x, e = x[here], e[here]
                    to = nearest(x, books[now][p])[0]
                    goes = to != e
                    _add(sums, p, e[~goes], x[~goes])
                    n = int(goes.sum())
                    if n:
                        yield _member_rows(now, p, to[goes], (at + np.arange(n)) % salts, x[goes])
                        at += n
        if sums:
            yield _sum_rows(now, sums)
    return emit


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrivals and sums of an owner to one sum per entry."""
    sums: dict = {}
    for b in batches:
        position, entry = (b.column(i).to_numpy(zero_copy_only=False) for i in range(2))
        n = b.column(2).fill_null(1).to_numpy(zero_copy_only=False)
        size = b.column(3).value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        value = b.column(3).flatten().to_numpy(zero_copy_only=False)
        first = np.cumsum(size) - size
        for p in np.unique(position).tolist():
            i = np.flatnonzero(position == p)
            _add(sums, p, entry[i], value[first[i][:, None] + np.arange(size[i[0]])], n[i])
    if sums:
        yield _sum_rows(0, sums)


def _updated(books: list[np.ndarray], table: DataFrame) -> list[np.ndarray]:
    """The next codebook from a round's table: ``ENTRIES`` times the dimension totals reach the driver."""
    got = (table.select("position", "entry", "n", "part").mapInArrow(_totals, MEMBER)
           .select("position", "entry", "n", F.posexplode("part").alias("j", "s"))
           .groupBy("position", "entry", "j").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect())
    out = [b.copy() for b in books]
    for r in got:
        out[r["position"]][r["entry"], r["j"]] = r["s"] // r["n"]
    return out


def train(kept: DataFrame, id_col: str, vec_col: str, d: int, rounds: int = ROUNDS) -> list[np.ndarray]:
    """The codebooks of each part position after ``rounds`` rounds over the vectors of dimension ``d``."""
    spark = kept.sparkSession
    vec, ident = F.col(f"`{vec_col}`"), F.col(f"`{id_col}`")
    seeds = kept.select(vec.cast("array<double>").alias("v"), ident.alias("id")).orderBy(F.col("id").asc_nulls_last(), "v").limit(ENTRIES).collect()
    start = floored(np.array([r["v"] for r in seeds], dtype=np.float64).reshape(len(seeds), d), SCALE, LIMIT)
    cuts = part_cuts(d)
    books = {1: [start[:, a:b] for a, b in zip(cuts, cuts[1:])]}
    n, width = kept.count(), n_partitions(spark)
    salts = max(1, -(-n // (ENTRIES * OWNER_PARTS)), width // PARTS)
    members = []
    for now in range(1, rounds + 1):
        if now == 1:
            moves = kept.select(vec.alias("v")).mapInArrow(_place(books[1], d, salts), MEMBER)
        else:
            moves = members[0]
            for m in members[1:]:
                moves = moves.unionByName(m)
            moves = moves.mapInArrow(_migrate(dict(books), now, salts), MEMBER)
        table = saved(moves.repartition("position", "entry", "salt"), f"members-{now}")
        members.append(table.where("n is null").select("born", "position", "entry", "part"))
        books[now + 1] = _updated(books[now], table)
    return books[rounds + 1]


def _codes(books: list[np.ndarray], d: int):
    cuts = part_cuts(d)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, STEP):
                s = b.slice(lo, STEP)
                length = s.column(2).value_lengths().to_numpy(zero_copy_only=False)
                mine = length == d
                x = floored(matrix(s.column(2).filter(pa.array(mine)), d), SCALE, LIMIT)
                at, error = np.zeros((len(x), PARTS), dtype=np.uint8), np.zeros(len(x), dtype=np.int64)
                for p in range(PARTS):
                    at[:, p], far = nearest(x[:, cuts[p]:cuts[p + 1]], books[p])
                    error += far
                text = at.tobytes().hex()
                w = 2 * PARTS
                code, err = np.full(s.num_rows, None, dtype=object), np.full(s.num_rows, None, dtype=object)
                code[mine] = [text[i:i + w] for i in range(0, len(text), w)]
                err[mine] = error
                yield pa.RecordBatch.from_arrays([s.column(0), s.column(1), pa.array(code, pa.string()), pa.array(err.tolist(), pa.int64())], ["id", "label", "code", "error"])
    return emit


def codebook_digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(v) for b in books for v in b.ravel().tolist()).encode()).hexdigest()


def vector_codes(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", rounds: int = ROUNDS) -> DataFrame:
    """(id, code, error, label, label_error, codebooks_sha256) for each kept row."""
    vec, ident, label = F.col(f"`{vec_col}`"), F.col(f"`{id_col}`"), F.col(f"`{label_col}`")
    kept = df.select(ident.alias("id"), label.alias("label"), vec.alias("v")).where(usable(F.col("v")))
    d = common_dimension(kept, F.col("v"))
    alike = kept.where(F.size("v") == (d or 0))
    books = train(alike, "id", "v", d, rounds) if d is not None else [np.zeros((0, 0), dtype=np.int64)] * PARTS
    kinds = {f.name: f.dataType.simpleString() for f in kept.schema.fields}
    # an empty table has no codebooks and no rows to encode
    coded = saved(kept.mapInArrow(_codes(books, d or 0), f"id {kinds['id']}, label {kinds['label']}, code string, error long")
                  .withColumn("key", F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit("null"))), "vector-codes")
    most = F.lit((1 << 63) - 1).cast("decimal(38,0)")
    sums = coded.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("error").cast("decimal(19,0)")).alias("s"))
    sums = saved(sums.select("key", "n", F.when(F.col("s") <= most, F.col("s")).cast("long").alias("label_error")), "label-errors")
    return attach(coded, sums, "key", F.xxhash64("id", "code")).select(
        F.col("id").alias(id_col), "code", "error", F.col("label").alias(label_col), "label_error", F.lit(codebook_digest(books)).alias("codebooks_sha256"))
