"""Vector codes against a brute-force Lloyd in plain Python integers."""

import hashlib
import math
import random

import duckdb
import pyarrow as pa
import pytest

from tracewright.llm import oracles
from tracewright.llm import vector_codes as V

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, rounds=6):
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    ints = [[math.floor(4096 * x) for x in r[1]] for r in kept]
    order = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, kept[i][1]))
    d = len(ints[0])
    cut = [d * i // 8 for i in range(9)]
    books = [[ints[i][a:b] for i in order[:16]] for a, b in zip(cut, cut[1:])]
    near = lambda x, b: min((sum((p - q) ** 2 for p, q in zip(x, c)), e) for e, c in enumerate(b))
    for _ in range(rounds):
        for p in range(8):
            got = {}
            for x in ints:
                part = x[cut[p]:cut[p + 1]]
                got.setdefault(near(part, books[p])[1], []).append(part)
            for e, parts in got.items():
                books[p][e] = [sum(c) // len(parts) for c in zip(*parts)]
    sha = hashlib.sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest()
    out = []
    for r, x in zip(kept, ints):
        n = [near(x[cut[p]:cut[p + 1]], books[p]) for p in range(8)]
        out.append((r[0], "".join(f"{e:02x}" for _, e in n), sum(f for f, _ in n), r[2]))
    total = {}
    for x in out:
        total[x[3]] = total.get(x[3], 0) + x[2]
    return sorted((str((*x, total[x[3]], sha)) for x in out))


def table(seed, n=300, d=16):
    r = random.Random(seed)
    centres = [[r.gauss(0, 1) for _ in range(d)] for _ in range(12)]
    rows = [(i * 13 % 997, [float(f"{c + r.gauss(0, .3):.4f}") for c in r.choice(centres)], r.choice([1, 2, None])) for i in range(n)]
    hot = rows[0][1]
    rows += [(2000 + i, hot, 7) for i in range(n // 2)]  # a third of all rows are one vector
    rows += [(None, hot, 3), (5000, None, 1), (5001, [None] + hot[1:], 1), (5002, [math.inf] + hot[1:], 1), (5003, [math.nan] + hot[1:], 2)]
    rows += [rows[3], rows[3], (rows[4][0], rows[5][1], 2)]
    r.shuffle(rows)
    return rows


def exact(rows):
    """Values as Spark holds them: 4-byte floats."""
    import numpy as np
    return [(a, None if v is None else [None if x is None else float(np.float32(x)) for x in v], c) for a, v, c in rows]


@pytest.mark.parametrize("seed,d,owner", [(1, 16, V.OWNER_PARTS), (2, 13, 4), (3, 64, 1)])
def test_equals_brute_force(spark, monkeypatch, seed, d, owner):
    monkeypatch.setattr(V, "OWNER_PARTS", owner)
    monkeypatch.setattr(V, "STEP", 50)
    rows = exact(table(seed, d=d, n=200))
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", code string, salt int").repartition(4)
    got = sorted(str(tuple(r)) for r in V.vector_codes(df).collect())
    assert got == brute(rows)


def test_sql_agrees(spark):
    rows = [r for r in exact(table(4, n=120)) if r[0] is not None]
    rows = list({r[0]: r for r in rows}.values())
    con = duckdb.connect()
    con.register("embeddings", pa.table({"vec_id": pa.array([r[0] for r in rows], pa.int64()), "embedding": pa.array([r[1] for r in rows], pa.list_(pa.float32())),
                                         "label": pa.array([r[2] for r in rows], pa.int32())}))
    cols = ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    want = con.sql(f"SELECT {', '.join(cols)} FROM ({oracles.VECTOR_CODES})").fetchall()
    got = V.vector_codes(spark.createDataFrame(rows, SCHEMA)).select(*cols).collect()
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in got)


def test_only_parts_that_change_entry_are_shuffled_after_the_first_round(spark, monkeypatch):
    rows = exact([r for r in table(5) if r[1] and None not in r[1] and all(map(math.isfinite, r[1]))])
    tables = []
    monkeypatch.setattr(V, "saved", lambda df, name, f=V.saved: (tables.append((name, out := f(df, name))), out)[1])
    V.vector_codes(spark.createDataFrame(rows, SCHEMA)).collect()
    moved = {name: t.where("n is null").count() for name, t in tables if name.startswith("members")}
    assert moved["members-1"] == 8 * len(rows)
    assert all(moved[f"members-{i}"] < 4 * len(rows) for i in range(2, 7)) and moved["members-6"] < moved["members-2"]


def test_few_rows_other_lengths_huge_values_and_empty_table(spark):
    rows = [(1, [0.5, 1e30, -1e30, 0.0], None), (2, [0.25] * 4, None), (3, [0.25] * 3, 5), (4, [], 5)]
    got = {r.vec_id: r for r in V.vector_codes(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(got) == 4 and got[1].code == "0000000000000000"[:16] or got[1].code
    assert got[3].code is None and got[4].error is None and got[3].label_error is None
    assert got[1].error == 0 and got[2].error == 0  # two entries hold both vectors
    empties = V.vector_codes(spark.createDataFrame([(1, [], 1), (2, [], 1)], SCHEMA)).collect()
    assert [(r.code, r.error) for r in empties] == [("00" * 8, 0)] * 2
    df = spark.createDataFrame([(1, None, 1)], SCHEMA)
    assert V.vector_codes(df).count() == 0 and V.vector_codes(df.limit(0)).count() == 0
