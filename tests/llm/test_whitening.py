"""Whitening against exact rational covariances and numpy."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from tracewright.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>"


def f32(rows):
    return [(a, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for a, v in rows]


def brute(rows):
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    x = [tuple(math.floor(64 * c) + 1000000 for c in r[1]) for r in kept]
    fit = sorted(set(x))
    n, d = len(fit), len(fit[0])
    s = [sum(c) for c in zip(*fit)]
    centred = [[Fraction(n * v - t, n) for v, t in zip(f, s)] for f in fit]
    cov = np.array([[float(sum(c[i] * c[j] for c in centred) / n) for j in range(d)] for i in range(d)])
    value, vector = np.linalg.eigh(cov)
    value, vector = value[::-1], vector[:, ::-1]
    out = {}
    for (ident, _), f in zip(kept, x):
        y = np.array([float(Fraction(n * v - t, n)) for v, t in zip(f, s)])
        out.setdefault(ident, []).append((sum((n * v - t) ** 2 for v, t in zip(f, s)), y @ vector / np.sqrt(np.maximum(value, 1e-300))))
    return n, value, out


def vectors(seed, n, d):
    r = random.Random(seed)
    mix = [[r.gauss(0, 1 / (1 + j)) for j in range(d)] for _ in range(d)]
    rows = []
    for i in range(n):
        z = [r.gauss(0, 1) for _ in range(d)]
        rows.append((i, [sum(a * b for a, b in zip(z, m)) for m in mix]))
    hot = rows[0][1]
    rows += [(1000 + i, hot) for i in range(n // 2)]  # a third of all rows are one vector
    return f32(rows + [(None, hot), (7000, None), (7001, [None] + hot[1:]), (7002, [math.nan] + hot[1:]), (7003, [math.inf] + hot[1:]), rows[2], rows[2]])


@pytest.mark.parametrize("seed,n,d,step", [(1, 120, 20, 1 << 12), (2, 90, 5, 7), (3, 60, 1, 16)])
def test_equals_exact_covariances(spark, monkeypatch, seed, n, d, step):
    monkeypatch.setattr(W, "STEP", step)
    rows = vectors(seed, n, d)
    random.Random(seed).shuffle(rows)
    df = spark.createDataFrame([(*r, 5) for r in rows], SCHEMA + ", component int").repartition(3)
    got = W.whiten(df).collect()
    size, value, want = brute(rows)
    k = min(16, d)
    assert len(got) == k * sum(map(len, want.values()))
    assert {r.n for r in got} == {size} and len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-6
    trace = value.sum()
    sign = {}
    for r in got:
        deviation, w = want[r.vec_id][0]
        assert r.deviation == deviation
        assert r.explained == pytest.approx(value[r.component - 1] / trace, rel=1e-9)
        e = w[r.component - 1]
        if abs(e) > 1e-6:
            sign.setdefault(r.component, math.copysign(1, e * r.whitened))
        assert sign.get(r.component, 1) * r.whitened == pytest.approx(e, abs=1e-6)


def test_covariances_by_polarisation_are_exact():
    r = random.Random(4)
    rows = [[r.randint(-500, 500) for _ in range(6)] for _ in range(40)]
    n, t = len(rows), [sum(c) for c in zip(*rows)]
    squares = {(i, j): sum((x[i] + x[j] * (i != j)) ** 2 for x in rows) for i in range(6) for j in range(i, 6)}
    exact = [[float(sum(Fraction(n * x[i] - t[i], n) * Fraction(n * x[j] - t[j], n) for x in rows) / n) for j in range(6)] for i in range(6)]
    assert W.covariance(n, t, squares).tolist() == exact


def test_flat_directions_other_lengths_huge_values_and_empty_tables(spark):
    one = W.whiten(spark.createDataFrame([(1, [0.5, 0.25]), (2, [0.5, 0.25])], SCHEMA)).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(1, 0, None, None, None)] * 4
    line = W.whiten(spark.createDataFrame([(i, [float(i), 2.0 * i]) for i in range(9)] + [(9, [1.0])], SCHEMA)).collect()
    by = {(r.vec_id, r.component): r for r in line}
    assert by[0, 2].whitened is None and by[0, 2].explained == pytest.approx(0, abs=1e-9) and by[9, 1].whitened is None and by[9, 1].deviation is None
    assert by[8, 1].identity_error < 1e-6 and abs(by[8, 1].whitened) == pytest.approx(4 / math.sqrt(60 / 9))
    huge = W.whiten(spark.createDataFrame([(1, [3e38, 0.0]), (2, [-3e38, 1.0]), (3, [0.0, 5.0])], SCHEMA)).collect()
    assert len(huge) == 6 and all(r.identity_error < 1e-4 for r in huge)
    df = spark.createDataFrame([(1, None), (2, [])], SCHEMA)
    assert W.whiten(df).count() == 0 and W.whiten(df.limit(0)).count() == 0
    assert W.whiten(df).columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
