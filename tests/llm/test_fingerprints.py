"""Fingerprints against plain Python sets of paragraphs."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from tracewright.llm import fingerprints as P


def paragraphs(text):
    return Counter(x for x in re.split(r"\n|(?<=[.!?]) ", text) if x)


def like(a, b):
    a, b = paragraphs(a), paragraphs(b)
    return 1.0 if not a and not b else sum((a & b).values()) / sum((a | b).values())


def brute(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, hashlib.md5((r[1] or "").encode()).digest()), reverse=True)
    out = []
    for i, (d, t) in enumerate(order):
        t, nxt = t or "", order[(i + 1) % len(order)][1] or ""
        e = t[:len(t) - len(t) // 2] + nxt[:len(t) // 2]
        out.append((d, len(t), hashlib.sha256(e.encode()).hexdigest(), round(like(t, e), 9), round(like(t, nxt), 9)))
    return sorted(out, key=str)


def corpus(seed, n=150):
    r = random.Random(seed)
    line = lambda: "".join(r.choice("abc é\U0001F600") for _ in range(r.randint(1, 20))) + r.choice([".", "!", "?", "\n", ". ", "\n\n", ""])
    stock = [line() for _ in range(30)]
    out = [None, "", "\n", ". . .", "one line", "é" * 5001, "".join(line() for _ in range(4000))]
    for _ in range(n):
        out.append("".join(r.choice(stock) if r.random() < 0.5 else line() for _ in range(r.randint(0, 60))))
        if r.random() < 0.3:
            out.append(out[-1] + r.choice(["", line()]))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = [(i * 37 % 1000, t) for i, t in enumerate(corpus(seed))]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, k string, ord int").repartition(5)
    got = P.document_fingerprints(df).collect()
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in got), key=str) == brute(rows)
    by_text = {}
    texts = dict(rows)
    for r in got:
        assert by_text.setdefault(texts[r.doc_id] or "", r.fingerprint) == r.fingerprint
    assert len(set(by_text.values())) >= len({frozenset(paragraphs(t).items()) for t in by_text})


def test_null_and_repeated_ids_repeated_rows_and_empty_table(spark):
    rows = [(None, "a.\nb."), (3, "a.\nc."), (3, "x"), (3, "x"), (9, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = P.document_fingerprints(df).collect()
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in got), key=str) == brute(rows)
    assert [(r.doc_id, r.near_next) for r in P.document_fingerprints(df.where("doc_id = 9")).collect()] == [(9, 1.0)]
    assert P.document_fingerprints(df.limit(0)).count() == 0


def test_peeling_recovers_the_difference_and_grows_on_failure():
    shared = [f"line {i}." for i in range(300)]
    a = P.Paragraphs(["\n".join(shared + [f"old {i}." for i in range(40)]).encode()])
    b = P.Paragraphs(["\n".join([f"new {i}." for i in range(25)] + shared).encode()])
    zero = np.array([0])
    _, _, _, done = a.base.minus(b.base, zero, zero).peel()
    assert not done[0]                                        # 65 paragraphs do not fit 18 cells
    assert P.difference_sizes(a, zero, b, zero).tolist() == [65]
    diff = P.Sketches(1, 288, 2).add(a.doc, a.digest).add(b.doc, b.digest, -1)
    _, digest, sign, done = diff.peel()
    assert done[0]
    assert set(digest[sign == 1].tolist()) == set(a.digest.tolist()) - set(b.digest.tolist())
    assert set(digest[sign == -1].tolist()) == set(b.digest.tolist()) - set(a.digest.tolist())
