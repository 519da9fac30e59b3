"""Substring dedup against brute force."""

import hashlib
import random
import re

import pytest

from tracewright.llm import substring_dedup as S


def brute(rows):
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, hashlib.md5((rows[i][1] or "").encode()).digest()))
    seen, out, done = set(), {}, {}
    for i in order:
        if rows[i] in done:
            out[i] = done[rows[i]]
            continue
        w = re.findall(r"[^\x20\x09-\x0D]+", rows[i][1] or "")
        gone = [False] * len(w)
        for j in range(len(w) - 19):
            g = tuple(w[j:j + 20])
            if g in seen:
                gone[j:j + 20] = [True] * 20
            seen.add(g)
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out[i] = done[rows[i]] = (rows[i][0], len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return sorted((out[i] for i in range(len(rows))), key=str)


def corpus(seed):
    r = random.Random(seed)
    vocab = ["".join(r.choice("abcdefgé") for _ in range(r.randint(1, 7))) for _ in range(300)]
    prose = lambda n: [r.choice(vocab) for _ in range(n)]
    passages = [prose(r.randint(19, 45)) for _ in range(5)]
    base = prose(300)
    docs = [None, "", " \t\n", " ".join(["la"] * 130), " ".join(["a", "b", "c"] * 60), " ".join(base), " ".join(base), "\n".join(base), " ".join(prose(20000))]
    for _ in range(60):
        w = prose(r.randint(0, 70))
        for _ in range(r.randint(0, 2)):
            w += r.choice(passages) + prose(r.randint(0, 30))
        if r.random() < 0.3:
            a = r.randrange(len(base))
            w += base[a:a + r.randint(5, 150)]
        if r.random() < 0.2:
            w += w[:r.randint(1, 60)]
        docs.append(" ".join(w))
    return docs


@pytest.mark.parametrize("seed,chunk", [(1, 1 << 22), (2, 600), (3, 5000)])
def test_equals_brute_force(spark, monkeypatch, seed, chunk):
    monkeypatch.setattr(S, "CHUNK", chunk)
    docs = corpus(seed)
    rows = [(i * 7 % 1000, t) for i, t in enumerate(docs)] + [(5000 + i, t) for i, t in enumerate(docs[::4])]
    random.Random(seed).shuffle(rows)
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, k string, ord int").repartition(4)
    got = sorted((tuple(r) for r in S.substring_dedup(df).drop("spans").collect()), key=str)
    assert got == brute(rows)


def test_null_and_repeated_ids_repeated_rows_and_empty_table(spark):
    t, u = " ".join(map(str, range(40))), " ".join(map(str, range(10, 60)))
    rows = [(None, u), (3, t), (3, t), (3, u), (4, t), (5, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in S.substring_dedup(df).drop("spans").collect()), key=str)
    assert got == brute(rows)
    assert S.substring_dedup(df.limit(0)).count() == 0


@pytest.mark.parametrize("width", [3, 4, 6])
def test_granules_survive_the_byte_codes(width):
    import numpy as np
    codes = np.array([5, 9, (1 << 8 * width) - 1, 8, 11], dtype=np.uint64)  # 9 and 8 share a sequence, 9 is a block
    assert S._bytes_to_codes(S._codes_to_bytes(codes, width), width).tolist() == codes.tolist()
    gaps = bytes([1, 0, 255, 4, 3])
    live = S.live_granules([S._codes_to_bytes(codes, width)], [gaps], width)
    assert [x.tolist() for x in live] == [[1, 260]]


def test_hashing_words_takes_a_few_bytes_a_byte_of_text():
    """Prefix hashes of a whole chunk would take some 35."""
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    from tracewright.llm.common import HASH_BYTES, joined
    r = np.random.default_rng(5)
    texts = [" ".join(f"w{x}" for x in r.integers(0, 50_000, 500)) for _ in range(1_000)] + ["", "  ", "x" * (HASH_BYTES + 9), "one"]
    buf, start, end = joined(pa.array(texts))
    tracemalloc.start()
    h, first = S._words(buf, start, end)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 15 * len(buf)
    for i in (0, 1, 500, 999, 1000, 1001, 1002, 1003):  # the same hashes wherever a text stands
        alone, _ = S._words(*joined(pa.array([texts[i]])))
        assert h[first[i]:first[i + 1]].tolist() == alone.tolist()
