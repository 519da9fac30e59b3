"""MinHash near-dedup against all pairs."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from tracewright.llm.minhash_dedup import GATE, _blocked, estimate, minhash_dedup, minima, pack_low_bits, passes


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                root[find(i)] = find(j)
    order = lambda d: (d is not None, d or 0)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        least[r] = min((least.get(r, d), d), key=order)
    return sorted(((d, len(sets[i]), least[find(i)], d == least[find(i)]) for i, (d, _) in enumerate(rows)), key=str)


def corpus(seed):
    r = random.Random(seed)
    vocab = ["".join(r.choice("abcdefghé") for _ in range(r.randint(1, 8))) for _ in range(400)]
    prose = lambda n: [r.choice(vocab) for _ in range(n)]
    docs = [None, "", " \n\t", "one", "ONE", "one two three", "One Two\nthree", "Éa b c d e", "éa b c d e", " ".join(prose(4000))]
    for _ in range(12):
        base = prose(r.randint(8, 250))
        line = list(base)
        for _ in range(r.randint(1, 14)):
            text = list(base if r.random() < 0.5 else line)
            for _ in range(r.randint(0, max(1, len(text) // 40))):
                text[r.randrange(len(text))] = r.choice(vocab)
            line = text
            docs.append(" ".join(w.upper() if r.random() < 0.1 and w.isascii() else w for w in text))
    docs += [" ".join(prose(r.randint(1, 90))) for _ in range(40)]
    return docs


@pytest.mark.parametrize("seed,block,chunk", [(1, 4096, 20000), (2, 3, 7), (3, 16, 40)])
def test_equals_all_pairs(spark, seed, block, chunk):
    docs = corpus(seed)
    rows = list(enumerate(docs)) + [(10_000 + i, d) for i, d in enumerate(docs[::5])]
    random.Random(seed).shuffle(rows)
    df = spark.createDataFrame([(i, t, "x", b"y") for i, t in rows], "doc_id long, text string, k string, s binary").repartition(4)
    got = sorted((tuple(r) for r in minhash_dedup(df, block=block, chunk_nodes=chunk).collect()), key=str)
    assert got == brute(rows)


def test_null_id_repeated_rows_and_empty_table(spark):
    t = "a b c d e f g h"
    rows = [(5, t), (5, t), (None, t), (6, "z y x w v u t"), (7, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in minhash_dedup(df).collect()), key=str)
    assert got == sorted([(5, 4, None, False), (5, 4, None, False), (None, 4, None, True), (6, 3, 6, True), (7, 0, 7, True)], key=str)
    assert minhash_dedup(df.limit(0)).count() == 0


def test_packed_estimate_is_corrected_for_chance():
    rng = np.random.default_rng(3)
    common, a, b = (rng.integers(0, 2**63, n, dtype=np.uint64) for n in (6000, 2000, 2000))
    sets = [np.concatenate((common, a)), np.concatenate((common, b)), rng.integers(0, 2**63, 8000, dtype=np.uint64)]
    m = pack_low_bits(minima(np.concatenate(sets), np.array([0, 8000, 16000])))
    assert abs(estimate(m[0], m[1]) - 0.6) < 0.15
    assert abs(estimate(m[0], m[2])) < 0.15
    assert estimate(m[0], m[0]) == 1


def test_both_sides_of_an_unsettled_key_are_cut(spark):
    """No group grows with its key, texts stay out of the groups, and every two blocks meet once."""
    n, core = 600, 200
    name = lambda i: i.to_bytes(16, "big")
    rows = [(7, name(i), name(0 if i < core else i), 40, b"", b"", -(-n // 50), -(-(n - core) // 50), name(0)) for i in range(n)]
    opened = spark.createDataFrame(rows, "key long, s binary, root binary, n long, bits binary, bands binary, blocks int, outer_blocks int, main binary")
    got = _blocked(opened)
    assert "text" not in got.columns
    sides = {}
    for r in got.collect():
        sides.setdefault((r.outer, r.inner), ([], []))[r.outside].append(bytes(r.s))
    assert len(sides) == 12 * 8 and max(len(x) for g in sides.values() for x in g) < 100
    met = Counter((a, b) for inner, outer in sides.values() for a in outer for b in inner)
    assert len(met) == n * (n - core) and set(met.values()) == {1}


def test_alike_below_the_threshold_and_links_between_blocks(spark):
    """Pages of one template that share keys without being near, and a few that are near."""
    r = random.Random(11)
    words = lambda n: [f"w{r.randrange(10**6)}" for _ in range(n)]
    template = words(66)
    rows = [(i, " ".join(template + words(34))) for i in range(150)]
    rows += [(1000 + i, " ".join(t.split()[:-r.randint(1, 12)] + words(2))) for i, (_, t) in enumerate(rows[::6])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted((tuple(x) for x in minhash_dedup(df, block=16, chunk_nodes=10).collect()), key=str)
    assert got == brute(rows)


def test_stored_bits_of_different_functions_are_independent():
    """3 common of 4 shingles: the estimate scatters as 200 independent trials do, and none falls below the gate."""
    rng = np.random.default_rng(5)
    h = rng.integers(0, 2**64, (40_000, 4), dtype=np.uint64)
    a, b = (pack_low_bits(minima(np.ascontiguousarray(x).ravel(), np.arange(len(h)) * x.shape[1])) for x in (h, h[:, :3]))
    like = estimate(a, b)
    assert abs(like.mean() - 0.75) < 0.01 and like.std() < 0.045 and like.min() >= GATE


def test_small_sets_pass_whatever_their_estimate():
    far = np.zeros((1, 50), dtype=np.uint8), np.full((1, 50), 255, dtype=np.uint8)
    ask = lambda m, n: bool(passes(*far, np.array([m]), np.array([n]))[0])
    assert ask(3, 4) and ask(40, 31) and not ask(32, 32) and not ask(2, 4)


def test_eight_words_and_the_same_less_one(spark):
    r = random.Random(4)
    rows = []
    for i in range(4000):
        words = [f"{r.randrange(10**9):x}" for _ in range(8)]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(words[1:] if r.random() < 0.5 else words[:-1]))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert {(x.doc_id, x.component_id) for x in minhash_dedup(df).collect()} == {(i, i // 2 * 2) for i in range(8000)}


def test_sets_of_a_group_take_a_few_bytes_a_byte_of_text():
    """A group's texts come at once; what their sets take beside must not be a multiple as by prefix hashes of all (35)."""
    import tracemalloc

    import pyarrow as pa

    from tracewright.llm.common import joined
    from tracewright.llm.minhash_dedup import SET_BYTES, shingle_sets
    r = np.random.default_rng(6)
    texts = [" ".join(f"W{x}" for x in r.integers(0, 50_000, 500)) for _ in range(1_000)] + ["", " ", "a b", "x" * (SET_BYTES + 9), "a B", "A b c d e f"]
    buf, start, end = joined(pa.array(texts))
    tracemalloc.start()
    d, h = shingle_sets(buf, start, end)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 15 * len(buf)
    assert (np.diff(d) >= 0).all()
    for i in (0, 1, 500, 999, *range(1000, 1006)):  # the same set wherever a text stands
        _, alone = shingle_sets(*joined(pa.array([texts[i]])))
        assert h[d == i].tolist() == alone.tolist()
    assert h[d == 1002].tolist() == h[d == 1004].tolist() and not (d == 1000).any()
