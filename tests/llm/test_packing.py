"""Packing: counts against brute force, pieces against whole-text encoding."""

import random
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import public_tokenizers
import pytest

from tracewright.llm.packing import best_fit, complete, lower_bound, pack_counts, pack_documents, sequences

PATH = public_tokenizers.path("byte_bpe_50k.json")


def check(patterns, counts, capacity):
    held = Counter()
    for times, pattern in patterns:
        assert times > 0 and sum(a * b for a, b in pattern) <= capacity
        for a, b in pattern:
            held[a] += times * b
    assert held == Counter(counts)
    return sum(t for t, _ in patterns)


def fewest(items, capacity):
    @lru_cache(None)
    def go(rest):
        if not rest:
            return 0
        first, others = rest[0], rest[1:]
        out = len(rest)
        for mask in range(1 << len(others)):
            pick = [x for i, x in enumerate(others) if mask >> i & 1]
            if first + sum(pick) <= capacity:
                out = min(out, 1 + go(tuple(x for i, x in enumerate(others) if not mask >> i & 1)))
        return out
    return go(tuple(sorted(items, reverse=True)))


def test_small_packings_are_optimal():
    r = random.Random(2)
    for _ in range(150):
        items = [r.randint(1, 20) for _ in range(r.randint(0, 8))]
        assert check(pack_counts(Counter(items), 20), Counter(items), 20) == fewest(items, 20)


def test_completion_beats_best_fit_where_that_fails():
    counts = Counter([6, 6, 6, 5, 5, 5, 4, 4, 4, 3, 3, 3, 2, 2, 2] * 2 + [7, 7, 3, 3])
    n = check(best_fit(counts, 20), counts, 20)
    assert check(pack_counts(counts, 20), counts, 20) <= n
    hard = Counter({44: 2, 24: 2, 22: 2, 21: 2, 17: 2, 8: 4, 6: 4})   # two bins of 61+... need the right partners
    least = lower_bound(hard, 100)
    assert check(pack_counts(hard, 100), hard, 100) == least
    better = complete(Counter({5: 2, 4: 2, 3: 2, 2: 2}), 14, 3, 1000)
    assert better is not None and check(better, Counter({5: 2, 4: 2, 3: 2, 2: 2}), 14) == 2


def test_large_counts_stay_near_the_bound():
    r = np.random.default_rng(1)
    counts = Counter(np.clip(r.lognormal(6, 1, 200_000), 1, 2048).astype(int).tolist())
    n = check(pack_counts(counts), counts, 2048)
    assert n <= lower_bound(counts, 2048) * 1.001 + 1


@pytest.fixture(scope="module")
def whole():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return lambda s: t.encode(s or "", add_special_tokens=False).ids + [0]


def test_pieces_and_places(spark, whole):
    r = random.Random(3)
    odd = ["a  b\n\n c\t d", " lead", "tail ", "x y   z", "it's we'll  'tis", "<|endoftext|> y", "日本 語　文", "\r\n\r\n a", "é è\n\né ", "  a", "a  b"]
    texts = [None, "", " ", "\n"] + odd + ["".join(r.choice(["the", " ", "\n", "!", "é", " ", "12", "'s", "\t"]) for _ in range(r.randint(1, 300))) for _ in range(150)]
    texts += [" ".join(["word"] * 2047), " ".join(["word"] * 2048), " ".join(["w%d" % i for i in range(9000)])]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(None, "null id", "x"), (5, texts[5], "x"), (5, texts[5], "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, piece string").repartition(4)
    got = pack_documents(df, PATH, with_ids=True).collect()
    assert [f.name for f in pack_documents(df.limit(0), PATH).schema] == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    bins, docs = defaultdict(list), defaultdict(list)
    for x in got:
        assert len(x.ids) == 4 * x.length and zlib.crc32(bytes(x.ids)) == x.ids_crc32 and 1 <= x.length <= 2048
        bins[x.sequence_id].append((x.offset, x.length))
        docs[x.doc_id].append((x.piece, x.start, bytes(x.ids)))
    for v in bins.values():
        at = 0
        for offset, length in sorted(v):
            assert offset == at
            at += length
        assert at <= 2048
    copies = Counter(d for d, _, _ in rows)
    for d, t, _ in rows:
        ids = np.array(whole(t), dtype="<u4")
        head = (len(ids) - 1) % 2048 + 1
        cuts = [0, *range(head, len(ids), 2048), len(ids)]
        want = [(j, a, ids[a:b].tobytes()) for j, (a, b) in enumerate(zip(cuts, cuts[1:]))]
        assert sorted(docs[d]) == sorted(want * copies[d]), t
    total = sum(x.length for x in got)
    assert len(bins) <= -(-total // 2048) + 1
    seq = sequences(pack_documents(df, PATH, with_ids=True)).collect()
    assert sum(s.length for s in seq) == total and all(len(s.ids) == 4 * s.length for s in seq)
    assert pack_documents(df.limit(0), PATH).count() == 0


def test_units_give_the_ids_of_whole_texts(whole):
    """On every document of the small table."""
    import pyarrow.parquet as pq

    from tracewright.llm.common import joined
    from tracewright.llm.tokens import encode
    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"])["text"].combine_chunks()
    ids, first = encode(*joined(texts), PATH, "byte")
    for i, t in enumerate(texts.to_pylist()):
        assert ids[first[i]:first[i + 1]].tolist() == whole(t)[:-1]


def test_the_search_is_the_same_for_any_number_of_pieces():
    """Sequences cut in three at random: full ones exist, for a few pieces as for thousands."""
    for n in (20, 140, 1000, 4000):
        r = random.Random(n)
        counts = Counter()
        for _ in range(n):
            a, b = sorted(r.sample(range(1, 2048), 2))
            counts.update((a, b - a, 2048 - b))
        assert check(best_fit(counts, 2048), counts, 2048) == n + 1
        assert check(pack_counts(counts), counts, 2048) == n


def test_long_fillings_do_not_recurse():
    counts = {1: 5000, 2040: 3}
    assert check(complete(counts, 2048, 7, 100), counts, 2048) == 6
