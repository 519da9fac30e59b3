"""Minimax sharding: cuts against dynamic programming, the query's laws on a skewed table."""

import random
import zlib
from collections import defaultdict

import numpy as np

from tracewright.llm.sharding import minimax_cuts, minimax_shards, smallest_capacity


def best(sizes, shards):
    """Smallest possible largest sum over contiguous partitions."""
    inf = float("inf")
    cost = [0] + [inf] * len(sizes)
    for _ in range(shards):
        new = [0] + [inf] * len(sizes)
        for i in range(1, len(sizes) + 1):
            run = 0
            for j in range(i, 0, -1):
                run += sizes[j - 1]
                new[i] = min(new[i], max(cost[j - 1], run))
        cost = new
    return cost[-1]


def test_capacity_is_the_smallest_and_cuts_keep_it():
    r = random.Random(4)
    for _ in range(60):
        sizes = [r.choice([0, r.randint(0, 9), r.randint(0, 200)]) for _ in range(r.randint(1, 40))]
        shards = r.randint(1, 9)
        c = smallest_capacity(np.array(sizes), shards)
        assert c == best(sizes, shards)
        ends = minimax_cuts(np.array(sizes), shards)
        assert ends[-1] == len(sizes) and (np.diff(ends) >= 0).all()
        assert max(sum(sizes[a:b]) for a, b in zip([0, *ends], ends)) <= c


def test_groups_stay_whole_slots_are_gapless_and_sizes_near(spark):
    r = random.Random(1)
    texts = [None, "", "é" * 50] + ["word " * r.randint(1, 400) + str(i) for i in range(6000)] + ["hot text"] * 3000
    rows = [(i if i % 500 else None, t, "x", 3) for i, t in enumerate(texts)] + [(7, texts[7], "x", 3)] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string, shard string, size int").repartition(6)
    got = minimax_shards(df).collect()
    assert len(got) == len(rows)
    want = sorted((i is None, i or 0, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, _, _ in rows)
    assert sorted((x.doc_id is None, x.doc_id or 0, x["size"], x.text_crc32) for x in got) == want
    slots, total, shard_of = defaultdict(list), defaultdict(int), defaultdict(set)
    for x in got:
        slots[x.shard].append(x.slot)
        total[x.shard] += x["size"]
        shard_of[x["size"], x.text_crc32].add(x.shard)
        assert x.law == "bytes" and x.grown_shard is None
    assert sorted(slots) == list(range(40)) and all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert all(len(v) == 1 for v in shard_of.values())
    mean = sum(total.values()) / 40
    assert max(total.values()) < 1.1 * mean and min(total.values()) > 0.8 * mean
    assert {(x.doc_id, x.shard, x.slot) for x in got if x.doc_id} == {(x.doc_id, x.shard, x.slot) for x in minimax_shards(df.repartition(3)).collect() if x.doc_id}


def test_empty_table_and_few_groups(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    assert minimax_shards(df.limit(0)).count() == 0
    got = minimax_shards(df).collect()
    assert len(got) == 2 and all(0 <= x.shard < 40 and x.slot == 0 for x in got)
