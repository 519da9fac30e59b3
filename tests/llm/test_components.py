"""Components against union-find."""

import random

import pytest

from tracewright.llm.components import components


@pytest.mark.parametrize("shape", ["chain", "star", "random", "none"])
def test_equals_union_find(spark, shape):
    r = random.Random(7)
    names = [bytes([i // 256, i % 256]) * 8 for i in range(400)]
    r.shuffle(names)
    pairs = {"chain": [(i, i + 1) for i in range(60)], "star": [(0, i) for i in range(1, 200)],
             "random": [(r.randrange(400), r.randrange(400)) for _ in range(250)], "none": [(3, 3)]}[shape]
    root = list(range(400))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in pairs:
        root[find(a)] = find(b)
    linked = {i for a, b in pairs if a != b for i in (a, b)}
    least = {}
    for i in linked:
        least[find(i)] = min(least.get(find(i), names[i]), names[i])
    got = components(spark.createDataFrame([(names[a], names[b]) for a, b in pairs], "a binary, b binary")).collect()
    assert sorted((bytes(x.s), bytes(x.root)) for x in got) == sorted((names[i], least[find(i)]) for i in linked)
