"""Suffix-array dedup against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tracewright.llm import suffix_dedup as module
from tracewright.llm.suffix_dedup import anchors_of, common_prefixes, solve_shard, suffix_array, suffix_dedup


def brute(texts, width):
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[i:i + width] for b in data for i in range(len(b) - width + 1))
    out = []
    for b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - width + 1):
            if seen[b[i:i + width]] > 1:
                gone[i:i + width] = b"\1" * width
        spans = len([x for x in bytes(gone).split(b"\0") if x])
        out.append((len(b), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(b, gone) if not g)).hexdigest()))
    return out


def corpus(seed, n=60):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdeé ñ") for _ in range(r.randint(1, 9)))
    prose = lambda k: " ".join(word() for _ in range(k))
    passages = [prose(30) for _ in range(4)]
    base = prose(200)
    out = [None, "", "x", "ab" * 700, "a" * 900, base, base, base + "!", prose(3000)]
    for _ in range(n):
        parts = [prose(r.randint(0, 60))]
        if r.random() < 0.6:
            parts.append(r.choice(passages))
        if r.random() < 0.4:
            cut = r.randint(0, len(base))
            parts.append(base[:cut] + word() + base[cut:])
        parts.append(prose(r.randint(0, 30)))
        out.append(" ".join(parts))
    return out


def test_suffix_array_and_prefixes_are_those_of_a_plain_sort():
    r = random.Random(5)
    words = ["".join(r.choice("ab") for _ in range(r.randint(1, 40))).encode() for _ in range(60)] + [b"\0\0\0", b"\0", b"abab" * 9, b"abab" * 9]
    text = np.frombuffer(b"".join(words), dtype=np.uint8)
    start = np.cumsum([0] + [len(w) for w in words])[:-1]
    left = np.concatenate([np.arange(len(w), 0, -1) for w in words])
    sa = suffix_array(text, left)
    raw = text.tobytes()
    suffix = lambda i: raw[i:i + left[i]]
    assert sa.tolist() == sorted(range(len(raw)), key=lambda i: (suffix(i), i))
    lcp = common_prefixes(text, start, left, sa, 30)
    for j in range(1, len(sa)):
        a, b = suffix(sa[j - 1]), suffix(sa[j])
        n = next((k for k in range(min(len(a), len(b))) if a[k] != b[k]), min(len(a), len(b)))
        assert lcp[j] == min(n, 30)


@pytest.mark.parametrize("seed,size", [(1, 2_000), (2, 20_000)])
def test_orders_of_long_and_periodic_strings(seed, size):
    """Texts on both sides of the 65,536 bytes up to which three ranks are packed; 1 to 200 different bytes."""
    r = random.Random(seed)
    words = [bytes(r.choices(range(k), k=r.randint(1, 400))) * r.randint(1, 3) for k in (1, 2, 30, 200) for _ in range(12)]
    words += [b"ab" * size, b"ab" * (size // 2) + b"c", words[20], words[30] + b"x"]
    text = np.frombuffer(b"".join(words), dtype=np.uint8)
    start = np.cumsum([0] + [len(w) for w in words])[:-1]
    left = np.concatenate([np.arange(len(w), 0, -1) for w in words])
    assert (len(text) > 1 << 16) == (size == 20_000)
    sa = suffix_array(text, left)
    assert sorted(sa.tolist()) == list(range(len(text)))
    raw = text.tobytes()
    same, end = [], left.tolist()
    for a, b in zip(sa.tolist(), sa[1:].tolist()):
        x, y = raw[a:a + end[a]], raw[b:b + end[b]]
        assert (x, a) < (y, b)
        x, y = x[:400], y[:400]
        same.append(next((k for k in range(min(len(x), len(y))) if x[k] != y[k]), min(len(x), len(y))) if x != y else len(x))
    assert common_prefixes(text, start, left, sa, 400).tolist()[1:] == same


def test_hashes_of_a_shard_are_sorted_apart(monkeypatch):
    """Work of a shard: no more than some 65,536 bytes are sorted together unless one hash has more, and
    neighbours that move along together are not compared again."""
    r = random.Random(8)
    prose = lambda n: bytes(r.choices(b"abcdefgh ", k=n))
    rows = []
    for h in range(300):
        common = prose(700)
        n = 200 if h == 7 else r.randint(1, 4)
        for i in range(n):
            data = prose(r.randint(0, 90)) + common[r.randint(0, 300):r.randint(400, 700)] + prose(400)
            rows.append((h, 0, 1, h.to_bytes(8, "big") + i.to_bytes(8, "big"), 1, data))
    sizes = []
    monkeypatch.setattr(module, "suffix_array", lambda text, left: sizes.append(len(text)) or suffix_array(text, left))
    got = {x["w"]: list(zip(x["lo"], x["hi"])) for x in solve_shard(rows, 400)}
    largest = sum(len(x[5]) for x in rows if x[0] == 7)
    assert sum(sizes) == sum(len(x[5]) for x in rows) and largest > 1 << 16
    assert sorted(sizes)[-1] <= largest and sorted(sizes)[-2] < 1 << 16
    seen = Counter((x[0], x[5][i:i + 400]) for x in rows for i in range(len(x[5]) - 399))
    for h, _, _, w, _, data in rows:
        want = [i for i in range(len(data) - 399) if seen[h, data[i:i + 400]] > 1]
        assert [i for a, b in got.get(w, []) for i in range(a, b)] == want


def test_anchors_do_not_depend_on_the_bytes_hashed_at_once(monkeypatch):
    r = random.Random(4)
    texts = [(t or "").encode() for t in corpus(4, 20)] + [b"ab" * r.randint(1, 900) for _ in range(5)]
    end = np.cumsum([len(t) for t in texts])
    start = end - [len(t) for t in texts]
    buf = np.frombuffer(b"".join(texts), dtype=np.uint8)
    want = anchors_of(buf, start, end, 400)
    monkeypatch.setattr(module, "BLOCK", 333)
    for a, b in zip(want, anchors_of(buf, start, end, 400)):
        assert a.tolist() == b.tolist()
    for h, lo, hi, several in list(zip(*(x.tolist() for x in want)))[-150:]:
        assert hi > lo and any(s <= lo and hi - 1 + 400 <= e for s, e in zip(start, end))
        grams = [buf[i:i + module.GRAM] for i in range(lo, hi + 400 - module.GRAM)]
        hashes = [int(module._gram_hash(g)[0]) >> module.POSITION_BITS for g in grams]
        first = {min(range(x, x + 401 - module.GRAM), key=lambda i: (hashes[i], i)) for x in range(hi - lo)}
        assert {hashes[i] for i in first} == {h} and several == (len(first) > 1)


@pytest.mark.parametrize("seed,windows,size", [(1, 1500, 1 << 21), (2, 4, 1 << 12), (3, 2, 1 << 21)])
def test_equals_brute_force(spark, seed, windows, size):
    texts = corpus(seed)
    rows = [(i, t, "clash", i) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, k string, copies int").repartition(5)
    got = {r.doc_id: (r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256)
           for r in suffix_dedup(df, shard_windows=windows, shard_bytes=size).collect()}
    want = brute(texts, 400)
    assert len(got) == len(texts)
    for i, w in enumerate(want):
        assert got[i] == w, (i, got[i], w)


def test_null_ids_repeated_rows_and_empty_table(spark):
    t = "".join(chr(97 + i * i % 26) for i in range(500))
    df = spark.createDataFrame([(None, t), (7, t), (7, t), (7, "other"), (None, None)], "doc_id long, text string")
    got = sorted((r.doc_id is None, r.doc_id, r.n_bytes, r.n_removed) for r in suffix_dedup(df).collect() if r.doc_id)
    assert got == [(False, 7, 5, 0), (False, 7, 500, 500), (False, 7, 500, 500)]
    assert suffix_dedup(df.limit(0)).count() == 0
