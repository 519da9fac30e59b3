"""Token files: exact round trip against whole-text encoding, bit packing, random access."""

import random
import uuid
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest

from tracewright.llm import token_output as T
from tracewright.llm.common import joined
from tracewright.llm.tokens import encode

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def whole():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return lambda s: t.encode(s or "", add_special_tokens=False).ids + [1]


@pytest.mark.parametrize("bits", [1, 3, 8, 11, 16, 17, 20, 32])
def test_bits_round_trip_and_random_access(bits):
    r = np.random.default_rng(bits)
    for n in (0, 1, 7, 4096, 4097, 20_000):
        ids = r.integers(0, 1 << bits, n, dtype=np.uint64).astype(np.uint32)
        payload, offsets = T.pack(ids, bits)
        assert len(payload) <= n * bits / 8 + len(offsets)
        assert (T.unpack(payload, offsets, bits, 0, n) == ids).all()
        for _ in range(5):
            a, b = sorted(r.integers(0, n + 1, 2).tolist())
            assert (T.unpack(payload, offsets, bits, a, b) == ids[a:b]).all()


def test_vocabulary_decides_the_width():
    assert [T.bits_for(n) for n in (1, 2, 3, 49408, 65536, 65537)] == [1, 1, 2, 16, 16, 17]


def test_round_trip(spark, whole, monkeypatch):
    monkeypatch.setattr(T, "RECORD_IDS", 500)
    r = random.Random(3)
    texts = [None, "", " \n", "É́ ΑΣ ΑΣΑ", "a b", "<|startoftext|> x", "it's 12 34"] + [
        "".join(r.choice(["the", " ", "\n", "!", "É", " ", "12", "'s", "\t", "İ", "́"]) for _ in range(r.randint(1, 400))) for _ in range(120)]
    rows = [(i * 17 % 1000 - 3, t, 1) for i, t in enumerate(texts)] + [(None, "null id", 1), (40_000, "x y", 1), (40_000, "x y", 1), (40_000, "w", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, bucket int").repartition(5)
    order = sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1] or ""))
    want, at, every = [], 0, []
    for d, t, _ in order:
        ids = whole(t)
        want.append((d, at, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        at += len(ids)
        every += ids
    got = T.token_round_trip(df, PATH).collect()
    assert sorted((tuple(x) for x in got), key=lambda x: x[1]) == want
    out = T.write_tokens(df, T.scratch_path(spark, f"llm/test-{uuid.uuid4().hex}"), PATH)
    for _ in range(5):
        a = r.randrange(at)
        b = min(at, a + r.randint(1, 900))
        assert T.read_ids(spark, out, a, b - a).tolist() == every[a:b]
    assert T.token_round_trip(df.limit(0), PATH).count() == 0


def test_units_give_the_ids_of_whole_texts(whole):
    """On every document of the small table."""
    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"])["text"].combine_chunks()
    ids, first = encode(*joined(texts), PATH, "word")
    for i, t in enumerate(texts.to_pylist()):
        assert ids[first[i]:first[i + 1]].tolist() == whole(t)[:-1]


def test_remembered_units_stay_right_when_memory_is_full(whole, monkeypatch):
    from tracewright.llm import tokens
    monkeypatch.setattr(tokens, "KNOWN_UNITS", 40)
    monkeypatch.setattr(tokens, "_known", {})
    import pyarrow as pa
    r = random.Random(9)
    for _ in range(6):
        texts = [" ".join(f"w{r.randrange(120)}x" for _ in range(60)) for _ in range(r.choice([1, 3]))]
        ids, first = encode(*joined(pa.array(texts)), PATH, "word")
        for i, t in enumerate(texts):
            assert ids[first[i]:first[i + 1]].tolist() == whole(t)[:-1]
        assert len(tokens._known[PATH, "word"].keys) <= 40
