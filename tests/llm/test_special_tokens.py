"""Special tokens' strings in texts: the registered queries agree with an unmodified Tokenizer."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tracewright.llm.common import joined
from tracewright.llm.queries import op5_bin_completion_packing, op9_token_output
from tracewright.llm.tokens import encode

ODD = ["see <|endoftext|> here", "<|endoftext|>", "a  <|endoftext|>  b", "\n\n <|endoftext|><|startoftext|>\n x", "<|ENDOFTEXT|> y",
       "<|endoftext", " |> <|endoftext|>x", "é <|startoftext|>é", "plain", "", "tail \n "]


def texts(seed):
    r = random.Random(seed)
    parts = ["<|endoftext|>", "<|startoftext|>", "<|", "|>", " ", " ", "\n", "\t", "the", "é", "12", "!", "'s", "日"]
    return ODD + ["".join(r.choice(parts) for _ in range(r.randint(1, 60))) for _ in range(400)]


@pytest.mark.parametrize("name,cuts", [("byte_bpe_50k.json", "byte"), ("word_bpe_49k.json", "word"), ("byte_bpe_50k.json", None)])
def test_units_give_the_ids_of_the_library(name, cuts):
    path = public_tokenizers.path(name)
    whole, some = Tokenizer.from_file(path), texts(6)
    ids, first = encode(*joined(pa.array(some)), path, cuts, special=True)
    for i, t in enumerate(some):
        assert ids[first[i]:first[i + 1]].tolist() == whole.encode(t, add_special_tokens=False).ids, t


def test_registered_queries(spark, tmp_path):
    some = texts(7)
    docs = spark.createDataFrame(list(enumerate(some)), "doc_id long, text string").repartition(3)
    docs.write.parquet(str(tmp_path / "documents.parquet"))

    def want(name, end):
        t = Tokenizer.from_file(public_tokenizers.path(name))
        return [t.encode(x, add_special_tokens=False).ids + [end] for x in some]

    crc = lambda ids: zlib.crc32(np.array(ids, dtype="<u4").tobytes())
    pieces = sorted((i, len(x), crc(x)) for i, x in enumerate(want("byte_bpe_50k.json", 0)))
    for got in (op5_bin_completion_packing(spark, str(tmp_path)), corpus_pipeline.pack(spark, docs, str(tmp_path))):
        assert sorted((r.doc_id, r.length, r.ids_crc32) for r in got.collect()) == pieces
    at, rows = 0, []
    for i, x in enumerate(want("word_bpe_49k.json", 1)):
        rows.append((i, at, len(x), crc(x)))
        at += len(x)
    assert sorted(tuple(r) for r in op9_token_output(spark, str(tmp_path)).collect()) == rows
