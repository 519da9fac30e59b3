"""A text of a hundred thousand words beside short ones."""

import public_tokenizers
import pytest

from tracewright.llm.fingerprints import document_fingerprints
from tracewright.llm.minhash_dedup import minhash_dedup
from tracewright.llm.mixing import mix_sources
from tracewright.llm.quality_rules import quality_rules
from tracewright.llm.sharding import minimax_shards
from tracewright.llm.suffix_dedup import suffix_dedup
from tracewright.llm.token_output import token_round_trip

WORDS = 100_000
LONG = " ".join(f"w{i * 7919 % 100_003}" for i in range(WORDS)) + "."


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(1, LONG, "a"), (2, LONG.replace("w7919 ", "other "), "a"), (3, "one two three", "b"), (4, "one two three", "b"), (5, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_near_duplicates_sizes_and_words(docs):
    m = by_id(minhash_dedup(docs))
    assert (m[1].component_id, m[2].component_id, m[4].component_id) == (1, 1, 3) and m[1].n_shingles == WORDS - 4
    assert by_id(minimax_shards(docs))[1].size == len(LONG) + 16
    x = by_id(mix_sources(docs))
    assert x[1].size == WORDS and x[1].taken in (0, WORDS, 2 * WORDS, 3 * WORDS)
    assert by_id(quality_rules(docs))[1].n_words == WORDS


def test_bytes_tokens_and_fingerprints(docs):
    s = by_id(suffix_dedup(docs))
    assert s[1].n_bytes == len(LONG) and len(LONG) - 20 < s[1].n_removed < len(LONG)
    t = by_id(token_round_trip(docs, public_tokenizers.path("word_bpe_49k.json")))
    assert t[1].n_tokens > WORDS and t[2].start == t[1].start + t[1].n_tokens
    f = by_id(document_fingerprints(docs))
    assert f[1].n_chars == len(LONG) and f[3].fingerprint == f[4].fingerprint != f[1].fingerprint
