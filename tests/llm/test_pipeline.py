"""The pipeline's stages against a brute-force version, each on its own input."""

import random
import re
from collections import Counter

import duckdb
import public_tokenizers
import pyarrow as pa
import pytest

import corpus_pipeline
from test_minhash_dedup import brute as near_brute
from tracewright.llm import oracles
from tracewright.llm import quality_rules as Q

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SYMBOLS = re.compile(Q.SYMBOLS)
ENDED = re.compile(r"[.!?:;…。！？][\"'”’»)\]]*[\x20\x09-\x0D]*\Z")


def corpus(seed):
    r = random.Random(seed)
    vocab = ["".join(r.choice("abcdefghé") for _ in range(r.randint(2, 8))) for _ in range(500)]
    sentence = lambda n: " ".join(r.choice(vocab) for _ in range(n)).capitalize() + r.choice(".!?")
    prose = lambda k: "\n".join(sentence(r.randint(4, 14)) for _ in range(k))
    passage = sentence(40)
    out = [None, "", "too short.", "Home | About | Login | Help\n" * 9, prose(5) + "\nAll rights reserved.", " ".join(["same"] * 60) + "."]
    for _ in range(25):
        t = prose(r.randint(3, 20))
        out.append(t)
        for _ in range(r.choice([0, 0, 1, 3])):
            w = t.split(" ")
            w[r.randrange(len(w))] = r.choice(vocab)
            out.append(" ".join(w))
        if r.random() < 0.4:
            out.append(prose(4) + "\n" + passage + "\n" + prose(4))
        if r.random() < 0.3:
            out.append(prose(3) + "\nNext page | Previous page | Top\nno end here " + "### " * 3 + "\n" + prose(3))
    return [(i if i != 7 else None, t, "en", r.choice(["a", "b", "c", "d", None]), len(t or "")) for i, t in enumerate(out)]


def line_fails(x):
    return (not ENDED.search(x) or x.count("!!") >= 3 or x.count("|") >= 2 or len(SYMBOLS.findall(x)) * 100 > len(x) * 10
            or any(p in x.lower() for p in Q.BOILERPLATE))


def clean_brute(rows):
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": list(range(len(rows))), "text": [r[1] for r in rows]}))
    kept = {i for i, k in con.sql(f"SELECT doc_id, kept FROM ({oracles.QUALITY_RULES})").fetchall() if k}
    out = []
    for i, (d, t, lang, source, _) in enumerate(rows):
        if i in kept:
            t = "\n".join(x for x in t.split("\n") if not re.search(r"[^\x20\x09-\x0D]", x) or not line_fails(x))
            out.append((d, t, lang, source, len(t)))
    return out


def near_dedup_brute(rows):
    kept = {d for d, _, _, k in near_brute([(r[0], r[1]) for r in rows]) if k}
    return list({(r[0], r[1]): r for r in rows if r[0] in kept}.values())


def cut_brute(rows):
    seen, out, once = set(), [], {}
    for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        w = re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")
        gone = [False] * len(w)
        for j in range(len(w) - 19):
            g = tuple(w[j:j + 20])
            if g in seen:
                gone[j:j + 20] = [True] * 20
            seen.add(g)
        t = " ".join(x for x, g in zip(w, gone) if not g) if any(gone) else r[1] or ""
        if not (w and all(gone)):
            out.append((r[0], t, r[2], r[3], len(t)))
    return out


def mix_brute(rows):
    con = duckdb.connect()
    con.register("d", pa.table({"doc_id": pa.array([r[0] for r in rows], pa.int64()), "text": [r[1] for r in rows], "source": [r[3] for r in rows]}))
    taken = {d: (t // s if s else 0) for d, s, _, _, t in con.sql(oracles.source_mixing("d")).fetchall()}
    return [r for r in rows for _ in range(taken[r[0]])]


def text_rows(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_stages_equal_brute_force(spark, tmp_path, seed):
    rows = corpus(seed)
    random.Random(seed).shuffle(rows)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    want = rows
    for (name, stage), brute in zip(corpus_pipeline.STAGES[:-1], (clean_brute, near_dedup_brute, cut_brute, mix_brute)):
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        want = brute(want)
        assert want and text_rows(docs) == Counter(want), name
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    size = Counter()
    for r in want:
        size[r[0]] += len(t.encode(r[1], add_special_tokens=False).ids) + 1
    got, whole = Counter(), corpus_pipeline.run(spark, str(tmp_path)).collect()
    fill = Counter()
    for x in whole:
        got[x.doc_id] += x.length
        fill[x.sequence_id] += x.length
    assert got == size
    assert max(fill.values()) <= 2048 and len(fill) <= -(-sum(size.values()) // 2048) + 1


def test_empty_table(spark, tmp_path):
    empty = spark.createDataFrame([], SCHEMA)
    empty.write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


MADE = ["kept", "size", "taken", "target", "epochs", "source_size", "n_words", "n_removed", "spans", "kept_sha256", "kept_text", "clean_text",
        "first_ord", "component_id", "n_shingles", "base_failed", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "k", "ord",
        "id", "copies", "near", "starts", "bucket", "__ord", "__k", "__nth", "__c0", "__carried_0", "__llm_id", "a.b", "a b"]


def test_foreign_columns_keep_their_values(spark):
    """Every name that an operator makes stands in the input with values of its own; each stage returns them."""
    text = "One two three four five six seven eight nine ten eleven twelve. Some more words that end with a stop are here now.\n"
    rows = [(i, text.replace("One", f"Word{i}") + f"Another line {i} of prose that ends well.", "en", "ab"[i % 2], 9, *[f"{c}-{i}" for c in MADE])
            for i in range(6)] + [(9, None, None, None, None, *[None] * len(MADE))]
    docs = spark.createDataFrame(rows, ", ".join([SCHEMA, *(f"`{c}` string" for c in MADE)]))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns, name
        got = [r for r in out.collect() if r[0] != 9]
        assert got, name
        for r in got:
            assert list(r[5:]) == [f"{c}-{r[0]}" for c in MADE], name
    corpus_pipeline.pack(spark, docs, "").collect()
