"""Quality rules, URL filters and mixing: brute force, SQL on skewed rows, and the defined cases."""

import random
import re
from collections import Counter

import duckdb
import pyarrow as pa
import pytest

from tracewright.llm import oracles
from tracewright.llm import quality_rules as Q
from tracewright.llm.mixing import mix_sources, source_targets
from tracewright.llm.quality_rules import quality_rules
from tracewright.llm.url_filters import HOST_RULES, host_rule, pattern_rule, rarest_literals, url_filters


def no_python(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return not re.search("Python|Pandas|Arrow", plan)


# ---- quality rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base_figures(text):
    t = text or ""
    w = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    win = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    hit = {j for i in range(len(w) - 7) if win[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
    return (len(w), sum(map(len, w)), len(re.findall(Q.SYMBOLS, t)), len(lines) - len(set(lines)), len(hit),
            len(w) < 20 or 100 * len(hit) > 30 * len(w))


def quality_corpus():
    r = random.Random(5)
    texts = [None, "", " ", "\n\n", "a " * 25, "one two three four five six seven eight " * 2, " ".join(map(str, range(20))) + ".", "x" * 5000,
             "é\u00a0ü\u2003w " * 30, "a\r\nb\rc\x0bd\x0ce\n" * 9, " ".join(r.choice("ab") for _ in range(3000)), "# $ %\n" * 40]
    for _ in range(150):
        vocab = [f"w{i}" for i in range(r.choice([2, 5, 400]))]
        texts.append("".join(r.choice(vocab) + r.choice([" ", " ", " ", ".\n", "\t", " | ", "!! "]) for _ in range(r.randint(0, 120))))
    return texts


def test_base_figures_equal_brute_force(spark):
    texts = quality_corpus()
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, kept string, n_words int").repartition(3)
    out = quality_rules(df)
    assert no_python(out)
    assert out.columns.count("kept") == 1 and out.columns.count("n_words") == 1
    for r in out.collect():
        want = base_figures(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == want, texts[r.doc_id]
        assert not (r.base_failed and r.kept)


def test_quality_sql_agrees_on_odd_texts(spark):
    texts = quality_corpus()
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": list(range(len(texts))), "text": texts}))
    want = {r[0]: r[1:] for r in con.sql(f"SELECT doc_id, n_words, n_repeat_words, kept FROM ({oracles.QUALITY_RULES})").fetchall()}
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: (r.n_words, r.n_repeat_words, r.kept) for r in quality_rules(df).collect()} == want


def test_lines_are_cleaned_and_lossy_documents_rejected(spark):
    prose = "\n".join(f"This clean{i} sentence{i} is number{i} of the text{i} here{i}." for i in range(6))
    junk = ["Home | About | Contact us.", "BUY!! NOW!! CHEAP!!", "no end here", "All Rights Reserved.", "a### b### c### d$$$."]
    rows = [(1, prose), (2, prose + "\n" + "\n".join(junk)), (3, "\n".join(junk * 9) + "\n" + prose[:60]), (4, prose + "\n\n" + prose[:40])]
    got = {r.doc_id: r for r in quality_rules(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].kept and got[1].clean_text == prose and got[1].lost_chars == 0
    assert got[2].kept and got[2].clean_text == prose and got[2].lost_chars == sum(map(len, junk))
    assert not got[3].kept
    assert got[4].kept and got[4].clean_text == prose + "\n"
    assert quality_rules(spark.createDataFrame([], "doc_id long, text string")).count() == 0


# ---- URL filters

URLS = [None, "", "example.org/es/x", "http://example.org", "http://example.org/", "https://EXAMPLE.org/es/1?u=/de/", "https://a.b.example.org/es", "x://notexample.org/es/",
        "http://example.org/EN/1", "http://example.org/en/1", "http://m.example.org/en/199#top", "http://shop.com/fr/a", "http://shop.com/de/a", "http://com/de/", "http://scom/de/",
        "http://www.casino-win.com/fr/", "http://www.casino-win.com/x", "http://a.net/Casino", "http://a.net/casinos", "http://a.net?q=casino", "http://free-bets.net/", "http://freebets.net/",
        "a://b://c.org/es/", "://", "http:///de/", "http://user@h.com:80/de/x", "http://a.com\n/de/", "http://example.org/es/" + "a" * 20000, "http://é.org/fr/", "http://ads-track.net/1"]


def plain_rule(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    m = re.match(r"([^/?#]*)([^?#]*)", rest)
    host, path = re.sub("[A-Z]", lambda x: x[0].lower(), m[1]), m[2]
    fits = [r for r in HOST_RULES for h, p in [r.name.split("/", 1)] if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
    best = max(fits, key=lambda r: len(r.name), default=None)
    return host, path, best and best.name, best and best.verdict


def test_urls_equal_brute_force_and_sql(spark):
    rows = [(i, u, "clash", True) for i, u in enumerate(URLS)] + [(7, URLS[7], "clash", True)] * 3
    df = spark.createDataFrame(rows, "page_id long, url string, verdict string, host boolean").repartition(3)
    out = url_filters(df)
    assert no_python(out)
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        host, path, rule, verdict = plain_rule(r.url)
        assert (r.host, r.path, r.rule) == (host, path, rule), r.url
        assert r.verdict == (verdict or ("block" if r.pattern else "allow"))
    blocked = {r.url: r.pattern for r in got if r.pattern}
    assert blocked == {"http://www.casino-win.com/x": "casino", "http://a.net/Casino": "casino", "http://free-bets.net/": "free-bets", "http://freebets.net/": "freebets", "http://ads-track.net/1": "ad-tracker"}
    con = duckdb.connect()
    con.register("pages", pa.table({"page_id": list(range(len(URLS))), "url": URLS}))
    want = sorted(con.sql(f"SELECT page_id, host, path, rule, pattern, verdict FROM ({oracles.URL_FILTERS})").fetchall())
    assert sorted({(r.page_id, r.host, r.path, r.rule, r.pattern, r.verdict) for r in got}) == want
    assert url_filters(df.limit(0)).count() == 0


def test_rules_are_filed_under_their_rarest_literal(spark):
    subjects = spark.createDataFrame([("a.example.org/en/1",), ("b.example.org/x",), ("wp.org/admin",), ("c.org/admin",)], "subject string")
    rules = [host_rule("block", "example.org", "/en/1"), pattern_rule("admin", "/wp-admin/", "wp", "admin"), pattern_rule("none", "zzz", "zzz", "org")]
    assert rules[0].literals == ("example", "org", "en")
    assert rarest_literals(subjects, rules) == {"example.org/en/1": "en", "admin": "wp", "none": "zzz"}
    with pytest.raises(ValueError):
        url_filters(spark.createDataFrame([("http://a.org/",)], "url string"), host_rules=[], pattern_rules=[pattern_rule("any", ".*")])


# ---- mixing

def shared(sizes, weights, cap):
    """Targets by sharing again and again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, target, open_ = sum(sizes.values()), {}, set(names)
    while open_:
        left = total - sum(target.values())
        share = {s: left * w[s] / sum(w[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > cap * sizes[s]]
        if not over:
            return target | share
        for s in over:
            target[s] = cap * sizes[s]
            open_.discard(s)
    return target


def test_targets_are_shared_until_none_is_above(spark):
    r = random.Random(8)
    for sizes in [{"a": 10, "b": 1000, "c": 1, None: 40}, {"Z": 5, "a": 5, "é": 5, "\U0001F600": 900}, {"x": 0, "y": 7},
                  {f"s{i}": r.randint(0, 500) for i in range(30)}, {"only": 12}, {"zero": 0}]:
        df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, source_size long")
        got = {x.source: x.target for x in source_targets(df, (1, 2, 3), 3).collect()}
        want = shared(sizes, (1, 2, 3), 3)
        assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 for s in want), sizes


def mix_rows():
    r = random.Random(3)
    rows = [(i, r.choice(["a", "a", "a", "b", None, "é"]), "w " * min(4000, int(r.lognormvariate(3, 1)))) for i in range(1500)]
    return rows + [(2000, "tiny", "one two"), (2001, "empty", ""), (2002, "empty", None), (None, "b", "no id here"), (5, rows[5][1], rows[5][2]), (5, rows[5][1], rows[5][2]),
                   (3000, "a", "word " * 3000)]


def test_mix_comes_near_its_targets_and_reruns_agree(spark):
    rows = mix_rows()
    df = spark.createDataFrame([(*r, 9) for r in rows], "doc_id long, source string, text string, size int").repartition(7)
    out = mix_sources(df)
    assert no_python(out)
    got = out.collect()
    assert Counter((r.doc_id, r.source, r.size) for r in got) == Counter((d, s, len((t or "").split())) for d, s, t in rows)
    sizes, taken, target, each = Counter(), Counter(), {}, {}
    for r in got:
        sizes[r.source] += r["size"]
        taken[r.source] += r.taken
        target[r.source] = r.target
        each.setdefault(r.source, set()).add(r.taken // r["size"] if r["size"] else 0)
        assert r.taken <= 3 * r["size"] and (r.taken % r["size"] == 0 if r["size"] else r.taken == 0)
    assert target == pytest.approx(shared(sizes, (1, 2, 3), 3))
    assert all(r.source_size == sizes[r.source] for r in got)
    for s in sizes:
        assert abs(taken[s] - target[s]) <= max(2, 0.01 * target[s]), s
        whole = [x for x in each[s]]
        assert max(whole) - min(whole) <= 1 or 0 in whole
    again = mix_sources(df.repartition(3)).collect()
    assert Counter((r.doc_id, r.source, r.taken) for r in again) == Counter((r.doc_id, r.source, r.taken) for r in got)
    assert mix_sources(df.limit(0)).count() == 0


def test_mixing_sql_agrees(spark):
    rows = mix_rows()
    con = duckdb.connect()
    con.register("d", pa.table({"doc_id": pa.array([r[0] for r in rows], pa.int64()), "source": [r[1] for r in rows], "text": [r[2] for r in rows]}))
    want = Counter((a, b, c, round(t, 6), x) for a, b, c, t, x in con.sql(oracles.source_mixing("d")).fetchall())
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = Counter((r.doc_id, r["size"], r.source_size, round(r.target, 6), r.taken) for r in mix_sources(df).collect())
    # the three rows of id 5 meet three rows of the SQL's keyed join once each
    assert set(got) == set(want)


def test_mix_keeps_columns_named_like_its_own_and_spreads_a_hot_source(spark):
    rows = [(i, "hot" if i % 3 else None if i % 9 else f"s{i}", "w " * (i % 13), "mine") for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, cut string")
    for name in ("fill", "filled", "key", "n", "e", "rest", "cell"):
        df = df.withColumn(name, df["cut"])
    got = mix_sources(df)
    plan = got._jdf.queryExecution().executedPlan().toString()
    plain = {(r.doc_id, r.taken) for r in mix_sources(df.select("doc_id", "source", "text")).collect()}
    out = got.collect()
    assert {(r.doc_id, r.taken) for r in out} == plain and len(out) == 900
    assert all(r[c] == "mine" for r in out for c in ("cut", "fill", "filled", "key", "n", "e", "rest", "cell"))
    assert "BroadcastHashJoin" in plan  # thresholds go to the documents of the hot source


def test_targets_of_many_sources_in_many_ranges(spark):
    r = random.Random(3)
    sizes = {f"s{i:05d}": r.choice([0, 1, 7, 7, 500, r.randint(1, 10 ** 6)]) for i in range(3000)}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame(list(sizes.items()), "source string, source_size long").repartition(5)
        got = {x.source: x.target for x in source_targets(df, (1, 2, 3), 3).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == pytest.approx(shared(sizes, (1, 2, 3), 3))
