"""Quality rules: line-first cleaning with DataFrame functions only.

Every line is judged by itself (punctuation, navigation, shouting, symbols, boilerplate); failing lines are
taken out, and a document that loses more than ``max_loss`` percent of its characters that way is rejected.
Before that two rules on the whole text hold: at least ``min_words`` words, and not more than
``max_repeat`` percent of the words in 8-word windows that the text has twice or more.

One projection, no shuffle: a document never leaves its row. Higher-order functions hold each array in a
lambda variable, so it is computed once; repeated windows are found by sorting (window hash, position).
Windows are compared by 64-bit hashes within one document.

A very long text is judged whole, in its
row.

Defined cases: null or empty text has no words, fails the base rules and is not kept; blank lines are
neither judged nor counted; lines are cut at ``\\n`` only; ids, ties and repeated rows play no part (each
row is judged alone); input columns with an output's name give way to the output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.llm.common import WORD_BREAK

HAS_WORD = "[^\\x20\\x09-\\x0D]"
SYMBOLS = "[#*$%&|<>]"
# Line rules. A line fails if one of them holds.
NAVIGATION_BARS = 2        # this many '|' in a line
SHOUTS = 3                 # this many '!!' in a line
SYMBOL_SHARE = 10          # percent of symbols among the line's characters, above which it fails
END_MARK = "[.!?:;\\x{2026}\\x{3002}\\x{FF01}\\x{FF1F}][\"'\\x{201D}\\x{2019}\\x{00BB})\\]]*[\\x20\\x09-\\x0D]*\\z"
BOILERPLATE = ("all rights reserved", "licensed under", "released under the", "terms of use", "terms of service",
               "privacy policy", "accept cookies", "accept all cookies", "enable javascript", "copyright (c)",
               "subscribe to our", "lorem ipsum")  # in any case


def _bind(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once and held in a lambda variable."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, WORD_BREAK), "")


def repeat_words(words: Column) -> Column:
    """How many words stand in windows of 8 words that ``words`` (an array) has twice or more."""
    width = 8
    zero = F.lit(0).cast("long")

    def covered(pos: Column) -> Column:
        step = F.zip_with(pos, F.slice(pos, 2, F.size(pos)),
                          lambda a, b: F.least(F.coalesce(b - a, F.lit(width)), F.lit(width)))
        return F.aggregate(step, zero, lambda acc, x: acc + x)

    def marked(s: Column) -> Column:
        twice = F.filter(s, lambda x, i: (F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"]))
        return _bind(F.array_sort(F.transform(twice, lambda x: x["i"])), covered)

    def hashed(h: Column) -> Column:
        pairs = F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), zero).otherwise(_bind(F.sort_array(pairs), marked))

    def pairs_at(h: Column, distance: int) -> Column:
        """Each entry hashed with the one ``distance`` later: doubles the window's width."""
        n = F.size(h) - distance
        return F.zip_with(F.slice(h, 1, n), F.slice(h, distance + 1, n), lambda a, b: F.xxhash64(a, b))

    def windows(w: Column) -> Column:
        h = F.transform(w, lambda x: F.xxhash64(x))
        return F.when(F.size(w) < 9, zero).otherwise(
            _bind(h, lambda one: _bind(pairs_at(one, 1), lambda two: _bind(pairs_at(two, 2), lambda four: _bind(
                pairs_at(four, 4), hashed)))))

    return _bind(words, windows)


def line_fails(line: Column, symbols: Column) -> Column:
    """``symbols``: how many the whole text has; without any, no line is searched for them."""
    ended = F.lit(False)
    for mark in ".!?":
        ended = ended | line.endswith(mark)
    return (~(ended | line.rlike(END_MARK))
            | (line.contains("!!") & (F.regexp_count(line, F.lit("!!")) >= SHOUTS))
            | ((symbols > 0) & ((F.regexp_count(line, F.lit("\\|")) >= NAVIGATION_BARS)
                                | (F.regexp_count(line, F.lit(SYMBOLS)) * 100 > F.char_length(line) * SYMBOL_SHARE)))
            | _bind(F.lower(line), stock_phrase))


def stock_phrase(low: Column) -> Column:
    hit = F.lit(False)
    for phrase in BOILERPLATE:
        hit = hit | low.contains(phrase)
    return hit


def quality_rules(df: DataFrame, text_col: str = "text", min_words: int = 20, max_repeat: int = 30,
                  max_loss: int = 50) -> DataFrame:
    """``df`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, clean_text (the lines
    that pass), lost_chars and kept."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    total = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda acc, x: acc + F.char_length(x))
    full = lambda a: F.filter(a, lambda x: x.rlike(HAS_WORD))

    def lines(a: Column, symbols: Column) -> Column:
        return F.struct(
            _bind(full(a), lambda f: (F.size(f) - F.size(F.array_distinct(f))).cast("long")).alias("dup"),
            total(full(a)).alias("all_chars"),
            _bind(F.filter(a, lambda x: ~x.rlike(HAS_WORD) | ~line_fails(x, symbols)),
                  lambda good: F.struct(F.array_join(good, "\n").alias("text"), total(full(good)).alias("chars"))).alias("good"))

    measured = F.struct(
        _bind(words_of(text), lambda w: F.struct(
            F.size(w).cast("long").alias("n"), total(w).alias("chars"), repeat_words(w).alias("repeat"))).alias("w"),
        _bind(F.regexp_count(text, F.lit(SYMBOLS)).cast("long"), lambda n: F.struct(
            n.alias("symbols"), _bind(F.split(text, "\n"), lambda a: lines(a, n)).alias("l"))).alias("s"))
    named = {
        "n_words": "__llm_m.w.n", "word_chars": "__llm_m.w.chars", "n_symbols": "__llm_m.s.symbols",
        "n_dup_lines": "__llm_m.s.l.dup", "n_repeat_words": "__llm_m.w.repeat", "clean_text": "__llm_m.s.l.good.text",
    }
    kept_cols = [c for c in df.columns if c not in {*named, "base_failed", "lost_chars", "kept"}]
    m = df.select("*", F.inline(F.array(F.struct(measured.alias("__llm_m")))))
    base = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat * F.col("n_words"))
    lost = F.col("__llm_m.s.l.all_chars") - F.col("__llm_m.s.l.good.chars")
    out = m.select(*[F.col(f"`{c}`") for c in kept_cols], *[F.col(v).alias(k) for k, v in named.items()],
                   lost.alias("lost_chars"), F.col("__llm_m.s.l.all_chars").alias("__llm_all"))
    return (out.withColumn("base_failed", base)
            .withColumn("kept", ~F.col("base_failed") & (100 * F.col("lost_chars") <= max_loss * F.col("__llm_all")))
            .drop("__llm_all"))
