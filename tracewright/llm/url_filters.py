"""URL filters: pattern rules indexed by their rarest literal token, with DataFrame functions only.

Each rule names literal tokens (runs of a-z and 0-9) that every URL it fits must hold as whole tokens. The
rule is filed under the one that the corpus has least often. The tokens of a URL fetch its candidate
rules by an equi-join, and regular expressions run on those alone. Different URLs are judged once;
verdicts go back to the rows by a join on the URL's subject (host and path).

Among the fitting host rules the longest wins; without any, a fitting pattern rule blocks; else allow.
The rule list is a parameter held by the driver; its index is broadcast up to ``BROADCAST_RULES`` rules.

A very long URL is matched whole.

Defined cases: a null URL or one without ``://`` has empty host and path, fits no rule and is allowed;
ties between equally long host rules go to the greater name; repeated rows each get the verdict; an empty
table gives an empty one; input columns with an output's name give way to the output.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NOT_TOKEN = "[^a-z0-9]+"
BROADCAST_RULES = 20_000   # above this the rules' index is shuffled like any table


class UrlRule(NamedTuple):
    name: str
    verdict: str
    pattern: str          # on host and path joined (host in lower case)
    literals: tuple[str, ...]
    host_rule: bool


def host_rule(verdict: str, host: str, path: str) -> UrlRule:
    """Fits the host, all its subdomains, and paths that begin with ``path``. The path's last token may go
    on in the URL, so it is a literal only if something follows it in the rule."""
    whole = f"{host}{path}".lower()
    tokens = re.findall("[a-z0-9]+", whole)
    if re.search("[a-z0-9]$", whole) and "/" in whole:
        tokens = tokens[:-1]
    return UrlRule(f"{host}{path}", verdict, f"^([^/]*\\.)?{re.escape(host)}{re.escape(path)}", tuple(tokens), True)


def pattern_rule(name: str, pattern: str, *literals: str) -> UrlRule:
    return UrlRule(name, "block", f"(?i){pattern}", literals, False)


HOST_RULES = (host_rule("allow", "org", "/"), host_rule("block", "example.org", "/es/"),
              host_rule("block", "example.org", "/en/1"), host_rule("allow", "com", "/fr/"),
              host_rule("block", "com", "/de/"))
_EDGE, _END = "(^|[^a-z0-9])", "([^a-z0-9]|$)"
PATTERN_RULES = tuple(
    pattern_rule(w, f"{_EDGE}{w}{_END}", w)
    for w in ("casino", "poker", "viagra", "porn", "xxx", "torrent", "jackpot", "escort", "adult", "spam")
) + (
    pattern_rule("free-bets", f"{_EDGE}free-bets{_END}", "free", "bets"),
    pattern_rule("freebets", f"{_EDGE}freebets{_END}", "freebets"),
    pattern_rule("cheap-pills", f"{_EDGE}cheap-pills{_END}", "cheap", "pills"),
    pattern_rule("ad-tracker", f"{_EDGE}ads-track(er|ing)?{_END}", "ads"),
    pattern_rule("admin", "/wp-admin(/|$)", "wp", "admin"),
    pattern_rule("cart", "/(shopping-)?cart(/|$)", "cart"),
)


def url_parts(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), UPPER, LOWER), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def _tokens(subjects: DataFrame) -> DataFrame:
    t = F.array_distinct(F.split(F.translate(F.col("subject"), UPPER, LOWER), NOT_TOKEN))
    return subjects.select("subject", F.explode(t).alias("token")).where(F.col("token") != "")


def rarest_literals(subjects: DataFrame, rules: Sequence[UrlRule]) -> dict[str, str]:
    """Rule name -> its literal that the fewest subjects hold (ties: the lesser word). Only counts of the
    rules' own literals come back, so the answer is as large as the rule list."""
    words = sorted({w for r in rules for w in r.literals})
    spark = subjects.sparkSession
    wanted = spark.createDataFrame([(w,) for w in words], "token string")
    if len(words) <= BROADCAST_RULES:
        wanted = F.broadcast(wanted)
    counts = dict(_tokens(subjects).join(wanted, "token").groupBy("token").count().collect())
    return {r.name: min(r.literals, key=lambda w: (counts.get(w, 0), w)) for r in rules}


def url_filters(df: DataFrame, url_col: str = "url", host_rules: Sequence[UrlRule] = HOST_RULES,
                pattern_rules: Sequence[UrlRule] = PATTERN_RULES) -> DataFrame:
    """``df`` with host, path, rule (the host rule that decided, else null), pattern (the pattern rule that
    blocked, else null) and verdict."""
    rules = [*host_rules, *pattern_rules]
    if any(not r.literals for r in rules):
        raise ValueError("a rule needs a literal token to be indexed by")
    spark = df.sparkSession
    host, path = url_parts(F.col(f"`{url_col}`").cast("string"))
    outputs = {"host", "path", "rule", "pattern", "verdict"}
    keep = [F.col(f"`{c}`") for c in df.columns if c not in outputs]
    rows = df.select(*keep, host.alias("host"), path.alias("path")).withColumn("__llm_subject", F.concat("host", "path"))
    subjects = rows.select(F.col("__llm_subject").alias("subject")).distinct()
    rarest = rarest_literals(subjects, rules)
    index = spark.createDataFrame(
        [(rarest[r.name], r.name, r.verdict, r.pattern, 1 if r.host_rule else 0, len(r.name)) for r in rules],
        "token string, name string, rule_verdict string, rule_pattern string, by_host int, long int")
    if len(rules) <= BROADCAST_RULES:
        index = F.broadcast(index)
    fits = (_tokens(subjects).join(index, "token")
            .where(F.rlike(F.col("subject"), F.col("rule_pattern")))
            .groupBy("subject").agg(F.max(F.struct("by_host", "long", "name", "rule_verdict")).alias("best")))
    best = F.col("best")
    return (rows.join(fits, rows["__llm_subject"] == fits["subject"], "left")
            .withColumn("rule", F.when(best["by_host"] == 1, best["name"]))
            .withColumn("pattern", F.when(best["by_host"] == 0, best["name"]))
            .withColumn("verdict", F.coalesce(best["rule_verdict"], F.lit("allow")))
            .drop("best", "subject", "__llm_subject"))
