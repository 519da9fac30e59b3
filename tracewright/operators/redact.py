"""Redaction (R1-R10): secret scan, PII mask, byte truncation, audit.

One projection per rule step; every step is a codegen'd JVM expression
(``rlike`` / ``regexp_replace`` / ``substring`` on BINARY), no Python.
Rule order is fixed (secret -> pii -> truncate) whatever the order of
``rules``; ``rules=None`` means all three, ``rules=[]`` does nothing.
Within a rule the patterns chain, each seeing the previous result, and a
rule counts as applied when one of its patterns *matches* the running text.
Text rules run only on valid UTF-8; truncation always runs and cuts bytes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.functions.patterns import (JAVA_PII_PATTERNS, JAVA_SECRET_PATTERNS, PII_REQUIRES, SECRET_REQUIRES,
                                           SECRET_TOKEN)
from tracewright.operators.common import stage_boundary
from tracewright.schemas import ENUMS, MAX_BLOB_BYTES

ALL_RULES = ENUMS["redaction_rule"]


def redact(df: DataFrame, content: str, rules: Sequence[str] | None = None,
           max_bytes: int = MAX_BLOB_BYTES, prefix: str = "r_") -> DataFrame:
    """Append redaction columns for column ``content`` (STRING or BINARY).

    Adds ``{prefix}content`` (BINARY), ``{prefix}rules_applied`` (ARRAY<STRING>),
    ``{prefix}was_modified``, ``{prefix}was_truncated``, ``{prefix}original_length``.
    """
    rules = list(ALL_RULES) if rules is None else list(rules)
    unknown = set(rules) - set(ALL_RULES)
    if unknown:
        raise ValueError(f"unknown redaction rules {sorted(unknown)}")
    raw, txt, ok = f"{prefix}_raw", f"{prefix}_txt", f"{prefix}_utf8"
    out = (df.withColumn(raw, F.col(content).cast("binary"))
             .withColumn(ok, F.expr(f"is_valid_utf8(cast(`{raw}` as string))"))
             .withColumn(txt, F.col(raw).cast("string")))
    hit_cols: dict[str, list[str]] = {"secret_scan": [], "pii_mask": []}
    steps: list[tuple[str, str, str, tuple[str, ...] | None]] = []
    if "secret_scan" in rules:
        steps += [("secret_scan", p, SECRET_TOKEN, q) for p, q in zip(JAVA_SECRET_PATTERNS, SECRET_REQUIRES)]
    if "pii_mask" in rules:
        steps += [("pii_mask", p, r, q) for (p, r), q in zip(JAVA_PII_PATTERNS, PII_REQUIRES)]
    guards = []
    for i, (_, _, _, req) in enumerate(steps):
        g = f"{prefix}_g{i}"
        cond = F.col(txt).rlike(r"\p{Nd}") if req is None else \
            F.greatest(*[F.col(txt).contains(x) for x in req]) if len(req) > 1 else F.col(txt).contains(req[0])
        out = out.withColumn(g, F.col(ok) & cond)
        guards.append(g)
    for i, (rule, pat, repl, _) in enumerate(steps):
        hit = f"{prefix}_hit{i}"
        # The regex runs only where the cheap literal guard (on the original
        # text) holds; each step is its own projection, computed once.
        out = (out.withColumn(hit, F.col(guards[i]) & F.col(txt).rlike(pat))
                  .withColumn(txt, F.when(F.col(hit), F.regexp_replace(F.col(txt), pat, _escape_repl(repl)))
                              .otherwise(F.col(txt))))
        hit_cols[rule].append(hit)

    def any_of(cols: list[str]) -> Column:
        return F.greatest(*[F.col(c) for c in cols]) if len(cols) > 1 else (F.col(cols[0]) if cols else F.lit(False))

    sec, pii = any_of(hit_cols["secret_scan"]), any_of(hit_cols["pii_mask"])
    text_mod = sec | pii
    body = F.when(text_mod, F.col(txt).cast("binary")).otherwise(F.col(raw))
    if "truncate_large" in rules:
        trunc = F.octet_length(body) > F.lit(max_bytes)
        body = F.when(trunc, F.substring(body, 1, max_bytes)).otherwise(body)
    else:
        trunc = F.lit(False)
    applied = F.filter(F.array(F.when(sec, F.lit("secret_scan")), F.when(pii, F.lit("pii_mask")),
                               F.when(trunc, F.lit("truncate_large"))), lambda x: x.isNotNull())
    tmp = [raw, ok, txt] + guards + [c for cs in hit_cols.values() for c in cs]
    # stage_boundary: later filters on these columns must not be pushed into
    # (and re-evaluate) the regex chain.
    return stage_boundary(out.withColumn(f"{prefix}content", body)
               .withColumn(f"{prefix}rules_applied", applied)
               .withColumn(f"{prefix}was_modified", text_mod | trunc)
               .withColumn(f"{prefix}was_truncated", trunc)
               .withColumn(f"{prefix}original_length", F.octet_length(F.col(raw)).cast("long"))
               .drop(*tmp))


def _escape_repl(s: str) -> str:
    # Java replacement strings treat '$' and '\\' specially.
    return s.replace("\\", "\\\\").replace("$", "\\$")


def redaction_audit(redacted: DataFrame, group_cols: Sequence[str], prefix: str = "r_") -> DataFrame:
    """Per group and rule, how many items the rule changed and their bytes.

    Conditional sums per rule, then an unpivot of the tiny aggregate: no
    ``explode`` on the big side (its inferred ``size > 0`` filter would be
    pushed below, and re-run, the regex chain).
    """
    applied = F.col(f"{prefix}rules_applied")
    length = F.col(f"{prefix}original_length")
    aggs = []
    for r in ALL_RULES:
        hit = F.array_contains(applied, r)
        aggs += [F.sum(F.when(hit, 1).otherwise(0)).cast("long").alias(f"n_{r}"),
                 F.sum(F.when(hit, length).otherwise(0)).cast("long").alias(f"b_{r}")]
    per = redacted.groupBy(*group_cols).agg(*aggs)
    stack = ", ".join(f"'{r}', n_{r}, b_{r}" for r in ALL_RULES)
    return (per.selectExpr(*group_cols, f"stack({len(ALL_RULES)}, {stack}) AS (rule, n_items, bytes_in)")
            .where(F.col("n_items") > 0))
