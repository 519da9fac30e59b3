"""Validation operators (V1-V11, V22): documents -> violation rows.

A rule table is compiled (``functions.jsonrules``) into one projection over a
VARIANT parse of each document; rows with violations are exploded into
``(keys..., field, code, message)``. No shuffle, no Python.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.functions.jsonrules import SparkDialect, compile_any, compile_rules, kind_paths
from tracewright.operators.common import sql_expr
from tracewright.schemas import PAYLOAD_RULES, Field

VIOLATION_FIELDS = ("field", "code", "message")


def _add_kinds(df: DataFrame, d: SparkDialect, rules_by_gate: Mapping[str | None, Sequence[Field]],
               gate_col: str | None) -> DataFrame:
    """One kind column per path, computed only for rows whose gate uses it."""
    users: dict[str, list[str | None]] = {}
    for g, fields in rules_by_gate.items():
        for p in kind_paths(fields):
            users.setdefault(p, []).append(g)
    cols = []
    for p, gates in users.items():
        e = d.kind_expr(p)
        if gate_col is not None and None not in gates:
            e = f"CASE WHEN `{gate_col}` IN ({', '.join(_quoted(g) for g in gates)}) THEN {e} END"
        cols.append(sql_expr(f"{e} AS {d.col_name(p)}"))
    return df.select("*", *cols)


def violations_array(df: DataFrame, doc_col: str, rules_by_gate: Mapping[str | None, Sequence[Field]],
                     gate_col: str | None = None, prefix: Column | None = None, out: str = "violations") -> DataFrame:
    """Add ``out``: array of (idx, field, code, message) for each row.

    ``rules_by_gate`` maps a value of ``gate_col`` (e.g. the event type) to its
    rules; key ``None`` means the rules apply to every row.
    """
    vcol = "_doc_v"
    d = SparkDialect(f"`{vcol}`")
    base = df.withColumn(vcol, sql_expr(f"try_parse_json(`{doc_col}`)"))
    if prefix is not None:
        base = base.withColumn("_vprefix", prefix)
    pre = "`_vprefix`" if prefix is not None else "''"
    base = _add_kinds(base, d, rules_by_gate, gate_col)
    if gate_col is None:
        expr = compile_rules(d, rules_by_gate[None], pre)
    else:
        branches = " ".join(f"WHEN `{gate_col}` = '{g}' THEN {compile_rules(d, fs, pre)}"
                            for g, fs in rules_by_gate.items() if g is not None)
        expr = f"CASE {branches} ELSE {compile_rules(d, [], pre)} END"
    kind_cols = [d.col_name(p) for fs in rules_by_gate.values() for p in kind_paths(fs)]
    drop = [vcol] + sorted(set(kind_cols)) + (["_vprefix"] if prefix is not None else [])
    return base.withColumn(out, sql_expr(expr)).drop(*drop)


def any_violation(df: DataFrame, doc_col: str, rules_by_gate: Mapping[str | None, Sequence[Field]], gate_col: str, out: str) -> DataFrame:
    """Add ``out``: whether the document breaks a rule of its gate. For plans that need no more than that."""
    d = SparkDialect("`_doc_v`")
    base = _add_kinds(df.withColumn("_doc_v", sql_expr(f"try_parse_json(`{doc_col}`)")), d, rules_by_gate, gate_col)
    branches = " ".join(f"WHEN {_quoted(g)} THEN {compile_any(d, fs)}" for g, fs in rules_by_gate.items() if g is not None)
    return base.select(*[f"`{c}`" for c in df.columns], sql_expr(f"CASE `{gate_col}` {branches} ELSE false END").alias(out))


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def explode_violations(df: DataFrame, keys: Sequence[str], arr: str = "violations") -> DataFrame:
    """One row per violation (the rule slots holding NULL are dropped)."""
    # explode_outer: no inferred size(arr) > 0 filter pushed below (and
    # inlining) the rule projection; NULL slots are dropped above the generator.
    return (df.select(*keys, F.explode_outer(arr).alias("_v"))
            .where(F.col("_v").isNotNull())
            .select(*keys, "_v.idx", "_v.field", "_v.code", "_v.message"))


def payload_violations(events: DataFrame, keys: Sequence[str], payload_col: str = "payload_json",
                       type_col: str = "type", prefix: Column | None = None) -> DataFrame:
    """Payload rules by event type; one row per violation."""
    arr = violations_array(events, payload_col, PAYLOAD_RULES, gate_col=type_col, prefix=prefix)
    return explode_violations(arr, keys)


def document_violations(docs: DataFrame, keys: Sequence[str], doc_col: str, rules: Sequence[Field]) -> DataFrame:
    """One rule set for every document."""
    arr = violations_array(docs, doc_col, {None: rules})
    return explode_violations(arr, keys)


def offending_value(doc: Column, path: Column, code: Column) -> Column:
    """JSON text of the input that a violation is about: what stands at the failing path, or for a missing field the
    object that lacks it. NULL for null, and then left out of the response. ``path`` is the violation's field within ``doc``,
    list positions as numbers. Meant for violation rows, which are few: no rule carries values."""
    at = F.regexp_replace(path, r"\.([0-9]+)(?=\.|$)", "[$1]")
    at = F.when(code == "missing", F.regexp_replace(at, r"(^|\.)[^.]+$", "")).otherwise(at)
    full = F.concat(F.lit("$."), at)
    scalar = F.call_function("to_json", F.call_function("try_variant_get", F.call_function("try_parse_json", doc), full, F.lit("variant")))
    # objects and lists as they were sent: a VARIANT orders the keys
    value = F.when(F.substring(scalar, 1, 1).isin("{", "["), F.call_function("get_json_object", doc, full)).otherwise(scalar)
    return F.nullif(F.when(at == "", F.trim(doc)).otherwise(value), F.lit("null"))
