"""Validation queries: payload, trace-create, finalize."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracewright.functions.jsonrules import DuckDialect, compile_rules
from tracewright.operators import validate as V
from tracewright.plans.oracle_views import with_views
from tracewright.plans.registry import query
from tracewright.schemas import FINALIZE_RULES, PAYLOAD_RULES, TRACE_CREATE_RULES
from tracewright.sources import bindings as B


def duck_payload_array(doc: str = "payload_json", type_col: str = "type", prefix: str = "''") -> str:
    d = DuckDialect(doc)
    branches = " ".join(f"WHEN {type_col} = '{t}' THEN {compile_rules(d, fs, prefix)}" for t, fs in PAYLOAD_RULES.items())
    return f"CASE {branches} ELSE {compile_rules(d, [], prefix)} END"


def duck_doc_array(rules, doc: str) -> str:
    return compile_rules(DuckDialect(doc), rules)


def _duck_explode(src: str, keys: str, arr: str) -> str:
    return f"""
SELECT {keys}, v.idx AS idx, v.field AS field, v.code AS code, v.message AS message
FROM (SELECT {keys}, unnest({arr}) AS v FROM {src}) u WHERE v IS NOT NULL"""


@query("payload_violations", with_views(_duck_explode("tel_events", "trace_id, event_id, type", duck_payload_array()),
                                        "tel_events"))
def payload_violations(spark, sf):
    ev = B.tel_events(spark, sf)
    return V.payload_violations(ev, ["trace_id", "event_id", "type"])


@query("trace_create_violations", with_views(_duck_explode("tel_trace_bodies", "trace_id",
                                                           duck_doc_array(TRACE_CREATE_RULES, "body_json")),
                                             "tel_trace_bodies"))
def trace_create_violations(spark, sf):
    return V.document_violations(B.tel_trace_bodies(spark, sf), ["trace_id"], "body_json", TRACE_CREATE_RULES)


@query("finalize_violations", with_views(_duck_explode("tel_finalize_bodies", "trace_id",
                                                       duck_doc_array(FINALIZE_RULES, "body_json")),
                                         "tel_finalize_bodies"))
def finalize_violations(spark, sf):
    return V.document_violations(B.tel_finalize_bodies(spark, sf), ["trace_id"], "body_json", FINALIZE_RULES)


@query("violation_counts", with_views(f"""
SELECT type, code, field, CAST(count(*) AS BIGINT) AS n
FROM ({_duck_explode("tel_events", "trace_id, event_id, type", duck_payload_array())}) x GROUP BY type, code, field""",
                                      "tel_events"))
def violation_counts(spark, sf):
    """A4 over payload violations: counts by (type, code, field)."""
    v = V.payload_violations(B.tel_events(spark, sf), ["trace_id", "event_id", "type"])
    return v.groupBy("type", "code", "field").agg(F.count(F.lit(1)).alias("n"))
