"""Judge response queries over tel_judge_raw."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracewright.functions.jsonrules import DuckDialect, compile_rules
from tracewright.functions.patterns import PY_SPACE
from tracewright.functions.rounding import duck_round1, py_round1
from tracewright.operators import judge as J
from tracewright.plans.oracle_views import with_views
from tracewright.plans.registry import query
from tracewright.schemas import JUDGE_RULES, SCORE_NAMES
from tracewright.sources import bindings as B

MODEL = "judge-model"
_NUM = DuckDialect("body").num

_STRIPPED = f"regexp_replace(response_text, '^[{PY_SPACE}]+|[{PY_SPACE}]+$', '', 'g')"
_PARSED = f"""
SELECT trace_id, response_text, s, starts_with(s, '```') AS fenced,
       CASE WHEN starts_with(s, '```')
            THEN array_to_string(lines[2:len(lines) - list_position(list_reverse(list_transform(lines, lambda l: starts_with(l, '```'))), true)], chr(10))
            ELSE s END AS body
FROM (SELECT *, string_split(s, chr(10)) AS lines FROM (SELECT *, {_STRIPPED} AS s FROM tel_judge_raw) a) b"""

_CHECKED = f"""
SELECT *, json_valid(body) AS parsed_ok,
       CASE WHEN json_valid(body) THEN {compile_rules(DuckDialect('body'), JUDGE_RULES)} ELSE [] END AS violations
FROM jg_parsed"""

_OUT = """
SELECT *, len(list_filter(violations, lambda v: v IS NOT NULL)) AS n_violations,
       CASE WHEN NOT parsed_ok THEN 'invalid_json' WHEN len(list_filter(violations, lambda v: v IS NOT NULL)) > 0
            THEN 'failed_validation' ELSE 'ok' END AS outcome
FROM jg_checked"""

_RESULTS = f"""
SELECT trace_id, '{MODEL}' AS model, '1.0' AS rubric_version,
       {", ".join(f"{_NUM('scores.' + n)} AS {n}" for n in SCORE_NAMES)},
       {_NUM('overall')} AS overall_raw,
       {duck_round1(_NUM('overall'))} AS overall,
       json_extract_string(body, '$.rationale') AS rationale,
       concat('sha256:', sha256(json_extract_string(body, '$.rationale'))) AS rationale_blob_id,
       coalesce(json_extract_string(body, '$.flags[*]'), CAST([] AS VARCHAR[])) AS flags
FROM jg_out WHERE outcome = 'ok'"""

_EXTRA = {"jg_parsed": _PARSED, "jg_checked": _CHECKED, "jg_out": _OUT, "jg_results": _RESULTS}


def _sql(body: str) -> str:
    return with_views(body, "tel_judge_raw", extra=_EXTRA)


def _parsed(spark, sf):
    return J.parse_responses(B.tel_judge_raw(spark, sf), MODEL)


def _results(spark, sf):
    return J.judge_results(_parsed(spark, sf))


@query("fence_strip", _sql("SELECT trace_id, fenced, body FROM jg_parsed"))
def fence_strip(spark, sf):
    """G1: code-fence stripping with array functions."""
    return J.fence_strip(B.tel_judge_raw(spark, sf), "response_text").select("trace_id", "fenced", "body")


@query("judge_outcomes", _sql("SELECT trace_id, outcome, CAST(n_violations AS INT) AS n_violations FROM jg_out"))
def judge_outcomes(spark, sf):
    """Outcome class per response."""
    return _parsed(spark, sf).select("trace_id", "outcome", F.col("n_violations").cast("int"))


@query("judge_violations", _sql("""
SELECT trace_id, v.idx AS idx, v.field AS field, v.code AS code, v.message AS message
FROM (SELECT trace_id, unnest(violations) AS v FROM jg_out WHERE parsed_ok) x WHERE v IS NOT NULL"""))
def judge_violations(spark, sf):
    """Rule violations of parsed responses."""
    p = _parsed(spark, sf).where(F.col("_parsed_ok"))
    return (p.select("trace_id", F.explode_outer("violations").alias("v")).where(F.col("v").isNotNull())
            .select("trace_id", "v.idx", "v.field", "v.code", "v.message"))


@query("judge_results", _sql(f"""
SELECT trace_id, model, rubric_version, {", ".join(SCORE_NAMES)}, overall, rationale_blob_id,
       array_to_string(flags, ',') AS flags FROM jg_results"""))
def judge_results(spark, sf):
    """Result records (overall rounded as Python does, rationale as a blob id)."""
    r = _results(spark, sf)
    return r.select("trace_id", "model", "rubric_version", *SCORE_NAMES, "overall", "rationale_blob_id",
                    F.array_join("flags", ",").alias("flags"))


@query("judge_rounding", _sql("SELECT trace_id, overall_raw, overall FROM jg_results"))
def judge_rounding(spark, sf):
    """Raw overall and its one-decimal rounding (ties on the binary value)."""
    return _results(spark, sf).select("trace_id", "overall_raw", "overall")


_MEAN = "(" + " + ".join(["0.0"] + list(SCORE_NAMES)) + f") / {len(SCORE_NAMES)}"


@query("rubric_consistency", _sql(f"""
SELECT trace_id, {duck_round1(_MEAN)} AS rubric_overall, overall, {duck_round1(_MEAN)} = overall AS consistent
FROM jg_results"""))
def rubric_consistency(spark, sf):
    """Equal-weight mean of the six scores, rounded, against overall."""
    r = _results(spark, sf)
    m = py_round1(J.rubric_mean(r))
    return r.select("trace_id", m.alias("rubric_overall"), "overall", (m == F.col("overall")).alias("consistent"))


@query("flag_counts", _sql("""
SELECT flag, CAST(count(*) AS BIGINT) AS n FROM (SELECT unnest(flags) AS flag FROM jg_results) x GROUP BY flag"""))
def flag_counts(spark, sf):
    """Flag frequencies over accepted judge results."""
    return _results(spark, sf).select(F.explode("flags").alias("flag")).groupBy("flag").agg(F.count(F.lit(1)).alias("n"))


@query("score_report", _sql(f"""
SELECT trace_id, score_name, score FROM (
  {" UNION ALL ".join(f"SELECT trace_id, '{n}' AS score_name, {n} AS score FROM jg_results" for n in SCORE_NAMES)}) x"""))
def score_report(spark, sf):
    """Six named scores per trace as rows."""
    return J.score_report(_results(spark, sf))
