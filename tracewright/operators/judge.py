"""Judge response processing.

Raw judge responses ``(trace_id, response_text)`` are fence-stripped with
array functions, parsed to VARIANT, validated by the judge rule table and
turned into result records; all in projections, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.functions.hashing import content_address
from tracewright.functions.jsonrules import SparkDialect
from tracewright.functions.patterns import PY_SPACE
from tracewright.functions.rounding import py_round1
from tracewright.operators.common import stage_boundary
from tracewright.operators.validate import violations_array
from tracewright.schemas import JUDGE_RULES, RUBRIC_VERSION, SCORE_NAMES

FENCE = "```"
_STRIP = f"^[{PY_SPACE}]+|[{PY_SPACE}]+$"


def py_strip(c: Column) -> Column:
    """Python ``str.strip()`` (Unicode whitespace)."""
    return F.regexp_replace(c, _STRIP, "")


def fence_strip(df: DataFrame, text: str, out: str = "body") -> DataFrame:
    """G1: strip; if it starts with a fence drop line 1 and cut at the last
    line starting with a fence (only an opening fence gives an empty body).
    One step per projection, so each intermediate is computed once."""
    x = (df.withColumn("_s", py_strip(F.coalesce(F.col(text), F.lit(""))))
           .withColumn("_lines", F.split(F.col("_s"), "\n", -1)))
    flags = F.transform(F.col("_lines"), lambda l: l.startswith(FENCE))
    last = F.size(F.col("_lines")) - F.array_position(F.reverse(flags), F.lit(True)) + 1  # 1-based
    body = F.array_join(F.slice(F.col("_lines"), 2, F.greatest(last - 2, F.lit(0)).cast("int")), "\n")
    return (x.withColumn("fenced", F.col("_s").startswith(FENCE))
             .withColumn(out, F.when(F.col("fenced"), body).otherwise(F.col("_s")))
             .drop("_s", "_lines"))


def parse_responses(raw: DataFrame, model: str = "judge-model") -> DataFrame:
    """G1-G4 + V22: per response the stripped body, the outcome and violations.

    Outcome: no_choices > refused (empty content with a refusal) >
    invalid_json > failed_validation > ok. Optional input columns
    ``has_choices`` (bool) and ``refusal`` (string) carry the API envelope."""
    cols = set(raw.columns)
    has_choices = F.col("has_choices") if "has_choices" in cols else F.lit(True)
    refusal = F.col("refusal") if "refusal" in cols else F.lit(None).cast("string")
    x = fence_strip(raw, "response_text")
    x = x.withColumn("_parsed_ok", F.expr("try_parse_json(body)").isNotNull())
    x = violations_array(x, "body", {None: JUDGE_RULES}, out="violations")
    x = x.withColumn("violations", F.when(F.col("_parsed_ok"), F.col("violations"))
                     .otherwise(F.array().cast(x.schema["violations"].dataType)))
    n_bad = F.size(F.filter("violations", lambda v: v.isNotNull()))
    empty = F.coalesce(F.col("response_text"), F.lit("")) == ""
    outcome = (F.when(~has_choices, F.lit("no_choices"))
               .when(empty & refusal.isNotNull() & (refusal != ""), F.lit("refused"))
               .when(~F.col("_parsed_ok"), F.lit("invalid_json"))
               .when(n_bad > 0, F.lit("failed_validation"))
               .otherwise(F.lit("ok")))
    x = x.withColumn("outcome", outcome).withColumn("n_violations", n_bad).withColumn("model", F.lit(model))
    return stage_boundary(x)


def judge_results(parsed: DataFrame) -> DataFrame:
    """Result records for ok responses: six scores, overall rounded
    half-even on the binary value (P16), rationale blob id, flags."""
    ok = parsed.where(F.col("outcome") == "ok").withColumn("_v", F.expr("try_parse_json(body)"))
    number = lambda path: F.expr(SparkDialect("_v").num(path))  # noqa: E731  as the rules read it: "0_4" is 4.0
    score = lambda n: number(f"scores.{n}")
    rationale = F.expr("try_variant_get(_v, '$.rationale', 'string')")
    flags = F.expr("try_variant_get(_v, '$.flags', 'array<string>')")
    return ok.select("trace_id", "model", F.lit(RUBRIC_VERSION).alias("rubric_version"),
                     *[score(n).alias(n) for n in SCORE_NAMES],
                     number("overall").alias("overall_raw"),
                     py_round1(number("overall")).alias("overall"),
                     rationale.alias("rationale"),
                     content_address(rationale).alias("rationale_blob_id"),
                     F.coalesce(flags, F.array().cast("array<string>")).alias("flags"))


def rubric_mean(results: DataFrame) -> Column:
    """Equal-weight mean of the six scores (the rubric's stated overall)."""
    return sum((F.col(n) for n in SCORE_NAMES), F.lit(0.0)) / len(SCORE_NAMES)


def score_report(results: DataFrame) -> DataFrame:
    """Unpivot the six named scores (tiny projection, ``stack``)."""
    pairs = ", ".join(f"'{n}', {n}" for n in SCORE_NAMES)
    return results.selectExpr("trace_id", f"stack({len(SCORE_NAMES)}, {pairs}) AS (score_name, score)")
