"""Plan helpers shared by operators."""

from __future__ import annotations

import uuid

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.session import scratch_path

_EXPR_CACHE: dict[tuple[int, str], Column] = {}


def sql_expr(sql: str) -> Column:
    """``F.expr`` memoized per SQL text and active context: the rule compiler
    emits the same large expressions for every query, parsing them once is
    enough (columns are unresolved expressions, reusable across plans)."""
    key = (id(SparkContext._active_spark_context), sql)
    col = _EXPR_CACHE.get(key)
    if col is None:
        col = _EXPR_CACHE[key] = F.expr(sql)
    return col


def stage_boundary(df: DataFrame) -> DataFrame:
    """Keep later filters from being pushed below (and inlining) expensive
    derived columns.

    Catalyst pushes a filter through a projection by substituting the
    projected expressions into the predicate; with deep derived columns
    (validation arrays, regex chains) that re-evaluates them and can blow the
    plan up. A predicate over the output of a ``Generate`` cannot be pushed
    below it, so one ``inline`` of a one-element array makes the columns
    computed exactly once, in the projection under it. Costs one struct copy
    per row; no shuffle, no materialization.
    """
    cols = df.columns
    return df.select(F.inline_outer(F.array(F.struct(*[F.col(f"`{c}`") for c in cols]))))


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh folder under the shared checkpoint folder and read it back: computed once however often
    it is used, lineage cut, and its size known to the planner. The folder stays; clear such folders by age."""
    path = scratch_path(df.sparkSession, f"tw-steps/{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
