"""Lookups by key read few row groups."""

import pytest
from pyspark.sql import functions as F

from tracewright.operators import lookup as L


def rows_read(df):
    """Rows that the scan gave to the filter, from the scan's metric."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    leaf = leaves.apply(0)
    return leaf.metrics().apply("numOutputRows").value()


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("lookup") / "t")
    df = spark.range(200_000).select(F.concat(F.lit("t"), (F.col("id") % 500)).alias("trace_id"), F.col("id").cast("int").alias("seq"),
                                     F.concat(F.lit("ev-"), F.sha2(F.col("id").cast("string"), 256)).alias("event_id"))
    L.write_lookup(df, path, "event_id", ["trace_id", "seq"], row_group=1 << 18, rows_per_group=5000)
    return path


@pytest.mark.parametrize("n", [1, 20])
def test_a_lookup_by_a_scattered_key_skips_row_groups(spark, table, n):
    ids = [r.e for r in spark.range(n).select(F.concat(F.lit("ev-"), F.sha2((F.col("id") * 9973).cast("string"), 256)).alias("e")).collect()]
    got = L.lookup(spark, table, "event_id", ids)
    assert {r.event_id for r in got.collect()} == set(ids)
    assert rows_read(L.lookup(spark, table, "event_id", ids[:1])) < 20_000
    assert rows_read(got) < 200_000 * (0.1 if n == 1 else 0.9)
    assert rows_read(L.lookup(spark, table, "event_id", ["ev-none"])) < 20_000 and L.lookup(spark, table, "event_id", ["ev-none"]).count() == 0


def test_bounds_of_a_lookup(spark, table):
    assert L.lookup(spark, table, "event_id", []).count() == 0
    with pytest.raises(ValueError):
        L.lookup(spark, table, "event_id", [str(i) for i in range(L.MOST_KEYS + 1)])
    assert L.lookup(spark, table, "event_id", [str(i) for i in range(L.MOST_KEYS)]).count() == 0
