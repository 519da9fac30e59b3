"""Every registered query against its DuckDB oracle on the smallest scale factor."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return round(v, 9)
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    return v if isinstance(v, (int, str, bool)) else str(v)


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(_norm(r[c]) for c in cols) for r in pdf.to_dict("records")),
                        key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_matches_oracle(spark, duck, name):
    got = E.queries()[name](spark, SF).toPandas()
    sql = E.oracle_sql().get(name)
    if sql is None:
        pytest.skip("no oracle")
    assert _rows(got) == _rows(duck.sql(sql).df())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "trace_id" in df.columns
