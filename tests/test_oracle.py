"""Every registered query against its SQL, on the smallest data."""

import datetime
import decimal
import math

import duckdb
import pytest

from tradepath.registry import load

QUERIES, ORACLES = load()
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
ROWS_ONLY = sorted(set(QUERIES) - set(ORACLES))
CHECKED = sorted(ORACLES)


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, bool) or v is None:
        return str(v)
    if isinstance(v, float):
        return "None" if math.isnan(v) else f"{v + 0.0:.6f}"
    if isinstance(v, (datetime.date, datetime.datetime)):
        return v.isoformat()
    return str(v)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


def test_names():
    assert set(ORACLES) <= set(QUERIES)
    assert len(QUERIES) > 170


@pytest.mark.parametrize("name", CHECKED)
def test_query_matches_sql(spark, duck, sf, name):
    result = QUERIES[name](spark, sf)
    plan = result._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas"):
        assert node not in plan
    cursor = duck.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(result.columns) == sorted(columns)
    expected = table(columns, cursor.fetchall())
    assert table(result.columns, result.collect()) == expected


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_query_runs(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0
