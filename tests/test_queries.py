"""Every registered query agrees with its SQL on the smallest supplied tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_module
from conftest import TESTDATA
from tests_support import plan_of

FOLDER = f"{TESTDATA}/sf0.001"
QUERIES, ORACLES = entry_module.queries(), entry_module.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no supplied tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in os.listdir(FOLDER):
        name = file.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{file}'")
    return connection


def comparable(value):
    if value is None:
        return ("", "")
    if isinstance(value, bool):
        return ("bool", str(value))
    if isinstance(value, (int, float)):
        return ("number", "nan" if math.isnan(value) else repr(float(value) + 0.0))
    return (type(value).__name__, str(value))


def table_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(
        tuple(comparable(row[i]) for i in order) for row in rows
    )


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_agrees_with_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    expected = duck.execute(ORACLES[name])
    names = [column[0] for column in expected.description]
    assert table_of(df.columns, df.collect()) == table_of(names, expected.fetchall())
    plan = plan_of(df)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs_without_sql(spark, name):
    rows = QUERIES[name](spark, FOLDER).collect()
    assert rows
    if name == "ivf_train_stats":
        assert sum(r.n_vectors for r in rows) == 500
    if name == "index_smoke":
        assert all(r.found_itself and r.nearest_distance == 0 for r in rows)
    if name == "pq_encode":
        assert len({r.vec_id for r in rows}) == 500 and {r.code_bytes for r in rows} == {8}
    if name == "ivfpq_search":
        assert len(rows) == 100 and {r["rank"] for r in rows} == set(range(1, 11))


def test_entry_has_rows(spark):
    df = entry_module.entry(spark)
    assert df.count() == 100
    assert set(ORACLES) <= set(QUERIES)
