"""Every registered query with an SQL meaning, against DuckDB on the smallest tables."""

import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries

SMALL = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return connection


def canonical(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def text(v):
        if v is None or v != v:
            return "~"
        return str(v)[:10] if hasattr(v, "isoformat") else repr(v)

    return sorted("|".join(text(r[i]) for i in order) for r in data)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_same_rows(spark, duck, name):
    got = queries()[name](spark, SMALL)
    cursor = duck.execute(oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(got.columns) == sorted(columns)
    assert canonical(got.columns, got.collect()) == canonical(columns, cursor.fetchall())


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_plans_have_no_cross_join(spark):
    """No plan pairs rows without a key; model jobs are left out, their plans are Spark ML's."""
    for name in sorted(oracle_sql()):
        plan = queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan, name
