"""Every registered query against its SQL check, at the smallest scale."""

import duckdb
import pytest

import __spark_entry__ as contract
from given_tables import SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
QUERIES, CHECKS = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return connection


def _sorted(rows):
    return sorted((tuple(row) for row in rows), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, duck, name):
    frame = QUERIES[name](spark, SMALL)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    columns = sorted(frame.columns)
    rows = _sorted(frame.select(*[f"`{c}`" for c in columns]).collect())
    assert rows or name in ("stream_late_rows",)
    if name not in CHECKS:
        return
    relation = duck.sql(CHECKS[name])
    order = sorted(range(len(relation.columns)), key=lambda i: relation.columns[i])
    assert [relation.columns[i] for i in order] == columns
    assert rows == _sorted(tuple(row[i] for i in order) for row in relation.fetchall())


def test_entry_has_rows(spark):
    assert not contract.entry(spark).isEmpty()


def test_every_check_has_a_query():
    assert set(CHECKS) <= set(QUERIES)
