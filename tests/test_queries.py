"""Every registered query against its SQL on the smallest tables, and plans without nested-loop joins."""

import os
from pathlib import Path

import duckdb
import pytest

from leafmill.plans import catalog

SF = "/root/testdata/sf0.001"
QUERIES, SQL = catalog.queries(), catalog.oracle_sql()


@pytest.fixture(scope="session")
def duck():
    connection = duckdb.connect()
    for path in sorted(Path(SF).glob("*.parquet")):
        source = f"{path}/*.parquet" if os.path.isdir(path) else path
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{source}'")
    return connection


def shown(frame):
    columns = sorted(frame.columns)
    return frame[columns].astype(str).sort_values(columns).reset_index(drop=True)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    frame = QUERIES[name](spark, SF)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    got = frame.toPandas()
    if name in SQL:
        want = duck.execute(SQL[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert shown(got).equals(shown(want))
    else:
        assert len(got)
