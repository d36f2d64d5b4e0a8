"""Every core query with SQL gives what DuckDB gives on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from lodestar.plans.registry import ORACLES, QUERIES

ROOT = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute("SET timezone = 'UTC'")
    for path in ROOT.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS FROM '{path}'")
    return connection


def lines(frame, columns):
    return sorted(map(str, frame[columns].astype(object).where(frame[columns].notna(), None).itertuples(index=False, name=None)))


@pytest.mark.skipif(not ROOT.exists(), reason="no test tables")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, duck, name):
    ours, theirs = QUERIES[name](spark, str(ROOT)).toPandas(), duck.execute(ORACLES[name]).df()
    columns = sorted(ours.columns)
    assert columns == sorted(theirs.columns)
    assert lines(ours, columns) == lines(theirs, columns)
