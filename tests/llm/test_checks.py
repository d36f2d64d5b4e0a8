"""The queries with SQL on the smallest tables, and the recall that p4_recall measures."""

from pathlib import Path

import duckdb
import numpy as np
import pytest

from lodestar.llm import neighbours as N
from lodestar.llm.registry import ORACLES, QUERIES

ROOT = Path("/root/testdata/sf0.001")


@pytest.mark.skipif(not ROOT.exists(), reason="no test tables")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    duck = duckdb.connect()
    duck.execute("SET timezone = 'UTC'")
    for path in ROOT.glob("*.parquet"):
        duck.execute(f"CREATE VIEW {path.stem} AS FROM '{path}'")
    ours, theirs = QUERIES[name](spark, str(ROOT)).toPandas(), duck.execute(ORACLES[name]).df()
    columns = sorted(ours.columns)
    assert columns == sorted(theirs.columns)
    lines = lambda frame: sorted(map(str, frame[columns].astype(object).where(frame[columns].notna(), None).itertuples(index=False, name=None)))
    assert lines(ours) == lines(theirs)


def test_recall_is_that_of_brute_force(spark, monkeypatch):
    draw = np.random.default_rng(4)
    v = draw.standard_normal((120, 8))
    table = spark.createDataFrame([("s", f"k{i}", i, 8, x.tolist()) for i, x in enumerate(v)] + [("alone", "a", None, 8, v[0].tolist())], "space string, key string, key_no long, size int, vector array<double>")
    items = N.unit_vectors(table)
    queries = items.where("key_no % 20 = 0 OR space = 'alone'")
    monkeypatch.setattr(N, "EXACT_ROWS", 50)
    assert sorted(map(tuple, N.measured_recall(items, queries, 5).collect())) == [("alone", 1, 0, 0), ("s", 6, 30, 30)]

    def other(items, k):
        """Neighbours one of which in five is wrong."""
        near = similar(items, k)
        return near.withColumn("cosine6", N.F.when(N.F.row_number().over(N.W.partitionBy("space", "key").orderBy("cosine6")) == 1, -(10**6)).otherwise(N.F.col("cosine6")))

    similar = N.similar_vectors
    monkeypatch.setattr(N, "similar_vectors", other)
    assert ("s", 6, 30, 24) in map(tuple, N.measured_recall(items, queries, 5).collect())
    assert N.measured_recall(items.limit(0), queries.limit(0), 5).count() == 0
