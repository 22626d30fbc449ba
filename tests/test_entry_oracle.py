"""Every registered query against its oracle SQL (DuckDB) on the smallest tables."""
import os
import sys

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import TABLES, norm_frame  # noqa: E402

SF = "/root/testdata/sf0.001"
KEYS = sorted(E.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["user_id", "cluster_distance_norm", "cf_score_norm", "graph_score_norm",
                          "final_anomaly_score", "rank", "cluster"]


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, key):
    sdf = E.queries()[key](spark, SF)
    got = sdf.toPandas()
    sql = E.oracle_sql().get(key)
    if sql is None:
        assert len(got) > 0 and len(got.columns) > 0
        return
    want = duck.execute(sql).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert norm_frame(got) == norm_frame(want)
