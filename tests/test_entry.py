"""Driver contract: entry runs, every key builds, SQL keys agree with DuckDB on sf0.001."""

import os
import sys

import duckdb
import pytest
from conftest import ROOT, SF0001

sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import TABLES, digest  # noqa: E402

SLOW = {"leaderboard", "fit_forest", "fit_gbt", "fit_bagging", "fit_tree", "grid_search", "final_report",
        "knn_score", "score_stream", "score_batch", "fit_logistic"}


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "CUSTOMER_ID_NB_TX_7DAY_WINDOW" in df.columns


def test_oracle_keys_subset_of_queries():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF0001, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", sorted(k for k in E.oracle_sql() if k not in SLOW))
def test_oracle_match_sf0001(spark, duck, name):
    sdf = E.queries()[name](spark, SF0001)
    srows = [tuple(r) for r in sdf.collect()]
    res = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(sdf.columns, srows) == digest(dcols, drows)
