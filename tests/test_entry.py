"""The driver contract, and the oracle comparison for a fast subset at sf0.001."""

import duckdb
import pytest

import __spark_entry__ as se
from tests.conftest import SF_SMALL

FAST = ["dim_indicators", "economy_snapshot", "indicators_clean", "run_counters", "quality_report", "pivot_first",
        "pivot_strict_mean", "benchmark_rank", "interpolate", "panel_clean", "describe", "corr_matrix",
        "lineitem_checks", "alert_routing", "forecast_ar1", "orphan_keys"]


def test_entry_runs(spark):
    df = se.entry(spark)
    assert df.columns == ["source", "dataset", "code", "name", "years_min", "years_max", "n_obs"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    q, o = se.queries(), se.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 70


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    return v


@pytest.mark.parametrize("name", FAST)
def test_matches_duckdb(spark, name):
    con = duckdb.connect()
    for t in ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    sdf = se.queries()[name](spark, SF_SMALL).toPandas()
    odf = con.execute(se.oracle_sql()[name]).df()
    assert sorted(sdf.columns) == sorted(odf.columns)
    cols = sorted(sdf.columns)
    key = lambda r: tuple((x is None, str(x)) for x in r)
    a = sorted((tuple(_norm(None if v != v else v) for v in r) for r in sdf[cols].astype(object).itertuples(index=False)), key=key)
    b = sorted((tuple(_norm(None if v != v else v) for v in r) for r in odf[cols].astype(object).itertuples(index=False)), key=key)
    assert len(a) == len(b)
    assert [tuple(map(str, r)) for r in a] == [tuple(map(str, r)) for r in b]
