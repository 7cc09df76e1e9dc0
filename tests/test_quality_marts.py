import numpy as np
import pytest

from obsframe.operators import clean, marts, quality
from tests.conftest import rows


def test_dimension_and_quality_report(spark):
    df = spark.createDataFrame([("WB", "WDI", "a", "A", None, 2000, 1.0), ("WB", "WDI", "a", "A", None, 2001, None),
                                ("WB", "WDI", "a", "A", None, 2002, None), ("WB", "WDI", "a", "A", None, 2003, 2.0)],
                               "source string, dataset string, code string, name string, entity string, year int, value double")
    d = quality.dimension(df).collect()[0]
    assert (d.years_min, d.years_max, d.n_obs) == (2000, 2003, 2)
    q = quality.quality_report(df).collect()[0]
    assert (q.n_total, q.n_nonnull, q.n_missing, q.pct_missing, q.pct_complete) == (4, 2, 2, 50.0, 50.0)


def test_describe_matches_numpy(spark):
    x = [1.0, 2.0, 2.0, 3.0, 7.0, 9.0, 10.0, 11.0, 15.0, 40.0, 41.0]
    df = spark.createDataFrame([("a", v) for v in x], "code string, value double")
    r = quality.describe(df).collect()[0]
    a = np.array(x)
    n = len(a)
    assert r.median == pytest.approx(np.median(a))
    cut = int(0.1 * n)
    assert r.trimmed == pytest.approx(np.sort(a)[cut:n - cut].mean())
    assert r.mad == pytest.approx(1.4826 * np.median(np.abs(a - np.median(a))), rel=1e-6)
    m2, m3 = ((a - a.mean()) ** 2).mean(), ((a - a.mean()) ** 3).mean()
    g1 = m3 / m2 ** 1.5
    assert r.skew == pytest.approx(g1 * ((n - 1) / n) ** 1.5, rel=1e-5)
    assert r.se == pytest.approx(a.std(ddof=1) / np.sqrt(n), rel=1e-5)


def test_usable_codes(spark):
    df = spark.createDataFrame([("const", 1.0), ("const", 1.0), ("one", 1.0), ("ok", 1.0), ("ok", 2.0)],
                               "code string, value double")
    assert [r.code for r in quality.usable_codes(df).collect()] == ["ok"]


def test_benchmark_rank_ties_and_latest(spark):
    data = [("gdp", "MAR", "AF", 2020, 5.0), ("gdp", "EGY", "AF", 2020, 5.0), ("gdp", "FRA", "EU", 2020, 9.0),
            ("gdp", "NOR", None, 2020, 1.0), ("gdp", "MAR", "AF", 2021, None), ("gdp", "FRA", "EU", 2021, 3.0)]
    df = spark.createDataFrame(data, "indicator string, entity string, region string, year int, value double")
    r = marts.parity(marts.benchmark_rank(df, "MAR")).collect()[0]
    assert r.year == 2020                      # subject has no value in 2021: its latest non-null year
    assert r.subject_rank == 2                 # 1 + strictly greater (the tie with EGY does not count)
    assert r.rank_out_of == 4 and r.world_avg == pytest.approx(5.0)
    assert r.group_avg == pytest.approx(5.0) and r.region == "AF"
    assert r.parity_ratio == pytest.approx(1.0) and r.above_peer is False


def test_precedence_and_year_panel(spark):
    pref = spark.createDataFrame([(1, 10.0), (2, None)], "k int, value double")
    fall = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 3.0)], "k int, value double")
    out = {r.k: (r.value, r.source_rank) for r in marts.precedence_merge([pref, fall], ["k"]).collect()}
    assert out == {1: (10.0, 0), 2: (2.0, 1), 3: (3.0, 1)}
    facts = spark.createDataFrame([(2020, "x"), (2021, "y"), (1850, "z")], "year int, e string")
    panel = spark.createDataFrame([(2020, 1.0), (1850, 2.0)], "year int, p double")
    j = {r.e: r.p for r in marts.join_year_panel(facts, panel).collect()}
    assert j == {"x": 1.0, "y": None, "z": 2.0}


def test_latest_rows_and_entity_summary(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 2.0), ("a", 2, 3.0), ("b", 1, 1.0)],
                               "indicator string, year int, value double")
    assert marts.latest_rows(df, ["indicator"]).count() == 3
    p = spark.createDataFrame([("bk", 2020, 10.0), ("bk", 2020, 0.0)], "entity string, year int, price double")
    r = marts.entity_year_summary(p).collect()[0]
    assert r.sessions == 2 and r.range_volatility_pct is None   # min = 0 -> NULL, no error
    assert rows(p) is not None


def test_hot_key_plans_reduce_before_shuffle(spark):
    """A key holding a third of all rows: dedup and rank are partial aggregates, never whole-group windows."""
    from obsframe.operators import clean
    n = 3000
    df = spark.range(n).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE CAST(id AS STRING) END AS code", "'S' AS source", "'D' AS dataset",
        "CAST(NULL AS STRING) AS entity", "2000 AS year", "CAST(id AS DOUBLE) AS value", "'n' AS name",
        "id AS row_order")
    d = clean.dedup_first(df)
    plan = d._jdf.queryExecution().executedPlan().toString()
    assert "partial_min(" in plan and "Window" not in plan and "LeftSemi" in plan
    got = {r.code: r.value for r in d.collect()}
    assert got["hot"] == 0.0 and len(got) == 1 + 2 * n // 3
    # the (indicator, year) group of year 2000 holds a third of all rows
    panel = spark.range(n).selectExpr("'gdp' AS indicator", "CONCAT('e', id) AS entity", "'R' AS region",
                                      "CASE WHEN id % 3 = 0 THEN 2000 ELSE 2001 + CAST(id % 7 AS INT) END AS year",
                                      "CAST(id AS DOUBLE) AS value")
    b = marts.benchmark_rank(panel, "e0")
    bplan = b._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in bplan and "partial_count" in bplan
    r = b.collect()[0]
    assert (r.year, r.subject_value, r.rank_out_of, r.subject_rank) == (2000, 0.0, n // 3, n // 3)


def test_measured_broadcast_checks_size(spark):
    from obsframe.operators.joins import measured_broadcast
    small = spark.range(5)
    big = spark.range(50)
    facts = spark.range(1000).selectExpr("id % 50 AS id")
    plan = lambda d: facts.join(d, "id")._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in plan(measured_broadcast(small, 10)).lower()
    assert "broadcast" not in plan(measured_broadcast(big, 10)).lower()


def test_describe_approx_close_to_exact(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(50, 10, 4000)
    df = spark.createDataFrame([("hot" if i % 3 else "cold", float(v)) for i, v in enumerate(x)], "code string, value double")
    exact = {r.code: r for r in quality.describe(df).collect()}
    approx = {r.code: r for r in quality.describe_approx(df).collect()}
    plan = quality.describe_approx(df)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    for c in ("hot", "cold"):
        e, a = exact[c], approx[c]
        assert a.n == e.n and a.mean == pytest.approx(e.mean, abs=1e-6) and a.skew == pytest.approx(e.skew, abs=1e-6)
        assert abs(a.median - e.median) < 0.5 and abs(a.trimmed - e.trimmed) < 0.5 and abs(a.mad - e.mad) < 0.5


def test_year_panel_is_not_cut_and_must_be_unique(spark):
    facts = spark.createDataFrame([(1700, 1), (2020, 2), (2500, 3)], "year int, x int")
    panel = spark.createDataFrame([(1700, 1.0), (2020, 2.0), (2500, 3.0)], "year int, gdp double")
    assert sorted((r.year, r.gdp) for r in marts.join_year_panel(facts, panel).collect()) == [(1700, 1.0), (2020, 2.0), (2500, 3.0)]
    with pytest.raises(ValueError):
        marts.join_year_panel(facts, panel.union(panel))


def test_keep_first_with_ties_and_null_orders(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, 5), ("b", 3, None), ("c", 4, 1), ("c", 4, 1), ("d", 6, None), ("d", 7, 2)], "k string, v int, row_order int")
    for d in (df, df.repartition(5)):
        got = sorted((r.k, r.v) for r in clean.dedup_first(d, ["k"]).collect())
        assert [k for k, _ in got] == ["a", "b", "c", "d"] and got[3] == ("d", 7)
    assert clean.dedup_first(df, ["k"]).collect().__len__() == 4
