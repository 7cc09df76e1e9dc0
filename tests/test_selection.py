"""Distributed exact selection against numpy, with small blocks so that every group is refined."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from obsframe.operators import quality, selection, series


@pytest.fixture(scope="module")
def groups():
    rng = np.random.default_rng(3)
    return {"hot": np.concatenate([rng.lognormal(0, 3, 3000), [0.0] * 2000, [1e300, -1e300]]), "small": rng.normal(size=400),
            "one": np.array([4.5]), "same": np.full(900, 7.0), None: rng.integers(0, 9, 700).astype(float)}


@pytest.fixture(scope="module")
def facts(spark, groups):
    rows = [(k, float(x), "clash") for k, v in groups.items() for x in v] + [("hot", None, ""), ("empty", None, "")]
    return spark.createDataFrame(rows, "code string, value double, n string").repartition(5)


def test_quantiles_match_numpy(facts, groups):
    shares = [0.0, 0.05, 0.5, 0.95, 1.0]
    for bins, block in ((4, 20), (16, 100), (64, 10**6)):
        got = {r.code: r for r in selection.quantiles(facts, "code", "value", shares, block, bins).collect()}
        assert set(got) == set(groups)
        for k, v in groups.items():
            assert got[k].n == len(v)
            np.testing.assert_allclose(got[k].q, np.quantile(v, shares), rtol=1e-12, atol=1e-12)


def test_ranks_outside_are_null_and_partitions_do_not_matter(facts, groups):
    def ranks(n):
        return [F.lit(0), F.lit(1), n, n + 1]
    a = selection.order_statistics(facts, "code", "value", ranks, 50, 8)
    b = selection.order_statistics(facts.repartition(2), ["code"], "value", ranks, 50, 8)
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    for r in a.collect():
        assert r.stats == [None, groups[r.code].min(), groups[r.code].max(), None]
    assert selection.order_statistics(facts.limit(0), "code", "value", ranks).count() == 0


def test_describe_refines_a_hot_group(facts, groups):
    got = {r.code: r for r in quality.describe(facts.where("abs(value) < 1e9"), "code", block=50).collect()}
    for k, v in groups.items():
        v = np.sort(v[np.abs(v) < 1e9])
        cut = int(0.1 * len(v))
        med = np.median(v)
        assert got[k].n == len(v)
        np.testing.assert_allclose([got[k].median, got[k].mad, got[k].trimmed],
                                   [med, 1.4826 * np.median(np.abs(v - med)), v[cut:len(v) - cut].mean()], atol=2e-6)
    plan = quality.describe(facts, "code")._jdf.queryExecution().executedPlan().toString()
    assert not any(f in plan for f in ("row_number", "median(", "percentile("))  # nothing sorts or holds a whole group


def test_distributed_winsorize_equals_the_window_form(facts):
    key = ["code", "value", "w"]
    a = series.winsorize(facts, "code", out="w").select(key)
    b = series.winsorize(facts, "code", out="w", distributed=True).select(key)
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
