"""Uniqueness and referential rules of a table in one pass: limits, nulls, mixed key types, empty tables."""

from obsframe.operators import checks


def run(df, rules):
    return {r.test: r for r in checks.run_suite(df, "t", rules).collect()}


def test_limits_nulls_types_and_least_orphans(spark):
    rows = [(i, float(i % 7), f"k{i % 3}", "clash") for i in range(40)] + [(3, 1.0, None, ""), (None, 1.0, "k1", ""), (None, 2.5, "k1", "")]
    df = spark.createDataFrame(rows, "a int, b double, c string, i string")
    ints = spark.createDataFrame([(x,) for x in range(0, 5)] + [(0,)], "r int")
    longs = spark.createDataFrame([(x,) for x in range(20, 60)] + [(None,)], "r long")
    words = spark.createDataFrame([("k0",), ("k1",), ("k2",)], "r string")
    ref = [{"check": "referential", "column": c, "ref": r, "ref_column": "r"} for c, r in (("a", longs), ("b", ints), ("c", words))]
    out = run(df, [{"check": "unique", "columns": ["a", "missing"]}, *ref])
    assert (out["t.a_unique"].observed, out["t.a_unique"].passed) == (2.0, False)  # 3 again, and a second null
    assert out["t.a_referential"].observed == 20 and out["t.a_referential"].details == "sample=0,1,2,3,4,5,6,7,8,9"
    assert out["t.b_referential"].details == "sample=2.5,5.0,6.0" and not out["t.b_referential"].passed
    assert out["t.c_referential"].passed and out["t.c_referential"].details == "sample="
    out = run(df, [{"check": "unique", "columns": ["a"], "max_duplicates": 2}, {**ref[1], "max_orphans": 3}])
    assert out["t.a_unique"].passed and out["t.b_referential"].passed and out["t.a_unique"].bound_high == 2.0
    assert all(r.passed and r.observed == 0 for r in run(df.limit(0), [{"check": "unique", "columns": ["a"]}, *ref]).values())
