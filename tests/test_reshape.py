import pytest

from obsframe.operators import reshape
from tests.conftest import rows


def test_unpivot_mixed_types_and_dotted_codes(spark):
    df = spark.createDataFrame([("MAR", 2020, 1, 2.5, "3"), ("FRA", 2020, None, 1.0, "x")],
                               "country string, year int, `NY.GDP.MKTP.CD` int, gdp_pct double, txt string")
    out = reshape.unpivot(df, ["country", "year"])
    got = {(r["country"], r["code"]): r["value"] for r in out.collect()}
    assert got[("MAR", "NY.GDP.MKTP.CD")] == 1.0
    assert got[("MAR", "txt")] == 3.0
    assert got[("FRA", "NY.GDP.MKTP.CD")] is None
    assert got[("FRA", "txt")] is None          # bad text -> NULL, not an error
    assert out.count() == 6
    assert reshape.unpivot(df, ["country", "year"], drop_empty=True).count() == 4


def test_unpivot_suffixed_skips_columns_without_year(spark):
    df = spark.createDataFrame([("MAR", 0.68, 0.70, 74.0, 99.0)],
                               "country string, hdi_2020 double, hdi_2021 double, le_2021 double, hdi_rank double")
    out = rows(reshape.unpivot_suffixed(df, ["country"]), "code", "year")
    assert [(r["code"], r["year"], r["value"]) for r in out] == [
        ("hdi", 2020, 0.68), ("hdi", 2021, 0.70), ("le", 2021, 74.0)]


def test_pivot_first_mean_strict(spark):
    df = spark.createDataFrame([
        (2020, "a", None, 1), (2020, "a", 5.0, 2), (2020, "a", 7.0, 3),
        (2020, "b", 1.0, 4), (2021, "a", 2.0, 5), (2021, "b", None, 6)],
        "year int, code string, value double, ord int")
    first = {r["year"]: r for r in reshape.pivot(df, "year", "code", agg="first", order_by="ord").collect()}
    assert first[2020]["a"] == 5.0 and first[2020]["b"] == 1.0    # first NON-NULL in file order
    assert first[2021]["b"] is None
    mean = {r["year"]: r for r in reshape.pivot(df, "year", "code", agg="mean").collect()}
    assert mean[2020]["a"] == 6.0
    strict = {r["year"]: r for r in reshape.pivot(df, "year", "code", agg="strict_mean").collect()}
    assert strict[2020]["a"] is None and strict[2020]["b"] == 1.0 and strict[2021]["a"] == 2.0


def test_pivot_width_cap(spark):
    df = spark.range(30).selectExpr("1 AS year", "CAST(id AS STRING) AS code", "1.0 AS value")
    with pytest.raises(ValueError):
        reshape.pivot(df, "year", "code", agg="max", max_width=10)


def test_unpivot_pivot_roundtrip(spark):
    wide = spark.createDataFrame([(2019, 1.0, None), (2020, 2.0, 3.0)], "year int, x double, y double")
    long = reshape.unpivot(wide, ["year"], drop_empty=True)
    back = reshape.pivot(long, "year", "code", values=["x", "y"], agg="max")
    assert sorted(map(tuple, back.select("year", "x", "y").collect())) == sorted(map(tuple, wide.collect()))


def test_snapshot_names_and_filter(spark):
    df = spark.createDataFrame([(2020, "IMF", "NGDPD", 1.0), (2020, "IMF", "LUR", 9.0), (2020, "WB", "LUR", 99.0)],
                               "year int, source string, code string, value double")
    from pyspark.sql import functions as F
    out = reshape.snapshot(df, "year", "code", {"gdp": "NGDPD", "unemployment": "LUR"},
                           where=F.col("source") == "IMF").collect()[0]
    assert out["gdp"] == 1.0 and out["unemployment"] == 9.0


def test_densify_null_entity(spark):
    df = spark.createDataFrame([("a", None, 1, 1.0), ("a", None, 3, 3.0), ("b", "x", 2, 5.0)],
                               "code string, entity string, year int, value double")
    out = rows(reshape.densify(df, ["code", "entity"]), "code", "year")
    assert len(out) == 6
    assert [r["value"] for r in out if r["code"] == "a"] == [1.0, None, 3.0]


def test_densify_keeps_repeated_periods_and_null_keys(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 3, None), ("a", 3, 2.0), (None, 2, 5.0), ("b", 9, 1.0)], "k string, year int, value double")
    got = sorted(((r.k, r.year, r.value) for r in reshape.densify(df, ["k"], t_min=1, t_max=3).collect()), key=str)
    want = [("a", 1, 1.0), ("a", 2, None), ("a", 3, None), ("a", 3, 2.0), (None, 1, None), (None, 2, 5.0), (None, 3, None),
            ("b", 1, None), ("b", 2, None), ("b", 3, None)]
    assert got == sorted(want, key=str)
