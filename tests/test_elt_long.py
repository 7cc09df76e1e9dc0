"""The long table in generated SQL: provenance, suffix years, NULLs and odd column names."""

from obsframe.plans.etl import elt_long


def test_columns_become_tagged_rows_without_nulls(spark):
    wide = spark.createDataFrame([("MA", 2001, 1, "x", None), ("FR", 2002, None, "7.5", 2.0)], "country string, yr int, a int, `odd ``name` string, b double")
    suffixed = spark.createDataFrame([("MA", 3.0, None, 9.0), (None, 4.0, 5.0, 9.0)], "country string, hdi_2000 double, hdi_2001 double, hdi_all double")
    raw = [{"view": "v_wide", "source": "it's", "dataset": "d1", "entity": "country", "year": "yr", "ids": ["b"]},
           {"view": "v_hdi", "source": "s", "dataset": "d2", "entity": "country"}]
    out = elt_long(spark, raw, {"v_wide": wide, "v_hdi": suffixed})
    assert out.columns == ["source", "dataset", "code", "name", "entity", "year", "value"]
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, [
        ("it's", "d1", "a", "a", "MA", 2001, 1.0), ("it's", "d1", "odd `name", "odd `name", "FR", 2002, 7.5),
        ("s", "d2", "hdi", "hdi", "MA", 2000, 3.0), ("s", "d2", "hdi", "hdi", None, 2000, 4.0), ("s", "d2", "hdi", "hdi", None, 2001, 5.0)]))
