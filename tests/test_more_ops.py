import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsframe.operators import marts, reshape
from obsframe.sources import read_csv_typed


def test_read_csv_typed(spark, tmp_path):
    p = tmp_path / "prices.csv"
    p.write_text("bank,date,Price\nA,2020-01-02,10.5\nB,bad,NA\nC,2021-03-04 10:00:00,abc\n")
    schema = T.StructType([T.StructField("bank", T.StringType()), T.StructField("date", T.DateType()),
                           T.StructField("Price", T.DoubleType())])
    got = {r.bank: (r.date, r.Price) for r in read_csv_typed(spark, str(p), schema).collect()}
    assert str(got["A"][0]) == "2020-01-02" and got["A"][1] == 10.5
    assert got["B"] == (None, None) and str(got["C"][0]) == "2021-03-04" and got["C"][1] is None


def test_composite_index_clips_and_rounds(spark):
    a = spark.createDataFrame([(1, -30.0), (2, 0.0), (3, 40.0), (4, 1.0)], "y int, g double")
    b = spark.createDataFrame([(1, 0.0), (2, 1.234), (3, 0.0), (5, 9.0)], "y int, u double")
    expr = F.lit(18.0) - F.lit(0.8) * F.col("g") + F.lit(0.5) * F.col("u")
    got = {r.y: r["index"] for r in marts.composite_index(a, b, "y", expr, 8.0, 35.0, 2).collect()}
    assert got == {1: 35.0, 2: 18.62, 3: 8.0}                   # inner join: keys 4 and 5 drop


def test_three_way_full_join(spark):
    a = spark.createDataFrame([(2000, 1.0)], "year int, a double")
    b = spark.createDataFrame([(2001, 2.0)], "year int, b double")
    c = spark.createDataFrame([(2000, 3.0), (2002, 4.0)], "year int, c double")
    got = sorted(tuple(r) for r in marts.full_join_on([a, b, c]).select("year", "a", "b", "c").collect())
    assert got == [(2000, 1.0, None, 3.0), (2001, None, 2.0, None), (2002, None, None, 4.0)]


def test_pivot_aggregates_against_pandas(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"year": rng.integers(2000, 2004, 60), "code": rng.choice(list("abc"), 60),
                        "value": np.where(rng.random(60) < 0.2, np.nan, rng.normal(size=60)), "ord": np.arange(60)})
    df = spark.createDataFrame([(int(y), c, None if np.isnan(v) else float(v), int(o))
                                for y, c, v, o in pdf.itertuples(index=False)], "year int, code string, value double, ord int")
    mean = {r.year: r for r in reshape.pivot(df, "year", "code", values=list("abc"), agg="mean").collect()}
    strict = {r.year: r for r in reshape.pivot(df, "year", "code", values=list("abc"), agg="strict_mean").collect()}
    first = {r.year: r for r in reshape.pivot(df, "year", "code", values=list("abc"), agg="first", order_by="ord").collect()}
    for (y, c), g in pdf.groupby(["year", "code"]):
        assert mean[y][c] == pytest.approx(g["value"].mean())              # pandas skips NaN
        s = g["value"].mean(skipna=False)
        assert (strict[y][c] is None) if np.isnan(s) else strict[y][c] == pytest.approx(s)
        nn = g.dropna(subset=["value"]).sort_values("ord")
        assert first[y][c] == (None if nn.empty else pytest.approx(nn["value"].iloc[0]))
    auto = reshape.pivot(df, "year", "code", agg="first", order_by="ord")   # no value list: two-phase path
    assert sorted(auto.columns) == ["a", "b", "c", "year"]
    assert sorted(map(tuple, auto.select("year", "a", "b", "c").collect())) == \
        sorted(map(tuple, reshape.pivot(df, "year", "code", values=list("abc"), agg="first",
                                        order_by="ord").select("year", "a", "b", "c").collect()))
