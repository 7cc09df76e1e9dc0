"""Property tests: interpolation, dedup idempotence, unpivot/pivot identity."""

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from obsframe.operators import clean, reshape, series

values = st.lists(st.one_of(st.none(), st.floats(-1e6, 1e6, allow_nan=False)), min_size=1, max_size=12)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values)
def test_interpolate_matches_numpy(spark, vals):
    df = spark.createDataFrame([("s", 2000 + i, v) for i, v in enumerate(vals)], "code string, year int, value double")
    got = [r["vi"] for r in sorted(series.interpolate(df, "code", out="vi").collect(), key=lambda r: r["year"])]
    known = [(i, v) for i, v in enumerate(vals) if v is not None]
    for i, v in enumerate(vals):
        if v is not None:
            assert got[i] == v                                   # equal to the input at known points
        elif known and known[0][0] < i < known[-1][0]:
            xs, ys = zip(*known)
            assert np.isclose(got[i], np.interp(i, xs, ys), rtol=1e-9, atol=1e-6)
        else:
            assert got[i] is None                                # no extrapolation


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(1990, 1995),
                          st.one_of(st.none(), st.floats(-10, 10, allow_nan=False))), min_size=1, max_size=15))
def test_dedup_and_roundtrip(spark, rows):
    df = spark.createDataFrame([("S", "D", "c", "c", e, str(y), None if v is None else repr(v), i)
                                for i, (e, y, v) in enumerate(rows)],
                               "source string, dataset string, code string, name string, entity string, "
                               "year string, value string, row_order int")
    once = clean.clean_long(df)
    keys = {(e, y) for e, y, _ in rows}
    assert once.count() == len(keys)                             # one row per key, NULL entity included
    twice = clean.dedup_first(once.withColumn("row_order", once.year), order_by="row_order")
    assert twice.count() == once.count()
    wide = reshape.pivot(once.filter("value IS NOT NULL"), ["entity"], "year", values=list(range(1990, 1996)),
                         agg="max", names={y: str(y) for y in range(1990, 1996)})
    back = reshape.unpivot(wide, ["entity"], [str(y) for y in range(1990, 1996)], "y", "value", drop_empty=True)
    assert back.count() == once.filter("value IS NOT NULL").count()
