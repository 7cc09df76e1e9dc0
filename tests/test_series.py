import math

import numpy as np
import pytest

from obsframe.operators import series
from tests.conftest import rows

S = "code string, year int, value double"


def _panel(spark):
    data = [("g", y, v) for y, v in zip(range(2000, 2007), [None, 1.0, None, None, 4.0, None, None])]
    data += [("c", y, 5.0) for y in range(2000, 2003)]                   # constant
    data += [("one", 2000, None), ("one", 2001, 3.0), ("one", 2002, None)]  # single value
    data += [("none", 2000, None), ("none", 2001, None)]                  # all NULL
    return spark.createDataFrame(data, S)


def test_interpolate_interior_only(spark):
    out = rows(series.interpolate(_panel(spark), "code", out="vi"), "code", "year")
    g = [r["vi"] for r in out if r["code"] == "g"]
    assert g[0] is None and g[5] is None and g[6] is None          # leading / trailing gaps stay empty
    assert g[1:5] == [1.0, 2.0, 3.0, 4.0]
    assert [r["vi"] for r in out if r["code"] == "one"] == [None, 3.0, None]
    assert all(r["vi"] is None for r in out if r["code"] == "none")


def test_interpolate_position_axis(spark):
    df = spark.createDataFrame([("a", 2000, 0.0), ("a", 2001, None), ("a", 2010, 10.0)], S)
    by_year = rows(series.interpolate(df, "code", out="vi"), "year")
    by_pos = rows(series.interpolate(df, "code", axis="position", out="vi"), "year")
    assert by_year[1]["vi"] == pytest.approx(1.0)
    assert by_pos[1]["vi"] == pytest.approx(5.0)


def test_chain_invariants(spark):
    out = series.chain_clean(_panel(spark), "code")
    got = rows(out, "code", "year")
    one = [r["v_filled"] for r in got if r["code"] == "one"]
    assert one == [3.0, 3.0, 3.0]                                   # mean fill of a single value
    assert all(r["v_scaled"] is None for r in got if r["code"] in ("c", "one"))   # sd = 0 -> NULL
    g = [r for r in got if r["code"] == "g"]
    filled = [r["v_filled"] for r in g]
    lo, hi = np.quantile(filled, [0.05, 0.95])
    assert all(lo - 1e-12 <= r["v_winsor"] <= hi + 1e-12 for r in g)
    z = np.array([r["v_scaled"] for r in g])
    assert abs(z.mean()) < 1e-9 and abs(z.std(ddof=1) - 1) < 1e-9


def test_cagr_counts_rows_not_years(spark):
    df = spark.createDataFrame([("a", 2000, 100.0), ("a", 2005, None), ("a", 2010, 121.0), ("a", 2011, None)], S)
    r = series.cagr(df, "code").collect()[0]
    assert r["n"] == 2 and r["cagr"] == pytest.approx(0.21)


def test_scenarios(spark):
    df = spark.createDataFrame([("a", 2000, 100.0, None), ("a", 2001, 110.0, 10.0), ("a", 2002, 99.0, -10.0)],
                               "code string, year int, value double, growth double")
    out = rows(series.growth_scenarios(df, "code", horizon=2), "h")
    mu, sd = 0.0, math.sqrt(200.0)
    assert out[0]["year"] == 2003 and out[1]["year"] == 2004
    assert out[1]["base"] == pytest.approx(99.0)
    assert out[1]["pessimiste"] == pytest.approx(99.0 * (1 + (mu - sd) / 100) ** 2)


def test_forecasts_against_numpy(spark):
    y = [10.0, 12.0, 11.0, 15.0, 16.0, 18.0]
    df = spark.createDataFrame([("a", 2000 + i, v) for i, v in enumerate(y)], S)
    drift = rows(series.forecast(df, "code", horizon=3, method="drift"), "h")
    d = np.diff(y)
    assert drift[2]["forecast"] == pytest.approx(y[-1] + 3 * d.mean())
    hw = 1.96 * d.std(ddof=1) * math.sqrt(3 * (1 + 3 / (len(y) - 1)))
    assert drift[2]["hi95"] - drift[2]["forecast"] == pytest.approx(hw)
    ar = rows(series.forecast(df, "code", horizon=2, method="ar1"), "h")
    x, t = np.array(y[:-1]), np.array(y[1:])
    phi, c = np.polyfit(x, t, 1)
    if abs(phi) < 1:
        mu = c / (1 - phi)
        assert ar[1]["forecast"] == pytest.approx(mu + phi ** 2 * (y[-1] - mu))
    else:
        assert ar[1]["method"] == "drift"


def test_rolling_regime_gap(spark):
    df = spark.createDataFrame([("a", 2000, 100.0), ("a", 2001, 100.5), ("a", 2002, 90.0)], S)
    r = rows(series.regime(df, "code"), "year")
    assert [x["regime"] for x in r] == [None, "flat", "down"]
    rs = rows(series.rolling_sd(df, "code", window=2), "year")
    assert rs[0]["rolling_sd"] is None and rs[1]["rolling_sd"] == pytest.approx(np.std([100, 100.5], ddof=1))
    g = spark.createDataFrame([(2000, "m", 5.0), (2000, "f", 7.0)], "year int, code string, value double")
    assert series.series_gap(g, "year", "code", "m", "f").collect()[0]["gap"] == -2.0


def _auto(y, horizon, top=3):
    """Yule-Walker equations solved order by order, AICc and recursions by plain loops."""
    best = None
    for d in (0, 1):
        x = np.diff(y) if d else np.asarray(y, float)
        n, m = len(x), x.mean() if len(x) else 0.0
        c = [float((x[k:] - m) @ (x[:n - k] - m)) / n for k in range(min(top, n - 1) + 1)] if n else []
        c += [0.0] * (top + 1 - len(c))
        for p in range(top + 1):
            if c[0] <= 0:
                phi, v = np.zeros(p), 0.0
            else:
                phi = np.linalg.solve([[c[abs(i - j)] for j in range(p)] for i in range(p)], c[1:p + 1]) if p else np.zeros(0)
                v = c[0] - phi @ np.array(c[1:p + 1])
            k = p + 2
            if p == 0 and d == 0 and c[0] <= 0:
                score = -1e300
            elif n > k + 1 and v > 0:
                score = np.log(v) + 2 * k / n + 2 * k * (k + 1) / (n * (n - k - 1))
            elif p == 0 and d == 0:
                score = 1e300
            else:
                continue
            if best is None or score < best[0]:
                best = (score, d, p, phi, v, m, x)
    _, d, p, phi, v, m, x = best
    past, psi, level, out, var = list(x - m), [1.0], y[-1], [], 0.0
    for h in range(1, horizon + 1):
        new = sum(phi[i] * past[-1 - i] for i in range(p))
        past.append(new)
        level = level + m + new if d else m + new
        var += v * (sum(psi) if d else psi[-1]) ** 2
        out.append((h, d, p, level, level - 1.96 * var ** 0.5, level + 1.96 * var ** 0.5))
        psi.append(sum(phi[i] * psi[-1 - i] for i in range(min(p, len(psi)))))
    return out


def test_forecast_auto_against_numpy(spark):
    rng = np.random.default_rng(2)
    models = {"ar1": [0.8], "ar2": [0.5, 0.4], "ar3": [0.4, -0.5, 0.6]}
    data = {"walk": np.cumsum(rng.normal(0.5, 1, 80)), "short": np.array([1.0, 5.0, 2.0]), "one": np.array([4.0]), "flat": np.full(30, 7.0), "line": np.arange(40.0)}
    for name, phi in models.items():
        y = [0.0] * 3
        for e in rng.normal(size=1500):
            y.append(sum(a * y[-1 - i] for i, a in enumerate(phi)) + e)
        data[name] = np.array(y[500:]) + 1000
    rows = [(k, 1900 + i, float(v)) for k, y in data.items() for i, v in enumerate(y)] + [("ar1", 5000, None), ("walk", 6000, float("nan"))]
    df = spark.createDataFrame(rows, "code string, year int, value double")
    for parts in (2, 16):
        got = {}
        for r in series.forecast_auto(df.repartition(parts), "code", horizon=12).collect():
            got.setdefault(r.code, []).append((r.h, r["diff"], r.order, r.forecast, r.lo95, r.hi95))
        for k, y in data.items():
            want = _auto(y, 12)
            assert [r[:3] for r in sorted(got[k])] == [r[:3] for r in want], k
            assert np.allclose([r[3:] for r in sorted(got[k])], [r[3:] for r in want], rtol=1e-8, atol=1e-8), k
        assert all(got[k][0][1] == 0 and got[k][0][2] >= len(phi) for k, phi in models.items())  # AICc may take a larger order, not a smaller
