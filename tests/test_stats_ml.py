import numpy as np
import pandas as pd
import pytest

from obsframe.operators import ml, stats


def test_corr_matrix_pairwise_complete(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame(rng.normal(size=(40, 4)), columns=list("abcd"))
    pdf.iloc[::3, 1] = np.nan
    pdf.iloc[::5, 2] = np.nan
    pdf["d"] = 7.0                                  # constant -> NULL correlation
    long = [(i, c, None if np.isnan(v) else float(v)) for i, row in pdf.iterrows() for c, v in row.items()]
    df = spark.createDataFrame(long, "t int, code string, value double")
    got = {(r.code_a, r.code_b): r.corr for r in stats.corr_matrix(df, "t").collect()}
    ref = pdf.corr()                                # pandas: pairwise complete
    for (a, b), v in got.items():
        if "d" in (a, b):
            assert v is None
        else:
            assert v == pytest.approx(ref.loc[a, b], abs=1e-9)
    assert len(got) == 6


def test_pearson_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (1.0, None)], "x double, y double")
    r = stats.pearson(df, "x", "y").collect()[0]
    assert r.corr is None and r.n_pairs == 2


def test_ols_table_matches_lstsq(spark):
    rng = np.random.default_rng(0)
    X = rng.normal(size=(50, 2))
    y = 1.5 + X @ np.array([2.0, -1.0]) + rng.normal(scale=0.1, size=50)
    df = spark.createDataFrame([(float(a), float(b), float(c)) for (a, b), c in zip(X, y)], "x1 double, x2 double, y double")
    t = {r.term: r.estimate for r in stats.ols_table(df, "y", ["x1", "x2"]).collect()}
    beta = np.linalg.lstsq(np.c_[X, np.ones(50)], y, rcond=None)[0]
    assert t["x1"] == pytest.approx(beta[0], rel=1e-6) and t["(Intercept)"] == pytest.approx(beta[2], rel=1e-6)


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 1.5), (3.0, 3.0)], "label double, prediction double")
    r = stats.regression_metrics(df).collect()[0]
    assert r.rmse == pytest.approx(np.sqrt((0.25 + 0.25 + 0) / 3))
    assert r.r2 == pytest.approx(1 - 0.5 / 2.0)


def test_split_balanced_and_deterministic(spark):
    df = spark.range(5000).selectExpr("id", "CAST(id % 97 AS DOUBLE) AS y")
    a = ml.stratified_split(df, "y", ["id"])
    frac = a.filter("is_train").count() / 5000
    assert 0.77 < frac < 0.83
    b = ml.stratified_split(df.repartition(7), "y", ["id"])
    assert a.filter("is_train").select("id").exceptAll(b.filter("is_train").select("id")).count() == 0


def test_kmeans_and_pca(spark):
    pts = [(i, float(c + 0.01 * i), float(c - 0.02 * i)) for c in (0, 10, 20) for i in range(10)]
    df = spark.createDataFrame([(k * 100 + i, x, y) for k, (i, x, y) in enumerate(pts)], "id int, x double, y double")
    labels, cost = ml.kmeans_best_of(df, "id", ["x", "y"], k=3, starts=3)
    assert labels.select("cluster").distinct().count() == 3
    pca = ml.pca_variance(df, ["x", "y"]).collect()
    assert sum(r.variance_explained for r in pca) == pytest.approx(1.0)


def _linear_panel(spark, n=120):
    rng = np.random.default_rng(7)
    X = rng.normal(size=(n, 3))
    y = 3.0 + X @ np.array([2.0, 0.0, -1.0]) + rng.normal(scale=0.05, size=n)
    rows = [(i, float(a), float(b), float(c), float(t)) for i, ((a, b, c), t) in enumerate(zip(X, y))]
    df = spark.createDataFrame(rows, "k int, x1 double, x2 double, x3 double, y double")
    return df.filter("k % 5 != 0"), df.filter("k % 5 = 0")


def test_forest_lasso_ridge_residuals(spark):
    tr, te = _linear_panel(spark)
    feats = ["x1", "x2", "x3"]
    metrics, imp = ml.random_forest_cv(tr, te, "y", feats, num_trees=10, folds=2, max_depth=4)
    m = metrics.collect()[0]
    assert m.n == 24 and m.r2_corr > 0.5
    top = imp.collect()
    assert top[0].importance == 100.0 and top[0].feature == "x1"      # rescaled so the top is 100
    lm, coefs = ml.lasso_cv(tr, te, "y", feats, folds=2)
    c = {r.term: r.estimate for r in coefs.collect()}
    assert abs(c["x1"] - 2.0) < 0.2 and abs(c["x2"]) < 0.1              # the irrelevant feature shrinks
    assert lm.collect()[0].r2 > 0.95
    rl = {r.model: r for r in ml.ridge_vs_lasso(tr, te, "y", feats).collect()}
    assert set(rl) == {"ridge", "lasso"} and rl["lasso"].r2_gap == pytest.approx(rl["lasso"].r2_train - rl["lasso"].r2_test)
    res = ml.residuals(te.withColumn("prediction", te.y - 1.0), "y").collect()
    assert all(r.residual == pytest.approx(1.0) for r in res)


def test_logit_table_matches_newton(spark):
    rng = np.random.default_rng(5)
    X = rng.normal(size=(400, 2))
    p = 1 / (1 + np.exp(-(0.5 + X @ np.array([1.5, -1.0]))))
    y = (rng.random(400) < p).astype(float)
    df = spark.createDataFrame([(float(a), float(b), float(t)) for (a, b), t in zip(X, y)], "x1 double, x2 double, y double")
    got = {r.term: r for r in stats.logit_table(df, "y", ["x1", "x2"]).collect()}
    A = np.c_[X, np.ones(len(X))]
    beta = np.zeros(3)
    for _ in range(25):                                   # Newton-Raphson / IRLS
        mu = 1 / (1 + np.exp(-A @ beta))
        W = mu * (1 - mu)
        beta += np.linalg.solve(A.T @ (A * W[:, None]), A.T @ (y - mu))
    se = np.sqrt(np.diag(np.linalg.inv(A.T @ (A * W[:, None]))))
    for i, term in enumerate(["x1", "x2", "(Intercept)"]):
        assert got[term].estimate == pytest.approx(beta[i], rel=1e-4)
        assert got[term].std_error == pytest.approx(se[i], rel=1e-3)
    empty = stats.logit_table(df.withColumn("y", df.y * 0), "y", ["x1", "x2"])
    assert empty.count() == 0                              # fewer than 2 positives: no fit


def test_split_is_balanced_in_every_stratum(spark):
    df = spark.createDataFrame([(i, float(i * i % 997)) for i in range(900)] + [(900 + i, None) for i in range(100)], "k int, y double")
    a = ml.stratified_split(df, "y", ["k"]).collect()
    b = ml.stratified_split(df.repartition(13), "y", ["k"]).collect()
    assert {(r.k, r.stratum, r.is_train) for r in a} == {(r.k, r.stratum, r.is_train) for r in b}
    for s in {r.stratum for r in a}:
        of = [r.is_train for r in a if r.stratum == s]
        assert abs(sum(of) - 0.8 * len(of)) <= 1
    assert {r.stratum for r in a if r.y is None} == {-1}


def test_correlation_keeps_precision_with_an_offset(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=300)
    y = x + 0.5 * rng.normal(size=300)
    rows = [(i, "a", 1e9 + float(x[i])) for i in range(300)] + [(i, "b", 1e9 + float(y[i])) for i in range(300)] + [(300, "a", float("nan"))]
    got = stats.corr_matrix(spark.createDataFrame(rows, "t int, code string, value double"), "t").first()
    assert got.n_pairs == 300 and abs(got["corr"] - np.corrcoef(x, y)[0, 1]) < 1e-5


def test_fits_do_not_depend_on_partitions(spark):
    rng = np.random.default_rng(5)
    df = spark.createDataFrame([(i, *map(float, rng.normal(size=2) + 3 * (i % 3))) for i in range(150)], "k int, a double, b double")
    fits = [sorted(map(tuple, ml.kmeans_best_of(d, "k", ["a", "b"], starts=2)[0].collect()))
            for d in (df.repartition(2, "k"), df.repartition(8, "a"))]
    assert fits[0] == fits[1]
    # the labels are those of numpy's nearest centres
    x = np.array([(r.a, r.b) for r in df.orderBy("k").collect()])
    z = (x - x.mean(0)) / x.std(0, ddof=1)
    lab = np.array([c for _, c in fits[0]])
    centre = np.stack([z[lab == c].mean(0) for c in range(3)])
    assert (((z[:, None] - centre) ** 2).sum(2).argmin(1) == lab).all()


def test_pca_against_numpy(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(80, 3)) @ rng.normal(size=(3, 3))
    got = [r.variance_explained for r in ml.pca_variance(spark.createDataFrame(x.tolist(), ["a", "b", "c"]), ["a", "b", "c"]).orderBy("component").collect()]
    w = np.sort(np.linalg.eigvalsh(np.corrcoef(x.T)))[::-1]
    assert np.allclose(got, w / w.sum())


def _panel(spark, n=600):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(n, 4)) * [1, 10, 0.1, 5] + [0, 1e6, 3, -2]
    y = 5 + 2 * x[:, 0] + np.where(x[:, 3] > -2, 4.0, -4.0) + 0.3 * (x[:, 1] - 1e6) + rng.normal(scale=0.5, size=n)
    df = spark.createDataFrame([(i, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))] + [(n, None, 1.0, 1.0, 1.0, 1.0)],
                               "k int, a double, b double, c double, d double, y double")
    return df, x, y


def test_moments_merge_with_an_offset(spark):
    df, x, y = _panel(spark)
    from obsframe.operators import moments
    cols = ["a", "b", "c", "d", "y"]
    rows = moments.complete(df, cols, ["k"]).withColumn("g", df.k % 7)
    m = moments.total(list(moments.comoments(rows.repartition(16), cols, "g").values()), 5)
    z = np.c_[x, y]
    assert m.n == 600 and np.allclose(m.mean, z.mean(0)) and np.allclose(m.comoment, np.cov(z.T, ddof=0) * 600, rtol=1e-8)


def test_lasso_against_an_independent_solver(spark):
    """Proximal gradient steps on the rows themselves, fold by fold."""
    df, x, y = _panel(spark)
    feats, lambdas = ["a", "b", "c", "d"], [0.01, 0.1, 1.0]
    fold = {r.k: r.f for r in df.dropna().select("k", ml._fold(["k"], 5, 42).alias("f")).collect()}
    f = np.array([fold[i] for i in range(600)])

    def fit(x, y, p):
        z, c = (x - x.mean(0)) / x.std(0), y - y.mean()
        g, rate = np.zeros(4), 1 / np.linalg.eigvalsh(z.T @ z / len(z)).max()
        for _ in range(3000):
            v = g - rate * (z.T @ (z @ g - c) / len(z))
            g = np.sign(v) * np.maximum(np.abs(v) - rate * p, 0)
        return g / x.std(0), y.mean() - x.mean(0) @ (g / x.std(0))

    error = []
    for p in lambdas:
        each = [np.sqrt(np.mean((y[f == i] - x[f == i] @ b - c) ** 2)) for i in range(5) for b, c in [fit(x[f != i], y[f != i], p)]]
        error.append(np.mean(each))
    best = lambdas[int(np.argmin(error))]
    for parts in (2, 16):
        metrics, coefs = ml.lasso_cv(df.repartition(parts), df, "y", feats, lambdas=lambdas, key=["k"])
        assert metrics.first()["lambda"] == best
        b, c = fit(x, y, best)
        got = {r.term: r.estimate for r in coefs.collect()}
        assert np.allclose([got[t] for t in feats], b, rtol=1e-6, atol=1e-9) and got["(Intercept)"] == pytest.approx(c, rel=1e-6)


def test_ridge_and_lasso_equal_spark_ml(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    from obsframe.operators import moments
    df, _, _ = _panel(spark)
    feats = ["a", "b", "c", "d"]
    rows = VectorAssembler(inputCols=feats, outputCol="v").transform(df.dropna())
    m = moments.comoments(df.dropna(), [*feats, "y"])[None]
    for penalty, alpha, fit in ((10.0, 0.0, moments.ridge(m, 10.0)), (0.1, 1.0, moments.lasso(m, [0.1])[0])):
        model = LinearRegression(featuresCol="v", labelCol="y", regParam=penalty, elasticNetParam=alpha, tol=1e-12, maxIter=1000).fit(rows)
        assert np.allclose(model.coefficients.toArray(), fit.beta, rtol=1e-4, atol=1e-7), (model.coefficients, fit)


def test_kmeans_cost_is_not_above_spark_ml(spark):
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(size=(60, 2)) + c for c in ((0, 0), (4, 1), (1, 5))])
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(x)], "k int, a double, b double")
    z = (x - x.mean(0)) / x.std(0, ddof=1)
    rows = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(spark.createDataFrame(z.tolist(), ["a", "b"]))
    least = min(KMeans(k=3, seed=s, maxIter=50).fit(rows).summary.trainingCost for s in range(3))
    found = [ml.kmeans_best_of(d, "k", ["a", "b"], starts=10) for d in (df.repartition(2), df.repartition(16))]
    assert all(cost <= least * (1 + 1e-6) for _, cost in found)
    assert len({tuple(sorted(map(tuple, labels.collect()))) for labels, _ in found}) == 1


def test_forest_against_spark_ml_and_partitions(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import RandomForestRegressor
    df, _, _ = _panel(spark)
    df = df.dropna()
    tr, te, feats = df.filter("k % 4 > 0"), df.filter("k % 4 = 0"), ["a", "b", "c", "d"]
    found = [(m.first(), imp.collect()) for m, imp in (ml.random_forest_cv(tr.repartition(n), te, "y", feats, num_trees=30, folds=3, key=["k"]) for n in (2, 16))]
    assert found[0][1] == found[1][1] and found[0][0].r2 == pytest.approx(found[1][0].r2, abs=1e-9)
    va = VectorAssembler(inputCols=feats, outputCol="v")
    model = RandomForestRegressor(featuresCol="v", labelCol="y", numTrees=30, maxDepth=5, seed=1, featureSubsetStrategy="all").fit(va.transform(tr))
    theirs = stats.regression_metrics(model.transform(va.transform(te)), "y", "prediction").first()
    assert found[0][0].r2 > theirs.r2 - 0.02


def test_p_values_of_t():
    """Simpson's rule on Student's density."""
    import math

    from obsframe.operators import moments
    for t, v in ((0.5, 3), (2.1, 10), (1.0, 1), (3.3, 200), (-1.7, 30)):
        x = np.linspace(0, abs(t), 20_001)
        f = np.exp(math.lgamma((v + 1) / 2) - math.lgamma(v / 2)) / math.sqrt(v * math.pi) * (1 + x * x / v) ** (-(v + 1) / 2)
        area = (f[0] + f[-1] + 4 * f[1::2].sum() + 2 * f[2:-1:2].sum()) * (x[1] - x[0]) / 3
        assert moments.student_p(t, v) == pytest.approx(1 - 2 * area, abs=1e-10)


def test_ols_table_of_collinear_features_is_empty(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i, float(i % 3)) for i in range(20)], "a double, b double, y double")
    assert stats.ols_table(df, "y", ["a", "b"]).count() == 0
