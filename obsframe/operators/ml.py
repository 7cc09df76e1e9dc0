"""Model fitting as aggregations: split, random forest, lasso/ridge, k-means, PCA.

Every fit sends sums of fixed size to the driver (co-moments, histograms, centre sums), never rows, and gives the same result for
any partitioning: folds, bootstrap weights and starting points follow from hashes of a row's key.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsframe.functions.columns import col_ref
from obsframe.operators import moments
from obsframe.operators.stats import regression_metrics


def unit_hash(key: Sequence[str], seed: int = 42) -> Column:
    """A number in [0, 1) per row, from the md5 of the key and a seed: the same wherever the row is computed."""
    text = F.concat_ws("|", *[F.coalesce(col_ref(k).cast("string"), F.lit("")) for k in key], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))


def stratified_split(df: DataFrame, target: str, key: Sequence[str], train_frac: float = 0.8,
                     strata: int = 5, seed: int = 42, accuracy: int = 1_000_000) -> DataFrame:
    """Adds ``stratum`` (target quantile bin; -1 for a NULL target) and ``is_train``, balanced within each stratum.

    Bin edges are approximate quantiles (one small aggregate, no global sort). Each row has a
    fixed number from ``unit_hash``; a stratum's training rows are those up to the
    ``train_frac`` quantile of these numbers in it, so every stratum is split in that
    proportion (to 1/``accuracy``), independent of partitioning and task retries.
    """
    probs = [i / strata for i in range(1, strata)]
    edges = df.agg(F.percentile_approx(target, probs, accuracy)).first()[0] or []
    t = col_ref(target)
    stratum = F.lit(len(edges))
    for i in reversed(range(len(edges))):
        stratum = F.when(t <= F.lit(edges[i]), F.lit(i)).otherwise(stratum)
    d = df.withColumn("stratum", F.when(t.isNull(), -1).otherwise(stratum).cast("int")).withColumn("_u", unit_hash(key, seed))
    cuts = {r[0]: r[1] for r in d.groupBy("stratum").agg(F.percentile_approx("_u", train_frac, accuracy)).collect()}  # one row per stratum
    limit = F.lit(train_frac)
    for s, c in cuts.items():
        limit = F.when(F.col("stratum") == s, F.lit(c)).otherwise(limit)
    return d.withColumn("is_train", F.col("_u") <= limit).drop("_u")


def stored(df: DataFrame) -> DataFrame:
    """Written to the shared checkpoint folder, so that the passes of a fit do not run its upstream again."""
    from obsframe.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _fold(key: Sequence[str], folds: int, seed: int) -> Column:
    return F.floor(unit_hash(key, seed) * folds).cast("int")


def _scored(test: DataFrame, label: str, features: Sequence[str], fit: moments.Linear) -> DataFrame:
    return moments.complete(test, [*features, label]).withColumn("prediction", fit.column(features))


def lasso_cv(train: DataFrame, test: DataFrame, label: str, features: Sequence[str], folds: int = 5,
             seed: int = 42, lambdas: Sequence[float] | None = None, key: Sequence[str] | None = None):
    """Lasso (elastic net alpha = 1) with CV over lambda = 10^(-4..1 step 0.5); returns (metrics, coefficients).

    One aggregation gives each fold's co-moments; the rest is arithmetic on them: a training set's are the sum over the other folds,
    fits come by coordinate descent, and a held-out fold's squared error is a quadratic form of its own. Rows go to folds by the
    hash of ``key`` (default: all columns used). The least mean RMSE over folds wins (of equals, the larger lambda).
    """
    lambdas = list(lambdas) if lambdas is not None else [10 ** (-4 + 0.5 * i) for i in range(11)]
    columns = [*features, label]
    rows = moments.complete(train.withColumn("_fold", _fold(key or columns, folds, seed)), columns, ["_fold"])
    parts = moments.comoments(rows, columns, "_fold")
    k = len(columns)
    if not parts:
        raise ValueError("no complete training rows")
    errors = np.zeros(len(lambdas))
    for f, held in parts.items():
        rest = moments.total([m for g, m in parts.items() if g != f], k)
        if rest.n:
            errors += [np.sqrt(max(fit.squared_error(held), 0.0) / held.n) for fit in moments.lasso(rest, lambdas)]
    best = min(lambdas, key=lambda x: (errors[lambdas.index(x)], -x))
    fit = moments.lasso(moments.total(list(parts.values()), k), [best])[0]
    coefs = [*zip(features, map(float, fit.beta)), ("(Intercept)", fit.intercept)]
    metrics = regression_metrics(_scored(test, label, features, fit), label, "prediction").withColumn("lambda", F.lit(float(best)))
    return metrics, train.sparkSession.createDataFrame(coefs, "term string, estimate double")


def ridge_fit(train: DataFrame, label: str, features: Sequence[str], alpha: float) -> moments.Linear:
    columns = [*features, label]
    return moments.ridge(moments.comoments(moments.complete(train, columns), columns)[None], alpha)


def ridge_vs_lasso(train: DataFrame, test: DataFrame, label: str, features: Sequence[str],
                   ridge_alpha: float = 10.0, lasso_alpha: float = 0.1) -> DataFrame:
    """Train and test R^2 / RMSE of a ridge and a lasso fit, and the train-test R^2 gap.

    Both fits and all four scores come from one aggregation: the co-moments of the two splits.
    """
    columns = [*features, label]
    both = reduce(DataFrame.unionByName, (moments.complete(d, columns).withColumn("_split", F.lit(s)) for s, d in (("train", train), ("test", test))))
    parts = moments.comoments(both, columns, "_split")
    nothing = moments.total([], len(columns))
    tr, te = (parts.get(s, nothing) for s in ("train", "test"))
    if not tr.n:
        raise ValueError("no complete training rows")

    def r2(fit: moments.Linear, m: moments.Moments) -> float | None:
        return None if not m.n or not m.comoment[-1, -1] else 1 - fit.squared_error(m) / float(m.comoment[-1, -1])

    rows = []
    for name, alpha, fit in (("ridge", ridge_alpha, moments.ridge(tr, ridge_alpha)), ("lasso", lasso_alpha, moments.lasso(tr, [lasso_alpha])[0])):
        a, b = r2(fit, tr), r2(fit, te)
        rmse = float(np.sqrt(max(fit.squared_error(te), 0.0) / te.n)) if te.n else None
        rows.append((name, float(alpha), a, b, rmse, None if a is None or b is None else a - b))
    return train.sparkSession.createDataFrame(rows, "model string, alpha double, r2_train double, r2_test double, rmse double, r2_gap double")


def pca_variance(df: DataFrame, features: Sequence[str], k: int | None = None) -> DataFrame:
    """PCA on standardised complete-case features: variance explained per component, from one aggregation of co-moments."""
    m = moments.comoments(moments.complete(df, features), features)[None]
    w = moments.principal_variances(m)[:k or len(features)]
    rows = [(i + 1, float(x), float(c)) for i, (x, c) in enumerate(zip(w, np.cumsum(w)))]
    return df.sparkSession.createDataFrame(rows, "component int, variance_explained double, cumulative double")


def _tools():
    """Helpers for tasks; as inner functions they travel with the task and need no package on the workers."""
    def mixed(u: np.ndarray, salt: int) -> np.ndarray:
        """Uniform numbers in (0, 1) from 64-bit hashes and a salt (the finaliser of splitmix64, a public generator)."""
        with np.errstate(over="ignore"):
            x = u.view(np.uint64) + np.uint64(salt % (1 << 32) + 1) * np.uint64(0x9E3779B97F4A7C15)
            x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / float(1 << 53) + 2.0 ** -54

    def matrix(b: pa.RecordBatch, names: Sequence[str]) -> np.ndarray:
        return np.stack([b.column(n).to_numpy() for n in names], 1)

    return mixed, matrix


def kmeans_best_of(df: DataFrame, key: str, features: Sequence[str], k: int = 3, starts: int = 10,
                   seed: int = 42, iterations: int = 50, tolerance: float = 1e-4, settled: float = 1e-4):
    """Standardise complete-case features (constant ones dropped), fit k-means from ``starts`` seeds, keep the lowest cost.
    Returns (assignments, cost).

    All starts advance together: a step is one scan that sends k centre sums per start and task. Centres are seeded as in k-means++,
    one scan per centre: a row is drawn with probability in proportion to its squared distance, as the row with the least
    exponential variate per distance, and the variates come from the hash of its key. A start rests once no centre moves by
    ``tolerance`` or its cost falls by less than a share of ``settled``; then the best goes on until no centre moves by ``tolerance``. Clusters are numbered by their first key, so numbers do not depend on which start won.
    """
    base = moments.complete(df, features, [key])
    m = moments.comoments(base, features)[None]
    sd = np.sqrt(np.diag(m.comoment) / max(m.n - 1, 1))
    on = [i for i in range(len(features)) if sd[i] > 0]
    if len(on) < 2:
        raise ValueError("k-means needs at least two non-constant features")
    names = [f"z{i}" for i in range(len(on))]
    z = [((col_ref(features[i]) - F.lit(float(m.mean[i]))) / F.lit(float(sd[i]))).alias(n) for i, n in zip(on, names)]
    rows = stored(base.select(col_ref(key), F.xxhash64(col_ref(key).cast("string"), F.lit(seed)).alias("_u"), *z))
    d, (mixed, matrix) = len(on), _tools()
    sums = [f"s{i}" for i in range(d)]

    def distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
        return np.maximum((x * x).sum(1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(1), 0.0)

    def draw(chosen: np.ndarray):
        """The drawn row of each start in a task."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best = np.full(starts, np.inf)
            rows = np.zeros((starts, d))
            for b in batches:
                x, u = matrix(b, names), b.column("_u").to_numpy()
                for s in range(starts if len(x) else 0):
                    far = distances(x, chosen[s]).min(1) if chosen.shape[1] else np.ones(len(x))
                    with np.errstate(divide="ignore"):
                        wait = -np.log(mixed(u, s * 1000 + chosen.shape[1])) / far
                    i = int(wait.argmin())
                    if wait[i] < best[s]:
                        best[s], rows[s] = wait[i], x[i]
            found = np.flatnonzero(np.isfinite(best))
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(best[found]), *(pa.array(rows[found, i]) for i in range(d))], ["start", "wait", *sums])
        return run

    def step(centres: np.ndarray):
        """Number, cost and sums of the rows nearest to each centre in a task."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n, cost, total = np.zeros((starts, k)), np.zeros((starts, k)), np.zeros((starts, k, d))
            for b in batches:
                x = matrix(b, names)
                for s in live:
                    far = distances(x, centres[s])
                    near = far.argmin(1)
                    n[s] += np.bincount(near, minlength=k)
                    cost[s] += np.bincount(near, far.min(1), k)
                    total[s] += np.stack([np.bincount(near, x[:, i], k) for i in range(d)], 1)
            at = np.argwhere(n > 0)
            i, j = at[:, 0], at[:, 1]
            yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(n[i, j]), pa.array(cost[i, j]), *(pa.array(total[i, j, c]) for c in range(d))],
                                             ["start", "cluster", "n", "cost", *sums])
        return run

    values = rows.select("_u", *names)
    centres = np.zeros((starts, 0, d))
    for _ in range(k):
        found = values.mapInArrow(draw(centres), "start long, wait double, " + ", ".join(f"{s} double" for s in sums))
        drawn = {r["start"]: r for r in found.groupBy("start").agg(F.min_by(F.struct(*sums), "wait").alias("row")).collect()}
        new = np.array([[list(drawn[s]["row"]) if s in drawn else centres[s, 0]] for s in range(starts)]).reshape(starts, 1, d)
        centres = np.concatenate((centres, new), 1)
    live, costs, resting = list(range(starts)), np.full(starts, np.inf), []
    kept = values.select(*names)
    for _ in range(iterations):
        sent = kept.mapInArrow(step(centres), "start long, cluster long, n double, cost double, " + ", ".join(f"{s} double" for s in sums))
        moved = centres.copy()
        cost = np.zeros(starts)
        for r in sent.groupBy("start", "cluster").agg(*(F.sum(c).alias(c) for c in ("n", "cost", *sums))).collect():  # starts * k rows
            moved[r["start"], r["cluster"]] = np.array([r[c] for c in sums]) / r["n"]
            cost[r["start"]] += r["cost"]
        shift = np.sqrt(((moved - centres) ** 2).sum(2)).max(1)
        slow = [s for s in live if shift[s] <= tolerance or costs[s] - cost[s] <= settled * cost[s]]
        for s in live:
            costs[s] = cost[s]
        centres, live = moved, [s for s in live if s not in slow]
        if not live and not resting:  # of all starts, the best goes on until its centres stay
            resting = [int(costs.argmin())]
            live = [s for s in resting if shift[s] > tolerance]
            settled = -1.0
        if not live:
            break
    live = list(range(starts))  # costs of the final centres
    costs = np.zeros(starts)
    for r in kept.mapInArrow(step(centres), "start long, cluster long, n double, cost double, " + ", ".join(f"{s} double" for s in sums)).groupBy("start").agg(F.sum("cost").alias("c")).collect():
        costs[r["start"]] = r["c"]
    won = int(costs.argmin())

    far = [reduce(lambda a, b: a + b, (F.pow(F.col(n) - F.lit(float(v)), 2) for n, v in zip(names, c))) for c in centres[won]]
    near = F.array_position(F.array(*far), F.array_min(F.array(*far))).cast("int") - 1
    pred = rows.select(key, near.alias("_c"))
    first = {r["_c"]: r["first"] for r in pred.groupBy("_c").agg(F.min(key).alias("first")).collect()}  # k rows
    order = {c: i for i, c in enumerate(sorted(first, key=lambda c: (first[c] is None, first[c])))}
    number = reduce(lambda a, c: F.when(F.col("_c") == c, F.lit(order[c])).otherwise(a), order, F.lit(None).cast("int"))
    return pred.select(key, number.cast("int").alias("cluster")), float(costs[won])


def random_forest_cv(train: DataFrame, test: DataFrame, label: str, features: Sequence[str],
                     num_trees: int = 100, folds: int = 5, seed: int = 42, max_depth: int = 5, bins: int = 64, key: Sequence[str] | None = None):
    """Random forest regression tuned by k-fold CV over the features tried per node (a third, all); returns (metrics, importances).

    Trees of all folds and settings grow together, level by level: a scan sends, per task, histograms of the label over quantile bins
    (count and sum per tree, node, feature and bin), which are added up and give every node's best split of squared error.
    Bootstrap weights are Poisson(1) by the hash of ``key`` (default: all columns used) and the tree, and so are folds, so the forest does
    not depend on partitions. A task's histograms have a fixed size, so tasks should hold many rows.
    Importances (the mean over trees of the normalised decrease of squared error) are rescaled so the largest is 100, rounded to 2 decimals, top 10.
    """
    columns = [*features, label]
    d, third = len(features), max(1, -(-len(features) // 3))
    named = [F.col(f"`{f}`").alias(f"x{i}") for i, f in enumerate(features)]
    rows = train.withColumns({"_u": F.xxhash64(*[col_ref(c).cast("string") for c in (key or columns)], F.lit(seed)), "_fold": _fold(key or columns, folds, seed)})
    rows = stored(moments.complete(rows, columns, ["_u", "_fold"]).select("_u", "_fold", F.col(f"`{label}`").alias("y"), *named))
    if rows.rdd.getNumPartitions() < (least := train.sparkSession.sparkContext.defaultParallelism):  # few rows, but much work on each
        rows = rows.repartition(least, "_u")
    names = [f"x{i}" for i in range(d)]
    probs = [i / bins for i in range(1, bins)]
    found = rows.agg(F.avg("y").alias("y"), F.var_pop("y").alias("spread"), *(F.percentile_approx(n, probs, 10_000).alias(n) for n in names)).first()
    if found["y"] is None:
        raise ValueError("no complete training rows")
    # labels become whole numbers of a fine unit: their sums are exact, so no order of adding can change a split
    middle, unit = float(f"{found['y']:.6g}"), 2.0 ** (round(np.log2(found["spread"]) / 2) - 20) if found["spread"] else 1.0
    spread, edges = found["spread"] / unit ** 2, [np.unique(np.array(found[n], float)) for n in names]
    (mixed, matrix), spark = _tools(), train.sparkSession
    poisson = np.cumsum([np.exp(-1) / np.prod(range(1, i + 1), dtype=float) for i in range(12)])
    size = (1 << (max_depth + 1)) - 1

    def binned(b: pa.RecordBatch) -> np.ndarray:
        x = matrix(b, names)
        return np.stack([np.searchsorted(e, x[:, i]) for i, e in enumerate(edges)], 1)

    def descend(x: np.ndarray, feature: np.ndarray, cut: np.ndarray, depth: int) -> np.ndarray:
        """The node of each row after at most ``depth`` splits."""
        node, every = np.zeros(len(x), np.int64), np.arange(len(x))
        for _ in range(depth):
            f = feature[node]
            node = np.where(f < 0, node, 2 * node + 2 - (x[every, np.maximum(f, 0)] <= cut[node]))
        return node

    def grow(trees: list[tuple[int, int, int]]):
        """``trees``: features tried, fold left out (-1: none), number. Returns splits and values by node, and decreases by feature."""
        t = len(trees)
        feature, cut = np.full((t, size), -1), np.zeros((t, size), np.int64)
        value, gains = np.zeros((t, size)), np.zeros((t, d))
        for depth in range(max_depth + 1):
            width, base = 1 << depth, (1 << depth) - 1
            split, at = feature.copy(), cut.copy()

            def histograms(batches: Iterator[pa.RecordBatch], split=split, at=at, width=width, base=base, depth=depth) -> Iterator[pa.RecordBatch]:
                sums, used = {}, 1 if depth == max_depth else d  # leaves need no features
                for b in batches:
                    x, y, u, fold = binned(b), np.rint((b.column("y").to_numpy() - middle) / unit), b.column("_u").to_numpy(), b.column("_fold").to_numpy()
                    drawn = {number: np.searchsorted(poisson, mixed(u, number)).astype(float) for number in {t[2] for t in trees}}
                    columns = x[:, :used] + np.arange(used) * bins
                    for i, (_, out, number) in enumerate(trees):
                        node = descend(x, split[i], at[i], depth) - base
                        on = np.flatnonzero((drawn[number] > 0) & (fold != out) & (node >= 0))
                        if len(on):
                            w = drawn[number][on]
                            place = (columns[on] + (node[on] * used * bins)[:, None]).ravel()
                            h = sums.setdefault(i, np.zeros((2, width * used * bins)))
                            for j, weight in enumerate((w, w * y[on])):
                                h[j] += np.bincount(place, np.repeat(weight, used), h.shape[1])
                for i, h in sums.items():
                    yield pa.RecordBatch.from_arrays([pa.array([i]), pa.array([h.tobytes()], pa.binary())], ["tree", "h"])

            def add(table: pa.Table) -> pa.Table:
                parts = sorted(table.column("h").to_pylist())  # a fixed order of adding
                h = sum(np.frombuffer(p) for p in parts)
                return pa.Table.from_arrays([table.column("tree").slice(0, 1), pa.array([h.tobytes()], pa.binary())], ["tree", "h"])

            parts = rows.mapInArrow(histograms, "tree long, h binary").groupBy("tree").applyInArrow(add, "tree long, h binary")
            for r in parts.collect():  # one row a tree
                i, h = r["tree"], np.frombuffer(r["h"]).reshape(2, width, -1, bins)
                n, s = h[:, :, 0].sum(2)
                here = n > 0
                value[i, base:base + width][here] = middle + unit * s[here] / n[here]
                if depth == max_depth:
                    continue
                left = h.cumsum(3)[:, :, :, :-1]
                right = np.stack((n, s))[:, :, None, None] - left
                with np.errstate(divide="ignore", invalid="ignore"):
                    whole = np.where(here, s * s / n, 0.0)
                    gain = np.where((left[0] > 0) & (right[0] > 0.5), left[1] ** 2 / left[0] + right[1] ** 2 / right[0] - whole[:, None, None], -np.inf)
                order = np.random.default_rng((seed, trees[i][2], depth)).random((width, d)).argsort(1)
                np.put_along_axis(gain, order[:, trees[i][0]:, None], -np.inf, 1)  # features not tried
                best = gain.reshape(width, -1).argmax(1)
                top = gain.reshape(width, -1)[np.arange(width), best]
                for node in np.flatnonzero(top > 1e-9 * spread * n):
                    feature[i, base + node], cut[i, base + node] = divmod(int(best[node]), bins - 1)
                    gains[i, feature[i, base + node]] += top[node]
        return feature, cut, value, gains

    def predicted(data: DataFrame, keep: Sequence[str], groups: list[list[int]], forest, schema: str) -> DataFrame:
        """``keep`` and the mean prediction ``p0, p1, ...`` of each group of trees."""
        feature, cut, value, _ = forest

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                x = binned(b)
                means = [np.mean([value[i][descend(x, feature[i], cut[i], max_depth)] for i in g], 0) if b.num_rows else np.empty(0) for g in groups]
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), *(pa.array(v) for v in means)], [*keep, *(f"p{i}" for i in range(len(groups)))])

        return data.mapInArrow(run, schema)

    settings = sorted({third, d})
    trees = [(m, out, i) for m in settings for out in range(folds) for i in range(num_trees)]
    if len(settings) > 1:
        groups = [[i for i, t in enumerate(trees) if t[:2] == (m, out)] for m in settings for out in range(folds)]
        held = predicted(rows, ["y", "_fold"], groups, grow(trees), "y double, _fold int, " + ", ".join(f"p{i} double" for i in range(len(groups))))
        errors = held.agg(*(F.sqrt(F.avg(F.when(F.col("_fold") == i % folds, F.pow(F.col("y") - F.col(f"p{i}"), 2)))).alias(f"e{i}") for i in range(len(groups)))).first()
        mean = {m: np.mean([errors[f"e{s * folds + o}"] or 0.0 for o in range(folds)]) for s, m in enumerate(settings)}
        best = min(settings, key=lambda m: (mean[m], m))
    else:
        best = settings[0]
    forest = grow([(best, -1, i) for i in range(num_trees)])
    data = moments.complete(test, columns).select(F.col(f"`{label}`").alias("y"), *named)
    scored = predicted(data, ["y"], [list(range(num_trees))], forest, "y double, p0 double")
    gains = forest[3]
    weight = gains.sum(1, keepdims=True)
    importance = np.divide(gains, weight, out=np.zeros_like(gains), where=weight > 0).mean(0)
    top = float(importance.max()) or 1.0
    ranked = sorted(((f, float(round(float(v) * 100.0 / top, 2))) for f, v in zip(features, importance)), key=lambda r: (-r[1], r[0]))[:10]
    return regression_metrics(scored, "y", "p0"), spark.createDataFrame(ranked, "feature string, importance double")


def residuals(model_predictions: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """Predicted-vs-actual table with residual = label - prediction."""
    return model_predictions.withColumn("residual", F.col(label) - F.col(prediction))
