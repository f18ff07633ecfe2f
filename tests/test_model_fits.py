"""Trees, forests, boosted trees and support vector regression against brute force, against
Spark's own regressors, and fitted in memory against fitted by passes."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.operators.moments import co_moments, collected
from ledgerlens.plans import fits, models as M, svr, trees
from ledgerlens.plans.trees import Settings

FEW = Settings(forest_trees=4, boost_rounds=4, boost_depth=3)
BY_PASSES = Settings(forest_trees=4, boost_rounds=4, boost_depth=3, local_rows=25)


def toy(spark, n=260, parts=3, seed=5, offset=0.0):
    """A search plan over two industries with three features, one of them constant in B."""
    rng = np.random.default_rng(seed)
    rows = []
    for ind, m in (("A", n), ("B", n // 4)):
        x = np.round(rng.normal(size=(m, 3)), 2)
        x[:, 2] = x[:, 2] if ind == "A" else 1.0
        y = 50 + offset + (10 * x[:, 0] - 5 * np.abs(x[:, 1]) + (x[:, 0] > 0.5) * 8 + rng.normal(scale=0.5, size=m))
        rows += [(f"{ind}{i // 7}", 2000 + i % 7, ind, "train" if i % 7 < 5 else "test", float(v), 1.0, *map(float, x[i])) for i, v in enumerate(y)]
    df = spark.createDataFrame(rows, "ticker string, fy int, broad_industry string, split string, stock_price double, market_cap double, f0 double, f1 double, f2 double")
    pdf = df.toPandas()
    stats, live, ys = {}, {}, {}
    for ind, g in pdf[pdf.split == "train"].groupby("broad_industry"):
        x = g[["f0", "f1", "f2"]].to_numpy()
        sd = x.std(axis=0)
        stats[ind], live[ind], ys[ind] = (x.mean(axis=0), np.where(sd > 0, sd, 1.0)), sd > 0, (g.stock_price.mean(), g.stock_price.std(ddof=0))
    pools = {i: ["f0", "f1", "f2"] for i in stats}
    held = {}
    for (ind, split), m in collected(co_moments(df, ["f0", "f1", "f2", "stock_price"], ["broad_industry", "split"]), ["broad_industry", "split"]).items():
        held.setdefault(ind, {})[split] = m
    return M.SearchPlan(df.repartition(parts, "fy", "ticker"), pools, {}, {}, {}, stats, live, ys, held)


def specs(families, ks=(2, 3)):
    return [(i, f, k) for i in ("A", "B") for f in families for k in ks]


def scored(df):
    return {(r["family"], r["n_features"], r["ticker"], r["fy"]): r["prediction"] for r in df.collect()}


def close(a, b, tol=1e-9):
    assert a.keys() == b.keys() and a
    worst = max(abs(a[k] - b[k]) / max(1.0, abs(b[k])) for k in a)
    assert worst <= tol, worst


def greedy(bins, y, w, depth=None):
    """A regression tree by definition: every split of every node is tried."""
    keep = w > 0
    bins, y, w = bins[keep], y[keep].astype(float), w[keep].astype(float)
    mean = (y * w).sum() / w.sum()
    node = {"value": mean}
    if depth == 0:
        return node
    base, best = ((y - mean) ** 2 * w).sum(), None
    for f in range(bins.shape[1]):
        for b in np.unique(bins[:, f])[:-1]:
            go = bins[:, f] <= b
            cost = sum(((y[s] - (y[s] * w[s]).sum() / w[s].sum()) ** 2 * w[s]).sum() for s in (go, ~go))
            if best is None or cost < best[0] - 1e-6:
                best = (cost, f, b)
    if best is None or base - best[0] < 1e-6:
        return node
    go = bins[:, best[1]] <= best[2]
    deeper = None if depth is None else depth - 1
    return node | {"f": best[1], "b": best[2], "l": greedy(bins[go], y[go], w[go], deeper), "r": greedy(bins[~go], y[~go], w[~go], deeper)}


def walk(node, row):
    while "f" in node:
        node = node["l"] if row[node["f"]] <= node["b"] else node["r"]
    return node["value"]


@pytest.mark.parametrize("depth", [1, 3, None])
def test_a_tree_is_the_greedy_one(depth):
    rng = np.random.default_rng(1)
    bins = rng.integers(0, 9, size=(70, 4)).astype(np.uint8)
    y = (rng.normal(size=70) * 1000 + bins[:, 1].astype(int) * 500).astype(np.int64)
    w = rng.integers(0, 3, size=70)
    t = trees.grow(bins, y, w, max_depth=depth)
    want = greedy(bins, y, w, depth)
    assert np.allclose(t.predict(bins[w > 0]), [walk(want, r) for r in bins[w > 0]])


def test_edge_cases_of_a_tree():
    empty = trees.grow(np.zeros((0, 2), np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64))
    assert empty.predict(np.zeros((3, 2), np.uint8)).tolist() == [0, 0, 0]
    same = trees.grow(np.zeros((5, 2), np.uint8), np.arange(5), np.ones(5, np.int64))
    assert len(same.feature) == 1 and same.value[0] == 2.0           # nothing to split by
    pure = trees.grow(np.arange(5, dtype=np.uint8)[:, None], np.full(5, 7), np.ones(5, np.int64))
    assert len(pure.feature) == 1 and pure.value[0] == 7.0
    x = np.r_[np.arange(1000.0), np.nan, np.inf]
    e = trees.bin_edges(x)
    assert len(e) <= trees.BINS - 1 and np.all(np.diff(e) > 0)
    assert trees.bin_edges(np.array([3.0, 1.0, 3.0])).tolist() == [2.0] and len(trees.bin_edges(np.array([]))) == 0


def test_bootstrap_is_poisson_and_the_rows_own():
    rid = np.arange(200_000) * 7919
    w = trees.bootstrap_weights(rid, 3)
    assert abs(w.mean() - 1) < 0.01 and abs(w.var() - 1) < 0.02 and abs((w == 0).mean() - np.exp(-1)) < 0.005
    pick = np.random.default_rng(0).permutation(len(rid))
    assert (trees.bootstrap_weights(rid[pick], 3) == w[pick]).all()
    assert abs(np.corrcoef(w, trees.bootstrap_weights(rid, 4))[0, 1]) < 0.01


@pytest.mark.parametrize("family", [fits.TREE, fits.FOREST, fits.BOOST, fits.SVR])
def test_in_tasks_and_by_passes_give_one_model(spark, family):
    """Both ways of fitting, and any partitions: the same predictions."""
    one, other = toy(spark, parts=1), toy(spark, parts=7)
    tol = 1e-4 if family == fits.SVR else 1e-9
    want = scored(fits.predictions(one, specs([family]), one.data, FEW))
    assert len(want) == 2 * one.data.count()
    close(scored(fits.predictions(other, specs([family]), other.data, FEW)), want, 1e-7 if family == fits.SVR else 0.0)
    some = specs([family], ks=(3,)) if family == fits.SVR else specs([family])
    got = scored(fits.predictions(other, some, other.data, BY_PASSES))
    close(got, {k: v for k, v in want.items() if k in got}, tol)


@pytest.mark.parametrize("settings", [FEW, BY_PASSES], ids=["tasks", "passes"])
def test_saved_models_score_like_the_search(spark, scratch, settings):
    plan = toy(spark, n=140)
    for i, family in enumerate((fits.TREE, fits.FOREST, fits.BOOST, fits.SVR)):
        wanted = [("A", family, 3), ("B", family, 2)][:1 if family == fits.SVR else 2]
        at = f"{scratch}/fitted-{settings.local_rows}-{i}"
        fits.fit_models(plan, wanted, settings).write.parquet(at)
        table = spark.read.parquet(at)
        got = {(r["ticker"], r["fy"]): r["prediction"] for r in fits.score(table, plan.data).collect()}
        # in memory: fits by passes give the same predictions
        want = {(r["ticker"], r["fy"]): r["prediction"] for r in fits.predictions(plan, wanted, plan.data, FEW).collect()}
        close(got, want, 1e-4 if family == fits.SVR else 1e-9)
    assert fits.score(table, plan.data.filter("broad_industry = 'C'")).count() == 0


def test_trees_are_scored_in_lots(spark, monkeypatch):
    plan = toy(spark, n=140)
    table = fits.fit_models(plan, [("A", fits.FOREST, 3)], FEW)
    whole = {(r["ticker"], r["fy"]): r["prediction"] for r in fits.score(table, plan.data).collect()}
    monkeypatch.setattr(fits, "NODES", 60)
    close({(r["ticker"], r["fy"]): r["prediction"] for r in fits.score(table, plan.data).collect()}, whole)


def test_r2_is_near_that_of_sparks_regressors(spark):
    """Full settings (100 rounds at 0.05, 100 trees) on synthetic data: R^2 on test rows
    within 0.05 of Spark's regressors."""
    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, RandomForestRegressor
    plan = toy(spark, n=700)
    res = {(r[0], r[1], r[3]): r[4] for r in M.fitted_results(plan, ["A"], [fits.TREE, fits.FOREST, fits.BOOST])}
    d = VectorAssembler(inputCols=["f0", "f1", "f2"], outputCol="features").transform(plan.data.filter("broad_industry = 'A'")).cache()
    ev = RegressionEvaluator(labelCol="stock_price", predictionCol="prediction", metricName="r2")
    for family, est in ((fits.TREE, DecisionTreeRegressor(labelCol="stock_price", maxDepth=20, maxBins=256)),
                        (fits.FOREST, RandomForestRegressor(labelCol="stock_price", numTrees=50, maxDepth=12, maxBins=256, featureSubsetStrategy="all", seed=1)),
                        (fits.BOOST, GBTRegressor(labelCol="stock_price", maxIter=40, stepSize=0.1, maxDepth=6, maxBins=256, seed=1))):
        theirs = ev.evaluate(est.fit(d.filter("split = 'train'")).transform(d.filter("split = 'test'")))
        assert abs(res["A", family, 3] - theirs) < 0.05, (family, res["A", family, 3], theirs)


def test_a_large_offset_does_not_hurt(spark):
    """Prices around 1e9 with a spread of 1: linear, tree and kernel fits as without the offset."""
    plan, far = toy(spark, n=140), toy(spark, n=140, offset=1e9)
    near, off = M.linear_results(plan, ["A"])[0], M.linear_results(far, ["A"])[0]
    assert [r[4] for r in off] == pytest.approx([r[4] for r in near], abs=1e-5)
    a, b = (M.fitted_results(p, ["A"], [fits.SVR])[0][4] for p in (plan, far))
    assert a == pytest.approx(b, abs=1e-3)


def dual_svr(K, y, c, eps, sweeps=4000):
    """Epsilon-insensitive regression by pairwise coordinate descent on the dual (the sum of
    the multipliers stays 0, as a free intercept asks)."""
    n, rng = len(y), np.random.default_rng(0)
    beta, f = np.zeros(n), np.zeros(n)
    for _ in range(sweeps):
        order = rng.permutation(n)
        for i, j in zip(order, np.roll(order, 1)):
            eta = K[i, i] + K[j, j] - 2 * K[i, j]
            if eta < 1e-12:
                continue
            lo, hi = max(-c - beta[i], beta[j] - c), min(c - beta[i], beta[j] + c)
            kinks = sorted({lo, hi, *(t for t in (-beta[i], beta[j]) if lo < t < hi)})

            def cost(t):
                return 0.5 * eta * t * t + t * (f[i] - f[j] - y[i] + y[j]) + eps * (abs(beta[i] + t) + abs(beta[j] - t))

            tries = list(kinks)
            for a, b in zip(kinks, kinks[1:]):
                m = (a + b) / 2
                t = -((f[i] - f[j] - y[i] + y[j]) + eps * (np.sign(beta[i] + m) - np.sign(beta[j] - m))) / eta
                tries.append(min(max(t, a), b))
            t = min(tries, key=cost)
            beta[i] += t
            beta[j] -= t
            f += t * (K[:, i] - K[:, j])
    inside = np.abs(beta) < c * (1 - 1e-6)
    inside &= np.abs(beta) > 1e-7
    b = np.median((y - f - eps * np.sign(beta))[inside])
    return beta, b


def test_support_vector_regression_is_the_dual_solution():
    rng = np.random.default_rng(3)
    z = rng.normal(size=(45, 2))
    y = 20 + 6 * np.sin(z[:, 0]) + 2 * z[:, 1] + rng.normal(scale=0.3, size=45)
    phi, theta = svr.fit(z, y, z, 0.5)
    K = phi._kernel(z)
    beta, b = dual_svr(K, y, svr.SVR_C, svr.SVR_EPSILON, sweeps=600)
    assert np.allclose(phi(z) @ theta, K @ beta + b, atol=0.06)
    # the dual's value bounds every fit's objective from below
    bound = y @ beta - svr.SVR_EPSILON * np.abs(beta).sum() - 0.5 * beta @ K @ beta
    f = phi(z) @ theta
    ours = 0.5 * theta[:-1] @ theta[:-1] + svr.SVR_C * np.maximum(np.abs(y - f) - svr.SVR_EPSILON, 0).sum()
    assert bound <= ours <= bound * 1.01
