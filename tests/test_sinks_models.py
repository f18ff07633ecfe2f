"""Sinks (S7-S9, S11, S12) and model-search pieces that need no long fits."""

import numpy as np
import pytest
from pyspark.sql import functions as F


def test_export_csv_orders_and_renders_null(spark, scratch):
    from ledgerlens.sources.tables import export_csv
    df = spark.createDataFrame([("B", 2020, "FY", 1.0), ("A", 2021, "FY", None), ("A", 2019, "FY", 2.0)],
                               "ticker string, fy int, fp string, v double")
    out = f"{scratch}/csv_out"
    export_csv(df, out)
    rows = spark.read.option("header", "true").csv(out).collect()
    keys = [(r["ticker"], int(r["fy"])) for r in rows]
    assert sorted(keys) == [("A", 2019), ("A", 2021), ("B", 2020)]
    raw = "".join(open(p).read() for p in sorted(__import__("glob").glob(f"{out}/part-*.csv")))
    assert "NULL" in raw


def test_append_and_replace(spark, scratch):
    from ledgerlens.sources.tables import append, read_table, replace_if_any
    df = spark.createDataFrame([("A", 2020, 1.0)], "ticker string, fy int, v double")
    p = f"{scratch}/tbl"
    append(df, p)
    append(df, p)
    assert read_table(spark, p).count() == 2
    assert replace_if_any(df.limit(0), p) is False and read_table(spark, p).count() == 2
    assert replace_if_any(df, p) is True and read_table(spark, p).count() == 1


def test_upsert_replaces_by_key_and_can_run_again(spark, scratch):
    from ledgerlens.sources.tables import read_table, upsert
    schema, p, log = "ticker string, fy int, v double", f"{scratch}/upsert", f"{scratch}/upsert_log"

    def rows(at):
        return sorted((r["ticker"] or "", r["fy"], r["v"]) for r in read_table(spark, at).collect())

    first = spark.createDataFrame([("A", 2020, 1.0), ("B", 2020, 2.0), ("A", 2021, 3.0), (None, 2021, 4.0)], schema)
    upsert(first, p, ["ticker", "fy"])
    upsert(first, p, ["ticker", "fy"])
    assert rows(p) == [("", 2021, 4.0), ("A", 2020, 1.0), ("A", 2021, 3.0), ("B", 2020, 2.0)]
    before = {f.name for f in __import__("pathlib").Path(f"{p}/fy=2020").glob("*.parquet")}
    run = spark.createDataFrame([("A", 2021, 30.0), ("C", 2021, 5.0), (None, 2021, 40.0)], schema)
    for _ in range(2):      # a recovery run, and the same one again
        upsert(run, p, ["ticker", "fy"])
        assert rows(p) == [("", 2021, 40.0), ("A", 2020, 1.0), ("A", 2021, 30.0), ("B", 2020, 2.0), ("C", 2021, 5.0)]
    assert {f.name for f in __import__("pathlib").Path(f"{p}/fy=2020").glob("*.parquet")} == before     # untouched
    upsert(run.limit(0), p, ["ticker", "fy"])
    assert len(rows(p)) == 5
    with pytest.raises(ValueError):
        upsert(run.unionByName(run), p, ["ticker", "fy"])
    upsert(first.select("ticker", "fy", "v"), log, ["ticker", "fy"], partition_by=())
    upsert(run, log, ["ticker", "fy"], partition_by=())
    assert rows(log) == rows(p) and "bucket" in read_table(spark, log).columns


@pytest.mark.parametrize("offset", [0.0, 1e8])
def test_co_moments_give_means_correlations_and_fits(spark, offset):
    """One scan in many partitions against numpy on the rows: means, deviations, correlations,
    least squares, ridge and R^2 on other rows; a large offset cancels nothing; constant
    and missing columns stay apart; a null key is a group."""
    from ledgerlens.operators.moments import co_moments, collected, r2, ridge
    rng = np.random.default_rng(0)
    x = rng.normal(size=(240, 4)) * [1, 3, 0.5, 2] + offset
    y = (x - offset) @ np.array([1.0, -2.0, 0.5, 0.0]) + 3 + offset + rng.normal(scale=0.1, size=240)
    part = np.array(["train", "test", None], dtype=object)[np.arange(240) % 3]
    rows = [(p, *map(float, v), float(t), 7.0, None if i == 5 else 1.0) for i, (p, v, t) in enumerate(zip(part, x, y))]
    df = spark.createDataFrame(rows, "g string, a double, b double, c double, d double, y double, k double, m double").repartition(7)
    held = collected(co_moments(df, ["a", "b", "c", "d", "y", "k", "m"], ["g"]), ["g"])
    assert set(held) == {("train",), ("test",), (None,)} and sum(m.n for m in held.values()) == 240
    tr, te = held[("train",)], held[("test",)]
    X, T, u, v = x[part == "train"], x[part == "test"], y[part == "train"], y[part == "test"]
    assert np.allclose(tr.mean[:5], [*X.mean(0), u.mean()], rtol=1e-12) and np.allclose(tr.std[:4], X.std(0), rtol=1e-6) and tr.std[5] == 0
    assert np.allclose(tr.corr(4)[:4], [np.corrcoef(X[:, j], u)[0, 1] for j in range(4)], atol=1e-7) and np.isnan(tr.corr(4)[5])
    assert np.isnan(held[(None,)].mean[6]) and np.isfinite(held[(None,)].c[:5, :5]).all()
    mu, sd = tr.mean[:4], tr.std[:4]
    Z, V = (X - mu) / sd, (T - mu) / sd
    for alpha in (None, 1.0):
        b0, beta = ridge(tr, mu, sd, 4, 4, alpha)
        want = np.linalg.lstsq(Z, u - u.mean(), rcond=None)[0] if alpha is None else np.linalg.solve(Z.T @ Z + np.eye(4), Z.T @ (u - u.mean()))
        assert np.allclose(beta, want, atol=1e-6) and b0 == pytest.approx(u.mean(), rel=1e-12)
        e = v - b0 - V @ beta
        assert r2(te, mu, sd, 4, 4, b0, beta) == pytest.approx(1 - (e ** 2).sum() / ((v - v.mean()) ** 2).sum(), abs=1e-6)


def test_prefix_sizes_and_selection():
    from ledgerlens.plans.models import equation_text, prefix_sizes, select_best
    assert prefix_sizes(35)[0] == (0.1, 3) and prefix_sizes(34)[8] == (0.9, 30) and prefix_sizes(5)[0] == (0.1, 1)
    res = [("I", "Ridge Regression", 0.1, 1, 0.5), ("I", "Linear Regression", 0.2, 2, 0.5),
           ("I", "Linear Regression", 0.1, 1, 0.5), ("I", "Support Vector Regression", 0.3, 3, 0.4)]
    best_fam, best = select_best(res)
    assert best_fam[("I", "Linear Regression")][0] == 0.1      # first ratio wins ties
    assert best["I"][2] == "Linear Regression"                  # first family wins ties
    assert equation_text(1.0, [2.0], ["x"]).startswith("Predicted Price = 1.000 + ")


def test_linear_model_persistence_roundtrip(spark, scratch):
    from ledgerlens.plans.checks import features
    from ledgerlens.plans import models as M
    f = features(spark, "/root/testdata/sf0.001")
    res, best_fam, best, plan, coefs = M.search(f, ("Linear Regression", "Ridge Regression"),
                                                train_last=1999, test_first=2000)
    assert res and best
    out = f"{scratch}/models"
    M.save_linear_models(spark, coefs, best, plan, out)
    back = spark.read.parquet(out).collect()
    assert {r["industry"] for r in back} == set(best)
    for r in back:
        assert len(r["coef"]) == len(r["features"]) == len(r["mean"])
    # the loaded table scores as the search did: the same R^2 on the test rows
    test = plan.data.filter(F.col("split") == "test")
    scored = M.score_linear(M.load_linear_models(spark, out), test).toPandas()
    for r in back:
        g = scored[scored.broad_industry == r["industry"]]
        r2 = 1 - ((g.stock_price - g.prediction) ** 2).sum() / ((g.stock_price - g.stock_price.mean()) ** 2).sum()
        assert r2 == pytest.approx(r["r2"], abs=1e-6)


def test_linear_search_matches_row_level_fits(spark):
    """On the driver tables, every industry and prefix: the search's R^2 of OLS (where the
    rows determine it) and of ridge are those of fits to the rows."""
    from ledgerlens.plans.checks import features
    from ledgerlens.plans import models as M
    plan = M.prepare(features(spark, "/root/testdata/sf0.01"), 1999, 2000)
    inds = M.eligible_industries(plan)
    res = {(r[0], r[1], r[2]): r[4] for r in M.linear_results(plan, inds)[0]}
    pdf, checked = plan.data.toPandas(), 0
    for ind in inds:
        pool, (mu, sd) = plan.pools[ind], plan.stats[ind]
        d = pdf[pdf.broad_industry == ind]
        tr, te = d[d.split == "train"], d[d.split == "test"]
        x, t = (tr[pool].to_numpy(float) - mu) / sd, (te[pool].to_numpy(float) - mu) / sd
        assert np.allclose(x.mean(0), 0, atol=1e-9) and np.allclose(x.std(0)[plan.live[ind]], 1)
        u, v = tr.stock_price.to_numpy(float), te.stock_price.to_numpy(float)

        def r2(pred):
            return 1 - ((v - pred) ** 2).sum() / ((v - v.mean()) ** 2).sum()

        for ratio, k in M.prefix_sizes(len(pool)):
            ridge = np.linalg.solve(x[:, :k].T @ x[:, :k] + np.eye(k), x[:, :k].T @ (u - u.mean()))
            assert res[ind, M.RIDGE, ratio] == pytest.approx(r2(u.mean() + t[:, :k] @ ridge), abs=1e-5, rel=1e-5)
            if len(x) > k + 2 and np.linalg.cond(x[:, :k]) < 1e3:
                coef = np.linalg.lstsq(x[:, :k], u - u.mean(), rcond=None)[0]
                assert res[ind, M.LINEAR, ratio] == pytest.approx(r2(u.mean() + t[:, :k] @ coef), abs=1e-4, rel=1e-4)
                checked += 1
    assert checked > 20


def test_summary_csv_is_one_ordered_file(spark, scratch):
    import glob
    from ledgerlens.sources.tables import write_summary_csv
    df = spark.createDataFrame([("Services", 0.5), ("Mining", 0.7)], "Industry string, R2_Score double").repartition(2)
    out = f"{scratch}/summary_csv"
    write_summary_csv(df, out)
    files = glob.glob(f"{out}/part-*.csv")
    assert len(files) == 1
    with open(files[0]) as f:
        assert f.read().split() == ["Industry,R2_Score", "Mining,0.7", "Services,0.5"]


def test_prices_from_csv_and_parquet(spark, scratch):
    from datetime import date
    from ledgerlens.sources.filings import read_prices
    df = spark.createDataFrame([("A", "2020-01-02 00:00:00", 1.5, 2.5)], "ticker string, date string, close_adj double, close_unadj double")
    df.write.parquet(f"{scratch}/prices_parquet")
    df.write.option("header", "true").csv(f"{scratch}/prices_csv")
    for fmt in ("parquet", "csv"):
        r = read_prices(spark, f"{scratch}/prices_{fmt}", fmt).collect()
        assert [tuple(x) for x in r] == [("A", date(2020, 1, 2), 1.5, 2.5)]


def test_log_merge_keeps_old_messages(spark):
    from ledgerlens.operators.repair import merge_log
    log = spark.createDataFrame([("A", "old"), ("B", "old"), ("C", None)], "ticker string, update_after_cleanup string")
    new = spark.createDataFrame([("A", "new")], "ticker string, update_after_cleanup string")
    got = {r["ticker"]: r["update_after_cleanup"] for r in merge_log(log, new).collect()}
    assert got == {"A": "new", "B": "old", "C": None}


def test_row_helpers_and_key_check(spark):
    from ledgerlens.functions.numeric import any_null, row_sum
    from ledgerlens.operators.resolve import assert_unique
    df = spark.createDataFrame([("a", 1.0, 2.0), ("b", None, 2.0), ("b", None, None)], "k string, x double, y double")
    got = df.select(row_sum(["x", "y"]).alias("s"), row_sum(["x", "y"], skip_null=False).alias("t"), any_null(["x", "y"]).alias("n")).collect()
    assert [tuple(r) for r in got] == [(3.0, 3.0, False), (2.0, None, True), (0.0, None, True)]
    assert [tuple(r) for r in assert_unique(df, ["k"]).collect()] == [("b", 2)]


def test_numeric_coercion(spark):
    from ledgerlens.operators.features import coerce_numeric
    df = spark.createDataFrame([("1.5", "x"), ("abc", "y"), (None, "z")], "v string, k string")
    assert [r["v"] for r in coerce_numeric(df, ["v"]).orderBy("k").collect()] == [1.5, None, None]
