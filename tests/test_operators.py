"""Operator properties: exact quantiles, as-of window vs brute force, dedupe, routing."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F


def test_exact_quantiles_multi_pass_matches_pandas(spark):
    from ledgerlens.operators.quantiles import exact_quantiles
    rng = np.random.default_rng(11)
    v = np.concatenate([rng.normal(size=6000), np.full(800, 3.0), rng.exponential(size=3000)])
    g = np.where(np.arange(len(v)) % 4 == 0, "a", "b")
    pdf = pd.DataFrame({"g": g, "x": v})
    df = spark.createDataFrame(pdf)
    # a tiny collect limit forces the bracket-refinement passes
    got = exact_quantiles(df, "x", [0.01, 0.5, 0.99], keys=["g"]).toPandas()
    for _, r in got.iterrows():
        assert r.q == pytest.approx(pdf[pdf.g == r.g].x.quantile(r.p), abs=1e-12)


@pytest.mark.parametrize("keyed", [False, True])
def test_exact_quantiles_on_heavy_ties(spark, keyed):
    """Ties at the wanted rank, beside it, and filling half the rows; null keys; infinities."""
    from ledgerlens.operators.quantiles import exact_quantiles
    rng = np.random.default_rng(3)
    n = 100_000
    x = np.concatenate([np.zeros(49_990), rng.lognormal(size=n - 49_990)])
    x[60_000:60_900] = x[60_000]
    g = np.where(np.arange(n) % 3 == 0, "a", "b")
    pdf = pd.DataFrame({"g": g, "x": x})
    df = spark.createDataFrame(pdf)
    probs = [0.0, 0.01, 0.4999, 0.5, 0.75, 0.99, 1.0]
    got = exact_quantiles(df, "x", probs, keys=["g"] if keyed else []).collect()
    assert len(got) == len(probs) * (2 if keyed else 1)
    for r in got:
        want = (pdf[pdf.g == r["g"]] if keyed else pdf).x.quantile(r["p"])
        assert r["q"] == pytest.approx(want, abs=1e-12)
    odd = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", float("inf")), ("a", float("nan")), ("b", None)], "g string, x double")
    assert {(r["g"], r["q"]) for r in exact_quantiles(odd, "x", [0.5], keys=["g"]).collect()} == {(None, 2.0), ("a", float("inf"))}



def test_forward_window_matches_brute_force(spark):
    from ledgerlens.operators.asof import forward_window_mean
    rng = np.random.default_rng(2)
    base = pd.Timestamp("2024-01-01")
    # one key holds most rows (skewed), prices and anchors interleave, equal timestamps occur
    keys = np.where(rng.random(3000) < 0.7, 1, rng.integers(2, 6, 3000))
    ts = base + pd.to_timedelta(rng.integers(0, 60 * 24 * 20, 3000), unit="min")
    kind = rng.random(3000) < 0.8
    close = rng.normal(100, 5, 3000).round(2)
    prices = pd.DataFrame({"key": keys[kind], "ts": ts[kind], "seq": np.arange(3000)[kind], "close": close[kind]})
    anchors = pd.DataFrame({"anchor_id": np.arange(3000)[~kind], "key": keys[~kind], "ts": ts[~kind]})
    anchors.loc[anchors.index[:5], "ts"] = prices.ts.iloc[:5].values   # exact ties
    got = forward_window_mean(spark.createDataFrame(anchors), spark.createDataFrame(prices), n=5,
                              bucket="day").toPandas().set_index("anchor_id")
    p = prices.sort_values(["key", "ts", "seq"])
    for _, a in anchors.iterrows():
        nxt = p[(p.key == a.key) & (p.ts >= a.ts)].head(5)
        exp = nxt.close.mean() if len(nxt) else None
        g = got.loc[a.anchor_id, "mean_next"]
        if exp is None:
            assert pd.isna(g)
        else:
            assert g == pytest.approx(exp)
        assert got.loc[a.anchor_id, "n_used"] == len(nxt)


def test_keep_latest_is_idempotent(spark):
    from ledgerlens.operators.filters import keep_latest
    from ledgerlens.sources.standin import raw_facts
    f = raw_facts(spark, "/root/testdata/sf0.001")
    once = keep_latest(f)
    twice = keep_latest(once.withColumn("ns", F.lit("us-gaap")).withColumn("unit", F.lit("USD"))
                        .withColumn("fp", F.lit("FY")).withColumn("form", F.lit("10-K")))
    cols = ["cik", "tag", "fy", "end", "filed", "val"]
    assert sorted(map(tuple, once.select(*cols).collect())) == sorted(map(tuple, twice.select(*cols).collect()))


def test_routes_disjoint_and_complete(spark):
    from ledgerlens.operators.repair import cleanup
    from ledgerlens.plans.checks import valued_panel
    p = valued_panel(spark, "/root/testdata/sf0.001", 1)
    r = cleanup(p)
    routes = r.routes.toPandas()
    assert len(routes) == p.count()
    assert routes.groupby("ticker").route.nunique().max() == 1
    assert not routes.duplicated(["ticker", "fy", "fp"]).any()


def test_fallback_never_overrides_lower_rank(spark):
    from ledgerlens.plans.checks import _facts_ctx
    from ledgerlens.operators.resolve import resolve_concepts
    c = _facts_ctx(spark, "/root/testdata/sf0.001")
    r = resolve_concepts(c["template"], c["values"], c["concepts"])
    v = c["values"].filter(F.col("val").isNotNull()).join(F.broadcast(c["concepts"]), "tag") \
        .filter(F.col("mode") == "fill")
    m = v.join(c["template"], ["cik", "fy", "fp", "filed", "end"]).groupBy("cik", "concept", "fy") \
        .agg(F.min("rank").alias("best"))
    j = r.filter(~F.col("_by_add")).join(m, ["cik", "concept", "fy"])
    assert j.filter(F.col("src_rank") != F.col("best")).count() == 0


def test_trim_is_subset(spark):
    from ledgerlens.plans.checks import features, trimmed
    f = features(spark, "/root/testdata/sf0.001")
    t = trimmed(spark, "/root/testdata/sf0.001")
    assert t.join(f, ["ticker", "fy"], "left_anti").count() == 0
    assert t.count() <= f.count()


def test_infinite_share_counts_both_signs(spark):
    from ledgerlens.operators.stats import missing_profile
    df = spark.createDataFrame([("g", float("inf")), ("g", float("-inf")), ("g", 1.0), ("g", None)], "broad_industry string, x double")
    r = missing_profile(df, ["x"]).collect()[0]
    assert (r["inf_pct"], r["neginf_pct"], r["nan_pct"]) == (50.0, 25.0, 25.0)


def test_large_and_missing_share_counts_in_messages(spark):
    from ledgerlens.operators.repair import plain_number
    cases = {16_000_000_000.0: "16000000000.0", 9_999_999.5: "9999999.5", 12_345_678.25: "12345678.25", 100.0: "100.0", None: "nan"}
    got = spark.createDataFrame([(k,) for k in cases], "x double").select("x", plain_number(F.col("x")).alias("t")).collect()
    assert {r["x"]: r["t"] for r in got} == cases


def test_fit_quality_of_constant_and_short_data(spark):
    from ledgerlens.operators.stats import r2_overall, trend_band, trend_line
    schema = "stock_price double, theoretical_price double"
    flat = spark.createDataFrame([(5.0, 1.0), (5.0, 2.0), (5.0, 4.0)], schema)
    assert r2_overall(flat).collect()[0]["r2"] is None
    assert trend_line(flat).collect()[0]["slope"] == 0.0
    two = trend_line(spark.createDataFrame([(1.0, 1.0), (2.0, 2.0)], schema)).collect()[0]
    assert (two["slope"], two["se_slope"]) == (1.0, None)
    same = spark.createDataFrame([(1.0, 3.0), (2.0, 3.0), (4.0, 3.0)], schema)
    assert trend_line(same).collect()[0]["slope"] is None and trend_band(same).collect() == []
    line = trend_band(spark.createDataFrame([(2.0 * i, float(i)) for i in range(9)], schema), points=5).collect()
    assert [r["fit"] for r in line] == pytest.approx([0, 4, 8, 12, 16])
    assert all(r["lower"] == pytest.approx(r["fit"]) == pytest.approx(r["upper"]) for r in line)


def test_additive_tag_alone_is_no_sum(spark):
    """K2: a company that reports only the additive tag keeps missing years missing; one
    with a fill tag as well gets the sum, additive values off the template count as reported."""
    from ledgerlens.operators.resolve import concept_table, resolve_concepts
    rows = [("a", 2020), ("a", 2021), ("b", 2020), ("b", 2021)]
    template = spark.createDataFrame(rows, "cik string, fy int")
    values = spark.createDataFrame([("a", "Add", 2020, 5.0), ("b", "Add", 1999, 1.0), ("b", "Fill", 2020, 7.0)],
                                   "cik string, tag string, fy int, val double")
    ct = concept_table(spark, {"c": ["Fill"]}, {"c": "Add"})
    got = {(r["cik"], r["fy"]): r["val"] for r in resolve_concepts(template, values, ct, keys=["fy"]).collect()}
    assert got == {("a", 2020): 5.0, ("b", 2020): 7.0, ("b", 2021): 0.0}


def test_resampled_band_is_near_the_normal_one_and_covers(spark):
    """On normal data the resampled band is the parametric one within a tenth of its
    width; over many samples it holds the true line about as often as it says; any
    partitions give the same band; no line, no rows."""
    import numpy as np
    from ledgerlens.operators.stats import trend_band, trend_band_resampled
    schema = "ticker string, fy int, theoretical_price double, stock_price double"

    def sample(seed, n):
        rng = np.random.default_rng(seed)
        x = rng.normal(size=n) * 10 + 1000
        return spark.createDataFrame([(f"T{i}", 2020, float(a), float(2 * a + 5 + e)) for i, (a, e) in enumerate(zip(x, rng.normal(size=n) * 8))], schema)

    df = sample(1, 800)
    a = {r["point"]: r for r in trend_band(df).collect()}
    b = {r["point"]: r for r in trend_band_resampled(df).collect()}
    assert len(b) == 100
    for i in a:
        width = a[i]["upper"] - a[i]["lower"]
        assert abs(a[i]["x"] - b[i]["x"]) < 1e-9 and abs(a[i]["fit"] - b[i]["fit"]) < 1e-6
        assert max(abs(a[i]["lower"] - b[i]["lower"]), abs(a[i]["upper"] - b[i]["upper"])) < 0.2 * width
    again = {r["point"]: r for r in trend_band_resampled(df.repartition(5, "ticker")).collect()}
    assert all(abs(again[i][c] - b[i][c]) < 1e-6 for i in b for c in ("lower", "upper"))
    held = 0
    for seed in range(20):
        r = trend_band_resampled(sample(100 + seed, 120), draws=300, points=3).collect()[1]
        held += r["lower"] <= 2 * r["x"] + 5 <= r["upper"]
    assert held >= 16
    flat = spark.createDataFrame([("A", 1, 1.0, 2.0), ("B", 1, 1.0, 3.0), ("C", 1, 1.0, 4.0), ("D", 1, None, 4.0)], schema)
    assert trend_band_resampled(flat).collect() == [] and trend_band_resampled(flat.limit(0)).collect() == []


@pytest.mark.parametrize("accuracy", [10_000, 25, 5])
def test_quantiles_inside_brackets_are_exact(spark, monkeypatch, accuracy):
    """Groups taken whole and groups inside brackets of a coarse sketch: numpy's values, with
    ties, missing values, a null key and a group of one; also when the sketch is off."""
    import numpy as np
    from ledgerlens.operators import quantiles
    rng = np.random.default_rng(6)
    rows = [("a", float(v)) for v in rng.normal(size=3000)] + [("b", float(v)) for v in rng.integers(0, 4, 700)] + [(None, float(v)) for v in rng.exponential(size=400)]
    rows += [("one", 3.0), ("none", None), ("none", float("nan")), ("a", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(6)
    probs = [0.0, 0.01, 0.5, 0.99, 1.0]
    groups = {}
    for g, v in rows:
        if v is not None and v == v:
            groups.setdefault(g, []).append(v)

    def check():
        got = {(r["g"], r["p"]): r["q"] for r in quantiles.exact_quantiles(df, "v", probs, ["g"], accuracy).collect()}
        assert got.keys() == {(g, p) for g in groups for p in probs}
        assert all(got[g, p] == pytest.approx(np.quantile(v, p), abs=1e-12) for g, v in groups.items() for p in probs)

    check()
    if accuracy == 5:
        real = quantiles._brackets
        monkeypatch.setattr(quantiles, "_brackets", lambda *a: real(*a).withColumn("_spans", F.transform("_spans", lambda s: s.withField("low", F.lit(0.4)).withField("high", F.lit(0.6)))))
        check()
    whole = quantiles.exact_quantiles(df, "v", [0.5], accuracy=accuracy).collect()
    assert [r["q"] for r in whole] == [pytest.approx(np.median([v for x in groups.values() for v in x]))]
