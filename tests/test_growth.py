"""How work and moved rows grow: what travels between tasks, and how many jobs a fit takes."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import quantiles
from ledgerlens.plans import fits, svr, trees
from ledgerlens.sources import standin
from test_model_fits import BY_PASSES, FEW, close, scored, specs, toy

D = dt.datetime


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """One supplier with 40 lines in a year and one with a single line, under shared orders."""
    at = str(tmp_path_factory.mktemp("tables"))
    lines = [(i % 10, 1 if i else 2, float(i + 1), 700.0 + i, 0.01 * (i % 5), 0.02, "ANR"[i % 3], "FO"[i % 2], D(1996, 1 + i % 12, 3)) for i in range(41)]
    spark.createDataFrame(lines, "l_orderkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                                 "l_returnflag string, l_linestatus string, l_shipdate timestamp").write.parquet(f"{at}/lineitem.parquet")
    orders = [(i, "FOP"[i % 3], 1000.0 * (i + 1), D(1995, 1 + i % 4, 5), ["1-URGENT", "2-HIGH", "5-LOW"][i % 3]) for i in range(10)]
    spark.createDataFrame(orders, "o_orderkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string") \
        .write.parquet(f"{at}/orders.parquet")
    spark.createDataFrame([(1, "one", 0, 10.0), (2, "two", 0, 20.0)], "s_suppkey long, s_name string, s_nationkey int, s_acctbal double").write.parquet(f"{at}/supplier.parquet")
    spark.createDataFrame([(0, 0)], "n_nationkey int, n_regionkey int").write.parquet(f"{at}/nation.parquet")
    spark.createDataFrame([(0, "EUROPE")], "r_regionkey int, r_name string").write.parquet(f"{at}/region.parquet")
    return at, lines, orders


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    return [line.split("Exchange hashpartitioning(")[1] for line in plan.splitlines() if "Exchange hashpartitioning(" in line]


def test_a_large_node_is_split_from_sums_as_if_ordered(monkeypatch):
    rng = np.random.default_rng(3)
    bins = rng.integers(0, 40, (900, 4)).astype(np.uint8)
    bins[:, 2] = bins[:, 1]                                 # equal gains: the first feature wins
    q, w = rng.integers(-1000, 1000, 900), rng.poisson(1, 900)
    one = np.ones(900, np.int64)
    shallow = trees.grow(bins, q, one, 1.0, 4)
    assert vars(shallow) == vars(trees._grow_sorted(bins, q, one, 1.0, 4))
    monkeypatch.setattr(trees, "SORTED_ROWS", 60)
    whole, ordered = trees.grow(bins, q, w), trees._grow_sorted(bins, q, w)
    assert len(whole.feature) == len(ordered.feature) and np.array_equal(whole.predict(bins), ordered.predict(bins))


def test_boosting_of_a_large_industry_is_one_job_not_one_a_level(spark, monkeypatch):
    plan = toy(spark)
    want = scored(fits.predictions(plan, specs([fits.BOOST]), plan.data, FEW))
    by_passes = trees.Settings(**{**vars(BY_PASSES), "boost_rows": 10})
    close(scored(fits.predictions(plan, specs([fits.BOOST]), plan.data, by_passes)), want)
    monkeypatch.setattr(trees, "boosted", None)             # no passes from here on
    close(scored(fits.predictions(plan, specs([fits.BOOST]), plan.data, BY_PASSES)), want)


def test_support_vector_passes_send_vectors_to_the_driver(spark, monkeypatch):
    sent, plain = [], svr.newton

    def watched(dim, *rest):
        solver = plain(dim, *rest)
        try:
            asked = next(solver)
            while True:
                answer = yield asked
                sent.append((dim, sum(np.size(x) for x in answer if x is not None)))
                asked = solver.send(answer)
        except StopIteration as done:
            return done.value

    plan = toy(spark)
    want = scored(fits.predictions(plan, specs([fits.SVR]), plan.data, FEW))
    monkeypatch.setattr(svr, "newton", watched)
    close(scored(fits.predictions(plan, specs([fits.SVR]), plan.data, BY_PASSES)), want, 1e-4)
    assert sent and all(n <= max(dim + 2, len(svr.STEPS)) for dim, n in sent)


def test_lines_of_a_company_year_travel_before_they_are_summed(spark, tables):
    at, lines, orders = tables
    panel = standin.supplier_year_panel(spark, at)
    assert any("l_suppkey" in e and "part" in e for e in exchanges(panel))
    got = {r["ticker"]: r for r in panel.collect()}
    mine = [x for x in lines if x[1] == 1]
    assert got["S1"]["gross_revenue"] == pytest.approx(sum(x[3] for x in mine) / 7)
    assert got["S1"]["asset"] == pytest.approx(sum(orders[x[0]][2] for x in mine) / 7)
    assert got["S1"]["shares#"] == sum(x[2] for x in mine) and got["S1"]["filed"] == dt.date(1996, 12, 3)
    assert got["S2"]["gross_revenue"] == pytest.approx(100.0)


def exchanged(df, keys):
    """Rows that the executed plan wrote to its exchange by exactly these keys, and the columns they had."""
    def nodes(p):
        yield p
        kind = p.getClass().getSimpleName()
        below = p.children()
        for c in ([p.executedPlan()] if kind == "AdaptiveSparkPlanExec" else [p.plan()] if kind.endswith("QueryStageExec") else [below.apply(i) for i in range(below.size())]):
            yield from nodes(c)

    for p in nodes(df._jdf.queryExecution().executedPlan()):
        if p.getClass().getSimpleName() == "ShuffleExchangeExec":
            by = p.outputPartitioning().toString().split("(", 1)[1].split(", ")
            if [b.split("#")[0] for b in by[:-1]] == keys:
                out = p.output()
                return p.metrics().apply("shuffleRecordsWritten").value(), [out.apply(i).name() for i in range(out.size())]


def test_sums_of_a_company_year_travel_once_unless_it_is_hot(spark, tables, monkeypatch):
    at = tables[0]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        panel = standin.supplier_year_panel(spark, at)
        want = panel.collect()
        monkeypatch.setattr(standin, "HOT_LINES", 39)
        hot = standin.supplier_year_panel(spark, at)
        got = {r["ticker"]: r for r in hot.collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert exchanged(panel, ["l_suppkey", "fy"])[0] == 2                # a row a company year
    assert 2 < exchanged(hot, ["l_suppkey", "fy"])[0] <= standin.SPREAD + 1
    for r in want:
        assert got[r["ticker"]].asDict() == {k: pytest.approx(v) if isinstance(v, float) else v for k, v in r.asDict().items()}


def test_codes_travel_as_bits_and_missing_ones_count_nowhere(spark, tables, tmp_path):
    at, lines, orders = tables
    for name in ("supplier", "nation", "region"):
        (tmp_path / f"{name}.parquet").symlink_to(f"{at}/{name}.parquet")
    blank = lambda df, c, k: df.withColumn(c, F.when(k % 4 != 0, F.col(c)))
    li, od = (spark.read.parquet(f"{at}/{x}.parquet") for x in ("lineitem", "orders"))
    li = blank(blank(li, "l_returnflag", F.col("l_quantity")), "l_linestatus", F.col("l_quantity") + 1)
    li.write.parquet(f"{tmp_path}/lineitem.parquet")
    blank(od, "o_orderstatus", F.col("o_orderkey")).write.parquet(f"{tmp_path}/orders.parquet")
    panel = standin.supplier_year_panel(spark, str(tmp_path))
    got = {r["ticker"]: r for r in panel.collect()}["S1"]
    moved = exchanged(panel, ["l_suppkey", "fy", "part"])[1]
    assert not {"l_returnflag", "l_linestatus", "o_orderstatus"} & set(moved)
    mine = [(x[2], x[3] / 7, x[4], x[5], x[6] if x[2] % 4 else None, x[7] if (x[2] + 1) % 4 else None, orders[x[0]][2] / 7, orders[x[0]][1] if x[0] % 4 else None)
            for x in lines if x[1] == 1]
    want = {"equity": sum(x[6] for x in mine if x[4] == "A"), "currasset": sum(x[6] for x in mine if x[4] == "N"),
            "curr_liabilities": sum(x[6] for x in mine if x[4] == "R"), "cost": sum(x[1] * (1 - x[2]) for x in mine if x[4] == "R"),
            "expense_general/admin": sum(x[1] * x[3] for x in mine if x[5] == "O"), "inventory": sum(x[1] for x in mine if x[5] == "F" and x[0] <= 10),
            "investing_cash": -sum(x[1] * x[3] for x in mine if x[7] == "O"), "payment_cap": sum(x[1] * x[2] for x in mine if x[7] == "F"),
            "payment_intangible": sum(x[1] * x[3] for x in mine if x[7] == "P")}
    assert {k: got[k] for k in want} == {k: pytest.approx(v) for k, v in want.items()}


def test_documents_of_companies_take_one_shuffle_of_their_facts(spark, tables):
    docs = standin.facts_documents(spark, tables[0])
    assert not any(e.startswith("cik") and "ns" in e.split("),")[0] for e in exchanges(docs))
    assert docs.count() == 2


def test_facts_of_company_years_take_one_pass_over_the_lines(spark, tables):
    at, lines, orders = tables
    facts = standin.taxonomy_facts(spark, at)
    plan = facts._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 2       # lines and orders
    got = {(r["cik"], r["fy"], r["tag"]): r for r in facts.collect()}
    want, assets, shares = {}, {}, {}
    for k, supp, q, price, _, _, rf, ls, _ in lines:
        year = (f"{supp:010d}", orders[k][3].year)
        tag, _, sign = standin.TAXONOMY_TAGS[("ANR".index(rf) * 2 + "FO".index(ls)) * 3 + (q > 17) + (q > 34)]
        want[*year, tag] = want.get((*year, tag), 0.0) + sign * price / 7
        assets[year] = assets.get(year, 0.0) + orders[k][2] / 7
        shares[year] = shares.get(year, 0.0) + q
    want |= {(*y, "Assets"): v for y, v in assets.items()} | {(*y, "EntityCommonStockSharesOutstanding"): v for y, v in shares.items()}
    assert {k: r["val"] for k, r in got.items()} == {k: pytest.approx(v) for k, v in want.items()}
    for r in got.values():
        duration = dict((t, d) for t, d, _ in standin.TAXONOMY_TAGS).get(r["tag"], False)
        assert r["start"] == (r["end"] - dt.timedelta(days=364) if duration else None)
        assert (r["ns"], r["unit"]) == (("dei", "shares") if r["tag"].startswith("Entity") else ("us-gaap", "USD"))


def test_medians_of_many_columns_do_not_make_the_rows_long(spark, monkeypatch):
    rng = np.random.default_rng(7)
    rows = [("ab"[i % 2] if i % 9 else None, *[None if rng.random() < 0.2 else float(v) for v in (rng.integers(0, 12), rng.normal())], None, 5.0)
            for i in range(400)]
    df = spark.createDataFrame(rows, "g string, x double, y double, none double, same double").repartition(3)
    monkeypatch.setattr(quantiles, "POINTS", 6)             # wide brackets
    monkeypatch.setattr(quantiles, "exact_quantiles", None)
    got = {(r["g"], r["column"], r["p"]): r["q"] for r in quantiles.exact_quantiles_of(df, ["x", "y", "none", "same"], [0.0, 0.1, 0.5, 1.0], "g").collect()}
    want = {}
    for g in (None, "a", "b"):
        for c, name in ((1, "x"), (2, "y"), (4, "same")):
            v = [r[c] for r in rows if r[0] == g and r[c] is not None]
            want |= {(g, name, p): pytest.approx(float(np.quantile(v, p))) for p in (0.0, 0.1, 0.5, 1.0)}
    assert got == want


def test_support_vectors_of_a_somewhat_larger_industry_are_fitted_in_a_task(spark, monkeypatch):
    plan = toy(spark)
    want = scored(fits.predictions(plan, specs([fits.SVR]), plan.data, FEW))
    most = max(r["count"] for r in plan.data.groupBy(fits.GROUP).count().collect())
    between = trees.Settings(**{**vars(FEW), "local_rows": most})      # less than its training and scored rows, which all count
    monkeypatch.setattr(svr, "fit_by_passes", None)
    close(scored(fits.predictions(plan, specs([fits.SVR]), plan.data, between)), want)


def test_a_full_step_asks_once():
    rng = np.random.default_rng(2)
    z = rng.normal(size=(60, 3))
    y, phi, asked = z[:, 0] + 0.1 * rng.normal(size=60), svr.KernelFeatures(z, 1 / 3), []
    rows = phi(z)

    def answer(*question):
        asked.append(question)
        return svr.answered(question[0], *svr.loss_sums(rows, y, *question), len(y), float(np.std(y)))

    svr.solve(svr.newton(phi.dim, float(np.mean(y)), float(np.std(y))), answer)
    single, tried = ([q for q in asked if (len(q[0]) > 1) == many] for many in (False, True))
    assert len(single) < len(tried)


@pytest.mark.parametrize("family", [fits.TREE, fits.FOREST])
def test_trees_of_a_large_industry_are_grown_in_tasks_not_by_passes(spark, monkeypatch, family):
    plan = toy(spark)
    want = scored(fits.predictions(plan, specs([family]), plan.data, FEW))
    by_passes = trees.Settings(**{**vars(BY_PASSES), "bag_rows": 10})
    close(scored(fits.predictions(plan, specs([family]), plan.data, by_passes)), want)
    monkeypatch.setattr(trees, "grown", None)               # no passes from here on
    monkeypatch.setattr(fits, "LOT_WORK", 1)                # a task for every tree
    close(scored(fits.predictions(plan, specs([family]), plan.data, BY_PASSES)), want)


def test_many_small_nodes_are_ordered_at_a_time(monkeypatch):
    rng = np.random.default_rng(4)
    bins = rng.integers(0, 60, (1500, 3)).astype(np.uint8)
    bins, q, w = np.r_[bins, bins[:300]], rng.integers(-9, 9, 1800) * (1 << 26), rng.poisson(1, 1800)
    whole, calls, plain = trees._grow_sorted(bins, q, w), [], trees._grow_ordered
    monkeypatch.setattr(trees, "_grow_ordered", lambda *a: calls.append(a[4]) or plain(*a))
    for rows, batch, cells in ((30, 400, 3_000), (7, 50, 10 ** 6), (200, 1, 1)):
        monkeypatch.setattr(trees, "SORTED_ROWS", rows), monkeypatch.setattr(trees, "SORTED_BATCH", batch), monkeypatch.setattr(trees, "SPLIT_CELLS", cells)
        calls.clear()
        got = trees.grow(bins, q, w)
        assert len(got.feature) == len(whole.feature) and np.array_equal(got.predict(bins), whole.predict(bins))
        assert (max(calls) > 1) == (batch > 1)


def test_support_vectors_of_a_large_industry_come_packed_to_tasks(spark, monkeypatch):
    plan = toy(spark)
    want = scored(fits.predictions(plan, specs([fits.SVR]), plan.data, FEW))
    monkeypatch.setattr(fits, "SVR_PACKED", 100)
    monkeypatch.setattr(svr, "fit_by_passes", None)         # no passes from here on
    monkeypatch.setattr(fits, "_binned", None)              # nor bins that nobody asks for
    close(scored(fits.predictions(plan, specs([fits.SVR]), plan.data, BY_PASSES)), want, 1e-6)


@pytest.mark.parametrize("held", [0, 300, 10 ** 6])
def test_support_vectors_take_few_sums_over_rows(monkeypatch, held):
    rng = np.random.default_rng(8)
    z = rng.normal(size=(900, 2))
    y, asked, plain = 9 * np.sin(z[:, 0]) + z[:, 1] + rng.normal(size=900), [], svr._Held.products
    z[3], y[3], z[7], y[7] = z[4], y[4], 0.0, 500.0             # a copy and an odd one
    monkeypatch.setattr(svr, "NEWTON_ROWS", 0), monkeypatch.setattr(svr, "CHUNK", 128), monkeypatch.setattr(svr, "HELD", held)
    monkeypatch.setattr(svr._Held, "products", lambda self, *a: asked.append(1) or plain(self, *a))
    phi, theta = svr.fit(z, y, z[:200], 0.5)
    assert 0 < len(asked) < 60
    rows, spread = phi(z), float(np.std(y))
    other = svr.solve(svr.newton(phi.dim, float(np.mean(y)), spread), lambda thetas, delta: svr.answered(thetas, *svr.loss_sums(rows, y, thetas, delta), len(y), spread))
    cost = lambda t: t[:-1] @ t[:-1] / 2 + svr.SVR_C * np.maximum(np.abs(y - rows @ t) - svr.SVR_EPSILON, 0).sum()
    assert cost(theta) <= cost(other) * (1 + 1e-8)
    assert np.allclose(phi.predict(z, theta), rows @ theta) and np.allclose(rows @ theta, rows @ other, atol=1e-2)


@pytest.mark.parametrize("few", [0, 5_000])
def test_support_vectors_of_odd_targets(monkeypatch, few):
    monkeypatch.setattr(svr, "NEWTON_ROWS", few)
    z = np.arange(12.0).reshape(6, 2)
    for y in (np.full(6, 7.0), np.zeros(6), np.r_[1e9, np.zeros(5)]):
        phi, theta = svr.fit(z, y, z, 0.5)
        assert np.isfinite(theta).all() and np.median(np.abs(phi.predict(z, theta) - y)) < 1e9
    phi, theta = svr.fit(z[:1], np.array([3.0]), z[:1], 0.5)
    assert phi.predict(z[:1], theta)[0] == pytest.approx(3.0, abs=0.11) and len(phi.predict(z[:0], theta)) == 0


def test_scores_of_the_largest_companies_build_the_analysis_frame_once(spark, monkeypatch):
    from ledgerlens.plans import checks, models as M
    plan, made, search = toy(spark, n=70), [], M.search
    plan.n_train, plan.n_test = ({i: m[sp].n for i, m in plan.moments.items()} for sp in ("train", "test"))
    monkeypatch.setattr(checks, "features", lambda *a: made.append(1) or plan.data)
    monkeypatch.setattr(M, "prepare", lambda *a: plan)
    monkeypatch.setattr(M, "search", lambda f, families, plan: search(f, (M.LINEAR,), plan=plan))
    got = checks.top_cap_scores(spark, "nowhere").collect()
    assert len(made) == 1 and len(got) == plan.data.count()
