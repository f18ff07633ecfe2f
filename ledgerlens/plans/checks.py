"""Registered checks: each is (spark, sf_dir) -> DataFrame over the driver tables.

Every check runs the library operators over whole tables (no row caps, no key
subsets) and rounds floating outputs to 4 decimals, the oracle comparison rule.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from ..constants import MODEL_FAMILIES, PANEL_BASE_COLUMNS, VALUATION_V1_COLUMNS
from ..functions.sic import broad_industry
from ..operators.derive import derive_line_items
from ..operators.valuation import valuation_v1, valuation_v2
from ..sources import standin

NUMERIC_PANEL = [c for c in PANEL_BASE_COLUMNS if c not in ("ticker", "name", "industry", "fy", "fp", "filed")]
V2_COLUMNS = [c for c in VALUATION_V1_COLUMNS if c != "career_value"] + [
    "capped_eps", "capped_roa", "business_value"]


def bq(name: str):
    return F.col(f"`{name}`")


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """Round every floating column (oracle comparison rule)."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            out.append((F.round(bq(f.name), digits) + F.lit(0.0)).alias(f.name))
        else:
            out.append(bq(f.name))
    return df.select(*out)


# ---- panel and valuation ----------------------------------------------------------

def derived_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive_line_items(standin.supplier_year_panel(spark, sf_dir))


def valued_panel(spark: SparkSession, sf_dir: str, version: int = 1) -> DataFrame:
    p = derived_panel(spark, sf_dir)
    return valuation_v1(p) if version == 1 else valuation_v2(p)


def panel_line_items(spark, sf_dir):
    p = derived_panel(spark, sf_dir)
    return rounded(p.select("ticker", "fy", F.col("filed").cast("string").alias("filed"),
                            *[bq(c) for c in NUMERIC_PANEL]))


def valuation_v1_check(spark, sf_dir):
    p = valued_panel(spark, sf_dir, 1)
    return rounded(p.select("ticker", "fy", *VALUATION_V1_COLUMNS))


def valuation_v2_check(spark, sf_dir):
    p = valued_panel(spark, sf_dir, 2)
    return rounded(p.select("ticker", "fy", *V2_COLUMNS))


def industry_totals(spark, sf_dir):
    """A1: rows, companies and market cap per broad industry."""
    p = valued_panel(spark, sf_dir, 1).withColumn("broad_industry", broad_industry("industry"))
    out = p.groupBy("broad_industry").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct("ticker").alias("n_companies"),
        F.sum("market_cap").alias("market_cap"))
    return rounded(out, 2)


# ---- repair, routing and audit -----------------------------------------------------

def _cleanup(spark, sf_dir):
    from ..operators.repair import cleanup
    from ..session import cut
    # stage boundary: the valued panel feeds every routing branch
    return cleanup(cut(valued_panel(spark, sf_dir, 1)))


def route_damaged(spark, sf_dir):
    from ..operators.repair import damaged_flags
    return damaged_flags(valued_panel(spark, sf_dir, 1))


def shares_fill(spark, sf_dir):
    from ..operators.repair import damaged_flags, fill_shares
    p = valued_panel(spark, sf_dir, 1)
    rest = p.join(damaged_flags(p).select("ticker"), "ticker", "left_anti")
    return rounded(fill_shares(rest).select("ticker", "fy", bq("shares#"), "shares_filled"))


def route_zero_shares(spark, sf_dir):
    r = _cleanup(spark, sf_dir)
    return r.damaged.join(r.zero, "ticker", "left_semi").groupBy("ticker").agg(
        F.count(F.lit(1)).alias("n_rows"))


def eps_repair(spark, sf_dir):
    r = _cleanup(spark, sf_dir)
    rows = r.clean.unionByName(r.less_data)
    return rounded(rows.select("ticker", "fy", "eps"))


def cleanup_valuation(spark, sf_dir):
    from ..constants import VALUATION_V1_COLUMNS
    r = _cleanup(spark, sf_dir)
    return rounded(r.clean.select("ticker", "fy", bq("shares#"), "eps", *VALUATION_V1_COLUMNS))


def route_less(spark, sf_dir):
    r = _cleanup(spark, sf_dir)
    return r.less_data.groupBy("ticker").agg(F.count(F.lit(1)).alias("n_rows"))


def audit_merge(spark, sf_dir):
    return _cleanup(spark, sf_dir).messages


def success_rate(spark, sf_dir):
    """Companies that came through the cleanup, of all."""
    from ..operators.repair import success_rate as rate
    routes = _cleanup(spark, sf_dir).routes     # every company of the panel is on one route
    log = routes.groupBy("ticker").agg(F.max(F.when(F.col("route") == "damaged", 1)).alias("bad")) \
        .select("ticker", F.when(F.col("bad") == 1, "Fail").otherwise("Success").alias("status"))
    return rounded(rate(log))


def run_stats(spark, sf_dir):
    from ..operators.repair import run_stats as stats
    return stats(_cleanup(spark, sf_dir).routes)


# ---- features and statistics ----------------------------------------------------------

def features(spark, sf_dir):
    from ..operators.features import analysis_features
    from ..session import cut
    # stage boundary: the analysis frame feeds quantile passes and many aggregates
    return cut(analysis_features(_cleanup(spark, sf_dir).clean))


def trimmed(spark, sf_dir):
    from ..operators.stats import trim
    return trim(features(spark, sf_dir))


def ratio_score_check(spark, sf_dir):
    return features(spark, sf_dir).select("ticker", "fy", "broad_industry", "ratio_score")


def per_share_log(spark, sf_dir):
    from ..operators.features import correlation_factors
    return rounded(features(spark, sf_dir).select("ticker", "fy", *[bq(c) for c in correlation_factors()]))


def small_fold_check(spark, sf_dir):
    from ..constants import SMALL_SHARE_CAP, SMALL_SHARE_COUNT
    from ..operators.stats import industry_totals as totals, small_fold
    t = totals(features(spark, sf_dir))
    a = small_fold(t, "n_rows", SMALL_SHARE_COUNT).select("label", F.lit("n_rows").alias("metric"),
                                                         F.col("n_rows").cast("double").alias("value"))
    b = small_fold(t, "market_cap", SMALL_SHARE_CAP).select("label", F.lit("market_cap").alias("metric"),
                                                            F.col("market_cap").alias("value"))
    return rounded(a.unionByName(b), 2)


def quantile_trim(spark, sf_dir):
    return rounded(trimmed(spark, sf_dir).select("ticker", "fy", "theoretical_price", "stock_price"))


def industry_year_means(spark, sf_dir):
    from ..operators.stats import industry_year_means as f
    return rounded(f(trimmed(spark, sf_dir)))


def corr_overall(spark, sf_dir):
    from ..operators.features import correlation_factors
    from ..operators.stats import corr_overall as f
    return rounded(f(trimmed(spark, sf_dir), correlation_factors()))


def corr_by_group(spark, sf_dir):
    from ..operators.features import correlation_factors
    from ..operators.stats import corr_by_group as f
    return rounded(f(trimmed(spark, sf_dir), correlation_factors()))


def r2_overall(spark, sf_dir):
    from ..operators.stats import r2_overall as f
    return rounded(f(trimmed(spark, sf_dir)))


def r2_by_year(spark, sf_dir):
    from ..operators.stats import r2_by_year as f
    return rounded(f(trimmed(spark, sf_dir)))


def trend_line(spark, sf_dir):
    from ..operators.stats import trend_line as f
    return rounded(f(trimmed(spark, sf_dir)))


def trend_band(spark, sf_dir):
    from ..operators.stats import trend_band as f
    return rounded(f(trimmed(spark, sf_dir)))


def trend_band_resampled(spark, sf_dir):
    """The band from resamples; rows drawn by hash, so reruns agree."""
    from ..operators.stats import trend_band_resampled as f
    return rounded(f(trimmed(spark, sf_dir), key=("ticker", "fy", "fp")))


def size_scale_check(spark, sf_dir):
    """Marker size of every company year."""
    from ..operators.features import size_scale
    return rounded(size_scale(features(spark, sf_dir)).select("ticker", "fy", "norm_size"))


def sic_groups(spark, sf_dir):
    """Industry text -> broad industry."""
    p = derived_panel(spark, sf_dir)
    return p.groupBy("industry", broad_industry("industry").alias("broad_industry")).agg(F.count(F.lit(1)).alias("n_rows"))


def bin_pivot(spark, sf_dir):
    from ..operators.stats import bin_pivot as f
    return rounded(f(trimmed(spark, sf_dir)))


def inf_missing_profile(spark, sf_dir):
    from ..operators.features import analysis_numeric_columns
    from ..operators.stats import missing_profile
    f = features(spark, sf_dir)
    cols = analysis_numeric_columns()
    return rounded(missing_profile(f, cols))


def missing_ratio(spark, sf_dir):
    from ..operators.features import analysis_numeric_columns
    from ..operators.stats import missing_ratio as mr
    f = features(spark, sf_dir)
    cols = analysis_numeric_columns()
    return rounded(mr(f, cols))


def median_impute(spark, sf_dir):
    from ..operators.features import correlation_factors
    from ..operators.stats import impute_medians
    f = features(spark, sf_dir)
    cols = correlation_factors() + ["theoretical_price", "stock_price"]
    return rounded(impute_medians(f, cols).select("ticker", "fy", *[bq(c) for c in cols]))


def factor_long(spark, sf_dir):
    from ..operators.features import correlation_factors, size_scale
    from ..operators.stats import factor_long as f
    return rounded(f(size_scale(features(spark, sf_dir)), correlation_factors()))


def top_k_cap(spark, sf_dir):
    from ..operators.stats import top_k_cap as f
    return rounded(f(features(spark, sf_dir)), 2)


def residual(spark, sf_dir):
    from ..operators.features import with_residual
    return rounded(with_residual(trimmed(spark, sf_dir)).select("ticker", "fy", "model_error"))


# ---- filings: filters, dedupe, eligibility, concept resolution ------------------------

def _facts_ctx(spark, sf_dir):
    from ..operators import filters as fl
    from ..operators.resolve import concept_table
    from ..session import cut
    s = standin
    facts = cut(s.raw_facts(spark, sf_dir))
    annual = fl.annual_facts(facts, start=s.STANDIN_START)
    latest = cut(fl.keep_latest(annual))
    elig = cut(fl.eligibility(facts, s.STANDIN_ANCHOR, s.STANDIN_START, s.STANDIN_END, 7))
    ok = elig.filter("eligible").select("cik")
    template = cut(latest.filter(F.col("tag") == s.STANDIN_ANCHOR).join(ok, "cik", "left_semi")
                   .select("cik", "fy", "fp", "filed", "end"))
    values = latest.join(ok, "cik", "left_semi")
    concepts = concept_table(spark, s.STANDIN_CONCEPTS, s.STANDIN_ADDITIVE)
    return dict(facts=facts, annual=annual, latest=latest, elig=elig, ok=ok, template=template,
                values=values, concepts=concepts)


def form_filter(spark, sf_dir):
    from ..operators.filters import annual_form, study_window
    f = standin.raw_facts(spark, sf_dir)
    return f.filter(annual_form() & study_window("fy", standin.STANDIN_START)).groupBy("cik", "tag").agg(
        F.count(F.lit(1)).alias("n"))


def duration_filter(spark, sf_dir):
    return _facts_ctx(spark, sf_dir)["annual"].groupBy("cik", "tag").agg(F.count(F.lit(1)).alias("n"))


def namespace_rank(spark, sf_dir):
    from ..operators.filters import namespace_choice
    return namespace_choice(standin.mixed_namespace_facts(spark, sf_dir), standin.STANDIN_ANCHOR)


def dedupe_latest(spark, sf_dir):
    lt = _facts_ctx(spark, sf_dir)["latest"]
    return rounded(lt.select("cik", "tag", "fy", "fp", F.col("end").cast("string").alias("end"),
                             F.col("filed").cast("string").alias("filed"), "val"))


def eligibility_check(spark, sf_dir):
    return _facts_ctx(spark, sf_dir)["elig"]


def fallback_fill(spark, sf_dir):
    from ..operators.resolve import resolve_concepts
    c = _facts_ctx(spark, sf_dir)
    r = resolve_concepts(c["template"], c["values"], c["concepts"])
    # nullable integers change dtype in pandas round-trips; -1 marks "additive only"
    return rounded(r.select("cik", "concept", "fy", "val",
                            F.coalesce(F.col("src_rank"), F.lit(-1)).alias("src_rank")))


def provenance_check(spark, sf_dir):
    from ..operators.resolve import provenance, resolve_concepts
    c = _facts_ctx(spark, sf_dir)
    r = resolve_concepts(c["template"], c["values"], c["concepts"])
    return provenance(c["values"], r, c["concepts"])


def tag_inventory_check(spark, sf_dir):
    from ..operators.filters import namespace_choice
    from ..operators.resolve import tag_inventory
    from ..session import cut
    f = cut(standin.raw_facts(spark, sf_dir))
    inv = tag_inventory(f, namespace_choice(f, standin.STANDIN_ANCHOR))
    return inv.select("cik", F.array_join("tags", ",").alias("tags"))


def _missing(spark, sf_dir):
    from ..operators.resolve import missing_required
    c = _facts_ctx(spark, sf_dir)
    avail = c["values"].filter(F.col("val").isNotNull()).join(F.broadcast(c["concepts"]), "tag") \
        .select("cik", "concept").distinct()
    required = {k: v[0] for k, v in standin.STANDIN_CONCEPTS.items()}
    return c, missing_required(avail, c["ok"], required)


def required_tags(spark, sf_dir):
    return _missing(spark, sf_dir)[1]


def tag_suggest(spark, sf_dir):
    from ..constants import SUGGEST_IGNORE_WORDS
    from ..operators.resolve import tag_inventory, tag_suggestions
    c, miss = _missing(spark, sf_dir)
    s = tag_suggestions(miss, tag_inventory(c["facts"]), SUGGEST_IGNORE_WORDS)
    return s.select("cik", "missing_tag", F.array_join("suggestions", ",").alias("suggestions"))


# ---- prices: forward event-window as-of join -----------------------------------------------

def event_window_price(spark, sf_dir):
    from ..operators.asof import forward_window_mean
    a = standin.event_anchors(spark, sf_dir)
    p = standin.event_prices(spark, sf_dir)
    return rounded(forward_window_mean(a, p, n=5, bucket="day").select("anchor_id", "mean_next", "n_used"))


# ---- per-industry model search ---------------------------------------------------------------
# Stand-in split (FIXTURES): the seven order years 1995-2001, train <= 1999, test >= 2000.
STANDIN_TRAIN_LAST, STANDIN_TEST_FIRST = 1999, 2000


def _search(spark, sf_dir, families=MODEL_FAMILIES, frame=None):
    """A whole search of ``families``, from the tables (or their analysis frame): nothing is
    kept between calls."""
    from . import models as M
    plan = M.prepare(features(spark, sf_dir) if frame is None else frame, STANDIN_TRAIN_LAST, STANDIN_TEST_FIRST)
    return M.search(None, families, plan=plan)


def time_split(spark, sf_dir):
    from ..constants import OTHER_GROUP
    f = features(spark, sf_dir).filter(F.col("broad_industry") != OTHER_GROUP)
    return f.groupBy("broad_industry").agg(
        F.sum((F.col("fy") <= STANDIN_TRAIN_LAST).cast("int")).cast("long").alias("n_train"),
        F.sum((F.col("fy") >= STANDIN_TEST_FIRST).cast("int")).cast("long").alias("n_test"),
        F.countDistinct("ticker").alias("n_companies"))


def scaled_train(spark, sf_dir):
    """M3 inputs: train mean / population std of each median-imputed candidate factor."""
    from ..constants import OTHER_GROUP
    from ..operators.features import correlation_factors
    from ..operators.stats import impute_medians
    cand = [c for c in correlation_factors()]
    f = features(spark, sf_dir).filter(F.col("broad_industry") != OTHER_GROUP)
    imp = impute_medians(f, cand).filter(F.col("fy") <= STANDIN_TRAIN_LAST)
    g = imp.groupBy("broad_industry").agg(*[x for i, c in enumerate(cand) for x in (
        F.avg(bq(c)).alias(f"m{i}"), F.stddev_pop(bq(c)).alias(f"s{i}"))])
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"m{i}").alias("mean"),
                                         F.col(f"s{i}").alias("std")) for i, c in enumerate(cand)]))
    return rounded(g.select("broad_industry", pairs.alias("p")).select("broad_industry", "p.*"))


def _family_rows(spark, sf_dir, fam):
    from . import models as M
    res = _search(spark, sf_dir, (fam,))[0]
    return rounded(M.results_frame(spark, res))


def ols_prefix_r2(spark, sf_dir):
    return _family_rows(spark, sf_dir, "Linear Regression")


def ridge_prefix_r2(spark, sf_dir):
    return _family_rows(spark, sf_dir, "Ridge Regression")


def kernel_search(spark, sf_dir):
    return _family_rows(spark, sf_dir, MODEL_FAMILIES[4])


def tree_search(spark, sf_dir):
    return _family_rows(spark, sf_dir, "Decision Tree")


def forest_search(spark, sf_dir):
    return _family_rows(spark, sf_dir, "Random Forest")


def boost_search(spark, sf_dir):
    return _family_rows(spark, sf_dir, MODEL_FAMILIES[5])


def model_summary(spark, sf_dir):
    from . import models as M
    res, best_fam, best, plan, coefs = _search(spark, sf_dir)
    return rounded(M.summary_frame(spark, best, plan))


def family_comparison(spark, sf_dir):
    """Best ratio / R^2 per (industry, family)."""
    res, best_fam, best, plan, coefs = _search(spark, sf_dir)
    rows = [(i, f, float(v[0]), int(v[1]), float(v[3])) for (i, f), v in sorted(best_fam.items())]
    return rounded(spark.createDataFrame(rows, "broad_industry string, family string, ratio double, "
                                               "n_features int, r2 double"))


def actual_vs_predicted(spark, sf_dir):
    """Test rows scored by their industry's winning model."""
    from . import models as M
    res, best_fam, best, plan, coefs = _search(spark, sf_dir)
    test = plan.data.filter(F.col("split") == "test")
    p = M.predict_best(plan, best, coefs, test)
    return rounded(p.select("broad_industry", "ticker", "fy", "stock_price", "prediction"))


def case_study(spark, sf_dir):
    """One seeded test-set company per industry, all its years scored."""
    from . import models as M
    res, best_fam, best, plan, coefs = _search(spark, sf_dir)
    rows = plan.data.join(M.case_study_tickers(plan, sorted(best)), ["broad_industry", "ticker"], "left_semi")
    p = M.predict_best(plan, best, coefs, rows)
    return rounded(p.select("broad_industry", "ticker", "fy", "stock_price", "prediction")).orderBy("broad_industry", "fy")


def top_cap_scores(spark, sf_dir):
    """Global top-20 companies by mean market cap, scored by their industry's model."""
    from . import models as M
    frame = features(spark, sf_dir)         # for the search and the choice of companies
    res, best_fam, best, plan, coefs = _search(spark, sf_dir, frame=frame)
    top = M.top_cap_members(frame)
    rows = plan.data.join(top, "ticker", "left_semi")
    p = M.predict_best(plan, best, coefs, rows)
    return rounded(p.select("broad_industry", "ticker", "fy", "stock_price", "prediction"))


# ---- sources: directory, JSON field access, retry selection, top-k profile -----------------

def directory_scan(spark, sf_dir):
    """Company directory JSON (suppliers as filers) -> 10-digit zero-padded id,
    ticker, title, place in the directory."""
    from ..sources.filings import flatten_directory
    return flatten_directory(standin.directory_documents(spark, sf_dir), "doc")


def json_facts(spark, sf_dir):
    """Nested company-facts JSON, parsed with the fixed schema and flattened."""
    from ..sources.filings import COMPANY_FACTS, flatten_facts
    docs = standin.facts_documents(spark, sf_dir).withColumn("p", F.from_json("doc", COMPANY_FACTS)).select("cik", "p.facts")
    f = flatten_facts(docs)
    return rounded(f.select("cik", "ns", "tag", "unit", *[F.col(c).cast("string").alias(c) for c in ("start", "end", "filed")],
                            "val", "fy", "fp", "form", "has_start"))


def json_field(spark, sf_dir):
    """A field of a JSON payload column, parsed with a fixed schema."""
    ev = standin.table(spark, sf_dir, "events")
    k = F.from_json(F.col("props"), "k long").getField("k")
    return ev.select("event_id", k.alias("k"))


def retry_set_check(spark, sf_dir):
    """Failed companies whose logged error matches a pattern. The run log
    here is the cleanup outcome: relocated / deleted companies are 'Fail' with
    their message; the retry pattern selects the share-count failures."""
    from .panel import retry_set
    m = _cleanup(spark, sf_dir).messages
    fail = F.col("update_after_cleanup").like("Relocated%") | F.col("update_after_cleanup").like("Deleted%")
    log = m.select(F.col("ticker").alias("cik"),
                   F.when(fail, F.lit("Fail")).otherwise(F.lit("Success")).alias("status_after_recovery1"),
                   F.col("update_after_cleanup").alias("error_after_recovery1"))
    return retry_set(log, "%shares#%")


def top_missing(spark, sf_dir):
    """O3: top-10 columns by missing % per industry (ties by column name)."""
    from ..operators.features import analysis_numeric_columns
    from ..operators.stats import missing_profile, top_missing as tm
    p = missing_profile(features(spark, sf_dir), analysis_numeric_columns())
    return rounded(tm(p, 10).drop("rank"))


# ---- complete stage 1 over the driver tables ----------------------------------------------

def _panel_build(spark, sf_dir):
    from .panel import build_panel
    return build_panel(standin.taxonomy_facts(spark, sf_dir), standin.taxonomy_companies(spark, sf_dir),
                       standin.daily_prices(spark, sf_dir), start=standin.STANDIN_START,
                       end=standin.STANDIN_END, run_ts="2001-12-31 00:00:00")


def panel_build(spark, sf_dir):
    """Stage 1 end to end: facts -> filters -> fallback -> special rules -> prices -> valuation."""
    p = _panel_build(spark, sf_dir).panel
    return rounded(p.drop("tag_history").withColumn("filed", F.col("filed").cast("string")))


def panel_build_log(spark, sf_dir):
    """Q8: one log row per company (status, error, namespace)."""
    return _panel_build(spark, sf_dir).log.drop("timestamp")
