"""Per-industry model search.

Spark-first layout:

* profiling and median imputation are grouped aggregates over the analysis frame (one
  row per company-year); correlations and training statistics follow from co-moments;
* the linear families (OLS, ridge) for *all* industries and *all* feature prefixes come
  from one scan that leaves centred co-moments per industry and split
  (``operators.moments``); the driver solves the leading k x k blocks (k <= 35) -- no
  per-prefix refits;
* trees, forests, boosted trees and support vector regression (``fits``, ``trees``,
  ``svr``) give predictions of all fits in one job, which one grouped aggregate turns
  into R^2; industries too large for a task are fitted by passes over their rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ..constants import (EQUATION, FEATURE_RATIOS, MIN_TEST_ROWS, MIN_TRAIN_ROWS, MISSING_DROP_PCT, MODEL_FAMILIES,
                         OTHER_GROUP, PROTECTED_COLUMNS, RIDGE_ALPHA, SEED, TEST_FIRST_FY, TOP_CAP_COMPANIES, TRAIN_LAST_FY)
from ..functions.numeric import finite_or_null
from ..operators.features import analysis_numeric_columns, correlation_factors
from ..operators import moments
from ..operators.moments import Moments, co_moments, collected
from ..operators.stats import impute_medians, missing_ratio
from ..session import cut
from . import fits

LINEAR, RIDGE = MODEL_FAMILIES[:2]
GROUP = "broad_industry"


def bq(c):
    return F.col(f"`{c}`")


@dataclass
class SearchPlan:
    data: DataFrame                  # imputed, standardised rows (industry, split, z columns, y)
    pools: dict                      # industry -> ordered feature pool
    n_companies: dict
    n_train: dict
    n_test: dict
    stats: dict                      # industry -> (mean vector, std vector) over the pool, training rows
    live: dict                       # industry -> whether a pool feature varies there
    y_stats: dict                    # industry -> (mean, std) of the training prices
    moments: dict                    # industry -> split -> co-moments of the pool and the price


def prepare(features: DataFrame, train_last: int = TRAIN_LAST_FY, test_first: int = TEST_FIRST_FY,
            group: str = GROUP) -> SearchPlan:
    """Drop sparse columns, impute, pool features, split, standardise."""
    df = features.filter(F.col(group) != OTHER_GROUP)
    num = [c for c in analysis_numeric_columns() if c in df.columns]
    df = df.withColumns({c: finite_or_null(bq(c)) for c in num})

    # M1: columns with > 10 % missing per industry (protected columns stay)
    mr = missing_ratio(df, num, group).collect()
    drops = {}
    for r in mr:
        if r["missing_pct"] > MISSING_DROP_PCT and r["column"] not in PROTECTED_COLUMNS:
            drops.setdefault(r[group], set()).add(r["column"])
    # Impute the columns kept by *any* industry with that industry's median;
    # the per-industry drop list is applied when pooling features.
    imputed = cut(impute_medians(df, num, group))

    # one scan of the imputed rows gives all that M2-M5 need: co-moments per industry and split
    cand = [c for c in correlation_factors() if c not in ("stock_price", "stock_price_unadjusted")]
    split = (F.when(F.col("fy") <= train_last, F.lit("train"))
             .when(F.col("fy") >= test_first, F.lit("test")))
    imputed = imputed.withColumn("split", split)
    held = collected(co_moments(imputed, [*cand, "stock_price"], [group, "split"]), [group, "split"])
    companies = {r[group]: r["n"] for r in imputed.groupBy(group).agg(F.countDistinct("ticker").alias("n")).collect()}
    pools, ntr, nte, stats, live, y_stats, held_by = {}, {}, {}, {}, {}, {}, {}
    for ind in companies:
        mine = {sp: m for (i, sp), m in held.items() if i == ind}
        # M2: pool = declared-order correlation factors with a defined correlation
        corr = reduce(Moments.__add__, mine.values()).corr(len(cand))
        pool = [i for i, f in enumerate(cand) if f not in drops.get(ind, set()) and np.isfinite(corr[i])]
        pools[ind] = [cand[i] for i in pool]
        ntr[ind], nte[ind] = (mine[sp].n if sp in mine else 0 for sp in ("train", "test"))
        if "train" not in mine:
            continue
        # F14 split + M3 train statistics (population std; zero -> 1 like the studied scaler)
        at = [*pool, len(cand)]
        held_by[ind] = {sp: Moments(m.n, m.mean[at], m.c[np.ix_(at, at)], m.low[at], m.high[at]) for sp, m in mine.items() if sp}
        train = held_by[ind]["train"]
        sd = train.std[:-1]
        live[ind], stats[ind] = sd > 0, (train.mean[:-1], np.where(sd > 0, sd, 1.0))
        y_stats[ind] = float(train.mean[-1]), float(train.std[-1])
    keep = ["ticker", "fy", group, "split", "stock_price", "market_cap"]
    data = imputed.filter(F.col("split").isNotNull()).select(*keep, *[bq(c) for c in cand])
    return SearchPlan(data, pools, companies, ntr, nte, stats, live, y_stats, held_by)


def feature_columns(plan: SearchPlan) -> list[str]:
    return [c for c in plan.data.columns if c not in ("ticker", "fy", GROUP, "split", "stock_price", "market_cap")]


def eligible_industries(plan: SearchPlan):
    return sorted(i for i in plan.pools
                  if plan.pools[i] and i in plan.stats
                  and plan.n_train.get(i, 0) >= MIN_TRAIN_ROWS and plan.n_test.get(i, 0) >= MIN_TEST_ROWS)


def prefix_sizes(n_pool: int):
    """max(1, floor(n * ratio)) leading features, in declared order."""
    return [(r, max(1, int(n_pool * r))) for r in FEATURE_RATIOS]


def linear_results(plan: SearchPlan, industries, families=(LINEAR, RIDGE)):
    """R^2 on test for OLS / ridge, every prefix: (results, coefficients). Solved on the
    driver from the co-moments of the pool, k x k numbers (k <= 35) an industry."""
    out, coefs = [], {}
    for ind in industries:
        held, (mu, sd) = plan.moments[ind], plan.stats[ind]
        y = len(plan.pools[ind])
        for ratio, k in prefix_sizes(y):
            for fam in families:
                b0, beta = moments.ridge(held["train"], mu[:k], sd[:k], k, y, None if fam == LINEAR else RIDGE_ALPHA)
                out.append((ind, fam, ratio, k, moments.r2(held["test"], mu[:k], sd[:k], k, y, b0, beta)))
                coefs[(ind, fam, k)] = (b0, [float(x) for x in beta])
    return out, coefs


def fitted_results(plan: SearchPlan, industries, families, to: fits.Settings = fits.Settings()):
    """R^2 on test of the families whose models are fitted to rows (trees, support vector
    regression), every prefix: one grouped aggregate over the predictions of all fits."""
    specs = [(i, fam, k) for i in industries for fam in families for k in sorted({k for _, k in prefix_sizes(len(plan.pools[i]))})]
    test = plan.data.filter((F.col("split") == "test") & F.col(GROUP).isin(*industries))
    p = fits.predictions(plan, specs, test, to)
    y, e = F.col("stock_price"), (F.col("stock_price") - F.col("prediction")) ** 2
    found = p.groupBy(GROUP, "family", "n_features").agg(
        (F.lit(1.0) - F.try_divide(F.sum(e), F.count(y) * F.var_pop(y))).alias("r2")).collect()
    r2 = {(r[GROUP], r["family"], r["n_features"]): r["r2"] for r in found}
    return [(i, fam, ratio, k, float("nan") if r2[i, fam, k] is None else r2[i, fam, k])
            for i in industries for fam in families for ratio, k in prefix_sizes(len(plan.pools[i])) if (i, fam, k) in r2]


def select_best(results):
    """Best ratio per family (strict >, first ratio wins), then best
    family per industry (first family in declared order wins ties)."""
    best_fam = {}
    for ind, fam, ratio, k, r2 in sorted(results, key=lambda r: (r[0], MODEL_FAMILIES.index(r[1]), r[2])):
        cur = best_fam.get((ind, fam))
        if r2 == r2 and (cur is None or r2 > cur[3]):
            best_fam[(ind, fam)] = (ratio, k, fam, r2)
    best = {}
    for (ind, fam), v in sorted(best_fam.items(), key=lambda kv: (kv[0][0], MODEL_FAMILIES.index(kv[0][1]))):
        if ind not in best or v[3] > best[ind][3]:
            best[ind] = v
    return best_fam, best


def equation_text(b0, beta, feats):
    """A linear model in the fixed notation."""
    head, term, between = EQUATION
    return head % b0 + between.join(term % pair for pair in zip(beta, feats))


def search(features: DataFrame, families=MODEL_FAMILIES, train_last: int = TRAIN_LAST_FY,
           test_first: int = TEST_FIRST_FY, plan: SearchPlan | None = None):
    """Full M1-M12 search -> (results rows, best per family, best per industry, plan, coefs)."""
    plan = plan or prepare(features, train_last, test_first)
    inds = eligible_industries(plan)
    linear, fitted = [f for f in families if f in (LINEAR, RIDGE)], [f for f in families if f not in (LINEAR, RIDGE)]
    res, coefs = linear_results(plan, inds, linear) if linear else ([], {})
    if fitted:
        res += fitted_results(plan, inds, fitted)
    best_fam, best = select_best(res)
    return res, best_fam, best, plan, coefs


def results_frame(spark, res) -> DataFrame:
    """(industry, family, ratio, n_features, r2) for every fit."""
    return spark.createDataFrame(
        [(i, f, float(r), int(k), None if r2 != r2 else float(r2)) for i, f, r, k, r2 in res],
        f"{GROUP} string, family string, ratio double, n_features int, r2 double")


def summary_frame(spark, best, plan) -> DataFrame:
    """Industry, Best_Model, Optimal_Feature_Ratio, No_of_Features, No_of_Companies, R2_Score."""
    rows = [(ind, v[2], f"Top {int(round(v[0] * 100))}%", int(v[1]), int(plan.n_companies[ind]), float(v[3]))
            for ind, v in sorted(best.items())]
    return spark.createDataFrame(rows, "Industry string, Best_Model string, Optimal_Feature_Ratio string, "
                                       "No_of_Features int, No_of_Companies int, R2_Score double")


def case_study_tickers(plan: SearchPlan, industries, seed: int = SEED) -> DataFrame:
    """(industry, ticker), a seeded pick of one test-set company of each industry."""
    t = plan.data.filter((F.col("split") == "test") & F.col(GROUP).isin(*industries))
    return t.groupBy(GROUP).agg(F.min(F.struct(F.xxhash64("ticker", F.lit(seed)).alias("h"), "ticker")).alias("m")).select(GROUP, "m.ticker")


def top_cap_members(features: DataFrame, k: int = TOP_CAP_COMPANIES) -> DataFrame:
    """Companies among the global top-k by mean market cap."""
    from ..operators.stats import top_k_cap
    return top_k_cap(features, k).select("ticker")


LINEAR_FIELDS = ("industry", "family", "features", "mean", "std", "intercept", "coef", "r2")


def linear_rows(plan: SearchPlan, best: dict, coefs) -> list[tuple]:
    """One row (LINEAR_FIELDS) per industry whose winner is a linear model."""
    rows = []
    for ind, (ratio, k, fam, r2) in sorted(best.items()):
        if (ind, fam, k) in coefs:
            b0, beta = coefs[(ind, fam, k)]
            mu, sd = plan.stats[ind]
            rows.append((ind, fam, plan.pools[ind][:k], [float(x) for x in mu[:k]], [float(x) for x in sd[:k]],
                         float(b0), beta, float(r2)))
    return rows


def save_linear_models(spark, coefs, best, plan, path: str):
    """The chosen linear models as a small table; ``load_linear_models`` and
    ``score_linear`` read and apply it."""
    schema = ("industry string, family string, features array<string>, mean array<double>, "
              "std array<double>, intercept double, coef array<double>, r2 double")
    spark.createDataFrame(linear_rows(plan, best, coefs), schema).write.mode("overwrite").parquet(path)


def load_linear_models(spark, path: str):
    """The table of ``save_linear_models`` as {industry: row}."""
    return {r["industry"]: r for r in spark.read.parquet(path).collect()}


def score_linear(models: dict, rows: DataFrame) -> DataFrame:
    """Rows with ``prediction`` by loaded linear models (industries without one drop), in
    one vectorised pass over Arrow batches."""
    held = {i: (list(r["features"]), np.array(r["mean"]), np.array(r["std"]), r["intercept"], np.array(r["coef"]))
            for i, r in models.items()}
    names = rows.columns
    schema = StructType([*rows.schema.fields, StructField("prediction", DoubleType())])

    def run(batches):
        for b in batches:
            for ind, g in b.groupby(GROUP):
                if ind in held:
                    feats, mu, sd, b0, beta = held[ind]
                    yield g[names].assign(prediction=b0 + (g[feats].to_numpy(dtype=float) - mu) / sd @ beta)

    return rows.mapInPandas(run, schema)


SCORED = ["ticker", "fy", GROUP, "split", "stock_price", "prediction"]


def predict_best(plan: SearchPlan, best: dict, coefs, rows: DataFrame | None = None) -> DataFrame:
    """Rows (columns SCORED) scored with each industry's winning model, the one
    whose R^2 won: linear winners in one pass over Arrow batches, all others in one job
    (a fit depends on the training rows alone, so it is the model of the search)."""
    d = plan.data if rows is None else rows
    lin = linear_rows(plan, best, coefs)
    held = [(ind, v[2], v[1]) for ind, v in sorted(best.items()) if v[2] not in (LINEAR, RIDGE)]
    parts = [score_linear({r[0]: dict(zip(LINEAR_FIELDS, r)) for r in lin}, d).select(*SCORED)] if lin else []
    parts += [fits.predictions(plan, held, d).select(*SCORED)] if held else []
    if not parts:
        return d.withColumn("prediction", F.lit(None).cast("double")).select(*SCORED).limit(0)
    return reduce(DataFrame.unionByName, parts)


def save_fitted_models(plan: SearchPlan, best: dict, path: str) -> None:
    """S11 for the winners that are not linear: ``fits.fit_models`` as a Parquet table,
    which ``fits.score`` applies to any rows with the feature columns."""
    fits.fit_models(plan, [(ind, v[2], v[1]) for ind, v in sorted(best.items()) if v[2] not in (LINEAR, RIDGE)]) \
        .write.mode("overwrite").parquet(path)
