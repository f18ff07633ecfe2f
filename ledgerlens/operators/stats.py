"""Statistics behind the analysis tables.

Everything is a grouped or global aggregate with partial (map-side)
aggregation; the only values that reach the driver are bounded summaries
(per-column quantile bounds, min/max scalars).
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..constants import (BAND_DRAWS, BAND_Z, BIN_COUNT, MIN_GROUP_ROWS_CORR, OTHER_FOLD_LABEL, OTHER_GROUP,
                         SCORE_BREAKPOINTS, SEED, TOP_CAP_COMPANIES, TRIM_HIGH, TRIM_LOW)
from ..functions.draws import poisson_weights
from ..functions.numeric import finite_or_null, is_neg_inf, is_pos_inf, null_d, num, safe_corr
from .quantiles import exact_quantiles, exact_quantiles_of


def bq(c: str):
    return F.col(f"`{c}`")


def _stack(cols, val_name="value", key_name="factor"):
    """unpivot helper: (factor, value) pairs from wide columns."""
    return F.explode(F.array(*[F.struct(F.lit(c).alias(key_name), bq(c).cast("double").alias(val_name))
                               for c in cols]))


# ---- A1 / A2 ------------------------------------------------------------------------

def industry_totals(df: DataFrame, group: str = "broad_industry") -> DataFrame:
    """A1: rows (the studied 'company count' counts company-years), companies, market cap."""
    return df.groupBy(group).agg(F.count(F.lit(1)).alias("n_rows"),
                                 F.countDistinct("ticker").alias("n_companies"),
                                 F.sum("market_cap").alias("market_cap"))


def small_fold(totals: DataFrame, col: str, threshold: float, group: str = "broad_industry") -> DataFrame:
    """Groups whose share of the total is below ``threshold`` fold into one label.

    The grand total is one global partial aggregate returned as a scalar.
    """
    total = totals.agg(F.sum(col)).first()[0]
    share = F.col(col) / F.lit(total) if total else F.lit(None).cast("double")
    lab = F.when(share < threshold, F.lit(OTHER_FOLD_LABEL)).otherwise(F.col(group))
    return totals.withColumn("label", lab).groupBy("label").agg(F.sum(col).alias(col))


# ---- F11 / A6: 1 % - 99 % trim -------------------------------------------------------------

def quantile_bounds(df: DataFrame, cols, lo: float = TRIM_LOW, hi: float = TRIM_HIGH) -> dict:
    """Exact linear quantiles of several columns -> {col: (lo, hi)}."""
    long = df.select(_stack(cols, "v", "c").alias("s")).select("s.c", "s.v")
    q = exact_quantiles(long, "v", [lo, hi], keys=["c"]).collect()
    out = {c: [None, None] for c in cols}
    for r in q:
        out[r["c"]][0 if r["p"] == lo else 1] = r["q"]
    return {k: tuple(v) for k, v in out.items()}


def trim(df: DataFrame, cols=("theoretical_price", "stock_price"), lo: float = TRIM_LOW,
         hi: float = TRIM_HIGH) -> DataFrame:
    """keep rows inside the [lo, hi] quantiles of every listed column (missing rows drop)."""
    b = quantile_bounds(df, list(cols), lo, hi)
    cond = reduce(lambda a, c: a & F.col(c).between(F.lit(b[c][0]), F.lit(b[c][1])),
                  cols, F.lit(True))
    return df.filter(cond)


# ---- A3 -----------------------------------------------------------------------------------

def industry_year_means(df: DataFrame, group: str = "broad_industry") -> DataFrame:
    cols = list(SCORE_BREAKPOINTS) + ["stock_price"]
    return df.groupBy(group, "fy").agg(*[num(F.avg(bq(c))).alias(c) for c in cols])


# ---- A4 / A5 / M2: correlation with price --------------------------------------------------

def corr_with(df: DataFrame, factors, target: str = "stock_price", groups=()) -> DataFrame:
    """Pairwise-complete Pearson correlation of each factor with ``target``.

    Long form: every row is unpivoted to (groups..., factor, x, y) inside the
    scan stage and aggregated by (groups..., factor); partial aggregation
    combines map-side, so the shuffle carries one small buffer per
    (partition, group, factor) and each aggregate stays a handful of
    expressions (compact generated code instead of one 35-way wide row).
    """
    groups = list(groups)
    pairs = _stack(factors, "x", "factor")
    long = df.select(*groups, bq(target).cast("double").alias("_y"), pairs.alias("s")).select(
        *groups, "s.factor", "s.x", "_y")
    n = df.groupBy(*groups).agg(F.count(F.lit(1)).alias("_n"))
    c = long.groupBy(*groups, "factor").agg(safe_corr(F.col("x"), F.col("_y")).alias("corr"))
    return c.join(n, groups) if groups else c.withColumn("_n", F.lit(None).cast("long"))


def corr_overall(df: DataFrame, factors, target: str = "stock_price") -> DataFrame:
    """A4 (Fig 1a)."""
    return corr_with(df, factors, target).drop("_n")


def corr_by_group(df: DataFrame, factors, target: str = "stock_price",
                  group: str = "broad_industry") -> DataFrame:
    """A5 (Fig 1b): per group with >= 5 rows, excluding the unclassified group;
    undefined correlations are dropped."""
    d = df.filter(F.col(group) != OTHER_GROUP)
    c = corr_with(d, factors, target, [group])
    return c.filter((F.col("_n") >= MIN_GROUP_ROWS_CORR) & F.col("corr").isNotNull()).drop("_n")


# ---- A8 / A9: fit quality of the theoretical price -----------------------------------------

def r2_overall(df: DataFrame, y: str = "stock_price", p: str = "theoretical_price") -> DataFrame:
    """A8 (Fig 5): R^2 = 1 - SSE/SST over rows where both sides are present; missing
    for a constant price."""
    d = df.filter(F.col(y).isNotNull() & F.col(p).isNotNull())
    return d.agg(F.count(F.lit(1)).alias("n"),
                 (F.lit(1.0) - F.try_divide(F.sum((F.col(y) - F.col(p)) ** 2),
                                            F.count(F.lit(1)) * F.var_pop(F.col(y)))).alias("r2"))


def r2_by_year(df: DataFrame, y: str = "stock_price", p: str = "theoretical_price") -> DataFrame:
    """A8 (Fig 6): per fiscal year, inf/missing -> 0 on both sides, SST = 0 -> NULL."""
    yy = F.coalesce(finite_or_null(F.col(y)), F.lit(0.0))
    pp = F.coalesce(finite_or_null(F.col(p)), F.lit(0.0))
    g = df.groupBy("fy").agg(F.count(F.lit(1)).alias("n"),
                             F.sum((yy - pp) ** 2).alias("sse"),
                             (F.count(F.lit(1)) * F.var_pop(yy)).alias("sst"))
    return g.select("fy", "n", F.when(F.col("sst") != 0, F.lit(1.0) - F.col("sse") / F.col("sst"))
                    .otherwise(null_d()).alias("r2"))


def trend_line(df: DataFrame, y: str = "stock_price", x: str = "theoretical_price") -> DataFrame:
    """OLS line of price on theoretical price plus the slope's standard error
    (missing where the line is: a constant side, or two rows)."""
    d = df.filter(F.col(y).isNotNull() & F.col(x).isNotNull())
    g = d.agg(F.regr_count(y, x).alias("n"), F.regr_slope(y, x).alias("slope"),
              F.regr_intercept(y, x).alias("intercept"), F.regr_r2(y, x).alias("r2"),
              F.regr_sxx(y, x).alias("sxx"), F.regr_syy(y, x).alias("syy"), F.regr_sxy(y, x).alias("sxy"))
    sse = F.col("syy") - F.col("slope") * F.col("sxy")
    v = F.try_divide(F.try_divide(sse, F.col("n") - 2), F.col("sxx"))
    return g.select("n", "slope", "intercept", "r2", num(F.sqrt(F.when(v < 0, F.lit(0.0)).otherwise(v))).alias("se_slope"))


def trend_band(df: DataFrame, y: str = "stock_price", x: str = "theoretical_price", points: int = 100,
               z: float = BAND_Z) -> DataFrame:
    """The trend line at ``points`` equally spaced x with its 95 % confidence band,
    fit +- z * s * sqrt(1/n + (x - mean)^2 / sxx); no rows where the line is undefined."""
    d = df.filter(F.col(y).isNotNull() & F.col(x).isNotNull())
    g = d.agg(F.regr_count(y, x).alias("n"), F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
              F.regr_sxx(y, x).alias("sxx"), F.regr_syy(y, x).alias("syy"), F.regr_sxy(y, x).alias("sxy"),
              F.avg(x).alias("mx"), F.min(x).alias("lo"), F.max(x).alias("hi")).filter("n > 2 and sxx > 0")
    at = F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("i") / (points - 1)
    s2 = F.greatest(F.col("syy") - F.col("slope") * F.col("sxy"), F.lit(0.0)) / (F.col("n") - 2)
    half = z * F.sqrt(s2 * (1 / F.col("n") + (F.col("x") - F.col("mx")) ** 2 / F.col("sxx")))
    fit = F.col("intercept") + F.col("slope") * F.col("x")
    return (g.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(points - 1)))).withColumn("x", at)
            .select(F.col("i").alias("point"), "x", fit.alias("fit"), (fit - half).alias("lower"), (fit + half).alias("upper")))


def trend_band_resampled(df: DataFrame, y: str = "stock_price", x: str = "theoretical_price", key=("ticker", "fy"),
                         points: int = 100, draws: int = BAND_DRAWS, level: float = 0.95, seed: int = SEED) -> DataFrame:
    """The trend line at ``points`` equally spaced x with the band that resampling gives:
    at each x, the outer (1 - level) / 2 quantiles of the lines of ``draws`` resamples.

    A resample takes every row a Poisson(1) number of times, drawn from a hash of (row
    ``key``, draw): each row decides for itself, so one pass serves all draws and the
    partitions don't matter. The pass sums five moments per draw (centred at the means, in
    NumPy over Arrow batches); they are added up in two levels, and ``draws`` x 5 numbers
    reach the driver. Draws without a line (no spread in x) are left out; no rows where
    the line itself is undefined."""
    d = df.filter(F.col(y).isNotNull() & F.col(x).isNotNull()).select(F.xxhash64(*key).alias("k"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    g = d.agg(F.count(F.lit(1)).alias("n"), F.avg("x").alias("mx"), F.avg("y").alias("my"), F.min("x").alias("lo"), F.max("x").alias("hi"),
              F.regr_slope("y", "x").alias("slope")).first()
    schema = "point int, x double, fit double, lower double, upper double"
    if g["n"] < 3 or g["slope"] is None or not g["hi"] > g["lo"]:
        return df.sparkSession.createDataFrame([], schema)
    mx, my = g["mx"], g["my"]

    def moments(batches):
        total = np.zeros((draws, 5))
        for b in batches:
            k, u, v = (b.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            u, v = u - mx, v - my
            of = np.column_stack([np.ones(len(u)), u, v, u * u, u * v])
            for at in range(0, len(u), 2000):
                w = poisson_weights(k[at:at + 2000], np.arange(draws), seed)
                total += w.T @ of[at:at + 2000]
        yield pa.RecordBatch.from_pydict({"draw": pa.array(np.arange(draws), pa.int32()), **{f"m{i}": pa.array(total[:, i]) for i in range(5)}})

    sums = d.mapInArrow(moments, "draw int, m0 double, m1 double, m2 double, m3 double, m4 double")
    m = sums.groupBy("draw").agg(*[F.sum(f"m{i}").alias(f"m{i}") for i in range(5)]).orderBy("draw").toPandas()[[f"m{i}" for i in range(5)]].to_numpy()
    m = m[m[:, 0] > 0]
    n, su, sv, suu, suv = m.T
    sxx, sxy = suu - su * su / n, suv - su * sv / n
    ok = sxx > 1e-12 * suu
    slope = sxy[ok] / sxx[ok]
    at = np.linspace(g["lo"], g["hi"], points)
    lines = (sv[ok] / n[ok] - slope * su[ok] / n[ok])[:, None] + slope[:, None] * (at - mx) + my
    lower, upper = np.quantile(lines, [(1 - level) / 2, (1 + level) / 2], axis=0)
    fit = my + g["slope"] * (at - mx)
    rows = [(i, *map(float, r)) for i, r in enumerate(zip(at, fit, lower, upper))]
    return df.sparkSession.createDataFrame(rows, schema)


# ---- A10: equal-width 2-D binning ------------------------------------------------------

def bin_index(x, lo: float, hi: float, bins: int = BIN_COUNT):
    """Right-closed equal-width bins over [lo, hi]; lo belongs to bin 1."""
    if hi == lo:
        return F.when(x.isNotNull(), F.lit(1))
    idx = F.ceil((x - F.lit(lo)) / F.lit(hi - lo) * bins).cast("int")
    return F.when(x.isNotNull(), F.greatest(F.lit(1), idx))


def bin_pivot(df: DataFrame, row: str = "asset_value", col: str = "career_value",
              values=("stock_price", "theoretical_price"), bins: int = BIN_COUNT) -> DataFrame:
    """A10 (Fig 7): mean of ``values`` per (row bin, col bin); only non-empty cells
    are emitted (the display pivot fills the rest with 0)."""
    mm = df.agg(F.min(row).alias("r0"), F.max(row).alias("r1"),
                F.min(col).alias("c0"), F.max(col).alias("c1")).first()
    if mm["r0"] is None or mm["c0"] is None:
        return df.sparkSession.createDataFrame([], "row_bin int, col_bin int, n bigint")
    d = df.withColumns({"row_bin": bin_index(F.col(row), mm["r0"], mm["r1"], bins),
                        "col_bin": bin_index(F.col(col), mm["c0"], mm["c1"], bins)})
    d = d.filter(F.col("row_bin").isNotNull() & F.col("col_bin").isNotNull())
    return d.groupBy("row_bin", "col_bin").agg(F.count(F.lit(1)).alias("n"),
                                               *[num(F.avg(v)).alias(f"mean_{v}") for v in values])


# ---- A11 / A12 / M1 / A13: missing-value profile and imputation ----------------------------

def missing_profile(df: DataFrame, cols, group: str = "broad_industry") -> DataFrame:
    """% infinite (both signs), -inf and missing per column per group (rows with any > 0).

    Long form (explode -> grouped aggregate), partial aggregation map-side."""
    long = df.select(group, _stack(cols, "x", "column").alias("s")).select(group, "s.column", "s.x")
    x = F.col("x")

    def share(cond):    # of all rows, missing ones too
        return F.avg(F.coalesce(cond, F.lit(False)).cast("double")) * 100

    out = long.groupBy(group, "column").agg(
        share(is_pos_inf(x) | is_neg_inf(x)).alias("inf_pct"), share(is_neg_inf(x)).alias("neginf_pct"),
        share(x.isNull() | F.isnan(x)).alias("nan_pct"))
    return out.filter((F.col("inf_pct") + F.col("neginf_pct") + F.col("nan_pct")) > 0)


def top_missing(profile: DataFrame, k: int = 10, group: str = "broad_industry") -> DataFrame:
    """O3: top-k columns by missing % per group (ties broken by column name)."""
    w = Window.partitionBy(group).orderBy(F.desc("nan_pct"), F.asc("column"))
    return profile.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def missing_ratio(df: DataFrame, cols, group: str = "broad_industry") -> DataFrame:
    """% missing per column per group after inf -> missing (long form)."""
    long = df.select(group, _stack(cols, "x", "column").alias("s")).select(group, "s.column", "s.x")
    return long.groupBy(group, "column").agg(
        (F.avg(finite_or_null(F.col("x")).isNull().cast("double")) * 100).alias("missing_pct"))


def group_medians(df: DataFrame, cols, group: str = "broad_industry") -> DataFrame:
    """Exact per-group medians of many columns, one row each."""
    wide = df.select(group, *[finite_or_null(bq(c).cast("double")).alias(c) for c in cols])
    return exact_quantiles_of(wide, cols, [0.5], group).select(group, "column", F.col("q").alias("median"))


def impute_medians(df: DataFrame, cols, group: str = "broad_industry") -> DataFrame:
    """Inf -> missing, then missing -> the group's median (one row per group
    in the broadcast medians table, bounded by the number of groups)."""
    med = group_medians(df, cols, group)
    wide = med.groupBy(group).pivot("column", list(cols)).agg(F.first("median"))
    wide = wide.select(group, *[F.col(f"`{c}`").alias(f"__med_{i}") for i, c in enumerate(cols)])
    out = df.join(F.broadcast(wide), group, "left")
    out = out.withColumns({c: F.coalesce(finite_or_null(bq(c)), F.col(f"__med_{i}"))
                           for i, c in enumerate(cols)})
    return out.drop(*[f"__med_{i}" for i in range(len(cols))])


# ---- A15 / O2 ------------------------------------------------------------------------------

def factor_long(df: DataFrame, factors, group: str = "broad_industry") -> DataFrame:
    """A15 (Fig 3 data): (factor, x, stock_price, norm_size, group), missing pairs dropped."""
    out = df.select("ticker", "fy", group, "stock_price", "norm_size",
                    _stack(factors, "x", "factor").alias("s")).select(
        "ticker", "fy", group, "s.factor", "s.x", "stock_price", "norm_size")
    return out.filter(F.col("x").isNotNull() & F.col("stock_price").isNotNull())


def top_k_cap(df: DataFrame, k: int = TOP_CAP_COMPANIES) -> DataFrame:
    """O2: k tickers with the largest mean market cap (ties -> ticker order)."""
    return (df.groupBy("ticker").agg(num(F.avg("market_cap")).alias("mean_market_cap"))
            .filter(F.col("mean_market_cap").isNotNull())
            .orderBy(F.desc("mean_market_cap"), F.asc("ticker")).limit(k))
