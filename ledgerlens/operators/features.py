"""Feature scalars for the analysis stage.

All are Column expressions applied in one or two projections.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import (CORRELATION_EXTRA, NO_LOG, PER_SHARE_BASE, SCORE_BREAKPOINTS, SCORE_POINTS)
from ..functions.ladders import breakpoint_score
from ..functions.numeric import ieee_div, num, null_d, try_double
from ..functions.sic import broad_industry
from .valuation import valuation_v2

SHARES = "shares#"


def bq(c: str):
    return F.col(f"`{c}`")


def per_share_columns():
    return [f"{c}_per_share" for c in PER_SHARE_BASE]


def correlation_factors():
    return per_share_columns() + list(CORRELATION_EXTRA)


def log_columns():
    return [c for c in correlation_factors() if c not in NO_LOG]


def with_ratio_score(df: DataFrame) -> DataFrame:
    """Sum of breakpoint scores over the nine ratios (missing -> top score)."""
    parts = [breakpoint_score(bq(r), bps, SCORE_POINTS) for r, bps in SCORE_BREAKPOINTS.items()
             if r in df.columns]
    return df.withColumn("ratio_score", reduce(lambda a, b: a + b, parts))


def with_broad_industry(df: DataFrame, src: str = "industry") -> DataFrame:
    return df.withColumn("broad_industry", broad_industry(src))


def coerce_numeric(df: DataFrame, cols) -> DataFrame:
    """text that does not parse as a number becomes NULL."""
    return df.withColumns({c: try_double(c) for c in cols if c in df.columns})


def with_per_share(df: DataFrame) -> DataFrame:
    """Item / shares#, a zero share count counts as missing."""
    safe = F.when(bq(SHARES) != 0, bq(SHARES))
    return df.withColumns({f"{c}_per_share": ieee_div(bq(c), safe)
                           for c in PER_SHARE_BASE if c in df.columns})


def log_compress(x) -> "F.Column":
    """Negative -> 0, +-inf / missing -> 0, then log1p."""
    x = num(x)
    clean = F.when(x.isNull() | (x == float("inf")) | (x < 0), F.lit(0.0)).otherwise(x)
    return F.log1p(clean)


def with_log_features(df: DataFrame) -> DataFrame:
    return df.withColumns({c: log_compress(bq(c)) for c in log_columns() if c in df.columns})


def analysis_features(clean: DataFrame) -> DataFrame:
    """Clean panel -> analysis frame: v2 valuation, score, broad industry,
    per-share items, log compression (bps / eps / asset_pershare are replaced
    by their logs after the theoretical price has been computed from them)."""
    df = valuation_v2(clean)
    df = with_ratio_score(df)
    df = with_broad_industry(df)
    df = with_per_share(df)
    return with_log_features(df)


def size_scale(df: DataFrame, cap: str = "market_cap", out: str = "norm_size") -> DataFrame:
    """40 * (log1p(cap) - min) / (max - min + 1e-9) + 5 over the whole frame.

    min/max are one global partial aggregate; the two scalars come back as a
    single row and enter the projection as literals (no cross join).
    """
    lc = num(F.log1p(F.coalesce(bq(cap), F.lit(0.0))))
    mm = df.agg(F.min(lc).alias("lo"), F.max(lc).alias("hi")).first()
    lo, hi = mm["lo"], mm["hi"]
    if lo is None:
        return df.withColumn(out, null_d())
    return df.withColumn(out, F.lit(40.0) * (lc - F.lit(lo)) / (F.lit(hi) - F.lit(lo) + F.lit(1e-9)) + F.lit(5.0))


def with_residual(df: DataFrame) -> DataFrame:
    """Model error = actual - theoretical price."""
    return df.withColumn("model_error", num(F.col("stock_price") - F.col("theoretical_price")))


def analysis_numeric_columns():
    """Numeric columns of the analysis frame, in a fixed order (profiles, imputation)."""
    from ..constants import PANEL_BASE_COLUMNS, PRICE_COLUMNS, VALUATION_V1_COLUMNS
    base = [c for c in PANEL_BASE_COLUMNS if c not in ("ticker", "name", "industry", "fy", "fp", "filed")]
    return (base + list(PRICE_COLUMNS) + list(VALUATION_V1_COLUMNS)
            + ["capped_eps", "capped_roa", "business_value", "ratio_score"] + per_share_columns())
