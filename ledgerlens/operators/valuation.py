"""Valuation ratios and theoretical price (R1-R31), two rule sets.

``valuation_v1`` is the rule set stored with the panel (strict risk ladder,
career value with PER 20); ``valuation_v2`` is the analysis-time rule set
(inclusive risk ladder, capped EPS/ROA, business value). Both are a single
projection of Column expressions: no UDF, whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import PER
from ..functions.ladders import leverage_factor, risk_factor_v1, risk_factor_v2, roa_discount
from ..functions.numeric import clip_upper, fill0, ieee_div, num

SHARES = "shares#"


def _common_ratios(df: DataFrame) -> DataFrame:
    col = F.col
    sh = col(f"`{SHARES}`")
    df = df.withColumns({
        "per": ieee_div(col("stock_price"), col("eps")),
        "equity_ratio": ieee_div(col("equity"), col("asset")),
        "bps": ieee_div(col("equity"), sh),
        "cash_flow_ratio": ieee_div(col("operating_cash"), col("curr_liabilities")),
        "cash_reinvest_ratio": ieee_div(
            col("operating_cash") - fill0("dividend"),
            col("lt_asset") + col("lt_liabilities")
            + (col("cash") + fill0("inven_other") - col("curr_liabilities"))),
        "cash_per_asset_ratio": ieee_div(col("operating_cash"), col("asset")),
        "cashflowps_ratio": ieee_div(col("operating_cash") - fill0("dividend"), sh),
        "ocfperprofit_ratio": ieee_div(col("operating_cash"), col("profit")),
        "debt_assurance_ratio": ieee_div(
            col("operating_cash"), col("curr_liabilities") + col("lt_liabilities")),
        "roa": ieee_div(col("net_income"), col("asset")),
        "current_ratio": ieee_div(col("cash") + fill0("inven_other"), col("curr_liabilities")),
        "quick_ratio": ieee_div(col("cash"), col("curr_liabilities")),
        "fixedasset_per_ltcapital_ratio": ieee_div(
            col("lt_asset"), col("equity") + col("lt_liabilities")),
        "fixedasset_per_equity_ratio": ieee_div(col("lt_asset"), col("equity")),
        "roe": ieee_div(col("net_income"), col("equity")),
        "asset_pershare": ieee_div(col("asset"), sh),
        "market_cap": num(col("stock_price_unadjusted") * sh),
    })
    df = df.withColumns({
        "pbr": ieee_div(col("stock_price"), col("bps")),
        "roa_discount": roa_discount(col("equity_ratio")),
        "financial_leverage_ratio": ieee_div(F.lit(1.0), col("equity_ratio")),
    })
    df = df.withColumns({
        "leverage_factor": leverage_factor(col("financial_leverage_ratio")),
        "asset_value": num(col("roa_discount") * col("bps")),
    })
    return df


def _tail(df: DataFrame) -> DataFrame:
    col = F.col
    df = df.withColumn("theoretical_price_upper", num(col("theoretical_price") * 2))
    return df.withColumns({
        "theoretical_roe": ieee_div(col("theoretical_price"), col("eps")),
        "theoretical_pbr": ieee_div(col("theoretical_price"), col("bps")),
    })


def valuation_v1(df: DataFrame) -> DataFrame:
    col = F.col
    df = _common_ratios(df)
    df = df.withColumns({
        "risk_factor": risk_factor_v1(col("pbr")),
        "career_value": num(clip_upper(col("roa"), 0.3) * col("eps")
                            * col("leverage_factor") * F.lit(float(PER)) * 10),
    })
    df = df.withColumn("theoretical_price",
                       num((col("asset_value") + col("career_value")) * col("risk_factor")))
    return _tail(df)


def valuation_v2(df: DataFrame) -> DataFrame:
    col = F.col
    df = _common_ratios(df)
    df = df.withColumns({
        "capped_eps": clip_upper(col("eps"), num(col("bps") * 0.6)),
        "capped_roa": clip_upper(col("roa"), 0.3),
        "risk_factor": risk_factor_v2(col("pbr")),
    })
    df = df.withColumn("business_value",
                       num(col("capped_eps") * col("capped_roa") * 150 * col("leverage_factor")))
    df = df.withColumn("theoretical_price",
                       num((col("asset_value") + col("business_value")) * col("risk_factor")))
    return _tail(df)
