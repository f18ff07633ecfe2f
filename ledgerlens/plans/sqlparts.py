"""DuckDB SQL fragments for the oracle side of the registered checks.

These mirror the *semantics* (IEEE division, NaN -> NULL, ladders) in plain
ANSI-ish SQL so the oracle is an independent implementation of each rule.
"""

from __future__ import annotations

from ..constants import SIC_GROUPS, OTHER_GROUP


def q(name: str) -> str:
    return f'"{name}"'


def nn(x: str) -> str:
    """NaN -> NULL."""
    return f"(CASE WHEN isnan(({x})::DOUBLE) THEN NULL ELSE ({x})::DOUBLE END)"


def div(a: str, b: str) -> str:
    return nn(f"CASE WHEN ({a}) IS NULL OR ({b}) IS NULL THEN NULL "
              f"WHEN ({b}) <> 0 THEN ({a})::DOUBLE / ({b}) "
              f"WHEN ({a}) > 0 THEN 'inf'::DOUBLE WHEN ({a}) < 0 THEN '-inf'::DOUBLE END")


def f0(x: str) -> str:
    return f"coalesce(({x})::DOUBLE, 0.0)"


def clip(x: str, upper: str) -> str:
    return f"(CASE WHEN ({x}) IS NOT NULL AND ({upper}) IS NOT NULL AND ({x}) > ({upper}) THEN ({upper}) ELSE ({x}) END)"


def ladder(x: str, steps, otherwise, strict=True) -> str:
    op = ">" if strict else ">="
    parts = " ".join(f"WHEN ({x}) {op} {b} THEN {v}" for b, v in steps)
    return f"(CASE {parts} ELSE {otherwise} END)"


def roa_discount(x):
    return ladder(x, [(0.8, 0.8), (0.67, 0.75), (0.5, 0.7), (0.33, 0.65), (0.1, 0.6), (0, 0.5)], "0.0")


def leverage_factor(x):
    return ladder(x, [(3, 1.5), (2.5, 1.36), (2, 1.2)], "1.0")


def risk_v1(x):
    lad = ladder(x, [(0.5, 1.0), (0.4, 0.8), (0.33, 0.66), (0.25, 0.5), (0.03, f"0.15 * (({x}) / 50 * 5)")],
                 f"0.01 * ((({x}) - 1) * 10 + 5)")
    return nn(f"CASE WHEN ({x}) IS NULL THEN NULL ELSE {lad} END")


def risk_v2(x):
    return nn(ladder(x, [(0.5, 1.0), (0.41, 0.8), (0.34, 0.66), (0.26, 0.5), (0.21, 0.33),
                         (0.04, f"(({x}) / 5 * 50 + 50) / 100")], "0.005", strict=False))


def score(x, bps, points=(-5, 0, 5, 8)):
    b0, b1, b2 = bps
    op = ">" if b0 > b2 else "<"
    return (f"(CASE WHEN ({x}) {op} {b0} THEN {points[0]} WHEN ({x}) {op} {b1} THEN {points[1]} "
            f"WHEN ({x}) {op} {b2} THEN {points[2]} ELSE {points[3]} END)")


def broad_industry(ind: str) -> str:
    code = f"TRY_CAST(split_part(coalesce({ind}, ''), ' ', 1) AS INTEGER)"
    parts = " ".join(f"WHEN {code} BETWEEN {lo} AND {hi} THEN '{name}'" for lo, hi, name in SIC_GROUPS)
    return f"(CASE {parts} ELSE '{OTHER_GROUP}' END)"


def r4(x: str, digits: int = 4) -> str:
    return f"(round(({x})::DOUBLE, {digits}) + 0.0)"


# ---------------------------------------------------------------------------------
# Stand-in inputs (mirror of sources/standin.py)
# ---------------------------------------------------------------------------------

def _flag(qty=None, disc=None, tax=None):
    conds = ["TRUE"]
    if qty is not None:
        conds.append(f"l_quantity = {qty}")
    if disc is not None:
        conds.append(f"l_discount = {disc}")
    if tax is not None:
        conds.append(f"l_tax = {tax}")
    return f"max(CASE WHEN {' AND '.join(conds)} THEN 1 ELSE 0 END) = 1"


SUPPLIERS_CTE = """
sup AS (
  SELECT s_suppkey, 'S' || CAST(s_suppkey AS VARCHAR) AS ticker, s_name AS name,
         lpad(CAST((s_suppkey * 2671 + s_nationkey * 389) % 10000 AS VARCHAR), 4, '0') || ' ' || r_name AS industry,
         20.0 + 75.0 * (s_acctbal + 1000.0) / 11000.0 AS price_div
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""

LINES_CTE = """
lines AS (
  SELECT l_orderkey, l_suppkey, l_quantity, l_extendedprice / 7.0 AS l_extendedprice, l_discount, l_tax, l_returnflag,
         l_linestatus, l_shipdate, o_totalprice / 7.0 AS o_totalprice, o_orderdate, o_orderstatus,
         CAST(year(o_orderdate) AS INTEGER) AS fy
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""

PANEL_CTES = LINES_CTE + "," + SUPPLIERS_CTE + f""",
agg AS (
  SELECT l_suppkey, fy,
    CAST(max(l_shipdate) AS DATE) AS filed,
    sum(l_extendedprice) AS gross_revenue,
    sum(CASE WHEN l_returnflag = 'R' THEN l_extendedprice * (1 - l_discount) END) AS cost,
    sum(CASE WHEN l_linestatus = 'O' THEN l_extendedprice * l_tax END) AS sga,
    sum(l_extendedprice * (0.06 - l_discount)) AS operating_income,
    sum(l_extendedprice * (0.07 - l_discount)) AS recurrent_profit,
    sum(l_extendedprice * l_tax) AS tax,
    sum(l_extendedprice * (0.1 - l_discount - l_tax)) AS net_income,
    sum(l_quantity) AS shares,
    sum(o_totalprice) AS asset,
    sum(CASE WHEN l_returnflag = 'A' THEN o_totalprice END) AS equity,
    sum(CASE WHEN l_returnflag = 'N' THEN o_totalprice END) AS currasset,
    sum(CASE WHEN l_linestatus = 'F' AND l_quantity <= 10 THEN l_extendedprice END) AS inventory,
    sum(CASE WHEN l_quantity > 40 THEN l_extendedprice * l_discount END) AS other_currasset,
    sum(CASE WHEN l_returnflag = 'R' THEN o_totalprice END) AS curr_liabilities,
    sum(l_extendedprice * (0.09 - l_discount)) AS operating_cash,
    -sum(CASE WHEN o_orderstatus = 'O' THEN l_extendedprice * l_tax END) AS investing_cash,
    sum(CASE WHEN o_orderstatus = 'F' THEN l_extendedprice * l_discount END) AS payment_cap,
    sum(CASE WHEN o_orderstatus = 'P' THEN l_extendedprice * l_tax END) AS payment_intangible,
    sum(l_extendedprice * (l_discount - l_tax)) AS financing_cash,
    sum(o_totalprice * l_discount) AS cash_end,
    sum(l_extendedprice * (l_tax - 0.04)) AS inventory_delta,
    sum(CASE WHEN l_quantity >= 45 THEN l_extendedprice * l_tax END) AS dividend,
    avg(l_extendedprice) AS avg_price,
    avg(l_extendedprice * (1 + l_tax)) AS avg_price_unadj,
    {_flag(50, 0.10)} AS h_fill,
    {_flag(49, 0.09)} AS h_eps,
    {_flag(48, 0.02)} AS h_other,
    {_flag(47, None, 0.01)} AS h_div,
    {_flag(50, 0.10, 0.08)} AS h_ni,
    {_flag(49, 0.0, 0.08)} AS h_rp,
    {_flag(1, 0.0, 0.0)} AS h_cost,
    {_flag(2, 0.05, 0.04)} AS h_zero
  FROM lines GROUP BY l_suppkey, fy
),
panel AS (
  SELECT ticker, name, industry, fy, 'FY' AS fp, filed, gross_revenue,
    CASE WHEN h_cost THEN NULL ELSE cost END AS cost,
    sga AS "expense_general/admin", operating_income,
    CASE WHEN h_rp THEN NULL ELSE recurrent_profit END AS recurrent_profit,
    tax,
    CASE WHEN h_ni THEN NULL ELSE net_income END AS net_income,
    CASE WHEN h_fill THEN NULL WHEN h_zero THEN 0.0 ELSE shares END AS "shares#",
    CASE WHEN h_eps THEN NULL ELSE net_income / shares END AS eps,
    asset, equity, currasset,
    CASE WHEN h_fill THEN NULL ELSE inventory END AS inventory,
    CASE WHEN h_other THEN NULL ELSE other_currasset END AS other_currasset,
    curr_liabilities, operating_cash, investing_cash, payment_cap, payment_intangible,
    financing_cash, cash_end, inventory_delta,
    CASE WHEN h_div THEN NULL ELSE dividend END AS dividend,
    avg_price / price_div AS stock_price,
    avg_price_unadj / price_div AS stock_price_unadjusted
  FROM agg JOIN sup ON l_suppkey = s_suppkey
)"""

# Derived items D1-D13 on top of ``panel`` -> ``derived``.
DERIVED_CTE = f"""
d1 AS (
  SELECT *,
    gross_revenue - {f0('cost')} AS gross_profit,
    CASE WHEN (gross_revenue - {f0('cost')} - operating_income) IS NULL AND "expense_general/admin" IS NULL THEN NULL
         ELSE {f0(f'gross_revenue - {f0("cost")} - operating_income')} - {f0('"expense_general/admin"')} END AS expense_others,
    coalesce(operating_income, recurrent_profit) AS operating_income_f,
    recurrent_profit - tax AS profit,
    asset - equity AS liabilities,
    {f0('inventory')} + {f0('other_currasset')} AS inven_other,
    asset - currasset AS lt_asset,
    {f0('payment_cap')} + {f0('payment_intangible')} AS cap_ex
  FROM panel
),
derived AS (
  SELECT * EXCLUDE (operating_income, operating_income_f),
    operating_income_f AS operating_income,
    recurrent_profit - operating_income_f AS nonoperating_income,
    net_income - profit AS noncontrolling_interest,
    currasset - {f0('inven_other')} AS cash,
    liabilities - curr_liabilities AS lt_liabilities,
    operating_cash - cap_ex AS fcf
  FROM d1
)"""


def valuation_cte(src: str, version: int, name: str) -> str:
    """Valuation over CTE ``src`` -> CTE ``name`` (three stacked CTEs)."""
    sh = '"shares#"'
    common = f"""
{name}_a AS (
  SELECT *,
    {div('stock_price', 'eps')} AS per,
    {div('equity', 'asset')} AS equity_ratio,
    {div('equity', sh)} AS bps,
    {div('operating_cash', 'curr_liabilities')} AS cash_flow_ratio,
    {div(f"operating_cash - {f0('dividend')}", f"lt_asset + lt_liabilities + (cash + {f0('inven_other')} - curr_liabilities)")} AS cash_reinvest_ratio,
    {div('operating_cash', 'asset')} AS cash_per_asset_ratio,
    {div(f"operating_cash - {f0('dividend')}", sh)} AS cashflowps_ratio,
    {div('operating_cash', 'profit')} AS ocfperprofit_ratio,
    {div('operating_cash', 'curr_liabilities + lt_liabilities')} AS debt_assurance_ratio,
    {div('net_income', 'asset')} AS roa,
    {div(f"cash + {f0('inven_other')}", 'curr_liabilities')} AS current_ratio,
    {div('cash', 'curr_liabilities')} AS quick_ratio,
    {div('lt_asset', 'equity + lt_liabilities')} AS fixedasset_per_ltcapital_ratio,
    {div('lt_asset', 'equity')} AS fixedasset_per_equity_ratio,
    {div('net_income', 'equity')} AS roe,
    {div('asset', sh)} AS asset_pershare,
    {nn(f'stock_price_unadjusted * {sh}')} AS market_cap
  FROM {src}
),
{name}_b AS (
  SELECT *,
    {div('stock_price', 'bps')} AS pbr,
    {roa_discount('equity_ratio')} AS roa_discount,
    {div('1.0', 'equity_ratio')} AS financial_leverage_ratio
  FROM {name}_a
),
{name}_c AS (
  SELECT *,
    {leverage_factor('financial_leverage_ratio')} AS leverage_factor,
    {nn('roa_discount * bps')} AS asset_value
  FROM {name}_b
),"""
    if version == 1:
        body = f"""
{name}_d AS (
  SELECT *,
    {risk_v1('pbr')} AS risk_factor,
    {nn(f"{clip('roa', '0.3')} * eps * leverage_factor * 20.0 * 10")} AS career_value
  FROM {name}_c
),
{name}_e AS (
  SELECT *, {nn('(asset_value + career_value) * risk_factor')} AS theoretical_price FROM {name}_d
),"""
    else:
        body = f"""
{name}_d AS (
  SELECT *,
    {clip('eps', nn('bps * 0.6'))} AS capped_eps,
    {clip('roa', '0.3')} AS capped_roa,
    {risk_v2('pbr')} AS risk_factor
  FROM {name}_c
),
{name}_d2 AS (
  SELECT *, {nn('capped_eps * capped_roa * 150 * leverage_factor')} AS business_value FROM {name}_d
),
{name}_e AS (
  SELECT *, {nn('(asset_value + business_value) * risk_factor')} AS theoretical_price FROM {name}_d2
),"""
    tail = f"""
{name} AS (
  SELECT *,
    {nn('theoretical_price * 2')} AS theoretical_price_upper,
    {div('theoretical_price', 'eps')} AS theoretical_roe,
    {div('theoretical_price', 'bps')} AS theoretical_pbr
  FROM {name}_e
)"""
    return common + body + tail
