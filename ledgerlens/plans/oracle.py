"""DuckDB oracle SQL for the registered checks (same tables, same column names)."""

from __future__ import annotations

from ..constants import PANEL_BASE_COLUMNS, VALUATION_V1_COLUMNS
from .sqlparts import (DERIVED_CTE, LINES_CTE, PANEL_CTES, SUPPLIERS_CTE, broad_industry, q, r4, valuation_cte)

NUMERIC_PANEL = [c for c in PANEL_BASE_COLUMNS if c not in ("ticker", "name", "industry", "fy", "fp", "filed")]
V2_COLUMNS = [c for c in VALUATION_V1_COLUMNS if c != "career_value"] + [
    "capped_eps", "capped_roa", "business_value"]


def _round_list(cols, digits=4):
    return ",\n  ".join(f"{r4(q(c), digits)} AS {q(c)}" for c in cols)


BASE = "WITH " + PANEL_CTES + "," + DERIVED_CTE

SQL: dict[str, str] = {}

SQL["panel_line_items"] = BASE + f"""
SELECT ticker, fy, CAST(filed AS VARCHAR) AS filed,
  {_round_list(NUMERIC_PANEL)}
FROM derived"""

SQL["valuation_v1"] = BASE + "," + valuation_cte("derived", 1, "v1") + f"""
SELECT ticker, fy,
  {_round_list(VALUATION_V1_COLUMNS)}
FROM v1"""

SQL["valuation_v2"] = BASE + "," + valuation_cte("derived", 2, "v2") + f"""
SELECT ticker, fy,
  {_round_list(V2_COLUMNS)}
FROM v2"""

SQL["industry_totals"] = BASE + "," + valuation_cte("derived", 1, "v1") + f"""
SELECT {broad_industry('industry')} AS broad_industry,
  count(*) AS n_rows,
  count(DISTINCT ticker) AS n_companies,
  {r4('sum(market_cap)', 2)} AS market_cap
FROM v1 GROUP BY 1"""


# ---- repair, routing and audit -----------------------------------------------------
from .sqlparts import div as _div  # noqa: E402

_V1_RATIOS = ", ".join(q(c) for c in VALUATION_V1_COLUMNS)
_W = "PARTITION BY ticker ORDER BY fy, filed"
CLEANUP_CTES = BASE + "," + valuation_cte("derived", 1, "v1") + f""",
flags AS (
  SELECT ticker, bool_or(net_income IS NULL) AS miss_ni, bool_or(recurrent_profit IS NULL) AS miss_rp
  FROM v1 GROUP BY ticker
),
dmg AS (
  SELECT ticker, miss_ni, miss_rp,
    CASE WHEN miss_ni AND miss_rp THEN 'Relocated to table "damaged_data" due to missing recurrent_profit and net_income.'
         WHEN miss_ni THEN 'Relocated to table "damaged_data" due to missing net_income.'
         ELSE 'Relocated to table "damaged_data" due to missing recurrent_profit.' END AS message
  FROM flags WHERE miss_ni OR miss_rp
),
rest AS (SELECT * FROM v1 WHERE ticker NOT IN (SELECT ticker FROM dmg)),
filled AS (
  SELECT * REPLACE (coalesce(
      last_value("shares#" IGNORE NULLS) OVER ({_W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
      first_value("shares#" IGNORE NULLS) OVER ({_W} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS "shares#"),
    "shares#" IS NULL AS shares_filled
  FROM rest
),
fill_msgs AS (
  SELECT ticker, string_agg(printf('year %s shares# is filled into %s', CAST(fy AS VARCHAR), coalesce(CAST("shares#" AS VARCHAR), 'nan')), ' , ' ORDER BY fy, filed) AS shares_msg
  FROM filled WHERE shares_filled GROUP BY ticker
),
zero AS (SELECT ticker FROM filled GROUP BY ticker HAVING bool_or("shares#" = 0)),
rest2 AS (SELECT * EXCLUDE (shares_filled) FROM filled WHERE ticker NOT IN (SELECT ticker FROM zero)),
rep AS (
  SELECT * EXCLUDE ({_V1_RATIOS}) REPLACE (
      CASE WHEN "shares#" IS NOT NULL AND eps IS NULL THEN {_div('net_income', '"shares#"')} ELSE eps END AS eps),
    ("shares#" IS NOT NULL AND eps IS NULL) AS eps_repaired
  FROM rest2
),
eps_msgs AS (
  SELECT ticker, string_agg(printf('year %s eps is recovered from nan into %.2f, ', CAST(fy AS VARCHAR), eps), '. ' ORDER BY fy, filed) AS eps_msg
  FROM rep WHERE eps_repaired GROUP BY ticker
),
{valuation_cte("rep", 1, "rv")},
less AS (
  SELECT ticker FROM rv GROUP BY ticker
  HAVING bool_or(cost IS NULL OR "expense_general/admin" IS NULL OR currasset IS NULL OR curr_liabilities IS NULL)
),
clean AS (SELECT * FROM rv WHERE ticker NOT IN (SELECT ticker FROM less)),
less_data AS (SELECT * FROM rv WHERE ticker IN (SELECT ticker FROM less)),
damaged AS (
  SELECT ticker, fy, fp, net_income, recurrent_profit FROM v1 WHERE ticker IN (SELECT ticker FROM dmg)
  UNION ALL
  SELECT ticker, fy, fp, net_income, recurrent_profit FROM rest2 WHERE FALSE
  UNION ALL
  SELECT ticker, fy, fp, net_income, recurrent_profit FROM filled WHERE ticker IN (SELECT ticker FROM zero)
),
routes AS (
  SELECT ticker, fy, fp, 'clean' AS route FROM clean
  UNION ALL SELECT ticker, fy, fp, 'damaged' FROM damaged
  UNION ALL SELECT ticker, fy, fp, 'less_data' FROM less_data
)"""

SQL["route_damaged"] = CLEANUP_CTES + "\nSELECT ticker, miss_ni, miss_rp, message FROM dmg"
SQL["shares_fill"] = CLEANUP_CTES + f'\nSELECT ticker, fy, {r4(q("shares#"))} AS "shares#", shares_filled FROM filled'
SQL["route_zero_shares"] = CLEANUP_CTES + """
SELECT ticker, count(*) AS n_rows FROM filled WHERE ticker IN (SELECT ticker FROM zero) GROUP BY ticker"""
SQL["eps_repair"] = CLEANUP_CTES + f"\nSELECT ticker, fy, {r4('eps')} AS eps FROM rv"
SQL["cleanup_valuation"] = CLEANUP_CTES + f"""
SELECT ticker, fy, {r4(q('shares#'))} AS "shares#", {r4('eps')} AS eps,
  {_round_list(VALUATION_V1_COLUMNS)}
FROM clean"""
SQL["route_less"] = CLEANUP_CTES + "\nSELECT ticker, count(*) AS n_rows FROM less_data GROUP BY ticker"
SQL["audit_merge"] = CLEANUP_CTES + """
SELECT ticker, coalesce(m1, m3, CASE WHEN shares_msg IS NOT NULL OR eps_msg IS NOT NULL
                               THEN concat_ws('. ', shares_msg, eps_msg) END) AS update_after_cleanup
FROM (SELECT ticker, message AS m1 FROM dmg) a
FULL JOIN (SELECT ticker, 'Deleted due to missing shares#.' AS m3 FROM zero) b USING (ticker)
FULL JOIN fill_msgs USING (ticker)
FULL JOIN eps_msgs USING (ticker)"""
SQL["success_rate"] = CLEANUP_CTES + """,
lg AS (SELECT DISTINCT ticker, ticker IN (SELECT ticker FROM dmg) OR ticker IN (SELECT ticker FROM zero) AS bad FROM v1)
SELECT count(*) FILTER (WHERE NOT bad) AS n_success, count(*) AS n_companies,
  round(count(*) FILTER (WHERE NOT bad) * 100.0 / count(*), 4) + 0.0 AS success_pct FROM lg"""
SQL["run_stats"] = CLEANUP_CTES + """
SELECT route, count(*) AS n_rows, count(DISTINCT ticker) AS n_companies FROM routes GROUP BY route"""


# ---- features and statistics ----------------------------------------------------------
from ..constants import (CORRELATION_EXTRA, NO_LOG, PER_SHARE_BASE, SCORE_BREAKPOINTS)  # noqa: E402
from .sqlparts import nn as _nn, score as _score  # noqa: E402

_PS = [f"{c}_per_share" for c in PER_SHARE_BASE]
_CF = _PS + list(CORRELATION_EXTRA)
_LOG = [c for c in _CF if c not in NO_LOG]
_V1_EXCEPT_CAREER = ", ".join(q(c) for c in VALUATION_V1_COLUMNS if c != "career_value")


def _safe_corr(x, y):
    xm = f"(CASE WHEN ({x}) IS NOT NULL AND ({y}) IS NOT NULL THEN ({x}) END)"
    ym = f"(CASE WHEN ({x}) IS NOT NULL AND ({y}) IS NOT NULL THEN ({y}) END)"
    return (f"(CASE WHEN count({xm}) < 2 OR min({xm}) = max({xm}) OR min({ym}) = max({ym}) THEN NULL "
            f"WHEN stddev_pop({xm}) * stddev_pop({ym}) = 0 THEN NULL "
            f"ELSE covar_pop({xm}, {ym}) / (stddev_pop({xm}) * stddev_pop({ym})) END)")


def _log1p_clean(x):
    return (f"ln(1 + (CASE WHEN ({x}) IS NULL OR isnan({x}) OR ({x}) = 'inf'::DOUBLE OR ({x}) < 0 "
            f"THEN 0.0 ELSE ({x}) END))")


_SCORE_SUM = " + ".join(_score(q(r), b) for r, b in SCORE_BREAKPOINTS.items())
_PS_SELECT = ",\n    ".join(
    f"{_div(q(c), 'CASE WHEN \"shares#\" <> 0 THEN \"shares#\" END')} AS {q(c + '_per_share')}"
    for c in PER_SHARE_BASE)
_LOG_REPLACE = ",\n    ".join(f"{_log1p_clean(q(c))} AS {q(c)}" for c in _LOG)

FEATURE_CTES = CLEANUP_CTES + f""",
clean_src AS (SELECT * EXCLUDE ({_V1_EXCEPT_CAREER}) FROM clean),
{valuation_cte("clean_src", 2, "fv")},
feat_s AS (
  SELECT *, {_SCORE_SUM} AS ratio_score, {broad_industry('industry')} AS broad_industry FROM fv
),
feat_p AS (
  SELECT *,
    {_PS_SELECT}
  FROM feat_s
),
feat AS (
  SELECT * REPLACE (
    {_LOG_REPLACE})
  FROM feat_p
),
bounds AS (
  SELECT quantile_cont(theoretical_price, 0.01) AS tp_lo, quantile_cont(theoretical_price, 0.99) AS tp_hi,
         quantile_cont(stock_price, 0.01) AS sp_lo, quantile_cont(stock_price, 0.99) AS sp_hi
  FROM feat
),
trimmed AS (
  SELECT feat.* FROM feat, bounds
  WHERE theoretical_price BETWEEN tp_lo AND tp_hi AND stock_price BETWEEN sp_lo AND sp_hi
)"""

SQL["ratio_score"] = FEATURE_CTES + "\nSELECT ticker, fy, broad_industry, ratio_score FROM feat"
SQL["per_share_log"] = FEATURE_CTES + f"""
SELECT ticker, fy, ratio_score,
  {_round_list([c for c in _CF if c != "ratio_score"])}
FROM feat"""

SQL["small_fold"] = FEATURE_CTES + """,
tot AS (SELECT broad_industry, count(*)::DOUBLE AS n_rows, sum(market_cap) AS market_cap FROM feat GROUP BY 1),
shares AS (SELECT *, n_rows / sum(n_rows) OVER () AS s_n, market_cap / sum(market_cap) OVER () AS s_c FROM tot)
SELECT CASE WHEN s_n < 0.0035 THEN 'All other industries' ELSE broad_industry END AS label,
       'n_rows' AS metric, round(sum(n_rows), 2) + 0.0 AS value FROM shares GROUP BY 1
UNION ALL
SELECT CASE WHEN s_c < 0.005 THEN 'All other industries' ELSE broad_industry END AS label,
       'market_cap' AS metric, round(sum(market_cap), 2) + 0.0 AS value FROM shares GROUP BY 1"""

SQL["quantile_trim"] = FEATURE_CTES + f"""
SELECT ticker, fy, {r4('theoretical_price')} AS theoretical_price, {r4('stock_price')} AS stock_price FROM trimmed"""

_MEANS = list(SCORE_BREAKPOINTS) + ["stock_price"]
SQL["industry_year_means"] = FEATURE_CTES + f"""
SELECT broad_industry, fy,
  {", ".join(f"{r4(_nn(f'avg({q(c)})'))} AS {q(c)}" for c in _MEANS)}
FROM trimmed GROUP BY broad_industry, fy"""

_UNPIV = ", ".join(q(c) for c in _CF)
SQL["corr_overall"] = FEATURE_CTES + f""",
lng AS (SELECT factor, x, stock_price FROM (UNPIVOT (SELECT stock_price, {_UNPIV} FROM trimmed)
        ON {_UNPIV} INTO NAME factor VALUE x))
SELECT factor, {r4(_safe_corr('x', 'stock_price'))} AS corr FROM lng GROUP BY factor
UNION ALL
SELECT f AS factor, NULL::DOUBLE AS corr FROM (SELECT unnest([{", ".join(repr(c) for c in _CF)}]) AS f)
WHERE f NOT IN (SELECT factor FROM lng)"""

SQL["corr_by_group"] = FEATURE_CTES + f""",
grp AS (SELECT broad_industry, count(*) AS n FROM trimmed WHERE broad_industry <> 'Other/Unclassified' GROUP BY 1),
lng AS (SELECT broad_industry, factor, x, stock_price FROM (UNPIVOT (
          SELECT broad_industry, stock_price, {_UNPIV} FROM trimmed WHERE broad_industry <> 'Other/Unclassified')
        ON {_UNPIV} INTO NAME factor VALUE x)),
c AS (SELECT broad_industry, factor, {_safe_corr('x', 'stock_price')} AS corr FROM lng GROUP BY 1, 2)
SELECT c.broad_industry, factor, {r4('corr')} AS corr FROM c JOIN grp USING (broad_industry)
WHERE n >= 5 AND corr IS NOT NULL"""

SQL["r2_overall"] = FEATURE_CTES + f"""
SELECT count(*) AS n,
  {r4('1.0 - sum((stock_price - theoretical_price) ^ 2) / (count(*) * var_pop(stock_price))')} AS r2
FROM trimmed WHERE stock_price IS NOT NULL AND theoretical_price IS NOT NULL"""

_fin = lambda x: f"coalesce(CASE WHEN isinf({x}) OR isnan({x}) THEN NULL ELSE {x} END, 0.0)"
SQL["r2_by_year"] = FEATURE_CTES + f""",
g AS (SELECT fy, count(*) AS n, sum(({_fin('stock_price')} - {_fin('theoretical_price')}) ^ 2) AS sse,
        count(*) * var_pop({_fin('stock_price')}) AS sst FROM trimmed GROUP BY fy)
SELECT fy, n, {r4('CASE WHEN sst <> 0 THEN 1.0 - sse / sst END')} AS r2 FROM g"""

SQL["trend_line"] = FEATURE_CTES + f""",
g AS (SELECT regr_count(stock_price, theoretical_price) AS n, regr_slope(stock_price, theoretical_price) AS slope,
        regr_intercept(stock_price, theoretical_price) AS intercept, regr_r2(stock_price, theoretical_price) AS r2,
        regr_sxx(stock_price, theoretical_price) AS sxx, regr_syy(stock_price, theoretical_price) AS syy,
        regr_sxy(stock_price, theoretical_price) AS sxy
      FROM trimmed WHERE stock_price IS NOT NULL AND theoretical_price IS NOT NULL)
SELECT CAST(n AS BIGINT) AS n, {r4('slope')} AS slope, {r4('intercept')} AS intercept, {r4('r2')} AS r2,
  {r4('CASE WHEN sxx <> 0 THEN sqrt((syy - slope * sxy) / (n - 2) / sxx) END')} AS se_slope FROM g"""

SQL["bin_pivot"] = FEATURE_CTES + f""",
mm AS (SELECT min(asset_value) AS r0, max(asset_value) AS r1, min(career_value) AS c0, max(career_value) AS c1 FROM trimmed),
b AS (
  SELECT CASE WHEN r1 = r0 THEN 1 ELSE greatest(1, CAST(ceil((asset_value - r0) / (r1 - r0) * 100) AS INTEGER)) END AS row_bin,
         CASE WHEN c1 = c0 THEN 1 ELSE greatest(1, CAST(ceil((career_value - c0) / (c1 - c0) * 100) AS INTEGER)) END AS col_bin,
         stock_price, theoretical_price
  FROM trimmed, mm WHERE asset_value IS NOT NULL AND career_value IS NOT NULL
)
SELECT row_bin, col_bin, count(*) AS n, {r4(_nn('avg(stock_price)'))} AS mean_stock_price,
  {r4(_nn('avg(theoretical_price)'))} AS mean_theoretical_price
FROM b GROUP BY 1, 2"""

from ..operators.features import analysis_numeric_columns as _anc  # noqa: E402

_NUMC = _anc()


def _pct(expr):
    return f"(avg(CASE WHEN {expr} THEN 1.0 ELSE 0.0 END) * 100)"


_PROFILE_UNION = "\nUNION ALL\n".join(
    f"SELECT broad_industry, '{c}' AS \"column\", {_pct(f'isinf({q(c)})')} AS inf_pct, "
    f"{_pct(f'{q(c)} = \'-inf\'::DOUBLE')} AS neginf_pct, {_pct(f'({q(c)} IS NULL OR isnan({q(c)}))')} AS nan_pct "
    f"FROM feat GROUP BY broad_industry" for c in _NUMC)
SQL["inf_missing_profile"] = FEATURE_CTES + f""",
prof AS ({_PROFILE_UNION})
SELECT broad_industry, "column", {r4('inf_pct')} AS inf_pct, {r4('neginf_pct')} AS neginf_pct, {r4('nan_pct')} AS nan_pct
FROM prof WHERE inf_pct + neginf_pct + nan_pct > 0"""

_MISS_UNION = "\nUNION ALL\n".join(
    f"SELECT broad_industry, '{c}' AS \"column\", "
    f"{_pct(f'({q(c)} IS NULL OR isnan({q(c)}) OR isinf({q(c)}))')} AS missing_pct FROM feat GROUP BY broad_industry"
    for c in _NUMC)
SQL["missing_ratio"] = FEATURE_CTES + f""",
mr AS ({_MISS_UNION})
SELECT broad_industry, "column", {r4('missing_pct')} AS missing_pct FROM mr"""

_IMP = _CF + ["theoretical_price", "stock_price"]
_finite = lambda x: f"(CASE WHEN isinf({x}) OR isnan({x}) THEN NULL ELSE {x} END)"
SQL["median_impute"] = FEATURE_CTES + f""",
med AS (SELECT broad_industry,
  {", ".join(f"quantile_cont({_finite(q(c))}, 0.5) AS {q('m_' + c)}" for c in _IMP)}
  FROM feat GROUP BY broad_industry)
SELECT ticker, fy,
  {", ".join(f"{r4(f'coalesce({_finite(q(c))}, med.{q(chr(109) + chr(95) + c)})')} AS {q(c)}" for c in _IMP)}
FROM feat LEFT JOIN med USING (broad_industry)"""

SQL["factor_long"] = FEATURE_CTES + f""",
lc AS (SELECT *, CASE WHEN 1 + coalesce(market_cap, 0.0) > 0 THEN ln(1 + coalesce(market_cap, 0.0)) END AS lcap FROM feat),
sz AS (SELECT min(lcap) AS lo, max(lcap) AS hi FROM lc),
f2 AS (SELECT lc.*, 40.0 * (lcap - lo) / (hi - lo + 1e-9) + 5.0 AS norm_size FROM lc, sz),
lng AS (SELECT * FROM (UNPIVOT (SELECT ticker, fy, broad_industry, stock_price, norm_size, {_UNPIV} FROM f2)
        ON {_UNPIV} INTO NAME factor VALUE x))
SELECT ticker, fy, broad_industry, factor, {r4('x')} AS x, {r4('stock_price')} AS stock_price,
  {r4('norm_size')} AS norm_size
FROM lng WHERE x IS NOT NULL AND stock_price IS NOT NULL"""

SQL["top_k_cap"] = FEATURE_CTES + f"""
SELECT ticker, {r4('mean_market_cap', 2)} AS mean_market_cap FROM (
  SELECT ticker, avg(market_cap) AS mean_market_cap FROM feat GROUP BY ticker) t
WHERE mean_market_cap IS NOT NULL
ORDER BY mean_market_cap DESC, ticker LIMIT 20"""

SQL["residual"] = FEATURE_CTES + f"""
SELECT ticker, fy, {r4(_nn('stock_price - theoretical_price'))} AS model_error FROM trimmed"""


# ---- filings: filters, dedupe, eligibility, concept resolution ------------------------
from ..constants import SUGGEST_IGNORE_WORDS  # noqa: E402
from ..sources.standin import (STANDIN_ADDITIVE, STANDIN_ANCHOR, STANDIN_CONCEPTS,  # noqa: E402
                               STANDIN_END, STANDIN_START)


def _concept_values():
    rows = []
    for c, tags in STANDIN_CONCEPTS.items():
        for i, t in enumerate(tags):
            rows.append(f"('{c}', '{t}', {i}, 'fill')")
    for c, t in STANDIN_ADDITIVE.items():
        rows.append(f"('{c}', '{t}', {len(STANDIN_CONCEPTS.get(c, []))}, 'add')")
    return ", ".join(rows)


FACTS_CTES = f"""WITH
fl AS (
  SELECT l_suppkey, CAST(year(o_orderdate) AS INTEGER) AS fy, month(o_orderdate) AS fm, o_orderdate, l_shipdate,
         o_orderpriority, o_totalprice, l_extendedprice, l_returnflag, l_linestatus, l_quantity, l_discount
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
),
filing AS (
  SELECT l_suppkey, fy, fm, CAST(max(o_orderdate) AS DATE) AS "end", CAST(max(l_shipdate) AS DATE) AS filed,
         min(o_orderpriority) AS prio, sum(o_totalprice / 7.0) AS assets
  FROM fl GROUP BY 1, 2, 3
),
filing2 AS (
  SELECT *, CASE prio WHEN '1-URGENT' THEN '10-K' WHEN '2-HIGH' THEN '10-K/A' WHEN '3-MEDIUM' THEN '20-F'
                      WHEN '4-NOT SPECIFIED' THEN '10-Q' ELSE '10-KT' END AS form
  FROM filing
),
per_tag AS (
  SELECT l_suppkey, fy, fm,
    (CASE l_returnflag WHEN 'A' THEN 'Accepted' WHEN 'N' THEN 'New' ELSE 'Returned' END)
      || (CASE WHEN l_linestatus = 'F' THEN 'FulfilledRevenue' ELSE 'OpenLiabilities' END) AS tag,
    l_linestatus, sum(l_extendedprice / 7.0) AS v, max(CASE WHEN l_quantity = 50 THEN 1 ELSE 0 END) AS hole,
    max(l_discount) AS maxd
  FROM fl GROUP BY 1, 2, 3, 4, 5
),
facts AS (
  SELECT 'S' || CAST(p.l_suppkey AS VARCHAR) AS cik, 'us-gaap' AS ns, tag, 'USD' AS unit,
    CASE WHEN l_linestatus = 'F' THEN CAST(f."end" - (CASE WHEN maxd >= 0.05 THEN 364 ELSE 91 END) AS DATE) END AS start,
    f."end", CASE WHEN hole = 1 THEN NULL ELSE v END AS val, p.fy, 'FY' AS fp, form, filed
  FROM per_tag p JOIN filing2 f ON p.l_suppkey = f.l_suppkey AND p.fy = f.fy AND p.fm = f.fm
  UNION ALL
  SELECT 'S' || CAST(l_suppkey AS VARCHAR), 'us-gaap', '{STANDIN_ANCHOR}', 'USD', NULL::DATE, "end", assets, fy, 'FY', form, filed
  FROM filing2
),
has_start AS (SELECT cik, ns, tag, unit, bool_or(start IS NOT NULL) AS hs FROM facts GROUP BY ALL),
annual AS (
  SELECT f.* FROM facts f JOIN has_start USING (cik, ns, tag, unit)
  WHERE regexp_full_match(form, '(10-K|20-F)(/A)?') AND fy >= {STANDIN_START}
    AND (NOT hs OR date_diff('day', start, "end") >= 300)
),
latest AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY cik, ns, tag, unit, fy, fp ORDER BY "end" DESC, filed DESC, val DESC NULLS LAST) AS rn
    FROM annual) WHERE rn = 1
),
span AS (SELECT cik, min(fy) AS earliest_fy, max(fy) AS latest_fy FROM facts WHERE tag = '{STANDIN_ANCHOR}' GROUP BY cik),
anc AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY cik, fy, fp ORDER BY "end" DESC, filed DESC, val DESC NULLS LAST) AS rn
    FROM facts WHERE tag = '{STANDIN_ANCHOR}' AND regexp_full_match(form, '(10-K|20-F)(/A)?') AND fy >= {STANDIN_START})
  WHERE rn = 1
),
cnt AS (SELECT cik, count(*) AS n FROM anc GROUP BY cik),
elig AS (
  SELECT cik, earliest_fy, latest_fy, coalesce(n, 0) AS n_annual,
    coalesce(earliest_fy <= {STANDIN_START} AND latest_fy >= {STANDIN_END} AND coalesce(n, 0) >= 7, false) AS eligible
  FROM span LEFT JOIN cnt USING (cik)
),
ok AS (SELECT cik FROM elig WHERE eligible),
template AS (SELECT cik, fy, fp, filed, "end" FROM latest WHERE tag = '{STANDIN_ANCHOR}' AND cik IN (SELECT cik FROM ok)),
vals AS (SELECT * FROM latest WHERE cik IN (SELECT cik FROM ok)),
concepts(concept, tag, rank, mode) AS (VALUES {_concept_values()}),
m AS (
  SELECT v.cik, c.concept, v.fy, v.fp, v.filed, v."end", v.tag, c.rank, c.mode, v.val
  FROM vals v JOIN concepts c USING (tag) JOIN template t USING (cik, fy, fp, filed, "end")
  WHERE v.val IS NOT NULL
),
fill AS (
  SELECT cik, concept, fy, fp, filed, "end", arg_min(val, rank) AS fill_val, min(rank) AS src_rank
  FROM m WHERE mode = 'fill' GROUP BY ALL
),
n_t AS (SELECT cik, count(*) AS n_t FROM template GROUP BY cik),
n_f AS (SELECT cik, concept, count(*) AS n_f FROM fill WHERE concept IN (SELECT concept FROM concepts WHERE mode = 'add') GROUP BY ALL),
kinds AS (SELECT v.cik, c.concept, bool_or(c.mode = 'fill') AS has_fill, bool_or(c.mode = 'add') AS has_add
  FROM vals v JOIN concepts c USING (tag) WHERE v.val IS NOT NULL GROUP BY ALL),
reached AS (
  SELECT h.cik, h.concept FROM kinds h JOIN n_t USING (cik) LEFT JOIN n_f USING (cik, concept)
  WHERE h.has_add AND h.has_fill AND coalesce(n_f, 0) < n_t
),
add_vals AS (SELECT cik, concept, fy, fp, filed, "end", sum(val) AS add_val FROM m WHERE mode = 'add' GROUP BY ALL),
added AS (
  SELECT t.cik, r.concept, t.fy, t.fp, t.filed, t."end",
    coalesce(fill_val, 0.0) + coalesce(add_val, 0.0) AS val, src_rank, fill_val IS NULL AS by_add
  FROM template t JOIN reached r USING (cik)
  LEFT JOIN fill USING (cik, concept, fy, fp, filed, "end")
  LEFT JOIN add_vals USING (cik, concept, fy, fp, filed, "end")
),
plain AS (
  SELECT f.cik, f.concept, f.fy, f.fp, f.filed, f."end", f.fill_val AS val, f.src_rank, false AS by_add
  FROM fill f WHERE NOT EXISTS (SELECT 1 FROM reached r WHERE r.cik = f.cik AND r.concept = f.concept)
),
alone AS (
  SELECT a.cik, a.concept, a.fy, a.fp, a.filed, a."end", add_val AS val, NULL::INTEGER AS src_rank, true AS by_add
  FROM add_vals a JOIN kinds k USING (cik, concept) WHERE NOT k.has_fill
),
resolved AS (SELECT * FROM plain UNION ALL SELECT * FROM added UNION ALL SELECT * FROM alone),
avail AS (SELECT DISTINCT v.cik, c.concept, c.tag, c.rank FROM vals v JOIN concepts c USING (tag) WHERE v.val IS NOT NULL),
yr AS (
  SELECT cik, concept, src_rank AS rank, min(fy) AS y0, max(fy) AS y1 FROM resolved
  WHERE src_rank IS NOT NULL AND NOT by_add GROUP BY ALL
  UNION ALL
  SELECT r.cik, r.concept, a.rank, min(r.fy), max(r.fy) FROM resolved r
  JOIN (SELECT concept, rank FROM concepts WHERE mode = 'add') a USING (concept) WHERE r.by_add GROUP BY ALL
),
items AS (
  SELECT a.cik, a.concept, a.rank, a.tag,
    CASE WHEN y0 IS NULL THEN a.tag WHEN y0 = y1 THEN '[' || y0 || '] ' || a.tag
         ELSE '[' || y0 || '-' || y1 || '] ' || a.tag END AS txt
  FROM avail a LEFT JOIN yr USING (cik, concept, rank)
),
prov AS (
  SELECT cik, concept, CASE WHEN count(*) = 1 THEN min(tag) ELSE string_agg(txt, ' + ' ORDER BY rank) END AS used_tag
  FROM items GROUP BY ALL
),
required(concept, missing_tag) AS (VALUES {", ".join(f"('{c}', '{t[0]}')" for c, t in STANDIN_CONCEPTS.items())}),
missing AS (
  SELECT o.cik, r.concept, r.missing_tag FROM ok o, required r
  WHERE NOT EXISTS (SELECT 1 FROM avail a WHERE a.cik = o.cik AND a.concept = r.concept)
)"""

SQL["form_filter"] = FACTS_CTES + f"""
SELECT cik, tag, count(*) AS n FROM facts
WHERE regexp_full_match(form, '(10-K|20-F)(/A)?') AND fy >= {STANDIN_START} GROUP BY cik, tag"""
SQL["duration_filter"] = FACTS_CTES + "\nSELECT cik, tag, count(*) AS n FROM annual GROUP BY cik, tag"
MIXED_CTES = FACTS_CTES + """,
mixed AS (
  SELECT f.* REPLACE (CASE WHEN s_acctbal < 0 THEN 'ifrs-full' WHEN s_acctbal < 1000 THEN 'dei'
                           WHEN form = '20-F' THEN 'ifrs-full' ELSE 'us-gaap' END AS ns)
  FROM facts f JOIN supplier ON cik = 'S' || CAST(s_suppkey AS VARCHAR)
)"""
SQL["namespace_rank"] = MIXED_CTES + f"""
SELECT cik, CASE min(CASE ns WHEN 'us-gaap' THEN 0 ELSE 1 END) WHEN 0 THEN 'us-gaap' ELSE 'ifrs-full' END AS ns
FROM mixed WHERE tag = '{STANDIN_ANCHOR}' AND ns IN ('us-gaap', 'ifrs-full') GROUP BY cik"""
SQL["dedupe_latest"] = FACTS_CTES + f"""
SELECT cik, tag, fy, fp, CAST("end" AS VARCHAR) AS "end", CAST(filed AS VARCHAR) AS filed, {r4('val')} AS val FROM latest"""
SQL["eligibility"] = FACTS_CTES + "\nSELECT * FROM elig"
SQL["fallback_fill"] = FACTS_CTES + f"\nSELECT cik, concept, fy, {r4('val')} AS val, coalesce(src_rank, -1) AS src_rank FROM resolved"
SQL["provenance"] = FACTS_CTES + "\nSELECT cik, concept, used_tag FROM prov"
SQL["tag_inventory"] = FACTS_CTES + """
SELECT cik, array_to_string(list_sort(list(DISTINCT tag)), ',') AS tags FROM facts WHERE ns = 'us-gaap' GROUP BY cik"""
SQL["required_tags"] = FACTS_CTES + "\nSELECT cik, concept, missing_tag FROM missing"
_IGN = ", ".join(f"'{w}'" for w in SUGGEST_IGNORE_WORDS)
SQL["tag_suggest"] = FACTS_CTES + f""",
sw AS (SELECT cik, missing_tag, unnest(regexp_extract_all(missing_tag, '([A-Z][a-z]*)', 1)) AS word FROM missing),
sw2 AS (SELECT * FROM sw WHERE word NOT IN ({_IGN})),
inv AS (SELECT DISTINCT cik, tag FROM facts),
hits AS (SELECT DISTINCT s.cik, s.missing_tag, i.tag FROM sw2 s JOIN inv i ON s.cik = i.cik AND contains(i.tag, s.word))
SELECT m.cik, m.missing_tag,
  coalesce((SELECT array_to_string(list_sort(list(h.tag)), ',') FROM hits h
            WHERE h.cik = m.cik AND h.missing_tag = m.missing_tag), '') AS suggestions
FROM missing m"""


# ---- prices: forward event-window as-of join (range-join form as the oracle) ---------------
SQL["event_window_price"] = f"""
WITH p AS (
  SELECT user_id AS k, ts, value AS close, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rk
  FROM events WHERE event_type = 'view'
),
a AS (SELECT event_id AS anchor_id, user_id AS k, ts FROM events WHERE event_type = 'error'),
nx AS (SELECT a.anchor_id, a.k, min(p.rk) AS r0 FROM a LEFT JOIN p ON p.k = a.k AND p.ts >= a.ts GROUP BY a.anchor_id, a.k)
SELECT nx.anchor_id, {r4('avg(p.close)')} AS mean_next, count(p.close) AS n_used
FROM nx LEFT JOIN p ON p.k = nx.k AND p.rk BETWEEN nx.r0 AND nx.r0 + 4
GROUP BY nx.anchor_id"""


# ---- model search inputs ---------------------------------------------------------------------
SQL["time_split"] = FEATURE_CTES + """
SELECT broad_industry, CAST(sum(CASE WHEN fy <= 1999 THEN 1 ELSE 0 END) AS BIGINT) AS n_train,
  CAST(sum(CASE WHEN fy >= 2000 THEN 1 ELSE 0 END) AS BIGINT) AS n_test, count(DISTINCT ticker) AS n_companies
FROM feat WHERE broad_industry <> 'Other/Unclassified' GROUP BY broad_industry"""

_f2 = lambda x: f"(CASE WHEN isinf({x}) OR isnan({x}) THEN NULL ELSE {x} END)"
SQL["scaled_train"] = FEATURE_CTES + f""",
fo AS (SELECT * FROM feat WHERE broad_industry <> 'Other/Unclassified'),
med AS (SELECT broad_industry,
  {", ".join(f"quantile_cont({_f2(q(c))}, 0.5) AS {q('m_' + c)}" for c in _CF)}
  FROM fo GROUP BY broad_industry),
imp AS (SELECT fo.broad_industry, fo.fy,
  {", ".join(f"coalesce({_f2('fo.' + q(c))}, med.{q('m_' + c)}) AS {q(c)}" for c in _CF)}
  FROM fo LEFT JOIN med USING (broad_industry)),
lng AS (SELECT broad_industry, feature, v FROM (UNPIVOT (SELECT * FROM imp WHERE fy <= 1999)
        ON {_UNPIV} INTO NAME feature VALUE v))
SELECT broad_industry, feature, {r4('avg(v)')} AS mean, {r4('stddev_pop(v)')} AS std FROM lng GROUP BY 1, 2"""


SQL["trend_band"] = FEATURE_CTES + f""",
g AS (SELECT regr_count(stock_price, theoretical_price) AS n, regr_slope(stock_price, theoretical_price) AS slope,
        regr_intercept(stock_price, theoretical_price) AS intercept, regr_sxx(stock_price, theoretical_price) AS sxx,
        regr_syy(stock_price, theoretical_price) AS syy, regr_sxy(stock_price, theoretical_price) AS sxy,
        avg(theoretical_price) AS mx, min(theoretical_price) AS lo, max(theoretical_price) AS hi
      FROM trimmed WHERE stock_price IS NOT NULL AND theoretical_price IS NOT NULL),
pt AS (SELECT CAST(i AS INTEGER) AS point, lo + (hi - lo) * i / 99 AS x, g.* FROM g, range(100) r(i)),
fit AS (SELECT point, x, intercept + slope * x AS fit,
  1.959963984540054 * sqrt((syy - slope * sxy) / (n - 2) * (1.0 / n + (x - mx) * (x - mx) / sxx)) AS half FROM pt)
SELECT point, {r4('x')} AS x, {r4('fit')} AS fit, {r4('fit - half')} AS lower, {r4('fit + half')} AS upper FROM fit"""

SQL["size_scale"] = FEATURE_CTES + f""",
lc AS (SELECT *, CASE WHEN 1 + coalesce(market_cap, 0.0) > 0 THEN ln(1 + coalesce(market_cap, 0.0)) END AS lcap FROM feat),
sz AS (SELECT min(lcap) AS lo, max(lcap) AS hi FROM lc)
SELECT ticker, fy, {r4('40.0 * (lcap - lo) / (hi - lo + 1e-9) + 5.0')} AS norm_size FROM lc, sz"""
SQL["sic_groups"] = BASE + f"""
SELECT industry, {broad_industry('industry')} AS broad_industry, count(*) AS n_rows FROM derived GROUP BY 1, 2"""

# ---- sources: directory, JSON field access, retry selection, top-k profile -----------------
SQL["directory_scan"] = """
SELECT lpad(CAST(s_suppkey AS VARCHAR), 10, '0') AS cik, 'S' || CAST(s_suppkey AS VARCHAR) AS ticker,
       s_name AS title, CAST(s_suppkey AS BIGINT) AS source_index FROM supplier"""
SQL["json_facts"] = MIXED_CTES + f"""
SELECT cik, ns, tag, unit, CAST(start AS VARCHAR) AS start, CAST("end" AS VARCHAR) AS "end", CAST(filed AS VARCHAR) AS filed,
  {r4('val')} AS val, fy, fp, form, bool_or(start IS NOT NULL) OVER (PARTITION BY cik, ns, tag, unit) AS has_start FROM mixed"""
SQL["json_field"] = "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events"
SQL["retry_set"] = CLEANUP_CTES + """,
lg AS (SELECT ticker AS cik, 'Fail' AS status, message AS error FROM dmg
       UNION ALL SELECT ticker, 'Fail', 'Deleted due to missing shares#.' FROM zero)
SELECT DISTINCT lpad(cik, 10, '0') AS cik FROM lg WHERE error LIKE '%shares#%' AND status = 'Fail'"""
SQL["top_missing"] = FEATURE_CTES + f""",
prof AS ({_PROFILE_UNION}),
p2 AS (SELECT *, row_number() OVER (PARTITION BY broad_industry ORDER BY nan_pct DESC, "column") AS rk
       FROM prof WHERE inf_pct + neginf_pct + nan_pct > 0)
SELECT broad_industry, "column", {r4('inf_pct')} AS inf_pct, {r4('neginf_pct')} AS neginf_pct,
  {r4('nan_pct')} AS nan_pct FROM p2 WHERE rk <= 10"""


# ---- complete stage 1 ---------------------------------------------------------------------
# Every concept of the stand-in taxonomy has one tag, so that each line item is a conditional
# sum over a supplier-year's lines; the company errors follow from which tags a company has.
from ..constants import (ALLOW_MISSING, FALLBACKS, LINE_ITEMS, MSG_NONE_EMPTY, MSG_NO_USED_TAG, MSG_SKIP, MSG_TAG_MISSING,  # noqa: E402
                         PRICE_COLUMNS)
from ..sources.standin import TAXONOMY_TAGS  # noqa: E402

_COMBO = "((CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END) * 2 + (CASE l_linestatus WHEN 'F' THEN 0 ELSE 1 END)) * 3 " \
         "+ (CASE WHEN l_quantity <= 17 THEN 0 WHEN l_quantity <= 34 THEN 1 ELSE 2 END)"
_PLACE = {t: i for i, (t, _, _) in enumerate(TAXONOMY_TAGS)}


def _own_tag(tag: str):
    """The taxonomy's tag of a concept, or None."""
    return next((t for t in FALLBACKS.get(tag, [tag]) if t in _PLACE), None)


def _text(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _missing_checks() -> str:
    """The strict run's errors in processing order, for a company that is eligible."""
    out = []
    for tag, name in LINE_ITEMS:
        own, fallback = _own_tag(tag), tag in FALLBACKS
        has = f"{'avail' if fallback else 'present'}_{_PLACE[own]}" if own else None
        if name == "expense_general/admin":
            out.append((f"NOT {has}", MSG_NO_USED_TAG))
        elif name == "recurrent_profit":
            out.append((f"NOT {has}", MSG_NONE_EMPTY))
        elif name in ("shares#", "eps") or tag in ALLOW_MISSING:
            continue
        else:
            out.append((f"NOT {has}" if has else "TRUE", MSG_TAG_MISSING % tag))
    return " ".join(f"WHEN {c} THEN {_text(m)}" for c, m in out)


_STAGE1 = LINES_CTE + "," + SUPPLIERS_CTE + f""",
tagged AS (SELECT l_suppkey, fy, {_COMBO} AS combo, sum(l_extendedprice) AS v FROM lines GROUP BY ALL),
filed_year AS (
  SELECT l_suppkey, CAST(year(o_orderdate) AS INTEGER) AS fy, CAST(max(l_shipdate) AS DATE) AS filed,
         min(o_orderpriority) IN ('1-URGENT', '2-HIGH', '3-MEDIUM') AS annual, sum(o_totalprice / 7.0) AS asset, sum(l_quantity) AS shares
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL),
has AS (
  SELECT l_suppkey,
    {", ".join(f"coalesce(bool_or(combo = {i}), false) AS present_{i}, coalesce(bool_or(combo = {i} AND annual AND fy >= {STANDIN_START}), false) AS avail_{i}" for i in _PLACE.values())}
  FROM tagged JOIN filed_year USING (l_suppkey, fy) GROUP BY l_suppkey),
reach AS (
  SELECT l_suppkey, min(fy) <= {STANDIN_START} AND max(fy) >= {STANDIN_END}
         AND count(*) FILTER (WHERE annual AND fy >= {STANDIN_START}) >= 7 AS eligible
  FROM filed_year GROUP BY l_suppkey),
company AS (
  SELECT s_suppkey, lpad(CAST(s_suppkey AS VARCHAR), 10, '0') AS cik, ticker, name, industry,
    CASE WHEN eligible IS NULL THEN {_text(MSG_TAG_MISSING % "asset")}
         WHEN NOT eligible THEN printf({_text(MSG_SKIP)}, lpad(CAST(s_suppkey AS VARCHAR), 10, '0'), ticker, name)
         {_missing_checks()} ELSE '' END AS error, eligible IS NOT NULL AS has_ns
  FROM sup LEFT JOIN reach ON s_suppkey = reach.l_suppkey LEFT JOIN has ON s_suppkey = has.l_suppkey),
item AS (
  SELECT l_suppkey, fy,
    {", ".join((f"sum(CASE WHEN combo = {_PLACE[_own_tag(t)]} THEN v * {TAXONOMY_TAGS[_PLACE[_own_tag(t)]][2]} END)" if _own_tag(t) else "NULL::DOUBLE") + f" AS {q(n)}"
               for t, n in LINE_ITEMS if n not in ("shares#", "eps"))}
  FROM tagged GROUP BY l_suppkey, fy),
day AS (
  SELECT l_suppkey, CAST(l_shipdate AS DATE) AS d, avg(l_extendedprice / 103.27) AS adj, avg(l_extendedprice * (1 + l_tax) / 103.27) AS unadj,
         row_number() OVER (PARTITION BY l_suppkey ORDER BY CAST(l_shipdate AS DATE)) AS rk
  FROM lines GROUP BY 1, 2),
first_day AS (SELECT f.l_suppkey, f.fy, min(rk) AS r0 FROM filed_year f JOIN day USING (l_suppkey) WHERE day.d >= f.filed GROUP BY 1, 2),
price AS (
  SELECT x.l_suppkey, x.fy, avg(adj) AS stock_price, avg(unadj) AS stock_price_unadjusted
  FROM first_day x JOIN day ON day.l_suppkey = x.l_suppkey AND rk BETWEEN r0 AND r0 + 4 GROUP BY 1, 2),
panel AS (
  SELECT ticker, name, industry, f.fy, 'FY' AS fp, f.filed, f.asset, f.shares::DOUBLE AS "shares#", {_div('i.net_income', 'f.shares')} AS eps,
    i.* EXCLUDE (l_suppkey, fy), stock_price, stock_price_unadjusted
  FROM company c JOIN filed_year f ON c.s_suppkey = f.l_suppkey AND c.error = '' AND f.annual AND f.fy >= {STANDIN_START}
  JOIN item i ON i.l_suppkey = f.l_suppkey AND i.fy = f.fy
  LEFT JOIN price p ON p.l_suppkey = f.l_suppkey AND p.fy = f.fy)"""
SQL["panel_build"] = "WITH " + _STAGE1 + "," + DERIVED_CTE + "," + valuation_cte("derived", 1, "v1") + f"""
SELECT ticker, name, industry, fy, fp, CAST(filed AS VARCHAR) AS filed,
  {_round_list([*NUMERIC_PANEL, *PRICE_COLUMNS, *VALUATION_V1_COLUMNS])}
FROM v1"""
SQL["panel_build_log"] = "WITH " + _STAGE1 + """
SELECT cik, ticker, name AS company_name, CASE WHEN has_ns THEN 'us-gaap' END AS namespace,
  CASE WHEN error = '' THEN 'Success' ELSE 'Fail' END AS status, error FROM company"""
