"""Stand-in inputs derived from the driver's TPC-H-style tables.

The filings data model (company x fiscal year panel, long tag facts, daily
prices) is mapped onto the shared test tables so every operator can be checked
against an independent SQL oracle and benchmarked at growing scale:

* panel  = one row per (supplier, order year): lineitem x orders x supplier x
  nation x region, aggregated. Missing values are *data-derived*: a line item
  is NULL in a year when a rare combination of quantity / discount / tax occurs
  among that supplier-year's lines, so holes grow with the data instead of
  following a key rule.
* long facts = one value per (supplier, year, tag) with tag = returnflag ||
  linestatus, plus a filing date and period end per value.
* prices = ``view`` events (close = value), anchors = ``error`` events.

Every reader here touches only the columns it needs, so the Parquet scan
prunes columns and pushes filters.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SHARES = "shares#"
SGA = "expense_general/admin"
SPREAD = 8                  # tasks over which the lines of a company year are dealt, if its company has
HOT_LINES = 1_000_000       # more lines than this

# what the panel asks of the codes of a line and of its order: a bit each, so that they travel as one number
CODES = [("l_returnflag", "R"), ("l_returnflag", "A"), ("l_returnflag", "N"), ("l_linestatus", "O"), ("l_linestatus", "F"),
         ("o_orderstatus", "O"), ("o_orderstatus", "F"), ("o_orderstatus", "P")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus", "l_shipdate")
    od = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", "o_orderdate", "o_orderstatus", "o_orderpriority")
    return li.join(od, li.l_orderkey == od.o_orderkey)


def _codes(columns):
    """The bits of ``CODES`` that these columns decide; a missing code sets none."""
    return reduce(add, [F.when(F.col(c) == v, F.lit(1 << i)).otherwise(F.lit(0)) for i, (c, v) in enumerate(CODES) if c in columns])


def _coded(column: str, value: str):
    return F.col("codes").bitwiseAND(F.lit(1 << CODES.index((column, value)))) != 0


def _company_year_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with what the panel needs of their orders, those of a company year in one task;
    a company with more than ``HOT_LINES`` lines has each of its years in ``SPREAD`` tasks.

    Lines travel twice, to their orders and to their company year, so they are made narrow
    before the first trip: codes as bits, dates as days. Companies that large are one in
    ``HOT_LINES`` lines at most, so broadcasting their keys is bounded.
    """
    li = table(spark, sf_dir, "lineitem")
    od = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", F.year("o_orderdate").alias("fy"), _codes(["o_orderstatus"]).alias("o_codes"))
    hot = li.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > HOT_LINES).select(F.col("l_suppkey").alias("hot"))
    lines = li.select("l_orderkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                      _codes(["l_returnflag", "l_linestatus"]).alias("l_codes"), F.to_date("l_shipdate").alias("l_shipdate"))
    part = F.when(F.col("hot").isNotNull(), F.pmod("l_orderkey", F.lit(SPREAD))).otherwise(F.lit(0))
    return (lines.join(od, lines.l_orderkey == od.o_orderkey)
            .join(F.broadcast(hot), F.col("l_suppkey") == F.col("hot"), "left")
            .select("l_suppkey", "fy", part.cast("byte").alias("part"), "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                    (F.col("l_codes") + F.col("o_codes")).alias("codes"), "l_shipdate", "o_totalprice")
            .repartition("l_suppkey", "fy", "part"))


def suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Company directory stand-in: ticker, name, industry text 'NNNN REGION'.

    nation (25 rows) and region (5 rows) are fixed-size TPC-H dimensions, so
    broadcasting them is bounded by construction; the supplier table grows with
    the scale factor and is left to the optimizer / AQE size checks.
    """
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    sic = (F.col("s_suppkey") * 2671 + F.col("s_nationkey") * 389) % 10000
    return (s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey)
            .join(F.broadcast(r), F.col("n_regionkey") == r.r_regionkey)
            .select(F.col("s_suppkey"),
                    F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("ticker"),
                    F.col("s_name").alias("name"),
                    F.concat_ws(" ", F.lpad(sic.cast("string"), 4, "0"), F.col("r_name")).alias("industry"),
                    (F.lit(20.0) + F.lit(75.0) * (F.col("s_acctbal") + 1000.0) / 11000.0).alias("price_div")))


def _flag(q=None, d=None, t=None):
    cond = F.lit(True)
    if q is not None:
        cond = cond & (F.col("l_quantity") == q)
    if d is not None:
        cond = cond & (F.col("l_discount") == d)
    if t is not None:
        cond = cond & (F.col("l_tax") == t)
    return F.max(cond.cast("int")) == 1


def _sum_if(expr, cond):
    return F.sum(F.when(cond, expr))


def supplier_year_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide company x year panel with the raw line items and two prices."""
    col = F.col
    # Money is scaled by 1/7: since every line
    # product has at most 4 decimals before the division by 7, no true value
    # sits on a 4-decimal rounding half-boundary, so the rounded comparison is
    # insensitive to engine-dependent summation order.
    e, d, t, q = col("l_extendedprice") / 7.0, col("l_discount"), col("l_tax"), col("l_quantity")
    tp = col("o_totalprice") / 7.0
    # the lines themselves travel, narrower than the many sums of nearly as many groups; a sum
    # travels once the lines of its company year have met
    lines = _company_year_lines(spark, sf_dir)

    agg = lines.groupBy(col("l_suppkey"), col("fy")).agg(
        F.max("l_shipdate").alias("filed"),
        F.sum(e).alias("gross_revenue"),
        _sum_if(e * (1 - d), _coded("l_returnflag", "R")).alias("cost"),
        _sum_if(e * t, _coded("l_linestatus", "O")).alias(SGA),
        F.sum(e * (F.lit(0.06) - d)).alias("operating_income"),
        F.sum(e * (F.lit(0.07) - d)).alias("recurrent_profit"),
        F.sum(e * t).alias("tax"),
        F.sum(e * (F.lit(0.1) - d - t)).alias("net_income"),
        F.sum(q).alias(SHARES),
        F.sum(tp).alias("asset"),
        _sum_if(tp, _coded("l_returnflag", "A")).alias("equity"),
        _sum_if(tp, _coded("l_returnflag", "N")).alias("currasset"),
        _sum_if(e, _coded("l_linestatus", "F") & (q <= 10)).alias("inventory"),
        _sum_if(e * d, q > 40).alias("other_currasset"),
        _sum_if(tp, _coded("l_returnflag", "R")).alias("curr_liabilities"),
        F.sum(e * (F.lit(0.09) - d)).alias("operating_cash"),
        (-_sum_if(e * t, _coded("o_orderstatus", "O"))).alias("investing_cash"),
        _sum_if(e * d, _coded("o_orderstatus", "F")).alias("payment_cap"),
        _sum_if(e * t, _coded("o_orderstatus", "P")).alias("payment_intangible"),
        F.sum(e * (d - t)).alias("financing_cash"),
        F.sum(tp * d).alias("cash_end"),
        F.sum(e * (t - F.lit(0.04))).alias("inventory_delta"),
        _sum_if(e * t, q >= 45).alias("dividend"),
        F.avg(e).alias("avg_price"),
        F.avg(e * (1 + t)).alias("avg_price_unadj"),
        # rare line combinations that blank out a value in that supplier-year
        _flag(50, 0.10).alias("h_fill"),
        _flag(49, 0.09).alias("h_eps"),
        _flag(48, 0.02).alias("h_other"),
        _flag(47, None, 0.01).alias("h_div"),
        _flag(50, 0.10, 0.08).alias("h_ni"),
        _flag(49, 0.0, 0.08).alias("h_rp"),
        _flag(1, 0.0, 0.0).alias("h_cost"),
        _flag(2, 0.05, 0.04).alias("h_zero"),
    )
    sup = suppliers(spark, sf_dir)
    p = agg.join(sup, agg.l_suppkey == sup.s_suppkey)
    blank = lambda cond, x: F.when(cond, F.lit(None).cast("double")).otherwise(col(x))
    shares = (F.when(col("h_fill"), F.lit(None).cast("double"))
              .when(col("h_zero"), F.lit(0.0)).otherwise(col(f"`{SHARES}`")))
    eps = F.when(col("h_eps"), F.lit(None).cast("double")).otherwise(
        col("net_income") / col(f"`{SHARES}`"))
    return p.select(
        "ticker", "name", "industry", col("fy").cast("int").alias("fy"), F.lit("FY").alias("fp"),
        "filed", "gross_revenue",
        blank(col("h_cost"), "cost").alias("cost"),
        col(f"`{SGA}`"), "operating_income",
        blank(col("h_rp"), "recurrent_profit").alias("recurrent_profit"),
        "tax",
        blank(col("h_ni"), "net_income").alias("net_income"),
        shares.alias(SHARES), eps.alias("eps"),
        "asset", "equity", "currasset",
        blank(col("h_fill"), "inventory").alias("inventory"),
        blank(col("h_other"), "other_currasset").alias("other_currasset"),
        "curr_liabilities", "operating_cash", "investing_cash", "payment_cap",
        "payment_intangible", "financing_cash", "cash_end", "inventory_delta",
        blank(col("h_div"), "dividend").alias("dividend"),
        (col("avg_price") / col("price_div")).alias("stock_price"),
        (col("avg_price_unadj") / col("price_div")).alias("stock_price_unadjusted"),
    )


def long_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long (company, tag, period) facts: one value per supplier x year x tag.

    tag = returnflag || linestatus. ``end`` is the last order date of the
    group, ``filed`` the last ship date; a value is missing when the group's
    lines contain the rare quantity/discount pair (data-derived holes).
    """
    col = F.col
    lines = _lines(spark, sf_dir).withColumn("fy", F.year("o_orderdate"))
    g = lines.groupBy(col("l_suppkey"), col("fy"),
                      F.concat(col("l_returnflag"), col("l_linestatus")).alias("tag")).agg(
        F.sum("l_extendedprice").alias("v"),
        F.max("o_orderdate").cast("date").alias("end"),
        F.max("l_shipdate").cast("date").alias("filed"),
        _flag(None, 0.10, 0.08).alias("hole"))
    return g.select(
        F.concat(F.lit("S"), col("l_suppkey").cast("string")).alias("cik"),
        "tag", col("fy").cast("int").alias("fy"), F.lit("FY").alias("fp"), "end", "filed",
        F.when(col("hole"), F.lit(None).cast("double")).otherwise(col("v")).alias("val"))


def event_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price rows: ``view`` events (key = user, ts, tie-break id, close = value)."""
    ev = table(spark, sf_dir, "events")
    return (ev.filter(F.col("event_type") == "view")
            .select(F.col("user_id").alias("key"), "ts", F.col("event_id").alias("seq"),
                    F.col("value").alias("close")))


def event_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchor rows (filings): ``error`` events."""
    ev = table(spark, sf_dir, "events")
    return (ev.filter(F.col("event_type") == "error")
            .select(F.col("event_id").alias("anchor_id"), F.col("user_id").alias("key"), "ts"))


# Stand-in concept table: (concept -> tags in preference order), additive tag,
# and a tag no company reports (drives the required-tag and suggestion checks).
STANDIN_CONCEPTS = {
    "revenue": ["NewFulfilledRevenue", "ReturnedFulfilledRevenue", "AcceptedFulfilledRevenue"],
    "liabilities": ["NewOpenLiabilities", "ReturnedOpenLiabilities"],
    "deferred": ["ReturnedFulfilledRevenueNet"],
}
STANDIN_ADDITIVE = {"revenue": "AcceptedOpenLiabilities"}
STANDIN_ANCHOR = "Assets"
STANDIN_START, STANDIN_END = 1995, 2001


def raw_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long facts in the filings schema (cik, ns, tag, unit, start, end, val, fy, fp, form, filed).

    A *filing* is one supplier-month of orders: period end = last order date of
    the month, filed = last ship date, form from the most urgent order priority
    (10-K, 10-K/A, 20-F pass the annual filter; 10-Q and 10-KT do not). Each
    filing reports the anchor ``Assets`` (instant) and one value per
    returnflag/linestatus tag; 'Fulfilled' tags are durations whose start lies
    364 or 91 days before the end, so the annual-duration filter matters.
    """
    col = F.col
    lines = _lines(spark, sf_dir)
    lines = lines.withColumns({"fy": F.year("o_orderdate"), "fm": F.month("o_orderdate")})
    fkey = ["l_suppkey", "fy", "fm"]
    filing = lines.groupBy(*fkey).agg(
        F.max("o_orderdate").cast("date").alias("end"),
        F.max("l_shipdate").cast("date").alias("filed"),
        F.min("o_orderpriority").alias("prio"),
        F.sum(col("o_totalprice") / 7.0).alias("assets"))
    form = (F.when(col("prio") == "1-URGENT", "10-K").when(col("prio") == "2-HIGH", "10-K/A")
            .when(col("prio") == "3-MEDIUM", "20-F").when(col("prio") == "4-NOT SPECIFIED", "10-Q")
            .otherwise("10-KT"))
    filing = filing.withColumn("form", form)
    tag = F.concat(
        F.when(col("l_returnflag") == "A", "Accepted").when(col("l_returnflag") == "N", "New").otherwise("Returned"),
        F.when(col("l_linestatus") == "F", "FulfilledRevenue").otherwise("OpenLiabilities"))
    per_tag = lines.groupBy(*fkey, tag.alias("tag"), col("l_linestatus")).agg(
        F.sum(col("l_extendedprice") / 7.0).alias("v"),
        F.max((col("l_quantity") == 50).cast("int")).alias("hole"),
        F.max("l_discount").alias("maxd"))
    tv = per_tag.join(filing, fkey).select(
        F.concat(F.lit("S"), col("l_suppkey").cast("string")).alias("cik"),
        F.lit("us-gaap").alias("ns"), "tag", F.lit("USD").alias("unit"),
        F.when(col("l_linestatus") == "F",
               F.date_sub(col("end"), F.when(col("maxd") >= 0.05, F.lit(364)).otherwise(F.lit(91)))).alias("start"),
        "end", F.when(col("hole") == 1, F.lit(None).cast("double")).otherwise(col("v")).alias("val"),
        col("fy").cast("int").alias("fy"), F.lit("FY").alias("fp"), "form", "filed")
    anchor = filing.select(
        F.concat(F.lit("S"), col("l_suppkey").cast("string")).alias("cik"),
        F.lit("us-gaap").alias("ns"), F.lit(STANDIN_ANCHOR).alias("tag"), F.lit("USD").alias("unit"),
        F.lit(None).cast("date").alias("start"), "end", col("assets").alias("val"),
        col("fy").cast("int").alias("fy"), F.lit("FY").alias("fp"), "form", "filed")
    return tv.unionByName(anchor)


def mixed_namespace_facts(spark: SparkSession, sf_dir: str, by_company: bool = False) -> DataFrame:
    """``raw_facts`` under several namespaces, by the supplier's account balance and the
    filing's form: overdrawn suppliers file under ifrs-full only, the next under dei
    (no choice), others under us-gaap but for 20-F filings. ``by_company`` deals the facts
    by company first, for what puts together whole companies."""
    s = table(spark, sf_dir, "supplier").select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("cik"), "s_acctbal")
    ns = (F.when(F.col("s_acctbal") < 0, "ifrs-full").when(F.col("s_acctbal") < 1000, "dei")
          .when(F.col("form") == "20-F", "ifrs-full").otherwise("us-gaap"))
    facts = raw_facts(spark, sf_dir)
    return (facts.repartition("cik") if by_company else facts).join(s, "cik").withColumn("ns", ns).drop("s_acctbal")


def directory_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Directory JSON texts of at most 1000 entries, by nation and range of supplier keys:
    {"<supplier key>": {cik_str, ticker, title}}."""
    s = table(spark, sf_dir, "supplier")
    entry = F.struct(F.col("s_suppkey").cast("long").alias("cik_str"), F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("ticker"),
                     F.col("s_name").alias("title"))
    return s.groupBy("s_nationkey", F.floor(F.col("s_suppkey") / 1000)).agg(F.to_json(F.map_from_entries(F.collect_list(
        F.struct(F.col("s_suppkey").cast("string"), entry)))).alias("doc"))


def facts_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(cik, doc): every company's facts of ``mixed_namespace_facts`` as one nested JSON
    text, as the filing service hands them out."""
    f = mixed_namespace_facts(spark, sf_dir, by_company=True)
    rec = F.struct(F.col("start").cast("string").alias("start"), F.col("end").cast("string").alias("end"), "val", "fy", "fp", "form",
                   F.col("filed").cast("string").alias("filed"))
    unit = f.groupBy("cik", "ns", "tag", "unit").agg(F.collect_list(rec).alias("recs"))
    tag = unit.groupBy("cik", "ns", "tag").agg(F.map_from_entries(F.collect_list(F.struct("unit", "recs"))).alias("units"))
    ns = tag.groupBy("cik", "ns").agg(F.map_from_entries(F.collect_list(F.struct("tag", F.struct("units")))).alias("tags"))
    return ns.groupBy("cik").agg(F.to_json(F.struct(F.map_from_entries(F.collect_list(F.struct("ns", "tags"))).alias("facts"))).alias("doc"))


# Supplier-year filings in the real tag taxonomy, so the complete stage-1 job
# (build_panel) runs over whole driver tables. A line's tag is chosen by
# (returnflag, linestatus, quantity band); the 18 combinations map, in order, to
# these (tag, is_duration, sign) entries.
TAXONOMY_TAGS = [
    ("Revenues", True, 1.0),
    ("CostOfGoodsAndServicesSold", True, 1.0),
    ("SellingGeneralAndAdministrativeExpense", True, 1.0),
    ("OperatingIncomeLoss", True, 1.0),
    ("IncomeLossFromContinuingOperationsBeforeIncomeTaxesExtraordinaryItemsNoncontrollingInterest", True, 1.0),
    ("IncomeTaxExpenseBenefit", True, 1.0),
    ("NetIncomeLoss", True, 1.0),
    ("StockholdersEquity", False, 1.0),
    ("AssetsCurrent", False, 1.0),
    ("InventoryNet", False, 1.0),
    ("LiabilitiesCurrent", False, 1.0),
    ("NetCashProvidedByUsedInOperatingActivities", True, 1.0),
    ("NetCashProvidedByUsedInInvestingActivities", True, -1.0),
    ("PaymentsToAcquirePropertyPlantAndEquipment", True, 1.0),
    ("NetCashProvidedByUsedInFinancingActivities", True, -1.0),
    ("CashCashEquivalentsRestrictedCashAndRestrictedCashEquivalents", False, 1.0),
    ("PaymentsOfDividendsCommonStock", True, 1.0),
    ("OtherAssetsCurrent", False, 1.0),
]


def taxonomy_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts (cik, ns, tag, unit, start, end, val, fy, fp, form, filed): one annual
    filing per supplier-year (end = last order date, filed = last ship date,
    form from the most urgent order priority), values = line sums per tag,
    ``Assets`` anchor = order totals, ``dei`` share count = quantities."""
    col = F.col
    rf = F.when(col("l_returnflag") == "A", 0).when(col("l_returnflag") == "N", 1).otherwise(2)
    ls = F.when(col("l_linestatus") == "F", 0).otherwise(1)
    qb = F.when(col("l_quantity") <= 17, 0).when(col("l_quantity") <= 34, 1).otherwise(2)
    # tables are read and joined once: the lines meet as in supplier_year_panel, and all sums
    # of a company year, one per tag among them, lie in one row
    lines = _lines(spark, sf_dir).select(
        "l_suppkey", F.year("o_orderdate").alias("fy"), F.pmod("l_orderkey", F.lit(SPREAD)).cast("byte").alias("part"),
        ((rf * 2 + ls) * 3 + qb).alias("combo"), "l_quantity", "l_extendedprice", "l_shipdate",
        "o_totalprice", "o_orderdate", "o_orderpriority").repartition("l_suppkey", "fy", "part")
    v, combos = col("l_extendedprice") / 7.0, range(len(TAXONOMY_TAGS))
    filing = lines.groupBy("l_suppkey", "fy").agg(
        F.max("o_orderdate").cast("date").alias("end"), F.max("l_shipdate").cast("date").alias("filed"),
        F.min("o_orderpriority").alias("prio"), F.sum(col("o_totalprice") / 7.0).alias("assets"),
        F.sum("l_quantity").alias("shares"), F.bit_or(F.expr("shiftleft(1, combo)")).alias("seen"),
        *[_sum_if(v, col("combo") == i).alias(f"v{i}") for i in combos])
    form = (F.when(col("prio") == "1-URGENT", "10-K").when(col("prio") == "2-HIGH", "10-K/A")
            .when(col("prio") == "3-MEDIUM", "20-F").when(col("prio") == "4-NOT SPECIFIED", "10-Q")
            .otherwise("10-KT"))
    named = col("l_suppkey").isNotNull() & col("fy").isNotNull()     # else no values but the filing's own

    def fact(there, ns, tag, unit, val, duration=False):
        start = F.date_sub(col("end"), 364) if duration else F.lit(None).cast("date")
        return F.struct(there.alias("there"), F.lit(ns).alias("ns"), F.lit(tag).alias("tag"), F.lit(unit).alias("unit"),
                        start.alias("start"), val.alias("val"))

    facts = [fact(named & (col("seen").bitwiseAND(1 << i) != 0), "us-gaap", tag, "USD", col(f"v{i}") * sign, duration)
             for i, (tag, duration, sign) in enumerate(TAXONOMY_TAGS)]
    facts += [fact(F.lit(True), "us-gaap", "Assets", "USD", col("assets")),
              fact(F.lit(True), "dei", "EntityCommonStockSharesOutstanding", "shares", col("shares").cast("double"))]
    return filing.select("*", F.explode(F.array(*facts)).alias("f")).filter("f.there").select(
        F.lpad(col("l_suppkey").cast("string"), 10, "0").alias("cik"), "f.ns", "f.tag", "f.unit", "f.start", "end", "f.val",
        col("fy").cast("int").alias("fy"), F.lit("FY").alias("fp"), form.alias("form"), "filed")


def taxonomy_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = suppliers(spark, sf_dir)
    return s.select(F.lpad(F.col("s_suppkey").cast("string"), 10, "0").alias("cik"), "ticker", "name", "industry")


def daily_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trading days per company = its ship dates; close = mean line price
    (scaled so that means of a few days do not lie on a rounding boundary)."""
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_shipdate", "l_extendedprice", "l_tax")
    g = li.groupBy("l_suppkey", F.col("l_shipdate").cast("date").alias("d")).agg(
        F.avg(F.col("l_extendedprice") / 7.0 / 103.27).alias("close_adj"),
        F.avg(F.col("l_extendedprice") / 7.0 * (1 + F.col("l_tax")) / 103.27).alias("close_unadj"))
    return g.select(F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("ticker"), "d",
                    "close_adj", "close_unadj")
