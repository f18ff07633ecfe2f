"""Stage 1 (and the recovery pass): long filings facts -> annual company panel.

One DataFrame plan over *all* companies (no per-company loop):

    facts -> namespace choice (F4) -> eligibility (F6) -> template rows
          -> annual filters (F1-F3) -> keep latest (F5)
          -> ranked fallback per concept (K1-K3) + special rules (K4-K9)
          -> required-concept check (K10) -> errors as data (Q8)
          -> pivot -> derived items (D*) -> prices (J7) -> valuation (R*)

Per-company state (available tags, provenance, flags) is a small grouped
table joined back by cik; concept lists are fixed constants (broadcast).
``mode='relaxed'`` is the recovery variant: share counts and the pre-tax
back-calculation align on fiscal year only and tolerate a missing component.

Errors are data: every rule that can fail a company is a condition over grouped flags,
and the first that holds, in processing order, is the company's logged error. That goes
for missing tags (K10) as for the rules that fail on the shape of the data: keys that are
not one to one (J1), period ends or years that repeat where values are aligned on them,
and a zero denominator among items put together from several tags (mixed items).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import (EPS_CALCULATED, MSG_BAD_FACTS, MSG_BAD_PAYLOAD, MSG_DUPLICATE_LABELS, MSG_MERGE_LEFT, MSG_MERGE_RIGHT,
                         MSG_NO_DATA_COLS, MSG_NO_USED_TAG, MSG_NONE_EMPTY, MSG_NONE_SUBSCRIPT, MSG_NOT_JSON, MSG_SKIP,
                         MSG_TAG_MISSING, MSG_ZERO_DIVISION, RECOVERY_PATTERNS, SGA_EXEMPT_TICKERS,
                         ADDITIVE_TAG, ADDITIVE_TRIGGER, ALLOW_MISSING, ANCHOR_NAME, ANCHOR_TAG,
                         CURR_LIABILITY_INDUSTRIES, CURR_LIABILITY_TAGS, CURRASSET_SUBTRACT_TAGS,
                         EXPECTED_RECORDS, FALLBACKS, LINE_ITEMS, NONOPERATING_TAGS, SHARE_FALLBACKS,
                         STUDY_END, STUDY_START)
from ..functions.numeric import ieee_div
from ..operators import filters as fl
from ..operators.derive import derive_line_items, order_panel
from ..operators.resolve import TEMPLATE_KEYS, concept_table, provenance, resolve_concepts
from ..operators.valuation import valuation_v1
from ..session import cut

SHARES, EPS, SGA = "shares#", "eps", "expense_general/admin"
CURRASSET, RECURRENT, CURR_LIAB = "currasset", "recurrent_profit", "curr_liabilities"
EPS_TAG = "EarningsPerShareBasic"
SGA_TAG = "SellingGeneralAndAdministrativeExpense"
CURRASSET_TAG = "AssetsCurrent"
PRETAX_TAG = "IncomeLossFromContinuingOperationsBeforeIncomeTaxesExtraordinaryItemsNoncontrollingInterest"
EPS_CALC = EPS_CALCULATED
HELPERS = {"ga": FALLBACKS["ga_fallbacks"], "sm": FALLBACKS["sm_fallbacks"],
           "ppe": [CURRASSET_SUBTRACT_TAGS[0]], "gw": [CURRASSET_SUBTRACT_TAGS[1]],
           "emi": [CURRASSET_SUBTRACT_TAGS[2]], "nonop1": [NONOPERATING_TAGS[0]],
           "nonop2": [NONOPERATING_TAGS[1]]}


#: Divisions of the valuation that meet raw line items: (numerator, denominator, the resolved
#: concepts behind them).
DIVISIONS = [
    ("net_income", SHARES, ("net_income", SHARES)), ("equity", "asset", ("equity",)), ("equity", SHARES, ("equity", SHARES)),
    ("operating_cash", CURR_LIAB, ("operating_cash", CURR_LIAB)), ("operating_cash", "asset", ("operating_cash",)),
    ("operating_cash", SHARES, ("operating_cash", SHARES)), ("operating_cash", "profit", ("operating_cash", RECURRENT, "tax")),
    ("net_income", "asset", ("net_income",)), ("net_income", "equity", ("net_income", "equity")),
    ("lt_asset", "equity", (CURRASSET, "equity")), ("cash", CURR_LIAB, (CURRASSET, "inventory", "other_currasset", CURR_LIAB)),
    ("asset", SHARES, (SHARES,)),
]


def bq(c):
    return F.col(f"`{c}`")


def _main_concepts():
    """concept -> tags (rank order), concept -> kind ('fallback' | 'single'), additive."""
    tags, kind = {}, {}
    for tag, name in LINE_ITEMS:
        if name == SHARES:
            continue
        lst = list(FALLBACKS.get(tag, [tag]))
        tags[name], kind[name] = lst, ("fallback" if tag in FALLBACKS else "single")
    additive = {n: ADDITIVE_TAG for n, lst in tags.items() if ADDITIVE_TRIGGER in lst}
    for t in CURR_LIABILITY_TAGS:
        tags[f"liab:{t}"], kind[f"liab:{t}"] = [t], "single"
    return tags, kind, additive


@dataclass
class PanelBuild:
    panel: DataFrame        # annual_financials_full rows of successful companies
    log: DataFrame          # one row per company: status, error, namespace
    failed_tags: DataFrame  # S10 inventory of failed companies
    suggestions: DataFrame  # K11 for "No X Tag Found" errors


def build_panel(facts: DataFrame, companies: DataFrame, prices: DataFrame | None = None,
                mode: str = "strict", start: int = STUDY_START, end: int = STUDY_END,
                expected: int = EXPECTED_RECORDS, run_ts: str | None = None) -> PanelBuild:
    spark = facts.sparkSession
    facts_all = facts
    relaxed = mode == "relaxed"
    main, kind, additive = _main_concepts()
    helper_tags = sorted({t for v in HELPERS.values() for t in v})
    relevant = sorted({ANCHOR_TAG} | {t for v in main.values() for t in v} | set(helper_tags)
                      | {ADDITIVE_TAG})

    # ---- stage cut: only the tags any rule reads, parsed once -------------------------
    share_cond = None
    for ns_, t in SHARE_FALLBACKS:
        c_ = (F.col("ns") == ns_) & (F.col("tag") == t)
        share_cond = c_ if share_cond is None else share_cond | c_
    facts = cut(facts.filter(F.col("tag").isin(*relevant) | share_cond))

    # ---- namespace, eligibility, template ----------------------------------------------
    ns = fl.namespace_choice(facts, ANCHOR_TAG)
    f_ns = facts.join(ns, ["cik", "ns"]).filter(F.col("tag").isin(*relevant))
    elig = fl.eligibility(f_ns, ANCHOR_TAG, start, end, expected)
    ok = elig.filter("eligible").select("cik")
    anchor = fl.keep_latest(f_ns.filter((F.col("tag") == ANCHOR_TAG) & fl.annual_form()
                                        & fl.study_window("fy", start)))
    template = anchor.join(ok, "cik", "left_semi").select("cik", *TEMPLATE_KEYS, F.col("val").alias(ANCHOR_NAME))

    # ---- per-company tag presence / availability ----------------------------------------
    present = f_ns.groupBy("cik").agg(F.collect_set("tag").alias("present"))
    max_fy = f_ns.groupBy("cik", "tag").agg(F.max("fy").alias("mfy"))
    eps_recent = max_fy.filter((F.col("tag") == EPS_TAG) & (F.col("mfy") >= start)).select(
        "cik", F.lit(True).alias("eps_recent"))
    annual = fl.annual_facts(f_ns.join(ok, "cik", "left_semi"), start)
    latest = fl.keep_latest(annual)
    avail = latest.filter(F.col("val").isNotNull()).groupBy("cik").agg(F.collect_set("tag").alias("avail"))

    # ---- J1: where keys repeat ---------------------------------------------------------------
    # rows, years and period ends of each company's template and of its helper tags: partial
    # aggregates over the distinct rows that the joins below are keyed by
    t_keys = template.groupBy("cik").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("fy").alias("y"), F.countDistinct("end").alias("e")) \
        .select("cik", (F.col("n") > F.col("y")).alias("t_years"), (F.col("n") > F.col("e")).alias("t_ends"))
    h_keys = latest.filter(F.col("tag").isin(*helper_tags)).groupBy("cik", "tag").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("fy").alias("y"), F.countDistinct("end").alias("e")) \
        .groupBy("cik").agg(F.collect_set(F.when(F.col("n") > F.col("y"), F.col("tag"))).alias("h_years"),
                            F.collect_set(F.when(F.col("n") > F.col("e"), F.col("tag"))).alias("h_ends"))

    # ---- K1-K3 main concepts on the 4-key template ------------------------------------
    ct = concept_table(spark, main, additive)
    resolved = resolve_concepts(template, latest, ct)
    prov = provenance(latest, resolved, ct)
    names = list(main)
    wide = (resolved.groupBy("cik", *TEMPLATE_KEYS).pivot("concept", names).agg(F.first("val")))

    # ---- helpers aligned on fiscal year (K6-K8) -------------------------------------------
    latest_fy = fl.keep_latest(annual, keys=("cik", "ns", "tag", "unit", "fy"))
    hct = concept_table(spark, HELPERS)
    tmpl_fy = template.select("cik", "fy").distinct()
    h_res = resolve_concepts(tmpl_fy, latest_fy, hct, keys=["fy"])
    h_prov = provenance(latest_fy, h_res, hct, keys=["fy"])
    h_wide = h_res.groupBy("cik", "fy").pivot("concept", list(HELPERS)).agg(F.first("val"))

    # ---- K4 share counts: namespace pairs across all namespaces ----------------------------
    pairs = [(ns_, t, i) for i, (ns_, t) in enumerate(SHARE_FALLBACKS)]
    label = F.concat(F.lit("["), F.col("ns"), F.lit("] "), F.col("tag"))
    cond = None
    for ns_, t, _ in pairs:
        c = (F.col("ns") == ns_) & (F.col("tag") == t)
        cond = c if cond is None else cond | c
    sf = (facts.filter(cond).join(ok, "cik", "left_semi")
          .withColumn("tag", label)
          .withColumn("fy", F.coalesce(F.col("fy"), F.year("end")))
          .withColumn("fp", F.coalesce(F.col("fp"), F.lit("FY"))))
    share_labels = [f"[{ns_}] {t}" for ns_, t, _ in pairs]
    sct = concept_table(spark, {SHARES: share_labels})
    s_present = sf.select("cik", "tag").distinct().join(F.broadcast(sct), "tag").select("cik", "concept", "tag", "rank")
    s_form = sf.filter(fl.annual_form())
    s_last = (s_form.groupBy("cik").agg(F.max("fy").alias("s_mfy")))
    s_top = (s_form.join(F.broadcast(sct), "tag").join(s_last, "cik").filter(F.col("fy") == F.col("s_mfy"))
             .groupBy("cik", "rank").agg(F.max_by("val", F.struct("end", "filed")).alias("v")))
    s_lv = s_top.groupBy("cik").agg(F.min_by("v", F.col("rank")).alias("s_lv"))
    s_vals = s_form.filter(fl.study_window("fy", start))
    if relaxed:
        s_latest = fl.keep_latest(s_vals, keys=("cik", "tag", "fy"))
        s_res = resolve_concepts(template.select("cik", "fy").distinct(), s_latest, sct, keys=["fy"])
        s_wide = s_res.select("cik", "fy", F.col("val").alias("_shares"))
        s_join = ["cik", "fy"]
    else:
        s_latest = fl.keep_latest(s_vals, keys=("cik", "tag", "fy", "fp"))
        s_res = resolve_concepts(template, s_latest, sct)
        s_wide = s_res.select("cik", *TEMPLATE_KEYS, F.col("val").alias("_shares"))
        s_join = ["cik", *TEMPLATE_KEYS]
    s_prov = provenance(s_latest, s_res, sct, available=s_present)

    # ---- company-level table -------------------------------------------------------------
    comp = (companies.join(ns, "cik", "left").join(elig, "cik", "left").join(present, "cik", "left")
            .join(avail, "cik", "left").join(eps_recent, "cik", "left").join(s_last, "cik", "left")
            .join(s_lv, "cik", "left").join(t_keys, "cik", "left").join(h_keys, "cik", "left"))
    comp = comp.withColumns({
        "t_years": F.coalesce("t_years", F.lit(False)), "t_ends": F.coalesce("t_ends", F.lit(False)),
        "h_years": F.coalesce("h_years", F.array().cast("array<string>")),
        "h_ends": F.coalesce("h_ends", F.array().cast("array<string>")),
        "present": F.coalesce("present", F.array().cast("array<string>")),
        "avail": F.coalesce("avail", F.array().cast("array<string>")),
        "eps_recent": F.coalesce("eps_recent", F.lit(False))})
    has = lambda arr, tags: F.exists(F.col(arr), lambda x: x.isin(*tags))
    among = lambda arr, tags: F.filter(F.col(arr), lambda x: x.isin(*tags))
    comp = comp.withColumns({
        "sga_present": has("present", [SGA_TAG]),
        "currasset_present": has("present", [CURRASSET_TAG]),
        "sub_present": has("present", CURRASSET_SUBTRACT_TAGS),
        "pretax_avail": has("avail", FALLBACKS[PRETAX_TAG]),
        "n1_present": has("present", [NONOPERATING_TAGS[0]]),
        "n2_present": has("present", [NONOPERATING_TAGS[1]]),
        "n1_avail": has("avail", [NONOPERATING_TAGS[0]]),
        "n2_avail": has("avail", [NONOPERATING_TAGS[1]]),
        "liab_present": has("present", CURR_LIABILITY_TAGS),
        "liab_industry": F.col("industry").isin(*CURR_LIABILITY_INDUSTRIES),
    })
    # share presence counts any (ns, tag) pair, even without annual rows
    sp = s_present.groupBy("cik").agg(F.count(F.lit(1)).alias("_np"))
    comp = comp.join(sp, "cik", "left").withColumn("n_shares", F.coalesce(F.col("_np"), F.lit(0))) \
        .withColumn("has_shares", F.col("n_shares") > 0).drop("_np")
    # Share tags exist but none reaches the study window (or none passes the
    # form filter) -> the latest value (0 when there is none) fills every year
    comp = comp.withColumns({
        "share_broadcast": F.col("has_shares") & (F.col("s_mfy").isNull() | (F.col("s_mfy") < start)),
        "s_lv": F.coalesce(F.col("s_lv"), F.lit(0.0))})

    # ---- K10 / Q8: first failing concept in processing order -> error text --------------
    checks = []
    for tag, name in LINE_ITEMS:
        if name == SHARES:
            checks.append((~F.col("has_shares"), F.lit(MSG_TAG_MISSING % SHARES)))
            if relaxed:     # several tags meet the template by year
                checks.append((~F.col("share_broadcast") & (F.col("n_shares") > 1) & F.col("t_years"), F.lit(MSG_MERGE_LEFT)))
            continue
        if name == SGA:     # K6: no total, and neither of its parts has a value
            none = ~F.col("sga_present") & ~has("avail", HELPERS["ga"] + HELPERS["sm"]) & ~F.col("ticker").isin(*SGA_EXEMPT_TICKERS)
            checks.append((none, F.lit(MSG_TAG_MISSING % SGA_TAG if relaxed else MSG_NO_USED_TAG)))
            # put together by year: the years of the part that gives the row keys (G&A if any)
            # may not repeat; a part from several tags lies on the template's rows
            ga, sm = among("avail", HELPERS["ga"]), among("avail", HELPERS["sm"])
            base = F.when(F.size(ga) > 0, ga).otherwise(sm)
            twice = F.when(F.size(base) > 1, F.col("t_years")).otherwise(F.arrays_overlap(base, F.col("h_years")))
            checks.append((~F.col("sga_present") & (F.size(base) > 0) & twice, F.lit(MSG_MERGE_RIGHT)))
            continue
        if name == EPS or tag in ALLOW_MISSING:
            continue
        if name == CURRASSET:
            checks.append((~F.col("currasset_present") & ~F.col("sub_present"),
                           F.lit(MSG_TAG_MISSING % CURRASSET_TAG)))
            checks.append((~F.col("currasset_present") & F.col("t_years"), F.lit(MSG_MERGE_RIGHT)))
            continue
        if name == RECURRENT:
            no_pretax = ~F.col("pretax_avail")
            if relaxed:
                fail = no_pretax & ~F.col("n1_avail") & ~F.col("n2_avail")
                checks.append((fail, F.lit(MSG_TAG_MISSING % PRETAX_TAG)))
            else:
                checks.append((no_pretax & ~F.col("n1_present"), F.lit(MSG_NONE_EMPTY)))
                checks.append((no_pretax & ~F.col("n2_present") & F.col("n1_avail"), F.lit(MSG_NONE_SUBSCRIPT)))
                checks.append((no_pretax & ~F.col("n2_present"), F.lit(MSG_NONE_EMPTY)))
                checks.append((no_pretax & ~F.col("n1_avail") & ~F.col("n2_avail"),
                               F.lit(MSG_TAG_MISSING % PRETAX_TAG)))
            # the parts are aligned on period ends (relaxed: on years), which may not repeat
            again = F.exists(F.col("h_years" if relaxed else "h_ends"), lambda t: t.isin(*NONOPERATING_TAGS))
            checks.append((no_pretax & again, F.lit(MSG_DUPLICATE_LABELS)))
            continue
        if kind[name] == "fallback":
            checks.append((~has("avail", main[name]), F.lit(MSG_TAG_MISSING % tag)))
        else:
            checks.append((~has("present", [tag]), F.lit(MSG_TAG_MISSING % tag)))
    # K9: a bank or insurer none of whose liability components is reported
    checks.append((F.col("liab_industry") & ~F.col("liab_present"), F.lit(MSG_NO_DATA_COLS)))
    checks.append((F.col("liab_industry") & F.col("t_ends"), F.lit(MSG_DUPLICATE_LABELS)))
    err = None
    for cond, msg in checks:
        err = F.when(cond, msg) if err is None else err.when(cond, msg)
    skip = F.format_string(MSG_SKIP, F.col("cik"), F.col("ticker"), F.col("name"))
    # F8: an unreadable metadata or facts payload fails the company before any tag rule
    def flag(c):
        return F.coalesce(F.col(c), F.lit(False)) if c in comp.columns else F.lit(False)

    # a payload that is no JSON at all fails in the parser, which the recovery run never reaches
    first = F.lit(None).cast("string") if relaxed else F.when(flag("payload_not_json") | (flag("facts_not_json") & ~flag("bad_payload")),
                                                              F.lit(MSG_NOT_JSON))
    error = (F.when(first.isNotNull(), first).when(flag("bad_payload"), F.lit(MSG_BAD_PAYLOAD))
             .when(flag("bad_facts"), F.lit(MSG_BAD_FACTS))
             .when(F.col("ns").isNull(), F.lit(MSG_TAG_MISSING % ANCHOR_NAME))
             .when(~F.coalesce(F.col("eligible"), F.lit(False)), skip)
             .otherwise(err.otherwise(F.lit(None))))
    comp = comp.withColumn("error", error).withColumn(
        "status", F.when(F.col("error").isNull(), F.lit("Success")).otherwise(F.lit("Fail")))

    # ---- provenance text per company (tag_history) ----------------------------------------
    pm = prov.unionByName(h_prov).unionByName(s_prov).groupBy("cik").agg(
        F.map_from_entries(F.collect_list(F.struct("concept", "used_tag"))).alias("pm"))
    comp = comp.join(pm, "cik", "left").withColumns({
        "ga_avail": F.col("pm")["ga"].isNotNull(), "sm_avail": F.col("pm")["sm"].isNotNull()})

    def used(concept):
        return F.coalesce(F.col("pm")[concept], F.lit("none"))

    hist_parts = []
    for tag, name in LINE_ITEMS:
        if name == SHARES:
            u = F.when(F.col("share_broadcast"), F.lit("")).otherwise(used(SHARES))
        elif name == EPS:
            u = F.when(F.col("eps_recent"), used(EPS)).otherwise(F.lit(EPS_CALC))
        elif name == SGA:
            u = (F.when(F.col("sga_present"), F.lit(SGA_TAG))
                 .when(F.col("pm")["ga"].isNotNull() | F.col("pm")["sm"].isNotNull(),
                       F.concat(F.lit("ga: "), used("ga"), F.lit(" sm: "), used("sm")))
                 .otherwise(F.lit("none")))
        elif name == CURRASSET:
            subs = [F.when(has("present", [t]), F.lit(t)) for t in CURRASSET_SUBTRACT_TAGS]
            u = F.when(F.col("currasset_present"), F.lit(CURRASSET_TAG)).otherwise(
                F.concat_ws(" + ", F.lit(ANCHOR_TAG), *subs))
        elif name == RECURRENT:
            n1 = F.when(F.col("n1_avail"), F.lit(NONOPERATING_TAGS[0]))
            n2 = F.when(F.col("n2_avail"), F.lit(NONOPERATING_TAGS[1]))
            u = F.when(F.col("pretax_avail"), used(RECURRENT)).otherwise(F.concat_ws(" + ", n1, n2))
        elif kind.get(name) == "single":
            u = F.when(has("present", [tag]), F.lit(tag)).otherwise(F.lit("none"))
        else:
            u = used(name)
        hist_parts.append(F.concat(F.lit(f"{name} = "), u))
    comp = cut(comp.withColumn("tag_history", F.concat_ws("; ", *hist_parts)))

    # ---- assemble rows of successful companies -------------------------------------------
    good = comp.filter(F.col("status") == "Success")
    rows = (template.join(good.select("cik", "ticker", "name", "industry", "eps_recent", "share_broadcast", "s_lv",
                                      "sga_present", "currasset_present", "pretax_avail", "liab_present",
                                      "ga_avail", "sm_avail", "avail", "n_shares",
                                      "liab_industry", "tag_history"), "cik")
            .join(wide, ["cik", *TEMPLATE_KEYS], "left")
            .join(h_wide, ["cik", "fy"], "left")
            .join(s_wide, s_join, "left"))
    for n in names + list(HELPERS):
        if n not in rows.columns:
            rows = rows.withColumn(n, F.lit(None).cast("double"))
    col = F.col
    zero = F.lit(0.0)
    liab_cols = [bq(f"liab:{t}") for t in CURR_LIABILITY_TAGS]
    rows = rows.withColumns({
        SHARES: F.when(col("share_broadcast"), col("s_lv")).otherwise(col("_shares")),
        # base rows come from G&A when the company has it, else from S&M
        SGA: F.when(col("sga_present"), bq(SGA)).when(
            col("ga_avail"), F.when(col("ga").isNotNull(), col("ga") + F.coalesce(col("sm"), zero))).when(
            col("sm_avail"), F.when(col("sm").isNotNull(), F.coalesce(col("ga"), zero) + col("sm"))),
        CURRASSET: F.when(col("currasset_present"), bq(CURRASSET)).otherwise(
            col(ANCHOR_NAME) - F.coalesce(col("ppe"), zero) - F.coalesce(col("gw"), zero)
            - F.coalesce(col("emi"), zero)),
        RECURRENT: F.when(col("pretax_avail"), bq(RECURRENT)).otherwise(
            col("operating_income") + F.coalesce(col("nonop1"), zero) + F.coalesce(col("nonop2"), zero)),
    })
    rows = rows.withColumn(CURR_LIAB, F.when(col("liab_industry") & col("liab_present"),
                                             sum((F.coalesce(c_, zero) for c_ in liab_cols), zero))
                           .otherwise(bq(CURR_LIAB)))
    rows = rows.withColumn(EPS, F.when(col("eps_recent"), bq(EPS)).otherwise(ieee_div(col("net_income"), bq(SHARES))))
    # mixed items: put together from several tags, or from several items
    mixed = {c: F.size(among("avail", main[c])) > 1 for c in {x for _, _, xs in DIVISIONS for x in xs} if c in main}
    mixed |= {SHARES: (F.col("n_shares") > 1) & ~F.col("share_broadcast"), CURRASSET: ~F.col("currasset_present"),
              RECURRENT: mixed[RECURRENT] | ~F.col("pretax_avail")}
    zero_by = [(bq(n).isNotNull() & (bq(d) == 0) & reduce(lambda a, x: a | mixed[x], xs, F.lit(False))) for n, d, xs in DIVISIONS]
    whole = derive_line_items(rows)
    panel = cut(order_panel(whole.withColumn("zero_division", reduce(lambda a, z: a | z, zero_by)), extra_last=["tag_history", "cik", "zero_division"]))
    # a zero denominator among mixed items fails the company after its rows are put together
    zeros = panel.groupBy("cik").agg(F.max("zero_division").alias("zero_division")).filter("zero_division")
    comp = cut(comp.join(zeros, "cik", "left").withColumns({
        "error": F.when(F.col("zero_division"), F.lit(MSG_ZERO_DIVISION)).otherwise(F.col("error")),
        "status": F.when(F.col("zero_division"), F.lit("Fail")).otherwise(F.col("status"))}))
    panel = panel.join(zeros.select("cik"), "cik", "left_anti").drop("cik", "zero_division")
    if prices is not None:
        from ..operators.asof import attach_prices
        panel = attach_prices(panel, prices)
    else:
        panel = panel.withColumns({"stock_price": F.lit(None).cast("double"),
                                   "stock_price_unadjusted": F.lit(None).cast("double")})
    panel = valuation_v1(panel)
    cols = [c for c in panel.columns if c != "tag_history"] + ["tag_history"]
    panel = panel.select(*[bq(c) for c in cols])

    ts = F.lit(run_ts) if run_ts else F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")
    log = comp.select(*([c for c in ("source_index",) if c in comp.columns]),
                      ts.alias("timestamp"), "cik", "ticker", F.col("name").alias("company_name"),
                      F.col("ns").alias("namespace"), "status", F.coalesce("error", F.lit("")).alias("error"))

    failed = comp.filter(F.col("status") == "Fail").select("cik", "error")
    from ..operators.resolve import tag_inventory, tag_suggestions
    from ..constants import SUGGEST_IGNORE_WORDS
    inv = tag_inventory(facts_all, ns)
    failed_tags = failed.join(inv, "cik", "left")
    missing = failed.select("cik", F.regexp_extract("error", r"^No (.+) Tag Found$", 1).alias("missing_tag")) \
        .filter(F.col("missing_tag") != "")
    sugg = tag_suggestions(missing, inv, SUGGEST_IGNORE_WORDS)
    return PanelBuild(panel, log, failed_tags, sugg)


def retry_set(log: DataFrame, pattern: str | list[str] = tuple(RECOVERY_PATTERNS),
              error_col: str = "error_after_recovery1", status_col: str = "status_after_recovery1") -> DataFrame:
    """Companies whose last recorded attempt failed with an error like one of the
    patterns, by default the five classes a recovery run takes up (projected and
    predicated scan; the LIKEs and the equality push down to Parquet)."""
    patterns = [pattern] if isinstance(pattern, str) else pattern
    like = reduce(lambda a, p: a | F.col(error_col).like(p), patterns, F.lit(False))
    return log.filter(like & (F.col(status_col) == "Fail")).select(
        F.lpad(F.col("cik").cast("string"), 10, "0").alias("cik")).distinct()


def recover(facts: DataFrame, companies: DataFrame, log: DataFrame, retry: DataFrame,
            prices: DataFrame | None = None, suffix: str = "2", **kw):
    """Q9: rebuild the retry set with relaxed rules; returns (new panel rows,
    log with status/error_after_recovery{suffix} merged by cik)."""
    f = facts.join(retry, "cik", "left_semi")
    c = companies.join(retry, "cik", "left_semi")
    b = build_panel(f, c, prices, mode="relaxed", **kw)
    upd = b.log.select("cik", F.col("status").alias(f"status_after_recovery{suffix}"),
                       F.col("error").alias(f"error_after_recovery{suffix}"))
    keep = [c_ for c_ in log.columns if c_ not in (f"status_after_recovery{suffix}", f"error_after_recovery{suffix}")]
    old_s = F.col(f"_old_s") if f"status_after_recovery{suffix}" in log.columns else F.lit(None).cast("string")
    merged = log.select(*keep, *( [F.col(f"status_after_recovery{suffix}").alias("_old_s"),
                                   F.col(f"error_after_recovery{suffix}").alias("_old_e")]
                                 if f"status_after_recovery{suffix}" in log.columns else []))
    merged = merged.join(upd, "cik", "left")
    if f"status_after_recovery{suffix}" in log.columns:
        merged = merged.withColumn(f"status_after_recovery{suffix}",
                                   F.coalesce(F.col(f"status_after_recovery{suffix}"), old_s)) \
            .withColumn(f"error_after_recovery{suffix}",
                        F.coalesce(F.col(f"error_after_recovery{suffix}"), F.col("_old_e"))) \
            .drop("_old_s", "_old_e")
    return b.panel, merged
