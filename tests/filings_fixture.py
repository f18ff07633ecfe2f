"""Hand-made golden filings (company facts JSON, metadata, directory, prices)."""

import json
import os
from datetime import date, timedelta

YEARS = list(range(2019, 2026))


def rec(fy, end, filed, val, start=None, form="10-K", fp="FY"):
    r = {"end": end, "val": val, "fy": fy, "fp": fp, "form": form, "filed": filed}
    if start:
        r["start"] = start
    return r


def annual(value_fn, duration=True, years=YEARS, form="10-K", comparatives=True):
    """Records as filed in yearly 10-Ks: each filing (fy) reports its own year
    and the prior year as a comparative; duration items also carry a 10-Q."""
    out = []
    for y in years:
        filed = f"{y + 1}-02-15"
        for yy in ([y, y - 1] if comparatives else [y]):
            v = value_fn(yy)
            if v is None:
                continue
            out.append(rec(y, f"{yy}-12-31", filed, v, f"{yy}-01-01" if duration else None, form))
        if duration:
            out.append(rec(y, f"{y}-03-31", f"{y}-05-01", value_fn(y) / 4 if value_fn(y) else 1.0,
                           f"{y}-01-01", "10-Q", "Q1"))
    return out


def facts_doc(cik, name, gaap: dict, dei: dict | None = None, ns="us-gaap"):
    facts = {ns: {t: {"units": {u: recs}} for t, (u, recs) in gaap.items()}}
    if dei:
        facts["dei"] = {t: {"units": {u: recs}} for t, (u, recs) in dei.items()}
    return {"cik": int(cik), "entityName": name, "facts": facts}


def base_company(scale=1.0, revenue_tags=None, with_eps=True, with_sga=True):
    g = {}
    g["Assets"] = ("USD", annual(lambda y: scale * (1000 + 10 * (y - 2019)), duration=False))
    if revenue_tags is None:
        g["Revenues"] = ("USD", annual(lambda y: scale * (500 + y - 2019)))
    else:
        g.update(revenue_tags)
    g["CostOfGoodsAndServicesSold"] = ("USD", annual(lambda y: scale * 200))
    if with_sga:
        g["SellingGeneralAndAdministrativeExpense"] = ("USD", annual(lambda y: scale * 50))
    g["OperatingIncomeLoss"] = ("USD", annual(lambda y: scale * 150))
    g["IncomeLossFromContinuingOperationsBeforeIncomeTaxesExtraordinaryItemsNoncontrollingInterest"] = (
        "USD", annual(lambda y: scale * 140))
    g["IncomeTaxExpenseBenefit"] = ("USD", annual(lambda y: scale * 30))
    g["NetIncomeLoss"] = ("USD", annual(lambda y: scale * 110))
    g["WeightedAverageNumberOfSharesOutstandingBasic"] = ("shares", annual(lambda y: 100.0))
    if with_eps:
        g["EarningsPerShareBasic"] = ("USD/shares", annual(lambda y: scale * 1.1))
    g["StockholdersEquity"] = ("USD", annual(lambda y: scale * 600, duration=False))
    g["AssetsCurrent"] = ("USD", annual(lambda y: scale * 400, duration=False))
    g["InventoryNet"] = ("USD", annual(lambda y: scale * 80, duration=False))
    g["LiabilitiesCurrent"] = ("USD", annual(lambda y: scale * 250, duration=False))
    g["NetCashProvidedByUsedInOperatingActivities"] = ("USD", annual(lambda y: scale * 160))
    g["NetCashProvidedByUsedInInvestingActivities"] = ("USD", annual(lambda y: scale * -70))
    g["PaymentsToAcquirePropertyPlantAndEquipment"] = ("USD", annual(lambda y: scale * 60))
    g["NetCashProvidedByUsedInFinancingActivities"] = ("USD", annual(lambda y: scale * -40))
    g["CashCashEquivalentsRestrictedCashAndRestrictedCashEquivalents"] = (
        "USD", annual(lambda y: scale * 120, duration=False))
    g["PaymentsOfDividendsCommonStock"] = ("USD", annual(lambda y: scale * 20))
    return g


def write_fixture(root):
    os.makedirs(f"{root}/facts", exist_ok=True)
    os.makedirs(f"{root}/meta", exist_ok=True)
    companies = {
        "0": {"cik_str": 1111, "ticker": "AAA", "title": "Alpha Corp"},
        "1": {"cik_str": 2222, "ticker": "BBB", "title": "Beta Inc"},
        "2": {"cik_str": 3333, "ticker": "CCC", "title": "Gamma Ltd"},
        "3": {"cik_str": 4444, "ticker": "DDD", "title": "Delta Co"},
        "4": {"cik_str": 5555, "ticker": "EEE", "title": "Epsilon plc"},
        "5": {"cik_str": 6666, "ticker": "FFF", "title": "Phi Corp"},
        "6": {"cik_str": 7777, "ticker": "GGG", "title": "Gimel SA"},
        "7": {"cik_str": 8888, "ticker": "HHH", "title": "Heth Inc"},
        "8": {"cik_str": 9991, "ticker": "III", "title": "Iota Inc"},
        "9": {"cik_str": 9992, "ticker": "JJJ", "title": "Jota Inc"},
        "10": {"cik_str": 9993, "ticker": "KKK", "title": "Kappa Bank"},
        "11": {"cik_str": 9994, "ticker": "BRK-A", "title": "Lambda Holding"},
        "12": {"cik_str": 9995, "ticker": "MMM", "title": "My Corp"},
        "13": {"cik_str": 9996, "ticker": "OOO", "title": "Omicron Inc"},
        "14": {"cik_str": 9997, "ticker": "PPP", "title": "Pi Corp"},
        "15": {"cik_str": 9998, "ticker": "QQQ", "title": "Qoppa Co"},
        "16": {"cik_str": 9999, "ticker": "NNN", "title": "Nu Ltd"},
    }
    with open(f"{root}/directory.json", "w") as f:
        json.dump(companies, f)
    sic = {1111: ("3571", "ELECTRONIC COMPUTERS"), 2222: ("5331", "RETAIL-VARIETY STORES"),
           3333: ("1311", "CRUDE PETROLEUM"), 4444: ("7372", "SERVICES-PREPACKAGED SOFTWARE"),
           5555: ("2834", "PHARMACEUTICAL PREPARATIONS"), 6666: ("4911", "ELECTRIC SERVICES"),
           8888: ("5411", "RETAIL-GROCERY STORES"), 9991: ("3571", "ELECTRONIC COMPUTERS"),
           9992: ("3571", "ELECTRONIC COMPUTERS"), 9993: ("6021", "National Commercial Banks"),
           9994: ("6331", "OTHER INSURANCE"),
           **{c: ("3571", "ELECTRONIC COMPUTERS") for c in (9995, 9996, 9997, 9998, 9999)}}
    for cik, (code, desc) in sic.items():
        with open(f"{root}/meta/CIK{cik:010d}.json", "w") as f:
            json.dump({"cik": str(cik), "sic": code, "sicDescription": desc}, f)
    with open(f"{root}/meta/CIK0000007777.json", "w") as f:   # truncated payload
        f.write('{"cik": "7777", "sic": "3571", "sicDesc')

    # AAA: plain filer; 2020 restated by a 10-K/A filed later
    a = base_company(1.0)
    a["Revenues"][1].append(rec(2020, "2020-12-31", "2021-06-30", 999.0, "2020-01-01", "10-K/A"))
    # BBB: revenue tag switch, no EPS tag (calculated), SG&A composed from G&A + S&M
    b_rev = {"Revenues": ("USD", annual(lambda y: 700.0 if y <= 2020 else None)),
             "RevenueFromContractWithCustomerExcludingAssessedTax": (
                 "USD", annual(lambda y: 800.0 if y >= 2021 else None))}
    b = base_company(2.0, revenue_tags=b_rev, with_eps=False, with_sga=False)
    b["GeneralAndAdministrativeExpense"] = ("USD", annual(lambda y: 30.0))
    b["SellingAndMarketingExpense"] = ("USD", annual(lambda y: 12.0))
    # CCC: history starts 2020 -> skipped
    c = base_company(1.0)
    c["Assets"] = ("USD", annual(lambda y: 900.0, duration=False, years=list(range(2020, 2026))))
    # DDD: no net income tag at all -> error + suggestions
    d = base_company(1.0)
    del d["NetIncomeLoss"]
    d["ComprehensiveIncomeNetOfTax"] = ("USD", annual(lambda y: 5.0))
    # EEE: share count only on the cover page (dei), dated at the filing date, not
    # the fiscal year end -> the strict 4-key merge misses it, the relaxed one aligns on fy
    e = base_company(1.0)
    del e["WeightedAverageNumberOfSharesOutstandingBasic"]
    e_dei = {"EntityCommonStockSharesOutstanding": (
        "shares", [rec(y, f"{y + 1}-02-10", f"{y + 1}-02-15", 50.0) for y in YEARS])}
    # FFF: share counts reported only up to 2017 -> the latest value is carried to every year
    f_ = base_company(1.0)
    f_["WeightedAverageNumberOfSharesOutstandingBasic"] = (
        "shares", [rec(y, f"{y}-12-31", f"{y + 1}-02-15", 10.0 * y - 20000.0, f"{y}-01-01") for y in (2015, 2016, 2017)])
    # HHH: share counts only in quarterly reports -> none passes the annual-form filter
    h = base_company(1.0)
    h["WeightedAverageNumberOfSharesOutstandingBasic"] = (
        "shares", [rec(y, f"{y}-03-31", f"{y}-05-01", 77.0, f"{y}-01-01", "10-Q", "Q1") for y in YEARS])
    docs = {1111: facts_doc(1111, "Alpha Corp", a), 2222: facts_doc(2222, "Beta Inc", b),
            3333: facts_doc(3333, "Gamma Ltd", c), 4444: facts_doc(4444, "Delta Co", d),
            5555: facts_doc(5555, "Epsilon plc", e, dei=e_dei), 6666: facts_doc(6666, "Phi Corp", f_),
            7777: facts_doc(7777, "Gimel SA", base_company(1.0)),
            8888: facts_doc(8888, "Heth Inc", h),
            # no SG&A total and neither of its parts; the same, but exempt
            9991: facts_doc(9991, "Iota Inc", base_company(1.0, with_sga=False)),
            9994: facts_doc(9994, "Lambda Holding", base_company(1.0, with_sga=False)),
            # a bank that reports none of the liability components
            9993: facts_doc(9993, "Kappa Bank", base_company(1.0))}
    # MMM: no pre-tax profit, and of its non-operating parts only the second: fails strictly, recovers
    m = base_company(1.0)
    del m["IncomeLossFromContinuingOperationsBeforeIncomeTaxesExtraordinaryItemsNoncontrollingInterest"]
    m["OtherNonoperatingIncomeExpense"] = ("USD", annual(lambda y: -4.0))
    docs[9995] = facts_doc(9995, "My Corp", m)
    # OOO: two share tags; the first only fits the year (an amendment filed later), the second
    # is zero: items put together from several tags meet a zero denominator, unless by year
    o = base_company(1.0)
    del o["WeightedAverageNumberOfSharesOutstandingBasic"]
    o["CommonStockSharesIssued"] = ("shares", [rec(y, f"{y}-12-31", f"{y + 1}-06-30", 80.0, form="10-K/A") for y in YEARS])
    o["CommonStockSharesOutstanding"] = ("shares", [rec(y, f"{y}-12-31", f"{y + 1}-02-15", 0.0) for y in YEARS])
    docs[9996] = facts_doc(9996, "Omicron Inc", o)
    # PPP: no pre-tax profit; the report of 2022 only repeats 2021's non-operating income, so
    # that a period end stands for two years: aligned on period ends it fails, on years not
    pre = "IncomeLossFromContinuingOperationsBeforeIncomeTaxesExtraordinaryItemsNoncontrollingInterest"
    p = base_company(1.0)
    del p[pre]
    p["NonoperatingIncomeExpense"] = ("USD", annual(lambda y: None if y == 2022 else 6.0))
    p["OtherNonoperatingIncomeExpense"] = ("USD", annual(lambda y: -4.0))
    docs[9997] = facts_doc(9997, "Pi Corp", p)
    # QQQ: general and administrative expense twice in one year, under two fiscal periods
    q = base_company(1.0, with_sga=False)
    q["GeneralAndAdministrativeExpense"] = ("USD", [*annual(lambda y: 30.0), rec(2021, "2021-12-31", "2022-02-15", 31.0, "2021-01-01", fp="Q4")])
    docs[9998] = facts_doc(9998, "Qoppa Co", q)
    # NNN: an error page instead of the facts; the payload lands later
    os.makedirs(f"{root}/facts_later", exist_ok=True)
    with open(f"{root}/facts/CIK0000009999.json", "w") as f:
        f.write("<html><body>Request rate exceeded</body></html>")
    with open(f"{root}/facts_later/CIK0000009999.json", "w") as f:
        json.dump(facts_doc(9999, "Nu Ltd", base_company(1.0)), f)
    with open(f"{root}/facts/CIK0000009992.json", "w") as f:   # truncated payload
        f.write('{"cik": 9992, "facts": {"us-ga')
    for cik, doc in docs.items():
        with open(f"{root}/facts/CIK{cik:010d}.json", "w") as f:
            json.dump(doc, f)

    # prices: business days from 2019-12-01, close = day index
    rows = []
    d0 = date(2019, 12, 1)
    for t in ("AAA", "BBB", "DDD"):
        i = 0
        for k in range(0, 2600):
            d_ = d0 + timedelta(days=k)
            if d_.weekday() >= 5:
                continue
            i += 1
            rows.append({"ticker": t, "d": d_.isoformat(), "close_adj": float(i), "close_unadj": float(2 * i)})
    with open(f"{root}/prices.json", "w") as f:
        json.dump(rows, f)
    return root
