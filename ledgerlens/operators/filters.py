"""Filters over the long facts table.

Facts schema (one row per reported value):
    cik, ns, tag, unit, start date, end date, val double, fy int, fp string,
    form string, filed date

Every step is a narrow filter or a grouped aggregate (partial aggregation),
so a company or tag with a disproportionate number of records is combined
map-side before any shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import ANNUAL_FORM_PATTERN, EXPECTED_RECORDS, MIN_ANNUAL_DAYS, STUDY_END, STUDY_START

FACT_KEYS = ["cik", "ns", "tag", "unit"]


def annual_form(col="form", pattern: str = ANNUAL_FORM_PATTERN):
    """full-match of the annual-report form pattern; missing form -> False."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c.rlike(pattern), F.lit(False))


def study_window(col="fy", start: int = STUDY_START):
    """fiscal year inside the study window."""
    c = F.col(col) if isinstance(col, str) else col
    return c >= F.lit(start)


def with_has_start(facts: DataFrame, keys=FACT_KEYS) -> DataFrame:
    """Per (cik, ns, tag, unit): does any record carry a period start?

    The facts reader sets the flag while a tag's records are still one array; only
    facts from elsewhere need the grouped aggregate and the join back.
    """
    if "has_start" in facts.columns:
        return facts
    hs = facts.groupBy(*keys).agg(F.max(F.col("start").isNotNull().cast("int")).cast("boolean").alias("has_start"))
    return facts.join(hs, keys)


def annual_duration(min_days: int = MIN_ANNUAL_DAYS):
    """duration tags keep periods of >= min_days (a missing start then drops);
    instant tags (no start anywhere) keep every record."""
    return (~F.col("has_start")) | (F.datediff(F.col("end"), F.col("start")) >= min_days)


def annual_facts(facts: DataFrame, start: int = STUDY_START, duration: bool = True) -> DataFrame:
    """F1 + F2 (+ F3): annual-report records inside the study window."""
    f = facts
    if duration:
        f = with_has_start(f)
    f = f.filter(annual_form() & study_window("fy", start))
    if duration:
        f = f.filter(annual_duration())
    return f


def keep_latest(facts: DataFrame, keys=("cik", "ns", "tag", "unit", "fy", "fp")) -> DataFrame:
    """Amendments and comparatives -> keep the record with the largest
    (end, filed) per (company, tag, fy, fp). A grouped ``max_by`` with partial
    aggregation, not a sort of the whole group."""
    keys = list(keys)
    order = F.struct(F.col("end"), F.col("filed"), F.col("val"))
    rec = F.struct(F.col("end"), F.col("filed"), F.col("val"), F.col("start"))
    g = facts.groupBy(*keys).agg(F.max_by(rec, order).alias("r"))
    return g.select(*keys, "r.end", "r.filed", "r.val", "r.start")


def namespace_choice(facts: DataFrame, anchor: str, namespaces=("us-gaap", "ifrs-full")) -> DataFrame:
    """per company, the first namespace (in order) that reports the anchor tag."""
    rank = F.when(F.col("ns") == namespaces[0], F.lit(0))
    for i, ns in enumerate(namespaces[1:], 1):
        rank = rank.when(F.col("ns") == ns, F.lit(i))
    a = facts.filter((F.col("tag") == anchor) & F.col("ns").isin(*namespaces)).withColumn("_r", rank)
    return a.groupBy("cik").agg(F.min("_r").alias("_r")).select(
        "cik", F.element_at(F.array(*[F.lit(n) for n in namespaces]), F.col("_r") + 1).alias("ns"))


def eligibility(facts: DataFrame, anchor: str, start: int = STUDY_START, end: int = STUDY_END,
                expected: int = EXPECTED_RECORDS) -> DataFrame:
    """per company from the anchor tag -- earliest fy <= start and latest fy
    >= end over all records, and >= ``expected`` annual rows after F1/F2/F5.

    Returns cik, earliest_fy, latest_fy, n_annual, eligible.
    """
    a = facts.filter(F.col("tag") == anchor)
    span = a.groupBy("cik").agg(F.min("fy").alias("earliest_fy"), F.max("fy").alias("latest_fy"))
    ann = keep_latest(a.filter(annual_form() & study_window("fy", start)))
    cnt = ann.groupBy("cik").agg(F.count(F.lit(1)).alias("n_annual"))
    out = span.join(cnt, "cik", "left").withColumn("n_annual", F.coalesce(F.col("n_annual"), F.lit(0)))
    ok = ((F.col("earliest_fy") <= start) & (F.col("latest_fy") >= end) & (F.col("n_annual") >= expected))
    return out.withColumn("eligible", F.coalesce(ok, F.lit(False)))
