"""Repair, routing and audit.

The panel's key (ticker, fy, fp) is unique (see ``assert_unique``), so a
company holds at most one row per fiscal period: per-ticker windows here are
bounded by the number of fiscal years, never by data volume. Company-level
flags are computed with grouped aggregates (partial aggregation, skew-safe)
and joined back, instead of collecting ticker lists on the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..constants import (MSG_DAMAGED_BOTH, MSG_DAMAGED_NI, MSG_DAMAGED_RP, MSG_EPS_RECOVERED,
                         MSG_SHARES_FILLED, MSG_ZERO_SHARES)
from ..functions.numeric import ieee_div
from .valuation import valuation_v1

SHARES = "shares#"
SGA = "expense_general/admin"
LESS_DATA_COLUMNS = ["cost", SGA, "currasset", "curr_liabilities"]

MSG_BOTH, MSG_NI, MSG_RP, MSG_ZERO = MSG_DAMAGED_BOTH, MSG_DAMAGED_NI, MSG_DAMAGED_RP, MSG_ZERO_SHARES


def bq(c: str):
    return F.col(f"`{c}`")


def company_flags(df: DataFrame, flags: dict) -> DataFrame:
    """One row per ticker with boolean 'any row matches' flags (grouped, skew-safe)."""
    return df.groupBy("ticker").agg(*[F.max(cond.cast("int")).cast("boolean").alias(name)
                                      for name, cond in flags.items()])


def damaged_flags(df: DataFrame) -> DataFrame:
    """Q1: companies missing net_income or recurrent_profit in any year, with reason."""
    f = company_flags(df, {"miss_ni": F.col("net_income").isNull(),
                           "miss_rp": F.col("recurrent_profit").isNull()})
    f = f.filter(F.col("miss_ni") | F.col("miss_rp"))
    return f.withColumn("message", F.when(F.col("miss_ni") & F.col("miss_rp"), F.lit(MSG_BOTH))
                        .when(F.col("miss_ni"), F.lit(MSG_NI)).otherwise(F.lit(MSG_RP)))


def fill_shares(df: DataFrame, order=("fy", "filed")) -> DataFrame:
    """Forward fill then backward fill ``shares#`` per ticker.

    Adds ``shares_filled`` (bool) for rows whose value was filled.
    """
    w = Window.partitionBy("ticker").orderBy(*order)
    ffill = F.last(bq(SHARES), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    first_any = F.first(bq(SHARES), ignorenulls=True).over(
        w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return (df.withColumn("shares_filled", bq(SHARES).isNull())
            .withColumn(SHARES, F.coalesce(ffill, first_any)))


def _joined(flag, text, sep: str, order=("fy", "filed")):
    """Aggregate: the texts of flagged rows in (fy, filed) order, null without one; bounded
    by the years of a company."""
    s = F.when(flag, F.struct(*[F.col(o) for o in order], text.alias("m")))
    return F.nullif(F.array_join(F.transform(F.array_sort(F.collect_list(s)), lambda x: x["m"]), sep), F.lit(""))


def plain_number(x):
    """A double as plain text: ``16000000000.0`` where a cast gives ``1.6E10`` (from 1e7
    up to 1e16, beyond which the exponent form is the plain one); missing: ``nan``."""
    digits = F.regexp_replace(x.cast("decimal(38,12)").cast("string"), "0+$", "")
    text = F.when(F.endswith(digits, F.lit(".")), F.concat(digits, F.lit("0"))).otherwise(digits)
    return F.when(x.isNull(), F.lit("nan")).when((F.abs(x) >= 1e7) & (F.abs(x) < 1e16), text).otherwise(x.cast("string"))


def repair_eps(df: DataFrame) -> DataFrame:
    """Q4: eps = net_income / shares# where shares are known and eps is missing."""
    target = bq(SHARES).isNotNull() & F.col("eps").isNull()
    return (df.withColumn("eps_repaired", target)
            .withColumn("eps", F.when(target, ieee_div("net_income", bq(SHARES))).otherwise(F.col("eps"))))


def repair_messages(repaired: DataFrame) -> DataFrame:
    """Q2/Q4: (ticker, message) of companies with filled share counts or repaired EPS, the
    share counts first, from rows with both flags: one grouped aggregate."""
    shares = F.format_string(MSG_SHARES_FILLED, F.col("fy").cast("string"), plain_number(bq(SHARES)))
    eps = F.format_string(MSG_EPS_RECOVERED, F.col("fy").cast("string"), F.col("eps"))
    m = repaired.groupBy("ticker").agg(_joined(F.col("shares_filled"), shares, " , ").alias("s"), _joined(F.col("eps_repaired"), eps, ". ").alias("e"))
    return m.filter("s IS NOT NULL OR e IS NOT NULL").select("ticker", F.concat_ws(". ", "s", "e").alias("message"))


@dataclass
class CleanupResult:
    clean: DataFrame
    damaged: DataFrame
    less_data: DataFrame
    messages: DataFrame          # ticker, update_after_cleanup
    routes: DataFrame            # ticker, fy, fp, route
    zero: DataFrame              # tickers routed for a zero share count


def cleanup(panel: DataFrame, materialize: bool = True) -> CleanupResult:
    """Q1-Q7 over a valued panel; routes are disjoint and cover every input row.

    A company's route follows from its rows as they are: filling share counts adds no
    zero where there was none, and neither filling nor repairing touches the columns that
    decide on less_data. So one grouped aggregate gives every flag (Q1, Q3, Q6) and one
    join brings them to the rows (J9, J10); what follows are filters.
    ``materialize`` checkpoints the flagged rows and the repaired, re-valued ones (stage
    boundaries): routes and messages then read those instead of replaying the windows.
    """
    def kept(df):
        if not materialize:
            return df
        from ..session import cut
        return cut(df)

    flags = company_flags(panel, {
        "miss_ni": F.col("net_income").isNull(), "miss_rp": F.col("recurrent_profit").isNull(), "zero": bq(SHARES) == 0,
        "less": F.greatest(*[bq(c).isNull() for c in LESS_DATA_COLUMNS])})
    flags = kept(flags.withColumns({"damaged": F.col("miss_ni") | F.col("miss_rp"), "zero": F.coalesce("zero", F.lit(False))}))
    rows = kept(panel.join(flags.select("ticker", "damaged", "zero", "less"), "ticker"))
    held = [bq(c) for c in panel.columns]

    filled = fill_shares(rows.filter(~F.col("damaged")))                          # Q2
    repaired = repair_eps(filled.filter(~F.col("zero")))                          # Q4
    repaired = kept(valuation_v1(repaired))                                       # Q5
    clean = repaired.filter(~F.col("less")).select(*held)                         # Q6
    less_data = repaired.filter("less").select(*held)
    damaged = rows.filter("damaged").select(*held).unionByName(filled.filter("zero").select(*held))     # Q3, U1

    # Q7 audit merge: the reasons of a route overwrite, fills set, EPS repairs append
    reason = (F.when(F.col("miss_ni") & F.col("miss_rp"), F.lit(MSG_BOTH)).when(F.col("miss_ni"), F.lit(MSG_NI))
              .when(F.col("miss_rp"), F.lit(MSG_RP)).otherwise(F.lit(MSG_ZERO)))
    messages = flags.filter("damaged OR zero").select("ticker", reason.alias("update_after_cleanup")) \
        .unionByName(repair_messages(repaired).withColumnRenamed("message", "update_after_cleanup"))

    route = F.when(F.col("damaged") | F.col("zero"), F.lit("damaged")).when(F.col("less"), F.lit("less_data")).otherwise(F.lit("clean"))
    routes = rows.select("ticker", "fy", "fp", route.alias("route"))
    return CleanupResult(clean, damaged, less_data, messages, routes, flags.filter("zero AND NOT damaged").select("ticker"))


def merge_log(log: DataFrame, messages: DataFrame, column: str = "update_after_cleanup") -> DataFrame:
    """Keyed update of the run log -- new message wins, otherwise keep the old value."""
    upd = messages.select("ticker", F.col(column).alias("_new"))
    out = log.join(upd, "ticker", "left")
    old = F.col(column) if column in log.columns else F.lit(None).cast("string")
    return out.withColumn(column, F.coalesce(F.col("_new"), old)).drop("_new")


def success_rate(log: DataFrame, status: str = "status") -> DataFrame:
    """One row with the companies that succeeded, all companies and the rate in
    per cent (missing for an empty log)."""
    ok = F.count(F.when(F.col(status) == "Success", 1))
    return log.agg(ok.alias("n_success"), F.count(F.lit(1)).alias("n_companies"),
                   F.try_divide(ok * 100.0, F.count(F.lit(1))).alias("success_pct"))


def run_stats(routes: DataFrame) -> DataFrame:
    """Rows and companies per route."""
    return routes.groupBy("route").agg(F.count(F.lit(1)).alias("n_rows"),
                                       F.countDistinct("ticker").alias("n_companies"))
