"""Derived line items (D1-D13): one projection over the wide panel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import PANEL_BASE_COLUMNS
from ..functions.numeric import fill0, num, sub_fill_both

SGA = "expense_general/admin"


def derive_line_items(df: DataFrame) -> DataFrame:
    """Add the 13 derived items. ``expense_others`` uses the *reported*
    operating income; ``operating_income`` is then back-filled from the
    pre-tax recurring profit and feeds ``nonoperating_income``."""
    col = F.col
    gross_profit = num(col("gross_revenue") - fill0("cost"))
    expense_others = sub_fill_both(gross_profit - col("operating_income"), col(SGA))
    operating_income = F.coalesce(col("operating_income"), col("recurrent_profit"))
    liabilities = col("asset") - col("equity")
    inven_other = fill0("inventory") + fill0("other_currasset")
    cap_ex = fill0("payment_cap") + fill0("payment_intangible")
    df = df.withColumns({
        "gross_profit": gross_profit,
        "expense_others": expense_others,
        "operating_income": operating_income,
        "profit": col("recurrent_profit") - col("tax"),
        "liabilities": liabilities,
        "inven_other": inven_other,
        "lt_asset": col("asset") - col("currasset"),
        "cap_ex": cap_ex,
    })
    df = df.withColumns({
        "nonoperating_income": col("recurrent_profit") - col("operating_income"),
        "noncontrolling_interest": col("net_income") - col("profit"),
        "cash": col("currasset") - fill0("inven_other"),
        "lt_liabilities": col("liabilities") - col("curr_liabilities"),
        "fcf": col("operating_cash") - col("cap_ex"),
    })
    return df


def order_panel(df: DataFrame, extra_first=(), extra_last=()) -> DataFrame:
    """Select the panel's fixed column order (plus any extra columns)."""
    cols = list(extra_first) + [c for c in PANEL_BASE_COLUMNS if c in df.columns] + list(extra_last)
    return df.select(*[F.col(f"`{c}`") for c in cols])
