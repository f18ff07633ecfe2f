"""SIC code -> broad industry, as a Column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import OTHER_GROUP, SIC_GROUPS
from .numeric import c


def sic_code(industry) -> Column:
    """Leading token of the industry text as an integer, NULL when unparsable."""
    head = F.split(F.coalesce(c(industry).cast("string"), F.lit("")), " ").getItem(0)
    return head.try_cast("int")


def broad_industry(industry) -> Column:
    code = sic_code(industry)
    expr = None
    for lo, hi, name in SIC_GROUPS:
        cond = code.between(lo, hi)
        expr = F.when(cond, name) if expr is None else expr.when(cond, name)
    return expr.otherwise(F.lit(OTHER_GROUP))
