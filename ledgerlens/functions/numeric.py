"""Null- and IEEE-aware Column helpers.

Spark runs with ANSI mode on: ``x / 0`` raises and NaN compares greater than
every number. The studied computations follow NumPy float semantics instead
(``x/0`` = +-inf, ``0/0`` = missing, NaN compares false). Every helper here
keeps the work inside Catalyst expressions (whole-stage codegen, no UDF) and
turns NaN into NULL so comparisons behave like the reference.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F



def null_d() -> Column:
    return F.lit(None).cast("double")


def pos_inf() -> Column:
    return F.lit(float("inf"))


def neg_inf() -> Column:
    return F.lit(float("-inf"))


def c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def num(x) -> Column:
    """NaN -> NULL (a NaN is 'missing' in the studied semantics)."""
    return F.nanvl(c(x).cast("double"), null_d())


def ieee_div(a, b) -> Column:
    """a / b with float semantics: x/0 -> +-inf, 0/0 and NULL operands -> NULL."""
    a, b = c(a).cast("double"), c(b).cast("double")
    return num(
        F.when(a.isNull() | b.isNull(), null_d())
        .when(b != 0, a / b)
        .when(a > 0, pos_inf())
        .when(a < 0, neg_inf())
        .otherwise(null_d()))


def fill0(x) -> Column:
    return F.coalesce(c(x).cast("double"), F.lit(0.0))


def sub_fill_both(a, b) -> Column:
    """a - b where a missing side counts as 0, but both missing stays missing."""
    a, b = c(a), c(b)
    return F.when(a.isNull() & b.isNull(), null_d()).otherwise(num(fill0(a) - fill0(b)))


def clip_upper(x, upper) -> Column:
    """Cap x at ``upper``; a missing x stays missing, a missing bound leaves x."""
    x, upper = c(x), c(upper) if not isinstance(upper, (int, float)) else F.lit(float(upper))
    return F.when(x.isNotNull() & upper.isNotNull() & (x > upper), upper).otherwise(x)


def try_double(x) -> Column:
    """Numeric coercion: unparsable text -> NULL (plain cast raises under ANSI)."""
    return num(F.expr(f"try_cast(`{x}` as double)") if isinstance(x, str) else x.try_cast("double"))


def row_sum(cols: Iterable, skip_null: bool = True) -> Column:
    cols = [c(x) for x in cols]
    if skip_null:
        cols = [fill0(x) for x in cols]
    return reduce(lambda l, r: l + r, cols)


def any_null(cols: Iterable) -> Column:
    return reduce(lambda l, r: l | r, [c(x).isNull() for x in cols])


def finite_or_null(x) -> Column:
    """+-inf and NaN -> NULL."""
    x = num(x)
    return F.when(x.isin(float("inf"), float("-inf")), null_d()).otherwise(x)


def is_pos_inf(x) -> Column:
    return c(x) == pos_inf()


def is_neg_inf(x) -> Column:
    return c(x) == neg_inf()


def safe_corr(x, y) -> Column:
    """Pearson correlation over pairs where both sides are present.

    NULL for fewer than two pairs or a constant side (plain ``corr`` raises
    DIVIDE_BY_ZERO under ANSI in that case). Pure aggregate expression, so it
    runs with partial aggregation like any built-in.
    """
    x, y = num(x), num(y)
    both = x.isNotNull() & y.isNotNull()
    xm = F.when(both, x)
    ym = F.when(both, y)
    sx, sy = F.stddev_pop(xm), F.stddev_pop(ym)
    cov = F.covar_pop(xm, ym)
    const = (F.min(xm) == F.max(xm)) | (F.min(ym) == F.max(ym))
    return F.when((F.count(xm) < 2) | const, null_d()).otherwise(
        num(F.try_divide(cov, sx * sy)))
