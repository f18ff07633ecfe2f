"""Step functions ("ladders") used by the valuation and the ratio score.

A missing input falls through every comparison to the last branch, exactly like
the row-wise rules they re-express (comparisons with NULL are never true).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import c, null_d, num


def _ladder(x: Column, steps, otherwise, strict: bool = True) -> Column:
    expr = None
    for bound, value in steps:
        cond = (x > bound) if strict else (x >= bound)
        value = value if isinstance(value, Column) else F.lit(float(value))
        expr = F.when(cond, value) if expr is None else expr.when(cond, value)
    otherwise = otherwise if isinstance(otherwise, Column) else F.lit(float(otherwise))
    return expr.otherwise(otherwise)


def roa_discount(equity_ratio) -> Column:
    x = num(equity_ratio)
    return _ladder(x, [(0.8, 0.8), (0.67, 0.75), (0.5, 0.7), (0.33, 0.65), (0.1, 0.6), (0, 0.5)], 0.0)


def leverage_factor(financial_leverage_ratio) -> Column:
    x = num(financial_leverage_ratio)
    return _ladder(x, [(3, 1.5), (2.5, 1.36), (2, 1.2)], 1.0)


def risk_factor_v1(pbr) -> Column:
    """Strict bounds; missing pbr stays missing (the tail formula of NaN)."""
    x = num(pbr)
    tail = F.lit(0.01) * ((x - 1) * 10 + 5)
    mid = F.lit(0.15) * (x / 50 * 5)
    lad = _ladder(x, [(0.5, 1.0), (0.4, 0.8), (0.33, 0.66), (0.25, 0.5), (0.03, mid)], tail)
    return num(F.when(x.isNull(), null_d()).otherwise(lad))


def risk_factor_v2(pbr) -> Column:
    """Inclusive bounds; missing pbr -> 0.005."""
    x = num(pbr)
    mid = (x / 5 * 50 + 50) / 100
    return num(_ladder(x, [(0.5, 1.0), (0.41, 0.8), (0.34, 0.66), (0.26, 0.5), (0.21, 0.33), (0.04, mid)],
                       0.005, strict=False))


def breakpoint_score(x, breakpoints, points=(-5, 0, 5, 8)) -> Column:
    """Score one ratio against three breakpoints (strict comparisons).

    Increasing breakpoints: below b0 -> points[0], below b1 -> points[1], below
    b2 -> points[2], otherwise points[3]. Decreasing breakpoints flip the
    comparisons. Missing values land on points[3].
    """
    x = num(x)
    b0, b1, b2 = breakpoints
    rev = b0 > b2
    cmp = (lambda v, b: v > b) if rev else (lambda v, b: v < b)
    return (F.when(cmp(x, b0), F.lit(points[0]))
            .when(cmp(x, b1), F.lit(points[1]))
            .when(cmp(x, b2), F.lit(points[2]))
            .otherwise(F.lit(points[3])))
