"""Column helpers: IEEE division, ladders, clip, two-sided fill, scores, SIC groups, corr."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F


def one_col(spark, vals, name="x"):
    return spark.createDataFrame([(None if v is None else float(v),) for v in vals], f"{name} double")


def test_ieee_div(spark):
    from ledgerlens.functions.numeric import ieee_div
    df = spark.createDataFrame([(1.0, 0.0), (-1.0, 0.0), (0.0, 0.0), (None, 1.0), (1.0, None), (6.0, 3.0)],
                               "a double, b double")
    got = [r[0] for r in df.select(ieee_div("a", "b")).collect()]
    assert got[0] == math.inf and got[1] == -math.inf
    assert got[2] is None and got[3] is None and got[4] is None
    assert got[5] == 2.0


def test_nan_becomes_null(spark):
    from ledgerlens.functions.numeric import ieee_div, num
    df = spark.createDataFrame([(math.inf, math.inf)], "a double, b double")
    r = df.select(ieee_div("a", "b").alias("d"), num(F.col("a") - F.col("b")).alias("n")).first()
    assert r["d"] is None and r["n"] is None


@pytest.mark.parametrize("v,exp", [(0.81, 0.8), (0.8, 0.75), (0.67, 0.7), (0.5, 0.65), (0.33, 0.6),
                                   (0.1, 0.5), (0.0, 0.0), (-1.0, 0.0), (None, 0.0)])
def test_roa_discount_edges(spark, v, exp):
    from ledgerlens.functions.ladders import roa_discount
    assert one_col(spark, [v]).select(roa_discount("x")).first()[0] == pytest.approx(exp)


@pytest.mark.parametrize("v,exp", [(3.01, 1.5), (3.0, 1.36), (2.5, 1.2), (2.0, 1.0), (None, 1.0)])
def test_leverage_factor(spark, v, exp):
    from ledgerlens.functions.ladders import leverage_factor
    assert one_col(spark, [v]).select(leverage_factor("x")).first()[0] == pytest.approx(exp)


def _risk_v1(v):
    if v is None:
        return None
    return (1 if v > .5 else .8 if v > .4 else .66 if v > .33 else .5 if v > .25
            else .15 * (v / 50 * 5) if v > .03 else .01 * ((v - 1) * 10 + 5))


def _risk_v2(v):
    if v is None:
        return .005
    return (1.0 if v >= .5 else .8 if v >= .41 else .66 if v >= .34 else .5 if v >= .26 else .33 if v >= .21
            else (v / 5 * 50 + 50) / 100 if v >= .04 else .005)


@pytest.mark.parametrize("v", [0.6, 0.5, 0.41, 0.4, 0.34, 0.33, 0.26, 0.25, 0.21, 0.2, 0.04, 0.03, 0.01, -2.0, None])
def test_risk_factors(spark, v):
    from ledgerlens.functions.ladders import risk_factor_v1, risk_factor_v2
    r = one_col(spark, [v]).select(risk_factor_v1("x").alias("a"), risk_factor_v2("x").alias("b")).first()
    e1 = _risk_v1(v)
    assert (r["a"] is None and e1 is None) or r["a"] == pytest.approx(e1)
    assert r["b"] == pytest.approx(_risk_v2(v))


def test_clip_upper_semantics(spark):
    from ledgerlens.functions.numeric import clip_upper
    df = spark.createDataFrame([(0.5, 0.3), (0.1, 0.3), (None, 0.3), (0.5, None)], "x double, u double")
    assert [r[0] for r in df.select(clip_upper("x", F.col("u"))).collect()] == [0.3, 0.1, None, 0.5]


def test_two_sided_fill(spark):
    from ledgerlens.functions.numeric import sub_fill_both
    df = spark.createDataFrame([(None, None), (None, 2.0), (3.0, None)], "a double, b double")
    assert [r[0] for r in df.select(sub_fill_both("a", "b")).collect()] == [None, -2.0, 3.0]


def _score(v, bps):
    rev = bps[0] > bps[-1]
    if v is None:
        return 8
    if not rev:
        return -5 if v < bps[0] else 0 if v < bps[1] else 5 if v < bps[2] else 8
    return -5 if v > bps[0] else 0 if v > bps[1] else 5 if v > bps[2] else 8


@pytest.mark.parametrize("bps", [[0.1, 0.2, 0.5], [1.2, 1, 0.8]])
def test_breakpoint_score(spark, bps):
    from ledgerlens.functions.ladders import breakpoint_score
    vals = [-math.inf, 0.05, 0.1, 0.15, 0.2, 0.5, 0.8, 0.9, 1.0, 1.1, 1.2, 2.0, math.inf, None]
    got = [r[0] for r in one_col(spark, vals).select(breakpoint_score("x", bps)).collect()]
    assert got == [_score(v, bps) for v in vals]


@pytest.mark.parametrize("text,exp", [("0100 x", "Agriculture, Forestry and Fishing"), ("999 x", "Agriculture, Forestry and Fishing"),
                                      ("1800 x", "Other/Unclassified"), ("abc", "Other/Unclassified"),
                                      (None, "Other/Unclassified"), ("9100 GOV", "Public Administration"),
                                      ("5199 W", "Wholesale Trade"), ("5200 R", "Retail Trade")])
def test_broad_industry(spark, text, exp):
    from ledgerlens.functions.sic import broad_industry
    df = spark.createDataFrame([(text,)], "industry string")
    assert df.select(broad_industry("industry")).first()[0] == exp


def test_safe_corr(spark):
    from ledgerlens.functions.numeric import safe_corr
    rng = np.random.default_rng(3)
    x = rng.normal(size=50)
    y = 2 * x + rng.normal(size=50)
    rows = [(float(a), float(b), 0.1) for a, b in zip(x, y)] + [(None, 1.0, 0.1)]
    df = spark.createDataFrame(rows, "x double, y double, c double")
    r = df.agg(safe_corr("x", "y").alias("r"), safe_corr("c", "y").alias("k")).first()
    assert r["r"] == pytest.approx(np.corrcoef(x, y)[0, 1], abs=1e-12)
    assert r["k"] is None


def test_equal_width_bins_match_right_closed_cut(spark):
    from ledgerlens.operators.stats import bin_index
    rng = np.random.default_rng(5)
    x = rng.normal(size=2000)
    lo, hi = float(x.min()), float(x.max())
    edges = np.linspace(lo, hi, 101)
    edges[0] -= 0.001 * (hi - lo)
    exp = np.searchsorted(edges, x, side="left")   # right-closed bins (a, b]
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    got = [r[0] for r in df.select(bin_index(F.col("x"), lo, hi)).collect()]
    assert sum(int(g != e) for g, e in zip(got, exp)) == 0
