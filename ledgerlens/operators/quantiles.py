"""Exact quantiles (linear interpolation) without funnelling a group into one task.

Spark's exact ``percentile`` keeps every value of a group in one aggregation
buffer, which does not survive a group holding a third of 100 TB. Here:

1. a mergeable sketch per group (bounded size, partial aggregation) brackets each wanted
   rank between two values; small groups are taken whole;
2. rows above a bracket drop, rows below become one count, and equal values inside are
   merged (partial aggregation): what is shuffled is the bracket's share of the rows;
3. the distinct (group, bracket, value) rows are range-partitioned: a large group
   spreads over as many partitions as its distinct values need;
4. a running count inside each partition plus the counts of the partitions
   before it (one small row per partition and group) give every row the ranks
   it covers; the rows that cover a wanted rank hold the answer.

The answer is exact whatever the sketch says: a rank that falls outside its bracket is
noticed, and its groups are then taken whole. No passes to converge, no caps, no values
on the driver: the result is one row per group and probability.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut


def _same(left: DataFrame, right: DataFrame, pairs):
    """Null-safe equality of the paired columns."""
    return reduce(lambda a, p: a & left[p[0]].eqNullSafe(right[p[1]]), pairs, F.lit(True))


ACCURACY = 10_000       # a sketch's rank error is 1 / ACCURACY of a group's rows; groups up to twice that size are taken whole
FEW_GROUPS = 100_000    # brackets of so many groups are broadcast
BLOCK_ROWS = 50_000     # wide rows that are sketched and counted at a time
POINTS = 1_000          # points of a block's sketch, per group and column


def _brackets(base: DataFrame, ks, probs, accuracy: int) -> DataFrame:
    """(keys, _total, _spans): per group the spans (number, low, high, probabilities) that
    hold the wanted ranks, three times the sketch's error wide on each side; an open span
    for all of them in a small group."""
    edge = 3.0 / accuracy
    asked = [x for p in probs for x in (max(0.0, p - edge), min(1.0, p + edge))]
    g = base.groupBy(*ks).agg(F.count(F.lit(1)).alias("_total"), F.percentile_approx("_v", asked, accuracy).alias("_q")).filter("_total > 0")
    span = "struct<i:int,low:double,high:double,ps:array<double>>"
    whole = F.array(F.struct(F.lit(0).alias("i"), F.lit(None).cast("double").alias("low"), F.lit(None).cast("double").alias("high"),
                             F.array(*[F.lit(float(p)) for p in probs]).alias("ps")).cast(span))
    each = F.array(*[F.struct(F.lit(i).alias("i"), F.col("_q")[2 * i].alias("low"), F.col("_q")[2 * i + 1].alias("high"),
                              F.array(F.lit(float(p))).alias("ps")).cast(span) for i, p in enumerate(probs)])
    return g.select(*ks, "_total", F.when(F.col("_total") <= 2 * accuracy, whole).otherwise(each).alias("_spans"))


def exact_quantiles(df: DataFrame, value: str, probs, keys=(), accuracy: int = ACCURACY) -> DataFrame:
    """Linear-interpolated quantiles of ``value`` per ``keys`` (NULL / NaN ignored).

    Returns (keys..., p, q), one row per group and probability; a null key is a
    group like any other, a group without values has no row."""
    keys, probs = list(keys), list(probs)
    ks = [f"_k{i}" for i in range(len(keys))]
    base = (df.select(*[F.col(f"`{k}`").alias(a) for k, a in zip(keys, ks)], F.col(f"`{value}`").cast("double").alias("_v"))
            .filter(F.col("_v").isNotNull() & ~F.isnan("_v")))
    spans = cut(_brackets(base, ks, probs, accuracy))
    got = cut(_at_ranks(_counted(base, spans, ks), spans, ks))
    out = got.filter("_x0 IS NOT NULL AND _x1 IS NOT NULL")
    missed = got.filter("_x0 IS NULL OR _x1 IS NULL").select(*ks).distinct()
    if not missed.isEmpty():        # a sketch was off by more than it promises: these groups whole
        t = cut(missed.select(*[F.col(k).alias(f"_m{k}") for k in ks], F.lit(1).alias("_one")))
        again = [(k, f"_m{k}") for k in ks]
        full = spans.join(t, _same(spans, t, again), "left_semi").withColumn("_spans", F.expr(
            "array(named_struct('i', 0, 'low', cast(null as double), 'high', cast(null as double), 'ps', flatten(transform(_spans, s -> s.ps))))"))
        out = out.join(t, _same(out, t, again), "left_anti").unionByName(_at_ranks(_counted(base, full := cut(full), ks), full, ks))
    return out.select(*[F.col(a).alias(k) for k, a in zip(keys, ks)], F.col("_p").alias("p"), _interpolated().alias("q"))


def _interpolated():
    return F.when((F.col("_x0") == F.col("_x1")) | (F.col("_frac") == 0), F.col("_x0")) \
        .otherwise(F.col("_x0") + (F.col("_x1") - F.col("_x0")) * F.col("_frac"))


def exact_quantiles_of(df: DataFrame, columns, probs, group: str) -> DataFrame:
    """The quantiles of many ``columns`` per ``group`` (a string column; null is a group like
    any other): (group, column, p, q), no row for a group's column without values.

    A block's sketch of a column is every m-th of its ordered values, so the number of
    values up to a point is known to within the m of all blocks: what lies between the
    points around a wanted rank holds it for certain. The groups' brackets go to every task
    (one row per group and column)."""
    columns, probs = list(columns), [float(p) for p in probs]
    wide = df.select(F.col(f"`{group}`").alias("_g"), *[F.col(f"`{c}`").cast("double").alias(f"_x{i}") for i, c in enumerate(columns)])

    def sketched(batches):
        for g, x in _blocks(batches):
            out = []
            for c in range(x.shape[1]):
                v = np.sort(x[:, c][~np.isnan(x[:, c])])
                if len(v):
                    m = -(-len(v) // POINTS)
                    out.append((g, c, len(v), m, v[np.r_[np.arange(m - 1, len(v) - 1, m), len(v) - 1]].tolist()))
            yield pd.DataFrame(out, columns=["_g", "_c", "n", "m", "points"])

    def bracketed(pdf: pd.DataFrame) -> pd.DataFrame:
        n, error = int(pdf["n"].sum()), int(pdf["m"].sum())
        v = np.concatenate([np.asarray(x) for x in pdf["points"]])
        w = np.concatenate([np.r_[np.full(len(x) - 1, m), k - m * (len(x) - 1)] for x, m, k in zip(pdf["points"], pdf["m"], pdf["n"])])
        order = np.argsort(v, kind="stable")
        v, upto = v[order], np.cumsum(w[order])
        rank = np.floor(np.array(probs) * (n - 1)).astype(np.int64)
        last = np.searchsorted(upto + error, rank, side="right") - 1            # at most ``rank`` values up to there
        first = np.searchsorted(upto, np.minimum(rank + 2, n), side="left")     # the rank and the next lie up to there
        low = [float(v[i]) if i >= 0 else -np.inf for i in last]
        return pd.DataFrame({"_g": [pdf["_g"].iloc[0]], "_c": [pdf["_c"].iloc[0]], "_total": [n], "low": [low], "high": [v[first].tolist()]})

    found = wide.mapInPandas(sketched, "_g string, _c int, n long, m long, points array<double>") \
        .groupBy("_g", "_c").applyInPandas(bracketed, "_g string, _c int, _total long, low array<double>, high array<double>")
    each = [F.struct(F.lit(i).alias("i"), F.col("low")[i].alias("low"), F.col("high")[i].alias("high"), F.array(F.lit(p)).alias("ps")) for i, p in enumerate(probs)]
    spans = cut(found.select("_g", "_c", "_total", F.array(*each).alias("_spans")))
    bounds: dict = {}
    for r in spans.collect():
        bounds.setdefault(r["_g"], {})[r["_c"]] = [(s["low"], s["high"]) for s in r["_spans"]]

    def counted(batches):
        for g, x in _blocks(batches):
            c_, i_, v_, n_ = [], [], [], []
            for c, of in bounds.get(g, {}).items():
                v = x[:, c]
                for i, (low, high) in enumerate(of):
                    near, many = np.unique(v[(v >= low) & (v <= high)], return_counts=True)
                    below = int((v < low).sum())
                    near, many = (np.r_[np.nan, near], np.r_[below, many]) if below else (near, many)
                    c_.append(np.full(len(near), c)), i_.append(np.full(len(near), i)), v_.append(near), n_.append(many)
            if c_:
                yield pd.DataFrame({"_g": g, **{k: np.concatenate(a) for k, a in (("_c", c_), ("_i", i_), ("_v", v_), ("_n", n_))}})

    rows = wide.mapInPandas(counted, "_g string, _c int, _i int, _v double, _n long") \
        .withColumn("_v", F.nanvl("_v", F.lit(None).cast("double"))).groupBy("_g", "_c", "_i", "_v").agg(F.sum("_n").alias("_n"))
    name = F.element_at(F.array(*[F.lit(c) for c in columns]), F.col("_c") + 1)
    return cut(_at_ranks(rows, spans, ["_g", "_c"])).select(F.col("_g").alias(group), name.alias("column"), F.col("_p").alias("p"), _interpolated().alias("q"))


def _blocks(batches):
    """(group, values of its rows) of wide rows, BLOCK_ROWS rows at a time."""
    def split(held):
        b = pd.concat(held) if len(held) > 1 else held[0]
        x = b.iloc[:, 1:].to_numpy(dtype=float)
        for g, at in b.reset_index(drop=True).groupby("_g", dropna=False, sort=False).indices.items():
            yield None if pd.isna(g) else g, x[at]

    held, rows = [], 0
    for b in batches:
        held, rows = [*held, b], rows + len(b)
        if rows >= BLOCK_ROWS:
            yield from split(held)
            held, rows = [], 0
    if rows:
        yield from split(held)


def _counted(base: DataFrame, spans: DataFrame, ks) -> DataFrame:
    """(keys, _i, _v, _n): how often each value inside a span comes; the null value counts
    all rows below the span."""
    s = spans.select(*[F.col(k).alias(f"_s{k}") for k in ks], "_spans")
    s = F.broadcast(s) if spans.count() <= FEW_GROUPS else s
    inside = base.join(s, _same(base, s, [(k, f"_s{k}") for k in ks])).select(*ks, "_v", F.explode("_spans").alias("_s")) \
        .filter(F.col("_s.high").isNull() | (F.col("_v") <= F.col("_s.high")))
    below = F.col("_s.low").isNotNull() & (F.col("_v") < F.col("_s.low"))
    return inside.select(*ks, F.col("_s.i").alias("_i"), F.when(~below, F.col("_v")).alias("_v")) \
        .groupBy(*ks, "_i", "_v").agg(F.count(F.lit(1)).alias("_n"))


def _at_ranks(counted: DataFrame, spans: DataFrame, ks) -> DataFrame:
    """(keys, _p, _frac, _x0, _x1): the values at the wanted ranks' lower and upper
    neighbour, null where they lie outside the group's spans."""
    ks = [*ks, "_i"]
    # checkpointed, so that a row's partition number stays what it is
    placed = cut(counted.repartitionByRange(*ks, F.col("_v").asc_nulls_first())).withColumn("_pid", F.spark_partition_id())
    parts = placed.groupBy(*ks, "_pid").agg(F.sum("_n").alias("_m"))
    w = Window.partitionBy(*ks).orderBy("_pid")     # one row per partition and group
    parts = parts.withColumn("_before", F.sum("_m").over(w) - F.col("_m"))
    # wanted ranks: p * (n - 1) and its neighbours
    pos = F.col("_p") * (F.col("_total") - 1)
    wanted = (spans.select(*ks[:-1], "_total", F.explode("_spans").alias("_s")).select(*ks[:-1], F.col("_s.i").alias("_i"), "_total", F.explode("_s.ps").alias("_p"))
              .withColumns({"_r0": F.floor(pos), "_frac": pos - F.floor(pos)})
              .withColumn("_r1", F.least(F.col("_r0") + 1, F.col("_total") - 1)))
    running = Window.partitionBy(*ks, "_pid").orderBy(F.col("_v").asc_nulls_first())
    upto = placed.withColumn("_upto", F.sum("_n").over(running))
    b = parts.select(*[F.col(k).alias(f"_b{k}") for k in ks], F.col("_pid").alias("_bpid"), "_before")
    ranked = upto.join(b, _same(upto, b, [(k, f"_b{k}") for k in ks]) & (upto["_pid"] == b["_bpid"])) \
        .select(*ks, "_v", (F.col("_before") + F.col("_upto") - F.col("_n")).alias("_lo"),
                (F.col("_before") + F.col("_upto")).alias("_hi"))
    t = wanted.select(*[F.col(k).alias(f"_t{k}") for k in ks], "_p", "_r0", "_r1", "_frac")

    def covers(r):
        return (F.col(r) >= F.col("_lo")) & (F.col(r) < F.col("_hi"))

    hits = t.join(ranked, _same(ranked, t, [(k, f"_t{k}") for k in ks]) & (covers("_r0") | covers("_r1")), "left")
    names = [f"_t{k}" for k in ks]
    return hits.groupBy(*names, "_p", "_frac").agg(F.max(F.when(covers("_r0"), F.col("_v"))).alias("_x0"),
                                                   F.max(F.when(covers("_r1"), F.col("_v"))).alias("_x1")) \
        .select(*[F.col(f"_t{k}").alias(k) for k in ks[:-1]], "_p", "_frac", "_x0", "_x1")
