"""Forward event-window as-of join.

For each anchor (key, ts) -- a filing date per ticker -- the mean of the
first ``n`` price rows with ts >= anchor ts (ties broken by ``seq``); no such
row -> NULL. Re-expressed without a theta join and without one window over a
whole key, so a key holding a large share of all rows still spreads over many
tasks:

1. prices get a time bucket (``date_trunc(bucket, ts)``) and a local rank
   inside (key, bucket) -- windows only ever span one bucket;
2. a small (key, bucket) count table (one row per non-empty bucket) yields each
   bucket's rank offset with a running sum, so global rank = offset + local;
3. each anchor finds the first price at/after it inside its own bucket
   (descending running min over the bucket), or else the first price of any
   later bucket = the bucket's cumulative count + 1;
4. anchors are expanded to their n target ranks (n is a fixed small constant)
   and equi-joined to prices on (key, global rank) -- unique keys on the price
   side, so there is no skew on that join -- then averaged per anchor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def forward_window_mean(anchors: DataFrame, prices: DataFrame, values=("close",), n: int = 5,
                        key: str = "key", ts: str = "ts", seq: str = "seq", anchor_id: str = "anchor_id",
                        bucket: str = "day", out_prefix: str = "mean_next") -> DataFrame:
    """anchors(anchor_id, key, ts, ...) -> anchors + mean_next[_v] + n_used.

    Large shuffles: the price+anchor union once by (key, bucket) -- both
    windows and the bucket counts reuse that partitioning -- and the prices
    once more by (key, global rank) for the target join. Everything else
    moves one row per bucket or per anchor.
    """
    values = list(values)
    b = lambda c: F.date_trunc(bucket, F.col(c))
    vcols = [f"_v{i}" for i in range(len(values))]
    pv = prices.select(F.col(key).alias("_k"), F.col(ts).alias("_ts"), F.col(seq).alias("_seq"),
                       *[F.col(v).cast("double").alias(c) for v, c in zip(values, vcols)])
    av = anchors.select(F.col(anchor_id).alias("_aid"), F.col(key).alias("_k"), F.col(ts).alias("_ts"))
    aid_t, seq_t = av.schema["_aid"].dataType, pv.schema["_seq"].dataType
    u = (pv.select("_k", "_ts", "_seq", F.lit(0).alias("_kind"), F.lit(None).cast(aid_t).alias("_aid"), *vcols)
         .unionByName(av.select("_k", "_ts", F.lit(None).cast(seq_t).alias("_seq"), F.lit(1).alias("_kind"),
                                "_aid", *[F.lit(None).cast("double").alias(c) for c in vcols]))
         .withColumn("_b", b("_ts")))
    # 1 + 3. inside (key, bucket): local rank of prices (ascending) and, for each
    # anchor, the smallest local rank at/after it (descending running min; at
    # equal ts prices sort before anchors so they count as "at or after").
    wb = Window.partitionBy("_k", "_b")
    is_p = F.col("_kind") == 0
    u = u.withColumn("_lr", F.when(is_p, F.sum(is_p.cast("int")).over(
        wb.orderBy("_kind", "_ts", "_seq").rowsBetween(Window.unboundedPreceding, 0))))
    u = u.withColumn("_nl", F.min("_lr").over(
        wb.orderBy(F.desc("_ts"), F.asc("_kind"), F.desc("_seq")).rowsBetween(Window.unboundedPreceding, 0)))
    # 2. bucket offsets: counts per (key, bucket) -> running sum per key (one row per bucket)
    cnt = u.groupBy("_k", "_b").agg(F.sum(is_p.cast("long")).alias("_c"))
    cnt = cnt.withColumn("_thru", F.sum("_c").over(
        Window.partitionBy("_k").orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)))
    u = u.join(cnt.select("_k", "_b", "_thru", (F.col("_thru") - F.col("_c")).alias("_before")), ["_k", "_b"])
    pg = u.filter(is_p).select("_k", (F.col("_before") + F.col("_lr")).alias("_gr"), *vcols)
    nxt = u.filter(~is_p).select("_aid", "_k", F.when(F.col("_nl").isNotNull(), F.col("_before") + F.col("_nl"))
                                 .otherwise(F.col("_thru") + 1).alias("_r0"))
    # 4. the n target ranks per anchor -> unique-key join to prices -> mean
    tgt = nxt.select("_aid", "_k", F.explode(F.sequence(F.col("_r0"), F.col("_r0") + (n - 1))).alias("_gr"))
    hit = tgt.join(pg, ["_k", "_gr"])
    names = [out_prefix] if len(values) == 1 else [f"{out_prefix}_{v}" for v in values]
    agg = hit.groupBy("_aid").agg(*[F.avg(c).alias(nm) for c, nm in zip(vcols, names)],
                                  F.count(F.lit(1)).alias("n_used"))
    out = anchors.join(agg.withColumnRenamed("_aid", anchor_id), anchor_id, "left")
    return out.withColumn("n_used", F.coalesce(F.col("n_used"), F.lit(0).cast("long")))


def attach_prices(panel: DataFrame, prices: DataFrame, n: int = 5, bucket: str = "month",
                  keys=("ticker", "fy", "fp")) -> DataFrame:
    """J7 on the panel: stock_price / stock_price_unadjusted = mean close of the
    first n trading days on/after ``filed`` (prices: ticker, d, close_adj, close_unadj).

    The panel key (ticker, fy, fp) identifies each anchor, so the result joins
    back deterministically. A missing filing date gets no price.
    """
    aid = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    a = panel.filter(F.col("filed").isNotNull()).select(
        aid.alias("_aid"), F.col("ticker").alias("key"), F.col("filed").cast("timestamp").alias("ts"))
    p = prices.select(F.col("ticker").alias("key"), F.col("d").cast("timestamp").alias("ts"),
                      F.col("d").cast("timestamp").cast("long").alias("seq"), "close_adj", "close_unadj")
    m = forward_window_mean(a, p, values=("close_adj", "close_unadj"), n=n, anchor_id="_aid", bucket=bucket)
    m = m.select("_aid", F.col("mean_next_close_adj").alias("stock_price"),
                 F.col("mean_next_close_unadj").alias("stock_price_unadjusted"))
    drop = [c for c in ("stock_price", "stock_price_unadjusted") if c in panel.columns]
    return panel.drop(*drop).withColumn("_aid", aid).join(m, "_aid", "left").drop("_aid")
