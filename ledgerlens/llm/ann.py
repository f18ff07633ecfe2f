"""Operator 9: nearest neighbours by collision-counting hashing.

Every vector is projected on ``projections`` random lines; each line keeps a sorted
array. A query opens a window around its own place on every line and widens all
windows together (virtual rehashing: a wider window is a coarser hash, without
building it). A vector found in at least ``threshold`` of a query's windows is
verified by its exact distance. A query ends when its k-th verified distance is
within the radius R of its windows, so a vector at distance R or less has been found
with probability ``confidence`` at least (the threshold is set from that), or when
the windows hold everything.

Vectors are dealt to shards and queries to blocks by hash, both of bounded size; each
(shard, block) pair is one group of a cogrouped job, whatever the number of rows. A
group sorts its shard's lines once and answers its block's queries ``STEP`` at a time.
All rows are indexed, none is sampled; every query meets every shard, as a stated query
set against all rows has to.
"""

from __future__ import annotations

from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import numbered
from .vectors import matrix, usable

HALF = 1.0      # a window's half width is HALF * R
GROWTH = 1.3
STEP = 128      # queries that a group answers together: what they have seen stays in a core's cache


def threshold(projections: int, confidence: float) -> int:
    """Collisions that a vector at distance R has with probability ``confidence``."""
    p = 2 * NormalDist().cdf(HALF) - 1
    return max(1, int(projections * p + NormalDist().inv_cdf(1 - confidence) * (projections * p * (1 - p)) ** 0.5))


class SortedLines:
    """The sorted projections of one shard."""

    def __init__(self, x: np.ndarray, lines: np.ndarray):
        p = x @ lines.T
        order = np.argsort(p, axis=0, kind="stable").T
        self.x, self.lines, self.n, self.m = x, lines, len(x), len(lines)
        self.values = np.take_along_axis(p.T, order, axis=1)
        self.order = order.astype(np.int32).ravel()
        self.base = np.arange(self.m) * self.n

    def search(self, q: np.ndarray, own: np.ndarray, ids: np.ndarray, k: int, least: int):
        """For each query (its own row in the shard or -1) the rows and distances of the
        k nearest verified, ties to smaller ids."""
        n, m = self.n, self.m
        pq = (q @ self.lines.T).T
        place = np.stack([np.searchsorted(self.values[j], pq[j]) for j in range(m)])
        low, high = place.copy(), place.copy()
        # the first radius: windows that hold about k vectors
        first = np.minimum(place + k, n - 1)
        gap = np.abs(np.take_along_axis(self.values, first, axis=1) - pq)
        radius = np.maximum(np.median(gap, axis=0) / HALF, 1e-12)
        seen = np.zeros((len(q), n), np.uint16)
        found = [(np.zeros(0, np.int64), np.zeros(0)) for _ in q]
        for i in np.flatnonzero(own >= 0):
            seen[i, own[i]] = 40_000        # never a candidate of itself
        live = np.arange(len(q))
        while len(live):
            to_low, to_high = low[:, live].copy(), high[:, live].copy()
            for j in range(m):
                c, w = pq[j, live], HALF * radius[live]
                to_low[j] = np.searchsorted(self.values[j], c - w, side="left")
                to_high[j] = np.searchsorted(self.values[j], c + w, side="right")
            to_low, to_high = np.minimum(to_low, low[:, live]), np.maximum(to_high, high[:, live])
            ended = []
            for at, i in enumerate(live):
                start = np.concatenate([self.base + to_low[:, at], self.base + high[:, i]])
                size = np.concatenate([low[:, i] - to_low[:, at], to_high[:, at] - high[:, i]])
                total = int(size.sum())
                if total:
                    steps = np.repeat(start - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(total)
                    before = seen[i] >= least
                    seen[i] += np.bincount(self.order[steps], minlength=n).astype(np.uint16)
                    new = np.flatnonzero((seen[i] >= least) & ~before)
                    if len(new):
                        d = np.sqrt(((self.x[new] - q[i]) ** 2).sum(axis=1))
                        rows, dist = np.concatenate([found[i][0], new]), np.concatenate([found[i][1], d])
                        if len(rows) > k:
                            keep = np.lexsort((ids[rows], dist))[:k]
                            rows, dist = rows[keep], dist[keep]
                        found[i] = rows, dist
                whole = not to_low[:, at].any() and (to_high[:, at] == n).all()
                kth = found[i][1].max() if len(found[i][0]) >= k else np.inf
                if whole or kth <= radius[i]:
                    ended.append(at)
                else:
                    radius[i] = min(GROWTH * radius[i], kth)
            low[:, live], high[:, live] = to_low, to_high
            live = np.delete(live, ended)
        return found


def nearest(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 10,
            projections: int = 128, confidence: float = 0.98, shard: int = 16_384, block: int = 4096, seed: int = 9) -> DataFrame:
    """(query_id, rank, id, score): the k nearest rows found for every row of ``vectors``
    where ``is_query`` holds, by Euclidean distance in double precision, ties to the
    smaller id; all other rows if there are fewer than k.

    Vectors that are null, zero or hold a null or non-finite component take no part,
    nor do rows with a null id; vectors of different lengths are never compared.
    Repeated rows are candidates each (a query is not a candidate of itself, its
    copies are). Empty table or no queries: empty result."""
    rows = numbered(vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("v"), is_query.alias("q"))
                    .filter(F.col("id").isNotNull()).filter(usable(F.col("v"))), "row")
    sizes = rows.agg(F.count("row"), F.count(F.when(F.col("q"), 1))).first()
    shards, blocks = max(1, -(-sizes[0] // shard)), max(1, -(-sizes[1] // block))
    rows = rows.withColumn("dim", F.size("v")).withColumns({
        "s": F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int"),
        "b": F.pmod(F.xxhash64("row", F.lit(1)), F.lit(blocks)).cast("int")})
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("b")
    index = rows.select("dim", "s", every, "row", "id", "v")
    # names of their own: both sides come from one table, and a pruned plan must not mix them up
    asked = rows.filter("q").select(F.col("dim").alias("qdim"), F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("qs"), F.col("b").alias("qb"),
                                    F.col("row").alias("qrow"), F.col("id").alias("query_id"), F.col("v").alias("qv"))
    least = threshold(projections, confidence)

    def run(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = {c: [] for c in ("qrow", "query_id", "id", "score")}
        if len(left) and len(right):
            left, right = left.sort_values("row"), right.sort_values("qrow")
            lines = np.random.default_rng(seed).normal(size=(projections, int(key[0])))
            ids, at = left["id"].to_numpy(), {r: i for i, r in enumerate(left["row"])}
            lines_of = SortedLines(matrix(left["v"]), lines)
            for first in range(0, len(right), STEP):
                part = right.iloc[first:first + STEP]
                own = np.array([at.get(r, -1) for r in part["qrow"]])
                found = lines_of.search(matrix(part["qv"]), own, ids, k, least)
                for r, i, (hit, dist) in zip(part["qrow"], part["query_id"], found):
                    out["qrow"] += [r] * len(hit)
                    out["query_id"] += [i] * len(hit)
                    out["id"] += ids[hit].tolist()
                    out["score"] += dist.tolist()
        return pd.DataFrame(out)

    hits = index.groupBy("dim", "s", "b").cogroup(asked.groupBy("qdim", "qs", "qb")) \
        .applyInPandas(run, "qrow long, query_id long, id long, score double")
    by = Window.partitionBy("qrow").orderBy("score", "id")
    return hits.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k) \
        .select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score")
