"""Operator 10: near-duplicate embeddings by cross-polytope hashing.

A unit vector is rotated pseudo-randomly (three rounds of random signs and a fast
Hadamard transform); its hash is the axis, with sign, that the rotated vector is
nearest to. A table joins ``hashes`` such values to a bucket within the label, and
there are ``tables`` of them. Multiprobe: a vector also visits the buckets that are
next best, those whose replaced axis falls least behind. A pair that meets in a
bucket (one of the two at home there) is verified by its cosine.

Equal vectors of a label are merged first. Buckets are never capped: one with more
than ``block`` visitors is cut into blocks that are compared two at a time. A pair
is counted in the first table in which it meets, where both rows' hash values tell,
so a task puts out a count and a local component per row, never the pairs.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, numbered
from .graph import connected_components
from .simhash import local_roots
from .vectors import hadamard, matrix, usable


def hash_codes(x: np.ndarray, tables: int, hashes: int, probes: int, seed: int) -> np.ndarray:
    """(rows, tables, 1 + probes) bucket codes of unit vectors: home, then the next best
    ones, in which one of the values is replaced by its runner-up or third."""
    n, d = x.shape
    size = 1 << max(1, (d - 1).bit_length())
    x = np.pad(x, ((0, 0), (0, size - d)))
    rng, out = np.random.default_rng(seed), np.empty((n, tables, 1 + probes), np.int64)
    rows = np.arange(n)[:, None]
    for t in range(tables):
        home, other, behind = np.zeros(n, np.int64), [], []
        for h in range(hashes):
            y = x
            for _ in range(3):
                y = hadamard(y * rng.choice([-1.0, 1.0], size))
            size_of = np.abs(y)
            top = np.argsort(-size_of, axis=1, kind="stable")[:, :3]
            value = top * 2 + (y[rows, top] < 0)
            weight = (2 * size) ** h
            home += value[:, 0] * weight
            for j in range(1, top.shape[1]):
                other.append((value[:, j] - value[:, 0]) * weight)
                behind.append(size_of[rows[:, 0], top[:, 0]] - size_of[rows[:, 0], top[:, j]])
        best = np.argsort(np.stack(behind, axis=1), axis=1, kind="stable")[:, :probes]
        out[:, t, 0] = home
        more = home[:, None] + np.take_along_axis(np.stack(other, axis=1), best, axis=1)
        out[:, t, 1:] = np.pad(more, ((0, 0), (0, probes - more.shape[1])), mode="edge")
    return out


def meets(codes: np.ndarray, a: np.ndarray, b: np.ndarray, t: int) -> np.ndarray:
    """Whether rows a and b meet in table t: one's home is among the other's buckets."""
    x, y = codes[a, t], codes[b, t]
    return (x[:, :1] == y).any(axis=1) | (x == y[:, :1]).any(axis=1)


def counted_here(codes, a, b, t: int, bucket) -> np.ndarray:
    """Whether the pair's first meeting is this bucket of table t."""
    ok = np.ones(len(a), bool)
    for s in range(t):
        ok &= ~meets(codes, a, b, s)
    x, y = codes[a, t], codes[b, t]
    at_a = (x[:, :1] == y).any(axis=1)      # a's home counts as a meeting place
    at_b = (x == y[:, :1]).any(axis=1)
    here_a, here_b = at_a & (x[:, 0] == bucket), at_b & (y[:, 0] == bucket)
    both = at_a & at_b
    return ok & np.where(both, np.minimum(x[:, 0], y[:, 0]) == bucket, here_a | here_b)


def group_links(vec, codes, home, mine, weight, first, last, table, bucket, split, least: float, small: int = 64):
    """Per row of a batch of whole groups: links (weighted by the other row's copies) and
    a local root. first/last: a row's group; split: whether two blocks meet there."""
    n = len(vec)
    links, roots = np.zeros(n, np.int64), np.arange(n)

    def take(a, b):
        nonlocal roots
        ok = (home[a] | home[b]) & (~split[a] | (mine[a] != mine[b]))
        a, b = a[ok], b[ok]
        cos = np.einsum("ij,ij->i", vec[a], vec[b]) if len(a) else np.zeros(0)
        near = cos >= least
        a, b = a[near], b[near]
        if not len(a):
            return
        for t in np.unique(table[a]):
            at = table[a] == t
            ok = counted_here(codes, a[at], b[at], int(t), bucket[a[at]])
            i, j = a[at][ok], b[at][ok]
            links[:] += np.bincount(i, weight[j], n).astype(np.int64) + np.bincount(j, weight[i], n).astype(np.int64)
        up = local_roots(np.concatenate([a, np.arange(n)]), np.concatenate([b, roots]), n)
        roots = up

    i, k = np.flatnonzero((last - first > 1) & (last - first <= small)), 1
    pa, pb = [], []
    while len(i):
        i = i[i + k < last[i]]
        pa.append(i)
        pb.append(i + k)
        k += 1
        if sum(map(len, pa)) > 200_000:
            take(np.concatenate(pa), np.concatenate(pb))
            pa, pb = [], []
    if pa:
        take(np.concatenate(pa), np.concatenate(pb))
    for s, e in sorted({(int(f), int(l)) for f, l in zip(first, last) if l - f > small}):
        step = max(1, 400_000 // (e - s))
        for r in range(s, e, step):
            cos = vec[r:min(r + step, e)] @ vec[r:e].T
            a, b = np.nonzero(cos >= least - 1e-9)
            a, b = a + r, b + r
            up = b > a
            take(a[up], b[up])
    return links, roots


def widths(vectors: int) -> tuple[int, int]:
    """(tables, hashes a table) that keep random buckets small, each pair of them with a
    miss rate of a few in a million for a pair at the threshold."""
    return next((w for w, most in (((6, 2), 5e7), ((9, 3), 5e9)) if vectors <= most), (13, 4))


def near_duplicate_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                           least: float = 0.98, tables: int | None = None, hashes: int | None = None, probes: int = 2, block: int = 2048,
                           seed: int = 10) -> DataFrame:
    """One row per row of ``vectors``: id, n_links (other rows linked directly),
    component_id (smallest id reachable, its own included), kept (id = component_id).

    Rows link if their labels are equal and not null and the cosine of their vectors,
    in double precision, is ``least`` or more. Vectors that are null, zero or hold a
    null or non-finite component, and vectors of different lengths, link with nothing.
    Repeated rows link with each other; a null id is kept only if it stands alone.
    Empty table: empty result. Other columns are ignored. ``tables`` and ``hashes`` a table
    grow with the number of distinct vectors by default (``widths``)."""
    v = F.col("v")
    rows = cut(vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"),
                              F.col(label_col).alias("label"))
               .withColumn("on", usable(v) & F.col("label").isNotNull())
               .withColumns({"h1": F.when(F.col("on"), F.xxhash64("label", "v")),
                             "h2": F.when(F.col("on"), F.xxhash64(F.lit(seed), "v", "label"))}))
    reps = numbered(rows.filter("on").groupBy("h1", "h2").agg(
        F.count(F.lit(1)).alias("n"), F.min("id").alias("least_id"), F.first("label").alias("label"), F.first("v").alias("v")), "row")

    by_size = widths(reps.count())
    tables, hashes = tables or by_size[0], hashes or by_size[1]

    @F.pandas_udf("binary")
    def codes_of(v: pd.Series) -> pd.Series:
        out = pd.Series([b""] * len(v), dtype=object)
        for d, at in v.groupby(v.map(len)).groups.items():
            x = matrix(v.loc[at])
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            c = hash_codes(x, tables, hashes, probes, seed)
            for i, row in zip(at, c):
                out.loc[i] = row.tobytes()
        return out

    @F.pandas_udf("array<long>")
    def longs(b: pd.Series) -> pd.Series:
        return b.map(lambda x: np.frombuffer(x, np.int64))

    reps = cut(reps.withColumn("codes", codes_of("v")))
    wide = 1 + probes
    light = reps.select("row", "label", F.size("v").alias("dim"), F.posexplode(longs("codes")).alias("p", "code")) \
        .withColumn("t", F.floor(F.col("p") / wide).cast("int")).withColumn("home", F.col("p") % wide == 0) \
        .withColumn("key", F.xxhash64("label", "dim", "t", "code")).select("row", "key", "t", "code", "home")
    full = light.groupBy("key").agg(F.count("row").alias("n"), F.max("home").alias("any")).filter("n > 1 and any") \
        .select("key", F.ceil(F.col("n") / block).cast("int").alias("nb"))
    visits = light.join(full, "key").withColumn("mine", F.pmod(F.xxhash64("row"), F.col("nb")).cast("int")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1))) \
        .select("row", F.struct(F.xxhash64("key", F.least("mine", "other"), F.greatest("mine", "other")).alias("bin"), "t", "code",
                                "home", "mine", (F.col("mine") != F.col("other")).alias("apart")).alias("x"))
    # the vectors travel once per bucket that has company
    met = reps.select("row", "n", "v", "codes").join(visits, "row").select("row", "n", "v", "codes", "x.*")

    def run(batches):
        def links(b: pd.DataFrame) -> pd.DataFrame:
            out = []
            for _, g in b.groupby(b["v"].map(len), sort=False):
                bins = g["bin"].to_numpy()
                edge = np.flatnonzero(np.diff(bins)) + 1
                first, last = np.concatenate(([0], edge)), np.concatenate((edge, [len(bins)]))
                size = last - first
                vec = matrix(g["v"])
                vec /= np.linalg.norm(vec, axis=1, keepdims=True)
                codes = np.frombuffer(b"".join(g["codes"]), np.int64).reshape(len(g), tables, wide)
                apart = g["apart"].to_numpy()
                split = np.repeat(np.logical_or.reduceat(apart, first), size)
                n, root = group_links(vec, codes, g["home"].to_numpy(), g["mine"].to_numpy(), g["n"].to_numpy(),
                                      np.repeat(first, size), np.repeat(last, size), g["t"].to_numpy(), g["code"].to_numpy(),
                                      split, least)
                row = g["row"].to_numpy()
                some = (n > 0) | (root != np.arange(len(root)))
                out.append(pd.DataFrame({"row": row[some], "root": row[root[some]], "n": n[some]}))
            return pd.concat(out)

        held = []
        for b in batches:
            held.append(b)
            if sum(map(len, held)) < 20_000:
                continue
            whole = pd.concat(held)
            done = (whole["bin"] != whole["bin"].iloc[-1]).to_numpy()   # rows of a partition are sorted by bin
            if done.any():
                yield links(whole[done])
            held = [whole[~done]]
        if held and sum(map(len, held)):
            yield links(pd.concat(held))

    found = cut(met.repartition("bin").sortWithinPartitions("bin").mapInPandas(run, "row long, root long, n long"))
    number = found.groupBy("row").agg(F.sum("n").alias("others"))
    parts = connected_components(found, "row", "root")
    placed = reps.select("row", "h1", "h2", F.col("n").alias("copies"), "least_id").join(number, "row", "left") \
        .join(parts.withColumnRenamed("node", "row"), "row", "left").withColumn("root", F.coalesce("root", "row"))
    placed = cut(placed)
    # checkpointed first, so that a giant component's rows aren't dealt by its root already
    smallest = cut(placed.groupBy("root").agg(F.min("least_id").alias("component_id")))
    links = F.coalesce("others", F.lit(0)) + F.col("copies") - 1
    of = cut(placed.join(smallest, "root").select("h1", "h2", "component_id", links.alias("n_links")))
    out = rows.drop("v", "label").join(of, ["h1", "h2"], "left")
    component = F.when(F.col("on"), F.col("component_id")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
