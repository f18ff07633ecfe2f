"""Operator 2: SimHash near-duplicates by a segment-popcount embedding.

A fingerprint's 64 bits are cut into 32 segments of two bits; the bit counts of
the segments (0, 1 or 2 each) place it in a 32-dimensional grid. The Manhattan
distance of two such points is a lower bound of the Hamming distance, so every
pair within ``max_bits`` lies within Manhattan distance ``max_bits``.

Grid range join: the 32 coordinates form ``groups`` groups; points within
distance d differ in at most d groups, so they share a cell (equal coordinates)
for at least one choice of ``groups - d`` groups. Every fingerprint goes to one
cell per choice; in a cell the Manhattan bound is tested, then the exact
distance. Nothing is lost and no bucket is capped: a cell of more than ``block``
fingerprints is cut into blocks that are compared two at a time.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import cut, text_batches
from .graph import connected_components

EVEN = 0x5555555555555555


def fingerprint(raw: bytes | None, shingle: int = 4) -> int:
    """SimHash of a text's UTF-8 bytes: A-Z lower-cased, words split at ASCII white
    space, shingles with repeats, XXH64 with seed 42; a bit is set if set in over
    half the hashes. No words: 0. Fewer words than a shingle: the whole sequence."""
    words = raw.lower().split() if raw else []
    if not words:
        return 0
    joined = b" ".join(words)
    k = min(shingle, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    starts, ends = starts[:len(words) - k + 1].tolist(), ends[k - 1:].tolist()
    digest = xxhash.xxh64_digest
    ones, step = np.zeros(64, np.int64), 1 << 14
    for i in range(0, len(starts), step):
        hashes = b"".join([digest(joined[s:e], 42) for s, e in zip(starts[i:i + step], ends[i:i + step])])
        ones += np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(starts))
    return int.from_bytes(bits.tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int = 4) -> DataFrame:
    """(id, fp): the fingerprint of every row's whole text as a signed long; ids of any type
    pass as they are. A null text counts as empty; rows with a null or repeated id stay."""
    src = text_batches(docs).select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("raw"))

    def run(batches):
        for b in batches:
            fp = np.fromiter((fingerprint(x, shingle) for x in b.column(1).to_pylist()), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], names=["id", "fp"])

    return src.mapInArrow(run, StructType([StructField("id", src.schema["id"].dataType), StructField("fp", LongType())]))


def thermometer(x: Column) -> Column:
    """The embedded point: each two-bit segment's count as 00, 01 or 11, so that the
    Manhattan distance of two points is the number of differing bits."""
    half = F.shiftrightunsigned(x, 1)
    low = x.bitwiseOR(half).bitwiseAND(F.lit(EVEN))
    high = x.bitwiseAND(half).bitwiseAND(F.lit(EVEN))
    return low.bitwiseOR(F.shiftleft(high, 1))


def cell_masks(max_bits: int, groups: int) -> list[int]:
    """One mask per choice of ``groups - max_bits`` coordinate groups, as signed longs."""
    parts = np.array_split(np.arange(32), groups)
    one = [sum(3 << (2 * int(s)) for s in p) for p in parts]
    out = [sum(one[g] for g in pick) for pick in combinations(range(groups), groups - max_bits)]
    return [m - (1 << 64) if m >> 63 else m for m in out]


def local_roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest node reachable from each of the nodes 0..n-1 over the edges a-b."""
    root = np.arange(n)
    while len(a):
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        open_ = low != high
        if not open_.any():
            break
        a, b = a[open_], b[open_]
        np.minimum.at(root, high[open_], low[open_])
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
    return root


def near(t, fp, i, j, max_bits: int) -> np.ndarray:
    """Manhattan bound of the embedded points, then the exact distance where it holds."""
    ok = np.bitwise_count(t[i] ^ t[j]) <= max_bits
    at = np.flatnonzero(ok)
    i, j = (x if np.isscalar(x) else x[at] for x in (i, j))
    exact = np.bitwise_count(fp[i] ^ (fp[j] if np.isscalar(j) else fp[j])) <= max_bits
    ok[at] = exact
    return ok


def cell_links(fp: np.ndarray, start: np.ndarray, end: np.ndarray, max_bits: int, small: int = 128):
    """Roots of the rows (cells are the runs start..end, given per row): a spanning
    set of the links inside the cells. Small cells are compared all at once; in a
    larger one a search walks from row to row, and rows once reached are not
    compared again, so a dense cell costs far less than its pairs."""
    n = len(fp)
    half = fp >> np.uint64(1)
    even = np.uint64(EVEN)
    t = ((fp | half) & even) | (((fp & half) & even) << np.uint64(1))
    i, k, la, lb = np.flatnonzero((end - start > 1) & (end - start <= small)), 1, [], []
    while len(i):
        i = i[i + k < end[i]]
        ok = near(t, fp, i, i + k, max_bits)
        la.append(i[ok])
        lb.append(i[ok] + k)
        k += 1
    for s in np.unique(start[end - start > small]):
        left = np.arange(s, end[s])
        while len(left):
            queue, left = [left[0]], left[1:]
            while queue and len(left):
                at = queue.pop()
                ok = near(t, fp, left, at, max_bits)
                if ok.any():
                    la.append(np.full(int(ok.sum()), at))
                    lb.append(left[ok])
                    queue.extend(left[ok].tolist())
                    left = left[~ok]
    if not la:
        return np.arange(n)
    return local_roots(np.concatenate(la), np.concatenate(lb), n)


def simhash_links(fps: DataFrame, max_bits: int, groups: int, block: int) -> DataFrame:
    """(a, b): links that connect whatever distinct fingerprints ``fps`` (column fp)
    within ``max_bits`` connect; a spanning set per cell, not all pairs."""
    masks = cell_masks(max_bits, groups)
    spot = F.array(*[F.struct(F.lit(i).alias("c"), F.col("t").bitwiseAND(F.lit(m)).alias("p"))
                     for i, m in enumerate(masks)])
    cells = fps.select("fp", thermometer(F.col("fp")).alias("t")).select("fp", F.explode(spot).alias("s")) \
        .select("fp", F.xxhash64("s.c", "s.p").alias("cell"))
    large = (cells.groupBy("cell").agg(F.count("fp").alias("n")).filter(F.col("n") > block)
             .select("cell", F.ceil(F.col("n") / block).cast("int").alias("nb")))
    mine = F.pmod(F.xxhash64("fp"), F.col("nb")).cast("int")
    dealt = (cells.join(large, "cell", "left")
             .withColumn("nb", F.coalesce("nb", F.lit(1)))
             .withColumn("mine", mine)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
             .select("fp", F.xxhash64("cell", F.least("mine", "other"), F.greatest("mine", "other")).alias("cell")))

    def run(batches):
        def links(cell, fp):
            cut_at = np.flatnonzero(np.diff(cell)) + 1
            first = np.concatenate(([0], cut_at))
            last = np.concatenate((cut_at, [len(cell)]))
            size = last - first
            root = cell_links(fp.view(np.uint64), np.repeat(first, size), np.repeat(last, size), max_bits)
            i = np.flatnonzero(root != np.arange(len(root)))
            pairs = np.unique(np.stack([fp[i], fp[root[i]]], axis=1), axis=0) if len(i) else np.zeros((0, 2), np.int64)
            return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

        cell, fp, held = np.zeros(0, np.int64), np.zeros(0, np.int64), []
        rows = 0
        for b in batches:
            held.append(b)
            rows += len(b)
            if rows < 100_000:
                continue
            cell = np.concatenate([cell, *(x["cell"].to_numpy() for x in held)])
            fp = np.concatenate([fp, *(x["fp"].to_numpy() for x in held)])
            held, rows = [], 0
            whole = int(np.searchsorted(cell, cell[-1]))    # rows of a partition are sorted by cell
            if whole:
                yield links(cell[:whole], fp[:whole])
                cell, fp = cell[whole:], fp[whole:]
        cell = np.concatenate([cell, *(x["cell"].to_numpy() for x in held)])
        fp = np.concatenate([fp, *(x["fp"].to_numpy() for x in held)])
        if len(cell):
            yield links(cell, fp)

    return dealt.repartition("cell").sortWithinPartitions("cell").mapInPandas(run, "a long, b long")


def spare_groups(fingerprints: int) -> int:
    """Groups of coordinates beyond ``max_bits``: all of them but max_bits make a cell, so a
    cell holds about 2^-15, 2^-20, 2^-24 ... of random fingerprints for 2, 3, 4 ... of them;
    enough that a cell of random fingerprints stays below some hundreds."""
    return next((g for g, most in ((2, 8e6), (3, 2.5e8), (4, 4e9)) if fingerprints <= most), 5)


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                       max_bits: int = 4, groups: int | None = None, block: int = 16_384) -> DataFrame:
    """One row per row of ``docs``: id, fingerprint (16 hex digits), component_id.

    ``component_id`` is the smallest id reachable over fingerprints that differ in
    at most ``max_bits`` bits, the row's own included. Null, empty and white-space
    texts have fingerprint zero and are linked like any other. Rows that repeat an
    id keep a row each; a null id never becomes a component's id unless all ids of
    the component are null (then it is null). Other columns are ignored. An empty
    table gives an empty result. ``groups`` trades cells per fingerprint against their
    size (by default it grows with the number of fingerprints); the result does not
    depend on it."""
    rows = cut(fingerprints(docs, id_col, text_col, shingle))
    reps = cut(rows.groupBy("fp").agg(F.min("id").alias("least")))
    groups = groups or max_bits + spare_groups(reps.count())
    roots = connected_components(simhash_links(reps.select("fp"), max_bits, groups, block), "a", "b")
    placed = reps.join(roots, reps["fp"] == roots["node"], "left") \
        .select("fp", "least", F.coalesce("root", "fp").alias("root"))
    placed = cut(placed)
    # checkpointed first, so that a giant component's rows aren't dealt by its root already
    least = cut(placed.groupBy("root").agg(F.min("least").alias("component_id")))
    # a table of its own, so that the last join's sides are plain shuffles and a hot fingerprint is split
    of = cut(placed.select("fp", "root").join(least, "root").select("fp", "component_id"))
    return rows.join(of, "fp").select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                                      "component_id")
