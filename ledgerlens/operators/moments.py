"""Counts, means and centred co-moments of many columns at once.

One scan gives a buffer per group: the number of rows, every column's mean, least and
greatest value, and the sums of products of deviations from the means. Buffers merge
pairwise (the deviations are re-centred by the difference of means), so nothing cancels
however large the values are, and means, deviations, correlations, least-squares fits and
their errors all follow from the buffer without another scan.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StructField, StructType


@dataclass
class Moments:
    n: int
    mean: np.ndarray
    c: np.ndarray           # sums of products of deviations
    low: np.ndarray
    high: np.ndarray

    @classmethod
    def of(cls, x: np.ndarray) -> "Moments":
        mean = x.mean(axis=0)
        d = x - mean
        return cls(len(x), mean, d.T @ d, x.min(axis=0), x.max(axis=0))

    def __add__(self, other: "Moments") -> "Moments":
        n, d = self.n + other.n, other.mean - self.mean
        return Moments(n, self.mean + d * (other.n / n), self.c + other.c + np.outer(d, d) * (self.n * other.n / n),
                       np.minimum(self.low, other.low), np.maximum(self.high, other.high))

    @property
    def std(self) -> np.ndarray:
        """Population deviations; 0 exactly where a column is constant."""
        return np.where(self.low == self.high, 0.0, np.sqrt(np.diag(self.c) / self.n))

    def corr(self, at: int) -> np.ndarray:
        """Correlation of every column with column ``at``; NaN where one is constant or missing."""
        s = np.where(self.std > 0, np.sqrt(np.diag(self.c)), np.nan)
        return self.c[at] / (s * s[at])


_PARTS = ("mean", "c", "low", "high")


def _row(m: Moments) -> dict:
    return {"n": m.n, **{p: getattr(m, p).ravel().tolist() for p in _PARTS}}


def _moments(r) -> Moments:
    k = len(r["mean"])
    return Moments(int(r["n"]), *(np.array(r[p], dtype=float).reshape((k, k) if p == "c" else (k,)) for p in _PARTS))


def co_moments(df: DataFrame, columns, keys) -> DataFrame:
    """(keys, n, mean, c, low, high): one row per group of ``keys``, the co-moments of
    ``columns`` (doubles; a missing value makes its column's numbers NaN). Buffers are
    formed per partition, from Arrow batches, and merged in two levels, so that no task
    merges those of all partitions."""
    columns, keys = list(columns), list(keys)
    names = [f"_k{i}" for i in range(len(keys))]
    src = df.select(*[F.col(f"`{k}`").alias(a) for k, a in zip(keys, names)], *[F.col(f"`{c}`").cast("double").alias(f"_c{i}") for i, c in enumerate(columns)])
    buffer = [StructField("n", LongType()), *[StructField(p, ArrayType(DoubleType())) for p in _PARTS]]
    key_fields = [src.schema[a] for a in names]

    def form(batches):
        held: dict = {}
        for b in batches:
            for key, g in b.groupby(names, dropna=False):
                m = Moments.of(g.iloc[:, len(names):].to_numpy(dtype=float))
                key = tuple(None if pd.isna(x) else x for x in key)
                held[key] = held[key] + m if key in held else m
        if held:
            yield pd.DataFrame([{**dict(zip(names, k)), "part": 0, **_row(m)} for k, m in held.items()])

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = [_moments(r) for _, r in pdf.iterrows()]
        out = rows[0]
        for m in rows[1:]:
            out = out + m
        first = pdf.iloc[0]
        return pd.DataFrame([{**{a: first[a] for a in names}, "part": 0, **_row(out)}])

    schema = StructType([*key_fields, StructField("part", IntegerType()), *buffer])
    parts = src.mapInPandas(form, schema).withColumn("part", F.pmod(F.spark_partition_id(), F.lit(64)))
    merged = parts.groupBy(*names, "part").applyInPandas(merge, schema).groupBy(*names).applyInPandas(merge, schema)
    return merged.select(*[F.col(a).alias(k) for a, k in zip(names, keys)], "n", *_PARTS)


def collected(df: DataFrame, keys) -> dict[tuple, Moments]:
    """The buffers of ``co_moments`` on the driver, one per group: {key: Moments}."""
    return {tuple(r[k] for k in keys): _moments(r) for r in df.collect()}


def ridge(m: Moments, mu: np.ndarray, sd: np.ndarray, k: int, y: int, alpha: float | None) -> tuple[float, np.ndarray]:
    """(intercept, coefficients) over the first ``k`` columns, standardised by ``mu`` and
    ``sd`` (the group's own): least squares, penalised by ``alpha`` if given."""
    cxx, cxy = m.c[:k, :k] / np.outer(sd, sd), m.c[:k, y] / sd
    beta = np.linalg.pinv(cxx) @ cxy if alpha is None else np.linalg.solve(cxx + alpha * np.eye(k), cxy)
    return float(m.mean[y] - (m.mean[:k] - mu) / sd @ beta), beta


def r2(m: Moments, mu: np.ndarray, sd: np.ndarray, k: int, y: int, b0: float, beta: np.ndarray) -> float:
    """1 - SSE / SST of a fit on another group's rows; NaN for a constant target."""
    shift = m.mean[y] - b0 - (m.mean[:k] - mu) / sd @ beta
    cxx, cxy = m.c[:k, :k] / np.outer(sd, sd), m.c[:k, y] / sd
    sse = m.c[y, y] - 2 * beta @ cxy + beta @ cxx @ beta + m.n * shift ** 2
    return float(1.0 - sse / m.c[y, y]) if m.low[y] < m.high[y] else float("nan")
