"""Vector helpers of operators 9 and 10."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vec: Column) -> Column:
    """Not null, not all zero, every component finite."""
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vec.isNotNull() & ~bad & F.exists(vec, lambda x: x != 0), F.lit(False))


def matrix(series) -> np.ndarray:
    """Rows of equal length as doubles."""
    return np.stack(series.to_list()).astype(np.float64)


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows; their length is a power of two."""
    n, d = x.shape
    h = 1
    while h < d:
        x = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(n, d)
        h *= 2
    return x / np.sqrt(d)
