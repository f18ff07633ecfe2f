"""Random draws from hashes: a row's draw depends on its key alone, wherever it lies."""

from __future__ import annotations

import numpy as np


def mixed(x: np.ndarray) -> np.ndarray:
    """64 well-mixed bits of each 64-bit integer."""
    with np.errstate(over="ignore"):
        x = x + np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


#: Probabilities of at most 0, 1, 2, ... events of a Poisson law of mean 1.
AT_MOST = np.cumsum([np.exp(-1.0) / f for f in np.cumprod([1.0, *range(1, 12)])])


def poisson_weights(key: np.ndarray, draws, seed: int) -> np.ndarray:
    """Poisson(1) numbers, a row per key (a long hash of a table's row) and a column per draw."""
    draws = np.atleast_1d(np.asarray(draws)).astype(np.uint64)
    u = mixed(key.astype(np.int64).view(np.uint64)[:, None] ^ mixed(draws + np.uint64(seed << 20))) / 2.0 ** 64
    return np.searchsorted(AT_MOST, u.ravel(), side="right").reshape(u.shape).astype(np.int64)
