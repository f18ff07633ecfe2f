"""Support vector regression of the model search (M8): RBF kernel, epsilon-insensitive loss.

The kernel is spanned by landmark rows (the ``LANDMARKS`` training rows with the
smallest row hash; all rows of a small industry, where nothing is approximated). With
features phi so that phi(a) . phi(b) is the kernel between landmarks, the fit minimises

    |w|^2 / 2 + C * sum max(0, |y - w . phi(x) - b| - epsilon)

for many rows in memory by an interior point method (``interior``), some 15 to 30 steps. For few
rows, and for rows that stay where they are, by Newton steps on the loss with its corners rounded over ``delta``, which
shrinks until it no longer matters: such a step needs sums over rows only and nothing that is
kept per row. ``newton`` is a generator that asks for them, in lock step for all models of
large industries, one Spark pass a question.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StringType, StructField, StructType

from ..constants import SVR_C, SVR_EPSILON

LANDMARKS = 256
CHUNK = 1_024               # rows whose kernel values are made at a time
NEWTON_ROWS = 5_000         # rows up to which Newton steps alone are taken, some hundred sums over them
HELD = 100_000              # rows whose kernel values a task keeps
STEPS = (1.0, 0.5, 0.25, 0.1, 0.03, 0.01, 0.003, 0.001, 1e-4, 1e-5)


class KernelFeatures:
    """phi: rows (standardised) to features, from landmark rows."""

    def __init__(self, landmarks: np.ndarray, gamma: float):
        self.landmarks, self.gamma = landmarks, gamma
        values, vectors = np.linalg.eigh(self._kernel(landmarks))
        keep = values > 1e-10 * values.max()
        self.map = vectors[:, keep] / np.sqrt(values[keep])

    def _kernel(self, x: np.ndarray) -> np.ndarray:
        d = (x ** 2).sum(1)[:, None] + (self.landmarks ** 2).sum(1) - 2 * x @ self.landmarks.T
        return np.exp(-self.gamma * np.maximum(d, 0))

    def values(self, x: np.ndarray) -> np.ndarray:
        """The same for some rows of many, in one array."""
        d = x @ (2 * self.gamma * self.landmarks.T)
        d -= self.gamma * (x ** 2).sum(1)[:, None]
        d -= self.gamma * (self.landmarks ** 2).sum(1)
        np.minimum(d, 0, out=d)
        return np.exp(d, out=d)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """Features and a last column of ones, for the intercept."""
        return np.column_stack([self._kernel(x) @ self.map, np.ones(len(x))])

    def predict(self, x: np.ndarray, theta: np.ndarray) -> np.ndarray:
        """phi(x) @ theta, some rows at a time."""
        coef = self.map @ theta[:-1]
        return np.concatenate([self.values(x[i:i + CHUNK]) @ coef for i in range(0, len(x), CHUNK)] or [np.zeros(0)]) + theta[-1]

    @property
    def dim(self) -> int:
        return self.map.shape[1] + 1


def kernel_width(live: np.ndarray) -> float:
    """1 / (features * variance of all standardised values): features that vary count."""
    return 1.0 / max(1.0, float(np.sum(live)))


def loss_sums(phi: np.ndarray, y: np.ndarray, thetas, delta: float):
    """Sums over rows of the rounded loss at each of ``thetas``, and of its gradient and
    curvature at the first."""
    values = []
    for theta in thetas:
        a = np.abs(y - phi @ theta) - SVR_EPSILON
        values.append(np.where(a <= 0, 0.0, np.where(a < delta, a * a / (2 * delta), a - delta / 2)).sum())
    r = y - phi @ thetas[0]
    a = np.abs(r) - SVR_EPSILON
    slope = np.where(a <= 0, 0.0, np.where(a < delta, a / delta, 1.0)) * -np.sign(r)
    bent = phi[(a > 0) & (a < delta)]
    return np.array(values), phi.T @ slope, bent.T @ bent / delta


def direction(theta: np.ndarray, g: np.ndarray, h: np.ndarray, rows: int, spread: float, c: float = SVR_C) -> tuple[float, np.ndarray]:
    """(slope along the step, Newton step) from the sums of gradient and curvature."""
    flat = np.r_[np.ones(len(theta) - 1), 0.0]          # the intercept is free
    grad = flat * theta + c * g
    curve = np.diag(flat + np.r_[np.zeros(len(theta) - 1), 1e-6 * c * rows / max(spread, 1e-12) + 1e-9]) + c * h
    step = -np.linalg.solve(curve, grad)
    return float(grad @ step), step


def penalised(thetas, v: np.ndarray, c: float = SVR_C) -> np.ndarray:
    """What the fit minimises, from the sums ``v`` of the loss at ``thetas``."""
    return np.array([t[:-1] @ t[:-1] / 2 for t in thetas]) + c * v


def answered(thetas, v: np.ndarray, g: np.ndarray, h: np.ndarray, rows: int, spread: float):
    """(sums of the loss, slope, step): with ``direction`` at the first theta, and its sum
    alone, if none is better."""
    return (v[:1], *direction(thetas[0], g, h, rows, spread)) if np.argmin(penalised(thetas, v)) == 0 else (v, None, None)


def newton(dim: int, centre: float, spread: float, c: float = SVR_C, limit: int = 60, near: np.ndarray | None = None):
    """Generator: yields (thetas, delta), is sent what ``answered`` makes of the sums over
    all rows; returns theta (the intercept last). So no matrix of sums has to leave where it
    was added up, and a full step that is taken brings the next direction with it: one
    question a step. ``near`` is a theta to begin the last stage from."""
    theta = np.zeros(dim)
    theta[-1] = centre
    delta, last = max(spread, SVR_EPSILON), 0.01 * SVR_EPSILON
    if near is not None:
        theta, delta = near, last
    while True:
        here = None
        for _ in range(limit):
            v, slope, step = here or (yield [theta], delta)
            now = penalised([theta], v, c)[0]
            if -slope < 1e-9 * max(1.0, abs(now)):
                break
            tries = [theta + s * step for s in STEPS]
            v, slope, step = yield tries, delta
            at = penalised(tries[:len(v)], v, c)
            i = int(np.argmin(at))
            if not at[i] < now - 1e-12 * abs(now):
                break
            theta, here = tries[i], None if slope is None else (v, slope, step)
        if delta <= last:
            return theta
        delta = max(delta * 0.25, last)


def solve(solver, answer):
    """Runs one ``newton`` generator with ``answer(thetas, delta)``."""
    try:
        asked = next(solver)
        while True:
            asked = solver.send(answer(*asked))
    except StopIteration as done:
        return done.value


class _Held:
    """Sums over rows in memory, in chunks; the kernel values of the first ``HELD`` rows are
    kept (2 KB a row), those of more rows are made again each time."""

    def __init__(self, phi: KernelFeatures, z: np.ndarray):
        self.phi, self.z, self.n = phi, z, len(z)
        self.kept = [self._made(i) for i in range(0, min(self.n, HELD), CHUNK)]
        self.map = np.zeros((len(phi.landmarks) + 1, phi.dim))      # from kernel values and a one to features
        self.map[:-1, :-1], self.map[-1, -1] = phi.map, 1.0

    def _made(self, i: int) -> np.ndarray:
        return np.column_stack([self.phi.values(self.z[i:i + CHUNK]), np.ones(min(CHUNK, self.n - i))])

    def _chunks(self):
        for j, i in enumerate(range(0, self.n, CHUNK)):
            yield slice(i, i + CHUNK), self.kept[j] if j < len(self.kept) else self._made(i)

    def times(self, theta: np.ndarray) -> np.ndarray:
        """phi @ theta."""
        coef = self.map @ theta
        return np.concatenate([k @ coef for _, k in self._chunks()])

    def sums(self, v: np.ndarray) -> np.ndarray:
        """phi' @ v."""
        return self.map.T @ sum(k.T @ v[at] for at, k in self._chunks())

    def products(self, weight: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(phi' @ diag(weight) @ phi, phi' @ v)."""
        root, out, line = np.sqrt(weight), 0.0, 0.0
        for at, k in self._chunks():
            scaled = k * root[at][:, None]
            out, line = out + scaled.T @ scaled, line + k.T @ v[at]
        return self.map.T @ out @ self.map, self.map.T @ line


    def losses(self, y: np.ndarray, thetas, delta: float):
        """``loss_sums`` over all rows."""
        coef, values, line, out = self.map @ np.array(thetas).T, 0.0, 0.0, np.zeros((len(self.map),) * 2)
        for at, k in self._chunks():
            r = y[at][:, None] - k @ coef
            a = np.abs(r) - SVR_EPSILON
            values = values + np.where(a <= 0, 0.0, np.where(a < delta, a * a / (2 * delta), a - delta / 2)).sum(axis=0)
            a = a[:, 0]
            line = line + k.T @ (np.where(a <= 0, 0.0, np.where(a < delta, a / delta, 1.0)) * -np.sign(r[:, 0]))
            bent = k[(a > 0) & (a < delta)]
            if len(bent):
                out += bent.T @ bent
        return values, self.map.T @ line, self.map.T @ out @ self.map / delta


def interior(rows: _Held, y: np.ndarray, c: float = SVR_C, eps: float = SVR_EPSILON, limit: int = 200) -> np.ndarray:
    """theta of least |w|^2 / 2 + c * sum max(0, |y - w . phi - b| - eps), by predictor-corrector
    steps of an interior point method. Per row: the excess above and below (``u``, ``v``), what
    the tube leaves (``s``, ``t``), the multipliers ``a`` and ``d`` in [0, c] and what they
    leave (``p``, ``q``); each product is driven to 0. A step needs sums over rows only."""
    dim, n = rows.map.shape[1], len(y)
    theta, flat = np.zeros(dim), np.r_[np.ones(dim - 1), 0.0]           # the intercept is free
    theta[-1] = float(np.mean(y))
    f, start = np.full(n, theta[-1]), max(float(np.std(y)), eps)
    u, v = np.maximum(y - f - eps, 0) + start, np.maximum(f - y - eps, 0) + start
    a, d, p, q = (np.full(n, c / 2) for _ in range(4))
    best, stuck, found = np.inf, 0, theta
    for _ in range(limit):
        r = y - f
        s, t = u - r + eps, v + r + eps
        now = theta[:-1] @ theta[:-1] / 2 + c * np.maximum(np.abs(r) - eps, 0).sum()
        gap = float(a @ s + p @ u + d @ t + q @ v)
        if now < best * (1 - 1e-10):
            best, stuck, found = now, 0, theta.copy()
        else:
            stuck += 1
        if gap <= 1e-9 * max(1.0, now) or stuck > 12:
            break
        mean = gap / (4 * n)
        ca, cd = 1 / (s / a + u / p), 1 / (t / d + v / q)

        def solved(base, line):
            g = line - flat * theta
            step = np.linalg.solve(base, g)
            return step, rows.times(step)

        def moved(df, ea, ed, m2, m4):
            da, dd = ca * (ea - df), cd * (ed + df)
            du, dv = m2 / p - u + u / p * da, m4 / q - v + v / q * dd
            return da, dd, du, dv, du + df, dv - df

        def longest(da, dd, du, dv, ds, dt):
            least = min(float(np.min(dx / x, initial=0.0)) for x, dx in ((a, da), (d, dd), (u, du), (v, dv), (s, ds), (t, dt), (p, -da), (q, -dd)))
            return min(1.0, -1.0 / least) if least < 0 else 1.0

        ea, ed = r - eps, -r - eps
        h, line = rows.products(ca + cd, a - d + ca * ea - cd * ed)
        h[np.diag_indices(dim)] += flat + 1e-12
        h[-1, -1] += 1e-12 * h[-1, -1]
        _, df = solved(h, line)
        da, dd, du, dv, ds, dt = moved(df, ea, ed, 0.0, 0.0)
        far = longest(da, dd, du, dv, ds, dt)
        then = float((a + far * da) @ (s + far * ds) + (p - far * da) @ (u + far * du) + (d + far * dd) @ (t + far * dt) + (q - far * dd) @ (v + far * dv))
        aim = (then / gap) ** 3 * mean
        m1, m2, m3, m4 = aim - da * ds, aim + da * du, aim - dd * dt, aim + dd * dv
        ea, ed = m1 / a - m2 / p + r - eps, m3 / d - m4 / q - r - eps
        step, df = solved(h, rows.sums(a - d + ca * ea - cd * ed))
        da, dd, du, dv, ds, dt = moved(df, ea, ed, m2, m4)
        far = longest(da, dd, du, dv, ds, dt)
        far = far if far == 1.0 else 0.995 * far
        theta, f = theta + far * step, f + far * df
        for x, dx in ((a, da), (d, dd), (u, du), (v, dv), (p, -da), (q, -dd)):
            x += far * dx
    return found


def fit(z: np.ndarray, y: np.ndarray, landmarks: np.ndarray, gamma: float):
    """(features, theta) for rows in memory: from the interior point solution of more than
    ``NEWTON_ROWS`` rows, the last stage of ``newton`` ends where fits by passes end."""
    phi, y = KernelFeatures(landmarks, gamma), np.asarray(y, dtype=float)
    centre, spread = float(np.mean(y)), float(np.std(y))
    if len(y) <= NEWTON_ROWS:
        whole = phi(z)
        return phi, solve(newton(phi.dim, centre, spread), lambda thetas, delta: answered(thetas, *loss_sums(whole, y, thetas, delta), len(y), spread))
    rows = _Held(phi, z)
    return phi, solve(newton(phi.dim, centre, spread, near=interior(rows, y)),
                      lambda thetas, delta: answered(thetas, *rows.losses(y, thetas, delta), len(y), spread))


def fit_by_passes(rows: DataFrame, models: dict, moments: dict) -> dict:
    """theta of every model, rows staying where they are: {key: theta}. ``models`` maps a
    key (a number) to (industry, k, mean, std, landmarks, gamma); ``rows`` has industry, x
    (array of the pool's features) and y, training rows only; ``moments`` maps an industry
    to (rows, mean, std of y). Every pass answers the pending question of all models;
    sums are reduced in two levels, so no task adds up all partitions, and the task that adds
    the last ones solves for the step: the driver gets a vector a model, not a matrix."""
    features = {i: KernelFeatures(m[4], m[5]) for i, m in models.items()}
    solvers = {i: newton(features[i].dim, *moments[m[0]][1:]) for i, m in models.items()}
    asked = {i: next(s) for i, s in solvers.items()}
    out: dict = {}
    schema = StructType([StructField("model", IntegerType()), StructField("part", IntegerType()), StructField("v", ArrayType(DoubleType()))])
    while asked:
        now = dict(asked)

        def part(batches):
            acc: dict = {}
            for b in batches:
                for ind, g in b.groupby("industry"):
                    x, y = np.vstack(g["x"].to_numpy()), g["y"].to_numpy(dtype=float)
                    for i, question in now.items():
                        m = models[i]
                        if m[0] != ind:
                            continue
                        v = _flat(loss_sums(features[i]((x[:, :m[1]] - m[2]) / m[3]), y, *question))
                        acc[i] = acc[i] + v if i in acc else v
            yield pd.DataFrame({"model": list(acc), "part": [0] * len(acc), "v": [v.tolist() for v in acc.values()]})

        def add(pdf):
            return pd.DataFrame({"model": [pdf["model"].iloc[0]], "part": [0], "v": [np.sum(np.vstack(pdf["v"].to_numpy()), axis=0).tolist()]})

        def step(pdf):
            i, v = int(pdf["model"].iloc[0]), np.sum(np.vstack(pdf["v"].to_numpy()), axis=0)
            thetas, _ = now[i]
            n, _, spread = moments[models[i][0]]
            v, slope, step = answered(thetas, *_unflat(v, len(thetas), features[i].dim), n, spread)
            v = v if slope is None else np.concatenate([v, [slope], step])
            return pd.DataFrame({"model": [i], "part": [int(slope is None)], "v": [v.tolist()]})

        first = rows.mapInPandas(part, schema).withColumn("part", F.pmod(F.spark_partition_id(), F.lit(64)))
        sums = first.groupBy("model", "part").applyInPandas(add, schema).groupBy("model").applyInPandas(step, schema).collect()
        for r in sorted(sums, key=lambda r: r["model"]):
            i = r["model"]
            try:
                v = np.array(r["v"])
                asked[i] = solvers[i].send((v, None, None) if r["part"] else (v[:1], v[1], v[2:]))
            except StopIteration as done:
                out[i] = done.value
                del asked[i]
    return {i: (features[i], theta) for i, theta in out.items()}


def _flat(answer) -> np.ndarray:
    v, g, h = answer
    return np.concatenate([v, g, h.ravel()])


def _unflat(x: np.ndarray, n: int, dim: int):
    return x[:n], x[n:n + dim], x[n + dim:].reshape(dim, dim)
