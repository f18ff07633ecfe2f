"""Tree families of the model search: regression trees, bagged forests, boosted trees.

Features are cut into at most ``BINS`` bins; a split is found from per-bin sums. All
sums are exact: targets and residuals are integers on a grid (``GRID`` steps for the
largest absolute target), bootstrap weights are small integers drawn from a hash of
(row, tree). So a model depends on its rows only, not on their order, their partitions
or the way it was fitted -- and there are two ways, with equal results:

* ``grow`` fits a tree to rows in memory, used inside a task for at most
  ``local_rows`` rows (a whole small industry, or a node of a large one);
* histogram passes (``Passes``) fit trees level by level to rows that stay where they
  are: each pass sums (model, node, feature, bin) cells per partition with NumPy, adds
  them by a grouped aggregate and returns one best split per node.

Industries of more than ``local_rows`` rows come to tasks as a byte per feature, up to
``boost_rows`` or ``bag_rows`` training rows: a boosted prefix to each task, or some trees of a
forest. Larger ones use passes: unlimited trees until a node is small enough, whose rows then
meet in a task that grows the rest; boosted trees need every row after each round, a job a level.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import BOOST_RATE, BOOST_ROUNDS, FOREST_TREES, SEED
from ..functions.draws import poisson_weights
from ..session import cut

BINS = 256
GRID = 1 << 30
EDGE_ROWS = 50_000          # expected rows of an industry that give its bin edges (all rows up to there)
SORTED_ROWS = 256           # rows of a node that are ordered rather than summed up per bin
SORTED_BATCH = 4_096        # rows of such nodes that are ordered at a time
SPLIT_CELLS = 200_000       # sums per bin that are looked through at a time
CELLS = 4_000_000           # cells that a pass holds at a time in a task
STATE_ROUNDS = 10           # boosting rounds between rewrites of the margins


@dataclass(frozen=True)
class Settings:
    """What is fitted, and up to how many rows a task fits in memory (which changes nothing
    in the models)."""
    forest_trees: int = FOREST_TREES
    boost_rounds: int = BOOST_ROUNDS
    boost_rate: float = BOOST_RATE
    boost_depth: int = 6
    boost_l2: float = 1.0
    local_rows: int = 50_000
    boost_rows: int = 1_000_000     # training rows that boosting takes in a task, as a byte per feature
    bag_rows: int = 1_000_000       # the same for single trees and forests


# ---- one tree ------------------------------------------------------------------------------

@dataclass
class Tree:
    """Node arrays; ``feature`` is -1 at a leaf, else rows whose bin is at most ``cut`` go
    left. ``value`` is on the grid of the targets."""
    feature: list = field(default_factory=lambda: [-1])
    cut: list = field(default_factory=lambda: [0])
    left: list = field(default_factory=lambda: [0])
    right: list = field(default_factory=lambda: [0])
    value: list = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, at: int) -> tuple[int, int]:
        n = len(self.feature)
        self.feature[node], self.cut[node], self.left[node], self.right[node] = int(feature), int(at), n, n + 1
        for xs, new in ((self.feature, -1), (self.cut, 0), (self.left, 0), (self.right, 0), (self.value, 0.0)):
            xs += [new, new]
        return n, n + 1

    def hang(self, node: int, part: "Tree") -> None:
        """Puts a tree in the place of a leaf."""
        base = len(self.feature) - 1                # a part's node j > 0 becomes base + j
        lists = [(self.feature, part.feature), (self.cut, part.cut), (self.left, [x + base if x else 0 for x in part.left]),
                 (self.right, [x + base if x else 0 for x in part.right]), (self.value, part.value)]
        for xs, new in lists:
            xs[node] = new[0]
            xs += new[1:]

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        """The leaf of every row of binned features."""
        feature, at, left, right = (np.asarray(x) for x in (self.feature, self.cut, self.left, self.right))
        flat, k = np.ascontiguousarray(bins).ravel(), bins.shape[1]
        node, rows, now = np.zeros(len(bins), np.int64), np.arange(len(bins)), np.zeros(len(bins), np.int64)
        while len(rows):
            f = feature.take(now)
            on = f >= 0
            if not on.all():
                off = ~on
                node[rows[off]] = now[off]
                rows, now, f = rows[on], now[on], f[on]
            now = np.where(flat.take(rows * k + f) <= at.take(now), left.take(now), right.take(now))
        return node

    def predict(self, bins: np.ndarray) -> np.ndarray:
        return np.asarray(self.value)[self.leaves(bins)]


def bin_edges(x: np.ndarray) -> np.ndarray:
    """At most BINS - 1 cut points of one feature: between all neighbouring values if they
    are few, else between those around equally spaced quantiles."""
    x = np.sort(x[np.isfinite(x)])
    values = x[np.flatnonzero(np.r_[True, x[1:] != x[:-1]])] if len(x) else x
    if len(values) > BINS:
        at = np.searchsorted(values, x[np.linspace(0, len(x) - 1, BINS + 1).astype(int)[1:-1]])
        at = np.unique(np.clip(at, 0, len(values) - 2))
        return values[at] + (values[at + 1] - values[at]) / 2
    return values[:-1] + np.diff(values) / 2


def to_bins(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.column_stack([np.searchsorted(e, x[:, j], side="left").astype(np.uint8) for j, e in enumerate(edges)]) if len(edges) \
        else np.zeros((len(x), 0), np.uint8)


def _score(s, n, l2):
    s = np.asarray(s, dtype=np.float64)
    return s * s / (np.asarray(n, dtype=np.float64) + l2)


def _gains(sl, cl, sr, cr, l2):
    """The scores of left and right parts, added; uses up ``sr`` and ``cr``."""
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = sl * sl
        gain /= cl + l2 if l2 else cl
        np.multiply(sr, sr, out=sr)
        sr /= np.add(cr, l2, out=cr) if l2 else cr
        gain += sr
    return gain


def _better(gain: float, parent: float) -> bool:
    return bool(gain - parent > 1e-12 * abs(parent))


def leaf_value(s, n, l2: float) -> float:
    return float(s) / (float(n) + l2) if n else 0.0


def grow(bins: np.ndarray, target: np.ndarray, weight: np.ndarray, l2: float = 0.0, max_depth: int | None = None) -> Tree:
    """The tree of rows in memory: large nodes (all of a tree of bounded depth) are split from
    sums per bin, the rows of smaller ones are then ordered, many nodes at a time."""
    used = np.flatnonzero(weight > 0)
    w = weight[used].astype(np.int64)
    by_feature, q = np.ascontiguousarray(bins[used].T), target[used].astype(np.int64)
    if max_depth is not None:
        return _grow_binned(by_feature, q * w, w, l2, max_depth, 0)[0]
    return grow_whole(by_feature, q, w, l2)


def grow_whole(by_feature: np.ndarray, q: np.ndarray, w: np.ndarray, l2: float = 0.0) -> Tree:
    """The unlimited tree of rows that all have a weight (a line per feature), as arrays."""
    if len(q) <= SORTED_ROWS and len(q) and len(by_feature):
        return Tree(*_grow_ordered(by_feature, q, w, np.zeros(len(q), np.int64), 1, l2))
    tree, node = _grow_binned(by_feature, q * w, w, l2, None, SORTED_ROWS)
    order = np.argsort(node, kind="stable")
    order = order[np.searchsorted(node[order], 0):]                     # rows of nodes that are left to order
    first = np.flatnonzero(np.r_[True, np.diff(node[order]) != 0]) if len(order) else np.zeros(0, np.int64)
    parts, last, made, i = [], np.r_[first[1:], len(order)], len(tree.feature), 0
    while i < len(first):
        j = max(i + 1, int(np.searchsorted(last, first[i] + SORTED_BATCH, side="right")))
        rows = order[first[i]:last[j - 1]]
        grown = _grow_ordered(by_feature[:, rows], q[rows], w[rows], np.repeat(np.arange(j - i), last[i:j] - first[i:j]), j - i, l2)
        place = np.r_[node[order[first[i:j]]], np.arange(made, made + len(grown[0]) - (j - i))]
        parts.append((place, *grown))
        made, i = made + len(grown[0]) - (j - i), j
    out = [np.r_[np.asarray(x, dtype=t), np.zeros(made - len(tree.feature), t)]
           for x, t in ((tree.feature, np.int64), (tree.cut, np.int64), (tree.left, np.int64), (tree.right, np.int64), (tree.value, np.float64))]
    for place, feature, cut_, left, right, value in parts:
        for xs, new in zip(out, (feature, cut_, np.where(left > 0, place[left], 0), np.where(right > 0, place[right], 0), value)):
            xs[place] = new
    return Tree(*out)


def _grow_binned(by_feature: np.ndarray, g: np.ndarray, w: np.ndarray, l2: float, max_depth: int | None, sorted_rows: int) -> tuple[Tree, np.ndarray]:
    """(tree, per row the node of at most ``sorted_rows`` rows that is left to order, else
    -1), level by level from exact sums per (node, feature, bin): of two children the one of
    fewer rows is summed up, the other is what is left of their parent."""
    tree, (k, n) = Tree(), by_feature.shape
    left_at = np.full(n, -1)
    tree.value[0] = leaf_value(g.sum(), w.sum(), l2)
    if not n or not k:
        return tree, left_at
    plain = bool((w == 1).all())

    def sums(rows, slot, many):
        """Sums and weights (many, k, BINS) of ``rows``, whose nodes are ``slot``."""
        base, value, weight = slot * BINS, g[rows].astype(np.float64), None if plain else w[rows].astype(np.float64)
        S, N = np.empty((k, many * BINS)), np.empty((k, many * BINS))
        for f in range(k):
            key = base + by_feature[f][rows]
            S[f], N[f] = np.bincount(key, value, many * BINS), np.bincount(key, weight, many * BINS)
        return (x.reshape(k, many, BINS).transpose(1, 0, 2) for x in (S, N))

    rows, slot, ids = np.arange(n), np.zeros(n, np.int64), [0]
    waiting = [(rows, slot, ids, 0, *sums(rows, slot, 1))]
    while waiting:
        rows, slot, ids, depth, S, N = waiting.pop()
        if len(ids) > 1 and S.size > SPLIT_CELLS:           # so many nodes at a time as stay near the processor
            half = len(ids) // 2
            low = slot < half
            waiting += [(rows[~low], slot[~low] - half, ids[half:], depth, S[half:].copy(), N[half:].copy()), (rows[low], slot[low], ids[:half], depth, S[:half], N[:half])]
            continue
        depth += 1
        sl, cl = np.cumsum(S, axis=2), np.cumsum(N, axis=2)
        total, many = sl[:, 0, -1], cl[:, 0, -1]
        gain = _gains(sl, cl, total[:, None, None] - sl, many[:, None, None] - cl, l2)
        np.copyto(gain, -np.inf, where=(N == 0) | (cl >= many[:, None, None]))
        gain = gain.reshape(len(ids), -1)
        best, parent = np.argmax(gain, axis=1), _score(total, many, l2)
        top = gain[np.arange(len(ids)), best]
        feature, bound = best // BINS, best % BINS
        kids, split = [], np.zeros(len(ids), bool)
        for i, node in enumerate(ids):
            if np.isfinite(top[i]) and _better(top[i], parent[i]):
                split[i] = True
                a, b = tree.split(node, feature[i], bound[i])
                ls, lc = int(sl[i, feature[i], bound[i]]), int(cl[i, feature[i], bound[i]])
                tree.value[a], tree.value[b] = leaf_value(ls, lc, l2), leaf_value(int(total[i]) - ls, int(many[i]) - lc, l2)
                kids += [a, b]
        if not kids or depth == max_depth:
            continue
        held = split[slot]
        rows, slot = rows[held], slot[held]
        child = 2 * (np.cumsum(split) - 1)[slot] + (by_feature[feature[slot], rows] > bound[slot])
        size = np.bincount(child, minlength=len(kids))
        on = size > sorted_rows                             # the others are ordered later, if at all
        node_of = np.asarray(kids)
        off = ~on[child]
        left_at[rows[off]] = node_of[child[off]]
        if not on.any():
            continue
        pair = np.flatnonzero(on[::2] | on[1::2])
        fewer = 2 * pair + (size[1::2] < size[::2])[pair]
        place, to = np.full(len(kids), -1), np.cumsum(on) - 1
        place[fewer] = np.arange(len(fewer))
        mine = np.flatnonzero(place[child] >= 0)
        s1, n1 = sums(rows[mine], place[child[mine]], len(fewer))
        more, above = fewer ^ 1, np.flatnonzero(split)[pair]
        a, b = on[fewer], on[more]
        both_s, both_n = np.empty((int(on.sum()), k, BINS)), np.empty((int(on.sum()), k, BINS))
        for both, one, whole in ((both_s, s1, S), (both_n, n1, N)):
            both[to[fewer[a]]] = one[a]
            both[to[more[b]]] = whole[above[b]] - one[b]
        rows, slot = rows[~off], to[child[~off]]
        waiting.append((rows, slot, [int(x) for x in node_of[on]], depth, both_s, both_n))
    return tree, left_at
    plain = bool((w == 1).all())

    def sums(rows, slot, many):
        """Sums and weights (many, k, BINS) of ``rows``, whose nodes are ``slot``."""
        base, value, weight = slot * BINS, g[rows].astype(np.float64), None if plain else w[rows].astype(np.float64)
        S, N = np.empty((k, many * BINS)), np.empty((k, many * BINS))
        for f in range(k):
            key = base + by_feature[f][rows]
            S[f], N[f] = np.bincount(key, value, many * BINS), np.bincount(key, weight, many * BINS)
        return (x.reshape(k, many, BINS).transpose(1, 0, 2) for x in (S, N))

    rows, slot, ids = np.arange(n), np.zeros(n, np.int64), [0]
    waiting = [(rows, slot, ids, 0, *sums(rows, slot, 1))]
    while waiting:
        rows, slot, ids, depth, S, N = waiting.pop()
        if len(ids) > 1 and S.size > SPLIT_CELLS:           # so many nodes at a time as stay near the processor
            half = len(ids) // 2
            low = slot < half
            waiting += [(rows[~low], slot[~low] - half, ids[half:], depth, S[half:].copy(), N[half:].copy()), (rows[low], slot[low], ids[:half], depth, S[:half], N[:half])]
            continue
        depth += 1
        sl, cl = np.cumsum(S, axis=2), np.cumsum(N, axis=2)
        total, many = sl[:, 0, -1], cl[:, 0, -1]
        gain = _gains(sl, cl, total[:, None, None] - sl, many[:, None, None] - cl, l2)
        np.copyto(gain, -np.inf, where=(N == 0) | (cl >= many[:, None, None]))
        gain = gain.reshape(len(ids), -1)
        best, parent = np.argmax(gain, axis=1), _score(total, many, l2)
        top = gain[np.arange(len(ids)), best]
        feature, bound = best // BINS, best % BINS
        kids, split = [], np.zeros(len(ids), bool)
        for i, node in enumerate(ids):
            if np.isfinite(top[i]) and _better(top[i], parent[i]):
                split[i] = True
                a, b = tree.split(node, feature[i], bound[i])
                ls, lc = int(sl[i, feature[i], bound[i]]), int(cl[i, feature[i], bound[i]])
                tree.value[a], tree.value[b] = leaf_value(ls, lc, l2), leaf_value(int(total[i]) - ls, int(many[i]) - lc, l2)
                kids += [a, b]
        if not kids or depth == max_depth:
            continue
        held = split[slot]
        rows, slot = rows[held], slot[held]
        child = 2 * (np.cumsum(split) - 1)[slot] + (by_feature[feature[slot], rows] > bound[slot])
        size = np.bincount(child, minlength=len(kids))
        fewer = np.arange(0, len(kids), 2) + (size[1::2] < size[::2])
        on = size > sorted_rows                             # the others are ordered later, if at all
        node_of = np.asarray(kids)
        off = ~on[child]
        left_at[rows[off]] = node_of[child[off]]
        if not on.any():
            continue
        place = np.full(len(kids), -1)
        place[fewer] = np.arange(len(fewer))
        mine = np.flatnonzero(place[child] >= 0)
        s1, n1 = sums(rows[mine], place[child[mine]], len(fewer))
        both_s, both_n = np.empty((len(kids), k, BINS)), np.empty((len(kids), k, BINS))
        both_s[fewer], both_n[fewer] = s1, n1
        both_s[fewer ^ 1], both_n[fewer ^ 1] = S[split] - s1, N[split] - n1
        rows, slot = rows[~off], (np.cumsum(on) - 1)[child[~off]]
        waiting.append((rows, slot, [int(x) for x in node_of[on]], depth, both_s[on], both_n[on]))
    return tree, left_at


def _grow_sorted(bins: np.ndarray, target: np.ndarray, weight: np.ndarray, l2: float = 0.0, max_depth: int | None = None) -> Tree:
    """The tree of few rows."""
    used = np.flatnonzero(weight > 0)
    w, q = weight[used].astype(np.int64), target[used].astype(np.int64)
    if not len(used) or not bins.shape[1]:
        return Tree(value=[leaf_value((q * w).sum(), w.sum(), l2)])
    return Tree(*(x.tolist() for x in _grow_ordered(np.ascontiguousarray(bins[used].T), q, w, np.zeros(len(used), np.int64), 1, l2, max_depth)))


def _grow_ordered(by_feature: np.ndarray, q: np.ndarray, w: np.ndarray, slot: np.ndarray, roots: int, l2: float, max_depth: int | None = None) -> tuple:
    """(feature, cut, left, right, value) of the trees of few rows, whose roots are the first
    ``roots`` nodes; ``slot`` names each row's root. Per level, every feature's rows are kept
    ordered by (node, bin), so that running sums give all splits of all nodes at once. Sums are
    integers below 2^53, exact in doubles. A node of equal targets has no split."""
    k, n = by_feature.shape
    flat, lines, g = by_feature.ravel(), np.arange(k)[:, None], q * w
    s_, n_ = np.bincount(slot, g.astype(np.float64), roots), np.bincount(slot, w, roots)
    value, splits = [s_ / (n_ + l2)], []                    # per level: nodes split, feature, cut, first child
    order = np.argsort(by_feature, axis=1, kind="stable").astype(np.int32)      # by feature: rows by node and bin
    bins, ids, made, depth = None, np.arange(roots), roots, 0
    while len(ids) and (max_depth is None or depth < max_depth):
        depth += 1
        # nodes of equal targets drop out
        rows = np.argsort(slot.astype(np.uint16), kind="stable")
        rows = rows[:np.searchsorted(slot[rows], len(ids))]
        of = slot[rows]
        first = np.searchsorted(of, np.arange(len(ids)))
        on = np.minimum.reduceat(q[rows], first) < np.maximum.reduceat(q[rows], first)
        if not on.any():
            break
        if not on.all():
            now = np.where(on, np.cumsum(on) - 1, len(ids))
            slot, ids = np.where(slot < len(ids), now[np.minimum(slot, len(ids) - 1)], n), ids[on]
        slot, many_open = np.minimum(slot, len(ids)), len(ids)
        width = int((slot < many_open).sum())
        at = slot.astype(np.uint8 if many_open < 256 else np.uint16).take(order)
        move = np.argsort(at, axis=1, kind="stable")[:, :width] + lines * order.shape[1]
        order = order.ravel().take(move)
        bins = flat.take(order + lines * n) if bins is None else bins.ravel().take(move)
        rows = order[0]
        of = slot[rows]                                     # the same for every feature
        first = np.searchsorted(of, np.arange(many_open))
        last = np.r_[first[1:], width] - 1
        sl, cl = ((x - x0[of]).astype(np.float64) for x, x0 in (_running(v.take(order), first) for v in (g, w)))
        total, many = sl[0][last], cl[0][last]
        sr, cr = total[of] - sl, many[of] - cl
        same = np.empty(bins.shape, bool)
        np.equal(bins[:, :-1], bins[:, 1:], out=same[:, :-1])
        same[:, last] = True
        gain = _gains(sl, cl, sr, cr, l2)
        np.copyto(gain, -np.inf, where=same)
        best = np.maximum.reduceat(gain, first, axis=1)
        feature = np.argmax(best, axis=0)
        top, parent = best[feature, np.arange(many_open)], _score(total, many, l2)
        hit = np.flatnonzero(gain[feature[of], np.arange(width)] == top[of])
        place = hit[np.searchsorted(of[hit], np.arange(many_open))]
        split = np.flatnonzero(np.isfinite(top) & (top - parent > 1e-12 * np.abs(parent)))
        if not len(split):
            break
        f, p = feature[split], place[split]
        child, bound = np.full(many_open, -1), np.zeros(many_open, np.int64)
        bound[split], child[split] = bins[f, p], np.arange(0, 2 * len(split), 2)
        splits.append((ids[split], f, bound[split], made + child[split]))
        ls, lc = sl[f, p], cl[f, p]
        s_, n_ = (np.column_stack(x).ravel() for x in ((ls, total[split] - ls), (lc, many[split] - lc)))
        value.append(s_ / (n_ + l2))
        go = child[of] + (flat.take(feature[of] * n + rows) > bound[of])
        slot = np.full(n, n)
        slot[rows] = np.where(child[of] >= 0, go, n)
        ids = made + np.arange(2 * len(split))
        made += len(ids)
    feature, at, left, right = np.full(made, -1), np.zeros(made, np.int64), np.zeros(made, np.int64), np.zeros(made, np.int64)
    for node, f, bound, child in splits:
        feature[node], at[node], left[node], right[node] = f, bound, child, child + 1
    return feature, at, left, right, np.concatenate(value)


def _running(x: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(running sums of every line, those before the places ``first``, the same for all lines)."""
    np.cumsum(x, axis=1, out=x)
    return x, np.where(first > 0, x[0][first - 1], 0)


def best_split(cells: np.ndarray, s: np.ndarray, n: np.ndarray, k: int, l2: float):
    """(feature, bin, left sum, left weight, sum, weight) of a node from its cells
    (feature * BINS + bin), as ``grow`` would find it; feature -1 without a split."""
    S, N = np.zeros(k * BINS, np.int64), np.zeros(k * BINS, np.int64)
    S[cells], N[cells] = s, n
    S, N = S.reshape(k, BINS), N.reshape(k, BINS)
    total, many = int(S[0].sum()), int(N[0].sum())
    sl, cl = np.cumsum(S, axis=1), np.cumsum(N, axis=1)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where((N > 0) & (cl < many), _score(sl, cl, l2) + _score(total - sl, many - cl, l2), -np.inf)
    i = int(np.argmax(gain))
    if not np.isfinite(gain.flat[i]) or not _better(gain.flat[i], float(_score(total, many, l2))):
        return -1, 0, 0, 0, total, many
    return i // BINS, i % BINS, int(sl.flat[i]), int(cl.flat[i]), total, many


# ---- bootstrap and boosting ----------------------------------------------------------------

def bootstrap_weights(rid: np.ndarray, tree: int) -> np.ndarray:
    """How often a forest's tree takes each row: Poisson(1), drawn from (row, tree)."""
    return poisson_weights(rid, tree, SEED)[:, 0]


def to_grid(y: np.ndarray, largest: float) -> np.ndarray:
    return np.rint(np.asarray(y, dtype=np.float64) * (GRID / largest)).astype(np.int64) if largest > 0 else np.zeros(len(y), np.int64)


def boost(bins: np.ndarray, y: np.ndarray, largest: float, wanted: np.ndarray, to: Settings):
    """(start, trees, predictions for ``wanted``) of boosted trees fitted in memory."""
    one = np.ones(len(y), np.int64)
    q = to_grid(y, largest)
    start = float(q.sum()) / len(q) * (largest / GRID)
    margin, out, trees = np.full(len(y), start), np.full(len(wanted), start), []
    for _ in range(to.boost_rounds):
        t = grow(bins, to_grid(y - margin, largest), one, to.boost_l2, to.boost_depth)
        margin = margin + to.boost_rate * (t.predict(bins) * (largest / GRID))
        out = out + to.boost_rate * (t.predict(wanted) * (largest / GRID))
        trees.append(t)
    return start, trees, out


def bagged(bins: np.ndarray, q: np.ndarray, rid: np.ndarray, ks: list[int], numbers):
    """Yields (place in ``ks``, tree) of the forest trees of these numbers that took a row;
    number -1 is the tree that takes every row once."""
    by_feature = np.ascontiguousarray(bins.T)
    for t in numbers:
        w = bootstrap_weights(rid, t) if t >= 0 else np.ones(len(q), np.int64)
        used = np.flatnonzero(w)
        if len(used):
            mine, taken, w = by_feature[:, used], q[used], w[used]
            for j, k in enumerate(ks):
                yield j, grow_whole(mine[:k], taken, w)


def bag(bins: np.ndarray, y: np.ndarray, rid: np.ndarray, largest: float, wanted: np.ndarray, n_trees: int):
    """(trees, predictions for ``wanted``) of a forest; a single tree takes every row once."""
    out, trees = np.zeros(len(wanted)), []
    for _, tree in bagged(bins, to_grid(y, largest), rid, [bins.shape[1]], range(n_trees) if n_trees > 1 else [-1]):
        trees.append(tree)
        out = out + tree.predict(wanted)
    return trees, out / max(len(trees), 1) * (largest / GRID)


# ---- the same by passes over rows that stay where they are ------------------------------------

@dataclass
class Model:
    """One tree model of a large industry while it is fitted."""
    industry: str
    k: int
    tree: int = -1                  # number of a forest's tree; -1: every row once
    now: Tree = field(default_factory=Tree)
    open: list = field(default_factory=lambda: [0])
    local: set = field(default_factory=set)     # nodes whose rows a task takes over


class Passes:
    """Histogram passes over ``rows``: industry, train, rid, y, bins (binary, one byte per
    feature of the industry's pool) and, for boosting, margins (array, one per prefix)."""

    def __init__(self, rows: DataFrame, largest: dict[str, float]):
        self.rows, self.largest = rows, largest

    def splits(self, models: list[Model], l2: float, target=None) -> dict:
        """(model, node) -> (best split, number of rows) for all open nodes, in as many
        passes as the bound on cells asks for. ``target`` gives the integers to fit from
        (model number, a batch's columns, binned features); the grid targets if None."""
        out, wave, size = {}, [], 0
        for i, m in enumerate(models):
            need = len(m.open) * m.k * BINS
            if wave and size + need > CELLS:
                out |= self._wave(models, wave, l2, target)
                wave, size = [], 0
            if m.open:
                wave.append(i)
                size += need
        return out | (self._wave(models, wave, l2, target) if wave else {})

    def _wave(self, models: list[Model], wave: list[int], l2: float, target) -> dict:
        held, largest = [(i, models[i]) for i in wave], self.largest
        ks = {i: m.k for i, m in held}

        def sums(batches):
            cells = {i: np.zeros((2, len(m.open) * m.k * BINS), np.int64) for i, m in held}
            count = {i: np.zeros(len(m.open), np.int64) for i, m in held}
            for b in batches:
                cols = batch_columns(b)
                for i, m in held:
                    at = np.flatnonzero(cols["industry"] == m.industry)
                    if not len(at):
                        continue
                    part = {c: v[at] for c, v in cols.items()}
                    bins = unpacked(part["bins"])[:, :m.k]
                    place = np.full(len(m.now.feature), -1)
                    place[m.open] = np.arange(len(m.open))
                    slot = place[m.now.leaves(bins)]
                    w = np.where(part["train"], bootstrap_weights(part["rid"], m.tree) if m.tree >= 0 else 1, 0)
                    count[i] += np.bincount(slot[(slot >= 0) & ((w > 0) | ~part["train"])], minlength=len(m.open))
                    use = (slot >= 0) & (w > 0)
                    if not use.any():
                        continue
                    q = to_grid(part["y"], largest[m.industry]) if target is None else target(i, part, unpacked(part["bins"]))
                    g, w, slot, bins = (q * w)[use], w[use], slot[use], bins[use]
                    key = ((slot[:, None] * m.k + np.arange(m.k)) * BINS + bins).ravel()
                    # a batch's sums stay below 2^53, so that they are exact in doubles
                    cells[i][0] += np.bincount(key, np.repeat(g, m.k).astype(np.float64), cells[i].shape[1]).astype(np.int64)
                    cells[i][1] += np.bincount(key, np.repeat(w, m.k).astype(np.float64), cells[i].shape[1]).astype(np.int64)
            for i, m in held:
                at = np.flatnonzero(cells[i][1])
                width = m.k * BINS
                yield _record(i, np.r_[np.asarray(m.open)[at // width], m.open], np.r_[at % width, np.full(len(m.open), -1)],
                              np.r_[cells[i][0][at], np.zeros(len(m.open), np.int64)], np.r_[cells[i][1][at], count[i]])

        added = self.rows.mapInArrow(sums, "model int, node int, cell int, s long, n long") \
            .groupBy("model", "node", "cell").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))

        def best(pdf: pd.DataFrame) -> pd.DataFrame:
            i, node = int(pdf["model"].iloc[0]), int(pdf["node"].iloc[0])
            p = pdf[pdf["cell"] >= 0]
            found = best_split(p["cell"].to_numpy(), p["s"].to_numpy(), p["n"].to_numpy(), ks[i], l2)
            return pd.DataFrame([[i, node, *found, int(pdf.loc[pdf["cell"] < 0, "n"].sum())]],
                                columns=["model", "node", "feature", "bin", "ls", "ln", "s", "n", "rows"])

        schema = "model int, node int, feature int, bin int, ls long, ln long, s long, n long, rows long"
        return {(r["model"], r["node"]): r for r in added.groupBy("model", "node").applyInPandas(best, schema).collect()}

    def level(self, models: list[Model], l2: float, depth: int | None, local_rows: int, target=None) -> None:
        """Splits every open node once; nodes of at most ``local_rows`` rows are left to tasks."""
        found = self.splits(models, l2, target)
        for i, m in enumerate(models):
            nxt = []
            for node in m.open:
                r = found.get((i, node))
                if r is None:
                    continue
                if node == 0:
                    m.now.value[0] = leaf_value(r["s"], r["n"], l2)
                if local_rows and r["rows"] <= local_rows:
                    m.local.add(node)
                elif r["feature"] >= 0 and depth != 0:
                    a, b = m.now.split(node, r["feature"], r["bin"])
                    m.now.value[a], m.now.value[b] = leaf_value(r["ls"], r["ln"], l2), leaf_value(r["s"] - r["ls"], r["n"] - r["ln"], l2)
                    nxt += [a, b]
            m.open = nxt


def _record(model: int, node, cell, s, n) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({
        "model": pa.array(np.full(len(node), model), pa.int32()), "node": pa.array(np.asarray(node), pa.int32()),
        "cell": pa.array(np.asarray(cell), pa.int32()), "s": pa.array(np.asarray(s), pa.int64()), "n": pa.array(np.asarray(n), pa.int64())})


def batch_columns(b: pa.RecordBatch) -> dict[str, np.ndarray]:
    out = {}
    for name in b.schema.names:
        c = b.column(name)
        flat = pa.types.is_integer(c.type) or pa.types.is_floating(c.type) or pa.types.is_boolean(c.type)
        out[name] = c.to_numpy(zero_copy_only=False) if flat and not c.null_count else np.array([*c.to_pylist(), None], dtype=object)[:-1]
    return out


def unpacked(bins: np.ndarray) -> np.ndarray:
    return np.frombuffer(b"".join(bins), np.uint8).reshape(len(bins), -1)


def boosted(rows: DataFrame, ks: dict[str, list[int]], largest: dict[str, float], start: dict[str, float], to: Settings):
    """Boosted trees of all prefixes of large industries, joint passes: a pass per level
    and round serves all of them. Returns ({(industry, k): trees}, rows whose ``margins``
    hold the predictions of each prefix)."""
    order = [(ind, k) for ind in sorted(ks) for k in ks[ind]]
    column = {key: ks[key[0]].index(key[1]) for key in order}
    trees: dict = {key: [] for key in order}
    state = rows.withColumn("margins", _start_margins(start, ks))
    since: list[dict] = []          # finished rounds that the margins do not hold yet

    def margin_of(key, part, bins):
        m = np.array([x[column[key]] for x in part["margins"]])
        for done in since:
            m = m + to.boost_rate * (done[key].predict(bins[:, :key[1]]) * (largest[key[0]] / GRID))
        return m

    for r in range(to.boost_rounds):
        models = [Model(ind, k) for ind, k in order]
        passes = Passes(state, largest)
        for d in range(to.boost_depth):
            if any(m.open for m in models):
                passes.level(models, to.boost_l2, to.boost_depth - d, 0,
                             lambda i, part, bins: to_grid(part["y"] - margin_of(order[i], part, bins), largest[order[i][0]]))
        done = {key: m.now for key, m in zip(order, models)}
        since.append(done)
        for key in order:
            trees[key].append(done[key])
        if len(since) == STATE_ROUNDS or r == to.boost_rounds - 1:
            state, since = cut(_with_margins(state, since, ks, largest, to.boost_rate)), []
    return trees, state


def _start_margins(start: dict[str, float], ks: dict[str, list[int]]):
    """Every prefix starts at the industry's mean."""
    e = F.lit(None).cast("array<double>")
    for ind in ks:
        e = F.when(F.col("industry") == ind, F.array_repeat(F.lit(float(start[ind])), len(ks[ind]))).otherwise(e)
    return e


def _with_margins(state: DataFrame, rounds: list[dict], ks, largest, rate) -> DataFrame:
    names = state.columns

    def run(batches):
        for b in batches:
            cols = batch_columns(b)
            bins = [np.frombuffer(x, np.uint8) for x in cols["bins"]]
            margins = [list(m) for m in cols["margins"]]
            for ind in set(cols["industry"]):
                at = np.flatnonzero(cols["industry"] == ind)
                x = np.vstack([bins[i] for i in at])
                for j, k in enumerate(ks[ind]):
                    m = np.array([margins[i][j] for i in at])
                    for done in rounds:
                        m = m + rate * (done[ind, k].predict(x[:, :k]) * (largest[ind] / GRID))
                    for i, v in zip(at, m):
                        margins[i][j] = float(v)
            kept = [b.column(c) if c != "margins" else pa.array(margins, pa.list_(pa.float64())) for c in names]
            yield pa.RecordBatch.from_arrays(kept, names=names)

    return state.mapInArrow(run, state.schema)


def _upper_parts(rows: DataFrame, ks: dict[str, list[int]], n_trees: int, largest: dict[str, float], local_rows: int) -> list[Model]:
    """Unlimited trees of large industries by passes, down to nodes of ``local_rows`` rows."""
    models = [Model(ind, k, t if n_trees > 1 else -1) for ind in sorted(ks) for k in ks[ind] for t in range(n_trees)]
    passes = Passes(rows, largest)
    while any(m.open for m in models):
        passes.level(models, 0.0, None, local_rows)
    return models


def _routed(rows: DataFrame, models: list[Model], largest: dict[str, float]) -> DataFrame:
    """A row per model and row that a task of ``node`` needs (training rows by weight,
    wanted rows with weight 0), and per wanted row that lies at a leaf (node -1)."""
    sent = rows.sparkSession.sparkContext.broadcast(models)

    def run(batches):
        for b in batches:
            cols = batch_columns(b)
            for i, m in enumerate(sent.value):
                at = np.flatnonzero(cols["industry"] == m.industry)
                if not len(at):
                    continue
                part = {c: v[at] for c, v in cols.items()}
                bins = unpacked(part["bins"])[:, :m.k]
                node = m.now.leaves(bins)
                w = np.where(part["train"], bootstrap_weights(part["rid"], m.tree) if m.tree >= 0 else 1, 0)
                near = np.isin(node, list(m.local))
                keep = np.flatnonzero(np.where(part["train"], near & (w > 0), True))
                yield pa.RecordBatch.from_pydict({
                    "model": pa.array(np.full(len(keep), i), pa.int32()), "node": pa.array(np.where(near, node, -1)[keep], pa.int32()),
                    "row": pa.array(part["row"][keep].astype(np.int64)), "w": pa.array(w[keep].astype(np.int64)),
                    "q": pa.array(to_grid(part["y"], largest[m.industry])[keep]),
                    "bins": pa.array([x.tobytes() for x in bins[keep]], pa.binary()), "value": pa.array(np.asarray(m.now.value)[node][keep])})

    return rows.mapInArrow(run, "model int, node int, row long, w long, q long, bins binary, value double")


def _grown_from(pdf: pd.DataFrame) -> tuple[Tree, np.ndarray, np.ndarray]:
    bins, tr = unpacked(pdf["bins"].to_numpy()), pdf["w"].to_numpy() > 0
    return grow(bins[tr], pdf["q"].to_numpy()[tr], pdf["w"].to_numpy()[tr]), bins, tr


def grown(rows: DataFrame, ks: dict[str, list[int]], n_trees: int, largest: dict[str, float],
          local_rows: int) -> tuple[list[Model], DataFrame]:
    """Unlimited trees of large industries: passes down to nodes of ``local_rows`` rows,
    then one task per node. Returns the models and, for every wanted row and model,
    (model, row, value on the grid)."""
    models = _upper_parts(rows, ks, n_trees, largest, local_rows)
    dealt = cut(_routed(rows, models, largest))

    def finish(pdf: pd.DataFrame) -> pd.DataFrame:
        tree, bins, tr = _grown_from(pdf)
        return pdf[~tr][["model", "row"]].assign(value=tree.predict(bins[~tr]))

    ready = dealt.filter("node < 0").select("model", "row", "value")
    return models, ready.unionByName(dealt.filter("node >= 0").groupBy("model", "node").applyInPandas(finish, "model int, row long, value double"))


TREE_ROW = "industry string, k int, tree int, feature array<int>, cut array<int>, left array<int>, right array<int>, value array<double>"


def whole_trees(rows: DataFrame, ks: dict[str, list[int]], n_trees: int, largest: dict[str, float], local_rows: int) -> DataFrame:
    """The same trees as node arrays (TREE_ROW): lower parts are grown one task per node
    and hung into their tree's upper part, one task per tree."""
    models = _upper_parts(rows, ks, n_trees, largest, local_rows)
    dealt = _routed(rows.filter("train"), models, largest).filter("node >= 0")
    parts = "model int, node int, feature array<int>, cut array<int>, left array<int>, right array<int>, value array<double>"

    def finish(pdf: pd.DataFrame) -> pd.DataFrame:
        t = _grown_from(pdf)[0]
        return pd.DataFrame([[int(pdf["model"].iloc[0]), int(pdf["node"].iloc[0]), t.feature, t.cut, t.left, t.right, t.value]],
                            columns=["model", "node", "feature", "cut", "left", "right", "value"])

    upper = rows.sparkSession.createDataFrame([(i, -1, *(list(map(kind, x)) for kind, x in (
        (int, m.now.feature), (int, m.now.cut), (int, m.now.left), (int, m.now.right), (float, m.now.value)))) for i, m in enumerate(models)], parts)
    of = {i: (m.industry, m.k, max(m.tree, 0)) for i, m in enumerate(models)}

    def hung(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("node")
        t = [list(pdf[c].iloc[0]) for c in ("feature", "cut", "left", "right", "value")]
        for r in pdf.iloc[1:].itertuples():
            base = len(t[0]) - 1                # a part's node j > 0 becomes base + j, its root the node itself
            for xs, new in zip(t, (r.feature, r.cut, [x + base if x else 0 for x in r.left], [x + base if x else 0 for x in r.right], r.value)):
                xs[r.node] = new[0]
                xs += list(new[1:])
        return pd.DataFrame([[*of[int(pdf["model"].iloc[0])], *t]], columns=["industry", "k", "tree", "feature", "cut", "left", "right", "value"])

    return upper.unionByName(dealt.groupBy("model", "node").applyInPandas(finish, parts)).groupBy("model").applyInPandas(hung, TREE_ROW)
