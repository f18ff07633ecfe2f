"""Models fitted to rows (M6-M9): what all of them predict, in one job.

A fit is named by (industry, family, number of leading features). Industries of at most
``Settings.local_rows`` training and scored rows are dealt out as jobs: the rows of an industry
meet once per job in a task, which fits the job's models and scores the wanted rows.
The rows of larger industries come to tasks packed (a byte per feature for trees, 8 for
support vectors), and from about a million rows on are fitted by passes over rows that stay
where they are (``trees.Passes``, ``svr.fit_by_passes``). Either way gives the same models.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import MODEL_FAMILIES
from ..session import cut
from . import svr, trees
from .trees import GRID, Settings

TREE, FOREST, SVR, BOOST = MODEL_FAMILIES[2:6]
GROUP = "broad_industry"
KEYS = ["ticker", "fy", GROUP, "split", "stock_price"]
SVR_SPAN = 2                # support vectors are fitted in a task up to so many times ``local_rows``: passes take many jobs
SVR_PACKED = 16             # and up to so many with their rows packed, 8 bytes a feature
LOT_WORK = 150_000_000      # training rows x features x trees that a task grows
PREDICTED = f"row long, {GROUP} string, family string, n_features int, prediction double"


def _frame(plan, rows: DataFrame) -> DataFrame:
    """Training rows and the rows to score (``row`` numbers them, in files of the shared
    folder), with the candidate features as one array."""
    features = [c for c in plan.data.columns if c not in (*KEYS, "market_cap")]
    x = F.array(*[F.col(f"`{c}`").cast("double") for c in features]).alias("x")
    rid = F.xxhash64("ticker", "fy").alias("rid")
    y = F.col("stock_price").cast("double").alias("y")
    train = plan.data.filter(F.col("split") == "train").select(F.col(GROUP).alias("industry"), F.lit(True).alias("train"), F.lit(-1).cast("long").alias("row"), rid, y, x)
    wanted = rows.select(F.col(GROUP).alias("industry"), F.lit(False).alias("train"), "row", rid, y, x)
    return train.unionByName(wanted)


class Local:
    """Fits and scores in a task; the same for search, scoring and saving."""

    def __init__(self, plan, industries, to: Settings):
        self.to = to
        features = [c for c in plan.data.columns if c not in (*KEYS, "market_cap")]
        self.pool = {i: [features.index(f) for f in plan.pools[i]] for i in industries}
        self.stats = {i: plan.stats[i] for i in industries}
        self.live = {i: plan.live[i] for i in industries}

    def arrays(self, ind: str, pdf: pd.DataFrame):
        """(x of the pool, y, row hash, train?) with training rows in order of their hash."""
        pdf = pdf.sort_values(["train", "rid", "row"], ascending=[False, True, True], kind="stable")
        x = np.vstack(pdf["x"].to_numpy())[:, self.pool[ind]].astype(float)
        return pdf, x, pdf["y"].to_numpy(dtype=float), pdf["rid"].to_numpy(dtype=np.int64), pdf["train"].to_numpy(dtype=bool)

    def fit(self, ind: str, family: str, ks: list[int], x, y, rid, tr):
        """Yields (k, model, predictions of the rows not in ``tr``). A tree model is
        (bin edges, largest target, start, trees)."""
        if family == SVR:
            mu, sd = self.stats[ind]
            z = (x - mu) / sd
            for k in ks:
                phi, theta = svr.fit(z[tr][:, :k], y[tr], z[tr][:svr.LANDMARKS, :k], svr.kernel_width(self.live[ind][:k]))
                yield k, (phi, theta), phi.predict(z[~tr][:, :k], theta)
            return
        edges = [trees.bin_edges(x[tr, j]) for j in range(max(ks))]
        bins = trees.to_bins(x[:, :max(ks)], edges)
        largest = float(np.max(np.abs(y[tr]), initial=0.0))
        for k in ks:
            a, b = bins[tr][:, :k], bins[~tr][:, :k]
            if family == BOOST:
                start, made, p = trees.boost(a, y[tr], largest, b, self.to)
            else:
                start, (made, p) = 0.0, trees.bag(a, y[tr], rid[tr], largest, b, self.to.forest_trees if family == FOREST else 1)
            yield k, (edges, largest, start, made), p


def predictions(plan, specs: list[tuple], rows: DataFrame, to: Settings = Settings()) -> DataFrame:
    """``rows`` (like ``plan.data``) scored by every fit of ``specs``: KEYS, family,
    n_features, prediction."""
    industries = sorted({s[0] for s in specs})
    numbered = cut(rows.filter(F.col(GROUP).isin(*industries))).withColumn("row", F.monotonically_increasing_id())
    frame = _frame(plan, numbered).filter(F.col("industry").isin(*industries))
    sizes = {r["industry"]: r["n"] for r in frame.groupBy("industry").agg(F.count(F.lit(1)).alias("n")).collect()}
    near = [s for s in specs if sizes.get(s[0], 0) <= to.local_rows * (SVR_SPAN if s[1] == SVR else 1)]
    far = [s for s in specs if s not in near]
    out = _by_passes(plan, far, frame, sizes, to) if far else None     # its tasks are the longer ones
    if near:
        more = _in_tasks(plan, near, frame, sizes, to)
        out = more if out is None else out.unionByName(more)
    return numbered.select("row", *KEYS).join(out.drop(GROUP), "row").select(*KEYS, "family", "n_features", "prediction")


def _jobs(specs) -> dict[str, list[tuple[str, list[int]]]]:
    """What the tasks of an industry fit: all single trees in one task, else one fit each."""
    out: dict = {}
    for ind, family, k in specs:
        jobs = out.setdefault(ind, [])
        single = next((j for j in jobs if j[0] == family == TREE), None)
        if single:
            single[1].append(k)
        else:
            jobs.append((family, [k]))
    return out


def _dealt(frame: DataFrame, jobs: dict) -> DataFrame:
    """Every row once per job of its industry."""
    n = F.create_map(*[F.lit(v) for ind in jobs for v in (ind, len(jobs[ind]))])
    return frame.filter(F.col("industry").isin(*jobs)).withColumn("job", F.explode(F.sequence(F.lit(0), n[F.col("industry")] - 1)))


def _in_tasks(plan, specs, frame: DataFrame, sizes: dict, to: Settings) -> DataFrame:
    """Every job of ``_jobs`` in a task of its own, costly jobs first."""
    local = Local(plan, {s[0] for s in specs}, to)
    rounds = {TREE: 1, FOREST: to.forest_trees, SVR: 50, BOOST: max(1, to.boost_rounds // 4)}
    lots = sorted(((ind, family, ks) for ind, jobs in _jobs(specs).items() for family, ks in jobs), key=lambda x: -sizes.get(x[0], 0) * sum(x[2]) * rounds[x[1]])
    each = F.create_map(*[F.lit(v) for ind in local.pool for v in (ind, F.array(*[F.lit(i) for i, x in enumerate(lots) if x[0] == ind]))])
    dealt = frame.filter(F.col("industry").isin(*local.pool)).withColumn("lot", F.explode(each[F.col("industry")]))

    def run(batches):
        got = list(batches)
        if got:
            rows = pd.concat(got, ignore_index=True)
            got.clear()
            for lot, pdf in rows.groupby("lot"):
                ind, family, ks = lots[lot]
                pdf, x, y, rid, tr = local.arrays(ind, pdf)
                wanted = pdf["row"].to_numpy()[~tr]
                for k, _, p in local.fit(ind, family, ks, x, y, rid, tr):
                    yield pd.DataFrame({"row": wanted, GROUP: ind, "family": family, "n_features": k, "prediction": p})

    return dealt.repartitionById(len(lots), F.col("lot")).mapInPandas(run, PREDICTED)


# ---- large industries ------------------------------------------------------------------------

def _edges(plan, frame: DataFrame, local: Local, sizes: dict) -> dict:
    """industry -> (bin edges of its pool, landmark rows), from the training rows with the
    smallest row hashes: about EDGE_ROWS of an industry, all of a smaller one."""
    share = F.create_map(*[F.lit(v) for i in local.pool for v in (i, min(1.0, trees.EDGE_ROWS / sizes[i]))])[F.col("industry")]
    least = frame.filter("train").filter((F.col("rid").cast("double") / 2.0 ** 64 + 0.5) <= share)

    def of(pdf: pd.DataFrame) -> pd.DataFrame:
        ind = pdf["industry"].iloc[0]
        _, x, _, _, _ = local.arrays(ind, pdf)
        return pd.DataFrame({"industry": [ind], "edges": [[trees.bin_edges(x[:, j]).tolist() for j in range(x.shape[1])]],
                             "landmarks": [x[:svr.LANDMARKS].tolist()]})

    found = least.groupBy("industry").applyInPandas(of, "industry string, edges array<array<double>>, landmarks array<array<double>>").collect()
    return {r["industry"]: ([np.array(e) for e in r["edges"]], np.array(r["landmarks"], dtype=float)) for r in found}


def _binned(frame: DataFrame, edges: dict, local: Local) -> DataFrame:
    """The rows with their pool's features as one byte each, written once."""
    def run(batches):
        for b in batches:
            for ind, g in b.groupby("industry"):
                x = np.vstack(g["x"].to_numpy())[:, local.pool[ind]].astype(float)
                yield g[["industry", "train", "row", "rid", "y"]].assign(bins=[r.tobytes() for r in trees.to_bins(x, edges[ind][0])])

    return cut(frame.mapInPandas(run, "industry string, train boolean, row long, rid long, y double, bins binary"))


def _by_passes(plan, specs, frame: DataFrame, sizes: dict, to: Settings) -> DataFrame:
    industries = sorted({s[0] for s in specs})
    local = Local(plan, industries, to)
    frame = frame.filter(F.col("industry").isin(*industries))
    train = frame.filter("train")
    info = {r["industry"]: r for r in train.groupBy("industry").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.abs("y")).alias("largest"), F.avg("y").alias("mean"), F.stddev_pop("y").alias("std")).collect()}
    largest = {i: float(info[i]["largest"]) for i in industries}
    edges = _edges(plan, frame, local, {i: info[i]["n"] for i in industries})
    binned = _binned(frame, edges, local) if any(s[1] != SVR for s in specs) else None
    out = []
    grown = {f: _prefixes(specs, f) for f in (TREE, FOREST)}
    near = {f: {i: k for i, k in ks.items() if info[i]["n"] <= to.bag_rows} for f, ks in grown.items()}
    if any(near.values()):
        out.append(_bagged_in_tasks(binned, near, {i: info[i]["n"] for i in industries}, largest, to))
    for family, n_trees in ((TREE, 1), (FOREST, to.forest_trees)):
        ks = {i: k for i, k in grown[family].items() if i not in near[family]}
        if ks:
            models, value = trees.grown(binned, ks, n_trees, largest, to.local_rows)
            of = frame.sparkSession.createDataFrame([(i, m.industry, m.k, GRID / largest[m.industry] if largest[m.industry] else 1.0) for i, m in enumerate(models)],
                                                    f"model int, {GROUP} string, n_features int, grid double")
            out.append(value.join(F.broadcast(of), "model").groupBy("row", GROUP, "n_features").agg((F.avg("value") / F.first("grid")).alias("prediction"))
                       .withColumn("family", F.lit(family)))
    boost = _prefixes(specs, BOOST)
    near = {i: k for i, k in boost.items() if info[i]["n"] <= to.boost_rows}
    if near:
        out.append(_boosted_in_tasks(binned, near, {i: info[i]["n"] for i in near}, largest, to))
    ks = {i: k for i, k in boost.items() if i not in near}
    if ks:
        _, scored = trees.boosted(binned, ks, largest, start_of(train, largest), to)
        size = F.create_map(*[F.lit(v) for i in ks for v in (i, F.array(*[F.lit(k) for k in ks[i]]))])
        pairs = F.explode(F.arrays_zip(size[F.col("industry")].alias("n_features"), F.col("margins").alias("prediction"))).alias("p")
        out.append(scored.filter(~F.col("train")).select("row", F.col("industry").alias(GROUP), pairs)
                   .select("row", GROUP, F.lit(BOOST).alias("family"), "p.n_features", "p.prediction"))
    vectors = _prefixes(specs, SVR)
    near = {i: k for i, k in vectors.items() if sizes[i] <= to.local_rows * SVR_PACKED}
    if near:
        out.append(_svr_in_tasks(near, frame, local, edges, {i: info[i]["n"] for i in near}))
    ks = {i: k for i, k in vectors.items() if i not in near}
    if ks:
        out.append(_svr_by_passes(plan, ks, frame, local, edges, info))
    names = ["row", GROUP, "family", "n_features", "prediction"]
    whole = out[0].select(*names)
    for more in out[1:]:
        whole = whole.unionByName(more.select(*names))
    return whole


def _in_lots(rows: DataFrame, lots: list[tuple], packed: str, run, schema: str) -> DataFrame:
    """What ``run`` makes of the rows of each lot. Lots are (industry, bytes of ``packed`` that
    it takes, cost, what to do); the rows of an industry meet once per lot in a task, costly
    lots first. ``run`` gets the lot and its rows' columns."""
    lots = sorted(lots, key=lambda x: -x[2])
    of: dict = {}
    for i, (ind, width, _, _) in enumerate(lots):
        of.setdefault(ind, []).append((i, width))
    each = F.create_map(*[F.lit(v) for ind, mine in of.items() for v in (ind, F.array(*[F.struct(F.lit(i).alias("lot"), F.lit(n).alias("width")) for i, n in mine]))])
    dealt = rows.filter(F.col("industry").isin(*of)).withColumn("l", F.explode(each[F.col("industry")])) \
        .select("l.lot", "train", "row", "rid", "y", F.substring(packed, F.lit(1), F.col("l.width")).alias("packed"))

    def task(batches):
        got = [trees.batch_columns(b) for b in batches]
        if got:
            cols = {c: np.concatenate([g[c] for g in got]) for c in got[0]}
            got.clear()
            for lot in np.unique(cols["lot"]):
                at = np.flatnonzero(cols["lot"] == lot)
                yield from run(lots[lot], {c: v[at] for c, v in cols.items()} if len(at) < len(cols["lot"]) else cols)

    return dealt.repartitionById(len(lots), F.col("lot")).mapInArrow(task, schema)


def _numbered(row: np.ndarray, ind: str, family: str, k: int, p: np.ndarray) -> pa.RecordBatch:
    """Predictions as PREDICTED."""
    n = len(row)
    return pa.RecordBatch.from_pydict({"row": pa.array(row.astype(np.int64)), GROUP: pa.array([ind] * n, pa.string()), "family": pa.array([family] * n, pa.string()),
                                       "n_features": pa.array(np.full(n, k, np.int32)), "prediction": pa.array(np.asarray(p, dtype=np.float64))})


def _bagged_in_tasks(binned: DataFrame, ks: dict[str, dict[str, list[int]]], n: dict[str, int], largest: dict[str, float], to: Settings) -> DataFrame:
    """Predictions of single trees and forests: a task grows some trees of an industry for all
    prefixes and adds up their values, which another sum completes."""
    lots = []
    for family, numbers in ((TREE, [-1]), (FOREST, list(range(to.forest_trees)) if to.forest_trees > 1 else [-1])):
        for ind, mine in ks[family].items():
            work = n[ind] * sum(mine)
            many = max(1, min(len(numbers), -(-work * len(numbers) // LOT_WORK)))
            lots += [(ind, max(mine), work * len(part), (family, mine, part)) for i in range(many) if (part := numbers[i::many])]

    def run(lot, cols):
        ind, _, _, (family, mine, numbers) = lot
        bins, tr = trees.unpacked(cols["packed"]), cols["train"].astype(bool)
        wanted, made, out = np.ascontiguousarray(bins[~tr]), 0, np.zeros((len(mine), int((~tr).sum())))
        for j, tree in trees.bagged(bins[tr], trees.to_grid(cols["y"][tr].astype(float), largest[ind]), cols["rid"][tr].astype(np.int64), mine, numbers):
            out[j] += tree.predict(wanted)
            made += j == 0
        row = cols["row"][~tr].astype(np.int64)
        for at in range(0, len(row), 10_000):
            part = out[:, at:at + 10_000].T
            yield pa.RecordBatch.from_pydict({
                "row": pa.array(row[at:at + 10_000]), GROUP: pa.array([ind] * len(part), pa.string()), "family": pa.array([family] * len(part), pa.string()),
                "trees": pa.array(np.full(len(part), made, np.int64)), "v": pa.FixedSizeListArray.from_arrays(pa.array(part.ravel()), len(mine)).cast(pa.list_(pa.float64()))})

    sums = _in_lots(binned, lots, "bins", run, f"row long, {GROUP} string, family string, trees long, v array<double>")
    size, scale = ({(i, f): v(i, mine) for f in (TREE, FOREST) for i, mine in ks[f].items()} for v in (
        lambda i, mine: F.array(*[F.lit(k) for k in mine]), lambda i, mine: F.lit(largest[i] / GRID)))
    name = lambda x: F.create_map(*[y for (i, f), v in x.items() for y in (F.lit(f"{f} {i}"), v)])[F.concat_ws(" ", "family", GROUP)]
    most = max(len(mine) for by in ks.values() for mine in by.values())
    added = sums.groupBy("row", GROUP, "family").agg(F.sum("trees").alias("trees"), *[F.sum(F.get("v", F.lit(j))).alias(f"v{j}") for j in range(most)])
    pairs = F.arrays_zip(name(size).alias("n_features"), F.array(*[F.col(f"v{j}") / F.greatest("trees", F.lit(1)) * name(scale) for j in range(most)]).alias("prediction"))
    return added.select("row", GROUP, "family", F.explode(pairs).alias("p")).select("row", GROUP, "family", "p.n_features", "p.prediction").filter("n_features IS NOT NULL")


def _boosted_in_tasks(binned: DataFrame, ks: dict[str, list[int]], n: dict[str, int], largest: dict[str, float], to: Settings) -> DataFrame:
    """Predictions of boosted trees, a task per industry and prefix; a task gets the bytes of
    its prefix alone."""
    def run(lot, cols):
        ind, k = lot[:2]
        bins, tr, y = trees.unpacked(cols["packed"]), cols["train"].astype(bool), cols["y"].astype(float)
        yield _numbered(cols["row"][~tr], ind, BOOST, k, trees.boost(bins[tr], y[tr], largest[ind], bins[~tr], to)[2])

    return _in_lots(binned, [(i, k, n[i] * k, None) for i, mine in ks.items() for k in mine], "bins", run, PREDICTED)


def _svr_in_tasks(ks: dict[str, list[int]], frame: DataFrame, local: Local, edges: dict, n: dict[str, int]) -> DataFrame:
    """Predictions of support vector regression, a task per industry and prefix; a task gets
    the features of its prefix alone."""
    def pack(batches):
        for b in batches:
            for ind, g in b.groupby("industry"):
                x = np.vstack(g["x"].to_numpy())[:, local.pool[ind]].astype(float)
                yield g[["industry", "train", "row", "rid", "y"]].assign(x=[r.tobytes() for r in x])

    def run(lot, cols):
        ind, width = lot[:2]
        k, (mu, sd), tr = width // 8, local.stats[ind], cols["train"].astype(bool)
        z = (np.frombuffer(b"".join(cols.pop("packed")), np.float64).reshape(len(tr), k) - mu[:k]) / sd[:k]
        phi, theta = svr.fit(z[tr], cols["y"][tr].astype(float), (edges[ind][1][:, :k] - mu[:k]) / sd[:k], svr.kernel_width(local.live[ind][:k]))
        yield _numbered(cols["row"][~tr], ind, SVR, k, phi.predict(z[~tr], theta))

    packed = cut(frame.filter(F.col("industry").isin(*ks)).mapInPandas(pack, "industry string, train boolean, row long, rid long, y double, x binary"))
    return _in_lots(packed, [(i, 8 * k, n[i] * (k + 50), None) for i, mine in ks.items() for k in mine], "x", run, PREDICTED)


def _prefixes(specs, family: str) -> dict[str, list[int]]:
    out: dict = {}
    for ind, f, k in specs:
        if f == family:
            out.setdefault(ind, []).append(k)
    return out


def start_of(train: DataFrame, largest: dict[str, float]) -> dict[str, float]:
    """The mean training target, from the grid, as fits in memory take it."""
    grid = F.create_map(*[F.lit(v) for i in largest for v in (i, GRID / largest[i] if largest[i] else 0.0)])[F.col("industry")]
    q = F.rint(F.col("y") * grid).cast("long")
    return {r["industry"]: float(r["q"]) / r["n"] * (largest[r["industry"]] / GRID)
            for r in train.groupBy("industry").agg(F.sum(q).alias("q"), F.count(F.lit(1)).alias("n")).collect()}


def _svr_models(ks: dict, train: DataFrame, local: Local, edges: dict, info: dict):
    """({model: fit}, {model: (industry, k, mean, std, landmarks, gamma)}) by passes."""
    pool = F.create_map(*[F.lit(v) for i in ks for v in (i, F.array(*[F.lit(j) for j in local.pool[i]]))])[F.col("industry")]
    rows = cut(train.filter(F.col("industry").isin(*ks)).select("industry", "y", F.transform(pool, lambda j: F.element_at("x", j + 1)).alias("x")))
    models = {}
    for ind in ks:
        mu, sd = local.stats[ind]
        for k in ks[ind]:
            models[len(models)] = (ind, k, mu[:k], sd[:k], (edges[ind][1][:, :k] - mu[:k]) / sd[:k], svr.kernel_width(local.live[ind][:k]))
    return svr.fit_by_passes(rows, models, {i: (info[i]["n"], float(info[i]["mean"]), float(info[i]["std"])) for i in ks}), models


def _svr_by_passes(plan, ks: dict, frame: DataFrame, local: Local, edges: dict, info: dict) -> DataFrame:
    fitted, models = _svr_models(ks, frame.filter("train"), local, edges, info)

    def score(batches):
        for b in batches:
            for ind, g in b.groupby("industry"):
                x = np.vstack(g["x"].to_numpy())[:, local.pool[ind]].astype(float)
                for i, (phi, theta) in fitted.items():
                    if models[i][0] == ind:
                        k, mu, sd = models[i][1:4]
                        yield pd.DataFrame({"row": g["row"].to_numpy(), GROUP: ind, "family": SVR, "n_features": k, "prediction": phi.predict((x[:, :k] - mu) / sd, theta)})

    return frame.filter(~F.col("train") & F.col("industry").isin(*ks)).select("industry", "row", "x").mapInPandas(score, PREDICTED)


# ---- models as a table (S11) --------------------------------------------------------------------

MODEL = ("industry string, family string, n_features int, features array<string>, tree int, start double, scale double, "
         "feature array<int>, threshold array<double>, left array<int>, right array<int>, value array<double>, "
         "mean array<double>, std array<double>, landmarks array<array<double>>, gamma double, coef array<double>, intercept double")
MODEL_COLUMNS = [c.split()[0] for c in MODEL.split(", ")]
NODES = 5_000_000           # tree nodes that are broadcast at a time


def _tree_row(ind, family, k, names, number, start, scale, edges, tree, unit) -> list:
    at = [float(edges[f][c]) if f >= 0 else 0.0 for f, c in zip(tree.feature, tree.cut)]
    return [ind, family, k, names[:k], number, start, scale, [int(f) for f in tree.feature], at, [int(x) for x in tree.left],
            [int(x) for x in tree.right], [float(v) * unit for v in tree.value], None, None, None, None, None, None]


def _svr_row(ind, k, names, mu, sd, phi, theta) -> list:
    return [ind, SVR, k, names[:k], 0, 0.0, 1.0, None, None, None, None, None, [float(v) for v in mu[:k]], [float(v) for v in sd[:k]],
            phi.landmarks.tolist(), float(phi.gamma), (phi.map @ theta[:-1]).tolist(), float(theta[-1])]


def _rows_of(ind, family, k, names, stats, model, rate) -> list[list]:
    if family == SVR:
        return [_svr_row(ind, k, names, *stats, *model)]
    edges, largest, start, made = model
    scale = rate if family == BOOST else 1.0 / max(len(made), 1)
    return [_tree_row(ind, family, k, names, t, start, scale, edges, tree, largest / GRID) for t, tree in enumerate(made)]


def fit_models(plan, specs: list[tuple], to: Settings = Settings()) -> DataFrame:
    """The fits of ``specs`` as rows (MODEL): one per tree, or one per support vector
    regression. ``score`` applies them."""
    spark, industries = plan.data.sparkSession, sorted({s[0] for s in specs})
    local, jobs, names = Local(plan, industries, to), _jobs(specs), {i: plan.pools[i] for i in industries}
    none = plan.data.limit(0).withColumn("row", F.lit(0).cast("long"))
    frame = _frame(plan, none).filter(F.col("industry").isin(*industries))
    sizes = {r["industry"]: r["n"] for r in frame.groupBy("industry").agg(F.count(F.lit(1)).alias("n")).collect()}
    large = [i for i in industries if sizes.get(i, 0) > to.local_rows]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        ind = pdf["industry"].iloc[0]
        family, ks = jobs[ind][int(pdf["job"].iloc[0])]
        pdf, x, y, rid, tr = local.arrays(ind, pdf)
        return pd.DataFrame([row for k, model, _ in local.fit(ind, family, ks, x, y, rid, tr)
                             for row in _rows_of(ind, family, k, names[ind], local.stats[ind], model, to.boost_rate)], columns=MODEL_COLUMNS)

    out = spark.createDataFrame([], MODEL)
    if small := {i: j for i, j in jobs.items() if i not in large}:
        out = out.unionByName(_dealt(frame, small).groupBy("industry", "job").applyInPandas(run, MODEL))
    if large:
        out = out.unionByName(_models_by_passes(plan, [s for s in specs if s[0] in large], frame, to, names))
    return out


def _models_by_passes(plan, specs, frame: DataFrame, to: Settings, names: dict) -> DataFrame:
    spark, industries = frame.sparkSession, sorted({s[0] for s in specs})
    local, frame = Local(plan, industries, to), frame.filter(F.col("industry").isin(*industries))
    info = {r["industry"]: r for r in frame.groupBy("industry").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.abs("y")).alias("largest"), F.avg("y").alias("mean"), F.stddev_pop("y").alias("std")).collect()}
    largest = {i: float(info[i]["largest"]) for i in industries}
    edges = _edges(plan, frame, local, {i: info[i]["n"] for i in industries})
    binned, rows, out = _binned(frame, edges, local), [], spark.createDataFrame([], MODEL)
    if ks := _prefixes(specs, BOOST):
        start = start_of(frame, largest)
        made, _ = trees.boosted(binned, ks, largest, start, to)
        rows += [r for (i, k), t in made.items() for r in _rows_of(i, BOOST, k, names[i], None, (edges[i][0], largest[i], start[i], t), to.boost_rate)]
    if ks := _prefixes(specs, SVR):
        fitted, models = _svr_models(ks, frame, local, edges, info)
        rows += [r for i, m in models.items() for r in _rows_of(m[0], SVR, m[1], names[m[0]], local.stats[m[0]], fitted[i], 0.0)]
    if rows:
        out = out.unionByName(spark.createDataFrame(rows, MODEL))
    for family, n_trees in ((TREE, 1), (FOREST, to.forest_trees)):
        if ks := _prefixes(specs, family):
            out = out.unionByName(trees.whole_trees(binned, ks, n_trees, largest, to.local_rows).mapInPandas(_named(family, edges, largest, names, n_trees), MODEL))
    return out


def _named(family: str, edges: dict, largest: dict, names: dict, n_trees: int):
    """Merged trees of passes as MODEL rows."""
    def run(batches):
        for b in batches:
            yield pd.DataFrame([_tree_row(r.industry, family, int(r.k), names[r.industry], int(r.tree), 0.0, 1.0 / n_trees, edges[r.industry][0],
                                          trees.Tree(r.feature, r.cut, r.left, r.right, r.value), largest[r.industry] / GRID)
                                for r in b.itertuples()], columns=MODEL_COLUMNS)

    return run


def score(models: DataFrame, rows: DataFrame) -> DataFrame:
    """``rows`` (the industry column and the feature columns) with ``prediction`` by the
    fitted models of a ``fit_models`` table, one model an industry; rows of other
    industries drop. Trees are broadcast NODES nodes at a time, each lot a narrow pass
    that adds to the prediction."""
    total = models.agg(F.sum(F.greatest(F.size("feature"), F.lit(1)))).first()[0] or 0
    lots = max(1, -(-total // NODES))
    dealt = models.withColumn("lot", F.pmod(F.xxhash64("industry", "tree"), F.lit(lots)))
    held = [r["industry"] for r in models.select("industry").distinct().collect()]
    out = rows.filter(F.col(GROUP).isin(*held)).withColumn("prediction", F.lit(0.0))
    for lot in range(lots):
        out = _score_lot([r.asDict() for r in dealt.filter(F.col("lot") == lot).collect()], out)
    return out


def _score_lot(models: list[dict], rows: DataFrame) -> DataFrame:
    by: dict = {}
    for m in models:
        by.setdefault(m["industry"], []).append(m)
    sent = rows.sparkSession.sparkContext.broadcast(by)

    def run(batches):
        for b in batches:
            for ind, g in b.groupby(GROUP):
                add = np.zeros(len(g))
                for m in sent.value.get(ind, ()):
                    x = g[m["features"]].to_numpy(dtype=float)
                    add = add + m["scale"] * _apply(m, x) + (m["start"] if m["tree"] == 0 else 0.0)
                yield g.assign(prediction=g["prediction"] + add)

    return rows.mapInPandas(run, rows.schema)


def _apply(m: dict, x: np.ndarray) -> np.ndarray:
    if m["family"] == SVR:
        z = (x - np.array(m["mean"])) / np.array(m["std"])
        marks = np.array(m["landmarks"])
        d = (z ** 2).sum(1)[:, None] + (marks ** 2).sum(1) - 2 * z @ marks.T
        return np.exp(-m["gamma"] * np.maximum(d, 0)) @ np.array(m["coef"]) + m["intercept"]
    return trees.Tree(m["feature"], m["threshold"], m["left"], m["right"], m["value"]).predict(x)
