"""Operator 1: mixing sources to target token weights by entropy balancing.

Document rates r minimise the weighted relative entropy to one copy each,
sum w (r log r - r + 1) with w = size^(1 - tilt), under one token constraint per
source, sum size * r = target, and 0 <= r <= cap. The convex dual has one
multiplier per source; its solution is an exponentially tilted rate

    r = min(cap, exp(lambda_source * (size / mean size) ** tilt)).

The dual is solved by Newton steps over all sources at once: one grouped
aggregate over the (source, size) histogram of all documents per step, kept in a
bracket so that a step can't run away. Rates are then rounded into whole copies,
``floor(rate + u + shift)`` with u a hash of the row; a source's shift is chosen
by two exact histograms, for each of ``tries`` hash seeds, so that its copies
come as near its target as whole documents allow. Everything is per source or per
(source, bin); no documents reach the driver, and a hot source is summed before every
shuffle. Sums that decide anything are exact (integers or decimals), so that no order of
adding up can change a rate or a rounding.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut, word_count

BINS = 1024
PART_ROWS = 1_000_000   # rows of a part that a hot source is dealt to, and at least LEAST_PARTS parts
LEAST_PARTS = 64
TOLERANCE = 1e-10
MAX_STEPS = 100


def _ranked(sources: DataFrame) -> DataFrame:
    """``sid``: the rank of a source by code point, null last, from 0. A range sort;
    the driver sees one count per partition."""
    placed = cut(sources.orderBy(F.col("source").asc_nulls_last())).select("*", F.spark_partition_id().alias("pid"),
                                                                           F.monotonically_increasing_id().alias("at"))
    placed = placed.withColumn("at", F.col("at").bitwiseAND(F.lit((1 << 33) - 1)))
    before, counts = 0, {}
    for r in sorted(placed.groupBy("pid").count().collect()):
        counts[r["pid"]] = before
        before += r["count"]
    if not counts:
        return sources.withColumn("sid", F.lit(0).cast("long"))
    offset = F.create_map(*[F.lit(x) for kv in counts.items() for x in kv])
    return placed.withColumn("sid", (F.col("at") + offset[F.col("pid")]).cast("long")).drop("pid", "at")


def source_targets(sources: DataFrame, weights, cap: float, share: float = 1.0) -> DataFrame:
    """Adds sid, weight and target to (source, source_size, n_docs): ``share`` of all
    sizes dealt by weight; a source stops at ``cap`` times its size and the excess
    is dealt again by weight until none is above."""
    ws = F.array(*[F.lit(float(w)) for w in weights])
    s = cut(_ranked(sources).withColumn("weight", F.element_at(ws, (F.col("sid") % len(weights) + 1).cast("int")))
            .withColumn("most", F.lit(float(cap)) * F.col("source_size")))
    total = share * float(s.agg(F.sum("source_size")).first()[0] or 0)
    # sources fill up in the order of most / weight; sums in that order say how many do: per
    # partition of a range sort, whose totals (whole numbers, so exact) go to the driver
    placed = cut(s.select("sid", "weight", "most", (F.col("most") / F.col("weight")).alias("full_at")).orderBy("full_at", "sid")) \
        .withColumn("pid", F.spark_partition_id())
    before, most, weight = {}, 0.0, 0.0
    for r in sorted(placed.groupBy("pid").agg(F.sum("most").alias("most"), F.sum("weight").alias("weight")).collect()):
        before[r["pid"]] = (most, weight)
        most, weight = most + r["most"], weight + r["weight"]
    if not before:
        return s.withColumn("target", F.lit(0.0)).drop("most")
    by = Window.partitionBy("pid").orderBy("full_at", "sid")
    of = F.create_map(*[x for pid, (m, w) in before.items() for x in (F.lit(pid), F.struct(F.lit(m).alias("m"), F.lit(w).alias("w")))])[F.col("pid")]
    upto = placed.select("full_at", "sid", (of["m"] + F.sum("most").over(by)).alias("m"), (of["w"] + F.sum("weight").over(by)).alias("w"))
    last = upto.filter(F.col("m") + F.col("full_at") * (F.lit(weight) - F.col("w")) <= F.lit(total)) \
        .agg(F.max_by(F.struct("m", "w", "full_at"), F.struct("full_at", "sid")).alias("l")).first()["l"]
    m, w, level = (last["m"], last["w"], last["full_at"]) if last else (0.0, 0.0, 0.0)
    if w < weight:      # words for a weight of one; a source gets min(most, weight * level)
        level = (total - m) / (weight - w)
    return s.withColumn("target", F.least("most", F.col("weight") * F.lit(level))).drop("most")


def _rate(lam: Column, z: Column, cap: float) -> Column:
    return F.when(lam.isNull(), F.lit(float(cap))).otherwise(
        F.least(F.lit(float(cap)), F.exp(F.least(lam * z, F.lit(50.0)))))


def solve_dual(hist: DataFrame, targets: DataFrame, cap: float, tilt: float) -> DataFrame:
    """Adds ``scale`` (mean size) and ``lam`` to ``targets``. ``hist``: (sid, size, n) of
    all documents with words. lam is null where every rate is the cap."""
    full = F.col("target") >= F.lit(cap * (1 - 1e-12)) * F.col("source_size")
    state = cut(targets.withColumn("scale", F.col("source_size") / F.greatest("n_docs", F.lit(1)))
                .withColumns({"lam": F.when(~full, F.lit(0.0)), "lo": F.lit(None).cast("double"),
                              "hi": F.lit(None).cast("double"), "err": F.lit(None).cast("double")}))
    z = F.pow(F.col("size") / F.col("scale"), F.lit(float(tilt)))
    mass = F.col("n") * F.col("size")
    for _ in range(MAX_STEPS):
        r = _rate(F.col("lam"), z, cap)
        sums = hist.join(state.filter("lam is not null").select("sid", "scale", "lam"), "sid") \
            .groupBy("sid").agg(exact(mass * r).alias("got"), exact(F.when(r < cap, mass * z * r)).alias("slope"))
        gap = F.col("got") - F.col("target")
        nxt = state.join(sums, "sid", "left") \
            .withColumns({"lo": F.when(gap < 0, F.col("lam")).otherwise(F.col("lo")),
                          "hi": F.when(gap > 0, F.col("lam")).otherwise(F.col("hi"))}) \
            .withColumn("step", F.least(F.greatest(F.try_divide(gap, "slope"), F.lit(-8.0)), F.lit(8.0))) \
            .withColumn("step", F.col("lam") - F.coalesce("step", F.signum(gap))) \
            .withColumn("step", F.when((F.col("step") <= F.col("lo")) | (F.col("step") >= F.col("hi")),
                                       F.coalesce((F.col("lo") + F.col("hi")) / 2, F.col("lam") - 8 * F.signum(gap)))
                        .otherwise(F.col("step"))) \
            .withColumn("err", F.abs(gap) / F.greatest("target", F.lit(1.0))) \
            .withColumn("lam", F.when(F.col("err") <= TOLERANCE, F.col("lam")).otherwise(
                F.coalesce(F.col("step"), F.col("lam"))))
        state = cut(nxt.select(*state.columns))
        if (state.agg(F.max("err")).first()[0] or 0.0) <= TOLERANCE:
            return state.drop("lo", "hi", "err")
    raise ArithmeticError(f"the mix did not come within {TOLERANCE} of its targets in {MAX_STEPS} steps")


def exact(x: Column) -> Column:
    """A sum of doubles as decimals of twelve places, which any order of adding leaves the same."""
    return F.sum(x.cast("decimal(38,12)")).cast("double")


def _places(rate: Column, mark: Column, seed: Column, cap: int) -> Column:
    """For k = 1..cap the place, -1..BINS^2, of the shift from which a row has k copies:
    ``rate + u + shift >= k`` for shifts from -1 to 1, u a hash of mark and seed."""
    fine = BINS * BINS
    u = F.pmod(F.xxhash64(mark, seed), F.lit(1 << 40)) / float(1 << 40)
    return F.array(*[F.greatest(F.lit(-1), F.least(F.lit(fine), F.floor((k - rate - u + 1) * (fine / 2)))).cast("long")
                     for k in range(1, cap + 1)])


def _with_state(rows: DataFrame, state: DataFrame, parts: int, on=("sid",)) -> DataFrame:
    """rows (..., mark) joined to a per-source table. A source may hold a third of all
    rows: each is dealt to ``parts`` parts by its mark, and the small table repeated."""
    salted = state.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
    return rows.withColumn("salt", F.pmod("mark", F.lit(parts))).join(salted, [*on, "salt"]).drop("salt")


def _rated(rows: DataFrame, state: DataFrame, cap: float, tilt: float, parts: int) -> DataFrame:
    """rows (..., sid, size, mark) with their source's state and their rate."""
    z = F.pow(F.col("size") / F.col("scale"), F.lit(float(tilt)))
    rate = F.when(F.col("size") > 0, _rate(F.col("lam"), z, cap)).otherwise(F.lit(1.0))
    return _with_state(rows, state, parts).withColumn("rate", rate)


def choose_shift(rated: DataFrame, state: DataFrame, cap: int, tries: int, parts: int) -> DataFrame:
    """Adds ``seed`` and ``edge`` to ``state``: a row has as many copies as it has places
    <= edge. The shift that comes nearest the target is found for each of ``tries``
    seeds; the best seed of a source is kept."""
    by = Window.partitionBy("sid", "seed").orderBy("bin")
    steps = (rated.filter("size > 0").select("sid", "size", "rate", "mark", F.explode(F.array(*map(F.lit, range(tries)))).alias("seed"))
             .select("sid", "seed", "size", "mark", F.explode(_places(F.col("rate"), F.col("mark"), F.col("seed"), cap)).alias("at")))
    goal = state.select("sid", "target")

    def sums(x: DataFrame, name: Column) -> DataFrame:
        return (x.groupBy("sid", "seed", name.alias("bin")).agg(F.sum("size").alias("words"))
                .withColumn("upto", F.sum("words").over(by.rowsBetween(Window.unboundedPreceding, 0))))

    coarse = cut(sums(steps, F.floor(F.col("at") / BINS)).join(goal, "sid"))
    pick = coarse.groupBy("sid", "seed").agg(
        F.coalesce(F.min(F.when(F.col("upto") >= F.col("target"), F.col("bin"))), F.max("bin")).alias("b"))
    below = coarse.join(pick, ["sid", "seed"]).groupBy("sid", "seed", "b", "target").agg(
        F.coalesce(F.max(F.when(F.col("bin") < F.col("b"), F.col("upto"))), F.lit(0)).alias("below"))
    below = cut(below)
    inside = _with_state(steps, below.select("sid", "seed", "b"), parts, ("sid", "seed")).filter(F.floor(F.col("at") / BINS) == F.col("b"))
    fine = sums(inside, F.col("at")).join(below, ["sid", "seed"]) \
        .select("sid", "seed", F.col("bin").alias("edge"), F.abs(F.col("upto") + F.col("below") - F.col("target")).alias("off"))
    none = below.select("sid", "seed", (F.col("b") * BINS - 1).alias("edge"), F.abs(F.col("below") - F.col("target")).alias("off"))
    best = fine.unionByName(none).groupBy("sid").agg(
        F.min_by(F.struct("seed", "edge"), F.struct("off", "seed", "edge")).alias("best"))
    return cut(state.join(best, "sid", "left").withColumns({
        "seed": F.coalesce("best.seed", F.lit(0)), "edge": F.coalesce("best.edge", F.lit(BINS * BINS // 2))}).drop("best"))


def copies(cap: int) -> Column:
    """Copies of a rated row under its source's seed and edge."""
    at = _places(F.col("rate"), F.col("mark"), F.col("seed"), cap)
    return F.size(F.filter(at, lambda a: a <= F.greatest(F.col("edge"), F.lit(-1)))).cast("long")


def keyed(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(id, source, size, h): h tells texts apart."""
    return docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                       word_count(F.col(text_col)).alias("size"), F.xxhash64(F.col(text_col)).alias("h"))


MARK = ("id", "source", "size", "h", "k")


def counted_up(rows: DataFrame, n: str, k: str, step: int = 1000) -> DataFrame:
    """Every row ``n`` times, numbered from 1 in ``k``; no array is longer than ``step``
    however many equal rows there are (to step ** 4)."""
    zero, base = F.lit(0).cast("long"), F.lit(0).cast("long")
    for i, unit in enumerate((step ** 3, step ** 2, step, 1)):
        left = F.col(n) - 1 - base          # the last number below this branch
        top = F.least(F.floor(left / unit).cast("long"), F.lit(step - 1).cast("long"))
        rows = rows.withColumn(f"{k}_{i}", F.explode(F.sequence(zero, top)))
        base = base + F.col(f"{k}_{i}") * unit
    return rows.withColumn(k, base + 1).drop(n, *[f"{k}_{i}" for i in range(4)])


def mix_state(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
              weights=(5, 2, 1), cap: int = 3, share: float = 1.0, tilt: float = 0.5, tries: int = 4):
    """(state, rows, parts): per source the target, multiplier and rounding edge; the rows
    (id, source, size, h, k, sid, mark), k counting equal rows from 1; and to how many parts
    a source's rows are dealt."""
    rows = cut(keyed(docs, id_col, text_col, source_col).groupBy("id", "source", "size", "h").agg(F.count(F.lit(1)).alias("n")))
    sources = rows.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"),
                                         F.sum(F.when(F.col("size") > 0, F.col("n"))).alias("n_docs")) \
        .withColumn("n_docs", F.coalesce("n_docs", F.lit(0)))
    targets = cut(source_targets(sources, weights, cap, share))
    parts = max(LEAST_PARTS, -(-(targets.agg(F.max("n_docs")).first()[0] or 0) // PART_ROWS))
    rows = cut(rows.join(targets.select(F.col("source").alias("s2"), "sid"), F.col("source").eqNullSafe(F.col("s2"))).drop("s2"))
    hist = cut(rows.filter("size > 0").groupBy("sid", "size").agg(F.sum("n").alias("n")))
    state = solve_dual(hist, targets, cap, tilt).drop("source")
    rows = counted_up(rows, "n", "k").withColumn("mark", F.xxhash64(*MARK))
    return choose_shift(_rated(rows, state, cap, tilt, parts), state, cap, tries, parts), rows, parts


def entropy_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights=(5, 2, 1), cap: int = 3, share: float = 1.0, tilt: float = 0.5, tries: int = 4) -> DataFrame:
    """One row per row of ``docs``: id, source, size (words), source_size, target (its
    source's), rate, copies, taken (= copies * size).

    Sources by code point, null last, take the ``weights`` in turn. A null text has
    size 0 and is taken 0 words; a source without words has target 0. Equal rows are
    told apart by a running number, so each keeps its own row and its own rounding;
    null ids are ids like any other. An empty table gives an empty result. Reruns
    agree: nothing depends on partitions or row order. Other columns are ignored."""
    state, rows, parts = mix_state(docs, id_col, text_col, source_col, weights, cap, share, tilt, tries)
    out = _rated(rows, state, cap, tilt, parts).withColumn("copies", copies(cap))
    return out.select(F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target", "rate",
                      "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    weights=(5, 2, 1), cap: int = 3, share: float = 1.0, tilt: float = 0.5, tries: int = 4, few: int = 50_000) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as ``entropy_mix`` copies it, with
    the columns of ``docs``. Rows with equal id, source and text together get the copies
    of all of them. Only the per-source state is joined to the texts, and the table of
    such repeated rows (broadcast up to ``few``)."""
    names = docs.columns
    state, rows, parts = mix_state(docs, id_col, text_col, source_col, weights, cap, share, tilt, tries)
    of = rows.select("source", "sid").distinct()
    whole = docs.select(F.struct(*names).alias("row")).select(
        "row", F.col("row")[id_col].alias("id"), F.col("row")[source_col].alias("source"),
        word_count(F.col("row")[text_col]).alias("size"), F.xxhash64(F.col("row")[text_col]).alias("h"))
    # rows that are alike share their copies: each the whole part, one of them the rest
    alike = cut(_rated(rows, state, cap, tilt, parts).withColumn("copies", copies(cap)).groupBy("id", "source", "size", "h")
                .agg(F.count(F.lit(1)).alias("n"), F.sum("copies").alias("all")).filter("n > 1"))
    repeated = alike.count()
    other = alike.select(F.col("id").alias("id2"), F.col("source").alias("source2"), F.col("size").alias("size2"), F.col("h").alias("h2"), "n", "all")
    same = F.col("id").eqNullSafe(F.col("id2")) & F.col("source").eqNullSafe(F.col("source2")) & (F.col("size") == F.col("size2")) & (F.col("h") == F.col("h2"))
    if repeated:
        whole = whole.join(F.broadcast(other) if repeated <= few else other, same, "left")
    else:
        whole = whole.withColumns({"n": F.lit(None).cast("long"), "all": F.lit(None).cast("long")})
    single = whole.filter("n IS NULL").withColumn("k", F.lit(1).cast("long")).withColumn("mark", F.xxhash64(*MARK)) \
        .join(of.withColumnRenamed("source", "s2"), F.col("source").eqNullSafe(F.col("s2"))).drop("s2")
    single = _rated(single.drop("n", "all"), state, cap, tilt, parts).select("row", copies(cap).alias("copies"))
    if not repeated:
        return counted_up(single.filter("copies > 0"), "copies", "copy").select("row.*")
    shared = whole.filter("n IS NOT NULL")
    each = shared.select("row", F.expr("all div n").alias("copies"))
    rest = shared.filter("all % n > 0").groupBy("id", "source", "size", "h").agg(
        F.min_by("row", F.xxhash64("row")).alias("row"), F.first(F.expr("all % n")).alias("copies")).select("row", "copies")
    out = single.unionByName(each).unionByName(rest).filter("copies > 0")
    return counted_up(out, "copies", "copy").select("row.*")
