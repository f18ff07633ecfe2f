"""Concept resolution over long facts.

A *concept* (panel column) may be reported under several alternative tags.
The concept table ``(concept, tag, rank, mode)`` is a fixed, small reference
DataFrame (bounded by the constants, broadcast-safe):

* ``mode='fill'``: the lowest-rank tag with a value wins for each template row
  (ordered fallback coalesce, K1);
* ``mode='add'``: added on top of the filled value, but only for companies
  where the fill tags left some template row empty (K2).

The template is the anchor tag's rows per company, keyed by
(cik, fy, fp, filed, end); values join to it on those keys (J1). All steps are
equi-joins and grouped aggregates -- no per-company loop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

TEMPLATE_KEYS = ["fy", "fp", "filed", "end"]


def concept_table(spark: SparkSession, mapping: dict, additive: dict | None = None) -> DataFrame:
    """{concept: [tag, ...]} (+ {concept: tag} additive) -> (concept, tag, rank, mode)."""
    rows = []
    for concept, tags in mapping.items():
        for i, t in enumerate(tags):
            rows.append((concept, t, i, "fill"))
    for concept, t in (additive or {}).items():
        rows.append((concept, t, len(mapping.get(concept, [])), "add"))
    return spark.createDataFrame(rows, "concept string, tag string, rank int, mode string")


def assert_unique(df: DataFrame, keys) -> DataFrame:
    """J1 cardinality check: rows whose key occurs more than once (empty = valid 1:1)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def resolve_concepts(template: DataFrame, values: DataFrame, concepts: DataFrame,
                     keys=TEMPLATE_KEYS, additive=None) -> DataFrame:
    """K1/K2: one value per (cik, concept, template row).

    template: cik + keys; values: cik, tag + keys, val. Returns cik, concept,
    keys..., val, src_rank (rank of the winning fill tag), _by_add (value
    supplied by the additive tag only).

    Plan: matched values -> ONE grouped aggregate per (cik, concept, row)
    carrying both the lowest-rank fill value and the additive sum; the additive
    rule holds for companies that report a fill tag as well. Only the
    additive concepts (a fixed, tiny list) need the full template grid, built
    by tagging template rows with those concept names (no join), and a window
    per (cik, concept) -- bounded by the company's fiscal years -- decides
    whether the fill tags left a row empty.
    """
    keys = list(keys)
    if additive is None:
        additive = [r["concept"] for r in concepts.filter(F.col("mode") == "add").select("concept")
                    .distinct().collect()]
    v = values.filter(F.col("val").isNotNull()).join(F.broadcast(concepts), "tag")
    m = v.join(template.select("cik", *keys), ["cik", *keys])
    is_fill = F.col("mode") == "fill"
    agg = m.groupBy("cik", "concept", *keys).agg(
        F.min_by(F.struct("val", "rank"), F.when(is_fill, F.col("rank"))).alias("w"),
        F.sum(F.when(~is_fill, F.col("val"))).alias("add_val"))
    agg = agg.select("cik", "concept", *keys, F.col("w.val").alias("fill_val"), F.col("w.rank").alias("src_rank"),
                     "add_val")
    plain = agg.filter(~F.col("concept").isin(*additive) if additive else F.lit(True)) \
        .filter(F.col("fill_val").isNotNull()) \
        .select("cik", "concept", *keys, F.col("fill_val").alias("val"), "src_rank", F.lit(False).alias("_by_add"))
    if not additive:
        return plain
    grid = template.select("cik", *keys, F.explode(F.array(*[F.lit(c) for c in additive])).alias("concept"))
    g = grid.join(agg.filter(F.col("concept").isin(*additive)), ["cik", "concept", *keys], "left")
    # which kinds of tag the company reports at all, on a template row or not
    kinds = v.filter(F.col("concept").isin(*additive)).groupBy("cik", "concept").agg(
        F.max(is_fill).alias("_fill"), F.max(~is_fill).alias("_add"))
    w = Window.partitionBy("cik", "concept")
    g = g.withColumn("_empty", F.max(F.col("fill_val").isNull().cast("int")).over(w)).join(kinds, ["cik", "concept"])
    reached = (F.col("_empty") == 1) & F.col("_add") & F.col("_fill")
    # the only tag of a company is taken as it is: years without it stay missing
    val = F.when(reached, F.coalesce("fill_val", F.lit(0.0)) + F.coalesce("add_val", F.lit(0.0))) \
        .when(F.col("_add") & ~F.col("_fill"), F.col("add_val")).otherwise(F.col("fill_val"))
    added = g.select("cik", "concept", *keys, val.alias("val"), "src_rank",
                     (F.col("_add") & F.col("fill_val").isNull()).alias("_by_add")).filter(F.col("val").isNotNull())
    return plain.unionByName(added)


def provenance(values: DataFrame, resolved: DataFrame, concepts: DataFrame, keys=TEMPLATE_KEYS,
               available: DataFrame | None = None) -> DataFrame:
    """K3: per (cik, concept) text of the available tags in rank order, each
    prefixed with the fiscal-year range it filled ('[2019-2021] Tag'); a single
    available tag is named bare; no tag -> 'none'."""
    avail = available if available is not None else (
        values.filter(F.col("val").isNotNull()).join(F.broadcast(concepts), "tag")
        .select("cik", "concept", "tag", "rank").distinct())
    # one aggregate: a row's contributing rank is the winning fill tag, or the
    # additive tag's rank when the additive tag alone supplied it
    add_rank = {r["concept"]: r["rank"] for r in
                concepts.filter(F.col("mode") == "add").select("concept", "rank").collect()}
    arank = None
    for c_, r_ in add_rank.items():
        arank = (F.when(F.col("concept") == c_, F.lit(r_)) if arank is None
                 else arank.when(F.col("concept") == c_, F.lit(r_)))
    eff = F.col("src_rank") if arank is None else F.when(
        F.coalesce(F.col("_by_add"), F.lit(False)), arank).otherwise(F.col("src_rank"))
    yrs = (resolved.withColumn("rank", eff).filter(F.col("rank").isNotNull())
           .groupBy("cik", "concept", "rank").agg(F.min("fy").alias("y0"), F.max("fy").alias("y1")))
    a = avail.join(yrs, ["cik", "concept", "rank"], "left")
    rng = F.when(F.col("y0").isNull(), F.lit(None)).when(
        F.col("y0") == F.col("y1"), F.format_string("[%d]", F.col("y0"))).otherwise(
        F.format_string("[%d-%d]", F.col("y0"), F.col("y1")))
    a = a.withColumn("txt", F.concat_ws(" ", rng, F.col("tag")))
    g = a.groupBy("cik", "concept").agg(
        F.count(F.lit(1)).alias("n_tags"),
        F.array_sort(F.collect_list(F.struct("rank", "txt", "tag"))).alias("items"))
    text = F.when(F.col("n_tags") == 1, F.col("items")[0]["tag"]).otherwise(
        F.array_join(F.transform("items", lambda x: x["txt"]), " + "))
    return g.select("cik", "concept", text.alias("used_tag"))


def tag_inventory(facts: DataFrame, ns_choice: DataFrame | None = None) -> DataFrame:
    """Sorted distinct tags per company (within its chosen namespace)."""
    f = facts if ns_choice is None else facts.join(ns_choice, ["cik", "ns"])
    return f.groupBy("cik").agg(F.array_sort(F.collect_set("tag")).alias("tags"))


def split_words(tag_col):
    """CamelCase words of a tag name (runs of one capital + lower-case letters)."""
    return F.regexp_extract_all(tag_col, F.lit(r"([A-Z][a-z]*)"), 1)


def tag_suggestions(missing: DataFrame, inventory: DataFrame, ignore_words) -> DataFrame:
    """For each (cik, missing_tag), the company's tags containing any
    non-ignored CamelCase word of the missing tag.

    One row per company on each side (cik equi-join); the match runs inside
    higher-order functions over the company's tag array, so no word x tag pairs
    are materialised.
    """
    ign = F.array(*[F.lit(w) for w in ignore_words])
    words = F.filter(split_words(F.col("missing_tag")), lambda w: ~F.array_contains(ign, w))
    m = missing.select("cik", "missing_tag", words.alias("words"))
    j = m.join(inventory.select("cik", "tags"), "cik", "left")
    sug = F.filter(F.coalesce(F.col("tags"), F.array().cast("array<string>")),
                   lambda t: F.exists(F.col("words"), lambda w: F.instr(t, w) > 0))
    return j.select("cik", "missing_tag", F.array_sort(sug).alias("suggestions"))


def missing_required(available: DataFrame, companies: DataFrame, required: dict) -> DataFrame:
    """(cik, concept, missing_tag) for required concepts without any available tag.

    ``available`` is (cik, concept) pairs; ``required`` maps concept -> the
    primary tag named in the error. The fixed concept list is tested inside
    higher-order functions per company row (no company x concept join).
    """
    have = available.groupBy("cik").agg(F.collect_set("concept").alias("have"))
    req = F.array(*[F.struct(F.lit(c).alias("concept"), F.lit(t).alias("missing_tag"))
                    for c, t in required.items()])
    c = companies.select("cik").join(have, "cik", "left").withColumn(
        "have", F.coalesce(F.col("have"), F.array().cast("array<string>")))
    miss = F.filter(req, lambda r: ~F.array_contains(F.col("have"), r["concept"]))
    return c.select("cik", F.explode(miss).alias("m")).select("cik", "m.concept", "m.missing_tag")
