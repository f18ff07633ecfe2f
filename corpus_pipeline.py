"""The corpus pipeline: ``documents`` through training-data operators, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written
as Parquet in the shared folder and read again as the next stage's ``docs``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ledgerlens.llm import langid, mixing, packing, secret_scan, simhash
from ledgerlens.session import checkpoint_dir


def language(spark, docs, sf_dir):
    """Operator 3: documents without a language (``und``: null text, no letter) go; the
    others stay, and one without a lang gets the predicted one."""
    model = langid.fit(docs.filter(~langid.held_out(F.col("doc_id"))), "text", "lang")
    predict = langid.predictor(spark, model).asNondeterministic()   # else once for the filter and once for the column
    rows = docs.select(F.struct(*docs.columns).alias("row"), predict("text").alias("p")).filter("p.lang_pred <> 'und'")
    return rows.select(F.col("row").withField("lang", F.coalesce("row.lang", "p.lang_pred")).alias("row")).select("row.*")


def near_duplicates(spark, docs, sf_dir):
    """Operator 2: of each group of SimHash near-duplicates one document stays, once: the
    one with the smallest doc_id (documents without an id come last, those that share one
    in the order of a hash of their text). Rows with equal doc_id and text are one
    document; distinct texts under one doc_id are documents of their own."""
    key = F.struct(F.col("doc_id").isNull().alias("unnamed"), F.coalesce("doc_id", F.lit(0)).alias("doc_id"), F.xxhash64("text").alias("h"))
    named = docs.select(F.struct(*docs.columns).alias("row"), key.alias("key"), "text")
    groups = simhash.simhash_components(named, "key", "text", shingle=4, max_bits=4)
    keep = groups.filter(F.col("key") == F.col("component_id")).select("key").distinct()
    kept = named.select("row", "key").join(keep, "key", "left_semi")
    return kept.groupBy("key").agg(F.min_by("row", F.xxhash64("row")).alias("row")).select("row.*")


def secrets(spark, docs, sf_dir):
    """Operator 4: every secret in a text becomes [SECRET]; n_chars follows."""
    return secret_scan.redact(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mix(spark, docs, sf_dir):
    """Operator 1: every document as often as the entropy-balanced mix takes it."""
    return mixing.mixed_documents(docs)


def sequences(spark, docs, sf_dir):
    """Operator 6: the mix's documents packed into sequences, a row per piece."""
    return packing.pack_documents(docs)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("secrets", secrets),
    ("mix", mix),
    ("sequences", sequences),
]

#: Language models, near-duplicate groups and rounded Newton solutions have no SQL;
#: the stages are tested against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """Applies STAGES to ``documents`` and returns the last stage's rows."""
    at = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{at}/{name}")
        docs = spark.read.parquet(f"{at}/{name}")
    return docs
