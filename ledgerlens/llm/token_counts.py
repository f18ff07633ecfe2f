"""Operator 8: token counts through a digest cache.

A cache is a Parquet table (content_digest, n_tokens) partitioned by
tokenizer_digest. Every text is reduced to the SHA-256 of its normalised content;
digests, without their texts, join the stored counts of the tokenizer's version first.
Only the texts of misses are then brought together, equal ones merged before the
shuffle, encoded once each, and their counts appended: with a warm cache hardly a text
moves. Misses are looked up by broadcasting their digests if these are few (counted),
else by a join after equal texts are merged.
"""

from __future__ import annotations

import hashlib
import uuid
from importlib.metadata import version

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from .common import cut, text_batches
from .tokens import Counts

CACHE = "content_digest string, n_tokens long, tokenizer_digest string"


def tokenizer_digest(name: str) -> str:
    """SHA-256 over the tokenizer file and the library that reads it, with its version."""
    import public_tokenizers

    library = "tokenizers" if name.endswith(".json") else "sentencepiece"
    h = hashlib.sha256(f"{library} {version(library)}\n".encode())
    with open(public_tokenizers.path(name), "rb") as f:
        h.update(f.read())
    return h.hexdigest()


def content(text: Column) -> Column:
    """Normalised content: null is the empty text. Nothing else may change, or the
    count of another text would be returned."""
    return F.coalesce(text, F.lit(""))


def stored_counts(spark, cache_dir: str, tokenizer: str) -> DataFrame:
    """(content_digest, n_tokens) stored for a tokenizer digest, each digest once."""
    try:
        held = spark.read.schema(CACHE).parquet(cache_dir)
    except AnalysisException as e:      # no cache yet
        if "PATH_NOT_FOUND" not in str(e):
            raise
        held = spark.createDataFrame([], CACHE)
    return held.filter(F.col("tokenizer_digest") == tokenizer).groupBy("content_digest").agg(F.max("n_tokens").alias("n_tokens"))


def count_tokens(docs: DataFrame, cache_dir: str, id_col: str = "doc_id", text_col: str = "text",
                 tokenizer: str = "piece_bpe_32k.model", limit: int = 4096, few: int = 50_000) -> DataFrame:
    """One row per row of ``docs``: id, n_bytes (UTF-8), n_tokens (whole text, no added
    tokens), over_limit (n_tokens > ``limit``). The cache at ``cache_dir`` (a shared
    folder) is read and extended. ``few`` bounds the digests that are broadcast.

    Null and empty texts have 0 bytes and 0 tokens. Repeated rows and null ids keep a
    row each; an empty table gives an empty result; other columns are ignored. An
    append that is run twice leaves equal rows, which reading merges."""
    spark, which = docs.sparkSession, tokenizer_digest(tokenizer)
    whole = content(F.col(text_col))
    keyed = text_batches(docs).select(F.col(id_col), whole.alias("content"), F.sha2(whole.cast("binary"), 256).alias("content_digest"))
    rows = cut(keyed.select(F.col(id_col).alias("id"), F.octet_length("content").cast("long").alias("n_bytes"), "content_digest"))

    def encode(batches):
        counts = Counts.of(tokenizer)
        for b in batches:
            yield pd.DataFrame({"content_digest": b["content_digest"], "n_tokens": counts.many(b["content"].tolist())})

    missing = cut(rows.select("content_digest").distinct().join(stored_counts(spark, cache_dir, which), "content_digest", "left_anti"))
    merged = F.first("content").alias("content")
    if missing.count() <= few:
        texts = keyed.join(F.broadcast(missing), "content_digest", "left_semi").groupBy("content_digest").agg(merged)
    else:
        texts = keyed.groupBy("content_digest").agg(merged).join(missing, "content_digest", "left_semi")
    misses = texts.select("content_digest", "content").mapInPandas(encode, "content_digest string, n_tokens long")
    misses.withColumn("tokenizer_digest", F.lit(which)).write.mode("append").partitionBy("tokenizer_digest").parquet(cache_dir)
    # a table of its own, so that the join's sides are plain shuffles and a hot digest is split
    counted = rows.join(cut(stored_counts(spark, cache_dir, which)), "content_digest", "left")
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def fresh_cache(spark) -> str:
    """A cache folder of its own in the shared folder, so that a call counts everything."""
    return f"{checkpoint_dir(spark).rstrip('/')}/token-cache-{uuid.uuid4().hex}"
