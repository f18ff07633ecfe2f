"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import cut

#: A word: a run of anything but space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"


#: Rows of an Arrow batch where the session has Spark's default: whole texts are long,
#: and a batch exists several times over in a task (JVM buffers, Python objects).
TEXT_BATCH = 1000


def text_batches(df: DataFrame) -> DataFrame:
    """``df`` as it is; its session hands Python workers smaller Arrow batches, unless it
    was given a size of its own."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    conf = df.sparkSession.conf
    if conf.get(key, "10000") == "10000":
        conf.set(key, str(TEXT_BATCH))
    return df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words of a text (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ascii_lower(s: Column) -> Column:
    return F.translate(s, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def numbered(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared checkpoint folder, with a long row number that
    stays the same when a task is run again (the rows are read from files)."""
    return cut(df).withColumn(name, F.monotonically_increasing_id())


def best_per_key(df: DataFrame, keys: list[str], order: list[Column], k: int, parts: int = 64) -> DataFrame:
    """The first ``k`` rows of each key by ``order``, with their ``rank`` (from 1). A key's
    rows are cut to ``k`` in ``parts`` parts before they meet, so no task sorts them all."""
    salted = df.withColumn("salt", F.pmod(F.xxhash64(*df.columns), F.lit(parts)))
    first = salted.withColumn("rank", F.row_number().over(Window.partitionBy(*keys, "salt").orderBy(*order))).filter(F.col("rank") <= k)
    return first.drop("salt", "rank").withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("rank") <= k)


__all__ = ["WORD", "table", "text_batches", "word_count", "ascii_lower", "numbered", "best_per_key", "cut"]
