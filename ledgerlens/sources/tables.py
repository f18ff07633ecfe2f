"""Table sources and sinks.

Tables are Parquet folders (or catalog tables); the studied job used a SQL
database for the same roles.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Full scan (column pruning / predicate pushdown happen per query)."""
    return spark.read.parquet(path)


def append(df: DataFrame, path: str, partition_by=("fy",)) -> None:
    """Append sink, partitioned by fiscal year so later year filters prune files."""
    w = df.write.mode("append")
    cols = [c for c in partition_by if c in df.columns]
    (w.partitionBy(*cols) if cols else w).parquet(path)


def upsert(df: DataFrame, path: str, keys, partition_by=("fy",), buckets: int = 64) -> None:
    """Rows of ``df`` replace the rows of the table that have the same ``keys`` (a
    null key equals a null key); other rows stay. Writing the same rows again, after
    whatever kind of failure, leaves the same table.

    The table is partitioned by ``partition_by`` (columns among the keys, or else ``bucket``,
    a hash of the keys), so a key never moves between partitions: only the partitions that
    ``df`` touches are read, merged into a staged copy in the shared checkpoint folder, and
    then overwritten. Rows of ``df`` that repeat a key are an error of the caller: they
    raise before anything is written."""
    spark, keys = df.sparkSession, list(keys)
    cols = [c for c in partition_by if c in keys]
    new = df if cols else df.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
    cols = cols or ["bucket"]
    new = cut(new)
    twice = new.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").first()
    if twice:
        raise ValueError(f"rows repeat the key {twice.asDict()}")
    try:
        held = spark.read.parquet(path)
    except AnalysisException as e:      # no table yet
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
        held = None
    if held is not None:
        touched, again = new.select(*cols).distinct(), new.select(*keys)
        kept = held.join(touched, _same(held, touched, cols), "left_semi").join(again, _same(held, again, keys), "left_anti")
        new = cut(kept.unionByName(new, allowMissingColumns=True))
    new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*cols).parquet(path)


def _same(left: DataFrame, right: DataFrame, cols):
    return reduce(lambda a, c: a & left[c].eqNullSafe(right[c]), cols, F.lit(True))


def replace_if_any(df: DataFrame, path: str) -> bool:
    """Replace sink that leaves the existing table alone when there is nothing to write."""
    if df.isEmpty():
        return False
    df.write.mode("overwrite").parquet(path)
    return True


def export_csv(df: DataFrame, path: str, order=("ticker", "fy", "fp"), null_text: str = "NULL") -> None:
    """Ordered CSV export with missing values rendered as ``NULL``.

    The global order is a range-partitioned sort (distributed); part files are
    written in order, so concatenating them yields the total order.
    """
    cols = [c for c in order if c in df.columns]
    out = df.orderBy(*cols) if cols else df
    out.write.mode("overwrite").option("header", "true").option("nullValue", null_text) \
        .option("emptyValue", "").csv(path)


def write_summary_csv(summary: DataFrame, path: str) -> None:
    """The per-industry model summary (a handful of rows) as one CSV file."""
    summary.orderBy("Industry").coalesce(1).write.mode("overwrite").option("header", "true").csv(path)
