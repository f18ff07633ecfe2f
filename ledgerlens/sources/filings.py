"""Readers for landed regulatory filings.

* company directory: one JSON object ``{"0": {"cik_str", "ticker", "title"}, ...}``
* filer metadata: one JSON file per company (``CIK##########.json``) with
  ``sic`` and ``sicDescription``
* company facts: one JSON file per company with nested
  ``facts -> namespace -> tag -> units -> unit -> [records]``
* prices: Parquet/CSV rows (ticker, date, close_adj, close_unadj)

All schemas are fixed (no inference). Per-company files are parsed one file
per task; everything after the explode is ordinary columnar data.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, DoubleType, IntegerType, LongType, MapType, StringType,
                               StructField, StructType)

from ..session import cut

RECORD = StructType([
    StructField("start", StringType()), StructField("end", StringType()),
    StructField("val", DoubleType()), StructField("fy", IntegerType()),
    StructField("fp", StringType()), StructField("form", StringType()),
    StructField("filed", StringType()),
])
TAG = StructType([StructField("units", MapType(StringType(), ArrayType(RECORD)))])
COMPANY_FACTS = StructType([
    StructField("cik", LongType()), StructField("entityName", StringType()),
    StructField("facts", MapType(StringType(), MapType(StringType(), TAG))),
])
DIRECTORY_ENTRY = StructType([
    StructField("cik_str", LongType()), StructField("ticker", StringType()), StructField("title", StringType()),
])
METADATA = StructType([
    StructField("cik", StringType()), StructField("sic", StringType()), StructField("sicDescription", StringType()),
])

FACT_COLUMNS = ["cik", "ns", "tag", "unit", "start", "end", "val", "fy", "fp", "form", "filed"]


def pad_cik(c) -> "F.Column":
    """10-digit zero-padded company id."""
    return F.lpad(c.cast("string"), 10, "0")


def read_directory(spark: SparkSession, path: str) -> DataFrame:
    """Directory JSON (one object) -> (cik, ticker, title)."""
    return flatten_directory(spark.read.text(path, wholetext=True), "value")


def flatten_directory(raw: DataFrame, json_col: str) -> DataFrame:
    """Directory JSON texts -> one row per entry."""
    m = F.from_json(F.col(json_col), MapType(StringType(), DIRECTORY_ENTRY))
    e = raw.select(F.explode(m).alias("idx", "e"))
    return e.select(pad_cik(F.col("e.cik_str")).alias("cik"), F.col("e.ticker").alias("ticker"),
                    F.col("e.title").alias("title"), F.col("idx").cast("long").alias("source_index"))


def cik_from_path(path_col) -> "F.Column":
    return F.regexp_extract(path_col, r"CIK(\d{10})", 1)


def parse_files(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """JSON files as they landed, one row per file: cik (from the file name), path, doc (the
    parsed payload), bad (not an object of this shape, or cut off), not_json (empty, or
    another kind of document, such as an error page) and n_bytes. The whole text is parsed
    once; the corrupt field keeps an unreadable payload a row."""
    read = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("path"))
    flagged = StructType([*schema.fields, StructField("_corrupt", StringType())])
    doc = F.from_json("value", flagged, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    not_json = ~F.coalesce(F.col("value").rlike(r"^\s*\{"), F.lit(False))
    return read.withColumn("doc", doc).select(
        cik_from_path(F.col("path")).alias("cik"), "path", "doc",
        (F.col("doc").isNull() | F.col("doc._corrupt").isNotNull() | not_json).alias("bad"), not_json.alias("not_json"),
        F.octet_length("value").cast("long").alias("n_bytes"))


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Filer metadata -> (cik, sic, sicDescription, industry = 'sic description').

    Unreadable payloads (F8) keep the row with NULL fields and flags."""
    df = parse_files(spark, path, METADATA)

    def known(name):
        return F.when(~F.col("bad"), F.col(f"doc.{name}")).alias(name)

    return df.select("cik", known("sic"), known("sicDescription"), F.col("bad").alias("bad_payload"),
                     F.col("not_json").alias("payload_not_json")) \
        .select("cik", "sic", "sicDescription", F.concat_ws(" ", "sic", "sicDescription").alias("industry"), "bad_payload", "payload_not_json")


def flatten_facts(parsed: DataFrame, cik_col: str = "cik") -> DataFrame:
    """S3: nested facts -> long records, keeping the *first* unit of each tag
    (document order of the JSON map)."""
    ns = parsed.select(F.col(cik_col).alias("cik"), F.explode("facts").alias("ns", "tags"))
    tg = ns.select("cik", "ns", F.explode("tags").alias("tag", "t"))
    first_unit = F.element_at(F.map_entries(F.col("t.units")), 1)
    un = tg.select("cik", "ns", "tag", first_unit.alias("u")).filter(F.col("u").isNotNull())
    rec = un.select("cik", "ns", "tag", F.col("u.key").alias("unit"),
                    F.exists("u.value", lambda x: x["start"].isNotNull()).alias("has_start"), F.explode("u.value").alias("r"))
    return rec.select(
        "cik", "ns", "tag", "unit",
        F.to_date("r.start").alias("start"), F.to_date("r.end").alias("end"),
        F.nanvl(F.col("r.val"), F.lit(None).cast("double")).alias("val"),
        F.col("r.fy").alias("fy"), F.col("r.fp").alias("fp"), F.col("r.form").alias("form"),
        F.to_date("r.filed").alias("filed"), "has_start")


@dataclass
class Filings:
    facts: DataFrame        # long facts of the readable files
    status: DataFrame       # (cik, bad_facts, facts_not_json) of every file
    quarantine: DataFrame   # (cik, path, n_bytes) of unreadable files


def read_filings(spark: SparkSession, path: str) -> Filings:
    """S3/F8: company-facts files, each read and parsed once (the parsed rows are cut) and
    split into long facts, a status per file and the files that are not readable."""
    parsed = cut(parse_files(spark, path, COMPANY_FACTS))
    return Filings(flatten_facts(parsed.filter(~F.col("bad")).select("cik", "doc.facts")),
                   parsed.select("cik", F.col("bad").alias("bad_facts"), F.col("not_json").alias("facts_not_json")),
                   parsed.filter("bad").select("cik", "path", "n_bytes"))


def read_company_facts(spark: SparkSession, path: str) -> DataFrame:
    """S3: company-facts files -> long facts (cik from the file name), where the status of
    the files isn't needed."""
    return flatten_facts(parse_files(spark, path, COMPANY_FACTS).filter(~F.col("bad")).select("cik", "doc.facts"))


def read_prices(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Daily closes -> (ticker, d date, close_adj, close_unadj); time zone dropped."""
    df = spark.read.format(fmt).option("header", "true").load(path) if fmt == "csv" \
        else spark.read.format(fmt).load(path)
    dcol = "d" if "d" in df.columns else "date"
    return df.select("ticker", F.to_date(F.col(dcol)).alias("d"),
                     F.col("close_adj").cast("double"), F.col("close_unadj").cast("double"))
