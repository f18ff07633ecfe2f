"""Structured Streaming ingest of landed filings (micro-batches -> panel + log)."""

from pyspark.sql import functions as F

from tests.filings_fixture import write_fixture


def test_stream_ingest_matches_batch(spark, scratch):
    from ledgerlens.sources import filings
    from ledgerlens.streaming.ingest import start_ingest
    root = write_fixture(f"{scratch}/stream")
    dirx = filings.read_directory(spark, f"{root}/directory.json")
    meta = filings.read_metadata(spark, f"{root}/meta/*.json")
    companies = dirx.join(meta, "cik").select("cik", "ticker", F.col("title").alias("name"), "industry")
    q = start_ingest(spark, f"{root}/facts", companies, None, f"{scratch}/stream_out",
                     f"{scratch}/stream_ckpt", run_ts="2026-01-01 00:00:00")
    q.awaitTermination(600)
    panel = spark.read.parquet(f"{scratch}/stream_out/panel")
    log = {r["ticker"]: r["status"] for r in spark.read.parquet(f"{scratch}/stream_out/log").collect()}
    assert {k: log[k] for k in ("AAA", "BBB", "CCC", "DDD")} == {
        "AAA": "Success", "BBB": "Success", "CCC": "Fail", "DDD": "Fail"}
    assert len(log) == 17
    assert panel.filter(F.col("ticker") == "AAA").count() == 7
