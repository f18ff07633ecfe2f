"""The pipeline's stages on awkward rows, and the whole of it against its parts."""

from collections import Counter

from llm_data import CLASHING, DOCS, EN, FR, ROWS, clash, docs
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from ledgerlens.llm import langid, mixing, packing, simhash

SF = "/root/testdata/sf0.001"


def test_stages_on_awkward_rows(spark, scratch):
    now = docs(spark)
    for k, (name, stage) in enumerate(pipeline.STAGES):
        at = f"{scratch}/stage-{k}"
        out = stage(spark, now, SF)
        if k < len(pipeline.STAGES) - 1:
            assert out.columns == docs(spark).columns, name
        out.write.parquet(at)
        now = spark.read.parquet(at)
    assert now.count() > 0
    for _, stage in pipeline.STAGES:
        assert stage(spark, spark.createDataFrame([], DOCS), SF).collect() == []


def test_language_and_duplicates_decide(spark):
    kept = pipeline.language(spark, docs(spark), SF)
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(r[0] for r in ROWS if langid.has_letter(r[1]))
    assert all(r["lang"] for r in kept.collect())
    rows = ROWS + [(None, "a text that nothing else in the table is near to", "en", "a", 1)] * 2
    one = pipeline.near_duplicates(spark, docs(spark, rows), SF).collect()
    groups = simhash.simhash_components(docs(spark, rows)).collect()
    want = sorted({r["component_id"] for r in groups if r["component_id"] is not None})
    assert sorted(r["doc_id"] for r in one if r["doc_id"] is not None) == want
    assert [r["text"] for r in one if r["doc_id"] is None] == [rows[-1][1]]      # the other unnamed ones have named copies


def test_no_document_is_lost_by_a_shared_doc_id(spark):
    """Distinct texts under one doc_id are documents of their own; equal rows are one."""
    rows = [(1, EN, "en", "a", 1), (1, FR, "fr", "a", 1), (2, EN.replace("river", "brook"), "en", "b", 1), (1, EN, "en", "a", 1),
            (None, "a text that nothing else in the table is near to", "en", "a", 1), (None, "and another text without an id, far from the rest", "en", "a", 1)]
    kept = pipeline.near_duplicates(spark, docs(spark, rows), SF).collect()
    assert Counter(r["text"] for r in kept) == Counter([EN, FR, rows[4][1], rows[5][1]]) or \
        Counter(r["text"] for r in kept) == Counter([EN, FR, rows[2][1], rows[4][1], rows[5][1]])
    again = pipeline.near_duplicates(spark, docs(spark, rows[::-1]).repartition(3), SF).collect()
    assert sorted(map(str, kept)) == sorted(map(str, again))


def test_columns_of_any_name_come_back_untouched(spark):
    """The caller's columns, whatever they are called, are the caller's."""
    names = [*CLASHING, "__id", "__p", "key", "row", "p", "k", "copies", "h", "n", "all", "copy", "text2"]
    wide = clash(docs(spark)).withColumns({c: F.lit("x") for c in names})
    for name, stage in pipeline.STAGES[:4]:
        out = stage(spark, wide, SF)
        assert out.columns == wide.columns, name
        got = out.collect()
        assert got and all(r[c] == "x" for r in got for c in names), name


def test_run_is_its_stages(spark):
    got = pipeline.run(spark, SF)
    d = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in pipeline.STAGES[:3]:
        d = stage(spark, d, SF)
    want = Counter()
    for r in mixing.entropy_mix(d).collect():
        want[r["doc_id"]] += r["copies"]
    assert Counter(r["doc_id"] for r in got.collect() if r["start"] == 0) == +want
    whole = packing.pack_documents(mixing.mixed_documents(d)).select("doc_id", "start", "length", "ids_crc32")
    assert Counter(map(tuple, got.select("doc_id", "start", "length", "ids_crc32").collect())) == Counter(map(tuple, whole.collect()))
