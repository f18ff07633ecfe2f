"""Registered queries of the training-data operators, with production parameters."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import (ann, collocations, embed_dedup, html_main, langid, lexical_search, license_scan, mixing, packing, secret_scan, simhash,
               token_counts, url_filter)
from .common import table


def op1_entropy_mix(spark, sf_dir):
    return mixing.entropy_mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "rate", "copies")


def op2_simhash(spark, sf_dir):
    return simhash.simhash_components(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)


def op3_language_id(spark, sf_dir):
    return langid.identify(table(spark, sf_dir, "documents"))


def op4_secret_scan(spark, sf_dir):
    return secret_scan.digest_columns(secret_scan.secret_spans(table(spark, sf_dir, "documents")))


def op5_main_text(spark, sf_dir):
    return html_main.main_text(table(spark, sf_dir, "pages"))


def op6_packing(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op7_url_filter(spark, sf_dir):
    return url_filter.judge_urls(table(spark, sf_dir, "pages"))


def op8_token_counts(spark, sf_dir):
    """Counted with a cache of its own: every run encodes every distinct text."""
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), token_counts.fresh_cache(spark))


def op9_nearest(spark, sf_dir):
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op10_embedding_dedup(spark, sf_dir):
    return embed_dedup.near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


def op11_license_scan(spark, sf_dir):
    return license_scan.digest_columns(license_scan.license_places(table(spark, sf_dir, "documents")))


def op12_lexical_search(spark, sf_dir):
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_collocations(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_entropy_mix": op1_entropy_mix,
    "op2_simhash": op2_simhash,
    "op3_language_id": op3_language_id,
    "op4_secret_scan": op4_secret_scan,
    "op5_main_text": op5_main_text,
    "op6_packing": op6_packing,
    "op7_url_filter": op7_url_filter,
    "op8_token_counts": op8_token_counts,
    "op9_nearest": op9_nearest,
    "op10_embedding_dedup": op10_embedding_dedup,
    "op11_license_scan": op11_license_scan,
    "op12_lexical_search": op12_lexical_search,
    "op13_collocations": op13_collocations,
}

ORACLE: dict[str, str] = {
    "op7_url_filter": url_filter.oracle_sql(),
    "op11_license_scan": license_scan.oracle_sql(),
    "op12_lexical_search": lexical_search.oracle_sql(),
    "op13_collocations": collocations.oracle_sql(),
}
