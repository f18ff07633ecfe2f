"""Operator 6: packing examples into sequences by vector bin packing.

An example takes tokens, one segment and loss-bearing tokens of a sequence, all
three limited at once. The open sequence takes, again and again, the example that
fits and has the largest dot product of its demand and the sequence's remaining
capacity, both relative to the limits and weighted by how scarce each capacity is
overall (dot-product heuristic of vector bin packing); if none fits, the next
sequence is opened.

Documents are cut into pieces of a full sequence each and one remainder; the
remainders are packed in groups of bounded size dealt by hash, so no task gets more
than about ``group`` of them however many there are.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import numbered, text_batches
from .tokens import ByteIds


def dot_product_pack(demand: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """The sequence (0, 1, ...) of each example; ``demand`` has a row per example and a
    column per limit. Equal rows are interchangeable; ties go to the larger example."""
    kinds, kind_of = np.unique(demand, axis=0, return_inverse=True)
    kinds, kind_of = kinds[::-1], len(kinds) - 1 - kind_of.ravel()
    left = np.bincount(kind_of, minlength=len(kinds))
    if (kinds > limits).any():
        raise ValueError("an example exceeds the limits of a sequence")
    relative = kinds / limits
    scarce = (relative * left[:, None]).sum(axis=0)
    weighted = relative * (scarce / max(scarce.sum(), 1e-12))
    order = np.argsort(kind_of, kind="stable")
    next_of = np.concatenate(([0], np.cumsum(left)[:-1]))
    out, bin_, room = np.empty(len(demand), np.int64), 0, limits.astype(float).copy()
    alive = np.arange(len(kinds))
    while len(alive):
        fits = alive[(kinds[alive] <= room).all(axis=1)]
        if not len(fits):
            bin_, room = bin_ + 1, limits.astype(float).copy()
            continue
        k = fits[np.argmax(weighted[fits] @ (room / limits))]
        out[order[next_of[k]]] = bin_
        next_of[k] += 1
        left[k] -= 1
        room -= kinds[k]
        if not left[k]:
            alive = alive[alive != k]
    return out


def pack(items: DataFrame, row_col: str, max_tokens: int, max_segments: int, max_loss: int, group: int = 20_000) -> DataFrame:
    """Adds sequence_id and offset to ``items``, which has a unique long ``row_col`` and
    the columns ``length`` (1 to max_tokens) and ``loss`` (0 to max_loss).

    Within a sequence offsets run from 0 without gaps. Examples are dealt by a hash of
    the row to ceil(n / group) groups. An empty table gives an empty result."""
    n = max(1, -(-items.count() // group))
    dealt = items.withColumn("bunch", F.pmod(F.xxhash64(row_col), F.lit(n)))
    schema = items.withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")}).schema
    limits = np.array([max_tokens, max_segments, max_loss], np.int64)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", row_col], ascending=[False, True])
        demand = np.stack([pdf["length"], np.ones(len(pdf), np.int64), pdf["loss"]], axis=1)
        pdf["sequence_id"] = dot_product_pack(demand, limits)
        pdf["offset"] = pdf.groupby("sequence_id")["length"].cumsum() - pdf["length"]
        pdf["sequence_id"] += pdf["bunch"] * (1 << 32)
        return pdf[schema.names]

    return dealt.groupBy("bunch").applyInPandas(run, schema)


PIECE = "doc_id long, nil boolean, start long, length long, ids_crc32 long, doc_tokens long"


def pieces(docs: DataFrame, id_col: str, text_col: str, tokenizer: str, max_tokens: int, end_id: int = 0) -> DataFrame:
    """One row per piece: the document's ids (its tokens, then ``end_id``) cut after
    every ``max_tokens``. A null text has only the end id. Null ids keep rows."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        ids_of = ByteIds.of(tokenizer)
        for b in batches:
            rows = []
            for doc, nil, ids in zip(b["doc_id"], b["nil"], ids_of.many(b["text"].tolist())):
                ids += end
                n = len(ids) // 4
                rows += [(doc, nil, a, min(max_tokens, n - a), zlib.crc32(ids[4 * a:4 * (a + max_tokens)]), n)
                         for a in range(0, n, max_tokens)]
            yield pd.DataFrame(rows, columns=["doc_id", "nil", "start", "length", "ids_crc32", "doc_tokens"])

    src = text_batches(docs).select(F.coalesce(F.col(id_col), F.lit(0)).cast("long").alias("doc_id"), F.col(id_col).isNull().alias("nil"),
                      F.col(text_col).alias("text"))
    return src.mapInPandas(run, PIECE)


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = "byte_bpe_50k.json",
                   max_tokens: int = 1024, max_segments: int = 256, group: int = 20_000) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every id of every document lies in exactly one piece, and every piece in one
    sequence of at most ``max_tokens`` ids and ``max_segments`` pieces; all ids of a
    document bear loss. Null and empty texts are a single end id. Repeated rows are
    packed once each; null ids stay null; an empty table gives an empty result;
    other columns are ignored."""
    rows = numbered(pieces(docs, id_col, text_col, tokenizer, max_tokens), "row")
    whole = rows.filter(F.col("length") == max_tokens) \
        .withColumns({"sequence_id": F.col("row") * 2, "offset": F.lit(0).cast("long")})
    rest = pack(rows.filter(F.col("length") < max_tokens).withColumn("loss", F.col("length")), "row",
                max_tokens, max_segments, max_tokens, group).drop("loss").withColumn("sequence_id", F.col("sequence_id") * 2 + 1)
    return whole.unionByName(rest).select(F.when(~F.col("nil"), F.col("doc_id")).alias(id_col), "start", "length", "ids_crc32",
                                          "doc_tokens", "sequence_id", "offset")
