"""Operator 12: ranked lexical search by scanning documents, without an index of them.

The distinct terms of the items become an Aho-Corasick automaton whose patterns carry a
guard (a space) on both sides, so that only whole terms match; it is broadcast, and every
document is scanned directly. The first scan counts documents, terms and, per pattern, the
documents that hold it; the second takes each document's term counts from the automaton's
outputs, maps them to the items that hold the term, scores, and keeps each task's best
per item. Only counts and these few candidates are shuffled.

What is broadcast is bounded: items are dealt into blocks of about ``block_terms`` terms
(whole items, as many blocks as it takes), and blocks are searched one after the other.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, best_per_key, cut, numbered, text_batches

#: A term: a run of letters, digits and characters beyond ASCII (A-Z are lower-cased after).
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: By UTF-8 byte: A-Z lower-cased, every other ASCII character but a-z and digits a space.
_GUARDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
DOCS, TERMS = -1, -2        # in the first scan's counts, beside pattern numbers


def guarded(text: str) -> tuple[str, int]:
    """A text with a space for everything between terms and at both ends, and its number
    of terms. Bytes of characters beyond ASCII are never touched."""
    low = text.encode("utf-8", "replace").translate(_GUARDS)
    return f" {low.decode()} ", len(low.split())


_AUTOMATA: dict[str, object] = {}


def automaton(key: str, terms: list[str]):
    """The automaton of a broadcast list of terms; a worker keeps only its latest."""
    if key not in _AUTOMATA:
        import ahocorasick

        made = ahocorasick.Automaton()
        for i, t in enumerate(terms):
            made.add_word(f" {t} ", i)
        made.make_automaton()
        _AUTOMATA.clear()
        _AUTOMATA[key] = made
    return _AUTOMATA[key]


def term_counts(found, text: str) -> dict[int, int]:
    """How often each pattern stands in a guarded text."""
    return Counter(map(itemgetter(1), found.iter(text)))


def _corpus_counts(docs: DataFrame, sent) -> DataFrame:
    """(term, n): documents that hold each pattern; DOCS and TERMS hold the corpus's."""
    def scan(batches):
        found, seen = automaton(*sent.value), Counter()
        for b in batches:
            for text in b.column(0).to_pylist():
                if not text:
                    continue
                low, n = guarded(text)
                if n:
                    seen[DOCS] += 1
                    seen[TERMS] += n
                    seen.update(set(term_counts(found, low)))
        yield pa.RecordBatch.from_pydict({"term": pa.array(list(seen), pa.int64()), "n": pa.array(list(seen.values()), pa.int64())})

    return docs.select("text").mapInArrow(scan, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))


class _Best:
    """The ``k`` best (item, score, id) of each item seen so far, in bounded memory:
    highest score, then smallest id, null last."""

    LEAST = 500_000

    def __init__(self, items: int, k: int):
        self.k, self.floor = k, np.zeros(items, np.int64)       # scores below an item's floor can't be among its best
        self.rows = [np.zeros(0, np.int64)] * 4                 # item, score, id, id is null
        self.more: list[list[np.ndarray]] = []
        self.waiting = 0

    def add(self, scores: np.ndarray, doc: int | None) -> None:
        at = np.flatnonzero((scores > 0) & (scores >= self.floor))
        if len(at):
            same = np.ones(len(at), np.int64)
            self.more.append([at, scores[at], same * (doc or 0), same * (doc is None)])
            self.waiting += len(at)
            if self.waiting > self.LEAST:
                self.keep()

    def keep(self) -> list[np.ndarray]:
        item, score, doc, nil = (np.concatenate([a, *b]) for a, *b in zip(self.rows, *self.more))
        order = np.lexsort((doc, nil, -score, item))
        item, score, doc, nil = item[order], score[order], doc[order], nil[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)      # from 0 inside an item
        held = place < self.k
        self.rows = [x[held] for x in (item, score, doc, nil)]
        full = place == self.k - 1
        self.floor[item[full]] = score[full]
        self.more, self.waiting = [], 0
        return self.rows


def _block(it: DataFrame, block: int, spark):
    """The rows of one block of items as arrays: terms, the items of each term (a slice
    of ``item`` and ``q`` per term) and the items' numbers."""
    rows = it.filter(F.col("block") == block).select("row", "term", "q").collect()
    terms, numbers = sorted({r["term"] for r in rows}), sorted({r["row"] for r in rows})
    at, place = {t: i for i, t in enumerate(terms)}, {x: i for i, x in enumerate(numbers)}
    term = np.array([at[r["term"]] for r in rows], np.int64)
    order = np.argsort(term, kind="stable")
    item = np.array([place[r["row"]] for r in rows], np.int64)[order]
    q = np.array([r["q"] for r in rows], np.int64)[order]
    return terms, numbers, np.searchsorted(term[order], np.arange(len(terms) + 1)), item, q


def _scores(docs: DataFrame, sent, held, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """(row, doc_id, score): each task's best documents of every item of a block."""
    def scan(batches):
        numbers, starts, item, q, w = held.value
        found, best = automaton(*sent.value), _Best(len(numbers), k)
        for b in batches:
            for text, doc in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if not text:
                    continue
                low, n = guarded(text)
                counts = term_counts(found, low)
                if not counts:
                    continue
                m = 100 - 75 + (75 * n * n_docs) // n_terms
                ids, tf = (np.fromiter(x, np.int64, len(counts)) for x in (counts.keys(), counts.values()))
                part = w[ids] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
                many = starts[ids + 1] - starts[ids]
                at = np.repeat(starts[ids] + many - np.cumsum(many), many) + np.arange(many.sum())     # the terms' slices, end to end
                scores = np.zeros(len(numbers), np.int64)
                np.add.at(scores, item[at], np.repeat(part, many) * q[at])
                best.add(scores, doc)
        i, s, d, nil = best.keep()
        if len(i):
            yield pa.RecordBatch.from_pydict({"row": pa.array(np.array(numbers, np.int64)[i]), "doc_id": pa.array(d, mask=nil == 1), "score": pa.array(s)})

    return docs.mapInArrow(scan, "row long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
           item_id_col: str = "item_id", item_text_col: str = "text", block_terms: int = 100_000) -> DataFrame:
    """The ``k`` highest-scoring documents of each row of ``items``: its id, rank (int,
    from 1), doc_id, score.

    A term's weight is floor(1000 ln((2N+2)/(2df+1))); a document's score sums
    weight * (10^9 tf div (1000 tf + 8m)) over the item's terms, repeats included, with
    m = 25 + 75 n N div L. Scores above 0 only; ties go to the smaller doc_id (an integer;
    null last). Whole texts; null and empty texts have no terms: such documents count
    nowhere, such items get no rows. Rows that repeat a doc_id are documents of their own
    and rank one after the other; rows that repeat an item_id are items of their own; an
    empty table on either side gives an empty result; other columns are ignored."""
    spark = docs.sparkSession
    rows = numbered(items.select(F.col(item_id_col).alias("item_id"), F.col(item_text_col).alias("text")), "row")
    terms = cut(rows.select("row", F.explode(F.expr(f"regexp_extract_all(text, r'{TERM}', 0)")).alias("term"))
                .groupBy("row", ascii_lower(F.col("term")).alias("term")).agg(F.count(F.lit(1)).alias("q")))
    corpus = text_batches(docs).select(F.col(text_col).alias("text"), F.col(id_col).cast("long").alias("doc_id"))
    blocks, dealt = max(1, math.ceil(terms.count() / block_terms)), None
    while True:     # more blocks until each keeps the bound or is one item
        dealt = terms.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)))
        most = dealt.groupBy("block").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("row").alias("items"))
        if most.filter((F.col("n") > 2 * block_terms) & (F.col("items") > 1)).isEmpty():
            break
        blocks *= 2
    out = None
    for block in range(blocks):
        names, numbers, starts, item, q = _block(dealt, block, spark)
        if not names:
            continue
        sent = spark.sparkContext.broadcast((uuid.uuid4().hex, names))
        counts = {r["term"]: r["n"] for r in _corpus_counts(corpus, sent).collect()}
        n_docs, n_terms = counts.get(DOCS, 0), counts.get(TERMS, 0)
        if not n_docs:
            break
        w = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * counts.get(i, 0) + 1))) for i in range(len(names))], np.int64)
        held = spark.sparkContext.broadcast((numbers, starts, item, q, w))
        found = cut(best_per_key(_scores(corpus, sent, held, n_docs, n_terms, k), ["row"], [F.desc("score"), F.asc_nulls_last("doc_id")], k))
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = spark.createDataFrame([], "row long, doc_id long, score long, rank int")
    return out.join(rows.select("row", "item_id"), "row").select(F.col("item_id").alias(item_id_col), F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def oracle_sql() -> str:
    """The same in DuckDB SQL, over an index of all terms."""
    low = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, {low}), '{TERM}') AS w FROM documents),
i AS (SELECT row_number() OVER () AS i, item_id, regexp_extract_all(translate(text, {low}), '{TERM}') AS w FROM benchmark),
x AS (SELECT count(*) AS n, sum(len(w))::BIGINT AS l FROM d WHERE len(w) > 0),
p AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM d) GROUP BY r, t),
f AS (SELECT t, floor(1000 * ln((2 * any_value(x.n) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS wt FROM p, x GROUP BY t),
g AS (SELECT i, t, count(*) AS q FROM (SELECT i, unnest(w) AS t FROM i) GROUP BY i, t),
m AS (SELECT r, doc_id, 100 - 75 + (75 * len(w) * x.n) // x.l AS m FROM d, x WHERE len(w) > 0),
s AS (SELECT g.i, m.doc_id, m.r, sum(g.q * f.wt * ((1000000000 * p.tf) // (1000 * p.tf + 8 * m.m)))::BIGINT AS score
      FROM g JOIN p USING (t) JOIN f USING (t) JOIN m USING (r) GROUP BY g.i, m.doc_id, m.r),
o AS (SELECT i, doc_id, score, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0)
SELECT i.item_id, o.rank::INTEGER AS rank, o.doc_id, o.score FROM o JOIN i USING (i) WHERE o.rank <= 10"""
