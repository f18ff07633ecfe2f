"""Operator 13: collocations by prefix-free parsing.

A document is the sequence of its words, with a separator between pieces. Windows of
``max_words - 1`` tokens whose content hash is 0 modulo ``spread`` are triggers; a chunk
reaches from one trigger to the end of the next, so neighbours overlap by exactly a
window. Equal passages are cut alike wherever they stand, so the distinct chunks with
their frequencies (the dictionary and the parse) are far fewer than the passages. N-grams
are counted inside distinct chunks, weighted by frequency; one that starts in a chunk's
closing window belongs to the next chunk, so that each is counted once.

Most words and most pairs of words are rare. A first pass counts both by a 64-bit hash
and keeps the hashes that reach ``least`` in a Bloom filter of fixed size: what shares a
hash or a bit may pass for no reason, nothing is missed. The second pass counts exactly,
as text, the words that pass and the phrases all of whose pairs pass.
"""

from __future__ import annotations

import hashlib
import uuid
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from .common import best_per_key, text_batches

BREAK, END = 0x0A, 0x0B                 # one-byte tokens between pieces and after chunks; never inside a word
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz \n\n\n\n\n\n\n\n\n")
SPREAD = 32                             # mean number of tokens between triggers
HELD = 600_000                          # distinct entries that a task counts before it hands them on
HASHES = 2_000_000                      # hashes that a task holds before it adds them up
SPAN = 1 << 21                          # bytes of text that are worked on at a time
K1, K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * K2
    return x ^ (x >> np.uint64(29))


def normalised(text: str) -> bytes:
    """Words and breaks, lower-cased, with one or more spaces between them."""
    return text.encode("utf-8", "replace").translate(_LOWER).replace(b"\n", b" \n ")


class Tokens:
    """The tokens of a byte string, found and hashed with NumPy: ``data`` (one space between
    tokens), where each starts and ends, its hash, and which are words."""

    def __init__(self, raw: bytes):
        x = np.frombuffer(raw, np.uint8)
        space = x == 32
        x = x[~(space & np.r_[True, space[:-1]])] if len(x) else x     # no space at the start or after a space
        x = x[:-1] if len(x) and x[-1] == 32 else x
        at = np.flatnonzero(x == 32)
        self.data = x.tobytes()
        self.starts = np.r_[0, at + 1] if len(x) else np.zeros(0, np.int64)
        self.ends = np.r_[at, len(x)] if len(x) else np.zeros(0, np.int64)
        self.h = self._hashes(x)
        single = (self.ends - self.starts) == 1
        first = x[self.starts]
        self.end = single & (first == END)
        self.word = ~(self.end | (single & (first == BREAK)))

    def _hashes(self, x: np.ndarray) -> np.ndarray:
        """A polynomial hash of each token's bytes, SPAN bytes (or one token) at a time."""
        out, a, n = np.empty(len(self.starts), np.uint64), 0, len(self.starts)
        while a < n:
            b = max(a + 1, int(np.searchsorted(self.starts, self.starts[a] + SPAN)))
            low, high = self.starts[a], self.ends[b - 1]
            part = x[low:high].astype(np.uint64) + np.uint64(1)
            part[x[low:high] == 32] = 0
            at = self.starts[a:b] - low
            place = np.arange(high - low) - np.repeat(at, np.diff(np.r_[at, high - low]))
            power = np.cumprod(np.r_[np.uint64(1), np.full(int(place.max()), K1, np.uint64)])
            out[a:b] = _mixed(np.add.reduceat(part * power[place], at))
            a = b
        return out


def chunks_of(t: Tokens, window: int, spread: int = SPREAD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first token, token after the last, whether the last of its text) of every chunk of
    texts that an END token closes each; neighbours share ``window`` tokens."""
    n = len(t.h)
    close = np.flatnonzero(t.end)
    opens = np.r_[0, close[:-1] + 1] if len(close) else close
    opens, close = opens[opens < close], close[opens < close]       # texts with a token at all
    cut = np.zeros(n, bool)
    if n > window:
        mixed = t.h[:n - window + 1]
        for j in range(1, window):
            mixed = mixed * K1 + t.h[j:n - window + 1 + j]
        cut[:n - window + 1] = _mixed(mixed) % np.uint64(spread) == 0
        for j in range(window):         # windows inside one text only
            cut[np.maximum(np.flatnonzero(t.end) - j, 0)] = False
    cut[opens] = True
    first = np.flatnonzero(cut & ~t.end)
    text = np.searchsorted(close, first, side="left")
    last = np.r_[text[1:] != text[:-1], True] if len(first) else np.zeros(0, bool)
    after = np.where(last, close[text], np.r_[first[1:], 0] + window) if len(first) else first
    return first, after, last


class _Counts:
    """Weighted counts per key, handed on as Arrow batches when they grow."""

    def __init__(self, field: str):
        self.field, self.by = field, defaultdict(Counter)

    def full(self, most: int = HELD) -> bool:
        return sum(map(len, self.by.values())) >= most

    def batch(self) -> pa.RecordBatch:
        parts = [(*key, c) for key, c in self.by.items() if c]
        self.by.clear()

        def column(arrays, kind):
            return pa.concat_arrays([pa.array([], kind), *arrays])

        return pa.RecordBatch.from_pydict({
            "lang": column([pa.repeat(pa.scalar(lang, pa.string()), len(c)) for lang, _, c in parts], pa.string()),
            "kind": column([pa.array(np.full(len(c), kind, np.int32)) for _, kind, c in parts], pa.int32()),
            self.field: column([pa.array(list(c), pa.binary()).cast(pa.string()) for _, _, c in parts], pa.string()),
            "n": column([pa.array(np.fromiter(c.values(), np.int64, len(c))) for _, _, c in parts], pa.int64())})


def parse(docs: DataFrame, text_col: str, lang_col: str, window: int, spread: int) -> DataFrame:
    """The dictionary of all texts: (lang, kind, chunk, n); kind is 1 for the last chunk
    of a text, else 0; a chunk's text ends with an END token and a space."""
    close = bytes((32, END, 32))

    def cut_up(texts: list[bytes], langs: list[str], held: _Counts) -> None:
        t = Tokens(close.join([*texts, b""]))
        first, after, last = chunks_of(t, window, spread)
        of = np.cumsum(t.end)[first]            # a chunk's text, by the texts closed before it
        counters = {(lang, k): held.by[lang, k] for lang in set(langs) for k in (0, 1)}
        for a, b, k, i in zip(t.starts[first].tolist(), t.ends[after - 1].tolist(), last.tolist(), of.tolist()):
            counters[langs[i], k][t.data[a:b] + close[:2] + b" "] += 1

    def run(batches):
        held = _Counts("chunk")
        for b in batches:
            texts, langs, size = [], [], 0
            for text, lang in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if text:
                    texts.append(normalised(text))
                    langs.append(lang)
                    size += len(texts[-1])
                if size >= SPAN:
                    cut_up(texts, langs, held)
                    texts, langs, size = [], [], 0
                    if held.full(HELD // 20):       # chunks are long
                        yield held.batch()
            if texts:
                cut_up(texts, langs, held)
            if held.full(HELD // 20):
                yield held.batch()
        yield held.batch()

    rows = text_batches(docs).select(F.col(text_col), F.coalesce(F.col(lang_col).cast("string"), F.lit("und")))
    return rows.mapInArrow(run, "lang string, kind int, chunk string, n long") \
        .groupBy("lang", "kind", "chunk").agg(F.sum("n").alias("n"))


class _Block:
    """The chunks of an Arrow batch, end to end: tokens, and for each the weight and the
    language (a place in ``langs``) of its chunk, and ``starts``: where a word stands that
    is the chunk's own (a closing window's words belong to the next chunk)."""

    def __init__(self, batch, window: int):
        self.t = t = Tokens("".join(batch.column(2).to_pylist()).encode())
        last, n = batch.column(1).to_numpy() == 1, batch.column(3).to_numpy()
        lang = batch.column(0).dictionary_encode()
        self.langs = lang.dictionary.to_pylist()
        ends = np.flatnonzero(t.end)
        size = np.diff(np.r_[-1, ends])
        self.n = np.repeat(n, size)
        self.lang = np.repeat(lang.indices.to_numpy(), size)
        self.starts = t.word.copy()
        for j in range(1, window + 1):
            self.starts[ends[~last] - j] = False
        # hashes of words, of pairs (at every token but the last), and where pairs are
        of = np.array([int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in self.langs], np.uint64)[self.lang]
        self.one, self.two = _mixed(t.h + of), _mixed(t.h[:-1] * K1 + t.h[1:] * K2 + of[:-1])
        self.pair = t.word[:-1] & t.word[1:]


def hash_counts(chunks: DataFrame, window: int) -> DataFrame:
    """(h, n): occurrences of all words and pairs of words in the dictionary's chunks, by hash."""
    def added(hs, ns):
        h, n = np.concatenate(hs), np.concatenate(ns)
        order = np.argsort(h)
        h, n = h[order], n[order]
        first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]]) if len(h) else np.zeros(0, np.int64)
        return pa.RecordBatch.from_pydict({"h": pa.array(h[first].view(np.int64)), "n": pa.array(np.add.reduceat(n, first) if len(h) else n)})

    def run(batches):
        hs, ns = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for b in batches:
            x = _Block(b, window)
            use = x.pair & x.starts[:-1]
            hs += [x.one[x.starts], x.two[use]]
            ns += [x.n[x.starts], x.n[:-1][use]]
            if sum(map(len, hs)) >= HASHES:
                yield added(hs, ns)
                hs, ns = hs[:1], ns[:1]
        yield added(hs, ns)

    return chunks.select("lang", "kind", "chunk", "n").mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


def _bits(h: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    return (h & np.uint64(0xFFFFFFFF)) % np.uint64(size), (h >> np.uint64(32)) % np.uint64(size)


def bloom_filter(hashes: DataFrame, size: int) -> bytes:
    """A Bloom filter of ``size`` bits (a power of two) over 64-bit hashes. At most
    ``size`` / 64 words of bits reach the driver, however many hashes there are."""
    def run(batches):
        bits = np.zeros(size, bool)
        for b in batches:
            for x in _bits(b.column(0).to_numpy().view(np.uint64), size):
                bits[x] = True
        words = np.packbits(bits, bitorder="little").view(np.int64)
        at = np.flatnonzero(words)
        yield pa.RecordBatch.from_pydict({"at": pa.array(at, pa.int64()), "word": pa.array(words[at])})

    found = hashes.select("h").mapInArrow(run, "at long, word long").groupBy("at").agg(F.bit_or("word").alias("word")).toArrow()
    out = np.zeros(size // 64, np.int64)
    out[found["at"].to_numpy()] = found["word"].to_numpy()
    return out.tobytes()


def count_phrases(chunks: DataFrame, max_words: int, window: int, frequent, bits: int) -> DataFrame:
    """(lang, kind, phrase, n): occurrences in the dictionary's chunks of the words (kind 1)
    that pass ``frequent`` (a broadcast Bloom filter), of the phrases of up to ``max_words``
    words (kind) all of whose pairs do, and of all words together (kind 0, no phrase)."""
    def add(counter: Counter, found, n: np.ndarray):
        if (n == 1).all():
            counter.update(found)
        else:
            for g, x in zip(found, n.tolist()):
                counter[g] += x

    def run(batches):
        held, filled = _Counts("phrase"), np.frombuffer(frequent.value, np.uint8)

        def passes(h):
            return np.logical_and.reduce([(filled[x >> np.uint64(3)] >> (x & np.uint64(7)).astype(np.uint8)) & 1 == 1 for x in _bits(h, bits)])

        for b in batches:
            x = _Block(b, window)
            data, starts, ends = x.t.data, x.t.starts, x.t.ends
            own = np.bincount(x.lang[x.starts], x.n[x.starts], len(x.langs))
            for i, lang in enumerate(x.langs):
                held.by[lang, 0][None] += int(own[i])
            pair, run_on = x.pair & passes(x.two), x.starts
            order = (x.lang.astype(np.int64) << 1) + (x.n != 1)     # by language, weights of one apart
            for k in range(1, max_words + 1):
                # the phrase of k words at i goes on from that of k - 1 by the pair at i + k - 2
                run_on = run_on if k == 1 else run_on[:-1] & pair[k - 2:]
                at = np.flatnonzero(run_on & passes(x.one) if k == 1 else run_on)
                at = at[np.argsort(order[at], kind="stable")]
                edges = np.flatnonzero(np.diff(order[at], prepend=-1, append=-1)) if len(at) else []
                found = [data[i:j] for i, j in zip(starts[at].tolist(), ends[at + k - 1].tolist())]     # words stand a space apart
                for i, j in zip(edges[:-1], edges[1:]):
                    add(held.by[x.langs[x.lang[at[i]]], k], found[i:j], x.n[at[i:j]])
            if held.full():
                yield held.batch()
        yield held.batch()

    return chunks.select("lang", "kind", "chunk", "n").mapInArrow(run, "lang string, kind int, phrase string, n long") \
        .groupBy("lang", "kind", "phrase").agg(F.sum("n").alias("n"))


def phrase_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", max_words: int = 3, least: int = 10,
                  spread: int = SPREAD, bits: int = 1 << 26) -> DataFrame:
    """(lang, kind, phrase, n): all phrases of 1 to ``max_words`` words (kind) that occur
    ``least`` times or more, with their numbers of occurrences, and the number of all words
    of a language (kind 0, no phrase)."""
    spark, window = docs.sparkSession, max(1, max_words - 1)
    at = f"{checkpoint_dir(spark).rstrip('/')}/collocations-{uuid.uuid4().hex}"
    parse(docs, text_col, lang_col, window, spread).write.parquet(f"{at}/chunks")
    chunks = spark.read.parquet(f"{at}/chunks")
    sent = spark.sparkContext.broadcast(bloom_filter(hash_counts(chunks, window).filter(F.col("n") >= least), bits))
    count_phrases(chunks, max_words, window, sent, bits).filter((F.col("kind") == 0) | (F.col("n") >= least)).write.parquet(f"{at}/phrases")
    return spark.read.parquet(f"{at}/phrases")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", max_words: int = 3, least: int = 10,
                 k: int = 2000, spread: int = SPREAD, bits: int = 1 << 26) -> DataFrame:
    """Each language's first ``k`` collocations: lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased (A-Z), split at ``.,;:!?`` and line ends into pieces and those
    into words at spaces and tabs. Candidates are phrases of 2 to ``max_words`` words with
    a >= ``least`` occurrences inside pieces. Cut after its first words, a candidate's parts
    occur l and r times; score is floor(10^6 a a / (l r)) of the lowest-scoring cut (ties:
    the shortest first part), exact in decimals. A candidate whose words lie inside a longer
    one that occurs at least half as often is dropped. Order: score, a (both descending),
    phrase (UTF-8 bytes). n counts the language's words.

    Whole texts; null and empty texts have no words; a null lang is ``und``, a language
    like others. Repeated rows count each; an empty table gives an empty result; other
    columns are ignored."""
    counts = phrase_counts(docs, text_col, lang_col, max_words, least, spread, bits)
    words = counts.filter("kind = 0").select("lang", F.col("n").alias("total"))
    held = counts.filter("kind > 0").select("lang", "kind", "phrase", F.col("n").alias("a"))
    cand = held.filter("kind > 1")
    w = F.split("phrase", " ")

    def joined(start, length):
        return F.array_join(F.slice(F.col("w"), start, length), " ")

    cuts = cand.withColumn("w", w).withColumn("at", F.explode(F.sequence(F.lit(1), F.col("kind") - 1))) \
        .select("lang", "kind", "phrase", "a", "at", joined(F.lit(1), F.col("at")).alias("head"), joined(F.col("at") + 1, F.col("kind") - F.col("at")).alias("rest"))
    part = held.select("lang", F.col("phrase").alias("part"), F.col("a").alias("f"))
    heads = part.select("lang", F.col("part").alias("head"), F.col("f").alias("l"))
    rests = part.select("lang", F.col("part").alias("rest"), F.col("f").alias("r"))
    value = F.expr("(cast(1000000 as decimal(7,0)) * cast(a as decimal(15,0)) * cast(a as decimal(15,0))) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))")
    scored = cuts.join(heads, ["lang", "head"]).join(rests, ["lang", "rest"]).withColumn("score", value) \
        .groupBy("lang", "kind", "phrase", "a").agg(F.min(F.struct("score", "at", "l", "r")).alias("b"))
    # what a longer candidate holds inside it, with the longer one's count
    spans = F.expr("flatten(transform(sequence(2, kind - 1), m -> transform(sequence(1, kind - m + 1), i -> array_join(slice(w, i, m), ' '))))")
    inside = cand.filter("kind > 2").withColumn("w", w).select("lang", F.explode(spans).alias("phrase"), "a") \
        .groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    left = scored.join(inside, ["lang", "phrase"], "left").filter(F.col("longer").isNull() | (100 * F.col("longer") < 50 * F.col("a")))
    best = best_per_key(left.select("lang", "phrase", "a", "b.l", "b.r", "b.score"), ["lang"], [F.desc("score"), F.desc("a"), F.asc("phrase")], k)
    return best.join(words, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("total").alias("n"), "score")


def oracle_sql() -> str:
    """The same in DuckDB SQL, from all phrases of all pieces."""
    return r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
g AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS a
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (VALUES (1), (2), (3)) AS s(k)) GROUP BY ALL),
n AS (SELECT lang, sum(a)::BIGINT AS n FROM g WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w FROM g WHERE k > 1 AND a >= 10),
u AS (SELECT lang, k, phrase, a, i, array_to_string(w[1:i], ' ') AS h, array_to_string(w[i + 1:k], ' ') AS t
      FROM (SELECT *, unnest(range(1, k)) AS i FROM c)),
s AS (SELECT u.lang, u.k, u.phrase, u.a, u.i, x.a AS l, y.a AS r, (1000000::HUGEINT * u.a * u.a) // (x.a::HUGEINT * y.a) AS score
      FROM u JOIN g x ON x.lang = u.lang AND x.phrase = u.h JOIN g y ON y.lang = u.lang AND y.phrase = u.t),
b AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, i) AS o FROM s),
d AS (SELECT lang, phrase, max(a) AS longer
      FROM (SELECT lang, a, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS phrase FROM c WHERE k = 3) GROUP BY ALL),
e AS (SELECT b.lang, b.phrase, b.a, b.l, b.r, b.score FROM b LEFT JOIN d USING (lang, phrase)
      WHERE o = 1 AND (d.longer IS NULL OR 100 * d.longer < 50 * b.a)),
f AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM e)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM f JOIN n USING (lang) WHERE rank <= 2000"""
