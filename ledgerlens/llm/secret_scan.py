"""Operator 4: secrets in texts, by patterns and by a token-efficiency test.

Base patterns find assignments, access keys and long hex runs. Beyond them, a run
of key characters that a byte-pair vocabulary needs many tokens for (few
characters a token) is a random string: words and names cost few tokens, random
ones many. Known digests (hex of a digest's length, UUIDs), numbers and identifiers
(mostly letters, in runs that the vocabulary has words for) are left out of that test.
A run that passes as a whole is tested again without its words and numbers, which
separators join to a secret.
"""

from __future__ import annotations

import base64
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_batches

# The base patterns and their least lengths.
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "random")
KEYWORDS = (b"passw", b"secret", b"token", b"apikey", b"api_key")
DIGEST_LENGTHS = (32, 40, 48, 56, 64, 96, 128)

LEAST = 16      # characters of a random string
RUN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % LEAST)
UUID = re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
#: What separators join: UUIDs as one, else letters and digits.
PART = re.compile(rf"(?<![A-Za-z0-9]){UUID.pattern}(?![A-Za-z0-9])|[A-Za-z0-9]+")
LETTERS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
#: Least characters a token of a letter run that is a word; least share of such runs in an identifier.
WORD_RATIO, WORD_SHARE = 2.5, 0.6
#: Bytes of any base or candidate run as they are, all others as a space.
_RUNS = bytes(c if chr(c) in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-" else 32 for c in range(256))


class Vocabulary:
    """A public tiktoken vocabulary, loaded once per worker process."""

    _held: dict[str, "Vocabulary"] = {}

    def __init__(self, name: str):
        import public_tokenizers
        import tiktoken

        with open(public_tokenizers.path(name), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    @classmethod
    def of(cls, name: str) -> "Vocabulary":
        if name not in cls._held:
            cls._held[name] = cls(name)
        return cls._held[name]

    def chars_per_token(self, s: str) -> float:
        return len(s) / len(self.encoding.encode_ordinary(s))

    def is_word(self, w: str) -> bool:
        """A run of letters of few tokens, as it is or in lower case after a space."""
        return len(w) >= 3 and (self.chars_per_token(w) >= WORD_RATIO
                                or len(w) / len(self.encoding.encode_ordinary(" " + w.lower())) >= WORD_RATIO)


def known(s: str, vocabulary: Vocabulary) -> bool:
    """A digest, no letter at all, or an identifier: mostly letters, most of them in words."""
    if UUID.fullmatch(s) or (len(s) in DIGEST_LENGTHS and re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", s)):
        return True
    runs = LETTERS.findall(s)
    n = sum(map(str.isalnum, s))
    if sum(map(len, runs)) < 0.7 * n:
        return not runs
    return sum(len(w) for w in runs if vocabulary.is_word(w)) >= WORD_SHARE * n


def random_spans(s: str, vocabulary: Vocabulary, max_ratio: float) -> list[tuple[int, int]]:
    """Random strings in ``s``, a run without base spans: all of it, else its stretches
    of parts (between separators) that are no words or numbers, else such a part."""
    def low(a, b):
        return b - a >= LEAST and vocabulary.chars_per_token(s[a:b]) <= max_ratio and not known(s[a:b], vocabulary)

    if low(0, len(s)):
        return [(0, len(s))]
    stretches, open_ = [], False
    for m in PART.finditer(s):
        plain = len(m[0]) >= 3 and (vocabulary.chars_per_token(m[0]) > max_ratio or known(m[0], vocabulary))
        if not plain:
            if not open_:
                stretches.append([])
            stretches[-1].append(m.span())
        open_ = not plain
    out = []
    for parts in stretches:
        a, b = parts[0][0], parts[-1][1]
        out += [(a, b)] if low(a, b) else [p for p in parts if low(*p)]
    return out


def find(text: str | None, vocabulary: Vocabulary, max_ratio: float) -> list[tuple[str, int, int]]:
    """(kind, start, end) by start, then kind as listed; code points, end exclusive.
    The base kinds may overlap; an added one lies apart from all of them."""
    if not text:
        return []
    raw = text.encode("utf-8", "replace")
    low = raw.lower()
    long_run = max(map(len, raw.translate(_RUNS).split()), default=0) >= LEAST
    out = []
    if any(k in low for k in KEYWORDS):
        out += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if long_run:
        if "AKIA" in text:
            out += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
        out += [("hex", *m.span()) for m in HEX.finditer(text)]
        base = sorted((a, b) for _, a, b in out)
        for m in RUN.finditer(text):
            at, end = m.span()
            for x, y in [*((x, y) for x, y in base if x < end and at < y), (end, end)]:
                if x - at >= LEAST:
                    out += [("random", at + a, at + b) for a, b in random_spans(text[at:x], vocabulary, max_ratio)]
                at = max(at, y)
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0])))


def redacted(text: str, spans) -> str:
    """``text`` with every span (overlapping ones together) as [SECRET]."""
    out, at = [], 0
    for _, a, b in spans:
        if a >= at:
            out += [text[at:a], "[SECRET]"]
        at = max(at, b)
    return "".join(out) + text[at:]


def _scanner(returns: str, make, vocabulary: str, max_ratio: float):
    @F.pandas_udf(returns)
    def scan(text: pd.Series) -> pd.Series:
        voc = Vocabulary.of(vocabulary)
        return pd.Series([make(t, find(t, voc, max_ratio)) for t in text], dtype=object)

    return scan


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 vocabulary: str = "byte_bpe_50k.tiktoken", max_ratio: float = 2.0) -> DataFrame:
    """One row per row of ``docs``: id and ``spans``, an array of (kind, start, end).

    Whole texts; null and empty texts have no spans. Repeated rows and null ids keep
    a row each; an empty table gives an empty result; other columns are ignored."""
    of = _scanner("array<struct<kind:string,start:long,end:long>>",
                  lambda t, s: [{"kind": k, "start": a, "end": b} for k, a, b in s], vocabulary, max_ratio)
    return text_batches(docs).select(F.col(id_col), of(F.col(text_col)).alias("spans"))


def redact(docs: DataFrame, text_col: str = "text", vocabulary: str = "byte_bpe_50k.tiktoken",
           max_ratio: float = 2.0) -> DataFrame:
    """``docs`` with every secret of the text replaced by [SECRET]; null stays null."""
    of = _scanner("string", lambda t, s: redacted(t, s) if s else t, vocabulary, max_ratio)
    return text_batches(docs).withColumn(text_col, of(F.col(text_col)))


def digest_columns(spans: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """n_assign, n_access, n_hex, base_sha256 and spans (all, as text) from ``secret_spans``."""
    def text_of(x):
        return F.array_join(F.transform(x, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] != "random")
    return spans.select(F.col(id_col), *[number(k) for k in KINDS], F.sha2(text_of(base), 256).alias("base_sha256"),
                        text_of(F.col("spans")).alias("spans"))
