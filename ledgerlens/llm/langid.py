"""Operator 3: language identification by hierarchical discrimination.

A text becomes a vector of hashed byte n-grams (2 to 4 bytes, lower case, anything
but letters as one space), square roots of relative frequencies, so that its length
is one. A first set of linear support vector machines, one per language family
against the rest, picks the family; then one linear SVM per pair of the family's
languages ("one versus one") votes for the language.

The machines are fitted on a bounded sample (``max_docs`` labelled documents in all,
an equal share per language, chosen by hash among distinct texts); every document is predicted from its
whole text. The model is a few dense vectors per language pair.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_batches

BITS = 12
RANGE = 1 << 40     # of the hashes that choose the sample
#: Language codes of each family; a language listed nowhere is a family of its own.
FAMILIES = {
    "germanic": ["af", "da", "de", "en", "fy", "is", "lb", "nb", "nl", "nn", "no", "sv", "yi"],
    "romance": ["ca", "es", "fr", "gl", "it", "la", "oc", "pt", "ro"],
    "slavic": ["be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"],
    "uralic": ["et", "fi", "hu"],
    "semitic": ["am", "ar", "he", "mt"],
    "indo-iranian": ["bn", "fa", "gu", "hi", "ku", "mr", "ne", "pa", "ps", "sd", "ur"],
    "turkic": ["az", "kk", "ky", "tr", "tt", "ug", "uz"],
    "sino-tibetan": ["bo", "my", "yue", "zh"],
    "austronesian": ["id", "jv", "ms", "su", "tl"],
    "dravidian": ["kn", "ml", "ta", "te"],
}

_PLAIN = np.full(256, 32, np.uint8)     # ASCII letters and all other bytes above 127 stay
for _b in [*range(97, 123), *range(128, 256)]:
    _PLAIN[_b] = _b


def family(lang: str) -> str:
    code = lang.lower().replace("_", "-").split("-")[0]
    return next((f for f, codes in FAMILIES.items() if code in codes), code)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def vector(text: str) -> np.ndarray:
    """Hashed n-gram profile of a text with a letter, of length one."""
    b = _PLAIN[np.frombuffer(f" {text.lower()} ".encode("utf-8", "replace"), np.uint8)]
    b = b[np.concatenate(([True], (b[1:] != 32) | (b[:-1] != 32)))].astype(np.uint32)
    total, gram = np.zeros(1 << BITS, np.int64), b
    for n in (2, 3, 4):
        if len(b) < n:
            break
        gram = (gram[:-1] << np.uint32(8)) | b[n - 1:]
        h = (gram + np.uint32(n)) * np.uint32(2654435761)
        total += np.bincount(h >> np.uint32(32 - BITS), minlength=1 << BITS)
    return np.sqrt(total / max(1, total.sum())).astype(np.float32)


def linear_svm(x: np.ndarray, y: np.ndarray, c: float = 10.0, epochs: int = 30) -> np.ndarray:
    """Weights of an L2-regularised squared-hinge SVM (dual coordinate descent); a last
    column of ones in ``x`` gives the bias. ``y`` is +1 or -1; classes weigh alike
    whatever their sizes."""
    n, pos = len(y), max(1, int((y > 0).sum()))
    weight = np.where(y > 0, n / (2 * pos), n / (2 * max(1, n - pos)))
    soft = 1 / (2 * c * weight)
    q = np.einsum("ij,ij->i", x, x) + soft
    w, alpha, order = np.zeros(x.shape[1], np.float32), np.zeros(n), np.random.default_rng(7)
    for _ in range(epochs):
        worst = 0.0
        for i in order.permutation(n):
            g = y[i] * float(w @ x[i]) - 1 + soft[i] * alpha[i]
            a = max(alpha[i] - g / q[i], 0.0)
            if a != alpha[i]:
                worst = max(worst, abs(a - alpha[i]))
                w += np.float32((a - alpha[i]) * y[i]) * x[i]
                alpha[i] = a
        if worst < 1e-3:
            break
    return w


class Model:
    """families: names; family_w: a column each; pairs: per family its languages and
    {(i, j): weights}."""

    def __init__(self, x: np.ndarray, labels: list[str]):
        x = np.hstack([x.astype(np.float32, copy=False), np.ones((len(x), 1), np.float32)])
        lang = np.array(labels)
        of = {v: family(v) for v in sorted(set(labels))}
        self.families = sorted(set(of.values()))
        kin = np.array([of[v] for v in labels])
        self.langs = {f: sorted(v for v in of if of[v] == f) for f in self.families}
        self.family_w = np.stack([linear_svm(x, np.where(kin == f, 1, -1)) for f in self.families], axis=1) \
            if len(self.families) > 1 else np.zeros((x.shape[1], 1), np.float32)
        self.pairs = {}
        for f in self.families:
            for i, j in combinations(range(len(self.langs[f])), 2):
                a, b = self.langs[f][i], self.langs[f][j]
                at = (lang == a) | (lang == b)
                self.pairs[f, i, j] = linear_svm(x[at], np.where(lang[at] == a, 1, -1))

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        n = len(x)
        x = np.hstack([x, np.ones((n, 1), np.float32)])
        m = x @ self.family_w
        best = m.argmax(axis=1)
        score = np.ones(n)
        if len(self.families) > 1:
            second = np.partition(m, -2, axis=1)[:, -2]
            score = _squash(m[np.arange(n), best] - second)
        lang = np.empty(n, object)
        for k, f in enumerate(self.families):
            at, names = np.flatnonzero(best == k), self.langs[f]
            if not len(at):
                continue
            if len(names) == 1:
                lang[at] = names[0]
                continue
            margin = np.zeros((len(at), len(names), len(names)))
            for i, j in combinations(range(len(names)), 2):
                margin[:, i, j] = x[at] @ self.pairs[f, i, j]
                margin[:, j, i] = -margin[:, i, j]
            votes = (margin > 0).sum(axis=2) + _squash(margin.sum(axis=2)) * 0.5
            win = votes.argmax(axis=1)
            own = margin[np.arange(len(at)), win]
            own[np.arange(len(at)), win] = np.inf
            lang[at] = np.array(names, object)[win]
            score[at] *= _squash(own.min(axis=1))
        return lang.tolist(), np.clip(score, 0.0, 1.0)


def _squash(m: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(3 * m, -30, 30)))


def sample(rows: DataFrame, max_docs: int) -> list[int]:
    """Hashes h of the distinct (lang, text) of ``rows`` (columns lang, h) to learn from:
    of each language the max_docs / languages smallest ones (one at least), or all it has."""
    about = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).collect()}
    share = max(1, max_docs // max(1, len(about)))
    # a draw somewhat larger than the share, whose size follows the estimate; what is short is drawn again from more
    part = {v: min(1.0, (1.25 * share + 5 * share ** 0.5 + 10) / max(1, n)) for v, n in about.items()}
    out: list[int] = []
    while part:
        limits = F.create_map(*[F.lit(x) for v, p in sorted(part.items()) for x in (v, int(p * RANGE))])
        drawn = rows.filter(F.pmod("h", F.lit(RANGE)) < F.element_at(limits, F.col("lang"))).distinct()
        got: dict[str, list[int]] = {v: [] for v in part}
        for r in drawn.collect():
            got[r["lang"]].append(r["h"])
        for v, h in got.items():
            if len(h) >= share or part[v] >= 1.0:
                out += sorted(h, key=lambda x: (x % RANGE, x))[:share]
        part = {v: min(1.0, 4 * p) for v, p in part.items() if len(got[v]) < share and p < 1.0}
    return out


def fit(train: DataFrame, text_col: str, lang_col: str, max_docs: int = 4000) -> Model | None:
    """A model from at most ``max_docs`` distinct texts of ``train`` with a letter and a
    language, an equal share per language, one at least; equal rows count once, before
    the shares are drawn. None if there are no such rows."""
    rows = text_batches(train).select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")) \
        .filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).withColumn("h", F.xxhash64("lang", "text"))
    chosen = sample(rows.select("lang", "h"), max_docs)
    if not chosen:
        return None
    few = train.sparkSession.createDataFrame([(h,) for h in chosen], "h long")
    some = rows.join(F.broadcast(few), "h").dropDuplicates(["h"])

    def vectors(batches):
        for b in batches:
            b = b[[has_letter(t) for t in b["text"]]]
            yield pd.DataFrame({"lang": b["lang"], "h": b["h"], "v": [vector(t).astype(np.float16).tobytes() for t in b["text"]]})

    got = some.mapInPandas(vectors, "lang string, h long, v binary").toPandas().sort_values("h")
    if not len(got):
        return None
    return Model(np.stack([np.frombuffer(v, np.float16) for v in got["v"]]).astype(np.float32), got["lang"].tolist())


def predictor(spark, model: Model | None):
    """A column function text -> struct(lang_pred, score): ``und`` and 0 for a null text
    or one without a letter, and where nothing was learned."""
    held = spark.sparkContext.broadcast(model)      # a few vectors per pair of languages

    @F.pandas_udf("lang_pred string, score double")
    def predict(text: pd.Series) -> pd.DataFrame:
        model = held.value
        out = pd.DataFrame({"lang_pred": ["und"] * len(text), "score": np.zeros(len(text))})
        some = [i for i, t in enumerate(text) if model is not None and has_letter(t)]
        for k in range(0, len(some), 512):
            at = some[k:k + 512]
            lang, score = model.predict(np.stack([vector(text.iloc[i]) for i in at]))
            out.iloc[at, 0] = lang
            out.iloc[at, 1] = score
        return out

    return predict


def held_out(id_col: Column) -> Column:
    """crc32 of the id as text leaves 2 when divided by 4; a null id is not held out."""
    return F.coalesce(F.crc32(id_col.cast("string")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             max_docs: int = 4000) -> DataFrame:
    """One row per row of ``docs``: id, held_out, lang_pred, score.

    Learns from the rows that are not held out and have a language; predicts every
    row from its text alone. Null texts and texts without a letter give ``und`` and
    0; so does everything if there is nothing to learn from. Repeated rows stay;
    an empty table gives an empty result; other columns are ignored."""
    model = fit(docs.filter(~held_out(F.col(id_col))), text_col, lang_col, max_docs)
    of = predictor(docs.sparkSession, model)
    return docs.select(F.col(id_col), held_out(F.col(id_col)).alias("held_out"), of(F.col(text_col)).alias("p")) \
        .select(id_col, "held_out", "p.lang_pred", "p.score")
