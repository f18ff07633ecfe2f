"""Operators 11, 12 and 13 on awkward tables and against brute force and SQL."""

import math
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from llm_data import DOCS, ROWS, clash, docs, rows_of

from ledgerlens.llm import collocations, lexical_search, license_scan

SF = "/root/testdata/sf0.001"
TEXTS = [
    "The MIT License. Released under the MIT license, MIT-License!", "GNU General Public  License\nv3 and gnu general public license",
    "Licensed under the Apache License, Version 2.0. See CC BY-NC-SA 4.0 or Licensed under CC BY 4.0.", "cc by cc by cc\tby", "çc by éapache license mit licenseé",
    " ".join(license_scan.TEMPLATES["mit-text"].replace("<<8>>", "the authors or copyright holders").replace("{{including the next paragraph}}", "").replace("{{the software}}", "(the software)").split()),
    "This work, as it stands, is licensed under the GNU Lesser General Public License", "spdx license\x00identifier: MIT", "gnu general\x1cpublic license",
    "mit license " * 4000, "Neither the name of the University of X nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
]
MORE = ROWS + [(100 + i, t, "en", "a", 1) for i, t in enumerate(TEXTS)]


def as_frame(rows, **names):
    import pandas as pd
    return pd.DataFrame(rows, columns=["doc_id", "text", "lang", "source", "n_chars"]).astype({"doc_id": "Int64", "n_chars": "Int64"})


def sql_rows(sql, **frames):
    con = duckdb.connect()
    for k, v in frames.items():
        con.register(k, v)
    got = con.sql(sql)
    return got.columns, got.fetchall()


def same(df, columns, want):
    """Equal rows, doubles to nine places."""
    def plain(v):
        return round(v, 9) if isinstance(v, float) else v

    got = Counter(tuple(plain(r[c]) for c in columns) for r in df.collect())
    assert got == Counter(tuple(plain(v) for v in r) for r in want)


# --- operator 11

def scan(df):
    return license_scan.digest_columns(license_scan.license_places(df))


def test_license_awkward_tables(spark):
    got = scan(docs(spark, MORE))
    assert Counter(r["doc_id"] for r in got.collect()) == Counter(r[0] for r in MORE)
    assert rows_of(got) == rows_of(scan(clash(docs(spark, MORE[::-1]).repartition(3))), *got.columns)
    assert scan(spark.createDataFrame([], DOCS)).collect() == []


def test_license_matches_sql(spark):
    same(scan(docs(spark, MORE)), *sql_rows(license_scan.oracle_sql(), documents=as_frame(MORE)))


def test_license_base_places_and_labels(spark):
    got = {r["doc_id"]: r for r in scan(docs(spark, MORE)).collect()}
    g = lambda i: (got[100 + i]["n_base"], got[100 + i]["first_word"], got[100 + i]["last_word"], got[100 + i]["base_labels"])
    assert g(0) == (3, 1, 8, "mit") and g(1) == (2, 0, 6, "gpl") and g(3) == (3, 0, 4, "cc-by") and g(4) == (0, None, None, "")
    assert got[109]["n_base"] == 4000 and got[109]["last_word"] == 7998 and got[109]["score"] == pytest.approx(2 / 8000)
    assert got[100]["labels"] == "mit,mit-notice" and "mit-text" in got[105]["labels"] and got[105]["score"] > 0.9
    assert got[102]["labels"] == "apache,apache-notice,cc-by,cc-by-nc,cc-by-notice"
    assert got[106]["labels"] == "gpl-notice" and got[106]["base_labels"] == ""      # "gnu lesser general ...": no base phrase
    assert "bsd-no-endorsement" in got[110]["labels"] and got[107]["labels"] == "spdx-line"
    assert (got[4]["n_words"], got[4]["n_base"], got[4]["first_word"], got[4]["score"], got[4]["labels"]) == (0, 0, None, 0.0, "")


def as_regex(template):
    parts = {"{{": "(?:", "}}": ")?"}
    return re.compile(" " + "".join(parts.get(x) or (f"(?:[^ ]+ ){{0,{x[2:-2]}}}" if x.startswith("<<") else x + " ") for x in re.findall(r"\{\{|\}\}|<<\d+>>|[a-z0-9]+", template)))


def test_token_automaton_against_regular_expressions():
    """Random templates and texts over few words: a place for every end that a regular
    expression reaches, the longest; also when the states are forgotten all the time."""
    rng = np.random.default_rng(11)
    words = list("abcd")
    for trial in range(60):
        made = []
        for k in range(4):
            parts = [words[rng.integers(4)]]
            for _ in range(rng.integers(1, 5)):
                kind = rng.integers(4)
                parts.append("{{" + " ".join(words[j] for j in rng.integers(0, 4, rng.integers(1, 3))) + "}}" if kind == 0 else f"<<{rng.integers(1, 3)}>>" if kind == 1 else words[rng.integers(4)])
            made.append((f"t{k}", False, " ".join([*parts, words[rng.integers(4)]])))
        text = [words[j] if j < 4 else "x" for j in rng.integers(0, 5, 30)]
        if trial % 2:
            license_scan.MAX_STATES = 3
        got = set(license_scan.TokenAutomaton(made).places(text))
        license_scan.MAX_STATES = 20_000
        want = set()
        for k, (_, _, t) in enumerate(made):
            pattern = as_regex(t)
            for end in range(1, len(text) + 1):
                for start in range(end):
                    if pattern.fullmatch(" " + " ".join(text[start:end]) + " "):
                        want.add((k, start, end))
                        break
        assert got == want


def test_templates_must_be_closed_and_have_wording():
    for bad in ("{{a b", "{{a}} <<3>>"):
        with pytest.raises(ValueError):
            license_scan.TokenAutomaton([("x", False, bad)])


# --- operator 12

ITEMS = "item_id long, text string"
QUERIES = [(1, "the river house, the river"), (2, None), (3, "--- !!"), (4, "garden 12 345 MAISON"), (5, "zzz unknown"), (6, "rivière là"), (6, "night night"), (None, "children")]


def by_hand(rows, items, k=10):
    term = re.compile(lexical_search.TERM)
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    held = [(r[0], Counter(term.findall((r[1] or "").translate(low)))) for r in rows]
    held = [(i, c, sum(c.values())) for i, c in held if c]
    n, total, df = len(held), sum(x[2] for x in held), Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        want, found = Counter(term.findall((text or "").translate(low))), []
        for i, c, size in held:
            m = 100 - 75 + (75 * size * n) // total
            s = sum(q * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t, q in want.items() if c[t])
            if s > 0:
                found.append((-s, i is None, i or 0, i))
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(found)[:k])]
    return out


@pytest.mark.parametrize("block_terms", [100_000, 2])
def test_lexical_search_against_brute_force(spark, block_terms):
    items = spark.createDataFrame(QUERIES, ITEMS)
    got = lexical_search.search(clash(docs(spark).repartition(3)), clash(items), block_terms=block_terms)
    want = by_hand(ROWS, QUERIES)
    assert Counter(map(tuple, got.select("item_id", "rank", "doc_id", "score").collect())) == Counter(want) and want
    few = lexical_search.search(docs(spark), items, k=1)
    assert Counter(map(tuple, few.select("item_id", "rank", "doc_id", "score").collect())) == Counter(by_hand(ROWS, QUERIES, 1))


def test_lexical_search_matches_sql(spark):
    import pandas as pd
    from ledgerlens.llm import queries
    con = duckdb.connect()
    con.register("documents", as_frame(ROWS))
    con.register("benchmark", pd.DataFrame(QUERIES, columns=["item_id", "text"]).astype({"item_id": "Int64"}))
    got = con.sql(lexical_search.oracle_sql()).fetchall()
    assert Counter(got) == Counter(by_hand(ROWS, QUERIES))
    for t in ("documents", "benchmark"):
        con.execute(f"DROP VIEW IF EXISTS {t}")
        con.unregister(t)
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    cur = con.sql(lexical_search.oracle_sql())
    same(queries.op12_lexical_search(spark, SF), cur.columns, cur.fetchall())


def test_lexical_search_empty_sides(spark):
    none, items = spark.createDataFrame([], DOCS), spark.createDataFrame(QUERIES, ITEMS)
    for d, i in ((none, items), (docs(spark), items.limit(0)), (docs(spark, [(1, None, None, None, None), (2, " ..", None, None, None)]), items)):
        out = lexical_search.search(d, i)
        assert out.collect() == [] and out.columns == ["item_id", "rank", "doc_id", "score"]


def test_whole_terms_only_and_overlapping_guards():
    found = lexical_search.automaton("t", ["a", "ab", "b", "é"])
    text, n = lexical_search.guarded("A ab,b  a;É é aé\x00b a")
    assert n == 9 and lexical_search.term_counts(found, text) == {0: 3, 1: 1, 2: 2, 3: 1}


def test_best_of_items_keeps_the_right_rows():
    rng = np.random.default_rng(2)
    best, all_ = lexical_search._Best(3, 4), defaultdict(list)
    best.LEAST = 20
    for doc in rng.permutation(400):
        scores = rng.integers(0, 6, 3)
        doc = None if doc < 5 else int(doc)
        best.add(scores.astype(np.int64), doc)
        for i, s in enumerate(scores):
            if s:
                all_[i].append((-int(s), doc is None, doc or 0))
    i, s, d, nil = best.keep()
    got = defaultdict(list)
    for a, b, c, e in zip(i, s, d, nil):
        got[int(a)].append((-int(b), bool(e), int(c)))
    assert got == {k: sorted(v)[:4] for k, v in all_.items()}


# --- operator 13

def collocations_by_hand(rows, max_words=3, least=10, k=2000):
    low, f, n = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(low)):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for size in range(1, max_words + 1):
                f.update((lang, *w[i:i + size]) for i in range(len(w) - size + 1))
    cand, out = {g: a for g, a in f.items() if len(g) > 2 and a >= least}, defaultdict(list)
    longer = Counter()
    for (lang, *w), a in cand.items():
        for size in range(2, len(w)):
            for i in range(len(w) - size + 1):
                g = (lang, *w[i:i + size])
                longer[g] = max(longer[g], a)
    for (lang, *w), a in cand.items():
        if 100 * longer[lang, *w] >= 50 * a:
            continue
        s, c, l, r = min((10**6 * a * a // (f[lang, *w[:c]] * f[lang, *w[c:]]), c, f[lang, *w[:c]], f[lang, *w[c:]]) for c in range(1, len(w)))
        out[lang].append((-s, -a, " ".join(w).encode(), l, r))
    return [(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for lang, v in out.items() for i, (s, a, p, l, r) in enumerate(sorted(v)[:k])]


COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def prose(seed=13, n=150):
    rng = np.random.default_rng(seed)
    words = ["The", "of", "Été", "a", "b-c", "d", "e'f", "g\x1c", "日本", "h"]
    passage = "The of a, d b-c the of a d! Été h\th the of"
    rows = []
    for i in range(n):
        t = "".join(words[min(int(j), 9)] + (" ", "  ", "\t", ", ", "\n", " ")[rng.integers(6)] for j in rng.exponential(2.5, rng.integers(0, 60)))
        rows.append((i, t + (passage if i % 3 == 0 else ""), ["en", "fr", None, "und"][i % 4], "a", 1))
    return rows + ROWS + [(900 + i, "x y z " * 40, "en", "b", 1) for i in range(4)]


@pytest.mark.parametrize("settings", [{}, {"spread": 2}, {"spread": 1}, {"spread": 10**9}, {"bits": 64}, {"max_words": 2}, {"max_words": 4, "least": 6, "spread": 3}, {"k": 3}])
def test_collocations_against_brute_force(spark, settings):
    """Any chunking, any filter: the same counts."""
    rows = prose()
    got = collocations.collocations(clash(docs(spark, rows).repartition(5)), **settings)
    want = collocations_by_hand(rows, **{k: v for k, v in settings.items() if k in ("max_words", "least", "k")})
    assert Counter(map(tuple, got.select(*COLUMNS).collect())) == Counter(want) and len(want) > 5


def test_collocations_match_sql(spark):
    rows = [r for r in prose(14) if len(r[1] or "") < 10_000]       # the SQL copies a piece's words for each phrase
    cols, want = sql_rows(collocations.oracle_sql(), documents=as_frame(rows))
    same(collocations.collocations(docs(spark, rows)), cols, want)


def test_collocations_of_little(spark):
    for rows in ([], [(1, None, None, None, None), (2, "", "en", "a", 0), (3, " ,. \t", "en", "a", 0)], [(1, "one", "en", "a", 1)] * 30):
        assert collocations.collocations(docs(spark, rows) if rows else spark.createDataFrame([], DOCS)).collect() == []


def test_chunks_overlap_by_a_window_and_equal_passages_are_cut_alike():
    rng = np.random.default_rng(5)
    close = bytes((32, collocations.END, 32))
    shared = " ".join(f"s{j}" for j in rng.integers(0, 500, 400))
    texts = [" ".join(f"w{j}" for j in rng.integers(0, 300, rng.integers(0, 200))) + (" " + shared if i % 2 else "") for i in range(8)]
    t = collocations.Tokens(close.join([*(collocations.normalised(x) for x in texts), b""]))
    first, after, last = collocations.chunks_of(t, 2, 16)
    assert int(last.sum()) == sum(bool(x.split()) for x in texts) and len(first) > 50
    for i in range(len(first) - 1):
        assert last[i] or after[i] - first[i + 1] == 2
    whole = Counter(t.data[t.starts[a]:t.ends[b - 1]] for a, b in zip(first, after))
    assert sum(n for n in whole.values() if n >= 4) > 40      # most chunks of the shared passage, four times each
    # hashes depend on a token's bytes alone, in one span or many
    a = collocations.Tokens(b"  ab  c\x00 ab\xc3\xa9 \n ab ")
    assert a.data == b"ab c\x00 ab\xc3\xa9 \n ab" and a.h[0] == a.h[4] and len(set(a.h.tolist())) == 4 and a.word.tolist() == [True, True, True, False, True]
    size, collocations.SPAN = collocations.SPAN, 3
    assert (collocations.Tokens(a.data).h == a.h).all()
    collocations.SPAN = size
