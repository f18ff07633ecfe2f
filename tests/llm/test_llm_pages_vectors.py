"""Operators 5, 7, 9 and 10 on awkward tables and against brute force."""

import duckdb
import numpy as np
import pytest
from llm_data import clash, rows_of
from pyspark.sql import functions as F

from ledgerlens.llm import ann, embed_dedup, html_main, url_filter
from ledgerlens.llm.common import table
from ledgerlens.llm.graph import connected_components
from ledgerlens.llm.html_main import Page

PAGES = "page_id long, url string, html string"
BODY = "<p>" + "Long words of an article, told at some length. " * 8 + "</p>"
ROWS = [
    (1, "http://a.net/x", f'<link rel="canonical" href="http://b.com/y"><body><article>{BODY}</article></body>'), (2, "http://b.com/y", None),
    (3, "https://b.com/y#frag", ""), (4, "http://c.example.net/en/1", '<meta http-equiv="refresh" content="0; url=/x2">'),
    (5, "http://c.example.net/x2", "plain text, no tags"), (6, None, None), (7, "nope", "<link rel=canonical href=http://a.net/x>"),
    (8, "http://z.com", '<link href="//www.example.com/de/1" rel="canonical">'), (None, "http://q.org/fr/1", "<p>x"),
    (9, "HTTP://Z.COM/q?u=http://k", '<meta http-equiv=refresh content="1;url=next.html">'), (10, "http://net/", "<"), (10, "http://net/", "<"),
    (11, "http://z.com/next.html", "<div" + " <p>word" * 20_000), (12, "ftp://q.net", "&lt;b&gt; &amp <b>x</b>"), (13, "http://sub.org/fr/", None),
]


def pages(spark, rows=ROWS):
    return spark.createDataFrame(rows, PAGES)


@pytest.mark.parametrize("op", [html_main.main_text, url_filter.judge_urls])
def test_awkward_pages(spark, op):
    got = op(pages(spark))
    assert got.count() == len(ROWS)
    assert rows_of(got) == rows_of(op(clash(pages(spark, ROWS[::-1]).repartition(3))))
    assert op(spark.createDataFrame([], PAGES)).collect() == []


# --- operator 5

def test_blocks_and_boilerplate():
    p = Page('<html><body class="has-sidebar"><div class="menu"><a href=x>Home</a></div><div id=wrap><div class="post-content"><h1>T &amp; U</h1>'
             '<p>Hello   <b>wor</b>ld&nbsp;x<p>Two<br>three<ul><li>a<li>b</ul><table><tr><td>1<td>2<tr><td>3</table><div class="ad-box">buy</div>'
             '<form>q<input></form><script>if(a<b)"</p>"</script></div><article class="comment">reader says</article></div>'
             '<footer>f</footer><p unclosed="')
    assert p.text(p.containers[p.best()][0]).split("\n") == ["T & U", "Hello world x", "Two", "three", "a", "b", "1", "2", "3"]
    assert "reader" not in "\n".join(x for x, ok in zip(p.blocks, p.kept) if ok)


def test_consensus_beats_a_page_of_its_own(spark):
    """On one page a notice is longer than the text; the host's other pages outvote it."""
    def html(main, note):
        return f'<body><div class="c1"><p>{main}</p></div><div class="c-x"><p>{note}</p></div></body>'

    rows = [(i, f"http://h.com/{i}", html("Main text of the page. " * 9, "Note.")) for i in range(6)]
    rows.append((9, "http://h.com/9", html("Short main text.", "We would like to tell you something else. " * 9)))
    got = {r["page_id"]: r["text"] for r in html_main.main_text(pages(spark, rows)).collect()}
    assert got[9] == "Short main text."
    assert got[0] == ("Main text of the page. " * 9).strip()


def test_paths_join_alike_beyond_the_broadcast_bound(spark):
    assert rows_of(html_main.main_text(pages(spark), broadcast_mb=0)) == rows_of(html_main.main_text(pages(spark)))


def test_articles_of_the_given_pages(spark):
    """The given pages hold their text in <article>: it comes out whole, and nothing else."""
    import html
    import re

    t = table(spark, "/root/testdata/sf0.01", "pages")
    got = {r["page_id"]: r for r in html_main.main_text(t).collect()}
    for r in t.collect():
        inner = re.sub(r"<[^>]*\Z", "", re.search(r"(?s)<article>(.*?)(</article>|\Z)", r["html"])[1])
        parts = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1|br)\b[^>]*>", inner))
        want = "\n".join(x for x in parts if x)
        assert got[r["page_id"]]["text"] == want and got[r["page_id"]]["n_chars"] == len(want)


ARTICLE = "<article><h1>Title</h1>" + BODY + "</article>"
WANT = "Title\n" + " ".join(BODY[3:-4].split())


@pytest.mark.parametrize("html", [
    f'<div class="layout-sidebar-right">{ARTICLE}<div class="sidebar"><p>Other things.</p></div></div>',
    f'<div class="elementor-widget-container">{ARTICLE}</div><div class="widget"><p>More.</p></div>',
    f'<div class="content-with-sidebar">{ARTICLE}</div><div class="related"><article><p>A teaser.</p></article></div>',
    f'<div class="page-header-wrap"><div class="widget-outer"><main>{BODY.replace("<p>", "<h1>Title</h1><p>")}</main><div class="share">Share!</div></div></div>',
    f'<div class="social-layout"><div><h1>Title</h1>{BODY}</div></div><div class="cookie-bar"><p>We use cookies.</p></div>',
    f'{ARTICLE}<div class="comments">{BODY * 3}<article><p>reader</p></article></div><div id="sidebar">{BODY}{BODY}</div>',
])
def test_wrappers_keep_their_article(html):
    """A negative word in a wrapper's name drops neither the article nor most of the prose;
    comments, widgets and sidebars still go, however long they are."""
    p = Page(f"<body>{html}</body>")
    assert p.text(p.containers[p.best()][0]) == WANT


def test_a_page_of_doubtful_parts_only_is_not_empty():
    assert Page('<div class="widget"><p>a</p></div><div class="banner"><p>b</p></div>').text(None) == "a\nb"
    assert Page('<div class="comments"><p>a</p></div><div class="ad"><p>b</p></div>').text(None) == ""


def test_alternating_containers_cost_no_more_than_flat_ones():
    import tracemalloc

    html = "<div><section>" * 5000 + "<p>" + "deep text " * 9
    tracemalloc.start()
    p = Page(html)
    votes = p.votes()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 50e6 and sum(map(len, votes)) < 1e6 and p.text(None) == ("deep text " * 9).strip()


def test_deep_and_broken_markup():
    assert Page("<div>" * 5000 + "x").text(None) == "x"
    assert len({c[0] for c in Page("<div>" * 5000 + "x").containers}) == 3       # the document, a div, a run of divs
    assert Page("a <!-- b").text(None) == "a" and Page("<p>a</div></b>b<i").text(None) == "ab"
    assert Page("<title>t</title><style>s").text(None) == ""


# --- operator 7

def test_url_verdicts_match_sql(spark):
    con = duckdb.connect()
    con.register("pages", pages(spark).toPandas().astype({"page_id": "Int64"}))
    want = sorted(tuple(str(x) for x in r) for r in con.sql(url_filter.oracle_sql()).fetchall())
    got = rows_of(url_filter.judge_urls(pages(spark)), "page_id", "host", "path", "rule", "verdict")
    assert got == want
    verdict = {r["page_id"]: (r["rule"], r["verdict"]) for r in url_filter.judge_urls(pages(spark)).collect()}
    assert verdict[2] == (None, "block") and verdict[8] == (None, "block")      # aliases of blocked addresses
    assert verdict[4] == ("example.net/en/", "allow") and verdict[5] == ("net/", "block")   # own rules stand
    assert verdict[13] == ("org/fr/", "allow") and verdict[12] == (None, "allow")


def test_all_links_of_a_page_count(spark):
    """Every canonical link and refresh of a page is an edge: after one without a target,
    with canonical among other words of rel, among several, in either quotes; no other
    link or meta is one."""
    b = "http://www.example.com/de/1"
    tags = [f'<link rel=canonical><link rel="canonical" href="{b}">', f'<link rel="shortlink Canonical" href=\'{b}\'>',
            f'<LINK HREF={b} REL=canonical>', f'<link rel=canonical href="http://q.com/"><link rel=canonical href="{b}">',
            f'<meta http-equiv=refresh content="9"><meta http-equiv="Refresh" content="0; URL={b}">', f'<link title="a > b" rel="canonical" href="{b}">',
            f'<link rel="alternate canonical-ish" href="{b}">', f'<link rel="alternate" title="rel=canonical" href="{b}">', f'<meta name="refresh" content="0; url={b}">',
            f'<link rel="canonical" data-href="{b}">', f'<linked rel="canonical" href="{b}">']
    rows = [(i, f"http://h{i}.com/", t) for i, t in enumerate(tags)]
    df = pages(spark, rows)
    got = {r["page_id"]: r["verdict"] for r in url_filter.judge_urls(df).collect()}
    assert got == {i: "block" if i < 6 else "allow" for i in range(len(tags))}
    con = duckdb.connect()
    con.register("pages", df.toPandas())
    assert {r[0]: r[4] for r in con.sql(url_filter.oracle_sql()).fetchall()} == got


def test_explicit_allow_precedence(spark):
    rows = [(1, "http://x.com/1", '<link rel=canonical href="http://m.org/fr/a">'), (2, "http://m.org/fr/a", None),
            (3, "http://y.com/1", None), (4, "http://k.net/", None)]
    more = spark.createDataFrame([("http://x.com/1", "http://k.net/"), ("http://y.com/1", "http://k.net/z")], "from_url string, to_url string")
    got = {r["page_id"]: r["verdict"] for r in url_filter.judge_urls(pages(spark, rows), redirects=more).collect()}
    assert got == {1: "allow", 2: "allow", 3: "block", 4: "block"}


def test_components_of_chains_stars_and_random_graphs(spark):
    rng = np.random.default_rng(8)
    edges = [(i, i + 1) for i in range(100, 160)] + [(1000, i) for i in range(1001, 1200)] + \
        [tuple(int(x) for x in rng.integers(2000, 2150, 2)) for _ in range(110)] + [(5, 5), (None, 7)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "x long, y long"), "x", "y").collect()}
    up = {}

    def top(i):
        while up.setdefault(i, i) != i:
            i = up[i]
        return i

    for a, b in edges:
        if a is not None and a != b:
            a, b = sorted((top(a), top(b)))
            up[b] = a
    assert got == {i: top(i) for i in up if top(i) != i}


# --- operators 9 and 10

VECTORS = "vec_id long, embedding array<float>, label int"


def vectors(spark, n=400, d=24, seed=4):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    x[n // 2:n // 2 + 80] = x[3] + 0.05 * rng.normal(size=(80, d))      # a dense group
    x[-40:] = x[7]                                                      # copies
    rows = [(i, [float(np.float32(c)) for c in v], int(i % 3) if i < n // 2 else 1) for i, v in enumerate(x)]
    odd = [(900, None, 1), (1000, [0.0] * d, 1), (1100, [float("nan")] + [1.0] * (d - 1), 1), (1200, [float("inf")] * d, 1),
           (1300, [None] + [1.0] * (d - 1), 1), (1400, [1.0] * (d - 1), 1), (1500, [], 1), (None, rows[3][1], 1), (1600, rows[3][1], None),
           rows[7], (1700, rows[7][1], 1)]
    return spark.createDataFrame(rows + odd, VECTORS), rows + odd


def good(v):
    return bool(v) and all(c is not None and np.isfinite(c) for c in v) and any(v)


@pytest.mark.parametrize("shard,block", [(16_384, 512), (100, 3)])
def test_nearest_recall_and_scores(spark, shard, block):
    df, rows = vectors(spark)
    got = ann.nearest(clash(df), F.col("vec_id") % 100 == 0, shard=shard, block=block).collect()
    rows = [(i, np.array(v, float)) for i, v, _ in rows if good(v) and i is not None]
    hit = all_ = 0
    for q, (i, v) in enumerate(rows):
        if i % 100:
            continue
        near = sorted((float(np.sqrt(((w - v) ** 2).sum())), j) for p, (j, w) in enumerate(rows) if p != q and len(w) == len(v))[:10]
        mine = sorted((r["rank"], r["score"], r["vec_id"]) for r in got if r["query_id"] == i)
        assert [r for r, *_ in mine] == list(range(1, len(near) + 1))
        assert [x[1:] for x in mine] == sorted(x[1:] for x in mine)
        exact = {(j, round(float(np.sqrt(((w - v) ** 2).sum())), 9)) for j, w in rows if len(w) == len(v)}
        assert all((j, round(s, 9)) in exact for _, s, j in mine)
        hit += len({j for _, j in near} & {j for *_, j in mine})
        all_ += len(near)
    assert hit / all_ >= 0.9


def test_every_query_survives_pruning(spark):
    """Each registered query under count() and a selection of one column: plans that need
    fewer columns give as many rows."""
    from ledgerlens.llm import queries
    for name, query in queries.QUERIES.items():
        df = query(spark, "/root/testdata/sf0.001")
        n = len(df.collect())
        assert df.count() == n and len(df.select(df.columns[-1]).collect()) == n, name


def test_nearest_few_rows(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0], 1), (1, [0.0, 1.0], 1), (2, [0.0, 1.0], 1)], VECTORS)
    got = [(r["query_id"], r["rank"], r["vec_id"]) for r in ann.nearest(df, F.col("vec_id") == 0).orderBy("rank").collect()]
    assert got == [(0, 1, 1), (0, 2, 2)]
    assert ann.nearest(df, F.col("vec_id") == 9).collect() == []
    assert ann.nearest(spark.createDataFrame([], VECTORS), F.col("vec_id") == 0).collect() == []


@pytest.mark.parametrize("block", [2048, 16])
def test_embedding_links_against_brute_force(spark, block):
    df, rows = vectors(spark)
    got = embed_dedup.near_duplicate_vectors(clash(df), block=block).collect()
    n = len(rows)
    unit = [np.array(v, float) / np.linalg.norm(v) if good(v) and lab is not None else None for _, v, lab in rows]
    near = [[j for j in range(n) if j != i and unit[i] is not None and unit[j] is not None and rows[i][2] == rows[j][2]
             and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.98] for i in range(n)]
    want = []
    for i in range(n):
        seen, queue = {i}, [i]
        while queue:
            for j in near[queue.pop()]:
                if j not in seen:
                    seen.add(j)
                    queue.append(j)
        least = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        want.append((str(rows[i][0]), str(len(near[i])), str(least), str(rows[i][0] == least)))
    assert rows_of(spark.createDataFrame(got)) == sorted(want)
    assert embed_dedup.near_duplicate_vectors(spark.createDataFrame([], VECTORS)).collect() == []


@pytest.mark.parametrize("tables,hashes", [embed_dedup.widths(n) for n in (10**6, 10**9, 10**11)])
def test_multiprobe_keeps_close_pairs(tables, hashes):
    """Pairs at the threshold meet in some table but for a very few in a million, with the
    widths of any number of vectors."""
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = rng.normal(size=x.shape)
    z -= (z * x).sum(axis=1, keepdims=True) * x
    y = 0.98 * x + (1 - 0.98 ** 2) ** 0.5 * z / np.linalg.norm(z, axis=1, keepdims=True)
    codes = np.concatenate([embed_dedup.hash_codes(x, tables, hashes, 2, 10), embed_dedup.hash_codes(y, tables, hashes, 2, 10)])
    a, b = np.arange(3000), np.arange(3000, 6000)
    met = np.stack([embed_dedup.meets(codes, a, b, t) for t in range(tables)])
    assert met.any(axis=0).all() and (1 - met.mean()) ** tables < 5e-6
