"""Operator 5: main text of web pages by consensus of a host's container paths.

Every page's containers (body, div, section, article, ...) are scored by the prose
and the boilerplate below them. A container's generalised tag-class path has no
positions, ids or digits, so that the pages of a host share it; it is kept as a hash
of its parent's path and its own label, so deep markup costs no more than flat. In
Spark each page votes for its good paths; the path with most votes of a host wins, and
the page is extracted again from all containers on that path. A page without such a
container (or without text in it) falls back to its own best one.

Elements, roles and hidden parts that are boilerplate are never read. A class or id name
only makes its part of the page doubtful (a layout may be called "sidebar-right" for what
stands beside the article): such a part is read, and dropped when the page is known,
unless it holds the page's article, or most of its prose where articles hold little, or
nothing would be left. What readers and advertisers write is never spared.
"""

from __future__ import annotations

import hashlib
import re
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, text_batches
from .url_filter import host

# Element and class names.
CONTAINERS = frozenset("body div section article main td center".split())
BLOCKS = CONTAINERS | frozenset(
    "address aside blockquote br caption dd details dialog dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr html legend li menu nav ol optgroup option p pre summary table tbody tfoot thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp".split())
BOILERPLATE = frozenset(
    "aside button canvas datalist dialog footer form head header iframe menu nav noembed noframes noscript object script "
    "select style svg template textarea title".split())
CLOSES_P = BLOCKS - {"br", "option", "optgroup", "title", "html", "body"}
SAME_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
             "th": {"td", "th"}, "option": {"option"}}
SAME_WITHIN = frozenset("ul ol dl table menu select".split())
NEGATIVE = frozenset(
    "ad ads adv advert advertisement adverts advertising alert aside banner breadcrumb breadcrumbs comment comments consent "
    "cookie cookies disqus dialog footer gdpr header hidden login masthead menu modal nav navbar navigation newsletter notice "
    "notification overlay pager pagination popup promo promoted promotion recommended related replies reply respond share "
    "sharing sidebar signup skip social sponsor sponsored subscribe toolbar widget".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
POSITIVE = frozenset("article body content entry main post prose story text".split())
KEPT = frozenset("html body main".split())
#: An article is dropped only for these (a reader's comment, a teaser), not for the others.
NEGATIVE_ARTICLE = frozenset("ad ads advert advertisement comment comments promo related recommended replies reply sponsored".split())
#: Names of what readers and advertisers write: never spared for being long.
NEVER_SPARED = frozenset("ad ads adv advert advertisement adverts advertising comment comments consent cookie cookies disqus gdpr promoted "
                         "replies reply respond sponsor sponsored".split())
#: Class names that tell of something else on the page.
ABOUT = re.compile(r"(?:has|with|no|is|js)-")

PART_ROWS = 100_000     # pages of a part that a hot host is dealt to, and at least LEAST_PARTS parts
LEAST_PARTS = 64

TAG = re.compile(r"<!--|<[!?]|<(/?)([a-zA-Z][^\s/>]*)")
REST = re.compile(r"""[^>"']*+(?:"[^"]*"[^>"']*+|'[^']*'[^>"']*+)*+>""")
ATTR = re.compile(r"""(?i)\b(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
WORD = re.compile(r"[a-z]+")


def _attributes(raw: str) -> dict[str, str]:
    out: dict[str, str] = {}
    if "=" in raw or "hidden" in raw.lower():
        for m in ATTR.finditer(raw):
            out.setdefault(m[1].lower(), (m[2] or "").strip("\"'").lower())
    return out


READ, DOUBTFUL, NEVER, SKIPPED = range(4)


def _kind(tag: str, at: dict[str, str]) -> int:
    """READ; DOUBTFUL or NEVER (spared) by its class or id names; SKIPPED for certain."""
    if tag in BOILERPLATE:
        return SKIPPED
    if tag in KEPT or not at:
        return READ
    if "hidden" in at or at.get("aria-hidden") == "true" or at.get("role") in ROLES \
            or "display:none" in at.get("style", "").replace(" ", ""):
        return SKIPPED
    bad = NEGATIVE_ARTICLE if tag == "article" else NEGATIVE
    names = {w for k in ("class", "id") for name in at.get(k, "").split() if not ABOUT.match(name) for w in WORD.findall(name)} & bad
    return READ if not names else NEVER if names & NEVER_SPARED or tag == "article" else DOUBTFUL


def _label(tag: str, at: dict[str, str]) -> str:
    names = sorted({re.sub(r"[\d]+", "#", c) for c in at.get("class", "").split()})
    return ".".join([tag, *names])


class Page:
    """``blocks``: the texts outside boilerplate in page order; ``kept``: which of them
    stay. ``containers``: [path, weight, prose, boilerplate, first block, end of blocks,
    depth, parent], the document itself first; prose and boilerplate count characters
    below it."""

    def __init__(self, html: str):
        self.blocks: list[str] = []
        self.containers = [["", 0.7, 0, 0, 0, 0, 0, -1]]
        self._paths = [("", "")]                        # of a container: parent's path, label
        self._facts: list[tuple[int, int, int, bool]] = []      # of a block: container, prose, links, in an article
        self._regions: list[list] = []                  # doubtful parts: first block, end, kind, region around
        self._text: list[str] = []
        self._linked = 0
        self._open: list[tuple[str, int, bool, int, int]] = []  # tag, container or -1, skipped, region or -1, article depth outside
        self._inside = [0]                              # open containers
        self._around = [-1]                             # open regions
        self._skip = self._link = self._article = 0
        self._read(html)
        self._flush()
        while self._open:
            self._pop()
        self.containers[0][5] = len(self.blocks)
        self.kept = self._decide()
        self._add_up()

    def _decide(self) -> list[bool]:
        """Which blocks stay: doubtful parts go unless they hold at least half of the prose in
        the page's articles, or (of those that may be spared) of all prose; a page that
        would be empty is read without this rule."""
        kept = [True] * len(self.blocks)
        if not self._regions:
            return kept
        own = [True] * len(self.blocks)         # outside parts that are never spared
        for first, end, kind, _ in self._regions:
            if kind == NEVER:
                own[first:end] = [False] * (end - first)
        prose, articles = [0], [0]              # running sums
        for ok, (_, good, _, inside) in zip(own, self._facts):
            prose.append(prose[-1] + good * ok)
            articles.append(articles[-1] + good * (ok and inside))
        gone: list[bool] = []
        for first, end, kind, around in self._regions:
            held = articles[end] - articles[first]
            much = prose[end] - prose[first]
            spared = kind == DOUBTFUL and (held > 0 and 2 * held >= articles[-1]
                                           or much > 0 and 2 * much >= prose[-1] and 4 * articles[-1] < prose[-1])
            gone.append(not spared or (around >= 0 and gone[around]))
            if gone[-1]:
                kept[first:end] = [False] * (end - first)
        return kept if any(kept) else own

    def _add_up(self) -> None:
        """Prose and boilerplate of every container, the deepest first."""
        for ok, (c, good, linked, _) in zip(self.kept, self._facts):
            self.containers[c][2] += good * ok
            self.containers[c][3] += linked if ok else good + linked
        for c in self.containers[:0:-1]:
            up = self.containers[c[7]]
            up[2] += c[2]
            up[3] += c[3]

    def _flush(self) -> None:
        s = " ".join("".join(self._text).split())
        if s:
            linked = min(self._linked, len(s))
            self._facts.append((self._inside[-1], len(s) - linked, linked, self._article > 0))
            self.blocks.append(s)
        self._text, self._linked = [], 0

    def _words(self, raw: str) -> None:
        if not raw:
            return
        if self._skip:
            self.containers[self._inside[-1]][3] += len(raw)
            return
        s = unescape(raw) if "&" in raw else raw
        self._text.append(s)
        if self._link:
            self._linked += len(s.strip())

    def _pop(self) -> None:
        tag, c, skip, region, article = self._open.pop()
        if tag in BLOCKS:
            self._flush()
        if tag == "a":
            self._link -= 1
        self._skip -= skip
        if region >= 0 and tag not in BLOCKS:
            self._flush()
        self._article = article
        if c >= 0:
            self._inside.pop()
            self.containers[c][5] = len(self.blocks)
        if region >= 0:
            self._around.pop()
            self._regions[region][1] = len(self.blocks)

    def _close(self, tags, stop=frozenset()) -> bool:
        """Closes the innermost open element of ``tags``, unless one of ``stop`` is inside."""
        for i in range(len(self._open) - 1, -1, -1):
            t = self._open[i][0]
            if t in tags:
                while len(self._open) > i:
                    self._pop()
                return True
            if t in stop:
                return False
        return False

    def _start(self, tag: str, raw: str) -> None:
        if tag in BLOCKS:
            if not self._skip:
                self._flush()
            if tag in CLOSES_P:
                self._close({"p"}, CONTAINERS | SAME_WITHIN | {"li", "blockquote", "th"})
            if tag in SAME_ENDS:
                self._close(SAME_ENDS[tag], SAME_WITHIN)
        elif tag == "th":
            self._close(SAME_ENDS["th"], SAME_WITHIN)
        if tag in ("td", "th") and not self._skip:
            self._text.append(" ")
        if tag in VOID or (raw.endswith("/") and tag not in BLOCKS):
            return
        at = _attributes(raw)
        kind = _kind(tag, at)
        skip, c, region, article = kind == SKIPPED, -1, -1, self._article
        if kind in (DOUBTFUL, NEVER) and not self._skip:
            self._flush()
            region = len(self._regions)
            self._regions.append([len(self.blocks), 0, kind, self._around[-1]])
            self._around.append(region)
            if kind == NEVER:
                self._article = 0
        elif tag in ("article", "main") and not skip and not self._skip:
            self._article += 1
        if tag in CONTAINERS and not self._skip and not skip:
            up = self._inside[-1]
            base, label = self.containers[up][0], _label(tag, at)
            above, last = self._paths[up]
            if last == label + "+":             # one of a run of equal labels: the run's path
                self._paths.append((above, last))
            elif last == label:
                self._paths.append((above, label + "+"))
            else:
                self._paths.append((base, label))
            path = hashlib.blake2b(">".join(self._paths[-1]).encode("utf-8", "replace"), digest_size=10).hexdigest()
            words = {w for k in ("class", "id") for w in WORD.findall(at.get(k, ""))}
            weight = 0.8 if tag == "body" else 1.25 if tag in ("article", "main") else 1.15 if words & POSITIVE else 1.0
            c = len(self.containers)
            self.containers.append([path, weight, 0, 0, len(self.blocks), 0, len(self._inside), up])
            self._inside.append(c)
        self._open.append((tag, c, skip, region, article))
        self._skip += skip
        self._link += tag == "a"

    def _read(self, html: str) -> None:
        at, n = 0, len(html)
        while True:
            m = TAG.search(html, at)
            if not m:
                self._words(html[at:])
                return
            self._words(html[at:m.start()])
            if not m[2]:        # a comment or declaration
                end = "-->" if m[0] == "<!--" else ">"
                to = html.find(end, m.end())
                if to < 0:
                    return
                at = to + len(end)
                continue
            rest = REST.match(html, m.end())
            if rest:
                raw, at = html[m.end():rest.end() - 1], rest.end()
            else:               # an open quote: up to the next >; a tag cut off at the end is dropped
                to = html.find(">", m.end())
                if to < 0:
                    return
                raw, at = html[m.end():to], to + 1
            tag = m[2].lower()
            if m[1]:
                if tag == "br":
                    self._start("br", "")
                elif tag == "p" and not any(x[0] == "p" for x in self._open):
                    self._flush()
                else:
                    self._close({tag}, frozenset() if tag in BLOCKS else CONTAINERS)
                continue
            self._start(tag, raw)
            if tag in RAW:
                to = re.compile(f"</{tag}", re.I).search(html, at)
                if not to:
                    return
                at = to.start()

    def scores(self) -> list[float]:
        return [w * (good - 0.5 * bad) for _, w, good, bad, *_ in self.containers]

    def best(self) -> int:
        s = self.scores()
        return max(range(len(s)), key=lambda i: (s[i], self.containers[i][6], -i))

    def votes(self) -> dict[str, tuple[int, float]]:
        """(depth, share of one page's vote) for each path that scores at least half the best."""
        by: dict[str, float] = {}
        depth: dict[str, int] = {}
        for c, s in zip(self.containers, self.scores()):
            by[c[0]] = by.get(c[0], 0.0) + max(s, 0.0)
            depth.setdefault(c[0], c[6])
        top = max(by.values())
        return {p: (depth[p], s / top) for p, s in by.items() if top > 0 and s >= 0.5 * top}

    def text(self, path: str | None) -> str:
        spans = [(c[4], c[5]) for c in self.containers if c[0] == path]
        out, done = [], 0
        for a, b in spans:
            out += self._between(max(a, done), b)
            done = max(done, b)
        if not out:
            c = self.containers[self.best()]
            out = self._between(c[4], c[5])
        return "\n".join(out)

    def _between(self, a: int, b: int) -> list[str]:
        return [x for x, ok in zip(self.blocks[a:b], self.kept[a:b]) if ok]


def host_paths(pages: DataFrame, url_col: str, html_col: str) -> DataFrame:
    """(host, path): each host's path with most votes, ties to the one nearest the root,
    then by hash."""
    def run(batches):
        for b in batches:
            rows = [(h, p, d, v) for h, x in zip(b["host"], b["html"]) if x for p, (d, v) in Page(x).votes().items()]
            yield pd.DataFrame(rows, columns=["host", "path", "depth", "vote"])

    votes = pages.select(host(F.col(url_col)).alias("host"), F.col(html_col).alias("html")) \
        .mapInPandas(run, "host string, path string, depth long, vote double")
    # in whole thousandths, so that the order of summing can't change a winner
    return votes.groupBy("host", "path").agg(F.sum(F.round(F.col("vote") * 1000).cast("long")).alias("n"), F.min("depth").alias("depth")) \
        .groupBy("host").agg(F.min_by("path", F.struct(-F.col("n"), "depth", "path")).alias("path"))


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
              broadcast_mb: float = 8.0) -> DataFrame:
    """One row per row of ``pages``: id, url, text, n_chars (code points).

    Whole html; null and empty html give an empty text. Null urls share the empty
    host. Unclosed, misnested and cut-off markup is read as far as it goes. Repeated
    rows and null ids keep a row each; an empty table gives an empty result; other
    columns are ignored.

    Votes are summed before they are shuffled. Winning paths of at most ``broadcast_mb``
    (measured) go to every task, so that no html moves; beyond that, pages join them by
    host and salt, which spreads a hot host."""
    @F.pandas_udf("string")
    def extract(html: pd.Series, path: pd.Series) -> pd.Series:
        return pd.Series([Page(h).text(p) if h else "" for h, p in zip(html, path)], dtype=object)

    best = cut(host_paths(text_batches(pages), url_col, html_col))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"),
                        host(F.col(url_col)).alias("host"))
    size = best.agg(F.sum(F.octet_length("host") + F.octet_length("path") + 32)).first()[0] or 0
    if size <= broadcast_mb * 1e6:
        rows = rows.join(F.broadcast(best), "host", "left")
    else:
        hottest = rows.groupBy("host").count().agg(F.max("count")).first()[0] or 0
        parts = max(LEAST_PARTS, -(-hottest // PART_ROWS))
        spread = best.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
        rows = rows.withColumn("salt", F.pmod(F.xxhash64("id", "html"), F.lit(parts)).cast("int")).join(spread, ["host", "salt"], "left")
    return rows.select(F.col("id").alias(id_col), F.col("url").alias(url_col),
                                                  extract("html", "path").alias("text")) \
        .withColumn("n_chars", F.length("text").cast("long"))
