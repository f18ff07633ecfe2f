"""Operator 7: URL filters with redirect equivalence. DataFrame functions only.

Rules block or allow a host (its subdomains too) and a path prefix; the longest rule
that fits decides. Pages that redirect to, or name as canonical, another address are
aliases: connected components over these links, both ways, are classes of one
resource. A block of any member holds for every member without a rule of its own,
unless some member is explicitly allowed (explicit allow precedence). Pages that
neither rules nor aliases decide are allowed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, cut
from .graph import connected_components

#: The production rules, (host, path) and verdict.
RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]
# Patterns that Java and RE2 read alike.
HOST = r"(?s)^.*?://([^/?#]*)"
PATH = r"(?s)^.*?://[^/?#]*([^?#]*)"
KEY = r"(?s)^.*?://[^/?#]*([^#]*)"
# Tags as Java reads them: to the first > outside quotes or, if a quote stays open, to the first >.
LINK = r"(?i)<link\s(?:[^\"'>]++|\"[^\"]*\"|'[^']*')*+>|<link\s[^>]*>"
META = r"(?i)<meta\s(?:[^\"'>]++|\"[^\"]*\"|'[^']*')*+>|<meta\s[^>]*>"
PAIR = r"([a-zA-Z-]+)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\"'\s>]+)"
#: For the oracle: the inside of a tag up to the first > outside quotes.
OUTSIDE = r"(?s)^((?:[^\"'>]|\"[^\"]*\"|'[^']*')*)>"
GOES_TO = r"(?i)url\s*=\s*[\"']?([^\"'\s>]+)"


def host(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, HOST, 1)), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PATH, 1), F.lit(""))


def address(url: Column) -> Column:
    """A node of the alias graph: host, path and query; null without ``://``."""
    return F.when(F.contains(url, F.lit("://")), F.concat(host(url), F.regexp_extract(url, KEY, 1)))


def fitting_rule(h: Column, p: Column, rules) -> Column:
    """struct(rule, verdict) of the longest rule that fits, else null. ``rules`` is a
    list given by the caller, so its size is known when the plan is made."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rh, rp, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((h == rh) | F.endswith(h, F.lit("." + rh))) & F.startswith(p, F.lit(rp))
        out = F.when(fits, F.struct(F.lit(rh + rp).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def attribute(tag: Column, name: str) -> Column:
    """The value of a tag's first attribute of that name, without its quotes and the space
    around it; null without one."""
    names = F.transform(F.regexp_extract_all(tag, F.lit(PAIR), F.lit(1)), F.lower)
    value = F.get(F.regexp_extract_all(tag, F.lit(PAIR), F.lit(2)), (F.array_position(names, name) - 1).cast("int"))
    return F.trim(F.translate(value, "\"'\t\n\r\f", "      "))


def alias_links(pages: DataFrame, url_col: str, html_col: str) -> DataFrame:
    """(a, b): addresses joined by refresh redirects or canonical links in the whole html,
    all of them; ``canonical`` may be any word of rel, and a tag without a target is
    none. A target without ``://`` is taken relative to the page: ``//host/...``,
    ``/path``, or beside the page's path."""
    html, url = F.col(html_col), F.col(url_col)

    def tags(pattern):
        return F.regexp_extract_all(html, F.lit(pattern), F.lit(0))

    canonical = F.filter(tags(LINK), lambda x: F.array_contains(F.split(F.lower(attribute(x, "rel")), r"\s+"), "canonical"))
    refresh = F.filter(tags(META), lambda x: F.lower(attribute(x, "http-equiv")) == "refresh")
    targets = F.concat(F.transform(canonical, lambda x: attribute(x, "href")),
                       F.transform(refresh, lambda x: F.regexp_extract(attribute(x, "content"), GOES_TO, 1)))
    t = F.replace(F.col("t"), F.lit("&amp;"), F.lit("&"))
    base = F.concat(F.lit("http://"), host(url))
    full = (F.when(F.contains(t, F.lit("://")), t).when(F.startswith(t, F.lit("//")), F.concat(F.lit("http:"), t))
            .when(F.startswith(t, F.lit("/")), F.concat(base, t))
            .otherwise(F.concat(base, F.regexp_replace(path(url), "[^/]*$", ""), t)))
    return (pages.filter(F.contains(url, F.lit("://")) & html.rlike("(?i)canonical|refresh"))
            .select(url, F.explode(targets).alias("t")).filter("t <> ''")
            .select(address(url).alias("a"), address(full).alias("b")).filter("a <> b").distinct())


def judge_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
               rules=RULES, redirects: DataFrame | None = None) -> DataFrame:
    """One row per row of ``pages``: id, host, path, rule (null if none fits), verdict.

    ``redirects`` may add known (from_url, to_url) pairs. Null urls and urls without
    ``://`` have empty host and path and no aliases. Null html has no links. Repeated
    rows and null ids keep a row each; an empty table gives an empty result; other
    columns are ignored."""
    rows = pages.select(F.col(id_col).alias("id"), host(F.col(url_col)).alias("host"), path(F.col(url_col)).alias("path"),
                        address(F.col(url_col)).alias("node"))
    rows = rows.withColumn("own", fitting_rule(F.col("host"), F.col("path"), rules))
    links = alias_links(pages, url_col, html_col)
    if redirects is not None:
        links = links.unionByName(redirects.select(address(F.col("from_url")).alias("a"), address(F.col("to_url")).alias("b")))
    of = connected_components(links, "a", "b")
    member = cut(of.unionByName(of.select(F.col("root").alias("node"), "root").distinct()))
    # a member's own rule follows from its address, whether or not a page has it
    a_host = F.regexp_extract("node", "^[^/?#]*", 0)
    a_path = F.regexp_extract("node", r"^[^/?#]*([^?#]*)", 1)
    verdict = fitting_rule(a_host, a_path, rules)["verdict"]
    blocked = member.groupBy("root").agg(F.max(F.coalesce(verdict == "block", F.lit(False))).alias("block"),
                                         F.max(F.coalesce(verdict == "allow", F.lit(False))).alias("allow")) \
        .filter("block and not allow").select("root")
    by_alias = member.join(blocked, "root").select(F.col("node").alias("alias"))
    out = rows.join(by_alias, rows["node"] == by_alias["alias"], "left")
    return out.select(F.col("id").alias(id_col), "host", "path", F.col("own.rule").alias("rule"),
                      F.coalesce("own.verdict", F.when(F.col("alias").isNotNull(), F.lit("block")), F.lit("allow")).alias("verdict"))


def oracle_sql() -> str:
    """The same verdicts as DuckDB SQL; reachability by a recursive query."""
    def q(s):
        return "'" + s.replace("'", "''") + "'"

    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

    def host_of(u):
        return "coalesce(" + lower.format(f"regexp_extract({u}, {q(HOST)}, 1)") + ", '')"

    def address_of(u):
        return f"CASE WHEN contains({u}, '://') THEN {host_of(u)} || regexp_extract({u}, {q(KEY)}, 1) END"

    def rule(h, p, what):
        cases = [f"WHEN ({h} = {q(rh)} OR ends_with({h}, {q('.' + rh)})) AND starts_with({p}, {q(rp)}) THEN {q(rh + rp if what == 'rule' else v)}"
                 for rh, rp, v in sorted(RULES, key=lambda r: -len(r[0] + r[1]))]
        return "CASE " + " ".join(cases) + " END"

    base = f"'http://' || {host_of('url')}"
    path_of = f"coalesce(regexp_extract(url, {q(PATH)}, 1), '')"
    # tags by splitting the text at <, attributes by splitting the tag at =: no pattern in common with the query's
    return f"""
WITH RECURSIVE piece AS (
  SELECT url, unnest(string_split(html, '<')[2:]) AS x FROM pages WHERE contains(url, '://')),
piece2 AS (
  SELECT url, lower(regexp_extract(x, '^[a-zA-Z]+', 0)) AS name, regexp_replace(x, '^[a-zA-Z]+', '') AS x FROM piece
  WHERE lower(x[1:4]) IN ('link', 'meta')),
tag AS (
  SELECT url, name, CASE WHEN regexp_matches(x, {q(OUTSIDE)}) THEN regexp_extract(x, {q(OUTSIDE)}, 1) ELSE string_split(x, '>')[1] END AS x
  FROM piece2 WHERE contains(x, '>') AND regexp_matches(x, '^\\s')),
att AS (
  SELECT url, name, regexp_extract_all(x, {q(PAIR)}, 1) AS k, regexp_extract_all(x, {q(PAIR)}, 2) AS v FROM tag),
held AS (
  SELECT url, name, map_from_entries(list_filter(list_zip(list_transform(k, lambda y: lower(y)), list_transform(v, lambda y: trim(translate(y, chr(34) || chr(39) || chr(9) || chr(10) || chr(13) || chr(12), '      ')))),
                                                 lambda e, n: list_position(list_transform(k, lambda y: lower(y)), e[1]) = n)) AS m FROM att),
found AS (
  SELECT url, coalesce(m['href'], '') AS t0 FROM held
  WHERE name = 'link' AND list_contains(regexp_split_to_array(lower(coalesce(m['rel'], '')), '\\s+'), 'canonical')
  UNION ALL
  SELECT url, regexp_extract(coalesce(m['content'], ''), {q(GOES_TO)}, 1) AS t0 FROM held
  WHERE name = 'meta' AND lower(coalesce(m['http-equiv'], '')) = 'refresh'),
target AS (SELECT url, replace(t0, '&amp;', '&') AS t FROM found WHERE t0 <> ''),
full_target AS (
  SELECT url, CASE WHEN contains(t, '://') THEN t WHEN starts_with(t, '//') THEN 'http:' || t
                   WHEN starts_with(t, '/') THEN {base} || t
                   ELSE {base} || regexp_replace({path_of}, '[^/]*$', '') || t END AS t FROM target),
link AS (SELECT DISTINCT {address_of('url')} AS a, {address_of('t')} AS b FROM full_target),
edge AS (SELECT a, b FROM link WHERE a <> b UNION SELECT b, a FROM link WHERE a <> b),
reach(a, b) AS (SELECT a, a FROM edge UNION SELECT r.a, e.b FROM reach r JOIN edge e ON r.b = e.a),
member AS (SELECT a, regexp_extract(b, '^[^/?#]*', 0) AS h, regexp_extract(b, '^[^/?#]*([^?#]*)', 1) AS p FROM reach),
alias AS (SELECT a FROM member GROUP BY a
          HAVING bool_or(coalesce({rule('h', 'p', 'verdict')} = 'block', false))
             AND NOT bool_or(coalesce({rule('h', 'p', 'verdict')} = 'allow', false))),
page AS (SELECT page_id, {host_of('url')} AS host, {path_of} AS path, {address_of('url')} AS node FROM pages)
SELECT page_id, host, path, {rule('host', 'path', 'rule')} AS rule,
       coalesce({rule('host', 'path', 'verdict')}, CASE WHEN node IN (SELECT a FROM alias) THEN 'block' END, 'allow') AS verdict
FROM page"""
