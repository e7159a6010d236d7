from __future__ import annotations

import re
from urllib.parse import urljoin

import duckdb
import pytest
from pyspark.sql import functions as F

from salestide.llm import oracles, queries, url_filter
from tests.llm import plain

PAGES = [
    (1, "http://a.com/x/y.html", '<link rel="canonical" href="../z/q">'),
    (2, "https://A.com/z/q#f", '<meta http-equiv=refresh content="0; url=http://bad.net/">'),
    (3, "http://bad.net/", ""),
    # An allow anywhere in the class comes before the block that is passed on.
    (4, "http://n.org/fr/1", "<LINK HREF=http://o.com REL='Canonical x'>"),
    (5, "http://o.com", '<link rel=canonical href="http://x.net/p">'),
    (6, None, None),
    (7, "nope", "<link rel=canonical href='http://bad.net/'>"),
    (8, "http://q.com?x#y", "<!-- <link rel=canonical href='http://bad.net/'> --><script>'<link rel=canonical href=http://bad.net/>'</script>"),
    (9, "http://a.com/z/r", "<link rel=canonical href='q?a&amp;b'>"),
    (10, "http://a.com/z/q?a&b", "<meta name=x content='a>b'><link rel=canonical href=//bad.net/>"),
    (11, "http://c.com/1", "<link rel=canonical href='/2'>"),
    (12, "http://c.com/2", "<link rel=canonical href='mailto:x'><link rel=canonical href='#top'><link rel=canonical>"),
    (13, "http://d.example.com/de/", "<link rel=canonical href='http://alias.com/'>"),
    (14, "http://alias.com/", "<link rel=canonical href='http://alias.com/#x'>"),
    (15, "http://m.example.net/en/1", "<link rel=canonical href='http://m.example.net/fr/1'>"),
    (15, "http://m.example.net/en/1", "<link rel=canonical href='http://m.example.net/fr/1'>"),
    (None, "http://alias.com/", "<link " + '"' * 50_000),
    (16, "http://e.com/a/b/c", "<meta content='5;URL=\"./../../../x/./y/..\"' http-equiv=Refresh>"),
    (17, "http://e.com/x/", "<link rel='canonical' href='https://sub.e.net/'>"),
    (18, "http://foo.net", ""),
]


def judged(pages, rules, more=()):
    """Verdicts by address, with the links found by other means than the operator's."""

    def parts(url):
        found = re.match(r"(?s).*?://([^/?#]*)([^?#]*)(\?[^#]*)?", url or "")
        return (found[1].translate(plain.LOWER), found[2], found[3] or "") if found else None

    def rule(node):
        fits = [
            r for r in rules
            if node and (node[0] == r.host or node[0].endswith("." + r.host)) and node[1].startswith(r.path)
        ]
        return max(fits, key=lambda r: len(r.name), default=None)

    links = list(more)
    for _, url, html in pages:
        if not parts(url):
            continue
        html = re.sub(r"(?is)<!--.*?-->|<(script|style).*?</\1", "", html or "")
        for tag in re.findall(r"(?i)<(?:link|meta) [^>]*>", html):
            fields = {n.lower(): a or b or c for n, a, b, c in re.findall(r"([\w-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s'\">]+))", tag)}
            href = None
            if "canonical" in fields.get("rel", "").lower().split():
                href = fields.get("href")
            if fields.get("http-equiv", "").lower() == "refresh":
                href = re.sub(r"(?i)^[\d;\s]*url=|[\"']", "", fields["content"])
            if href and not href.startswith("mailto:"):
                links.append((url, urljoin(url, href.replace("&amp;", "&"))))
    nodes = {parts(x) for link in links for x in link}
    nodes |= {parts(url) for _, url, _ in pages} - {None}
    nodes = sorted(nodes)
    tops = plain.classes(len(nodes), [(nodes.index(parts(a)), nodes.index(parts(b))) for a, b in links])
    said = {}
    for node, top in zip(nodes, tops):
        if rule(node):
            said.setdefault(top, set()).add(rule(node).verdict)
    rows = []
    for id, url, _ in pages:
        node = parts(url)
        own = rule(node)
        passed = "block" if node and said.get(tops[nodes.index(node)]) == {"block"} else "allow"
        rows.append((id, *(node[:2] if node else ("", "")), own and own.name, own.verdict if own else passed))
    return sorted(rows, key=str)


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(PAGES, "page_id long, url string, html string")


def test_aliases_against_plain_classes(spark, pages):
    got = sorted(map(tuple, url_filter.judge(pages, queries.URL_RULES).collect()), key=str)
    assert got == judged(PAGES, queries.URL_RULES)
    verdicts = {row[0]: row[4] for row in got}
    assert [verdicts[k] for k in (1, 2, 9, 10, 14, 16, 17)] == ["block"] * 7
    assert [verdicts[k] for k in (4, 5, 8, 11, 15, 18)] == ["allow"] * 6


def test_given_redirects_are_edges_too(spark, pages):
    more = [("http://c.com/2", "https://deep.net/x"), ("nothing", "http://c.com/1"), (None, None)]
    given = spark.createDataFrame(more, "src string, dst string")
    got = sorted(map(tuple, url_filter.judge(pages, queries.URL_RULES, redirects=given).collect()), key=str)
    assert got == judged(PAGES, queries.URL_RULES, more[:1])
    assert {row[0]: row[4] for row in got}[11] == "block"


def test_sql_gives_the_same_rows(pages):
    frame = pages.toPandas()
    duck = duckdb.connect()
    duck.execute("CREATE TABLE pages AS SELECT page_id::BIGINT AS page_id, url, html FROM frame")
    columns = "page_id, host, path, rule, verdict"
    found = duck.execute(f"SELECT {columns} FROM ({oracles.URL_VERDICTS})").fetchall()
    assert sorted(found, key=str) == judged(PAGES, queries.URL_RULES)


def test_a_chain_and_a_ring_of_many_pages(spark):
    rows = [(k, f"http://h{k}.com/", f"<link rel=canonical href=http://h{(k + 1) % 300}.com/>") for k in range(300)]
    rows += [(300, "http://h300.com/", "<link rel=canonical href=http://h7.com/>"), (301, "http://z.net/", "<link rel=canonical href=http://h9.com/>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = url_filter.judge(pages, queries.URL_RULES).groupBy("verdict").count().collect()
    assert [tuple(row) for row in got] == [("block", 302)]


def test_no_pages_clashing_columns_and_long_pages(spark, pages):
    assert url_filter.judge(pages.limit(0), queries.URL_RULES).count() == 0
    clash = pages.withColumns({n: F.lit("x") for n in ("id", "node", "host", "path", "rule", "said", "_node", "source", "target", "verdict")})
    assert url_filter.judge(clash, queries.URL_RULES).count() == len(PAGES)
    long = [(1, "http://a.com/" + "x" * 200_000, "canonical " + "<link a=1 " * 20_000 + "<!--" * 20_000), (2, "http://a.com/", "<meta " + "a='b' " * 30_000 + "> refresh")]
    rows = url_filter.judge(spark.createDataFrame(long, "page_id long, url string, html string"), queries.URL_RULES)
    assert [r.verdict for r in rows.collect()] == ["allow", "allow"]


def test_links_are_resolved_as_the_standard_says(spark):
    base = "http://h.com/a/b/c?q#f"
    links = ["x", "./x", "../x", "../../../x", "/x/../y/", "?z", "//o.com/p/./q", "https://o.com/r?s#t", "x/..", "x/.", "/", ".", ".."]
    rows = spark.createDataFrame([(base, link) for link in links], "url string, link string")
    got = [r.to for r in rows.select(url_filter.resolved(F.col("url"), F.col("link")).alias("to")).collect()]
    assert got == [urljoin(base, link).split("#")[0] if "o.com" not in link else urljoin("http:", link).split("#")[0].replace("/./", "/./") for link in links]
