"""URL filters with redirect equivalence.

1. *Rules* name a host and the start of a path. A rule fits its host and all subdomains; of
   several that fit the longest wins. The rules are a short list and become part of the plan.
2. *Edges.* A page that redirects (``meta`` refresh) or names its canonical address
   (``link rel=canonical``) is an alias of the address named; a table of HTTP redirects can
   add more. The addresses are nodes, whether or not a page of theirs is in the table.
3. *Components* of the aliases are found by distributed union-find. A component is blocked
   if the rules block one of its addresses and allow none of them: an explicit allow comes
   before a block that is only passed on.
4. A page with a rule of its own follows it; any other follows its component, and is allowed
   without one.

An address is a node without its scheme and its fragment, with the host in lower case.
Only pages that hold a link of the two kinds are looked into, and only addresses with an
alias meet in a shuffle; the pages follow without their HTML.

Defined results: a NULL address, or one without ``://``, has an empty host and path, fits no
rule and has no aliases; NULL, empty and broken HTML has no links; a link to the page itself, to
another protocol or in a comment, script or style is none; the first ``href``, ``rel``,
``content`` or ``http-equiv`` of a tag counts; repeated rows are judged alike; a row whose id
is NULL is judged as any other; other columns are ignored; no pages give no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salestide.llm.components import components
from salestide.llm.rows import lower_ascii, named
from salestide.session import stored

HOST = "://([^/?#]*)"
PATH = "://[^/?#]*([^?#]*)"
QUERY = r"://[^?#]*(\?[^#]*)"
SCHEME = "^([A-Za-z][A-Za-z0-9+.-]*):"
#: Parts of a page in which tags are only text.
DEAD = r"(?is)<!--.*?(?:-->|\z)|<(?:script|style)\b.*?(?:</(?:script|style)|\z)"
TAG = r"""(?i)<(?:link|meta)[\s/](?:[^>"']|"[^"]*"|'[^']*')*+>"""
FIELD = r"""([^\s"'<>/=]+)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
REFRESH = r"""(?is)^\s*[0-9.]*\s*[;,]?\s*url\s*=\s*["']?\s*([^"']*)"""


@dataclass(frozen=True)
class Rule:
    """``path`` begins with a slash. ``verdict`` is allow or block."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    return lower_ascii(F.coalesce(F.regexp_extract(url, HOST, 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PATH, 1), F.lit(""))


def node_of(url: Column) -> Column:
    """The address as a number, the same for both schemes and any fragment."""
    query = F.coalesce(F.regexp_extract(url, QUERY, 1), F.lit(""))
    return F.when(url.contains("://"), F.xxhash64(host_of(url), path_of(url), query))


def _first_fit(host: Column, path: Column, rules: Sequence[Rule], said: str) -> Column:
    """``said`` of the longest rule that fits; NULL if none does."""
    longest = sorted(rules, key=lambda rule: (-len(rule.name), rule.name))
    found = F.lit(None).cast("string")
    for rule in reversed(longest):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.lit(getattr(rule, said))).otherwise(found)
    return found


def _field(tag: Column, name: str) -> Column:
    """The value of a tag's first field of that name, without quotes; NULL without one."""
    names = F.regexp_extract_all(tag, F.lit(FIELD), F.lit(1))
    values = F.regexp_extract_all(tag, F.lit(FIELD), F.lit(2))
    pairs = F.arrays_zip(names.alias("name"), values.alias("value"))
    value = F.get(F.filter(pairs, lambda p: F.lower(p["name"]) == name), F.lit(0))["value"]
    bare = F.regexp_replace(value, r"""^["']|["']$""", "")
    for written in ("&amp;", "&#38;", "&#x26;"):
        bare = F.replace(bare, F.lit(written), F.lit("&"))
    return F.trim(bare)


def _walked(path: Column) -> Column:
    """A path without ``.`` and ``..`` steps."""
    steps = F.split(path, "/")
    nothing = F.array().cast("array<string>")

    def walk(done: Column, step: Column) -> Column:
        up = F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))
        return F.when(step == "..", up).when(step == ".", done).otherwise(F.array_append(done, step))

    kept = F.aggregate(F.slice(steps, F.lit(2), F.size(steps)), nothing, walk)
    last = F.when(path.rlike(r"/\.\.?$"), "/").otherwise("")
    return F.concat(F.lit("/"), F.array_join(kept, "/"), F.when(F.size(kept) > 0, last).otherwise(""))


def resolved(url: Column, link: Column) -> Column:
    """The address a link of the page leads to; NULL if it leaves the web."""
    scheme = F.lower(F.regexp_extract(url, SCHEME, 1))
    base = F.concat(scheme, F.lit("://"), F.regexp_extract(url, HOST, 1))
    bare = F.regexp_replace(link, "(?s)#.*$", "")
    beside = F.regexp_replace(path_of(url), "[^/]*$", "")
    beside = F.when(beside == "", "/").otherwise(beside)
    own = F.regexp_extract(bare, r"^([^?]*)", 1)
    query = F.regexp_extract(bare, r"(?s)(\?.*)$", 1)
    web = F.lower(F.regexp_extract(bare, SCHEME, 1)).isin("http", "https") & bare.contains("://")
    return (
        F.when(web, bare)
        .when(bare.rlike(SCHEME) | (bare == ""), None)
        .when(bare.startswith("//"), F.concat(scheme, F.lit(":"), bare))
        .when(bare.startswith("?"), F.concat(base, path_of(url), bare))
        .when(bare.startswith("/"), F.concat(base, _walked(own), query))
        .otherwise(F.concat(base, _walked(F.concat(beside, own)), query))
    )


def page_links(pages: DataFrame) -> DataFrame:
    """``source, target`` for every redirect and canonical link, from ``url, html``."""
    seen = pages.filter(F.col("url").contains("://") & F.col("html").rlike("(?i)canonical|refresh"))
    alive = F.regexp_replace("html", DEAD, " ")
    tags = seen.select("url", F.explode(F.regexp_extract_all(alive, F.lit(TAG), F.lit(0))).alias("tag"))
    kind = F.lower(F.substring("tag", 2, 4))
    canonical = F.array_contains(F.split(F.lower(_field(F.col("tag"), "rel")), r"\s+"), "canonical")
    refresh = F.lower(_field(F.col("tag"), "http-equiv")) == "refresh"
    led = F.regexp_extract(_field(F.col("tag"), "content"), REFRESH, 1)
    link = F.when((kind == "link") & canonical, _field(F.col("tag"), "href"))
    link = link.when((kind == "meta") & refresh & (led != ""), F.trim(led))
    found = tags.select("url", link.alias("link")).filter("link is not null")
    found = found.select(F.col("url").alias("source"), resolved(F.col("url"), F.col("link")).alias("target"))
    return found.filter("target is not null")


def _blocked(edges: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``node`` of every address whose component the rules block and nowhere allow."""
    ends = [
        edges.select(node_of(F.col(end)).alias("node"), host_of(F.col(end)).alias("host"), path_of(F.col(end)).alias("path"))
        for end in ("source", "target")
    ]
    said = _first_fit(F.col("host"), F.col("path"), rules, "verdict")
    nodes = ends[0].unionByName(ends[1]).select("node", said.alias("said")).distinct()
    pairs = edges.select(node_of(F.col("source")).alias("a"), node_of(F.col("target")).alias("b"))
    hung = components(pairs, "a", "b").select(F.col("node").alias("_node"), "root")
    tops = nodes.join(hung, F.col("node") == F.col("_node"), "left")
    tops = stored(tops.select("node", "said", F.coalesce("root", "node").alias("top")), "aliases")
    verdicts = tops.groupBy(F.col("top").alias("_top")).agg(
        F.max(F.col("said") == "block").alias("block"), F.max(F.col("said") == "allow").alias("allow")
    )
    verdicts = stored(verdicts.filter("block and not coalesce(allow, false)").select("_top"), "blocked")
    return tops.join(verdicts, F.col("top") == F.col("_top")).select(F.col("node").alias("_node")).distinct()


def judge(
    pages: DataFrame,
    rules: Sequence[Rule],
    id: str = "page_id",
    url: str = "url",
    html: str = "html",
    redirects: DataFrame | None = None,
) -> DataFrame:
    """``id, host, path, rule, verdict`` for every page.

    ``redirects`` has addresses in its first two columns: where from, where to.
    """
    own = named(pages, id=id, url=url, html=html)
    edges = page_links(own.select("url", "html"))
    if redirects is not None:
        edges = edges.unionByName(redirects.select(*redirects.columns[:2]).toDF("source", "target"))
    whole = F.col("source").contains("://") & F.col("target").contains("://")
    other = node_of(F.col("source")) != node_of(F.col("target"))
    edges = stored(edges.filter(whole & other).distinct(), "alias-edges")
    blocked = stored(_blocked(edges, rules), "blocked-addresses")

    judged = own.select("id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), node_of(F.col("url")).alias("node"))
    name, verdict = (_first_fit(F.col("host"), F.col("path"), rules, said) for said in ("name", "verdict"))
    judged = judged.select("id", "host", "path", "node", name.alias("rule"), verdict.alias("said"))
    # Pages that ask nothing of their component need not meet at one key.
    asked = F.when(F.col("rule").isNull(), F.col("node"))
    judged = judged.withColumn("asked", F.coalesce(asked, F.xxhash64("id", "host", "path")))
    joined = judged.join(blocked, F.col("asked") == F.col("_node"), "left")
    passed_on = F.when(F.col("_node").isNotNull() & F.col("rule").isNull(), "block").otherwise("allow")
    return joined.select("id", "host", "path", "rule", F.coalesce("said", passed_on).alias("verdict"))
