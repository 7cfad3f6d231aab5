"""URL rules with decisions carried over to aliases. DataFrame functions only.

A rule (host, path, verdict) fits a page when its host is the page's or a domain above it, and the page's
path starts with the rule's; the longest rule wins, a block among equals. Pages without a rule take the
verdict of their aliases, the connected components of a graph over addresses, found by alternating stars.
Its edges are: a url and the plain form of its address (without scheme, ``www.``, closing slash, tracking
parameters and fragment), canonical links and redirects of the pages' HTML, and redirects that were
observed elsewhere. In a component an explicit allow wins over any block, a block over nothing; a page
that nothing reaches gets ``DEFAULT``.

Targets are resolved as a browser does it: against the page's path, with ``.`` and ``..`` taken out, a
target of a query alone on the page's path. Urls are made distinct before anything is joined, and joined
sides are written first where one address may have very many pages, so adaptive execution can split it.
Addresses are nodes by their 128-bit hash.

Nulls: a null url has an empty host and path and no aliases; null HTML has no links; a redirect with a null
or relative end is left out. Repeated rows are judged one by one. Other columns are ignored. An empty table
gives an empty result; without rules every page gets ``DEFAULT``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gustline.llm.components import components
from gustline.session import stage

DEFAULT = "allow"
BROADCAST_RULES = 100_000  # rules sent to all tasks at most; more are joined by a shuffle
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^(.*?)://([^/?#]*)([^?#]*)(\?[^#]*)?"
_CANONICAL = r"""(?is)<link\b[^>]*\brel\s*=\s*["']?canonical\b[^>]*>"""
_HREF = r"""(?is)\bhref\s*=\s*["']?([^"'\s>]+)"""
_REFRESH = r"""(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["']?refresh\b[^>]*>"""
_TARGET = r"""(?is)\burl\s*=\s*["']?([^"'\s>]+)"""
_TRACKING = r"(^|&)(utm_[^=&]*|ref|fbclid|gclid)(=[^&]*)?(?=&|$)"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 3), F.lit(""))


def address(url: Column) -> Column:
    """One form for all addresses that differ in scheme, ``www.``, closing slash, tracking or fragment."""
    query = F.regexp_replace(F.regexp_replace(F.substring(F.regexp_extract(url, _PARTS, 4), 2, 1 << 30), _TRACKING, ""), "^&+", "")
    path = F.regexp_replace(path_of(url), "/$", "")
    whole = F.concat(F.regexp_replace(host_of(url), r"^www\.", ""), path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))
    return F.when(host_of(url) != "", whole)


def _links(html: Column) -> Column:
    """Targets of canonical links and redirects, as written."""

    def targets(tag: str, inner: str) -> Column:
        found = F.transform(F.regexp_extract_all(html, F.lit(tag), F.lit(0)), lambda t: F.regexp_extract(t, inner, 1))
        return F.when(html.rlike(tag), found).otherwise(F.array().cast("array<string>"))

    return F.filter(F.concat(targets(_CANONICAL, _HREF), targets(_REFRESH, _TARGET)), lambda t: t != "")


def _without_dots(path: Column) -> Column:
    """The path with its ``.`` and ``..`` taken out."""
    parts = F.split(F.substring(path, 2, 1 << 30), "/", -1)
    none = F.array().cast("array<string>")
    above = lambda kept: F.when(F.size(kept) > 0, F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(0)))).otherwise(kept)
    step = lambda kept, part: F.when(part == ".", kept).when(part == "..", above(kept)).otherwise(F.concat(kept, F.array(part)))
    closed = F.when(F.element_at(parts, -1).isin(".", ".."), F.concat(F.aggregate(parts, none, step), F.array(F.lit(""))))
    whole = F.concat(F.lit("/"), F.array_join(F.coalesce(closed, F.aggregate(parts, none, step)), "/"))
    return F.when(path.rlike(r"/\.\.?(/|$)"), whole).otherwise(path)


def resolved(target: Column, url: Column) -> Column:
    """Whole address of a target that stands on the page ``url``."""
    scheme = F.regexp_extract(url, _PARTS, 1)
    origin = F.concat(scheme, F.lit("://"), host_of(url))
    own = F.when(path_of(url) == "", "/").otherwise(path_of(url))
    whole = (
        F.when(target.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), target)
        .when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
        .when(target.startswith("/"), F.concat(origin, target))
        .when(target.startswith("?"), F.concat(origin, own, target))
        .when(target.startswith("#"), url)
        .otherwise(F.concat(origin, F.regexp_replace(own, "[^/]*$", ""), target))
    )
    rest = F.regexp_extract(whole, r"(?s)^.*?://[^/?#]*[^?#]*(.*)$", 1)
    return F.concat(F.regexp_extract(whole, r"(?s)^(.*?://[^/?#]*)", 1), _without_dots(path_of(whole)), rest)


def apply_rules(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """(key, rule, said) of the pages (key, host, path) that a rule fits."""
    rules = rules.select(F.col("host").alias("rule_host"), F.col("path").alias("rule_path"), "verdict").distinct()
    if rules.count() <= BROADCAST_RULES:
        rules = F.broadcast(rules)
    labels = F.split("host", r"\.", -1)
    ends = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    spread = pages.where("host <> ''").select("key", "path", F.explode(ends).alias("rule_host"))
    fits = spread.join(rules, "rule_host").where(F.col("path").startswith(F.col("rule_path")))
    rule = F.concat("rule_host", "rule_path")
    best = F.max(F.struct(F.length(rule).alias("long"), "verdict", rule.alias("rule"))).alias("best")  # block > allow
    return fits.groupBy("key").agg(best).select("key", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("said"))


def _url_node(url: Column) -> Column:
    return F.when(host_of(url) != "", F.md5(F.concat(F.lit("u"), url).cast("binary")))


def _address_node(url: Column) -> Column:
    return F.md5(F.concat(F.lit("a"), address(url)).cast("binary"))


def judge(pages: DataFrame, rules: DataFrame, redirects: DataFrame | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict, reached) of each page; ``reached`` tells whether an alias decided.

    ``pages`` has page_id, url and html, ``redirects`` url and target (whole urls), if there are any.
    """
    url = F.col("url")
    parsed = pages.select(
        F.monotonically_increasing_id().cast("string").alias("key"), "page_id", host_of(url).alias("host"), path_of(url).alias("path"),
        _url_node(url).alias("node"), _address_node(url).alias("plain"), F.transform(_links(F.col("html")), lambda t: resolved(t, url)).alias("links"),
    )
    parsed = stage(parsed, "pages")
    ends = parsed.where("node is not null").select(F.col("plain").alias("a"), F.explode("links").alias("target"))
    if redirects is not None:
        ends = ends.unionByName(redirects.select(_address_node(F.col("url")).alias("a"), "target").where("a is not null"))
        sources = redirects.select(F.col("url").alias("target"))
    target = F.col("target")

    def places(urls: DataFrame, *more: str) -> DataFrame:
        return urls.select(*more, _address_node(target).alias("b"), host_of(target).alias("host"), path_of(target).alias("path")).where("b is not null")

    linked = stage(places(ends, "a").distinct(), "page-links")
    named = linked.select("b", "host", "path")
    if redirects is not None:
        named = named.unionByName(places(sources))
    targets = named.select(F.concat(F.lit("t"), F.md5(F.concat_ws(" ", "b", "host", "path").cast("binary"))).alias("key"), "host", "path", F.col("b").alias("node")).distinct()

    told = stage(apply_rules(parsed.select("key", "host", "path").unionByName(targets.select("key", "host", "path")), rules), "rule-hits")
    forms = parsed.select(F.col("node").alias("a"), F.col("plain").alias("b")).where("a is not null").distinct()
    group = components(forms.unionByName(linked.select("a", "b")))
    group = stage(group.withColumnRenamed("node", "member"), "aliases")
    said = parsed.select("key", "node").where("node is not null").unionByName(targets.select("key", "node"))
    said = said.join(told, "key").groupBy("node").agg(F.min("said").alias("said"))  # allow < block
    placed = said.join(group, said["node"] == group["member"], "left").select("said", F.coalesce("component", "node").alias("component"))
    verdicts = placed.groupBy("component").agg(F.min("said").alias("alias_said"))
    nodes = stage(group.join(verdicts, "component").select(F.col("member").alias("node"), "alias_said"), "alias-verdicts")
    whole = parsed.join(told, "key", "left").select("page_id", "host", "path", "rule", "said", "node")
    whole = whole.join(nodes, "node", "left")
    return whole.select(
        "page_id", "host", "path", "rule", F.coalesce("said", "alias_said", F.lit(DEFAULT)).alias("verdict"),
        (F.col("said").isNull() & F.col("alias_said").isNotNull()).alias("reached"),
    )
