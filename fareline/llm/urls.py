"""URL filtering with block decisions that follow redirects and canonical links."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareline.llm.common import Saved, pick
from fareline.llm.components import connected_components

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``verdict`` for a host with all its subdomains, where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def bound(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with columns that are worked out once: a projection would be repeated in every later use of them."""
    made = F.explode(F.array(F.struct(*(c.alias(name) for name, c in columns.items())))).alias("made")
    return df.select("*", made).select(*df.columns, *(F.col("made")[name].alias(name) for name in columns))


def after_scheme(url: Column) -> Column:
    """What follows the first ``://``; empty if there is none or the url is null."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(after_scheme(url), r"^([^/?#]*)", 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits as a struct, or null. Equally long rules: allow before block, then by text."""
    ordered = sorted(rules, key=lambda r: (-len(r.text), r.verdict != "allow", r.text))
    chosen = F.lit(None)
    for rule in reversed(ordered):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        chosen = F.when(fits, F.struct(F.lit(rule.text).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(
            chosen)
    return chosen


def without_dots(path: Column) -> Column:
    """A path without its ``.`` and ``..`` segments, the latter with the segment before them; none leads above the root."""
    segments = F.split(path, "/")
    kept = F.aggregate(F.slice(segments, 2, F.size(segments)), F.array().cast("array<string>"), lambda done, s: (
        F.when(s == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))))
        .when(s == ".", done).otherwise(F.concat(done, F.array(s)))))
    joined = F.concat(F.lit("/"), F.array_join(kept, "/"))
    # A path that ends in a dot segment names a folder.
    folder = F.element_at(segments, -1).isin(".", "..") & (F.size(kept) > 0)
    return F.when(path.rlike(r"(^|/)\.\.?(/|$)"), F.when(folder, F.concat(joined, F.lit("/"))).otherwise(joined)).otherwise(path)


def node_of(url: Column) -> Column:
    """The url as a graph node: host, path without dot segments, and query; null if it has no host."""
    query = F.regexp_extract(after_scheme(url), r"^[^?#]*(\?[^#]*)", 1)
    host, path = host_of(url), path_of(url)
    whole = F.when(path == "", F.lit("/")).otherwise(without_dots(path))
    return F.when(host != "", F.concat(host, whole, query))


def absolute(target: Column, base: Column) -> Column:
    """A link target as an absolute url, as RFC 3986 resolves it against ``base`` but for dot segments, which nodes are without.

    One with a scheme stays; others keep the base's scheme, then its host, its path, and its query, as far as they begin further on.
    """
    scheme, host, path = F.regexp_extract(base, r"^(.*?)://", 1), F.regexp_extract(after_scheme(base), r"^([^/?#]*)", 1), path_of(base)
    origin = F.concat(scheme, F.lit("://"), host)
    rooted = F.when(path == "", F.lit("/")).otherwise(path)
    folder = F.regexp_extract(rooted, r"^(.*/)", 1)
    return (F.when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), target)
            .when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
            .when(target.startswith("/"), F.concat(origin, target))
            .when(target.startswith("?"), F.concat(origin, rooted, target))
            .when(target.startswith("#"), base)
            .otherwise(F.concat(origin, folder, target)))


def base_of(html: Column) -> Column:
    """What the first ``base`` element of a page with an href says; empty without one."""
    tags = F.regexp_extract_all(html, F.lit(r"(?i)(<base\b[^>]*>)"), F.lit(1))
    hrefs = F.transform(tags, lambda tag: F.regexp_extract(tag, r"(?i)\bhref\s*=\s*[\"']?\s*([^\"'\s>]+)", 1))
    return F.coalesce(F.get(F.filter(hrefs, lambda to: to != ""), F.lit(0)), F.lit(""))


def targets_of(html: Column) -> Column:
    """Canonical links and refresh redirects of a page, in order, as written apart from ``&amp;``."""
    links = F.filter(F.regexp_extract_all(html, F.lit(r"(?i)(<link\b[^>]*>)"), F.lit(1)),
                     lambda tag: tag.rlike(r"(?i)\brel\s*=\s*[\"']?\s*canonical\b"))
    hrefs = F.transform(links, lambda tag: F.regexp_extract(tag, r"(?i)\bhref\s*=\s*[\"']?\s*([^\"'\s>]+)", 1))
    metas = F.filter(F.regexp_extract_all(html, F.lit(r"(?i)(<meta\b[^>]*>)"), F.lit(1)),
                     lambda tag: tag.rlike(r"(?i)\bhttp-equiv\s*=\s*[\"']?\s*refresh\b"))
    goals = F.transform(metas, lambda tag: F.regexp_extract(tag, r"(?i);\s*url\s*=\s*['\"]?\s*([^\"'\s>]+)", 1))
    clean = F.transform(F.concat(hrefs, goals), lambda to: F.regexp_replace(to, "&amp;", "&"))
    return F.filter(clean, lambda to: to != "")


def equivalences(links: DataFrame) -> DataFrame:
    """Edges ``(a, b)`` between the nodes of ``links(url, target, base)``; null where either has no host."""
    url, base = F.col("url"), F.regexp_replace("base", "&amp;", "&")
    from_page = bound(links, a=node_of(url), base_url=F.when(base == "", url).otherwise(absolute(base, url)))
    goal = bound(from_page, goal=absolute(F.col("target"), F.col("base_url")))
    return goal.select("a", node_of(F.col("goal")).alias("b"))


def page_links(pages: DataFrame) -> DataFrame:
    rows = pages.filter(F.col("html").rlike(r"(?i)canonical|http-equiv"))
    return rows.select("url", F.explode(targets_of(F.col("html"))).alias("target"), base_of(F.col("html")).alias("base"))


def judge(pages: DataFrame, rules: Sequence[Rule], redirects: DataFrame | None = None) -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict, component``.

    A page's own longest rule decides. Without one, the page is blocked if any url equivalent to it, over
    canonical links, refresh redirects and the optional ``redirects(source, target)`` urls, is blocked by
    a rule, and allowed otherwise. Targets are resolved as RFC 3986 does, against the page's ``base`` element if it has one. A block spreads to aliases, an explicit allow holds for its own urls and never
    spreads. Null and unparsable urls have empty host and path, match nothing and are allowed; null html
    has no links; repeated rows are judged alike; an empty table gives an empty result.

    Only urls with an edge enter the components and the joins that follow; where a component is hot, its
    verdict is one row joined back by node.
    """
    rows = pick(pages, ("page_id", "long", "page_id"), ("url", "string", "url"), ("html", "string", "html"))
    links = page_links(rows)
    if redirects is not None:
        told = pick(redirects, ("source", "string", "url"), ("target", "string", "target"))
        links = links.unionByName(told.withColumn("base", F.lit("")))
    edges = equivalences(links)
    groups = Saved(pages.sparkSession, "aliases")(connected_components(edges, "aliases"), "groups")
    host, path = (F.regexp_extract("node", r"^([^/?#]*)([^?]*)", i) for i in (1, 2))
    named = bound(groups, host=host, path=path)
    marked = named.withColumn("own", matching_rule(F.col("host"), F.col("path"), rules).getField("verdict"))
    blocked = marked.groupBy("component").agg(F.max(F.col("own") == "block").alias("blocked")).filter("blocked")
    aliases = groups.join(blocked, "component", "left").select("node", "component", "blocked")
    url = F.col("url")
    parsed = bound(rows.select("page_id", "url"), host=host_of(url), path=path_of(url), node=node_of(url))
    own = bound(parsed, own=matching_rule(F.col("host"), F.col("path"), rules))
    met = own.join(aliases, "node", "left")
    verdict = F.coalesce(F.col("own.verdict"), F.when(F.col("blocked"), F.lit("block")), F.lit("allow"))
    return met.select("page_id", "host", "path", F.col("own.rule").alias("rule"), verdict.alias("verdict"),
                      F.coalesce("component", "node").alias("component"))
