"""URL filters with redirect equivalence.

Each url is judged by allow and block rules of host and path; the longest rule
that fits wins.  Redirects and canonical links then make urls equivalent: in a
connected component of them, a url without a rule of its own is allowed if a
member is allowed by a rule, else blocked if a member is blocked, else allowed.
A url's own rule always stands.

Everything is DataFrame functions; the links and the components stay distributed.

Defined results: a null url, or one without ``://``, has an empty host and path, no
rule and no aliases; relative links are resolved against their page; of several
canonical links or refreshes of a page all count; links that
lead nowhere else are ignored; repeated rows stay repeated; an empty table gives
an empty table; further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexloom.llm.components import connected_components
from lexloom.sources.scratch import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
CANONICAL = r"""(?is)<link\b(?=[^>]*\brel\s*=\s*(?:["'](?:[^"'>]*\s)?canonical[\s"']|canonical[\s/>]))[^>]*\bhref\s*=\s*["']?([^"'\s>]+)"""
REFRESH = r"""(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*["']?refresh\b)[^>]*\bcontent\s*=\s*["']?\s*\d+\s*;\s*url\s*=\s*['"]?([^"'\s>]+)"""


@dataclass(frozen=True)
class Rule:
    action: str  # allow or block
    host: str
    path: str


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, PARTS, 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """Struct (rule, action) of the longest rule that fits, else null; of equally long ones allow comes first."""
    found = F.lit(None).cast("struct<rule:string,action:string>")
    for rule in sorted(rules, key=lambda r: (len(r.host + r.path), r.action == "allow")):
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))
        found = F.when(fits, F.struct(F.lit(rule.host + rule.path).alias("rule"), F.lit(rule.action).alias("action"))).otherwise(found)
    return found


def without_dots(path: Column) -> Column:
    """A path that starts with a slash, its ``.`` and ``..`` segments resolved."""
    segments = F.split(path, "/")
    step = lambda done, s: (
        F.when(s == ".", done).when(s == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))).otherwise(F.concat(done, F.array(s)))
    )
    kept = F.aggregate(F.slice(segments, F.lit(2), F.size(segments)), F.array().cast("array<string>"), step)
    ends = F.element_at(segments, -1).isin(".", "..") & (F.size(kept) > 0)
    return F.when(F.contains(path, F.lit("/.")), F.concat(F.lit("/"), F.array_join(kept, "/"), F.when(ends, "/").otherwise(""))).otherwise(path)


def url_key(url: Column) -> Column:
    """What two urls of the same resource share: no fragment or dot segments, scheme and host in lower case; null without a host."""
    bare = F.substring_index(url, "#", 1)
    scheme = F.translate(F.substring_index(bare, "://", 1), UPPER, LOWER)
    query = F.regexp_extract(bare, PARTS + r"(.*)$", 3)
    return F.when(host_of(url) != "", F.concat(scheme, F.lit("://"), host_of(url), without_dots(path_of(bare)), query))


def resolved(link: Column, page: Column) -> Column:
    """A link of a page as an absolute url; character references for & are undone."""
    link = F.replace(link, F.lit("&amp;"), F.lit("&"))
    scheme = F.substring_index(page, "://", 1)
    site = F.regexp_extract(page, r"(?s)^(.*?://[^/?#]*)", 1)
    folder = F.regexp_extract(path_of(page), r"(?s)^(.*/)", 1)
    return (
        F.when(F.rlike(link, F.lit(r"^[A-Za-z][A-Za-z0-9+.-]*://")), link)
        .when(F.rlike(link, F.lit(r"^[A-Za-z][A-Za-z0-9+.-]*:")), F.lit(None))  # mailto and the like
        .when(F.startswith(link, F.lit("//")), F.concat(scheme, F.lit(":"), link))
        .when(F.startswith(link, F.lit("/")), F.concat(site, link))
        .when(F.startswith(link, F.lit("?")), F.concat(site, path_of(page), link))
        .when(F.startswith(link, F.lit("#")), page)
        .otherwise(F.concat(site, F.when(folder == "", F.lit("/")).otherwise(folder), link))
    )


def page_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(a, b) keys of pages and where their canonical links and meta refreshes lead."""
    links = pages.select(url, F.explode(F.concat(*[F.regexp_extract_all(html, F.lit(p), 1) for p in (CANONICAL, REFRESH)])).alias("link"))
    links = links.filter((F.col("link") != "") & F.col(url).isNotNull())
    return links.select(url_key(F.col(url)).alias("a"), url_key(resolved(F.col("link"), F.col(url))).alias("b"))


def judge_urls(
    pages: DataFrame, rules: list[Rule], redirects: DataFrame | None = None, id_column: str = "page_id", url_column: str = "url", html_column: str = "html"
) -> DataFrame:
    """(id, host, path, rule, verdict, component) of every url; ``redirects`` holds further (source, target) urls."""
    pages = pages.select(F.col(id_column).alias("id"), F.col(url_column).alias("url"), F.col(html_column).alias("html"))
    links = page_links(pages)
    if redirects is not None:
        links = links.unionByName(redirects.select(url_key(F.col("source")).alias("a"), url_key(F.col("target")).alias("b")))
    nodes = connected_components(links)
    judged = nodes.select("node", "component", fitting_rule(host_of(F.col("node")), path_of(F.col("node")), rules)["action"].alias("action"))
    groups = judged.groupBy("component").agg(F.max(F.col("action") == "allow").alias("allowed"), F.max(F.col("action") == "block").alias("blocked"))
    inherited = F.when(F.coalesce("allowed", F.lit(False)), "allow").when(F.coalesce("blocked", F.lit(False)), "block")
    # One row per linked url; pages without links find nothing here.
    aliases = materialize(nodes.join(groups, "component").select(F.col("node").alias("key"), "component", inherited.alias("inherited")), "url-aliases")
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    rows = pages.select("id", host.alias("host"), path.alias("path"), url_key(F.col("url")).alias("key"))
    rows = rows.withColumn("own", fitting_rule(F.col("host"), F.col("path"), rules))
    return rows.join(aliases, "key", "left").select(
        F.col("id").alias(id_column), "host", "path", F.col("own.rule").alias("rule"),
        F.coalesce("own.action", "inherited", F.lit("allow")).alias("verdict"), "component",
    )
