"""URL rules with redirect equivalence.

A page is judged by the longest rule that fits its host and path. Pages that no rule fits
are judged by their aliases: URLs linked by redirects and canonical links form connected
components, and a block anywhere in one reaches its members without a rule, unless the
component holds an explicit allow, which takes precedence.

Rules meet pages in a join on the suffixes of the host; only addresses are shuffled,
never page bodies, and components are computed over linked addresses alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sluice.llm.components import components

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    """Between the first :// and the next /, ? or #, A-Z lower-cased; empty where there is none."""
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def address(url: Column) -> Column:
    """What two spellings of one resource share: host, path and query. Null without a host."""
    query = F.regexp_extract(_rest(url), r"^[^?#]*(\?[^#]*)", 1)
    return F.when(host_of(url) != "", F.concat(host_of(url), path_of(url), query))


def _resolved(link: Column, host: Column, path: Column) -> Column:
    """A link found on a page, made absolute."""
    base = F.concat(F.lit("x://"), host)
    folder = F.regexp_replace(path, r"[^/]*$", "")
    return (
        F.when((link == "") | F.startswith(link, F.lit("#")), None)
        .when(F.instr(link, "://") > 0, link)
        .when(F.startswith(link, F.lit("//")), F.concat(F.lit("x:"), link))
        .when(F.startswith(link, F.lit("/")), F.concat(base, link))
        .otherwise(F.concat(base, F.when(folder == "", "/").otherwise(folder), link))
    )


def link_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Edges (source, target) between addresses: canonical links and refresh redirects in `html`."""
    body, own = F.col(html), F.col(url)
    lower = F.lower(body)
    hinted = pages.where(F.contains(lower, F.lit("canonical")) | F.contains(lower, F.lit("refresh")))
    tags = F.regexp_extract_all(body, F.lit(r"(?is)(<(?:link|meta)\b[^>]*>)"), 1)
    quoted = r"""(?is)\b%s\s*=\s*["']?\s*([^"'>]*)"""
    tag = F.col("tag")
    canonical = F.when(
        tag.rlike(r"(?is)^<link\b") & tag.rlike(r"""(?is)\brel\s*=\s*["']?\s*canonical\b"""), F.regexp_extract(tag, quoted % "href", 1)
    )
    refresh = F.when(
        tag.rlike(r"(?is)^<meta\b") & tag.rlike(r"""(?is)\bhttp-equiv\s*=\s*["']?\s*refresh\b"""),
        F.regexp_extract(tag, r"""(?is)\burl\s*=\s*["']?\s*([^"'>]*)""", 1),
    )
    # Each step is a column of its own, so that no expression is repeated inside another.
    found = hinted.select(own.alias("own"), F.explode(tags).alias("tag")).select("own", F.coalesce(canonical, refresh).alias("link")).where("link IS NOT NULL")
    parts = found.select(
        host_of(F.col("own")).alias("host"), path_of(F.col("own")).alias("path"), address(F.col("own")).alias("source"),
        F.trim(F.replace("link", F.lit("&amp;"), F.lit("&"))).alias("link"),
    )
    full = parts.select("source", _resolved(F.col("link"), F.col("host"), F.col("path")).alias("full"))
    # Behind the outer generator, the filter does not take the place of the columns above: inlined
    # into each other, they make code that no longer compiles.
    pair = F.struct("source", address(F.col("full")).alias("target"))
    edges = full.select(F.explode_outer(F.array(pair)).alias("edge")).select("edge.source", "edge.target")
    return edges.where("source IS NOT NULL AND target IS NOT NULL AND source <> target").distinct()


def label_counts(rules: DataFrame) -> list[int]:
    """The numbers of labels that hosts of rules have: few, however many the rules are."""
    labels = F.size(F.split(F.substring_index("rule", "/", 1), r"\."))
    return sorted(r.n for r in rules.select(labels.alias("n")).distinct().collect())


def fitting_rules(urls: DataFrame, rules: DataFrame, row: str, counts: list[int]) -> DataFrame:
    """Per value of `row`: rule and action of the longest rule that fits its host and path.

    `counts` are the `label_counts` of the rules: a host has one suffix for each, however long it is.
    """
    # A host of fewer labels is its own suffix, which is then looked up once.
    suffixes = F.array_distinct(F.array(*[F.substring_index("host", ".", -n) for n in counts]).cast("array<string>"))
    split = rules.select(
        "rule", "action", F.substring_index("rule", "/", 1).alias("suffix"), F.expr("substring(rule, instr(rule, '/'))").alias("start")
    )
    exploded = urls.select(row, "path", F.explode(suffixes).alias("suffix"))
    fits = exploded.join(split, "suffix").where(F.startswith("path", "start"))
    best = F.max_by(F.struct("rule", "action"), F.struct(F.length("rule"), F.col("rule"), F.col("action")))
    return fits.groupBy(row).agg(best.alias("best")).select(row, "best.rule", "best.action")


def judge_urls(
    pages: DataFrame, rules: DataFrame, edges: DataFrame | None = None, key: str = "page_id", url: str = "url", html: str | None = "html"
) -> DataFrame:
    """One row per row of `pages`: key, host, path, rule (null: none fits), verdict, component.

    `rules` has rule ("host/path") and action ("block" or "allow"). `edges` are further pairs
    of URLs known to be aliases, such as recorded redirects. A null URL, or one without
    "://", has no host and no alias and is allowed. A rule without a slash fits nothing. Of two equal rules, one that blocks
    wins. Repeated pages are rows of their own; other columns are not read. `component` is
    the least address of the page's aliases, null where it has none. Hosts and paths of any
    length are judged whole, at a cost in proportion to their length.
    """
    spark = pages.sparkSession
    rules = rules.select("rule", "action").where("instr(rule, '/') > 0")
    links = spark.createDataFrame([], "source STRING, target STRING") if html is None else link_edges(pages, url, html)
    if edges is not None:
        a, b = edges.columns
        links = links.union(edges.select(address(F.col(a)), address(F.col(b))))
    aliases = components(links)
    named = aliases.select("node", F.regexp_extract("node", r"^[^/?]*", 0).alias("host"), F.regexp_extract("node", r"^[^/?]*([^?]*)", 1).alias("path"))
    counts = label_counts(rules)
    told = fitting_rules(named, rules, "node", counts)
    spread = (
        aliases.join(told, "node")
        .groupBy("component")
        .agg(F.bool_or(F.col("action") == "allow").alias("allowed"))
        .select("component", F.when(F.col("allowed"), "allow").otherwise("block").alias("spread"))
    )
    by_alias = aliases.join(spread, "component", "left_outer")
    own = pages.select(
        F.monotonically_increasing_id().alias("_row"), F.col(key).alias("_key"), host_of(F.col(url)).alias("host"),
        path_of(F.col(url)).alias("path"), address(F.col(url)).alias("node"),
    )
    # Pages of one host and path share their rule, so it is looked up once for them all.
    places = own.select("host", "path").distinct().withColumn("_place", F.struct("host", "path"))
    ruled = fitting_rules(places, rules, "_place", counts).select("_place.host", "_place.path", "rule", "action")
    return (
        own.join(ruled, ["host", "path"], "left_outer")
        .join(by_alias, "node", "left_outer")
        .select(F.col("_key").alias(key), "host", "path", "rule", F.coalesce("action", "spread", F.lit("allow")).alias("verdict"), "component")
    )
