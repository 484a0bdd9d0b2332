"""URL block rules that hold for aliases: pages joined by redirect and canonical links share a decision.

A rule names a host, meant with all its subdomains, and the beginning of a path; the longest rule that fits a URL decides
it. Redirects and canonical links join URLs to groups, found as connected components. A URL without a rule of its own is
allowed if any alias is explicitly allowed, else blocked if any alias is blocked, else allowed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.llm.common import materialise
from tillflow.llm.components import components

#: (host, path, verdict)
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Attributes of a link or meta element in either order; the target is the first group that is not empty.
CANONICAL = (
    r"""(?i)<link\b[^>]*\brel\s*=\s*["']?canonical\b[^>]*\bhref\s*=\s*["']?([^"'>\s]+)""",
    r"""(?i)<link\b[^>]*\bhref\s*=\s*["']?([^"'>\s]+)["']?[^>]*\brel\s*=\s*["']?canonical\b""",
)
REFRESH = (
    r"""(?i)<meta\b[^>]*\bhttp-equiv\s*=\s*["']?refresh\b[^>]*\burl\s*=\s*["']?([^"'>\s]+)""",
    r"""(?i)<meta\b[^>]*\burl\s*=\s*["']?([^"'>\s]+)["']?[^>]*\bhttp-equiv\s*=\s*["']?refresh\b""",
)


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` and for null."""
    found = F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, UPPER, LOWER), F.lit(""))


def path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def place(url: Column) -> Column:
    """What two spellings of an address share: host, path and query, without scheme and fragment. Null without a host."""
    query = F.regexp_extract(url, r"(?s)^[^?#]*(\?[^#]*)", 1)
    return F.when(host(url) != "", F.concat(host(url), F.regexp_replace(path(url), "^$", "/"), query))


def targets(html: Column) -> Column:
    """Addresses that a page names as its canonical one or sends its readers to."""
    found = [F.regexp_extract_all(html, F.lit(pattern), F.lit(1)) for pattern in (*CANONICAL, *REFRESH)]
    found = F.array_distinct(F.transform(F.concat(*found), lambda t: F.replace(t, F.lit("&amp;"), F.lit("&"))))
    return F.when(F.rlike(html, F.lit("(?i)canonical|http-equiv")), found).otherwise(F.array().cast("array<string>"))


def resolve(base: Column, target: Column) -> Column:
    """The address that ``target`` means on a page at ``base``."""
    scheme = F.regexp_extract(base, "(?s)^(.*?)://", 1)
    root = F.concat(scheme, F.lit("://"), host(base))
    folder = F.regexp_replace(F.regexp_replace(path(base), "^$", "/"), "[^/]*$", "")
    return (
        F.when(F.contains(target, F.lit("://")), target)
        .when(F.startswith(target, F.lit("//")), F.concat(scheme, F.lit(":"), target))
        .when(F.startswith(target, F.lit("/")), F.concat(root, target))
        .otherwise(F.concat(root, folder, target))
    )


def page_links(pages: DataFrame) -> DataFrame:
    """``source, target`` addresses of the canonical and refresh links of pages (``url, html``)."""
    found = pages.where(host(F.col("url")) != "").select("url", F.explode(targets(F.col("html"))).alias("_t"))
    return found.select(F.col("url").alias("source"), resolve(F.col("url"), F.col("_t")).alias("target"))


def _ruled(addresses: DataFrame, rules: DataFrame) -> DataFrame:
    """``host, path`` with ``rule, verdict`` of the longest rule that fits; addresses without one are left out."""
    labels = F.split("host", r"\.")
    names = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    asked = addresses.where("host <> ''").select("host", "path", F.explode(F.array_distinct(names)).alias("rule_host"))
    fits = asked.join(rules, "rule_host").where(F.startswith("path", F.col("rule_path")))
    best = fits.groupBy("host", "path").agg(F.max(F.struct(F.length("rule").alias("n"), "rule", "verdict")).alias("_best"))
    return best.select("host", "path", "_best.rule", "_best.verdict")


def judge(pages: DataFrame, rules=RULES, redirects: DataFrame | None = None) -> DataFrame:
    """``page_id, host, path, rule, verdict`` and ``alias`` (of the decision, null if none) for every row of ``pages``.

    ``pages`` has ``page_id, url, html``; ``redirects`` may add links ``source, target`` between addresses. Two rules of equal
    length are told apart by their text. A null url, and one without ``://``, has an empty host and path, no rule and no
    alias, and is allowed. Repeated rows get equal verdicts; an empty table gives an empty result.
    """
    spark = pages.sparkSession
    listed = [(h, p, h + p, v) for h, p, v in rules]
    ruled = spark.createDataFrame(listed, "rule_host string, rule_path string, rule string, verdict string")
    own = pages.select("page_id", "url", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    links = page_links(pages)
    if redirects is not None:
        links = links.union(redirects.select("source", "target"))
    links = materialise(links.distinct())
    addresses = own.select("host", "path")
    for end in ("source", "target"):
        addresses = addresses.union(links.select(host(F.col(end)), path(F.col(end))))
    decided = materialise(_ruled(addresses.distinct(), ruled))

    edges = links.select(place(F.col("source")).alias("a"), place(F.col("target")).alias("b")).where("a IS NOT NULL AND b IS NOT NULL")
    groups = materialise(components(edges))
    ends = links.select(F.col("source").alias("url")).union(links.select("target")).distinct()
    ends = ends.select(place(F.col("url")).alias("node"), host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    members = groups.join(ends, "node").join(decided, ["host", "path"])
    shared = members.groupBy("component").agg(F.min("verdict").alias("_shared"))  # allow comes before block
    shared = materialise(groups.join(shared, "component").select(F.col("node").alias("_place"), "_shared"))

    found = own.join(decided, ["host", "path"], "left").withColumn("_place", place(F.col("url"))).join(shared, "_place", "left")
    alias = F.when(F.col("rule").isNull(), F.col("_shared"))
    return found.select("page_id", "host", "path", "rule", F.coalesce("verdict", alias, F.lit("allow")).alias("verdict"), alias.alias("alias"))
