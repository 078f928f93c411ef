"""URL rules, and block decisions that follow redirects and canonical links."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.llm.components import components

RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)

_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_CANONICAL = r"""(?is)<link\b(?=[^>]*\brel\s*=\s*["']?canonical\b)[^>]*\bhref\s*=\s*["']?([^"'\s>]+)"""
_REFRESH = (
    r"""(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*["']?refresh\b)[^>]*\bcontent\s*=\s*["']?"""
    r"""[^"'>]*?url\s*=\s*([^"'\s>]+)"""
)


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def best_rule(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits as struct(size, allow, rule), or null; an allow wins a tie.

    A rule fits its host and all subdomains if the path starts with the rule's.
    The rules are one constant map from host to its rules, so a page looks up its
    host's suffixes and nothing is joined; keep the list below some 10,000 rules.
    """
    by_host: dict[str, list] = {}
    for rule_host, rule_path, verdict in rules:
        by_host.setdefault(rule_host, []).append({"path": rule_path, "allow": verdict == "allow"})
    known = F.from_json(F.lit(json.dumps(by_host)), "map<string,array<struct<path:string,allow:boolean>>>")
    labels = F.split(host, r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    hits = F.flatten(
        F.transform(
            suffixes,
            lambda s: F.transform(
                F.filter(
                    F.coalesce(F.try_element_at(known, s), F.array().cast("array<struct<path:string,allow:boolean>>")),
                    lambda r: path.startswith(r["path"]),
                ),
                lambda r: F.struct(
                    F.length(F.concat(s, r["path"])).alias("size"),
                    r["allow"].alias("allow"),
                    F.concat(s, r["path"]).alias("rule"),
                ),
            ),
        )
    )
    return F.array_max(hits)


def alias_key(url: Column) -> Column:
    """One name for spellings of a URL that serve the same page: no scheme, fragment or last slash."""
    query = F.regexp_extract(url, r"(?s)^[^?#]*(\?[^#]*)", 1)
    path = F.regexp_replace(path_of(url), "/+$", "")
    return F.when(host_of(url) != "", F.concat(host_of(url), path, query))


def _absolute(url: Column, target: Column) -> Column:
    root = F.concat(F.regexp_extract(url, "(?s)^(.*?)://", 1), F.lit("://"), host_of(url))
    return (
        F.when(target == "", None)
        .when(target.contains("://"), target)
        .when(target.startswith("//"), F.concat(F.lit("http:"), target))
        .when(target.startswith("/"), F.concat(root, target))
    )


def page_links(pages: DataFrame) -> DataFrame:
    """(src_url, dst_url): canonical links and refresh redirects found in the pages' html."""
    html = F.coalesce(F.col("html"), F.lit(""))
    found = pages.select(
        F.col("url").alias("src_url"),
        F.explode(
            F.array(
                _absolute(F.col("url"), F.regexp_extract(html, _CANONICAL, 1)),
                _absolute(F.col("url"), F.regexp_extract(html, _REFRESH, 1)),
            )
        ).alias("dst_url"),
    )
    return found.where("src_url IS NOT NULL AND dst_url IS NOT NULL")


def judge_pages(pages: DataFrame, redirects: DataFrame | None = None, rules=RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row of ``pages`` (page_id, url, html).

    A fitting rule decides; so an explicit allow stands whatever its aliases are.
    A page without one is blocked if any alias of it, a page or only a link's
    target, is blocked by a rule, and allowed otherwise. Aliases are the pages
    connected by redirects (``redirects``: src_url, dst_url), canonical links and
    refresh tags, or equal but for scheme, fragment and last slash. Null or
    malformed urls have no aliases and are allowed; repeated rows are judged alike;
    an empty table gives none; html of any length is searched as a whole.
    """
    url = F.col("url")
    judged = pages.select("page_id", "url", host_of(url).alias("host"), path_of(url).alias("path"))
    judged = judged.withColumn("_rule", best_rule(F.col("host"), F.col("path"), rules)).withColumn(
        "_key", alias_key(url)
    )
    links = page_links(pages)
    if redirects is not None:
        links = links.unionByName(redirects.select("src_url", "dst_url"))
    # Hashed names keep the graph narrow; two keys that share a 64-bit hash would count as aliases.
    ends = links.select(
        F.xxhash64(alias_key(F.col("src_url"))).alias("u"),
        F.xxhash64(alias_key(F.col("dst_url"))).alias("v"),
        F.col("dst_url").alias("url"),
    )
    roots = components(ends.select("u", "v"))
    targets = ends.select(
        F.col("v").alias("node"), best_rule(host_of(F.col("url")), path_of(F.col("url")), rules).alias("_rule")
    )
    nodes = judged.where("_key IS NOT NULL").select(F.xxhash64("_key").alias("node"), "_rule").union(targets)
    # The nodes are made unique before the join, so a hot page or target meets it once.
    blocked_nodes = nodes.where("NOT _rule.allow").select("node").distinct()
    blocked = (
        blocked_nodes.join(roots, "node", "left").select(F.coalesce("root", "node").alias("_class")).distinct()
    )
    classes = (
        judged.where("_rule IS NULL AND _key IS NOT NULL").select(F.xxhash64("_key").alias("node")).distinct()
        .join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("_class"))
        .join(blocked, "_class", "left_semi").select("node").withColumn("_blocked", F.lit(True))
    )
    # A ruled page needs no class: a key of its own spreads it over the tasks, and what it meets there is not read.
    node = F.when(F.expr("_rule IS NULL AND _key IS NOT NULL"), F.xxhash64("_key")).otherwise(
        F.xxhash64("page_id", "url")
    )
    return (
        judged.withColumn("node", node).join(classes, "node", "left")
        .select(
            "page_id", "host", "path", F.col("_rule.rule").alias("rule"),
            F.when(F.col("_rule").isNotNull(), F.when(F.col("_rule.allow"), "allow").otherwise("block"))
            .when(F.expr("_blocked AND _key IS NOT NULL"), "block").otherwise("allow").alias("verdict"),
        )
    )
