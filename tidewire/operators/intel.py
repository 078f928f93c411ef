"""Conflict, economic, commodity, category, credibility and watchlist tagging."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.functions import lexicons as lx
from tidewire.functions import text as t
from tidewire.session import pin


def _lowered() -> Column:
    return F.lower(t.title_and_content())


def conflict_articles(df: DataFrame, words: Iterable[str] = lx.CONFLICT_QUERY_WORDS) -> DataFrame:
    """Articles a conflict query would return, retyped."""
    return df.filter(t.mentions_any(_lowered(), words)).withColumn(
        "event_type", F.lit("conflict_intelligence")
    )


def scan_conflict(
    df: DataFrame,
    escalation_rule: str = "last",
    match: str = "substring",
    triggers: Mapping[str, list[str]] = lx.ESCALATION_TRIGGERS,
    zones: Iterable[str] = lx.CONFLICT_ZONES,
    keywords: Iterable[str] = lx.CONFLICT_KEYWORDS,
) -> DataFrame:
    """Escalation level, triggers, zones, keyword hits and severity.

    ``escalation_rule='last'``: levels are tried high, medium, low and the last
    hit wins; ``'max'`` keeps the highest level instead.
    """
    order = {"last": ["low", "medium", "high"], "max": ["high", "medium", "low"]}[escalation_rule]
    low = _lowered()
    hits = {lvl: t.mentions_any(low, words, match) for lvl, words in triggers.items()}
    level = F.lit(None).cast("string")
    for name in reversed(order):
        level = F.when(hits[name], name).otherwise(level)
    level = F.coalesce(level, F.lit("low"))
    every_trigger = [w for words in triggers.values() for w in words]
    points = F.lit(lx.SEVERITY_POINTS["low"])
    for name, value in lx.SEVERITY_POINTS.items():
        points = F.when(F.col("escalation_level") == name, value).otherwise(points)
    return df.withColumns(
        {
            "escalation_level": level,
            "matched_triggers": t.mentioned(low, every_trigger, match),
            "active_zones": t.mentioned(low, zones, match),
            "keyword_hits": t.count_true(t.mentions(low, k, match) for k in keywords),
        }
    ).withColumn("severity_score", points)


def _matched_by_label(df: DataFrame, name: str, lists: Mapping[str, list[str]], match: str) -> DataFrame:
    """Add map label -> matched keywords, labels without a match left out.

    The texts are searched once into an array of keyword positions (compiled);
    the map is then built from that short array.
    """
    keywords = [k for words in lists.values() for k in words]
    listed = F.array(*[F.lit(k) for k in keywords])

    def entry(label: str, first: int, last: int) -> Column:
        own = F.filter("_at", lambda i: i.between(first, last))
        names = F.transform(own, lambda i: F.element_at(listed, i))
        return F.struct(F.lit(label).alias("label"), names.alias("matched"))

    entries, at = [], 0
    for label, words in lists.items():
        entries.append(entry(label, at + 1, at + len(words)))
        at += len(words)
    kept = F.filter(F.array(*entries), lambda e: F.size(e["matched"]) > 0)
    return (
        pin(df, "_at", t.mentioned_at(_lowered(), keywords, match))
        .withColumn(name, F.map_from_entries(kept))
        .drop("_at")
    )


def detect_economic(df: DataFrame, match: str = "substring") -> DataFrame:
    """Indicators with their matched keywords and counts, and primary sectors."""
    return (
        _matched_by_label(df, "_matched", lx.ECONOMIC_INDICATORS, match)
        .withColumns(
            {
                "indicators_detected": F.transform_values(
                    "_matched", lambda _, m: F.struct(m.alias("matched"), F.size(m).alias("count"))
                ),
                "indicator_count": F.size("_matched"),
                "primary_sectors": t.labels_mentioned(_lowered(), lx.SECTORS, match),
            }
        )
        .drop("_matched")
    )


def detect_commodities(df: DataFrame, match: str = "substring") -> DataFrame:
    """Map commodity category -> mentioned commodities."""
    return _matched_by_label(df, "commodities_mentioned", lx.COMMODITIES, match)


def classify_news(df: DataFrame, match: str = "substring") -> DataFrame:
    """News categories, ``['general']`` when none fits."""
    none = F.size("_found") == 0
    return (
        df.withColumn("_found", t.labels_mentioned(_lowered(), lx.NEWS_CATEGORIES, match))
        .withColumns(
            {
                "categories": F.when(none, F.array(F.lit("general"))).otherwise(F.col("_found")),
                "category_count": F.greatest(F.size("_found"), F.lit(1)),
            }
        )
        .drop("_found")
    )


def weigh_sources(
    df: DataFrame,
    weights: Mapping[str, float] = lx.SOURCE_WEIGHTS,
    default: float = lx.DEFAULT_SOURCE_WEIGHT,
) -> DataFrame:
    """Source credibility by name; the small table is a literal map, not a join."""
    name = t.first_filled(F.col("source_name"), F.col("source"))
    key = F.replace(F.lower(name), F.lit(" "), F.lit("_"))
    lookup = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair])
    return df.withColumn(
        "source_credibility", F.coalesce(F.try_element_at(lookup, key), F.lit(default))
    ).withColumn("source_weight", F.col("source_credibility"))


def watch_mentions(
    df: DataFrame,
    watchlist: Mapping[str, list[str]] = lx.WATCHLIST,
    match: str = "substring",
) -> DataFrame:
    """Articles mentioning each watched place per day, with a z-score over its days.

    The place list is unrolled into the row, so the texts are read once and
    only (kind, place, day) counts are shuffled.
    """
    watched = [(kind, place) for kind, places in watchlist.items() for place in places]
    kinds = F.array(*[F.lit(kind) for kind, _ in watched])
    names = F.array(*[F.lit(place) for _, place in watched])
    at = t.mentioned_at(_lowered(), [place for _, place in watched], match)
    daily = (
        df.select(F.to_date("event_ts").alias("day"), F.explode(at).alias("at"))
        .groupBy("at", "day")
        .agg(F.count("*").alias("mentions"))
        .select(
            F.element_at(kinds, F.col("at")).alias("kind"),
            F.element_at(names, F.col("at")).alias("place"),
            "day",
            "mentions",
        )
    )
    days = Window.partitionBy("kind", "place")
    mean, spread = F.avg("mentions").over(days), F.stddev_pop("mentions").over(days)
    return daily.withColumn(
        "z_score",
        F.when(spread > 0, F.round((F.col("mentions") - mean) / spread, 4)).otherwise(F.lit(0.0)),
    )


def project_episodes(df: DataFrame, pipeline_name: str) -> DataFrame:
    """Episode rows for a memory store; absent columns fall back as documented."""

    def text_of(name: str) -> Column:
        return F.col(name) if name in df.columns else F.lit(None).cast("string")

    def list_of(*names: str) -> Column:
        present = [F.col(n) for n in names if n in df.columns]
        return F.coalesce(*present, F.array().cast("array<string>"))

    return df.select(
        "event_id",
        F.coalesce(text_of("title"), text_of("event_type"), F.lit("Pipeline Event")).alias("title"),
        F.coalesce(text_of("summary"), text_of("description"), F.lit("")).alias("summary"),
        (F.col("locations") if "locations" in df.columns else F.array().cast("array<string>")).alias("locations"),
        list_of("sectors", "affected_sectors").alias("sectors"),
        (F.col("entities") if "entities" in df.columns else F.array().cast("array<string>")).alias("entities"),
        F.lit("pipeline").alias("source"),
        F.lit(pipeline_name).alias("pipeline_name"),
    )
