"""Flows: operators composed the way a run uses them."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.functions import lexicons as lx
from tidewire.operators import clean, enrich, explain, features, graph, intel, learn, nlp, signals, similarity, transform
from tidewire.session import chain, cut_lineage
from tidewire.sources import landed
from tidewire.streaming import sinks


def tag(
    articles: DataFrame,
    positive: Iterable[str] = lx.POSITIVE_WORDS,
    negative: Iterable[str] = lx.NEGATIVE_WORDS,
) -> DataFrame:
    """Entities, places and sentiment of articles."""
    return chain(
        enrich.extract_entities,
        enrich.enrich_geo,
        lambda df: nlp.score_sentiment(df, positive, negative),
    )(articles)


def feature_rows(
    articles: DataFrame,
    positive: Iterable[str] = lx.POSITIVE_WORDS,
    negative: Iterable[str] = lx.NEGATIVE_WORDS,
) -> DataFrame:
    """Narrow feature rows straight from articles: one pass over the texts, no shuffle."""
    return features.extract_features(tag(articles, positive, negative))


def daily_rows(
    articles: DataFrame,
    positive: Iterable[str] = lx.POSITIVE_WORDS,
    negative: Iterable[str] = lx.NEGATIVE_WORDS,
) -> DataFrame:
    """Deduplicated daily feature rows with their linked entities.

    Features depend on the row alone, so they are taken before the
    deduplication: the shuffle that finds the first copy then moves narrow rows
    instead of texts.
    """
    enriched = chain(
        enrich.enrich_geo,
        enrich.link_entities,
        lambda df: nlp.score_sentiment(df, positive, negative),
    )(articles)
    narrow = enriched.select(
        "event_id",
        "event_ts",
        clean.dedup_key().alias("dedup_key"),
        F.col("language"),
        F.col("sentiment.score").alias("sentiment_score"),
        F.col("sentiment.label").alias("sentiment_label"),
        F.struct("entities.countries", "entities.organizations").alias("entities"),
        F.col("entity_count"),
        F.length(F.coalesce("content", F.lit(""))).alias("text_length"),
        F.col("has_geo").cast("int").alias("has_geo"),
    )
    return clean.keep_first(narrow, "dedup_key")


def daily_flow(
    articles: DataFrame,
    positive: Iterable[str] = lx.POSITIVE_WORDS,
    negative: Iterable[str] = lx.NEGATIVE_WORDS,
) -> dict[str, DataFrame]:
    """Dedup, enrich, graph, features and signals of a batch of articles.

    The narrow daily rows feed three results, so they are written once.
    """
    rows = cut_lineage(daily_rows(articles, positive, negative), "daily")
    nodes, edges = graph.daily_graph(rows)
    by_day = features.daily_features(rows)
    return {
        "rows": rows,
        "nodes": nodes,
        "edges": edges,
        "features": by_day,
        "signals": signals.generate_daily_signals(by_day, "day"),
    }


DAILY_TABLES = ("rows", "nodes", "edges", "features", "signals")


def store_daily(out: dict[str, DataFrame], root: str) -> dict[str, T.StructType]:
    """Write the tables of ``daily_flow`` under ``root``, each partitioned by day, and return their schemas.

    Nodes and edges carry the day of the article they come from. A partitioned
    write of no rows leaves no file to read a schema from, so readers are given it.
    """
    days = out["rows"].select(F.col("event_id").alias("_id"), F.to_date("event_ts").alias("day"))
    tables = {
        "rows": out["rows"].withColumn("day", F.to_date("event_ts")),
        "nodes": out["nodes"].join(days, out["nodes"]["id"] == days["_id"]).drop("_id"),
        "edges": out["edges"].join(days, out["edges"]["source"] == days["_id"]).drop("_id"),
        "features": out["features"],
        "signals": out["signals"],
    }
    for name in DAILY_TABLES:
        sinks.write_table(tables[name], f"{root}/{name}", "day", mode="overwrite")
    return {name: tables[name].schema for name in DAILY_TABLES}


def ingest_flow(spark: SparkSession, paths: Mapping[str, str], payload: T.StructType, run_ts: str) -> DataFrame:
    """Landed data of every source as events: what collectors return is cleaned, feeds are
    mapped with their times, payloads become events."""
    arrived = F.lit(run_ts).cast("timestamp_ntz")

    def numbered(df: DataFrame) -> DataFrame:
        """Landed articles carry no id: title, address and time name them."""
        named = F.md5(F.concat_ws("|", *[c for c in ("title", "url", "link", "published", "payload") if c in df.columns]))
        return df.withColumn("event_id", named).withColumn("event_ts", arrived)

    gdelt = clean.clean(numbered(landed.read_gdelt(spark, paths["gdelt"], run_ts, multiline=False)).withColumn("description", F.lit("")))
    news = clean.clean(numbered(landed.read_newsapi(spark, paths["newsapi"], multiline=False)))
    feeds = transform.transform_rss(numbered(landed.read_rss(spark, paths["rss"])), run_ts)
    hooks = transform.build_event(
        numbered(landed.read_webhook(spark, paths["webhook"], payload, stream=False)).withColumn("content", F.col("text"))
    )
    columns = ["event_id", "source", "event_type", "title", "content"]
    parts = [gdelt.select(columns), news.select(columns)]
    for df, kind in ((feeds, "news_article"), (hooks, "incoming")):
        parts.append(df.select("event_id", "source", F.lit(kind).alias("event_type"), "title", "content"))
    return transform.union_sources(parts)


def explain_flow(feature_table: DataFrame, edges: DataFrame, run_ts: str, trees: int = 20) -> DataFrame:
    """One explanation per source: a forest is trained on the features, its predictions are
    attributed, and each source gets its mean attributions and its paths to the market."""
    model, _ = learn.train_forest(feature_table, trees=trees)
    values = explain.attribute(model, feature_table, explain.background_of(feature_table))
    sources = feature_table.select("event_id", "source_name")
    attributions = (
        values.join(sources, "event_id").groupBy("source_name", "feature")
        .agg(F.round(F.avg("shap_value"), 4).alias("shap_value"))
    )
    to_market = edges.where(F.col("target") == graph.MARKET_NODE).select(F.col("source").alias("event_id")).distinct()
    paths = to_market.join(sources, "event_id").groupBy("source_name").agg(F.count("*").alias("causal_paths"))
    per_source = signals.with_signals(features.aggregate_features(feature_table, "source_name"))
    return explain.explain(per_source, "source_name", run_ts, paths=paths, attributions=attributions)


def similarity_text_flow(
    live: DataFrame, articles: DataFrame, run_ts: str, threshold: float = 0.7, k: int = 20, dim: int = 384
) -> DataFrame:
    """From texts to similarity links: both sides are embedded first."""
    queries = cut_lineage(nlp.embed_text(live, dim).select("event_id", "embedding"), "queries")
    corpus = nlp.embed_text(articles, dim).select("event_id", "embedding")
    return similarity_flow(queries, corpus, run_ts, threshold, k, query_id="event_id", corpus_id="event_id")


def news_flow(sources: Iterable[DataFrame]) -> DataFrame:
    """Collect, classify and weigh news."""
    return chain(intel.classify_news, intel.weigh_sources)(transform.union_sources(sources))


def similarity_flow(
    queries: DataFrame, corpus: DataFrame, run_ts: str, threshold: float = 0.7, k: int = 20, **columns: str
) -> DataFrame:
    """Search, match, attach outcomes, link."""
    hits = similarity.top_k(queries, corpus, k, **columns)
    matched = similarity.attach_outcomes(similarity.match(hits, threshold, k))
    return similarity.similarity_links(matched, run_ts)


def signal_series(feature_table: DataFrame, group: str, start: str) -> DataFrame:
    """Daily average sentiment per group as ``(series_id, idx, value)``."""
    by_day = features.daily_features(feature_table, group)
    return by_day.select(
        F.col(group).alias("series_id"),
        F.date_diff(F.col("day"), F.lit(start).cast("date")).alias("idx"),
        F.col("avg_sentiment").alias("value"),
    )


def live_scoring(articles: DataFrame, dim: int) -> DataFrame:
    """Articles reduced to what live scoring needs."""
    return nlp.embed_text(articles, dim).select("event_id", "event_ts", "embedding")
