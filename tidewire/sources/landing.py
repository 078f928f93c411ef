"""Writers that land given tables in the shapes the sources read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RESPONSE_SIZE = 250  # articles an article API returns at most


def land_gdelt(articles: DataFrame, path: str) -> None:
    """One response of up to 250 articles per line; ids are dense, so a response
    is a bounded group."""
    rows = articles.select(
        F.floor(F.col("event_id").cast("long") / RESPONSE_SIZE).alias("response"),
        F.struct(
            F.col("event_id").alias("id"), "title", "url", "content",
            F.col("source_name").alias("source"), F.col("published").alias("date"),
            F.array(F.col("language")).alias("categories"),
            F.lit(0.0).alias("tone"),
        ).alias("a"),
    )
    rows.groupBy("response").agg(F.collect_list("a").alias("articles")).select("articles").write.json(path)


def land_newsapi(articles: DataFrame, path: str) -> None:
    article = F.struct(
        "title", "description", "content", "url",
        F.struct(F.col("source_name").alias("name")).alias("source"),
        F.col("published").alias("publishedAt"),
    )
    articles.select(F.array(article).alias("articles")).write.json(path)


def land_rss(articles: DataFrame, path: str) -> None:
    articles.select(
        "title",
        F.col("content").alias("description"),
        F.concat(F.lit("http://feed.example/"), F.col("event_id")).alias("link"),
        F.col("published").alias("pubDate"),
    ).write.format("xml").option("rootTag", "channel").option("rowTag", "item").save(path)


def land_payloads(rows: DataFrame, path: str) -> None:
    rows.select(F.to_json(F.struct(*rows.columns)).alias("value")).write.text(path)


def land_kafka(events: DataFrame, key: str, topic: str, path: str) -> None:
    """Records in the layout of the Kafka source."""
    events.select(
        F.col(key).cast("string").cast("binary").alias("key"),
        F.to_json(F.struct(*events.columns)).cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    ).write.parquet(path)
