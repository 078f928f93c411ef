"""Sources that read landed files (batch or stream) and Kafka topics.

Fetching from the network is somebody else's job: responses, feeds and payloads
land as files, and these readers turn them into article rows. Every reader has
a fixed schema, so nothing is inferred.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

GDELT_SCHEMA = (
    "articles array<struct<id string, title string, url string, content string, source string, "
    "date string, categories array<string>, locations array<string>, tone double>>"
)
NEWSAPI_SCHEMA = (
    "articles array<struct<title string, description string, content string, url string, "
    "source struct<name string>, publishedAt string>>"
)
RSS_SCHEMA = "title string, description string, link string, pubDate string"

CORRUPT = "_corrupt_record"


def _json(spark: SparkSession, path: str, schema: str, stream: bool, multiline: bool) -> DataFrame:
    reader = spark.readStream if stream else spark.read
    return reader.schema(schema).option("multiLine", multiline).json(path)


def gdelt_rows(responses: DataFrame, collected_at: str) -> DataFrame:
    none = F.array().cast("array<string>")
    return responses.select(F.explode("articles").alias("a")).select(
        F.lit("gdelt").alias("source"),
        F.lit("news_article").alias("event_type"),
        "a.title",
        "a.url",
        "a.content",
        F.col("a.source").alias("source_name"),
        F.col("a.date").alias("published"),
        F.coalesce("a.categories", none).alias("categories"),
        F.coalesce("a.locations", none).alias("locations"),
        "a.tone",
        F.create_map(
            F.lit("gdelt_doc_id"), F.col("a.id"), F.lit("collected_at"), F.lit(collected_at)
        ).alias("metadata"),
    )


def read_gdelt(
    spark: SparkSession, path: str, collected_at: str, stream: bool = False, multiline: bool = True
) -> DataFrame:
    """Landed article-list responses; pass ``multiline=False`` for one response per
    line, which large files need to be split between tasks."""
    return gdelt_rows(_json(spark, path, GDELT_SCHEMA, stream, multiline), collected_at)


def read_newsapi(
    spark: SparkSession, path: str, stream: bool = False, multiline: bool = True
) -> DataFrame:
    responses = _json(spark, path, NEWSAPI_SCHEMA, stream, multiline)
    return responses.select(F.explode("articles").alias("a")).select(
        F.lit("newsapi").alias("source"),
        F.lit("news_article").alias("event_type"),
        "a.title",
        "a.description",
        "a.content",
        "a.url",
        F.col("a.source.name").alias("source_name"),
        F.col("a.publishedAt").alias("published"),
    )


def read_rss_items(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """Every ``<item>`` of landed feeds; one that can't be read has its text in ``_corrupt_record``."""
    reader = spark.readStream if stream else spark.read
    return (
        reader.format("xml")
        .schema(f"{RSS_SCHEMA}, {CORRUPT} string")
        .option("rowTag", "item")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("ignoreSurroundingSpaces", False)
        .load(path)
        .select("*", F.col("_metadata.file_path").alias("feed"))
    )


def rss_skipped(items: DataFrame) -> DataFrame:
    """Read and skipped items per feed."""
    bad = F.col(CORRUPT).isNotNull()
    # A query that reads nothing but the column of broken records is refused, so the title is read as well.
    read = F.when(~bad, F.coalesce("title", F.lit("")))
    return items.groupBy("feed").agg(F.count(read).alias("items"), F.count_if(bad).alias("skipped"))


def read_rss(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """Landed feeds, one row per ``<item>``; ``feed`` is the file the item came from.

    Missing elements read as ''. Of a file that is not well formed the items that
    can be read are kept, so a bad feed fails no run; ``rss_skipped`` counts the rest.
    """
    items = read_rss_items(spark, path, stream).filter(F.col(CORRUPT).isNull())

    def text(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(""))

    return items.select(
        F.lit("rss").alias("source"),
        F.lit("news_article").alias("event_type"),
        text("title").alias("title"),
        text("description").alias("description"),
        text("link").alias("link"),
        text("pubDate").alias("published"),
        "feed",
    )


def parse_payloads(lines: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """JSON payload lines to columns; a line that does not parse is kept in
    ``_corrupt_record``."""
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    return lines.select(
        F.lit("webhook").alias("source"),
        F.lit("incoming").alias("event_type"),
        F.col(value).alias("payload"),
        F.from_json(F.col(value), full, options).alias("_p"),
    ).select("source", "event_type", "payload", "_p.*")


def read_webhook(
    spark: SparkSession, path: str, schema: T.StructType, stream: bool = True
) -> DataFrame:
    """Payloads from a landing folder, one JSON object per line."""
    reader = spark.readStream if stream else spark.read
    return parse_payloads(reader.text(path), schema)


def read_kafka(
    spark: SparkSession,
    servers: str = "localhost:9092",
    topic: str = "raw-events",
    starting: str = "earliest",
    group_prefix: str = "tidewire",
    max_per_trigger: int | None = None,
) -> DataFrame:
    """Kafka topic as a stream (needs the Spark Kafka connector on the class path)."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .option("groupIdPrefix", group_prefix)
    )
    if max_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    return reader.load()


def kafka_values(records: DataFrame, schema: T.StructType) -> DataFrame:
    """Decode Kafka records (key, value, topic, timestamp) to payload columns."""
    return records.select(
        F.col("key").cast("string").alias("key"),
        "topic",
        F.col("timestamp").alias("kafka_ts"),
        F.from_json(F.col("value").cast("string"), schema).alias("_p"),
    ).select("key", "topic", "kafka_ts", "_p.*")
