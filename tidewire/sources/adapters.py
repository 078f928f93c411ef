"""Adapters from the given tables to the canonical article, price and run tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ARTICLE_COLUMNS = [
    "event_id", "source", "event_type", "event_ts", "title", "content",
    "description", "url", "source_name", "language", "published",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def arrival_time(key: Column) -> Column:
    """Arrival time of a record that carries none: ids are laid over 30 days in
    steps of 7919 seconds. A rule on the id needs no join, so the text column
    is never shuffled just to be dated."""
    return F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        secs=F.pmod(F.pmod(key, F.lit(2592000)) * 7919, F.lit(2592000)).cast("decimal(18,6)")
    )


def published_text(key: Column, ts: Column) -> Column:
    """Publication time in the spellings feeds use: ISO with Z, ISO with an
    offset, mail style, junk and missing."""
    shifted = ts + F.make_dt_interval(hours=F.lit(5), mins=F.lit(30))
    iso = "yyyy-MM-dd'T'HH:mm:ss"
    return (
        F.when(key % 17 == 9, F.lit(None).cast("string"))
        .when(key % 13 == 7, F.lit("n/a"))
        .when(
            key % 11 == 5,
            F.concat(F.date_format(ts, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" +0000")),
        )
        .when(key % 7 == 3, F.concat(F.date_format(shifted, iso), F.lit("+05:30")))
        .otherwise(F.concat(F.date_format(ts, iso), F.lit("Z")))
    )


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return articles_of(table(spark, sf_dir, "documents"))


def articles_of(documents: DataFrame) -> DataFrame:
    """``documents`` (batch or stream) as articles: the first line is the title,
    the text the content."""
    key, ts = F.col("doc_id"), F.col("event_ts")
    return (
        documents.withColumn("event_ts", arrival_time(key))
        .select(
            key.cast("string").alias("event_id"),
            F.lit("documents").alias("source"),
            F.lit("news_article").alias("event_type"),
            ts,
            F.substring_index("text", "\n", 1).alias("title"),
            F.col("text").alias("content"),
            F.lit(None).cast("string").alias("description"),
            F.lit("").alias("url"),
            F.col("source").alias("source_name"),
            F.col("lang").alias("language"),
            published_text(key, ts).alias("published"),
        )
    )


def page_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pages`` as url-bearing articles; the title is the page's ``<title>``."""
    return table(spark, sf_dir, "pages").select(
        F.concat(F.lit("page:"), F.col("page_id").cast("string")).alias("event_id"),
        F.lit("pages").alias("source"),
        F.lit("web_page").alias("event_type"),
        arrival_time(F.col("page_id")).alias("event_ts"),
        F.regexp_extract("html", r"<title>([^<]*)</title>", 1).alias("title"),
        F.col("html").alias("content"),
        F.col("url"),
    )


def conversation_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``conversations`` as incoming payloads without title or url."""
    return table(spark, sf_dir, "conversations").select(
        F.concat(
            F.lit("turn:"),
            F.col("conv_id").cast("string"),
            F.lit("/"),
            F.col("turn").cast("string"),
        ).alias("event_id"),
        F.lit("conversations").alias("source"),
        F.lit("incoming").alias("event_type"),
        F.col("text").alias("content"),
    )


def daily_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily mean event value per event type: ``series_id, idx, value``."""
    day = F.to_date("ts")
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.col("event_type").alias("series_id"), day.alias("day"))
        .agg(F.round(F.avg("value"), 6).alias("value"))
        .select(
            "series_id",
            F.date_diff(F.col("day"), F.lit("2024-01-01").cast("date")).alias("idx"),
            "value",
        )
    )


def daily_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One price per day: the mean value of the day's events."""
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.to_date("ts").alias("day"))
        .agg(F.round(F.avg("value"), 6).alias("act"))
    )


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` read as a log of runs: an ``error`` event is a failed run."""
    seconds = F.col("value").cast("decimal(18,6)")
    failed = F.col("event_type") == "error"
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("run_id"),
        F.col("event_type").alias("pipeline"),
        F.when(failed, "failed").otherwise("success").alias("status"),
        F.col("ts").alias("started_at"),
        (F.col("ts") + F.make_dt_interval(secs=seconds)).alias("completed_at"),
        F.when(failed, F.concat(F.lit("user "), F.col("user_id").cast("string"))).alias("error"),
        F.create_map(F.lit("value"), F.col("value")).alias("metrics"),
    )


def supply_graph(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Order -> supplier / customer -> nation -> region as (nodes, edges)."""

    def node(prefix: str, key: str) -> Column:
        return F.concat(F.lit(f"{prefix}:"), F.col(key).cast("string"))

    def edges_of(df: DataFrame, src: Column, dst: Column, relation: str, weight: Column) -> DataFrame:
        return df.select(
            src.alias("source"),
            dst.alias("target"),
            F.lit("link").alias("type"),
            F.lit(relation).alias("relation"),
            weight.alias("weight"),
        )

    customer = table(spark, sf_dir, "customer")
    supplier = table(spark, sf_dir, "supplier")
    orders = table(spark, sf_dir, "orders")
    nation = table(spark, sf_dir, "nation")
    shipped = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey", "l_suppkey")
        .agg(F.sum("l_quantity").alias("qty"))
    )
    one = F.lit(1.0)
    edges = (
        edges_of(shipped, node("order", "l_orderkey"), node("supplier", "l_suppkey"), "SHIPPED_BY", F.col("qty"))
        .unionByName(
            edges_of(orders, node("order", "o_orderkey"), node("customer", "o_custkey"), "PLACED_BY", one)
        )
        .unionByName(
            edges_of(supplier, node("supplier", "s_suppkey"), node("nation", "s_nationkey"), "LOCATED_IN", one)
        )
        .unionByName(
            edges_of(customer, node("customer", "c_custkey"), node("nation", "c_nationkey"), "LOCATED_IN", one)
        )
        .unionByName(
            edges_of(nation, node("nation", "n_nationkey"), node("region", "n_regionkey"), "LOCATED_IN", one)
        )
    )
    nodes = (
        orders.select(node("order", "o_orderkey").alias("id"), F.lit("order").alias("type"))
        .unionByName(customer.select(node("customer", "c_custkey").alias("id"), F.lit("customer").alias("type")))
        .unionByName(supplier.select(node("supplier", "s_suppkey").alias("id"), F.lit("supplier").alias("type")))
        .unionByName(nation.select(node("nation", "n_nationkey").alias("id"), F.lit("nation").alias("type")))
        .unionByName(
            table(spark, sf_dir, "region").select(
                node("region", "r_regionkey").alias("id"), F.lit("region").alias("type")
            )
        )
    )
    return nodes, edges
