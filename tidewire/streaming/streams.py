"""Streaming forms of the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.operators.clean import dedup_key
from tidewire.operators.features import feature_sums, ratios_from_sums
from tidewire.operators.signals import rule_signals
from tidewire.session import scratch_dir


def stream_table(
    spark: SparkSession, sf_dir: str, name: str, files_per_trigger: int | None = None
) -> DataFrame:
    """A parquet table as a stream with the table's own schema.

    The path is a pattern: a file stream takes a folder or a pattern, and the
    table may be a folder of part files or one file.
    """
    path = f"{sf_dir}/{name}.parquet"
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(f"{path}*")


def event_time(df: DataFrame, column: str, delay: str) -> DataFrame:
    """Zone-less times become instants, which is what a watermark needs."""
    return df.withColumn(column, F.col(column).cast("timestamp")).withWatermark(column, delay)


def dedup_stream(df: DataFrame, delay: str = "1 day", salts: int | None = None) -> DataFrame:
    """First article per key within the watermark.

    Two rounds: copies are first dropped per (key, salt), which spreads a hot
    key over ``salts`` tasks (by default as many as the shuffle has), then the
    survivors per key meet. The number of salts belongs to the stream's state, so
    a stream keeps it between restarts, as it keeps its shuffle width.
    """
    salts = salts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = event_time(df.withColumn("dedup_key", dedup_key()), "event_ts", delay)
    salted = keyed.withColumn("_salt", F.pmod(F.xxhash64("event_id"), F.lit(salts)))
    return (
        salted.dropDuplicatesWithinWatermark(["dedup_key", "_salt"])
        .drop("_salt")
        .dropDuplicatesWithinWatermark(["dedup_key"])
    )


def mark_processed(df: DataFrame, ts: str) -> DataFrame:
    """Processing flag and latency in milliseconds since the event's own time."""
    return df.withColumns(
        {
            "stream_processed": F.lit(True),
            "processing_latency_ms": F.unix_millis(F.current_timestamp())
            - F.unix_millis(F.col(ts).cast("timestamp")),
        }
    )


def windowed_sums(features: DataFrame, group: str, delay: str, length: str, slide: str) -> DataFrame:
    """Partial sums per window and group.

    Rows are summed once, into tumbling windows of ``slide``; sliding windows are
    then made of these few sums. (A row in each window that covers it would be
    ``length / slide`` copies of every row.) ``length`` must be a multiple of ``slide``.
    """
    sums = feature_sums()
    steps = (
        event_time(features, "event_ts", delay)
        .groupBy(F.window("event_ts", slide).alias("w"), group)
        .agg(*sums)
    )
    if length == slide:
        return steps
    names = [c for c in steps.columns if c not in ("w", group)]
    return steps.groupBy(F.window(F.window_time("w"), length, slide).alias("w"), group).agg(*[F.sum(c).alias(c) for c in names])


def windowed_signals(
    features: DataFrame,
    group: str,
    delay: str = "1 day",
    length: str = "7 days",
    slide: str = "1 day",
) -> DataFrame:
    """Rule signals per sliding window and group, emitted when the window closes.

    Rows later than the watermark are dropped. ``length == slide`` gives tumbling
    windows, such as one per day.
    """
    sums = windowed_sums(features, group, delay, length, slide)
    rows = sums.withColumns({"window_start": F.col("w.start"), "window_end": F.col("w.end")}).drop("w")
    keys = ("window_start", "window_end", group)
    return (
        ratios_from_sums(rows, *keys)
        .select(*keys, F.posexplode(rule_signals()).alias("ord", "s"))
        .select(*keys, "ord", "s.*")
    )


def drain(stream: DataFrame, label: str) -> DataFrame:
    """Run a stream over everything available into a file sink and read it back."""
    spark = stream.sparkSession
    out, state = scratch_dir(spark, label), scratch_dir(spark, f"{label}-state")
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", out)
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)
