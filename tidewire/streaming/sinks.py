"""Sinks: envelopes, idempotent batch writes, the growing graph, live scoring."""

from __future__ import annotations

from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidewire.operators import graph, similarity
from tidewire.operators.vector_index import VectorIndex, search_index
from tidewire.session import cut_lineage, scratch_dir, scratch_scope

BatchFn = Callable[[DataFrame, int], None]


def envelope(df: DataFrame, pipeline: str, ts: str, kind: str = "pipeline_update") -> DataFrame:
    """Push messages ``(key, value)``: the row as JSON inside a typed envelope."""
    data = F.struct(*[c for c in df.columns if c != "event_id"])
    message = F.struct(
        F.lit(kind).alias("type"),
        F.lit(pipeline).alias("pipeline"),
        F.col("event_id").cast("string").alias("event_id"),
        data.alias("data"),
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
    )
    return df.select(F.col("event_id").cast("string").alias("key"), F.to_json(message).alias("value"))


def to_kafka(messages: DataFrame, checkpoint: str, servers: str = "localhost:9092", topic: str = "enriched-events"):
    """Start writing ``(key, value)`` messages to a topic (needs the Kafka connector)."""
    return (
        messages.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .start()
    )


def write_table(df: DataFrame, path: str, by: str, mode: str = "append") -> None:
    """Partitioned parquet. Adaptive execution brings a partition value's rows together
    and splits them again by size, so a day is written by as many tasks as it needs."""
    df.hint("rebalance", by).write.mode(mode).partitionBy(by).parquet(path)


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", **options: str) -> None:
    df.write.format("jdbc").options(url=url, dbtable=table, **options).mode(mode).save()


def batch_writer(path: str, by: str) -> BatchFn:
    """``foreachBatch`` sink that overwrites its own batch folder, so a replayed
    batch replaces itself instead of doubling."""

    def write(batch: DataFrame, batch_id: int) -> None:
        write_table(batch, f"{path}/batch_id={batch_id}", by, mode="overwrite")

    return write


def graph_writer(root: str) -> BatchFn:
    """``foreachBatch`` sink for a growing graph.

    A batch only appends its own nodes and edges (replays overwrite them); the
    newest version of an edge is chosen when the graph is read.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        folder = f"batch_id={batch_id}"
        narrow = batch.select("event_id", "title", "source", "published", "url", "entities", "sentiment")
        with scratch_scope(batch.sparkSession):
            rows = cut_lineage(narrow, "graph-batch")
            nodes = graph.build_nodes(rows).select("id", "type", "label")
            edges = graph.merge_edges(graph.build_edges(rows))
            nodes.write.mode("overwrite").parquet(f"{root}/nodes/{folder}")
            edges.write.mode("overwrite").parquet(f"{root}/edges/{folder}")

    return write


def stored_edges(spark: SparkSession, root: str) -> DataFrame:
    """Current edges: the last batch wins per (source, target)."""
    log = spark.read.parquet(f"{root}/edges")
    return graph.merge_edges(log, order="batch_id")


def stored_nodes(spark: SparkSession, root: str) -> DataFrame:
    log = spark.read.parquet(f"{root}/nodes")
    row = F.struct("type", "label")
    return log.groupBy("id").agg(F.max_by(row, F.struct("batch_id", "label")).alias("_r")).select("id", "_r.*")


def write_counted(df: DataFrame, path: str, *by: str, mode: str = "append") -> int:
    """Write a table, partitioned by some columns, and return the rows that this very write has put there."""
    counts = Observation()
    df.observe(counts, F.count("*").alias("rows")).write.partitionBy(*by).mode(mode).parquet(path)
    try:
        return counts.get["rows"]
    except Py4JJavaError:  # a table known to be empty when planned: the counting was planned away with it
        return 0


def compact_graph(spark: SparkSession, root: str, new_root: str) -> None:
    """Rewrite the graph log as one version."""
    stored_nodes(spark, root).write.parquet(f"{new_root}/nodes/batch_id=0")
    stored_edges(spark, root).write.parquet(f"{new_root}/edges/batch_id=0")


def scoring_writer(index: VectorIndex, out: str, k: int = 20, threshold: float = 0.0, exact: bool = True) -> BatchFn:
    """``foreachBatch`` body of live scoring.

    ``batch(event_id, embedding, event_ts)`` is searched in a stored ``index``, so
    a batch reads the partitions that its events probe (and with ``exact`` those
    that could hold a better hit) and not the corpus; the live event becomes a
    node, its hits edges, an impact score and a push message. What a batch wrote
    meanwhile goes with it.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        with scratch_scope(batch.sparkSession):
            score(cut_lineage(batch, "live"), f"batch_id={batch_id}")

    def score(batch: DataFrame, folder: str) -> None:
        found = search_index(batch, index, k, query_id="event_id", exact=exact)
        hits = cut_lineage(found, "hits").filter(F.col("score") >= threshold)
        events = batch.select(F.col("event_id").alias("query_id"), "event_ts")
        impact = similarity.impact_scores(hits, events)
        impact.write.mode("overwrite").parquet(f"{out}/impact/{folder}")
        live = batch.select(F.col("event_id").alias("id"), F.lit("event").alias("type"), "event_ts")
        live.write.mode("overwrite").parquet(f"{out}/nodes/{folder}")
        links = hits.select(
            F.col("query_id").alias("source"), F.col("hit_id").alias("target"),
            F.lit("similar_to").alias("type"), F.lit("SIMILAR_TO").alias("relation"),
            F.col("score").alias("weight"),
        )
        links.write.mode("overwrite").parquet(f"{out}/edges/{folder}")
        pushed = impact.withColumnRenamed("query_id", "event_id").join(
            events.withColumnRenamed("query_id", "event_id"), "event_id"
        )
        envelope(pushed, "realtime", "event_ts").write.mode("overwrite").parquet(f"{out}/push/{folder}")

    return write


def prepared(write: BatchFn, prepare: Callable[[DataFrame], DataFrame]) -> BatchFn:
    """Run ``prepare`` on each batch before it is written."""
    return lambda batch, batch_id: write(prepare(batch), batch_id)


def run_batches(stream: DataFrame, write: BatchFn, label: str) -> None:
    """Drain a stream through a ``foreachBatch`` sink."""
    state = scratch_dir(stream.sparkSession, f"{label}-state")
    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
