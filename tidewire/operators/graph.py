"""Knowledge graph: nodes, edges, statistics and centrality.

A graph is two tables, ``nodes(id, type, label, ...)`` and
``edges(source, target, type, relation, weight)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.functions import text as t
from tidewire.session import cut_lineage

# Edge weights and the sentiment below which a market is affected.
COUNTRY_WEIGHT = 0.8
ORG_WEIGHT = 0.7
DAILY_ORG_WEIGHT = 0.6
AFFECTS_BELOW = -0.3
MARKET_NODE = "market:global"


def _mentioned_entities(df: DataFrame) -> DataFrame:
    """(event_id, kind, name): one narrow row per mention."""

    def tagged(kind: str, names: str) -> Column:
        return F.transform(names, lambda n: F.struct(F.lit(kind).alias("kind"), n.alias("name")))

    both = F.concat(
        tagged("country", "entities.countries"), tagged("organization", "entities.organizations")
    )
    return df.select("event_id", F.inline(both))


def _entity_id() -> Column:
    prefix = F.when(F.col("kind") == "country", "country").otherwise("org")
    key = F.replace(F.lower("name"), F.lit(" "), F.lit("_"))
    return F.concat(prefix, F.lit(":"), key)


def build_nodes(df: DataFrame) -> DataFrame:
    """Event nodes plus distinct country and organisation nodes.

    ``event_id`` is the key of the articles, so only the entity mentions go
    through a (map-side combined) aggregation; event rows are not shuffled.
    """
    text = F.lit(None).cast("string")
    events = df.select(
        F.col("event_id").alias("id"),
        F.lit("event").alias("type"),
        F.substring(F.coalesce("title", F.lit("Untitled Event")), 1, 80).alias("label"),
        F.coalesce("source", F.lit("unknown")).alias("source"),
        F.coalesce("published", F.lit("")).alias("published"),
        F.coalesce("sentiment.score", F.lit(0.0)).alias("sentiment"),
        F.coalesce("url", F.lit("")).alias("url"),
        (F.coalesce("summary", F.lit("")) if "summary" in df.columns else F.lit("")).alias("summary"),
    )
    entities = (
        _mentioned_entities(df)
        .groupBy(_entity_id().alias("id"))
        .agg(F.min("kind").alias("type"), F.min("name").alias("label"))
        .select(
            "id", "type", "label",
            text.alias("source"), text.alias("published"),
            F.lit(None).cast("double").alias("sentiment"),
            text.alias("url"), text.alias("summary"),
        )
    )
    return events.unionByName(entities)


def _mention_edges(df: DataFrame, org_weight: float) -> DataFrame:
    return _mentioned_entities(df).select(
        F.col("event_id").alias("source"),
        _entity_id().alias("target"),
        F.lit("mentions").alias("type"),
        F.lit("MENTIONS").alias("relation"),
        F.when(F.col("kind") == "country", COUNTRY_WEIGHT).otherwise(org_weight).alias("weight"),
    )


def build_edges(df: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """MENTIONS edges to existing entity nodes, AFFECTS edges to the global market.

    Without ``nodes`` the targets are the articles' own entities, which exist by
    construction, and no join is needed. With ``nodes`` the mentions are
    semi-joined; the node side is unique on its id, so a hot target is a skewed
    left side that adaptive execution splits.
    """
    mentions = _mention_edges(df, ORG_WEIGHT)
    if nodes is not None:
        known = nodes.filter(F.col("type") != "event").select(F.col("id").alias("target"))
        mentions = mentions.join(known, "target", "left_semi").select(
            "source", "target", "type", "relation", "weight"
        )
    score = F.col("sentiment.score")
    affects = df.filter(score < AFFECTS_BELOW).select(
        F.col("event_id").alias("source"),
        F.lit(MARKET_NODE).alias("target"),
        F.lit("affects").alias("type"),
        F.lit("AFFECTS").alias("relation"),
        F.abs(score).alias("weight"),
    )
    return mentions.unionByName(affects)


def merge_edges(edges: DataFrame, order: str | None = None) -> DataFrame:
    """One edge per (source, target): the last by ``order`` wins.

    Without an order column the heaviest edge (then the greatest relation) is kept.
    """
    attributes = F.struct("type", "relation", "weight")
    rank = F.col(order) if order else F.struct("weight", "relation", "type")
    return (
        edges.groupBy("source", "target")
        .agg(F.max_by(attributes, rank).alias("_a"))
        .select("source", "target", "_a.*")
    )


def all_node_ids(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Ids of listed nodes and of edge endpoints."""
    ends = edges.select(F.explode(F.array("source", "target")).alias("id"))
    return nodes.select("id").unionByName(ends).distinct()


def graph_stats(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Node count, edge count and directed density (0 for fewer than two nodes)."""
    m = edges.select("source", "target").distinct().agg(F.count("*").alias("edges"))
    counted = all_node_ids(nodes, edges).agg(F.count("*").alias("nodes"))
    n = F.col("nodes")
    return counted.select("nodes", m.scalar().alias("edges")).withColumn(
        "density",
        F.when(n > 1, F.round(F.col("edges") / (n.cast("double") * (n - 1)), 4)).otherwise(F.lit(0.0)),
    )


def _degrees(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, degree) in one aggregation: listed nodes count zero, endpoints one.

    Partial counts are combined map-side, so a hub costs one row per task.
    """
    ends = (
        edges.select("source", "target")
        .distinct()
        .select(F.explode(F.array("source", "target")).alias("id"), F.lit(1).alias("d"))
    )
    listed = nodes.select("id", F.lit(0).alias("d"))
    return ends.unionByName(listed).groupBy("id").agg(F.sum("d").alias("degree"))


def centrality(nodes: DataFrame, edges: DataFrame, top: int = 10) -> DataFrame:
    """Top nodes by degree centrality, with the average degree of the graph."""
    degrees = cut_lineage(_degrees(nodes, edges), "degrees")
    whole = degrees.agg(F.struct(F.count("*").alias("n"), F.sum("degree").alias("s"))).scalar()
    n, s = whole["n"], whole["s"]
    return (
        degrees.orderBy(F.col("degree").desc(), "id")
        .limit(top)
        .select(
            "id",
            F.when(n > 1, F.round(F.col("degree") / (n - 1), 4)).otherwise(F.lit(1.0)).alias("centrality"),
            F.round(s / n, 2).alias("avg_degree"),
        )
    )


def daily_graph(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes and merged edges of one day's enriched articles."""
    edges = merge_edges(_mention_edges(df, DAILY_ORG_WEIGHT))
    return df.select(F.col("event_id").alias("id"), F.lit("event").alias("type")), edges


def upsert_edges(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """Stored edges with fresh ones laid over them; the newest version wins."""
    both = stored.withColumn("_v", F.lit(0)).unionByName(fresh.withColumn("_v", F.lit(1)))
    rank = F.struct("_v", "weight", "relation", "type")
    return (
        both.groupBy("source", "target")
        .agg(F.max_by(F.struct("type", "relation", "weight"), rank).alias("_a"))
        .select("source", "target", "_a.*")
    )
