"""Feature vectors, their aggregates and snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.functions import temporal
from tidewire.session import cut_lineage

# Scores carry four decimals: summed as whole ten-thousandths the result does
# not depend on the order in which partial sums meet.
SCORE_UNIT = 10000
BROADCAST_GROUPS = 10_000  # aggregate rows that are shipped to every task
JOIN_SALTS = 32


def extract_features(df: DataFrame) -> DataFrame:
    """One narrow feature row per article; text and arrays are left behind.

    Missing inputs (no sentiment, entities, locations or embedding column) give
    the neutral value. The embedding spread is the population deviation.
    """
    has = set(df.columns).__contains__
    zero = F.lit(0)
    extra = [c for c in ("event_ts", "language", "source_name", "dedup_key") if has(c)]
    out = temporal.read_published(df) if has("published") else df.withColumn(
        "pub_local", F.lit(None).cast("timestamp_ntz")
    )
    if has("embedding"):
        n = F.size("embedding")
        vec = F.transform("embedding", lambda x: x.cast("double"))
        total = F.aggregate(vec, F.lit(0.0), lambda a, x: a + x)
        out = out.withColumn("embedding_mean", F.when(n > 0, total / n)).withColumn(
            "embedding_std",
            F.when(
                n > 0,
                F.sqrt(
                    F.aggregate(
                        vec,
                        F.lit(0.0),
                        lambda a, x: a
                        + (x - F.col("embedding_mean")) * (x - F.col("embedding_mean")),
                    )
                    / n
                ),
            ),
        )
    else:
        missing = F.lit(None).cast("double")
        out = out.withColumn("embedding_mean", missing).withColumn("embedding_std", missing)
    return out.select(
        "event_id",
        *extra,
        (F.coalesce("sentiment.score", F.lit(0.0)) if has("sentiment") else F.lit(0.0)).alias("sentiment_score"),
        (F.coalesce("sentiment.label", F.lit("neutral")) if has("sentiment") else F.lit("neutral")).alias(
            "sentiment_label"
        ),
        (
            F.coalesce(F.size("entities.countries") + F.size("entities.organizations"), zero)
            if has("entities")
            else zero
        ).alias("entity_count"),
        F.length(F.coalesce("content", F.lit(""))).alias("text_length"),
        (F.when(F.size("locations") > 0, 1).otherwise(0) if has("locations") else zero).alias("has_geo"),
        F.coalesce(F.hour("pub_local"), zero).alias("hour_of_day"),
        F.coalesce(temporal.weekday_number(F.col("pub_local")), zero).alias("day_of_week"),
        (F.when(F.col("embedding").isNotNull(), 1).otherwise(0) if has("embedding") else zero).alias("has_embedding"),
        "embedding_mean",
        "embedding_std",
    )


def feature_sums() -> list[Column]:
    """Partial sums every aggregate is made of; all integers, so exact and mergeable."""
    return [
        F.count("*").alias("total_events"),
        F.sum(F.round(F.col("sentiment_score") * SCORE_UNIT).cast("long")).alias("score_sum"),
        F.count_if(F.col("sentiment_label") == "positive").alias("n_positive"),
        F.count_if(F.col("sentiment_label") == "negative").alias("n_negative"),
        F.sum(F.col("entity_count").cast("long")).alias("entity_sum"),
        F.sum(F.col("has_geo").cast("long")).alias("geo_sum"),
    ]


def ratios_from_sums(df: DataFrame, *keep: str) -> DataFrame:
    n = F.col("total_events")
    return df.filter(n > 0).select(
        *keep,
        "total_events",
        (F.col("score_sum") / F.lit(float(SCORE_UNIT)) / n).alias("avg_sentiment"),
        (F.col("n_positive") / n).alias("positive_ratio"),
        (F.col("n_negative") / n).alias("negative_ratio"),
        (F.col("entity_sum") / n).alias("avg_entity_count"),
        (F.col("geo_sum") / n).alias("geo_ratio"),
    )


def aggregate_features(features: DataFrame, *group: str) -> DataFrame:
    """Means and ratios over all features, or per group. No rows give no aggregate."""
    return ratios_from_sums(features.groupBy(*group).agg(*feature_sums()), *group)


def daily_features(features: DataFrame, *group: str) -> DataFrame:
    """Average sentiment, average entities and event count per day (and group)."""
    by_day = features.withColumn("day", F.to_date("event_ts"))
    return aggregate_features(by_day, "day", *group).select(
        "day", *group, "avg_sentiment", F.col("avg_entity_count").alias("avg_entities"), "total_events"
    )


def snapshot(features: DataFrame, aggregates: DataFrame, group: str, run_ts: str) -> DataFrame:
    """Features of each event with its group's aggregates and signals.

    ``aggregates`` carries the group's ``signals`` array (bounded by the number
    of rules). It is written first and counted: up to ``BROADCAST_GROUPS`` groups
    are broadcast, so no feature row moves; more are joined on the group and a
    salt, each group's row in as many copies, so a hot group meets many tasks.
    """
    aggregates = cut_lineage(aggregates, "groups")
    packed = aggregates.select(
        group,
        "signals",
        F.struct(*[c for c in aggregates.columns if c not in (group, "signals")]).alias("aggregates"),
    )
    columns = [c for c in features.columns if c not in ("event_id", group)]
    if aggregates.limit(BROADCAST_GROUPS + 1).count() <= BROADCAST_GROUPS:
        joined = features.join(F.broadcast(packed), group, "left")
    else:
        salt = F.pmod(F.xxhash64("event_id"), F.lit(JOIN_SALTS))
        copies = packed.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(JOIN_SALTS - 1))).cast("bigint"))
        joined = features.withColumn("_salt", salt).join(copies, [group, "_salt"], "left")
    return joined.select(
        "event_id",
        group,
        F.struct(*columns).alias("features"),
        "signals",
        "aggregates",
        F.lit(run_ts).alias("timestamp"),
    )


def latest_snapshot(snapshots: DataFrame, key: str = "event_id") -> DataFrame:
    row = F.struct(*[c for c in snapshots.columns if c != key])
    return snapshots.groupBy(key).agg(F.max_by(row, "timestamp").alias("_r")).select(key, "_r.*")
