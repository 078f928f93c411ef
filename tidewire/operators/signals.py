"""Rule signals from feature aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.operators.features import feature_sums, ratios_from_sums

# Thresholds of the rules. The reason texts below are fixed values too.
THRESHOLDS = {
    "strong_bearish": -0.5,
    "bearish": -0.2,
    "strong_bullish": 1.0,
}
MIN_CONFIDENCE = 0.3


def two_decimals(value: Column) -> Column:
    return F.format_string("%.2f", F.round(value, 2))


def _signal(kind: str, severity: str, direction: str, confidence: Column, reason: Column) -> Column:
    return F.struct(
        F.lit(kind).alias("type"),
        F.lit(severity).alias("severity"),
        F.lit(direction).alias("direction"),
        confidence.cast("double").alias("confidence"),
        reason.alias("reason"),
    )


def rule_signals() -> Column:
    """Array of the signals that fire on one row of aggregates, in rule order."""
    avg, neg, geo = F.col("avg_sentiment"), F.col("negative_ratio"), F.col("geo_ratio")
    shown = two_decimals(avg)

    def said(text: str) -> Column:
        return F.concat(F.lit(f"{text} ("), shown, F.lit(")"))

    percent = F.format_string("%d%%", F.round(neg * 100).cast("long"))
    return F.array_compact(
        F.array(
            F.when(
                avg <= THRESHOLDS["strong_bearish"],
                _signal("market_risk", "high", "bearish", F.abs(avg), said("Strong negative sentiment")),
            ).when(
                avg <= THRESHOLDS["bearish"],
                _signal("market_risk", "medium", "bearish", F.abs(avg), said("Negative sentiment")),
            ),
            F.when(
                avg >= THRESHOLDS["strong_bullish"],
                _signal("market_opportunity", "high", "bullish", avg, said("Strong positive sentiment")),
            ),
            F.when(
                neg > 0.6,
                _signal(
                    "negative_surge", "high", "bearish", neg,
                    F.concat(F.lit("Negative ratio "), percent, F.lit(" exceeds threshold")),
                ),
            ),
            F.when(
                geo > 0.5,
                _signal(
                    "geopolitical_activity", "medium", "neutral", geo,
                    F.lit("High geographic diversity in events"),
                ),
            ),
        )
    )


def daily_rule_signals() -> Column:
    """Array of the daily signals that fire on one row of daily aggregates."""
    avg, entities = F.col("avg_sentiment"), F.col("avg_entities")

    def said(text: str) -> Column:
        return F.concat(F.lit("Daily aggregate sentiment "), two_decimals(avg), F.lit(f" {text}"))

    return F.array_compact(
        F.array(
            F.when(
                avg < -0.3,
                _signal("market_risk", "high", "bearish", F.abs(avg), said("indicates elevated risk")),
            ).when(
                avg < -0.1,
                _signal("market_caution", "medium", "bearish", F.abs(avg), said("suggests caution")),
            ),
            F.when(
                avg > 0.3,
                _signal("market_opportunity", "medium", "bullish", avg, said("indicates opportunity")),
            ),
            F.when(
                entities > 3,
                _signal(
                    "high_entity_density", "low", "neutral", F.least(entities / 10, F.lit(1.0)),
                    F.lit("High entity density suggests complex multi-actor event"),
                ),
            ),
        )
    )


def _one_row_per_signal(df: DataFrame, fired: Column, group: tuple[str, ...]) -> DataFrame:
    return df.select(*group, F.posexplode(fired).alias("ord", "s")).select(*group, "ord", "s.*")


def generate_signals(aggregates: DataFrame, *group: str) -> DataFrame:
    return _one_row_per_signal(aggregates, rule_signals(), group)


def generate_daily_signals(daily: DataFrame, *group: str) -> DataFrame:
    return _one_row_per_signal(daily, daily_rule_signals(), group)


def with_signals(aggregates: DataFrame) -> DataFrame:
    """Aggregates with their signals as an array column, for operators that need both."""
    return aggregates.withColumn("signals", rule_signals())


def collect_signals(aggregates: DataFrame, signals: DataFrame, *group: str) -> DataFrame:
    """Aggregates with the signals of a stored signal table as an array column.

    A group holds at most one signal per rule, so the arrays are short.
    """
    parts = ("type", "severity", "direction", "confidence", "reason")
    listed = signals.groupBy(*group).agg(
        F.sort_array(F.collect_list(F.struct("ord", *parts))).alias("_s")
    )
    arrays = listed.select(
        *group,
        F.transform("_s", lambda x: F.struct(*[x[p].alias(p) for p in parts])).alias("signals"),
    )
    empty = F.array().cast(arrays.schema["signals"].dataType)
    return aggregates.join(arrays, list(group), "left").withColumn(
        "signals", F.coalesce("signals", empty)
    )


def rolling_aggregates(features: DataFrame, *group: str, days: int = 7) -> DataFrame:
    """Aggregates over the trailing ``days`` calendar days, for every day with events.

    Features are summed to one row per (group, day) first; the window then runs
    over days, not events, and adds sums and counts so that ratios stay exact.
    """
    sums = (
        features.withColumn("day", F.to_date("event_ts"))
        .groupBy(*group, "day")
        .agg(*feature_sums())
        .withColumn("_n", F.unix_date("day"))
    )
    frame = Window.partitionBy(*group).orderBy("_n").rangeBetween(-(days - 1), 0)
    added = [c for c in sums.columns if c not in (*group, "day", "_n")]
    rolled = sums.select(*group, "day", *[F.sum(c).over(frame).alias(c) for c in added])
    return ratios_from_sums(rolled, *group, "day")


def rolling_signals(features: DataFrame, *group: str, days: int = 7) -> DataFrame:
    return generate_signals(rolling_aggregates(features, *group, days=days), *group, "day")


def filter_signals(signals: DataFrame, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Keep confident signals; works on batch and streaming frames alike."""
    return signals.filter(F.coalesce("confidence", F.lit(0.0)) >= min_confidence)
