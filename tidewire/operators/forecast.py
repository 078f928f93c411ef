"""Drift, linear and growth forecasts and their ensemble."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HORIZON = 30
BAND = 0.1
# Ensemble weights, given in order to the models that are present.
ENSEMBLE_WEIGHTS = (0.5, 0.3, 0.2)
MODEL_ORDER = ("linear", "growth", "drift")


def momentum_of(signals: Column) -> Column:
    """Sum of signed signal confidences, a tenth each."""

    def step(s: Column) -> Column:
        sign = F.when(s["direction"] == "bearish", -0.1).when(s["direction"] == "bullish", 0.1).otherwise(0.0)
        return sign * F.coalesce(s["confidence"], F.lit(0.5))

    return F.aggregate(F.transform(signals, step), F.lit(0.0), lambda a, x: a + x)


def trend_of(drift: Column) -> Column:
    return F.when(drift > 0.01, "bullish").when(drift < -0.01, "bearish").otherwise("neutral")


def with_trend(aggregates: DataFrame) -> DataFrame:
    """Add drift, trend and confidence to aggregates that carry a ``signals`` array."""
    return (
        aggregates.withColumn("drift", momentum_of(F.col("signals")) * 0.05)
        .withColumn("trend", trend_of(F.col("drift")))
        .withColumn("confidence", F.abs("drift") * 10 + 0.5)
    )


def drift_forecast(
    aggregates: DataFrame,
    *group: str,
    run_date: str,
    horizon: int = HORIZON,
    noise_seed: int | None = None,
) -> DataFrame:
    """Daily projection of the average sentiment along its drift.

    Noise (deviation 0.02) is off unless a seed is given.
    """
    value = F.col("avg_sentiment") + F.col("drift") * F.col("day")
    if noise_seed is not None:
        value = value + F.randn(noise_seed) * 0.02
    end = F.round(F.col("avg_sentiment") + F.col("drift") * horizon, 4)
    return (
        with_trend(aggregates)
        .select(
            *group, "avg_sentiment", "drift", "trend", "confidence",
            F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("day"),
        )
        .withColumn("_v", value)
        .select(
            *group,
            "day",
            F.date_format(F.date_add(F.lit(run_date).cast("date"), F.col("day")), "yyyy-MM-dd").alias("date"),
            F.round("_v", 4).alias("predicted_sentiment"),
            F.round(F.col("_v") - BAND, 4).alias("lower_bound"),
            F.round(F.col("_v") + BAND, 4).alias("upper_bound"),
            "trend",
            "confidence",
            F.col("avg_sentiment").alias("start"),
            end.alias("end"),
            F.round(end - F.col("avg_sentiment"), 4).alias("change"),
        )
    )


def linear_forecast(series: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """Last value carried along the least-squares slope over the index.

    One point has no slope and stays level.
    """
    fitted = series.groupBy("series_id").agg(
        F.coalesce(F.regr_slope("value", "idx"), F.lit(0.0)).alias("slope"),
        F.max_by("value", "idx").alias("last"),
    )
    return fitted.select(
        "series_id", "slope", "last", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step")
    ).select(
        "series_id",
        F.lit("linear").alias("model"),
        "step",
        (F.col("last") + F.col("slope") * F.col("step")).alias("value"),
        F.col("slope").alias("trend"),
    )


def growth_forecast(series: DataFrame, horizon: int = HORIZON, noise_seed: int | None = None) -> DataFrame:
    """Last value grown by a thousandth per step, starting with the value itself."""
    last = series.groupBy("series_id").agg(F.max_by("value", "idx").alias("last"))
    value = F.col("last") * (1 + 0.001 * (F.col("step") - 1))
    if noise_seed is not None:
        value = value + F.randn(noise_seed) * 0.01
    return (
        last.select("series_id", "last", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step"))
        .select("series_id", F.lit("growth").alias("model"), "step", value.alias("value"))
    )


def ensemble(
    forecasts: DataFrame,
    weights: Sequence[float] = ENSEMBLE_WEIGHTS,
    order: Sequence[str] = MODEL_ORDER,
) -> DataFrame:
    """Weighted mean of the models present, cut to the shortest forecast.

    ``forecasts(series_id, model, step, value)``; weights go by position to the
    models a series has and are renormalised, so ``weights`` and ``order`` name
    the models an ensemble may hold. A model that ``order`` lacks is an error, not
    left out or weighed like another. A series holds at most ``len(order)``
    forecasts of one horizon, so its group is small.
    """
    if len(weights) < len(order):
        raise ValueError("every model of the order needs a weight")
    place = F.array_position(F.array(*[F.lit(m) for m in order]), F.col("model"))
    unknown = F.raise_error(F.concat(F.lit("no weight for forecast model "), F.coalesce("model", F.lit("null"))))
    position = F.when(place > 0, place).otherwise(unknown.cast("long"))
    per_series = Window.partitionBy("series_id")
    ranked = (
        forecasts.withColumn("_m", position)
        .withColumn("_len", F.count("*").over(Window.partitionBy("series_id", "model")))
        .withColumns(
            {
                "_cut": F.min("_len").over(per_series),
                "_slot": F.dense_rank().over(per_series.orderBy("_m")),
            }
        )
        .filter(F.col("step") <= F.col("_cut"))
    )
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), F.col("_slot"))
    return ranked.groupBy("series_id", "step").agg(
        (F.sum(w * F.col("value")) / F.sum(w)).alias("value"),
        F.count("*").alias("models_used"),
    )
