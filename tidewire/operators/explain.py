"""Feature attribution and explanation texts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations
from math import factorial

from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.operators import similarity
from tidewire.operators.forecast import with_trend
from tidewire.operators.learn import MODEL_FEATURES

# Names the attribution reports for the model's features.
FEATURE_NAMES = ["sentiment", "entity_count", "text_length"]


def baseline_of(features: DataFrame) -> dict[str, float]:
    """Mean of each model feature: the point attributions are measured from."""
    row = features.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in MODEL_FEATURES]).first()
    return {c: float(row[c] or 0.0) for c in MODEL_FEATURES}


BACKGROUND_ROWS = 10  # documented bound of the background sample


def background_of(features: DataFrame, rows: int = BACKGROUND_ROWS) -> list[dict[str, float]]:
    """A bounded sample of rows, the first by a hash of the id: the points attributions are measured from."""
    by_hash = features.orderBy(F.xxhash64("event_id"), "event_id").limit(rows)
    picked = by_hash.select(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in MODEL_FEATURES]).collect()
    return [r.asDict() for r in picked]


def attribute(
    model: RandomForestClassificationModel,
    features: DataFrame,
    background: Mapping[str, float] | Sequence[Mapping[str, float]],
    target_class: int = 1,
) -> DataFrame:
    """Exact Shapley values of the three features for every row, against a background.

    The score of a coalition is the mean over the background's points, the
    features outside the coalition taken from the point; Shapley values are linear
    in it, so they are the means of the values against each point. One point (a
    mapping) is a background of one. The points are rows of a small inline table;
    each row meets them all in its own task and is averaged by id afterwards.
    """
    points = [background] if isinstance(background, Mapping) else list(background)
    names = MODEL_FEATURES
    point = F.inline(F.array(*[F.struct(*[F.lit(float(p[c])).alias(f"_b{i}") for i, c in enumerate(names)]) for p in points]))
    rows = features.select("event_id", *[F.col(c).cast("double").alias(c) for c in names], point)
    values = _coalition_values(model, rows, target_class)
    mean = values.groupBy("event_id").agg(*[F.avg(c).alias(c) for c in values.columns if c != "event_id"])
    return _attribution_rows(mean)


def _coalition_values(model: RandomForestClassificationModel, scored: DataFrame, target_class: int) -> DataFrame:
    """(event_id, base_value, _s0, _s1, _s2): Shapley values of each row against its own point.

    Each of the eight feature coalitions is one vector column scored by the
    model; the values are a weighted sum of columns.
    """
    names = MODEL_FEATURES
    size = len(names)
    subsets = [s for k in range(size + 1) for s in combinations(range(size), k)]
    kept = ["event_id", *names, *[f"_b{i}" for i in range(size)]]
    value: dict[tuple[int, ...], str] = {}
    for s in subsets:
        tag = "v" + "".join(map(str, s))
        inputs = [names[i] if i in s else f"_b{i}" for i in range(size)]
        vector = VectorAssembler(inputCols=inputs, outputCol="_x").transform(scored)
        view = model.copy()
        view.setFeaturesCol("_x").setProbabilityCol("_p").setRawPredictionCol("").setPredictionCol("")
        scored = view.transform(vector).select(
            *kept, *value.values(), vector_to_array("_p")[target_class].alias(tag)
        )
        value[s] = tag

    def shapley(i: int) -> Column:
        total = F.lit(0.0)
        for s in subsets:
            if i in s:
                continue
            weight = factorial(len(s)) * factorial(size - len(s) - 1) / factorial(size)
            joined = tuple(sorted((*s, i)))
            total = total + weight * (F.col(value[joined]) - F.col(value[s]))
        return total

    return scored.select(
        "event_id", F.col(value[()]).alias("base_value"), *[shapley(i).alias(f"_s{i}") for i in range(size)]
    )


def _attribution_rows(rows: DataFrame) -> DataFrame:
    """One row per feature, with the row's strongest feature."""
    size = len(MODEL_FEATURES)
    best = F.greatest(*[F.abs(f"_s{i}") for i in range(size)])
    top = F.lit(FEATURE_NAMES[-1])
    for i in reversed(range(size)):
        top = F.when(F.abs(f"_s{i}") == best, FEATURE_NAMES[i]).otherwise(top)
    cells = F.array(
        *[
            F.struct(
                F.lit(FEATURE_NAMES[i]).alias("feature"),
                F.round(f"_s{i}", 4).alias("shap_value"),
                F.when(F.col(f"_s{i}") > 0, "positive").otherwise("negative").alias("impact"),
            )
            for i in range(size)
        ]
    )
    return rows.select("event_id", "base_value", top.alias("top_feature"), F.inline(cells))


# Recommendation texts.
HEDGE = "Increase hedging positions. Monitor analog events for historical drawdown patterns."
EXPAND = "Consider increasing exposure. Historical analogs suggest sustained positive momentum."
HOLD = "Maintain current positioning. No strong directional signals detected."


def explain(
    aggregates: DataFrame,
    group: str,
    run_ts: str,
    event_type: str = "economic",
    paths: DataFrame | None = None,
    attributions: DataFrame | None = None,
) -> DataFrame:
    """One explanation per group from aggregates that carry a ``signals`` array.

    Analogs, trend and recommendation are computed inside the row. Optional
    ``paths(group, causal_paths)`` and ``attributions(group, feature,
    shap_value)`` are joined per group.
    """
    rows = with_trend(aggregates).withColumn(
        "_analog", similarity.ranked_analogs(F.lit(event_type), 1)[0]
    )
    if paths is not None:
        rows = rows.join(paths, group, "left")
    else:
        rows = rows.withColumn("causal_paths", F.lit(0))
    if attributions is not None:
        place = F.array_position(F.array(*[F.lit(n) for n in FEATURE_NAMES]), F.col("feature"))
        cells = attributions.groupBy(group).agg(
            F.max_by("feature", F.struct(F.abs("shap_value"), -place)).alias("_feature"),
            F.max_by("shap_value", F.struct(F.abs("shap_value"), -place)).alias("_shap"),
            F.transform(
                F.array_sort(F.collect_set(F.struct(place.alias("p"), "feature"))), lambda x: x["feature"]
            ).alias("key_factors"),
        )
        rows = rows.join(cells, group, "left")
    else:
        rows = rows.withColumns(
            {
                "_feature": F.lit(None).cast("string"),
                "_shap": F.lit(None).cast("double"),
                "key_factors": F.lit(None).cast("array<string>"),
            }
        )
    reasons = F.transform("signals", lambda s: s["reason"])
    n_paths = F.coalesce("causal_paths", F.lit(0)).cast("long")
    score = F.col("_analog.similarity_score")
    summary = F.format_string(
        "The %s prediction is primarily driven by %s (SHAP value: %.3f). "
        "This pattern resembles the %s event (similarity: %.2f). "
        "Key signal: %s. %d causal paths identified in the knowledge graph.",
        F.col("trend"),
        F.coalesce("_feature", F.lit("unknown")),
        F.round(F.coalesce("_shap", F.lit(0.0)), 3),
        F.col("_analog.name"),
        F.round(score, 2),
        F.when(F.size("signals") > 0, reasons[0]).otherwise("No strong signals"),
        n_paths,
    )
    alarmed = F.exists("signals", lambda s: s["severity"] == "high")
    return rows.select(
        group,
        F.lit(run_ts).alias("generated_at"),
        summary.alias("summary"),
        F.coalesce("key_factors", F.array().cast("array<string>")).alias("key_factors"),
        F.col("_analog.name").alias("analog_event"),
        score.alias("analog_similarity"),
        n_paths.alias("causal_paths"),
        F.slice(reasons, 1, 3).alias("active_signals"),
        "confidence",
        F.when((F.col("trend") == "bearish") & alarmed, HEDGE)
        .when(F.col("trend") == "bullish", EXPAND)
        .otherwise(HOLD)
        .alias("recommendation"),
    )
