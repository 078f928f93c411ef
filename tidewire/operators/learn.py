"""Label encoding, splitting, forest training, evaluation and the model registry."""

from __future__ import annotations

import json

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.session import cut_lineage

MODEL_FEATURES = ["sentiment_score", "entity_count", "text_length"]
CLASSES = (0, 1, 2)
MIN_TRAIN_ROWS = 10
MIN_EVAL_ROWS = 5


def class_of(label: Column) -> Column:
    return F.when(label == "positive", 1).when(label == "negative", 0).otherwise(2)


def encode_and_split(features: DataFrame, train_tenths: int = 8) -> DataFrame:
    """Add ``label`` and ``is_train``. The split hashes the id, so a row keeps its
    side however the data is partitioned."""
    bucket = F.pmod(F.conv(F.substring(F.md5("event_id"), 1, 8), 16, 10).cast("long"), F.lit(10))
    return features.withColumns(
        {"label": class_of(F.col("sentiment_label")), "is_train": bucket < train_tenths}
    )


def assemble(df: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=MODEL_FEATURES, outputCol="features").transform(df)


def train_forest(
    features: DataFrame, trees: int = 100, depth: int = 10, seed: int = 42
) -> tuple[RandomForestClassificationModel | None, DataFrame]:
    """Train on the hashed split; returns the model and a one-row metrics table.

    The narrow features are written once: training passes over them several
    times and must not re-read the texts. Fewer than ten rows: skipped.
    """
    schema = (
        "status string, train_accuracy double, test_accuracy double, "
        "train_samples long, test_samples long, feature_dim int"
    )
    split = encode_and_split(features).select("event_id", "label", "is_train", *MODEL_FEATURES)
    data = assemble(cut_lineage(split, "train"))
    spark = features.sparkSession
    if data.limit(MIN_TRAIN_ROWS).count() < MIN_TRAIN_ROWS:
        return None, spark.createDataFrame([("skipped", None, None, None, None, None)], schema)
    forest = RandomForestClassifier(
        numTrees=trees, maxDepth=depth, seed=seed, featuresCol="features", labelCol="label"
    )
    model = forest.fit(data.filter("is_train"))
    right = (F.col("prediction") == F.col("label")).cast("double")
    train, test = F.col("is_train"), ~F.col("is_train")
    metrics = model.transform(data).agg(
        F.lit("trained").alias("status"),
        F.round(F.avg(F.when(train, right)), 4).alias("train_accuracy"),
        F.round(F.avg(F.when(test, right)), 4).alias("test_accuracy"),
        F.count_if(train).alias("train_samples"),
        F.count_if(test).alias("test_samples"),
        F.lit(len(MODEL_FEATURES)).alias("feature_dim"),
    )
    return model, metrics


def evaluate(predictions: DataFrame) -> DataFrame:
    """Per-class report with macro and weighted averages from ``(label, pred)``.

    One scan: the class-by-class counts are reduced first, everything after
    works on that handful of rows. Fewer than five rows give no report.
    """
    pairs = predictions.groupBy("label", "pred").agg(F.count("*").alias("n"))
    hit = F.col("label") == F.col("pred")
    zero = F.lit(0).cast("long")

    def share(cls: str, tp: Column, fp: Column, fn: Column) -> Column:
        return F.struct(F.col(cls).alias("cls"), tp.alias("tp"), fp.alias("fp"), fn.alias("fn"))

    n = F.col("n")
    shares = F.when(hit, F.array(share("label", n, zero, zero))).otherwise(
        F.array(share("label", zero, zero, n), share("pred", zero, n, zero))
    )
    per_class = (
        pairs.select(F.inline(shares))
        .groupBy("cls")
        .agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn")])
    )

    def ratio(a: Column, b: Column) -> Column:
        return F.coalesce(a / F.nullif(b, F.lit(0)), F.lit(0.0))

    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    scored = per_class.select(
        F.col("cls").cast("string").alias("cls"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        (tp + fn).alias("support"),
        "tp",
    )

    def row(name: Column, weight: Column, averaged: bool) -> Column:
        return F.struct(
            name.alias("name"), weight.cast("double").alias("w"), F.lit(averaged).alias("averaged"),
            "precision", "recall", "f1", "support", "tp",
        )

    one = F.lit(1)
    spread = scored.select(
        F.inline(
            F.array(
                row(F.col("cls"), one, False),
                row(F.lit("macro avg"), one, True),
                row(F.lit("weighted avg"), F.col("support"), True),
            )
        )
    )

    def mean(c: str) -> Column:
        return F.sum(F.col(c) * F.col("w")) / F.sum("w")

    enough = pairs.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total")).scalar() >= MIN_EVAL_ROWS
    return (
        spread.where(enough)
        .groupBy("name", "averaged")
        .agg(
            mean("precision").alias("precision"),
            mean("recall").alias("recall"),
            mean("f1").alias("f1"),
            F.sum("support").alias("support"),
            (F.sum("tp") / F.sum("support")).alias("_acc"),
        )
        .select(
            "name", "precision", "recall", "f1", "support",
            F.when(F.col("averaged"), F.col("_acc")).alias("accuracy"),
        )
    )


def confusion(predictions: DataFrame) -> DataFrame:
    """Counts ``(label, pred, n)`` of every class seen against every class seen, zeros included.

    Classes are those that occur as label or as prediction. The counts are reduced
    in one scan; the grid is as large as the square of the number of classes.
    """
    counts = predictions.groupBy("label", "pred").agg(F.count("*").alias("n"))
    seen = F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.array("label", "pred")))))
    cells = F.map_from_entries(F.collect_list(F.struct(F.struct("label", "pred"), "n")))
    grid = counts.agg(seen.alias("seen"), cells.alias("cells"))
    labelled = grid.select(F.explode("seen").alias("label"), "seen", "cells")
    return labelled.select("label", F.explode("seen").alias("pred"), "cells").select(
        "label", "pred", F.coalesce(F.try_element_at("cells", F.struct("label", "pred")), F.lit(0).cast("long")).alias("n")
    )


REGISTRY = "model_id string, registered_at string, metrics string, params string, path string"


def register_model(
    model: RandomForestClassificationModel, root: str, metrics: dict, params: dict, run_ts: str
) -> str:
    """Save a model under ``root`` and append its entry to the registry table."""
    spark = SparkSession.getActiveSession()
    body = (json.dumps(metrics, sort_keys=True), json.dumps(params, sort_keys=True))
    entry = spark.createDataFrame([(run_ts, *body)], "registered_at string, metrics string, params string")
    keyed = entry.withColumn("model_id", F.md5(F.concat_ws("|", "registered_at", "metrics", "params")))
    model_id = keyed.first()["model_id"]
    path = f"{root}/models/{model_id}"
    model.write().overwrite().save(path)
    keyed.select("model_id", "registered_at", "metrics", "params", F.lit(path).alias("path")).write.mode(
        "append"
    ).parquet(f"{root}/registry")
    return model_id


def list_models(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(REGISTRY).parquet(f"{root}/registry").orderBy("registered_at", "model_id")


def get_model(spark: SparkSession, root: str, model_id: str) -> DataFrame:
    return list_models(spark, root).filter(F.col("model_id") == model_id)
