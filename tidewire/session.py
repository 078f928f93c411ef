"""Session settings, the shared scratch folder and operator chaining."""

from __future__ import annotations

import contextlib
import contextvars
import functools
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Step = Callable[[DataFrame], DataFrame]

# Folders written inside the innermost open scratch scope of a thread: stream batches run in threads of their own.
_SCOPE: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("scratch", default=None)


def build_session(
    app: str = "tidewire", master: str | None = None, initial_partitions: int | None = None, **conf: str
) -> SparkSession:
    """Session with the settings the operators expect.

    Shuffle width is left to adaptive execution: it starts with
    ``initial_partitions`` (some thousands for terabytes; Spark's shuffle width if
    not given), coalesces small partitions and splits the skewed ones. Stateful
    streams keep ``spark.sql.shuffle.partitions``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if initial_partitions:
        settings["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(initial_partitions)
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _shared_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, or where that is unset a folder in the warehouse.

    A warehouse on a local disk is only shared where all executors run on the
    driver's machine; on a cluster it is refused.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    if root.startswith(("file:", "/")) and not (spark.conf.get("spark.master", None) or "local").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share: the warehouse is on a local disk")
    return f"{root}/_scratch"


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder."""
    path = f"{_shared_root(spark).rstrip('/')}/tidewire/{label}-{uuid.uuid4().hex}"
    scope = _SCOPE.get()
    if scope is not None:
        scope.append(path)
    return path


@contextlib.contextmanager
def scratch_scope(spark: SparkSession):
    """What is written to the scratch folder inside the scope is deleted at its end.

    For work whose result does not read it any more: a stream's batch that has
    been written to its sink, a search whose answer has come to the driver.
    """
    token = _SCOPE.set([])
    try:
        yield
    finally:
        written = _SCOPE.get()
        _SCOPE.reset(token)
        drop_folders(spark, written)


def drop_folders(spark: SparkSession, paths: list[str]) -> None:
    """Delete scratch folders, in whatever store they are; needs a classic session, as the file system is the JVM's."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        folder = jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(conf).delete(folder, True)


def cut_lineage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Used between rounds of an iterative operator: the plan stays short, and a
    lost executor costs one round because the table outlives it.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def pin(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column that is computed once per row, whatever reads it.

    The optimizer copies a plain column into the filters and lambdas above it,
    where it is evaluated again and again; it does not look through a generator.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def chain(*steps: Step) -> Step:
    """Compose operators left to right into one operator."""
    return lambda df: functools.reduce(lambda acc, step: step(acc), steps, df)
