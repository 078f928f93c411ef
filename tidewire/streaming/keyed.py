"""Streaming dedup with a state of its own per key."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from tidewire.operators.clean import dedup_key

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
DAY_MS = 86_400_000


class FirstSeen(StatefulProcessor):
    """Passes on a key's first row and remembers it for ``ttl_ms`` of running time.

    Within a batch the first row is the one of least event time, then id; rows of
    later batches are copies whatever their event time.
    """

    def __init__(self, ttl_ms: int, order: tuple[str, ...]):
        self.ttl_ms, self.order = ttl_ms, order

    def init(self, handle: StatefulProcessorHandle) -> None:
        kept = StructType([StructField("event_ts", TimestampType()), StructField("event_id", StringType())])
        self.first = handle.getValueState("first", kept, ttlDurationMs=self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        if self.first.exists():
            return
        best = min(rows, key=self.place, default=None)  # of equal ones the first; a hot key's rows come one by one, one is held
        if best is not None:
            self.first.update((best["event_ts"], str(best["event_id"])))
            yield best

    def place(self, row: Row) -> list[tuple]:
        """Nulls are least."""
        return [(row[c] is not None, row[c]) for c in self.order]

    def close(self) -> None:
        pass


@contextlib.contextmanager
def settings(spark: SparkSession):
    """What a query with such a state needs when it is started; it keeps a copy, so the session gets its own back.

    The state lives in the RocksDB store. Batches without data are off: they would
    follow one another for as long as keys can expire, so a run over what is
    available would not end.
    """
    wanted = {PROVIDER: ROCKS, "spark.sql.streaming.noDataMicroBatches.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def dedup_stream_keyed(df: DataFrame, ttl_days: float = 365.0, order: tuple[str, ...] = ("event_ts", "event_id")) -> DataFrame:
    """First article per key, however late its copies come; the key stays as ``dedup_key``.

    No watermark bounds what is remembered: a key is a small entry of the state
    store for ``ttl_days`` of running time after it was seen, and late rows are not
    dropped for being late. Copies in one batch are one group of it, so a batch's
    size bounds what a hot key brings to a task. Start the query inside ``settings``.
    """
    keyed = df.withColumn("dedup_key", dedup_key()).withColumn("event_ts", F.col("event_ts").cast("timestamp"))
    return keyed.groupBy("dedup_key").transformWithState(
        FirstSeen(round(ttl_days * DAY_MS), order), outputStructType=keyed.schema, outputMode="Append", timeMode="ProcessingTime"
    )
