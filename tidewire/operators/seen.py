"""Keys that earlier runs have seen, with a bit table that tells most new keys from them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.session import cut_lineage

BLOCK_BITS = 32_768  # bits of a block, what one bitmap of the bitmap functions holds
PROBES = 5  # bits set for a key, all in one block


def _hash(key: Column, seed: int) -> Column:
    return F.xxhash64(key, F.lit(seed))


@dataclass(frozen=True)
class SeenStore:
    """A key table in partitions, and beside it the blocks of a Bloom filter.

    A key belongs to one block; its partition follows from the block. A batch of
    keys is first held against the blocks: a key whose bits are not all set is
    new. Only the others, seen ones and few false alarms, go to the exact anti
    join, and only the partitions that hold such keys are read. ``blocks`` is
    fixed for a store; with 10 bits for each key it will hold, about one new key
    in a hundred is a false alarm. More keys cost reads, never results.
    """

    spark: SparkSession
    path: str
    blocks: int = 4096
    parts: int = 256

    def _block(self, key: Column) -> Column:
        return F.pmod(_hash(key, 1), F.lit(self.blocks)).cast("int")

    @staticmethod
    def _bits(key: Column) -> Column:
        return F.array_distinct(F.array(*[F.pmod(_hash(key, i + 2), F.lit(BLOCK_BITS)).cast("int") for i in range(PROBES)]))

    def _part(self, block: Column) -> Column:
        return (block % self.parts).cast("int")

    def append(self, rows: DataFrame, run: str) -> None:
        """Add the keys of ``rows(dedup_key)`` under the name of a run; a run written again replaces its own part."""
        key = F.col("dedup_key")
        keys = rows.select("dedup_key", self._block(key).alias("block"))
        kept = keys.select("dedup_key", self._part(F.col("block")).alias("part"))
        kept.repartition("part").sortWithinPartitions("part", "dedup_key").write.partitionBy("part").mode("overwrite").parquet(
            f"{self.path}/keys/run={run}"
        )
        set_bits = keys.select("block", F.explode(self._bits(key)).alias("bit"))
        # Bits count from 0 here and from 1 in the bitmap functions' values.
        tables = set_bits.groupBy("block").agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("bit") + 1)).alias("bits"))
        tables.write.mode("overwrite").parquet(f"{self.path}/bits/run={run}")

    def _exists(self) -> bool:
        folder = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/bits")
        return folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)

    def keys(self) -> DataFrame:
        """(dedup_key, part, run) of all runs."""
        return self.spark.read.schema("dedup_key string, run string, part int").parquet(f"{self.path}/keys")

    def suspects(self, rows: DataFrame) -> DataFrame:
        """``rows(dedup_key, ...)`` with ``part`` and whether the sketch holds the key (``maybe``)."""
        key = F.col("dedup_key")
        stored = self.spark.read.schema("block int, bits binary, run string").parquet(f"{self.path}/bits")
        blocks = stored.groupBy("block").agg(F.bitmap_or_agg("bits").alias("bits"))
        asked = rows.withColumn("block", self._block(key))

        def is_set(bit: Column) -> Column:
            octet = F.conv(F.hex(F.substring("bits", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
            return F.getbit(octet, (bit % 8).cast("int")) == 1

        maybe = F.coalesce(F.forall(self._bits(key), is_set), F.lit(False))
        found = asked.join(blocks, "block", "left").withColumn("maybe", F.col("bits").isNotNull() & maybe)
        return found.withColumn("part", self._part(F.col("block"))).drop("bits", "block")

    def unseen(self, rows: DataFrame) -> DataFrame:
        """``rows`` whose key no earlier run has."""
        if not self._exists():
            return rows
        held = cut_lineage(self.suspects(rows), "suspects")
        parts = [r["part"] for r in held.where("maybe").select("part").distinct().collect()]  # at most ``self.parts``
        history = self.keys().where(F.col("part").isin(parts)).select("dedup_key")
        checked = held.where("maybe").join(history, "dedup_key", "left_anti")
        return held.where(~F.col("maybe")).unionByName(checked).select(*rows.columns)
