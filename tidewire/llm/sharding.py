"""Sharding with fixed virtual slots and a versioned slot-to-shard map."""

from __future__ import annotations

import heapq
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewire.llm.tables import literal_lookup
from tidewire.session import cut_lineage

SLOTS = 4096


@dataclass(frozen=True)
class SlotMap:
    """Which shard owns each virtual slot. A record's slot never changes, only the slot's owner."""

    version: int
    shards: int
    owner: tuple[int, ...]

    def shard_of(self, slot: Column) -> Column:
        return literal_lookup(list(self.owner), slot).cast("int")

    def save(self, spark: SparkSession, path: str) -> None:
        """Writes the version beside the earlier ones; a version is never overwritten."""
        owners = ",".join(map(str, self.owner))
        rows = spark.range(1).select(
            F.lit(self.shards).alias("shards"), F.posexplode(F.split(F.lit(owners), ",")).alias("slot", "shard")
        )
        rows.withColumn("shard", F.col("shard").cast("int")).write.parquet(
            f"{path.rstrip('/')}/version={self.version}", mode="error"
        )

    @staticmethod
    def load(spark: SparkSession, path: str, version: int) -> SlotMap:
        rows = spark.read.parquet(f"{path.rstrip('/')}/version={version}").orderBy("slot").collect()
        return SlotMap(version, rows[0]["shards"], tuple(r["shard"] for r in rows))


def slot_of(*columns: Column, slots: int = SLOTS) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(slots)).cast("int")


def records(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS) -> DataFrame:
    """(doc_id, size, text_crc32, vslot) per row; size is UTF-8 bytes + 1, a null text counts as empty."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    narrow = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    return narrow.withColumn("vslot", slot_of(F.col("doc_id"), F.col("text_crc32"), slots=slots))


def slot_stats(recs: DataFrame, slots: int = SLOTS) -> list[tuple[int, int]]:
    """(bytes, rows) per slot: as many entries as there are slots, whatever the table's size."""
    found = {
        r["vslot"]: (r["bytes"], r["n"])
        for r in recs.groupBy("vslot").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).collect()
    }
    return [found.get(i, (0, 0)) for i in range(slots)]


def first_map(sizes: list[int], shards: int) -> SlotMap:
    """Largest slot first, each to the lightest shard."""
    owner, heap = [0] * len(sizes), [(0, s) for s in range(shards)]
    for slot in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        load, shard = heap[0]
        owner[slot] = shard
        heapq.heapreplace(heap, (load + sizes[slot], shard))
    return SlotMap(1, shards, tuple(owner))


def rebalance(old: SlotMap, sizes: list[int], shards: int | None = None, tolerance: float = 0.02) -> SlotMap:
    """The next version: moves slots off shards above the mean until all are within ``tolerance``.

    Only slots of shards that are too full (or that go away) move. With more shards
    than before, slots move only into the new ones.
    """
    shards = shards or old.shards
    owner, load = list(old.owner), [0] * shards
    held: list[list[int]] = [[] for _ in range(shards)]
    homeless = []
    for slot, shard in enumerate(owner):
        if shard < shards:
            load[shard] += sizes[slot]
            held[shard].append(slot)
        else:
            homeless.append(slot)
    mean = sum(sizes) / shards
    new = range(old.shards, shards)
    for shard in range(min(shards, old.shards)):
        # Large slots leave first, while the shard stays at the mean or above; so few slots move.
        for slot in sorted(held[shard], key=lambda i: (-sizes[i], i)):
            if load[shard] > mean * (1 + tolerance) or new:
                if load[shard] - sizes[slot] < mean:
                    continue
                load[shard] -= sizes[slot]
                homeless.append(slot)
    # What only makes room for new shards goes to them; else to the lightest of all.
    heap = [(load[s], s) for s in (new if new and shards > old.shards else range(shards))]
    heapq.heapify(heap)
    for slot in sorted(homeless, key=lambda i: (-sizes[i], i)):
        lightest, shard = heap[0]
        owner[slot] = shard
        heapq.heapreplace(heap, (lightest + sizes[slot], shard))
    return SlotMap(old.version + 1, shards, tuple(owner))


def place(recs: DataFrame, slot_map: SlotMap, stats: list[tuple[int, int]]) -> DataFrame:
    """Adds ``shard`` and ``slot``, the record's gapless position in its shard.

    Positions need no sort of a whole shard: a virtual slot's rows are numbered
    among themselves and start where the shard's earlier slots end.
    """
    start, used = [], [0] * slot_map.shards
    for slot, shard in enumerate(slot_map.owner):
        start.append(used[shard])
        used[shard] += stats[slot][1]
    within = F.row_number().over(W.partitionBy("vslot").orderBy("doc_id", "text_crc32", "size"))
    return recs.select(
        "*",
        slot_map.shard_of(F.col("vslot")).alias("shard"),
        (literal_lookup(start, F.col("vslot")) + within - 1).cast("long").alias("slot"),
    )


def shard_documents(
    docs: DataFrame, shards: int = 16, slots: int = SLOTS, map_path: str | None = None
) -> tuple[DataFrame, SlotMap]:
    """Shards by bytes: (doc_id, size, text_crc32, vslot, shard, slot) and the map, saved if a path is given.

    Null ids and null texts are hashed like values; rows equal in id and text
    share a virtual slot. An empty table gives no rows and a map of empty slots.
    """
    recs = cut_lineage(records(docs, slots=slots), "records")
    stats = slot_stats(recs, slots)
    slot_map = first_map([size for size, _ in stats], shards)
    if map_path:
        slot_map.save(docs.sparkSession, map_path)
    return place(recs, slot_map, stats), slot_map
