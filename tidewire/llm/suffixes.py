"""Repeated passages by prefix-partitioned suffix trees over words.

The suffixes are those that start at a word and have a window of words left.
Their tree is never built whole: suffixes with the same short prefix belong to
one subtree, and a prefix that too many share is lengthened, so that each group
of subtrees fits into a task's memory whatever the corpus holds. Below the depth
of a window nothing is asked, so a suffix is known by the name (a hash) of its
first words; the nodes of a subtree at that depth with two suffixes or more are
its deep internal nodes, the repeats. Runs of such nodes along a text are its
maximal repeated passages.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.llm.kernels import slices, texts_of, window_hashes, word_hashes

WINDOW = 20
GROUP = 400_000  # suffixes of a group: what a task holds at a time
_PREFIXES = 4096  # classes of one-word prefixes
_CHUNK = 8 << 20  # bytes of text whose suffixes are sorted together before the shuffle
_NULL_ID = -(1 << 63)  # stands for a null id, which so comes first


@dataclass(frozen=True)
class Partition:
    """Where each prefix class goes: its first group and over how many its longer prefixes are split."""

    base: np.ndarray
    split: np.ndarray
    groups: int

    def group_of(self, prefix: np.ndarray, name: np.ndarray) -> np.ndarray:
        return self.base[prefix] + ((name >> np.uint64(8)) % self.split[prefix].astype(np.uint64)).astype(np.int64)


def _prefix(first_words: np.ndarray) -> np.ndarray:
    return (first_words >> np.uint64(52)).astype(np.int64)


def count_prefixes(docs: DataFrame, window: int = WINDOW) -> list[int]:
    """Suffixes of the whole corpus per prefix class; a bounded number of sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(_PREFIXES, np.int64)
        for batch in batches:
            for part in slices(batch, 0, _CHUNK):
                words, text, _, _ = word_hashes(texts_of(part.column(0)))
                n = max(0, len(words) - window + 1)
                starts = words[:n][text[:n] == text[len(text) - n :]]
                counts += np.bincount(_prefix(starts), minlength=_PREFIXES)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(counts[used], pa.int64())], names=["prefix", "n"])

    found = docs.select("text").mapInArrow(run, "prefix int, n long").groupBy("prefix").agg(F.sum("n").alias("n")).collect()
    out = [0] * _PREFIXES
    for row in found:
        out[row["prefix"]] = row["n"]
    return out


def partition(counts: list[int], group: int = GROUP) -> Partition:
    """Small classes share groups, large ones are split by the name of the whole window."""
    base, split = np.zeros(len(counts), np.int64), np.ones(len(counts), np.int64)
    at = held = 0
    for prefix in sorted(range(len(counts)), key=lambda i: counts[i]):
        parts = -(-counts[prefix] // group)
        if parts > 1 or held + counts[prefix] > group:
            at, held = at + (held > 0), 0
        base[prefix], split[prefix] = at, max(1, parts)
        if parts > 1:
            at += parts
        else:
            held += counts[prefix]
    return Partition(base, split, int(at + 1))


def _planes(values: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of each value, all first bytes, then all second ones: equal bytes lie together."""
    return values.view(np.uint8).reshape(len(values), -1)[:, :width].T.tobytes()


def _unplanes(data: np.ndarray, n: int, width: int, dtype) -> np.ndarray:
    out = np.zeros((n, np.dtype(dtype).itemsize), np.uint8)
    out[:, :width] = data.reshape(width, n).T
    return out.view(dtype).ravel()


def _pack(ids: np.ndarray, places: np.ndarray, names: np.ndarray | None = None) -> bytes:
    body = _planes(np.diff(ids, prepend=np.int64(0)), 8) + _planes(places.astype(np.int32), 4)
    return body if names is None else body + _planes(names, 7)


def _unpack(blob: bytes, named: bool) -> tuple[np.ndarray, ...]:
    data = np.frombuffer(blob, np.uint8)
    n = len(data) // (19 if named else 12)
    ids = np.cumsum(_unplanes(data[: 8 * n], n, 8, np.int64))
    places = _unplanes(data[8 * n : 12 * n], n, 4, np.int32)
    return (ids, places, _unplanes(data[12 * n :], n, 7, np.uint64)) if named else (ids, places)


def _bucket(ids: np.ndarray, buckets: int) -> np.ndarray:
    x = ids.view(np.uint64)
    return ((x ^ (x >> np.uint64(13)) ^ (x >> np.uint64(29))) % np.uint64(1 << 31) % np.uint64(buckets)).astype(np.int32)


def _bucket_column(key: Column, buckets: int) -> Column:
    """The same in SQL functions."""
    x = key.bitwiseXOR(F.shiftrightunsigned(key, 13)).bitwiseXOR(F.shiftrightunsigned(key, 29))
    return (x.bitwiseAND(F.lit((1 << 31) - 1)) % buckets).cast("int")


def _parts(keys: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(key, indices with it, ascending) for every key."""
    order = np.argsort(keys, kind="stable")
    cut = np.flatnonzero(np.diff(keys[order])) + 1
    for rows in np.split(order, cut) if len(order) else ():
        yield int(keys[rows[0]]), rows


def _repeats(names: np.ndarray, ids: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, later): index of the earliest suffix of each name, and of all that start after it."""
    order = np.argsort(names, kind="stable")
    ranked = names[order]
    again = np.zeros(len(order), bool)  # belongs to a node with more than one suffix
    again[1:] = ranked[1:] == ranked[:-1]
    again[:-1] |= again[1:]
    single = order[~again]
    some = order[again]
    some = some[np.lexsort((places[some], ids[some], names[some]))]
    if not len(some):
        return single, some
    lead = np.ones(len(some), bool)
    lead[1:] = names[some][1:] != names[some][:-1]
    leader = some[np.maximum.accumulate(np.where(lead, np.arange(len(some)), 0))]
    later = (ids[some] != ids[leader]) | (places[some] != places[leader])
    return np.concatenate([single, some[lead]]), some[later]


_ROWS = T.StructType(
    [T.StructField("grp", T.LongType(), False), T.StructField("bucket", T.IntegerType(), False), T.StructField("blob", T.BinaryType(), False)]
)


def _suffix_rows(docs: DataFrame, plan: Partition, buckets: int, window: int) -> DataFrame:
    """(grp, bucket, blob): packed suffixes by group (bucket -1), and packed repeats already known by document bucket.

    Of the suffixes with one name in a chunk only the earliest goes to the group,
    so a passage that very many documents share sends a row per chunk; the later
    ones are repeats whatever other chunks hold.
    """
    names = _ROWS.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1, _CHUNK):
                keys = part.column(0).to_numpy(zero_copy_only=False)
                order = np.argsort(keys, kind="stable")
                texts = texts_of(part.column(1))
                words, text, _, _ = word_hashes([texts[i] for i in order])
                name, at = window_hashes(words, text, window)
                if not len(at):
                    continue
                begin = np.searchsorted(text, np.arange(len(texts)))
                ids, places = keys[order][text[at]], at - begin[text[at]]
                name = name & np.uint64((1 << 56) - 1)
                first, later = _repeats(name, ids, places)
                first, later = np.sort(first), np.sort(later)
                rows = []
                for g, at_g in _parts(plan.group_of(_prefix(words[at[first]]), name[first])):
                    chosen = first[at_g]
                    rows.append((g, -1, _pack(ids[chosen], places[chosen], name[chosen])))
                for b, at_b in _parts(_bucket(ids[later], buckets)):
                    chosen = later[at_b]
                    rows.append((b % plan.groups, b, _pack(ids[chosen], places[chosen])))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.binary()))], names=names
                )

    return docs.select("_key", "text").mapInArrow(run, _ROWS)


def _later_suffixes(rows: DataFrame, buckets: int) -> DataFrame:
    """(bucket, blob): the suffixes that are not the first of their name, group by group."""

    def run(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket").to_numpy()
        blobs = table.column("blob").to_pylist()
        out = [(int(b), x) for b, x in zip(bucket, blobs) if b >= 0]
        packed = [_unpack(x, True) for b, x in zip(bucket, blobs) if b < 0]
        if packed:
            ids, places, names = (np.concatenate(c) for c in zip(*packed))
            later = _repeats(names, ids, places)[1]
            later = later[np.lexsort((places[later], ids[later]))]
            for b, at in _parts(_bucket(ids[later], buckets)):
                out.append((b, _pack(ids[later[at]], places[later[at]])))
        return pa.table({"bucket": pa.array([b for b, _ in out], pa.int32()), "blob": pa.array([x for _, x in out], pa.binary())})

    return rows.groupBy("grp").applyInArrow(run, "bucket int, blob binary")


def remove_repeats(docs: DataFrame, window: int = WINDOW, group: int = GROUP) -> DataFrame:
    """(doc_id, n_words, n_removed, spans, kept) of every row of ``docs`` (doc_id long, text).

    ``spans`` are the maximal runs of words covered by a window that also starts
    earlier, in a document of smaller id or before in the same one, as [start,
    end) word numbers; ``kept`` is the other words joined by one blank. Windows
    are judged on the input. A null text has no words; a null id comes before all
    others. Rows of one id count as one document: the first start of a window is
    the least (id, place), and what is removed of one is removed of its equals.
    An empty table gives no rows; a text of any length is read as a whole in memory.
    Names have 56 bits within a group of bounded size, so a false match is as
    unlikely in a large corpus as in a small one, per suffix.
    """
    keyed = docs.select("doc_id", F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_NULL_ID)).alias("_key"), "text")
    plan = partition(count_prefixes(keyed, window), group)
    buckets = plan.groups | 1
    later = _later_suffixes(_suffix_rows(keyed, plan, buckets, window), buckets)
    both = keyed.select(
        _bucket_column(F.col("_key"), buckets).alias("bucket"), F.lit(1).alias("kind"), "doc_id", "_key", "text",
        F.lit(None).cast("binary").alias("blob"),
    ).unionByName(later.select("bucket", F.lit(0).alias("kind"), "blob"), allowMissingColumns=True)
    span = T.StructType([T.StructField("start", T.IntegerType(), False), T.StructField("end", T.IntegerType(), False)])
    schema = T.StructType(
        [
            docs.schema["doc_id"], T.StructField("n_words", T.LongType(), False), T.StructField("n_removed", T.LongType(), False),
            T.StructField("spans", T.ArrayType(span, False), False), T.StructField("kept", T.StringType(), False),
        ]
    )
    names = schema.fieldNames()
    spans_type = pa.list_(pa.struct([pa.field("start", pa.int32(), False), pa.field("end", pa.int32(), False)]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, packed, ids, places = None, [], None, None
        for batch in batches:
            for part in slices(batch, 4, 1 << 20):
                rows = []
                kind, bucket, keys, blobs = (part.column(i).to_pylist() for i in (1, 0, 3, 5))
                texts = texts_of(part.column(4))
                for i in range(part.num_rows):
                    if bucket[i] != current:
                        current, packed, ids = bucket[i], [], None
                    if kind[i] == 0:
                        packed.append(_unpack(blobs[i], False))
                        continue
                    if ids is None:  # the bucket's repeats have all been read
                        empty = (np.empty(0, np.int64), np.empty(0, np.int32))
                        ids, places = (np.concatenate(c) for c in zip(empty, *packed))
                        order = np.argsort(ids, kind="stable")
                        ids, places, packed = ids[order], places[order], []
                    words = texts[i].split()
                    lo, hi = np.searchsorted(ids, keys[i], "left"), np.searchsorted(ids, keys[i], "right")
                    starts = places[lo:hi]
                    starts = starts[starts + window <= len(words)]
                    if not len(starts):
                        rows.append((part.column(2)[i], len(words), 0, [], b" ".join(words)))
                        continue
                    depth = np.zeros(len(words) + 1, np.int32)
                    np.add.at(depth, starts, 1)
                    np.add.at(depth, starts + window, -1)
                    gone = np.cumsum(depth) > 0
                    edge = np.flatnonzero(np.diff(gone.view(np.int8), prepend=np.int8(0)))
                    spans = [{"start": int(a), "end": int(b)} for a, b in zip(edge[0::2], edge[1::2])]
                    kept, at = [], 0
                    for s in spans:
                        kept += words[at : s["start"]]
                        at = s["end"]
                    kept += words[at:]
                    rows.append((part.column(2)[i], len(words), len(words) - len(kept), spans, b" ".join(kept)))
                if rows:
                    columns = list(zip(*rows))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([x.as_py() for x in columns[0]], part.column(2).type), pa.array(columns[1], pa.int64()),
                            pa.array(columns[2], pa.int64()), pa.array(columns[3], spans_type), pa.array(columns[4], pa.binary()).cast(pa.string()),
                        ],
                        names=names,
                    )

    return both.repartition("bucket").sortWithinPartitions("bucket", "kind").mapInArrow(run, schema)
