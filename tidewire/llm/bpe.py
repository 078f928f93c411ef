"""Byte-level BPE with a hierarchical-bitmap rank queue."""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidewire.llm.kernels import slices

CACHED_CHARS = 48  # longer pre-tokens are merged anew each time
CACHED_PIECES = 500_000  # the cache is emptied when it holds so many
SLICE = 512  # rows per output batch
MOST_RANKS = 1 << 16
ROUND_BYTES = 1 << 20  # bytes of text encoded and decoded at a time


_BIT = [1 << i for i in range(256)]


class RankQueue:
    """Positions by merge rank; the lowest rank comes first, within it the leftmost position.

    One bucket per rank holds positions. Two levels of 256-bit words mark which
    buckets hold any: the lowest set bit of the top word names the leaf, the
    lowest of the leaf the rank, whatever the number of ranks (up to 65,536).
    """

    def __init__(self):
        self.leaf = [0] * 256
        self.top = 0
        self.buckets: dict[int, list[int]] = {}

    def push(self, rank: int, position: int) -> None:
        if rank in self.buckets:
            heappush(self.buckets[rank], position)
        else:
            self.buckets[rank] = [position]
            self.leaf[rank >> 8] |= _BIT[rank & 255]
            self.top |= _BIT[rank >> 8]

    def pop(self) -> tuple[int, int] | None:
        top = self.top
        if not top:
            return None
        a = (top & -top).bit_length() - 1
        word = self.leaf[a]
        rank = (a << 8) + (word & -word).bit_length() - 1
        bucket = self.buckets[rank]
        position = heappop(bucket)
        if not bucket:
            del self.buckets[rank]
            self.leaf[a] ^= _BIT[rank & 255]
            if not self.leaf[a]:
                self.top ^= _BIT[a]
        return rank, position


class Encoder(dict):
    """Ids of a pre-token as packed 32-bit numbers: a dictionary that computes and remembers what it lacks."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks = ranks
        self.queue = RankQueue()
        # Ranks of two-byte tokens by their bytes, for the first look at a pre-token.
        self.pairs = [-1] * 65536
        for token, rank in ranks.items():
            if len(token) == 2:
                self.pairs[token[0] << 8 | token[1]] = rank

    def __missing__(self, piece: str) -> bytes:
        data = piece.encode("utf-8")
        whole = self.ranks.get(data)
        ids = array("i", (whole,) if whole is not None else self.merge(data)).tobytes()
        if len(piece) <= CACHED_CHARS:
            if len(self) >= CACHED_PIECES:
                self.clear()
            self[piece] = ids
        return ids

    def merge(self, data: bytes) -> list[int]:
        """Merges neighbours, lowest rank and then leftmost first, until no pair has a rank.

        The pieces are a linked list over start positions. A merge changes the
        pairs at two positions; their old entries stay queued and are skipped when
        they come up, as the rank noted for the position is then another.
        """
        n, queue, pairs = len(data), self.queue, self.pairs
        rank_of, leaf, buckets, bit, top = self.ranks.get, queue.leaf, queue.buckets, _BIT, 0
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pair = [pairs[a << 8 | b] for a, b in zip(data, data[1:])]
        pair.append(-1)
        # The queue's steps are written out here: a call for each would cost more than the step.
        for i, rank in enumerate(pair):
            if rank >= 0:
                if rank in buckets:
                    buckets[rank].append(i)
                else:
                    buckets[rank] = [i]
                    leaf[rank >> 8] |= bit[rank & 255]
                    top |= bit[rank >> 8]
        while top:
            a = (top & -top).bit_length() - 1
            word = leaf[a]
            rank = (a << 8) + (word & -word).bit_length() - 1
            bucket = buckets[rank]
            lower = False
            while bucket and not lower:
                i = heappop(bucket)
                if pair[i] != rank:
                    continue
                j = after[i]
                pair[j] = -1
                after[i] = k = after[j]
                p = before[i]
                if k < n:
                    before[k] = i
                    new = pair[i] = rank_of(data[i : after[k]], -1)
                    if new >= 0:
                        lower = new < rank
                        if new in buckets:
                            heappush(buckets[new], i)
                        else:
                            buckets[new] = [i]
                            leaf[new >> 8] |= bit[new & 255]
                            top |= bit[new >> 8]
                else:
                    pair[i] = -1
                if p >= 0:
                    new = pair[p] = rank_of(data[p:k], -1)
                    if new >= 0:
                        lower = lower or new < rank
                        if new in buckets:
                            heappush(buckets[new], p)
                        else:
                            buckets[new] = [p]
                            leaf[new >> 8] |= bit[new & 255]
                            top |= bit[new >> 8]
            if not bucket:
                del buckets[rank]
                leaf[a] ^= bit[rank & 255]
                if not leaf[a]:
                    top ^= bit[a]
        ids, i, ranks = [], 0, self.ranks
        while i < n:
            ids.append(ranks[data[i : after[i]]])
            i = after[i]
        return ids


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Token bytes to rank, from the lines of a rank file; ranks beyond the queue's bitmap are refused."""
    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line.strip())}
    if max(ranks.values(), default=0) >= MOST_RANKS:
        raise ValueError(f"ranks must be below {MOST_RANKS}, what two levels of 256 bits hold")
    return ranks


def _pool(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes of all tokens end to end, where each id's begin, how many they are)."""
    size = max(ranks.values()) + 1
    begin, length, at = np.zeros(size, np.int64), np.zeros(size, np.int64), 0
    for token, rank in ranks.items():
        begin[rank], length[rank] = at, len(token)
        at += len(token)
    return np.frombuffer(b"".join(ranks), np.uint8), begin, length


_MADE: dict[tuple, object] = {}  # per Python worker


def _once(key: tuple, make):
    if key not in _MADE:
        _MADE[key] = make()
    return _MADE[key]


def _list_type() -> T.DataType:
    return T.ArrayType(T.IntegerType(), False)


class Tokenizer:
    """A rank file and a split pattern, shipped to the tasks once (the file's size bounds the broadcast)."""

    def __init__(self, spark, path: str, pattern: str):
        with open(path, "rb") as f:  # an installed vocabulary on the driver; tasks get it from the broadcast
            data = f.read()
        self.shipped = spark.sparkContext.broadcast(data)
        self.digest = hashlib.sha256(data).hexdigest()  # names what a worker has built from it
        self.pattern = pattern

    def encode(self, docs: DataFrame, text_col: str = "text", out: str = "ids") -> DataFrame:
        """``docs`` with the token ids of each whole text in ``out``, in place of the text.

        Null is empty: no ids. Rows are independent: repeated ones get equal ids, an
        empty table gives none, and a text of any length is encoded as a whole in memory.
        """
        kept = [c for c in docs.columns if c != text_col and c != out]
        schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField(out, _list_type())])
        shipped, pattern, digest = self.shipped, self.pattern, self.digest

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            import regex

            encoder = _once(("encoder", digest), lambda: Encoder(read_ranks(shipped.value)))
            split = regex.compile(pattern).findall
            ids_of = encoder.__getitem__
            for whole in batches:
                for start in range(0, whole.num_rows, SLICE):
                    batch = whole.slice(start, SLICE)
                    packed = [b"".join(map(ids_of, split(text.as_py() or ""))) for text in batch.column(batch.schema.names.index(text_col))]
                    offsets = np.cumsum([0, *map(len, packed)]) // 4
                    lists = pa.ListArray.from_arrays(
                        pa.array(offsets, pa.int32()), pa.array(np.frombuffer(b"".join(packed), dtype=np.int32))
                    )
                    yield pa.RecordBatch.from_arrays([batch.column(batch.schema.names.index(c)) for c in kept] + [lists], names=[*kept, out])

        return docs.select(*kept, text_col).mapInArrow(run, schema)

    def round_trip(self, docs: DataFrame, text_col: str = "text", ids: str = "ids", out: str = "bytes") -> DataFrame:
        """``docs`` with the token ids of each whole text, and the bytes that these ids stand for, in place of the text.

        What ``decode(encode(docs))`` gives, in one pass over the rows: the bytes come
        from the ids alone, by one gather from the bytes of all tokens laid end to end.
        """
        kept = [c for c in docs.columns if c not in (text_col, ids, out)]
        schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField(ids, _list_type()), T.StructField(out, T.BinaryType())])
        shipped, pattern, digest = self.shipped, self.pattern, self.digest

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            import regex

            encoder = _once(("encoder", digest), lambda: Encoder(read_ranks(shipped.value)))
            pool, begin, length = _once(("pool", digest), lambda: _pool(read_ranks(shipped.value)))
            split = regex.compile(pattern).findall
            ids_of = encoder.__getitem__
            for whole in batches:
                for batch in slices(whole, whole.schema.names.index(text_col), ROUND_BYTES):
                    texts = batch.column(batch.schema.names.index(text_col)).to_pylist()
                    packed = [b"".join(map(ids_of, split(text))) if text else b"" for text in texts]
                    bounds = np.cumsum([0, *map(len, packed)]) // 4
                    flat = np.frombuffer(b"".join(packed), dtype=np.int32)
                    sizes = length[flat]
                    ends = np.cumsum(sizes)
                    data = pool[np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(begin[flat] - (ends - sizes), sizes)]
                    offsets = np.concatenate([[0], ends])[bounds].astype(np.int32)
                    lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat))
                    texts = pa.Array.from_buffers(pa.binary(), len(packed), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(batch.schema.names.index(c)) for c in kept] + [lists, texts], names=[*kept, ids, out]
                    )

        return docs.select(*kept, text_col).mapInArrow(run, schema)

    def decode(self, encoded: DataFrame, ids_col: str = "ids", out: str = "bytes", drop_ids: bool = False) -> DataFrame:
        """``encoded`` with the bytes that the ids stand for in ``out``; null or no ids give empty bytes, no rows give none."""
        kept = [c for c in encoded.columns if c != out and not (drop_ids and c == ids_col)]
        schema = T.StructType([encoded.schema[c] for c in kept] + [T.StructField(out, T.BinaryType())])
        shipped, digest = self.shipped, self.digest

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bytes_of = _once(("decoder", digest), lambda: {i: b for b, i in read_ranks(shipped.value).items()}).__getitem__
            for whole in batches:
                for start in range(0, whole.num_rows, SLICE):
                    batch = whole.slice(start, SLICE)
                    column = batch.column(batch.schema.names.index(ids_col))
                    texts = [b"".join(map(bytes_of, ids.values.to_numpy(zero_copy_only=False).tolist() if ids.is_valid else ())) for ids in column]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(batch.schema.names.index(c)) for c in kept] + [pa.array(texts, pa.binary())], names=[*kept, out]
                    )

        return encoded.mapInArrow(run, schema)
