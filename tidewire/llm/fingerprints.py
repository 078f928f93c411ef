"""Document fingerprints: quartile digests of hashed byte triplets."""

from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.llm.kernels import mix, slices

BUCKETS = 128
WORST = 300  # a difference of so much or more is likeness 0
CHUNK = 1 << 20  # bytes of text digested at a time
_SCRAMBLE = np.argsort(mix(np.arange(256, dtype=np.uint64) + np.uint64(77))).astype(np.uint8)  # a fixed permutation of bytes
_STEP = np.array([0, 1, 2, 6])  # cost of quartiles that lie so far apart


def triplet_counts(texts: list[bytes]) -> np.ndarray:
    """Rows of counts: how many of a text's byte triplets fall into each bucket."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    data = np.frombuffer(b"".join(texts), np.uint8)
    if len(data) < 3:
        return np.zeros((len(texts), BUCKETS), np.int64)
    owner = np.repeat(np.arange(len(texts)), lengths)
    a = _SCRAMBLE[_SCRAMBLE[_SCRAMBLE[data[:-2]] ^ data[1:-1]] ^ data[2:]]
    same = owner[:-2] == owner[2:]
    slot = (owner[:-2] * BUCKETS + a % BUCKETS)[same]
    return np.bincount(slot, minlength=len(texts) * BUCKETS).reshape(len(texts), BUCKETS)


class Digests:
    """Digests of a list of texts: a length class, two quartile ratios, and each bucket's quartile."""

    def __init__(self, texts: list[bytes]):
        counts = triplet_counts(texts)
        ordered = np.sort(counts, axis=1)
        q1, q2, q3 = (ordered[:, i * BUCKETS // 4 - 1] for i in (1, 2, 3))
        self.body = ((counts > q1[:, None]).astype(np.uint8) + (counts > q2[:, None]) + (counts > q3[:, None])).astype(np.uint8)
        self.length = np.array([min(255, round(math.log(len(t) + 1) / math.log(1.1))) for t in texts], np.int64)
        top = np.maximum(q3, 1)
        self.low, self.mid = q1 * 16 // (top + 1), q2 * 16 // (top + 1)

    def take(self, rows: list[int] | np.ndarray) -> Digests:
        out = object.__new__(Digests)
        out.body, out.length, out.low, out.mid = self.body[rows], self.length[rows], self.low[rows], self.mid[rows]
        return out

    def strings(self) -> list[str]:
        pairs = self.body.reshape(len(self.body), BUCKETS // 4, 4)
        packed = (pairs[:, :, 0] << 6 | pairs[:, :, 1] << 4 | pairs[:, :, 2] << 2 | pairs[:, :, 3]).astype(np.uint8)
        return [
            f"{n:02x}{a:x}{b:x}{body.tobytes().hex()}" for n, a, b, body in zip(self.length, self.low, self.mid, packed)
        ]


def likeness(a: Digests, b: Digests) -> np.ndarray:
    """1 for equal digests, falling with their difference score to 0 at ``WORST`` and beyond."""
    apart = _STEP[np.abs(a.body.astype(np.int8) - b.body.astype(np.int8))].sum(axis=1)
    length = np.abs(a.length - b.length)
    apart = apart + np.where(length <= 1, length, 3 * length)
    for x, y in ((a.low, b.low), (a.mid, b.mid)):
        gap = np.abs(x - y)
        apart = apart + np.where(gap <= 1, gap, 4 * (gap - 1))
    return 1.0 - np.minimum(apart, WORST) / WORST


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint) of every whole text, row by row. A null text counts as empty."""
    schema = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("fingerprint", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1, CHUNK):
                texts = [(t.as_py() or "").encode() for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(Digests(texts).strings())], names=["doc_id", "fingerprint"])

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def _constant(values: list) -> Column:
    return F.from_json(F.lit(json.dumps(values)), "array<bigint>")


def _below(x: Column, bounds: list[int]) -> Column:
    """How many of the sorted ``bounds`` are not above ``x``, by bisection; 0 for null."""
    if not bounds:
        return F.lit(0)
    known = _constant(bounds)

    def step(s: Column, _: Column) -> Column:
        middle = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        up = (s["lo"] < s["hi"]) & (F.get(known, middle) <= x)
        down = (s["lo"] < s["hi"]) & ~up
        return F.struct(
            F.when(up, middle + 1).otherwise(s["lo"]).cast("int").alias("lo"), F.when(down, middle).otherwise(s["hi"]).cast("int").alias("hi")
        )

    start = F.struct(F.lit(0).cast("int").alias("lo"), F.lit(len(bounds)).cast("int").alias("hi"))
    steps = F.sequence(F.lit(1), F.lit(len(bounds).bit_length() + 1))
    return F.when(x.isNull(), F.lit(0)).otherwise(F.aggregate(steps, start, step, lambda s: s["lo"]))


def _with_successors(docs: DataFrame, ranges: int) -> tuple[DataFrame, int]:
    """(r, tail, doc_id, h, text): the rows dealt into ranges of the id, and to each range the row after its last.

    The row after a range's last is the first of the next range in use, and the
    very first row for the last one; such a row goes to two ranges. So each range
    can be read alone, in order, and no row is far from its successor. The first
    rows come from one narrow aggregate, a row per range.
    """
    shares = [i / ranges for i in range(1, ranges)]
    bounds = docs.agg(F.percentile_approx("doc_id", shares or [0.5], 10 * ranges + 1000).alias("q")).first()["q"]
    bounds = sorted(set(bounds or [])) if ranges > 1 else []
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("h"), _below(F.col("doc_id"), bounds).alias("r"))
    firsts = keyed.groupBy("r").agg(F.min(F.struct("doc_id", "h")).alias("k")).orderBy("r").collect()
    size = len(bounds) + 1
    first_id, first_h, before = [None] * size, [None] * size, [None] * size
    for i, row in enumerate(firsts):
        first_id[row["r"]], first_h[row["r"]] = row["k"]["doc_id"], row["k"]["h"]
        before[row["r"]] = firsts[i - 1]["r"]
    look = lambda values: F.get(_constant(values), F.col("r"))
    is_first = F.col("doc_id").eqNullSafe(look(first_id)) & F.col("h").eqNullSafe(look(first_h))
    targets = F.when(
        is_first, F.array(F.struct(F.col("r").cast("bigint").alias("r"), F.lit(False).alias("tail")), F.struct(look(before).alias("r"), F.lit(True).alias("tail")))
    ).otherwise(F.array(F.struct(F.col("r").cast("bigint").alias("r"), F.lit(False).alias("tail"))))
    return keyed.select(F.explode(targets).alias("t"), "doc_id", "h", "text").select("t.r", "t.tail", "doc_id", "h", "text"), size


def edited_fingerprints(docs: DataFrame, ranges: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edit, with their likeness.

    The edit replaces the last quarter of the code points, rounded down, by as
    many of the next document's first (or all of them), in the order of the id and
    then of the text's hash, nulls first; after the last row comes the first. A
    null text counts as empty; rows equal in id and text follow one another, so
    the next of all but one of them is equal. A single row is its own next.
    """
    spark = docs.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    plain = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    dealt, size = _with_successors(plain, ranges)
    schema = T.StructType(
        [T.StructField("doc_id", T.LongType()), T.StructField("n_chars", T.LongType(), False)]
        + [T.StructField(c, T.StringType(), False) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")]
        + [T.StructField(c, T.DoubleType(), False) for c in ("near_edited", "near_next")]
    )
    names = [f.name for f in schema]

    def finish(rows: list[tuple], count: int) -> pa.RecordBatch:
        """Results of the first ``count`` rows, each with the row after it."""
        texts = [r[2] for r in rows]
        edited = []
        for i in range(count):
            text, k = texts[i], len(texts[i]) // 4
            edited.append((text[: len(text) - k] + texts[i + 1][:k]).encode())
        plain, changed = Digests([t.encode() for t in texts]), Digests(edited)
        these, following = plain.take(np.arange(count)), plain.take(np.arange(1, count + 1))
        values = [
            pa.array([r[1] for r in rows[:count]], pa.int64()), pa.array([len(t) for t in texts[:count]], pa.int64()),
            pa.array([hashlib.sha256(e).hexdigest() for e in edited]), pa.array(these.strings()), pa.array(changed.strings()),
            pa.array(likeness(these, changed)), pa.array(likeness(these, following)),
        ]
        return pa.RecordBatch.from_arrays(values, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []  # consecutive rows of one range: (r, doc_id, text)
        held = 0
        closed = None  # the range whose tail has been read

        for batch in batches:
            for part in slices(batch, 4, CHUNK):
                for r, tail, doc_id, text in zip(*(part.column(i).to_pylist() for i in (0, 1, 2, 4))):
                    if r == closed:
                        continue  # more copies of the tail
                    rows.append((r, doc_id, text))
                    held += len(text)
                    if tail:
                        if len(rows) > 1:
                            yield finish(rows, len(rows) - 1)
                        rows, held, closed = [], 0, r
                    elif held > CHUNK and len(rows) > 1:
                        yield finish(rows, len(rows) - 1)
                        rows = rows[-1:]
                        held = len(rows[0][2])

    return (
        dealt.repartition(min(size, 20_000), "r")
        .sortWithinPartitions("r", "tail", F.asc_nulls_first("doc_id"), "h")
        .mapInArrow(run, schema)
    )
