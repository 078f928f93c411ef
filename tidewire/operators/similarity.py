"""Vector search, matches, links, impact and historical analogs."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.functions import lexicons as lx
from tidewire.session import cut_lineage

# Query batches up to this many bytes of vectors are shipped to every task;
# larger ones are joined block by block.
BROADCAST_BYTES = 8 * 1024 * 1024
BLOCK_ROWS = 4096  # query rows of a block
CORPUS_BLOCK_ROWS = 65536
SCORE_CELLS = 500_000  # scores held at once while a block is ranked
SCORE_ROWS = 4096  # corpus rows of which a task holds vectors of full precision
HELD_HITS = 100_000  # hits a task gathers before it cuts them to the best
HOT_BUCKET = 50_000  # corpus rows of a hash bucket that one task joins

HITS = "query_id string, hit_id string, score double"


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; zero rows stay zero."""
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.divide(vectors, norms, out=np.zeros_like(vectors), where=norms > 0)


def matrix_of(column: pa.Array) -> np.ndarray:
    """List column -> float64 matrix (every list has the same length)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def best_per_query(
    q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, k: int, skip_self: bool
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, corpus id, rounded score) of the ``k`` best corpus rows for each query, ties by id.

    Score and id order are packed into one whole number per cell, so a block is
    ranked by one partition and ids are looked up for the winners only.
    """
    by_id = np.argsort(c_ids, kind="stable")
    c_ids, c = c_ids[by_id], c[by_id]
    micro = np.rint((q @ c.T) * 1e6).astype(np.int64)
    packed = (micro << 32) - np.arange(len(c_ids))
    if skip_self:
        at = np.minimum(np.searchsorted(c_ids, q_ids), len(c_ids) - 1)
        own = np.flatnonzero(c_ids[at] == q_ids)
        for row in own:  # an id may lie in the block more than once
            packed[row, np.searchsorted(c_ids, q_ids[row], "left") : np.searchsorted(c_ids, q_ids[row], "right")] = np.iinfo(np.int64).min
    k = min(k, len(c_ids))
    best = np.argpartition(packed, len(c_ids) - k, axis=1)[:, len(c_ids) - k :]
    rows = np.repeat(np.arange(len(q_ids)), k)
    columns = best.ravel()
    kept = packed[rows, columns] != np.iinfo(np.int64).min
    rows, columns = rows[kept], columns[kept]
    return rows, c_ids[columns], micro[rows, columns] / 1e6


class _BestSoFar:
    """The ``k`` best hits of each query that a task has met; hits that the last cut shows to be worse are not taken."""

    def __init__(self, q_ids: np.ndarray, k: int):
        self.q_ids, self.k = q_ids, k
        self.floor = np.full(len(q_ids), -np.inf)
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, part: tuple[np.ndarray, np.ndarray, np.ndarray]) -> None:
        able = part[2] >= self.floor[part[0]]
        self.parts.append(tuple(x[able] for x in part))
        self.held += int(able.sum())
        if self.held > max(HELD_HITS, 2 * self.k * len(self.q_ids)):
            self.cut()

    def cut(self) -> None:
        rows, ids, scores = (np.concatenate(x) for x in zip(*self.parts))
        order = np.lexsort((ids, -scores, rows))
        rows, ids, scores = rows[order], ids[order], scores[order]
        head = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]])) if len(rows) else np.empty(0, int)
        place = np.arange(len(rows)) - np.repeat(head, np.diff(np.append(head, len(rows))))
        kept = place < self.k
        last = place == self.k - 1
        self.floor[rows[last]] = scores[last]
        self.parts, self.held = [(rows[kept], ids[kept], scores[kept])], int(kept.sum())

    def batch(self) -> pa.RecordBatch:
        if self.parts:
            self.cut()
        rows, ids, scores = self.parts[0] if self.parts else (np.empty(0, int), np.empty(0, "U1"), np.empty(0))
        return pa.RecordBatch.from_arrays(
            [pa.array(self.q_ids[rows], pa.string()), pa.array(ids, pa.string()), pa.array(scores, pa.float64())],
            names=["query_id", "hit_id", "score"],
        )


def _keep_best(hits: DataFrame, k: int) -> DataFrame:
    """Merge partial top-k lists; the rank limit also runs before the shuffle."""
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("hit_id"))
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hyperplanes(dim: int, tables: int, bits: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((tables, bits, dim))


def signatures(vectors: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """(rows, tables) bucket numbers: the signs of the projections read as bits."""
    tables, bits, dim = planes.shape
    signs = (vectors @ planes.reshape(tables * bits, dim).T) >= 0
    powers = 1 << np.arange(bits, dtype=np.int64)
    return signs.reshape(len(vectors), tables, bits) @ powers


def _search(batches: Iterator[pa.RecordBatch], q_ids, q, k, skip_self) -> Iterator[pa.RecordBatch]:
    """Best hits of a task: one list per query, whatever the number of batches."""
    best = _BestSoFar(q_ids, k)
    for batch in batches:
        for start in range(0, batch.num_rows, SCORE_ROWS):
            part = batch.slice(start, SCORE_ROWS)
            c_ids = np.array(part.column(0).to_pylist(), dtype=str)
            c = unit(matrix_of(part.column(1)))
            step = max(1, SCORE_CELLS // len(c_ids))
            for at in range(0, len(q_ids), step):
                rows, ids, scores = best_per_query(q_ids[at : at + step], q[at : at + step], c_ids, c, k, skip_self)
                best.add((rows + at, ids, scores))
    yield best.batch()


def _two_columns(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    return df.select(F.col(id_col).cast("string").alias("id"), F.col(vec_col).alias("vec")).filter(
        F.size("vec") > 0
    )


def _grid_search(q: DataFrame, c: DataFrame, k: int, skip_self: bool, n_q: int, n_c: int) -> DataFrame:
    """Block join for query batches too large to ship.

    Ids are hashed into blocks of bounded size on both sides; every query block
    meets every corpus block in one task that returns only the best ``k`` per
    query. Corpus blocks are the larger ones, so few partial lists are made.
    Blocks are balanced because ids are unique.
    """
    q_blocks, c_blocks = -(-n_q // BLOCK_ROWS), -(-n_c // CORPUS_BLOCK_ROWS)

    def blocked(df: DataFrame, own: str, n_own: int, other: str, n_other: int) -> DataFrame:
        return df.withColumn(own, F.pmod(F.xxhash64("id"), F.lit(n_own)).cast("int")).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.lit(n_other - 1)))
        )

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        schema = pa.schema([("query_id", pa.string()), ("hit_id", pa.string()), ("score", pa.float64())])
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        ids = np.array(left.column("id").to_pylist(), dtype=str)
        vec = unit(matrix_of(left.column("vec")))
        batch = pa.RecordBatch.from_arrays(
            [right.column("id").combine_chunks(), right.column("vec").combine_chunks()], ["id", "vec"]
        )
        return pa.Table.from_batches(_search(iter([batch]), ids, vec, k, skip_self), schema)

    left = blocked(q, "qb", q_blocks, "cb", c_blocks).groupBy("qb", "cb")
    right = blocked(c, "cb", c_blocks, "qb", q_blocks).groupBy("qb", "cb")
    return left.cogroup(right).applyInArrow(meet, HITS)


def _signed(vectors: DataFrame, lsh: tuple[int, int, int], dim: int) -> DataFrame:
    """(id, table, sig): the hash bucket of each vector in each table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = hyperplanes(dim, *lsh)
        for batch in batches:
            if batch.num_rows:
                found = signatures(unit(matrix_of(batch.column(1))), planes)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.tolist(), pa.list_(pa.int64()))], names=["id", "sigs"])

    return vectors.mapInArrow(run, "id string, sigs array<long>").select("id", F.posexplode("sigs").alias("table", "sig"))


def candidates(queries: DataFrame, corpus: DataFrame, lsh: tuple[int, int, int], dim: int, skip_self: bool = False) -> DataFrame:
    """Distinct (query_id, hit_id) that share a bucket; both sides are (id, vec).

    An equi-join on (table, bucket). A bucket of more than ``HOT_BUCKET`` corpus
    rows is split by a salt, and the queries in it go to each part; there are no
    more buckets than ``tables * 2 ** bits``.
    """
    keys = ["table", "sig"]
    signed = cut_lineage(_signed(corpus, lsh, dim), "buckets")
    parts = signed.groupBy(*keys).agg(F.ceil(F.count("*") / HOT_BUCKET).cast("int").alias("parts"))
    salt = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
    right = signed.join(F.broadcast(parts), keys).select(*keys, salt.alias("salt"), F.col("id").alias("hit_id"))
    left = (
        _signed(queries, lsh, dim).join(F.broadcast(parts), keys)
        .select(*keys, F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("salt"), F.col("id").alias("query_id"))
    )
    pairs = left.join(right, [*keys, "salt"]).select("query_id", "hit_id")
    if skip_self:
        pairs = pairs.filter("query_id <> hit_id")
    return pairs.distinct()


def _rescored(pairs: DataFrame, q: DataFrame, c: DataFrame) -> DataFrame:
    """Exact cosines of the candidate pairs, and of no others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                scores = np.einsum("ij,ij->i", unit(matrix_of(batch.column(2))), unit(matrix_of(batch.column(3))))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(np.rint(scores * 1e6) / 1e6)], names=["query_id", "hit_id", "score"]
                )

    both = pairs.join(c.select(F.col("id").alias("hit_id"), F.col("vec").alias("c_vec")), "hit_id").join(
        q.select(F.col("id").alias("query_id"), F.col("vec").alias("q_vec")), "query_id"
    )
    return both.select("query_id", "hit_id", "q_vec", "c_vec").mapInArrow(run, HITS)


def top_k(
    queries: DataFrame,
    corpus: DataFrame,
    k: int = 20,
    query_id: str = "vec_id",
    corpus_id: str = "vec_id",
    query_vec: str = "embedding",
    corpus_vec: str = "embedding",
    skip_self: bool = False,
    lsh: tuple[int, int, int] | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Exact cosine search: ``query_id, hit_id, score (6 decimals), rank``.

    The corpus is read once, where it lies. The query batch is shipped to the
    tasks when its measured size allows, else both sides are joined in blocks.
    Either way a task scores a block with one matrix product and returns the
    best ``k`` per query, and those partial lists are merged.

    ``lsh=(tables, bits, seed)`` scores only corpus rows that share a
    random-hyperplane bucket with the query, found by a join on the buckets
    (approximate recall, exact scores, fewer than ``k`` hits where fewer share one).
    """
    q = _two_columns(queries, query_id, query_vec)
    c = _two_columns(corpus, corpus_id, corpus_vec)
    size = q.agg(F.count("*").alias("n"), F.max(F.size("vec")).alias("d")).first()
    if not size["n"]:
        return queries.sparkSession.createDataFrame([], HITS + ", rank int")
    if lsh:
        hits = _rescored(candidates(q, c, lsh, size["d"], skip_self), q, c)
    elif size["n"] * (size["d"] * 8 + 64) <= broadcast_bytes:
        rows = q.toArrow()
        ids = np.array(rows.column("id").to_pylist(), dtype=str)
        search = partial(_search, q_ids=ids, q=unit(matrix_of(rows.column("vec"))), k=k, skip_self=skip_self)
        hits = c.mapInArrow(search, HITS)
    else:
        hits = _grid_search(q, c, k, skip_self, size["n"], c.count())
    return _keep_best(hits, k)


def label_centroids(vectors: DataFrame) -> DataFrame:
    """Mean vector per label: ``(query_id, embedding)``.

    Dimensions are averaged as (label, position) groups, combined map-side, so
    a label with a third of all rows is no heavier for its reducer than any other.
    """
    means = (
        vectors.select("label", F.posexplode("embedding").alias("pos", "x"))
        .groupBy("label", "pos")
        .agg(F.avg(F.col("x").cast("double")).alias("x"))
    )
    ordered = F.array_sort(F.collect_list(F.struct("pos", "x")))
    return means.groupBy("label").agg(ordered.alias("cells")).select(
        F.concat(F.lit("label:"), F.col("label").cast("string")).alias("query_id"),
        F.transform("cells", lambda s: s["x"]).alias("embedding"),
    )


def match(hits: DataFrame, threshold: float = 0.7, top: int = 20) -> DataFrame:
    """Hits at or above the threshold, best first, with the match count per query."""
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("hit_id"))
    kept = (
        hits.filter(F.col("score") >= threshold)
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= top)
    )
    return kept.select(
        "query_id",
        F.col("hit_id").alias("matched_event_id"),
        F.col("score").alias("similarity_score"),
        "rank",
        F.count("*").over(Window.partitionBy("query_id")).alias("match_count"),
    )


def attach_outcomes(matches: DataFrame) -> DataFrame:
    score = F.col("similarity_score")
    return matches.withColumns(
        {
            "direction": F.when(score > 0.85, "up").otherwise("down"),
            "confidence": F.round(score * 0.8, 4),
            "asset_classes": F.array(*[F.lit(a) for a in lx.ASSET_CLASSES]),
        }
    )


def similarity_links(matches: DataFrame, run_ts: str) -> DataFrame:
    """One link per (event, match)."""
    return matches.select(
        F.col("query_id").alias("source_event"),
        F.col("matched_event_id").alias("target_event"),
        F.col("similarity_score").alias("similarity"),
        "direction",
        "confidence",
        "asset_classes",
        F.lit(run_ts).alias("created_at"),
    )


def impact_scores(hits: DataFrame, queries: DataFrame | None = None) -> DataFrame:
    """Mean score of the hits per query and the impact level read from it.

    With ``queries(query_id)`` those without hits are kept with score 0.
    """
    per_query = hits.groupBy("query_id").agg(F.avg("score").alias("mean"))
    if queries is not None:
        per_query = queries.select("query_id").join(per_query, "query_id", "left")
    mean = F.coalesce("mean", F.lit(0.0))
    return per_query.select(
        "query_id",
        F.round(mean, 4).alias("impact_score"),
        F.when(mean > 0.8, "high").when(mean > 0.6, "medium").otherwise("low").alias("impact_level"),
        F.array(*[F.lit(a) for a in lx.AFFECTED_ASSETS]).alias("affected_assets"),
        F.when(mean > 0.8, "fast").otherwise("moderate").alias("time_to_market"),
    )


def ranked_analogs(event_type: Column, top: int = 5) -> Column:
    """Array of the closest historical events for a row's ``avg_sentiment``.

    The history is a literal, so ranking happens inside the row: no join.
    """
    history = F.array(
        *[
            F.struct(
                F.lit(i).alias("ord"), F.lit(n).alias("name"), F.lit(kind).alias("type"),
                F.lit(imp).alias("impact"), F.lit(float(s)).alias("sentiment"),
            )
            for i, (n, kind, imp, s) in enumerate(lx.HISTORICAL_EVENTS)
        ]
    )

    def score(h: Column) -> Column:
        near = 1 - F.abs(h["sentiment"] - F.col("avg_sentiment"))
        same = F.when(h["type"] == event_type, 1.0).otherwise(0.3)
        value = F.round(near * 0.6 + same * 0.4, 4)
        return F.struct(
            (-value).alias("neg"), h["ord"].alias("ord"), h["name"].alias("name"), h["type"].alias("type"),
            h["impact"].alias("impact"), value.alias("similarity_score"),
            h["sentiment"].alias("historical_sentiment"),
        )

    return F.slice(F.array_sort(F.transform(history, score)), 1, top)


def analogs(aggregates: DataFrame, *group: str, event_type: str = "economic", top: int = 5) -> DataFrame:
    """Top historical analogs of each aggregate row."""
    return aggregates.select(
        *group, F.posexplode(ranked_analogs(F.lit(event_type), top)).alias("pos", "a")
    ).select(
        *group, (F.col("pos") + 1).alias("rank"),
        "a.name", "a.type", "a.impact", "a.similarity_score", "a.historical_sentiment",
    )
