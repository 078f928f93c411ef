"""A stored vector index: cells around centroids, probed by partition, with exact bounds on what a cell can hold.

Vectors lie in the cell of the nearest centroid, one table partition per cell.
A search reads the partitions of the cells that its queries probe and no others.
Each cell knows the least and the greatest angle between its centroid and its
vectors; by the triangle inequality a cell whose best possible score is below a
query's k-th best hit holds none, so a second look at the few cells that could
makes the search exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.operators.similarity import (
    BROADCAST_BYTES, HITS, SCORE_CELLS, SCORE_ROWS, _BestSoFar, _keep_best, _search, _two_columns, best_per_query, matrix_of, top_k, unit,
)
from tidewire.session import cut_lineage

MOST_CELLS = 4096  # bounds what a search knows of the index: cells x dimensions numbers
SAMPLE_ROWS = 65_536  # rows that the centroids are fitted on, at most
TRIAL_QUERIES = 256  # rows that the number of probes is chosen with, at most
BLOCK_ROWS = 50_000  # rows of a cell that one task writes or joins
QUERY_BLOCK = 4096  # queries that one task joins with a block
SLACK = 1e-5  # radians; covers rounding of angles and scores


@dataclass(frozen=True)
class VectorIndex:
    """What a search needs to know of a stored index; the vectors stay in the table."""

    path: str
    centroids: np.ndarray  # cells x dimensions, of length one
    near: np.ndarray  # least angle of a cell's vectors
    far: np.ndarray  # greatest one; below ``near`` for an empty cell
    rows: np.ndarray
    probes: int  # cells that reach the target recall


def _angles(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Angles between rows of length one; a zero row is at a right angle to everything."""
    return np.arccos(np.clip(vectors @ centroids.T, -1.0, 1.0))


def fit_centroids(vectors: np.ndarray, cells: int, rounds: int = 10, seed: int = 7) -> np.ndarray:
    """Spherical k-means on a bounded sample. Cells that run empty take the rows that fit worst."""
    vectors = vectors[np.linalg.norm(vectors, axis=1) > 0]
    cells = max(1, min(cells, len(vectors)))
    if not len(vectors):
        return np.zeros((1, vectors.shape[1]))
    rng = np.random.default_rng(seed)
    centroids = vectors[rng.choice(len(vectors), cells, replace=False)]
    for _ in range(rounds):
        own, fit = np.empty(len(vectors), np.int64), np.empty(len(vectors))
        step = max(1, SCORE_CELLS // cells)
        for at in range(0, len(vectors), step):
            scores = vectors[at : at + step] @ centroids.T
            own[at : at + step] = scores.argmax(1)
            fit[at : at + step] = scores.max(1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, vectors)
        empty = np.flatnonzero(np.bincount(own, minlength=cells) == 0)
        sums[empty] = vectors[np.argsort(fit)[: len(empty)]]
        centroids = unit(sums)
    return centroids


def _assigned(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(id, vec, cell, angle): the nearest centroid of each vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            cell, angle = np.empty(batch.num_rows, np.int32), np.empty(batch.num_rows)
            step = max(1, SCORE_CELLS // len(centroids))
            for at in range(0, batch.num_rows, step):
                angles = _angles(unit(matrix_of(batch.column(1).slice(at, step))), centroids)
                cell[at : at + step] = angles.argmin(1)
                angle[at : at + step] = angles.min(1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(angle)], names=["id", "vec", "cell", "angle"])

    return vectors.mapInArrow(run, "id string, vec array<float>, cell int, angle double")


def build_index(
    corpus: DataFrame, path: str, corpus_id: str = "vec_id", corpus_vec: str = "embedding", cells: int | None = None,
    k: int = 20, target_recall: float = 0.95, seed: int = 7,
) -> VectorIndex:
    """Write the index of ``corpus`` to ``path`` (in shared storage) and return what a search needs.

    Every row is indexed; only the centroids are fitted on a sample of at most
    ``SAMPLE_ROWS`` rows and the number of probes on ``TRIAL_QUERIES`` queries,
    both picked by a hash of the id. Cells default to the root of the row count. A
    cell of over ``BLOCK_ROWS`` rows is written and joined in blocks, so copies of
    one vector, which share a cell, do not meet in one task.
    """
    spark = corpus.sparkSession
    known = _two_columns(corpus, corpus_id, corpus_vec).withColumn("vec", F.col("vec").cast("array<float>"))
    n = known.count()
    cells = cells or int(min(MOST_CELLS, max(1, round(n**0.5))))
    order = F.xxhash64("id", F.lit(seed))
    sample = known.orderBy(order, "id").limit(min(SAMPLE_ROWS, 64 * cells)).toArrow()
    dim = len(sample.column("vec")[0]) if sample.num_rows else 1
    vectors = unit(matrix_of(sample.column("vec"))) if sample.num_rows else np.zeros((0, dim))
    centroids = fit_centroids(vectors, cells, seed=seed)
    placed = cut_lineage(_assigned(known, centroids), "placed")
    facts = placed.groupBy("cell").agg(F.count("*").alias("rows"), F.min("angle").alias("near"), F.max("angle").alias("far"))
    facts = facts.orderBy("cell").collect()  # a row per cell
    near, far, rows = np.full(len(centroids), 4.0), np.full(len(centroids), -1.0), np.zeros(len(centroids), np.int64)
    for f in facts:
        near[f.cell], far[f.cell], rows[f.cell] = f.near, f.far, f.rows
    blocks = spark.createDataFrame([(f.cell, -(-f.rows // BLOCK_ROWS)) for f in facts], "cell int, blocks long")
    block = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    dealt = placed.join(F.broadcast(blocks), "cell").select("id", "vec", block.alias("block"), "cell")
    dealt.repartition("cell", "block").write.partitionBy("cell").parquet(f"{path}/vectors")
    index = VectorIndex(path, centroids, near, far, rows, len(centroids))
    if n:
        index = VectorIndex(path, centroids, near, far, rows, _probes(index, known, placed, k, target_recall, order))
    table = [(i, c.tolist(), float(a), float(b), int(m), index.probes) for i, (c, a, b, m) in enumerate(zip(centroids, near, far, rows))]
    spark.createDataFrame(table, "cell int, centroid array<double>, near double, far double, rows long, probes int").write.parquet(f"{path}/cells")
    return index


def _probes(index: VectorIndex, known: DataFrame, placed: DataFrame, k: int, target: float, order) -> int:
    """The least number of nearest cells that hold the target share of the trial queries' exact hits."""
    trial = known.orderBy(order.desc(), "id").limit(TRIAL_QUERIES)
    asked = trial.toArrow()
    hits = top_k(trial, known, k, query_id="id", corpus_id="id", query_vec="vec", corpus_vec="vec", skip_self=True)
    found = placed.select(F.col("id").alias("hit_id"), "cell").join(F.broadcast(hits.select("query_id", "hit_id")), "hit_id").toArrow()
    if not found.num_rows:
        return 1
    rank = np.argsort(np.argsort(_angles(unit(matrix_of(asked.column("vec"))), index.centroids), axis=1, kind="stable"), axis=1)
    row = {q: i for i, q in enumerate(asked.column("id").to_pylist())}
    rows = [row[q] for q in found.column("query_id").to_pylist()]
    needed = np.sort(rank[rows, found.column("cell").to_numpy()])
    return int(needed[max(0, int(np.ceil(target * len(needed))) - 1)]) + 1


def open_index(spark: SparkSession, path: str) -> VectorIndex:
    """The index written at ``path``; reads a row per cell."""
    rows = spark.read.parquet(f"{path}/cells").orderBy("cell").collect()
    column = lambda name, kind: np.array([r[name] for r in rows], kind)
    return VectorIndex(path, np.array([r.centroid for r in rows]), column("near", float), column("far", float), column("rows", np.int64), rows[0].probes)


def _best_score(angles: np.ndarray, index: VectorIndex) -> np.ndarray:
    """The best score that each cell can hold for a query at these angles from its centroid; -2 for an empty cell."""
    apart = np.maximum(np.maximum(angles - index.far, index.near - angles) - SLACK, 0.0)
    return np.where(index.rows > 0, np.cos(np.minimum(apart, np.pi)), -2.0)


def _probed(asked: DataFrame, index: VectorIndex, probes: int, second: bool) -> DataFrame:
    """(id, vec, cells): the cells that each query looks into.

    First the ``probes`` nearest cells; in the second round, of the others, those
    that can hold a score of at least ``floor``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            step = max(1, SCORE_CELLS // len(index.centroids))
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                angles = _angles(unit(matrix_of(part.column(1))), index.centroids)
                angles[:, index.rows == 0] = 9.0
                order = np.argsort(angles, axis=1, kind="stable")
                if second:
                    able = _best_score(angles, index) >= part.column(2).to_numpy()[:, None]
                    able[np.arange(len(able))[:, None], order[:, :probes]] = False
                    chosen = [np.flatnonzero(x) for x in able]
                else:
                    chosen = [o[index.rows[o] > 0] for o in order[:, :probes]]
                cells = pa.array([c.astype(np.int32) for c in chosen], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), cells], names=["id", "vec", "cells"])

    return asked.mapInArrow(run, "id string, vec array<float>, cells array<int>")


def _read(spark: SparkSession, index: VectorIndex, cells: list[int]) -> DataFrame:
    """The partitions of these cells."""
    schema = "id string, vec array<float>, block int, cell int"
    return spark.read.schema(schema).parquet(f"{index.path}/vectors").where(F.col("cell").isin(cells))


def _score_shipped(vectors: DataFrame, ids: np.ndarray, q: np.ndarray, of_cell: dict[int, np.ndarray], k: int, skip_self: bool) -> DataFrame:
    """Hits of a query batch that goes to every task; vectors are scored where they are read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _BestSoFar(ids, k)
        for batch in batches:
            cell = batch.column(2).to_numpy()
            order = np.argsort(cell, kind="stable")
            edge = np.flatnonzero(np.diff(cell[order], prepend=-1)) if len(order) else []
            blocks = np.split(order, edge[1:]) if len(order) else []
            for rows in (b[i : i + SCORE_ROWS] for b in blocks for i in range(0, len(b), SCORE_ROWS)):
                part = batch.take(pa.array(rows))
                c_ids, c = np.array(part.column(0).to_pylist(), dtype=str), unit(matrix_of(part.column(1)))
                asking = of_cell[int(cell[rows[0]])]
                step = max(1, SCORE_CELLS // len(c_ids))
                for at in range(0, len(asking), step):
                    some = asking[at : at + step]
                    found, hit_ids, scores = best_per_query(ids[some], q[some], c_ids, c, k, skip_self)
                    best.add((some[found], hit_ids, scores))
        yield best.batch()

    return vectors.select("id", "vec", "cell").mapInArrow(run, HITS)


def _score_joined(pairs: DataFrame, vectors: DataFrame, index: VectorIndex, asked: int, k: int, skip_self: bool) -> DataFrame:
    """Hits of a query table too large to ship: queries and vectors meet by cell and block."""
    blocks = pairs.sparkSession.createDataFrame(
        [(int(i), int(-(-m // BLOCK_ROWS))) for i, m in enumerate(index.rows) if m], "cell int, blocks int"
    )
    parts = -(-asked // QUERY_BLOCK)
    left = (
        pairs.select("id", "vec", F.explode("cells").alias("cell")).join(F.broadcast(blocks), "cell")
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("part", F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int"))
    )
    right = vectors.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    empty = pa.schema([("query_id", pa.string()), ("hit_id", pa.string()), ("score", pa.float64())])

    def meet(asking: pa.Table, held: pa.Table) -> pa.Table:
        if not asking.num_rows or not held.num_rows:
            return empty.empty_table()
        ids, q = np.array(asking.column("id").to_pylist(), dtype=str), unit(matrix_of(asking.column("vec")))
        return pa.Table.from_batches(_search(iter(held.select(["id", "vec"]).to_batches()), ids, q, k, skip_self))

    keys = ("cell", "block", "part")
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(meet, HITS)


def _round(pairs: DataFrame, index: VectorIndex, n: int, dim: int, k: int, skip_self: bool, broadcast_bytes: int) -> DataFrame:
    spark = pairs.sparkSession
    if n * (dim * 8 + 64) <= broadcast_bytes:
        known = pairs.toArrow()
        ids, q = np.array(known.column("id").to_pylist(), dtype=str), unit(matrix_of(known.column("vec")))
        cells = [np.array(c, np.int64) for c in known.column("cells").to_pylist()]
        flat = np.concatenate([np.empty(0, np.int64), *cells])
        owner = np.repeat(np.arange(len(cells), dtype=np.int32), [len(c) for c in cells])
        of_cell = {int(c): owner[flat == c] for c in np.unique(flat)}
        return _score_shipped(_read(spark, index, sorted(of_cell)), ids, q, of_cell, k, skip_self)
    cells = [r.cell for r in pairs.select(F.explode("cells").alias("cell")).distinct().collect()]  # a row per cell at most
    return _score_joined(pairs, _read(spark, index, sorted(cells)), index, n, k, skip_self)


def probe_cells(asked: DataFrame, index: VectorIndex, probes: int | None = None) -> DataFrame:
    """(id, vec, cells) of a first look; ``asked`` is (id, vec)."""
    return _probed(asked.select("id", F.col("vec").cast("array<float>").alias("vec")), index, probes or index.probes, False)


def bound_cells(asked: DataFrame, hits: DataFrame, index: VectorIndex, k: int, probes: int | None = None) -> DataFrame:
    """(id, vec, cells) of a second look: cells that can hold a better hit than the ``k``-th found so far."""
    floors = hits.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("floor"))
    least = F.when(F.col("n") >= k, F.col("floor")).otherwise(F.lit(-1.5)).alias("floor")
    known = asked.join(floors, asked["id"] == floors["query_id"], "left").select("id", F.col("vec").cast("array<float>").alias("vec"), least)
    return _probed(known, index, probes or index.probes, True).where(F.size("cells") > 0)


def search_index(
    queries: DataFrame, index: VectorIndex, k: int = 20, query_id: str = "vec_id", query_vec: str = "embedding", skip_self: bool = False,
    probes: int | None = None, exact: bool = False, broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``query_id, hit_id, score (6 decimals), rank`` of the ``k`` best hits in the cells probed, or in all with ``exact``.

    Ids of queries must be unique. Scores are exact cosines either way; without
    ``exact`` a hit in a cell not probed is missed. A batch of queries up to
    ``broadcast_bytes`` of vectors is shipped to the tasks that read the probed
    partitions; a larger one is joined by cell.
    """
    spark = queries.sparkSession
    asked = _two_columns(queries, query_id, query_vec)
    size = asked.agg(F.count("*").alias("n"), F.max(F.size("vec")).alias("d")).first()
    if not size["n"] or not index.rows.sum():
        return spark.createDataFrame([], HITS + ", rank int")
    shape = (size["n"], size["d"], k, skip_self, broadcast_bytes)
    hits = _keep_best(_round(probe_cells(asked, index, probes), index, *shape), k)
    if not exact:
        return hits
    hits = cut_lineage(hits, "first-look").drop("rank")
    pairs = cut_lineage(bound_cells(asked, hits, index, k, probes), "second-look")
    left = pairs.count()
    if not left:
        return _keep_best(hits, k)
    return _keep_best(hits.unionByName(_round(pairs, index, left, *shape[1:])), k)
