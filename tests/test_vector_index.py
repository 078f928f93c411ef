import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewire.operators import similarity, vector_index
from tidewire.session import scratch_dir

RNG = np.random.default_rng(11)
CENTERS = RNG.standard_normal((24, 12))
VECTORS = CENTERS[np.arange(1200) % 24] + 0.25 * RNG.standard_normal((1200, 12))
VECTORS[400:800] = VECTORS[400]  # a third of the rows are copies of one
VECTORS[7] = 0.0


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(VECTORS)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5).persist()


@pytest.fixture(scope="module")
def index(spark, corpus):
    return vector_index.build_index(corpus, scratch_dir(spark, "test-index"), cells=30)


def rows(hits):
    return sorted((r.query_id, r["rank"], r.hit_id, r.score) for r in hits.collect())


def asked(corpus):
    return corpus.where("vec_id % 20 = 0")


def test_exact_search_equals_brute_force(corpus, index):
    got = vector_index.search_index(asked(corpus), index, 20, skip_self=True, exact=True)
    assert rows(got) == rows(similarity.top_k(asked(corpus), corpus, 20, skip_self=True))


@pytest.mark.parametrize("probes", [1, 3])
def test_bounds_mend_any_number_of_probes(corpus, index, probes):
    got = vector_index.search_index(asked(corpus), index, 7, probes=probes, exact=True)
    assert rows(got) == rows(similarity.top_k(asked(corpus), corpus, 7))


def test_queries_joined_by_cell_give_the_same(corpus, index, monkeypatch):
    monkeypatch.setattr(vector_index, "BLOCK_ROWS", 100)
    monkeypatch.setattr(vector_index, "QUERY_BLOCK", 16)
    blocked = vector_index.build_index(corpus, scratch_dir(corpus.sparkSession, "test-blocks"), cells=30)
    want = rows(similarity.top_k(asked(corpus), corpus, 20, skip_self=True))
    got = vector_index.search_index(asked(corpus), blocked, 20, skip_self=True, exact=True, broadcast_bytes=0)
    assert rows(got) == want


def test_the_second_look_scores_few_pairs(corpus, index):
    q = similarity._two_columns(asked(corpus), "vec_id", "embedding")
    first = vector_index.probe_cells(q, index, 2)
    hits = vector_index.search_index(asked(corpus), index, 10, probes=2)
    second = vector_index.bound_cells(q, hits.drop("rank"), index, 10, probes=2)

    def pairs(looked):
        return sum(int(index.rows[r.cells].sum()) for r in looked.collect())

    assert 0 < pairs(first) + pairs(second) < 0.5 * q.count() * len(VECTORS)


def test_recall_of_the_chosen_probes(corpus, index):
    want = {(q, h) for q, _, h, _ in rows(similarity.top_k(asked(corpus), corpus, 20, skip_self=True))}
    got = {(q, h) for q, _, h, _ in rows(vector_index.search_index(asked(corpus), index, 20, skip_self=True))}
    assert len(want & got) >= 0.9 * len(want)
    assert index.probes < 30


def test_recall_on_the_given_vectors(spark, sf_dir):
    given = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    index = vector_index.build_index(given, scratch_dir(spark, "test-given"))
    queries = given.where("vec_id % 20 = 0")
    want = {(q, h) for q, _, h, _ in rows(similarity.top_k(queries, given, 20, skip_self=True))}
    got = {(q, h) for q, _, h, _ in rows(vector_index.search_index(queries, index, 20, skip_self=True))}
    assert len(want & got) >= 0.9 * len(want)


def test_a_search_reads_only_probed_partitions(spark, corpus, index):
    hits = vector_index.search_index(corpus.where("vec_id = 40"), index, 5, probes=2)
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [cell" in plan and "IN (" in plan
    found = vector_index._read(spark, index, [3, 5])
    assert {r.cell for r in found.select("cell").distinct().collect()} == {3, 5}


def test_every_row_is_indexed_and_the_index_reopens(spark, corpus, index):
    stored = spark.read.parquet(f"{index.path}/vectors")
    assert stored.count() == len(VECTORS) == index.rows.sum()
    again = vector_index.open_index(spark, index.path)
    assert again.probes == index.probes and np.allclose(again.centroids, index.centroids) and (again.rows == index.rows).all()
    assert rows(vector_index.search_index(asked(corpus), again, 3)) == rows(vector_index.search_index(asked(corpus), index, 3))


def test_empty_sides(spark, corpus, index):
    assert vector_index.search_index(corpus.where("false"), index).count() == 0
    nothing = vector_index.build_index(corpus.where("false"), scratch_dir(spark, "test-empty"))
    assert vector_index.search_index(asked(corpus), nothing, exact=True).count() == 0
    one = vector_index.build_index(corpus.where("vec_id = 5"), scratch_dir(spark, "test-one"))
    got = vector_index.search_index(corpus.where(F.col("vec_id").isin(5, 7)), one, exact=True)
    assert [(q, h) for q, _, h, _ in rows(got)] == [("5", "5"), ("7", "5")]
