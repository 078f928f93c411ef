import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from tidewire.operators import similarity

RNG = np.random.default_rng(3)
VECTORS = RNG.standard_normal((300, 16))
VECTORS[100:200] = VECTORS[100]  # a third of the rows are copies of one
VECTORS[299] = 0.0


@pytest.fixture(scope="module")
def vectors(spark):
    rows = [(i, [float(x) for x in v], i % 3) for i, v in enumerate(VECTORS)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(5).persist()


def brute(queries, k, skip_self=False):
    unit = similarity.unit(VECTORS.astype(np.float32).astype(float))
    out = {}
    for q in queries:
        scored = [(-round(float(unit[q] @ unit[c]), 6), str(c)) for c in range(len(unit)) if not (skip_self and c == q)]
        out[str(q)] = [(c, -s) for s, c in sorted(scored)[:k]]
    return out


def collected(hits):
    out = {}
    for r in sorted(hits.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.hit_id, r.score))
    return out


def same(got, want):
    assert got.keys() == want.keys()
    for q in want:
        assert [c for c, _ in got[q]] == [c for c, _ in want[q]]
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]], atol=2e-6)


def test_exact_search(vectors):
    queries = vectors.filter("vec_id in (0, 5, 150)")
    same(collected(similarity.top_k(queries, vectors, 7)), brute([0, 5, 150], 7))


def test_block_join_gives_the_same(vectors, monkeypatch):
    monkeypatch.setattr(similarity, "BLOCK_ROWS", 64)
    got = similarity.top_k(vectors, vectors, 4, skip_self=True, broadcast_bytes=0)
    same(collected(got), brute(range(300), 4, skip_self=True))


def test_small_score_slices_give_the_same(vectors, monkeypatch):
    monkeypatch.setattr(similarity, "SCORE_CELLS", 50)
    same(collected(similarity.top_k(vectors.filter("vec_id < 9"), vectors, 3)), brute(range(9), 3))


def test_hashed_search_scores_exactly_and_finds_copies(vectors):
    got = collected(similarity.top_k(vectors.filter("vec_id = 100"), vectors, 20, lsh=(8, 4, 1)))
    assert got["100"] == brute([100], 20)["100"]
    some = collected(similarity.top_k(vectors.filter("vec_id < 50"), vectors, 1, skip_self=True, lsh=(16, 4, 1)))
    want = brute(range(50), 1, skip_self=True)
    right = sum(some.get(q, [None])[0] == want[q][0] for q in want)
    assert right >= 35


def test_hashed_search_scores_few_pairs(spark, vectors, monkeypatch):
    pairs = similarity.candidates(*(similarity._two_columns(vectors, "vec_id", "embedding") for _ in range(2)), (2, 8, 1), 16)
    found = {tuple(r) for r in pairs.collect()}
    assert 300 <= len(found) < 0.35 * 300 * 300  # a third of the rows are copies, which must all meet
    assert all((str(a), str(b)) in found for a in range(100, 200, 9) for b in range(100, 200, 9))
    monkeypatch.setattr(similarity, "HOT_BUCKET", 20)
    split = similarity.candidates(*(similarity._two_columns(vectors, "vec_id", "embedding") for _ in range(2)), (2, 8, 1), 16)
    assert {tuple(r) for r in split.collect()} == found


def test_a_task_returns_one_list_per_query(vectors):
    import pyarrow as pa

    q = similarity.unit(VECTORS[:5])
    batches = [
        pa.RecordBatch.from_arrays([pa.array([str(i) for i in range(a, a + 30)]), pa.array(VECTORS[a : a + 30].tolist())], ["id", "vec"])
        for a in range(0, 300, 30)
    ]
    out = list(similarity._search(iter(batches), np.array(list("01234")), q, 4, True))
    assert len(out) == 1 and out[0].num_rows == 20


def test_no_queries(vectors):
    assert similarity.top_k(vectors.filter("false"), vectors).count() == 0


def test_centroids(vectors):
    got = {r.query_id: r.embedding for r in similarity.label_centroids(vectors).collect()}
    for label in range(3):
        assert np.allclose(got[f"label:{label}"], VECTORS[label::3].mean(axis=0), atol=1e-5)


HITS = "query_id string, hit_id string, score double"


def test_match_outcomes_links_impact(spark):
    hits = spark.createDataFrame(
        [("q", "a", 0.69), ("q", "b", 0.70), ("q", "c", 0.85), ("q", "d", 0.86), ("r", "a", 0.1)], HITS
    )
    matched = similarity.match(hits)
    got = [(r.matched_event_id, r["rank"], r.match_count) for r in matched.orderBy("rank").collect()]
    assert got == [("d", 1, 3), ("c", 2, 3), ("b", 3, 3)]
    assert similarity.match(hits, top=1).count() == 1
    links = similarity.similarity_links(similarity.attach_outcomes(matched), "now").orderBy("target_event").collect()
    assert [(r.target_event, r.direction, r.confidence) for r in links] == [
        ("b", "down", 0.56), ("c", "down", 0.68), ("d", "up", 0.688)
    ]
    assert links[0].asset_classes == ["equities", "bonds", "commodities"] and links[0].created_at == "now"
    queries = spark.createDataFrame([("q",), ("r",), ("s",)], "query_id string")
    impact = {r.query_id: r for r in similarity.impact_scores(hits, queries).collect()}
    assert (impact["q"].impact_score, impact["q"].impact_level, impact["q"].time_to_market) == (0.775, "medium", "moderate")
    assert (impact["s"].impact_score, impact["s"].impact_level) == (0.0, "low")


def test_analogs(spark):
    rows = similarity.analogs(spark.createDataFrame([("g", -0.6)], "k string, avg_sentiment double"), "k").collect()
    assert [(r.name, r.similarity_score) for r in rows] == [
        ("European Debt Crisis 2011", 1.0), ("2008 Financial Crisis", 0.82), ("Tech Bubble 2000", 0.72),
        ("Russia-Ukraine War 2022", 0.66), ("Brexit Vote 2016", 0.66),
    ]


def test_search_holds_few_scores_at_once():
    """Memory is bounded by blocks, not by a batch of the corpus times the queries."""
    rnd = np.random.default_rng(5)
    c, q = rnd.standard_normal((20_000, 16)), similarity.unit(rnd.standard_normal((500, 16)))
    ids = [str(i) for i in range(len(c))]
    batches = [pa.RecordBatch.from_arrays([pa.array(ids[i : i + 10_000]), pa.array(list(c[i : i + 10_000]))], ["id", "vec"]) for i in (0, 10_000)]
    tracemalloc.start()
    (found,) = similarity._search(iter(batches), np.array(ids[:500]), q, 5, False)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    micro = np.rint(q @ similarity.unit(c).T * 1e6)
    got = list(zip(found.column(0).to_pylist(), found.column(1).to_pylist(), found.column(2).to_pylist()))
    best = -np.sort(-micro, axis=1)[:, :5] / 1e6
    assert [s for *_, s in sorted(got, key=lambda r: (int(r[0]), -r[2]))] == best.ravel().tolist()
    assert peak < 64 << 20
