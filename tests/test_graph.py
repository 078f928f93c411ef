import random
from collections import deque

from tidewire.operators import enrich, graph, graph_queries, nlp

EDGES = "source string, target string, type string, relation string, weight double"


def make_edges(spark, *pairs, weight=1.0):
    return spark.createDataFrame([(a, b, "t", "R", weight) for a, b in pairs], EDGES)


def tagged(make_articles, *rows):
    return nlp.score_sentiment(enrich.extract_entities(make_articles(*rows)))


def test_nodes_and_edges(make_articles):
    rows = tagged(
        make_articles,
        {"event_id": "e1", "title": "NATO in Syria", "content": "war crisis"},
        {"event_id": "e2", "title": "Syria", "content": "growth"},
        {"event_id": "e3", "title": None, "content": "x"},
    )
    nodes = graph.build_nodes(rows)
    assert sorted(r.id for r in nodes.collect()) == ["country:syria", "e1", "e2", "e3", "org:nato"]
    labels = {r.id: r.label for r in nodes.collect()}
    assert labels["e3"] == "Untitled Event" and labels["country:syria"] == "Syria"
    for edges in (graph.build_edges(rows), graph.build_edges(rows, nodes)):
        got = {(r.source, r.target, r.relation, r.weight) for r in edges.collect()}
        assert got == {
            ("e1", "country:syria", "MENTIONS", 0.8), ("e1", "org:nato", "MENTIONS", 0.7),
            ("e2", "country:syria", "MENTIONS", 0.8), ("e1", "market:global", "AFFECTS", 1.0),
        }
    only = nodes.filter("id <> 'org:nato'")
    assert graph.build_edges(rows, only).filter("target = 'org:nato'").count() == 0
    stats = graph.graph_stats(nodes, graph.merge_edges(graph.build_edges(rows))).first()
    assert (stats.nodes, stats.edges, stats.density) == (6, 4, round(4 / 30, 4))


def test_merge_keeps_the_last_edge(spark):
    rows = [("a", "b", "t", "R", 1.0, 1), ("a", "b", "t", "S", 0.5, 2), ("a", "c", "t", "R", 1.0, 1)]
    edges = spark.createDataFrame(rows, EDGES + ", ord int")
    got = {(r.target, r.relation, r.weight) for r in graph.merge_edges(edges, "ord").collect()}
    assert got == {("b", "S", 0.5), ("c", "R", 1.0)}


def test_centrality(spark):
    edges = make_edges(spark, ("a", "h"), ("b", "h"), ("h", "c"))
    nodes = spark.createDataFrame([("lone",)], "id string")
    rows = graph.centrality(nodes, edges, top=2).collect()
    assert [(r.id, r.centrality, r.avg_degree) for r in rows] == [("h", 0.75, 1.2), ("a", 0.25, 1.2)]


def test_small_graph_density(spark):
    one = spark.createDataFrame([("x",)], "id string")
    assert graph.graph_stats(one, make_edges(spark, ("a", "b")).filter("false")).first().density == 0.0


PATHS = [("a", "b"), ("a", "c"), ("b", "d"), ("c", "d"), ("d", "a"), ("d", "e"), ("x", "a")]


def brute_paths(pairs, source, target, cutoff):
    out, queue = [], deque([[source]])
    while queue:
        path = queue.popleft()
        if path[-1] == target and len(path) > 1:
            out.append(path)
            continue
        if len(path) <= cutoff:
            queue.extend(path + [b] for a, b in pairs if a == path[-1] and b not in path)
    return sorted(out, key=lambda p: (len(p), p))


def test_shortest_path(spark):
    edges = make_edges(spark, *PATHS)
    row = graph_queries.shortest_path(edges, "x", "e").first()
    assert (row.path, row.length) == (brute_paths(PATHS, "x", "e", 9)[0], 4)
    assert graph_queries.shortest_path(edges, "e", "a").first().path is None
    assert graph_queries.shortest_path(edges, "a", "a").first().length == 0
    assert graph_queries.shortest_path(edges, "a", "nowhere").count() == 0


def test_shortest_path_has_no_hop_limit(spark):
    chain = spark.createDataFrame([(f"n{i:03d}", f"n{i + 1:03d}") for i in range(20)], "source string, target string")
    row = graph_queries.shortest_path(chain, "n000", "n020").first()
    assert row.length == 20 and row.path[-1] == "n020"


def test_causal_paths(spark):
    edges = make_edges(spark, *PATHS)
    got = graph_queries.causal_paths(edges, "e").collect()
    assert [r.path for r in got] == brute_paths(PATHS, "x", "e", 5)[:5]
    assert [(e.source, e.target) for e in got[0].edges] == list(zip(got[0].path, got[0].path[1:]))
    two = graph_queries.causal_paths(edges, "d", sources=["a", "x"], max_paths=3).collect()
    want = sorted(brute_paths(PATHS, "a", "d", 5) + brute_paths(PATHS, "x", "d", 5), key=lambda p: (len(p), p))
    assert [r.path for r in two] == want[:3]


def counted(monkeypatch):
    """(label, rows) of every table that a search writes."""
    written, plain = [], graph_queries.cut_lineage

    def note(df, label):
        out = plain(df, label)
        written.append((label, out.count()))
        return out

    monkeypatch.setattr(graph_queries, "cut_lineage", note)
    return written


def test_shortest_path_meets_half_way(spark, monkeypatch):
    chain = spark.createDataFrame([(f"n{i:03d}", f"n{i + 1:03d}") for i in range(21)], "source string, target string")
    written = counted(monkeypatch)
    for goal in (20, 21):
        written.clear()
        assert graph_queries.shortest_path(chain, "n000", f"n{goal:03d}").first().length == goal
        assert sum(label == "layers" for label, _ in written) == (goal + 1) // 2


def test_shortest_path_on_random_graphs(spark):
    rnd = random.Random(6)
    for n, m in ((12, 20), (9, 40), (30, 60)):
        pairs = sorted({(f"v{rnd.randrange(n):02d}", f"v{rnd.randrange(n):02d}") for _ in range(m)})
        edges = make_edges(spark, *pairs, ("v00", "v00"))
        for goal in ("v01", "v05", "v08"):
            want = next(iter(brute_paths([p for p in pairs if p[0] != p[1]], "v00", goal, 12 if n < 20 else 6)), None)
            row = graph_queries.shortest_path(edges, "v00", goal).first()
            if row is not None and (want or row.path):
                assert row.path == want


def test_a_hub_on_one_side_waits(spark, monkeypatch):
    pairs = [("s", f"leaf{i}") for i in range(40)] + [(f"leaf{i}", f"far{i}") for i in range(40)] + [("s", "p"), ("p", "q"), ("q", "t")]
    written = counted(monkeypatch)
    row = graph_queries.shortest_path(make_edges(spark, *pairs), "s", "t").first()
    assert row.path == ["s", "p", "q", "t"]
    assert all(rows <= 42 for label, rows in written if label == "layers")


def test_first_paths_of_dense_graphs(spark, monkeypatch):
    rnd = random.Random(2)
    written = counted(monkeypatch)
    for n, density in ((7, 1.0), (9, 0.5)):
        names = [f"v{i}" for i in range(n)]
        pairs = [(a, b) for a in names for b in names if a != b and rnd.random() < density]
        for k, limit in ((5, 5), (12, 3)):
            written.clear()
            got = graph_queries.causal_paths(make_edges(spark, *pairs), "v1", sources=["v0", "v2"], max_paths=k, max_edges=limit).collect()
            want = sorted((p for s in ("v0", "v2") for p in brute_paths(pairs, s, "v1", limit)), key=lambda p: (len(p), p))
            assert [r.path for r in got] == want[:k]
            # A round keeps a label per branch and node, and no round has more than ``limit`` branches (or two sources).
            assert all(rows <= limit * n for label, rows in written if label == "labels")


def test_first_paths_that_do_not_exist(spark):
    edges = make_edges(spark, ("a", "b"), ("b", "a"), ("c", "d"))
    assert graph_queries.causal_paths(edges, "d", sources=["a"]).collect() == []
    assert [r.path for r in graph_queries.causal_paths(edges, "b", sources=["a", "b"], max_paths=9).collect()] == [["a", "b"]]


def test_neighbors_subgraph_impact(spark):
    edges = make_edges(spark, *PATHS).unionByName(make_edges(spark, ("a", "z"), weight=2.0))
    assert {(r.neighbor, r["count"]) for r in graph_queries.neighbors(edges, "a").collect()} == {
        ("b", 3), ("c", 3), ("z", 3)
    }
    members = spark.createDataFrame([("a",), ("b",), ("d",), ("gone",)], "id string")
    nodes = spark.createDataFrame([("a",)], "id string")
    row = graph_queries.subgraph(nodes, edges, members).first()
    assert (row.subgraph_nodes, row.subgraph_edges) == (3, 3)
    top = graph_queries.impact(edges, "a", top=2).collect()
    assert [(r.to_node, r.weight) for r in top] == [("z", 2.0), ("b", 1.0)]
    assert graph_queries.impact(edges, top=1).filter("from_node = 'a'").first().to_node == "z"


def test_upsert(spark):
    old, new = make_edges(spark, ("a", "b"), ("a", "c"), weight=9.0), make_edges(spark, ("a", "b"), ("d", "e"))
    got = {(r.source, r.target): r.weight for r in graph.upsert_edges(old, new).collect()}
    assert got == {("a", "b"): 1.0, ("a", "c"): 9.0, ("d", "e"): 1.0}
