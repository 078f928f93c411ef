"""Graph queries: neighbours, subgraph, impact, shortest and simple paths."""

from __future__ import annotations

import functools
import heapq
import itertools
from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewire.session import cut_lineage, scratch_scope

SEEN_ROUNDS = 8  # rounds of a breadth-first search between rewrites of the nodes seen
WAIT_AT = 4  # a side of a two-sided search waits while it has over so many times the other's nodes


def neighbors(edges: DataFrame, node: str) -> DataFrame:
    """Successors of a node, each with the number of successors."""
    found = edges.filter(F.col("source") == node).select(F.col("target").alias("neighbor")).distinct()
    total = found.agg(F.count("*")).scalar()
    return found.select("neighbor", total.alias("count"))


def subgraph(nodes: DataFrame, edges: DataFrame, members: DataFrame) -> DataFrame:
    """Node and edge counts of the graph induced by ``members(id)``.

    Node ids are made distinct before they are joined, so a hub counts once;
    the edge side of the semi joins may be skewed, which adaptive execution splits.
    """
    members = members.select("id").distinct()
    ends = edges.select(F.explode(F.array("source", "target")).alias("id"))
    known = nodes.select("id").unionByName(ends).distinct().join(members, "id", "left_semi")
    inside = (
        edges.select("source", "target")
        .join(members.withColumnRenamed("id", "source"), "source", "left_semi")
        .join(members.withColumnRenamed("id", "target"), "target", "left_semi")
        .distinct()
    )
    n_edges = inside.agg(F.count("*")).scalar()
    return known.agg(F.count("*").alias("subgraph_nodes")).select(
        "subgraph_nodes", n_edges.alias("subgraph_edges")
    )


def impact(edges: DataFrame, event: str | None = None, top: int = 20) -> DataFrame:
    """Heaviest out-edges of one node, or of every node.

    For all nodes the rank limit is applied before the shuffle as well, so a
    hub sends at most ``top`` rows per task.
    """
    out = edges.filter(F.col("source") != F.col("target")).select(
        F.col("source").alias("from_node"), F.col("target").alias("to_node"), "weight"
    )
    heaviest = (F.col("weight").desc(), F.col("to_node"))
    if event is not None:
        return out.filter(F.col("from_node") == event).orderBy(*heaviest).limit(top)
    ranked = Window.partitionBy("from_node").orderBy(*heaviest)
    return out.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= top)


def shortest_path(edges: DataFrame, source: str, target: str) -> DataFrame:
    """Unweighted directed path as one row ``(path, length)``; ``path`` is null if unreachable.

    Breadth first from both ends until the frontiers meet, so neither grows
    further than half the way; a side much larger than the other waits. Each new
    node carries its lexicographically least path to its own end. When the sides
    have grown to depths ``a`` and ``b`` without meeting, every path is longer than
    ``a + b``, so a first meeting lies on both outermost layers, and the least of
    the joined paths there is the least of all shortest ones. Rounds are written to
    the shared folder, the nodes seen anew every few rounds, so neither plan nor
    reads grow with the depth. Only frontier sizes and the meeting come back.
    """
    with scratch_scope(edges.sparkSession):
        return _shortest_path(edges, source, target)


def _shortest_path(edges: DataFrame, source: str, target: str) -> DataFrame:
    spark = edges.sparkSession
    plain = edges.select("source", "target").where("source <> target").distinct()
    ahead = plain.select(F.lit("ahead").alias("side"), F.col("source").alias("node"), F.col("target").alias("next"))
    back = plain.select(F.lit("back").alias("side"), F.col("target").alias("node"), F.col("source").alias("next"))
    links = cut_lineage(ahead.unionByName(back), "links")
    ends = edges.select(F.explode(F.array("source", "target")).alias("id"))
    both_known = (
        ends.filter(F.col("id").isin(source, target))
        .agg(F.count_distinct("id").alias("n"))
        .first()["n"]
    )
    answer = "path array<string>, length int"
    if both_known < len({source, target}):
        return spark.createDataFrame([], answer)
    if source == target:
        return spark.createDataFrame([([source], 0)], answer)
    start = spark.createDataFrame([("ahead", source, [source]), ("back", target, [target])], "side string, node string, path array<string>")
    layers = {side: start.where(F.col("side") == side) for side in ("ahead", "back")}
    sizes = {"ahead": 1, "back": 1}
    seen = start.select("side", "node")
    for hop in itertools.count(1):
        growing = [side for side, n in sizes.items() if n <= WAIT_AT * min(sizes.values())]
        frontier = functools.reduce(DataFrame.unionByName, (layers[side] for side in growing))
        step = F.when(F.col("side") == "ahead", F.concat("path", F.array("next"))).otherwise(F.concat(F.array("next"), "path"))
        reached = (
            links.join(frontier, ["side", "node"])
            .select("side", F.col("next").alias("node"), step.alias("path"))
            .groupBy("side", "node")
            .agg(F.min("path").alias("path"))
            .join(seen, ["side", "node"], "left_anti")
        )
        grown = cut_lineage(reached, "layers")
        found = {r["side"]: r["n"] for r in grown.groupBy("side").agg(F.count("*").alias("n")).collect()}
        before = dict(layers)
        for side in growing:
            layers[side], sizes[side] = grown.where(F.col("side") == side), found.get(side, 0)
        # The layer that grew first meets the other side as it was; if both grew, their new layers meet one hop later.
        first = {"ahead": layers["ahead"], "back": before["back"]} if "ahead" in growing else layers
        for pair in [first] + [layers] * (len(growing) == 2):
            met = (
                pair["ahead"].select("node", F.col("path").alias("head"))
                .join(pair["back"].select("node", F.expr("slice(path, 2, size(path))").alias("tail")), "node")
                .agg(F.min(F.concat("head", "tail")).alias("path")).first()["path"]
            )
            if met:
                return spark.createDataFrame([(list(met), len(met) - 1)], answer)
        if not min(sizes.values()):
            return spark.createDataFrame([(None, None)], answer)
        seen = seen.unionByName(grown.select("side", "node"))
        if hop % SEEN_ROUNDS == 0:
            seen = cut_lineage(seen, "seen")


def first_sources(edges: DataFrame, nodes: DataFrame | None = None, n: int = 3) -> DataFrame:
    """The first ``n`` nodes (by id) without incoming edges, as ``(node)``."""
    candidates = edges.select(F.col("source").alias("node"))
    if nodes is not None:
        candidates = candidates.unionByName(nodes.select(F.col("id").alias("node")))
    pointed_at = edges.select(F.col("target").alias("node"))
    # One aggregation instead of an anti join: incoming edges mark the node.
    return (
        candidates.withColumn("incoming", F.lit(0))
        .unionByName(pointed_at.withColumn("incoming", F.lit(1)))
        .groupBy("node")
        .agg(F.max("incoming").alias("incoming"))
        .filter(F.col("incoming") == 0)
        .orderBy("node")
        .limit(n)
        .select("node")
    )


def reachable_edges(edges: DataFrame, starts: DataFrame, max_hops: int) -> DataFrame:
    """Edges that leave a node within ``max_hops - 1`` hops of ``starts(node)``.

    Only new node ids are written per round; the search stops as soon as a round
    finds none, and the edges are picked once at the end.
    """
    frontier = seen = starts.select("node")
    for hop in range(max_hops - 1):
        out = edges.join(frontier, edges["source"] == frontier["node"], "left_semi")
        fresh = out.select(F.col("target").alias("node")).distinct().join(seen, "node", "left_anti")
        frontier = cut_lineage(fresh, f"front{hop}")
        if frontier.isEmpty():
            break
        seen = seen.unionByName(frontier)
    return cut_lineage(edges.join(seen, edges["source"] == seen["node"], "left_semi"), "reachable")


def default_target(edges: DataFrame) -> str | None:
    """The greatest node id without outgoing edges, or the greatest of all where every node has some."""
    ends = edges.select(F.col("target").alias("node"), F.lit(0).alias("out")).unionByName(
        edges.select(F.col("source").alias("node"), F.lit(1).alias("out"))
    )
    nodes = ends.groupBy("node").agg(F.max("out").alias("out"))
    return nodes.agg(F.coalesce(F.max(F.when(F.col("out") == 0, F.col("node"))), F.max("node"))).first()[0]


def causal_paths(
    edges: DataFrame,
    target: str | None = None,
    sources: Iterable[str] | DataFrame | None = None,
    nodes: DataFrame | None = None,
    max_edges: int = 5,
    max_paths: int = 5,
    max_sources: int = 3,
) -> DataFrame:
    """The first simple paths of at most ``max_edges`` edges to ``target``: ``(path, length, edges)``, by length and then path.

    Without a target the ``default_target`` is taken. The graph is first cut down
    to the edges the sources can reach. Backwards from the target, each node gets
    the number of hops it still needs; paths are only grown into nodes that can
    arrive in the hops that are left.

    Paths are found one after the other, each as the best of some branches. A
    branch is the set of paths that begin in a given way and do not go on to
    certain nodes; its best path comes from a breadth-first search that keeps one
    label, the least path, per node. Taking a path divides its branch along the
    path into at most ``max_edges`` new ones, searched together. So a round writes
    at most a label per branch and node, however many paths the graph has.
    Of parallel edges the one of least relation and weight is shown.
    """
    spark = edges.sparkSession
    target = default_target(edges) if target is None else target
    if sources is None:
        starts = first_sources(edges, nodes, max_sources)
    elif isinstance(sources, DataFrame):
        starts = sources.select("node").orderBy("node").limit(max_sources)
    else:
        starts = spark.createDataFrame([(s,) for s in list(sources)[:max_sources]], "node string")
    starts = cut_lineage(starts.distinct(), "starts")
    links = reachable_edges(edges.select("source", "target", "relation", "weight"), starts, max_edges)

    # Hops still needed from each node: a backward search over new nodes only.
    frontier = to_go = spark.createDataFrame([(target, 0)], "node string, need int")
    for need in range(1, max_edges):
        back = links.select("source", F.col("target").alias("node")).join(frontier, "node", "left_semi")
        fresh = back.select(F.col("source").alias("node")).distinct().join(to_go, "node", "left_anti")
        frontier = cut_lineage(fresh.withColumn("need", F.lit(need)), f"need{need}")
        if frontier.isEmpty():
            break
        to_go = to_go.unionByName(frontier)
    useful = links.join(to_go.withColumnRenamed("node", "target"), "target").where("source <> target")
    useful = cut_lineage(useful.select("source", "target", "need").distinct(), "useful")

    # Branches: (first nodes of the path, nodes not to go on to). The driver holds these few, never paths at large.
    branches = [([r["node"]], []) for r in starts.collect() if r["node"] != target]
    best: list[tuple[int, list[str]]] = []  # the best path of each open branch
    taken: list[list[str]] = []
    open_to: dict[tuple[str, ...], tuple[int, list[str]]] = {}  # how many first nodes its branch fixes, and what it excludes
    while len(taken) < max_paths:
        for branch, path in _best_of(useful, branches, target, max_edges).items():
            open_to[tuple(path)] = (len(branches[branch][0]), branches[branch][1])
            heapq.heappush(best, (len(path), path))
        if not best:
            break
        _, path = heapq.heappop(best)
        taken.append(path)
        fixed, excluded = open_to.pop(tuple(path))
        # Every other path of the branch leaves this one after its i-th node.
        branches = [(path[:i], [path[i], *(excluded if i == fixed else [])]) for i in range(fixed, len(path))]
    shown = spark.createDataFrame([(i, p) for i, p in enumerate(taken)], "place int, path array<string>")
    steps = shown.select("place", "path", F.posexplode(F.arrays_zip(F.expr("slice(path, 1, size(path) - 1)").alias("s"), F.expr("slice(path, 2, size(path))").alias("t"))).alias("pos", "e"))
    single = links.groupBy("source", "target").agg(F.min(F.struct("relation", "weight")).alias("with"))
    with_edges = (
        single.join(F.broadcast(steps.select("place", "path", "pos", F.col("e.s").alias("source"), F.col("e.t").alias("target"))), ["source", "target"])
        .groupBy("place", "path")
        .agg(F.array_sort(F.collect_list(F.struct("pos", F.struct("source", "target", "with.relation", "with.weight").alias("edge")))).alias("all"))
    )
    return (
        with_edges.select("path", (F.size("path") - 1).alias("length"), F.transform("all", lambda s: s["edge"]).alias("edges"))
        .orderBy("length", "path")
    )


def _best_of(useful: DataFrame, branches: list[tuple[list[str], list[str]]], target: str, max_edges: int) -> dict[int, list[str]]:
    """The best path of each branch that has one, by number of the branch.

    All branches are searched together, hop by hop; each node of each branch keeps
    the least path to it, and a branch ends when its path has arrived.
    """
    spark = useful.sparkSession
    found: dict[int, list[str]] = {}
    if not branches:
        return found
    rows = [(i, head[-1], head, head, excluded) for i, (head, excluded) in enumerate(branches)]
    frontier = spark.createDataFrame(rows, "branch int, node string, path array<string>, head array<string>, excluded array<string>")
    heads = F.broadcast(frontier.select("branch", "head"))
    seen = None
    for _ in range(max_edges):
        grown = (
            useful.join(frontier, useful["source"] == frontier["node"])
            .where(F.size("path") + F.col("need") <= max_edges)
            .where(~F.array_contains("head", F.col("target")) & ~F.array_contains("excluded", F.col("target")))
            .groupBy("branch", F.col("target").alias("node"))
            .agg(F.min(F.concat("path", F.array("target"))).alias("path"))
        )
        if seen is not None:
            grown = grown.join(seen, ["branch", "node"], "left_anti")
        grown = cut_lineage(grown, "labels")
        found |= {r["branch"]: list(r["path"]) for r in grown.where(F.col("node") == target).select("branch", "path").collect()}
        ends = list(found)
        rest = grown.where(~F.col("branch").isin(ends)) if ends else grown
        if len(found) == len(branches) or rest.isEmpty():
            break
        seen = grown.select("branch", "node") if seen is None else seen.unionByName(grown.select("branch", "node"))
        frontier = rest.join(heads, "branch").withColumn("excluded", F.array().cast("array<string>"))
    return found
