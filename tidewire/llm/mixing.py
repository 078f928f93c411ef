"""Mixing sources to target weights: budgets down a tree, then token prefixes of seeded epochs."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewire.llm.tables import words_of
from tidewire.session import cut_lineage

LEVELS = ("domain", "lang", "source")
FEW_LEAVES = 20_000  # leaves whose plan is broadcast
_WIDE = "decimal(38,0)"


def _weight(level: str, weights: Mapping[str, int]) -> Column:
    """The node's weight among its siblings; a name that is not listed weighs 1."""
    if not weights:
        return F.lit(1).cast("bigint")
    known = F.from_json(F.lit(json.dumps(dict(weights))), "map<string,bigint>")
    return F.coalesce(F.try_element_at(known, F.col(level)), F.lit(1).cast("bigint"))


def fill(children: DataFrame, parent: Sequence[str]) -> DataFrame:
    """Shares each parent's ``budget`` among its children (w, cap) in proportion to weight, up to capacity.

    A child that can't use its share takes its capacity, and the shortage goes to
    its siblings in proportion again; rounds of one narrow aggregate go on until
    no child newly reaches its capacity. Whole numbers throughout: a share is
    rounded down, so less than one token per child is left over.
    """
    state = cut_lineage(children.withColumn("full", F.lit(False)), "fill")
    while True:
        rest = state.groupBy(*parent).agg(
            F.coalesce(F.sum(F.when(~F.col("full"), F.col("w"))), F.lit(0)).cast(_WIDE).alias("weight_left"),
            (F.max("budget") - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))), F.lit(0))).cast(_WIDE).alias("budget_left"),
        )
        joined = state.join(rest, list(parent))
        fits = F.col("cap").cast(_WIDE) * F.col("weight_left") <= F.col("budget_left") * F.col("w").cast(_WIDE)
        state = cut_lineage(
            joined.select(
                *children.columns, (F.col("full") | fits).alias("full"), (~F.col("full") & fits).alias("new"),
                F.when(F.col("full") | fits, F.col("cap"))
                .otherwise(F.expr("CAST((budget_left * CAST(w AS DECIMAL(38,0))) DIV greatest(weight_left, CAST(1 AS DECIMAL(38,0))) AS BIGINT)"))
                .alias("alloc"),
            ), "fill",
        )
        if state.where("new").isEmpty():
            return state.drop("full", "new")
        state = state.drop("new", "alloc")


def budgets(leaves: DataFrame, total: int, weights: Mapping[str, Mapping[str, int]], max_epochs: int, levels: Sequence[str] = LEVELS) -> DataFrame:
    """(levels..., tokens, alloc) of every leaf; ``leaves`` has the levels and the supply ``tokens``.

    Budgets go from the root down. A node can use what its leaves can, so a
    shortage is made up by its siblings, and only what all of them can't use is
    made up further up. A weight of 0 takes nothing.
    """
    for level in levels:
        leaves = leaves.withColumn(f"w_{level}", _weight(level, weights.get(level, {})))
    usable = F.lit(True)
    for level in levels:
        usable = usable & (F.col(f"w_{level}") > 0)
    leaves = cut_lineage(leaves.withColumn("cap", F.when(usable, F.col("tokens") * max_epochs).otherwise(0).cast("bigint")), "leaves")
    leaves = leaves.withColumn("_root", F.lit(0))
    given = None
    for depth, level in enumerate(levels):
        parent = ["_root", *levels[:depth]]
        names = [*parent, level]
        nodes = leaves.groupBy(*names).agg(F.sum("cap").alias("cap"), F.max(f"w_{level}").alias("w"))
        nodes = nodes.withColumn("budget", F.lit(total).cast("bigint")) if given is None else nodes.join(given, parent)
        given = fill(nodes, parent).select(*names, F.col("alloc").alias("budget"))
    return leaves.select(*levels, "tokens").join(given.select(*levels, F.col("budget").alias("alloc")), list(levels))


def _boundary(rows: DataFrame, leaf: Sequence[str], bucket: str, left: str) -> DataFrame:
    """(leaf..., at, left): the bucket in which a leaf's running sum passes what is ``left``, and what is left there."""
    sums = rows.groupBy(*leaf, bucket).agg(F.sum("n_tokens").alias("n"), F.first(left).alias("goal"))
    running = F.sum("n").over(W.partitionBy(*leaf).orderBy(bucket))  # at most 4096 buckets of a leaf
    return (
        sums.withColumn("to", running).where("to > goal").groupBy(*leaf)
        .agg(F.min(F.struct(bucket, (F.col("goal") - F.col("to") + F.col("n")).alias("left"))).alias("x"))
        .select(*leaf, F.col(f"x.{bucket}").alias(f"at_{bucket}"), F.col("x.left").alias(f"left_{bucket}"))
    )


def select_epochs(items: DataFrame, plan: DataFrame, seed: int, levels: Sequence[str] = LEVELS) -> DataFrame:
    """``items`` (item, levels..., n_tokens) with ``copies``: how often the mix takes each.

    A leaf's allocation is so many whole epochs and the rest of one more. An epoch
    is the leaf's items in the order of a seeded hash; of the last one the longest
    prefix within the rest is taken. Items are found by two rounds of 4,096 hash
    ranges with their sums, then only the range where the prefix ends is sorted,
    one in 16 million of the leaf: no task reads a whole leaf in order.
    """
    leaf = list(levels)
    plan = plan.select(
        *leaf, F.expr("alloc DIV greatest(tokens, 1)").alias("whole"), F.expr("alloc % greatest(tokens, 1)").alias("rest")
    )
    # A row per leaf: a counted few are broadcast, so the items of a hot leaf stay spread; more are
    # joined on the leaf, where adaptive execution splits a hot one.
    small = F.broadcast if plan.limit(FEW_LEAVES + 1).count() <= FEW_LEAVES else (lambda df: df)
    rows = items.join(small(plan), leaf)
    rank = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("whole").cast("string"), F.col("item")).cast("binary"))
    rows = rows.withColumn("rank", rank)
    rows = cut_lineage(
        rows.withColumn("b1", F.conv(F.substring("rank", 1, 3), 16, 10).cast("int")).withColumn("b2", F.conv(F.substring("rank", 4, 3), 16, 10).cast("int")), "ranked"
    )
    rows = rows.join(small(_boundary(rows, leaf, "b1", "rest")), leaf, "left")
    edge = rows.where("b1 = at_b1")
    rows = cut_lineage(rows.join(small(_boundary(edge, leaf, "b2", "left_b1")), leaf, "left"), "edges")
    last = rows.where("b1 = at_b1 AND b2 = at_b2")
    taken = last.withColumn("to", F.sum("n_tokens").over(W.partitionBy(*leaf).orderBy("rank", "item").rowsBetween(W.unboundedPreceding, 0)))
    taken = taken.select(*items.columns, "whole", (F.col("to") <= F.col("left_b2")).alias("in"))
    before = rows.where("NOT coalesce(b1 = at_b1 AND b2 = at_b2, false)").select(
        *items.columns, "whole", F.expr("coalesce(b1 < at_b1 OR (b1 = at_b1 AND b2 < at_b2), false)").alias("in")
    )
    return taken.unionByName(before).select(*items.columns, (F.col("whole") + F.col("in").cast("bigint")).alias("copies"))


def item_name(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """What is drawn together: the rows of an id, or of a text where the id is null."""
    return F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("t"), F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))))


def mix_documents(
    docs: DataFrame,
    weights: Mapping[str, Mapping[str, int]],
    budget_percent: int = 100,
    max_epochs: int = 4,
    seed: int = 1,
    domain: Column | None = None,
) -> DataFrame:
    """(item, domain, lang, source, n_tokens, copies) of every item of ``docs`` (doc_id, text, lang, source).

    The budget is ``budget_percent`` of the words of all texts. ``weights`` gives
    whole numbers by level and name. Null levels are the name ``none``; rows of
    one id and leaf are one item, taken together; items without words are taken
    like others, a leaf without any is left out. An empty table gives no rows.
    """
    leaf = [
        F.coalesce(domain if domain is not None else F.col("domain"), F.lit("none")).alias("domain"),
        F.coalesce("lang", F.lit("none")).alias("lang"), F.coalesce("source", F.lit("none")).alias("source"),
    ]
    items = docs.select(item_name().alias("item"), *leaf, F.size(words_of(F.col("text"))).cast("bigint").alias("n_tokens"))
    items = cut_lineage(items.groupBy("item", *LEVELS).agg(F.sum("n_tokens").alias("n_tokens")), "items")
    leaves = cut_lineage(items.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens")), "supply")
    supply = leaves.agg(F.sum("tokens")).first()[0] or 0
    plan = cut_lineage(budgets(leaves, supply * budget_percent // 100, weights, max_epochs), "budgets")
    return select_epochs(items, plan, seed)


def mixed_rows(docs: DataFrame, weights: Mapping[str, Mapping[str, int]], domain: Column | None = None, **options) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, with all their columns."""
    taken = mix_documents(docs, weights, domain=domain, **options).where("copies > 0")
    leaf = [
        F.coalesce(domain if domain is not None else F.col("domain"), F.lit("none")).alias("_domain"),
        F.coalesce("lang", F.lit("none")).alias("_lang"), F.coalesce("source", F.lit("none")).alias("_source"),
    ]
    rows = docs.select(F.struct("*").alias("_row"), item_name().alias("_item"), *leaf)
    chosen = taken.select(F.col("item").alias("_item"), *[F.col(c).alias(f"_{c}") for c in LEVELS], "copies")
    # The hash of an item spreads a hot source; a join on the leaf would not.
    joined = rows.join(chosen, ["_item", "_domain", "_lang", "_source"])
    return joined.select("_row", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies")))).select("_row.*")
