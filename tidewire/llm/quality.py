"""Quality rules: counts of a text, and a decision list learned from labelled statistics."""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.llm.tables import words_of
from tidewire.session import cut_lineage, pin

WINDOW = 8
MIN_WORDS = 20
LABEL_BOUND = 50_000  # about so many labelled rows are learned from; every row is judged
BINS = 16
_SPACE_FREE = "[^\\x20\\x09-\\x0D]"

FEATURES = {
    "n_words": "cast(n_words AS double)",
    "mean_word": "word_chars / greatest(n_words, 1)",
    "symbol_share": "n_symbols / greatest(word_chars, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "distinct_share": "n_distinct / greatest(n_words, 1)",
    "words_per_line": "n_words / greatest(n_lines, 1)",
}


def _repeat_words(windows: Column, n_words: Column) -> Column:
    """Words that lie in a window (by hash) found twice or more.

    Only a text with a repeat sorts its windows; equal neighbours then give the
    starts, and the next start bounds the words a start adds.
    """
    size = F.size(windows)
    placed = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def starts(pairs: Column) -> Column:
        n = F.size(pairs)
        same = lambda i, j: F.get(pairs, i)["h"] == F.get(pairs, j)["h"]
        hit = F.transform(
            pairs,
            lambda p, i: F.when(
                F.coalesce(same(i, i + 1), F.lit(False)) | ((i > 0) & F.coalesce(same(i, i - 1), F.lit(False))), p["i"]
            ),
        )
        return F.when(n > 0, F.array_sort(F.filter(hit, lambda i: i.isNotNull())))

    # An aggregate over one element binds the sorted array once.
    bound = lambda value, use: F.get(F.transform(F.array(value), use), 0)
    covered = bound(
        placed,
        lambda pairs: bound(
            starts(pairs),
            lambda at: F.aggregate(
                F.transform(
                    at, lambda s, i: F.least(F.lit(WINDOW), F.coalesce(F.get(at, i + 1) - s, F.lit(WINDOW)))
                ),
                F.lit(0), lambda a, x: a + x,
            ),
        ),
    )
    return F.when(size == F.size(F.array_distinct(windows)), F.lit(0)).otherwise(F.coalesce(covered, F.lit(0)))


def text_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", whole_row: bool = False) -> DataFrame:
    """Per row: doc_id (with ``whole_row``: the row as ``_row``), n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, n_distinct, base_failed.

    A null or empty text has no words and fails the base rules. Windows are
    compared by a 64-bit hash within one text.
    """
    lines = F.filter(F.split("_text", "\n", -1), lambda x: x.rlike(_SPACE_FREE))
    key = F.struct("*").alias("_row") if whole_row else F.col(id_col).alias("doc_id")
    df = docs.select(key, F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    df = pin(df, "_words", words_of(F.col("_text")))
    df = pin(df, "_lines", lines)
    n = F.size("_words")
    windows = F.when(
        n >= WINDOW,
        F.transform(
            F.sequence(F.lit(1), n - (WINDOW - 1)), lambda i: F.xxhash64(F.slice("_words", i, F.lit(WINDOW)))
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    df = pin(df, "_windows", windows)
    df = df.select(
        df.columns[0],
        n.cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.regexp_count("_text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("_windows"), n).cast("long").alias("n_repeat_words"),
        F.size(F.array_distinct("_words")).cast("long").alias("n_distinct"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return df.withColumn("base_failed", failed)


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def expression(self) -> Column:
        value = F.col(f"f_{self.feature}")
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]
    bad: int  # rows of the pruning part that it covers
    good: int

    def expression(self) -> Column:
        out = F.lit(True)
        for c in self.conditions:
            out = out & c.expression()
        return out

    def __str__(self) -> str:
        return f"reject if {' and '.join(map(str, self.conditions))}  [{self.bad} bad, {self.good} good]"


@dataclass(frozen=True)
class DecisionList:
    """Ordered rules; the first that fits rejects, and a row that none fits is kept."""

    rules: tuple[Rule, ...]

    def verdict(self) -> Column:
        """One conditional expression over the ``f_`` columns: true keeps the row."""
        out = F.lit(True)
        for rule in reversed(self.rules):
            out = F.when(rule.expression(), F.lit(False)).otherwise(out)
        return out

    def fired(self) -> Column:
        """The number of the rule that rejects the row, from 1; null if none does."""
        return F.coalesce(*[F.when(r.expression(), F.lit(i)) for i, r in enumerate(self.rules, 1)], F.lit(None).cast("int"))


def with_features(counts: DataFrame, features: Iterable[str] = FEATURES) -> DataFrame:
    return counts.select("*", *[F.expr(FEATURES[f]).alias(f"f_{f}") for f in features])


def _thresholds(rows: DataFrame, features: list[str]) -> dict[str, list[float]]:
    """Exact quantiles of the bad and of the good rows: the places where a rule may cut."""
    shares = [i / BINS for i in range(1, BINS)]
    found = rows.groupBy("bad").agg(*[F.percentile(f"f_{f}", shares).alias(f) for f in features]).collect()
    return {f: sorted({x for r in found for x in (r[f] or []) if x is not None}) for f in features}


def _gain(p: int, n: int, p0: int, n0: int) -> float:
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p else 0.0


def _grow(rows: DataFrame, cuts: dict[str, list[float]], max_conditions: int) -> list[Condition]:
    """Adds the condition of greatest information gain until no good row is covered.

    One aggregate per condition: rows fall into the bins between the cuts, and
    sums over the bins on either side of a cut give all its conditions at once.
    """
    chosen: list[Condition] = []
    names = list(cuts)
    binned = F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f"b_{f}").alias("b")) for f in names]))
    while len(chosen) < max_conditions:
        here = rows
        for c in chosen:
            here = here.where(c.expression())
        counts = here.select("bad", binned.alias("x")).groupBy("x.f", "x.b").agg(
            F.sum("bad").alias("p"), F.count("*").alias("t")
        ).collect()
        by = {(r["f"], r["b"]): (r["p"], r["t"] - r["p"]) for r in counts}
        some = names[0]
        p0, n0 = (sum(by.get((some, b), (0, 0))[i] for b in range(len(cuts[some]) + 1)) for i in (0, 1))
        if not p0 or not n0:
            break
        best = (0.0, None)
        for f in names:
            below = [0, 0]
            for b, cut in enumerate(cuts[f]):
                p, n = by.get((f, b), (0, 0))
                below = [below[0] + p, below[1] + n]
                for above, (x, y) in ((False, below), (True, (p0 - below[0], n0 - below[1]))):
                    gain = _gain(x, y, p0, n0)
                    if gain > best[0] + 1e-9:
                        best = (gain, Condition(f, above, cut))
        if best[1] is None:
            break
        chosen.append(best[1])
    return chosen


def _prune(rows: DataFrame, conditions: list[Condition]) -> Rule:
    """Keeps the leading conditions that are worth most on rows the rule was not grown on."""
    held = F.lit(len(conditions))
    for i in reversed(range(len(conditions))):
        held = F.when(~conditions[i].expression(), F.lit(i)).otherwise(held)
    counts = rows.groupBy(held.alias("held")).agg(F.sum("bad").alias("p"), F.count("*").alias("t")).collect()
    by = {r["held"]: (r["p"], r["t"] - r["p"]) for r in counts}
    best = None
    for k in range(1, len(conditions) + 1):
        p, n = (sum(by.get(h, (0, 0))[i] for h in range(k, len(conditions) + 1)) for i in (0, 1))
        worth = (p - n) / (p + n) if p + n else -1.0
        if best is None or worth > best[0]:
            best = (worth, k, p, n)
    _, k, p, n = best
    return Rule(tuple(conditions[:k]), p, n)


def learn(
    counts: DataFrame,
    labels: DataFrame,
    label_bound: int = LABEL_BOUND,
    max_rules: int = 8,
    max_conditions: int = 4,
    min_precision: float = 0.95,
    min_cover: int = 3,
    features: Iterable[str] = tuple(FEATURES),
) -> DecisionList:
    """Sequential covering of the bad rows (``labels``: doc_id, quality 0/1) that pass the base rules.

    A rule is grown on two thirds of the labelled rows and pruned on the rest; it
    is taken while it is right for ``min_precision`` of at least ``min_cover``
    rows there, and the rows it covers are then set aside. About
    ``label_bound`` labelled rows, chosen by the hash of their id, are used.
    Without usable labels, or with one class only, the list has no rules.
    """
    features = list(features)
    known, _ = labelled_part(labels, label_bound)
    rows = with_features(counts.where("NOT base_failed"), features).join(known, "doc_id").select(
        F.when(F.col("quality") == 0, 1).otherwise(0).alias("bad"),
        F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(3)).alias("part"),
        *[f"f_{f}" for f in features],
    )
    rows = cut_lineage(rows, "labelled")
    cuts = _thresholds(rows, features)
    cuts = {f: v for f, v in cuts.items() if v}
    if not cuts:
        return DecisionList(())

    def bin_of(f: str) -> Column:
        """How many cuts lie below the value."""
        value = F.col(f"f_{f}")
        return F.size(F.filter(F.array(*map(F.lit, cuts[f])), lambda x: x < value)).alias(f"b_{f}")

    bins = [bin_of(f) for f in cuts]
    rows = cut_lineage(rows.select("*", *bins), "binned")
    rules: list[Rule] = []
    left = rows
    while len(rules) < max_rules:
        conditions = _grow(left.where("part <> 0"), cuts, max_conditions)
        if not conditions:
            break
        rule = _prune(left.where("part = 0"), conditions)
        if rule.bad < min_cover or rule.bad < min_precision * (rule.bad + rule.good):
            break
        rules.append(rule)
        left = left.where(~rule.expression())
    return DecisionList(tuple(rules))


def labelled_part(labels: DataFrame, bound: int = LABEL_BOUND) -> tuple[DataFrame, Column]:
    """(doc_id, quality) of about ``bound`` labelled ids, and the condition on an id that picks them."""
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    n = known.count()
    scale = 1 << 30
    take = scale if n <= bound else bound * scale // n
    picked = F.pmod(F.xxhash64("doc_id", F.lit("learn")), F.lit(scale)) < take
    return known.where(picked), picked


def judge(docs: DataFrame, labels: DataFrame, **options) -> tuple[DataFrame, DecisionList]:
    """``text_counts`` with ``rule`` and ``kept`` for every row, and the list learned for it.

    A row that fails the base rules is not kept; of the others the list decides.
    Repeated rows are each judged; clashing columns of ``docs`` are not read.
    """
    counts = cut_lineage(text_counts(docs), "counts")
    model = learn(counts, labels, **options)
    judged = with_features(counts)
    return judged.select(
        *counts.columns,
        F.when(~F.col("base_failed"), model.fired()).cast("int").alias("rule"),
        (~F.col("base_failed") & model.verdict()).alias("kept"),
    ), model


def keep_good(docs: DataFrame, labels: DataFrame, label_bound: int = LABEL_BOUND, **options) -> tuple[DataFrame, DecisionList]:
    """The rows of ``docs`` that the base rules and a learned list keep, with all their columns.

    The counts of the labelled part are taken first; the others are taken in the
    pass that filters, so texts are neither shuffled nor stored with their counts.
    """
    _, picked = labelled_part(labels, label_bound)
    counts = cut_lineage(text_counts(docs.where(picked)), "counts")
    model = learn(counts, labels, label_bound, **options)
    judged = with_features(text_counts(docs, whole_row=True))
    return judged.where(~F.col("base_failed") & model.verdict()).select("_row.*"), model
