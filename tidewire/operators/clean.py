"""Deduplication, normalisation and validation of articles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tidewire.functions import text as t
from tidewire.operators.seen import SeenStore
from tidewire.session import chain

ARRIVAL_ORDER = ("event_ts", "event_id")


def dedup_key(title: str = "title", url: str = "url") -> Column:
    return F.md5(F.concat(t.col_or_blank(title), t.col_or_blank(url)))


def keep_first(df: DataFrame, key: str, order: tuple[str, ...] = ARRIVAL_ORDER) -> DataFrame:
    """One row per key, the first by ``order``.

    ``min_by`` is combined map-side, so a key that holds a large share of all
    rows reaches its reducer as one row per map task; a ranking window would
    send every copy there.
    """
    row = F.struct(*[F.col(c) for c in df.columns if c != key])
    return (
        df.groupBy(key)
        .agg(F.min_by(row, F.struct(*order)).alias("_row"))
        .select(*[F.col(key) if c == key else F.col(f"_row.{c}").alias(c) for c in df.columns])
    )


def _named(df: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """Rows with their ``dedup_key`` and a ``_row`` that only rows of one key and equal order share."""
    keyed = df.withColumn("dedup_key", dedup_key())
    return keyed.withColumn("_row", F.md5(F.to_json(F.struct("dedup_key", *order), {"ignoreNullFields": "false"})))


def _winners(named: DataFrame, order: tuple[str, ...], counts: Observation | None = None) -> DataFrame:
    """(dedup_key, _row) of the first row of each key; a narrow aggregate, combined map-side."""
    first = named.groupBy("dedup_key").agg(F.min(F.struct(*order, "_row")).alias("_first"), F.count("*").alias("_copies"))
    if counts is not None:
        skipped = F.coalesce(F.sum("_copies") - F.count("*"), F.lit(0))
        first = first.observe(counts, F.count("*").alias("kept"), skipped.alias("skipped"))
    return first.select("dedup_key", "_first._row")


def _picked(named: DataFrame, winners: DataFrame) -> DataFrame:
    """The rows that ``winners`` name, one of each.

    Rows move once, dealt by their name, which spreads a hot key; where one was
    delivered twice its copies lie together then and are numbered in place.
    """
    found = named.join(winners.select("_row"), "_row", "left_semi")
    ranked = found.withColumn("_n", F.row_number().over(Window.partitionBy("_row").orderBy("_row")))
    return ranked.where("_n = 1").drop("_n", "_row")


def dedup(df: DataFrame, order: tuple[str, ...] = ARRIVAL_ORDER, counts: Observation | None = None) -> DataFrame:
    """Keep the first article per md5(title ++ url); the key stays as ``dedup_key``.

    Of rows that ``order`` does not tell apart, such as one article delivered
    twice, one is kept. The first copies are found on key and order alone, and only
    the columns that are read later move, in one shuffle at most. ``counts`` gets
    ``kept`` and ``skipped`` from the pass that writes the result.
    """
    named = _named(df, order)
    return _picked(named, _winners(named, order, counts))


def dedup_counts(df: DataFrame, *group: str) -> DataFrame:
    """Kept and skipped articles, optionally per group.

    Counts rows per key first (combined map-side), then sums the small result.
    """
    per_key = df.groupBy(*group, dedup_key().alias("dedup_key")).agg(F.count("*").alias("n"))
    return per_key.groupBy(*group).agg(
        F.count("*").alias("kept"), (F.sum("n") - F.count("*")).alias("skipped")
    )


def dedup_against_history(df: DataFrame, seen_keys: DataFrame) -> DataFrame:
    """Deduplicate a batch and drop what earlier runs have seen.

    The batch's first copies meet the history as names, before any text moves; a
    hot key is one of them, and the history needs no distinct, as an anti join only
    asks whether a key is there.
    """
    named = _named(df, ARRIVAL_ORDER)
    fresh = _winners(named, ARRIVAL_ORDER).join(seen_keys.select("dedup_key"), "dedup_key", "left_anti")
    return _picked(named, fresh)


def dedup_against_store(df: DataFrame, store: SeenStore) -> DataFrame:
    """The same against a stored history, whose sketch spares reading most of it."""
    named = _named(df, ARRIVAL_ORDER)
    return _picked(named, store.unseen(_winners(named, ARRIVAL_ORDER)))


def append_seen(new_rows: DataFrame, path: str) -> None:
    """Add the keys of freshly kept rows to the stored key table."""
    new_rows.select("dedup_key").write.mode("append").parquet(path)


def normalize(df: DataFrame) -> DataFrame:
    """Fill content from description, squeeze white space, strip the title."""
    body = t.first_filled(F.col("content"), F.col("description"))
    return df.withColumns(
        {"content": t.squeeze(body), "title": t.strip(t.col_or_blank("title"))}
    ).withColumn("text_length", F.length("content"))


def validate(df: DataFrame, min_content: int = 20, min_title: int = 3) -> DataFrame:
    """Drop articles without text, or with both a short content and a short title."""
    title_len = F.length(t.col_or_blank("title"))
    body_len = F.length(t.first_filled(F.col("content"), F.col("description")))
    empty = (title_len == 0) & (body_len == 0)
    short = (body_len < min_content) & (title_len < min_title)
    return df.filter(~empty & ~short)


def clean(df: DataFrame) -> DataFrame:
    """Dedup, then normalise, then validate. Dedup sees untrimmed titles."""
    return chain(dedup, normalize, validate)(df)
