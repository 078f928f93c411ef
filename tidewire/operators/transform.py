"""Column mapping, event building, batch caps and unions."""

from __future__ import annotations

import functools
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.functions import temporal
from tidewire.functions import text as t
from tidewire.operators.enrich import enrich_temporal


def map_schema(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Copy ``source`` columns to ``target`` names; sources stay, unknown ones are skipped.

    All targets are read from the input row: no target sees another's result.
    """
    return df.withColumns({t_: F.col(s) for t_, s in mapping.items() if s in df.columns})


def _optional(df: DataFrame, name: str):
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def build_event(df: DataFrame, template: Mapping[str, object] | None = None) -> DataFrame:
    """Canonical event columns, laid over the template's defaults."""
    source = _optional(df, "source")
    built = {name: F.lit(value) for name, value in (template or {}).items()}
    built.update(
        original_type=_optional(df, "event_type"),
        source=source,
        timestamp=F.date_format("event_ts", "yyyy-MM-dd'T'HH:mm:ss"),
        content=t.first_filled(_optional(df, "content"), _optional(df, "description")),
        title=t.first_filled(_optional(df, "title")),
        url=t.first_filled(_optional(df, "url")),
        source_name=t.first_filled(_optional(df, "source_name"), source),
        language=F.coalesce(_optional(df, "language"), F.lit("en")),
    )
    return df.withColumns(built)


def transform_rss(df: DataFrame, run_ts: str) -> DataFrame:
    """Feed items to events: the url is the item's link, then the time fields."""
    return enrich_temporal(build_event(map_schema(df, {"url": "link"})), run_ts)


def cap_batch(df: DataFrame, n: int) -> DataFrame:
    """The ``n`` records published last, whatever spelling and offset their times have.

    A distributed top-k, no global sort; times that can't be read come last, ties by id.
    """
    timed = temporal.instant(df, name="_instant")
    return timed.orderBy(F.col("_instant").desc_nulls_last(), F.col("event_id")).limit(n).drop("_instant")


def union_sources(sources: Iterable[DataFrame]) -> DataFrame:
    return functools.reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True), sources
    )
