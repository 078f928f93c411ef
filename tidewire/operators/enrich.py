"""Places, linked entities and time fields."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.functions import lexicons as lx
from tidewire.functions import temporal
from tidewire.functions import text as t
from tidewire.session import chain


def enrich_geo(df: DataFrame, confidence: float = 0.5) -> DataFrame:
    """Runs of capitalised words, distinct in order of appearance, as place candidates."""
    names = F.array_distinct(t.find_all(t.title_and_content(), t.PROPER_NAME))
    longer = F.filter(names, lambda n: F.length(n) > 2)
    return df.withColumn("_places", longer).withColumns(
        {
            "locations": F.transform(
                "_places",
                lambda n: F.struct(n.alias("name"), F.lit(confidence).alias("confidence")),
            ),
            "has_geo": F.size("_places") > 0,
        }
    ).drop("_places")


def _organisations(acronyms: list[str], suffixes: list[str]):
    listed, suffixed = t.organisation_patterns(acronyms, suffixes)
    body = t.title_and_content()
    return F.sort_array(F.array_union(t.find_all(body, listed), t.find_all(body, suffixed)))


def link_entities(
    df: DataFrame,
    countries: list[str] = lx.LINKER_COUNTRIES,
    acronyms: list[str] = lx.LINKER_ACRONYMS,
    suffixes: list[str] = lx.LINKER_SUFFIXES,
    match: str = "substring",
) -> DataFrame:
    """Countries and organisations of an article; people and events stay empty."""
    lowered = F.lower(t.title_and_content())
    none = F.array().cast("array<string>")
    return df.withColumn(
        "entities",
        F.struct(
            _organisations(acronyms, suffixes).alias("organizations"),
            none.alias("people"),
            t.mentioned(lowered, countries, match).alias("countries"),
            none.alias("events"),
        ),
    ).withColumn(
        "entity_count", F.size("entities.organizations") + F.size("entities.countries")
    )


def extract_entities(
    df: DataFrame,
    countries: list[str] = lx.NER_COUNTRIES,
    acronyms: list[str] = lx.NER_ACRONYMS,
    suffixes: list[str] = lx.NER_SUFFIXES,
    match: str = "substring",
) -> DataFrame:
    """``entities`` struct from the long lists: sorted, distinct, with a total."""
    lowered = F.lower(t.title_and_content())
    return (
        df.withColumns(
            {
                "_countries": F.sort_array(t.mentioned(lowered, countries, match)),
                "_orgs": _organisations(acronyms, suffixes),
            }
        )
        .withColumn(
            "entities",
            F.struct(
                F.col("_countries").alias("countries"),
                F.col("_orgs").alias("organizations"),
                (F.size("_countries") + F.size("_orgs")).alias("total"),
            ),
        )
        .drop("_countries", "_orgs")
    )


def enrich_temporal(df: DataFrame, run_ts: str) -> DataFrame:
    """Publication time fields in the source's own offset.

    ``run_ts`` (ISO text, UTC) stands in for the clock: it dates the ingestion
    and replaces a publication time that cannot be read.
    """
    local = F.col("pub_local")
    given = t.col_or_blank("published") != ""
    return (
        temporal.read_published(df)
        .withColumns(
            {
                "published_parsed": F.when(
                    given,
                    F.coalesce(
                        temporal.iso_text(local, F.col("pub_fraction"), F.col("pub_offset")),
                        F.lit(f"{run_ts}+00:00"),
                    ),
                ),
                "published_date": F.date_format(local, "yyyy-MM-dd"),
                "published_hour": F.hour(local),
                "day_of_week": F.date_format(local, "EEEE"),
                "ingested_at": F.lit(run_ts),
            }
        )
        .drop("pub_local", "pub_offset", "pub_fraction")
    )


def enrich(df: DataFrame, run_ts: str) -> DataFrame:
    """Places, then entities, then time fields."""
    return chain(enrich_geo, link_entities, lambda d: enrich_temporal(d, run_ts))(df)
