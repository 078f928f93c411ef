"""Reading publication times without losing the source's own offset."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Month abbreviations, three letters each.
MONTHS = "JanFebMarAprMayJunJulAugSepOctNovDec"

_ISO = (
    r"^\d{4}-\d{2}-\d{2}"
    r"(?:[T ]\d{2}:\d{2}(?::\d{2}(?:\.\d{1,6})?)?(?:[+-](?:[01]\d|2[0-3]):?[0-5]\d)?)?$"
)
_MAIL = (
    r"^(?:[A-Za-z]{3}, *)?(\d{1,2}) (Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)"
    r" (\d{4}) (\d{2}:\d{2}:\d{2}) ([+-]\d{4}|GMT|UTC|UT)$"
)


def _part(c: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract(c, pattern, group)


def iso_form(published: Column) -> Column:
    """ISO text of a publication time; mail-style dates are rewritten, 'Z' spelled out."""
    month = (F.instr(F.lit(MONTHS), _part(published, _MAIL, 2)) + 2) / 3
    zone = _part(published, _MAIL, 5)
    rewritten = F.concat(
        _part(published, _MAIL, 3),
        F.lit("-"),
        F.lpad(month.cast("int").cast("string"), 2, "0"),
        F.lit("-"),
        F.lpad(_part(published, _MAIL, 1), 2, "0"),
        F.lit("T"),
        _part(published, _MAIL, 4),
        F.when(zone.startswith("+") | zone.startswith("-"), zone).otherwise("+0000"),
    )
    return F.when(F.rlike(published, F.lit(_MAIL)), rewritten).otherwise(
        F.replace(published, F.lit("Z"), F.lit("+00:00"))
    )


def read_published(df: DataFrame, published: str = "published") -> DataFrame:
    """Add ``pub_local`` (wall clock of the source), ``pub_offset`` ('+hh:mm' or '')
    and ``pub_fraction``; all null when the text is not a valid time."""
    iso = F.col("_iso")
    offset = _part(iso, r"([+-]\d{2}:?\d{2})$")
    wall = _part(iso, r"^(\d{4}-\d{2}-\d{2}(?:[T ]\d{2}:\d{2}(?::\d{2})?)?)")
    valid = F.rlike(iso, F.lit(_ISO))
    has_clock = F.length(iso) > 10
    return (
        df.withColumn("_iso", iso_form(F.col(published)))
        .withColumns(
            {
                "pub_local": F.when(valid, wall.try_cast("timestamp_ntz")),
                "pub_offset": F.when(
                    valid & has_clock, F.regexp_replace(offset, r"^([+-]\d{2}):?(\d{2})$", "$1:$2")
                ),
                "pub_fraction": F.when(valid, _part(iso, r"\.(\d+)")),
            }
        )
        .drop("_iso")
    )


def instant(df: DataFrame, published: str = "published", name: str = "pub_instant") -> DataFrame:
    """Add the moment of publication as struct(UTC wall clock, microseconds text); null if unreadable.

    A time without an offset counts as UTC.
    """
    offset = F.coalesce(F.nullif(F.col("pub_offset"), F.lit("")), F.lit("+00:00"))
    sign = F.when(offset.startswith("-"), -1).otherwise(1)
    minutes = sign * (F.substring(offset, 2, 2).cast("int") * 60 + F.substring(offset, 5, 2).cast("int"))
    utc = F.col("pub_local") - F.make_dt_interval(mins=minutes)
    found = F.struct(utc.alias("utc"), F.rpad(F.coalesce("pub_fraction", F.lit("")), 6, "0").alias("micros"))
    return (
        read_published(df, published)
        .withColumn(name, F.when(F.col("pub_local").isNotNull(), found))
        .drop("pub_local", "pub_offset", "pub_fraction")
    )


def iso_text(local: Column, fraction: Column, offset: Column) -> Column:
    padded = F.rpad(fraction, 6, "0")
    return F.concat(
        F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss"),
        F.when((fraction != "") & (padded != "000000"), F.concat(F.lit("."), padded)).otherwise(""),
        F.coalesce(offset, F.lit("")),
    )


def weekday_number(local: Column) -> Column:
    """Monday = 0."""
    return F.weekday(local)
