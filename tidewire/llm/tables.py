"""Reading input tables, and the small helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = "[^\\x20\\x09-\\x0D]+"  # a run of anything but ASCII white space


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def words_of(text: Column) -> Column:
    """The words of a text as an array; a null text has none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def literal_lookup(values: list[int], index: Column) -> Column:
    """``values[index]`` for a bounded driver-side list.

    The list is one constant string that the optimizer folds into an array, so
    the look-up is map-side and needs neither a join nor a broadcast.
    """
    text = F.lit(",".join(map(str, values)))
    return F.get(F.split(text, ",").cast("array<bigint>"), index.cast("int"))


HOT_TEXT = 1000  # a text held by over one row in so many is joined by broadcast; there are fewer than that of them


def joined_by_text(keyed: DataFrame, measured: DataFrame, digest: str = "digest", copies: str = "copies") -> DataFrame:
    """Rows with a digest joined to the row of their text; ``measured`` is a written table with the number of each text's rows.

    The few texts that hold many rows are broadcast, so no task gets all rows of
    one; the others meet by a shuffle of the digests.
    """
    rows = measured.agg(F.sum(copies)).first()[0] or 0
    hot, cold = measured.where(F.col(copies) * HOT_TEXT > rows), measured.where(F.col(copies) * HOT_TEXT <= rows)
    few = F.broadcast(hot)
    return keyed.join(few, digest).unionByName(keyed.join(few.select(digest), digest, "left_anti").join(cold, digest))
