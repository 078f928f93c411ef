"""Runs catalogue queries next to their oracle SQL and compares the results."""

from __future__ import annotations

import math
import os
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{os.path.join(sf_dir, name)}.parquet')")
    return con


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return repr(v)  # tells -0.0 from 0.0
    if isinstance(v, Decimal):
        return ("decimal", str(v))
    if isinstance(v, (datetime, date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def kind(name: str) -> str:
    name = name.lower()
    if name.startswith("list") or name.endswith("[]"):
        return "list"
    return {"bigint": "int64", "long": "int64", "varchar": "string", "integer": "int32", "int": "int32"}.get(name, name)


def rows_of_spark(df: DataFrame) -> tuple[list[str], dict, Counter]:
    cols = sorted(df.columns)
    types = {f.name: kind(f.dataType.simpleString()) for f in df.schema.fields}
    return cols, types, Counter(tuple(plain(r[c]) for c in cols) for r in df.collect())


def rows_of_duck(con, sql: str) -> tuple[list[str], dict, Counter]:
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    types = {d[0]: kind(str(d[1])) for d in rel.description}
    at = [names.index(c) for c in sorted(names)]
    return sorted(names), types, Counter(tuple(plain(r[i]) for i in at) for r in rel.fetchall())


def differences(df: DataFrame, con, sql: str, show: int = 2) -> list[str]:
    """Empty when columns, types and the multiset of rows agree."""
    cols, types, mine = rows_of_spark(df)
    ocols, otypes, theirs = rows_of_duck(con, sql)
    out = []
    if cols != ocols:
        return [f"columns {cols} vs {ocols}"]
    for c in cols:
        if types[c] != otypes[c]:
            out.append(f"type of {c}: {types[c]} vs {otypes[c]}")
    if mine != theirs:
        out.append(f"rows {sum(mine.values())} vs {sum(theirs.values())}; columns {cols}")
        key = lambda t: tuple(str(x) for x in t)
        out += [f"  spark  {r}" for r in sorted((mine - theirs), key=key)[:show]]
        out += [f"  oracle {r}" for r in sorted((theirs - mine), key=key)[:show]]
    return out
