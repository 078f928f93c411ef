"""Text expressions shared by the operators (all JVM-side)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space, spelled out so that every regex engine reads it alike.
SPACE_CLASS = (
    r"[\t-\r\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)
# The same set for Java: its Unicode \s is one table look-up, several times
# faster than the ranges; only the four separators have to be added.
SPACE = r"(?U:[\s\x1C-\x1F])"
# The same set as plain characters, for trimming.
SPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def col_or_blank(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def first_filled(*cols: Column) -> Column:
    """First value that is neither null nor empty, else ''."""
    filled = [F.when(c != "", c) for c in cols]
    return F.coalesce(*filled, F.lit(""))


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(SPACE_CHARS))


def squeeze(c: Column) -> Column:
    """Collapse white space runs to one space and strip the ends.

    Once every run is a single space, plain ``trim`` does the stripping.
    """
    return F.trim(F.regexp_replace(c, f"{SPACE}+", " "))


def tokens(c: Column) -> Column:
    """Array of white-space tokens (no empty strings)."""
    return F.array_remove(F.split(c, f"{SPACE}+"), "")


def title_and_content(title: str = "title", content: str = "content") -> Column:
    return F.concat(col_or_blank(title), F.lit(" "), col_or_blank(content))


def _word_pattern(keyword: str) -> str:
    return rf"(?U)\b\Q{keyword}\E\b"


def mentions(lowered: Column, keyword: str, match: str = "substring") -> Column:
    """Does already lower-cased text hold ``keyword``?"""
    if match == "substring":
        return F.contains(lowered, F.lit(keyword.lower()))
    if match == "word":
        return F.rlike(lowered, F.lit(_word_pattern(keyword.lower())))
    raise ValueError(f"match must be 'substring' or 'word', not {match!r}")


def mentioned(lowered: Column, keywords: Iterable[str], match: str = "substring") -> Column:
    """Array of the keywords found, in list order.

    The list is unrolled into plain branches and the blanks are removed with
    ``array_remove``: all of that is compiled, and the lower-casing is shared.
    A lambda (``filter``, ``array_compact``) would interpret the whole tree below
    it and lower-case the text anew for every keyword.
    """
    return F.array_remove(
        F.array(*[F.when(mentions(lowered, k, match), k).otherwise("") for k in keywords]), ""
    )


def mentioned_at(lowered: Column, keywords: Iterable[str], match: str = "substring") -> Column:
    """Positions (from 1) of the keywords found."""
    found = [
        F.when(mentions(lowered, k, match), i).otherwise(0) for i, k in enumerate(keywords, start=1)
    ]
    return F.array_remove(F.array(*found), 0)


def mentions_any(lowered: Column, keywords: Iterable[str], match: str = "substring") -> Column:
    found = F.lit(False)
    for k in keywords:
        found = found | mentions(lowered, k, match)
    return found


def labels_mentioned(
    lowered: Column, lists: dict[str, list[str]], match: str = "substring"
) -> Column:
    """Labels (in dict order) for which any keyword is found."""
    return F.array_remove(
        F.array(
            *[F.when(mentions_any(lowered, ks, match), lab).otherwise("") for lab, ks in lists.items()]
        ),
        "",
    )


def count_true(conds: Iterable[Column]) -> Column:
    total = F.lit(0)
    for c in conds:
        total = total + F.when(c, 1).otherwise(0)
    return total


def organisation_patterns(acronyms: list[str], suffixes: list[str]) -> tuple[str, str]:
    """Regexes for listed acronyms and for 'Capitalised Words + company suffix'."""
    initials = "".join(sorted({a[0] for a in acronyms}))
    # The lookahead spares the costly Unicode boundary test at most positions.
    return (
        rf"(?U)(?=[{initials}])\b(?:{'|'.join(acronyms)})\b",
        rf"(?U)(?=[A-Z])\b[A-Z][a-z]+(?:\s[A-Z][a-z]+)*\s(?:{'|'.join(suffixes)})\b",
    )


PROPER_NAME = r"(?U)(?=[A-Z])\b[A-Z][a-z]+(?:\s[A-Z][a-z]+)*\b"


def find_all(c: Column, pattern: str) -> Column:
    return F.regexp_extract_all(c, F.lit(pattern), F.lit(0))


def node_key(prefix: str, c: Column) -> Column:
    return F.concat(F.lit(f"{prefix}:"), F.replace(F.lower(c), F.lit(" "), F.lit("_")))
