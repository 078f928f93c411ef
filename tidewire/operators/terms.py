"""Keyword search for lists too long to unroll: anchors find candidates, which are then checked in full."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.functions import text as t

LENGTHS = (1, 2, 3, 5)  # of anchors
SHIPPED_TERMS = 500_000  # so many terms at most are shipped to the tasks (some 50 MB); more are joined by a shuffle of narrow rows
PIECE = 1 << 18  # bytes of text looked at together
_SEEN_BITS = 20


def anchor_of(term: str, uses: Counter) -> str | None:
    """The piece of ``term`` to look it up by: of one of its words, as long as ``LENGTHS`` has, and shared with few other terms."""
    pieces = pieces_of(term)
    return min(pieces, key=lambda p: (-len(p), uses[p], p)) if pieces else None


def pieces_of(term: str) -> list[str]:
    out = []
    for word in term.lower().split():
        size = max(n for n in LENGTHS if n <= len(word))
        out += [word[i : i + size] for i in range(len(word) - size + 1)]
    return out


def listed(lists: Mapping[str, Iterable[str]]) -> tuple[list[tuple[str, int, str, str]], dict[str, str]]:
    """(label, pos, keyword, term) rows, and the anchor of each term."""
    rows = [(label, pos, k, k.lower()) for label, words in lists.items() for pos, k in enumerate(words, 1)]
    uses = Counter(p for *_, term in rows for p in set(pieces_of(term)))
    anchors = {term: anchor_of(term, uses) for *_, term in rows}
    blank = [k for _, _, k, term in rows if anchors[term] is None]
    if blank:
        raise ValueError(f"a keyword needs a character other than white space: {blank[0]!r}")
    return rows, anchors


@dataclass(frozen=True)
class Needles:
    """Terms as UTF-8 bytes, and by the length of their anchors' first bytes where to look them up."""

    data: np.ndarray  # the bytes of all terms, one after the other
    begin: np.ndarray
    size: np.ndarray
    at: np.ndarray  # bytes before a term's anchor
    by_length: list[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]  # length, keys, first of their terms, terms, hashes seen


def _hashed(keys: np.ndarray) -> np.ndarray:
    return (keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _SEEN_BITS)


def needles_of(anchors: Mapping[str, str]) -> Needles:
    raw, known = [term.encode() for term in anchors], [anchor.encode() for anchor in anchors.values()]
    size = np.array([len(r) for r in raw], np.int64)
    of_length: dict[int, list[tuple[int, int]]] = {}
    for i, anchor in enumerate(known):
        of_length.setdefault(min(8, len(anchor)), []).append((int.from_bytes(anchor[:8], "big"), i))
    by_length = []
    for length, pairs in sorted(of_length.items()):
        pairs.sort()
        keys, first = np.unique(np.array([k for k, _ in pairs], np.uint64), return_index=True)
        seen = np.zeros(1 << _SEEN_BITS, bool)
        seen[_hashed(keys)] = True
        by_length.append((length, keys, np.append(first, len(pairs)), np.array([i for _, i in pairs], np.int64), seen))
    at = np.array([r.find(a) for r, a in zip(raw, known)], np.int64)
    return Needles(np.frombuffer(b"".join(raw), np.uint8), np.cumsum(size) - size, size, at, by_length)


def _windows(data: np.ndarray, n: int) -> np.ndarray:
    """The eight bytes at each of the first ``n`` positions as one number; zeros follow the end."""
    out = np.zeros(n + 7, np.uint64)
    out[: len(data)] = data
    for width in (1, 2, 4):
        out = (out[:-width] << np.uint64(8 * width)) | out[width:]
    return out


def held_terms(data: np.ndarray, bounds: np.ndarray, needles: Needles) -> tuple[np.ndarray, np.ndarray]:
    """(text, term) of every term that a text holds, sorted; text i is ``data[bounds[i]:bounds[i + 1]]``."""
    n_terms, found = len(needles.size), [np.empty(0, np.int64)]
    for start in range(int(bounds[0]), int(bounds[-1]), PIECE):
        n = min(PIECE, int(bounds[-1]) - start)
        windows = _windows(data[start : start + n + 7], n)
        for length, keys, first, terms, seen in needles.by_length:
            value = windows >> np.uint64(64 - 8 * length)
            place = np.flatnonzero(seen[_hashed(value)])
            value = value[place]
            key = np.minimum(np.searchsorted(keys, value), len(keys) - 1)
            place, key = place[keys[key] == value] + start, key[keys[key] == value]
            many = first[key + 1] - first[key]  # terms share an anchor
            nth = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            term, place = terms[np.repeat(first[key], many) + nth], np.repeat(place, many)
            text, begin = np.searchsorted(bounds, place, "right") - 1, place - needles.at[term]
            inside = (begin >= bounds[text]) & (begin + needles.size[term] <= bounds[text + 1])
            text, term, begin = text[inside], term[inside], begin[inside]
            done, i = [], 0
            while len(term):  # byte by byte, with those that agree so far
                same = data[begin + i] == needles.data[needles.begin[term] + i]
                text, term, begin = text[same], term[same], begin[same]
                i += 1
                ended = needles.size[term] == i
                if ended.any():
                    done.append(text[ended] * n_terms + term[ended])
                    text, term, begin = text[~ended], term[~ended], begin[~ended]
            if done:
                found.append(np.unique(np.concatenate(done)))
    return np.divmod(np.unique(np.concatenate(found)), max(n_terms, 1))


def _terms_in(anchors: Mapping[str, str]):
    """Arrow function: texts -> numbers of the terms they hold, in the order of ``anchors``."""
    needles = needles_of(anchors)

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def held(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            texts = texts.cast(pa.large_binary())
            _, bounds, data = texts.buffers()
            bounds = np.frombuffer(bounds, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
            data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
            text, term = held_terms(data, bounds, needles)
            ends = np.searchsorted(text, np.arange(len(texts) + 1))
            yield pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(term.astype(np.int32)))

    return held


def _grams(low: Column, lengths: list[int]) -> Column:
    """Distinct pieces of the given lengths of all words of a lower-cased text."""
    words = F.array_distinct(F.split(low, f"{t.SPACE}+"))

    def pieces(letters: Column) -> Column:
        def of(size: int) -> Column:
            starts = F.when(F.size(letters) >= size, F.sequence(F.lit(1), F.size(letters) - (size - 1))).otherwise(F.array().cast("array<int>"))
            return F.transform(starts, lambda i: F.array_join(F.slice(letters, i, F.lit(size)), ""))

        return F.concat(*[of(n) for n in lengths])

    # A slice of letters costs its length, wherever it lies; a lambda's argument is computed once, whatever reads it.
    letters = F.transform(words, lambda word: F.filter(F.split(word, ""), lambda c: c != ""))
    return F.array_distinct(F.flatten(F.transform(letters, pieces)))


def _holds(low: Column, term: Column, match: str) -> Column:
    if match == "substring":
        return F.contains(low, term)
    if match == "word":
        return F.rlike(low, F.concat(F.lit(r"(?U)\b\Q"), term, F.lit(r"\E\b")))
    raise ValueError(f"match must be 'substring' or 'word', not {match!r}")


def find_terms(df: DataFrame, lists: Mapping[str, Iterable[str]], row_id: str = "event_id", match: str = "substring") -> DataFrame:
    """(row_id, label, pos, keyword) of every keyword that a row's title and content hold, as the unrolled search finds them.

    A keyword is looked up by an anchor: a rare piece of one of its words. The plan
    is the same for ten keywords and for ten thousand. Up to ``SHIPPED_TERMS``
    distinct keywords go to the tasks, which compare the windows of their texts'
    bytes with the anchors and check the whole keyword where one lies; texts stay
    where they are. More are joined on the anchor with the pieces of the texts'
    words as (id, piece) rows, and only texts with candidates move: there
    ``row_id`` must be unique.
    """
    rows, anchors = listed(lists)
    low = F.lower(t.title_and_content())
    texts = df.select(row_id, low.alias("_low"))
    spark = df.sparkSession
    if len(anchors) <= SHIPPED_TERMS:
        number = {term: i for i, term in enumerate(anchors)}
        known = spark.createDataFrame([(*r, number[r[3]]) for r in rows], "label string, pos int, keyword string, term string, nth int")
        held = F.explode(_terms_in(anchors)(F.col("_low"))).alias("nth")
        if match == "substring":  # what the tasks have checked
            return texts.select(row_id, held).join(F.broadcast(known), "nth").select(row_id, "label", "pos", "keyword")
        found = texts.select("*", held).join(F.broadcast(known), "nth")
    else:
        known = spark.createDataFrame([(*r, anchors[r[3]]) for r in rows], "label string, pos int, keyword string, term string, anchor string")
        offered = texts.select(row_id, F.explode(_grams(F.col("_low"), sorted({len(a) for a in anchors.values()}))).alias("anchor"))
        found = offered.join(known, "anchor").drop("anchor").join(texts, row_id)
    return found.where(_holds(F.col("_low"), F.col("term"), match)).select(row_id, "label", "pos", "keyword")


def terms_by_label(found: DataFrame, row_id: str = "event_id") -> DataFrame:
    """(row_id, label, matched, count): keywords in list order."""
    return (
        found.groupBy(row_id, "label")
        .agg(F.array_sort(F.collect_list(F.struct("pos", "keyword"))).alias("_all"))
        .select(row_id, "label", F.transform("_all", lambda s: s["keyword"]).alias("matched"), F.size("_all").alias("count"))
    )
