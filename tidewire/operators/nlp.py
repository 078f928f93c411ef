"""Lexicon sentiment, extractive summaries and text embedding."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.functions import lexicons as lx
from tidewire.functions import text as t

EMBEDDED_ROWS, EMBEDDED_TOKENS = 512, 1 << 16  # texts and tokens that a task's arithmetic holds at once


def sentiment_of(body: Column, positive: Iterable[str], negative: Iterable[str]) -> Column:
    """Struct score/label/positive_words/negative_words of a text.

    Distinct white-space tokens count once; punctuation stays on the token.
    """

    def lexicon(words: Iterable[str]) -> Column:
        return F.array(*[F.lit(w) for w in words])

    def build(words: Column) -> Column:
        pos = F.size(F.array_intersect(words, lexicon(positive)))
        neg = F.size(F.array_intersect(words, lexicon(negative)))
        return F.struct(pos.alias("pos"), neg.alias("neg"))

    def scored(counts: Column) -> Column:
        pos, neg = counts["pos"], counts["neg"]
        score = (pos - neg) / F.greatest(pos + neg, F.lit(1))
        return F.struct(
            F.round(score, 4).alias("score"),
            F.when(score > 0.1, "positive").when(score < -0.1, "negative").otherwise("neutral").alias("label"),
            pos.alias("positive_words"),
            neg.alias("negative_words"),
        )

    # one-element transforms bind the token array and the counts once each
    words = F.array(F.split(F.lower(body), f"{t.SPACE}+"))
    return F.transform(F.transform(words, build), scored)[0]


def score_sentiment(
    df: DataFrame,
    positive: Iterable[str] = lx.POSITIVE_WORDS,
    negative: Iterable[str] = lx.NEGATIVE_WORDS,
) -> DataFrame:
    return df.withColumn("sentiment", sentiment_of(t.title_and_content(), positive, negative))


def summarize(
    df: DataFrame,
    max_sentences: int = 3,
    keywords: Iterable[str] = lx.SUMMARY_KEYWORDS,
    bonus: int = 10,
) -> DataFrame:
    """The ``max_sentences`` longest sentences, keyword sentences lifted, best first.

    Texts with no more sentences than that are returned unchanged.
    """
    body = t.first_filled(
        F.col("content"), F.col("description") if "description" in df.columns else F.lit("")
    )
    full = F.concat(t.col_or_blank("title"), F.lit(". "), body)
    keywords = list(keywords)

    def rank(sentence: Column, i: Column) -> Column:
        # bound once: inside a lambda nothing is shared between the keyword tests
        lowered = F.array(F.lower(sentence))
        lifted = F.transform(
            lowered, lambda low: F.when(t.mentions_any(low, keywords), bonus).otherwise(0)
        )[0]
        points = F.size(t.tokens(sentence)) + lifted
        return F.struct((-points).alias("p"), i.alias("i"), sentence.alias("s"))

    best = F.slice(F.array_sort(F.transform("_sentences", rank)), 1, max_sentences)
    return (
        df.withColumn("_full", full)
        .withColumn("_sentences", F.split(t.strip(F.col("_full")), rf"(?<=[.!?]){t.SPACE}+"))
        .withColumn(
            "summary",
            F.when(F.size("_sentences") <= max_sentences, F.col("_full")).otherwise(
                F.array_join(F.transform(best, lambda x: x["s"]), " ")
            ),
        )
        .drop("_full", "_sentences")
    )


def _hashed_vectors(dim: int):
    """Arrow function: token slots -> unit vectors (signed feature hashing)."""

    @F.arrow_udf(T.ArrayType(T.FloatType()))
    def vectors(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for slots in batches:
            n = len(slots)
            done = np.empty((n, dim), np.float32)
            for row in range(0, n, EMBEDDED_ROWS):
                part = slots.slice(row, EMBEDDED_ROWS)
                flat, bounds = part.flatten().to_numpy(zero_copy_only=False), part.offsets.to_numpy() - part.offsets[0].as_py()
                out = np.zeros(len(part) * dim)
                for at in range(0, len(flat), EMBEDDED_TOKENS):  # signs are whole numbers: their sums do not depend on the steps
                    some = flat[at : at + EMBEDDED_TOKENS].astype(np.int64)
                    owner = np.searchsorted(bounds, np.arange(at, at + len(some)), "right") - 1
                    out += np.bincount(owner * dim + some % dim, weights=np.where(some >= dim, -1.0, 1.0), minlength=len(out))
                out = out.reshape(len(part), dim)
                norm = np.linalg.norm(out, axis=1, keepdims=True)
                done[row : row + len(part)] = np.divide(out, norm, out=np.zeros_like(out), where=norm > 0)
            offsets = np.arange(0, (n + 1) * dim, dim, dtype=np.int32)
            yield pa.ListArray.from_arrays(pa.array(offsets), pa.array(done.ravel()))

    return vectors


def hash_embedding(body: Column, dim: int) -> Column:
    """Feature hashing: tokens are hashed JVM-side, only slot numbers cross to Python.

    The slot comes from the first 32 bits of the token's md5, which any engine can compute.
    """
    slots = F.transform(
        t.tokens(F.lower(body)),
        lambda w: F.pmod(F.conv(F.substring(F.md5(w.cast("binary")), 1, 8), 16, 10).cast("bigint"), F.lit(2 * dim)).cast("int"),
    )
    return _hashed_vectors(dim)(slots)


Encoder = Callable[[list[str]], np.ndarray]


def embed_text(
    df: DataFrame,
    dim: int = 384,
    load_encoder: Callable[[], Encoder] | None = None,
    batch_size: int = 64,
) -> DataFrame:
    """Add ``embedding`` and ``embedding_dim`` for 'title content'.

    ``load_encoder`` is called once per task and returns a function from texts
    to a matrix, so a model is loaded once per partition. Without one, signed
    feature hashing is used.
    """
    body = t.title_and_content()
    if load_encoder is None:
        return df.withColumn("embedding", hash_embedding(body, dim)).withColumn(
            "embedding_dim", F.lit(dim)
        )

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = load_encoder()
        for texts in batches:
            parts = [
                np.asarray(encoder(texts.iloc[i : i + batch_size].tolist()), dtype=np.float32)
                for i in range(0, len(texts), batch_size)
            ]
            yield pd.Series([row for part in parts for row in part])

    return df.withColumn("embedding", encode(body)).withColumn(
        "embedding_dim", F.size("embedding")
    )
