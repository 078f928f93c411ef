"""Fill-in-the-middle examples by displacement scatter over batches of bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.llm.kernels import slices, texts_of

CHUNK = 4 << 20  # bytes of text rearranged at a time
PLAIN, PSM, SPM = 0, 1, 2
FORMS = np.array(["plain", "psm", "spm"])
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_MARK = np.zeros(256, bool)
_MARK[list(b"PSM")] = True


def _text_column(data: np.ndarray, lengths: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.Array.from_buffers(pa.string(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _steps(starts: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """The value of the last of the ascending ``starts`` at or before each place, by a difference array and its sum.

    Starts that coincide belong to empty runs; their differences add up to the last one's value.
    """
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, starts, np.diff(values, prepend=0))
    return np.cumsum(change[:size])


def _marks(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, row) of every ``<P>``, ``<S>`` and ``<M>`` that lies within one row."""
    at = np.flatnonzero((data[:-2] == 60) & _MARK[data[1:-1]] & (data[2:] == 62)) if len(data) > 2 else np.empty(0, np.int64)
    row = np.searchsorted(ends, at, "right")
    inside = at + 2 < ends[row]
    return at[inside], row[inside]


def rearrange(texts: list[bytes], h: np.ndarray) -> tuple[np.ndarray, ...]:
    """(output bytes, their lengths, form, units, code points of prefix and of middle) for a list of texts.

    ``h`` has a row of four whole numbers for each text.
    """
    data = np.frombuffer(b"".join(texts), np.uint8)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(lengths)
    begins = ends - lengths
    lead = (data & 0xC0) != 0x80
    letter = _LETTER[data]
    joined = np.zeros(len(data), bool)
    joined[1:] = letter[1:] & letter[:-1]
    joined[begins[lengths > 0]] = False
    cuts = np.flatnonzero(lead & ~joined)  # first bytes of units
    first = np.searchsorted(cuts, begins)
    n = np.searchsorted(cuts, ends) - first
    x, y = h[:, 0] % (n + 1), h[:, 1] % (n + 1)
    place = np.append(cuts, len(data))
    lo, hi = (np.where(k < n, place[np.minimum(first + k, len(cuts))], ends) for k in (np.minimum(x, y), np.maximum(x, y)))
    form = np.where(h[:, 3] % 100 < 20, SPM, PSM)
    form[(lengths == 0) | (h[:, 2] % 100 >= 90)] = PLAIN
    form[_marks(data, ends)[1]] = PLAIN
    moved, spm = form != PLAIN, form == SPM

    out_lengths = lengths + 9 * moved
    out_begins = np.cumsum(out_lengths) - out_lengths
    p, m, s = lo - begins, hi - lo, ends - hi
    base = out_begins - begins
    prefix = base + np.where(spm, 6 + s, 3)
    middle = base + 9 + s
    suffix = base + np.where(spm, 3 - p - m, 6 - m)
    shifts = np.stack([np.where(moved, v, base) for v in (prefix, middle, suffix)], 1).ravel()
    shift = _steps(np.stack([begins, lo, hi], 1).ravel(), shifts, len(data))
    out = np.empty(int(out_lengths.sum()), np.uint8)
    out[np.arange(len(data)) + shift] = data
    one, two, three = out_begins, out_begins + 3 + np.where(spm, s, p), out_begins + 6 + p + s
    for at, name in ((np.where(spm, two, one), b"P"), (np.where(spm, one, two), b"S"), (three, b"M")):
        at = at[moved]
        out[at], out[at + 1], out[at + 2] = 60, name[0], 62
    points = np.concatenate([[0], np.cumsum(lead)])
    return out, out_lengths, form, n, points[lo] - points[begins], points[hi] - points[lo]


def restore(data: np.ndarray, lengths: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text bytes, their lengths) from outputs and forms alone: marks are found, parts gathered back into place.

    Parts hold no mark, and none can arise where a part and a mark meet, so the
    marks of an output are exactly its three.
    """
    ends = np.cumsum(lengths)
    moved = form != PLAIN
    at, row = _marks(data, ends)
    marks = np.zeros((len(form), 3), np.int64)
    marks[moved] = at[moved[row]].reshape(-1, 3)
    one, two, three = marks.T
    spm = form == SPM
    first, second, m = two - one - 3, three - two - 3, ends - three - 3
    p, s = np.where(spm, second, first), np.where(spm, first, second)
    whole = np.where(moved, lengths - 9, lengths)
    begins = np.cumsum(whole) - whole
    p, m = np.where(moved, p, whole), np.where(moved, m, 0)
    lo, hi = begins + p, begins + p + m
    prefix = np.where(moved, np.where(spm, two, one) + 3, ends - lengths) - begins
    middle, suffix = three + 3 - lo, np.where(spm, one, two) + 3 - hi
    source = _steps(np.stack([begins, lo, hi], 1).ravel(), np.stack([prefix, middle, suffix], 1).ravel(), int(whole.sum()))
    return data[np.arange(len(source)) + source], whole


def _draws(doc_id: Column, seed: int) -> list[Column]:
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint").alias(f"h{i + 1}") for i in range(4)]


def infill_documents(docs: DataFrame, seed: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output, restored) of every row of ``docs``.

    A text is cut into ``n`` units, runs of ASCII letters or single other code
    points; two cuts drawn from the seed and the id divide it into prefix, middle
    and suffix. ``psm`` gives ``<P>``prefix``<S>``suffix``<M>``middle, ``spm`` puts the
    suffix first. Empty and null texts, texts that hold a mark, and a tenth of the
    others by draw are ``plain``: the output is the text and the lengths are null.
    A null id draws as an empty one; repeated rows give equal results; other
    columns are not read. Rows are independent, so work is one map over the input
    in slices of about ``CHUNK`` bytes; a longer text is a slice of its own.
    """
    schema = T.StructType(
        [T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("n", T.LongType(), False), T.StructField("form", T.StringType(), False)]
        + [T.StructField(c, T.LongType()) for c in ("prefix_chars", "middle_chars")]
        + [T.StructField(c, T.StringType(), False) for c in ("output", "restored")]
    )
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1, CHUNK):
                h = np.stack([part.column(i).to_numpy() for i in range(2, 6)], 1)
                out, lengths, form, n, prefix, middle = rearrange(texts_of(part.column(1)), h)
                back, whole = restore(out, lengths, form)
                plain = form == PLAIN
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), pa.array(n, pa.int64()), pa.array(FORMS[form].tolist()), pa.array(prefix, pa.int64(), mask=plain),
                        pa.array(middle, pa.int64(), mask=plain), _text_column(out, lengths), _text_column(back, whole),
                    ],
                    names=names,
                )

    drawn = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), *_draws(F.col(id_col), seed))
    return drawn.mapInArrow(run, schema)
