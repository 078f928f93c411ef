"""Array arithmetic on batches of texts: word and window hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)

_U = np.uint64
_SPACES = np.zeros(256, bool)
_SPACES[[32, *range(9, 14)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every bit of the input moves about half of the output's."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE = mix(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))
_BYTE[_SPACES] = 0
_BASE = _U(0xD1342543DE82EF95)
_powers = np.ones(1, _U)


def _power(n: int) -> np.ndarray:
    """At least the first ``n`` powers of the base."""
    global _powers
    if len(_powers) < n:
        steps = np.full(1 << max(10, (n - 1).bit_length()), _BASE, _U)
        steps[0] = 1
        _powers = np.cumprod(steps, dtype=_U)
    return _powers


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts with a blank after each, start of each text)."""
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    return data, np.concatenate([[0], np.cumsum(lengths)[:-1]])


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, text number, first byte, end byte in the text) of every word of the texts, in order."""
    data, text_at = joined(texts)
    inside = ~_SPACES[data]
    turn = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0)))
    starts, ends = turn[0::2], turn[1::2]
    if not len(starts):
        none = np.empty(0, np.int64)
        return np.empty(0, _U), none, none, none
    body = data[starts[0] :]
    gaps = np.diff(np.append(starts, len(data)))
    place = np.arange(len(body)) - np.repeat(starts - starts[0], gaps)
    hashes = np.add.reduceat(_BYTE[body] * _power(int(gaps.max()))[place], starts - starts[0])
    text = np.searchsorted(text_at, starts, "right") - 1
    return mix(hashes + (ends - starts).astype(_U)), text, starts - text_at[text], ends - text_at[text]


def window_hashes(words: np.ndarray, text: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, index of the first word) of every run of ``size`` words within one text."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, _U), np.empty(0, np.int64)
    # Polynomials of doubled lengths, joined by the bits of the size.
    span, part, total, done = 1, words, None, 0
    left, base = size, _BASE
    while True:
        if left & 1:
            if total is None:
                total, done = part, span
            else:  # the longer part comes first, what is there follows it
                m = len(words) - done - span + 1
                total = part[:m] * _raise(done) + total[span : span + m]
                done += span
        left >>= 1
        if not left:
            break
        m = len(words) - 2 * span + 1
        part = part[:m] * _raise(span) + part[span : span + m]
        span *= 2
    at = np.flatnonzero(text[:n] == text[size - 1 :])
    return mix(total[:n][at] + _U(size)), at


def _raise(n: int) -> np.uint64:
    return _power(n + 1)[n]


def slices(batch: pa.RecordBatch, column: int, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """The batch in consecutive parts of about ``most_bytes`` of text, a row at least."""
    lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    total = np.cumsum(lengths)
    start = 0
    while start < batch.num_rows:
        base = total[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(total, base + most_bytes, "right")))
        yield batch.slice(start, end - start)
        start = end


def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]
