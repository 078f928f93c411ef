"""Byte passages that earlier documents hold, by suffix arrays over bins of candidates.

Every window of 50 bytes belongs to the bin of its least gram: the least hash of
the grams of 24 bytes inside it (hashed once more, as least values crowd together),
which equal windows share. Neighbouring windows
of one bin make a segment, so a text is some segments, one for about every 15
bytes. Bins that only one segment of the corpus falls into are found from sorted
lists of gram hashes and go no further. The segments of each other bin meet in a
task, where a suffix array of the distinct ones, built by Lyndon grouping, brings
equal windows next to each other.

Three passes read the texts in buckets of bounded size (the shuffle of the texts
is written once): for the lists of gram hashes, for the candidates, and for the
result. A bin too large for a task is split down to single windows, where no
order is left to find.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.llm.alignment import _put, _take
from tidewire.llm.kernels import mix
from tidewire.llm.tables import joined_by_text
from tidewire.session import cut_lineage

WINDOW = 50  # bytes of a passage
GRAM = 24  # bytes of the grams that name bins
BUCKET = 4 << 20  # bytes of text of a bucket; more for corpora of terabytes, so that buckets and groups meet in fewer rows
LARGEST_BUCKET = 64 << 20
HOT = 2048  # segments of a bin; those of larger bins go on as single windows
NOWHERE = 255
PIECE = 64  # windows of a segment at most; in periodic text pieces repeat, where whole runs would differ by their lengths
_SLICE = 1 << 19  # bytes hashed at a time
_NULL_ID = -(1 << 63)  # stands for a null id, which so comes first
_U = np.uint64
_BASE = _U(0x9FB21C651E98DF25)
_BYTE = mix(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))


def lyndon_groups(data: bytes) -> tuple[list[list[int]], list[int]]:
    """(groups, previous): suffixes grouped by their Lyndon prefix, highest group first, and pointers to earlier lower ones.

    Groups start as equal first bytes and are processed in descending order. When
    a group's turn comes, its members are final: each points to the nearest
    earlier suffix of a lower group, found by following the pointers of processed
    ones. The suffixes pointed to have a prefix that the group's extends; they
    leave their group for a new one right above it, further up the more members
    point to them, so their turn comes later and nothing is ever renamed.
    """
    symbols = sorted(set(data))
    number = {c: g for g, c in enumerate(symbols)}
    top = len(symbols)  # a group above all others, always empty
    group = [number[c] for c in data]
    members: list[list[int]] = [[] for _ in range(top + 1)]
    for i, g in enumerate(group):
        members[g].append(i)
    below, above = list(range(-1, top)), list(range(1, top + 2))
    previous = [-2] * len(data)  # -2: not processed, -1: none
    done: list[list[int]] = []
    g = below[top]
    while g >= 0:
        here = [i for i in members[g] if group[i] == g]
        if here:
            done.append(here)
            pointed: dict[int, int] = {}
            for i in here:
                p = i - 1
                while p >= 0 and previous[p] != -2:
                    p = previous[p]
                previous[i] = p
                if p >= 0:
                    pointed[p] = pointed.get(p, 0) + 1
            if len(pointed) == len(here):
                levels = [pointed]
            else:
                by_count: dict[int, list[int]] = {}
                for p, n in pointed.items():
                    by_count.setdefault(n, []).append(p)
                levels = [by_count[n] for n in sorted(by_count, reverse=True)]
            for level in levels:
                made: dict[int, int] = {}
                for p in level:
                    old = group[p]
                    new = made.get(old)
                    if new is None:
                        new = made[old] = len(members)
                        up = above[old]
                        members.append([])
                        above.append(up)
                        below.append(old)
                        above[old] = below[up] = new
                    group[p] = new
                    members[new].append(p)
        g = below[g]
    return done, previous


def suffix_order(data: bytes) -> list[int]:
    """Starts of all suffixes in ascending order, in linear time.

    Each group owns a run of places. Read in ascending order, a suffix at ``i``
    gives the next places of their groups to the larger ones that end where it
    starts: ``i - 1`` and along its pointers, up to one that has its place.
    """
    groups, previous = lyndon_groups(data)
    n = len(data)
    slot, owner, at = [0] * len(groups), [0] * n, n
    for k, here in enumerate(groups):
        at -= len(here)
        slot[k] = at
        for i in here:
            owner[i] = k
    order, placed = [-1] * n, bytearray(n)
    p, read = n - 1, 0
    while True:
        while p >= 0 and not placed[p]:
            placed[p] = 1
            k = owner[p]
            order[slot[k]] = p
            slot[k] += 1
            p = previous[p]
        if read == n:
            return order
        p = order[read] - 1
        read += 1


def _raise(n: int) -> np.uint64:
    return _U(pow(int(_BASE), n, 1 << 64))


_POWERS = {n: _raise(n) for n in range(65)}


def _gram_hashes(data: np.ndarray, sizes: tuple[int, ...]) -> list[np.ndarray]:
    """Hashes of all runs of each size, from polynomials of doubled lengths."""
    parts, span = {1: _BYTE[data]}, 1
    while 2 * span <= max(sizes):
        part = parts[span]
        m = max(0, len(part) - span)
        parts[2 * span] = part[:m] * _POWERS[span] + part[span : span + m]
        span *= 2
    out = []
    for size in sizes:
        total, covered = None, 0
        for span in sorted(parts, reverse=True):
            if size & span:
                m = max(0, len(data) - covered - span + 1)
                total = parts[span][:m] if total is None else total[:m] * _POWERS[span] + parts[span][covered : covered + m]
                covered += span
        out.append(mix(total))
    return out


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours."""
    span = 1
    while 2 * span <= width:
        values = np.minimum(values[: max(0, len(values) - span)], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[: max(0, len(values) - rest)], values[rest:]) if rest else values


class Segments:
    """Segments of a list of texts: bin, name (a hash of the content), text number, first byte, windows, and the place of the gram.

    The place is that of the bin's gram in the segment, if the same one lies in all its windows, else ``NOWHERE``.
    """

    def __init__(self, texts: list[bytes]):
        found, at = [], 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (end == at or size + len(texts[end]) <= _SLICE):
                size += len(texts[end])
                end += 1
            found.append(self._of(texts[at:end], at))
            at = end
        none = [np.empty(0, _U)] * 2 + [np.empty(0, np.int64)] * 4
        self.bin, self.name, self.text, self.start, self.windows, self.place = (np.concatenate(c) for c in zip(none, *found))

    @staticmethod
    def _of(texts: list[bytes], first: int) -> list[np.ndarray]:
        data = np.frombuffer(b"".join(texts), np.uint8)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        begins = np.cumsum(lengths) - lengths
        n = len(data) - WINDOW + 1
        if n <= 0:
            return [np.empty(0, _U)] * 2 + [np.empty(0, np.int64)] * 4
        grams, windows = _gram_hashes(data, (GRAM, WINDOW))
        least = _least(grams, WINDOW - GRAM + 1)
        cut = np.zeros(n + 1, bool)  # a segment or a stretch without windows starts here
        cut[1:n] = least[1:] != least[:-1]
        cut[begins[begins < n]] = True
        short = begins + np.maximum(lengths - WINDOW + 1, 0)
        cut[short[short < n]] = True
        starts = np.flatnonzero(cut[:n])
        text = np.searchsorted(begins, starts, "right") - 1
        sizes = np.diff(np.append(starts, n))
        names = mix(np.add.reduceat(windows, starts) + sizes.astype(_U))
        inside = starts < short[text]
        if sizes.max() > PIECE:  # long runs of one bin, as in periodic text, are cut
            return Segments._pieces(starts, sizes, least, windows, text, begins, inside, first)
        starts, text, sizes = starts[inside], text[inside], sizes[inside]
        place = (grams[starts[:, None] + np.arange(WINDOW - GRAM + 1)] == least[starts][:, None]).argmax(1)
        place[place < sizes - 1] = NOWHERE
        return [mix(least[starts]), names[inside], text + first, starts - begins[text], sizes, place]

    @staticmethod
    def _pieces(starts, sizes, least, windows, text, begins, inside, first) -> list[np.ndarray]:
        starts, sizes, text = starts[inside], sizes[inside], text[inside]
        parts = -(-sizes // PIECE)
        owner = np.repeat(np.arange(len(starts)), parts)
        offset = (np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)) * PIECE
        starts, sizes, text = starts[owner] + offset, np.minimum(PIECE, sizes[owner] - offset), text[owner]
        bounds = np.stack([starts, starts + sizes], 1).ravel()
        sums = np.add.reduceat(np.append(windows, _U(0)), bounds)[::2]
        return [mix(least[starts]), mix(sums + sizes.astype(_U)), text + first, starts - begins[text], sizes, np.full(len(starts), NOWHERE)]

    def kinds(self) -> tuple[np.ndarray, np.ndarray]:
        """(order, first): segments sorted so that equal ones lie together, and where each run of equal ones begins."""
        order = np.argsort(mix(self.bin ^ mix(self.name)), kind="stable")
        bins, names = self.bin[order], self.name[order]
        new = np.ones(len(order), bool)
        new[1:] = (bins[1:] != bins[:-1]) | (names[1:] != names[:-1])
        return order, np.flatnonzero(new)


def _short(bins: np.ndarray) -> np.ndarray:
    """48 bits of a bin: enough to tell which bins may have company."""
    return (bins >> _U(16)).astype(np.int64)


def _group_of(short: np.ndarray, groups: int) -> np.ndarray:
    """Groups are ranges of bins."""
    return ((short >> 16) * groups) >> 32


def _cuts(keys: np.ndarray) -> Iterator[tuple[int, slice]]:
    """(key, its slice) of ascending keys."""
    edge = np.flatnonzero(np.diff(keys)) + 1
    bounds = [0, *edge.tolist(), len(keys)] if len(keys) else [0]
    for a, b in zip(bounds, bounds[1:]):
        yield int(keys[a]), slice(a, b)


def _texts(table: pa.Table) -> tuple[list[bytes], list[bytes]]:
    """(digests, texts) of a bucket, each text once, in the order of the digests."""
    found = dict(zip(table.column("digest").to_pylist(), table.column("text").cast(pa.binary()).to_pylist()))
    digests = sorted(found)
    return digests, [found[d] for d in digests]


def _first_seen(texts: DataFrame) -> DataFrame:
    """Texts that a task meets again are not shuffled again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            fresh = []
            for digest in batch.column(1).to_pylist():
                fresh.append(digest not in seen)
                seen.add(digest)
            yield batch.filter(pa.array(fresh, pa.bool_()))

    return texts.mapInArrow(run, texts.schema)


_LISTS = "grp int, bucket int, blobs array<binary>"


def _lists(texts: DataFrame, groups: int) -> DataFrame:
    """(grp, bucket, [bins, segments]): the sorted bins of each bucket, and how many different segments are in each."""

    def run(table: pa.Table) -> pa.Table:
        found = Segments(_texts(table)[1])
        order, first = found.kinds()
        bins, counts = np.unique(_short(found.bin[order[first]]), return_counts=True)
        rows = [(g, [_put(np.diff(bins[s], prepend=0)), _put(counts[s])]) for g, s in _cuts(_group_of(bins, groups))]
        bucket = table.column("bucket")[0].as_py()
        return pa.table(
            {
                "grp": pa.array([g for g, _ in rows], pa.int32()), "bucket": pa.array([bucket] * len(rows), pa.int32()),
                "blobs": pa.array([b for _, b in rows], pa.list_(pa.binary())),
            }
        )

    return texts.groupBy("bucket").applyInArrow(run, _LISTS)


def _company(lists: DataFrame) -> DataFrame:
    """(bucket, grp, blobs): for each bin of a list, in its order, 0 if it has one segment in the corpus, 1 if more, 2 if over ``HOT``."""

    def run(table: pa.Table) -> pa.Table:
        bins, counts = zip(*((np.cumsum(_take(b)), _take(n)) for b, n in table.column("blobs").to_pylist()))
        known, index = np.unique(np.concatenate(bins), return_inverse=True)
        total = np.zeros(len(known), np.int64)
        np.add.at(total, index, np.concatenate(counts))
        level = ((total > 1).astype(np.uint8) + (total > HOT))[index]
        parts = np.split(level, np.cumsum([len(b) for b in bins])[:-1])
        blobs = [[np.packbits(x > 0).tobytes(), np.packbits(x > 1).tobytes()] for x in parts]
        return pa.table({"bucket": table.column("bucket"), "grp": table.column("grp"), "blobs": pa.array(blobs, pa.list_(pa.binary()))})

    return lists.groupBy("grp").applyInArrow(run, "bucket int, grp int, blobs array<binary>")


def _bits(blob: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(blob, np.uint8), count=n).astype(bool)


def _earliest(order: np.ndarray, first: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """For each entry, the least key among those equal to it."""
    out = np.empty(len(order), np.int64)
    if len(order):
        out[order] = np.repeat(np.minimum.reduceat(keys[order], first), np.diff(np.append(first, len(order))))
    return out


def _signed(keys: np.ndarray) -> bytes:
    return keys.astype(np.int64).tobytes()


def _candidates(texts: DataFrame, facts: DataFrame, groups: int) -> DataFrame:
    """(grp, bucket, blobs) of candidate segments with their bytes, and of spans that a bucket finds by itself.

    Of equal segments in a bucket only those of the least key go on; the windows
    of all later ones start earlier as well, whatever other buckets hold.
    """

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        digests, data = _texts(left)
        bucket = left.column("bucket")[0].as_py()
        key_of, levels = {}, []
        for grp, digest, key, blobs in zip(*(right.column(c).to_pylist() for c in ("grp", "digest", "key", "blobs"))):
            if digest is not None:
                key_of[digest] = key
            else:
                levels.append((grp, blobs))
        keys = np.array([key_of[d] for d in digests], np.int64)
        found = Segments(data)
        bins = np.unique(_short(found.bin))
        counts = dict(_cuts(_group_of(bins, groups)))
        more, hot = np.zeros(len(bins), bool), np.zeros(len(bins), bool)
        for grp, (a, b) in levels:
            s = counts[grp]
            more[s], hot[s] = _bits(a, s.stop - s.start), _bits(b, s.stop - s.start)
        order, first = found.kinds()
        key = keys[found.text]
        late = key > _earliest(order, first, key)
        spans = [(found.text[late], found.start[late], found.windows[late])]
        at = np.searchsorted(bins, _short(found.bin))
        rows = []
        chosen = np.flatnonzero(~late & more[at] & ~hot[at])
        rows += _segment_rows(data, keys, *(x[chosen] for x in (found.bin, found.text, found.start, found.windows, found.place)), bucket, groups)
        chosen = np.flatnonzero(~late & hot[at])
        if len(chosen):
            text, start = (np.repeat(x[chosen], found.windows[chosen]) for x in (found.text, found.start))
            start = start + np.arange(len(start)) - np.repeat(np.cumsum(found.windows[chosen]) - found.windows[chosen], found.windows[chosen])
            names = _window_names(data, text, start)
            order = np.argsort(names, kind="stable")
            first = np.flatnonzero(np.append(True, np.diff(names[order]) != 0))
            key = keys[text]
            late = key > _earliest(order, first, key)
            spans.append((text[late], start[late], np.ones(int(late.sum()), np.int64)))
            on = ~late
            rows += _segment_rows(data, keys, names[on], text[on], start[on], np.ones(int(on.sum()), np.int64), np.full(int(on.sum()), NOWHERE), bucket, groups)
        text, start, windows = (np.concatenate(c) for c in zip(*spans))
        if len(text):
            rows.append((bucket % groups, bucket, [_put(text), _put(start), _put(windows)]))
        return _table(rows)

    return texts.groupBy("bucket").cogroup(facts.groupBy("bucket")).applyInArrow(run, _LISTS)


def _table(rows: list[tuple]) -> pa.Table:
    return pa.table(
        {
            "grp": pa.array([r[0] for r in rows], pa.int32()), "bucket": pa.array([r[1] for r in rows], pa.int32()),
            "blobs": pa.array([r[2] for r in rows], pa.list_(pa.binary())),
        }
    )


def _window_names(data: list[bytes], text: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Hashes of single windows; ``text`` ascends in runs."""
    out = np.empty(len(text), _U)
    for t, s in _cuts(text):
        (names,) = _gram_hashes(np.frombuffer(data[t], np.uint8), (WINDOW,))
        out[s] = names[start[s]]
    return out


def _segment_rows(data, keys, bins, text, start, windows, place, bucket, groups) -> list[tuple]:
    """Rows of packed segments, one for each group that has any."""
    order = np.argsort(bins, kind="stable")
    bins, text, start, windows, place = bins[order], text[order], start[order], windows[order], place[order]
    out = []
    for g, s in _cuts(_group_of(_short(bins), groups)):
        content = b"".join([data[t][b : b + n] for t, b, n in zip(text[s].tolist(), start[s].tolist(), (windows[s] + WINDOW - 1).tolist())])
        packed = [_put(np.diff(bins[s].view(np.int64) ^ np.int64(-1 << 63), prepend=np.int64(0)).view(_U)), _signed(keys[text[s]])]
        out.append((g, bucket, [*packed, _put(text[s]), _put(start[s]), _put(windows[s]), _put(place[s]), content]))
    return out


def earlier_windows(contents: dict[bytes, int], places: list[int]) -> dict[bytes, list[int]]:
    """For each content (with the least key that holds it), the least key of every window, by a suffix array of all contents.

    Contents are laid end to end with a byte that UTF-8 does not use between
    them; suffixes of windows that are equal are neighbours in the order. Where
    one gram is known to lie in all windows, by its places in the contents, it is
    laid as one more such byte, for it is the same in all.
    """
    short = NOWHERE not in places
    laid = [c[:p] + b"\xff" + c[p + GRAM :] for c, p in zip(contents, places)] if short else list(contents)
    window = WINDOW - GRAM + 1 if short else WINDOW
    data = b"\xfe".join(laid)
    key_at, valid = [0] * len(data), bytearray(len(data))
    at = 0
    for part, key in zip(laid, contents.values()):
        n = len(part) - window + 1
        key_at[at : at + n] = [key] * n
        valid[at : at + n] = b"\x01" * n
        at += len(part) + 1
    before, run, least = b"", [], 0
    for i in suffix_order(data):
        if not valid[i]:
            continue
        this = data[i : i + window]
        if this == before:
            run.append(i)
            if key_at[i] < least:
                least = key_at[i]
        else:
            if len(run) > 1:
                for j in run:
                    key_at[j] = least
            before, run, least = this, [i], key_at[i]
    if len(run) > 1:
        for j in run:
            key_at[j] = least
    out, at = {}, 0
    for content, part in zip(contents, laid):
        out[content] = key_at[at : at + len(part) - window + 1]
        at += len(part) + 1
    return out


def _repeats(segments: DataFrame) -> DataFrame:
    """(bucket, blobs): spans of windows that a smaller key holds, bin by bin."""

    def run(table: pa.Table) -> pa.Table:
        buckets, spans, columns, contents = [], [], [], []
        for bucket, blobs in zip(table.column("bucket").to_pylist(), table.column("blobs").to_pylist()):
            if len(blobs) == 3:
                buckets.append(bucket)
                spans.append(blobs)
                continue
            bins, keys, text, start, windows, place, content = blobs
            bins = np.cumsum(_take(bins))
            text, start, windows = _take(text), _take(start), _take(windows)
            columns.append((bins, np.frombuffer(keys, np.int64), np.full(len(bins), bucket), text, start, _take(place)))
            at = 0
            for n in (windows + WINDOW - 1).tolist():
                contents.append(content[at : at + n])
                at += n
        if columns:
            bins, keys, bucket, text, start, place = (np.concatenate(c) for c in zip(*columns))
            order = np.argsort(bins, kind="stable")
            low, place = keys.tolist(), place.tolist()
            found: list[tuple[int, int, int]] = []  # (entry, first window, windows)
            edge = np.flatnonzero(np.append(True, np.diff(bins[order]) != 0))
            sizes = np.diff(np.append(edge, len(order)))
            ranked = order.tolist()
            for a, n in zip(edge[sizes > 1].tolist(), sizes[sizes > 1].tolist()):
                entries = ranked[a : a + n]
                first: dict[bytes, int] = {}
                for i in entries:
                    content, key = contents[i], low[i]
                    if first.setdefault(content, key) > key:
                        first[content] = key
                if len({low[i] for i in entries}) == 1:
                    continue
                if len(first) == 1:
                    (least,) = first.values()
                    found += [(i, 0, len(contents[i]) - WINDOW + 1) for i in entries if low[i] > least]
                    continue
                where = {contents[i]: place[i] for i in entries}
                least_of = earlier_windows(first, [where[c] for c in first])
                for i in entries:
                    key, begin = low[i], -1
                    least = least_of[contents[i]]
                    for j, x in enumerate(least):
                        if x < key:
                            if begin < 0:
                                begin = j
                        elif begin >= 0:
                            found.append((i, begin, j - begin))
                            begin = -1
                    if begin >= 0:
                        found.append((i, begin, len(least) - begin))
            if found:
                i, j, n = np.array(found, np.int64).T
                by = np.argsort(bucket[i], kind="stable")
                i, j, n = i[by], j[by], n[by]
                for b, s in _cuts(bucket[i]):
                    buckets.append(b)
                    spans.append([_put(text[i[s]]), _put(start[i[s]] + j[s]), _put(n[s])])
        return pa.table({"bucket": pa.array(buckets, pa.int32()), "blobs": pa.array(spans, pa.list_(pa.binary()))})

    return segments.groupBy("grp").applyInArrow(run, "bucket int, blobs array<binary>")


_SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32())])
_RESULT = "digest binary, n_bytes long, n_removed long, spans array<struct<start: int, end: int>>, kept binary"


def _cleaned(texts: DataFrame, spans: DataFrame) -> DataFrame:
    """(digest, n_bytes, n_removed, spans, kept) of each distinct text."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        digests, texts = _texts(left)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        ends = np.cumsum(lengths)
        begins = ends - lengths
        data = np.frombuffer(b"".join(texts), np.uint8)
        depth = np.zeros(len(data) + 1, np.int32)
        for blobs in right.column("blobs").to_pylist():
            text, start, windows = map(_take, blobs)
            np.add.at(depth, begins[text] + start, 1)
            np.add.at(depth, begins[text] + start + windows + WINDOW - 1, -1)
        gone = np.cumsum(depth[:-1]) > 0
        opens, closes = gone.copy(), np.zeros(len(gone) + 1, bool)
        opens[1:] &= ~gone[:-1]
        closes[1:-1] = gone[:-1] & ~gone[1:]
        closes[-1] = len(gone) > 0 and bool(gone[-1])
        inner = begins[(lengths > 0) & (begins > 0)]  # spans of neighbouring texts do not join
        opens[inner] = gone[inner]
        closes[inner] |= gone[inner - 1]
        first, last = np.flatnonzero(opens), np.flatnonzero(closes)
        owner = np.searchsorted(ends, first, "right")
        offsets = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(texts)))]).astype(np.int32)
        pairs = pa.StructArray.from_arrays(
            [pa.array(first - begins[owner], pa.int32()), pa.array(last - begins[owner], pa.int32())], fields=list(_SPAN)
        )
        removed = np.concatenate([[0], np.cumsum(gone)])
        removed = removed[ends] - removed[begins]
        kept = data[~gone].tobytes()
        cut = np.concatenate([[0], np.cumsum(lengths - removed)]).tolist()
        return pa.table(
            {
                "digest": pa.array(digests, pa.binary()), "n_bytes": lengths, "n_removed": removed.astype(np.int64),
                "spans": pa.ListArray.from_arrays(pa.array(offsets), pairs), "kept": pa.array([kept[a:b] for a, b in zip(cut, cut[1:])], pa.binary()),
            }
        )

    return texts.groupBy("bucket").cogroup(spans.groupBy("bucket")).applyInArrow(run, _RESULT)


def cleaned_texts(named: DataFrame, buckets: int, groups: int) -> DataFrame:
    """(digest, n_bytes, n_removed, spans, kept, first_key, copies) of each distinct text of ``named`` (key, digest, text)."""
    bucket = F.pmod(F.xxhash64("digest"), F.lit(buckets)).cast("int").alias("bucket")
    firsts = named.groupBy("digest").agg(F.min("key").alias("key"), F.count("*").alias("copies"))
    texts = _first_seen(named.select(bucket, "digest", "text"))
    company = _company(_lists(texts, groups))
    facts = firsts.select(bucket, "digest", "key").unionByName(company, allowMissingColumns=True)
    found = _cleaned(texts, _repeats(_candidates(texts, facts, groups)))
    return found.join(firsts.withColumnRenamed("key", "first_key"), "digest")


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shape: Callable[[Column], Column] = lambda kept: kept
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, spans, kept) of every row of ``docs``.

    Texts are read as UTF-8 bytes. ``spans`` are the maximal runs of bytes covered
    by a string of 50 bytes that also starts in a document of smaller id, as
    [start, end); ``kept`` is the other bytes, shaped by ``shape`` before they are
    joined to the rows (a digest travels lighter than bytes). Strings are judged on
    the input, and none reaches across documents. A null text is empty, a null id
    comes before all others; rows of equal id do not count as earlier than one
    another, so repeated rows get equal results. Other columns are not read. The
    length of a text is bounded only by a task's memory.

    Of equal texts one is looked at, for the least id; rows of a greater id lose
    all of a text of 50 bytes or more.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    buckets = size // min(LARGEST_BUCKET, max(BUCKET, 32 * math.isqrt(size))) + 1
    key = F.coalesce(F.col(id_col).cast("bigint"), F.lit(_NULL_ID)).alias("key")
    digest = F.unhex(F.md5(text.cast("binary"))).alias("digest")
    named = docs.select(F.col(id_col).alias("doc_id"), key, digest, text.alias("text"))
    found = cleaned_texts(named, buckets, max(16, buckets // 2))
    found = found.select("*", shape(F.lit(b"").cast("binary")).alias("_nothing")).withColumn("kept", shape(F.col("kept")))
    rows = joined_by_text(named.drop("text"), cut_lineage(found, "cleaned"))
    copy = (F.col("key") > F.col("first_key")) & (F.col("n_bytes") >= WINDOW)
    whole = F.array(F.struct(F.lit(0).alias("start"), F.col("n_bytes").cast("int").alias("end")))
    return rows.select(
        "doc_id", "n_bytes", F.when(copy, F.col("n_bytes")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(copy, whole).otherwise(F.col("spans")).alias("spans"), F.when(copy, F.col("_nothing")).otherwise(F.col("kept")).alias("kept"),
    )
