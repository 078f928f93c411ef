"""Alignment of two tokenizers over a corpus, each distinct text once.

Texts are made distinct by a shuffle on the full text. Each is tokenised twice
and aligned in a task, through elements (words with the blank before them) that no
token of either side crosses and that are kept in a dictionary; a chunk of texts keeps its links as numbers into its own
sorted list of id pairs, and sends per pair how many documents of the chunk hold
it linked. Groups of A ids add these up and send the corpus counts back to the
chunks that asked, in the order of their lists. Measures of a text then come
from its links alone and are joined to the ids of the documents that hold it.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.llm.kernels import slices, texts_of
from tidewire.llm.tables import joined_by_text
from tidewire.session import cut_lineage

CHUNK = 8 << 20  # bytes of distinct texts that share one list of pairs
SLICE = 1 << 20  # bytes of text tokenised at a time
GROUP = 1 << 25  # bytes of text for each group of A ids
DICTIONARY = 8 << 20  # characters of elements that a task remembers
_ID_BITS = 20
# A blank, white space and a word, with what other white space joins to it; one blank at the end of a text stays with its last word.
_ELEMENT = re.compile(r" \s*\S*(?:[^\S ]\s*\S*)*(?: \Z)?")
_MEASURES = ("n_a", "n_b", "n_groups", "n_links")


def _byte_values() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies use for the 256 bytes: printable Latin-1 for itself, the rest from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Aligner:
    """Both tokenizers, and the bytes of each of their tokens."""

    def __init__(self, byte_level: bytes, piece_model: bytes):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(byte_level.decode())
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=piece_model)
        value = _byte_values()
        self.bytes_a = [b""] * (1 + max(self.a.get_vocab().values()))
        for token, i in self.a.get_vocab().items():
            self.bytes_a[i] = bytes(value[c] for c in token) if all(c in value for c in token) else token.encode()
        self.bytes_b = []
        for i in range(self.b.vocab_size()):
            piece = self.b.id_to_piece(i)
            self.bytes_b.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
        if max(len(self.bytes_a), len(self.bytes_b)) > 1 << _ID_BITS:
            raise ValueError(f"ids must be below {1 << _ID_BITS}")
        self.length_a, self.length_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        self.names = [[np.array([b"%d%s" % (i, end) for i in range(len(t))], object) for end in ends]
                      for t, ends in ((self.bytes_a, (b",", b"|")), (self.bytes_b, (b",", b";")))]
        # Merges cannot reach over a blank after another character if no piece has one inside.
        self.divides = not any("▁" in self.b.id_to_piece(i).lstrip("▁") for i in range(self.b.vocab_size()))

    def encode(self, texts: list[str]) -> list[tuple[list[int], list[int]]]:
        """(A ids, B ids) of each text; both empty for an empty text and where the tokens are not the text's bytes."""
        ids_a = [e.ids for e in self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
        ids_b = self.b.encode(texts, num_threads=1)
        out, of_a, of_b = [], self.bytes_a.__getitem__, self.bytes_b.__getitem__
        for text, a, b in zip(texts, ids_a, ids_b):
            whole = b" " + text.encode()
            same = text and b"".join(map(of_a, a)) == whole and b"".join(map(of_b, b)) == whole
            out.append((a, b) if same else ([], []))
        return out

    def elements(self, text: str) -> list[str]:
        """A blank and the text, cut where neither tokenizer has a token across: at blanks that follow no white space.

        A's pattern never joins white space to what stands before it, and B's
        merges stop there too. So the tokens of a text are those of its elements.
        """
        return _ELEMENT.findall(" " + text) if self.divides else [" " + text]


class Links:
    """Links of a list of token pairs: per entry the counts of ``_MEASURES`` and its groups as text; all links as (entry, pair)."""

    def __init__(self, aligner: Aligner, tokens: list[tuple[list[int], list[int]]]):
        k = len(tokens)
        n_a, n_b = (np.fromiter((len(t[s]) for t in tokens), np.int64, k) for s in (0, 1))
        a, b = (np.fromiter(chain.from_iterable(t[s] for t in tokens), np.int64, int(n.sum())) for s, n in ((0, n_a), (1, n_b)))
        # Both cover the same bytes of the entries laid end to end, so ends compare across the entries.
        ends_a, ends_b = np.cumsum(aligner.length_a[a]), np.cumsum(aligner.length_b[b])
        entry_of_a = np.repeat(np.arange(k), n_a)
        shared = np.intersect1d(ends_a, ends_b, assume_unique=True)
        n_groups = np.bincount(entry_of_a[np.searchsorted(ends_a, shared)], minlength=k)
        # Between two neighbouring ends of either side lies one overlap of one A and one B token.
        cuts = np.union1d(ends_a, ends_b)
        at_a, at_b = np.searchsorted(ends_a, cuts), np.searchsorted(ends_b, cuts)
        self.entry = entry_of_a[at_a]
        self.pair = a[at_a] << _ID_BITS | b[at_b]
        self.counts = np.stack([n_a, n_b, n_groups, np.bincount(self.entry, minlength=k)], 1)
        self.groups = self._groups(aligner, a, b, ends_a, ends_b, shared, n_a + n_b)

    @staticmethod
    def _groups(aligner, a, b, ends_a, ends_b, shared, sizes) -> list[bytes]:
        group_a, group_b = np.searchsorted(shared, ends_a), np.searchsorted(shared, ends_b)
        last_a, last_b = np.searchsorted(ends_a, shared), np.searchsorted(ends_b, shared)
        (comma_a, bar), (comma_b, semicolon) = aligner.names
        names_a, names_b = comma_a[a], comma_b[b]
        names_a[last_a], names_b[last_b] = bar[a[last_a]], semicolon[b[last_b]]
        laid = np.empty(len(a) + len(b), object)  # a group's A tokens, then its B tokens
        laid[np.arange(len(a)) + np.concatenate([[0], last_b + 1])[group_a]] = names_a
        laid[np.arange(len(b)) + (last_a + 1)[group_b]] = names_b
        laid, out, at = laid.tolist(), [], 0
        for n in sizes.tolist():
            out.append(b"".join(laid[at : at + n])[:-1])
            at += n
        return out


class Dictionary:
    """Elements that a task has met, each tokenised and aligned once, numbered as they come."""

    def __init__(self, aligner: Aligner):
        self.aligner = aligner
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.held = 0
        self.groups: list[bytes] = []
        self.counts = np.empty((0, len(_MEASURES)), np.int64)
        self.begin = np.zeros(1, np.int64)  # links of element e are pair[begin[e]:begin[e + 1]]
        self.pair = np.empty(0, np.int64)

    def learn(self, elements: set[str]) -> None:
        """Adds what is missing; the whole is dropped first when it has outgrown ``DICTIONARY`` characters."""
        if self.held > DICTIONARY:
            self.clear()
        new = [e for e in elements if e not in self.number]
        if not new:
            return
        links = Links(self.aligner, self.aligner.encode([e[1:] for e in new]))
        self.number.update(zip(new, range(len(self.number), len(self.number) + len(new))))
        self.held += sum(map(len, new))
        self.groups += links.groups
        self.counts = np.concatenate([self.counts, links.counts])
        self.begin = np.concatenate([self.begin, self.begin[-1] + np.cumsum(links.counts[:, 3])])
        self.pair = np.concatenate([self.pair, links.pair])


class Aligned:
    """Texts by their elements: per text the counts of ``_MEASURES``, a digest of the groups, and (text, pair, times) of its links."""

    def __init__(self, known: Dictionary, texts: list[str]):
        elements = [known.aligner.elements(t) if t else [] for t in texts]
        known.learn(set(chain.from_iterable(elements)))
        k = len(texts)
        sizes = np.fromiter(map(len, elements), np.int64, k)
        ids = np.fromiter(map(known.number.__getitem__, chain.from_iterable(elements)), np.int64, int(sizes.sum()))
        text = np.repeat(np.arange(k), sizes)
        whole = np.ones(k, bool)  # an element whose tokens are not its bytes takes the tokens from all of its text
        whole[text[known.counts[ids, 0] == 0]] = False
        groups, self.digests, at = known.groups, [], 0
        for n, good in zip(sizes.tolist(), whole.tolist()):
            joined = b";".join([groups[i] for i in ids[at : at + n].tolist()]) if good and n else b""
            self.digests.append(hashlib.sha256(joined).digest() if joined else b"")
            at += n
        ids, text = ids[whole[text]], text[whole[text]]
        self.counts = np.stack([np.bincount(text, known.counts[ids, c], k) for c in range(len(_MEASURES))], 1).astype(np.int64)
        # Each element once per text, then its links, then each pair once per text.
        both, times = np.unique(text << 32 | ids, return_counts=True)
        text, ids = both >> 32, both & 0xFFFFFFFF
        n = known.counts[ids, 3]
        place = np.arange(int(n.sum())) + np.repeat(known.begin[ids] - (np.cumsum(n) - n), n)
        pair, text, times = known.pair[place], np.repeat(text, n), np.repeat(times, n)
        order = np.lexsort((pair, text))
        pair, text, times = pair[order], text[order], times[order]
        at = np.flatnonzero(np.append(True, (pair[1:] != pair[:-1]) | (text[1:] != text[:-1]))) if len(pair) else np.empty(0, np.int64)
        self.text, self.pair = text[at], pair[at]
        self.times = np.add.reduceat(times, at) if len(at) else times


def _narrow(values: np.ndarray) -> np.ndarray:
    """The same whole numbers (0 or more) in the least unsigned type that holds them."""
    return values.astype(np.min_scalar_type(int(values.max()) if len(values) else 0))


def _put(values: np.ndarray) -> bytes:
    """Whole numbers, 0 or more, as bytes: the width, then all lowest bytes, then all second ones and so on."""
    values = _narrow(values)
    return bytes([values.itemsize]) + values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def _take(blob: bytes) -> np.ndarray:
    width = blob[0]
    if len(blob) == 1:
        return np.empty(0, np.int64)
    planes = np.frombuffer(blob, np.uint8, offset=1).reshape(width, -1)
    return np.ascontiguousarray(planes.T).view(f"u{width}").ravel().astype(np.int64)


class _Chunk:
    """Texts under one list of pairs, gathered slice by slice."""

    def __init__(self):
        self.digests, self.copies, self.counts, self.groups, self.keys, self.times = [], [], [], [], [], []
        self.texts = self.size = 0

    def add(self, digests: list[bytes], copies: np.ndarray, aligned: Aligned, size: int) -> None:
        self.keys.append((aligned.text + self.texts, aligned.pair))
        self.times.append(aligned.times)
        self.digests += digests
        self.copies.append(copies)
        self.counts.append(aligned.counts)
        self.groups += aligned.digests
        self.texts += len(digests)
        self.size += size

    def rows(self, chunk: int, groups: int) -> list[tuple]:
        """The measures row (group -1), and a row of pairs for each group of A ids that the chunk has."""
        text, pair = (np.concatenate(c) for c in zip(*self.keys))
        copies = np.concatenate(self.copies)
        pairs, index = np.unique(pair, return_inverse=True)
        held = np.zeros(len(pairs), np.int64)
        np.add.at(held, index, copies[text])
        group = (pairs >> _ID_BITS) % groups
        order = np.argsort(group, kind="stable")  # lists of the groups one after the other, each ascending
        place = np.empty(len(pairs), np.int64)
        place[order] = np.arange(len(pairs))
        per_text = np.bincount(text, minlength=self.texts)
        blobs = [_put(x) for x in (copies, per_text, place[index], np.concatenate(self.times), *np.concatenate(self.counts).T)]
        out = [(chunk, -1, [b"".join(self.digests), b"".join(x or bytes(32) for x in self.groups), *blobs])]
        cut = np.flatnonzero(np.diff(group[order], prepend=-1))
        for rows in np.split(order, cut[1:]) if len(order) else ():
            out.append((chunk, int(group[rows[0]]), [_put(np.diff(pairs[rows], prepend=0)), _put(held[rows])]))
        return out


_ROWS = "chunk long, grp int, blobs array<binary>"


def _chunks(texts: DataFrame, shipped, groups: int) -> DataFrame:
    """(chunk, grp, blobs) of distinct texts (text, digest, copies)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Dictionary(Aligner(*shipped.value))
        base, done, held = TaskContext.get().partitionId() << 32, 0, _Chunk()

        def closed() -> pa.RecordBatch:
            rows = held.rows(base | done, groups)
            types = (pa.int64(), pa.int32(), pa.list_(pa.binary()))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["chunk", "grp", "blobs"])

        for batch in batches:
            for part in slices(batch, 0, SLICE):
                data = texts_of(part.column(0))
                aligned = Aligned(known, [x.decode() for x in data])
                held.add(part.column(1).to_pylist(), part.column(2).to_numpy(), aligned, sum(map(len, data)))
                if held.size >= CHUNK:
                    yield closed()
                    done, held = done + 1, _Chunk()
        if held.texts:
            yield closed()

    return texts.select("text", "digest", "copies").mapInArrow(run, _ROWS)


def _counts(pairs: DataFrame) -> DataFrame:
    """(chunk, grp, blob): for each of a chunk's pairs, in its order, twice the corpus count, plus one where it is its A id's highest."""

    def run(table: pa.Table) -> pa.Table:
        lists, held = [], []
        for pair, count in table.column("blobs").to_pylist():
            lists.append(np.cumsum(_take(pair)))
            held.append(_take(count))
        sizes = [len(x) for x in lists]
        pairs, index = np.unique(np.concatenate(lists), return_inverse=True)
        total = np.zeros(len(pairs), np.int64)
        np.add.at(total, index, np.concatenate(held))
        a = pairs >> _ID_BITS
        first = np.flatnonzero(np.diff(a, prepend=-1))
        highest = np.repeat(np.maximum.reduceat(total, first), np.diff(np.append(first, len(a))))
        said = (2 * total + (total == highest))[index]
        blobs = [_put(x) for x in np.split(said, np.cumsum(sizes)[:-1])]
        return pa.table({"chunk": table.column("chunk"), "grp": table.column("grp"), "blob": pa.array(blobs, pa.binary())})

    return pairs.groupBy("grp").applyInArrow(run, "chunk long, grp int, blob binary")


_COLUMNS = ("digest", "copies", *_MEASURES, "n_best", "count_sum", "groups_sha256")
_RESULT = "digest binary, copies long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _measured(chunks: DataFrame, counts: DataFrame) -> DataFrame:
    """Measures of each distinct text, chunk by chunk."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        groups = right.column("grp").to_numpy()
        blobs = right.column("blob").to_pylist()
        said = np.concatenate([np.empty(0, np.int64), *(_take(blobs[i]) for i in np.argsort(groups))])
        for digests, shas, *packed in left.column("blobs").to_pylist():
            copies, per_text, place, times, *counts = map(_take, packed)
            ends = np.cumsum(per_text)
            found = said[place]
            best, total = (np.concatenate([[0], np.cumsum(x)]) for x in (times * (found & 1), times * (found >> 1)))
            measures = [*counts, best[ends] - best[ends - per_text], total[ends] - total[ends - per_text]]
            names = [shas[32 * i : 32 * i + 32].hex() if n else "" for i, n in enumerate(counts[0].tolist())]
            keys = [digests[32 * i : 32 * i + 32] for i in range(len(copies))]
            out.append(pa.table([pa.array(keys, pa.binary()), pa.array(copies), *map(pa.array, measures), pa.array(names)], names=_COLUMNS))
        return pa.concat_tables(out)

    return chunks.groupBy("chunk").cogroup(counts.groupBy("chunk")).applyInArrow(run, _RESULT)


def align_tokenizers(docs: DataFrame, byte_level: str, piece_model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row of ``docs``.

    A tokens are those of a blank and the text by the byte-level vocabulary in the
    file ``byte_level``, B tokens those of the text by ``piece_model``. Ends that
    both share cut them into groups; a link is a pair of overlapping tokens. A
    pair's count is the number of rows whose text links it. ``n_best`` counts the
    links whose count is the highest of their A id in the corpus, ``count_sum``
    adds the counts of all links. Null and empty texts, and texts whose tokens are
    not their bytes, have zeros and ''. Rows with equal texts or ids each get their
    row; other columns are not read. One text is tokenised as a whole in a task.

    Shuffled are the distinct texts, the chunks' packed links and pairs, and ids
    with digests. Chunks and their counts are tables in the scratch folder.
    """
    spark = docs.sparkSession
    files = []
    for path in (byte_level, piece_model):
        with open(path, "rb") as f:  # installed vocabularies on the driver, of some megabytes; tasks get them from the broadcast
            files.append(f.read())
    shipped = spark.sparkContext.broadcast(tuple(files))
    text = F.coalesce(F.col(text_col), F.lit(""))
    digest = F.unhex(F.sha2(text, 256)).alias("digest")
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    groups = max(16, size // GROUP)
    distinct = docs.groupBy(text.alias("text")).agg(F.count("*").alias("copies"))
    distinct = distinct.select("text", F.unhex(F.sha2("text", 256)).alias("digest"), "copies")
    chunks = cut_lineage(_chunks(distinct, shipped, groups), "aligned")
    counts = _counts(chunks.where("grp >= 0"))
    measures = cut_lineage(_measured(chunks.where("grp < 0"), counts), "measures")
    keyed = docs.select(F.col(id_col).alias("doc_id"), digest)
    return joined_by_text(keyed, measures).select("doc_id", *_MEASURES, "n_best", "count_sum", "groups_sha256")
