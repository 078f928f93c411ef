"""Word-piece token counts by a longest-match automaton."""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

WORD = r"\w+|[^\w\s]"  # a run of letters, digits and underscores, or one other visible character
CACHED_WORDS = 300_000
CACHED_CHARS = 48
_ROOT, _INNER = 0, 1  # where a word starts, and where it goes on after a piece
_UNKNOWN = 1 << 40


class LongestMatch:
    """Counts the pieces of greedy longest-match without making them.

    Two tries, of pieces that start a word and of pieces that continue one.
    Reading on from a node that lacks the character, the longest pieces that end
    what has been read are popped: ``fail`` is the node of what remains then,
    ``pops`` how many pieces were popped. Both are computed once, level by level,
    so a word takes time in proportion to its length.
    """

    def __init__(self, starting: set[str], inner: set[str]):
        self.child: list[dict[str, int]] = [{}, {}]
        ends = [False, False]
        for root, pieces in ((_ROOT, starting), (_INNER, inner)):
            for piece in pieces:
                node = root
                for c in piece:
                    node = self.child[node].setdefault(c, len(self.child))
                    if node == len(self.child):
                        self.child.append({})
                        ends.append(False)
                ends[node] = bool(piece) or ends[node]
        self.fail, self.pops = [-1] * len(self.child), [0] * len(self.child)
        queue = deque([_ROOT, _INNER])
        while queue:
            node = queue.popleft()
            for c, below in self.child[node].items():
                queue.append(below)
                if ends[below]:
                    self.fail[below], self.pops[below] = _INNER, 1
                    continue
                at, popped = self.fail[node], self.pops[node]
                while at >= 0 and c not in self.child[at]:
                    popped += self.pops[at]
                    at = self.fail[at]
                if at >= 0:
                    self.fail[below], self.pops[below] = self.child[at][c], popped

    def count(self, word: str) -> int:
        """Number of pieces, or -1 if the pieces can't spell the word."""
        child, fail, pops = self.child, self.fail, self.pops
        node = n = 0
        for c in word:
            below = child[node].get(c)
            while below is None:
                n += pops[node]
                node = fail[node]
                if node < 0:
                    return -1
                below = child[node].get(c)
            node = below
        while node > _INNER:
            n += pops[node]
            node = fail[node]
            if node < 0:
                return -1
        return n


class Counter(dict):
    """Pieces of a word, remembered; an unknown word counts as one piece and is marked."""

    def __init__(self, automaton: LongestMatch):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: str) -> int:
        n = self.automaton.count(word)
        n = n if n >= 0 else _UNKNOWN + 1
        if len(word) <= CACHED_CHARS:
            if len(self) >= CACHED_WORDS:
                self.clear()
            self[word] = n
        return n


def vocabulary(path: str) -> tuple[list[str], list[str]]:
    """(pieces that start a word, pieces that continue one) of a sentence-piece model file.

    A piece with the word mark starts a word, without it continues one; single
    characters do both. Control and byte pieces are left out.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [
        model.id_to_piece(i)
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]
    mark = "▁"
    starting = {p[1:] for p in pieces if p.startswith(mark) and len(p) > 1}
    inner = {p for p in pieces if mark not in p}
    return sorted(starting | {p for p in inner if len(p) == 1}), sorted(inner)


_MADE: dict[int, Counter] = {}  # per Python worker


def count_tokens(docs: DataFrame, pieces: tuple[list[str], list[str]], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_tokens, n_unknown) of every whole text, row by row.

    Null and empty texts count 0. The vocabulary is broadcast; its file bounds the
    size. Each task keeps the counts of a bounded number of words.
    """
    spark = docs.sparkSession
    shipped = spark.sparkContext.broadcast(pieces)
    key = hash(tuple(map(tuple, pieces)))
    schema = T.StructType(
        [T.StructField("doc_id", docs.schema[id_col].dataType)]
        + [T.StructField(c, T.LongType(), False) for c in ("n_words", "n_tokens", "n_unknown")]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _MADE:
            starting, inner = shipped.value
            _MADE[key] = Counter(LongestMatch(set(starting), set(inner)))
        pieces_of, split = _MADE[key].__getitem__, re.compile(WORD).findall
        for batch in batches:
            words_n, total = [], []
            for text in batch.column(1):
                words = split(text.as_py() or "")
                words_n.append(len(words))
                total.append(sum(map(pieces_of, words)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(words_n, pa.int64()),
                    pa.array([t % _UNKNOWN for t in total], pa.int64()), pa.array([t // _UNKNOWN for t in total], pa.int64()),
                ],
                names=["doc_id", "n_words", "n_tokens", "n_unknown"],
            )

    return docs.select(id_col, text_col).mapInArrow(run, schema)
