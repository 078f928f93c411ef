import hashlib
import os
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidewire.llm import alignment, queries

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")


@pytest.fixture(scope="module")
def aligner():
    with open(queries.BYTE_LEVEL, "rb") as a, open(queries.WORD_PIECES, "rb") as b:
        return alignment.Aligner(a.read(), b.read())


def spans(ids, table):
    at, out = 0, []
    for i in ids:
        out.append((at, at + len(table[i]), i))
        at += len(table[i])
    return out


def plainly(aligner, texts):
    """Measures of every text by comparing all A tokens with all B tokens."""
    tokens = [aligner.encode([t])[0] for t in texts]
    linked, groups = [], []
    for a, b in tokens:
        sa, sb = spans(a, aligner.bytes_a), spans(b, aligner.bytes_b)
        linked.append([(x[2], y[2]) for x in sa for y in sb if x[0] < y[1] and y[0] < x[1]])
        shared = sorted({x[1] for x in sa} & {y[1] for y in sb})
        parts, low = [], 0
        for end in shared:
            inside = [",".join(str(t[2]) for t in s if low < t[1] <= end) for s in (sa, sb)]
            parts.append("|".join(inside))
            low = end
        groups.append(parts)
    count = Counter(p for pairs in linked for p in set(pairs))
    top = defaultdict(int)
    for (a, _), n in count.items():
        top[a] = max(top[a], n)
    out = []
    for (a, b), pairs, parts in zip(tokens, linked, groups):
        sha = hashlib.sha256(";".join(parts).encode()).hexdigest() if parts else ""
        best = sum(count[p] == top[p[0]] for p in pairs)
        out.append((len(a), len(b), len(parts), len(pairs), best, sum(count[p] for p in pairs), sha))
    return out


def odd_texts():
    rnd = random.Random(8)
    words = "the stone of a river unbelievable São 漢字 naïve 🙂 1234 <|endoftext|> </s> <0x41> \x00 \t  \n ▁ ﬁ".split(" ")
    out = [" ".join(rnd.choice(words) for _ in range(rnd.randint(0, 30))) for _ in range(120)]
    return out + ["", None, " ", "  lead", "trail  ", "a" * 400, "\n\n", "x" * 2000 + " y"] + ["copied text here"] * 60 + ["the stone"] * 3


def test_equals_all_pairs_of_tokens(spark, aligner, monkeypatch):
    texts = odd_texts()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("n_a", F.lit("x")).withColumn("digest", F.lit(1))
    want = plainly(aligner, [t or "" for t in texts])
    got = {r.doc_id: tuple(r)[1:] for r in alignment.align_tokenizers(df.repartition(3), queries.BYTE_LEVEL, queries.WORD_PIECES).collect()}
    assert len(got) == len(texts)
    assert [got[i] for i in range(len(texts))] == want
    assert any(w[0] and w[2] < w[0] for w in want)  # groups of several tokens occur


def test_bytes_that_differ_leave_no_tokens(spark, aligner):
    assert aligner.encode([""]) == [([], [])]
    a, b = aligner.encode(["plain"])[0]
    assert b"".join(aligner.bytes_a[i] for i in a) == b"".join(aligner.bytes_b[i] for i in b) == b" plain"
    strange = [t for t in ("▁", "a▁b", "\x00") if aligner.encode([t]) == [([], [])]]
    assert "▁" in strange  # B's pieces give a blank for it


def test_elements_give_what_whole_texts_give(aligner):
    """Both libraries on whole texts, against the dictionary of elements."""
    rnd = random.Random(3)
    letters = list("ab  \n\t.,'sé漢\u00a0\u2003\u3000\x1c\x85▁1🙂\x00")
    texts = [t or "" for t in odd_texts()] + ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 30))) for _ in range(3000)]
    texts += [" ", "  ", "x ", "x  ", "\n ", " \n", "\n  \n x"]
    whole = alignment.Links(aligner, aligner.encode(texts))
    assert all("".join(aligner.elements(t)) == " " + t for t in texts)
    known = alignment.Dictionary(aligner)
    for texts_at in (slice(0, 1500), slice(1500, None)):
        got = alignment.Aligned(known, texts[texts_at])
        k = len(texts[texts_at])
        assert got.counts.tolist() == whole.counts[texts_at].tolist()
        assert got.digests == [hashlib.sha256(g).digest() if g else b"" for g in whole.groups[texts_at]]
        inside = (whole.entry >= (texts_at.start or 0)) & (whole.entry < (texts_at.start or 0) + k)
        want = Counter(zip((whole.entry[inside] - (texts_at.start or 0)).tolist(), whole.pair[inside].tolist()))
        assert want == Counter({(t, p): n for t, p, n in zip(got.text.tolist(), got.pair.tolist(), got.times.tolist())})


def test_a_dictionary_that_is_dropped_gives_the_same(aligner, monkeypatch):
    texts = [t or "" for t in odd_texts()]
    want = alignment.Aligned(alignment.Dictionary(aligner), texts)
    monkeypatch.setattr(alignment, "DICTIONARY", 10)
    known = alignment.Dictionary(aligner)
    alignment.Aligned(known, texts[:50])
    got = alignment.Aligned(known, texts)
    assert (got.counts == want.counts).all() and got.digests == want.digests and (got.pair == want.pair).all()


def test_rows_of_any_width_return():
    import numpy as np

    rnd = np.random.default_rng(1)
    for top in (1, 255, 256, 70_000, 1 << 40):
        x = rnd.integers(0, top, 50)
        assert alignment._take(alignment._put(x)).tolist() == x.tolist()
    assert alignment._take(alignment._put(np.empty(0, np.int64))).tolist() == []


def test_empty_tables_repeated_rows_and_null_ids(spark):
    df = spark.createDataFrame([(1, "one two"), (1, "one two"), (None, "one two"), (None, None)], "doc_id int, text string")
    args = (queries.BYTE_LEVEL, queries.WORD_PIECES)
    rows = alignment.align_tokenizers(df, *args).collect()
    assert sorted((r.doc_id or 0, r.n_a, r.count_sum) for r in rows) == [(0, 0, 0), (0, 2, 6), (1, 2, 6), (1, 2, 6)]
    assert alignment.align_tokenizers(df.where("false"), *args).count() == 0
