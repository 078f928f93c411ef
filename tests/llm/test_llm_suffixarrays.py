import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewire.llm import kernels, suffixarrays


def random_bytes(rnd):
    s = bytes(rnd.randint(97, 96 + rnd.randint(1, 4)) for _ in range(rnd.randint(0, 60)))
    return s * 3 if rnd.random() < 0.3 else s


def test_suffix_order_equals_sorting():
    rnd = random.Random(2)
    for _ in range(800):
        s = random_bytes(rnd)
        assert suffixarrays.suffix_order(s) == sorted(range(len(s)), key=lambda i: s[i:])
    long = b"ab" * 3000 + b"a" * 3000
    order = suffixarrays.suffix_order(long)
    assert all(long[i : i + 7000] < long[j : j + 7000] for i, j in zip(order[:200], order[1:201]))


def lyndon_prefix(s, i):
    return max((s[i:j] for j in range(i + 1, len(s) + 1) if all(s[i:j] < s[k:j] for k in range(i + 1, j))), key=len)


def test_groups_are_lyndon_prefixes_in_descending_order():
    rnd = random.Random(5)
    for _ in range(150):
        s = random_bytes(rnd)[:30]
        groups, previous = suffixarrays.lyndon_groups(s)
        words = [{lyndon_prefix(s, i) for i in g} for g in groups]
        assert all(len(w) == 1 for w in words)
        flat = [next(iter(w)) for w in words]
        assert flat == sorted(set(flat), reverse=True)
        rank = {i: k for k, g in enumerate(groups) for i in g}
        for i, p in enumerate(previous):
            assert p == max((j for j in range(i) if rank[j] > rank[i]), default=-1)


def named(least):
    return int(kernels.mix(np.array([least], np.uint64))[0])


def test_segments_cover_every_window_once(monkeypatch):
    rnd = random.Random(1)
    texts = [b"", b"abc", bytes(rnd.randint(97, 99) for _ in range(500)), b"a" * 49, b"a" * 50, b"", b"a" * 300, b"ab" * 200, b"x" * 51]
    for piece, size in ((4096, 1 << 19), (40, 200)):
        monkeypatch.setattr(suffixarrays, "PIECE", piece)
        monkeypatch.setattr(suffixarrays, "_SLICE", size)
        found = suffixarrays.Segments(texts)
        seen, names = defaultdict(list), {}
        for b, t, s, n, name in zip(*(x.tolist() for x in (found.bin, found.text, found.start, found.windows, found.name))):
            seen[t] += range(s, s + n)
            content = texts[t][s : s + n + 49]
            assert names.setdefault(name, content) == content
            grams = suffixarrays._gram_hashes(np.frombuffer(content, np.uint8), (suffixarrays.GRAM,))[0]
            assert all(b == named(grams[i : i + 27].min()) for i in range(n))
        for b, t, s, n, p in zip(*(x.tolist() for x in (found.bin, found.text, found.start, found.windows, found.place))):
            if p != suffixarrays.NOWHERE:
                gram = np.frombuffer(texts[t][s + p : s + p + suffixarrays.GRAM], np.uint8)
                assert n - 1 <= p and named(suffixarrays._gram_hashes(gram, (suffixarrays.GRAM,))[0][0]) == b
        assert len(names) == len(set(names.values()))
        assert all(sorted(seen[t]) == list(range(max(0, len(x) - 49))) for t, x in enumerate(texts))


def test_windows_of_a_bin_find_their_least_key():
    rnd = random.Random(12)
    make = lambda n: bytes(rnd.choice(b"abc") for _ in range(n))
    for _ in range(40):
        gram, left, right = make(24), make(26), make(26)
        contents, places = {}, []
        for _ in range(rnd.randint(2, 8)):
            a, b = rnd.randint(0, 26), rnd.randint(0, 26)
            own = make(26)[a:] + left[26 - a :] + gram + right[:b] + make(26)[b:]
            place = 26
            begin = rnd.randint(0, 26)
            content = own[begin : min(len(own), 26 + 50)]
            if len(content) >= 50 and content not in contents:
                contents[content] = rnd.randint(0, 5)
                places.append(place - begin)
        contents = {c: k for (c, k), p in zip(contents.items(), places) if len(c) - 50 <= p}
        places = [c.find(gram) if c.find(gram) >= len(c) - 50 else suffixarrays.NOWHERE for c in contents]
        want = defaultdict(lambda: 99)
        for c, k in contents.items():
            for i in range(len(c) - 49):
                want[c[i : i + 50]] = min(want[c[i : i + 50]], k)
        plain = {c: [want[c[i : i + 50]] for i in range(len(c) - 49)] for c in contents}
        assert suffixarrays.earlier_windows(contents, [suffixarrays.NOWHERE] * len(contents)) == plain
        if contents and all(c[p : p + 24] == gram for c, p in zip(contents, places) if p != suffixarrays.NOWHERE):
            assert suffixarrays.earlier_windows(contents, places) == plain


def plainly(rows):
    first = {}
    key = lambda i: -(1 << 63) if i is None else i
    data = [(i, (t or "").encode()) for i, t in rows]
    for i, t in data:
        for j in range(len(t) - 49):
            w = t[j : j + 50]
            first[w] = min(first.get(w, key(i)), key(i))
    out = []
    for i, t in data:
        gone = [False] * len(t)
        for j in range(len(t) - 49):
            if first[t[j : j + 50]] < key(i):
                gone[j : j + 50] = [True] * 50
        spans = sum(g and (j == 0 or not gone[j - 1]) for j, g in enumerate(gone))
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((i, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def passages():
    rnd = random.Random(9)
    letters = "abcdefghij klmné漢"
    make = lambda n: "".join(rnd.choice(letters) for _ in range(n))
    shared = [make(n) for n in (49, 50, 51, 80, 300)]
    out = []
    for i in range(150):
        parts = [make(rnd.randint(0, 120))]
        for _ in range(rnd.randint(0, 3)):
            s = rnd.choice(shared)
            a = rnd.randint(0, 10)
            parts += [s[a:], make(rnd.randint(0, 60))]
        out.append("".join(parts))
    out += out[:10] + [None, "", "short", "short", "a" * 49, "a" * 49, "a" * 50, "a" * 51, "a" * 50, "ab" * 400, "ba" * 300, make(30) * 12]
    out += [out[3]] * 30
    return out


def run(df):
    found = suffixarrays.remove_repeats(df, shape=lambda k: F.sha2(k, 256))
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), r.kept) for r in found.collect()), key=str)


@pytest.mark.parametrize(("bucket", "hot"), [(8 << 20, 2048), (6000, 2048), (3000, 2)])
def test_equals_a_table_of_all_strings(spark, monkeypatch, bucket, hot):
    monkeypatch.setattr(suffixarrays, "BUCKET", bucket)
    monkeypatch.setattr(suffixarrays, "HOT", hot)
    texts = passages()
    ids = list(range(len(texts)))
    random.Random(4).shuffle(ids)
    rows = list(zip(ids, texts)) + [(None, texts[0]), (7, texts[20]), (7, texts[21]), (7, texts[20]), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit("x")).withColumn("spans", F.lit(1))
    assert run(df.repartition(3)) == plainly(rows)


def test_kept_bytes_and_spans(spark):
    a, b = "".join(map(chr, range(192, 252))), "0123456789" * 5
    rows = [(1, a), (2, "x" + a[:30] + "y"), (3, "w" + a + b), (4, b + "z")]
    got = {r.doc_id: r for r in suffixarrays.remove_repeats(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    assert got[2].spans[0].start == 1 and got[2].spans[0].end == 61 and bytes(got[2].kept) == b"xy"
    assert bytes(got[3].kept) == b"w" + b.encode() and bytes(got[4].kept) == b"z" and got[1].spans == []


def test_empty_table_and_long_text(spark):
    df = spark.createDataFrame([(1, "ab" * 300_000), (2, "ba" * 100)], "doc_id long, text string")
    assert run(df.where("false")) == []
    assert [r[2] for r in run(df)] == [0, 200]


def test_groups_are_even():
    rnd = np.random.default_rng(0)
    found = suffixarrays.Segments([bytes(rnd.integers(97, 123, 200_000).astype(np.uint8))])
    sizes = np.bincount(suffixarrays._group_of(suffixarrays._short(found.bin), 16), minlength=16)
    assert len(sizes) == 16 and sizes.max() < 1.3 * sizes.mean()


def test_texts_are_shuffled_once(spark, sf_dir):
    """The three passes over the buckets read one exchange of the texts."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = suffixarrays.cleaned_texts(docs.select(F.col("doc_id").alias("key"), F.unhex(F.md5("text")).alias("digest"), "text"), 4, 8)
    assert found.count() == docs.select("text").distinct().count()
    plan = found._jdf.queryExecution().executedPlan().toString()
    found.collect()
    final = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("ReusedExchange") >= 2 and plan.count("FlatMapCoGroupsInArrow") >= 2
