import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewire.llm import fingerprints, kernels, mixing, suffixes, weighted

# ------------------------------------------------------------------ hashes


def test_window_hashes_tell_windows_apart():
    words = [str(x).encode() for x in np.random.RandomState(1).randint(0, 3, 400)]
    parts = [words[:150], [], words[150:]]
    h, text, start, end = kernels.word_hashes([b" \t".join(p) for p in parts])
    assert len(h) == 400 and set(text) == {0, 2}
    for size in (1, 2, 5, 7, 20):
        got, at = kernels.window_hashes(h, text, size)
        sequences = [tuple(words[i : i + size]) for i in at]
        assert len(at) == 150 + 250 - 2 * size + 2
        assert len(set(zip(sequences, got.tolist()))) == len(set(sequences)) == len(set(got.tolist()))


# ------------------------------------------------------------------ repeated passages


def brute_repeats(rows, window=20):
    seen, out = {}, {}
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    for doc, text in rows:
        words = (text or "").encode().split()
        for i in range(len(words) - window + 1):
            key = tuple(words[i : i + window])
            seen.setdefault(key, (doc, i))
    for doc, text in rows:
        words = (text or "").encode().split()
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            if seen[tuple(words[i : i + window])] != (doc, i):
                gone[i : i + window] = [True] * window
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        out.setdefault(doc, []).append((len(words), sum(gone), kept.decode()))
    return out


def passages():
    rnd = random.Random(7)
    word = lambda: "".join(rnd.choice("abcdeé") for _ in range(rnd.randint(1, 5)))
    hot = [word() for _ in range(60)]
    rows = []
    for i in range(300):
        words = [word() for _ in range(rnd.randint(0, 90))]
        if i % 3 == 0:
            at = rnd.randint(0, len(words))
            words[at:at] = hot[rnd.randint(0, 20) :]
        rows.append((i, rnd.choice([" ", "\n", "\t "]).join(words)))
    rows += [(400 + i, rows[i][1]) for i in range(0, 300, 7)]
    rows += [(900, "x " * 200), (901, "x " * 25), (902, None), (903, ""), (None, " ".join(hot)), (904, "x " * 19), (905, "x " * 25), (905, "x " * 25)]
    return rows


@pytest.mark.parametrize("group", [50, 400_000])
def test_removal_matches_brute_force(spark, group):
    rows = passages()
    df = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, kept int").repartition(5, "text")
    got = {}
    for r in suffixes.remove_repeats(df, group=group).collect():
        got.setdefault(r["doc_id"], []).append((r["n_words"], r["n_removed"], r["kept"]))
        assert r["n_removed"] == sum(s["end"] - s["start"] for s in r["spans"])
    assert got == brute_repeats(rows)


def test_removal_of_nothing(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert suffixes.remove_repeats(df).count() == 0
    df = spark.createDataFrame([(1, None), (2, "a b")], "doc_id long, text string")
    assert sorted(r["kept"] for r in suffixes.remove_repeats(df).collect()) == ["", "a b"]


def test_groups_hold_their_bound():
    counts = [0, 5, 1000, 30, 30, 30, 2, 99]
    plan = suffixes.partition(counts, 100)
    prefix = np.repeat(np.arange(8), counts)
    names = kernels.mix(np.arange(len(prefix), dtype=np.uint64))
    sizes = np.bincount(plan.group_of(prefix, names), minlength=plan.groups)
    assert len(sizes) == plan.groups and sizes.max() <= 150


# ------------------------------------------------------------------ near duplicates


def shingles(text):
    w = (text or "").split()
    if len(w) < 5:
        return Counter([tuple(w)]) if w else Counter()
    return Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))


def similarity(a, b, share):
    idf = lambda s: np.log(1 + 1 / max(share[s], weighted.COMMON))
    both = sum(n * idf(s) for s, n in (a & b).items())
    return both / sum(n * idf(s) for s, n in (a | b).items()) if a or b else 0.0


def near_texts():
    rnd = random.Random(11)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(6))
    line = [word() for _ in range(15)]  # in every third text
    out = []
    for g in range(25):
        base = [word() for _ in range(rnd.randint(40, 150))]
        for _ in range(rnd.randint(1, 6)):
            copy = list(base)
            for _ in range(rnd.randint(0, 4)):
                copy[rnd.randrange(len(copy))] = word()
            out.append(" ".join(copy + (line if rnd.random() < 0.3 else [])))
    base = [word() for _ in range(120)]
    for _ in range(330):  # a group larger than what is compared in full
        copy = list(base)
        copy[rnd.randrange(len(copy))] = word()
        copy[rnd.randrange(len(copy))] = word()
        out.append(" ".join(copy))
    return out + [out[0], out[0], None, "", " ", "a b", "a  b", "a b"]


def grouped(n, pairs):
    root = list(range(n))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in pairs:
        root[max(top(a), top(b))] = min(top(a), top(b))
    return [top(i) for i in range(n)]


@pytest.mark.parametrize("block", [(16, 32), (4096, 8192)])
def test_large_buckets_lose_no_link(spark, monkeypatch, block):
    for name, value in {"SMALL": 20, "PIVOTS": 2, "OTHERS": block[0], "MEMBERS": block[1], "TOGETHER": 5}.items():
        monkeypatch.setattr(weighted, name, value)
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(6))
    base, texts = [word() for _ in range(150)], []
    for _ in range(160):  # edits cost about 5 of some 146 shingles each: two texts are 0.7 to 0.9 alike
        copy = list(base)
        for _ in range(rnd.randint(1, 3)):
            copy[rnd.randrange(len(copy))] = word()
        texts.append(" ".join(copy))
    sets = [shingles(t) for t in texts]
    share = Counter(s for c in sets for s in c)
    share = {s: n / len(texts) for s, n in share.items()}
    near = {(i, j): similarity(sets[i], sets[j], share) for i in range(160) for j in range(i)}
    assert sum(0.75 < x < 0.85 for x in near.values()) > 1500
    sig = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    common = weighted.common_shingles(sig)
    rows = weighted.signatures(sig, common).select(
        F.explode("keys").alias("key"), "doc_id", F.col("doc_id").alias("node"), F.col("doc_id").alias("cls"), "sig", F.col("keys").alias("bands")
    ).cache()
    signs = {r["doc_id"]: np.frombuffer(r["sig"], np.uint8) for r in rows.select("doc_id", "sig").distinct().collect()}
    met = {}
    for r in rows.collect():
        met.setdefault(r["key"], set()).add(r["doc_id"])
    assert max(map(len, met.values())) > 20
    # Every pair of a bucket that agrees often enough is verified, in one bucket, however large the bucket.
    want = {(a, b) for m in met.values() for a in m for b in m if a < b and (signs[a] == signs[b]).sum() >= weighted.MAYBE}
    in_key = {}
    for key in sorted(met, reverse=True):
        in_key |= {(a, b): key for a in met[key] for b in met[key] if (a, b) in want}
    still = weighted.open_members(weighted.mixed_buckets(rows)).cache()
    assert {(r["key"], r["node"]) for r in still.collect()} == {(key, x) for pair, key in in_key.items() for x in pair}
    _, shingle, count = zip(*(weighted.shingle_sets([t.encode()]) for t in texts))
    words = spark.createDataFrame([(i, len(s), weighted._packed(s, c)) for i, (s, c) in enumerate(zip(shingle, count))], "node long, size int, words binary")
    for i in (0, 77):
        s, x = weighted._weighted(weighted._packed(shingle[i], count[i]), len(shingle[i]), weighted.Weights(common))
        assert (s == shingle[i]).all() and np.allclose(x, weighted.Weights(common).of(shingle[i], count[i]))
    twice = weighted._packed(shingle[0], count[0] * 2)
    assert np.allclose(weighted._weighted(twice, len(shingle[0]), weighted.Weights({}))[1], 2 * weighted.Weights({}).of(shingle[0], count[0]))
    # Classes: what the links join is what all pairs that are verified would join.
    found = weighted._bucket_links(weighted.mixed_buckets(rows.join(still, ["key", "node"])).join(words, "node"), common, 0.8).collect()
    assert all(abs(near[b, a] - s) < 1e-6 and s >= 0.8 - 1e-9 for a, b, s in found)
    assert grouped(160, [(a, b) for a, b, _ in found]) == grouped(160, [(a, b) for a, b in want if near[b, a] >= 0.8 - 1e-9])
    assert len(found) <= 160 * len(met)


def test_settled_members_still_meet_each_other(spark, monkeypatch):
    """Two texts linked to each other but only near the others of their buckets, whatever the pivots are."""
    for name, value in {"SMALL": 4, "PIVOTS": 2}.items():
        monkeypatch.setattr(weighted, name, value)
    rnd = random.Random(23)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(6))
    common, texts = [word() for _ in range(160)], []
    for _ in range(30):  # pairs: 0.75 alike between them, 0.9 within
        own = [word() for _ in range(26)]
        for _ in range(2):
            texts.append(" ".join(common + own + [word() for _ in range(4)]))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = [shingles(t) for t in texts]
    share = Counter(s for c in sets for s in c)
    share = {s: n / len(texts) for s, n in share.items()}
    near = {(i, j): similarity(sets[i], sets[j], share) for i in range(60) for j in range(i)}
    assert {p for p, x in near.items() if x >= 0.8} == {(i + 1, i) for i in range(0, 60, 2)}
    assert sum(x > 0.5 for x in near.values()) > 1700
    got = {r["doc_id"]: (r["class_id"], r["n_in_class"]) for r in weighted.near_duplicates(df)[0].collect()}
    assert got == {i: (i - i % 2, 2) for i in range(60)}


def test_classes_match_brute_force(spark):
    rows = list(enumerate(near_texts()))
    df = spark.createDataFrame([(i, t, 5) for i, t in rows], "doc_id long, text string, class_id int").repartition(4, "doc_id")
    got = {r["doc_id"]: r for r in weighted.near_duplicates(df)[0].collect()}
    sets = {i: shingles(t) for i, t in rows}
    share = Counter(s for c in sets.values() for s in c)
    share = {s: n / len(rows) for s, n in share.items()}
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, t in rows:
        for j in range(i):
            same = (t or "") == (rows[j][1] or "")
            if same or similarity(sets[i], sets[j], share) >= 0.8:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    expected = {i: find(i) for i, _ in rows}
    size = Counter(expected.values())
    assert {i: (r["class_id"], r["n_in_class"]) for i, r in got.items()} == {i: (c, size[c]) for i, c in expected.items()}
    kept = weighted.keep_one_each(df)
    assert kept.columns == df.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted(set(expected.values()))


def test_null_ids_and_repeated_rows(spark):
    text = " ".join(map(str, range(50)))
    rows = [(None, text), (None, text), (7, text + " 50"), (7, text + " 50"), (None, "other words than those of the rest here"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((r["doc_id"], r["class_id"], r["n_in_class"]) for r in weighted.near_duplicates(df)[0].collect())
    assert got == Counter({(None, 7, 4): 2, (7, 7, 4): 2, (None, None, 1): 2})
    assert Counter((r["doc_id"], r["text"]) for r in weighted.keep_one_each(df).collect()) == Counter([(7, text + " 50"), (None, rows[4][1]), (None, None)])
    assert weighted.near_duplicates(df.where("false"))[0].count() == 0


def test_samples_agree_as_often_as_weights_overlap():
    rnd = np.random.RandomState(3)
    agree, near = 0, []
    for trial in range(60):
        ids = kernels.mix(np.arange(200, dtype=np.uint64) + np.uint64(1000 * trial)) >> np.uint64(16)
        a, b = rnd.uniform(0.5, 3, 200), rnd.uniform(0.5, 3, 200)
        near.append(np.minimum(a, b).sum() / np.maximum(a, b).sum())
        owner = np.repeat([0, 1], 200)
        order = np.argsort(ids)
        got = weighted.consistent_samples(owner, np.concatenate([ids[order]] * 2), np.concatenate([a[order], b[order]]))
        agree += (got[0] == got[1]).sum()
    assert abs(agree / (60 * weighted.SAMPLES) - np.mean(near)) < 0.04


# ------------------------------------------------------------------ fingerprints


def brute_edits(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    out = []
    for i, (doc, text) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        k = len(text) // 4
        out.append((doc, len(text), hashlib.sha256((text[: len(text) - k] + after[:k]).encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("ranges", [1, 7, 64])
def test_edits_and_digests(spark, ranges):
    rnd = random.Random(3)
    rows = [(i * 3, "".join(rnd.choice("abc dé🙂\n") for _ in range(rnd.choice([0, 1, 3, 50, 900, 6000])))) for i in range(120)]
    rows += [(None, "x" * 40), (1000, None), (1001, rows[5][1])]
    df = spark.createDataFrame([(d, t, "z") for d, t in rows], "doc_id long, text string, h string").repartition(3, "text")
    got = fingerprints.edited_fingerprints(df, ranges).collect()
    assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got), key=str) == brute_edits(rows)
    by = {r["doc_id"]: r for r in got}
    assert by[1001]["fingerprint"] == by[15]["fingerprint"] and all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    plain = {r["doc_id"]: r["fingerprint"] for r in fingerprints.fingerprint_documents(df).collect()}
    assert plain == {d: r["fingerprint"] for d, r in by.items()}


def test_repeated_rows_and_a_single_row(spark):
    df = spark.createDataFrame([(1, "abcdefgh")] * 5 + [(2, "12345678")], "doc_id long, text string")
    got = Counter((r["doc_id"], r["near_next"] == 1.0) for r in fingerprints.edited_fingerprints(df, 4).collect())
    assert sum(got.values()) == 6 and got[(1, True)] == 4
    one = fingerprints.edited_fingerprints(df.where("doc_id = 2"), 4).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0 and one[0]["edited_sha256"] == hashlib.sha256(b"12345612").hexdigest()
    assert fingerprints.edited_fingerprints(df.where("false"), 4).count() == 0


def test_likeness_tells_edits_from_other_texts():
    rnd = random.Random(9)
    word = lambda: "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6))
    a, b = (" ".join(word() for _ in range(400)) for _ in range(2))
    digests = fingerprints.Digests([t.encode() for t in (a, a, a[:2000] + b[2000:2300] + a[2300:], b)])
    first = digests.take([0, 0, 0])
    same, edited, other = fingerprints.likeness(first, digests.take([1, 2, 3]))
    assert same == 1.0 and edited > 0.8 and other < 0.5


# ------------------------------------------------------------------ mixing


def test_shortage_goes_to_siblings_before_ancestors(spark):
    # web/en/a has 10 words of the 60 it should get; b takes what is missing, and the forum its own share only.
    leaves = spark.createDataFrame(
        [("web", "en", "a", 10), ("web", "en", "b", 1000), ("forum", "en", "c", 1000), ("web", "de", "z", 50)],
        "domain string, lang string, source string, tokens long",
    )
    weights = {"domain": {"web": 2, "forum": 1}, "lang": {"en": 2, "de": 1}, "source": {"a": 3, "b": 1}}
    got = {r["source"]: r["alloc"] for r in mixing.budgets(leaves, 180, weights, 1).collect()}
    assert got == {"a": 10, "b": 70, "z": 40, "c": 60}
    got = {r["source"]: r["alloc"] for r in mixing.budgets(leaves, 2400, weights, 1).collect()}
    assert got == {"a": 10, "b": 1000, "z": 50, "c": 1000}  # all there is
    got = {r["source"]: r["alloc"] for r in mixing.budgets(leaves, 180, {"domain": {"forum": 0}}, 1).collect()}
    assert got["c"] == 0


def test_prefixes_of_epochs(spark):
    rows = [(i, "w " * (i % 7), "en", f"s{i % 2}") for i in range(400)] + [(None, "a b", None, None), (None, "a b", None, None), (9, None, "en", "s1"), (9, None, "en", "s1")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("copies", F.lit("x"))
    weights = {"source": {"s0": 9}}
    mixed = mixing.mix_documents(df, weights, max_epochs=3, domain=F.lit("all")).collect()
    for leaf in {(r["lang"], r["source"]) for r in mixed}:
        here = [r for r in mixed if (r["lang"], r["source"]) == leaf]
        assert max(r["copies"] for r in here) - min(r["copies"] for r in here) <= 1
        if leaf[1] == "s0":
            supply = sum(r["n_tokens"] for r in here)
            assert 1.0 < sum(r["n_tokens"] * r["copies"] for r in here) / supply <= 3
    wanted = {r["item"]: r["copies"] for r in mixed}
    out = mixing.mixed_rows(df, weights, max_epochs=3, domain=F.lit("all"))
    assert out.columns == df.columns
    found = Counter(r["doc_id"] for r in out.collect())
    assert all(found[i] == wanted[str(i)] * (3 if i == 9 else 1) for i in range(400))
    assert mixing.mix_documents(df.where("false"), weights, domain=F.lit("all")).count() == 0
