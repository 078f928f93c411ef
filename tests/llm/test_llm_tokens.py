import base64
import hashlib
import random

import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

from tidewire.llm import bpe, queries, wordpiece


def test_rank_queue_orders_by_rank_then_place():
    rnd = random.Random(0)
    queue, left = bpe.RankQueue(), []
    for _ in range(3000):
        if left and rnd.random() < 0.45:
            left.sort()
            assert queue.pop() == left.pop(0)
        else:
            entry = (rnd.choice([rnd.randrange(50_000), 7]), rnd.randrange(1000))
            queue.push(*entry)
            left.append(entry)
    for entry in sorted(left):
        assert queue.pop() == entry
    assert queue.pop() is None


def reference():
    with open(queries.BYTE_RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_texts():
    rnd = random.Random(4)
    alphabet = "abcdefgh  \n\t'sdé漢字🙂\x1c\x85\u00a0\u200b0123Ⅷ.,!?\u0301"
    out = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 80))) for _ in range(300)]
    out += [None, "", " ", "<|endoftext|>", "a" * 3000, "".join(rnd.choice("ab") for _ in range(4000)), "I'll we've\r\n  x"]
    return out


def test_ids_and_bytes_match_the_public_encoder(spark):
    rows = [(i, t, 9) for i, t in enumerate(token_texts())]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int").select("doc_id", "text")
    got = {r["doc_id"]: r for r in queries.token_digests(df).collect()}
    known = reference()
    for i, t, _ in rows:
        ids = known.encode_ordinary(t or "")
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256((t or "").encode()).hexdigest()


def test_one_pass_gives_what_two_give(spark):
    tokenizer = bpe.Tokenizer(spark, queries.BYTE_RANKS, public_tokenizers.PATTERN)
    rows = [(i, t, 9, "x") for i, t in enumerate(token_texts())]
    df = spark.createDataFrame(rows, "doc_id long, text string, bytes int, ids string")
    once = tokenizer.round_trip(df)
    assert once.columns == ["doc_id", "ids", "bytes"]
    assert once._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    two = tokenizer.decode(tokenizer.encode(df.select("doc_id", "text")))
    key = lambda r: r["doc_id"]
    assert [(r["ids"], bytes(r["bytes"])) for r in sorted(once.collect(), key=key)] == [(r["ids"], bytes(r["bytes"])) for r in sorted(two.collect(), key=key)]
    assert tokenizer.round_trip(df.where("false")).count() == 0


def test_ranks_beyond_the_bitmap_are_refused():
    import pytest

    line = base64.b64encode(b"a") + b" 65536"
    with pytest.raises(ValueError, match="65536"):
        bpe.read_ranks(line)


def test_other_columns_stay_and_empty_tables_work(spark):
    tokenizer = bpe.Tokenizer(spark, queries.BYTE_RANKS, public_tokenizers.PATTERN)
    df = spark.createDataFrame([(1, "a b", "x"), (1, "a b", "x"), (None, None, None)], "doc_id long, text string, ids string")
    out = tokenizer.decode(tokenizer.encode(df))
    assert sorted(out.columns) == ["bytes", "doc_id", "ids"]
    assert sorted((r["doc_id"] or 0, bytes(r["bytes"]), len(r["ids"])) for r in out.collect()) == [(0, b"", 0), (1, b"a b", 2), (1, b"a b", 2)]
    assert tokenizer.decode(tokenizer.encode(df.where("false"))).count() == 0


def brute(word, starting, inner):
    i = n = 0
    while i < len(word):
        known = starting if i == 0 else inner
        j = next((j for j in range(len(word), i, -1) if word[i:j] in known), None)
        if j is None:
            return -1
        i, n = j, n + 1
    return n


def test_longest_match_equals_brute_force():
    rnd = random.Random(1)
    draw = lambda k: {"".join(rnd.choice("ab") for _ in range(rnd.randint(1, 4))) for _ in range(k)}
    for _ in range(200):
        starting, inner = draw(5), draw(4)
        automaton = wordpiece.LongestMatch(starting, inner)
        for _ in range(50):
            word = "".join(rnd.choice("abc") for _ in range(rnd.randint(1, 12)))
            assert automaton.count(word) == brute(word, starting, inner), (starting, inner, word)


def test_counts_of_texts(spark):
    rows = [(1, "abc, ab!", 0), (2, None, 0), (3, "", 0), (4, "zz abz", 0), (4, "zz abz", 0), (None, "ab" * 5000, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    pieces = (["a", "ab", ",", "!"], ["b", "c", "ab"])
    got = sorted(wordpiece.count_tokens(df, pieces).collect(), key=lambda r: r["doc_id"] or 0)
    # abc = ab + c; zz is unknown; abz fails at its last letter
    assert [tuple(r) for r in got] == [(None, 1, 5000, 0), (1, 4, 5, 0), (2, 0, 0, 0), (3, 0, 0, 0), (4, 2, 2, 2), (4, 2, 2, 2)]
    assert wordpiece.count_tokens(df.where("false"), pieces).count() == 0


def test_vocabulary_spells_the_tables_words(spark, sf_dir):
    out = queries.op2_longest_match(spark, sf_dir)
    assert out.agg(F.sum("n_unknown")).first()[0] == 0
