import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewire.functions import lexicons as lx
from tidewire.functions import text as t
from tidewire.operators import terms

LISTS = {**lx.ECONOMIC_INDICATORS, "zones": list(lx.CONFLICT_ZONES), "words": list(lx.CONFLICT_KEYWORDS), **{f"watch {k}": v for k, v in lx.WATCHLIST.items()}}


def articles(make_articles):
    rnd = random.Random(4)
    every = [k for words in LISTS.values() for k in words]
    filler = ["plain", "The", "said", "Ukraine", "naïve", "xGDPx", "in-flation", "x" * 300, "q"]
    rows = [{"title": rnd.choice(filler), "content": rnd.choice([" ", "\n", "  "]).join(rnd.choice(filler + [rnd.choice(every).upper(), rnd.choice(every)]) for _ in range(rnd.randint(0, 25)))} for _ in range(120)]
    return make_articles(*rows, {"title": None, "content": None}, {"title": "gdp", "content": ""}, {"title": "a", "content": "b" * 5000 + "inflation" + "c" * 5000})


@pytest.mark.parametrize("match", ["substring", "word"])
@pytest.mark.parametrize("shipped", [500_000, 0])
def test_equals_the_unrolled_search(make_articles, monkeypatch, match, shipped):
    monkeypatch.setattr(terms, "SHIPPED_TERMS", shipped)
    df = articles(make_articles)
    got = {(r.event_id, r.label): list(r.matched) for r in terms.terms_by_label(terms.find_terms(df, LISTS, match=match)).collect()}
    low = F.lower(t.title_and_content())
    want = df.select("event_id", *[t.mentioned(low, words, match).alias(label) for label, words in LISTS.items()]).collect()
    want = {(r.event_id, label): r[label] for r in want for label in LISTS if r[label]}
    assert got == want and len(want) > 100


def test_ten_thousand_terms_do_not_grow_the_plan(make_articles):
    rnd = random.Random(1)
    words = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(1, 9))) for _ in range(400)]
    many = [" ".join(rnd.choice(words) for _ in range(rnd.randint(1, 3))) for _ in range(10_000)]
    df = make_articles(*[{"content": " ".join(rnd.choice(words) for _ in range(30))} for _ in range(40)])
    found = terms.find_terms(df, {"many": many})

    def nodes(out):
        return len(out._jdf.queryExecution().optimizedPlan().toString().splitlines())

    assert nodes(found) == nodes(terms.find_terms(df, {"few": ["ab c", "d", "efg"]}))
    texts = {r.event_id: f" {r.content}".lower() for r in df.collect()}
    assert {(r.event_id, r.pos) for r in found.collect()} == {(i, p) for i, x in texts.items() for p, k in enumerate(many, 1) if k in x}


def test_anchors_are_pieces_of_their_terms():
    assert terms.pieces_of("Oil  of UK") == ["oil", "of", "uk"] and terms.pieces_of("abcdef") == ["abcde", "bcdef"]
    assert terms.anchor_of("the strait", terms.Counter({"strai": 5})) == "trait"
    assert terms.anchor_of(" \n", terms.Counter()) is None


def test_blank_terms_are_refused(make_articles):
    with pytest.raises(ValueError, match="white space"):
        terms.find_terms(make_articles({"content": "x"}), {"a": ["x", " "]})


def test_windows_of_bytes_find_what_texts_hold():
    """Keywords at the ends of texts, across their bounds, with many-byte letters, and sharing anchors."""
    rnd = random.Random(2)
    words = ["naïve", "日本語", "日本", "oil", "il", "o", "a b", " é", "😀", "x😀y", "inflation rate", "flation", "ation r", "a" * 20, "İ".lower()]
    anchors = {w: terms.anchor_of(w, terms.Counter({"infla": 1, "nflat": 1})) for w in words}
    texts = ["", "日本語", "oil", "o", "il", "inflation", " rate", "a" * 21, "日", "本"] + ["".join(rnd.choice([*words, " ", "z", "é"]) for _ in range(rnd.randint(0, 12))) for _ in range(200)]
    raw = [x.encode() for x in texts]
    bounds = np.cumsum([0, *map(len, raw)])
    for piece in (1 << 18, 7):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(terms, "PIECE", piece)
            text, term = terms.held_terms(np.frombuffer(b"".join(raw), np.uint8), bounds, terms.needles_of(anchors))
        assert list(zip(text, term)) == [(i, j) for i, x in enumerate(texts) for j, w in enumerate(words) if w in x]


def test_a_very_long_word_costs_its_length(make_articles):
    """Its letters were once taken apart anew for each of its pieces. Rows whose id repeats or lacks stay apart."""
    df = make_articles({"content": "b" * 100_000 + "inflation" + "c" * 100_000}, {"event_id": "1", "content": "gdp GDP"}, {"event_id": "1", "content": "gdp"}, {"event_id": None, "content": "gdp"})
    began = time.monotonic()
    found = sorted((str(r.event_id), r.keyword) for r in terms.find_terms(df, {"a": ["inflation", "gdp"]}).collect())
    assert found == [("0", "inflation"), ("1", "gdp"), ("1", "gdp"), ("None", "gdp")] and time.monotonic() - began < 30
