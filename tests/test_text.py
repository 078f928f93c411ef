import datetime
import hashlib
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from tidewire.operators import enrich, intel, nlp

RUN = "2024-02-01T00:00:00"


def one(df):
    return df.first()


def test_places_in_order_of_appearance(make_articles):
    df = make_articles({"title": "New York and Élan", "content": "Then Paris, new Paris. Oé Al Enère"})
    row = one(enrich.enrich_geo(df))
    assert [x.name for x in row.locations] == ["New York", "Then Paris", "Paris"]
    assert row.has_geo and row.locations[0].confidence == 0.5
    assert one(enrich.enrich_geo(make_articles({"title": "no", "content": "places"}))).has_geo is False


def test_linked_entities(make_articles):
    df = make_articles({"title": "World Bank and NATO", "content": "Acme Holdings Corp met the EU in Ukraine. UNESCO"})
    row = one(enrich.link_entities(df))
    # 'World Bank' is listed and also fits the suffix pattern
    assert row.entities.organizations == ["Acme Holdings Corp", "EU", "NATO", "World Bank"]
    assert row.entities.countries == ["Ukraine", "UK"]
    assert row.entity_count == 6
    word = one(enrich.link_entities(df, match="word"))
    assert word.entities.countries == ["Ukraine"]


def test_long_entity_lists(make_articles):
    row = one(enrich.extract_entities(make_articles({"title": "WHO", "content": "Blue Sky Committee in Sudan, Afghanistan"})))
    assert row.entities.countries == ["Afghanistan", "Sudan"]
    assert row.entities.organizations == ["Blue Sky Committee", "WHO"]
    assert row.entities.total == 4


@pytest.mark.parametrize(
    "published, parsed, date, hour, day",
    [
        ("2024-01-05T23:30:00Z", "2024-01-05T23:30:00+00:00", "2024-01-05", 23, "Friday"),
        ("2024-01-05T23:30:00+05:00", "2024-01-05T23:30:00+05:00", "2024-01-05", 23, "Friday"),
        ("2024-01-05T23:30:00.250+0530", "2024-01-05T23:30:00.250000+05:30", "2024-01-05", 23, "Friday"),
        ("2024-01-05", "2024-01-05T00:00:00", "2024-01-05", 0, "Friday"),
        ("Fri, 05 Jan 2024 10:20:30 GMT", "2024-01-05T10:20:30+00:00", "2024-01-05", 10, "Friday"),
        ("5 Jan 2024 10:20:30 -0700", "2024-01-05T10:20:30-07:00", "2024-01-05", 10, "Friday"),
        ("2024-02-30T00:00:00Z", RUN + "+00:00", None, None, None),
        ("junk", RUN + "+00:00", None, None, None),
        ("", None, None, None, None),
        (None, None, None, None, None),
    ],
)
def test_times_keep_their_offset(make_articles, published, parsed, date, hour, day):
    row = one(enrich.enrich_temporal(make_articles({"published": published}), RUN))
    assert (row.published_parsed, row.published_date, row.published_hour, row.day_of_week) == (parsed, date, hour, day)
    assert row.ingested_at == RUN


@pytest.mark.parametrize(
    "content, score, label, pos, neg",
    [
        ("growth growth profit", 1.0, "positive", 2, 0),
        ("war. crisis", -1.0, "negative", 0, 1),
        ("growth crisis", 0.0, "neutral", 1, 1),
        ("gain rally crisis", 0.3333, "positive", 2, 1),
        ("nothing", 0.0, "neutral", 0, 0),
        ("GROWTH loss\x1cwar", -0.3333, "negative", 1, 2),
    ],
)
def test_sentiment(make_articles, content, score, label, pos, neg):
    s = one(nlp.score_sentiment(make_articles({"content": content}))).sentiment
    assert (s.score, s.label, s.positive_words, s.negative_words) == (score, label, pos, neg)


def test_summary(make_articles):
    short = one(nlp.summarize(make_articles({"title": "T", "content": " One. Two."})))
    assert short.summary == "T.  One. Two."
    long = one(
        nlp.summarize(
            make_articles({"title": "Title", "content": "One two. A b c d e. The Market. Four five six seven! x"})
        )
    )
    # 'The Market.' scores 2+10; then five words, then four
    assert long.summary == "The Market. A b c d e. Four five six seven!"


def test_hash_embedding_matches_a_plain_rebuild(make_articles):
    df = make_articles({"title": "a b", "content": "b c"}, {"content": ""})
    rows = nlp.embed_text(df, dim=8).orderBy("event_id").collect()
    words = ["a", "b", "b", "c"]
    slots = [int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % 16 for w in words]
    want = np.zeros(8)
    for s in slots:
        want[s % 8] += -1 if s >= 8 else 1
    norm = np.linalg.norm(want)
    assert np.allclose(rows[0].embedding, want / norm if norm else want)
    assert rows[1].embedding == [0.0] * 8 and rows[0].embedding_dim == 8


def test_encoder_plug_in_is_loaded_in_tasks(make_articles):
    def load():
        return lambda texts: np.array([[len(x), 1.0] for x in texts])

    row = one(nlp.embed_text(make_articles({"title": "ab", "content": "c"}), load_encoder=load))
    assert row.embedding == [4.0, 1.0] and row.embedding_dim == 2


def test_conflict_levels(make_articles):
    df = make_articles({"title": "Invasion", "content": "after a summit in Gaza; sanctions and war"})
    last = one(intel.scan_conflict(df))
    assert (last.escalation_level, last.severity_score) == ("low", 1)
    assert last.matched_triggers == ["invasion", "sanctions", "summit"]
    assert last.active_zones == ["Gaza"] and last.keyword_hits == 3
    top = one(intel.scan_conflict(df, escalation_rule="max"))
    assert (top.escalation_level, top.severity_score) == ("high", 10)
    calm = one(intel.scan_conflict(make_articles({"content": "calm"})))
    assert (calm.escalation_level, calm.matched_triggers) == ("low", [])
    assert intel.conflict_articles(df).first().event_type == "conflict_intelligence"


def test_economic_and_commodities(make_articles):
    df = make_articles({"content": "GDP and inflation: crude OIL exports, deficit. Gold!"})
    row = one(intel.detect_economic(df))
    assert {k: (v.matched, v["count"]) for k, v in row.indicators_detected.items()} == {
        "gdp": (["GDP"], 1), "inflation": (["inflation"], 1), "trade": (["export"], 1), "fiscal": (["deficit"], 1)
    }
    assert row.indicator_count == 4 and row.primary_sectors == ["energy"]
    assert one(intel.detect_commodities(df)).commodities_mentioned == {"energy": ["crude oil"], "metals": ["gold"]}


def test_news_categories_and_credibility(make_articles):
    df = make_articles(
        {"title": "He said", "source_name": "Al Jazeera"},
        {"title": "zzz", "source_name": None, "source": "BBC"},
        {"title": "stock", "source_name": "nobody"},
    )
    rows = intel.weigh_sources(intel.classify_news(df)).orderBy("event_id").collect()
    assert [(r.categories, r.category_count, r.source_credibility) for r in rows] == [
        (["technology"], 1, 0.7), (["general"], 1, 0.85), (["markets"], 1, 0.5)
    ]


def test_watchlist_counts_and_scores(make_articles):
    day = datetime.datetime(2024, 1, 1)
    later = day + datetime.timedelta(days=1)
    df = make_articles(
        {"content": "suez canal", "event_ts": day},
        {"content": "Suez Canal", "event_ts": later},
        {"content": "the Suez Canal again", "event_ts": later},
    )
    got = {(r.place, str(r.day)): (r.mentions, r.z_score) for r in intel.watch_mentions(df).collect()}
    assert got == {("Suez Canal", "2024-01-01"): (1, -1.0), ("Suez Canal", "2024-01-02"): (2, 1.0)}


def test_episodes(make_articles):
    row = one(intel.project_episodes(make_articles({"title": None, "description": "D"}), "p"))
    assert (row.title, row.summary, row.sectors, row.source, row.pipeline_name) == ("news_article", "D", [], "pipeline", "p")


def test_hashed_vectors_hold_few_tokens_at_once():
    """Memory is bounded by steps, not by a batch of texts or one long text."""
    rnd = np.random.default_rng(1)
    lengths = [0, 3, 1_000_000, 0, 1, *rnd.integers(0, 400, 3000).tolist()]
    flat = rnd.integers(0, 16, sum(lengths)).astype(np.int32)
    bounds = np.cumsum([0, *lengths]).astype(np.int32)
    slots = pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat)).slice(1)
    tracemalloc.start()
    (got,) = nlp._hashed_vectors(8).func(iter([slots]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    got = np.array(got.to_pylist(), np.float32)
    for i, (a, b) in enumerate(zip(bounds[1:], bounds[2:])):
        want = np.bincount(flat[a:b] % 8, np.where(flat[a:b] >= 8, -1.0, 1.0), 8)
        norm = np.linalg.norm(want)
        assert np.array_equal(got[i], (want / norm if norm else want * 0).astype(np.float32))
    assert len(got) == len(lengths) - 1 and peak < 16 << 20
