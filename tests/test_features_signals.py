import datetime

import numpy as np
import pytest

from tidewire.operators import enrich, features, nlp, signals
from tidewire.session import chain

AGG = "g string, avg_sentiment double, positive_ratio double, negative_ratio double, avg_entity_count double, geo_ratio double"


def test_extract_features(make_articles, spark):
    df = make_articles(
        {"title": "NATO", "content": "growth in Syria", "published": "2024-01-06T07:08:09+02:00"},
        {"title": None, "content": None, "published": "junk"},
    )
    rows = chain(enrich.extract_entities, enrich.enrich_geo, nlp.score_sentiment)(df)
    vectors = spark.createDataFrame([("0", [1.0, 2.0, 6.0])], "event_id string, embedding array<float>")
    a, b = features.extract_features(rows.join(vectors, "event_id", "left")).orderBy("event_id").collect()
    assert (a.sentiment_score, a.sentiment_label, a.entity_count, a.text_length) == (1.0, "positive", 2, 15)
    assert (a.has_geo, a.hour_of_day, a.day_of_week, a.has_embedding) == (1, 7, 5, 1)
    assert np.isclose(a.embedding_mean, 3.0) and np.isclose(a.embedding_std, np.std([1, 2, 6]))
    assert (b.sentiment_label, b.text_length, b.has_geo, b.hour_of_day, b.day_of_week, b.has_embedding) == (
        "neutral", 0, 0, 0, 0, 0
    )
    bare = features.extract_features(df.select("event_id", "content")).orderBy("event_id").first()
    assert (bare.sentiment_score, bare.sentiment_label, bare.entity_count) == (0.0, "neutral", 0)


FEATURE = "event_id string, g string, event_ts timestamp_ntz, sentiment_score double, sentiment_label string, entity_count int, has_geo int"


def rows_of(spark, *items):
    t0 = datetime.datetime(2024, 1, 1)
    data = [
        (str(i), g, t0 + datetime.timedelta(days=d), s, "positive" if s > 0.1 else "negative" if s < -0.1 else "neutral", e, geo)
        for i, (g, d, s, e, geo) in enumerate(items)
    ]
    return spark.createDataFrame(data, FEATURE)


def test_aggregates(spark):
    df = rows_of(spark, ("a", 0, 1.0, 2, 1), ("a", 0, -0.5, 0, 0), ("a", 1, 0.0, 4, 0), ("b", 1, -1.0, 1, 1))
    row = features.aggregate_features(df).first()
    assert row.total_events == 4 and np.isclose(row.avg_sentiment, -0.125)
    assert (row.positive_ratio, row.negative_ratio, row.geo_ratio) == (0.25, 0.5, 0.5)
    assert features.aggregate_features(df.filter("false")).count() == 0
    by_day = {str(r.day): (r.avg_sentiment, r.avg_entities, r.total_events) for r in features.daily_features(df).collect()}
    assert by_day == {"2024-01-01": (0.25, 1.0, 2), "2024-01-02": (-0.5, 2.5, 2)}


@pytest.mark.parametrize(
    "avg, neg, geo, want",
    [
        (-0.5, 0.0, 0.0, [("market_risk", "high")]),
        (-0.49, 0.0, 0.0, [("market_risk", "medium")]),
        (-0.2, 0.6, 0.5, [("market_risk", "medium")]),
        (-0.19, 0.61, 0.51, [("negative_surge", "high"), ("geopolitical_activity", "medium")]),
        (0.99, 0.0, 0.0, []),
        (1.0, 0.0, 0.0, [("market_opportunity", "high")]),
    ],
)
def test_rules_at_their_thresholds(spark, avg, neg, geo, want):
    df = spark.createDataFrame([("x", avg, 0.0, neg, 0.0, geo)], AGG)
    got = signals.generate_signals(df, "g").orderBy("ord").collect()
    assert [(r.type, r.severity) for r in got] == want
    assert [r.ord for r in got] == list(range(len(want)))


def test_signal_texts(spark):
    df = spark.createDataFrame([("x", -0.714, 0.0, 0.666, 0.0, 0.6)], AGG)
    got = signals.generate_signals(df, "g").orderBy("ord").collect()
    assert [r.reason for r in got] == [
        "Strong negative sentiment (-0.71)", "Negative ratio 67% exceeds threshold", "High geographic diversity in events"
    ]
    assert [r.confidence for r in got] == [0.714, 0.666, 0.6]


@pytest.mark.parametrize(
    "avg, entities, want",
    [
        (-0.31, 0.0, ["market_risk"]), (-0.3, 0.0, ["market_caution"]), (-0.1, 3.0, []),
        (0.3, 3.1, ["high_entity_density"]), (0.31, 20.0, ["market_opportunity", "high_entity_density"]),
    ],
)
def test_daily_rules(spark, avg, entities, want):
    df = spark.createDataFrame([("x", avg, entities)], "g string, avg_sentiment double, avg_entities double")
    got = signals.generate_daily_signals(df, "g").orderBy("ord").collect()
    assert [r.type for r in got] == want
    if entities == 20.0:
        assert got[-1].confidence == 1.0


def test_filter_and_collect(spark):
    df = spark.createDataFrame([("x", -0.6, 0.0, 0.7, 0.0, 0.0)], AGG)
    fired = signals.generate_signals(df, "g")
    assert signals.filter_signals(fired, 0.65).count() == 1
    missing = fired.limit(1).selectExpr("g", "cast(null as double) confidence")
    assert signals.filter_signals(missing).count() == 0
    both = signals.collect_signals(df, fired, "g").first().signals
    assert [s.type for s in both] == [s.type for s in signals.with_signals(df).first().signals]


def test_rolling_window_counts_calendar_days(spark):
    df = rows_of(spark, ("a", 0, -1.0, 0, 0), ("a", 6, -1.0, 0, 0), ("a", 7, 1.0, 0, 0))
    got = {str(r.day): (r.total_events, r.avg_sentiment) for r in signals.rolling_aggregates(df, "g").collect()}
    assert got == {"2024-01-01": (1, -1.0), "2024-01-07": (2, -1.0), "2024-01-08": (2, 0.0)}


def test_snapshot_and_latest(spark):
    df = rows_of(spark, ("a", 0, -1.0, 0, 0), ("b", 0, 1.0, 0, 1))
    aggregates = signals.with_signals(features.aggregate_features(df, "g"))
    old = features.snapshot(df, aggregates, "g", "2024-01-01")
    new = features.snapshot(df.filter("g = 'a'"), aggregates, "g", "2024-01-02")
    rows = {r.event_id: r for r in features.latest_snapshot(old.unionByName(new)).collect()}
    assert (rows["0"].timestamp, rows["1"].timestamp) == ("2024-01-02", "2024-01-01")
    assert [s.type for s in rows["0"].signals] == ["market_risk", "negative_surge"]
    assert rows["1"].aggregates.avg_sentiment == 1.0
