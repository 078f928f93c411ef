import datetime
import json
import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.operators import clean, enrich, features, nlp, transform, vector_index
from tidewire.session import chain, scratch_dir
from tidewire.sources import landed
from tidewire.streaming import keyed, sinks, streams


def test_gdelt_responses(spark, tmp_path):
    body = {"articles": [
        {"id": "1", "title": "A", "url": "u", "content": "c", "source": "s", "date": "d", "categories": ["x"], "tone": -1.5},
        {"id": "2", "title": None},
    ]}
    (tmp_path / "r1.json").write_text(json.dumps(body, indent=2))
    (tmp_path / "r2.json").write_text(json.dumps({"articles": []}))
    rows = landed.read_gdelt(spark, str(tmp_path), "now").orderBy("title").collect()
    assert len(rows) == 2 and rows[0].title is None and rows[0].categories == []
    assert (rows[1].source, rows[1].source_name, rows[1].published, rows[1].tone) == ("gdelt", "s", "d", -1.5)
    assert rows[1].metadata == {"gdelt_doc_id": "1", "collected_at": "now"}


def test_newsapi_responses(spark, tmp_path):
    body = {"articles": [{"title": "A", "source": {"id": None, "name": "BBC"}, "publishedAt": "p"}, {"title": "B"}]}
    (tmp_path / "r.json").write_text(json.dumps(body))
    rows = landed.read_newsapi(spark, str(tmp_path)).orderBy("title").collect()
    assert [(r.title, r.source_name, r.published) for r in rows] == [("A", "BBC", "p"), ("B", None, None)]


def test_rss_items(spark, tmp_path):
    feed = (
        "<rss><channel><title>feed</title><item><title>T &amp; U</title><link>http://x</link>"
        "<description>D</description><pubDate>Fri, 05 Jan 2024 10:20:30 GMT</pubDate></item>"
        "<item><title>only</title></item></channel></rss>"
    )
    (tmp_path / "a.xml").write_text(feed)
    (tmp_path / "b.xml").write_text("not a feed <item")
    rows = landed.read_rss(spark, str(tmp_path)).orderBy("title").collect()
    assert [(r.title, r.link) for r in rows] == [("T & U", "http://x"), ("only", "")]
    assert rows[0].feed.endswith("a.xml")
    out = transform.transform_rss(
        landed.read_rss(spark, str(tmp_path)).withColumn("event_ts", F.lit("2024-01-06").cast("timestamp_ntz")), "now"
    ).filter("url = 'http://x'").first()
    assert (out.published_parsed, out.source_name, out.content) == ("2024-01-05T10:20:30+00:00", "rss", "D")


def test_webhook_payloads_keep_what_does_not_parse(spark, tmp_path):
    (tmp_path / "p.txt").write_text('{"title": "A", "n": 1}\nbroken {\n')
    schema = T.StructType([T.StructField("title", T.StringType()), T.StructField("n", T.LongType())])
    rows = streams.drain(landed.read_webhook(spark, str(tmp_path), schema), "t").orderBy("payload").collect()
    bad, good = (rows if rows[0].title is None else rows[::-1])
    assert (good.title, good.n, good[landed.CORRUPT]) == ("A", 1, None)
    assert bad[landed.CORRUPT] == "broken {" and bad.event_type == "incoming"


@pytest.fixture
def land(spark, make_articles):
    """Articles as a stream with one file per call."""

    def start(*batches):
        path = scratch_dir(spark, "test-land")
        for rows in batches:
            make_articles(*rows).coalesce(1).write.mode("append").parquet(path)
        schema = make_articles({}).schema
        return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)

    return start


def test_stream_dedup_across_batches(land):
    t0 = datetime.datetime(2024, 1, 1)
    copies = [{"event_id": f"h{i}", "title": "hot", "event_ts": t0 + datetime.timedelta(minutes=i)} for i in range(40)]
    stream = land(copies, [{"event_id": "z", "title": "hot"}, {"event_id": "n", "title": "new"}])
    rows = streams.drain(streams.dedup_stream(stream, "2 days"), "t").collect()
    assert sorted(r.title for r in rows) == ["hot", "new"]


def drained(stream, out, state):
    with keyed.settings(stream.sparkSession):
        query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start()
    assert query.awaitTermination(90)


def test_keyed_dedup_outlives_the_watermark_and_restarts(land, spark, make_articles):
    """Late and earlier copies are copies, new keys pass however late they are, and a restart forgets nothing."""
    t0, day = datetime.datetime(2024, 3, 1), datetime.timedelta(days=1)
    row = lambda i, title, ts: {"event_id": i, "title": title, "event_ts": ts}
    folder = scratch_dir(spark, "keyed-in")
    first = make_articles(row("b", "hot", t0 + day), row("a", "hot", t0), row("c", "other", t0), row("z", "hot", t0 + 2 * day))
    first.coalesce(1).write.parquet(folder)
    stream = lambda: spark.readStream.schema(first.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    out, state = scratch_dir(spark, "keyed-out"), scratch_dir(spark, "keyed-state")
    drained(keyed.dedup_stream_keyed(stream()), out, state)
    assert sorted(r.event_id for r in spark.read.parquet(out).collect()) == ["a", "c"]
    make_articles(row("early", "hot", t0 - 90 * day), row("late", "new", t0 - 200 * day)).coalesce(1).write.mode("append").parquet(folder)
    drained(keyed.dedup_stream_keyed(stream()), out, state)
    make_articles(row("x", "other", t0 + 300 * day), row("y", "new", t0)).coalesce(1).write.mode("append").parquet(folder)
    drained(keyed.dedup_stream_keyed(stream()), out, state)
    got = spark.read.parquet(out).collect()
    assert sorted(r.event_id for r in got) == ["a", "c", "late"] and all(len(r.dedup_key) == 32 for r in got)


def test_keys_are_forgotten_after_their_time(land, spark, make_articles):
    import time

    folder, out, state = (scratch_dir(spark, f"ttl-{x}") for x in ("in", "out", "state"))
    batch = make_articles({"title": "hot"})
    batch.coalesce(1).write.parquet(folder)
    for again in range(2):
        stream = spark.readStream.schema(batch.schema).parquet(folder)
        drained(keyed.dedup_stream_keyed(stream, ttl_days=0.5 / 86_400), out, state)
        time.sleep(1)
        batch.coalesce(1).write.mode("append").parquet(folder)
    assert spark.read.parquet(out).count() == 2


def test_keyed_dedup_takes_plain_rows():
    """One row is held, nulls are least, and a known key's rows are not looked at."""
    class State:
        kept = None
        exists = lambda self: self.kept is not None
        def update(self, value): self.kept = value

    first = keyed.FirstSeen(1, ("event_ts", "event_id"))
    first.first = State()
    t0 = datetime.datetime(2024, 1, 1)
    rows = [Row(event_ts=t0, event_id="b"), Row(event_ts=None, event_id="c"), Row(event_ts=None, event_id="a"), Row(event_ts=t0, event_id=None)]
    assert list(first.handleInputRows(("k",), iter(rows), None)) == [rows[2]] and first.first.kept == (None, "a")
    assert list(first.handleInputRows(("k",), iter(rows), None)) == []


def test_keyed_dedup_of_a_key_longer_than_an_arrow_batch(land, spark):
    t0 = datetime.datetime(2024, 1, 1, 12, 30, 15, 123456)
    rows = [{"event_id": f"h{i:02}", "title": "hot", "event_ts": t0 - datetime.timedelta(minutes=i)} for i in range(40)] + [{"event_id": "n", "title": None, "url": None}]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        with keyed.settings(spark):
            got = {r.event_id: r.event_ts for r in streams.drain(keyed.dedup_stream_keyed(land(rows)), "t").select("event_id", F.col("event_ts").cast("string").alias("event_ts")).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert set(got) == {"h39", "n"} and got["h39"] == "2024-01-01 11:51:15.123456"


def test_sliding_windows_are_made_of_daily_sums(land, spark):
    """Windows of seven days from daily sums hold what each row in all its windows gives."""
    day, t0 = datetime.timedelta(days=1), datetime.datetime(2024, 1, 1, 12)
    rnd = random.Random(7)
    rows = [{"event_id": str(i), "content": rnd.choice(["war", "rally", "x"]), "language": rnd.choice("ab"), "event_ts": t0 + rnd.randrange(12) * day} for i in range(80)]
    end = [{"event_id": "end", "content": "x", "language": "a", "event_ts": t0 + 60 * day}]
    feats = chain(nlp.score_sentiment, features.extract_features)(land(rows, end))
    got = streams.drain(streams.windowed_sums(feats, "language", "1 day", "7 days", "1 day"), "t")
    got = {(r.w.start, r.language): (r.total_events, r.n_positive, r.n_negative) for r in got.collect() if r.w.start < t0 + 20 * day}
    want = {}
    for r in rows:
        for back in range(7):
            start = datetime.datetime(2024, 1, 1) + (r["event_ts"] - t0) - back * day
            n, p, m = want.get((start, r["language"]), (0, 0, 0))
            want[start, r["language"]] = (n + 1, p + (r["content"] == "rally"), m + (r["content"] == "war"))
    assert got == want


def test_stream_equals_batch(land, make_articles):
    rows = [{"title": "NATO", "content": "war and growth in Syria"}, {"title": "x", "content": "rally"}]
    steps = chain(clean.normalize, clean.validate, enrich.extract_entities, nlp.score_sentiment, features.extract_features)
    got = streams.drain(steps(land(rows)), "t")
    assert sorted(map(str, got.collect())) == sorted(map(str, steps(make_articles(*rows)).collect()))


def test_windows_close_and_late_rows_are_dropped(land):
    day = datetime.timedelta(days=1)
    t0 = datetime.datetime(2024, 1, 1, 12)
    bad = {"content": "war", "language": "en"}
    stream = land(
        [{**bad, "event_id": "a", "event_ts": t0}],
        [{**bad, "event_id": "b", "event_ts": t0 + 9 * day}],
        [{**bad, "event_id": "late", "event_ts": t0}, {**bad, "event_id": "c", "event_ts": t0 + 20 * day}],
    )
    rows = chain(nlp.score_sentiment, features.extract_features)(stream)
    out = streams.drain(streams.windowed_signals(rows, "language", length="1 day"), "t")
    got = sorted((str(r.window_start), r.type) for r in out.collect())
    assert got == [
        ("2024-01-01 00:00:00", "market_risk"), ("2024-01-01 00:00:00", "negative_surge"),
        ("2024-01-10 00:00:00", "market_risk"), ("2024-01-10 00:00:00", "negative_surge"),
    ]
    assert {r.confidence for r in out.collect()} == {1.0}


def test_batch_sink_is_idempotent(make_articles, spark):
    path = scratch_dir(spark, "test-sink")
    write = sinks.batch_writer(path, "language")
    rows = make_articles({"language": "en"}, {"language": "de"})
    write(rows, 0)
    write(rows, 0)
    write(make_articles({"event_id": "9", "language": "en"}), 1)
    assert spark.read.parquet(path).groupBy("language").count().orderBy("language").collect() == [("de", 1), ("en", 2)]


def test_graph_log_replays_and_compacts(make_articles, spark):
    root, new = scratch_dir(spark, "test-graph"), scratch_dir(spark, "test-graph2")
    write = sinks.graph_writer(root)

    def tagged(*rows):
        return nlp.score_sentiment(enrich.extract_entities(make_articles(*rows)))

    first = tagged({"event_id": "e", "title": "Syria", "content": "war"})
    write(first, 0)
    write(first, 0)
    write(tagged({"event_id": "e", "title": "Syria", "content": "war growth crisis"}), 1)
    weights = {r.target: r.weight for r in sinks.stored_edges(spark, root).collect()}
    assert weights == {"country:syria": 0.8, "market:global": 0.3333}
    sinks.compact_graph(spark, root, new)
    assert sinks.stored_edges(spark, new).count() == 2
    assert {r.id for r in sinks.stored_nodes(spark, new).collect()} == {"e", "country:syria"}


def test_envelope(make_articles):
    rows = make_articles({"event_id": "e", "title": "T"}).select("event_id", "title", "event_ts")
    row = sinks.envelope(rows, "p", "event_ts").first()
    message = json.loads(row.value)
    assert row.key == "e" and message["type"] == "pipeline_update" and message["pipeline"] == "p"
    assert message["data"]["title"] == "T" and message["timestamp"] == "2024-01-01T00:00:00.000000"


def test_live_scoring(spark):
    schema = "event_id string, event_ts timestamp_ntz, embedding array<float>"
    t0 = datetime.datetime(2024, 1, 1)
    corpus = spark.createDataFrame([("c1", t0, [1.0, 0.0]), ("c2", t0, [0.0, 1.0])], schema)
    batch = spark.createDataFrame([("e1", t0, [1.0, 0.0]), ("e2", t0, [0.0, 0.0])], schema)
    out = scratch_dir(spark, "test-live")
    index = vector_index.build_index(corpus, scratch_dir(spark, "test-live-index"), "event_id")
    write = sinks.scoring_writer(index, out, k=1, threshold=0.5)
    write(batch, 0)
    write(batch, 0)
    got = {r.query_id: (r.impact_score, r.impact_level, r.time_to_market) for r in spark.read.parquet(f"{out}/impact").collect()}
    assert got == {"e1": (1.0, "high", "fast"), "e2": (0.0, "low", "moderate")}
    edge = spark.read.parquet(f"{out}/edges").collect()
    assert [(e.source, e.target, e.relation) for e in edge] == [("e1", "c1", "SIMILAR_TO")]
    assert spark.read.parquet(f"{out}/push").count() == 2
