import datetime

from pyspark.sql import functions as F

from tidewire.operators import clean, transform


def test_dedup_keeps_first_arrival_and_ignores_separators(make_articles):
    t0 = datetime.datetime(2024, 1, 1)
    df = make_articles(
        {"event_id": "b", "title": "A", "url": "x", "event_ts": t0 + datetime.timedelta(hours=1)},
        {"event_id": "a", "title": "A", "url": "x", "event_ts": t0},
        {"event_id": "c", "title": "Ax", "url": "", "event_ts": t0},
        {"event_id": "d", "title": " A", "url": "x", "event_ts": t0},
    )
    kept = {r.event_id for r in clean.dedup(df).collect()}
    # 'A'+'x' and 'Ax'+'' share a key; the tie on time goes to the smaller id
    assert kept == {"a", "d"}
    assert clean.dedup(clean.dedup(df).drop("dedup_key")).count() == 2
    counts = clean.dedup_counts(df).first()
    assert (counts.kept, counts.skipped) == (2, 2)


def test_history_survives_runs(make_articles, spark, tmp_path):
    seen = str(tmp_path / "seen")
    first = clean.dedup(make_articles({"title": "A"}, {"title": "B"}))
    clean.append_seen(first, seen)
    batch = make_articles({"title": "B"}, {"title": "C"}, {"title": "C"})
    fresh = clean.dedup_against_history(batch, spark.read.parquet(seen))
    assert [r.title for r in fresh.collect()] == ["C"]


def test_normalize_and_validate(make_articles):
    df = make_articles(
        {"title": "  T \n", "content": "a  b\t\n c ", "description": "d"},
        {"title": None, "content": "", "description": " only  description here long "},
        {"title": None, "content": None},
        {"title": "ab", "content": "short"},
        {"title": "abc", "content": "short"},
        {"title": "", "content": "x" * 20},
    )
    rows = clean.normalize(df).orderBy("event_id").collect()
    assert (rows[0].title, rows[0].content, rows[0].text_length) == ("T", "a b c", 5)
    assert rows[1].content == "only description here long"
    kept = {r.event_id for r in clean.validate(clean.normalize(df)).collect()}
    assert kept == {"1", "4", "5"}  # row 0: one-letter title, five letters of content


def test_schema_map_reads_the_input_row(make_articles):
    df = make_articles({"title": "T", "source_name": "S"})
    row = transform.map_schema(df, {"title": "source_name", "copy": "title", "none": "nope"}).first()
    assert (row.title, row.copy, row.source_name) == ("S", "T", "S")
    assert "none" not in row.asDict()


def test_event_build_fallbacks(make_articles):
    df = make_articles({"source": "rss", "content": "", "description": "D", "source_name": ""}).drop("url")
    row = transform.build_event(df, {"title": "default", "channel": "news"}).first()
    assert row.content == "D" and row.title == "" and row.url == "" and row.channel == "news"
    assert row.source_name == "rss" and row.language == "en" and row.original_type == "news_article"
    assert row.timestamp == "2024-01-01T00:00:00"


def test_cap_takes_the_latest(make_articles):
    df = make_articles(*[{"published": f"2024-01-0{i}T00:00:00Z"} for i in range(1, 6)], {"published": None})
    got = [r.published[:10] for r in transform.cap_batch(df, 2).collect()]
    assert got == ["2024-01-05", "2024-01-04"]


def test_cap_reads_every_spelling(make_articles):
    spellings = [
        "Wed, 03 Jan 2024 10:00:00 +0000", "2024-01-03T15:31:00+05:30", "2024-01-03T09:59:00Z", "n/a", None,
        "Mon, 01 Jan 2024 23:00:00 GMT", "2024-01-03T10:01:00.5Z",
    ]
    df = make_articles(*[{"published": p} for p in spellings])
    assert [r.published for r in transform.cap_batch(df, 5).collect()] == [spellings[i] for i in (6, 1, 0, 2, 5)]
    assert [r.event_id for r in transform.cap_batch(df, 7).collect()][5:] == ["3", "4"]


def test_dedup_reads_no_text_it_does_not_return(spark, sf_dir):
    from tidewire.plans import catalog

    plan = catalog.clean_dedup(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "min_by" not in plan and "content" not in plan.split("Relation")[0]


def test_dedup_keeps_one_of_equal_rows(make_articles):
    twice = make_articles({"title": "A", "content": "x"}, {"title": "B"})
    assert sorted(r.title for r in clean.dedup(twice.union(twice)).collect()) == ["A", "B"]


def test_union_fills_missing_columns(make_articles):
    a = make_articles({"title": "A"})
    both = transform.union_sources([a, a.select("event_id").withColumn("tone", F.lit(1.0))])
    assert both.count() == 2 and "tone" in both.columns
