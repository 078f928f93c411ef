from tidewire.plans import catalog, flows


def test_daily_tables_without_rows_are_read_back(make_articles, spark, tmp_path):
    """One plain article gives no edge and no signal: their folders hold no file with a schema."""
    out = flows.daily_flow(make_articles({"title": "plain", "content": "words only", "language": "en"}))
    schemas = flows.store_daily(out, str(tmp_path))
    stored = {name: spark.read.schema(schemas[name]).parquet(f"{tmp_path}/{name}") for name in flows.DAILY_TABLES}
    assert {name: df.count() for name, df in stored.items()} == {name: out[name].count() for name in flows.DAILY_TABLES}
    assert stored["signals"].count() == 0 and [str(r.day) for r in stored["rows"].collect()] == ["2024-01-01"]


def test_daily_store_of_articles_without_signals(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"plain words {i}", "en", "src0", 13) for i in range(3)], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = {(r.table, r.n) for r in catalog.QUERIES["daily_store"](spark, str(tmp_path)).collect()}
    assert ("rows", 3) in got and not any(table == "signals" for table, _ in got)
