"""The catalogue of queries: every operator over the given tables.

Each entry takes ``(spark, sf_dir)``. Results are flat: arrays are joined with
'|', structs opened, dates printed, so that they compare across engines.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.functions import lexicons as lx
from tidewire.functions import text as t
from tidewire.operators import (
    backtest, clean, enrich, explain, features, forecast, graph, graph_queries,
    intel, learn, nlp, runs, seen, signals, similarity, terms, transform, vector_index,
)
from tidewire.plans import flows
from tidewire.session import cut_lineage, scratch_dir
from tidewire.sources import adapters, landed, landing
from tidewire.streaming import keyed, sinks, streams

RUN_TS = "2024-02-01T00:00:00"
START = "2024-01-01"
# The tables hold invented prose, which the news lexicons hardly touch; frequent
# words and syllables of it are added so that every branch of the rules is reached.
POSITIVE = [*lx.POSITIVE_WORDS, "with", "for", "from"]
NEGATIVE = [*lx.NEGATIVE_WORDS, "was", "that", "this"]
MATCH_AT = 0.3
CONFLICT_WORDS = [*lx.CONFLICT_QUERY_WORDS, "thtion"]
TRIGGERS = {
    "high": [*lx.ESCALATION_TRIGGERS["high"], "thtion"],
    "medium": [*lx.ESCALATION_TRIGGERS["medium"], "ierung", "ement"],
    "low": [*lx.ESCALATION_TRIGGERS["low"], "blely"],
}
ZONES = [*lx.CONFLICT_ZONES, "ention", "schung"]
CONFLICT_HITS = [*lx.CONFLICT_KEYWORDS, "tion", "ment", "lich"]
WATCHED = {**lx.WATCHLIST, "syllable": ["thtion", "ention", "ement"]}

PATH_FROM, PATH_TO = "order:1", "region:4"
HUB = "order:1"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__.rstrip("_")] = fn
    return fn


def flat(c: Column | str) -> Column:
    return F.array_join(c, "|")


def day_text(c: Column | str) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def stamp(c: Column | str) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to a fixed number of digits, integers to long."""
    out = []
    for field in df.schema.fields:
        c = F.col(field.name)
        if isinstance(field.dataType, T.DoubleType):
            c = F.round(c, digits)
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("long")
        out.append(c.alias(field.name))
    return df.select(*out)


articles = adapters.articles


def feature_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flows.feature_rows(articles(spark, sf_dir), POSITIVE, NEGATIVE)


def daily_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flows.daily_rows(articles(spark, sf_dir), POSITIVE, NEGATIVE)


# ---- sources -------------------------------------------------------------


@query
def src_gdelt(spark, sf_dir):
    path = scratch_dir(spark, "gdelt")
    landing.land_gdelt(articles(spark, sf_dir), path)
    return landed.read_gdelt(spark, path, RUN_TS, multiline=False).select(
        F.col("metadata")["gdelt_doc_id"].alias("gdelt_doc_id"), "source", "event_type", "title", "url",
        F.md5("content").alias("content_md5"), "source_name", "published",
        flat("categories").alias("categories"), flat("locations").alias("locations"), "tone",
    )


@query
def src_gdelt_conflict(spark, sf_dir):
    return intel.conflict_articles(articles(spark, sf_dir), CONFLICT_WORDS).select("event_id", "event_type", "title", "source_name")


@query
def src_newsapi(spark, sf_dir):
    path = scratch_dir(spark, "newsapi")
    landing.land_newsapi(articles(spark, sf_dir), path)
    return landed.read_newsapi(spark, path, multiline=False).select(
        "source", "event_type", "title", "description", F.md5("content").alias("content_md5"),
        "url", "source_name", "published",
    )


@query
def src_rss(spark, sf_dir):
    path = scratch_dir(spark, "rss")
    landing.land_rss(articles(spark, sf_dir), path)
    return landed.read_rss(spark, path).select(
        "source", "event_type", "title", F.md5("description").alias("description_md5"), "link", "published",
        (F.length("feed") > 0).alias("has_feed"),
    )


CONVERSATION = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("turn", T.LongType()),
        T.StructField("role", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)


@query
def src_webhook(spark, sf_dir):
    path = scratch_dir(spark, "webhook")
    landing.land_payloads(adapters.table(spark, sf_dir, "conversations"), path)
    return streams.drain(landed.read_webhook(spark, path, CONVERSATION), "webhook").select(
        "source", "event_type", "conv_id", "turn", "role", F.md5("text").alias("text_md5"),
        F.col(landed.CORRUPT).isNull().alias("parsed"),
    )


@query
def src_cap(spark, sf_dir):
    return transform.cap_batch(articles(spark, sf_dir), 250).select("event_id", "published", "title")


EVENT = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)


@query
def stream_kafka_in(spark, sf_dir):
    path = scratch_dir(spark, "kafka")
    events = adapters.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", "ts")
    landing.land_kafka(events, "event_id", "raw-events", path)
    records = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)
    return streams.drain(landed.kafka_values(records, EVENT), "kafka").select(
        "key", "topic", "event_id", "user_id", "event_type", "value", stamp("kafka_ts").alias("kafka_ts")
    )


@query
def src_union(spark, sf_dir):
    everything = transform.union_sources(
        [
            articles(spark, sf_dir),
            adapters.page_articles(spark, sf_dir),
            adapters.conversation_articles(spark, sf_dir),
        ]
    )
    return everything.select(
        "event_id", "source", "event_type", "title", F.md5("content").alias("content_md5"), "url", "language"
    )


# ---- clean and transform -------------------------------------------------


@query
def clean_dedup(spark, sf_dir):
    return clean.dedup(articles(spark, sf_dir)).select(
        "dedup_key", "event_id", "title", "source_name", stamp("event_ts").alias("event_ts")
    )


@query
def daily_dedup(spark, sf_dir):
    by_day = articles(spark, sf_dir).withColumn("day", day_text("event_ts"))
    return clean.dedup_counts(by_day, "day")


@query
def clean_dedup_history(spark, sf_dir):
    """The first half of the month is history, the second half the new batch."""
    rows = articles(spark, sf_dir)
    middle = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    seen = scratch_dir(spark, "seen")
    clean.append_seen(clean.dedup(rows.filter(F.col("event_ts") < middle)), seen)
    fresh = clean.dedup_against_history(rows.filter(F.col("event_ts") >= middle), spark.read.parquet(seen))
    return fresh.select("dedup_key", "event_id", "title")


@query
def clean_dedup_store(spark, sf_dir):
    """The same with a stored history and its sketch, appended run by run: a week at a time is a batch."""
    rows = articles(spark, sf_dir).withColumn("week", F.floor((F.dayofmonth("event_ts") - 1) / 7).cast("int"))
    history = seen.SeenStore(spark, scratch_dir(spark, "seen-store"), blocks=256, parts=64)
    kept = []
    for week in range(5):
        fresh = cut_lineage(clean.dedup_against_store(rows.where(F.col("week") == week).drop("week"), history), "fresh")
        history.append(fresh, f"week{week}")
        kept.append(fresh)
    return functools.reduce(DataFrame.unionByName, kept).select("dedup_key", "event_id", "title")


@query
def clean_normalize(spark, sf_dir):
    return rounded(
        clean.normalize(articles(spark, sf_dir)).select(
            "event_id", "title", F.md5("content").alias("content_md5"), "text_length"
        )
    )


@query
def clean_validate(spark, sf_dir):
    return clean.validate(articles(spark, sf_dir)).select("event_id", "title")


@query
def clean_chain(spark, sf_dir):
    return rounded(
        clean.clean(articles(spark, sf_dir)).select(
            "event_id", "dedup_key", "title", F.md5("content").alias("content_md5"), "text_length"
        )
    )


@query
def xf_schema_map(spark, sf_dir):
    mapping = {"headline": "title", "lang": "language", "missing": "no_such_column", "source_name": "source"}
    return transform.map_schema(articles(spark, sf_dir), mapping).select(
        "event_id", "title", "headline", "lang", "source_name"
    )


@query
def xf_event_build(spark, sf_dir):
    built = transform.build_event(articles(spark, sf_dir), {"channel": "news", "title": "overwritten"})
    return built.select(
        "event_id", "channel", "original_type", "source", "timestamp", "title", "url", "source_name",
        "language", F.md5("content").alias("content_md5"),
    )


@query
def xf_rss(spark, sf_dir):
    items = articles(spark, sf_dir).withColumn("link", F.concat(F.lit("http://feed.example/"), F.col("event_id")))
    return rounded(
        transform.transform_rss(items, RUN_TS).select(
            "event_id", "url", "title", "source_name", "timestamp", "published_parsed", "published_date",
            "published_hour", "day_of_week", "ingested_at",
        )
    )


# ---- enrichment and text -------------------------------------------------


@query
def enrich_geo(spark, sf_dir):
    return rounded(
        enrich.enrich_geo(articles(spark, sf_dir)).select(
            "event_id", "has_geo", F.size("locations").alias("n_locations"),
            flat(F.transform("locations", lambda x: x["name"])).alias("names"),
            F.try_element_at(F.transform("locations", lambda x: x["confidence"]), F.lit(1)).alias("confidence"),
        )
    )


@query
def enrich_entities(spark, sf_dir):
    return rounded(
        enrich.link_entities(articles(spark, sf_dir)).select(
            "event_id", "entity_count",
            flat("entities.organizations").alias("organizations"),
            flat("entities.countries").alias("countries"),
            F.size("entities.people").alias("n_people"),
            F.size("entities.events").alias("n_events"),
        )
    )


@query
def enrich_temporal(spark, sf_dir):
    return rounded(
        enrich.enrich_temporal(articles(spark, sf_dir), RUN_TS).select(
            "event_id", "published", "published_parsed", "published_date", "published_hour", "day_of_week",
            "ingested_at",
        )
    )


@query
def daily_enrich(spark, sf_dir):
    """Enriched before the deduplication, which then moves these columns and no text."""
    rows = enrich.enrich(articles(spark, sf_dir), RUN_TS).select(
        "event_id", "event_ts", clean.dedup_key().alias("dedup_key"), F.size("locations").alias("n_locations"),
        "entity_count", "published_parsed", "day_of_week",
    )
    return rounded(clean.keep_first(rows, "dedup_key").drop("event_ts"))


@query
def nlp_entities(spark, sf_dir):
    return rounded(
        enrich.extract_entities(articles(spark, sf_dir)).select(
            "event_id", flat("entities.countries").alias("countries"),
            flat("entities.organizations").alias("organizations"), F.col("entities.total").alias("total"),
        )
    )


def _sentiment(df: DataFrame) -> DataFrame:
    return rounded(df.select("event_id", "sentiment.*"))


@query
def nlp_sentiment(spark, sf_dir):
    return _sentiment(nlp.score_sentiment(articles(spark, sf_dir)))


@query
def nlp_sentiment_lexicon(spark, sf_dir):
    """The same operator with a lexicon of the caller's."""
    return _sentiment(nlp.score_sentiment(articles(spark, sf_dir), POSITIVE, NEGATIVE))


@query
def nlp_summary(spark, sf_dir):
    return nlp.summarize(articles(spark, sf_dir)).select("event_id", "summary")


@query
def nlp_embed(spark, sf_dir):
    """Vectors as their occupied cells and a checksum of their places and values."""
    rows = nlp.embed_text(articles(spark, sf_dir), dim=384)
    cells = F.filter(
        F.transform("embedding", lambda x, i: F.struct(F.round(x.cast("double") * 1e6).cast("bigint").alias("v"), (i + 1).alias("i"))),
        lambda c: c["v"] != 0,
    )
    return rounded(
        rows.select("event_id", "embedding_dim", cells.alias("cells")).select(
            "event_id", "embedding_dim", F.size("cells").alias("n_cells"),
            F.aggregate("cells", F.lit(0).cast("bigint"), lambda a, c: a + c["v"] * c["i"]).alias("checksum"),
        )
    )


@query
def intel_conflict(spark, sf_dir):
    return rounded(
        intel.scan_conflict(articles(spark, sf_dir), triggers=TRIGGERS, zones=ZONES, keywords=CONFLICT_HITS).select(
            "event_id", "escalation_level", flat("matched_triggers").alias("matched_triggers"),
            flat("active_zones").alias("active_zones"), "keyword_hits", "severity_score",
        )
    )


@query
def intel_economic(spark, sf_dir):
    """Long form: one row per (article, indicator); articles without any keep one row."""
    found = intel.detect_economic(articles(spark, sf_dir)).select(
        "event_id", "indicator_count", flat("primary_sectors").alias("primary_sectors"),
        F.explode_outer("indicators_detected").alias("indicator", "hit"),
    )
    return rounded(
        found.select(
            "event_id", "indicator_count", "primary_sectors", "indicator",
            flat("hit.matched").alias("matched"), F.col("hit.count").alias("matches"),
        )
    )


@query
def intel_commodity(spark, sf_dir):
    return (
        intel.detect_commodities(articles(spark, sf_dir))
        .select("event_id", F.explode("commodities_mentioned").alias("category", "names"))
        .select("event_id", "category", flat("names").alias("mentioned"))
    )


@query
def news_classify(spark, sf_dir):
    return rounded(
        intel.classify_news(articles(spark, sf_dir)).select(
            "event_id", flat("categories").alias("categories"), "category_count"
        )
    )


@query
def news_credibility(spark, sf_dir):
    """The tables' source names are unknown to the weights, so three are renamed."""
    renamed = articles(spark, sf_dir).replace({"src0": "Reuters", "src1": "Al Jazeera", "src2": ""}, subset="source_name")
    return intel.weigh_sources(renamed).select("event_id", "source_name", "source_credibility", "source_weight")


@query
def terms_economic(spark, sf_dir):
    """The indicator keywords once more, found by anchors and a join."""
    found = terms.terms_by_label(terms.find_terms(articles(spark, sf_dir), lx.ECONOMIC_INDICATORS))
    return found.select("event_id", F.col("label").alias("indicator"), flat("matched").alias("matched"), F.col("count").cast("long").alias("matches"))


@query
def terms_benchmark(spark, sf_dir):
    """A long list: the 10,000 most frequent longer words of the benchmark, and how many articles hold each."""
    words = adapters.table(spark, sf_dir, "benchmark").select(F.explode(F.split(F.lower("text"), " ")).alias("w"))
    words = words.where((F.length("w") >= 6) & F.col("w").rlike("^[!-~]+$"))
    listed = [r.w for r in words.groupBy("w").count().orderBy(F.desc("count"), "w").limit(10_000).collect()]
    return terms.find_terms(articles(spark, sf_dir), {"benchmark": listed}).groupBy("keyword").agg(F.count("*").alias("articles"))


@query
def watchlist_mentions(spark, sf_dir):
    return intel.watch_mentions(articles(spark, sf_dir), WATCHED).withColumn("day", day_text("day"))


@query
def memory_episodes(spark, sf_dir):
    rows = nlp.summarize(enrich.enrich_geo(articles(spark, sf_dir)))
    return rounded(
        intel.project_episodes(rows, "memory_encoding").select(
            "event_id", "title", F.md5("summary").alias("summary_md5"), F.size("locations").alias("n_locations"),
            F.size("sectors").alias("n_sectors"), "source", "pipeline_name",
        )
    )


# ---- knowledge graph -----------------------------------------------------


def _tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles with entities and sentiment, the texts left behind."""
    return (
        nlp.score_sentiment(enrich.extract_entities(articles(spark, sf_dir)), POSITIVE, NEGATIVE)
        .select("event_id", "event_ts", "title", "source", "published", "url", "entities", "sentiment")
    )


def _article_graph(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = cut_lineage(_tagged(spark, sf_dir), "tagged")
    return graph.build_nodes(rows), graph.build_edges(rows)


@query
def kg_nodes(spark, sf_dir):
    rows = nlp.summarize(nlp.score_sentiment(enrich.extract_entities(articles(spark, sf_dir)), POSITIVE, NEGATIVE))
    return graph.build_nodes(rows).withColumn("summary", F.md5("summary"))


@query
def kg_edges(spark, sf_dir):
    rows = cut_lineage(_tagged(spark, sf_dir), "tagged")
    return graph.build_edges(rows, graph.build_nodes(rows))


@query
def kg_stats(spark, sf_dir):
    nodes, edges = _article_graph(spark, sf_dir)
    return graph.graph_stats(nodes, graph.merge_edges(edges))


@query
def kg_centrality(spark, sf_dir):
    nodes, edges = _article_graph(spark, sf_dir)
    return graph.centrality(nodes, graph.merge_edges(edges))


def _supply(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    nodes, edges = adapters.supply_graph(spark, sf_dir)
    return nodes, cut_lineage(edges, "supply")


@query
def kg_shortest_path(spark, sf_dir):
    _, edges = _supply(spark, sf_dir)
    found = graph_queries.shortest_path(edges, PATH_FROM, PATH_TO)
    return rounded(found.select(flat("path").alias("path"), "length"))


@query
def kg_neighbors(spark, sf_dir):
    _, edges = adapters.supply_graph(spark, sf_dir)
    return graph_queries.neighbors(edges, HUB)


@query
def kg_subgraph(spark, sf_dir):
    """The graph among suppliers, nations and regions."""
    nodes, edges = adapters.supply_graph(spark, sf_dir)
    members = nodes.filter(F.col("type").isin("supplier", "nation", "region"))
    return graph_queries.subgraph(nodes, edges, members)


@query
def kg_impact(spark, sf_dir):
    _, edges = adapters.supply_graph(spark, sf_dir)
    return rounded(graph_queries.impact(edges))


@query
def kg_causal_paths(spark, sf_dir):
    nodes, edges = _supply(spark, sf_dir)
    found = graph_queries.causal_paths(edges, PATH_TO, nodes=nodes)
    return rounded(
        found.select(
            flat("path").alias("path"), "length",
            flat(F.transform("edges", lambda e: e["relation"])).alias("relations"),
            F.aggregate("edges", F.lit(0.0), lambda a, e: a + e["weight"]).alias("weight_sum"),
        )
    )


@query
def daily_graph(spark, sf_dir):
    rows = cut_lineage(daily_rows(spark, sf_dir).withColumn("day", day_text("event_ts")), "daily-graph")
    nodes, edges = graph.daily_graph(rows)
    days = rows.select(F.col("event_id").alias("source"), "day")
    by_day = edges.join(days, "source")
    # node and edge counts of each day's own graph
    ends = by_day.select("day", F.explode(F.array("source", "target")).alias("id"))
    own = rows.select("day", F.col("event_id").alias("id"))
    n_nodes = own.unionByName(ends).distinct().groupBy("day").agg(F.count("*").alias("n_nodes"))
    n_edges = by_day.groupBy("day").agg(
        F.count("*").alias("n_edges"), F.round(F.sum("weight"), 4).alias("weight_sum")
    )
    return n_nodes.join(n_edges, "day", "left").select(
        "day", "n_nodes", F.coalesce("n_edges", F.lit(0)).alias("n_edges"),
        F.coalesce("weight_sum", F.lit(0.0)).alias("weight_sum"),
    )


@query
def graph_upsert(spark, sf_dir):
    """Articles stream into the stored graph, then a revision of the month's second half."""
    root = scratch_dir(spark, "graph")

    def tagged(batch: DataFrame) -> DataFrame:
        return nlp.score_sentiment(enrich.extract_entities(adapters.articles_of(batch)), POSITIVE, NEGATIVE)

    write = sinks.prepared(sinks.graph_writer(root), tagged)
    sinks.run_batches(streams.stream_table(spark, sf_dir, "documents"), write, "graph")
    middle = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    revised = _tagged(spark, sf_dir).filter(F.col("event_ts") >= middle)
    sinks.graph_writer(root)(revised, 1)
    return sinks.stored_edges(spark, root)


# ---- features and signals ------------------------------------------------


@query
def feat_extract(spark, sf_dir):
    """Features of all articles; vectors come from the embedding table by id."""
    narrow = flows.tag(articles(spark, sf_dir), POSITIVE, NEGATIVE)
    base = features.extract_features(narrow).drop("has_embedding", "embedding_mean", "embedding_std")
    vectors = adapters.table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("string").alias("event_id"), "embedding",
        F.lit("").alias("content"),
    )
    stats = features.extract_features(vectors).select(
        "event_id", "has_embedding", "embedding_mean", "embedding_std"
    )
    joined = base.join(stats, "event_id", "left")
    return rounded(
        joined.drop("event_ts", "language", "source_name").withColumn(
            "has_embedding", F.coalesce("has_embedding", F.lit(0))
        )
    )


@query
def feat_aggregate(spark, sf_dir):
    return rounded(features.aggregate_features(feature_rows(spark, sf_dir), "source_name", "language"))


@query
def daily_features(spark, sf_dir):
    by_day = features.daily_features(daily_rows(spark, sf_dir))
    return rounded(by_day.withColumn("day", day_text("day")))


@query
def signals_(spark, sf_dir):
    per_source = features.aggregate_features(feature_rows(spark, sf_dir), "source_name", "language")
    return rounded(signals.generate_signals(per_source, "source_name", "language"))


@query
def daily_signals(spark, sf_dir):
    by_day = features.daily_features(daily_rows(spark, sf_dir), "language")
    return rounded(signals.generate_daily_signals(by_day, "language", "day").withColumn("day", day_text("day")))


@query
def signals_7d(spark, sf_dir):
    rolled = signals.rolling_signals(feature_rows(spark, sf_dir), "language")
    return rounded(rolled.withColumn("day", day_text("day")))


@query
def signal_filter(spark, sf_dir):
    by_day = features.daily_features(feature_rows(spark, sf_dir), "language")
    kept = signals.filter_signals(signals.generate_daily_signals(by_day, "language", "day"))
    return rounded(kept.withColumn("day", day_text("day")))


@query
def feature_snapshot(spark, sf_dir):
    rows = cut_lineage(feature_rows(spark, sf_dir), "features")
    grouped = signals.with_signals(features.aggregate_features(rows, "language"))
    snap = features.snapshot(rows, grouped, "language", RUN_TS)
    path = scratch_dir(spark, "snapshots")
    snap.write.partitionBy("timestamp").parquet(path)
    latest = features.latest_snapshot(spark.read.schema(snap.schema).parquet(path))
    return rounded(
        latest.select(
            "event_id", "language", "features.sentiment_score", "features.entity_count",
            F.size("signals").alias("n_signals"),
            flat(F.transform("signals", lambda s: s["type"])).alias("signal_types"),
            "aggregates.avg_sentiment", "aggregates.total_events",
            F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
        )
    )


# ---- similarity ----------------------------------------------------------


def _vectors(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Query vectors are the mean vector of each label: few, whatever the table's size."""
    corpus = adapters.table(spark, sf_dir, "embeddings")
    return cut_lineage(similarity.label_centroids(corpus), "centroids"), corpus


def _hits(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    queries, corpus = _vectors(spark, sf_dir)
    return similarity.top_k(queries, corpus, 20, query_id="query_id", **options)


@query
def sim_topk(spark, sf_dir):
    return rounded(_hits(spark, sf_dir))


def _indexed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, vector_index.VectorIndex]:
    """Queries are the rows whose id is divisible by 20, searched against all rows in a stored index."""
    corpus = adapters.table(spark, sf_dir, "embeddings")
    return corpus.where("vec_id % 20 = 0"), vector_index.build_index(corpus, scratch_dir(spark, "vector-index"))


@query
def sim_lsh(spark, sf_dir):
    """Hits in the probed cells of the stored index."""
    queries, index = _indexed(spark, sf_dir)
    return rounded(vector_index.search_index(queries, index, 20, skip_self=True))


@query
def sim_index(spark, sf_dir):
    """The same made exact by a second look at the cells that could hold a better hit."""
    queries, index = _indexed(spark, sf_dir)
    return rounded(vector_index.search_index(queries, index, 20, skip_self=True, exact=True))


@query
def sim_recall(spark, sf_dir):
    """How many of the exact hits the probed cells give, and whether that is nine in ten at least."""
    queries, index = _indexed(spark, sf_dir)
    found = vector_index.search_index(queries, index, 20, skip_self=True).select("query_id", "hit_id", F.lit(1).alias("found"))
    exact = similarity.top_k(queries, adapters.table(spark, sf_dir, "embeddings"), 20, skip_self=True)
    return exact.join(found, ["query_id", "hit_id"], "left").agg(
        F.count_distinct("query_id").alias("n_queries"), F.count("*").alias("n_hits"),
        (10 * F.coalesce(F.sum("found"), F.lit(0)) >= 9 * F.count("*")).alias("recall_reached"),
    )


@query
def sim_match(spark, sf_dir):
    return rounded(similarity.match(_hits(spark, sf_dir), MATCH_AT))


@query
def sim_outcomes(spark, sf_dir):
    matched = similarity.match(_hits(spark, sf_dir), MATCH_AT)
    return rounded(
        similarity.attach_outcomes(matched).withColumn("asset_classes", flat("asset_classes")).drop("match_count")
    )


@query
def sim_links(spark, sf_dir):
    matched = similarity.attach_outcomes(similarity.match(_hits(spark, sf_dir), MATCH_AT))
    path = scratch_dir(spark, "links")
    similarity.similarity_links(matched, RUN_TS).write.mode("append").parquet(path)
    return rounded(spark.read.parquet(path).withColumn("asset_classes", flat("asset_classes")))


@query
def impact(spark, sf_dir):
    scored = similarity.impact_scores(_hits(spark, sf_dir))
    return rounded(scored.withColumn("affected_assets", flat("affected_assets")))


@query
def analogs(spark, sf_dir):
    per_source = features.aggregate_features(feature_rows(spark, sf_dir), "source_name")
    return rounded(similarity.analogs(per_source, "source_name"))


# ---- learning and explanation --------------------------------------------


@query
def ml_split(spark, sf_dir):
    return rounded(
        learn.encode_and_split(feature_rows(spark, sf_dir)).select("event_id", "label", "is_train")
    )


def _predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class read from the whole text, and the one read from the title alone."""

    def cls(body: Column) -> Column:
        return learn.class_of(nlp.sentiment_of(body, POSITIVE, NEGATIVE)["label"])

    return articles(spark, sf_dir).select(
        "event_id", cls(t.title_and_content()).alias("label"), cls(t.col_or_blank("title")).alias("pred")
    )


@query
def ml_train(spark, sf_dir):
    """What a run of the training says that does not hang on the forest, and whether it learned anything."""
    rows = cut_lineage(feature_rows(spark, sf_dir), "features")
    metrics = learn.train_forest(rows)[1]
    shares = learn.encode_and_split(rows).where("NOT is_train").groupBy("label").agg(F.count("*").alias("n"))
    majority = shares.agg(F.max("n") / F.sum("n")).scalar()
    return rounded(
        metrics.select(
            "status", "train_samples", "test_samples", "feature_dim",
            (F.col("test_accuracy") >= F.round(majority, 4)).alias("beats_majority"),
        )
    )


@query
def ml_evaluate(spark, sf_dir):
    return rounded(learn.evaluate(_predictions(spark, sf_dir)))


@query
def ml_confusion(spark, sf_dir):
    return rounded(learn.confusion(_predictions(spark, sf_dir)))


@query
def ml_registry(spark, sf_dir):
    root = scratch_dir(spark, "registry")
    model, metrics = learn.train_forest(feature_rows(spark, sf_dir), trees=10)
    row = metrics.first().asDict()
    learn.register_model(model, root, row, {"trees": 10}, RUN_TS)
    listed = learn.list_models(spark, root)
    again = listed.first()["model_id"]
    return listed.select(
        "registered_at", "params", F.get_json_object("metrics", "$.train_samples").cast("long").alias("train_samples"),
        F.get_json_object("metrics", "$.test_samples").cast("long").alias("test_samples"),
        F.lit(learn.get_model(spark, root, again).count() == 1).alias("found"),
    )


@query
def explain_shapley(spark, sf_dir):
    rows = cut_lineage(feature_rows(spark, sf_dir), "features")
    model, _ = learn.train_forest(rows, trees=20)
    return explain.attribute(model, rows, explain.background_of(rows))


@query
def explain_text(spark, sf_dir):
    per_source = features.aggregate_features(feature_rows(spark, sf_dir), "source_name")
    return rounded(
        explain.explain(signals.with_signals(per_source), "source_name", RUN_TS)
        .withColumn("key_factors", flat("key_factors"))
        .withColumn("active_signals", flat("active_signals"))
    )


@query
def explain_flow(spark, sf_dir):
    """Train, predict, attribute, and explain each source with its strongest feature and its paths."""
    rows = cut_lineage(feature_rows(spark, sf_dir), "features")
    return rounded(
        flows.explain_flow(rows, _article_graph(spark, sf_dir)[1], RUN_TS)
        .withColumn("key_factors", flat("key_factors"))
        .withColumn("active_signals", flat("active_signals"))
    )


# ---- forecasts and back-tests --------------------------------------------


def _language_aggregates(rows: DataFrame) -> DataFrame:
    return signals.with_signals(features.aggregate_features(rows, "language"))


@query
def fc_drift(spark, sf_dir):
    return rounded(
        forecast.drift_forecast(_language_aggregates(feature_rows(spark, sf_dir)), "language", run_date=RUN_TS[:10])
    )


@query
def fc_linear(spark, sf_dir):
    return rounded(forecast.linear_forecast(adapters.daily_values(spark, sf_dir)))


@query
def fc_growth(spark, sf_dir):
    return rounded(forecast.growth_forecast(adapters.daily_values(spark, sf_dir)))


@query
def fc_ensemble(spark, sf_dir):
    """Linear, growth and drift forecasts of each language's daily sentiment."""
    rows = cut_lineage(feature_rows(spark, sf_dir), "features")
    series = flows.signal_series(rows, "language", START)
    drift = forecast.drift_forecast(_language_aggregates(rows), "language", run_date=RUN_TS[:10]).select(
        F.col("language").alias("series_id"), F.lit("drift").alias("model"),
        F.col("day").alias("step"), F.col("predicted_sentiment").alias("value"),
    )
    models = (
        forecast.linear_forecast(series).drop("trend")
        .unionByName(forecast.growth_forecast(series))
        .unionByName(drift)
    )
    return rounded(forecast.ensemble(models), 4)


def _positions(rows: DataFrame) -> DataFrame:
    """Strategies are languages: their daily signals set the position."""
    by_day = cut_lineage(features.daily_features(rows, "language"), "days").withColumnRenamed(
        "language", "strategy_id"
    )
    fired = signals.generate_daily_signals(by_day, "strategy_id", "day")
    return backtest.positions(fired, by_day.select("strategy_id", "day"))


def _accounts(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> DataFrame:
    rows = feature_rows(spark, sf_dir) if rows is None else rows
    return backtest.simulate(_positions(rows).join(adapters.daily_prices(spark, sf_dir), "day"))


@query
def bt_positions(spark, sf_dir):
    return rounded(_positions(feature_rows(spark, sf_dir)).withColumn("day", day_text("day")))


@query
def bt_equity(spark, sf_dir):
    return rounded(backtest.equity(_accounts(spark, sf_dir)))


@query
def bt_trades(spark, sf_dir):
    return rounded(backtest.trades(_accounts(spark, sf_dir)), 4)


@query
def bt_metrics(spark, sf_dir):
    return rounded(backtest.risk_metrics(backtest.trades(_accounts(spark, sf_dir))), 4)


@query
def bt_metrics_fixed(spark, sf_dir):
    return rounded(backtest.risk_metrics(backtest.trades(_accounts(spark, sf_dir)), mode="fixed"), 4)


@query
def bt_report(spark, sf_dir):
    rows = cut_lineage(feature_rows(spark, sf_dir), "features")
    accounts = cut_lineage(_accounts(spark, sf_dir, rows), "accounts")
    trends = forecast.with_trend(_language_aggregates(rows)).select(
        F.col("language").alias("strategy_id"), "trend", F.lit(forecast.HORIZON).alias("horizon_days")
    )
    return rounded(backtest.report(accounts, trends).drop("report"), 4)


# ---- streams -------------------------------------------------------------


@query
def stream_dedup(spark, sf_dir):
    stream = adapters.articles_of(streams.stream_table(spark, sf_dir, "documents"))
    narrow = stream.select("event_id", "event_ts", "title", "url")
    return streams.drain(streams.dedup_stream(narrow, "40 days"), "dedup").select("dedup_key", "title")


@query
def stream_dedup_keyed(spark, sf_dir):
    """The same with a state per key that outlives any watermark."""
    stream = adapters.articles_of(streams.stream_table(spark, sf_dir, "documents"))
    narrow = stream.select("event_id", "event_ts", "title", "url")
    with keyed.settings(spark):
        return streams.drain(keyed.dedup_stream_keyed(narrow), "dedup-keyed").select("dedup_key", "title")


@query
def stream_transform(spark, sf_dir):
    marked = streams.mark_processed(streams.stream_table(spark, sf_dir, "events"), "ts")
    return streams.drain(marked, "transform").select(
        "event_id", "event_type", "stream_processed", (F.col("processing_latency_ms") > 0).alias("waited")
    )


@query
def stream_signals(spark, sf_dir):
    stream = adapters.articles_of(streams.stream_table(spark, sf_dir, "documents"))
    rows = flows.feature_rows(stream, POSITIVE, NEGATIVE)
    out = streams.drain(streams.windowed_signals(rows, "language"), "signals")
    return rounded(
        out.withColumns({"window_start": stamp("window_start"), "window_end": stamp("window_end")})
    )


@query
def stream_signals_daily(spark, sf_dir):
    """Tumbling days: the first step of the seven-day windows as an output of its own."""
    stream = adapters.articles_of(streams.stream_table(spark, sf_dir, "documents"))
    rows = flows.feature_rows(stream, POSITIVE, NEGATIVE)
    out = streams.drain(streams.windowed_signals(rows, "language", length="1 day"), "signals-daily")
    return rounded(
        out.withColumns({"window_start": stamp("window_start"), "window_end": stamp("window_end")})
    )


@query
def stream_realtime(spark, sf_dir):
    """Short texts arrive live and are scored against the stored index of the embedded documents."""
    dim = 64
    corpus = cut_lineage(flows.live_scoring(articles(spark, sf_dir), dim), "corpus")
    live = streams.stream_table(spark, sf_dir, "benchmark").select(
        F.concat(F.lit("live:"), F.col("item_id").cast("string")).alias("event_id"),
        adapters.arrival_time(F.col("item_id")).alias("event_ts"),
        F.lit("").alias("title"),
        F.col("text").alias("content"),
    )
    out = scratch_dir(spark, "live")
    index = vector_index.build_index(corpus, scratch_dir(spark, "live-index"), "event_id")
    sinks.run_batches(flows.live_scoring(live, dim), sinks.scoring_writer(index, out), "live")
    return spark.read.parquet(f"{out}/impact").select("query_id", "impact_score", "impact_level", "time_to_market")


@query
def stream_out(spark, sf_dir):
    """Event rows as push messages, read back from the sink."""
    stream = streams.stream_table(spark, sf_dir, "events").select("event_id", "event_type", "user_id", "value", "ts")
    sent = streams.drain(sinks.envelope(stream, "streaming_out", "ts"), "out")
    back = (
        "type string, pipeline string, event_id string, "
        "data struct<event_type:string,user_id:bigint,value:double>, timestamp string"
    )
    return sent.select("key", F.from_json("value", back).alias("m")).select(
        "key", "m.type", "m.pipeline", "m.data.event_type", "m.data.user_id", "m.data.value", "m.timestamp"
    )


@query
def sink_tables(spark, sf_dir):
    """Feature rows streamed into a table partitioned by day, counted from the table."""
    path = scratch_dir(spark, "sink")

    def rows(batch: DataFrame) -> DataFrame:
        found = flows.feature_rows(adapters.articles_of(batch), POSITIVE, NEGATIVE)
        return found.withColumn("day", F.to_date("event_ts"))

    write = sinks.prepared(sinks.batch_writer(path, "day"), rows)
    sinks.run_batches(streams.stream_table(spark, sf_dir, "documents"), write, "sink")
    return (
        spark.read.parquet(path)
        .groupBy(day_text("day").alias("day"))
        .agg(F.count("*").alias("n_rows"), F.sum(F.col("text_length").cast("long")).alias("n_chars"))
    )


# ---- flows and run log ---------------------------------------------------


@query
def daily_flow(spark, sf_dir):
    out = flows.daily_flow(articles(spark, sf_dir), POSITIVE, NEGATIVE)
    return rounded(out["signals"].withColumn("day", day_text("day")))


@query
def daily_store(spark, sf_dir):
    """The daily flow's tables, stored by day and read back: rows of each table and day."""
    root = scratch_dir(spark, "daily-store")
    schemas = flows.store_daily(flows.daily_flow(articles(spark, sf_dir), POSITIVE, NEGATIVE), root)
    counts = [
        spark.read.schema(schemas[name]).parquet(f"{root}/{name}").groupBy(day_text("day").alias("day"))
        .agg(F.count("*").alias("n")).select(F.lit(name).alias("table"), "day", "n")
        for name in flows.DAILY_TABLES
    ]
    return transform.union_sources(counts)


@query
def similarity_text_flow(spark, sf_dir):
    """Short texts against the documents, from text to stored links: embed, search, match, link."""
    live = adapters.table(spark, sf_dir, "benchmark").select(
        F.concat(F.lit("live:"), F.col("item_id").cast("string")).alias("event_id"), F.lit("").alias("title"), F.col("text").alias("content")
    )
    links = flows.similarity_text_flow(live, articles(spark, sf_dir), RUN_TS, MATCH_AT, dim=64)
    return rounded(links.withColumn("asset_classes", flat("asset_classes")))


@query
def ingest_flow(spark, sf_dir):
    """Landed responses, feeds and payloads, each read, cleaned or mapped, and united."""
    rows = articles(spark, sf_dir)
    paths = {name: scratch_dir(spark, name) for name in ("gdelt", "newsapi", "rss", "webhook")}
    landing.land_gdelt(rows, paths["gdelt"])
    landing.land_newsapi(rows, paths["newsapi"])
    landing.land_rss(rows, paths["rss"])
    landing.land_payloads(adapters.table(spark, sf_dir, "conversations"), paths["webhook"])
    found = flows.ingest_flow(spark, paths, CONVERSATION, RUN_TS)
    return found.groupBy("source", "event_type").agg(F.count("*").alias("n"), F.count_distinct("title").alias("n_titles"))


@query
def similarity_flow(spark, sf_dir):
    queries, corpus = _vectors(spark, sf_dir)
    links = flows.similarity_flow(queries, corpus, RUN_TS, MATCH_AT, query_id="query_id")
    return rounded(links.withColumn("asset_classes", flat("asset_classes")))


@query
def news_flow(spark, sf_dir):
    news = flows.news_flow([articles(spark, sf_dir), adapters.page_articles(spark, sf_dir)])
    return rounded(
        news.select(
            "event_id", "source", flat("categories").alias("categories"), "category_count", "source_credibility"
        )
    )


@query
def runs_summary(spark, sf_dir):
    return rounded(runs.summary(runs.with_duration(adapters.run_log(spark, sf_dir)), "pipeline"))


@query
def runs_recent(spark, sf_dir):
    """The ten latest runs and the ten latest failures."""
    log = adapters.run_log(spark, sf_dir)
    both = runs.recent(log).withColumn("list", F.lit("recent")).unionByName(
        runs.recent(runs.failures(log)).withColumn("list", F.lit("failed"))
    )
    return runs.with_duration(both).select(
        "list", "run_id", "pipeline", "status", stamp("started_at").alias("started_at"),
        F.round("duration_ms", 3).alias("duration_ms"), "error",
    )
