"""Times the catalogue's queries and prints one JSON line.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS`` (default 8) and
``BENCH_QUERIES`` (comma-separated names, default: the headline set; ``all`` for
every query). Each query runs to a sink that consumes all rows and columns; the
best of ``BENCH_RUNS`` (default 2) timings counts, the first one warms up.
"""

from __future__ import annotations

import json
import os
import sys
import time

from tidewire import build_session
from tidewire.plans.catalog import QUERIES

HEADLINE = [
    "src_gdelt", "src_rss", "clean_dedup", "clean_chain", "enrich_geo", "enrich_entities", "enrich_temporal",
    "nlp_entities", "nlp_sentiment", "nlp_summary", "nlp_embed", "intel_conflict", "intel_economic",
    "news_classify", "watchlist_mentions", "kg_nodes", "kg_edges", "kg_stats", "kg_centrality",
    "kg_shortest_path", "kg_causal_paths", "kg_impact", "feat_extract", "feat_aggregate", "signals",
    "signals_7d", "feature_snapshot", "sim_topk", "sim_lsh", "similarity_flow", "ml_train", "explain_shapley",
    "fc_linear", "fc_ensemble", "bt_equity", "bt_metrics", "stream_dedup", "stream_signals", "stream_realtime",
    "graph_upsert", "daily_flow", "news_flow", "runs_summary",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else [n for n in chosen.split(",") if n] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds: dict[str, float] = {}
    for name in names:
        times = []
        for _ in range(runs):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(min(times), 3)
        print(name, [round(x, 2) for x in times], file=sys.stderr, flush=True)
    spark.stop()
    result = {
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
