import hashlib

from pyspark.sql import functions as F

from tidewire.operators import clean
from tidewire.operators.seen import BLOCK_BITS, SeenStore
from tidewire.session import scratch_dir


def keys(spark, *ranges):
    rows = [(hashlib.md5(str(i).encode()).hexdigest(), i) for r in ranges for i in r]
    return spark.createDataFrame(rows, "dedup_key string, n int")


def store(spark, **options):
    return SeenStore(spark, scratch_dir(spark, "seen-store"), **{"blocks": 64, "parts": 64} | options)


def test_same_rows_as_an_anti_join(spark):
    held = store(spark)
    batch = keys(spark, range(0, 900))
    assert sorted(r.n for r in held.unseen(batch).collect()) == list(range(900))
    held.append(keys(spark, range(100, 400)), "a")
    held.append(keys(spark, range(300, 600)), "b")
    got = held.unseen(batch)
    assert got.columns == batch.columns
    assert sorted(r.n for r in got.collect()) == [*range(100), *range(600, 900)]


def test_a_run_written_again_replaces_itself(spark):
    held = store(spark)
    for _ in range(2):
        held.append(keys(spark, range(50)), "only")
    assert held.keys().count() == 50


def test_every_seen_key_is_suspected_and_few_others(spark):
    held = store(spark)
    held.append(keys(spark, range(20_000)), "a")
    seen = held.suspects(keys(spark, range(20_000)))
    assert seen.where("maybe").count() == 20_000
    assert held.suspects(keys(spark, range(20_000, 40_000))).where("maybe").count() < 200  # 100 bits for each key


def test_bits_are_where_the_bitmaps_have_them(spark):
    """The block's bitmap has exactly the bits that the key names."""
    held = store(spark, blocks=1)
    held.append(keys(spark, range(1)), "a")
    want = set(keys(spark, range(1)).select(held._bits(F.col("dedup_key")).alias("b")).first().b)
    bits = bytes(spark.read.parquet(f"{held.path}/bits").first().bits)
    assert {i for i in range(BLOCK_BITS) if bits[i // 8] >> (i % 8) & 1} == want


def test_new_keys_read_little_history(spark):
    held = store(spark)
    held.append(keys(spark, range(3000)), "a")
    batch = keys(spark, range(5000, 5200), range(7, 9))
    got = held.unseen(batch)
    assert got.count() == 200
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [part" in plan
    parts = {r.part for r in held.suspects(batch).where("maybe").select("part").collect()}
    read = held.keys().where(F.col("part").isin(sorted(parts))).count()
    assert 2 <= read < 0.25 * held.keys().count()


def test_dedup_against_a_store_equals_a_key_table(spark, make_articles):
    rows = make_articles(*[{"title": f"t{i % 7}", "content": "c" * i} for i in range(20)])
    old = clean.dedup(make_articles({"title": "t1"}, {"title": "t4"}, {"title": "zz"}))
    held = store(spark)
    held.append(old, "old")
    ids = lambda df: sorted(r.event_id for r in df.collect())
    want = ids(clean.dedup_against_history(rows, old.select("dedup_key")))
    assert ids(clean.dedup_against_store(rows, held)) == want == ["0", "2", "3", "5", "6"]


def test_texts_pass_one_shuffle_and_no_aggregate(spark, make_articles):
    import datetime

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        t0 = datetime.datetime(2024, 1, 1)
        rows = make_articles(*[{"event_id": "same", "event_ts": t0, "title": "t", "content": "copy"}] * 3, {"title": None, "content": "x"})
        out = clean.clean(rows.withColumn("content", F.concat(F.col("content"), F.lit(" and so on, at length"))))
        got = out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(got) == 2
    assert all("content" not in line for line in plan.splitlines() if "Aggregate" in line)
    assert sum("Exchange hashpartitioning(_row" in line for line in plan.splitlines()) <= 2  # the rows, and the winners' names
    assert "Exchange hashpartitioning(dedup_key" in plan


def test_counts_come_with_the_pass_that_writes(spark, make_articles):
    from pyspark.sql import Observation

    from tidewire.streaming import sinks

    rows = make_articles(*[{"title": f"t{i % 7}", "content": "c", "language": "ab"[i % 2]} for i in range(20)])
    for broadcast in ("-1", "10m"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
        try:
            counts = Observation()
            path = scratch_dir(spark, "counted")
            assert sinks.write_counted(clean.dedup(rows, counts=counts), path, "language") == 7
            want = clean.dedup_counts(rows).first()
            assert counts.get == {"kept": want.kept, "skipped": want.skipped} == {"kept": 7, "skipped": 13}
            assert spark.read.parquet(path).count() == 7
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sinks.write_counted(rows.where("false"), scratch_dir(spark, "counted"), "language") == 0
