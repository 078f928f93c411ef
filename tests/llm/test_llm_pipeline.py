import hashlib
import os
import re

import pytest
from harness import differences, duck
from pyspark.sql import functions as F

import corpus_pipeline
from tidewire.llm import queries

NATIVE = ("op3_decision_list", "op5_virtual_slots", "op7_pseudonyms", "op8_redirect_classes")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracles(spark, sf_dir, name):
    assert differences(queries.QUERIES[name](spark, sf_dir), duck(sf_dir), queries.ORACLES[name]) == []


@pytest.mark.parametrize("name", NATIVE)
def test_native_queries_run_no_python(spark, sf_dir, name):
    plan = queries.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_every_operator_has_its_query(spark, sf_dir):
    assert [int(re.match(r"op(\d+)_", q)[1]) for q in queries.QUERIES] == list(range(1, 11))


def test_fingerprints_and_repeats_cover_the_table(spark, sf_dir):
    n = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    for name in ("op4_weighted_sampling", "op9_prefix_subtrees", "op10_quartile_digest"):
        got = queries.QUERIES[name](spark, sf_dir)
        assert got.count() == n and got.select("doc_id").distinct().count() == n


def words(i, n):
    return " ".join(hashlib.md5(f"{i}:{k}".encode()).hexdigest()[: 3 + k % 5] for k in range(n))


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    """Documents with a clashing extra column, nulls, copies and junk, and labels."""
    folder = str(tmp_path_factory.mktemp("small"))
    rows = [(i, words(i, 40 + i % 30), "en" if i % 2 else "fr", f"src{i % 4}", 0, "x") for i in range(120)]
    rows += [(200 + i, f"{words(1000 + i, 40)} mail ab.{i}@c.example.org card 4111111111111111", "en", "src1", 0, "x") for i in range(10)]
    rows += [(300 + i, rows[i][1], "en", "src0", 0, "y") for i in range(20)]  # copies
    rows += [(400 + i, rows[i][1] + " more", "en", "src0", 0, "y") for i in range(20)]  # near copies
    rows += [(500 + i, " ".join(w + "###" for w in words(500 + i, 50).split()), "en", "src2", 0, "z") for i in range(30)]  # junk
    rows += [(600, None, None, None, None, None), (None, words("n", 50), None, None, 0, None), (None, words("n", 50), None, None, 0, None), (601, "", "en", "src0", 0, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept string")
    docs.write.parquet(os.path.join(folder, "documents.parquet"))
    labels = [(i, 1, 0) for i in [*range(0, 120, 2), *range(200, 210)]] + [(500 + i, 0, 0) for i in range(0, 30)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(os.path.join(folder, "labels.parquet"))
    return folder


def test_stages_take_effect(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns = docs.columns
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, small)
        path = f"{small}/{name.replace(' ', '-')}"
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
        seen.append((name, before, docs))
    ids = {name: [r[0] for r in after.select("doc_id").collect()] for name, _, after in seen}
    good = ids["quality rules"]
    assert not any(i is not None and (500 <= i < 530 or i in (600, 601)) for i in good)
    assert {i for i in good if i is not None} == {*range(120), *range(200, 210), *range(300, 320), *range(400, 420)}
    once = ids["near duplicates"]
    assert sorted(i for i in once if i is not None) == [*range(120), *range(200, 210)] and once.count(None) == 1
    masked = {r["doc_id"]: r["text"] for r in seen[2][2].collect()}
    assert sorted(map(str, masked)) == sorted(map(str, once))
    assert all(f"ab.{i}@" not in masked[200 + i] and "4111111111111111" not in masked[200 + i] for i in range(10))
    mixed = seen[3][2]
    assert set(ids["source mix"]) <= set(once) and mixed.count() > 50
    last = seen[4][2]
    assert last.count() == mixed.count() and last.where("NOT exact OR n_tokens <> size(ids)").count() == 0


def test_run_of_an_empty_table(spark, small, tmp_path):
    spark.read.parquet(f"{small}/documents.parquet").where("false").write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{small}/labels.parquet").where("false").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_run_over_the_tables(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    assert out.count() > 0 and out.where(~F.col("exact")).count() == 0
