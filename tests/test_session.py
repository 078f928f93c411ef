import os
import threading

import pytest

from tidewire import session


class Conf:
    def __init__(self, **values):
        self.values = values

    def get(self, key, *default):
        return self.values.get(key, *default)


class Fake:
    def __init__(self, **values):
        self.conf = Conf(**values)


def test_scopes_of_two_threads_do_not_mix(spark):
    """Each thread's scope deletes what that thread wrote, while the other still reads its own."""
    kept, inside, done = {}, threading.Barrier(2), threading.Event()

    def batch(name):
        with session.scratch_scope(spark):
            kept[name] = session.scratch_dir(spark, name)
            spark.range(3).write.parquet(kept[name])
            inside.wait(60)
            if name == "second":
                done.wait(60)
                kept["read"] = spark.read.parquet(kept[name]).count()

    threads = [threading.Thread(target=batch, args=(n,)) for n in ("first", "second")]
    for thread in threads:
        thread.start()
    threads[0].join(60)
    assert not os.path.exists(kept["first"])
    done.set()
    threads[1].join(60)
    assert kept["read"] == 3 and not os.path.exists(kept["second"])


def test_nested_scopes_and_what_is_written_outside(spark):
    outside = session.scratch_dir(spark, "outside")
    spark.range(1).write.parquet(outside)
    with session.scratch_scope(spark):
        outer = session.cut_lineage(spark.range(2), "outer")
        with session.scratch_scope(spark):
            session.cut_lineage(spark.range(2), "inner")
        assert outer.count() == 2
    assert os.path.exists(outside)


def test_a_local_warehouse_is_no_scratch_folder_on_a_cluster():
    local = {"spark.sql.warehouse.dir": "file:/work/spark-warehouse"}
    assert session._shared_root(Fake(**local, **{"spark.master": "local[8]"})).endswith("_scratch")
    with pytest.raises(ValueError, match="checkpoint"):
        session._shared_root(Fake(**local, **{"spark.master": "spark://host:7077"}))
    assert session._shared_root(Fake(**{"spark.sql.warehouse.dir": "s3a://lake/wh", "spark.master": "yarn"})) == "s3a://lake/wh/_scratch"
    assert session._shared_root(Fake(**local, **{"spark.checkpoint.dir": "hdfs:///c", "spark.master": "yarn"})) == "hdfs:///c"
