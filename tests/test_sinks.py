"""Writers (K1-K8): overwrite, schema guard, partitioning, counts, run log."""

import os

import pytest
from pyspark.sql import functions as F

from chainsight.sinks import writers as W


def test_write_counted_partitioned_and_read_back(spark, tmp_dir):
    df = spark.createDataFrame([(i, ["A", "B", "C"][i % 3]) for i in range(30)], "id int, market string")
    path = os.path.join(tmp_dir, "t")
    assert W.write_counted(df, path, partition_by="market") == 30
    assert {"market=A", "market=B", "market=C"} <= set(os.listdir(path))
    assert W.read_back_count(spark, path) == 30
    # overwrite replaces
    assert W.write_counted(df.limit(5), path) == 5
    assert W.read_back_count(spark, path) == 5


def test_schema_guard(spark, tmp_dir):
    path = os.path.join(tmp_dir, "g")
    W.overwrite_same_schema(spark, spark.createDataFrame([(1, "a")], "id int, v string"), path)
    W.overwrite_same_schema(spark, spark.createDataFrame([(2, "b")], "id int, v string"), path)
    with pytest.raises(W.SchemaMismatch):
        W.overwrite_same_schema(spark, spark.createDataFrame([(2, 1.0)], "id int, v double"), path)
    assert spark.read.parquet(path).first().v == "b"


def test_run_log_history(spark, tmp_dir):
    log = os.path.join(tmp_dir, "log")
    W.log_run(spark, log, "silver", "/t/silver", "WRITE", 10, "1.0")
    W.log_run(spark, log, "gold", "/t/gold", "WRITE", 3, "1.0")
    W.log_run(spark, log, "silver", "/t/silver", "WRITE", 12, "1.0")
    hist = W.history(spark, log, "/t/silver").collect()
    assert [r.rows for r in hist] == [12, 10]


def test_publish_replaces_a_table_that_is_its_own_input(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    W.overwrite(spark.range(3), path)
    for _ in range(2):
        W.overwrite(spark.read.parquet(path).selectExpr("id + 1 AS id"), f"{path}.new")
        W.publish(spark, f"{path}.new", path)
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [2, 3, 4]
    assert os.listdir(tmp_dir) == ["t"]


def test_unreadable_target_is_no_new_table(spark, tmp_dir):
    from pyspark.errors import AnalysisException

    path = os.path.join(tmp_dir, "broken")
    os.makedirs(path)
    with pytest.raises(AnalysisException):
        W.overwrite_same_schema(spark, spark.range(1), path)
    assert W.existing_schema(spark, os.path.join(tmp_dir, "none")) is None


def test_run_log_time_does_not_depend_on_the_zone(spark, tmp_dir):
    log, before = os.path.join(tmp_dir, "log"), spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        W.log_run(spark, log, "silver", "/t", "WRITE", 1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert W.history(spark, log).selectExpr("abs(timestampdiff(MINUTE, logged_at, now())) < 5").first()[0]


def test_readers_never_miss_a_table_while_versions_are_published(spark, tmp_dir):
    import threading

    root, name = f"{tmp_dir}/t", "published_versions"
    versions = [W.new_version(root) for _ in range(6)]
    for i, v in enumerate(versions):
        W.overwrite(spark.range(100).selectExpr("id", f"{i} AS run", "id % 3 AS market"), v, partition_by="market")
    W.switch(spark, name, versions[0])
    seen, failed, done = [], [], threading.Event()

    def read():
        while not done.is_set():
            try:
                rows = spark.table(name).groupBy("run").count().collect()
                assert len(rows) == 1 and rows[0]["count"] == 100
                seen.append(rows[0].run)
            except Exception as e:  # noqa: BLE001
                failed.append(e)
    readers = [threading.Thread(target=read) for _ in range(3)]
    for t in readers:
        t.start()
    try:
        for v in versions[1:]:
            W.switch(spark, name, v)
            spark.table(name).count()
        # input = output: the next version is made from the present one
        more = W.new_version(root)
        W.overwrite(spark.table(name).withColumn("run", F.col("run") + 1), more, partition_by="market")
        W.switch(spark, name, more)
        assert spark.table(name).select("run").distinct().collect()[0].run == 6
    finally:
        done.set()
        for t in readers:
            t.join()
    assert not failed and len(seen) > 3
    assert len(W.drop_old_versions(spark, root, more)) == 4 and spark.table(name).count() == 100
    spark.sql(f"DROP VIEW {name}")
