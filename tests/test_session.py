"""The checkpoint folder: named by the cluster, made only for a local master."""

from types import SimpleNamespace

import pytest

from costmart.session import ensure_checkpoint_dir


class Context:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def session(master, conf=None):
    return SimpleNamespace(sparkContext=Context(master), conf=SimpleNamespace(get=lambda key, default: conf or default))


def test_cluster_without_a_folder_is_an_error():
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,512]", "k8s://host"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            ensure_checkpoint_dir(session(master))


def test_named_folder_is_used_and_local_gets_one():
    named = session("yarn", "hdfs:///shared")
    assert ensure_checkpoint_dir(named) == "hdfs:///shared" == named.sparkContext.folder
    local = session("local[4]")
    assert ensure_checkpoint_dir(local) == local.sparkContext.folder


def test_scratch_goes_with_its_scope(spark):
    import os

    from costmart.session import ensure_checkpoint_dir, materialize, scratch_scope

    base = ensure_checkpoint_dir(spark).removeprefix("file:").rstrip("/") + "/costmart-scratch"
    there = lambda tag: [d for d in os.listdir(base) if d.startswith(tag)]
    with scratch_scope(spark):
        materialize(spark.range(3), "outer-gone")
        with scratch_scope(spark):
            materialize(spark.range(3), "inner-gone")
            kept = materialize(spark.range(3), "inner-kept", keep=True)
        assert not there("inner-gone") and kept.count() == 3
        last = materialize(kept.selectExpr("id + 1 as id"), "outer-kept", keep=True)
    assert not there("outer-gone") and not there("inner-kept") and sorted(r.id for r in last.collect()) == [1, 2, 3]
    assert materialize(spark.range(2), "no-scope").count() == 2


def test_shuffles_go_once_written(spark):
    import time

    from costmart.session import materialize, shuffles_released

    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(name, None)
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {x for x in disk.getAllBlocks().mkString(" ").split() if x.startswith("shuffle_")}
    before = files()
    with shuffles_released(spark):
        out = materialize(spark.range(1000).repartition(3, "id").groupBy("id").count(), "released")
    until = time.time() + 20
    while files() - before and time.time() < until:
        time.sleep(0.2)
    assert not files() - before and out.count() == 1000
    assert spark.conf.get(name, None) == was


def test_lookup_tables_are_broadcast_by_counted_bytes(spark):
    from costmart.session import broadcast_up_to

    def hinted(df, most):
        return "strategy=broadcast" in broadcast_up_to(df, most)._jdf.queryExecution().analyzed().toString()

    keys = spark.range(1000)  # 16 bytes a row
    assert hinted(keys, 16_000) and not hinted(keys, 15_999)
    texts = spark.createDataFrame([("é" * 50, 1), (None, 2)], "t string, n int")  # 40 bytes a row and 100 of text
    assert hinted(texts, 180) and not hinted(texts, 179)
    assert hinted(texts.limit(0), 0)
    money = keys.selectExpr("cast(id as decimal(28,10)) as m")
    assert hinted(money, 32_000) and not hinted(money, 31_999)


def test_reports_leave_only_their_result(spark, sf_dir):
    import os

    from costmart.catalog import QUERIES
    from costmart.session import ensure_checkpoint_dir

    base = ensure_checkpoint_dir(spark).removeprefix("file:").rstrip("/") + "/costmart-scratch"
    for name, kept in (("cost_reports", {"cost-reports"}), ("describe_numeric", set()), ("fuzzy_best_match", {"fuzzy-best"})):
        before = set(os.listdir(base))
        QUERIES[name](spark, sf_dir).collect()
        new = {d.rsplit("-", 1)[0] for d in set(os.listdir(base)) - before}
        assert new - {"choices", "priced-items", "gsn-modal"} == kept, name


def test_compressed_files_are_not_taken_for_small_tables(spark, tmp_path):
    """A table of 1.5 million keys, 6 MB of Parquet, is no side to broadcast by its file size."""
    from costmart.operators.joins import join_inner_using
    from costmart.session import apply_core_conf

    spark.range(1_500_000).coalesce(1).write.parquet(f"{tmp_path}/keys")
    keys = apply_core_conf(spark).read.parquet(f"{tmp_path}/keys")
    plan = join_inner_using(keys, keys.selectExpr("id + 5 as id"), "id")._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" not in plan


def test_shuffles_grow_with_the_tables(spark, tmp_path):
    from costmart.session import size_shuffles

    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before, least = spark.conf.get(name, None), int(spark.conf.get("spark.sql.shuffle.partitions"))
    try:
        for size in (0, 100, 100_000):
            (tmp_path / "t.parquet").write_bytes(b"x" * size)
            assert size_shuffles(spark, str(tmp_path), 1000) == max(least, size // 1000) == int(spark.conf.get(name))
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def test_registered_queries_size_their_shuffles(spark, sf_dir):
    import __spark_entry__ as entry

    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = spark.conf.get(name, None)
    try:
        spark.conf.unset(name)
        entry.queries()["dim_admission"](spark, sf_dir)
        assert int(spark.conf.get(name)) >= int(spark.conf.get("spark.sql.shuffle.partitions"))
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def test_no_side_of_some_megabytes_is_broadcast(spark, tmp_path):
    """350,000 keys are 1.4 MB of Parquet and 5.6 MB of rows: neither size makes the driver hold them."""
    from costmart.operators.joins import join_inner_using
    from costmart.session import apply_core_conf

    spark.range(350_000).coalesce(1).write.parquet(f"{tmp_path}/keys")
    keys = apply_core_conf(spark).read.parquet(f"{tmp_path}/keys")
    n = join_inner_using(keys, keys.selectExpr("id + 5 as id"), "id").groupBy().count()
    assert n.first()[0] == 349_995
    assert "BroadcastHashJoin" not in n._jdf.queryExecution().executedPlan().toString()
