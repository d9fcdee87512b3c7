"""Numbered ids and the bucketed star join."""

import pytest
from pyspark.sql import functions as F

from costmart.catalog import QUERIES
from costmart.functions import frames as FR
from costmart.operators import bucketed as B
from costmart.operators.joins import join_star
from costmart.session import scratch_path


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("partitions", [1, 5, 40])
def test_numbers_are_gapless_in_order_and_the_same_under_any_partitioning(spark, partitions):
    rows = [(None if i % 50 == 0 else (7 if i % 3 else i % 11), "ab"[i % 2], {"m": i % 2}) for i in range(1500)]  # a hot key with equal rows
    df = spark.createDataFrame(rows, "k int, s string, m map<string,int>").repartition(partitions + 1)
    got = sorted((r.row_id, (r.k is not None, r.k or 0, r.s)) for r in FR.numbered_id(df, ["k"], partitions=partitions).collect())
    assert [i for i, _ in got] == list(range(1, 1501))
    assert [key for _, key in got] == sorted((k is not None, k or 0, s) for k, s, _ in rows)


def test_numbering_uses_no_single_task_window_over_rows(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    plan = FR.numbered_id(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SinglePartition" not in plan


def test_numbering_an_empty_table(spark):
    assert FR.numbered_id(spark.createDataFrame([], "k int"), ["k"]).count() == 0


def star(spark):
    fact = spark.createDataFrame([(1, 10, 0.5), (2, 10, 1.5), (2, 11, 2.5), (3, None, 3.5), (None, 10, 4.5), (4, 99, 5.5)], "stay int, patient int, cost double")
    units = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b2"), (None, "z")], "unit int, unit_name string")
    patients = spark.createDataFrame([(10, "x"), (10, "y"), (11, "w"), (None, "n")], "pid int, race string")
    return fact, [("unit", units, "stay", "unit"), ("patient", patients, "patient", "pid")]


def test_bucketed_star_equals_the_plain_one(spark):
    """Nulls in keys, repeated dimension keys, a fact key that repeats with two values of the other key."""
    fact, dims = star(spark)
    tables = B.write_star(fact, dims, "stay", scratch_path(spark, "star"), 4)
    got = B.join_star_bucketed(spark, tables, [(d[0], d[2]) for d in dims], "stay").select("stay", "patient", "cost", "unit_name", "race")
    want = join_star(fact, [d[1:] for d in dims]).select("stay", "patient", "cost", "unit_name", "race")
    kept = want.where("stay is not null").unionByName(fact.where("stay is null"), allowMissingColumns=True)
    assert rows_of(got) == rows_of(kept)
    B.drop_star(spark, tables)


def test_bucketed_star_has_no_exchange(spark, sf_dir):
    out = QUERIES["join_star_bucketed"](spark, sf_dir)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = out.select("*").withColumn("again", F.lit(1))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("SortMergeJoin") == 3 and "Exchange" not in plan and "SelectedBucketsCount: 8 out of 8" in plan
