"""Edge cases on tiny invented rows (FIXTURES.md §5)."""

import pytest
from pyspark.sql import functions as F

from costmart.functions import columns as C
from costmart.functions import frames as FR
from costmart.operators import nested as N
from costmart.operators import similarity as SIM
from costmart.operators import windows as W
from costmart.operators.impute import knn_impute
from costmart.plans import mart


def col_values(df, c):
    return [r[c] for r in df.orderBy("i").collect()]


def test_unit_type(spark):
    df = spark.createDataFrame([(1, "Ward A (WA/WB)"), (2, "Ward B"), (3, "Ward C ()"), (4, "Ward D (/X)"), (5, None)],
                               "i int, name string")
    assert col_values(df.withColumn("t", C.unit_type("name")), "t") == ["WA", None, None, "", None]


def test_resolve_code(spark):
    rx = spark.createDataFrame([(1, "d1", "12"), (2, "d1", "12, 13"), (3, "d9", "7 8"), (4, "d1", " "), (5, "d1", None),
                                (6, "d1", "13"), (7, "d1", "13 14")], "i int, drug string, gsn string")
    modal = mart.gsn_modal(rx)
    assert {r["drug_name"]: r["most_freq_gsn"] for r in modal.collect()}["d1"] == "13"
    out = FR.resolve_code(rx, "drug", "gsn", modal, "drug_name", "most_freq_gsn", "code")
    assert col_values(out, "code")[:5] == ["12", "13", "7", "00000", "00000"]


def test_bins(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([0, 18, 19, 40, 65, 66, 1000, None])], "i int, age int")
    assert col_values(df.withColumn("b", C.bin_labels("age")), "b") == \
        [None, "child", "adult", "adult", "senior", "elderly", None, None]


def test_cap_upper_keeps_null(spark):
    df = spark.createDataFrame([(0, 399.9), (1, 400.0), (2, 900.0), (3, None)], "i int, c double")
    assert col_values(df.withColumn("x", C.cap_upper("c")), "x") == [399.9, 400.0, 400.0, None]


def test_extract_count(spark):
    df = spark.createDataFrame([(0, 30.0, "x 5 tab"), (1, None, "zed 20tab"), (2, None, "zed 20ml"), (3, None, None)],
                               "i int, ps double, name string")
    assert col_values(df.withColumn("x", C.extract_count("ps", "name")), "x") == [30.0, 20.0, None, None]


def test_default_price(spark):
    df = spark.createDataFrame([(0, 0.0, "blood gas"), (1, None, "Chemistry"), (2, 0.0, "other"), (3, 5.0, "hematology")],
                               "i int, price double, category string")
    assert col_values(FR.default_by_category(df, "price", "category"), "price") == [8.0, 75.0, 0.0, 5.0]


def test_parse_ratio(spark):
    df = spark.createDataFrame([(0, "1:2"), (1, " 1:3"), (2, "bad"), (3, None)], "i int, r string")
    a, b = C.parse_ratio("r")
    rows = df.select("i", a.alias("a"), b.alias("b")).orderBy("i").collect()
    assert [(r.a, r.b) for r in rows] == [(1.0, 2.0), (1.0, 3.0), (None, None), (None, None)]


def test_similarity_examples(spark):
    df = spark.createDataFrame([("red bolt", "bolt red"), ("red bolt", "red bolt 5"), ("", "a"), ("abc", "abd")],
                               "a string, b string")
    out = SIM.score_pairs(df.select(SIM.token_set("a").alias("ta"), SIM.token_set("b").alias("tb")),
                          "ta", "tb", "s").collect()
    assert [round(r.s, 6) for r in out] == [100.0, 100.0, 0.0, round(100 - 100 * 2 / 6, 6)]


def test_top5_keeps_null_last_and_breaks_ties_by_id(spark):
    rows = [(1, "a", 10.0), (2, "a", 50.0), (3, "a", None), (4, "a", 30.0), (5, "a", 30.0), (6, "a", 20.0), (7, "a", 40.0),
            (8, "b", None), (9, "b", 5.0)]
    df = spark.createDataFrame(rows, "id int, g string, amount double")
    doc = W.top_k_per_group(df, ["g"], "amount", 5, tie=["id"])
    got = {g: [r.id for r in sorted(doc.where(F.col("g") == g).collect(), key=lambda r: r["rank"])] for g in "ab"}
    assert got == {"a": [2, 7, 4, 5, 6], "b": [9, 8]}
    graph = W.top_k_per_group(df, ["g"], "amount", 5, tie=["id"], keep_null=False)
    assert sorted(r.id for r in graph.where(F.col("g") == "b").collect()) == [9]


def test_lookup_null_matches_null(spark):
    pol = spark.createDataFrame([(1, None), (2, "v1"), (3, "v9")], "pid int, vid string")
    ven = spark.createDataFrame([(10, None), (11, "v1")], "vno int, vid string")
    out = N.lookup_nested(pol, "vid", ven, "vid", "v_").orderBy("pid").collect()
    assert [(r.pid, r.v_vno, r.matched) for r in out] == [(1, 10, True), (2, 11, True), (3, None, False)]


@pytest.mark.parametrize("n", [10, 1000])
def test_groups_have_one_row_per_member_at_any_size(spark, n):
    df = spark.range(0, n).select((F.col("id") % 3).alias("k"), F.col("id"))
    g = N.nested_group(df, ["k"])
    assert g.columns == ["k", "id"] and sorted((r.k, r.id) for r in g.collect()) == sorted((i % 3, i) for i in range(n))
    left = spark.createDataFrame([(1, 0), (2, 5)], "x int, lk int")
    looked = N.lookup_nested(left, "lk", df, "k")
    assert sorted((r.x, r.id, r.matched) for r in looked.collect() if r.matched) == [(1, i, True) for i in range(0, n, 3)]
    assert [(r.x, r.id) for r in looked.collect() if not r.matched] == [(2, None)]


def test_malformed_text_dates_and_ages_give_null(spark):
    fact = spark.createDataFrame([("2150-01-01 10:00:00", "2150-01-03"), ("not a date", None), ("2150-13-40", "")],
                                 "icu_admit_date string, icu_discharge_date string")
    assert sorted(str(r.calendar_date) for r in mart.dim_date(fact).collect()) == ["2150-01-01", "2150-01-03"]
    ages = spark.createDataFrame([("17",), ("x",), (None,), ("70",)], "age string").select(C.bin_labels("age").alias("b"))
    assert [r.b for r in ages.collect()] == ["child", None, None, "elderly"]


def test_stay_cost_rules(spark):
    adm = spark.createDataFrame([("a1", "0"), ("a2", "1")], "hadm_id string, hospital_expire_flag string")
    icu = spark.createDataFrame([("p1", "a1", "s1", "2150-01-01 10:00:00", "2150-01-03 10:00:00", "2.0", "MICU (MICU)"),
                                 ("p1", "a1", "s2", "2150-01-04 10:00:00", "2150-01-05 10:00:00", "1.0", "MICU (MICU)"),
                                 ("p2", "a2", "s3", "2150-02-01 10:00:00", "2150-02-02 10:00:00", "1.0", "CCU")],
                                "subject_id string, hadm_id string, stay_id string, intime string, outtime string, "
                                "los string, first_careunit string")
    rx = spark.createDataFrame([("a1", "Aspirin "), ("a1", "unpriced"), ("a2", "aspirin")], "hadm_id string, drug string")
    price = spark.createDataFrame([("aspirin", "2.50")], "drug string, cost string")
    labs = spark.createDataFrame([("a1", "i1")], "hadm_id string, itemid string")
    items = spark.createDataFrame([("i1", "Glucose")], "itemid string, label string")
    lprice = spark.createDataFrame([("glucose", "4")], "label string, price string")
    fact = mart.fact_stay_cost(adm, icu, rx, price, labs, items, lprice)
    got = {r.stay_id: (r.lab_tests_cost, r.medicine_cost, r.total_cost, r.survived) for r in fact.collect()}
    assert got == {"s1": (4.0, 2.5, 6.5, 1), "s2": (4.0, 2.5, 6.5, 1), "s3": (0.0, 2.5, 2.5, 0)}


def test_dim_patient_keeps_fan_out(spark):
    pat = spark.createDataFrame([("p1", "F", "2150", "50")], "subject_id string, gender string, anchor_year string, anchor_age string")
    adm = spark.createDataFrame([("p1", "A", "M"), ("p1", "B", "M")], "subject_id string, race string, marital_status string")
    assert mart.dim_patient(pat, adm).count() == 2


def test_knn_rules(spark):
    rows = [(1, 1.0, 10.0), (2, 2.0, 20.0), (3, 2.0, 30.0), (4, 4.0, None), (5, None, None), (6, 3.0, 40.0),
            (7, 9.0, None)]
    df = spark.createDataFrame(rows, "k int, size double, cost double")
    out = {r.k: r.cost for r in knn_impute(df, "cost", "size", "k", k=3, buckets=2).collect()}
    # size 4: nearest are 3.0 (d=1), then 2.0 twice (d=2; keys 2 and 3) -> (40 + 20 + 30) / 3
    assert out[4] == 30.0
    assert out[5] == 25.0  # both missing: mean of every present cost
    assert out[7] == 30.0  # 3 nearest of 9.0: 3.0, 2.0 (k2), 2.0 (k3)
    few = spark.createDataFrame([(1, 1.0, 10.0), (2, None, 30.0), (3, 5.0, None)], "k int, size double, cost double")
    assert {r.k: r.cost for r in knn_impute(few, "cost", "size", "k").collect()}[3] == 10.0
