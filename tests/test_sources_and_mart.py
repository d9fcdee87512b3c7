"""Writers and the mart build end to end on the smallest tables."""

import pytest
from pyspark.sql import functions as F

from costmart.plans import mart
from costmart.session import scratch_path
from costmart.sources import files as S
from costmart.standins import frames as fr


def test_write_mart_round_trip(spark, sf_dir):
    t = fr.Tables(spark, sf_dir)
    tables = mart.build_mart(fr.raw_hospital(t))
    paths = mart.write_mart(tables, scratch_path(spark, "mart-test"))
    assert set(paths) == {"dim_patient", "dim_admission", "dim_icu_unit", "dim_date", "fact_icustay"}
    fact = spark.read.parquet(paths["fact_icustay"])
    assert fact.count() == tables["fact_icustay"].count()
    # invariants of the stay fact: total = lab + medicine, unique stays, every stay has a unit
    bad = fact.where(F.abs(F.col("total_cost") - F.col("lab_tests_cost") - F.col("medicine_cost")) > 1e-6).count()
    assert bad == 0
    assert fact.select("stay_id").distinct().count() == fact.count()
    units = spark.read.parquet(paths["dim_icu_unit"])
    assert fact.join(units, fact["stay_id"] == units["unit_id"], "left_anti").count() == 0
    dates = spark.read.parquet(paths["dim_date"])
    assert dates.select("date_id").distinct().count() == dates.count()


def test_csv_round_trip_keeps_quoted_commas(spark):
    df = spark.createDataFrame([("1", "Albumin, Blood", "2.5"), ("2", 'say "hi"', "x")], "id string, label string, price string")
    path = scratch_path(spark, "csv-test")
    S.sink_csv(df, path)
    back = S.scan_csv_typed(spark, path, ["id", "label", "price"], casts={"price": "double"})
    assert sorted((r.id, r.label, r.price) for r in back.collect()) == [("1", "Albumin, Blood", 2.5), ("2", 'say "hi"', None)]


def test_truncate_load_requires_every_target_column(spark):
    df = spark.createDataFrame([(1, "a")], "patient_id int, gender string")
    with pytest.raises(ValueError, match="race"):
        S.sink_table_truncate_load(df, "jdbc:none", "public.dim_patient", ["patient_id", "gender", "race"])


def test_docs_to_json_renders_nested_groups_and_nulls(spark):
    df = spark.createDataFrame([("a", 1, 5.0), ("a", 2, None), ("b", 3, None)], "company string, emp int, claim double")
    from costmart.operators.windows import collect_ranked, top_k_per_group

    g = collect_ranked(top_k_per_group(df, ["company"], "claim", 2, tie=["emp"]), ["company"], "rank", ["emp", "claim"], "top")
    js = {r.json for r in S.docs_to_json(g, ["company", "top"]).collect()}
    assert js == {'{"company":"a","top":[{"emp":1,"claim":5.0},{"emp":2,"claim":null}]}',
                  '{"company":"b","top":[{"emp":3,"claim":null}]}'}


def test_csv_files_with_other_column_order_fail(spark):
    path = scratch_path(spark, "csv-order")
    spark.createDataFrame([("h1", "heparin")], "hadm_id string, drug string").write.option("header", True).csv(path)
    spark.createDataFrame([("aspirin", "h2")], "drug string, hadm_id string").write.mode("append").option("header", True).csv(path)
    with pytest.raises(Exception, match="CSV header does not conform"):
        S.scan_csv_strings(spark, path, ["hadm_id", "drug"]).collect()


def test_raw_tables_need_their_columns(spark):
    from costmart.plans import jobs

    path = scratch_path(spark, "raw-lacking")
    spark.createDataFrame([("1",)], "subject_id string").write.option("header", True).csv(path)
    with pytest.raises(ValueError, match="patients lacks columns"):
        jobs.read_raw_csv(spark, {n: path for n in jobs.RAW_COLUMNS})


def test_etl_job_from_raw_csv_matches_typed_build(spark, sf_dir):
    """The batch job reads every raw table as headered all-text CSV; its fact must agree
    with the fact built from typed frames (ids come back as text)."""
    from costmart.plans import jobs

    t = fr.Tables(spark, sf_dir)
    raw = fr.raw_hospital(t)
    base = scratch_path(spark, "raw-csv")
    paths = {}
    for name, df in raw.items():
        paths[name] = f"{base}/{name}"
        S.sink_csv(df, paths[name])
    out = jobs.etl_job(spark, paths, scratch_path(spark, "mart-from-csv"))
    fact_csv = spark.read.parquet(out["fact_icustay"])
    fact_typed = mart.fact_stay_cost(raw["admissions"], raw["icustays"], raw["prescriptions"], raw["drug_price"],
                                     raw["lab_events"], raw["lab_items"], raw["lab_price"])
    key = ["stay_id", "lab_tests_cost", "medicine_cost", "total_cost", "survived"]
    a = {tuple(r) for r in fact_csv.select(F.col("stay_id").cast("long"), *key[1:]).collect()}
    b = {tuple(r) for r in fact_typed.select(*key).collect()}
    assert a == b
    assert spark.read.parquet(out["dim_date"]).count() == mart.dim_date(fact_typed).count()
    assert set(jobs.WAREHOUSE_COLUMNS) == set(out)
    for name, cols in jobs.WAREHOUSE_COLUMNS.items():
        assert set(cols) <= set(spark.read.parquet(out[name]).columns), name
