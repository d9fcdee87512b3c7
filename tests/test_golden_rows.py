"""A small invented warehouse, as headered all-text CSV files, with the figures it must give.

The rows have the shapes that matter: unit names with and without a bracketed type, a patient
with two race values, quoted commas, empty cells, a non-numeric price.
"""

import math
import statistics

import pytest
from pyspark.sql import functions as F

from costmart.functions import columns as C
from costmart.operators import aggregates as A
from costmart.operators.joins import join_star
from costmart.plans import mart
from costmart.sources.files import scan_csv_strings

FACT = """patient_id,admission_id,stay_id,icu_admit_date,icu_discharge_date,total_icu_days,survived,lab_tests_cost,medicine_cost,total_cost
1,10,100,2150-03-30 10:00:00,2150-04-02 01:00:00,2.5,0,100.25,50.5,150.75
1,11,101,2151-12-31 23:59:59,2152-01-01 00:10:00,0.01,1,0.0,7.0,7.0
2,20,200,2150-04-02 08:00:00,2150-04-09 09:30:00,7.0625,0,400.0,600.0,1000.0
3,30,300,2160-02-29 12:00:00,2160-02-29 18:00:00,0.25,0,12.5,0.0,12.5
4,40,400,,2150-04-09 09:30:00,,1,,3.5,3.5
"""
UNITS = """unit_id,unit_name
100,Medical Intensive Care Unit (MICU)
101,Medical/Surgical Intensive Care Unit (MICU/SICU)
200,Trauma SICU (TSICU)
300,Neuro Stepdown
400,Step down ()
"""
PATIENTS = """patient_id,gender,race,birth_year,marital_status,age
1,F,WHITE,2100,MARRIED,52
1,F,OTHER,2100,MARRIED,52
2,M,"ASIAN, OTHER",2090,,60
3,M,,2130,SINGLE,30
"""
FEES = '''category,price
"Albumin, Blood",8.5
 albumin, 7
"say ""pH""",n/a
ALBUMIN,9
'''


@pytest.fixture
def read(spark, tmp_path):
    def run(name, text):
        path = tmp_path / f"{name}.csv"
        path.write_text(text)
        header = spark.read.option("header", True).csv(str(path)).columns
        return scan_csv_strings(spark, str(path), header)
    return run


def numbers(fact):
    return fact.withColumns({c: F.col(c).try_cast("double") for c in ("total_icu_days", "lab_tests_cost", "medicine_cost", "total_cost")})


def test_unit_types(read):
    got = {r.unit_id: r.t for r in read("units", UNITS).select("unit_id", C.unit_type("unit_name").alias("t")).collect()}
    assert got == {"100": "MICU", "101": "MICU", "200": "TSICU", "300": None, "400": None}


def test_date_dimension(read):
    got = sorted((str(r.calendar_date), r.date_id, r.year, r.quarter, r.month, r.day_of_week) for r in mart.dim_date(read("fact", FACT)).collect())
    assert got == [("2150-03-30", "21500330", "2150", 1, "03", "Monday"), ("2150-04-02", "21500402", "2150", 2, "04", "Thursday"),
                   ("2150-04-09", "21500409", "2150", 2, "04", "Thursday"), ("2151-12-31", "21511231", "2151", 4, "12", "Friday"),
                   ("2152-01-01", "21520101", "2152", 1, "01", "Saturday"), ("2160-02-29", "21600229", "2160", 1, "02", "Friday")]


def test_fact_invariants(read):
    fact = numbers(read("fact", FACT))
    assert fact.count() == fact.select("stay_id").distinct().count() == 5
    assert fact.agg(F.max(F.abs(F.col("total_cost") - C.derive_total("lab_tests_cost", "medicine_cost")))).first()[0] < 1e-9


def test_report_figures(read):
    fact = numbers(read("fact", FACT))
    stats = {r.survived: (round(r["mean"], 4), r["median"], r["count"]) for r in A.group_stats(fact, ["survived"], "total_cost").collect()}
    assert stats == {"0": (387.75, 150.75, 3), "1": (5.25, 5.25, 2)}
    corr = {(r.row_col, r.col_col): r.corr for r in A.corr_matrix(fact, ["total_cost", "medicine_cost", "total_icu_days"]).collect()}
    want = statistics.correlation([150.75, 7.0, 1000.0, 12.5, 3.5], [50.5, 7.0, 600.0, 0.0, 3.5])
    assert math.isclose(corr["total_cost", "medicine_cost"], want, abs_tol=1e-9)
    assert corr["total_cost", "total_icu_days"] == pytest.approx(corr["total_icu_days", "total_cost"]) and corr["total_cost", "total_icu_days"] > 0.9
    joined = fact.join(read("units", UNITS).withColumn("unit_type", C.unit_type("unit_name")), F.col("stay_id") == F.col("unit_id"), "left")
    means = {r.unit_type: round(r["mean"], 4) for r in A.group_stats(joined, ["unit_type"], "total_cost", stats=("mean",)).collect()}
    assert means == {"MICU": 78.875, "TSICU": 1000.0}


def test_star_join_fan_out(read):
    fact, patients = read("fact", FACT), read("patients", PATIENTS)
    assert join_star(fact, [(patients, "patient_id", "patient_id")]).count() == 7
    one = join_star(fact, [(patients, "patient_id", "patient_id")], one_row_per_dim_key=True)
    assert sorted((r.stay_id, r.race) for r in one.collect()) == [("100", "OTHER"), ("101", "OTHER"), ("200", "ASIAN, OTHER"), ("300", None), ("400", None)]


def test_fee_list_with_quoted_commas(read):
    fees = read("fees", FEES)
    assert fees.count() == 4 and len(fees.columns) == 2
    assert fees.where(F.col("category").contains(",")).count() == 1
    got = sorted((r.k, r.p) for r in fees.select(C.normalize_key("category").alias("k"), C.coerce_numeric("price").alias("p")).collect() if r.p is not None)
    assert got == [("albumin", 7.0), ("albumin", 9.0), ("albumin, blood", 8.5)]
    assert fees.select(C.normalize_key("category")).distinct().count() == 3
