"""The two batch jobs: raw CSV -> star schema in Parquet, and Parquet ->
warehouse tables (truncate and load).

Raw tables are read with their header and every column as text (the
ETL's contract: no type inference); the mart builders cast with ``try_*``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from ..sources.files import scan_csv_strings, sink_table_truncate_load
from .mart import build_mart, write_mart

# Columns the ETL reads from each raw CSV (the files may hold more).
RAW_COLUMNS = {
    "patients": ["subject_id", "gender", "anchor_year", "anchor_age"],
    "admissions": ["hadm_id", "subject_id", "race", "marital_status", "admission_type", "admission_location",
                   "discharge_location", "insurance", "hospital_expire_flag"],
    "drgcodes": ["hadm_id", "drg_code", "description", "drg_type"],
    "icustays": ["subject_id", "hadm_id", "stay_id", "first_careunit", "intime", "outtime", "los"],
    "prescriptions": ["subject_id", "hadm_id", "drug", "gsn", "starttime"],
    "lab_events": ["subject_id", "hadm_id", "itemid", "charttime"],
    "lab_items": ["itemid", "label", "category"],
    "drug_price": ["drug", "medicine_name", "package_size", "cost"],
    "lab_price": ["label", "category", "price"],
}

# Columns that a raw file may lack: the mart does not read them.
OPTIONAL_COLUMNS = {"prescriptions": ("subject_id", "gsn", "starttime"), "lab_events": ("subject_id", "charttime"),
                    "lab_items": ("category",), "drug_price": ("medicine_name", "package_size"), "lab_price": ("category",)}

# Warehouse tables in load order (dimensions before the fact) with their column order.
WAREHOUSE_COLUMNS = {
    "dim_patient": ["patient_id", "gender", "race", "birth_year", "marital_status", "age"],
    "dim_admission": ["admission_id", "admission_type", "admission_source", "discharge_disposition",
                      "insurance_category", "drg_code", "drg_description", "drg_category"],
    "dim_icu_unit": ["unit_id", "unit_type", "unit_name"],
    "dim_date": ["calendar_date", "date_id", "year", "quarter", "month", "day_of_week"],
    "fact_icustay": ["patient_id", "admission_id", "stay_id", "icu_admit_date", "icu_discharge_date",
                     "total_icu_days", "hospital_expire_flag", "survived", "medicine_cost", "total_cost",
                     "lab_tests_cost"],
}


def read_raw_csv(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, DataFrame]:
    """Every raw table from its headered CSV path, all columns text."""
    missing = [n for n in RAW_COLUMNS if n not in paths]
    if missing:
        raise ValueError(f"no path for raw tables {missing}")
    out = {}
    for name, cols in RAW_COLUMNS.items():
        header = spark.read.option("header", True).csv(paths[name]).columns
        lacking = [c for c in cols if c not in header and c not in OPTIONAL_COLUMNS.get(name, ())]
        if lacking:
            raise ValueError(f"{paths[name]}: raw table {name} lacks columns {lacking}")
        out[name] = scan_csv_strings(spark, paths[name], header).select(*[c for c in cols if c in header])
    return out


def etl_job(spark: SparkSession, raw_paths: Mapping[str, str], out: str) -> dict[str, str]:
    """Raw CSV in, the five warehouse tables written as Parquet under ``out``; returns their paths."""
    return write_mart(build_mart(read_raw_csv(spark, raw_paths)), out)


def load_warehouse(spark: SparkSession, mart_paths: Mapping[str, str], url: str,
                   properties: Mapping[str, str] | None = None, schema: str = "public") -> None:
    """Truncate and load each warehouse table, dimensions first, columns matched by name."""
    for name, cols in WAREHOUSE_COLUMNS.items():
        df = spark.read.parquet(mart_paths[name])
        sink_table_truncate_load(df, url, f"{schema}.{name}", cols, properties)
