"""Stand-ins: the driver's TPC-H-like tables shaped as the raw hospital,
price-list, document and graph inputs the library expects (SURVEY §2 "T:").

Each function reads whole tables and derives columns with plain
expressions, so the work grows with the tables. The oracle SQL in
``costmart.catalog`` builds the same frames as CTEs.
"""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.aggregates import first_per_key

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations")


class Tables:
    """Lazy access to ``{sf_dir}/{name}.parquet``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def patients(t: Tables) -> DataFrame:
    c = t.customer
    return c.select(F.col("c_custkey").alias("subject_id"),
                    F.when(F.col("c_custkey") % 2 == 0, "F").otherwise("M").alias("gender"),
                    (F.lit(2110) + F.col("c_custkey") % 90).cast("int").alias("anchor_year"),
                    (F.col("c_custkey") % 91).cast("int").alias("anchor_age"))


def admissions(t: Tables) -> DataFrame:
    o = t.orders
    return o.select(F.col("o_orderkey").alias("hadm_id"), F.col("o_custkey").alias("subject_id"),
                    F.col("o_orderpriority").alias("race"), F.col("o_orderstatus").alias("marital_status"),
                    F.col("o_orderpriority").alias("admission_type"),
                    F.concat(F.lit("LOC_"), (F.col("o_custkey") % 4).cast("string")).alias("admission_location"),
                    F.concat(F.lit("DIS_"), (F.col("o_orderkey") % 3).cast("string")).alias("discharge_location"),
                    F.when(F.col("o_totalprice") > 200000, "Private").otherwise("Medicare").alias("insurance"),
                    F.when(F.col("o_orderkey") % 7 == 0, 1).otherwise(0).cast("int").alias("hospital_expire_flag"))


def drgcodes(t: Tables) -> DataFrame:
    li = t.lineitem
    return li.select(F.col("l_orderkey").alias("hadm_id"), (F.col("l_partkey") % 40).cast("string").alias("drg_code"),
                     F.concat(F.lit("DRG "), (F.col("l_partkey") % 40).cast("string")).alias("description"),
                     F.col("l_returnflag").alias("drg_type"))


CARE_UNIT_SQL = ("""case o_orderkey % 6
    when 0 then 'Medical Intensive Care Unit (MICU)'
    when 1 then 'Medical/Surgical Intensive Care Unit (MICU/SICU)'
    when 2 then 'Cardiac Vascular Intensive Care Unit (CVICU)'
    when 3 then 'Trauma SICU (TSICU)'
    when 4 then 'Step down ()'
    else 'Neuro Stepdown' end""")


def _care_unit():
    return F.expr(CARE_UNIT_SQL)


def icustays(t: Tables) -> DataFrame:
    """Finished orders are stays; urgent admissions have a second stay a day later."""
    o = t.orders.where(F.col("o_orderstatus") == "F")
    days = (F.col("o_orderkey") % 10).cast("int")
    first = o.select(F.col("o_custkey").alias("subject_id"), F.col("o_orderkey").alias("hadm_id"),
                     F.col("o_orderkey").alias("stay_id"), F.col("o_orderdate").alias("intime"),
                     F.timestamp_add("DAY", days, F.col("o_orderdate")).alias("outtime"),
                     (days.cast("double") + F.lit(0.25)).alias("los"), _care_unit().alias("first_careunit"))
    second = (o.where(F.col("o_orderpriority") == "1-URGENT")
               .select(F.col("o_custkey").alias("subject_id"), F.col("o_orderkey").alias("hadm_id"),
                       (F.col("o_orderkey") + F.lit(1_000_000_000)).alias("stay_id"),
                       F.timestamp_add("DAY", F.lit(1), F.col("o_orderdate")).alias("intime"),
                       F.timestamp_add("DAY", days + 1, F.col("o_orderdate")).alias("outtime"),
                       (days.cast("double") + F.lit(0.5)).alias("los"), _care_unit().alias("first_careunit")))
    return first.unionByName(second)


def event_lines(t: Tables) -> DataFrame:
    """Lines with their order's customer, in the columns that both kinds of events take from them."""
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    o = t.orders.select("o_orderkey", F.col("o_custkey").alias("subject_id"))
    return li.join(o, li["l_orderkey"] == o["o_orderkey"], "inner").drop("o_orderkey")


def prescriptions(t: Tables, with_subject: bool = False, lines: DataFrame | None = None) -> DataFrame:
    """Lines as prescriptions; the drug is the part name, written with odd case/padding.
    ``lines``: ``event_lines`` once they are written; they come with their subject, but have no dose."""
    li, p = t.lineitem if lines is None else lines, t.part.select("p_partkey", "p_name")
    rx = li.join(p, li["l_partkey"] == p["p_partkey"], "inner")
    cols = [F.col("l_orderkey").alias("hadm_id"),
            F.when(F.col("l_linenumber") % 2 == 0, F.upper("p_name"))
             .otherwise(F.concat(F.col("p_name"), F.lit(" "))).alias("drug"),
            F.when(F.col("l_linenumber") == 7, F.lit(" "))
             .otherwise(F.concat(F.col("l_suppkey").cast("string"), F.lit(" ,"),
                                 (F.col("l_partkey") % 3).cast("string"))).alias("gsn"),
            F.col("l_shipdate").alias("starttime"), F.lit("TAB").alias("form_rx"),
            *([F.col("l_quantity").cast("string").alias("dose_val_rx")] if lines is None else ["subject_id"]),
            F.col("l_linenumber").cast("string").alias("doses_per_24_hrs"), F.lit("PO").alias("route"),
            "l_linenumber", "l_partkey", "l_suppkey"]
    out = rx.select(*cols, "l_orderkey")
    if with_subject and lines is None:
        o = t.orders.select("o_orderkey", "o_custkey")
        out = out.join(o, out["l_orderkey"] == o["o_orderkey"], "inner").withColumn("subject_id", F.col("o_custkey"))
        out = out.drop("o_orderkey", "o_custkey")
    return out


def drug_price(t: Tables) -> DataFrame:
    """One price per part name (lowest part key's price); names starting 'red' are unpriced."""
    p = t.part.select(F.col("p_name").alias("drug"), "p_partkey", F.col("p_retailprice").alias("cost"))
    first = first_per_key(p, ["drug"], ["p_partkey"])
    return first.where(~F.col("drug").startswith("red")).select("drug", "cost")


def lab_events(t: Tables, with_subject: bool = False, lines: DataFrame | None = None) -> DataFrame:
    """Lines as lab events; ``lines``: ``event_lines`` once they are written, with their subject."""
    li = t.lineitem if lines is None else lines
    out = li.select(F.col("l_orderkey").alias("hadm_id"), F.col("l_suppkey").alias("itemid"),
                    F.col("l_shipdate").alias("charttime"), "l_linenumber", "l_partkey", "l_orderkey",
                    *([] if lines is None else ["subject_id"]))
    if with_subject and lines is None:
        o = t.orders.select("o_orderkey", "o_custkey")
        out = out.join(o, out["l_orderkey"] == o["o_orderkey"], "inner").withColumn("subject_id", F.col("o_custkey"))
        out = out.drop("o_orderkey", "o_custkey")
    return out


def lab_items(t: Tables) -> DataFrame:
    s, n = t.supplier, t.nation
    j = s.join(n, s["s_nationkey"] == n["n_nationkey"], "inner")
    return j.select(F.col("s_suppkey").alias("itemid"), F.col("n_name").alias("label"),
                    F.expr("""case n_regionkey when 0 then 'Blood Gas' when 1 then 'Chemistry'
                              when 2 then 'Hematology' else 'Other' end""").alias("category"))


def lab_price(t: Tables) -> DataFrame:
    """A price per lab label; every 7th label's price is missing (it adds nothing to a stay)."""
    price = F.when(F.col("n_nationkey") % 7 != 0, (F.col("n_nationkey") + 1) * F.lit(0.75))
    return t.nation.select(F.col("n_name").alias("label"), price.alias("price"))


def raw_hospital(t: Tables) -> dict[str, DataFrame]:
    return {"patients": patients(t), "admissions": admissions(t), "drgcodes": drgcodes(t),
            "icustays": icustays(t), "prescriptions": prescriptions(t), "drug_price": drug_price(t),
            "lab_events": lab_events(t), "lab_items": lab_items(t), "lab_price": lab_price(t)}


def nurse_wages(t: Tables) -> DataFrame:
    """State (nation name) and hourly wage."""
    return t.nation.select(F.col("n_name").alias("State"),
                           (F.lit(40.0) + F.col("n_nationkey")).alias("hourly_wage"))


def nurse_ratios(t: Tables) -> DataFrame:
    """State (padded with spaces, as in the workbook) and ``nurses:patients`` text."""
    return t.nation.select(F.concat(F.lit(" "), F.col("n_name"), F.lit(" ")).alias("State"),
                           F.concat((F.col("n_regionkey") + 1).cast("string"), F.lit(":"),
                                    (F.col("n_nationkey") % 3 + 2).cast("string")).alias("nurse_patient_ratio"))
