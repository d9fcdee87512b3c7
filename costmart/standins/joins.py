"""Registered queries: joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..catalog import register
from ..functions import frames as FR
from ..operators import bucketed as B
from ..operators import joins as J
from ..operators import nested as N
from ..plans import mart
from ..session import scratch_path
from . import frames as fr
from .sql import MED_COST, STAYS, with_


def _t(spark, sf_dir):
    return fr.Tables(spark, sf_dir)


@register("join_left_using", with_("admissions", "drgcodes") + """
select * from admissions left join drgcodes using (hadm_id)""")
def q_join_left_using(spark, sf_dir):
    t = _t(spark, sf_dir)
    return J.join_left_using(fr.admissions(t), fr.drgcodes(t), "hadm_id")


@register("join_inner_using", with_("admissions", "icustays") + """
select * from admissions join icustays using (hadm_id, subject_id)""")
def q_join_inner_using(spark, sf_dir):
    t = _t(spark, sf_dir)
    return J.join_inner_using(fr.admissions(t), fr.icustays(t), ["hadm_id", "subject_id"])


@register("join_left_on_expr", with_("admissions", "icustays", "prescriptions", "drug_price", extra=(STAYS, MED_COST)) + """
select s.*, med.medicine_cost from stays s left join med on s.admission_id = med.hadm_id""")
def q_join_left_on_expr(spark, sf_dir):
    t = _t(spark, sf_dir)
    s = mart.stays(fr.admissions(t), fr.icustays(t))
    med = mart.medicine_cost_by_admission(fr.prescriptions(t), fr.drug_price(t))
    return J.join_left_on_expr(s, med, "admission_id", "hadm_id")


@register("join_chain_inner", """
select l_orderkey, l_linenumber, l_partkey, s_suppkey, s_nationkey, n_name
from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey""")
def q_join_chain_inner(spark, sf_dir):
    t = _t(spark, sf_dir)
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    out = J.join_chain_inner(li, [(t.supplier.select("s_suppkey", "s_nationkey"), ("l_suppkey", "s_suppkey")),
                                  (t.nation.select("n_nationkey", "n_name"), ("s_nationkey", "n_nationkey"))])
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "s_suppkey", "s_nationkey", "n_name")


ROLE_SQL = """with ship as (select l_orderkey, cast(max(l_shipdate) as date) as ship_date from lineitem group by l_orderkey),
f as (select o_orderkey, cast(o_orderdate as date) as order_date, ship_date
      from orders left join ship on o_orderkey = l_orderkey),
dd as (select distinct d as calendar_date from (select order_date as d from f union all select ship_date from f) where d is not null),
dim as (select calendar_date, strftime(calendar_date, '%Y%m%d') as date_id, dayname(calendar_date) as day_of_week from dd)
select o_orderkey, a.date_id as date_id_adm, a.day_of_week as day_of_week_adm,
       d.date_id as date_id_dis, d.day_of_week as day_of_week_dis
from f left join dim a on f.order_date = a.calendar_date left join dim d on f.ship_date = d.calendar_date"""


def _role_fact_and_dim(t):
    li = t.lineitem.groupBy("l_orderkey").agg(F.max("l_shipdate").cast("date").alias("ship_date"))
    o = t.orders.select("o_orderkey", F.col("o_orderdate").cast("date").alias("order_date"))
    f = o.join(li, o["o_orderkey"] == li["l_orderkey"], "left").drop("l_orderkey")
    dates = (f.select(F.col("order_date").alias("d")).union(f.select("ship_date"))
              .where(F.col("d").isNotNull()).distinct())
    dim = FR.date_parts(dates, "d").select("calendar_date", "date_id", "day_of_week")
    return f, dim


@register("join_role_dim", ROLE_SQL)
def q_join_role_dim(spark, sf_dir):
    f, dim = _role_fact_and_dim(_t(spark, sf_dir))
    out = J.join_role_dim(f, dim, {"_adm": "order_date", "_dis": "ship_date"}, "calendar_date")
    return out.select("o_orderkey", "date_id_adm", "day_of_week_adm", "date_id_dis", "day_of_week_dis")


@register("join_star", """
select o_orderkey, o_totalprice, c_name, n_name, r_name
from orders left join customer on o_custkey = c_custkey left join nation on c_nationkey = n_nationkey
     left join region on n_regionkey = r_regionkey""")
def q_join_star(spark, sf_dir):
    t = _t(spark, sf_dir)
    fact = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    out = J.join_star(fact, [(t.customer.select("c_custkey", "c_name", "c_nationkey"), "o_custkey", "c_custkey"),
                             (t.nation.select("n_nationkey", "n_name", "n_regionkey"), "c_nationkey", "n_nationkey"),
                             (t.region, "n_regionkey", "r_regionkey")])
    return out.select("o_orderkey", "o_totalprice", "c_name", "n_name", "r_name")


@register("join_star_bucketed", """
select o.o_orderkey, o.o_totalprice, c.c_name, c.c_nationkey, l.l_linenumber, l.l_extendedprice, p.total_quantity
from orders o left join customer c on o.o_custkey = c.c_custkey left join lineitem l on o.o_orderkey = l.l_orderkey
     left join (select l_orderkey, sum(l_quantity) as total_quantity from lineitem group by l_orderkey) p on o.o_orderkey = p.l_orderkey""")
def q_join_star_bucketed(spark, sf_dir):
    """Orders with their customer (another key), lines (fan-out) and totals, from tables in buckets of the order key."""
    t = _t(spark, sf_dir)
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice")
    totals = t.lineitem.groupBy("l_orderkey").agg(F.sum("l_quantity").alias("total_quantity"))
    dims = [("customer", t.customer.select("c_custkey", "c_name", "c_nationkey"), "o_custkey", "c_custkey"),
            ("lines", lines, "o_orderkey", "l_orderkey"), ("totals", totals, "o_orderkey", "l_orderkey")]
    tables = B.write_star(t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), dims, "o_orderkey", scratch_path(spark, "star"), 8)
    out = B.join_star_bucketed(spark, tables, [(d[0], d[2]) for d in dims], "o_orderkey")
    return out.drop("o_custkey")


NATION_LK = "case when n_nationkey = 3 then null else n_nationkey end"
SUPP_LK = "case when s_suppkey % 17 = 0 then null else s_nationkey end"


@register("lookup_nested", f"""
with l as (select n_nationkey, n_name, {NATION_LK} as lk from nation),
r as (select s_suppkey, s_name, {SUPP_LK} as rk from supplier)
select n_nationkey, n_name, s_suppkey, s_name, s_suppkey is not null as matched
from l left join r on l.lk is not distinct from r.rk""")
def q_lookup_nested(spark, sf_dir):
    t = _t(spark, sf_dir)
    left = t.nation.select("n_nationkey", "n_name", F.expr(NATION_LK).alias("lk"))
    right = t.supplier.select("s_suppkey", "s_name", F.expr(SUPP_LK).alias("rk"))
    return N.lookup_nested(left, "lk", right, "rk").drop("lk", "rk")


@register("path_one_hop", """
select o_orderkey, c_custkey, c_nationkey
from orders i join (select o_orderkey as src, o_custkey as dst from orders) e on i.o_orderkey = e.src
     join customer on e.dst = c_custkey""")
def q_path_one_hop(spark, sf_dir):
    t = _t(spark, sf_dir)
    ins = t.orders.select("o_orderkey")
    edge = t.orders.select(F.col("o_orderkey").alias("src"), F.col("o_custkey").alias("dst"))
    emp = t.customer.select("c_custkey", "c_nationkey")
    return J.path_one_hop(ins, "o_orderkey", edge, "src", "dst", emp, "c_custkey")


@register("path_two_hop", """
select distinct c_custkey, s_suppkey
from orders i join (select o_orderkey as m1, o_custkey as a from orders) e1 on i.o_orderkey = e1.m1
     join (select l_orderkey as m2, l_suppkey as b from lineitem) e2 on e1.m1 = e2.m2
     join customer on e1.a = c_custkey join supplier on e2.b = s_suppkey""")
def q_path_two_hop(spark, sf_dir):
    t = _t(spark, sf_dir)
    paths = J.path_two_hop(t.customer.select("c_custkey"), "c_custkey",
                           t.orders.select("o_orderkey", "o_custkey"), "o_orderkey", "o_custkey",
                           t.orders.select("o_orderkey"), "o_orderkey",
                           t.lineitem.select("l_orderkey", "l_suppkey"), "l_orderkey", "l_suppkey",
                           t.supplier.select("s_suppkey"), "s_suppkey")
    return paths.select("c_custkey", "s_suppkey").distinct()


EITHER_KEYS = """keys as (select p_name as k from part
                 union select p_brand from part
                 union select p_name || ' / ' || p_brand from part)"""


@register("lookup_either_column", f"""
with {EITHER_KEYS},
m as (select k, min(p_partkey) as pk from keys join part on p_name = k or p_brand = k group by k)
select keys.k as drug, p.p_partkey, p.p_name, p.p_brand, p.p_retailprice
from keys left join m on keys.k = m.k left join part p on p.p_partkey = m.pk""")
def q_lookup_either_column(spark, sf_dir):
    t = _t(spark, sf_dir)
    p = t.part
    keys = (p.select(F.col("p_name").alias("drug"))
             .union(p.select("p_brand"))
             .union(p.select(F.concat("p_name", F.lit(" / "), "p_brand")))
             .distinct())
    ref = p.select("p_partkey", "p_name", "p_brand", "p_retailprice")
    return J.lookup_either_column(keys, "drug", ref, ["p_name", "p_brand"], "p_partkey")


@register("join_star_one_row_per_key", with_("patients", "admissions", "icustays", extra=(STAYS,)) + """
, dp as (select distinct p.subject_id as patient_id, p.gender, a.race, p.anchor_year as birth_year, a.marital_status,
                p.anchor_age as age from patients p left join admissions a on p.subject_id = a.subject_id),
dp1 as (select * exclude (rn) from (
          select *, row_number() over (partition by patient_id order by gender nulls first, race nulls first,
                                        birth_year nulls first, marital_status nulls first, age nulls first) as rn
          from dp) where rn = 1)
select s.stay_id, s.patient_id, dp1.gender, dp1.race, dp1.birth_year, dp1.marital_status, dp1.age
from stays s left join dp1 on s.patient_id = dp1.patient_id""")
def q_join_star_one_row_per_key(spark, sf_dir):
    """Stays joined to the patient dimension with its fan-out removed (first row per patient)."""
    t = _t(spark, sf_dir)
    s = mart.stays(fr.admissions(t), fr.icustays(t)).select("stay_id", "patient_id")
    dim = mart.dim_patient(fr.patients(t), fr.admissions(t))
    return J.join_star(s, [(dim, "patient_id", "patient_id")], one_row_per_dim_key=True)
