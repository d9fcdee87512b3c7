"""Registered queries: scalar expressions and row transforms."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..catalog import register
from ..functions import columns as C
from ..functions import frames as FR
from ..plans import mart
from . import frames as fr
from .mart import _modal_sql, _resolved_sql
from .sql import with_

WS = "[ \\t\\n\\x0B\\f\\r]+"


def _t(spark, sf_dir):
    return fr.Tables(spark, sf_dir)


@register("project_rename", """
select o_orderkey as stay_id, o_custkey as patient_id, o_totalprice as total_cost from orders""")
def q_project_rename(spark, sf_dir):
    return FR.project_rename(_t(spark, sf_dir).orders,
                             {"stay_id": "o_orderkey", "patient_id": "o_custkey", "total_cost": "o_totalprice"})


UNIT_NAME_SQL = """case p_size % 10 when 0 then 'Ward' when 1 then 'Ward ()' when 2 then 'Ward (/B)'
     when 3 then null
     else p_type || ' unit (' || p_brand || case when p_size % 3 = 0 then '/x' else '' end || ')' end"""


@register("unit_type", f"""
with u as (select p_partkey, {UNIT_NAME_SQL} as unit_name from part)
select p_partkey, unit_name,
       case when regexp_extract(unit_name, '\\((.*?)\\)', 1) <> ''
            then split_part(regexp_extract(unit_name, '\\((.*?)\\)', 1), '/', 1) end as unit_type
from u""")
def q_unit_type(spark, sf_dir):
    p = _t(spark, sf_dir).part.select("p_partkey", F.expr(UNIT_NAME_SQL).alias("unit_name"))
    return p.withColumn("unit_type", C.unit_type("unit_name"))


RAW_NAME_SQL = "case when p_partkey % 2 = 0 then '  ' || upper(p_name) || chr(9) else p_name || chr(10) end"


@register("normalize_key", f"""
with r as (select p_partkey, {RAW_NAME_SQL} as raw_name from part)
select p_partkey, raw_name, lower(regexp_replace(raw_name, '^{WS}|{WS}$', '', 'g')) as name_key from r""")
def q_normalize_key(spark, sf_dir):
    p = _t(spark, sf_dir).part.select("p_partkey", F.expr(RAW_NAME_SQL.replace("chr(", "char(")).alias("raw_name"))
    return p.withColumn("name_key", C.normalize_key("raw_name"))


@register("coerce_numeric", """
with r as (select o_orderkey, case when o_orderkey % 5 = 0 then 'bad' else substr(o_orderpriority, 1, 1) end as txt
           from orders)
select o_orderkey, txt, try_cast(txt as double) as num from r""")
def q_coerce_numeric(spark, sf_dir):
    o = _t(spark, sf_dir).orders.select(
        "o_orderkey", F.expr("case when o_orderkey % 5 = 0 then 'bad' else substr(o_orderpriority, 1, 1) end").alias("txt"))
    return o.withColumn("num", C.coerce_numeric("txt"))


NULLED_PRICE = "case when o_orderkey % 7 = 0 then null else o_totalprice end"


@register("null_to_zero", f"""
select o_orderkey, coalesce({NULLED_PRICE}, 0) as cost from orders""")
def q_null_to_zero(spark, sf_dir):
    o = _t(spark, sf_dir).orders
    return o.select("o_orderkey", C.null_to_zero(F.expr(NULLED_PRICE)).alias("cost"))


@register("derive_total", """
select l_orderkey, l_linenumber, l_partkey, l_suppkey,
       coalesce(l_extendedprice, 0) + coalesce(case when l_linenumber = 3 then null else l_tax end, 0) as total_cost
from lineitem""")
def q_derive_total(spark, sf_dir):
    li = _t(spark, sf_dir).lineitem
    tax = F.expr("case when l_linenumber = 3 then null else l_tax end")
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                     C.derive_total("l_extendedprice", tax).alias("total_cost"))


@register("date_parts", """
select o_orderkey, cast(o_orderdate as date) as calendar_date, strftime(o_orderdate, '%Y%m%d') as date_id,
       strftime(o_orderdate, '%Y') as year, cast(quarter(o_orderdate) as int) as quarter,
       strftime(o_orderdate, '%m') as month, dayname(o_orderdate) as day_of_week
from orders""")
def q_date_parts(spark, sf_dir):
    o = _t(spark, sf_dir).orders.select("o_orderkey", "o_orderdate")
    return FR.date_parts(o, "o_orderdate").drop("o_orderdate")


BLANKED = "case when o_orderkey % 7 = 0 then null when o_orderkey % 11 = 0 then '' else o_orderpriority end"


@register("filter_not_null", f"""
with r as (select o_orderkey, {BLANKED} as priority from orders)
select o_orderkey, priority from r where priority is not null and priority <> ''""")
def q_filter_not_null(spark, sf_dir):
    o = _t(spark, sf_dir).orders.select("o_orderkey", F.expr(BLANKED).alias("priority"))
    return FR.filter_not_null(o, ["priority"], blank=True)


@register("filter_equals", """
select o_orderkey, o_custkey, o_orderstatus from orders where o_orderstatus = 'F'""")
def q_filter_equals(spark, sf_dir):
    o = _t(spark, sf_dir).orders.select("o_orderkey", "o_custkey", "o_orderstatus")
    return FR.filter_equals(o, "o_orderstatus", "F")


@register("const_columns", """
select l_orderkey, l_linenumber, l_partkey, 'LAB' as event_type, cast(0 as double) as cost,
       cast(null as varchar) as location_id, cast(null as varchar) as med_id
from lineitem""")
def q_const_columns(spark, sf_dir):
    li = _t(spark, sf_dir).lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    return FR.const_columns(li, {"event_type": ("LAB", "string"), "cost": (0, "double"),
                                 "location_id": (None, "string"), "med_id": (None, "string")})


@register("drop_columns", """
select o_orderkey, o_custkey, o_totalprice, c_nationkey
from orders join customer on o_custkey = c_custkey""")
def q_drop_columns(spark, sf_dir):
    t = _t(spark, sf_dir)
    o = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    c = t.customer.select("c_custkey", "c_nationkey")
    return FR.drop_columns(o.join(c, o["o_custkey"] == c["c_custkey"], "inner"), c["c_custkey"])


@register("cap_upper", f"""
select o_orderkey, case when {NULLED_PRICE} > 400000 then 400000.0 else {NULLED_PRICE} end as capped
from orders""")
def q_cap_upper(spark, sf_dir):
    o = _t(spark, sf_dir).orders
    return o.select("o_orderkey", C.cap_upper(F.expr(NULLED_PRICE), 400000.0).alias("capped"))


def md5_number_sql(keys, digits, seed=42):
    """The same whole number as ``functions.columns.hash_number``."""
    return f"cast('0x' || substr(md5(concat_ws('|', {keys}, '{seed}')), 1, {digits}) as bigint)"


@register("redraw_capped", f"""
with c as (select o_orderkey, case when {NULLED_PRICE} > 400000 then 400000.0 else {NULLED_PRICE} end as capped from orders)
select o_orderkey, capped, case when capped = 400000 then
       cast(100000 as double) + cast(300000 as double) * ({md5_number_sql('cast(o_orderkey as varchar)', 5)} / cast(1048576 as double))
       else capped end as cost from c""")
def q_redraw_capped(spark, sf_dir):
    """Capped prices redrawn in [100000, 400000) by a hash of the order key."""
    o = _t(spark, sf_dir).orders
    capped = C.cap_upper(F.expr(NULLED_PRICE), 400000.0)
    return o.select("o_orderkey", capped.alias("capped"),
                    C.redraw_capped(capped, ["o_orderkey"], 400000.0, 100000.0, 400000.0).alias("cost"))


@register("assign_random_category", with_("nurse_wages") + f"""
, s as (select "State", row_number() over (order by "State") - 1 as n from (select distinct "State" from nurse_wages where "State" is not null))
select o_orderkey, s."State" from orders
join s on s.n = {md5_number_sql('cast(o_orderkey as varchar)', 15)} % (select count(*) from s)""")
def q_assign_random_category(spark, sf_dir):
    """Every stay gets a repeatable pseudo-random state (nation name)."""
    t = _t(spark, sf_dir)
    return FR.assign_random_category(t.orders.select("o_orderkey"), ["o_orderkey"],
                                     fr.nurse_wages(t), "State", "State")


PKG_SIZE = "case when p_size % 4 = 0 then null else p_size end"
PKG_NAME = "cast(p_size as string) || ' ' || p_name || case when p_partkey % 3 = 0 then ' tab' else ' ml' end"


@register("extract_count", f"""
select p_partkey, coalesce(cast({PKG_SIZE} as double),
       case when contains(lower({PKG_NAME}), 'tab')
            then cast(try_cast(regexp_extract({PKG_NAME}, '(\\d+)', 1) as int) as double) end) as package_size
from part""")
def q_extract_count(spark, sf_dir):
    p = _t(spark, sf_dir).part
    return p.select("p_partkey", C.extract_count(F.expr(PKG_SIZE), F.expr(PKG_NAME)).alias("package_size"))


LAB_CATEGORY = """case p_type when 'ECONOMY' then 'Blood Gas' when 'SMALL' then 'Chemistry'
     when 'LARGE' then 'hematology' else p_type end"""
LAB_PRICE0 = "case when p_partkey % 3 = 0 then 0 when p_partkey % 3 = 1 then null else p_retailprice end"


@register("default_by_category", f"""
with r as (select p_partkey, {LAB_CATEGORY} as category, cast({LAB_PRICE0} as double) as price from part),
d as (select * from (values ('blood gas', 8.0), ('chemistry', 75.0), ('hematology', 100.0)) v(k, dp))
select p_partkey, category,
       case when price is null or price = 0 then coalesce(d.dp, price) else price end as price
from r left join d on lower(r.category) = d.k""")
def q_default_by_category(spark, sf_dir):
    p = _t(spark, sf_dir).part.select("p_partkey", F.expr(LAB_CATEGORY).alias("category"),
                                      F.expr(LAB_PRICE0).cast("double").alias("price"))
    return FR.default_by_category(p, "price", "category")


BAND_EDGES = (0, 10, 20, 40, 45)


@register("bin_labels", """
select p_partkey, p_size,
       case when p_size > 0 and p_size <= 10 then 'child' when p_size > 10 and p_size <= 20 then 'adult'
            when p_size > 20 and p_size <= 40 then 'senior' when p_size > 40 and p_size <= 45 then 'elderly'
       end as band
from part""")
def q_bin_labels(spark, sf_dir):
    p = _t(spark, sf_dir).part.select("p_partkey", "p_size")
    return p.withColumn("band", C.bin_labels("p_size", BAND_EDGES))


@register("month_period", """
select o_orderkey, cast(date_trunc('month', o_orderdate) as date) as admit_month from orders""")
def q_month_period(spark, sf_dir):
    o = _t(spark, sf_dir).orders
    return o.select("o_orderkey", C.month_period("o_orderdate").alias("admit_month"))


RATIO_TXT = """case n_nationkey % 5 when 0 then 'bad' when 1 then ' ' || cast(n_regionkey + 1 as string) || ':3'
     else cast(n_regionkey + 1 as string) || ':' || cast(n_nationkey + 1 as string) end"""


@register("parse_ratio", f"""
with r as (select n_nationkey, {RATIO_TXT} as ratio from nation)
select n_nationkey, ratio, try_cast(trim(split_part(ratio, ':', 1)) as double) as icu_nurses,
       case when len(string_split(ratio, ':')) >= 2
            then try_cast(trim(string_split(ratio, ':')[2]) as double) end as icu_patients
from r""")
def q_parse_ratio(spark, sf_dir):
    n = _t(spark, sf_dir).nation.select("n_nationkey", F.expr(RATIO_TXT).alias("ratio"))
    nurses, pats = C.parse_ratio("ratio")
    return n.select("n_nationkey", "ratio", nurses.alias("icu_nurses"), pats.alias("icu_patients"))


@register("labor_cost", """
with r as (select o_orderkey, cast(o_orderkey % 10 as double) + 0.25 as days, cast(n_regionkey as double) as patients,
                  40.0 + n_nationkey as wage
           from orders join customer on o_custkey = c_custkey left join nation on c_nationkey = n_nationkey)
select o_orderkey, case when patients = 0 then null else days * 24 / patients end as nurse_hours,
       case when patients = 0 then null else days * 24 / patients end * wage * days as labor_cost,
       case when patients = 0 then null else days * 24 / patients end * wage as labor_cost_hours_only
from r""")
def q_labor_cost(spark, sf_dir):
    t = _t(spark, sf_dir)
    o, c, n = t.orders, t.customer, t.nation
    r = (o.join(c, o["o_custkey"] == c["c_custkey"], "inner").join(n, F.col("c_nationkey") == n["n_nationkey"], "left")
          .select("o_orderkey", ((F.col("o_orderkey") % 10).cast("double") + F.lit(0.25)).alias("days"),
                  F.col("n_regionkey").cast("double").alias("patients"), (F.lit(40.0) + F.col("n_nationkey")).alias("wage")))
    return r.select("o_orderkey", C.nurse_hours("days", "patients").alias("nurse_hours"),
                    C.labor_cost("days", "patients", "wage").alias("labor_cost"),
                    C.labor_cost("days", "patients", "wage", as_reference=False).alias("labor_cost_hours_only"))


@register("tokenize_explode", f"""
select doc_id, unnest(list_filter(string_split_regex(trim(regexp_replace(text, ',', ' ', 'g')), '{WS}'),
                                  lambda t: t <> '')) as token
from documents""")
def q_tokenize_explode(spark, sf_dir):
    d = _t(spark, sf_dir).documents.select("doc_id", "text")
    return FR.tokenize_explode(d, "text", "token").select("doc_id", "token")


@register("resolve_code", with_("prescriptions", extra=(
    "rxn as (select * replace (lower(trim(drug)) as drug) from prescriptions)",
    _modal_sql("rxn", "drug"))) + f"""
select l_orderkey, l_linenumber, l_partkey, l_suppkey, rxn.drug, gsn, {_resolved_sql('drug')} as code
from rxn left join modal on rxn.drug is not distinct from modal.drug_name""")
def q_resolve_code(spark, sf_dir):
    rx = fr.prescriptions(_t(spark, sf_dir))
    rx = rx.withColumn("drug", C.normalize_key("drug", all_whitespace=False))
    modal = mart.gsn_modal(rx)
    out = FR.resolve_code(rx, "drug", "gsn", modal, "drug_name", "most_freq_gsn", "code")
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "drug", "gsn", "code")


@register("surrogate_id", """
select o_orderkey, sha256(concat_ws('|', cast(o_orderkey as varchar), cast(o_custkey as varchar))) as event_id
from orders""")
def q_surrogate_id(spark, sf_dir):
    o = _t(spark, sf_dir).orders.select("o_orderkey", "o_custkey")
    return FR.surrogate_id(o, ["o_orderkey", "o_custkey"]).select("o_orderkey", "event_id")


@register("surrogate_id_numbered", """
select row_number() over (order by o_orderdate nulls first, o_orderpriority nulls first, o_orderkey) as row_id, o_orderkey, o_orderdate
from orders""")
def q_surrogate_id_numbered(spark, sf_dir):
    o = _t(spark, sf_dir).orders.select("o_orderdate", "o_orderpriority", "o_orderkey")
    return FR.numbered_id(o, ["o_orderdate", "o_orderpriority", "o_orderkey"]).select("row_id", "o_orderkey", "o_orderdate")


@register("suffix_columns", """
select n_nationkey as n_nationkey_adm, n_name as n_name_adm, n_regionkey as n_regionkey_adm from nation""")
def q_suffix_columns(spark, sf_dir):
    return FR.suffix_columns(_t(spark, sf_dir).nation, "_adm")
