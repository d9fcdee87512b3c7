"""Registered queries: fuzzy matching, imputation and the two price lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..catalog import register
from ..operators import similarity as SIM
from ..session import materialize
from . import frames as fr
from .scalars import md5_number_sql
from .sql import CTE

CTE_LAB_ITEMS = CTE["lab_items"]

WS = "[ \\t\\n\\x0B\\f\\r]+"

ALTERED = """case p_partkey % 5 when 0 then p_name
     when 1 then split_part(p_name, ' ', 2) || ' ' || split_part(p_name, ' ', 1)
     when 2 then replace(p_name, 'e', 'a')
     when 3 then p_name || ' ' || lower(p_type)
     else substr(p_name, 2) end"""


def _tokset(c):
    return f"list_sort(list_distinct(list_filter(string_split_regex({c}, '{WS}'), lambda t: t <> '')))"


def _lcs(x, y):
    return f"""(case when length({x}) = 0 or length({y}) = 0 then 0 else list_reduce(
   list_transform(range(1, length({x}) + 1), lambda i: substr({x}, i, 1)),
   lambda prev, ch: list_reduce(range(1, length({y}) + 1),
        lambda acc, j: list_append(acc, case when ch = substr({y}, j, 1) then prev[j] + 1
                                        else greatest(prev[j + 1], acc[j]) end), [0]),
   list_transform(range(0, length({y}) + 1), lambda i: 0))[length({y}) + 1] end)"""


def brute_force_best_sql(left_sql: str, right_sql: str, threshold: float) -> str:
    """Oracle: every pair scored, best per left name (score >= threshold, ties -> lowest choice)."""
    return f"""l as ({left_sql}), r as ({right_sql}),
lt as (select name, {_tokset('name')} as ta from l where name is not null),
rt as (select name as rname, {_tokset('name')} as tb from r where name is not null),
pr as (select lt.name as lname, rname, ta, tb, list_intersect(ta, tb) as i,
              list_filter(ta, lambda t: not list_contains(tb, t)) as xa,
              list_filter(tb, lambda t: not list_contains(ta, t)) as yb
       from lt cross join rt),
pv as (select *, array_to_string(xa, ' ') as x, array_to_string(yb, ' ') as y,
              length(array_to_string(i, ' ')) as s from pr),
pw as (select *, case when s > 0 then 1 else 0 end as p, {_lcs('x', 'y')} as lcs from pv),
sc as (select lname, rname,
              case when len(ta) = 0 or len(tb) = 0 then 0.0
                   when len(i) > 0 and (len(xa) = 0 or len(yb) = 0) then 100.0
                   else greatest(
                     cast(100 as double) - cast(100 as double) * (length(x) + length(y) - 2 * lcs) / (s * 2 + p * 2 + length(x) + length(y)),
                     case when s > 0 then cast(100 as double) - cast(100 as double) * (p + length(x)) / (s * 2 + p + length(x)) else 0.0 end,
                     case when s > 0 then cast(100 as double) - cast(100 as double) * (p + length(y)) / (s * 2 + p + length(y)) else 0.0 end)
              end as score
       from pw),
best as (select lname, rname, score from (
           select *, row_number() over (partition by lname order by score desc, rname) as rn
           from sc where score >= {threshold}) where rn = 1)"""


@register("fuzzy_best_match", "with " + brute_force_best_sql(
    f"select distinct {ALTERED} as name from part",
    "select distinct p_name as name from part union select distinct lower(p_type) from part", 80.0) + """
select l.name, best.rname as match, round(best.score, 6) as score
from (select distinct name from l) l left join best on l.name = best.lname""")
def q_fuzzy_best_match(spark, sf_dir):
    """Altered part names matched to the part-name and type vocabulary (threshold 80)."""
    p = fr.Tables(spark, sf_dir).part
    left = p.select(F.expr(ALTERED).alias("name")).distinct()
    right = p.select(F.col("p_name").alias("name")).union(p.select(F.lower("p_type"))).distinct()
    best = SIM.best_match_names(left, right, 80.0)
    return best.withColumn("score", F.round("score", 6))


KNN_SIZE = "case when p_partkey % 10 = 3 then null else cast(p_size as double) end"
KNN_COST = "case when p_partkey % 4 = 0 then null else p_retailprice end"


@register("knn_impute", f"""
with x as (select p_partkey as k, {KNN_SIZE} as package_size, {KNN_COST} as cost from part),
d as (select * from x where cost is not null and package_size is not null),
cm as (select avg(cost) as m from x)
select x.k as p_partkey, x.package_size,
       round(case when x.cost is not null then x.cost
                  when x.package_size is null then (select m from cm)
                  else coalesce((select avg(cost) from (select cost from d
                                  order by abs(d.package_size - x.package_size), d.k limit 3)),
                                (select m from cm)) end, 6) as cost
from x""")
def q_knn_impute(spark, sf_dir):
    """Part prices with every 4th missing, imputed from the 3 parts nearest in size."""
    from ..operators.impute import knn_impute

    p = fr.Tables(spark, sf_dir).part.select(F.col("p_partkey"), F.expr(KNN_SIZE).alias("package_size"),
                                             F.expr(KNN_COST).alias("cost"))
    out = knn_impute(p, "cost", "package_size", "p_partkey", k=3, buckets=8)
    return out.withColumn("cost", F.round("cost", 6))


ORDER_COST = "case when o_orderkey % 2 = 0 then null else cast(o_custkey as double) end"
ORDER_SIZE = "case when o_orderkey % 97 = 3 then null else o_totalprice end"


@register("knn_impute_many_values", f"""
with x as (select o_orderkey as k, {ORDER_SIZE} as size, {ORDER_COST} as cost from orders),
d as (select size, k, cost, row_number() over (order by size, k) as rn from x where cost is not null and size is not null),
w as (select distinct size from x where cost is null and size is not null),
p as (select size, recipient, sum(donor) over (order by size, donor desc rows unbounded preceding) as c
      from (select size, 1 as donor, false as recipient from d union all select size, 0, true from w)),
a as (select p.size as place, d.cost, row_number() over (partition by p.size order by abs(d.size - p.size), d.k) as nearest
      from p join d on p.recipient and d.rn between p.c - 12 and p.c + 12),
i as (select place, avg(cost) as cost from a where nearest <= 3 group by place),
cm as (select avg(cost) as m from x)
select x.k as o_orderkey, round(coalesce(x.cost, i.cost, cm.m), 6) as cost
from x left join i on x.size = i.place, cm""")
def q_knn_impute_many_values(spark, sf_dir):
    """Every other order's number imputed from the 3 orders nearest in price, nearly all of a price of their
    own, dealt into ranges of 2,000 prices (the SQL ranks the 12 donors on either side)."""
    from ..operators.impute import knn_impute

    x = fr.Tables(spark, sf_dir).orders.select(F.col("o_orderkey"), F.expr(ORDER_SIZE).alias("size"), F.expr(ORDER_COST).alias("cost"))
    out = knn_impute(x, "cost", "size", "o_orderkey", k=3, values_per_bucket=2_000)
    return out.select("o_orderkey", F.round("cost", 6).alias("cost"))


def trade_names(t):
    p = t.part
    return p.select("p_partkey",
                    F.expr("case when p_partkey % 2 = 0 then upper(p_name) else p_name || ' ' end").alias("brand_name"),
                    F.expr("lower(p_type) || ' ' || split_part(p_name, ' ', 2)").alias("active_ingredients"))


def medicine_prices(t):
    p = t.part
    return p.select("p_partkey",
                    F.expr("p_name || ' ' || cast(p_size as string) || "
                           "case when p_partkey % 2 = 0 then ' tab' else ' ml' end").alias("Medication_Name"),
                    F.expr("case when p_partkey % 7 = 0 then 'n/a' when p_partkey % 5 = 0 then null "
                           "else cast(p_size as string) end").alias("Package_Size"),
                    F.expr("case when p_partkey % 11 = 0 then 'bad' when p_partkey % 13 = 0 then null "
                           "else cast(round(p_retailprice / 3, 2) as string) end").alias("Max_Consumer_VAT_Price"))


MED_NAME = "p_name || ' ' || cast(p_size as varchar) || case when p_partkey % 2 = 0 then ' tab' else ' ml' end"
BRAND = "case when p_partkey % 2 = 0 then upper(p_name) else p_name || ' ' end"
NORM = "lower(regexp_replace({c}, '^" + WS + "|" + WS + "$', '', 'g'))"

#: The mapping as CTEs: every pair scored, the best whatever its score.
MAPPING_CTES = brute_force_best_sql(f"select distinct {NORM.format(c=MED_NAME)} as name from part",
                                    f"select distinct {NORM.format(c=BRAND)} as name from part", 0.0) + f"""
, tn as (select * from (select p_partkey, {NORM.format(c=BRAND)} as brand,
                               lower(p_type) || ' ' || split_part(p_name, ' ', 2) as active_ingredients,
                               row_number() over (partition by {NORM.format(c=BRAND)} order by p_partkey) as rn from part) where rn = 1),
mapping as (
  select p.p_partkey, p.med as medicine_name, best.rname as matched_drug,
         case when p.p_partkey % 7 = 0 then 'n/a' when p.p_partkey % 5 = 0 then null else cast(p_size as varchar) end as package_size,
         best.score as match_score,
         case when p.p_partkey % 11 = 0 then 'bad' when p.p_partkey % 13 = 0 then null
              else cast(round(p_retailprice / 3, 2) as varchar) end as cost,
         tn.active_ingredients as drugs
  from (select *, {MED_NAME} as med from part) p left join best on best.lname = {NORM.format(c="med")}
       left join tn on tn.brand = best.rname)"""


@register("medicine_mapping", "with " + MAPPING_CTES + """
select p_partkey, medicine_name, matched_drug, package_size, round(match_score, 6) as match_score, try_cast(cost as double) as cost, drugs
from mapping""")
def q_medicine_mapping(spark, sf_dir):
    """Medicine price rows matched to trade names for their ingredients."""
    from ..plans import pricing as PR

    t = fr.Tables(spark, sf_dir)
    out = PR.medicine_mapping(medicine_prices(t), trade_names(t), "p_partkey")
    return out.withColumns({"match_score": F.round("match_score", 6), "cost": F.expr("try_cast(cost as double)")})


def _drug_price_sql():
    """Both matchers by all pairs, the first price row of either name, the 3 nearest package sizes, cap,
    redraw, size from tablet names, first spelling of each drug."""
    norm = lambda c: NORM.format(c=c)
    match = brute_force_best_sql("select distinct drug as name from drugs", """select drugs as name from mp where drugs is not null
              union select medicine_name from mp where medicine_name is not null""", 80.0)
    return f"""with {CTE['prescriptions']},
mp as (with {MAPPING_CTES}
  select p_partkey, {norm('drugs')} as drugs, {norm('medicine_name')} as medicine_name, package_size, cost from mapping),
drugs as (select raw_drug, {norm('raw_drug')} as drug from (select distinct drug as raw_drug from prescriptions where drug is not null)),
matched as (with {match} select lname, rname from best),
either as (select drugs as name, p_partkey, medicine_name, package_size, cost from mp union all select medicine_name, p_partkey, medicine_name, package_size, cost from mp),
first as (select * from (select *, row_number() over (partition by name order by p_partkey) as rn from either where name is not null) where rn = 1),
priced as (select d.raw_drug, d.drug, f.medicine_name, try_cast(f.package_size as double) as package_size, try_cast(f.cost as double) as cost
           from drugs d left join matched m on d.drug = m.lname left join first f on m.rname = f.name),
donors as (select * from priced where cost is not null and package_size is not null),
imputed as (
  select p.*, coalesce(p.cost, n.cost, (select avg(cost) from priced)) as filled
  from priced p left join (
    select raw_drug, avg(cost) as cost from (
      select w.raw_drug, d.cost, row_number() over (partition by w.raw_drug order by abs(d.package_size - w.package_size), d.raw_drug) as rn
      from priced w join donors d on w.cost is null and w.package_size is not null) where rn <= 3 group by raw_drug) n on n.raw_drug = p.raw_drug),
redrawn as (
  select *, case when filled >= 400 then cast(100 as double) + cast(300 as double) * ({md5_number_sql('drug', 5)} / cast(1048576 as double))
                 else filled end as price from imputed),
sized as (
  select raw_drug, drug, medicine_name, coalesce(package_size, case when contains(lower(medicine_name), 'tab')
         then cast(try_cast(regexp_extract(medicine_name, '(\\d+)', 1) as int) as double) end) as package_size, price from redrawn)
select drug, medicine_name, package_size, round(price, 6) as cost
from (select *, row_number() over (partition by drug order by raw_drug) as rn from sized) where rn = 1"""


@register("drug_price_list", _drug_price_sql())
def q_drug_price_list(spark, sf_dir):
    """Prescribed drugs priced through both matchers, imputation, cap and redraw."""
    from ..plans import pricing as PR

    t = fr.Tables(spark, sf_dir)
    mapping = materialize(PR.medicine_mapping(medicine_prices(t), trade_names(t), "p_partkey"), "medicine-mapping")
    return PR.drug_price_list(fr.prescriptions(t), mapping, "p_partkey").withColumn("cost", F.round("cost", 6))


FEE_CATEGORY = """case n_nationkey % 3 when 0 then lower(n_name) when 1 then replace(lower(n_name), '_', ' ')
     else 'panel ' || lower(n_name) end"""
FEE_PRICE = "case when n_nationkey % 4 = 0 then 0.0 else (n_nationkey + 1) * 1.5 end"


def lab_fees(t):
    return t.nation.select("n_nationkey", F.expr(FEE_CATEGORY).alias("category"), F.expr(FEE_PRICE).alias("price"))


@register("lab_price_list", "with " + CTE_LAB_ITEMS + ", " + brute_force_best_sql(
    f"select distinct lower(trim({FEE_CATEGORY})) as name from nation",
    "select distinct lower(trim(label)) as name from lab_items", 80.0) + f"""
, fees as (select n_nationkey, lower(trim({FEE_CATEGORY})) as fee_category, {FEE_PRICE} as price from nation),
priced as (select best.rname as label, cast(fees.price as double) as price, fees.n_nationkey
           from fees join best on fees.fee_category = best.lname),
items as (select itemid, lower(trim(label)) as label, category from lab_items),
j as (select items.*, priced.price, priced.n_nationkey from items left join priced on items.label = priced.label),
f as (select label, category, price from (
        select *, row_number() over (partition by label order by itemid, n_nationkey nulls last) as rn
        from j where label is not null) where rn = 1),
d as (select * from (values ('blood gas', 8.0), ('chemistry', 75.0), ('hematology', 100.0)) v(k, dp))
select label, category,
       case when price is null or price = 0 then coalesce(d.dp, price) else price end as price
from f left join d on lower(f.category) = d.k""")
def q_lab_price_list(spark, sf_dir):
    from ..plans import pricing as PR

    t = fr.Tables(spark, sf_dir)
    return PR.lab_price_list(fr.lab_items(t), lab_fees(t), "itemid", "n_nationkey")
