"""Registered queries: ranking, sorts, limits and arrays."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..catalog import register
from ..functions import columns as C
from ..operators import aggregates as A
from ..operators import windows as W
from . import frames as fr


def _t(spark, sf_dir):
    return fr.Tables(spark, sf_dir)


@register("modal_value", """
with c as (select l_partkey, l_suppkey, count(*) as n from lineitem group by all)
select l_partkey, l_suppkey as modal_suppkey, n as modal_count
from (select *, row_number() over (partition by l_partkey order by n desc, l_suppkey) as rn from c) where rn = 1""")
def q_modal_value(spark, sf_dir):
    li = _t(spark, sf_dir).lineitem.select("l_partkey", "l_suppkey")
    return W.modal_value(li, ["l_partkey"], "l_suppkey", out="modal_suppkey", count_out="modal_count")


CLAIM = "case when o_orderkey % 5 = 0 then null else o_totalprice end"
CLAIMS_SQL = f"""claims as (select c_nationkey, o_orderpriority, o_orderkey, {CLAIM} as claim
                 from orders join customer on o_custkey = c_custkey)"""


def _claims(t):
    o, c = t.orders, t.customer.select("c_custkey", "c_nationkey")
    return (o.join(c, o["o_custkey"] == c["c_custkey"], "inner")
             .select("c_nationkey", "o_orderpriority", "o_orderkey", F.expr(CLAIM).alias("claim")))


@register("top_k_per_group", f"""
with {CLAIMS_SQL}
select * from (select *, cast(row_number() over (partition by c_nationkey, o_orderpriority
                                            order by claim desc nulls last, o_orderkey) as int) as rank from claims)
where rank <= 5""")
def q_top_k_per_group(spark, sf_dir):
    return W.top_k_per_group(_claims(_t(spark, sf_dir)), ["c_nationkey", "o_orderpriority"], "claim", 5,
                             tie=["o_orderkey"])


@register("sort_desc", "select o_orderkey, o_totalprice from orders order by o_totalprice desc nulls last, o_orderkey")
def q_sort_desc(spark, sf_dir):
    return A.sort_desc(_t(spark, sf_dir).orders.select("o_orderkey", "o_totalprice"), ["o_totalprice"], ["o_orderkey"])


@register("limit_n", """
select o_custkey, round(avg(o_totalprice), 6) as mean from orders group by o_custkey
order by avg(o_totalprice) desc, o_custkey limit 10""")
def q_limit_n(spark, sf_dir):
    m = A.group_stats(_t(spark, sf_dir).orders, ["o_custkey"], "o_totalprice", stats=("mean",))
    top = A.limit_n(m, 10, [F.col("mean").desc(), F.col("o_custkey")])
    return top.withColumn("mean", F.round("mean", 6))


@register("array_slice", f"""
with {CLAIMS_SQL},
r as (select *, row_number() over (partition by c_nationkey, o_orderpriority
                                   order by claim desc nulls last, o_orderkey) as rank from claims)
select c_nationkey, o_orderpriority, string_agg(cast(o_orderkey as varchar), ',' order by rank) as top_ids
from r where rank <= 3 group by all""")
def q_array_slice(spark, sf_dir):
    """Top-10 claims packed per group, then the first 3 sliced off the array."""
    top = W.top_k_per_group(_claims(_t(spark, sf_dir)), ["c_nationkey", "o_orderpriority"], "claim", 10,
                            tie=["o_orderkey"])
    packed = W.collect_ranked(top, ["c_nationkey", "o_orderpriority"], "rank", ["o_orderkey", "claim"], "claims")
    first3 = W.array_slice("claims", 1, 3)
    return packed.select("c_nationkey", "o_orderpriority",
                         F.array_join(F.transform(first3, lambda x: x["o_orderkey"].cast("string")), ",").alias("top_ids"))


@register("unwind", """
with r as (select l_orderkey, l_linenumber,
                  list_filter(string_split_regex(trim(regexp_replace(
                      case when l_linenumber = 7 then ' ' else cast(l_suppkey as varchar) || ' ,' || cast(l_partkey % 3 as varchar) end,
                      ',', ' ', 'g')), '[ \\t\\n\\x0B\\f\\r]+'), lambda t: t <> '') as codes
           from lineitem)
select l_orderkey, l_linenumber, unnest(codes) as code from r""")
def q_unwind(spark, sf_dir):
    li = _t(spark, sf_dir).lineitem
    gsn = F.expr("case when l_linenumber = 7 then ' ' else "
                 "concat(cast(l_suppkey as string), ' ,', cast(l_partkey % 3 as string)) end")
    arr = li.select("l_orderkey", "l_linenumber", C.code_tokens(gsn).alias("code"))
    return W.unwind(arr, "code")
