"""Registered queries: set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..catalog import register
from ..operators import sets as S
from . import frames as fr


@register("union_distinct", """
select cast(o_orderdate as date) as calendar_date from orders
union select cast(l_shipdate as date) from lineitem""")
def q_union_distinct(spark, sf_dir):
    t = fr.Tables(spark, sf_dir)
    return S.union_distinct(t.orders.select(F.col("o_orderdate").cast("date").alias("calendar_date")),
                            t.lineitem.select(F.col("l_shipdate").cast("date").alias("calendar_date")))


@register("union_by_name", """
select l_orderkey as admission_id, l_suppkey as lab_item_id, cast(null as bigint) as part_id, 'LAB' as event_type,
       cast(null as double) as dose
from lineitem
union all
select l_orderkey, null, l_partkey, 'MED', l_quantity from lineitem""")
def q_union_by_name(spark, sf_dir):
    li = fr.Tables(spark, sf_dir).lineitem
    lab = li.select(F.col("l_orderkey").alias("admission_id"), F.col("l_suppkey").alias("lab_item_id"),
                    F.lit("LAB").alias("event_type"))
    med = li.select(F.col("l_orderkey").alias("admission_id"), F.col("l_partkey").alias("part_id"),
                    F.lit("MED").alias("event_type"), F.col("l_quantity").alias("dose"))
    return S.union_by_name(lab, med)
