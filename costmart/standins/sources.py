"""Registered queries: readers and writers.

Round trips write under the session's shared checkpoint folder.
(#4, the JDBC truncate-and-load, needs a database and is not registered.)
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..catalog import register
from ..plans import companies
from ..session import scratch_path
from ..sources import files as S
from . import documents
from . import frames as fr


@register("scan_csv_strings", """
select cast(n_nationkey as varchar) as n_nationkey, n_name || ', region ' || cast(n_regionkey as varchar) as n_name,
       cast(n_regionkey as varchar) as n_regionkey
from nation""")
def q_scan_csv_strings(spark, sf_dir):
    """Nation written as CSV with a quoted comma in the name, read back as text."""
    n = fr.Tables(spark, sf_dir).nation
    n = n.withColumn("n_name", F.concat("n_name", F.lit(", region "), F.col("n_regionkey").cast("string")))
    path = scratch_path(spark, "nation-csv")
    S.sink_csv(n, path)
    return S.scan_csv_strings(spark, path, ["n_nationkey", "n_name", "n_regionkey"])


@register("scan_csv_typed", """
select cast(o_orderkey as varchar) as o_orderkey, cast(o_orderdate as date) as o_orderdate,
       case when o_orderkey % 9 = 0 then null else o_totalprice end as o_totalprice, o_orderpriority
from orders""")
def q_scan_csv_typed(spark, sf_dir):
    """Orders as CSV (some prices malformed), read with ids as text, dates parsed, prices cast."""
    o = fr.Tables(spark, sf_dir).orders
    o = o.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"),
                 F.when(F.col("o_orderkey") % 9 == 0, F.lit("n/a"))
                  .otherwise(F.col("o_totalprice").cast("string")).alias("o_totalprice"), "o_orderpriority")
    path = scratch_path(spark, "orders-csv")
    S.sink_csv(o, path)
    return S.scan_csv_typed(spark, path, ["o_orderkey", "o_orderdate", "o_totalprice", "o_orderpriority"],
                            casts={"o_totalprice": "double"}, dates=["o_orderdate"])


@register("sink_parquet_overwrite", """
select o_orderkey, o_custkey, o_totalprice from orders where o_orderstatus = 'F'""")
def q_sink_parquet_overwrite(spark, sf_dir):
    """Written twice to one path (second write replaces the first), read back."""
    o = fr.Tables(spark, sf_dir).orders
    path = scratch_path(spark, "orders-parquet")
    S.sink_parquet_overwrite(o.select("o_orderkey", "o_custkey", "o_totalprice"), path)
    S.sink_parquet_overwrite(o.where(F.col("o_orderstatus") == "F").select("o_orderkey", "o_custkey", "o_totalprice"),
                             path)
    return S.scan_parquet(spark, path)


@register("scan_parquet", """
select l_orderkey, l_extendedprice from lineitem where l_returnflag = 'R'""")
def q_scan_parquet(spark, sf_dir):
    """Parquet by path with two columns and a filter, both pushed into the scan."""
    li = S.scan_parquet(spark, f"{sf_dir.rstrip('/')}/lineitem.parquet")
    return li.where(F.col("l_returnflag") == "R").select("l_orderkey", "l_extendedprice")


@register("sink_csv", """
select p_name as drug, arg_min(p_retailprice, p_partkey) as cost
from part group by p_name having not starts_with(p_name, 'red')""")
def q_sink_csv(spark, sf_dir):
    """The drug price list written as headered CSV and read back."""
    prices = fr.drug_price(fr.Tables(spark, sf_dir))
    path = scratch_path(spark, "drug-price-csv")
    S.sink_csv(prices, path)
    return S.scan_csv_typed(spark, path, ["drug", "cost"], casts={"cost": "double"})


@register("docs_to_json", """
select o_orderkey, cast(o_orderkey as varchar) as id_text, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.000') as date_text,
       case when o_orderkey % 7 <> 0 then o_orderpriority end as priority_text, o_orderkey % 7 = 0 as null_written
from orders""")
def q_docs_to_json(spark, sf_dir):
    """Orders rendered as JSON documents (id as text, ISO timestamps, nulls kept); fields read back from the text."""
    o = fr.Tables(spark, sf_dir).orders.select(F.col("o_orderkey").cast("string").alias("_id"), "o_orderdate",
                                               F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderpriority")).alias("o_orderpriority"))
    docs = S.docs_to_json(o, ["_id", "o_orderdate", "o_orderpriority"], out="doc")
    return docs.select(F.get_json_object("doc", "$._id").cast("long").alias("o_orderkey"),
                       F.get_json_object("doc", "$._id").alias("id_text"),
                       F.get_json_object("doc", "$.o_orderdate").alias("date_text"),
                       F.get_json_object("doc", "$.o_orderpriority").alias("priority_text"),
                       F.col("doc").contains('"o_orderpriority":null').alias("null_written"))


@register("docs_to_json_nested", documents.doc_ctes("") + """
select AGENT_ID as company, INSURANCE_TYPE as insurance_type, count(*) as members,
       count(*) filter (where CLAIM_AMOUNT is null) as null_claims,
       max(policy_no) filter (where rk = 1) as first_policy, max(VENDOR_ID) filter (where rk = 1) as first_vendor
from top group by all""")
def q_docs_to_json_nested(spark, sf_dir):
    """The top-claim groups rendered as nested documents, null claims included."""
    top = companies.top_claims_by_company_and_type(documents.insurance_docs(fr.Tables(spark, sf_dir)), "policy_no", k=5)
    docs = S.docs_to_json(top, out="doc")
    field = lambda path: F.get_json_object("doc", path)
    return docs.select(field("$.company").alias("company"), field("$.insurance_type").alias("insurance_type"),
                       F.regexp_count("doc", F.lit('"_id":')).cast("long").alias("members"),
                       F.regexp_count("doc", F.lit('"CLAIM_AMOUNT":null')).cast("long").alias("null_claims"),
                       field("$.top_claims[0].policy_no").cast("long").alias("first_policy"),
                       field("$.top_claims[0].VENDOR_ID").alias("first_vendor"))
