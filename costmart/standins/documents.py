"""Registered queries: the company queries in document and graph form.

Stand-ins: employees are customers (company = nation), policies are orders
(type = priority, claim = total price with every 5th null, vendor id from
the customer key with every 13th null), vendors are suppliers (every 17th
has a null id). Graph: Employee = customer, Insurance = order, Vendor =
supplier, HAS_EMPLOYEE = order -> customer, HAS_VENDOR = line -> supplier.

Each registered result is one row per returned group and member (top claims
with their rank), compared as whole rows with a flat oracle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..catalog import register
from ..plans import companies as CO
from . import frames as fr

CLAIM = "case when o_orderkey % 5 = 0 then null else o_totalprice end"
VENDOR_REF = "case when o_orderkey % 13 = 0 then null else cast(o_custkey % 100 as string) end"
VENDOR_ID = "case when s_suppkey % 17 = 0 then null else cast(s_suppkey as string) end"


def employee_docs(t):
    return t.customer.select(F.col("c_custkey").cast("string").alias("_id"), F.col("c_custkey").alias("emp_no"),
                             F.col("c_nationkey").cast("string").alias("AGENT_ID"), F.col("c_name").alias("name"))


def vendor_docs(t):
    return t.supplier.select(F.col("s_suppkey").cast("string").alias("_id"), F.col("s_suppkey").alias("vendor_no"),
                             F.expr(VENDOR_ID).alias("VENDOR_ID"), F.col("s_name").alias("name"))


def insurance_docs(t):
    o, c = t.orders, t.customer.select("c_custkey", "c_nationkey")
    j = o.join(c, o["o_custkey"] == c["c_custkey"], "inner")
    return j.select(F.col("o_orderkey").cast("string").alias("_id"), F.col("o_orderkey").alias("policy_no"),
                    F.col("c_nationkey").cast("string").alias("AGENT_ID"), F.expr(VENDOR_REF).alias("VENDOR_ID"),
                    F.col("o_orderpriority").alias("INSURANCE_TYPE"), F.expr(CLAIM).alias("CLAIM_AMOUNT"))


def _members(df, query, company, category, member, name=None, amount=None, rank=None):
    """Registered form: one row per group member."""
    return df.select(F.lit(query).alias("query"), F.col(company).alias("company"),
                     (F.col(category) if category else F.lit(None).cast("string")).alias("category"),
                     F.col(member).cast("long").alias("member"), (F.col(name) if name else F.lit(None)).cast("string").alias("name"),
                     (F.col(amount) if amount else F.lit(None)).cast("double").alias("amount"),
                     (F.col(rank) if rank else F.lit(None)).cast("int").alias("rank"))


def _ranked(df, keys, fields):
    """Top-k arrays unpacked with their place."""
    members = df.select(*keys, F.posexplode("top_claims").alias("_pos", "_m"))
    return members.select(*keys, (F.col("_pos") + 1).alias("rank"), *[F.col("_m").getField(f).alias(f) for f in fields])


def _union(parts):
    return reduce(lambda a, b: a.unionByName(b), parts)


def doc_ctes(limit):
    """The stand-ins as CTEs; ``limit``: text that ends a query for the first groups."""
    return f"""with emp as (select cast(c_nationkey as varchar) as AGENT_ID, c_custkey as emp_no, c_name as name from customer),
ven as (select s_suppkey as vendor_no, {VENDOR_ID} as VENDOR_ID, s_name as name from supplier),
ins as (select o_orderkey as policy_no, cast(c_nationkey as varchar) as AGENT_ID, {VENDOR_REF} as VENDOR_ID,
               o_orderpriority as INSURANCE_TYPE, {CLAIM} as CLAIM_AMOUNT
        from orders join customer on o_custkey = c_custkey),
ge as (select distinct AGENT_ID from emp order by AGENT_ID nulls first {limit}),
gi as (select distinct AGENT_ID from ins order by AGENT_ID nulls first {limit}),
gp as (select distinct AGENT_ID, INSURANCE_TYPE from ins
       order by AGENT_ID nulls first, INSURANCE_TYPE nulls first {limit}),
lk as (select distinct i.AGENT_ID, case when v.vendor_no is null then null else i.VENDOR_ID end as ref, v.vendor_no, v.name
       from ins i left join ven v on i.VENDOR_ID is not distinct from v.VENDOR_ID
       where i.AGENT_ID in (select AGENT_ID from gi)),
top as (select * from (select *, row_number() over (partition by AGENT_ID, INSURANCE_TYPE
                                                    order by CLAIM_AMOUNT desc nulls last, policy_no) as rk from ins)
        where rk <= 5)
"""


def doc_sql(limit):
    return doc_ctes(limit) + """
select 'employees' as query, AGENT_ID as company, cast(null as varchar) as category, cast(emp_no as bigint) as member, name,
       cast(null as double) as amount, cast(null as integer) as rank
from emp where AGENT_ID in (select AGENT_ID from ge)
union all
select 'vendors', AGENT_ID, ref, cast(vendor_no as bigint), name, null, null from lk
union all
select 'policies', AGENT_ID, INSURANCE_TYPE, cast(policy_no as bigint), null, CLAIM_AMOUNT, null
from ins where (AGENT_ID, INSURANCE_TYPE) in (select (AGENT_ID, INSURANCE_TYPE) from gp)
union all
select 'top_claims', AGENT_ID, INSURANCE_TYPE, cast(policy_no as bigint), null, CLAIM_AMOUNT, cast(rk as integer) from top
"""


def _doc_queries(spark, sf_dir, **limit):
    t = fr.Tables(spark, sf_dir)
    emp, ven, ins = employee_docs(t), vendor_docs(t), insurance_docs(t)
    v = CO.vendors_by_company(ins, ven, **limit)
    p = CO.policies_by_company_and_type(ins, **limit)
    k = _ranked(CO.top_claims_by_company_and_type(ins, "policy_no"), ["company", "insurance_type"], ["policy_no", "CLAIM_AMOUNT"])
    return _union([_members(CO.employees_by_company(emp, **limit), "employees", "company", None, "emp_no", "name"),
                   _members(v, "vendors", "company", "vendor_ref", "v_vendor_no", "v_name"),
                   _members(p, "policies", "company", "insurance_type", "policy_no", amount="CLAIM_AMOUNT"),
                   _members(k, "top_claims", "company", "insurance_type", "policy_no", amount="CLAIM_AMOUNT", rank="rank")])


@register("company_doc_queries", doc_sql("limit 20"))
def q_company_doc_queries(spark, sf_dir):
    return _doc_queries(spark, sf_dir)


@register("company_doc_queries_all", doc_sql(""))
def q_company_doc_queries_all(spark, sf_dir):
    """Every group, without the reference's limit."""
    return _doc_queries(spark, sf_dir, limit=None)


# ---------------------------------------------------------------- graph form

def graph_frames(t):
    employee = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_nationkey").cast("string").alias("agentId"),
                                 F.col("c_name").alias("agentName"))
    insurance = t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("insuranceType"),
                                F.expr(CLAIM).alias("claimAmount"))
    vendor = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    has_employee = t.orders.select(F.col("o_orderkey").alias("src"), F.col("o_custkey").alias("dst"))
    has_vendor = t.lineitem.select(F.col("l_orderkey").alias("src"), F.col("l_suppkey").alias("dst"))
    return employee, insurance, vendor, has_employee, has_vendor


def graph_sql(limit):
    return f"""with emp as (select c_custkey as id, cast(c_nationkey as varchar) as agentId, c_name as agentName from customer),
pol as (select o_orderkey as id, o_orderpriority as insuranceType, {CLAIM} as claimAmount, o_custkey as emp_id from orders),
ge as (select distinct agentId from emp order by agentId nulls first {limit}),
vp as (select distinct e.agentId as agent, e.agentName as employeeName, l_suppkey as vendor_id, s_name as name
       from emp e join orders on o_custkey = e.id join lineitem on l_orderkey = o_orderkey join supplier on l_suppkey = s_suppkey),
gv as (select distinct agent, employeeName from vp order by agent nulls first, employeeName nulls first {limit}),
pp as (select p.*, e.agentId as company from pol p join emp e on p.emp_id = e.id),
gp as (select distinct company, insuranceType from pp order by company nulls first, insuranceType nulls first {limit}),
top as (select * from (select *, row_number() over (partition by company, insuranceType
                                                    order by claimAmount desc, id) as rk
                       from pp where claimAmount is not null) where rk <= 5)
select 'employees' as query, agentId as company, cast(null as varchar) as category, cast(id as bigint) as member, agentName as name,
       cast(null as double) as amount, cast(null as integer) as rank
from emp where agentId in (select agentId from ge)
union all
select 'vendors', agent, employeeName, cast(vendor_id as bigint), name, null, null
from vp where (agent, employeeName) in (select (agent, employeeName) from gv)
union all
select 'policies', company, insuranceType, cast(id as bigint), null, claimAmount, null
from pp where (company, insuranceType) in (select (company, insuranceType) from gp)
union all
select 'top_claims', company, insuranceType, cast(id as bigint), null, claimAmount, cast(rk as integer) from top
"""


def _graph_queries(spark, sf_dir, **limit):
    employee, insurance, vendor, has_employee, has_vendor = graph_frames(fr.Tables(spark, sf_dir))
    v = CO.vendors_by_company_graph(employee, has_employee, insurance, has_vendor, vendor, **limit)
    p = CO.policies_by_company_and_type_graph(insurance, has_employee, employee, **limit)
    k = _ranked(CO.top_claims_graph(insurance, has_employee, employee), ["company", "category"], ["p_id", "p_claimAmount"])
    return _union([_members(CO.employees_by_company_graph(employee, **limit), "employees", "company", None, "id", "agentName"),
                   _members(v, "vendors", "agent", "employeeName", "v_id", "v_name"),
                   _members(p, "policies", "company", "category", "p_id", amount="p_claimAmount"),
                   _members(k, "top_claims", "company", "category", "p_id", amount="p_claimAmount", rank="rank")])


@register("company_graph_queries", graph_sql("limit 20"))
def q_company_graph_queries(spark, sf_dir):
    return _graph_queries(spark, sf_dir)


@register("company_graph_queries_all", graph_sql(""))
def q_company_graph_queries_all(spark, sf_dir):
    """Every group, without the reference's limit."""
    return _graph_queries(spark, sf_dir, limit=None)


@register("vendors_by_company_flat", doc_ctes("") + """
select distinct AGENT_ID as company, vendor_no from lk where vendor_no is not null""")
def q_vendors_by_company_flat(spark, sf_dir):
    """The vendor sets of all companies flattened to distinct (company, vendor) rows."""
    t = fr.Tables(spark, sf_dir)
    flat = CO.vendors_by_company_flat(insurance_docs(t), vendor_docs(t), limit=None)
    return flat.select("company", "vendor_no")
