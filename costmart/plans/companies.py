"""Insurance-company queries (SURVEY §2.10 ``company_doc_queries`` /
``company_graph_queries``): employees, vendors and policies grouped by
company, and the top claims per (company, insurance type), each in a
document form and a graph form.

Document form: frames ``employee`` (AGENT_ID, ...), ``vendor`` (VENDOR_ID,
...), ``insurance`` (AGENT_ID, VENDOR_ID, INSURANCE_TYPE, CLAIM_AMOUNT,
...). Graph form: node frames with an ``id`` column and edge frames
``(src, dst)``; a path pattern is a chain of equi joins.

Results hold one row per (group, member) at any size (``operators.nested``);
only the top claims, bounded by k, are arrays. The first 20 groups in key
order are the reference's limit; ``limit=None`` returns all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixed import GROUP_LIMIT, TOP_CLAIMS
from ..operators import joins as J
from ..operators import nested as N
from ..operators import windows as W


def employees_by_company(employee: DataFrame, limit: int | None = GROUP_LIMIT) -> DataFrame:
    """One row per company and employee."""
    return N.nested_group(employee, ["AGENT_ID"], limit_groups=limit).withColumnRenamed("AGENT_ID", "company")


def vendors_by_company(insurance: DataFrame, vendor: DataFrame, limit: int | None = GROUP_LIMIT) -> DataFrame:
    """The set of looked-up vendor lists per company, one row per vendor in each.

    ``vendor_ref`` names the list. All references without a vendor give the
    same empty list, so a company has at most one row with ``matched`` false.
    References are made distinct before the lookup: the same set, and no
    policy carries vendors through a shuffle.
    """
    src = N.first_groups(insurance.select("AGENT_ID", "VENDOR_ID"), ["AGENT_ID"], limit)
    refs = N.collect_distinct(src, ["AGENT_ID"], ["VENDOR_ID"]).select(F.col("AGENT_ID").alias("company"), F.col("VENDOR_ID").alias("vendor_ref"))
    looked = N.lookup_nested(refs, "vendor_ref", vendor, "VENDOR_ID", prefix="v_")
    return looked.withColumn("vendor_ref", F.when(F.col("matched"), F.col("vendor_ref"))).distinct()


def vendors_by_company_flat(insurance: DataFrame, vendor: DataFrame, limit: int | None = GROUP_LIMIT) -> DataFrame:
    """The same flattened to distinct vendors per company."""
    nested = vendors_by_company(insurance, vendor, limit)
    return nested.where("matched").select("company", *[F.col("v_" + c).alias(c) for c in vendor.columns]).distinct()


def policies_by_company_and_type(insurance: DataFrame, limit: int | None = GROUP_LIMIT) -> DataFrame:
    """One row per (company, type) and policy."""
    g = N.nested_group(insurance, ["AGENT_ID", "INSURANCE_TYPE"], limit_groups=limit)
    return g.withColumnRenamed("AGENT_ID", "company").withColumnRenamed("INSURANCE_TYPE", "insurance_type")


def top_claims_by_company_and_type(insurance: DataFrame, order: str, k: int = TOP_CLAIMS) -> DataFrame:
    """Top k claims per (company, type); null amounts sort last and are kept (document form)."""
    top = W.top_k_per_group(insurance, ["AGENT_ID", "INSURANCE_TYPE"], "CLAIM_AMOUNT", k, tie=[order])
    cols = [c for c in insurance.columns]
    packed = W.collect_ranked(top, ["AGENT_ID", "INSURANCE_TYPE"], "rank", cols, "top_claims")
    return packed.withColumnRenamed("AGENT_ID", "company").withColumnRenamed("INSURANCE_TYPE", "insurance_type")


# ---------------------------------------------------------------- graph form

def employees_by_company_graph(employee: DataFrame, limit: int | None = GROUP_LIMIT) -> DataFrame:
    """``MATCH (e:Employee) RETURN e.agentId AS company, collect(e)``."""
    return N.nested_group(employee, ["agentId"], limit_groups=limit).withColumnRenamed("agentId", "company")


def vendors_by_company_graph(employee: DataFrame, has_employee: DataFrame, insurance: DataFrame,
                             has_vendor: DataFrame, vendor: DataFrame, limit: int | None = GROUP_LIMIT) -> DataFrame:
    """``(e)<-[HAS_EMPLOYEE]-(i)-[HAS_VENDOR]->(v)``: distinct vendors per (agent, employee name).

    Returns both ``agent`` and ``employeeName`` (the reference drops the name
    it groups by).
    """
    e = employee.select(F.col("id").alias("e_id"), F.col("agentId").alias("agent"),
                        F.col("agentName").alias("employeeName"))
    v = vendor.select(*[F.col(c).alias("v_" + c) for c in vendor.columns])
    paths = J.path_two_hop(e, "e_id", has_employee, "src", "dst", insurance.select(F.col("id").alias("i_id")), "i_id",
                           has_vendor, "src", "dst", v, "v_id")
    keys = ["agent", "employeeName"]
    distinct = N.collect_distinct(paths, keys, ["v_" + c for c in vendor.columns])
    return N.first_groups(distinct, keys, limit)


def _policy_paths(insurance: DataFrame, has_employee: DataFrame, employee: DataFrame) -> DataFrame:
    i = insurance.select(*[F.col(c).alias("p_" + c) for c in insurance.columns])
    e = employee.select(F.col("id").alias("e_id"), F.col("agentId").alias("company"))
    return J.path_one_hop(i, "p_id", has_employee, "src", "dst", e, "e_id")


def policies_by_company_and_type_graph(insurance: DataFrame, has_employee: DataFrame, employee: DataFrame,
                                       limit: int | None = GROUP_LIMIT) -> DataFrame:
    """``(p:Insurance)-[HAS_EMPLOYEE]->(e)``: policies per (agentId, insuranceType)."""
    paths = _policy_paths(insurance, has_employee, employee).withColumnRenamed("p_insuranceType", "category")
    pcols = [c for c in paths.columns if c.startswith("p_")]
    return N.nested_group(paths, ["company", "category"], cols=pcols, limit_groups=limit)


def top_claims_graph(insurance: DataFrame, has_employee: DataFrame, employee: DataFrame,
                     k: int = TOP_CLAIMS) -> DataFrame:
    """Top k non-null claims per (agentId, insuranceType); all-null groups vanish (graph form)."""
    paths = _policy_paths(insurance, has_employee, employee).withColumnRenamed("p_insuranceType", "category")
    top = W.top_k_per_group(paths, ["company", "category"], "p_claimAmount", k, tie=["p_id"], keep_null=False)
    pcols = [c for c in paths.columns if c.startswith("p_")]
    return W.collect_ranked(top, ["company", "category"], "rank", pcols, "top_claims")
