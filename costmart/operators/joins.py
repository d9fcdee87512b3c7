"""Joins: equi joins, star and role-playing dimensions, graph
paths as joins through edge tables, and the either-of-two-columns lookup.

No join here carries a broadcast hint on a side that grows with the data:
Spark's own size check (``autoBroadcastJoinThreshold`` on plan statistics,
re-checked by AQE on runtime shuffle sizes) decides by bytes, and a sort-merge
join with AQE skew splitting is the way beyond it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.frames import suffix_columns


def join_left_using(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    return left.join(right, on=[on] if isinstance(on, str) else list(on), how="left")


def join_inner_using(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    return left.join(right, on=[on] if isinstance(on, str) else list(on), how="inner")


def join_left_on_expr(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                      keep_right_key: bool = False) -> DataFrame:
    """Left join on differently named keys; the right key is dropped unless asked for."""
    out = left.join(right, left[left_key] == right[right_key], "left")
    return out if keep_right_key else out.drop(right[right_key])


def join_chain_inner(df: DataFrame, steps: Sequence[tuple[DataFrame, str | tuple[str, str]]]) -> DataFrame:
    """``df ⋈ d1 ⋈ d2 ...``: each step joins on a shared name or a (left, right) key pair."""
    out = df
    for dim, key in steps:
        if isinstance(key, str):
            out = out.join(dim, key, "inner")
        else:
            lk, rk = key
            out = out.join(dim, out[lk] == dim[rk], "inner")
    return out


def join_role_dim(fact: DataFrame, dim: DataFrame, roles: Mapping[str, str], dim_key: str) -> DataFrame:
    """Join one dimension once per role: ``{suffix: fact_key}``; dim columns get the suffix."""
    out = fact
    for suffix, fact_key in roles.items():
        d = suffix_columns(dim, suffix)
        out = out.join(d, out[fact_key] == d[dim_key + suffix], "left")
    return out


def one_row_per_key(dim: DataFrame, key: str) -> DataFrame:
    """First row per key by all columns in order (repeatable): removes join fan-out."""
    others = [c for c in dim.columns if c != key]
    if not others:
        return dim.distinct()
    picked = dim.groupBy(key).agg(F.min(F.struct(*others)).alias("_r"))
    return picked.select(key, *[F.col("_r." + c).alias(c) for c in others])


def join_star(fact: DataFrame, dims: Sequence[tuple[DataFrame, str, str]],
              one_row_per_dim_key: bool = False) -> DataFrame:
    """Fact left-joined to each ``(dim, fact_key, dim_key)``.

    By default a dimension key that repeats multiplies fact rows (the
    reference's behaviour); ``one_row_per_dim_key`` keeps the first row per key.
    """
    out = fact
    for dim, fkey, dkey in dims:
        d = one_row_per_key(dim, dkey) if one_row_per_dim_key else dim
        if fkey == dkey:
            out = out.join(d, fkey, "left")
        else:
            out = out.join(d, out[fkey] == d[dkey], "left")
    return out


def path_one_hop(a: DataFrame, a_key: str, edge: DataFrame, edge_a: str, edge_b: str,
                 b: DataFrame, b_key: str) -> DataFrame:
    """``(a)-[edge]-(b)``: two inner equi joins through the edge table."""
    e = edge.select(F.col(edge_a).alias("_ea"), F.col(edge_b).alias("_eb"))
    return (a.join(e, a[a_key] == e["_ea"], "inner")
             .join(b, F.col("_eb") == b[b_key], "inner")
             .drop("_ea", "_eb"))


def path_two_hop(a: DataFrame, a_key: str, edge1: DataFrame, e1_mid: str, e1_a: str,
                 mid: DataFrame, mid_key: str, edge2: DataFrame, e2_mid: str, e2_b: str,
                 b: DataFrame, b_key: str) -> DataFrame:
    """``(a)<-[edge1]-(mid)-[edge2]->(b)``: one row per matching path."""
    e1 = edge1.select(F.col(e1_mid).alias("_m1"), F.col(e1_a).alias("_a"))
    e2 = edge2.select(F.col(e2_mid).alias("_m2"), F.col(e2_b).alias("_b"))
    m = mid.join(e1, mid[mid_key] == e1["_m1"], "inner").join(e2, F.col("_m1") == e2["_m2"], "inner")
    return (m.join(a, F.col("_a") == a[a_key], "inner")
             .join(b, F.col("_b") == b[b_key], "inner")
             .drop("_m1", "_m2", "_a", "_b"))


def lookup_either_column(df: DataFrame, key: str, ref: DataFrame, match_cols: Sequence[str],
                         order: str, prefix: str = "") -> DataFrame:
    """For each ``df[key]``, the first ``ref`` row (by ``order``) whose any of ``match_cols`` equals it.

    The OR condition is rewritten as a union of one equi-keyed copy of
    ``ref`` per column, reduced to the first row per key by a partially
    aggregated ``min_by``, then one hash join: never a nested-loop join.
    """
    payload = [c for c in ref.columns]
    branches = [
        ref.select(F.col(c).alias("_lk"), F.col(order).alias("_ord"), F.struct(*payload).alias("_row"))
           .where(F.col("_lk").isNotNull())
        for c in match_cols
    ]
    cand = branches[0]
    for b in branches[1:]:
        cand = cand.unionByName(b)
    first = cand.groupBy("_lk").agg(F.min_by("_row", "_ord").alias("_row"))
    first = first.select("_lk", *[F.col("_row." + c).alias(prefix + c) for c in payload])
    return df.join(first, df[key] == first["_lk"], "left").drop("_lk")
