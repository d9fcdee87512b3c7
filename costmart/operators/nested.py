"""Nested results: members of groups, a
document-style lookup, and distinct values per key.

The grain is the same at every size: one row per (key, member). A group is
never packed into an array here, so a key that holds a third of a table is
just many rows, spread over the tasks that hold them. Arrays are built only
for groups that are bounded already (``operators.windows.collect_ranked``
after a top-k).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _same_keys(left: DataFrame, keys: Sequence[str], prefix: str = "_g_") -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & left[k].eqNullSafe(F.col(prefix + k))
    return cond


def first_groups(df: DataFrame, keys: Sequence[str], n: int | None) -> DataFrame:
    """The rows of the first ``n`` keys in key order, nulls first (None: all rows)."""
    if n is None:
        return df
    first = df.select(*keys).distinct().orderBy(*[F.col(k).asc_nulls_first() for k in keys]).limit(n)
    first = first.select(*[F.col(k).alias("_g_" + k) for k in keys])
    return df.join(first, _same_keys(df, keys), "left_semi")


def nested_group(df: DataFrame, keys: Sequence[str], cols: Sequence[str] | None = None,
                 limit_groups: int | None = None) -> DataFrame:
    """Whole rows per key (``$group`` with ``$push: $$ROOT`` / Cypher ``collect``):
    the keys and the members' columns, one row per member. Null is a key like any other."""
    src = first_groups(df, keys, limit_groups)
    cols = [c for c in (cols if cols is not None else df.columns) if c not in keys]
    return src.select(*keys, *cols)


def lookup_nested(left: DataFrame, left_key: str, right: DataFrame, right_key: str, prefix: str = "",
                  matched: str = "matched") -> DataFrame:
    """``$lookup``: one row per left row and matching right row; a left row
    without a match appears once with ``matched`` false. Null matches null."""
    r = right.select(F.lit(True).alias("_hit"), F.col(right_key).alias("_lk"), *[F.col(c).alias(prefix + c) for c in right.columns])
    joined = left.join(r, left[left_key].eqNullSafe(r["_lk"]), "left")
    return joined.withColumn(matched, F.coalesce("_hit", F.lit(False))).drop("_hit", "_lk")


def collect_distinct(df: DataFrame, keys: Sequence[str], value_cols: Sequence[str]) -> DataFrame:
    """Distinct values per key (``$addToSet`` / ``collect(DISTINCT n)``), one row each."""
    return df.select(*keys, *value_cols).distinct()
