"""Set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_distinct(*dfs: DataFrame) -> DataFrame:
    """Stack by position and drop duplicates (one shuffle on the whole row)."""
    return reduce(lambda a, b: a.union(b), dfs).distinct()


def union_by_name(*dfs: DataFrame, allow_missing: bool = True) -> DataFrame:
    """Stack by column name; a column missing on one side is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), dfs)
