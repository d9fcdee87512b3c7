"""Ranking per group: modal value and top-k per group.

``top_k_per_group`` filters ``row_number() <= k``; Spark plans that as a
``WindowGroupLimit`` that runs once *before* the shuffle (each map task
keeps at most k rows per group) and once after, so a group holding a third
of all rows never reaches a reducer whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def modal_value(df: DataFrame, keys: Sequence[str], col: str, out: str = "modal",
                count_out: str | None = None) -> DataFrame:
    """Most frequent non-null ``col`` per key; ties go to the smallest value.

    Counting is a partially aggregated group-by on (keys, value); the pick is
    a second partially aggregated ``min_by`` on (-count, value).
    """
    counts = (df.where(F.col(col).isNotNull())
                .groupBy(*keys, col).agg(F.count(F.lit(1)).alias("_n")))
    picked = counts.groupBy(*keys).agg(
        F.min_by(F.struct(F.col(col).alias("v"), F.col("_n").alias("n")),
                 F.struct((-F.col("_n")).alias("neg_n"), F.col(col).alias("v"))).alias("_best"))
    cols = [*keys, F.col("_best.v").alias(out)]
    if count_out:
        cols.append(F.col("_best.n").alias(count_out))
    return picked.select(*cols)


def top_k_per_group(df: DataFrame, keys: Sequence[str], measure: str, k: int,
                    tie: Sequence[str] = (), keep_null: bool = True, rank_col: str = "rank") -> DataFrame:
    """The ``k`` rows with the largest ``measure`` per group, one row each with its rank.

    ``keep_null=True`` (document-store form): null measures sort last and
    fill the list when a group has fewer than k others; all-null groups stay.
    ``keep_null=False`` (graph form): null measures are dropped first, so
    all-null groups vanish. Ties are broken by ``tie`` ascending.
    """
    src = df if keep_null else df.where(F.col(measure).isNotNull())
    w = Window.partitionBy(*keys).orderBy(F.col(measure).desc_nulls_last(),
                                          *[F.col(t).asc_nulls_last() for t in tie])
    return src.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= F.lit(k))


def collect_ranked(df: DataFrame, keys: Sequence[str], rank_col: str, cols: Sequence[str],
                   out: str) -> DataFrame:
    """Pack already-bounded ranked rows (e.g. top-k) into one ordered array per group."""
    s = F.struct(F.col(rank_col).alias("_rank"), *[F.col(c) for c in cols])
    arr = F.transform(F.sort_array(F.collect_list(s)), lambda x: x.dropFields("_rank"))
    return df.groupBy(*keys).agg(arr.alias(out))


def array_slice(c: str | Column, start: int = 1, n: int = 5) -> Column:
    """``n`` elements from the 1-based ``start`` (``claims[0..5]`` is ``start=1, n=5``)."""
    return F.slice(F.col(c) if isinstance(c, str) else c, start, n)


def unwind(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """One row per array element; null and empty arrays produce no row."""
    return df.withColumn(out or col, F.explode(col))
