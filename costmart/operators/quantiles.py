"""Exact quantiles (linear interpolation) without gathering a group in one task.

Spark's exact ``percentile`` merges every distinct value of a group in one
task; a group holding a third of a 100 TB table would not fit. Here the values
needed are found by radix selection on order-preserving longs
(``functions.bits``), a digit at a time from the highest:

1. rows are counted per group and first digit (sign, exponent and eight bits of
   the fraction), partially aggregated, with each cell's smallest and largest
   value; sums of counts give the group's size and so the ranks needed, ``floor``
   and ``ceil`` of ``p * (n - 1)`` for every probability, and a running sum the
   cell that holds each rank;
2. the rows of those cells are written once, a small part of the input; each
   further pass counts them by one more digit, within the cells still open;
3. a cell of one value (smallest = largest) is the answer. The digits are
   ``DIGITS``, 64 bits in all: there are at most five passes by construction,
   whatever the values. NaN and both infinities are values like any other (NaN
   the greatest, as Spark and SQL order it); the input is read twice.

No values are collected, at any size. The driver reads one scalar per pass (is
a cell still open). Targets are few rows in a small Parquet table, which Spark
broadcasts by its byte threshold; beyond that they join by a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.bits import from_ordered_bits, ordered_bits
from ..session import materialize, scratch_scope

#: Bits counted by each pass.
DIGITS = (20, 12, 12, 12, 8)
#: Bits below the digits of each pass.
SHIFTS = tuple(64 - sum(DIGITS[:i + 1]) for i in range(len(DIGITS)))


def first_cell(image: Column) -> Column:
    """The first digit of an image: its cell in the first pass."""
    return F.shiftright(image, SHIFTS[0])


def _same(left: DataFrame, right: DataFrame, cols: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right["_r_" + c]) for c in cols])


def _renamed(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(c).alias("_r_" + c if c in cols else c) for c in df.columns])


def _join(left: DataFrame, right: DataFrame, cols: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi join on ``cols``, in which nulls are equal."""
    r = _renamed(right, cols)
    return left.join(r, _same(left, r, cols), how).drop(*["_r_" + c for c in cols])


def count_first(src: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, _cell, _c, _lo, _hi) of (keys, _i): the first pass."""
    return src.groupBy(*keys, first_cell(F.col("_i")).alias("_cell")).agg(F.count(F.lit(1)).alias("_c"), F.min("_i").alias("_lo"), F.max("_i").alias("_hi"))


def quantiles_of_cells(src: DataFrame, cells: DataFrame, probs: Sequence[float], keys: Sequence[str], names: Sequence[str],
                       also: DataFrame | None = None, keep: bool = False, weight: str | None = None) -> tuple[DataFrame, DataFrame | None]:
    """(``keys..., <name per prob>``, rows written) from the first pass's ``cells`` of ``src`` (keys, _i).

    ``also`` (keys, _cell) names further cells whose rows the caller wants
    written with those that hold the ranks; the rows come back as (keys, _i, _cell).
    ``weight``: a column of ``src`` with the number of equal rows that each row stands for.
    """
    weights, number = ([weight], F.sum(weight)) if weight else ([], F.count(F.lit(1)))
    keys = list(keys)
    upto = Window.partitionBy(*keys).orderBy("_cell").rowsBetween(Window.unboundedPreceding, 0)
    placed = cells.withColumns({"_start": F.sum("_c").over(upto) - F.col("_c"), "_n": F.sum("_c").over(Window.partitionBy(*keys))})
    pos = [F.lit(float(p)) * (F.col("_n") - 1) for p in probs]
    ranks = F.array_distinct(F.flatten(F.array(*[F.array(F.floor(h), F.ceil(h)) for h in pos])))
    inside = F.filter(ranks, lambda r: (r >= F.col("_start")) & (r < F.col("_start") + F.col("_c")))
    targets = materialize(placed.select(*keys, "_n", F.col("_cell").alias("_prefix"), F.col("_start").alias("_below"), "_lo", "_hi",
                                        F.explode(inside).alias("_rank")), "quantile-targets")
    rows, level, open_ = None, 0, F.col("_lo") < F.col("_hi")
    wanted = targets.where(open_).select(*keys, F.col("_prefix").alias("_cell")).distinct()
    if also is not None:
        wanted = wanted.unionByName(also.select(*keys, "_cell")).distinct()
    if also is not None or not targets.where(open_).isEmpty():
        rows = materialize(_join(src.select(*keys, "_i", *weights, first_cell(F.col("_i")).alias("_cell")), wanted, [*keys, "_cell"], "left_semi"), "quantile-rows")
    while not targets.where(open_).isEmpty():
        probes = targets.where(open_).select(*keys, "_prefix", "_below").distinct()
        seen = rows.select(*keys, "_i", *weights, F.shiftright("_i", SHIFTS[level]).alias("_prefix"))
        level += 1
        digit = F.shiftright("_i", SHIFTS[level]).alias("_cell")
        counted = _join(seen, probes, [*keys, "_prefix"]).groupBy(*keys, "_prefix", "_below", digit).agg(
            number.alias("_c"), F.min("_i").alias("_nlo"), F.max("_i").alias("_nhi"))
        upto = Window.partitionBy(*keys, "_prefix").orderBy("_cell").rowsBetween(Window.unboundedPreceding, 0)
        counted = counted.withColumn("_start", F.col("_below") + F.sum("_c").over(upto) - F.col("_c")).drop("_below")
        hit = _join(targets.where(open_).select(*keys, "_n", "_prefix", "_rank"), counted, [*keys, "_prefix"])
        hit = hit.where((F.col("_start") <= F.col("_rank")) & (F.col("_rank") < F.col("_start") + F.col("_c")))
        narrowed = hit.select(*keys, "_n", F.col("_cell").alias("_prefix"), F.col("_start").alias("_below"), F.col("_nlo").alias("_lo"),
                              F.col("_nhi").alias("_hi"), "_rank")
        targets = materialize(targets.where(~open_).unionByName(narrowed), "quantile-targets")
    values = F.map_from_entries(F.collect_list(F.struct("_rank", from_ordered_bits(F.col("_lo")))))
    out = targets.groupBy(*keys, "_n").agg(values.alias("_m"))
    cols = []
    for p, name in zip(probs, names, strict=True):
        h = F.lit(float(p)) * (F.col("_n") - 1)
        lo, hi = F.floor(h), F.ceil(h)
        vlo, vhi = F.element_at("_m", lo.cast("long")), F.element_at("_m", hi.cast("long"))
        cols.append(F.when(vlo.eqNullSafe(vhi), vlo).otherwise((hi - h) * vlo + (h - lo) * vhi).alias(name))
    return materialize(out.select(*keys, *cols), "quantiles", keep=keep), rows


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float], keys: Sequence[str] = (),
                    names: Sequence[str] | None = None, write_input: bool = True) -> DataFrame:
    """``keys..., <name per prob>``: exact quantiles of ``col`` per group (nulls ignored).

    Interpolation matches Spark's ``percentile``: position ``h = p(n-1)``,
    ``(ceil(h) - h) * v[floor(h)] + (h - floor(h)) * v[ceil(h)]``.
    ``write_input=False`` when ``df`` is cheap to read twice (a written table or
    a cached frame); else its column is written first.
    """
    names = list(names) if names else [f"q{p}" for p in probs]
    gkeys = list(keys) or ["_g"]
    x = F.col(col).cast("double")
    base = df if keys else df.withColumn("_g", F.lit(0))
    src = base.where(x.isNotNull()).select(*gkeys, ordered_bits(x).alias("_i"))
    with scratch_scope(df.sparkSession):
        if write_input:
            src = materialize(src, "quantile-input")
        cells = materialize(count_first(src, gkeys), "quantile-cells")
        result, _ = quantiles_of_cells(src, cells, probs, gkeys, names, keep=True)
    return result if keys else result.drop("_g")
