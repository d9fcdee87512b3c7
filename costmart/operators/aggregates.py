"""Aggregations: all have a partial (map-side) step before the
shuffle, so a hot key costs one partial row per map task instead of a third
of the table in one reducer. Sums, counts and extremes are hash aggregates;
``first_per_key`` orders structs, which Spark plans as a sort aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Money accumulates in a decimal: exact, so sums do not depend on partitioning; 10 decimals keep
# imputed and redrawn costs (not rounded to cents) equal to their double values.
MONEY = "decimal(28,10)"


def money_sum(c: str | Column) -> Column:
    """Sum money in ``MONEY`` decimal (result independent of partitioning), returned as double."""
    col = F.col(c) if isinstance(c, str) else c
    return F.sum(col.cast(MONEY)).cast("double")


def distinct_project(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    return (df.select(*cols) if cols else df).distinct()


def sum_by_key(df: DataFrame, keys: Sequence[str], col: str, out: str, money: bool = True) -> DataFrame:
    """Per-key sum; null inputs ignored; an all-null group gives null (0-fill later)."""
    agg = money_sum(col) if money else F.sum(col)
    return df.groupBy(*keys).agg(agg.alias(out))


def group_stats(df: DataFrame, keys: Sequence[str], col: str,
                stats: Sequence[str] = ("mean", "median", "count"),
                drop_null_keys: bool = True, rows_as: str = "rows") -> DataFrame:
    """mean / median / count (non-null values) / rows (``size``) / sum / min / max / std per group.

    ``drop_null_keys`` reproduces pandas, which drops null group keys.
    The median is exact (``exact_quantiles``, linear interpolation).
    """
    src = df
    if drop_null_keys:
        for k in keys:
            src = src.where(F.col(k).isNotNull())
    c = F.col(col)
    exprs = {
        "mean": F.avg(c), "count": F.count(c), rows_as: F.count(F.lit(1)),
        "sum": F.sum(c), "min": F.min(c), "max": F.max(c), "std": F.stddev_samp(c),
    }
    simple = [s for s in stats if s != "median"]
    out = src.groupBy(*keys).agg(*[exprs[s].alias(s if s != "rows" else rows_as) for s in simple]) if simple else \
        src.select(*keys).distinct()
    if "median" in stats:
        from .quantiles import exact_quantiles
        med = exact_quantiles(src, col, [0.5], keys, names=["median"], write_input=not df.is_cached)
        med = med.select(*[F.col(k).alias("_m_" + k) for k in keys], "median")
        cond = F.lit(True)
        for k in keys:
            cond = cond & out[k].eqNullSafe(med["_m_" + k])
        out = out.join(med, cond, "left").drop(*["_m_" + k for k in keys])
    order = [s if s != "rows" else rows_as for s in stats]
    return out.select(*keys, *order)


def group_mean_all_labels(df: DataFrame, label: str, col: str, labels: Sequence[str],
                          out: str = "mean") -> DataFrame:
    """Mean per label, every label listed (empty ones null), in label order (``observed=False``)."""
    spark = df.sparkSession
    lab = spark.createDataFrame([(l, i) for i, l in enumerate(labels)], f"{label} string, label_order int")
    means = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.avg(col).alias(out))
    return F.broadcast(lab).join(means, label, "left").select(label, "label_order", out)


def _stat_rows(stats: DataFrame, cols: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Unpivot a one-row frame with columns ``{name}__{col}`` to (statistic, col1, col2, ...)."""
    n = len(names)
    parts = ", ".join(
        f"'{s}', " + ", ".join(f"`{s}__{c}`" for c in cols) for s in names
    )
    return stats.selectExpr(f"stack({n}, {parts}) as (statistic, {', '.join(cols)})")


def moments(c: str) -> list[Column]:
    """count, mean, std (sample), min and max of a column, named ``<statistic>__<column>``."""
    x = F.col(c).cast("double")
    return [F.count(x).cast("double").alias(f"count__{c}"), F.avg(x).alias(f"mean__{c}"),
            F.stddev_samp(x).alias(f"std__{c}"), F.min(x).alias(f"min__{c}"), F.max(x).alias(f"max__{c}")]


def describe_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """count, mean, std (sample), min, 25/50/75 % (exact, linear), max, one row each.

    The quartiles come from ``exact_quantiles`` over all columns at once
    (column name as the group); their 3 x len(cols) values are read back as
    scalars and placed beside the one-row aggregate.
    """
    from ..session import scratch_scope
    from .quantiles import exact_quantiles

    one = df.agg(*[a for c in cols for a in moments(c)])
    stacked = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("_col"), F.col(c).cast("double").alias("_x"))
                                            for c in cols])).alias("_s")).select("_s.*")
    with scratch_scope(df.sparkSession):
        qs = {r["_col"]: r for r in exact_quantiles(stacked, "_x", [0.25, 0.5, 0.75], ["_col"],
                                                    names=["q25", "q50", "q75"], write_input=not df.is_cached).collect()}
    for c in cols:
        r = qs.get(c)
        one = one.withColumns({f"{lab}__{c}": F.lit(r[q] if r else None).cast("double")
                               for lab, q in (("25%", "q25"), ("50%", "q50"), ("75%", "q75"))})
    names = ["count", "mean", "std", "min", "25%", "50%", "75%", "max"]
    out = _stat_rows(one, cols, names)
    order = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("statistic")).cast("int")
    return out.withColumn("stat_order", order)


def bin_of(x: Column, lo: float, hi: float, bins: int) -> Column:
    return F.least(F.width_bucket(x, F.lit(lo), F.lit(hi), F.lit(bins)), F.lit(bins)).cast("int")


def bin_edges(lo: float | None, hi: float | None) -> tuple[float | None, float | None]:
    """The range that the bins divide: pandas widens a zero range by 0.1 % each side."""
    if lo is None or lo != hi:
        return lo, hi
    return (lo - 0.001 * abs(lo), hi + 0.001 * abs(hi)) if lo else (-0.001, 0.001)


def fold_cells(cells: DataFrame, lo: float, hi: float, bins: int) -> DataFrame:
    """Histogram cells (_c, _min, _max, ...) with the bin of both ends: those with
    ``_bin = _last`` lie in one bin, the others are border cells."""
    return cells.withColumns({"_bin": bin_of(F.col("_min"), lo, hi, bins), "_last": bin_of(F.col("_max"), lo, hi, bins)})


def list_bins(counts: DataFrame, lo: float | None, hi: float | None, bins: int, others: DataFrame | None = None) -> DataFrame:
    """(bin, bin_lo, bin_hi, n): all ``bins`` with their edges, empty ones with 0; ``counts`` (bin, n)
    may have several rows a bin. ``others`` (value, n), non-finite values, follow as bins of their own
    if there are any: 0 for -infinity, ``bins + 1`` for infinity, ``bins + 2`` for NaN."""
    spark = counts.sparkSession
    all_bins = spark.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    width = None if lo is None else (hi - lo) / bins
    edge = lambda k: F.lit(lo).cast("double") + k * F.lit(width).cast("double")
    summed = counts.groupBy("bin").agg(F.sum("n").alias("n"))
    out = (all_bins.join(summed, "bin", "left")
                   .select("bin", edge(F.col("bin") - 1).alias("bin_lo"), edge(F.col("bin")).alias("bin_hi"),
                           F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n")))
    if others is None:
        return out
    own = F.when(F.isnan("value"), bins + 2).when(F.col("value") > 0, bins + 1).otherwise(0).cast("int")
    return out.unionByName(others.select(own.alias("bin"), F.col("value").alias("bin_lo"), F.col("value").alias("bin_hi"), F.col("n").cast("long").alias("n")))


def histogram_equal_width(df: DataFrame, col: str, bins: int = 30) -> DataFrame:
    """``bins`` equal-width bins from the least to the greatest finite value (last bin closed), empty bins
    listed with 0; infinities and NaN have bins of their own (``list_bins``).

    One scan counts rows by cells of leading bits (``functions.bits``: no bounds needed), with each
    cell's smallest and largest value, partially aggregated; so the bounds and nearly all counts come from that
    small table. A cell that a bin's edge cuts is counted exactly from its rows alone: at most
    ``bins - 1`` cells, read back as ranges that reach the scan as filters.
    """
    from ..functions.bits import ordered_bits
    from ..session import materialize
    from .quantiles import first_cell

    x = F.col(col).cast("double")
    finite = ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    cell = F.when(finite, first_cell(ordered_bits(x)))
    cells = materialize(df.where(x.isNotNull()).groupBy(cell.alias("_cell"), F.when(~finite, x).alias("_own"))
                          .agg(F.count(F.lit(1)).alias("_c"), F.min(x).alias("_min"), F.max(x).alias("_max")), "histogram-cells")
    inner = cells.where(F.col("_own").isNull())
    others = cells.where(F.col("_own").isNotNull()).select(F.col("_own").alias("value"), F.col("_c").alias("n"))
    lo, hi = bin_edges(*inner.agg(F.min("_min"), F.max("_max")).first())
    if lo is None:
        return list_bins(inner.select(F.lit(1).alias("bin"), F.col("_c").alias("n")), None, None, bins, others)
    folded = fold_cells(inner, lo, hi, bins)
    counts = folded.where(F.col("_bin") == F.col("_last")).select(F.col("_bin").alias("bin"), F.col("_c").alias("n"))
    cut = folded.where(F.col("_bin") < F.col("_last")).select("_min", "_max").collect()  # fewer than bins
    if cut:
        ranges = F.lit(False)
        for r in cut:
            ranges = ranges | ((x >= F.lit(r["_min"])) & (x <= F.lit(r["_max"])))
        border = df.where(ranges).groupBy(bin_of(x, lo, hi, bins).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
        counts = counts.unionByName(border)
    return list_bins(counts, lo, hi, bins, others)


def corr_complete(a: str, b: str) -> Column:
    """Pearson correlation over the rows that have both."""
    xa, xb = F.col(a).cast("double"), F.col(b).cast("double")
    both = xa.isNotNull() & xb.isNotNull()
    return F.corr(F.when(both, xa), F.when(both, xb))


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation for every ordered pair, pairwise complete, in one aggregate.

    Long form ``(row_col, col_col, corr)``.
    """
    aggs = [corr_complete(a, b).alias(f"{a}__{b}") for a in cols for b in cols]
    one = df.agg(*aggs)
    pairs = ", ".join(f"'{a}', '{b}', `{a}__{b}`" for a in cols for b in cols)
    return one.selectExpr(f"stack({len(cols) ** 2}, {pairs}) as (row_col, col_col, corr)")


def share_of_total(df: DataFrame, cols: Sequence[str], by: Sequence[str] | None = None,
                   money: bool = False) -> DataFrame:
    """Sums of ``cols`` and each one's percentage of their combined sum (per group if ``by``).

    ``money`` sums in the ``MONEY`` decimal (exact, independent of partitioning).
    """
    sums = [(money_sum(c) if money else F.sum(F.col(c).cast("double"))).alias(f"{c}_sum") for c in cols]
    out = df.groupBy(*by).agg(*sums) if by else df.agg(*sums)
    total = sum((F.coalesce(F.col(f"{c}_sum"), F.lit(0.0)) for c in cols[1:]),
                F.coalesce(F.col(f"{cols[0]}_sum"), F.lit(0.0)))
    return out.withColumns({f"{c}_pct": F.try_divide(F.col(f"{c}_sum") * F.lit(100.0), total) for c in cols})


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row per key by ``order`` (pandas ``drop_duplicates(keep='first')``).

    ``min_by`` over a struct is partially aggregated: a hot key is reduced
    map-side before the shuffle. ``order`` should be unique within a key.
    """
    payload = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*payload), F.struct(*order)).alias("_r"))
    return picked.select(*keys, *[F.col("_r." + c).alias(c) for c in payload])


def sort_desc(df: DataFrame, cols: Sequence[str], tie: Sequence[str] = ()) -> DataFrame:
    """Order by ``cols`` descending (nulls last), ``tie`` ascending."""
    return df.orderBy(*[F.col(c).desc_nulls_last() for c in cols], *[F.col(c).asc_nulls_last() for c in tie])


def limit_n(df: DataFrame, n: int, order: Sequence[Column | str]) -> DataFrame:
    """First ``n`` rows in an explicit order (a top-n sort, never an arbitrary n)."""
    return df.orderBy(*order).limit(n)
