"""k-nearest-neighbour imputation on one numeric feature.

A missing ``target`` takes the mean target of the k rows nearest in
``feature`` among rows having both (ties: lowest key; fewer than k donors:
the mean of those there). A row missing both, or with no donor at all,
takes the mean of every present target (duplicates included).

Exact and shuffle-based, with no pair list and no single global sort:

1. donors are reduced to one row per distinct feature value holding its k
   lowest-key donors (a rank filter, limited per group before the shuffle);
2. distinct values are dealt into ranges by Spark's range partitioning, one for
   every ``values_per_bucket`` of them however many there are, and written once
   with the number of their range (the driver reads back their count alone);
3. inside a range, a window over values supplies the k nearest donor
   values on each side (``lag``/``lead ... IGNORE NULLS``); across its borders
   the k first and k last donor values of every range are carried on: a window over one
   row per range gives each the borders of the k nearest ranges with donors on
   either side, a table that is written, so Spark joins it by its known size;
4. the k nearest of those candidates give the value's imputation, joined
   back to the rows by value (an equi join).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

def knn_impute(df: DataFrame, target: str, feature: str, key: str, k: int = 3,
               buckets: int | None = None, out: str | None = None, values_per_bucket: int = 20_000) -> DataFrame:
    """``df`` with ``target`` (or ``out``) imputed from the k nearest donors by ``feature``."""
    out = out or target
    t, f = F.col(target).cast("double"), F.col(feature).cast("double")
    entry_type = f"struct<feature:double,key:{dict(df.dtypes)[key]},target:double>"
    col_mean = df.agg(F.avg(t).alias("m")).first()["m"]

    donors = df.where(t.isNotNull() & f.isNotNull()).select(f.alias("v"), F.col(key).alias("key"), t.alias("target"))
    # the k lowest-key donors per value: a rank filter Spark runs as a WindowGroupLimit before the
    # shuffle too, so a value shared by a third of the rows never reaches one task whole
    ranked = donors.withColumn("_rk", F.row_number().over(Window.partitionBy("v").orderBy("key", "target")))
    per_value = (ranked.where(F.col("_rk") <= k)
                       .groupBy("v").agg(F.array_sort(F.collect_list(F.struct("key", "target"))).alias("ds")))
    wanted = df.where(t.isNull() & f.isNotNull()).select(f.alias("v")).distinct()
    values = (per_value.join(wanted.withColumn("recipient", F.lit(True)), "v", "full_outer")
                       .withColumn("recipient", F.coalesce("recipient", F.lit(False))))

    values = materialize(values, "knn-values")
    if buckets is None:  # one window task for every so many distinct values
        buckets = 1 + values.count() // values_per_bucket
    values = materialize(values.repartitionByRange(buckets, "v").withColumn("bucket", F.spark_partition_id()), "knn-ranges")

    # every donor value as a list of (value, key, target) donor entries
    entries = F.transform("ds", lambda d: F.struct(F.col("v").alias("feature"), d["key"].alias("key"),
                                                   d["target"].alias("target")))
    values = values.withColumn("es", F.when(F.col("ds").isNotNull(), entries))

    # edges: the k first and k last donor values of each bucket, then for each bucket the
    # nearest k donor values before it and after it (a window over one row per bucket)
    dv = values.where(F.col("es").isNotNull())
    w_up = Window.partitionBy("bucket").orderBy("v")
    w_dn = Window.partitionBy("bucket").orderBy(F.col("v").desc())
    edges = (dv.withColumn("r_up", F.row_number().over(w_up)).withColumn("r_dn", F.row_number().over(w_dn))
               .where((F.col("r_up") <= k) | (F.col("r_dn") <= k))
               .groupBy("bucket")
               .agg(F.flatten(F.collect_list(F.when(F.col("r_up") <= k, F.col("es")))).alias("first_es"),
                    F.flatten(F.collect_list(F.when(F.col("r_dn") <= k, F.col("es")))).alias("last_es")))
    all_b = values.select("bucket").distinct().join(edges, "bucket", "left")
    # of the buckets before and after, only the k nearest that hold donors matter: each has one value at least
    wb = "ORDER BY bucket"  # one row per bucket
    near = lambda fn, c: F.flatten(F.filter(F.array(*[F.expr(f"{fn}({c}, {i}) IGNORE NULLS OVER ({wb})") for i in range(1, k + 1)]),
                                            lambda x: x.isNotNull()))
    near_edges = materialize(all_b.select("bucket", near("lag", "last_es").alias("below_es"), near("lead", "first_es").alias("above_es")), "knn-borders")

    # within a bucket: the k nearest donor values below and above each value
    wv = "PARTITION BY bucket ORDER BY v"
    lags = [F.expr(f"lag(es, {i}) IGNORE NULLS OVER ({wv})") for i in range(1, k + 1)]
    leads = [F.expr(f"lead(es, {i}) IGNORE NULLS OVER ({wv})") for i in range(1, k + 1)]
    local = values.select("v", "bucket", "recipient", "es", F.array(*lags).alias("lag_es"), F.array(*leads).alias("lead_es"))
    rec = local.where("recipient").join(near_edges, "bucket", "left")

    def nonnull(c):
        return F.coalesce(c, F.array().cast(f"array<{entry_type}>"))

    cands = F.concat(nonnull(F.col("es")), nonnull(F.flatten(F.filter("lag_es", lambda a: a.isNotNull()))),
                     nonnull(F.flatten(F.filter("lead_es", lambda a: a.isNotNull()))),
                     nonnull(F.col("below_es")), nonnull(F.col("above_es")))
    ranked = F.transform(cands, lambda e: F.struct(F.abs(e["feature"] - F.col("v")).alias("dist"),
                                                   e["key"].alias("key"), e["target"].alias("target")))
    nearest = F.slice(F.array_sort(F.array_distinct(ranked)), 1, k)
    mean_t = F.aggregate(nearest, F.lit(0.0), lambda a, e: a + e["target"]) / F.size(nearest)
    imputed = rec.select(F.col("v").alias("_knn_v"), F.when(F.size(nearest) > 0, mean_t).alias("_imp"))

    fill = F.coalesce(F.col("_imp"), F.lit(col_mean).cast("double"))
    joined = df.join(imputed, f == imputed["_knn_v"], "left")
    return joined.withColumn(out, F.when(t.isNull(), fill).otherwise(t)).drop("_knn_v", "_imp")

