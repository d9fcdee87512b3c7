"""Connected components of a link table, by alternating large and small stars.

Each vertex is linked to the smallest of its neighbours, first for its larger
neighbours, then for its smaller ones, until nothing changes; then every vertex
is linked to the smallest of its component. A step is one aggregate (combined
before its shuffle) and one join, so no vertex's neighbours are ever held
together, and links, labels and groups stay in Spark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

LINKS_A_FILE = 500_000  # 8 MB


def _star(links: DataFrame, larger: bool) -> DataFrame:
    """Links (u > v). Large star: every larger neighbour of u goes to the
    smallest of u's neighbours and u. Small star: u and its smaller ones do."""
    if larger:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        out = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = links.groupBy("u").agg(F.min("v").alias("m"))
        moved = links.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        out = moved.unionByName(least.withColumnRenamed("m", "v"))
    return out.where("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b) that is not the
    smallest of its component; component is that smallest node."""
    links = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "links")
    mark = lambda d: tuple(d.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())
    now = mark(links)
    while now[0]:
        # a step never has more links than before: files by their number, not by that of shuffle partitions
        files = max(links.sparkSession.sparkContext.defaultParallelism, now[0] // LINKS_A_FILE + 1)
        for name, larger in (("large-star", True), ("small-star", False)):
            links = stored(_star(links, larger).coalesce(files), name)
        before, now = now, mark(links)
        if now == before:
            break
    return links.select(F.col("u").alias("node"), F.col("v").alias("component"))
