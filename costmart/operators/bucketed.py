"""A star schema written for joins without shuffles: fact and dimensions as
catalogued tables in buckets of the fact's key, each bucket sorted by it.

One key per fact row decides where everything lies. A dimension on that key is
bucketed by its own; a dimension on another key is first carried to the fact's
key, through the fact's pairs of both keys alone, so one row stands per fact key
and dimension row. The exchanges are paid once, when the tables are written: any
number of star joins after that read bucket against bucket. A fact key
that repeats with several values of a dimension's key is joined by both. The key should not be
null: a fact row without it is kept, but matches no dimension, on other keys neither.

At 100 TB: as many buckets as make one a few hundred MB of fact; the carried
dimensions hold their attributes once per fact row that refers to them, which is the price.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEY, OTHER = "_star_key", "_star_other"


def _write(df: DataFrame, key: str, name: str, path: str, buckets: int) -> None:
    # dealt by key first: one file per bucket, not one per bucket and task
    df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("path", path).mode("overwrite").saveAsTable(name)


def write_star(fact: DataFrame, dims: Sequence[tuple[str, DataFrame, str, str]], key: str, out: str, buckets: int,
               prefix: str | None = None) -> dict[str, str]:
    """Write ``fact`` and ``dims`` (name, dimension, fact key, dimension key) under ``out``; returns the
    catalogued table of each name (the fact's is "fact"). ``dims`` must not share attribute names."""
    prefix = prefix or f"star_{uuid.uuid4().hex[:12]}"
    tables = {name: f"{prefix}_{name}" for name in ["fact", *(d[0] for d in dims)]}
    path = lambda name: f"{out.rstrip('/')}/{tables[name]}"
    _write(fact, key, tables["fact"], path("fact"), buckets)
    written = fact.sparkSession.table(tables["fact"])
    for name, dim, fact_key, dim_key in dims:
        attributes = [c for c in dim.columns if c != dim_key]
        if fact_key == key:
            placed = dim.select(F.col(dim_key).alias(KEY), *attributes).where(F.col(KEY).isNotNull())
        else:
            pairs = written.select(F.col(key).alias(KEY), F.col(fact_key).alias(OTHER)).where(F.col(KEY).isNotNull()).distinct()
            placed = pairs.join(dim, pairs[OTHER] == dim[dim_key]).select(KEY, OTHER, *attributes)
        _write(placed, KEY, tables[name], path(name), buckets)
    return tables


def join_star_bucketed(spark: SparkSession, tables: Mapping[str, str], dims: Sequence[tuple[str, str]], key: str) -> DataFrame:
    """The star join of ``write_star``'s tables: the fact left-joined to ``dims`` (name, fact key), dimension
    fan-out kept, without an exchange of any of them."""
    out = spark.table(tables["fact"])
    for name, fact_key in dims:
        dim = spark.table(tables[name])
        on = out[key] == dim[KEY]
        if fact_key != key:
            # not an equality of join keys to the planner: the buckets know the one key only
            on = on & F.coalesce(out[fact_key] == dim[OTHER], F.lit(False))
        out = out.join(dim, on, "left").drop(KEY, OTHER)
    return out


def drop_star(spark: SparkSession, tables: Mapping[str, str]) -> None:
    """Take the tables out of the catalogue (their files stay where they were written)."""
    for table in tables.values():
        spark.sql(f"drop table if exists {table}")
