"""DataFrame-level scalar transforms: projections, filters,
date parts, category assignment and code resolution.

All are narrow transformations except where a small side table is joined
(``assign_random_category``, ``default_by_category``, ``resolve_code``);
those joins are equi joins that Spark may broadcast after its own size check.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..fixed import DEFAULT_LAB_PRICES
from ..session import materialize
from .columns import DEFAULT_CODE, WHITESPACE_RUN, code_tokens, hash_number, hashed_id


def project_rename(df: DataFrame, mapping: Mapping[str, str | Column]) -> DataFrame:
    """``select`` with aliases: ``{new_name: old_name_or_column}``."""
    return df.select([(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in mapping.items()])


def suffix_columns(df: DataFrame, suffix: str) -> DataFrame:
    """Append ``suffix`` to every column (role-playing dimensions)."""
    return df.withColumnsRenamed({c: c + suffix for c in df.columns})


def drop_columns(df: DataFrame, *cols: str | Column) -> DataFrame:
    out = df
    for c in cols:
        out = out.drop(c)
    return out


def filter_not_null(df: DataFrame, cols: Sequence[str], blank: bool = False) -> DataFrame:
    """Keep rows whose ``cols`` are all non-null (and non-empty text when ``blank``)."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
        if blank:
            cond = cond & (F.col(c).cast("string") != F.lit(""))
    return df.filter(cond)


def filter_equals(df: DataFrame, col: str, value) -> DataFrame:
    return df.filter(F.col(col) == F.lit(value))


def const_columns(df: DataFrame, spec: Mapping[str, tuple[object, str]]) -> DataFrame:
    """Add literal columns: ``{name: (value, type)}``; ``value`` may be None (typed null)."""
    return df.withColumns({k: F.lit(v).cast(t) for k, (v, t) in spec.items()})


def to_day(df: DataFrame, col: str) -> Column:
    """A date from a date, timestamp or text column; malformed text gives null."""
    return F.try_to_date(F.col(col)) if dict(df.dtypes)[col] == "string" else F.col(col).cast("date")


def date_parts(df: DataFrame, col: str, out_date: str = "calendar_date") -> DataFrame:
    """Calendar attributes of a timestamp/date/text column.

    ``date_id`` ``yyyyMMdd``, ``year`` and ``month`` as text, ``quarter`` as
    int, ``day_of_week`` as the English weekday name.
    """
    d = F.col(out_date)
    return (df.withColumn(out_date, to_day(df, col))
              .withColumns({
                  "date_id": F.date_format(d, "yyyyMMdd"),
                  "year": F.date_format(d, "yyyy"),
                  "quarter": F.quarter(d),
                  "month": F.date_format(d, "MM"),
                  "day_of_week": F.date_format(d, "EEEE"),
              }))


def assign_random_category(df: DataFrame, key: Sequence[str], choices: DataFrame, choice_col: str,
                           out: str, seed: int = 42) -> DataFrame:
    """Give every row a repeatable pseudo-random member of ``choices[choice_col]``.

    Distinct choices are numbered in sorted order; each row picks the number
    ``hash(key, seed) mod n`` (``hash_number``). The pick is an equi join on
    that number, so no array of choices is ever built on the driver; only the
    scalar ``n`` is read back. Any number of choices works; a small list is
    broadcast by Spark's byte threshold.
    """
    opts = choices.select(F.col(choice_col).alias(out)).where(F.col(out).isNotNull()).distinct()
    n = opts.count()
    if n == 0:
        return df.withColumn(out, F.lit(None).cast("string"))
    numbered = number_choices(opts, out)
    return df.withColumn("_ord", hash_number(*key, seed=seed) % F.lit(n)).join(numbered, "_ord", "left").drop("_ord")


def number_choices(opts: DataFrame, col: str) -> DataFrame:
    """Distinct values numbered from 0 in order, as a table of known size."""
    return materialize(opts.withColumn("_ord", F.row_number().over(Window.orderBy(col)).cast("long") - 1), "choices")


def defaults_frame(spark: SparkSession, defaults=DEFAULT_LAB_PRICES,
                   key: str = "_default_category", value: str = "_default_price") -> DataFrame:
    return spark.createDataFrame([(k, float(v)) for k, v in defaults], f"{key} string, {value} double")


def default_by_category(df: DataFrame, price: str, category: str, defaults: DataFrame | None = None,
                        defaults_key: str = "_default_category", defaults_value: str = "_default_price") -> DataFrame:
    """Price null or 0 -> the default of its (lower-cased) category; unknown category -> unchanged."""
    if defaults is None:
        defaults = defaults_frame(df.sparkSession)
    d = F.broadcast(defaults)  # a handful of literal rows
    joined = df.join(d, F.lower(df[category]) == d[defaults_key], "left")
    p = F.col(price)
    fixed = F.when(p.isNull() | (p == F.lit(0)), F.coalesce(F.col(defaults_value), p)).otherwise(p)
    return joined.withColumn(price, fixed).drop(defaults_key, defaults_value)


def tokenize_explode(df: DataFrame, col: str, out: str) -> DataFrame:
    """One row per whitespace/comma separated token of ``col``; blank tokens dropped."""
    return (df.withColumn(out, F.explode(code_tokens(col)))
              .withColumn(out, F.trim(F.col(out)))
              .filter(F.col(out) != F.lit("")))


def resolve_code(df: DataFrame, name: str, codes: str, modal: DataFrame, modal_name: str,
                 modal_code: str, out: str, default: str = DEFAULT_CODE) -> DataFrame:
    """One code per row from a free-text code list.

    One token -> that token; several (or none) -> the name's modal code,
    else the first token; null, whitespace-only or unmapped-empty -> ``default``.
    ``modal`` is one row per name (see ``operators.windows.modal_value``).
    """
    m = modal.select(F.col(modal_name).alias("_m_name"), F.col(modal_code).alias("_m_code"))
    toks = code_tokens(codes)
    joined = df.join(m, df[name].eqNullSafe(m["_m_name"]), "left")
    blank = F.col(codes).isNull() | (F.regexp_replace(F.col(codes), WHITESPACE_RUN, "") == F.lit(""))
    resolved = (F.when(blank, F.lit(default))
                 .when(F.size(toks) == F.lit(1), F.get(toks, 0))
                 .otherwise(F.coalesce(F.col("_m_code"), F.get(toks, 0), F.lit(default))))
    return joined.withColumn(out, resolved).drop("_m_name", "_m_code")


def surrogate_id(df: DataFrame, keys: Sequence[str] | None = None, out: str = "event_id") -> DataFrame:
    """Unique row id as text.

    With ``keys`` the id is a SHA-256 of the key texts: repeatable under task
    retries, so it is the default for anything joined later. Without keys it
    is ``monotonically_increasing_id`` (unique, not repeatable across runs).
    """
    if keys:
        return df.withColumn(out, hashed_id(*keys))
    return df.withColumn(out, F.monotonically_increasing_id().cast("string"))


def numbered_id(df: DataFrame, order: Sequence[str], out: str = "row_id", partitions: int | None = None) -> DataFrame:
    """Gapless numbers 1..n in the order of ``order`` (nulls first), then of the other columns, so the
    same rows get the same numbers under any partitioning; rows equal in all columns take theirs in any order.

    Rows are dealt into ranges and sorted within them, written once with their place
    (``monotonically_increasing_id``: range and position), and shifted by the sizes of the ranges
    before theirs, one count per range: no window over the rows, and no range of equal keys, as a row's
    number in the input is the last key.
    """
    names = df.columns
    others = [f.name for f in df.schema.fields if f.name not in order and not _unordered(f.dataType.simpleString())]
    keys = [F.col(c).asc_nulls_first() for c in [*order, *others, "_tie"]]
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = materialize(df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(n, *keys).sortWithinPartitions(*keys)
                           .drop("_tie").withColumn("_at", F.monotonically_increasing_id()), "numbered-rows")
    placed = placed.withColumns({"_range": F.shiftright("_at", 33), "_place": F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))})
    sizes = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))  # one row per range
    starts = materialize(sizes.select("_range", F.coalesce(before, F.lit(0)).alias("_start")), "numbered-starts")
    return placed.join(starts, "_range").select(*names, (F.col("_start") + F.col("_place") + 1).alias(out))


def _unordered(type_name: str) -> bool:
    return "map<" in type_name or "variant" in type_name
