"""Readers and writers.

CSV is read with an explicit schema (never ``inferSchema``, which scans the
data twice); Parquet by path, with column pruning and filter pushdown left
to Catalyst.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def string_schema(columns: Sequence[str]) -> StructType:
    return StructType([StructField(c, StringType(), True) for c in columns])


def scan_csv_strings(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Headered CSV, every column text; quoted fields may hold commas.

    Each file's header is held against ``columns``: a folder whose files order
    their columns differently fails instead of being read under wrong names.
    """
    return (spark.read.schema(string_schema(columns))
                 .option("header", True).option("enforceSchema", False).option("quote", '"').option("escape", '"')
                 .option("mode", "PERMISSIVE").csv(path))


def scan_csv_typed(spark: SparkSession, path: str, columns: Sequence[str],
                   casts: Mapping[str, str] | None = None,
                   dates: Sequence[str] = (), timestamps: Sequence[str] = ()) -> DataFrame:
    """Headered CSV read as text, then cast column by column with ``try_*``.

    Ids stay text unless listed in ``casts``; ``dates`` / ``timestamps`` are
    parsed; a malformed value becomes null instead of failing the job.
    """
    df = scan_csv_strings(spark, path, columns)
    conv: dict[str, Column] = {}
    for c, t in (casts or {}).items():
        conv[c] = F.col(c).try_cast(t)
    for c in dates:
        conv[c] = F.try_to_date(F.col(c))
    for c in timestamps:
        conv[c] = F.try_to_timestamp(F.col(c))
    return df.withColumns(conv) if conv else df


def scan_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def sink_parquet_overwrite(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace the table at ``path``; optional directory partitioning for later pruning."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def sink_csv(df: DataFrame, path: str) -> None:
    """Headered CSV without an index, one part file per task.

    Parts are written in parallel; a reader given the folder sees one table.
    (One single file would route the whole table through one task.)
    """
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def sink_table_truncate_load(df: DataFrame, url: str, table: str, columns: Sequence[str],
                             properties: Mapping[str, str] | None = None) -> None:
    """Truncate ``table`` and load ``df`` into it, keeping the table's DDL.

    Columns are selected **by name** in the target's order, so a source whose
    column order differs still lands in the right columns.
    """
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"source lacks target columns {missing}")
    props = {"truncate": "true", **(properties or {})}
    df.select(*columns).write.jdbc(url=url, table=table, mode="overwrite", properties=props)


def docs_to_json(df: DataFrame, cols: Sequence[str] | None = None, out: str = "json",
                 ts_format: str = "yyyy-MM-dd'T'HH:mm:ss.SSSXXX",
                 ts_ntz_format: str = "yyyy-MM-dd'T'HH:mm:ss.SSS") -> DataFrame:
    """Render rows (nested arrays and structs included) as JSON text.

    Ids are expected as text already; timestamps are written in ISO-8601
    (with the zone offset for zoned timestamps, without for local ones); null
    fields are written as null.
    """
    cols = list(cols) if cols else df.columns
    opts = {"timestampFormat": ts_format, "timestampNTZFormat": ts_ntz_format, "ignoreNullFields": "false"}
    return df.select(F.to_json(F.struct(*cols), opts).alias(out))
