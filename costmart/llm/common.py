"""Helpers shared by the operators of this package."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import ensure_checkpoint_dir, scratch_path

#: Words are runs of other characters than these six (space, \t \n \v \f \r).
SPACES = " \t\n\x0b\x0c\r"
#: Rows and bytes of an Arrow batch: what a Python worker holds of whole texts at a time (one text at least).
BATCH_ROWS, BATCH_BYTES = 1000, 32_000_000
WORD_BREAK = "[\\x20\\x09-\\x0D]+"


def prepare(spark: SparkSession) -> SparkSession:
    """Name the checkpoint folder, keep Arrow batches of whole texts small, and
    let Python workers import this package from where the driver has it (a
    cluster installs it or uses --py-files)."""
    ensure_checkpoint_dir(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    root = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it
    back: lineage ends there, and a lost executor takes nothing with it."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", null_text: str | None = "") -> DataFrame:
    """The two columns an operator needs as (doc_id bigint, text string); any
    further columns, whatever their names, are left behind."""
    text = F.col(text_col).cast("string")
    if null_text is not None:
        text = F.coalesce(text, F.lit(null_text))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))


def wrapped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, doc_id, text, text_key): the whole row as one struct, so that no
    column name of the caller can clash with an operator's own; nulls in text
    count as empty, and text_key is a hash of it."""
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return docs.select(whole, F.col(f"`{id_col}`").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_key"))


def unwrapped(columns: list[str], changed: dict[str, Column] | None = None) -> list[Column]:
    """The caller's columns out of ``row``, some of them changed."""
    return [((changed or {}).get(c, F.col("row").getField(c))).alias(c) for c in columns]


def words_of(text: Column) -> Column:
    """Array of the words of a text (empty array: no word)."""
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WORD_BREAK))


_held: list = []  # of this worker: a key and what is kept for it


def held(key: tuple, make: Callable):
    """What ``make()`` gave for ``key`` in an earlier task of this worker. A worker outlives the
    operators of a pipeline and keeps one such thing, so theirs don't add up."""
    if not _held or _held[0] != key:
        let_go()
        _held[:] = [key, make()]
    return _held[1]


def let_go() -> None:
    """Forget what another operator has kept in this worker, and give Arrow's free memory back."""
    _held.clear()
    pa.default_memory_pool().release_unused()


def map_rows(df: DataFrame, fn: Callable, schema: str, chars: int = 4_000_000, keeps: bool = False) -> DataFrame:
    """``mapInArrow`` where ``fn(columns: dict of Python lists) -> dict of lists``.

    Works through each Arrow batch in slices whose ``text`` column holds about
    ``chars`` characters (one whole text at least), so Python holds only one
    slice of texts besides the batch itself. ``keeps``: ``fn`` uses ``held``.
    """
    arrow = _arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not keeps:
            let_go()
        for whole in batches:
            for part in slices(whole, chars):
                out = fn({n: c.to_pylist() for n, c in zip(part.schema.names, part.columns)})
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def slices(whole: pa.RecordBatch, chars: int) -> Iterator[pa.RecordBatch]:
    at, held = 0, 0
    sizes = pc.fill_null(pc.binary_length(whole.column("text")), 0).to_pylist()
    for i, size in enumerate(sizes):
        if held and held + size > chars or i - at >= 8192:
            yield whole.slice(at, i - at)
            at, held = i, 0
        held += size
    if at < whole.num_rows:
        yield whole.slice(at)


def _arrow_schema(schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(StructType.fromDDL(schema))


def fold(column: Column, n: int) -> Column:
    """crc32 of the value as text, modulo n (null counts as the empty text)."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % n
