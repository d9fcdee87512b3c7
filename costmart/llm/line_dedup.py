"""Line dedup by overlapping three-line windows.

Lines without a word are passed over. Every three consecutive other lines of a
text form a window, identified by a 128-bit hash. Windows that occur more than
once in the corpus keep their first occurrence, in the order of id (nulls
last), text hash and place; the lines that later occurrences cover are merged
and removed. Lines of fewer than three in a row are never removed.

All of it is DataFrame expressions. A window's first place is an aggregate
that is combined before its shuffle; the join that finds later occurrences
meets each repeated window once on its other side, and AQE splits it where a
window is in a third of all texts.

Cases: null texts stay null, empty ones empty; texts with fewer than three
lines are unchanged; a text all of whose lines go becomes empty; rows that
repeat id and text count as one occurrence and change alike; an empty table
gives an empty result; other columns are kept and may have any names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, unwrapped, wrapped

SOLID = "[^\\x20\\x09-\\x0D]"


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, text hash, all lines and the places of lines with a word."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    lines = F.split(text, "\n")
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), lines.alias("lines"))
            .withColumn("solid", F.filter(F.transform("lines", lambda x, i: F.when(x.rlike(SOLID), i)), lambda i: i.isNotNull())))


def later_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3) -> DataFrame:
    """(doc_id, text_key, at): windows, by number of solid line, that occurred before."""
    solid = _lines(docs, id_col, text_col).select("doc_id", "text_key", F.transform("solid", lambda i: F.get("lines", i)).alias("lines")).where(F.size("lines") >= size)
    lines = F.col("lines")
    window = F.transform(lines, lambda x, i: F.struct(
        F.xxhash64(x, *(F.get(lines, i + k) for k in range(1, size))).alias("h1"),
        F.xxhash64(F.lit(size), *(F.get(lines, i + k) for k in range(1, size)), x).alias("h2")))
    windows = stored(solid.select("doc_id", "text_key", F.posexplode(F.slice(window, 1, F.size(lines) - (size - 1))).alias("at", "w"))
                     .select("w.h1", "w.h2", "doc_id", "text_key", "at"), "line-windows")
    place = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("text_key"), F.col("at"))
    first = windows.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first <> last").select("h1", "h2", "first")
    return windows.join(first, ["h1", "h2"]).where(place != F.col("first")).select("doc_id", "text_key", "at")


def covered(later: DataFrame, size: int = 3) -> DataFrame:
    """(c_id, c_key, gone): numbers of the solid lines to remove, of texts that lose any. The
    windows of rows that repeat id and text are the same few places, and are merged before they are dealt."""
    places = F.transform(F.collect_set("at"), lambda a: F.sequence(a, a + (size - 1)))
    return later.groupBy(F.col("doc_id").alias("c_id"), F.col("text_key").alias("c_key")).agg(F.array_distinct(F.flatten(places)).alias("gone"))


def mark(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3) -> DataFrame:
    """(row, doc_id, rewritten, n_lines, n_removed): ``row`` is the input row,
    ``rewritten`` its text without the removed lines (null: nothing removed)."""
    gone = covered(later_windows(docs, id_col, text_col, size), size)
    on = F.col("doc_id").eqNullSafe(F.col("c_id")) & (F.col("text_key") == F.col("c_key"))
    lines = wrapped(docs, id_col, text_col).join(gone, on, "left").withColumn("lines", F.split("text", "\n"))
    split = lines.withColumn("solid", F.filter(F.transform("lines", lambda x, i: F.when(x.rlike(SOLID), i)), lambda i: i.isNotNull()))
    drop = F.transform("gone", lambda j: F.get("solid", j))
    stay = split.withColumn("stay", F.when(F.col("gone").isNotNull(), F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), drop)))
    return stay.select("row", "doc_id", F.array_join(F.transform("stay", lambda i: F.get("lines", i)), "\n").alias("rewritten"),
                       F.size("solid").cast("long").alias("n_lines"), F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3) -> DataFrame:
    """``docs``, all columns, with the texts rewritten."""
    text = F.coalesce(F.col("rewritten"), F.col("row").getField(text_col))
    return mark(docs, id_col, text_col, size).select(*unwrapped(docs.columns, {text_col: text}))
