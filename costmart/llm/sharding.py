"""Histogram sort: exact splitters by counting, then one exchange.

Rows have a sort key of 62 bits: the leading bits hash the text, so equal
texts lie next to each other, the next ``ID_BITS`` hash the document's id, so
a text held by a third of all rows still spreads over that many keys, and the last
``ROW_BITS`` hash the row's number in the written table, so rows that repeat id and
text (null ids with one text above all) spread as well. Shards
are ranges of keys, and shard j ends where the bytes below reach j/shards of
the total. No row is sampled or sorted to find those ends: every partition
counts the exact bytes and rows below the current probes, Spark sums the
counts, and each open interval is probed more finely, until no row lies
strictly between its ends or the bytes between them are within the tolerance.
The same counts give finer cuts inside the shards, at about ``rows_per_range``
rows each, with the exact number of rows below each. The rows are then
exchanged once, by these ranges; a row's slot is its place in its range plus
the rows below that range in the shard.

On the driver: two counts for each probe, as Arrow columns, and the probes number
``FAN`` times the open ranges, one range for a million rows (1e11 rows: 100,000 ranges,
narrowed side by side in numpy). Only (key, size) is read in a probing round, from a
table that is written once.

Cases: a null text has size 8 and crc32 0; null ids hash like any value; ties within
a key are ordered by id, size and crc32, then arbitrarily between equal rows;
an empty table gives an empty result; other columns pass through ``payload``
and may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

ID_BITS, ROW_BITS = 16, 14
KEY_END = 1 << 62
FAN = 64


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", payload: Sequence[str] = ()) -> DataFrame:
    """doc_id, size, text_crc32 and the sort key; with ``payload`` also a struct of those columns."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    low = ID_BITS + ROW_BITS
    bits = lambda h, n, at: F.shiftleft(F.shiftrightunsigned(h, 64 - n), at)
    key = (bits(F.xxhash64(text), 62 - low, low).bitwiseOR(bits(F.xxhash64(F.col(id_col)), ID_BITS, ROW_BITS))
           .bitwiseOR(bits(F.xxhash64(F.monotonically_increasing_id()), ROW_BITS, 0)))
    out = [F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text) + F.lit(8)).cast("long").alias("size"),
           F.crc32(text.cast("binary")).alias("text_crc32"), key.alias("sort_key")]
    return docs.select(*out, *([F.struct(*[docs[c] for c in payload]).alias("payload")] if payload else []))


def count_below(rows: DataFrame, probes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact (bytes, rows) with a key below each of the sorted probes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((2, len(probes) + 1), np.int64)
        for b in batches:
            at = np.searchsorted(probes, b.column("sort_key").to_numpy(zero_copy_only=False), side="right")
            size = b.column("size").to_numpy(zero_copy_only=False)
            places, inverse = np.unique(at, return_inverse=True)
            np.add.at(n[0], places, _sums(inverse, size, len(places)))
            np.add.at(n[1], places, np.bincount(inverse, minlength=len(places)))
        cell = np.flatnonzero(n[1])
        yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int64)), pa.array(n[0][cell]), pa.array(n[1][cell])], names=["cell", "bytes", "n"])

    counted = (rows.select("sort_key", "size").mapInArrow(run, "cell long, bytes long, n long")
               .groupBy("cell").agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n")).toArrow())
    size, number = np.zeros(len(probes) + 1, np.int64), np.zeros(len(probes) + 1, np.int64)
    cell = counted.column("cell").to_numpy()
    size[cell], number[cell] = counted.column("bytes").to_numpy(), counted.column("n").to_numpy()
    return np.cumsum(size)[:-1], np.cumsum(number)[:-1]


def _sums(group: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Exact integer sums by group (bincount's weights would be floats)."""
    order = np.argsort(group, kind="stable")
    starts = np.searchsorted(group[order], np.arange(n))
    return np.add.reduceat(values[order], starts) if n else np.zeros(0, np.int64)


def splitters(rows: DataFrame, total: int, n: int, targets: np.ndarray, tolerance: np.ndarray, first_probes: int = 4096) -> tuple[np.ndarray, np.ndarray]:
    """For each target number of bytes a key such that the bytes below it are
    within the tolerance of the target, or as near as whole keys allow; and the
    exact number of rows below that key."""
    lo, hi = np.zeros(len(targets), np.int64), np.full(len(targets), KEY_END, np.int64)
    below_lo, below_hi = np.zeros(len(targets), np.int64), np.full(len(targets), total, np.int64)
    rows_lo, rows_hi = np.zeros(len(targets), np.int64), np.full(len(targets), n, np.int64)
    fan = first_probes
    while True:
        open_ = (hi - lo > 1) & (below_hi > below_lo) & (np.minimum(targets - below_lo, below_hi - targets) > tolerance)
        if not open_.any():
            break
        ends = np.unique(np.stack([lo[open_], hi[open_]], 1), axis=0)
        probes = _inner(ends[:, 0], ends[:, 1], fan)
        size, number = count_below(rows, probes)
        j = np.flatnonzero(open_)
        first, last = np.searchsorted(probes, lo[j] + 1), np.searchsorted(probes, hi[j])
        up = np.clip(np.searchsorted(size, targets[j]), first, last)  # the first probe inside with the target's bytes below it
        down = up[up > first] - 1
        to, at = j[up > first], j[up < last]
        lo[to], below_lo[to], rows_lo[to] = probes[down], size[down], number[down]
        up = up[up < last]
        hi[at], below_hi[at], rows_hi[at] = probes[up], size[up], number[up]
        fan = FAN
    upper = np.abs(below_hi - targets) < np.abs(targets - below_lo)
    return np.where(upper, hi, lo), np.where(upper, rows_hi, rows_lo)


def _inner(a: np.ndarray, b: np.ndarray, fan: int) -> np.ndarray:
    """Sorted probes inside each of the open intervals (a, b): every key of a short one."""
    step = np.maximum(1, (b - a) // fan)
    n = np.minimum((b - a - 1) // step, 2 * fan)
    heads = np.cumsum(n) - n
    return np.unique(np.repeat(a, n) + np.repeat(step, n) * (np.arange(n.sum()) - np.repeat(heads, n) + 1))


def histogram_sort(docs: DataFrame, shards: int = 24, tolerance: float = 0.0, rows_per_range: int = 1_000_000,
                   id_col: str = "doc_id", text_col: str = "text", payload: Sequence[str] = ()) -> DataFrame:
    """(doc_id, size, text_crc32, sort_key, shard, slot[, payload]).

    ``tolerance``: allowed distance of a shard's end from its share, as a part
    of a shard's mean bytes; 0 looks for the nearest whole keys."""
    full = stored(keyed(docs, id_col, text_col, payload), "shard-keys")  # once: keys hold the rows' numbers
    narrow = full.drop("payload")
    total, n = narrow.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    fine = max(4, -(-n // (shards * rows_per_range)))  # ranges a shard
    at = np.arange(1, shards * fine)
    targets = total * at // (shards * fine)
    share = total / max(1, shards)
    loose = share / fine / 4
    keys, below = splitters(narrow, total, n, targets, np.where(at % fine == 0, tolerance * share, loose))
    keys, below = np.maximum.accumulate(keys), np.maximum.accumulate(below)
    shard_rows = np.concatenate([[0], below[fine - 1::fine]])
    range_rows = np.concatenate([[0], below])
    offset = range_rows - np.repeat(shard_rows, fine)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            r = np.searchsorted(keys, b.column("sort_key").to_numpy(zero_copy_only=False), side="right")
            more = [pa.array(r.astype(np.int32)), pa.array((r // fine).astype(np.int32)), pa.array(offset[r])]
            yield pa.RecordBatch.from_arrays([*b.columns, *more], names=[*b.schema.names, "range", "shard", "offset"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in full.schema) + ", range int, shard int, offset long"
    placed = full.mapInArrow(place, schema)
    order = Window.partitionBy("range").orderBy("sort_key", "doc_id", "size", "text_crc32")
    return (placed.withColumn("slot", F.col("offset") + F.row_number().over(order) - 1)
            .drop("range", "offset"))
