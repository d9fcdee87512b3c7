"""Vector codes: product quantisation with Orchard's nearest-entry search.

Each component x becomes the integer floor(256 * x), vectors are cut into
``parts`` equal consecutive parts, and every part position has a codebook of
``entries`` integer entries: at first the parts of the rows with the smallest
ids, then ``rounds`` times the floored means of the parts assigned to them. All
distances are exact integers, so codes do not depend on the order of rows.

The nearest entry is found by Orchard's search. For every entry the others are
listed by their distance to it. A query starts at entry 0 and walks the list of
its best entry so far; a better entry (nearer, or as near with a lower index)
becomes the best one and its own list is walked from the start; entries seen
are marked and never measured again; the walk ends when the list goes beyond
twice the query's distance, as nothing there can be as near. A batch's queries
walk side by side in numpy.

A round is one pass over the rows: every task sums its own parts by entry, and
Spark adds the sums up (``parts * entries`` rows of a fixed number of columns a
task). Only codebooks pass through the driver, ``parts * entries`` rows at any
number of vectors. No rows are shuffled, so equal vectors, however many, are no
hot key; the sum by label is combined before its shuffle and joined as a small
written table.

Cases: rows whose vector is null or holds a null, NaN or infinite component
are dropped; the empty vector and vectors shorter than the longest one are
filled up with zeros, and the length is brought to a multiple of ``parts`` the
same way; |x| counts as 65,536 at most (so that all sums fit a long); rows that
repeat an id or a vector all get a row each, with ties of the smallest ids in
the order of their integers; null ids come last there; fewer rows than entries
make smaller codebooks; unused entries stay as they are; null labels are one
label; a label's sum beyond a long is null; an empty table, or one whose rows
are all dropped, gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

SCALE = 256.0
LARGEST = float(1 << 24)


class Codebooks:
    """Integer entries (part, entry, component) and, for Orchard's search, every
    entry's neighbours by distance, ties by index."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries.astype(np.int64)
        apart = ((self.entries[:, :, None, :] - self.entries[:, None, :, :]) ** 2).sum(axis=3)
        self.order = np.argsort(apart, axis=2, kind="stable")
        self.apart = np.take_along_axis(apart, self.order, axis=2)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest entry and squared distance of every part: x is (row, part, component)."""
        rows, parts, k = x.shape
        m = self.entries.shape[1]
        x, part = x.reshape(-1, k), np.tile(np.arange(parts), rows)
        best = np.zeros(len(x), np.int64)
        near = ((x - self.entries[part, 0]) ** 2).sum(axis=1)
        seen = np.zeros((len(x), m), bool)
        seen[:, 0] = True
        walking, at = np.arange(len(x)), np.zeros(len(x), np.int64)  # queries under way, and their place in the list
        while len(walking):
            p, b = part[walking], best[walking]
            far = self.apart[p, b, at] > 4 * near[walking]  # squared: beyond twice the distance
            if far.any():
                walking, at = walking[~far], at[~far]
                p, b = p[~far], b[~far]
            entry = self.order[p, b, at]
            at = at + 1
            new = np.flatnonzero(~seen[walking, entry])
            q, e = walking[new], entry[new]
            seen[q, e] = True
            d = ((x[q] - self.entries[p[new], e]) ** 2).sum(axis=1)
            better = (d < near[q]) | ((d == near[q]) & (e < best[q]))
            near[q[better]], best[q[better]] = d[better], e[better]
            at[new[better]] = 0
            going = at < m
            walking, at = walking[going], at[going]
        return best.reshape(rows, parts), near.reshape(rows, parts)

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def integers(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(vec_id, label, x array<int>) of the rows whose components are all finite."""
    label_type = vectors.select(F.col(f"`{label_col}`")).schema[0].dataType.simpleString()
    schema = f"vec_id long, label {label_type}, x array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(batch.column("x").is_valid())
            lists = batch.column("x")
            ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
            x = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            wrong = np.concatenate([[0], np.cumsum(~np.isfinite(x))])
            keep = wrong[ends[1:]] == wrong[ends[:-1]]
            q = np.floor(np.clip(np.where(np.isfinite(x), x, 0), -LARGEST / SCALE, LARGEST / SCALE) * SCALE).astype(np.int32)
            whole = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(q))
            out = pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), whole], names=["vec_id", "label", "x"])
            yield out.filter(pa.array(keep))

    named = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{label_col}`").alias("label"),
                           F.col(f"`{vector_col}`").cast("array<double>").alias("x"))
    return named.mapInArrow(run, schema)


def matrix(lists: pa.ListArray, parts: int, width: int) -> np.ndarray:
    """(row, part, component) of integer lists, short ones filled up with zeros."""
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if len(flat) == len(lists) * parts * width:
        return flat.reshape(-1, parts, width)
    out = np.zeros((len(lists), parts * width), np.int64)
    out[np.arange(parts * width)[None, :] < lengths[:, None]] = flat
    return out.reshape(-1, parts, width)


def improved(rows: DataFrame, books: Codebooks) -> Codebooks:
    """Every entry that parts are assigned to becomes their floored mean."""
    parts, m, width = books.entries.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, sums = np.zeros(parts * m, np.int64), np.zeros((parts * m, width), np.int64)
        for batch in batches:
            x = matrix(batch.column("x"), parts, width)
            code, _ = books.nearest(x)
            cell = (code + np.arange(parts) * m).ravel()
            count += np.bincount(cell, minlength=parts * m)
            for j in range(width):  # a batch's sums are exact in a double
                sums[:, j] += np.bincount(cell, x[:, :, j].ravel(), parts * m).astype(np.int64)
        used = np.flatnonzero(count)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(used) + 1, dtype=np.int32) * width), pa.array(sums[used].ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(count[used]), lists], names=["cell", "k", "sums"])

    partial = rows.select("x").mapInArrow(run, "cell long, k long, sums array<long>")
    total = partial.groupBy("cell").agg(F.sum("k").alias("k"), *(F.sum(F.col("sums")[j]).alias(f"s{j}") for j in range(width)))
    entries = books.entries.reshape(parts * m, width).copy()
    for r in total.collect():  # at most parts * m rows
        entries[r["cell"]] = [r[f"s{j}"] // r["k"] for j in range(width)]
    return Codebooks(entries.reshape(parts, m, width))


def fit(rows: DataFrame, parts: int, entries: int, rounds: int) -> Codebooks | None:
    """Codebooks of the rows of ``integers`` (None: no rows)."""
    length = rows.agg(F.max(F.size("x"))).first()[0]
    if length is None:
        return None
    width = max(1, -(-length // parts))
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(entries).collect()
    start = np.zeros((len(first), parts * width), np.int64)
    for i, r in enumerate(first):
        start[i, :len(r["x"])] = r["x"]
    books = Codebooks(start.reshape(-1, parts, width).transpose(1, 0, 2))
    for _ in range(rounds):
        books = improved(rows, books)
    return books


def encode(rows: DataFrame, books: Codebooks) -> DataFrame:
    """(vec_id, label, code, error): two hex digits a part, and the squared distances summed over the parts."""
    parts, _, width = books.entries.shape
    label_type = rows.schema["label"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code, apart = books.nearest(matrix(batch.column("x"), parts, width))
            text = code.astype(np.uint8).tobytes().hex()
            codes = [text[i:i + 2 * parts] for i in range(0, len(text), 2 * parts)]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(codes, pa.string()), pa.array(apart.sum(axis=1))],
                                             names=["vec_id", "label", "code", "error"])

    return rows.mapInArrow(run, f"vec_id long, label {label_type}, code string, error long")


def compress(vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, id_col: str = "vec_id",
             vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(vec_id, label, code, error, label_error, codebooks_sha256) per row that is not dropped."""
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits: 1 to 256 entries")
    rows = stored(integers(vectors, id_col, vector_col, label_col), "vector-integers")
    books = fit(rows, parts, entries, rounds)
    if books is None:
        return rows.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"),
                           F.lit(0).cast("long").alias("label_error"), F.lit("").alias("codebooks_sha256"))
    coded = stored(encode(rows, books), "vector-codes")
    by_label = stored(coded.groupBy(F.col("label").alias("of")).agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("total")), "label-errors")
    return (coded.join(by_label, F.col("label").eqNullSafe(F.col("of")))
            .select("vec_id", "label", "code", "error", F.col("total").try_cast("long").alias("label_error"), F.lit(books.sha256()).alias("codebooks_sha256")))
