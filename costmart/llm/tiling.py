"""Benchmark decontamination by greedy string tiling.

Texts and benchmark items are compared as lower-case words without punctuation
at their ends. Windows of ``seed`` words are the seeds (an item with fewer
words is one seed): texts that share a seed with an item are candidates. For
each candidate and item, the longest matches of still unmarked words on both
sides are marked again and again, none shorter than the seed; matches start
from Karp-Rabin rolling hashes of the seeds and are confirmed word by word.
Tiles may lie in any order, so passages whose parts were moved are caught. A
text is contaminated if tiles cover ``coverage`` of some item's words.

Seeds are joined in Spark. What every task gets of the benchmark is a bitmap
of fixed size marking its seeds' hashes, which only spares the join most
texts; candidates carry their text along, so no other text is shuffled. A
benchmark of any size works.

Cases: null and empty texts are clean; items without a word are passed over;
rows that repeat id and text are tested once and get equal results; items
that repeat an id are each tested; texts or benchmarks without rows give no
contamination; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from .common import id_and_text, let_go, map_rows, slices, stored, unwrapped, wrapped

BITMAP = 1 << 23
BASE = np.uint64(0x9E3779B97F4A7C15)
EDGE = b"\"'()[]{}<>.,;:!?"


def word_hashes(text: str) -> np.ndarray:
    words = [w for x in text.encode().lower().split() if (w := x.strip(EDGE))]
    return np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Karp-Rabin hashes modulo 2^64 of all windows, as signed numbers."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    out = np.full(n, size, np.uint64)
    for j in range(size):
        out = out * BASE + words[j:j + n]
    return (out ^ (out >> np.uint64(29))).view(np.int64)


def tile(pattern: np.ndarray, text: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Tiles (place in the pattern, place in the text, length), longest first."""
    least = min(least, len(pattern))
    if not least:
        return []
    starts: dict[int, list[int]] = {}
    for i, h in enumerate(window_hashes(pattern, least).tolist()):
        starts.setdefault(h, []).append(i)
    hashes = window_hashes(text, least)
    places = np.flatnonzero(np.isin(hashes, np.fromiter(starts, np.int64, len(starts))))
    pairs = {(i, int(t)) for t in places for i in starts[int(hashes[t])] if np.array_equal(pattern[i:i + least], text[t:t + least])}
    p, t = pattern.tolist(), text.tolist()
    free_p, free_t = [True] * len(p), [True] * len(t)
    tiles = []
    while pairs:
        open_ = {(i, j) for i, j in pairs if all(free_p[i:i + least]) and all(free_t[j:j + least])}
        best, found = 0, []
        for i, j in open_:
            if (i - 1, j - 1) in open_:
                continue  # inside a longer match
            n = least
            while i + n < len(p) and j + n < len(t) and p[i + n] == t[j + n] and free_p[i + n] and free_t[j + n]:
                n += 1
            if n >= best:
                best, found = n, [*(found if n == best else []), (i, j)]
        for i, j in sorted(found):
            if all(free_p[i:i + best]) and all(free_t[j:j + best]):
                tiles.append((i, j, best))
                free_p[i:i + best] = free_t[j:j + best] = [False] * best
        pairs = open_
        if not found:
            break
    return tiles


def coverage_of(pattern: np.ndarray, text: np.ndarray, least: int) -> float:
    return sum(n for _, _, n in tile(pattern, text, least)) / len(pattern) if len(pattern) else 0.0


def item_seeds(items: DataFrame, seed: int) -> DataFrame:
    def run(cols: dict) -> dict:
        out: dict[str, list] = {"item_id": [], "item_key": [], "size": [], "seed": []}
        for i, key, text in zip(cols["doc_id"], cols["text_key"], cols["text"], strict=True):
            w = word_hashes(text)
            size = min(seed, len(w))
            for h in set(window_hashes(w, size).tolist()) if size else ():
                for name, x in (("item_id", i), ("item_key", key), ("size", size), ("seed", h)):
                    out[name].append(x)
        return out

    return map_rows(items, run, "item_id long, item_key long, size int, seed long")


def candidates(texts: DataFrame, sizes: list[int], bitmap: np.ndarray) -> DataFrame:
    """Texts with windows that the bitmap marks, and those windows' hashes."""
    packed = np.packbits(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        marked = np.unpackbits(packed).astype(bool)
        for batch in batches:
            for part in slices(batch, 4_000_000):
                rows, hits = [], []
                for i, text in enumerate(part.column("text").to_pylist()):
                    w = word_hashes(text)
                    h = np.concatenate([window_hashes(w, s) for s in sizes])
                    h = np.unique(h[marked[h & (BITMAP - 1)]])
                    if len(h):
                        rows.append(i)
                        hits.append(h)
                kept = part.take(pa.array(rows, pa.int32()))
                yield pa.RecordBatch.from_arrays([*kept.columns, pa.array([h.tolist() for h in hits], pa.list_(pa.int64()))], names=["doc_id", "text_key", "text", "hits"])

    return texts.select("doc_id", "text_key", "text").mapInArrow(run, "doc_id long, text_key long, text string, hits array<long>")


def contamination(docs: DataFrame, benchmark: DataFrame, seed: int = 5, coverage: float = 0.5, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(c_id, c_key, item_ids, max_coverage) of contaminated texts; c_key is xxhash64 of the text."""
    key = F.xxhash64("text").alias("text_key")
    items = id_and_text(benchmark, item_col, item_text_col).select("*", key)
    seeds = stored(item_seeds(items, seed), "tiling-seeds")
    bitmap = np.zeros(BITMAP, bool)
    bitmap[[r[0] for r in seeds.select(F.col("seed").bitwiseAND(F.lit(BITMAP - 1)).cast("int")).distinct().collect()]] = True  # at most BITMAP numbers
    sizes = sorted(r[0] for r in seeds.select("size").distinct().collect()) or [seed]
    found = stored(candidates(id_and_text(docs, id_col, text_col).select("*", key), sizes, bitmap), "tiling-candidates")
    pairs = (found.select("doc_id", "text_key", F.explode("hits").alias("seed")).join(seeds.select("seed", "item_id", "item_key"), "seed")
             .select("doc_id", "text_key", "item_id", "item_key").distinct())
    item_texts = items.select(F.col("doc_id").alias("i_id"), F.col("text_key").alias("i_key"), F.col("text").alias("item")).distinct()
    texts = found.select(F.col("doc_id").alias("t_id"), F.col("text_key").alias("t_key"), "text").dropDuplicates(["t_id", "t_key"])
    both = (pairs.join(item_texts, F.col("item_id").eqNullSafe(F.col("i_id")) & (F.col("item_key") == F.col("i_key")))
            .join(texts, F.col("doc_id").eqNullSafe(F.col("t_id")) & (F.col("text_key") == F.col("t_key")))
            .select("doc_id", "text_key", "item_id", "item", "text"))

    def run(cols: dict) -> dict:
        words, last = np.zeros(0, np.uint64), None
        cover = []
        for item, text in zip(cols["item"], cols["text"], strict=True):
            if text is not last:
                words, last = word_hashes(text), text
            cover.append(coverage_of(word_hashes(item), words, seed))
        return {n: cols[n] for n in ("doc_id", "text_key", "item_id")} | {"cover": cover}

    covered = map_rows(both, run, "doc_id long, text_key long, item_id long, cover double").where(F.col("cover") >= coverage)
    return covered.groupBy(F.col("doc_id").alias("c_id"), F.col("text_key").alias("c_key")).agg(
        F.array_sort(F.collect_set("item_id")).alias("item_ids"), F.max("cover").alias("max_coverage"))


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that no benchmark item covers, all columns kept."""
    found = contamination(docs, benchmark, id_col=id_col, text_col=text_col, **options).select("c_id", "c_key")
    on = F.col("doc_id").eqNullSafe(F.col("c_id")) & (F.col("text_key") == F.col("c_key"))
    return wrapped(docs, id_col, text_col).join(found, on, "left_anti").select(*unwrapped(docs.columns))
