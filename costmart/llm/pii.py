"""Personal data by bootstrapped contextual extraction.

1. Seeds: spans of the fixed formats (e-mail, address, card, phone).
2. Each seed induces two lexical patterns: the two words before it, and the
   word before with the word after. The same keys are taken for every other
   token with a digit, of ``MIN_LENGTH`` characters or more (candidates).
3. How often a pattern's context occurs before any word at all is counted over
   the whole corpus, so a pattern of common words has a low precision.
4. On the graph of patterns and instances, Spark alternates: a pattern's
   confidence is the instances' confidence it covers, over all occurrences of
   its context; an instance's confidence is the noisy-or over its patterns.
   Seeds keep confidence 1; patterns need ``support`` different seeds.
5. Occurrences of instances of ``accept`` or more, in a pattern of
   ``pattern_accept`` or more, become spans of kind ``id``. Base spans stay.

Nothing of this is held on the driver. What is broadcast is one bitmap of
fixed size that marks the patterns' hashes, a filter before an exact join.
Edges are aggregated before they are joined, so an instance or a pattern with
a third of all rows is one row for each task; AQE splits skewed joins.

Cases: a null text counts as empty; texts without any span give empty strings
and the digest of the empty string; rows that repeat id and text get equal
spans; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from .common import SPACES, id_and_text, map_rows, slices, stored
from .spans import PRIVATE, find, sha256, written

NAMES = [*PRIVATE, "id"]
MIN_LENGTH = 5
NEAR = 512  # characters on either side in which the context's words are looked for
BITMAP = 1 << 23
EDGE = "\"'()[]{}<>.,;:!?"
PUNCTUATION = EDGE.encode()
SPACE = re.compile(r"[\x20\x09-\x0D]")
DIGIT = re.compile("[0-9]")
MASK = (1 << 63) - 1
FOUND = ("doc_id long, text_key long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
         "base array<struct<start:int,kind:int,end:int>>, "
         "near array<struct<start:int,end:int,kind:int,instance:long,before:long,around:long>>")


def plain_words(text: str) -> list[bytes]:
    return text.encode().translate(None, PUNCTUATION).lower().split()


def before_key(a: bytes, b: bytes) -> int:
    return xxh3_64_intdigest(b"2 " + a + b" " + b) & MASK


def around_key(a: bytes, b: bytes) -> int:
    return xxh3_64_intdigest(b"1 " + a + b" " + b) & MASK


def digit_tokens(text: str) -> Iterator[tuple[int, int]]:
    """Space-delimited tokens with a digit, without punctuation at their ends."""
    end, m = 0, DIGIT.search(text)
    while m:
        i = m.start()
        start = max(max(text.rfind(c, end, i) for c in SPACES) + 1, end)
        stop = SPACE.search(text, i)
        end = stop.start() if stop else len(text)
        a, b = start, end
        while a < b and text[a] in EDGE:
            a += 1
        while b > a and text[b - 1] in EDGE:
            b -= 1
        if b - a >= MIN_LENGTH:
            yield a, b
        m = DIGIT.search(text, end)


def occurrences(text: str, base: list[tuple[int, int, int]]) -> list[tuple]:
    """(start, end, kind or None, instance, before, around) of seeds and candidates."""
    taken = [(a, b) for a, _, b in base]
    found = [(a, b, k) for a, k, b in base]
    found += [(a, b, None) for a, b in digit_tokens(text) if not any(a < y and x < b for x, y in taken)] if len(taken) < 64 else \
             [(a, b, None) for a, b in digit_tokens(text) if not _hits(taken, a, b)]
    out = []
    for a, b, k in found:
        left = plain_words(text[max(0, a - NEAR):a])[-2:]
        right = plain_words(text[b:b + NEAR])[:1]
        instance = xxh3_64_intdigest(text[a:b].lower().encode()) & MASK
        out.append((a, b, k, instance, before_key(*left) if len(left) == 2 else None,
                    around_key(left[-1], right[0]) if left and right else None))
    return out


def _hits(taken: list[tuple[int, int]], a: int, b: int) -> bool:
    from bisect import bisect_left

    i = bisect_left(taken, (b, 0))
    return any(x < b and a < y for x, y in taken[max(0, i - 4):i])


def scan(cols: dict) -> dict:
    out: dict[str, list] = {n.split()[0]: [] for n in ("doc_id", "text_key", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "base", "near")}
    out["doc_id"], out["text_key"] = cols["doc_id"], cols["text_key"]
    for text in cols["text"]:
        base = find(text, PRIVATE)
        for i, name in enumerate(PRIVATE):
            out[f"n_{name}"].append(sum(k == i for _, k, _ in base))
        out["base_sha256"].append(sha256(written(base, NAMES)))
        out["base"].append([{"start": a, "kind": k, "end": b} for a, k, b in base])
        out["near"].append([dict(zip(("start", "end", "kind", "instance", "before", "around"), o)) for o in occurrences(text, base)])
    return out


def context_counts(texts: DataFrame, marks: DataFrame) -> DataFrame:
    """(pattern, total): how often each marked context occurs before any word."""
    bitmap = np.zeros(BITMAP, bool)
    bitmap[[r[0] for r in marks.select((F.col("pattern") % BITMAP).cast("int")).distinct().collect()]] = True
    if not bitmap.any():
        return marks.select("pattern", F.lit(0).cast("long").alias("total"))
    packed = np.packbits(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked, held = np.unpackbits(packed).astype(bool), []
        for batch in batches:
            for part in slices(batch, 4_000_000):
                for text in part.column("text").to_pylist():
                    w = plain_words(text)
                    pairs = chain((before_key(a, b) for a, b in zip(w, w[1:-1])), (around_key(a, b) for a, b in zip(w, w[2:])))
                    keys = np.fromiter(pairs, np.int64)
                    held.append(keys[marked[keys % BITMAP]])
                yield _counted(held)
                held = []

    return (texts.mapInArrow(run, "pattern long, total long").groupBy("pattern").agg(F.sum("total").alias("total"))
            .join(marks.select("pattern"), "pattern", "left_semi"))


def _counted(held: list[np.ndarray]) -> pa.RecordBatch:
    keys, n = np.unique(np.concatenate([*held, np.zeros(0, np.int64)]), return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.array(n.astype(np.int64))], names=["pattern", "total"])


def bootstrap(edges: DataFrame, totals: DataFrame, rounds: int, accept: float, pattern_accept: float) -> DataFrame:
    """(pattern, instance) of accepted instances that are no seeds, with an accepted pattern."""
    graph = stored(edges.join(totals, "pattern"), "pii-graph")
    instances = graph.groupBy("instance").agg(F.max("seed").cast("double").alias("sure"))
    conf = instances.withColumn("conf", F.col("sure"))
    patterns = None
    for _ in range(rounds):
        covered = graph.join(conf, "instance").groupBy("pattern").agg(
            (F.sum(F.col("n") * F.col("conf")) / (F.max(F.greatest("total", F.lit(0))) + 1)).alias("p"))
        patterns = covered.select("pattern", F.least("p", F.lit(0.999)).alias("p"))
        reached = graph.join(patterns, "pattern").groupBy("instance").agg(
            F.max("seed").alias("seed"), (1 - F.exp(F.sum(F.log(1 - F.col("p"))))).alias("p"))
        conf = stored(reached.select("instance", F.col("seed").cast("double").alias("sure"),
                                     F.when(F.col("seed") == 1, 1.0).otherwise(F.col("p")).alias("conf")), "pii-instances")
    good = conf.where((F.col("sure") == 0) & (F.col("conf") >= accept)).select("instance")
    return (graph.join(patterns.where(F.col("p") >= pattern_accept), "pattern")
            .join(good, "instance", "left_semi").select("pattern", "instance"))


def extract(docs: DataFrame, rounds: int = 3, support: int = 3, accept: float = 0.8, pattern_accept: float = 0.5,
            id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_found) per row."""
    texts = id_and_text(docs, id_col, text_col)
    found = stored(map_rows(texts.withColumn("text_key", F.xxhash64("text")), scan, FOUND), "pii-found")
    one = found.select("doc_id", "text_key", F.explode("near").alias("o")).select("doc_id", "text_key", "o.*")
    both = one.select("doc_id", "text_key", "start", "end", "kind", "instance", F.explode(F.array("before", "around")).alias("pattern")).where("pattern is not null")
    edges = both.groupBy("pattern", "instance").agg(F.count(F.lit(1)).alias("n"), F.max(F.col("kind").isNotNull().cast("int")).alias("seed"))
    induced = stored(edges.where("seed = 1").groupBy("pattern").agg(F.count(F.lit(1)).alias("seeds")).where(F.col("seeds") >= support), "pii-patterns")
    totals = context_counts(texts.select("text"), induced)
    accepted = bootstrap(edges, totals, rounds, accept, pattern_accept)
    more = (both.where("kind is null").join(accepted, ["pattern", "instance"], "left_semi").groupBy("doc_id", "text_key")
            .agg(F.collect_set(F.struct("start", F.lit(len(PRIVATE)).alias("kind"), "end")).alias("more")))
    names = F.array(*map(F.lit, NAMES))
    every = F.array_sort(F.concat("base", F.coalesce("more", F.expr("array()").cast("array<struct<start:int,kind:int,end:int>>"))))
    write = F.array_join(F.transform(every, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")
    base = found.drop("near")
    joined = base.join(more.withColumnsRenamed({"doc_id": "m_id", "text_key": "m_key"}),
                       F.col("doc_id").eqNullSafe(F.col("m_id")) & (F.col("text_key") == F.col("m_key")), "left")
    return joined.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", write.alias("spans"),
                         F.coalesce(F.size("more"), F.lit(0)).cast("long").alias("n_found"))
