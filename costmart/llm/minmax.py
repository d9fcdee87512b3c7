"""Near-duplicates by min-max hashing.

A text's set is its distinct word shingles (64-bit hashes). Under each of
``hashes`` permutations both the smallest and the largest value are kept, so a
signature has twice as many entries as hash evaluations, and each entry of two
texts agrees with probability of their Jaccard similarity. Bands of ``rows``
entries are hashed; at the defaults two texts of similarity 0.8 share no band
with a probability of 1e-7.

Texts with equal sets form a class, represented by its smallest id, before any
band is looked at. Buckets of a band are not expanded into pairs: each member
is first compared with the bucket's smallest id only. After the components of
those links, only pairs of different components can still add anything. So in
buckets that still hold several components, the members outside the first's
component meet members of other components in an exact prefix and positional
filter on their rarest shingles, which passes few pairs that are no links. A
bucket inside one component costs nothing more. Every link is confirmed on the
full sets.

Cases: null and empty texts have no set, no link and stay their own component;
a text with fewer words than a shingle is one shingle of all its words; rows
that repeat an id are one document; rows without an id are kept and linked
with nothing; ties of similarity at the threshold are links; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from .common import id_and_text, let_go, slices, stored, unwrapped, wrapped
from .components import components

COUNTS = 1 << 20
GOLD = np.uint64(0x9E3779B97F4A7C15)
SIGNED = "doc_id long, n long, key_hi long, key_lo long, bands array<long>"


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64 (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str, words: int) -> np.ndarray:
    """Sorted distinct 64-bit shingles of the words, with A-Z in lower case."""
    w = text.encode().lower().split()
    h = np.fromiter(map(xxh3_64_intdigest, w), np.uint64, len(w))
    if not len(h):
        return h
    m = min(words, len(h))
    n = len(h) - m + 1
    out = np.full(n, m, np.uint64)
    for j in range(m):
        out = mix(out * GOLD + h[j:j + n])
    return np.unique(out)


class MinMax:
    def __init__(self, hashes: int, rows: int, seed: int = 1):
        r = np.random.default_rng(seed)
        self.a = r.integers(0, 1 << 32, hashes, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
        self.b = r.integers(0, 1 << 32, hashes, dtype=np.uint64).astype(np.uint32)
        self.order = r.permutation(2 * hashes)  # a band mixes minima and maxima of different permutations
        self.rows = rows

    def signature(self, shingles: np.ndarray, block: int = 2048) -> np.ndarray:
        h = (shingles >> np.uint64(32)).astype(np.uint32)
        low, high = np.full(len(self.a), 0xFFFFFFFF, np.uint32), np.zeros(len(self.a), np.uint32)
        for i in range(0, len(h), block):
            v = self.a[:, None] * h[None, i:i + block]
            v += self.b[:, None]
            np.minimum(low, v.min(axis=1), out=low)
            np.maximum(high, v.max(axis=1), out=high)
        return np.concatenate([low, high])[self.order]

    def bands(self, shingles: np.ndarray) -> np.ndarray:
        entries = self.signature(shingles).reshape(-1, self.rows).astype(np.uint64)
        out = np.arange(1, len(entries) + 1, dtype=np.uint64)
        for j in range(self.rows):
            out = mix(out * GOLD + entries[:, j])
        return out.view(np.int64)


def sign(texts: DataFrame, words: int, hashes: int, rows: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        scheme = MinMax(hashes, rows)
        for batch in batches:
            for part in slices(batch, 4_000_000):
                n, hi, lo, bands, ends = [], [], [], [], [0]
                ids = part.column("doc_id")
                for i, text in zip(ids.to_pylist(), part.column("text").to_pylist(), strict=True):
                    s = shingle_set(text, words)
                    n.append(len(s))
                    m = mix(s) if len(s) else np.array([i or 0], np.int64).view(np.uint64)
                    hi.append(m.sum(dtype=np.uint64))
                    lo.append(np.bitwise_xor.reduce(mix(m + GOLD)))
                    bands.append(scheme.bands(s) if len(s) else np.zeros(0, np.int64))
                    ends.append(ends[-1] + len(bands[-1]))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(bands)))
                as_long = lambda x: pa.array(np.array(x, np.uint64).view(np.int64))
                yield pa.RecordBatch.from_arrays([ids, pa.array(n, pa.int64()), as_long(hi), as_long(lo), lists], names=["doc_id", "n", "key_hi", "key_lo", "bands"])

    return texts.mapInArrow(run, SIGNED)


def confirm(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Those pairs (a, b) whose full sets have 100 * intersection >= percent * union."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        last, held = None, None
        for batch in batches:
            yes = []
            for a, b, s, t in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "text_a", "text_b")), strict=True):
                if a != last:
                    last, held = a, shingle_set(s, words)
                other = shingle_set(t, words)
                both = len(held) + len(other) - len(np.union1d(held, other))
                yes.append(100 * both >= percent * (len(held) + len(other) - both))
            yield batch.select(["a", "b"]).filter(pa.array(yes, pa.bool_()))

    one = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    two = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    return pairs.join(one, "b").join(two, "a").select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def near(percent: int):
    """Sizes that allow the similarity."""
    return 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, hashes: int = 100, rows: int = 5,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row."""
    texts = id_and_text(docs, id_col, text_col)
    signed = stored(sign(texts, words, hashes, rows), "minmax-signed")
    full = signed.where("n > 0 and doc_id is not null")
    classes = stored(full.groupBy("key_hi", "key_lo").agg(F.min("doc_id").alias("node")), "minmax-classes")
    nodes = stored(full.join(classes.select(F.col("node").alias("doc_id")), "doc_id", "left_semi")
                   .select(F.col("doc_id").alias("node"), "n", "bands"), "minmax-nodes")
    entries = nodes.select("node", "n", F.posexplode("bands").alias("band", "bucket"))
    buckets = (entries.groupBy("bucket").agg(F.min("node").alias("head"), F.max("node").alias("last"))
               .where("head <> last").select("bucket", "head"))
    members = stored(entries.join(buckets, "bucket"), "minmax-members")
    if members.isEmpty():
        labels = None
    else:
        sizes = nodes.select("node", "n")
        reps = texts.where("doc_id is not null").join(nodes.select(F.col("node").alias("doc_id")), "doc_id", "left_semi")
        first = (members.where("node <> head").select(F.col("head").alias("a"), F.col("node").alias("b"), F.col("n").alias("n_b")).distinct()
                 .join(sizes.select(F.col("node").alias("a"), F.col("n").alias("n_a")), "a").where(near(percent)).select("a", "b"))
        links = stored(confirm(first, reps, words, percent), "minmax-links")
        rest = remaining(members, components(links), reps, words, percent)
        more = confirm(stored(rest, "minmax-rest"), reps, words, percent)
        labels = components(links.unionByName(more))
    labelled = classes.withColumn("component_id", F.col("node")).drop("node") if labels is None else (
        classes.join(labels, "node", "left").select("key_hi", "key_lo", F.coalesce("component", "node").alias("component_id")))
    known = signed.select("doc_id", "n", "key_hi", "key_lo", ((F.col("n") > 0) & F.col("doc_id").isNotNull()).alias("has"))
    out = known.join(labelled.withColumn("has", F.lit(True)), ["key_hi", "key_lo", "has"], "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept"))


def remaining(members: DataFrame, labels: DataFrame, reps: DataFrame, words: int, percent: int) -> DataFrame:
    """Pairs (a, b) of different components that can still be links.

    Taken are the members of buckets that hold several components, each with
    the rarest shingles of its set: two sets of the similarity must have one of
    them in common (prefix filter), and the shingles up to the first common one
    must not be too many (positional filter). Any common order of shingles is
    exact; theirs is by a hashed count, of fixed size, among these members.
    """
    of = lambda c, name: labels.select(F.col("node").alias(c), F.col("component").alias(name))
    placed = (members.join(of("node", "c"), "node", "left").withColumn("c", F.coalesce("c", "node"))
              .join(of("head", "h"), "head", "left").withColumn("h", F.coalesce("h", "head")))
    open_ = placed.groupBy("bucket").agg(F.max((F.col("c") != F.col("h")).cast("int")).alias("o")).where("o = 1").select("bucket")
    inside = stored(placed.join(open_, "bucket").groupBy("node", "c").agg(F.max((F.col("c") != F.col("h")).cast("int")).alias("outside")), "minmax-open")
    texts = stored(reps.join(inside.select(F.col("node").alias("doc_id")), "doc_id", "left_semi"), "minmax-open-texts")
    rank = texts.sparkSession.sparkContext.broadcast(hashed_counts(texts, words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            for part in slices(batch, 4_000_000):
                firsts, n = [], []
                for text in part.column("text").to_pylist():
                    s = shingle_set(text, words)
                    n.append(len(s))
                    keep = len(s) + 1 - -(-percent * len(s) // 100)
                    firsts.append(s[np.lexsort((s, rank.value[(s & np.uint64(COUNTS - 1)).astype(np.int64)]))][:keep].view(np.int64).tolist())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n, pa.int64()), pa.array(firsts, pa.list_(pa.int64()))], names=["node", "n", "firsts"])

    prefixes = stored(texts.mapInArrow(run, "node long, n long, firsts array<long>").join(inside, "node"), "minmax-prefixes")
    tokens = prefixes.select("node", "n", "c", "outside", F.posexplode("firsts").alias("at", "token"))
    u = tokens.where("outside = 1").select("token", *(F.col(x).alias(f"{x}_a") for x in ("node", "n", "c", "at")))
    v = tokens.select("token", *(F.col(x).alias(f"{x}_b") for x in ("node", "n", "c", "outside", "at")))
    # the common shingles are at most those from here on
    reach = (100 + percent) * F.least(F.col("n_a") - F.col("at_a"), F.col("n_b") - F.col("at_b")) >= percent * (F.col("n_a") + F.col("n_b"))
    once = (F.col("outside_b") == 0) | (F.col("node_a") < F.col("node_b"))
    pairs = u.join(v, (u["token"] == v["token"]) & (F.col("c_a") != F.col("c_b")) & once & near(percent) & reach)
    return pairs.select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")).distinct()


def hashed_counts(texts: DataFrame, words: int) -> np.ndarray:
    """How many sets hold a shingle, by the shingle's last bits (COUNTS numbers at any size)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        total = np.zeros(COUNTS, np.int64)
        for batch in batches:
            for text in batch.column("text").to_pylist():
                s = shingle_set(text, words)
                np.add.at(total, (s & np.uint64(COUNTS - 1)).astype(np.int64), 1)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["cell", "k"])

    rows = texts.select("text").mapInArrow(run, "cell long, k long").groupBy("cell").agg(F.sum("k").alias("k")).toArrow()
    out = np.zeros(COUNTS, np.int64)
    out[rows.column("cell").to_numpy()] = rows.column("k").to_numpy()
    return out


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs``, all columns: of each component only the rows with the smallest id."""
    gone = (near_duplicates(docs, words, percent, id_col=id_col, text_col=text_col, **options)
            .where("not kept").select(F.col("doc_id").alias("g_id")).distinct())
    return wrapped(docs, id_col, text_col).join(gone, F.col("doc_id") == F.col("g_id"), "left_anti").select(*unwrapped(docs.columns))
