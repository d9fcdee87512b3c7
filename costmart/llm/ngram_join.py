"""Similarity join of word n-gram sets by rare-first prefix filtering.

A document's set is its distinct n-grams of words (64-bit hashes), and two
documents link when 100 * intersection >= percent * union. Equal sets are one
class, represented by its smallest id, before anything is joined.

**Sieve.** Two linked sets have at most ``n - ceil(percent * n / 100)`` n-grams
that the other lacks, so in their prefixes by hash, a tenth longer than that,
they share about a tenth of n. Classes with fewer n-grams that any other prefix
holds are linked with nothing; for most of a corpus that settles it, at a
third of the n-grams. It is exact: it uses the prefix bound only.

**Order.** Of the classes left the whole sets are counted, and every set is put
in the order of its n-grams' counts, rarest first. An n-gram that no other set
holds comes first and is left out (its number is kept); a set with too few
shared n-grams left goes too.

**Join.** A set probes with the n-grams of its prefix and is found by those of
its shorter index prefix, as only a set of at least its own size looks for it.
Probe and index entries are joined on (n-gram, band of sizes): the length filter
is part of the key. Positions of the common n-gram bound the rest of the overlap
(positional filter); distinct pairs then meet the suffix filter, which splits both
rests by ranges of the hash and adds up the smaller parts, and what passes is
verified once on the shared n-grams of both sets.

``links`` returns every linked pair. ``linked_groups`` wants the connected groups only
and does not make all pairs of a group: first every entry of a key is compared
with the key's head alone, the index entry whose set has the fewest rarer
n-grams (the one that the others were copied from, if there is one). Once these
links are grouped, only pairs of different groups can still tell anything: in keys
that hold several groups, entries outside the head's group are joined with the
others. No link between groups is lost.

Nothing grows on the driver, and no key's entries are held together: keys are
counted by combined aggregates, the joins are equi joins that Spark may split.

Cases: null and empty texts have no set, no link and are their own group;
a text with fewer words than an n-gram is one n-gram of all its words; rows that
repeat an id are one document, linked by any of its texts; rows without an id
are kept and linked with nothing; pairs exactly at the threshold are linked; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize, scratch_scope
from .common import id_and_text, slices, stored
from .components import components
from .minmax import GOLD, mix, shingle_set

#: The suffix filter counts by this many leading bits of the hash.
CELL_BITS = 4


def least(percent: int, n):
    """Fewest n-grams that a linked set shares, by its own size n."""
    return -(-percent * n // 100)


def _signed(texts: DataFrame, words: int, percent: int) -> DataFrame:
    """(doc_id, n, key_hi, key_lo, firsts): size, digest and prefix by hash of every text's set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 4_000_000):
                n, hi, lo, firsts, ends = [], [], [], [], [0]
                ids = part.column("doc_id")
                for text in part.column("text").to_pylist():
                    s = shingle_set(text, words)
                    m = mix(s)
                    n.append(len(s))
                    hi.append(int(m.sum(dtype=np.uint64)))
                    lo.append(int(np.bitwise_xor.reduce(mix(m + GOLD))) if len(s) else 0)
                    firsts.append(s[:len(s) - least(percent, len(s)) + 1 + len(s) // 10])
                    ends.append(ends[-1] + len(firsts[-1]))
                signed = lambda x: pa.array(np.array(x, np.uint64).view(np.int64))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), signed(np.concatenate(firsts)))
                yield pa.RecordBatch.from_arrays([ids, pa.array(n, pa.int64()), signed(hi), signed(lo), lists], names=["doc_id", "n", "key_hi", "key_lo", "firsts"])

    return texts.mapInArrow(run, "doc_id long, n long, key_hi long, key_lo long, firsts array<long>")


def _sets(texts: DataFrame, words: int) -> DataFrame:
    """(v, n, grams): one row for each distinct set of an id; v = (id, digest)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 4_000_000):
                key, n, grams, ends = [], [], [np.zeros(0, np.uint64)], [0]
                for text in part.column("text").to_pylist():
                    s = shingle_set(text, words)
                    key.append(int(mix(s).sum(dtype=np.uint64)))
                    n.append(len(s))
                    grams.append(s)
                    ends.append(ends[-1] + len(s))
                signed = lambda x: pa.array(np.array(x, np.uint64).view(np.int64))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), signed(np.concatenate(grams)))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), signed(key), pa.array(n, pa.int64()), lists], names=["node", "key", "n", "grams"])

    made = texts.mapInArrow(run, "node long, key long, n long, grams array<long>")
    one = made.groupBy("node", "key").agg(F.first("n").alias("n"), F.first("grams").alias("grams"))
    return one.select(F.struct("node", "key").alias("v"), "n", "grams")


class Join:
    """The prepared join of a table: ``signed`` rows, ``classes`` and the ``ranked`` sets that may link."""

    def __init__(self, docs: DataFrame, words: int, percent: int, id_col: str, text_col: str):
        self.percent = percent
        texts = id_and_text(docs, id_col, text_col)
        with scratch_scope(texts.sparkSession):  # what holds the prefixes goes when the sieve is done, before whole sets are written
            signed = materialize(_signed(texts, words, percent), "join-signed")
            self.signed = materialize(signed.drop("firsts"), "join-ids", keep=True)
            full = signed.where("n > 0 and doc_id is not null")
            whole = materialize(full.groupBy("key_hi", "key_lo").agg(F.min("doc_id").alias("node"), F.first("n").alias("n"),
                                                                     F.first("firsts").alias("firsts")), "join-classes")
            self.classes = materialize(whole.select("key_hi", "key_lo", "node", "n"), "join-class-ids", keep=True)
            entries = whole.select("node", F.explode("firsts").alias("gram"))
            common = entries.groupBy("gram").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("gram")
            hits = entries.join(common, "gram").groupBy("node").agg(F.count(F.lit(1)).alias("hits"))
            enough = 1 + F.floor(self.least("n") / 10)
            left = self.classes.select("node", "n").join(hits, "node").where(F.col("hits") >= enough).select("node").distinct()
            left = materialize(left, "join-left", keep=True)
        with scratch_scope(texts.sparkSession):
            held = texts.where("doc_id is not null").join(left.select(F.col("node").alias("doc_id")), "doc_id", "left_semi")
            sets = materialize(_sets(held, words), "join-sets")
            grams = sets.select("v", "n", F.explode("grams").alias("gram"))
            counts = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("k")).where("k > 1")
            order = F.array_sort(F.collect_list(F.struct("k", "gram")))
            ranked = grams.join(counts, "gram").groupBy("v", "n").agg(F.transform(order, lambda e: e["gram"]).alias("grams"))
            ranked = ranked.where(F.size("grams") >= self.least("n"))
            self.ranked = materialize(ranked.select("v", "n", (F.col("n") - F.size("grams")).alias("alone"), "grams"), "join-ranked", keep=True)

    def least(self, n: str) -> Column:
        return F.ceil(F.col(n) * self.percent / 100.0 - 1e-9)

    def band(self, n: Column) -> Column:
        """Band of a size; sizes that allow a link are in the same or in neighbouring bands."""
        if self.percent >= 100:
            return n.cast("long")
        return F.floor(F.log(n.cast("double")) / F.lit(math.log(100 / self.percent)))

    def entries(self) -> DataFrame:
        """(gram, band, v, n, at, index): the probe entries of every set, at = rarer n-grams
        of the set; those of its index prefix are marked in its own band."""
        n, alone = F.col("n"), F.col("alone")
        probe = n - self.least("n") + 1
        short = n - F.ceil(n * 2 * self.percent / (100.0 + self.percent) - 1e-9) + 1
        bands = F.sequence(self.band(F.greatest(n * self.percent / 100.0 * (1 - 1e-9), F.lit(1.0))), self.band(n)) if self.percent < 100 else F.array(n)
        rows = self.ranked.where(probe > alone).select("v", "n", short.alias("short"), "alone", bands.alias("bands"),
                                                       F.posexplode(F.slice("grams", F.lit(1), (probe - alone).cast("int"))).alias("k", "gram"))
        rows = rows.select("v", "n", "short", (F.col("alone") + F.col("k")).alias("at"), "gram", F.explode("bands").alias("band"))
        index = (F.col("at") < F.col("short")) & (F.col("band") == self.band(F.col("n")))
        return rows.select("gram", "band", "v", "n", "at", index.alias("index"))

    def possible(self) -> Column:
        """Length and positional filter of a pair with a common n-gram (n_a, at_a, n_b, at_b)."""
        near = 100 * F.least("n_a", "n_b") >= self.percent * F.greatest("n_a", "n_b")
        rest = F.least(F.col("n_a") - F.col("at_a"), F.col("n_b") - F.col("at_b"))
        return near & ((100 + self.percent) * rest >= self.percent * (F.col("n_a") + F.col("n_b")))

    def pairs(self, found: DataFrame) -> DataFrame:
        """Distinct pairs (a, b, at_a, at_b), a < b, with their rarest common n-gram found."""
        turned = F.col("a") > F.col("b")
        pick = lambda x, y: F.when(turned, F.col(y)).otherwise(F.col(x))
        rows = found.select(pick("a", "b").alias("a"), pick("b", "a").alias("b"), F.struct(pick("at_a", "at_b").alias("at_a"), pick("at_b", "at_a").alias("at_b")).alias("at"))
        return rows.groupBy("a", "b").agg(F.min("at").alias("at")).select("a", "b", "at.at_a", "at.at_b")

    def verified(self, pairs: DataFrame) -> DataFrame:
        """(a, b, overlap, n_a, n_b) of the pairs that are links."""
        percent = self.percent

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                sets = {c: _rows(batch.column(c)) for c in ("grams_a", "grams_b")}
                numbers = [batch.column(c).to_pylist() for c in ("n_a", "n_b", "k_a", "k_b")]
                keep, overlap = [], []
                for r, (n_a, n_b, k_a, k_b) in enumerate(zip(*numbers, strict=True)):
                    wanted = -(-percent * (n_a + n_b) // (100 + percent))
                    a, b = sets["grams_a"](r), sets["grams_b"](r)
                    if may_share(a, b, k_a, k_b) >= wanted:
                        both = len(a) + len(b) - len(np.union1d(a, b))
                        if both >= wanted:
                            keep.append(r)
                            overlap.append(both)
                out = batch.select(["a", "b", "n_a", "n_b"]).take(pa.array(keep, pa.int64()))
                yield out.append_column("overlap", pa.array(overlap, pa.int64()))

        side = lambda s: self.ranked.select(F.col("v").alias(s), F.col("n").alias(f"n_{s}"), F.col("alone").alias(f"alone_{s}"), F.col("grams").alias(f"grams_{s}"))
        rows = pairs.join(side("b"), "b").join(side("a"), "a")
        rows = rows.select(F.col("a.node").alias("a"), F.col("b.node").alias("b"), "n_a", "n_b", (F.col("at_a") - F.col("alone_a")).alias("k_a"),
                           (F.col("at_b") - F.col("alone_b")).alias("k_b"), "grams_a", "grams_b")
        return rows.mapInArrow(run, "a long, b long, n_a long, n_b long, overlap long")

    def links(self) -> DataFrame:
        """Every linked pair of classes of different ids, verified once."""
        entries = stored(self.entries(), "join-entries")
        x, y = _side(entries, "a"), _side(entries.where("index"), "b")
        smaller = (F.col("n_b") < F.col("n_a")) | ((F.col("n_b") == F.col("n_a")) & (F.col("b") < F.col("a")))
        found = x.join(y, ["gram", "band"]).where((F.col("a.node") != F.col("b.node")) & smaller & self.possible())
        return self.verified(self.pairs(found))

    def repeated(self) -> DataFrame:
        """Links (a, b) of ids that have several sets with the classes of all of them."""
        full = self.signed.where("n > 0 and doc_id is not null").select("doc_id", F.struct("key_hi", "key_lo").alias("key"))
        several = stored(full.groupBy("doc_id").agg(F.min("key").alias("x"), F.max("key").alias("y")).where("x <> y").select("doc_id"), "join-repeated")
        sets = full.join(several, "doc_id").distinct().select("doc_id", "key.key_hi", "key.key_lo")
        return sets.join(self.classes, ["key_hi", "key_lo"]).select(F.col("doc_id").alias("a"), F.col("node").alias("b")).where("a <> b")

    def grouped(self) -> DataFrame:
        """(node, component) of the classes that are not the smallest of their group."""
        entries = stored(self.entries(), "join-entries")
        head = F.min(F.when(F.col("index"), F.struct("at", "n", "v"))).alias("head")
        keys = entries.groupBy("gram", "band").agg(F.count(F.lit(1)).alias("k"), head).where("k > 1 and head is not null")
        members = stored(entries.join(keys.select("gram", "band", "head"), ["gram", "band"]), "join-members")
        same = self.repeated()
        if members.isEmpty():
            return components(same)
        first = members.select(F.col("head.v").alias("a"), F.col("head.n").alias("n_a"), F.col("head.at").alias("at_a"),
                               F.col("v").alias("b"), F.col("n").alias("n_b"), F.col("at").alias("at_b"))
        first = stored(self.pairs(first.where((F.col("a.node") != F.col("b.node")) & self.possible())), "join-first")
        found = stored(self.verified(first).select("a", "b").unionByName(same).distinct(), "join-first-links")
        rest = stored(self.pairs(self.apart(members, components(found))).join(first.select("a", "b"), ["a", "b"], "left_anti"), "join-rest")
        more = self.verified(rest).select("a", "b")
        return components(found.unionByName(more))

    def apart(self, members: DataFrame, labels: DataFrame) -> DataFrame:
        """Joined entries of different groups: those outside the group of their key's head with all others."""
        of = lambda name: labels.select(F.col("node").alias("l_node"), F.col("component").alias(name))
        group = lambda v, name: F.coalesce(F.col(name), F.col(f"{v}.node"))
        placed = (members.join(of("c"), F.col("v.node") == F.col("l_node"), "left").drop("l_node")
                  .join(of("h"), F.col("head.v.node") == F.col("l_node"), "left").drop("l_node"))
        placed = placed.select("gram", "band", "v", "n", "at", "index", group("v", "c").alias("c"), (group("v", "c") != group("head.v", "h")).alias("outside"))
        mixed = placed.where("outside").select("gram", "band").distinct()
        placed = stored(placed.join(mixed, ["gram", "band"]), "join-mixed")
        smaller = (F.col("n_b") < F.col("n_a")) | ((F.col("n_b") == F.col("n_a")) & (F.col("b") < F.col("a")))
        both = None
        for probing, found in ((F.col("outside"), F.col("index")), (~F.col("outside"), F.col("index") & F.col("outside"))):
            x, y = _side(placed.where(probing), "a", "c"), _side(placed.where(found), "b", "c")
            made = x.join(y, ["gram", "band"]).where((F.col("c_a") != F.col("c_b")) & smaller & self.possible()).select("a", "b", "at_a", "at_b")
            both = made if both is None else both.unionByName(made)
        return both


def _side(entries: DataFrame, name: str, *more: str) -> DataFrame:
    return entries.select("gram", "band", F.col("v").alias(name), *(F.col(c).alias(f"{c}_{name}") for c in ("n", "at", *more)))


def _rows(lists: pa.ListArray):
    """A function from a row's number to its list, as numpy."""
    ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return lambda r: flat[ends[r]:ends[r + 1]]


def may_share(a: np.ndarray, b: np.ndarray, k_a: int, k_b: int) -> int:
    """Suffix filter: the most that two ordered sets can share, when the n-gram
    at places k_a and k_b is common. Before it, at most the shorter beginning is;
    from it on, at most the smaller part of every range of hashes."""
    cells = lambda x: np.bincount((x.view(np.uint64) >> np.uint64(64 - CELL_BITS)).astype(np.int64), minlength=1 << CELL_BITS)
    return min(k_a, k_b) + int(np.minimum(cells(a[k_a:]), cells(b[k_b:])).sum())


def links(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(a, b, n_a, n_b, overlap): every linked pair of different sets, each set by the
    smallest id that has it (see ``classes`` for the others)."""
    return Join(docs, words, percent, id_col, text_col).links().where("a <> b").distinct()


def classes(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, class_id): the smallest id with an equal set (its own without a set)."""
    j = Join(docs, words, percent, id_col, text_col)
    return _labelled(j, j.classes.withColumn("label", F.col("node"))).withColumnRenamed("component_id", "class_id")


def linked_groups(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) per row: the smallest id reachable by links."""
    j = Join(docs, words, percent, id_col, text_col)
    return _labelled(j, j.classes.join(j.grouped(), "node", "left").withColumn("label", F.coalesce("component", "node")))


def _labelled(j: Join, labels: DataFrame) -> DataFrame:
    known = j.signed.select("doc_id", "n", "key_hi", "key_lo", ((F.col("n") > 0) & F.col("doc_id").isNotNull()).alias("has"))
    out = known.join(labels.select("key_hi", "key_lo", "label", F.lit(True).alias("has")), ["key_hi", "key_lo", "has"], "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("label", "doc_id").alias("component_id"))
