"""Language-model scores by a hashed maximum-entropy model.

Tokens are the words of a text, A-Z in lower case, and one end. Each token
belongs to a leaf: the ``HEAD`` most frequent tokens have one each, all other
words, unseen ones too, share ``SPELLINGS`` leaves by the hash of their ending.
The probability of a token is

    P(class | history) * P(leaf | class, history) * P(token | leaf)

where the first two factors are softmaxes (class-factored: ``CLASSES`` classes
of ``SUBS`` leaves) whose scores are sums of hashed weight rows for a bias, the
word before, the two words before (n-grams) and the word two before (a skip);
the last factor is the smoothed frequency within the leaf, with room for one
unseen word in each leaf.

Training is by distributed gradient updates: in each round every task walks
over its part of that round's training texts with AdaGrad steps on sparse
batches, starting from the round's common weights, and gives back the rows it
has touched; Spark adds them up by block, weighted by how often each row was
used, and the averages are the next round's weights. Each training text is in
exactly one round. The weights have a fixed size, whatever the corpus.

Counts cover all training texts and stay in Spark. Each task holds the words
above a count such that at most ``max_words`` are (a fixed bound); the other
words' counts are joined to their occurrences, combined by text before.

Cases: a null text counts as empty and consists of its end; rows with a null
id are held out as crc32 of the empty text is 0; with no training text counts
are 0 and scores follow from the smoothing alone; rows that repeat are each
scored (and each counted); an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import chain, repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, id_and_text, map_rows, stored

CLASSES = SUBS = 16
SPELLINGS = 128
HEAD = CLASSES * SUBS - SPELLINGS - 1  # one leaf is the end's
END_LEAF = HEAD
CLASS_ROWS, LEAF_ROWS = 1 << 13, 1 << 15
ROWS = CLASS_ROWS + LEAF_ROWS
FEATURES = 4
BLOCKS = 64
ADD = 0.1
END = "\n"  # no word holds a line break
GOLD = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xD6E8FEB86659FD93)


def spelling(word: bytes) -> int:
    """0..SPELLINGS-1 by the last letters, and the punctuation after them."""
    core = word.rstrip(b".,;:!?\"')]}")
    return crc32(core[-3:] + b" " + word[len(core):][:1]) % SPELLINGS


@dataclass
class Vocabulary:
    """Frequent words in order of (count, word), and what is known of the rest."""
    words: list[bytes]
    counts: np.ndarray
    ends: int
    total: int
    distinct: int
    rest_tokens: np.ndarray  # by spelling, of the words that are not frequent
    rest_words: np.ndarray

    @cached_property
    def place(self) -> dict[bytes, int]:
        return {w: i for i, w in enumerate(self.words)}

    @cached_property
    def leaf(self) -> np.ndarray:
        """By number: frequent words, then the spellings, then the end."""
        own = [i if i < HEAD else HEAD + 1 + spelling(w) for i, w in enumerate(self.words)]
        return np.array([*own, *range(HEAD + 1, HEAD + 1 + SPELLINGS), END_LEAF], np.int32)

    @cached_property
    def feature(self) -> np.ndarray:
        return _mix(np.arange(1, len(self.words) + SPELLINGS + 2, dtype=np.uint64))

    @cached_property
    def log_count(self) -> np.ndarray:
        """log10 (count + ADD); 0 for the rest, whose counts are joined."""
        return np.concatenate([np.log10(self.counts + ADD), np.zeros(SPELLINGS), [math.log10(self.ends + ADD)]])

    @cached_property
    def log_room(self) -> np.ndarray:
        """By leaf: log10 of the smoothed number of its tokens."""
        n = len(self.words)
        tokens = np.bincount(self.leaf[:n], self.counts, CLASSES * SUBS)
        kinds = np.bincount(self.leaf[:n], minlength=CLASSES * SUBS).astype(float)
        tokens[HEAD + 1:] += self.rest_tokens
        kinds[HEAD + 1:] += self.rest_words
        tokens[END_LEAF] += self.ends
        kinds[END_LEAF] += self.ends > 0
        return np.log10(tokens + ADD * (kinds + 1))

    def numbers(self, text: str) -> tuple[np.ndarray, list[bytes]]:
        """The tokens' numbers, and the words that are not frequent."""
        words, n = text.encode().lower().split(), len(self.words)
        out = np.array([*map(self.place.get, words, repeat(-1)), n + SPELLINGS], np.int32)
        other = np.flatnonzero(out < 0).tolist()
        rest = [words[i] for i in other]
        if other:
            out[other] = [n + spelling(w) for w in rest]
        return out, rest


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# ---- counts

def count_words(texts: DataFrame, held: int = 400_000) -> DataFrame:
    """(word, n) over all texts, and the number of texts as the end's."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: Counter = Counter()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                n.update(text.encode().lower().split())
                n[END.encode()] += 1
                if len(n) > held:
                    yield _rows(n)
                    n.clear()
        yield _rows(n)

    return texts.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _rows(n: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(n), pa.binary()), pa.array(list(n.values()), pa.int64())], names=["word", "n"])


def vocabulary(counts: DataFrame, max_words: int) -> tuple[Vocabulary, DataFrame]:
    """The frequent words, and the counts of the others."""
    ends = counts.where(F.col("word") == F.lit(END.encode())).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    words = counts.where(F.col("word") != F.lit(END.encode()))
    step = F.floor(F.log2("n") * 8)
    steps = words.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("kinds"), F.sum("n").alias("n")).orderBy(F.desc("step")).collect()
    least, kinds = 1 << 62, 0
    for r in steps:  # a few hundred steps of the logarithm
        kinds += r["kinds"]
        if kinds > max_words:
            break
        least = r["step"]
    frequent, rest = words.where(step >= least), words.where(step < least)
    top = frequent.toArrow()
    names, n = top.column("word").to_pylist(), top.column("n").to_numpy()
    order = sorted(range(len(names)), key=lambda i: (-n[i], names[i]))

    def spelt(cols: dict) -> dict:
        t, k = np.zeros(SPELLINGS, np.int64), np.zeros(SPELLINGS, np.int64)
        for w, c in zip(cols["text"], cols["n"], strict=True):
            s = spelling(w)
            t[s] += c
            k[s] += 1
        seen = np.flatnonzero(k)
        return {"spelling": seen.tolist(), "tokens": t[seen].tolist(), "kinds": k[seen].tolist()}

    tokens, kinds_ = np.zeros(SPELLINGS), np.zeros(SPELLINGS)
    for r in (map_rows(rest.select(F.col("word").alias("text"), "n"), spelt, "spelling int, tokens long, kinds long")
              .groupBy("spelling").agg(F.sum("tokens").alias("tokens"), F.sum("kinds").alias("kinds")).collect()):
        tokens[r["spelling"]], kinds_[r["spelling"]] = r["tokens"], r["kinds"]
    total, distinct = sum(r["n"] for r in steps) + ends, sum(r["kinds"] for r in steps) + (ends > 0)
    return Vocabulary([names[i] for i in order], n[order].astype(float), ends, total, distinct, tokens, kinds_), rest


# ---- model

def examples(docs: list[np.ndarray], v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Leaves of all tokens of some texts, and FEATURES hashes of their histories."""
    none = np.full(2, -1, np.int32)
    ids = np.concatenate([none, *chain.from_iterable((d, none) for d in docs)])
    at = np.flatnonzero(ids >= 0)
    f = np.where(ids >= 0, v.feature.take(ids, mode="clip"), np.uint64(0))
    one, two = f[at - 1], f[at - 2]
    out = np.empty((len(at), FEATURES), np.uint64)
    out[:, 0] = GOLD  # bias
    np.multiply(one, GOLD, out=out[:, 1])
    np.multiply((one * GOLD) ^ two, MIX, out=out[:, 2])
    np.multiply(two, MIX, out=out[:, 3])
    return v.leaf[ids[at]], out


def rows_of(hashes: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The weight rows of the class scores, and of the scores inside the given classes."""
    a = (hashes >> np.uint64(48)).astype(np.uint16) & np.uint16(CLASS_ROWS - 1)
    b = (hashes + (classes.astype(np.uint64)[:, None] + np.uint64(1)) * GOLD) * MIX
    return a, np.uint16(CLASS_ROWS) + ((b >> np.uint64(48)).astype(np.uint16) & np.uint16(LEAF_ROWS - 1))


def over_subs(z: np.ndarray, op: np.ufunc) -> np.ndarray:
    """``op.reduce`` of each column of (SUBS, n), in the order in which numpy adds up a row of 16 numbers."""
    z = op(z[:8], z[8:])
    while len(z) > 1:
        z = op(z[0::2], z[1::2])
    return z[0]


def log_softmax(z: np.ndarray) -> np.ndarray:
    """Of each column."""
    z -= over_subs(z, np.maximum)
    z -= np.log(over_subs(np.exp(z), np.add))
    return z


def scores(w: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """(SUBS, n): long columns, which numpy works through faster than rows of 16."""
    out = w.take(rows[:, 0], axis=0)
    for k in range(1, rows.shape[1]):
        out += w.take(rows[:, k], axis=0)
    return log_softmax(np.ascontiguousarray(out.T))


def leaf_log10(w: np.ndarray, leaves: np.ndarray, hashes: np.ndarray, block: int = 8192) -> np.ndarray:
    """log10 P(leaf | history) of each token, in sparse batches."""
    out = np.empty(len(leaves))
    for i in range(0, len(leaves), block):
        y, h = leaves[i:i + block], hashes[i:i + block]
        a, b = rows_of(h, y // SUBS)
        each = np.arange(len(y))
        out[i:i + block] = scores(w, a)[y // SUBS, each] + scores(w, b)[y % SUBS, each]
    return out / math.log(10)


class Trainer:
    """AdaGrad with one step size for each weight row."""

    def __init__(self, w: np.ndarray, rate: float):
        self.w, self.rate = w.copy(), rate
        self.squares = np.full(ROWS, 1e-2, np.float32)
        self.used = np.zeros(ROWS, np.float64)

    def step(self, leaves: np.ndarray, hashes: np.ndarray) -> None:
        each = np.arange(len(leaves))
        rows_and_targets = zip(rows_of(hashes, leaves // SUBS), (leaves // SUBS, leaves % SUBS), (slice(0, CLASS_ROWS), slice(CLASS_ROWS, ROWS)), strict=True)
        for rows, y, part in rows_and_targets:
            g = np.exp(scores(self.w, rows))
            g[y, each] -= 1
            local = rows.reshape(-1).astype(np.intp) - part.start
            n = np.bincount(local, minlength=part.stop - part.start)
            touched = np.flatnonzero(n)
            place = np.empty(len(n), np.intp)
            place[touched] = np.arange(len(touched))
            local = place[local]
            total = np.stack([np.bincount(local, x, len(touched)) for x in np.repeat(g.astype(float), FEATURES, axis=1)])
            mean = (total / np.sqrt(n[touched])).astype(np.float32)
            touched += part.start
            self.squares[touched] += over_subs(mean * mean, np.add) / np.float32(SUBS)
            self.w[touched] -= (mean * (self.rate / np.sqrt(self.squares[touched]))).T
            self.used[part] += n


def train(texts: DataFrame, v: Vocabulary, rounds: int = 2, rate: float = 0.25, batch: int = 8192, tokens_a_task: int = 1_000_000) -> np.ndarray:
    """Weights (ROWS, SUBS), after ``rounds`` rounds over disjoint parts of the texts."""
    sc = texts.sparkSession.sparkContext
    words = sc.broadcast(v)
    w = np.zeros((ROWS, SUBS), np.float32)
    part = F.pmod(F.xxhash64("text", F.lit(11)), F.lit(rounds))
    for k in range(rounds):
        now = sc.broadcast(w)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            trainer, seen = Trainer(now.value, rate), words.value
            held, size = [], 0
            for b in batches:
                for text in b.column("text").to_pylist():
                    held.append(seen.numbers(text)[0])
                    size += len(held[-1])
                    if size > 8 * batch:
                        _walk(trainer, held, seen, batch)
                        held, size = [], 0
            _walk(trainer, held, seen, batch)
            yield _blocks(trainer)

        some = texts.where(part == k).select("text")
        tasks = max(8, v.total // rounds // tokens_a_task)  # fewer, fuller tasks: each gives back a whole set of weights
        if some.rdd.getNumPartitions() > tasks:
            some = some.coalesce(int(tasks))
        form = "block int, used binary, weighted binary"
        sums = some.mapInArrow(run, form).repartition(BLOCKS, "block").mapInArrow(_add_blocks, form)
        w = _averaged(w, sums.collect())  # a fixed number of fixed-size blocks
        now.unpersist()
    return w


def _walk(trainer: Trainer, docs: list[list[int]], v: Vocabulary, batch: int) -> None:
    if docs:
        leaves, hashes = examples(docs, v)
        for i in range(0, len(leaves), batch):
            trainer.step(leaves[i:i + batch], hashes[i:i + batch])


def _blocks(trainer: Trainer) -> pa.RecordBatch:
    size = ROWS // BLOCKS
    used = [trainer.used[i * size:(i + 1) * size].astype(np.float32) for i in range(BLOCKS)]
    weighted = [(trainer.w[i * size:(i + 1) * size] * u[:, None]).astype(np.float32) for i, u in enumerate(used)]
    keep = [i for i in range(BLOCKS) if used[i].any()]
    return pa.RecordBatch.from_arrays([pa.array(keep, pa.int32()), pa.array([used[i].tobytes() for i in keep], pa.binary()),
                                       pa.array([weighted[i].tobytes() for i in keep], pa.binary())], names=["block", "used", "weighted"])


def _add_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, list[np.ndarray]] = {}
    for b in batches:
        for block, used, weighted in zip(*(b.column(c).to_pylist() for c in range(3)), strict=True):
            u, x = np.frombuffer(used, np.float32).astype(float), np.frombuffer(weighted, np.float32).astype(float)
            held = sums.setdefault(block, [np.zeros_like(u), np.zeros_like(x)])
            held[0] += u
            held[1] += x
    if sums:
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([u.tobytes() for u, _ in sums.values()], pa.binary()),
                                          pa.array([x.tobytes() for _, x in sums.values()], pa.binary())], names=["block", "used", "weighted"])


def _averaged(w: np.ndarray, blocks: list) -> np.ndarray:
    w, size = w.copy(), ROWS // BLOCKS
    for r in blocks:
        used, total = np.frombuffer(bytes(r["used"])), np.frombuffer(bytes(r["weighted"])).reshape(size, SUBS)
        at = r["block"] * size + np.flatnonzero(used)
        w[at] = (total[used > 0] / used[used > 0][:, None]).astype(np.float32)
    return w


# ---- scores

def score(docs: DataFrame, folds: int = 10, max_words: int = 1 << 18, rounds: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) per row."""
    texts = id_and_text(docs, id_col, text_col)
    learn = texts.where(fold(F.col("doc_id"), folds) != 0)
    counts = stored(count_words(learn), "maxent-counts")
    v, rest_counts = vocabulary(counts, max_words)
    w = train(learn, v, rounds)
    sc = docs.sparkSession.sparkContext
    words, weights = sc.broadcast(v), sc.broadcast(w)

    def run(cols: dict) -> dict:
        seen = words.value
        out: dict[str, list] = {"doc_id": cols["doc_id"], "n_tokens": [], "known": [], "logs": [], "model": [], "rest": []}
        numbered = [seen.numbers(text) for text in cols["text"]]
        leaves, hashes = examples([ids for ids, _ in numbered], seen)
        per_token = leaf_log10(weights.value, leaves, hashes) - seen.log_room[leaves]
        at = 0
        for ids, rest in numbered:
            out["n_tokens"].append(len(ids))
            out["known"].append(len(ids) - 1 - len(rest) + (seen.ends > 0))
            out["logs"].append(float(seen.log_count[ids].sum()))
            out["model"].append(float(per_token[at:at + len(ids)].sum()))
            at += len(ids)
            out["rest"].append(list(Counter(rest).items()))
        return out

    seen = stored(map_rows(texts, run, "doc_id long, n_tokens long, known long, logs double, model double, rest array<struct<word:binary,m:long>>", 1_000_000)
                  .withColumn("row_id", F.monotonically_increasing_id()), "maxent-seen")
    rest = seen.select("row_id", F.explode("rest").alias("r")).select("row_id", "r.word", "r.m")
    joined = rest.join(rest_counts, "word", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    sums = joined.groupBy("row_id").agg(F.sum(F.col("m") * F.log10(F.col("n") + ADD)).alias("more"),
                                        F.sum(F.when(F.col("n") > 0, F.col("m")).otherwise(0)).alias("more_known"))
    whole = seen.drop("rest").join(sums, "row_id", "left")
    logs = F.col("logs") + F.coalesce("more", F.lit(0.0))
    return whole.select("doc_id", (fold(F.col("doc_id"), folds) == 0).alias("held_out"), "n_tokens",
                        (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"), F.lit(v.total).cast("long").alias("train_tokens"),
                        (logs - F.col("n_tokens") * math.log10(v.total + ADD * (v.distinct + 1))).alias("base_score"),
                        (logs + F.col("model")).alias("score"))
