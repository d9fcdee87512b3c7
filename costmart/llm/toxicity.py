"""Toxicity by noisy-channel deobfuscation.

A character language model (4-grams over a-z, a word boundary and one symbol
for all other letters) is counted over every document. A word that looks
written around a filter (leetspeak, inner separators, doubled or repeated
letters), and every run of tokens of up to ``SHORT`` characters (letters spelt
out, words split in pieces; a piece of more characters is not joined), becomes a lattice of what its characters may stand for,
each with a channel cost, and a Viterbi search under the language model picks
the restored text; in a run a word may end between any two characters. A word or
run may lack letters if it holds signs for them (``@$$``, ``4$$``, ``@ $ $``); digits alone are
a number. Words without such signs restore to themselves.

The score looks at restored words and their beginnings (so inflected forms
count): weights are lower confidence bounds of the log odds between toxic and
clean labelled documents, and a logistic function of the largest weight, the
sum of weights and that sum for the text's length gives the probability. It is fitted on weights
learnt from the other half of the training rows.

Labels are read only where crc32(doc_id as text) mod ``folds`` is not 0, from
at most ``max_labels`` such rows (the ones with the lowest hash of the id): a
bounded sample, so the lexicon on the driver is bounded too. The language
model's table has 28^4 entries at any corpus size. Whole texts are scored.

Cases: null and empty texts get the score of a text without any evidence; null
labels or ids teach nothing; of repeated labels of an id the highest counts;
without labels of both classes every score is 0.0; rows that
repeat are each scored; an empty table gives an empty result; other columns are
kept by ``reject`` and may have any names.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property, lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fold, held, id_and_text, let_go, map_rows

#: What a character may stand for besides itself.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
        "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l"}
#: Separators that may stand for a letter too.
MAYBE = {"#": "h"}
#: Channel costs in nats.
STANDS_FOR, DROP_DIGIT, DROP_LEET, DROP_OTHER, BREAK, HALVE, FROM_MANY = 0.7, 6.0, 5.0, 0.5, 4.0, 2.0, 0.7

SYMBOLS = 28  # 0 word boundary, 1..26 a..z, 27 any other letter
ORDER = 4
EDGE = ".,;:!?\"'()[]{}<>…“”‘’«»"
NOISY = re.compile(r"(?=.*[^\W\d_])(?:.*[0-9@$!|+€£*#%&~^=/\\.\-_]|.*(.)\1)", re.S)
#: A word without letters is leetspeak if it holds signs for letters, digits alone are a number.
LETTERLESS = re.compile(r"(?=.*[@$!|+€£])[0-9@$!|+€£*#%&~^=/\\.\-_]{2,}\Z", re.S)
SIGNS = frozenset("@$!|€£")
SHORT = 3
MEMO = 100_000  # words in each half of what a worker remembers, which stays with it between tasks
PREFIXES = (4, 5, 6)


# ---- character language model

def _code_table() -> np.ndarray:
    code = np.zeros(256, np.int64)
    for c in range(26):
        code[97 + c] = code[65 + c] = 1 + c
    code[128:] = SYMBOLS - 1
    return code


def gram_counts(text: bytes) -> np.ndarray:
    code = _code_table()[np.frombuffer(b"  " + text + b"  ", np.uint8)]
    follows = code[1:] == code[:-1]
    code = code[1:][~(follows & ((code[1:] == 0) | (code[1:] == SYMBOLS - 1)))]  # one boundary, one symbol for the bytes of a letter
    code = np.concatenate([[0, 0], code])
    grams = code[:-3]
    for k in range(1, ORDER):
        grams = grams * SYMBOLS + code[k:len(code) - 3 + k]
    return np.bincount(grams, minlength=SYMBOLS ** ORDER)


def count_grams(texts: DataFrame) -> np.ndarray:
    """4-gram counts of all texts; what comes to the driver has a fixed size."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        total = np.zeros(SYMBOLS ** ORDER, np.int64)
        for b in batches:
            some, size = [], 0
            for t in b.column("text").to_pylist():
                some.append(t.encode())
                size += len(some[-1])
                if size > 1 << 21:
                    total += gram_counts(b"\n\n".join(some))
                    some, size = [], 0
            total += gram_counts(b"\n\n".join(some))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int64)), pa.array(total[seen])], names=["gram", "n"])

    rows = texts.select("text").mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(SYMBOLS ** ORDER, np.int64)
    counts[rows.column("gram").to_numpy()] = rows.column("n").to_numpy()
    return counts


def log_probabilities(counts: np.ndarray) -> np.ndarray:
    """log p(symbol | three before), interpolated down to the uniform distribution."""
    p = np.full(SYMBOLS, 1 / SYMBOLS)
    for order in range(1, ORDER + 1):
        c = counts.reshape(SYMBOLS ** (ORDER - order), SYMBOLS ** (order - 1), SYMBOLS).sum(0).astype(float)
        kinds, n = (c > 0).sum(1, keepdims=True), c.sum(1, keepdims=True)
        lower = np.tile(p.reshape(-1, SYMBOLS), (c.shape[0] // p.reshape(-1, SYMBOLS).shape[0], 1))
        p = np.where(n > 0, (c + kinds * lower) / np.maximum(n + kinds, 1), lower)
    return np.log(np.maximum(p, 1e-9)).reshape(-1)


# ---- lattice and search

def noisy(word: str) -> bool:
    return bool(NOISY.match(word) or not word[:1].isalpha() and LETTERLESS.match(word))


def symbol(c: str) -> int:
    return ord(c) - 96 if "a" <= c <= "z" else (SYMBOLS - 1 if c.isalpha() else 0)


#: (text, cost, symbols of the text)
Option = tuple[str, float, tuple[int, ...]]


def option(text: str, cost: float) -> Option:
    return text, cost, tuple(symbol(c) for c in text)


INSIDE, BETWEEN = (option("", 0.0), option(" ", BREAK)), (option(" ", 0.0), option("", DROP_OTHER))


@lru_cache(1 << 16)
def options(c: str, n: int, lettered: bool = True) -> tuple[Option, ...]:
    """What a run of n (3: more) equal characters may stand for. Beside letters, a
    repeated sign is likelier mere ornament than in a word without any."""
    if c in LEET:
        out = [option("", (DROP_DIGIT if c.isdigit() else DROP_LEET) if n == 1 or not lettered else DROP_OTHER * 2)]
        for letter in LEET[c]:
            out.append(option(letter, STANDS_FOR + (n > 1) * FROM_MANY))
            if n > 1:
                out.append(option(letter * 2, STANDS_FOR))
        return tuple(out)
    if c.isalpha():
        return ((option(c, 0.0),) if n == 1 else (option(c * 2, 0.0), option(c, HALVE)) if n == 2
                else (option(c, FROM_MANY), option(c * 2, FROM_MANY)))
    return option("", DROP_OTHER), option(" ", BREAK), *(option(x, STANDS_FOR) for x in MAYBE.get(c, ""))


def lattice(word: str) -> list[tuple[Option, ...]]:
    """For each run of equal characters what it may stand for, with its cost."""
    out, i, end = [], 0, len(word)
    lettered = any(map(str.isalpha, word))
    while i < end:
        c, j = word[i], i + 1
        while j < end and word[j] == c:
            j += 1
        out.append(options(c, min(j - i, 3), lettered))
        i = j
    return out


@lru_cache(1 << 14)
def token_lattice(token: str) -> tuple[tuple[Option, ...], ...]:
    """The token's lattice with an optional break between any two characters."""
    return tuple(chain.from_iterable((INSIDE, slot) for slot in lattice(token)))[1:]


def run_lattice(tokens: list[str]) -> list[tuple[Option, ...]]:
    """The tokens' lattices, which breaks may part or not."""
    out: list[tuple[Option, ...]] = []
    for token in tokens:
        if out:
            out.append(BETWEEN)
        out += token_lattice(token)
    return out


def viterbi(slots: list[tuple[Option, ...]], logp) -> str:
    cut = SYMBOLS ** 3
    best: dict[int, tuple[float, tuple]] = {0: (0.0, ())}
    i, end = 0, len(slots)
    while i < end:
        slot = slots[i]
        i += 1
        after: dict[int, tuple[float, tuple]] = {}
        if len(slot) == 1:  # a letter that stands for itself: states stay apart or the better one stays
            (text, cost, (c,)), = slot
            if len(best) == 1:  # one state: the letters up to the next choice are one step
                (state, (score, path)), = best.items()
                k = state * SYMBOLS + c
                score = score - cost + logp[k]
                while i < end and len(slots[i]) == 1:
                    (letter, cost, (c,)), = slots[i]
                    i += 1
                    k = k % cut * SYMBOLS + c
                    score = score - cost + logp[k]
                    text += letter
                best = {k % cut: (score, (path, text))}
                continue
            for state, (score, path) in best.items():
                k = state * SYMBOLS + c
                s, total = k % cut, score - cost + logp[k]
                if s not in after or total > after[s][0]:
                    after[s] = (total, (path, text))
        elif i < end and len(slots[i]) == 1 and (slot is INSIDE or slot is BETWEEN):  # most of a run: one step with the letter
            gap, joint = (BREAK, 0.0) if slot is INSIDE else (0.0, DROP_OTHER)
            (text, cost, (c,)), = slots[i]
            i += 1
            spaced = " " + text
            for state, (score, path) in best.items():
                space = state * SYMBOLS
                k = space + c
                s, total = k % cut, score - joint - cost + logp[k]
                if s not in after or total > after[s][0]:
                    after[s] = (total, (path, text))
                k = space % cut * SYMBOLS + c
                s, total = k % cut, score - gap + logp[space] - cost + logp[k]
                if s not in after or total > after[s][0]:
                    after[s] = (total, (path, spaced))
        else:
            for state, (score, path) in best.items():
                for text, cost, codes in slot:
                    s, total = state, score - cost
                    for c in codes:
                        k = s * SYMBOLS + c
                        total += logp[k]
                        s = k % cut
                    held = after.get(s)
                    if held is None or total > held[0]:
                        after[s] = (total, (path, text) if text else path)
        best = after
    found = max(best.items(), key=lambda kv: (kv[1][0] + logp[kv[0] * SYMBOLS], kv[0]))[1][1]
    parts = []
    while found:
        found, text = found
        parts.append(text)
    return "".join(reversed(parts))


class Decoder:
    """Restores words; remembers short ones (a fixed number of them)."""

    def __init__(self, logp: np.ndarray):
        self.logp = memoryview(np.ascontiguousarray(logp))
        self.memo: dict[str, list[str]] = {}
        self.old: dict[str, list[str]] = {}
        self.plain: set[str] = set()  # short words known not to be noisy

    def keep(self, word: str, found: list[str]) -> None:
        """Remember; when the young half is full it becomes the old one, and what is still used is taken over."""
        if len(self.memo) >= MEMO:
            self.old, self.memo = self.memo, {}
        self.memo[word] = found

    def restore(self, word: str) -> list[str]:
        """The words that a noisy word, or a run of tokens with a space between, stands for."""
        found = self.memo.get(word)
        if found is None and (found := self.old.get(word)) is not None:
            self.keep(word, found)
        if found is None:
            found = viterbi(run_lattice(word.split(" ")) if " " in word else lattice(word), self.logp).split()
            if len(word) <= 64:
                self.keep(word, found)
        return found

    def words(self, text: str) -> set[str]:
        """The distinct words of a text, cleaned, with the restored forms of noisy ones."""
        raw = text.lower().split()
        cores = {w: w.strip(EDGE) for w in set(raw)}
        words = set(cores.values())
        for w in words - self.plain:
            if w in self.memo or w in self.old or noisy(w):
                words.update(self.restore(w))
            elif len(w) <= 64:
                self.plain.add(w)
        if len(self.plain) > MEMO:
            self.plain.clear()
        for _, _, run in _runs(raw, cores):
            words.update(self.restore(run))
        words.discard("")
        return words

    def restored(self, text: str) -> str:
        """The text with noisy words replaced, for readers of the result."""
        raw, out, at = text.lower().split(), [], 0
        one = lambda w: self.restore(c) if (c := w.strip(EDGE)) and noisy(c) else [w]
        for i, j, run in [*_runs(raw, {w: w.strip(EDGE) for w in set(raw)}), (len(raw), len(raw), "")]:
            for w in raw[at:i]:
                out += one(w)
            if run:
                # a run read as its own tokens keeps their punctuation
                out += [x for w in raw[i:j] for x in one(w)] if (found := self.restore(run)) == run.split() else found
            at = j
        return " ".join(out)


def _runs(raw: list[str], cores: dict[str, str]) -> Iterator[tuple[int, int, str]]:
    """(from, to, tokens without punctuation at their ends) of two or more short tokens that may be letters."""
    short = {w: c or w for w, c in cores.items() if len(c or w) <= SHORT}
    held: list[str] = []
    for i, c in enumerate(chain(map(short.get, raw), (None,))):
        if c is not None:
            held.append(c)
        elif held:
            if len(held) > 1 and _spelt(held):
                yield i - len(held), i, " ".join(held)
            held = []


def _spelt(tokens: list[str]) -> bool:
    """Two tokens that hold a letter or a sign for one, or one letter among three or more single characters."""
    n = 0
    for t in tokens:
        if t.isalpha() or not SIGNS.isdisjoint(t) or any(map(str.isalpha, t)):
            n += 1
            if n > 1:
                return True
    return len(tokens) > 2 and all(len(t) == 1 for t in tokens) and any(map(str.isalpha, tokens))


def features(words: set[str]) -> set[str]:
    out = {"=" + w for w in words}
    for n in PREFIXES:
        out |= {w[:n] + "~" for w in words if len(w) > n}
    return out


# ---- model

@dataclass
class Model:
    logp: np.ndarray
    weights: dict[str, float] = field(default_factory=dict)
    coefficients: tuple[float, ...] = (-math.inf, *[0.0] * 4)

    @cached_property
    def lexicon(self) -> tuple[set[str], list[tuple[int, set[str]]]]:
        """Whole words and, by length, beginnings that have a weight."""
        return {f[1:] for f in self.weights if f[:1] == "="}, [(n, {f[:n] for f in self.weights if len(f) == n + 1 and f[n] == "~"}) for n in PREFIXES]

    def weighted(self, words: set[str]) -> list[str]:
        """``features(words)`` that have a weight, in order."""
        whole, beginnings = self.lexicon
        found = {"=" + w for w in words & whole}
        for n, known in beginnings:
            found.update(b + "~" for b in known.intersection([w[:n] for w in words if len(w) > n]))
        return sorted(found)

    def evidence(self, words: set[str]) -> tuple[float, ...]:
        """Largest weight, its square, the sum of weights, and that in relation to the text's length."""
        hits = [self.weights[f] for f in self.weighted(words)]
        if not hits:
            return (0.0,) * 4
        top, total = max(hits), sum(hits)
        return top, top * top / 10, math.log1p(total), total / math.sqrt(len(words))

    def score(self, words: set[str]) -> float:
        z = self.coefficients[0] + sum(b * x for b, x in zip(self.coefficients[1:], self.evidence(words), strict=True))
        return 1 / (1 + math.exp(-z)) if z > -700 else 0.0


def weigh(n1: int, n0: int, all1: int, all0: int) -> float:
    """Lower confidence bound of a feature's log odds of being in toxic texts."""
    odds = math.log((n1 + 0.5) / (all1 + 1)) - math.log((n0 + 0.5) / (all0 + 1))
    return odds - 1.64 * math.sqrt(1 / (n1 + 0.5) + 1 / (n0 + 0.5))


def logistic(x: np.ndarray, y: np.ndarray, steps: int = 50, ridge: float = 1e-2) -> np.ndarray:
    """Newton's method on a few columns."""
    x = np.column_stack([np.ones(len(x)), x])
    b = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + ridge * np.eye(len(b)), x.T @ (y - p) - ridge * b)
        b += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return b


def train(docs: DataFrame, labels: DataFrame, folds: int = 5, max_labels: int = 20_000, min_support: int = 3,
          min_weight: float = 1.0, id_col: str = "doc_id", text_col: str = "text") -> Model:
    spark = docs.sparkSession
    texts = id_and_text(docs, id_col, text_col)
    model = Model(log_probabilities(count_grams(texts)))
    known = (labels.select(F.col(id_col).cast("long").alias("l_id"), F.col("toxic").cast("int").alias("y"))
             .where("l_id is not null and y is not null").where(fold(F.col("l_id"), folds) != 0)
             .groupBy("l_id").agg(F.max("y").alias("y"))
             .orderBy(F.xxhash64("l_id"), "l_id").limit(max_labels))
    sample = texts.join(F.broadcast(known), F.col("doc_id") == F.col("l_id")).select(  # at most max_labels ids
        "text", "y", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(2)).cast("int").alias("half"))
    logp = spark.sparkContext.broadcast(model.logp)

    def count(cols: dict) -> dict:
        decoder, n = _decoder(logp), [Counter() for _ in range(4)]
        for text, y, half in zip(cols["text"], cols["y"], cols["half"], strict=True):
            n[half * 2 + (y > 0)].update(features(decoder.words(text)) | {""})
        names = list(set().union(*n))
        return {"feature": names} | {f"n{i}": [c[f] for f in names] for i, c in enumerate(n)}

    counts = (map_rows(sample, count, "feature string, n0 long, n1 long, n2 long, n3 long", keeps=True).groupBy("feature")
              .agg(*(F.sum(f"n{i}").alias(f"n{i}") for i in range(4))).where(F.expr("n1 + n3") >= min_support))
    rows = {r["feature"]: tuple(r)[1:] for r in counts.collect()}
    totals = rows.pop("", (0, 0, 0, 0))
    if totals[0] + totals[2] == 0 or totals[1] + totals[3] == 0:
        return model
    keep = lambda pick: {f: w for f, n in rows.items() if pick(n)[0] >= min_support and (w := weigh(*pick(n), *pick(totals))) >= min_weight}
    model.weights = keep(lambda n: (n[1] + n[3], n[0] + n[2]))
    other = [Model(model.logp, keep(lambda n: (n[3], n[2]))), Model(model.logp, keep(lambda n: (n[1], n[0])))]
    lexicons = spark.sparkContext.broadcast([m.weights for m in other])

    def judge(cols: dict) -> dict:
        decoder, models = _decoder(logp), [Model(logp.value, w) for w in lexicons.value]
        seen = [models[half].evidence(decoder.words(text)) for text, half in zip(cols["text"], cols["half"], strict=True)]
        return {"y": cols["y"]} | {f"x{i}": [s[i] for s in seen] for i in range(4)}

    judged = map_rows(sample, judge, "y int, x0 double, x1 double, x2 double, x3 double", keeps=True).toArrow()
    x = np.column_stack([judged.column(f"x{i}").to_numpy() for i in range(4)])
    y = (judged.column("y").to_numpy() > 0).astype(float)
    order = np.lexsort((*x.T, y))  # the sum of floats must not depend on the order of rows
    model.coefficients = tuple(map(float, logistic(x[order], y[order])))
    return model


def _decoder(logp: Broadcast) -> Decoder:
    """This worker's, which holds the table itself: no other can have its id."""
    return held(("toxicity", id(logp.value)), lambda: Decoder(logp.value))


def scorer(spark: SparkSession, model: Model):
    """A function of a text column that gives its score."""
    sc = spark.sparkContext
    logp, rest = sc.broadcast(model.logp), sc.broadcast((model.weights, model.coefficients))

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        decoder, judge = _decoder(logp), Model(logp.value, *rest.value)
        return pa.array([judge.score(decoder.words(t)) for t in texts.to_pylist()], pa.float64())

    return lambda text: score(F.coalesce(text.cast("string"), F.lit("")))


def reject(docs: DataFrame, model: Model, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """``docs``, all columns, without the rows whose text scores the threshold or more."""
    return docs.where(scorer(docs.sparkSession, model)(F.col(f"`{text_col}`")) < threshold)
