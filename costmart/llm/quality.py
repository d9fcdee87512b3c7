"""Quality rules under weak supervision, in DataFrame expressions only.

Each rule looks at one figure of a text and votes that the text is good (1) or
bad (-1), or abstains (0). How often a rule is right is not assumed:
expectation-maximisation estimates, from the votes alone, the share of good
texts and for each rule how likely each of its votes (abstaining included) is
on good and on bad texts. A text's posterior probability of being good, not an all-must-pass filter, decides.

All texts are counted by their pattern of votes; those counts, at most 3^rules
at any corpus size, are all that EM needs and all that the driver sees. The
estimates start at ``START`` and carry it as a
prior of ``PRIOR`` texts, which fixes which side is the good one.

Repeated three-word windows are found inside each row: windows are hashed to 64
bits, and where some hash occurs twice the (hash, place) pairs are sorted and
neighbours compared. Nothing is exploded or shuffled but the pattern counts.

Cases: a null text counts as empty; empty texts have no words and fail the
base rules; no rows give no rows (and EM stays at its start); ties at exactly
the threshold are kept; rows that repeat get equal verdicts; other columns,
whatever their names, are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, stored, words_of

#: Where EM starts: vote -> its probability on (good, bad) texts; kept as a prior of so many texts.
START = {1: (0.5, 0.1), 0: (0.4, 0.4), -1: (0.1, 0.5)}
PRIOR = 10.0

#: Common function words of the corpus's languages.
FUNCTION_WORDS = ("the", "of", "and", "to", "in", "is", "der", "die", "und", "das", "den", "le", "la", "les", "de", "et",
                  "el", "los", "que", "y")

#: Rules (name, numerator, denominator, "most", good up to, bad above) or
#: (…, "least", good from, bad below); None: the rule never votes good.
RULES = (
    ("symbols", "n_symbols", "n_words", "most", 0.02, 0.20),
    ("symbol_runs", "n_symbol_runs", "n_words", "most", 0.02, 0.10),
    ("function_words", "n_function_words", None, "least", 3, 2),
    ("variety", "n_distinct_words", "n_words", "least", 0.40, 0.25),
    ("duplicate_lines", "n_dup_lines", "n_lines", "most", None, 0.30),
    ("repeated_words", "n_repeat_words", "n_words", "most", None, 0.40),
    ("capitals", "n_capitals", "word_chars", "most", None, 0.40),
    ("exclamations", "n_bangs", "n_words", "most", None, 0.20),
    ("stops", "n_stops", "n_words", "least", None, 0.015),
    ("word_length", "word_chars", "n_words", "most", None, 11.0),
)


def figures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the whole numbers that the rules look at."""
    only = lambda keep: F.length(F.regexp_replace("text", f"[^{keep}]+", "")).cast("long")
    size = lambda c: F.size(c).cast("long")
    split = id_and_text(docs, id_col, text_col).withColumn("words", words_of(F.col("text")))
    words = F.col("words")
    window = F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)))
    counted = split.select(
        "doc_id", size(words).alias("n_words"), F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        only("#*$%&|<>").alias("n_symbols"), only("A-Z").alias("n_capitals"), only("!").alias("n_bangs"), only(".?").alias("n_stops"),
        F.length(F.regexp_replace(F.regexp_replace("text", "[#*$%&|<>]+", "#"), "[^#]+", "")).cast("long").alias("n_symbol_runs"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")).alias("lines"),
        size(F.array_intersect(words, F.array(*map(F.lit, FUNCTION_WORDS)))).alias("n_function_words"),
        size(F.array_distinct(words)).alias("n_distinct_words"),
        F.slice(window, 1, F.greatest(F.size(words) - 2, F.lit(0))).alias("windows"))
    windows, places = F.col("windows"), F.col("places")
    pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    twice = F.size(F.array_distinct(windows)) < F.size(windows)
    sorted_ = counted.withColumn("places", F.when(twice, pairs)).drop("windows")
    same = lambda x, y: F.coalesce(x["h"] == y["h"], F.lit(False))
    repeated = F.filter(places, lambda x, j: same(x, F.get(places, j - 1)) | same(x, F.get(places, j + 1)))
    starts = sorted_.withColumn("starts", F.sort_array(F.transform(repeated, lambda x: x["i"]))).drop("places")
    at = F.col("starts")
    covered = F.aggregate(F.transform(at, lambda a, j: F.least(F.lit(3), F.coalesce(F.get(at, j + 1) - a, F.lit(3)))),
                          F.lit(0).cast("long"), lambda s, n: s + n)
    return starts.select("doc_id", "n_words", "word_chars", "n_symbols", size("lines").alias("n_lines"),
                         (size("lines") - size(F.array_distinct("lines"))).alias("n_dup_lines"),
                         F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words"),
                         "n_symbol_runs", "n_capitals", "n_bangs", "n_stops", "n_function_words", "n_distinct_words")


def vote(rule: Sequence) -> Column:
    """1, -1 or 0. A figure without a denominator (no words, no lines) abstains."""
    name, top, bottom, kind, good, bad = rule
    n = F.col(top).cast("double")
    base = F.col(bottom).cast("double") if bottom else F.lit(1.0)
    is_bad = n > base * bad if kind == "most" else n < base * bad
    out = F.when(base <= 0, 0).when(is_bad, -1)
    if good is not None:
        out = out.when(n <= base * good if kind == "most" else n >= base * good, 1)
    return out.otherwise(0).alias(f"v_{name}")


Beliefs = dict[str, dict[int, tuple[float, float]]]


def posterior(prior: float, beliefs: Beliefs) -> Column:
    """P(good | votes); beliefs: rule -> vote -> its probability on (good, bad) texts."""
    z = F.lit(math.log(prior / (1 - prior)))
    for name, by_vote in beliefs.items():
        v = F.col(f"v_{name}")
        ratio = {x: math.log(g / b) for x, (g, b) in by_vote.items()}
        z = z + F.when(v == 1, ratio[1]).when(v == -1, ratio[-1]).otherwise(ratio[0])
    return 1 / (1 + F.exp(-z))


def estimate(patterns: list[tuple[tuple[int, ...], int]], rules: Sequence = RULES, rounds: int = 100,
             tolerance: float = 1e-9) -> tuple[float, Beliefs]:
    """EM over the counted vote patterns [(votes in the order of the rules, n)]."""
    prior, beliefs = 0.5, [dict(START) for _ in rules]
    for _ in range(rounds):
        good = 0.0
        got = [{x: [0.0, 0.0] for x in START} for _ in rules]
        for votes, n in patterns:
            z = math.log(prior / (1 - prior)) + sum(math.log(b[v][0] / b[v][1]) for v, b in zip(votes, beliefs, strict=True))
            p = 1 / (1 + math.exp(-z)) if z > -700 else 0.0
            good += n * p
            for v, g in zip(votes, got, strict=True):
                g[v][0] += n * p
                g[v][1] += n * (1 - p)
        whole = sum(n for _, n in patterns)
        mass = (good, whole - good)
        before, prior = prior, (good + PRIOR / 2) / (whole + PRIOR)
        beliefs = [{x: tuple((g[x][i] + PRIOR * START[x][i]) / (mass[i] + PRIOR) for i in (0, 1)) for x in START} for g in got]
        if abs(prior - before) < tolerance:
            break
    return prior, {r[0]: b for r, b in zip(rules, beliefs, strict=True)}


def judge(docs: DataFrame, rules: Sequence = RULES, rounds: int = 100, threshold: float = 0.5, min_words: int = 50,
          repeat_percent: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The figures, the votes, the posterior, base_failed and kept, per row."""
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words"))
    voted = stored(figures(docs, id_col, text_col).select("*", failed.alias("base_failed"), *map(vote, rules)), "quality-votes")
    votes = [f"v_{r[0]}" for r in rules]
    counted = voted.groupBy(*votes).agg(F.count(F.lit(1)).alias("n")).orderBy(*votes).collect()
    prior, beliefs = estimate([(tuple(r)[:-1], r["n"]) for r in counted], rules, rounds)
    return (voted.withColumn("posterior", posterior(prior, beliefs))
            .withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= threshold)))
