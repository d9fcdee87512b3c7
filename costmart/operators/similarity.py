"""Best fuzzy match by token-set ratio, as an exact
similarity join.

Score (token-set ratio, 0..100) of texts with token sets A and B: I = A∩B,
x / y = the sorted tokens only in A / only in B joined by spaces, s = the
length of the joined I and p = 1 if s > 0. Either set empty -> 0; I not
empty and x or y empty -> 100; otherwise the largest of
``100 - 100·indel(x, y) / (2s + 2p + |x| + |y|)`` and, when s > 0,
``100 - 100·(p + |x|) / (2s + p + |x|)`` and the same with y, where
``indel = |x| + |y| - 2·LCS(x, y)``.

**Own thresholds.** Only the best choice of a name is wanted, so a name looks for
choices that reach the best score it has already, its own threshold. First every name
scores a few seeds: choices that share its rarest features, found through at most
``HEADS`` choices per feature. Then come two equi joins on features in a global
order, rarest first, each exact for pairs that reach a name's own threshold:

* token join (the two ratios on the intersection, and the 100 case): the
  tokens outside I weigh (length + 1) at most ``2δl/(1+δ)`` of a text of
  length l (δ = 1 - own threshold/100), so I meets the shortest rare-first
  token prefix heavier than that, of one side or the other.
* letter join (the LCS ratio), for names still below 100: ``e = indel <= δ(a+b)`` leaves at least
  ``(a+b)/2 + 1 - 1.5e`` common occurrence-numbered bigrams of " token " for every
  token (an unmatched character breaks two bigrams of its own text and one of the
  other), and ``(a+b-e)/2`` common characters. Two prefixes that leave out fewer features
  than that, but for K - 1, share at least K, so the join key is a set of K features:
  three or two where the prefixes are short, one elsewhere; bigrams where
  their bound is of use, else characters. The key also holds a geometric band of lengths and the
  class of the left name's threshold, which fix K on both sides.

Pairs without a common token are scored only if the characters they have in common
could reach the own threshold; where thresholds are low, those with the most common
bigrams first, which raises it for the rest. Names of one template (running numbers) meet only if they share
several of the rare bigrams that tell them apart, or if nothing better was found.

Scores are native expressions computed once per distinct candidate pair:
the LCS is the bit-parallel recurrence on 64-bit longs for texts up to 62
characters (a dynamic-programming row fold beyond), and it is skipped when
its upper bound cannot beat the intersection ratios. The best choice per
text is a partially aggregated ``min_by`` (highest score, then the lowest
choice text); the threshold is applied after it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..fixed import MATCH_THRESHOLD
from ..functions.columns import WHITESPACE_RUN
from ..session import materialize, scratch_scope

# Below every positive score: the own threshold of a name without a seed.
LEAST = 1e-6
# Choices a feature offers as seeds, and the seeds that a name scores.
HEADS, SEEDS = 4, 4
# Pairs of a name with a low own threshold that are scored before the others.
LIKELY = 12
# Own thresholds are classed by these floors.
CLASSES = (100.0, 90.0, 80.0, 67.0, 50.0, 30.0, 0.0)
# Lengths of one band differ by less than this factor.
BAND = 1.25
# At most these many features may be missing from a prefix whose key holds two, or three, of them.
MISSING = {2: 12, 3: 6}

# Slack for the pruning bounds: 1 - 0.8 is 0.19999999999999996 in binary
# floating point, and a bound must never cut a pair sitting exactly on it.
EPS = 1e-6


def token_set(c: Column | str) -> Column:
    """Sorted distinct whitespace tokens of a text."""
    col = F.col(c) if isinstance(c, str) else c
    toks = F.filter(F.split(col, WHITESPACE_RUN), lambda t: t != F.lit(""))
    return F.array_sort(F.array_distinct(toks))


def _lcs_dp_sql(x: str, y: str) -> str:
    """LCS length by the textbook dynamic program (one row folded per character of x)."""
    return f"""element_at(aggregate(
        transform(sequence(1, length({x})), i -> substr({x}, i, 1)),
        array_repeat(0, length({y}) + 1),
        (prev, ch) -> aggregate(sequence(1, length({y})), array(0),
            (acc, j) -> array_append(acc, CASE WHEN ch = substr({y}, j, 1) THEN element_at(prev, j) + 1
                                           ELSE greatest(element_at(prev, j + 1), element_at(acc, j)) END))),
        length({y}) + 1)"""


def _lcs_bits_sql(x: str, y: str) -> str:
    """LCS length by the bit-parallel recurrence ``V = (V + U) | (V - U)``, ``U = V & match(ch)``.

    One bit per character of y; kept to ``length(y)`` bits (<= 62), so the
    sum never overflows a long. LCS = the zero bits of V.
    """
    mask = f"(shiftleft(1L, length({y})) - 1L)"
    match = (f"aggregate(sequence(1, length({y})), 0L, (m, j) -> m | "
             f"CASE WHEN substr({y}, j, 1) = ch THEN shiftleft(1L, j - 1) ELSE 0L END)")
    step = f"(((v + (v & {match})) | (v - (v & {match}))) & {mask})"
    return f"""(length({y}) - bit_count(aggregate(
        transform(sequence(1, length({x})), i -> substr({x}, i, 1)), {mask}, (v, ch) -> {step})))"""


def _lcs_sql(x: str, y: str) -> str:
    return f"""(CASE WHEN length({x}) = 0 OR length({y}) = 0 THEN 0
        WHEN length({y}) <= 62 THEN {_lcs_bits_sql(x, y)}
        ELSE {_lcs_dp_sql(x, y)} END)"""


def score_pairs(df: DataFrame, a: str, b: str, out: str = "score") -> DataFrame:
    """Add the token-set ratio of the ``token_set`` array columns ``a`` and ``b``.

    Intermediate values are columns computed once per pair; the LCS runs
    only where its upper bound (LCS <= the shorter text) could beat the two
    intersection ratios.
    """
    hundred = F.lit(100.0)
    parts = df.withColumns({
        "_i": F.array_intersect(a, b), "_xa": F.array_except(a, b), "_yb": F.array_except(b, a)})
    parts = parts.withColumns({
        "_x": F.array_join("_xa", " "), "_y": F.array_join("_yb", " "),
        "_s": F.length(F.array_join("_i", " ")).cast("double")})
    parts = parts.withColumns({
        "_lx": F.length("_x").cast("double"), "_ly": F.length("_y").cast("double"),
        "_p": F.when(F.col("_s") > 0, F.lit(1.0)).otherwise(F.lit(0.0))})
    lensum = F.col("_s") * 2 + F.col("_p") * 2 + F.col("_lx") + F.col("_ly")
    sect = F.when(F.col("_s") > 0, F.greatest(
        hundred - hundred * (F.col("_p") + F.col("_lx")) / (F.col("_s") * 2 + F.col("_p") + F.col("_lx")),
        hundred - hundred * (F.col("_p") + F.col("_ly")) / (F.col("_s") * 2 + F.col("_p") + F.col("_ly")))
    ).otherwise(F.lit(0.0))
    parts = parts.withColumns({"_sect": sect, "_bound": hundred - hundred * F.abs(F.col("_lx") - F.col("_ly")) / lensum})
    whole = (F.size(a) > 0) & (F.size(b) > 0)
    contained = (F.size("_i") > 0) & ((F.size("_xa") == 0) | (F.size("_yb") == 0))
    need_lcs = whole & ~contained & (F.col("_bound") > F.col("_sect"))
    parts = parts.withColumn("_lcs", F.when(need_lcs, F.expr(_lcs_sql("_x", "_y"))).cast("double"))
    r1 = hundred - hundred * (F.col("_lx") + F.col("_ly") - F.col("_lcs") * 2) / lensum
    score = (F.when(~whole, F.lit(0.0)).when(contained, hundred)
              .when(F.col("_lcs").isNull(), F.col("_sect")).otherwise(F.greatest(r1, F.col("_sect"))))
    return parts.withColumn(out, score).drop("_i", "_xa", "_yb", "_x", "_y", "_s", "_lx", "_ly", "_p",
                                              "_sect", "_bound", "_lcs")


def _numbered(arr: Column) -> Column:
    """Tag each element with its occurrence number: ['ab', 'ab'] -> ['ab#1', 'ab#2']."""
    return F.transform(arr, lambda v, j: F.concat(v, F.lit("#"), F.size(F.filter(F.slice(arr, 1, j + 1),
                                                                                  lambda z: z == v)).cast("string")))


def _bigrams(toks: Column) -> Column:
    padded = F.transform(toks, lambda t: F.concat(F.lit(" "), t, F.lit(" ")))
    grams = F.transform(padded, lambda s: F.transform(F.sequence(F.lit(1), F.length(s) - 1),
                                                      lambda k: F.substr(s, k, F.lit(2))))
    return _numbered(F.flatten(grams))


def _chars(text: Column) -> Column:
    return _numbered(F.transform(F.sequence(F.lit(1), F.length(text)), lambda k: F.substr(text, k, F.lit(1))))


# Characters counted each for itself; all others are one.
COUNTED = "abcdefghijklmnopqrstuvwxyz0123456789 "


def _bag(text: str) -> Column:
    """How often each character occurs in an SQL text expression (``COUNTED``, then all others)."""
    counts = [f"length({text}) - length(translate({text}, '{c}', ''))" for c in COUNTED]
    return F.expr(f"array({', '.join(counts)}, length(translate({text}, '{COUNTED}', '')))")


def ranked_names(left_names: DataFrame, right_names: DataFrame) -> DataFrame:
    """Both sides' distinct names, written once: (side, name, toks, l) with their features rarest first,
    ``tok`` (f, before: the weight of the rarer tokens), ``bi`` and ``ch``, and their ``bag`` of characters."""
    base = (left_names.select(F.lit("L").alias("side"), "name").unionByName(right_names.select(F.lit("R").alias("side"), "name")).distinct()
            .withColumn("toks", token_set("name")).withColumn("l", F.length(F.array_join("toks", " "))))
    base = base.where(F.col("l") > 0)
    tagged = lambda kind, arr: F.transform(arr, lambda f: F.struct(F.lit(kind).alias("kind"), f.alias("f")))
    feats = base.select("side", "name", "toks", "l", F.explode(F.concat(tagged("tok", F.col("toks")), tagged("bi", _bigrams(F.col("toks"))),
                                                                        tagged("ch", _chars(F.array_join("toks", " "))))).alias("x")).select("side", "name", "toks", "l", "x.*")
    df = feats.groupBy("kind", "f").agg(F.count(F.lit(1)).alias("df"))
    of = lambda kind: F.transform(F.array_sort(F.collect_list(F.when(F.col("kind") == kind, F.struct("df", "f")))), lambda e: e["f"])
    ranked = feats.join(df, ["kind", "f"]).groupBy("side", "name", "toks", "l").agg(of("tok").alias("tok"), of("bi").alias("bi"), of("ch").alias("ch"))
    before = lambda i: F.aggregate(F.slice("tok", F.lit(1), i), F.lit(0), lambda acc, t: acc + F.length(t) + 1)
    ranked = ranked.withColumns({"tok": F.transform("tok", lambda t, i: F.struct(t.alias("f"), before(i).alias("before"))),
                                 "text": F.array_join("toks", " ")}).withColumn("bag", _bag("text")).drop("text")
    return materialize(ranked, "fuzzy-features")


def _delta(own: str = "own") -> Column:
    return F.lit(1.0) - F.col(own) / 100.0


def _side(names: DataFrame, side: str) -> DataFrame:
    return names.where(F.col("side") == side)


def seed_pairs(names: DataFrame) -> DataFrame:
    """At most ``SEEDS`` (lname, rname) per left name: choices that share the most weight of its
    rarest features, out of at most ``HEADS`` choices of each feature. A guess that loses nothing."""
    # a feature's weight falls with its place in the order of rarity
    tokens = F.transform("tok", lambda t, i: F.struct(F.concat(F.lit("t "), t["f"]).alias("f"), ((F.length(t["f"]) + 2) / (1 + i)).alias("w")))
    pieces = F.transform("bi", lambda g, i: F.struct(F.concat(F.lit("b "), g).alias("f"), (1 / (1 + i)).alias("w")))
    heads = _side(names, "R").select(F.col("name").alias("rname"), "l", F.explode(F.concat(tokens, pieces)).alias("x")).select("rname", "l", "x.f")
    w = Window.partitionBy("f").orderBy("l", "rname")
    heads = heads.withColumn("at", F.row_number().over(w)).where(F.col("at") <= HEADS).select("f", "rname")
    mine = _side(names, "L").select(F.col("name").alias("lname"), F.explode(F.concat(F.slice(tokens, 1, 8), F.slice(pieces, 1, 8))).alias("x")).select("lname", "x.*")
    met = mine.join(heads, "f").groupBy("lname", "rname").agg(F.sum("w").alias("w"))
    best = Window.partitionBy("lname").orderBy(F.col("w").desc(), "rname")
    return met.withColumn("at", F.row_number().over(best)).where(F.col("at") <= SEEDS).select("lname", "rname")


def _classed(own: DataFrame) -> DataFrame:
    """With ``cls``, the highest class floor that the own threshold ``own`` reaches."""
    cls = F.lit(0.0)
    for c in reversed(CLASSES):
        cls = F.when(F.col("own") >= c, F.lit(c)).otherwise(cls)
    return own.withColumn("cls", cls)


def _floor_delta(cls: Column) -> Column:
    return F.lit(1.0) - F.greatest(cls, F.lit(LEAST)) / 100.0


def token_pairs(mine: DataFrame, names: DataFrame, classes: list[float]) -> DataFrame:
    """(lname, rname) that can reach the own threshold by their common tokens."""
    budget = lambda d: 2.0 * d / (1.0 + d)
    lt = (mine.select(F.col("name").alias("lname"), "own", "cls", F.col("l").alias("la"), F.explode("tok").alias("t"))
          .select("lname", "own", "cls", "la", F.col("t.f").alias("f"), F.col("t.before").alias("lbefore")))
    rt = (_side(names, "R").select(F.col("name").alias("rname"), F.col("l").alias("lb"), F.explode("tok").alias("t"))
          .select("rname", "lb", F.col("t.f").alias("f"), F.col("t.before").alias("rbefore")))
    by_left = lt.where(F.col("lbefore") <= F.col("la") * budget(_delta()) + EPS).select("lname", "f").join(rt.select("rname", "f"), "f")
    placed = rt.withColumn("cls", F.explode(F.array(*[F.lit(c) for c in classes])))
    placed = placed.where(F.col("rbefore") <= F.col("lb") * budget(_floor_delta(F.col("cls"))) + EPS)
    by_right = lt.join(placed, ["f", "cls"]).where(F.col("rbefore") <= F.col("lb") * budget(_delta()) + EPS)
    return by_left.select("lname", "rname").unionByName(by_right.select("lname", "rname"))


def _band(length: Column) -> Column:
    return F.floor(F.log(length) / F.lit(math.log(BAND))).cast("int")


def _subsets(prefix: Column, k: Column) -> Column:
    """Hashes of all sets of k (1, 2 or 3) features of a prefix."""
    after = lambda arr, i: F.slice(arr, i + 2, F.size(arr))
    one = F.transform(prefix, lambda f: F.xxhash64(f))
    two = F.flatten(F.transform(prefix, lambda f, i: F.transform(after(prefix, i), lambda g: F.xxhash64(f, g))))
    three = F.flatten(F.flatten(F.transform(prefix, lambda f, i: F.transform(
        after(prefix, i), lambda g, j: F.transform(F.slice(prefix, i + j + 3, F.size(prefix)), lambda h: F.xxhash64(f, g, h))))))
    return F.when(k == 3, three).when(k == 2, two).otherwise(one)


def _letter_keys(rows: DataFrame, missing: Column) -> DataFrame:
    """``rows`` (l, bi, ch, cls, band, ...) with one row for each ``key``; ``missing(bigrams)`` is how
    many features of its own a name may lack in the other."""
    d = _floor_delta(F.col("cls"))
    low = F.pow(F.lit(BAND), F.col("band"))
    bigrams = F.lit(2.0) <= (1.0 - 3.0 * d) / (1.0 + d) * low + 1.0
    rows = rows.withColumns({"_bi": bigrams,
                             "_kept": F.when(bigrams, (1.0 - 3.0 * d) / (1.0 + d) * low + 1.0).otherwise((1.0 - d) / (1.0 + d) * low),
                             "_most": F.floor(low * BAND * F.when(bigrams, 4.0 * d / (1.0 + d)).otherwise(2.0 * d / (1.0 + d)) + EPS)})
    k = F.lit(1)
    for n, most in MISSING.items():
        k = F.when((F.col("_most") <= most) & (F.col("_kept") >= n), n).otherwise(k)
    rows = rows.withColumns({"_k": k, "_feats": F.when(F.col("_bi"), F.col("bi")).otherwise(F.col("ch")), "_missing": missing})
    prefix = F.slice("_feats", F.lit(1), F.greatest(F.floor(F.col("_missing") + EPS) + F.col("_k"), F.lit(0)).cast("int"))
    rows = rows.withColumn("_prefix", prefix)
    return rows.withColumn("key", F.explode(_subsets(F.col("_prefix"), F.col("_k")))).drop("bi", "ch", "_bi", "_kept", "_most", "_k", "_feats", "_missing", "_prefix")


def letter_pairs(left: DataFrame, names: DataFrame, classes: list[float], longest: int) -> DataFrame:
    """(lname, rname) that can reach the own threshold by the LCS ratio."""
    d = _delta()
    ratio = (1.0 + d) / F.greatest(1.0 - d, F.lit(1e-12))
    a = F.col("l").cast("double")
    lo, hi = _band(F.greatest(a / ratio * (1 - 1e-9), F.lit(1.0))), _band(F.least(a * ratio * (1 + 1e-9), F.lit(float(longest))))
    left = left.where(lo <= hi).select("name", "l", "own", "cls", "bi", "ch", F.explode(F.sequence(lo, hi)).alias("band"))
    b = F.greatest(F.pow(F.lit(BAND), F.col("band")) * (1 - 1e-9), a / ratio)
    lk = _letter_keys(left, F.when(F.col("_bi"), a - (0.5 - 1.5 * d) * (a + b)).otherwise(a - (1.0 - d) * (a + b) / 2.0))
    right = _side(names, "R").select("name", "l", "bi", "ch", _band(a).alias("band"), F.explode(F.array(*[F.lit(c) for c in classes])).alias("cls"))
    dc = _floor_delta(F.col("cls"))
    rk = _letter_keys(right, a * F.when(F.col("_bi"), 4.0 * dc / (1.0 + dc)).otherwise(2.0 * dc / (1.0 + dc)))
    lk = lk.select(F.col("name").alias("lname"), F.col("l").alias("la"), "own", "cls", "band", "key")
    rk = rk.select(F.col("name").alias("rname"), F.col("l").alias("lb"), "cls", "band", "key")
    met = lk.join(rk, ["cls", "band", "key"])
    near = F.abs(F.col("la") - F.col("lb")).cast("double") <= (F.col("la") + F.col("lb")) * d + EPS
    return met.where(near).select("lname", "rname")


def promising(pairs: DataFrame, mine: DataFrame, names: DataFrame) -> DataFrame:
    """(lname, rname, own, bound, shared) of the pairs that can reach the own threshold: their common
    characters bound the LCS ratio, and their common tokens the other two."""
    side = lambda s: [F.col(c).alias(f"_{c}_{s}") for c in ("l", "toks", "bi", "bag")]
    met = (pairs.join(mine.select(F.col("name").alias("lname"), "own", *side("L")), "lname")
                .join(_side(names, "R").select(F.col("name").alias("rname"), *side("R")), "rname"))
    common = F.aggregate(F.zip_with("_bag_L", "_bag_R", lambda x, y: F.least(x, y)), F.lit(0), lambda acc, n: acc + n)
    la, lb, both = F.col("_l_L"), F.col("_l_R"), F.length(F.array_join(F.array_intersect("_toks_L", "_toks_R"), " "))
    met = met.withColumn("_s", both)
    rest = F.least(la, lb) - F.col("_s") - 1  # the lesser of |x| and |y|; negative: one holds the other
    shared = F.when(F.col("_s") == 0, F.lit(0.0)).when(rest < 0, F.lit(100.0)).otherwise(200.0 * F.col("_s") / (2 * F.col("_s") + 1 + rest))
    bound = F.greatest(shared, 200.0 * common / (la + lb))
    met = met.select("lname", "rname", "own", bound.alias("bound"), "_bi_L", "_bi_R").where(F.col("bound") >= F.col("own") - EPS)
    return met.select("lname", "rname", "own", "bound", F.size(F.array_intersect("_bi_L", "_bi_R")).alias("shared"))


def _distinct(pairs: DataFrame) -> DataFrame:
    """Distinct pairs, spread by an explicit number of partitions: scoring is heavy and its input small in
    bytes, so AQE would coalesce it into very few tasks."""
    n = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return pairs.repartition(n, "lname", "rname").dropDuplicates(["lname", "rname"])


def _best(pairs: DataFrame) -> DataFrame:
    """(name, match, score) of the best-scored choice per left name, the lowest text of equal ones."""
    scored = score_pairs(pairs.withColumn("ta", token_set("lname")).withColumn("tb", token_set("rname")), "ta", "tb")
    return _better(scored.select(F.col("lname").alias("name"), F.col("rname").alias("match"), "score"))


def _better(found: DataFrame) -> DataFrame:
    pick = F.min_by(F.struct("match", "score"), F.struct((-F.col("score")).alias("neg"), F.col("match").alias("m")))
    return found.groupBy("name").agg(pick.alias("b")).select("name", "b.match", "b.score")


def _owned(names: DataFrame, best: DataFrame, least: float) -> DataFrame:
    """The left names with their best score so far as ``own``, ``least`` at the least, and its class."""
    own = _side(names, "L").join(best.select("name", "score"), "name", "left")
    return _classed(own.withColumn("own", F.greatest(F.coalesce("score", F.lit(0.0)), F.lit(least))).drop("score"))


def _matches(left_names: DataFrame, right_names: DataFrame, least: float) -> DataFrame:
    """(name, match, score): the best choice of every left name, if it reaches ``least``."""
    names = ranked_names(left_names, right_names)

    best = materialize(_best(seed_pairs(names)), "fuzzy-seeds")
    mine = _owned(names, best, least)
    facts = mine.select("cls").distinct().unionByName(_side(names, "R").agg((-F.max("l")).cast("double").alias("cls"))).collect()
    classes = sorted(r[0] for r in facts if r[0] is not None and r[0] >= 0)  # at most len(CLASSES)
    if classes:
        longest = max((int(-r[0]) for r in facts if r[0] is not None and r[0] < 0), default=1)
        letters = [c for c in classes if c < CLASSES[0]]
        pairs = token_pairs(mine, names, classes)
        if letters:
            pairs = pairs.unionByName(letter_pairs(mine.where(F.col("cls") < CLASSES[0]), names, letters, longest))
        pairs = promising(_distinct(pairs), mine, names)
        if classes[0] < CLASSES[3]:  # low thresholds admit many pairs: the likeliest first, then what can still beat them
            pairs = materialize(pairs.withColumn("at", F.row_number().over(
                Window.partitionBy("lname").orderBy(F.col("shared").desc(), F.col("bound").desc(), "rname"))), "fuzzy-pairs")
            best = materialize(_better(best.unionByName(_best(pairs.where(F.col("at") <= LIKELY)))), "fuzzy-likely")
            raised = best.select(F.col("name").alias("lname"), F.col("score").alias("_s"))
            pairs = pairs.where(F.col("at") > LIKELY).join(raised, "lname", "left").where(F.col("bound") >= F.coalesce("_s", F.lit(0.0)) - EPS)
        return materialize(_better(best.unionByName(_best(pairs.select("lname", "rname")))), "fuzzy-best", keep=True)
    return materialize(best, "fuzzy-best", keep=True)


def best_match_names(left_names: DataFrame, right_names: DataFrame,
                     threshold: float | None = MATCH_THRESHOLD) -> DataFrame:
    """``(name, match, score)`` for each distinct left name; no choice scoring >= threshold -> null.

    Without a threshold (None) every name gets its best choice; a name that
    shares no character with any choice scores 0 everywhere and gets the lowest
    text, as all ties do.
    """
    if threshold is not None and threshold <= 0:
        raise ValueError("the threshold must be positive (None: best match whatever its score)")
    least = float(threshold or LEAST)
    with scratch_scope(left_names.sparkSession):
        best = _matches(left_names, right_names, least)
    best = best.where((F.col("score") >= least) & (F.col("score") > 0))
    out = left_names.select("name").join(best, "name", "left")
    if threshold is None:
        lowest = right_names.agg(F.min("name")).first()[0]
        out = out.select("name", F.coalesce("match", F.lit(lowest).cast("string")).alias("match"),
                         F.coalesce("score", F.when(F.lit(lowest).isNotNull(), 0.0)).alias("score"))
    return out


def fuzzy_best_match(left: DataFrame, left_col: str, right: DataFrame, right_col: str,
                     threshold: float | None = MATCH_THRESHOLD, match_col: str = "match",
                     score_col: str = "match_score") -> DataFrame:
    """Every ``left`` row with its best ``right[right_col]`` by token-set ratio.

    Matching runs on distinct non-null texts only; results join back to
    the rows by text. A null text gets no match. Ties: the lowest choice.
    """
    ln = left.select(F.col(left_col).alias("name")).where(F.col("name").isNotNull()).distinct()
    rn = right.select(F.col(right_col).alias("name")).where(F.col("name").isNotNull()).distinct()
    best = best_match_names(ln, rn, threshold).select(
        F.col("name").alias("_fz_name"), F.col("match").alias(match_col), F.col("score").alias(score_col))
    return left.join(best, left[left_col] == best["_fz_name"], "left").drop("_fz_name")
