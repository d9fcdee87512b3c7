"""The best-match join against brute force, and how many pairs it scores."""

import random

import pytest

from costmart.operators import similarity as SIM

from .test_properties import py_ratio

SYLLABLES = "am ox i cil lin pro pran o lol sta tin met for min a ce ta mol ibu fen na xen di clo ze pam ri vi ra".split()


def brute(left, right, threshold):
    out = {}
    for a in left:
        score, match = max(((py_ratio(a, b), b) for b in right), key=lambda t: (t[0], [-ord(c) for c in t[1]], -len(t[1])))
        lowest = min(b for b in right if py_ratio(a, b) == score)
        out[a] = (lowest, round(score, 9)) if score >= (threshold or 0) else None
    return out


def matched(spark, monkeypatch, left, right, threshold):
    """Matches by name, and the number of scored pairs."""
    scored = []
    monkeypatch.setattr(SIM, "score_pairs", lambda df, *a, f=SIM.score_pairs: (scored.append(df.count()), f(df, *a))[1])
    ldf, rdf = (spark.createDataFrame([(n,) for n in names], "name string") for names in (left, right))
    got = {r.name: (r.match, round(r.score, 9)) if r.match is not None else None for r in SIM.best_match_names(ldf, rdf, threshold).collect()}
    return got, sum(scored)


def drugs(seed, n, tail):
    r = random.Random(seed)
    return sorted({"".join(r.choice(SYLLABLES) for _ in range(r.randint(2, 4))) + tail(r) for _ in range(n)})


def test_without_a_threshold_few_pairs_are_scored(spark, monkeypatch):
    """Names out of common syllables, some with no choice above 50."""
    left = drugs(1, 150, lambda r: f" {r.randint(5, 500)} mg")
    right = drugs(2, 150, lambda r: " " + r.choice(["tab", "ml", "cap"]))
    got, scored = matched(spark, monkeypatch, left, right, None)
    assert got == brute(left, right, None)
    assert any(v[1] < 50 for v in got.values()) and scored <= 0.16 * len(left) * len(right)  # 0.09 at 300 x 300


@pytest.mark.parametrize("threshold", [80.0, 60.0])
def test_drug_names_with_a_threshold(spark, monkeypatch, threshold):
    left = drugs(3, 120, lambda r: r.choice(["", " tab", " 5 mg"]))
    right = drugs(4, 120, lambda r: r.choice(["", " tab", " tablet"])) + left[::7]
    got, _ = matched(spark, monkeypatch, left, sorted(set(right)), threshold)
    assert got == brute(left, sorted(set(right)), threshold)


def test_names_of_one_template_equal_brute_force(spark, monkeypatch):
    numbers = random.Random(5).sample(range(100_000), 70)
    left, right = [f"item {i:05d} tab" for i in numbers[:50]], [f"item {i:05d} tablet" for i in numbers[20:]]
    got, _ = matched(spark, monkeypatch, left, right, 80.0)
    assert got == brute(left, right, 80.0)


def test_names_of_one_template_meet_in_linear_numbers(spark, monkeypatch):
    scored = {}
    for n in (500, 2000):
        got, scored[n] = matched(spark, monkeypatch, [f"item {i:05d} tab" for i in range(n)], [f"item {i:05d} tablet" for i in range(n)], 80.0)
        assert all(match.split()[1] == name.split()[1] for name, (match, _) in got.items())
    assert scored[2000] <= 12 * 2000 and scored[2000] <= 6 * scored[500]


def test_long_names_and_repeated_letters(spark, monkeypatch):
    r = random.Random(6)
    left = ["a" * 90, "ab " * 20, "x" + "y" * 70 + " z", "one two three four five six seven eight nine ten", "é漢 ß", "A b"]
    right = ["a" * 80 + " b", "ab", "y" * 75, "one two three four five six seven eight nine tan", "é漢 ss", "a B", "".join(r.choice("abc ") for _ in range(120)).strip()]
    for threshold in (None, 80.0):
        got, _ = matched(spark, monkeypatch, left, right, threshold)
        assert got == brute(left, right, threshold)
        monkeypatch.undo()


def test_empty_sides(spark):
    none, some = spark.createDataFrame([], "name string"), spark.createDataFrame([("a",), ("",)], "name string")
    assert SIM.best_match_names(none, some).count() == 0
    for threshold in (None, 80.0):
        assert [(r.match, r.score) for r in SIM.best_match_names(some, none, threshold).collect()] == [(None, None)] * 2
