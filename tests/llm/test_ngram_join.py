import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from costmart.llm import ngram_join

from .conftest import LONG


def words_of(text):
    lower = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return re.findall("[^\x20\x09-\x0d]+", lower)


def grams(text, words):
    w = words_of(text)
    return {tuple(w[i:i + words]) for i in range(max(1, len(w) - words + 1))} if w else set()


def linked(a, b, percent):
    return 100 * len(a & b) >= percent * len(a | b)


def brute_groups(rows, words, percent):
    """Sorted (doc_id, n, smallest id reachable), rows without an id linked with nothing."""
    sets = [(i, grams(t, words)) for i, t in rows]
    root = {i: i for i, _ in rows if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    full = [(i, s) for i, s in sets if s and i is not None]
    for x, (i, s) in enumerate(full):
        for j, t in full[:x]:
            if linked(s, t, percent):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return sorted(((i, len(s), None if i is None else find(i) if s else i) for i, s in sets), key=repr)


def brute_links(rows, words, percent):
    least = {}
    for i, t in rows:
        s = frozenset(grams(t, words))
        if s and i is not None:
            least[s] = min(i, least.get(s, i))
    out = set()
    for s, i in least.items():
        for t, j in least.items():
            if i < j and linked(s, t, percent):
                out.add((i, j, len(s), len(t), len(s & t)))
    return sorted(out)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def corpus(seed, n=60):
    """Texts with copies edited in several places, a shared passage, and many texts of few words."""
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(40)]
    passage = [r.choice(vocabulary) for _ in range(30)]
    bases = [[r.choice(vocabulary) for _ in range(r.randint(1, 80))] for _ in range(n // 4)]
    rows = []
    for i in range(n):
        w = list(r.choice(bases))
        for _ in range(r.choice([0, 0, 1, 1, 2, 4])):
            at = r.randrange(len(w))
            w[at:at + r.randint(0, 2)] = [r.choice(vocabulary) for _ in range(r.randint(0, 2))]
            w = w or ["w0"]
        if r.random() < 0.3:
            w += passage
        rows.append((i, " ".join(w).upper() if r.random() < 0.2 else " ".join(w)))
    return rows


@pytest.mark.parametrize(("seed", "words", "percent"), [(1, 5, 80), (2, 2, 80), (3, 1, 50), (4, 3, 95), (5, 2, 100), (6, 1, 30)])
def test_groups_and_links_equal_brute_force(make_docs, seed, words, percent):
    rows = corpus(seed)
    docs = make_docs(rows)
    assert found(ngram_join.linked_groups(docs, words, percent)) == brute_groups(rows, words, percent)
    made = [(min(a, b), max(a, b), *((n, m) if a < b else (m, n)), o) for a, b, n, m, o in found(ngram_join.links(docs, words, percent))]
    assert sorted(made) == brute_links(rows, words, percent)


def test_odd_rows(make_docs, odd):
    rows = odd + [(11, "the SAME few words here today"), (12, "the same\tfew words here TODAY"), (12, "another text of this very id")]
    assert found(ngram_join.linked_groups(make_docs(rows))) == brute_groups(rows, 5, 80)


def test_repeated_id_is_linked_by_any_of_its_texts(make_docs):
    one, two = "a b c d e f g h i j k l", "m n o p q r s t u v w x"
    rows = [(5, one), (5, two), (7, one), (3, two + " y"), (9, "z " + one)]
    assert found(ngram_join.linked_groups(make_docs(rows), 2, 80)) == brute_groups(rows, 2, 80)


@pytest.mark.parametrize("rows", [[], [(1, None), (2, ""), (None, None)], [(1, "only one text here to see")]])
def test_nothing_to_link(make_docs, rows):
    docs = make_docs(rows)
    assert found(ngram_join.linked_groups(docs)) == brute_groups(rows, 5, 80)
    assert ngram_join.links(docs).count() == 0


def test_hot_groups_do_not_become_all_pairs(make_docs, monkeypatch):
    """A third of the rows copies of one text with one word changed each, another third one text."""
    r = random.Random(8)
    base = [f"b{i}" for i in range(100)]
    rows = [(i, " ".join(r.choice([f"x{i}"]) if k == i % 97 else w for k, w in enumerate(base))) for i in range(300)]
    rows += [(1000 + i, "one text that very many documents hold in full") for i in range(300)]
    rows += [(2000 + i, " ".join(f"u{i}.{k}" for k in range(30))) for i in range(300)]
    rows.append((5000, " ".join(base)))
    seen = []
    verified = ngram_join.Join.verified
    monkeypatch.setattr(ngram_join.Join, "verified", lambda self, pairs: (seen.append(pairs.count()), verified(self, pairs))[1])
    out = found(ngram_join.linked_groups(make_docs(rows), 2, 80))
    assert sum(seen) <= 4 * 300
    assert {(i, c) for i, _, c in out} == {(i, 0 if i < 300 or i == 5000 else 1000 if i < 2000 else i) for i, _ in rows}


def test_very_long_texts(make_docs):
    text = " ".join(f"w{i}" for i in range(100_000))
    rows = [(1, text), (2, text + " end"), (3, LONG), (4, "word word word word word")]
    assert found(ngram_join.linked_groups(make_docs(rows))) == [(1, 99_996, 1), (2, 99_997, 1), (3, 1, 3), (4, 1, 3)]


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 2**32 - 1))
def test_suffix_filter_never_says_too_little(seed):
    r = np.random.default_rng(seed)
    pool = r.integers(0, 2**64 - 1, 60, dtype=np.uint64).view(np.int64)
    order = {int(x): k for k, x in enumerate(pool)}  # any common order
    a, b = (np.array(sorted(r.choice(pool, r.integers(1, 50), replace=False).tolist(), key=order.get)) for _ in range(2))
    common = sorted(set(a.tolist()) & set(b.tolist()), key=order.get)
    for x in common:
        assert ngram_join.may_share(a, b, a.tolist().index(x), b.tolist().index(x)) >= len(common)


def test_classes(make_docs):
    rows = [(3, "a b c d e f"), (2, "A b c d e f"), (9, "x"), (None, "x"), (4, None)]
    assert found(ngram_join.classes(make_docs(rows))) == [(2, 2, 2), (3, 2, 2), (4, 0, 4), (9, 1, 9), (None, 1, None)]


def test_prefixes_and_whole_sets_are_not_left_on_disk(llm, make_docs):
    import os

    from costmart.llm.ngram_join import Join
    from costmart.session import ensure_checkpoint_dir

    base = ensure_checkpoint_dir(llm).removeprefix("file:").rstrip("/") + "/costmart-scratch"
    os.makedirs(base, exist_ok=True)
    before = set(os.listdir(base))
    text = " ".join(f"w{i}" for i in range(40))
    j = Join(make_docs([(1, text), (2, text + " x"), (3, "a b c d e f g h")]), 5, 80, "doc_id", "text")
    left = {d.rsplit("-", 1)[0] for d in set(os.listdir(base)) - before}
    assert left == {"join-ids", "join-class-ids", "join-left", "join-ranked"}
    assert j.signed.count() == 3 and j.ranked.count() == 2
