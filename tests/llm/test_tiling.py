import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from costmart.llm import tiling as t


def brute(pattern, text, least):
    """Greedy string tiling by comparing all places."""
    least = min(least, len(pattern))
    p_free, t_free, tiles = [True] * len(pattern), [True] * len(text), []
    while least:
        best, found = least - 1, []
        for i in range(len(pattern)):
            for j in range(len(text)):
                n = 0
                while i + n < len(pattern) and j + n < len(text) and pattern[i + n] == text[j + n] and p_free[i + n] and t_free[j + n]:
                    n += 1
                if n >= least and n >= best:
                    best, found = n, [*(found if n == best else []), (i, j)]
        if best < least or not found:
            return tiles
        for i, j in sorted(found):
            if all(p_free[i:i + best]) and all(t_free[j:j + best]):
                tiles.append((i, j, best))
                for k in range(best):
                    p_free[i + k] = t_free[j + k] = False
    return tiles


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=12), st.lists(st.integers(0, 3), max_size=25), st.integers(1, 4))
def test_tiles_equal_brute_force(pattern, text, least):
    assert t.tile(np.array(pattern, np.uint64), np.array(text, np.uint64), least) == brute(pattern, text, least)


def passage(r, n):
    return [f"{r.choice('abcdefgh')}{r.randint(0, 500)}" for _ in range(n)]


def test_catches_exact_and_reordered_and_leaves_clean(make_docs, llm):
    r = random.Random(1)
    items = [passage(r, 40) for _ in range(5)] + [["short", "item", "here"]]
    bench = llm.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)] + [(None, None), (9, ""), (0, " ".join(items[0]))], "item_id long, text string")
    noise = lambda n: " ".join(passage(r, n))
    a = items[0]
    rows = [(1, f"{noise(30)} {' '.join(a)} {noise(10)}"), (2, f"{' '.join(a[20:])} {noise(9)} {' '.join(a[:20])}".upper()),
            (3, noise(200)), (4, " ".join(a[:12]) + " " + noise(50)), (5, noise(9) + " Short, item here. " + noise(4)), (6, None), (7, ""),
            (1, None), (8, f"{noise(30)} {' '.join(items[1])} {' '.join(items[2])}")]
    docs = make_docs(rows)
    got = {x["c_id"]: (x["item_ids"], round(x["max_coverage"], 3)) for x in t.contamination(docs, bench).collect()}
    assert got == {1: ([0], 1.0), 2: ([0], 1.0), 5: ([5], 1.0), 8: ([1, 2], 1.0)}
    kept = t.clean(docs, bench)
    assert kept.columns == docs.columns and sorted((x["doc_id"], x["text"] or "") for x in kept.collect()) == sorted(
        (i, x or "") for i, x in rows if i in (3, 4, 6, 7) or (i, x) == (1, None))


def test_equals_brute_force_on_tables(llm, sf_dir):
    docs, bench = llm.read.parquet(f"{sf_dir}/documents.parquet"), llm.read.parquet(f"{sf_dir}/benchmark.parquet")
    items = [(r["item_id"], t.word_hashes(r["text"])) for r in bench.collect()]
    want = {}
    for r in docs.collect():
        words = t.word_hashes(r["text"])
        hit = sorted(i for i, w in items if t.coverage_of(w, words, 5) >= 0.5)
        if hit:
            want[r["doc_id"]] = hit
    assert want and {r["c_id"]: r["item_ids"] for r in t.contamination(docs, bench).collect()} == want


def test_odd_rows_and_empty_tables(make_docs, odd, llm):
    none = llm.createDataFrame([], "item_id long, text string")
    some = llm.createDataFrame([(1, "some words that no text has at all")], "item_id long, text string")
    assert t.contamination(make_docs(odd), none).count() == 0
    assert t.clean(make_docs(odd), some).count() == len(odd)
    assert t.clean(make_docs([]), some).count() == 0
