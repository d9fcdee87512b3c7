import random
import re

import numpy as np
import pytest

from costmart.llm import minmax
from costmart.llm.components import components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute(rows, k):
    """Components over all pairs; rows sharing an id are one document."""
    sets = [shingles(t, k) for _, t in rows]
    parent = {i: i for i, _ in rows if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            x, y = sets[a], sets[b]
            if x and y and None not in (rows[a][0], rows[b][0]) and 100 * len(x & y) >= 80 * len(x | y):
                i, j = find(rows[a][0]), find(rows[b][0])
                parent[max(i, j)] = min(i, j)
    return sorted((-1 if i is None else i, len(s), -1 if i is None else find(i)) for (i, _), s in zip(rows, sets))


def result(frame):
    rows = frame.collect()
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)
    return sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_shingles"], -1 if r["component_id"] is None else r["component_id"]) for r in rows)


def edited(r, words, share):
    return " ".join(r.choice(["uno", "due", "tre"]) + str(r.randint(0, 99)) if r.random() < share else w for w in words)


@pytest.mark.parametrize("k", [2, 5])
def test_hot_group_of_near_copies(make_docs, k):
    r = random.Random(k)
    base = [f"w{r.randint(0, 400)}" for _ in range(120)]
    rows = [(i, edited(r, base, r.choice([0, 0.01, 0.03, 0.06, 0.1]))) for i in range(250)]
    rows += [(300 + i, "exact copy of one text that many rows hold " * 3) for i in range(60)]
    rows += [(400 + i, " ".join(f"w{r.randint(0, 400)}" for _ in range(r.randint(1, 60)))) for i in range(100)]
    r.shuffle(rows)
    assert result(minmax.near_duplicates(make_docs(rows, 7), words=k)) == brute(rows, k)


def test_corpus(llm, sf_dir):
    docs = llm.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert result(minmax.near_duplicates(docs, words=2)) == brute(rows, 2)


def test_odd_rows_ties_and_empty_table(make_docs, odd):
    tie = [(50, "a b c d e f g h i"), (51, "a b c d e f g h"), (52, "p q r s t"), (53, "p q r s u")]  # 8 of 8 + 1 shingles: under; ties below
    rows = [*odd, *tie, (60, "A b c"), (61, "a B c"), (62, "v w x y z"), (63, "v w x y z q")]
    assert result(minmax.near_duplicates(make_docs(rows), words=2)) == brute(rows, 2)
    assert minmax.near_duplicates(make_docs([])).count() == 0


def test_keep_one_keeps_columns_and_ids(make_docs):
    rows = [(3, "the same words here now"), (1, "the same words here now"), (2, "other words altogether there then"), (None, None), (4, "")]
    frame = make_docs(rows)
    kept = minmax.keep_one(frame)
    assert kept.columns == frame.columns and sorted((r["doc_id"] or -1) for r in kept.collect()) == [-1, 1, 2, 4]


def test_signature_estimates_similarity():
    scheme, r = minmax.MinMax(100, 5), np.random.default_rng(1)
    a = r.integers(0, 1 << 63, 1000, dtype=np.uint64)
    b = np.concatenate([a[:800], r.integers(0, 1 << 63, 200, dtype=np.uint64)])
    truth = 800 / 1200
    assert abs((scheme.signature(a) == scheme.signature(b)).mean() - truth) < 0.12


def test_components_of_random_links(llm):
    r = random.Random(5)
    links = [(r.randint(0, 300), r.randint(0, 300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)] + [(500, 500 + i) for i in range(1, 80)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        i, j = find(a), find(b)
        parent[max(i, j)] = min(i, j)
    want = {x: find(x) for x in list(parent) if find(x) != x}
    assert {x["node"]: x["component"] for x in components(llm.createDataFrame(links, "a long, b long")).collect()} == want


def test_components_write_files_by_the_number_of_links(llm, monkeypatch):
    """Files of a step don't grow with the shuffle partitions, and the labels are those of a search."""
    from costmart.llm import components as c

    files, real = {}, c.stored

    def stored(df, name):
        out = real(df, name)
        files.setdefault(name, []).append(len(out.inputFiles()))
        return out

    monkeypatch.setattr(c, "stored", stored)
    names = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: llm.conf.get(k) for k in names}
    try:
        for k, v in names.items():
            llm.conf.set(k, v)
        links = llm.createDataFrame([(i, i + 3) for i in range(400)], "a long, b long")
        got = {r["node"]: r["component"] for r in c.components(links).collect()}
    finally:
        for k, v in before.items():
            llm.conf.set(k, v)
    assert got == {i: i % 3 for i in range(3, 403)}
    most = llm.sparkContext.defaultParallelism
    assert most < 40 and files["large-star"] and max(files["large-star"] + files["small-star"]) <= most
