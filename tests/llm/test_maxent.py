import math
import zlib
from collections import Counter

import numpy as np

from costmart.llm import maxent as m


def brute(rows):
    texts = [(i, (t or "").encode().lower().split() + [b"\n"], zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0) for i, t in rows]
    c = Counter(w for _, t, h in texts if not h for w in t)
    total, z = sum(c.values()), math.log10(sum(c.values()) + 0.1 * (len(c) + 1))
    return [(-1 if i is None else i, h, len(t), sum(c[w] > 0 for w in t), total, round(sum(math.log10(c[w] + 0.1) - z for w in t), 4)) for i, t, h in texts]


def base(rows):
    return sorted((-1 if r["doc_id"] is None else r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in rows)


def test_base_and_gain_on_held_out(llm, sf_dir):
    docs = llm.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/documents.parquet")
    rows = m.score(docs, max_words=5000).collect()
    assert base(rows) == sorted(brute([(r["doc_id"], r["text"]) for r in docs.collect()]))
    held = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_probabilities_sum_to_one():
    words = [b"the", b"of", *(f"w{i}th".encode() for i in range(300))]
    v = m.Vocabulary(words, np.arange(len(words), 0, -1).astype(float), 50, 0, 0, np.full(m.SPELLINGS, 3.0), np.full(m.SPELLINGS, 2.0))
    w = np.random.default_rng(1).standard_normal((m.ROWS, m.SUBS)).astype(np.float32)
    _, hashes = m.examples([v.numbers("the w3th of")[0]], v)
    leaves = np.arange(m.CLASSES * m.SUBS)
    assert abs((10 ** m.leaf_log10(w, leaves, np.repeat(hashes[2:3], len(leaves), 0))).sum() - 1) < 1e-4
    # inside the leaves: frequent words, two others of count 1 and 2 in each spelling, one unseen word
    mass = np.bincount(v.leaf[:len(words)], v.counts + m.ADD, m.CLASSES * m.SUBS)
    mass[m.HEAD + 1:] += 3 + 2 * m.ADD
    mass[m.END_LEAF] += v.ends + m.ADD
    assert np.allclose((mass + m.ADD) / 10 ** v.log_room, 1)


def test_training_learns_what_follows_what():
    v = m.Vocabulary([b"a", b"b", b"c", b"d"], np.array([4.0, 4, 4, 4]), 1, 0, 0, np.zeros(m.SPELLINGS), np.zeros(m.SPELLINGS))
    leaves, hashes = m.examples([v.numbers("a b c d " * 500)[0]], v)
    trainer = m.Trainer(np.zeros((m.ROWS, m.SUBS), np.float32), 0.25)
    before = m.leaf_log10(trainer.w, leaves, hashes).mean()
    for i in range(0, len(leaves), 200):
        trainer.step(leaves[i:i + 200], hashes[i:i + 200])
    assert before < -2 and m.leaf_log10(trainer.w, leaves, hashes).mean() > -0.3


def test_step_follows_the_gradient():
    v = m.Vocabulary([b"a", b"b"], np.array([2.0, 1]), 1, 0, 0, np.zeros(m.SPELLINGS), np.zeros(m.SPELLINGS))
    leaves, hashes = m.examples([v.numbers("a b")[0]], v)
    trainer = m.Trainer(np.zeros((m.ROWS, m.SUBS), np.float32), 1e-3)
    trainer.step(leaves[:1], hashes[:1])
    rows, _ = m.rows_of(hashes[:1], leaves[:1] // m.SUBS)
    g = np.full(m.SUBS, 1 / m.SUBS)
    g[leaves[0] // m.SUBS] -= 1
    moved = trainer.w[rows[0, 0].astype(int)]
    assert np.allclose(moved / np.abs(moved).max(), -g / np.abs(g).max(), atol=1e-5)


def test_odd_rows_and_empty_table(make_docs, odd):
    rows = m.score(make_docs(odd), max_words=3).collect()
    assert base(rows) == sorted(brute(odd)) and all(math.isfinite(r["score"]) for r in rows)
    assert m.score(make_docs([])).count() == 0
