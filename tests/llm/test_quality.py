import math
import re
from collections import Counter

from costmart.llm import quality as q


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    c = Counter(zip(w, w[1:], w[2:]))
    covered = {i + k for i in range(len(w) - 2) if c[tuple(w[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


FIGURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def test_figures_match_brute_force(llm, sf_dir):
    docs = llm.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in q.figures(docs).collect():
        assert tuple(r[f] for f in FIGURES) == brute(texts[r["doc_id"]])


def test_odd_rows(make_docs, odd):
    more = [*odd, (11, "a b c a b c a b c"), (12, "x y x y x y x"), (13, "s s s s s s"), (14, "a b c d a b c"), (15, "\x0ba\x0cb\rc")]
    got = sorted(((r["doc_id"] or -1), *(r[f] for f in FIGURES)) for r in q.figures(make_docs(more)).collect())
    assert got == sorted((i or -1, *brute(t)) for i, t in more)
    judged = q.judge(make_docs(more)).collect()
    assert len(judged) == len(more) and all(r["base_failed"] and not r["kept"] for r in judged if r["n_words"] < 50)
    assert q.judge(make_docs([])).count() == 0


def test_em_recovers_planted_accuracies():
    import random

    r, rules = random.Random(3), q.RULES[:5]
    counts = Counter()
    truth = {}
    for _ in range(20_000):
        good = r.random() < 0.8
        votes = tuple(0 if r.random() < 0.2 else (1 if (r.random() < (0.9 - 0.05 * j)) == good else -1) for j in range(len(rules)))
        counts[votes] += 1
        truth.setdefault(votes, [0, 0])[good] += 1
    prior, beliefs = q.estimate(sorted(counts.items()), rules)
    assert abs(prior - 0.8) < 0.05
    for j, rule in enumerate(rules):
        good, bad = beliefs[rule[0]][1][0] / (1 - beliefs[rule[0]][0][0]), beliefs[rule[0]][-1][1] / (1 - beliefs[rule[0]][0][1])
        assert abs(good - (0.9 - 0.05 * j)) < 0.05 and abs(bad - (0.9 - 0.05 * j)) < 0.08


def test_estimate_counts_base_failures_too(make_docs):
    rows = [(i, f"the cat of number{i} and the dog. " * (1 if i % 2 else 9) + "# " * (i % 3 * 9)) for i in range(40)]
    got = q.judge(make_docs(rows)).collect()
    votes = [tuple(r[f"v_{x[0]}"] for x in q.RULES) for r in got]
    prior, beliefs = q.estimate(sorted(Counter(votes).items()))
    assert any(r["base_failed"] for r in got)
    for r, v in zip(got, votes):
        z = math.log(prior / (1 - prior)) + sum(math.log(b[x][0] / b[x][1]) for x, b in zip(v, beliefs.values()))
        assert abs(r["posterior"] - 1 / (1 + math.exp(-z))) < 1e-9


def test_agrees_with_labels_it_has_not_seen(llm, sf_dir):
    base = sf_dir.replace("0.001", "0.01")
    labels = {r["doc_id"]: r["quality"] for r in llm.read.parquet(f"{base}/labels.parquet").collect()}
    rows = [r for r in q.judge(llm.read.parquet(f"{base}/documents.parquet")).collect() if r["doc_id"] in labels and not r["base_failed"]]
    assert sum(r["kept"] == (labels[r["doc_id"]] == 1) for r in rows) / len(rows) > 0.97
    assert all(r["kept"] for r in rows if labels[r["doc_id"]] == 1)


def test_main_path_is_native(llm, sf_dir):
    plan = q.judge(llm.read.parquet(f"{sf_dir}/documents.parquet"))._jdf.queryExecution().toString()
    figures = q.figures(llm.read.parquet(f"{sf_dir}/documents.parquet"))._jdf.queryExecution().toString()
    assert not any(w in plan + figures for w in ("Python", "Pandas", "Arrow", "Generate", "Cartesian"))
