import hashlib
import random
import re
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from costmart.llm import secret_scan as s
from costmart.llm import spans

KEYWORDS = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key"))
PLAIN = {"assign": rf"({KEYWORDS})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", "access": r"AKIA[A-Z0-9]+", "hex": r"[0-9a-f]+"}


def brute(text):
    out = []
    for k, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text):
            if {"assign": lambda: len(m.group(2)) >= 6, "access": lambda: len(m.group()) >= 20, "hex": lambda: len(m.group()) >= 24}[kind]():
                out.append((m.start(), k, m.end()))
    return sorted(out)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["token", "PassWord", "api_key", "apikey", "=", ":", " ", '"', "abc123", "AKIA", "0123456789abcdef", "X9", "é", "ſecret"]), max_size=12))
def test_base_equals_plain_patterns(parts):
    text = "".join(parts)
    assert spans.find(text, spans.SECRET) == brute(text)


def test_windows_hold_the_whole_candidate():
    r = random.Random(4)
    body = "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(500))
    rows = s.encode(f"left {body} right", 5, 505)
    held = ["".join(chr(c - 128) if c > 128 else " " for c in row).strip() for row in rows]
    whole = held[0]
    for h in held[1:]:
        overlap = max(k for k in range(len(h) + 1) if whole.endswith(h[:k]))
        whole += h[overlap:]
    assert whole == body


def corpus(n, seed=1):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("etaoinshrdlu") for _ in range(r.randint(3, 9)))
    rows = []
    for i in range(n):
        text = " ".join(word() for _ in range(20)) + " " + "".join(word() for _ in range(5))[:r.randint(17, 30)]
        if i % 3 == 0:
            text += f' token = "{r.getrandbits(160):040x}" {word()}'
        rows.append((i, text + " " + word()))
    return rows


def test_held_out_quality_and_unseen_secrets(make_docs):
    net = s.train(make_docs(corpus(400)).select("text"), sample=1000)
    r = random.Random(9)
    unseen = [f"note {r.getrandbits(80):020x}-{r.getrandbits(80):020x} end" for _ in range(40)]  # runs too short for the fixed formats
    plain = ["note " + "".join(r.choice("etaoinshrdlu") for _ in range(41)) + " end" for _ in range(40)]
    rate = lambda texts: np.mean([net.probability(np.frombuffer(s.encode(t, 5, 46)[0], np.uint8)[None, :])[0] >= net.threshold for t in texts])
    assert rate(unseen) > 0.9 and rate(plain) < 0.1


def test_recall_holds_where_secrets_are_rare():
    r = np.random.default_rng(7)
    codes, y = r.integers(0, 256, (600, s.WIDTH)).astype(np.uint8), np.repeat([1, 0], 300).astype(np.float32)
    net = s.Network.fresh(1)
    s.calibrate(net, codes, y, np.where(y > 0, 0.01, 1.99), 0.98)  # one secret in 200 candidates, hard to tell
    found = net.probability(codes) >= net.threshold
    assert net.threshold < 0.5 and found[y > 0].mean() >= 0.98
    assert abs(net.precision - 0.01 * found[y > 0].sum() / (0.01 * found[y > 0].sum() + 1.99 * found[y == 0].sum())) < 1e-6


def test_short_and_dotted_runs_are_candidates():
    for text, wanted in (("pwd: Hunter2xQ9", "Hunter2xQ9"), ("use xk7.Zp0q.LL29.a81c now", "xk7.Zp0q.LL29.a81c"), ("is p@ss!W0rd#99$kk ok", "p@ss!W0rd#99$kk"),
                         ("a tok3n1 b", "tok3n1")):
        assert wanted in [text[a:b] for a, b, _ in zip(*s.candidates(text, []))]
    text = 'note password: "abc123" end'
    labels = {text[a:b]: k for a, b, k in zip(*s.candidates(text, s.values(text, spans.find(text, spans.SECRET))))}
    assert labels == {"password": False, "abc123": True}


def test_shared_convolution_equals_windows():
    r = random.Random(11)
    texts = ["".join(r.choice("abXY019.=/ \n:é") for _ in range(n)) for n in (0, 6, 300, 20_000)] + ["x" * 48, "y" * 47 + " ab12cd"]
    net, raw, place, want = s.Network.fresh(3), b"", [], []
    for t in texts:
        a, b, _ = s.candidates(t, [])
        assert list(zip(a, b)) == [m.span() for m in re.finditer(r"[A-Za-z0-9+/_=.!@#$%^&*?~-]{6,}", t)]
        a, b = a[b - a <= s.BODY], b[b - a <= s.BODY]
        windows = s.first_windows(t, a, b)
        assert [w.tobytes() for w in windows] == [s.encode(t, int(x), int(y))[0] for x, y in zip(a, b)]
        place += [(x + len(raw) + s.LEFT, y + len(raw) + s.LEFT) for x, y in zip(a, b)]
        want.append(net.raw(windows))
        raw += bytes(s.LEFT) + t.encode("ascii", "replace") + bytes(s.WIDTH)
    start, end = np.array(place).T
    assert len(start) > 100 and np.allclose(net.in_place(np.frombuffer(raw, np.uint8), start, end, block=512), np.concatenate(want), atol=1e-4)


def test_short_password_is_found(make_docs):
    r = random.Random(2)
    secret = lambda n: "".join(r.choice("ABCDEFGHJKMNPQRSTUVWXYZ23456789") for _ in range(n))
    rows = [(i, t + (f" password: {secret(r.randint(7, 12))} and" if i % 2 else "")) for i, t in corpus(400)]
    got = {x["doc_id"]: x["spans"] for x in s.scan(make_docs([*rows, (1000, "note pwd: HUNTER2XQ9 and")]), sample=1000).collect()}
    assert got[1000] == "cnn:10:20"


def test_scan_keeps_base_and_adds(make_docs):
    rows = corpus(300) + [(1000, "note 0a1b2c3d4e5f6a7b8c9d-7e0f61825394a5b6c7d8 end")]
    got = {r["doc_id"]: r for r in s.scan(make_docs(rows), sample=1000).collect()}
    for i, t in rows:
        base = spans.written(brute(t), s.NAMES)
        assert got[i]["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        assert set(filter(None, base.split(","))) <= set(got[i]["spans"].split(","))
    assert got[1000]["spans"] == "cnn:5:46"


def test_gradients_match_differences():
    net = s.Network.fresh(1)
    r = np.random.default_rng(2)
    codes, y = r.integers(0, 256, (6, s.WIDTH)).astype(np.uint8), np.array([0, 1, 0, 1, 1, 0], np.float32)

    def loss():
        z = net.forward(codes)[-1].astype(float)
        return np.mean(np.log1p(np.exp(-z)) * y + np.log1p(np.exp(z)) * (1 - y))

    for p, g in zip(net.parameters(), net.gradients(codes, y), strict=True):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        old, step = p[at], 1e-2
        p[at] = old + step
        up = loss()
        p[at] = old - step
        down = loss()
        p[at] = old
        assert abs((up - down) / (2 * step) - g[at]) < 0.05 * abs(g[at]) + 1e-4


def windows_of(texts):
    """All first windows with and without their surroundings, and their labels."""
    codes, y = [], []
    for text in texts:
        a, b, known = s.candidates(text, s.values(text, spans.find(text, spans.SECRET)))
        codes.append(s.first_windows(text, a, b))
        y.append(known)
    codes, y = np.concatenate(codes), np.concatenate(y)
    return np.concatenate([codes, np.where(codes >= 128, codes, 0)]), np.tile(y, 2)


ODD_TEXTS = [t for _, t in corpus(60, 3)] + ["", "x" * 48, "y" * 49 + " ab12cd", "z" * 52, "w" * 55 + " q", "v" * 300 + ' token="abc123"',
                                              "é" * 9 + "ab12cd", "only a few"]


def test_summed_gradients_equal_those_of_windows():
    net, weight = s.Network.fresh(3), np.array([0.25, 2.0])
    codes, y = windows_of(ODD_TEXTS)
    want = [0.0] * 4
    for k in (0, 1):
        want = [w + weight[k] * (y == k).sum() * g for w, g in zip(want, net.gradients(codes[y == k], y[y == k].astype(np.float32)))]
    whole, got = Counter(), [0.0] * 4
    of = s.Gathered.of(ODD_TEXTS, None, False, whole)
    alone = whole.copy()
    for some, *places in of.within(np.arange(len(of.start)), block=512):
        got = [a + b for a, b in zip(got, net.sums(*places, of.known[some], weight[of.known[some]]))]
    for known, n, *places in s.by_themselves(alone, block=50):
        got = [a + b for a, b in zip(got, net.sums(*places, known, n * weight[known]))]
    assert all(np.allclose(a, b, atol=2e-3 * np.abs(b).max()) for a, b in zip(got, want))
    parts = [s.Gathered.of(ODD_TEXTS, (1 << 61, 1 << 62), held, alone) for held in (False, True)]
    assert sum(len(p.start) for p in parts) == len(of.start) and all(len(p.start) for p in parts) and alone == whole


def test_every_candidate_counts_not_a_sample(make_docs):
    """Threshold and precision are those of all held-back candidates, and the network changes with any candidate it learns from."""
    from pyspark.sql import functions as F

    docs = make_docs(corpus(400))
    net = s.train(docs.select("text"), sample=20)
    held = [r["text"] for r in docs.where(F.pmod(F.xxhash64("text"), F.lit(3)) == 0).collect()]
    codes, y = windows_of(held)
    z = np.floor(net.raw(codes).astype(float) * s.STEPS) / s.STEPS
    want = s.Network(*net.parameters())
    s.settle(want, z, y.astype(float), np.ones(len(z)), np.ones(len(z)), 0.98, 1 / s.STEPS)
    assert y.sum() > 20 and (net.probability(codes)[y] >= net.threshold).mean() >= 0.98
    assert abs(want.threshold - net.threshold) < 0.01 and abs(want.precision - net.precision) < 0.01
    # one more text to learn from, none of whose windows would be drawn
    drawn = [np.sort(s.window_hash(k))[:20].max() for k in (lambda c, y: (c[~y], c[y]))(*(x[:len(x) // 2] for x in windows_of([t for _, t in corpus(400)])))]
    more = docs.sparkSession.createDataFrame([(f"{t} {i}",) for i, (_, t) in enumerate(corpus(40, 8))], "text string")
    more = [r["text"] for r in more.where(F.pmod(F.xxhash64("text"), F.lit(3)) != 0).collect()]
    more = next(t for t in more if all((s.window_hash(c[:len(c) // 2][y[:len(c) // 2] == k]) > drawn[k]).all() for c, y in [windows_of([t])] for k in (0, 1)))
    other = s.train(make_docs([*corpus(400), (1000, more)]).select("text"), sample=20)
    assert np.abs(other.kernel - net.kernel).max() > 0


def test_odd_rows_and_empty_table(make_docs, odd):
    rows = s.scan(make_docs(odd)).collect()
    assert sorted(((r["doc_id"] or -1), r["n_assign"] + r["n_access"] + r["n_hex"]) for r in rows) == sorted(((i or -1), len(brute(t or ""))) for i, t in odd)
    assert s.scan(make_docs([])).count() == 0


def test_distinct_keys_where_slots_are_shared():
    r = np.random.default_rng(5)
    for n, top in ((0, 9), (1, 9), (300, 7), (50_000, 20_000), (50_000, 1 << 40)):
        keys = r.integers(0, top, n)
        found, row = s.distinct(keys)
        assert len(np.unique(found)) == len(found) == len(np.unique(keys)) and (found[row] == keys).all()


def test_maxima_sums_and_spread_equal_each_place():
    """Of windows whose places are shared, against the places one by one, candidates of every length."""
    r = np.random.default_rng(3)
    text = "".join("x" * n + " " * int(r.integers(1, 30)) for n in [*range(6, 60), 90, *range(6, 12)])
    joined = np.frombuffer(bytes(s.LEFT) + text.encode() + bytes(s.WIDTH), np.uint8)
    start, end, _ = s.candidates(text, [])
    start, end = start + s.LEFT, np.minimum(end, start + s.WIDTH - s.LEFT) + s.LEFT
    seen = 0
    for block in (64, 1 << 19):
        for some, codes, w in s.blocks(joined, start, end, block):
            each = [np.concatenate([w.text[b:b + s.LEAD], w.own[h:h + n], w.text[a:a + s.PLACES - s.LEAD - n]])
                    for b, h, n, a in zip(w.before, w.heads, w.sizes, w.after)]
            windows = np.stack([s.first_windows(text, start[some] - s.LEFT, end[some] - s.LEFT)[:, k:k + s.PLACES] for k in range(s.KERNEL)], axis=2)
            assert (codes[np.stack(each)] == windows).all()
            values, d = r.integers(0, 1 << 50, (len(codes), s.FILTERS)), r.random(len(each))
            for by in (16, 4096):
                assert (w.maxima(values, by) == np.stack([values[e].max(0) for e in each])).all()
            assert np.allclose(w.sums(values[:, 0].astype(float)), [values[e, 0].sum() for e in each])
            want = np.zeros(len(codes))
            for e, x in zip(each, d):
                np.add.at(want, e, x)
            assert np.allclose(w.spread(d, len(codes)), want)
            seen += len(each)
    assert seen == 2 * len(start)
