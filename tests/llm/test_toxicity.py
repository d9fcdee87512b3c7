import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from costmart.llm import toxicity as t


@pytest.fixture(scope="module")
def model(llm, sf_dir):
    base = sf_dir.replace("0.001", "0.1")  # the smaller tables label too few toxic texts
    return t.train(llm.read.parquet(f"{base}/documents.parquet"), llm.read.parquet(f"{base}/labels.parquet"))


def test_restores_written_around_words(model):
    decoder = t.Decoder(model.logp)
    wanted = {"1d10t": "idiot", "i.d.i.o.t": "idiot", "idiooot": "idiot", "l0s3r": "loser", "$cum": "scum", "m0r0n": "moron", "tr@sh": "trash",
              "cl0wn": "clown", "stup1d": "stupid", "stuuupid": "stupid", "scu-m": "scum", "the***": "the"}
    assert {w: " ".join(decoder.restore(w)) for w in wanted} == wanted
    assert "idiot" in decoder.words("you are an i d i o t indeed")
    assert decoder.words("plain words, here.") == {"plain", "words", "here"}


def test_restores_doubled_spaced_and_split_words(model):
    decoder = t.Decoder(model.logp)
    for text in ("iddiiot", "you are a i d i o t", "i. d. i. o. t.", "such an id iot here", "i d i o t s c u m", "s c u m i d i o t"):
        assert "idiot" in decoder.words(text), (text, decoder.words(text))
    assert "stupid" in decoder.words("stuupid") and "scum" in decoder.words("i d i o t s c u m")
    assert decoder.restored("it is in the house") == "it is in the house"


def test_viterbi_is_the_best_path(model):
    logp = memoryview(model.logp)

    def brute(slots):
        def go(i, state, score, text):
            if i == len(slots):
                yield score + logp[state * t.SYMBOLS], text
                return
            for piece, cost, _ in slots[i]:
                s, total = state, score - cost
                for c in piece:
                    k = s * t.SYMBOLS + t.symbol(c)
                    total += logp[k]
                    s = k % t.SYMBOLS ** 3
                yield from go(i + 1, s, total, text + piece)
        return max(go(0, 0, 0.0, ""))[1]

    for word in ("1d10t", "l0s3r", "s+u|d", "a--b", "5t00oop", "é1é"):
        slots = t.lattice(word)
        assert t.viterbi(slots, logp) == brute(slots)


def test_grams_match_plain_counts(llm, make_docs):
    text = "Abc d! é\nabc"
    counts = t.count_grams(make_docs([(1, text), (2, None)]).select(F.coalesce("text", F.lit("")).alias("text")))
    codes, last = [0, 0, 0], 0
    for c in text.lower() + " ":
        s = t.symbol(c)
        if not (s == 0 and last == 0):
            codes.append(s)
        last = s
    want = np.zeros(t.SYMBOLS ** 4, np.int64)
    for a in zip(codes, codes[1:], codes[2:], codes[3:]):
        want[((a[0] * 28 + a[1]) * 28 + a[2]) * 28 + a[3]] += 1
    got = counts.copy()
    got[0] = want[0] = 0
    assert np.abs(got - want).sum() <= 2  # borders between texts


def test_held_out_accuracy(llm, sf_dir, model):
    base = sf_dir.replace("0.001", "0.1")
    docs = llm.read.parquet(f"{base}/documents.parquet").join(llm.read.parquet(f"{base}/labels.parquet"), "doc_id").where("lang = 'en'")
    rows = docs.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0).select("toxic", t.scorer(llm, model)(F.col("text")).alias("s")).collect()
    right = sum((r["s"] >= 0.5) == (r["toxic"] == 1) for r in rows)
    assert right / len(rows) > 0.95


def test_labels_of_held_out_rows_teach_nothing(make_docs, llm):
    docs = make_docs([(i, "bad worm" if i % 2 else "good bird") for i in range(60)])
    labels = llm.createDataFrame([(i, i % 2) for i in range(60) if zlib.crc32(str(i).encode()) % 5 == 0], "doc_id long, toxic int")
    model = t.train(docs, labels)
    assert model.weights == {} and model.coefficients[0] == -math.inf


def test_odd_rows_and_empty_tables(make_docs, odd, llm, model):
    scored = make_docs(odd).select("doc_id", t.scorer(llm, model)(F.col("text")).alias("s")).collect()
    assert len(scored) == len(odd) and all(0 <= r["s"] < 0.5 for r in scored)
    kept = t.reject(make_docs([*odd, (11, "you idiot " * 3 + "loser scum moron trash")]), model)
    assert kept.count() == len(odd) and kept.columns == make_docs([]).columns
    assert t.reject(make_docs([]), model).count() == 0
    none = llm.createDataFrame([(None, 1), (1, None)], "doc_id long, toxic int")
    assert t.train(make_docs([]), none).weights == {}


def test_words_and_runs_without_letters_are_restored():
    text = b"the pass is a mass of gas and an ass sits on it with a lass " * 50 + b"what a shit list of idiot hits " * 50
    decoder = t.Decoder(t.log_probabilities(t.gram_counts(text)))
    for noisy, plain in (("@$$", "ass"), ("4$$", "ass"), ("$#!+", "shit"), ("@ $ $", "ass"), ("1 d 1 0 7", "idiot"), ("an 1d10t", "idiot")):
        assert plain in decoder.words(f"it is {noisy}, truly"), noisy
    assert decoder.words("455 2023 12 34 56 --- 1.5") == {"455", "2023", "12", "34", "56", "---", "1.5"}


def test_all_labels_of_one_class_score_nothing(make_docs, llm):
    docs = make_docs([(i, "bad worm") for i in range(40)])
    model = t.train(docs, llm.createDataFrame([(i, 1) for i in range(40)], "doc_id long, toxic int"))
    assert [r["s"] for r in docs.select(t.scorer(llm, model)(F.col("text")).alias("s")).distinct().collect()] == [0.0]
