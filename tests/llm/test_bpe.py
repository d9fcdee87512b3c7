import hashlib
import random

import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from costmart.llm import bpe
from costmart.llm.bpe import encode_decode, tokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
TEXTS = ["", " ", "  a  b ", "foo \n bar\n\n  baz", "a<|endoftext|> b<|endoftext|><|endoftext|>", "<|endoftext", "x" * 5000, "don't we'll I'M ''s",
         "ab" * 4000 + " " + "1" * 3000, "\t\t x \r\n y", "a\x1f b \x1f c \x85  d", "é漢字🙂 " * 50, "word " * 1000]


def same(text):
    ids = tokenizer(PATH).encode(text)
    assert ids == LIBRARY.encode(text, add_special_tokens=False).ids
    assert tokenizer(PATH).decode(ids) == LIBRARY.decode(ids, skip_special_tokens=False) == text


def test_equals_library_on_awkward_texts():
    for text in TEXTS:
        same(text)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.characters(codec="utf-8"), max_size=80) | st.text(alphabet=" \n\tab's1é.<|endoftext>", max_size=60))
def test_equals_library(text):
    same(text)


def test_heap_and_matrix_agree():
    bpe = tokenizer(PATH)
    for word in (b"ththtionerandthe", "übergeheitkeiten".encode(), b"aaaaaaaabaaaaaaa", b"z"):
        bounds = bpe._heap(word)
        assert [bpe.id_of[word[a:b]] for a, b in zip(bounds, bounds[1:])] == list(bpe.encode_words([word])[0])


def test_corpus_round_trip(llm, sf_dir):
    docs = llm.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = encode_decode(docs, PATH, with_ids=True).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = LIBRARY.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["ids"] == ids and r["n_tokens"] == len(ids) and r["decoded"] == texts[r["doc_id"]]
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(r["decoded"].encode()).hexdigest()


def test_odd_rows_and_empty_table(make_docs, odd):
    rows = encode_decode(make_docs(odd), PATH).collect()
    assert sorted((r["doc_id"] or -1, r["n_tokens"]) for r in rows) == sorted(
        (i or -1, len(LIBRARY.encode(t or "", add_special_tokens=False).ids)) for i, t in odd)
    assert encode_decode(make_docs([]), PATH).count() == 0


def test_memo_is_bounded_by_bytes(monkeypatch):
    """Texts without spaces, and more short chunks than a half holds; ids stay the library's."""
    monkeypatch.setattr(bpe, "HALF_BYTES", 200_000)
    r, own, most = random.Random(4), bpe.RankArrayBPE(PATH), 0
    for _ in range(30):
        texts = ["".join(chr(r.randint(0x4E00, 0x9FFF)) for _ in range(400)) for _ in range(5)] + [" ".join(f"w{r.randint(0, 9999)}" for _ in range(300))]
        assert own.encode_batch(texts) == [LIBRARY.encode(t, add_special_tokens=False).ids for t in texts]
        most = max(most, sum(bpe.ENTRY_BYTES + len(k) + len(v) for half in (own.memo, own.old) for k, v in half.items()))
    assert most < 3 * 200_000 and not own.passing and all(len(k) <= bpe.LONGEST for k in own.memo)


def test_words_of_the_memo_are_not_encoded_again(monkeypatch):
    """A word found in a chunk of its own is taken from the memo where a later chunk holds it beside others."""
    own, seen = bpe.RankArrayBPE(PATH), []
    scan = own._scan
    monkeypatch.setattr(own, "_scan", lambda words, width: seen.extend(words) or scan(words, width))
    own.encode_batch(["some unheardofword here, and"])
    assert b" unheardofword" in seen
    seen.clear()
    text = "x unheardofword, y here\n (unheardofword) z"
    assert own.encode(text) == LIBRARY.encode(text, add_special_tokens=False).ids
    assert b" unheardofword" not in seen and b"unheardofword" in seen


def test_chunks_of_a_batch_cut_as_one_text():
    """Chunks of several texts are cut together; ids and digests of each text stay the library's."""
    r, own = random.Random(6), bpe.RankArrayBPE(PATH)
    for _ in range(40):
        texts = ["".join(r.choice([" ", " ", "\n", "\t", "\x1f", "\x85", " ", "a", "b1", "é", "漢", "'s", "...", "<|endoftext|>", "٣"]) for _ in range(r.randint(0, 30))) for _ in range(20)]
        for t, ids in zip(texts, own.encode_arrays(texts), strict=True):
            want = LIBRARY.encode(t, add_special_tokens=False).ids
            assert ids.tolist() == want and own.decode(ids) == t
            assert own.digest(ids) == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
