import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from costmart.llm import pii, spans

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    values = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(v - 9 if v > 9 else v for v in values) % 10 == 0


def brute(text):
    out = []
    for k, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")),
                    "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]:
                out.append((m.start(), k, m.end()))
    return sorted(out)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a1.@-+_ 2(", max_size=40) | st.text(alphabet="0123456789 -.+", max_size=60))
def test_base_equals_plain_patterns(text):
    assert spans.find(text, spans.PRIVATE) == brute(text)


def test_base_on_documents(llm, sf_dir):
    docs = llm.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in pii.extract(docs).collect():
        want = brute(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(spans.written(want, pii.NAMES).encode()).hexdigest()
        assert (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]) == tuple(sum(k == i for _, k, _ in want) for i in range(4))


def test_discovers_unseen_identifiers(make_docs):
    rows = [(i, f"filler{chr(97 + i)} words then please reach customer at user{i}@mail.example.com for details") for i in range(12)]
    rows += [(20 + i, f"other{chr(97 + i)} words then please reach customer at handle-{700 + i} for details") for i in range(4)]
    rows += [(40 + i, f"the year of {1990 + i} was plain and the room number {100 + i} too") for i in range(12)]
    got = {r["doc_id"]: r for r in pii.extract(make_docs(rows), accept=0.6).collect()}
    for i in range(4):
        text = dict(rows)[20 + i]
        at = text.index("handle-")
        assert got[20 + i]["spans"] == f"id:{at}:{at + 10}" and got[20 + i]["n_found"] == 1
    assert all(got[40 + i]["spans"] == "" for i in range(12))
    assert all(got[i]["n_found"] == 0 and got[i]["n_email"] == 1 for i in range(12))


def test_odd_rows_and_empty_table(make_docs, odd):
    rows = pii.extract(make_docs(odd)).collect()
    assert len(rows) == len(odd)
    want = sorted(((i or -1), spans.written(brute(t or ""), pii.NAMES) if len(t or "") < 20_000 else "") for i, t in odd)
    assert sorted(((r["doc_id"] or -1), r["spans"]) for r in rows) == want
    assert pii.extract(make_docs([])).count() == 0
