import zlib

import numpy as np

from costmart.llm.sharding import _inner, histogram_sort


def check(rows, docs, shards):
    assert len(rows) == len(docs)
    want = sorted((i if i is not None else -1, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in docs)
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["size"], r["text_crc32"]) for r in rows) == want
    for s in range(shards):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sum(r["shard"] == s for r in rows)))
    order = sorted(rows, key=lambda r: r["sort_key"])
    assert [r["shard"] for r in order] == sorted(r["shard"] for r in rows)
    # every end is the nearest that whole keys allow
    total, below, ends = sum(r["size"] for r in rows), 0, {0: 0}
    at = []
    for i, r in enumerate(order):
        if not i or order[i - 1]["sort_key"] != r["sort_key"]:
            at.append(below)
        below += r["size"]
    at.append(below)
    for s in range(1, shards):
        end = sum(r["size"] for r in rows if r["shard"] < s)
        target = total * s // shards
        assert abs(end - target) == min(abs(x - target) for x in at), ends


def test_near_equal_bytes_with_hot_text(make_docs):
    docs = [(i, "the same text" if i % 3 == 0 else f"text {i} " * (i % 40 + 1)) for i in range(900)]
    rows = histogram_sort(make_docs(docs), shards=7, rows_per_range=40).collect()
    check(rows, docs, 7)
    sizes = [sum(r["size"] for r in rows if r["shard"] == s) for s in range(7)]
    assert max(sizes) - min(sizes) <= 2 * max(r["size"] for r in rows)


def test_odd_rows_payload_and_empty_table(make_docs, odd):
    frame = make_docs(odd)
    rows = histogram_sort(frame, shards=3, payload=frame.columns).collect()
    check(rows, odd, 3)
    assert sorted((r["payload"]["text"] or "")[:9] for r in rows) == sorted((t or "")[:9] for _, t in odd)
    assert histogram_sort(make_docs([]), shards=3).count() == 0


def test_tolerance_saves_rounds_and_stays_near(make_docs):
    docs = [(i, f"text {i} " * 5) for i in range(500)]
    rows = histogram_sort(make_docs(docs), shards=5, tolerance=0.05).collect()
    sizes = [sum(r["size"] for r in rows if r["shard"] == s) for s in range(5)]
    assert len(rows) == 500 and max(sizes) - min(sizes) <= 0.1 * sum(sizes) / 5 + 100


def test_rows_that_repeat_id_and_text_are_split(make_docs):
    """A third of the rows one id with one text, another third null ids with one text."""
    docs = [(7, "one text of one id")] * 400 + [(None, "no id")] * 400 + [(i, f"text {i} " * (i % 9 + 1)) for i in range(400)]
    rows = histogram_sort(make_docs(docs), shards=6, rows_per_range=50).collect()
    check(rows, docs, 6)
    sizes = [sum(r["size"] for r in rows if r["shard"] == s) for s in range(6)]
    assert max(sizes) - min(sizes) <= 2 * max(r["size"] for r in rows)


def test_probes_lie_inside_open_intervals():
    a, b = np.array([0, 10, 20, 1 << 40]), np.array([1, 12, 90, 1 << 61])
    probes = _inner(a, b, 64)
    assert 11 in probes and set(range(21, 90)) <= set(probes.tolist()) and (np.diff(probes) > 0).all()
    assert all(((a < x) & (x < b)).any() for x in probes.tolist())
