import re

from pyspark.sql import functions as F

from costmart.llm import line_dedup


def brute(rows):
    """Texts after removal, by (id, text): rows that repeat both are one."""
    lines = {}
    for i, t in set(rows):
        lines[(i, t)] = [(n, x) for n, x in enumerate((t or "").split("\n")) if re.search(r"[^\x20\x09-\x0D]", x)]
    return lines


def rewrite(rows, keys):
    lines = brute(rows)
    seen, gone = set(), {k: set() for k in lines}
    for k in sorted(lines, key=lambda k: (k[0] is None, k[0] or 0, keys[k])):
        solid = lines[k]
        for j in range(len(solid) - 2):
            window = tuple(x for _, x in solid[j:j + 3])
            if window in seen:
                gone[k] |= {n for n, _ in solid[j:j + 3]}
            seen.add(window)
    return {k: None if k[1] is None else "\n".join(x for n, x in enumerate(k[1].split("\n")) if n not in gone[k]) if gone[k] else k[1] for k in lines}


def check(frame, rows):
    keys = {(r["doc_id"], r["text"]): r["k"] for r in frame.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("k")).collect()}
    want = rewrite(rows, keys)
    out = line_dedup.dedup(frame)
    assert out.columns == frame.columns
    key = lambda x: (x[0] is None, x[0] or 0, x[1] is None, x[1] or "")
    assert sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=key) == sorted((((i, want[(i, t)])) for i, t in rows), key=key)


def test_corpus(llm, sf_dir):
    docs = llm.read.parquet(f"{sf_dir}/documents.parquet")
    check(docs, [(r["doc_id"], r["text"]) for r in docs.collect()])


def test_hot_passage_overlaps_and_blank_lines(make_docs):
    shared = "one shared line\nanother shared line\nthird shared line\nfourth shared line"
    rows = [(i, f"own {i}\n{shared}\nend {i}") for i in range(60)]
    rows += [(100, "a\n\nb\n \nc\nd"), (101, "x\na\nb\nc\n\n"), (102, "a\nb"), (103, "r\n" * 8), (104, "a\nb\nc"), (104, "a\nb\nc")]
    check(make_docs(rows), rows)


def test_odd_rows_and_empty_table(make_docs, odd):
    check(make_docs(odd), odd)
    assert line_dedup.dedup(make_docs([])).count() == 0


def test_places_of_many_equal_rows_are_merged_early(make_docs):
    text = "a\nb\nc\nd"
    docs = make_docs([(None, text)] * 400 + [(1, text)] * 400 + [(2, "other\nlines\nhere")])
    out = line_dedup.dedup(docs)
    assert out.count() == 801
    places = line_dedup.covered(line_dedup.later_windows(docs))
    assert all(len(r["gone"]) <= 4 for r in places.collect())
    assert "collect_set" in places._jdf.queryExecution().optimizedPlan().toString()
