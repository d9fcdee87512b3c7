"""Native expressions vs plain-Python statements of their semantics, on random text."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from costmart.functions import columns as C
from costmart.functions import frames as FR

TEXT = st.text(alphabet="ab /(),\t\n5", max_size=14)


def py_unit_type(name):
    m = re.search(r"\((.*?)\)", name)
    if not m or m.group(1) == "":
        return None
    return m.group(1).split("/")[0]


def py_tokens(codes):
    return [t for t in codes.replace(",", " ").split() if t]


@settings(max_examples=25, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=40))
def test_unit_type_semantics(spark, names):
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, name string")
    got = [r.t for r in df.select("i", C.unit_type("name").alias("t")).orderBy("i").collect()]
    assert got == [py_unit_type(n) for n in names]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["d1", "d2"]), TEXT), min_size=1, max_size=40))
def test_code_resolution_semantics(spark, rows):
    df = spark.createDataFrame([(i, d, g) for i, (d, g) in enumerate(rows)], "i int, drug string, gsn string")
    toks = [r.t for r in df.select("i", C.code_tokens("gsn").alias("t")).orderBy("i").collect()]
    assert toks == [py_tokens(g) for _, g in rows]
    # modal token per drug over all rows (ties: smallest token)
    counts = {}
    for d, g in rows:
        for t in py_tokens(g):
            counts.setdefault(d, {}).setdefault(t, 0)
            counts[d][t] += 1
    modal = {d: min(c, key=lambda t: (-c[t], t)) for d, c in counts.items()}
    want = []
    for d, g in rows:
        t = py_tokens(g)
        if not g.strip():
            want.append("00000")
        elif len(t) == 1:
            want.append(t[0])
        else:
            want.append(modal.get(d) or (t[0] if t else "00000"))
    modal_df = spark.createDataFrame(list(modal.items()) or [("none", "x")], "drug_name string, code string")
    got = [r.code for r in FR.resolve_code(df, "drug", "gsn", modal_df, "drug_name", "code", "code")
           .orderBy("i").collect()]
    assert got == want


def py_extract_count(size, name):
    if size is not None:
        return float(size)
    if name is not None and "tab" in name.lower():
        m = re.search(r"(\d+)", name)
        if m:
            return float(int(m.group(1)))
    return None


def py_band(age):
    if age is None:
        return None
    for lo, hi, lab in zip(C.AGE_EDGES[:-1], C.AGE_EDGES[1:], C.AGE_LABELS):
        if lo < age <= hi:
            return lab
    return None


@settings(max_examples=20, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 60)),
                          st.one_of(st.none(), st.text(alphabet="TaBb 0123x:", max_size=10)),
                          st.one_of(st.none(), st.integers(-5, 1100))), min_size=1, max_size=40))
def test_count_band_ratio_semantics(spark, rows):
    df = spark.createDataFrame([(i, s, n, a) for i, (s, n, a) in enumerate(rows)],
                               "i int, size int, name string, age int")
    nurses, patients = C.parse_ratio("name")
    out = df.select("i", C.extract_count("size", "name").alias("pc"), C.bin_labels("age").alias("band"),
                    nurses.alias("a"), patients.alias("b")).orderBy("i").collect()
    for r, (s, n, a) in zip(out, rows):
        assert r.pc == py_extract_count(s, n)
        assert r.band == py_band(a)
        if n is None:
            assert (r.a, r.b) == (None, None)
        else:
            parts = n.split(":")

            def num(x):
                try:
                    return float(x.strip())
                except ValueError:
                    return None
            assert (r.a, r.b) == (num(parts[0]), num(parts[1]) if len(parts) > 1 else None)
