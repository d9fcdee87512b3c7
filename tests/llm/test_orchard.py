import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql.types import ArrayType, DoubleType, FloatType, IntegerType, LongType, StringType, StructField, StructType

from costmart.llm import orchard


def brute(vectors, parts, entries, rounds):
    """{(id, code, error)} and the codebooks' digest, every entry measured."""
    rows = [(i, [int(np.floor(256.0 * c)) for c in v], label) for i, v, label in vectors
            if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = max(1, -(-max(len(x) for _, x, _ in rows) // parts))
    x = np.array([v + [0] * (parts * width - len(v)) for _, v, _ in rows], dtype=object).reshape(-1, parts, width)
    books = x[:entries].transpose(1, 0, 2).copy()

    def assign():
        d = ((x[:, :, None, :] - books[None]) ** 2).sum(axis=3)
        code = [[min(range(books.shape[1]), key=lambda e: (d[r, p, e], e)) for p in range(parts)] for r in range(len(x))]
        return code, [sum(d[r, p, code[r][p]] for p in range(parts)) for r in range(len(x))]

    for _ in range(rounds):
        code, _error = assign()
        for p in range(parts):
            for e in range(books.shape[1]):
                mine = [x[r, p] for r in range(len(x)) if code[r][p] == e]
                if mine:
                    books[p, e] = [s // len(mine) for s in np.sum(mine, axis=0)]
    code, error = assign()
    by_label = {}
    for (_, _, label), e in zip(rows, error):
        by_label[label] = by_label.get(label, 0) + e
    digest = hashlib.sha256(",".join(str(v) for v in books.ravel()).encode()).hexdigest()
    return sorted((r[0] is None, r[0] or 0, "".join(f"{c:02x}" for c in cs), e, by_label[r[2]], digest)
                  for r, cs, e in zip(rows, code, error))


def table(spark, rows, component=FloatType(), label=IntegerType()):
    schema = StructType([StructField("vec_id", LongType()), StructField("embedding", ArrayType(component)), StructField("label", label),
                         StructField("x", IntegerType()), StructField("code", StringType()), StructField("of", IntegerType())])
    return spark.createDataFrame([(*r, 1, "c", 2) for r in rows], schema).repartition(3)


def found(df):
    return sorted((r.vec_id is None, r.vec_id or 0, r.code, r.error, r.label_error, r.codebooks_sha256) for r in df.collect())


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**32 - 1), st.integers(1, 40), st.integers(1, 5), st.sampled_from([2, 9, 300]))
def test_search_finds_the_nearest_entry(seed, m, width, spread):
    r = np.random.default_rng(seed)
    books = r.integers(-spread, spread, (3, m, width))  # small spreads have equal entries and ties
    x = r.integers(-spread, spread, (50, 3, width))
    code, near = orchard.Codebooks(books).nearest(x)
    d = ((x[:, :, None, :] - books[None]) ** 2).sum(axis=3)
    assert (near == d.min(axis=2)).all() and (code == d.argmin(axis=2)).all()


def test_equals_brute_force_with_odd_rows(llm):
    r = np.random.default_rng(5)
    rows = [(int(i), [float(np.float32(c)) for c in r.normal(0, 1, 8)], int(i) % 3) for i in range(60)]
    rows += [(100 + i, [0.5] * 8, None) for i in range(40)]  # a hot vector without a label
    rows += [(200, None, 1), (201, [None] * 8, 1), (202, [float("nan")] + [0.0] * 7, 1), (203, [float("inf")] + [0.0] * 7, 2), (204, [0.0] * 7 + [float("-inf")], 2),
             (205, [], 1), (206, [1.0, -2.0], 7), (None, [0.25] * 8, 1), (3, [0.75] * 8, 1), (3, [0.75] * 8, 1), (3, [0.5] * 8, 2)]
    out = orchard.compress(table(llm, rows), parts=4, entries=6, rounds=2)
    assert out.columns == ["vec_id", "label", "code", "error", "label_error", "codebooks_sha256"]
    assert found(out) == brute(rows, 4, 6, 2)


def test_lengths_that_parts_do_not_divide_and_few_rows(llm):
    rows = [(i, [i / 10, -i / 7, 0.3, i / 3, 1.0], None) for i in range(5)]
    assert found(orchard.compress(table(llm, rows, DoubleType()), parts=3, entries=64, rounds=2)) == brute(rows, 3, 64, 2)


def test_far_components_count_as_the_largest(llm):
    rows = [(1, [1e30, -1e30], 1), (2, [65536.0, -65536.0], 1), (3, [0.0, 0.0], 1)]
    out = {r.vec_id: r for r in orchard.compress(table(llm, rows, DoubleType()), parts=2, entries=2, rounds=1).collect()}
    assert out[1].code == out[2].code and out[1].error == out[2].error


def test_labels_of_another_type(llm):
    rows = [(1, [0.0, 1.0], "a"), (2, [0.1, 1.0], "a"), (3, [5.0, 1.0], None)]
    out = orchard.compress(table(llm, rows, label=StringType()), parts=2, entries=1, rounds=1)
    assert found(out) == brute(rows, 2, 1, 1)


@pytest.mark.parametrize("rows", [[], [(1, None, 1), (2, [None], 1)]])
def test_nothing_left(llm, rows):
    out = orchard.compress(table(llm, rows))
    assert out.count() == 0 and out.columns == ["vec_id", "label", "code", "error", "label_error", "codebooks_sha256"]
