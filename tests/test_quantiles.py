"""Order-preserving longs, radix selection and histograms against plain Python."""

import math
import random
import struct

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from costmart.functions.bits import from_ordered_bits, ordered_bits
from costmart.operators import quantiles as Q

INF, NAN = float("inf"), float("nan")
EDGES = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308, INF, -INF, NAN, 1.0, -1.0, 0.1]


def image(x: float) -> int:
    if x != x:
        return 0x7FF8 << 48
    bits = struct.unpack("<q", struct.pack("<d", abs(x)))[0]
    return ~bits if x < 0 else bits


def same(a, b):
    return a == b or (a != a and b != b)


def test_images_are_the_bits_and_come_back(spark):
    r = random.Random(1)
    xs = EDGES + [struct.unpack("<d", struct.pack("<Q", r.getrandbits(64)))[0] for _ in range(5000)]
    xs += [s * 2.0 ** e * f for e in range(-1074, 1024, 7) for f in (1.0, 1 + 2**-52, 1 - 2**-53) for s in (1, -1)]
    xs = [NAN if x != x else x for x in xs]
    df = spark.createDataFrame([(x,) for x in [*xs, None]], "x double")
    got = df.select("x", ordered_bits(F.col("x")).alias("i")).withColumn("y", from_ordered_bits(F.col("i"))).collect()
    for r in got:
        assert (r.i is None and r.y is None) if r.x is None else (r.i == image(r.x) and same(r.y, r.x)), r


def brute(vals, p):
    vals = sorted(vals, key=lambda v: (v != v, v))
    h = p * (len(vals) - 1)
    lo, hi = vals[int(h // 1)], vals[int(-(-h // 1))]
    return lo if same(lo, hi) else (math.ceil(h) - h) * lo + (h - math.floor(h)) * hi


def checked(got, vals, probs):
    for x, p in zip(got, probs):
        want = brute(vals, p)
        assert same(x, want) or math.isclose(x, want, rel_tol=1e-12), (p, x, want)


PROBS = [0.0, 0.25, 0.5, 0.75, 0.9, 1.0]


@pytest.mark.parametrize("extra", [[INF], [NAN], [INF, -INF, NAN], [INF] * 60 + [NAN] * 60, [-INF] * 200])
def test_non_finite_values_end_within_the_passes(spark, monkeypatch, extra):
    written = []
    monkeypatch.setattr(Q, "materialize", lambda df, name, f=Q.materialize, **k: (written.append(name), f(df, name, **k))[1])
    vals = [float(i) for i in range(100)] + extra
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = Q.exact_quantiles(df, "x", PROBS).first()
    checked(got, vals, PROBS)
    assert written.count("quantile-targets") <= len(Q.DIGITS) and written.count("quantile-rows") <= 1


@settings(max_examples=15, deadline=None)
@given(data=st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.none() | st.floats() | st.integers(-3, 3).map(float)), min_size=1, max_size=60))
def test_any_doubles_with_null_groups(spark, data):
    df = spark.createDataFrame(data, "g string, x double")
    got = {r.g: [r[f"q{p}"] for p in PROBS] for r in Q.exact_quantiles(df, "x", PROBS, ["g"]).collect()}
    groups = {g for g, v in data if v is not None}
    assert set(got) == groups
    for g in groups:
        vals = [v for k, v in data if k == g and v is not None]
        if all(abs(v) < 1e300 for v in vals):  # beyond, the interpolation itself may overflow
            checked(got[g], vals, PROBS)


def test_values_that_differ_in_the_last_bit_take_all_passes(spark, monkeypatch):
    written = []
    monkeypatch.setattr(Q, "materialize", lambda df, name, f=Q.materialize, **k: (written.append(name), f(df, name, **k))[1])
    vals = [math.nextafter(1.0, 2.0) + i * 2**-52 for i in range(300)]
    checked(Q.exact_quantiles(spark.createDataFrame([(v,) for v in vals], "x double"), "x", PROBS).first(), vals, PROBS)
    assert written.count("quantile-targets") == len(Q.DIGITS)


def test_empty_and_all_null(spark):
    for rows in ([], [(None,)]):
        df = spark.createDataFrame(rows, "x double")
        assert Q.exact_quantiles(df, "x", PROBS).count() == 0


def hist_brute(vals, bins):
    xs = [v for v in vals if math.isfinite(v)]
    out = {b: 0 for b in range(1, bins + 1)}
    if xs:
        lo, hi = min(xs), max(xs)
        if lo == hi:
            lo, hi = (lo - 0.001 * abs(lo), hi + 0.001 * abs(hi)) if lo else (-0.001, 0.001)
        for v in xs:
            out[min(int(bins * (v - lo) / (hi - lo)) + 1, bins)] += 1
    for v, b in ((-INF, 0), (INF, bins + 1)):
        if vals.count(v):
            out[b] = vals.count(v)
    if any(v != v for v in vals):
        out[bins + 2] = sum(v != v for v in vals)
    return out


@pytest.mark.parametrize("vals", [[float(i) for i in range(100)] + [INF], [float(i) for i in range(100)] + [NAN, -INF], [NAN, NAN], [], [3.0] * 7 + [INF], [0.0],
                                  [1000 + i / 997 for i in range(997)], [random.Random(2).uniform(-1e6, 1e6) for _ in range(3000)] + [NAN]])
@pytest.mark.parametrize("bins", [1, 7, 30])
def test_histogram_equals_brute_force(spark, vals, bins):
    from costmart.operators.aggregates import histogram_equal_width

    df = spark.createDataFrame([(v,) for v in [*vals, None]], "x double")
    rows = histogram_equal_width(df, "x", bins).collect()
    assert {r.bin: r.n for r in rows} == hist_brute(vals, bins)
    finite = sorted((r for r in rows if 1 <= r.bin <= bins), key=lambda r: r.bin)
    assert all(a.bin_hi is None or math.isclose(a.bin_hi, b.bin_lo, rel_tol=1e-9, abs_tol=1e-9) for a, b in zip(finite, finite[1:]))


def test_histogram_reads_border_cells_by_pushed_filters(spark, sf_dir):
    from costmart.operators.aggregates import histogram_equal_width

    out = histogram_equal_width(spark.read.parquet(f"{sf_dir}/lineitem.parquet"), "l_extendedprice", 30)
    plan = out._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "lineitem.parquet" in line]
    assert len(scans) == 1 and "PushedFilters: [Or(" in scans[0]  # what is left after the one full scan
