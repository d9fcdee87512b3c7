"""Property tests: brute force on random small inputs, repeatability, plans."""

import random

import pytest

from pyspark.sql import functions as F

from costmart.catalog import QUERIES
from costmart.functions import columns as C
from costmart.functions import frames as FR
from costmart.operators import aggregates as A
from costmart.operators import similarity as SIM
from costmart.operators import windows as W
from costmart.operators.impute import knn_impute


def py_ratio(a: str, b: str) -> float:
    """Plain-Python token-set ratio (same formula, for brute force)."""
    sa, sb = set(a.split()), set(b.split())
    if not sa or not sb:
        return 0.0
    i, xa, yb = sa & sb, sa - sb, sb - sa
    if i and (not xa or not yb):
        return 100.0
    x, y = " ".join(sorted(xa)), " ".join(sorted(yb))
    s = len(" ".join(sorted(i)))
    p = 1 if s else 0
    prev = [0] * (len(y) + 1)
    for ch in x:
        cur = [0]
        for j, cy in enumerate(y, 1):
            cur.append(prev[j - 1] + 1 if ch == cy else max(prev[j], cur[j - 1]))
        prev = cur
    lcs = prev[-1]
    r = 100.0 - 100.0 * (len(x) + len(y) - 2 * lcs) / (2 * s + 2 * p + len(x) + len(y))
    if s:
        r = max(r, 100.0 - 100.0 * (p + len(x)) / (2 * s + p + len(x)),
                100.0 - 100.0 * (p + len(y)) / (2 * s + p + len(y)))
    return r


def rand_name(rng):
    return " ".join("".join(rng.choice("abcde") for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(1, 3)))


def test_best_match_equals_brute_force(spark):
    rng = random.Random(7)
    left = sorted({rand_name(rng) for _ in range(150)})
    right = sorted({rand_name(rng) for _ in range(120)})
    left += ["zzz", "zz yy", "", "axxxxxxxxxxxxxxxxxxxxxxxxxx"]  # no shared character, no token, a low score
    for threshold in (80.0, 70.0, 90.0, None):
        want = {}
        for a in left:
            best = None
            for b in right:
                s = py_ratio(a, b)
                if s >= (threshold or 0) and (best is None or s > best[1] or (s == best[1] and b < best[0])):
                    best = (b, s)
            want[a] = best
        ldf = spark.createDataFrame([(n,) for n in left], "name string")
        rdf = spark.createDataFrame([(n,) for n in right], "name string")
        got = {r.name: (r.match, r.score) if r.match is not None else None
               for r in SIM.best_match_names(ldf, rdf, threshold).collect()}
        assert {k: (v[0], round(v[1], 9)) if v else None for k, v in got.items()} == \
               {k: (v[0], round(v[1], 9)) if v else None for k, v in want.items()}


def test_knn_equals_brute_force(spark):
    rng = random.Random(3)
    rows = []
    for k in range(400):
        size = None if rng.random() < 0.1 else float(rng.randint(0, 40))
        cost = None if rng.random() < 0.3 else round(rng.uniform(1, 100), 2)
        rows.append((k, size, cost))
    donors = [(k, s, c) for k, s, c in rows if s is not None and c is not None]
    mean_all = sum(c for _, _, c in rows if c is not None) / sum(1 for r in rows if r[2] is not None)
    want = {}
    for k, s, c in rows:
        if c is not None:
            want[k] = c
        elif s is None:
            want[k] = mean_all
        else:
            near = sorted(donors, key=lambda d: (abs(d[1] - s), d[0]))[:3]
            want[k] = sum(d[2] for d in near) / len(near)
    df = spark.createDataFrame(rows, "k int, size double, cost double")
    for buckets in (1, 5, 64):
        got = {r.k: r.cost for r in knn_impute(df, "cost", "size", "k", buckets=buckets).collect()}
        assert {k: round(v, 9) for k, v in got.items()} == {k: round(v, 9) for k, v in want.items()}


def test_knn_has_no_bucket_limit_and_no_literal_bounds(spark):
    """2,500 ranges, most of them with donors on one side only, against brute force on a sample of recipients."""
    rng = random.Random(4)
    rows = [(i, i / 7 + (0.01 if i % 3 else 0.0), None if i % 5 else float(rng.randint(1, 1000))) for i in range(5000)]
    rows += [(9000 + i, 2000.0 + i / 3, None) for i in range(300)]  # ranges without donors
    df = spark.createDataFrame(rows, "k int, size double, cost double")
    out = knn_impute(df, "cost", "size", "k", buckets=2500)
    assert len(_plan(out)) < 20_000  # no bounds in it
    got = {r.k: r.cost for r in out.collect()}
    donors = [(s, k, c) for k, s, c in rows if c is not None]
    for k, s, c in rows[::37] + rows[-300::50]:
        near = sorted(donors, key=lambda d: (abs(d[0] - s), d[1]))[:3]
        want = c if c is not None else sum(d[2] for d in near) / 3
        assert round(got[k], 9) == round(want, 9), k


def test_redraw_range_and_repeatability(spark):
    df = spark.range(0, 5000).select("id", F.when(F.col("id") % 3 == 0, 400.0).otherwise(F.col("id") / 100).alias("c"))
    out = df.select("id", "c", C.redraw_capped("c", ["id"]).alias("x"))
    rows = out.collect()
    assert all(100.0 <= r.x < 400.0 for r in rows if r.c == 400.0)
    assert all(r.x == r.c for r in rows if r.c != 400.0)
    again = {r.id: r.x for r in out.repartition(7).collect()}
    assert again == {r.id: r.x for r in rows}


def test_assign_category_membership_and_balance(spark):
    choices = spark.createDataFrame([(s,) for s in ["CA", "NY", "TX", "WA"]], "State string")
    df = spark.range(0, 8000).withColumnRenamed("id", "stay_id")
    out = FR.assign_random_category(df, ["stay_id"], choices, "State", "State")
    counts = {r.State: r["count"] for r in out.groupBy("State").count().collect()}
    assert set(counts) == {"CA", "NY", "TX", "WA"} and min(counts.values()) > 1700
    again = FR.assign_random_category(df.repartition(3), ["stay_id"], choices, "State", "State")
    assert out.exceptAll(again).count() == 0


def test_results_independent_of_shuffle_partitions(spark):
    df = spark.range(0, 3000).select((F.col("id") % 17).alias("k"), (F.col("id") * 7 % 11).alias("v"), "id")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    res = []
    for n in ("1", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        res.append((sorted(A.first_per_key(df, ["k"], ["v", "id"]).collect()),
                    sorted(W.modal_value(df, ["k"], "v").collect())))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert res[0] == res[1]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_k_uses_window_group_limit(spark):
    df = spark.range(0, 1000).select((F.col("id") % 5).alias("g"), "id", (F.col("id") * 13 % 101).alias("m"))
    top = W.top_k_per_group(df, ["g"], "m", 5, tie=["id"])
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert "WindowGroupLimit" in _plan(top)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_no_python_udf_cross_join_or_nested_loop(spark, sf_dir):
    bad = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin")
    skip = {"drug_price_list"}  # checkpoints inside; its parts are covered by other queries
    for name, fn in QUERIES.items():
        if name in skip:
            continue
        plan = _plan(fn(spark, sf_dir))
        assert not any(b in plan for b in bad), (name, [b for b in bad if b in plan])


@pytest.mark.parametrize("name", ["cost_reports", "describe_numeric", "group_stats", "drug_price_list", "medicine_mapping"])
def test_plans_before_materialisation(spark, sf_dir, name, tmp_path):
    """Every plan a query runs, those it writes or collects on the way included (from the event stream of executions)."""
    seen = []
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    QUERIES[name](spark, sf_dir).collect()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    executions = store.executionsList()
    for i in range(executions.size()):
        e = executions.apply(i)
        if e.executionId() >= before:
            seen.append(e.physicalPlanDescription())
    assert len(seen) > 1
    bad = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "collect_list(_x")
    assert not any(b in plan for plan in seen for b in bad)


def test_cost_reports_reads_the_mart_three_times(spark, sf_dir, monkeypatch):
    """However many reports: the mart is built once, written once, and its written columns are scanned in three plans."""
    from costmart.plans import reports

    from costmart.operators import quantiles

    reads, built = [], []

    def watch(df, name, f=reports.materialize, **keep):
        files = df.inputFiles()
        reads.append(any("mart-columns" in x for x in files))
        built.append((name, any("lineitem" in x for x in files)))
        return f(df, name, **keep)

    monkeypatch.setattr(reports, "materialize", watch)
    monkeypatch.setattr(quantiles, "materialize", watch)
    QUERIES["cost_reports"](spark, sf_dir).collect()
    assert sum(reads) == 3
    assert [name for name, of_tables in built if of_tables] == ["mart-columns"]


def test_code_lookup_does_not_shuffle_events_on_drug_names(spark, sf_dir):
    plan = _plan(QUERIES["fact_cost_event"](spark, sf_dir))
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan  # exchanges are those of the small tables' own aggregates


def test_cost_events_are_shuffled_for_parts_alone(spark, sf_dir):
    """Lines meet orders once, before; price and code tables are broadcast by their counted bytes, whatever file sizes say."""
    import re

    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = [spark.conf.get(k, None) for k in names]
    try:
        for k in names:
            spark.conf.set(k, "-1")
        plan = _plan(QUERIES["fact_cost_event"](spark, sf_dir))
    finally:
        for k, v in zip(names, before):
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "orders.parquet" not in plan and "lineitem.parquet" not in plan
    assert set(re.findall(r"Exchange hashpartitioning\((\w+)#", plan)) == {"l_partkey", "p_partkey"}


@pytest.mark.parametrize("most", [32 << 20, 0])
def test_cost_events_of_repeated_and_null_keys(spark, monkeypatch, most):
    """The same events whether lookup tables are broadcast or not; repeated keys multiply, null drugs have a code of their own."""
    from costmart.plans import mart
    from costmart.session import broadcast_up_to

    monkeypatch.setattr(mart, "broadcast_up_to", lambda df: broadcast_up_to(df, most))
    lab = spark.createDataFrame([(i, 10, "t", item, i) for i, item in enumerate([1, 2, 3, 9, None])],
                                "subject_id int, hadm_id int, charttime string, itemid int, labevent_id int")
    items = spark.createDataFrame([(1, "A"), (1, " a "), (2, "B"), (3, None)], "itemid int, label string")
    lprice = spark.createDataFrame([("a", 2.5), ("b", None), (None, 9.0)], "label string, price double")
    rx = spark.createDataFrame([(i, 10, "t", drug, gsn, i) for i, (drug, gsn) in enumerate(
        [("X ", "12"), ("x", "7,8"), ("x", "12"), (None, "5 6"), (None, "6"), ("y", None)])],
        "subject_id int, hadm_id int, starttime string, drug string, gsn string, pharmacy_id int")
    dprice = spark.createDataFrame([("X", 5.0), ("x", 7.0), (None, 3.0)], "drug string, cost double")
    got = mart.fact_cost_event(lab, items, lprice, rx, dprice).select("event_type", "patient_id", "source_code", "cost").collect()
    assert sorted(map(tuple, got), key=str) == sorted(
        [("LAB", 0, "1", 2.5)] * 2 + [("LAB", 1, "2", 0.0), ("LAB", 2, "3", 0.0), ("LAB", 3, "9", 0.0), ("LAB", 4, None, 0.0)]
        + [("MED", i, "12", c) for i in range(3) for c in (5.0, 7.0)]
        + [("MED", 3, "6", 0.0), ("MED", 4, "6", 0.0), ("MED", 5, "00000", 0.0)], key=str)


def test_fact_reads_orders_for_stays_once(spark, sf_dir):
    from costmart.plans import mart
    from costmart.standins import frames as fr

    t = fr.Tables(spark, sf_dir)
    stays_only = _plan(mart.stays(fr.admissions(t), fr.icustays(t))).count("orders.parquet")
    whole = mart.fact_stay_cost(fr.admissions(t), fr.icustays(t), fr.prescriptions(t), fr.drug_price(t),
                                fr.lab_events(t), fr.lab_items(t), fr.lab_price(t))
    others = sum(_plan(d).count("orders.parquet") for d in (fr.prescriptions(t), fr.lab_events(t)))
    assert _plan(whole).count("orders.parquet") <= stays_only + others


def test_scan_prunes_columns_and_pushes_filters(spark, sf_dir):
    plan = _plan(QUERIES["scan_parquet"](spark, sf_dir))
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)]" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double,l_returnflag:string>" in plan


def test_exact_quantiles_equal_brute_force(spark):
    from costmart.operators.quantiles import exact_quantiles

    rng = random.Random(11)
    rows = []
    for i in range(6000):
        g = "hot" if i % 3 else rng.choice(["a", "b", "c"])
        v = None if rng.random() < 0.05 else (float(rng.randint(0, 50)) if rng.random() < 0.5 else rng.uniform(-1e3, 1e3))
        rows.append((g, v))
    df = spark.createDataFrame(rows, "g string, v double")
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]

    def brute(vals, p):
        vals = sorted(vals)
        h = p * (len(vals) - 1)
        lo, hi = int(h // 1), int(-(-h // 1))
        return vals[lo] if lo == hi else (hi - h) * vals[lo] + (h - lo) * vals[hi]

    got = {r.g: [r[f"q{p}"] for p in probs]
           for r in exact_quantiles(df, "v", probs, ["g"]).collect()}
    for g in got:
        vals = [v for gg, v in rows if gg == g and v is not None]
        assert [round(x, 9) for x in got[g]] == [round(brute(vals, p), 9) for p in probs], g
    one = exact_quantiles(df, "v", [0.5]).first()["q0.5"]
    assert round(one, 9) == round(brute([v for _, v in rows if v is not None], 0.5), 9)


def test_ranking_operators_equal_brute_force(spark):
    rng = random.Random(5)
    rows = []
    for i in range(3000):
        g = "hot" if rng.random() < 0.34 else rng.choice("abcdefg")
        amount = None if rng.random() < 0.1 else float(rng.randint(0, 30))  # many ties
        rows.append((i, g, amount, rng.randint(0, 4)))
    df = spark.createDataFrame(rows, "id int, g string, amount double, v int")
    groups = sorted({r[1] for r in rows})

    def top(keep_null):
        out = {}
        for g in groups:
            rs = [r for r in rows if r[1] == g and (keep_null or r[2] is not None)]
            rs.sort(key=lambda r: (r[2] is None, -(r[2] or 0), r[0]))
            if rs:
                out[g] = [r[0] for r in rs[:5]]
        return out

    for keep in (True, False):
        got = {}
        for r in sorted(W.top_k_per_group(df, ["g"], "amount", 5, tie=["id"], keep_null=keep).collect(),
                        key=lambda r: r["rank"]):
            got.setdefault(r.g, []).append(r.id)
        assert got == top(keep)
    first = {r.g: r.id for r in A.first_per_key(df.select("g", "v", "id"), ["g"], ["v", "id"]).collect()}
    assert first == {g: min((r[3], r[0]) for r in rows if r[1] == g)[1] for g in groups}
    modal = {r.g: r.m for r in W.modal_value(df, ["g"], "v", out="m").collect()}
    want = {}
    for g in groups:
        counts = {}
        for r in rows:
            if r[1] == g:
                counts[r[3]] = counts.get(r[3], 0) + 1
        want[g] = min(counts, key=lambda v: (-counts[v], v))
    assert modal == want


def test_lookup_and_histogram_equal_brute_force(spark):
    from costmart.operators.joins import lookup_either_column

    rng = random.Random(9)
    ref = [(i, rng.choice("abcdefgh") + rng.choice("xy"), rng.choice(["ax", "bx", "zz", None])) for i in range(200)]
    keys = sorted({r[1] for r in ref} | {r[2] for r in ref if r[2]} | {"nope"})
    rdf = spark.createDataFrame(ref, "ord int, drugs string, name string")
    kdf = spark.createDataFrame([(k,) for k in keys], "k string")
    got = {r.k: r.ord for r in lookup_either_column(kdf, "k", rdf, ["drugs", "name"], "ord").collect()}
    want = {k: min((r[0] for r in ref if r[1] == k or r[2] == k), default=None) for k in keys}
    assert got == want

    vals = [rng.uniform(-5, 5) for _ in range(997)] + [5.0, -5.0, None]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    hist = {r.bin: r.n for r in A.histogram_equal_width(df, "x", 30).collect()}
    xs = [v for v in vals if v is not None]
    lo, hi = min(xs), max(xs)
    want_h = {b: 0 for b in range(1, 31)}
    for v in xs:
        want_h[min(int(30 * (v - lo) / (hi - lo)) + 1, 30)] += 1
    assert hist == want_h and sum(hist.values()) == len(xs)


def test_reports_write_the_fact_once_and_equal_rows_as_one(spark, sf_dir, monkeypatch):
    """A mart's rows equal in all that the reports read are written once, with their number."""
    from costmart.plans import reports
    from costmart.standins import reports as queries

    written = {}

    def watch(df, name, f=reports.materialize, **keep):
        out = f(df, name, **keep)
        written[name] = (out.count(), out.select(*df.columns[:11]).distinct().count(), out.agg({df.columns[-1]: "sum"}).first()[0] if name == "mart-columns" else None)
        return out

    monkeypatch.setattr(reports, "materialize", watch)
    monkeypatch.setattr(queries, "materialize", watch)
    QUERIES["cost_reports"](spark, sf_dir).collect()
    rows = QUERIES["stay_mart"](spark, sf_dir).count()
    n, distinct, whole = written["mart-columns"]
    assert n == distinct < whole == rows and {"fact", "dates"} <= written.keys()
