"""Registered queries: aggregations.

Statistics over doubles are rounded to 6 decimals on both sides: a sum
of doubles depends on the order partial results arrive in.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..catalog import register
from ..functions import columns as C
from ..operators import aggregates as A
from ..operators import nested as N
from . import frames as fr


def _t(spark, sf_dir):
    return fr.Tables(spark, sf_dir)


def _round(df, cols, n=6):
    return df.withColumns({c: F.round(c, n) for c in cols})


@register("distinct_project", "select distinct o_custkey, o_orderpriority from orders")
def q_distinct_project(spark, sf_dir):
    return A.distinct_project(_t(spark, sf_dir).orders, ["o_custkey", "o_orderpriority"])


@register("sum_by_key", """
select l_orderkey, cast(sum(cast(l_extendedprice as decimal(28,10))) as double) as medicine_cost
from lineitem group by l_orderkey""")
def q_sum_by_key(spark, sf_dir):
    return A.sum_by_key(_t(spark, sf_dir).lineitem, ["l_orderkey"], "l_extendedprice", "medicine_cost")


NULL_KEY = "case when o_orderkey % 9 = 0 then null else o_orderpriority end"


@register("group_stats", f"""
select {NULL_KEY} as priority, round(avg(o_totalprice), 6) as mean, round(median(o_totalprice), 6) as median,
       count(o_totalprice) as count
from orders where {NULL_KEY} is not null group by 1""")
def q_group_stats(spark, sf_dir):
    o = _t(spark, sf_dir).orders.select(F.expr(NULL_KEY).alias("priority"), "o_totalprice")
    return _round(A.group_stats(o, ["priority"], "o_totalprice"), ["mean", "median"])


@register("group_mean_all_labels", """
with b as (select case when p_size > 0 and p_size <= 18 then 'child' when p_size > 18 and p_size <= 40 then 'adult'
                       when p_size > 40 and p_size <= 65 then 'senior' when p_size > 65 and p_size <= 999 then 'elderly'
                  end as age_group, p_retailprice from part),
l as (select * from (values ('child', 0), ('adult', 1), ('senior', 2), ('elderly', 3)) v(age_group, label_order)),
m as (select age_group, avg(p_retailprice) as mean from b where age_group is not null group by 1)
select l.age_group, l.label_order, round(m.mean, 6) as mean from l left join m on l.age_group = m.age_group""")
def q_group_mean_all_labels(spark, sf_dir):
    p = _t(spark, sf_dir).part.select(C.bin_labels("p_size").alias("age_group"), "p_retailprice")
    return _round(A.group_mean_all_labels(p, "age_group", "p_retailprice", C.AGE_LABELS), ["mean"])


@register("nested_group", "select c_nationkey, c_custkey, c_name, c_acctbal, c_mktsegment from customer")
def q_nested_group(spark, sf_dir):
    """Whole customer rows per nation, one row per member."""
    return N.nested_group(_t(spark, sf_dir).customer, ["c_nationkey"], cols=["c_custkey", "c_name", "c_acctbal", "c_mktsegment"])


@register("first_per_key", """
select p_name, arg_min(p_partkey, p_partkey) as p_partkey, arg_min(p_brand, p_partkey) as p_brand,
       arg_min(p_retailprice, p_partkey) as p_retailprice
from part group by p_name""")
def q_first_per_key(spark, sf_dir):
    p = _t(spark, sf_dir).part.select("p_name", "p_partkey", "p_brand", "p_retailprice")
    return A.first_per_key(p, ["p_name"], ["p_partkey"])


@register("collect_distinct", "select distinct o_custkey, l_suppkey from lineitem join orders on l_orderkey = o_orderkey")
def q_collect_distinct(spark, sf_dir):
    t = _t(spark, sf_dir)
    li, o = t.lineitem.select("l_orderkey", "l_suppkey"), t.orders.select("o_orderkey", "o_custkey")
    pairs = li.join(o, li["l_orderkey"] == o["o_orderkey"], "inner")
    return N.collect_distinct(pairs, ["o_custkey"], ["l_suppkey"])


DESCRIBE_COLS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def _describe_sql(cols):
    stats = [("count", "cast(count({c}) as double)", 1), ("mean", "avg({c})", 2), ("std", "stddev_samp({c})", 3),
             ("min", "min({c})", 4), ("25%", "quantile_cont({c}, 0.25)", 5), ("50%", "quantile_cont({c}, 0.5)", 6),
             ("75%", "quantile_cont({c}, 0.75)", 7), ("max", "max({c})", 8)]
    parts = []
    for name, f, i in stats:
        sel = ", ".join(f"round({f.format(c=c)}, 6) as {c}" for c in cols)
        parts.append(f"select '{name}' as statistic, {sel}, {i} as stat_order from lineitem")
    return "\nunion all\n".join(parts)


@register("describe_numeric", _describe_sql(DESCRIBE_COLS))
def q_describe_numeric(spark, sf_dir):
    d = A.describe_numeric(_t(spark, sf_dir).lineitem, DESCRIBE_COLS)
    return _round(d, DESCRIBE_COLS)


@register("histogram_equal_width", """
with mm as (select min(l_extendedprice) as lo, max(l_extendedprice) as hi from lineitem),
b as (select least(cast(floor(30 * (l_extendedprice - lo) / (hi - lo)) as int) + 1, 30) as bin
      from lineitem, mm where l_extendedprice is not null),
c as (select bin, count(*) as n from b group by bin),
allb as (select cast(range as int) as bin from range(1, 31))
select allb.bin, round(lo + (allb.bin - 1) * ((hi - lo) / 30), 6) as bin_lo, round(lo + allb.bin * ((hi - lo) / 30), 6) as bin_hi,
       coalesce(c.n, 0) as n
from allb left join c on allb.bin = c.bin, mm""")
def q_histogram_equal_width(spark, sf_dir):
    h = A.histogram_equal_width(_t(spark, sf_dir).lineitem, "l_extendedprice", 30)
    return _round(h, ["bin_lo", "bin_hi"])


CORR_COLS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@register("corr_matrix", "\nunion all\n".join(
    f"select '{a}' as row_col, '{b}' as col_col, round(corr({a}, {b}), 6) as corr from lineitem"
    for a in CORR_COLS for b in CORR_COLS))
def q_corr_matrix(spark, sf_dir):
    return _round(A.corr_matrix(_t(spark, sf_dir).lineitem, CORR_COLS), ["corr"])


@register("share_of_total", """
with s as (select sum(l_extendedprice) as a, sum(l_extendedprice * l_tax) as b from lineitem)
select round(a, 2) as l_extendedprice_sum, round(b, 2) as tax_amount_sum,
       round(a * 100.0 / (a + b), 6) as l_extendedprice_pct, round(b * 100.0 / (a + b), 6) as tax_amount_pct
from s""")
def q_share_of_total(spark, sf_dir):
    li = _t(spark, sf_dir).lineitem.select("l_extendedprice", (F.col("l_extendedprice") * F.col("l_tax")).alias("tax_amount"))
    s = A.share_of_total(li, ["l_extendedprice", "tax_amount"])
    return (s.withColumns({"l_extendedprice_sum": F.round("l_extendedprice_sum", 2), "tax_amount_sum": F.round("tax_amount_sum", 2)})
             .transform(lambda d: _round(d, ["l_extendedprice_pct", "tax_amount_pct"])))


# A measured column as it comes out of text coercion: "NaN" and "Infinity" are numbers of their own.
ODD_TEXT = """case when l_linenumber = 7 then 'NaN' when l_linenumber = 6 and l_partkey % 2 = 0 then 'Infinity'
     when l_linenumber = 6 then '-Infinity' when l_orderkey % 11 = 0 then 'n/a' else cast(l_extendedprice as {text}) end"""
ODD_SQL = f"o as (select l_returnflag, try_cast({ODD_TEXT.format(text='varchar')} as double) as x, l_quantity as y from lineitem)"


def odd_measures(t):
    li = t.lineitem.select("l_returnflag", F.expr(ODD_TEXT.format(text="string")).alias("raw"), "l_quantity")
    return li.select("l_returnflag", C.coerce_numeric("raw").alias("x"), F.col("l_quantity").alias("y"))


def _told(df, cols):
    """Each number as a finite value and a word for the others (null: finite)."""
    for c in cols:
        x = F.col(c)
        word = F.when(F.isnan(x), "nan").when(x == float("inf"), "inf").when(x == float("-inf"), "-inf")
        df = df.withColumns({f"{c}_word": word, c: F.when(word.isNull(), F.round(x, 6))})
    return df


def _told_sql(expr, name):
    word = f"case when isnan({expr}) then 'nan' when {expr} = 'Infinity'::double then 'inf' when {expr} = '-Infinity'::double then '-inf' end"
    return f"case when isfinite({expr}) then round({expr}, 6) end as {name}, {word} as {name}_word"


# DuckDB stops at a variance over infinities, which is NaN.
_STD = "case when count(*) filter (where not isfinite({c})) > 0 then 'NaN'::double else stddev_samp(case when isfinite({c}) then {c} end) end"
_MEAN = """case when count(*) filter (where isnan({c})) > 0 or (count(*) filter (where {c} = 'Infinity'::double) > 0 and count(*) filter (where {c} = '-Infinity'::double) > 0)
     then 'NaN'::double else avg({c}) end"""


def _describe_odd_sql():
    stats = [("count", "cast(count({c}) as double)"), ("mean", _MEAN), ("std", _STD), ("min", "min({c})"), ("25%", "quantile_cont({c}, 0.25)"),
             ("50%", "quantile_cont({c}, 0.5)"), ("75%", "quantile_cont({c}, 0.75)"), ("max", "max({c})")]
    one = ",\n".join(f"{f.format(c=c)} as {c}{i}" for i, (_, f) in enumerate(stats) for c in "xy")
    rows = "\nunion all\n".join(f"select '{n}' as statistic, {_told_sql(f'x{i}', 'x')}, {_told_sql(f'y{i}', 'y')}, {i + 1} as stat_order from s"
                                for i, (n, _) in enumerate(stats))
    return f"with {ODD_SQL}, s as (select {one} from o)\n{rows}"


@register("describe_numeric_nonfinite", _describe_odd_sql())
def q_describe_numeric_nonfinite(spark, sf_dir):
    """describe over a coerced text column that holds NaN and both infinities."""
    return _told(A.describe_numeric(odd_measures(_t(spark, sf_dir)), ("x", "y")), ("x", "y")).select(
        "statistic", "x", "x_word", "y", "y_word", "stat_order")


@register("group_stats_nonfinite", f"""
with {ODD_SQL},
g as (select l_returnflag, {_MEAN.format(c='x')} as a, quantile_cont(x, 0.5) as b, count(x) as count from o group by l_returnflag)
select l_returnflag, {_told_sql('a', 'mean')}, {_told_sql('b', 'median')}, count from g""")
def q_group_stats_nonfinite(spark, sf_dir):
    g = A.group_stats(odd_measures(_t(spark, sf_dir)), ["l_returnflag"], "x")
    return _told(g, ("mean", "median")).select("l_returnflag", "mean", "mean_word", "median", "median_word", "count")


@register("histogram_equal_width_nonfinite", f"""
with {ODD_SQL},
f as (select x from o where isfinite(x)),
mm as (select min(x) as lo, max(x) as hi from f),
b as (select least(cast(floor(30 * (x - lo) / (hi - lo)) as int) + 1, 30) as bin from f, mm),
c as (select bin, count(*) as n from b group by bin),
allb as (select cast(range as int) as bin from range(1, 31)),
w as (select case when isnan(x) then 32 when x > 0 then 31 else 0 end as bin, case when isnan(x) then 'nan' when x > 0 then 'inf' else '-inf' end as word,
             count(*) as n from o where x is not null and not isfinite(x) group by all)
select allb.bin, round(lo + (allb.bin - 1) * ((hi - lo) / 30), 6) as bin_lo, cast(null as varchar) as bin_lo_word, coalesce(c.n, 0) as n
from allb left join c on allb.bin = c.bin, mm
union all
select bin, null, word, n from w""")
def q_histogram_equal_width_nonfinite(spark, sf_dir):
    h = A.histogram_equal_width(odd_measures(_t(spark, sf_dir)), "x", 30)
    return _told(h, ("bin_lo",)).select("bin", "bin_lo", "bin_lo_word", "n")
