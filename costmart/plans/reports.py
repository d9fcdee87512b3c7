"""The analysis mart and its reports.

``stay_mart`` joins the stay fact to its dimensions (the date dimension
twice, admit and discharge roles), gives each stay a state with nurse
wage and nurse-to-patient ratio, an age band, and labour / supply costs.
Dimension fan-out is kept by default, as in the reference (a patient or
admission with several dimension rows multiplies its stays);
``one_row_per_dim_key`` removes it.

``cost_reports`` renders the nine summaries of the analysis as one long
table ``(report, label, stat, value)``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.bits import from_ordered_bits, ordered_bits
from ..functions.columns import AGE_LABELS, bin_labels, derive_total, labor_cost, month_period, nurse_hours, parse_ratio
from ..functions.frames import assign_random_category, number_choices, suffix_columns, to_day
from ..operators import aggregates as A
from ..operators.joins import join_star
from ..operators.quantiles import first_cell, quantiles_of_cells
from ..session import materialize, scratch_scope

NUMERIC = ("total_icu_days", "lab_tests_cost", "medicine_cost", "total_cost")
# What the reports read of the mart.
REPORT_COLUMNS = (*NUMERIC, "unit_type", "admit_month", "survived", "drg_category", "age_group", "labor_cost", "supply_cost")


def stay_mart(fact: DataFrame, dim_patient: DataFrame, dim_admission: DataFrame, dim_icu_unit: DataFrame,
              dim_date: DataFrame, nurse_wages: DataFrame, nurse_ratios: DataFrame,
              state_pick: Column | None = None, one_row_per_dim_key: bool = False, seed: int = 42) -> DataFrame:
    """Stays with all dimension attributes, staffing and labour / supply costs.

    ``nurse_wages``: State, hourly_wage; ``nurse_ratios``: State (may carry
    spaces), nurse_patient_ratio ``'a:b'``. Each stay gets a repeatable
    pseudo-random state (hash of the stay id), or ``state_pick`` (an integer
    column: the ordinal of the state among the sorted distinct states).
    """
    f = fact.withColumns({"_admit_day": to_day(fact, "icu_admit_date"), "_disch_day": to_day(fact, "icu_discharge_date")})
    dd = dim_date
    # dimensions with one row per stay first, so their joins see stays, not fanned-out rows
    df = join_star(f, [(dim_icu_unit, "stay_id", "unit_id"),
                       (suffix_columns(dd, "_adm"), "_admit_day", "calendar_date_adm"),
                       (suffix_columns(dd, "_dis"), "_disch_day", "calendar_date_dis")],
                   one_row_per_dim_key=one_row_per_dim_key).drop("_admit_day", "_disch_day")
    if state_pick is None:
        df = assign_random_category(df, ["stay_id"], nurse_wages, "State", "State", seed=seed)
    else:
        states = nurse_wages.select("State").where(F.col("State").isNotNull()).distinct()
        n = states.count()
        df = (df.withColumn("_ord", F.pmod(state_pick.cast("long"), F.lit(n)))
                .join(number_choices(states, "State"), "_ord", "left").drop("_ord"))
    # staffing tables are one row per state: Spark broadcasts them by its byte threshold
    wages = nurse_wages.select("State", "hourly_wage")
    ratios = nurse_ratios.select(F.trim(F.col("State")).alias("State"), "nurse_patient_ratio")
    nurses, patients = parse_ratio("nurse_patient_ratio")
    df = (df.join(wages, "State", "left").join(ratios, "State", "left")
            .withColumns({"icu_nurses": nurses, "icu_patients": patients}))
    # the dimensions that may repeat a key (several race or DRG rows) last
    df = join_star(df, [(dim_patient, "patient_id", "patient_id"), (dim_admission, "admission_id", "admission_id")],
                   one_row_per_dim_key=one_row_per_dim_key)
    return df.withColumns({
        "age_group": bin_labels("age"),
        "admit_month": month_period("calendar_date_adm"),
        "nurse_hours": nurse_hours("total_icu_days", "icu_patients"),
        "labor_cost": labor_cost("total_icu_days", "icu_patients", "hourly_wage"),
        # the reference multiplies by the days twice; the single-count form under its own name
        "labor_cost_hours_only": labor_cost("total_icu_days", "icu_patients", "hourly_wage", as_reference=False),
        "supply_cost": derive_total("lab_tests_cost", "medicine_cost"),
    }).withColumn("total_cost_all", F.col("total_cost") + F.col("labor_cost"))


def _long(df: DataFrame, report: str, label: Column, stats: dict[str, Column]) -> DataFrame:
    """(report, label, stat, value): all statistics of a row unpivoted at once, so ``df`` is read once."""
    pairs = F.array(*[F.struct(F.lit(s).alias("stat"), v.cast("double").alias("value")) for s, v in stats.items()])
    return df.select(F.lit(report).alias("report"), label.cast("string").alias("label"), F.explode(pairs).alias("_p")).select("report", "label", "_p.*")


def _finest(m: DataFrame) -> DataFrame:
    """(report, label, x, _w, _i): the mart's rows once for every report that groups them, each with the number
    of mart rows it stands for and the image of the values whose quantiles are needed (``functions.bits``)."""
    cost = F.col("total_cost").cast("double")
    of = [("describe", F.lit(c), F.col(c).cast("double")) for c in NUMERIC]
    of += [("drg_top_mean", F.col("drg_category"), cost), ("mean_cost_by_unit", F.col("unit_type"), cost),
           ("stays_per_month", F.date_format("admit_month", "yyyy-MM"), cost), ("mean_cost_by_outcome", F.col("survived"), cost),
           ("mean_cost_by_age", F.col("age_group"), cost)]
    entries = F.array(*[F.struct(F.lit(r).alias("report"), label.cast("string").alias("label"), x.alias("x")) for r, label, x in of])
    rows = m.select("_w", F.explode(entries).alias("_e")).select("_e.*", "_w").where(F.col("label").isNotNull())
    return rows.withColumn("_i", F.when(F.col("report").isin("describe", "drg_top_mean"), ordered_bits(F.col("x"))))


def cost_reports(mart: DataFrame | Callable[[], DataFrame], bins: int = 30, top_drg: int = 10) -> DataFrame:
    """The nine summaries: describe, stay-length histogram, mean cost by unit type,
    stays per month, mean cost by outcome, correlations, DRG stats (top by mean),
    mean cost by age band (all bands), labour vs supply shares.

    Runs eagerly, over the mart's eleven columns written once, rows equal in all of them as one with their number
    (a stay's rows repeat with its patient's and admission's attributes), in three reads whatever the number of reports:
    one for the aggregates of the whole mart (moments, correlations, money sums); one
    for all that groups it, its rows exploded by (report, label) and partially aggregated at once, by cells
    of leading bits where a quantile or the histogram needs them; one for the rows of
    those few cells that hold a quantile or are cut by a bin's edge. All else reads small tables.
    What is written on the way is deleted when the result is; of a function that makes the mart, what it writes too.
    """
    with scratch_scope(SparkSession.active() if callable(mart) else mart.sparkSession):
        return _cost_reports(mart() if callable(mart) else mart, bins, top_drg)


def _cost_reports(mart: DataFrame, bins: int, top_drg: int) -> DataFrame:
    m = materialize(mart.groupBy(*REPORT_COLUMNS).agg(F.count(F.lit(1)).alias("_w")), "mart-columns")
    corr = [A.corr_complete(a, b).alias(f"corr__{a}__{b}") for i, a in enumerate(NUMERIC) for b in NUMERIC[i:]]
    money = [A.money_sum(c).alias(c) for c in ("labor_cost", "supply_cost")]
    every = m.select(*REPORT_COLUMNS, F.explode(F.sequence(F.lit(1).cast("long"), "_w")))
    whole = materialize(every.agg(*[x for c in NUMERIC for x in A.moments(c)], *corr, *money), "mart-whole")

    finest = _finest(m)
    grouped = materialize(finest.groupBy("report", "label", first_cell(F.col("_i")).alias("_cell")).agg(
        F.sum("_w").alias("rows"), F.sum(F.when(F.col("x").isNull(), 0).otherwise(F.col("_w"))).alias("_c"), F.sum(F.col("x") * F.col("_w")).alias("total"),
        F.min("_i").alias("_lo"), F.max("_i").alias("_hi")), "mart-grouped")
    cells = grouped.where(F.col("_cell").isNotNull())
    stays = (cells.where((F.col("report") == "describe") & (F.col("label") == "total_icu_days"))
                  .withColumns({"_min": from_ordered_bits(F.col("_lo")), "_max": from_ordered_bits(F.col("_hi"))}))
    finite = ~F.isnan("_max") & (F.abs("_max") < F.lit(float("inf")))
    lo, hi = A.bin_edges(*stays.where(finite).agg(F.min("_min"), F.max("_max")).first())
    folded = A.fold_cells(stays.where(finite), lo, hi, bins) if lo is not None else stays.where(F.lit(False)).withColumns({"_bin": F.lit(1), "_last": F.lit(1)})
    cut = folded.where(F.col("_bin") < F.col("_last"))
    src = finest.where(F.col("_i").isNotNull()).select("report", "label", "_i", "_w")
    quart, rows = quantiles_of_cells(src, cells.select("report", "label", "_cell", "_c", "_lo", "_hi"), [0.25, 0.5, 0.75], ["report", "label"],
                                     ["q25", "q50", "q75"], also=cut, weight="_w")

    border = rows.join(cut.select("report", "label", "_cell"), ["report", "label", "_cell"], "left_semi")
    x = from_ordered_bits(F.col("_i"))
    counts = folded.where(F.col("_bin") == F.col("_last")).select(F.col("_bin").alias("bin"), F.col("_c").alias("n"))
    if lo is not None:
        counts = counts.unionByName(border.groupBy(A.bin_of(x, lo, hi, bins).alias("bin")).agg(F.sum("_w").alias("n")))
    hist = A.list_bins(counts, lo, hi, bins, stays.where(~finite).select(F.col("_max").alias("value"), F.col("_c").alias("n")))

    sums = grouped.groupBy("report", "label").agg(F.sum("rows").alias("rows"), F.sum("_c").alias("n"), F.sum("total").alias("total"))
    sums = sums.withColumn("mean", F.try_divide("total", "n"))
    of = lambda report: sums.where(F.col("report") == report)
    drg = of("drg_top_mean").join(quart.where(F.col("report") == "drg_top_mean").select(F.col("label").alias("_l"), F.col("q50").alias("median")),
                                  F.col("label") == F.col("_l"), "left")
    drg = A.limit_n(drg, top_drg, [F.col("mean").desc(), F.col("label")])
    ages = m.sparkSession.createDataFrame([(a,) for a in AGE_LABELS], "age string")
    age = ages.join(of("mean_cost_by_age"), F.col("age") == F.col("label"), "left")
    total = F.coalesce("labor_cost", F.lit(0.0)) + F.coalesce("supply_cost", F.lit(0.0))
    share = lambda c: F.try_divide(F.col(c) * F.lit(100.0), total)
    pairs = {f"{a}|{b}": f"corr__{min((a, b), key=NUMERIC.index)}__{max((a, b), key=NUMERIC.index)}" for a in NUMERIC for b in NUMERIC}
    parts = [
        *[_long(whole, "describe", F.lit(c), {s: F.col(f"{s}__{c}") for s in ("count", "mean", "std", "min", "max")}) for c in NUMERIC],
        # a column without values has its quartiles listed too
        _long(m.sparkSession.createDataFrame([(c,) for c in NUMERIC], "c string").join(
            quart.where(F.col("report") == "describe"), F.col("c") == F.col("label"), "left"),
              "describe", F.col("c"), {"25%": F.col("q25"), "50%": F.col("q50"), "75%": F.col("q75")}),
        _long(hist, "icu_days_histogram", F.col("bin"), {"n": F.col("n"), "bin_lo": F.col("bin_lo")}),
        _long(of("mean_cost_by_unit"), "mean_cost_by_unit", F.col("label"), {"mean": F.col("mean")}),
        _long(of("stays_per_month"), "stays_per_month", F.col("label"), {"count": F.col("rows")}),
        _long(of("mean_cost_by_outcome"), "mean_cost_by_outcome", F.col("label"), {"mean": F.col("mean")}),
        *[_long(whole, "correlation", F.lit(k), {"corr": F.col(c)}) for k, c in pairs.items()],
        _long(drg, "drg_top_mean", F.col("label"), {"mean": F.col("mean"), "median": F.col("median"), "count": F.col("n")}),
        _long(age, "mean_cost_by_age", F.col("age"), {"mean": F.col("mean")}),
        _long(whole, "labor_supply_share", F.lit("all"), {"labor_sum": F.col("labor_cost"), "supply_sum": F.col("supply_cost"),
                                                           "labor_pct": share("labor_cost"), "supply_pct": share("supply_cost")}),
    ]
    return materialize(reduce(lambda a, b: a.unionByName(b), parts), "cost-reports", keep=True)
