"""Registered queries: the analysis mart and its nine reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..catalog import register
from ..plans import mart as MT
from ..plans import reports as RP
from ..session import materialize
from . import frames as fr
from .sql import FACT_WITH, CTE

UNIT_TYPE_SQL = """case when regexp_extract(first_careunit, '\\((.*?)\\)', 1) <> ''
            then split_part(regexp_extract(first_careunit, '\\((.*?)\\)', 1), '/', 1) end"""

MART_CTES = FACT_WITH + ", " + ", ".join([CTE["patients"], CTE["drgcodes"], CTE["nurse_wages"], CTE["nurse_ratios"]]) + f"""
, dp as (select distinct p.subject_id as patient_id, p.gender, a.race, p.anchor_year as birth_year, a.marital_status,
                p.anchor_age as age from patients p left join admissions a on p.subject_id = a.subject_id),
da as (select distinct a.hadm_id as admission_id, a.admission_type, a.admission_location as admission_source,
              a.discharge_location as discharge_disposition, a.insurance as insurance_category, d.drg_code,
              d.description as drg_description, d.drg_type as drg_category
       from admissions a left join drgcodes d on a.hadm_id = d.hadm_id),
du as (select distinct stay_id as unit_id, {UNIT_TYPE_SQL} as unit_type, first_careunit as unit_name from icustays),
dd0 as (select cast(icu_admit_date as date) as calendar_date from fact union select cast(icu_discharge_date as date) from fact),
dd as (select calendar_date, strftime(calendar_date, '%Y%m%d') as date_id, dayname(calendar_date) as day_of_week
       from dd0 where calendar_date is not null),
st as (select "State", row_number() over (order by "State") - 1 as ord
       from (select distinct "State" from nurse_wages where "State" is not null)),
nst as (select count(*) as n from st),
mart as (
  select f.*, dp.age, dp.race, da.drg_category, du.unit_type, a.date_id as date_id_adm, a.calendar_date as calendar_date_adm,
         d.day_of_week as day_of_week_dis, st."State", w.hourly_wage,
         try_cast(trim(split_part(r.nurse_patient_ratio, ':', 2)) as double) as icu_patients
  from fact f left join dp on f.patient_id = dp.patient_id left join da on f.admission_id = da.admission_id
       left join du on f.stay_id = du.unit_id
       left join dd a on cast(f.icu_admit_date as date) = a.calendar_date
       left join dd d on cast(f.icu_discharge_date as date) = d.calendar_date
       cross join nst left join st on f.stay_id % nst.n = st.ord
       left join nurse_wages w on st."State" = w."State" left join nurse_ratios r on trim(r."State") = st."State"),
mart2 as (
  select *, case when age > 0 and age <= 18 then 'child' when age > 18 and age <= 40 then 'adult'
                 when age > 40 and age <= 65 then 'senior' when age > 65 and age <= 999 then 'elderly' end as age_group,
         cast(date_trunc('month', calendar_date_adm) as date) as admit_month,
         case when icu_patients = 0 then null else total_icu_days * 24 / icu_patients end as nurse_hours,
         case when icu_patients = 0 then null else total_icu_days * 24 / icu_patients end * hourly_wage * total_icu_days
           as labor_cost,
         coalesce(lab_tests_cost, 0) + coalesce(medicine_cost, 0) as supply_cost
  from mart)
"""

MART_COLS = ["stay_id", "patient_id", "admission_id", "unit_type", "drg_category", "race", "age_group", "date_id_adm",
             "day_of_week_dis", "State", "hourly_wage", "icu_patients", "admit_month"]
MART_ROUNDED = ["nurse_hours", "labor_cost", "labor_cost_hours_only", "supply_cost", "total_cost_all"]


def mart_from(spark, sf_dir):
    """The mart over a written fact and its dates, as ``write_mart`` has them: the mart reads the fact
    five times (itself and the days of two roles), its joins run once."""
    t = fr.Tables(spark, sf_dir)
    m = MT.build_mart(fr.raw_hospital(t))
    fact = materialize(m["fact_icustay"], "fact")
    return RP.stay_mart(fact, m["dim_patient"], m["dim_admission"], m["dim_icu_unit"], materialize(MT.dim_date(fact), "dates"),
                        fr.nurse_wages(t), fr.nurse_ratios(t), state_pick=F.col("stay_id"))


@register("stay_mart", MART_CTES + f"""
select {', '.join('"State"' if c == "State" else c for c in MART_COLS)},
       round(nurse_hours, 6) as nurse_hours, round(labor_cost, 6) as labor_cost,
       round(nurse_hours * hourly_wage, 6) as labor_cost_hours_only, round(supply_cost, 6) as supply_cost,
       round(total_cost + labor_cost, 6) as total_cost_all
from mart2""")
def q_stay_mart(spark, sf_dir):
    m = mart_from(spark, sf_dir)
    return m.select(*MART_COLS, *[F.round(c, 6).alias(c) for c in MART_ROUNDED])


def _describe(cols):
    stats = [("count", "cast(count({c}) as double)"), ("mean", "avg({c})"), ("std", "stddev_samp({c})"),
             ("min", "min({c})"), ("25%", "quantile_cont({c}, 0.25)"), ("50%", "quantile_cont({c}, 0.5)"),
             ("75%", "quantile_cont({c}, 0.75)"), ("max", "max({c})")]
    return "\nunion all\n".join(f"select 'describe', '{c}', '{n}', round({f.format(c=c)}, 6) from mart2"
                                for c in cols for n, f in stats)


NUM = ("total_icu_days", "lab_tests_cost", "medicine_cost", "total_cost")

REPORTS_SQL = MART_CTES + f""",
mm as (select min(total_icu_days) as lo, max(total_icu_days) as hi from mart2),
hb as (select least(cast(floor(30 * (total_icu_days - lo) / (hi - lo)) as int) + 1, 30) as bin
       from mart2, mm where total_icu_days is not null),
hc as (select bin, count(*) as n from hb group by bin),
allb as (select cast(range as int) as bin from range(1, 31)),
drg as (select drg_category, avg(total_cost) as mean, median(total_cost) as median, count(total_cost) as cnt
        from mart2 where drg_category is not null group by 1 order by mean desc, drg_category limit 10),
labs as (select * from (values ('child', 0), ('adult', 1), ('senior', 2), ('elderly', 3)) v(age_group, o)),
age as (select age_group, avg(total_cost) as mean from mart2 where age_group is not null group by 1),
sh as (select cast(sum(cast(labor_cost as decimal(28,10))) as double) as a,
              cast(sum(cast(supply_cost as decimal(28,10))) as double) as b from mart2)
select 'describe' as report, 'x' as label, 'x' as stat, 0.0 as value where false
union all
{_describe(NUM)}
union all
select 'icu_days_histogram', cast(allb.bin as varchar), 'n', cast(coalesce(hc.n, 0) as double)
from allb left join hc on allb.bin = hc.bin
union all
select 'icu_days_histogram', cast(allb.bin as varchar), 'bin_lo', round(lo + (allb.bin - 1) * ((hi - lo) / 30), 6)
from allb, mm
union all
select 'mean_cost_by_unit', unit_type, 'mean', round(avg(total_cost), 6) from mart2 where unit_type is not null group by unit_type
union all
select 'stays_per_month', strftime(admit_month, '%Y-%m'), 'count', cast(count(*) as double)
from mart2 where admit_month is not null group by admit_month
union all
select 'mean_cost_by_outcome', cast(survived as varchar), 'mean', round(avg(total_cost), 6)
from mart2 where survived is not null group by survived
union all
{chr(10).join(f"select 'correlation', '{a}|{b}', 'corr', round(corr({a}, {b}), 6) from mart2 union all" for a in NUM for b in NUM)}
select 'drg_top_mean', drg_category, 'mean', round(mean, 6) from drg
union all
select 'drg_top_mean', drg_category, 'median', round(median, 6) from drg
union all
select 'drg_top_mean', drg_category, 'count', cast(cnt as double) from drg
union all
select 'mean_cost_by_age', labs.age_group, 'mean', round(age.mean, 6) from labs left join age on labs.age_group = age.age_group
union all
select 'labor_supply_share', 'all', 'labor_sum', round(a, 6) from sh
union all
select 'labor_supply_share', 'all', 'supply_sum', round(b, 6) from sh
union all
select 'labor_supply_share', 'all', 'labor_pct', round(a * 100.0 / (a + b), 6) from sh
union all
select 'labor_supply_share', 'all', 'supply_pct', round(b * 100.0 / (a + b), 6) from sh
"""


@register("cost_reports", REPORTS_SQL)
def q_cost_reports(spark, sf_dir):
    r = RP.cost_reports(lambda: mart_from(spark, sf_dir))
    return r.withColumn("value", F.round("value", 6))
