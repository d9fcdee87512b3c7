"""Registered queries: the mart pipelines."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..catalog import register
from ..plans import mart
from ..session import materialize, shuffles_released
from . import frames as fr
from .sql import CTE, FACT_WITH, with_

FACT_COLS = ("patient_id, admission_id, stay_id, icu_admit_date, icu_discharge_date, total_icu_days, "
             "hospital_expire_flag, survived, lab_tests_cost, medicine_cost, total_cost, cost_per_stay")


def fact_from(t: fr.Tables):
    return mart.fact_stay_cost(fr.admissions(t), fr.icustays(t), fr.prescriptions(t), fr.drug_price(t),
                               fr.lab_events(t), fr.lab_items(t), fr.lab_price(t))


@register("fact_stay_cost", FACT_WITH + f"select {FACT_COLS} from fact")
def q_fact_stay_cost(spark, sf_dir):
    return fact_from(fr.Tables(spark, sf_dir)).select(*[c.strip() for c in FACT_COLS.split(",")])


@register("dim_patient", with_("patients", "admissions") + """
select distinct p.subject_id as patient_id, p.gender, a.race, p.anchor_year as birth_year, a.marital_status,
       p.anchor_age as age
from patients p left join admissions a on p.subject_id = a.subject_id""")
def q_dim_patient(spark, sf_dir):
    t = fr.Tables(spark, sf_dir)
    return mart.dim_patient(fr.patients(t), fr.admissions(t))


@register("dim_admission", with_("admissions", "drgcodes") + """
select distinct a.hadm_id as admission_id, a.admission_type, a.admission_location as admission_source,
       a.discharge_location as discharge_disposition, a.insurance as insurance_category, d.drg_code,
       d.description as drg_description, d.drg_type as drg_category
from admissions a left join drgcodes d on a.hadm_id = d.hadm_id""")
def q_dim_admission(spark, sf_dir):
    t = fr.Tables(spark, sf_dir)
    return mart.dim_admission(fr.admissions(t), fr.drgcodes(t))


@register("dim_icu_unit", with_("icustays") + """
select distinct stay_id as unit_id,
       case when regexp_extract(first_careunit, '\\((.*?)\\)', 1) <> ''
            then split_part(regexp_extract(first_careunit, '\\((.*?)\\)', 1), '/', 1) end as unit_type,
       first_careunit as unit_name
from icustays""")
def q_dim_icu_unit(spark, sf_dir):
    return mart.dim_icu_unit(fr.icustays(fr.Tables(spark, sf_dir)))


@register("dim_date", FACT_WITH + """
, d as (select cast(icu_admit_date as date) as calendar_date from fact
        union select cast(icu_discharge_date as date) from fact)
select calendar_date, strftime(calendar_date, '%Y%m%d') as date_id, strftime(calendar_date, '%Y') as year,
       cast(quarter(calendar_date) as int) as quarter, strftime(calendar_date, '%m') as month,
       dayname(calendar_date) as day_of_week
from d where calendar_date is not null""")
def q_dim_date(spark, sf_dir):
    return mart.dim_date(fact_from(fr.Tables(spark, sf_dir)))


# code tokens / modal code / resolved code, shared by dims_extra and fact_cost_event
_TOKS = "list_filter(string_split_regex(trim(regexp_replace({c}, ',', ' ', 'g')), '[ \\t\\n\\x0B\\f\\r]+'), lambda t: t <> '')"


def _modal_sql(src: str, name: str) -> str:
    toks = _TOKS.format(c="gsn")
    return f"""tok as (select {name} as drug_name, unnest({toks}) as tok from {src}
                 where gsn is not null and gsn <> ''),
cnt as (select drug_name, tok, count(*) as n from tok group by all),
modal as (select drug_name, tok as most_freq_gsn
          from (select *, row_number() over (partition by drug_name order by n desc, tok) as rn from cnt) where rn = 1)"""


def _resolved_sql(name: str) -> str:
    toks = _TOKS.format(c="gsn")
    return f"""case when gsn is null or regexp_replace(gsn, '[ \\t\\n\\x0B\\f\\r]+', '', 'g') = '' then '00000'
            when len({toks}) = 1 then ({toks})[1]
            else coalesce(modal.most_freq_gsn, ({toks})[1], '00000') end"""


@register("dims_extra", with_("prescriptions", extra=(_modal_sql("prescriptions", "drug"),)) + f"""
, meds as (select distinct gsn, drug as drug_name, cast(null as varchar) as drug_class, form_rx as form,
                  dose_val_rx as dosage, doses_per_24_hrs as frequency, route from prescriptions)
select meds.drug_name, meds.drug_class, meds.form, meds.dosage, meds.frequency, meds.route,
       {_resolved_sql('drug_name')} as drug_id
from meds left join modal on meds.drug_name is not distinct from modal.drug_name""")
def q_dims_extra(spark, sf_dir):
    """The draft's medication dimension with resolved drug codes (the other three draft
    dimensions are plain projections: ``dim_diagnosis``, ``dim_labtest``, ``dim_hcpcs``)."""
    return mart.dim_medication(fr.prescriptions(fr.Tables(spark, sf_dir)))


@register("dim_labtest", with_("lab_items") + """
select distinct itemid as lab_item_id, label as test_name, category as test_category, 'fluid' as test_type
from lab_items""")
def q_dim_labtest(spark, sf_dir):
    t = fr.Tables(spark, sf_dir)
    return mart.dim_labtest(fr.lab_items(t))


_RX_NORM = """rxn as (select * replace (lower(trim(drug)) as drug) from prescriptions_s)"""
FACT_EVENT_SQL = with_("lab_items", "lab_price", "drug_price", "lab_events", extra=(
    CTE["prescriptions"].replace("prescriptions as (", "prescriptions_s as ("),
    _RX_NORM, _modal_sql("rxn", "drug"),
    """priced_items as (select li.itemid, cast(lp.price as decimal(28,10)) as price from lab_items li
                     join lab_price lp on lower(trim(li.label)) = lower(trim(lp.label)))""",
    """labe as (select o_custkey as patient_id, e.hadm_id as admission_id, e.charttime as event_date,
                  cast(e.itemid as varchar) as lab_item_id, cast(e.itemid as varchar) as source_code,
                  cast(coalesce(pi.price, 0) as double) as cost,
                  sha256(concat_ws('|', 'LAB', cast(e.l_orderkey as varchar), cast(e.l_linenumber as varchar),
                                   cast(e.l_partkey as varchar), cast(e.itemid as varchar))) as event_id,
                  'LAB' as event_type, cast(null as varchar) as location_id, cast(null as varchar) as med_id,
                  cast(null as varchar) as drug_name, cast(null as varchar) as raw_gsn,
                  cast(null as varchar) as hcpcs_cd, cast(null as varchar) as procedure_code
           from lab_events e join orders on e.hadm_id = o_orderkey left join priced_items pi on e.itemid = pi.itemid)""",
    f"""mede as (select o_custkey as patient_id, r.hadm_id as admission_id, r.starttime as event_date,
                  cast(null as varchar) as lab_item_id, {_resolved_sql('drug')} as source_code,
                  cast(coalesce(cast(dp.cost as decimal(28,10)), 0) as double) as cost,
                  sha256(concat_ws('|', 'MED', cast(r.l_orderkey as varchar), cast(r.l_linenumber as varchar),
                                   cast(r.l_partkey as varchar), cast(r.l_suppkey as varchar))) as event_id,
                  'MED' as event_type, cast(null as varchar) as location_id, cast(null as varchar) as med_id,
                  r.drug as drug_name, r.gsn as raw_gsn,
                  cast(null as varchar) as hcpcs_cd, cast(null as varchar) as procedure_code
           from rxn r join orders on r.hadm_id = o_orderkey
                left join drug_price dp on r.drug = lower(trim(dp.drug))
                left join modal on r.drug is not distinct from modal.drug_name)"""))


@register("fact_cost_event", FACT_EVENT_SQL + "select * from labe union all select * from mede")
def q_fact_cost_event(spark, sf_dir):
    t = fr.Tables(spark, sf_dir)
    with shuffles_released(spark):  # lines meet orders once, not for each kind of event and for the codes again
        lines = materialize(fr.event_lines(t), "event-lines")
    lab = fr.lab_events(t, with_subject=True, lines=lines)
    rx = fr.prescriptions(t, with_subject=True, lines=lines)
    ev = mart.fact_cost_event(lab, fr.lab_items(t), fr.lab_price(t), rx, fr.drug_price(t),
                              lab_id=("l_orderkey", "l_linenumber", "l_partkey", "itemid"),
                              rx_id=("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))
    return ev.select("patient_id", "admission_id", "event_date", "lab_item_id", "source_code", "cost", "event_id",
                     "event_type", "location_id", "med_id", "drug_name", "raw_gsn", "hcpcs_cd", "procedure_code")


@register("reconcile_fact", FACT_WITH + """
, medl as (select p.hadm_id, cast(sum(cast(d.cost as decimal(28,10))) as double) as rebuilt_medicine_cost
           from prescriptions p left join drug_price d on lower(trim(p.drug)) = lower(trim(d.drug)) group by p.hadm_id),
rebuilt as (select s.stay_id, coalesce(medl.rebuilt_medicine_cost, 0.0) as rebuilt_medicine_cost
            from stays s left join medl on s.admission_id = medl.hadm_id),
j as (select coalesce(f.stay_id, r.stay_id) as stay_id, f.medicine_cost as fact_medicine_cost, r.rebuilt_medicine_cost
      from fact f full outer join rebuilt r on f.stay_id = r.stay_id)
select stay_id, fact_medicine_cost, rebuilt_medicine_cost,
       case when fact_medicine_cost is null then 'missing' when rebuilt_medicine_cost is null then 'extra'
            when abs(fact_medicine_cost - rebuilt_medicine_cost) > 0.005 then 'differs' else 'same' end as status
from j""")
def q_reconcile_fact(spark, sf_dir):
    t = fr.Tables(spark, sf_dir)
    fact = fact_from(t)
    return mart.reconcile_fact(fact, fr.admissions(t), fr.icustays(t), fr.prescriptions(t), fr.drug_price(t))


DIAG_SQL = """diagnoses_icd as (select l_orderkey as hadm_id, cast(l_partkey % 97 as varchar) as icd_code,
                         case when l_linenumber % 2 = 0 then '10' else '9' end as icd_version from lineitem),
d_icd_diagnoses as (select cast(p_partkey % 97 as varchar) as icd_code,
                           case when p_partkey % 2 = 0 then '10' else '9' end as icd_version,
                           arg_min(p_name, p_partkey) as long_title
                    from part group by 1, 2)"""


def diagnoses_icd(t):
    return t.lineitem.select(F.col("l_orderkey").alias("hadm_id"), (F.col("l_partkey") % 97).cast("string").alias("icd_code"),
                             F.when(F.col("l_linenumber") % 2 == 0, "10").otherwise("9").alias("icd_version"))


def d_icd_diagnoses(t):
    """One title per (code, version): the name of the lowest part key mapping to it."""
    from ..operators.aggregates import first_per_key

    p = t.part.select((F.col("p_partkey") % 97).cast("string").alias("icd_code"),
                      F.when(F.col("p_partkey") % 2 == 0, "10").otherwise("9").alias("icd_version"),
                      F.col("p_name").alias("long_title"), "p_partkey")
    return first_per_key(p, ["icd_code", "icd_version"], ["p_partkey"]).drop("p_partkey")


@register("dim_diagnosis", "with " + DIAG_SQL + """
select distinct d.icd_code, dd.long_title as description, d.icd_version
from diagnoses_icd d left join d_icd_diagnoses dd on d.icd_code = dd.icd_code and d.icd_version = dd.icd_version""")
def q_dim_diagnosis(spark, sf_dir):
    t = fr.Tables(spark, sf_dir)
    return mart.dim_diagnosis(diagnoses_icd(t), d_icd_diagnoses(t))


@register("dim_hcpcs", """
select distinct p_brand as hcpcs_code, p_name || ' service' as service_description, p_type as category from part""")
def q_dim_hcpcs(spark, sf_dir):
    p = fr.Tables(spark, sf_dir).part
    codes = p.select(F.col("p_brand").alias("code"), F.concat("p_name", F.lit(" service")).alias("long_description"),
                     F.col("p_type").alias("category"))
    return mart.dim_hcpcs(codes)
