"""The stand-in frames of ``frames.py`` as DuckDB CTEs, for oracle SQL."""

from __future__ import annotations

CARE_UNIT = """case o_orderkey % 6
    when 0 then 'Medical Intensive Care Unit (MICU)'
    when 1 then 'Medical/Surgical Intensive Care Unit (MICU/SICU)'
    when 2 then 'Cardiac Vascular Intensive Care Unit (CVICU)'
    when 3 then 'Trauma SICU (TSICU)'
    when 4 then 'Step down ()'
    else 'Neuro Stepdown' end"""

CTE = {
    "patients": """patients as (
  select c_custkey as subject_id, case when c_custkey % 2 = 0 then 'F' else 'M' end as gender,
         cast(2110 + c_custkey % 90 as int) as anchor_year, cast(c_custkey % 91 as int) as anchor_age
  from customer)""",
    "admissions": """admissions as (
  select o_orderkey as hadm_id, o_custkey as subject_id, o_orderpriority as race, o_orderstatus as marital_status,
         o_orderpriority as admission_type, 'LOC_' || cast(o_custkey % 4 as varchar) as admission_location,
         'DIS_' || cast(o_orderkey % 3 as varchar) as discharge_location,
         case when o_totalprice > 200000 then 'Private' else 'Medicare' end as insurance,
         cast(case when o_orderkey % 7 = 0 then 1 else 0 end as int) as hospital_expire_flag
  from orders)""",
    "drgcodes": """drgcodes as (
  select l_orderkey as hadm_id, cast(l_partkey % 40 as varchar) as drg_code,
         'DRG ' || cast(l_partkey % 40 as varchar) as description, l_returnflag as drg_type
  from lineitem)""",
    "icustays": f"""icustays as (
  select o_custkey as subject_id, o_orderkey as hadm_id, o_orderkey as stay_id, o_orderdate as intime,
         o_orderdate + to_days(cast(o_orderkey % 10 as int)) as outtime,
         cast(o_orderkey % 10 as double) + 0.25 as los, {CARE_UNIT} as first_careunit
  from orders where o_orderstatus = 'F'
  union all
  select o_custkey, o_orderkey, o_orderkey + 1000000000, o_orderdate + to_days(1),
         o_orderdate + to_days(cast(o_orderkey % 10 + 1 as int)),
         cast(o_orderkey % 10 as double) + 0.5, {CARE_UNIT}
  from orders where o_orderstatus = 'F' and o_orderpriority = '1-URGENT')""",
    "prescriptions": """prescriptions as (
  select l_orderkey as hadm_id,
         case when l_linenumber % 2 = 0 then upper(p_name) else p_name || ' ' end as drug,
         case when l_linenumber = 7 then ' '
              else cast(l_suppkey as varchar) || ' ,' || cast(l_partkey % 3 as varchar) end as gsn,
         l_shipdate as starttime, 'TAB' as form_rx, cast(l_quantity as varchar) as dose_val_rx,
         cast(l_linenumber as varchar) as doses_per_24_hrs, 'PO' as route,
         l_linenumber, l_partkey, l_suppkey, l_orderkey
  from lineitem join part on l_partkey = p_partkey)""",
    "drug_price": """drug_price as (
  select p_name as drug, arg_min(p_retailprice, p_partkey) as cost
  from part group by p_name having not starts_with(p_name, 'red'))""",
    "lab_events": """lab_events as (
  select l_orderkey as hadm_id, l_suppkey as itemid, l_shipdate as charttime, l_linenumber, l_partkey, l_orderkey
  from lineitem)""",
    "lab_items": """lab_items as (
  select s_suppkey as itemid, n_name as label,
         case n_regionkey when 0 then 'Blood Gas' when 1 then 'Chemistry' when 2 then 'Hematology'
              else 'Other' end as category
  from supplier join nation on s_nationkey = n_nationkey)""",
    "lab_price": """lab_price as (
  select n_name as label, case when n_nationkey % 7 <> 0 then (n_nationkey + 1) * 0.75 end as price from nation)""",
    "nurse_wages": """nurse_wages as (select n_name as "State", cast(40.0 + n_nationkey as double) as hourly_wage from nation)""",
    "nurse_ratios": """nurse_ratios as (
  select ' ' || n_name || ' ' as "State",
         cast(n_regionkey + 1 as varchar) || ':' || cast(n_nationkey % 3 + 2 as varchar) as nurse_patient_ratio
  from nation)""",
}

# SQL for the mart pieces other queries build on.
STAYS = """stays as (
  select i.subject_id as patient_id, i.hadm_id as admission_id, i.stay_id, i.intime as icu_admit_date,
         i.outtime as icu_discharge_date, cast(i.los as double) as total_icu_days, a.hospital_expire_flag,
         case when a.hospital_expire_flag is null then null
              else cast(a.hospital_expire_flag = 0 as int) end as survived
  from admissions a join icustays i on a.hadm_id = i.hadm_id)"""

MED_COST = """med as (
  select p.hadm_id, cast(sum(cast(d.cost as decimal(28,10))) as double) as medicine_cost
  from prescriptions p join drug_price d on lower(trim(p.drug)) = lower(trim(d.drug)) group by p.hadm_id)"""

LAB_COST = """lab as (
  select e.hadm_id, cast(sum(cast(lp.price as decimal(28,10))) as double) as lab_tests_cost
  from lab_events e join lab_items li on e.itemid = li.itemid
       join lab_price lp on lower(trim(li.label)) = lower(trim(lp.label))
  group by e.hadm_id)"""

FACT = """fact0 as (
  select s.*, coalesce(lab.lab_tests_cost, 0.0) as lab_tests_cost, coalesce(med.medicine_cost, 0.0) as medicine_cost,
         cast(cast(coalesce(lab.lab_tests_cost, 0.0) as decimal(28,10))
              + cast(coalesce(med.medicine_cost, 0.0) as decimal(28,10)) as double) as total_cost
  from stays s left join med on s.admission_id = med.hadm_id left join lab on s.admission_id = lab.hadm_id),
fact as (select *, total_cost / count(*) over (partition by admission_id) as cost_per_stay from fact0)"""


def with_(*names: str, extra: tuple[str, ...] = ()) -> str:
    """``with`` clause holding the named stand-in CTEs and extra CTE texts."""
    parts = [CTE[n] for n in names] + list(extra)
    return "with " + ",\n".join(parts) + "\n"


FACT_WITH = with_("admissions", "icustays", "prescriptions", "drug_price", "lab_events", "lab_items", "lab_price",
                  extra=(STAYS, MED_COST, LAB_COST, FACT))
