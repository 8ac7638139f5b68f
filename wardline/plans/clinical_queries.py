"""Queries of the clinical composites over the data model."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardline.functions import scalars as S
from wardline.operators import clinical as C
from wardline.operators import joins, typing_ops, windows
from wardline.plans.cdm import Tables
from wardline.plans.registry import query
from wardline.plans.spec import FactTable, VariableSpec, compile_spec, load_variables

c = F.col

SHAPES = {"measurements": FactTable("variable", "taken_at", "value", "measurement_id"), "exposures": FactTable("drug_class", "exp_start", "quantity", "drug_id")}

_ELIGIBLE = """single as (select person_id, cast(proc_start as date) as day from procedures group by 1, 2 having count(*) = 1),
e as (select p.*, v.start_at, v.end_at, row_number() over (partition by p.visit_id order by proc_start, procedure_id) rn from procedures p join visits v using (visit_id) join persons q on q.person_id = p.person_id
 where (p.person_id, cast(proc_start as date)) in (select person_id, day from single) and date_diff('year', birth_date, proc_start) >= 18 and date_diff('hour', start_at, end_at) >= 24 and date_diff('minute', proc_start, proc_end) > 20 and status in ('F', 'O'))"""
query("c1_eligible_cohort", "procedures visits persons", _ELIGIBLE + " SELECT person_id, visit_id, procedure_id, start_at, end_at, proc_start, proc_end from e where rn = 1")(lambda t: C.eligible_cohort(t.procedures, t.visits, t.persons, statuses=("F", "O")))
query("c2_split_by_time", "visits", """d as (select status, cast(start_at as date) as day, count(*) k from visits group by all), u as (select *, sum(k) over (partition by status) n, sum(k) over (partition by status order by day) c from d),
e as (select status, min(day) filter (c >= greatest(1, floor(n * 0.8))) e0, min(day) filter (c >= greatest(1, floor(n * 0.9))) e1 from u group by 1)
SELECT visit_id, case when cast(start_at as date) <= e0 then 'Development' when cast(start_at as date) <= e1 then 'Validation' else 'Test' end split from visits join e using (status)""")(
    lambda t: C.split_by_time(t.visits, date="start_at", key="visit_id", strata=["status"]).select("visit_id", "split")
)
query("c2_split_random")(lambda t: C.split_random(t.visits, key="visit_id").groupBy("split").agg(F.count("*").alias("n")))
query("c3_assign_subsets")(lambda t: C.assign_subsets(t.visits, split="status", key="visit_id", size=2000).groupBy("status", "subset_id").agg(F.count("*").alias("n")))


def _extracts(t: Tables):
    index = t.visits.select("visit_id", "person_id", "start_at", "end_at")
    one = VariableSpec("recent", "measurements", ("view", "click"), low="start_at", high="end_at", before="365 DAYS", nth=-1)
    two = VariableSpec("errors", "measurements", ("error",), low="start_at", high="end_at", before="365 DAYS", nth=-1)
    avg = VariableSpec("means", "measurements", ("view", "purchase"), low="end_at", high="end_at", after="4 DAYS", aggregate="avg", fields=("unit",))
    drugs = VariableSpec("drugs", "exposures", ("A", "R"), key="visit_id", low="start_at", high="end_at", before="365 DAYS", where="quantity <> 0")
    specs = [one, two, avg, drugs]
    tables = {"measurements": t.measurements, "exposures": t.exposures.drop("person_id")}
    return compile_spec(specs, index, tables, SHAPES, subject="visit_id"), specs


query("c4_extract_nth", "visits measurements", """r as (select visit_id, variable variable_name, taken_at fact_at, value, measurement_id, row_number() over (partition by visit_id, variable order by taken_at desc, measurement_id desc) rn from measurements m join visits v using (person_id) where variable in ('view', 'click') and taken_at between start_at - interval 365 day and end_at)
SELECT visit_id, variable_name, fact_at, value, measurement_id from r where rn = 1""")(lambda t: _extracts(t)[0]["recent"])
query("c4_extract_aggregate", "visits measurements", "SELECT visit_id, variable variable_name, unit, avg(value) as value, count(value) n from measurements join visits using (person_id) where variable in ('view', 'purchase') and taken_at between end_at and end_at + interval 4 day group by all", "value")(lambda t: _extracts(t)[0]["means"])
query("c4_extract_window", "visits exposures", "SELECT e.visit_id, drug_class variable_name, exp_start fact_at, quantity as value, drug_id from exposures e join visits v using (visit_id) where drug_class in ('A', 'R') and quantity <> 0 and exp_start between start_at - interval 365 day and end_at")(lambda t: _extracts(t)[0]["drugs"])
query("s10_load_variables", "visits measurements", """r as (select visit_id, variable variable_name, value, row_number() over (partition by visit_id, variable order by taken_at desc, measurement_id desc) rn from measurements m join visits v using (person_id) where variable in ('view', 'error') and taken_at between start_at - interval 365 day and end_at)
SELECT variable_name, count(*) n, count(value) known from r where rn = 1 group by 1""")(
    lambda t: (lambda x: load_variables(x[0], x[1][:2], ["view", "error"]))(_extracts(t)).groupBy("variable_name").agg(F.count("*").alias("n"), F.count("value").alias("known"))
)
query("c5_demographics", "visits persons", "SELECT visit_id, case sex when 'F' then 'female' when 'M' then 'male' end sex, case when race in ('BUILDING', 'MACHINERY') then lower(race) else 'other' end race, date_diff('day', birth_date, cast(start_at as date)) / 365.2425 age, hour(start_at)::int as hour from visits join persons using (person_id)", "age")(
    lambda t: t.visits.join(t.persons, "person_id").select("visit_id", typing_ops.map_values(c("sex"), {"F": "female", "M": "male"}).alias("sex"), typing_ops.map_values(c("race"), {"BUILDING": "building", "MACHINERY": "machinery"}, other="other").alias("race"), S.age_years(c("birth_date"), F.to_date("start_at"), exact=True).alias("age"), F.hour("start_at").alias("hour"))
)
query("c6_residency", "", """k as (select c_custkey, c_nationkey, case when c_nationkey % 5 <> 0 then (c_nationkey * 53 % 180) - 90.0 end x, (c_nationkey * 29 % 360) - 180.0 y from customer)
SELECT c_custkey, 2 * 6371.009 / 1.609 * asin(least(1, sqrt(pow(sin(radians(30 - x) / 2), 2) + cos(radians(x)) * cos(radians(30)) * pow(sin(radians(-80 - y) / 2), 2)))) miles from k""", "miles")(
    lambda t: t.customer.select("c_custkey", S.haversine_miles(F.when(c("c_nationkey") % 5 != 0, (c("c_nationkey") * 53 % 180) - 90.0), (c("c_nationkey") * 29 % 360) - 180.0, F.lit(30.0), F.lit(-80.0)).alias("miles"))
)
query("c7_comorbidity_index", "exposures", """o as (select distinct person_id, p_brand as variable from exposures join part on p_partkey = drug_id where quantity > 40),
k as (select * from o where not (variable = 'Brand#1' and person_id in (select person_id from o where variable = 'Brand#2'))),
w as (select p_brand as variable, 1 + min(p_size) % 4 weight from part group by 1)
SELECT person_id, cast(sum(weight) as bigint) score, count(*) n_conditions from k join w using (variable) group by 1""")(
    lambda t: C.comorbidity_index(t.exposures.where("quantity > 40").join(t.part, c("p_partkey") == c("drug_id")).select("person_id", c("p_brand").alias("variable")), t.part.groupBy(c("p_brand").alias("variable")).agg((F.min("p_size") % 4 + 1).alias("weight")), subject="person_id", exclusive={"Brand#1": "Brand#2"})
)
_anchors = lambda t: t.visits.groupBy("person_id").agg(F.max("start_at").alias("anchor"))
_A = "a as (select person_id, max(start_at) anchor from visits group by 1)"
query("c8_medication_counts", "visits exposures", _A + ", j as (select a.*, drug_class, drug_id from a left join exposures e on e.person_id = a.person_id and exp_start <= anchor and exp_end >= anchor - interval 365 day) SELECT person_id, anchor, count(distinct drug_id) filter (drug_class = 'A') as \"n_A\", count(distinct drug_id) filter (drug_class = 'N') as \"n_N\" from j group by 1, 2")(
    lambda t: C.medication_counts(_anchors(t), t.exposures, classes=["A", "N"])
)
_FIRST = "a as (select person_id, min(start_at) + interval 15 day anchor from visits group by 1)"
_first = lambda t: t.visits.groupBy("person_id").agg((F.min("start_at") + F.expr("interval 15 days")).alias("anchor"))
query("c9_lab_features", "visits measurements", _FIRST + """, r as (select m.person_id, anchor, variable, value, date_diff('day', taken_at, anchor) d from measurements m join a using (person_id) where value is not null and taken_at <= anchor)
SELECT person_id, anchor, variable, min(value) filter (d between 0 and 7) week_min, max(value) filter (d between 0 and 7) week_max, avg(value) filter (d between 0 and 7) week_mean, var_samp(value) filter (d between 0 and 7) week_var, count(value) filter (d between 0 and 7) week_n,
min(value) filter (d between 8 and 365) year_min, max(value) filter (d between 8 and 365) year_max, avg(value) filter (d between 8 and 365) year_mean, var_samp(value) filter (d between 8 and 365) year_var, count(value) filter (d between 8 and 365) year_n from r group by 1, 2, 3""", "week_mean week_var year_mean year_var")(
    lambda t: C.lab_features(_first(t), t.measurements, at="taken_at", value="value", variable="variable", spans={"week": (0, 7), "year": (8, 365)}, decimals=9)
)
query("c10_kidney_history_flags", "visits exposures", _A + """, k as (select person_id, cast(exp_start as date) code_date, case when quantity > 48 then 'esrd' when drug_class = 'A' then 'ckd' when drug_class = 'N' then 'aki' else 'transplant' end disease from exposures),
x as (select a.person_id, anchor, coalesce(max(case when disease = 'esrd' then 1 else 0 end), 0) esrd, coalesce(max(case when disease = 'ckd' then 1 else 0 end), 0) ckd, coalesce(max(case when disease = 'aki' and code_date < cast(anchor as date) then 1 else 0 end), 0) aki, coalesce(max(case when disease = 'transplant' and code_date < cast(anchor as date) then 1 else 0 end), 0) transplant,
max(case when disease = 'esrd' then code_date end) esrd_latest, max(case when disease = 'ckd' then code_date end) ckd_latest, max(case when disease = 'aki' and code_date < cast(anchor as date) then code_date end) aki_latest, max(case when disease = 'transplant' and code_date < cast(anchor as date) then code_date end) transplant_latest from a left join k on k.person_id = a.person_id and code_date <= cast(anchor as date) group by 1, 2)
SELECT * replace (case when esrd = 1 then 0 else ckd end as ckd) from x""")(
    lambda t: C.history_flags(_anchors(t), t.exposures.select("person_id", F.to_date("exp_start").alias("code_date"), F.when(c("quantity") > 48, "esrd").when(c("drug_class") == "A", "ckd").when(c("drug_class") == "N", "aki").otherwise("transplant").alias("disease")), diseases=["esrd", "ckd", "aki", "transplant"], strict=["aki", "transplant"], suppressed={"ckd": "esrd"})
)
_labs = lambda t: t.measurements.where("value is not null").select("person_id", "measurement_id", "taken_at", (0.5 + c("value") % 40 / 10).alias("cr"))
_LABS = "labs as (select person_id, measurement_id, taken_at, 0.5 + value % 40 / 10 cr from measurements where value is not null)"
_RATED = _LABS + """, ages as (select person_id, sex = 'F' f, cast(person_id % 80 as double) age from persons), rated as (select l.*, f, age, 142 * pow(least(cr / case when f then 0.7 else 0.9 end, 1), case when f then -0.241 else -0.302 end) * pow(greatest(cr / case when f then 0.7 else 0.9 end, 1), -1.2) * pow(0.9938, age) * case when f then 1.012 else 1 end rate from labs l join ages using (person_id))"""
_rated = lambda t: _labs(t).join(t.persons.select("person_id", (c("sex") == "F").alias("f"), (c("person_id") % 80).cast("double").alias("age")), "person_id").withColumn("rate", S.egfr_2021(c("cr"), c("age"), c("f")))
query("c11_creatinine_history", "visits persons measurements", _RATED + """, a as (select person_id, min(start_at) + interval 100 day anchor from visits group by 1), r as (select r.*, anchor, date_diff('day', taken_at, anchor) ago from rated r join a using (person_id) where taken_at < anchor)
SELECT person_id, anchor, max(case when ago <= 365 then 1 else 0 end) previous_year, case when date_diff('day', min(taken_at), max(taken_at)) >= 20 then 1 else 0 end two_apart, coalesce(case when date_diff('day', min(taken_at) filter (rate <= 60 and ago > 90), max(taken_at) filter (rate <= 60 and ago > 90)) >= 20 then 1 else 0 end, 0) two_low, max(case when rate <= 60 and ago <= 90 then 1 else 0 end) recent_low, arg_min(cr, taken_at) first_value from r group by 1, 2""", "first_value")(
    lambda t: C.creatinine_history(t.visits.groupBy("person_id").agg((F.min("start_at") + F.expr("interval 100 days")).alias("anchor")), _rated(t), at="taken_at", value="cr", rate="rate", days=20, recent=90)
)
query("c12_baseline_creatinine", "visits measurements", _LABS + """, r as (select visit_id, start_at, end_at, l.*, date_diff('day', taken_at, start_at) d from visits join labs l using (person_id) where cr <= 30), x as (select visit_id, min(cr) filter (taken_at between start_at and end_at) stay_min, min(cr) filter (d between 0 and 7 and taken_at <= start_at) week_min, arg_min(taken_at, (cr, -epoch_us(taken_at))) filter (d between 0 and 7 and taken_at <= start_at) week_min_at, median(cr) filter (d between 8 and 365) year_median from r group by 1),
n as (select visit_id, arg_min(measurement_id, (abs(cr - year_median), -epoch_us(taken_at), measurement_id)) median_row from r join x using (visit_id) where d between 8 and 365 group by 1)
SELECT x.*, median_row, least(stay_min, week_min, year_median) reference from x left join n using (visit_id)""", "stay_min week_min year_median reference")(lambda t: C.baseline_creatinine(t.visits, _labs(t), at="taken_at", value="cr", unique="measurement_id"))
query("c13_reference_creatinine", "persons measurements", _RATED + """, x as (select person_id, any_value(f) f, any_value(age) age, min(cr) a, median(cr) b, count(*) filter (rate < 60) low from rated group by 1)
SELECT person_id, case when low >= 2 then 'CKD by creatinine' else 'No CKD' end class, case when low >= 2 then least(a, b) else least(a, b, case when f then 0.7 else 0.9 end * pow(75 / (142 * pow(0.9938, age) * case when f then 1.012 else 1 end), -1 / 1.2)) end reference from x""", "reference")(
    lambda t: _rated(t).groupBy("person_id", "f", "age").agg(F.min("cr").alias("a"), F.median("cr").alias("b"), F.count_if(c("rate") < 60).alias("low")).withColumn("class", C.ckd_class(F.lit(0), F.lit(0), F.lit(0), (c("low") >= 2).cast("int"))).select("person_id", "class", C.reference_creatinine([c("a"), c("b")], c("class"), c("age"), c("f")).alias("reference"))
)
query("c13_ckd_class_and_stage", "persons", """x as (select person_id, 142 * pow(least((0.5 + person_id % 40 / 10.0) / 0.9, 1), -0.302) * pow(greatest((0.5 + person_id % 40 / 10.0) / 0.9, 1), -1.2) * pow(0.9938, person_id % 80) e from persons)
SELECT person_id, case when e >= 90 then 'G1' when e >= 60 then 'G2' when e >= 45 then 'G3a' when e >= 30 then 'G3b' when e >= 15 then 'G4' else 'G5' end stage, case when person_id % 31 = 0 then 'ESRD' when person_id % 17 = 0 then 'Transplant' when person_id % 5 = 0 then 'CKD by code' when e < 60 then 'CKD by creatinine' else 'No CKD' end class from x""")(
    lambda t: t.persons.withColumn("e", S.egfr_2021(0.5 + c("person_id") % 40 / 10.0, (c("person_id") % 80).cast("double"), F.lit(False))).select("person_id", C.ckd_stage(c("e")).alias("stage"), C.ckd_class((c("person_id") % 31 == 0).cast("int"), (c("person_id") % 17 == 0).cast("int"), (c("person_id") % 5 == 0).cast("int"), (c("e") < 60).cast("int")).alias("class"))
)
query("c14_dialysis_events", "visits exposures locations", """d as (select person_id, exp_start as_at from exposures where drug_class = 'R' and quantity > 45 union all select person_id, proc_start from (select o_custkey person_id, o_orderdate proc_start from orders where o_orderpriority = '1-URGENT'))
SELECT v.visit_id, max(case when as_at is not null then 1 else 0 end) dialysis, max(case when as_at <= start_at + interval 24 hour then 1 else 0 end) dialysis_24h from visits v left join d on d.person_id = v.person_id and as_at between start_at and end_at group by 1""")(
    lambda t: t.visits.join(
        t.exposures.where("drug_class = 'R' and quantity > 45").select(c("person_id").alias("p"), c("exp_start").alias("d")).union(t.orders.where("o_orderpriority = '1-URGENT'").select("o_custkey", "o_orderdate")),
        (c("person_id") == c("p")) & c("d").between(c("start_at"), c("end_at")), "left",
    ).groupBy("visit_id").agg(F.max(F.when(c("d").isNotNull(), 1).otherwise(0)).alias("dialysis"), F.max(F.when(c("d") <= c("start_at") + F.expr("interval 24 hours"), 1).otherwise(0)).alias("dialysis_24h"))
)
_AKI = _LABS + """, r as (select l.*, ref, min(cr) over (partition by person_id order by taken_at range between interval 2 day preceding and current row) least_48h from labs l join (select person_id, median(cr) ref from labs group by 1) using (person_id)),
s as (select *, case when cr / ref >= 3 or (cr >= 4 and ((cr - least_48h >= 0.3 and cr - ref >= 0.3) or cr / ref > 1.5)) then 3 when cr / ref >= 2 then 2 when (cr - least_48h >= 0.3 and cr - ref >= 0.3) or cr / ref > 1.5 then 1 else 0 end stage from r)"""


def _aki(t: Tables):
    labs = _labs(t)
    return C.detect_aki(labs.join(labs.groupBy("person_id").agg(F.median("cr").alias("ref")), "person_id"), by=["person_id"], at="taken_at", value="cr", reference="ref")


query("c15_aki_detection", "measurements", _AKI + " SELECT person_id, measurement_id, stage from s")(lambda t: _aki(t).select("person_id", "measurement_id", "stage"))
query("c15_aki_with_replacement", "measurements", _AKI + """, w as (select *, max(case when measurement_id % 29 = 0 then 1 else 0 end) over (partition by person_id order by taken_at range between interval 7 day preceding and current row) rrt from s)
SELECT person_id, measurement_id, case when rrt = 1 then 4 else stage end stage from w""")(
    lambda t: (lambda labs: C.detect_aki(labs.join(labs.groupBy("person_id").agg(F.median("cr").alias("ref")), "person_id"), by=["person_id"], at="taken_at", value="cr", reference="ref", rrt="rrt"))(_labs(t).withColumn("rrt", (c("measurement_id") % 29 == 0).cast("int"))).select("person_id", "measurement_id", "stage")
)
_DAILY = """, dd as (select person_id, cast(taken_at as date) as day, max(stage) st from s group by all), gg as (select person_id, cast(unnest(generate_series(min(day), max(day), interval 1 day)) as date) as day from dd group by 1),
daily as (select gg.person_id, gg.day, last_value(st ignore nulls) over (partition by gg.person_id order by gg.day) stage, case when st is null then 0 else 1 end observed from gg left join dd using (person_id, day))"""
query("c16_daily_injury", "measurements", _AKI + _DAILY + " SELECT person_id, day, stage, observed from daily")(lambda t: C.daily_injury(_aki(t), by=["person_id"], at="taken_at", stage="stage"))
query("c16_c18_injury_summary", "measurements", _AKI + _DAILY + """, h as (select *, case when date_diff('day', lag(day) over (partition by person_id order by day), day) <= 2 then 0 else 1 end n from daily where stage > 0),
e as (select *, sum(n) over (partition by person_id order by day) episode from h), g as (select person_id, episode, min(day) begin_day, max(day) end_day, date_diff('day', min(day), max(day)) + 1 length, max(stage) worst from e group by 1, 2),
z as (select g.*, case when length > 7 then 3 when length > 2 then 2 else 1 end r, case when end_day < last_day then 1 else 0 end recovered from g join (select person_id, max(day) last_day from daily group by 1) using (person_id)),
y as (select person_id, count(*) n_episodes, max(worst) worst, max(r) r, min(recovered) recovered, cast(sum(length) as bigint) total_days, max(begin_day) filter (episode = 1) begin_day_1, cast(max(length) filter (episode = 1) as int) length_1, max(worst) filter (episode = 1) worst_1, max(begin_day) filter (episode = 2) begin_day_2, cast(max(length) filter (episode = 2) as int) length_2, max(worst) filter (episode = 2) worst_2 from z group by 1)
SELECT y.* exclude (r), case when recovered = 0 and n_episodes = 1 and total_days <= 2 then 'undetermined' when r = 3 then 'acute disease' when r = 2 then 'persistent' else 'rapid reversal' end overall from y""")(
    lambda t: C.injury_summary(C.aki_trajectory(C.daily_injury(_aki(t), by=["person_id"], at="taken_at", stage="stage"), by=["person_id"], day="day", stage="stage"), by=["person_id"], most=2)
)
query("c16_c18_aki_trajectory", "measurements", _AKI + """, d as (select person_id, cast(taken_at as date) as day, max(stage) stage from s group by all),
h as (select *, case when date_diff('day', lag(day) over (partition by person_id order by day), day) <= 2 then 0 else 1 end n from d where stage > 0),
e as (select *, sum(n) over (partition by person_id order by day) episode from h),
g as (select person_id, cast(episode as bigint) episode, min(day) begin_day, max(day) end_day, cast(date_diff('day', min(day), max(day)) + 1 as int) length, max(stage) worst from e group by 1, 2)
SELECT g.*, case when length > 7 then 'acute disease' when length > 2 then 'persistent' else 'rapid reversal' end kind, case when end_day < last_day then 1 else 0 end recovered from g join (select person_id, max(day) last_day from d group by 1) using (person_id)""")(
    lambda t: C.aki_trajectory(_aki(t).groupBy("person_id", F.to_date("taken_at").alias("day")).agg(F.max("stage").alias("stage")), by=["person_id"], day="day", stage="stage")
)
query("c17_aki_description", "measurements", _AKI + """, d as (select *, max(case when stage > 0 then taken_at end) over (partition by person_id order by taken_at rows between unbounded preceding and 1 preceding) prev from s),
b as (select *, last_value(case when stage > 0 and (prev is null or taken_at > prev + interval 2 day) then taken_at end ignore nulls) over (partition by person_id order by taken_at) bg from d)
SELECT measurement_id, case when stage > 0 then case when taken_at <= bg + interval 2 day then 'AKI' when taken_at <= bg + interval 7 day then 'Persistent AKI' else 'AKD' end when taken_at <= prev + interval 7 day then 'Recovery' end description from b""")(
    lambda t: C.describe_injury(_aki(t), by=["person_id"], at="taken_at", stage="stage").select("measurement_id", "description")
)
query("c19_creatinine_filter", "measurements visits", "SELECT measurement_id, case unit when 'mg/dl' then value else value * 100 end as value from measurements where value > 0 and unit is not null and person_id in (select person_id from visits where status = 'P')", "value")(
    lambda t: C.filter_creatinine(t.measurements, t.visits.where("status = 'P'"), value="value", unit="unit", factors={"mg/dl": 1.0, "g/l": 100.0}).select("measurement_id", "value")
)
query("c20_kidney_outputs", "visits", "SELECT visit_id, status from visits where status in ('F', 'P') or visit_id % 2 = 0")(
    lambda t: C.merge_outputs([t.visits.where("status = 'F'"), t.visits.where("status = 'P'"), t.visits.where("visit_id % 2 = 0")], ["visit_id"]).select("visit_id", "status")
)
query("c21_ckd_at_anchor", "visits measurements", _LABS + """, a as (select person_id, min(start_at) + interval 5 day anchor from visits group by 1)
SELECT a.person_id, case when cr >= 3 then 'severe' when cr is not null then 'mild' end class, taken_at matched_at from a asof left join labs l on l.person_id = a.person_id and anchor > taken_at""")(
    lambda t: joins.asof_join(t.visits.groupBy("person_id").agg((F.min("start_at") + F.expr("interval 5 days")).alias("anchor")), _labs(t), on="anchor", right_on="taken_at", by=["person_id"], values=["cr"], strict=True, tie=["measurement_id"]).select("person_id", F.when(c("cr") >= 3, "severe").when(c("cr").isNotNull(), "mild").alias("class"), "matched_at")
)
query("c22_mortality", "visits", """d as (select c_custkey person_id, max(o_orderdate) + to_days(cast(c_custkey % 15 as int)) death_at from customer join orders on o_custkey = c_custkey where c_custkey % 4 = 0 group by 1)
SELECT visit_id, case when death_at between start_at and end_at then 1 else 0 end died_in_stay, case when death_at >= end_at and death_at <= end_at + interval 24 hour then 1 else 0 end dead_1d, case when death_at >= end_at and death_at <= end_at + interval 72 hour then 1 else 0 end dead_3d, case when death_at >= end_at and death_at <= end_at + interval 168 hour then 1 else 0 end dead_7d,
case when date_diff('day', end_at, death_at) between 0 and 1 then 1 else 0 end dead_1_days, case when date_diff('day', end_at, death_at) between 0 and 3 then 1 else 0 end dead_3_days, case when date_diff('day', end_at, death_at) between 0 and 7 then 1 else 0 end dead_7_days from visits v left join d using (person_id)""")(
    lambda t: C.mortality(t.visits, t.visits.where("person_id % 4 = 0").groupBy("person_id").agg(F.max("start_at").alias("m")).select("person_id", F.expr("m + make_dt_interval(cast(person_id % 15 as int))").alias("death_at")))
)
_HOSPITAL = "hospital as (select person_id, max(start_at) + interval 2 day death_at from visits where person_id % 7 = 0 group by 1), d as (select person_id, coalesce(h.death_at, i.death_at) death_at from hospital h full join deaths i using (person_id))"
query("c22_clean_deaths_and_places", "visits deaths", _HOSPITAL + """ SELECT visit_id, case when coalesce(death_at between start_at and end_at, false) or visit_id % 11 = 0 or (visit_id % 11 = 1 and coalesce(epoch_us(death_at) - epoch_us(end_at) between 0 and 168 * 3600000000, false)) then 1 else 0 end died_in_stay, case when death_at >= end_at and death_at <= end_at + interval 720 hour then 1 else 0 end dead_30d, case when date_diff('day', end_at, death_at) between 0 and 30 then 1 else 0 end dead_30_days from visits left join d using (person_id)""")(
    lambda t: C.mortality(t.visits.withColumn("place", F.when(c("visit_id") % 11 == 0, "dead").when(c("visit_id") % 11 == 1, "hospice")), C.clean_deaths(t.visits.where("person_id % 7 = 0").groupBy("person_id").agg((F.max("start_at") + F.expr("interval 2 days")).alias("death_at")), t.deaths), horizons=(30,), place="place")
)
query("c23_icu_stays", "locations", """l as (select * from locations where label = 'error'), a as (select *, case when loc_start > max(loc_end + interval 24 hour) over (partition by person_id order by loc_start, loc_end rows between unbounded preceding and 1 preceding) then 1 else 0 end n from l),
b as (select *, sum(n) over (partition by person_id order by loc_start, loc_end rows unbounded preceding) island from a)
SELECT person_id, min(loc_start) loc_start, max(loc_end) loc_end, count(*) n_merged from b group by person_id, island""")(lambda t: C.icu_stays(t.locations, by=["person_id"], start="loc_start", end="loc_end", label="label", unit="error"))
query("c24_delirium", "visits measurements", """SELECT visit_id, coalesce(max(case when variable = 'error' then 1 else 0 end), 0) in_stay, coalesce(max(case when variable = 'error' and taken_at <= start_at + interval 24 hour then 1 else 0 end), 0) within_24h, coalesce(max(case when variable = 'error' and taken_at <= start_at + interval 72 hour then 1 else 0 end), 0) within_72h
from visits v left join measurements m on m.person_id = v.person_id and taken_at between start_at and end_at group by 1""")(lambda t: C.delirium(t.measurements, t.visits, at="taken_at", value="variable", positive="error"))
query("c25_c27_flags_and_union", "visits measurements", """x as (select v.visit_id, max(case when value > 50 then 1 when value is not null then 0 end) high from visits v left join measurements m on m.person_id = v.person_id and taken_at between start_at and end_at group by 1)
SELECT visit_id, high, greatest(high, case when visit_id % 10 = 0 then 1 end) any_flag from x""")(
    lambda t: C.flags_if_observed(t.visits.join(t.measurements.select(c("person_id").alias("p"), "taken_at", "value"), (c("person_id") == c("p")) & c("taken_at").between(c("start_at"), c("end_at")), "left"), ["visit_id"], {"high": c("value") > 50}).withColumn("esrd", F.when(c("visit_id") % 10 == 0, 1)).withColumn("any_flag", C.any_flag("high", "esrd")).drop("esrd")
)
query("c26_condition_outcomes", "visits exposures", """SELECT v.visit_id, max(case when drug_class = 'A' and exp_start < start_at then 1 else 0 end) a_before, max(case when drug_class = 'A' and exp_start between start_at and end_at then 1 else 0 end) a_new, max(case when drug_class = 'A' then 1 else 0 end) a_any from visits v join exposures e using (visit_id) group by 1""")(
    lambda t: t.visits.drop("person_id").join(t.exposures, "visit_id").groupBy("visit_id").agg(*(F.max(F.when((c("drug_class") == "A") & k, 1).otherwise(0)).alias(n) for n, k in (("a_before", c("exp_start") < c("start_at")), ("a_new", c("exp_start").between(c("start_at"), c("end_at"))), ("a_any", F.lit(True)))))
)


_READ = """kinds as (select event_id, user_id as person_id, ts, value, case event_id % 9 when 0 then 'pf' when 1 then 'platelets' when 2 then 'bilirubin' when 3 then 'creatinine' when 4 then 'coma' when 5 then 'map' when 6 then 'norepinephrine' when 7 then 'rate' else 'systolic' end kind from events),
spans as (select user_id as person_id, min(ts) lo, min(ts) + interval 10 day hi from events group by 1), readings as (select k.* from kinds k join spans using (person_id) where ts between lo and hi)"""
_KIND = "case event_id % 9 when 0 then 'pf' when 1 then 'platelets' when 2 then 'bilirubin' when 3 then 'creatinine' when 4 then 'coma' when 5 then 'map' when 6 then 'norepinephrine' when 7 then 'rate' else 'systolic' end"
_SOFA = {
    "respiration": "case when kind = 'pf' then case when value * 5 < 100 then 4 when value * 5 < 200 then 3 when value * 5 < 300 then 2 when value * 5 < 400 then 1 when value is not null then 0 end end",
    "coagulation": "case when kind = 'platelets' then case when value * 2 < 20 then 4 when value * 2 < 50 then 3 when value * 2 < 100 then 2 when value * 2 < 150 then 1 when value is not null then 0 end end",
    "liver": "case when kind = 'bilirubin' then case when value / 8 > 12 then 4 when value / 8 >= 6 then 3 when value / 8 >= 2 then 2 when value / 8 >= 1.2 then 1 when value is not null then 0 end end",
    "renal": "case when kind = 'creatinine' then case when value / 20 > 5 then 4 when value / 20 >= 3.5 then 3 when value / 20 >= 2 then 2 when value / 20 >= 1.2 then 1 when value is not null then 0 end end",
    "consciousness": "case when kind = 'coma' then case when 3 + event_id % 13 < 6 then 4 when 3 + event_id % 13 <= 9 then 3 when 3 + event_id % 13 <= 12 then 2 when 3 + event_id % 13 <= 14 then 1 else 0 end end",
    "circulation": "case kind when 'map' then case when value < 70 then 1 when value is not null then 0 end when 'norepinephrine' then case when value / 500 > 0.1 then 4 when value / 500 > 0 then 3 when value is not null then 0 end end",
}
_QUICK = {"rate": "case when kind = 'rate' and value is not null then case when value >= 22 then 1 else 0 end end", "pressure": "case when kind = 'systolic' and value is not null then case when value * 2 <= 100 then 1 else 0 end end", "mind": "case when kind = 'coma' then case when 3 + event_id % 13 < 15 then 1 else 0 end end"}


def _hourly_sql(parts: dict[str, str], override: str = "") -> str:
    each = ", ".join(f"max({e}) {n}" for n, e in parts.items())
    roll = ", ".join(f"max({n}) over w {n}" for n in parts)
    fill = ", ".join(f"last_value({n} ignore nulls) over w {n}" for n in parts)
    total = " + ".join(f"coalesce({n}, 0)" for n in parts)
    return _READ + f""", p as (select person_id, date_trunc('hour', ts) as hour, {each} from readings group by all),
g as (select person_id, unnest(generate_series(min(hour), max(hour), interval 1 hour)) as hour from p group by 1),
d as (select g.person_id, g.hour, {roll} from g left join p using (person_id, hour) window w as (partition by g.person_id order by g.hour rows between 23 preceding and current row)),
f as (select person_id, hour, {fill} from d window w as (partition by person_id order by hour rows between 24 preceding and current row)), o as (select * {override} from f)
SELECT person_id, cast(hour as timestamp) as hour, {', '.join(parts)}, {total} total from o"""


def _hourly(t: Tables, parts, override=None):
    readings = t.events.select("event_id", c("user_id").alias("person_id"), "ts", "value", F.expr(_KIND).alias("kind"))
    stays = t.events.groupBy(c("user_id").alias("person_id")).agg(F.min("ts").alias("_from")).withColumn("_to", c("_from") + F.expr("interval 10 days"))
    return C.hourly_scores(readings, by=["person_id"], at="ts", parts=parts, stays=stays, override=override)


_of = lambda kind, value: F.when(c("kind") == kind, value)
query("c28_sofa", "", _hourly_sql(_SOFA, "replace (case when person_id % 10 = 0 then 4 else renal end as renal)"))(
    lambda t: _hourly(
        t,
        {
            "respiration": C.band_points(_of("pf", c("value") * 5), "respiration"), "coagulation": C.band_points(_of("platelets", c("value") * 2), "coagulation"), "liver": C.band_points(_of("bilirubin", c("value") / 8), "liver"),
            "renal": C.band_points(_of("creatinine", c("value") / 20), "renal"), "consciousness": C.band_points(_of("coma", 3 + c("event_id") % 13), "consciousness"),
            "circulation": C.cardiovascular_points(_of("map", c("value")), {"norepinephrine": _of("norepinephrine", c("value") / 500)}),
        },
        {"renal": (t.customer.where("c_custkey % 10 = 0").select(c("c_custkey").alias("person_id")), 4)},
    )
)
query("c28_qsofa", "", _hourly_sql(_QUICK))(lambda t: _hourly(t, C.quick_score(_of("rate", c("value")), _of("systolic", c("value") * 2), _of("coma", 3 + c("event_id") % 13))))
_WORST = {"creatinine": ("max", "view", 20), "bilirubin": ("max", "click", 8), "platelets": ("min", "purchase", 0.5), "lactate": ("max", "error", 20)}
query("c28_esofa", "visits procedures stays measurements", "x as (select visit_id, min(v.person_id) person_id, " + ", ".join(f"{f}(value / {k}) filter (variable = '{v}' and taken_at >= start_at) {n}, median(value / {k}) filter (variable = '{v}' and taken_at < start_at) {n}_base" for n, (f, v, k) in _WORST.items()) + """ from stays v join measurements m on m.person_id = v.person_id and taken_at <= end_at group by 1),
y as (select visit_id, person_id, coalesce(case when creatinine >= 2 * creatinine_base or person_id % 10 = 0 then 1 end, 0) renal, coalesce(case when bilirubin >= 2 and bilirubin >= 2 * bilirubin_base then 1 end, 0) liver, coalesce(case when platelets < 100 and platelets <= 0.5 * platelets_base and platelets_base >= 100 then 1 end, 0) coagulation, coalesce(case when lactate >= 2 then 1 end, 0) perfusion,
 case when visit_id in (select l_orderkey from lineitem where l_quantity > 45) then 1 else 0 end pressor, case when visit_id in (select l_orderkey from lineitem where l_quantity < 3) then 1 else 0 end ventilation from x)
SELECT visit_id, renal, liver, coagulation, perfusion, pressor, ventilation, renal + liver + coagulation + perfusion + pressor + ventilation total from y""")(lambda t: _esofa(t))


def _esofa(t: Tables):
    when = {"": c("taken_at") >= c("start_at"), "_base": c("taken_at") < c("start_at")}
    worst = [(F.median if s else getattr(F, f))(F.when((c("variable") == v) & when[s], c("value") / k)).alias(n + s) for n, (f, v, k) in _WORST.items() for s in when]
    rows = joins.interval_join(t.measurements, t.stays.withColumn("lo", F.lit("1900-01-01").cast("timestamp")), key="person_id", at="taken_at", start="lo", end="end_at").groupBy("visit_id", "person_id").agg(*worst)
    flag = lambda where, n: t.lineitem.where(where).select(c("l_orderkey").alias("visit_id")).distinct().withColumn(n, F.lit(1))
    rows = rows.join(flag("l_quantity > 45", "drug"), "visit_id", "left").join(flag("l_quantity < 3", "device"), "visit_id", "left").withColumn("esrd", (c("person_id") % 10 == 0).cast("int"))
    out = C.electronic_score(rows, creatinine="creatinine", bilirubin="bilirubin", platelets="platelets", lactate="lactate", pressor="drug", ventilated="device", esrd="esrd")
    return out.select("visit_id", "renal", "liver", "coagulation", "perfusion", "pressor", "ventilation", "total")


query("c29_ratio_score", "measurements", """x as (select person_id, avg(value) filter (variable = 'view') as value, avg(value) filter (variable = 'click') baseline from measurements group by 1)
SELECT person_id, coalesce(case when value >= 40 then 1 else 0 end + case when value / baseline >= 1.1 then 1 else 0 end + case when baseline >= 30 then 1 else 0 end, 0) rules, case when coalesce(case when value >= 40 then 1 else 0 end + case when value / baseline >= 1.1 then 1 else 0 end + case when baseline >= 30 then 1 else 0 end, 0) >= 2 then 1 else 0 end score from x where value is not null and baseline is not null""")(
    lambda t: C.ratio_score(t.measurements.groupBy("person_id").agg(F.avg(F.when(c("variable") == "view", c("value"))).alias("value"), F.avg(F.when(c("variable") == "click", c("value"))).alias("baseline")).where("value is not null and baseline is not null"), limit=40, ratio=1.1, least_baseline=30, need=2).select("person_id", "rules", "score")
)
query("c30_pressor_score", "exposures", """x as (select visit_id, date_trunc('hour', exp_start) as hour, quantity / 10 dose, drug_class from exposures)
SELECT visit_id, cast(hour as timestamp) as hour, max(case drug_class when 'A' then case when dose > 15 then 4 when dose > 5 then 3 when dose > 0 then 2 else 0 end when 'R' then case when dose > 0.1 then 4 when dose > 0 then 3 else 0 end else 0 end) points from x group by all""")(
    lambda t: C.hourly_points(
        t.lineitem.select(c("l_orderkey").alias("visit_id"), c("l_shipdate").alias("exp_start"), F.when(c("l_returnflag") == "A", C.above(c("l_quantity") / 10, C.PRESSORS["dopamine"])).when(c("l_returnflag") == "R", C.above(c("l_quantity") / 10, C.PRESSORS["norepinephrine"])).otherwise(0).alias("points")),
        t.visits.select("visit_id"), key="visit_id", at="exp_start", points="points",
    )
)
query("c31_station_features", "locations", """a as (select distinct person_id, timestamp '2024-01-10' anchor from locations)
SELECT a.person_id, a.anchor, b.label before_label, f.label after_label, (epoch_us(e.loc_start) - epoch_us(a.anchor)) / 3.6e9 hours_to_icu from a asof left join locations b on b.person_id = a.person_id and a.anchor > b.loc_start asof left join locations f on f.person_id = a.person_id and a.anchor < f.loc_start asof left join (select * from locations where label = 'error') e on e.person_id = a.person_id and a.anchor <= e.loc_start""", "hours_to_icu")(
    lambda t: C.station_features(t.locations.select("person_id").distinct().withColumn("anchor", F.lit("2024-01-10 00:00:00").cast("timestamp")), t.locations, units={"icu": "error"})
)
query("c32_exclusive_duration", "locations", """edges as (select person_id, loc_start b from locations union select person_id, loc_end from locations), seg as (select person_id, b s, lead(b) over (partition by person_id order by b) e from edges),
won as (select s.person_id, s, e, arg_min(label, (priority, loc_start, label)) as label from seg s join locations l on l.person_id = s.person_id and loc_start <= s and loc_end >= e where e is not null group by all),
r as (select *, case when label = lag(label) over w and s = lag(e) over w then 0 else 1 end n from won window w as (partition by person_id order by s))
SELECT person_id, sum(epoch_us(e) - epoch_us(s)) / 3.6e9 as hours, cast(sum(n) as bigint) n_spells from r where label = 'purchase' group by 1""", "hours")(
    lambda t: C.exclusive_duration(t.locations, by=["person_id"], start="loc_start", end="loc_end", priority="priority", label="label", wanted="purchase")
)
query("c33_ladder_features", "exposures", "SELECT visit_id, count(*) n, sum(quantity) volume, case when sum(quantity) >= 1 then 1 else 0 end volume_1_plus, case when sum(quantity) >= 2 then 1 else 0 end volume_2_plus from exposures where drug_class = 'R' group by 1", "volume")(
    lambda t: t.exposures.where("drug_class = 'R'").groupBy("visit_id").agg(F.count("*").alias("n"), F.sum("quantity").alias("volume")).select("*", *S.ladder(c("volume"), "volume", range(1, 3)))
)
query("c34_admission_score", "visits measurements", "SELECT v.visit_id, m.measurement_id, m.taken_at matched_at from visits v asof left join measurements m on m.person_id = v.person_id and v.start_at <= m.taken_at")(
    lambda t: joins.asof_join(t.visits.select("visit_id", "person_id", "start_at"), t.measurements, on="start_at", right_on="taken_at", by=["person_id"], values=["measurement_id"], direction="forward").select("visit_id", "measurement_id", "matched_at")
)
query("c35_second_procedure", "procedures", """w as (select procedure_id, lead(procedure_id) over w next_id, lead(code) over w next_code, (epoch_us(lead(proc_start) over w) - epoch_us(proc_end)) / 3.6e9 as hours from procedures window w as (partition by person_id order by proc_start, procedure_id))
SELECT procedure_id, next_id, next_code, hours from w where hours >= 0 and hours <= 720""", "hours")(lambda t: C.second_procedure(t.procedures))
query("c36_disposition_and_cost", "visits", "SELECT visit_id, case visit_id % 3 when 0 then 'home' when 1 then 'hospice' else 'other' end place, charge / 1000 cost_k, case when date_diff('day', start_at, end_at) >= 2 then 1 else 0 end prolonged from visits", "cost_k")(
    lambda t: t.visits.select("visit_id", S.discharge_place(F.when(c("visit_id") % 3 == 0, "Home").when(c("visit_id") % 3 == 1, "Hospice care").otherwise("Elsewhere")).alias("place"), (c("charge") / 1000).alias("cost_k"), (S.elapsed("day", c("start_at"), c("end_at")) >= 2).cast("int").alias("prolonged"))
)
query("c37_order_flags", "visits exposures", """SELECT v.visit_id, max(case when exp_start < start_at then 1 else 0 end) before_anchor, max(case when start_at between exp_start and exp_end then 1 else 0 end) active_at_anchor from visits v join exposures e on e.person_id = v.person_id and exp_start <= end_at and exp_end >= start_at group by 1""")(
    lambda t: joins.overlap_join(t.visits.select("visit_id", "person_id", "start_at", "end_at"), t.exposures.select("person_id", "exp_start", "exp_end"), key="person_id", a_start="start_at", a_end="end_at", b_start="exp_start", b_end="exp_end").groupBy("visit_id").agg(F.max((c("exp_start") < c("start_at")).cast("int")).alias("before_anchor"), F.max(c("start_at").between(c("exp_start"), c("exp_end")).cast("int")).alias("active_at_anchor"))
)
query("c38_demographic_counts", "persons", "e as (select race, count(*) filter (sex = 'F') as \"F\", count(*) filter (sex = 'M') as \"M\", count(*) total from persons group by 1) SELECT * from e union all select 'Total', count(*) filter (sex = 'F'), count(*) filter (sex = 'M'), count(*) from persons")(
    lambda t: C.counts_with_totals(t.persons, ["race"], "sex", ["F", "M"])
)

# --- the extract catalogue: patterns of facts, windows and selections -----------------------------------------------

_CATALOGUE: dict[str, tuple[VariableSpec, str]] = {}
for _name, _spec in {
    "x01_first_in_stay_by_date": VariableSpec("x", "measurements", ("view",), low="start_at", high="end_at", dates=True, nth=1),
    "x02_recent_before_anchor": VariableSpec("x", "measurements", ("click", "view"), low="start_at", high="start_at", before="365 DAYS", nth=-1),
    "x03_recent_unbounded": VariableSpec("x", "measurements", ("signup",), high="start_at", where="value <> 0", nth=-1),
    "x09_average_after_end": VariableSpec("x", "measurements", ("view",), low="end_at", high="end_at", after="4 DAYS", aggregate="avg", fields=("unit",)),
    "x11_max_after_end": VariableSpec("x", "measurements", ("purchase",), low="end_at", high="end_at", after="2 DAYS", aggregate="max"),
    "x13_all_until_end": VariableSpec("x", "measurements", ("error", "purchase"), high="end_at"),
    "x15_stay_by_date": VariableSpec("x", "exposures", ("A",), key="visit_id", low="start_at", high="end_at", dates=True),
    "x21_year_before": VariableSpec("x", "exposures", ("N", "R"), key="visit_id", low="start_at", high="start_at", before="365 DAYS"),
    "x24_year_before_to_end": VariableSpec("x", "exposures", ("N",), key="visit_id", low="start_at", high="end_at", before="365 DAYS"),
    "x27_stay": VariableSpec("x", "measurements", ("view", "click"), low="start_at", high="end_at"),
    "x42_after_start_to_end": VariableSpec("x", "exposures", ("A", "N", "R"), key="visit_id", low="start_at", high="end_at", after="30 DAYS"),
}.items():
    _shape, _s = SHAPES[_spec.table], _spec
    _at = _shape.at
    _fit = (lambda e: f"cast({e} as date)") if _s.dates else (lambda e: e)
    _days = lambda s: s.replace(" SECONDS", " second").replace(" DAYS", " day")
    _terms = [f"{_fit(_at)} >= {_fit(f'{_s.low} - interval {_days(_s.before)}')}"] if _s.low else []
    _terms += [f"{_fit(_at)} <= {_fit(f'{_s.high} + interval {_days(_s.after)}')}"] if _s.high else []
    _terms += [f"{_shape.variable} in ({', '.join(repr(v) for v in _s.variables)})"] if _s.lookup == "inner" else []
    _terms += [_s.where] if _s.where else []
    _from = f"from {_spec.table} f join visits v using ({_s.key}) where {' and '.join(_terms)}"
    _more = "".join(f", {x}" for x in _s.fields)
    if _s.aggregate:
        _sql = f"SELECT visit_id, {_shape.variable} variable_name{_more}, {_s.aggregate}({_shape.value}) as value, count({_shape.value}) n {_from} group by all"
    elif _s.nth:
        _dir = "" if _s.nth > 0 else " desc"
        _sql = f"r as (select visit_id, {_shape.variable} variable_name, {_at} fact_at, {_shape.value} as value, {_shape.unique}, row_number() over (partition by visit_id, {_shape.variable} order by {_at}{_dir}, {_shape.unique}{_dir}) rn {_from}) SELECT visit_id, variable_name, fact_at, value, {_shape.unique} from r where rn = {abs(_s.nth)}"
    else:
        _sql = f"SELECT visit_id, {_shape.variable} variable_name, {_at} fact_at, {_shape.value} as value, {_shape.unique} {_from}"

    def _extract(t: Tables, s: VariableSpec = _s):
        facts = t.measurements if s.table == "measurements" else t.exposures.drop("person_id")
        return compile_spec([s], t.visits.select("visit_id", "person_id", "start_at", "end_at"), {s.table: facts}, SHAPES, subject="visit_id")["x"]

    query(_name, f"visits {_spec.table}", _sql, "value" if _s.aggregate == "avg" else "")(_extract)

query("x12_care_site", "persons", "SELECT person_id, n_name site, case when n_name like 'NATION_1%' then 1 else 0 end first_sites from persons left join nation on n_nationkey = facility_id")(
    lambda t: t.persons.join(t.nation, c("n_nationkey") == c("facility_id"), "left").select("person_id", c("n_name").alias("site"), c("n_name").startswith("NATION_1").cast("int").alias("first_sites"))
)
query("x16_cost", "visits", "SELECT visit_id, sum(l_extendedprice * (1 - l_discount)) * 0.36 cost from visits join lineitem on l_orderkey = visit_id group by 1", "cost")(
    lambda t: t.visits.join(t.lineitem, c("l_orderkey") == c("visit_id")).groupBy("visit_id").agg((F.sum(c("l_extendedprice") * (1 - c("l_discount"))) * 0.36).alias("cost"))
)
query("x38_plan_period", "visits", """p as (select c_custkey person_id, make_date(y, 1, 1) lo, make_date(y, 12, 31) hi, c_mktsegment || y as plan from customer, (select unnest(range(1995, 2001)) y))
SELECT visit_id, plan from visits v left join p on p.person_id = v.person_id and cast(start_at as date) between lo and hi""")(
    lambda t: joins.effective_dated_join(t.visits.select("visit_id", "person_id", F.to_date("start_at").alias("d")), t.customer.withColumn("y", F.explode(F.sequence(F.lit(1995), F.lit(2000)))).select(c("c_custkey").alias("person_id"), F.make_date("y", F.lit(1), F.lit(1)).alias("lo"), F.make_date("y", F.lit(12), F.lit(31)).alias("hi"), F.concat("c_mktsegment", c("y").cast("string")).alias("plan")), keys=["person_id"], at="d", start="lo", end="hi").select("visit_id", "plan")
)
query("x41_primary_and_anaesthesia", "procedures", """a as (select person_id, procedure_id, row_number() over (partition by person_id order by code, procedure_id) rn from procedures), b as (select person_id, procedure_id, row_number() over (partition by person_id order by proc_end desc, procedure_id) rn from procedures)
SELECT person_id, procedure_id from a where rn = 1 union select person_id, procedure_id from b where rn = 1""")(
    lambda t: windows.nth_row(t.procedures, ["person_id"], [c("code"), c("procedure_id")]).select("person_id", "procedure_id").union(windows.nth_row(t.procedures, ["person_id"], [c("proc_end").desc(), c("procedure_id")]).select("person_id", "procedure_id")).distinct()
)
