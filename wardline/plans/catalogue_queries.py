"""The extract catalogue: facts, windows around stays and procedures, and selections, each a declared variable or a short plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.functions import scalars as S
from wardline.operators import joins, typing_ops, windows
from wardline.plans.cdm import Tables
from wardline.plans.registry import query
from wardline.plans.spec import FactTable, VariableSpec, compile_spec

c = F.col

SHAPES = {
    "measurements": FactTable("variable", "taken_at", "value", "measurement_id"),
    "observations": FactTable("variable", "seen_at", "concept", "observation_id"),
    "exposures": FactTable("drug_class", "exp_start", "quantity", "drug_id"),
    "conditions": FactTable("variable", "found_at", "poa", "condition_id"),
    "devices": FactTable("variable", "used_at", "quantity", "device_id"),
    "acts": FactTable("variable", "done_at", "work", "act_id"),
}
#: Views that a table's SQL is built on.
_ON = {"observations": "measurements observations", "acts": "acts"}

_LATER = "cast(done_at as date) > cast(proc_start as date)"
_NEXT = "cast(seen_at as date) > cast(proc_start as date)"
_URGENT = ("1-URGENT", "2-HIGH")
_YEAR = {"low": "start_at", "before": "365 DAYS"}
_STAY = {"low": "start_at", "high": "end_at"}
_PROCEDURE = {"low": "proc_start", "high": "proc_end"}

CATALOGUE: dict[str, VariableSpec] = {
    "x04_first_in_stay_by_branch": VariableSpec("x", "observations", ("view", "click", "signup"), **_STAY, branches=("variable = 'view'", "concept <> 0"), nth=1),
    "x05_next_procedure_observation": VariableSpec("x", "observations", ("view", "purchase"), high="end_at", branches=(_NEXT,), nth=1),
    "x06_next_procedure_by_work": VariableSpec("x", "acts", (), high="end_at", branches=(_LATER,), nth=1, value_order="-work"),
    "x07_next_procedure_times": VariableSpec("x", "acts", _URGENT, high="end_at", branches=(_LATER,), nth=1),
    "x10_average_observation_after": VariableSpec("x", "observations", ("view", "error"), low="proc_end", high="proc_end", after="4 DAYS", aggregate="avg"),
    "x18_devices_until_end": VariableSpec("x", "devices", ("dialysis",), high="end_at"),
    "x19_devices_by_period": VariableSpec("x", "devices", ("red cells", "ventilator"), **_STAY, period=("proc_start", "proc_end")),
    "x22_drugs_in_stay": VariableSpec("x", "exposures", ("A", "R"), key="visit_id", **_STAY),
    "x25_labs_year_to_end": VariableSpec("x", "measurements", ("click", "view"), high="end_at", **_YEAR),
    "x26_labs_until_end": VariableSpec("x", "measurements", ("view",), high="end_at"),
    "x30_year_to_procedure": VariableSpec("x", "measurements", ("signup",), high="proc_start", **_YEAR),
    "x31_year_to_end": VariableSpec("x", "measurements", ("purchase",), high="end_at", **_YEAR),
    "x32_during_procedure": VariableSpec("x", "measurements", ("view", "click", "purchase", "signup", "error"), **_PROCEDURE),
    "x33_stay_branches_by_period": VariableSpec("x", "measurements", ("view", "click", "error"), **_STAY, branches=("variable = 'view' and value > 10", "variable <> 'view' and taken_at >= proc_start"), period=("proc_start", "proc_end")),
    "x34_observations_until_end": VariableSpec("x", "observations", ("error",), high="end_at"),
    "x35_same_date": VariableSpec("x", "observations", ("view", "click", "signup"), low="proc_start", high="proc_start", dates=True, branches=("variable = 'view'", "concept > 1")),
    "x36_observed_during_procedure": VariableSpec("x", "observations", ("view", "click", "purchase"), **_PROCEDURE, branches=("variable = 'click'", "concept <> 0")),
    "x37_screens_in_stay": VariableSpec("x", "observations", ("error",), **_STAY),
    "x40_procedures_until_end": VariableSpec("x", "acts", _URGENT, high="end_at"),
    "x50_earlier_first_in_stay": VariableSpec("x", "measurements", ("view", "click"), **_STAY, dates=True, nth=1),
    "x52_conditions_to_two_months": VariableSpec("x", "conditions", ("AF", "RF"), low="start_at", high="end_at", after="60 DAYS"),
}


def spec_sql(s: VariableSpec) -> str:
    """The extract in SQL over ``stays`` and the fact's view."""
    shape = SHAPES[s.table]
    fit = (lambda e: f"cast({e} as date)") if s.dates else (lambda e: e)
    days = lambda x: x.replace(" SECONDS", " second").replace(" DAYS", " day")
    terms = [f"{fit(shape.at)} >= {fit(f'{s.low} - interval {days(s.before)}')}"] if s.low else []
    terms += [f"{fit(shape.at)} <= {fit(f'{s.high} + interval {days(s.after)}')}"] if s.high else []
    terms += [f"{shape.variable} in ({', '.join(map(repr, s.variables))})"] if s.variables else []
    terms += ["(" + " or ".join(f"({b})" for b in s.branches) + ")"] if s.branches else []
    source = f"from {s.table} f join stays v using ({s.key}) where {' and '.join(terms)}"
    period = f", case when {shape.at} < {s.period[0]} then 'preop' when {shape.at} <= {s.period[1]} then 'intraop' else 'postop' end period" if s.period else ""
    if s.aggregate:
        return f"SELECT v.visit_id, {shape.variable} variable_name, {s.aggregate}({shape.value}) as value, count({shape.value}) n {source} group by all"
    each = f"v.visit_id, {shape.variable} variable_name, {shape.at} fact_at, {shape.value} as value, {shape.unique}{period}"
    if not s.nth:
        return f"SELECT {each} {source}"
    then = f", {s.value_order}" if s.value_order else ""
    return f"r as (select {each}, row_number() over (partition by v.visit_id, {shape.variable} order by {shape.at}{then}, {shape.unique}) rn {source}) SELECT visit_id, variable_name, fact_at, value, {shape.unique} from r where rn = {s.nth}"


for _name, _spec in CATALOGUE.items():

    def _extract(t: Tables, s: VariableSpec = _spec):
        return compile_spec([s], t.stays, {s.table: getattr(t, s.table)}, SHAPES, subject="visit_id")["x"]

    query(_name, f"visits procedures stays {_ON.get(_spec.table, _spec.table)}", spec_sql(_spec), "value" if _spec.aggregate == "avg" else "")(_extract)

_STAYS = "visits procedures stays"
query("x17_deaths", "visits deaths", "SELECT visit_id, death_at from visits join deaths using (person_id)")(lambda t: t.visits.select("visit_id", "person_id").join(t.deaths, "person_id").select("visit_id", "death_at"))
query("x23_drug_by_ingredient", f"{_STAYS} exposures", """SELECT visit_id, p_brand ingredient, drug_id, exp_start, quantity * p_size / 10.0 dose from exposures join stays using (visit_id) join part on p_partkey = drug_id where quantity <> 0 and exp_start between start_at and end_at and p_brand in ('Brand#1', 'Brand#2', 'Brand#11', 'Brand#12')""", "dose")(
    lambda t: t.exposures.drop("person_id").where("quantity <> 0").join(t.stays, "visit_id").where(typing_ops.window_filter(c("exp_start"), c("start_at"), c("end_at"))).join(t.part.where(c("p_brand").isin("Brand#1", "Brand#2", "Brand#11", "Brand#12")), c("p_partkey") == c("drug_id")).select("visit_id", c("p_brand").alias("ingredient"), "drug_id", "exp_start", (c("quantity") * c("p_size") / 10.0).alias("dose"))
)
_ADDRESS = "h as (select c_custkey person_id, make_date(y, 1, 1) lo, make_date(y, 12, 31) hi, c_mktsegment || y as place from customer, (select unnest([1994, 1996, 1998]) y) where c_custkey % 2 = 0)"
_address = lambda t: t.customer.where("c_custkey % 2 = 0").withColumn("y", F.explode(F.array(*map(F.lit, (1994, 1996, 1998))))).select(c("c_custkey").alias("person_id"), F.make_date("y", F.lit(1), F.lit(1)).alias("lo"), F.make_date("y", F.lit(12), F.lit(31)).alias("hi"), F.concat("c_mktsegment", c("y").cast("string")).alias("place"))
query("x28_address_at_procedure", f"persons {_STAYS}", _ADDRESS + " SELECT visit_id, coalesce(place, n_name) address from stays s join persons p using (person_id) join nation on n_nationkey = facility_id left join h on h.person_id = s.person_id and cast(proc_start as date) between lo and hi")(
    lambda t: joins.effective_dated_join(t.stays.withColumn("d", F.to_date("proc_start")).join(t.persons.select("person_id", "facility_id"), "person_id"), _address(t), keys=["person_id"], at="d", start="lo", end="hi").join(t.nation, c("n_nationkey") == c("facility_id")).select("visit_id", F.coalesce("place", "n_name").alias("address"))
)
query("x29_facility_address", "persons visits", "SELECT visit_id, n_name facility, r_name area from visits join persons using (person_id) join nation on n_nationkey = facility_id join region on r_regionkey = n_regionkey")(
    lambda t: t.visits.join(t.persons.select("person_id", "facility_id"), "person_id").join(t.nation, c("n_nationkey") == c("facility_id")).join(t.region, c("r_regionkey") == c("n_regionkey")).select("visit_id", c("n_name").alias("facility"), c("r_name").alias("area"))
)
query("x39_person", "persons visits", "SELECT visit_id, birth_date, sex, race, facility_id from visits join persons using (person_id)")(lambda t: t.visits.join(t.persons, "person_id").select("visit_id", "birth_date", "sex", "race", "facility_id"))
query("x43_stations_during_procedure", f"{_STAYS} measurements stations", "SELECT visit_id, station_id, label from stations join stays using (person_id) where cast(loc_start as date) between cast(proc_start as date) and cast(proc_end as date)")(
    lambda t: t.stations.join(t.stays, "person_id").where(typing_ops.window_filter(c("loc_start"), c("proc_start"), c("proc_end"), dates=True)).select("visit_id", "station_id", "label")
)
query("x44_station_at_procedure_start", f"{_STAYS} measurements stations", "SELECT visit_id, station_id, label from stations join stays using (person_id) where proc_start between loc_start and loc_end")(
    lambda t: joins.interval_join(t.stays.select("visit_id", "person_id", "proc_start"), t.stations, key="person_id", at="proc_start", start="loc_start", end="loc_end").select("visit_id", "station_id", "label")
)
query("x45_station_by_id", f"{_STAYS} measurements stations", "SELECT visit_id, label, coalesce(loc_start, proc_start) begins, coalesce(loc_end, proc_end) ends from stays left join stations on station_id = visit_id")(
    lambda t: t.stays.join(t.stations.drop("person_id"), c("station_id") == c("visit_id"), "left").select("visit_id", "label", F.coalesce("loc_start", "proc_start").alias("begins"), F.coalesce("loc_end", "proc_end").alias("ends"))
)
_KINDS = "kinds as (select event_type as label, min(user_id) % 3 kind from events where event_type <> 'signup' group by 1)"
query("x46_stations_with_left_lookup", f"{_STAYS} measurements stations", _KINDS + " SELECT visit_id, station_id, label, kind from stations join stays using (person_id) left join kinds using (label) where loc_start between start_at and end_at")(
    lambda t: joins.interval_join(t.stations, t.stays.select("visit_id", "person_id", "start_at", "end_at"), key="person_id", at="loc_start", start="start_at", end="end_at").join(t.events.where("event_type <> 'signup'").groupBy(c("event_type").alias("label")).agg((F.min("user_id") % 3).alias("kind")), "label", "left").select("visit_id", "station_id", "label", "kind")
)
query("x47_visit_fields", "visits", "SELECT visit_id, start_at, end_at, status, charge from visits where visit_id in (select l_orderkey from lineitem)")(
    lambda t: t.visits.join(t.lineitem.select(c("l_orderkey").alias("visit_id")), "visit_id", "left_semi").select("visit_id", "start_at", "end_at", "status", "charge")
)
query("x48_emergency_flag", "visits", "k as (select o_orderkey visit_id, o_orderpriority as source from orders where o_orderpriority <> '5-LOW') SELECT visit_id, case when source = '1-URGENT' then 1 when source is not null then 0 end emergency from visits left join k using (visit_id)")(
    lambda t: t.visits.join(t.orders.where("o_orderpriority <> '5-LOW'").select(c("o_orderkey").alias("visit_id"), c("o_orderpriority").alias("source")), "visit_id", "left").select("visit_id", F.when(c("source") == "1-URGENT", 1).when(c("source").isNotNull(), 0).alias("emergency"))
)
# a visit that stands for others of its person: the one of least id; facts of all are read under it
_PARENT = "parents as (select visit_id, min(visit_id) over (partition by person_id, cast(start_at as date)) parent_id from visits)"
_parents = lambda t: t.visits.groupBy("person_id", F.to_date("start_at").alias("day")).agg(F.min("visit_id").alias("parent_id")).join(t.visits.withColumn("day", F.to_date("start_at")), ["person_id", "day"]).select("visit_id", "parent_id")
query("x49_parent_visit", "visits", _PARENT + " SELECT parent_id visit_id, count(*) n_visits, min(start_at) start_at, max(end_at) end_at, sum(charge) charge from parents join visits using (visit_id) group by 1", "charge")(
    lambda t: _parents(t).join(t.visits, "visit_id").groupBy(c("parent_id").alias("visit_id")).agg(F.count("*").alias("n_visits"), F.min("start_at").alias("start_at"), F.max("end_at").alias("end_at"), F.sum("charge").alias("charge"))
)
query("c4_extract_under_parent", "visits exposures", _PARENT + ", w as (select parent_id, min(start_at) lo, max(end_at) hi from parents join visits using (visit_id) group by 1) SELECT w.parent_id visit_id, drug_class variable_name, count(*) n, sum(quantity) quantity from exposures join parents using (visit_id) join w on w.parent_id = parents.parent_id where exp_start between lo - interval 30 day and hi group by 1, 2", "quantity")(
    lambda t: (lambda p: t.exposures.drop("person_id").join(p, "visit_id").join(p.join(t.visits, "visit_id").groupBy("parent_id").agg(F.min("start_at").alias("lo"), F.max("end_at").alias("hi")), "parent_id"))(_parents(t)).where(typing_ops.window_filter(c("exp_start"), c("lo"), c("hi"), before="30 DAYS")).groupBy(c("parent_id").alias("visit_id"), c("drug_class").alias("variable_name")).agg(F.count("*").alias("n"), F.sum("quantity").alias("quantity"))
)
query("x51_last_weight_in_one_unit", f"{_STAYS} measurements", """r as (select visit_id, variable, case unit when 'mg/dl' then value when 'g/l' then value * 0.45359237 end kg, row_number() over (partition by visit_id, variable order by taken_at desc, measurement_id desc) rn from measurements join stays using (person_id) where variable in ('view', 'click') and unit is not null and value is not null and taken_at between start_at - interval 365 day and proc_start)
SELECT visit_id, variable, kg from r where rn = 1""", "kg")(
    lambda t: windows.nth_row(t.measurements.where("variable in ('view', 'click') and unit is not null and value is not null").join(t.stays, "person_id").where(typing_ops.window_filter(c("taken_at"), c("start_at"), c("proc_start"), before="365 DAYS")), ["visit_id", "variable"], [c("taken_at").desc(), c("measurement_id").desc()]).select("visit_id", "variable", S.convert_unit(c("value"), c("unit"), {"mg/dl": 1.0, "g/l": 0.45359237}).alias("kg"))
)
query("x51_distinct_drugs_before", f"{_STAYS} exposures", "SELECT distinct visit_id, drug_class, drug_id from exposures join stays using (visit_id) where exp_start between start_at - interval 365 day and proc_start")(
    lambda t: t.exposures.drop("person_id").join(t.stays, "visit_id").where(typing_ops.window_filter(c("exp_start"), c("start_at"), c("proc_start"), before="365 DAYS")).select("visit_id", "drug_class", "drug_id").distinct()
)
query("x52_ventilation_soon_after", f"{_STAYS} devices", "SELECT visit_id, max(case when used_at between proc_end + interval 1 hour and proc_end + interval 72 hour then 1 else 0 end) ventilated from stays s left join devices d on d.person_id = s.person_id and variable = 'ventilator' group by 1")(
    lambda t: t.stays.join(t.devices.where("variable = 'ventilator'").select(c("person_id").alias("p"), "used_at"), c("person_id") == c("p"), "left").groupBy("visit_id").agg(F.max(F.coalesce(c("used_at").between(c("proc_end") + F.expr("interval 1 hour"), c("proc_end") + F.expr("interval 72 hours")).cast("int"), F.lit(0))).alias("ventilated"))
)
query("x53_kidney_inputs", f"{_STAYS} measurements conditions devices acts", """SELECT visit_id, 'creatinine' kind, variable as code, taken_at as at from measurements join stays using (person_id) where variable = 'view' and value is not null and taken_at <= end_at
union select visit_id, 'diagnosis', variable, found_at from conditions join stays using (person_id) where found_at <= end_at + interval 60 day
union select visit_id, 'dialysis', 'device', used_at from devices join stays using (person_id) where variable = 'dialysis' and used_at <= end_at
union select visit_id, 'dialysis', 'procedure', done_at from acts join stays using (person_id) where variable = '1-URGENT' and done_at <= end_at""")(
    lambda t: _kidney_inputs(t)
)


def _kidney_inputs(t: Tables) -> DataFrame:
    """Facts are made distinct a person before they meet the stays, which are far more rows; afterwards only where a visit stands for several persons."""
    stays = t.stays.groupBy("visit_id", "person_id").agg(F.max("end_at").alias("end_at"))
    facts = lambda f, kind, code, at, days: f.select("person_id", F.lit(kind).alias("kind"), code.alias("code"), c(at).alias("at"), F.lit(days).alias("days"))
    rows = (
        facts(t.measurements.where("variable = 'view' and value is not null"), "creatinine", c("variable"), "taken_at", 0)
        .union(facts(t.conditions, "diagnosis", c("variable"), "found_at", 60))
        .union(facts(t.devices.where("variable = 'dialysis'"), "dialysis", F.lit("device"), "used_at", 0))
        .union(facts(t.acts.where("variable = '1-URGENT'"), "dialysis", F.lit("procedure"), "done_at", 0))
    ).distinct()
    out = rows.join(stays, "person_id").where(c("at") <= c("end_at") + F.make_dt_interval(c("days"))).select("visit_id", "kind", "code", "at")
    shared = t.visits.groupBy("visit_id").agg((F.min("person_id") != F.max("person_id")).alias("several")).where("several")
    return out if shared.isEmpty() else out.distinct()


query("x08_hospice_and_planned_return", "visits", """SELECT v.visit_id, max(case when w.visit_id is not null then 1 else 0 end) readmitted, max(case when w.status = 'F' then 1 else 0 end) hospice, max(case when w.status = 'P' then 1 else 0 end) planned from visits v left join visits w on w.person_id = v.person_id and w.visit_id <> v.visit_id and w.start_at between v.end_at and v.end_at + interval 30 day group by 1""")(
    lambda t: joins.followup_flags(t.visits.select("person_id", "visit_id", "start_at", "end_at", "status"), person="person_id", visit="visit_id", start="start_at", end="end_at", days=30, flags={"readmitted": F.lit(True), "hospice": c("status") == "F", "planned": c("status") == "P"})
)
query("x14_left_lookup", f"{_STAYS} measurements", _KINDS + " SELECT visit_id, measurement_id, variable, kind from measurements join stays using (person_id) left join kinds on label = variable where taken_at <= start_at")(
    lambda t: t.measurements.join(t.stays, "person_id").where(typing_ops.window_filter(c("taken_at"), None, c("start_at"))).join(t.events.where("event_type <> 'signup'").groupBy(c("event_type").alias("variable")).agg((F.min("user_id") % 3).alias("kind")), "variable", "left").select("visit_id", "measurement_id", "variable", "kind")
)
query("x20_order_classes", "visits exposures", """o as (select person_id, exp_start, exp_end, case when drug_class = 'A' then 'do not resuscitate' when quantity > 25 then 'comfort care' else 'limited' end class from exposures)
SELECT visit_id, class, max(case when exp_start < start_at then 1 else 0 end) before_stay, max(case when exp_end >= end_at then 1 else 0 end) active_at_end from visits v join o on o.person_id = v.person_id and exp_start <= end_at and exp_end >= start_at group by 1, 2""")(
    lambda t: joins.overlap_join(t.visits.select("visit_id", "person_id", "start_at", "end_at"), t.exposures.select("person_id", "exp_start", "exp_end", F.when(c("drug_class") == "A", "do not resuscitate").when(c("quantity") > 25, "comfort care").otherwise("limited").alias("class")), key="person_id", a_start="start_at", a_end="end_at", b_start="exp_start", b_end="exp_end")
    .groupBy("visit_id", "class").agg(F.max((c("exp_start") < c("start_at")).cast("int")).alias("before_stay"), F.max((c("exp_end") >= c("end_at")).cast("int")).alias("active_at_end"))
)
