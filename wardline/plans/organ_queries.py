"""Queries of the organ failure score from raw series, and of sweeps, nearest places, concept hops and global order; their SQL is written apart from the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.operators import intervals, joins, organ, windows
from wardline.plans.cdm import Tables
from wardline.plans.registry import query

c = F.col

_KIND = "case event_id % 9 when 0 then 'pao2' when 1 then 'spo2' when 2 then 'fio2' when 3 then 'platelets' when 4 then 'bilirubin' when 5 then 'creatinine' when 6 then 'coma' when 7 then 'map' else 'weight' end"
_VALUE = "case event_id % 9 when 0 then value * 1.5 when 1 then 60 + value * 0.4 when 2 then 21 + value * 0.5 when 3 then value * 2 when 4 then value / 8 when 5 then value / 20 when 6 then 3 + event_id % 13 when 7 then 40 + value when 8 then 40 + value end"
_DRUG = "case cast(event_id / 5 as bigint) % 4 when 0 then 'dopamine' when 1 then 'epinephrine' when 2 then 'norepinephrine' else 'dobutamine' end"
_RATE = "case when cast(event_id / 5 as bigint) % 4 = 0 then value * 12 else value / 8 end"


def _readings(t: Tables) -> DataFrame:
    return t.events.select("event_id", c("user_id").alias("person_id"), "ts", F.expr(_KIND).alias("kind"), F.expr(_VALUE).alias("value"))


def _stays(t: Tables) -> DataFrame:
    return t.events.groupBy(c("user_id").alias("person_id")).agg(F.min("ts").alias("_from")).withColumn("_to", c("_from") + F.expr("interval 10 days"))


def _pressors(t: Tables) -> DataFrame:
    drugs = t.events.where("event_id % 5 = 0").select(c("user_id").alias("person_id"), c("ts").alias("s"), F.expr("ts + make_dt_interval(0, cast(event_id % 6 as int))").alias("e"), F.expr(_DRUG).alias("drug"), F.expr(_RATE).alias("rate"))
    weights = organ.first_weights(_readings(t).where("kind = 'weight'"), by=["person_id"], at="ts", weight="value", pounds=c("event_id") % 2 == 0, tie=["event_id"])
    return organ.pressor_hours(drugs, weights, by=["person_id"], start="s", end="e", drug="drug", rate="rate")


def _ventilated(t: Tables) -> DataFrame:
    return organ.whole_hours(t.events.where("event_id % 11 = 0").select(c("user_id").alias("person_id"), "ts", F.expr("ts + make_dt_interval(0, cast(1 + event_id % 12 as int))").alias("until")), by=["person_id"], start="ts", end="until", keep=[])


_SQL_READ = f"r as (select event_id, user_id as person_id, ts, {_KIND} kind, {_VALUE} v from events), f as (select * from r where kind = 'fio2' and v is not null)"
_SQL_OXY = _SQL_READ + """, o as (select b.person_id, b.ts, b.kind, case b.kind when 'pao2' then b.v / (coalesce(f.v, 21) / 100) else (b.v / (coalesce(f.v, 21) / 100) - 64) / 0.84 end ratio
  from (select * from r where kind in ('pao2', 'spo2') and v is not null) b asof left join f on b.person_id = f.person_id and b.ts >= f.ts)"""
_SQL_PRESS = """w as (select person_id, arg_min(case when event_id % 2 = 0 then v / 2.205 else v end, (ts, event_id)) kg from r where kind = 'weight' and v is not null group by 1),
d as (select user_id as person_id, ts s, ts + to_hours(event_id % 6) e, (event_id // 5) % 4 drug, value from events where event_id % 5 = 0),
dd as (select d.*, case when drug = 0 then value * 12 else value / 8 end / coalesce(kg, 70) dose from d left join w using (person_id)),
dp as (select *, case when drug = 3 then 2 when dose is null then null when drug in (1, 2) then case when dose > 0.1 then 4 else 3 end when dose > 15 then 4 when dose > 5 then 3 else 2 end points from dd),
ph as (select person_id, hour, max(points) pressor from (select person_id, points, unnest(generate_series(date_trunc('hour', s), case when date_trunc('hour', e) < e then date_trunc('hour', e) + interval 1 hour else date_trunc('hour', e) end, interval 1 hour)) as hour from dp where points is not null) group by all)"""

query("c28_oxygenation", "", _SQL_OXY + " SELECT person_id, ts, case when kind = 'pao2' then ratio end pf, case when kind = 'spo2' then ratio end sf from o where kind = 'pao2' or ratio > 0", "pf sf")(
    lambda t: organ.oxygenation(_readings(t), by=["person_id"], at="ts", tie=["event_id"])
)
query("c30_pressor_hours", "", _SQL_READ + ", " + _SQL_PRESS + " SELECT person_id, cast(hour as timestamp) as hour, pressor from ph")(_pressors)
query("c28_sofa_from_series", "", _SQL_OXY + ", " + _SQL_PRESS + """, band as (select person_id, date_trunc('hour', ts) as hour, max(case when kind <> 'pao2' then null when ratio < 100 then 4 when ratio < 200 then 3 when ratio < 300 then 2 when ratio < 400 then 1 else 0 end) pf,
  max(case when kind <> 'spo2' then null when ratio < 100 then 4 when ratio < 200 then 3 when ratio < 300 then 2 when ratio < 400 then 1 else 0 end) sf from o where kind = 'pao2' or ratio > 0 group by all),
one as (select person_id, date_trunc('hour', ts) as hour,
  max(case when kind <> 'platelets' or v is null then null when v < 20 then 4 when v < 50 then 3 when v < 100 then 2 when v < 150 then 1 else 0 end) coagulation,
  max(case when kind <> 'bilirubin' or v is null then null when v > 12 then 4 when v >= 6 then 3 when v >= 2 then 2 when v >= 1.2 then 1 else 0 end) liver,
  max(case when kind <> 'creatinine' or v is null then null when v > 5 then 4 when v >= 3.5 then 3 when v >= 2 then 2 when v >= 1.2 then 1 else 0 end) renal,
  max(case when kind <> 'coma' or v is null then null when v < 6 then 4 when v <= 9 then 3 when v <= 12 then 2 when v <= 14 then 1 else 0 end) consciousness,
  max(case when kind <> 'map' or v is null then null when v < 70 then 1 else 0 end) pressure from r group by all),
vh as (select distinct person_id, unnest(generate_series(date_trunc('hour', ts), case when date_trunc('hour', u) < u then date_trunc('hour', u) + interval 1 hour else date_trunc('hour', u) end, interval 1 hour)) as hour from (select user_id as person_id, ts, ts + to_hours(1 + event_id % 12) u from events where event_id % 11 = 0)),
g as (select person_id, unnest(generate_series(date_trunc('hour', lo), date_trunc('hour', lo + interval 10 day), interval 1 hour)) as hour from (select user_id as person_id, min(ts) lo from events group by 1)),
h as (select g.person_id, g.hour, pf, sf, coagulation, liver, renal, consciousness, case when pressure is not null or pressor is not null then coalesce(pressure, 0) + coalesce(pressor, 0) end circulation, case when vh.hour is not null then 1 else 0 end machine
  from g left join one using (person_id, hour) left join band using (person_id, hour) left join ph using (person_id, hour) left join vh using (person_id, hour)),
d24 as (select person_id, hour, max(pf) over w pf, max(sf) over w sf, max(coagulation) over w coagulation, max(liver) over w liver, max(renal) over w renal, max(consciousness) over w consciousness, max(circulation) over w circulation, max(machine) over w machine from h window w as (partition by person_id order by hour rows between 23 preceding and current row)),
ff as (select person_id, hour, last_value(pf ignore nulls) over w pf, last_value(sf ignore nulls) over w sf, last_value(coagulation ignore nulls) over w coagulation, last_value(liver ignore nulls) over w liver, last_value(renal ignore nulls) over w renal, last_value(consciousness ignore nulls) over w consciousness,
  last_value(circulation ignore nulls) over w circulation, machine from d24 window w as (partition by person_id order by hour rows between 24 preceding and current row)),
z as (select person_id, cast(hour as timestamp) as hour, case when machine = 1 then greatest(pf, sf, machine) else least(greatest(pf, sf, machine), 2) end respiration, coagulation, liver, case when person_id in (select c_custkey from customer where c_mktsegment = 'BUILDING') then 4 else renal end renal, consciousness, circulation from ff)
SELECT *, coalesce(respiration, 0) + coalesce(coagulation, 0) + coalesce(liver, 0) + coalesce(renal, 0) + coalesce(consciousness, 0) + coalesce(circulation, 0) total from z""")(
    lambda t: organ.sofa(_readings(t), _pressors(t), _ventilated(t), _stays(t), by=["person_id"], at="ts", tie=["event_id"], end_stage=t.customer.where("c_mktsegment = 'BUILDING'").select(c("c_custkey").alias("person_id")))
)

# --- counts of overlaps, nearest places ----------------------------------------------------------------------------

query("i3_active_counts", "locations", """e as (select person_id, loc_start b, 1 d from locations where loc_start < loc_end union all select person_id, loc_end, -1 from locations where loc_start < loc_end), s as (select person_id, b, sum(d) d from e group by all),
q as (select person_id, b seg_start, lead(b) over w seg_end, cast(sum(d) over w as bigint) n_active from s window w as (partition by person_id order by b)) SELECT * from q where n_active > 0""")(
    lambda t: intervals.active_counts(t.locations, by=["person_id"], start="loc_start", end="loc_end")
)
query("j11_nearest_supplier", "", """k as (select c_custkey k, (c_custkey * 7919 % 18000) / 100.0 - 90 x, (c_custkey * 104729 % 36000) / 100.0 - 180 y from customer), r as (select s_suppkey n, (s_suppkey * 6133 % 18000) / 100.0 - 90 x, (s_suppkey * 15485 % 36000) / 100.0 - 180 y from supplier),
a as (select k, n, sqrt((k.x - r.x) ** 2 + (k.y - r.y) ** 2) d from k, r)
SELECT k, cast(arg_min(n, (d, n)) as varchar) nearest, min(d) distance from a group by k""", "distance")(
    lambda t: joins.nearest_neighbour(
        t.customer.select(c("c_custkey").alias("k"), ((c("c_custkey") * 7919 % 18000) / 100.0 - 90).alias("x"), ((c("c_custkey") * 104729 % 36000) / 100.0 - 180).alias("y")),
        t.supplier.select(c("s_suppkey").alias("k"), ((c("s_suppkey") * 6133 % 18000) / 100.0 - 90).alias("x"), ((c("s_suppkey") * 15485 % 36000) / 100.0 - 180).alias("y")), key="k", x="x", y="y",
    )
)
query("j13_anti_join_status", "", "SELECT c_custkey from customer where not exists (select 1 from orders where o_custkey = c_custkey and o_orderpriority = '1-URGENT' and o_totalprice > 250000)")(
    lambda t: t.customer.select("c_custkey").join(t.orders.where("o_orderpriority = '1-URGENT' and o_totalprice > 250000").select(c("o_custkey").alias("c_custkey")), "c_custkey", "left_anti")
)
# parts as concepts: part n contains part n // 3, every seventh is replaced by one that leads back to the top (a cycle)
query("j16_concept_hops", "", """recursive edges as (select p_partkey // 3 f, p_partkey t, 'contains' kind from part where p_partkey > 0 union all select p_partkey, p_partkey // 9, 'replaces' from part where p_partkey % 7 = 0 union all select p_partkey, p_partkey + 1, 'other' from part),
seeds as (select 'first' variable, 4 id union all select 'first', 5 union all select 'second', 2), no as (select 'first' variable, 14 id union all select 'second', 6),
walk as (select variable, id, 0 hops from seeds union select w.variable, e.t, w.hops + 1 from walk w join edges e on e.f = w.id and e.kind <> 'other' where w.hops < 5 and (w.variable, e.t) not in (select variable, id from no))
SELECT variable, cast(id as bigint) concept_id, cast(min(hops) as int) hops from walk where id in (select p_partkey from part where (p_name like '%ring' or p_name like 'red%') and p_name not like 'large%') group by 1, 2""")(lambda t: _hops(t))
query("t1_global_sort", "", "SELECT o_orderkey, row_number() over (order by o_totalprice desc, o_orderkey) - 1 as position from orders")(
    lambda t: windows.sort_globally(t.orders.select("o_orderkey", "o_totalprice"), [c("o_totalprice").desc(), c("o_orderkey")]).select("o_orderkey", "position")
)


def _hops(t: Tables) -> DataFrame:
    n, edge = c("p_partkey"), lambda d, f, to, kind: d.select(f.alias("from_id"), to.alias("to_id"), F.lit(kind).alias("kind"))
    edges = edge(t.part.where(n > 0), F.floor(n / 3), n, "contains").union(edge(t.part.where(n % 7 == 0), n, F.floor(n / 9), "replaces")).union(edge(t.part, n, n + 1, "other"))
    seeds = t.spark.createDataFrame([("first", 4), ("first", 5), ("second", 2)], "variable string, concept_id long")
    return joins.concept_hops(seeds, edges, t.part.select(n.alias("concept_id"), c("p_name").alias("name")), most_hops=5, kinds=["contains", "replaces"], like=["%ring", "red%"], not_like=["large%"], excluded=t.spark.createDataFrame([("first", 14), ("second", 6)], "variable string, concept_id long"))
