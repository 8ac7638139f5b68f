"""Queries over joins, windows, intervals, aggregates and typing."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardline.functions import scalars as S
from wardline.operators import aggs, intervals, joins, stats, timeseries, typing_ops, windows
from wardline.plans.registry import query

c = F.col

# --- windowed facts -------------------------------------------------------------------------------------------

query("w1_most_recent_measurement", "visits measurements", """a as (select person_id, min(start_at) + interval 15 day anchor from visits group by 1),
r as (select m.*, anchor, row_number() over (partition by m.person_id, variable order by taken_at desc, measurement_id desc) rn from measurements m join a using (person_id) where taken_at between anchor - interval 365 day and anchor)
SELECT person_id, variable, taken_at, value, anchor from r where rn = 1""", "value")(
    lambda t: windows.nth_row(
        t.measurements.join(t.visits.groupBy("person_id").agg((F.min("start_at") + F.expr("interval 15 days")).alias("anchor")), "person_id").where(typing_ops.window_filter(c("taken_at"), c("anchor"), c("anchor"), before="365 DAYS")),
        ["person_id", "variable"], [c("taken_at").desc(), c("measurement_id").desc()],
    ).select("person_id", "variable", "taken_at", "value", "anchor")
)
query("w1_first_per_visit", "visits exposures", """r as (select visit_id, drug_class, drug_id, exp_start, row_number() over (partition by visit_id, drug_class order by exp_start, drug_id, quantity, exp_end) rn from exposures)
SELECT visit_id, drug_class, drug_id, exp_start from r where rn = 1""")(
    lambda t: windows.nth_row(t.exposures, ["visit_id", "drug_class"], [c("exp_start"), c("drug_id"), c("quantity"), c("exp_end")]).select("visit_id", "drug_class", "drug_id", "exp_start")
)
query("w2_priority_row", "", """r as (select o_custkey, o_orderkey, o_orderpriority, row_number() over (partition by o_custkey order by case o_orderpriority when '1-URGENT' then 1 when '2-HIGH' then 2 else 3 end, o_totalprice desc, o_orderkey) rn from orders)
SELECT o_custkey, o_orderkey, o_orderpriority from r where rn = 1""")(
    lambda t: windows.nth_row(t.orders, ["o_custkey"], [F.when(c("o_orderpriority") == "1-URGENT", 1).when(c("o_orderpriority") == "2-HIGH", 2).otherwise(3), c("o_totalprice").desc(), c("o_orderkey")]).select("o_custkey", "o_orderkey", "o_orderpriority")
)
query("w3_latest_per_level", "measurements", "SELECT person_id, variable, max(taken_at) taken_at, arg_max(measurement_id, (taken_at, measurement_id)) measurement_id from measurements group by all")(
    lambda t: t.measurements.groupBy("person_id", "variable").agg(F.max(F.struct("taken_at", "measurement_id")).alias("m")).select("person_id", "variable", "m.taken_at", "m.measurement_id")
)
query("w4_change_runs", "", """a as (select *, case when row_number() over w = 1 then 1 when event_type is distinct from lag(event_type) over w then 1 else 0 end changed from events window w as (partition by user_id order by ts))
SELECT event_id, changed, cast(sum(changed) over (partition by user_id order by ts) as bigint) run from a""")(
    lambda t: windows.change_runs(t.events, ["user_id"], ["ts"], "event_type").select("event_id", "changed", "run")
)
query("w5_next_start_as_end", "", "SELECT event_id, coalesce(lead(ts) over (partition by user_id order by ts) - interval 1 second, timestamp '2024-02-01') end_at from events")(
    lambda t: windows.next_start_as_end(t.events.withColumn("stop", F.lit("2024-02-01 00:00:00").cast("timestamp")), ["user_id"], "ts", "stop").select("event_id", "end_at")
)
query("w6_rolling_min_past", "", "SELECT event_id, min(value) over (partition by user_id order by ts range between interval 7 day preceding and current row) least from events")(
    lambda t: windows.rolling(t.events, ["user_id"], "ts", "value", F.min, back=7 * windows.DAY, name="least").select("event_id", "least")
)
query("w7_rolling_max_24h_filled", "", """a as (select event_id, user_id, ts, max(case when event_id % 7 <> 0 then value end) over (partition by user_id order by ts range between interval 86399999999 microsecond preceding and current row) m from events)
SELECT event_id, last_value(m ignore nulls) over (partition by user_id order by ts rows between 3 preceding and current row) filled from a""")(
    lambda t: windows.fill_forward(windows.rolling(t.events.withColumn("v", F.when(c("event_id") % 7 != 0, c("value"))), ["user_id"], "ts", "v", F.max, back=windows.DAY, open_left=True, name="m"), ["user_id"], ["ts"], "m", 3).select("event_id", "filled")
)
query("w8_fill_both_ways", "", """a as (select event_id, user_id, ts, case when event_id % 4 = 0 then value end v from events)
SELECT event_id, last_value(v ignore nulls) over (partition by user_id order by ts) fwd, first_value(v ignore nulls) over (partition by user_id order by ts rows between current row and unbounded following) bwd from a""")(
    lambda t: windows.fill_backward(windows.fill_forward(t.events.withColumn("v", F.when(c("event_id") % 4 == 0, c("value"))), ["user_id"], ["ts"], "v", name="fwd"), ["user_id"], ["ts"], "v", name="bwd").select("event_id", "fwd", "bwd")
)
query("w9_episode_bounds", "", """d as (select user_id, cast(ts as date) as day, max(case when event_type = 'error' then 1 else 0 end) flag from events group by all),
h as (select *, case when date_diff('day', lag(day) over w, day) <= 2 then 0 else 1 end n from d where flag = 1 window w as (partition by user_id order by day)),
e as (select *, sum(n) over (partition by user_id order by day) episode from h)
SELECT user_id, cast(episode as bigint) episode, min(day) begin_day, max(day) end_day, date_diff('day', min(day), max(day))::int + 1 length from e group by 1, 2""")(
    lambda t: windows.episodes(t.events.groupBy("user_id", F.to_date("ts").alias("day")).agg(F.max((c("event_type") == "error").cast("int")).alias("flag")), ["user_id"], "day", "flag")
)
query("w10_forward_roll", "", "SELECT event_id, avg(value) over (partition by user_id order by ts range between current row and interval 3 day following) ahead from events", "ahead")(
    lambda t: windows.rolling(t.events, ["user_id"], "ts", "value", F.avg, back=0, ahead=3 * windows.DAY, name="ahead").select("event_id", "ahead")
)
query("w11_stay_extremes", "", """SELECT user_id, arg_min(value, ts) first_value, min(ts) first_at, arg_max(value, ts) last_value, max(ts) last_at, min(value) least_value, arg_min(ts, (value, ts)) least_at, max(value) most_value, arg_min(ts, (-value, ts)) most_at from events group by 1""")(
    lambda t: windows.stay_extremes(t.events.withColumnRenamed("ts", "at"), ["user_id"], "at", "value")
)
query("w12_nth_detail_facts", "", """l as (select *, row_number() over (partition by user_id, event_type order by ts) rn from events)
SELECT l.user_id, l.event_id, e.event_id fact_id from l join events e on e.user_id = l.user_id and e.ts between l.ts and l.ts + interval 1 day where rn = 2 and l.event_type = 'purchase'""")(
    lambda t: joins.interval_join(
        t.events.select("user_id", c("event_id").alias("fact_id"), c("ts").alias("fact_at")),
        windows.nth_row(t.events.where("event_type = 'purchase'"), ["user_id"], [c("ts")], 2).select("user_id", "event_id", c("ts").alias("lo"), (c("ts") + F.expr("interval 1 day")).alias("hi")),
        key="user_id", at="fact_at", start="lo", end="hi",
    ).select("user_id", "event_id", "fact_id")
)

# --- joins ----------------------------------------------------------------------------------------------------

query("j1_cohort_index_fact", "visits exposures", "SELECT v.person_id, v.visit_id, e.drug_class, count(*) n from visits v join exposures e using (visit_id) where status = 'F' group by all")(
    lambda t: t.visits.where("status = 'F'").select("person_id", "visit_id").join(t.exposures.select("visit_id", "drug_class"), "visit_id").groupBy("person_id", "visit_id", "drug_class").agg(F.count("*").alias("n"))
)
query("j2_lookup_join", "", "SELECT p_brand variable, count(*) n, sum(l_quantity) quantity from lineitem left join part on p_partkey = l_partkey group by 1", "quantity")(
    lambda t: t.lineitem.join(t.part.select(c("p_partkey").alias("l_partkey"), c("p_brand").alias("variable")), "l_partkey", "left").groupBy("variable").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("quantity"))
)
query("j3_interval_join", "visits measurements", "SELECT visit_id, measurement_id from visits v join measurements m on m.person_id = v.person_id and taken_at between start_at and end_at")(
    lambda t: joins.interval_join(t.measurements, t.visits.select("person_id", "visit_id", "start_at", "end_at"), key="person_id", at="taken_at", start="start_at", end="end_at").select("visit_id", "measurement_id")
)
query("j3_interval_join_binned", "visits measurements", "SELECT visit_id, measurement_id from visits v join measurements m on m.person_id = v.person_id and taken_at between start_at and end_at")(
    lambda t: joins.interval_join(t.measurements, t.visits.select("person_id", "visit_id", "start_at", "end_at"), key="person_id", at="taken_at", start="start_at", end="end_at", bin_seconds=86400).select("visit_id", "measurement_id")
)
query("j4_effective_dated_join", "", """ref as (select brand, make_date(y, 1, 1) lo, case when y < 2000 then make_date(y, 12, 31) end hi, a * (y - 1990) rate from (select p_brand brand, avg(p_retailprice) a from part group by 1), (select unnest(range(1995, 2001)) y)),
f as (select l_orderkey, l_partkey, l_shipdate, p_brand from lineitem join part on p_partkey = l_partkey)
SELECT p_brand brand, count(*) n, count(rate) matched, sum(rate) total from f left join ref on brand = p_brand and l_shipdate >= lo and (hi is null or l_shipdate <= hi) group by 1""", "total")(
    lambda t: joins.effective_dated_join(
        t.lineitem.join(t.part.select(c("p_partkey").alias("l_partkey"), c("p_brand").alias("brand")), "l_partkey"),
        t.part.groupBy(c("p_brand").alias("brand")).agg(F.avg("p_retailprice").alias("a")).withColumn("y", F.explode(F.sequence(F.lit(1995), F.lit(2000)))).select("brand", F.make_date("y", F.lit(1), F.lit(1)).alias("lo"), F.when(c("y") < 2000, F.make_date("y", F.lit(12), F.lit(31))).alias("hi"), (c("a") * (c("y") - 1990)).alias("rate")),
        keys=["brand"], at="l_shipdate", start="lo", end="hi",
    ).groupBy("brand").agg(F.count("*").alias("n"), F.count("rate").alias("matched"), F.sum("rate").alias("total"))
)
query("j5_later_in_same_person", "procedures", """SELECT a.procedure_id, b.procedure_id later_id from procedures a join procedures b on a.person_id = b.person_id and cast(b.proc_start as date) > cast(a.proc_start as date) and b.proc_start <= a.proc_start + interval 90 day""")(
    lambda t: joins.interval_join(
        t.procedures.select("person_id", c("procedure_id").alias("later_id"), c("proc_start").alias("s")),
        t.procedures.select("person_id", "procedure_id", (F.to_date("proc_start") + F.expr("interval 1 day")).cast("timestamp").alias("lo"), (c("proc_start") + F.expr("interval 90 days")).alias("hi")),
        key="person_id", at="s", start="lo", end="hi", bin_seconds=30 * 86400,
    ).select("procedure_id", "later_id")
)
query("j6_followup_within", "visits", """SELECT v.visit_id, max(case when w.visit_id is not null then 1 else 0 end) followed_up from visits v left join visits w on w.person_id = v.person_id and w.visit_id <> v.visit_id and w.start_at between v.end_at and v.end_at + interval 30 day group by 1""")(
    lambda t: joins.followup_flag(t.visits.select("person_id", "visit_id", "start_at", "end_at"), person="person_id", visit="visit_id", start="start_at", end="end_at", days=30).select("visit_id", "followed_up")
)
query("j7_overlap_join", "visits exposures", """SELECT v.visit_id, count(*) n from visits v join exposures e on e.person_id = v.person_id and exp_start <= end_at and exp_end >= start_at group by 1""")(
    lambda t: joins.overlap_join(t.visits.select("person_id", "visit_id", "start_at", "end_at"), t.exposures.select("person_id", "exp_start", "exp_end"), key="person_id", a_start="start_at", a_end="end_at", b_start="exp_start", b_end="exp_end").groupBy("visit_id").agg(F.count("*").alias("n"))
)
query("j7_overlap_join_binned", "visits exposures", """SELECT v.visit_id, count(*) n from visits v join exposures e on e.person_id = v.person_id and exp_start <= end_at and exp_end >= start_at group by 1""")(
    lambda t: joins.overlap_join(t.visits.select("person_id", "visit_id", "start_at", "end_at"), t.exposures.select("person_id", "exp_start", "exp_end"), key="person_id", a_start="start_at", a_end="end_at", b_start="exp_start", b_end="exp_end", bin_seconds=7 * 86400).groupBy("visit_id").agg(F.count("*").alias("n"))
)
query("j8_containment_left_join", "visits exposures", "SELECT e.visit_id, drug_class, exp_start, count(v.visit_id) inside from exposures e left join visits v on v.person_id = e.person_id and exp_start between v.start_at and v.end_at group by all")(
    lambda t: joins.interval_join(t.exposures, t.visits.select("person_id", c("visit_id").alias("v"), "start_at", "end_at"), key="person_id", at="exp_start", start="start_at", end="end_at", how="left").groupBy("visit_id", "drug_class", "exp_start").agg(F.count("v").alias("inside"))
)
for _mode, _strict, _op, _dir in (("backward", False, ">=", "backward"), ("backward_strict", True, ">", "backward"), ("forward", False, "<=", "forward"), ("forward_strict", True, "<", "forward")):
    query(f"j9_asof_{_mode}", "", f"SELECT p.event_id, v.event_id other_id, v.ts matched_at from (select * from events where event_type = 'purchase') p asof left join (select * from events where event_type = 'view') v on p.user_id = v.user_id and p.ts {_op} v.ts")(
        lambda t, d=_dir, s=_strict: joins.asof_join(t.events.where("event_type = 'purchase'").select("event_id", "user_id", "ts"), t.events.where("event_type = 'view'").select("user_id", "ts", c("event_id").alias("other_id")), on="ts", by=["user_id"], values=["other_id"], direction=d, strict=s).select("event_id", "other_id", "matched_at")
    )
query("j9_asof_tolerance", "", "SELECT p.event_id, case when v.ts >= p.ts - interval 6 hour then v.event_id end other_id from (select * from events where event_type = 'purchase') p asof left join (select * from events where event_type = 'view') v on p.user_id = v.user_id and p.ts >= v.ts")(
    lambda t: joins.asof_join(t.events.where("event_type = 'purchase'").select("event_id", "user_id", "ts"), t.events.where("event_type = 'view'").select("user_id", "ts", c("event_id").alias("other_id")), on="ts", by=["user_id"], values=["other_id"], tolerance="6 HOURS").select("event_id", "other_id")
)
query("j10_pair_within", "", "SELECT n.user_id, n.ts num_at, d.ts den_at, n.value / d.value ratio from events n join events d on n.user_id = d.user_id and abs(epoch(n.ts)::bigint - epoch(d.ts)::bigint) <= 86400 and d.value <> 0 where n.event_type = 'purchase' and d.event_type = 'click'", "ratio")(
    lambda t: joins.pair_within(t.events.where("event_type = 'purchase'"), t.events.where("event_type = 'click'"), key="user_id", at="ts", value="value", seconds=86400)
)
query("j11_nearest_neighbour", "", """k as (select s_suppkey k, (s_suppkey * 37 % 180) - 90.0 x, (s_suppkey * 91 % 360) - 180.0 y from supplier), r as (select n_nationkey n, (n_nationkey * 53 % 180) - 90.0 x, (n_nationkey * 29 % 360) - 180.0 y from nation)
SELECT cast(k as bigint) as k, case when k % 11 = 0 then 'missing' else cast(arg_min(n, (sqrt((k.x - r.x) ** 2 + (k.y - r.y) ** 2), n)) as varchar) end nearest, case when k % 11 <> 0 then min(sqrt((k.x - r.x) ** 2 + (k.y - r.y) ** 2)) end distance from k, r group by k""", "distance")(
    lambda t: joins.nearest_neighbour(
        t.supplier.select(c("s_suppkey").alias("k"), F.when(c("s_suppkey") % 11 != 0, (c("s_suppkey") * 37 % 180) - 90.0).alias("x"), ((c("s_suppkey") * 91 % 360) - 180.0).alias("y")),
        t.nation.select(c("n_nationkey").alias("k"), ((c("n_nationkey") * 53 % 180) - 90.0).alias("x"), ((c("n_nationkey") * 29 % 360) - 180.0).alias("y")), key="k", x="x", y="y",
    )
)
query("j12_semi_join", "", "SELECT c_custkey from customer where c_custkey in (select o_custkey from orders where o_orderstatus = 'P')")(lambda t: t.customer.select("c_custkey").join(t.orders.where("o_orderstatus = 'P'").select(c("o_custkey").alias("c_custkey")), "c_custkey", "left_semi"))
query("j13_anti_join", "", "SELECT c_custkey from customer where not exists (select 1 from orders where o_custkey = c_custkey)")(lambda t: t.customer.select("c_custkey").join(t.orders.select(c("o_custkey").alias("c_custkey")), "c_custkey", "left_anti"))
query("j14_outer_merge", "", """a as (select o_custkey k, count(*) n_orders from orders where o_orderstatus = 'P' group by 1), b as (select user_id k, count(*) n_events from events group by 1)
SELECT coalesce(a.k, b.k) k, n_orders, n_events from a full join b on a.k = b.k""")(
    lambda t: joins.outer_merge([t.orders.where("o_orderstatus = 'P'").groupBy(c("o_custkey").alias("k")).agg(F.count("*").alias("n_orders")), t.events.groupBy(c("user_id").alias("k")).agg(F.count("*").alias("n_events"))], ["k"])
)
query("j15_feature_assembly", "", """a as (select o_custkey k, count(*) n_orders from orders group by 1), b as (select user_id k, avg(value) mean_value from events group by 1)
SELECT c_custkey k, n_orders, mean_value from customer left join a on a.k = c_custkey left join b on b.k = c_custkey""", "mean_value")(
    lambda t: joins.assemble_features(t.customer.select(c("c_custkey").alias("k")), [t.orders.groupBy(c("o_custkey").alias("k")).agg(F.count("*").alias("n_orders")), t.events.groupBy(c("user_id").alias("k")).agg(F.avg("value").alias("mean_value"))], "k")
)
query("j16_concept_expansion", "", """closure as (select n_regionkey ancestor_id, c_custkey descendant_id from customer join nation on n_nationkey = c_nationkey union all select 10 + c_nationkey, c_custkey from customer),
rules as (select * from (values ('america', 1, 2), ('nation_three', 13, 1), ('asia', 2, 3)) v(variable, ancestor_id, priority)),
x as (select descendant_id from closure where ancestor_id = 18)
SELECT descendant_id concept_id, arg_min(variable, (priority, variable)) as variable from closure join rules using (ancestor_id) where descendant_id not in (select descendant_id from x) group by 1""")(
    lambda t: joins.expand_concepts(
        t.spark.createDataFrame([("america", 1, 2), ("nation_three", 13, 1), ("asia", 2, 3)], "variable string, ancestor_id int, priority int"),
        t.customer.join(t.nation, c("c_nationkey") == c("n_nationkey")).select(c("n_regionkey").alias("ancestor_id"), c("c_custkey").alias("descendant_id")).union(t.customer.select(c("c_nationkey") + 10, "c_custkey")),
        t.spark.createDataFrame([(18,)], "ancestor_id int"),
    )
)

# --- aggregates -----------------------------------------------------------------------------------------------

query("a1_group_having", "", "SELECT o_custkey, o_orderdate from orders group by 1, 2 having count(*) = 1")(lambda t: t.orders.groupBy("o_custkey", "o_orderdate").count().where("count = 1").drop("count"))
query("a2_conditional_flags", "", "SELECT o_custkey, max(case when o_orderpriority = '1-URGENT' then 1 else 0 end) any_urgent, min(case when o_orderstatus = 'F' then 1 else 0 end) all_finished from orders group by 1")(
    lambda t: t.orders.groupBy("o_custkey").agg(F.max(F.when(c("o_orderpriority") == "1-URGENT", 1).otherwise(0)).alias("any_urgent"), F.min(F.when(c("o_orderstatus") == "F", 1).otherwise(0)).alias("all_finished"))
)
query("a3_windowed_agg", "visits measurements", "SELECT visit_id, variable, unit, avg(value) mean, max(value) most, count(value) n from visits v join measurements m on m.person_id = v.person_id and taken_at between end_at and end_at + interval 4 day group by all", "mean")(
    lambda t: joins.interval_join(t.measurements, t.visits.select("person_id", "visit_id", "end_at", (c("end_at") + F.expr("interval 4 days")).alias("stop")), key="person_id", at="taken_at", start="end_at", end="stop").groupBy("visit_id", "variable", "unit").agg(F.avg("value").alias("mean"), F.max("value").alias("most"), F.count("value").alias("n"))
)
query("a4_weighted_average", "", "SELECT l_returnflag, sum(l_discount * l_quantity) / sum(l_quantity) wavg from lineitem group by 1", "wavg")(lambda t: t.lineitem.groupBy("l_returnflag").agg(aggs.weighted_average(c("l_discount"), c("l_quantity")).alias("wavg")))
query("a5_count_sum_pivot", "", """SELECT user_id, count(*) filter (event_type = 'click') n_click, coalesce(sum(value) filter (event_type = 'click'), 0) sum_click, count(*) filter (event_type = 'purchase') n_purchase, coalesce(sum(value) filter (event_type = 'purchase'), 0) sum_purchase, count(*) n_total, sum(value) sum_total from events group by 1""", "sum_click sum_purchase sum_total")(
    lambda t: aggs.count_sum_pivot(t.events, ["user_id"], "event_type", "value", ["click", "purchase"])
)
query("a6_distinct_per_category", "exposures", "SELECT person_id, count(distinct drug_id) filter (drug_class = 'A') as \"n_A\", count(distinct drug_id) filter (drug_class = 'N') as \"n_N\", count(distinct drug_id) filter (drug_class = 'R') as \"n_R\" from exposures group by 1")(
    lambda t: aggs.distinct_per_category(t.exposures, ["person_id"], "drug_class", "drug_id", ["A", "N", "R"])
)
query("a7_median_by", "", "SELECT event_type, median(value) mid from events group by 1", "mid")(lambda t: stats.quantiles(t.events, ["event_type"], "value", [0.5]).withColumnRenamed("q0", "mid"))
query("a8_first_last", "", "SELECT user_id, arg_min(event_type, ts) first_type, arg_max(event_type, ts) last_type from events group by 1")(lambda t: t.events.groupBy("user_id").agg(F.min_by("event_type", "ts").alias("first_type"), F.max_by("event_type", "ts").alias("last_type")))
query("a9_string_agg_distinct", "", "SELECT user_id, string_agg(distinct trim(event_type), ', ' order by trim(event_type)) types from events group by 1")(lambda t: t.events.groupBy("user_id").agg(aggs.string_agg_distinct(c("event_type")).alias("types")))
query("a10_numeric_bundle", "", "SELECT event_type, sum(value) sum, min(value) min, max(value) max, count(value) count, avg(value) mean, median(value) median, stddev_samp(value) std, mad(value) mad from events group by 1", "sum mean median std mad")(lambda t: aggs.numeric_bundle(t.events, ["event_type"], "value"))
query("a11_simple_aggregators", "", "SELECT c_mktsegment, avg(c_acctbal) mean, sum(c_acctbal) total, max(case when c_acctbal > 0 then 1 else 0 end) any_positive, min(c_acctbal) least, count(*) n from customer group by 1", "mean total")(
    lambda t: t.customer.groupBy("c_mktsegment").agg(F.avg("c_acctbal").alias("mean"), F.sum("c_acctbal").alias("total"), F.max((c("c_acctbal") > 0).cast("int")).alias("any_positive"), F.min("c_acctbal").alias("least"), F.count("*").alias("n"))
)
_WORST = (("error", "worst"), ("purchase|signup", "middle"), (".", "mild"))
query("a12_ordinal_worst", "", "SELECT user_id, case min(case when event_type like '%error%' then 0 when regexp_matches(event_type, 'purchase|signup') then 1 else 2 end) when 0 then 'worst' when 1 then 'middle' else 'mild' end worst from events group by 1")(
    lambda t: t.events.groupBy("user_id").agg(aggs.ordinal_worst(c("event_type"), _WORST).alias("worst"))
)
_PLACES = "case event_id % 7 when 0 then 'ICU 4' when 1 then 'Ward B' when 2 then 'OR' when 3 then 'Floor 4' when 4 then 'At home' when 5 then 'PACU' end"
_DEVICES = "case event_id % 6 when 0 then 'ventilator' when 1 then 'supplemental oxygen' when 2 then 'noninvasive ventilator' when 3 then 'room air' when 4 then 'other' end"
_HELP = "case event_id % 5 when 0 then 'independent' when 1 then 'maximum assist, patient does 25-49%' when 2 then 'assistance by 2-3 caregivers' when 3 then 'ADL assistance by 4 or more caregivers' end"
query("a12_published_orders", "", f"""x as (select user_id, cast(ts as date) as day, {_PLACES} p, {_DEVICES} d, {_HELP} h, case event_id % 11 when 0 then 'Yes' when 1 then 'Unable to assess' when 2 then 'No' end s from events)
SELECT user_id, day, case when bool_or(p ilike '%home%') then 'HOME' when bool_or(p ilike '%or%') then 'OR' when bool_or(p ilike '%icu%') then 'ICU' when count(p) > 0 then 'WARD' end station,
case when bool_or(d = 'ventilator') then 'ventilator' when bool_or(d = 'supplemental oxygen') then 'supplemental oxygen' when bool_or(d = 'noninvasive ventilator') then 'noninvasive ventilator' when bool_or(d = 'room air') then 'room air' end device,
case when bool_or(s = 'Yes') then 'POSITIVE' when bool_or(s = 'Unable to assess') then 'UNABLE_TO_ASSESS' when count(s) > 0 then 'NEGATIVE' end delirium,
case when bool_or(h like 'max%') then 'Maximum' when bool_or(h like 'ADL%') then 'Moderate' when bool_or(h like 'assist%') then 'Minimal' when bool_or(h = 'independent') then 'Independent' end assistance from x group by 1, 2""")(
    lambda t: t.events.groupBy("user_id", F.to_date("ts").alias("day")).agg(
        aggs.ordinal_worst(F.expr(_PLACES), aggs.ORDERS["station"]).alias("station"), aggs.ordinal_worst(F.expr(_DEVICES), aggs.ORDERS["respiratory_device"]).alias("device"),
        aggs.ordinal_worst(F.expr("case event_id % 11 when 0 then 'Yes' when 1 then 'Unable to assess' when 2 then 'No' end"), aggs.ORDERS["delirium"]).alias("delirium"), aggs.ordinal_worst(F.expr(_HELP), aggs.ORDERS["assistance"]).alias("assistance"))
)
query("a13_station_flags", "", f"""x as (select user_id, cast(ts as date) as day, {_PLACES} p from events)
SELECT user_id, day, max(case when p ilike '%icu%' then 1 when p is not null then 0 end) "ICU", max(case when p ilike '%ward%' then 1 when p is not null then 0 end) "WARD", max(case when p = 'OR' then 1 when p is not null then 0 end) "OR", max(case when p = 'PACU' then 1 when p is not null then 0 end) "PACU" from x group by 1, 2""")(
    lambda t: aggs.multi_label(t.events.withColumn("day", F.to_date("ts")).withColumn("p", F.expr(_PLACES)), ["user_id", "day"], "p", aggs.STATIONS).select("user_id", "day", "ICU", "WARD", "OR", "PACU")
)
query("a13_multi_label_indicators", "", """p as (select o_custkey, unnest(string_split(lower(o_orderpriority) || ';' || case when o_orderkey % 2 = 0 then 'even' else 'odd' end, ';')) v from orders)
SELECT o_custkey, max(case when regexp_matches(v, 'even') then 1 else 0 end) even, max(case when regexp_matches(v, 'urgent') then 1 else 0 end) urgent from p group by 1""")(
    lambda t: aggs.multi_label(t.orders.withColumn("v", F.concat_ws(";", F.lower("o_orderpriority"), F.when(c("o_orderkey") % 2 == 0, "even").otherwise("odd"))), ["o_custkey"], "v", {"even": "even", "urgent": "urgent"})
)
query("a14_take_highest_priority", "", "SELECT user_id, arg_min(event_type, (case event_type when 'purchase' then 1 when 'signup' then 2 else 1000000 end, event_type)) best from events group by 1")(
    lambda t: t.events.groupBy("user_id").agg(aggs.highest_priority(c("event_type"), {"purchase": 1, "signup": 2}).alias("best"))
)
query("a15_first_matching", "", "SELECT o_custkey, coalesce(min(case when o_orderstatus = 'P' then 'P' end), min(o_orderstatus)) status from orders group by 1")(
    lambda t: t.orders.groupBy("o_custkey").agg(aggs.highest_priority(c("o_orderstatus"), {"P": 1}).alias("status"))
)
query("a16_pivot_long_to_wide", "", "SELECT user_id, max(value) filter (event_type = 'click') click, max(value) filter (event_type = 'view') as \"view\" from events group by 1")(lambda t: aggs.pivot_wide(t.events, ["user_id"], "event_type", "value", ["click", "view"], F.max))
query("a17_unstack_exploding", "", """e as (select user_id, event_type, value, row_number() over (partition by user_id, event_type order by value) i from events where event_type in ('purchase', 'signup'))
SELECT coalesce(p.user_id, s.user_id) user_id, p.value purchase, s.value signup from (select * from e where event_type = 'purchase') p full join (select * from e where event_type = 'signup') s on p.user_id = s.user_id and p.i = s.i""")(
    lambda t: aggs.unstack_exploding(t.events.where("event_type in ('purchase', 'signup')"), ["user_id"], "event_type", "value", ["purchase", "signup"])
)
query("a18_profile", "", """x as (select 'event_type' as "column", event_type as text, cast(null as double) num from events union all select 'value', cast(value as varchar), value from events),
s as (select "column", count(text) n, count(*) - count(text) missing, count(distinct text) levels, min(coalesce(num, length(text))) min, max(coalesce(num, length(text))) max, avg(coalesce(num, length(text))) mean, median(coalesce(num, length(text))) median, stddev_samp(coalesce(num, length(text))) std from x group by 1)
SELECT "column", n, missing, levels, min, max, mean, median, std from s""", "mean median std")(lambda t: aggs.profile(t.events, ["event_type", "value"]).drop("mode"))
query("a19_profile_by_group", "", """x as (select event_type, 'user_id' as "column", cast(user_id as varchar) as text, cast(user_id as double) num from events),
f as (select event_type, "column", text, count(*) k from x group by all), m as (select event_type, "column", arg_min(text, (-k, text)) as mode from f group by all)
SELECT x.event_type, x."column", count(text) n, count(*) - count(text) missing, count(distinct text) levels, min(num) min, max(num) max, avg(num) mean, median(num) median, stddev_samp(num) std, any_value(mode) as mode from x join m using (event_type, "column") group by all""", "mean median std")(
    lambda t: aggs.profile(t.events, ["user_id"], ["event_type"])
)
query("a20_timestamp_stats", "", "SELECT user_id, make_timestamp(cast(trunc(median(epoch_us(ts))) as bigint)) median_at, min(ts) min_at, max(ts) max_at from events group by 1")(lambda t: aggs.timestamp_stats(t.events, ["user_id"], "ts"))
query("a21_census", "", """x as (select distinct c_custkey id, 'customer' frame from customer union select distinct user_id, 'events' from events union select distinct o_custkey, 'orders' from orders)
SELECT id, string_agg(frame, ',' order by frame) frames, count(*) n_frames from x group by 1""")(lambda t: aggs.census({"customer": t.customer.withColumnRenamed("c_custkey", "id"), "events": t.events.withColumnRenamed("user_id", "id"), "orders": t.orders.withColumnRenamed("o_custkey", "id")}, "id"))
_FOLDER = {"customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment", "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority", "part": "p_partkey p_name p_brand p_type p_size p_retailprice"}
query("a22_directory_summary", "", " union all ".join(f"SELECT '{k}' as \"table\", '{x}' as \"column\", count(*) n_rows, count({x}) n, count(distinct {x}) levels, min(length(cast({x} as varchar))) shortest from {k}" for k, v in _FOLDER.items() for x in v.split() if x not in ("o_totalprice", "o_orderdate", "c_acctbal", "p_retailprice")).replace("union all SELECT", "union all select"))(
    lambda t: aggs.directory_summary(t.spark, {k: f"{t.dir}/{k}.parquet" for k in _FOLDER}).where("`column` not in ('o_totalprice', 'o_orderdate', 'c_acctbal', 'p_retailprice')")
)
query("a23_concept_date_list", "", """f as (select user_id, event_type, min(cast(ts as date)) d from events group by all)
SELECT user_id, string_agg('[' || event_type || ': ' || d || ']', ', ' order by event_type) concepts from f group by 1""")(lambda t: aggs.concept_date_list(t.events, ["user_id"], "event_type", "ts"))

# --- sort, top, sets ------------------------------------------------------------------------------------------

query("t2_top_n_subjects", "", "SELECT o_custkey, count(*) n from orders group by 1 order by n desc, o_custkey limit 20")(lambda t: t.orders.groupBy("o_custkey").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "o_custkey").limit(20))
query("t3_keep_top_n", "", """top as (select p_type from part group by 1 order by count(*) desc, p_type limit 5)
SELECT case when p_type is null then 'UNKNOWN' when p_type in (select p_type from top) then p_type else 'OTHER' end p_type, count(*) n from part group by 1""")(lambda t: windows.keep_top_levels(t.part, "p_type", 5).groupBy("p_type").agg(F.count("*").alias("n")))
query("t4_closest_to_median", "", """m as (select event_type, median(value) m from events group by 1), r as (select event_id, e.event_type, row_number() over (partition by e.event_type order by abs(value - m), ts desc) rn from events e join m using (event_type))
SELECT event_type, event_id from r where rn = 1""")(lambda t: windows.closest_to_median(t.events, ["event_type"], "value", "ts").select("event_type", "event_id"))
query("t5_leaderboard", "", "SELECT p_brand, max(p_retailprice) best, avg(p_retailprice) mean from part group by 1 order by best desc, mean desc, p_brand limit 10", "mean")(
    lambda t: t.part.groupBy("p_brand").agg(F.max("p_retailprice").alias("best"), F.avg("p_retailprice").alias("mean")).orderBy(F.desc("best"), F.desc("mean"), "p_brand").limit(10)
)
query("u1_union_distinct", "", "SELECT c_nationkey k from customer union select s_nationkey from supplier")(lambda t: t.customer.select(c("c_nationkey").alias("k")).union(t.supplier.select("s_nationkey")).distinct())
query("u2_union_all_by_name", "", "SELECT c_custkey id, c_name as name, c_mktsegment segment from customer union all by name select s_suppkey id, s_name as name from supplier")(
    lambda t: t.customer.select(c("c_custkey").alias("id"), c("c_name").alias("name"), c("c_mktsegment").alias("segment")).unionByName(t.supplier.select(c("s_suppkey").alias("id"), c("s_name").alias("name")), allowMissingColumns=True)
)
query("u3_drop_duplicates_keep_last", "", "SELECT user_id, event_type, max(ts) ts from events group by 1, 2")(lambda t: windows.nth_row(t.events, ["user_id", "event_type"], ["ts"], -1).select("user_id", "event_type", "ts"))
query("u4_set_difference_check", "", "SELECT count(*) missing from (select distinct o_custkey from orders) where o_custkey not in (select user_id from events)")(
    lambda t: t.orders.select("o_custkey").distinct().join(t.events.select(c("user_id").alias("o_custkey")), "o_custkey", "left_anti").agg(F.count("*").alias("missing"))
)

# --- intervals ------------------------------------------------------------------------------------------------

query("i1_condense_intervals", "locations", """a as (select *, case when loc_start > max(loc_end + interval 2 hour) over (partition by person_id order by loc_start, loc_end rows between unbounded preceding and 1 preceding) then 1 else 0 end n from locations),
b as (select *, sum(n) over (partition by person_id order by loc_start, loc_end rows unbounded preceding) island from a)
SELECT person_id, min(loc_start) loc_start, max(loc_end) loc_end, count(*) n_merged, min(priority) priority from b group by person_id, island""")(
    lambda t: intervals.condense_intervals(t.locations, by=["person_id"], start="loc_start", end="loc_end", gap="2 HOURS", aggregates={"priority": F.min})
)
_SEG = """edges as (select person_id, loc_start b from locations union select person_id, loc_end from locations),
seg as (select person_id, b s, lead(b) over (partition by person_id order by b) e from edges)"""
query("i2_resolve_overlaps", "locations", _SEG + """, won as (select s.person_id, s, e, arg_min(label, (priority, loc_start, label)) as label from seg s join locations l on l.person_id = s.person_id and loc_start <= s and loc_end >= e where e is not null group by all),
r as (select *, case when label = lag(label) over w and s = lag(e) over w then 0 else 1 end n from won window w as (partition by person_id order by s)),
q as (select *, sum(n) over (partition by person_id order by s) run from r)
SELECT person_id, label, min(s) loc_start, max(e) loc_end from q group by person_id, run, label""")(
    lambda t: intervals.resolve_overlaps(t.locations, by=["person_id"], start="loc_start", end="loc_end", priority="priority", label="label")
)
query("i3_timeline", "locations", _SEG + """ SELECT s.person_id, s seg_start, e seg_end, string_agg(distinct event_id::varchar, ',' order by event_id::varchar) active from seg s join locations l on l.person_id = s.person_id and loc_start <= s and loc_end >= e where e is not null group by all""")(
    lambda t: intervals.timeline(t.locations.withColumn("id", c("event_id").cast("string")), by=["person_id"], start="loc_start", end="loc_end", id_column="id").withColumn("active", F.array_join("active", ","))
)
query("i2_resolve_overlaps_capped", "locations", """short as (select person_id, label, priority, loc_start, least(loc_end, loc_start + interval 5 hour) loc_end from locations), edges as (select person_id, loc_start b from short union select person_id, loc_end from short),
seg as (select person_id, b s, lead(b) over (partition by person_id order by b) e from edges), won as (select s.person_id, s, e, arg_min(label, (priority, loc_start, label)) as label from seg s join short l on l.person_id = s.person_id and loc_start <= s and loc_end >= e where e is not null group by all)
SELECT person_id, label, sum(epoch_us(e) - epoch_us(s)) / 3.6e9 as hours from won group by 1, 2""", "hours")(
    lambda t: intervals.resolve_overlaps(t.locations, by=["person_id"], start="loc_start", end="loc_end", priority="priority", label="label", max_len="5 HOURS").groupBy("person_id", "label").agg((F.sum(F.unix_micros("loc_end") - F.unix_micros("loc_start")) / 3.6e9).alias("hours"))
)
query("i3_components", "locations", """a as (select *, case when loc_start > max(loc_end + interval 1 hour) over (partition by person_id order by loc_start, loc_end rows between unbounded preceding and 1 preceding) then 1 else 0 end n from locations)
SELECT event_id, cast(1 + sum(n) over (partition by person_id order by loc_start, loc_end rows unbounded preceding) as bigint) component from a""")(
    lambda t: intervals.components(t.locations, by=["person_id"], start="loc_start", end="loc_end", gap="1 HOUR").select("event_id", "component")
)
query("i3_intersections", "locations", """SELECT a.person_id, a.event_id earlier, b.event_id later, b.loc_start shared_from, least(a.loc_end, b.loc_end) shared_to from locations a join locations b on a.person_id = b.person_id and a.event_id <> b.event_id and a.loc_end > b.loc_start and (a.loc_start < b.loc_start or (a.loc_start = b.loc_start and a.event_id < b.event_id))""")(
    lambda t: intervals.intersections(t.locations, by=["person_id"], start="loc_start", end="loc_end", id_column="event_id")
)
query("i6_points_and_bounds", "visits measurements", """i as (select visit_id, taken_at as \"at\", value from measurements join visits using (person_id) where taken_at between start_at and end_at), b as (select visit_id, start_at as \"at\" from visits union select visit_id, end_at from visits)
SELECT visit_id, \"at\", value, 1 observed from i union all select visit_id, \"at\", null, 0 from b where (visit_id, \"at\") not in (select visit_id, \"at\" from i)""")(
    lambda t: intervals.with_bounds(t.measurements.select(c("taken_at").alias("at"), "value", "person_id").join(t.visits.select("person_id", "visit_id"), "person_id").drop("person_id"), t.visits, key="visit_id", at="at", low="start_at", high="end_at").select("visit_id", "at", "value", "observed")
)
query("i4_floor_ceil_condense", "locations", """f as (select person_id, date_trunc('day', loc_start) s, case when date_trunc('day', loc_end) < loc_end then date_trunc('day', loc_end) + interval 1 day else date_trunc('day', loc_end) end e from locations),
a as (select *, case when s > max(e) over (partition by person_id order by s, e rows between unbounded preceding and 1 preceding) then 1 else 0 end n from f),
b as (select *, sum(n) over (partition by person_id order by s, e rows unbounded preceding) island from a)
SELECT person_id, cast(min(s) as timestamp) loc_start, cast(max(e) as timestamp) loc_end, count(*) n_merged from b group by person_id, island""")(
    lambda t: intervals.floor_ceil_condense(t.locations.select("person_id", "loc_start", "loc_end"), by=["person_id"], start="loc_start", end="loc_end", unit="day")
)
query("i5_expand_to_grid", "visits", "SELECT visit_id, unnest(generate_series(start_at, end_at, interval 6 hour)) as at from visits")(
    lambda t: intervals.expand_to_grid(t.visits, start="start_at", end="end_at", step="6 HOURS").select("visit_id", "at")
)
query("i5_expand_all_to_grid", "visits", "SELECT visit_id, unnest(generate_series(start_at, end_at, interval 1 day)) as at from visits")(
    lambda t: intervals.expand_to_grid(t.visits, start="start_at", end="end_at", step="1 DAY").select("visit_id", "at")
)
query("i6_trim_to_bounds", "visits exposures", "SELECT e.visit_id, drug_id, greatest(exp_start, start_at) exp_start, least(exp_end, end_at) exp_end from exposures e join visits v using (visit_id) where exp_end >= start_at and exp_start <= end_at")(
    lambda t: intervals.trim_to_bounds(t.exposures.select("visit_id", "drug_id", "exp_start", "exp_end"), t.visits.select("visit_id", "start_at", "end_at"), key="visit_id", start="exp_start", end="exp_end", low="start_at", high="end_at")
)
query("i7_resample", "", """o as (select *, date_trunc('day', min(ts) over (partition by user_id)) origin from events)
SELECT user_id, cast(floor((epoch_us(ts) - epoch_us(origin)) / 43200000000) as bigint) bin, avg(value) mean, max(value) most from o group by all""", "mean")(
    lambda t: timeseries.resample(t.events.join(t.events.groupBy("user_id").agg(F.min("ts").alias("lo")), "user_id"), by=["user_id"], at="ts", value="value", seconds=43200, origin=timeseries.origin_of("start_day", c("lo"), c("lo")), aggregates={"mean": F.avg, "most": F.max})
)
query("i8_interpolate", "", """b as (select user_id, cast(floor(epoch_us(ts) / 86400000000) as bigint) bin, avg(value) mean from events group by all),
g as (select user_id, unnest(range(min(bin), max(bin) + 1)) bin from b group by 1),
f as (select g.user_id, g.bin, mean, last_value(case when mean is not null then {'x': g.bin, 'y': mean} end ignore nulls) over w a, first_value(case when mean is not null then {'x': g.bin, 'y': mean} end ignore nulls) over (partition by g.user_id order by g.bin rows between current row and unbounded following) z from g left join b using (user_id, bin) window w as (partition by g.user_id order by g.bin))
SELECT user_id, bin, case when mean is null then 1 else 0 end missing_ind, case when z.x = a.x then a.y else a.y + (z.y - a.y) * (bin - a.x) / (z.x - a.x) end filled from f""", "filled")(
    lambda t: timeseries.interpolate(timeseries.full_grid(timeseries.resample(t.events, by=["user_id"], at="ts", value="value", seconds=86400, origin=timeseries.origin_of("epoch", c("ts"), c("ts")), aggregates={"mean": F.avg}), by=["user_id"], values=["mean"]), by=["user_id"], order="bin", value="mean").select("user_id", "bin", "missing_ind", "filled")
)
query("i9_exposure_duration", "visits exposures", """d as (select v.visit_id, sum(greatest(0, least(epoch_us(exp_end), epoch_us(start_at + interval 30 day)) - greatest(epoch_us(exp_start), epoch_us(start_at))) / 86400e6) d30, sum(greatest(0, least(epoch_us(exp_end), epoch_us(start_at + interval 365 day)) - greatest(epoch_us(exp_start), epoch_us(start_at))) / 86400e6) d365 from visits v left join exposures e using (visit_id) group by 1)
SELECT visit_id, case when coalesce(d30, 0) < 1e-3 then 0 else d30 end d30, case when coalesce(d365, 0) < 1e-3 then 0 else d365 end d365 from d""", "d30 d365")(
    lambda t: intervals.exposure_duration(t.visits.select("visit_id", "start_at"), t.exposures.select("visit_id", "exp_start", "exp_end"), key="visit_id", anchor="start_at", horizons={"d30": 30, "d365": 365}, start="exp_start", end="exp_end").select("visit_id", "d30", "d365")
)
_DAYS = """x as (select v.visit_id, cast(start_at as date) a, unnest(generate_series(greatest(cast(exp_start as date), cast(start_at as date)), least(cast(exp_end as date), cast(start_at as date) + 29), interval 1 day)) as day from visits v join exposures e using (visit_id) where cast(exp_start as date) <= cast(start_at as date) + 29 and cast(exp_end as date) >= cast(start_at as date)),
n as (select v.visit_id, count(distinct day) exposed_days, cast(min(date_diff('day', a, cast(day as date))) as int) days_to_first from visits v left join x using (visit_id) group by 1)"""
_days = lambda t: intervals.calendar_days(t.visits.select("visit_id", "start_at"), t.exposures.select("visit_id", "exp_start", "exp_end"), key="visit_id", anchor="start_at", days=30, start="exp_start", end="exp_end")
query("i10_calendar_day_exposure", "visits exposures", _DAYS + " SELECT * from n")(lambda t: _days(t).drop("start_at"))
query("i11_event_free_days", "visits exposures", _DAYS + " SELECT visit_id, greatest(0, 30 - exposed_days) free, greatest(0, 30 - exposed_days - case when visit_id % 45 < 30 then 30 - visit_id % 45 else 0 end) alive_free from n")(
    lambda t: _days(t).select("visit_id", *(x.cast("long").alias(n) for x, n in zip(intervals.event_free_days(c("exposed_days"), 30, c("visit_id") % 45), ("free", "alive_free"), strict=True)))
)
query("i12_exposure_over_threshold", "visits exposures", _DAYS + " SELECT visit_id, case when exposed_days > 2 then 1 else 0 end over_two from n")(lambda t: _days(t).select("visit_id", (c("exposed_days") > 2).cast("int").alias("over_two")))
query("i13_rate_normalise_and_grid", "procedures", """m as (select event_id, user_id person_id, ts, ts + to_minutes(5 + event_id % 50) te, value from events), cs as (select user_id person_id, min(ts) cs, min(ts) + interval 3 hour ce from events group by 1),
x as (select person_id, value / greatest(1, (epoch(te)::bigint - epoch(ts)::bigint) / 60.0) / 70 rate, unnest(generate_series(cast(floor((epoch(greatest(ts, cs))::bigint - epoch(cs)::bigint) / 60.0) as bigint), cast(floor((epoch(least(te, ce))::bigint - epoch(cs)::bigint) / 60.0) as bigint))) as minute from m join cs using (person_id) where ts <= ce and te >= cs)
SELECT person_id, minute, sum(rate) rate from x group by 1, 2""", "rate")(
    lambda t: intervals.infusion_rates(
        t.events.select(c("user_id").alias("person_id"), "ts", F.expr("ts + make_dt_interval(0, 0, cast(5 + event_id % 50 as int))").alias("te"), "value", F.lit(None).cast("double").alias("kg")),
        t.events.groupBy(c("user_id").alias("person_id")).agg(F.min("ts").alias("cs")).withColumn("ce", c("cs") + F.expr("interval 3 hours")), key="person_id", start="ts", end="te", amount="value", weight="kg", case_start="cs", case_end="ce",
    )
)
query("i14_densify_calendar", "", """d as (select user_id, cast(ts as date) as day, max(value) most from events group by all), g as (select user_id, cast(unnest(generate_series(min(day), max(day), interval 1 day)) as date) as day from d group by 1)
SELECT g.user_id, g.day, last_value(most ignore nulls) over (partition by g.user_id order by g.day) most, case when most is null then 0 else 1 end observed from g left join d using (user_id, day)""")(
    lambda t: intervals.densify_calendar(t.events.groupBy("user_id", F.to_date("ts").alias("day")).agg(F.max("value").alias("most")), by=["user_id"], day="day", values=["most"])
)
query("i15_recursive_scan", "", """recursive s as (select user_id, min(ts) ts from events group by 1 union all select s.user_id, (select min(e.ts) from events e where e.user_id = s.user_id and e.ts >= s.ts + interval 12 hour) ts from s where s.ts is not null)
SELECT s.user_id, s.ts, e.value from s join events e on e.user_id = s.user_id and e.ts = s.ts""")(lambda t: intervals.accept_apart(t.events, by=["user_id"], at="ts", value="value", seconds=12 * 3600))

# --- typing and scalars ---------------------------------------------------------------------------------------

query("p1_coerce", "", "SELECT event_id, try_cast(json_extract_string(props, '$.page') as int) page, cast(cast(value as varchar) as double) as value from events", "value")(
    lambda t: typing_ops.coerce(t.events.select("event_id", F.get_json_object("props", "$.page").alias("page"), c("value").cast("string").alias("value")), {"page": "int", "value": "double"})
)
query("p2_infer_types", "", "SELECT * from (values ('o_orderstatus', 'cat_one_hot'), ('o_totalprice', 'float'), ('o_orderdate', 'date'), ('o_orderpriority', 'cat_one_hot')) v(\"column\", logical_type)")(
    lambda t: typing_ops.infer_types(t.orders, ["o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"])
)
query("p4_p5_ensure_and_coalesce", "", "SELECT o_orderkey, coalesce(case when o_orderkey % 3 = 0 then o_orderpriority end, o_orderstatus) label, cast(null as double) weight from orders")(
    lambda t: typing_ops.coalesce_fields(typing_ops.ensure_columns(t.orders.select("o_orderkey", F.when(c("o_orderkey") % 3 == 0, c("o_orderpriority")).alias("a"), c("o_orderstatus").alias("b")), {"weight": "double"}), {"label": ["a", "b"]})
)
query("p6_combine_date_time", "", "SELECT o_orderkey, cast(cast(o_orderdate as date) as timestamp) + to_hours(case when o_orderkey % 5 = 0 then 0 else o_orderkey % 24 end) + to_minutes(case when o_orderkey % 5 = 0 then 0 else o_orderkey % 60 end) as at from orders")(
    lambda t: t.orders.select("o_orderkey", typing_ops.combine_date_time(F.to_date("o_orderdate"), F.when(c("o_orderkey") % 5 != 0, (c("o_orderkey") % 24) * 100 + c("o_orderkey") % 60)).alias("at"))
)
query("p7_date_censor", "", "SELECT o_orderkey from orders where o_orderdate between timestamp '1996-01-01' and timestamp '1997-12-31'")(
    lambda t: typing_ops.date_censor(t.orders, ["o_orderdate"], low=F.lit("1996-01-01").cast("timestamp"), high=F.lit("1997-12-31").cast("timestamp")).select("o_orderkey")
)
query("p8_clean_ids", "", "SELECT c_custkey, case when c_custkey % 9 = 0 then null else cast(c_custkey as varchar) end cleaned, split_part(c_name, '#', 2) token from customer")(
    lambda t: t.customer.select("c_custkey", typing_ops.clean_id(F.concat(F.lit("id_"), F.when(c("c_custkey") % 9 == 0, "None").otherwise(c("c_custkey").cast("string")))).alias("cleaned"), typing_ops.id_token(c("c_name"), 2, "#").alias("token"))
)
query("p9_window_filter", "visits exposures", "SELECT v.visit_id, drug_id from exposures e join visits v using (visit_id) where cast(exp_start as date) >= cast(start_at - interval 30 day as date) and cast(exp_start as date) <= cast(end_at + interval 30 day as date)")(
    lambda t: t.exposures.join(t.visits.select("visit_id", "start_at", "end_at"), "visit_id").where(typing_ops.window_filter(c("exp_start"), c("start_at"), c("end_at"), before="30 DAYS", after="30 DAYS", dates=True)).select("visit_id", "drug_id")
)
query("p10_concept_filter", "exposures", "SELECT visit_id, drug_id from exposures join part on p_partkey = drug_id where p_brand in ('Brand#11', 'Brand#12', 'Brand#1')")(
    lambda t: t.exposures.join(t.part.where(c("p_brand").isin("Brand#11", "Brand#12", "Brand#1")).select(c("p_partkey").alias("drug_id")), "drug_id", "left_semi").select("visit_id", "drug_id")
)
query("p12_or_of_branches", "", "SELECT event_id from events where (event_type = 'click' and value > 50) or (event_type = 'error') or (event_type = 'view' and hour(ts) < 6)")(
    lambda t: t.events.where(typing_ops.any_of([(c("event_type") == "click") & (c("value") > 50), c("event_type") == "error", (c("event_type") == "view") & (F.hour("ts") < 6)])).select("event_id")
)
query("p14_period_label", "visits exposures", "SELECT v.visit_id, case when exp_start < start_at then 'preop' when exp_start <= end_at then 'intraop' else 'postop' end period, count(*) n from exposures e join visits v using (visit_id) group by all")(
    lambda t: t.exposures.join(t.visits.select("visit_id", "start_at", "end_at"), "visit_id").groupBy("visit_id", typing_ops.period_label(c("exp_start"), c("start_at"), c("end_at")).alias("period")).agg(F.count("*").alias("n"))
)
query("p15_one_hot_sites", "", "SELECT c_custkey, case when c_nationkey = 1 then 1 else 0 end site_1, case when c_nationkey = 7 then 1 else 0 end site_7 from customer")(lambda t: t.customer.select("c_custkey", *typing_ops.indicators(c("c_nationkey"), [1, 7], "site")))
query("p16_p17_custom_fields", "visits", "SELECT visit_id, charge * 0.36 cost, case when status in ('F', 'P') then 1 end present from visits", "cost")(lambda t: t.visits.select("visit_id", F.expr("charge * 0.36").alias("cost"), F.when(c("status").isin("F", "P"), 1).alias("present")))
query("p18_datediff_boundary", "procedures persons", "SELECT procedure_id, date_diff('hour', proc_start, proc_end) as hours, date_diff('minute', proc_start, proc_end) as minutes, cast(date_diff('year', birth_date, proc_start) as int) as years, cast(date_diff('month', birth_date, proc_start) as int) as months from procedures join persons using (person_id)")(
    lambda t: t.procedures.join(t.persons, "person_id").select("procedure_id", S.datediff_boundary("hour", c("proc_start"), c("proc_end")).alias("hours"), S.datediff_boundary("minute", c("proc_start"), c("proc_end")).alias("minutes"), S.datediff_boundary("year", c("birth_date"), c("proc_start")).alias("years"), S.datediff_boundary("month", c("birth_date"), c("proc_start")).alias("months"))
)
query("p19_map_values", "", "SELECT o_orderkey, case when o_orderkey % 6 = 0 then 'none' else case o_orderstatus when 'F' then 'final' when 'O' then 'open' else 'rest' end end status from orders")(
    lambda t: t.orders.select("o_orderkey", typing_ops.map_values(F.when(c("o_orderkey") % 6 != 0, c("o_orderstatus")), {"F": "final", "O": "open"}, default="none", other="rest").alias("status"))
)
_TEXTS = "case event_id % 14 when 0 then '<' || user_id when 1 then user_id || '-' || (user_id + 4) when 2 then 'NEG ' || user_id when 3 then '2020-01-02' when 4 then '1/2' when 5 then '1,2' || (10 + user_id % 80) when 6 then '1 2 3 4' when 7 then 'trace' when 8 then user_id || '.5 of 20' when 9 then 'B-' || user_id when 10 then 'negative' || user_id when 11 then '-' || user_id || '.25' when 12 then 'Abnormal' else '1-2-3' end"
query("f1_f2_f3_result_text", "", f"""x as (select event_id, user_id, event_id % 14 k, {_TEXTS} t from events)
SELECT event_id, cast(case k when 0 then user_id when 1 then user_id + 2 when 2 then -user_id when 5 then 1200 + 10 + user_id % 80 when 8 then user_id + 0.5 when 9 then user_id when 10 then -user_id when 11 then -user_id - 0.25 end as double) number, case when t like '<%' then '<' end sign, case when k = 7 then 'Small' when k in (2, 10) then 'Negative' end grade from x""")(
    lambda t: t.events.select("event_id", S.extract_number(F.expr(_TEXTS)).alias("number"), S.extract_operator(F.expr(_TEXTS)).alias("sign"), S.grade_text(F.expr(_TEXTS)).alias("grade"))
)
query("f3_numeric_grades", "", """SELECT event_id, case when value <= 499 then 'Small' when value >= 1000 then 'Large' when value >= 500 then 'Moderate' end glucose, case when value < 30 then 'Small' when value >= 300 then 'Large' when value >= 30 then 'Moderate' end protein,
case when value <= 4 then 'Negative' when value <= 30 then 'Small' when value <= 50 then 'Moderate' when value > 50 then 'Large' end cells from (select event_id, case when event_id % 9 <> 0 then value * 10 end as value from events)""")(
    lambda t: t.events.withColumn("v", F.when(c("event_id") % 9 != 0, c("value") * 10)).select("event_id", S.grade_number(c("v"), "glucose_urine").alias("glucose"), S.grade_number(c("v"), "protein_urine").alias("protein"), S.grade_number(c("v"), "red_cells_urine").alias("cells"))
)
query("f4_postal_code", "", "SELECT c_custkey, lpad(cast(c_custkey * 7919 % 100000 as varchar), 5, '0') zip5, case when c_custkey % 2 = 0 then lpad(cast(c_custkey * 7919 % 100000 as varchar), 5, '0') || '1234' end zip9 from customer")(
    lambda t: t.customer.withColumn("z", F.concat(F.lpad((c("c_custkey") * 7919 % 100000).cast("string"), 5, "0"), F.when(c("c_custkey") % 2 == 0, "-1234").otherwise(""))).select("c_custkey", S.postal_code(c("z")).alias("zip5"), S.postal_code(c("z"), 9).alias("zip9"))
)
query("f5_f6_units", "measurements", "SELECT measurement_id, value * case unit when 'mg/dl' then 1.0 when 'g/l' then 100.0 end mg_dl, value * case unit when 'mg/dl' then 10 / 180.16 when 'g/l' then 1000 / 180.16 end mmol_l, value * case unit when 'g/l' then 0.45359237 end kg from measurements", "mg_dl mmol_l kg")(
    lambda t: t.measurements.select("measurement_id", (c("value") * S.unit_ratio(c("unit"), "mg/dl")).alias("mg_dl"), (c("value") * S.unit_ratio(c("unit"), "mmol/l", F.lit(180.16))).alias("mmol_l"), S.convert_unit(c("value"), c("unit"), {"g/l": 0.45359237}).alias("kg"))
)
query("f7_temperatures", "measurements", "SELECT measurement_id, case when unit like '%l' and measurement_id % 3 = 1 then (value - 32) * 5 / 9 else value end celsius from measurements", "celsius")(
    lambda t: t.measurements.select("measurement_id", S.fahrenheit_to_celsius(c("value"), F.when(c("measurement_id") % 3 == 1, "degF").otherwise("C")).alias("celsius"))
)
_UNITS = "case event_id % 4 when 0 then 'mmol/l' when 1 then 'mg/dl' when 2 then 'mg/ml' end"
query("f8_scoring_units", "", f"""x as (select event_id, value, coalesce({_UNITS}, '') u from events)
SELECT event_id, case when u = 'mmol/l' then value / 0.111 else value end lactate, case when u in ('mmol/l', '') then 'mg/dl' else u end lactate_unit, case when u in ('mg/ml', '') then 'mg/dl' else u end creatinine_unit, case when u = '' then 'thousand/ul' else u end platelet_unit from x""", "lactate")(
    lambda t: t.events.withColumn("u", F.expr(_UNITS)).select("event_id", *(x.alias(n) for x, n in zip(S.scoring_lab(c("value"), c("u"), "lactate"), ("lactate", "lactate_unit"), strict=True)), S.scoring_lab(c("value"), c("u"), "creatinine")[1].alias("creatinine_unit"), S.scoring_lab(c("value"), c("u"), "platelets")[1].alias("platelet_unit"))
)
query("f9_red_cell_volume", "", "SELECT event_id, case when event_id % 3 = 0 then value when event_id % 3 = 1 and value > 10 then value else value * 250 end ml from events", "ml")(
    lambda t: t.events.select("event_id", S.red_cell_volume(c("value"), F.expr("case event_id % 3 when 0 then 'mL' when 2 then 'unit' end")).alias("ml"))
)
query("f10_haversine", "", "SELECT s_suppkey, 2 * 6371.009 / 1.609 * asin(least(1, sqrt(pow(sin(radians(10 - s_suppkey % 90) / 2), 2) + cos(radians(s_suppkey % 90)) * cos(radians(10)) * pow(sin(radians(20 - s_suppkey % 170) / 2), 2)))) miles from supplier", "miles")(
    lambda t: t.supplier.select("s_suppkey", S.haversine_miles((c("s_suppkey") % 90).cast("double"), (c("s_suppkey") % 170).cast("double"), F.lit(10.0), F.lit(20.0)).alias("miles"))
)
query("f11_f13_kidney_formulas", "persons", """x as (select person_id, 0.5 + person_id % 40 / 10.0 cr, cast(person_id % 80 as double) age, sex = 'F' f from persons)
SELECT person_id, 142 * pow(least(cr / case when f then 0.7 else 0.9 end, 1), case when f then -0.241 else -0.302 end) * pow(greatest(cr / case when f then 0.7 else 0.9 end, 1), -1.2) * pow(0.9938, age) * case when f then 1.012 else 1 end egfr21,
141 * pow(least(cr / case when f then 0.7 else 0.9 end, 1), case when f then -0.329 else -0.411 end) * pow(greatest(cr / case when f then 0.7 else 0.9 end, 1), -1.209) * pow(0.993, age) * case when f then 1.018 else 1 end egfr09,
case when f then 0.7 else 0.9 end * pow(75 / (142 * pow(0.9938, age) * case when f then 1.012 else 1 end), -1 / 1.2) base,
1.0 * 90 / ((cr + cr + 0.3) / 2) * (1 - 24 * 0.3 / (12 * 1.5)) kinetic, 0.74 - case when f then 0.2 else 0 end + 0.003 * age fallback from x""", "egfr21 egfr09 base kinetic fallback")(
    lambda t: t.persons.select("person_id", (0.5 + c("person_id") % 40 / 10.0).alias("cr"), (c("person_id") % 80).cast("double").alias("age"), (c("sex") == "F").alias("f")).select(
        "person_id", S.egfr_2021(c("cr"), c("age"), c("f")).alias("egfr21"), S.egfr_2009(c("cr"), c("age"), c("f"), F.lit(False)).alias("egfr09"), S.baseline_creatinine(c("age"), c("f")).alias("base"),
        S.kinetic_egfr(F.lit(1.0), F.lit(90.0), c("cr"), c("cr") + 0.3, F.lit(12.0)).alias("kinetic"), S.creatinine_fallback(c("age"), c("f")).alias("fallback"))
)
query("f14_f16_oxygen_and_dose", "", "SELECT event_id, value / (case when event_id % 3 = 0 then 21.0 else 40.0 end / 100) pf, (90 / (case when event_id % 3 = 0 then 21.0 else 40.0 end / 100) - 64) / 0.84 sf, value * 1000 / 70 / greatest(event_id % 5, 1) dose from events", "pf sf dose")(
    lambda t: t.events.select("event_id", S.pf_ratio(c("value"), F.when(c("event_id") % 3 != 0, 40.0)).alias("pf"), S.sf_ratio(F.lit(90.0), F.when(c("event_id") % 3 != 0, 40.0)).alias("sf"), S.dose_per_kg_minute(c("value"), F.lit(70.0), (c("event_id") % 5).cast("double")).alias("dose"))
)
query("f17_f18_dates", "visits persons", "SELECT visit_id, date_diff('day', birth_date, cast(start_at as date)) / 365.2425 age, case when hour(start_at) < 7 or hour(start_at) > 18 then 1 else 0 end night, year(start_at)::int as year, month(start_at)::int as month, date_diff('day', start_at, end_at) los_days from visits join persons using (person_id)", "age")(
    lambda t: t.visits.join(t.persons, "person_id").select("visit_id", S.age_years(c("birth_date"), F.to_date("start_at"), exact=True).alias("age"), S.night(c("start_at")).alias("night"), F.year("start_at").alias("year"), F.month("start_at").alias("month"), S.elapsed("day", c("start_at"), c("end_at")).alias("los_days"))
)
query("f19_f21_ladders_and_places", "", "SELECT p_partkey, case when p_size >= 1 then 1 else 0 end size_1_plus, case when p_size >= 2 then 1 else 0 end size_2_plus, case when p_size >= 3 then 1 else 0 end size_3_plus, case p_size % 4 when 0 then 'home' when 1 then 'facility' when 2 then 'dead' end place from part")(
    lambda t: t.part.select("p_partkey", *S.ladder(c("p_size"), "size", range(1, 4)), S.discharge_place(F.expr("case p_size % 4 when 0 then 'Home or self care' when 1 then 'Skilled nursing' when 2 then 'Expired' end")).alias("place"))
)
