"""A common data model over the given tables: persons, visits, procedures, measurements, exposures, locations.

Each view exists twice: as a DataFrame, and as the SQL of a common table expression for the oracle.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Tables:
    """The tables of a folder, timestamps as instants, and the views built on them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        df = self.spark.read.parquet(f"{self.dir}/{name}.parquet")
        return df.withColumns({c: F.col(c).cast("timestamp") for c, t in df.dtypes if t == "timestamp_ntz"}) if any(t == "timestamp_ntz" for _, t in df.dtypes) else df

    @cached_property
    def persons(self) -> DataFrame:
        return self.customer.select(
            F.col("c_custkey").alias("person_id"), F.expr("make_date(1990 - cast(c_custkey % 80 as int), 6, 15)").alias("birth_date"), F.when(F.col("c_custkey") % 2 == 0, "F").otherwise("M").alias("sex"),
            F.col("c_mktsegment").alias("race"), F.col("c_nationkey").alias("facility_id"), F.col("c_acctbal").alias("balance"),
        )

    @cached_property
    def visits(self) -> DataFrame:
        return self.orders.select(
            F.col("o_orderkey").alias("visit_id"), F.col("o_custkey").alias("person_id"), F.col("o_orderdate").alias("start_at"),
            F.expr("o_orderdate + make_dt_interval(cast(1 + o_orderkey % 10 as int))").alias("end_at"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("charge"),
        )

    @cached_property
    def procedures(self) -> DataFrame:
        return self.orders.select(
            F.col("o_orderkey").alias("procedure_id"), F.col("o_orderkey").alias("visit_id"), F.col("o_custkey").alias("person_id"),
            F.expr("o_orderdate + make_dt_interval(0, cast(o_orderkey % 24 as int))").alias("proc_start"),
            F.expr("o_orderdate + make_dt_interval(0, cast(o_orderkey % 24 as int), cast(15 + o_orderkey % 90 as int))").alias("proc_end"), F.col("o_orderpriority").alias("code"),
        )

    @cached_property
    def measurements(self) -> DataFrame:
        first = self.orders.groupBy(F.col("o_custkey").alias("person_id")).agg(F.min("o_orderdate").alias("first_at"))
        at = F.expr("first_at + (ts - timestamp'2024-01-01 00:00:00') - interval 10 days")
        return self.events.withColumnRenamed("user_id", "person_id").join(first, "person_id").select(
            F.col("event_id").alias("measurement_id"), "person_id", F.col("event_type").alias("variable"), at.alias("taken_at"),
            F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("value"), F.when(F.col("event_id") % 3 == 0, "mg/dl").when(F.col("event_id") % 3 == 1, "g/l").alias("unit"),
        )

    @cached_property
    def exposures(self) -> DataFrame:
        e = self.lineitem.select(F.col("l_orderkey").alias("visit_id"), F.col("l_shipdate").alias("exp_start"), F.expr("l_shipdate + make_dt_interval(cast(l_quantity % 7 as int))").alias("exp_end"), F.col("l_returnflag").alias("drug_class"), F.col("l_partkey").alias("drug_id"), F.col("l_quantity").alias("quantity"))
        return e.join(self.visits.select("visit_id", "person_id"), "visit_id")

    @cached_property
    def locations(self) -> DataFrame:
        return self.events.select("event_id", F.col("user_id").alias("person_id"), F.col("ts").alias("loc_start"), F.expr("ts + make_dt_interval(0, cast(1 + event_id % 48 as int))").alias("loc_end"), F.col("event_type").alias("label"), F.expr("case event_type when 'error' then 1 when 'purchase' then 2 when 'signup' then 3 when 'click' then 4 else 5 end").alias("priority"))

    @cached_property
    def stays(self) -> DataFrame:
        """Visits with the times of their procedure: the index of extracts."""
        return self.visits.select("visit_id", "person_id", "start_at", "end_at").join(self.procedures.select("visit_id", "proc_start", "proc_end"), "visit_id")

    @cached_property
    def observations(self) -> DataFrame:
        return self.measurements.select(F.col("measurement_id").alias("observation_id"), "person_id", "variable", F.col("taken_at").alias("seen_at"), (F.col("measurement_id") % 4).alias("concept"), "value")

    @cached_property
    def conditions(self) -> DataFrame:
        return self.lineitem.join(self.visits.select(F.col("visit_id").alias("l_orderkey"), "person_id"), "l_orderkey").select(
            "person_id", F.concat("l_returnflag", "l_linestatus").alias("variable"), F.col("l_shipdate").alias("found_at"), (F.col("l_linenumber") % 2).alias("poa"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("condition_id")
        )

    @cached_property
    def devices(self) -> DataFrame:
        return self.lineitem.join(self.visits.select(F.col("visit_id").alias("l_orderkey"), "person_id"), "l_orderkey").select(
            "person_id", F.when(F.col("l_suppkey") % 3 == 0, "dialysis").when(F.col("l_suppkey") % 3 == 1, "ventilator").otherwise("red cells").alias("variable"), F.col("l_shipdate").alias("used_at"), F.col("l_quantity").alias("quantity"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("device_id")
        )

    @cached_property
    def acts(self) -> DataFrame:
        """Procedures as facts of a person."""
        return self.procedures.select("person_id", F.col("code").alias("variable"), F.col("proc_start").alias("done_at"), F.col("procedure_id").alias("act_id"), (F.col("procedure_id") % 13).alias("work"))

    @cached_property
    def stations(self) -> DataFrame:
        return self.measurements.select(
            F.col("measurement_id").alias("station_id"), "person_id", F.col("variable").alias("label"), F.col("taken_at").alias("loc_start"), F.expr("taken_at + make_dt_interval(0, cast(1 + measurement_id % 48 as int))").alias("loc_end")
        )

    @cached_property
    def deaths(self) -> DataFrame:
        last = self.visits.where("person_id % 4 = 0").groupBy("person_id").agg(F.max("start_at").alias("m"))
        return last.select("person_id", F.expr("m + make_dt_interval(cast(person_id % 15 as int))").alias("death_at"))


CTE: dict[str, str] = {
    "persons": "persons as (select c_custkey person_id, make_date(1990 - cast(c_custkey % 80 as int), 6, 15) birth_date, case when c_custkey % 2 = 0 then 'F' else 'M' end sex, c_mktsegment race, c_nationkey facility_id, c_acctbal balance from customer)",
    "visits": "visits as (select o_orderkey visit_id, o_custkey person_id, o_orderdate start_at, o_orderdate + to_days(cast(1 + o_orderkey % 10 as int)) end_at, o_orderstatus status, o_totalprice charge from orders)",
    "procedures": "procedures as (select o_orderkey procedure_id, o_orderkey visit_id, o_custkey person_id, o_orderdate + to_hours(o_orderkey % 24) proc_start, o_orderdate + to_hours(o_orderkey % 24) + to_minutes(15 + o_orderkey % 90) proc_end, o_orderpriority code from orders)",
    "measurements": "measurements as (select event_id measurement_id, user_id person_id, event_type variable, first_at + (ts - timestamp '2024-01-01') - interval 10 day taken_at, case when event_id % 7 <> 0 then value end as value, case event_id % 3 when 0 then 'mg/dl' when 1 then 'g/l' end unit from events join (select o_custkey, min(o_orderdate) first_at from orders group by 1) on o_custkey = user_id)",
    "exposures": "exposures as (select l_orderkey visit_id, o_custkey person_id, l_shipdate exp_start, l_shipdate + to_days(cast(l_quantity % 7 as int)) exp_end, l_returnflag drug_class, l_partkey drug_id, l_quantity quantity from lineitem join orders on o_orderkey = l_orderkey)",
    "stays": "stays as (select v.visit_id, v.person_id, start_at, end_at, proc_start, proc_end from visits v join procedures p using (visit_id))",
    "observations": "observations as (select measurement_id observation_id, person_id, variable, taken_at seen_at, measurement_id % 4 concept, value from measurements)",
    "conditions": "conditions as (select o_custkey person_id, l_returnflag || l_linestatus variable, l_shipdate found_at, l_linenumber % 2 poa, l_orderkey * 8 + l_linenumber condition_id from lineitem join orders on o_orderkey = l_orderkey)",
    "devices": "devices as (select o_custkey person_id, case l_suppkey % 3 when 0 then 'dialysis' when 1 then 'ventilator' else 'red cells' end variable, l_shipdate used_at, l_quantity quantity, l_orderkey * 8 + l_linenumber device_id from lineitem join orders on o_orderkey = l_orderkey)",
    "acts": "acts as (select person_id, code variable, proc_start done_at, procedure_id act_id, procedure_id % 13 work from procedures)",
    "stations": "stations as (select measurement_id station_id, person_id, variable as label, taken_at loc_start, taken_at + to_hours(1 + measurement_id % 48) loc_end from measurements)",
    "deaths": "deaths as (select person_id, max(start_at) + to_days(cast(person_id % 15 as int)) death_at from visits where person_id % 4 = 0 group by 1)",
    "locations": "locations as (select event_id, user_id person_id, ts loc_start, ts + to_hours(1 + event_id % 48) loc_end, event_type as label, case event_type when 'error' then 1 when 'purchase' then 2 when 'signup' then 3 when 'click' then 4 else 5 end priority from events)",
}


def sql_with(views: str, body: str) -> str:
    """SQL over some of the views; ``body`` may start with further expressions and 'select'."""
    ctes = [CTE[v] for v in views.split()]
    head, _, tail = body.partition("SELECT ")
    return ("with " if ctes or head.strip() else "") + ", ".join([*ctes, *([head.strip().rstrip(",")] if head.strip() else [])]) + " select " + tail
