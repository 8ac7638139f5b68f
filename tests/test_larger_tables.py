"""Faults that showed on larger tables only, each on a few rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.test_queries import DATA
from wardline.operators import intervals, joins
from wardline.plans import registry

at = lambda second, micros=0: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=second, microseconds=micros)


def test_infusion_minutes_count_rounded_seconds(spark):
    """A start of 0.6 s is second 1, so 60.4 s lies in minute 0 and 120.6 s in minute 2; half a second goes to the even one."""
    cases = spark.createDataFrame([(1, at(0, 600_000), at(9000)), (2, at(0, 500_000), at(9000))], "k int, cs timestamp, ce timestamp")
    meds = spark.createDataFrame([(1, at(60, 400_000), at(60, 400_000), 7.0), (1, at(120, 600_000), at(120, 600_000), 14.0), (2, at(59, 500_000), at(59, 500_000), 70.0)], "k int, s timestamp, e timestamp, v double").withColumn("kg", F.lit(None).cast("double"))
    got = intervals.infusion_rates(meds, cases, key="k", start="s", end="e", amount="v", weight="kg", case_start="cs", case_end="ce")
    assert sorted(map(tuple, got.collect())) == [(1, 0, 0.1), (1, 2, 0.2), (2, 1, 1.0)]


def test_pairs_by_rounded_seconds(spark):
    """0.6 s and 10.4 s are 9 seconds apart, 0.5 s and 10.5 s 10, 0.4 s and 10.6 s 11; each pair meets once, whatever its bins."""
    num = spark.createDataFrame([(1, at(10, 400_000), 6.0), (2, at(10, 500_000), 6.0), (3, at(10, 600_000), 6.0), (4, at(19, 500_000), 6.0)], "k int, s timestamp, v double")
    den = spark.createDataFrame([(1, at(0, 600_000), 2.0), (2, at(0, 500_000), 2.0), (3, at(0, 400_000), 2.0), (4, at(9, 600_000), 2.0)], "k int, s timestamp, v double")
    found = lambda n: sorted(r[0] for r in joins.pair_within(num, den, key="k", at="s", value="v", seconds=n).select("k").collect())
    assert found(9) == [1] and found(10) == [1, 2, 4] and found(11) == [1, 2, 3, 4]


def test_custom_rules_over_batches_of_groups(spark):
    """Groups cut by batches of seven rows, null keys, keys that floats cannot hold, null times; in far fewer calls to Spark's own workers than groups."""
    from wardline.functions import hooks

    big = 2**60 + 1
    rows = [(k if k else None, i % 2, at(3600 * ((7 * i + k) % 40)), at(3600 * ((7 * i + k) % 40 + i % 3))) for k in (0, big, big + 1, 5) for i in range(11)] + [(9, 1, None, at(5)), (9, 1, at(1), None), (big + 2, 0, at(0), at(1))]
    df = spark.createDataFrame(rows, "k long, h int, s timestamp, e timestamp")

    def rule(g):
        assert g[["k", "h"]].drop_duplicates().shape[0] == 1
        return ((g["s"] - g["e"].cummax().shift()).dt.total_seconds() > 7200).cumsum()

    want = []
    for key in {r[:2] for r in rows}:
        latest, own = None, sorted((r[2:] for r in rows if r[:2] == key), key=lambda r: (r[0] is None, r[0] or at(0), r[1] is None, r[1] or at(0)))
        for s, e in own:
            if not want or want[-1][:2] != list(key) or (s and latest and s - latest > dt.timedelta(hours=2)):
                want.append([*key, s, e, 1])
            else:
                want[-1][3:] = [max(filter(None, (want[-1][3], e)), default=None), want[-1][4] + 1]
            latest = max(filter(None, (latest, e)), default=None)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        out = hooks.condense_custom(df, by=["k", "h"], start="s", end="e", islands=rule)
        assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, map(tuple, want)))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert "MapInPandas" in out._jdf.queryExecution().executedPlan().toString()


def test_hours_are_made_by_sorting(spark):
    """Worst points a visit and hour, of known visits only; no hash table and no join under the sort."""
    from wardline.operators import clinical

    doses = spark.createDataFrame([(1, at(0), 2), (1, at(3599), 4), (1, at(3600), None), (2, at(0), 3), (None, at(0), 1), (3, at(0), None), (3, at(1), 0)], "v int, t timestamp, p int")
    visits = spark.createDataFrame([(1,), (1,), (3,), (None,)], "v int")
    got = clinical.hourly_points(doses, visits, key="v", at="t", points="p")
    assert sorted(map(tuple, got.collect())) == [(1, at(0), 4), (1, at(3600), None), (3, at(0), 0)]
    plan = registry.queries()["c30_pressor_score"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" not in plan and "LeftSemi" in plan


def test_distinct_items_without_copies_of_rows(spark):
    from wardline.operators import aggs

    df = spark.createDataFrame([(1, "a", 5), (1, "a", 5), (1, "a", 6), (1, "b", 5), (1, "z", 9), (2, "z", 1), (3, None, 1), (4, "b", None), (None, "a", 1)], "k int, c string, i int")
    out = aggs.distinct_per_category(df, ["k"], "c", "i", ["a", "b"])
    assert sorted(map(tuple, out.collect()), key=str) == [(1, 2, 1), (2, 0, 0), (3, 0, 0), (4, 0, 0), (None, 1, 0)]
    assert "Expand" not in out._jdf.queryExecution().executedPlan().toString()


def test_forest_reads_written_rows(spark):
    files = registry.queries()["k10_random_forest"](spark, DATA).inputFiles()
    assert files and all("/wardline-" in f for f in files)


def test_nearest_places_are_sought_once_a_position(spark):
    """2,000 keys at two positions: the cells of each level meet two rows; keys at several positions or none have one row."""
    places = spark.createDataFrame([(i, float(i % 40), float(i // 40)) for i in range(400)], "k int, x double, y double")
    keys = spark.createDataFrame([(i, 3.2 + 30 * (i % 2), 5.1) for i in range(2000)] + [(0, 39.0, 9.0), (2000, None, 1.0), (2001, None, None), (2001, 0.0, 0.0)], "k int, x double, y double")
    out = joins.nearest_neighbour(keys, places, key="k", x="x", y="y")
    got = {r.k: (r.nearest, r.distance and round(r.distance, 6)) for r in out.collect()}
    assert len(got) == 2002 == out.count() and got[2000] == ("missing", None) and got[2001] == ("0", 0.0) and got[0] == ("399", 0.0)
    assert got[2] == ("203", 0.223607) and got[1] == ("233", 0.223607)
    by_position = [line for line in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Window [min(_hi" in line]
    assert by_position and all("k#" not in line for line in by_position)


def test_kidney_inputs_are_distinct_before_they_multiply(spark, tmp_path):
    """No aggregate over the joined rows; where visits stand for several persons or are repeated, the rows still are those of the SQL."""
    duckdb = pytest.importorskip("duckdb")
    name, con = "x53_kidney_inputs", duckdb.connect()
    run = registry.queries()[name]
    assert not run(spark, DATA)._jdf.queryExecution().optimizedPlan().toString().startswith("Aggregate")
    for table in ("lineitem", "events"):
        (tmp_path / f"{table}.parquet").symlink_to(f"{DATA}/{table}.parquet")
    con.sql(f"copy (select * from '{DATA}/orders.parquet' union all select * from '{DATA}/orders.parquet' where o_orderkey < 20 union all select * replace (o_custkey + 1 as o_custkey) from '{DATA}/orders.parquet' where o_orderkey between 10 and 40) to '{tmp_path}/orders.parquet'")
    for table in ("lineitem", "events", "orders"):
        con.sql(f"create view {table} as select * from '{tmp_path}/{table}.parquet'")
    want = con.sql(registry.oracle_sql()[name]).fetchall()
    got = run(spark, str(tmp_path)).select("visit_id", "kind", "code", "at").collect()
    assert len(got) == len(want) and set(map(tuple, got)) == set(want)
