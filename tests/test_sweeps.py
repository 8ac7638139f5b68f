"""Interval sweeps and the nearest-place search against plain versions."""

import datetime
import math
import random

import pytest
from pyspark.sql import functions as F

from wardline.operators import intervals, joins, windows

T0 = datetime.datetime(2024, 1, 1)
at = lambda h: None if h is None else T0 + datetime.timedelta(hours=h)


def plain_winners(rows):
    """Label of each hour of each group, by trying all intervals."""
    out = {}
    for g in {r[0] for r in rows}:
        for h in range(60):
            over = [(p is not None, p or 0, s, label) for k, s, e, p, label in rows if k == g and s is not None and e is not None and s <= h < e]
            if over:
                out[g, h] = min(over)[3]
    return out


@pytest.mark.parametrize("levels", [16, 300])
def test_overlaps_are_resolved_like_hour_by_hour(spark, levels):
    draw, rows = random.Random(levels), []
    for g in range(12):
        for _ in range(draw.randrange(1, 25)):
            s = draw.randrange(40)
            rows.append((g, s, s + draw.choice([0, 1, 3, 8, 19]), draw.choice([None, *range(6)]) if levels == 16 else draw.randrange(200), draw.choice("abc")))
    rows += [(3, None, 5, 0, "z"), (3, 5, None, 0, "z"), rows[0]]
    df = spark.createDataFrame([(g, at(s), at(e), p, x) for g, s, e, p, x in rows], "g int, s timestamp, e timestamp, p int, label string").withColumn("t", F.lit(1))
    got = intervals.resolve_overlaps(df, by=["g"], start="s", end="e", priority="p", label="label", levels=levels).collect()
    hours, spans = {}, {}
    for r in got:
        lo, hi = (int((r[c] - T0).total_seconds() // 3600) for c in ("s", "e"))
        spans.setdefault((r.g, r.label), []).append((lo, hi))
        for h in range(lo, hi):
            assert (r.g, h) not in hours
            hours[r.g, h] = r.label
    assert hours == plain_winners(rows)
    assert all(a[1] < b[0] for x in spans.values() for a, b in zip(sorted(x), sorted(x)[1:]))  # equal neighbours are one


def test_too_many_priorities_are_an_error(spark):
    df = spark.range(20).select(F.lit(1).alias("g"), F.lit(T0).alias("s"), F.lit(at(5)).alias("e"), F.col("id").alias("p"), F.lit("a").alias("label"))
    with pytest.raises(Exception, match="more than 16 priorities"):
        intervals.resolve_overlaps(df, by=["g"], start="s", end="e", priority="p", label="label").collect()


def test_nested_intervals_make_no_pairs(spark):
    """3000 nested intervals of one key: 9 million pairs; no operator of the plan makes more than a few rows an interval."""
    n = 3000
    df = spark.range(n).select(F.lit(1).alias("g"), F.timestamp_seconds(F.col("id")).alias("s"), F.timestamp_seconds(2 * n - F.col("id")).alias("e"), (15 - F.col("id") % 16).alias("p"), F.col("id").cast("string").alias("label"))
    out = intervals.resolve_overlaps(df, by=["g"], start="s", end="e", priority="p", label="label")
    assert out.count() > 1
    out.collect()
    plans, most = [out._jdf.queryExecution().executedPlan()], 0
    while plans:
        p = plans.pop()
        if "AdaptiveSparkPlan" in p.nodeName():
            p = p.executedPlan()
        rows = p.metrics().get("numOutputRows")
        most = max(most, rows.get().value() if rows.isDefined() else 0)
        plans += [p.children().apply(i) for i in range(p.children().size())]
        if "QueryStage" in p.nodeName():
            plans.append(p.plan())
    assert 0 < most <= 4 * n


def test_counts_and_steps(spark):
    rows = [(1, 0, 4), (1, 2, 6), (1, 6, 8), (1, 9, 9), (2, 1, 2), (2, None, 3)]
    df = spark.createDataFrame([(g, at(s), at(e)) for g, s, e in rows], "g int, s timestamp, e timestamp").withColumn("id", F.monotonically_increasing_id())
    got = sorted((r.g, r.seg_start, r.seg_end, r.n_active) for r in intervals.active_counts(df, by=["g"], start="s", end="e").collect())
    assert got == [(1, at(0), at(2), 1), (1, at(2), at(4), 2), (1, at(4), at(6), 1), (1, at(6), at(8), 1), (2, at(1), at(2), 1)]
    steps = intervals.timeline(df.where("g = 2"), by=["g"], start="s", end="e", id_column="id", seconds=3 * 3600).collect()
    assert [(r.seg_start, r.seg_end, len(r.active)) for r in steps] == [(at(0), at(3), 1)]


@pytest.mark.parametrize("n", [0, 1, 40, 3000])
def test_nearest_place_is_exact(spark, n):
    draw = random.Random(n)
    # most places in one town, some far away, some on a lattice with ties
    places = [(i, draw.gauss(5, 0.01) if i % 3 else draw.uniform(-90, 90), draw.gauss(5, 0.01) if i % 3 else draw.uniform(-180, 180)) for i in range(n)]
    places += [(n + i, float(i % 4), float(i // 4)) for i in range(12 if n else 0)]
    keys = [(i, draw.uniform(-100, 100), draw.uniform(-200, 200)) for i in range(60)] + [(100 + i, draw.gauss(5, 0.02), draw.gauss(5, 0.02)) for i in range(60)]
    keys += [(200 + i, i % 4 + 0.5, i // 4 + 0.5) for i in range(12)] + [(300, None, 1.0), (301, 1.0, None), keys[0]]
    ref = spark.createDataFrame([*places, (-1, None, 2.0)], "k long, x double, y double")
    got = {r.k: (r.nearest, r.distance) for r in joins.nearest_neighbour(spark.createDataFrame(keys, "k long, x double, y double"), ref, key="k", x="x", y="y").collect()}
    assert len(got) == len({k for k, _, _ in keys})
    for k, x, y in keys:
        if x is None or y is None or not places:
            assert got[k] == ("missing", None)
        else:
            d, best = min((math.sqrt((x - px) ** 2 + (y - py) ** 2), p) for p, px, py in places)
            assert got[k][0] == str(best) and math.isclose(got[k][1], d, rel_tol=1e-12)


def test_hops_end_in_cycles_and_go_deep(spark):
    """A chain of 12 with a way back and a side way: all are found, by the least number of hops."""
    edges = [(i, i + 1, "a") for i in range(12)] + [(12, 0, "a"), (3, 12, "b"), (5, None, "a"), (0, 0, "a"), (2, 2, "a")]
    e = spark.createDataFrame(edges, "from_id int, to_id int, kind string").withColumn("hops", F.lit("x"))
    seeds = spark.createDataFrame([("v", 0), ("w", 11), ("w", None), ("w", 11)], "variable string, concept_id int")
    names = spark.createDataFrame([(i, "even" if i % 2 == 0 else "odd_x") for i in range(13)] + [(4, "even")], "concept_id int, name string")
    run = lambda **k: sorted(map(tuple, joins.concept_hops(seeds, e, names, **k).collect()))
    assert [r for r in run() if r[0] == "v"] == [("v", i, min(i, 4 if i == 12 else 99)) for i in range(13)] and len([r for r in run() if r[0] == "w"]) == 13
    assert [r for r in run(kinds=["a"]) if r[0] == "v"] == [("v", i, i) for i in range(13)]
    assert run(most_hops=0) == [("v", 0, 0), ("w", 11, 0)]
    assert {r[1] for r in run(most_hops=4, like=["ev%"]) if r[0] == "v"} == {0, 2, 4, 12} and {r[1] for r in run(most_hops=4, not_like=["ev%"]) if r[0] == "v"} == {1, 3}
    gone = spark.createDataFrame([("v", 2), ("w", 0)], "variable string, concept_id int")
    assert run(excluded=gone) == [("v", 0, 0), ("v", 1, 1), ("w", 11, 0), ("w", 12, 1)]
    assert joins.concept_hops(seeds.where("false"), e, names).collect() == []


def test_global_order_over_partitions(spark):
    draw = random.Random(3)
    rows = [(draw.choice([None, 1, 1, 1, 5]), i) for i in range(500)]
    df = spark.createDataFrame(rows, "x int, id int").repartition(7)
    got = windows.sort_globally(df, [F.col("x"), F.col("id")]).collect()
    assert [(r.x, r.id) for r in sorted(got, key=lambda r: r.position)] == sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1])) and sorted(r.position for r in got) == list(range(500))
    assert windows.sort_globally(df.where("false"), [F.col("x")]).collect() == []


def test_rows_counted_from_the_end(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (1, 2, "c"), (2, None, "d")], "g int, x int, id string")
    pick = lambda n, *o: {r.g: r.id for r in windows.nth_row(df, ["g"], o, n).collect()}
    assert pick(1, "x", "id") == {1: "a", 2: "d"} and pick(-1, "x", "id") == {1: "c", 2: "d"} and pick(-1, ("x", True), "id") == {1: "a", 2: "d"}
    assert pick(2, ("x", True), F.col("id")) == {1: "c"}
    with pytest.raises(ValueError, match="names only"):
        pick(-1, F.expr("x").desc(), "id")
