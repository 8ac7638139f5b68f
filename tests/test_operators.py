"""Operators on hand-made frames: ties, nulls, touching intervals, empty groups, and naive versions."""

import datetime as dt
import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from wardline.functions import scalars as S
from wardline.operators import aggs, intervals, joins, prep, stats, timeseries, typing_ops, windows
from wardline.sources import io

DAY0 = dt.datetime(2024, 1, 1)
at = lambda h: DAY0 + dt.timedelta(hours=h)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def random_intervals(seed, n=40, groups=3):
    r = random.Random(seed)
    out = []
    for i in range(n):
        s = r.randrange(60)
        out.append((r.randrange(groups), at(s), at(s + r.randrange(8)), i, r.randrange(3)))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_condense_is_a_sequential_merge(spark, seed):
    data = random_intervals(seed)
    df = spark.createDataFrame(data, "g int, s timestamp, e timestamp, id int, p int")
    got = rows(intervals.condense_intervals(df, by=["g"], start="s", end="e", gap="1 HOURS"))
    want = []
    for g in {d[0] for d in data}:
        now = None
        for _, s, e, *_ in sorted(d for d in data if d[0] == g):
            if now and s <= now[2] + dt.timedelta(hours=1):
                now = [g, now[1], max(now[2], e), now[3] + 1]
            else:
                want += [tuple(now)] if now else []
                now = [g, s, e, 1]
        want.append(tuple(now))
    assert got == sorted(want, key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_resolve_overlaps_by_the_hour(spark, seed):
    data = [d for d in random_intervals(seed) if d[1] < d[2]]
    df = spark.createDataFrame([(g, s, e, p, f"l{p}") for g, s, e, i, p in data], "g int, s timestamp, e timestamp, p int, label string")
    got = rows(intervals.resolve_overlaps(df, by=["g"], start="s", end="e", priority="p", label="label"))
    hours = {}
    for g, s, e, _, p in data:
        h = s
        while h < e:
            hours[g, h] = min(hours.get((g, h), 9), p)
            h += dt.timedelta(hours=1)
    for g, label, s, e in got:
        h = s
        while h < e:
            assert hours.pop((g, h)) == int(label[1:])
            h += dt.timedelta(hours=1)
    assert not hours


@pytest.mark.parametrize("direction,strict", list(itertools.product(("backward", "forward"), (False, True))))
def test_asof_ties_and_nulls(spark, direction, strict):
    left = [(1, at(5), "a"), (1, at(7), "b"), (2, at(1), "c"), (None, at(5), "d"), (1, None, "e")]
    right = [(1, at(5), 10), (1, at(5), 11), (1, at(9), 12), (None, at(1), 13), (3, at(1), 14)]
    l, r = spark.createDataFrame(left, "k int, t timestamp, id string"), spark.createDataFrame(right, "k int, t timestamp, v int")
    got = {x["id"]: x["v"] for x in joins.asof_join(l, r, on="t", by=["k"], values=["v"], direction=direction, strict=strict, tie=["v"]).collect()}
    for k, t, name in left:
        fit = [(u, v) for key, u, v in right if k is not None and t is not None and key == k and ((u < t or (u == t and not strict)) if direction == "backward" else (u > t or (u == t and not strict)))]
        best = (max(fit) if direction == "backward" else min(fit))[1] if fit else None
        assert got[name] == best, name
    assert len(got) == 5


def test_datediff_counts_boundaries(spark):
    df = spark.createDataFrame([(dt.datetime(2023, 12, 31, 23, 59), dt.datetime(2024, 1, 1, 0, 1))], "a timestamp, b timestamp")
    assert tuple(df.select(*(S.datediff_boundary(u, F.col("a"), F.col("b")) for u in ("year", "month", "day", "hour", "minute"))).first()) == (1, 1, 1, 1, 2)


def test_number_texts(spark):
    texts = {"<0.5": 0.5, "1-3": 2.0, "NEG 2": -2.0, "1.5 of 20": 1.5, "B-12": 12.0, "1-2-3": None, "2020-01-02": None, "1/2": None, "1,200": 1200.0, "1 2 3 4": None, "": None, "-7": -7.0, None: None}
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert {r[0]: r[1] for r in df.select("t", S.extract_number(F.col("t"))).collect()} == texts


def test_units(spark):
    df = spark.createDataFrame([("mg/dL",), ("mmol/L",), ("g/L",), ("furlong",), (None,)], "u string")
    got = {r[0]: r[1] for r in df.select("u", S.unit_ratio(F.col("u"), "mg/dl", F.lit(180.16))).collect()}
    assert got["mg/dL"] == pytest.approx(1) and got["mmol/L"] == pytest.approx(18.016) and got["g/L"] == pytest.approx(100) and got["furlong"] is None and got[None] is None


def test_rolling_left_edge_is_open(spark):
    df = spark.createDataFrame([(1, at(0), 9.0), (1, at(24), 1.0)], "k int, t timestamp, v double")
    shut = windows.rolling(df, ["k"], "t", "v", F.max, back=windows.DAY).orderBy("t").collect()
    wide = windows.rolling(df, ["k"], "t", "v", F.max, back=windows.DAY, open_left=True).orderBy("t").collect()
    assert [r["rolled"] for r in shut] == [9.0, 9.0] and [r["rolled"] for r in wide] == [9.0, 1.0]


def test_accept_apart(spark):
    df = spark.createDataFrame([(1, at(h), float(h)) for h in (0, 5, 11, 12, 20, 24, 25)], "k int, t timestamp, v double")
    assert [r["v"] for r in intervals.accept_apart(df, by=["k"], at="t", value="v", seconds=12 * 3600).orderBy("t").collect()] == [0.0, 12.0, 24.0]


def test_interpolate_edges_and_gaps(spark):
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate([None, 2.0, None, None, 8.0, None])], "k int, i int, v double")
    assert [r["filled"] for r in timeseries.interpolate(df, by=["k"], order="i", value="v").orderBy("i").collect()] == [2, 2, 4, 6, 8, 8]


def test_followup_and_empty(spark):
    v = spark.createDataFrame([(1, 1, at(0), at(24)), (1, 2, at(48), at(72)), (2, 3, at(0), at(1))], "p int, v int, s timestamp, e timestamp")
    f = lambda df: {r["v"]: r["followed_up"] for r in joins.followup_flag(df, person="p", visit="v", start="s", end="e", days=30).collect()}
    assert f(v) == {1: 1, 2: 0, 3: 0} and f(v.limit(0)) == {}


def test_assembly_refuses_repeated_keys(spark):
    base = spark.createDataFrame([(1,), (2,)], "k int")
    with pytest.raises(Exception, match="repeats a key"):
        joins.assemble_features(base, [spark.createDataFrame([(1, 1), (1, 2)], "k int, x int")], "k").collect()


def test_nearest_neighbour_refuses_a_large_reference(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0), (2, None, 1.0)], "k int, x double, y double")
    assert rows(joins.nearest_neighbour(df, df.where("k = 1"), key="k", x="x", y="y")) == [(1, "1", 0.0), (2, "missing", None)]


def test_auroc_with_ties(spark):
    r = random.Random(3)
    data = [(i, int(r.random() < 0.4), round(r.random(), 1)) for i in range(200)]
    m = stats.binary_metrics(spark.createDataFrame(data, "id int, y int, s double"), y="y", score="s").first()
    pos, neg = [s for _, y, s in data if y], [s for _, y, s in data if not y]
    assert m["auroc"] == pytest.approx(sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / len(pos) / len(neg))


@pytest.mark.parametrize("small", [0, 1000])
def test_running_sums_are_plain_sums(spark, small, monkeypatch):
    monkeypatch.setattr(stats, "SMALL", small)
    r = random.Random(1)
    data = [(g, float(x), r.randrange(9)) for g in (1, 2) for x in r.sample(range(1000), 50)]
    got = stats.running_sums(spark.createDataFrame(data, "g int, x double, n int"), ["g"], "x", ["n"], falling=True).collect()
    assert all(row["n_run"] == sum(n for g, x, n in data if g == row["g"] and x >= row["x"]) for row in got) and len(got) == 100


def test_tails():
    assert stats.chi_square_tail(3.841459, 1) == pytest.approx(0.05, abs=1e-6)
    assert stats.fisher_exact(3, 1, 1, 3) == pytest.approx(0.485714, abs=1e-5)


def test_variance_ratio_tail():
    assert stats.variance_ratio_tail(2.866081, 4, 20) == pytest.approx(0.05, abs=1e-6)
    assert stats.variance_ratio_tail(4.964603, 1, 10) == pytest.approx(0.05, abs=1e-6)
    assert stats.variance_ratio_tail(0.0, 3, 5) == 1.0 and stats.variance_ratio_tail(1e9, 3, 50) < 1e-30
    assert stats.beta_part(2.5, 1.5, 0.3) + stats.beta_part(1.5, 2.5, 0.7) == pytest.approx(1, abs=1e-12)


def test_resamples_are_weighted_metrics(spark):
    """Each replicate is the metric of its draws, whatever the partitions; draws depend on score, label and seed alone."""
    r = random.Random(11)
    data = [(int(r.random() < 0.4), round(r.random(), 1)) for _ in range(150)] + [(1, None), (None, 0.5)]
    df = spark.createDataFrame(data, "y int, s double").withColumns({"part": F.lit(1), "replicate": F.lit("x"), "p": F.lit(0)})
    got = [sorted(map(tuple, stats.resampled_metrics(df.repartition(k), y="y", score="s", replicates=6).collect())) for k in (1, 5)]
    assert len(got[0]) == 6 and all(a == pytest.approx(b) for a, b in zip(got[0], got[1], strict=True))
    known = [(y, s) for y, s in data if y is not None and s is not None]
    for row in got[0]:
        cells = {(s, y): stats.draws(s, y, sum(k == (y, s) for k in known), 6, 5)[row[0]] for y, s in set(known)}
        pos, neg = ({s: w for (s, y), w in cells.items() if y == label} for label in (1, 0))
        area = sum(a * b * ((s > t) + 0.5 * (s == t)) for s, a in pos.items() for t, b in neg.items())
        assert row[1] == pytest.approx(area / sum(pos.values()) / sum(neg.values()))
    alone = spark.createDataFrame([(1, 0.5), (1, 0.7)], "y int, s double")
    assert stats.resampled_metrics(alone, y="y", score="s", replicates=4).collect() == []


def test_bootstrap_widens_like_the_theory(spark):
    """The interval's width at n rows against the normal one, and no exchange carries rows times replicates."""
    r = random.Random(2)
    data = [(int(r.random() < 0.5),) for _ in range(2000)]
    df = spark.createDataFrame([(y, r.gauss(y, 1.0)) for (y,) in data], "y int, s double")
    ci = {x["metric"]: x for x in stats.bootstrap_ci(df, y="y", score="s", replicates=200).collect()}["auroc"]
    auc = 0.76025  # of two normal scores one deviation apart
    n1 = sum(y for (y,) in data)
    q1, q2 = auc / (2 - auc), 2 * auc * auc / (1 + auc)
    se = ((auc * (1 - auc) + (n1 - 1) * (q1 - auc**2) + (len(data) - n1 - 1) * (q2 - auc**2)) / n1 / (len(data) - n1)) ** 0.5
    assert ci["low"] < auc < ci["high"] and ci["high"] - ci["low"] == pytest.approx(3.92 * se, rel=0.3) and ci["n"] == 200


def test_comparison_table(spark):
    rows = [("a", float(i), i % 2, "xyz"[i % 3]) for i in range(30)] + [("b", 40.0 + i, 1, "x") for i in range(30)] + [(None, 1.0, 1, "x"), ("b", None, None, None)]
    df = spark.createDataFrame(rows, "g string, v double, w int, l string")
    got = {(r.variable, r.level, r.group): r for r in stats.comparison_table(df, "g", ranked=["v"], normal=["w"], levels=["l"], top=1).collect()}
    assert got["size", "", "b"].n == 31 and got["size", "", "b"].display == "50.8%"
    assert got["v", "", "a"].display == "14.50 [7.25-21.75]" and got["v", "", "a"].p < 1e-9 and got["v", "", "a"].test == "kruskal"
    assert got["w", "", "a"].display == "0.50 (0.51)" and got["w", "", "b"].test == "anova" and got["w", "", "b"].p < 1e-4
    assert got["l", "other", "a"].display == "20 (66.7%)" and got["l", "x", "b"].n == 30 and ("l", "y", "a") not in got and got["l", "x", "a"].test == "pearson"
    with pytest.raises(ValueError, match="more than 1 groups"):
        stats.pairwise_ranks(df, "v", "g", most_groups=1)


def test_bootstrap_covers(spark):
    r = random.Random(5)
    data = [(i, int(r.random() < 0.5), r.random()) for i in range(300)]
    ci = {x["metric"]: x for x in stats.bootstrap_ci(spark.createDataFrame(data, "id int, y int, s double"), y="y", score="s", replicates=20).collect()}
    assert ci["auroc"]["low"] <= ci["auroc"]["high"] and 0.35 < ci["auroc"]["low"] and ci["auroc"]["high"] < 0.65


def test_standardizer_unseen_levels_and_json(spark):
    train = spark.createDataFrame([(1, 1.0, "a"), (2, 3.0, "a"), (3, 5.0, "b"), (4, None, None)], "id int, x double, v string")
    fit = prep.Standardizer.from_json(prep.fit_standardizer(train, numeric=["x"], categorical=["v"]).to_json())
    out = {r["id"]: r for r in prep.apply_standardizer(spark.createDataFrame([(9, None, "zzz"), (8, 100.0, None)], train.schema), fit, key="id").collect()}
    assert out[9]["v_other"] == 1 and out[9]["x_missing_ind"] == 1 and out[9]["x"] == pytest.approx(0) and out[8]["v_a"] == 1 and out[8]["x"] < 2


def test_draws_are_seeded(spark):
    df = spark.range(200)
    u = lambda seed: [r[0] for r in df.select(prep.uniform(F.col("id"), seed)).collect()]
    assert u(1) == u(1) != u(2) and all(0 <= x < 1 for x in u(1)) and abs(sum(u(1)) / 200 - 0.5) < 0.1
    n = [r[0] for r in df.select(prep.normal(F.col("id"), 4)).collect()]
    assert abs(sum(n) / 200) < 0.3 and not any(math.isnan(x) for x in n)


def test_conform_splits_rows(spark):
    df = spark.createDataFrame([("1", "short"), ("x", "short"), ("2", "much too long"), (None, "a")], "id string, name string")
    good, bad = io.conform(df, {"id": ("int", None, False), "name": ("string", 6, True)})
    assert rows(good) == [(1, "short")] and bad.count() == 3
    assert io.conform(df, {"id": ("int", None, False), "name": ("string", 6, True)}, truncate=True)[0].count() == 2


def test_bucket_keeps_known_ids(spark):
    df = spark.createDataFrame([(i % 5,) for i in range(50)], "id int")
    got = io.bucket_by_id(df, "id", 3, spark.createDataFrame([(2, 99)], "id int, batch int")).distinct().collect()
    assert {r["id"]: r["batch"] for r in got}[2] == 99 and len(got) == 5


def test_ordinal_and_labels(spark):
    df = spark.createDataFrame([(1, "Ward; ICU"), (1, "pacu"), (2, "ward"), (3, None)], "k int, v string")
    got = {r["k"]: r["w"] for r in df.groupBy("k").agg(aggs.ordinal_worst(F.col("v"), aggs.ORDERS["station"]).alias("w")).collect()}
    assert got == {1: "ICU", 2: "WARD", 3: None}
    assert rows(aggs.multi_label(df, ["k"], "v", {"icu": "icu", "ward": "ward"})) == [(1, 1, 1), (2, 0, 1), (3, None, None)]


def test_sanitize_and_types(spark):
    assert typing_ops.sanitize("VisitStart Date%") == "visit_start_date"
    df = spark.createDataFrame([("1", "2020-01-01", "x"), ("0", "2020-01-02", "y"), (None, None, None)], "b string, d string, s string")
    assert {r[0]: r[1] for r in typing_ops.infer_types(df, ["b", "d", "s"]).collect()} == {"b": "binary", "d": "date", "s": "cat_one_hot"}


def test_quantiles_are_those_of_sorted_lists(spark):
    """Ties, nulls, a constant group, one row, outliers, and a group that holds most rows."""
    import numpy as np

    rng = np.random.default_rng(4)
    groups = {"hot": [*np.round(rng.normal(size=900), 2), 1e12, -1e12], "same": [3.0] * 40, "one": [7.5], "few": [1.0, 2.0, 2.0, 9.0]}
    df = spark.createDataFrame([(g, float(x)) for g, xs in groups.items() for x in xs] + [("none", None), ("few", None), (None, 1.0)], "g string, x double").repartition(5)
    ps = [0.0, 0.01, 0.25, 0.5, 0.975, 1.0]
    got = {r["g"]: [r[f"q{i}"] for i in range(len(ps))] for r in stats.quantiles(df, ["g"], "x", ps).collect()}
    assert got.keys() == groups.keys()
    for g, xs in groups.items():
        assert got[g] == pytest.approx(np.quantile(xs, ps).tolist())
    mid = stats.quantiles(df.where("g = 'few'"), [], "x", [0.1, 0.9], midpoint=True).first()
    assert (mid["q0"], mid["q1"]) == (1.5, 5.5)
    assert stats.quantiles(df.where("false"), ["g"], "x", [0.5]).count() == 0


def test_running_sums_of_a_skewed_key(spark):
    """One outlier must not push all other rows into one range; missing keys come first in rising order."""
    data = [(i / 1000, 1) for i in range(5000)] + [(1e15, 1), (None, 1)]
    got = stats.running_sums(spark.createDataFrame(data, "x double, n int"), [], "x", ["n"]).collect()
    want = {x: i + 1 for i, (x, _) in enumerate(sorted(data, key=lambda r: float("-inf") if r[0] is None else r[0]))}
    assert {r["x"]: r["n_run"] for r in got} == want


def test_accept_apart_is_the_plain_loop(spark):
    rng = random.Random(8)
    data = sorted({(k, rng.randrange(400)) for k in range(4) for _ in range(80)})
    df = spark.createDataFrame([(k, DAY0 + dt.timedelta(hours=h), float(h)) for k, h in data] + [(1, None, 5.0)], "k int, t timestamp, v double")
    want, last = set(), {}
    for k, h in data:
        if k not in last or h - last[k] >= 7:
            want.add((k, float(h)))
            last[k] = h
    got = intervals.accept_apart(df, by=["k"], at="t", value="v", seconds=7 * 3600).collect()
    assert len(got) == len(want) and {(r["k"], r["v"]) for r in got} == want


def test_level_draws_follow_training_frequencies(spark):
    fit = prep.LevelFit(["a", "b", "c"], [6, 3, 1], "a", 0.0, False)
    drawn = spark.range(4000).select(prep.impute_level(F.lit(None).cast("string"), fit, "weighted", F.col("id")).alias("v"))
    n = {r["v"]: r["count"] for r in drawn.groupBy("v").count().collect()}
    assert n.keys() == {"a", "b", "c"} and all(abs(n[v] / 4000 - share) < 0.04 for v, share in (("a", 0.6), ("b", 0.3), ("c", 0.1)))
    assert spark.range(1).select(prep.impute_level(F.lit("z"), fit, "weighted", F.col("id"))).first()[0] == "z"


def test_redrawn_outliers_stay_in_the_outer_bands(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(1001)], "id long, x double")
    fit = prep.Standardizer.from_json(prep.fit_standardizer(df, numeric=["x"]).to_json()).numeric["x"]
    assert (fit.low, fit.inner_low, fit.median, fit.inner_high, fit.high) == (10.0, 150.0, 500.0, 850.0, 990.0)
    for r in df.select("x", prep.clip_or_redraw(F.col("x"), fit, F.col("id"), redraw=True).alias("y")).collect():
        assert 10 <= r["y"] <= 150 if r["x"] < 10 else 850 <= r["y"] <= 990 if r["x"] > 990 else r["y"] == r["x"]


def test_binned_pairs_and_overlaps_are_all_pairs(spark):
    rng = random.Random(3)
    at = lambda h: DAY0 + dt.timedelta(hours=h)
    rows = [(i, i % 2, at(s), at(s + rng.randrange(30)), float(i % 4)) for i, s in enumerate(rng.randrange(200) for _ in range(60))]
    a = spark.createDataFrame(rows[:30], "i int, k int, s timestamp, e timestamp, v double")
    b = spark.createDataFrame(rows[30:], "j int, k int, s2 timestamp, e2 timestamp, v double").drop("v")
    got = joins.overlap_join(a, b, key="k", a_start="s", a_end="e", b_start="s2", b_end="e2", bin_seconds=7 * 3600).select("i", "j").collect()
    want = {(x[0], y[0]) for x in rows[:30] for y in rows[30:] if x[1] == y[1] and x[2] <= y[3] and x[3] >= y[2]}
    assert len(got) == len(want) and {tuple(r) for r in got} == want
    den = spark.createDataFrame(rows[30:], "i int, k int, s timestamp, e timestamp, v double")
    for seconds in (0, 5 * 3600):
        n = joins.pair_within(a, den, key="k", at="s", value="v", seconds=seconds).count()
        assert n == sum(x[1] == y[1] and y[4] != 0 and abs((x[2] - y[2]).total_seconds()) <= seconds for x in rows[:30] for y in rows[30:])


def test_forest_scores_do_not_leak(spark):
    """Every row has one score; labels of a fold, turned round, do not change that fold's scores; a useful feature is found."""
    from wardline.operators import forest

    r = random.Random(9)
    data = [(i, float(r.random() < 0.3), r.random(), r.random()) for i in range(300)]
    data = [(i, y, a + y, None if i % 50 == 0 else b) for i, y, a, b in data] + [(300, None, 0.5, 0.5)]
    df = spark.createDataFrame(data, "id int, y double, a double, b double").repartition(3)
    run = lambda d: {x["id"]: (x["fold"], x["score"]) for x in forest.out_of_fold_scores(d, key="id", y="y", features=["a", "b"], select=1, folds=2, depths=[2, 3], trees=[5]).collect()}
    one = run(df)
    assert len(one) == 301 and all(0 <= s <= 1 for _, s in one.values())
    auc = stats.binary_metrics(spark.createDataFrame([(int(y), one[i][1]) for i, y, _, _ in data if y is not None], "y int, s double"), y="y", score="s").first()["auroc"]
    assert auc > 0.9
    held = [i for i, (f, _) in one.items() if f == 0]
    two = run(df.withColumn("y", F.when(F.col("id").isin(held), 1 - F.col("y")).otherwise(F.col("y"))))
    assert all(two[i] == one[i] for i in held) and any(two[i] != one[i] for i in one if i not in held)
