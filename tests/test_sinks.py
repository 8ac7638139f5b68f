"""Sinks, packaging, long series and folds of constant memory, on small frames against plain Python."""

import datetime as dt
import os
import random
import threading

import pytest
from pyspark.sql import functions as F

from wardline.functions import hooks
from wardline.operators import intervals, prep
from wardline.sources import io

DAY0 = dt.datetime(2024, 1, 1)
minute = lambda m: DAY0 + dt.timedelta(minutes=m)
TARGET = {"id": ("int", None, False), "name": ("string", 3, True)}


@pytest.mark.parametrize("batch", [3, 10_000])
def test_long_chains_are_folded_over_batches(spark, batch):
    r = random.Random(7)
    data = [(k, None if r.random() < 0.02 else minute(r.randrange(5000)), r.choice([None, 2**60 + r.randrange(5)])) for k in (1, 1, 1, None) for _ in range(300)] + [(2, minute(0), 1)] * 3
    df = spark.createDataFrame(data, "k int, t timestamp, v long")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        for apart in (0, 1, 30, 600):
            want = []
            for k in {d[0] for d in data}:
                last = None
                for t, _, v in sorted((t, (v is not None, v or 0), v) for g, t, v in data if g == k and t):
                    if last is None or t >= last + dt.timedelta(minutes=apart):
                        want.append((k, t, v))
                        last = t
            got = [tuple(x) for x in intervals.accept_apart(df, by=["k"], at="t", value="v", seconds=apart * 60).collect()]
            assert sorted(got, key=repr) == sorted(want, key=repr)
        assert intervals.accept_apart(df.limit(0), by=["k"], at="t", value="v", seconds=60).count() == 0
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("batch", [3, 10_000])
def test_running_rule_is_the_whole_group_rule(spark, batch):
    r = random.Random(11)
    spans = [(r.choice(["a", "b", None]), s := r.randrange(3000), s + r.randrange(20)) for _ in range(400)]
    df = spark.createDataFrame([(k, minute(s), minute(e)) for k, s, e in spans] + [("a", None, minute(1)), ("c", minute(1), None)], "k string, s timestamp, e timestamp")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = hooks.condense_running(df, by=["k"], start="s", end="e", joins=lambda a, b, s, e: s <= b and e - a <= 40 * 60_000_000)
        want = []
        for k in ("a", "b", None):
            now = None
            for s, e in sorted((s, e) for g, s, e in spans if g == k):
                if now and s <= now[1] and e - now[0] <= 40:
                    now = (now[0], max(now[1], e), now[2] + 1)
                else:
                    want += [(k, minute(now[0]), minute(now[1]), now[2])] if now else []
                    now = (s, e, 1)
            want.append((k, minute(now[0]), minute(now[1]), now[2]))
        assert sorted((tuple(x) for x in got.collect()), key=repr) == sorted(want, key=repr)
        assert hooks.condense_running(df.limit(0), by=["k"], start="s", end="e", joins=lambda *_: True).count() == 0
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def _database(spark, name):
    url = f"jdbc:derby:memory:{name};create=true"
    return url, spark._jvm.java.sql.DriverManager.getConnection(url)


def test_database_reads_in_parts_and_again_after_a_lock(spark):
    url, held = _database(spark, "locked")
    run = held.createStatement()
    run.execute("call syscs_util.syscs_set_database_property('derby.locks.waitTimeout', '1')")
    io.to_database(url, "facts")(spark.range(100).select(F.col("id").cast("int").alias("K"), (F.col("id") * 2).cast("int").alias("V")))
    parts = io.read_database(spark, url, "select * from facts", partition=("K", 10, 90, 4))
    assert parts.rdd.getNumPartitions() == 4 and parts.count() == 100
    held.setAutoCommit(False)
    run.execute("lock table facts in exclusive mode")
    with pytest.raises(Exception, match="(?i)lock"):
        io.read_database(spark, url, "select sum(v) s from facts").collect()
    release = threading.Timer(4.0, held.commit)
    release.start()
    assert io.read_database(spark, url, "select sum(v) s from facts", attempts=6, wait=0.5).first()[0] == 9900
    release.join()
    with pytest.raises(Exception, match="(?i)absent"):
        io.read_database(spark, url, "select * from absent", attempts=3, wait=60)
    held.close()


def test_other_errors_are_not_tried_again():
    seen = []

    def fails(text):
        seen.append(text)
        raise RuntimeError(text)

    with pytest.raises(RuntimeError):
        io.retried(lambda: fails("no such table"), attempts=5, wait=0)
    with pytest.raises(RuntimeError):
        io.retried(lambda: fails("Deadlock found"), attempts=3, wait=0)
    assert len(seen) == 4


def test_files_are_cut_by_bytes(spark, tmp_path):
    df = spark.createDataFrame([(i, 'a "q", é' * (i % 5), None if i % 3 else "x") for i in range(2000)], "id int, t string, n string")
    for fmt in ("csv", "tsv"):
        io.write_table(df, f"{tmp_path}/{fmt}", fmt=fmt, bytes_per_file=4000)
        sizes = [os.path.getsize(f"{tmp_path}/{fmt}/{f}") for f in os.listdir(f"{tmp_path}/{fmt}") if f.startswith("part")]
        assert max(sizes) <= 4000 and len(sizes) >= sum(sizes) / 4000
        assert io.read_delimited(spark, f"{tmp_path}/{fmt}", separator="," if fmt == "csv" else "\t").count() == 2000
    io.write_table(df, f"{tmp_path}/four", files=4)
    assert len([f for f in os.listdir(f"{tmp_path}/four") if f.endswith(".parquet")]) == 4
    with pytest.raises(ValueError):
        io.write_table(df, f"{tmp_path}/narrow", fmt="csv", bytes_per_file=30)
    with pytest.raises(ValueError):
        io.write_table(df, f"{tmp_path}/columnar", bytes_per_file=4000)


def test_append_holds_back_batches_of_unfit_rows(spark, tmp_path):
    raw = [("1", "ab", "x"), ("no", "cd", "x"), ("3", "long", "y"), ("4", None, "y"), (None, "ef", None), ("6", "gh", "z")]
    df = spark.createDataFrame(raw, "id string, name string, load string")
    read = lambda name, c: sorted(r[0] for r in spark.read.parquet(f"{tmp_path}/{name}").select(c).collect())
    io.append_table(df, TARGET, write=io.to_folder(f"{tmp_path}/a"), review=io.to_folder(f"{tmp_path}/a_review"))
    assert read("a", "id") == [1, 4, 6] and read("a_review", "unfit") == [["id"], ["id"], ["name"]]
    io.append_table(df, TARGET, write=io.to_folder(f"{tmp_path}/b"), review=io.to_folder(f"{tmp_path}/b_review"), batch=F.col("load"))
    assert read("b", "id") == [6] and read("b_review", "unfit") == [[], [], ["id"], ["id"], ["name"]]
    io.append_table(df, TARGET, write=io.to_folder(f"{tmp_path}/b"), review=io.to_folder(f"{tmp_path}/b_review"), batch=F.col("load"), truncate=True)
    assert read("b", "id") == [3, 4, 6, 6] and len(read("b_review", "unfit")) == 8
    url, held = _database(spark, "appended")
    io.append_table(df, {"id": ("int", None, False)}, write=io.to_database(url, "kept"), review=io.to_folder(f"{tmp_path}/c_review"))
    assert sorted(r[0] for r in io.read_database(spark, url, 'select "id" from kept').collect()) == [1, 3, 4, 6]
    held.close()


def test_package_reads_back_as_it_was(spark, tmp_path):
    r = random.Random(3)
    steps = [(r.randrange(1, 9), minute(r.randrange(30)), r.choice([None, 1.5, 2.5]), "note", r.randrange(2)) for _ in range(200)]
    steps += [steps[0]] * 3 + [(9, minute(m), float(m), "hot", 0) for m in range(300)]
    series = spark.createDataFrame(steps, "id int, t timestamp, v double, note string, v_missing_ind int")
    static = spark.createDataFrame([(i, i * 0.5, "s") for i in range(2, 12)], "id int, a double, b string")
    split = spark.createDataFrame([(i, ["Training", "Development", "Test"][i % 3]) for i in range(12)], "id int, split string")
    y = spark.createDataFrame([(i, i % 2) for i in range(1, 11)], "id int, y int")
    path = f"{tmp_path}/package"
    io.write_package({"series": series, "static": static}, split, y, key="id", path=path, sequences={"series": "t"})
    assert sorted(os.listdir(f"{path}/series")) == ["missing", "numeric", "offsets", "text", "time"] and sorted(os.listdir(f"{path}/static")) == ["numeric", "text"]
    both = ["Development", "Test"]
    assert {x["id"] for x in io.read_package(spark, path, "static", "numeric", both).collect()} == {i for i in range(2, 10) if i % 3}
    columns = [{(x["split"], x["position"]): x[c] for x in io.read_package(spark, path, "series", kind).collect()} for kind, c in (("time", "t"), ("numeric", "v"), ("text", "note"), ("missing", "v_missing_ind"))]
    got, places = [], []
    for x in io.read_package(spark, path, "series", "offsets").collect():
        span = [(x["split"], p) for p in range(x["start"], x["start"] + x["length"])]
        times = [columns[0][p] for p in span]
        assert times == sorted(times)
        got += [(x["id"], *(c[p] for c in columns)) for p in span]
        places += span
    assert sorted(got, key=repr) == sorted((s for s in steps if s[0] in range(2, 10)), key=repr)
    assert sorted(places) == sorted((s, p) for s in {s for s, _ in places} for p in range(sum(q[0] == s for q in places)))


def test_series_of_odd_rows(spark):
    at = lambda h: DAY0 + dt.timedelta(hours=h)
    data = [("a", "hr", at(0), 1.0), ("a", "hr", at(0.5), 3.0), ("a", "hr", at(5), None), ("a", "bp", at(2), 7.0), ("b", "bp", at(1), 9.0), ("b", "flat", at(1), 4.0), ("b", None, at(1), 4.0), (None, "hr", at(1), 4.0), ("b", "hr", None, 4.0), ("b", "void", at(9), None)]
    df = spark.createDataFrame(data, "k string, m string, t timestamp, v double")
    fit = prep.fit_series(df, variable="m", value="v")
    assert {v: f.drop for v, f in fit.numeric.items()} == {"hr": False, "bp": False, "flat": True, "void": True}
    assert fit.numeric["hr"].missing == pytest.approx(0.2) and fit.numeric["hr"].median == 3.5
    out = prep.apply_series(df, fit, key="k", variable="m", at="t", value="v", seconds=3600, carry=2).orderBy("k", "t").collect()
    assert [(r["k"], r["t"]) for r in out] == [("a", at(h)) for h in range(6)] + [("b", at(h)) for h in range(1, 10)]
    assert [r["hr_missing_ind"] for r in out[:6]] == [0, 1, 1, 1, 1, 1] and [r["bp_missing_ind"] for r in out[:6]] == [1, 1, 0, 1, 1, 1]
    f = fit.numeric["hr"]
    assert out[2]["hr"] == pytest.approx(((max(1.0, f.low) + 3) / 2 - f.mean) / f.std) and out[3]["hr"] == pytest.approx((f.median - f.mean) / f.std)
    with pytest.raises(ValueError):
        prep.fit_series(df, variable="m", value="v", most_variables=2)
    empty = prep.fit_series(df.limit(0), variable="m", value="v")
    assert prep.apply_series(df, empty, key="k", variable="m", at="t", value="v", seconds=3600).columns == ["k", "t"]


def test_numbers_in_odd_texts(spark):
    texts = {"1,234.5": 1234.5, "1..5": 1.5, "-2-4": 1.0, "B-1-3": 2.0, "1.5/2": None, "x-1/2": 1.0, "neg-5": 5.0, "negative 4": -4.0, "NEG 1 2": 1.0, "3 # 4": 3.0, "1 2 3": 1.0, "10/12/2020": None, "of": None, "1.2.3": 1.2, "5.": 5.0}
    from wardline.functions import scalars as S

    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert {r[0]: r[1] for r in df.select("t", S.extract_number(F.col("t"))).collect()} == texts
