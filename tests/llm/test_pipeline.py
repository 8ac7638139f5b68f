"""Each stage of the pipeline against a plain version on the smallest tables, and the rules that hold for all."""

import os
import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from tests.llm.test_dedup import shingles
from wardline.llm import queries as Q

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs, out = spark.read.parquet(f"{DATA}/documents.parquet"), {}
    out["input"] = docs
    for name, stage in P.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, docs, DATA).write.parquet(path)
        docs = out[name] = spark.read.parquet(path)
    return out


def test_columns_stay(stages):
    for name, _ in P.STAGES[:-1]:
        assert stages[name].columns == stages["input"].columns


def test_toxic_documents_go(spark, stages):
    scored = Q.op6_toxicity(spark, DATA)
    assert {r[0] for r in stages["toxicity"].select("doc_id").collect()} == {r[0] for r in scored.where("predicted = 0").select("doc_id").collect()}


def test_one_of_each_group_stays(stages):
    sets = {r["doc_id"]: shingles(r["text"], 5) for r in stages["toxicity"].collect()}
    root = {i: i for i in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((root[a], root[b]))
                root = {i: x if k == y else k for i, k in root.items()}
    assert {r[0] for r in stages["minhash"].select("doc_id").collect()} == set(root.values())


def test_benchmark_passages_go(spark, stages):
    items = [r["text"] for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    before, after = ({r["doc_id"]: r["text"] for r in stages[n].collect()} for n in ("minhash", "decontamination"))
    leaks = {i for i, t in before.items() if any(x in (t or "") for x in items)}
    assert not leaks & set(after) and len(set(before) - leaks - set(after)) <= 0.01 * len(before)


def test_benchmark_stage_fits_on_all_documents(spark, monkeypatch):
    """All 4,500 documents and all items come to the fit, those without an id and those of one id included."""
    docs = spark.range(4_500).select(F.when(F.col("id") % 5 > 0, F.col("id") % 900).alias("doc_id"), F.concat(F.lit("plain words of text "), F.col("id")).alias("text"))
    fit, given = P.decontaminate.fit_space, []
    monkeypatch.setattr(P.decontaminate, "fit_space", lambda *frames, **more: given.append([x.count() for x in frames]) or fit(*frames, **more))
    assert P.drop_benchmark(spark, docs, DATA).count() == 4_500
    assert given == [[4_500, spark.read.parquet(f"{DATA}/benchmark.parquet").count()]]


def test_personal_data_is_replaced(stages):
    text = " ".join(r["text"] or "" for r in stages["pii"].collect())
    assert not re.search(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)
    assert stages["pii"].count() == stages["decontamination"].count()
    assert not stages["pii"].where(F.length("text") != F.col("n_chars")).count()


def test_all_documents_are_packed(stages):
    pieces = stages["packing"]
    assert pieces.select("doc_id").distinct().count() == stages["pii"].count()
    assert pieces.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("m")).where("n <> m or n > 2048").count() == 0


def test_run_gives_the_last_stage(spark, stages):
    assert sorted(map(tuple, P.run(spark, DATA).drop("sequence_id", "offset").collect())) == sorted(map(tuple, stages["packing"].drop("sequence_id", "offset").collect()))


COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, spans string, score double"


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """Documents with nulls, empty texts, a long text, repeated and clashing ids, and columns named like results."""
    clean = "the morning train left the old station and everyone on board was quietly reading a newspaper about distant towns"
    other = "a gardener planted seven rows of beans beside the stone wall before the rain came over the hills from the west"
    rows = [
        (1, clean, "en", "a", 1, "s", 0.5), (2, clean, None, None, None, None, None), (2, other, "en", "b", 2, "s", 0.1), (2, other, "en", "b", 2, "s", 0.1),
        (3, None, None, "a", None, None, None), (4, "", "en", "a", 0, None, None), (None, clean, "en", "a", 1, None, None), (None, None, None, None, None, None, None),
        (5, "alpha beta gamma delta " * 40_000 + "write to someone@mail.example.org", "en", "a", 3, None, None),
    ]
    root = tmp_path_factory.mktemp("odd")
    spark.createDataFrame(rows, COLUMNS).write.parquet(str(root / "documents.parquet"))
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{DATA}/{name}.parquet").write.parquet(str(root / f"{name}.parquet"))
    return str(root)


def test_stages_on_odd_rows(spark, odd):
    docs = spark.read.parquet(f"{odd}/documents.parquet")
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, odd)
        assert out.columns == docs.columns, name
        rows = sorted((str(r["doc_id"]), str(r["text"])[:20]) for r in out.collect())
        if name == "minhash":
            assert rows == sorted([("1", "the morning train le"), ("2", "a gardener planted s"), ("3", "None"), ("4", ""), ("5", "alpha beta gamma del"), ("None", "the morning train le"), ("None", "None")])
        else:
            assert len(rows) == docs.count(), name
        if name == "pii":
            assert out.where("doc_id = 5").first()["text"].endswith("write to <email>")
        assert stage(spark, docs.limit(0), odd).count() == 0
    assert P.run(spark, odd).select("doc_id").distinct().count() == 6
    assert P.pack_sequences(spark, docs, odd).count() > docs.count() and P.pack_sequences(spark, docs.limit(0), odd).count() == 0


def test_unrelated_texts_of_one_id_stay(spark):
    r = random.Random(4)
    a, b, c = (" ".join("".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(60)) for _ in range(3))
    rows = [(5, a), (5, b), (5, b), (3, c), (8, b + " more"), (9, a), (None, a)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = P.drop_near_copies(spark, docs, DATA)
    assert got.columns == docs.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(5, a), (5, b), (3, c), (None, a)], key=str)
