"""Ranked search and the token files against plain versions."""

import glob
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyarrow import orc
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")
from wardline.llm import ranked_search, token_store  # noqa: E402

PATH = public_tokenizers.path("word_bpe_49k.json")
DATA = "/root/testdata/sf0.001"
ODD = ["", "<|endoftext|> a<|startoftext|>b", "don't We'LL 'S x's 'tis,'s", "İstanbul ıI", "é é", "a\x1cb\x1fc\x85d\xa0e f　g", "x" * 5000, "١٢٣ 12３4 ²³¼", "ﬁ Σίσυφος ΣΑΣ", "日本語 テキスト", "\x00\x01\x7f", "😀👍🏽 a̐éö̲", "ªº µ ×÷ßÿ ŸŽ", "a​b ﻿c \xadhy", "a\n\r\t\x0b\x0c b", "́a ́", "각", None, "word " * 30_000]


def test_encoder_is_the_tokenizer(spark):
    t, e = token_store.tokenizer(PATH), token_store.Encoder(PATH)
    assert e.by_parts
    texts = [x for x in ODD if x is not None] + [r[0] for r in spark.read.parquet(f"{DATA}/documents.parquet").select("text").where("text is not null").collect()]
    for kept in (3, 100_000):  # a table that overflows at once, and one that does not
        e.parts.most = e.words.most = kept
        for x in texts:
            assert np.frombuffer(e(x.encode()), "<u4").tolist() == t.encode(x, add_special_tokens=False).ids, x[:40]
    other = token_store.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    assert not other.by_parts and np.frombuffer(other("a b\n c".encode()), "<u4").tolist() == other.tokenizer.encode("a b\n c", add_special_tokens=False).ids


def plain_tokens(rows):
    t, want, start = token_store.tokenizer(PATH), [], 0
    for i, x in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*t.encode(x or "", add_special_tokens=False).ids, 1]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return want


def test_round_trip_of_documents(spark):
    from wardline.llm.queries import op11_token_ids

    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, op11_token_ids(spark, DATA).collect())) == plain_tokens(rows)


def test_round_trip_of_odd_rows(spark):
    rows = [*enumerate(ODD, -3), (500, "copy"), (500, "copy"), (None, "no id")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"ids": F.lit("x"), "part": F.lit(1), "start": F.lit(2), "mark": F.lit(3)})
    got = sorted(map(tuple, token_store.round_trip(df.repartition(3), PATH).collect()), key=lambda r: r[1])
    assert got == plain_tokens(rows)
    assert token_store.round_trip(df.where("false"), PATH).collect() == []


def test_files_are_pruned_and_read_by_stripes(spark, tmp_path):
    path = str(tmp_path / "tokens")
    docs = spark.range(0, 40_000, 2).select(F.col("id").alias("doc_id"), F.concat_ws(" ", *(F.sha2((F.col("id") + k).cast("string"), 256) for k in range(3))).alias("text"))
    token_store.write(docs, path, PATH, stripe_bytes=1 << 18, stride=1000)
    files = sorted(glob.glob(f"{path}/*.orc"))
    assert any(orc.ORCFile(f).nstripes > 1 for f in files) and all(orc.ORCFile(f).row_index_stride == 1000 for f in files)
    order = [i for f in files for i in orc.ORCFile(f).read(["doc_id"])["doc_id"].to_pylist()]
    assert order == list(range(0, 40_000, 2))
    flat = lambda r: (*r[:3], tuple(r[3]))
    whole = {r[0]: flat(r) for r in token_store.read(spark, path).collect()}
    ends = [(r[1], r[1] + r[2]) for r in sorted(whole.values(), key=lambda r: r[1])]
    assert ends[0][0] == 0 and all(a[1] == b[0] for a, b in zip(ends, ends[1:])) and all(len(r[3]) == r[2] and r[3][-1] == 1 for r in whole.values())

    def scanned(df):
        rows = df.collect()
        plans, found = [df._jdf.queryExecution().executedPlan()], 0
        while plans:
            p = plans.pop()
            if "AdaptiveSparkPlan" in p.nodeName():
                p = p.executedPlan()
            if "Scan orc" in p.nodeName() and "ids" in p.output().toString():
                found += p.metrics().apply("numOutputRows").value()
            plans += [p.children().apply(i) for i in range(p.children().size())]
            if "QueryStage" in p.nodeName():
                plans.append(p.plan())
        return rows, found

    rows, read = scanned(token_store.lookup(spark, path, [1234, 39_998]))
    assert {flat(r) for r in rows} == {whole[1234], whole[39_998]} and read <= 4_000
    rows, read = scanned(token_store.lookup(spark, path, [1235, 20_001]))  # within bounds, but in no Bloom filter
    assert rows == [] and read == 0
    low, high = ends[7000][0] + 5, ends[7300][0] + 1
    rows, read = scanned(token_store.between(spark, path, low, high))
    assert {flat(r) for r in rows} == {r for r in whole.values() if r[1] < high and r[1] + r[2] > low} and read <= 4_000
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 18))
    try:
        split = token_store.read(spark, path)
        assert split.rdd.getNumPartitions() > len(files) and {flat(r) for r in split.collect()} == set(whole.values())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


WORDS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_search(docs, items, top=10):
    held = [(i, Counter(WORDS.findall((t or "").translate(LOWER)))) for i, t in docs]
    held = [(i, c, sum(c.values())) for i, c in held if c]
    n_docs, length, out = len(held), sum(n for _, _, n in held), []
    for item, text in items:
        found = []
        asked = set(WORDS.findall((text or "").translate(LOWER)))
        w = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * sum(t in c for _, c, _ in held) + 1))) for t in asked}
        for i, c, n in held:
            m = 10 + (90 * n * n_docs) // length
            score = sum(w[t] * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in asked if t in c)
            if score:
                found.append((-score, i is None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(found)[:top], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize(("block", "run", "short"), [(8192, 256, 1 / 16), (50, 3, 1 / 4), (7, 1, 0.0), (40, 8, 1.0)])
def test_blocks_rank_like_a_full_search(block, run, short, monkeypatch):
    """The search of a task, for blocks, runs and shares of short lists of any size."""
    for name, value in (("BLOCK", block), ("RUN", run), ("SHORT", short)):
        monkeypatch.setattr(ranked_search, name, value)
    draw = random.Random(block)
    common = ["a", "B", "c1", "dé"] + [f"w{i}" for i in range(40)]
    docs = [(i // 2 if i % 9 else None, " ".join(draw.choices(common, weights=[400, 200, 100, 50] + [3] * 40, k=draw.randrange(1, 30)))) for i in range(300)]
    items = [(j, " ".join(draw.choices(common, k=6))) for j in range(25)]
    import pyarrow as pa

    asked = [sorted(set(ranked_search.terms(t.encode()))) for _, t in items]
    vocabulary = {t: i for i, t in enumerate(sorted(set().union(*asked)))}
    batch = pa.RecordBatch.from_arrays([pa.array([d for d, _ in docs], pa.int64()), pa.array([t for _, t in docs]), pa.array([zlib.crc32(t.encode()) for _, t in docs], pa.int64())], names=["doc_id", "text", "mark"])
    counted = [b for lo in range(0, 300, 60) for b in ranked_search._counted(vocabulary)(iter([batch.slice(lo, 60)]))]
    (df,) = ranked_search._document_counts(len(vocabulary))(iter(counted))
    weights = np.zeros(len(vocabulary), np.int64)
    for t, d in zip(df.column(0).to_pylist(), df.column(1).to_pylist()):
        weights[t] = math.floor(1000 * math.log(602 / (2 * d + 1)))
    length = sum(len(ranked_search.terms(t.encode())) for _, t in docs)
    (found,) = ranked_search._rank([np.array([vocabulary[t] for t in a]) for a in asked], weights, 300, length, 10, 90, 8, 10**9)(iter(counted))
    got = {}
    for item, doc, _, score in zip(*(c.to_pylist() for c in found.columns)):
        got.setdefault(item, []).append((item, len(got.get(item, [])) + 1, doc, score))
    assert sorted((r for rows in got.values() for r in rows), key=repr) == plain_search(docs, items)


def test_search_of_odd_rows(spark):
    docs = [(1, "Étude of the-thing_THE"), (2, None), (3, ""), (4, "... !"), (5, "the thing"), (5, "the thing"), (None, "the thing"), (6, "thing " * 50_000), (7, "ét étude"), (8, "a\x00b\x7fthe")]
    items = [(1, "The THING"), (1, "étude"), (2, None), (None, "thing ét"), (3, "?"), (4, "absent")]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"mark": F.lit("x"), "n": F.lit(1), "terms": F.lit(0), "score": F.lit(2)})
    q = spark.createDataFrame(items, "item_id long, text string").withColumns({"item": F.lit(1), "rank": F.lit(2)})
    for most in (2_000, 2):
        got = ranked_search.search(d.repartition(4), q, top=3, most_items=most).select("item_id", "rank", "doc_id", "score").collect()
        assert sorted(map(tuple, got), key=repr) == plain_search(docs, items, top=3)
    assert ranked_search.search(d.where("false"), q).collect() == [] and ranked_search.search(d, q.where("false")).collect() == []
