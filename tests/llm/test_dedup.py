"""Near copies, repeated substrings and fingerprints against plain versions."""

import hashlib
import math
import random
import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from wardline.llm import fingerprint, minhash, suffix_dedup
from wardline.llm.components import connected_components
from wardline.llm.common import Scratch

WORDS = [a + b for a in "ba be bi bo bu da de di do du ga ge gi go gu".split() for b in "ka ke ki ko ku la le li lo lu ma me".split()]


def prose(r, n):
    return " ".join(r.choice(WORDS) for _ in range(n))


def copies(r, text, n, most):
    out = []
    for _ in range(n):
        words = text.split()
        for _ in range(r.randrange(most + 1)):
            words[r.randrange(len(words))] = r.choice(WORDS)
        out.append(" ".join(words))
    return out


@pytest.fixture(scope="module")
def texts():
    r = random.Random(4)
    out = [prose(r, r.randrange(20, 80)) for _ in range(60)]
    out += [out[0], out[0].upper(), "  ".join(out[1].split()), None, "", " \n ", "one", "One", "two words", "long " * 4000]
    out += copies(r, out[2], 20, 4) + copies(r, prose(r, 120), 70, 12)
    return list(enumerate(out, 100))


def frame(spark, data):
    # other columns, some with names that the operators use inside
    return spark.createDataFrame([(i, t, "x", 1, None) for i, t in data], "doc_id long, text string, id string, key int, bands string")


def shingles(text, n):
    w = (text or "").encode().lower().split()
    return set(zip(*(w[i:] for i in range(n)), strict=False)) if len(w) >= n else {tuple(w)} if w else set()


@pytest.mark.parametrize("size,percent", [(3, 85), (5, 80)])
def test_components_are_those_of_all_pairs(spark, texts, size, percent):
    sets = {i: shingles(t, size) for i, t in texts}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    got = {r["doc_id"]: r for r in minhash.near_duplicates(frame(spark, texts), shingle=size, percent=percent).collect()}
    assert len(got) == len(texts)
    for i in sets:
        assert (got[i]["n_shingles"], got[i]["component_id"], got[i]["kept"]) == (len(sets[i]), find(i), find(i) == i)


def test_both_ways_to_compare_open_buckets_agree(spark):
    r, base = random.Random(31), [f"w{k}" for k in range(60)]
    data = []
    for i in range(150):
        words = list(base)
        for _ in range(r.randrange(12)):
            words[r.randrange(60)] = f"v{r.randrange(40)}"
        data.append((i, " ".join(words)))
    got = [sorted(map(tuple, minhash.near_duplicates(frame(spark, data), small_bucket=n).collect())) for n in (0, 16, 10**9)]
    assert got[0] == got[1] == got[2] and 1 < len({x[2] for x in got[0]}) < 150


def test_near_duplicates_of_odd_rows(spark):
    df = frame(spark, [(None, "a b c d"), (1, "a b c d"), (1, "a b c d"), (2, "q r s t"), (2, "a b c d")])
    got = sorted((r["doc_id"] or 0, r["component_id"] or 0, r["kept"]) for r in minhash.near_duplicates(df, shingle=3, percent=85).collect())
    assert got == [(0, 0, True), (1, 1, True), (1, 1, True), (2, 1, False), (2, 1, False)]
    assert minhash.near_duplicates(df.limit(0)).count() == 0


def test_prune_table_keeps_what_is_similar():
    least = minhash.prune_table(0.85, 1e-6, 16, 8)
    r = np.random.default_rng(1)
    hits = np.cumsum((r.random((20_000, 128)) < 0.86).reshape(20_000, 8, 16).sum(axis=2), axis=1)
    assert (hits >= np.array(least)).all(axis=1).mean() > 0.9995
    far = np.cumsum((r.random((2_000, 128)) < 0.5).reshape(2_000, 8, 16).sum(axis=2), axis=1)
    assert (far >= np.array(least)).all(axis=1).mean() < 0.01


def test_connected_components(spark):
    edges = [(1, 2), (2, 3), (9, 8), (8, 7), (20, 21)] + [(i, i + 1) for i in range(100, 160)]
    got = {r["id"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark)).collect()}
    assert got[3] == 1 and got[9] == 7 and got[21] == 20 and {got[i] for i in range(100, 161)} == {100} and len(got) == 69


def removed(data, length):
    seen, out = set(), {}
    rank = lambda i: (i is None, i or 0)
    for i in sorted({i for i, _ in data}, key=rank):
        mine = [(t or "").encode() for j, t in data if j == i]
        for b in mine:
            gone = bytearray(len(b))
            for k in range(len(b) - length + 1):
                if b[k : k + length] in seen:
                    gone[k : k + length] = b"\1" * length
            runs = sum(1 for k in range(len(b)) if gone[k] and not (k and gone[k - 1]))
            out.setdefault(i, []).append((len(b), sum(gone), runs, hashlib.sha256(bytes(x for x, y in zip(b, gone, strict=True) if not y)).hexdigest()))
        if i is not None:
            seen |= {b[k : k + length] for b in mine for k in range(len(b) - length + 1)}
    return {i: sorted(v) for i, v in out.items()}


@pytest.mark.parametrize("block_bytes,crowd,hot", [(2_000, 32, 4096), (1 << 20, 32, 4096), (2_000, 1, 1), (4_000, 10**9, 10**9), (4_000, 10**9, 1)])
def test_repeats_are_those_of_all_windows(spark, block_bytes, crowd, hot):
    r = random.Random(8)
    shared, line = prose(r, 30), "é" * 40 + prose(r, 6)
    data = [(i, prose(r, r.randrange(1, 40)) + (" " + shared if i % 3 == 0 else "") + (line if i % 7 == 0 else "") + prose(r, r.randrange(3))) for i in range(150)]
    data += [(500, data[3][1]), (501, data[3][1] * 3), (502, None), (503, ""), (504, "z" * 5000), (505, "z" * 300), (506, "short"), (507, data[5][1]), (507, data[5][1]), (None, data[9][1]), (None, data[9][1])]
    got = {}
    for x in suffix_dedup.drop_repeats(frame(spark, data), length=50, block_bytes=block_bytes, crowd=crowd, hot=hot).collect():
        got.setdefault(x["doc_id"], []).append((x["n_bytes"], x["n_removed"], x["n_spans"], x["kept_sha256"]))
    assert {i: sorted(v) for i, v in got.items()} == removed(data, 50)
    assert suffix_dedup.drop_repeats(frame(spark, data).limit(0)).count() == 0


def calls(task, *tables):
    """Result of a task, and how many functions it calls."""
    n = [0]

    def count(frame, event, arg):
        n[0] += event in ("call", "c_call")

    sys.setprofile(count)
    try:
        out = task(*tables)
    finally:
        sys.setprofile(None)
    return out, n[0]


def test_work_on_repeats_does_not_grow_with_the_number_of_buckets():
    """The rows of a block are one for each bucket, so a call a row would make the work grow with the square of the input."""
    r = random.Random(3)
    shared = [prose(r, 25) for _ in range(40)]
    data = [(i, prose(r, 20) + " " + shared[i % 40] + prose(r, 10)) for i in range(400)]
    table = pa.table({"doc_id": [i for i, _ in data], "text": [t for _, t in data], "block": pa.array([0] * 400, pa.int32())})
    results, counts = [], []
    for buckets in (16, 4_000):
        sent, n = calls(suffix_dedup._entries(50, buckets, 1), table)
        back = sent.select(["block", "bucket"]).append_column("flags", pa.array([bytes([3 if k % 2 else 2]) * (len(a) // 5) for k, a in enumerate(sent.column("a").to_pylist())], pa.binary()))
        pending, m = calls(suffix_dedup._resolve(50, buckets, 1), table, back)
        kind = pa.array(pending.column("kind"))
        answers = pending.filter(pc.is_in(kind, pa.array(["open", "hot"])))
        sizes = [len(a) // 8 if k == "hot" else sum(b[i] + 1 for i in range(1, len(b), 2)) for k, a, b in zip(*(answers.column(c).to_pylist() for c in ("kind", "a", "b")), strict=True)]
        answers = answers.select(["kind", "block", "bucket"]).append_column("flags", pa.array([bytes(k) for k in sizes], pa.binary()))
        done, k = calls(suffix_dedup._finish(50), pending.filter(pc.not_equal(kind, "done")), answers)
        assert answers.num_rows > (100 if buckets > 16 else 10)
        results.append(sorted(done.to_pylist(), key=lambda x: x["doc_id"]))
        counts.append((n, m, k))
    assert results[0] and all(high < 1.5 * low for low, high in zip(*counts, strict=True)), counts


def test_suffixes_are_compared_only_where_they_begin_alike(monkeypatch):
    r, pairs, plain = np.random.default_rng(5), [], suffix_dedup.common_extension
    data = r.integers(97, 123, 40_000).astype(np.uint8)
    starts = np.arange(0, 39_900, 10)
    starts = np.r_[starts, starts[:50]]
    monkeypatch.setattr(suffix_dedup, "common_extension", lambda poly, a, b, limit: pairs.append(len(a)) or plain(poly, a, b, limit))
    classes = suffix_dedup.sorted_classes(data, suffix_dedup.PolyHash(data), starts, np.zeros(len(starts), np.int64), 50)
    assert len(set(classes.tolist())) == len(starts) - 50 and (classes[-50:] == classes[:50]).all()
    assert sum(pairs) < len(starts)


def test_suffix_sort_finds_equal_prefixes():
    r = random.Random(2)
    data = np.frombuffer("".join(r.choice("ab") for _ in range(3000)).encode(), np.uint8)
    poly, limit = suffix_dedup.PolyHash(data), 7
    starts = np.arange(len(data) - limit + 1)
    groups = starts % 3
    classes = suffix_dedup.sorted_classes(data, poly, starts, groups, limit)
    plain = {}
    for s, g, k in zip(starts, groups, classes, strict=True):
        plain.setdefault((g, data[s : s + limit].tobytes()), set()).add(int(k))
    assert all(len(v) == 1 for v in plain.values()) and len(plain) == len(set(classes.tolist()))
    a, b = np.array([0, 5, 9]), np.array([100, 5, 2000])
    for x, y, n in zip(a, b, suffix_dedup.common_extension(poly, a, b, 64), strict=True):
        k = 0
        while k < 64 and data[x + k] == data[y + k]:
            k += 1
        assert n == k


def test_fingerprints_add_and_subtract(spark):
    df = spark.createDataFrame([(1, "red fox ran.\nblue hen sat."), (2, "blue hen sat.\nred fox ran."), (3, "red fox ran."), (4, ""), (5, None)], "doc_id long, text string")
    got = {r["doc_id"]: r["fingerprint"] for r in fingerprint.fingerprints(df).collect()}
    assert got[1] == got[2] != got[3] and got[4] == got[5] and not any(got[4])
    three = fingerprint.fingerprints(df.where("doc_id = 3")).select("fingerprint", fingerprint.passages(F.lit("blue hen sat.")).alias("p"))
    more = three.select(F.aggregate("p", F.col("fingerprint"), fingerprint.insert).alias("f"), "p")
    assert more.first()["f"] == got[1]
    assert more.select(F.aggregate("p", F.col("f"), fingerprint.delete).alias("f")).first()["f"] == got[3]


def test_fingerprints_against_plain_sums(spark):
    """Likeness is the cosine of signed sums, recomputed from passages; a very long text keeps its counters apart."""
    a, b = prose(random.Random(1), 4000), prose(random.Random(2), 3000)
    long = "".join(f"{k % 7}\n" for k in range(1_200_000))
    df = spark.createDataFrame([(1, a), (2, a[: len(a) // 2] + b), (3, b), (4, long), (5, long + long)], "doc_id long, text string")
    marks = fingerprint.fingerprints(df)
    got = {r["doc_id"]: r["fingerprint"] for r in marks.collect()}
    sums = {}
    for i, hs in df.select("doc_id", F.explode(fingerprint.passages(F.col("text"))).alias("p")).select("doc_id", F.array(*fingerprint.hashes(F.col("p")))).collect():
        exact, signed, n = sums.setdefault(i, ([0] * fingerprint.EXACT, np.zeros(120, np.int64), [0]))
        n[0] += 1
        for k in range(fingerprint.EXACT):
            exact[k] = (exact[k] + (hs[k // 2] >> 32 * (k % 2) & 0xFFFFFFFF)) % 2**32
        if i < 4:
            signed += np.array([1 if h >> bit & 1 else -1 for h in hs[-2:] for k in range(30) for bit in (k, k + 30)])
    for i, (exact, _, n) in sums.items():
        assert got[i][: 1 + fingerprint.EXACT] == [n[0], *exact]
    pair = marks.alias("x").join(marks.alias("y"), F.col("x.doc_id") < F.col("y.doc_id"))
    near = {(r[0], r[1]): r[2] for r in pair.select("x.doc_id", "y.doc_id", fingerprint.likeness(F.col("x.fingerprint"), F.col("y.fingerprint"))).collect()}
    for i, j in ((1, 2), (1, 3), (2, 3)):
        x, y = sums[i][1].astype(float), sums[j][1].astype(float)
        assert abs(near[i, j] - max(0.0, x @ y / math.sqrt((x @ x) * (y @ y)))) < 1e-9
    assert near[4, 5] > 0.999999  # the same shares of the same passages


def test_edits_and_next_documents(spark, texts):
    data = [*texts, (None, "null id here"), (7, "again"), (7, "again")]
    out = fingerprint.with_edits(frame(spark, data)).collect()
    assert len(out) == len(data)
    order = sorted({(i, t or "") for i, t in texts} | {(7, "again")}, reverse=True)
    got = {r["doc_id"]: r for r in out}
    for k, (i, t) in enumerate(order[:-1]):
        n = len(t) // 3
        edited = t[: len(t) - n] + order[k + 1][1][:n]
        assert got[i]["n_chars"] == len(t) and got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= got[i]["near_next"] <= 1 and 0 <= got[i]["near_edited"] <= 1
    far = [r for r in out if r["n_chars"] > 150 and 101 <= (r["doc_id"] or 0) < 160]
    assert sum(r["near_edited"] > r["near_next"] for r in far) > 0.8 * len(far)
    assert fingerprint.with_edits(frame(spark, data).limit(0)).count() == 0
