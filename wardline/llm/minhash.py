"""MinHash near-duplicate detection with sequential Bayesian verification.

1. One scan gives each document the hash of its word sequence, the size of its shingle
   set, ``bands`` band hashes and a separate verification signature.
2. Documents of one word sequence collapse to the smallest id.
3. Documents that share a band bucket are candidates. A bucket first compares all its members
   with its most central one (the one whose buckets are largest in sum); what these links leave
   in one bucket but in different components is compared further: in small buckets
   each pair, in larger ones pairs that pass an exact prefix filter on shingles.
4. A candidate's signatures are compared batch by batch; it is pruned once the posterior
   probability of the wanted similarity, given the matches so far, falls below ``miss``.
5. Survivors are verified on their full shingle sets; links are contracted to components.

No bucket is capped, and no bucket is collected into one task: its rows are dealt over cells, and a document with many
candidates is copied to each part of them. Shingles are counted by 64-bit hashes and word sequences are equal by a
128-bit digest; links are confirmed on the shingles themselves.

Edge cases: null and empty texts have an empty set and link with nothing; texts with fewer words
than a shingle have their whole sequence as one shingle; rows with a repeated id stand for one
node of the graph each time; a null id is returned unlinked; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardline.llm.common import Scratch, slices, text_or_empty
from wardline.llm.components import connected_components

CELLS = 64
PARTNERS = 256  # of one document in one task
SLICE = 512  # shingles signed at once, so that their values stay in a core's cache
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xC2B2AE3D27D4EB4F)


def words_of(text: bytes) -> list[bytes]:
    """Words of a text: ASCII letters lower-cased, split at ASCII white space."""
    return text.lower().split()


def shingle_set(words: list[bytes], size: int) -> set:
    if not words:
        return set()
    if len(words) < size:
        return {tuple(words)}
    return set(zip(*(words[i:] for i in range(size)), strict=False))


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _GOLD
    x = (x ^ (x >> np.uint64(29))) * _MIX
    return x ^ (x >> np.uint64(32))


class _WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > 200_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def shingle_hashes(words: list[bytes], size: int, known: dict) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a document."""
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    n = max(1, len(words) - size + 1)
    acc = np.full(n, min(size, len(words)), np.uint64)
    for i in range(min(size, len(words))):
        acc = _scramble(acc + h[i : i + n])
    return np.unique(acc)


def signatures(hashes: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """Minimum of each of the hash functions over a set; one 32-bit value for each."""
    low, mul = (hashes >> np.uint64(32)).astype(np.uint32), seeds | np.uint32(1)
    best = np.full(len(seeds), 0xFFFFFFFF, np.uint32)
    for i in range(0, len(low), SLICE):
        part = low[i : i + SLICE, None] ^ seeds[None, :]
        part *= mul[None, :]
        part ^= part >> np.uint32(15)
        part *= np.uint32(0x2C1B3C6D)
        np.minimum(best, part.min(axis=0), out=best)
    return best


@lru_cache
def prune_table(similarity: float, miss: float, batch: int, batches: int) -> tuple[int, ...]:
    """After each batch, the smallest number of matches that keeps a candidate alive.

    Signature values are bytes, so they match with probability s + (1 - s)/256. Under a uniform
    prior, P(match rate >= t | m of n match) = P(Binomial(n + 1, t) <= m).
    """
    t, least = similarity + (1 - similarity) / 256, []
    for k in range(1, batches + 1):
        n, below, m = k * batch + 1, 0.0, 0
        while True:
            below += math.comb(n, m) * t**m * (1 - t) ** (n - m)
            if below >= miss:
                break
            m += 1
        least.append(m)
    return tuple(least)


def _sign(shingle: int, bands: int, rows: int, checks: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        seeds = np.random.default_rng(seed).integers(0, 2**32, bands * rows + checks, dtype=np.uint32)
        known = _WordHash()
        for batch in slices(batches, 1):
            keys, sizes, banded, checked = [], [], [], []
            for text in batch.column(1).cast(pa.binary()).to_pylist():
                words = words_of(text)
                hashes = shingle_hashes(words, shingle, known)
                keys.append(hashlib.blake2b(b" ".join(words), digest_size=16).digest())
                sizes.append(len(hashes))
                if len(hashes):
                    values = signatures(hashes, seeds)
                    wide = values[: bands * rows].astype(np.uint64).reshape(bands, rows)
                    acc = np.arange(bands, dtype=np.uint64)
                    for r in range(rows):
                        acc = _scramble(acc + wide[:, r])
                    banded.append(acc.view(np.int64))
                    checked.append(values[bands * rows :].astype(np.uint8).tobytes())
                else:
                    banded.append(np.zeros(0, np.int64))
                    checked.append(b"")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), pa.array(banded, pa.list_(pa.int64())), pa.array(checked, pa.binary())],
                names=["doc_id", "key", "n_shingles", "bands", "checks"],
            )

    return run


def _bayes(similarity: float, miss: float, batch: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            left = np.frombuffer(b"".join(b.column(2).to_pylist()), np.uint8).reshape(b.num_rows, -1)
            right = np.frombuffer(b"".join(b.column(3).to_pylist()), np.uint8).reshape(b.num_rows, -1)
            alive, matches = np.arange(b.num_rows), np.zeros(b.num_rows, np.int32)
            for k, least in enumerate(prune_table(similarity, miss, batch, left.shape[1] // batch)):
                part = slice(k * batch, (k + 1) * batch)
                matches[alive] += (left[alive, part] == right[alive, part]).sum(axis=1, dtype=np.int32)
                alive = alive[matches[alive] >= least]
            rest = [i for i in range(b.num_columns) if i not in (2, 3)]
            yield pa.RecordBatch.from_arrays([b.column(i).take(pa.array(alive)) for i in rest], names=[b.schema.names[i] for i in rest])

    return run


def _verify(shingle: int, num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_text, last = None, set()
        for b in slices(batches, 2, 3):
            keep = []
            for i, (s, t) in enumerate(zip(b.column(2).cast(pa.binary()).to_pylist(), b.column(3).cast(pa.binary()).to_pylist(), strict=True)):
                if t != last_text:
                    last_text, last = t, shingle_set(words_of(t), shingle)
                own = shingle_set(words_of(s), shingle)
                both = len(own & last)
                if den * both >= num * (len(own) + len(last) - both):
                    keep.append(i)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(keep, pa.int64())), b.column(1).take(pa.array(keep, pa.int64()))], names=["a", "b"])

    return run


def _hash_sets(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _WordHash()
        for b in slices(batches, 1):
            sets = [shingle_hashes(words_of(t), shingle, known).view(np.int64) for t in b.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["id", "hashes"])

    return run


def near_duplicates(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle: int = 5,
    percent: int = 80,
    bands: int = 25,
    rows: int = 5,
    checks: int = 128,
    batch: int = 16,
    miss: float = 1e-6,
    small_bucket: int = 16,
    seed: int = 20,
) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id, kept), one for each input row.

    Linked: 100 * |intersection| >= percent * |union| of the shingle sets. ``small_bucket`` chooses between two exact
    ways to compare what a bucket has left open, and changes no result.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), text_or_empty(text_column).alias("text"))
    signed = scratch.save(texts.mapInArrow(_sign(shingle, bands, rows, checks, seed), "doc_id long, key binary, n_shingles long, bands array<long>, checks binary"))
    full = signed.where("n_shingles > 0 and doc_id is not null")
    # One id may stand for several texts; a node of the graph is then a text, and ids tie them below.
    first = full.groupBy("key").agg(F.min(F.struct("doc_id", "n_shingles", "bands", "checks")).alias("first"))
    marks = scratch.save(first.select(F.col("first.doc_id").alias("id"), "key", F.col("first.n_shingles").alias("n"), "first.bands", "first.checks"))
    classes = marks.select("key", F.col("id").alias("rep"), "n")

    # A bucket's rows are dealt over cells, so that a crowded one takes no single task.
    cell = F.pmod(F.xxhash64("id"), F.lit(CELLS)).cast("int")
    banded = marks.select("id", F.explode("bands").alias("bucket"), cell.alias("cell"))
    counts = banded.groupBy("bucket", "cell").agg(F.count("*").alias("n"))
    sized = counts.withColumn("size", F.sum("n").over(Window.partitionBy("bucket"))).where("size > 1")
    cells = scratch.save(sized.select("bucket", "cell", "size"))
    members = scratch.save(banded.join(cells, ["bucket", "cell"]))

    def beside(buckets: DataFrame, rows: DataFrame) -> DataFrame:
        """Members with the columns of their bucket."""
        return rows.join(cells.select("bucket", "cell").join(buckets, "bucket"), ["bucket", "cell"])

    central = members.groupBy("id").agg(F.sum("size").alias("weight"))
    pivots = members.join(central, "id").groupBy("bucket").agg(F.max(F.struct("weight", "id")).alias("top")).select("bucket", F.col("top.id").alias("pivot"))
    pivots = scratch.save(pivots)
    star = beside(pivots, members).where("id <> pivot").groupBy(F.col("id").alias("a"), F.col("pivot").alias("b")).agg(F.max("size").alias("crowd"))
    star = scratch.save(star)

    sign_a = marks.select(F.col("id").alias("a"), F.col("checks").alias("ca"), F.col("n").alias("na"))
    sign_b = marks.select(F.col("id").alias("b"), F.col("checks").alias("cb"), F.col("n").alias("nb"))
    reps_text = texts.join(marks.select(F.col("id").alias("doc_id")).distinct(), "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])

    def verified(pairs: DataFrame) -> DataFrame:
        """The linked ones of pairs (a, b, crowd). The side of b is copied to each part of its crowd of partners."""
        parts = F.greatest(F.lit(1), F.ceil(F.col("crowd") / PARTNERS)).cast("long")
        pairs = pairs.withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("a"), F.col("parts"))).drop("crowd")
        place = ["b", "parts", "part"]
        sized = pairs.join(sign_a, "a").join(pairs.select(place).distinct().join(sign_b, "b"), place).where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent)
        alive = scratch.save(sized.select("a", "b", "ca", "cb", "parts", "part").mapInArrow(_bayes(percent / 100, miss, batch), "a long, b long, parts long, part long"))
        wanted = reps_text.join(alive.select(F.col("a").alias("doc_id")).union(alive.select("b")).distinct(), "doc_id", "left_semi")
        left = wanted.select(F.col("doc_id").alias("a"), F.col("text").alias("ta"))
        right = wanted.select(F.col("doc_id").alias("b"), F.col("text").alias("tb"))
        ready = alive.join(left, "a").join(alive.select(place).distinct().join(right, "b"), place).select("a", "b", "ta", "tb")
        return scratch.save(ready.mapInArrow(_verify(shingle, percent, 100), "a long, b long"))

    links = verified(star)
    found = connected_components(links, scratch)

    # What the stars left open: buckets whose members are in several components.
    placed = members.join(found, "id", "left").select("id", "bucket", "cell", "size", F.coalesce("component", "id").alias("component"))
    open_buckets = placed.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("bucket")
    open_members = scratch.save(beside(open_buckets, placed))
    small = open_members.where(F.col("size") <= small_bucket)
    one = small.select("bucket", F.col("id").alias("a"), F.col("component").alias("pa"))
    two = small.select("bucket", F.col("id").alias("b"), F.col("component").alias("pb"))
    rest = one.join(two, "bucket").where("a < b and pa <> pb").select("a", "b")
    large = open_members.where(F.col("size") > small_bucket)
    if not large.isEmpty():
        heads = beside(pivots.withColumnRenamed("pivot", "head"), large)
        main = heads.where("id = head").select("bucket", F.col("component").alias("main"))
        loose = beside(main, large).where("component <> main").select("id").distinct()
        rest = rest.union(_prefix_pairs(large, loose, reps_text, shingle, percent, scratch))
    rest = scratch.save(rest.distinct())
    # of the pairs that remain, a document with many partners is the copied side's crowd
    crowds = rest.groupBy("b").agg(F.count("*").alias("crowd"))
    tried = star.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    more = verified(rest.join(tried, ["a", "b"], "left_anti").join(crowds, "b").select("a", "b", "crowd"))

    joined = found if more.isEmpty() else connected_components(links.union(more), scratch)
    by_key = full.select("doc_id", "key").join(classes.select("key", "rep"), "key").where("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    # Copies hang on their class; ids with several texts tie classes together, which is rare.
    repeated = full.select("doc_id", "key").distinct().groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select(F.col("doc_id").alias("a"))
    ties = by_key.join(repeated, "a", "left_semi")
    if not repeated.isEmpty():
        joined = connected_components(links.union(more).union(ties), scratch)
    of_class = classes.join(joined.withColumnRenamed("id", "rep"), "rep", "left").select("key", F.coalesce("component", "rep").alias("component"))
    out = signed.select("doc_id", "key", "n_shingles").join(of_class, "key", "left")
    component = F.when(F.col("n_shingles") > 0, F.coalesce("component", "doc_id")).otherwise(F.col("doc_id"))
    component = F.when(F.col("doc_id").isNull(), F.lit(None).cast("long")).otherwise(component)
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def _prefix_pairs(large: DataFrame, loose: DataFrame, texts: DataFrame, shingle: int, percent: int, scratch: Scratch) -> DataFrame:
    """Pairs of members of large buckets in different components that can still be linked.

    With shingles ordered from rare to frequent, two sets of similarity t share one of the first
    n - ceil(t n) + 1 shingles of each (the prefix), and at the first shared shingle the
    positions bound the similarity from above. Both tests are exact. One side of each pair is
    ``loose``: outside the component of its bucket's most central member.
    """
    ids = scratch.save(large.groupBy("id").agg(F.min("component").alias("component")))
    sets = texts.withColumnRenamed("doc_id", "id").join(ids.select("id"), "id", "left_semi").select("id", "text").mapInArrow(_hash_sets(shingle), "id long, hashes array<long>")
    sets = scratch.save(sets)
    flat = sets.select("id", F.size("hashes").alias("n"), F.explode("hashes").alias("h"))
    often = flat.groupBy("h").agg(F.count("*").alias("df"))
    ranked = flat.join(often.where("df > 1"), "h", "left").groupBy("id", "n").agg(F.sort_array(F.collect_list(F.struct(F.coalesce("df", F.lit(1)).alias("df"), "h"))).alias("ordered"))
    width = (F.col("n") - F.ceil(F.col("n") * percent / 100.0 - 1e-9) + 1).cast("int")
    prefix = ranked.select("id", "n", F.posexplode(F.slice("ordered", 1, width)).alias("pos", "entry")).where("entry.df > 1").select("id", "n", "pos", F.col("entry.h").alias("h"))
    prefix = scratch.save(prefix.join(ids, "id"))
    x = prefix.join(loose, "id", "left_semi").select("h", F.col("id").alias("x"), F.col("n").alias("nx"), F.col("pos").alias("px"), F.col("component").alias("cx"))
    y = prefix.select("h", F.col("id").alias("y"), F.col("n").alias("ny"), F.col("pos").alias("py"), F.col("component").alias("cy"))
    most = F.least(F.col("nx") - F.col("px"), F.col("ny") - F.col("py"))
    can = (F.col("cx") != F.col("cy")) & (most * 100 >= (F.col("nx") + F.col("ny") - most) * percent)
    pairs = x.join(y, (x.h == y.h) & can).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    return pairs.distinct()
