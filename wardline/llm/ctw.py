"""Context-tree weighting over bytes: code length of texts under a model of the training texts.

A byte is eight binary decisions, each with its own context tree over the ``depth`` bytes before it.
A node's Krichevsky-Trofimov estimate and the product of its children are mixed half and half, from the leaves up; the
posterior weights then mix the estimates of all depths along a context's path. Trees are built from all training
texts, with counts, and then held fixed for scoring.

1. Each partition sends its distinct grams (context and byte) with counts, in buckets of the context's last two bytes, so a
   bucket has whole subtrees. Buckets return what the two upper levels need: at most 256 * 255 rows, whatever the corpus.
2. Blocks of documents send their distinct grams to the buckets, where the trees give each gram its probability, and sum up.

Words go the same way for the unigram base. Byte 255, which UTF-8 never has, ends each text and stands before it.

Edge cases: null texts are empty (they score the end alone); with no training text every byte costs eight bits;
ids may repeat, and a null id has no CRC and is held out; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import input_bytes, text_or_empty

END = 255
HALF = math.log(0.5)
NODES = 256
CHUNK = 16 << 20


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function for x >= 0.5: Stirling's series after eight steps up."""
    low = np.ones_like(x)
    for k in range(8):
        low *= x + k
    z = x + 8
    return (z - 0.5) * np.log(z) - z + 0.5 * math.log(2 * math.pi) + 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5) - 1 / (1680 * z**7) - np.log(low)


def log_kt(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Krichevsky-Trofimov probability of a zeros and b ones, in nats."""
    return log_gamma(a + 0.5) + log_gamma(b + 0.5) - math.log(math.pi) - log_gamma(a + b + 1.0)


def grams_of(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The gram at each byte (and end) of the texts, and how many each text has."""
    pad = bytes([END]) * depth
    data = np.frombuffer(b"".join(x for t in texts for x in (pad, t, pad[:1])), np.uint8)
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    n = len(data) - depth
    grams = np.zeros(max(n, 0), np.int64)
    for k in range(depth + 1):
        grams <<= 8
        grams |= data[k : k + n]
    # the last ``depth`` grams before each later text reach over its padding
    keep = np.ones(n, bool)
    ends = np.cumsum(sizes + depth)[:-1]
    for k in range(1, depth + 1):
        keep[ends - k] = False
    return grams[keep], sizes


class Trees:
    """The subtrees of a bucket, from depth 2 down, over distinct grams with training counts."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray, depth: int):
        symbol, context = grams & 255, grams >> 8
        keys = np.empty((8, len(grams)), np.int64)
        self.bits = np.empty((8, len(grams)), bool)
        for k in range(8):
            keys[k] = context << 8 | 1 << k | symbol >> 8 - k
            self.bits[k] = symbol >> 7 - k & 1
        keys, self.leaf = np.unique(keys.ravel(), return_inverse=True)
        weight, ones = np.tile(counts, 8), self.bits.ravel()
        b = np.bincount(self.leaf, weights=weight * ones, minlength=len(keys))
        a = np.bincount(self.leaf, weights=weight, minlength=len(keys)) - b
        below, self.levels = None, []
        for d in range(depth, 1, -1):
            kt = log_kt(a, b)
            both = kt if below is None else np.logaddexp(HALF + kt, HALF + below)
            weight = np.ones(len(kt)) if below is None else np.exp(HALF + kt - both)
            parents = ((keys >> 8) & ((1 << 8 * (d - 1)) - 1)) << 8 | keys & 255
            parents, up = np.unique(parents, return_inverse=True)
            self.levels.append((up, weight, (b + 0.5) / (a + b + 1.0)))
            below = np.bincount(up, weights=both, minlength=len(parents))
            a = np.bincount(up, weights=a, minlength=len(parents))
            b = np.bincount(up, weights=b, minlength=len(parents))
            keys = parents
        #: at depth 1: keys (context byte and node), counts, and the children's logarithms
        self.top = keys, a, b, below

    def log10(self, chance: np.ndarray, left: np.ndarray) -> np.ndarray:
        """Log10 probability of each gram's byte; chance and left: the mixture down to depth 1, by key."""
        chance, left = chance[self.top[0]], left[self.top[0]]
        for up, weight, one in reversed(self.levels):
            chance, left = chance[up] + left[up] * weight * one, left[up] * (1 - weight)
        chance = chance[self.leaf].reshape(8, -1)
        return np.log10(np.where(self.bits, chance, 1 - chance)).sum(axis=0)


def upper_levels(rows: list[tuple[int, float, float, float]]) -> tuple[np.ndarray, np.ndarray]:
    """Chance of a one by the estimates of depths 0 and 1, and the weight left for deeper ones, by key."""
    a, b, below = (np.zeros(NODES * NODES) for _ in range(3))
    for key, x, y, z in rows:
        a[key], b[key], below[key] = x, y, z
    kt = log_kt(a, b)
    both = np.logaddexp(HALF + kt, HALF + below)
    node = np.arange(NODES * NODES) & 255
    a0, b0, below0 = (np.bincount(node, weights=x, minlength=NODES) for x in (a, b, both))
    kt0 = log_kt(a0, b0)
    w0 = np.exp(HALF + kt0 - np.logaddexp(HALF + kt0, HALF + below0))
    w1 = np.exp(HALF + kt - both)
    chance = (w0 * (b0 + 0.5) / (a0 + b0 + 1.0))[node] + (1 - w0)[node] * w1 * (b + 0.5) / (a + b + 1.0)
    return chance, (1 - w0)[node] * (1 - w1)


SENT = pa.schema([("kind", pa.string()), ("block", pa.int32()), ("bucket", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])
_SENT = "kind string, block int, bucket int, keys binary, counts binary"


def _planes(x: np.ndarray) -> bytes:
    return x.astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _from_planes(blob: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(blob, np.uint8).reshape(8, -1).T).view("<i8").ravel()


def _bucket_of(grams: np.ndarray, count: int) -> np.ndarray:
    two = (grams >> 8 & 0xFFFF).astype(np.uint64)
    two = (two * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
    return (two % np.uint64(count)).astype(np.int64)


class Gathered:
    """Distinct grams and words of some texts, with counts over the training texts among them."""

    def __init__(self, depth: int):
        self.depth, self.words, self.parts = depth, Counter(), []
        self.held: Counter = Counter()

    def add(self, texts: list[bytes], training: list[bool]) -> None:
        for learn in (True, False):
            some = [t for t, x in zip(texts, training, strict=True) if bool(x) == learn]
            lo = 0
            while lo < len(some):
                hi, size = lo, 0
                while hi < len(some) and (hi == lo or size + len(some[hi]) <= CHUNK // 4):
                    size += len(some[hi])
                    hi += 1
                keys, counts = np.unique(grams_of(some[lo:hi], self.depth)[0], return_counts=True)
                self.parts.append((keys, counts * learn))
                lo = hi
            into = self.words if learn else self.held
            for t in some:
                into.update(t.lower().split())
            if some:
                into[b""] += len(some)
        if len(self.parts) > 8:
            self.grams()

    def grams(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        keys, inverse = np.unique(np.concatenate([k for k, _ in self.parts]), return_inverse=True)
        counts = np.bincount(inverse, weights=np.concatenate([c for _, c in self.parts]), minlength=len(keys)).astype(np.int64)
        self.parts = [(keys, counts)]
        return keys, counts

    def by_bucket(self, count: int) -> dict[tuple[str, int], tuple]:
        """Sorted grams, and sorted words, of each bucket, with their counts."""
        import zlib

        out: dict[tuple[str, int], tuple] = {}
        keys, counts = self.grams()
        buckets = _bucket_of(keys, count)
        order = np.argsort(buckets, kind="stable")
        cut = np.searchsorted(buckets[order], np.arange(count + 1))
        for k in range(count):
            if cut[k] < cut[k + 1]:
                p = order[cut[k] : cut[k + 1]]
                out["gram", k] = keys[p], counts[p]
        lists: dict[int, list[bytes]] = {}
        for w in sorted(self.words.keys() | self.held.keys()):
            lists.setdefault(zlib.crc32(w) % count, []).append(w)
        for k, ws in lists.items():
            out["word", k] = ws, np.array([self.words[w] for w in ws], np.int64)
        return out

    def rows(self, block: int, count: int) -> pa.Table:
        rows = [(kind, block, k, _planes(keys) if kind == "gram" else b" ".join(keys), _planes(c)) for (kind, k), (keys, c) in self.by_bucket(count).items()]
        return pa.Table.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(SENT)], schema=SENT)


def _merged(table: pa.Table) -> tuple[str, list, np.ndarray, np.ndarray, list[int]]:
    """Kind, distinct keys and counts of a bucket; the place of each row's keys; and how many keys each row has."""
    kind, sizes = table.column("kind")[0].as_py(), []
    counts = [_from_planes(c) for c in table.column("counts").to_pylist()]
    sizes = [len(c) for c in counts]
    if kind == "gram":
        keys, inverse = np.unique(np.concatenate([_from_planes(k) for k in table.column("keys").to_pylist()]), return_inverse=True)
    else:
        known: dict[bytes, int] = {}
        inverse = np.array([known.setdefault(w, len(known)) for k in table.column("keys").to_pylist() for w in k.split(b" ")], np.int64)
        keys = list(known)
    return kind, keys, np.bincount(inverse, weights=np.concatenate(counts), minlength=len(keys)), inverse, sizes


def _learn(depth: int, count: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got, size = Gathered(depth), 0
        for batch in batches:
            texts = batch.column(0).cast(pa.binary()).to_pylist()
            got.add(texts, [True] * len(texts))
            size += sum(map(len, texts))
            if size > 4 * CHUNK:
                yield from got.rows(0, count).to_batches()
                got, size = Gathered(depth), 0
        yield from got.rows(0, count).to_batches()

    return run


def _summary(depth: int):
    def run(table: pa.Table) -> pa.Table:
        kind, keys, counts, _, _ = _merged(table)
        if kind == "gram":
            key, a, b, below = Trees(keys, counts, depth).top
            cols = [np.array(x) for x in (key, a, b, below)]
        else:
            cols = [np.array([-1]), np.array([counts.sum()]), np.array([float((counts > 0).sum())]), np.array([0.0])]
        return pa.Table.from_arrays([pa.array(cols[0], pa.int64()), *(pa.array(c, pa.float64()) for c in cols[1:])], names=["key", "a", "b", "below"])

    return run


def _send(depth: int, count: int):
    def run(table: pa.Table) -> pa.Table:
        got = Gathered(depth)
        got.add(table.column("text").cast(pa.binary()).to_pylist(), table.column("training").to_pylist())
        return got.rows(table.column("block")[0].as_py(), count)

    return run


ANSWER = pa.schema([("kind", pa.string()), ("block", pa.int32()), ("keys", pa.binary()), ("values", pa.binary())])


def _answer(depth: int, chance: np.ndarray, left: np.ndarray):
    def run(table: pa.Table) -> pa.Table:
        kind, keys, counts, inverse, sizes = _merged(table)
        values = (Trees(keys, counts, depth).log10(chance, left) if kind == "gram" else counts)[inverse]
        cut = np.split(values.astype("<f8"), np.cumsum(sizes)[:-1])
        return pa.Table.from_arrays([table.column("kind").combine_chunks(), table.column("block").combine_chunks(), table.column("keys").combine_chunks(), pa.array([c.tobytes() for c in cut], pa.binary())], schema=ANSWER)

    return run


SCORES = pa.schema(
    [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64())]
    + [("base_score", pa.float64()), ("score", pa.float64()), ("bits_per_byte", pa.float64())]
)


def _score(depth: int, tokens: int, vocabulary: int):
    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        import pandas as pd

        cols: list[list] = [[] for _ in SCORES]
        if table.num_rows:
            texts, training = table.column("text").cast(pa.binary()).to_pylist(), table.column("training").to_pylist()
            log10 = math.log10(tokens + vocabulary + 1)
            worth, keys, values = {}, [], []
            for kind, blob, got in zip(*(answers.column(c).to_pylist() for c in ("kind", "keys", "values")), strict=True):
                if kind == "gram":
                    keys.append(_from_planes(blob))
                    values.append(np.frombuffer(got, "<f8"))
                else:
                    worth.update(zip(blob.split(b" "), (np.log10(np.frombuffer(got, "<f8") + 1) - log10).tolist(), strict=True))
            index, values = pd.Index(np.concatenate(keys)), np.concatenate(values)
            lo = 0
            while lo < len(texts):
                hi, size = lo, 0
                while hi < len(texts) and (hi == lo or size + len(texts[hi]) <= CHUNK // 4):
                    size += len(texts[hi])
                    hi += 1
                grams, sizes = grams_of(texts[lo:hi], depth)
                scores = np.add.reduceat(values[index.get_indexer(grams)], np.cumsum(sizes) - sizes)
                for i, learn, text, s in zip(table.column("doc_id")[lo:hi].to_pylist(), training[lo:hi], texts[lo:hi], scores.tolist(), strict=True):
                    words = text.lower().split()
                    words.append(b"")
                    each = list(map(worth.__getitem__, words))
                    row = (i, not learn, len(words), len(each) - each.count(-log10), tokens, math.fsum(each), s, -s * math.log2(10) / (len(text) + 1))
                    for c, v in zip(cols, row, strict=True):
                        c.append(v)
                lo = hi
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(cols, SCORES, strict=True)], schema=SCORES)

    return run


def code_lengths(docs: DataFrame, training: Column, *, id_column: str = "doc_id", text_column: str = "text", depth: int = 5, block_bytes: int = 16 << 20) -> DataFrame:
    """Rows (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte), one for each input row.

    training: which rows the model learns from. Scores are log10 probabilities of whole texts and their ends.
    """
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), text_or_empty(text_column).alias("text"), F.coalesce(training, F.lit(False)).alias("training"))
    blocks = max(1, math.ceil(input_bytes(texts) / block_bytes))
    count = max(64, 2 * blocks)
    learned = texts.where("training").select("text").mapInArrow(_learn(depth, count), _SENT)
    top = learned.groupBy("kind", "bucket").applyInArrow(_summary(depth), "key long, a double, b double, below double")
    # at most 256 contexts of one byte with 255 nodes each, and one row of word counts
    rows = [tuple(r) for r in top.groupBy("key").agg(F.sum("a"), F.sum("b"), F.sum("below")).collect()]
    tokens, vocabulary = next(((int(a), int(b)) for key, a, b, _ in rows if key < 0), (0, 0))
    chance, left = upper_levels([r for r in rows if r[0] >= 0])
    blocked = texts.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int"))
    sent = blocked.groupBy("block").applyInArrow(_send(depth, count), _SENT)
    answers = sent.groupBy("kind", "bucket").applyInArrow(_answer(depth, chance, left), "kind string, block int, keys binary, values binary")
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double"
    return blocked.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_score(depth, tokens, vocabulary), schema)
