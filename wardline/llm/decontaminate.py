"""Benchmark decontamination by latent semantic retrieval.

1. Frequencies of hashed words, over all documents, give TF-IDF weights.
2. A randomised SVD (range finder with one power iteration) of the TF-IDF matrix of passages gives a
   latent space. Passages are those of all documents and all benchmark items, whose hashed words are written once; each
   pass over them sums a matrix of fixed size (hashed words by dimensions).
3. Windows of all documents, two blocks of words each, are projected and compared by cosine with the windows of
   all items; whitening by the singular values keeps frequent words from drowning the rest.
4. Runs of three words of any item, and of two words of items that mostly have words without weight, propose candidates
   too, so a copy is found whatever its words weigh. Of a copy that drops or replaces words but inserts none, the
   needed share always leaves such a run, save for items of eight words (three-word runs). Items under ``least_words``
   words have no paraphrases: they are found where all their words stand in a row.
5. A candidate is verified on its words: the longest common subsequence of the item and the region around the
   window, as a share of the item, and how much of the item's answer (its last sentence) is there.

Items lie in a table by blocks of bounded size and are read block by block: neither the driver nor a task holds more
of the benchmark than one. Long texts are searched in overlapping parts.

Edge cases: null and empty texts match nothing; items under ``least_exact`` words are no passages and are skipped; equal ids are
each matched; a null id is returned as null; an empty benchmark or table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import Scratch, slices, text_or_empty

FEATURES = 1 << 13
BLOCK = 12  # words; a window is two blocks
FREQUENT = 1e-3  # words with a larger share of all words weigh less and less
PART = 4_000 * BLOCK  # words of a text searched at a time
SLICES = 16
TASKS = 128  # at most, of a pass over the passages
PUNCTUATION = b"\"'.,;:!?()[]{}<>|*&%$#@~`^_-+=/\\"


class _Feature(dict):
    """Hashed feature of a word, without case and surrounding punctuation."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        value = self[word] = zlib.crc32(plain(word)) % FEATURES
        return value


def plain(word: bytes) -> bytes:
    return word.strip(PUNCTUATION) or word


#: The CRC-32 of bytes is that of as many zeros, changed by each byte as its distance from the end says.
NEAR = 32
ZEROS = np.array([zlib.crc32(bytes(n)) for n in range(NEAR + 1)], np.uint32)
CHANGES = np.array([[zlib.crc32(bytes([b]) + bytes(n)) ^ zlib.crc32(bytes(n + 1)) for b in range(256)] for n in range(NEAR)], np.uint32)
#: 0 for white space, 1 for punctuation, 2 for all other bytes
KINDS = bytes(0 if bytes([b]).isspace() else 1 if b in PUNCTUATION else 2 for b in range(256))


class Words:
    """The words of texts, without case and surrounding punctuation: where they lie in one buffer, and their hashed features, without an object for each."""

    def __init__(self, column: pa.Array):
        texts = pc.fill_null(column.cast(pa.binary()), b"")
        _, offsets, data = texts.buffers()
        ends = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64) if len(texts) else np.zeros(1, np.int64)
        self.text = (data[int(ends[0]) : int(ends[-1])].to_pybytes() if data else b"").lower()
        ends -= ends[0]
        kind = np.frombuffer(self.text.translate(KINDS), np.uint8)
        solid = kind > 0
        first, last = solid.copy(), solid.copy()
        first[1:] &= ~solid[:-1]
        last[:-1] &= ~solid[1:]
        cuts = ends[(ends > 0) & (ends < len(solid))]  # words end with their text
        first[cuts], last[cuts - 1] = solid[cuts], solid[cuts - 1]
        self.begin, self.end = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.sizes = np.diff(np.searchsorted(self.begin, ends))
        rim = np.flatnonzero((kind[self.begin] == 1) | (kind[self.end - 1] == 1))
        if len(rim):
            inner = np.flatnonzero(kind == 2)
            lo, hi = np.searchsorted(inner, self.begin[rim]), np.searchsorted(inner, self.end[rim])
            some = lo < hi  # a word of punctuation alone stays
            self.begin[rim[some]], self.end[rim[some]] = inner[lo[some]], inner[hi[some] - 1] + 1
        self.features = self._features()

    def _features(self) -> np.ndarray:
        size = np.minimum(self.end - self.begin, NEAR + 1).astype(np.uint8)
        order = np.argsort(size, kind="stable")
        bounds = np.searchsorted(size[order], np.arange(NEAR + 2))  # the first word of each size
        near, final, data = bounds[NEAR + 1], self.end[order] - 1, np.frombuffer(self.text, np.uint8)
        sums = ZEROS[np.minimum(size[order], NEAR)]
        for n in range(NEAR):
            lo = bounds[n + 1]
            sums[lo:near] ^= CHANGES[n][data[final[lo:near] - n]]
        for k in range(near, len(order)):
            sums[k] = zlib.crc32(self.text[self.begin[order[k]] : self.end[order[k]]])
        out = np.empty(len(order), np.int32)
        out[order] = sums % FEATURES
        return out

    def plain(self, lo: int, hi: int) -> list[bytes]:
        return [self.text[b:e] for b, e in zip(self.begin[lo:hi].tolist(), self.end[lo:hi].tolist(), strict=True)]

    def parts(self, step: int, overlap: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, first word and number of words of each part: a text of more than PART words is cut every ``step`` of them, and its parts overlap."""
        firsts = np.cumsum(self.sizes) - self.sizes
        cuts = [c for t, n in enumerate(self.sizes.tolist()) for c in ([(t, i, min(step + overlap, n - i)) for i in range(0, max(1, n - overlap), step)] if n > PART else [(t, 0, n)])]
        of, inside, sizes = np.array(cuts, np.int64).reshape(-1, 3).T
        return of, firsts[of] + inside, sizes


def _chunks(sizes: np.ndarray, words: int = 50_000) -> Iterator[tuple[int, int]]:
    lo, size = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if size and size + n > words:
            yield lo, i
            lo, size = i, 0
        size += n
    if lo < len(sizes):
        yield lo, len(sizes)


def _blocks(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word and document of each block, and how many blocks each document has."""
    count = -(-sizes // BLOCK)
    doc = np.repeat(np.arange(len(sizes)), count)
    inside = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    return (np.cumsum(sizes) - sizes)[doc] + inside * BLOCK, doc, count


def _sum_rows(rows: np.ndarray, ids: np.ndarray, most: int = 1_000) -> np.ndarray:
    """Sum of the rows of each column of ids, row of ids by row of ids; so few at a time that they stay in the cache."""
    out, each = np.empty((ids.shape[1], rows.shape[1]), rows.dtype), np.empty((most, rows.shape[1]), rows.dtype)
    for lo in range(0, len(out), most):
        part = out[lo : lo + most]
        np.take(rows, ids[0, lo : lo + most], axis=0, out=part, mode="clip")
        for k in range(1, len(ids)):
            part += np.take(rows, ids[k, lo : lo + most], axis=0, out=each[: len(part)], mode="clip")
    return out


def padded_sums(rows: np.ndarray, flat: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Sum of the rows of each block's features, place by place; the last row stands for no word."""
    places = start + np.arange(BLOCK)[:, None]
    return _sum_rows(rows, np.where(places < np.r_[start[1:], len(flat)], flat[np.minimum(places, len(flat) - 1)], len(rows) - 1))


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hashed words of each text, two bytes each, and how many there are."""
    for b in slices(batches, 0):
        words = Words(b.column(0))
        ends = np.r_[0, np.cumsum(words.sizes)]
        hashed = pa.Array.from_buffers(pa.binary(), len(words.sizes), [None, pa.py_buffer((ends * 2).astype(np.int32)), pa.py_buffer(words.features.astype("<u2"))])
        yield pa.RecordBatch.from_arrays([hashed, pa.array(words.sizes)], names=["features", "n"])


def _hashed(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Hashed words of all texts of a batch of ``_word_counts``, and the words of each text."""
    _, offsets, data = b.column(0).buffers()
    ends = np.frombuffer(offsets, np.int32)[b.column(0).offset : b.column(0).offset + len(b) + 1] // 2
    return np.frombuffer(data, "<u2")[ends[0] : ends[-1]] if data else np.zeros(0, np.uint16), np.diff(ends).astype(np.int64)


def _feature_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(FEATURES, np.int64)
    for b in batches:
        counts += np.bincount(_hashed(b)[0], minlength=FEATURES)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(FEATURES)), pa.array(counts)], names=["feature", "n"])


def sums_by(keys: np.ndarray, rows: np.ndarray, ids: np.ndarray, n: int, width: int = 8) -> np.ndarray:
    """Sum of ``rows[ids]`` for each key below n, ``width`` rows at a time; the last row of ``rows`` is zero."""
    order = np.argsort(keys.astype(np.uint16) if n <= 1 << 16 else keys, kind="stable")
    ids, count = ids[order], np.bincount(keys, minlength=n)
    while True:
        groups = -(-count // width)
        key = np.repeat(np.arange(n), groups)
        at = (np.cumsum(count) - count)[key] + (np.arange(len(key)) - (np.cumsum(groups) - groups)[key]) * width + np.arange(width)[:, None]
        sums = _sum_rows(rows, np.where(at < np.cumsum(count)[key], ids[np.minimum(at, len(ids) - 1)], len(rows) - 1))
        if len(key) == (groups > 0).sum():
            break
        rows, ids, count = np.vstack([sums, np.zeros((1, rows.shape[1]), rows.dtype)]), np.arange(len(key)), groups
    out = np.zeros((n, rows.shape[1]), rows.dtype)
    out[key] = sums
    return out


def _gram_product(idf: np.ndarray, basis: np.ndarray, most: int = 16_000):
    """Partial sums of A^T A B over the passages of a partition, ``most`` at a time, in slices of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(basis.shape, np.float64)
        weighted = np.vstack([basis * idf[:, None], np.zeros((1, basis.shape[1]))]).astype(np.float32)
        square = idf**2
        for b in slices(batches, 0):
            flat, sizes = _hashed(b)
            start = _blocks(sizes)[0]
            for lo in range(0, len(start), most):
                first = start[lo : lo + most]
                words = flat[first[0] : start[lo + most] if lo + most < len(start) else len(flat)]
                first = first - first[0]
                norm = np.sqrt(np.add.reduceat(square[words], first)) + 1e-6
                each = padded_sums(weighted, words, first) / (norm[:, None] ** 2).astype(np.float32)
                each = np.vstack([each, np.zeros((1, each.shape[1]), np.float32)])
                out += sums_by(words, each, np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(words)])), FEATURES) * idf[:, None]
        parts = np.split(out.astype(np.float32), SLICES)
        yield pa.RecordBatch.from_arrays([pa.array(range(SLICES), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())], names=["slice", "sums"])

    return run


def _add_slices(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(s, np.float32).astype(np.float64) for s in table.column("sums").to_pylist())
    return pa.table({"slice": pa.array([table.column("slice")[0].as_py()], pa.int32()), "sums": pa.array([total.astype(np.float32).tobytes()], pa.binary())})


@dataclass
class Space:
    """The latent space: a row of ``projection`` for each feature, TF-IDF weight and whitening within.

    Words of more than ``FREQUENT`` of all have little weight, and ``rare`` is false there.
    """

    projection: np.ndarray
    rare: np.ndarray

    def __post_init__(self) -> None:
        self.rows = np.vstack([self.projection, np.zeros((1, self.projection.shape[1]))]).astype(np.float32)

    def block_sums(self, flat: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Sum of the projections of each block of words; start: the first word of each."""
        return padded_sums(self.rows, flat, start)


def fit_space(texts: DataFrame, items: DataFrame, *, dimensions: int = 128, extra: int = 16, seed: int = 7) -> Space:
    """Word frequencies over ``texts`` (text); randomised SVD over the passages of all ``texts`` and ``items`` (text)."""
    counts, scratch = np.zeros(FEATURES), Scratch(texts.sparkSession)
    hashed = [scratch.save(t.select("text").mapInArrow(_word_counts, "features binary, n long")) for t in (texts, items)]
    rows = hashed[0].select("features").mapInArrow(_feature_counts, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    for r in rows.collect():  # a row for each feature
        counts[r["feature"]] = r["n"]
    total = counts.sum()
    # squared: what sets a passage apart are its rare words
    share = np.maximum(counts, 1) / max(total, 1)
    idf = np.log((1 + total) / (1 + counts)) ** 2 * np.minimum(1, FREQUENT / share) ** 2 + 1e-9
    # a matrix for each task is shuffled, so their number is bounded
    passages = hashed[0].union(hashed[1]).where("n > 0").select("features").coalesce(TASKS)

    def product(basis: np.ndarray) -> np.ndarray:
        parts = passages.mapInArrow(_gram_product(idf, basis), "slice int, sums binary").groupBy("slice").applyInArrow(_add_slices, "slice int, sums binary")
        got = {r["slice"]: np.frombuffer(r["sums"], np.float32) for r in parts.collect()}  # FEATURES x dimensions numbers
        if not got:
            return np.zeros_like(basis)
        return np.concatenate([got[i] for i in range(SLICES)]).reshape(basis.shape).astype(np.float64)

    basis = np.random.default_rng(seed).standard_normal((FEATURES, dimensions + extra))
    basis, _ = np.linalg.qr(product(basis))
    image = product(basis)  # A^T A Q
    scratch.drop(*hashed)
    values, vectors = np.linalg.eigh((basis.T @ image + image.T @ basis) / 2)
    top = np.argsort(values)[::-1][:dimensions]
    sigma = np.sqrt(np.maximum(values[top], 1e-9 * max(values.max(), 1e-12)))
    return Space((basis @ vectors[:, top] / sigma * idf[:, None]).astype(np.float32), share <= FREQUENT)


def common_subsequence(item: dict[bytes, int], length: int, words: list[bytes]) -> int:
    """Length of the longest common subsequence; item: a bit mask of places for each word."""
    full = (1 << length) - 1
    v = full
    for w in words:
        u = v & item.get(w, 0)
        if u:
            v = ((v + u) | (v - u)) & full
    return length - v.bit_count()


@dataclass
class Item:
    item_id: object
    words: list[bytes]
    answer: Counter
    masks: dict[bytes, int] = field(default_factory=dict)
    features: frozenset[int] = frozenset()
    #: distinct features in order, and how often each is there
    kinds: tuple[np.ndarray, np.ndarray] | None = None

    def __post_init__(self):
        for i, w in enumerate(self.words):
            self.masks[w] = self.masks.get(w, 0) | 1 << i
        self.counted = Counter(self.words)


def read_items(rows: list, least: int) -> list[Item]:
    items = []
    for item_id, text in rows:
        words = [plain(w) for w in (text or "").encode().lower().split()]
        if words and len(words) >= least:
            last = [s for s in re.split(r"(?<=[.!?:])\s+|\n+", text.strip()) if s.strip()][-1]
            items.append(Item(item_id, words, Counter(plain(w) for w in last.encode().lower().split())))
    return items


def _keys(flat: np.ndarray, n: int) -> np.ndarray:
    """A number for each run of n features."""
    size = max(0, len(flat) - n + 1)
    key = flat[:size].astype(np.int64)
    for k in range(1, n):
        key = key * FEATURES + flat[k : k + size]
    return key


class Runs:
    """Runs of ``n`` words of items, found again in texts by equality."""

    SLOTS = 20

    def __init__(self, n: int, features: dict[int, np.ndarray]):
        self.n = n
        owner = [(i, s) for i, f in features.items() for s in range(len(f) - n + 1)]
        keys = np.concatenate([np.zeros(0, np.int64), *(_keys(f, n) for f in features.values())])
        order = np.argsort(keys, kind="stable")
        self.owner = np.array(owner, np.int64).reshape(-1, 2)[order]
        self.keys, self.first, self.count = np.unique(keys[order], return_index=True, return_counts=True)
        self.some = np.zeros(1 << self.SLOTS, bool)
        self.some[self._slots(self.keys)] = True

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.SLOTS)

    def hits(self, flat: np.ndarray, doc: np.ndarray, most: int = 200_000) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Word of the text, item and word of the item, for each common run within one document, about ``most`` at a time."""
        if not len(self.keys):
            return
        keys = _keys(flat, self.n)
        at = np.flatnonzero(self.some[self._slots(keys)])
        at = at[doc[at] == doc[at + self.n - 1]]
        k = np.minimum(np.searchsorted(self.keys, keys[at]), len(self.keys) - 1)
        same = self.keys[k] == keys[at]
        at, k = at[same], k[same]
        part = np.cumsum(self.count[k]) // most
        for cut in np.split(np.arange(len(at)), np.flatnonzero(np.diff(part)) + 1):
            if len(cut):
                count = self.count[k[cut]]
                own = self.owner[_ranges(self.first[k[cut]], count)]
                yield at[cut].repeat(count), own[:, 0], own[:, 1]


def _ranges(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers from each first on, as many as counted."""
    return np.arange(count.sum()) + (first - (np.cumsum(count) - count)).repeat(count)


class Finder:
    """Finds items in texts; made in each task from small parts."""

    def __init__(self, space: Space, items: list[Item], terms: Terms):
        short, items = [i for i in items if len(i.words) < terms.least_words], [i for i in items if len(i.words) >= terms.least_words]
        self.space, self.items, self.share, self.sure = space, items, terms.share, terms.sure
        cosine = terms.cosine
        self.known = _Feature()
        #: items too short for paraphrases, by their number of words
        self.short: dict[int, dict[tuple[bytes, ...], list[Item]]] = {}
        for item in short:
            self.short.setdefault(len(item.words), {}).setdefault(tuple(item.words), []).append(item)
        self.reach = -(-max((2 * len(i.words) + 6 * BLOCK for i in items), default=BLOCK) // BLOCK) * BLOCK
        vectors, self.owner, own = [], [], {}
        for i, item in enumerate(items):
            features = own[i] = np.array([self.known[w] for w in item.words])
            item.kinds = np.unique(features, return_counts=True)
            item.features = frozenset(item.kinds[0].tolist())
            last = max(0, len(features) - 2 * BLOCK)
            count = max(1, math.ceil(last / BLOCK))
            for s in sorted({round(last * (k + 0.5) / count) if count == 1 else round(last * k / (count - 1)) for k in range(count)}):
                vectors.append(space.projection[features[s : s + 2 * BLOCK]].sum(axis=0))
                self.owner.append((i, s))
        words = np.array([len(items[i].words) for i, _ in self.owner])
        # an item shorter than a window shares it with other words
        self.least = (cosine * np.minimum(1, words / (2 * BLOCK)) ** 0.75).astype(np.float32)
        self.half = np.minimum(words, 2 * BLOCK) * 0.6
        self.item_of = np.array([i for i, _ in self.owner], np.int64)
        self.runs = [Runs(3, own), Runs(2, {i: f for i, f in own.items() if space.rare[f].mean() < 0.5})]
        self.words = np.array([len(item.words) for item in items], np.int64)
        self.member = np.zeros((len(items), FEATURES), bool)
        for i, item in enumerate(items):
            self.member[i, list(item.features)] = True
        self.queries = _unit(np.array(vectors, np.float32).reshape(len(vectors), space.projection.shape[1])).T.copy()

    def matches(self, texts: pa.Array) -> list[list[tuple]]:
        """For each text: (item id, cosine, common words in order, item words, share of the answer)."""
        found: list[dict[int, tuple]] = [{} for _ in range(len(texts))]
        out: list[list[tuple]] = [[] for _ in range(len(texts))]
        words = Words(texts)
        ends = np.cumsum(words.sizes).tolist()
        for text, lo, hi in zip(out, [0, *ends], ends, strict=False) if self.short else ():
            text += self._short_items(words.plain(lo, hi))
        # a text longer than PART goes in parts that overlap by more than any item's surroundings
        of, from_word, counts = words.parts(max(BLOCK, PART - self.reach), self.reach)
        for lo, hi in _chunks(counts) if self.items else ():
            flat, sizes, base = words.features[_ranges(from_word[lo:hi], counts[lo:hi])], counts[lo:hi], from_word[lo:hi].tolist()
            if not len(flat):
                continue
            start, doc, count = _blocks(sizes)
            sums = self.space.block_sums(flat, start)
            pair = np.flatnonzero(doc[1:] == doc[:-1])
            window = np.concatenate([sums[pair] + sums[pair + 1], sums[(count == 1)[doc]]])
            at = np.concatenate([pair, np.flatnonzero((count == 1)[doc])])
            cosines = _unit(window) @ self.queries
            begin = start - (np.cumsum(sizes) - sizes)[doc]
            best: dict[tuple[int, int], tuple] = {}
            first = np.cumsum(sizes) - sizes
            rows, queries = np.divmod(np.flatnonzero(cosines >= self.least), len(self.least))
            places = start[at[rows]][:, None] + np.arange(2 * BLOCK)
            inside = places < (first + sizes)[doc[at[rows]]][:, None]
            shared = (self.member[self.item_of[queries][:, None], flat[np.minimum(places, len(flat) - 1)]] & inside).sum(axis=1)
            some = shared >= self.share * self.half[queries]
            for r, q in zip(rows[some].tolist(), queries[some].tolist(), strict=True):
                d, place = int(doc[at[r]]), int(begin[at[r]])
                i, s = self.owner[q]
                item = self.items[i]
                left, right = self._region(item, s, place)
                right = min(right, int(sizes[d]))
                region = flat[first[d] + left : first[d] + right]
                if len(set(region.tolist()) & item.features) < self.share * len(item.features) or not self._enough(item, region):
                    continue
                if checked := self._verify(item, words.plain(base[d] + left, base[d] + right)):
                    hit = (checked[0], float(cosines[r, q]), checked[1])
                    if hit > best.get((d, i), ()):
                        best[d, i] = hit
            row = np.zeros(len(start), np.int64)
            row[at] = np.arange(len(at))
            last = np.r_[doc[1:] != doc[:-1], True] & (count > 1)[doc]
            row[last] = row[np.flatnonzero(last) - 1]
            for d, i, s, place in self._common_runs(flat, sizes, first):
                if (d, i) not in best:
                    left, right = self._region(self.items[i], s, place)
                    right = min(right, int(sizes[d]))
                    if not self._enough(self.items[i], flat[first[d] + left : first[d] + right]):
                        continue
                    if checked := self._verify(self.items[i], words.plain(base[d] + left, base[d] + right)):
                        block = np.searchsorted(start, first[d] + place, "right") - 1
                        best[d, i] = (checked[0], float(cosines[row[block], self.item_of == i].max()), checked[1])
            for (d, i), hit in best.items():
                mine = found[int(of[lo + d])]
                mine[i] = max(hit, mine.get(i, ()))
        for text, mine in zip(out, found, strict=True):
            text += [(self.items[i].item_id, cosine, lcs, len(self.items[i].words), answer) for i, (lcs, cosine, answer) in mine.items()]
        return out

    def _short_items(self, bare: list[bytes]) -> list[tuple]:
        """Short items whose words stand in the text one after the other."""
        got = {}
        for n, known in self.short.items():
            for run in zip(*(bare[k:] for k in range(n)), strict=False):
                if run in known:
                    got[run] = known[run]
        return [(item.item_id, 1.0, len(run), len(run), 1.0) for run, items in got.items() for item in items]

    def _common_runs(self, flat: np.ndarray, sizes: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """Document, item, word of the item and word of the document, where they share a run and enough words around it."""
        doc = np.repeat(np.arange(len(sizes)), sizes)
        for runs in self.runs:
            for word, i, s in runs.hits(flat, doc):
                d = doc[word]
                place = word - first[d]
                along = (place - s + self.words.max()) // BLOCK
                _, one = np.unique((d * len(self.words) + i) * (along.max() + 1) + along, return_index=True)
                d, i, s, place = d[one], i[one], s[one], place[one]
                n = self.words[i]
                slack = BLOCK + n // 4
                left, right = np.maximum(0, place - s - slack), np.minimum(sizes[d], place - s + n + BLOCK + slack)
                ends = np.cumsum(right - left)
                for cut in np.split(np.arange(len(d)), np.flatnonzero(np.diff(ends // 1_000_000)) + 1):
                    if len(cut):
                        size = (right - left)[cut]
                        there = self.member[i[cut].repeat(size), flat[_ranges((first[d] + left)[cut], size)]]
                        some = cut[np.add.reduceat(there, np.cumsum(size) - size, dtype=np.int64) >= self.share * n[cut]]
                        yield from zip(d[some].tolist(), i[some].tolist(), s[some].tolist(), place[some].tolist(), strict=True)

    def _region(self, item: Item, s: int, place: int) -> tuple[int, int]:
        """Words around a window at ``place`` that may hold the item, whose own window starts at ``s``."""
        n, slack = len(item.words), BLOCK + len(item.words) // 4
        return max(0, place - s - slack), place - s + n + BLOCK + slack

    def _enough(self, item: Item, region: np.ndarray) -> bool:
        """Whether the region has so many features in common with the item that it may have enough words in common."""
        kinds, counts = item.kinds
        return np.minimum(np.bincount(region, minlength=FEATURES)[kinds], counts).sum() >= self.share * len(item.words)

    def _verify(self, item: Item, region: list[bytes]) -> tuple[int, float] | None:
        n, there = len(item.words), Counter(region)
        if sum((there & item.counted).values()) < self.share * n:
            return None
        lcs = common_subsequence(item.masks, n, region)
        answer = sum((there & item.answer).values()) / max(1, item.answer.total())
        if lcs >= self.sure * n or lcs >= self.share * n and answer >= 0.8:
            return lcs, answer
        return None


@dataclass(frozen=True)
class Terms:
    """What counts as a candidate and as a leak."""

    cosine: float
    share: float
    sure: float
    least_words: int


@dataclass
class Index:
    """The latent space, and the table of items (block, item_id, text) in blocks of bounded size."""

    space: Space
    items: DataFrame
    blocks: int
    least_exact: int
    terms: Terms

    def block(self, number: int) -> list[Item]:
        return read_items([tuple(r) for r in self.items.where(F.col("block") == number).select("item_id", "text").collect()], self.least_exact)


def build_index(
    docs: DataFrame, benchmark: DataFrame, *, text_column: str = "text", item_id: str = "item_id", item_text: str = "text", id_column: str = "doc_id",
    dimensions: int = 128, block_items: int = 2_000, least_words: int = 8, least_exact: int = 3, cosine: float = 0.45, share: float = 0.6, sure: float = 0.75,
) -> Index:
    """Fit the latent space on all documents and items, and lay out the items."""
    texts = docs.select(F.col(id_column).alias("doc_id"), text_or_empty(text_column).alias("text"))
    items = benchmark.select(F.col(item_id).alias("item_id"), text_or_empty(item_text).alias("text"))
    scratch, n_items = Scratch(docs.sparkSession), items.count()
    space = fit_space(texts, items, dimensions=dimensions)
    blocks = max(1, math.ceil(n_items / block_items))
    # by text too, so that repeated ids do not crowd one block
    laid = scratch.save(items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)).cast("int")))
    return Index(space, laid, blocks, least_exact, Terms(cosine, share, sure, least_words))


_LEAK = "doc_id long, item_id long, cosine double, lcs long, n_words long, answer double"


def _find(space: Space, items: list[Item], terms: Terms):
    types = (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.float64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(space, items, terms)
        for b in slices(batches, 1):
            rows = [(i, *m) for i, ms in zip(b.column(0).to_pylist(), finder.matches(b.column(1)), strict=True) for m in ms]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names=["doc_id", "item_id", "cosine", "lcs", "n_words", "answer"])

    return run


def _without(space: Space, items: list[Item], terms: Terms, at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(space, items, terms)
        for b in slices(batches, at):
            yield b.filter(pa.array([not m for m in finder.matches(b.column(at))], pa.bool_()))

    return run


def find_leaks(docs: DataFrame, index: Index, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Rows (doc_id, item_id, cosine, lcs, n_words, answer), one for each item found in a document."""
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), text_or_empty(text_column).alias("text"))
    scratch, found = Scratch(docs.sparkSession), None
    for number in range(index.blocks):
        part = texts.mapInArrow(_find(index.space, index.block(number), index.terms), _LEAK)
        if index.blocks > 1:  # written at once, so that no plan holds the items of several blocks
            part = scratch.save(part)
        found = part if found is None else found.union(part)
    return found


def drop_leaks(docs: DataFrame, index: Index, *, text_column: str = "text") -> DataFrame:
    """The rows whose text has no benchmark item, with their own columns."""
    scratch, before = Scratch(docs.sparkSession), None
    for number in range(index.blocks):
        docs = docs.mapInArrow(_without(index.space, index.block(number), index.terms, docs.columns.index(text_column)), docs.schema)
        if index.blocks > 1:
            docs = scratch.save(docs)
            if before is not None:
                scratch.drop(before)
            before = docs
    return docs
