"""Removal of repeated substrings by a hash-compared suffix sort.

A byte goes when it lies in a string of ``length`` bytes that also starts in a document of smaller id.
Prefix polynomial hashes of the text give the hash of any substring in constant time, so the longest
common extension of two suffixes is found by binary search, and suffixes are ordered by a mergesort
whose comparisons cost O(log length). Equal neighbours are compared byte by byte.

Sorting all suffixes of a corpus would shuffle every position. Instead:

1. Documents go to blocks by id. In each string of ``length`` bytes, the smallest hash of its grams is its
   anchor, so equal strings have equal anchors at equal offsets. A run of strings with one anchor is
   an entry: its anchor's hash, the hash of the run's whole context, and its smallest document.
2. Entries meet by anchor hash. An entry whose context occurs in a smaller document is removed whole. One
   that shares its anchor only with the same context, or with none, is settled; so is one whose halves on both sides
   of the anchor no other context has, since equal strings agree in one of them. What remains is open.
3. Contexts of open entries meet by anchor. There, suffixes that start at the strings are grouped by anchor and offset,
   equal ones collapse (verified byte by byte), and the others are sorted as above; neighbours whose common extension
   reaches ``length`` are one class, whose smallest document decides.
4. An anchor with more than ``crowd`` contexts in one block, or ``hot`` in all, would crowd one task. Its suffixes are
   sorted within their blocks, and classes of equal strings meet by 128 bits of two independent hashes of the string instead.

Blocks hold a bounded number of bytes; entries and classes are single per block, so a passage that a third of
all documents share sends a few rows a block. Equality of whole contexts rests on 80 bits of two independent hashes, beside
the 40 bits of the anchor: among ten million contexts of one anchor a false pair has a chance under 1e-10.

Edge cases: null texts are empty; texts under ``length`` bytes lose nothing; equal ids are never smaller
than one another; null ids sort after all others and are not smaller than each other; repeated rows are
each returned; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import Scratch, input_bytes, text_or_empty

GRAM = 14
LEAD = 16  # bytes by which suffixes are dealt before they are sorted
NONE = 255  # no side, or one that no string reaches over
BASE, OTHER = 0x5DEECE66D1CE4E5B, 0x27BB2EE687B0B0FD  # odd, so that they have inverses modulo 2**64
CHUNK = 1 << 16  # bytes hashed at a time, whose arrays stay in the cache; a longer text is one chunk
NO_ID = np.iinfo(np.int64).max
_U = np.uint64
MARK = _U((1 << 40) - 1)  # instead of a context: a crowd of them


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.empty(n, np.uint64)
    out[0] = 1
    have = 1
    while have < n:
        step = _U(pow(base, have, 1 << 64))
        more = min(have, n - have)
        out[have : have + more] = out[:more] * step
        have += more
    return out


class PolyHash:
    """Prefix polynomial hashes of a byte buffer."""

    _tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, data: np.ndarray, base: int = BASE):
        n = len(data) + 1
        if base not in self._tables or len(self._tables[base][0]) < n:
            size = max(n, CHUNK + (1 << 17))
            self._tables[base] = _powers(base, size), _powers(pow(base, -1, 1 << 64), size)
        self.up, down = self._tables[base]
        self.prefix = np.zeros(n, np.uint64)
        np.cumsum((data.astype(np.uint64) + _U(1)) * down[: n - 1], out=self.prefix[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of data[start:end], equal for equal strings wherever they stand."""
        return (self.prefix[end] - self.prefix[start]) * self.up[start]


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    x = (x ^ _U(salt)) * _U(0x9E3779B97F4A7C15)
    x ^= x >> _U(29)
    x *= _U(0xC2B2AE3D27D4EB4F)
    return x ^ (x >> _U(32))


def common_extension(poly: PolyHash, a: np.ndarray, b: np.ndarray, limit: int) -> np.ndarray:
    """Longest common extension of suffixes a and b, up to ``limit``, by binary search on hashes."""
    got = np.zeros(len(a), np.int64)
    for step in (1 << k for k in reversed(range(limit.bit_length()))):
        may = got + step <= limit
        x, y = a + got, b + got
        same = may & (poly.of(x, np.where(may, x + step, x)) == poly.of(y, np.where(may, y + step, y)))
        got += step * same
    return got


def _less(data: np.ndarray, poly: PolyHash, a: np.ndarray, b: np.ndarray, limit: int, or_equal: np.ndarray) -> np.ndarray:
    got = common_extension(poly, a, b, limit)
    end = got >= limit
    return np.where(end, or_equal, data[np.where(end, a, a + got)] < data[np.where(end, b, b + got)])


def sorted_classes(data: np.ndarray, poly: PolyHash, starts: np.ndarray, groups: np.ndarray, limit: int) -> np.ndarray:
    """Class number of each suffix: equal iff group and the first ``limit`` bytes are equal.

    Suffixes are dealt by group and leading bytes; then a bottom-up mergesort of all that agree there at once: the rank
    of a suffix in the run beside its own is found by binary search with hash-compared suffixes.
    """
    n = len(starts)
    if not n:
        return np.zeros(0, np.int64)
    lead = [np.zeros(n, np.uint64) for _ in range(-(-min(limit, LEAD) // 8))]
    for i in range(min(limit, LEAD)):
        lead[i // 8] = lead[i // 8] << _U(8) | data[starts + i]
    order = np.lexsort((*lead[::-1], groups))
    differ = np.r_[False, np.any([x[order[1:]] != x[order[:-1]] for x in (groups, *lead)], axis=0)]
    groups = np.empty(n, np.int64)
    groups[order] = np.cumsum(differ)
    g = groups[order]
    first = np.r_[True, g[1:] != g[:-1]]
    begin = np.flatnonzero(first)
    size = np.diff(np.r_[begin, n])
    begin, size = np.repeat(begin, size), np.repeat(size, size)
    local = np.arange(n) - begin
    width = 1
    while (many := np.flatnonzero(size > width)).size:
        at, top = local[many], size[many]
        own = at // (2 * width) * (2 * width)
        right = at - own >= width
        lo = np.where(right, own, np.minimum(own + width, top))
        hi = np.where(right, own + width, np.minimum(own + 2 * width, top))
        base, me, low0 = begin[many], starts[order[many]], lo.copy()
        while (open_ := np.flatnonzero(lo < hi)).size:
            mid = (lo[open_] + hi[open_]) // 2
            other = starts[order[base[open_] + mid]]
            # the sibling's suffix goes before mine: a left one also when equal (stable)
            before = _less(data, poly, other, me[open_], limit, right[open_])
            lo[open_] = np.where(before, mid + 1, lo[open_])
            hi[open_] = np.where(before, hi[open_], mid)
        target = base + own + (at - own - np.where(right, width, 0)) + (lo - low0)
        moved = order.copy()
        moved[target] = order[many]
        order = moved
        width *= 2
    a, b = starts[order[:-1]], starts[order[1:]]
    differ = g[1:] != g[:-1]
    same = np.flatnonzero(~differ)
    equal = common_extension(poly, a[same], b[same], limit) >= limit
    for i in range(0, len(same), 1 << 16):  # collision verification
        part = same[i : i + (1 << 16)][equal[i : i + (1 << 16)]]
        span = np.arange(limit)
        equal[np.flatnonzero(equal[i : i + (1 << 16)]) + i] = (data[a[part][:, None] + span] == data[b[part][:, None] + span]).all(axis=1)
    differ[same[~equal]] = True
    out = np.empty(n, np.int64)
    out[order] = np.r_[0, np.cumsum(differ)]
    return out


class Block:
    """Documents of one block, by id, with the entries of their strings."""

    def __init__(self, table: pa.Table, length: int, most: int):
        ids = table.column("doc_id").to_pylist()
        texts = table.column("text").cast(pa.binary()).to_pylist()
        order = sorted(range(len(ids)), key=lambda i: (NO_ID if ids[i] is None else ids[i], texts[i]))
        self.ids = [ids[i] for i in order]
        self.texts = [texts[i] for i in order]
        self.ranks = np.array([NO_ID if i is None else i for i in self.ids], np.int64)
        self.length, self.chunks = length, []
        for lo, hi in self._cuts():
            self.chunks.append((lo, hi, *self._runs(lo, hi)))
        pick = lambda k: np.concatenate([c[k] for c in self.chunks]) if self.chunks else np.zeros(0, np.int64)
        self.doc, self.s0, self.s1, self.offset = pick(2), pick(3), pick(4), pick(5)
        self.anchor, self.context = pick(6).astype(np.uint64), pick(7).astype(np.uint64)
        self.left, self.right = pick(8).astype(np.uint8), pick(9).astype(np.uint8)
        self.second = pick(10).astype(np.uint64)
        # the smallest document of each (anchor, context); ids may repeat
        key = mix(self.anchor, 1) + self.context
        by = np.argsort(key)
        second = self.second[by]
        if ((key[by][1:] == key[by][:-1]) & (second[1:] != second[:-1])).any():
            by = np.lexsort((self.second, key))
            second = self.second[by]
        new = np.r_[True, (key[by][1:] != key[by][:-1]) | (second[1:] != second[:-1])] if len(by) else np.zeros(0, bool)
        number = np.cumsum(new) - 1
        self.entry = np.empty(len(by), np.int64)
        self.entry[by] = number
        self.entry_run = np.minimum.reduceat(by, np.flatnonzero(new)) if len(by) else by  # runs are in the order of documents
        self.key = key[by][new]
        # what the block sends: its entries, but one mark for an anchor with a crowd of them
        anchors, which, times = np.unique(self.anchor[self.entry_run], return_inverse=True, return_counts=True)
        crowd = times[which] > most
        lone, marks = np.flatnonzero(~crowd), np.flatnonzero(times > most)
        place = np.empty(len(times), np.int64)
        place[marks] = len(lone) + np.arange(len(marks))
        self.sent = np.where(crowd, place[which], 0)
        self.sent[lone] = np.arange(len(lone))
        self.sent_anchor = np.r_[self.anchor[self.entry_run][lone], anchors[marks]]
        self.sent_key = np.r_[mix(self.key[lone], 3) >> _U(24), np.full(len(marks), MARK)]
        self.sent_more = np.r_[self.second[self.entry_run][lone] >> _U(24), np.zeros(len(marks), np.uint64)]
        self.sent_rank = np.r_[self.ranks[self.doc[self.entry_run[lone]]], np.full(len(marks), NO_ID)]
        none = np.full(len(marks), NONE, np.uint8)
        self.sent_sides = np.stack([np.r_[self.left[self.entry_run][lone], none], np.r_[self.right[self.entry_run][lone], none]])

    def _cuts(self):
        lo, size = 0, 0
        for i, t in enumerate(self.texts):
            if size and size + len(t) > CHUNK:
                yield lo, i
                lo, size = i, 0
            size += len(t)
        if lo < len(self.texts):
            yield lo, len(self.texts)

    def buffer(self, lo: int, hi: int):
        texts = self.texts[lo:hi]
        data = np.frombuffer(b"".join(texts), np.uint8)
        ends = np.cumsum([len(t) for t in texts])
        return data, np.r_[0, ends[:-1]].astype(np.int64), ends.astype(np.int64)

    def _runs(self, lo: int, hi: int):
        data, begin, end = self.buffer(lo, hi)
        n = len(data) - self.length + 1
        none = [np.zeros(0, np.int64)] * 4 + [np.zeros(0, np.uint64)] * 2 + [np.zeros(0, np.uint8)] * 2 + [np.zeros(0, np.uint64)]
        if n <= 0:
            return none
        poly = PolyHash(data)
        grams = (poly.prefix[GRAM:] - poly.prefix[:-GRAM]) * poly.up[: len(poly.prefix) - GRAM]
        grams = mix(grams)
        bits = _U(max(24, int(len(grams)).bit_length()))
        low = (grams >> bits << bits) | np.arange(len(grams), dtype=np.uint64)
        window, have = self.length - GRAM + 1, 1
        while 2 * have <= window:
            low = np.minimum(low[: len(low) - have], low[have:])
            have *= 2
        if window > have:
            low = np.minimum(low[: len(low) - (window - have)], low[window - have :])
        at = (low[:n] & ((_U(1) << bits) - _U(1))).astype(np.int64)
        doc = np.repeat(np.arange(hi - lo), end - begin)[:n]
        ok = np.arange(n) + self.length <= end[doc]
        new = ok & np.r_[True, (at[1:] != at[:-1]) | (doc[1:] != doc[:-1]) | ~ok[:-1]]
        last = ok & np.r_[new[1:] | ~ok[1:], True]
        s0, s1 = np.flatnonzero(new), np.flatnonzero(last)
        a, d = at[s0], doc[s0]
        context = mix(poly.of(s0, s1 + self.length) + mix((a - s0).astype(np.uint64) * _U(1000003) + (s1 - s0).astype(np.uint64), 5), 7)
        second = mix(PolyHash(data, OTHER).of(s0, s1 + self.length), 9)
        # a string over the anchor has half of its other bytes on the left or on the right
        half = (self.length - GRAM) // 2
        reach = a - s0 >= half
        left = np.where(reach, mix(poly.of(np.where(reach, a - half, a), a), 31) % _U(NONE), NONE)
        reach, end = s1 + self.length - a - GRAM >= half, a + GRAM
        right = np.where(reach, mix(poly.of(end, np.where(reach, end + half, end)), 37) % _U(NONE), NONE)
        return d + lo, s0 - begin[d], s1 - begin[d], a - s0, grams[a], context, left.astype(np.uint8), right.astype(np.uint8), second


def _low_bytes(x: np.ndarray, width: int) -> np.ndarray:
    """The low ``width`` bytes of integers, a row each."""
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]


def _numbers(raw: np.ndarray, width: int) -> np.ndarray:
    """Integers of ``width`` bytes each."""
    raw = raw.reshape(-1, width)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, :width] = raw
    return wide.view("<u8").ravel()


def _binary(items: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """A value for each stretch of items between the cuts: their bytes one after the other."""
    items = np.ascontiguousarray(items)
    size = items.nbytes // max(1, len(items))
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer((cuts * size).astype(np.int32)), pa.py_buffer(items)])


def _joined(column: pa.ChunkedArray) -> np.ndarray:
    """The bytes of all values of a column one after the other; no value becomes an object."""
    parts = [np.zeros(0, np.uint8)]
    for c in column.chunks:
        _, offsets, data = c.buffers()
        if len(c) and data is not None:
            ends = np.frombuffer(offsets, np.int32)[c.offset : c.offset + len(c) + 1]
            parts.append(np.frombuffer(data, np.uint8)[ends[0] : ends[-1]])
    return np.concatenate(parts)


def _sizes(column: pa.ChunkedArray) -> np.ndarray:
    """Bytes of each value; none for null."""
    return pc.fill_null(pc.binary_length(column), 0).to_numpy().astype(np.int64)


def _deal(keys: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys in the order of their buckets, the buckets that are not empty, and where each of them begins, with the end."""
    buckets = (keys % _U(count)).astype(np.int64)
    order = np.argsort(buckets, kind="stable")
    first = np.flatnonzero(np.diff(buckets[order], prepend=-1))
    return order, buckets[order][first], np.r_[first, len(order)]


def _spread(rank: np.ndarray, cuts: np.ndarray) -> dict[str, pa.Array]:
    """Ranks as three low and five high bytes: the high ones are mostly the same and compress well."""
    wide = rank.view(np.uint64)
    return {"low": _binary(_low_bytes(wide, 3), cuts), "high": _binary(_low_bytes(wide >> _U(24), 5), cuts)}


def _ranks(table: pa.Table) -> np.ndarray:
    return (_numbers(_joined(table.column("high")), 5) << _U(24) | _numbers(_joined(table.column("low")), 3)).view(np.int64)


def _rows(schema: pa.Schema, n: int, **columns) -> pa.Table:
    """Rows of a schema; a column is an array, one value for all rows, or null."""
    arrays = []
    for f in schema:
        x = columns.get(f.name)
        arrays.append(x if isinstance(x, pa.Array | pa.ChunkedArray) else pa.array(x, f.type) if isinstance(x, np.ndarray | list) else pa.repeat(pa.scalar(x, f.type), n))
    return pa.Table.from_arrays(arrays, schema=schema)


SENT = pa.schema([("block", pa.int32()), ("bucket", pa.int32()), *((c, pa.binary()) for c in ("a", "b", "low", "high", "sides"))])
_SENT = "block int, bucket int, a binary, b binary, low binary, high binary, sides binary"
BACK = pa.schema([("block", pa.int32()), ("bucket", pa.int32()), ("flags", pa.binary())])
_BACK = "block int, bucket int, flags binary"


def _answer(table: pa.Table, flags: np.ndarray, sizes: np.ndarray) -> pa.Table:
    """Flags for each row of a bucket, so many each."""
    return _rows(BACK, table.num_rows, block=table.column("block"), bucket=table.column("bucket"), flags=_binary(flags, np.r_[0, np.cumsum(sizes)]))


def _answers(back: pa.Table) -> np.ndarray:
    """All flags that came back for a block, in the order of the buckets."""
    return _joined(back.take(pa.array(np.argsort(back.column("bucket").to_numpy(), kind="stable"))).column("flags"))


def _meet(widths: tuple[int, int], open_too: bool, hot: int = 0):
    """For each entry of a bucket: 1 if a smaller document has it; 2 if its first half occurs with another second half."""

    def run(table: pa.Table) -> pa.Table:
        a = _numbers(_joined(table.column("a")), widths[0])
        if open_too:  # entries have a second part of their key behind the first
            both = _joined(table.column("b")).reshape(-1, 2 * widths[1])
            b, b2 = _numbers(both[:, : widths[1]], widths[1]), _numbers(both[:, widths[1] :], widths[1])
        else:
            b, b2 = _numbers(_joined(table.column("b")), widths[1]), np.zeros(len(a), np.uint64)
        rank = _ranks(table)
        order = np.lexsort((rank, b2, b, a) if open_too else (rank, b, a))
        x, y, y2 = a[order], b[order], b2[order]
        new_a = np.r_[True, x[1:] != x[:-1]]
        new = new_a | np.r_[True, (y[1:] != y[:-1]) | (y2[1:] != y2[:-1])]
        number = np.cumsum(new) - 1
        least = rank[order][new][number]
        flag = (rank[order] > least).astype(np.uint8)
        if open_too:
            # of contexts around one anchor, those that may share a string: equal on one side of it; the
            # smallest entry of each sends its strings on
            group = (np.cumsum(new_a) - 1)[new]
            sides = _joined(table.column("sides")).reshape(-1, 2)[order][new]
            may = np.zeros(len(group), bool)
            for side in sides.T:
                _, where, times = np.unique(group * 256 + side, return_inverse=True, return_counts=True)
                may |= (times[where] > 1) & (side != NONE)
            flag |= (may[number] & (flag == 0)).astype(np.uint8) * 2
            crowded = np.zeros(group[-1] + 1, bool)
            crowded[group[y[new] == MARK]] = True
            crowded |= np.bincount(group) > hot
            flag[crowded[group][number] & (flag != 1)] = 3
        flags = np.empty(len(order), np.uint8)
        flags[order] = flag
        return _answer(table, flags, _sizes(table.column("a")) // widths[0])

    return run


def _entries(length: int, count: int, crowd: int):
    def run(table: pa.Table) -> pa.Table:
        b, number = Block(table, length, crowd), table.column("block")[0].as_py()
        order, buckets, cuts = _deal(b.sent_anchor, count)
        keys = np.hstack([_low_bytes(b.sent_key[order], 5), _low_bytes(b.sent_more[order], 5)])
        return _rows(SENT, len(buckets), block=number, bucket=buckets, a=_binary(_low_bytes(b.sent_anchor[order] // _U(count), 5), cuts), b=_binary(keys, cuts), sides=_binary(b.sent_sides[:, order].T, cuts), **_spread(b.sent_rank[order], cuts))

    return run


DONE = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])
PENDING = pa.schema([("kind", pa.string()), ("block", pa.int32()), ("bucket", pa.int32()), *((c, pa.binary()) for c in ("a", "b", "low", "high", "text", "spans", "runs", "classes")), *DONE])
_PENDING = "kind string, block int, bucket int, a binary, b binary, low binary, high binary, text binary, spans binary, runs binary, classes binary, doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _union(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, start and end of each maximal run of the bytes in spans."""
    if not len(doc):
        return doc, start, end
    by = np.lexsort((start, doc))
    doc, start, end = doc[by], start[by], end[by]
    beyond = doc * (int(end.max()) + 1)  # the spans of a document reach no later one
    reach = np.maximum.accumulate(end + beyond) - beyond
    first = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (start[1:] > reach[:-1])])
    return doc[first], start[first], reach[np.r_[first[1:], len(doc)] - 1]


def _cut(ids: list, texts: list[bytes], doc: np.ndarray, start: np.ndarray, end: np.ndarray, which: list[int]) -> dict[str, list]:
    """Id, bytes, removed bytes, maximal removed runs and digest of what is kept of some texts, given the runs of all in order."""
    cuts = np.searchsorted(doc, np.arange(len(texts) + 1)).tolist()
    out: dict[str, list] = {f.name: [] for f in DONE}
    for d in which:
        text, at, gone, digest = memoryview(texts[d]), 0, 0, hashlib.sha256()
        lo, hi = cuts[d], cuts[d + 1]
        for s, e in zip(start[lo:hi].tolist(), end[lo:hi].tolist(), strict=True):
            digest.update(text[at:s])
            at, gone = e, gone + e - s
        digest.update(text[at:])
        for column, value in zip(out.values(), (ids[d], len(text), gone, hi - lo, digest.hexdigest()), strict=True):
            column.append(value)
    return out


def _windows(width: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For runs of so many strings: the run and the place in it of each string."""
    run = np.repeat(np.arange(len(width)), width)
    return run, np.arange(len(run)) - np.repeat(np.cumsum(width) - width, width)


def _classes(data: np.ndarray, at: np.ndarray, groups: np.ndarray, length: int) -> np.ndarray:
    """Class of each suffix by its group and first ``length`` bytes: equal ones collapse, the rest are sorted."""
    poly = PolyHash(data)
    _, one, of = np.unique(mix(poly.of(at, at + length), 41) + mix(groups.astype(np.uint64), 43), return_index=True, return_inverse=True)
    span, same = np.arange(length), np.ones(len(at), bool)
    for i in range(0, len(at), 1 << 15):  # collision verification
        a, b = at[i : i + (1 << 15)], at[one[of[i : i + (1 << 15)]]]
        more = np.flatnonzero(a != b)
        same[i + more] = (data[a[more][:, None] + span] == data[b[more][:, None] + span]).all(axis=1) & (groups[i + more] == groups[one[of[i + more]]])
    apart = np.flatnonzero(~same)
    heads = np.r_[one, apart]
    classes = sorted_classes(data, poly, at[heads], groups[heads], length)
    out = classes[of]
    out[apart] = classes[len(one) :]
    return out


def _decide(length: int):
    """For each string of the contexts of a bucket: whether a smaller document has it."""

    def run(table: pa.Table) -> pa.Table:
        anchor, rank, data = _numbers(_joined(table.column("a")), 5), _ranks(table), _joined(table.column("text"))
        shape = _joined(table.column("b")).reshape(-1, 2).astype(np.int64)
        offset, width = shape[:, 0], shape[:, 1] + 1
        of, step = _windows(width)
        ends = np.cumsum(width + length - 1)
        at = (ends - (width + length - 1))[of] + step
        groups = np.unique((anchor[of] << _U(8)) + (offset[of] - step).astype(np.uint64), return_inverse=True)[1]
        classes = _classes(data, at, groups, length)
        least = np.full(classes.max() + 1, NO_ID)
        np.minimum.at(least, classes, rank[of])
        strings = np.r_[0, np.cumsum(width)][np.r_[0, np.cumsum(_sizes(table.column("a")) // 5)]]
        return _answer(table, (rank[of] > least[classes]).astype(np.uint8), np.diff(strings))

    return run


def _resolve(length: int, count: int, crowd: int):
    def run(table: pa.Table, back: pa.Table) -> pa.Table:
        if not table.num_rows:
            return PENDING.empty_table()
        number = table.column("block")[0].as_py()
        block = Block(table, length, crowd)
        flags = np.zeros(len(block.sent_anchor), np.uint8)
        flags[_deal(block.sent_anchor, count)[0]] = _answers(back)
        flags = flags[block.sent]
        first = block.ranks[block.doc[block.entry_run]]
        gone = (flags[block.entry] == 1) | (block.ranks[block.doc] > first[block.entry])
        is_open = (flags[block.entry] > 1) & ~gone
        lone = block.entry_run[is_open[block.entry_run]]  # other runs of an entry have the same strings
        hot = flags[block.entry[lone]] == 3
        # questions: the strings of open runs in the order of their buckets, then those of hot runs
        order, buckets, cuts = _deal(block.anchor[lone[~hot]], count)
        lone, n_open = np.r_[lone[~hot][order], lone[hot]], len(order)
        width = (block.s1 - block.s0 + 1)[lone]
        size = width + length - 1
        anchor, ranks = block.anchor[lone], block.ranks[block.doc[lone]]
        begin = np.cumsum([0, *map(len, block.texts)])
        data = np.frombuffer(b"".join(block.texts), np.uint8)
        text = lambda p: data[np.repeat((begin[block.doc] + block.s0)[lone[p]], size[p]) + _windows(size[p])[1]]
        out = []
        if n_open:
            p = slice(0, n_open)
            shape = np.stack([block.offset[lone[p]], width[p] - 1], axis=1).astype(np.uint8)
            out.append(_rows(PENDING, len(buckets), kind="open", block=number, bucket=buckets, a=_binary(_low_bytes(anchor[p] // _U(count), 5), cuts), b=_binary(shape, cuts), text=_binary(text(p), np.r_[0, np.cumsum(size[p])][cuts]), **_spread(ranks[p], cuts)))
        if n_open < len(lone):
            p = slice(n_open, len(lone))
            of, step = _windows(width[p])
            fine = mix(anchor[p][of] + mix((block.offset[lone[p]][of] - step).astype(np.uint64), 11), 13)
            strings, at = text(p), (np.cumsum(size[p]) - size[p])[of] + step
            classes = _classes(strings, at, np.unique(fine, return_inverse=True)[1], length)
            by = np.lexsort((ranks[p][of], classes))
            head = by[np.r_[True, classes[by][1:] != classes[by][:-1]]]  # of class 0, 1, ...
            one, two = (PolyHash(strings, base).of(at[head], at[head] + length) for base in (BASE, OTHER))
            a, b = mix(one, 17), mix(two, 23) ^ mix(fine[head], 29)
            order, buckets, cuts = _deal(a, count)
            place = np.empty(len(order), np.int32)
            place[order] = np.arange(len(order))
            least = ranks[p][of[head[order]]]
            out.append(_rows(PENDING, len(buckets), kind="hot", block=number, bucket=buckets, a=_binary(_low_bytes(a[order] // _U(count), 8), cuts), b=_binary(_low_bytes(b[order], 8), cuts), **_spread(least, cuts)))
            out.append(_rows(PENDING, 1, kind="classes", block=number, classes=[place[classes].astype("<i4").tobytes()]))
        first_of = np.full(len(flags), -1)
        first_of[block.entry[lone]] = np.cumsum(width) - width
        out_of = np.flatnonzero(gone)
        spans = _union(block.doc[out_of], block.s0[out_of], block.s1[out_of] + length)
        more = np.flatnonzero(is_open)
        more = more[np.argsort(block.doc[more], kind="stable")]
        waits = np.zeros(len(block.ids), bool)
        waits[block.doc[more]] = True
        done = np.flatnonzero(~waits).tolist()
        out.append(_rows(PENDING, len(done), kind="done", block=number, **_cut(block.ids, block.texts, *spans, done)))
        if len(more):
            which = np.flatnonzero(waits)
            doc, start, end = (x[waits[spans[0]]] for x in spans)
            edges = lambda docs: np.r_[np.searchsorted(docs, which), len(docs)]
            runs = np.stack([block.s0[more], block.s1[more] - block.s0[more] + 1, first_of[block.entry[more]]], axis=1).astype("<i4")
            out.append(_rows(PENDING, len(which), kind="doc", block=number, doc_id=[block.ids[d] for d in which], text=pa.array([block.texts[d] for d in which], pa.binary()), spans=_binary(np.stack([start, end], axis=1).astype("<i4"), edges(doc)), runs=_binary(runs, edges(block.doc[more]))))
        return pa.concat_tables(out)

    return run


def _finish(length: int):
    """Cuts the documents with open strings, given the answers to their block's questions."""

    def run(table: pa.Table, back: pa.Table) -> pa.Table:
        of_kind = lambda t, kind: t.filter(pc.equal(t.column("kind"), kind))
        docs, hot = of_kind(table, "doc"), of_kind(table, "hot")
        seen = _answers(of_kind(back, "open"))
        least = np.full(len(seen), NO_ID)
        if hot.num_rows:  # a class of hot strings may have a smaller document in this very block
            classes = _joined(of_kind(table, "classes").column("classes")).view("<i4")
            ranks = _ranks(hot.take(pa.array(np.argsort(hot.column("bucket").to_numpy(), kind="stable"))))
            seen, least = np.r_[seen, _answers(of_kind(back, "hot"))[classes]], np.r_[least, ranks[classes]]
        ids, texts = docs.column("doc_id").to_pylist(), docs.column("text").to_pylist()
        mine = np.array([NO_ID if i is None else i for i in ids], np.int64)
        old, runs = (_joined(docs.column(c)).view("<i4").reshape(-1, n).astype(np.int64) for c, n in (("spans", 2), ("runs", 3)))
        old_of, run_of = (np.repeat(np.arange(len(ids)), _sizes(docs.column(c)) // (4 * n)) for c, n in (("spans", 2), ("runs", 3)))
        of, step = _windows(runs[:, 1])
        question = runs[:, 2][of] + step
        hit = np.flatnonzero((seen[question] > 0) | (least[question] < mine[run_of][of]))
        start = (runs[:, 0][of] + step)[hit]
        spans = _union(np.r_[old_of, run_of[of[hit]]], np.r_[old[:, 0], start], np.r_[old[:, 1], start + length])
        return _rows(DONE, len(ids), **_cut(ids, texts, *spans, range(len(ids))))

    return run


def drop_repeats(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", length: int = 50, block_bytes: int = 6 << 20, crowd: int = 32, hot: int = 4096) -> DataFrame:
    """Rows (doc_id, n_bytes, n_removed, n_spans, kept_sha256), one for each input row.

    ``crowd`` and ``hot`` choose where the contexts of a frequent anchor are compared, and change no result.
    """
    if length <= GRAM:
        raise ValueError(f"length must be over {GRAM}")
    scratch = Scratch(docs.sparkSession)
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), text_or_empty(text_column).alias("text"))
    blocks = max(1, math.ceil(input_bytes(texts) / block_bytes))
    count = max(64, blocks)
    blocked = texts.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int"))
    back = blocked.groupBy("block").applyInArrow(_entries(length, count, crowd), _SENT).groupBy("bucket").applyInArrow(_meet((5, 5), True, hot), _BACK)
    met = blocked.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(_resolve(length, count, crowd), _PENDING)
    met = scratch.save(met)
    answer = [
        met.where(f"kind = '{kind}'").select("block", "bucket", "a", "b", "low", "high", "text").groupBy("bucket").applyInArrow(task, _BACK).withColumn("kind", F.lit(kind))
        for kind, task in (("open", _decide(length)), ("hot", _meet((8, 8), False)))
    ]
    waiting = met.where("kind in ('doc', 'hot', 'classes')").select("kind", "block", "bucket", "low", "high", "doc_id", "text", "spans", "runs", "classes")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    cut = waiting.groupBy("block").cogroup(answer[0].union(answer[1]).groupBy("block")).applyInArrow(_finish(length), schema)
    return met.where("kind = 'done'").select(*DONE.names).union(cut)
