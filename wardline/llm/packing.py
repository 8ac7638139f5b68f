"""Packing of token sequences by bin completion with branch and bound.

Only lengths matter for packing, and there are at most ``capacity`` of them, so the search runs
on the histogram of lengths: a bounded table, however many documents there are. It fills one sequence around
the longest piece left at a time: it enumerates the undominated fillings of the space beside
that piece, applies each as often as the counts allow and then less often, prunes branches whose waste exceeds what a better solution may
waste, and keeps a best-fit packing as the first incumbent. It ends when a lower bound is met (on large tables best fit
mostly meets it at once), when all branches are pruned, or after ``nodes`` sets of pieces. The plan (patterns of lengths with how often each is used)
then goes back to the pieces: Spark ranks the pieces of each length, in salted groups, and each task looks up the
sequence and offset of its pieces.

Token ids are those of the named ``tokenizers`` file; tiktoken computes them from the same vocabulary where it can
(several times faster, equal ids), and ``tokenizers`` does the rest.

Edge cases: null texts are empty and give one piece, the end token; ids may repeat or be null (each row is
packed); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import bisect
import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardline.llm.common import Scratch, slices, text_or_empty


@lru_cache
def tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache
def _ranked(path: str):
    """The same byte-level vocabulary in tiktoken, or None where the file is of another kind."""
    import json

    import tiktoken

    spec = json.load(open(path, encoding="utf-8"))
    pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
    if spec.get("normalizer") or model.get("type") != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space"):
        return None
    if not pre.get("use_regex", True):
        return None
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    chars = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in printable)}
    special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    ranks = {bytes(chars[c] for c in token): i for token, i in model["vocab"].items() if token not in special}
    if sorted(ranks.values()) != list(range(len(ranks))):
        return None
    pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    return tiktoken.Encoding("ranked", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)


def token_ids(text: str, path: str) -> np.ndarray:
    ranked = _ranked(path)
    if ranked is not None:
        try:
            return ranked.encode_to_numpy(text, allowed_special="all").astype("<u4")
        except BaseException as error:  # its regular expressions give up on extreme runs, in a Rust panic, which has no class to import
            if type(error).__name__ != "PanicException":
                raise
    return np.array(tokenizer(path).encode(text, add_special_tokens=False).ids, "<u4")


def pieces_of(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of each piece of n tokens; the first one is what full pieces leave."""
    first = n - (math.ceil(n / capacity) - 1) * capacity
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def _tokenize(path: str, capacity: int, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = 0
        for batch in slices(batches, 1):
            cols: list[list] = [[] for _ in range(6)]
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.append(token_ids(text, path), np.uint32(end)).astype("<u4")
                for k, (s, n) in enumerate(pieces_of(len(ids), capacity)):
                    for c, v in zip(cols, (i, k, s, n, zlib.crc32(ids[s : s + n].tobytes()), number), strict=True):
                        c.append(v)
                    number += 1
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32", "number"])

    return run


Plan = list[tuple[tuple[int, ...], int]]  # lengths of one sequence, and how many such sequences


class _Sizes:
    """Counts of lengths, with the lengths that are left in order."""

    def __init__(self, counts: dict[int, int]):
        self.counts = {s: c for s, c in counts.items() if c > 0}
        self.left = sorted(self.counts)

    def copy(self) -> _Sizes:
        other = object.__new__(_Sizes)
        other.counts, other.left = dict(self.counts), list(self.left)
        return other

    def best(self, room: int) -> int:
        """The longest length that fits, or 0."""
        i = bisect.bisect_right(self.left, room)
        return self.left[i - 1] if i else 0

    def take(self, pattern: tuple[int, ...], times: int) -> None:
        for s in set(pattern):
            self.counts[s] -= times * pattern.count(s)
            if not self.counts[s]:
                del self.counts[s]
                self.left.pop(bisect.bisect_left(self.left, s))

    def give(self, pattern: tuple[int, ...], times: int) -> None:
        """Undo ``take``."""
        for s in set(pattern):
            if s not in self.counts:
                self.counts[s] = 0
                bisect.insort(self.left, s)
            self.counts[s] += times * pattern.count(s)

    def times(self, pattern: tuple[int, ...]) -> int:
        return min(self.counts[s] // pattern.count(s) for s in set(pattern))


def best_fit(counts: dict[int, int], capacity: int) -> Plan:
    """Best-fit decreasing: beside the longest piece, the longest that fits, again and again."""
    sizes, plan = _Sizes(counts), []
    while sizes.left:
        trial, pattern, room = sizes.copy(), (), capacity
        while (s := trial.best(room)) and room:
            pattern += (s,)
            trial.take((s,), 1)
            room -= s
        times = sizes.times(pattern)
        sizes.take(pattern, times)
        plan.append((pattern, times))
    return plan


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """At least so many sequences are needed: for any k, pieces over capacity - k stand alone, pieces over a half apart."""
    if not counts:
        return 0
    n, total = np.zeros(capacity + 1, np.int64), np.zeros(capacity + 1, np.int64)
    for s, c in counts.items():
        n[s], total[s] = c, s * c
    upto_n, upto = np.cumsum(n), np.cumsum(total)
    half, best = capacity // 2, 0
    for k in range(half + 1):
        alone = int(upto_n[-1] - upto_n[capacity - k])
        apart = int(upto_n[capacity - k] - upto_n[half])
        small = int(upto[half] - (upto[k - 1] if k else 0))
        room = apart * capacity - int(upto[capacity - k] - upto[half])
        best = max(best, alone + apart + max(0, -(-(small - room) // capacity)))
    return best


def fillings(sizes: _Sizes, first: int, capacity: int, most_waste: int, budget: list[int]) -> Iterator[tuple[int, ...]]:
    """Undominated fillings around ``first`` that waste at most ``most_waste``, best-fit ones first.

    A filling is dominated where another piece still fits, or where one longer piece could stand in for one or two of
    its pieces. ``budget[0]`` counts down by each set looked at, and ends the search at zero.
    """
    left = sizes.left

    def self_fits(taken: tuple[int, ...], room: int) -> bool:
        return any(sizes.counts[left[i]] > taken.count(left[i]) for i in range(bisect.bisect_right(left, room)))

    def dominated(taken: tuple[int, ...], room: int) -> bool:
        if not room:
            return False
        inner = Counter(taken[1:])
        kinds = sorted(inner)
        for x in {*kinds, *(x + y for i, x in enumerate(kinds) for y in kinds[i + (inner[x] < 2) :])}:
            i = bisect.bisect_right(left, x + room) - 1
            while i >= 0 and left[i] > x:  # all pieces of a length may be taken already
                if sizes.counts[left[i]] > taken.count(left[i]):
                    return True
                i -= 1
        return False

    def from_top(top: int) -> int:
        return bisect.bisect_right(left, top) - 1

    # sets under construction, each with its room and the place of the next length to try
    stack = [[(first,), capacity - first, from_top(min(first, capacity - first))]]
    while stack and budget[0] > 0:
        entry = stack[-1]
        taken, room, i = entry
        while i >= 0 and (sizes.counts[left[i]] <= taken.count(left[i]) or most_waste < room - left[i] < left[0]):
            i -= 1
        entry[2] = i - 1
        if i < 0:
            stack.pop()
        else:
            budget[0] -= 1
            taken, room = (*taken, left[i]), room - left[i]
            stack.append([taken, room, from_top(min(left[i], room))])
        if (i >= 0 or taken == (first,)) and room <= most_waste and not self_fits(taken, room) and not dominated(taken, room):
            yield taken


@dataclass
class Packing:
    plan: Plan
    sequences: int
    bound: int  # no packing has fewer
    ended: bool = False  # the search looked at all that it had to

    @property
    def optimal(self) -> bool:
        """Whether no packing has fewer sequences, by the bound or by a search that ended."""
        return self.ended or self.sequences == self.bound


@dataclass
class _Frame:
    """One step of the search: fillings around the longest piece, those that it has used up, and the one in use."""

    first: int
    choices: Iterator[tuple[int, ...]]
    spent: frozenset[tuple[int, ...]]
    pattern: tuple[int, ...] = ()
    times: int = 0


def bin_completion(counts: dict[int, int], capacity: int, *, nodes: int = 50_000) -> Packing:
    """A packing with as few sequences as the search finds; the best-fit one at worst.

    The search goes depth first. Around the longest piece left it takes each undominated filling, as often as the counts allow first
    and then once less often each time, down to once; what is left of that length then takes other fillings (the order of sequences does not matter, so a
    filling that was left is not taken up again around the same length). ``nodes`` bounds the sets of pieces and the steps that it looks at; best fit does not count.
    """
    incumbent = best_fit(counts, capacity)
    used = lambda plan: sum(t for _, t in plan)
    total, least = sum(s * c for s, c in counts.items()), lower_bound(counts, capacity)
    best, budget = used(incumbent), [nodes]
    sizes, waste = _Sizes(counts), 0
    frames: list[_Frame] = []
    slack = lambda: (best - 1) * capacity - total - waste  # noqa: E731  # what a better packing may still waste

    def go_on() -> None:
        first = sizes.left[-1]
        spent = frozenset()
        if frames and frames[-1].first == first:
            spent = frames[-1].spent | {frames[-1].pattern}
        budget[0] -= 1
        frames.append(_Frame(first, fillings(sizes, first, capacity, slack(), budget), spent))

    if best > least and sizes.left:
        go_on()
    while frames and budget[0] > 0 and best > least:
        frame = frames[-1]
        if frame.times:  # one sequence less of the filling in use
            sizes.give(frame.pattern, 1)
            waste -= capacity - sum(frame.pattern)
            frame.times -= 1
        if not frame.times:
            frame.pattern = next((p for p in frame.choices if p not in frame.spent), ())
            if not frame.pattern:
                frames.pop()
                continue
            wasted = capacity - sum(frame.pattern)
            times = min(sizes.times(frame.pattern), max(slack(), 0) // wasted if wasted else 1 << 60)
            if times <= 0:
                frame.pattern = ()
                continue
            frame.times = times
            sizes.take(frame.pattern, times)
            waste += times * wasted
        if not sizes.left:
            best, incumbent = sum(f.times for f in frames), [(f.pattern, f.times) for f in frames]
        elif slack() >= 0:
            go_on()
    return Packing(incumbent, best, least, best > least and not frames)


def slots_of(plan: Plan) -> dict[str, np.ndarray]:
    """For each length, ranges of ranks and where they go.

    A range covers one place of one pattern: rank r of it goes to sequence ``base + r - low`` at ``offset``.
    """
    rows, base, used = [], 0, {}
    for pattern, times in plan:
        offset = 0
        for s in pattern:
            low = used.get(s, 0)
            rows.append((s, low, base, offset))
            used[s] = low + times
            offset += s
        base += times
    rows.sort()
    names = ("length", "low", "base", "offset")
    return {n: np.array([r[i] for r in rows], np.int64) for i, n in enumerate(names)}


def _place(slots: dict[str, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shift = np.int64(1) << 44
        keys = slots["length"] * shift + slots["low"]
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            at = np.searchsorted(keys, length * shift + rank, side="right") - 1
            sequence = slots["base"][at] + rank - slots["low"][at]
            cols = [b.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(sequence), pa.array(slots["offset"][at])], names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return run


def pack(docs: DataFrame, tokenizer_path: str, *, id_column: str = "doc_id", text_column: str = "text", capacity: int = 2048, end: int = 0, nodes: int = 50_000, group: int = 20_000) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32, sequence_id, offset), one for each piece."""
    scratch = Scratch(docs.sparkSession)
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), text_or_empty(text_column).alias("text"))
    cut = scratch.save(texts.mapInArrow(_tokenize(tokenizer_path, capacity, end), "doc_id long, piece int, start long, length long, ids_crc32 long, number long"))
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}  # at most ``capacity`` rows
    slots = slots_of(bin_completion(counts, capacity, nodes=nodes).plan)
    salts = max(16, math.ceil(sum(counts.values()) / group))
    # ``number`` counts the pieces of a task, so that repeated rows are dealt out too
    salted = cut.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "number"), F.lit(salts)))
    sums = salted.groupBy("length", "salt").count()
    before = sums.select("length", "salt", (F.sum("count").over(Window.partitionBy("length").orderBy("salt")) - F.col("count")).alias("before"))
    own = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "number")) - 1
    ranked = salted.withColumn("own", own).join(before, ["length", "salt"]).withColumn("rank", (F.col("own") + F.col("before")).cast("long"))
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank")
    return ranked.mapInArrow(_place(slots), "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
