"""Repair of the turn structure of conversations by depth-first branch and bound.

A conversation is well formed where the initials of its roles read ``(s?(ua)+)?``: a system turn or none, then pairs of user and assistant. Edits make
it so at the least cost: Keep (0), Rerole to user or assistant (2), Delete (3; the only choice for blank and duplicate rows), Insert an empty user or assistant turn
(2); a truncated row that stays adds 1. Among the cheapest repairs the one with the least ``audit`` (initials of the edits, in order) wins.

The search keeps an explicit stack of prefixes. It goes to the least edit first, drops a prefix whose cost and suffix lower bound (what the rows left cost at least from
its state) exceed the incumbent's cost, or meet it with a greater audit, and drops one that is no better than what its node's dominance table holds (a node is a row and a
state of the pattern). The cost of a prefix follows from its audit, so of two prefixes of equal cost at a node neither
is the beginning of the other, and the lesser one stays the lesser whatever follows: eliminating the worse is exact. It ends when the stack is empty.

Conversations of at most ``stretch`` rows and ``most_bytes`` of text are read whole, one at a time, from rows that are shuffled once. A longer one may hold any part
of all rows, so it is never in one place: its equal rows are counted first, earlier equal rows are found by hashes, and its rows are sorted in ranges of turns. Tasks read ranges as streams and
search stretches of ``stretch`` rows for the cheapest repair between each pair of states; stretches are then joined in order, one small row for each (the
same argument makes that exact). A hash of a whole text cannot be split: the rows pass once more, as a stream, through a task that holds the audit
and the state of the hash, but no rows.

Faults: a blank row has no character but white space (space, tab to carriage return); a duplicate has the role and text of an earlier row of its conversation; a truncated one ends,
white space aside, in something other than ``.``, ``!`` or ``?``. A row's first fault counts.

Edge cases: null texts and roles are one space; a null conversation id is a conversation of its own, a null turn comes first; rows of one turn are ordered by role and text;
a role without initial cannot be kept; repeated rows are duplicates; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import Scratch, slices

KEEP, REROLE, DELETE, INSERT = 0, 2, 3, 2
TRUNCATED = 1
#: States of the pattern: nothing yet, after s, after u, after a. It may end in the first and the last.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES, ENDS = range(4), (START, ASSISTANT)
#: (state, role initial) -> state
STEP = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
SPACE = " \t\n\x0b\x0c\r"
FAULTS = ("blank", "duplicate", "truncated")

Repair = tuple[int, str]  # cost, audit


def edits(row: str, state: int) -> list[tuple[str, int, int]]:
    """(initial, cost, next state) of each edit of a row from a state, the least initial first.

    A row is one character: its role initial (``s``, ``u``, ``a``, ``x`` for others), a capital where it is truncated, ``-`` where it must go.
    """
    found = [("D", DELETE, state)]
    if row != "-":
        extra = TRUNCATED if row.isupper() else 0
        if (to := STEP.get((state, row.lower()))) is not None:
            found.append(("K", KEEP + extra, to))
        found += [("R", REROLE + extra, to) for r in "ua" if (to := STEP.get((state, r))) is not None]
    return found


INSERTS = {q: [("I", INSERT, to) for r in "ua" if (to := STEP.get((q, r))) is not None] for q in STATES}
EDITS = {(r, q): edits(r, q) for r in "suaxSUAX-" for q in STATES}
#: All edits at a node, the greatest initial first, as a stack wants them; ``advance`` is 1 where the row is used up.
MOVES = {(r, q): sorted([(e, c, to, 1) for e, c, to in EDITS.get((r, q), [])] + [(e, c, to, 0) for e, c, to in INSERTS[q]], reverse=True) for r in "suaxSUAX-$" for q in STATES}
NEVER = 1 << 60


def suffix_bounds(rows: str, ends: tuple[int, ...]) -> list[list[int]]:
    """For each row and state, the least that the rows from there on cost until one of ``ends``; audits play no part."""
    bounds = [[NEVER] * 4 for _ in range(len(rows) + 1)]
    for i in range(len(rows), -1, -1):
        here = bounds[i]
        if i == len(rows):
            for q in ends:
                here[q] = 0
        else:
            row, below = rows[i], bounds[i + 1]
            for q in STATES:
                here[q] = min(c + below[to] for _, c, to in EDITS[row, q])
        for _ in STATES:  # inserts before the row
            for q in STATES:
                for _, c, to in INSERTS[q]:
                    here[q] = min(here[q], c + here[to])
    return bounds


def search(rows: str, start: int, ends: tuple[int, ...]) -> Repair | None:
    """The cheapest repair of the rows from a state to one of ``ends``, ties by the least audit; None where there is none."""
    bounds, n = suffix_bounds(rows, ends), len(rows)
    if bounds[0][start] >= NEVER:
        return None
    best = (bounds[0][start], "~")  # no repair costs less than the root's bound, so what costs more is never the incumbent; any audit is less than this one
    kept: dict[tuple[int, int], Repair] = {}
    stack: list[tuple[int, int, int, str]] = [(0, start, 0, "")]
    while stack:
        i, q, cost, audit = stack.pop()
        if ((i, q) in kept and kept[i, q] <= (cost, audit)) or (cost + bounds[i][q] == best[0] and audit > best[1]):
            continue
        kept[i, q] = (cost, audit)
        if i == n and q in ends and (cost, audit) < best:
            best = (cost, audit)
        for edit, more, to, advance in MOVES[rows[i] if i < n else "$", q]:
            if cost + more + bounds[i + advance][to] <= best[0]:
                stack.append((i + advance, to, cost + more, audit + edit))
    return best


@lru_cache(maxsize=100_000)
def whole_repair(rows: str) -> Repair:
    """The repair of a whole conversation; many have the same rows."""
    return search(rows, START, ENDS)  # deleting all rows is always possible


LEGAL = {"su", "ua", "au"}
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
#: What a task tells of a stretch: counts, the turns and role initials at its edges, and its repairs between pairs of states.
STRETCH = "task int, number long, low long, high long, turns long, blank long, duplicate long, truncated long, illegal long, first string, last string, costs array<long>, audits array<string>"


class Tally:
    """Counts over rows in order; ``symbols`` has one character for each, as ``edits`` reads it."""

    def __init__(self):
        self.low = self.high = self.first = self.last = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.symbols: list[str] = []

    def add(self, turn: int | None, role: str, text: str, again: bool) -> None:
        if turn is not None and turn != self.high:
            self.low, self.high, self.turns = turn if self.low is None else self.low, turn, self.turns + 1
        initial, body = role[:1], text.rstrip(SPACE)
        self.illegal += self.last is not None and self.last + initial not in LEGAL
        self.first, self.last = initial if self.first is None else self.first, initial
        known = initial if initial and initial in "sua" else "x"
        cut = not again and body[-1:] not in (".", "!", "?")
        self.blank += not body
        self.duplicate += bool(body) and again
        self.truncated += bool(body) and cut
        self.symbols.append("-" if not body or again else known.upper() if cut else known)

    @property
    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.turns


def repaired(rows: Iterator[tuple[str, str]], audit: str) -> Iterator[tuple[str, str, str]]:
    """(role, text, edit) of each turn after the edits. Each rerole and insert takes the role that the pattern wants there."""
    wanted = "user"
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(rows)
        if edit == "D":
            continue
        if edit != "K":
            role = wanted
        yield role, text, edit
        wanted = "assistant" if role[0] == "u" else "user"


def hashed(turns: Iterator[tuple[str, str, str]]) -> str:
    digest, first = hashlib.sha256(), True
    for role, text, _ in turns:
        digest.update(f"{'' if first else chr(10)}{role}:{text}".encode())
        first = False
    return digest.hexdigest()


def _rows(batches: Iterator[pa.RecordBatch], text: int | None) -> Iterator[tuple]:
    """Rows of the batches, taken few at a time: by the size of a text column, or a hundred."""
    for b in (b.slice(i, 100) for b in batches for i in range(0, b.num_rows, 100)) if text is None else slices(batches, text):
        yield from zip(*(c.to_pylist() for c in b.columns), strict=True)


def _emit(rows: Iterator[tuple], types: dict[str, pa.DataType], most: int = 1000, most_chars: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += sum(len(v) for v in row if isinstance(v, str))
        if len(held) >= most or chars >= most_chars:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types.values(), strict=True)], names=list(types))
            held, chars = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types.values(), strict=True)], names=list(types))


def _task(make, types: dict[str, pa.DataType], text: int | None):
    """A function on Arrow batches whose rows (key first) go to ``make`` and come out as ``types``; the key keeps its type."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is not None:
            yield from _emit(make(_rows(chain([first], batches), text)), {"conv_id": first.schema.field(0).type} | types)

    return run


TOTALS = {c: pa.int64() for c in COUNTS} | {"audit": pa.string(), "repaired_sha256": pa.string()}
TURNS = {"position": pa.int64(), "role": pa.string(), "text": pa.string(), "edit": pa.string()}


def _outcome(key, counts: tuple, audit: str, rows: Iterator[tuple[str, str]], turns: bool) -> Iterator[tuple]:
    if turns:
        for k, turn in enumerate(repaired(rows, audit)):
            yield (key, k, *turn)
    else:
        yield (key, *counts, audit, hashed(repaired(rows, audit)))


def _whole(turns: bool):
    """Conversations one after another: their rows (conv_id, turn, role, text, copies), in order."""

    def make(rows: Iterator[tuple]) -> Iterator[tuple]:
        for key, group in groupby(rows, key=lambda r: r[0]):
            tally, seen, kept = Tally(), set(), []
            for _, turn, role, text, copies in group:
                for _ in range(copies):
                    tally.add(turn, role, text, (role, text) in seen)
                    seen.add((role, text))
                    kept.append((role, text))
            cost, audit = whole_repair("".join(tally.symbols))
            yield from _outcome(key, (tally.gaps, tally.blank, tally.duplicate, tally.truncated, tally.illegal, cost), audit, iter(kept), turns)

    return make


def _stretches(stretch: int):
    """Ranges of long conversations: rows (conv_id, turn, role, text, copies, again), in order."""

    def told(key, number: int, tally: Tally) -> tuple:
        rows = "".join(tally.symbols)
        found = [search(rows, a, (b,)) for a in STATES for b in STATES]
        costs, audits = [f and f[0] for f in found], [f and f[1] for f in found]
        return (key, TaskContext.get().partitionId(), number, tally.low, tally.high, tally.turns, tally.blank, tally.duplicate, tally.truncated, tally.illegal, tally.first, tally.last, costs, audits)

    def make(rows: Iterator[tuple]) -> Iterator[tuple]:
        for key, group in groupby(rows, key=lambda r: r[0]):
            tally, number = Tally(), 0
            for _, turn, role, text, copies, again in group:
                for k in range(copies):
                    tally.add(turn, role, text, again or k > 0)
                    if len(tally.symbols) >= stretch:
                        yield told(key, number, tally)
                        tally, number = Tally(), number + 1
            if tally.symbols:
                yield told(key, number, tally)

    return make


def before(a: tuple | None, b: tuple | None) -> bool:
    """Whether one joined audit is less than another; each is a chain (audit so far, piece), and equal beginnings are the same object."""
    one, two = [], []
    while a is not b:
        if b is None or (a is not None and a[2] > b[2]):
            one.append(a[1])
            a = a[0]
        else:
            two.append(b[1])
            b = b[0]
    return "".join(reversed(one)) < "".join(reversed(two))


def _join_stretches(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Rows of ``_stretches`` in order to one row for each conversation; its turns are hashed later."""
    for key, group in groupby(rows, key=lambda r: r[0]):
        total, ways = Tally(), {START: (0, None)}
        for _, _, _, low, high, turns, blank, duplicate, truncated, illegal, first, last, costs, audits in group:
            total.illegal += illegal + (total.last is not None and total.last + first not in LEGAL)
            total.last = last
            total.blank, total.duplicate, total.truncated = total.blank + blank, total.duplicate + duplicate, total.truncated + truncated
            if low is not None:
                total.turns += turns - (low == total.high)
                total.low, total.high = low if total.low is None else total.low, high
            after: dict[int, tuple[int, tuple]] = {}
            for a, (cost, audit) in ways.items():
                for b in STATES:
                    piece = audits[4 * a + b]
                    if piece is not None:
                        way = (cost + costs[4 * a + b], (audit, piece, 1 + (audit[2] if audit else 0)))
                        if b not in after or way[0] < after[b][0] or (way[0] == after[b][0] and before(way[1], after[b][1])):
                            after[b] = way
            ways = after
        best = None
        for q in ENDS:
            if q in ways and (best is None or ways[q][0] < best[0] or (ways[q][0] == best[0] and before(ways[q][1], best[1]))):
                best = ways[q]
        pieces, audit = [], best[1]
        while audit is not None:
            pieces.append(audit[1])
            audit = audit[0]
        yield (key, total.gaps, total.blank, total.duplicate, total.truncated, total.illegal, best[0], "".join(reversed(pieces)))


def _apply(turns: bool):
    """Long conversations one after another: a row with the audit as text and the counts, then their rows, in order."""

    def expanded(group: Iterator[tuple]) -> Iterator[tuple[str, str]]:
        for r in group:
            for _ in range(r[5]):
                yield r[3], r[4]

    def make(rows: Iterator[tuple]) -> Iterator[tuple]:
        for key, group in groupby(rows, key=lambda r: r[0]):
            head = next(group)
            yield from _outcome(key, head[6:], head[4], expanded(group), turns)

    return make


def damage(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) with the damage of a test: by a hash of conversation and turn some are lost, emptied, cut,
    repeated or put in the user's mouth. ``copies`` counts how often a row stands there (0: lost)."""
    key = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.pmod(F.crc32(key.cast("binary")), F.lit(20))
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    copies = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    return rows.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"), text.alias("text"), copies.cast("long").alias("copies"))


def _long(rows: DataFrame, stretch: int, most_bytes: int) -> DataFrame:
    """(conv_id, long): conversations that are not read whole."""
    size = rows.groupBy("conv_id").agg(F.sum("copies").alias("n"), F.sum(F.octet_length("text") * F.col("copies")).alias("bytes"))
    return size.where((F.col("n") > stretch) | (F.col("bytes") > most_bytes)).select("conv_id")


def _in_stretches(rows: DataFrame, id_type: str, stretch: int, turns: bool) -> DataFrame:
    """The outcome of long conversations."""
    scratch = Scratch(rows.sparkSession)
    same = ["conv_id", "turn", "role", "text"]
    counted = rows.groupBy(*same).agg(F.sum("copies").alias("copies")).where("copies > 0")
    counted = scratch.save(counted.withColumns({"a": F.xxhash64("role", "text"), "b": F.xxhash64("text", F.lit(7), "role")}))
    nth = F.struct(F.col("turn").isNotNull(), "turn")
    earliest = counted.groupBy(F.col("conv_id").alias("c"), F.col("a").alias("x"), F.col("b").alias("y")).agg(F.min(nth).alias("least"))
    met = counted.join(earliest, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("a") == F.col("x")) & (F.col("b") == F.col("y")))
    marked = scratch.save(met.select(*same, "copies", (nth != F.col("least")).alias("again")))
    # ranges are cut by turn and by the beginnings of texts, in the order of the rows
    ranges = marked.withColumn("head", F.substring("text", 1, 64)).repartitionByRange("conv_id", "turn", "role", "head").sortWithinPartitions(*same)
    types = {"task": pa.int32(), "number": pa.int64()} | {c: pa.int64() for c in ("low", "high", "turns", *FAULTS, "illegal")} | {"first": pa.string(), "last": pa.string(), "costs": pa.list_(pa.int64()), "audits": pa.list_(pa.string())}
    told = scratch.save(ranges.select(*same, "copies", "again").mapInArrow(_task(_stretches(stretch), types, 3), f"conv_id {id_type}, {STRETCH}"))
    ordered = told.repartition("conv_id").sortWithinPartitions("conv_id", "task", "number")
    counts = ", ".join(f"{c} long" for c in COUNTS)
    joined = ordered.mapInArrow(_task(_join_stretches, {c: pa.int64() for c in COUNTS} | {"audit": pa.string()}, None), f"conv_id {id_type}, {counts}, audit string")
    heads = joined.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.col("audit").alias("text"), F.lit(0).cast("long").alias("copies"), *COUNTS)
    body = marked.select("conv_id", F.lit(1).alias("kind"), "turn", "role", "text", "copies", *(F.lit(None).cast("long").alias(c) for c in COUNTS))
    stream = heads.union(body).repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "role", "text")
    return stream.mapInArrow(_task(_apply(turns), TURNS if turns else TOTALS, 4), _schema(id_type, turns))


def _schema(id_type: str, turns: bool) -> str:
    if turns:
        return f"conv_id {id_type}, position long, role string, text string, edit string"
    return f"conv_id {id_type}, {', '.join(f'{c} long' for c in COUNTS)}, audit string, repaired_sha256 string"


def _repair(rows: DataFrame, stretch: int, most_bytes: int, turns: bool) -> DataFrame:
    clean = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), F.col("copies").cast("long").alias("copies"))
    id_type = clean.schema["conv_id"].dataType.simpleString()
    long = Scratch(rows.sparkSession).save(_long(clean, stretch, most_bytes))
    found, short = None, clean
    if not long.isEmpty():
        long = long.withColumnRenamed("conv_id", "c")
        one = F.col("conv_id").eqNullSafe(F.col("c"))
        short = clean.join(long, one, "left_anti")
        found = _in_stretches(clean.join(long, one, "left_semi"), id_type, stretch, turns)
    ordered = short.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    done = ordered.mapInArrow(_task(_whole(turns), TURNS if turns else TOTALS, 3), _schema(id_type, turns))
    return done if found is None else done.union(found)


def repair(rows: DataFrame, *, stretch: int = 1024, most_bytes: int = 16 << 20) -> DataFrame:
    """One row for each conversation of rows (conv_id, turn, role, text, copies): faults, the cheapest repair's cost and audit, and the hash of the repaired turns.

    ``copies`` says how often a row stands in its place; 0 keeps the conversation in the result without the row.
    """
    return _repair(rows, stretch, most_bytes, turns=False)


def repaired_turns(rows: DataFrame, *, stretch: int = 1024, most_bytes: int = 16 << 20) -> DataFrame:
    """The turns after the cheapest repair: rows (conv_id, position, role, text, edit); conversations of which nothing is left have none."""
    return _repair(rows, stretch, most_bytes, turns=True)
