"""Conversation repair against an exhaustive search and a plain reading of the contract."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from wardline.llm import conversations as C

SCHEMA = "conv_id long, turn long, role string, text string"
GOOD = re.compile(r"(s?(ua)+)?")


def plain_repair(rows):
    """Cheapest (cost, audit) over all sequences of edits of (initial, fault), by growing audits row by row; two inserts in a row at most lead anywhere."""
    ways = {"": (0, "")}  # roles so far, kept whole, -> best

    def grow(ways):
        for _ in range(2):
            more = dict(ways)
            for roles, (c, a) in ways.items():
                for r in "ua":
                    key, way = roles + r, (c + 2, a + "I")
                    if key not in more or way < more[key]:
                        more[key] = way
            ways = more
        return {k: v for k, v in ways.items() if re.fullmatch(r"s?((ua)*u?)?", k)}

    for initial, fault in rows:
        after = {}
        for roles, (c, a) in grow(ways).items():
            options = [("D", 3, roles)]
            if fault not in ("blank", "duplicate"):
                extra = fault == "truncated"
                options += [("K", extra, roles + (initial or "?")), *(("R", 2 + extra, roles + r) for r in "ua")]
            for e, more, key in options:
                way = (c + more, a + e)
                if key not in after or way < after[key]:
                    after[key] = way
        ways = after
    return min(v for k, v in grow(ways).items() if GOOD.fullmatch(k))


def plain(rows, damaged=True):
    """All columns of one conversation's original rows (conv_id, turn, role, text)."""
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if damaged else 9
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    out.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, faults = set(), []
    for _, role, text in out:
        body = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else None if body[-1] in ".!?" else "truncated")
        seen.add((role, text))
    turns = {t for t, _, _ in out if t is not None}
    initials = [r[:1] for _, r, _ in out]
    cost, audit = plain_repair(list(zip(initials, faults)))
    left, lines, at = iter(out), [], 0
    for e in audit:
        _, role, text = (0, "", "") if e == "I" else next(left)
        if e == "D":
            continue
        if e != "K":
            role = ("user", "assistant")[(at - (1 if lines and lines[0][:1] == "s" else 0)) % 2]
        lines.append(f"{role}:{text}")
        at += 1
    counts = tuple(faults.count(f) for f in C.FAULTS)
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def brute(rows, damaged=True):
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    return {k: plain(v, damaged) for k, v in by.items()}


def result(df):
    rows = df.select("conv_id", *C.COUNTS, "audit", "repaired_sha256").collect()
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: tuple(r)[1:] for r in rows}


def made(n, seed, turns=9):
    draw, rows = random.Random(seed), []
    for conv in range(n):
        for t in range(draw.randrange(1, turns)):
            role = draw.choice(["user", "assistant", "assistant", "user", "system", "tool", "", None, "User"])
            text = draw.choice(["Yes.", "No!", "a?", "cut", " \n", "", None, "Yes. ", "eé.　", f"{draw.random()}."])
            rows.append((conv, draw.choice([t, t, t + 2, None]), role, text))
    return rows


@pytest.mark.parametrize("length", range(6))
def test_search_is_exact(length):
    draw = random.Random(length)
    symbols = [(i, f) for i in "suax" for f in (None, "truncated")] + [("u", "blank")]
    cases = list(itertools.product(symbols, repeat=length)) if length < 4 else [draw.choices(symbols, k=length + 3) for _ in range(300)]
    for case in cases:
        rows = "".join("-" if f == "blank" else i.upper() if f else i for i, f in case)
        assert C.search(rows, C.START, C.ENDS) == plain_repair(case), rows


def test_stretches_join_to_the_whole():
    draw = random.Random(5)
    for _ in range(60):
        rows = "".join(draw.choices("suauauaxSUA-", k=draw.randrange(1, 40)))
        cut = sorted({0, len(rows), *(draw.randrange(len(rows) + 1) for _ in range(3))})
        told = []
        for lo, hi in itertools.pairwise(cut):
            found = [C.search(rows[lo:hi], a, (b,)) for a in C.STATES for b in C.STATES]
            told.append((1, 0, 0, None, None, 0, 0, 0, 0, 0, "u", "u", [f and f[0] for f in found], [f and f[1] for f in found]))
        (joined,) = C._join_stretches(iter(told))
        assert joined[-2:] == C.search(rows, C.START, C.ENDS), rows


def test_long_rows_take_bounded_work():
    rows = "".join(random.Random(1).choices("uaUAsx-", k=3000))
    cost, audit = C.search(rows, C.START, C.ENDS)
    assert len(audit.replace("I", "")) == 3000 and cost > 0


def test_query_is_the_contract(spark):
    from wardline.llm.queries import op12_conversation_repair

    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert result(op12_conversation_repair(spark, "/root/testdata/sf0.001")) == brute(rows)


def test_odd_rows(spark):
    rows = [*made(150, 3), (None, None, None, None), (None, 1, "user", "a"), (900, None, "user", "x." * 60_000), (900, 1, "assistant", "y" * 200_000), (901, 5, "user", "Q?"), (901, 5, "user", "Q?"), (901, 9, "assistant", "Q?")]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"copies": F.lit("clash"), "kind": F.lit(1), "c": F.lit(2), "n": F.lit(3)})
    assert result(C.repair(C.damage(df))) == brute(rows)
    assert result(C.repair(C.damage(df.where("false")))) == {}


def test_long_conversations(spark):
    """Both ways give the same: conversations that are read whole, and stretches of 7 rows."""
    draw, rows = random.Random(8), [*made(40, 4, turns=25)]
    rows += [(500, draw.choice([*range(90), None]), draw.choice(["user", "assistant", "system"]), draw.choice(["Yes.", "no", f"{t}.", ""])) for t in range(120)]
    rows += [(501, 3, "user", "Again.")] * 90 + [(502, t, ("user", "assistant")[t % 2], f"{t}.") for t in range(100)] + [(None, t, "user", f"{t}?") for t in range(30)]
    df = C.damage(spark.createDataFrame(rows, SCHEMA)).repartition(5)
    want = brute(rows)
    assert result(C.repair(df, stretch=7)) == want
    assert result(C.repair(df, most_bytes=30)) == want
    whole = result(C.repair(df))
    assert whole == want
    one, two = (sorted(map(tuple, C.repaired_turns(df, stretch=s).collect()), key=repr) for s in (7, 1024))
    assert one == two and {r[4] for r in one} == {"K", "R", "I"}
    lines = {}
    for c, _, role, text, _ in sorted(one, key=lambda r: (str(r[0]), r[1])):
        lines.setdefault(c, []).append(f"{role}:{text}")
    assert all(hashlib.sha256("\n".join(v).encode()).hexdigest() == want[c][-1] for c, v in lines.items())
