"""Personal data: regular expressions propose spans, checksums confirm them, context words adjust the score.

Only DataFrame functions: for each kind, one regular expression cuts the text into the pieces between matches and
yields the matches, and a fold over both gives positions in code points. No row leaves its task.

Kinds: e-mail, IP address, card number (Luhn), international phone number; beyond these, bank account numbers
(mod 97) and identity numbers, which need a context word nearby. Matches are leftmost and non-overlapping within
a kind; a match that fails its test is dropped and not retried.

Edge cases: null texts are empty and have no spans; ids may repeat or be null; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import text_or_empty


def _start(chars: str) -> str:
    """A match can only begin at the start of a run of ``chars`` or where the last match ended: long runs then cost linear time."""
    return rf"(?:(?<![{chars}])|\G)"


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    guard: str  # a text without it has no match
    context: str  # words before a match that raise its score
    score: float
    base: bool = True

    def valid(self, m: Column) -> Column:
        return F.lit(True)


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn checksum."""
    r = F.reverse(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(r, i, F.lit(1)).cast("int")
        twice = d * 2 - F.when(d > 4, 9).otherwise(0)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def mod97(account: Column) -> Column:
    """Whether an account number (letters and digits) has remainder 1 modulo 97, its first four characters last."""
    moved = F.concat(F.substring(account, 5, 1000), F.substring(account, 1, 4))

    def add(rest: Column, c: Column) -> Column:
        letter = F.ascii(c) - 55  # A is 10
        return F.when(c.between("0", "9"), (rest * 10 + F.ascii(c) - 48) % 97).otherwise((rest * 100 + letter) % 97)

    return F.aggregate(F.split(moved, ""), F.lit(0), lambda a, c: F.when(c == "", a).otherwise(add(a, c))) == 1


class Card(Kind):
    def valid(self, m: Column) -> Column:
        digits = F.regexp_replace(m, "[ -]", "")
        return F.when(F.length(digits).between(16, 19), luhn(digits)).otherwise(False)


class Ip(Kind):
    def valid(self, m: Column) -> Column:
        part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
        return m.rlike(rf"^{part}(?:\.{part}){{3}}$")


class Phone(Kind):
    def valid(self, m: Column) -> Column:
        return F.length(F.regexp_replace(m, "[^0-9]", "")).between(8, 15)


class Account(Kind):
    def valid(self, m: Column) -> Column:
        plain = F.regexp_replace(m, " ", "")
        return F.when(F.length(plain).between(15, 34), mod97(plain)).otherwise(False)


class Identity(Kind):
    def valid(self, m: Column) -> Column:
        return ~m.rlike("^(?:000|666|9)") & ~m.rlike("-00-") & ~m.rlike("0000$")


KINDS: tuple[Kind, ...] = (
    Kind("email", _start("A-Za-z0-9._%+-") + r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", "e-?mail|mail|contact|write|address", 0.9),
    Ip("ip", _start("0-9") + r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]", "ip|host|server|address|login", 0.7),
    Card("card", r"[0-9](?:[ -]?[0-9])++", r"[0-9](?:[ -]?[0-9]){15}", "card|visa|credit|debit|account|payment", 0.8),
    Phone("phone", r"\+[0-9][ ().0-9-]+[0-9]", r"\+[0-9]", "phone|tel|call|mobile|fax|contact", 0.7),
    Account("iban", _start("A-Za-z0-9") + r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])", r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11}", "iban|account|bank|transfer", 0.8, False),
    Identity("identity", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", "ssn|social|security|identity|id", 0.3, False),
)
NEAR, BONUS, LEAST = 40, 0.1, 0.35


def context_pattern(words: str) -> str:
    return rf"(?:^|[^a-z])(?:{words})(?:[^a-z]|$)"


def found(kind: Kind, text: Column) -> Column:
    """Struct (n, spans, scores) of a kind: spans as kind:start:end, comma-joined."""
    pieces = F.split(text, kind.pattern, -1)
    matches = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))

    def both(before: Column, m: Column) -> Column:
        near = F.lower(F.substring(before, -NEAR, NEAR)).rlike(context_pattern(kind.context))
        score = F.lit(kind.score) + F.when(near, BONUS).otherwise(0.0)
        ok = F.coalesce(kind.valid(m), F.lit(False)) & m.isNotNull()
        if not kind.base:
            ok = ok & (score >= LEAST)
        return F.struct(F.length(before).alias("gap"), F.coalesce(F.length(m), F.lit(0)).alias("len"), ok.alias("ok"), score.alias("score"))

    def add(acc: Column, x: Column) -> Column:
        start, end = acc.at + x.gap, acc.at + x.gap + x.len
        span = F.concat(F.lit(f",{kind.name}:"), start.cast("string"), F.lit(":"), end.cast("string"))
        return F.struct(
            end.alias("at"),
            (acc.n + x.ok.cast("long")).alias("n"),
            F.when(x.ok, F.concat(acc.spans, span)).otherwise(acc.spans).alias("spans"),
            F.when(x.ok, F.concat(acc.scores, F.lit(","), F.format_string("%.2f", x.score))).otherwise(acc.scores).alias("scores"),
        )

    none = F.struct(F.lit(0).alias("at"), F.lit(0).cast("long").alias("n"), F.lit("").alias("spans"), F.lit("").alias("scores"))
    return F.when(text.rlike(kind.guard), F.aggregate(F.zip_with(pieces, matches, both), none, add)).otherwise(none)


def find_personal_data(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """Rows (doc_id, n_<kind> for each kind, base_sha256, spans, scores), one for each input row."""
    texts = docs.select(F.col(id_column).alias("doc_id"), text_or_empty(text_column).alias("text"))
    cut = texts.select("doc_id", *(found(k, F.col("text")).alias(k.name) for k in kinds))
    joined = lambda field, some: F.substring(F.concat(*(F.col(f"{k.name}.{field}") for k in some)), 2, 2**31 - 1)
    base = [k for k in kinds if k.base]
    counts = [F.col(f"{k.name}.n").alias(f"n_{k.name}") for k in kinds]
    return cut.select("doc_id", *counts, F.sha2(joined("spans", base), 256).alias("base_sha256"), joined("spans", kinds).alias("spans"), joined("scores", kinds).alias("scores"))


def redact(docs: DataFrame, *, text_column: str = "text", kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """The rows with each confirmed span of their text replaced by its kind in angle brackets; null texts stay null.

    Kinds go in order; each sees the text that the ones before have left.
    """
    text = F.col(text_column)
    for k in kinds:
        pieces, matches = F.split(text, k.pattern, -1), F.regexp_extract_all(text, F.lit(k.pattern), F.lit(0))
        docs = docs.withColumn(text_column, F.when(text.rlike(k.guard), F.array_join(F.zip_with(pieces, matches, _replacer(k)), "")).otherwise(text))
    return docs


def _replacer(k: Kind):
    def both(before: Column, m: Column) -> Column:
        near = F.lower(F.substring(before, -NEAR, NEAR)).rlike(context_pattern(k.context))
        ok = F.coalesce(k.valid(m), F.lit(False)) & (F.lit(k.base) | (F.lit(k.score) + F.when(near, BONUS).otherwise(0.0) >= LEAST))
        return F.concat(before, F.when(m.isNull(), "").when(ok, F.lit(f"<{k.name}>")).otherwise(m))

    return both


def sql(kinds: tuple[Kind, ...] = KINDS) -> str:
    """DuckDB SQL of ``find_personal_data`` over documents."""
    plain = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+",
        "card": r"[0-9](?:[ -]?[0-9])+",
        "phone": r"\+[0-9][ ().0-9-]+[0-9]",
        "iban": r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}\b",
        "identity": r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b",
    }
    part = "0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
    digit = "cast(substr(reverse(regexp_replace(x.m, '[ -]', '', 'g')), i, 1) as int)"
    tests = {
        "email": "true",
        "ip": rf"regexp_matches(x.m, '^{part}(\.{part}){{3}}$')",
        "card": f"length(regexp_replace(x.m, '[ -]', '', 'g')) between 16 and 19 and list_sum([case when i % 2 = 1 then {digit} when {digit} > 4 then {digit} * 2 - 9 else {digit} * 2 end for i in range(1, length(regexp_replace(x.m, '[ -]', '', 'g')) + 1)]) % 10 = 0",
        "phone": "length(regexp_replace(x.m, '[^0-9]', '', 'g')) between 8 and 15",
        "iban": "length(replace(x.m, ' ', '')) between 15 and 34 and list_reduce(list_prepend(0, [case when c between '0' and '9' then ascii(c) - 48 else ascii(c) - 55 end for c in string_split(substr(replace(x.m, ' ', ''), 5) || substr(replace(x.m, ' ', ''), 1, 4), '')]), lambda a, v: case when v < 10 then (a * 10 + v) % 97 else (a * 100 + v) % 97 end) = 1",
        "identity": "not regexp_matches(x.m, '^(000|666|9)') and x.m not like '%-00-%' and x.m not like '%0000'",
    }
    steps, picks = [], []
    for k in kinds:
        score = f"{k.score} + case when regexp_matches(lower(right(x.p, {NEAR})), '{context_pattern(k.context)}') then {BONUS} else 0.0 end"
        ok = tests[k.name] + ("" if k.base else f" and {score} >= {LEAST}")
        steps.append(
            f"""{k.name}_m as (select row, string_split_regex(t, '{plain[k.name]}') p, regexp_extract_all(t, '{plain[k.name]}') m from d where regexp_matches(t, '{plain[k.name]}')),
{k.name}_x as (select row, [struct_pack(p := p[i], m := m[i], s := list_sum([length(q) for q in p[1:i]]) + coalesce(list_sum([length(q) for q in m[1:i - 1]]), 0)) for i in range(1, len(m) + 1)] xs from {k.name}_m),
{k.name} as (select row, count(*) n, string_agg('{k.name}:' || cast(x.s as bigint) || ':' || cast(x.s + length(x.m) as bigint), ',' order by x.s) spans,
 string_agg(printf('%.2f', cast({score} as double)), ',' order by x.s) scores from (select row, unnest(xs) x from {k.name}_x) where {ok} group by row)"""
        )
        picks.append(k.name)
    spans = lambda field, some: f"concat_ws(',', {', '.join(f'{k.name}.{field}' for k in some)})"
    return (
        "with d as (select row_number() over () row, doc_id, coalesce(text, '') t from documents),\n"
        + ",\n".join(steps)
        + "\nselect doc_id, "
        + ", ".join(f"coalesce({n}.n, 0) n_{n}" for n in picks)
        + f", sha256({spans('spans', [k for k in kinds if k.base])}) base_sha256, {spans('spans', kinds)} spans, {spans('scores', kinds)} scores from d "
        + " ".join(f"left join {n} using (row)" for n in picks)
    )
