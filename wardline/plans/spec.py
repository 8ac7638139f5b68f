"""Declared variables compiled to extracts: one plan for all variables that share a window, table and selection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.operators.typing_ops import any_of, period_label, window_filter
from wardline.operators.windows import nth_row


@dataclass(frozen=True)
class VariableSpec:
    """One extract: facts of some variables around an index row's anchors.

    ``anchors`` are columns of the index; None leaves a side open. ``nth``: first (1, 2, ..) or last (-1, ..) row a
    subject and variable, of one time the least ``value_order`` (an SQL expression) first; ``aggregate``: avg, max, min, sum or
    count, with the count beside it. ``branches``: predicates over the fact and the anchors of which one must hold;
    ``period``: two anchors by which a fact is before, within or after.
    """

    name: str
    table: str
    variables: tuple[str, ...] = ()
    key: str = "person_id"
    low: str | None = None
    high: str | None = None
    before: str = "0 SECONDS"
    after: str = "0 SECONDS"
    dates: bool = False
    nth: int | None = None
    aggregate: str | None = None
    where: str | None = None
    lookup: str = "inner"
    fields: tuple[str, ...] = field(default=())
    branches: tuple[str, ...] = ()
    period: tuple[str, str] | None = None
    value_order: str | None = None


@dataclass(frozen=True)
class FactTable:
    """Where a table has its variable, time, value and unique column."""

    variable: str
    at: str
    value: str
    unique: str


def compile_spec(specs: Sequence[VariableSpec], index: DataFrame, tables: Mapping[str, DataFrame], shapes: Mapping[str, FactTable], *, subject: str) -> dict[str, DataFrame]:
    """An extract for each spec.

    Specs that share table, key, window and selection become one plan, whose rows are told apart by variable; Spark reads it
    once for each extract that is used, unless the caller writes the shared rows.
    """
    groups: dict[tuple, list[VariableSpec]] = {}
    for s in specs:
        groups.setdefault((s.table, s.key, s.low, s.high, s.before, s.after, s.dates, s.nth, s.aggregate, s.where, s.lookup, s.fields, s.branches, s.period, s.value_order), []).append(s)
    out = {}
    for members in groups.values():
        s, shape = members[0], shapes[members[0].table]
        facts = tables[s.table]
        wanted = {v for m in members for v in m.variables}
        if wanted and s.lookup == "inner":
            facts = facts.where(F.col(shape.variable).isin(*sorted(wanted)))
        if s.where:
            facts = facts.where(s.where)
        facts = facts.drop(*(c for c in index.columns if c != s.key))
        base = index.select(*dict.fromkeys((subject, s.key, *index.columns)))  # unused anchors are pruned by the optimizer
        col = lambda c: F.col(c) if c else None
        rows = facts.join(base, s.key).where(window_filter(F.col(shape.at), col(s.low), col(s.high), before=s.before, after=s.after, dates=s.dates))
        rows = rows.where(any_of([F.expr(b) for b in s.branches])) if s.branches else rows
        labels = [period_label(F.col(shape.at), F.col(s.period[0]), F.col(s.period[1])).alias("period")] if s.period else []
        rows = rows.withColumnRenamed(shape.variable, "variable_name") if shape.variable != "variable_name" else rows
        if s.nth:
            rows = rows.withColumn("_by_value", F.expr(s.value_order or "1"))
            rows = nth_row(rows, [subject, "variable_name"], [shape.at, "_by_value", shape.unique], s.nth).drop("_by_value")
        if s.aggregate:
            rows = rows.groupBy(subject, "variable_name", *s.fields).agg(getattr(F, s.aggregate)(shape.value).alias("value"), F.count(shape.value).alias("n"))
        else:
            rows = rows.select(subject, "variable_name", F.col(shape.at).alias("fact_at"), F.col(shape.value).alias("value"), shape.unique, *s.fields, *labels)
        for m in members:
            out[m.name] = rows.where(F.col("variable_name").isin(*m.variables)) if len(members) > 1 and m.variables else rows
    return out


def load_variables(extracts: Mapping[str, DataFrame], specs: Sequence[VariableSpec], names: Sequence[str]) -> DataFrame:
    """Rows of named variables from the extracts that declare them, stacked by name of column."""
    parts = [extracts[s.name].where(F.col("variable_name").isin(*names)) for s in specs if not s.variables or set(s.variables) & set(names)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
