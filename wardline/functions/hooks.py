"""User functions: aggregates by name or callable, overlap rules, and frame-to-frame steps."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Aggregate = Callable[[Column], Column]
_NAMED: dict[str, Aggregate] = {
    "first": lambda x: F.first(x, ignorenulls=True), "last": lambda x: F.last(x, ignorenulls=True), "min": F.min, "max": F.max, "sum": F.sum, "mean": F.avg, "median": F.median,
    "count": F.count, "distinct": F.count_distinct, "std": F.stddev_samp, "any": lambda x: F.max(x.cast("int")), "range": lambda x: F.max(x) - F.min(x),
}


def register_aggregate(name: str, function: Aggregate) -> None:
    """Make an aggregate known by a name; the function may wrap a grouped-aggregate pandas UDF."""
    _NAMED[name] = function


def aggregate(spec: str | Aggregate) -> Aggregate:
    return spec if callable(spec) else _NAMED[spec]


def aggregate_by(df: DataFrame, by: Sequence[str], actions: dict[str, str | Aggregate]) -> DataFrame:
    """Columns of a group by an action each, named or callable."""
    return df.groupBy(*by).agg(*(aggregate(a)(F.col(c)).alias(c) for c, a in actions.items()))


def condense_custom(df: DataFrame, *, by: Sequence[str], start: str, end: str, islands: Callable[[pd.DataFrame], pd.Series]) -> DataFrame:
    """Condense intervals by a rule of the user: a function from a group's rows, by start, to an island number each.

    The rule sees one group as a whole, so a group must fit in a task; ``condense_running`` takes rules that only need
    the open interval, for groups of any size, and ``condense_intervals`` covers the common rules without Python.
    A task hands the rule one group after the other and condenses a batch of groups at once.
    """
    types = dict(df.dtypes)
    schema = ", ".join(f"`{c}` {types[c]}" for c in (*by, start, end)) + ", n_merged long"

    def condense(rows: pd.DataFrame, heads: list[int]) -> pd.DataFrame:
        """Whole groups in order; ``heads`` are the places of their first rows."""
        found = []
        for lo, hi in pairwise([*heads, len(rows)]):
            g = rows.iloc[lo:hi].reset_index(drop=True)
            found.append(g.assign(_i=islands(g))["_i"])
        rows = rows.assign(_g=np.repeat(np.arange(len(heads)), np.diff([*heads, len(rows)])), _i=pd.concat(found).to_numpy())
        out = rows.groupby(["_g", "_i"], dropna=False).agg(**{c: (c, "first") for c in by}, **{start: (start, "min"), end: (end, "max"), "n_merged": (start, "size")})
        return out.reset_index(drop=True)[[*by, start, end, "n_merged"]]

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []  # the last group so far
        for frame in frames:
            heads = np.flatnonzero(frame["_head"].to_numpy(bool))
            frame, cut = frame.drop(columns="_head"), int(heads[-1]) if len(heads) else None
            if cut is None:
                held.append(frame)
                continue
            whole = [*held, frame.iloc[:cut]]
            before, held = sum(map(len, held)), [frame.iloc[cut:]]
            if before + cut:
                places = [before + int(h) for h in heads[:-1]]
                yield condense(pd.concat(whole, ignore_index=True), places if not before else [0, *places])
        if held:
            yield condense(pd.concat(held, ignore_index=True), [0])

    def run(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values([start, end])
        out = g.assign(_i=islands(g)).groupby([*by, "_i"], dropna=False).agg(**{start: (start, "min"), end: (end, "max"), "n_merged": (start, "size")}).reset_index()
        return out[[*by, start, end, "n_merged"]]

    spans = df.select(*by, start, end)
    keyed = reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in by))
    w = Window.partitionBy(*by).orderBy(F.asc_nulls_last(start), F.asc_nulls_last(end))
    # the window leaves a task's rows in its order
    many = spans.where(keyed).withColumn("_head", F.row_number().over(w) == 1).mapInPandas(batches, schema)
    # beside a null, pandas would turn whole numbers of other groups to floats
    return many.union(spans.where(~keyed).groupBy(*by).applyInPandas(run, schema))


def condense_running(df: DataFrame, *, by: Sequence[str], start: str, end: str, joins: Callable[[int, int, int, int], bool]) -> DataFrame:
    """Condense intervals by a rule of the user: whether a row (start, end) joins the open interval (start, end), in microseconds.

    A task reads its groups in order of start and end and remembers the open interval only, so a group of any length
    takes the memory of one batch. Rows with a null start or end are left out; an empty table gives no rows.
    """
    spans = df.where(F.col(start).isNotNull() & F.col(end).isNotNull()).select(*by, F.unix_micros(start).alias("_s"), F.unix_micros(end).alias("_e"))
    w = Window.partitionBy(*by).orderBy("_s", "_e")
    rows = spans.withColumn("_head", F.row_number().over(w) == 1).repartition(*by).sortWithinPartitions(*by, "_s", "_e", F.desc("_head"))
    keys = rows.select(*by).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None  # the keys of the open interval, one row
        s, e, n = 0, 0, 0
        for batch in batches:
            done: list[tuple[int, int, int]] = []
            places: list[int] = []  # rows of the batch that opened an interval
            before = held
            for k, (head, s2, e2) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("_head", "_s", "_e")))):
                if n and not head and joins(s, e, s2, e2):
                    s, e, n = min(s, s2), max(e, e2), n + 1
                    continue
                if n:
                    done.append((s, e, n))
                s, e, n = s2, e2, 1
                places.append(k)
            if not places:
                continue
            own = batch.select(list(by))
            held = own.slice(places[-1], 1)
            closed = own.take(pa.array(places[:-1], pa.int64()))
            if before is not None:
                closed = pa.Table.from_batches([before, closed]).combine_chunks()
            columns = [closed.column(i) for i in range(len(by))]
            columns = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns]
            yield from _spans(columns, list(by), done)
        if held is not None:
            yield from _spans([held.column(i) for i in range(len(by))], list(by), [(s, e, n)])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keys) + ", _s long, _e long, n_merged long"
    kind = dict(df.dtypes)
    back = lambda c, name: F.timestamp_micros(c).cast(kind[name]).alias(name)
    return rows.mapInArrow(run, schema).select(*by, back("_s", start), back("_e", end), "n_merged")


def _spans(keys: list[pa.Array], names: list[str], spans: list[tuple[int, int, int]]) -> Iterator[pa.RecordBatch]:
    if spans:
        yield pa.RecordBatch.from_arrays([*keys, *(pa.array(x, pa.int64()) for x in zip(*spans))], names=[*names, "_s", "_e", "n_merged"])


def steps(df: DataFrame, *functions: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Frame-to-frame functions one after the other."""
    for f in functions:
        df = df.transform(f)
    return df
