"""Intervals: condensing, priorities, timelines, grids, clipping, exposure."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardline.functions.scalars import nearest_second


def condense_intervals(df: DataFrame, *, by: Sequence[str], start: str, end: str, gap: str = "0 SECONDS", aggregates: dict[str, Callable[[Column], Column]] | None = None) -> DataFrame:
    """Merge intervals of a group that overlap, touch, or lie within ``gap``; other columns by an aggregate each.

    Sort-based: an interval opens a new island when it starts after the latest end so far, plus the gap. Rows
    with a null start or end are left out.
    """
    w = Window.partitionBy(*by).orderBy(start, end)
    before = F.max(F.col(end) + F.expr(f"INTERVAL {gap}")).over(w.rowsBetween(Window.unboundedPreceding, -1))
    rows = df.where(F.col(start).isNotNull() & F.col(end).isNotNull()).withColumn("_new", (before.isNull() | (F.col(start) > before)).cast("int"))
    rows = rows.withColumn("_island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    extra = [f(F.col(c)).alias(c) for c, f in (aggregates or {}).items()]
    return rows.groupBy(*by, "_island").agg(F.min(start).alias(start), F.max(end).alias(end), F.count("*").alias("n_merged"), *extra).drop("_island")


def floor_ceil_condense(df: DataFrame, *, by: Sequence[str], start: str, end: str, unit: str = "hour") -> DataFrame:
    """Widen intervals to whole units, then condense."""
    up = F.when(F.date_trunc(unit, end) < F.col(end), F.date_trunc(unit, end) + F.expr(f"INTERVAL 1 {unit}")).otherwise(F.col(end))
    return condense_intervals(df.withColumns({start: F.date_trunc(unit, start), end: up}), by=by, start=start, end=end)


def segments(df: DataFrame, *, by: Sequence[str], start: str, end: str) -> DataFrame:
    """Elementary segments: the stretches between neighbouring boundaries of a group."""
    edges = df.select(*by, F.explode(F.array(start, end)).alias("seg_start")).where(F.col("seg_start").isNotNull()).distinct()
    w = Window.partitionBy(*by).orderBy("seg_start")
    return edges.withColumn("seg_end", F.lead("seg_start").over(w)).where(F.col("seg_end").isNotNull())


def _covered(df: DataFrame, by: Sequence[str], start: str, end: str) -> DataFrame:
    """A row for each elementary segment and each interval over it.

    An interval begins and ends at boundaries, so it covers the segments numbered from one to the other: the numbers
    come by equality, and no segment is compared with an interval that does not cover it. Intervals of no length cover nothing.
    """
    w = Window.partitionBy(*by).orderBy("seg_start")
    seg = segments(df, by=by, start=start, end=end).withColumn("_seg", F.row_number().over(w))
    first = seg.select(*by, F.col("seg_start").alias(start), F.col("_seg").alias("_from"))
    last = seg.select(*by, F.col("seg_end").alias(end), F.col("_seg").alias("_to"))
    rows = df.where(F.col(start) < F.col(end)).join(first, [*by, start]).join(last, [*by, end])
    return rows.withColumn("_seg", F.explode(F.sequence("_from", "_to"))).drop("_from", "_to").join(seg, [*by, "_seg"]).drop("_seg")


#: Priorities that one sweep tells apart; more go in rounds, so many of the neighbouring ones at a time.
WIDTH = 16


def _equal_neighbours(df: DataFrame, by: Sequence[str], start: str, end: str, label: str) -> DataFrame:
    """Disjoint intervals of a group that touch and have one label become one."""
    w = Window.partitionBy(*by).orderBy(start)
    new = F.coalesce((F.lag(label).over(w) != F.col(label)) | (F.lag(end).over(w) < F.col(start)), F.lit(True)).cast("int")
    runs = df.withColumn("_new", new).withColumn("_run", F.sum("_new").over(w))
    return runs.groupBy(*by, "_run", label).agg(F.min(start).alias(start), F.max(end).alias(end)).drop("_run")


def _sweep(df: DataFrame, by: Sequence[str], start: str, end: str, label: str, width: int) -> DataFrame:
    """Classes (_class) of disjoint intervals; of ``width`` neighbouring classes the first one that is there at an instant wins.

    One stream of boundaries, read by one window: beside each boundary stands the last interval that began in each of the classes, and as those of a
    class are disjoint, it is the only one that can still last. So there is a row for each boundary, however many intervals lie over it.
    """
    group = [*by, "_class"]
    payload = F.struct(F.col(end).alias("e"), F.col(label).alias("l"))
    slot = F.pmod("_class", F.lit(width)).cast("int")
    both = F.array(F.struct(F.col(start).alias("t"), slot.alias("k"), payload.alias("p")), F.struct(F.col(end).alias("t"), F.lit(-1).alias("k"), F.lit(None).cast(df.select(payload.alias("p")).schema["p"].dataType).alias("p")))
    events = df.select(*by, F.floor(F.col("_class") / width).cast("int").alias("_class"), F.explode(both).alias("x")).select(*group, "x.*")
    order = Window.partitionBy(*group).orderBy("t")  # up to and with all boundaries of one instant
    last = [F.last(F.when(F.col("k") == i, F.col("p")), ignorenulls=True).over(order).alias(f"_p{i}") for i in range(width)]
    rows = events.select(*group, "t", F.lead("t").over(order).alias("_next"), *last).where(F.col("_next") > F.col("t"))
    won = F.coalesce(*(F.when(F.col(f"_p{i}.e") > F.col("t"), F.col(f"_p{i}")) for i in range(width)))
    found = rows.select(*group, F.col("t").alias(start), F.col("_next").alias(end), won.alias("_won")).where(F.col("_won").isNotNull())
    return _equal_neighbours(found.select(*group, start, end, F.col("_won.l").alias(label)), group, start, end, label)


def resolve_overlaps(df: DataFrame, *, by: Sequence[str], start: str, end: str, priority: str, label: str, max_len: str | None = None, levels: int = WIDTH) -> DataFrame:
    """At each instant the label of least priority number wins, then of the earliest start, then the least label; output is disjoint, equal neighbours merged.

    Not a grid, and no interval meets another. Within a priority the earlier start wins while it lasts, so what an interval wins there begins where all before it have ended: a
    running maximum. Between priorities a sweep over the boundaries follows. A group is shuffled once; its work is that of sorting it, whatever its overlaps.
    ``levels`` bounds the different priorities of a group (a greater number of them is an error, not a wrong result); an interval counts for at most ``max_len`` from its start.
    Intervals of no length win nothing; a null priority comes first.
    """
    if max_len:
        df = df.withColumn(end, F.least(F.col(end), F.col(start) + F.expr(f"INTERVAL {max_len}")))
    rank = F.dense_rank().over(Window.partitionBy(*by).orderBy(priority)) - 1
    rows = df.where(F.col(start) < F.col(end)).select(*by, start, end, F.col(label), rank.alias("_class"))
    bounded = F.when(F.col("_class") < levels, F.col("_class")).otherwise(F.raise_error(F.lit(f"more than {levels} priorities in a group: raise levels")).cast("int"))
    before = Window.partitionBy(*by, "_class").orderBy(start, label).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_class", bounded).withColumn("_cover", F.max(end).over(before))
    rows = rows.withColumn(start, F.greatest(start, "_cover")).where(F.col(start) < F.col(end)).drop("_cover")
    left = max(levels, 2)
    while left > 1:
        rows = _sweep(rows, by, start, end, label, min(left, WIDTH))
        left = -(-left // WIDTH)
    return rows.select(*by, label, start, end)


def timeline(df: DataFrame, *, by: Sequence[str], start: str, end: str, id_column: str, seconds: int | None = None) -> DataFrame:
    """Which intervals are active in each elementary segment, as a sorted list of ids: as much work as the lists are long.

    With ``seconds``, intervals are first widened to whole steps of that length.
    """
    if seconds:
        step = lambda c, round_: F.timestamp_seconds(round_(F.unix_micros(c) / (seconds * 1_000_000)) * seconds)
        df = df.withColumns({start: step(F.col(start), F.floor), end: step(F.col(end), F.ceil)})
    return _covered(df, by, start, end).groupBy(*by, "seg_start", "seg_end").agg(F.array_sort(F.collect_set(id_column)).alias("active"))


def active_counts(df: DataFrame, *, by: Sequence[str], start: str, end: str) -> DataFrame:
    """How many intervals are active in each elementary segment where any is: running sums over starts and ends, a row for each boundary."""
    some = df.where(F.col(start) < F.col(end))
    both = F.array(F.struct(F.col(start).alias("seg_start"), F.lit(1).alias("d")), F.struct(F.col(end).alias("seg_start"), F.lit(-1).alias("d")))
    steps = some.select(*by, F.explode(both).alias("x")).select(*by, "x.*").groupBy(*by, "seg_start").agg(F.sum("d").alias("d"))
    w = Window.partitionBy(*by).orderBy("seg_start")
    return steps.select(*by, "seg_start", F.lead("seg_start").over(w).alias("seg_end"), F.sum("d").over(w).alias("n_active")).where("n_active > 0")


def components(df: DataFrame, *, by: Sequence[str], start: str, end: str, gap: str = "0 SECONDS") -> DataFrame:
    """Each interval with the number of its connected component: intervals that overlap, touch, or lie within ``gap``."""
    w = Window.partitionBy(*by).orderBy(start, end)
    before = F.max(F.col(end) + F.expr(f"INTERVAL {gap}")).over(w.rowsBetween(Window.unboundedPreceding, -1))
    new = (before.isNull() | (F.col(start) > before)).cast("int")
    return df.where(F.col(start).isNotNull() & F.col(end).isNotNull()).withColumn("_new", new).withColumn("component", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def intersections(df: DataFrame, *, by: Sequence[str], start: str, end: str, id_column: str) -> DataFrame:
    """Pairs of intervals of a group that share some time, and what they share.

    The later of two begins in a segment that the earlier covers, so pairs meet by equality on the number of that segment.
    """
    w = Window.partitionBy(*by).orderBy("seg_start")
    seg = segments(df, by=by, start=start, end=end).withColumn("_seg", F.row_number().over(w))
    first = seg.select(*by, F.col("seg_start").alias(start), F.col("_seg").alias("_from"))
    last = seg.select(*by, F.col("seg_end").alias(end), F.col("_seg").alias("_to"))
    rows = df.select(*by, start, end, id_column).where(F.col(start) < F.col(end)).join(first, [*by, start]).join(last, [*by, end])
    over = rows.select(*by, F.explode(F.sequence("_from", "_to")).alias("_from"), F.col(id_column).alias("_id"), F.col(start).alias("_s"), F.col(end).alias("_e"))
    pairs = rows.join(over, [*by, "_from"]).where((F.col("_s") < F.col(start)) | (F.col("_s") == F.col(start)) & (F.col("_id") < F.col(id_column)))
    return pairs.select(*by, F.col("_id").alias("earlier"), F.col(id_column).alias("later"), F.col(start).alias("shared_from"), F.least("_e", end).alias("shared_to"))


def expand_to_grid(df: DataFrame, *, start: str, end: str, step: str, name: str = "at") -> DataFrame:
    """A row for each step from start to end, both included."""
    return df.where(F.col(start) <= F.col(end)).withColumn(name, F.explode(F.sequence(F.col(start), F.col(end), F.expr(f"INTERVAL {step}"))))


def trim_to_bounds(df: DataFrame, bounds: DataFrame, *, key: str, start: str, end: str, low: str, high: str) -> DataFrame:
    """Intervals clipped to their key's bounds; those outside go. For points, start and end may be one column."""
    inside = df.join(bounds, key).where((F.col(end) >= F.col(low)) & (F.col(start) <= F.col(high)))
    return inside.withColumns({start: F.greatest(start, low), end: F.least(end, high)}).drop(low, high)


def with_bounds(df: DataFrame, bounds: DataFrame, *, key: str, at: str, low: str, high: str) -> DataFrame:
    """Points within their key's bounds, and a row at each bound where no point stands; ``observed`` tells them apart."""
    inside = df.join(bounds.select(key, low, high), key).where(F.col(at).between(F.col(low), F.col(high))).drop(low, high).withColumn("observed", F.lit(1))
    edges = bounds.select(key, F.explode(F.array_distinct(F.array(low, high))).alias(at)).where(F.col(at).isNotNull())
    return inside.unionByName(edges.join(inside.select(key, at), [key, at], "left_anti").withColumn("observed", F.lit(0)), allowMissingColumns=True)


def exposure_duration(anchors: DataFrame, events: DataFrame, *, key: str, anchor: str, horizons: dict[str, int], start: str, end: str) -> DataFrame:
    """Days (fractions too) of events within [anchor, anchor + h days] for each horizon; under 1e-3 counts as 0."""
    e = events.select(F.col(key).alias("_k"), F.col(start).alias("_s"), F.col(end).alias("_e"))
    joined = anchors.join(e, F.col(key) == F.col("_k"), "left")
    seconds = lambda c: F.unix_micros(c) / 1e6
    sums = []
    for name, days in horizons.items():
        stop = F.col(anchor) + F.expr(f"INTERVAL {days} DAYS")
        part = F.greatest(F.lit(0.0), F.least(seconds(F.col("_e")), seconds(stop)) - F.greatest(seconds(F.col("_s")), seconds(F.col(anchor)))) / 86400
        total = F.coalesce(F.sum(part), F.lit(0.0))
        sums.append(F.when(total < 1e-3, 0.0).otherwise(total).alias(name))
    return joined.groupBy(*anchors.columns).agg(*sums)


def calendar_days(anchors: DataFrame, events: DataFrame, *, key: str, anchor: str, days: int, start: str, end: str) -> DataFrame:
    """Distinct calendar days with an event among the first ``days`` from the anchor's; and days to the first event."""
    e = events.select(F.col(key).alias("_k"), F.to_date(start).alias("_s"), F.to_date(end).alias("_e"))
    first, last = F.to_date(anchor), F.date_add(F.to_date(anchor), days - 1)
    on = (F.col(key) == F.col("_k")) & (F.col("_s") <= last) & (F.col("_e") >= first)
    touched = anchors.join(e, on, "left")
    day = F.explode_outer(F.when(F.col("_k").isNotNull(), F.sequence(F.greatest("_s", first), F.least("_e", last))))
    return touched.select(*anchors.columns, day.alias("_day")).groupBy(*anchors.columns).agg(F.count_distinct("_day").alias("exposed_days"), F.min(F.datediff("_day", first)).alias("days_to_first"))


def event_free_days(exposed: Column, days: int, death_day: Column | None = None) -> tuple[Column, Column]:
    """Days without event, and days alive and without event, of the first ``days``."""
    free = F.greatest(F.lit(0), days - exposed)
    if death_day is None:
        return free, free
    dead = F.when(death_day < days, days - F.greatest(death_day, F.lit(0))).otherwise(0)
    return free, F.greatest(F.lit(0), free - dead)


def densify_calendar(df: DataFrame, *, by: Sequence[str], day: str, values: Sequence[str], until: str | None = None) -> DataFrame:
    """Missing days between the first and last observed (or ``until``) added, values carried forward."""
    last = F.max(until) if until else F.max(day)
    span = df.groupBy(*by).agg(F.min(day).alias("_lo"), last.alias("_hi")).select(*by, F.explode(F.sequence("_lo", F.greatest("_lo", "_hi"))).alias(day))
    full = span.join(df.select(*by, day, *values, F.lit(1).alias("observed")), [*by, day], "left")
    w = Window.partitionBy(*by).orderBy(day).rowsBetween(Window.unboundedPreceding, 0)
    return full.select(*by, day, *(F.last(v, ignorenulls=True).over(w).alias(v) for v in values), F.coalesce("observed", F.lit(0)).alias("observed"))


def infusion_rates(meds: DataFrame, cases: DataFrame, *, key: str, start: str, end: str, amount: str, weight: str, case_start: str, case_end: str) -> DataFrame:
    """Per case and minute offset, the summed rate per kilogram of concurrent infusions (weight 70 where missing). Times count to the nearest second."""
    joined = meds.join(cases, key).where((F.col(start) <= F.col(case_end)) & (F.col(end) >= F.col(case_start)))
    minutes = F.greatest(F.lit(1.0), (nearest_second(F.col(end)) - nearest_second(F.col(start))) / 60)
    rate = F.col(amount) / minutes / F.coalesce(weight, F.lit(70.0))
    offset = lambda c: F.floor((nearest_second(c) - nearest_second(F.col(case_start))) / 60)
    lo, hi = offset(F.greatest(start, case_start)), offset(F.least(end, case_end))
    return joined.select(key, rate.alias("rate"), F.explode(F.sequence(lo, hi)).alias("minute")).groupBy(key, "minute").agg(F.sum("rate").alias("rate"))


def accept_apart(df: DataFrame, *, by: Sequence[str], at: str, value: str, seconds: int) -> DataFrame:
    """Values at least so many seconds after the last accepted one, from the first on. Rows without a time are left out.

    A row that far from the row before it is accepted whatever came earlier, so each key falls into chains there, which
    are dealt over the tasks. A task reads its chains in order and remembers the last accepted time only, so a chain of
    any length takes the memory of one batch. Ties go by the value, nulls first; an empty table gives no rows.
    """
    step, w = seconds * 1_000_000, Window.partitionBy(*by).orderBy("_t", value)
    timed = df.where(F.col(at).isNotNull()).select(*by, F.unix_micros(at).alias("_t"), value)
    free = timed.withColumn("_free", F.coalesce((F.col("_t") - F.lag("_t").over(w) >= step).cast("int"), F.lit(1)))
    chained = free.withColumn("_chain", F.sum("_free").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    rows = chained.repartition(*by, "_chain").sortWithinPartitions(*by, "_chain", "_t", value, F.desc("_free"))
    keep = [*by, "_t", value]

    def accept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: int | None = None
        for batch in batches:
            t, taken = batch.column("_t").to_numpy(), np.zeros(batch.num_rows, bool)
            heads = np.flatnonzero(batch.column("_free").to_numpy()).tolist()
            for lo, hi in pairwise([0, *(h for h in heads if h), len(t)]):
                if heads and lo == heads[0]:
                    heads.pop(0)
                    last = None
                i = lo if last is None else lo + int(np.searchsorted(t[lo:hi], last + step))
                while i < hi:
                    taken[i], last = True, int(t[i])
                    i = max(i + 1, i + int(np.searchsorted(t[i:hi], last + step)))
            yield batch.filter(pa.array(taken)).select(keep)

    out = rows.mapInArrow(accept, rows.select(*keep).schema)
    return out.select(*by, F.timestamp_micros("_t").alias(at), value)
