"""Ordered windows within a group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardline.operators.saved import saved
from wardline.operators.stats import quantiles

DAY = 86_400_000_000


def nth_row(df: DataFrame, by: Sequence[str], order: Sequence[Column | str | tuple[Column | str, bool]], n: int = 1) -> DataFrame:
    """The nth row of each group; negative n counts from the last. ``order`` should end in a unique column.

    An order is a column, a name, or a pair of one of these and whether it falls. A negative n turns all of them round and takes names only, as a column may
    bring a direction of its own.
    """
    pairs = [o if isinstance(o, tuple) else (o, False) for o in order]
    if n < 0 and not all(isinstance(c, str) for c, _ in pairs):
        raise ValueError("an order cannot be counted from the end unless it has names only; use (name, falls) pairs")
    columns = [(F.col(c) if isinstance(c, str) else c, falls) for c, falls in pairs]
    columns = [c.desc() if falls else c for c, falls in columns] if n > 0 else [c.asc_nulls_last() if falls else c.desc_nulls_last() for c, falls in columns]
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*by).orderBy(*columns))).where(F.col("_rn") == abs(n)).drop("_rn")


def sort_globally(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """The rows in one order over all partitions, with their ``position`` from 0, as a table that is written once.

    Ranges of the order go to partitions and are sorted there; a row's position is its place in its partition and the rows of the partitions before, one
    number for each. ``order`` should end in a unique column; ranges are cut by it, so many equal beginnings do not make one large partition.
    """
    ranges = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    rows = saved(ranges).withColumn("_part", F.shiftright("_id", 33))
    sums = rows.groupBy("_part").agg(F.count("*").alias("_n"))
    before = sums.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))  # a row for each partition
    placed = rows.join(F.broadcast(before), "_part").withColumn("position", F.col("_before") + F.col("_id").bitwiseAND((1 << 33) - 1))
    return placed.select(*df.columns, "position")


def change_runs(df: DataFrame, by: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """A flag where the value differs from the row before, and the number of its run."""
    w = Window.partitionBy(*by).orderBy(*order)
    changed = F.when(F.row_number().over(w) == 1, 1).otherwise((~F.col(value).eqNullSafe(F.lag(value).over(w))).cast("int"))
    return df.withColumn("changed", changed).withColumn("run", F.sum("changed").over(w))


def next_start_as_end(df: DataFrame, by: Sequence[str], start: str, fill: str | None = None) -> DataFrame:
    """End of an interval: a second before the next start; the last one's is ``fill``."""
    w = Window.partitionBy(*by).orderBy(start)
    nxt = F.lead(start).over(w) - F.expr("INTERVAL 1 SECOND")
    return df.withColumn("end_at", F.coalesce(nxt, F.col(fill)) if fill else nxt)


def rolling(df: DataFrame, by: Sequence[str], at: str, value: str, fn, *, back: int, ahead: int = 0, open_left: bool = False, name: str = "rolled") -> DataFrame:
    """Aggregate over the times from ``back`` before to ``ahead`` after (microseconds); the left edge may be open."""
    w = Window.partitionBy(*by).orderBy(F.unix_micros(at)).rangeBetween(-back + (1 if open_left else 0), ahead)
    return df.withColumn(name, fn(value).over(w))


def fill_forward(df: DataFrame, by: Sequence[str], order: Sequence[str], column: str, limit: int | None = None, name: str = "filled") -> DataFrame:
    """Last value carried forward, over at most ``limit`` rows."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding if limit is None else -limit, 0)
    return df.withColumn(name, F.last(column, ignorenulls=True).over(w))


def fill_backward(df: DataFrame, by: Sequence[str], order: Sequence[str], column: str, name: str = "filled") -> DataFrame:
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(0, Window.unboundedFollowing)
    return df.withColumn(name, F.first(column, ignorenulls=True).over(w))


def episodes(df: DataFrame, by: Sequence[str], day: str, flag: str, quiet: int = 2) -> DataFrame:
    """Number and length of episodes of flagged days; one ends after ``quiet`` days without the flag."""
    w = Window.partitionBy(*by).orderBy(day)
    hits = df.where(F.col(flag) == 1)
    new = F.coalesce((F.datediff(F.col(day), F.lag(day).over(w)) > quiet).cast("int"), F.lit(1))
    numbered = hits.withColumn("_n", new).withColumn("episode", F.sum("_n").over(w))
    return numbered.groupBy(*by, "episode").agg(F.min(day).alias("begin_day"), F.max(day).alias("end_day"), (F.datediff(F.max(day), F.min(day)) + 1).alias("length"))


def stay_extremes(df: DataFrame, by: Sequence[str], at: str, value: str) -> DataFrame:
    """First, last, least and greatest value of a stay with their times; ties by the earlier time."""
    x, t = F.col(value), F.col(at)
    out = df.where(x.isNotNull()).groupBy(*by).agg(
        F.min(F.struct(t, x)).alias("first"), F.max(F.struct(t, x)).alias("last"), F.min(F.struct(x, t)).alias("least"), F.max(F.struct(x, (-F.unix_micros(t)).alias("m"), t)).alias("most")
    )
    return out.select(*by, *(F.col(f"{k}.{c}").alias(f"{k}_{n}") for k in ("first", "last", "least", "most") for c, n in ((value, "value"), (at, "at"))))


def closest_to_median(df: DataFrame, by: Sequence[str], value: str, at: str) -> DataFrame:
    """The row nearest its group's median; the latest on a tie."""
    mid = quantiles(df, by, value, [0.5]).withColumnRenamed("q0", "_median")
    order = (F.abs(F.col(value) - F.col("_median")).asc(), F.col(at).desc())
    return nth_row(df.join(mid, list(by)), by, order).drop("_median")


def keep_top_levels(df: DataFrame, column: str, n: int, *, other: str = "OTHER", unknown: str = "UNKNOWN") -> DataFrame:
    """Keep the n most frequent levels; other ones and nulls get a name. Names of unknowns are not ranked."""
    named = F.upper(F.col(column)).isin(other, unknown)
    top = df.where(F.col(column).isNotNull() & ~named).groupBy(column).count().orderBy(F.desc("count"), column).limit(n).select(F.col(column), F.lit(True).alias("_top"))
    return df.join(F.broadcast(top), column, "left").withColumn(column, F.when(F.col(column).isNull(), unknown).when(F.col("_top"), F.col(column)).otherwise(other)).drop("_top")
