"""Resampling to a regular grid, and filling it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def origin_of(kind: str, start: Column, end: Column) -> Column:
    """Where bins begin: epoch, start, start_day, end or end_day."""
    return {"epoch": F.timestamp_micros(F.lit(0)), "start": start, "start_day": F.date_trunc("day", start), "end": end, "end_day": F.date_trunc("day", end)}[kind]


def resample(df: DataFrame, *, by: Sequence[str], at: str, value: str, seconds: int, origin: Column, aggregates: Mapping[str, object]) -> DataFrame:
    """Values by bin: rows (*by, bin, one column for each aggregate)."""
    number = F.floor((F.unix_micros(at) - F.unix_micros(origin)) / (seconds * 1_000_000))
    return df.withColumn("bin", number).groupBy(*by, "bin").agg(*(f(value).alias(name) for name, f in aggregates.items()))


def full_grid(df: DataFrame, *, by: Sequence[str], values: Sequence[str]) -> DataFrame:
    """All bins between the first and last one of a group, with an indicator where nothing was observed."""
    span = df.groupBy(*by).agg(F.min("bin").alias("_lo"), F.max("bin").alias("_hi")).select(*by, F.explode(F.sequence("_lo", "_hi")).alias("bin"))
    full = span.join(df.withColumn("_seen", F.lit(1)), [*by, "bin"], "left")
    return full.select(*by, "bin", *values, F.coalesce(1 - F.col("_seen"), F.lit(1)).alias("missing_ind"))


def interpolate(df: DataFrame, *, by: Sequence[str], order: str, value: str, method: str = "linear", limit: int | None = None, edges: bool = True, constant: float | None = None) -> DataFrame:
    """Fill gaps between known values: linear or forward; edges take the nearest value; at most ``limit`` steps away."""
    w = Window.partitionBy(*by).orderBy(order)
    back, ahead = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(0, Window.unboundedFollowing)
    point = F.when(F.col(value).isNotNull(), F.struct(F.col(order).alias("x"), F.col(value).alias("y")))
    both = df.withColumn("_a", F.last(point, ignorenulls=True).over(back)).withColumn("_b", F.first(point, ignorenulls=True).over(ahead))
    x, (xa, ya), (xb, yb) = F.col(order), (F.col("_a.x"), F.col("_a.y")), (F.col("_b.x"), F.col("_b.y"))
    if method == "constant":
        filled = F.coalesce(F.col(value), F.lit(constant))
    elif method == "ffill":
        filled = F.coalesce(ya, yb) if edges else ya
    else:
        line = F.when(xb == xa, ya).otherwise(ya + (yb - ya) * (x - xa) / (xb - xa))
        filled = F.coalesce(line, ya, yb) if edges else line
    if limit is not None and method != "constant":
        filled = F.when(F.col(value).isNotNull() | (x - xa <= limit), filled)
    return both.withColumn("filled", filled).drop("_a", "_b")
