"""Grouped aggregates: bundles, ordinal worst, priorities, indicators, pivots, profiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.operators.saved import saved
from wardline.operators.stats import counted, deviations, quantiles_of


def numeric_bundle(df: DataFrame, by: Sequence[str], value: str, scaled_mad: bool = False) -> DataFrame:
    """sum, min, max, count, mean, median, std (n - 1) and median absolute deviation; medians by counts of distinct values."""
    x, g = F.col(value), counted(df, by, value)
    mid = quantiles_of(g, by, [0.5]).withColumnRenamed("q0", "median")
    mad = quantiles_of(deviations(g, by, mid, "median"), by, [0.5]).select(*by, (F.col("q0") * (1.4826 if scaled_mad else 1.0)).alias("mad"))
    out = df.groupBy(*by).agg(F.sum(x).alias("sum"), F.min(x).alias("min"), F.max(x).alias("max"), F.count(x).alias("count"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"))
    for part in (mid, mad):
        out = out.join(part, list(by), "left") if by else out.join(F.broadcast(part), how="left")
    return out.select(*by, "sum", "min", "max", "count", "mean", "median", "std", "mad")


def weighted_average(value: Column, weight: Column) -> Column:
    return F.sum(value * weight) / F.sum(F.when(value.isNotNull(), weight))


def count_sum_pivot(df: DataFrame, by: Sequence[str], label: str, value: str, labels: Sequence[str]) -> DataFrame:
    """Count and sum for each label side by side, zero where absent, with totals."""
    aggs = [f for v in labels for f in (F.count(F.when(F.col(label) == v, 1)).alias(f"n_{v}"), F.coalesce(F.sum(F.when(F.col(label) == v, F.col(value))), F.lit(0.0)).alias(f"sum_{v}"))]
    return df.groupBy(*by).agg(*aggs, F.count("*").alias("n_total"), F.sum(value).alias("sum_total"))


def sorted_max(column: Column) -> Column:
    """The maximum, of values in a struct, which Spark aggregates over sorted rows: for groups of few rows each, whose hash table would hold the whole task."""
    return F.max(F.struct(column.alias("most")))["most"]


def distinct_per_category(df: DataFrame, by: Sequence[str], category: str, item: str, categories: Sequence[str]) -> DataFrame:
    """Distinct items of each category; rows are sorted once, not copied for each category."""
    named = F.col(category).isin(*categories)
    rows = df.select(*by, F.when(named, F.col(category)).alias("_category"), F.when(named, F.col(item)).alias("_item")).repartition(*by)
    once = rows.groupBy(*by, "_category", "_item").agg(sorted_max(F.col("_item")).alias("_once"))
    return once.groupBy(*by).agg(*(F.count(F.when(F.col("_category") == c, F.col("_once"))).alias(f"n_{c}") for c in categories))


def string_agg_distinct(column: Column, separator: str = ", ") -> Column:
    """Distinct trimmed texts in order, joined."""
    return F.array_join(F.array_sort(F.collect_set(F.trim(column))), separator)


def ordinal_rank(column: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Rank of the first rule (pattern, label) that a text matches, or null."""
    low, out = F.lower(column), F.when(F.lit(False), F.lit(None).cast("int"))
    for i, (pattern, _) in enumerate(rules):
        out = out.when(low.rlike(pattern), i)
    return out


def ordinal_worst(column: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Aggregate: label of the best-ranked rule that any value of the group matches."""
    labels = F.array(*(F.lit(label) for _, label in rules))
    return F.try_element_at(labels, F.min(ordinal_rank(column, rules)) + 1)


# Orders of severity, worst first; the last rule of some stands for any other value. The bare "or" of a
# station also matches inside words such as "floor", as in the tables that this order was made for.
ORDERS: dict[str, tuple[tuple[str, str], ...]] = {
    "station": (("home", "HOME"), ("or", "OR"), ("icu", "ICU"), ("", "WARD")),
    "respiratory_device": (("^ventilator$", "ventilator"), ("^supplemental oxygen$", "supplemental oxygen"), ("^noninvasive ventilator$", "noninvasive ventilator"), ("^room air$", "room air")),
    "delirium": (("positive|yes", "POSITIVE"), ("unable to assess", "UNABLE_TO_ASSESS"), ("", "NEGATIVE")),
    "assistance": (
        ("^dependent, patient does less than 25%$", "Dependent"), ("^maximum assist, patient does 25-49%$", "Maximum"), ("^moderate assist, patient does 50-74%$", "Moderate"),
        ("^minimal assist, patient does 75% or more$", "Minimal"), ("^(adl )?assistance by 4 or more caregivers$", "Moderate"),
        ("^((adl )?assistance by 2-3 caregivers|assistance with re-learning adl activities)$", "Minimal"), ("^independent$", "Independent"),
    ),
}
# Patterns of location flags.
STATIONS = {"ICU": "icu", "WARD": "ward", "HOME": "home", "ED": "^ed$", "OR": "^or$", "PROC": "procedure", "IMC": "imc", "PACU": "pacu"}


def multi_label(df: DataFrame, by: Sequence[str], column: str, labels: Mapping[str, str], separator: str = ";") -> DataFrame:
    """Flags per group of which patterns its separated values match; null where the group has no value."""
    parts = df.select(*by, F.explode_outer(F.split(column, separator)).alias("_v"))
    return parts.groupBy(*by).agg(*(F.max(F.lower("_v").rlike(p).cast("int")).alias(name) for name, p in labels.items()))


def highest_priority(value: Column, priority: Mapping[str, int]) -> Column:
    """Aggregate: the value of the lowest priority number; unlisted values come last."""
    table = F.create_map(*(F.lit(x) for pair in priority.items() for x in pair))
    return F.min(F.struct(F.coalesce(F.try_element_at(table, value), F.lit(10**6)).alias("p"), value.alias("v"))).getField("v")


def pivot_wide(df: DataFrame, by: Sequence[str], name: str, value: str, names: Sequence[str], aggregate=F.min) -> DataFrame:
    return df.groupBy(*by).agg(*(aggregate(F.when(F.col(name) == n, F.col(value))).alias(n) for n in names))


def unstack_exploding(df: DataFrame, by: Sequence[str], name: str, value: str, names: Sequence[str]) -> DataFrame:
    """Pivot, then a row for each place of the longest list of values."""
    wide = df.groupBy(*by).agg(*(F.array_sort(F.collect_list(F.when(F.col(name) == n, F.col(value)))).alias(n) for n in names))
    return wide.select(*by, F.explode_outer(F.arrays_zip(*names)).alias("_z")).select(*by, *(F.col(f"_z.{n}").alias(n) for n in names))


def profile(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Per column (and group): count, missing, distinct, mode, min, max, mean, median, std of its numbers or text lengths."""
    tall = df.select(*by, F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("text"), F.expr(f"try_cast(cast(`{c}` as string) as double)").alias("num")) for c in columns))).alias("_x")).select(*by, "_x.*")
    x = F.coalesce("num", F.length("text").cast("double"))
    key = [*by, "column"]
    freq = saved(tall.groupBy(*key, "text", x.alias("x")).count())  # all else comes from the counts of distinct values
    known, n = F.col("text").isNotNull(), F.sum(F.when(F.col("x").isNotNull(), F.col("count")))
    stats = freq.groupBy(*key).agg(F.coalesce(F.sum(F.when(known, F.col("count"))), F.lit(0)).alias("n"), F.coalesce(F.sum(F.when(~known, F.col("count"))), F.lit(0)).alias("missing"), F.count("text").alias("levels"), F.min("x").alias("min"), F.max("x").alias("max"), (F.sum(F.col("x") * F.col("count")) / n).alias("mean"))
    same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in key))
    apart = freq.join(stats.select(*(F.col(c).alias(f"_{c}") for c in key), F.col("mean").alias("_mean")), same)
    std = apart.groupBy(*key).agg(F.when(n > 1, F.sqrt(F.sum(F.pow(F.col("x") - F.col("_mean"), 2) * F.col("count")) / (n - 1))).alias("std"))
    stats = stats.join(std.select(*(F.col(c).alias(f"_{c}") for c in key), "std"), same, "left").drop(*(f"_{c}" for c in key))
    some = " and ".join(f"`{c}` is not null" for c in [*key, "x"])
    median = quantiles_of(saved(freq.where(some).groupBy(*key, F.col("x").alias("_v")).agg(F.sum("count").alias("_c"))), key, [0.5]).withColumnRenamed("q0", "median")
    freq = freq.where(known)
    mode = freq.groupBy(*by, "column").agg(F.min(F.struct((-F.col("count")).alias("c"), "text")).getField("text").alias("mode"))
    out = stats.join(median, [*by, "column"], "left").join(mode, [*by, "column"], "left")
    return out.select(*by, "column", "n", "missing", "levels", "min", "max", "mean", "median", "std", "mode")


def directory_summary(spark: SparkSession, tables: Mapping[str, str]) -> DataFrame:
    """Rows (table, column, n_rows, n, levels, shortest) for the columns of Parquet tables, each table read once."""
    out = None
    for name, path in tables.items():
        df = spark.read.parquet(path)
        stats = df.agg(F.count("*").alias("n_rows"), *(F.struct(F.count(x).alias("n"), F.count_distinct(x).alias("levels"), F.min(F.length(F.col(x).cast("string"))).alias("shortest")).alias(x) for x in df.columns))
        rows = stats.select(F.lit(name).alias("table"), "n_rows", F.explode(F.array(*(F.struct(F.lit(x).alias("column"), f"{x}.*") for x in df.columns))).alias("x"))
        part = rows.select("table", "x.column", "n_rows", "x.n", "x.levels", F.col("x.shortest").cast("long").alias("shortest"))
        out = part if out is None else out.unionByName(part)
    return out


def timestamp_stats(df: DataFrame, by: Sequence[str], at: str) -> DataFrame:
    """Median, least and greatest time of a group, of years 1905 to 2200."""
    ok = df.where(F.year(at).between(1905, 2200))
    return ok.groupBy(*by).agg(F.timestamp_micros(F.median(F.unix_micros(at)).cast("long")).alias("median_at"), F.min(at).alias("min_at"), F.max(at).alias("max_at"))


def census(frames: Mapping[str, DataFrame], key: str) -> DataFrame:
    """Which frames hold each id, and how many."""
    stacked = None
    for name, f in frames.items():
        part = f.select(F.col(key).alias("id")).distinct().withColumn("frame", F.lit(name))
        stacked = part if stacked is None else stacked.union(part)
    return stacked.groupBy("id").agg(F.array_join(F.array_sort(F.collect_set("frame")), ",").alias("frames"), F.count("*").alias("n_frames"))


def concept_date_list(df: DataFrame, by: Sequence[str], concept: str, at: str) -> DataFrame:
    """Per group '[concept: earliest date]' joined, in order of concept."""
    first = df.groupBy(*by, concept).agg(F.min(F.to_date(at)).alias("_d"))
    return first.groupBy(*by).agg(F.array_join(F.array_sort(F.collect_list(F.concat(F.lit("["), F.col(concept), F.lit(": "), F.col("_d").cast("string"), F.lit("]")))), ", ").alias("concepts"))
