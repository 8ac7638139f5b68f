"""Feature preparation: fit parameters on training rows, apply them anywhere as a projection."""

from __future__ import annotations

import json
import math
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardline.operators.stats import counted, deviations, quantiles, quantiles_of


def uniform(key: Column, seed: int) -> Column:
    """A number in [0, 1) by hash of a key: seeded, and the same on every run."""
    return F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1 << 52)) / float(1 << 52)


def normal(key: Column, seed: int) -> Column:
    """A standard normal number by hash (Box-Muller)."""
    return F.sqrt(-2 * F.log(1 - uniform(key, seed))) * F.cos(2 * math.pi * uniform(key, seed + 1))


def normalise_text(column: Column, na: Sequence[str] = ("", "na", "nan", "none", "null", "?", "-999")) -> Column:
    s = F.lower(F.trim(F.regexp_replace(column.cast("string"), r"\s+", " ")))
    return F.when(~s.isin(*na), s)


def midpoint_quantiles(df: DataFrame, by: Sequence[str], value: str, probabilities: Sequence[float]) -> DataFrame:
    """Quantiles as the mean of the two ranks around them."""
    found = quantiles(df, by, value, probabilities, midpoint=True)
    return found.select(*by, *(F.col(f"q{i}").alias(f"q{round(p * 100)}") for i, p in enumerate(probabilities)))


@dataclass
class NumericFit:
    mean: float | None
    std: float | None
    median: float | None
    mad: float | None
    low: float | None
    high: float | None
    missing: float
    drop: bool
    inner_low: float | None = None
    inner_high: float | None = None


@dataclass
class LevelFit:
    levels: list[str]
    frequencies: list[int]
    mode: str | None
    missing: float
    drop: bool


@dataclass
class Standardizer:
    """Fitted parameters; a few numbers a column, kept as JSON beside the data."""

    numeric: dict[str, NumericFit] = field(default_factory=dict)
    levels: dict[str, LevelFit] = field(default_factory=dict)

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> Standardizer:
        d = json.loads(text)
        return Standardizer({k: NumericFit(**v) for k, v in d["numeric"].items()}, {k: LevelFit(**v) for k, v in d["levels"].items()})


def fit_standardizer(train: DataFrame, *, numeric: Sequence[str] = (), categorical: Sequence[str] = (), most_missing: float = 0.9, least_count: int = 1, most_levels: int = 1000) -> Standardizer:
    """Jobs over all numeric columns at once for moments and quantiles, and one of level counts for each other (at most ``most_levels`` a column come to the driver)."""
    fit = Standardizer()
    if numeric:
        aggs = []
        for c in numeric:
            x = F.col(c).cast("double")
            aggs.append(F.struct(F.count("*").alias("rows"), F.count(x).alias("n"), F.avg(x).alias("mean"), F.stddev_pop(x).alias("std"), (F.min(x) < F.max(x)).alias("varies")).alias(c))
        row = train.agg(*aggs).first()
        tall = train.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in numeric))).alias("_r")).select("_r.*")
        counts = counted(tall, ["column"], "x")
        spread = quantiles_of(counts, ["column"], [0.01, 0.15, 0.5, 0.85, 0.99])
        q = {r["column"]: tuple(r[f"q{i}"] for i in range(5)) for r in spread.collect()}  # a row a column
        mads = {r["column"]: r["q0"] for r in quantiles_of(deviations(counts, ["column"], spread, "q2"), ["column"], [0.5]).collect()}
        for c in numeric:
            r, (low, inner_low, median, inner_high, high) = row[c], q.get(c, (None,) * 5)
            lost = 1 - r["n"] / r["rows"] if r["rows"] else 1.0
            fit.numeric[c] = NumericFit(r["mean"], r["std"], median, mads[c] * 1.4826 if c in mads else None, low, high, lost, not r["varies"] or lost >= most_missing, inner_low, inner_high)
    for c in categorical:
        s = normalise_text(F.col(c))
        counts = train.select(s.alias("v")).groupBy("v").count().orderBy(F.desc("count"), "v").limit(most_levels + 1).collect()
        total, known = sum(r["count"] for r in counts), [(r["v"], r["count"]) for r in counts if r["v"] is not None]
        kept = [(v, n) for v, n in known if n >= least_count]
        lost = 1 - sum(n for _, n in known) / total if total else 1.0
        fit.levels[c] = LevelFit([v for v, _ in kept], [n for _, n in kept], kept[0][0] if kept else None, lost, len(known) <= 1 or not kept or lost >= most_missing)
    return fit


def fit_series(train: DataFrame, *, variable: str, value: str, most_missing: float = 0.9, most_variables: int = 1000) -> Standardizer:
    """Parameters of each variable from long rows (variable, value); one row a variable comes to the driver, at most ``most_variables``.

    ``missing`` is the share of a variable's rows without a value. Rows without a variable are left out.
    """
    rows = train.where(F.col(variable).isNotNull()).select(F.col(variable).cast("string").alias("variable"), F.col(value).cast("double").alias("x"))
    counts = counted(rows, ["variable"], "x")
    x = F.col("x")
    moments = rows.groupBy("variable").agg(F.count("*").alias("rows"), F.count(x).alias("n"), F.avg(x).alias("mean"), F.stddev_pop(x).alias("std"), (F.min(x) < F.max(x)).alias("varies"))
    spread = quantiles_of(counts, ["variable"], [0.01, 0.15, 0.5, 0.85, 0.99])
    mads = quantiles_of(deviations(counts, ["variable"], spread, "q2"), ["variable"], [0.5]).select("variable", F.col("q0").alias("mad"))
    found = moments.join(spread, "variable", "left").join(mads, "variable", "left").orderBy("variable").limit(most_variables + 1).collect()
    if len(found) > most_variables:
        raise ValueError(f"over {most_variables} variables")
    fit = Standardizer()
    for r in found:
        lost = 1 - r["n"] / r["rows"]
        mad = None if r["mad"] is None else r["mad"] * 1.4826
        fit.numeric[r["variable"]] = NumericFit(r["mean"], r["std"], r["q2"], mad, r["q0"], r["q4"], lost, not r["varies"] or lost >= most_missing, r["q1"], r["q3"])
    return fit


def apply_series(df: DataFrame, fit: Standardizer, *, key: str, variable: str, at: str, value: str, seconds: int, carry: int | None = None) -> DataFrame:
    """Long rows as one row for each key and time step, a column for each fitted variable.

    Values are clipped to the fitted bounds, the mean of a step is scaled, and all steps from a key's first to its last
    row are there. A step without a value of a variable is marked in ``<variable>_missing_ind`` and takes the last one of
    the key, over at most ``carry`` steps (all, if None), else the fitted median. Variables that are not fitted or were
    dropped, and rows without a key or time, are left out.
    """
    used = {v: f for v, f in fit.numeric.items() if not f.drop}
    rows = df.where(F.col(key).isNotNull() & F.col(at).isNotNull()).withColumn("_step", F.floor(F.unix_micros(at) / (seconds * 1_000_000)))
    of = lambda v: F.when(F.col(variable) == v, F.col(value).cast("double"))
    clipped = [F.avg(F.when(of(v).isNotNull(), clip_or_redraw(of(v), f, F.col(key)))).alias(f"_m{i}") for i, (v, f) in enumerate(used.items())]
    wide = rows.groupBy(key, "_step").agg(F.count("*").alias("_n"), *clipped)
    grid = rows.groupBy(key).agg(F.min("_step").alias("_a"), F.max("_step").alias("_b")).select(key, F.explode(F.sequence("_a", "_b")).alias("_step"))
    w = Window.partitionBy(key).orderBy("_step").rowsBetween(Window.unboundedPreceding if carry is None else -carry, 0)
    full = grid.join(wide, [key, "_step"], "left")
    out: list[Column] = [F.col(key), F.timestamp_micros(F.col("_step") * (seconds * 1_000_000)).alias(at)]
    for i, (v, f) in enumerate(used.items()):
        x = F.coalesce(F.last(f"_m{i}", ignorenulls=True).over(w), F.lit(f.median))
        out += [((x - f.mean) / F.lit(f.std or 1.0)).alias(v), F.col(f"_m{i}").isNull().cast("int").alias(f"{v}_missing_ind")]
    return full.select(*out)


def impute(column: Column, fit: NumericFit, how: str, key: Column, seed: int = 1, constant: float = 0.0) -> Column:
    """Missing numbers by mean, median, constant, or a seeded draw (uniform, normal, normal_mad)."""
    lo, hi = fit.low or 0.0, fit.high or 0.0
    value = {
        "mean": lambda: F.lit(fit.mean),
        "median": lambda: F.lit(fit.median),
        "constant": lambda: F.lit(constant),
        "uniform": lambda: lo + uniform(key, seed) * (hi - lo),
        "normal": lambda: fit.mean + normal(key, seed) * (fit.std or 0.0),
        "normal_mad": lambda: fit.median + normal(key, seed) * (fit.mad or 0.0),
    }[how]()
    return F.coalesce(column, value)


def impute_level(column: Column, fit: LevelFit, how: str, key: Column, seed: int = 2, constant: str = "missing") -> Column:
    """Missing levels by the mode, a constant, or a seeded draw in proportion to the training frequencies (weighted)."""
    if how == "constant":
        return F.coalesce(column, F.lit(constant))
    if how == "mode" or not fit.levels:
        return F.coalesce(column, F.lit(fit.mode))
    if how != "weighted":
        raise ValueError(f"unknown way to impute levels: {how}")
    below = F.array(*(F.lit(float(x)) for x in accumulate(fit.frequencies)))
    place = F.size(F.filter(below, lambda x: x <= uniform(key, seed) * float(sum(fit.frequencies)))) + 1
    return F.coalesce(column, F.element_at(F.array(*(F.lit(v) for v in fit.levels)), place))


def clip_or_redraw(column: Column, fit: NumericFit, key: Column, *, redraw: bool = False, seed: int = 3) -> Column:
    """Numbers beyond the fitted 1 and 99 percent quantiles are clipped, or drawn anew below the 15 or above the 85 percent one."""
    lo, hi = F.lit(fit.low), F.lit(fit.high)
    if not redraw:
        return F.when(column.isNotNull(), F.greatest(lo, F.least(hi, column)))  # least and greatest skip nulls
    u = uniform(key, seed)
    return F.when(column < lo, lo + u * (fit.inner_low - fit.low)).when(column > hi, hi - u * (fit.high - fit.inner_high)).otherwise(column)


def apply_standardizer(df: DataFrame, fit: Standardizer, *, key: str, how: str = "median", one_hot: bool = True, other: str = "other", draw_unseen: bool = False) -> DataFrame:
    """Clip, impute and scale numbers; encode levels; add missing indicators.

    Rare and unseen levels become ``other``, or with ``draw_unseen`` a known one, drawn by training frequency.
    """
    out: list[Column] = [F.col(key)]
    for c, f in fit.numeric.items():
        if f.drop:
            continue
        x = impute(clip_or_redraw(F.col(c).cast("double"), f, F.col(key)), f, how, F.col(key))
        out += [((x - f.mean) / F.lit(f.std or 1.0)).alias(c), F.col(c).isNull().cast("int").alias(f"{c}_missing_ind")]
    for c, f in fit.levels.items():
        if f.drop:
            continue
        s = normalise_text(F.col(c))
        unseen = impute_level(F.lit(None).cast("string"), f, "weighted", F.col(key)) if draw_unseen else F.lit(other)
        v = F.when(s.isNull(), F.lit(f.mode)).when(s.isin(*f.levels), s).otherwise(unseen)
        if one_hot:
            out += [(v == level).cast("int").alias(f"{c}_{level}") for level in sorted({*f.levels, other})]
        else:
            places = F.create_map(*(F.lit(x) for i, level in enumerate(sorted({*f.levels, other})) for x in (level, i)))
            out.append(places[v].alias(c))
        out.append(F.col(c).isNull().cast("int").alias(f"{c}_missing_ind"))
    return df.select(*out)


def target_encode(df: DataFrame, train: DataFrame, column: str, target: str) -> DataFrame:
    """Category by its mean target in training; unseen ones by the overall mean."""
    means = train.groupBy(column).agg(F.avg(target).alias("encoded"))
    overall = train.agg(F.avg(target).alias("_all"))
    return df.join(means, column, "left").crossJoin(F.broadcast(overall)).withColumn("encoded", F.coalesce("encoded", "_all")).drop("_all")


def hierarchical_encode(df: DataFrame, train: DataFrame, levels: Sequence[str], target: str) -> DataFrame:
    """Value of the finest level known in training, else of the next one up, else overall."""
    for i, c in enumerate(levels):
        df = df.join(train.groupBy(c).agg(F.avg(target).alias(f"_e{i}")), c, "left")
    overall = train.agg(F.avg(target).alias("_all"))
    return df.crossJoin(F.broadcast(overall)).withColumn("encoded", F.coalesce(*(f"_e{i}" for i in range(len(levels))), "_all")).drop(*(f"_e{i}" for i in range(len(levels))), "_all")


def min_max(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    stats = df.agg(*(f(c).alias(f"_{n}_{c}") for c in columns for n, f in (("lo", F.min), ("hi", F.max))))
    scaled = {c: F.when(F.col(f"_hi_{c}") > F.col(f"_lo_{c}"), (F.col(c) - F.col(f"_lo_{c}")) / (F.col(f"_hi_{c}") - F.col(f"_lo_{c}"))).otherwise(0.0) for c in columns}
    return df.crossJoin(F.broadcast(stats)).withColumns(scaled).select(df.columns)


def robust_outliers(df: DataFrame, by: Sequence[str], value: str, limit: float = 3.5) -> DataFrame:
    """Flag values whose modified z score (by median and absolute deviation) is over the limit."""
    counts = counted(df, by, value)
    mid = quantiles_of(counts, by, [0.5]).withColumnRenamed("q0", "_m")
    near = df.join(mid, list(by))
    mad = quantiles_of(deviations(counts, by, mid, "_m"), by, [0.5]).withColumnRenamed("q0", "_mad")
    z = 0.6745 * (F.col(value) - F.col("_m")) / F.col("_mad")
    return near.join(mad, list(by)).withColumn("modified_z", F.when(F.col("_mad") > 0, z)).withColumn("outlier", F.coalesce((F.abs("modified_z") > limit).cast("int"), F.lit(0))).drop("_m", "_mad")


def kind_of(dtype: str) -> str:
    kinds = {"string": "text", "boolean": "flag", "date": "time", "timestamp": "time", "timestamp_ntz": "time"}
    numeric = ("tinyint", "smallint", "int", "bigint", "float", "double")
    return kinds.get(dtype, "numeric" if dtype in numeric or dtype.startswith("decimal") else "other")


def columns_by_kind(df: DataFrame) -> DataFrame:
    """Rows (kind, column): which columns are numeric, text, time or other."""
    rows = [(kind_of(t), c) for c, t in df.dtypes]
    return df.limit(1).select(F.explode(F.array(*(F.struct(F.lit(k).alias("kind"), F.lit(c).alias("column")) for k, c in rows))).alias("x")).select("x.*")
