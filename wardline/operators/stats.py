"""Evaluation and group comparison. Sums run in Spark; only tails of distributions, on a few numbers, run on the driver."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardline.operators.saved import once, saved


#: Ranges of a key, and rows that one task ranks without them.
BINS, SMALL = 256, 200_000


def running_sums(g: DataFrame, by: Sequence[str], key: str, columns: Sequence[str], *, falling: bool = False) -> DataFrame:
    """Sums of columns over the rows up to and with each one, in order of a numeric key without ties, as <column>_run.

    The table is written once, so that what it comes from runs once. Up to ``SMALL`` rows one window reads a group. More are cut into ranges of the key, each with about as
    many rows whatever the key's distribution: at most ``BINS`` cut points come from its approximate quantiles, over all groups. A
    window within each range and one over the sums of ranges then replace one that reads a whole group; the sums are the same.
    """
    g, sort = once(g), F.desc if falling else F.asc
    if g.count() <= SMALL:
        whole = Window.partitionBy(*(by or [F.lit(1)])).orderBy(sort(key))
        return g.select("*", *(F.sum(c).over(whole).alias(f"{c}_run") for c in columns))
    cuts = g.approxQuantile(key, [i / BINS for i in range(1, BINS)], 0.25 / BINS)
    splits = [-math.inf, *(sorted({x for x in cuts if math.isfinite(x)}) or [0.0]), math.inf]
    placed = Bucketizer(splits=splits, inputCol=key, outputCol="_place", handleInvalid="keep").transform(g)
    g = placed.withColumn("_bin", F.coalesce(F.col("_place").cast("int"), F.lit(-1))).drop("_place")
    bins = g.groupBy(*by, "_bin").agg(*(F.sum(c).alias(f"_b_{c}") for c in columns)).withColumn("_one", F.lit(1))
    w = Window.partitionBy("_one", *by).orderBy(sort("_bin"))
    before = bins.select(*by, "_bin", *((F.sum(f"_b_{c}").over(w) - F.col(f"_b_{c}")).alias(f"_before_{c}") for c in columns))
    inside = Window.partitionBy(*by, "_bin").orderBy(sort(key))
    out = g.select("*", *(F.sum(c).over(inside).alias(f"_in_{c}") for c in columns)).join(before, [*by, "_bin"])
    return out.select(*g.columns, *((F.col(f"_before_{c}") + F.col(f"_in_{c}")).alias(f"{c}_run") for c in columns)).drop("_bin")


def counted(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """(by, _v, _c): how often each number stands in each group, written once. Nulls, in ``by`` too, do not count."""
    known = df.where(" and ".join(f"`{c}` is not null" for c in [*by, value]))
    return saved(known.groupBy(*by, F.col(value).cast("double").alias("_v")).agg(F.count("*").alias("_c")))


def quantiles_of(g: DataFrame, by: Sequence[str], probabilities: Sequence[float], *, midpoint: bool = False) -> DataFrame:
    """Quantiles q0, q1, ... of each group of a ``counted`` table."""
    totals, r = g.groupBy(*by).agg(F.sum("_c").alias("_n")), running_sums(g, by, "_v", ["_c"])
    r = r.join(totals, list(by)) if by else r.crossJoin(F.broadcast(totals))
    slack = 1e-9  # so that a whole place is not taken for two ranks
    aggs, out = [], []
    for i, p in enumerate(probabilities):
        place = (F.col("_n") - 1) * F.lit(float(p))
        for side, rank in (("lo", F.floor(place + slack)), ("hi", F.ceil(place - slack))):
            aggs.append(F.max(F.when((F.col("_c_run") - F.col("_c") <= rank) & (rank < F.col("_c_run")), F.col("_v"))).alias(f"_{side}{i}"))
        part = F.lit(0.5) if midpoint else place - F.floor(place + slack)
        out.append((F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * part).alias(f"q{i}"))
    return r.groupBy(*by, "_n").agg(*aggs).select(*by, *out)


def quantiles(df: DataFrame, by: Sequence[str], value: str, probabilities: Sequence[float], *, midpoint: bool = False) -> DataFrame:
    """Exact quantiles of each group as q0, q1, ..., between two ranks by their distance or at the midpoint; nulls do not count.

    Ranks come from counts of distinct values, so a group may hold most of the table. Groups without a
    value are left out, as are rows with a null in ``by``.
    """
    return quantiles_of(counted(df, by, value), by, probabilities, midpoint=midpoint)


def deviations(g: DataFrame, by: Sequence[str], centre: DataFrame, column: str) -> DataFrame:
    """A ``counted`` table of the distances of the numbers of another one from their group's ``column`` of ``centre``."""
    near = g.join(centre, list(by)) if by else g.crossJoin(F.broadcast(centre))
    return saved(near.groupBy(*by, F.abs(F.col("_v") - F.col(column)).alias("_v")).agg(F.sum("_c").alias("_c")))


def binary_metrics(df: DataFrame, *, y: str, score: str, by: Sequence[str] = (), threshold: float | None = None) -> DataFrame:
    """AUROC, AUPRC (trapezoids on the precision-recall curve), and the confusion measures at a threshold.

    Without a threshold, the first one of greatest tpr - fpr (Youden) is taken. All comes from counts of distinct scores, written once.
    """
    g = saved(df.where(F.col(score).isNotNull() & F.col(y).isNotNull()).groupBy(*by, score).agg(F.sum(F.col(y).cast("double")).alias("p"), F.sum(1.0 - F.col(y)).alias("n")))
    totals = g.groupBy(*by).agg(F.sum("p").alias("all_p"), F.sum("n").alias("all_n"))
    r = running_sums(g, by, score, ["p", "n"], falling=True)
    r = r.join(totals, list(by)) if by else r.crossJoin(F.broadcast(totals))
    tp, fp = F.col("p_run"), F.col("n_run")
    tp0, fp0 = tp - F.col("p"), fp - F.col("n")
    precision, precision0 = tp / (tp + fp), F.when(tp0 + fp0 > 0, tp0 / (tp0 + fp0)).otherwise(1.0)
    div = lambda a, b: F.when(b != 0, a / b)
    best = F.max(F.struct((tp / F.col("all_p") - fp / F.col("all_n")).alias("j"), F.col(score).alias("t")))
    curve = r.groupBy(*by).agg(
        div(F.sum(F.col("n") * (tp + tp0) / 2), F.first("all_p") * F.first("all_n")).alias("auroc"),
        F.sum(F.col("p") / F.col("all_p") * (precision + precision0) / 2).alias("auprc"),
        best.getField("t").alias("youden"), F.first("all_p").alias("all_p"), F.first("all_n").alias("all_n"),
    )
    joined = g.join(curve, list(by)) if by else g.crossJoin(F.broadcast(curve))
    t = F.lit(threshold) if threshold is not None else F.col("youden")
    hit = lambda c: F.sum(F.when(F.col(score) >= t, F.col(c)).otherwise(0.0))
    m = joined.groupBy(*by).agg(*(F.first(c).alias(c) for c in ("auroc", "auprc", "all_p", "all_n")), F.first(t).alias("threshold"), hit("p").alias("tp"), hit("n").alias("fp"))
    return m.select(*by, *confusion(F.col("auroc"), F.col("auprc"), F.col("threshold"), F.col("tp"), F.col("fp"), F.col("all_p"), F.col("all_n")))


def confusion(auroc: Column, auprc: Column, threshold: Column, tp: Column, fp: Column, all_p: Column, all_n: Column) -> list[Column]:
    fn, tn = all_p - tp, all_n - fp
    div = lambda a, b: F.when(b != 0, a / b)
    return [auroc.alias("auroc"), auprc.alias("auprc"), threshold.alias("threshold"), div(tp, tp + fn).alias("sensitivity"), div(tn, tn + fp).alias("specificity"), div(tp, tp + fp).alias("ppv"), div(tn, tn + fn).alias("npv"), ((tp + tn) / (tp + fp + fn + tn)).alias("accuracy"), div(2 * tp, 2 * tp + fp + fn).alias("f1")]


def draws(score: float, y: int, count: int, replicates: int, seed: int) -> np.ndarray:
    """How often each of the resamples takes rows of one score and label: sums of Poisson(1) counts, which are Poisson(count)."""
    word = np.frombuffer(np.float64(score).tobytes(), np.uint64)[0]
    return np.random.Generator(np.random.Philox(key=[int(word), (seed << 1) | y])).poisson(count, replicates).astype(np.float64)


def _by_part(make):
    """Rows (part, score, p, n) in order of part and falling score, one part after another: ``make(part, rows)`` yields output rows."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for b in batches:
            yield from zip(*(c.to_pylist() for c in b.columns), strict=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from itertools import groupby

        for part, some in groupby(rows(batches), key=lambda r: r[0]):
            yield make(part, some)

    return run


def _totals(replicates: int, seed: int):
    def make(part: int, rows: Iterator[tuple]) -> pa.RecordBatch:
        p, n = np.zeros(replicates), np.zeros(replicates)
        for _, score, a, b in rows:
            p += draws(score, 1, a, replicates, seed)
            n += draws(score, 0, b, replicates, seed)
        return pa.RecordBatch.from_arrays([pa.array([part] * replicates, pa.int32()), pa.array(range(replicates), pa.int32()), pa.array(p), pa.array(n)], names=["part", "replicate", "p", "n"])

    return _by_part(make)


def _curves(before: dict[int, tuple[np.ndarray, np.ndarray]], all_p: np.ndarray, all_n: np.ndarray, replicates: int, seed: int):
    def make(part: int, rows: Iterator[tuple]) -> pa.RecordBatch:
        tp, fp = (x.copy() for x in before[part])
        area, prc = np.zeros(replicates), np.zeros(replicates)
        best, at, best_tp, best_fp = np.full(replicates, -np.inf), np.zeros(replicates), np.zeros(replicates), np.zeros(replicates)
        with np.errstate(divide="ignore", invalid="ignore"):
            for _, score, a, b in rows:
                p, n = draws(score, 1, a, replicates, seed), draws(score, 0, b, replicates, seed)
                precision0 = np.where(tp + fp > 0, tp / (tp + fp), 1.0)
                area += n * (tp + p / 2)
                tp, fp = tp + p, fp + n
                prc += np.where(p > 0, p / all_p * (tp / (tp + fp) + precision0) / 2, 0.0)
                j = np.where(p + n > 0, tp / all_p - fp / all_n, -np.inf)
                up = j > best
                best, at, best_tp, best_fp = np.where(up, j, best), np.where(up, score, at), np.where(up, tp, best_tp), np.where(up, fp, best_fp)
        cols = [pa.array([part] * replicates, pa.int32()), pa.array(range(replicates), pa.int32()), *(pa.array(x) for x in (area, prc, best, at, best_tp, best_fp))]
        return pa.RecordBatch.from_arrays(cols, names=["part", "replicate", "area", "prc", "j", "t", "tp", "fp"])

    return _by_part(make)


METRICS = ("auroc", "auprc", "sensitivity", "specificity", "ppv", "npv", "accuracy", "f1")


def resampled_metrics(df: DataFrame, *, y: str, score: str, replicates: int = 100, seed: int = 5) -> DataFrame:
    """The metrics of ``binary_metrics`` for each of many Poisson resamples: one row a replicate; null where a resample has one label only.

    Rows are first counted by score and label, and a resample draws the count of each at once, so no row is multiplied by the replicates and the only shuffles are of the counts.
    They are cut into ranges of the score; each range is read twice, as a stream with one number a replicate for each running sum: for its totals, then, after the totals of the ranges before it, for the
    curves. Draws depend on score, label and seed alone, not on how rows are dealt. Totals are ranges by replicates, which pass the driver.
    """
    g = df.where(F.col(score).isNotNull() & F.col(y).isNotNull()).groupBy(F.col(score).cast("double").alias("score")).agg(F.count_if(F.col(y) == 1).alias("p"), F.count_if(F.col(y) == 0).alias("n"))
    cut = saved(g.repartitionByRange(F.desc("score")).select(F.spark_partition_id().alias("part"), "score", "p", "n"))
    ordered = cut.repartition("part").sortWithinPartitions("part", F.desc("score"))
    sums = ordered.mapInArrow(_totals(replicates, seed), "part int, replicate int, p double, n double").toPandas().sort_values(["part", "replicate"])
    before, all_p, all_n = {}, np.zeros(replicates), np.zeros(replicates)
    for part, rows in sums.groupby("part"):
        before[part] = (all_p, all_n)
        all_p, all_n = all_p + rows["p"].to_numpy(), all_n + rows["n"].to_numpy()
    found = ordered.mapInArrow(_curves(before, all_p, all_n, replicates, seed), "part int, replicate int, area double, prc double, j double, t double, tp double, fp double")
    best = F.max(F.struct("j", "t", "tp", "fp"))
    by = found.groupBy("replicate").agg(F.sum("area").alias("area"), F.sum("prc").alias("prc"), best.alias("b"))
    totals = df.sparkSession.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(zip(all_p, all_n, strict=True))], "replicate int, all_p double, all_n double")
    m = by.join(F.broadcast(totals), "replicate").where("all_p > 0 and all_n > 0")  # a row a replicate
    return m.select("replicate", *confusion(F.col("area") / (F.col("all_p") * F.col("all_n")), F.col("prc"), F.col("b.t"), F.col("b.tp"), F.col("b.fp"), F.col("all_p"), F.col("all_n")))


def bootstrap_ci(df: DataFrame, *, y: str, score: str, replicates: int = 100, seed: int = 5) -> DataFrame:
    """2.5 and 97.5 percentiles of each metric over ``resampled_metrics``."""
    m = resampled_metrics(df, y=y, score=score, replicates=replicates, seed=seed)
    tall = m.select(F.explode(F.array(*(F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n in METRICS))).alias("x")).select("x.*")
    return tall.groupBy("metric").agg(F.percentile("value", F.lit(0.025)).alias("low"), F.percentile("value", F.lit(0.975)).alias("high"), F.count("value").alias("n"))


def brier(y: Column, score: Column) -> Column:
    return F.avg(F.pow(score - y, 2))


def gamma_tail(a: float, x: float) -> float:
    """Regularised upper incomplete gamma function."""
    if x <= 0:
        return 1.0
    if x < a + 1:
        term = total = 1 / a
        n = a
        while abs(term) > abs(total) * 1e-15:
            n += 1
            term *= x / n
            total += term
        return max(0.0, 1 - total * math.exp(-x + a * math.log(x) - math.lgamma(a)))
    b, c, d = x + 1 - a, 1e300, 1 / (x + 1 - a)
    h = d
    for i in range(1, 1000):
        an = -i * (i - a)
        b += 2
        d = 1 / (an * d + b or 1e-300)
        c = b + an / c or 1e-300
        h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return math.exp(-x + a * math.log(x) - math.lgamma(a)) * h


def chi_square_tail(statistic: float, dof: int) -> float:
    return gamma_tail(dof / 2, statistic / 2)


def chi_square(df: DataFrame, column: str, group: str) -> DataFrame:
    """Statistic and degrees of freedom of the contingency table of two columns."""
    obs = df.where(F.col(column).isNotNull() & F.col(group).isNotNull()).groupBy(column, group).count()
    rows, cols = obs.groupBy(column).agg(F.sum("count").alias("r")), obs.groupBy(group).agg(F.sum("count").alias("c"))
    total = obs.agg(F.sum("count").alias("t"))
    grid = rows.crossJoin(cols).crossJoin(F.broadcast(total)).join(obs, [column, group], "left")  # levels, not rows
    e = F.col("r") * F.col("c") / F.col("t")
    return grid.agg(F.sum(F.pow(F.coalesce("count", F.lit(0)) - e, 2) / e).alias("statistic"), ((F.count_distinct(column) - 1) * (F.count_distinct(group) - 1)).alias("dof"))


def fisher_exact(a: int, b: int, c: int, d: int) -> float:
    """Two-sided p of a 2 x 2 table: all tables as unlikely as this one or less."""
    n, r, k = a + b + c + d, a + b, a + c
    logp = lambda x: math.lgamma(r + 1) - math.lgamma(x + 1) - math.lgamma(r - x + 1) + math.lgamma(n - r + 1) - math.lgamma(k - x + 1) - math.lgamma(n - r - k + x + 1) - (math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1))
    here = logp(a)
    return min(1.0, sum(math.exp(p) for x in range(max(0, k - (n - r)), min(r, k) + 1) if (p := logp(x)) <= here + 1e-7))


def fisher_test(df: DataFrame, a: str, b: str) -> DataFrame:
    """Counts of a 2 x 2 table of two 0/1 columns, and the two-sided p; the margins are summed in Spark."""
    cells = (("a", 1, 1), ("b", 1, 0), ("c", 0, 1), ("d", 0, 0))
    row = df.agg(*(F.count_if((F.col(a) == x) & (F.col(b) == y)).alias(n) for n, x, y in cells)).first()
    return df.sparkSession.createDataFrame([(*row, fisher_exact(*row))], "a long, b long, c long, d long, p double")


def compare_proportions(df: DataFrame, column: str, group: str) -> DataFrame:
    """Rows (level, group, n, percent) of a contingency table with the p of the comparison and the test that gave it.

    Pearson's test where at most a fifth of the expected counts is under five and the table is not 2 x 2 with such a
    count; else Fisher's for 2 x 2; other tables keep Pearson's, marked as unsure. Null levels are left out.
    """
    known = df.where(F.col(column).isNotNull() & F.col(group).isNotNull())
    obs = known.groupBy(F.col(column).cast("string").alias("level"), F.col(group).cast("string").alias("group")).count()
    cells = {(r["level"], r["group"]): r["count"] for r in obs.collect()}  # levels by groups, not rows
    rows, cols = sorted({x for x, _ in cells}), sorted({y for _, y in cells})
    total, dof = sum(cells.values()), (len(rows) - 1) * (len(cols) - 1)
    r, k = ({x: sum(cells.get((x, y), 0) for y in cols) for x in rows}, {y: sum(cells.get((x, y), 0) for x in rows) for y in cols})
    expected = {(x, y): r[x] * k[y] / total for x in rows for y in cols}
    few = sum(e < 5 for e in expected.values())
    if len(rows) == len(cols) == 2 and few:
        p, test = fisher_exact(*(cells.get((x, y), 0) for x in rows for y in cols)), "fisher"
    else:
        statistic = sum((cells.get(at, 0) - e) ** 2 / e for at, e in expected.items())
        p, test = chi_square_tail(statistic, dof) if dof else 1.0, "pearson" if few * 5 <= len(expected) else "pearson (unsure)"
    out = [(x, y, cells.get((x, y), 0), 100.0 * cells.get((x, y), 0) / k[y], p, test) for x in rows for y in cols]
    return df.sparkSession.createDataFrame(out, "level string, group string, n long, percent double, p double, test string")


def beta_part(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function, by its continued fraction."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1 - beta_part(b, a, 1 - x)
    front = math.exp(a * math.log(x) + b * math.log1p(-x) + math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)) / a
    tiny = 1e-300
    c, d = 1.0, 1 / (1 - (a + b) * x / (a + 1) or tiny)
    h = d
    for m in range(1, 10_000):
        for step in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 / (1 + step * d or tiny)
            c = 1 + step / c or tiny
            h *= c * d
        if abs(c * d - 1) < 1e-15:
            break
    return front * h


def variance_ratio_tail(f: float, dof1: float, dof2: float) -> float:
    return 1.0 if f <= 0 else beta_part(dof2 / 2, dof1 / 2, dof2 / (dof2 + dof1 * f))


def _tail(function):
    """A column function of the few rows of a result; null where an argument is null or not a number."""

    def rows(x: pd.DataFrame) -> pd.Series:
        return pd.Series([function(*v) if all(y == y and y is not None for y in v) else None for v in x.itertuples(index=False, name=None)], dtype="float64")

    def column(*args: Column) -> Column:
        return F.pandas_udf(rows, "double")(F.struct(*(a.cast("double").alias(f"x{i}") for i, a in enumerate(args))))

    return column


chi_square_p = _tail(chi_square_tail)
variance_p = _tail(variance_ratio_tail)
fisher_p = _tail(lambda *cells: fisher_exact(*map(int, cells)))


def _ranked(g: DataFrame, by: Sequence[str]) -> DataFrame:
    """H and degrees of freedom from counts (by, group, value, count), written once."""
    ties = saved(g.groupBy(*by, "value").agg(F.sum("count").alias("t")))
    r = running_sums(ties, by, "value", ["t"]).select(*by, "value", "t", (F.col("t_run") - F.col("t") + (F.col("t") + 1) / 2).alias("rank"))
    groups = g.join(r, [*by, "value"]).groupBy(*by, "group").agg(F.sum("count").alias("n"), F.sum(F.col("count") * F.col("rank")).alias("s"))
    h = groups.groupBy(*by).agg(F.sum("n").alias("N"), F.sum(F.pow("s", F.lit(2)) / F.col("n")).alias("q"), F.count("*").alias("k"))
    correction = r.groupBy(*by).agg(F.sum(F.pow(F.col("t").cast("double"), 3) - F.col("t")).alias("ties"))
    raw = 12 / (F.col("N") * (F.col("N") + 1)) * F.col("q") - 3 * (F.col("N") + 1)
    both = h.join(correction, list(by)) if by else h.crossJoin(F.broadcast(correction))
    spread = 1 - F.col("ties") / (F.pow(F.col("N").cast("double"), 3) - F.col("N"))
    return both.select(*by, F.when(spread > 0, raw / spread).alias("h"), (F.col("k") - 1).alias("dof"))


def _group_counts(df: DataFrame, value: str, group: str) -> DataFrame:
    known = df.where(F.col(value).isNotNull() & F.col(group).isNotNull())
    return saved(known.groupBy(F.col(group).alias("group"), F.col(value).cast("double").alias("value")).count())


def kruskal_wallis(df: DataFrame, value: str, group: str) -> DataFrame:
    """Tie-corrected H and degrees of freedom; H is null where all values are one.

    Average ranks come from counts of distinct values, so a value that many rows share is one row.
    """
    return _ranked(_group_counts(df, value, group), [])


def kruskal_wallis_p(df: DataFrame, value: str, group: str) -> DataFrame:
    """``kruskal_wallis`` with its p."""
    return kruskal_wallis(df, value, group).withColumn("p", chi_square_p(F.col("h"), F.col("dof")))


def _pairs(g: DataFrame, most_groups: int) -> DataFrame:
    """Counts (a, b, group, ...) of each pair of groups: a table of levels, which are few."""
    levels = [r[0] for r in g.select("group").distinct().limit(most_groups + 1).collect()]
    if len(levels) > most_groups:
        raise ValueError(f"more than {most_groups} groups: choose a column with fewer levels")
    named = [(x, *sorted((x, y))) for x in levels for y in levels if x != y]
    kind = g.schema["group"].dataType.simpleString()
    return g.join(F.broadcast(g.sparkSession.createDataFrame(named, f"group {kind}, a {kind}, b {kind}")), "group")


def pairwise_ranks(df: DataFrame, value: str, group: str, *, most_groups: int = 40) -> DataFrame:
    """For each pair of groups a < b: numbers of rows, medians and quartiles of both, H of the two alone, and its p."""
    g = _group_counts(df, value, group)
    tests = _ranked(saved(_pairs(g, most_groups)), ["a", "b"])
    spread = quantiles_of(once(saved(g.select("group", F.col("value").alias("_v"), F.col("count").alias("_c")))), ["group"], [0.5, 0.25, 0.75]).join(g.groupBy("group").agg(F.sum("count").alias("n")), "group")
    of = lambda side: F.broadcast(spread.select(F.col("group").alias(side), *(F.col(c).alias(f"{n}_{side}") for c, n in (("n", "n"), ("q0", "median"), ("q1", "low"), ("q2", "high")))))  # noqa: E731  # a row a group
    return tests.join(of("a"), "a").join(of("b"), "b").withColumn("p", chi_square_p(F.col("h"), F.col("dof"))).drop("dof")


def pairwise_fisher(df: DataFrame, outcome: str, group: str, *, most_groups: int = 40) -> DataFrame:
    """For each pair of groups x < y: how many rows of each have and have not a 0/1 outcome, and the two-sided p of that table."""
    known = df.where(F.col(outcome).isNotNull() & F.col(group).isNotNull()).groupBy(F.col(group).alias("group")).agg(F.count_if(F.col(outcome) == 1).alias("yes"), F.count_if(F.col(outcome) != 1).alias("no"))
    pairs = _pairs(saved(known), most_groups)
    cell = lambda side, c: F.max(F.when(F.col("group") == F.col(side), F.col(c)))
    cells = pairs.groupBy("a", "b").agg(cell("a", "yes").alias("yes_a"), cell("a", "no").alias("no_a"), cell("b", "yes").alias("yes_b"), cell("b", "no").alias("no_b"))
    return cells.withColumn("p", fisher_p(F.col("yes_a"), F.col("no_a"), F.col("yes_b"), F.col("no_b")))


def anova_oneway(df: DataFrame, value: str, group: str) -> DataFrame:
    """F statistic with its degrees of freedom."""
    g = df.where(F.col(value).isNotNull() & F.col(group).isNotNull()).groupBy(group).agg(F.count("*").alias("n"), F.avg(value).alias("m"), F.var_pop(value).alias("v"))
    s = g.agg(F.sum("n").alias("N"), F.count("*").alias("k"), F.sum(F.col("n") * F.col("m")).alias("t"), F.sum(F.col("n") * F.col("m") * F.col("m")).alias("q"), F.sum(F.col("n") * F.col("v")).alias("within"))
    between = F.col("q") - F.col("t") * F.col("t") / F.col("N")
    return s.select(((between / (F.col("k") - 1)) / (F.col("within") / (F.col("N") - F.col("k")))).alias("f"), (F.col("k") - 1).alias("dof_between"), (F.col("N") - F.col("k")).alias("dof_within"))


def anova_p(df: DataFrame, value: str, group: str) -> DataFrame:
    """``anova_oneway`` with its p."""
    return anova_oneway(df, value, group).withColumn("p", variance_p(F.col("f"), F.col("dof_between"), F.col("dof_within")))


def comparison_table(df: DataFrame, group: str, *, ranked: Sequence[str] = (), normal: Sequence[str] = (), levels: Sequence[str] = (), top: int = 10) -> DataFrame:
    """Rows (variable, level, group, n, display, p, test) for a table that compares groups; the first variable is the size of the groups.

    ``ranked`` numbers show median [quartiles] with the rank test, ``normal`` ones mean (deviation) with the analysis of variance, ``levels`` count (percent) with the test that ``compare_proportions``
    chooses by the expected counts. A variable shows its ``top`` most frequent levels (ties by name) and the others together as "other"; the test takes what is shown.
    Rows without a group are left out.
    """
    known = df.where(F.col(group).isNotNull()).withColumn(group, F.col(group).cast("string"))
    sizes = known.groupBy(group).agg(F.count("*").alias("n"))
    total = known.count()
    row = lambda name, level, n, display, p, test: [F.lit(name).alias("variable"), level.alias("level"), F.col(group).alias("group"), n.alias("n"), display.alias("display"), p.alias("p"), F.lit(test).alias("test") if isinstance(test, str) else test.alias("test")]
    none = F.lit(None).cast("double")
    out = sizes.select(*row("size", F.lit(""), F.col("n"), F.format_string("%.1f%%", 100.0 * F.col("n") / F.lit(float(total or 1))), none, F.lit(None).cast("string")))
    for name in ranked:
        g = _group_counts(known, name, group)
        p = kruskal_wallis_p(known, name, group).select("p").first()[0]  # one row
        q = quantiles_of(once(saved(g.select("group", F.col("value").alias("_v"), F.col("count").alias("_c")))), ["group"], [0.5, 0.25, 0.75]).join(g.groupBy("group").agg(F.sum("count").alias("n")), "group").withColumnRenamed("group", group)
        out = out.union(q.select(*row(name, F.lit(""), F.col("n"), F.format_string("%.2f [%.2f-%.2f]", "q0", "q1", "q2"), F.lit(p).cast("double"), "kruskal")))
    for name in normal:
        p = anova_p(known, name, group).select("p").first()[0]  # one row
        m = known.where(F.col(name).isNotNull()).groupBy(group).agg(F.count("*").alias("n"), F.avg(name).alias("m"), F.stddev_samp(name).alias("s"))
        out = out.union(m.select(*row(name, F.lit(""), F.col("n"), F.format_string("%.2f (%.2f)", F.col("m").cast("double"), F.coalesce("s", F.lit(0.0))), F.lit(p).cast("double"), "anova")))
    for name in levels:
        common = [r[0] for r in known.where(F.col(name).isNotNull()).groupBy(F.col(name).cast("string").alias("x")).count().orderBy(F.desc("count"), "x").limit(top).collect()]
        shown = known.withColumn("_level", F.when(F.col(name).isNull(), None).when(F.col(name).cast("string").isin(common), F.col(name).cast("string")).otherwise("other"))
        c = compare_proportions(shown, "_level", group).withColumnRenamed("group", group)
        out = out.union(c.select(*row(name, F.col("level"), F.col("n"), F.format_string("%d (%.1f%%)", "n", "percent"), F.col("p"), F.col("test"))))
    return out


def summarize_groups(df: DataFrame, group: str, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """Rows (variable, level, group, n, share, median, q1, q3) for a table of groups."""
    sizes = df.groupBy(group).agg(F.count("*").alias("size"))
    out = None
    for c in numeric:
        q = quantiles(df, [group], c, [0.5, 0.25, 0.75])
        part = df.groupBy(group).agg(F.count(c).alias("n")).join(q, group, "left").select(F.lit(c).alias("variable"), F.lit("").alias("level"), group, "n", F.lit(None).cast("double").alias("share"), F.col("q0").alias("median"), F.col("q1").alias("q1"), F.col("q2").alias("q3"))
        out = part if out is None else out.union(part)
    for c in categorical:
        counts = df.where(F.col(c).isNotNull()).groupBy(group, F.col(c).cast("string").alias("level")).agg(F.count("*").alias("n")).join(F.broadcast(sizes), group)
        nothing = [F.lit(None).cast("double").alias(x) for x in ("median", "q1", "q3")]
        part = counts.select(F.lit(c).alias("variable"), "level", group, "n", (F.col("n") / F.col("size")).alias("share"), *nothing)
        out = part if out is None else out.union(part)
    return out


def k_fold(df: DataFrame, key: str, k: int, seed: int = 0) -> DataFrame:
    """Fold 0 .. k - 1 by hash of an id."""
    return df.withColumn("fold", F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(k)).cast("int"))


def oversample(df: DataFrame, y: str, times: int) -> DataFrame:
    """Positive rows repeated."""
    return df.withColumn("_c", F.explode(F.array_repeat(F.lit(1), F.when(F.col(y) == 1, times).otherwise(1)))).drop("_c")


def class_weights(df: DataFrame, y: str) -> DataFrame:
    """Inverse share of each class, over the number of classes."""
    c = df.groupBy(y).count()
    t = c.agg(F.sum("count").alias("t"), F.count("*").alias("k"))
    return c.crossJoin(F.broadcast(t)).select(y, (F.col("t") / (F.col("k") * F.col("count"))).alias("weight"))
