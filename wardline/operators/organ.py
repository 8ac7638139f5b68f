"""The organ failure score from its raw series: oxygenation by as-of ratios, pressors by weight, ventilation, hourly worst values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardline.functions import scalars as S
from wardline.operators import intervals, joins
from wardline.operators.clinical import band_points

c = F.col

#: Room air as percent of oxygen, pounds in a kilogram, the weight that stands for a missing one.
ROOM_AIR, POUNDS, ADULT = 21.0, 2.205, 70.0


def oxygenation(readings: DataFrame, *, by: Sequence[str], at: str, kind: str = "kind", value: str = "value", tie: Sequence[str] = ()) -> DataFrame:
    """Rows (by, at, pf, sf): each reading of ``pao2`` or ``spo2`` over the latest ``fio2`` (percent) up to its time, room air where none came before.

    ``sf`` is the ratio that saturation stands in for; where it is not positive the reading says nothing. Readings without a value are left out.
    """
    known = readings.where(c(value).isNotNull() & c(at).isNotNull())
    oxygen = known.where(c(kind) == "fio2").select(*by, c(at).alias("_fio2_at"), c(value).alias("_fio2"), *tie)
    blood = known.where(c(kind).isin("pao2", "spo2")).select(*by, at, kind, value)
    met = joins.asof_join(blood, oxygen, on=at, right_on="_fio2_at", by=by, values=["_fio2"], tie=tie)
    sf = S.sf_ratio(c(value), c("_fio2"))
    rows = met.select(*by, at, F.when(c(kind) == "pao2", S.pf_ratio(c(value), c("_fio2"))).alias("pf"), F.when((c(kind) == "spo2") & (sf > 0), sf).alias("sf"))
    return rows.where("pf is not null or sf is not null")


def first_weights(weights: DataFrame, *, by: Sequence[str], at: str, weight: str, pounds: Column, tie: Sequence[str] = ()) -> DataFrame:
    """(by, kilograms): the first known weight of each key, pounds as kilograms."""
    kilograms = F.when(pounds, c(weight) / POUNDS).otherwise(c(weight))
    return weights.where(c(weight).isNotNull()).groupBy(*by).agg(F.min_by(kilograms, F.struct(at, *tie)).alias("kilograms"))


def pressor_points(drug: Column, dose: Column) -> Column:
    """Points of one drug by its dose a kilogram and minute; null for other drugs and unknown doses. Dobutamine counts at any dose."""
    adrenergic = drug.isin("epinephrine", "norepinephrine")
    out = F.when(drug == "dobutamine", 2).when(dose.isNull(), None)
    out = out.when(adrenergic & (dose > 0.1), 4).when(adrenergic, 3)
    return out.when((drug == "dopamine") & (dose > 15), 4).when((drug == "dopamine") & (dose > 5), 3).when(drug == "dopamine", 2)


def whole_hours(df: DataFrame, *, by: Sequence[str], start: str, end: str, keep: Sequence[str]) -> DataFrame:
    """A row for each hour from that of the start up to the next full one at the end; intervals that end before they start have none."""
    up = F.when(F.date_trunc("hour", end) < c(end), F.date_trunc("hour", end) + F.expr("INTERVAL 1 HOUR")).otherwise(F.date_trunc("hour", end))
    cut = df.where(c(start) <= c(end)).select(*by, *keep, F.date_trunc("hour", start).alias("_lo"), up.alias("_hi"))
    return intervals.expand_to_grid(cut, start="_lo", end="_hi", step="1 HOUR", name="hour").drop("_lo", "_hi")


def pressor_hours(drugs: DataFrame, weights: DataFrame, *, by: Sequence[str], start: str, end: str, drug: str, rate: str) -> DataFrame:
    """(by, hour, pressor): the worst points of each hour, by the rate over the key's weight (``first_weights``), 70 kg where it is missing."""
    rows = drugs.join(weights, list(by), "left").withColumn("pressor", pressor_points(c(drug), c(rate) / F.coalesce("kilograms", F.lit(ADULT)))).where("pressor is not null")
    return whole_hours(rows, by=by, start=start, end=end, keep=["pressor"]).groupBy(*by, "hour").agg(F.max("pressor").alias("pressor"))


#: Parts that a reading gives by itself, and its organ's bands.
SINGLE = {"platelets": "coagulation", "bilirubin": "liver", "creatinine": "renal", "coma": "consciousness"}


def sofa(readings: DataFrame, pressors: DataFrame, ventilated: DataFrame, stays: DataFrame, *, by: Sequence[str], at: str, tie: Sequence[str] = (), end_stage: DataFrame | None = None, fill_hours: int = 24) -> DataFrame:
    """Six organ parts and their total for each hour of the stays (by, _from, _to).

    readings: (by, at, kind, value) of pao2, spo2, fio2, platelets, bilirubin, creatinine, coma (15 is best) and map. pressors and ventilated: (by, hour, pressor) and (by, hour).
    The worst of an hour, then of 24 hours, then carried forward for ``fill_hours``. Circulation is a pressure under 70 and the pressor points, summed in the hour. Respiration is the
    worse of both ratios, at most 2 unless ventilated in the last 24 hours. Members of ``end_stage`` (by) have 4 for the kidneys.
    """
    hour = F.date_trunc("hour", at)
    kind, value = c("kind"), c("value")
    ratios = oxygenation(readings, by=by, at=at, tie=tie)
    ratio = ratios.groupBy(*by, hour.alias("hour")).agg(*(F.max(band_points(c(r), "respiration")).alias(r) for r in ("pf", "sf")))
    each = [F.max(F.when(kind == k, band_points(value, organ))).alias(organ) for k, organ in SINGLE.items()]
    pressure = F.when((kind == "map") & value.isNotNull(), (value < 70).cast("int"))
    worst = readings.groupBy(*by, hour.alias("hour")).agg(*each, F.max(pressure).alias("pressure"))
    grid = intervals.expand_to_grid(stays.select(*by, F.date_trunc("hour", "_from").alias("_lo"), F.date_trunc("hour", "_to").alias("_hi")), start="_lo", end="_hi", step="1 HOUR", name="hour").drop("_lo", "_hi")
    key = [*by, "hour"]
    rows = grid.join(worst, key, "left").join(ratio, key, "left").join(pressors, key, "left").join(ventilated.select(*key).distinct().withColumn("machine", F.lit(1)), key, "left")
    both = F.when(c("pressure").isNotNull() | c("pressor").isNotNull(), F.coalesce("pressure", F.lit(0)) + F.coalesce("pressor", F.lit(0)))
    rows = rows.withColumn("circulation", both).withColumn("machine", F.coalesce("machine", F.lit(0)))
    held = [*SINGLE.values(), "circulation", "pf", "sf", "machine"]
    day = Window.partitionBy(*by).orderBy("hour").rowsBetween(-23, 0)
    fill = Window.partitionBy(*by).orderBy("hour").rowsBetween(-fill_hours, 0)
    rows = rows.withColumns({n: F.max(n).over(day) for n in held}).withColumns({n: F.last(n, ignorenulls=True).over(fill) for n in held})
    worse = F.greatest("pf", "sf", "machine")
    rows = rows.withColumn("respiration", F.when(c("machine") == 1, worse).otherwise(F.least(worse, F.lit(2))))
    if end_stage is not None:
        rows = rows.join(end_stage.select(*by).distinct().withColumn("_is", F.lit(True)), list(by), "left").withColumn("renal", F.when(c("_is"), 4).otherwise(c("renal"))).drop("_is")
    organs = ["respiration", "coagulation", "liver", "renal", "consciousness", "circulation"]
    return rows.select(*key, *organs, sum((F.coalesce(c(n), F.lit(0)) for n in organs), F.lit(0)).alias("total"))
