"""Clinical composites over the data model: cohorts, comorbidity, kidney injury, organ scores, outcomes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardline.functions import scalars as S
from wardline.operators import intervals, joins, windows
from wardline.operators.aggs import sorted_max

c = F.col


def eligible_cohort(procedures: DataFrame, visits: DataFrame, persons: DataFrame, *, least_age: int = 18, least_hours: int = 24, least_minutes: int = 20, statuses: Sequence[str] = (), facilities: Sequence[int] | None = None) -> DataFrame:
    """First procedure of each stay of adults: long enough, one procedure on its date, in the given statuses and facilities."""
    single = procedures.groupBy("person_id", F.to_date("proc_start").alias("day")).agg(F.count("*").alias("n")).where("n = 1").drop("n")
    rows = procedures.withColumn("day", F.to_date("proc_start")).join(single, ["person_id", "day"], "left_semi")
    rows = rows.join(visits.drop("person_id"), "visit_id").join(persons.select("person_id", "birth_date", "facility_id"), "person_id")
    rows = rows.where((S.datediff_boundary("year", c("birth_date"), c("proc_start")) >= least_age) & (S.datediff_boundary("hour", c("start_at"), c("end_at")) >= least_hours) & (S.datediff_boundary("minute", c("proc_start"), c("proc_end")) > least_minutes))
    rows = rows.where(c("status").isin(*statuses)) if statuses else rows
    rows = rows.where(c("facility_id").isin(*facilities)) if facilities is not None else rows
    return windows.nth_row(rows, ["visit_id"], [c("proc_start"), c("procedure_id")]).select("person_id", "visit_id", "procedure_id", "start_at", "end_at", "proc_start", "proc_end")


def split_by_time(df: DataFrame, *, date: str, key: str, shares: tuple[float, float] = (0.8, 0.1), strata: Sequence[str] = (), least_train: int = 0) -> DataFrame:
    """Development, Validation and Test by the dates at floor(n p) of each stratum; too small a stratum is all Test."""
    by = list(strata) or ["_all"]
    rows = df.withColumn("_all", F.lit(1))
    # counts a day, so that no window reads all rows of a stratum
    days = rows.groupBy(*by, F.to_date(date).alias("_d")).count()
    w = Window.partitionBy(*by)
    upto = days.withColumn("_n", F.sum("count").over(w)).withColumn("_c", F.sum("count").over(w.orderBy("_d")))
    edges = upto.groupBy(*by).agg(*(F.min(F.when(c("_c") >= F.greatest(F.lit(1), F.floor(c("_n") * p)), c("_d"))).alias(f"_e{i}") for i, p in enumerate((shares[0], sum(shares)))), F.first("_n").alias("_n"))
    day = F.to_date(date)
    label = F.when(F.floor(c("_n") * shares[0]) < least_train, "Test").when(day <= c("_e0"), "Development").when(day <= c("_e1"), "Validation").otherwise("Test")
    return rows.join(F.broadcast(edges), by).withColumn("split", label).drop("_all", "_e0", "_e1", "_n")


def split_random(df: DataFrame, *, key: str, shares: tuple[float, float] = (0.8, 0.1), seed: int = 0) -> DataFrame:
    u = F.pmod(F.xxhash64(c(key), F.lit(seed)), F.lit(1_000_000)) / 1_000_000
    return df.withColumn("split", F.when(u < shares[0], "Development").when(u < sum(shares), "Validation").otherwise("Test"))


def assign_subsets(df: DataFrame, *, split: str, key: str, size: int) -> DataFrame:
    """Near-equal chunks of about ``size`` subjects in each split, by hash of the subject."""
    n = df.groupBy(split).agg(F.greatest(F.lit(1), F.ceil(F.count("*") / size)).alias("_chunks"))
    return df.join(F.broadcast(n), split).withColumn("subset_id", F.pmod(F.xxhash64(key), c("_chunks")).cast("int")).drop("_chunks")


def comorbidity_index(conditions: DataFrame, weights: DataFrame, *, subject: str, variable: str = "variable", exclusive: Mapping[str, str] | None = None) -> DataFrame:
    """Weighted score of a subject's distinct conditions; of exclusive pairs the lesser one is dropped."""
    once = conditions.select(subject, variable).distinct()
    for lesser, greater in (exclusive or {}).items():
        worse = once.where(c(variable) == greater).select(subject)
        once = once.where(c(variable) != lesser).unionByName(once.where(c(variable) == lesser).join(worse, subject, "left_anti").select(once.columns))
    return once.join(weights, variable).groupBy(subject).agg(F.sum("weight").alias("score"), F.count("*").alias("n_conditions"))


def medication_counts(anchors: DataFrame, exposures: DataFrame, *, classes: Sequence[str], days: int = 365) -> DataFrame:
    """Distinct drugs of each class whose exposure overlaps the days before the anchor; zero where none."""
    e = exposures.select(c("person_id").alias("_p"), "exp_start", "exp_end", "drug_class", "drug_id")
    on = (c("person_id") == c("_p")) & (c("exp_start") <= c("anchor")) & (c("exp_end") >= c("anchor") - F.expr(f"INTERVAL {days} DAYS"))
    return anchors.join(e, on, "left").groupBy("person_id", "anchor").agg(*(F.count_distinct(F.when(c("drug_class") == k, c("drug_id"))).alias(f"n_{k}") for k in classes))


def lab_features(anchors: DataFrame, labs: DataFrame, *, at: str, value: str, variable: str, spans: Mapping[str, tuple[int, int]], decimals: int = 3) -> DataFrame:
    """min, max, mean, variance (rounded) and count of values so many days before the anchor, for each span."""
    rows = labs.join(anchors, "person_id").withColumn("_d", F.datediff("anchor", at)).where(c(value).isNotNull() & (c(at) <= c("anchor")))
    out = []
    for name, (near, far) in spans.items():
        x = F.when(c("_d").between(near, far), c(value))
        out += [F.min(x).alias(f"{name}_min"), F.max(x).alias(f"{name}_max"), F.round(F.avg(x), decimals).alias(f"{name}_mean"), F.round(F.var_samp(x), decimals).alias(f"{name}_var"), F.count(x).alias(f"{name}_n")]
    return rows.groupBy("person_id", "anchor", variable).agg(*out)


def history_flags(anchors: DataFrame, codes: DataFrame, *, diseases: Sequence[str], strict: Sequence[str] = (), suppressed: Mapping[str, str] | None = None) -> DataFrame:
    """Per disease whether a code stands on or before the anchor's day (strictly before for some), and the latest such day.

    ``suppressed``: a disease whose flag is zero where another one's is set (end stage over chronic disease).
    """
    rows = anchors.join(codes.select(c("person_id").alias("_p"), "code_date", "disease"), (c("person_id") == c("_p")) & (c("code_date") <= F.to_date("anchor")), "left")
    flag = lambda d: (c("disease") == d) & ((c("code_date") < F.to_date("anchor")) if d in strict else F.lit(True))
    out = rows.groupBy("person_id", "anchor").agg(*(F.coalesce(F.max(flag(d).cast("int")), F.lit(0)).alias(d) for d in diseases), *(F.max(F.when(flag(d), c("code_date"))).alias(f"{d}_latest") for d in diseases))
    for lesser, greater in (suppressed or {}).items():
        out = out.withColumn(lesser, F.when(c(greater) == 1, 0).otherwise(c(lesser)))
    return out


def baseline_creatinine(stays: DataFrame, labs: DataFrame, *, at: str, value: str, unique: str, highest: float = 30.0) -> DataFrame:
    """Candidates for a stay's reference creatinine: the stay's minimum, the 7-day minimum (its latest time), and of 8 to 365 days before
    the median with the row nearest to it (the latest of those); the reference is the least of the three."""
    rows = stays.join(labs.where(c(value) <= highest), "person_id")
    days = F.datediff("start_at", at)
    week, year = days.between(0, 7) & (c(at) <= c("start_at")), days.between(8, 365)
    lowest = F.min(F.when(week, F.struct(c(value).alias("v"), (-F.unix_micros(at)).alias("t"))))
    got = rows.groupBy("visit_id").agg(
        F.min(F.when(c(at).between(c("start_at"), c("end_at")), c(value))).alias("stay_min"), lowest.getField("v").alias("week_min"), F.timestamp_micros(-lowest.getField("t")).alias("week_min_at"), F.median(F.when(year, c(value))).alias("year_median")
    )
    near = rows.where(year).join(got.select("visit_id", "year_median"), "visit_id").groupBy("visit_id").agg(F.min(F.struct(F.abs(c(value) - c("year_median")).alias("d"), (-F.unix_micros(at)).alias("t"), c(unique).alias("id"))).getField("id").alias("median_row"))
    return got.join(near, "visit_id", "left").withColumn("reference", F.least("stay_min", "week_min", "year_median"))


def creatinine_history(anchors: DataFrame, labs: DataFrame, *, at: str, value: str, rate: str, limit: float = 60.0, days: int = 90, recent: int = 30) -> DataFrame:
    """Flags of the values before an anchor: any in the year before, two at least ``days`` apart, two rates up to ``limit`` so far
    apart and not of the last ``recent`` days, a low rate in those days; and the first value."""
    rows = anchors.join(labs, "person_id").where(c(at) < c("anchor"))
    ago = F.datediff("anchor", at)
    low = (c(rate) <= limit) & (ago > recent)
    spread = lambda k: F.datediff(F.max(F.when(k, c(at))), F.min(F.when(k, c(at))))
    flag = lambda x: F.coalesce(x.cast("int"), F.lit(0))
    return rows.groupBy("person_id", "anchor").agg(
        F.max((ago <= 365).cast("int")).alias("previous_year"), flag(spread(F.lit(True)) >= days).alias("two_apart"), flag(spread(low) >= days).alias("two_low"),
        F.max(((c(rate) <= limit) & (ago <= recent)).cast("int")).alias("recent_low"), F.min_by(value, at).alias("first_value"),
    )


def ckd_stage(egfr: Column) -> Column:
    """Stage of kidney disease by filtration rate."""
    return F.when(egfr >= 90, "G1").when(egfr >= 60, "G2").when(egfr >= 45, "G3a").when(egfr >= 30, "G3b").when(egfr >= 15, "G4").when(egfr.isNotNull(), "G5")


def ckd_class(esrd: Column, transplant: Column, codes: Column, low_rates: Column) -> Column:
    """Class of a patient: end stage, transplant, by code, by two low rates 90 days apart, or none."""
    return F.when(esrd == 1, "ESRD").when(transplant == 1, "Transplant").when(codes == 1, "CKD by code").when(low_rates == 1, "CKD by creatinine").otherwise("No CKD")


def reference_creatinine(candidates: Sequence[Column], kidney_class: Column, age: Column, female: Column) -> Column:
    """The least candidate; without known kidney disease the value back-calculated from a normal rate counts too."""
    known = F.least(*candidates) if len(candidates) > 1 else candidates[0]
    return F.when(kidney_class == "No CKD", F.least(known, S.baseline_creatinine(age, female))).otherwise(known)


def detect_aki(labs: DataFrame, *, by: Sequence[str], at: str, value: str, reference: str, rrt: str | None = None) -> DataFrame:
    """Stage of kidney injury at each value: by its rise over the least value of 48 hours, or its ratio to the reference.

    Stages: 1 from 1.5 times or a rise of 0.3; 2 from 2 times; 3 from 3 times or 4.0; 4 with replacement therapy.
    """
    rolled = windows.rolling(labs, by, at, value, F.min, back=2 * windows.DAY, name="least_48h")
    x, ratio = c(value), c(value) / c(reference)
    rise = (x - c("least_48h") >= 0.3) & (x - c(reference) >= 0.3)
    stage = F.when((ratio >= 3) | ((x >= 4.0) & (rise | (ratio > 1.5))), 3).when(ratio >= 2, 2).when(rise | (ratio > 1.5), 1).otherwise(0)
    if rrt:  # replacement therapy within seven days before counts as the worst stage
        recent = F.max(F.coalesce(c(rrt), F.lit(0))).over(Window.partitionBy(*by).orderBy(F.unix_micros(at)).rangeBetween(-7 * windows.DAY, 0))
        stage = F.when(recent == 1, 4).otherwise(stage)
    return rolled.withColumn("stage", stage)


def aki_trajectory(days: DataFrame, *, by: Sequence[str], day: str, stage: str) -> DataFrame:
    """Episodes of injury with worst stage, whether they last over two days (persistent) or seven, and recovery."""
    flagged = days.withColumn("_f", (c(stage) > 0).cast("int"))
    eps = windows.episodes(flagged, by, day, "_f")
    last = days.groupBy(*by).agg(F.max(day).alias("last_day"))
    worst = eps.join(days.select(*by, c(day).alias("_day"), stage), list(by)).where(c("_day").between(c("begin_day"), c("end_day"))).groupBy(*by, "episode", "begin_day", "end_day", "length").agg(F.max(stage).alias("worst"))
    out = worst.join(last, list(by))
    kind = F.when(c("length") > 7, "acute disease").when(c("length") > 2, "persistent").otherwise("rapid reversal")
    return out.select(*by, "episode", "begin_day", "end_day", "length", "worst", kind.alias("kind"), (c("end_day") < c("last_day")).cast("int").alias("recovered"))


def daily_injury(stages: DataFrame, *, by: Sequence[str], at: str, stage: str) -> DataFrame:
    """Worst stage of each day from the first to the last with a value; days between carry the stage before."""
    worst = stages.groupBy(*by, F.to_date(at).alias("day")).agg(F.max(stage).alias("stage"))
    return intervals.densify_calendar(worst, by=by, day="day", values=["stage"])


def injury_summary(episodes: DataFrame, *, by: Sequence[str], most: int = 20) -> DataFrame:
    """One row a group: number of episodes, worst stage, overall type, recovery, and columns of the first ``most`` episodes.

    The overall type is that of the longest kind; a group whose only episode has not ended by its last day within two days of
    its beginning is undetermined.
    """
    each = [F.max(F.when(c("episode") == k, c(x))).alias(f"{x}_{k}") for k in range(1, most + 1) for x in ("begin_day", "length", "worst")]
    rank = F.when(c("kind") == "acute disease", 3).when(c("kind") == "persistent", 2).otherwise(1)
    out = episodes.groupBy(*by).agg(F.count("*").alias("n_episodes"), F.max("worst").alias("worst"), F.max(rank).alias("_r"), F.min("recovered").alias("recovered"), F.sum("length").alias("total_days"), *each)
    overall = F.when((c("recovered") == 0) & (c("n_episodes") == 1) & (c("total_days") <= 2), "undetermined").when(c("_r") == 3, "acute disease").when(c("_r") == 2, "persistent").otherwise("rapid reversal")
    return out.withColumn("overall", overall).drop("_r")


def mortality(visits: DataFrame, deaths: DataFrame, *, horizons: Sequence[int] = (1, 3, 7), place: str | None = None) -> DataFrame:
    """Death in the stay and within days of its end, by hours and by calendar day.

    With the column of the discharge ``place``, a stay also ends in death where it is "dead", or "hospice" with a death up to seven days after.
    """
    rows = visits.join(deaths, "person_id", "left")
    hours = (F.unix_micros("death_at") - F.unix_micros("end_at")) / 3.6e9
    flags = [F.coalesce(((hours >= 0) & (hours <= 24 * h)).cast("int"), F.lit(0)).alias(f"dead_{h}d") for h in horizons]
    days = [F.coalesce(F.datediff("death_at", "end_at").between(0, h).cast("int"), F.lit(0)).alias(f"dead_{h}_days") for h in horizons]
    died = F.coalesce(c("death_at").between(c("start_at"), c("end_at")), F.lit(False))
    if place:
        died = died | F.coalesce(c(place) == "dead", F.lit(False)) | F.coalesce((c(place) == "hospice") & (hours >= 0) & (hours <= 168), F.lit(False))
    return rows.select("visit_id", died.cast("int").alias("died_in_stay"), *flags, *days)


def clean_deaths(hospital: DataFrame, index: DataFrame) -> DataFrame:
    """One time of death a person: the earliest of the hospital, or else of the index (person_id, death_at)."""
    both = hospital.select("person_id", c("death_at").alias("h"), F.lit(None).cast("timestamp").alias("i")).unionByName(index.select("person_id", F.lit(None).cast("timestamp").alias("h"), c("death_at").alias("i")))
    return both.groupBy("person_id").agg(F.coalesce(F.min("h"), F.min("i")).alias("death_at"))


def icu_stays(locations: DataFrame, *, by: Sequence[str], start: str, end: str, label: str, unit: str, gap: str = "24 HOURS") -> DataFrame:
    """Intervals of one kind of location, condensed over short gaps."""
    return intervals.condense_intervals(locations.where(c(label) == unit), by=by, start=start, end=end, gap=gap)


def delirium(screens: DataFrame, visits: DataFrame, *, at: str, value: str, positive: str, hours: Sequence[int] = (24, 72)) -> DataFrame:
    """Any positive screen within hours of the anchor, and in the stay; zero where none was positive."""
    rows = visits.join(screens.select(c("person_id").alias("_p"), c(at).alias("_at"), c(value).alias("_v")), (c("person_id") == c("_p")) & c("_at").between(c("start_at"), c("end_at")), "left")
    hit = F.coalesce(c("_v") == positive, F.lit(False))
    return rows.groupBy("visit_id").agg(F.max(hit.cast("int")).alias("in_stay"), *(F.max((hit & (c("_at") <= c("start_at") + F.expr(f"INTERVAL {h} HOURS"))).cast("int")).alias(f"within_{h}h") for h in hours))


def flags_if_observed(rows: DataFrame, by: Sequence[str], flags: Mapping[str, Column]) -> DataFrame:
    """Flags over a group that are null where nothing was observed."""
    return rows.groupBy(*by).agg(*(F.max(F.when(f.isNotNull(), f.cast("int"))).alias(n) for n, f in flags.items()))


def any_flag(*columns: str) -> Column:
    """1 if any flag is, null if all are null."""
    return F.greatest(*columns) if len(columns) > 1 else c(columns[0])


# Bands of the organ scores, worst first, as (limit, limit included, points).
BANDS: dict[str, tuple[str, tuple[tuple[float, bool, int], ...]]] = {
    "respiration": ("under", ((100, False, 4), (200, False, 3), (300, False, 2), (400, False, 1))),
    "coagulation": ("under", ((20, False, 4), (50, False, 3), (100, False, 2), (150, False, 1))),
    "liver": ("over", ((12.0, False, 4), (6.0, True, 3), (2.0, True, 2), (1.2, True, 1))),
    "renal": ("over", ((5.0, False, 4), (3.5, True, 3), (2.0, True, 2), (1.2, True, 1))),
    "consciousness": ("under", ((6, False, 4), (9, True, 3), (12, True, 2), (14, True, 1))),
}


def band_points(value: Column, organ: str) -> Column:
    """Points of the first band that holds the value; zero beyond all, null without a value."""
    side, bands = BANDS[organ]
    out = F.when(value.isNull(), None)
    for limit, included, points in bands:
        inside = (value < limit if side == "under" else value > limit) | ((value == limit) if included else F.lit(False))
        out = out.when(inside, points)
    return out.otherwise(0)


def cardiovascular_points(map_: Column, doses: Mapping[str, Column]) -> Column:
    """Points of mean arterial pressure under 70 and of pressors by dose a kilogram and minute; the worst counts."""
    pressors = [above(dose, PRESSORS[drug]) for drug, dose in doses.items()]
    return F.greatest(F.when(map_ < 70, 1).when(map_.isNotNull(), 0), *pressors) if pressors else F.when(map_ < 70, 1).when(map_.isNotNull(), 0)


def quick_score(respiratory_rate: Column, systolic: Column, consciousness: Column) -> dict[str, Column]:
    """Parts of the quick score: breaths from 22, systolic pressure up to 100, consciousness under 15."""
    part = lambda value, hit: F.when(value.isNotNull(), hit.cast("int"))
    return {"rate": part(respiratory_rate, respiratory_rate >= 22), "pressure": part(systolic, systolic <= 100), "mind": part(consciousness, consciousness < 15)}


def hourly_points(doses: DataFrame, visits: DataFrame, *, key: str, at: str, points: str) -> DataFrame:
    """The worst points of each hour of the visits. Hours are made by sorting before the visits are met, so a task holds neither all hours in a table nor doses beside visits."""
    hours = doses.where(F.col(key).isNotNull()).repartition(key).groupBy(key, F.date_trunc("hour", at).alias("hour")).agg(sorted_max(F.col(points)).alias(points))
    return hours.join(visits.select(key), key, "left_semi")


def electronic_score(visits: DataFrame, *, creatinine: str, bilirubin: str, platelets: str, lactate: str, pressor: str, ventilated: str, esrd: str, suffix: str = "_base") -> DataFrame:
    """Six parts from a visit's worst values and their baselines (column + suffix), null values giving no point.

    Renal: creatinine twice its baseline, or end-stage disease. Liver: bilirubin from 2 and twice its baseline. Coagulation:
    platelets under 100 and half of a baseline of at least 100. Perfusion: lactate from 2. Pressor and ventilation: any.
    """
    hit = lambda x: F.coalesce(x, F.lit(False)).cast("int")
    parts = {
        "renal": hit((c(creatinine) >= 2 * c(creatinine + suffix)) | (c(esrd) == 1)), "liver": hit((c(bilirubin) >= 2) & (c(bilirubin) >= 2 * c(bilirubin + suffix))),
        "coagulation": hit((c(platelets) < 100) & (c(platelets) <= 0.5 * c(platelets + suffix)) & (c(platelets + suffix) >= 100)), "perfusion": hit(c(lactate) >= 2),
        "pressor": hit(c(pressor) == 1), "ventilation": hit(c(ventilated) == 1),
    }
    return visits.withColumns(parts).withColumn("total", sum((c(p) for p in parts), F.lit(0)))


#: Dose bands of pressors in mcg a kilogram and minute, worst first.
PRESSORS = {"dopamine": ((15.0, 4), (5.0, 3), (0.0, 2)), "epinephrine": ((0.1, 4), (0.0, 3)), "norepinephrine": ((0.1, 4), (0.0, 3)), "dobutamine": ((0.0, 2),)}


def above(value: Column, bands: Sequence[tuple[float, int]]) -> Column:
    out = F.when(value.isNull(), None)
    for limit, points in bands:
        out = out.when(value > limit, points)
    return out.otherwise(0)


def hourly_scores(readings: DataFrame, *, by: Sequence[str], at: str, parts: Mapping[str, Column], fill_hours: int = 24, stays: DataFrame | None = None, override: Mapping[str, tuple[DataFrame, int]] | None = None) -> DataFrame:
    """Organ scores by hour: worst points of each part in the hour, over 24 hours, carried forward, and their total.

    parts: points of a reading by part, null for readings of other variables. ``stays`` (by, _from, _to) bounds the hours of
    each group, so that long gaps between stays have no rows. ``override`` gives the members of a table (by) fixed points of a part.
    """
    if stays is not None:
        readings = readings.join(stays, list(by)).where(c(at).between(c("_from"), c("_to"))).drop("_from", "_to")
    hour = F.date_trunc("hour", at)
    worst = readings.groupBy(*by, hour.alias("hour")).agg(*(F.max(p).alias(n) for n, p in parts.items()))
    grid = worst.groupBy(*by).agg(F.min("hour").alias("_lo"), F.max("hour").alias("_hi"))
    grid = intervals.expand_to_grid(grid, start="_lo", end="_hi", step="1 HOUR", name="hour").drop("_lo", "_hi").join(worst, [*by, "hour"], "left")
    day = Window.partitionBy(*by).orderBy("hour").rowsBetween(-23, 0)
    fill = Window.partitionBy(*by).orderBy("hour").rowsBetween(-fill_hours, 0)
    grid = grid.withColumns({n: F.max(n).over(day) for n in parts})
    grid = grid.withColumns({n: F.last(n, ignorenulls=True).over(fill) for n in parts})
    for n, (members, points) in (override or {}).items():
        grid = grid.join(members.select(*by).distinct().withColumn("_is", F.lit(True)), list(by), "left").withColumn(n, F.when(c("_is"), points).otherwise(c(n))).drop("_is")
    total = sum((F.coalesce(c(n), F.lit(0)) for n in parts), F.lit(0))
    return grid.withColumn("total", total)


def station_features(anchors: DataFrame, locations: DataFrame, *, at: str = "anchor", units: Mapping[str, str]) -> DataFrame:
    """Location before and after an anchor (as-of), and hours to the first location of each unit after it."""
    out = joins.asof_join(anchors, locations.select("person_id", c("loc_start").alias("at_"), c("label").alias("before_label")), on=at, right_on="at_", by=["person_id"], values=["before_label"], strict=True).drop("matched_at")
    out = joins.asof_join(out, locations.select("person_id", c("loc_start").alias("at_"), c("label").alias("after_label")), on=at, right_on="at_", by=["person_id"], values=["after_label"], direction="forward", strict=True).drop("matched_at")
    for name, label in units.items():
        only = locations.where(c("label") == label).select("person_id", c("loc_start").alias("at_"), c("event_id").alias("_id"))
        out = joins.asof_join(out, only, on=at, right_on="at_", by=["person_id"], values=["_id"], direction="forward").withColumn(f"hours_to_{name}", (F.unix_micros("matched_at") - F.unix_micros(at)) / 3.6e9).drop("_id", "matched_at")
    return out


def exclusive_duration(df: DataFrame, *, by: Sequence[str], start: str, end: str, priority: str, label: str, wanted: str, cap_days: int = 30) -> DataFrame:
    """Hours of one label once overlaps are resolved by priority; an interval counts ``cap_days`` at most."""
    capped = df.withColumn(end, F.least(c(end), c(start) + F.expr(f"INTERVAL {cap_days} DAYS")))
    won = intervals.resolve_overlaps(capped, by=by, start=start, end=end, priority=priority, label=label)
    return won.where(c(label) == wanted).groupBy(*by).agg((F.sum(F.unix_micros(end) - F.unix_micros(start)) / 3.6e9).alias("hours"), F.count("*").alias("n_spells"))


def ratio_score(values: DataFrame, *, limit: float, ratio: float, least_baseline: float, need: int) -> DataFrame:
    """Score if enough of three rules hold: absolute limit, ratio to baseline, and baseline high enough."""
    hits = (c("value") >= limit).cast("int") + (c("value") / c("baseline") >= ratio).cast("int") + (c("baseline") >= least_baseline).cast("int")
    return values.withColumn("rules", F.coalesce(hits, F.lit(0))).withColumn("score", (c("rules") >= need).cast("int"))


def second_procedure(procedures: DataFrame, hours: int = 720) -> DataFrame:
    """Next procedure of the person within some hours, with the interval."""
    w = Window.partitionBy("person_id").orderBy("proc_start", "procedure_id")
    gap = (F.unix_micros(F.lead("proc_start").over(w)) - F.unix_micros("proc_end")) / 3.6e9
    return procedures.select("procedure_id", F.lead("procedure_id").over(w).alias("next_id"), F.lead("code").over(w).alias("next_code"), gap.alias("hours")).where((c("hours") >= 0) & (c("hours") <= hours))


def counts_with_totals(df: DataFrame, rows: Sequence[str], column: str, values: Sequence[str]) -> DataFrame:
    """Counts of each value by row group, with a total column and a total row."""
    cells = [F.count(F.when(c(column) == v, 1)).alias(v) for v in values]
    each = df.groupBy(*rows).agg(*cells, F.count("*").alias("total"))
    return each.unionByName(df.agg(*cells, F.count("*").alias("total")).select(*(F.lit("Total").alias(r) for r in rows), *values, "total"))


def describe_injury(stages: DataFrame, *, by: Sequence[str], at: str, stage: str) -> DataFrame:
    """Each value as AKI (first two days of an episode), Persistent AKI (to seven), AKD (later), Recovery or none.

    Recovery is a value without injury within seven days of the last one with it; a pause of over two days
    ends an episode.
    """
    w = Window.partitionBy(*by).orderBy(at)
    last = F.last(F.when(c(stage) > 0, c(at)), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    fresh = (c(stage) > 0) & (last.isNull() | (F.unix_micros(at) - F.unix_micros(last) > 2 * windows.DAY))
    begun = stages.withColumn("_last", last).withColumn("_new", fresh).withColumn("_begin", F.last(F.when(c("_new"), c(at)), ignorenulls=True).over(w))
    days = (F.unix_micros(at) - F.unix_micros("_begin")) / windows.DAY
    label = F.when(c(stage) > 0, F.when(days <= 2, "AKI").when(days <= 7, "Persistent AKI").otherwise("AKD")).when(F.unix_micros(at) - F.unix_micros("_last") <= 7 * windows.DAY, "Recovery")
    return begun.withColumn("description", label).drop("_last", "_new", "_begin")


def filter_creatinine(labs: DataFrame, encounters: DataFrame, *, value: str, unit: str, factors: Mapping[str, float]) -> DataFrame:
    """Positive values in the standard unit, of persons with an admissible encounter; units without factor go."""
    fixed = labs.withColumn(value, S.convert_unit(c(value), c(unit), dict(factors)))
    return fixed.where(c(value) > 0).join(encounters.select("person_id").distinct(), "person_id", "left_semi")


def merge_outputs(batches: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Results of several batches as one table; of rows with equal keys that of the first batch stands, the least by its columns."""
    out = batches[0].withColumn("_batch", F.lit(0))
    for i, b in enumerate(batches[1:], 1):
        out = out.unionByName(b.withColumn("_batch", F.lit(i)), allowMissingColumns=True)
    rest = [x for x in out.columns if x not in (*keys, "_batch")]
    return out.groupBy(*keys).agg(F.min(F.struct("_batch", *rest)).alias("_one")).select(*keys, *(F.col(f"_one.{x}") for x in rest))
