"""Joins beyond equality: as-of, interval, effective-dated, follow-up and nearest-neighbour."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardline.functions.scalars import nearest_second
from wardline.operators.saved import saved


def asof_join(left: DataFrame, right: DataFrame, *, on: str, by: Sequence[str], right_on: str | None = None, values: Sequence[str], direction: str = "backward", strict: bool = False, tolerance: str | None = None, tie: Sequence[str] = ()) -> DataFrame:
    """Each left row with the nearest earlier (backward) or later (forward) right row of its ``by`` key.

    Both sides are stacked and read in time order by one window, so there is one shuffle and no range join. ``strict``
    leaves out equal times; of right rows at one time the last by ``tie`` (backward) or the first (forward) is
    taken. Left rows without a match keep nulls; null keys match nothing.
    """
    right_on = right_on or on
    back = direction == "backward"
    kept = F.struct(F.col(right_on).alias("_at"), *(F.col(v).alias(v) for v in values))
    # order of the sides at one time: a strict match must not see equal times
    side_left = (0 if strict else 1) if back else (1 if strict else 0)
    a = left.select(*(F.col(c).alias(f"_k{i}") for i, c in enumerate(by)), F.col(on).alias("_ts"), F.lit(side_left).alias("_side"), F.struct(*left.columns).alias("_left"), F.lit(None).alias("_right"), *(F.lit(None).alias(f"_t{i}") for i in range(len(tie))))
    b = right.select(*(F.col(c).alias(f"_k{i}") for i, c in enumerate(by)), F.col(right_on).alias("_ts"), F.lit(1 - side_left).alias("_side"), F.lit(None).alias("_left"), kept.alias("_right"), *(F.col(c).alias(f"_t{i}") for i, c in enumerate(tie)))
    b = b.where(F.col("_ts").isNotNull() & reduce(lambda x, y: x & y, (F.col(f"_k{i}").isNotNull() for i in range(len(by)))))
    w = Window.partitionBy(*(f"_k{i}" for i in range(len(by)))).orderBy("_ts", "_side", *(f"_t{i}" for i in range(len(tie))))
    match = F.last("_right", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)) if back else F.first("_right", ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing))
    out = a.unionByName(b).withColumn("_m", match).where(F.col("_left").isNotNull()).select("_left.*", F.col("_ts").alias("_ts"), F.col("_m").alias("_m"))
    near = F.lit(True)
    if tolerance:
        near = (F.col("_m._at") >= F.col("_ts") - F.expr(f"INTERVAL {tolerance}")) if back else (F.col("_m._at") <= F.col("_ts") + F.expr(f"INTERVAL {tolerance}"))
    near = near & F.col("_ts").isNotNull()
    return out.select(*left.columns, *(F.when(near, F.col(f"_m.{v}")).alias(v) for v in values), F.when(near, F.col("_m._at")).alias("matched_at"))


def interval_join(facts: DataFrame, windows: DataFrame, *, key: str, at: str, start: str, end: str, how: str = "inner", bin_seconds: int | None = None) -> DataFrame:
    """Facts whose time lies in a window of their key, both ends included.

    ``bin_seconds`` adds a time bin to the key, so that a key with very many facts spreads over tasks (inner only).
    """
    w = windows.withColumnRenamed(key, "_key")
    within = (F.col(key) == F.col("_key")) & F.col(at).between(F.col(start), F.col(end))
    if bin_seconds and how == "inner":
        number = lambda c: F.floor(F.unix_seconds(c) / bin_seconds)
        w = w.withColumn("_bin", F.explode(F.sequence(number(F.col(start)), number(F.col(end)))))
        return facts.withColumn("_fbin", number(F.col(at))).join(w, within & (F.col("_fbin") == F.col("_bin"))).drop("_key", "_bin", "_fbin")
    return facts.join(w, within, how).drop("_key")


def effective_dated_join(facts: DataFrame, reference: DataFrame, *, keys: Sequence[str], at: str, start: str, end: str) -> DataFrame:
    """Left join with the reference row whose dates include the fact's; open ends may be null."""
    ref = reference.select(*(F.col(k).alias(f"_r_{k}") if k in keys else F.col(k) for k in reference.columns))
    on = reduce(lambda a, b: a & b, (F.col(k) == F.col(f"_r_{k}") for k in keys))
    on = on & (F.col(at) >= F.col(start)) & (F.col(end).isNull() | (F.col(at) <= F.col(end)))
    return facts.join(ref, on, "left").drop(*(f"_r_{k}" for k in keys))


def overlap_join(a: DataFrame, b: DataFrame, *, key: str, a_start: str, a_end: str, b_start: str, b_end: str, how: str = "inner", bin_seconds: int | None = None) -> DataFrame:
    """Pairs of intervals of one key that overlap or touch.

    ``bin_seconds`` sends both sides to the time bins that they touch, so that a key with very many intervals spreads
    over tasks (inner only); a pair counts in the bin where the later of the two starts.
    """
    right = b.withColumnRenamed(key, "_key")
    on = (F.col(key) == F.col("_key")) & (F.col(a_start) <= F.col(b_end)) & (F.col(a_end) >= F.col(b_start))
    if bin_seconds and how == "inner":
        number = lambda c: F.floor(F.unix_seconds(c) / bin_seconds)
        bins = lambda start, end: F.explode(F.when(F.col(start) <= F.col(end), F.sequence(number(start), number(end))))
        left, right = a.withColumn("_abin", bins(a_start, a_end)), right.withColumn("_bbin", bins(b_start, b_end))
        on = on & (F.col("_abin") == F.col("_bbin")) & (F.col("_abin") == number(F.greatest(a_start, b_start)))
        return left.join(right, on).drop("_key", "_abin", "_bbin")
    return a.join(right, on, how).drop("_key")


def followup_flag(visits: DataFrame, *, person: str, visit: str, start: str, end: str, days: int) -> DataFrame:
    """Per visit, whether another one of the person starts within so many days of its end."""
    return visits.join(followup_flags(visits, person=person, visit=visit, start=start, end=end, days=days, flags={"followed_up": F.lit(True)}), visit)


def followup_flags(visits: DataFrame, *, person: str, visit: str, start: str, end: str, days: int, flags: dict[str, Column]) -> DataFrame:
    """Per visit, for each flag whether another visit of the person with it starts within so many days of the end.

    Starts and ends of a person go in one order of time; each end counts, by a range window, the starts that follow
    within the days. A visit that starts when it ends is no follow-up of itself. No pairs of visits are built.
    """
    wanted = [f.cast("int").alias(f"_f_{n}") for n, f in flags.items()]
    rows = visits.select(person, visit, F.unix_micros(start).alias("_s"), F.unix_micros(end).alias("_e"), *wanted)
    starts = rows.select(person, F.lit(None).cast(visits.schema[visit].dataType).alias(visit), F.col("_s").alias("_t"), *(F.col(f"_f_{n}") for n in flags), *(F.lit(0).alias(f"_o_{n}") for n in flags))
    own = [F.when(F.col("_s") == F.col("_e"), F.coalesce(F.col(f"_f_{n}"), F.lit(0))).otherwise(0).alias(f"_o_{n}") for n in flags]
    ends = rows.select(person, visit, F.col("_e").alias("_t"), *(F.lit(0).alias(f"_f_{n}") for n in flags), *own)
    w = Window.partitionBy(person).orderBy("_t").rangeBetween(0, days * 86_400_000_000)
    counted = starts.unionByName(ends).withColumns({n: (F.coalesce(F.sum(f"_f_{n}").over(w), F.lit(0)) - F.col(f"_o_{n}") > 0).cast("int") for n in flags})
    return counted.where(F.col(visit).isNotNull()).groupBy(visit).agg(*(F.max(n).alias(n) for n in flags))


def pair_within(num: DataFrame, den: DataFrame, *, key: str, at: str, value: str, seconds: int) -> DataFrame:
    """Ratios of values of one key whose times, to the nearest second, differ by at most so many seconds.

    Times are cut into bins of that length and each denominator stands in its own bin and the two beside it, so a pair
    meets once, in the bin of its numerator, and a key with very many rows spreads over its bins.
    """
    number = lambda c: F.floor(nearest_second(F.col(c)) / max(seconds, 1))
    a = num.select(key, F.col(at).alias("num_at"), F.col(value).alias("num")).withColumn("_bin", number("num_at"))
    b = den.where(F.col(value) != 0).select(F.col(key).alias("_k"), F.col(at).alias("den_at"), F.col(value).alias("den"))
    b = b.withColumn("_b", F.explode(F.sequence(number("den_at") - 1, number("den_at") + 1)))
    near = F.abs(nearest_second(F.col("num_at")) - nearest_second(F.col("den_at"))) <= seconds
    return a.join(b, (F.col(key) == F.col("_k")) & (F.col("_bin") == F.col("_b")) & near).select(key, "num_at", "den_at", (F.col("num") / F.col("den")).alias("ratio"))


#: Cells are cut into 4 x 4 at each level of ``nearest_neighbour``, at most so many times, until none holds more than LEAF places.
CUTS, LEAF = 12, 32


def nearest_neighbour(keys: DataFrame, reference: DataFrame, *, key: str, x: str, y: str) -> DataFrame:
    """For distinct keys with coordinates, the reference key at the least distance (ties: the least key); without coordinates, 'missing'.

    Reference places lie in nested square cells, each with the bounds of its places. A position, of however many keys, goes down level by level: of the cells below those that are left, it keeps
    the ones that may hold something nearer than what the best of them is sure to hold. All meetings are by the number of a cell, a position keeps a few cells a level, and the result is
    exact for any number of places. Reference keys without coordinates are left out; the number of levels comes from one aggregate of the reference.
    """
    ref = reference.where(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(F.col(x).cast("double").alias("_rx"), F.col(y).cast("double").alias("_ry")).agg(F.min(key).alias("ref_key"))
    found = keys.select(key, F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y")).distinct()
    box = ref.agg(F.min("_rx").alias("x0"), F.min("_ry").alias("y0"), F.greatest(F.max("_rx") - F.min("_rx"), F.max("_ry") - F.min("_ry")).alias("side")).first()
    if box["side"] is None:
        return found.select(key).distinct().select(key, F.lit("missing").alias("nearest"), F.lit(None).cast("double").alias("distance"))
    side = box["side"] or 1.0
    cell = lambda c, low, level: F.least(F.floor((F.col(c) - low) / side * 4**level), F.lit(4**level - 1)).cast("long")
    at = lambda level: (cell("_rx", box["x0"], level).alias("_i"), cell("_ry", box["y0"], level).alias("_j"))
    sizes = ref.select(F.explode(F.array(*(F.struct(F.lit(n).alias("level"), *at(n)) for n in range(1, CUTS + 1)))).alias("c")).groupBy("c").count().groupBy("c.level").agg(F.max("count").alias("most"))
    enough = [r["level"] for r in sizes.collect() if r["most"] <= LEAF]  # a row for each level
    levels = min(enough, default=CUTS)

    def squared(near: bool) -> Column:
        """To the nearest or to the farthest point of a cell's bounds."""
        part = lambda p, lo, hi: F.greatest(F.lit(0.0), F.col(lo) - F.col(p), F.col(p) - F.col(hi)) if near else F.greatest(F.abs(F.col(lo) - F.col(p)), F.abs(F.col(hi) - F.col(p)))
        return F.pow(part("_x", "_x0", "_x1"), 2) + F.pow(part("_y", "_y0", "_y1"), 2)

    left = found.where(F.col("_x").isNotNull() & F.col("_y").isNotNull()).select("_x", "_y").distinct().withColumns({"_i": F.lit(0).cast("long"), "_j": F.lit(0).cast("long")})
    best = Window.partitionBy("_x", "_y")
    for n in range(1, levels + 1):
        cells = ref.groupBy(*at(n)).agg(F.min("_rx").alias("_x0"), F.max("_rx").alias("_x1"), F.min("_ry").alias("_y0"), F.max("_ry").alias("_y1"))
        below = left.select("_x", "_y", "_i", "_j", F.explode(F.sequence(F.lit(0), F.lit(15))).alias("_c"))
        below = below.select("_x", "_y", (F.col("_i") * 4 + F.col("_c") % 4).alias("_i"), (F.col("_j") * 4 + F.floor(F.col("_c") / 4)).alias("_j")).join(cells, ["_i", "_j"])
        left = below.withColumns({"_lo": squared(True), "_hi": squared(False)}).withColumn("_sure", F.min("_hi").over(best)).where("_lo <= _sure").select("_x", "_y", "_i", "_j")
    apart = F.sqrt(F.pow(F.col("_x") - F.col("_rx"), 2) + F.pow(F.col("_y") - F.col("_ry"), 2))
    near = left.join(ref.select("ref_key", "_rx", "_ry", *at(levels)), ["_i", "_j"]).groupBy("_x", "_y").agg(F.min(F.struct(apart.alias("distance"), "ref_key")).alias("m"))
    return found.join(near, ["_x", "_y"], "left").groupBy(key).agg(F.min("m").alias("m")).select(key, F.coalesce(F.col("m.ref_key").cast("string"), F.lit("missing")).alias("nearest"), F.col("m.distance").alias("distance"))


def outer_merge(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Full outer join of all frames on their keys."""
    return reduce(lambda a, b: a.join(b, list(keys), "full_outer"), frames)


def assemble_features(base: DataFrame, frames: Sequence[DataFrame], key: str) -> DataFrame:
    """Left-join frames to a base; fails at run time where a frame repeats a key."""
    out = base
    for i, f in enumerate(frames):
        n = F.count(F.lit(1)).over(Window.partitionBy(key))
        checked = f.withColumn("_n", n).withColumn(f"_ok{i}", F.when(F.col("_n") > 1, F.raise_error(F.lit(f"frame {i} repeats a key"))).otherwise(F.lit(1))).drop("_n")
        out = out.join(checked.where(F.col(f"_ok{i}") == 1).drop(f"_ok{i}"), key, "left")
    return out


def expand_concepts(ancestors: DataFrame, closure: DataFrame, excluded: DataFrame | None = None) -> DataFrame:
    """Variables of all descendants of rules' ancestors, one row a concept: that of the first rule by priority.

    ancestors: (variable, ancestor_id, priority); closure: (ancestor_id, descendant_id); excluded: (ancestor_id).
    """
    found = closure.join(ancestors, "ancestor_id").select(F.col("descendant_id").alias("concept_id"), "variable", "priority")
    if excluded is not None:
        out = closure.join(excluded.distinct(), "ancestor_id", "left_semi").select(F.col("descendant_id").alias("concept_id"))
        found = found.join(out.distinct(), "concept_id", "left_anti")
    return found.groupBy("concept_id").agg(F.min(F.struct("priority", "variable")).alias("m")).select("concept_id", F.col("m.variable").alias("variable"))


def concept_hops(seeds: DataFrame, relations: DataFrame, concepts: DataFrame, *, most_hops: int | None = None, kinds: Sequence[str] | None = None, like: Sequence[str] = (), not_like: Sequence[str] = (), excluded: DataFrame | None = None) -> DataFrame:
    """Rows (variable, concept_id, hops): what each variable's seeds (variable, concept_id) reach over relations (from_id, to_id, kind), by the least number of hops.

    One join a hop, of the concepts found last with the relations, until a hop finds nothing new, so cycles end; each hop is written once. Names of the concepts
    (concept_id, name) must match one of ``like`` and none of ``not_like`` to be in the result, with case; what does not match is still gone through. Concepts of ``excluded`` (variable, concept_id) and what is
    reached only through them are not.
    """
    edges = relations if kinds is None else relations.where(F.col("kind").isin(*kinds))
    edges = edges.where("from_id is not null and to_id is not null").select(F.col("from_id").alias("concept_id"), "to_id").distinct()
    key = ["variable", "concept_id"]
    allowed = lambda d: d if excluded is None else d.join(excluded.select(*key).distinct(), key, "left_anti")
    last = saved(allowed(seeds.where("concept_id is not null").select(*key).distinct()).withColumn("hops", F.lit(0)))
    levels, hops = [last], 0
    while (most_hops is None or hops < most_hops) and not last.isEmpty():
        hops += 1
        found = reduce(lambda a, b: a.union(b), levels)
        new = last.join(edges, "concept_id").select("variable", F.col("to_id").alias("concept_id")).distinct()
        last = saved(allowed(new).join(found.select(*key), key, "left_anti").withColumn("hops", F.lit(hops)))
        levels.append(last)
    out = reduce(lambda a, b: a.union(b), levels)
    if like or not_like:
        name, yes = F.col("name"), F.lit(not like)
        for p in like:
            yes = yes | name.like(p)
        for p in not_like:
            yes = yes & ~name.like(p)
        out = out.join(concepts.where(yes).select("concept_id").distinct(), "concept_id", "left_semi")
    return out.select("variable", "concept_id", "hops")


def within_any(branches: Sequence[Column]) -> Column:
    """One predicate out of several windows or filters."""
    return reduce(lambda a, b: a | b, branches)
