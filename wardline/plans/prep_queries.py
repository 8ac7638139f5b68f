"""Queries of feature preparation, evaluation, comparison, quality, sources and sinks."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.functions import hooks
from wardline.operators import forest, prep, quality, stats, typing_ops
from wardline.plans.cdm import Tables
from wardline.plans.registry import query
from wardline.sources import io

c = F.col


def _scratch(t: Tables) -> str:
    """A new folder for tables written by a query, shared by all executors where the session names one."""
    root = t.spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not t.spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="wardline-")
    return f"{root.rstrip('/')}/wardline-{uuid.uuid4().hex}"


# --- preparation ------------------------------------------------------------------------------------------------

_TRAIN = "c_custkey % 5 <> 0"


def _fit(t: Tables) -> prep.Standardizer:
    return prep.fit_standardizer(t.customer.where(_TRAIN), numeric=["c_acctbal"], categorical=["c_mktsegment"])


query("e1_standardize", "", f"""f as (select quantile_cont(c_acctbal, 0.01) lo, quantile_cont(c_acctbal, 0.99) hi, avg(c_acctbal) m, stddev_pop(c_acctbal) s from customer where {_TRAIN})
SELECT c_custkey, (greatest(lo, least(hi, c_acctbal)) - m) / s c_acctbal, case when c_acctbal is null then 1 else 0 end c_acctbal_missing_ind, case when c_mktsegment = 'AUTOMOBILE' then 1 else 0 end as auto, case when c_mktsegment = 'BUILDING' then 1 else 0 end as building from customer, f""", "c_acctbal")(
    lambda t: prep.apply_standardizer(t.customer, _fit(t), key="c_custkey").select("c_custkey", "c_acctbal", "c_acctbal_missing_ind", c("c_mktsegment_automobile").alias("auto"), c("c_mktsegment_building").alias("building"))
)


def _series(t: Tables) -> DataFrame:
    fit = prep.fit_series(t.events.where("user_id % 5 <> 0"), variable="event_type", value="value")
    wide = prep.apply_series(t.events, fit, key="user_id", variable="event_type", at="ts", value="value", seconds=86400, carry=2)
    return wide.select("user_id", "ts", "click", "click_missing_ind", "purchase", "purchase_missing_ind")


query("e1_series", "", """f as (select event_type v, avg(value) m, stddev_pop(value) s, median(value) d, quantile_cont(value, 0.01) lo, quantile_cont(value, 0.99) hi from events where user_id % 5 <> 0 and event_type in ('click', 'purchase') group by 1),
d as (select user_id, date_trunc('day', ts) ts, event_type v, avg(greatest(lo, least(hi, value))) x from events join f on v = event_type group by all),
g as (select user_id, unnest(generate_series(a, b, interval 1 day)) ts from (select user_id, date_trunc('day', min(ts)) a, date_trunc('day', max(ts)) b from events group by 1)),
s as (select g.user_id, g.ts, f.v, x, (coalesce(x, lag(x) over w, lag(x, 2) over w, d) - m) / s z from g cross join f left join d on d.user_id = g.user_id and d.ts = g.ts and d.v = f.v window w as (partition by g.user_id, f.v order by g.ts))
SELECT user_id, ts, max(z) filter (v = 'click') click, cast(count(*) filter (v = 'click' and x is null) as int) click_missing_ind, max(z) filter (v = 'purchase') purchase, cast(count(*) filter (v = 'purchase' and x is null) as int) purchase_missing_ind from s group by 1, 2""", "click purchase")(_series)
query("e2_normalise_text", "", "SELECT c_custkey, case when c_custkey % 6 = 0 then null else lower(c_name) end name from customer")(lambda t: t.customer.select("c_custkey", prep.normalise_text(F.when(c("c_custkey") % 6 == 0, F.lit(" NA ")).otherwise(F.concat(F.lit("  "), c("c_name"), F.lit(" ")))).alias("name")))
query("e3_drop_rules", "", "SELECT 'constant' as \"column\", 1 dropped union all select 'empty', 1 union all select 'p_size', 0")(
    lambda t: (lambda f, s: s.createDataFrame([(k, int(v.drop)) for k, v in f.numeric.items()], "column string, dropped int"))(
        prep.fit_standardizer(t.part.select("p_size", F.lit(1.0).alias("constant"), F.lit(None).cast("double").alias("empty")), numeric=["p_size", "constant", "empty"]), t.spark)
)
query("e4_e5_rare_levels_index", "", """k as (select p_brand, count(*) n from part where p_partkey % 2 = 0 group by 1), l as (select lower(p_brand) level from k where n >= 3 union select 'other'), i as (select level, row_number() over (order by level) - 1 i from l)
SELECT p_partkey, cast(i as int) p_brand from part left join i on level = case when lower(p_brand) in (select level from l) then lower(p_brand) else 'other' end""")(
    lambda t: prep.apply_standardizer(t.part, prep.fit_standardizer(t.part.where("p_partkey % 2 = 0"), categorical=["p_brand"], least_count=3), key="p_partkey", one_hot=False).select("p_partkey", "p_brand")
)
query("e6_midpoint_quantiles", "", """r as (select event_type, value, row_number() over (partition by event_type order by value) r, count(*) over (partition by event_type) n from events)
SELECT event_type, avg(value) filter (r = floor((n - 1) * 0.01 + 1e-9) + 1 or r = ceil((n - 1) * 0.01 - 1e-9) + 1) q1, avg(value) filter (r = floor((n - 1) * 0.99 + 1e-9) + 1 or r = ceil((n - 1) * 0.99 - 1e-9) + 1) q99 from r group by 1""", "q1 q99")(lambda t: prep.midpoint_quantiles(t.events, ["event_type"], "value", [0.01, 0.99]))
query("e6_redraw_outliers")(lambda t: (lambda f: t.customer.select("c_custkey", prep.clip_or_redraw(c("c_acctbal"), f.numeric["c_acctbal"], c("c_custkey"), redraw=True).alias("x")))(_fit(t)))
query("e7_impute", "", f"""f as (select avg(c_acctbal) m, median(c_acctbal) d from customer where {_TRAIN} and c_custkey % 7 <> 0)
SELECT c_custkey, case when c_custkey % 7 = 0 then m else c_acctbal end by_mean, case when c_custkey % 7 = 0 then d else c_acctbal end by_median, case when c_custkey % 7 = 0 then -1 else c_acctbal end by_constant from customer, f""", "by_mean by_median by_constant")(
    lambda t: (lambda df: (lambda f: df.select("c_custkey", *(prep.impute(c("x"), f, how, c("c_custkey"), constant=-1.0).alias(f"by_{how}") for how in ("mean", "median", "constant"))))(prep.fit_standardizer(df.where(_TRAIN), numeric=["x"]).numeric["x"]))(
        t.customer.select("c_custkey", F.when(c("c_custkey") % 7 != 0, c("c_acctbal")).alias("x")))
)
query("e7_impute_draws")(lambda t: (lambda f: t.customer.select("c_custkey", *(prep.impute(F.lit(None).cast("double"), f.numeric["c_acctbal"], how, c("c_custkey")).alias(how) for how in ("uniform", "normal", "normal_mad"))))(_fit(t)))
query("e7_impute_levels", "", f"""m as (select lower(c_mktsegment) v from customer where {_TRAIN} and c_custkey % 7 <> 0 group by 1 order by count(*) desc, 1 limit 1)
SELECT c_custkey, case when c_custkey % 7 = 0 then v else lower(c_mktsegment) end by_mode, case when c_custkey % 7 = 0 then 'missing' else lower(c_mktsegment) end by_constant from customer, m""")(
    lambda t: (lambda df: (lambda f: df.select("c_custkey", *(prep.impute_level(c("x"), f, how, c("c_custkey")).alias(f"by_{how}") for how in ("mode", "constant"))))(prep.fit_standardizer(df.where(_TRAIN), categorical=["x"]).levels["x"]))(
        t.customer.select("c_custkey", F.when(c("c_custkey") % 7 != 0, F.lower("c_mktsegment")).alias("x")))
)
query("e8_zscore", "", "f as (select avg(value) m, stddev_pop(value) s from events where event_id % 2 = 0) SELECT event_id, (value - m) / s z from events, f", "z")(
    lambda t: t.events.crossJoin(F.broadcast(t.events.where("event_id % 2 = 0").agg(F.avg("value").alias("m"), F.stddev_pop("value").alias("s")))).select("event_id", ((c("value") - c("m")) / c("s")).alias("z"))
)
query("e11_robust_outliers", "", """m as (select event_type, median(value) m, mad(value) d from events group by 1)
SELECT event_id, 0.6745 * (value - m) / d modified_z, case when abs(0.6745 * (value - m) / d) > 3.5 then 1 else 0 end outlier from events join m using (event_type)""", "modified_z")(lambda t: prep.robust_outliers(t.events, ["event_type"], "value").select("event_id", "modified_z", "outlier"))
query("e12_target_encode", "", "m as (select p_brand, avg(p_retailprice) e from part where p_partkey % 10 = 0 group by 1), a as (select avg(p_retailprice) e from part where p_partkey % 10 = 0) SELECT p_partkey, coalesce(m.e, a.e) encoded from part left join m using (p_brand), a", "encoded")(
    lambda t: prep.target_encode(t.part, t.part.where("p_partkey % 10 = 0"), "p_brand", "p_retailprice").select("p_partkey", "encoded")
)
query("e13_hierarchical_encode", "", """k as (select * from part where p_partkey % 50 = 0), a as (select p_type, avg(p_retailprice) e from k group by 1), b as (select p_brand, avg(p_retailprice) e from k group by 1), o as (select avg(p_retailprice) e from k)
SELECT p_partkey, coalesce(a.e, b.e, o.e) encoded from part left join a using (p_type) left join b using (p_brand), o""", "encoded")(lambda t: prep.hierarchical_encode(t.part, t.part.where("p_partkey % 50 = 0"), ["p_type", "p_brand"], "p_retailprice").select("p_partkey", "encoded"))
query("e14_min_max", "", "SELECT p_partkey, (p_retailprice - min(p_retailprice) over ()) / (max(p_retailprice) over () - min(p_retailprice) over ()) p_retailprice from part", "p_retailprice")(lambda t: prep.min_max(t.part, ["p_retailprice"]).select("p_partkey", "p_retailprice"))

# --- evaluation and comparison -----------------------------------------------------------------------------------

_SCORED = "x as (select doc_id, quality y, least(1.0, n_chars / 5000.0) score from labels join documents using (doc_id))"
_scored = lambda t: t.labels.join(t.documents, "doc_id").select("doc_id", c("quality").alias("y"), F.least(F.lit(1.0), c("n_chars") / 5000.0).alias("score"))
query("k1_binary_metrics", "", _SCORED + """, tot as (select sum(y) p, sum(1 - y) n from x), g as (select score, sum(y) p, sum(1 - y) n from x group by 1),
r as (select score, sum(p) over w tp, sum(n) over w fp, p dp, n dn from g window w as (order by score desc)),
q as (select *, tp / (tp + fp) as prec, coalesce(lag(tp / (tp + fp)) over (order by score desc), 1) prec0 from r),
m as (select sum(dn * (tp + tp - dp) / 2.0) / (any_value(tot.p) * any_value(tot.n)) auroc, sum(dp / tot.p * (prec + prec0) / 2.0) auprc, max((tp / tot.p - fp / tot.n, score))[2] threshold from q, tot),
k as (select count(*) filter (score >= threshold and y = 1) tp, count(*) filter (score >= threshold and y = 0) fp, count(*) filter (score < threshold and y = 1) fn, count(*) filter (score < threshold and y = 0) tn from x, m)
SELECT auroc, auprc, threshold, tp / (tp + fn) sensitivity, tn / (tn + fp) specificity, tp / (tp + fp) ppv, tn / (tn + fn) npv, (tp + tn) / (tp + tn + fp + fn) accuracy, 2 * tp / (2 * tp + fp + fn) f1 from m, k""", "auroc auprc threshold sensitivity specificity ppv npv accuracy f1")(
    lambda t: stats.binary_metrics(_scored(t), y="y", score="score")
)
query("k2_bootstrap_ci")(lambda t: stats.bootstrap_ci(_scored(t), y="y", score="score", replicates=30))
query("k3_calibration", "", _SCORED + " SELECT avg((score - y) * (score - y)) brier, count(*) n from x", "brier")(lambda t: _scored(t).agg(stats.brier(c("y"), c("score")).alias("brier"), F.count("*").alias("n")))
query("k4_chi_square", "", """o as (select o_orderstatus a, o_orderpriority b, count(*) k from orders group by all), r as (select a, sum(k) r from o group by 1), q as (select b, sum(k) c from o group by 1), t as (select sum(k) t from o)
SELECT sum((coalesce(k, 0) - r * c / t) ** 2 / (r * c / t)) statistic, (count(distinct r.a) - 1) * (count(distinct q.b) - 1) dof from r cross join q cross join t left join o on o.a = r.a and o.b = q.b""", "statistic")(lambda t: stats.chi_square(t.orders, "o_orderstatus", "o_orderpriority"))
query("k6_kruskal_wallis", "", """v as (select value, count(*) t from events group by 1), r as (select value, t, sum(t) over (order by value) - t + (t + 1) / 2.0 as rank from v), e as (select event_type, count(*) n, sum(rank) s from events join r using (value) group by 1),
z as (select sum(cast(t as double) ** 3 - t) ties from v), h as (select cast(sum(n) as double) nn, sum(s * s / n) q, count(*) k from e)
SELECT (12 / (nn * (nn + 1)) * q - 3 * (nn + 1)) / (1 - ties / (nn ** 3 - nn)) h, k - 1 dof from h, z""", "h")(lambda t: stats.kruskal_wallis(t.events, "value", "event_type"))
query("k7_anova", "", """g as (select event_type, count(*) n, avg(value) m, var_pop(value) v from events group by 1), s as (select sum(n) nn, count(*) k, sum(n * m) t, sum(n * m * m) q, sum(n * v) w from g)
SELECT ((q - t * t / nn) / (k - 1)) / (w / (nn - k)) f, cast(k - 1 as bigint) dof_between, cast(nn - k as bigint) dof_within from s""", "f")(lambda t: stats.anova_oneway(t.events, "value", "event_type"))
_RANKS = """v as (select value, count(*) t from events group by 1), r as (select value, t, sum(t) over (order by value) - t + (t + 1) / 2.0 as rank from v), e as (select event_type, count(*) n, sum(rank) s from events join r using (value) group by 1),
z as (select sum(cast(t as double) ** 3 - t) ties from v), h as (select cast(sum(n) as double) nn, sum(s * s / n) q, count(*) k from e),
kw as (select (12 / (nn * (nn + 1)) * q - 3 * (nn + 1)) / (1 - ties / (nn ** 3 - nn)) h, k - 1 dof from h, z)"""
# five kinds of events: the tails have a closed form at four degrees of freedom
query("k6_kruskal_p", "", _RANKS + " SELECT h, dof, case when dof = 4 then exp(-h / 2) * (1 + h / 2) end p from kw", "h p")(lambda t: stats.kruskal_wallis_p(t.events, "value", "event_type"))
query("k7_anova_p", "", """g as (select event_type, count(*) n, avg(value) m, var_pop(value) v from events group by 1), s as (select sum(n) nn, count(*) k, sum(n * m) t, sum(n * m * m) q, sum(n * v) w from g),
a as (select ((q - t * t / nn) / (k - 1)) / (w / (nn - k)) f, cast(k - 1 as bigint) dof_between, cast(nn - k as bigint) dof_within from s), y as (select *, dof_within / (dof_within + dof_between * f) y from a)
SELECT f, dof_between, dof_within, case when dof_between = 4 then exp(dof_within / 2.0 * ln(y)) * (1 + dof_within / 2.0 * (1 - y)) end p from y""", "f p")(lambda t: stats.anova_p(t.events, "value", "event_type"))
# at one degree of freedom the tail is the complementary error function; its series has positive terms only
query("k6_pairwise_ranks", "", """g as (select distinct event_type e from events), p as (select a.e a, b.e b from g a join g b on a.e < b.e), v as (select a, b, value, count(*) t from events join p on event_type in (a, b) group by all),
r as (select *, sum(t) over (partition by a, b order by value) - t + (t + 1) / 2.0 as rank from v), x as (select p.a, p.b, event_type, count(*) n, sum(rank) s from events join p on event_type in (p.a, p.b) join r on r.a = p.a and r.b = p.b and r.value = events.value group by all),
z as (select a, b, sum(cast(t as double) ** 3 - t) ties from v group by all), q as (select a, b, cast(sum(n) as double) nn, sum(s * s / n) q from x group by all), h as (select a, b, (12 / (nn * (nn + 1)) * q - 3 * (nn + 1)) / (1 - ties / (nn ** 3 - nn)) h from q join z using (a, b)),
e as (select a, b, h, sum(exp(-h / 2 + k * ln(2) + (2 * k + 1) * ln(sqrt(h / 2)) - (lgamma(2 * k + 2) - k * ln(2) - lgamma(k + 1)))) z from h, (select unnest(range(0, 200)) k) group by all),
m as (select event_type, count(value) n, median(value) m, quantile_cont(value, 0.25) lo, quantile_cont(value, 0.75) hi from events group by 1)
SELECT a, b, h, x.n n_a, x.m median_a, x.lo low_a, x.hi high_a, y.n n_b, y.m median_b, y.lo low_b, y.hi high_b, 1 - 2 / sqrt(pi()) * z p
from e join m x on x.event_type = a join m y on y.event_type = b""", "h median_a low_a high_a median_b low_b high_b p")(lambda t: stats.pairwise_ranks(t.events, "value", "event_type"))
query("k5_pairwise_fisher", "", """g as (select c_mktsegment s, count(*) filter (c_acctbal < 0) yes, count(*) filter (c_acctbal >= 0) n from customer group by 1), c as (select a.s a, b.s b, a.yes yes_a, a.n no_a, b.yes yes_b, b.n no_b from g a join g b on a.s < b.s),
l as (select *, unnest(range(greatest(0, yes_a + yes_b - yes_b - no_b), least(yes_a + no_a, yes_a + yes_b) + 1)) x from c),
w as (select *, lgamma(yes_a + no_a + 1) - lgamma(x + 1) - lgamma(yes_a + no_a - x + 1) + lgamma(yes_b + no_b + 1) - lgamma(yes_a + yes_b - x + 1) - lgamma(yes_b + no_b - (yes_a + yes_b - x) + 1) - lgamma(yes_a + no_a + yes_b + no_b + 1) + lgamma(yes_a + yes_b + 1) + lgamma(no_a + no_b + 1) lp from l),
o as (select a, b, lp here from w where x = yes_a)
SELECT a, b, yes_a, no_a, yes_b, no_b, least(1.0, sum(exp(lp)) filter (lp <= here + 1e-7)) p from w join o using (a, b) group by all""", "p")(
    lambda t: stats.pairwise_fisher(t.customer.withColumn("debt", (c("c_acctbal") < 0).cast("int")), "debt", "c_mktsegment")
)
query("k8_comparison_table", "", """o as (select o_orderstatus g, o_custkey v, o_orderpriority l, o_orderkey % 97 w from orders), s as (select g, count(*) n, sum(count(*)) over () t from o group by 1)
SELECT 'size' as variable, '' as level, g as "group", n, printf('%.1f%%', 100.0 * n / t) display from s
union all select 'o_custkey', '', g, count(v), printf('%.2f [%.2f-%.2f]', median(v), quantile_cont(v, 0.25), quantile_cont(v, 0.75)) from o group by g
union all select 'work', '', g, count(w), printf('%.2f (%.2f)', avg(w), stddev_samp(w)) from o group by g
union all select 'o_orderpriority', l, g, count(*), printf('%d (%.1f%%)', count(*), 100.0 * count(*) / any_value(n)) from (select case when l in (select l from o group by l order by count(*) desc, l limit 3) then l else 'other' end l, o.g, s.n from o join s using (g)) group by l, g""")(
    lambda t: stats.comparison_table(t.orders.withColumn("work", c("o_orderkey") % 97), "o_orderstatus", ranked=["o_custkey"], normal=["work"], levels=["o_orderpriority"], top=3).drop("p", "test")
)
query("k8_summarize_groups", "", """s as (select o_orderstatus, count(*) z from orders group by 1)
SELECT 'o_totalprice' as variable, '' as level, o_orderstatus, count(o_totalprice) n, cast(null as double) as share, median(o_totalprice) median, quantile_cont(o_totalprice, 0.25) q1, quantile_cont(o_totalprice, 0.75) q3 from orders group by o_orderstatus
union all select 'o_orderpriority', o_orderpriority, o_orderstatus, count(*), count(*) / any_value(z), null, null, null from orders join s using (o_orderstatus) group by o_orderpriority, o_orderstatus""", "share median q1 q3")(
    lambda t: stats.summarize_groups(t.orders, "o_orderstatus", ["o_totalprice"], ["o_orderpriority"])
)
query("k9_class_weights", "", "SELECT toxic, (select count(*) from labels) / (2.0 * count(*)) weight from labels group by 1", "weight")(lambda t: stats.class_weights(t.labels, "toxic"))
query("k9_oversample", "", "SELECT toxic, count(*) * case when toxic = 1 then 3 else 1 end n from labels group by 1")(lambda t: stats.oversample(t.labels, "toxic", 3).groupBy("toxic").agg(F.count("*").alias("n")))
query("k9_k_fold")(lambda t: stats.k_fold(t.labels, "doc_id", 5).groupBy("fold").agg(F.count("*").alias("n")))


def _forest(t: Tables) -> DataFrame:
    rows = t.orders.join(t.customer, c("o_custkey") == c("c_custkey")).select("o_orderkey", c("o_totalprice").cast("double").alias("price"), c("c_acctbal").cast("double").alias("balance"), F.dayofyear("o_orderdate").cast("double").alias("day"), (c("o_orderstatus") == "F").cast("double").alias("y"))
    return forest.out_of_fold_scores(rows, key="o_orderkey", y="y", features=["price", "balance", "day"], select=2, folds=2, depths=[3, 5], trees=[10]).select("o_orderkey", "fold", "score")


query("k10_random_forest")(_forest)

# --- quality -----------------------------------------------------------------------------------------------------

query("d1_audit_variables", "measurements", "SELECT variable, count(distinct person_id) persons, count(distinct measurement_id) visits, count(*) observations, count(value) with_value, quantile_cont(value, 0.15) p15, quantile_cont(value, 0.85) p85, avg(value) mean from measurements group by 1", "p15 p85 mean")(
    lambda t: quality.audit(t.measurements, variable="variable", person="person_id", visit="measurement_id", value="value")
)
query("d2_completeness_check", "", "SELECT c_custkey, y from customer, (select unnest([1995, 1996, 1997]) y) where (c_custkey, y) not in (select o_custkey, year(o_orderdate) from orders)")(
    lambda t: quality.completeness(t.customer.select("c_custkey", F.explode(F.array(*(F.lit(y) for y in (1995, 1996, 1997)))).alias("y")), t.orders.select(c("o_custkey").alias("c_custkey"), F.year("o_orderdate").alias("y")), ["c_custkey", "y"])
)
query("d4_lookup_mapping_audit", "", "SELECT l_partkey, count(*) n from lineitem where l_partkey not in (select p_partkey from part where p_partkey % 3 <> 0) group by 1")(lambda t: quality.unmapped(t.lineitem, t.part.where("p_partkey % 3 <> 0").select(c("p_partkey").alias("l_partkey")), "l_partkey"))
query("d4_multiply_mapped", "", "SELECT l_partkey, count(distinct l_returnflag) n_variables, string_agg(distinct l_returnflag, ',' order by l_returnflag) variables from lineitem group by 1 having count(distinct l_returnflag) > 1")(lambda t: quality.multiply_mapped(t.lineitem, "l_partkey", "l_returnflag"))
query("d5_range_assertions", "", "SELECT 'positive' as rule, count(*) filter (not value > 0) broken from events union all select 'small', count(*) filter (not value <= 100) from events")(lambda t: quality.violations(t.events, {"positive": c("value") > 0, "small": c("value") <= 100}))
query("d6_load_log", "", """x as (select 'orders' as source, o_orderkey id from orders union all select 'events', event_id from events)
SELECT source as "table", batch, count(*) n, min(id) first_id, max(id) last_id, sum(count(*)) over (partition by source order by batch) so_far from (select source, id, id % 3 batch from x) group by 1, 2""")(lambda t: _load_log(t))


def _load_log(t: Tables) -> DataFrame:
    """Batches of two tables appended to a log, which is then read with the rows loaded so far."""
    path = _scratch(t)
    for k in range(3):
        for name, df, key in (("orders", t.orders, "o_orderkey"), ("events", t.events, "event_id")):
            quality.append_log(df.where(c(key) % 3 == k), path, table=name, batch=k, key=key)
    return quality.read_log(t.spark, path)


# --- sources and sinks ---------------------------------------------------------------------------------------------


def _csv_round_trip(t: Tables) -> DataFrame:
    path = _scratch(t)
    io.write_table(t.customer.select("c_custkey", F.when(c("c_custkey") % 4 == 0, "NULL").otherwise(c("c_name")).alias("note")), path, fmt="csv")
    return io.read_delimited(t.spark, path, columns=["c_custkey", "note", "absent"]).select(c("c_custkey").cast("long").alias("c_custkey"), "note")


query("s1_read_delimited", "", "SELECT c_custkey, case when c_custkey % 4 <> 0 then c_name end note from customer")(_csv_round_trip)
query("s2_read_parquet", "", "SELECT o_orderkey, o_totalprice from orders")(lambda t: io.read_parquet(t.spark, f"{t.dir}/orders.parquet", ["o_orderkey", "o_totalprice", "absent"], intersect=True))


def _many(t: Tables) -> DataFrame:
    path = _scratch(t)
    for name, part in (("a", t.customer.where("c_acctbal < 0")), ("b", t.customer.where("c_acctbal >= 0"))):
        io.write_table(part, f"{path}/{name}")
    return io.read_many(t.spark, path, tag="source_file").select("c_custkey", "c_name", c("source_file").endswith(".parquet").alias("tagged"))


query("s3_read_many", "", "SELECT c_custkey, c_name, true tagged from customer")(_many)
query("s5_sql_template", "", "SELECT o_custkey, count(*) n from orders where o_totalprice > 100000 group by 1")(
    lambda t: (t.orders.createOrReplaceTempView("wardline_orders"), io.run_template(t.spark, "select o_custkey, count(*) n from identifier(:orders) where o_totalprice > :least group by 1", {"orders": "wardline_orders"}, least=100000))[1]
)
query("s6_query_folder", "", "SELECT c_mktsegment, count(*) n from orders join customer on o_custkey = c_custkey group by 1")(
    lambda t: io.query_folder(t.spark, "select c_mktsegment, count(*) n from orders join customer on o_custkey = c_custkey group by 1", t.dir, ["orders", "customer"])
)


def _written(t: Tables) -> DataFrame:
    path = _scratch(t)
    io.write_table(t.orders.select("o_custkey", "o_orderstatus"), path, rows_per_file=5000, unique=True, partition_by=["o_orderstatus"])
    return t.spark.read.parquet(path).groupBy("o_orderstatus").agg(F.count("*").alias("n"))


query("s7_write_table", "", "SELECT o_orderstatus, count(distinct o_custkey) n from orders group by 1")(_written)
_TARGET = {"id": ("int", None, False), "name": ("string", 6, True), "size": ("int", None, True)}
_raw = lambda t: t.part.select(F.when(c("p_partkey") % 9 != 0, c("p_partkey").cast("string")).alias("id"), c("p_brand").alias("name"), F.when(c("p_partkey") % 7 == 0, "many").otherwise(c("p_size").cast("string")).alias("size"))
query("s8_conform", "", "SELECT case when p_partkey % 9 = 0 or p_partkey % 7 = 0 then 'rejected' else 'kept' end side, count(*) n from part group by 1")(
    lambda t: (lambda kept, bad: kept.agg(F.lit("kept").alias("side"), F.count("*").alias("n")).union(bad.agg(F.lit("rejected"), F.count("*"))).where("n > 0"))(*io.conform(_raw(t), _TARGET, truncate=True))
)


def _by_size(t: Tables) -> DataFrame:
    path = _scratch(t)
    io.write_table(t.orders.select("o_orderkey", "o_orderpriority"), path, fmt="csv", bytes_per_file=20_000)
    return t.spark.read.option("header", True).csv(path).select(c("o_orderkey").cast("long").alias("o_orderkey"), "o_orderpriority", (c("_metadata.file_size") <= 20_000).alias("fits"))


query("s7_write_by_size", "", "SELECT o_orderkey, o_orderpriority, true fits from orders")(_by_size)


def _appended(t: Tables) -> DataFrame:
    """Two loads appended to one table; batches of ten parts, some held back by a size that is no number."""
    path = _scratch(t)
    raw = t.part.select(c("p_partkey").cast("string").alias("id"), c("p_name").alias("name"), F.when(c("p_partkey") % 97 == 0, "many").otherwise(c("p_size").cast("string")).alias("size"))
    for k in range(2):
        io.append_table(raw.where(c("id").cast("long") % 20 >= 10 if k else c("id").cast("long") % 20 < 10), {**_TARGET, "id": ("long", None, False)}, write=io.to_folder(f"{path}/kept"), review=io.to_folder(f"{path}/review"), batch=F.floor(c("id").cast("long") / 10), truncate=True)
    kept, review = t.spark.read.parquet(f"{path}/kept"), t.spark.read.parquet(f"{path}/review")
    return kept.select("id", "name", "size", F.lit(None).cast("string").alias("unfit")).union(review.select(c("id").cast("long"), "name", F.lit(None).cast("int"), F.array_join("unfit", ",")))


query("s8_append_table", "", """b as (select distinct p_partkey // 10 b from part where p_partkey % 97 = 0)
SELECT p_partkey id, case when b is null then p_name[1:6] else p_name end as name, case when b is null then p_size end size, case when p_partkey % 97 = 0 then 'size' when b is not null then '' end unfit from part left join b on b = p_partkey // 10""")(_appended)
query("s9_bucket_by_id", "", "k as (select c_custkey, c_custkey % 16 batch from customer where c_custkey % 2 = 0) SELECT o_orderkey, o_custkey, cast(batch as int) known_batch, true one_batch, true in_range from orders left join k on c_custkey = o_custkey")(
    lambda t: (lambda known: io.bucket_by_id(t.orders, "o_custkey", 16, known).join(io.bucket_by_id(t.orders, "o_custkey", 16, known).groupBy("o_custkey").agg(F.count_distinct("batch").alias("n_batches")), "o_custkey").select("o_orderkey", "o_custkey", F.when(c("o_custkey") % 2 == 0, c("batch")).alias("known_batch"), (c("n_batches") == 1).alias("one_batch"), c("batch").between(0, 15).alias("in_range")))(t.customer.where("c_custkey % 2 = 0").select(c("c_custkey").alias("o_custkey"), (c("c_custkey") % 16).cast("int").alias("batch")))
)
query("s11_effective_dated_reference", "", "SELECT p_partkey, 1997 as release, p_size concept from part where p_partkey % 4 <> 0")(
    lambda t: io.load_effective_dated(t.spark.createDataFrame([(1996,)], "release int"), t.part.select("p_partkey", F.explode(F.array(F.lit(1996), F.lit(1997))).alias("release"), F.when(c("p_partkey") % 4 == 0, "TC").alias("modifier")), t.part.select("p_partkey", c("p_size").alias("concept")), code="p_partkey", release="release", modifier="modifier").select("p_partkey", "release", "concept")
)
query("s12_zip_rank_reference", "", "SELECT lpad(cast(s_suppkey as varchar), 9, '0') zip, s_acctbal as rank from supplier union all select lpad(cast(900000000 + c_custkey as varchar), 9, '0'), c_acctbal from customer")(
    lambda t: io.zip_ranks([t.supplier.select(F.concat(F.lit("G"), F.lpad(c("s_suppkey").cast("string"), 9, "0")).alias("ZIPID"), c("s_acctbal").alias("RANK_A")), t.customer.select((c("c_custkey") + 900000000).cast("string").alias("zip_4"), c("c_acctbal").alias("rank_b"))], key="zip", columns={"ZIPID": "zip", "zip_4": "zip", "RANK_A": "rank", "rank_b": "rank"})
)


def _packaged(t: Tables) -> DataFrame:
    split = t.customer.select(c("c_custkey").alias("id"), F.when(c("c_custkey") % 5 == 0, "Test").otherwise("Development").alias("split"))
    frames = {"static": t.customer.select(c("c_custkey").alias("id"), "c_acctbal"), "series": t.events.groupBy(c("user_id").alias("id")).agg(F.array_sort(F.collect_list(F.struct("ts", "value"))).alias("xs"))}
    y = t.orders.groupBy(c("o_custkey").alias("id")).agg(F.max(F.when(c("o_orderstatus") == "P", 1).otherwise(0)).alias("y"))
    out = io.package_dataset(frames, split, y, key="id")
    return out["series"].groupBy("split").agg(F.count("*").alias("n"), F.sum(F.size("xs")).alias("steps"))


query("s13_package_dataset", "", "SELECT case when user_id % 5 = 0 then 'Test' else 'Development' end split, count(distinct user_id) n, count(*) steps from events where user_id in (select o_custkey from orders) and user_id in (select c_custkey from customer) group by 1")(_packaged)


def _written_package(t: Tables) -> DataFrame:
    """Offsets of a packaged series read back, with the sum of the values that they point at first and last."""
    split = t.customer.select(c("c_custkey").alias("id"), F.when(c("c_custkey") % 5 == 0, "Test").otherwise("Development").alias("split"))
    frames = {"series": t.events.select(c("user_id").alias("id"), "ts", "event_id", "value", c("value").isNull().cast("int").alias("value_missing_ind"))}
    y = t.orders.groupBy(c("o_custkey").alias("id")).agg(F.count("*").alias("y"))
    path = _scratch(t)
    io.write_package(frames, split, y, key="id", path=path, sequences={"series": "ts"})
    offsets, values = (io.read_package(t.spark, path, "series", kind, ["Development", "Test"]) for kind in ("offsets", "numeric"))
    at = lambda place, name: values.select(c("split"), c("position").alias(place), c("event_id").alias(name))
    ends = offsets.withColumn("end", c("start") + c("length") - 1)
    return ends.join(at("start", "first_event"), ["split", "start"]).join(at("end", "last_event"), ["split", "end"]).select("split", "id", "start", "length", "first_event", "last_event")


query("s13_write_package", "", """e as (select case when user_id % 5 = 0 then 'Test' else 'Development' end split, user_id id, event_id, ts from events where user_id in (select o_custkey from orders) and user_id in (select c_custkey from customer)),
p as (select *, row_number() over (partition by split order by id, ts, event_id) - 1 p from e)
SELECT split, id, min(p) as start, count(*) length, arg_min(event_id, p) first_event, arg_max(event_id, p) last_event from p group by 1, 2""")(_written_package)
query("s14_populate_cohort", "visits", "SELECT 8 cohort_definition_id, person_id subject_id, start_at cohort_start_date, end_at cohort_end_date from visits where status = 'P'")(
    lambda t: io.populate_cohort(t.visits.where("status = 'P'"), t.spark.createDataFrame([(7,)], "cohort_definition_id int"), definition_name="pending", subject="person_id", start="start_at", end="end_at")[0]
)
query("p3_sanitize_columns", "", "SELECT c_custkey cust_key, c_name cust_name from customer")(lambda t: typing_ops.sanitize_columns(t.customer.select(c("c_custkey").alias("CustKey"), c("c_name").alias("cust Name%"))))


# --- user functions -------------------------------------------------------------------------------------------------


def _gap_rule(g):
    """Islands by a pause of over two hours since the latest end."""
    latest = g["loc_end"].cummax().shift()
    return ((g["loc_start"] - latest).dt.total_seconds() > 7200).cumsum()


query("xu1_aggregate_by_name", "", "SELECT user_id, max(value) - min(value) as value, count(distinct event_type) event_type from events group by 1", "value")(lambda t: hooks.aggregate_by(t.events, ["user_id"], {"value": "range", "event_type": F.count_distinct}))
_OVERLAP = """a as (select *, case when loc_start > max(loc_end + interval 2 hour) over (partition by person_id order by loc_start, loc_end rows between unbounded preceding and 1 preceding) then 1 else 0 end n from locations),
b as (select *, sum(n) over (partition by person_id order by loc_start, loc_end rows unbounded preceding) island from a)
SELECT person_id, min(loc_start) loc_start, max(loc_end) loc_end, count(*) n_merged from b group by person_id, island"""
query("xu2_custom_overlap", "locations", _OVERLAP)(lambda t: hooks.condense_custom(t.locations, by=["person_id"], start="loc_start", end="loc_end", islands=_gap_rule))
query("xu2_running_overlap", "locations", _OVERLAP)(lambda t: hooks.condense_running(t.locations, by=["person_id"], start="loc_start", end="loc_end", joins=lambda _, latest, start, __: start - latest <= 7200 * 1_000_000))
query("xu3_interval_preparation", "locations", "SELECT person_id, count(*) n from locations where label <> 'view' group by 1")(lambda t: hooks.steps(t.locations, lambda d: d.where("label <> 'view'"), lambda d: d.groupBy("person_id").agg(F.count("*").alias("n"))))
query("k5_fisher_exact", "", """t as (select count(*) filter (quality = 1 and toxic = 1) a, count(*) filter (quality = 1 and toxic = 0) b, count(*) filter (quality = 0 and toxic = 1) c, count(*) filter (quality = 0 and toxic = 0) d from labels),
m as (select *, a + b r, a + c k, a + b + c + d n from t), x as (select m.*, unnest(range(greatest(0, k - (n - r)), least(r, k) + 1)) i from m),
l as (select *, lgamma(r + 1) - lgamma(i + 1) - lgamma(r - i + 1) + lgamma(n - r + 1) - lgamma(k - i + 1) - lgamma(n - r - k + i + 1) - (lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1)) lp from x)
SELECT any_value(a) a, any_value(b) b, any_value(c) c, any_value(d) d, least(1.0, sum(exp(lp)) filter (lp <= (select lp from l where i = a) + 1e-7)) p from l""", "p")(lambda t: stats.fisher_test(t.labels, "quality", "toxic"))
# with an even number of degrees of freedom the tail is a finite sum
query("k4_compare_proportions", "", """o as (select o_orderstatus as "group", o_orderpriority as level, count(*) n from orders group by all), r as (select level, sum(n) r from o group by 1), q as (select "group", sum(n) c from o group by 1), t as (select sum(n) t from o),
e as (select r.level, q."group", coalesce(n, 0) n, c, r * c / t e from r cross join q cross join t left join o on o.level = r.level and o."group" = q."group"), s as (select sum((n - e) ** 2 / e) / 2 h, (count(distinct level) - 1) * (count(distinct "group") - 1) // 2 m from e),
p as (select exp(-h) * list_sum(list_transform(range(m), lambda i: h ** i / gamma(i + 1))) p from s)
SELECT level, "group", cast(n as bigint) n, 100.0 * n / c percent, p, case when (select count(*) filter (e < 5) * 5 <= count(*) from e) then 'pearson' else 'pearson (unsure)' end test from e, p""", "percent p")(lambda t: stats.compare_proportions(t.orders, "o_orderpriority", "o_orderstatus"))
query("e10_split_by_dtype", "", "SELECT 'numeric' kind, 'value' as \"column\" union all select 'numeric', 'event_id' union all select 'numeric', 'user_id' union all select 'text', 'event_type' union all select 'text', 'props' union all select 'time', 'ts'")(
    lambda t: prep.columns_by_kind(t.events)
)
query("e15_lab_ratio_to_baseline", "measurements", "b as (select person_id, min(value) m from measurements where value > 0 group by 1) SELECT measurement_id, value / m ratio from measurements join b using (person_id)", "ratio")(
    lambda t: t.measurements.join(t.measurements.where("value > 0").groupBy("person_id").agg(F.min("value").alias("m")), "person_id").select("measurement_id", (c("value") / c("m")).alias("ratio"))
)


def _preflight(t: Tables) -> DataFrame:
    t.orders.createOrReplaceTempView("wardline_preflight")
    missing = quality.preflight(t.spark, {"wardline_preflight": ["o_orderkey", "o_absent"], "wardline_no_table": []})
    return t.orders.agg(F.count("*").alias("n")).withColumn("missing", F.lit(",".join(missing)))


query("d3_source_preflight", "", "SELECT count(*) n, 'wardline_preflight.o_absent,wardline_no_table' missing from orders")(_preflight)
