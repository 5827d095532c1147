"""Bindings that complete the survey: unit rules on mixed units, notes joined
to stays, the remaining cross-tabs, early look-back windows, clock hours,
train-only scaling, the transition model and per-fold evaluation."""

from __future__ import annotations

from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import functions as F

from stayline.functions.hashing import uniform, uniform_sql
from stayline.functions.timefns import absolute_hour
from stayline.functions.units import apply_unit_rules
from stayline.operators import models as MD
from stayline.operators import stats as S
from stayline.operators.notes import notes_in_stays
from stayline.operators.splits import kfold
from stayline.operators.windows import rolling_lookback
from stayline.plans import events_plans as EP
from stayline.plans import model_plans as MP
from stayline.plans import orders_plans as OP
from stayline.plans.registry import register, rounded
from stayline.sources.tables import table

# ------------------------------------------------------------- D05 units
# Names and units that the line items stand for, by line number.
UNIT_NAMES = ("Weight oz", "Admission Weight", "Fraction inspired oxygen", "Oxygen saturation", "Temperature", "Height")


def _names(sep: str) -> str:
    return sep.join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(UNIT_NAMES))


@register("standardised_units", f"""
WITH m AS (SELECT l_orderkey, l_linenumber, CASE l_linenumber % 6 {_names(' ')} END AS name,
                  CASE l_returnflag WHEN 'A' THEN 'Lbs' WHEN 'R' THEN 'inches or F' END AS unit,
                  CASE l_linenumber % 6 WHEN 3 THEN l_discount * 20 ELSE l_quantity * 2 END AS v FROM lineitem),
f AS (SELECT *, lower(name) AS n, coalesce(lower(unit), '') AS u FROM m),
s1 AS (SELECT * REPLACE (CASE WHEN contains(n, 'weight') AND (contains(n, 'oz') OR contains(u, 'oz')) THEN v / 16.0 * 0.45359237 ELSE v END AS v) FROM f),
s2 AS (SELECT * REPLACE (CASE WHEN contains(n, 'weight') AND (contains(n, 'lbs') OR contains(u, 'lbs')) THEN v * 0.45359237 ELSE v END AS v) FROM s1),
s3 AS (SELECT * REPLACE (CASE WHEN contains(n, 'fraction inspired oxygen') AND v > 1 THEN v / 100.0 ELSE v END AS v) FROM s2),
s4 AS (SELECT * REPLACE (CASE WHEN contains(n, 'oxygen saturation') AND v <= 1 THEN v * 100.0 ELSE v END AS v) FROM s3),
s5 AS (SELECT * REPLACE (CASE WHEN contains(n, 'temperature') AND (contains(n, 'f') OR contains(u, 'f') OR v > 79) THEN (v - 32) * 5.0 / 9 ELSE v END AS v) FROM s4),
s6 AS (SELECT * REPLACE (CASE WHEN contains(n, 'height') AND (contains(n, 'in') OR contains(u, 'in')) THEN v * 2.54 ELSE v END AS v) FROM s5)
SELECT name, unit, count(*) AS n, round(avg(v), 6) AS mean, round(min(v), 6) AS lo, round(max(v), 6) AS hi FROM s6 GROUP BY name, unit""")
def q_standardised_units(spark, sf):
    """D05 (F13, F18, X01): the unit cascade on measurements in mixed units."""
    names = F.array(*[F.lit(n) for n in UNIT_NAMES])
    k = F.col("l_linenumber") % 6
    m = table(spark, sf, "lineitem").select(
        F.get(names, k).alias("name"),
        F.when(F.col("l_returnflag") == "A", "Lbs").when(F.col("l_returnflag") == "R", "inches or F").alias("unit"),
        F.when(k == 3, F.col("l_discount") * 20).otherwise(F.col("l_quantity") * 2).alias("v"))
    d = apply_unit_rules(m, "v", "name", "unit")
    return rounded(d.groupBy("name", "unit").agg(F.count(F.lit(1)).alias("n"), F.avg("v").alias("mean"),
                                                 F.min("v").alias("lo"), F.max("v").alias("hi")))


# ------------------------------------------------------------- J23 notes in stays
@register("notes_in_stays", "WITH " + OP.SQL_STAYS + """
SELECT l.l_orderkey AS hadm_id, st.icustay_id, l.l_linenumber AS note_id, l.l_shipdate AS chartdate,
       CASE WHEN l.l_linestatus = 'F' THEN l.l_shipdate - INTERVAL 30 DAY END AS charttime,
       l.l_returnflag AS category, l.l_linestatus AS description
FROM lineitem l JOIN st ON st.hadm_id = l.l_orderkey
WHERE NOT l.l_tax > 0.06 AND (l.l_shipdate <= st.outtime
      OR (l.l_linestatus = 'F' AND l.l_shipdate - INTERVAL 30 DAY <= st.outtime))""")
def q_notes_in_stays(spark, sf):
    """J23 (P08, N10): notes of a stay's admission up to its end, errors left
    out, with their dates and kinds (a line item stands for a note)."""
    notes = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("hadm_id"), F.col("l_linenumber").alias("note_id"), F.col("l_shipdate").alias("chartdate"),
        F.when(F.col("l_linestatus") == "F", F.col("l_shipdate") - F.make_dt_interval(days=F.lit(30))).alias("charttime"),
        F.col("l_returnflag").alias("category"), F.col("l_linestatus").alias("description"),
        F.when(F.col("l_tax") > 0.06, 1).alias("iserror"))
    d = notes_in_stays(notes, OP.stays(spark, sf))
    return d.select("hadm_id", "icustay_id", "note_id", "chartdate", "charttime", "category", "description")


# ------------------------------------------------------------- D27 cross-tabs
CROSSTABS = (("ethnicity", "gender"), ("ethnicity", "first_careunit"), ("admission_type", "first_careunit"),
             ("gender", "first_careunit"))


@register("cohort_crosstabs", OP.SQL_STATICS + "\n" + "\nUNION ALL\n".join(f"""
SELECT '{a} by {b}' AS crosstab, coalesce({a}, 'All') AS row_value, coalesce({b}, 'All') AS col_value, count(*) AS n,
       round(avg(mort_icu), 6) AS mort_icu, round(avg(los_icu), 6) AS los_icu
FROM cohort GROUP BY CUBE ({a}, {b})""" for a, b in CROSSTABS))
def q_cohort_crosstabs(spark, sf):
    """D27 (A12): the other four demographic cross-tabs with "All" margins."""
    d = OP.statics(spark, sf)
    out = []
    for a, b in CROSSTABS:
        t = S.crosstab_margins(d, a, b, {"mort_icu": "mort_icu", "los_icu": "los_icu"})
        out.append(t.select(F.lit(f"{a} by {b}").alias("crosstab"), F.col(a).alias("row_value"), F.col(b).alias("col_value"),
                            "n", "mort_icu", "los_icu"))
    return rounded(reduce(lambda x, y: x.unionByName(y), out))


# ------------------------------------------------------------- D24 table one
# The categories compared between survivors and non-survivors.
TABLE_ONE = (("gender", "F"), ("gender", "O"), ("admission_type", "1-URGENT"), ("first_careunit", "BUILDING"),
             ("first_careunit", "MACHINERY"))
_T1 = [f"CAST(CASE WHEN {c} = '{v}' THEN 1 ELSE 0 END AS DOUBLE) AS \"{c}={v}\"" for c, v in TABLE_ONE]
_T1_NAMES = ["age", "los_icu", *[f"{c}={v}" for c, v in TABLE_ONE]]


@register("table_one", OP.SQL_STATICS + f""",
d AS (SELECT mort_hosp, age, los_icu, {', '.join(_T1)} FROM cohort),
l AS (SELECT mort_hosp, variable, v FROM d UNPIVOT (v FOR variable IN ({', '.join(f'"{n}"' for n in _T1_NAMES)}))),
m AS (SELECT variable, count(v) FILTER (WHERE mort_hosp = 1) AS n_a, avg(v) FILTER (WHERE mort_hosp = 1) AS mean_a,
             var_samp(v) FILTER (WHERE mort_hosp = 1) AS var_a, count(v) FILTER (WHERE mort_hosp = 0) AS n_b,
             avg(v) FILTER (WHERE mort_hosp = 0) AS mean_b, var_samp(v) FILTER (WHERE mort_hosp = 0) AS var_b FROM l GROUP BY variable)
SELECT variable, n_a, round(mean_a, 6) AS mean_a, round(var_a, 6) AS var_a, n_b, round(mean_b, 6) AS mean_b,
       round(var_b, 6) AS var_b,
       round((mean_a - mean_b) / nullif(sqrt(((n_a - 1) * var_a + (n_b - 1) * var_b) / (n_a + n_b - 2) * (1.0 / n_a + 1.0 / n_b)), 0), 6) AS t,
       CAST(n_a + n_b - 2 AS DOUBLE) AS dof
FROM m""")
def q_table_one(spark, sf):
    """D24 (A27): every measure and category indicator of the cohort compared between outcomes."""
    return rounded(_table_one(spark, sf))


def _table_one(spark, sf, with_p: bool = False):
    d = OP.statics(spark, sf).select(
        "mort_hosp", "age", "los_icu",
        *[F.when(F.col(c) == v, 1.0).otherwise(0.0).alias(f"{c}={v}") for c, v in TABLE_ONE])
    long = d.unpivot(["mort_hosp"], [F.col(f"`{n}`") for n in _T1_NAMES], "variable", "v")
    out = S.ttest_ind(long, "mort_hosp", "v", 1, 0, by=["variable"], with_p=with_p)
    return out.withColumn("t", F.when(F.col("t").isNotNull() & ~F.isnan("t"), F.col("t")))


@register("table_one_p")
def q_table_one_p(spark, sf):
    """The same comparisons with two-sided p-values (no t distribution in SQL)."""
    return rounded(_table_one(spark, sf, with_p=True).select("variable", "t", "dof", "p_value"))


# ------------------------------------------------------------- W11 early window
EARLY = 24


@register("early_lookback", EP.SQL_WIDE + f"""
SELECT user_id, hours_in,
  round(first_value(click_mean IGNORE NULLS) OVER r, 6) AS click_mean_first,
  round(last_value(click_mean IGNORE NULLS) OVER r, 6) AS click_mean_last,
  round(first_value(click_mean IGNORE NULLS) OVER e, 6) AS click_mean_first_early,
  round(last_value(click_mean IGNORE NULLS) OVER e, 6) AS click_mean_last_early
FROM w WINDOW r AS (PARTITION BY user_id ORDER BY hours_in RANGE BETWEEN 4 PRECEDING AND CURRENT ROW),
              e AS (PARTITION BY user_id ORDER BY hours_in RANGE BETWEEN {4 + EARLY} PRECEDING AND CURRENT ROW)""")
def q_early_lookback(spark, sf):
    """First and last values over the look-back window and over the longer early one."""
    w, _ = EP.wide_grid(spark, sf)
    d = w.select(EP.STAY, "hours_in", "click_mean")
    late = rolling_lookback(d, EP.STAY, ["click_mean"], 4, first=True, parted=True)
    both = rolling_lookback(late.withColumnsRenamed({"click_mean_first": "f", "click_mean_last": "l"}),
                            EP.STAY, ["click_mean"], 4 + EARLY, first=True, parted=True)
    return rounded(both.select(EP.STAY, "hours_in", F.col("f").alias("click_mean_first"), F.col("l").alias("click_mean_last"),
                               F.col("click_mean_first").alias("click_mean_first_early"),
                               F.col("click_mean_last").alias("click_mean_last_early")))


# ------------------------------------------------------------- F09 clock hours
@register("clock_hours", EP.SQL_WIDE + """
SELECT CAST((hour(s.intime) + w.hours_in) % 24 AS BIGINT) AS clock_hour, count(*) AS n_hours, round(avg(w.click_mean), 6) AS click_mean
FROM w JOIN s USING (user_id) GROUP BY 1""")
def q_clock_hours(spark, sf):
    """hourly values by hour of the day, (hour of entry + hours in) mod 24."""
    w, s = EP.wide_grid(spark, sf)
    d = w.join(s.select(EP.STAY, "intime"), EP.STAY)
    d = d.withColumn("clock_hour", absolute_hour("intime", "hours_in").cast("bigint"))
    return rounded(d.groupBy("clock_hour").agg(F.count(F.lit(1)).alias("n_hours"), F.avg("click_mean").alias("click_mean")))


# ------------------------------------------------------------- A21 population scaling
@register("population_scaled", """
WITH t AS (SELECT event_type, avg(value) AS mu, stddev_pop(value) AS sd FROM events GROUP BY event_type)
SELECT e.event_id, round((e.value - t.mu) / t.sd, 6) AS value_z FROM events e JOIN t USING (event_type)""")
def q_population_scaled(spark, sf):
    """Standardisation with the population standard deviation."""
    ev = EP.events(spark, sf).select("event_id", "event_type", "value")
    return rounded(S.standardize(ev, ["value"], by=["event_type"], suffix="_z", ddof=0).select("event_id", "value_z"))


# ------------------------------------------------------------- D29 task samples
TASK_SEED = 21


@register("task_samples", EP.SQL_WIDE + f""",
el AS (SELECT user_id, max_hours, {uniform_sql(TASK_SEED, 'user_id')} < 0.7 AS train FROM s WHERE max_hours > 30),
die AS (SELECT user_id, max(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS died FROM events GROUP BY user_id),
ft AS (SELECT w.user_id, avg(click_mean) AS m, CAST(sum(view_count) AS DOUBLE) AS n FROM w WHERE hours_in < 24 GROUP BY w.user_id),
tr AS (SELECT avg(m) AS mm, stddev_samp(m) AS sm, avg(n) AS mn, stddev_samp(n) AS sn FROM ft JOIN el USING (user_id) WHERE train)
SELECT el.user_id, CAST(died AS INTEGER) AS died, CASE WHEN train THEN 'train' ELSE 'test' END AS split,
       round((coalesce(m, mm) - mm) / sm, 6) AS click_z, round((n - mn) / sn, 6) AS views_z
FROM el JOIN ft USING (user_id) JOIN die USING (user_id), tr""")
def q_task_samples(spark, sf):
    """Mortality label, hashed split, missing values and scaling from the training stays only."""
    w, s = EP.wide_grid(spark, sf)
    el = s.filter(F.col("max_hours") > 30).select(
        EP.STAY, F.when(uniform(TASK_SEED, EP.STAY) < 0.7, "train").otherwise("test").alias("split"))
    die = EP.events(spark, sf).groupBy(EP.STAY).agg(
        F.max(F.when(F.col("event_type") == "error", 1).otherwise(0)).cast("int").alias("died"))
    ft = w.filter(F.col("hours_in") < 24).groupBy(EP.STAY).agg(
        F.avg("click_mean").alias("click"), F.sum("view_count").cast("double").alias("views"))
    d = el.join(ft, EP.STAY).join(die, EP.STAY)
    train = d.filter("split = 'train'")
    d = d.crossJoin(F.broadcast(train.agg(F.avg("click").alias("__fill")))).withColumn(  # one row
        "click", F.coalesce("click", "__fill"))
    d = S.standardize(d, ["click", "views"], train=train, suffix="_z")
    return rounded(d.select(EP.STAY, "died", "split", "click_z", "views_z"))


# ------------------------------------------------------------- D30, D33 models
#: Samples in one part of the transition model's table: the learner runs a task a part in each of its passes.
SAMPLES = 500_000


@register("transition_model")
def q_transition_model(spark, sf):
    """D30 (M10, M16, M20): the four-class transition model with balanced
    weights; per class precision, recall, F1 and one-against-rest AUROC on
    held-out stays, and their macro means."""
    from pyspark.ml.functions import array_to_vector
    d = MP.q_transition_samples(spark, sf).select("user_id", F.col("label").cast("double").alias("label"), "features")
    d = d.withColumn("features", F.transform("features", lambda x: F.coalesce(x, F.lit(0.0))))
    # Samples of hours with the same values around them are equal: a stay's are kept once, with their number,
    # where the stay's hours are.  They are kept on disk: the learner holds its own copy of each in memory.
    d = d.groupBy("user_id", "label", "features").agg(F.count(F.lit(1)).alias("n"))
    d = d.select("label", "n", array_to_vector("features").alias("features"), (uniform(31, "user_id") < 0.3).alias("test"))
    kept = d.persist(StorageLevel.DISK_ONLY)
    try:
        samples = kept.agg(F.sum("n")).first()[0] or 0
        d = kept.coalesce(max(spark.sparkContext.defaultParallelism, -(-samples // SAMPLES)))
        train = MD.each_time(MD.class_weights(d.filter("NOT test"), "label", count="n"), "n")
        model = MD.fit_multiclass(train, "label", "weight")
        return MP._local(MD.class_report(model.transform(d.filter("test")), "label", count="n"))
    finally:
        kept.unpersist()


@register("model_kfold")
def q_model_kfold(spark, sf):
    """D33 (M04, M10, M16): exact test AUROC of each of five subject folds."""
    d = kfold(MP.doc_features(spark, sf), "doc_id", 5, seed=3).persist()
    try:
        out = []
        for k in range(5):
            model = MD.fit_classifier(d.filter(F.col("fold") != k), MP.FEATURES, "logreg", seed=11)
            pred = MD.positive_probability(model.transform(d.filter(F.col("fold") == k)))
            out.append(MD.exact_auroc(pred.select("p1", "label"), "p1", "label").withColumn("fold", F.lit(k)))
        return MP._local(reduce(lambda a, b: a.unionByName(b), out))
    finally:
        d.unpersist()
