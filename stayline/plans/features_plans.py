"""Composite feature tables (D10-D15, D22, D23, D29) and source operators
(U01, S19), bound to the provided tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from stayline.functions import scores as SC
from stayline.functions.hashing import uniform, uniform_sql
from stayline.functions.numbers import round_numeric
from stayline.functions.timefns import add_hours, interval_day_part, interval_hour_part
from stayline.operators.asof import asof_backward
from stayline.operators.cohort import stay_ordinals
from stayline.operators.features import full_outer_coalesce, label_features
from stayline.operators.impute import simple_impute
from stayline.operators.interval_join import events_in_windows
from stayline.operators.ordered import dense_rank_within, lag_within
from stayline.operators.sessions import gap_sessions
from stayline.plans import events_plans as EP
from stayline.plans import orders_plans as OP
from stayline.plans.registry import register, rounded
from stayline.sources.tables import table

HOUR_US = 3_600_000_000


# ------------------------------------------------------------- D10 demographics
@register("demographics", "WITH " + OP.SQL_STAYS + """,
anc AS (SELECT o_custkey AS subject_id, year(min(o_orderdate)) AS anchor_year FROM orders GROUP BY o_custkey),
ag AS (SELECT c_custkey AS subject_id, CAST(floor(abs(c_acctbal) / 200) AS INTEGER) + 18 AS anchor_age FROM customer)
SELECT st2.subject_id, hadm_id, icustay_id, admittime, dischtime,
  CAST(date_part('day', dischtime - admittime) AS INTEGER) AS los_hospital,
  CAST(floor(date_part('day', admittime - make_timestamp(anchor_year, 1, 1, 0, 0, 0)) / 365.0) + anchor_age AS INTEGER) AS admission_age,
  hospstay_seq, hospstay_seq = 1 AS first_hosp_stay,
  CAST(round(CAST(date_part('hour', outtime - intime) AS DECIMAL(38, 10)) / 24.0, 2) AS DOUBLE) AS los_icu_hour_part,
  round(date_diff('microsecond', intime, outtime) / 3600000000.0 / 24.0, 2) AS los_icu,
  CAST(dense_rank() OVER (PARTITION BY hadm_id ORDER BY intime) AS INTEGER) AS icustay_seq
FROM st2 JOIN anc USING (subject_id) JOIN ag USING (subject_id)""")
def q_demographics(spark, sf):
    """D10 (W02, F06, F07, F14): stay ordinals, interval parts, anchored age, rounded LOS.

    ``los_icu_hour_part`` is the source's literal DATE_PART('hour', ...) form
    (the 0-23 hour component); ``los_icu`` is the true length in days."""
    s = OP.stays(spark, sf)
    o = table(spark, sf, "orders")
    anc = o.groupBy(F.col("o_custkey").alias("subject_id")).agg(F.year(F.min("o_orderdate")).alias("anchor_year"))
    ag = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("subject_id"),
        (F.floor(F.abs("c_acctbal") / 200).cast("int") + 18).alias("anchor_age"))
    d = s.join(anc, "subject_id").join(ag, "subject_id")
    d = stay_ordinals(d, "subject_id", "admittime", "hospstay_seq")
    d = dense_rank_within(d, ["hadm_id"], "intime", "icustay_seq")
    anchor = F.make_timestamp_ntz(F.col("anchor_year").cast("int"), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    age = F.floor(interval_day_part(anchor, "admittime") / 365.0) + F.col("anchor_age")
    los_true = F.round(F.timestamp_diff("MICROSECOND", F.col("intime"), F.col("outtime")) / HOUR_US / 24.0, 2)
    return rounded(d.select(
        "subject_id", "hadm_id", "icustay_id", "admittime", "dischtime",
        interval_day_part("admittime", "dischtime").cast("int").alias("los_hospital"),
        age.cast("int").alias("admission_age"), "hospstay_seq",
        (F.col("hospstay_seq") == 1).alias("first_hosp_stay"),
        round_numeric(interval_hour_part("intime", "outtime").cast("decimal(38,10)") / 24.0, 2).alias("los_icu_hour_part"),
        los_true.alias("los_icu"), "icustay_seq"))


# ------------------------------------------------------------- D11 height history
@register("height_history", """
WITH h1 AS (SELECT user_id, ts, CAST(round(CAST(value AS DECIMAL(38, 10)), 2) AS DOUBLE) AS height
            FROM events WHERE event_type = 'view' AND value BETWEEN 120 AND 230),
h2 AS (SELECT user_id, ts, CAST(round(CAST(value * 2.54 AS DECIMAL(38, 10)), 2) AS DOUBLE) AS height
       FROM events WHERE event_type = 'click' AND value * 2.54 BETWEEN 120 AND 230)
SELECT coalesce(h1.user_id, h2.user_id) AS user_id, coalesce(h1.ts, h2.ts) AS ts,
       coalesce(h1.height, h2.height) AS height
FROM h1 FULL OUTER JOIN h2 ON h1.user_id = h2.user_id AND h1.ts = h2.ts""")
def q_height_history(spark, sf):
    """D11 (J07, F13, F14, P06): two height sources (cm, inches) full-outer-joined."""
    ev = EP.events(spark, sf)
    h1 = ev.filter((F.col("event_type") == "view") & F.col("value").between(120, 230)).select(
        "user_id", "ts", round_numeric(F.col("value"), 2).alias("h1"))
    cm = F.col("value") * 2.54
    h2 = ev.filter((F.col("event_type") == "click") & cm.between(120, 230)).select(
        "user_id", "ts", round_numeric(cm, 2).alias("h2"))
    j = full_outer_coalesce(h1, h2, ["user_id", "ts"])
    return j.select("user_id", "ts", F.coalesce("h1", "h2").alias("height"))


# ------------------------------------------------------------- D12 weight durations
@register("weight_durations", "WITH " + EP.SQL_STAYS.strip().rstrip(",").split("grid AS")[0].rstrip().rstrip(",") + """,
reading AS (  -- each weight counts from its time on, a stay's first admission weight from six hours before entry
  SELECT e.user_id, e.event_id, s.intime, s.outtime, e.value AS weight,
         CASE e.event_type WHEN 'purchase' THEN 'admit' ELSE 'daily' END AS weight_type,
         CASE WHEN e.event_id = arg_min(e.event_id, (e.ts, e.event_id)) FILTER (WHERE e.event_type = 'purchase')
                   OVER (PARTITION BY e.user_id) THEN s.intime - INTERVAL 6 HOUR ELSE e.ts END AS valid_from
  FROM events e JOIN s USING (user_id) WHERE e.event_type IN ('purchase', 'signup') AND e.value IS NOT NULL),
placed AS (
  SELECT *, lead(valid_from) OVER o AS following, first_value(event_id) OVER o AS first_id
  FROM reading WINDOW o AS (PARTITION BY user_id ORDER BY valid_from, event_id))
SELECT user_id, valid_from AS starttime, coalesce(following, outtime + INTERVAL 2 HOUR) AS endtime,
       round(weight, 6) AS weight, weight_type FROM placed
UNION ALL
SELECT user_id, intime - INTERVAL 2 HOUR, valid_from, round(weight, 6), weight_type
FROM placed WHERE event_id = first_id AND valid_from > intime""")
def q_weight_durations(spark, sf):
    """D12 (W07, W06, J08, U02): weight validity intervals with the admit weight
    moved before entry and a back-filled first interval."""
    ev = EP.events(spark, sf)
    s = EP.stays(ev).select("user_id", "intime", "outtime")
    wt = ev.filter(F.col("event_type").isin("purchase", "signup") & F.col("value").isNotNull()).select(
        "event_id", "user_id", F.col("ts").alias("charttime"),
        F.when(F.col("event_type") == "purchase", "admit").otherwise("daily").alias("weight_type"),
        F.col("value").alias("weight"))
    # rn = 1 of the admit type as an aggregate (no per-stay sort)
    first_admit = wt.filter(F.col("weight_type") == "admit").groupBy("user_id").agg(
        F.min_by("event_id", F.struct("charttime", "event_id")).alias("__first_id"))
    w = wt.join(s, "user_id").join(first_admit, "user_id", "left")
    moved = (F.col("weight_type") == "admit") & (F.col("event_id") == F.col("__first_id"))
    w = w.withColumn("starttime", F.when(moved, add_hours("intime", -6)).otherwise(F.col("charttime")))
    w = lag_within(w, ["user_id"], "starttime", ["starttime"], tiebreak=["event_id"], prefix="__next_", descending=True)
    w = w.withColumn("endtime", F.coalesce(F.col("__next_starttime"), add_hours("outtime", 2)))
    w1 = w.select("user_id", "event_id", "intime", "starttime", "endtime", "weight", "weight_type")
    first = w1.groupBy("user_id").agg(F.min_by(F.struct("intime", "starttime", "weight", "weight_type"),
                                               F.struct("starttime", "event_id")).alias("__f"))
    fix = first.select("user_id", F.col("__f.intime").alias("intime"), F.col("__f.starttime").alias("fs"),
                       F.col("__f.weight").alias("weight"), F.col("__f.weight_type").alias("weight_type"))
    fix = fix.filter(F.col("intime") < F.col("fs")).select(
        "user_id", add_hours("intime", -2).alias("starttime"), F.col("fs").alias("endtime"), "weight", "weight_type")
    out = w1.select("user_id", "starttime", "endtime", "weight", "weight_type").unionByName(fix)
    return rounded(out)


# ------------------------------------------------------------- D14 vital pivot
# Variable, event type, validity test, aggregate for the per-chart-time pivot.
VITAL_PIVOT = (
    ("heart_rate", "click", "value > 0 AND value < 300", "avg"),
    ("sbp", "view", "value > 0 AND value < 400", "avg"),
    ("dbp", "error", "value > 0 AND value < 300", "avg"),
    ("resp_rate", "signup", "value > 0 AND value < 70", "avg"),
    ("glucose", "purchase", "value > 0", "max"),
)


@register("vitals_pivot", "SELECT user_id, ts, " + ", ".join(
    f"round({agg}(CASE WHEN event_type = '{t}' AND {cond} THEN value END), 6) AS {name}"
    for name, t, cond, agg in VITAL_PIVOT) + " FROM events GROUP BY user_id, ts")
def q_vitals_pivot(spark, sf):
    """D14 (A03): conditional averages per chart time with per-variable validity bounds."""
    ev = EP.events(spark, sf)
    fn = {"avg": F.avg, "max": F.max}
    aggs = [fn[agg](F.when((F.col("event_type") == t) & F.expr(cond), F.col("value"))).alias(name)
            for name, t, cond, agg in VITAL_PIVOT]
    return rounded(ev.groupBy("user_id", "ts").agg(*aggs))


# ------------------------------------------------------------- D15 blood differential
@register("blood_differential", """
WITH g AS (SELECT l_orderkey AS hadm_id, max(l_quantity) AS wbc,
                  sum(CASE WHEN l_returnflag = 'R' THEN l_discount * 100 END) AS pct_r,
                  max(CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN l_extendedprice / 1000 END) AS abs_r,
                  CASE WHEN max(l_quantity) > 0 AND sum(l_discount * 100) > 0 THEN 1 ELSE 0 END AS impute_abs
           FROM lineitem GROUP BY l_orderkey)
SELECT hadm_id, round(wbc, 6) AS wbc, round(pct_r, 6) AS pct_r, CAST(impute_abs AS INTEGER) AS impute_abs,
       round(CASE WHEN abs_r IS NULL AND impute_abs = 1 THEN CAST(round(CAST(pct_r * wbc / 100 AS DECIMAL(38, 10)), 4) AS DOUBLE)
                  ELSE abs_r END, 6) AS abs_r
FROM g""")
def q_blood_differential(spark, sf):
    """D15 (A02, A25, F17): per specimen pivot, availability flag, %·total imputation."""
    li = table(spark, sf, "lineitem")
    r = F.col("l_returnflag") == "R"
    g = li.groupBy(F.col("l_orderkey").alias("hadm_id")).agg(
        F.max("l_quantity").alias("wbc"), F.sum(F.when(r, F.col("l_discount") * 100)).alias("pct_r"),
        F.max(F.when(r & (F.col("l_linestatus") == "O"), F.col("l_extendedprice") / 1000)).alias("abs_r"),
        F.when((F.max("l_quantity") > 0) & (F.sum(F.col("l_discount") * 100) > 0), 1).otherwise(0).alias("impute_abs"))
    return rounded(g.select("hadm_id", "wbc", "pct_r", F.col("impute_abs").cast("int").alias("impute_abs"),
                            SC.impute_from_percent(F.col("abs_r"), F.col("pct_r"), F.col("wbc"), F.col("impute_abs"))
                            .alias("abs_r")))


# ------------------------------------------------------------- D13 blood gas
def _specimen_sql() -> str:
    terms = {"spo2": "c.spo2", "fio2_chartevents": "v.fio2_chartevents", "pco2": "p.pco2"}
    z = [f"{SC.SPECIMEN_INTERCEPT!r}", f"{SC.SPECIMEN_PO2_COEF!r} * p.po2"]
    for name, b, mean, off in SC.SPECIMEN_TERMS:
        fb = repr(b * mean + off)
        z.append(f"coalesce({b!r} * {terms[name]}, {fb})" if name in terms else fb)
    return "1 / (1 + exp(-(" + " + ".join(z) + ")))"


@register("blood_gas", f"""
WITH p AS (SELECT event_id, user_id, ts, value AS po2, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS pco2
           FROM events WHERE event_type = 'purchase'),
c AS (SELECT p.event_id, r.value AS spo2,
             row_number() OVER (PARTITION BY p.event_id ORDER BY r.ts DESC, r.value DESC) AS rn
      FROM p JOIN events r ON r.user_id = p.user_id AND r.event_type = 'click' AND r.ts BETWEEN p.ts - INTERVAL 2 HOUR AND p.ts),
v AS (SELECT p.event_id, r.value AS fio2_chartevents,
             row_number() OVER (PARTITION BY p.event_id ORDER BY r.ts DESC, r.value DESC) AS rn
      FROM p JOIN events r ON r.user_id = p.user_id AND r.event_type = 'view' AND r.value > 0
       AND r.ts BETWEEN p.ts - INTERVAL 4 HOUR AND p.ts),
j AS (SELECT p.*, c.spo2, v.fio2_chartevents, {_specimen_sql()} AS specimen_prob
      FROM p LEFT JOIN (SELECT * FROM c WHERE rn = 1) c USING (event_id) LEFT JOIN (SELECT * FROM v WHERE rn = 1) v USING (event_id))
SELECT event_id, user_id, ts, round(po2, 6) AS po2, round(pco2, 6) AS pco2, round(spo2, 6) AS spo2,
       round(fio2_chartevents, 6) AS fio2_chartevents, round(specimen_prob, 6) AS specimen_prob,
       CASE WHEN specimen_prob > {SC.SPECIMEN_THRESHOLD} THEN 'ART.' END AS specimen_pred,
       round(CASE WHEN po2 IS NULL OR pco2 IS NULL THEN NULL
                  WHEN fio2_chartevents IS NOT NULL THEN (fio2_chartevents / 100) * {SC.ATMOSPHERIC_MINUS_WATER} - (pco2 / 0.8) - po2 END, 6) AS aado2_calc,
       round(CASE WHEN po2 IS NULL THEN NULL WHEN fio2_chartevents IS NOT NULL THEN 100 * po2 / fio2_chartevents END, 6) AS pao2fio2ratio
FROM j""")
def q_blood_gas(spark, sf):
    """D13 (J06, F15, F16): latest SpO2 (2 h) and FiO2 (4 h) before each gas,
    specimen probability, A–a gradient and P/F ratio."""
    ev = EP.events(spark, sf)
    p = ev.filter(F.col("event_type") == "purchase").select(
        "event_id", "user_id", "ts", F.col("value").alias("po2"),
        F.get_json_object("props", "$.k").cast("double").alias("pco2"))
    c = ev.filter(F.col("event_type") == "click").select("user_id", "ts", F.col("value").alias("spo2"))
    v = ev.filter((F.col("event_type") == "view") & (F.col("value") > 0)).select(
        "user_id", "ts", F.col("value").alias("fio2_chartevents"))
    d = asof_backward(p, c, ["user_id"], "ts", "ts", 2 * 3600, ["spo2"], "c_", tiebreak=["spo2"])
    d = d.withColumnRenamed("c_spo2", "spo2").drop("c_ts")
    d = asof_backward(d, v, ["user_id"], "ts", "ts", 4 * 3600, ["fio2_chartevents"], "v_",
                      tiebreak=["fio2_chartevents"])
    d = d.withColumnRenamed("v_fio2_chartevents", "fio2_chartevents").drop("v_ts")
    cols = {"po2": F.col("po2"), "spo2": F.col("spo2"), "fio2_chartevents": F.col("fio2_chartevents"),
            "pco2": F.col("pco2")}
    prob = SC.specimen_probability(cols)
    none = F.lit(None).cast("double")
    return rounded(d.select(
        "event_id", "user_id", "ts", "po2", "pco2", "spo2", "fio2_chartevents", prob.alias("specimen_prob"),
        F.when(prob > SC.SPECIMEN_THRESHOLD, F.lit("ART.")).alias("specimen_pred"),
        SC.aado2(F.col("po2"), F.col("pco2"), none, F.col("fio2_chartevents")).alias("aado2_calc"),
        SC.pf_ratio(F.col("po2"), none, F.col("fio2_chartevents")).alias("pao2fio2ratio")))


# ------------------------------------------------------------- D23 design matrix
DM_W, DM_W_EXTRA = 4, 24
DM_VARS = ("click_mean", "view_mean")


def design_matrix(grid, targets, stay: str, cols, w: int = DM_W, w_extra: int = DM_W_EXTRA):
    """Rows of hours t-(W+W_extra) .. t around each stay's target
    hour t; ``early`` = more than W hours before t.  first/last over the
    whole window → ``_first_early``/``_last_early``; over the late part →
    ``_first``, ``_last``, ``_min``, ``_max``, ``_sum`` (sum of nothing = 0).
    One range-filtered join and one aggregation."""
    m = w + w_extra
    d = grid.join(targets, stay).filter(F.col("hours_in").between(F.col("t") - m, F.col("t")))
    late = (F.col("t") - F.col("hours_in")) <= w
    aggs = []
    for c in cols:
        nn = F.col(c).isNotNull()
        aggs += [F.min_by(F.col(c), F.when(nn & late, F.col("hours_in"))).alias(f"{c}_first"),
                 F.min_by(F.col(c), F.when(nn, F.col("hours_in"))).alias(f"{c}_first_early"),
                 F.max_by(F.col(c), F.when(nn & late, F.col("hours_in"))).alias(f"{c}_last"),
                 F.max_by(F.col(c), F.when(nn, F.col("hours_in"))).alias(f"{c}_last_early"),
                 F.min(F.when(late, F.col(c))).alias(f"{c}_min"), F.max(F.when(late, F.col(c))).alias(f"{c}_max"),
                 F.coalesce(F.sum(F.when(late, F.col(c))), F.lit(0.0)).alias(f"{c}_sum")]
    return d.groupBy(stay).agg(*aggs)


def _dm_sql(targets: str = "SELECT user_id, max_hours // 2 AS t FROM s", extra: str = "") -> str:
    m = DM_W + DM_W_EXTRA
    cols = []
    for c in DM_VARS:
        late = f"(t - hours_in) <= {DM_W}"
        cols += [f"round(arg_min({c}, hours_in) FILTER (WHERE {c} IS NOT NULL AND {late}), 6) AS {c}_first",
                 f"round(arg_min({c}, hours_in) FILTER (WHERE {c} IS NOT NULL), 6) AS {c}_first_early",
                 f"round(arg_max({c}, hours_in) FILTER (WHERE {c} IS NOT NULL AND {late}), 6) AS {c}_last",
                 f"round(arg_max({c}, hours_in) FILTER (WHERE {c} IS NOT NULL), 6) AS {c}_last_early",
                 f"round(min({c}) FILTER (WHERE {late}), 6) AS {c}_min",
                 f"round(max({c}) FILTER (WHERE {late}), 6) AS {c}_max",
                 f"round(coalesce(sum({c}) FILTER (WHERE {late}), 0.0), 6) AS {c}_sum"]
    return EP.SQL_WIDE + f""",
tg AS ({targets})
SELECT w.user_id, {', '.join(cols)}{extra}
FROM w JOIN tg USING (user_id) WHERE w.hours_in BETWEEN t - {m} AND t GROUP BY w.user_id{extra}"""


@register("design_matrix", _dm_sql())
def q_design_matrix(spark, sf):
    """D23 (M09, J17): look-back design matrix at the middle hour of every stay."""
    w, s = EP.wide_grid(spark, sf)
    targets = s.select("user_id", F.floor(F.col("max_hours") / 2).cast("bigint").alias("t"))
    return rounded(design_matrix(w, targets, "user_id", DM_VARS))


def random_times(stays, stay: str, end_hours: str, death_hours: str | None = None, t_before: float | None = None,
                 seed: int = 111, name: str = "t", censor_hours: str | None = None, t_to_death: float | None = None):
    """Window end drawn uniformly in [0, end - T) per stay (floor,
    negatives → 0), end = discharge or earlier death or, with
    ``censor_hours``, the still earlier time of censoring; the draw is a hash of
    (stay, seed) so it never depends on partitioning.

    ``t_to_death`` fixes the time of those who die at most that many hours after
    discharge: that many hours before their death, whatever was drawn (a
    fraction of an hour, negative for an early death); ``name`` is a double then."""
    end = F.col(end_hours)
    if death_hours is not None:
        end = F.when(F.col(death_hours).isNotNull() & (F.col(death_hours) < end), F.col(death_hours)).otherwise(end)
    if censor_hours is not None:
        end = F.when(F.col(censor_hours) < end, F.col(censor_hours)).otherwise(end)  # NULL: not censored
    span = end - F.lit(t_before) if t_before is not None else end
    t = F.greatest(F.floor(uniform(seed, stay) * span), F.lit(0)).cast("bigint")
    if t_to_death is not None:
        if death_hours is None:
            raise ValueError("t_to_death needs death_hours")
        t = F.when(F.col(death_hours) - F.col(end_hours) <= t_to_death, F.col(death_hours) - t_to_death).otherwise(t.cast("double"))
    return stays.withColumn(name, t)


@register("random_design_matrix", _dm_sql(f"""
  SELECT user_id, CAST(greatest(floor({uniform_sql(111, 's.user_id')} * (
    CASE WHEN d.h < s.max_hours THEN d.h ELSE CAST(s.max_hours AS DOUBLE) END - 6.0)), 0) AS BIGINT) AS t
  FROM s LEFT JOIN (SELECT e.user_id, min(date_diff('microsecond', s.intime, e.ts)) / 3600000000.0 AS h
                    FROM events e JOIN s USING (user_id) WHERE e.event_type = 'error' GROUP BY e.user_id) d USING (user_id)""", ", t"))
def q_random_design_matrix(spark, sf):
    """D23 (M08, F32, F33): design matrix at a random hour ≥ 6 h before the end
    of each stay (death = first error event, if earlier)."""
    w, s = EP.wide_grid(spark, sf)
    ev = EP.events(spark, sf)
    first_err = ev.filter(F.col("event_type") == "error").groupBy("user_id").agg(F.min("ts").alias("__d"))
    st = s.join(first_err, "user_id", "left").select(
        "user_id", F.col("max_hours").cast("double").alias("end_h"),
        (F.timestamp_diff("MICROSECOND", F.col("intime"), F.col("__d")) / HOUR_US).alias("death_h"))
    tg = random_times(st, "user_id", "end_h", "death_h", t_before=6.0).select("user_id", "t")
    return rounded(design_matrix(w, tg, "user_id", DM_VARS).join(tg, "user_id"))


@register("death_design_matrix", _dm_sql(f"""
  SELECT user_id, CASE WHEN d.h - s.max_hours <= 6 THEN round(d.h - 6, 6) ELSE greatest(floor({uniform_sql(111, 's.user_id')} * (
    least(CASE WHEN d.h < s.max_hours THEN d.h ELSE CAST(s.max_hours AS DOUBLE) END, coalesce(c.h, 1e18)))), 0) END AS t
  FROM s LEFT JOIN (SELECT e.user_id, max(date_diff('microsecond', s.intime, e.ts)) / CAST(3600000000 AS DOUBLE) AS h
                    FROM events e JOIN s USING (user_id) WHERE e.event_type = 'error' GROUP BY e.user_id) d USING (user_id)
  LEFT JOIN (SELECT e.user_id, min(date_diff('microsecond', s.intime, e.ts)) / CAST(3600000000 AS DOUBLE) AS h
             FROM events e JOIN s USING (user_id) WHERE e.event_type = 'signup' GROUP BY e.user_id) c USING (user_id)""", ", t"))
def q_death_design_matrix(spark, sf):
    """D23 (M08): design matrix 6 hours before the death of those who die, at a
    random hour of the others (death = last error event, censored at the first signup)."""
    w, s = EP.wide_grid(spark, sf)
    at = EP.events(spark, sf).filter(F.col("event_type").isin("error", "signup")).groupBy("user_id").agg(
        F.max(F.when(F.col("event_type") == "error", F.col("ts"))).alias("__d"),
        F.min(F.when(F.col("event_type") == "signup", F.col("ts"))).alias("__c"))

    def hours(ts):
        return F.timestamp_diff("MICROSECOND", F.col("intime"), F.col(ts)) / HOUR_US
    st = s.join(at, "user_id", "left").select("user_id", F.col("max_hours").cast("double").alias("end_h"),
                                              hours("__d").alias("death_h"), hours("__c").alias("censor_h"))
    tg = random_times(st, "user_id", "end_h", "death_h", censor_hours="censor_h", t_to_death=6.0)
    tg = tg.select("user_id", F.round("t", 6).alias("t"))
    return rounded(design_matrix(w, tg, "user_id", DM_VARS).join(tg, "user_id"))


# ------------------------------------------------------------- D29 task table
TASK_WINDOW, TASK_GAP = 24, 6


def _task_sql() -> str:
    imp = ("round(coalesce(last_value(click_mean IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY hours_in "
           "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), avg(click_mean) OVER (PARTITION BY user_id), "
           "(SELECT avg(click_mean) FROM x24)), 6)")
    piv = ", ".join(f"max(v) FILTER (WHERE hours_in = {h}) AS click_mean_h{h}" for h in range(TASK_WINDOW))
    return EP.SQL_WIDE + f""",
el AS (SELECT user_id, max_hours, intime FROM s WHERE max_hours > {TASK_WINDOW + TASK_GAP}),
x24 AS (SELECT w.user_id, w.hours_in, w.click_mean FROM w JOIN el USING (user_id) WHERE w.hours_in < {TASK_WINDOW}),
imp AS (SELECT user_id, hours_in, {imp} AS v FROM x24)
SELECT imp.user_id, CAST(CASE WHEN el.max_hours / 24.0 > 3 THEN 1 ELSE 0 END AS INTEGER) AS los_3,
       CAST(CASE WHEN el.max_hours / 24.0 > 7 THEN 1 ELSE 0 END AS INTEGER) AS los_7,
       CAST(hour(el.intime) AS INTEGER) AS abs_hour0, {piv}
FROM imp JOIN el USING (user_id) GROUP BY imp.user_id, el.max_hours, el.intime"""


@register("task_table", _task_sql())
def q_task_table(spark, sf):
    """D29 (P16, F29, M06, A32, F09): eligible stays (> 24 + 6 h), first 24 h
    imputed and flattened hour by hour, LOS > 3 / > 7 day labels."""
    w, s = EP.wide_grid(spark, sf)
    el = s.filter(F.col("max_hours") > TASK_WINDOW + TASK_GAP).select("user_id", "max_hours", "intime")
    x = w.join(el.select("user_id"), "user_id", "left_semi").filter(F.col("hours_in") < TASK_WINDOW)
    imp = simple_impute(x.select("user_id", "hours_in", "click_mean", "click_count"), ["user_id"], ["click"])
    piv = imp.groupBy("user_id").agg(*[F.max(F.when(F.col("hours_in") == h, F.col("click_mean")))
                                       .alias(f"click_mean_h{h}") for h in range(TASK_WINDOW)])
    los = F.col("max_hours") / 24.0
    out = piv.join(el, "user_id").select(
        "user_id", F.when(los > 3, 1).otherwise(0).cast("int").alias("los_3"),
        F.when(los > 7, 1).otherwise(0).cast("int").alias("los_7"),
        F.hour("intime").cast("int").alias("abs_hour0"), *[f"click_mean_h{h}" for h in range(TASK_WINDOW)])
    return rounded(out)


# ------------------------------------------------------------- D22 modelling table
@register("model_table", EP.SQL_IND + """,
a AS (SELECT user_id, count(*) AS n_events, round(avg(value), 6) AS mean_value FROM events GROUP BY user_id),
therapy AS (SELECT DISTINCT user_id, ts FROM events WHERE event_type IN ('purchase', 'click')),
gaps AS (SELECT user_id, ts, ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS gap,
                lead(ts) OVER (PARTITION BY user_id ORDER BY ts) - ts AS next_gap FROM therapy),
-- A session's hours are the sum of its inner gaps; it counts if it has one.
b AS (SELECT user_id, count(*) FILTER (WHERE (gap IS NULL OR gap > INTERVAL 8 HOUR) AND next_gap <= INTERVAL 8 HOUR) AS n_sessions,
             round(sum(CASE WHEN gap <= INTERVAL 8 HOUR THEN date_diff('microsecond', ts - gap, ts) END) / 3600000000.0, 6)
               AS session_hours
      FROM gaps GROUP BY user_id HAVING n_sessions > 0),
c AS (SELECT user_id, sum(purchase_on) AS purchase_hours, count(*) AS n_hours FROM ind GROUP BY user_id)
SELECT * FROM a JOIN b USING (user_id) JOIN c USING (user_id)""")
def q_model_table(spark, sf):
    """D22 (J11, A08, A34): N-way inner join of per-stay feature tables on the stay key."""
    from functools import reduce
    ev = EP.events(spark, sf)
    a = ev.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_events"), F.avg("value").alias("mean_value"))
    sess = gap_sessions(ev.withColumn("flag", F.when(F.col("event_type").isin(*EP.SESSION_TYPES), 1).otherwise(0)),
                        "user_id", "ts", "flag", 8.0)
    b = sess.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_sessions"), F.sum("duration_hours").alias("session_hours"))
    c = EP.indicator_grid(spark, sf).groupBy("user_id").agg(F.sum("purchase_on").cast("long").alias("purchase_hours"),
                                                              F.count(F.lit(1)).alias("n_hours"))
    return rounded(reduce(lambda x, y: x.join(y, "user_id", "inner"), [a, b, c]))


# ------------------------------------------------------------- U01 / P05 / S19
@register("measurement_union", """
WITH chart AS (SELECT user_id, ts, event_type, value FROM events WHERE event_type <> 'error'),
lab AS (SELECT DISTINCT user_id, ts, event_type, value FROM events
        WHERE event_type = 'error' AND value IS DISTINCT FROM 0),
u AS (SELECT * FROM chart UNION ALL SELECT * FROM lab)
SELECT event_type, count(*) AS n, round(avg(value), 6) AS mean FROM u GROUP BY event_type""")
def q_measurement_union(spark, sf):
    """U01 (P05): chart rows UNION ALL de-duplicated lab rows (null-safe exclusion)."""
    ev = EP.events(spark, sf).select("user_id", "ts", "event_type", "value")
    chart = ev.filter(F.col("event_type") != "error")
    lab = ev.filter((F.col("event_type") == "error") & ~F.col("value").eqNullSafe(0)).distinct()
    u = chart.unionByName(lab)
    return rounded(u.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean")))


@register("seen_items", """
SELECT p_partkey, p_name, p_brand FROM part
WHERE p_partkey IN (SELECT l_partkey FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_orderstatus = 'F')""")
def q_seen_items(spark, sf):
    """S19 (S04): the item dictionary restricted to items seen in the cohort's events (semi join)."""
    o = table(spark, sf, "orders").filter(F.col("o_orderstatus") == "F").select(F.col("o_orderkey").alias("l_orderkey"))
    seen = table(spark, sf, "lineitem").select("l_orderkey", F.col("l_partkey").alias("p_partkey")) \
        .join(o, "l_orderkey", "left_semi").select("p_partkey")
    return table(spark, sf, "part").select("p_partkey", "p_name", "p_brand").join(seen, "p_partkey", "left_semi")


# ------------------------------------------------------------- M18 duration sweep
SWEEP_HOURS = (8, 24, 48, 72, 96, 120, 144)


@register("duration_sweep", EP._with(EP.SQL_STAYS) + """
SELECT s.user_id, """ + ", ".join(
    f"count(e.value) FILTER (WHERE e.ts <= s.intime + INTERVAL {d} HOUR) AS n_{d}h, "
    f"round(avg(e.value) FILTER (WHERE e.ts <= s.intime + INTERVAL {d} HOUR), 6) AS mean_{d}h"
    for d in SWEEP_HOURS) + """
FROM s JOIN events e ON e.user_id = s.user_id AND e.ts >= s.intime - INTERVAL 6 HOUR
 AND e.ts <= s.intime + INTERVAL """ + str(max(SWEEP_HOURS)) + """ HOUR
GROUP BY s.user_id""")
def q_duration_sweep(spark, sf):
    """Features for observation windows of 8 … 144 h in ONE scan — the
    widest window is joined once and each duration is a conditional aggregate."""
    ev = EP.events(spark, sf)
    s = EP.stays(ev).select("user_id", "intime")
    w = s.withColumns({"from": add_hours("intime", -6), "to": add_hours("intime", max(SWEEP_HOURS))})
    d = events_in_windows(ev.select("user_id", "event_id", "ts", "value"), w, "user_id", "ts", "from", "to")
    aggs = []
    for h in SWEEP_HOURS:
        v = F.when(F.col("ts") <= add_hours("intime", h), F.col("value"))
        aggs += [F.count(v).alias(f"n_{h}h"), F.avg(v).alias(f"mean_{h}h")]
    return rounded(d.groupBy("user_id").agg(*aggs))


# ------------------------------------------------------------- D26 / J25 wide durations
DURATION_TYPES = ("purchase", "error", "signup", "view")


@register("wide_durations", EP._with(EP.SQL_STAYS) + """,
nx AS (SELECT user_id, event_type, ts,
              coalesce(lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id), ts) AS nts FROM events),
du AS (SELECT user_id, event_type, sum(date_diff('microsecond', ts, nts)) / 3600000000.0 AS h FROM nx GROUP BY user_id, event_type)
SELECT s.user_id, """ + ", ".join(f"round(d_{t}.h, 6) AS {t}_hours" for t in DURATION_TYPES) + """
FROM s """ + " ".join(f"LEFT JOIN (SELECT user_id, h FROM du WHERE event_type = '{t}') d_{t} ON d_{t}.user_id = s.user_id"
                      for t in DURATION_TYPES))
def q_wide_durations(spark, sf):
    """Per-stay total duration of each interval type (NULL where a
    stay has none)."""
    from stayline.operators.intervals import next_start_end
    ev = EP.events(spark, sf).select("user_id", "event_id", "event_type", "ts")
    nx = next_start_end(ev, ["user_id"], "ts", tiebreak=["event_id"], name="nts")
    us = F.timestamp_diff("MICROSECOND", F.col("ts"), F.col("nts"))
    hours = [(F.sum(F.when(F.col("event_type") == t, us)) / HOUR_US).alias(f"{t}_hours") for t in DURATION_TYPES]
    du = nx.groupBy("user_id").agg(*hours)  # one conditional sum per type instead of a join per type
    s = EP.stays(EP.events(spark, sf)).select("user_id")
    return rounded(s.join(du, "user_id", "left"))


# ------------------------------------------------------------- J16 collapse events
@register("collapse_events", """
WITH c AS (SELECT user_id, ts, value AS click FROM events WHERE event_type = 'click'),
v AS (SELECT user_id, ts, value AS view FROM events WHERE event_type = 'view'),
p AS (SELECT user_id, ts, value AS purchase FROM events WHERE event_type = 'purchase'),
k AS (SELECT user_id, ts FROM c UNION SELECT user_id, ts FROM v UNION SELECT user_id, ts FROM p)
SELECT k.user_id, k.ts, round(max(c.click), 6) AS click, round(max(v.view), 6) AS view, round(max(p.purchase), 6) AS purchase
FROM k LEFT JOIN c USING (user_id, ts) LEFT JOIN v USING (user_id, ts) LEFT JOIN p USING (user_id, ts)
GROUP BY k.user_id, k.ts""")
def q_collapse_events(spark, sf):
    """Several event tables merged on (stay, time) — as one union and one
    aggregation instead of a chain of outer joins."""
    ev = EP.events(spark, sf)
    tabs = {t: ev.filter(F.col("event_type") == t).select("user_id", "ts", F.col("value").alias(t))
            for t in ("click", "view", "purchase")}
    u = None
    for t, d in tabs.items():
        d = d.select("user_id", "ts", F.lit(t).alias("__t"), F.col(t).alias("__v"))
        u = d if u is None else u.unionByName(d)
    return rounded(u.groupBy("user_id", "ts").agg(*[F.max(F.when(F.col("__t") == t, F.col("__v"))).alias(t) for t in tabs]))
