"""Operators bound to customer / orders / lineitem.

A customer is a patient (``subject_id``); an order is an admission and its
single ICU stay (``hadm_id = icustay_id = o_orderkey``).  The stay runs from
``o_orderdate`` for one day per line item of the order (``los_icu`` days); the
admission is discharged two days after the stay ends.  ``deathtime`` is the
latest ship date of a returned line (``l_returnflag = 'R'``), which may or may
not fall inside the stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.functions.categorize import (ADMISSION_LOCATION_RULES, DIAGNOSIS_RULES, INSURANCE_RULES, MARITAL_RULES,
                                          age_band_strict, by_rules, categorize_age, first_match, flag)
from stayline.functions.timefns import add_seconds, calendar_age, diff_us
from stayline.operators import stats as S
from stayline.operators.codes import ordered_codes
from stayline.operators.cohort import (CohortParams, cohort_filter, latest_per, mortality_flags,
                                       readmission_30, stay_ordinals, with_max_hours)
from stayline.plans.registry import register, rounded
from stayline.sources.schema import conform, schema_from_spec
from stayline.sources.tables import table

# Cohort template variables of this binding.
PARAMS = CohortParams(min_age=0.0, min_day=1.0, min_dur=12, max_dur=240, excluded_unit="AUTOMOBILE")
DISCHARGE_AFTER_DAYS = 2
DIED_WITHIN_SECONDS = 3 * 86400


def stays(spark, sf) -> DataFrame:
    """One row per stay."""
    o = table(spark, sf, "orders")
    li = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.max(F.when(F.col("l_returnflag") == "R", F.col("l_shipdate"))).alias("deathtime"))
    d = o.join(li, o.o_orderkey == li.l_orderkey, "left")
    n = F.coalesce(F.col("n_lines"), F.lit(0))
    d = d.select(F.col("o_custkey").alias("subject_id"), F.col("o_orderkey").alias("hadm_id"),
                 F.col("o_orderkey").alias("icustay_id"), F.col("o_orderdate").alias("intime"),
                 (F.col("o_orderdate") + F.make_dt_interval(days=n.cast("int"))).alias("outtime"),
                 n.cast("double").alias("los_icu"), "deathtime", "o_orderpriority", "o_orderstatus",
                 "o_totalprice")
    return d.withColumn("admittime", F.col("intime")).withColumn(
        "dischtime", F.col("outtime") + F.make_dt_interval(days=F.lit(DISCHARGE_AFTER_DAYS)))


def patients(spark, sf) -> DataFrame:
    c = table(spark, sf, "customer")
    n = table(spark, sf, "nation")
    return c.join(n, c.c_nationkey == n.n_nationkey, "left").select(
        F.col("c_custkey").alias("subject_id"), F.col("c_mktsegment").alias("first_careunit"),
        F.col("c_acctbal").alias("age"), F.col("n_name").alias("ethnicity"))


def statics(spark, sf, filtered: bool = True) -> DataFrame:
    s = stays(spark, sf)
    s = stay_ordinals(s, "subject_id", "intime", "hospstay_seq").withColumn("icustay_seq", F.col("hospstay_seq"))
    s = readmission_30(s)
    d = s.join(patients(spark, sf), "subject_id", "inner")
    d = mortality_flags(d)
    if filtered:
        d = cohort_filter(d, PARAMS)
    d = with_max_hours(d)
    return d.select("subject_id", "hadm_id", "icustay_id", F.col("o_orderstatus").alias("gender"), "age",
                    "ethnicity", "los_icu", "admittime", "dischtime", "intime", "outtime", "deathtime",
                    F.col("o_orderpriority").alias("admission_type"), "first_careunit", "mort_icu",
                    "mort_hosp", "hospstay_seq", "readmission_30", "max_hours")


# ---------------------------------------------------------------- oracle SQL
SQL_STAYS = f"""
li AS (SELECT l_orderkey, count(*) AS n_lines, max(CASE WHEN l_returnflag = 'R' THEN l_shipdate END) AS deathtime
       FROM lineitem GROUP BY l_orderkey),
st AS (SELECT o.o_custkey AS subject_id, o.o_orderkey AS hadm_id, o.o_orderkey AS icustay_id,
              o.o_orderdate AS intime, o.o_orderdate + to_days(CAST(coalesce(li.n_lines, 0) AS INTEGER)) AS outtime,
              CAST(coalesce(li.n_lines, 0) AS DOUBLE) AS los_icu, li.deathtime, o.o_orderpriority, o.o_orderstatus,
              o.o_totalprice
       FROM orders o LEFT JOIN li ON li.l_orderkey = o.o_orderkey),
st2 AS (SELECT *, intime AS admittime, outtime + INTERVAL {DISCHARGE_AFTER_DAYS} DAY AS dischtime,
               CAST(dense_rank() OVER (PARTITION BY subject_id ORDER BY intime) AS INTEGER) AS hospstay_seq
        FROM st),
nxt AS (  -- the end of the stay that ends first among those that begin after this one
  SELECT x.icustay_id, x.subject_id, x.outtime, min(y.outtime) AS next_end
  FROM st x JOIN st y ON y.subject_id = x.subject_id AND y.intime > x.outtime GROUP BY x.icustay_id, x.subject_id, x.outtime),
f AS (SELECT icustay_id, 1 AS readmission_30 FROM nxt
      WHERE EXISTS (SELECT 1 FROM st z WHERE z.subject_id = nxt.subject_id AND z.outtime = nxt.next_end
                    AND z.icustay_id > nxt.icustay_id AND z.intime <= nxt.outtime + INTERVAL 30 DAY)),
pt AS (SELECT c_custkey AS subject_id, c_mktsegment AS first_careunit, c_acctbal AS age, n_name AS ethnicity
       FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)"""
SQL_STATICS = "WITH " + SQL_STAYS + f""",
allst AS (
  SELECT st2.subject_id, hadm_id, icustay_id, o_orderstatus AS gender, age, ethnicity, los_icu, admittime, dischtime,
         intime, outtime, deathtime, o_orderpriority AS admission_type, first_careunit,
         CAST(CASE WHEN deathtime BETWEEN intime AND outtime THEN 1 ELSE 0 END AS INTEGER) AS mort_icu,
         CAST(CASE WHEN deathtime BETWEEN admittime AND dischtime THEN 1 ELSE 0 END AS INTEGER) AS mort_hosp,
         hospstay_seq, CAST(coalesce(f.readmission_30, 0) AS INTEGER) AS readmission_30,
         CAST(floor(date_diff('microsecond', intime, outtime) / 3600000000.0) AS BIGINT) AS max_hours
  FROM st2 JOIN pt USING (subject_id) LEFT JOIN f USING (icustay_id)),
cohort AS (
  SELECT * FROM allst
  WHERE first_careunit NOT LIKE '{PARAMS.excluded_unit}' AND hadm_id IS NOT NULL AND icustay_id IS NOT NULL
    AND hospstay_seq = 1 AND age >= {PARAMS.min_age} AND los_icu >= {PARAMS.min_day}
    AND outtime >= intime + INTERVAL {PARAMS.min_dur} HOUR AND outtime <= intime + INTERVAL {PARAMS.max_dur} HOUR)"""


# ---------------------------------------------------------------- queries
@register("stay_ordinals", "WITH " + SQL_STAYS + """
SELECT subject_id, hadm_id, intime, hospstay_seq FROM st2""")
def q_stay_ordinals(spark, sf):
    """Dense rank of each admission within its patient by admission time."""
    s = stays(spark, sf).select("subject_id", "hadm_id", "intime")
    return stay_ordinals(s, "subject_id", "intime", "hospstay_seq")


@register("readmission_30", "WITH " + SQL_STAYS + """
SELECT st.subject_id, st.icustay_id, st.intime, st.outtime, CAST(coalesce(f.readmission_30, 0) AS INTEGER) AS readmission_30
FROM st LEFT JOIN f USING (icustay_id)""")
def q_readmission_30(spark, sf):
    """30-day readmission flag with the "next stay = earliest outtime" rule."""
    s = stays(spark, sf).select("subject_id", "icustay_id", "intime", "outtime")
    return readmission_30(s)


@register("cohort_statics", SQL_STATICS + """
SELECT * REPLACE (round(age, 6) AS age) FROM cohort""")
def q_cohort_statics(spark, sf):
    """D01 (P02, P03, P09, P10, J01-J03, W02): the static cohort table."""
    return rounded(statics(spark, sf))


@register("cohort_crosstab", SQL_STATICS + """
SELECT coalesce(admission_type, 'All') AS admission_type, coalesce(gender, 'All') AS gender, count(*) AS n,
       round(avg(mort_icu), 6) AS mort_icu, round(avg(mort_hosp), 6) AS mort_hosp
FROM cohort GROUP BY CUBE (admission_type, gender)""")
def q_cohort_crosstab(spark, sf):
    """Counts and mortality by admission type × gender with "All" margins."""
    d = statics(spark, sf)
    return rounded(S.crosstab_margins(d, "admission_type", "gender", {"mort_icu": "mort_icu", "mort_hosp": "mort_hosp"}))


@register("cohort_rates", SQL_STATICS + """
SELECT flag, n_flagged, round(n_flagged * 100.0 / n, 6) AS pct FROM (
  SELECT count(*) AS n, sum(mort_icu) AS mort_icu, sum(mort_hosp) AS mort_hosp, sum(readmission_30) AS readmission_30
  FROM cohort) UNPIVOT (n_flagged FOR flag IN (mort_icu, mort_hosp, readmission_30))""")
def q_cohort_rates(spark, sf):
    """Mortality and readmission rates of the cohort."""
    d = statics(spark, sf)
    return rounded(S.rate_report(d, ["mort_icu", "mort_hosp", "readmission_30"]))


_EXCL = {
    "exclusion_unit": f"first_careunit LIKE '{PARAMS.excluded_unit}'",
    "exclusion_not_first": "hospstay_seq != 1",
    "exclusion_age": f"age < {PARAMS.min_age}",
    "exclusion_short": f"los_icu < {PARAMS.min_day} OR outtime < intime + INTERVAL {PARAMS.min_dur} HOUR",
}


@register("exclusion_report", SQL_STATICS + """,
fl AS (SELECT """ + ", ".join(f"CASE WHEN {c} THEN 1 ELSE 0 END AS {k}" for k, c in _EXCL.items()) + """ FROM allst),
fl2 AS (SELECT *, greatest(""" + ", ".join(_EXCL) + """) AS exclusion_any FROM fl)
SELECT flag, n_flagged, round(n_flagged * 100.0 / n, 6) AS pct FROM (
  SELECT count(*) AS n, """ + ", ".join(f"sum({k}) AS {k}" for k in list(_EXCL) + ["exclusion_any"]) + """ FROM fl2)
UNPIVOT (n_flagged FOR flag IN (""" + ", ".join(list(_EXCL) + ["exclusion_any"]) + "))")
def q_exclusion_report(spark, sf):
    """Count and % of stays hit by each exclusion rule and by any of them."""
    d = statics(spark, sf, filtered=False)
    dur = diff_us("intime", "outtime")
    d = d.select(
        flag(F.col("first_careunit").like(PARAMS.excluded_unit)).alias("exclusion_unit"),
        flag(F.col("hospstay_seq") != 1).alias("exclusion_not_first"),
        flag(F.col("age") < PARAMS.min_age).alias("exclusion_age"),
        flag((F.col("los_icu") < PARAMS.min_day) | (dur < PARAMS.min_dur * 3_600_000_000)).alias("exclusion_short"))
    d = d.withColumn("exclusion_any", F.greatest(*[F.col(k) for k in _EXCL]))
    return rounded(S.rate_report(d, list(_EXCL) + ["exclusion_any"]))


@register("latest_stay", "WITH " + SQL_STAYS + """
SELECT st.subject_id, st.icustay_id, st.intime, st.outtime FROM st JOIN pt USING (subject_id)
WHERE st.intime = (SELECT max(e.intime) FROM st e WHERE e.subject_id = st.subject_id)
  AND st.outtime >= st.intime + INTERVAL 24 HOUR AND pt.age > 0""")
def q_latest_stay(spark, sf):
    """D21 (P12, P13): latest stay per patient (ties kept), ≥ 24 h, positive "age"."""
    s = stays(spark, sf).select("subject_id", "icustay_id", "intime", "outtime")
    s = latest_per(s, "subject_id", "intime")
    s = s.filter(diff_us("intime", "outtime") >= 24 * 3_600_000_000)
    p = patients(spark, sf).filter(F.col("age") > 0).select("subject_id")
    return s.join(p, "subject_id", "left_semi")


@register("ordered_codes", """
SELECT o.o_orderkey AS icustay_id, o.o_custkey AS subject_id, o.o_orderkey AS hadm_id,
       list(CAST(l.l_partkey AS VARCHAR) ORDER BY l.l_linenumber, l.l_partkey) AS icd9_codes
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
WHERE l.l_linenumber IS NOT NULL
GROUP BY o.o_orderkey, o.o_custkey""")
def q_ordered_codes(spark, sf):
    """D07 (J22, A05): per stay, the code list ordered by sequence number."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("subject_id"))
    d = li.join(o, "l_orderkey", "inner")
    d = d.withColumnRenamed("l_orderkey", "icustay_id").withColumn("hadm_id", F.col("icustay_id"))
    return ordered_codes(d, ["icustay_id", "subject_id", "hadm_id"], "l_partkey", "l_linenumber", ["l_partkey"])


@register("ttest_by_status", """
WITH d AS (SELECT c.c_mktsegment, o.o_orderstatus AS g, o.o_totalprice / 1000.0 AS v
           FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey WHERE o.o_orderstatus IN ('F', 'O')),
m AS (SELECT c_mktsegment, count(v) FILTER (WHERE g = 'F') AS n_a, avg(v) FILTER (WHERE g = 'F') AS mean_a,
             var_samp(v) FILTER (WHERE g = 'F') AS var_a, count(v) FILTER (WHERE g = 'O') AS n_b,
             avg(v) FILTER (WHERE g = 'O') AS mean_b, var_samp(v) FILTER (WHERE g = 'O') AS var_b
      FROM d GROUP BY c_mktsegment)
SELECT c_mktsegment, n_a, round(mean_a, 6) AS mean_a, round(var_a, 6) AS var_a, n_b, round(mean_b, 6) AS mean_b,
       round(var_b, 6) AS var_b,
       round((mean_a - mean_b) / sqrt(((n_a - 1) * var_a + (n_b - 1) * var_b) / (n_a + n_b - 2) * (1.0 / n_a + 1.0 / n_b)), 6) AS t,
       CAST(n_a + n_b - 2 AS DOUBLE) AS dof
FROM m""")
def q_ttest_by_status(spark, sf):
    """A27 (D24/D25): equal-variance t statistic of order value (thousands), status F vs O, per segment."""
    o = table(spark, sf, "orders").select("o_custkey", "o_orderstatus", (F.col("o_totalprice") / 1000.0).alias("o_totalprice"))
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    d = o.join(c, "o_custkey")
    return rounded(S.ttest_ind(d, "o_orderstatus", "o_totalprice", "F", "O", by=["c_mktsegment"]))


# Nation-name needles of this binding, in match order.
NATION_NEEDLES = ("NATION_2", "NATION_1", "_3", "_4")


@register("categories", """
SELECT c_custkey,
  CASE WHEN coalesce(contains(n_name, 'NATION_2'), false) THEN 'NATION_2'
       WHEN coalesce(contains(n_name, 'NATION_1'), false) THEN 'NATION_1'
       WHEN coalesce(contains(n_name, '_3'), false) THEN '_3'
       WHEN coalesce(contains(n_name, '_4'), false) THEN '_4' ELSE 'OTHER' END AS region_group,
  CASE WHEN c_acctbal / 100 > 10 AND c_acctbal / 100 <= 30 THEN '<31'
       WHEN c_acctbal / 100 > 30 AND c_acctbal / 100 <= 50 THEN '31-50'
       WHEN c_acctbal / 100 > 50 AND c_acctbal / 100 <= 70 THEN '51-70' ELSE '>70' END AS age_group,
  CASE WHEN c_acctbal / 100 > 0 AND c_acctbal / 100 < 45 THEN '0-45'
       WHEN c_acctbal / 100 > 45 AND c_acctbal / 100 < 65 THEN '45-65'
       WHEN c_acctbal / 100 > 65 AND c_acctbal / 100 < 90 THEN '65-90'
       WHEN c_acctbal / 100 > 90 AND c_acctbal / 100 < 500 THEN '90-500' END AS age_band,
  CAST(CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END AS INTEGER) AS is_building
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""")
def q_categories(spark, sf):
    """First-match categoriser, age buckets, strict age bands, 0/1 flag."""
    c = table(spark, sf, "customer")
    n = table(spark, sf, "nation")
    d = c.join(n, c.c_nationkey == n.n_nationkey, "left")
    a = F.col("c_acctbal") / 100
    return d.select("c_custkey", first_match("n_name", NATION_NEEDLES).alias("region_group"),
                    categorize_age(a).alias("age_group"), age_band_strict(a).alias("age_band"),
                    flag(F.col("c_mktsegment") == "BUILDING").alias("is_building"))


# How columns of the given tables stand for the recorded texts.
MARITAL_TEXTS = {0: "SINGLE", 1: "MARRIED", 2: "WIDOWED", 3: "DIVORCED", 4: "LIFE PARTNER", 5: "SEPARATED", 6: "UNKNOWN (DEFAULT)"}
INSURANCE_TEXTS = {"AUTOMOBILE": "Private", "BUILDING": "Medicare", "FURNITURE": "Self Pay", "HOUSEHOLD": "Medicaid",
                   "MACHINERY": "Government"}
LOCATION_TEXTS = {"1-URGENT": "EMERGENCY ROOM ADMIT", "2-HIGH": "CLINIC REFERRAL/PREMATURE",
                  "3-MEDIUM": "TRANSFER FROM HOSP/EXTRAM", "4-NOT SPECIFIED": None, "5-LOW": "TRSF WITHIN THIS FACILITY"}
DIAGNOSIS_TEXTS = {"F": "URINARY TRACT INFECTION;SEPSIS", "O": "CHEST PAIN", "P": None}


def _text_of(key, texts: dict):
    """The text that ``texts`` states for a value."""
    out = F.lit(None).cast("string")
    for value, text in texts.items():
        out = F.when(key == F.lit(value), F.lit(text).cast("string")).otherwise(out)
    return out


@register("admission_groups", """
SELECT o_orderkey,
  CASE WHEN c_nationkey % 7 IN (0, 2, 3, 5) THEN 'SINGLE/SEPARATED/DIVORCED/WIDOW'
       WHEN c_nationkey % 7 IN (1, 4) THEN 'MARRIED' ELSE 'OTHER' END AS marital_group,
  CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'PRIVATE' WHEN 'BUILDING' THEN 'MEDICARE/MEDICAID' WHEN 'FURNITURE' THEN 'SELF PAY'
       WHEN 'HOUSEHOLD' THEN 'MEDICARE/MEDICAID' WHEN 'MACHINERY' THEN 'GOVERNMENT' ELSE 'OTHER' END AS insurance_group,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'EMERGENCY' WHEN '2-HIGH' THEN 'REFERRAL' WHEN '3-MEDIUM' THEN 'TRANSFER'
       WHEN '5-LOW' THEN 'TRANSFER' ELSE 'OTHER' END AS location_group,
  CASE o_orderstatus WHEN 'F' THEN 'SEPSIS' ELSE 'OTHER' END AS diagnosis_group
FROM orders LEFT JOIN customer ON o_custkey = c_custkey""")
def q_admission_groups(spark, sf):
    """marital status, insurance, admission location and diagnosis of each admission, grouped."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus")
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_mktsegment")
    d = o.join(c, "o_custkey", "left")
    return d.select("o_orderkey",
                    by_rules(_text_of(F.col("c_nationkey") % 7, MARITAL_TEXTS), MARITAL_RULES).alias("marital_group"),
                    by_rules(_text_of(F.col("c_mktsegment"), INSURANCE_TEXTS), INSURANCE_RULES).alias("insurance_group"),
                    by_rules(_text_of(F.col("o_orderpriority"), LOCATION_TEXTS), ADMISSION_LOCATION_RULES).alias("location_group"),
                    by_rules(_text_of(F.col("o_orderstatus"), DIAGNOSIS_TEXTS), DIAGNOSIS_RULES).alias("diagnosis_group"))


@register("died_within", "WITH " + SQL_STAYS + f"""
SELECT icustay_id, CAST(CASE WHEN deathtime < intime + INTERVAL {DIED_WITHIN_SECONDS} SECOND THEN 1 ELSE 0 END AS INTEGER) AS died_within
FROM st""")
def q_died_within(spark, sf):
    """Relabel "died within X seconds of the observation start"."""
    s = stays(spark, sf)
    return s.select("icustay_id", flag(F.col("deathtime") < add_seconds("intime", DIED_WITHIN_SECONDS)).alias("died_within"))


@register("existence_flags", """
WITH ex AS (SELECT l_orderkey, max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS has_return,
                   max(CASE WHEN l_discount > 0.08 THEN 1 ELSE 0 END) AS has_big_discount
            FROM lineitem GROUP BY l_orderkey),
lt AS (SELECT l_orderkey, l_quantity AS last_qty, l_shipdate AS last_ship
       FROM (SELECT l_orderkey, l_quantity, l_shipdate,
                    row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_quantity DESC) AS rn
             FROM lineitem) WHERE rn = 1)
SELECT o.o_orderkey AS hadm_id, CAST(coalesce(ex.has_return, 0) AS INTEGER) AS has_return,
       CAST(coalesce(ex.has_big_discount, 0) AS INTEGER) AS has_big_discount, lt.last_ship,
       round(lt.last_qty, 6) AS last_qty,
       round(CASE WHEN lt.last_qty > 0 THEN (o.o_totalprice / 1000.0) / ((lt.last_qty / 100) * (lt.last_qty / 100)) END, 6) AS ratio
FROM orders o LEFT JOIN ex ON ex.l_orderkey = o.o_orderkey LEFT JOIN lt ON lt.l_orderkey = o.o_orderkey""")
def q_existence_flags(spark, sf):
    """D16 (P11 existence flags, J09 latest row, F12 BMI-style ratio)."""
    from stayline.operators.features import latest_row
    li = table(spark, sf, "lineitem")
    ex = li.groupBy("l_orderkey").agg(
        F.max(flag(F.col("l_returnflag") == "R")).alias("has_return"),
        F.max(flag(F.col("l_discount") > 0.08)).alias("has_big_discount"))
    lt = latest_row(li, ["l_orderkey"], "l_shipdate", ["l_quantity"], ["l_quantity"])
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    d = o.join(ex, o.o_orderkey == ex.l_orderkey, "left").drop("l_orderkey")
    d = d.join(lt, d.o_orderkey == lt.l_orderkey, "left")
    q = F.col("l_quantity")
    return rounded(d.select(F.col("o_orderkey").alias("hadm_id"),
                            F.coalesce("has_return", F.lit(0)).cast("int").alias("has_return"),
                            F.coalesce("has_big_discount", F.lit(0)).cast("int").alias("has_big_discount"),
                            F.col("l_shipdate").alias("last_ship"), q.alias("last_qty"),
                            F.when(q > 0, (F.col("o_totalprice") / 1000.0) / ((q / 100) * (q / 100))).alias("ratio")))


@register("sepsis_cohort", """
WITH first_order AS (SELECT o_custkey, min(o_orderdate) AS dob FROM orders GROUP BY o_custkey)
SELECT DISTINCT c.c_custkey AS subject_id, o.o_orderkey AS hadm_id,
       CAST(CASE WHEN o.o_orderstatus = 'F' THEN 1 ELSE 0 END AS INTEGER) AS hospital_expire_flag,
       CAST(year(o.o_orderdate) - year(f.dob)
            - CASE WHEN month(o.o_orderdate) < month(f.dob)
                     OR (month(o.o_orderdate) = month(f.dob) AND day(o.o_orderdate) < day(f.dob)) THEN 1 ELSE 0 END
            AS INTEGER) AS age
FROM customer c JOIN orders o ON o.o_custkey = c.c_custkey JOIN first_order f ON f.o_custkey = c.c_custkey
JOIN lineitem l ON l.l_orderkey = o.o_orderkey JOIN part p ON p.p_partkey = l.l_partkey
  AND p.p_brand IN ('Brand#13', 'Brand#22', 'Brand#7')
WHERE year(o.o_orderdate) - year(f.dob)
      - CASE WHEN month(o.o_orderdate) < month(f.dob)
               OR (month(o.o_orderdate) = month(f.dob) AND day(o.o_orderdate) < day(f.dob)) THEN 1 ELSE 0 END > 1""")
def q_sepsis_cohort(spark, sf):
    """J24 (F08): patients ⋈ admissions ⋈ coded diagnoses in a code set, calendar age > 1, DISTINCT."""
    o = table(spark, sf, "orders")
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"))
    fo = o.groupBy("o_custkey").agg(F.min("o_orderdate").alias("dob"))
    p = table(spark, sf, "part").filter(F.col("p_brand").isin("Brand#13", "Brand#22", "Brand#7")) \
        .select(F.col("p_partkey").alias("l_partkey"))
    li = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey")
    dx = li.join(p, "l_partkey", "left_semi").select("o_orderkey").distinct()
    d = o.join(c, "o_custkey").join(fo, "o_custkey").join(dx, "o_orderkey", "left_semi")
    d = d.withColumn("age", calendar_age("dob", "o_orderdate")).filter(F.col("age") > 1)
    return d.select(F.col("o_custkey").alias("subject_id"), F.col("o_orderkey").alias("hadm_id"),
                    flag(F.col("o_orderstatus") == "F").alias("hospital_expire_flag"), "age").distinct()


# A data-package style spec for the conformed orders table.
ORDERS_SPEC = {
    "fields": [
        {"name": "o_orderkey", "type": "integer", "constraints": {"required": True}},
        {"name": "o_custkey", "type": "integer"},
        {"name": "o_orderdate", "type": "datetime"},
        {"name": "o_totalprice", "type": "number"},
        {"name": "n_returns", "type": "integer"},
        {"name": "o_orderpriority", "type": "string"},
    ],
    "primaryKey": ["o_orderkey"],
}


@register("conformed_orders", """
SELECT o_orderkey, o_custkey, o_orderdate, round(o_totalprice, 6) AS o_totalprice, CAST(0 AS BIGINT) AS n_returns,
       o_orderpriority FROM orders""")
def q_conformed_orders(spark, sf):
    """Conform a table to a JSON schema spec (missing numeric fields → 0, cast, key order)."""
    o = table(spark, sf, "orders")
    return rounded(conform(o, schema_from_spec(ORDERS_SPEC), ORDERS_SPEC.get("primaryKey")))


# The template parameters bound into the cohort SQL.
TEMPLATE_PARAMS = {"min_age": 0.0, "unit": "AUTOMOBILE", "stay_table": "orders"}
COHORT_SQL = """
SELECT o.o_custkey AS subject_id, o.o_orderkey AS icustay_id, o.o_orderdate AS intime, c.c_acctbal AS age
FROM IDENTIFIER(:stay_table) o JOIN customer c ON c.c_custkey = o.o_custkey
WHERE c.c_mktsegment NOT LIKE :unit AND c.c_acctbal >= :min_age
"""


@register("templated_cohort", f"""
SELECT o.o_custkey AS subject_id, o.o_orderkey AS icustay_id, o.o_orderdate AS intime, round(c.c_acctbal, 6) AS age
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
WHERE c.c_mktsegment NOT LIKE '{TEMPLATE_PARAMS['unit']}' AND c.c_acctbal >= {TEMPLATE_PARAMS['min_age']}""")
def q_templated_cohort(spark, sf):
    """SQL text with bound named parameters over registered tables."""
    from stayline.sources.querier import run_sql
    tables = {"orders": table(spark, sf, "orders"), "customer": table(spark, sf, "customer")}
    return rounded(run_sql(spark, COHORT_SQL, params=TEMPLATE_PARAMS, tables=tables))


COHORT_LIMIT = 100


@register("cohort_first_n", SQL_STATICS + f"""
SELECT subject_id, icustay_id, intime, readmission_30 FROM cohort ORDER BY subject_id, icustay_id LIMIT {COHORT_LIMIT}""")
def q_cohort_first_n(spark, sf):
    """The ``ORDER BY subject_id LIMIT n`` sample cohort (a top-k; keys added for determinism)."""
    from stayline.operators.cohort import first_rows
    d = statics(spark, sf).select("subject_id", "icustay_id", "intime", "readmission_30")
    return first_rows(d, ["subject_id", "icustay_id"], COHORT_LIMIT)


@register("censor_hours", "WITH " + SQL_STAYS + """,
cz AS (SELECT l_orderkey AS icustay_id, min(l_shipdate) FILTER (WHERE l_linestatus = 'O') AS censortime,
              sum(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) AS n_censor FROM lineitem GROUP BY l_orderkey)
SELECT st2.icustay_id, CAST(CASE WHEN st2.o_orderstatus = 'F' THEN 1 ELSE 0 END AS INTEGER) AS hospital_expire_flag,
  CAST(ceil(date_diff('microsecond', intime, dischtime) / 3600000000.0) AS BIGINT) AS dischtime_hours,
  CAST(ceil(date_diff('microsecond', intime, deathtime) / 3600000000.0) AS BIGINT) AS deathtime_hours,
  CAST(ceil(date_diff('microsecond', intime, censortime) / 3600000000.0) AS BIGINT) AS censortime_hours,
  CAST(CASE WHEN n_censor > 0 THEN 1 ELSE 0 END AS INTEGER) AS censored
FROM st2 LEFT JOIN cz USING (icustay_id)""")
def q_censor_hours(spark, sf):
    """Mortality label; discharge, death and earliest
    censor times as ceil hours after entry; censor flag from a count > 0."""
    from stayline.functions.timefns import ceil_hours
    s = stays(spark, sf)
    li = table(spark, sf, "lineitem")
    o = F.col("l_linestatus") == "O"
    cz = li.groupBy(F.col("l_orderkey").alias("icustay_id")).agg(
        F.min(F.when(o, F.col("l_shipdate"))).alias("censortime"), F.sum(flag(o)).alias("n_censor"))
    d = s.join(cz, "icustay_id", "left")
    return d.select("icustay_id", flag(F.col("o_orderstatus") == "F").alias("hospital_expire_flag"),
                    ceil_hours("intime", "dischtime").alias("dischtime_hours"),
                    ceil_hours("intime", "deathtime").alias("deathtime_hours"),
                    ceil_hours("intime", "censortime").alias("censortime_hours"),
                    flag(F.col("n_censor") > 0).alias("censored"))


@register("ttest_by_band", """
WITH d AS (SELECT CASE WHEN c_acctbal / 100 > 0 AND c_acctbal / 100 < 45 THEN '0-45'
                       WHEN c_acctbal / 100 > 45 AND c_acctbal / 100 < 65 THEN '45-65'
                       WHEN c_acctbal / 100 > 65 AND c_acctbal / 100 < 90 THEN '65-90'
                       WHEN c_acctbal / 100 > 90 AND c_acctbal / 100 < 500 THEN '90-500' END AS band,
                  o.o_orderstatus AS g, o.o_totalprice / 1000.0 AS v
           FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey WHERE o.o_orderstatus IN ('F', 'O')),
m AS (SELECT band, count(v) FILTER (WHERE g = 'F') AS n_a, avg(v) FILTER (WHERE g = 'F') AS mean_a,
             var_samp(v) FILTER (WHERE g = 'F') AS var_a, count(v) FILTER (WHERE g = 'O') AS n_b,
             avg(v) FILTER (WHERE g = 'O') AS mean_b, var_samp(v) FILTER (WHERE g = 'O') AS var_b
      FROM d GROUP BY band)
SELECT band, n_a, round(mean_a, 6) AS mean_a, round(var_a, 6) AS var_a, n_b, round(mean_b, 6) AS mean_b,
       round(var_b, 6) AS var_b,
       round((mean_a - mean_b) / sqrt(((n_a - 1) * var_a + (n_b - 1) * var_b) / (n_a + n_b - 2) * (1.0 / n_a + 1.0 / n_b)), 6) AS t,
       CAST(n_a + n_b - 2 AS DOUBLE) AS dof
FROM m""")
def q_ttest_by_band(spark, sf):
    """D25 (F23, A27): the same comparison inside strict "age" bands (boundary values in no band)."""
    o = table(spark, sf, "orders").select("o_custkey", "o_orderstatus", (F.col("o_totalprice") / 1000.0).alias("v"))
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"),
                                            age_band_strict(F.col("c_acctbal") / 100).alias("band"))
    return rounded(S.ttest_ind(o.join(c, "o_custkey"), "o_orderstatus", "v", "F", "O", by=["band"]))
