"""Operators bound to ``events``: a user is a stay, an event
type is a variable, ``value`` is the measurement.

Stay window: ``intime = min(ts) + 3 h`` (so the first hours of events lie
before entry and are clamped into hour 0, exercising the look-back rule) and
``outtime = max(ts)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stayline.functions.ranges import cleaning_report
from stayline.functions.timefns import add_hours, floor_hours
from stayline.operators import hourly as H
from stayline.operators.asof import asof_backward, value_at_hour
from stayline.operators.dims import local_dim
from stayline.operators.features import label_features
from stayline.operators.impute import global_means_from_long, simple_impute
from stayline.operators.interval_join import events_in_windows
from stayline.operators.intervals import bolus_intervals, hourly_indicators_from, interval_spans, next_start_end
from stayline.operators.sessions import flag_any, gap_sessions
from stayline.operators import stats as S
from stayline.operators.windows import binary_labels, rolling_lookback, to_sequence, transition_labels
from stayline.plans.registry import ORACLE, register, rounded  # noqa: F401
from stayline.sources.tables import table

STAY = "user_id"
ID = [STAY]
LOOKBACK_SHIFT_HOURS = 3
# The variable set of the binding (the item → variable map).
VARIABLES = ["click", "error", "purchase", "signup", "view"]
# Range table for the event variables
# (variable, OUTLIER_LOW, VALID_LOW, IMPUTE, VALID_HIGH, OUTLIER_HIGH); signup has none.
RANGES = [
    ("click", 0.5, 1.0, 10.0, 300.0, 450.0),
    ("error", 1.0, 3.0, 15.0, 250.0, 470.0),
    ("purchase", 0.1, 2.0, 20.0, 400.0, 480.0),
    ("view", 0.0, 0.5, 5.0, 200.0, 400.0),
]
RANGE_SCHEMA = "VARIABLE string, OUTLIER_LOW double, VALID_LOW double, IMPUTE double, VALID_HIGH double, OUTLIER_HIGH double"
SESSION_TYPES = ("purchase", "click")
INTERVAL_TYPES = ("purchase", "error", "signup")
BOLUS_TYPE = "view"


# ---------------------------------------------------------------- builders
def events(spark, sf):
    return table(spark, sf, "events")


def stays(ev: DataFrame) -> DataFrame:
    s = ev.groupBy(STAY).agg(F.min("ts").alias("__first"), F.max("ts").alias("outtime"))
    s = s.select(STAY, add_hours("__first", LOOKBACK_SHIFT_HOURS).alias("intime"), "outtime")
    return H.with_max_hours(s)


_DIMS: dict = {}


def ranges_df(spark) -> DataFrame:
    key = (spark.sparkContext.applicationId, id(spark), "ranges")
    if key not in _DIMS:
        _DIMS[key] = local_dim(spark, RANGES, RANGE_SCHEMA)
    return _DIMS[key]


def var_map(spark) -> DataFrame:
    key = (spark.sparkContext.applicationId, id(spark), "var_map")
    if key not in _DIMS:
        _DIMS[key] = local_dim(spark, [(v, v, v) for v in VARIABLES], "ITEMID string, LEVEL1 string, LEVEL2 string")
    return _DIMS[key]


def measurements(spark, sf, clean: bool = True) -> tuple[DataFrame, DataFrame]:
    ev = events(spark, sf)
    s = stays(ev)
    X = ev.select(STAY, F.col("ts").alias("charttime"), F.col("event_type").alias("itemid"), "value",
                  F.lit(None).cast("string").alias("valueuom"))
    M = H.prepare_measurements(X, s, var_map(spark), None, ranges_df(spark) if clean else None,
                               apply_var_limit=clean, id_cols=ID, stay_key=STAY)
    return M, s


def long_stats(spark, sf) -> DataFrame:
    M, _ = measurements(spark, sf)
    return H.hourly_long(M, True, ID)


def wide_grid(spark, sf) -> tuple[DataFrame, DataFrame]:
    M, s = measurements(spark, sf)
    return H.hourly_wide(M, s, VARIABLES, True, ID), s


def long_and_wide(spark, sf) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The long table and the wide grid built from that same DataFrame, so a
    plan using both shares (reuses) the long aggregation's shuffle."""
    M, s = measurements(spark, sf)
    long = H.hourly_long(M, True, ID)
    return long, H.long_to_wide(long, s, VARIABLES, ID), s


def indicator_grid(spark, sf) -> DataFrame:
    """All interventions placed in one pass: the typed intervals and the
    boluses are unioned first, so the stays are joined once."""
    ev = events(spark, sf)
    s = stays(ev)
    nx = next_start_end(ev.select(STAY, "event_id", "event_type", "ts"), [STAY], "ts",
                        tiebreak=["event_id"], name="endtime").withColumnRenamed("ts", "starttime")
    iv = nx.filter(F.col("event_type").isin(*INTERVAL_TYPES)).select(
        STAY, "starttime", "endtime", F.concat(F.col("event_type"), F.lit("_on")).alias("name"))
    bol = bolus_intervals(ev.filter(F.col("event_type") == BOLUS_TYPE).select(STAY, "ts"), "ts").select(
        STAY, "starttime", "endtime", F.lit(f"{BOLUS_TYPE}_bolus").alias("name"))
    spans = interval_spans(iv.unionByName(bol), s, STAY, None, name_col="name")
    names = [f"{t}_on" for t in INTERVAL_TYPES] + [f"{BOLUS_TYPE}_bolus"]
    return hourly_indicators_from(s, STAY, spans, names)


# ---------------------------------------------------------------- oracle SQL
def _values(rows) -> str:
    return ", ".join("(" + ", ".join(f"'{x}'" if isinstance(x, str) else repr(float(x)) for x in r) + ")" for r in rows)


FLOOR_H = "CAST(floor(date_diff('microsecond', {a}, {b}) / 3600000000.0) AS BIGINT)"
SQL_STAYS = f"""
s AS (
  SELECT user_id, intime, outtime, {FLOOR_H.format(a='intime', b='outtime')} AS max_hours
  FROM (SELECT user_id, min(ts) + INTERVAL {LOOKBACK_SHIFT_HOURS} HOUR AS intime, max(ts) AS outtime
        FROM events GROUP BY user_id)
),
grid AS (SELECT user_id, CAST(unnest(generate_series(0, max_hours)) AS BIGINT) AS hours_in FROM s WHERE max_hours >= 0)"""
SQL_X = f"""
x AS (
  SELECT e.user_id, e.event_id, e.event_type AS variable, e.ts,
         greatest(0, {FLOOR_H.format(a='s.intime', b='e.ts')}) AS hours_in, s.max_hours,
         CASE WHEN isnan(e.value) THEN NULL ELSE e.value END AS v
  FROM events e JOIN s USING (user_id)
),
xr AS (
  SELECT x.*, r.variable AS rvar, r.ol, r.vl, r.vh, r.oh
  FROM x LEFT JOIN (SELECT * FROM (VALUES {_values(RANGES)}) t(variable, ol, vl, imp, vh, oh)) r
    ON lower(x.variable) = r.variable
  WHERE x.hours_in <= x.max_hours
),
c AS (
  SELECT user_id, event_id, variable, ts, hours_in,
    CASE WHEN v IS NULL OR rvar IS NULL THEN v
         WHEN v > vh AND NOT coalesce(v > oh, false) THEN vh
         WHEN v < vl AND NOT coalesce(v < ol, false) THEN vl
         WHEN v < ol OR v > oh THEN NULL
         ELSE v END AS value
  FROM xr
)"""


def _with(*parts) -> str:
    return "WITH " + ",".join(parts)


SQL_LONG = _with(SQL_STAYS, SQL_X, """
hl AS (SELECT user_id, variable, hours_in, avg(value) AS mean, stddev_samp(value) AS std, count(value) AS count
       FROM c GROUP BY user_id, variable, hours_in)""")


def _wide_sql() -> str:
    cols = []
    for v in VARIABLES:
        cols += [f"avg(c.value) FILTER (WHERE c.variable = '{v}') AS {v}_mean",
                 f"stddev_samp(c.value) FILTER (WHERE c.variable = '{v}') AS {v}_std",
                 f"count(c.value) FILTER (WHERE c.variable = '{v}') AS {v}_count"]
    return _with(SQL_STAYS, SQL_X, f"""
w AS (SELECT g.user_id, g.hours_in, {', '.join(cols)}
      FROM grid g LEFT JOIN c ON c.user_id = g.user_id AND c.hours_in = g.hours_in
      GROUP BY g.user_id, g.hours_in)""")


SQL_WIDE = _wide_sql()


def _rnd(cols):
    return ", ".join(f"round({c}, 6) AS {c}" for c in cols)


# ---------------------------------------------------------------- queries
@register("hourly_stats", SQL_LONG + """
SELECT user_id, variable, hours_in, round(mean, 6) AS mean, round(std, 6) AS std, count FROM hl""")
def q_hourly_stats(spark: SparkSession, sf: str) -> DataFrame:
    """A01 (+F01, F02, D06): mean / std / count per (stay, variable, hour)."""
    return rounded(long_stats(spark, sf))


_WIDE_COLS = [f"{v}_{a}" for v in VARIABLES for a in ("mean", "std")]


@register("hourly_grid", SQL_WIDE + f"""
SELECT user_id, hours_in, {_rnd(_WIDE_COLS)}, {', '.join(f'{v}_count' for v in VARIABLES)} FROM w""")
def q_hourly_grid(spark, sf):
    """Dense stay-by-hour grid, three columns per variable, counts 0-filled."""
    w, _ = wide_grid(spark, sf)
    return rounded(w)


@register("hourly_means", SQL_WIDE + f"""
SELECT user_id, hours_in, {_rnd([f'{v}_mean' for v in VARIABLES])} FROM w""")
def q_hourly_means(spark, sf):
    """The mean-only view of the grid."""
    w, _ = wide_grid(spark, sf)
    return rounded(H.mean_only(w))


@register("cleaning_report", _with(SQL_STAYS, SQL_X) + """
SELECT variable,
       count(*) FILTER (WHERE v < ol OR v > oh) AS n_outlier,
       count(*) FILTER (WHERE NOT coalesce(v < ol, false) AND v < vl) AS n_valid_low,
       count(*) FILTER (WHERE NOT coalesce(v > oh, false) AND v > vh) AS n_valid_high,
       count(*) AS n_rows,
       count(*) FILTER (WHERE v < ol OR v > oh) + count(*) FILTER (WHERE NOT coalesce(v < ol, false) AND v < vl)
         + count(*) FILTER (WHERE NOT coalesce(v > oh, false) AND v > vh) AS n_cleaned
FROM xr WHERE v IS NOT NULL AND rvar IS NOT NULL GROUP BY variable""")
def q_cleaning_report(spark, sf):
    """Per variable, rows set to NULL / clipped low / clipped high."""
    M, _ = measurements(spark, sf, clean=False)
    return cleaning_report(M, ranges_df(spark), "LEVEL2", "value")


SPARSE_MIN_PERCENT = 50


@register("sparse_variables", SQL_LONG + f""",
n AS (SELECT count(*) AS n_rows FROM grid)
SELECT hl2.variable, n.n_rows, n.n_rows - hl2.n_mean AS n_null,
       CAST(round_even((1 - {SPARSE_MIN_PERCENT}/100.0) * n.n_rows, 0) AS BIGINT) AS threshold,
       (n.n_rows - hl2.n_mean) <= round_even((1 - {SPARSE_MIN_PERCENT}/100.0) * n.n_rows, 0) AS keep
FROM (SELECT variable, count(mean) AS n_mean FROM hl GROUP BY variable) hl2, n""")
def q_sparse_variables(spark, sf):
    """NULL-mean cells per variable on the grid and the keep/drop decision."""
    M, s = measurements(spark, sf)
    return H.sparse_variable_stats(H.hourly_long(M, True, ID), H.hour_grid(s, ID), SPARSE_MIN_PERCENT)


@register("gap_sessions", """
WITH therapy AS (SELECT DISTINCT user_id, ts FROM events WHERE event_type IN ('purchase', 'click')),
opened AS (  -- time points without another one in the 8 hours before them
  SELECT t.user_id, t.ts, NOT EXISTS (
    SELECT 1 FROM therapy p WHERE p.user_id = t.user_id AND p.ts < t.ts AND t.ts <= p.ts + INTERVAL 8 HOUR) AS opens
  FROM therapy t),
spans AS (
  SELECT o.user_id, o.starttime, max(t.ts) AS endtime, count(*) AS n_points
  FROM (SELECT user_id, ts AS starttime, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS following
        FROM opened WHERE opens) o
  JOIN therapy t ON t.user_id = o.user_id AND t.ts >= o.starttime AND (o.following IS NULL OR t.ts < o.following)
  GROUP BY o.user_id, o.starttime)
SELECT user_id, CAST(rank() OVER (PARTITION BY user_id ORDER BY starttime) AS INTEGER) AS session_no, starttime, endtime,
       round(date_diff('microsecond', starttime, endtime) / 3600000000.0, 6) AS duration_hours, n_points
FROM spans WHERE endtime > starttime""")
def q_gap_sessions(spark, sf):
    """D09 (A31, W03, W04, A06, W05, F04): a therapy flag per time point
    (MAX over its rows), then sessions of flagged points split by gaps > 8 h."""
    ev = events(spark, sf)
    pts = flag_any(ev, [STAY, "ts"], {"session": F.col("event_type").isin(*SESSION_TYPES)})
    return rounded(gap_sessions(pts, STAY, "ts", "flag", 8.0))


_IND = [f"{t}_on" for t in INTERVAL_TYPES] + [f"{BOLUS_TYPE}_bolus"]
SQL_IND = _with(SQL_STAYS, f"""
nx AS (SELECT user_id, event_type, ts AS starttime,
              coalesce(lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id), ts) AS endtime FROM events),
iv AS (SELECT user_id, event_type || '_on' AS name, starttime, endtime FROM nx
       WHERE event_type IN ({', '.join(f"'{t}'" for t in INTERVAL_TYPES)})
       UNION ALL
       SELECT user_id, event_type || '_bolus', ts, ts FROM events WHERE event_type = '{BOLUS_TYPE}'),
hrs AS (SELECT user_id, name, CAST(unnest(generate_series(sh, eh)) AS BIGINT) AS hours_in
        FROM (SELECT iv.user_id, name, {FLOOR_H.format(a='s.intime', b='starttime')} AS sh,
                     {FLOOR_H.format(a='s.intime', b='endtime')} AS eh
              FROM iv JOIN s USING (user_id)
              WHERE starttime BETWEEN s.intime AND s.outtime AND endtime BETWEEN s.intime AND s.outtime)
        WHERE eh >= sh),
ind AS (SELECT g.user_id, g.hours_in,
        {', '.join(f"CAST(coalesce(max(CASE WHEN h.name = '{n}' THEN 1 END), 0) AS INTEGER) AS {n}" for n in _IND)}
        FROM grid g LEFT JOIN hrs h ON h.user_id = g.user_id AND h.hours_in = g.hours_in
        GROUP BY g.user_id, g.hours_in)""")


@register("hourly_interventions", SQL_IND + "\nSELECT * FROM ind")
def q_hourly_interventions(spark, sf):
    """D04 (X02, X03, U07, J10, J21, W06, P19): hourly 0/1 intervention flags."""
    return indicator_grid(spark, sf)


@register("transition_labels", SQL_IND + """,
cut AS (SELECT user_id, hours_in, purchase_on, count(*) OVER (PARTITION BY user_id) AS len FROM ind),
lw AS (SELECT user_id, hours_in, len,
        """ + ", ".join(f"lead(purchase_on, {k}) OVER (PARTITION BY user_id ORDER BY hours_in) AS y{k}"
                         for k in range(6, 16)) + """
       FROM cut),
lc AS (SELECT user_id, hours_in,
         (""" + " OR ".join(f"coalesce(y{k} != y{k + 1}, false)" for k in range(6, 11)) + """) AS gchange,
         (""" + " OR ".join(f"coalesce(y{k} = 0 AND y{k + 1} = 1, false)" for k in range(12, 15)) + """) AS rise,
         (""" + " OR ".join(f"coalesce(y{k} = 1 AND y{k + 1} = 0, false)" for k in range(12, 15)) + """) AS fall,
         y13 IS NOT NULL AS some_diff,
         greatest(""" + ", ".join(f"coalesce(y{k}, -1)" for k in range(12, 16)) + """) AS pmax
       FROM lw WHERE hours_in < len - 16)
SELECT user_id, hours_in AS start_hour, label FROM (
  SELECT user_id, hours_in, CAST(CASE WHEN gchange THEN NULL
       WHEN some_diff AND NOT rise AND NOT fall AND pmax = 0 THEN 1
       WHEN some_diff AND NOT rise AND NOT fall AND pmax = 1 THEN 2
       WHEN rise THEN 0 WHEN fall THEN 3 END AS INTEGER) AS label FROM lc) WHERE label IS NOT NULL""")
def q_transition_labels(spark, sf):
    """ONSET/CONTROL/ON/WEAN samples (6 h window, 6 h gap, 4 h horizon)."""
    return transition_labels(indicator_grid(spark, sf), STAY, "purchase_on", keep_window=False)


@register("binary_labels", SQL_IND + """,
cut AS (SELECT user_id, hours_in, purchase_on, count(*) OVER (PARTITION BY user_id) AS len FROM ind),
lw AS (SELECT user_id, hours_in, len,
        max(purchase_on) OVER (PARTITION BY user_id ORDER BY hours_in ROWS BETWEEN 6 FOLLOWING AND 11 FOLLOWING) AS gmax,
        max(purchase_on) OVER (PARTITION BY user_id ORDER BY hours_in ROWS BETWEEN 12 FOLLOWING AND 15 FOLLOWING) AS pmax
       FROM cut)
SELECT user_id, hours_in AS start_hour, pmax AS label FROM lw
WHERE hours_in < len - 16 AND gmax != 1 AND pmax IS NOT NULL""")
def q_binary_labels(spark, sf):
    """W10 binary variant: drop if the gap holds the intervention, label = horizon max."""
    return binary_labels(indicator_grid(spark, sf), STAY, "purchase_on")


@register("asof_latest", """
WITH p AS (SELECT event_id, user_id, ts, value FROM events WHERE event_type = 'purchase'),
c AS (SELECT p.event_id, r.ts AS click_ts, r.value AS click_value,
             row_number() OVER (PARTITION BY p.event_id ORDER BY r.ts DESC, r.value DESC) AS rn
      FROM p JOIN events r ON r.user_id = p.user_id AND r.event_type = 'click'
       AND r.ts BETWEEN p.ts - INTERVAL 2 HOUR AND p.ts),
v AS (SELECT p.event_id, r.ts AS view_ts, r.value AS view_value,
             row_number() OVER (PARTITION BY p.event_id ORDER BY r.ts DESC, r.value DESC) AS rn
      FROM p JOIN events r ON r.user_id = p.user_id AND r.event_type = 'view'
       AND r.ts BETWEEN p.ts - INTERVAL 4 HOUR AND p.ts)
SELECT p.event_id, p.user_id, p.ts, round(p.value, 6) AS value, c.click_ts, round(c.click_value, 6) AS click_value,
       v.view_ts, round(v.view_value, 6) AS view_value
FROM p LEFT JOIN (SELECT * FROM c WHERE rn = 1) c USING (event_id)
       LEFT JOIN (SELECT * FROM v WHERE rn = 1) v USING (event_id)""")
def q_asof_latest(spark, sf):
    """Latest click within 2 h and latest view within 4 h before each purchase."""
    ev = events(spark, sf)
    p = ev.filter(F.col("event_type") == "purchase").select("event_id", STAY, "ts", "value")
    c = ev.filter(F.col("event_type") == "click").select(STAY, "ts", "value")
    v = ev.filter(F.col("event_type") == "view").select(STAY, "ts", "value")
    out = asof_backward(p, c, [STAY], "ts", "ts", 2 * 3600, ["value"], "click_", tiebreak=["value"])
    out = asof_backward(out, v, [STAY], "ts", "ts", 4 * 3600, ["value"], "view_", tiebreak=["value"])
    return rounded(out)


FEATURE_LOOKBACK_H, FEATURE_DURATION_H = 6, 24
_FEAT_STATS = ("first", "last", "min", "max", "avg")


def _feature_sql() -> str:
    cols = []
    for v in VARIABLES:
        f = f"FILTER (WHERE e.event_type = '{v}' AND e.value IS NOT NULL)"
        cols += [f"round(first(e.value ORDER BY e.ts, e.value) {f}, 6) AS {v}_first",
                 f"round(first(e.value ORDER BY e.ts DESC, e.value DESC) {f}, 6) AS {v}_last",
                 f"round(min(e.value) {f}, 6) AS {v}_min", f"round(max(e.value) {f}, 6) AS {v}_max",
                 f"round(avg(e.value) {f}, 6) AS {v}_avg"]
    return _with(SQL_STAYS) + f"""
SELECT s.user_id, {', '.join(cols)}
FROM s LEFT JOIN events e ON e.user_id = s.user_id
 AND e.ts BETWEEN s.intime - INTERVAL {FEATURE_LOOKBACK_H} HOUR AND s.intime + INTERVAL {FEATURE_DURATION_H} HOUR
GROUP BY s.user_id"""


@register("first_last_features", _feature_sql())
def q_first_last_features(spark, sf):
    """W01, A02, A04, J05 (D17-D19): first/last/min/max/avg per variable in the
    window intime - 6 h .. intime + 24 h."""
    ev = events(spark, sf)
    s = stays(ev).select(STAY, "intime")
    w = s.select(STAY, add_hours("intime", -FEATURE_LOOKBACK_H).alias("from"),
                 add_hours("intime", FEATURE_DURATION_H).alias("to"))
    d = events_in_windows(ev.select(STAY, "event_id", "event_type", "ts", "value"), w, STAY, "ts", "from", "to")
    found = label_features(d, [STAY], "event_type", VARIABLES, "value", "ts", _FEAT_STATS)
    return rounded(s.select(STAY).join(found, STAY, "left"))  # stays without a value in the window are kept


def _impute_sql() -> str:
    cols = []
    for v in VARIABLES:
        w = "OVER (PARTITION BY user_id ORDER BY hours_in ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
        cols += [f"round(coalesce(last_value({v}_mean IGNORE NULLS) {w}, avg({v}_mean) OVER (PARTITION BY user_id),"
                 f" (SELECT avg({v}_mean) FROM w)), 6) AS {v}_mean",
                 f"CAST(CASE WHEN {v}_count > 0 THEN 1 ELSE 0 END AS DOUBLE) AS {v}_mask",
                 f"coalesce(CAST(hours_in - last_value(CASE WHEN {v}_count > 0 THEN hours_in END IGNORE NULLS) {w}"
                 f" AS DOUBLE), 100.0) AS {v}_time_since_measured"]
    return SQL_WIDE + f"\nSELECT user_id, hours_in, {', '.join(cols)} FROM w"


@register("impute_grid", _impute_sql())
def q_impute_grid(spark, sf):
    """M06 (W08, A22, F28, W09): forward fill → stay mean → global mean, mask, time since measured."""
    long, w, _ = long_and_wide(spark, sf)
    gm = global_means_from_long(long, VARIABLES, ID)
    return rounded(simple_impute(w, ID, VARIABLES, global_means=gm))


@register("rolling_lookback", SQL_WIDE + """
SELECT user_id, hours_in, round(click_mean, 6) AS click_mean,
  round(last_value(click_mean IGNORE NULLS) OVER r, 6) AS click_mean_last,
  round(min(click_mean) OVER r, 6) AS click_mean_min, round(max(click_mean) OVER r, 6) AS click_mean_max,
  round(coalesce(sum(click_mean) OVER r, 0.0), 6) AS click_mean_sum
FROM w WINDOW r AS (PARTITION BY user_id ORDER BY hours_in RANGE BETWEEN 4 PRECEDING AND CURRENT ROW)""")
def q_rolling_lookback(spark, sf):
    """Look-back features over hours t-4..t at every hour of the stay."""
    w, _ = wide_grid(spark, sf)
    return rounded(rolling_lookback(w.select(STAY, "hours_in", "click_mean"), STAY, ["click_mean"], 4, parted=True))


@register("value_at_hour", SQL_LONG + """,
t AS (SELECT user_id, max_hours // 2 AS at_hour FROM s),
o AS (SELECT hl.user_id, hl.hours_in, hl.mean, t.at_hour FROM hl JOIN t USING (user_id) WHERE hl.variable = 'click'),
pick AS (SELECT user_id, coalesce(max(hours_in) FILTER (WHERE hours_in <= at_hour), min(hours_in)) AS hours_in
         FROM o GROUP BY user_id)
SELECT pick.user_id, pick.hours_in, round(o.mean, 6) AS mean FROM pick JOIN o USING (user_id, hours_in)""")
def q_value_at_hour(spark, sf):
    """The click mean at the latest observed hour ≤ half the stay (else the first)."""
    M, s = measurements(spark, sf)
    hl = H.hourly_long(M, True, ID).filter(F.col("variable") == "click")
    at = s.select(STAY, F.floor(F.col("max_hours") / 2).cast("bigint").alias("at_hour"))
    return rounded(value_at_hour(hl, STAY, at, "at_hour", ["mean"]))


@register("sequence_tensor", SQL_IND + """
SELECT user_id, list_resize(list(CAST(purchase_on AS DOUBLE) ORDER BY hours_in)[1:240], 240, 0.0) AS purchase_on
FROM ind GROUP BY user_id""")
def q_sequence_tensor(spark, sf):
    """Per-stay hour-ordered flag sequence padded/truncated to 240."""
    g = indicator_grid(spark, sf).withColumn("purchase_on", F.col("purchase_on").cast("double"))
    return to_sequence(g, STAY, ["purchase_on"], max_len=240)


# ------------------------------------------------ summaries over the grid
@register("column_completeness", SQL_WIDE + "\nSELECT variable, pct FROM (SELECT "
          + ", ".join(f"round(round(count({v}_mean) / count(*), 3) * 100, 6) AS {v}" for v in VARIABLES)
          + f" FROM w) UNPIVOT (pct FOR variable IN ({', '.join(VARIABLES)}))")
def q_column_completeness(spark, sf):
    """A10: share of grid hours with a mean, per variable (rounded to 3, × 100)."""
    w, _ = wide_grid(spark, sf)
    return rounded(S.completeness(w, {v: f"{v}_mean" for v in VARIABLES}))


@register("subject_obs_share", SQL_WIDE + """,
per AS (SELECT user_id, """ + ", ".join(f"count({v}_mean) AS {v}" for v in VARIABLES) + """ FROM w GROUP BY user_id),
lng AS (SELECT user_id, variable, n FROM per UNPIVOT (n FOR variable IN (""" + ", ".join(VARIABLES) + """)))
SELECT variable, CAST(k AS INTEGER) AS k, round(avg(CASE WHEN n > k THEN 1.0 ELSE 0.0 END), 6) AS share
FROM lng, (SELECT unnest([1, 2, 3]) AS k) GROUP BY variable, k""")
def q_subject_obs_share(spark, sf):
    """Share of stays with more than k hourly means per variable, k = 1, 2, 3."""
    w, _ = wide_grid(spark, sf)
    return rounded(S.share_more_than(w, STAY, {v: f"{v}_mean" for v in VARIABLES}, (1, 2, 3)))


@register("variable_summary", SQL_LONG + """,
n AS (SELECT count(*) AS n_rows FROM grid)
SELECT variable, round(avg(mean), 6) AS mean, round(stddev_samp(mean), 6) AS std,
       round(100.0 * (1 - count(mean) / n.n_rows), 6) AS missing_pct
FROM hl, n GROUP BY variable, n.n_rows""")
def q_variable_summary(spark, sf):
    """Mean / std / missing % of the hourly means per variable."""
    M, s = measurements(spark, sf)
    return rounded(S.variable_summary(H.hourly_long(M, True, ID), H.hour_grid(s, ID)))


@register("mean_by_hour", SQL_LONG + """
SELECT variable, hours_in, round(avg(mean) FILTER (WHERE count > 0), 6) AS mean, count(*) FILTER (WHERE count > 0) AS n_stays
FROM hl GROUP BY variable, hours_in""")
def q_mean_by_hour(spark, sf):
    """Mean of observed hourly means per variable and hour of stay."""
    return rounded(S.mean_by_hour(long_stats(spark, sf)))


@register("intervention_hours", SQL_IND + """
SELECT """ + ", ".join(f"round(avg(h_{n}), 6) AS {n}" for n in _IND) + """
FROM (SELECT user_id, """ + ", ".join(f"sum({n}) AS h_{n}" for n in _IND) + """ FROM ind GROUP BY user_id)""")
def q_intervention_hours(spark, sf):
    """Mean over stays of the summed intervention hours."""
    return rounded(S.mean_of_sums(indicator_grid(spark, sf), STAY, _IND))


@register("value_profile", """
WITH m AS (SELECT event_type, avg(value) AS mu, count(value) AS n FROM events GROUP BY event_type)
SELECT e.event_type AS variable, m.n, round(median(e.value), 6) AS median, round(var_samp(e.value), 6) AS variance,
       round(avg(power(e.value - m.mu, 3)) / power(avg(power(e.value - m.mu, 2)), 1.5)
             * sqrt(m.n * (m.n - 1)) / (m.n - 2), 6) AS skew,
       round(quantile_cont(e.value, 0.99), 6) AS q99
FROM events e JOIN m USING (event_type) WHERE e.value IS NOT NULL GROUP BY e.event_type, m.n""")
def q_value_profile(spark, sf):
    """N, median, sample variance, bias-corrected skew and 99th percentile per variable."""
    ev = events(spark, sf)
    return rounded(S.profile(ev.select(F.col("event_type").alias("variable"), "value"), ["variable"], "value"))


@register("outlier_study", """
WITH st AS (SELECT event_type, median(value) AS med, stddev_samp(value) AS sd FROM events GROUP BY event_type)
SELECT e.event_type AS variable,
       round(avg(CASE WHEN abs(e.value - st.med) > st.sd THEN 1.0 ELSE 0.0 END), 6) AS outlier_ratio,
       round(avg(CASE WHEN abs(e.value - st.med) > st.sd THEN st.med ELSE coalesce(e.value, st.med) END), 6) AS mean_replaced
FROM events e JOIN st USING (event_type) GROUP BY e.event_type""")
def q_outlier_study(spark, sf):
    """Share of rows farther than one std from the median; mean after replacing them by the median."""
    ev = events(spark, sf).select(F.col("event_type").alias("variable"), "value")
    return rounded(S.outlier_study(ev, ["variable"], "value"))


@register("scaled_values", """
WITH g AS (SELECT min(value) AS lo, max(value) AS hi FROM events),
t AS (SELECT event_type, avg(value) AS mu, stddev_samp(value) AS sd FROM events GROUP BY event_type)
SELECT e.event_id, round((e.value - g.lo) / (g.hi - g.lo), 6) AS value_minmax,
       round((e.value - t.mu) / t.sd, 6) AS value_std
FROM events e JOIN t USING (event_type), g""")
def q_scaled_values(spark, sf):
    """A19 global min-max scaling and A20 standardisation with per-variable statistics."""
    ev = events(spark, sf).select("event_id", "event_type", "value")
    out = S.minmax_scale(ev, ["value"], suffix="_minmax")
    out = S.standardize(out, ["value"], by=["event_type"], suffix="_std")
    return rounded(out.select("event_id", "value_minmax", "value_std"))


@register("missing_rank", SQL_WIDE + """,
nc AS (SELECT variable, n_null FROM (SELECT """ + ", ".join(f"count(*) - count({v}_mean) AS {v}" for v in VARIABLES)
          + """ FROM w) UNPIVOT (n_null FOR variable IN (""" + ", ".join(VARIABLES) + """)))
SELECT variable, n_null,
       round(rank() OVER (ORDER BY n_null) + (count(*) OVER (PARTITION BY n_null) - 1) / 2.0, 6) AS avg_rank
FROM nc""")
def q_missing_rank(spark, sf):
    """A15 NULL counts per column, with W14 average rank (ties share the mean rank)."""
    w, _ = wide_grid(spark, sf)
    nc = S.null_counts(w, {v: f"{v}_mean" for v in VARIABLES})
    return rounded(S.average_rank(nc, "n_null", "avg_rank"))
