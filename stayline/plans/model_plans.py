"""Splits, labels and baseline models bound to ``documents`` + ``labels``.

Features are derived per document by Spark (length, words, sentences,
blocks, de-identification spans, share of upper-case letters and digits,
language one-hot); the label is ``labels.quality``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from stayline.functions.hashing import uniform_sql
from stayline.operators import boosting as B
from stayline.operators import gram as G
from stayline.operators import models as MD
from stayline.operators import notes as N
from stayline.operators.hourly import join_hours
from stayline.operators.impute import global_means_from_long, simple_impute
from stayline.operators.splits import kfold, subject_split
from stayline.operators.windows import flatten_sample, one_hot_label, sample_windows, transition_labels
from stayline.plans import events_plans as EP
from stayline.plans.registry import register, round_half_away, rounded
from stayline.session import cut_lineage
from stayline.sources.tables import table

# The language categories for the one-hot features.
LANGS = ("en", "de", "fr", "es")
FEATURES = ["n_chars", "n_words", "n_sentences", "n_blocks", "n_deid", "upper_share", "digit_share"] + \
    [f"lang_{x}" for x in LANGS]


def doc_features(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text", "lang", "n_chars")
    t = F.col("text")
    letters = F.length(F.regexp_replace(t, r"[^A-Za-z]", ""))
    d = d.select(
        "doc_id", F.col("n_chars").cast("double").alias("n_chars"),
        F.size(F.split(F.trim(t), r"\s+")).cast("double").alias("n_words"),
        F.size(N.sentences(t)).cast("double").alias("n_sentences"),
        F.size(N.blocks(t)).cast("double").alias("n_blocks"),
        F.size(N.deid_spans(t)).cast("double").alias("n_deid"),
        F.when(letters > 0, F.length(F.regexp_replace(t, r"[^A-Z]", "")) / letters).otherwise(0.0).alias("upper_share"),
        F.when(F.length(t) > 0, F.length(F.regexp_replace(t, r"[^0-9]", "")) / F.length(t)).otherwise(0.0)
        .alias("digit_share"),
        *[F.when(F.col("lang") == x, 1.0).otherwise(0.0).alias(f"lang_{x}") for x in LANGS])
    lab = table(spark, sf, "labels").select("doc_id", F.col("quality").cast("double").alias("label"))
    return d.join(lab, "doc_id", "inner")


def split_docs(spark, sf):
    return subject_split(doc_features(spark, sf), "doc_id", seed=7, strata="label")


_LABELLED = "SELECT doc_id, CAST(quality AS DOUBLE) AS label FROM documents JOIN labels USING (doc_id)"


@register("doc_split", f"""
WITH d AS ({_LABELLED}),
k AS (SELECT DISTINCT doc_id, label, {uniform_sql(7, 'doc_id')} AS h FROM d),
r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY h, doc_id) AS r, count(*) OVER (PARTITION BY label) AS n FROM k)
SELECT doc_id, label, CASE WHEN r <= round_even(n * 0.7, 0) THEN 'train' WHEN r <= round_even(n * 0.8, 0) THEN 'dev'
                           ELSE 'test' END AS split
FROM d JOIN r USING (doc_id, label)""")
def q_doc_split(spark, sf):
    """Exact stratified 70/10/20 split of labelled documents by hashed id."""
    return split_docs(spark, sf).select("doc_id", "label", "split")


#: Folds of the documents of ``d``: dealt round in the order of their hash.
_FOLDS = f"""k AS (SELECT doc_id, CAST((row_number() OVER (ORDER BY {uniform_sql(3, 'doc_id')}, doc_id) - 1) % 5 AS INTEGER) AS fold
       FROM (SELECT DISTINCT doc_id FROM d))"""


@register("doc_folds", f"""
WITH d AS ({_LABELLED}), {_FOLDS}
SELECT doc_id, label, fold FROM d JOIN k USING (doc_id)""")
def q_doc_folds(spark, sf):
    """Grouped 5-fold assignment."""
    return kfold(doc_features(spark, sf).select("doc_id", "label"), "doc_id", 5, seed=3)


@register("class_weights", """
WITH c AS (SELECT CAST(quality AS DOUBLE) AS label, count(*) AS nc FROM labels JOIN documents USING (doc_id) GROUP BY 1),
t AS (SELECT sum(nc) AS n, count(*) AS k FROM c)
SELECT label, round(n / (k * nc), 6) AS weight FROM c, t""")
def q_class_weights(spark, sf):
    """Balanced class weights n / (k · n_c)."""
    w = MD.class_weights(doc_features(spark, sf).select("label"), "label")
    return rounded(w.distinct())


@register("auroc_exact", """
WITH s AS (SELECT d.n_chars AS score, l.quality AS y FROM documents d JOIN labels l USING (doc_id)),
g AS (SELECT score, sum(y) AS p, sum(1 - y) AS n FROM s GROUP BY score),
c AS (SELECT *, coalesce(sum(n) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb FROM g)
SELECT round(sum(p * (nb + 0.5 * n)) / (sum(p) * sum(n)), 6) AS auroc, CAST(sum(p) AS BIGINT) AS n_pos,
       CAST(sum(n) AS BIGINT) AS n_neg FROM c""")
def q_auroc_exact(spark, sf):
    """Exact AUROC of document length as a quality score (rank-sum form)."""
    d = table(spark, sf, "documents").select("doc_id", F.col("n_chars").alias("score"))
    lab = table(spark, sf, "labels").select("doc_id", F.col("quality").alias("y"))
    return rounded(MD.exact_auroc(d.join(lab, "doc_id"), "score", "y"))


_CURVE_SQL = """
WITH s AS (SELECT d.n_chars AS score, l.quality AS y FROM documents d JOIN labels l USING (doc_id)),
g AS (SELECT score, sum(y) AS p, sum(1 - y) AS n FROM s GROUP BY score),
c AS (SELECT *, sum(p) OVER (ORDER BY score DESC) AS tp, sum(n) OVER (ORDER BY score DESC) AS fp FROM g)"""


def _scored(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.col("n_chars").alias("score"))
    return d.join(table(spark, sf, "labels").select("doc_id", F.col("quality").alias("y")), "doc_id")


@register("average_precision", _CURVE_SQL + """
SELECT round(sum(p * tp / (tp + fp)) / sum(p), 6) AS average_precision, CAST(sum(p) AS BIGINT) AS n_pos,
       CAST(sum(n) AS BIGINT) AS n_neg FROM c""")
def q_average_precision(spark, sf):
    """Exact average precision of document length as a quality score, ties included."""
    return rounded(MD.exact_average_precision(_scored(spark, sf), "score", "y"))


@register("roc_points", _CURVE_SQL + """
SELECT score AS threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp,
       round(tp / (SELECT sum(p) FROM g), 6) AS tpr, round(fp / (SELECT sum(n) FROM g), 6) AS fpr FROM c""")
def q_roc_points(spark, sf):
    """The ROC curve of document length as a quality score."""
    return rounded(MD.roc_points(_scored(spark, sf), "score", "y"))


def _persisted_split(spark, sf):
    """Iterative learners read their input many times: keep the (derived,
    labelled, split) table in memory/disk for the duration of one fit."""
    from pyspark import StorageLevel
    return split_docs(spark, sf).persist(StorageLevel.MEMORY_AND_DISK)


def _local(df):
    """Materialise a tiny result so the persisted inputs can be released."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)


def _fit_eval(spark, sf, kind, d=None, **params):
    d = d if d is not None else split_docs(spark, sf)
    train = d.filter(F.col("split") != "test")
    test = d.filter(F.col("split") == "test")
    model = MD.fit_classifier(train, FEATURES, kind, seed=11, **params)
    return model, model.transform(test)


@register("model_logreg")
def q_model_logreg(spark, sf):
    """M10 + M16: logistic regression, test-split metrics."""
    d = _persisted_split(spark, sf)
    try:
        _, pred = _fit_eval(spark, sf, "logreg", d)
        return MD.binary_metrics(pred)
    finally:
        d.unpersist()


@register("model_forest")
def q_model_forest(spark, sf):
    """M11 + M17: random forest feature importances."""
    d = _persisted_split(spark, sf)
    try:
        model, _ = _fit_eval(spark, sf, "forest", d)
        return spark.createDataFrame(MD.feature_importance(model, FEATURES), "feature string, importance double")
    finally:
        d.unpersist()


def _boosted(spark, sf):
    """(test rows, model): boosting on features that are NULL where a document
    has nothing to measure (no letters, no language), without imputation."""
    d = cut_lineage(split_docs(spark, sf))
    nothing = {"upper_share": F.col("upper_share") == 0, "digit_share": F.col("n_words") < 2,
               **{f"lang_{x}": sum(F.col(f"lang_{y}") for y in LANGS) == 0 for x in LANGS}}
    d = d.withColumns({c: F.when(~when, F.col(c)) for c, when in nothing.items()})
    return d.filter(F.col("split") == "test"), B.fit(d.filter(F.col("split") != "test"), FEATURES, rounds=20, eta=0.2)


@register("model_gbt")
def q_model_gbt(spark, sf):
    """M12 + M16: boosted trees on features with missing values, confusion matrix on the test split."""
    test, model = _boosted(spark, sf)
    return MD.confusion(model.predict(test).withColumn("prediction", (F.col("p1") > 0.5).cast("double")))


@register("boost_importance")
def q_boost_importance(spark, sf):
    """M12 + M17: mean gain and number of the splits of each feature."""
    _, model = _boosted(spark, sf)
    return spark.createDataFrame(model.importance(), "feature string, gain double, n_splits int")


@register("model_mlp")
def q_model_mlp(spark, sf):
    """M14 + M16: one-hidden-layer perceptron, test-split metrics."""
    d = _persisted_split(spark, sf)
    try:
        _, pred = _fit_eval(spark, sf, "mlp", d)
        return MD.binary_metrics(pred)
    finally:
        d.unpersist()


def _transition_samples_sql() -> str:
    grid = EP.SQL_IND[len("WITH ") + len(EP.SQL_STAYS):]  # the indicator grid after the shared stays and hours
    w = "(PARTITION BY user_id ORDER BY hours_in ROWS BETWEEN CURRENT ROW AND 5 FOLLOWING)"
    fill = "(PARTITION BY user_id ORDER BY hours_in ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    labels = EP.ORACLE["transition_labels"].split("cut AS", 1)[1]
    return f"""{EP.SQL_WIDE}{grid},
imp AS (SELECT user_id, hours_in, coalesce(last_value(click_mean IGNORE NULLS) OVER {fill},
               avg(click_mean) OVER (PARTITION BY user_id), (SELECT avg(click_mean) FROM w)) AS click FROM w),
win AS (SELECT user_id, hours_in AS start_hour, list(round(click, 6)) OVER {w} AS a, list(CAST(purchase_on AS DOUBLE)) OVER {w} AS b
        FROM imp JOIN ind USING (user_id, hours_in)),
lab AS (WITH cut AS{labels}),
st AS (SELECT user_id, CAST(count(*) AS DOUBLE) AS n_events FROM events GROUP BY user_id)
SELECT user_id, start_hour, label, {', '.join(f"CAST(label = {k} AS INTEGER) AS label_{k}" for k in range(4))},
       list_concat([n_events], list_concat(a, b)) AS features
FROM lab JOIN win USING (user_id, start_hour) JOIN st USING (user_id)"""


@register("transition_samples", _transition_samples_sql())
def q_transition_samples(spark, sf):
    """D30 (W10, M06, M19, F27): labelled sliding samples with imputed feature
    windows and the intervention window flattened into one array."""
    ind = EP.indicator_grid(spark, sf)
    long, w, _ = EP.long_and_wide(spark, sf)
    imp = simple_impute(w.select("user_id", "hours_in", "click_mean", "click_count"), ["user_id"], ["click"],
                        global_means=global_means_from_long(long, ["click"], ["user_id"]))
    g = join_hours(ind.select("user_id", "hours_in", "purchase_on"),
                   imp.select("user_id", "hours_in", round_half_away(F.col("click_mean")).alias("click_mean")), ["user_id"])
    # Labels are put on the windows' own rows: windows by stay need no join, and leave the grid in its parts.
    win = sample_windows(g, "user_id", ["click_mean", "purchase_on"], 6).withColumnRenamed("start_hour", "hours_in")
    win = win.withColumn("purchase_on", F.get("purchase_on_win", F.lit(0)))
    lab = transition_labels(win, "user_id", "purchase_on", keep_window=False, keep=("click_mean_win", "purchase_on_win"))
    st = EP.events(spark, sf).groupBy("user_id").agg(F.count(F.lit(1)).alias("n_events"))
    d = lab.join(st, "user_id")
    d = one_hot_label(d, "label", 4)
    return d.select("user_id", "start_hour", "label", *[f"label_{k}" for k in range(4)],
                    flatten_sample(["n_events"], ["click_mean_win", "purchase_on_win"]).alias("features"))


# The features of the moment queries, two of them with NULLs.
MOMENT_FEATURES = ["kchars", "en_kchars", "foreign"]
_MOMENT_ROWS = f"""
WITH d AS (SELECT doc_id, CAST(quality AS DOUBLE) AS y, n_chars / 1000.0 AS kchars,
                  CASE WHEN lang = 'en' THEN n_chars / 1000.0 END AS en_kchars,
                  CASE WHEN lang <> 'en' THEN CAST(lang = 'de' AS DOUBLE) END AS "foreign"
           FROM documents JOIN labels USING (doc_id)), {_FOLDS},
r AS (SELECT d.*, CAST(k.fold AS BIGINT) AS fold FROM d JOIN k USING (doc_id))"""


def _moment_rows(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "lang", (F.col("n_chars") / 1000.0).alias("kchars"))
    lab = table(spark, sf, "labels").select("doc_id", F.col("quality").cast("double").alias("y"))
    d = d.join(lab, "doc_id").withColumns({
        "en_kchars": F.when(F.col("lang") == "en", F.col("kchars")),
        "foreign": F.when(F.col("lang") != "en", (F.col("lang") == "de").cast("double"))})
    return kfold(d, "doc_id", 5, seed=3)


@register("fold_moments", _MOMENT_ROWS + """,
v AS (SELECT fold, [1.0, y, coalesce(kchars, 0), coalesce(en_kchars, 0), coalesce("foreign", 0),
                    CAST(kchars IS NOT NULL AS DOUBLE), CAST(en_kchars IS NOT NULL AS DOUBLE),
                    CAST("foreign" IS NOT NULL AS DOUBLE)]::DOUBLE[] AS v FROM r)
SELECT fold, CAST(a.i AS INTEGER) AS i, CAST(b.i AS INTEGER) AS j, round(sum(v[a.i + 1] * v[b.i + 1]), 6) AS value
FROM v, range(8) a(i), range(8) b(i) GROUP BY fold, a.i, b.i""")
def q_fold_moments(spark, sf):
    """Sums of products of (1, label, features, observed) by fold, in one pass."""
    return rounded(G.fold_moments(_moment_rows(spark, sf), MOMENT_FEATURES, "y", "fold"))


@register("fold_statistics", _MOMENT_ROWS + """,
u AS (SELECT fold, 'kchars' AS feature, kchars AS x FROM r UNION ALL SELECT fold, 'en_kchars', en_kchars FROM r
      UNION ALL SELECT fold, 'foreign', "foreign" FROM r),
f AS (SELECT DISTINCT fold FROM r),
m AS (SELECT f.fold, u.feature, count(*) AS n, avg(u.x) AS mean FROM f JOIN u ON u.fold <> f.fold GROUP BY f.fold, u.feature)
SELECT m.fold, m.feature, m.n AS n_train, round(m.mean, 6) AS mean,
       round(sqrt(sum(coalesce((u.x - m.mean) * (u.x - m.mean), 0)) / (m.n - 1)), 6) AS std
FROM m JOIN u ON u.fold <> m.fold AND u.feature = m.feature GROUP BY m.fold, m.feature, m.n, m.mean""")
def q_fold_statistics(spark, sf):
    """For each fold the training means and, after mean
    imputation, sample deviations of all other folds, by subtraction of moments."""
    m = G.collect_moments(G.fold_moments(_moment_rows(spark, sf), MOMENT_FEATURES, "y", "fold"), len(MOMENT_FEATURES))
    total, rows = sum(m.values()), []
    for fold, own in m.items():
        st = G.Standardised.of(total - own)
        rows += [(fold, c, int(st.n), float(st.mean[i]), float(st.std[i])) for i, c in enumerate(MOMENT_FEATURES)]
    return rounded(spark.createDataFrame(rows, "fold long, feature string, n_train long, mean double, std double"))


def _lasso(spark, sf) -> G.LassoPath:
    # Splits and folds need the ids alone; the features are derived once, where their moments are summed.
    docs = table(spark, sf, "documents").select("doc_id")
    ids = docs.join(table(spark, sf, "labels").select("doc_id", F.col("quality").cast("double").alias("label")), "doc_id")
    split = cut_lineage(subject_split(ids, "doc_id", seed=7, strata="label"))
    folds = kfold(split.filter(F.col("split") != "test").select("doc_id").distinct(), "doc_id", 5, seed=3)
    moments = G.fold_moments(doc_features(spark, sf).join(folds, "doc_id"), FEATURES, "label", "fold")
    return G.lasso_path(G.collect_moments(moments, len(FEATURES)))


@register("model_lasso")
def q_model_lasso(spark, sf):
    """M13 (M04 folds): L1 regression with the penalty of a path of 100 picked by 5-fold CV."""
    path = _lasso(spark, sf)
    k = path.best
    nz = int((path.coefficients[k] != 0).sum())
    return spark.createDataFrame([(float(path.penalties[k]), float(path.cv_rmse[k]), nz)],
                                 "reg_param double, cv_rmse double, n_nonzero int")


@register("lasso_path")
def q_lasso_path(spark, sf):
    """The whole path: held-out error and each feature's coefficient at each penalty."""
    path = _lasso(spark, sf)
    rows = [(k, float(path.penalties[k]), float(path.cv_rmse[k]), c, float(path.coefficients[k][i]))
            for k in range(len(path.penalties)) for i, c in enumerate(FEATURES)]
    return spark.createDataFrame(rows, "step int, penalty double, cv_rmse double, feature string, coefficient double")


@register("model_search")
def q_model_search(spark, sf):
    """Random hyper-parameter search on dev AUROC, refit on train + dev, test metrics."""
    d = _persisted_split(spark, sf)
    try:
        train, dev, test = (d.filter(F.col("split") == x) for x in ("train", "dev", "test"))
        model, (auc, params) = MD.random_search(train, dev, FEATURES, "forest",
                                                {"numTrees": [20, 50, 100], "maxDepth": [3, 5, 8]}, n_iter=15, seed=2)
        m = MD.binary_metrics(model.transform(test))
        return _local(m.unionByName(spark.createDataFrame([("dev_auroc", float(auc))], "metric string, value double")))
    finally:
        d.unpersist()


@register("missing_importance")
def q_missing_importance(spark, sf):
    """D32 (A15, M17, J26, W14, O06): feature importance joined with missing
    shares, average-ranked, and the quadrant (missing ≥ 0.1, high rank) flagged."""
    from stayline.operators import stats as S
    d = _persisted_split(spark, sf)
    try:
        miss = S.null_counts(d, {c: c for c in FEATURES}).withColumnRenamed("variable", "feature")
        n = d.count()
        model, _ = _fit_eval(spark, sf, "forest", d)
        imp = spark.createDataFrame(MD.feature_importance(model, FEATURES), "feature string, importance double")
        j = imp.join(miss, "feature").withColumn("missing_share", F.col("n_null") / F.lit(float(max(n, 1))))
        j = S.average_rank(j, "importance", "importance_rank")
        return _local(j.withColumn("quadrant", (F.col("missing_share") >= 0.1)
                                   & (F.col("importance_rank") >= 0.65 * len(FEATURES))))
    finally:
        d.unpersist()
