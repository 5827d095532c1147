"""Baseline models and metrics on Spark ML.

Training data stays distributed; only parameter maps and metric values live
on the driver.
"""

from __future__ import annotations

import random

from pyspark import StorageLevel
from pyspark.ml import Pipeline
from pyspark.ml.classification import (GBTClassifier, LogisticRegression, MultilayerPerceptronClassifier,
                                       RandomForestClassifier)
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.operators.ordered import global_cumsum

#: Scores that one range of a running count holds; the number of ranges grows with the rows.
SCORE_ROWS = 500_000


def feature_pipeline(features: list[str], scale: bool = True, impute: bool = True):
    """M05 mean imputation + assembly + M07 standard scaling."""
    stages = []
    cols = features
    if impute:
        out = [f"__imp_{c}" for c in features]
        stages.append(Imputer(inputCols=features, outputCols=out, strategy="mean"))
        cols = out
    stages.append(VectorAssembler(inputCols=cols, outputCol="__raw", handleInvalid="keep"))
    if scale:
        stages.append(StandardScaler(inputCol="__raw", outputCol="features", withMean=True, withStd=True))
    else:
        stages[-1].setOutputCol("features")
    return stages


def make_classifier(kind: str, label: str = "label", weight: str | None = None, n_features: int | None = None,
                    seed: int = 0, **params):
    if kind == "logreg":
        m = LogisticRegression(labelCol=label, maxIter=params.get("maxIter", 100), regParam=params.get("regParam", 0.0))
    elif kind == "forest":
        m = RandomForestClassifier(labelCol=label, numTrees=params.get("numTrees", 100), seed=seed,
                                   maxDepth=params.get("maxDepth", 5))
    elif kind == "gbt":
        m = GBTClassifier(labelCol=label, maxDepth=params.get("maxDepth", 3), maxIter=params.get("maxIter", 300),
                          stepSize=params.get("stepSize", 0.05), seed=seed)
    elif kind == "mlp":
        hidden = params.get("hidden", 16)
        m = MultilayerPerceptronClassifier(labelCol=label, layers=[n_features, hidden, 2], seed=seed,
                                           maxIter=params.get("maxIter", 200))
    else:
        raise ValueError(kind)
    if weight and hasattr(m, "setWeightCol") and kind != "mlp":
        m.setWeightCol(weight)
    return m


def fit_classifier(train: DataFrame, features: list[str], kind: str = "logreg", label: str = "label",
                   weight: str | None = None, seed: int = 0, **params):
    stages = feature_pipeline(features)
    stages.append(make_classifier(kind, label, weight, len(features), seed, **params))
    return Pipeline(stages=stages).fit(train)


def binary_metrics(pred: DataFrame, label: str = "label") -> DataFrame:
    """AUROC, AUPRC (Spark evaluators), accuracy, F1 — as (metric, value) rows."""
    out = []
    for m in ("areaUnderROC", "areaUnderPR"):
        out.append((m, float(BinaryClassificationEvaluator(labelCol=label, metricName=m).evaluate(pred))))
    for m in ("accuracy", "f1"):
        out.append((m, float(MulticlassClassificationEvaluator(labelCol=label, metricName=m).evaluate(pred))))
    return pred.sparkSession.createDataFrame(out, "metric string, value double")


def confusion(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Confusion matrix as counts per (label, prediction)."""
    return pred.groupBy(F.col(label).cast("int").alias("label"), F.col(prediction).cast("int").alias("prediction")).count()


def exact_auroc(scored: DataFrame, score: str, label: str) -> DataFrame:
    """Exact AUROC = P(score_pos > score_neg) + ½ P(tie), from per-score
    counts and a distributed running count of negatives (no single-task sort);
    NULL if one class is missing."""
    g = scored.groupBy(score).agg(F.sum(F.col(label).cast("long")).alias("__p"),
                                  F.sum((1 - F.col(label)).cast("long")).alias("__n"))
    g = global_cumsum(g, [score], {"__neg_below": "__n"}, inclusive=False)
    contrib = F.col("__p") * (F.col("__neg_below") + 0.5 * F.col("__n"))
    return g.agg(F.try_divide(F.sum(contrib), F.sum("__p") * F.sum("__n")).alias("auroc"),
                 F.sum("__p").alias("n_pos"), F.sum("__n").alias("n_neg"))


def one_against_rest_aurocs(scored: DataFrame, scores: str, label: str, classes: list[int], count: str | None = None,
                            num_partitions: int | None = None) -> dict[int, float | None]:
    """``exact_auroc`` of every class against the rest in one running count:
    ``scores`` holds a row's score for each class.  A score's rows are counted
    for each class apart, so all classes share the order of the scores.  A row
    stands for ``count`` equal ones."""
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.get(scores, F.lit(c)).alias("s")) for c in classes]))
    d = scored.select(F.col(label).alias("__y"), _times(count).alias("__k"), each.alias("__e"))
    d = d.select("__y", "__k", "__e.c", "__e.s")
    mine = {c: F.col("c") == c for c in classes}

    def rows(when):
        return F.sum(F.when(when, F.col("__k")).otherwise(0))
    g = d.groupBy("s").agg(*[rows(mine[c] & (F.col("__y") == c)).alias(f"__p{c}") for c in classes],
                           *[rows(mine[c] & (F.col("__y") != c)).alias(f"__n{c}") for c in classes])
    g = global_cumsum(g, ["s"], {f"__b{c}": f"__n{c}" for c in classes}, num_partitions, inclusive=False)
    row = g.agg(*[F.try_divide(F.sum(F.col(f"__p{c}") * (F.col(f"__b{c}") + 0.5 * F.col(f"__n{c}"))),
                               F.sum(f"__p{c}") * F.sum(f"__n{c}")).alias(f"auroc{c}") for c in classes]).first()
    return {c: row[f"auroc{c}"] for c in classes}


def _running_counts(scored: DataFrame, score: str, label: str) -> DataFrame:
    """Per distinct score: __p and __n (positives and negatives of that score)
    and __tp and __fp (of that score or a higher one)."""
    g = scored.groupBy(score).agg(F.sum(F.col(label).cast("long")).alias("__p"),
                                  F.sum((1 - F.col(label)).cast("long")).alias("__n"))
    g = g.withColumn("__key", -F.col(score).cast("double"))
    return global_cumsum(g, ["__key"], {"__tp": "__p", "__fp": "__n"}, inclusive=True)


def exact_average_precision(scored: DataFrame, score: str, label: str) -> DataFrame:
    """Exact average precision, the sum over distinct scores of
    (recall gained) x precision, rows of one score entering together; from
    distributed running counts.  NULL without a positive."""
    g = _running_counts(scored, score, label)
    step = F.col("__p") * F.col("__tp") / (F.col("__tp") + F.col("__fp"))
    return g.agg(F.try_divide(F.sum(step), F.sum("__p")).alias("average_precision"),
                 F.sum("__p").alias("n_pos"), F.sum("__n").alias("n_neg"))


def roc_points(scored: DataFrame, score: str, label: str) -> DataFrame:
    """The ROC curve, one row per distinct score as threshold: threshold,
    tp, fp, tpr, fpr (a rate without its class is NULL)."""
    g = _running_counts(scored, score, label)
    n = scored.agg(F.sum(F.col(label).cast("long")).alias("__pos"), F.sum((1 - F.col(label)).cast("long")).alias("__neg"))
    g = g.join(F.broadcast(n), F.lit(True))  # one row
    return g.select(F.col(score).alias("threshold"), F.col("__tp").alias("tp"), F.col("__fp").alias("fp"),
                    F.try_divide("__tp", "__pos").alias("tpr"), F.try_divide("__fp", "__neg").alias("fpr"))


def _times(count: str | None):
    """How many equal rows a row stands for."""
    return F.lit(1).cast("long") if count is None else F.col(count)


def each_time(df: DataFrame, count: str) -> DataFrame:
    """Every row ``count`` times, without that column."""
    cols = [c for c in df.columns if c != count]
    return df.select(*cols, F.explode(F.sequence(F.lit(1).cast("long"), count)).alias("__i")).select(*cols)


def class_weights(df: DataFrame, label: str, name: str = "weight", count: str | None = None) -> DataFrame:
    """Balanced weight n / (k · n_c) per class, joined onto the rows, of
    which each stands for ``count`` equal ones."""
    counts = df.groupBy(label).agg(F.sum(_times(count)).alias("__nc"))
    tot = counts.agg(F.sum("__nc").alias("__n"), F.count(F.lit(1)).alias("__k"))
    w = counts.crossJoin(F.broadcast(tot)).select(label, (F.col("__n") / (F.col("__k") * F.col("__nc"))).alias(name))
    return df.join(F.broadcast(w), label, "left")  # one row per class


def fit_multiclass(train: DataFrame, label: str = "label", weight: str | None = None):
    """Multinomial logistic regression on a ``features`` vector, scaled."""
    lr = LogisticRegression(labelCol=label, featuresCol="__scaled", maxIter=100, family="multinomial")
    if weight:
        lr.setWeightCol(weight)
    return Pipeline(stages=[StandardScaler(inputCol="features", outputCol="__scaled", withMean=True), lr]).fit(train)


def class_report(pred: DataFrame, label: str = "label", count: str | None = None) -> DataFrame:
    """Class (null: macro mean), n, precision, recall, f1 and exact
    one-against-rest AUROC.  One row per class: the class ids are the labels.
    A row of ``pred`` stands for ``count`` equal ones."""
    p = pred.select(F.col(label).cast("int").alias("y"), F.col("prediction").cast("int").alias("z"),
                    vector_to_array("probability").alias("p"), _times(count).alias("k"))
    found = p.groupBy("y", "z").agg(F.sum("k").alias("n"), F.count(F.lit(1)).alias("rows")).collect()  # classes by classes
    cells = [(r["y"], r["z"], r["n"]) for r in found]
    classes = sorted({y for y, _, _ in cells})  # the classes of the model
    parts = max(int(p.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")),
                -(-len(classes) * sum(r["rows"] for r in found) // SCORE_ROWS))
    aurocs = one_against_rest_aurocs(p, "p", "y", classes, "k", parts) if classes else {}
    rows = []
    for c in classes:
        n, m = (sum(k for *yz, k in cells if yz[i] == c) for i in (0, 1))
        hit = sum(k for y, z, k in cells if y == z == c)
        prec, rec = hit / m if m else 0.0, hit / n
        rows.append((c, n, prec, rec, 2 * prec * rec / (prec + rec) if prec + rec else 0.0, aurocs[c]))
    if rows:
        mean = [sum(r[i] for r in rows if r[i] is not None) / len(rows) for i in (2, 3, 4, 5)]
        rows.append((None, sum(r[1] for r in rows), *mean))
    return pred.sparkSession.createDataFrame(rows, "class int, n long, precision double, recall double, f1 double, auroc double")


def feature_importance(model, features: list[str]) -> list[tuple[str, float]]:
    """Importances (trees) or coefficients (linear), sorted by magnitude."""
    last = model.stages[-1]
    if hasattr(last, "featureImportances"):
        vals = list(last.featureImportances.toArray())
    else:
        vals = list(last.coefficients.toArray())
    return sorted(zip(features, [float(v) for v in vals]), key=lambda t: -abs(t[1]))


def random_search(train: DataFrame, dev: DataFrame, features: list[str], kind: str, space: dict,
                  n_iter: int = 4, label: str = "label", seed: int = 0):
    """Sample parameter maps, keep the best dev AUROC, refit on train + dev.

    The trials share one fit of the features and their assembled rows.  A map
    that is drawn again would give the same model from the same seed, so its
    first trial stands for it; all ``n_iter`` draws are made and compared."""
    rng = random.Random(seed)
    best, tried = None, {}
    ev = BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC")
    prepared = Pipeline(stages=feature_pipeline(features)).fit(train)
    tr, dv = (prepared.transform(x).select(label, "features").persist(StorageLevel.MEMORY_AND_DISK) for x in (train, dev))
    try:
        for _ in range(n_iter):
            params = {k: rng.choice(v) for k, v in space.items()}
            if (key := tuple(params.items())) not in tried:
                model = make_classifier(kind, label, None, len(features), seed, **params).fit(tr)
                tried[key] = ev.evaluate(model.transform(dv))
            if best is None or tried[key] > best[0]:
                best = (tried[key], params)
    finally:
        tr.unpersist()
        dv.unpersist()
    final = fit_classifier(train.unionByName(dev), features, kind, label, seed=seed, **best[1])
    return final, best


def positive_probability(pred: DataFrame, name: str = "p1") -> DataFrame:
    return pred.withColumn(name, vector_to_array("probability")[1])
