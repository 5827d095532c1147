"""Work of the model helpers: no trial twice, no class on its own."""

import random

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from stayline.operators import models as MD


def test_a_map_drawn_again_is_not_fitted_again(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(x := rng.random(), rng.random(), float(x + rng.random() / 2 > 0.7)) for _ in range(300)]
    d = spark.createDataFrame(rows, "a double, b double, label double").cache()
    train, dev = d.limit(200), d.exceptAll(d.limit(200))
    made = []
    make = MD.make_classifier
    monkeypatch.setattr(MD, "make_classifier", lambda *a, **k: made.append(k) or make(*a, **k))
    _, (auc, params) = MD.random_search(train, dev, ["a", "b"], "forest", {"numTrees": [3], "maxDepth": [2, 3]}, n_iter=6, seed=2)
    assert len(made) == 3 and made[-1] == params  # two maps and the last fit
    ev = MD.BinaryClassificationEvaluator(labelCol="label", metricName="areaUnderROC")
    alone = [ev.evaluate(MD.fit_classifier(train, ["a", "b"], "forest", seed=2, numTrees=3, maxDepth=k).transform(dev)) for k in (2, 3)]
    assert abs(auc - max(alone)) < 1e-12


def test_aurocs_of_all_classes_at_once(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(rng.randrange(3), [round(rng.random(), 1) for _ in range(3)]) for _ in range(200)]  # many ties
    d = spark.createDataFrame(rows, "y int, p array<double>")
    want = {c: MD.exact_auroc(d.select(F.get("p", F.lit(c)).alias("s"), (F.col("y") == c).cast("int").alias("t")), "s", "t")
            .first()["auroc"] for c in range(3)}
    counted = []
    run = MD.global_cumsum
    monkeypatch.setattr(MD, "global_cumsum", lambda *a, **k: counted.append(1) or run(*a, **k))
    got = MD.one_against_rest_aurocs(d, "p", "y", [0, 1, 2])
    assert counted == [1] and all(abs(got[c] - want[c]) < 1e-12 for c in want)


def test_class_report_of_known_rows(spark):
    d = spark.createDataFrame([(0.0, 0.0, 0.9, 0.1), (0.0, 1.0, 0.4, 0.6), (1.0, 1.0, 0.2, 0.8), (1.0, 1.0, 0.4, 0.6)],
                              "label double, prediction double, p0 double, p1 double")
    d = VectorAssembler(inputCols=["p0", "p1"], outputCol="probability").transform(d)
    got = {r["class"]: tuple(r)[1:] for r in MD.class_report(d).collect()}
    assert got[0] == (2, 1.0, 0.5, 2 / 3, 0.875) and got[1] == (2, 2 / 3, 1.0, 0.8, 0.875)
    assert got[None][0] == 4 and abs(got[None][1] - 5 / 6) < 1e-12
