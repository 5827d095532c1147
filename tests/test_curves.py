import itertools
import random

from stayline.operators import models as M

SCHEMA = "score double, y int"


def test_average_precision_and_roc_equal_brute_force(spark):
    rng = random.Random(3)
    rows = [(float(rng.randrange(12)), rng.randrange(2)) for _ in range(200)]
    d = spark.createDataFrame(rows, SCHEMA).repartition(5)
    pos = sum(y for _, y in rows)
    ap, points = 0.0, {}
    tp = fp = 0
    for score, tied in itertools.groupby(sorted(rows, reverse=True), key=lambda r: r[0]):
        ys = [y for _, y in tied]
        tp, fp = tp + sum(ys), fp + len(ys) - sum(ys)
        ap += sum(ys) / pos * tp / (tp + fp)
        points[score] = (tp, fp, tp / pos, fp / (len(rows) - pos))
    got = M.exact_average_precision(d, "score", "y").first()
    assert abs(got.average_precision - ap) < 1e-12 and got.n_pos == pos
    assert {r.threshold: tuple(r)[1:] for r in M.roc_points(d, "score", "y").collect()} == points


def test_one_class(spark):
    d = spark.createDataFrame([(1.0, 0), (2.0, 0)], SCHEMA)
    assert M.exact_average_precision(d, "score", "y").first().average_precision is None
    assert {(r.fp, r.tpr, r.fpr) for r in M.roc_points(d, "score", "y").collect()} == {(1, None, 0.5), (2, None, 1.0)}
