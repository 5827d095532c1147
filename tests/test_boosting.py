import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayline.operators import boosting as B

X = ["a", "b", "c", "none"]


def rows_of(n, seed=1):
    """Missing values of ``a`` go with label 1, those of ``b`` say nothing."""
    r = random.Random(seed)
    out = []
    for _ in range(n):
        a, b, c = r.randrange(20), r.randrange(6), r.random()
        y = int(a > 11 or r.random() < 0.1)
        if r.random() < 0.2:
            a, y = None, int(r.random() < 0.9)
        out.append((y, None if a is None else float(a), float("nan") if r.random() < 0.3 else float(b), float(round(c, 1)), None))
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "label int, a double, b double, c double, none double")


def brute_tree(x, g, h, depth, cuts, lam):
    """One tree by trying every cut and both directions on the rows themselves."""
    def leaf(idx):
        return -sum(g[i] for i in idx) / (sum(h[i] for i in idx) + lam)

    def score(idx):
        return sum(g[i] for i in idx) ** 2 / (sum(h[i] for i in idx) + lam)

    def grow(idx, d):
        best = None
        if d < depth:
            for f in range(len(x[0])):
                for cut in cuts[f]:
                    for missing_left in (True, False):
                        left = [i for i in idx if (missing_left if x[i][f] is None else x[i][f] <= cut)]
                        right = [i for i in idx if i not in set(left)]
                        if sum(h[i] for i in left) < 1 or sum(h[i] for i in right) < 1:
                            continue
                        gain = 0.5 * (score(left) + score(right) - score(idx))
                        if gain > 1e-9 and (best is None or gain > best[0] + 1e-9 * max(1, gain)):
                            best = (gain, left, right)
        if best is None:
            return {i: leaf(idx) for i in idx}
        return {**grow(best[1], d + 1), **grow(best[2], d + 1)}
    return grow(list(range(len(x))), 0)


def test_equals_brute_force(spark):
    rows = rows_of(150)
    x = [[None if v is None or v != v else v for v in r[1:]] for r in rows]
    model = B.fit(frame(spark, rows).repartition(4), X, rounds=3, depth=2, eta=0.5)
    margin = [0.0] * len(rows)
    for _ in range(3):
        p = [1 / (1 + math.exp(-m)) for m in margin]
        g, h = [q - r[0] for q, r in zip(p, rows)], [q * (1 - q) for q in p]
        step = brute_tree(x, g, h, 2, model.cuts, 1.0)
        margin = [m + 0.5 * step[i] for i, m in enumerate(margin)]
    got = model.predict(frame(spark, rows).coalesce(1)).select("p1").collect()
    assert np.allclose([r[0] for r in got], [1 / (1 + math.exp(-m)) for m in margin], atol=1e-9)


def test_learns_default_directions_and_gain(spark):
    rows = rows_of(2000)
    model = B.fit(frame(spark, rows), X, rounds=12, depth=2, eta=0.3)
    assert len(model.trees) == 12  # margins are rewritten on the way
    first = model.trees[0]
    assert first.feature[0] == 0 and not first.left[0]  # missing a goes with the large ones
    imp = model.importance()
    assert imp[0][0] == "a" and dict((r[0], r[2]) for r in imp)["none"] == 0
    test = frame(spark, rows_of(1000, 9))
    hit = model.predict(test).agg(F.avg(((F.col("p1") > 0.5).cast("int") == F.col("label")).cast("double"))).first()[0]
    assert hit > 0.88


@pytest.mark.parametrize("rows", [[], [(1, 1.0, None, 0.0, None)] * 5, [(0, None, None, None, None)] * 5 + [(None, 1.0, 1.0, 1.0, None)]])
def test_nothing_to_split(spark, rows):
    model = B.fit(frame(spark, rows), X, rounds=2)
    assert model.trees == [] and {r[0] for r in model.predict(frame(spark, rows)).select("p1").collect()} <= {0.5}


def test_weights(spark):
    rows = rows_of(300)
    one = B.fit(frame(spark, rows + rows[:100]), X, rounds=2, depth=2)
    d = frame(spark, rows).coalesce(1).withColumn("w", F.when(F.monotonically_increasing_id() < 100, 2).otherwise(1))
    two = B.fit(d, X, weight="w", rounds=2, depth=2)
    for s, t in zip(one.trees, two.trees):
        assert (s.feature == t.feature).all() and np.allclose(s.value, t.value)
