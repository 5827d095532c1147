import numpy as np
import pytest
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from stayline.operators import gram as G

X = ["a", "b", "c", "same", "none"]


@pytest.fixture(scope="module")
def rows():
    r = np.random.default_rng(5)
    n = 400
    a, b = r.normal(50, 10, n), r.normal(0, 1, n)
    c = a / 10 + r.normal(0, 0.5, n)
    y = 0.3 * a - 2 * b + r.normal(0, 1, n)
    fold = [None if i % 4 == 3 else i % 4 for i in range(n)]
    return [(fold[i], float(y[i]), None if i % 7 == 0 else float(a[i]), float("nan") if i % 11 == 0 else float(b[i]),
             float(c[i]), 3.0, None) for i in range(n)]


@pytest.fixture(scope="module")
def moments(spark, rows):
    d = spark.createDataFrame(rows + [(0, None, 1.0, 1.0, 1.0, 3.0, None)],
                              "fold int, y double, a double, b double, c double, same double, none double")
    return G.collect_moments(G.fold_moments(d.repartition(5), X, "y", "fold"), len(X))


def imputed(part, means=None):
    x = np.array([[np.nan if v is None else v for v in r[2:]] for r in part])
    with np.errstate(all="ignore"):
        m = np.array([np.nanmean(c) if (~np.isnan(c)).any() else 0.0 for c in x.T]) if means is None else means
    return np.where(np.isnan(x), m, x), np.array([r[1] for r in part]), m


def test_statistics_of_all_other_folds(rows, moments):
    assert set(moments) == {0, 1, 2, None}
    total = sum(moments.values())
    for fold, m in moments.items():
        st = G.Standardised.of(total - m)
        x, y, mean = imputed([r for r in rows if r[0] != fold])
        assert st.n == len(y) and np.allclose(st.mean, mean) and np.allclose(st.std, x.std(0, ddof=1), atol=1e-9)
        w = np.array([1.0, -0.5, 0.2, 0, 0])
        held, held_y, _ = imputed([r for r in rows if r[0] == fold], mean)
        coef, icept = st.coefficients(w)
        assert np.isclose(st.squared_error(w, m), ((held_y - held @ coef - icept) ** 2).sum())


def test_path_equals_linear_regression(spark, rows, moments):
    """Three penalties against Spark's own elastic net on imputed features."""
    path = G.lasso_path(moments)
    assert len(path.penalties) == 100 and not path.coefficients[0].any() and path.coefficients[-1][:2].all()
    d = spark.createDataFrame([(r[1], *[None if v != v else v for v in r[2:6]]) for r in rows],
                              "y double, a double, b double, c double, same double")
    cols = X[:4]
    d = Imputer(inputCols=cols, outputCols=[f"i_{c}" for c in cols]).fit(d).transform(d)
    d = VectorAssembler(inputCols=[f"i_{c}" for c in cols], outputCol="features").transform(d).cache()
    for k in (10, 45, 90):
        lr = LinearRegression(labelCol="y", elasticNetParam=1.0, regParam=float(path.penalties[k]), tol=1e-13, maxIter=2000,
                              solver="l-bfgs")
        fit = lr.fit(d)
        assert np.allclose(fit.coefficients.toArray(), path.coefficients[k][:4], atol=1e-6)
        assert abs(fit.intercept - path.intercepts[k]) < 1e-5
    d.unpersist()


def test_cross_validation_equals_fits_by_fold(rows, moments):
    path = G.lasso_path(moments, penalties=[0.5, 0.05])
    want = []
    for penalty in (0.5, 0.05):
        errors = []
        for fold in moments:
            x, y, mean = imputed([r for r in rows if r[0] != fold])
            held, held_y, _ = imputed([r for r in rows if r[0] == fold], mean)
            sd = np.where(x.std(0, ddof=1) > 1e-9, x.std(0, ddof=1), 1)
            z, w = (x - mean) / sd, np.zeros(5)
            for _ in range(500):  # coordinate descent on the rows themselves
                for j in range(5):
                    s = (z[:, j] ** 2).mean()
                    rho = (z[:, j] * (y - y.mean() - z @ w)).mean() + s * w[j]
                    w[j] = np.sign(rho) * max(abs(rho) - penalty, 0) / s if s > 1e-12 else 0
            errors.append(np.sqrt(((held_y - y.mean() - ((held - mean) / sd) @ w) ** 2).mean()))
        want.append(np.mean(errors))
    assert np.allclose(path.cv_rmse, want, atol=1e-8) and path.best == int(np.argmin(want))


def test_no_rows_and_one_fold(spark, rows):
    d = spark.createDataFrame([(0, *r[1:]) for r in rows],
                              "fold int, y double, a double, b double, c double, same double, none double")
    one = G.collect_moments(G.fold_moments(d, X, "y", "fold"), len(X))
    assert list(one) == [0] and np.diff(G.lasso_path(one).cv_rmse).max() < 1e-9
    assert G.fold_moments(d.limit(0), X, "y", "fold").count() == 0


def test_folds_differ_by_one_at_most(spark):
    from stayline.operators.splits import kfold
    d = spark.range(1003).select(F.col("id"), F.explode(F.sequence(F.lit(1), F.pmod("id", F.lit(3)) + 1)).alias("row"))
    f = kfold(d, "id", 5, seed=1)
    sizes = [r[0] for r in f.select("id", "fold").distinct().groupBy("fold").count().select("count").collect()]
    assert sorted(sizes) == [200, 200, 201, 201, 201] and f.count() == d.count()
