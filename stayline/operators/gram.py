"""Linear models from moments by fold.

One pass over the rows gives, for each fold, the sums of all products of the
vector (1, label, features with NULL as 0, whether each is observed).  These
moments add up, so those of "every fold but one" are the total less that
fold's, and with them come the training means, the centred and scaled Gram
matrix after mean imputation, and the squared error of any coefficients on the
fold left out: nothing is read again for a fold or a penalty.  The lasso path
is coordinate descent on the p x p Gram matrix, from the least penalty that
leaves all coefficients at 0 downwards, each solution starting the next.

The matrices have (2 p + 2)^2 numbers a fold whatever the rows are.  NULL
labels are left out; a NULL fold is a fold of its own; features must be
numeric (NaN counts as NULL); no rows give no moments."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOLERANCE = 1e-12
MAX_SWEEPS = 100_000
SOLVE_EVERY = 10


def fold_moments(df: DataFrame, features: list[str], label: str, fold: str) -> DataFrame:
    """(fold, i, j, value): sums over the fold's rows of v[i] v[j] for
    v = (1, label, x_1 .., observed_1 ..).  Tasks add up matrices of products,
    of which only sums are shuffled."""
    size = 2 * len(features) + 2
    cols = [F.col(fold).cast("long").alias("fold"), F.col(label).cast("double").alias("y"),
            *[F.col(c).cast("double").alias(f"x{k}") for k, c in enumerate(features)]]

    def run(batches):
        sums: dict = {}
        for b in batches:
            fold_of = np.array(b.column(0).to_pylist(), dtype=object)
            v = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in b.columns[1:]])
            seen = ~np.isnan(v[:, 1:])
            v = np.column_stack([np.ones(len(v)), v[:, 0], np.where(seen, v[:, 1:], 0.0), seen])
            for f in set(fold_of.tolist()):
                x = v[np.array([g == f for g in fold_of], bool)]
                sums[f] = sums.get(f, 0) + x.T @ x
        at = np.indices((size, size)).reshape(2, -1)
        for f, m in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([f] * size ** 2, pa.int64()), pa.array(at[0], pa.int32()),
                                              pa.array(at[1], pa.int32()), pa.array(m.ravel())], ["fold", "i", "j", "value"])
    rows = df.select(*cols).filter(F.col("y").isNotNull() & ~F.isnan("y"))
    parts = rows.mapInArrow(run, "fold long, i int, j int, value double")
    return parts.groupBy("fold", "i", "j").agg(F.sum("value").alias("value"))


def collect_moments(moments: DataFrame, n_features: int) -> dict[int | None, np.ndarray]:
    """Fold -> matrix of moments; (2 p + 2)^2 numbers a fold."""
    out: dict = {}
    for r in moments.collect():
        out.setdefault(r["fold"], np.zeros((2 * n_features + 2,) * 2))[r["i"], r["j"]] = r["value"]
    return out


@dataclass
class Standardised:
    """Training statistics after mean imputation: means, sample deviations and
    the Gram matrix and label products of the scaled features, per row."""
    n: float
    mean: np.ndarray
    std: np.ndarray
    y_mean: float
    gram: np.ndarray
    xy: np.ndarray

    @classmethod
    def of(cls, m: np.ndarray) -> Standardised:
        p = len(m) // 2 - 1
        x, o, n = slice(2, 2 + p), slice(2 + p, 2 + 2 * p), m[0, 0]
        seen = m[0, o]
        mean = np.divide(m[0, x], seen, out=np.zeros(p), where=seen > 0)
        y_mean = m[0, 1] / n
        # Sums of (x_i - mean_i)(x_j - mean_j) where both are observed; imputed places add nothing.
        both, once = m[o, o], m[x, o]
        c = m[x, x] - once * mean[None, :] - once.T * mean[:, None] + both * np.outer(mean, mean)
        cy = m[x, 1] - y_mean * m[0, x] - mean * (m[o, 1] - y_mean * seen)
        var = np.maximum(np.diag(c), 0) / max(n - 1, 1)
        tiny = 1e-12 * np.maximum(1.0, mean ** 2)  # what rounding leaves of a constant
        std = np.where(var > tiny, np.sqrt(var), 0.0)
        scale = np.divide(1.0, std, out=np.zeros(p), where=std > 0)
        return cls(n, mean, std, y_mean, c * np.outer(scale, scale) / n, cy * scale / n)

    def max_penalty(self) -> float:
        """The least penalty at which every coefficient is 0."""
        return float(np.abs(self.xy).max(initial=0.0))

    def lasso(self, penalty: float, start: np.ndarray | None = None) -> np.ndarray:
        """Coefficients w of the scaled features that minimise
        (y - X w)^2 / 2n + penalty |w|, by coordinate descent."""
        w = np.zeros(len(self.xy)) if start is None else start.copy()
        diag = np.diag(self.gram)
        active = np.flatnonzero(diag > 0)
        gradient = self.xy - self.gram @ w
        for sweep in range(MAX_SWEEPS):
            if sweep % SOLVE_EVERY == 1:
                exact = self._solved(w, penalty)
                if exact is not None:
                    return exact
            moved = 0.0
            for j in active:
                rho = gradient[j] + diag[j] * w[j]
                new = np.sign(rho) * max(abs(rho) - penalty, 0.0) / diag[j]
                if new != w[j]:
                    gradient -= self.gram[:, j] * (new - w[j])
                    moved = max(moved, abs(new - w[j]))
                    w[j] = new
            if moved <= TOLERANCE * max(1.0, np.abs(w).max(initial=0.0)):
                break
        return w

    def _solved(self, w: np.ndarray, penalty: float) -> np.ndarray | None:
        """The solution with the signs of ``w``, if these are the right ones:
        correlated features need very many sweeps to get there."""
        a = np.flatnonzero(w)
        sign = np.sign(w[a])
        out = np.zeros(len(w))
        try:
            out[a] = np.linalg.solve(self.gram[np.ix_(a, a)], self.xy[a] - penalty * sign)
        except np.linalg.LinAlgError:
            return None
        gradient = np.abs(self.xy - self.gram @ out)
        right = (np.sign(out[a]) == sign).all() and gradient.max(initial=0.0) <= penalty * (1 + 1e-9) + 1e-14
        return out if right else None

    def path(self, penalties: np.ndarray) -> list[np.ndarray]:
        """Solutions for descending penalties, each from the one before."""
        out, w = [], None
        for penalty in penalties:
            w = self.lasso(penalty, w)
            out.append(w)
        return out

    def coefficients(self, w: np.ndarray) -> tuple[np.ndarray, float]:
        """(coefficients, intercept) on the features' own scale, NULLs imputed by the means."""
        raw = np.divide(w, self.std, out=np.zeros(len(w)), where=self.std > 0)
        return raw, float(self.y_mean - raw @ self.mean)

    def squared_error(self, w: np.ndarray, m: np.ndarray) -> float:
        """Sum of squared residuals over the rows that moments ``m`` are of."""
        raw = np.divide(w, self.std, out=np.zeros(len(w)), where=self.std > 0)
        c = np.concatenate([[-self.y_mean, 1.0], -raw, raw * self.mean])
        return max(float(c @ m @ c), 0.0)


@dataclass
class LassoPath:
    """Penalties (descending), the mean over folds of the held-out RMSE for
    each, and the solutions on all rows."""
    penalties: np.ndarray
    cv_rmse: np.ndarray
    coefficients: list[np.ndarray]
    intercepts: list[float]

    @property
    def best(self) -> int:
        """Index of the least error, the larger penalty of equal ones."""
        return int(np.argmin(self.cv_rmse))


def lasso_path(moments: dict[int | None, np.ndarray], n_penalties: int = 100, least: float = 1e-3,
               penalties: list[float] | None = None) -> LassoPath:
    """The path over ``n_penalties`` penalties, spaced evenly in logarithm
    down to ``least`` times the greatest one, with the error of each fold
    predicted from the others.  Without two folds the error is that on the rows themselves."""
    total = sum(moments.values())
    whole = Standardised.of(total)
    grid = np.array(sorted(penalties, reverse=True)) if penalties else whole.max_penalty() * np.logspace(
        0, np.log10(least), n_penalties)
    errors = []
    for m in moments.values():
        train = Standardised.of(total - m) if len(moments) > 1 else whole
        errors.append([np.sqrt(train.squared_error(w, m) / m[0, 0]) for w in train.path(grid)])
    fits = [whole.coefficients(w) for w in whole.path(grid)]
    return LassoPath(grid, np.mean(errors, axis=0), [f[0] for f in fits], [f[1] for f in fits])
