"""Gradient boosting of binary labels with missing values.

Features are cut once into at most ``max_bins`` bins at approximate quantiles;
NULL and NaN have a bin of their own.  A level of a tree costs one aggregate:
the sums of gradients and Hessians by (node, feature, bin), made as small
arrays in the tasks and added up by Spark.  The best split of each node
maximises the regularised gain of second-order boosting, with missing values
tried on either side; the better side becomes the split's default direction.
Only these sums (nodes x features x bins, whatever the rows are) reach the
driver.  The margins of the trees so far are written to the shared folder every
``REWRITE`` rounds, so a row passes through few trees in each aggregate.

Rows without label are left out; a feature without any value is never split;
equal gains go to the first feature and bin, and to the left default."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayline.operators.ordered import _count_below
from stayline.session import materialize

REWRITE = 10
#: Gains within this relative distance are equal: sums of floats depend on their order.
SAME = 1e-9


@dataclass
class Tree:
    """Nodes as in a heap (children of i: 2i+1 and 2i+2); feature -1: a leaf."""
    depth: int
    feature: np.ndarray = field(init=False)
    bin: np.ndarray = field(init=False)
    left: np.ndarray = field(init=False)   # default direction of missing values
    value: np.ndarray = field(init=False)
    gain: np.ndarray = field(init=False)

    def __post_init__(self):
        n = 2 ** (self.depth + 1) - 1
        self.feature, self.bin = np.full(n, -1), np.zeros(n, int)
        self.left, self.value, self.gain = np.ones(n, bool), np.zeros(n), np.zeros(n)

    def node_of(self, bins: np.ndarray, missing: int, levels: int | None = None) -> np.ndarray:
        """The node that each row reaches after ``levels`` levels."""
        at, rows = np.zeros(len(bins), int), np.arange(len(bins))
        for _ in range(self.depth if levels is None else levels):
            f = self.feature[at]
            b = bins[rows, np.maximum(f, 0)]
            left = np.where(b == missing, self.left[at], b <= self.bin[at])
            at = np.where(f >= 0, 2 * at + np.where(left, 1, 2), at)
        return at


@dataclass
class Boosted:
    """A fitted model: cut values by feature, trees, and the missing bin's number."""
    features: list[str]
    cuts: list[list[float]]
    max_bins: int
    trees: list[Tree] = field(default_factory=list)

    def binned(self, df: DataFrame, keep: list[str]) -> DataFrame:
        """``keep`` and a tinyint column b0, b1, ... for each feature."""
        out = []
        for k, (c, cuts) in enumerate(zip(self.features, self.cuts)):
            x = F.col(c).cast("double")
            arr = F.array(*[F.lit(float(v)) for v in cuts]) if cuts else F.array().cast("array<double>")
            out.append(F.when(x.isNull() | F.isnan(x), self.max_bins).otherwise(_count_below(arr, x))
                       .cast("tinyint").alias(f"b{k}"))
        return df.select(*keep, *out)

    def margins(self, bins: np.ndarray, trees: list[Tree] | None = None) -> np.ndarray:
        out = np.zeros(len(bins))
        for t in self.trees if trees is None else trees:
            out += t.value[t.node_of(bins, self.max_bins)]
        return out

    def predict(self, df: DataFrame, name: str = "p1") -> DataFrame:
        """``df`` with the probability of label 1."""
        p, keep = len(self.features), df.columns
        schema = T.StructType([f for f in df.schema.fields if f.name != name]).add(name, "double")
        kept = [c for c in keep if c != name]

        def run(batches):
            for b in batches:
                bins = _matrix(b, p)
                prob = 1 / (1 + np.exp(-self.margins(bins)))
                yield pa.RecordBatch.from_arrays([*[b.column(c) for c in kept], pa.array(prob)], [*kept, name])
        return self.binned(df, kept).mapInArrow(run, schema)

    def importance(self) -> list[tuple[str, float, int]]:
        """(feature, mean gain of its splits, number of splits), best first."""
        gain, count = np.zeros(len(self.features)), np.zeros(len(self.features), int)
        for t in self.trees:
            inner = t.feature >= 0
            np.add.at(gain, t.feature[inner], t.gain[inner])
            np.add.at(count, t.feature[inner], 1)
        rows = [(c, float(g / n) if n else 0.0, int(n)) for c, g, n in zip(self.features, gain, count)]
        return sorted(rows, key=lambda r: (-r[1], r[0]))


def _matrix(b: pa.RecordBatch, p: int) -> np.ndarray:
    return np.column_stack([b.column(f"b{k}").to_numpy(zero_copy_only=False) for k in range(p)]).astype(int)


def _histograms(rows: DataFrame, model: Boosted, recent: list[Tree], tree: Tree, level: int) -> np.ndarray:
    """Sums of (gradient, Hessian) by node of the level, feature and bin."""
    p, bins_n, first = len(model.features), model.max_bins + 1, 2 ** level - 1
    shape = (2 ** level, p, bins_n)
    size = int(np.prod(shape))

    def run(batches):
        sums = np.zeros((2, size))
        for b in batches:
            bins, y = _matrix(b, p), b.column("y").to_numpy()
            w, margin = b.column("w").to_numpy(), b.column("margin").to_numpy() + model.margins(bins, recent)
            prob = 1 / (1 + np.exp(-margin))
            node = tree.node_of(bins, model.max_bins, level) - first
            here = (node >= 0) & (w > 0)  # others ended in a leaf above
            at = ((node[:, None] * p + np.arange(p)) * bins_n + bins)[here].ravel()
            for k, v in enumerate((w * (prob - y), w * prob * (1 - prob))):
                sums[k] += np.bincount(at, np.repeat(v[here], p), size)
        used = np.flatnonzero(sums[1])
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(sums[0, used]), pa.array(sums[1, used])],
                                         ["at", "g", "h"])
    out = np.zeros((2, size))
    for r in rows.mapInArrow(run, "at int, g double, h double").groupBy("at").agg(F.sum("g"), F.sum("h")).collect():
        out[:, r[0]] = r[1], r[2]
    return out.reshape(2, *shape)


def best_split(g: np.ndarray, h: np.ndarray, reg_lambda: float, gamma: float, min_child_weight: float):
    """(gain, feature, bin, missing go left) of the best split of one node from
    its sums by (feature, bin), the last bin being that of missing values; None
    if no split gains."""
    def score(a, b):
        return a * a / (b + reg_lambda)
    total_g, total_h = g[0].sum(), h[0].sum()
    best = None
    cum_g, cum_h = np.cumsum(g[:, :-1], 1)[:, :-1], np.cumsum(h[:, :-1], 1)[:, :-1]
    gains = []
    for left in (True, False):  # missing values to the left or right
        lg, lh = (cum_g + g[:, -1:], cum_h + h[:, -1:]) if left else (cum_g, cum_h)
        rg, rh = total_g - lg, total_h - lh
        ok = (lh >= min_child_weight) & (rh >= min_child_weight) & (lh > 0) & (rh > SAME * total_h)
        with np.errstate(all="ignore"):
            gain = 0.5 * (score(lg, lh) + score(rg, rh) - score(total_g, total_h)) - gamma
        gains.append(np.where(ok, gain, -np.inf))
    gains = np.stack(gains, -1)
    top = gains.max(initial=-np.inf)
    if top > SAME:
        f, b, d = np.argwhere(gains >= top - SAME * max(1.0, top))[0]
        best = float(gains[f, b, d]), int(f), int(b), d == 0
    return best


def fit(df: DataFrame, features: list[str], label: str = "label", weight: str | None = None, rounds: int = 50,
        depth: int = 3, eta: float = 0.1, reg_lambda: float = 1.0, gamma: float = 0.0, min_child_weight: float = 1.0,
        max_bins: int = 64) -> Boosted:
    """Fit boosted trees to 0/1 labels; no imputation comes before it."""
    if not 2 <= max_bins <= 126:
        raise ValueError("max_bins must be from 2 to 126")
    rows = df.filter(F.col(label).isNotNull())
    probs = [i / max_bins for i in range(1, max_bins)]
    xs = [F.col(c).cast("double") for c in features]
    found = rows.agg(*[F.percentile_approx(F.when(~F.isnan(x), x), probs, 10_000).alias(f"q{k}")
                       for k, x in enumerate(xs)]).first()
    model = Boosted(list(features), [sorted(set(q or [])) for q in found], max_bins)
    w = F.coalesce(F.col(weight).cast("double"), F.lit(0.0)) if weight else F.lit(1.0)
    base = rows.withColumns({"__y": F.col(label).cast("double"), "__w": w})
    state = model.binned(base, [F.col("__y").alias("y"), F.col("__w").alias("w"), F.lit(0.0).alias("margin")])
    state = materialize(state, "boosting")
    done = 0
    for _ in range(rounds):
        tree = Tree(depth)
        recent = model.trees[done:]
        for level in range(depth + 1):
            open_ = [i for i in range(2 ** level - 1, 2 ** (level + 1) - 1)
                     if level == 0 or tree.feature[(i - 1) // 2] >= 0]
            if not open_ or level == depth:
                break
            g, h = _histograms(state, model, recent, tree, level)
            for i in open_:
                k = i - (2 ** level - 1)
                split = best_split(g[k], h[k], reg_lambda, gamma, min_child_weight)
                if split is None:
                    continue
                tree.gain[i], f, b, left = split
                tree.feature[i], tree.bin[i], tree.left[i] = f, b, left
                lg, lh = (float(x[k, f, :b + 1].sum() + (x[k, f, -1] if left else 0)) for x in (g, h))
                for child, (a, c) in ((2 * i + 1, (lg, lh)), (2 * i + 2, (g[k, f].sum() - lg, h[k, f].sum() - lh))):
                    tree.value[child] = -eta * a / (c + reg_lambda)
        if tree.feature[0] < 0:
            break  # nothing gains any more
        model.trees.append(tree)
        if len(model.trees) - done >= REWRITE:
            state, done = materialize(_moved(state, model, model.trees[done:]), "boosting"), len(model.trees)
    return model


def _moved(state: DataFrame, model: Boosted, recent: list[Tree]) -> DataFrame:
    """``state`` with the margins after ``recent`` trees."""
    p, names = len(model.features), state.columns

    def run(batches):
        for b in batches:
            margin = b.column("margin").to_numpy() + model.margins(_matrix(b, p), recent)
            yield b.set_column(names.index("margin"), "margin", pa.array(margin))
    return state.mapInArrow(run, state.schema)
