"""Tree ensembles as node arrays: scores, stages, attributions and dependence in Arrow batches.

Every function makes one narrow pass over its rows and carries the arrays in its closure; what
it shuffles is a few sums per task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Margins are counted in so many equal bins between -SPAN and SPAN for a rank statistic.
MARGIN_BINS, SPAN = 1 << 14, 12.0
_STAGE_BINS = 1 << 10


@dataclass(frozen=True)
class Trees:
    """Binary trees as arrays, trees x nodes.

    Rows with ``x[feature] <= threshold`` and missing values go left; a leaf is its own child.
    ``value`` holds the margin of a leaf, ``cover`` the training weight that reached a node and
    ``gain`` what its split gained. Margins are log odds.
    """

    features: tuple[str, ...]
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    cover: np.ndarray
    gain: np.ndarray
    bias: float = 0.0

    ARRAYS = ("feature", "threshold", "left", "right", "value", "cover", "gain")

    def __len__(self) -> int:
        return len(self.value)

    @property
    def depth(self) -> int:
        """Splits on the longest path."""
        return int(math.log2(self.value.shape[1] + 1)) - 1 if len(self) else 0

    def first(self, n: int) -> Trees:
        """The first ``n`` trees."""
        return Trees(self.features, *[getattr(self, a)[:n] for a in self.ARRAYS], self.bias)

    def leaves(self, x: np.ndarray, tree: int) -> np.ndarray:
        """The leaf of one tree that each row of ``x`` (rows x features) reaches."""
        at = np.zeros(len(x), np.int64)
        rows = np.arange(len(x))
        feature, threshold, left, right = (a[tree] for a in (self.feature, self.threshold, self.left, self.right))
        for _ in range(self.depth):
            at = np.where(x[rows, feature[at]] > threshold[at], right[at], left[at])  # NaN: not greater
        return at

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.bias)
        for t in range(len(self)):
            out += self.value[t][self.leaves(x, t)]
        return out

    def proba(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x)))

    def importance(self) -> np.ndarray:
        """Gain of all splits by feature."""
        return np.bincount(self.feature.ravel(), self.gain.ravel(), len(self.features))

    def to_dict(self) -> dict:
        arrays = {a: getattr(self, a).tolist() for a in self.ARRAYS}
        return {"features": list(self.features), "bias": self.bias, **arrays}

    @staticmethod
    def from_dict(d: dict) -> Trees:
        width = len(d["feature"][0]) if d["feature"] else 1
        arrays = []
        for a in Trees.ARRAYS:
            kind = np.int64 if a in ("feature", "left", "right") else np.float64
            arrays.append(np.array(d[a], kind).reshape(-1, width))
        return Trees(tuple(d["features"]), *arrays, d["bias"])


# -- rows as matrices --------------------------------------------------------------------


def feature_array(columns: Sequence[Column]) -> Column:
    """Features of a row as one array; ``matrix`` reads it."""
    return F.array(*[c.cast("double") for c in columns])


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows x features; nulls become NaN."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), width)


def probabilities(models: Sequence[Trees], features: Sequence[Column]) -> Column:
    """``array<double>``: the probability of every model, whose features are positions in ``features``.

    One Arrow function for all models; nothing but the features goes to Python.
    """
    width = len(features)

    @F.arrow_udf("array<double>")
    def score(x: pa.Array) -> pa.Array:
        m = matrix(x, width)
        out = np.stack([t.proba(m) for t in models], axis=1) if len(m) else np.zeros((0, len(models)))
        offsets = np.arange(0, (len(m) + 1) * len(models), len(models), dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(out.ravel()))

    return score(feature_array(features))


def with_features(trees: Trees, features: Sequence[str]) -> Trees:
    """The same trees over other positions, so that several models can share one row."""
    place = np.array([features.index(f) for f in trees.features] or [0], np.int64)
    return Trees(tuple(features), place[trees.feature], *[getattr(trees, a) for a in Trees.ARRAYS[1:]], trees.bias)


# -- stages ------------------------------------------------------------------------------


def _bins(margin: np.ndarray, n: int) -> np.ndarray:
    return np.clip(((margin + SPAN) * (n / (2 * SPAN))).astype(np.int64), 0, n - 1)


def binned_auc(positive: np.ndarray, negative: np.ndarray) -> float:
    """Area under the ROC curve from class weights by rising margin bin; ties count half."""
    below = np.cumsum(negative) - negative
    pairs = positive.sum() * negative.sum()
    return float((positive * (below + negative / 2)).sum() / pairs) if pairs else 0.5


def class_bins(margin: np.ndarray, label: np.ndarray, weight: np.ndarray, n: int = MARGIN_BINS) -> np.ndarray:
    """2 x n weights of the positive and the negative rows by margin bin."""
    at = _bins(margin, n)
    return np.stack([np.bincount(at, weight * label, n), np.bincount(at, weight * (1 - label), n)])


def stages(trees: Trees, df: DataFrame, label: str, weight: Column | None = None, features: Sequence[Column] | None = None) -> DataFrame:
    """``trees, auc, log_loss`` of every prefix of the ensemble, all in one pass over ``df``.

    A running margin per row takes one tree after the other; a task gives its class weights by
    margin bin and its loss, once per prefix.
    """
    cols = list(features) if features else [F.col(f"`{f}`") for f in trees.features]
    width = len(cols)
    w = F.lit(1.0) if weight is None else weight.cast("double")
    src = df.select(feature_array(cols).alias("x"), F.col(f"`{label}`").cast("double").alias("y"), w.alias("w"))
    n = len(trees)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, loss = np.zeros((n + 1, 2, _STAGE_BINS)), np.zeros(n + 1)
        for batch in batches:
            x, y, wt = matrix(batch.column(0), width), *[batch.column(i).to_numpy() for i in (1, 2)]
            margin = np.full(len(x), trees.bias)
            for t in range(n + 1):
                if t:
                    margin += trees.value[t - 1][trees.leaves(x, t - 1)]
                counts[t] += class_bins(margin, y, wt, _STAGE_BINS)
                loss[t] += (wt * (np.logaddexp(0, margin) - y * margin)).sum()
        cells = pa.array([c.tobytes() for c in counts])
        yield pa.RecordBatch.from_arrays([pa.array(range(n + 1), pa.int32()), cells, pa.array(loss)], ["trees", "counts", "loss"])

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        counts = sum(np.frombuffer(c.as_py()).reshape(2, -1) for c in table.column("counts"))
        loss = sum(table.column("loss").to_numpy()) / max(counts.sum(), 1e-300)
        return pa.table({"trees": [key[0].as_py()], "auc": [binned_auc(*counts)], "log_loss": [loss]}).cast(
            pa.schema([("trees", pa.int32()), ("auc", pa.float64()), ("log_loss", pa.float64())])
        )

    parts = src.mapInArrow(measure, "trees int, counts binary, loss double")
    return parts.groupBy("trees").applyInArrow(merge, "trees int, auc double, log_loss double")


# -- attributions ------------------------------------------------------------------------


@lru_cache(maxsize=64)
def _weights(m: int) -> np.ndarray:
    """Shapley weight of a coalition of k of the other m - 1 players."""
    return np.array([math.factorial(k) * math.factorial(m - 1 - k) / math.factorial(m) for k in range(m)])


def _leaf_shares(zeros: np.ndarray, value: float) -> np.ndarray:
    """Shares of m path features in a leaf, for each of the 2**m patterns of conditions that hold.

    The leaf is worth ``value`` times, per feature, 1 or 0 where it is known and its cover share where
    not. Coalitions are summed by size in the coefficients of a product of linear terms.
    """
    m = len(zeros)
    ones = (np.arange(1 << m)[:, None] >> np.arange(m)) & 1
    out = np.empty((1 << m, m))
    for j in range(m):
        poly = np.zeros((1 << m, m))
        poly[:, 0] = 1.0
        size = 0
        for i in range(m):
            if i != j:
                size += 1
                poly[:, 1 : size + 1] = poly[:, 1 : size + 1] * zeros[i] + poly[:, :size] * ones[:, i : i + 1]
                poly[:, 0] *= zeros[i]
        out[:, j] = value * (ones[:, j] - zeros[j]) * (poly @ _weights(m))
    return out


class Attribution:
    """Path attributions of an ensemble; the tables of its leaves are made once."""

    def __init__(self, trees: Trees):
        self.width = len(trees.features)
        self.paths = []  # per leaf: feature numbers, their conditions and the table of shares
        self.expected = trees.bias
        for t in range(len(trees)):
            feature, threshold, left, right = (a[t] for a in (trees.feature, trees.threshold, trees.left, trees.right))
            stack = [(0, [])]
            while stack:
                node, path = stack.pop()
                if left[node] == node:
                    self._leaf(path, trees.value[t][node])
                    continue
                total = trees.cover[t][left[node]] + trees.cover[t][right[node]]
                for child, low in ((left[node], True), (right[node], False)):
                    share = trees.cover[t][child] / total if total else 0.5
                    stack.append((child, [*path, (int(feature[node]), float(threshold[node]), low, share)]))

    def _leaf(self, path: list[tuple], value: float) -> None:
        names = sorted({f for f, *_ in path})
        zeros = np.array([math.prod(s for f, _, _, s in path if f == name) for name in names])
        self.expected += value * float(zeros.prod())
        if names and value:
            conditions = [[(threshold, low) for f, threshold, low, _ in path if f == name] for name in names]
            self.paths.append((names, conditions, _leaf_shares(zeros, value)))

    def values(self, x: np.ndarray) -> np.ndarray:
        """Rows x features; a row's values and ``expected`` add up to its margin."""
        out = np.zeros((len(x), self.width))
        for names, conditions, table in self.paths:
            pattern = np.zeros(len(x), np.int64)
            for i, (name, tests) in enumerate(zip(names, conditions, strict=True)):
                col = x[:, name]
                met = np.ones(len(x), bool)
                for threshold, low in tests:
                    over = col > threshold
                    met &= ~over if low else over
                pattern |= met.astype(np.int64) << i
            out[:, names] += table[pattern]
        return out


def attributions(trees: Trees, df: DataFrame, key: str, features: Sequence[Column] | None = None) -> DataFrame:
    """``key, expected, shares``: per row the attribution of every feature, in order of ``trees.features``."""
    cols = list(features) if features else [F.col(f"`{f}`") for f in trees.features]
    width = len(cols)
    paths = Attribution(trees)

    @F.arrow_udf("array<double>")
    def share(x: pa.Array) -> pa.Array:
        values = paths.values(matrix(x, width))
        offsets = np.arange(0, (len(values) + 1) * width, width, dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel()))

    return df.select(f"`{key}`", F.lit(paths.expected).alias("expected"), share(feature_array(cols)).alias("shares"))


def mean_attributions(trees: Trees, df: DataFrame, features: Sequence[Column] | None = None) -> DataFrame:
    """``col_name, importance``: mean absolute attribution per feature over all rows.

    Tasks give one sum per feature.
    """
    cols = list(features) if features else [F.col(f"`{f}`") for f in trees.features]
    width = len(cols)
    paths, names = Attribution(trees), list(trees.features)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(len(names)), 0
        for batch in batches:
            total += np.abs(paths.values(matrix(batch.column(0), width))).sum(axis=0)
            n += batch.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(total), pa.array([n] * len(names))], ["col_name", "total", "n"])

    sums = df.select(feature_array(cols).alias("x")).mapInArrow(add, "col_name string, total double, n bigint")
    return sums.groupBy("col_name").agg((F.sum("total") / F.greatest(F.sum("n"), F.lit(1))).alias("importance"))


def dependence(trees: Trees, df: DataFrame, grids: dict[str, Sequence[float]], features: Sequence[Column] | None = None) -> DataFrame:
    """``variable, point_no, value, mean_proba``: mean probability with a feature set to each of its grid values.

    All features and grid values are scored inside the batches of one scan; rows are not copied
    through a shuffle. Trees without the feature keep their margin from the unchanged row.
    """
    cols = list(features) if features else [F.col(f"`{f}`") for f in trees.features]
    width = len(cols)
    points = [(f, i, float(v)) for f, values in grids.items() for i, v in enumerate(values)]
    names = list(trees.features)
    inside = {f: [t for t in range(len(trees)) if (trees.feature[t][trees.left[t] != np.arange(trees.left.shape[1])] == names.index(f)).any()] for f in grids}

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(len(points)), 0
        for batch in batches:
            x = matrix(batch.column(0), width)
            n += len(x)
            per_tree = np.stack([trees.value[t][trees.leaves(x, t)] for t in range(len(trees))]) if len(trees) else np.zeros((0, len(x)))
            whole = trees.bias + per_tree.sum(axis=0)
            k = 0
            for f, values in grids.items():
                rest = whole - per_tree[inside[f]].sum(axis=0)
                changed = x.copy()
                for v in values:
                    changed[:, names.index(f)] = v
                    margin = rest + sum((trees.value[t][trees.leaves(changed, t)] for t in inside[f]), np.zeros(len(x)))
                    total[k] += (1 / (1 + np.exp(-margin))).sum()
                    k += 1
        yield pa.RecordBatch.from_arrays([pa.array(range(len(points)), pa.int32()), pa.array(total), pa.array([n] * len(points), pa.int64())], ["p", "total", "n"])

    sums = df.select(feature_array(cols).alias("x")).mapInArrow(add, "p int, total double, n bigint")
    means = sums.groupBy("p").agg((F.sum("total") / F.greatest(F.sum("n"), F.lit(1))).alias("mean_proba"))
    table = df.sparkSession.createDataFrame([(i, f, no, v) for i, (f, no, v) in enumerate(points)], "p int, variable string, point_no int, value double")
    return F.broadcast(table).join(means, "p").select("variable", "point_no", "value", "mean_proba")  # one row per point
