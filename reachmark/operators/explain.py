"""Feature attribution and partial dependence."""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reachmark.operators import trees as TR
from reachmark.operators.boosted import BoostedModel
from reachmark.operators.ordering import exact_quantiles

CAP_QUANTILE = 0.95
#: Features up to which every subset is scored.
SUBSET_FEATURES = 12


def _ranked(sums: DataFrame, cols: Sequence[str]) -> DataFrame:
    table = sums.unpivot([], list(cols), "col_name", "importance")
    order = Window.orderBy(F.desc("importance"), "col_name")
    return table.withColumn("rank", F.row_number().over(order))  # one row per feature


def _means(df: DataFrame, cols: Sequence[str]) -> dict[str, float]:
    row = df.agg(*[F.avg(F.col(c).cast("double")) for c in cols]).first()
    return {c: float(m or 0.0) for c, m in zip(cols, row)}


def shapley_linear(df: DataFrame, coefficients: dict[str, float]) -> DataFrame:
    """Mean absolute attribution per feature of a linear model: |b (x - mean)|, exact."""
    means = _means(df, list(coefficients))
    sums = df.agg(
        *[
            F.avg(F.abs((F.col(c) - means[c]) * b)).alias(c)
            for c, b in coefficients.items()
        ]
    )
    return _ranked(sums, list(coefficients))


def shapley_trees(model: BoostedModel, df: DataFrame) -> DataFrame:
    """Mean absolute attribution per feature of a boosted model over all rows, ranked.

    Attributions follow the paths of the trees: what is not known of a row is averaged by the training
    weight that reached each branch. The work grows with the leaves and the depth, not with the
    subsets of the features, and tasks give one sum per feature.
    """
    rows, features = model.with_features(df)
    sums = TR.mean_attributions(model.trees, rows, features)
    order = Window.orderBy(F.desc("importance"), "col_name")
    return sums.withColumn("rank", F.row_number().over(order))  # one row per feature


def attribution_rows(model: BoostedModel, df: DataFrame, key: str) -> DataFrame:
    """``key, expected, shares``: attributions of every row, in order of ``model.trees.features``."""
    rows, features = model.with_features(df)
    return TR.attributions(model.trees, rows, key, features)


def shapley_mc(
    df: DataFrame,
    score: Callable[[DataFrame], DataFrame],
    features: Sequence[str],
    key: str,
    orders: int | None = None,
    seed: int = 25,
) -> DataFrame:
    """Mean absolute Shapley value per numeric feature of any model.

    A row is scored with subsets of its features in place, the others at their means. All rows
    take part. With ``orders`` None every subset is scored once and the result is exact, for up
    to ``SUBSET_FEATURES`` features; a number draws that many orders of the features, the same for every
    row, and scores their prefixes. ``score`` adds ``proba`` and keeps other columns. For
    boosted models ``shapley_trees`` needs neither.
    """
    features = list(features)
    means = _means(df, features)
    n = len(features)
    weights: dict[str, dict[frozenset, float]] = {f: {} for f in features}

    def add(f: str, coalition: frozenset, weight: float) -> None:
        weights[f][coalition] = weights[f].get(coalition, 0.0) + weight

    if orders is None:
        if n > SUBSET_FEATURES:
            raise ValueError(f"{n} features have {2**n} subsets; give a number of orders")
        for f in features:
            rest = [g for g in features if g != f]
            for k in range(n):
                for s in map(frozenset, combinations(rest, k)):
                    w = math.factorial(k) * math.factorial(n - 1 - k) / math.factorial(n)
                    add(f, s | {f}, w)
                    add(f, s, -w)
    else:
        rng = random.Random(seed)
        for _ in range(orders):
            path = rng.sample(features, n)
            for i, f in enumerate(path):
                add(f, frozenset(path[: i + 1]), 1 / orders)
                add(f, frozenset(path[:i]), -1 / orders)
    # Coalitions are shared between features: each distinct one is scored once per row.
    coalitions = sorted({s for w in weights.values() for s in w}, key=lambda s: (len(s), sorted(s)))
    number = {s: i for i, s in enumerate(coalitions)}
    cells = [
        F.struct(
            F.lit(i).alias("_set"),
            *[
                (F.col(f).cast("double") if f in s else F.lit(means[f])).alias(f)
                for f in features
            ],
        )
        for s, i in number.items()
    ]
    rest = [c for c in df.columns if c not in features]
    spread = df.select(*rest, F.inline(F.array(*cells)))
    scored = score(spread)
    # A row's share is a weighted sum of its scores: one sum per row and feature.
    shares = {}
    for f in features:
        listed = F.array(*[F.lit(weights[f].get(s, 0.0)) for s in coalitions])
        shares[f] = F.sum(F.col("proba") * F.get(listed, F.col("_set"))).alias(f)
    wide = scored.groupBy(key).agg(*shares.values())
    sums = wide.agg(*[F.avg(F.abs(F.col(f))).alias(f) for f in features])
    return _ranked(sums, features)


def dependence_trees(model: BoostedModel, df: DataFrame, features: Sequence[str], grid: int = 10) -> DataFrame:
    """``partial_dependence`` of a boosted model's numeric features, all in one scan behind the grid ends."""
    ends = exact_quantiles(df, features, [0.0, CAP_QUANTILE])
    grids = {f: _points(*ends[f], grid) for f in features}
    rows, columns = model.with_features(df)
    return TR.dependence(model.trees, rows, grids, columns)


def _points(low: float, high: float, grid: int) -> list[float]:
    return [low + (high - low) * i / (grid - 1) for i in range(grid)]


def partial_dependence(
    df: DataFrame,
    score: Callable[[DataFrame], DataFrame],
    features: Sequence[str],
    grid: int = 10,
) -> DataFrame:
    """Mean score over all rows with a feature set to each value of a grid.

    The grid runs from the minimum to the 95th percentile. All features share one scan and one
    shuffle: a row is exploded once into the changed rows of every feature, and scores are
    averaged before the shuffle. ``score`` adds ``proba`` and keeps other columns.
    """
    features = list(features)
    ends = exact_quantiles(df, features, [0.0, CAP_QUANTILE])
    cells = []
    for v, f in enumerate(features):
        for i, x in enumerate(_points(*ends[f], grid)):
            changed = [F.lit(x).alias(g) if g == f else F.col(f"`{g}`").cast("double").alias(g) for g in features]
            cells.append(F.struct(F.lit(v).alias("_variable"), F.lit(i).alias("_no"), F.lit(x).alias("_value"), *changed))
    rest = [c for c in df.columns if c not in features]
    scored = score(df.select(*rest, F.inline(F.array(*cells))))
    means = scored.groupBy("_variable", "_no", "_value").agg(F.avg("proba").alias("mean_proba"))
    names = F.array(*[F.lit(f) for f in features])
    return means.select(F.get(names, F.col("_variable")).alias("variable"), F.col("_no").alias("point_no"), F.col("_value").alias("value"), "mean_proba")
