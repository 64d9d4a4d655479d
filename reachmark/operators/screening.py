"""Feature screens: missing, constant, collinear, inflated and clustered variables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reachmark.operators.profile import (
    corr_pairs,
    moments,
    null_profile,
    numeric_columns,
    pair_sums,
    spearman_matrix,
)


def screen_missing(df: DataFrame, threshold: float, cols: Sequence[str] | None = None) -> DataFrame:
    """Columns with a larger null share than the threshold."""
    return null_profile(df, cols, top=None).filter(F.col("null_share") > threshold)


def screen_single_unique(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Columns with exactly one distinct value: their minimum is their maximum."""
    cols = list(cols or df.columns)
    row = df.agg(*[F.coalesce(F.min(c) == F.max(c), F.lit(False)).alias(c) for c in cols])
    return row.unpivot([], cols, "variable", "single").filter("single").select("variable")


def screen_collinear(df: DataFrame, cols: Sequence[str], threshold: float) -> DataFrame:
    """Columns that correlate above the threshold with any earlier column."""
    hits = corr_pairs(df, cols).filter(F.abs("corr") > threshold)
    return hits.groupBy("b").agg(F.max(F.abs("corr")).alias("max_abs_corr")).select(
        F.col("b").alias("variable"), "max_abs_corr"
    )


def vif(df: DataFrame, cols: Sequence[str] | None = None, fixed: Sequence[str] = ()) -> DataFrame:
    """Variance inflation without intercept, nulls as 0, from one pass over the products.

    Only the p x p product sums reach the driver.
    """
    cols = [c for c in (cols or numeric_columns(df)) if c not in set(fixed)]
    p = len(cols)
    x = df.select(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in cols])
    gram = np.zeros((p, p))
    for r in pair_sums(x, cols).select("i", "j", "sxy").collect():
        gram[r["i"], r["j"]] = gram[r["j"], r["i"]] = r["sxy"]
    scale = np.sqrt(np.diag(gram))
    scale[scale == 0] = 1.0
    unit = gram / np.outer(scale, scale)
    try:
        values = np.diag(np.linalg.inv(unit)) * np.diag(unit)
    except np.linalg.LinAlgError:
        values = np.full(p, np.inf)
    rows = [(c, float(v)) for c, v in zip(cols, values)]
    return df.sparkSession.createDataFrame(rows, "variable string, vif double")


def screen_vif(df: DataFrame, cols: Sequence[str], threshold: float, fixed: Sequence[str] = ()):
    """All columns whose inflation is above the threshold."""
    return vif(df, cols, fixed).filter(F.col("vif") > threshold)


def log_suggestion(df: DataFrame, cols: Sequence[str], skew: float = 1.0) -> list[str]:
    """Columns worth a log: skewed right, not negative and not two-valued.

    A column is two-valued when every value is its minimum or its maximum, which a second
    narrow pass over the few skewed candidates tells without counting distinct values.
    """
    stats = moments(df, cols).filter((F.col("skew") > skew) & (F.col("min") >= 0))
    found = {r["variable"] for r in stats.select("variable").collect()}  # one row per column
    candidates = [c for c in cols if c in found]
    if not candidates:
        return []
    ends = df.agg(*[F.struct(F.min(c), F.max(c)) for c in candidates]).first()
    between = df.agg(
        *[F.count_if(~F.col(c).isin(lo, hi)) for c, (lo, hi) in zip(candidates, ends)]
    ).first()
    return [c for c, n in zip(candidates, between) if n > 0]


@dataclass
class ScreenResult:
    kept: list[str]
    dropped: dict[str, list[str]] = field(default_factory=dict)


def feature_screen(
    df: DataFrame,
    missing_threshold: float = 0.99,
    fixed: Sequence[str] = (),
    exclude: Sequence[str] = (),
) -> ScreenResult:
    """Exclusion, missing and single-value screens in one profiling aggregation."""
    cols = [c for c in df.columns if c not in set(exclude)]
    row = df.agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count(c).alias(f"n_{i}") for i, c in enumerate(cols)],
        *[(F.min(c) == F.max(c)).alias(f"s_{i}") for i, c in enumerate(cols)],
    ).first()
    keep = set(fixed)
    missing, single = [], []
    for i, c in enumerate(cols):
        if c in keep:
            continue
        if row["_n"] and 1 - row[f"n_{i}"] / row["_n"] > missing_threshold:
            missing.append(c)
        elif row[f"s_{i}"]:
            single.append(c)
    gone = set(missing) | set(single)
    return ScreenResult(
        [c for c in cols if c not in gone],
        {
            "excluded": [c for c in df.columns if c in set(exclude)],
            "missing": missing,
            "single_unique": single,
        },
    )


def screen_waterfall(df: DataFrame, result: ScreenResult) -> DataFrame:
    """Variables at the start, dropped per step, and left."""
    steps = [("start", len(df.columns))]
    steps += [(name, len(cols)) for name, cols in result.dropped.items()]
    steps.append(("kept", len(result.kept)))
    rows = [(i, name, n) for i, (name, n) in enumerate(steps)]
    return df.sparkSession.createDataFrame(rows, "step_no int, step string, variables long")


def _ward(points: np.ndarray) -> list[tuple[int, int, float]]:
    """Merges (cluster, cluster, height) of Ward's method over the rows of a small matrix."""
    gap = ((points[:, None, :] - points[None, :, :]) ** 2).sum(-1)
    np.fill_diagonal(gap, np.inf)
    size = np.ones(len(points))
    merges = []
    for _ in range(len(points) - 1):
        a, b = np.unravel_index(np.argmin(gap), gap.shape)
        d = gap[a, b]
        merges.append((int(a), int(b), float(np.sqrt(d))))
        n = size[a] + size[b] + size
        joined = ((size[a] + size) * gap[a] + (size[b] + size) * gap[b] - size * d) / n
        gap[a], gap[:, a] = joined, joined
        gap[a, a] = np.inf
        gap[b], gap[:, b] = np.inf, np.inf
        size[a] += size[b]
    return merges


def _clusters(merges: list[tuple[int, int, float]], p: int, height: float) -> list[int]:
    root = list(range(p))

    def top(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    for a, b, h in merges:
        if h <= height:
            root[top(b)] = top(a)
    seen: dict[int, int] = {}
    return [seen.setdefault(top(i), len(seen) + 1) for i in range(p)]


def variable_clusters(
    df: DataFrame, cols: Sequence[str], key: str, max_clusters: int = 100, rounds: int = 60
) -> DataFrame:
    """Variables grouped by Ward's method on the rows of their rank correlation matrix.

    The matrix is computed distributed; the cut height is searched until between p/6 and
    p/5 clusters remain (or the search runs out of rounds).
    """
    cols = list(cols)
    p = len(cols)
    corr = np.eye(p)
    for r in spearman_matrix(df, cols, key).collect():  # p x p
        i, j = cols.index(r["a"]), cols.index(r["b"])
        corr[i, j] = corr[j, i] = 0.0 if r["corr"] is None else r["corr"]
    merges = _ward(corr)
    low, high = max(1, p // 6), max(1, p // 5)
    if low > max_clusters:
        low, high = int(max_clusters * 0.9), int(max_clusters * 1.1)
    height, lower, upper = 0.1, 0.0, None
    ids = _clusters(merges, p, height)
    for _ in range(rounds):
        found = len(set(ids))
        if low <= found <= high:
            break
        if found > high:
            lower, height = height, height * 2 if upper is None else (height + upper) / 2
        else:
            upper, height = height, (lower + height) / 2
        ids = _clusters(merges, p, height)
    return df.sparkSession.createDataFrame(
        list(zip(cols, ids)), "variable string, cluster int"
    ).orderBy("cluster", "variable")
