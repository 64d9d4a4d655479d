"""Value bins, quantile bins and deciles."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reachmark.operators.ordering import Measure, OrderIndex, exact_quantiles

# Fixed edges of the score bins: multiples of 0.1 in double arithmetic.
SCORE_EDGES = tuple(i * 0.1 for i in range(11))


def cut(value: Column, edges: Sequence[float], right: bool = True, lowest: bool = True) -> Column:
    """Index (from 1) of the interval that holds ``value``; null outside all of them.

    ``right`` takes ``(lo, hi]``, else ``[lo, hi)``; ``lowest`` adds the first edge.
    """
    out: Column = F.lit(None).cast("int")
    if len(edges) < 2:
        return out
    # Ordered tests from the top edge down need one comparison per interval.
    inside = value <= edges[-1] if right else value < edges[-1]
    if right:
        above_first = value >= edges[0] if lowest else value > edges[0]
    else:
        above_first = value >= edges[0]
    chain = None
    for i in range(len(edges) - 2, 0, -1):
        test = value > edges[i] if right else value >= edges[i]
        chain = F.when(test, i + 1) if chain is None else chain.when(test, i + 1)
    first = F.lit(1) if chain is None else chain.otherwise(1)
    return F.when(inside & above_first, first)


def interval_label(index: Column, edges: Sequence[float], right: bool, digits: int = 3) -> Column:
    """Readable interval for a bin index."""
    left, close = ("(", "]") if right else ("[", ")")
    labels = [
        f"{left}{round(lo, digits)}, {round(hi, digits)}{close}"
        for lo, hi in zip(edges, edges[1:])
    ]
    return F.get(F.array(*[F.lit(x) for x in labels]), index - 1)


def with_score_bin(df: DataFrame, score: str, name: str = "score_bin") -> DataFrame:
    """Width-0.1 bins ``[lo, hi)``; a score of exactly 1.0 belongs to none."""
    return df.withColumn(name, cut(F.col(score), SCORE_EDGES, right=False))


@dataclass(frozen=True)
class QuantileBins:
    """Bins between quantiles of a column, duplicate edges dropped."""

    column: str
    edges: tuple[float, ...]

    @classmethod
    def fit(cls, df: DataFrame, column: str, n: int) -> QuantileBins:
        return cls.fit_many(df, [column], n)[column]

    @classmethod
    def fit_many(cls, df: DataFrame, columns: Sequence[str], n: int) -> dict[str, QuantileBins]:
        """Edges of several columns in the same three passes."""
        found = exact_quantiles(df, columns, [i / n for i in range(n + 1)])
        return {c: cls(c, tuple(sorted(set(found[c])))) for c in columns}

    @property
    def count(self) -> int:
        return max(len(self.edges) - 1, 0)

    def index(self) -> Column:
        return cut(F.col(self.column).cast("double"), self.edges)

    def transform(self, df: DataFrame, name: str) -> DataFrame:
        return df.withColumn(name, self.index())


def dense_rank_of(bins: DataFrame, name: str, ascending: bool = False) -> Column:
    """Dense rank of a bin among the bins that occur, for a frame that holds few bins.

    The occurring bins come from a one-row subquery, not from a window over the rows.
    """
    present = bins.select(F.sort_array(F.collect_set(name), asc=ascending).alias("present"))
    position = F.array_position(present.scalar(), F.col(name)).cast("int")
    return F.when(F.col(name).isNotNull(), position)


def with_quantile_decile(df: DataFrame, score: str, name: str = "decile", n: int = 10) -> DataFrame:
    """Value-quantile deciles, 1 for the highest scores."""
    bins = QuantileBins.fit(df, score, n)
    binned = bins.transform(df, "_bin")
    occurring = bins.transform(df.select(score), "_bin")
    return binned.withColumn(name, dense_rank_of(occurring, "_bin")).drop("_bin")


def with_rank_decile(
    df: DataFrame, score: str, key: str, name: str = "decile", n: int = 10
) -> DataFrame:
    """Equal-population deciles of the unique rank, 1 for the highest scores.

    Rows without a score get no decile.
    """
    index = OrderIndex.fit(df, [(score, True)], key, measures=[Measure("_n", "count", F.col(score))])
    ranked = sum(r["_n"] for r in index.totals)
    binned = index.bins(df, n, "_bin", total=ranked)
    return binned.withColumn(name, rank_decile("_bin", score, ranked, n)).drop("_bin")


def rank_decile(bin_name: str, score: str, ranked: int, n: int = 10) -> Column:
    """Decile of a rank bin; which bins occur follows from the row count alone."""
    present = {1}
    if ranked > 1:
        present = {max(1, math.ceil(n * (r - 1) / (ranked - 1))) for r in _edge_ranks(ranked, n)}
    place = {b: len(present) - i for i, b in enumerate(sorted(present))}
    deciles = F.array(*[F.lit(place.get(b)).cast("int") for b in range(1, n + 1)])
    return F.when(F.col(score).isNotNull(), F.get(deciles, F.col(bin_name) - 1))


def _edge_ranks(rows: int, n: int) -> range | list[int]:
    if rows <= 4 * n:
        return range(1, rows + 1)
    return [1 + (rows - 1) * i // n for i in range(n + 1)]


def running(df: DataFrame, order: Sequence[Column], sums: dict[str, str]) -> DataFrame:
    """Running sums over a grouped report (a handful of rows, one task)."""
    w = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumns({name: F.sum(c).over(w) for name, c in sums.items()})
