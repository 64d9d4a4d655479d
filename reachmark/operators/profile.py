"""Column profiles, moments and correlation."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reachmark.operators.ordering import average_ranks, exact_quantiles


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def _long(df: DataFrame, cells: Sequence[Column]) -> DataFrame:
    return df.select(F.inline(F.array(*cells)))


def long_values(df: DataFrame, cols: Sequence[str], keep: Sequence[Column] = (), text: bool = True):
    """(variable, value) rows of several columns; partial aggregation shrinks them at once."""
    kind = "string" if text else "double"
    cells = [
        F.struct(F.lit(c).alias("variable"), F.col(c).cast(kind).alias("value")) for c in cols
    ]
    return df.select(*keep, F.inline(F.array(*cells)))


def null_profile(
    df: DataFrame, cols: Sequence[str] | None = None, top: int | None = 50
) -> DataFrame:
    """Null share per column, largest first (``top`` of them), from one aggregation."""
    cols = list(cols or df.columns)
    counts = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(c).alias(c) for c in cols])
    share = [
        F.struct(
            F.lit(c).alias("variable"),
            F.try_divide((F.col("_n") - F.col(c)).cast("double"), F.col("_n")).alias("null_share"),
        )
        for c in cols
    ]
    out = _long(counts, share).orderBy(F.desc("null_share"), "variable")
    return out.limit(top) if top else out


def distinct_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Exact distinct non-null values per column."""
    cols = list(cols or df.columns)
    counts = df.agg(*[F.count_distinct(c).alias(c) for c in cols])
    return counts.unpivot([], cols, "variable", "distinct_values")


def variable_summary(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Type, distinct values, null and coverage percentage per column, best covered first."""
    cols = list(cols or df.columns)
    types = dict(df.dtypes)
    row = df.agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count(c).alias(f"n_{i}") for i, c in enumerate(cols)],
        *[F.count_distinct(c).alias(f"d_{i}") for i, c in enumerate(cols)],
    )
    cells = []
    for i, c in enumerate(cols):
        null_pct = F.try_divide(100 * (F.col("_n") - F.col(f"n_{i}")).cast("double"), F.col("_n"))
        cells.append(
            F.struct(
                F.lit(c).alias("variable"),
                F.lit(types[c]).alias("data_type"),
                F.col(f"d_{i}").alias("unique_values"),
                null_pct.alias("null_pct"),
                (100 - null_pct).alias("coverage_pct"),
            )
        )
    return _long(row, cells).orderBy(F.desc("coverage_pct"), "variable")


def moments(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, mean, deviation, bias-corrected skew and minimum per column."""
    rows = long_values(df, cols, text=False).filter("value is not null")
    n = F.count("value").cast("double")
    fix = F.when(n > 2, F.sqrt(n * (n - 1)) / (n - 2))
    return rows.groupBy("variable").agg(
        F.count("value").alias("n"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        (F.skewness("value") * fix).alias("skew"),
        F.min("value").alias("min"),
    )


def with_quantiles(stats: DataFrame, df: DataFrame, cols: Sequence[str], named: dict[str, float]):
    """Add exact quantiles to a frame with one row per variable."""
    found = exact_quantiles(df, cols, list(named.values()))
    rows = [(c, *(found[c] or [None] * len(named))) for c in cols]
    schema = T.StructType(
        [T.StructField("variable", T.StringType())]
        + [T.StructField(n, T.DoubleType()) for n in named]
    )
    quantiles = df.sparkSession.createDataFrame(rows, schema)
    return stats.join(F.broadcast(quantiles), "variable", "left")  # one row per column


def profile_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, missing, distinct, moments, zeros, range and quantiles per numeric column."""
    rows = long_values(df, cols, text=False)
    stats = rows.groupBy("variable").agg(
        F.count("value").alias("n"),
        F.count_if(F.col("value").isNull()).alias("missing"),
        F.count_distinct("value").alias("distinct_values"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.count_if(F.col("value") == 0).alias("zeros"),
    )
    named = {"q05": 0.05, "q25": 0.25, "q50": 0.5, "q75": 0.75, "q95": 0.95}
    return with_quantiles(stats, df, cols, named)


def profile_categorical(df: DataFrame, cols: Sequence[str], top: int = 10) -> DataFrame:
    """The most frequent values of each column with their share of the non-null rows.

    Counts come first, and Spark limits each column to its best rows before the shuffle.
    """
    counts = long_values(df, cols).filter("value is not null").groupBy("variable", "value").count()
    order = Window.partitionBy("variable").orderBy(F.desc("count"), "value")
    best = counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    totals = df.agg(*[F.count(c).alias(c) for c in cols]).unpivot([], list(cols), "variable", "_n")
    out = best.join(F.broadcast(totals), "variable")  # one row per column
    return out.select(
        "variable",
        "rank",
        "value",
        F.col("count").alias("cnt"),
        (F.col("count").cast("double") / F.col("_n")).alias("share"),
    )


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Rows per value with their share of all non-null rows."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("cnt"))
    total = df.agg(F.count(col)).scalar()
    return counts.withColumn("share", F.col("cnt").cast("double") / total)


# -- pairs of columns ---------------------------------------------------------------------

#: Columns of a tile of the pair matrices, and tasks per core that add up tiles.
TILE, TASKS_PER_CORE = 64, 4
_SUMS = ("n", "sx", "sy", "sxy", "sxx", "syy")
_RANGES = ("x_low", "y_low", "x_high", "y_high")


def pair_sums(df: DataFrame, cols: Sequence[str], centers: Sequence[float] | None = None):
    """Pairwise-complete sums and ranges of all column pairs, one small row per pair.

    Tasks add up matrix products of their Arrow batches and send them as tiles of ``TILE`` x
    ``TILE`` pairs; input partitions are put together first, so that there are a few tasks per
    core however many partitions there are. Tiles are added in a task each and only then cut into rows.
    ``centers`` are subtracted first, which keeps the products well scaled. ``x_low`` to
    ``y_high`` are the ranges over the rows that have both values; NaN counts as missing.
    """
    cols = list(cols)
    p = len(cols)
    shift = np.zeros(p) if centers is None else np.asarray(centers, dtype=float)
    edges = [(s, min(s + TILE, p)) for s in range(0, p, TILE)]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(_SUMS), p, p))
        low, high = np.full((p, p), np.inf), np.full((p, p), -np.inf)
        for batch in batches:
            if not batch.num_rows:
                continue
            raw = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1).astype(float) - shift
            there = ~np.isnan(raw)
            x, m = np.where(there, raw, 0.0), there.astype(float)
            sums, squares = x.T @ m, (x * x).T @ m
            total += np.stack([m.T @ m, sums, sums.T, x.T @ x, squares, squares.T])
            # Columns with the same rows missing share their ranges.
            patterns, which = np.unique(np.packbits(there, axis=0), axis=1, return_inverse=True)
            for g in range(patterns.shape[1]):
                of = np.flatnonzero(which.ravel() == g)
                rows = there[:, of[0]]
                least = np.where(there[rows], raw[rows], np.inf).min(axis=0, initial=np.inf)
                most = np.where(there[rows], raw[rows], -np.inf).max(axis=0, initial=-np.inf)
                low[:, of] = np.minimum(low[:, of], least[:, None])
                high[:, of] = np.maximum(high[:, of], most[:, None])
        for a, (i, k) in enumerate(edges):
            for b, (j, l) in enumerate(edges[a:], a):  # noqa: E741
                tile = np.stack([*total[:, i:k, j:l], low[i:k, j:l], low[j:l, i:k].T, high[i:k, j:l], high[j:l, i:k].T])
                yield pa.RecordBatch.from_arrays([pa.array([a], pa.int32()), pa.array([b], pa.int32()), pa.array([tile.tobytes()], pa.binary())], ["a", "b", "tile"])

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        a, b = (k.as_py() for k in key)
        (i, k), (j, l) = edges[a], edges[b]  # noqa: E741
        out = None
        for cell in table.column("tile"):
            tile = np.frombuffer(cell.as_buffer()).reshape(-1, k - i, l - j)
            if out is None:
                out = tile.copy()
                continue
            out[: len(_SUMS) + 2] = np.concatenate([out[: len(_SUMS)] + tile[: len(_SUMS)], np.minimum(out[len(_SUMS) : -2], tile[len(_SUMS) : -2])])
            out[-2:] = np.maximum(out[-2:], tile[-2:])
        x, y = np.meshgrid(np.arange(i, k), np.arange(j, l), indexing="ij")
        upper = x <= y
        numbers = {"i": x[upper].astype(np.int32), "j": y[upper].astype(np.int32)}
        return pa.table(numbers | {c: out[s][upper] for s, c in enumerate([*_SUMS, *_RANGES])})

    numbers = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    few = numbers.coalesce(TASKS_PER_CORE * df.sparkSession.sparkContext.defaultParallelism)
    schema = "i int, j int, " + ", ".join(f"{k} double" for k in [*_SUMS, *_RANGES])
    return few.mapInArrow(partial, "a int, b int, tile binary").groupBy("a", "b").applyInArrow(merge, schema)


def _corr_of_sums() -> Column:
    """Correlation over the rows that have both values; null when one is constant there."""
    n = F.col("n")
    cov = n * F.col("sxy") - F.col("sx") * F.col("sy")
    vx = n * F.col("sxx") - F.col("sx") * F.col("sx")
    vy = n * F.col("syy") - F.col("sy") * F.col("sy")
    vary = (F.col("x_low") < F.col("x_high")) & (F.col("y_low") < F.col("y_high"))
    return F.when(vary & (vx > 0) & (vy > 0), F.try_divide(cov, F.sqrt(vx) * F.sqrt(vy)))


def corr_pairs(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of all pairs ``a`` before ``b``; nulls are skipped pair by pair."""
    cols = list(cols)
    at = F.array(*[F.lit(c) for c in cols])
    numbers = df.select(
        *[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in cols]
    )
    centers = numbers.agg(*[F.avg(c) for c in cols]).first()
    sums = pair_sums(numbers, cols, [m or 0.0 for m in centers]).filter("i < j")
    return sums.select(
        F.col("i").alias("a_no"),
        F.col("j").alias("b_no"),
        F.get(at, F.col("i")).alias("a"),
        F.get(at, F.col("j")).alias("b"),
        _corr_of_sums().alias("corr"),
    )


def corr_matrix(df: DataFrame, cols: Sequence[str], digits: int = 2) -> DataFrame:
    """Lower triangle of the correlation matrix, rounded half to even."""
    return corr_pairs(df, cols).select("a", "b", F.bround("corr", digits).alias("corr"))


def spearman_matrix(df: DataFrame, cols: Sequence[str], key: str) -> DataFrame:
    """Rank correlation of all pairs over the rows where every column is present."""
    complete = df.select(key, *cols).na.drop(subset=list(cols))
    return corr_pairs(average_ranks(complete, cols, key), cols)


def score_density(
    df: DataFrame, label: str, score: str, bins: int = 200, grid: int = 50
) -> DataFrame:
    """Gaussian kernel density of a score per label, on a grid over the score range.

    Rows are first counted in ``bins`` equal cells per label; the kernel (Scott's
    bandwidth) is summed over the cells.
    """
    rows = df.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
    low, high = rows.agg(F.min(score), F.max(score)).first()
    low, high = float(low or 0.0), float(high or 0.0)
    width = (high - low) / bins or 1.0
    value = F.col(score).cast("double")
    cell = F.least(F.floor((value - F.lit(low)) / F.lit(width)), F.lit(bins - 1)).alias("cell")
    # Cells per label: bounded by the number of bins.
    cells = rows.groupBy(label, cell).agg(
        F.count(F.lit(1)).alias("cnt"), F.sum(value).alias("s1"), F.sum(value * value).alias("s2")
    )
    per_label = Window.partitionBy(label)
    n = F.sum("cnt").over(per_label).cast("double")
    s1, s2 = F.sum("s1").over(per_label), F.sum("s2").over(per_label)
    std = F.sqrt((s2 - s1 * s1 / n) / F.nullif(n - 1, F.lit(0.0)))
    cells = cells.select(
        label,
        "cnt",
        (F.lit(low) + (F.col("cell") + 0.5) * F.lit(width)).alias("mid"),
        n.alias("n"),
        (std * F.pow(n, F.lit(-0.2))).alias("bw"),
    )
    points = F.array(*[F.lit(low + (high - low) * i / (grid - 1)) for i in range(grid)])
    spread = cells.select("*", F.posexplode(points).alias("point_no", "x"))
    z = (F.col("x") - F.col("mid")) / F.col("bw")
    kernel = F.exp(-z * z / 2) / (F.lit(float(np.sqrt(2 * np.pi))) * F.col("bw"))
    return spread.groupBy(label, "point_no").agg(
        F.first("x").alias("x"), F.sum(F.col("cnt") * kernel / F.col("n")).alias("density")
    )
