"""Fitted boosted models: category statistics, scoring, and several models in one scan."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reachmark.functions.columns import hash_order
from reachmark.operators import trees as TR
from reachmark.operators.select import MISSING_CATEGORY
from reachmark.operators.trees import Trees
from reachmark.runtime import SMALL_TABLE_ROWS, materialize

#: Hash slices of the training rows; a row's category statistic counts the slices before its own.
SLICES = 32
#: Rows that the overall rate counts for in a category's rate.
PRIOR_ROWS = 1.0


def category(column: str) -> Column:
    """The value of a categorical column as statistics name it."""
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(MISSING_CATEGORY))


def slice_of(key: Column, seed: int) -> Column:
    return (F.pmod(hash_order(key, seed + 7), F.lit(SLICES))).cast("int")


def ordered_statistics(df: DataFrame, columns: Sequence[str], label: Column, key: Column, held_out: Column, seed: int):
    """Rows with ``_s0, _s1, ...`` per categorical column, and the table ``column, value, stat`` for scoring.

    The statistic of a training row is the rate of its category over the training rows of
    earlier hash slices, drawn to the overall rate: its own label is never in it. Rows that
    are held out get the rate over all training rows, as new rows do. All columns are
    counted in one pass, with partial sums before the shuffle, for any number of categories.
    """
    rows = df.withColumns({"_slice": F.when(held_out, SLICES).otherwise(slice_of(key, seed)), "_y": label.cast("double")})
    of_training = F.col("_slice") < SLICES
    prior = float(rows.filter(of_training).agg(F.avg("_y")).first()[0] or 0.0)
    listed = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), category(c).alias("value")) for i, c in enumerate(columns)]))
    counted = (
        rows.select(listed.alias("c"), "_slice", F.when(of_training, F.col("_y")).alias("y"))
        .groupBy(F.col("c.i").alias("i"), F.col("c.value").alias("value"), "_slice")
        .agg(F.count("y").alias("n"), F.coalesce(F.sum("y"), F.lit(0.0)).alias("pos"))
    )
    before = Window.partitionBy("i", "value").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)  # at most SLICES + 1 rows
    earlier = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    rate = lambda pos, n: (pos + prior * PRIOR_ROWS) / (n + PRIOR_ROWS)
    by_slice = materialize(counted.withColumn("stat", rate(earlier("pos"), earlier("n"))), "statistics")
    small = by_slice.count() <= SMALL_TABLE_ROWS
    for i, c in enumerate(columns):
        part = by_slice.filter(F.col("i") == i).select(F.col("value").alias("_v"), F.col("_slice").alias("_vs"), F.col("stat").alias(f"_s{i}"))
        part = F.broadcast(part) if small else part
        rows = rows.join(part, (category(c) == F.col("_v")) & (F.col("_slice") == F.col("_vs")), "left").drop("_v", "_vs")
    whole = by_slice.groupBy("i", "value").agg(rate(F.sum("pos"), F.sum("n")).alias("stat"))
    names = F.get(F.array(*[F.lit(c) for c in columns]), F.col("i"))
    return rows.drop("_slice", "_y"), materialize(whole.select(names.alias("column"), "value", "stat"), "categories"), prior


@dataclass
class BoostedModel:
    """Trees over numeric columns and the statistics of categorical ones."""

    trees: Trees
    numeric: tuple[str, ...]
    categorical: tuple[str, ...] = ()
    prior: float = 0.0
    statistics: DataFrame | None = None
    small: bool = True
    watched: list[float] = field(default_factory=list)

    def with_features(self, df: DataFrame) -> tuple[DataFrame, list[Column]]:
        """``df`` with the statistics of its categories, and the features as columns."""
        joined, stats = _joined(df, [self])
        return joined, [*[F.col(f"`{c}`").cast("double") for c in self.numeric], *stats[0]]

    def score(self, df: DataFrame, name: str) -> DataFrame:
        """Rows with the probability of class 1."""
        rows, features = self.with_features(df)
        proba = TR.probabilities([self.trees], features)[0].alias(name)
        return rows.select(*[F.col(f"`{c}`") for c in df.columns if c != name], proba)

    def save(self, spark: SparkSession, path: str) -> None:
        spec = {"trees": self.trees.to_dict(), "numeric": self.numeric, "categorical": self.categorical, "prior": self.prior, "small": self.small, "watched": self.watched}
        spark.createDataFrame([(json.dumps(spec),)], "spec string").coalesce(1).write.mode("overwrite").parquet(f"{path}/model")
        if self.statistics is not None:
            self.statistics.write.mode("overwrite").parquet(f"{path}/statistics")

    @staticmethod
    def load(spark: SparkSession, path: str) -> BoostedModel:
        d = json.loads(spark.read.parquet(f"{path}/model").first()["spec"])
        stats = spark.read.parquet(f"{path}/statistics") if d["categorical"] else None
        return BoostedModel(Trees.from_dict(d["trees"]), tuple(d["numeric"]), tuple(d["categorical"]), d["prior"], stats, d["small"], d["watched"])


def _joined(df: DataFrame, models: Sequence[BoostedModel]) -> tuple[DataFrame, list[list[Column]]]:
    """``df`` with the category statistics of all models, one join per categorical column."""
    found: dict[tuple[int, str], Column] = {}
    for k, c in enumerate(dict.fromkeys(c for m in models for c in m.categorical)):
        using = [i for i, m in enumerate(models) if c in m.categorical]
        parts = None
        for i in using:
            part = models[i].statistics.filter(F.col("column") == c).select("value", F.lit(i).alias("m"), "stat")
            parts = part if parts is None else parts.unionByName(part)
        name = f"_stat{k}"
        cells = [F.max(F.when(F.col("m") == i, F.col("stat"))).alias(f"m{i}") for i in using]
        wide = parts.groupBy(F.col("value").alias("_value")).agg(F.struct(*cells).alias(name))
        wide = F.broadcast(wide) if all(models[i].small for i in using) else wide  # counted when fitted
        df = df.join(wide, category(c) == F.col("_value"), "left").drop("_value")
        for i in using:
            found[i, c] = F.coalesce(F.col(f"{name}.m{i}"), F.lit(models[i].prior))
    return df, [[found[i, c] for c in m.categorical] for i, m in enumerate(models)]


def score_models(df: DataFrame, models: Sequence[BoostedModel], name: str) -> DataFrame:
    """``df`` with ``array<double>`` of the probabilities by every model: one scan, one Arrow function."""
    rows, stats = _joined(df, models)
    columns: dict[str, Column] = {}
    arrays = []
    for i, m in enumerate(models):
        own = [f"n:{c}" for c in m.numeric] + [f"{i}:{c}" for c in m.categorical]
        columns |= {f"n:{c}": F.col(f"`{c}`").cast("double") for c in m.numeric}
        columns |= {f"{i}:{c}": stat for c, stat in zip(m.categorical, stats[i], strict=True)}
        arrays.append((own, m.trees))
    union = list(columns)
    moved = [TR.with_features(Trees(tuple(own), *[getattr(t, a) for a in Trees.ARRAYS], t.bias), union) for own, t in arrays]
    proba = TR.probabilities(moved, list(columns.values()))
    return rows.select(*[F.col(f"`{c}`") for c in df.columns], proba.alias(name))


def statistics_size(statistics: DataFrame | None) -> bool:
    """Whether a statistics table is small enough to be broadcast; it is counted."""
    return statistics is None or statistics.count() <= SMALL_TABLE_ROWS
