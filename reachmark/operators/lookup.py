"""Joins and lookups. Catalyst and AQE pick the physical join and split hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F



def response_rates(df: DataFrame, by: Sequence[str], label: str, strict_reference: bool = False):
    """Rows, responders and rate per group, in one conditional aggregation.

    ``strict_reference`` gives null responders where a left join of totals and responders
    would find none.
    """
    hits = F.count_if(F.col(label) == 1)
    out = df.groupBy(*by).agg(F.count(F.lit(1)).alias("cnt"), hits.alias("responders"))
    if strict_reference:
        out = out.withColumn("responders", F.nullif("responders", F.lit(0)))
    return out.withColumn("rate", 100 * F.col("responders").cast("double") / F.col("cnt"))


def with_lookup(df: DataFrame, lookup: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join to a dimension; unmatched rows get nulls."""
    return df.join(lookup, list(on), "left")


def membership_flag(df: DataFrame, col: str, members: DataFrame, name: str) -> DataFrame:
    """Flag rows whose value is in a one-column list; null is in no list."""
    value = members.columns[0]
    listed = members.filter(F.col(value).isNotNull()).distinct().withColumnRenamed(value, "_m")
    joined = df.join(listed, df[col] == listed["_m"], "left")
    return joined.withColumn(name, F.col("_m").isNotNull()).drop("_m")


def members_only(df: DataFrame, members: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.join(members, list(on), "left_semi")


def not_members(df: DataFrame, members: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.join(members, list(on), "left_anti")


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """One row per key, the first in ``order``; rows without a key are dropped.

    Spark keeps the first row per key before the shuffle (window group limit), so a hot
    key sends one row per task.
    """
    for k in keys:
        df = df.filter(F.col(k).isNotNull())
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


#: Groups in a block of ``group_pairs``.
PAIR_BLOCK = 256


def group_pairs(groups: DataFrame, name: str, block: int = PAIR_BLOCK) -> DataFrame:
    """All pairs of rows of a per-group aggregate, the smaller name first.

    Groups are dealt to blocks by a hash of their name, and every two blocks meet in one key
    of a join, so that no task holds all groups. Null names pair with nothing.
    """
    n = groups.count()
    blocks = max(1, -(-n // block))
    others = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    dealt = groups.withColumn("_own", F.pmod(F.xxhash64(name), F.lit(blocks)).cast("int"))
    left = dealt.select(F.col("_own").alias("_x"), others.alias("_y"), *[F.col(c).alias(f"{c}_a") for c in groups.columns])
    right = dealt.select(others.alias("_x"), F.col("_own").alias("_y"), *[F.col(c).alias(f"{c}_b") for c in groups.columns])
    pairs = left.join(right, ["_x", "_y"]).filter(F.col(f"{name}_a") < F.col(f"{name}_b"))
    return pairs.drop("_x", "_y")


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
