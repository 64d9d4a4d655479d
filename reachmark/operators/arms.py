"""Fair assignment of accounts to test arms, and checks of it."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reachmark.functions.columns import hash_order
from reachmark.functions.stats import normal_p
from reachmark.operators.ordering import OrderIndex, running_by_value

# Largest distance between requested and realized shares; confidence of the fairness test.
SHARE_DISTANCE = 0.03
FAIRNESS_CONFIDENCE = 0.95


def pmf_distance(a: DataFrame, b: DataFrame, share: str = "share") -> DataFrame:
    """One row: Wasserstein distance of two sets of shares (a few rows each).

    The shares are compared as samples, so the order and names of the arms do not matter.
    """
    na, nb = a.agg(F.count(share)).scalar(), b.agg(F.count(share)).scalar()
    steps = a.select(F.col(share).alias("v"), (F.lit(1.0) / na).alias("d")).unionAll(
        b.select(F.col(share).alias("v"), (F.lit(-1.0) / nb).alias("d"))
    )
    jumps = steps.groupBy("v").agg(F.sum("d").alias("d"))
    w = Window.orderBy("v")
    height = F.abs(F.sum("d").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    gap = F.lead("v").over(w) - F.col("v")
    return jumps.select((height * gap).alias("area")).agg(
        F.coalesce(F.sum("area"), F.lit(0.0)).alias("distance")
    )


def same_prob_mass(a: DataFrame, b: DataFrame, threshold: float, share: str = "share") -> bool:
    """Are two sets of shares, each adding up to 1, closer than the threshold?"""
    for name, df in (("first", a), ("second", b)):
        total = df.agg(F.sum(share)).first()[0] or 0.0
        if abs(total - 1) > 1e-5:
            raise ValueError(f"the {name} shares must add up to 1, not {total}")
    return pmf_distance(a, b, share).first()["distance"] < threshold


def equal_shares(df: DataFrame, n: int) -> DataFrame:
    return df.sparkSession.range(n).select(F.lit(1.0 / n).alias("share"))


def is_uniform(shares: DataFrame, threshold: float, share: str = "share") -> bool:
    """Are the shares close to equal? A single one always is."""
    n = shares.count()
    return n < 2 or same_prob_mass(shares, equal_shares(shares, n), threshold, share)


def arm_shares(df: DataFrame, arm: str) -> DataFrame:
    """Realized share per arm."""
    counts = df.groupBy(arm).agg(F.count(F.lit(1)).alias("cnt"))
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return counts.withColumn("share", F.col("cnt").cast("double") / F.sum("cnt").over(everything))


def random_arms(
    df: DataFrame,
    key: str,
    shares: int | dict[int, float],
    seed: int = 0,
    name: str = "arm",
    check: bool = True,
) -> DataFrame:
    """Draw an arm per row with the given probabilities; a narrow transformation.

    The draw is a hash of the key, so it is repeatable. ``check`` counts the arms once and
    raises when the realized shares are off.
    """
    if isinstance(shares, int):
        shares = {i: 1.0 / shares for i in range(shares)}
    u = hash_order(F.col(key), seed) / F.lit(2.0**32)
    arms = list(shares)
    upto, draw = 0.0, None
    for a in arms[:-1]:
        upto += shares[a]
        draw = F.when(u < upto, a) if draw is None else draw.when(u < upto, a)
    out = df.withColumn(name, F.lit(arms[-1]) if draw is None else draw.otherwise(arms[-1]))
    if check and len(arms) > 1:
        wanted = df.sparkSession.createDataFrame([(float(s),) for s in shares.values()], "share double")
        if not same_prob_mass(wanted, arm_shares(out, name), SHARE_DISTANCE):
            raise ValueError("the realized arm shares differ from the requested ones")
    return out


def consecutive_arms(
    df: DataFrame,
    key: str,
    arms: int,
    sort_fields: Sequence[str],
    offset: int = 0,
    name: str = "arm",
) -> DataFrame:
    """Deal rows out to arms in sorted order, starting at ``offset``; ties go by key."""
    if not isinstance(arms, int):
        raise NotImplementedError("consecutive assignment takes a number of arms, not shares")
    if arms == 1:
        return df.withColumn(name, F.lit(0))
    index = OrderIndex.fit(df, [(f, True) for f in sort_fields], key)
    ranked = index.positions(df, rank="_rank")
    arm = F.pmod(F.col("_rank") - 1 + offset, F.lit(arms)).cast("int")
    return ranked.withColumn(name, arm).drop("_rank")


def mann_whitney(df: DataFrame, arm: str, fields: Sequence[str]) -> DataFrame:
    """Two-sided Mann-Whitney U with tie-corrected z (continuity 0.5) per arm pair and field.

    All pairs of a field come from one running count over its distinct values. A missing
    value in either arm leaves the test null.
    """
    sizes = df.groupBy(arm).agg(
        F.count(F.lit(1)).alias("n"), *[F.count(f).alias(f"n_{f}") for f in fields]
    )
    stats = {r[arm]: r for r in sizes.collect() if r[arm] is not None}  # one row per arm
    names = sorted(stats)
    out = None
    for f in fields:
        sums = {f"n{i}": F.when(F.col(arm) == a, 1).otherwise(0) for i, a in enumerate(names)}
        runs, _ = running_by_value(df.filter(F.col(f).isNotNull()).select(f, arm), f, True, sums)
        cells = []
        for i, j in combinations(range(len(names)), 2):
            a, b = F.col(f"n{i}").cast("double"), F.col(f"n{j}").cast("double")
            below = F.col(f"n{j}_run") - b
            ties = a + b
            cells += [
                F.sum(a * (below + b / 2)).alias(f"u_{i}_{j}"),
                F.sum(ties * ties * ties - ties).alias(f"t_{i}_{j}"),
            ]
        row = runs.agg(*cells)
        tests = []
        for i, j in combinations(range(len(names)), 2):
            na, nb = stats[names[i]], stats[names[j]]
            whole = na["n"] == na[f"n_{f}"] and nb["n"] == nb[f"n_{f}"]
            n1, n2 = float(na["n"]), float(nb["n"])
            u1 = F.col(f"u_{i}_{j}")
            u = F.greatest(u1, n1 * n2 - u1)
            n = n1 + n2
            var = n1 * n2 / 12 * ((n + 1) - F.col(f"t_{i}_{j}") / (n * (n - 1)))
            z = F.try_divide(u - n1 * n2 / 2 - 0.5, F.sqrt(var))
            tests.append(
                F.struct(
                    F.lit(names[i]).alias("arm_a"),
                    F.lit(names[j]).alias("arm_b"),
                    F.lit(f).alias("field"),
                    (u if whole else F.lit(None).cast("double")).alias("u"),
                    (z if whole else F.lit(None).cast("double")).alias("z"),
                )
            )
        part = row.select(F.inline(F.array(*tests)))
        out = part if out is None else out.unionByName(part)
    return out


def check_fairness(df: DataFrame, arm: str, fields: Sequence[str]) -> DataFrame:
    """Mann-Whitney tests with p-value and a flag on unfair pairs."""
    tests = mann_whitney(df, arm, fields).withColumn("p_value", normal_p(F.col("z")))
    unfair = F.coalesce(F.col("p_value") < 1 - FAIRNESS_CONFIDENCE, F.lit(False))
    return tests.withColumn("unfair", unfair)
