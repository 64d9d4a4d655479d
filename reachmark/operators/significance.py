"""Tests of a 0/1 label against features, and the bivariate response view."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reachmark.functions.stats import chi2_p, t_p
from reachmark.operators.bins import QuantileBins
from reachmark.operators.profile import long_values

# Name parts of features that are shown by value, not by quantile bin, and the rows a
# group needs to be shown.
INDICATOR_PARTS = ("ind", "chg_", "cadence_", "mailed_over_12mo", "flg_")
MIN_GROUP_ROWS = 300


def chi2_of_counts(counts: DataFrame, by: Sequence[str], n: str = "n", n1: str = "n1") -> DataFrame:
    """Chi-square of independence per ``by`` group from rows of (total, hits).

    Yates' correction at one degree of freedom; null when an expected cell is empty.
    """
    totals = counts.groupBy(*by).agg(
        F.sum(n).alias("_N"), F.sum(n1).alias("_N1"), F.count(F.lit(1)).alias("_r")
    )
    share = F.try_divide(F.col("_N1").cast("double"), F.col("_N"))
    joined = counts.join(F.broadcast(totals), list(by))  # one row per tested variable
    fix = F.when(F.col("_r") == 2, 0.5).otherwise(0.0)

    def cell(observed: Column, expected: Column) -> Column:
        off = F.abs(observed - expected)
        off = F.greatest(off - fix, F.lit(0.0))
        return F.try_divide(off * off, expected)

    hits = F.col(n) * share
    rest = F.col(n) * (1 - share)
    parts = cell(F.col(n1).cast("double"), hits) + cell((F.col(n) - F.col(n1)).cast("double"), rest)
    usable = F.min(F.least(hits, rest)) > 0
    dof = F.max("_r") - 1
    out = joined.groupBy(*by).agg(
        F.when(usable, F.sum(parts)).alias("stat"), dof.alias("dof")
    )
    return out.withColumn("stat", F.when(F.col("dof") > 0, F.col("stat")))


def chi2_screen(
    df: DataFrame, cols: Sequence[str], label: str, include_null: bool = False
) -> DataFrame:
    """Chi-square statistic, degrees of freedom and p-value per categorical column."""
    rows = long_values(
        df.filter(F.col(label).isNotNull()), [c for c in cols if c != label], [F.col(label)]
    )
    if not include_null:
        rows = rows.filter("value is not null")
    counts = rows.groupBy("variable", "value").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(label) == 1).alias("n1")
    )
    out = chi2_of_counts(counts, ["variable"])
    return out.withColumn("p_value", chi2_p(F.col("stat"), F.col("dof").cast("double")))


def ttest_screen(df: DataFrame, cols: Sequence[str], label: str) -> DataFrame:
    """Pooled two-sample t statistic (label 0 minus label 1) per numeric column."""
    rows = long_values(df, [c for c in cols if c != label], [F.col(label)], text=False)

    def side(k: int) -> Column:
        return F.when(F.col(label) == k, F.col("value"))

    stats = rows.filter("value is not null").groupBy("variable").agg(
        *[
            f(side(k)).alias(f"{name}{k}")
            for k in (0, 1)
            for name, f in (("n", F.count), ("m", F.avg), ("v", F.var_samp))
        ]
    )
    n0, n1 = F.col("n0").cast("double"), F.col("n1").cast("double")
    dof = n0 + n1 - 2
    pooled = F.try_divide((n0 - 1) * F.col("v0") + (n1 - 1) * F.col("v1"), dof)
    error = F.sqrt(pooled * (F.try_divide(F.lit(1.0), n0) + F.try_divide(F.lit(1.0), n1)))
    out = stats.select(
        "variable",
        F.try_divide(F.col("m0") - F.col("m1"), error).alias("stat"),
        (F.col("n0") + F.col("n1") - 2).alias("dof"),
    )
    return out.withColumn("p_value", t_p(F.col("stat"), F.col("dof").cast("double")))


def significant_share(tests: Sequence[DataFrame], level: float = 0.01) -> DataFrame:
    """Share of the tested variables whose p-value is below the level in any test."""
    rows = tests[0].select("variable", "p_value")
    for t in tests[1:]:
        rows = rows.unionByName(t.select("variable", "p_value"))
    per_variable = rows.groupBy("variable").agg(F.min("p_value").alias("p"))
    hit = F.count_if(F.col("p") < level)
    return per_variable.agg(
        hit.alias("significant"),
        F.count(F.lit(1)).alias("tested"),
        F.try_divide(hit.cast("double"), F.count(F.lit(1))).alias("share"),
    )


def bivariate_rates(
    df: DataFrame,
    label: str,
    by: str,
    cat_cols: Sequence[str],
    num_cols: Sequence[str],
    bins: int = 20,
    min_rows: int = MIN_GROUP_ROWS,
    strict_reference: bool = False,
) -> DataFrame:
    """Response rate per feature value (or quantile bin) and value of a 0/1 column.

    All features are counted in one pass. Each row also carries the chi-square statistic
    of its feature within its ``by`` group, taken before small groups are left out.
    ``strict_reference`` shows groups without a response as null.
    """
    fitted = QuantileBins.fit_many(df, num_cols, bins) if num_cols else {}
    cells = [
        F.struct(F.lit(c).alias("variable"), F.lit(0).alias("bin"), F.col(c).cast("string").alias("value"))
        for c in cat_cols
    ]
    for c in num_cols:
        if not fitted[c].edges:
            continue
        if fitted[c].count < 1 or any(part in c for part in INDICATOR_PARTS):
            bin_no, shown = F.lit(0), F.col(c).cast("string")
        else:
            bin_no = F.coalesce(fitted[c].index(), F.lit(0))
            shown = F.when(bin_no > 0, F.concat(F.lit("q"), bin_no.cast("string")))
        cells.append(F.struct(F.lit(c).alias("variable"), bin_no.alias("bin"), shown.alias("value")))
    rows = df.filter(F.col(by).isNotNull()).select(by, label, F.inline(F.array(*cells)))
    counts = rows.filter("value is not null").groupBy("variable", by, "bin", "value").agg(
        F.count(F.lit(1)).alias("cnt"), F.count_if(F.col(label) == 1).alias("responders")
    )
    tests = chi2_of_counts(counts, ["variable", by], "cnt", "responders")
    out = counts.join(F.broadcast(tests), ["variable", by])  # one row per feature and by value
    hits = F.col("responders")
    if strict_reference:
        hits = F.nullif(hits, F.lit(0))
    return out.filter(F.col("cnt") >= min_rows).select(
        "variable",
        by,
        "value",
        "cnt",
        hits.alias("responders"),
        (100 * hits.cast("double") / F.col("cnt")).alias("rate"),
        (F.col("cnt") - hits).alias("non_responders"),
        "stat",
        "dof",
    )


def with_chi2_p(rates: DataFrame) -> DataFrame:
    """Add the p-value of each row's test; a test that cannot run counts as 1."""
    p = chi2_p(F.col("stat"), F.col("dof").cast(T.DoubleType()))
    return rates.withColumn("p_value", F.coalesce(p, F.lit(1.0)))
