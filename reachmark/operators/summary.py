"""Funnel summaries, crosstabs and evaluation reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reachmark.functions.columns import threshold_flag
from reachmark.operators.bins import (
    SCORE_EDGES,
    QuantileBins,
    cut,
    interval_label,
    rank_decile,
    running,
)
from reachmark.operators.gains import auc_gini, capture_rates, classification_metrics
from reachmark.operators.ordering import Measure, OrderIndex

# Amounts from which a funded deal and an account balance count as large.
LARGE_FUND = 25_000
LARGE_BALANCE = 250_000

_SUMMED = (
    "flg_qual", "flg_sub", "flg_appr", "flg_nfappr", "flg_fund", "flg_nffund",
    "fund_amt", "nffund_amt", "fund_margin", "mail_cnt",
)


def funnel_measures(score: str) -> list[Measure]:
    """Counts and sums over the whole mail funnel."""
    return [
        Measure("cnt", "count", F.col("flg_resp")),
        Measure("flg_resp", "sum", F.col("flg_resp")),
        *[Measure(c, "sum", F.col(c)) for c in _SUMMED],
        Measure("large_fund", "sum", threshold_flag(F.col("fund_amt"), LARGE_FUND)),
        Measure("large_ags", "sum", threshold_flag(F.col("lead_ags"), LARGE_BALANCE)),
        Measure("ref_score_min", "min", F.col("ref_score")),
        Measure("ref_score_max", "max", F.col("ref_score")),
        Measure("score_min", "min", F.col(score)),
        Measure("score_max", "max", F.col(score)),
    ]


def _score_column(target: str) -> str:
    return f"score_{target.removeprefix('flg_')}"


def _order(var: str, ascending: bool) -> list[Column]:
    return [F.col(var).asc_nulls_last() if ascending else F.col(var).desc_nulls_last()]


def _rate(count: str, per: str = "cnt") -> Column:
    return F.bround(F.try_divide(100 * F.col(count).cast("double"), F.col(per)), 2)


def _share(part: str, whole: str) -> Column:
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return F.try_divide(F.col(part).cast("double"), F.sum(whole).over(everything))


def finish_funnel(grouped: DataFrame, var: str, ascending: bool = True, full: bool = True):
    """Rates and running totals over the grouped rows of a report."""
    out = running(
        grouped,
        _order(var, ascending),
        {"cumu_cnt": "cnt", "cumu_resp": "flg_resp", "cumu_fund_amt": "fund_amt"},
    )
    average = F.try_divide(F.col("fund_amt").cast("double"), F.col("flg_fund"))
    out = out.withColumns(
        {
            "cumu_resp_pcnt": _share("cumu_resp", "flg_resp"),
            "resp_rate": _rate("flg_resp"),
            "qual_rate": _rate("flg_qual"),
            "sub_rate": _rate("flg_sub"),
            "appr_rate": _rate("flg_appr"),
            "fund_rate": _rate("flg_fund"),
            "avg_funded": F.bround(average, 0),
            "cumu_fund_amt_pcnt": _share("cumu_fund_amt", "fund_amt"),
        }
    )
    if full:
        return out
    return out.select(
        var, "cnt", "resp_rate", "sub_rate", "appr_rate", "fund_rate", "cumu_cnt", "cumu_fund_amt_pcnt"
    )


def funnel_summary(
    df: DataFrame, var: str, target: str, ascending: bool = True, full: bool = True
) -> DataFrame:
    """Funnel measures, rates and running totals per value of a binned column.

    The null group is kept and comes last.
    """
    measures = funnel_measures(_score_column(target))
    grouped = df.groupBy(var).agg(*[m.over_rows() for m in measures])
    return finish_funnel(grouped, var, ascending, full)


def funnel_by_rank_decile(
    df: DataFrame, score: str, key: str, target: str, full: bool = True, n: int = 10
) -> DataFrame:
    """Funnel summary over equal-population score deciles, 1 the best.

    Decile totals come from the bucket totals of the score order; just the buckets that a
    decile edge cuts are sorted.
    """
    measures = funnel_measures(_score_column(target))
    counted = [*measures, Measure("_scored", "count", F.col(score))]
    index = OrderIndex.fit(df, [(score, True)], key, measures=counted)
    ranked = sum(r["_scored"] for r in index.totals)
    grouped = index.summarize(df, n, counted, "_bin", total=ranked)
    # Rows without a score sort behind all others, in bins beyond the last.
    decile = F.when(F.col("_bin") <= n, rank_decile("_bin", "_scored", ranked, n))
    grouped = grouped.withColumn("decile", decile).groupBy("decile")
    return finish_funnel(grouped.agg(*[m.over_parts() for m in measures]), "decile", True, full)


def response_summary(
    df: DataFrame, var: str, score: str | None = None, ascending: bool = True, full: bool = True
) -> DataFrame:
    """Response-only summary with protected rates and the good/bad ratio."""
    aggs = [F.count("flg_resp").alias("cnt"), F.sum("flg_resp").alias("flg_resp")]
    if score:
        aggs += [F.min(score).alias("min_score"), F.max(score).alias("max_score")]
    out = df.groupBy(var).agg(*aggs)
    out = running(out, _order(var, ascending), {"cumu_cnt": "cnt", "cumu_resp": "flg_resp"})
    rest = F.col("cnt") - F.col("flg_resp")
    out = out.withColumns(
        {
            "cumu_resp_pcnt": _share("cumu_resp", "flg_resp"),
            "resp_rate": _rate("flg_resp"),
            "good_bad_ratio_resp": F.try_divide(F.col("flg_resp").cast("double"), rest),
        }
    )
    if full:
        return out
    bounds = ["min_score", "max_score"] if score else []
    return out.select(
        var, "cumu_cnt", "flg_resp", "resp_rate", "cumu_resp", "cumu_resp_pcnt",
        "good_bad_ratio_resp", *bounds,
    )


def crosstab(df: DataFrame, row: str, col: str) -> DataFrame:
    """Counts of every value pair, with row and column percentages (nulls left out)."""
    pairs = df.filter(F.col(row).isNotNull() & F.col(col).isNotNull())
    counts = pairs.groupBy(row, col).agg(F.count(F.lit(1)).alias("cnt"))
    per_row = F.sum("cnt").over(Window.partitionBy(row))
    per_col = F.sum("cnt").over(Window.partitionBy(col))
    return counts.select(
        row,
        col,
        "cnt",
        (100 * F.col("cnt").cast("double") / per_row).alias("row_pct"),
        (100 * F.col("cnt").cast("double") / per_col).alias("col_pct"),
    )


def crosstab_wide(df: DataFrame, row: str, col: str, values: Sequence) -> DataFrame:
    """Crosstab counts with one column per given value; absent pairs count 0."""
    pairs = df.filter(F.col(row).isNotNull())
    return pairs.groupBy(row).agg(*[F.count_if(F.col(col) == v).alias(str(v)) for v in values])


def _metric_rows(df: DataFrame, label: str, score: str, key: str) -> DataFrame:
    """Headline measures of a scored sample as (metric, value) rows."""
    auc = auc_gini(df, label, score).select(F.lit("roc_auc").alias("metric"), F.col("auc").alias("value"))
    names = ["accuracy", "precision", "recall", "f1"]
    at_half = classification_metrics(df, label, score).unpivot([], names, "metric", "value")
    capture = capture_rates(df, label, score, key).select(
        F.format_string("capture_rate_%d%%", (F.col("share") * 100).cast("int")).alias("metric"),
        F.col("capture_rate").alias("value"),
    )
    return auc.unionByName(at_half.select("metric", "value")).unionByName(capture)


def evaluation_report(
    df: DataFrame, label: str, score: str, key: str, full: bool = True
) -> dict[str, DataFrame]:
    """Metrics and funnel summaries by score bin and by value-quantile decile."""
    rows = df.withColumn("score_bin", cut(F.col(score), SCORE_EDGES, right=False))
    bins = QuantileBins.fit(df, score, 10)
    by_bin = bins.transform(df, "_bin")
    measures = funnel_measures(_score_column(label))
    grouped = by_bin.groupBy("_bin").agg(*[m.over_rows() for m in measures])
    place = F.dense_rank().over(Window.orderBy(F.desc_nulls_last("_bin")))
    grouped = grouped.withColumn("decile", F.when(F.col("_bin").isNotNull(), place)).drop("_bin")
    score_bins = funnel_summary(rows, "score_bin", label, ascending=False, full=full)
    label_of = interval_label(F.col("score_bin"), SCORE_EDGES, right=False)
    return {
        "metrics": _metric_rows(df, label, score, key),
        "score_bins": score_bins.withColumn("score_range", label_of),
        "deciles": finish_funnel(grouped, "decile", True, full),
    }


def performance_report(
    df: DataFrame, label: str, score: str, key: str, full: bool = True
) -> dict[str, DataFrame]:
    """Same report with equal-population deciles."""
    rows = df.withColumn("score_bin", cut(F.col(score), SCORE_EDGES, right=False))
    return {
        "metrics": _metric_rows(df, label, score, key),
        "score_bins": funnel_summary(rows, "score_bin", label, ascending=False, full=full),
        "deciles": funnel_by_rank_decile(df, score, key, label, full=full),
    }
