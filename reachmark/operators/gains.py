"""Gains and KS tables, ROC and precision-recall measures, capture rates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from reachmark.functions.columns import percent
from reachmark.operators.ordering import Measure, OrderIndex, Splits, running_by_value
from reachmark.runtime import materialize


def _report() -> WindowSpec:
    """Order of the few rows of a gains table."""
    return Window.orderBy("Decile")


def _running() -> WindowSpec:
    return _report().rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _all() -> WindowSpec:
    return Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def _class_weights(label: str, weight: str | None) -> dict[str, Column]:
    w = F.col(weight) if weight else F.lit(1)
    return {
        "pos": F.when(F.col(label) == 1, w).otherwise(0),
        "neg": F.when(F.col(label) == 0, w).otherwise(0),
    }


def auc_gini(
    df: DataFrame,
    label: str,
    score: str,
    weight: str | None = None,
    splits: Splits | None = None,
    ascending: bool = False,
) -> DataFrame:
    """One row: weighted ROC-AUC (ties count half) and Gini; null when a class is absent."""
    runs, _ = running_by_value(df, score, ascending, _class_weights(label, weight), splits=splits)
    # Walking down the scores a negative is beaten by the positives met so far.
    met = F.col("pos_run") - F.col("pos") / 2.0
    wins = F.sum(F.col("neg") * met)
    auc = F.try_divide(wins, F.sum("pos").cast("double") * F.sum("neg").cast("double"))
    if ascending:
        auc = 1 - auc
    out = runs.agg(auc.alias("auc"))
    return out.select("auc", (2 * F.col("auc") - 1).alias("gini"))


def ks_table(
    df: DataFrame,
    label: str,
    score: str,
    weight: str | None,
    key: str,
    bins: int = 10,
    mode: str | None = None,
) -> DataFrame:
    """Gains table over equal slices of the running weight, best scores first.

    ``mode='score'`` ranks low values first (points that fall as the risk rises).
    ``cumm_*`` are percentages, ``KS`` has four decimals, ``pi_index`` is ``PI`` on the
    usual 0-1 scale. Ties are ordered by key. Empty slices stay as rows.
    """
    if 100 % bins:
        raise ValueError("bins must divide 100")
    ascending = mode == "score"
    w = F.col(weight) if weight else F.lit(1)
    rows = df.select(
        F.col(key).alias("k"),
        F.col(score).alias("s"),
        F.col(label).cast("int").alias("y"),
        w.alias("w"),
    )
    classes = _class_weights("y", "w")
    measures = [
        Measure("min_scr", "min", F.col("s")),
        Measure("max_scr", "max", F.col("s")),
        Measure("bads", "sum", classes["pos"]),
        Measure("goods", "sum", classes["neg"]),
    ]
    index = OrderIndex.fit(rows, [("s", ascending)], "k", weight="w", measures=measures)
    slices = index.summarize(rows, bins, measures, "b")
    frame = df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("b"))
    table = frame.join(slices, "b", "left").select(
        (100 // bins * (F.col("b") - 1) + 50 // bins).alias("Decile"),
        "min_scr",
        "max_scr",
        F.coalesce("bads", F.lit(0)).alias("bads"),
        F.coalesce("goods", F.lit(0)).alias("goods"),
    )
    roc = auc_gini(rows, "y", "s", "w", splits=index.splits[0], ascending=ascending)
    roc = roc.select(F.struct("auc", "gini").alias("roc"))
    return _finish_ks(table, roc.scalar(), ascending)


def _finish_ks(table: DataFrame, roc: Column, ascending: bool) -> DataFrame:
    """Running percentages, KS and lift areas over the report rows."""

    def pct(name: str) -> Column:
        share = F.try_divide(F.col(name).cast("double"), F.sum(name).over(_all()))
        return F.sum(share).over(_running()) * 100

    def before(name: str) -> Column:
        return F.lag(name, 1, 0.0).over(_report())

    t = table.withColumn("total", F.col("bads") + F.col("goods"))
    t = t.withColumns(
        {
            "bad_rate": percent(100 * F.try_divide(F.col("bads").cast("double"), F.col("total"))),
            "cumm_bad": pct("bads"),
            "cumm_good": pct("goods"),
            "cum_total": pct("total"),
            "_roc": roc,
            "areab": 0.5
            - F.try_divide(F.sum("bads").over(_all()).cast("double"), F.sum("total").over(_all())) / 2,
        }
    )
    t = t.withColumn("KS", F.abs(F.bround(F.col("cumm_bad") - F.col("cumm_good"), 4)))
    t = t.withColumns(
        {
            "max_ks": F.when(F.col("KS") == F.max("KS").over(_all()), "<----").otherwise(""),
            "gini": F.abs(F.col("_roc.gini")),
            "auc": 1 - F.col("_roc.auc") if ascending else F.col("_roc.auc"),
            "lcum_bad": before("cumm_bad"),
            "lcum_total": before("cum_total"),
        }
    )
    half = (F.col("cumm_bad") - F.col("cum_total")) + (F.col("lcum_bad") - F.col("lcum_total"))
    t = t.withColumn("area", 0.5 * half * (F.col("cum_total") - F.col("lcum_total")))
    t = t.withColumn("cum_area", F.sum("area").over(_running()))
    t = t.withColumn("PI", F.try_divide(F.col("cum_area"), F.col("areab")))
    return t.select(
        "Decile", "min_scr", "max_scr", "bads", "goods", "total", "bad_rate", "cumm_bad",
        "cumm_good", "KS", "max_ks", "gini", "auc", "lcum_bad", "cum_total", "lcum_total",
        "area", "cum_area", "areab", "PI", (F.col("PI") / 10000).alias("pi_index"),
    )


# Order and names of the development / out-of-time comparison rows.
KS_METRICS = ("ROC_AUC", "Gini", "KS", "10%", "20%", "max_prob", "min_prob")


def _headline(ks: DataFrame) -> DataFrame:
    """The comparison measures of one KS table, one row."""

    def at(decile: int, name: str) -> Column:
        return F.max(F.when(F.col("Decile") == decile, F.col(name)))

    return ks.agg(
        F.max("auc").alias("ROC_AUC"),
        F.max("gini").alias("Gini"),
        F.max("KS").alias("KS"),
        at(5, "cumm_bad").alias("10%"),
        at(15, "cumm_bad").alias("20%"),
        at(5, "max_scr").cast("double").alias("max_prob"),
        at(95, "min_scr").cast("double").alias("min_prob"),
    )


def ks_dev_vs_test(
    dev: DataFrame, test: DataFrame, label: str, score: str, weight: str | None, key: str
) -> DataFrame:
    """Seven measures for the development and the out-of-time sample."""
    return compare_ks(
        ks_table(dev, label, score, weight, key), ks_table(test, label, score, weight, key)
    )


def compare_ks(dev_ks: DataFrame, test_ks: DataFrame) -> DataFrame:
    def long(ks: DataFrame, name: str) -> DataFrame:
        return _headline(ks).unpivot([], list(KS_METRICS), "metric", name)

    return long(dev_ks, "Dev").join(long(test_ks, "OOT"), "metric")


def is_monotone(ks: DataFrame) -> DataFrame:
    """One row: does the bad rate (two decimals, as printed) never rise down the table?"""
    rate = F.try_divide(100 * F.col("bads").cast("double"), F.col("total"))
    rates = ks.select("Decile", F.bround(rate, 2).alias("r"))
    rises = F.col("r") > F.lag("r").over(_report())
    return rates.select(rises.alias("up")).agg(
        (F.coalesce(F.max(F.col("up").cast("int")), F.lit(0)) == 0).alias("monotone")
    )


def ks_stability(
    dev: DataFrame, test: DataFrame, label: str, score: str, weight: str | None, key: str
) -> DataFrame:
    """Comparison rows with their difference and the monotone bad-rate check of both samples."""
    dev_ks = materialize(ks_table(dev, label, score, weight, key), "ks")
    test_ks = materialize(ks_table(test, label, score, weight, key), "ks")
    both = is_monotone(dev_ks).scalar() & is_monotone(test_ks).scalar()
    return compare_ks(dev_ks, test_ks).select(
        "metric", "Dev", "OOT", (F.col("Dev") - F.col("OOT")).alias("Diff"), both.alias("Bad_Rate")
    )


def score_comparison(
    df: DataFrame, label: str, weight: str | None, key: str, scores: dict[str, str | None]
) -> DataFrame:
    """KS, AUC, PI and capture of competing scores, each over the rows where it is present."""
    parts = []
    for name, mode in scores.items():
        ks = ks_table(df.filter(F.col(name).isNotNull()), label, name, weight, key, mode=mode)
        parts.append(
            ks.agg(
                F.lit(name).alias("score"),
                F.lit(mode).cast("string").alias("mode"),
                F.max("KS").alias("KS"),
                F.max("auc").alias("auc"),
                F.max_by("PI", "Decile").alias("PI"),
                F.min_by("cumm_bad", "Decile").alias("perc10"),
                F.max(F.when(F.col("Decile") == 15, F.col("cumm_bad"))).alias("perc20"),
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def roc_curve(df: DataFrame, label: str, score: str, weight: str | None = None) -> DataFrame:
    """One point per distinct score, plus the origin (threshold null)."""
    runs, total = running_by_value(df, score, False, _class_weights(label, weight))
    points = runs.select(
        F.col(score).cast("double").alias("threshold"),
        F.try_divide(F.col("neg_run").cast("double"), F.lit(total["neg"])).alias("fpr"),
        F.try_divide(F.col("pos_run").cast("double"), F.lit(total["pos"])).alias("tpr"),
    )
    origin = df.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return origin.unionByName(points)


def best_threshold(curve: DataFrame) -> DataFrame:
    """The ROC point with the largest geometric mean; the highest threshold wins ties."""
    g = curve.withColumn("gmean", F.sqrt(F.col("tpr") * (1 - F.col("fpr"))))
    best = F.max(F.struct("gmean", "threshold", "fpr", "tpr")).alias("b")
    return g.filter("threshold is not null").agg(best).select("b.*")


def pr_curve(df: DataFrame, label: str, score: str, weight: str | None = None) -> DataFrame:
    """Precision and recall per distinct score, plus the anchor (recall 0, precision 1)."""
    runs, total = running_by_value(df, score, False, _class_weights(label, weight))
    points = runs.select(
        F.col(score).cast("double").alias("threshold"),
        F.try_divide(F.col("pos_run").cast("double"), F.col("pos_run") + F.col("neg_run")).alias(
            "precision"
        ),
        F.try_divide(F.col("pos_run").cast("double"), F.lit(total["pos"])).alias("recall"),
    )
    anchor = df.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"),
        F.lit(1.0).alias("precision"),
        F.lit(0.0).alias("recall"),
    )
    return anchor.unionByName(points)


def pr_auc(df: DataFrame, label: str, score: str, weight: str | None = None) -> DataFrame:
    """Trapezoid area under the precision-recall points, and the no-skill rate.

    The point before a distinct score follows from its own running sums, so no second
    ordering is needed.
    """
    runs, _ = running_by_value(df, score, False, _class_weights(label, weight))
    p, n = F.col("pos_run") - F.col("pos"), F.col("neg_run") - F.col("neg")
    here = F.col("pos_run").cast("double") / (F.col("pos_run") + F.col("neg_run"))
    prev = F.coalesce(F.try_divide(p.cast("double"), p + n), F.lit(1.0))
    positives = F.sum("pos").cast("double")
    return runs.filter("pos_run + neg_run > 0").agg(
        F.try_divide(F.sum(F.col("pos") * (here + prev) / 2), positives).alias("pr_auc"),
        F.try_divide(positives, F.sum("pos") + F.sum("neg")).alias("no_skill"),
    )


def confusion(label: str, score: str, threshold: float = 0.5) -> dict[str, Column]:
    """The four confusion counts; a null score counts as not predicted."""
    predicted = F.coalesce(F.col(score) >= threshold, F.lit(False))
    actual = F.col(label) == 1
    other = F.col(label) == 0
    return {
        "tp": F.count_if(predicted & actual).alias("tp"),
        "fp": F.count_if(predicted & other).alias("fp"),
        "fn": F.count_if(~predicted & actual).alias("fn"),
        "tn": F.count_if(~predicted & other).alias("tn"),
    }


def classification_metrics(
    df: DataFrame, label: str, score: str, threshold: float = 0.5
) -> DataFrame:
    """Accuracy, precision, recall and F1 in one aggregation; undefined ratios are 0."""
    c = df.agg(*confusion(label, score, threshold).values())
    tp, fp, fn, tn = (F.col(x).cast("double") for x in ("tp", "fp", "fn", "tn"))

    def ratio(a: Column, b: Column) -> Column:
        return F.coalesce(F.try_divide(a, b), F.lit(0.0))

    return c.select(
        "tp", "fp", "fn", "tn",
        ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def top_fraction(df: DataFrame, score: str, key: str, share: float) -> DataFrame:
    """The best ``int(n * share)`` rows by score, ties by key."""
    index = OrderIndex.fit(df, [(score, False)], key)
    return index.top(df, int(index.row_count() * share))


def capture_rates(
    df: DataFrame, label: str, score: str, key: str, shares: Sequence[float] = (0.10, 0.20)
) -> DataFrame:
    """Share of all positives among the best 10 % and 20 % of rows."""
    positive = F.col(label) == 1
    rows = df.select(F.col(key), F.col(score), F.col(label))
    measures = [Measure("hits", "count", F.when(positive, 1))]
    index = OrderIndex.fit(rows, [(score, False)], key, measures=measures)
    n = index.row_count()
    positives = sum(r["hits"] for r in index.totals)
    parts = []
    for share in shares:
        size = int(n * share)
        # Whole buckets are already counted; only the cut one is sorted.
        whole = [r for r in index.totals if r["_rank_before"] + r["_rows"] <= size]
        known = sum(r["hits"] for r in whole)
        rest = index.slice(rows, sum(r["_rows"] for r in whole), size)
        hits = F.lit(known) + F.count(F.when(positive, 1))
        parts.append(
            rest.agg(
                F.lit(share).alias("share"),
                F.lit(size).cast("long").alias("rows"),
                hits.cast("long").alias("captured"),
                F.try_divide(hits.cast("double"), F.lit(positives)).alias("capture_rate"),
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def gains_lift(ks_by_score: dict[str, DataFrame]) -> DataFrame:
    """Points of the gains and lift charts of several scores: a zero row, then the slices."""
    out = None
    for name, ks in ks_by_score.items():
        slices = ks.select(
            F.dense_rank().over(_report()).cast("int").alias("n"), F.col("cumm_bad").alias("gain")
        )
        share = (F.col("n") * F.lit(100.0) / F.count(F.lit(1)).over(_all())).alias("random_guess")
        points = slices.select(share, "gain", (F.col("gain") / share).alias("lift"))
        zero = ks.sparkSession.range(1).select(
            F.lit(0.0).alias("random_guess"),
            F.lit(0.0).alias("gain"),
            F.lit(None).cast("double").alias("lift"),
        )
        part = zero.unionByName(points).select(F.lit(name).alias("score"), "*")
        out = part if out is None else out.unionByName(part)
    return out


def decile_report(ks: DataFrame) -> DataFrame:
    """KS table with presentation names and formats."""
    return ks.select(
        F.dense_rank().over(_report()).cast("int").alias("Score"),
        "min_scr",
        "max_scr",
        "total",
        F.col("bads").alias("Targets"),
        F.col("goods").alias("NonTargets"),
        F.col("bad_rate").alias("TargetRate"),
        percent(F.col("cumm_bad")).alias("CumTargetCapRate"),
        percent(F.col("cumm_good")).alias("CumNonTargetCapRate"),
        F.format_string("%.2f", "KS").alias("KS"),
        "max_ks",
    )


def classification_report(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """Precision, recall, F1 and support per class, with macro and weighted averages."""
    y, p = F.col(label).cast("int"), F.col(predicted).cast("int")
    rows = df.filter(y.isNotNull() & p.isNotNull())
    c = rows.agg(*[F.count_if((y == a) & (p == b)).alias(f"n{a}{b}") for a in (0, 1) for b in (0, 1)])

    def ratio(a: Column, b: Column) -> Column:
        return F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))

    rows_per_class = []
    for a in (0, 1):
        b = 1 - a
        hit, miss, alarm = F.col(f"n{a}{a}"), F.col(f"n{a}{b}"), F.col(f"n{b}{a}")
        rows_per_class.append(
            F.struct(
                F.lit(str(a)).alias("class"),
                ratio(hit, hit + alarm).alias("precision"),
                ratio(hit, hit + miss).alias("recall"),
                ratio(2 * hit, 2 * hit + alarm + miss).alias("f1"),
                (hit + miss).alias("support"),
            )
        )
    classes = c.select(F.inline(F.array(*rows_per_class)))
    names = ("precision", "recall", "f1")
    support = F.sum("support")
    macro = classes.agg(
        F.lit("macro avg").alias("class"),
        *[F.avg(n).alias(n) for n in names],
        support.alias("support"),
    )
    weighted = classes.agg(
        F.lit("weighted avg").alias("class"),
        *[
            F.coalesce(F.try_divide(F.sum(F.col(n) * F.col("support")), support), F.lit(0.0)).alias(n)
            for n in names
        ],
        support.alias("support"),
    )
    return classes.unionByName(macro).unionByName(weighted)
