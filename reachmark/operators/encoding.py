"""Weight of evidence, and preparation of training and holdout data."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reachmark.operators.sampling import balance
from reachmark.operators.screening import log_suggestion
from reachmark.operators.select import (
    MISSING_CATEGORY,
    baseline_projection,
    fill_missing,
    keep_columns,
    log_columns,
)
from reachmark.runtime import SMALL_TABLE_ROWS, materialize

# Counts below this are raised to it before shares are taken.
COUNT_FLOOR = 0.5


def woe_table(df: DataFrame, cols: Sequence[str], label: str, fill: bool = True) -> DataFrame:
    """Weight of evidence and information value per (variable, category).

    All variables are counted in one pass. Missing categories count as ``'None'`` unless
    ``fill`` is off, which leaves them out.
    """
    cells = []
    for c in cols:
        value = F.col(c).cast("string")
        if fill:
            value = F.coalesce(value, F.lit(MISSING_CATEGORY))
        cells.append(F.struct(F.lit(c).alias("Variable"), value.alias("Cutoff")))
    rows = df.select(F.col(label).alias("_y"), F.inline(F.array(*cells)))
    counts = rows.filter("Cutoff is not null").groupBy("Variable", "Cutoff").agg(
        F.count("_y").alias("N"), F.sum("_y").cast("double").alias("_e")
    )
    floor = F.lit(COUNT_FLOOR)
    counts = counts.select(
        "Variable",
        "Cutoff",
        "N",
        F.greatest("_e", floor).alias("Events"),
        F.greatest(F.col("N") - F.col("_e"), floor).alias("NonEvents"),
    )
    totals = counts.groupBy("Variable").agg(
        F.sum("Events").alias("_te"), F.sum("NonEvents").alias("_tn")
    )
    # One row per variable: bounded by the columns asked for.
    joined = counts.join(F.broadcast(totals), "Variable")
    pe, pn = F.col("Events") / F.col("_te"), F.col("NonEvents") / F.col("_tn")
    woe = F.log(pe / pn)
    return joined.select(
        "Variable", "Cutoff", "N", "Events", "NonEvents", woe.alias("WoE"), (woe * (pe - pn)).alias("IV")
    )


def information_value(table: DataFrame) -> DataFrame:
    """Total information value per variable."""
    return table.groupBy("Variable").agg(F.sum("IV").alias("IV"))


@dataclass
class WoeModel:
    """A fitted and stored weight-of-evidence table."""

    table: DataFrame
    sizes: dict[str, int]

    @classmethod
    def fit(cls, df: DataFrame, cols: Sequence[str], label: str) -> WoeModel:
        return cls.of(materialize(woe_table(df, cols, label), "woe"))

    @classmethod
    def of(cls, table: DataFrame) -> WoeModel:
        """From a stored table; its size per variable decides how it is joined."""
        counts = table.groupBy("Variable").count().collect()  # one row per variable
        return cls(table, {r["Variable"]: r["count"] for r in counts})

    @classmethod
    def load(cls, spark, path: str) -> WoeModel:
        return cls.of(spark.read.parquet(path))

    def save(self, path: str) -> None:
        self.table.write.mode("overwrite").parquet(path)

    def transform(self, df: DataFrame, strict_reference: bool = False) -> DataFrame:
        """Replace categories by their weight of evidence; unseen ones become null.

        Missing values get the weight of ``'None'``; ``strict_reference`` leaves them null,
        as training data were encoded.
        """
        columns = df.columns
        for c in [v for v in self.sizes if v in columns]:
            lookup = self.table.filter(F.col("Variable") == c).select(
                F.col("Cutoff").alias("_cutoff"), F.col("WoE").alias("_woe")
            )
            if self.sizes[c] <= SMALL_TABLE_ROWS:
                lookup = F.broadcast(lookup)
            value = F.col(c).cast("string")
            if not strict_reference:
                value = F.coalesce(value, F.lit(MISSING_CATEGORY))
            df = df.join(lookup, value == F.col("_cutoff"), "left")
            df = df.drop(c).withColumnRenamed("_woe", c).drop("_cutoff")
        return df.select(*columns)


@dataclass
class Prepared:
    """Prepared rows with what was fitted on them."""

    data: DataFrame
    woe: WoeModel | None
    log_cols: list[str] | None


def prepare_training(
    df: DataFrame,
    label: str,
    key: str,
    cat_cols: Sequence[str],
    num_cols: Sequence[str],
    var_cols: Sequence[str],
    baseline: bool = False,
    balance_kind: str | None = None,
    log: bool = False,
    woe: bool = False,
    seed: int = 1,
) -> Prepared:
    """Project, balance, encode or fill categories, and take logs of skewed numbers."""
    if baseline:
        data = baseline_projection(df, label)
    else:
        data = keep_columns(df, list(dict.fromkeys(var_cols)))
    data = balance(data, label, balance_kind, key, seed)
    if balance_kind and (woe or log):
        # The sample is drawn once; the fits below and the result read the stored rows.
        data = materialize(data, "sample")
    cats = [c for c in cat_cols if c in data.columns]
    model = None
    if woe:
        model = WoeModel.fit(data, cats, label)
        data = model.transform(data)
    else:
        data = fill_missing(data, cats)
    log_cols = None
    if log:
        log_cols = log_suggestion(data, [c for c in num_cols if c in data.columns])
        data = log_columns(data, log_cols)
    return Prepared(data, model, log_cols)


def prepare_holdout(
    df: DataFrame,
    fitted: Prepared,
    model_vars: Sequence[str],
    cat_cols: Sequence[str] = (),
    label: str | None = None,
) -> DataFrame:
    """Apply fitted encodings to new rows; only model variables and the label stay."""
    wanted = [*model_vars, *([label] if label else [])]
    data = df.select(*dict.fromkeys(wanted))
    if fitted.woe is not None:
        data = fitted.woe.transform(data)
    else:
        data = fill_missing(data, [c for c in cat_cols if c in data.columns])
    return log_columns(data, [c for c in fitted.log_cols or [] if c in data.columns])
