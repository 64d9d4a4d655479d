"""Projection, filling and column roles."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reachmark.functions.columns import cap, first_present

# Fixed column lists of the baseline mailing experiment.
BASELINE_COLUMNS = (
    "non_fin_trade_balance", "comptype_hq", "bus_strt_yr", "d_sat_hq", "pexp_30", "pexp_sat",
    "pydx_1", "totdoll_hq", "amtowed30", "nbrpayexpsslow", "pr_bankruptcy_ind", "buydex",
)
MAILED_COLUMNS = (
    "cadence_pattern", "timesmailed", "months_since_first", "months_since_last", "flg_mailed",
    "mailed_6mo", "mailed_12mo",
)
MANDATORY_COLUMNS = ("TIB", "ags_model_250k", "mail_date", "chg_flg", "duns")

# What stands for a missing category.
MISSING_CATEGORY = "None"


def keep_columns(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """The wanted columns that exist."""
    return df.select(*first_present(df.columns, wanted))


def drop_columns(df: DataFrame, unwanted: Sequence[str]) -> DataFrame:
    return df.drop(*unwanted)


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def drop_duplicate_names(df: DataFrame) -> DataFrame:
    """Keep the first of columns with equal names (as Spark compares them, ignoring case)."""
    seen: set[str] = set()
    first = []
    for i, c in enumerate(df.columns):
        if c.lower() not in seen:
            seen.add(c.lower())
            first.append((f"_c{i}", c))
    numbered = df.toDF(*[f"_c{i}" for i in range(len(df.columns))])
    return numbered.select(*[F.col(n).alias(c) for n, c in first])


@dataclass(frozen=True)
class Roles:
    categorical: list[str]
    numeric: list[str]


def column_roles(df: DataFrame, label: str, exclude: Sequence[str] = ()) -> Roles:
    """Text columns and those named ``chg...`` are categorical, others numeric; both lists
    end with the label."""
    out = {*exclude, label}
    cats = [
        f.name
        for f in df.schema
        if f.name not in out and (isinstance(f.dataType, T.StringType) or f.name.startswith("chg"))
    ]
    nums = [c for c in df.columns if c not in out and c not in cats]
    return Roles([*cats, label], [*nums, label])


def model_columns(df: DataFrame, selected: Sequence[str], target: str, weight: str) -> Roles:
    """Selected variables without repeats, target and weight, by type."""
    kept = [c for c in dict.fromkeys(selected) if c not in (target, weight)]
    numeric = [c for c in kept if isinstance(df.schema[c].dataType, T.NumericType)]
    return Roles([c for c in kept if c not in numeric], numeric)


def fill_missing(df: DataFrame, categorical: Sequence[str] = (), numeric: Sequence[str] = ()):
    """Missing categories become ``'None'``, missing numbers 0."""
    if categorical:
        df = df.na.fill(MISSING_CATEGORY, list(categorical))
    return df.na.fill(0, list(numeric)) if numeric else df


def cap_columns(df: DataFrame, bounds: dict[str, tuple[float, float]]) -> DataFrame:
    """Clip columns to their (low, high) bounds."""
    return df.withColumns({c: cap(F.col(c), lo, hi) for c, (lo, hi) in bounds.items()})


def log_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``ln(x + 1)`` of the listed columns."""
    return df.withColumns({c: F.log1p(c) for c in cols}) if cols else df


def baseline_projection(
    df: DataFrame,
    label: str,
    baseline: Sequence[str] = BASELINE_COLUMNS,
    mailed: Sequence[str] = MAILED_COLUMNS,
    mandatory: Sequence[str] = MANDATORY_COLUMNS,
) -> DataFrame:
    """Baseline, mailing and mandatory columns that exist, plus the label.

    A response model also keeps the mailed flag.
    """
    needed = [*mandatory, "flg_mailed"] if label == "flg_resp" else list(mandatory)
    wanted = dict.fromkeys([*baseline, *mailed, *needed, label])
    return keep_columns(df, list(wanted))


def empty_columns(df: DataFrame) -> list[str]:
    """Columns without any value."""
    row = df.agg(*[F.count(c).alias(c) for c in df.columns]).first()
    return [c for c in df.columns if row[c] == 0]
