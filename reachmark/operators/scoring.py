"""Scoring of tables, one model or many, and the choice of models by name."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reachmark.operators.boosted import BoostedModel, score_models
from reachmark.operators.encoding import WoeModel
from reachmark.operators.learners import Fitted
from reachmark.operators.lookup import union_by_name
from reachmark.operators.select import fill_missing

log = logging.getLogger(__name__)

# Model types that are scored per account class, and those that are scored on all rows.
CLASS_TYPES = ("RESP", "SUB")
OPEN_TYPES = ("APPR", "FUND", "fundamt")
# Of the latter, those that batch scoring takes; FUND models are selected, but not scored.
SCORED_OPEN_TYPES = ("APPR", "fundamt")
# The version whose model names say nothing about the loan programme.
PLAIN_VERSION = "V50"


def score_table(
    fitted: Fitted,
    df: DataFrame,
    woe: WoeModel | None = None,
    categorical: Sequence[str] = (),
    plain: bool = False,
) -> DataFrame:
    """Add ``proba``: encode (or fill) categories, then apply the model.

    A missing categorical column raises before any job. ``plain`` skips the encoding.
    """
    missing = [c for c in categorical if c not in df.columns]
    if missing:
        raise KeyError(f"categorical variables missing from data: {missing}")
    if not plain:
        df = woe.transform(df) if woe is not None else fill_missing(df, categorical)
    return fitted.score(df)


def linear_proba(intercept: Column, coefficients: dict[str, Column | float]) -> Column:
    """Logistic score of a linear model; a missing feature leaves it null."""
    total = intercept
    for c, b in coefficients.items():
        total = total + b * F.col(c)
    return 1 / (1 + F.exp(-total))


def select_models(
    registry: DataFrame, brand: str, class_type: str, model_type: str, ppp: str, version: str
) -> DataFrame:
    """Registry rows whose name fits a brand, type and, for class models, class and programme."""
    name = F.col("model_name")
    fits = (F.col("version") == version) & name.contains(brand) & name.contains(model_type)
    if model_type in CLASS_TYPES:
        fits = fits & name.contains(class_type)
        if version != PLAIN_VERSION:
            fits = fits & name.contains("_nonppp_" if ppp == "N" else "_ppp_")
    elif model_type not in OPEN_TYPES:
        fits = F.lit(False)
    return registry.filter(fits)


def short_name(name: str) -> str:
    """Model name without its last part."""
    return name.rsplit("_", 1)[0]


def segment_of(name: str) -> Column | None:
    """Rows a model is for: its class, all rows, or none (FUND and unknown types)."""
    if any(t in name for t in CLASS_TYPES):
        return F.col("class_type") == name[-2:]
    if any(t in name for t in SCORED_OPEN_TYPES):
        return F.lit(True)
    return None


def score_batch(
    df: DataFrame, models: dict[str, Fitted | Callable[[DataFrame], DataFrame]], key: str = "duns"
) -> DataFrame:
    """(key, proba, mdl_name) of every model over its segment.

    A model is fitted, or a function that adds ``proba``. All boosted models share one scan, in
    which one Arrow function scores a row by every model and the row's own segments are kept; any other
    model scans its segment by itself. Models of an unknown type are logged and left out.
    """
    parts, boosted = [], {}
    for name, scorer in models.items():
        rows = segment_of(name)
        if rows is None:
            log.error("no segment for model %s", name)
        elif isinstance(scorer, Fitted) and isinstance(scorer.model, BoostedModel):
            boosted[name] = scorer.model
        else:
            scored = (scorer.score if isinstance(scorer, Fitted) else scorer)(df.filter(rows))
            parts.append(scored.select(key, "proba", F.lit(short_name(name)).alias("mdl_name")))
    if boosted:
        parts.insert(0, _score_boosted(df, boosted, key))
    if not parts:
        return df.select(key).limit(0).select(
            key, F.lit(0.0).alias("proba"), F.lit("").alias("mdl_name")
        )
    return union_by_name(parts)


def _score_boosted(df: DataFrame, models: dict[str, BoostedModel], key: str) -> DataFrame:
    needed = [key, *(["class_type"] if "class_type" in df.columns else [])]
    needed += [c for m in models.values() for c in (*m.numeric, *m.categorical)]
    scored = score_models(df.select(*dict.fromkeys(needed)), list(models.values()), "_proba")
    cells = [
        F.when(segment_of(name), F.struct(F.col("_proba")[i].alias("proba"), F.lit(short_name(name)).alias("mdl_name")))
        for i, name in enumerate(models)
    ]
    return scored.select(key, F.inline(F.filter(F.array(*cells), lambda s: s.isNotNull())))


def score_batch_linear(
    df: DataFrame, models: dict[str, tuple[float, dict[str, float]]], key: str = "duns"
) -> DataFrame:
    """The same for linear models, all of them in one pass over the rows."""
    cells = []
    for name, (intercept, coefficients) in models.items():
        rows = segment_of(name)
        if rows is None:
            log.error("no segment for model %s", name)
            continue
        proba = linear_proba(F.lit(intercept), coefficients)
        cell = F.struct(proba.alias("proba"), F.lit(short_name(name)).alias("mdl_name"))
        cells.append(F.when(rows, cell))
    scored = F.filter(F.array(*cells), lambda s: s.isNotNull())
    return df.select(key, F.inline(scored))


def scored_keys(scores: DataFrame, key: str = "duns") -> DataFrame:
    """Distinct keys scored per model."""
    return scores.groupBy("mdl_name").agg(F.count_distinct(key).alias("scored"))
