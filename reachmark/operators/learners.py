"""Classifier families: features, fitting, search, comparison and a model store.

Three boosted families stand in for three boosting libraries and take their parameters:
``gbt`` (weighted bootstrap, features drawn per level, stops by patience), ``bagged`` (class
bagging every few trees, features drawn per tree, stops by patience) and ``plain`` (least
loss reduction, keeps all trees). Bagged trees (``rf``) and a logistic regression (``lr``) on
MLlib are cheap baselines.
"""

from __future__ import annotations

import datetime
import json
import math
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import Imputer, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reachmark.functions.columns import hash_order
from reachmark.operators import boosting, gains
from reachmark.operators.boosted import BoostedModel, ordered_statistics, statistics_size
from reachmark.operators.search import Proposer
from reachmark.operators.sampling import stratified_folds, stratified_split
from reachmark.operators.select import MISSING_CATEGORY, drop_duplicate_names
from reachmark.runtime import materialize

MIN_ROWS = 100
SEED = 25
PATIENCE = 20
BOOSTED = ("gbt", "bagged", "plain")
FAMILIES = BOOSTED
BASELINES = ("rf", "lr")

# The search spaces of the boosted families, ("uniform", low, high) or
# ("quniform", low, high, step).
SPACES = {
    "gbt": {
        "n_estimators": ("quniform", 100, 1000, 50),
        "max_depth": ("quniform", 3, 5, 1),
        "reg_lambda": ("uniform", 1, 3),
        "learning_rate": ("uniform", 0.001, 0.05),
        "bagging_temperature": ("quniform", 0.1, 1.0, 0.2),
        "scale_pos_weight": ("quniform", 0.01, 1.0, 0.2),
        "colsample_bylevel": ("quniform", 0.3, 0.9, 0.2),
        "subsample": ("quniform", 0.2, 0.9, 0.2),
        "min_child_samples": ("quniform", 100, 500, 100),
    },
    "bagged": {
        "n_estimators": ("quniform", 100, 1000, 50),
        "max_depth": ("quniform", 3, 5, 1),
        "reg_alpha": ("uniform", 1, 3),
        "reg_lambda": ("uniform", 1, 3),
        "learning_rate": ("uniform", 0.001, 0.05),
        "subsample": ("quniform", 0.5, 0.9, 0.2),
        "pos_bagging_fraction": ("quniform", 0.1, 1.0, 0.2),
        "neg_bagging_fraction": ("quniform", 0.1, 1.0, 0.2),
        "colsample_bytree": ("quniform", 0.3, 0.9, 0.2),
        "min_child_samples": ("quniform", 100, 500, 100),
    },
    "plain": {
        "n_estimators": ("quniform", 100, 1000, 50),
        "max_depth": ("quniform", 3, 5, 1),
        "reg_alpha": ("uniform", 1, 3),
        "reg_lambda": ("uniform", 1, 3),
        "gamma": ("quniform", 0.0, 1.0, 0.001),
        "learning_rate": ("uniform", 0.001, 0.05),
        "scale_pos_weight": ("quniform", 0.01, 1.0, 0.2),
        "colsample_bylevel": ("quniform", 0.3, 0.9, 0.2),
        "subsample": ("quniform", 0.2, 0.9, 0.2),
        "min_child_weight": ("quniform", 0.01, 0.1, 0.01),
    },
    "rf": {
        "n_estimators": ("quniform", 100, 1000, 50),
        "max_depth": ("quniform", 3, 5, 1),
        "subsample": ("quniform", 0.5, 0.9, 0.2),
        "colsample_bytree": ("quniform", 0.3, 0.9, 0.2),
        "min_child_samples": ("quniform", 100, 500, 100),
    },
    "lr": {
        "reg_lambda": ("uniform", 0.0, 0.1),
        "elastic_net": ("uniform", 0.0, 1.0),
        "scale_pos_weight": ("quniform", 0.01, 1.0, 0.2),
    },
}


# What each family takes; other parameters are refused, not ignored.
COLUMN_SHARES = ("colsample_bytree", "colsample_bylevel")
_ROWS = {"seed", "scale_pos_weight", "pos_bagging_fraction", "neg_bagging_fraction"}
_TREES = {"n_estimators", "max_depth", "subsample", "min_child_samples", "min_child_weight", "gamma", *COLUMN_SHARES}
_BOOSTED = _ROWS | _TREES | {"learning_rate", "reg_alpha", "reg_lambda", "bagging_temperature", "max_bin", "patience"}
PARAMETERS = {
    **dict.fromkeys(BOOSTED, _BOOSTED),
    "rf": _ROWS | _TREES,
    "lr": _ROWS | {"reg_lambda", "elastic_net", "max_iter"},
}


class InsufficientRecordsError(ValueError):
    pass


@dataclass(frozen=True)
class ModelSpec:
    """Column roles of a model."""

    target: str
    key: str
    numeric: tuple[str, ...] = ()
    categorical: tuple[str, ...] = ()
    weight: str = "wt"

    @property
    def columns(self) -> list[str]:
        named = [self.key, self.target, self.weight, *self.numeric, *self.categorical]
        return list(dict.fromkeys(named))


def validate_input(df: DataFrame, spec: ModelSpec, given_weight: bool = False) -> DataFrame:
    """Checked rows: no repeated names, a whole-number target, a weight (1 by default)."""
    if not isinstance(df, DataFrame):
        raise TypeError("the input must be a DataFrame")
    df = drop_duplicate_names(df)
    if spec.target not in df.columns:
        raise KeyError(f"missing target column: {spec.target}")
    if spec.weight not in df.columns:
        if given_weight:
            raise KeyError(f"missing weight column: {spec.weight}")
        df = df.withColumn(spec.weight, F.lit(1.0))
    if df.limit(MIN_ROWS).count() < MIN_ROWS:
        raise InsufficientRecordsError(f"at least {MIN_ROWS} records are needed")
    return df.withColumn(spec.target, F.col(spec.target).cast("int"))


def _feature_stages(spec: ModelSpec, one_hot: bool) -> list:
    stages, parts = [], []
    if spec.numeric:
        filled = [f"{c}__num" for c in spec.numeric]
        stages.append(Imputer(inputCols=list(spec.numeric), outputCols=filled))
        parts += filled
    if spec.categorical:
        coded = [f"{c}__idx" for c in spec.categorical]
        stages.append(
            StringIndexer(inputCols=list(spec.categorical), outputCols=coded, handleInvalid="keep")
        )
        if one_hot:
            hot = [f"{c}__hot" for c in spec.categorical]
            stages.append(OneHotEncoder(inputCols=coded, outputCols=hot, handleInvalid="keep"))
            coded = hot
        parts += coded
    return [*stages, VectorAssembler(inputCols=parts, outputCol="features")]


def _typed(df: DataFrame, spec: ModelSpec) -> DataFrame:
    cols = {c: F.col(c).cast("double") for c in spec.numeric}
    cols |= {
        c: F.coalesce(F.col(c).cast("string"), F.lit(MISSING_CATEGORY)) for c in spec.categorical
    }
    return df.withColumns(cols) if cols else df


def _checked(family: str, params: dict) -> dict:
    if family not in PARAMETERS:
        raise ValueError(f"unknown family: {family}")
    if unknown := sorted(set(params) - PARAMETERS[family]):
        raise ValueError(f"{family} has no parameter {', '.join(unknown)}")
    return params


def boost_params(family: str, params: dict) -> boosting.BoostParams:
    """Boosting by the parameters of a family; each has its own defaults."""
    p = _checked(family, params)
    share = lambda name: min(1.0, max(0.01, float(p.get(name, 1.0))))
    return boosting.BoostParams(
        trees=int(p.get("n_estimators", 100)),
        depth=int(p.get("max_depth", 4)),
        rate=float(p.get("learning_rate", 0.1)),
        l1=float(p.get("reg_alpha", 0.0)),
        l2=float(p.get("reg_lambda", 0.0 if family == "bagged" else 1.0)),
        gamma=float(p.get("gamma", 0.0)),
        min_rows=int(p.get("min_child_samples", 1)),
        min_hessian=float(p.get("min_child_weight", 0.0)),
        subsample=share("subsample"),
        positive_share=share("pos_bagging_fraction"),
        negative_share=share("neg_bagging_fraction"),
        bagging_every=5 if family == "bagged" else 1,
        tree_share=share("colsample_bytree"),
        level_share=share("colsample_bylevel"),
        temperature=float(p.get("bagging_temperature", 0.0)),
        bins=int(p.get("max_bin", 64)),
        patience=int(p.get("patience", 0 if family == "plain" else PATIENCE)),
        seed=int(p.get("seed", SEED)),
    )


def _estimator(family: str, params: dict, categories: int):
    params = _checked(family, params)
    seed = int(params.get("seed", SEED))
    common = {"labelCol": "_label", "weightCol": "_weight", "featuresCol": "features"}
    if family == "lr":
        return LogisticRegression(
            regParam=float(params.get("reg_lambda", 0.0)),
            elasticNetParam=float(params.get("elastic_net", 0.0)),
            maxIter=int(params.get("max_iter", 50)),
            **common,
        )
    # MLlib draws features once per split; shares per tree and per level are drawn there, too.
    features = math.prod(float(params.get(k, 1.0)) for k in COLUMN_SHARES)
    return RandomForestClassifier(
        numTrees=int(params.get("n_estimators", 20)),
        maxDepth=int(params.get("max_depth", 4)),
        subsamplingRate=min(1.0, max(0.05, float(params.get("subsample", 1.0)))),
        featureSubsetStrategy=str(min(1.0, max(0.05, features))),
        minInstancesPerNode=max(1, int(params.get("min_child_samples", 1))),
        minWeightFractionPerNode=min(0.49, float(params.get("min_child_weight", 0.0))),
        minInfoGain=float(params.get("gamma", 0.0)),
        maxBins=max(32, categories + 2),
        seed=seed,
        **common,
    )


def with_training_columns(df: DataFrame, spec: ModelSpec, params: dict, validation: float = 0.1, once: bool = True):
    """Label, weight and early-stopping mark of training rows.

    The rows for early stopping are a hash share of the training rows: the test sample
    stays unseen.
    """
    boost = float(params.get("scale_pos_weight") or 1.0)
    weight = F.col(spec.weight).cast("double")
    held_out = hash_order(F.col(spec.key), SEED + 1) < int(validation * 2**32)
    # Bagging fractions draw a share of each class, by hash.
    share = F.when(F.col(spec.target) == 1, float(params.get("pos_bagging_fraction", 1.0)))
    share = share.otherwise(float(params.get("neg_bagging_fraction", 1.0)))
    # Boosted families draw per tree, not once.
    if once and {"pos_bagging_fraction", "neg_bagging_fraction"} & set(params):
        df = df.filter(hash_order(F.col(spec.key), SEED + 2) < share * 2**32)
    return _typed(df, spec).withColumns(
        {
            "_label": F.col(spec.target).cast("double"),
            "_weight": F.when(F.col(spec.target) == 1, weight * boost).otherwise(weight),
            "_validation": held_out,
        }
    )


@dataclass
class Fitted:
    """A fitted model with its family, parameters and column roles."""

    model: PipelineModel | BoostedModel
    family: str
    params: dict
    spec: ModelSpec

    def score(self, df: DataFrame, name: str = "proba") -> DataFrame:
        """Rows with the probability of class 1."""
        if isinstance(self.model, BoostedModel):
            return self.model.score(df, name)
        scored = self.model.transform(_typed(df, self.spec))
        proba = vector_to_array("probability")[1].alias(name)
        return scored.select(*[scored[c] for c in df.columns if c != name], proba)


def _categories(features: PipelineModel) -> int:
    """Values of the widest categorical column."""
    listed = [x for s in features.stages if hasattr(s, "labelsArray") for x in s.labelsArray]
    return max(map(len, listed), default=0)


def fit_family(df: DataFrame, spec: ModelSpec, family: str, params: dict | None = None) -> Fitted:
    """Fit one family on training rows."""
    params = params or {}
    if family in BOOSTED:
        return _fit_boosted(df, spec, family, params)
    _checked(family, params)
    rows = with_training_columns(df, spec, params)
    features = Pipeline(stages=_feature_stages(spec, one_hot=family == "lr")).fit(rows)
    model = _estimator(family, params, _categories(features)).fit(features.transform(rows))
    return Fitted(PipelineModel(stages=[*features.stages, model]), family, params, spec)


def _fit_boosted(df: DataFrame, spec: ModelSpec, family: str, params: dict) -> Fitted:
    """Boosted trees; categories of any number enter by their ordered statistics."""
    p = boost_params(family, params)
    rows = with_training_columns(df.select(*spec.columns), spec, params, once=False)
    if not p.patience:
        rows = rows.withColumn("_validation", F.lit(False))
    stats, prior, encoded = None, 0.0, []
    if spec.categorical:
        key = F.col(spec.key)
        rows, stats, prior = ordered_statistics(rows, spec.categorical, F.col("_label"), key, F.col("_validation"), p.seed)
        encoded = [F.coalesce(f"_s{i}", F.lit(prior)) for i in range(len(spec.categorical))]
    features = [F.col(c) for c in spec.numeric] + encoded
    names = [*spec.numeric, *spec.categorical]
    grown = boosting.boost(
        rows, names, features, F.col("_label"), F.col("_weight"), F.col(spec.key), F.col("_validation"), p
    )
    model = BoostedModel(
        grown.trees, spec.numeric, spec.categorical, prior, stats, statistics_size(stats), grown.watched
    )
    return Fitted(model, family, params, spec)


@dataclass
class Trial:
    no: int
    family: str
    params: dict
    loss: float
    metrics: dict[str, dict[str, float]] = field(default_factory=dict)
    monotone: bool = False


class Search:
    """Search over the families: propose, fit on train, measure on train and test.

    Proposals learn from a family's earlier trials; ``learns=False`` draws them at random.
    """

    def __init__(
        self,
        spec: ModelSpec,
        families: Sequence[str] = FAMILIES,
        spaces: dict[str, dict] | None = None,
        n_iter: int = 10,
        kfolds: int = 0,
        test_size: float = 0.2,
        seed: int = SEED,
        learns: bool = True,
    ):
        self.learns = learns
        self.spec, self.families, self.seed = spec, list(families), seed
        self.spaces = SPACES | (spaces or {})
        self.n_iter, self.kfolds, self.test_size = n_iter, kfolds, test_size
        self.trials: list[Trial] = []
        self.finals: dict[str, Fitted] = {}
        self.folded: DataFrame | None = None

    def split(self, df: DataFrame) -> None:
        """Stratified train and test samples, stored once for all trials."""
        rows = validate_input(df, self.spec).select(*self.spec.columns)
        train, test = stratified_split(
            rows, self.spec.key, self.test_size, self.spec.target, self.seed
        )
        self.train, self.test = materialize(train, "train"), materialize(test, "test")
        self.folded = None

    def folds(self) -> DataFrame:
        """The training rows with their folds, which are ranked and stored once for all trials."""
        if self.folded is None:
            folded = stratified_folds(self.train, self.spec.key, self.kfolds, self.spec.target, self.seed)
            self.folded = materialize(folded, "folds")
        return self.folded

    def run(self, df: DataFrame) -> list[Trial]:
        self.split(df)
        for family in self.families:
            proposer = Proposer(self.spaces[family], f"{self.seed}-{family}", learns=self.learns)
            for no in range(1, self.n_iter + 1):
                trial = self._trial(no, family, proposer.next())
                proposer.tell(trial.params, trial.loss)
                self.trials.append(trial)
        return self.trials

    def _trial(self, no: int, family: str, params: dict) -> Trial:
        fitted = fit_family(self.train, self.spec, family, params)
        metrics, monotone = self.measure(fitted)
        score = metrics["ROC_AUC"]["OOT"]
        if self.kfolds:
            score = self._cross_validate(family, params)
        return Trial(no, family, params, 1 - score, metrics, monotone)

    def _cross_validate(self, family: str, params: dict) -> float:
        folded = self.folds()
        if family in BOOSTED:
            areas = []
            for k in [r[0] for r in folded.select("fold").distinct().orderBy("fold").collect()]:
                fitted = fit_family(folded.filter(F.col("fold") != k), self.spec, family, params)
                scored = fitted.score(folded.filter(F.col("fold") == k)).select(self.spec.target, self.spec.weight, "proba")
                scored = materialize(scored, "scored")  # the measure reads them several times
                areas.append(gains.auc_gini(scored, self.spec.target, "proba", self.spec.weight).first()["auc"])
            return sum(areas) / len(areas)
        rows = with_training_columns(folded, self.spec, params)
        stages = _feature_stages(self.spec, one_hot=family == "lr")
        # The folds are fitted with the estimator that a refit on all of them uses.
        found = _categories(Pipeline(stages=stages).fit(rows)) if self.spec.categorical else 0
        cv = CrossValidator(
            estimator=Pipeline(stages=[*stages, _estimator(family, params, found)]),
            estimatorParamMaps=ParamGridBuilder().build(),
            evaluator=BinaryClassificationEvaluator(labelCol="_label", weightCol="_weight"),
            numFolds=self.kfolds,
            foldCol="fold",
            parallelism=self.kfolds,
        )
        return float(cv.fit(rows).avgMetrics[0])

    def measure(self, fitted: Fitted) -> tuple[dict, bool]:
        """Development and test measures of the gains table."""
        s = self.spec
        keep = [s.key, s.target, s.weight]
        scored = [
            materialize(fitted.score(rows).select(*keep, "proba"), "scored")
            for rows in (self.train, self.test)
        ]
        rows = gains.ks_stability(*scored, s.target, "proba", s.weight, s.key).collect()
        found = {r["metric"]: {"Dev": r["Dev"], "OOT": r["OOT"], "Diff": r["Diff"]} for r in rows}
        return found, bool(rows[0]["Bad_Rate"])

    def trials_table(self, spark: SparkSession) -> DataFrame:
        """One row per trial and measure."""
        rows = [
            (t.family, t.no, json.dumps(t.params, sort_keys=True), t.loss, m, v["Dev"], v["OOT"], v["Diff"], t.monotone)
            for t in self.trials
            for m, v in t.metrics.items()
        ]
        return spark.createDataFrame(
            rows,
            "family string, trial int, params string, loss double, metric string, Dev double, "
            "OOT double, Diff double, Bad_Rate boolean",
        )

    def refit(self, family: str, trial: int | None = None) -> Fitted:
        """Fit the best trial of a family, or the given one (counted from 1)."""
        own = [t for t in self.trials if t.family == family]
        if trial is None:
            chosen = min(own, key=lambda t: t.loss)
        elif isinstance(trial, int) and 0 < trial <= len(own):
            chosen = own[trial - 1]
        else:
            raise ValueError(f"trial must be a whole number from 1 to {len(own)}")
        self.finals[family] = fit_family(self.train, self.spec, family, chosen.params)
        return self.finals[family]

    def compare(self, trials: dict[str, int] | None = None) -> tuple[DataFrame, str]:
        """Test measures per refitted family, and the one with the best AUC (first wins)."""
        out = None
        for family in self.families:
            fitted = self.refit(family, (trials or {}).get(family))
            scored = materialize(
                fitted.score(self.test).select(self.spec.target, "proba"), "compared"
            )
            part = model_metrics(scored, self.spec.target, "proba", family)
            out = part if out is None else out.unionByName(part)
        out = materialize(out, "comparison")
        auc = {r["family"]: r["auc"] for r in out.collect()}  # one row per family
        return out, max(self.families, key=lambda f: auc[f])

    def metric_report(self, spark: SparkSession) -> DataFrame:
        """Development and test measures of each refitted family, side by side."""
        rows = []
        for family, fitted in self.finals.items():
            metrics, monotone = self.measure(fitted)
            trees = tree_count(fitted)
            rows += [
                (family, m, v["Dev"], v["OOT"], v["Diff"], monotone, trees)
                for m, v in metrics.items()
            ]
        return spark.createDataFrame(
            rows,
            "family string, metric string, Dev double, OOT double, Diff double, "
            "Bad_Rate boolean, Best_N_Tree int",
        )

    def final(self, family: str) -> Fitted:
        if family not in self.finals:
            raise ValueError(f"unknown final model: {family}")
        return self.finals[family]


def model_metrics(df: DataFrame, label: str, score: str, family: str) -> DataFrame:
    """AUC, PR-AUC, no-skill rate, F1, precision and recall of one scored sample."""
    auc = gains.auc_gini(df, label, score).select("auc").scalar()
    pr = gains.pr_auc(df, label, score).select(F.struct("pr_auc", "no_skill")).scalar()
    at_half = gains.classification_metrics(df, label, score)
    return at_half.select(
        F.lit(family).alias("family"),
        auc.alias("auc"),
        pr.getField("pr_auc").alias("pr_auc"),
        pr.getField("no_skill").alias("no_skill"),
        "f1",
        "precision",
        "recall",
    )


def feature_names(model: PipelineModel) -> list[str]:
    """Names of the assembled features, by the column they come from."""
    assembler = next(s for s in model.stages if isinstance(s, VectorAssembler))
    return [c.rsplit("__", 1)[0] for c in assembler.getInputCols()]


def tree_count(fitted: Fitted) -> int | None:
    """Trees that a model keeps."""
    if isinstance(fitted.model, BoostedModel):
        return len(fitted.model.trees)
    return getattr(fitted.model.stages[-1], "getNumTrees", None)


def importance_share(fitted: Fitted, spark: SparkSession) -> DataFrame:
    """Feature importance with its share of the total, largest first (tree families)."""
    if isinstance(fitted.model, BoostedModel):
        names, values = fitted.model.trees.features, fitted.model.trees.importance()
    else:
        names, values = feature_names(fitted.model), fitted.model.stages[-1].featureImportances.toArray()
    rows = [(n, float(v)) for n, v in zip(names, values)]
    table = spark.createDataFrame(rows, "variable string, importance double")
    total = F.sum("importance").over(
        Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    share = F.try_divide(F.col("importance"), total)
    return table.withColumn("share", share).orderBy(F.desc("importance"), "variable")


def tree_importance(df: DataFrame, spec: ModelSpec) -> DataFrame:
    """Importance ranking of a boosted model with default parameters."""
    return importance_share(fit_family(df, spec, "gbt"), df.sparkSession)


# -- model store ------------------------------------------------------------------------

_RUNS = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("model_name", T.StringType()),
        T.StructField("family", T.StringType()),
        T.StructField("params", T.StringType()),
        T.StructField("spec", T.StringType()),
        T.StructField("auc_train", T.DoubleType()),
        T.StructField("trained_on", T.DateType()),
        T.StructField("path", T.StringType()),
    ]
)


def save_run(
    spark: SparkSession,
    root: str,
    name: str,
    fitted: Fitted,
    auc_train: float | None = None,
    trained_on: datetime.date | None = None,
) -> str:
    """Save a model under ``root`` and add its row to the runs table; returns the run id."""
    run_id = uuid.uuid4().hex
    path = f"{root}/models/{run_id}"
    if isinstance(fitted.model, BoostedModel):
        fitted.model.save(spark, path)
    else:
        fitted.model.write().overwrite().save(path)
    spec = {**fitted.spec.__dict__}
    row = (run_id, name, fitted.family, json.dumps(fitted.params), json.dumps(spec), auc_train, trained_on or datetime.date.today(), path)
    spark.createDataFrame([row], _RUNS).coalesce(1).write.mode("append").parquet(f"{root}/runs")
    return run_id


def runs_table(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(_RUNS).parquet(f"{root}/runs")


def load_run(spark: SparkSession, root: str, run_id: str) -> Fitted:
    """A saved model by its run id."""
    row = runs_table(spark, root).filter(F.col("run_id") == run_id).first()
    if row is None:
        raise KeyError(f"no such run: {run_id}")
    if row["family"] not in PARAMETERS:
        raise ValueError(f"unknown family: {row['family']}")
    spec = json.loads(row["spec"])
    spec = ModelSpec(**{k: tuple(v) if isinstance(v, list) else v for k, v in spec.items()})
    boosted = row["family"] in BOOSTED
    model = BoostedModel.load(spark, row["path"]) if boosted else PipelineModel.load(row["path"])
    return Fitted(model, row["family"], json.loads(row["params"]), spec)

