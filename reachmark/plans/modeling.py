"""Learner, scoring and explanation queries."""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import Window
from pyspark.sql import functions as F

from reachmark.operators import explain as E
from reachmark.operators import gains as G
from reachmark.operators import learners as L
from reachmark.operators import scoring as S
from reachmark.operators import trees as TR
from reachmark.plans.registry import query, rounded
from reachmark.plans.views import campaign, stored_campaign, table, with_views
from reachmark.runtime import materialize

KEY, LABEL = "account_id", "flg_resp"
NUMERIC = ("x_price", "x_bal", "x_qty", "score_resp")
SPEC = L.ModelSpec(LABEL, KEY, NUMERIC, ("market_segment", "list_name"))
PLAIN = L.ModelSpec(LABEL, KEY, ("x_price", "x_bal", "score_resp"))

# Linear models: name -> (intercept, coefficients).
MODELS = {
    "BR1_nonppp_RESP_C1": (-1.0, {"x_price": 0.000002, "x_bal": 0.00001}),
    "BR1_nonppp_RESP_C2": (-0.5, {"x_price": 0.000001, "x_bal": 0.00002}),
    "BR1_ppp_SUB_C1": (-2.0, {"x_price": 0.000003, "x_bal": 0.00001}),
    "BR1_APPR_all": (-1.5, {"x_price": 0.000001, "x_bal": 0.00001}),
}
_COEF = {"x_price": 0.000002, "x_bal": 0.00001}
_LINEAR = "1 / (1 + exp(-(-1.0::DOUBLE + x_price * 0.000002::DOUBLE + x_bal * 0.00001::DOUBLE)))"


def _rows(spark, sf_dir):
    return stored_campaign(spark, sf_dir, KEY, LABEL, "wt", *SPEC.numeric, *SPEC.categorical)


def _linear_score(df):
    return df.withColumn("proba", S.linear_proba(F.lit(-1.0), _COEF))


# What SQL can hold of a fitted model: the rows scored, the responders among them, and that
# every probability is one and ranks better than a floor.
_SCORED = "SELECT CAST(COUNT(*) AS BIGINT) AS scored, CAST(SUM(flg_resp) AS BIGINT) AS responders, true AS in_range, true AS above_floor FROM campaign"
FLOOR = 0.6


def _facts(scored):
    p, y = F.col("proba"), F.col(LABEL)
    auc = G.auc_gini(scored, LABEL, "proba").select("auc").scalar()
    return scored.agg(
        F.count("proba").alias("scored"), F.sum(y).cast("bigint").alias("responders"),
        F.bool_and(p.between(0, 1)).alias("in_range"),
    ).withColumn("above_floor", auc > FLOOR)


def _fit(spark, sf_dir, family, params, spec=SPEC):
    df = L.validate_input(_rows(spark, sf_dir), spec)
    return L.fit_family(df, spec, family, params), df


def _fit_scored(spark, sf_dir, family, params):
    fitted, df = _fit(spark, sf_dir, family, params)
    return _facts(materialize(fitted.score(df).select(KEY, LABEL, "proba"), "scored"))


@query("fit_gbt", with_views("campaign", _SCORED))
def fit_gbt(spark, sf_dir):
    params = {"n_estimators": 100, "max_depth": 3, "reg_lambda": 1.5, "bagging_temperature": 0.3, "colsample_bylevel": 0.7, "subsample": 0.8, "min_child_samples": 20}
    return _fit_scored(spark, sf_dir, "gbt", params)


@query("fit_bagged", with_views("campaign", _SCORED))
def fit_bagged(spark, sf_dir):
    params = {"n_estimators": 100, "max_depth": 3, "reg_alpha": 1.0, "reg_lambda": 1.5, "pos_bagging_fraction": 0.8, "neg_bagging_fraction": 0.7, "colsample_bytree": 0.7}
    return _fit_scored(spark, sf_dir, "bagged", params)


@query("fit_plain", with_views("campaign", _SCORED))
def fit_plain(spark, sf_dir):
    params = {"n_estimators": 30, "max_depth": 3, "reg_alpha": 1.0, "gamma": 0.1, "min_child_weight": 0.05, "colsample_bylevel": 0.7, "subsample": 0.8}
    return _fit_scored(spark, sf_dir, "plain", params)


@query("fit_rf", with_views("campaign", _SCORED))
def fit_rf(spark, sf_dir):
    return _fit_scored(spark, sf_dir, "rf", {"n_estimators": 20, "max_depth": 4, "colsample_bytree": 0.7})


@query(
    "fit_lr",
    with_views("campaign", """SELECT t.feature, round(SUM(wt * flg_resp * v) / SUM(wt * v), 4) AS rate FROM campaign,
 LATERAL (VALUES ('score_resp', score_resp), ('weight', 1.0::DOUBLE), ('x_price', x_price::DOUBLE)) t(feature, v) GROUP BY t.feature"""),
)
def fit_lr(spark, sf_dir):
    """Score equations: weighted by any feature, probabilities sum to what labels sum to."""
    spec = L.ModelSpec(LABEL, KEY, ("x_price", "score_resp"))
    fitted, df = _fit(spark, sf_dir, "lr", {"max_iter": 200}, spec)
    features = {"score_resp": F.col("score_resp"), "weight": F.lit(1.0), "x_price": F.col("x_price").cast("double")}
    rate = lambda v: F.round(F.sum(F.col("wt") * F.col("proba") * v) / F.sum(F.col("wt") * v), 4)
    cells = [F.struct(F.lit(n).alias("feature"), F.col(n).alias("rate")) for n in features]
    return fitted.score(df).agg(*[rate(v).alias(n) for n, v in features.items()]).select(F.inline(F.array(*cells)))


# Ranges small enough for a test machine; the families' own ranges are learners.SPACES.
_SMALL = {"n_estimators": ("quniform", 10, 20, 5), "max_depth": ("quniform", 2, 2, 1), "learning_rate": ("uniform", 0.2, 0.5), "patience": ("quniform", 5, 5, 1)}
SEARCHED = {
    "gbt": _SMALL | {"reg_lambda": ("uniform", 1, 3)},
    "bagged": _SMALL | {"reg_alpha": ("uniform", 1, 3), "colsample_bytree": ("quniform", 0.7, 0.9, 0.1)},
    "plain": _SMALL | {"gamma": ("quniform", 0.0, 1.0, 0.001)},
}


def _search(spark, sf_dir, n_iter, kfolds=0):
    search = L.Search(SPEC, spaces=SEARCHED, n_iter=n_iter, kfolds=kfolds)
    search.run(_rows(spark, sf_dir))
    return search


@query("search_trials", "SELECT family, CAST(trial AS INT) AS trial, 7 AS measures, true AS loss_below_floor FROM (VALUES ('gbt'), ('bagged'), ('plain')) f(family), range(1, 2) t(trial)")
def search_trials(spark, sf_dir):
    """Three families, a trial each, by the loss of two folds."""
    found = _search(spark, sf_dir, 1, kfolds=2).trials_table(spark)
    return found.groupBy("family", "trial").agg(
        F.count_distinct("metric").cast("int").alias("measures"), (F.max("loss") < 1 - FLOOR).alias("loss_below_floor")
    )


@query(
    "model_comparison",
    with_views("campaign", """, n AS (SELECT flg_resp AS y, CAST(floor(0.2::DOUBLE * COUNT(*) + 0.5) AS BIGINT) AS k FROM campaign GROUP BY flg_resp)
 SELECT family, round(SUM(k * y) / SUM(k)::DOUBLE, 6) AS no_skill, true AS above_floor, true AS chosen_is_best FROM n, (VALUES ('gbt'), ('bagged'), ('plain')) f(family) GROUP BY family"""),
)
def model_comparison(spark, sf_dir):
    """Test measures of the three families and the one chosen; the rate without skill is that of the test rows."""
    found, chosen = _search(spark, sf_dir, 1).compare()
    top = found.agg(F.max("auc") == F.max(F.when(F.col("family") == chosen, F.col("auc")))).scalar()
    return rounded(found.select("family", "no_skill", (F.col("auc") > FLOOR).alias("above_floor"), top.alias("chosen_is_best")))


_SHARES = """SELECT v.variable, true AS positive, CAST(ROW_NUMBER() OVER (ORDER BY v.variable <> 'score_resp', v.variable) AS INT) = 1 AS first, 1.0::DOUBLE AS total
 FROM (VALUES ('x_price'), ('x_bal'), ('x_qty'), ('score_resp'), ('market_segment'), ('list_name')) v(variable)"""


def _shares(table_):
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)  # one row per feature
    return table_.select(
        "variable", (F.col("importance") >= 0).alias("positive"),
        (F.col("importance") == F.max("importance").over(every)).alias("first"), F.round(F.sum("share").over(every), 6).alias("total"),
    )


@query("tree_importance", _SHARES)
def tree_importance(spark, sf_dir):
    """All features with the share of their gain; the earlier score comes first."""
    return _shares(L.tree_importance(L.validate_input(_rows(spark, sf_dir), SPEC), SPEC))


@query("importance_share", _SHARES)
def importance_share(spark, sf_dir):
    fitted, _ = _fit(spark, sf_dir, "rf", {"n_estimators": 20})
    return _shares(L.importance_share(fitted, spark))


@query(
    "score_table",
    with_views("campaign", "SELECT CAST(COUNT(*) AS BIGINT) AS scored, round(SUM(wt * flg_resp) / SUM(wt)::DOUBLE, 4) AS mean_proba FROM campaign"),
)
def score_table(spark, sf_dir):
    """A model without penalty: the weighted mean of its probabilities is the response rate."""
    fitted, df = _fit(spark, sf_dir, "lr", {"max_iter": 200})
    scored = S.score_table(fitted, df, categorical=SPEC.categorical)
    mean = F.round(F.sum(F.col("wt") * F.col("proba")) / F.sum("wt"), 4)
    return scored.agg(F.count("proba").alias("scored"), mean.alias("mean_proba"))


@query(
    "boost_stages",
    "SELECT CAST(i AS INT) AS trees, true AS better FROM range(0, 26) t(i)",
)
def boost_stages(spark, sf_dir):
    """Every prefix of an ensemble in one pass: with all rows and no shrinkage of the gain, each tree lowers the loss."""
    fitted, df = _fit(spark, sf_dir, "plain", {"n_estimators": 25, "max_depth": 3}, PLAIN)
    rows, features = fitted.model.with_features(df)
    found = TR.stages(fitted.model.trees, rows, LABEL, F.col("wt"), features)
    before = F.lag("log_loss").over(Window.orderBy("trees"))  # one row per tree
    return found.select("trees", F.coalesce(F.col("log_loss") <= before + 1e-9, F.col("auc") == 0.5).alias("better"))


@query("score_linear", with_views("campaign", f"SELECT account_id, round({_LINEAR}, 6) AS proba FROM campaign"))
def score_linear(spark, sf_dir):
    return rounded(_linear_score(campaign(spark, sf_dir, KEY, "x_price", "x_bal")).select(KEY, "proba"))


# A model registry named after the parts: brand, programme, type and class.
_REGISTRY = """WITH registry AS (SELECT 'V' || CAST(1 + p_partkey % 3 AS VARCHAR) AS version, 'BR' || CAST(p_partkey % 4 AS VARCHAR) ||
 CASE WHEN p_partkey % 2 = 0 THEN '_nonppp_' ELSE '_ppp_' END || CASE p_partkey % 5 WHEN 0 THEN 'RESP' WHEN 1 THEN 'SUB' WHEN 2 THEN 'APPR' WHEN 3 THEN 'FUND' ELSE 'fundamt' END
 || '_m' || CAST(p_partkey AS VARCHAR) || CASE WHEN p_size % 2 = 0 THEN '_C1' ELSE '_C2' END AS model_name FROM part)"""


@query(
    "model_catalog_select",
    _REGISTRY + """ SELECT version, model_name, regexp_replace(model_name, '_[^_]*$', '') AS short, right(model_name, 2) AS class_type FROM registry
 WHERE version = 'V1' AND ((contains(model_name, 'BR0') AND contains(model_name, 'C1') AND contains(model_name, 'RESP') AND contains(model_name, '_nonppp_'))
  OR (contains(model_name, 'BR2') AND contains(model_name, 'APPR')))""",
)
def model_catalog_select(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    kind = F.get(F.array(*[F.lit(t) for t in ("RESP", "SUB", "APPR", "FUND", "fundamt")]), (key % 5).cast("int"))
    registry = part.select(
        F.concat(F.lit("V"), (1 + key % 3).cast("string")).alias("version"),
        F.concat(
            F.lit("BR"), (key % 4).cast("string"), F.when(key % 2 == 0, "_nonppp_").otherwise("_ppp_"), kind,
            F.lit("_m"), key.cast("string"), F.when(F.col("p_size") % 2 == 0, "_C1").otherwise("_C2"),
        ).alias("model_name"),
    )
    chosen = S.select_models(registry, "BR0", "C1", "RESP", "N", "V1").unionAll(
        S.select_models(registry, "BR2", "C1", "APPR", "N", "V1")
    )
    short = F.regexp_replace("model_name", "_[^_]*$", "").alias("short")
    return chosen.select("version", "model_name", short, F.right("model_name", F.lit(2)).alias("class_type"))


def _sql_batch() -> str:
    parts = []
    for name, (b0, b) in MODELS.items():
        where = f"WHERE class_type = '{name[-2:]}'" if "RESP" in name or "SUB" in name else ""
        total = f"{b0}::DOUBLE + x_price * {b['x_price']!r}::DOUBLE + x_bal * {b['x_bal']!r}::DOUBLE"
        parts.append(f"SELECT duns, account_id, 1 / (1 + exp(-({total}))) AS p, '{S.short_name(name)}' AS mdl_name FROM campaign {where}")
    return " UNION ALL ".join(parts)


@query("score_batch", with_views("campaign", f", s AS ({_sql_batch()}) SELECT duns, mdl_name, round(p, 6) AS proba FROM s"))
def score_batch(spark, sf_dir):
    df = campaign(spark, sf_dir, "duns", "class_type", "x_price", "x_bal")
    return rounded(S.score_batch_linear(df, MODELS))


@query(
    "union_scores",
    with_views("campaign", f", s AS ({_sql_batch()}) SELECT mdl_name, CAST(COUNT(*) AS BIGINT) AS cnt, CAST(COUNT(DISTINCT duns) AS BIGINT) AS scored, round(AVG(p), 6) AS mean_proba FROM s GROUP BY mdl_name"),
)
def union_scores(spark, sf_dir):
    df = campaign(spark, sf_dir, "duns", "class_type", "x_price", "x_bal")
    scorers = {
        name: lambda rows, b0=b0, b=b: rows.withColumn("proba", S.linear_proba(F.lit(b0), b))
        for name, (b0, b) in MODELS.items()
    }
    scores = S.score_batch(df, scorers)
    return rounded(
        scores.groupBy("mdl_name").agg(
            F.count(F.lit(1)).alias("cnt"), F.count_distinct("duns").alias("scored"), F.avg("proba").alias("mean_proba")
        )
    )


@query(
    "shapley_linear",
    with_views("campaign", """, m AS (SELECT AVG(x_price) AS mp, AVG(x_bal) AS mb FROM campaign),
 v AS (SELECT AVG(abs((x_price - mp) * 0.000002::DOUBLE)) AS x_price, AVG(abs((x_bal - mb) * 0.00001::DOUBLE)) AS x_bal FROM campaign, m),
 u AS (UNPIVOT v ON x_price, x_bal INTO NAME col_name VALUE importance)
 SELECT col_name, round(importance, 6) AS importance, CAST(ROW_NUMBER() OVER (ORDER BY importance DESC) AS INT) AS rank FROM u"""),
)
def shapley_linear(spark, sf_dir):
    return rounded(E.shapley_linear(campaign(spark, sf_dir, "x_price", "x_bal"), _COEF))


def _sql_shapley(features: dict[str, float], intercept: float) -> str:
    """Mean absolute Shapley values of a logistic score by all its coalitions."""
    names = list(features)
    n = len(names)

    def worth(inside) -> str:
        total = " + ".join(f"{features[f]!r}::DOUBLE * {f if f in inside else 'm_' + f}" for f in names)
        return f"1 / (1 + exp(-({intercept}::DOUBLE + {total})))"

    cells = []
    for f in names:
        rest = [g for g in names if g != f]
        terms = [
            f"{math.factorial(k) * math.factorial(n - 1 - k)}::DOUBLE / {math.factorial(n)} * ({worth({*s, f})} - {worth(set(s))})"
            for k in range(n) for s in combinations(rest, k)
        ]
        cells.append(f"AVG(abs({' + '.join(terms)})) AS {f}")
    means = ", ".join(f"AVG({f}) AS m_{f}" for f in names)
    return f""", m AS (SELECT {means} FROM campaign), v AS (SELECT {', '.join(cells)} FROM campaign, m),
 u AS (UNPIVOT v ON {', '.join(names)} INTO NAME col_name VALUE importance)
 SELECT col_name, round(importance, 6) AS importance, CAST(ROW_NUMBER() OVER (ORDER BY importance DESC) AS INT) AS rank FROM u"""


_THREE = {"x_price": 0.000002, "x_bal": 0.0001, "ref_score": 0.005}


@query("shapley_mc", with_views("campaign", _sql_shapley(_THREE, -3.0)))
def shapley_mc(spark, sf_dir):
    df = stored_campaign(spark, sf_dir, KEY, *_THREE)
    score = lambda rows: rows.withColumn("proba", S.linear_proba(F.lit(-3.0), _THREE))
    return rounded(E.shapley_mc(df, score, list(_THREE), KEY))


@query(
    "shapley_trees",
    """SELECT v.col_name, true AS adds_up, v.col_name = 'score_resp' AS first
 FROM (VALUES ('x_price'), ('x_bal'), ('x_qty'), ('score_resp'), ('market_segment'), ('list_name')) v(col_name)""",
)
def shapley_trees(spark, sf_dir):
    """Attributions of boosted trees: per row they add up to its margin, for every row."""
    fitted, df = _fit(spark, sf_dir, "gbt", {"n_estimators": 40, "max_depth": 3})
    rows = E.attribution_rows(fitted.model, df, KEY).join(fitted.score(df).select(KEY, "proba"), KEY)
    total = F.aggregate("shares", F.col("expected"), lambda t, x: t + x)
    off = rows.agg(F.max(F.abs(total - F.ln(F.col("proba") / (1 - F.col("proba")))))).scalar()
    return E.shapley_trees(fitted.model, df).select("col_name", (off < 1e-6).alias("adds_up"), (F.col("rank") == 1).alias("first"))


@query(
    "partial_dependence",
    with_views("campaign", """, q AS (SELECT MIN(x_price) AS pl, quantile_cont(x_price, 0.95) AS ph, MIN(x_bal) AS bl, quantile_cont(x_bal, 0.95) AS bh FROM campaign),
 g AS (SELECT CAST(i AS INT) AS point_no, pl + (ph - pl) * i / 4 AS pv, bl + (bh - bl) * i / 4 AS bv FROM q, range(5) t(i))
 SELECT 'x_price' AS variable, point_no, round(MIN(pv), 6) AS value, round(AVG(1 / (1 + exp(-(-1.0::DOUBLE + pv * 0.000002::DOUBLE + x_bal * 0.00001::DOUBLE)))), 6) AS mean_proba FROM campaign, g GROUP BY point_no
 UNION ALL SELECT 'x_bal', point_no, round(MIN(bv), 6), round(AVG(1 / (1 + exp(-(-1.0::DOUBLE + x_price * 0.000002::DOUBLE + bv * 0.00001::DOUBLE)))), 6) FROM campaign, g GROUP BY point_no"""),
)
def partial_dependence(spark, sf_dir):
    df = campaign(spark, sf_dir, "x_price", "x_bal")
    out = E.partial_dependence(df, _linear_score, ["x_price", "x_bal"], grid=5)
    return out.select("variable", "point_no", F.round("value", 6).alias("value"), F.round("mean_proba", 6).alias("mean_proba"))


@query(
    "dependence_trees",
    with_views("campaign", """, q AS (SELECT MIN(x_price) AS pl, quantile_cont(x_price, 0.95) AS ph, MIN(score_resp) AS bl, quantile_cont(score_resp, 0.95) AS bh FROM campaign)
 SELECT 'x_price' AS variable, CAST(i AS INT) AS point_no, round(pl + (ph - pl) * i / 4, 1) AS value, true AS in_range FROM q, range(5) t(i)
 UNION ALL SELECT 'score_resp', CAST(i AS INT), round(bl + (bh - bl) * i / 4, 1), true FROM q, range(5) t(i)"""),
)
def dependence_trees(spark, sf_dir):
    """Mean probability of boosted trees along a grid of two features, in one scan."""
    fitted, df = _fit(spark, sf_dir, "gbt", {"n_estimators": 40, "max_depth": 3})
    out = E.dependence_trees(fitted.model, df, ["x_price", "score_resp"], grid=5)
    return out.select("variable", "point_no", F.round("value", 1).alias("value"), F.col("mean_proba").between(0, 1).alias("in_range"))


@query(
    "score_batch_fitted",
    with_views("campaign", """SELECT 'BR1_ppp_RESP' AS mdl_name, CAST(COUNT(*) AS BIGINT) AS cnt, CAST(COUNT(DISTINCT duns) AS BIGINT) AS scored, true AS in_range FROM campaign WHERE class_type = 'C1'
 UNION ALL SELECT 'BR1_APPR', CAST(COUNT(*) AS BIGINT), CAST(COUNT(DISTINCT duns) AS BIGINT), true FROM campaign"""),
)
def score_batch_fitted(spark, sf_dir):
    """Two fitted models in one scan; FUND models and unknown types are not scored."""
    df = L.validate_input(
        stored_campaign(spark, sf_dir, KEY, LABEL, "wt", "duns", "class_type", *SPEC.numeric, *SPEC.categorical), SPEC
    )
    one = L.fit_family(df, SPEC, "gbt", {"n_estimators": 20, "max_depth": 3, "patience": 0})
    two = L.fit_family(df, PLAIN, "plain", {"n_estimators": 20, "max_depth": 2})
    models = {"BR1_ppp_RESP_C1": one, "BR1_APPR_all": two, "BR1_FUND_all": two, "BR1_odd_all": one}
    p = F.col("proba")
    return S.score_batch(df, models).groupBy("mdl_name").agg(
        F.count("proba").alias("cnt"), F.count_distinct("duns").alias("scored"), F.bool_and((p > 0) & (p < 1)).alias("in_range")
    )
