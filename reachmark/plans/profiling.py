"""Profile, screen and significance queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from reachmark.operators import profile as P
from reachmark.operators import screening as C
from reachmark.operators import significance as T
from reachmark.operators import summary as S
from reachmark.plans.evaluation import _IN_EDGE, sql_quantile_edges
from reachmark.plans.registry import query, rounded
from reachmark.plans.views import campaign, stored_campaign, with_views

PROFILED = ("market_segment", "list_name", "region", "x_price", "x_bal", "x_qty", "x_lines", "x_disc", "x_const", "x_sparse")
NUMERIC = ("x_price", "x_bal", "x_qty", "x_lines", "x_disc", "lead_ags", "ref_score")
CATEGORICAL = ("market_segment", "list_name", "region", "class_type", "ppp")


def _each(template: str, cols) -> str:
    return " UNION ALL ".join(template.format(c=c) for c in cols)


# Grouped measures ----------------------------------------------------------------------

@query(
    "group_measures",
    with_views("campaign", """SELECT market_segment, CAST(COUNT(*) AS BIGINT) AS cnt, CAST(SUM(fund_amt) AS BIGINT) AS fund_amt,
 MIN(ref_score) AS min_ref, MAX(ref_score) AS max_ref FROM campaign GROUP BY market_segment"""),
)
def group_measures(spark, sf_dir):
    return campaign(spark, sf_dir, "market_segment", "fund_amt", "ref_score").groupBy("market_segment").agg(
        F.count(F.lit(1)).alias("cnt"),
        F.sum("fund_amt").alias("fund_amt"),
        F.min("ref_score").alias("min_ref"),
        F.max("ref_score").alias("max_ref"),
    )


@query(
    "value_counts",
    with_views("campaign", """SELECT market_segment, CAST(COUNT(*) AS BIGINT) AS cnt, round(COUNT(*)::DOUBLE / SUM(COUNT(*)) OVER (), 6) AS share
 FROM campaign WHERE market_segment IS NOT NULL GROUP BY market_segment"""),
)
def value_counts(spark, sf_dir):
    return rounded(P.value_counts(campaign(spark, sf_dir, "market_segment"), "market_segment"))


_CROSS = """, x AS (SELECT market_segment, list_name, CAST(COUNT(*) AS BIGINT) AS cnt FROM campaign WHERE market_segment IS NOT NULL AND list_name IS NOT NULL GROUP BY ALL)"""


@query(
    "crosstab_counts",
    with_views("campaign", """SELECT market_segment,
 CAST(SUM(CASE WHEN flg_resp = 0 THEN 1 ELSE 0 END) AS BIGINT) AS "0", CAST(SUM(CASE WHEN flg_resp = 1 THEN 1 ELSE 0 END) AS BIGINT) AS "1"
 FROM campaign WHERE market_segment IS NOT NULL GROUP BY market_segment ORDER BY market_segment"""),
)
def crosstab_counts(spark, sf_dir):
    df = campaign(spark, sf_dir, "market_segment", "flg_resp")
    return S.crosstab_wide(df, "market_segment", "flg_resp", [0, 1]).orderBy("market_segment")


@query(
    "crosstab_row_pct",
    with_views("campaign", f"{_CROSS} SELECT market_segment, list_name, cnt, round(100 * cnt::DOUBLE / SUM(cnt) OVER (PARTITION BY market_segment), 6) AS row_pct FROM x"),
)
def crosstab_row_pct(spark, sf_dir):
    df = campaign(spark, sf_dir, "market_segment", "list_name")
    return rounded(S.crosstab(df, "market_segment", "list_name").drop("col_pct"))


@query(
    "crosstab_col_pct",
    with_views("campaign", f"{_CROSS} SELECT market_segment, list_name, cnt, round(100 * cnt::DOUBLE / SUM(cnt) OVER (PARTITION BY list_name), 6) AS col_pct FROM x"),
)
def crosstab_col_pct(spark, sf_dir):
    df = campaign(spark, sf_dir, "market_segment", "list_name")
    return rounded(S.crosstab(df, "market_segment", "list_name").drop("row_pct"))


# Profiles ------------------------------------------------------------------------------

@query(
    "null_profile",
    with_views("campaign", _each("SELECT '{c}' AS variable, round((COUNT(*) - COUNT({c}))::DOUBLE / COUNT(*), 6) AS null_share FROM campaign", PROFILED)),
)
def null_profile(spark, sf_dir):
    return rounded(P.null_profile(campaign(spark, sf_dir, *PROFILED)))


@query(
    "distinct_profile",
    with_views("campaign", _each("SELECT '{c}' AS variable, CAST(COUNT(DISTINCT {c}) AS BIGINT) AS distinct_values FROM campaign", PROFILED)),
)
def distinct_profile(spark, sf_dir):
    return P.distinct_profile(campaign(spark, sf_dir, *PROFILED))


_TYPES = {"market_segment": "string", "list_name": "string", "region": "string", "x_qty": "bigint", "x_lines": "bigint", "x_const": "int"}


@query(
    "variable_summary",
    with_views("campaign", " UNION ALL ".join(
        f"""SELECT '{c}' AS variable, '{_TYPES.get(c, 'double')}' AS data_type, CAST(COUNT(DISTINCT {c}) AS BIGINT) AS unique_values,
 round(100 * (COUNT(*) - COUNT({c}))::DOUBLE / COUNT(*), 6) AS null_pct, round(100 - 100 * (COUNT(*) - COUNT({c}))::DOUBLE / COUNT(*), 6) AS coverage_pct FROM campaign"""
        for c in PROFILED)),
)
def variable_summary(spark, sf_dir):
    return rounded(P.variable_summary(campaign(spark, sf_dir, *PROFILED)))


_NUMERIC_SQL = """SELECT '{c}' AS variable, CAST(COUNT({c}) AS BIGINT) AS n, CAST(COUNT(*) - COUNT({c}) AS BIGINT) AS missing,
 CAST(COUNT(DISTINCT {c}) AS BIGINT) AS distinct_values, round(AVG({c}::DOUBLE), 4) AS mean, round(stddev_samp({c}::DOUBLE), 4) AS std,
 round(MIN({c})::DOUBLE, 4) AS min, round(MAX({c})::DOUBLE, 4) AS max, CAST(SUM(CASE WHEN {c} = 0 THEN 1 ELSE 0 END) AS BIGINT) AS zeros,
 round(quantile_cont({c}::DOUBLE, 0.05), 4) AS q05, round(quantile_cont({c}::DOUBLE, 0.25), 4) AS q25, round(quantile_cont({c}::DOUBLE, 0.5), 4) AS q50,
 round(quantile_cont({c}::DOUBLE, 0.75), 4) AS q75, round(quantile_cont({c}::DOUBLE, 0.95), 4) AS q95 FROM campaign"""


@query("profile_numeric", with_views("campaign", _each(_NUMERIC_SQL, NUMERIC)))
def profile_numeric(spark, sf_dir):
    return rounded(P.profile_numeric(stored_campaign(spark, sf_dir, *NUMERIC), NUMERIC), 4)


@query(
    "profile_categorical",
    with_views("campaign", ", " + "l AS (" + _each("SELECT '{c}' AS variable, {c} AS value FROM campaign WHERE {c} IS NOT NULL", CATEGORICAL) + """),
 g0 AS (SELECT variable, value, CAST(COUNT(*) AS BIGINT) AS cnt FROM l GROUP BY ALL), g AS (SELECT *, SUM(cnt) OVER (PARTITION BY variable) AS n FROM g0)
 SELECT variable, CAST(ROW_NUMBER() OVER (PARTITION BY variable ORDER BY cnt DESC, value) AS INT) AS rank, value, cnt, round(cnt::DOUBLE / n, 6) AS share
 FROM g QUALIFY ROW_NUMBER() OVER (PARTITION BY variable ORDER BY cnt DESC, value) <= 3"""),
)
def profile_categorical(spark, sf_dir):
    return rounded(P.profile_categorical(campaign(spark, sf_dir, *CATEGORICAL), CATEGORICAL, top=3))


@query(
    "moments",
    with_views("campaign", _each("""SELECT '{c}' AS variable, CAST(COUNT({c}) AS BIGINT) AS n, round(AVG({c}::DOUBLE), 4) AS mean,
 round(stddev_samp({c}::DOUBLE), 4) AS std, round(skewness({c}::DOUBLE), 4) AS skew, round(MIN({c})::DOUBLE, 4) AS min, round(quantile_cont({c}::DOUBLE, 0.95), 4) AS q95 FROM campaign""", NUMERIC)),
)
def moments(spark, sf_dir):
    df = stored_campaign(spark, sf_dir, *NUMERIC)
    return rounded(P.with_quantiles(P.moments(df, NUMERIC), df, NUMERIC, {"q95": 0.95}), 4)


def _pairs(cols):
    return [(a, b) for i, a in enumerate(cols) for b in cols[i + 1 :]]


@query(
    "corr_matrix",
    with_views("campaign", " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round_even(corr({a}::DOUBLE, {b}::DOUBLE), 2) AS corr FROM campaign" for a, b in _pairs(NUMERIC))),
)
def corr_matrix(spark, sf_dir):
    return P.corr_matrix(campaign(spark, sf_dir, *NUMERIC), NUMERIC)


_RANKED = ("x_price", "x_bal", "x_qty", "x_lines")


@query(
    "spearman_matrix",
    with_views("campaign", ", r AS (SELECT " + ", ".join(
        f"RANK() OVER (ORDER BY {c}) + (COUNT(*) OVER (PARTITION BY {c}) - 1) / 2.0::DOUBLE AS {c}" for c in _RANKED)
        + " FROM campaign WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in _RANKED) + ") "
        + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS corr FROM r" for a, b in _pairs(_RANKED))),
)
def spearman_matrix(spark, sf_dir):
    df = stored_campaign(spark, sf_dir, "account_id", *_RANKED)
    return rounded(P.spearman_matrix(df, _RANKED, "account_id").select("a", "b", "corr"))


@query(
    "score_density",
    with_views("campaign", """, lim AS (SELECT MIN(score_resp) AS lo, MAX(score_resp) AS hi, (MAX(score_resp) - MIN(score_resp)) / 200 AS w FROM campaign),
 c AS (SELECT flg_resp, least(floor((score_resp - lo) / w), 199) AS cell, COUNT(*) AS cnt, any_value(lo) AS lo, any_value(hi) AS hi, any_value(w) AS w FROM campaign, lim GROUP BY flg_resp, cell),
 s AS (SELECT flg_resp, COUNT(*)::DOUBLE AS n, stddev_samp(score_resp) * pow(COUNT(*)::DOUBLE, -0.2) AS bw FROM campaign GROUP BY flg_resp)
 SELECT c.flg_resp, CAST(g AS INT) AS point_no, round(MIN(lo + (hi - lo) * g / 49), 6) AS x,
 round(SUM(cnt * exp(-pow(((lo + (hi - lo) * g / 49) - (lo + (cell + 0.5) * w)) / bw, 2) / 2) / (sqrt(2 * pi()) * bw) / n), 6) AS density
 FROM c JOIN s ON c.flg_resp = s.flg_resp, range(50) t(g) GROUP BY c.flg_resp, g"""),
)
def score_density(spark, sf_dir):
    return rounded(P.score_density(campaign(spark, sf_dir, "flg_resp", "score_resp"), "flg_resp", "score_resp"))


@query("scored_keys", with_views("campaign", "SELECT CAST(COUNT(DISTINCT duns) AS BIGINT) AS scored FROM campaign"))
def scored_keys(spark, sf_dir):
    return campaign(spark, sf_dir, "duns").agg(F.count_distinct("duns").alias("scored"))


# Screens -------------------------------------------------------------------------------

@query(
    "screen_missing",
    with_views("campaign", "SELECT * FROM (" + _each("SELECT '{c}' AS variable, round((COUNT(*) - COUNT({c}))::DOUBLE / COUNT(*), 6) AS null_share FROM campaign", PROFILED) + ") WHERE null_share > 0.1"),
)
def screen_missing(spark, sf_dir):
    return rounded(C.screen_missing(campaign(spark, sf_dir, *PROFILED), 0.1))


@query(
    "screen_single_unique",
    with_views("campaign", "SELECT variable FROM (" + _each("SELECT '{c}' AS variable, COUNT(DISTINCT {c}) AS d FROM campaign", PROFILED) + ") WHERE d = 1"),
)
def screen_single_unique(spark, sf_dir):
    return C.screen_single_unique(campaign(spark, sf_dir, *PROFILED))


_LINEAR = ("x_price", "x_bal", "x_qty", "x_copy", "x_const", "lead_ags")


@query(
    "screen_collinear",
    with_views("campaign", ", p AS (" + " UNION ALL ".join(
        f"SELECT '{b}' AS variable, corr({a}::DOUBLE, {b}::DOUBLE) AS r FROM campaign" for a, b in _pairs(_LINEAR) if "x_const" not in (a, b))
        + ") SELECT variable, round(MAX(abs(r)), 6) AS max_abs_corr FROM p WHERE abs(r) > 0.8 GROUP BY variable"),
)
def screen_collinear(spark, sf_dir):
    return rounded(C.screen_collinear(campaign(spark, sf_dir, *_LINEAR), _LINEAR, 0.8))


@query(
    "screen_vif",
    with_views("campaign", """, g AS (SELECT SUM(x * x) AS xx, SUM(y * y) AS yy, SUM(x * y) AS xy FROM
  (SELECT coalesce(x_price, 0)::DOUBLE AS x, coalesce(x_qty, 0)::DOUBLE AS y FROM campaign)),
 v AS (SELECT 1 / (1 - xy * xy / (xx * yy)) AS vif FROM g)
 SELECT 'x_price' AS variable, round(vif, 6) AS vif FROM v UNION ALL SELECT 'x_qty', round(vif, 6) FROM v"""),
)
def screen_vif(spark, sf_dir):
    return rounded(C.vif(campaign(spark, sf_dir, "x_price", "x_qty")))


@query("variable_clusters")
def variable_clusters(spark, sf_dir):
    cols = ("x_price", "x_bal", "x_qty", "x_lines", "x_copy", "lead_ags", "ref_score")
    return C.variable_clusters(stored_campaign(spark, sf_dir, "account_id", *cols), cols, "account_id")


_SCREENED = (*PROFILED, "flg_resp")


def _screen(spark, sf_dir):
    df = campaign(spark, sf_dir, "account_id", "mail_date", *_SCREENED)
    return df, C.feature_screen(df, 0.5, fixed=["flg_resp"], exclude=["account_id", "mail_date"])


@query(
    "feature_screen",
    with_views("campaign", "SELECT variable FROM (" + _each("SELECT '{c}' AS variable, 1 - COUNT({c})::DOUBLE / COUNT(*) AS m, COUNT(DISTINCT {c}) AS d FROM campaign", _SCREENED)
               + ") WHERE variable = 'flg_resp' OR (m <= 0.5 AND d <> 1)"),
)
def feature_screen(spark, sf_dir):
    _, result = _screen(spark, sf_dir)
    return spark.createDataFrame([(c,) for c in result.kept], "variable string")


@query(
    "screen_waterfall",
    with_views("campaign", ", s AS (" + _each("SELECT '{c}' AS variable, 1 - COUNT({c})::DOUBLE / COUNT(*) AS m, COUNT(DISTINCT {c}) AS d FROM campaign", _SCREENED)
               + """), f AS (SELECT variable, CASE WHEN variable = 'flg_resp' THEN 'kept' WHEN m > 0.5 THEN 'missing' WHEN d = 1 THEN 'single_unique' ELSE 'kept' END AS step FROM s)
 SELECT CAST(step_no AS INT) AS step_no, step, CAST(coalesce(fixed, (SELECT COUNT(*) FROM f WHERE f.step = t.step)) AS BIGINT) AS variables
 FROM (VALUES (0, 'start', 13), (1, 'excluded', 2), (2, 'missing', NULL), (3, 'single_unique', NULL), (4, 'kept', NULL)) t(step_no, step, fixed)"""),
)
def screen_waterfall(spark, sf_dir):
    return C.screen_waterfall(*_screen(spark, sf_dir))


# Significance --------------------------------------------------------------------------

_CHI2 = """, l AS (""" + _each("SELECT '{c}' AS variable, {c} AS value, flg_resp FROM campaign WHERE {c} IS NOT NULL", CATEGORICAL) + """),
 k AS (SELECT variable, value, COUNT(*)::DOUBLE AS n, SUM(flg_resp)::DOUBLE AS n1 FROM l GROUP BY ALL),
 t AS (SELECT k.*, SUM(n) OVER w AS big_n, SUM(n1) OVER w AS big_n1, COUNT(*) OVER w AS r FROM k WINDOW w AS (PARTITION BY variable)),
 x AS (SELECT variable, r, n, n1, n * big_n1 / big_n AS e1, n * (big_n - big_n1) / big_n AS e0, CASE WHEN r = 2 THEN 0.5 ELSE 0 END AS y FROM t),
 chi AS (SELECT variable, CAST(MAX(r) - 1 AS BIGINT) AS dof,
  SUM(pow(greatest(abs(n1 - e1) - y, 0), 2) / e1 + pow(greatest(abs(n - n1 - e0) - y, 0), 2) / e0) AS stat FROM x GROUP BY variable)"""


@query("chi2_screen", with_views("campaign", f"{_CHI2} SELECT variable, round(stat, 6) AS stat, dof FROM chi"))
def chi2_screen(spark, sf_dir):
    df = campaign(spark, sf_dir, "flg_resp", *CATEGORICAL)
    return rounded(T.chi2_screen(df, CATEGORICAL, "flg_resp").drop("p_value"))


_TTEST = ", tt AS (" + _each("""SELECT '{c}' AS variable, m0, m1, n0, n1, v0, v1 FROM (SELECT
 AVG(CASE WHEN flg_resp = 0 THEN {c} END::DOUBLE) AS m0, AVG(CASE WHEN flg_resp = 1 THEN {c} END::DOUBLE) AS m1,
 COUNT(CASE WHEN flg_resp = 0 THEN {c} END) AS n0, COUNT(CASE WHEN flg_resp = 1 THEN {c} END) AS n1,
 var_samp(CASE WHEN flg_resp = 0 THEN {c} END::DOUBLE) AS v0, var_samp(CASE WHEN flg_resp = 1 THEN {c} END::DOUBLE) AS v1 FROM campaign)""", NUMERIC) + """),
 ts AS (SELECT variable, (m0 - m1) / sqrt(((n0 - 1) * v0 + (n1 - 1) * v1) / (n0 + n1 - 2) * (1.0::DOUBLE / n0 + 1.0::DOUBLE / n1)) AS stat, CAST(n0 + n1 - 2 AS BIGINT) AS dof FROM tt)"""


@query("ttest_screen", with_views("campaign", f"{_TTEST} SELECT variable, round(stat, 6) AS stat, dof FROM ts"))
def ttest_screen(spark, sf_dir):
    df = campaign(spark, sf_dir, "flg_resp", *NUMERIC)
    return rounded(T.ttest_screen(df, NUMERIC, "flg_resp").drop("p_value"))


@query(
    "significant_share",
    # Critical values at 0.01: chi-square with 1, 3 and 4 degrees of freedom, and t with many.
    with_views("campaign", f"""{_CHI2} {_TTEST},
 s AS (SELECT stat > CASE dof WHEN 1 THEN 6.6349 WHEN 3 THEN 11.3449 WHEN 4 THEN 13.2767 END AS hit FROM chi UNION ALL SELECT abs(stat) > 2.5760 FROM ts)
 SELECT CAST(SUM(CASE WHEN hit THEN 1 ELSE 0 END) AS BIGINT) AS significant, CAST(COUNT(*) AS BIGINT) AS tested, round(SUM(CASE WHEN hit THEN 1 ELSE 0 END)::DOUBLE / COUNT(*), 6) AS share FROM s"""),
)
def significant_share(spark, sf_dir):
    df = campaign(spark, sf_dir, "flg_resp", *CATEGORICAL, *NUMERIC)
    tests = [T.chi2_screen(df, CATEGORICAL, "flg_resp"), T.ttest_screen(df, NUMERIC, "flg_resp")]
    return rounded(T.significant_share(tests))


@query(
    "bivariate_rates",
    with_views("campaign", f""", {sql_quantile_edges('campaign', 'x_price', 20)},
 l AS (SELECT 'market_segment' AS variable, flg_qual, flg_resp, market_segment AS value FROM campaign WHERE market_segment IS NOT NULL
  UNION ALL SELECT 'list_name', flg_qual, flg_resp, list_name FROM campaign
  UNION ALL SELECT 'x_price', flg_qual, flg_resp, 'q' || e.bin FROM (SELECT *, x_price AS v FROM campaign) x JOIN edges e ON {_IN_EDGE}),
 k AS (SELECT variable, flg_qual, value, COUNT(*)::DOUBLE AS n, SUM(flg_resp)::DOUBLE AS n1 FROM l GROUP BY ALL),
 t AS (SELECT k.*, SUM(n) OVER w AS big_n, SUM(n1) OVER w AS big_n1, COUNT(*) OVER w AS r FROM k WINDOW w AS (PARTITION BY variable, flg_qual)),
 x AS (SELECT *, n * big_n1 / big_n AS e1, n * (big_n - big_n1) / big_n AS e0, CASE WHEN r = 2 THEN 0.5 ELSE 0 END AS y FROM t),
 c AS (SELECT variable, flg_qual, CAST(MAX(r) - 1 AS BIGINT) AS dof, CASE WHEN MIN(least(e0, e1)) > 0 THEN
  SUM(pow(greatest(abs(n1 - e1) - y, 0), 2) / e1 + pow(greatest(abs(n - n1 - e0) - y, 0), 2) / e0) END AS stat FROM x GROUP BY ALL)
 SELECT x.variable, x.flg_qual, value, CAST(n AS BIGINT) AS cnt, CAST(n1 AS BIGINT) AS responders, round(100 * n1 / n, 6) AS rate,
 CAST(n - n1 AS BIGINT) AS non_responders, round(stat, 6) AS stat, dof FROM x JOIN c ON x.variable = c.variable AND x.flg_qual = c.flg_qual WHERE n >= 300"""),
)
def bivariate_rates(spark, sf_dir):
    df = campaign(spark, sf_dir, "flg_resp", "flg_qual", "market_segment", "list_name", "x_price")
    return rounded(T.bivariate_rates(df, "flg_resp", "flg_qual", ["market_segment", "list_name"], ["x_price"]))


@query(
    "log_suggestion",
    with_views("campaign", "SELECT variable FROM (" + _each("SELECT '{c}' AS variable, skewness({c}::DOUBLE) AS s, MIN({c}) AS m, COUNT(DISTINCT {c}) AS d FROM campaign", (*NUMERIC, "fund_amt", "flg_fund")) + ") WHERE s > 1 AND m >= 0 AND d <> 2"),
)
def log_suggestion(spark, sf_dir):
    cols = (*NUMERIC, "fund_amt", "flg_fund")
    found = C.log_suggestion(stored_campaign(spark, sf_dir, *cols), cols)
    return spark.createDataFrame([(c,) for c in found], "variable string")
