"""Ordering, binning, gains and summary queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from reachmark.operators import bins as B
from reachmark.operators import gains as G
from reachmark.operators import summary as S
from reachmark.operators.ordering import OrderIndex
from reachmark.plans.registry import query, rounded
from reachmark.plans.views import campaign, stored_campaign, with_views

KEY, LABEL, SCORE, WEIGHT = "account_id", "flg_resp", "score_resp", "wt"
FUNNEL = (
    "account_id", "score_resp", "flg_resp", "flg_qual", "flg_sub", "flg_appr", "flg_nfappr",
    "flg_fund", "flg_nffund", "fund_amt", "nffund_amt", "fund_margin", "lead_ags", "mail_cnt",
    "ref_score",
)


def scored(spark, sf_dir):
    return campaign(spark, sf_dir, KEY, LABEL, SCORE, WEIGHT)


# Reusable pieces of SQL ----------------------------------------------------------------

def sql_ks(source: str, score: str = "score_resp", mode: str = "probability", tag: str = "") -> str:
    """CTEs ending in ``ks{tag}``: the gains table of ``source``."""
    way = "ASC" if mode == "score" else "DESC"
    auc = "1 - auc" if mode == "score" else "auc"
    return f"""
o{tag} AS (SELECT account_id, {score} AS s, flg_resp AS y, wt,
     SUM(wt) OVER (ORDER BY {score} {way}, account_id ROWS UNBOUNDED PRECEDING) AS cw FROM {source}),
b{tag} AS (SELECT *, greatest(1, CAST(ceil(10.0::DOUBLE * (cw - mn)::DOUBLE / (mx - mn)::DOUBLE) AS INT)) AS b
     FROM o{tag}, (SELECT MIN(cw) AS mn, MAX(cw) AS mx FROM o{tag})),
a{tag} AS (SELECT b, MIN(s) AS min_scr, MAX(s) AS max_scr,
     CAST(SUM(CASE WHEN y = 1 THEN wt ELSE 0 END) AS BIGINT) AS bads,
     CAST(SUM(CASE WHEN y = 0 THEN wt ELSE 0 END) AS BIGINT) AS goods FROM b{tag} GROUP BY b),
v{tag} AS (SELECT s, SUM(CASE WHEN y = 1 THEN wt ELSE 0 END)::DOUBLE AS p, SUM(CASE WHEN y = 0 THEN wt ELSE 0 END)::DOUBLE AS n
     FROM o{tag} GROUP BY s),
auc{tag} AS (SELECT SUM(p * (nb + n / 2)) / (SUM(p) * SUM(n)) AS auc FROM (
     SELECT p, n, SUM(n) OVER (ORDER BY s ROWS UNBOUNDED PRECEDING) - n AS nb FROM v{tag})),
f{tag} AS (SELECT CAST(10 * (i - 1) + 5 AS INT) AS "Decile", a.min_scr, a.max_scr, coalesce(bads, 0) AS bads,
     coalesce(goods, 0) AS goods, coalesce(bads, 0) + coalesce(goods, 0) AS total
     FROM range(1, 11) t(i) LEFT JOIN a{tag} a ON a.b = t.i),
c{tag} AS (SELECT f.*, 100 * bads::DOUBLE / total AS rate,
     SUM(bads) OVER w * 100.0::DOUBLE / SUM(bads) OVER () AS cumm_bad,
     SUM(goods) OVER w * 100.0::DOUBLE / SUM(goods) OVER () AS cumm_good,
     SUM(total) OVER w * 100.0::DOUBLE / SUM(total) OVER () AS cum_total,
     0.5::DOUBLE - SUM(bads) OVER ()::DOUBLE / SUM(total) OVER () / 2 AS areab
     FROM f{tag} f WINDOW w AS (ORDER BY "Decile" ROWS UNBOUNDED PRECEDING)),
l{tag} AS (SELECT c.*, round_even(abs(cumm_bad - cumm_good), 4) AS "KS",
     LAG(cumm_bad, 1, 0.0::DOUBLE) OVER (ORDER BY "Decile") AS lcum_bad,
     LAG(cum_total, 1, 0.0::DOUBLE) OVER (ORDER BY "Decile") AS lcum_total FROM c{tag} c),
m{tag} AS (SELECT l.*, 0.5::DOUBLE * ((cumm_bad - cum_total) + (lcum_bad - lcum_total)) * (cum_total - lcum_total) AS area FROM l{tag} l),
ks{tag} AS (SELECT "Decile", min_scr, max_scr, bads, goods, total,
     CASE WHEN rate IS NULL THEN NULL ELSE printf('%.2f%%', rate) END AS bad_rate, cumm_bad, cumm_good, "KS",
     CASE WHEN "KS" = MAX("KS") OVER () THEN '<----' ELSE '' END AS max_ks,
     abs(2 * ({auc}) - 1) AS gini, {auc} AS auc, lcum_bad, cum_total, lcum_total, area,
     SUM(area) OVER (ORDER BY "Decile" ROWS UNBOUNDED PRECEDING) AS cum_area, areab,
     SUM(area) OVER (ORDER BY "Decile" ROWS UNBOUNDED PRECEDING) / areab AS "PI",
     SUM(area) OVER (ORDER BY "Decile" ROWS UNBOUNDED PRECEDING) / areab / 10000 AS pi_index, rate
     FROM m{tag}, auc{tag})"""


_ROUND_KS = """SELECT "Decile", {scr}, bads, goods, total, bad_rate,
 round(cumm_bad, 6) AS cumm_bad, round(cumm_good, 6) AS cumm_good, round("KS", 6) AS "KS", max_ks,
 round(gini, 6) AS gini, round(auc, 6) AS auc, round(lcum_bad, 6) AS lcum_bad, round(cum_total, 6) AS cum_total,
 round(lcum_total, 6) AS lcum_total, round(area, 6) AS area, round(cum_area, 6) AS cum_area, round(areab, 6) AS areab,
 round("PI", 6) AS "PI", round(pi_index, 6) AS pi_index FROM ks"""
_SCR = "round(min_scr, 6) AS min_scr, round(max_scr, 6) AS max_scr"


# Ordering ------------------------------------------------------------------------------

@query(
    "cum_weight",
    with_views("campaign", """SELECT account_id,
 CAST(ROW_NUMBER() OVER (ORDER BY score_resp DESC, account_id) AS BIGINT) AS row_no,
 CAST(SUM(wt) OVER (ORDER BY score_resp DESC, account_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS wt_cumsum
 FROM campaign"""),
)
def cum_weight(spark, sf_dir):
    df = campaign(spark, sf_dir, KEY, SCORE, WEIGHT)
    index = OrderIndex.fit(df, [(SCORE, False)], KEY, weight=WEIGHT)
    return index.positions(df, rank="row_no", running="wt_cumsum").select(KEY, "row_no", "wt_cumsum")


@query(
    "top_fraction",
    with_views("campaign", """, r AS (SELECT account_id, score_resp,
 ROW_NUMBER() OVER (ORDER BY score_resp DESC, account_id) AS rn, COUNT(*) OVER () AS n FROM campaign)
 SELECT account_id, score_resp FROM r WHERE rn <= CAST(floor(n * 0.2::DOUBLE) AS BIGINT)"""),
)
def top_fraction(spark, sf_dir):
    return G.top_fraction(campaign(spark, sf_dir, KEY, SCORE), SCORE, KEY, 0.2)


@query(
    "sorted_output",
    with_views("campaign", """SELECT region, CAST(COUNT(*) AS BIGINT) AS cnt, MAX(ref_score) AS best
 FROM campaign GROUP BY region ORDER BY cnt DESC, region"""),
)
def sorted_output(spark, sf_dir):
    df = campaign(spark, sf_dir, "region", "ref_score")
    out = df.groupBy("region").agg(F.count(F.lit(1)).alias("cnt"), F.max("ref_score").alias("best"))
    return out.orderBy(F.desc("cnt"), "region")


# Bins ----------------------------------------------------------------------------------

_EDGES = ", ".join(f"({i + 1}, {lo!r}::DOUBLE, {hi!r}::DOUBLE)" for i, (lo, hi) in enumerate(zip(B.SCORE_EDGES, B.SCORE_EDGES[1:])))


@query(
    "score_bins",
    with_views("campaign", f""", e(score_bin, lo, hi) AS (VALUES {_EDGES})
 SELECT e.score_bin, CAST(COUNT(*) AS BIGINT) AS cnt, CAST(SUM(flg_resp) AS BIGINT) AS resp,
 round(MIN(score_resp), 6) AS min_score, round(MAX(score_resp), 6) AS max_score
 FROM campaign LEFT JOIN e ON score_resp >= lo AND score_resp < hi GROUP BY e.score_bin"""),
)
def score_bins(spark, sf_dir):
    df = B.with_score_bin(campaign(spark, sf_dir, LABEL, SCORE), SCORE)
    return rounded(
        df.groupBy("score_bin").agg(
            F.count(F.lit(1)).alias("cnt"),
            F.sum(LABEL).alias("resp"),
            F.min(SCORE).alias("min_score"),
            F.max(SCORE).alias("max_score"),
        )
    )


@query(
    "rank_deciles",
    with_views("campaign", """, r AS (SELECT account_id, ROW_NUMBER() OVER (ORDER BY score_resp, account_id) AS rn,
 COUNT(*) OVER () AS n FROM campaign)
 SELECT account_id, CAST(11 - greatest(1, ceil(10.0::DOUBLE * (rn - 1) / (n - 1))) AS INT) AS decile FROM r"""),
)
def rank_deciles(spark, sf_dir):
    df = campaign(spark, sf_dir, KEY, SCORE)
    return B.with_rank_decile(df, SCORE, KEY).select(KEY, "decile")


def sql_quantile_edges(source: str, column: str, n: int, name: str = "edges") -> str:
    """CTEs: the distinct quantile edges of a column as numbered half-open intervals."""
    probs = ", ".join(f"{i / n!r}" for i in range(n + 1))
    return f"""
q_{name} AS (SELECT DISTINCT unnest(quantile_cont({column}::DOUBLE, [{probs}])) AS e FROM {source}),
{name} AS (SELECT CAST(ROW_NUMBER() OVER (ORDER BY lo) AS INT) AS bin, lo, hi, lo = MIN(lo) OVER () AS lowest
 FROM (SELECT e AS lo, LEAD(e) OVER (ORDER BY e) AS hi FROM q_{name}) WHERE hi IS NOT NULL)"""


_IN_EDGE = "(x.v > e.lo OR (e.lowest AND x.v = e.lo)) AND x.v <= e.hi"


@query(
    "quantile_deciles",
    with_views("campaign", f""", {sql_quantile_edges('campaign', 'score_resp', 10)}
 SELECT e.bin, CAST(COUNT(*) AS BIGINT) AS cnt, CAST(SUM(flg_resp) AS BIGINT) AS resp,
 round(MIN(v), 6) AS min_score, round(MAX(v), 6) AS max_score
 FROM (SELECT score_resp AS v, flg_resp FROM campaign) x LEFT JOIN edges e ON {_IN_EDGE} GROUP BY e.bin"""),
)
def quantile_deciles(spark, sf_dir):
    df = campaign(spark, sf_dir, LABEL, SCORE)
    binned = B.QuantileBins.fit(df, SCORE, 10).transform(df, "bin")
    return rounded(
        binned.groupBy("bin").agg(
            F.count(F.lit(1)).alias("cnt"),
            F.sum(LABEL).alias("resp"),
            F.min(SCORE).alias("min_score"),
            F.max(SCORE).alias("max_score"),
        )
    )


@query(
    "quantile_deciles_dense",
    with_views("campaign", f""", {sql_quantile_edges('campaign', 'score_resp', 10)},
 r AS (SELECT account_id, e.bin FROM (SELECT account_id, score_resp AS v FROM campaign) x LEFT JOIN edges e ON {_IN_EDGE})
 SELECT account_id, CAST(CASE WHEN bin IS NOT NULL THEN DENSE_RANK() OVER (ORDER BY bin DESC NULLS LAST) END AS INT) AS decile FROM r"""),
)
def quantile_deciles_dense(spark, sf_dir):
    df = campaign(spark, sf_dir, KEY, SCORE)
    return B.with_quantile_decile(df, SCORE).select(KEY, "decile")


@query(
    "quantile_bins20",
    with_views("campaign", f""", {sql_quantile_edges('campaign', 'x_qty', 20)}
 SELECT e.bin, CAST(COUNT(*) AS BIGINT) AS cnt, round(e.lo, 6) AS lo, round(e.hi, 6) AS hi
 FROM (SELECT x_qty::DOUBLE AS v FROM campaign) x LEFT JOIN edges e ON {_IN_EDGE} GROUP BY e.bin, e.lo, e.hi"""),
)
def quantile_bins20(spark, sf_dir):
    df = stored_campaign(spark, sf_dir, "x_qty")
    bins = B.QuantileBins.fit(df, "x_qty", 20)
    counts = bins.transform(df, "bin").groupBy("bin").agg(F.count(F.lit(1)).alias("cnt"))
    edges = F.array(*[F.lit(e) for e in bins.edges])
    return rounded(
        counts.select(
            "bin", "cnt", F.get(edges, F.col("bin") - 1).alias("lo"), F.get(edges, F.col("bin")).alias("hi")
        )
    )


# Gains and KS --------------------------------------------------------------------------

@query("ks_table", with_views("campaign", f", {sql_ks('campaign')} {_ROUND_KS.format(scr=_SCR)}"))
def ks_table(spark, sf_dir):
    return rounded(G.ks_table(scored(spark, sf_dir), LABEL, SCORE, WEIGHT, KEY))


@query(
    "ks_table_score_mode",
    with_views("campaign", f", {sql_ks('campaign', 'ref_score', 'score')} {_ROUND_KS.format(scr='min_scr, max_scr')}"),
)
def ks_table_score_mode(spark, sf_dir):
    df = campaign(spark, sf_dir, KEY, LABEL, "ref_score", WEIGHT)
    return rounded(G.ks_table(df, LABEL, "ref_score", WEIGHT, KEY, mode="score"))


def _sql_headline(tag: str) -> str:
    return f"""h{tag} AS (SELECT MAX(auc) AS "ROC_AUC", MAX(gini) AS "Gini", MAX("KS") AS "KS",
 MAX(CASE WHEN "Decile" = 5 THEN cumm_bad END) AS "10%", MAX(CASE WHEN "Decile" = 15 THEN cumm_bad END) AS "20%",
 MAX(CASE WHEN "Decile" = 5 THEN max_scr END) AS max_prob, MAX(CASE WHEN "Decile" = 95 THEN min_scr END) AS min_prob FROM ks{tag}),
u{tag} AS (UNPIVOT h{tag} ON COLUMNS(*) INTO NAME metric VALUE v)"""


_DEV_OOT = f""", dev AS (SELECT * FROM campaign WHERE load_year <= 1999), oot AS (SELECT * FROM campaign WHERE load_year > 1999),
 {sql_ks('dev', tag='_d')}, {sql_ks('oot', tag='_o')}, {_sql_headline('_d')}, {_sql_headline('_o')}"""


def dev_oot(spark, sf_dir):
    df = campaign(spark, sf_dir, KEY, LABEL, SCORE, WEIGHT, "load_year")
    return df.filter("load_year <= 1999"), df.filter("load_year > 1999")


@query(
    "ks_dev_vs_test",
    with_views("campaign", f"""{_DEV_OOT}
 SELECT d.metric, round(d.v, 6) AS "Dev", round(o.v, 6) AS "OOT" FROM u_d d JOIN u_o o ON d.metric = o.metric"""),
)
def ks_dev_vs_test(spark, sf_dir):
    dev, oot = dev_oot(spark, sf_dir)
    return rounded(G.ks_dev_vs_test(dev, oot, LABEL, SCORE, WEIGHT, KEY))


@query(
    "ks_stability",
    with_views("campaign", f"""{_DEV_OOT},
 up AS (SELECT round_even(rate, 2) > LAG(round_even(rate, 2)) OVER (ORDER BY "Decile") AS up FROM ks_d
   UNION ALL SELECT round_even(rate, 2) > LAG(round_even(rate, 2)) OVER (ORDER BY "Decile") FROM ks_o)
 SELECT d.metric, round(d.v, 6) AS "Dev", round(o.v, 6) AS "OOT", round(d.v - o.v, 6) AS "Diff",
 (SELECT coalesce(MAX(CAST(up AS INT)), 0) = 0 FROM up) AS "Bad_Rate" FROM u_d d JOIN u_o o ON d.metric = o.metric"""),
)
def ks_stability(spark, sf_dir):
    dev, oot = dev_oot(spark, sf_dir)
    return rounded(G.ks_stability(dev, oot, LABEL, SCORE, WEIGHT, KEY))


def _sql_comparison(tag: str, name: str, mode: str) -> str:
    return f"""SELECT '{name}' AS score, {mode} AS mode, round(MAX("KS"), 6) AS "KS", round(MAX(auc), 6) AS auc,
 round(MAX(CASE WHEN "Decile" = 95 THEN "PI" END), 6) AS "PI", round(MAX(CASE WHEN "Decile" = 5 THEN cumm_bad END), 6) AS perc10,
 round(MAX(CASE WHEN "Decile" = 15 THEN cumm_bad END), 6) AS perc20 FROM ks{tag}"""


@query(
    "score_comparison",
    with_views("campaign", f""", {sql_ks('campaign', tag='_a')}, {sql_ks('campaign', 'ref_score', 'score', tag='_b')}
 {_sql_comparison('_a', 'score_resp', 'CAST(NULL AS VARCHAR)')} UNION ALL {_sql_comparison('_b', 'ref_score', "'score'")}"""),
)
def score_comparison(spark, sf_dir):
    df = campaign(spark, sf_dir, KEY, LABEL, SCORE, "ref_score", WEIGHT)
    scores = {SCORE: None, "ref_score": "score"}
    return rounded(G.score_comparison(df, LABEL, WEIGHT, KEY, scores))


@query(
    "auc_gini",
    with_views("campaign", f""", {sql_ks('campaign')} SELECT round(auc, 6) AS auc, round(2 * auc - 1, 6) AS gini FROM auc"""),
)
def auc_gini(spark, sf_dir):
    return rounded(G.auc_gini(scored(spark, sf_dir), LABEL, SCORE, WEIGHT))


_POINTS = """, g AS (SELECT score_resp AS s, SUM(flg_resp) AS p, SUM(1 - flg_resp) AS n FROM campaign GROUP BY score_resp),
 r AS (SELECT s, p, n, SUM(p) OVER (ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS tp, SUM(n) OVER (ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS fp,
   SUM(p) OVER () AS np, SUM(n) OVER () AS nn FROM g)"""


@query(
    "roc_curve",
    with_views("campaign", f"""{_POINTS} SELECT round(s, 6) AS threshold, round(fp::DOUBLE / nn, 6) AS fpr, round(tp::DOUBLE / np, 6) AS tpr FROM r
 UNION ALL SELECT NULL, 0.0::DOUBLE, 0.0::DOUBLE"""),
)
def roc_curve(spark, sf_dir):
    return rounded(G.roc_curve(campaign(spark, sf_dir, LABEL, SCORE), LABEL, SCORE))


@query(
    "roc_best_threshold",
    with_views("campaign", f"""{_POINTS}, g2 AS (SELECT sqrt(tp::DOUBLE / np * (1 - fp::DOUBLE / nn)) AS gmean, s, fp::DOUBLE / nn AS fpr, tp::DOUBLE / np AS tpr FROM r)
 SELECT round(gmean, 6) AS gmean, round(s, 6) AS threshold, round(fpr, 6) AS fpr, round(tpr, 6) AS tpr FROM g2 ORDER BY g2.gmean DESC, s DESC LIMIT 1"""),
)
def roc_best_threshold(spark, sf_dir):
    curve = G.roc_curve(campaign(spark, sf_dir, LABEL, SCORE), LABEL, SCORE)
    return rounded(G.best_threshold(curve))


@query(
    "pr_curve",
    with_views("campaign", f"""{_POINTS} SELECT round(s, 6) AS threshold, round(tp::DOUBLE / (tp + fp), 6) AS "precision", round(tp::DOUBLE / np, 6) AS recall FROM r
 UNION ALL SELECT NULL, 1.0::DOUBLE, 0.0::DOUBLE"""),
)
def pr_curve(spark, sf_dir):
    return rounded(G.pr_curve(campaign(spark, sf_dir, LABEL, SCORE), LABEL, SCORE))


@query(
    "pr_auc",
    with_views("campaign", f"""{_POINTS}, c AS (SELECT s, tp::DOUBLE / (tp + fp) AS pr, tp::DOUBLE / np AS re, np::DOUBLE / (np + nn) AS ns FROM r),
 d AS (SELECT pr, re, LAG(pr, 1, 1.0::DOUBLE) OVER (ORDER BY s DESC) AS pp, LAG(re, 1, 0.0::DOUBLE) OVER (ORDER BY s DESC) AS pre, ns FROM c)
 SELECT round(SUM((re - pre) * (pr + pp) / 2), 6) AS pr_auc, round(MAX(ns), 6) AS no_skill FROM d"""),
)
def pr_auc(spark, sf_dir):
    return rounded(G.pr_auc(campaign(spark, sf_dir, LABEL, SCORE), LABEL, SCORE))


_CONFUSION = """, k AS (SELECT CAST(SUM(CASE WHEN score_resp >= 0.5 AND flg_resp = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
 CAST(SUM(CASE WHEN score_resp >= 0.5 AND flg_resp = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
 CAST(SUM(CASE WHEN score_resp < 0.5 AND flg_resp = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fn,
 CAST(SUM(CASE WHEN score_resp < 0.5 AND flg_resp = 0 THEN 1 ELSE 0 END) AS BIGINT) AS tn FROM campaign),
 cm AS (SELECT k.*, round((tp + tn)::DOUBLE / (tp + tn + fp + fn), 6) AS accuracy, round(tp::DOUBLE / (tp + fp), 6) AS "precision",
 round(tp::DOUBLE / (tp + fn), 6) AS recall, round(2 * tp::DOUBLE / (2 * tp + fp + fn), 6) AS f1 FROM k)"""


@query("classification_metrics", with_views("campaign", f"{_CONFUSION} SELECT * FROM cm"))
def classification_metrics(spark, sf_dir):
    return rounded(G.classification_metrics(campaign(spark, sf_dir, LABEL, SCORE), LABEL, SCORE))


_CAPTURE = """, cr AS (SELECT flg_resp, ROW_NUMBER() OVER (ORDER BY score_resp DESC, account_id) AS rn, COUNT(*) OVER () AS n FROM campaign),
 cap AS (SELECT share, CAST(floor(MAX(n) * share) AS BIGINT) AS "rows", CAST(SUM(CASE WHEN rn <= floor(n * share) THEN flg_resp ELSE 0 END) AS BIGINT) AS captured,
 round(SUM(CASE WHEN rn <= floor(n * share) THEN flg_resp ELSE 0 END)::DOUBLE / SUM(flg_resp), 6) AS capture_rate
 FROM cr, (VALUES (0.1::DOUBLE), (0.2::DOUBLE)) s(share) GROUP BY share)"""


@query("capture_rates", with_views("campaign", f"{_CAPTURE} SELECT * FROM cap"))
def capture_rates(spark, sf_dir):
    return rounded(G.capture_rates(campaign(spark, sf_dir, KEY, LABEL, SCORE), LABEL, SCORE, KEY))


def _sql_gains(tag: str, name: str) -> str:
    return f"""SELECT '{name}' AS score, ("Decile" + 5)::DOUBLE AS random_guess, round(cumm_bad, 6) AS gain, round(cumm_bad / ("Decile" + 5), 6) AS lift FROM ks{tag}
 UNION ALL SELECT '{name}', 0.0::DOUBLE, 0.0::DOUBLE, NULL"""


@query(
    "gains_lift",
    with_views("campaign", f""", {sql_ks('campaign', tag='_a')}, {sql_ks('campaign', 'ref_score', 'score', tag='_b')}
 {_sql_gains('_a', 'score_resp')} UNION ALL {_sql_gains('_b', 'ref_score')}"""),
)
def gains_lift(spark, sf_dir):
    df = campaign(spark, sf_dir, KEY, LABEL, SCORE, "ref_score", WEIGHT)
    return rounded(
        G.gains_lift(
            {
                SCORE: G.ks_table(df, LABEL, SCORE, WEIGHT, KEY),
                "ref_score": G.ks_table(df, LABEL, "ref_score", WEIGHT, KEY, mode="score"),
            }
        )
    )


@query(
    "decile_report",
    with_views("campaign", f""", {sql_ks('campaign')} SELECT CAST(("Decile" + 5) / 10 AS INT) AS "Score", {_SCR}, total, bads AS "Targets", goods AS "NonTargets",
 bad_rate AS "TargetRate", printf('%.2f%%', cumm_bad) AS "CumTargetCapRate", printf('%.2f%%', cumm_good) AS "CumNonTargetCapRate",
 printf('%.2f', "KS") AS "KS", max_ks FROM ks"""),
)
def decile_report(spark, sf_dir):
    return rounded(G.decile_report(G.ks_table(scored(spark, sf_dir), LABEL, SCORE, WEIGHT, KEY)))


# Summaries -----------------------------------------------------------------------------

def sql_funnel(source: str, var: str, ascending: bool) -> str:
    """CTEs ending in ``fs``: the full funnel summary of ``source`` by ``var``."""
    way = "ASC" if ascending else "DESC"
    sums = ", ".join(
        f"CAST(SUM({c}) AS BIGINT) AS {c}"
        for c in ("flg_resp flg_qual flg_sub flg_appr flg_nfappr flg_fund flg_nffund fund_amt nffund_amt fund_margin mail_cnt").split()
    )
    rates = ", ".join(
        f"round_even(100 * flg_{c}::DOUBLE / cnt, 2) AS {c}_rate" for c in "resp qual sub appr fund".split()
    )
    return f"""
fg AS (SELECT {var}, CAST(COUNT(flg_resp) AS BIGINT) AS cnt, {sums},
 CAST(SUM(CASE WHEN fund_amt >= 25000 THEN 1 ELSE 0 END) AS BIGINT) AS large_fund,
 CAST(SUM(CASE WHEN lead_ags >= 250000 THEN 1 ELSE 0 END) AS BIGINT) AS large_ags,
 MIN(ref_score) AS ref_score_min, MAX(ref_score) AS ref_score_max,
 round(MIN(score_resp), 6) AS score_min, round(MAX(score_resp), 6) AS score_max FROM {source} GROUP BY {var}),
fs AS (SELECT fg.*, CAST(SUM(cnt) OVER w AS BIGINT) AS cumu_cnt, CAST(SUM(flg_resp) OVER w AS BIGINT) AS cumu_resp,
 CAST(SUM(fund_amt) OVER w AS BIGINT) AS cumu_fund_amt,
 round(SUM(flg_resp) OVER w::DOUBLE / SUM(flg_resp) OVER (), 6) AS cumu_resp_pcnt, {rates},
 round_even(fund_amt::DOUBLE / nullif(flg_fund, 0), 0) AS avg_funded,
 round(SUM(fund_amt) OVER w::DOUBLE / SUM(fund_amt) OVER (), 6) AS cumu_fund_amt_pcnt
 FROM fg WINDOW w AS (ORDER BY {var} {way} NULLS LAST ROWS UNBOUNDED PRECEDING))"""


_RANKED = """, ranked AS (SELECT c.*, CAST(11 - greatest(1, ceil(10.0::DOUBLE * (rn - 1) / (n - 1))) AS INT) AS decile FROM
 (SELECT *, ROW_NUMBER() OVER (ORDER BY score_resp, account_id) AS rn, COUNT(*) OVER () AS n FROM campaign) c)"""
_BINNED = f""", e(score_bin, lo, hi) AS (VALUES {_EDGES}),
 binned AS (SELECT campaign.*, e.score_bin FROM campaign LEFT JOIN e ON score_resp >= lo AND score_resp < hi)"""
_QDECILE = f""", {sql_quantile_edges('campaign', 'score_resp', 10)},
 qdec AS (SELECT x.*, CAST(CASE WHEN e.bin IS NOT NULL THEN DENSE_RANK() OVER (ORDER BY e.bin DESC NULLS LAST) END AS INT) AS decile
  FROM (SELECT *, score_resp AS v FROM campaign) x LEFT JOIN edges e ON {_IN_EDGE})"""


@query("funnel_summary_decile", with_views("campaign", f"{_RANKED}, {sql_funnel('ranked', 'decile', True)} SELECT * FROM fs"))
def funnel_summary_decile(spark, sf_dir):
    return rounded(S.funnel_by_rank_decile(campaign(spark, sf_dir, *FUNNEL), SCORE, KEY, LABEL))


@query("funnel_summary_scorebin", with_views("campaign", f"{_BINNED}, {sql_funnel('binned', 'score_bin', False)} SELECT * FROM fs"))
def funnel_summary_scorebin(spark, sf_dir):
    df = B.with_score_bin(campaign(spark, sf_dir, *FUNNEL), SCORE)
    return rounded(S.funnel_summary(df, "score_bin", LABEL, ascending=False))


@query(
    "funnel_summary_reduced",
    with_views("campaign", f""", {sql_funnel('campaign', 'market_segment', True)}
 SELECT market_segment, cnt, resp_rate, sub_rate, appr_rate, fund_rate, cumu_cnt, cumu_fund_amt_pcnt FROM fs"""),
)
def funnel_summary_reduced(spark, sf_dir):
    df = campaign(spark, sf_dir, *FUNNEL, "market_segment")
    return rounded(S.funnel_summary(df, "market_segment", LABEL, full=False))


@query("decile_summary", with_views("campaign", f"""{_QDECILE}, {sql_funnel('qdec', 'decile', True)}
 SELECT decile, cnt, flg_resp, cumu_cnt, cumu_resp, cumu_resp_pcnt, cumu_fund_amt, cumu_fund_amt_pcnt FROM fs"""))
def decile_summary(spark, sf_dir):
    df = campaign(spark, sf_dir, *FUNNEL)
    out = S.evaluation_report(df, LABEL, SCORE, KEY)["deciles"]
    return rounded(
        out.select(
            "decile", "cnt", "flg_resp", "cumu_cnt", "cumu_resp", "cumu_resp_pcnt", "cumu_fund_amt", "cumu_fund_amt_pcnt"
        )
    )


@query(
    "response_summary",
    with_views("campaign", f"""{_BINNED}, g AS (SELECT score_bin, CAST(COUNT(flg_resp) AS BIGINT) AS cnt, CAST(SUM(flg_resp) AS BIGINT) AS flg_resp,
 MIN(score_resp) AS mn, MAX(score_resp) AS mx FROM binned GROUP BY score_bin)
 SELECT score_bin, cnt, flg_resp, round(mn, 6) AS min_score, round(mx, 6) AS max_score, CAST(SUM(cnt) OVER w AS BIGINT) AS cumu_cnt, CAST(SUM(flg_resp) OVER w AS BIGINT) AS cumu_resp,
 round(SUM(flg_resp) OVER w::DOUBLE / SUM(flg_resp) OVER (), 6) AS cumu_resp_pcnt, round_even(100 * flg_resp::DOUBLE / cnt, 2) AS resp_rate,
 round(flg_resp::DOUBLE / nullif(cnt - flg_resp, 0), 6) AS good_bad_ratio_resp
 FROM g WINDOW w AS (ORDER BY score_bin DESC NULLS LAST ROWS UNBOUNDED PRECEDING)"""),
)
def response_summary(spark, sf_dir):
    df = B.with_score_bin(campaign(spark, sf_dir, LABEL, SCORE), SCORE)
    return rounded(S.response_summary(df, "score_bin", SCORE, ascending=False))


_METRICS = f""", {sql_ks('(SELECT account_id, score_resp, flg_resp, 1 AS wt FROM campaign)')} {_CONFUSION} {_CAPTURE},
 metrics AS (SELECT 'roc_auc' AS metric, round(auc, 6) AS value FROM auc
 UNION ALL SELECT 'accuracy', accuracy FROM cm UNION ALL SELECT 'precision', "precision" FROM cm
 UNION ALL SELECT 'recall', recall FROM cm UNION ALL SELECT 'f1', f1 FROM cm
 UNION ALL SELECT printf('capture_rate_%d%%', CAST(share * 100 AS INT)), capture_rate FROM cap)"""


def _long(report):
    """Metrics and summaries of a report as (section, item, measure, value) rows."""
    metrics = report["metrics"].select(
        F.lit("metrics").alias("section"), F.lit(None).cast("int").alias("item"), "metric", "value"
    )
    out = metrics
    for section, item in (("score_bins", "score_bin"), ("deciles", "decile")):
        part = report[section].select(
            item, *[F.col(c).cast("double").alias(c) for c in ("cnt", "flg_resp", "resp_rate", "cumu_resp_pcnt", "avg_funded")]
        ).unpivot([item], ["cnt", "flg_resp", "resp_rate", "cumu_resp_pcnt", "avg_funded"], "metric", "value")
        out = out.unionByName(
            part.select(F.lit(section).alias("section"), F.col(item).cast("int").alias("item"), "metric", "value")
        )
    return rounded(out)


def _sql_long(section: str, item: str, source: str) -> str:
    parts = [
        f"SELECT '{section}' AS section, {item} AS item, '{m}' AS metric, {m}::DOUBLE AS value FROM {source}"
        for m in ("cnt", "flg_resp", "resp_rate", "cumu_resp_pcnt", "avg_funded")
    ]
    return " UNION ALL ".join(parts)


def _sql_report(decile_cte: str, decile_source: str) -> str:
    bins = sql_funnel("binned", "score_bin", False).replace("fg AS", "fg1 AS").replace("FROM fg", "FROM fg1").replace("fg.*", "fg1.*").replace("fs AS", "fs1 AS")
    deciles = sql_funnel(decile_source, "decile", True)
    edges = _BINNED.replace("e(score_bin", "eb(score_bin").replace("e.score_bin", "eb.score_bin").replace("JOIN e ON", "JOIN eb ON")
    return with_views("campaign", f"""{_METRICS} {edges} {decile_cte}, {bins}, {deciles}
 SELECT 'metrics' AS section, CAST(NULL AS INT) AS item, metric, value FROM metrics
 UNION ALL {_sql_long('score_bins', 'score_bin', 'fs1')} UNION ALL {_sql_long('deciles', 'decile', 'fs')}""")


@query("evaluation_report", _sql_report(_QDECILE, "qdec"))
def evaluation_report(spark, sf_dir):
    return _long(S.evaluation_report(stored_campaign(spark, sf_dir, *FUNNEL), LABEL, SCORE, KEY))


@query("performance_report", _sql_report(_RANKED, "ranked"))
def performance_report(spark, sf_dir):
    return _long(S.performance_report(stored_campaign(spark, sf_dir, *FUNNEL), LABEL, SCORE, KEY))
