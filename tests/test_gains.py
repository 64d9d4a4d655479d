import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from reachmark.operators import bins as B
from reachmark.operators import gains as G
from reachmark.operators import summary as S


def scored(spark, rows, partitions=4):
    return spark.createDataFrame(rows, "k long, y int, s double, w long").repartition(partitions)


def sample(n=300):
    rng = np.random.default_rng(3)
    s = np.round(rng.random(n), 2)
    y = (rng.random(n) < s).astype(int)
    return [(i, int(y[i]), float(s[i]), int(1 + i % 3)) for i in range(n)]


def pair_auc(rows):
    wins = total = 0.0
    for _, y1, s1, w1 in rows:
        for _, y0, s0, w0 in rows:
            if y1 == 1 and y0 == 0:
                total += w1 * w0
                wins += w1 * w0 * (1.0 if s1 > s0 else 0.5 if s1 == s0 else 0.0)
    return wins / total


def test_auc_counts_pairs(spark):
    rows = sample(120)
    got = G.auc_gini(scored(spark, rows), "y", "s", "w").first()
    assert got["auc"] == pytest.approx(pair_auc(rows))
    assert got["gini"] == pytest.approx(2 * pair_auc(rows) - 1)
    flipped = G.auc_gini(scored(spark, rows), "y", "s", "w", ascending=True).first()
    assert flipped["auc"] == pytest.approx(pair_auc(rows))


def test_auc_needs_both_classes(spark):
    rows = [(i, 1, i / 10, 1) for i in range(10)]
    assert G.auc_gini(scored(spark, rows), "y", "s").first()["auc"] is None


def brute_ks(rows, bins=10, ascending=False):
    pdf = pd.DataFrame(rows, columns=["k", "y", "s", "w"])
    pdf = pdf.sort_values(["s", "k"], ascending=[ascending, True])
    pdf["b"] = pd.cut(pdf["w"].cumsum(), bins, labels=False) + 1
    pdf["bad"], pdf["good"] = pdf["w"] * pdf["y"], pdf["w"] * (1 - pdf["y"])
    g = pdf.groupby("b")[["bad", "good"]].sum().reindex(range(1, bins + 1), fill_value=0)
    share = 100 * g.cumsum() / g.sum()
    return g, (share["bad"] - share["good"]).abs().round(4)


@pytest.mark.parametrize("partitions", [1, 32])
@pytest.mark.parametrize("mode", [None, "score"])
def test_ks_table_matches_pandas(spark, partitions, mode):
    rows = sample()
    got = G.ks_table(scored(spark, rows, partitions), "y", "s", "w", "k", mode=mode)
    got = got.toPandas().sort_values("Decile").reset_index(drop=True)
    g, ks = brute_ks(rows, ascending=mode == "score")
    assert got["Decile"].tolist() == list(range(5, 105, 10))
    assert got["bads"].tolist() == g["bad"].tolist()
    assert got["goods"].tolist() == g["good"].tolist()
    np.testing.assert_allclose(got["KS"], ks, atol=2e-4)
    assert (got["max_ks"] == "<----").sum() >= 1
    assert got["auc"].iloc[0] == pytest.approx(pair_auc(rows) if mode is None else 1 - pair_auc(rows))


def test_ks_keeps_empty_slices(spark):
    rows = [(0, 1, 0.9, 1), (1, 0, 0.8, 1000), (2, 1, 0.7, 1), (3, 0, 0.6, 1)]
    got = G.ks_table(scored(spark, rows), "y", "s", "w", "k").orderBy("Decile").collect()
    assert len(got) == 10
    assert got[4]["total"] == 0 and got[4]["min_scr"] is None and got[4]["bad_rate"] is None


def test_bins_must_divide_100(spark):
    with pytest.raises(ValueError):
        G.ks_table(scored(spark, sample(20)), "y", "s", "w", "k", bins=7)


def test_monotone_check(spark):
    rows = [(i, int(i < 50), 1 - i / 100, 1) for i in range(100)]
    assert G.is_monotone(G.ks_table(scored(spark, rows), "y", "s", "w", "k")).first()[0]
    rows = [(i, int(i >= 50), 1 - i / 100, 1) for i in range(100)]
    assert not G.is_monotone(G.ks_table(scored(spark, rows), "y", "s", "w", "k")).first()[0]


def test_perfect_score(spark):
    df = scored(spark, [(i, int(i < 50), 1 - i / 100, 1) for i in range(100)])
    assert G.pr_auc(df, "y", "s").first()["pr_auc"] == pytest.approx(1.0)
    best = G.best_threshold(G.roc_curve(df, "y", "s")).first()
    assert best["gmean"] == pytest.approx(1.0) and best["threshold"] == pytest.approx(0.51)
    m = G.classification_metrics(df, "y", "s").first()
    assert (m["tp"], m["fp"], m["fn"], m["tn"]) == (50, 1, 0, 49)


@pytest.mark.parametrize("n", [5, 10, 11, 137])
def test_capture_rates(spark, n):
    rows = [(i, i % 2, float(i % 5), 1) for i in range(n)]
    got = {r["share"]: r for r in G.capture_rates(scored(spark, rows), "y", "s", "k").collect()}
    order = sorted(rows, key=lambda r: (-r[2], r[0]))
    for share in (0.1, 0.2):
        top = order[: int(n * share)]
        assert got[share]["captured"] == sum(r[1] for r in top)


@pytest.mark.parametrize("n", [1, 9, 10, 11, 57])
def test_rank_deciles_match_qcut(spark, n):
    rows = [(i, 0, float(i % 4), 1) for i in range(n)]
    got = B.with_rank_decile(scored(spark, rows), "s", "k").toPandas().set_index("k")["decile"]
    if n == 1:
        assert got.tolist() == [1]
        return
    pdf = pd.DataFrame(rows, columns=["k", "y", "s", "w"]).sort_values(["s", "k"])
    want = pd.qcut(pdf["s"].rank(method="first"), 10).rank(method="dense", ascending=False)
    assert got.sort_index().tolist() == want.sort_index().astype(int).tolist()


def test_missing_scores_have_no_decile(spark):
    rows = [(i, i % 2, None if i % 4 == 0 else i / 100, 1) for i in range(100)]
    got = B.with_rank_decile(scored(spark, rows), "s", "k").toPandas()
    assert got[got["s"].isna()]["decile"].isna().all()
    assert got[got["s"].notna()]["decile"].value_counts().sort_index().tolist() == [
        (got["s"].notna().sum() + 9 - i) // 10 for i in range(10)
    ] or got[got["s"].notna()]["decile"].nunique() == 10


@pytest.mark.parametrize("scores", [[0.3] * 20, [0.1, 0.1, 0.2, 0.9, 0.9, 0.9, None], list(np.arange(40) / 7)])
def test_quantile_deciles_match_qcut(spark, scores):
    rows = [(i, 0, None if s is None else float(s), 1) for i, s in enumerate(scores)]
    got = B.with_quantile_decile(scored(spark, rows), "s").toPandas().set_index("k")["decile"].sort_index()
    series = pd.Series([np.nan if s is None else s for s in scores])
    bins = pd.qcut(series, 10, duplicates="drop")
    want = bins.cat.codes.where(bins.notna()).rank(method="dense", ascending=False)
    assert got.isna().tolist() == want.isna().tolist()
    assert got.dropna().tolist() == want.dropna().tolist()


def test_score_bin_edges(spark):
    scores = [0.0, 0.1, 0.3, 0.30000000000000004, 0.7000000000000001, 0.9999, 1.0, None]
    df = scored(spark, [(i, 0, s, 1) for i, s in enumerate(scores)])
    got = [r["score_bin"] for r in B.with_score_bin(df, "s").orderBy("k").collect()]
    want = pd.cut(pd.Series(scores, dtype=float), np.arange(0, 1.1, 0.1), right=False).cat.codes + 1
    assert [x or 0 for x in got] == want.tolist()


def test_classification_report(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 0), (0, 0), (None, 1)], "y int, p int")
    got = {r["class"]: r for r in G.classification_report(df, "y", "p").collect()}
    assert got["1"]["precision"] == 1.0 and got["1"]["recall"] == 0.5
    assert got["0"]["support"] == 2 and got["macro avg"]["support"] == 4


def test_response_summary_reduced_and_null_group_last(spark):
    rows = [("a", 1), ("a", 0), ("b", 1), (None, 0)]
    df = spark.createDataFrame(rows, "v string, flg_resp int")
    got = S.response_summary(df, "v", ascending=False, full=False).orderBy("cumu_cnt").collect()
    assert [r["v"] for r in got] == ["b", "a", None]
    assert got[0]["good_bad_ratio_resp"] is None
    assert got[1]["resp_rate"] == 50.0


def test_crosstab_percentages(spark):
    df = spark.createDataFrame([("x", "p"), ("x", "q"), ("y", "p"), (None, "p")], "a string, b string")
    got = {(r["a"], r["b"]): r for r in S.crosstab(df, "a", "b").collect()}
    assert got["x", "p"]["row_pct"] == 50.0 and got["x", "p"]["col_pct"] == 50.0
    assert ("y", "q") not in got and len(got) == 3
    assert df.agg(F.count("*")).first()[0] == 4
