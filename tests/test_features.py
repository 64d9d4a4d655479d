import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from reachmark.functions import stats
from reachmark.functions.columns import cap, coerce_number, scorecard_points
from reachmark.operators import encoding as E
from reachmark.operators import profile as P
from reachmark.operators import screening as C
from reachmark.operators import select as S
from reachmark.operators import significance as T


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(1)
    a = rng.normal(100, 5, 300)
    rows = [
        (i, float(a[i]), float(a[i] * 2 + rng.normal()), None if i % 5 == 0 else float(i % 9), 7.0, None, "x" if i % 3 else None, i % 2)
        for i in range(300)
    ]
    return spark.createDataFrame(
        rows, "k long, a double, b double, c double, const double, empty double, cat string, y int"
    ).repartition(4)


def test_tail_probabilities():
    assert stats.chi2_tail(5.991464547, 2) == pytest.approx(0.05, abs=1e-9)
    # Closed form at an even number of degrees of freedom: a Poisson sum.
    poisson = sum(math.exp(k * math.log(200) - 200 - math.lgamma(k + 1)) for k in range(150))
    assert stats.chi2_tail(400.0, 300) == pytest.approx(poisson, rel=1e-9)
    assert stats.t_two_sided(-2, 10) == pytest.approx(0.07338803477, abs=1e-9)
    assert stats.normal_two_sided(1.96) == pytest.approx(0.0499957903, abs=1e-9)
    assert stats.chi2_tail(0, 3) == 1.0 and stats.t_two_sided(0, 5) == pytest.approx(1.0)


def test_correlation_matches_pandas(table):
    cols = ["a", "b", "c", "const", "empty"]
    pdf = table.toPandas()
    for r in P.corr_pairs(table, cols).collect():
        if {"const", "empty"} & {r["a"], r["b"]}:
            assert r["corr"] is None
        else:
            assert r["corr"] == pytest.approx(pdf[r["a"]].corr(pdf[r["b"]]))


@pytest.mark.parametrize("more", [0, 8])
def test_a_column_constant_beside_another_has_no_correlation(spark, more):
    # x is 0.1 wherever y is present, NaN counts as missing
    rows = [(0.1 if i % 2 else i * 1.7, float(i) if i % 2 else math.nan) for i in range(200)]
    df = spark.createDataFrame(rows, "x double, y double").repartition(3)
    df = df.select("*", *[(F.col("x") * n + F.rand(n)).alias(f"z{n}") for n in range(more)])
    got = {(r["a"], r["b"]): r["corr"] for r in P.corr_pairs(df, df.columns).collect()}
    assert got["x", "y"] is None
    assert all(got["x", f"z{n}"] is not None for n in range(more))


def test_vif_is_uncentered(table):
    got = {r["variable"]: r["vif"] for r in C.vif(table, ["a", "b", "c", "const"]).collect()}
    x = table.toPandas()[["a", "b", "c", "const"]].fillna(0).to_numpy()
    for i, name in enumerate(["a", "b", "c", "const"]):
        rest = np.delete(x, i, axis=1)
        beta, *_ = np.linalg.lstsq(rest, x[:, i], rcond=None)
        r2 = 1 - ((x[:, i] - rest @ beta) ** 2).sum() / (x[:, i] ** 2).sum()
        assert got[name] == pytest.approx(1 / (1 - r2), rel=1e-6)
    assert {r["variable"] for r in C.screen_vif(table, ["a", "b"], 5).collect()} == {"a", "b"}
    assert "a" not in {r["variable"] for r in C.vif(table, ["a", "b"], fixed=["a"]).collect()}


def test_screens(table):
    assert [r["variable"] for r in C.screen_collinear(table, ["a", "c", "b"], 0.8).collect()] == ["b"]
    cols = ["a", "const", "empty", "cat"]
    single = {r["variable"] for r in C.screen_single_unique(table, cols).collect()}
    assert single == {"const", "cat"}
    result = C.feature_screen(table, 0.5, fixed=["const"], exclude=["k"])
    assert result.dropped == {"excluded": ["k"], "missing": ["empty"], "single_unique": ["cat"]}
    assert result.kept == ["a", "b", "c", "const", "y"]


def test_moments_match_pandas(table):
    got = P.moments(table, ["a", "c", "const", "empty"]).toPandas().set_index("variable")
    pdf = table.toPandas()
    assert got.loc["a", "skew"] == pytest.approx(pdf["a"].skew())
    assert got.loc["c", "std"] == pytest.approx(pdf["c"].std())
    assert pd.isna(got.loc["const", "skew"]) and "empty" not in got.index


def test_log_suggestion(spark):
    rows = [(float(i**3), float(i % 2), float(i), float(i**3 - 5)) for i in range(50)]
    df = spark.createDataFrame(rows, "skewed double, flag double, even double, negative double")
    df = df.withColumn("rare", (F.col("even") == 1).cast("double"))
    assert C.log_suggestion(df, df.columns) == ["skewed"]


def test_clusters_group_correlated_columns(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(200, 2))
    rows = [
        (i, *(float(base[i, j % 2] + 0.01 * rng.normal()) for j in range(10))) for i in range(200)
    ]
    cols = [f"v{j}" for j in range(10)]
    df = spark.createDataFrame(rows, "k long, " + ", ".join(f"{c} double" for c in cols))
    ids = {r["variable"]: r["cluster"] for r in C.variable_clusters(df, cols, "k").collect()}
    assert len(set(ids.values())) == 2
    assert len({ids[c] for c in cols[::2]}) == 1


def chi2_of(table, yates):
    o = np.array(table, dtype=float)
    e = o.sum(1, keepdims=True) * o.sum(0, keepdims=True) / o.sum()
    return (np.maximum(abs(o - e) - (0.5 if yates else 0), 0) ** 2 / e).sum()


def test_chi2(spark):
    rows = [("p", 1)] * 30 + [("p", 0)] * 20 + [("q", 1)] * 15 + [("q", 0)] * 35
    df = spark.createDataFrame(rows, "two string, y int")
    df = df.withColumn("three", F.when(F.rand(1) < 0.3, "r").otherwise(F.col("two")))
    df = df.withColumn("one", F.lit("x"))
    got = {r["variable"]: r for r in T.chi2_screen(df, ["two", "one", "y"], "y").collect()}
    assert got["two"]["stat"] == pytest.approx(chi2_of([[30, 20], [15, 35]], True))
    assert got["two"]["dof"] == 1 and got["two"]["p_value"] < 0.01
    assert got["one"]["stat"] is None and "y" not in got


def test_chi2_null_and_single_label(spark):
    df = spark.createDataFrame([("p", 1), ("q", 1), (None, 1)], "c string, y int")
    assert T.chi2_screen(df, ["c"], "y").first()["stat"] is None
    df = spark.createDataFrame([("p", 1), ("q", 0), (None, 1), (None, 0)], "c string, y int")
    assert T.chi2_screen(df, ["c"], "y").first()["dof"] == 1
    assert T.chi2_screen(df, ["c"], "y", include_null=True).first()["dof"] == 2


def test_ttest(table):
    got = {r["variable"]: r for r in T.ttest_screen(table, ["a", "c", "const"], "y").collect()}
    pdf = table.toPandas()
    x, y = (pdf[pdf["y"] == k]["c"].dropna() for k in (0, 1))
    n0, n1 = len(x), len(y)
    sp = ((n0 - 1) * x.var() + (n1 - 1) * y.var()) / (n0 + n1 - 2)
    assert got["c"]["stat"] == pytest.approx((x.mean() - y.mean()) / math.sqrt(sp * (1 / n0 + 1 / n1)))
    assert got["c"]["dof"] == n0 + n1 - 2
    assert got["const"]["stat"] is None and got["const"]["p_value"] is None


def test_bivariate_small_groups_and_strict_mode(spark):
    rows = [(float(i), i % 2, int(i % 20 == 1), "a" if i % 10 else "b") for i in range(400)]
    df = spark.createDataFrame(rows, "x double, seg int, y int, cat string")
    got = T.bivariate_rates(df, "y", "seg", ["cat"], ["x"], bins=4, min_rows=50).collect()
    assert all(r["cnt"] >= 50 for r in got)
    none = [r for r in got if r["seg"] == 0]
    assert none and all(r["responders"] == 0 for r in none)
    strict = T.bivariate_rates(df, "y", "seg", ["cat"], ["x"], 4, 50, strict_reference=True)
    assert all(r["responders"] is None for r in strict.filter("seg = 0").collect())
    p = T.with_chi2_p(T.bivariate_rates(df, "y", "seg", ["cat"], [], min_rows=1)).filter("seg = 0").first()
    assert p["p_value"] == 1.0


def brute_woe(pdf, col, label):
    d = pdf.assign(c=pdf[col].fillna("None")).groupby("c")[label].agg(["count", "sum"])
    e, ne = d["sum"].clip(lower=0.5), (d["count"] - d["sum"]).clip(lower=0.5)
    return np.log((e / e.sum()) / (ne / ne.sum()))


def test_woe_floor_nulls_and_unseen(spark):
    rows = [("p", 1)] * 5 + [("q", 0)] * 7 + [("r", 1), ("r", 0), (None, 1), (None, 0), (None, 0)]
    df = spark.createDataFrame(rows, "c string, y int").repartition(3)
    want = brute_woe(df.toPandas(), "c", "y")
    model = E.WoeModel.fit(df, ["c"], "y")
    got = {r["Cutoff"]: r for r in model.table.collect()}
    assert {k: r["WoE"] for k, r in got.items()} == pytest.approx(want.to_dict())
    assert got["p"]["NonEvents"] == 0.5 and got["p"]["N"] == 5
    new = spark.createDataFrame([(1, "p"), (2, None), (3, "new")], "k int, c string")
    coded = {r["k"]: r["c"] for r in model.transform(new).collect()}
    assert coded[1] == pytest.approx(want["p"]) and coded[2] == pytest.approx(want["None"]) and coded[3] is None
    strict = {r["k"]: r["c"] for r in model.transform(new, strict_reference=True).collect()}
    assert strict[2] is None


def test_woe_without_broadcast_is_the_same(spark, monkeypatch):
    rows = [(i, f"c{i % 7}", i % 2) for i in range(100)]
    df = spark.createDataFrame(rows, "k int, c string, y int")
    model = E.WoeModel.fit(df, ["c"], "y")
    small = model.transform(df).orderBy("k").collect()
    monkeypatch.setattr(E, "SMALL_TABLE_ROWS", 1)
    assert model.transform(df).orderBy("k").collect() == small


def test_preparation(spark):
    rows = [(i, i % 4 == 0 and 1 or 0, "a" if i % 3 else None, float(i**5)) for i in range(200)]
    df = spark.createDataFrame(rows, "k long, y int, c string, x double")
    cols = ["k", "y", "c", "x", "not_there"]
    plain = E.prepare_training(df, "y", "k", ["c"], ["x"], cols)
    assert plain.woe is None and plain.log_cols is None
    assert plain.data.filter("c = 'None'").count() == 67
    full = E.prepare_training(df, "y", "k", ["c"], ["x"], cols, balance_kind="balanced", log=True, woe=True)
    assert full.data.count() == 100 and full.log_cols == ["x"]
    held = E.prepare_holdout(df, full, ["x", "c"], label="y")
    assert held.columns == ["x", "c", "y"] and held.count() == 200
    assert held.agg(F.max("x")).first()[0] == pytest.approx(math.log(199.0**5 + 1))


def test_scalar_expressions(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (0.5,), (0.9,), (None,)], "p double")
    got = [r[0] for r in df.select(scorecard_points(F.col("p"))).collect()]
    assert got == [None, None, 1130, int(math.log(0.1 / 0.9) * 40 / math.log(2) + 1130), None]
    capped = [r[0] for r in df.select(cap(F.col("p"), 0.2, 0.8)).collect()]
    assert capped == [0.2, 0.8, 0.5, 0.8, None]
    text = spark.createDataFrame([("1.5",), ("x",), (None,)], "t string")
    assert [r[0] for r in text.select(coerce_number(F.col("t"))).collect()] == [1.5, None, None]


def test_column_helpers(spark):
    df = spark.createDataFrame([(1, 2, "x", 4)], "A int, b int, s string, chg_x int")
    twice = df.select("A", "b", F.col("b").alias("a"), "s")
    assert S.drop_duplicate_names(twice).columns == ["A", "b", "s"]
    assert S.lower_names(df).columns == ["a", "b", "s", "chg_x"]
    roles = S.column_roles(df, "b", exclude=["A"])
    assert roles.categorical == ["s", "chg_x", "b"] and roles.numeric == ["b"]
    model = S.model_columns(df, ["A", "s", "A", "b"], target="b", weight="w")
    assert model.numeric == ["A"] and model.categorical == ["s"]
    base = spark.createDataFrame([(1, 2, 3, 4)], "duns int, flg_mailed int, flg_resp int, other int")
    assert S.baseline_projection(base, "flg_resp").columns == ["flg_mailed", "duns", "flg_resp"]
    assert "flg_mailed" in S.baseline_projection(base.withColumn("flg_sub", F.lit(1)), "flg_sub").columns


def test_products_of_many_columns_are_summed_in_tiles(spark):
    rng = np.random.default_rng(4)
    p, n = 150, 400
    x = rng.normal(size=(n, p)) + rng.normal(size=(n, 1))
    x[rng.random((n, p)) < 0.05] = np.nan
    x[:, 7] = 3.0
    cols = [f"c{i}" for i in range(p)]
    df = spark.createDataFrame([[None if np.isnan(v) else float(v) for v in r] for r in x], ", ".join(f"{c} double" for c in cols)).repartition(90)
    want = pd.DataFrame(x, columns=cols).corr()
    sums = P.pair_sums(df, cols)
    assert sums.rdd.getNumPartitions() <= 8 and sums.count() == p * (p + 1) // 2
    got = {(r["a"], r["b"]): r["corr"] for r in P.corr_pairs(df, cols).collect()}
    assert len(got) == p * (p - 1) // 2
    for (a, b), c in got.items():
        assert c is None if "c7" in (a, b) else c == pytest.approx(want.loc[a, b])
