import datetime
import random

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from reachmark.functions import text as X
from reachmark.functions.regions import state_regions
from reachmark.operators import explain as E
from reachmark.operators import learners as L
from reachmark.operators import logistic
from reachmark.operators import lookup as J
from reachmark.operators import names as N
from reachmark.operators import scoring as S
from reachmark.operators.search import draw
from reachmark.runtime import materialize, scratch_path

SPEC = L.ModelSpec("y", "k", ("a", "b"), ("c",))


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(0)
    data = []
    for i in range(600):
        a, b = float(rng.normal()), float(rng.normal())
        c = "pqr"[i % 3]
        p = 1 / (1 + np.exp(-(2 * a - b + (c == "q"))))
        data.append((i, int(rng.random() < p), None if i % 50 == 0 else a, b, None if i % 70 == 0 else c))
    return spark.createDataFrame(data, "k long, y int, a double, b double, c string").repartition(4)


def test_validation(spark, rows):
    good = L.validate_input(rows, SPEC)
    assert dict(good.dtypes)["wt"] == "double"
    with pytest.raises(TypeError):
        L.validate_input([1], SPEC)
    with pytest.raises(KeyError):
        L.validate_input(rows.drop("y"), SPEC)
    with pytest.raises(KeyError):
        L.validate_input(rows, SPEC, given_weight=True)
    with pytest.raises(L.InsufficientRecordsError):
        L.validate_input(rows.limit(99), SPEC)


@pytest.mark.parametrize("family,params", [("gbt", {"n_estimators": 5, "scale_pos_weight": 0.5}), ("rf", {"n_estimators": 5, "neg_bagging_fraction": 0.5, "min_child_weight": 0.01}), ("lr", {})])
def test_families_learn(spark, rows, family, params):
    df = L.validate_input(rows, SPEC)
    scored = L.fit_family(df, SPEC, family, params).score(df)
    assert scored.columns == [*df.columns, "proba"]
    m = L.model_metrics(scored, "y", "proba", family).first()
    assert m["auc"] > 0.75 and 0 < m["no_skill"] < 1
    with pytest.raises(ValueError):
        L.fit_family(df, SPEC, "svm")


def test_search_refit_and_compare(spark, rows):
    spaces = {"lr": {"reg_lambda": ("uniform", 0.0, 0.1)}}
    search = L.Search(SPEC, ["lr"], spaces, n_iter=2, kfolds=2)
    trials = search.run(rows)
    assert search.train.count() + search.test.count() == 600
    assert [t.no for t in trials] == [1, 2] and trials[0].params != trials[1].params
    assert 0 < trials[0].loss < 0.4
    table = search.trials_table(spark)
    assert table.count() == 14
    assert search.refit("lr", 2).params == trials[1].params
    for bad in (0, 3, "x"):
        with pytest.raises(ValueError):
            search.refit("lr", bad)
    comparison, chosen = search.compare()
    assert chosen == "lr" and comparison.first()["auc"] > 0.75
    assert search.final("lr").family == "lr"
    report = search.metric_report(spark).filter("metric = 'ROC_AUC'").first()
    assert report["OOT"] == pytest.approx(comparison.first()["auc"]) and report["Best_N_Tree"] is None
    with pytest.raises(ValueError):
        search.final("gbt")


def test_draws_are_seeded_and_on_step():
    import random

    one = draw(L.SPACES["gbt"], random.Random(3))
    assert one == draw(L.SPACES["gbt"], random.Random(3))
    assert one["n_estimators"] % 50 == 0 and one["scale_pos_weight"] > 0


def test_model_store(spark, rows):
    df = L.validate_input(rows, SPEC)
    fitted = L.fit_family(df, SPEC, "lr")
    root = scratch_path(spark, "models")
    run = L.save_run(spark, root, "m1", fitted, 0.8, datetime.date(2024, 1, 1))
    L.save_run(spark, root, "m2", fitted)
    loaded = L.load_run(spark, root, run)
    assert loaded.spec == SPEC and loaded.family == "lr"
    a = fitted.score(df).agg(F.sum("proba")).first()[0]
    assert loaded.score(df).agg(F.sum("proba")).first()[0] == pytest.approx(a)
    with pytest.raises(KeyError):
        L.load_run(spark, root, "nope")
    ages = N.stale_models(L.runs_table(spark, root).filter("model_name = 'm1'"), F.lit("2024-06-30").cast("date"))
    assert (ages.first()["age_days"], ages.first()["refit"]) == (181, True)


def test_importance(spark, rows):
    df = L.validate_input(rows, SPEC)
    got = L.importance_share(L.fit_family(df, SPEC, "rf", {"n_estimators": 5}), spark).collect()
    assert got[0]["variable"] == "a" and sum(r["share"] for r in got) == pytest.approx(1)


def test_score_table_checks_columns_first(spark, rows):
    fitted = L.fit_family(L.validate_input(rows, SPEC), SPEC, "lr")
    with pytest.raises(KeyError):
        S.score_table(fitted, rows.drop("c"), categorical=["c"])
    assert S.score_table(fitted, rows, categorical=["c"]).filter("proba is null").count() == 0


def test_batch_segments(spark):
    df = spark.createDataFrame([(1, "C1", 1.0), (2, "C2", 1.0)], "duns long, class_type string, x double")
    models = {"B_ppp_RESP_C1": (0.0, {"x": 0.0}), "B_APPR_all": (0.0, {"x": 1.0}), "B_odd_all": (0.0, {})}
    one = S.score_batch_linear(df, models)
    many = S.score_batch(
        df, {n: lambda d, b=b, c=c: d.withColumn("proba", S.linear_proba(F.lit(b), c)) for n, (b, c) in models.items()}
    )
    want = {(1, "B_ppp_RESP"), (1, "B_APPR"), (2, "B_APPR")}
    for got in (one, many):
        assert {(r["duns"], r["mdl_name"]) for r in got.collect()} == want
    assert S.score_batch(df, {"B_odd_all": None}).count() == 0


def test_model_selection(spark):
    names = ["K1_ppp_RESP_C1", "K1_nonppp_RESP_C1", "K1_nonppp_RESP_C2", "K1_APPR_all", "K1_fundamt_all", "K2_APPR_all"]
    reg = spark.createDataFrame([(v, n) for n in names for v in ("V1", "V50")], "version string, model_name string")

    def pick(*args):
        return {r["model_name"] for r in S.select_models(reg, *args).collect()}

    assert pick("K1", "C1", "RESP", "N", "V1") == {"K1_nonppp_RESP_C1"}
    assert pick("K1", "C1", "RESP", "Y", "V1") == {"K1_ppp_RESP_C1"}
    assert pick("K1", "C1", "RESP", "N", "V50") == {"K1_ppp_RESP_C1", "K1_nonppp_RESP_C1"}
    assert pick("K1", "C9", "APPR", "N", "V1") == {"K1_APPR_all"}
    assert pick("K1", "C1", "fundamt", "N", "V1") == {"K1_fundamt_all"}
    assert pick("K1", "C1", "odd", "N", "V1") == set()


def test_shapley_paths_agree_on_a_linear_model(spark):
    df = spark.createDataFrame([(i, float(i % 7), float(i % 5), float(i % 3)) for i in range(60)], "k long, a double, b double, c double")
    beta = {"a": 0.5, "b": -1.0, "c": 0.25}

    def score(rows):
        return rows.withColumn("proba", sum(F.col(c) * w for c, w in beta.items()))

    exact = {r["col_name"]: r["importance"] for r in E.shapley_linear(df, beta).collect()}
    mc = {r["col_name"]: r["importance"] for r in E.shapley_mc(df, score, list(beta), "k").collect()}
    assert mc == pytest.approx(exact)


def test_partial_dependence_of_a_linear_score(spark):
    df = spark.createDataFrame([(float(i), 1.0) for i in range(101)], "a double, b double")
    got = E.partial_dependence(df, lambda d: d.withColumn("proba", F.col("a") + F.col("b")), ["a"], grid=3)
    assert [(r["value"], r["mean_proba"]) for r in got.orderBy("point_no").collect()] == [(0.0, 1.0), (47.5, 48.5), (95.0, 96.0)]


TEXTS = [
    ("Café du Monde, Inc.", "café du monde"),
    ("  THE  Co-op  Corp ", "the coop"),
    ("LLC Inc", ""),
    ("incorporated llcs", "incorporated llcs"),
    ("A_b 12", "a_b 12"),
    (None, None),
]


def test_normalize(spark):
    df = spark.createDataFrame([(t,) for t, _ in TEXTS], "t string")
    got = [r[0] for r in df.select(X.normalize(F.col("t"), X.COMPANY_STATUSES)).collect()]
    assert got == [w for _, w in TEXTS]
    plain = df.limit(1).select(X.normalize(F.col("t"), [])).first()[0]
    assert plain == "café du monde inc"


def test_cleaning_tokens_and_pairs(spark):
    df = spark.createDataFrame([("Shop 24/7 No.1!",), (None,), ("",), ("one",)], "t string")
    assert [r[0] for r in df.select(X.clean_business_name(F.col("t"))).collect()] == ["shop numnum nonum", None, "", "one"]
    assert [r[0] for r in df.select(X.tokens(F.col("t"))).collect()] == [["Shop", "24/7", "No.1!"], [], [], ["one"]]
    pairs = df.select(X.uni_and_bigrams(X.terms(F.col("t")))).collect()
    assert [r[0] for r in pairs] == [["shop", "24", "no", "shop 24", "24 no"], [], [], ["one"]]


def test_lemmas_keep_order_and_cache(spark):
    df = spark.createDataFrame([(1, "red shops red"), (2, None), (3, "shops"), (4, "shops")], "k int, t string")
    lemmas = spark.createDataFrame([("shops", "shop")], "token string, lemma string")
    got = {r["k"]: r["lemmatized"] for r in N.lemmatize(df, "k", "t", lemmas).collect()}
    assert got == {1: "red shop red", 2: "", 3: "shop", 4: "shop"}
    cache = spark.createDataFrame([("shops", "kept")], "name string, lemmatized string")
    merged = N.merge_lemma_cache(df.select(F.col("t").alias("name")), cache, lemmas)
    stored = N.store_lemma_cache(merged, scratch_path(spark, "lemmas"))
    assert {tuple(r) for r in stored.collect()} == {("shops", "kept"), ("red shops red", "red shop red")}


def test_unknown_parameters_are_refused(spark, rows):
    df = L.validate_input(rows, SPEC)
    for family, name in (("gbt", "elastic_net"), ("rf", "bagging_temperature"), ("lr", "max_depth")):
        with pytest.raises(ValueError, match=name):
            L.fit_family(df, SPEC, family, {name: 1})


def test_text_classifier_widths(spark):
    rows = [(i, "good fine shop" if i % 2 else "bad sad shop", i % 2) for i in range(60)]
    df = spark.createDataFrame([*rows, (99, "unlabelled", None)], "k int, t string, y int")
    for width in (8, 1 << 18):
        model = N.fit_text_classifier(df, "t", "y", width=width)
        got = N.classify_text(model, df, "t")
        assert got.filter("y is not null and y <> predicted").count() == 0
    with pytest.raises(ValueError):
        N.fit_text_classifier(df.limit(5), "t", "y")


def test_term_vectors_take_words_and_lengths_once(spark):
    rows = [(1, "good fine fine shop"), (2, "zz"), (3, None), (4, "fine good")]
    df = spark.createDataFrame(rows, "k int, t string")
    words = spark.createDataFrame([("fine", 2.0, 0), ("good", 1.0, 1), ("fine fine", 1.0, 2)], "term string, idf double, term_no int")
    parts = N.vector_parts(df, "k", "t", words, 3)
    plan = parts._jdf.queryExecution().optimizedPlan().toString()
    assert all("aggregate(" not in line for line in plan.splitlines() if "transform(" in line)
    assert plan.count("regexp_extract_all(") == 1
    terms = N.tfidf_terms(df, "t", 1)
    assert terms._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all(") == 1
    assert {r["term"]: r["texts"] for r in terms.collect()} == {
        t: 2 if t in ("good", "fine") else 1 for t in ("good", "fine", "shop", "zz", "good fine", "fine fine", "fine shop", "fine good")
    }
    got = {r["k"]: r["features"] for r in N.term_vectors(df, "k", "t", words, 3).collect()}
    assert np.allclose(got[1].toArray(), np.array([4, 1, 1]) / 18**0.5) and got[2].numNonzeros() == got[3].numNonzeros() == 0
    assert np.allclose(got[4].toArray(), np.array([2, 1, 0]) / 5**0.5) and len(got) == 4


def test_lookups(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, v string")
    members = spark.createDataFrame([("a",), ("a",), (None,)], "m string")
    got = {r["k"]: r["f"] for r in J.membership_flag(df, "v", members, "f").collect()}
    assert got == {1: True, 2: False, 3: False}
    groups = spark.createDataFrame([("x", 1), ("y", 2), ("z", 3)], "g string, n int")
    pairs = {(r["g_a"], r["g_b"], r["n_a"], r["n_b"]) for r in J.group_pairs(groups, "g").collect()}
    assert pairs == {("x", "y", 1, 2), ("x", "z", 1, 3), ("y", "z", 2, 3)}
    many = spark.range(40).selectExpr("concat('g', lpad(id, 2, '0')) AS g", "id AS n").unionByName(spark.createDataFrame([(None, 9)], "g string, n long"))
    found = J.group_pairs(many, "g", block=7)
    assert found.count() == found.distinct().count() == 40 * 39 // 2 and found.filter("g_a >= g_b").count() == 0
    states = spark.createDataFrame([("TX",), ("XX",)], "member string")
    found = {r["member"]: r["region"] for r in J.with_lookup(states, state_regions(spark), ["member"]).collect()}
    assert found == {"TX": "south_west", "XX": None}


def test_folds_are_ranked_once_for_all_trials(spark, monkeypatch):
    ranked, real = [], L.stratified_folds
    monkeypatch.setattr(L, "stratified_folds", lambda *a, **k: ranked.append(1) or real(*a, **k))

    class Same:
        def score(self, df):
            return df.withColumn("proba", F.col("id") / 200)

    monkeypatch.setattr(L, "fit_family", lambda *a: Same())
    search = L.Search(L.ModelSpec("y", "id"), kfolds=2)
    search.train = spark.range(200).select("id", (F.col("id") % 3 == 0).cast("int").alias("y"), F.lit(1.0).alias("wt"))
    losses = {search._cross_validate(family, {}) for family in ("gbt", "plain")}
    assert len(ranked) == 1 and len(losses) == 1


def test_text_weights_stay_a_table(spark, monkeypatch):
    """The weights are those of MLlib, but nothing on the driver grows with the terms."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    data = []
    for i in range(240):
        text = " ".join(rng.choice(words[:40] if i % 3 else words[20:]) for _ in range(rng.randint(1, 30)))
        data.append((i, text if i % 50 else None, float(i % 3 == 0) if i % 40 else None))
    df = spark.createDataFrame(data, "doc_id long, text string, label double").repartition(3)
    monkeypatch.setattr(logistic, "BLOCK_CELLS", 100)
    rows = df.filter("label is not null")
    kept, size = N.numbered_terms(N.tfidf_terms(rows, "text", 3))
    vocabulary = materialize(kept)
    vectors = N.term_vectors(rows, "doc_id", "text", vocabulary, size).join(rows.select("doc_id", "label"), "doc_id")
    want = LogisticRegression(regParam=2 / rows.count(), maxIter=500, tol=1e-12, standardization=False).fit(vectors)
    monkeypatch.setattr(N, "LogisticRegression", None)  # which holds all weights, several times over
    found = N.fit_text_model(df, "doc_id", "text", "label", min_texts=3)
    number = {r.term: r.term_no for r in vocabulary.collect()}
    weights = {r.term: r.weight for r in found.vocabulary.collect()}
    assert weights.keys() == number.keys()
    assert max(abs(w - want.coefficients[number[t]]) for t, w in weights.items()) < 1e-4 and abs(found.intercept - want.intercept) < 1e-4
    predicted = {r.doc_id: r.predicted for r in found.predict(df, "doc_id", "text").collect()}
    assert len(predicted) == 240 and predicted[0] == int(want.intercept > 0)
    expected = {r.doc_id: int(r.prediction) for r in want.transform(vectors).collect()}
    assert all(predicted[i] == p for i, p in expected.items())


@pytest.mark.parametrize("y,sign", [([0.0] * 4, -1), ([1.0] * 4, 1)])
def test_one_class_is_always_predicted(y, sign):
    a, intercept = logistic.fit(np.array(y), 2.0, lambda b: b)
    assert not a.any() and intercept == sign * np.inf
