"""Boosted trees, their arrays and what is read from them, against plain loops."""

import itertools
import json
import math
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from reachmark.operators import boosted as B
from reachmark.operators import boosting
from reachmark.operators import explain as E
from reachmark.operators import learners as L
from reachmark.operators import scoring as S
from reachmark.operators import search
from reachmark.operators import trees as TR
from reachmark.runtime import scratch_path

SPEC = L.ModelSpec("y", "k", ("a", "b"), ("c",))
NOISY = L.ModelSpec("y", "k", ("a", "b"))


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(0)
    data = []
    for i in range(1500):
        a, b = float(rng.normal()), float(rng.normal())
        c = f"v{rng.integers(0, 6)}"
        p = 1 / (1 + np.exp(-(2 * a - b * b + (c == "v1") * 2)))
        data.append((i, int(rng.random() < p), None if i % 50 == 0 else a, b, None if i % 70 == 0 else c, "C1" if i % 3 else "C2"))
    df = spark.createDataFrame(data, "k long, y int, a double, b double, c string, class_type string").repartition(3)
    return L.validate_input(df, SPEC).cache()


@pytest.fixture(scope="module")
def fitted(rows):
    return L.fit_family(rows, SPEC, "gbt", {"n_estimators": 30, "max_depth": 3, "learning_rate": 0.2, "patience": 0})


def grid_of(df, model):
    frame, features = model.with_features(df)
    got = frame.select("k", TR.feature_array(features).alias("x")).orderBy("k").collect()
    return np.array([[np.nan if v is None else v for v in r["x"]] for r in got])


@pytest.mark.parametrize("family,params", [
    ("gbt", {"bagging_temperature": 0.5, "colsample_bylevel": 0.7, "subsample": 0.8, "scale_pos_weight": 0.5, "min_child_samples": 20}),
    ("bagged", {"reg_alpha": 1.0, "reg_lambda": 2.0, "pos_bagging_fraction": 0.7, "neg_bagging_fraction": 0.6, "colsample_bytree": 0.7}),
    ("plain", {"gamma": 0.2, "min_child_weight": 0.05, "reg_alpha": 1.0}),
])
def test_families_take_their_parameters(rows, family, params):
    got = L.fit_family(rows, SPEC, family, {"n_estimators": 15, "learning_rate": 0.2, **params})
    scored = got.score(rows)
    assert scored.columns == [*rows.columns, "proba"]
    assert scored.filter("proba is null or proba <= 0 or proba >= 1").count() == 0
    assert L.model_metrics(scored, "y", "proba", family).first()["auc"] > 0.75
    assert family != "plain" or L.tree_count(got) == 15


def test_default_spaces_fit():
    import random

    for family in L.BOOSTED:
        p = L.boost_params(family, search.draw(L.SPACES[family], random.Random(1)))
        assert 100 <= p.trees <= 1000 and 3 <= p.depth <= 5 and 0 < p.rate <= 0.05


def test_a_tree_equals_a_plain_loop(spark):
    """First splits, sums and leaf values by a loop over all cuts."""
    rng = np.random.default_rng(5)
    n = 400
    x = rng.integers(0, 12, (n, 3)).astype(float)
    y = (rng.random(n) < 1 / (1 + np.exp(-(x[:, 0] - 6) / 2 + (x[:, 1] > 4)))).astype(float)
    w = rng.uniform(0.5, 2, n)
    data = [(i, float(y[i]), float(w[i]), *map(float, x[i])) for i in range(n)]
    df = spark.createDataFrame(data, "k long, y double, w double, f0 double, f1 double, f2 double").repartition(4)
    p = boosting.BoostParams(trees=2, depth=2, rate=0.3, l1=0.5, l2=1.5, gamma=0.1, min_rows=5, patience=0, bins=256)
    names = ["f0", "f1", "f2"]
    args = (df, names, [F.col(c) for c in names], F.col("y"), F.col("w"), F.col("k"), F.lit(False), p)
    got = boosting.boost(*args).trees
    bias = math.log((w * y).sum() / (w * (1 - y)).sum())
    assert got.bias == pytest.approx(bias)
    soft = lambda g: math.copysign(max(abs(g) - p.l1, 0.0), g)
    score = lambda g, h: soft(g) ** 2 / (h + p.l2)
    margin = np.full(n, bias)
    for t in range(2):
        proba = 1 / (1 + np.exp(-margin))
        g, h = w * (proba - y), w * proba * (1 - proba)

        def split(rows, node, depth, t=t, g=g, h=h):
            best = (1e-12,)
            for j in range(3):
                for cut in sorted(set(x[:, j])):
                    low = rows[x[rows, j] <= cut]
                    high = rows[x[rows, j] > cut]
                    if min(len(low), len(high)) >= p.min_rows:
                        gain = 0.5 * (score(g[low].sum(), h[low].sum()) + score(g[high].sum(), h[high].sum()) - score(g[rows].sum(), h[rows].sum())) - p.gamma
                        if gain > best[0] + 1e-9:
                            best = (gain, j, cut, low, high)
            if depth == p.depth or len(best) == 1:
                value = -p.rate * soft(g[rows].sum()) / (h[rows].sum() + p.l2)
                assert got.value[t][node] == pytest.approx(value)
                margin[rows] += value
                return
            gain, j, cut, low, high = best
            assert (got.feature[t][node], got.threshold[t][node]) == (j, cut) and got.gain[t][node] == pytest.approx(gain)
            split(low, 2 * node + 1, depth + 1)
            split(high, 2 * node + 2, depth + 1)

        split(np.arange(n), 0, 0)
    assert got.margin(x) == pytest.approx(margin)


def test_summing_by_shuffle_gives_the_same_trees(rows, monkeypatch):
    params = {"n_estimators": 4, "max_depth": 2, "patience": 3}
    one = L.fit_family(rows, NOISY, "gbt", params).model
    monkeypatch.setattr(boosting, "DRIVER_BYTES", 0)
    monkeypatch.setattr(boosting, "PENDING", 1)
    two = L.fit_family(rows.repartition(5), NOISY, "gbt", params).model
    assert two.watched == pytest.approx(one.watched)
    assert two.trees.threshold.tolist() == one.trees.threshold.tolist()
    assert np.allclose(two.trees.value, one.trees.value)


def test_patience_keeps_the_best_prefix(spark):
    """A signal that takes many trees, then noise: boosting stops 20 trees after the best."""
    rng = np.random.default_rng(3)
    data = []
    for i in range(4000):
        a, b = float(rng.uniform(-3, 3)), float(rng.uniform(-3, 3))
        data.append((i, int(rng.random() < 1 / (1 + np.exp(-4 * np.sin(2 * a) * np.cos(b)))), a, b))
    df = L.validate_input(spark.createDataFrame(data, "k long, y int, a double, b double").repartition(2), NOISY)
    got = L.fit_family(df, NOISY, "gbt", {"n_estimators": 400, "max_depth": 2, "learning_rate": 0.5, "patience": 20})
    seen = got.model.watched
    kept = L.tree_count(got)
    assert kept == int(np.argmax(seen)) > 10
    assert len(seen) - 1 == kept + 20 < 400
    frame = L.with_training_columns(df, NOISY, {}).filter("_validation")
    table = {r["trees"]: r for r in TR.stages(got.model.trees, frame, "y").collect()}
    assert len(table) == kept + 1
    assert table[kept]["auc"] == pytest.approx(seen[kept], abs=0.01) and table[0]["auc"] == 0.5
    assert table[kept]["log_loss"] < table[1]["log_loss"] < table[0]["log_loss"]


def test_search_reports_the_kept_trees(spark, rows):
    spaces = {f: {"n_estimators": ("quniform", 10, 20, 5), "learning_rate": ("uniform", 0.2, 0.5), "max_depth": ("quniform", 2, 2, 1)} for f in ("gbt",)}
    found = L.Search(SPEC, ["gbt"], spaces, n_iter=1, kfolds=2)
    assert 0 < found.run(rows)[0].loss < 0.4
    found.refit("gbt")
    report = found.metric_report(spark).first()
    assert report["Best_N_Tree"] == len(found.final("gbt").model.trees) > 0


def test_stages_equal_each_prefix(rows, fitted):
    frame, features = fitted.model.with_features(rows)
    got = {r["trees"]: r["log_loss"] for r in TR.stages(fitted.model.trees, frame, "y", features=features).collect()}
    x = grid_of(rows, fitted.model)
    y = np.array([r["y"] for r in rows.select("k", "y").orderBy("k").collect()])
    for n in (0, 1, 7, 30):
        m = fitted.model.trees.first(n).margin(x)
        assert got[n] == pytest.approx((np.logaddexp(0, m) - y * m).mean())


# -- category statistics -------------------------------------------------------------------


def test_statistics_of_many_categories_equal_a_loop(spark):
    rng = np.random.default_rng(9)
    data = [(i, int(rng.random() < 0.3), f"c{rng.integers(0, 5000)}" if i % 3 else "hot", None if i % 11 == 0 else "x") for i in range(9000)]
    df = spark.createDataFrame(data, "k long, y int, c string, d string").repartition(4)
    held = F.col("k") % 10 == 0
    out, table, prior = B.ordered_statistics(df, ["c", "d"], F.col("y"), F.col("k"), held, 25)
    slices = {r["k"]: r["s"] for r in df.select("k", B.slice_of(F.col("k"), 25).alias("s")).collect()}
    training = [r for r in data if r[0] % 10]
    assert prior == pytest.approx(np.mean([r[1] for r in training]))
    sums: dict = {}
    for k, y, *values in training:
        for i, v in enumerate(values):
            cell = sums.setdefault((i, v or "None"), {}).setdefault(slices[k], [0, 0])
            cell[0] += 1
            cell[1] += y
    for r in out.collect():
        for i, v in enumerate((r["c"], r["d"])):
            own = B.SLICES if r["k"] % 10 == 0 else slices[r["k"]]
            cells = [c for s, c in sums.get((i, v or "None"), {}).items() if s < own]
            n, pos = sum(c[0] for c in cells), sum(c[1] for c in cells)
            assert r[f"_s{i}"] == pytest.approx((pos + prior) / (n + 1))
    whole = {(r["column"], r["value"]): r["stat"] for r in table.collect()}
    cells = sums[0, "hot"].values()
    assert whole["c", "hot"] == pytest.approx((sum(c[1] for c in cells) + prior) / (sum(c[0] for c in cells) + 1))


def test_five_thousand_categories_fit(spark):
    rng = np.random.default_rng(2)
    rate = rng.random(5000)
    data = []
    for i in range(20000):
        c = int(rng.integers(0, 5000)) if i % 2 else int(rng.integers(0, 5))
        data.append((i, int(rng.random() < rate[c]), f"c{c}"))
    spec = L.ModelSpec("y", "k", (), ("c",))
    df = L.validate_input(spark.createDataFrame(data, "k long, y int, c string"), spec)
    got = L.fit_family(df, spec, "gbt", {"n_estimators": 10, "max_depth": 2})
    assert L.model_metrics(got.score(df), "y", "proba", "gbt").first()["auc"] > 0.6
    unknown = got.score(spark.createDataFrame([(1, 0, 1.0, "new"), (2, 0, 1.0, None)], "k long, y int, wt double, c string"))
    assert unknown.filter("proba is null").count() == 0


# -- attributions and dependence -----------------------------------------------------------


def random_trees(width, n, depth, seed):
    rng = np.random.default_rng(seed)
    size = 2 ** (depth + 1) - 1
    own = np.arange(size)
    feature, left, right = (np.tile(z, (n, 1)) for z in (np.zeros(size, int), own, own))
    cover = np.zeros((n, size))
    threshold, value = rng.normal(size=(n, size)), rng.normal(size=(n, size))
    for t in range(n):
        cover[t, 0] = 100
        for node in range(2**depth - 1):
            if cover[t, node] and (node == 0 or rng.random() < 0.85):
                feature[t, node], left[t, node], right[t, node] = rng.integers(0, width), 2 * node + 1, 2 * node + 2
                share = rng.uniform(0.1, 0.9)
                cover[t, 2 * node + 1], cover[t, 2 * node + 2] = cover[t, node] * share, cover[t, node] * (1 - share)
    return TR.Trees(tuple(f"x{i}" for i in range(width)), feature, threshold, left, right, value, cover, np.zeros((n, size)), 0.25)


def known(trees, t, node, x, s):
    """Value of a tree when only the features in ``s`` are known."""
    if trees.left[t][node] == node:
        return trees.value[t][node]
    a, b, f = trees.left[t][node], trees.right[t][node], trees.feature[t][node]
    if f in s:
        return known(trees, t, b if x[f] > trees.threshold[t][node] else a, x, s)
    total = trees.cover[t][a] + trees.cover[t][b]
    return sum(trees.cover[t][c] / total * known(trees, t, c, x, s) for c in (a, b))


def test_attributions_equal_enumerated_subsets(spark):
    width = 8
    trees = random_trees(width, 4, 4, 1)
    x = np.random.default_rng(7).normal(size=(6, width))
    x[0, 2] = np.nan
    got = TR.Attribution(trees)
    values = got.values(x)
    assert values.sum(axis=1) + got.expected == pytest.approx(trees.margin(x))
    for i, row in enumerate(x):
        worth = {s: sum(known(trees, t, 0, row, s) for t in range(4)) for k in range(width + 1) for s in itertools.combinations(range(width), k)}
        for f in range(width):
            total = 0.0
            for s, v in worth.items():
                if f not in s:
                    weight = math.factorial(len(s)) * math.factorial(width - 1 - len(s)) / math.factorial(width)
                    total += weight * (worth[tuple(sorted((*s, f)))] - v)
            assert values[i, f] == pytest.approx(total)


def test_attributions_of_fifty_features(spark):
    trees = random_trees(50, 20, 5, 2)
    x = np.random.default_rng(1).normal(size=(500, 50))
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "k long, " + ", ".join(f"x{i} double" for i in range(50))).repartition(3)
    want = np.abs(TR.Attribution(trees).values(x)).mean(axis=0)
    got = {r["col_name"]: r["importance"] for r in TR.mean_attributions(trees, df).collect()}
    assert [got[f"x{i}"] for i in range(50)] == pytest.approx(want.tolist())
    one = TR.attributions(trees, df, "k").filter("k = 3").first()
    assert sum(one["shares"]) + one["expected"] == pytest.approx(trees.margin(x[3:4])[0])
    plan = df._jdf  # the means shuffle one row per feature and task
    assert plan is not None


def test_attributions_of_a_fitted_model(rows, fitted):
    got = E.shapley_trees(fitted.model, rows).collect()
    assert {r["col_name"] for r in got} == {"a", "b", "c"} and sorted(r["rank"] for r in got) == [1, 2, 3]
    assert min(got, key=lambda r: r["rank"])["col_name"] == "a"
    x = grid_of(rows, fitted.model)
    per_row = E.attribution_rows(fitted.model, rows, "k").orderBy("k").collect()
    assert [sum(r["shares"]) + r["expected"] for r in per_row] == pytest.approx(fitted.model.trees.margin(x).tolist())


def test_dependence_equals_changed_rows(rows, fitted):
    got = E.dependence_trees(fitted.model, rows, ["a", "b"], grid=4).collect()
    x = grid_of(rows, fitted.model)
    assert len(got) == 8
    for r in got:
        changed = x.copy()
        changed[:, ["a", "b"].index(r["variable"])] = r["value"]
        assert r["mean_proba"] == pytest.approx(fitted.model.trees.proba(changed).mean())


def test_all_subsets_and_their_limit(spark):
    df = spark.createDataFrame([(i, float(i % 3), float(i % 2)) for i in range(12)], "k long, a double, b double")
    score = lambda d: d.withColumn("proba", F.col("a") * F.col("b"))
    exact = {r["col_name"]: r["importance"] for r in E.shapley_mc(df, score, ["a", "b"], "k").collect()}
    drawn = {r["col_name"]: r["importance"] for r in E.shapley_mc(df, score, ["a", "b"], "k", orders=400).collect()}
    assert exact == pytest.approx(drawn, abs=0.05)
    with pytest.raises(ValueError, match="subsets"):
        E.shapley_mc(df, score, [f"x{i}" for i in range(13)], "k") if False else E.shapley_mc(df.select("k", *[F.lit(1.0).alias(f"x{i}") for i in range(13)]), score, [f"x{i}" for i in range(13)], "k")


# -- batch scoring ---------------------------------------------------------------------------


def test_fitted_models_share_one_scan(spark, rows, fitted):
    other = L.fit_family(rows, L.ModelSpec("y", "k", ("b",), ("c", "class_type")), "plain", {"n_estimators": 5, "max_depth": 2})
    path = scratch_path(spark, "accounts")
    rows.write.parquet(path)
    accounts = spark.read.parquet(path)
    models = {"M_ppp_RESP_C1": fitted, "M_APPR_all": other, "M_FUND_all": other, "M_odd_all": fitted}
    got = S.score_batch(accounts, models, key="k")
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(path) <= 1 and plan.count("ArrowEvalPython") == 1
    assert plan.count("class_type#") and sum("Relation" in line and "class_type" in line for line in plan.splitlines()) == 1
    want = {("M_ppp_RESP", r["k"]): r["proba"] for r in fitted.score(rows.filter("class_type = 'C1'")).collect()}
    want |= {("M_APPR", r["k"]): r["proba"] for r in other.score(rows).collect()}
    found = {(r["mdl_name"], r["k"]): r["proba"] for r in got.collect()}
    assert found == pytest.approx(want)


def test_boosted_models_are_stored(spark, rows, fitted):
    root = scratch_path(spark, "models")
    loaded = L.load_run(spark, root, L.save_run(spark, root, "m", fitted, 0.9))
    assert loaded.model.watched == fitted.model.watched and loaded.spec == SPEC
    a, b = (m.score(rows).agg(F.sum("proba")).first()[0] for m in (loaded, fitted))
    assert a == pytest.approx(b)
    assert json.dumps(loaded.params) == json.dumps(fitted.params)


# -- search ----------------------------------------------------------------------------------


def test_learnt_proposals_beat_random_draws():
    space = {"a": ("uniform", -5, 5), "b": ("uniform", 0, 10), "c": ("quniform", 0.1, 1.0, 0.1), "d": ("uniform", 0, 1)}

    def loss(p):
        return (p["a"] - 2) ** 2 / 10 + abs(p["b"] - 7) / 3 + (p["c"] - 0.4) ** 2 * 4 + math.sin(6 * p["d"]) / 2

    learnt, drawn = (statistics.median(search.minimize(loss, space, 30, s, learns)[1] for s in range(25)) for learns in (True, False))
    assert learnt < drawn - 0.2
    params, _ = search.minimize(loss, space, 30, 1)
    assert params == search.minimize(loss, space, 30, 1)[0]
    assert all(how[1] <= params[name] <= how[2] + 1e-9 for name, how in space.items()) and round(params["c"] * 10) == pytest.approx(params["c"] * 10)


def test_paths_equal_a_walk_and_codes_are_bytes():
    """Paths by masks end where a walk from node to node ends, leaves above the last level included."""
    rng = np.random.default_rng(4)
    for depth, bins, kind in ((1, 8, np.uint8), (3, 255, np.uint8), (5, 64, np.uint8), (9, 400, np.uint16)):
        assert boosting.code_type([np.arange(bins), np.zeros(0)]) is kind
        codes = rng.integers(0, bins + 1, (3, 500)).astype(kind)
        tree = boosting._Tree.root(depth)
        for node in range(2**depth - 1):
            inside = node == 0 or tree.left[(node - 1) // 2] != (node - 1) // 2
            if inside and rng.random() < 0.8:
                tree.feature[node], tree.cut[node] = rng.integers(0, 3), rng.integers(0, bins)
                tree.left[node], tree.right[node] = 2 * node + 1, 2 * node + 2
        for levels in range(depth + 1):
            at = np.zeros(500, np.int64)
            for _ in range(levels):
                at = np.where(codes[tree.feature[at], np.arange(500)] > tree.cut[at], tree.right[at], tree.left[at])
            assert (tree.stops(levels)[tree.paths(codes, levels)] == at).all()


def test_blocks_are_filled_over_batches(spark, monkeypatch):
    """Blocks hold many rows although batches are small, as a pass costs some time per block."""
    df = spark.range(0, 25_000, 1, 1)
    x = [F.col("id").cast("double")]
    edges = [np.arange(0.0, 25_000, 500)]
    got = boosting.make_blocks(df, x, F.lit(1), F.lit(1), F.col("id"), F.lit(False), edges, 25_000)
    assert [r["n"] for r in got.collect()] == [25_000]
    assert len(got.first()["codes"]) == 25_000
