import math
import random
import re

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reachmark.operators import ordering
from reachmark.operators.ordering import (
    Measure,
    OrderIndex,
    Splits,
    average_ranks,
    exact_quantiles,
    quantile_splits,
    running_by_value,
)


def frame(spark, scores, weights=None, partitions=4):
    rows = [(i, s, (weights or [1] * len(scores))[i]) for i, s in enumerate(scores)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "k long, s double, w long").repartition(partitions)


def skewed(n):
    """A third of the rows share one score; some have none."""
    rng = random.Random(5)
    return [0.5 if i % 3 == 0 else None if i % 17 == 0 else round(rng.random(), 2) for i in range(n)]


def expected(scores, weights=None, ascending=True):
    pdf = pd.DataFrame({"k": range(len(scores)), "s": scores, "w": weights or 1})
    pdf["s"] = pdf["s"].astype(float)
    pdf = pdf.sort_values(["s", "k"], ascending=[ascending, True], na_position="last", kind="stable")
    pdf["rank"] = range(1, len(pdf) + 1)
    pdf["run"] = pdf["w"].cumsum()
    return pdf.set_index("k")


@pytest.mark.parametrize("partitions", [1, 4, 32])
@pytest.mark.parametrize("ascending", [True, False])
def test_positions_match_a_full_sort(spark, partitions, ascending):
    scores, weights = skewed(500), [1 + i % 4 for i in range(500)]
    df = frame(spark, scores, weights, partitions)
    index = OrderIndex.fit(df, [("s", ascending)], "k", weight="w", buckets=8)
    got = index.positions(df, rank="rank", running="run").toPandas().set_index("k")
    want = expected(scores, weights, ascending)
    assert (got["rank"].sort_index() == want["rank"].sort_index()).all()
    assert (got["run"].sort_index() == want["run"].sort_index()).all()


@pytest.mark.parametrize("ascending", [True, False])
def test_nan_and_infinite_scores(spark, ascending):
    scores = [math.nan if i % 5 == 0 else math.inf if i % 7 == 0 else -math.inf if i % 11 == 0 else i / 10 for i in range(300)]
    df = frame(spark, scores)
    index = OrderIndex.fit(df, [("s", ascending)], "k", buckets=8)
    got = index.positions(df, rank="rank").toPandas().set_index("k")
    want = expected(scores, ascending=ascending)
    assert (got["rank"].sort_index() == want["rank"].sort_index()).all()
    present = [s for s in scores if not math.isnan(s)]
    assert exact_quantiles(df, ["s"], [0.5])["s"][0] == pytest.approx(np.quantile(present, 0.5))


def test_edges_are_merged_from_few_sketches(spark):
    df = frame(spark, skewed(400), partitions=300)
    edges = quantile_splits(df, [F.col("s"), F.lit(None).cast("double")], 10)
    assert 0.5 in edges[0].points and edges[1].points == (-math.inf, 0.0, math.inf)


def test_a_hot_value_is_split_by_key(spark):
    df = frame(spark, [0.5] * 900 + [i / 1000 for i in range(100)])
    index = OrderIndex.fit(df, [("s", True)], "k", buckets=20)
    assert max(r["_rows"] for r in index.totals) <= 0.2 * 1000
    assert index.row_count() == 1000


def test_two_sort_columns_and_text_key(spark):
    rows = [(f"k{i}", float(i % 2), i % 5) for i in range(200)]
    df = spark.createDataFrame(rows, "k string, a double, b int").repartition(3)
    index = OrderIndex.fit(df, [("a", True), ("b", False)], "k", buckets=8)
    got = index.positions(df, rank="rank").orderBy("rank").collect()
    assert [(r["a"], -r["b"]) for r in got] == sorted((a, -b) for _, a, b in rows)
    assert [r["rank"] for r in got] == list(range(1, 201))


@pytest.mark.parametrize("size", [0, 1, 7, 250, 499, 500])
def test_top_takes_exactly_the_first_rows(spark, size):
    scores = skewed(500)
    df = frame(spark, scores)
    got = OrderIndex.fit(df, [("s", False)], "k", buckets=8).top(df, size)
    want = expected(scores, ascending=False)
    assert {r["k"] for r in got.collect()} == set(want.index[want["rank"] <= size])


def test_slice_and_mark(spark):
    scores = skewed(300)
    df = frame(spark, scores)
    index = OrderIndex.fit(df, [("s", True)], "k", buckets=8)
    want = expected(scores)
    got = {r["k"] for r in index.slice(df, 40, 130).collect()}
    assert got == set(want.index[want["rank"].between(41, 130)])
    marked = {r["k"] for r in index.mark(df, 77, "m").filter("m").collect()}
    assert marked == set(want.index[want["rank"] <= 77])
    assert index.mark(df, 77, "m").count() == 300


@pytest.mark.parametrize("n", [1, 2, 9, 10, 11, 57, 300])
def test_bins_follow_the_rank_formula(spark, n):
    scores = skewed(n)
    df = frame(spark, scores)
    index = OrderIndex.fit(df, [("s", True)], "k", buckets=8)
    got = {r["k"]: r["bin"] for r in index.bins(df, 10).collect()}
    for k, r in expected(scores)["rank"].items():
        assert got[k] == (1 if n == 1 else max(1, math.ceil(10 * (r - 1) / (n - 1))))


def test_summary_equals_grouped_bins(spark):
    scores, weights = skewed(400), [1 + (i * i) % 7 for i in range(400)]
    df = frame(spark, scores, weights)
    measures = [Measure("n", "count"), Measure("hi", "max", F.col("s")), Measure("w", "sum", F.col("w"))]
    index = OrderIndex.fit(df, [("s", False)], "k", weight="w", measures=measures, buckets=8)
    a = index.summarize(df, 10, measures).toPandas().sort_values("bin").reset_index(drop=True)
    rows = index.bins(df, 10).groupBy("bin").agg(*[m.over_rows() for m in measures])
    b = rows.toPandas().sort_values("bin").reset_index(drop=True)
    pd.testing.assert_frame_equal(a, b, check_dtype=False)


def test_one_huge_weight_leaves_bins_empty(spark):
    df = frame(spark, [0.9, 0.8, 0.7, 0.6], [1, 1000, 1, 1])
    index = OrderIndex.fit(df, [("s", False)], "k", weight="w")
    assert sorted(r["bin"] for r in index.bins(df, 10).collect()) == [1, 10, 10, 10]


def test_empty_frame(spark):
    df = frame(spark, [0.1]).filter("k < 0")
    index = OrderIndex.fit(df, [("s", True)], "k")
    assert index.row_count() == 0
    assert index.positions(df, rank="r").count() == 0
    assert index.bins(df, 10).count() == 0
    assert exact_quantiles(df, ["s"], [0.5]) == {"s": []}


values = st.lists(
    st.one_of(st.none(), st.floats(-50, 50, width=16), st.sampled_from([0.0, 1.0])),
    min_size=1,
    max_size=60,
)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(values)
def test_quantiles_match_numpy(spark, xs):
    df = spark.createDataFrame([(x,) for x in xs], "x double").repartition(3)
    probs = [0, 0.1, 0.25, 0.5, 0.9, 1]
    got = exact_quantiles(df, ["x"], probs, buckets=6)["x"]
    present = [x for x in xs if x is not None]
    if not present:
        assert got == []
    else:
        np.testing.assert_allclose(got, np.quantile(present, probs), rtol=1e-12, atol=1e-12)


def test_quantiles_of_several_columns(spark):
    rows = [(float(i % 10), float(i) if i % 4 else None, None) for i in range(1000)]
    df = spark.createDataFrame(rows, "a double, b double, c double").repartition(7)
    got = exact_quantiles(df, ["a", "b", "c"], [0.05, 0.5, 0.95], buckets=16)
    pdf = pd.DataFrame(rows, columns=["a", "b", "c"])
    for c in ("a", "b"):
        np.testing.assert_allclose(got[c], pdf[c].astype(float).quantile([0.05, 0.5, 0.95]))
    assert got["c"] == []


def test_average_ranks_match_pandas(spark):
    rows = [(i, float(i % 7), 3.0 if i % 3 else float(i)) for i in range(400)]
    df = spark.createDataFrame(rows, "k long, a double, b double").repartition(5)
    got = average_ranks(df, ["a", "b"], "k", buckets=8).toPandas().set_index("k").sort_index()
    want = pd.DataFrame(rows, columns=["k", "a", "b"]).set_index("k").rank()
    pd.testing.assert_frame_equal(got, want)


def test_running_by_value(spark):
    df = frame(spark, skewed(300)).filter("s is not null")
    rows, total = running_by_value(df, "s", False, {"n": F.lit(1)}, buckets=8)
    got = rows.toPandas()
    assert total == {"n": df.count()}
    want = df.toPandas().groupby("s").size().sort_index(ascending=False).cumsum()
    assert got.set_index("s")["n_run"].to_dict() == want.to_dict()


def test_splits_isolate_repeated_values():
    s = Splits.from_quantiles([1.0, 2.0, 2.0, 2.0, 3.0])
    assert s.locate(2.0) in s.heavy
    assert s.locate(math.nextafter(2.0, 3)) not in s.heavy
    assert s.value_of(s.locate(2.0)) == 2.0


def test_rank_tasks_grow_with_the_rows(spark, monkeypatch):
    monkeypatch.setattr(ordering, "RANK_ROWS", 100)
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"k": range(600), "a": rng.normal(size=600), "b": rng.integers(0, 5, 600)})
    pdf.loc[:9, "a"] = None
    df = spark.createDataFrame(pdf)
    ranks = ordering.average_ranks(df, ["a", "b"], "k")
    plan = ranks._jdf.queryExecution().optimizedPlan().toString()
    assert [int(n) for n in re.findall(r"RepartitionByExpression \[\w+#\w+(?:, \w+#\w+)*\], (\d+)", plan)] == [12, 12]
    assert plan.index("Aggregate") < plan.index("RepartitionByExpression")  # no task holds all keys before
    got = ranks.toPandas().sort_values("k")
    for c in ("a", "b"):
        assert np.allclose(got[c], pdf[c].rank(), equal_nan=True)
    assert ordering.average_ranks(df.limit(0), ["a", "b"], "k").count() == 0
