import pytest
from pyspark.sql import functions as F

from reachmark.operators import arms as A
from reachmark.operators import sampling as B


def accounts(spark, n=400, rare=10, partitions=4):
    df = spark.range(n).withColumnRenamed("id", "k").repartition(partitions)
    return df.withColumn("y", (F.col("k") % rare == 0).cast("int"))


def by_class(df):
    return {r["y"]: r["count"] for r in df.groupBy("y").count().collect()}


@pytest.mark.parametrize("kind,majority", [("balanced", 40), ("ratio1_2", 80), ("ratio1_25", 100), ("ratio1_5", 200)])
def test_balance_sizes(spark, kind, majority):
    got = B.balance(accounts(spark), "y", kind, "k")
    assert by_class(got) == {1: 40, 0: majority}
    assert {r["wt"] for r in got.select("wt").distinct().collect()} == {1}


def test_balance_is_the_same_for_any_partitioning(spark):
    picks = [
        {r["k"] for r in B.balance(accounts(spark, partitions=p), "y", "ratio1_3", "k").collect()}
        for p in (1, 4, 32)
    ]
    assert picks[0] == picks[1] == picks[2]
    other = {r["k"] for r in B.balance(accounts(spark), "y", "ratio1_3", "k", seed=2).collect()}
    assert other != picks[0]


def test_balance_errors(spark):
    df = accounts(spark)
    with pytest.raises(ValueError):
        B.balance(df, "y", "ratio1_10", "k")  # 400 wanted of 360
    with pytest.raises(ValueError):
        B.balance(df, "y", "half", "k")
    with pytest.raises(ValueError):
        B.balance(df, None, "balanced", "k")
    with pytest.raises(ValueError):
        B.balance(df.filter("y = 0"), "y", "weighted", "k")


def test_weights_even_out_the_classes(spark):
    got = B.balance(accounts(spark), "y", "ratio1_2_weighted", "k").groupBy("y").agg(F.sum("wt").alias("w"))
    sums = {r["y"]: r["w"] for r in got.collect()}
    assert sums[0] == pytest.approx(sums[1])
    assert {r["wt"] for r in B.balance(accounts(spark), None, None, "k").collect()} == {1}


def test_split_and_folds(spark):
    df = accounts(spark, 403)
    train, test = B.stratified_split(df, "k", 0.2, "y")
    assert by_class(test) == {1: 8, 0: 72}
    assert train.count() + test.count() == 403
    assert train.join(test, "k").count() == 0
    whole_train, whole_test = B.stratified_split(df, "k", 0.1)
    assert whole_test.count() == 40 and whole_train.count() == 363
    folds = B.stratified_folds(df, "k", 3, "y").groupBy("y", "fold").count().collect()
    for label in (0, 1):
        sizes = [r["count"] for r in folds if r["y"] == label]
        assert len(sizes) == 3 and max(sizes) - min(sizes) <= 1


def test_random_arms(spark):
    df = accounts(spark, 2000)
    got = A.random_arms(df, "k", {1: 0.7, 2: 0.3})
    shares = {r["arm"]: r["share"] for r in A.arm_shares(got, "arm").collect()}
    assert abs(shares[1] - 0.7) < 0.05
    assert got.collect() == A.random_arms(df, "k", {1: 0.7, 2: 0.3}).collect()
    with pytest.raises(ValueError):
        A.random_arms(df.limit(3), "k", {1: 0.5, 2: 0.5})
    with pytest.raises(ValueError):
        A.random_arms(df, "k", {1: 0.7, 2: 0.7})
    assert {r["arm"] for r in A.random_arms(df, "k", 1).collect()} == {0}


def test_consecutive_arms(spark):
    df = accounts(spark, 100).withColumn("v", -F.col("k"))
    got = A.consecutive_arms(df, "k", 3, ["v"], offset=1).orderBy("v").collect()
    assert [r["arm"] for r in got] == [(i + 1) % 3 for i in range(100)]
    with pytest.raises(NotImplementedError):
        A.consecutive_arms(df, "k", {0: 0.5, 1: 0.5}, ["v"])
    assert A.consecutive_arms(df, "k", 1, ["v"]).filter("arm <> 0").count() == 0


def brute_u(x, y):
    u = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a in x for b in y)
    return max(u, len(x) * len(y) - u)


def test_mann_whitney(spark):
    rows = [(i, i % 3, float((i * 7) % 11), float(i)) for i in range(60)]
    df = spark.createDataFrame(rows, "k long, arm int, a double, b double").repartition(5)
    got = {(r["arm_a"], r["arm_b"], r["field"]): r for r in A.check_fairness(df, "arm", ["a", "b"]).collect()}
    assert len(got) == 6
    for (p, q, f), r in got.items():
        col = 2 if f == "a" else 3
        x = [t[col] for t in rows if t[1] == p]
        y = [t[col] for t in rows if t[1] == q]
        assert r["u"] == pytest.approx(brute_u(x, y))
        assert 0 < r["p_value"] <= 1 and not r["unfair"]


def test_mann_whitney_flags_and_nulls(spark):
    rows = [(i, i // 50, float(i), None if i == 3 else 1.0) for i in range(100)]
    df = spark.createDataFrame(rows, "k long, arm int, a double, b double")
    got = {r["field"]: r for r in A.check_fairness(df, "arm", ["a", "b"]).collect()}
    assert got["a"]["unfair"] and got["a"]["p_value"] < 1e-10
    assert got["b"]["z"] is None and not got["b"]["unfair"]


def test_share_distance(spark):
    def shares(*xs):
        return spark.createDataFrame([(float(x),) for x in xs], "share double")

    # Equal lengths: mean distance of the sorted shares; unequal: area between the steps.
    assert A.pmf_distance(shares(0.5, 0.3, 0.2), shares(0.2, 0.4, 0.4)).first()[0] == pytest.approx(0.2 / 3)
    assert A.pmf_distance(shares(1.0), shares(0.5, 0.5)).first()[0] == pytest.approx(0.5)
    assert A.pmf_distance(shares(0.5, 0.5), shares(0.5, 0.5)).first()[0] == 0
    assert A.is_uniform(shares(0.34, 0.33, 0.33), 0.03)
    assert not A.is_uniform(shares(0.8, 0.2), 0.03)
    assert A.is_uniform(shares(1.0), 0.03)
    with pytest.raises(ValueError):
        A.same_prob_mass(shares(0.5), shares(1.0), 0.03)


def test_balance_takes_a_short_class_whole(spark, tmp_path):
    """Twice the smaller class is more than the larger one has: the query takes all rows, as its SQL does."""
    import duckdb

    from __spark_entry__ import oracle_sql, queries

    df = accounts(spark)
    assert by_class(B.balance(df, "y", "ratio1_10", "k", short=True)) == {1: 40, 0: 360}
    assert by_class(B.balance(df, "y", "ratio1_5", "k", short=True)) == {1: 40, 0: 200}
    con = duckdb.connect()
    for t in ("customer", "nation", "region", "lineitem"):
        con.execute(f"copy (select * from '/root/testdata/sf0.001/{t}.parquet') to '{tmp_path}/{t}.parquet' (format parquet)")
        con.execute(f"create view {t} as from '{tmp_path}/{t}.parquet'")
    status = "case when o_orderkey % 5 < 2 then 'F' else 'O' end as o_orderstatus"
    con.execute(f"copy (select * replace ({status}) from '/root/testdata/sf0.001/orders.parquet') to '{tmp_path}/orders.parquet' (format parquet)")
    con.execute(f"create view orders as from '{tmp_path}/orders.parquet'")
    got = [tuple(r) for r in queries()["balance_ratio"](spark, str(tmp_path)).collect()]
    assert len(got) == 1500
    assert sorted(got) == sorted(con.execute(oracle_sql()["balance_ratio"]).fetchall())
