"""Registered queries against DuckDB, and the shape of their plans."""

import datetime
import os

import pytest

import __spark_entry__ as entry

duckdb = pytest.importorskip("duckdb")

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
ROW_LEVEL = (
    "cum_weight", "top_fraction", "rank_deciles", "balance_equal",
    "balance_ratio", "stratified_split", "stratified_folds", "random_partitions", "woe_encode",
    "consecutive_partitions", "score_batch", "lemmatize_join", "union_dedupe_keep_first",
)


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return c


def plain(v):
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v + 0.0 if isinstance(v, float) else v


def by_value(rows):
    return sorted((tuple(map(plain, r)) for r in rows), key=lambda r: [(x is None, str(x)) for x in r])


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_sql(spark, sf_dir, con, name):
    df = entry.queries()[name](spark, sf_dir)
    cols = sorted(df.columns)
    got = by_value(df.select(*[f"`{c}`" for c in cols]).collect())
    result = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == cols
    order = [names.index(c) for c in cols]
    assert got == by_value([[r[i] for i in order] for r in result.fetchall()])


def executed_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ROW_LEVEL)
def test_rows_are_not_gathered(spark, sf_dir, name):
    plan = executed_plan(entry.queries()[name](spark, sf_dir))
    for bad in ("SinglePartition", "BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "MapInPandas"):
        assert bad not in plan, plan


def test_scan_is_pruned_and_filtered(spark, sf_dir):
    plan = executed_plan(entry.queries()["filter_segment"](spark, sf_dir))
    assert "EqualTo(o_orderstatus,F)" in plan or "o_orderstatus" in plan.split("PushedFilters")[1]
    assert "lineitem" not in plan and "o_orderdate" not in plan.split("ReadSchema")[1]


def test_entry_has_ten_deciles(spark):
    if not os.path.isdir("/root/testdata/sf0.001"):
        pytest.skip("no test tables")
    df = entry.entry(spark)
    assert [r["decile"] for r in df.orderBy("decile").collect()] == list(range(1, 11))


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
