import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reachmark.runtime import scratch_path
from reachmark.sources import readers as R
from reachmark.sources import tables as W


def test_csv_headers_and_types(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("DUNS,Name\n1,x\n2,\n")
    df = R.read_csv(spark, str(path))
    assert df.columns == ["duns", "name"] and dict(df.dtypes)["duns"] == "int"
    assert [r["name"] for r in df.orderBy("duns").collect()] == ["x", None]


VENDOR = 'Duns Number|Extra|Business Name|Primary SIC 8 Digit\n001|x|Caf\xe9 "A|12345678\n002|y||00010000\n'
COLUMNS = {"Duns Number": "duns", "Business Name": "business_name", "Primary SIC 8 Digit": "sic_8"}


def test_vendor_extract_plain_and_zipped(spark, tmp_path):
    plain = tmp_path / "v.txt"
    plain.write_bytes(VENDOR.encode("latin-1"))
    packed = tmp_path / "v.zip"
    with zipfile.ZipFile(packed, "w") as z:
        z.writestr("v.txt", VENDOR.encode("latin-1"))
    want = [("001", 'Caf\xe9 "A', "12345678"), ("002", None, "00010000")]
    for path in (plain, packed):
        rows = R.read_vendor_extract(spark, str(path), COLUMNS).orderBy("duns").collect()
        assert [tuple(r) for r in rows] == want


def test_union_keeps_the_first_file(spark):
    a = spark.createDataFrame([(1, "a2"), (1, "a1"), (None, "a0")], "k int, v string")
    b = spark.createDataFrame([(1, "b"), (2, "b")], "k int, v string")
    got = {r["k"]: r["v"] for r in R.union_keep_first([a, b], ["k"]).collect()}
    assert got == {1: "a1", 2: "b"}


def test_statement_splitter():
    text = "-- a; b\nSELECT ';' AS x, \"q;\", `c;d` ; /* x; */ SELECT 2 - 1 / 1;\n\n;"
    assert R.split_statements(text) == ["SELECT ';' AS x, \"q;\", `c;d`", "SELECT 2 - 1 / 1"]
    assert R.split_statements("SELECT 'it''s; ok'") == ["SELECT 'it''s; ok'"]


def test_scripts(spark, tmp_path):
    path = tmp_path / "s.sql"
    path.write_text("SELECT :a + 1 AS x FROM {t} WHERE v = :b")
    t = spark.createDataFrame([("k;",), ("z",)], "v string")
    assert R.read_script(spark, str(path), {"a": 2, "b": "k;"}, {"t": t}).collect()[0]["x"] == 3
    with pytest.raises(ValueError):
        R.read_script(spark, str(tmp_path / "none.sql"))


@pytest.fixture
def staged(spark):
    name = f"staged_{scratch_path(spark, 't')[-8:]}"
    df = spark.createDataFrame([(1, "a", 9), (2, "b", 9)], "id int, v string, junk int")
    W.append_table(df, name)
    yield name
    W.drop_table(spark, name)


def test_table_checks(spark, staged):
    assert W.table_exists(spark, staged) and W.row_count(spark, staged) == 2
    with pytest.raises(ValueError):
        W.row_count(spark, staged, assert_count=lambda n: n > 5)
    with pytest.raises(ValueError):
        W.as_df(spark, "a.b")
    with pytest.raises(ValueError):
        W.as_df(spark, "missing_table")
    with pytest.raises(ValueError):
        W.as_df(spark, 5)
    with pytest.raises(ValueError):
        W.table_exists(spark, 5)
    assert W.read_table(spark, staged, ["v", "zzz"]).columns == ["v"]
    assert W.row_count(spark, spark.table(staged).filter("id = 1")) == 1


def test_delete_and_drop(spark, staged):
    assert W.delete_all_rows(spark, staged) == 2
    assert W.row_count(spark, staged) == 0
    assert W.drop_table(spark, staged) and not W.drop_table(spark, staged)


def test_insert_by_name_and_file(spark, staged, tmp_path):
    W.insert_df(spark.createDataFrame([("c", 3)], "V string, Id int"), staged)
    row = spark.table(staged).filter("id = 3").first()
    assert (row["v"], row["junk"]) == ("c", None)
    for first, text in ((1, "4|d|1\n"), (2, "id|v|junk\n5|e|1\n"), (4, "x\ny\nid|v|junk\n6|f|1\n7|g|1\n")):
        path = tmp_path / f"f{first}.txt"
        path.write_text(text)
        W.insert_file(spark, staged, str(path), "|", first_row=first)
    assert {r["id"] for r in spark.table(staged).collect()} == {1, 2, 3, 4, 5, 6, 7}
    with pytest.raises(ValueError):
        W.insert_df(spark.table(staged), "missing_table")


def months(spark, name):
    return {tuple(r) for r in spark.table(name).groupBy("month", "id").count().collect()}


@pytest.mark.parametrize("overwrite", [True, False])
def test_archive_twice(spark, staged, overwrite):
    name = f"archive_{staged}_{overwrite}".lower()
    path = scratch_path(spark, name)

    def run(month):
        return W.archive_table(spark, staged, name, {"month": month}, overwrite, ["junk"], path=path)

    assert run("m1") == 0 and run("m2") == 0
    assert run("m1") == 2
    n = 1 if overwrite else 2
    assert months(spark, name) == {("m1", 1, n), ("m1", 2, n), ("m2", 1, 1), ("m2", 2, 1)}
    assert "junk" not in spark.table(name).columns
    empty = spark.table(staged).filter("id < 0")
    W.archive_table(spark, empty, name, {"month": "m2"}, overwrite, ["junk"])
    assert ("m2", 1, 1) in months(spark, name) or overwrite
    if overwrite:
        assert {m for m, _, _ in months(spark, name)} == {"m1"}
    W.drop_table(spark, name)


@pytest.mark.parametrize("overwrite", [True, False])
def test_archive_of_another_layout(spark, staged, overwrite):
    name = f"flat_{staged}_{overwrite}".lower()
    schema = T.StructType([T.StructField("month", T.StringType()), T.StructField("id", T.IntegerType())])
    W.create_table(spark, name, schema, scratch_path(spark, name))
    for month in ("m1", "m2", "m1"):
        stale = W.archive_table(spark, staged, name, {"month": month}, overwrite, ["junk", "v"])
    assert stale == 2
    n = 1 if overwrite else 2
    assert months(spark, name) == {("m1", 1, n), ("m1", 2, n), ("m2", 1, 1), ("m2", 2, 1)}
    W.drop_table(spark, name)


def test_rows_are_skipped_in_every_file(spark, staged, tmp_path):
    for i in range(40):
        (tmp_path / f"p{i}.txt").write_text(f"x\n\n{i}|h|1\n\n{i}|h|2\n{i}|h|3\n")
    W.delete_all_rows(spark, staged)
    W.insert_file(spark, staged, str(tmp_path), "|", first_row=3)
    rows = spark.table(staged)
    assert rows.count() == 120 and rows.filter("v is null").count() == 0
    assert {r["n"] for r in rows.groupBy("id").agg(F.count("*").alias("n")).collect()} == {3}


def test_lines_are_numbered_over_blocks(spark, staged, tmp_path):
    """Rows to skip reach far beyond the first block of a file."""
    big = tmp_path / "big.txt"
    big.write_text("".join(f"{i}|{'v' * (i % 90)}|{i % 7}\n" for i in range(1, 20_001)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        lines = W.numbered_lines(spark, str(big))
        assert lines.filter(F.col("line_no") != F.split("line", r"\|")[0].cast("long")).count() == 0
        assert lines.count() == 20_000
        W.delete_all_rows(spark, staged)
        W.insert_file(spark, staged, str(big), "|", first_row=15_001)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    got = spark.table(staged).agg(F.min("id"), F.max("id"), F.count("id")).first()
    assert tuple(got) == (15_001, 20_000, 5_000)


@pytest.mark.parametrize("flat", [True, False])
def test_a_failed_replacement_keeps_the_old_rows(spark, staged, flat):
    name = f"safe_{staged}_{flat}".lower()
    if flat:
        schema = T.StructType([T.StructField("month", T.StringType()), T.StructField("id", T.IntegerType())])
        W.create_table(spark, name, schema, scratch_path(spark, name))
    W.archive_table(spark, staged, name, {"month": "m1"}, ignore=["junk", "v"])
    W.archive_table(spark, staged, name, {"month": "m2"}, ignore=["junk", "v"])
    broken = spark.table(staged).withColumn("id", F.when(F.col("id") > 1, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        W.archive_table(spark, broken, name, {"month": "m1"}, True, ["junk", "v"])
    want = {("m1", 1, 1), ("m1", 2, 1), ("m2", 1, 1), ("m2", 2, 1)}
    assert months(spark, name) == want
    fresh = spark.table(staged).filter("id = 2")
    for _ in range(2):
        assert W.archive_table(spark, fresh, name, {"month": "m1"}, True, ["junk", "v"]) > 0
        assert months(spark, name) == want - {("m1", 1, 1)}
    W.archive_table(spark, staged, name, {"month": "m3"}, True, ["junk", "v"])
    assert ("m3", 1, 1) in months(spark, name)
    W.drop_table(spark, name)


def test_archive_must_exist(spark, staged):
    with pytest.raises(ValueError):
        W.archive_table(spark, staged, "no_archive", {"m": 1}, create=False)


def test_partitioned_write_prunes(spark):
    df = spark.range(100).select("id", (F.col("id") % 2 + 2000).cast("int").alias("load_year"), F.lit(1).alias("load_month"))
    name = "partitioned_by_month"
    W.write_partitioned(df, name, path=scratch_path(spark, name))
    assert spark.table(name).count() == 100
    plan = spark.table(name).filter("load_year = 2001")._jdf.queryExecution().executedPlan().toString()
    assert "load_year" in plan.split("PartitionFilters")[1].split("]")[0]
    W.drop_table(spark, name)
    W.write_partitioned(df.drop("load_month"), name, path=scratch_path(spark, name))
    assert spark.catalog.listColumns(name)[0].isPartition is False
    W.drop_table(spark, name)


def test_create_table(spark):
    schema = T.StructType([T.StructField("a", T.IntegerType())])
    W.create_table(spark, "made_empty", schema)
    assert spark.table("made_empty").count() == 0
    W.drop_table(spark, "made_empty")
