"""Reader, writer and table queries. Each writes a whole test table and reads it back."""

from __future__ import annotations

import uuid
from pathlib import Path

from pyspark.sql import functions as F
from pyspark.sql import types as T

from reachmark.plans.registry import query
from reachmark.plans.views import campaign, names, table, with_views
from reachmark.runtime import scratch_path
from reachmark.sources import readers as R
from reachmark.sources import tables as W

SCRIPTS = Path(__file__).parent / "scripts"


def _name(label: str) -> str:
    return f"rm_{label}_{uuid.uuid4().hex[:12]}"


@query("scan_csv", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def scan_csv(spark, sf_dir):
    path = scratch_path(spark, "csv")
    df = table(spark, sf_dir, "customer")
    df.toDF(*[c.upper() for c in df.columns]).write.option("header", True).csv(path)
    return R.read_csv(spark, path, schema=df.schema)


@query("scan_txt", "SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def scan_txt(spark, sf_dir):
    path = scratch_path(spark, "txt")
    df = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    df.write.option("header", True).option("sep", "\t").csv(path)
    return R.read_txt(spark, path, sep="\t", schema=df.schema)


@query("scan_vendor_extract", with_views("names", "SELECT CAST(name_id AS VARCHAR) AS duns, business_name, sic_8 FROM names"))
def scan_vendor_extract(spark, sf_dir):
    path = scratch_path(spark, "vendor")
    wide = names(spark, sf_dir).select(
        F.col("name_id").alias("Duns Number"),
        F.lit("x").alias("Unused"),
        F.col("business_name").alias("Business Name"),
        F.col("sic_8").alias("Primary SIC 8 Digit"),
    )
    wide.write.option("header", True).option("sep", "|").option("encoding", "ISO-8859-1").option("quote", "").csv(path)
    columns = {"Duns Number": "duns", "Business Name": "business_name", "Primary SIC 8 Digit": "sic_8"}
    return R.read_vendor_extract(spark, path, columns)


@query("sql_script_params", "SELECT o_orderpriority, CAST(COUNT(*) AS BIGINT) AS cnt, MAX(o_totalprice) AS best FROM orders WHERE o_totalprice >= 1000 AND o_orderstatus <> 'P' GROUP BY o_orderpriority")
def sql_script_params(spark, sf_dir):
    params = {"min_price": 1000.0, "status": "P"}
    return R.read_script(spark, str(SCRIPTS / "priority_totals.sql"), params, {"orders": table(spark, sf_dir, "orders")})


@query("sql_multi_statement", "SELECT c_mktsegment || ';' AS tag, CAST(COUNT(*) AS BIGINT) AS cnt, MAX(c_acctbal) AS best FROM customer GROUP BY 1")
def sql_multi_statement(spark, sf_dir):
    source = _name("customer")
    table(spark, sf_dir, "customer").createOrReplaceTempView(source)
    R.execute_script(spark, str(SCRIPTS / "segment_views.sql"), {"source": source})
    return spark.table("rm_segment_totals")


@query("scan_table_project", "SELECT o_orderkey, o_totalprice FROM orders")
def scan_table_project(spark, sf_dir):
    name = _name("orders")
    W.append_table(table(spark, sf_dir, "orders"), name, scratch_path(spark, name))
    return W.read_table(spark, name, ["o_orderkey", "not_there", "o_totalprice"]).orderBy("o_orderkey")


@query("sink_autocreate", "SELECT * FROM supplier UNION ALL SELECT * FROM supplier")
def sink_autocreate(spark, sf_dir):
    name = _name("supplier")
    path = scratch_path(spark, name)
    for _ in range(2):
        W.append_table(table(spark, sf_dir, "supplier"), name, path)
    return spark.table(name)


@query("sink_parquet", "SELECT * FROM customer")
def sink_parquet(spark, sf_dir):
    root = scratch_path(spark, "archive")
    path = W.write_archive_file(table(spark, sf_dir, "customer"), root, "2024-01", "customer", "gzip")
    return spark.read.parquet(path)


@query("sink_partitioned", with_views("campaign", "SELECT account_id, fund_amt, load_year, load_month FROM campaign"))
def sink_partitioned(spark, sf_dir):
    name = _name("campaign")
    df = campaign(spark, sf_dir, "account_id", "fund_amt", "load_year", "load_month")
    W.write_partitioned(df, name, path=scratch_path(spark, name))
    return spark.table(name)


@query("bulk_insert_df", "SELECT p_partkey, p_name, p_retailprice FROM part")
def bulk_insert_df(spark, sf_dir):
    name = _name("part")
    df = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    W.create_table(spark, name, df.schema, scratch_path(spark, name))
    W.insert_df(df.select("p_retailprice", "p_partkey", "p_name"), name)
    return spark.table(name)


@query("bulk_insert_file", "SELECT n_nationkey, n_name, n_regionkey FROM nation WHERE n_nationkey >= 4")
def bulk_insert_file(spark, sf_dir):
    name, path = _name("nation"), scratch_path(spark, "nation")
    df = table(spark, sf_dir, "nation")
    # One file with a header; data from its sixth row on.
    df.coalesce(1).sortWithinPartitions("n_nationkey").write.option("header", True).option("sep", "|").csv(path)
    W.create_table(spark, name, df.schema, scratch_path(spark, name))
    W.insert_file(spark, name, path, "|", first_row=6)
    return spark.table(name)


@query("copy_into_by_name", "SELECT c_custkey, c_name, c_acctbal, CAST(NULL AS VARCHAR) AS note FROM customer")
def copy_into_by_name(spark, sf_dir):
    name, path = _name("customer"), scratch_path(spark, "customer")
    df = table(spark, sf_dir, "customer")
    df.select(F.col("c_acctbal").alias("C_ACCTBAL"), F.col("c_name").alias("C_Name"), "c_custkey", "c_nationkey").write.parquet(path)
    schema = T.StructType([df.schema["c_custkey"], df.schema["c_name"], df.schema["c_acctbal"], T.StructField("note", T.StringType())])
    W.create_table(spark, name, schema, scratch_path(spark, name))
    W.copy_file_into(spark, name, path, "parquet")
    return spark.table(name)


@query(
    "archive_snapshot",
    """SELECT s_suppkey, s_name, s_acctbal, '2024-01' AS month, 's' AS source FROM supplier
 UNION ALL SELECT s_suppkey, s_name, s_acctbal, '2024-02', 's' FROM supplier WHERE s_suppkey % 2 = 0
 UNION ALL SELECT s_suppkey, s_name, s_acctbal, '2024-03', 's' FROM supplier UNION ALL SELECT s_suppkey, s_name, s_acctbal, '2024-03', 's' FROM supplier""",
)
def archive_snapshot(spark, sf_dir):
    name = _name("archive")
    path = scratch_path(spark, name)
    staging = table(spark, sf_dir, "supplier")

    def keep(rows, month, overwrite):
        W.archive_table(spark, rows, name, {"month": month, "source": "s"}, overwrite, ["s_nationkey"], path=path)

    keep(staging, "2024-01", False)
    keep(staging, "2024-02", True)
    keep(staging.filter("s_suppkey % 2 = 0"), "2024-02", True)
    keep(staging, "2024-03", False)
    keep(staging, "2024-03", False)
    return spark.table(name)


@query("row_count", "SELECT CAST(COUNT(*) AS BIGINT) AS n FROM lineitem")
def row_count(spark, sf_dir):
    n = W.row_count(spark, table(spark, sf_dir, "lineitem"), assert_count=lambda x: x > 0)
    return spark.createDataFrame([(n,)], "n long")
