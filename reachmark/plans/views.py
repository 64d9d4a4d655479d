"""Campaign-shaped views over the test tables, in Spark and as SQL for the checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reachmark.runtime import materialize

# Campaign columns that need more than the orders table.
_LINE_COLUMNS = {"x_qty", "x_lines", "x_disc"}
_REGION_COLUMNS = {"region"}
_CUSTOMER_COLUMNS = {"market_segment", "x_bal", "x_sparse"} | _REGION_COLUMNS

_SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; its schema is read from the file once."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def campaign(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    """One row per mailed account: funnel flags, amounts, scores and features.

    Customers, regions and summed order lines are left-joined on unique keys, and only
    when one of their columns is asked for: leaving them out keeps the rows.
    """
    wanted = set(cols) or _LINE_COLUMNS | _CUSTOMER_COLUMNS
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    b = table(spark, sf_dir, "orders")
    none = F.lit(None)
    if wanted & _CUSTOMER_COLUMNS:
        customer = table(spark, sf_dir, "customer")
        b = b.join(customer, b.o_custkey == customer.c_custkey, "left")
    else:
        b = b.withColumns({"c_acctbal": none.cast("double"), "c_mktsegment": none.cast("string")})
    if wanted & _REGION_COLUMNS:
        nation = table(spark, sf_dir, "nation")
        region = table(spark, sf_dir, "region")
        b = b.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").join(
            region, F.col("n_regionkey") == F.col("r_regionkey"), "left"
        )
    else:
        b = b.withColumn("r_name", none.cast("string"))
    if wanted & _LINE_COLUMNS:
        li = (
            table(spark, sf_dir, "lineitem")
            .groupBy("l_orderkey")
            .agg(
                F.count(F.lit(1)).alias("n_lines"),
                F.sum(F.col("l_quantity").cast("long")).alias("qty"),
                F.max("l_discount").alias("max_disc"),
            )
        )
        b = b.join(li, key == F.col("l_orderkey"), "left")
    else:
        b = b.withColumns(
            {"n_lines": none.cast("long"), "qty": none.cast("long"), "max_disc": none.cast("double")}
        )
    h = (key * 7919 + 13) % 9973
    stage1 = F.col("o_orderstatus") == "F"
    stage2 = stage1 & (key % 5 != 0)
    stage3 = stage2 & (key % 4 != 0)
    stage4 = stage3 & (key % 3 != 0)
    stage5 = stage4 & (key % 7 != 0)
    even = cust % 2 == 0

    def flag(c):
        return F.when(c, 1).otherwise(0)

    def amount(c, divisor):
        return F.when(c, F.floor(F.col("o_totalprice") / divisor)).otherwise(0).cast("long")

    out = b.select(
        key.alias("account_id"),
        cust.alias("duns"),
        F.col("o_orderdate").alias("mail_date"),
        F.year("o_orderdate").alias("load_year"),
        F.month("o_orderdate").alias("load_month"),
        F.when(even, "C1").otherwise("C2").alias("class_type"),
        F.when(cust % 4 == 0, "Y").otherwise("N").alias("ppp"),
        F.nullif(F.col("c_mktsegment"), F.lit("MACHINERY")).alias("market_segment"),
        F.col("o_orderpriority").alias("list_name"),
        F.col("r_name").alias("region"),
        flag(stage1).alias("flg_resp"),
        flag(stage2).alias("flg_qual"),
        flag(stage3).alias("flg_sub"),
        flag(stage4).alias("flg_appr"),
        flag(stage5).alias("flg_fund"),
        flag(stage4 & even).alias("flg_nfappr"),
        flag(stage5 & even).alias("flg_nffund"),
        amount(stage5, 10).alias("fund_amt"),
        amount(stage5 & even, 10).alias("nffund_amt"),
        amount(stage5, 100).alias("fund_margin"),
        F.floor("o_totalprice").alias("lead_ags"),
        (1 + key % 3).alias("mail_cnt"),
        (300 + h % 551).alias("ref_score"),
        ((h + 1 + 3000 * flag(stage1)).cast("double") / F.lit(13000.0)).alias("score_resp"),
        (1 + key % 4).alias("wt"),
        F.col("o_totalprice").alias("x_price"),
        F.col("c_acctbal").alias("x_bal"),
        F.col("qty").alias("x_qty"),
        F.col("n_lines").alias("x_lines"),
        F.col("max_disc").alias("x_disc"),
        (2 * F.col("o_totalprice") + 1).alias("x_copy"),
        F.lit(1).alias("x_const"),
        F.when(key % 10 == 0, F.col("c_acctbal")).alias("x_sparse"),
    )
    return out.select(*cols) if cols else out


def stored_campaign(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    """The same, written once: for operators that read a joined view several times."""
    return materialize(campaign(spark, sf_dir, *cols), "campaign")


def names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messy business names."""
    key = F.col("p_partkey")
    suffix = (
        F.when(key % 4 == 0, " LLC").when(key % 4 == 1, ", Inc.").when(key % 4 == 2, "  Corp")
    ).otherwise("")
    return table(spark, sf_dir, "part").select(
        key.alias("name_id"),
        F.when(
            key % 11 != 0,
            F.concat("p_name", suffix, F.lit(" #"), (key % 100).cast("string")),
        ).alias("business_name"),
        F.concat(
            (1000 + key % 9000).cast("string"), F.lit("0"), F.col("p_size").cast("string")
        ).alias("sic_8"),
    )


def marketing_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text rows with a partly missing label."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return docs.join(labels, "doc_id", "left")


def contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overlapping contact files; the first one wins."""
    events = table(spark, sf_dir, "events")
    return events.select(
        F.when(F.col("event_id") % 2 == 0, 1).otherwise(2).alias("file_no"),
        F.col("user_id").alias("duns"),
        F.col("event_id").alias("row_no"),
        F.col("event_type").alias("channel"),
    )


def region_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Region lookup that leaves the fifth region unmatched."""
    return (
        table(spark, sf_dir, "region")
        .filter("r_regionkey < 4")
        .select(
            F.col("r_name").alias("member"),
            F.when(F.col("r_regionkey") < 2, "east").otherwise("west").alias("macro_region"),
        )
    )


SQL_VIEWS = {
    "campaign": """
  SELECT b.o_orderkey AS account_id, o_custkey AS duns, o_orderdate AS mail_date,
         CAST(year(o_orderdate) AS INT) AS load_year, CAST(month(o_orderdate) AS INT) AS load_month,
         CASE WHEN o_custkey % 2 = 0 THEN 'C1' ELSE 'C2' END AS class_type,
         CASE WHEN o_custkey % 4 = 0 THEN 'Y' ELSE 'N' END AS ppp,
         NULLIF(c_mktsegment, 'MACHINERY') AS market_segment,
         o_orderpriority AS list_name, r_name AS region,
         f1 AS flg_resp, f2 AS flg_qual, f3 AS flg_sub, f4 AS flg_appr, f5 AS flg_fund,
         CASE WHEN f4 = 1 AND o_custkey % 2 = 0 THEN 1 ELSE 0 END AS flg_nfappr,
         CASE WHEN f5 = 1 AND o_custkey % 2 = 0 THEN 1 ELSE 0 END AS flg_nffund,
         CASE WHEN f5 = 1 THEN CAST(floor(o_totalprice / 10) AS BIGINT) ELSE 0 END AS fund_amt,
         CASE WHEN f5 = 1 AND o_custkey % 2 = 0 THEN CAST(floor(o_totalprice / 10) AS BIGINT) ELSE 0 END AS nffund_amt,
         CASE WHEN f5 = 1 THEN CAST(floor(o_totalprice / 100) AS BIGINT) ELSE 0 END AS fund_margin,
         CAST(floor(o_totalprice) AS BIGINT) AS lead_ags,
         1 + b.o_orderkey % 3 AS mail_cnt,
         300 + h % 551 AS ref_score,
         CAST(h + 1 + 3000 * f1 AS DOUBLE) / CAST(13000 AS DOUBLE) AS score_resp,
         1 + b.o_orderkey % 4 AS wt,
         o_totalprice AS x_price, c_acctbal AS x_bal, qty AS x_qty, n_lines AS x_lines, max_disc AS x_disc,
         2 * o_totalprice + 1 AS x_copy, 1 AS x_const,
         CASE WHEN b.o_orderkey % 10 = 0 THEN c_acctbal END AS x_sparse
  FROM (
    SELECT o.*, c.*, r.r_name, li.n_lines, li.qty, li.max_disc,
           (o.o_orderkey * 7919 + 13) % 9973 AS h,
           CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS f1,
           CASE WHEN o_orderstatus = 'F' AND o_orderkey % 5 <> 0 THEN 1 ELSE 0 END AS f2,
           CASE WHEN o_orderstatus = 'F' AND o_orderkey % 5 <> 0 AND o_orderkey % 4 <> 0 THEN 1 ELSE 0 END AS f3,
           CASE WHEN o_orderstatus = 'F' AND o_orderkey % 5 <> 0 AND o_orderkey % 4 <> 0 AND o_orderkey % 3 <> 0 THEN 1 ELSE 0 END AS f4,
           CASE WHEN o_orderstatus = 'F' AND o_orderkey % 5 <> 0 AND o_orderkey % 4 <> 0 AND o_orderkey % 3 <> 0 AND o_orderkey % 7 <> 0 THEN 1 ELSE 0 END AS f5
    FROM orders o
    LEFT JOIN customer c ON o.o_custkey = c.c_custkey
    LEFT JOIN nation n   ON c.c_nationkey = n.n_nationkey
    LEFT JOIN region r   ON n.n_regionkey = r.r_regionkey
    LEFT JOIN (
      SELECT l_orderkey, COUNT(*) AS n_lines,
             CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS qty,
             MAX(l_discount) AS max_disc
      FROM lineitem GROUP BY l_orderkey) li ON li.l_orderkey = o.o_orderkey
  ) b""",
    "names": """
  SELECT p_partkey AS name_id,
         CASE WHEN p_partkey % 11 = 0 THEN NULL
              ELSE concat(p_name, CASE p_partkey % 4 WHEN 0 THEN ' LLC' WHEN 1 THEN ', Inc.' WHEN 2 THEN '  Corp' ELSE '' END,
                          ' #', CAST(p_partkey % 100 AS VARCHAR)) END AS business_name,
         concat(CAST(1000 + p_partkey % 9000 AS VARCHAR), '0', CAST(p_size AS VARCHAR)) AS sic_8
  FROM part""",
    "marketing_text": """
  SELECT d.doc_id, d.text, d.lang, l.quality AS label
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "contacts": """
  SELECT CASE WHEN event_id % 2 = 0 THEN 1 ELSE 2 END AS file_no,
         user_id AS duns, event_id AS row_no, event_type AS channel
  FROM events""",
    "region_dim": """
  SELECT r_name AS member, CASE WHEN r_regionkey < 2 THEN 'east' ELSE 'west' END AS macro_region
  FROM region WHERE r_regionkey < 4""",
}


def with_views(views: str | Sequence[str], body: str) -> str:
    """SQL with the named views in front; ``body`` may start with ``, more AS (...)``."""
    wanted = [views] if isinstance(views, str) else views
    ctes = ", ".join(f"{v} AS ({SQL_VIEWS[v]})" for v in wanted)
    return f"WITH {ctes} {body}"
