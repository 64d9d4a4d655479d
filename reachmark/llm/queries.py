"""The ``opN_`` queries: each operator over its whole table, with the columns that are checked."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reachmark.llm import (
    alignment, bpe, embedding_dedup, language_model, packing, periodic_runs, pii, quality, simhash, suffix_dedup, token_files, trie_bpe, url_filter,
)
from reachmark.llm.common import KEY

QUERIES = {}
ORACLES = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)``, with SQL where it can express the whole result."""

    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: The rules that urls are judged by.
URL_RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)

_URL_SQL = """
WITH parts AS (
  SELECT page_id,
    CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
split AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts),
rules(h, p, action) AS (VALUES {rules})
SELECT page_id, host, path, max_by(h || p, length(h || p)) AS rule,
  coalesce(max_by(action, length(h || p)), 'allow') AS verdict
FROM split LEFT JOIN rules
  ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
GROUP BY page_id, host, path
""".format(rules=", ".join(f"('{h}', '{p}', '{a}')" for h, p, a in URL_RULES))


@query("op1_url_filter", _URL_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(URL_RULES), "host string, path string, action string")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge_urls(pages, rules).select(
        "page_id", F.col("url_host").alias("host"), F.col("url_path").alias("path"),
        F.col("url_rule").alias("rule"), F.col("url_verdict").alias("verdict"),
    )


@query("op2_suffix_array_dedup")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeat_digests(table(spark, sf_dir, "documents")).withColumnRenamed("doc", "doc_id")


@query("op3_lm_scores")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    learn = F.crc32(F.col("doc_id").cast("string")) % 5 != 1
    return language_model.score_documents(table(spark, sf_dir, "documents"), learn).withColumnRenamed(KEY, "doc_id")


@query("op4_simhash_near_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        F.col(KEY).alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


@query("op5_embedding_near_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))
    return found.withColumnsRenamed({KEY: "vec_id", "component": "component_id"})


@query("op6_best_fit_packing")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack_documents(table(spark, sf_dir, "documents"), path, 1024, 2).withColumnRenamed(KEY, "doc_id")


@query("op7_pii")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.find_pii(docs, pii.fit_pii(docs)).withColumnRenamed(KEY, "doc_id")


@query("op8_quality_rules")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    trees = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    return quality.judge_documents(docs, trees).withColumnRenamed(KEY, "doc_id")


@query("op9_token_files")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return token_files.round_trip(table(spark, sf_dir, "documents"), path).withColumnRenamed(KEY, "doc_id")


@query("op10_byte_bpe")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    ids = bpe.encode_documents(table(spark, sf_dir, "documents"), path, pattern)
    return bpe.decode_documents(ids, path, pattern).select(
        F.col(KEY).alias("doc_id"), "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256")
    )


@query("op11_token_alignment")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment.link_scores(table(spark, sf_dir, "documents"), *paths).withColumnRenamed(KEY, "doc_id")


@query("op12_word_bpe")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return trie_bpe.round_trip(table(spark, sf_dir, "documents"), path).withColumnRenamed(KEY, "doc_id")


def with_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: a tenth of the texts, by a hash of the id, turned periodic behind some word."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = docs.select(
        "doc_id", "text", h.alias("h"), F.floor(h / 10).alias("g"),
        F.when(h % 10 == 0, F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")).alias("w"),
    )
    n = F.size("w")
    placed = words.withColumn("a", F.when(n > 0, (F.col("g") % n).cast("int")))
    placed = placed.withColumn("p", (1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    place = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    turned = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get("w", place(i)))
    return placed.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(turned, " ")).otherwise(F.col("text")).alias("text"))


@query("op13_periodic_runs")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find_runs(with_repeats(table(spark, sf_dir, "documents")))
    # the greatest length, then the smallest start and period
    longest = F.element_at(F.array_sort(F.transform("runs", lambda r: F.struct(-r.length, r.start, r.period))), 1)
    row = lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n"))
    top = found.select(KEY, "runs", "collapsed", F.when(F.size("runs") > 0, longest).alias("top"))
    length = -F.col("top.col1")
    return top.select(
        F.col(KEY).alias("doc_id"), F.size("runs").cast("bigint").alias("n_runs"), F.col("top.start").alias("start"),
        length.alias("length"), F.col("top.period").alias("period"),
        F.floor(1000 * length / F.col("top.period")).cast("bigint").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", row), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
