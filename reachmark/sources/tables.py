"""Tables: create, load, count, archive and drop."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reachmark.operators.select import keep_columns
from reachmark.runtime import SMALL_TABLE_ROWS, materialize

log = logging.getLogger(__name__)

PARTITION_COLUMNS = ("load_year", "load_month")


def as_df(spark: SparkSession, table: str | DataFrame) -> DataFrame:
    """A DataFrame from a table name or a query."""
    if isinstance(table, DataFrame):
        return table
    if not isinstance(table, str):
        raise ValueError("a table is given by name or as a DataFrame")
    if "." in table:
        raise ValueError("a table name cannot contain '.'; set the current schema instead")
    if not table_exists(spark, table):
        raise ValueError(f"table {table} does not exist")
    return spark.table(table)


def table_exists(spark: SparkSession, name: str) -> bool:
    if not isinstance(name, str):
        raise ValueError("a table name must be a string")
    return spark.catalog.tableExists(name)


def read_table(spark: SparkSession, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A table, or the listed columns that it has."""
    df = as_df(spark, name)
    return keep_columns(df, columns) if columns is not None else df


def create_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    path: str | None = None,
    partition_by: Sequence[str] = (),
) -> None:
    """An empty table."""
    writer = spark.createDataFrame([], schema).write.partitionBy(*partition_by)
    _located(writer, path).saveAsTable(name)


def _located(writer, path: str | None):
    return writer.option("path", path) if path else writer


def append_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Append to a table, created from the frame when there is none."""
    _located(df.write.mode("append"), path).saveAsTable(name)


def write_archive_file(
    df: DataFrame, root: str, folder: str, table: str, compression: str = "snappy"
) -> str:
    """Parquet copy under an archive folder; returns its path."""
    path = f"{root}/{folder}/{table}.parquet"
    df.write.mode("overwrite").option("compression", compression).parquet(path)
    return path


def write_partitioned(
    df: DataFrame, name: str, partition: bool = True, path: str | None = None
) -> None:
    """Table partitioned by load year and month when both columns exist.

    Rows are first gathered by partition and rebalanced by size, so that a small month is
    one file and a big one is written by as many tasks as it needs.
    """
    writer = df.write
    if partition and set(PARTITION_COLUMNS) <= set(df.columns):
        dealt = df.hint("rebalance", *[F.col(c) for c in PARTITION_COLUMNS])
        writer = dealt.write.partitionBy(*PARTITION_COLUMNS)
    _located(writer.mode("overwrite"), path).saveAsTable(name)


def insert_df(df: DataFrame, name: str) -> None:
    """Append rows to an existing table by column name."""
    spark = df.sparkSession
    copy_into(df, name) if table_exists(spark, name) else as_df(spark, name)


def copy_into(df: DataFrame, name: str) -> None:
    """Append rows, matching columns by name without case; absent ones become null."""
    _aligned(df, df.sparkSession.table(name).schema).write.insertInto(name)


def _aligned(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema`` by name without case; absent ones are null."""
    given = {c.lower(): c for c in df.columns}
    cols = []
    for f in schema:
        source = given.get(f.name.lower())
        value = F.col(f"`{source}`") if source else F.lit(None)
        cols.append(value.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def copy_file_into(
    spark: SparkSession, name: str, path: str, kind: str = "csv", **options
) -> None:
    """Append a file: Parquet by column name, delimited text by position."""
    if kind.lower() == "parquet":
        copy_into(spark.read.parquet(path), name)
        return
    target = spark.table(name).schema
    df = spark.read.options(**options).schema(_nullable(target)).csv(path)
    df.write.insertInto(name)


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])


def insert_file(
    spark: SparkSession, name: str, path: str | list[str], delimiter: str = ",", first_row: int = 1
) -> None:
    """Append delimited files by position, each from its ``first_row`` (1-based) on.

    ``path``: one or more files or folders. Lines are counted as they stand in a file, blank
    ones too; blank lines give no row.
    """
    schema = _nullable(spark.table(name).schema)
    if first_row <= 2:
        copy_file_into(spark, name, path, sep=delimiter, header=first_row == 2)
        return
    rest = numbered_lines(spark, path).filter((F.col("line_no") >= first_row) & (F.trim("line") != ""))
    parsed = rest.select(F.from_csv("line", schema.simpleString()[7:-1].replace(":", " "), {"sep": delimiter}).alias("r"))
    parsed.select("r.*").write.insertInto(name)


def numbered_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``file, line_no, line`` of text files, lines numbered from 1 within each file.

    A task reads the lines of a block of a file in order and numbers them from the block's
    start; the lines of the blocks before it, counted in a first pass, are added. No file has
    to be read by one task.
    """
    text = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")
    )

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, n = None, 0
        for batch in batches:
            files, starts = batch.column("file").to_pylist(), batch.column("start").to_numpy()
            numbers = np.empty(batch.num_rows, np.int64)
            for i, block in enumerate(zip(files, starts.tolist())):
                if block != at:
                    at, n = block, 0
                n += 1
                numbers[i] = n
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(numbers)], [*batch.schema.names, "n"])

    lines = text.mapInArrow(number, "value string, file string, start bigint, n bigint")
    blocks = text.groupBy("file", "start").agg(F.count(F.lit(1)).alias("lines"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)  # blocks, not lines
    blocks = materialize(blocks.select("file", "start", F.coalesce(F.sum("lines").over(before), F.lit(0)).alias("before")), "blocks")
    known = F.broadcast(blocks) if blocks.count() <= SMALL_TABLE_ROWS else blocks
    return lines.join(known, ["file", "start"]).select("file", (F.col("before") + F.col("n")).alias("line_no"), F.col("value").alias("line"))


def row_count(
    spark: SparkSession, table: str | DataFrame, assert_count: Callable[[int], bool] | None = None
) -> int:
    """Rows of a table; a predicate that does not hold raises ``ValueError``."""
    n = as_df(spark, table).count()
    log.info("%s has %d rows", table if isinstance(table, str) else "query", n)
    if assert_count is not None and not assert_count(n):
        raise ValueError(f"{n} rows contradict the assertion passed")
    return n


def delete_all_rows(spark: SparkSession, name: str) -> int:
    """Empty a table; returns how many rows it had."""
    n = as_df(spark, name).count()
    spark.sql("TRUNCATE TABLE IDENTIFIER(:t)", args={"t": name})
    log.info("deleted %d rows from %s", n, name)
    return n


def drop_table(spark: SparkSession, name: str) -> bool:
    """Drop a table; says whether there was one."""
    if not table_exists(spark, name):
        log.info("no table %s to drop", name)
        return False
    spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:t)", args={"t": name})
    return True


def archive_table(
    spark: SparkSession,
    table: str | DataFrame,
    archive: str,
    keys: dict[str, object] | None = None,
    overwrite_stale: bool = False,
    ignore: Sequence[str] = (),
    create: bool = True,
    path: str | None = None,
) -> int:
    """Copy rows with literal key columns into an archive.

    Rows already there with the same keys are stale: they are replaced, or with
    ``overwrite_stale`` off only counted and kept. Returns the number of stale rows.
    A replacement is written next to the table and takes effect when the location of the
    partition (or, in an archive that is not partitioned by the keys, of the table) is switched to it: a
    job that fails before leaves the old rows. Read archives by name, not by path.
    In an archive partitioned by the keys, as made here, other keys are never read. One of
    another layout is appended to, and to replace rows there the ones to keep are written again.
    """
    keys = keys or {}
    rows = as_df(spark, table).drop(*ignore)
    rows = rows.withColumns({k: F.lit(v) for k, v in keys.items()}) if keys else rows
    if not table_exists(spark, archive):
        if not create:
            raise ValueError(f"archive table {archive} does not exist")
        create_table(spark, archive, rows.schema, path, list(keys))
    target = spark.table(archive)
    same = F.lit(True)
    for k, v in keys.items():
        same = same & (F.col(k) == F.lit(v))
    stale = target.filter(same).count()
    if stale:
        log.warning("%d stale rows in %s%s", stale, archive, "" if overwrite_stale else " are kept")
    parts = {c.name.lower() for c in spark.catalog.listColumns(archive) if c.isPartition}
    if not (stale and overwrite_stale):
        copy_into(rows, archive)
        return stale
    if parts == {k.lower() for k in keys}:
        plain = T.StructType([f for f in target.schema if f.name.lower() not in parts])
        _switch(_aligned(rows, plain), archive, keys)
    else:
        kept = target.filter(~F.coalesce(same, F.lit(False)))
        _switch(kept.unionByName(_aligned(rows, target.schema)), archive, {}, sorted(parts))
    return stale


def _switch(rows: DataFrame, name: str, keys: dict[str, object], partition_by: Sequence[str] = ()) -> None:
    """Write ``rows`` aside and make them the table, or its partition of ``keys``; then empty the old place."""
    spark = rows.sparkSession
    spec = ", ".join(f"`{k}` = :k{i}" for i, k in enumerate(keys))
    args = {f"k{i}": v for i, v in enumerate(keys.values())}
    root, old = _location(spark, name), _location(spark, name, keys)
    new = f"{root.split(_VERSIONS)[0]}{_VERSIONS}{uuid.uuid4().hex}"
    rows.write.partitionBy(*partition_by).parquet(new)
    place = f"PARTITION ({spec}) " if keys else ""
    spark.sql(f"ALTER TABLE `{name}` {place}SET LOCATION '{new}'", args=args or None)
    if partition_by:
        spark.sql(f"MSCK REPAIR TABLE `{name}`")
    spark.catalog.refreshTable(name)
    rows.limit(0).write.mode("overwrite").parquet(old)  # nothing refers to it any more


_VERSIONS = "_versions/"


def _location(spark: SparkSession, name: str, keys: dict[str, object] | None = None) -> str:
    """Where a table's files, or those of one partition, are."""
    spec = ", ".join(f"`{k}` = :k{i}" for i, k in enumerate(keys or {}))
    args = {f"k{i}": v for i, v in enumerate((keys or {}).values())}
    rows = spark.sql(f"DESCRIBE FORMATTED `{name}` {f'PARTITION ({spec})' if keys else ''}", args=args or None)
    return rows.filter("col_name = 'Location'").first()["data_type"].rstrip("/")
