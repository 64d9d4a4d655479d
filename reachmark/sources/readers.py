"""Readers: CSV and text, vendor extracts, zipped extracts, SQL scripts."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator, Sequence
from itertools import islice
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reachmark.operators.lookup import keep_first, union_by_name
from reachmark.operators.select import lower_names

# Format of the vendor extract.
VENDOR_SEPARATOR = "|"
VENDOR_ENCODING = "ISO-8859-1"


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str | None = None,
    sep: str = ",",
    lower: bool = True,
) -> DataFrame:
    """CSV with a header. Without a schema types are inferred, which reads the file twice."""
    reader = spark.read.option("header", True).option("sep", sep)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    df = reader.csv(path)
    return lower_names(df) if lower else df


def read_txt(spark: SparkSession, path: str | list[str], sep: str = ",", **options) -> DataFrame:
    """Text file read as CSV."""
    return read_csv(spark, path, sep=sep, **options)


def read_vendor_extract(spark: SparkSession, path: str, columns: dict[str, str]) -> DataFrame:
    """Some columns of a wide extract as text, renamed.

    Pipe-separated, Latin-1, no quoting. The parser skips the other columns. A ``.zip``
    is unpacked first; ``.gz`` is read as it is.
    """
    if path.endswith(".zip"):
        return _zipped_extract(spark, path, columns)
    df = (
        spark.read.option("header", True)
        .option("sep", VENDOR_SEPARATOR)
        .option("encoding", VENDOR_ENCODING)
        .option("quote", "")
        .csv(path)
    )
    return df.select(*[F.col(f"`{old}`").cast("string").alias(new) for old, new in columns.items()])


def _members(content: bytes, encoding: str) -> Iterator[tuple[str, Iterator[str]]]:
    """Members of a zip file and their lines, read as a stream."""
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        for member in archive.namelist():
            with archive.open(member) as f:
                text = io.TextIOWrapper(f, encoding=encoding, newline="")
                yield member, (line.rstrip("\r\n") for line in text)


def _batched(items: Iterator, size: int = 50_000) -> Iterator[list]:
    while batch := list(islice(items, size)):
        yield batch


def unzip_lines(spark: SparkSession, path: str, encoding: str = VENDOR_ENCODING) -> DataFrame:
    """Lines of the members of zip files, streamed member by member in each task."""

    def lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for file, content in zip(pdf["path"], pdf["content"]):
                for member, text in _members(content, encoding):
                    for batch in _batched(enumerate(text)):
                        numbers, values = zip(*batch)
                        yield pd.DataFrame({"file": file, "member": member, "line_no": numbers, "line": values})

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(lines, "file string, member string, line_no long, line string")


def _zipped_extract(spark: SparkSession, path: str, columns: dict[str, str]) -> DataFrame:
    """Wanted columns of zipped extracts: a member's header is read by the task that reads its lines.

    A zip file is unpacked once, in one task, as it cannot be split; its bytes are held whole.
    """
    wanted, names = list(columns), list(columns.values())

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for content in pdf["content"]:
                for _, text in _members(content, VENDOR_ENCODING):
                    header = next(text, "").split(VENDOR_SEPARATOR)
                    places = [header.index(c) if c in header else -1 for c in wanted]
                    for batch in _batched(line.split(VENDOR_SEPARATOR) for line in text):
                        yield pd.DataFrame(
                            [[(r[p] or None) if 0 <= p < len(r) else None for p in places] for r in batch], columns=names, dtype=object
                        )

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInPandas(rows, ", ".join(f"`{n}` string" for n in names))


def union_keep_first(
    frames: Sequence[DataFrame], keys: Sequence[str], order: Sequence[str] = ()
) -> DataFrame:
    """Union of frames with one row per key: the earlier frame wins.

    Inside a frame the first row by ``order`` is kept, by default by all columns, so the
    choice does not depend on how files were split.
    """
    ranked = [f.withColumn("_file", F.lit(i)) for i, f in enumerate(frames)]
    by = list(order) or [c for c in frames[0].columns if c not in keys]
    return keep_first(union_by_name(ranked), keys, ["_file", *by]).drop("_file")


def read_script(
    spark: SparkSession,
    path: str,
    params: dict | None = None,
    tables: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """Run the one SELECT of a script file.

    Values come as named parameters (``:name``), identifiers as ``IDENTIFIER(:name)``, and
    DataFrames as ``{name}``; nothing is pasted into the text.
    """
    return spark.sql(_script_text(path), args=params or None, **(tables or {}))


def _script_text(path: str) -> str:
    file = Path(path)
    if not file.is_file():
        raise ValueError(f"SQL script {path} does not exist")
    return file.read_text()


# A literal, quoted name or comment is one piece; so is a semicolon outside of them.
_PIECES = re.compile(
    r"'(?:[^'\\]|\\.|'')*'|\"(?:[^\"\\]|\\.)*\"|`[^`]*`|--[^\n]*|/\*.*?\*/|;|[^;'\"`/-]+|.", re.S
)


def split_statements(text: str) -> list[str]:
    """Statements of a script; semicolons in literals and comments do not count."""
    statements, current = [], ""
    for piece in _PIECES.findall(text):
        if piece == ";":
            statements.append(current.strip())
            current = ""
        elif not piece.startswith(("--", "/*")):
            current += piece
    return [s for s in [*statements, current.strip()] if s]


def execute_script(spark: SparkSession, path: str, params: dict | None = None) -> int:
    """Run all statements of a script in order for their effects; returns how many."""
    statements = split_statements(_script_text(path))
    for s in statements:
        used = {k: v for k, v in (params or {}).items() if re.search(rf":{re.escape(k)}\b", s)}
        spark.sql(s, args=used or None)
    return len(statements)
