"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Names an operator gives to the columns it works on, so that other columns cannot clash.
KEY, TEXT = "_key", "_text"

#: A single blank between two other characters. Pre-tokens of the byte-level pattern never
#: span it: the blank starts the next one. (``\s`` of ``re`` covers all white space there is.)
BLANK = re.compile(r"(?<=\S) (?=\S)")


def keyed_texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``key`` and the text, null texts as empty, and no other column."""
    return docs.select(F.col(f"`{key}`").alias(KEY), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias(TEXT))


def byte_rows(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of every value."""
    return column.cast(pa.binary() if pa.types.is_string(column.type) else pa.large_binary()).to_pylist()


#: Rows of a batch that a function of one batch gets at once: a worker holds few texts at a time.
SLICE_ROWS = 2048


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """``mapInArrow`` for a function of one batch, or a part of one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                if (out := fn(batch.slice(at, SLICE_ROWS))) is not None:
                    yield out

    return df.mapInArrow(run, schema)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased, all else as it is."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def blank_chunks(text: str) -> list[str]:
    """The text cut before single blanks; every part but the first lost its leading blank."""
    return BLANK.split(text)


def mix64(a: np.ndarray, b: np.ndarray | int) -> np.ndarray:
    """A 64-bit hash of two 64-bit values, elementwise."""
    with np.errstate(over="ignore"):
        x = a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.asarray(b).astype(np.uint64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
