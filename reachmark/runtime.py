"""Session-level helpers: shared storage, stored stages and size limits."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Above this many rows a small table is joined without a broadcast hint.
SMALL_TABLE_ROWS = 200_000


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session that names none (tests) gets a temporary one. On a cluster that
    raises, since every executor would write to a disk of its own.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="reachmark-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/reachmark/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage with a compressed, columnar and re-readable copy, so a lost
    executor costs a re-read and later passes prune columns.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    if (passing := _passing.get()) is not None:
        passing.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Folders that ``materialize`` wrote since the innermost ``passing`` began; none outside of one.
_passing: ContextVar[list[str] | None] = ContextVar("passing", default=None)


@contextmanager
def passing(spark: SparkSession) -> Iterator[list[str]]:
    """Stages stored within are removed at the end, but for those taken out of the list, which are the caller's.

    Shuffle files of what ran within go, too: Spark removes them once the driver has collected its
    garbage, which a driver with little to do would put off while its executors' disks fill up.
    """
    stored: list[str] = []
    outer = _passing.set(stored)
    try:
        yield stored
    finally:
        _passing.reset(outer)
        for path in stored:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
        spark._jvm.System.gc()


def settle(spark: SparkSession, make: Callable[[], DataFrame], label: str = "stage") -> DataFrame:
    """``make()`` stored by ``materialize``, without the stages that were stored on its way.

    These are removed as soon as the result is written, or ``make`` fails, so that a long job does
    not hold the disk of all its steps. ``make`` must pass on nothing else that reads them.
    """
    with passing(spark) as stored:
        df = materialize(make(), label)
        kept = stored.pop()
    if (around := _passing.get()) is not None:
        around.append(kept)
    return df


def spread(df: DataFrame) -> DataFrame:
    """Deal rows out where a scan has fewer partitions than the session has cores.

    For heavy work per row over few unsplittable files. A larger input is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(4 * cores) if df.rdd.getNumPartitions() < cores else df
