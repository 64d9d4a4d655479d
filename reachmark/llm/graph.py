"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reachmark.runtime import materialize


def components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """``node, component`` for every node of an edge, ``component`` its smallest reachable node.

    Alternating stars: nodes are linked to the smallest neighbour until only stars are left.
    Every round is a grouped minimum and a join, both with combining or splittable sides, and
    the edges never grow. Each round is written to the shared folder, so that a lost executor
    costs a re-read. Self links and repeated links are fine; null ends are left out.
    """
    both = edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).where("u is not null and v is not null and u <> v")
    now = materialize(both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    while True:
        # large star: every larger neighbour goes to the smallest of the neighbourhood
        nb = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = nb.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            nb.where("v > u").join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        large = materialize(large, "edges")
        # small star: every smaller neighbour, and the node, go to the smallest
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        new = materialize(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        # stars only: no node is both a leaf and a centre, and no leaf has two centres
        left = new.select("v").distinct().join(new.select(F.col("u").alias("v")).distinct(), "v", "left_semi")
        twice = new.groupBy("u").count().where("count > 1").select("u")
        now = new
        if left.isEmpty() and twice.isEmpty():
            break
    leaves = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    centres = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return leaves.unionByName(centres)
