"""Near-duplicate embeddings by small-world graphs per shard."""

from __future__ import annotations

import io
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reachmark.llm.common import KEY
from reachmark.llm.graph import components
from reachmark.llm.hnsw import Hnsw
from reachmark.runtime import materialize

SHARDS, SHARD_ROWS = 8, 1_000_000
#: Single precision steers the search; pairs this much below the bound are verified, too.
SLACK = 1e-4
#: Vectors at most that audits ask every shard for, in blocks until enough links are seen.
AUDITED = 8192


def _linked(rows: np.ndarray, places: np.ndarray, sims: np.ndarray, x: np.ndarray, y: np.ndarray, least: float) -> np.ndarray:
    """Which of the similarities are links; those near the bound are worked out in double precision."""
    near = np.abs(sims - least) <= SLACK
    good = sims > least
    at = np.flatnonzero(near.ravel())
    for k in range(0, len(at), 1 << 15):
        c = at[k : k + (1 << 15)]
        i, j = rows[c // len(places)], places[c % len(places)]
        u, v = x[i].astype(float), y[j].astype(float)
        good.ravel()[c] = np.einsum("ij,ij->i", u, v) / (np.linalg.norm(u, axis=1) * np.linalg.norm(v, axis=1)) >= least
    return good


def _tree(hits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (row, column) of links that connect all rows and columns that ``hits`` connects."""
    free_row, free_col = hits.any(axis=1), np.ones(hits.shape[1], bool)
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    while free_row.any():
        stack = [int(free_row.argmax())]
        free_row[stack[0]] = False
        while stack:
            i = stack.pop()
            cols = np.flatnonzero(hits[i] & free_col)
            if not len(cols):
                continue
            free_col[cols] = False
            rows = np.flatnonzero(free_row)
            rows = rows[hits[np.ix_(rows, cols)].any(axis=1)]
            free_row[rows] = False
            left += [np.full(len(cols), i), rows]
            right += [cols, cols[hits[np.ix_(rows, cols)].argmax(axis=1)]]
            stack += rows.tolist()
    return np.concatenate(left), np.concatenate(right)


def _ask(unit: np.ndarray, raw: np.ndarray, rep: np.ndarray, index: Hnsw, z: dict, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What vectors find in an index: links per vector, and (own, other) representatives of connecting links."""
    links = np.zeros(len(rep), np.int64)
    src, dst = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for rows, places, sims in index.matches(unit, least - SLACK, int(z["ef"])):
        good = _linked(rows, places, sims, raw, z["raw"], least)
        good &= z["rep"][places] != rep[rows][:, None]
        links[rows] += good @ z["copies"][places]
        i, j = _tree(good)
        src.append(rep[rows[i]])
        dst.append(z["rep"][places[j]])
    return links, np.concatenate(src), np.concatenate(dst)


def _forest(src: np.ndarray, dst: np.ndarray) -> tuple[list[int], list[int]]:
    """Links that connect what all links connect."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.setdefault(x, x)) != x:
            root[x] = root[up]
            x = root[x]
        return x

    out: tuple[list[int], list[int]] = [], []
    for a, b in zip(src.tolist(), dst.tolist(), strict=True):
        x, y = find(a), find(b)
        if x != y:
            root[max(x, y)] = min(x, y)
            out[0].append(a)
            out[1].append(b)
    return out


def _matrix(rows: list[list[float]]) -> tuple[np.ndarray, np.ndarray]:
    """The rows, shorter ones with zeros behind, as they are and as unit vectors."""
    raw = np.zeros((len(rows), max(map(len, rows), default=0)), np.float64)
    for r, x in zip(raw, rows, strict=True):
        r[: len(x)] = x
    most = np.abs(raw).max(axis=1, keepdims=True, initial=0)
    return raw, raw / (np.linalg.norm(raw / most, axis=1, keepdims=True) * most)


def build_indexes(classes: DataFrame, least: float, goal: float) -> DataFrame:
    """One row per shard: its graph, its vectors, the beam that passed the audit, and what the
    audit saw: links of sampled vectors of every shard (``home``) with this one, and those found.

    The sample is of all vectors, so most of it is foreign to a shard, as most searches are.
    """
    sample = classes.select("rep", "shard", "embedding").orderBy(F.xxhash64("rep", F.lit("audit")), "rep").limit(AUDITED).toArrow()
    asked, home = sample.column("rep").to_numpy(), sample.column("shard").to_numpy()
    queries = _matrix(sample.column("embedding").to_pylist())[1].astype(np.float32)

    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by("rep")
        raw, unit = _matrix(table.column("embedding").to_pylist())
        if (raw.astype(np.float32) == raw).all():
            raw = raw.astype(np.float32)
        shard = table.column("shard")[0].as_py()
        g = Hnsw(unit, seed=shard)
        rep = table.column("rep").to_numpy()[g.order]
        place = {r: k for k, r in enumerate(rep.tolist())}
        own = np.array([place.get(r, -1) for r in asked.tolist()], np.int64)
        wide = max(queries.shape[1], g.vec.shape[1])
        narrow = g.vec
        q, g.vec = (np.pad(v, ((0, 0), (0, wide - v.shape[1]))) for v in (queries, g.vec))
        ef, there, found = g.audit(least - SLACK, goal, q, own)
        g.vec = narrow
        homes = np.flatnonzero(np.bincount(home, there))
        seen = [{"home": int(h), "links": int(there[home == h].sum()), "found": int(found[home == h].sum())} for h in homes]
        data = g.to_bytes(raw=raw[g.order], rep=rep, copies=table.column("copies").to_numpy()[g.order], ef=np.array(ef))
        sink = io.BytesIO()
        np.savez(sink, unit=narrow, raw=raw[g.order], rep=rep)
        recall = found.sum() / there.sum() if there.any() else None  # no link seen, nothing known
        audit = pa.array([seen], pa.list_(pa.struct([("home", pa.int32()), ("links", pa.int64()), ("found", pa.int64())])))
        return pa.Table.from_pydict(
            {"shard": pa.array([shard], pa.int32()), "ef": [ef], "recall": pa.array([recall], pa.float64()), "audit": audit, "data": pa.array([data], pa.binary()), "vectors": pa.array([sink.getvalue()], pa.binary())}
        )

    schema = "shard int, ef bigint, recall double, audit array<struct<home: int, links: bigint, found: bigint>>, data binary, vectors binary"
    return classes.groupBy("shard").applyInArrow(build, schema)


def near_duplicates(
    vectors: DataFrame, key: str = "vec_id", embedding: str = "embedding", least: float = 0.95, goal: float = 0.98, shards: int = SHARDS
) -> DataFrame:
    """``_key, n_links, component, kept`` for every row of ``vectors`` (integer keys).

    Rows link at cosine ``least`` or more, in double precision. Null, empty and zero vectors,
    and those with null or non-finite components, link with nothing and are kept. A shorter
    vector counts as having zeros behind. ``component`` is the smallest key that links reach;
    ``kept`` rows are those. Rows with one vector are grouped first.

    Distinct vectors are dealt to shards by hash (``shards`` of them, more only to keep a
    shard below ``SHARD_ROWS``), each indexed whole. Per index the beam is widened until an
    audit against brute force reaches ``goal`` of the links of a sample of all vectors. Every shard's vectors ask
    every index, one task each; a vector's links are those that it finds itself. Where many link, they
    are counted in matrices; a task returns link counts and a spanning forest, never its pairs.
    """
    e = F.col(f"`{embedding}`")
    rows = vectors.select(F.col(f"`{key}`").cast("bigint").alias(KEY), e.alias("embedding"))
    x = F.col("embedding")
    fine = F.coalesce(
        F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))) & F.exists(x, lambda v: v != 0), F.lit(False)
    )
    good = rows.where(fine & F.col(KEY).isNotNull())
    classes = good.groupBy("embedding").agg(F.min(KEY).alias("rep"), F.count(F.lit(1)).alias("copies"))
    classes = materialize(classes, "vectors")
    n = max(shards, math.ceil(classes.count() / SHARD_ROWS))
    index = materialize(build_indexes(classes.withColumn("shard", F.pmod(F.xxhash64("rep"), F.lit(n)).cast("int")), least, goal), "hnsw")

    def meet(table: pa.Table) -> pa.Table:
        table = table.sort_by([("asks", "ascending")])
        index, z = Hnsw.from_bytes(table.column("data")[0].as_py())  # the index's row comes first
        asked = dict(np.load(io.BytesIO(table.column("data")[-1].as_py())))
        width = max(index.vec.shape[1], asked["unit"].shape[1])
        wide = lambda v: np.pad(v, ((0, 0), (0, width - v.shape[1])))
        index.vec, z["raw"] = wide(index.vec), wide(z["raw"])
        links, src, dst = _ask(wide(asked["unit"]), wide(asked["raw"]), asked["rep"], index, z, least)
        src, dst = _forest(src, dst)
        rep = asked["rep"].tolist()
        return pa.Table.from_pydict(
            {
                "src": pa.array([*rep, *src], pa.int64()),
                "dst": pa.array([None] * len(rep) + dst, pa.int64()),
                "links": pa.array([*links.tolist(), *([0] * len(src))], pa.int64()),
            }
        )

    # every shard's vectors ask every shard's index: a row per index and one per asking shard
    other = F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    answers = index.select(F.col("shard").alias("b"), other.alias("a"), F.lit(False).alias("asks"), "data")
    asks = index.select(F.col("shard").alias("a"), other.alias("b"), F.lit(True).alias("asks"), F.col("vectors").alias("data"))
    meets = asks.join(index.select(F.col("shard").alias("b")), "b", "left_semi")  # a shard may be empty
    meets = meets.unionByName(answers.join(index.select(F.col("shard").alias("a")), "a", "left_semi"))
    pairs = meets.repartition(n * n, "a", "b")
    met = materialize(pairs.groupBy("a", "b").applyInArrow(meet, "src bigint, dst bigint, links bigint"), "links")
    counts = met.where("dst is null").groupBy(F.col("src").alias("rep")).agg(F.sum("links").alias("links"))
    found = components(met.where("dst is not null").select("src", "dst")).withColumnRenamed("node", "rep")
    named = classes.join(counts, "rep", "left").join(found, "rep", "left").select(
        F.col("embedding").alias("_e"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component")
    )
    out = rows.withColumn("_fine", fine & F.col(KEY).isNotNull()).join(named, F.col("_fine") & (x == F.col("_e")), "left")
    component = F.coalesce("component", F.col(KEY))
    return out.select(KEY, F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component"), component.eqNullSafe(F.col(KEY)).alias("kept"))
