"""Gradient-boosted trees from histograms that Spark tasks sum, one pass per level.

Features are binned once and stored as blocks of small codes. A pass over the blocks adds the
gradients and hessians of the log loss per (node, feature, bin); tasks send one histogram per
node and feature, and the best splits come back. A row's margin is kept with its block and
brought up to date every few trees.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reachmark.operators.trees import MARGIN_BINS, Trees, binned_auc, class_bins, feature_array, matrix
from reachmark.runtime import materialize

#: Rows of a block.
BLOCK_ROWS = 1 << 16
#: Trees whose margins are worked out anew in every pass before blocks take them up.
PENDING = 16
#: Histograms of all tasks up to so many bytes are summed by the driver, larger ones by a shuffle.
DRIVER_BYTES = 32 << 20


@dataclass(frozen=True)
class BoostParams:
    """What steers boosting; shares are of rows per tree and of features per tree and level.

    ``bagging_every`` draws rows anew after so many trees; ``temperature`` weighs the rows of a
    tree by (-ln u) to that power. ``patience``: trees without a better AUC of the watched rows
    before boosting stops; 0 watches nothing and keeps all trees.
    """

    trees: int = 100
    depth: int = 4
    rate: float = 0.1
    l1: float = 0.0
    l2: float = 1.0
    gamma: float = 0.0
    min_rows: int = 1
    min_hessian: float = 0.0
    subsample: float = 1.0
    positive_share: float = 1.0
    negative_share: float = 1.0
    bagging_every: int = 1
    tree_share: float = 1.0
    level_share: float = 1.0
    temperature: float = 0.0
    bins: int = 64
    patience: int = 20
    seed: int = 25


@dataclass
class Boosted:
    """The kept trees and the AUC of the watched rows after each tree that was grown (from none)."""

    trees: Trees
    watched: list[float] = field(default_factory=list)


def bin_edges(df: DataFrame, features: list[Column], bins: int) -> list[np.ndarray]:
    """Inner quantiles per feature, from sketches of fixed size."""
    ranks = [i / bins for i in range(1, bins)]
    exprs = [F.percentile_approx(c.cast("double"), ranks, 10_000).alias(f"e{i}") for i, c in enumerate(features)]
    row = df.agg(*exprs).first() if exprs else []
    return [np.unique(np.array([v for v in (e or []) if v is not None and not np.isnan(v)], float)) for e in row]


def make_blocks(
    df: DataFrame, features: list[Column], label: Column, weight: Column, key: Column, watched: Column, edges: list[np.ndarray], rows: int
) -> DataFrame:
    """Stored blocks of rows: codes (feature by feature), label, weight, draw number and margin as bytes.

    Few rows get few tasks, as every level of every tree is a pass over them.

    Code 0 is the missing value and all values up to the first edge's left, so that missing values go left.
    """
    src = df.select(
        feature_array(features).alias("x"), label.cast("double").alias("y"), weight.cast("double").alias("w"),
        F.xxhash64(key).alias("h"), watched.cast("double").alias("v"),
    )

    kind = code_type(edges)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _full(batches):
            x = matrix(part.column(0), len(edges))
            codes = [np.where(np.isnan(x[:, j]), 0, np.searchsorted(e, x[:, j], "left")) for j, e in enumerate(edges)]
            packed = np.array(codes, kind).reshape(len(edges), len(x)).tobytes()
            cells = [np.nan_to_num(part.column(i).to_numpy().astype(float)) for i in (1, 2, 4)]
            hashes = part.column(3).to_numpy().tobytes()
            row = [packed, cells[0].tobytes(), cells[1].tobytes(), hashes, (cells[2] > 0).tobytes(), np.zeros(len(x)).tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array([len(x)], pa.int32()), *[pa.array([c], pa.binary()) for c in row]], _NAMES)

    blocks = src.coalesce(max(1, -(-rows // BLOCK_ROWS))).mapInArrow(run, _SCHEMA)
    return materialize(blocks, "blocks")


def code_type(edges: list[np.ndarray]) -> type:
    """What codes are stored as: bytes where the bins allow it."""
    return np.uint8 if max((len(e) for e in edges), default=0) < 256 else np.uint16


def _full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches put together to ``BLOCK_ROWS`` rows, but for the last."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, BLOCK_ROWS - rows)
            batch = batch.slice(part.num_rows)
            held.append(part)
            rows += part.num_rows
            if rows == BLOCK_ROWS:
                yield pa.Table.from_batches(held)
                held, rows = [], 0
    if held:
        yield pa.Table.from_batches(held)


_NAMES = ["n", "codes", "y", "w", "h", "v", "m"]
_TYPES = [float, float, np.uint64, bool, float]
_SCHEMA = "n int, codes binary, y binary, w binary, h binary, v binary, m binary"


@dataclass
class _Block:
    codes: np.ndarray
    y: np.ndarray
    w: np.ndarray
    h: np.ndarray
    v: np.ndarray
    m: np.ndarray

    @staticmethod
    def rows(batches: Iterator[pa.RecordBatch], kind: type) -> Iterator[_Block]:
        for batch in batches:
            for i in range(batch.num_rows):
                codes, y, w, h, v, m = (np.frombuffer(batch.column(c)[i].as_buffer(), t) for c, t in zip(_NAMES[1:], [kind, *_TYPES], strict=True))
                yield _Block(codes.reshape(-1, batch.column("n")[i].as_py()), y, w, h, v, m)


@dataclass
class _Tree:
    """A tree that grows: cuts are codes."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    cover: np.ndarray
    gain: np.ndarray

    @staticmethod
    def root(depth: int) -> _Tree:
        size = 2 ** (depth + 1) - 1
        own = np.arange(size)
        return _Tree(np.zeros(size, np.int64), np.zeros(size, np.int64), own.copy(), own.copy(), *np.zeros((3, size)))

    def stops(self, depth: int) -> np.ndarray:
        """The node where each of the ``2**depth`` paths from the root ends; a leaf above is its own child."""
        at = np.zeros(1 << depth, np.int64)
        for d in reversed(range(depth)):
            at = np.where((np.arange(1 << depth) >> d) & 1, self.right[at], self.left[at])
        return at

    def paths(self, codes: np.ndarray, depth: int) -> np.ndarray:
        """The path that each row takes, one bit per level; ``stops`` gives its node.

        Every split is compared for all rows and the paths below it are chosen by masks of bytes, which
        is far cheaper than following each row from node to node.
        """
        kind = np.uint8 if depth <= 8 else np.uint32

        def below(node: int, levels: int) -> np.ndarray | None:
            if not levels or self.left[node] == node:
                return None
            over = (codes[self.feature[node]] > codes.dtype.type(self.cut[node])).astype(kind)  # compared as bytes
            low, high = below(int(self.left[node]), levels - 1), below(int(self.right[node]), levels - 1)
            top = kind(1 << (levels - 1))
            if low is None and high is None:
                return over * top
            mask = np.negative(over)
            high = mask & top if high is None else mask & (high | top)
            return high if low is None else high | (low & ~mask)

        found = below(0, depth)
        return np.zeros(codes.shape[1], kind) if found is None else found


def _mixed(h: np.ndarray, *salt: int) -> np.ndarray:
    """Hashes of hashes and whole numbers, one after the other."""
    x = h.copy()
    with np.errstate(over="ignore"):
        for s in salt:
            x ^= np.uint64((s * 0x9E3779B97F4A7C15 + 1) & 0xFFFFFFFFFFFFFFFF)
            x *= np.uint64(0xBF58476D1CE4E5B9)
            x ^= x >> np.uint64(27)
            x *= np.uint64(0x94D049BB133111EB)
            x ^= x >> np.uint64(31)
    return x


def _uniform(h: np.ndarray, *salt: int) -> np.ndarray:
    """Numbers in (0, 1) from a hash of the row and whole numbers."""
    return ((_mixed(h, *salt) >> np.uint64(11)).astype(float) + 0.5) / 2**53


def _drawn(block: _Block, p: BoostParams, tree: int) -> tuple[np.ndarray, np.ndarray]:
    """The training rows of a block that are drawn for one tree, and their weights."""
    draw = tree // max(1, p.bagging_every)
    taken = ~block.v & (block.w > 0)
    least, most = sorted(p.subsample * s for s in (p.positive_share, p.negative_share))
    mixed = _mixed(block.h, p.seed, draw) if least < 1 or p.temperature > 0 else block.h
    if least < 1:
        share = most if least == most else p.subsample * np.where(block.y > 0.5, p.positive_share, p.negative_share)
        taken &= (share >= 1) | (_uniform(mixed, 1) < share)
    rows = np.flatnonzero(taken)
    w = block.w[rows]
    if p.temperature > 0:
        mixed = mixed[rows] if draw == tree else _mixed(block.h[rows], p.seed, tree)
        w = w * (-np.log(_uniform(mixed, 2))) ** p.temperature
    return rows, w


def _soft(g: np.ndarray, l1: float) -> np.ndarray:
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0.0)


def best_cut(hist: np.ndarray, p: BoostParams) -> tuple:
    """Gain, cut and sums of the best split of one node by one feature; ``hist`` is 3 x bins of g, h and rows.

    Codes up to the cut go left. No allowed split: gain minus infinity.
    """
    g, h, c = hist
    left, whole = np.cumsum(hist, axis=1)[:, :-1], hist.sum(axis=1)
    right = whole[:, None] - left
    score = lambda gs, hs: _soft(gs, p.l1) ** 2 / np.maximum(hs + p.l2, 1e-12)
    gain = 0.5 * (score(left[0], left[1]) + score(right[0], right[1]) - score(whole[0], whole[1])) - p.gamma
    allowed = (np.minimum(left[2], right[2]) >= max(1, p.min_rows)) & (np.minimum(left[1], right[1]) >= p.min_hessian)
    gain = np.where(allowed, gain, -np.inf)
    k = int(np.argmax(gain)) if len(gain) else 0
    if not len(gain) or gain[k] == -np.inf:
        return (-np.inf, 0, 0.0, 0.0, float(whole[0]), float(whole[1]))
    return (float(gain[k]), k, float(left[0][k]), float(left[1][k]), float(whole[0]), float(whole[1]))


class _Growth:
    """Boosting over stored blocks."""

    def __init__(self, blocks: DataFrame, edges: list[np.ndarray], p: BoostParams, bias: float):
        self.base, self.blocks, self.edges, self.p, self.bias = blocks, blocks, edges, p, bias
        self.width = max((len(e) for e in edges), default=0) + 1
        self.kind = code_type(edges)
        self.taken: list[_Tree] = []  # trees that the blocks' margins hold
        self.pending: list[_Tree] = []
        self.kept = None
        self.tasks = blocks.rdd.getNumPartitions()

    def _margin(self):
        depth = self.p.depth
        pending = [(tree, tree.value[tree.stops(depth)]) for tree in self.pending]

        def margin(block: _Block) -> np.ndarray:
            m = block.m.copy()
            for tree, values in pending:
                m += values[tree.paths(block.codes, depth)]
            return m

        return margin

    def take_up(self) -> None:
        """Blocks with the margins of all trees so far; a lost block is worked out again from the one before."""
        margin, kind = self._margin(), self.kind

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ms = [margin(b).tobytes() for b in _Block.rows([batch], kind)]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(ms, pa.binary())], _NAMES)

        fresh = self.blocks.mapInArrow(run, _SCHEMA).persist(StorageLevel.MEMORY_AND_DISK)
        fresh.count()
        self.release()
        self.blocks = self.kept = fresh
        self.taken += self.pending
        self.pending = []

    def release(self) -> None:
        if self.kept is not None:
            self.kept.unpersist()

    def level(self, tree: _Tree, number: int, depth: int, nodes: list[int], columns: list[list[int]], watch: bool) -> tuple[dict, float | None]:
        """Best split per node and feature at one level, and the AUC of the watched rows before this tree."""
        margin, p, width, bias, kind = self._margin(), self.p, self.width, self.bias, self.kind
        place = np.full(2 ** (p.depth + 1) - 1, -1)
        place[nodes] = np.arange(len(nodes))
        spot = {node: i for i, node in enumerate(nodes)}
        place = place[tree.stops(depth)]
        wanted = [(node, f) for node, cols in zip(nodes, columns, strict=True) for f in cols]

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            hist = np.zeros((len(wanted), 3, width))
            classes = np.zeros((2, MARGIN_BINS)) if watch else None
            used = False
            for block in _Block.rows(batches, kind):
                used = True
                m = bias + margin(block)
                if watch:
                    v = np.flatnonzero(block.v)
                    classes += class_bins(m[v], block.y[v], block.w[v])
                rows, w = _drawn(block, p, number)
                at = place[tree.paths(block.codes, depth)[rows]]
                if (at < 0).any():
                    rows, w, at = rows[at >= 0], w[at >= 0], at[at >= 0]
                if not len(rows):
                    continue
                proba = 1 / (1 + np.exp(-m[rows]))
                stats = w * (proba - block.y[rows]), w * proba * (1 - proba), None
                at = at * width
                size = len(nodes) * width
                by_feature: dict[int, np.ndarray] = {}
                for k, (node, f) in enumerate(wanted):
                    if f not in by_feature:
                        cell = at + block.codes[f][rows]
                        by_feature[f] = np.stack([np.bincount(cell, s, size) for s in stats]).reshape(3, len(nodes), width)
                    hist[k] += by_feature[f][:, spot[node]]
            if used:
                rows = [(n, f, h.tobytes()) for (n, f), h in zip(wanted, hist, strict=True)]
                rows += [(-1, -1, classes.tobytes())] if watch else []
                for node, feature, cell in rows:
                    yield pa.RecordBatch.from_arrays([pa.array([node], pa.int32()), pa.array([feature], pa.int32()), pa.array([cell], pa.binary())], ["node", "feature", "hist"])

        parts = self.blocks.mapInArrow(add, "node int, feature int, hist binary")
        if self.tasks * (len(wanted) * 3 * width + watch * 2 * MARGIN_BINS) * 8 <= DRIVER_BYTES:
            summed: dict[tuple, np.ndarray] = {}
            for r in sorted(parts.collect(), key=lambda r: bytes(r["hist"])):  # the same sums whatever order tasks end in
                key = (r["node"], r["feature"])
                summed[key] = summed.get(key, 0) + np.frombuffer(r["hist"])
            found = [(*key, *(_finished(key[0], h, p))) for key, h in summed.items()]
        else:

            def merge(key: tuple, table: pa.Table) -> pa.Table:
                node, feature = (k.as_py() for k in key)
                cells = sorted(h.as_py() for h in table.column("hist"))
                got = _finished(node, sum(np.frombuffer(h) for h in cells), p)
                return pa.table([pa.array([v], t) for v, t in zip((node, feature, *got), _CUT_TYPES)], _CUT_NAMES)

            found = [tuple(r) for r in parts.groupBy("node", "feature").applyInArrow(merge, _CUT_SCHEMA).collect()]
        auc = next((r[2] for r in found if r[0] < 0), None)
        best: dict[int, tuple] = {}
        for node, feature, *cut in sorted(found):
            if node >= 0 and (node not in best or cut[0] > best[node][1]):
                best[node] = (feature, *cut)
        return best, auc

    def watch(self, number: int) -> float | None:
        """AUC of the watched rows with all trees so far."""
        return self.level(_Tree.root(self.p.depth), number, 0, [0], [[]], True)[1]

    def grow(self, number: int) -> tuple[_Tree, float | None]:
        """The next tree, level by level, and the AUC of the watched rows before it."""
        p, tree = self.p, _Tree.root(self.p.depth)
        rng = np.random.default_rng((p.seed, number))
        count = lambda share, n: max(1, round(share * n))
        all_features = np.arange(len(self.edges))
        of_tree = np.sort(rng.permutation(all_features)[: count(p.tree_share, len(all_features))])
        nodes, auc = [0], None
        weight = lambda g, h: -p.rate * float(_soft(np.array(g), p.l1)) / max(h + p.l2, 1e-12)
        for depth in range(p.depth):
            of_level = np.sort(rng.permutation(of_tree)[: count(p.level_share, len(of_tree))]).tolist()
            best, seen = self.level(tree, number, depth, nodes, [of_level] * len(nodes), depth == 0 and p.patience > 0)
            auc = seen if depth == 0 else auc
            below = []
            for node in nodes:
                if node not in best:
                    continue
                f, gain, cut, gl, hl, g, h = best[node]
                if depth == 0:
                    tree.value[0], tree.cover[0] = weight(g, h), h
                if not gain > 1e-12:
                    continue
                a, b = 2 * node + 1, 2 * node + 2
                tree.feature[node], tree.cut[node], tree.left[node], tree.right[node], tree.gain[node] = f, cut, a, b, gain
                for child, gs, hs in ((a, gl, hl), (b, g - gl, h - hl)):
                    tree.value[child], tree.cover[child] = weight(gs, hs), hs
                below += [a, b]
            nodes = below
            if not nodes:
                break
        return tree, auc


def _finished(node: int, hist: np.ndarray, p: BoostParams) -> tuple:
    """A summed histogram's best split, or for the watched rows their AUC."""
    if node < 0:
        return (binned_auc(*hist.reshape(2, -1)), 0, 0.0, 0.0, 0.0, 0.0)
    return best_cut(hist.reshape(3, -1), p)


_CUT_NAMES = ["node", "feature", "gain", "cut", "gl", "hl", "g", "h"]
_CUT_TYPES = [pa.int32(), pa.int32(), pa.float64(), pa.int32(), *[pa.float64()] * 4]
_CUT_SCHEMA = "node int, feature int, gain double, cut int, gl double, hl double, g double, h double"


def boost(
    df: DataFrame, names: list[str], features: list[Column], label: Column, weight: Column, key: Column, watched: Column, p: BoostParams
) -> Boosted:
    """Grow trees on the rows that are not ``watched``, and keep those up to the best AUC of the watched rows.

    Boosting ends after ``p.trees`` trees, or ``p.patience`` trees after the best one. Missing
    values go left at every split. Results depend on keys, not on partitions.
    """
    edges = bin_edges(df.filter(~watched), features, p.bins)
    counted = F.when(~watched, weight)
    sums = df.agg(F.sum(counted * label), F.sum(counted), F.count(F.lit(1))).first()
    share = min(max((sums[0] or 0.0) / (sums[1] or 1.0), 1e-6), 1 - 1e-6)
    growth = _Growth(make_blocks(df, features, label, weight, key, watched, edges, sums[2]), edges, p, float(np.log(share / (1 - share))))
    seen: list[float] = []
    best = 0
    try:
        for number in range(p.trees + 1):
            if number == p.trees and not p.patience:
                break
            tree, auc = growth.grow(number) if number < p.trees else (None, growth.watch(number))
            if p.patience:  # the AUC with all trees before this one
                seen.append(auc if auc is not None else 0.5)
                if number and seen[number] > seen[best]:
                    best = number
                if number - best >= p.patience:
                    break
            if number < p.trees:
                growth.pending.append(tree)
                if len(growth.pending) >= PENDING:
                    growth.take_up()
    finally:
        growth.release()
    grown = growth.taken + growth.pending
    kept = grown[:best] if p.patience else grown
    # without one gain on the watched rows the first tree stays
    kept = kept or grown[:1]
    return Boosted(_assembled(kept, names, edges, growth.bias, p.depth), seen)


def _assembled(grown: list[_Tree], names: list[str], edges: list[np.ndarray], bias: float, depth: int) -> Trees:
    """Trees over values: a cut code becomes its edge."""
    size = 2 ** (depth + 1) - 1
    stack = lambda a, kind: np.array([getattr(t, a) for t in grown], kind).reshape(-1, size)
    threshold = np.zeros((len(grown), size))
    for i, t in enumerate(grown):
        for node in np.flatnonzero(t.left != np.arange(size)):
            threshold[i, node] = edges[t.feature[node]][t.cut[node]]
    ints = {a: stack(a, np.int64) for a in ("feature", "left", "right")}
    floats = {a: stack(a, float) for a in ("value", "cover", "gain")}
    return Trees(tuple(names), ints["feature"], threshold, ints["left"], ints["right"], floats["value"], floats["cover"], floats["gain"], bias)
