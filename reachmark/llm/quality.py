"""Quality rules: statistics of a document, judged by boosted trees with monotonic constraints."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reachmark.llm.common import KEY, TEXT, keyed_texts, map_arrow

BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS, MAX_REPEAT_PCT = 10, 20
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Features, and the direction in which quality may move with each (0: either).
FEATURES = {
    "log_words": 0, "mean_word": 0, "symbol_rate": -1, "dup_line_rate": -1, "repeat_rate": -1, "upper_rate": -1,
    "digit_rate": 0, "bang_rate": -1, "pipe_rate": -1, "stop_rate": 0, "line_words": 0, "distinct_rate": 0,
}
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def repeated_words(ids: np.ndarray, window: int = WINDOW) -> int:
    """Words that lie in a run of ``window`` words found twice or more, the first one included."""
    n = len(ids) - window + 1
    if n < 2:
        return 0
    with np.errstate(over="ignore"):
        h = sum(ids[i : i + n] * _ODD[i] for i in range(window))
    _, at, count = np.unique(h, return_inverse=True, return_counts=True)
    if len(count) == n:
        return 0
    edge = np.zeros(len(ids) + 1, np.int64)
    twice = count[at] > 1
    edge[:n] += twice
    edge[window:] -= twice
    return int((np.cumsum(edge[:-1]) > 0).sum())


def statistics(text: str) -> tuple[list[int], list[float]]:
    """The counts of ``COUNTS`` and the values of ``FEATURES``."""
    words = text.encode().split()
    n = len(words)
    chars = len(text) - sum(map(text.count, BLANKS))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    dup = len(lines) - len(set(lines))
    seen: dict[bytes, int] = {}
    put = seen.setdefault
    ids = np.fromiter((put(w, len(seen)) for w in words), np.uint64, n)
    repeat = repeated_words(ids)
    raw = np.frombuffer(text.encode(), np.uint8)
    upper = int(((raw >= 65) & (raw <= 90)).sum())
    m, c = max(n, 1), max(chars, 1)
    short = sum(1 for w in words if len(w) <= 3)
    digits = sum(map(text.count, "0123456789"))
    values = [
        float(np.log1p(n)), chars / m, symbols / c, dup / max(len(lines), 1), repeat / m, upper / c, digits / c,
        text.count("!") / c, text.count("|") / c, short / m, min(n / max(len(lines), 1), 200.0), len(seen) / m,
    ]
    return [n, chars, symbols, dup, repeat], values


@dataclass(frozen=True)
class Trees:
    """Trees as node arrays, trees x nodes: a leaf points to itself. Scores are log odds."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    bias: float
    cut: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.bias)
        rows = np.arange(len(x))
        depth = int(np.log2(self.feature.shape[1] + 1))
        for f, t, a, b, v in zip(self.feature, self.threshold, self.left, self.right, self.value, strict=True):
            at = np.zeros(len(x), np.int64)
            for _ in range(depth):
                at = np.where(x[rows, f[at]] <= t[at], a[at], b[at])
            out += v[at]
        return out

    def keeps(self, x: np.ndarray) -> np.ndarray:
        return self.margin(x) >= self.cut if len(x) else np.zeros(0, bool)


def fit_trees(
    x: np.ndarray,
    y: np.ndarray,
    directions: list[int],
    rounds: int = 60,
    depth: int = 3,
    rate: float = 0.2,
    bins: int = 64,
    ridge: float = 2.0,
    min_child: float = 1.0,
    lost_good: float = 0.001,
) -> Trees:
    """Gradient boosting of log loss over quantile bins.

    A split on a feature with a direction is taken only if the values of its two sides keep
    it, and passes the middle value down as a bound to both. The cut is 0 (even odds) or,
    if lower, the value below which the share ``lost_good`` of the good rows lies.
    """
    n, width = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for j in range(width)]
    codes = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], axis=1)
    prior = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    bias = float(np.log(prior / (1 - prior)))
    score = np.full(n, bias)
    size = 2 ** (depth + 1) - 1
    trees = []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-score))
        g, h = p - y, p * (1 - p)
        feature, threshold = np.zeros(size, np.int64), np.zeros(size)
        left = right = np.arange(size)
        left, right, value = left.copy(), right.copy(), np.zeros(size)
        where = np.zeros(n, np.int64)
        bound = {0: (-np.inf, np.inf)}
        weight = lambda gs, hs, lo, hi: np.clip(-gs / (hs + ridge), lo, hi)
        for node in range(size):
            if node not in bound:
                continue
            lo, hi = bound[node]
            rows = np.flatnonzero(where == node)
            gs, hs = g[rows].sum(), h[rows].sum()
            value[node] = rate * weight(gs, hs, lo, hi)
            if 2 * node + 2 >= size or len(rows) < 2:
                continue
            gain = lambda a, b, w: -(a * w + 0.5 * (b + ridge) * w * w)
            best = (1e-6, -1, -1, 0.0, 0.0)
            for j in range(width):
                if not len(edges[j]):
                    continue
                m = len(edges[j]) + 1
                gl = np.cumsum(np.bincount(codes[rows, j], g[rows], m))[:-1]
                hl = np.cumsum(np.bincount(codes[rows, j], h[rows], m))[:-1]
                wl, wr = weight(gl, hl, lo, hi), weight(gs - gl, hs - hl, lo, hi)
                got = gain(gl, hl, wl) + gain(gs - gl, hs - hl, wr) - gain(gs, hs, weight(gs, hs, lo, hi))
                got[(hl < min_child) | (hs - hl < min_child) | (directions[j] * (wr - wl) < 0)] = -np.inf
                k = int(np.argmax(got))
                if got[k] > best[0]:
                    best = (got[k], j, k, wl[k], wr[k])
            _, j, k, wl, wr = best
            if j < 0:
                continue
            a, b = 2 * node + 1, 2 * node + 2
            feature[node], threshold[node], left[node], right[node] = j, edges[j][k], a, b
            where[rows] = np.where(codes[rows, j] <= k, a, b)
            mid = (wl + wr) / 2
            bound[a], bound[b] = (lo, hi), (lo, hi)
            if directions[j] > 0:
                bound[a], bound[b] = (lo, mid), (mid, hi)
            elif directions[j] < 0:
                bound[a], bound[b] = (mid, hi), (lo, mid)
        score += value[where]
        trees.append((feature, threshold, left, right, value))
    good = np.sort(score[y > 0.5])
    cut = min(0.0, float(good[int(lost_good * len(good))])) if len(good) else 0.0
    return Trees(*map(np.stack, zip(*trees, strict=True)), bias, cut)


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    max_rows: int = 20_000,
    **options,
) -> Trees | None:
    """Trees from labelled documents; None if the labels do not hold both classes.

    At most about ``max_rows`` labelled keys are used, those of the smallest hashes; their
    keys are joined to the documents, and only those documents are measured. Keys with
    labels that disagree and null labels are left out.
    """
    marked = (
        labels.where(F.col(label).isNotNull() & F.col(key).isNotNull())
        .groupBy(F.col(f"`{key}`").alias("_id"))
        .agg(F.min(label).alias("y"), F.max(label).alias("top"))
        .where("y = top")
    )
    total = marked.count()
    if not total:
        return None
    share = min(1.0, max_rows / total)
    picked = marked.where(F.pmod(F.xxhash64("_id"), F.lit(1 << 20)) < int(share * (1 << 20))).select("_id", "y")
    src = keyed_texts(docs, key, text).join(F.broadcast(picked), F.col(KEY) == F.col("_id")).select(F.col("y").cast("double"), TEXT)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = [statistics(t)[1] for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.list_(pa.float64()))], ["y", "x"])

    rows = map_arrow(src, run, "y double, x array<double>").collect()  # about max_rows short rows
    y = np.array([r["y"] for r in rows]) > 0
    if not len(y) or y.all() or not y.any():
        return None
    order = np.lexsort(np.array([r["x"] for r in rows]).T)  # the same trees whatever order rows came in
    x = np.array([r["x"] for r in rows])[order]
    return fit_trees(x, y[order].astype(float), list(FEATURES.values()), **options)


def _judge(texts: list[str], trees: Trees | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    measured = [statistics(t) for t in texts]
    counts = np.array([m[0] for m in measured], np.int64).reshape(-1, len(COUNTS))
    values = np.array([m[1] for m in measured]).reshape(-1, len(FEATURES))
    failed = (counts[:, 0] < MIN_WORDS) | (100 * counts[:, 4] > MAX_REPEAT_PCT * counts[:, 0])
    return counts, failed, ~failed & (trees.keeps(values) if trees else True)


def judge_documents(docs: DataFrame, trees: Trees | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``_key``, the counts, ``base_failed`` and ``kept`` for every row.

    ``base_failed``: fewer than 10 words, or over 20 % of them in repeated 5-word windows;
    such rows are not kept, others as the trees say (without trees: kept). Null and empty
    texts have no words and fail. One narrow pass over whole texts. Null and repeated keys and
    repeated rows give a row each, very long texts are taken whole, other columns are left out, an
    empty table gives no row.
    """
    src = keyed_texts(docs, key, text)
    kind = src.schema[KEY].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, failed, kept = _judge(batch.column(1).to_pylist(), trees)
        columns = [batch.column(0), *map(pa.array, counts.T.copy()), pa.array(failed), pa.array(kept)]
        return pa.RecordBatch.from_arrays(columns, [KEY, *COUNTS, "base_failed", "kept"])

    schema = ", ".join([f"{KEY} {kind}", *(f"{c} bigint" for c in COUNTS), "base_failed boolean", "kept boolean"])
    return map_arrow(src, run, schema)


def keep_good(docs: DataFrame, trees: Trees | None, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``judge_documents`` keeps, with all their columns; null texts go, repeated rows stay."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
        return batch.filter(pa.array(_judge([t or "" for t in texts], trees)[2]))

    return map_arrow(docs, run, docs.schema)
