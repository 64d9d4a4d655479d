"""Packing of documents into sequences by vector best fit."""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reachmark.llm.common import KEY, keyed_texts, map_arrow
from reachmark.llm.tokens import encoder
from reachmark.runtime import materialize

#: Pieces that are packed together; a sequence holds pieces of one such group.
GROUP = 4096
#: Number of a row among the equal rows of its batch: they are dealt to groups like any others.
COPY = "_copy"


def best_fit(
    lengths: np.ndarray,
    capacity: int,
    max_docs: int,
    max_cost: float,
    weights: tuple[float, float, float] = (1.0, 0.1, 0.1),
    rule: str = "norm",
) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of every piece.

    Pieces go in from the longest on. A bin has room left for tokens, documents and attention
    cost (the sum of squared lengths); of the bins with room in all three, the piece takes the
    one whose room left after it has the smallest weighted norm (``norm``), or whose room has
    the smallest weighted dot product with the piece (``dot``), each as shares of the capacity.
    Without such a bin it opens one.
    """
    n = len(lengths)
    cap = np.array([capacity, max_docs, max_cost], float)
    scale = np.array(weights) / cap**2
    bins, offsets = np.empty(n, np.int64), np.empty(n, np.int64)
    room, ids, used = np.empty((3, n)), np.empty(n, np.int64), 0  # open bins are the first ``used`` columns
    opened = 0
    order = np.argsort(-lengths, kind="stable")
    least = int(lengths.min(initial=capacity))
    for i in order.tolist():
        length = int(lengths[i])
        need = (length, 1, float(length) ** 2)
        if length > capacity or max_docs < 1 or need[2] > max_cost:
            raise ValueError(f"a piece of {length} tokens fits no sequence")
        a, b, c = room[0, :used], room[1, :used], room[2, :used]
        fits = np.flatnonzero((a >= length) & (b >= 1) & (c >= need[2]))
        if len(fits):
            left = [x[fits] for x in (a, b, c)]
            if rule == "norm":
                score = sum(s * (x - y) ** 2 for s, x, y in zip(scale, left, need, strict=True))
            else:
                score = sum(s * x * y for s, x, y in zip(scale, left, need, strict=True))
            k = int(fits[np.argmin(score)])
        else:
            k, used = used, used + 1
            room[:, k], ids[k] = cap, opened
            opened += 1
        bins[i], offsets[i] = ids[k], capacity - int(room[0, k])
        room[0, k] -= length
        room[1, k] -= 1
        room[2, k] -= need[2]
        if room[0, k] < least or room[1, k] < 1 or room[2, k] < least**2:  # closed: the last one moves up
            used -= 1
            room[:, k], ids[k] = room[:, used], ids[used]
    return bins, offsets


def pieces(
    docs: DataFrame, path: str, capacity: int, end_id: int, key: str = "doc_id", text: str = "text", with_ids: bool = False
) -> DataFrame:
    """``_key, piece, start, length, ids_crc32``, a number of equal rows, and if asked for ``ids`` per piece.

    A document is its ids and the end id; one that is longer than ``capacity`` is cut into
    pieces of that length, of which the first may be shorter. Null texts are empty.
    """
    src = keyed_texts(docs, key, text)
    kind = src.schema[KEY].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        enc = encoder(path, True)
        rows, ids, seen = [], [], {}
        for at, (k, t) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
            seen[k, t] = copy = seen.get((k, t), -1) + 1
            got = np.append(enc.encode(t), np.uint32(end_id)).astype("<u4")
            head = len(got) % capacity or capacity
            edges = [0, *range(head, len(got) + 1, capacity)]
            for p, (a, b) in enumerate(zip(edges, edges[1:])):
                rows.append((at, p, a, b - a, zlib.crc32(got[a:b].tobytes()), copy))
                if with_ids:
                    ids.append(got[a:b].astype(np.int32))
        numbers = np.array(rows, np.int64).reshape(-1, 6)
        out = [batch.column(0).take(pa.array(numbers[:, 0])), pa.array(numbers[:, 1].astype(np.int32)), *(pa.array(numbers[:, c]) for c in (2, 3, 4, 5))]
        if with_ids:
            out.append(pa.array(ids, pa.list_(pa.int32())))
        return pa.RecordBatch.from_arrays(out, names)

    names = [KEY, "piece", "start", "length", "ids_crc32", COPY] + ["ids"] * with_ids
    schema = f"{KEY} {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, {COPY} bigint" + ", ids array<int>" * with_ids
    return map_arrow(src, run, schema)


def pack(
    stored: DataFrame, capacity: int, max_docs: int | None = None, max_cost: float | None = None, rule: str = "norm"
) -> DataFrame:
    """``stored`` with ``sequence_id`` and ``offset``.

    ``stored`` should be a written table, as it is read twice. Rows are dealt by hash into
    groups of about ``GROUP`` pieces, packed by ``best_fit`` within each: any number of tasks,
    at the cost of about half a sequence per group. ``max_docs`` and ``max_cost`` default to
    what ``capacity`` tokens can hold at most. Sequence numbers are unique, not dense.
    """
    groups = max(1, math.ceil(stored.count() / GROUP))
    docs_cap, cost_cap = max_docs or capacity, max_cost or float(capacity) ** 2
    columns = [c for c in stored.columns if c != COPY]
    dealt = stored.withColumn("_g", F.pmod(F.xxhash64(*[c for c in stored.columns if c != "ids"]), F.lit(groups)))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in stored.schema if f.name != COPY) + ", sequence_id bigint, offset bigint"

    def run(table: pa.Table) -> pa.Table:
        # the same result whatever order rows came in
        table = table.sort_by([(c, "ascending") for c in columns if c != "ids"])
        bins, offsets = best_fit(table.column("length").to_numpy(), capacity, docs_cap, cost_cap, rule=rule)
        group = table.column("_g")[0].as_py()
        return table.select(columns).append_column("sequence_id", pa.array(bins + (group << 32))).append_column("offset", pa.array(offsets))

    return dealt.groupBy("_g").applyInArrow(run, schema)


def pack_documents(
    docs: DataFrame,
    path: str,
    capacity: int = 1024,
    end_id: int = 2,
    key: str = "doc_id",
    text: str = "text",
    with_ids: bool = False,
    max_docs: int | None = None,
    max_cost: float | None = None,
    rule: str = "norm",
) -> DataFrame:
    """Pieces of all documents with their places in sequences of at most ``capacity`` tokens.

    Empty and null texts give one piece, the end id. Repeated rows are packed each. An empty
    table gives no piece.
    """
    return pack(materialize(pieces(docs, path, capacity, end_id, key, text, with_ids), "pieces"), capacity, max_docs, max_cost, rule)
