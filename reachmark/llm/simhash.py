"""Near-duplicate documents by SimHash fingerprints and tables of distances to pivots."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reachmark.llm.common import KEY, SLICE_ROWS, TEXT, byte_rows, free_name, keyed_texts, map_arrow, mix64
from reachmark.llm.graph import components
from reachmark.runtime import materialize, passing, settle

SEED = 42


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """64-bit SimHash of the shingles of ``shingle`` words, repeats included; 0 without words."""
    words = text.lower().split()  # bytes: A-Z only, and the six ASCII blanks
    if not words:
        return 0
    if len(words) <= shingle:
        grams = [b" ".join(words)]
    else:
        line = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.concatenate(([0], ends[:-1]))[: len(words) - shingle + 1].tolist()
        grams = [line[a:b] for a, b in zip(starts, (ends[shingle - 1 :] - 1).tolist(), strict=True)]
    h = xxhash.xxh64_intdigest
    hashes = np.array([h(g, SEED) for g in grams], dtype="<u8")
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):  # bounded for very long texts
        part = hashes[at : at + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """``_key, fp``: a signed 64-bit fingerprint per row; null and empty texts have 0. Null and repeated keys and
    repeated rows give a row each, very long texts are taken whole, other columns are left out, an
    empty table gives no row.
    """
    src = keyed_texts(docs, key, text)
    kind = src.schema[KEY].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        fp = np.array([fingerprint(t, shingle) for t in byte_rows(batch.column(1))], np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp)], [KEY, "fp"])

    return map_arrow(src, run, f"{KEY} {kind}, fp bigint")


class Pivots:
    """Reference fingerprints and what distances to them tell.

    For each of ``references`` random fingerprints the table also holds its copies with one
    of ``blocks`` bit ranges flipped. A flip changes the distance of x by the length of the
    range less twice x's own distance within it, so the table's differences give x's distance
    to the reference range by range.
    """

    def __init__(self, references: int = 12, blocks: int = 6, seed: int = 7):
        rng = np.random.default_rng(seed)
        edges = [64 * i // blocks for i in range(blocks + 1)]
        self.masks = np.array([sum(1 << b for b in range(s, e)) for s, e in zip(edges, edges[1:])], np.uint64)
        self.lengths = np.bitwise_count(self.masks).astype(np.int16)
        base = rng.integers(0, 1 << 64, references, np.uint64, endpoint=False)
        self.points = np.concatenate((base[:, None], base[:, None] ^ self.masks), axis=1)  # references x (1 + blocks)
        self.blocks = blocks

    def table(self, fp: np.ndarray) -> np.ndarray:
        """Distances, rows x references x (1 + blocks)."""
        return np.bitwise_count(fp.astype(np.uint64)[:, None, None] ^ self.points).astype(np.int16)

    def by_range(self, table: np.ndarray) -> np.ndarray:
        """Distances within each range, rows x references x blocks."""
        return (table[:, :, :1] - table[:, :, 1:] + self.lengths) // 2

    def cells(self, table: np.ndarray, distance: int) -> Iterator[np.ndarray]:
        """A key per choice of ranges. Fingerprints at most ``distance`` bits apart agree on
        all but ``distance`` ranges, and then on all distances within the others: they share a
        key of one choice at least."""
        near = self.by_range(table)
        code = np.zeros((len(table), self.blocks), np.uint64)
        for r in range(near.shape[1]):
            code = mix64(code, near[:, r, :].astype(np.uint64))
        for n, ranges in enumerate(combinations(range(self.blocks), self.blocks - distance)):
            key = np.full(len(table), n, np.uint64)
            for b in ranges:
                key = mix64(key, code[:, b])
            yield key


def close_links(fp: np.ndarray, pivots: Pivots, distance: int, block: int = 512) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links among distinct fingerprints.

    Blocks of rows against the rows after them: pairs whose distances to some pivot differ
    by more than ``distance`` are dropped, the rest verified. Only links that join two groups
    are returned, at most one per row.
    """
    u = fp.astype(np.uint64)
    table = pivots.table(u).reshape(len(u), -1)
    root = np.arange(len(u))
    left, right = [], []
    for at in range(0, len(u), block):
        i = np.arange(at, min(at + block, len(u)))
        far = at
        while far < len(u):
            j = np.arange(far, min(far + block, len(u)))
            far += block
            keep = np.ones((len(i), len(j)), bool)
            for p in range(0, table.shape[1], pivots.blocks + 1):  # the plain references first
                keep &= np.abs(table[i, p][:, None] - table[j, p]) <= distance
            a, b = np.nonzero(keep & (i[:, None] < j))
            a, b = i[a], j[b]
            most = np.abs(table[a] - table[b]).max(axis=1, initial=0) if len(a) else np.zeros(0)
            a, b = a[most <= distance], b[most <= distance]
            ok = np.bitwise_count(u[a] ^ u[b]) <= distance
            for s, t in zip(a[ok].tolist(), b[ok].tolist(), strict=True):
                x, y = s, t
                while root[x] != x:
                    root[x] = root[root[x]]
                    x = root[x]
                while root[y] != y:
                    root[y] = root[root[y]]
                    y = root[y]
                if x != y:
                    root[max(x, y)] = min(x, y)
                    left.append(s)
                    right.append(t)
    return fp[np.array(left, int)], fp[np.array(right, int)]


def link_fingerprints(distinct: DataFrame, distance: int = 3, pivots: Pivots | None = None) -> DataFrame:
    """``src, dst``: links between distinct fingerprints (column ``fp``) that connect exactly
    those at most ``distance`` bits apart, directly or over others.

    Each fingerprint goes to the cells of its pivot distances, one per choice of ranges.
    Cells are sorted into runs, not gathered by a group operator, and a run gives a spanning
    forest, never all its pairs.
    """
    pivots = pivots or Pivots()
    if not 0 <= distance < pivots.blocks:
        raise ValueError("distance must be below the number of ranges")

    def spread(batch: pa.RecordBatch) -> pa.RecordBatch:
        fp = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        table = pivots.table(fp.view(np.uint64))
        keys = list(pivots.cells(table, distance))
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.tile(fp, len(keys)))], ["cell", "fp"]
        )

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, fp = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def links(cell, fp):
            starts = np.concatenate(([0], np.flatnonzero(np.diff(cell)) + 1, [len(cell)]))
            sizes = np.diff(starts)
            out = [np.zeros((2, 0), np.int64)]
            two = starts[:-1][sizes == 2]
            ok = np.bitwise_count((fp[two] ^ fp[two + 1]).view(np.uint64)) <= distance if len(two) else np.zeros(0, bool)
            out.append(np.stack((fp[two][ok], fp[two + 1][ok])))
            for a, n in zip(starts[:-1][sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
                out.append(np.stack(close_links(fp[a : a + n], pivots, distance)))
            src, dst = np.concatenate(out, axis=1)
            return pa.RecordBatch.from_arrays([pa.array(src), pa.array(dst)], ["src", "dst"])

        for batch in batches:
            cell = np.concatenate((cell, batch.column(0).to_numpy(zero_copy_only=False)))
            fp = np.concatenate((fp, batch.column(1).to_numpy(zero_copy_only=False)))
            if len(cell):
                last = np.searchsorted(cell, cell[-1])  # the last run may go on
                yield links(cell[:last], fp[:last])
                cell, fp = cell[last:], fp[last:]
        if len(cell):
            yield links(cell, fp)

    dealt = distinct.select("fp").mapInArrow(lambda b: map(spread, (x for x in b if x.num_rows)), "cell bigint, fp bigint")
    return dealt.repartition("cell").sortWithinPartitions("cell").mapInArrow(runs, "src bigint, dst bigint").distinct()


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", distance: int = 3, shingle: int = 3
) -> DataFrame:
    """``_key, fp, component`` for every row of ``docs``.

    Rows whose fingerprints are at most ``distance`` bits apart are linked; ``component`` is
    the smallest key that links reach, the row's own included. Null and empty texts have
    fingerprint zero and link like any other; null keys are returned, and are no component's
    smallest unless all its keys are null. Rows with one fingerprint are grouped first, so
    copies never meet as pairs. Other columns are not used.
    """
    rows = materialize(fingerprints(docs, key, text, shingle), "simhash")
    distinct = rows.groupBy("fp").agg(F.min(KEY).alias("low"))
    found = components(link_fingerprints(distinct.select("fp"), distance))
    member = distinct.join(found.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "low", F.coalesce("component", "fp").alias("group")
    )
    member = materialize(member, "simhash")
    least = member.groupBy("group").agg(F.min("low").alias("component"))
    named = member.join(least, "group").select("fp", "component")
    return rows.join(named, "fp").select(KEY, "fp", "component")


# ---- groups of similar texts ------------------------------------------------------------

#: Texts in a block of a family, and the shingles per text it is laid out for; every two blocks
#: of one family meet in one task.
BLOCK, SKETCH = 4096, 256
#: Shingles that a task counts at a time, common ones whose counts every task knows, and the
#: binary logarithm of the most bits that tell repeated shingles, or wanted texts, from others.
CHUNK, COMMON, MARKS = 1 << 22, 500_000, 27
#: A shingle of more texts than this is never gathered in one task.
GATHERED = 4096
#: Cells of up to so many texts give pairs, larger ones a forest.
PAIRED = 32
#: Words of 64 bits in a parity bitmap: in cells, and to decide which sets are compared.
WORDS, LONG = 2, 32
#: Sets are compared by this part of their shingle hashes.
HASH = np.dtype("<u4")


def _shingles(text: bytes, shingle: int) -> np.ndarray:
    """The distinct shingle hashes of a text in order."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    number: dict[bytes, int] = {}
    put = number.setdefault
    at = np.array([put(w, len(number)) for w in words])
    h = np.array([xxhash.xxh64_intdigest(w, SEED) for w in number], np.uint64)
    n = max(1, len(words) - shingle + 1)
    grams = h[at[:n]]
    for k in range(1, min(shingle, len(words))):
        grams = mix64(grams, h[at[k : k + n]])
    return np.unique(grams)


def parities(grams: np.ndarray, words: int = WORDS) -> np.ndarray:
    """``words`` x 64 bits, each the parity of the hashes that fall on it. The bitmaps of two sets
    differ in no more bits than the sets differ in members."""
    bits = np.bincount((grams >> np.uint64(32)).astype(np.int64) % (64 * words), minlength=64 * words) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").view("<u8")


def may_link(n: np.ndarray, bits: np.ndarray, m: np.ndarray, other: np.ndarray, least: float) -> np.ndarray:
    """False only for sets of sizes ``n`` and ``m`` that cannot share ``least`` of their members."""
    ok = np.minimum(n, m) >= least * np.maximum(n, m) - 1e-6
    differ = np.bitwise_count(bits ^ other).sum(axis=-1, dtype=np.int64)
    return ok & (differ * (1 + least) <= (1 - least) * (n + m) + 1e-6)


def resemblance(a: bytes, b: bytes) -> float:
    """Share of common members of two sets of hashes, each distinct and in order."""
    x, y = np.frombuffer(a, HASH), np.frombuffer(b, HASH)
    common = len(np.intersect1d(x, y, assume_unique=True))
    union = len(x) + len(y) - common
    return common / union if union else 1.0


def close_texts(prints: np.ndarray | None, sets: list[bytes], least: float, distance: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Places (left, right) of links that connect exactly those texts that all links connect.

    A link has a resemblance of ``least`` and, where there are ``prints``, fingerprints of one
    column at most ``distance`` bits apart. Texts are reached from one another: each is compared,
    over the lists of texts per shingle, with those not reached yet, so texts around one centre
    take few passes.
    """
    sizes = np.array(list(map(len, sets)), np.int64) // HASH.itemsize
    ends = np.cumsum(sizes)
    values, number = np.unique(np.frombuffer(b"".join(sets), HASH), return_inverse=True)
    lists = np.repeat(np.arange(len(sets), dtype=np.int32), sizes)[np.argsort(number, kind="stable")]
    lengths = np.bincount(number, minlength=len(values))
    first = np.cumsum(lengths) - lengths
    free = np.ones(len(sets), bool)
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for start in range(len(sets)):
        reached = [start] if free[start] else []
        free[start] = False
        while reached:
            i = reached.pop()
            own = number[ends[i] - sizes[i] : ends[i]]
            k = lengths[own]
            places = np.arange(k.sum()) + np.repeat(first[own] - (np.cumsum(k) - k), k)
            common = np.bincount(lists[places], minlength=len(sets))
            union = sizes[i] + sizes - common
            ok = free & (np.where(union > 0, common / np.maximum(union, 1), 1.0) >= least)
            if prints is not None:
                ok &= (np.bitwise_count(prints ^ prints[i]) <= distance).any(axis=1)
            at = np.flatnonzero(ok)
            left.append(np.full(len(at), i))
            right.append(at)
            reached += at.tolist()
            free[at] = False
    return np.concatenate(left), np.concatenate(right)


def _cell_links(n: np.ndarray, bits: np.ndarray, least: float) -> tuple[list[int], list[int]]:
    """A forest of what ``may_link`` connects."""
    new = np.arange(len(n))
    left, right = [], []
    while len(new):
        reached, new = [int(new[0])], new[1:]
        while reached and len(new):
            i = reached.pop()
            ok = may_link(n[i], bits[i], n[new], bits[new], least)
            at = new[ok].tolist()
            left += [i] * len(at)
            right += at
            reached += at
            new = new[~ok]
    return left, right


def _per_text(batch: pa.RecordBatch, shingle: int) -> Iterator[tuple[int, np.ndarray]]:
    """Number and shingles of every text of a batch of (text, number), copies once."""
    number = batch.column(1).to_numpy()
    _, first = np.unique(number, return_index=True)
    texts = byte_rows(batch.column(0).take(pa.array(first)))
    return ((int(number[i]), _shingles(text, shingle)) for i, text in zip(first, texts, strict=True))


def marks_of(hashes: DataFrame, column: str, rows: int) -> np.ndarray:
    """Bits, 16 for each of ``rows`` hashes but ``2**MARKS`` at most, of which those are set that the first bits of a hash name."""
    size = min(MARKS, max(15, (16 * rows).bit_length()))
    place = F.shiftrightunsigned(column, 64 - size)
    cut = hashes.groupBy(F.shiftright(place, 15).cast("int").alias("at"))
    found = cut.agg(F.bitmap_construct_agg(place.bitwiseAND(F.lit(32767))).alias("bits")).toArrow()
    marks = np.zeros((1 << (size - 15), 4096), np.uint8)
    for at, bits in zip(found.column("at").to_pylist(), found.column("bits").to_pylist(), strict=True):
        marks[at] = np.frombuffer(bits, np.uint8)
    return marks.reshape(-1)


def marked(marks: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """False only for hashes that ``marks`` was not made of."""
    place = hashes.view(np.uint64) >> np.uint64(65 - (8 * len(marks)).bit_length())
    return (marks[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 > 0


def _planes(values: np.ndarray) -> bytes:
    """Whole numbers of 32 bits, first the low bytes of all; zeros of the high ones take no room once compressed."""
    return values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").reshape(-1)


def _first_bits(spark: SparkSession) -> int:
    """Bits of a hash that tell the group where it is counted; groups grow in number with the partitions."""
    return min(16, max(4, (4 * int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length()))


def shingle_counts(texts: DataFrame, shingle: int) -> DataFrame:
    """``h, c``: shingles that occur more than once, by the first bits of their hashes (the rest is zero), and how often.

    All shingles of all texts are counted, copies in a batch once. Tasks sort them in chunks, and what is
    shuffled of a chunk are the gaps between its hashes, dealt by their first bits.
    """
    bits = _first_bits(texts.sparkSession)

    def pack(held: list[np.ndarray]) -> pa.RecordBatch:
        key, count = np.unique(np.concatenate(held) >> np.uint64(32 - bits), return_counts=True)
        part = (key >> np.uint64(32)).astype(np.int32)
        edges = np.flatnonzero(np.diff(part)) + 1
        low = np.split(key.astype(np.uint32), edges)
        cols = [part[np.concatenate(([0], edges))], [_planes(np.diff(k, prepend=np.uint32(0))) for k in low], list(map(_planes, np.split(count, edges)))]
        return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(cols, (pa.int32(), pa.binary(), pa.binary()), strict=True)], ["part", "gaps", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                for _, grams in _per_text(batch.slice(at, SLICE_ROWS), shingle):
                    held.append(grams)
                    size += len(grams)
                    if size >= CHUNK:
                        yield pack(held)
                        held, size = [], 0
        if size:
            yield pack(held)

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        low = np.concatenate([np.cumsum(_from_planes(x), dtype=np.uint32) for x in table.column("gaps").to_pylist()])
        count = np.concatenate([_from_planes(x) for x in table.column("counts").to_pylist()]).astype(np.int64)
        order = np.argsort(low, kind="stable")
        low = low[order]
        first = np.flatnonzero(np.concatenate(([True], low[1:] != low[:-1])))
        total = np.add.reduceat(count[order], first)
        h = (np.uint64(key[0].as_py()) << np.uint64(32) | low[first].astype(np.uint64)) << np.uint64(32 - bits)
        return pa.table({"h": h[total > 1].view(np.int64), "c": total[total > 1]})

    packed = texts.mapInArrow(run, "part int, gaps binary, counts binary")
    return packed.groupBy("part").applyInArrow(merge, "h bigint, c bigint")


def common_shingles(texts: DataFrame, shingle: int) -> tuple[Callable[[np.ndarray], np.ndarray], int]:
    """Ranks of shingles, rare ones first, and the count of the commonest.

    A shingle of rank 0 occurs but once. Ranks above 1 are counts of the up to ``COMMON`` commonest
    shingles; others that are repeated, and a few that are not, have rank 1. Any order of shingles
    finds the same links.
    """
    spark = texts.sparkSession
    with passing(spark):
        counts = materialize(shingle_counts(texts, shingle), "counts")
        sizes = sorted(((r.c, r.k) for r in counts.groupBy("c").agg(F.count(F.lit(1)).alias("k")).collect()), reverse=True)
        held = list(accumulate(k for _, k in sizes))
        most = sizes[0][0] if sizes else 0
        cut = min((c for (c, _), n in zip(sizes, held, strict=True) if n <= COMMON), default=most + 1)
        found = counts.where(F.col("c") >= cut).toArrow()
        marks = marks_of(counts, "h", held[-1] if held else 0)
    h, c = found.column("h").to_numpy().view(np.uint64), found.column("c").to_numpy()
    order = np.argsort(h)
    common, often = h[order], c[order]
    kept = ~np.uint64((1 << (32 - _first_bits(spark))) - 1)

    def rank(grams: np.ndarray) -> np.ndarray:
        out = marked(marks, grams).astype(np.int64)
        if len(common):
            at = np.minimum(np.searchsorted(common, grams & kept), len(common) - 1)
            out = np.where(common[at] == grams & kept, often[at], out)
        return out

    return rank, most


def _fingerprint_links(texts: DataFrame, distance: int, shingle: int) -> DataFrame:
    """``src, dst``: links between text numbers (column ``t`` beside the text) that connect exactly those whose
    fingerprints links of at most ``distance`` bits connect; texts of one fingerprint hang on the least of them."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        number = batch.column(1).to_numpy()
        _, first = np.unique(number, return_index=True)
        of = byte_rows(batch.column(0).take(pa.array(first)))
        fp = np.array([fingerprint(t, shingle) for t in of], np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(number[first]), pa.array(fp)], ["t", "fp"])

    rows = materialize(map_arrow(texts, run, "t bigint, fp bigint"), "prints")
    least = materialize(rows.groupBy("fp").agg(F.min("t").alias("src")), "prints")
    same = rows.join(least, "fp").where("t <> src").select("src", F.col("t").alias("dst"))
    near = link_fingerprints(least.select("fp"), distance).withColumnsRenamed({"src": "a", "dst": "b"})
    left = least.select(F.col("fp").alias("a"), "src")
    right = least.select(F.col("fp").alias("b"), F.col("src").alias("dst"))
    return same.distinct().unionByName(near.join(left, "a").join(right, "b").select("src", "dst"))


def similar_groups(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 5, least: float = 0.8, distance: int | None = None
) -> DataFrame:
    """``_key, t, group, component``: groups of rows whose texts share ``least`` of their shingles or more.

    ``component`` is the smallest key of the group, ``t`` a number of the text. Null keys are
    never a component's key unless the group has no other. Texts without words are one group.
    Repeated rows are returned each, other columns are left out, an empty table gives no row.

    With a ``distance`` texts are also linked whose SimHash fingerprints over the same shingles are
    at most so many bits apart, as ``near_duplicates`` links them.

    Links are those of the whole sets of shingles, each by 32 bits of its hash, and none is left
    out. In one order of all shingles, rare ones first, two sets of sizes n that share ``least`` have one of
    their first n - ceil(least n) + 1 shingles in common. Texts meet in the cells of these. Sizes
    and parity bitmaps drop only pairs that cannot link: a short bitmap in the cells, a long one
    before the sets of the rest are fetched and compared.

    Texts are never shuffled: sets, and cells, are made in passes over the rows, where copies in a batch count once.
    Cells of up to ``PAIRED`` texts give their pairs. Larger ones give a forest of pairs not
    dropped, and shingles known to be in more than ``GATHERED`` texts a star without being
    gathered. What these connect is a family: there texts are compared until all that are linked
    are connected, in blocks, so neither all pairs nor a whole family meet in one task. That is
    quadratic in a family only where its texts do not link.
    """
    spark = docs.sparkSession
    src = keyed_texts(docs, key, text).select(KEY, F.xxhash64(TEXT).alias("t"), TEXT)
    texts = src.select(TEXT, "t")

    rank, most = common_shingles(texts, shingle)
    fields = ["h", "t", "n", *(f"b{k}" for k in range(WORDS))]
    schema = "h bigint, t bigint, n int, " + ", ".join(f"b{k} bigint" for k in range(WORDS))

    def spread(hot: bool):
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            heads, bits, t, n = [], [], [], []
            for number, g in _per_text(batch, shingle):
                order = rank(g)
                head = np.argsort(order, kind="stable")[: len(g) - int(np.ceil(least * len(g) - 1e-6)) + 1]
                order = order[head]  # what occurs but once is in no other text's cell
                heads.append(g[head[order > GATHERED if hot else (order > 0) & (order <= GATHERED)]] if len(g) else np.zeros(0 if hot else 1, np.uint64))
                bits.append(parities(g))
                t.append(number)
                n.append(len(g))
            k = np.array(list(map(len, heads)))
            table = np.repeat(np.stack(bits).view(np.int64), k, axis=0)
            h = np.concatenate(heads).astype(np.uint64).view(np.int64)
            cols = [h, np.repeat(np.array(t, np.int64), k), np.repeat(np.array(n, np.int32), k), *table.T]
            return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in cols], fields)

        return map_arrow(texts, run, schema)

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            h = batch.column(0).to_numpy()
            last = np.searchsorted(h, h[-1])
            if last or (parts and parts[-1].column(0)[-1].as_py() != h[0]):  # the last run may go on
                yield links([*parts, batch.slice(0, last)])
                parts = [batch.slice(last)]
            else:
                parts.append(batch)
        if parts:
            yield links(parts)

    def links(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        columns = [np.concatenate([p.column(c).to_numpy() for p in parts]) for c in range(3 + WORDS)]
        new = np.ones(len(columns[0]), bool)  # copies from several batches are neighbours
        new[1:] = (columns[0][1:] != columns[0][:-1]) | (columns[1][1:] != columns[1][:-1])
        cell, t, n, *words = (c[new] for c in columns)
        bits = np.stack(words, axis=1).view(np.uint64)
        n = n.astype(np.int64)
        edge = np.flatnonzero(np.diff(cell)) + 1
        starts, ends = np.concatenate(([0], edge)), np.append(edge, len(cell))
        size = ends - starts
        some = np.repeat(np.where(size <= PAIRED, ends, 0), size)  # where the cell of a row ends
        src, dst = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for gap in range(1, min(PAIRED, len(cell))):
            a = np.flatnonzero(np.arange(len(cell)) + gap < some)
            if not len(a):
                break
            for k in range(0, len(a), 1 << 18):
                x = a[k : k + (1 << 18)]
                x = x[may_link(n[x], bits[x], n[x + gap], bits[x + gap], least)]
                src.append(t[x])
                dst.append(t[x + gap])
        few = sum(map(len, src))
        for a, b in zip(starts[size > PAIRED].tolist(), ends[size > PAIRED].tolist(), strict=True):
            x, y = _cell_links(n[a:b], bits[a:b], least)
            src.append(t[a:b][np.array(x, int)])
            dst.append(t[a:b][np.array(y, int)])
        s, d = np.concatenate(src), np.concatenate(dst)
        out = (np.minimum(s, d), np.maximum(s, d), np.arange(len(s)) >= few)
        return pa.RecordBatch.from_arrays([pa.array(v) for v in out], ["src", "dst", "dense"])

    def met() -> DataFrame:
        cells = spread(False).repartition("h").sortWithinPartitions("h", "t")
        pairs = cells.mapInArrow(runs, "src bigint, dst bigint, dense boolean")
        if most > GATHERED:
            hot = materialize(spread(True).select("h", "t").distinct(), "hot")
            centre = F.broadcast(hot.groupBy("h").agg(F.min("t").alias("src")))  # COMMON rows at most
            stars = hot.join(centre, "h").where("src <> t").select("src", F.col("t").alias("dst"), F.lit(True).alias("dense"))
            pairs = pairs.unionByName(stars)
        return pairs.groupBy("src", "dst").agg(F.max("dense").alias("dense"))

    def described(wanted: DataFrame, describe: Callable[[np.ndarray], bytes], label: str) -> DataFrame:
        """``t, n, d``: size and description of the texts in ``wanted``, once each; others are passed over in the scan."""
        wanted = materialize(wanted.distinct(), "wanted")
        marks = marks_of(wanted, "t", wanted.count())

        def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
            batch = batch.filter(pa.array(marked(marks, batch.column(1).to_numpy())))
            if not batch.num_rows:
                return None
            found = [(t, len(g), describe(g)) for t, g in _per_text(batch, shingle)]
            cols = [pa.array(c, kind) for c, kind in zip(zip(*found, strict=True), (pa.int64(), pa.int32(), pa.binary()), strict=True)]
            return pa.RecordBatch.from_arrays(cols, ["t", "n", "d"])

        rows = map_arrow(texts, run, "t bigint, n int, d binary")
        return materialize(rows.join(wanted, "t", "left_semi").dropDuplicates(["t"]), label)

    def ends_of(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.explode(F.array("src", "dst")).alias("t"))

    def with_both(pairs: DataFrame, side: DataFrame, column: Column) -> DataFrame:
        """``pairs`` with a column of both texts as ``x`` and ``y``."""
        left, right = (side.select(F.col("t").alias(end), column.alias(name)) for end, name in (("src", "x"), ("dst", "y")))
        return pairs.join(left, "src").join(right, "dst")

    def possible(batch: pa.RecordBatch) -> pa.RecordBatch:
        a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u8").reshape(-1, LONG) for c in (4, 5))
        n, m = (batch.column(c).to_numpy().astype(np.int64) for c in (2, 3))
        return batch.select(["src", "dst"]).filter(pa.array(may_link(n, a, m, b, least)))

    def likely(few: DataFrame) -> DataFrame:
        """Pairs that their sizes and long bitmaps do not drop."""
        sizes = described(ends_of(few), lambda g: parities(g, LONG).tobytes(), "sizes")
        seen = with_both(few, sizes, F.struct("n", "d"))
        seen = seen.select("src", "dst", F.col("x.n").alias("n"), F.col("y.n").alias("m"), F.col("x.d").alias("a"), F.col("y.d").alias("b"))
        return map_arrow(seen, possible, "src bigint, dst bigint")

    def meet(table: pa.Table) -> pa.Table:
        table = table.sort_by("t")
        t = table.column("t").to_numpy()
        a, b = close_texts(None, table.column("grams").to_pylist(), least)
        return pa.Table.from_pydict({"src": t[a], "dst": t[b]})

    def verify(batch: pa.RecordBatch) -> pa.RecordBatch:
        ok = [resemblance(x, y) >= least for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
        return batch.select(["src", "dst"]).filter(pa.array(ok, pa.bool_()))

    def linked() -> DataFrame:
        """Links of all kinds. Only sets of texts in a likely pair or a family are made and moved."""
        left = settle(spark, lambda: likely(pairs.where("NOT dense").select("src", "dst")), "possible")
        family = components(pairs.where("dense").select("src", "dst")).withColumnsRenamed({"node": "t", "component": "family"})
        family = materialize(family, "families")
        sets = described(ends_of(left).unionByName(family.select("t")), lambda g: np.unique((g >> np.uint64(32)).astype(HASH)).tobytes(), "sets")
        good = map_arrow(with_both(left, sets, F.col("d")).select("src", "dst", "x", "y"), verify, "src bigint, dst bigint")
        placed = sets.join(family, "t")
        most = F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("n") / (BLOCK * SKETCH))
        blocks = placed.groupBy("family").agg(F.ceil(most).cast("int").alias("blocks"))
        meets = F.expr(
            "explode(transform(filter(sequence(0, blocks - 1), o -> o <> block OR blocks = 1),"
            " o -> struct(least(block, o) AS x, greatest(block, o) AS y)))"
        )
        placed = placed.join(blocks, "family").withColumn("block", F.pmod(F.xxhash64("t"), "blocks").cast("int"))
        placed = placed.select("t", F.col("d").alias("grams"), "family", meets.alias("p")).select("t", "grams", "family", "p.x", "p.y")
        links = good.unionByName(placed.groupBy("family", "x", "y").applyInArrow(meet, "src bigint, dst bigint"))
        return links if distance is None else links.unionByName(_fingerprint_links(texts, distance, shingle))

    pairs = settle(spark, met, "pairs")
    links_of_texts = settle(spark, linked, "links")
    found = components(links_of_texts).withColumnsRenamed({"node": "t", "component": "group"})
    lows = src.groupBy("t").agg(F.min(KEY).alias("low"))
    member = materialize(lows.join(found, "t", "left").withColumn("group", F.coalesce("group", "t")), "member")
    low = member.groupBy("group").agg(F.min("low").alias("component"))
    return src.select(KEY, "t").join(member.join(low, "group").select("t", "group", "component"), "t")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each group of similar texts, the one of the smallest key; all columns stay.

    Of rows equal in key and text one stays. A group that has null keys only keeps one of its rows.
    """
    found = settle(docs.sparkSession, lambda: similar_groups(docs, key, text, **options), "groups")
    kept = found.where(F.col(KEY).eqNullSafe(F.col("component")))
    once = kept.groupBy(KEY, "t", "group").agg(F.count(F.lit(1)).alias("n"))
    # several texts of a group may carry its smallest key
    own, other, kept_text = (free_name(docs, c) for c in ("_text_no", "_kept_key", "_kept_text"))
    keep = once.groupBy("group", F.col(KEY).alias(other)).agg(F.min("t").alias(kept_text)).drop("group")
    out = docs.withColumn(own, F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit(""))))
    out = out.join(keep, F.col(f"`{key}`").eqNullSafe(F.col(other)) & (F.col(own) == F.col(kept_text)), "left_semi")
    if not once.where("n > 1").isEmpty():  # rows equal in key and text
        out = out.dropDuplicates([key, own])
    return out.drop(own)
