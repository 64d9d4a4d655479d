"""Alignment of two tokenizers over the same bytes, and how many documents link each id pair.

Tokens of both sides end at byte offsets. Offsets where both sides end cut the bytes into
groups; every token of one side is linked with every token of the other side in its group.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reachmark.llm.common import KEY, keyed_texts
from reachmark.llm.tokens import byte_level_tokens, encoder
from reachmark.runtime import materialize, spread

#: Bytes of text that make a block: a block's distinct pairs are asked for once.
BLOCK_BYTES = 4 << 20
#: Bytes of text that are aligned at once.
SLICE_BYTES = 1 << 20
#: A group with more links than this is counted by its distinct ids, not link by link.
WIDE_GROUP = 256
#: Of so many searches side by side one goes first, and the others start where it ended.
STRIDE = 4
#: Numbers whose strings are written at once.
SPELLED = 1 << 16


def gallop(short: np.ndarray, long: np.ndarray, start: np.ndarray) -> np.ndarray:
    """First index in ``long`` whose value is at least each value of ``short``; both lists rise.

    Searches go side by side: each doubles its step from its start until it passes its
    value, then halves the range it has found. Every ``STRIDE``-th search goes first, in the same way;
    the others start where the one before them ended, so they take few steps in a list of any length.
    """
    n = len(long)
    if len(short) > STRIDE:
        first = gallop(short[::STRIDE], long, start[::STRIDE])
        start = np.maximum(start, np.repeat(first, STRIDE)[: len(short)])
    low, step, high = start.copy(), np.ones(len(short), np.int64), start.copy()
    active = np.arange(len(short))
    while len(active):
        at = np.minimum(high[active], n - 1)
        behind = (high[active] < n) & (long[at] < short[active])
        active = active[behind]
        low[active] = high[active] + 1
        high[active] += step[active]
        step[active] *= 2
    high = np.minimum(high, n)
    active = np.flatnonzero(low < high)
    while len(active):
        middle = (low[active] + high[active]) >> 1
        behind = long[middle] < short[active]
        low[active[behind]] = middle[behind] + 1
        high[active[~behind]] = middle[~behind]
        active = active[low[active] < high[active]]
    return low


def common_ends(a: np.ndarray, b: np.ndarray, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indexes in two rising lists of the values that both hold.

    ``parts`` holds per text the number of entries of ``a`` and of ``b``. The shorter list
    of each text drives the search into the longer one. Values rise over all texts.
    """
    stop = np.cumsum(parts, axis=0)
    begin = stop - parts
    out = []
    for drive, x, y in ((0, a, b), (1, b, a)):
        mine = (parts[:, 0] <= parts[:, 1]) == (drive == 0)
        chosen = np.repeat(mine, parts[:, drive])
        index = np.flatnonzero(chosen)
        found = gallop(x[index], y, np.repeat(begin[mine, 1 - drive], parts[mine, drive]))
        hit = (found < len(y)) & (y[np.minimum(found, len(y) - 1)] == x[index]) if len(y) else np.zeros(len(index), bool)
        out.append((index[hit], found[hit]) if drive == 0 else (found[hit], index[hit]))
    left, right = (np.concatenate(z) for z in zip(*out, strict=True))
    order = np.argsort(left, kind="stable")
    return left[order], right[order]


def linked_pairs(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct linked id pairs of one text, as ``a * width + b``, and their numbers of links.

    ``na``, ``nb``: tokens per group. Wide groups multiply the counts of their distinct ids, so
    that repeated tokens cost no memory per link.
    """
    links = na * nb
    sa, sb = np.cumsum(na) - na, np.cumsum(nb) - nb
    keys = []
    one = links == 1
    keys.append(a[sa[one]] * width + b[sb[one]])
    more = np.flatnonzero(~one & (links <= WIDE_GROUP))
    if len(more):
        g = np.repeat(more, links[more])
        k = np.arange(len(g)) - np.repeat(np.cumsum(links[more]) - links[more], links[more])
        keys.append(a[sa[g] + k // nb[g]] * width + b[sb[g] + k % nb[g]])
    wide = np.flatnonzero(links > WIDE_GROUP).tolist()
    if not wide:
        return np.unique(np.concatenate(keys), return_counts=True)
    times = [np.ones(len(k), np.int64) for k in keys]
    for g in wide:
        x, cx = np.unique(a[sa[g] : sa[g] + na[g]], return_counts=True)
        y, cy = np.unique(b[sb[g] : sb[g] + nb[g]], return_counts=True)
        keys.append((x[:, None] * width + y).ravel())
        times.append((cx[:, None] * cy).ravel())
    found, where = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.zeros(len(found), np.int64)
    np.add.at(total, where, np.concatenate(times))
    return found, total


class Spellings:
    """Byte strings by number; the strings of a run of numbers are copied from one array."""

    def __init__(self, strings: list[bytes]):
        self.size = np.array(list(map(len, strings)), np.int64)
        self.begin = np.cumsum(self.size) - self.size
        self.all = np.frombuffer(b"".join(strings), np.uint8)

    def write(self, numbers: np.ndarray) -> bytes:
        """The strings of all numbers in a row."""
        out = []
        for k in range(0, len(numbers), SPELLED):
            some = numbers[k : k + SPELLED]
            size = self.size[some]
            place = np.repeat(self.begin[some] - (np.cumsum(size) - size), size)
            place += np.arange(len(place))
            out.append(self.all[place].tobytes())
        return b"".join(out)

    def spell(self, ids: list[np.ndarray], texts: list[bytes]) -> list[bool]:
        """Whether the strings of each list of ids are its text."""
        numbers, most = np.concatenate(ids), np.cumsum(list(map(len, ids)))
        ends = np.concatenate(([0], np.cumsum(self.size[numbers])))[np.concatenate(([0], most))].tolist()
        held = self.write(numbers)
        return [held[s:e] == text for s, e, text in zip(ends, ends[1:], texts)]


class Aligner:
    """Both tokenizers of a worker, and the bytes of their tokens."""

    def __init__(self, byte_path: str, piece_path: str):
        import sentencepiece

        tokens = byte_level_tokens(byte_path)
        if tokens is None:
            raise ValueError(f"{byte_path} is no byte-level vocabulary")
        self.bpe = encoder(byte_path, True)
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        self.width = self.pieces.get_piece_size()
        self.a = Spellings([tokens.get(i, b"") for i in range(max(tokens) + 1)])
        self.b = Spellings(
            [
                bytes([int(p[3:5], 16)]) if self.pieces.is_byte(i) else p.replace("▁", " ").encode()
                for i in range(self.width)
                for p in [self.pieces.id_to_piece(i)]
            ]
        )
        self.n = max(len(self.a.size), self.width)
        # a written group list is a run of ids, each with the mark behind it
        self.written = Spellings([f"{i}{mark}".encode() for mark in ",|;" for i in range(self.n)])

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of both sides; none where the bytes are not a blank and the text."""
        none = np.zeros(0, np.int64)
        wholes = [b" " + text.encode() if text else b"" for text in texts]
        left = [self.bpe.encode(" " + text).astype(np.int64) if text else none for text in texts]
        right = [np.array(ids, np.int64) if text else none for text, ids in zip(texts, self.pieces.encode(texts, num_threads=1), strict=True)]
        same = [x and y for x, y in zip(self.a.spell(left, wholes), self.b.spell(right, wholes), strict=True)]
        return tuple([x if ok else none for x, ok in zip(side, same, strict=True)] for side in (left, right))

    def align(self, texts: list[str]) -> list[tuple]:
        """Per text: both id lists, and tokens per group on both sides."""
        left, right = self.encode(texts)
        a, b = np.concatenate(left), np.concatenate(right)
        parts = np.array([(len(x), len(y)) for x, y in zip(left, right, strict=True)], np.int64)
        i, j = common_ends(np.cumsum(self.a.size[a]), np.cumsum(self.b.size[b]), parts)
        na, nb = np.diff(i, prepend=-1), np.diff(j, prepend=-1)
        # every text ends in a common end, so its groups are those up to its last token
        cut = np.searchsorted(i, np.cumsum(parts[:, 0]) - 1, side="right")
        begin = np.concatenate(([0], cut[:-1]))
        return [(x, y, na[s:e], nb[s:e]) for x, y, s, e in zip(left, right, begin, cut, strict=True)]

    def written_groups(self, a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> bytes:
        """``a1,a2|b1;a3|b2,b3``: ids of both sides by group."""
        if not len(na):
            return b""
        out = np.empty(len(a) + len(b), np.int64)
        ends_a, ends_b = np.cumsum(na), np.cumsum(nb)
        mark_a, mark_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        mark_a[ends_a - 1], mark_b[ends_b - 1] = 1, 2
        out[np.arange(len(a)) + np.repeat(ends_b - nb, na)] = a + mark_a * self.n
        out[np.arange(len(b)) + np.repeat(ends_a, nb)] = b + mark_b * self.n
        return self.written.write(out)[:-1]


@lru_cache(maxsize=2)
def aligner(byte_path: str, piece_path: str) -> Aligner:
    """One pair of tokenizers per worker."""
    return Aligner(byte_path, piece_path)


def _runs(sizes: list[int], most: int) -> list[tuple[int, int]]:
    """Ranges of texts of about ``most`` bytes; a longer text shares its range with few."""
    number = np.cumsum(sizes) // most
    cuts = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), len(sizes)]
    return [(s, e) for s, e in zip(cuts[:-1], cuts[1:], strict=True) if e > s]


def align_documents(
    docs: DataFrame, byte_path: str, piece_path: str, key: str = "doc_id", text: str = "text", with_groups: bool = True
) -> DataFrame:
    """Per row of ``docs`` its alignment, in one narrow pass.

    ``_key, n_a, n_b, n_groups, n_links, groups_sha256``, with ``groups`` if asked for (written
    as ``a1,a2|b1;a3|b2``), and
    ``_block, pairs array<bigint>, times array<bigint>``: distinct linked id pairs and their
    links; an id pair is written ``a * pieces + b``. Null, empty and very long texts, repeated rows and
    null keys give one row each; null and empty ones, and texts that a tokenizer does not
    spell back byte by byte, have no tokens. Other columns are left out.
    """
    src = spread(keyed_texts(docs, key, text))
    kind = src.schema[KEY].dataType.simpleString()
    names = [KEY, "_block", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times", *(["groups"] if with_groups else [])]
    types = [kind, "string", *["bigint"] * 4, "string", "array<bigint>", "array<bigint>", "string"]
    schema = ", ".join(f"{n} {t}" for n, t in zip(names, types))

    def rows_of(texts: pa.Array, block: str) -> list[pa.Array]:
        both, rows = aligner(byte_path, piece_path), []
        for a, b, na, nb in both.align(texts.to_pylist()):
            pairs, times = linked_pairs(a, b, na, nb, both.width)
            groups = both.written_groups(a, b, na, nb)
            digest = hashlib.sha256(groups).hexdigest() if groups else ""
            rows.append((block, len(a), len(b), len(na), int((na * nb).sum()), digest, pairs, times, *([groups.decode()] if with_groups else [])))
        cols = list(zip(*rows, strict=True))
        offsets = pa.array(np.concatenate(([0], np.cumsum([len(p) for p in cols[6]]))).astype(np.int32))
        arrays = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(c))) for c in cols[6:8]]
        plain = [pa.array(cols[0]), *[pa.array(c, pa.int64()) for c in cols[1:5]], pa.array(cols[5])]
        return [*plain, *arrays, *[pa.array(c) for c in cols[8:]]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            sizes = [len(t) for t in texts.to_pylist()]
            for start, end in _runs(sizes, BLOCK_BYTES):
                block = uuid.uuid4().hex
                for s, e in _runs(sizes[start:end], SLICE_BYTES):
                    part = batch.slice(start + s, e - s)
                    yield pa.RecordBatch.from_arrays([part.column(0), *rows_of(part.column(1), block)], names)

    return src.mapInArrow(run, schema)


def pair_counts(aligned: DataFrame, width: int) -> DataFrame:
    """``pair, n, best``: documents that hold a pair linked, and whether no pair of its left id has more.

    Rows are counted within tasks before the shuffle. A left id has at most ``width`` pairs.
    """
    counted = aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n"))
    of_id = Window.partitionBy(F.expr(f"pair div {width}"))
    return counted.withColumn("best", F.col("n") == F.max("n").over(of_id))


def link_scores(docs: DataFrame, byte_path: str, piece_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: ``_key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.

    ``n_best``: links whose pair is in as many documents as any pair of its left id;
    ``count_sum``: documents of the pair, summed over links. Alignments are stored once. Each
    block of documents asks for its distinct pairs, so that a pair that all documents hold
    comes once per block to the join, and the answers go back to the block's rows. Edge cases are
    those of ``align_documents``; an empty table gives no row.
    """
    width = aligner(byte_path, piece_path).width
    stored = materialize(align_documents(docs, byte_path, piece_path, key, text, with_groups=False), "aligned")
    counts = materialize(pair_counts(stored, width), "pairs")
    asked = stored.select("_block", F.explode("pairs").alias("pair")).groupBy("_block", "pair").agg(F.lit(1).alias("_"))
    answers = asked.join(counts, "pair").select(F.col("_block").alias("_asker"), "pair", "n", "best")
    kind = stored.schema[KEY].dataType.simpleString()
    names = [KEY, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    schema = f"{KEY} {kind}, " + ", ".join(f"{c} bigint" for c in names[1:-1]) + ", groups_sha256 string"

    def run(rows: pa.Table, answers: pa.Table) -> pa.Table:
        pair = answers.column("pair").to_numpy()
        order = np.argsort(pair, kind="stable")
        pair, n = pair[order], answers.column("n").to_numpy()[order]
        best = answers.column("best").to_numpy()[order]
        pairs = [np.asarray(p, np.int64) for p in rows.column("pairs").to_numpy()]
        times = [np.asarray(t, np.int64) for t in rows.column("times").to_numpy()]
        n_best, total = [], []
        for p, t in zip(pairs, times, strict=True):
            at = np.searchsorted(pair, p)
            n_best.append(int(t[best[at]].sum()) if len(p) else 0)
            total.append(int((t * n[at]).sum()) if len(p) else 0)
        out = rows.append_column("n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(total, pa.int64()))
        return out.select(names)

    return stored.groupBy("_block").cogroup(answers.groupBy("_asker")).applyInArrow(run, schema)
