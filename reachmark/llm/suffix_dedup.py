"""Removal of byte strings that occur earlier, by suffix sorting of what can repeat."""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reachmark.llm.common import byte_rows, free_name, map_arrow, mix64
from reachmark.llm.suffix_sort import sorted_suffixes
from reachmark.runtime import materialize, settle

#: Bytes whose hash picks and names an anchor.
GRAM = 32
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
#: Bytes that are hashed at a time, and ranges of strings that one task should sort.
SEGMENT = 1 << 19
SORTED = 50_000


def _gram_hashes(text: np.ndarray) -> np.ndarray:
    """Hash of the ``GRAM`` bytes from every place on; meaningless for the last ones."""
    w = np.zeros(len(text) + GRAM, np.uint64)
    w[: len(text)] = text
    for k in (1, 2, 4):
        w[:-k] |= w[k:] << np.uint64(8 * k)
    h = mix64(w[:-8], w[8:])
    return mix64(h[:-16], h[16:])[: len(text)]


def _sliding(a: np.ndarray, width: int, least) -> np.ndarray:
    """least (np.minimum or np.maximum) over a[i : i + width], for every i that has as many."""
    w = 1
    while w * 2 <= width:
        a = least(a[:-w], a[w:])
        w *= 2
    return least(a[: len(a) - (width - w)], a[width - w :]) if width > w else a


def _hashes_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes over all texts in a row, the last of all where a gram would leave its text; starts."""
    starts = np.cumsum([0, *map(len, texts)])
    h = _gram_hashes(np.frombuffer(b"".join(texts), np.uint8))
    for end, start in zip(starts[1:].tolist(), starts[:-1].tolist(), strict=True):
        h[max(start, end - GRAM + 1) : end] = _NONE
    return h, starts


def anchors(texts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, place, hash) of places whose hash is the least of a string of ``length`` bytes.

    Equal strings have their anchors at equal places, so a string that occurs twice has an
    anchor whose hash occurs twice.
    """
    h, starts = _hashes_of(texts)
    width = length - GRAM + 1
    if len(h) < width:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    low = _sliding(h, width, np.minimum)
    pad = np.zeros(width - 1, np.uint64)
    high = _sliding(np.concatenate((pad, low, pad)), width, np.maximum)
    at = np.flatnonzero((h == high) & (h != _NONE))
    doc = np.searchsorted(starts, at, "right") - 1
    return doc, at - starts[doc], h[at]


def segments(texts: list[bytes], length: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """Groups of (text number, place, bytes) of about ``SEGMENT`` bytes. Longer texts are cut so
    that every string of ``length`` bytes lies in one cut."""
    group, size = [], 0
    for i, text in enumerate(texts):
        for at in range(0, max(1, len(text) - length + 1), SEGMENT):
            part = text[at : at + SEGMENT + length - 1]
            if size + len(part) > SEGMENT and group:
                yield group
                group, size = [], 0
            group.append((i, at, part))
            size += len(part)
    if group:
        yield group


def contexts(text: bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, first, last): strings of ``length`` bytes by their leftmost least hash.

    The strings that start at first..last share an anchor; each string is in one such range.
    """
    n = len(text) - length + 1
    if n < 1:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    h = _gram_hashes(np.frombuffer(text, np.uint8))[: len(text) - GRAM + 1]
    value, index = h, np.arange(len(h))

    def join(a, b, i, j):
        right = b < a
        return np.where(right, b, a), np.where(right, j, i)

    width, w = length - GRAM + 1, 1
    while w * 2 <= width:
        value, index = join(value[:-w], value[w:], index[:-w], index[w:])
        w *= 2
    if width > w:
        k = width - w
        value, index = join(value[:-k], value[k:], index[:-k], index[k:])
    first = np.flatnonzero(np.concatenate(([True], index[1:] != index[:-1])))
    return value[first], first, np.append(first[1:], n) - 1


def repeated_windows(order: Callable[[], np.ndarray], strings: Iterator[bytes], length: int) -> np.ndarray:
    """(row, first, last) of strings that occur in an earlier place among the rows.

    ``strings``: per row the bytes of a range of strings; ``order``, called when all are read,
    gives what tells which row is earlier, one row per column, the last line first. All go into one text in a file, sorted
    by suffixes; where neighbours share ``length`` characters, all but the earliest are repeats.
    """
    with tempfile.TemporaryFile() as f:  # mapped, not held
        starts = [0]
        for text in strings:
            f.write(text + b"\0")
            starts.append(f.tell())
        f.flush()
        if len(starts) == 1:
            return np.zeros((0, 3), np.int64)
        text = np.memmap(f, np.uint8, "r")
        begin = np.array(starts[:-1])
        size = np.diff(starts) - 1
        rank = np.empty(len(begin), np.int64)
        rank[np.lexsort(order())] = np.arange(len(begin))
        marked, group = [np.zeros((2, 0), np.int64)], 0
        held = [np.zeros((2, 0), np.int64)]

        def close(g: np.ndarray, p: np.ndarray) -> None:
            if len(g):
                first = np.flatnonzero(np.concatenate(([True], g[1:] != g[:-1])))
                row = np.searchsorted(begin, p, "right") - 1
                when = rank[row] << 32 | (p - begin[row])
                low = np.repeat(np.minimum.reduceat(when, first), np.diff(np.append(first, len(g))))
                marked.append(np.stack((row, p - begin[row]))[:, when != low])

        for at, shared in sorted_suffixes(text, length):
            g = group + np.cumsum(shared < length)
            group = int(g[-1])
            row = np.searchsorted(begin, at, "right") - 1
            whole = at - begin[row] + length <= size[row]
            held.append(np.stack((g[whole], at[whole])))
            if sum(x.shape[1] for x in held) > 1 << 20:
                g, p = np.concatenate(held, axis=1)
                cut = int(np.searchsorted(g, g[-1]))  # the last group may go on
                close(g[:cut], p[:cut])
                held = [np.stack((g[cut:], p[cut:]))]
        close(*np.concatenate(held, axis=1))
    row, off = np.concatenate(marked, axis=1)
    by = np.lexsort((off, row))
    row, off = row[by], off[by]
    new = np.flatnonzero(np.concatenate(([True], (row[1:] != row[:-1]) | (off[1:] != off[:-1] + 1)))) if len(row) else np.zeros(0, int)
    last = np.append(new[1:], len(row)) - 1 if len(row) else new
    return np.stack((row[new], off[new], off[last]), axis=1)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching spans as one, in order."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def cut(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The bytes outside the spans."""
    edges = [0, *(x for s in spans for x in s), len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))


class Repeats:
    """What repeats in the texts of ``docs``.

    ``rows``: ``doc, t, size, copy, sha`` for every row: its order key, the number of its text,
    its bytes, whether the same text occurs before it, and its digest.
    ``texts``: ``doc, t, text`` of the first rows of texts that may share a string, once each.
    ``spans``: ``doc, t, a, b``: byte ranges of those covered by strings that occur earlier.
    """

    def __init__(self, docs: DataFrame, key: str, text: str, length: int):
        if length <= GRAM:
            raise ValueError(f"strings must be longer than {GRAM} bytes")
        value = F.coalesce(F.col(f"`{text}`"), F.lit(""))
        keyed = docs.select(
            F.coalesce(F.col(f"`{key}`").cast("bigint"), F.lit(-(1 << 63))).alias("doc"), F.xxhash64(value).alias("t"), value.alias("text")
        )
        # equal texts: the first row stands for all
        ids = materialize(keyed.select("doc", "t", F.octet_length("text").cast("bigint").alias("size"), F.sha2("text", 256).alias("sha")), "rows")
        first = ids.groupBy("sha").agg(F.min("doc").alias("first"), F.count(F.lit(1)).alias("n"))
        # of rows with one key and one text, only one is no copy
        self.rows = ids.join(first, "sha").withColumn("copy", F.col("doc") > F.col("first")).select("doc", "t", "size", "sha", "copy", "first", "n")
        starts = ids.groupBy("sha", "t").agg(F.min("doc").alias("doc")).select("doc", "t")

        def find(batch: pa.RecordBatch) -> pa.RecordBatch:
            # copies within the batch bring nothing new
            number = batch.column(0).to_numpy(zero_copy_only=False)
            _, once = np.unique(number, return_index=True)
            texts = byte_rows(batch.column(1).take(pa.array(once)))
            out = [[np.zeros(0, np.int64)] for _ in range(3)]
            for group in segments(texts, length):
                part, at, h = anchors([g[2] for g in group], length)
                place = np.array([g[1] for g in group])[part] + at
                # a text names each anchor once, and tells whether it has it more than once
                order = np.lexsort((place, part, h))
                h, part, place = h[order], part[order], place[order]
                first = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (part[1:] != part[:-1])))) if len(h) else order
                many = np.diff(np.append(first, len(h))) > 1
                whose = number[once][np.array([g[0] for g in group])[part[first]]]
                for o, v in zip(out, (h[first].view(np.int64), whose, np.where(many, -1, place[first])), strict=True):
                    o.append(v)
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(o)) for o in out], ["h", "t", "at"])

        def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """Anchors whose hash has two different places; runs may cross batches."""
            rest = None
            for batch in batches:
                if not batch.num_rows:
                    continue
                new = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
                rest = new if rest is None else [np.concatenate(x) for x in zip(rest, new, strict=True)]
                last = int(np.searchsorted(rest[0], rest[0][-1]))
                yield pick([x[:last] for x in rest])
                rest = [x[last:] for x in rest]
                if len(rest[0]) > 1 << 16:  # one hash all along: passed on, but for its last two places
                    h, t, at = rest
                    other = (t != t[0]) | (at != at[0]) | (at < 0)
                    if other.any():
                        keep = [0, int(np.flatnonzero(other)[0])]
                        yield pick(rest)
                        rest = [x[keep] for x in rest]
                    else:
                        rest = [x[:1] for x in rest]
            if rest is not None:
                yield pick(rest)

        def pick(part: list[np.ndarray]) -> pa.RecordBatch:
            h, t, at = part
            if len(h):
                edge = np.concatenate(([True], h[1:] != h[:-1]))
                run = np.cumsum(edge) - 1
                first = np.flatnonzero(edge)
                differs = (t != t[first][run]) | (at != at[first][run]) | (at < 0)
                many = np.bincount(run, differs) > 0
                h, t, at = h[many[run]], t[many[run]], at[many[run]]
            return pa.RecordBatch.from_arrays([pa.array(t), pa.array(h)], ["t", "h"])

        found = map_arrow(keyed.select("t", "text"), find, "h bigint, t bigint, at bigint").repartition("h").sortWithinPartitions("h")
        wanted = found.mapInArrow(shared, "t bigint, h bigint").groupBy("t").agg(F.collect_set("h").alias("hs"))
        chosen = wanted.join(starts, "t")
        held = keyed.join(chosen, ["doc", "t"]).groupBy("doc", "t").agg(F.first("text").alias("text"), F.first("hs").alias("hs"))
        self.texts = materialize(held, "repeats")
        self.spans = settle(docs.sparkSession, lambda: self._spans(length), "spans")

    def _spans(self, length: int) -> DataFrame:
        def ranges(batch: pa.RecordBatch) -> pa.RecordBatch:
            """Ranges of strings at shared anchors, with two hashes of what they hold."""
            out = [[] for _ in range(7)]
            for doc, t, text, hs in zip(*(batch.column(i).to_pylist() if i != 2 else byte_rows(batch.column(2)) for i in range(4)), strict=True):
                parts = [(g[1], *contexts(g[2], length)) for group in segments([text], length) for g in group]
                h, a, b = (np.concatenate([p[1] if c == 1 else p[c] + p[0] for p in parts]) for c in (1, 2, 3))
                mine = np.isin(h.view(np.int64), np.array(hs, np.int64))
                h, a, b = h[mine].view(np.int64), a[mine], b[mine]
                raw = [hashlib.blake2b(text[x : y + length], digest_size=16).digest() for x, y in zip(a.tolist(), b.tolist(), strict=True)]
                both = np.frombuffer(b"".join(raw), np.int64).reshape(-1, 2)
                for o, v in zip(out, (h, both[:, 0], both[:, 1], np.full(len(a), doc), np.full(len(a), t), a, b), strict=True):
                    o.append(v)
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(o).astype(np.int64)) for o in out], names)

        names = ["h", "x", "y", "doc", "t", "a", "b"]
        every = materialize(map_arrow(self.texts, ranges, ", ".join(f"{n} bigint" for n in names)), "ranges")
        place = F.struct("doc", "t", "a", "b")
        firsts = materialize(every.groupBy("h", "x", "y").agg(F.min(place).alias("p")), "firsts")
        again = (
            every.join(firsts, ["h", "x", "y"]).where(place != F.col("p")).select("doc", "t", "a", (F.col("b") + length).alias("b"))
        )
        # anchors with ranges that differ: their strings are compared one by one
        hard = firsts.groupBy("h").count().where("count > 1").select("h")
        asked = materialize(firsts.join(hard, "h").select("p.doc", "p.t", "h", F.struct("p.a", "p.b").alias("r")), "asked")
        ranges_to_sort = asked.count()
        asked = asked.groupBy("doc", "t").agg(F.collect_list(F.struct("h", "r")).alias("rs"))

        def texts(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = []
            for doc, t, text, rs in zip(*(batch.column(i).to_pylist() if i != 2 else byte_rows(batch.column(2)) for i in range(4)), strict=True):
                rows += [(r["h"], doc, t, r["r"]["a"], text[r["r"]["a"] : r["r"]["b"] + length]) for r in rs]
            types = [pa.int64()] * 4 + [pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), types, strict=True)], ["h", "doc", "t", "a", "text"])

        def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            keys = [np.zeros((3, 0), np.int64)]

            def strings() -> Iterator[bytes]:
                for batch in batches:
                    keys.append(np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2, 3)]))
                    yield from byte_rows(batch.column(4))

            found = repeated_windows(lambda: np.concatenate(keys, axis=1)[::-1], strings(), length)
            doc, t, a = np.concatenate(keys, axis=1)
            r = found[:, 0]
            columns = (doc[r], t[r], a[r] + found[:, 1], a[r] + found[:, 2] + length)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["doc", "t", "a", "b"])

        strings = map_arrow(self.texts.select("doc", "t", "text").join(asked, ["doc", "t"]), texts, "h bigint, doc bigint, t bigint, a bigint, text binary")
        tasks = max(int(self.texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), ranges_to_sort // SORTED)
        part = strings.repartition(tasks, "h").mapInArrow(sort, "doc bigint, t bigint, a bigint, b bigint")
        return again.unionByName(part).select("doc", "t", F.struct("a", "b").alias("s")).groupBy("doc", "t").agg(F.collect_list("s").alias("spans"))


def _spans_of(value) -> list[tuple[int, int]]:
    return merged([(s["a"], s["b"]) for s in value or []])


def repeat_digests(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = 100) -> DataFrame:
    """``doc, n_bytes, n_removed, n_spans, kept_sha256`` for every row of ``docs`` (integer keys).

    A byte is removed if a string of ``length`` bytes covers it that also starts earlier: in a
    row with a smaller key, or in the same row before. Rows with one key are ordered by a hash
    of their text, a row that equals another is a copy of it (all but the first are removed
    whole, if ``length`` bytes long). Null texts are empty; null keys come first, and return
    as the smallest integer. Strings never cross rows, and are judged on the input.
    """
    found = Repeats(docs, key, text, length)

    def digest(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, spans = byte_rows(batch.column(2)), [_spans_of(s) for s in batch.column(3).to_pylist()]
        kept = [cut(x, s) for x, s in zip(texts, spans, strict=True)]
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0), batch.column(1),
                pa.array([len(x) - len(k) for x, k in zip(texts, kept, strict=True)], pa.int64()),
                pa.array(list(map(len, spans)), pa.int64()),
                pa.array([hashlib.sha256(k).hexdigest() for k in kept]),
            ],
            ["doc", "t", "removed", "spans", "kept"],
        )

    part = map_arrow(found.texts.select("doc", "t", "text").join(found.spans, ["doc", "t"]), digest, "doc bigint, t bigint, removed bigint, spans bigint, kept string")
    # of n equal rows with one key, one is the first
    rank = F.row_number().over(Window.partitionBy("doc", "sha").orderBy("t"))
    rows = found.rows.withColumn("copy", F.col("copy") | ((F.col("n") > 1) & (rank > 1)))
    gone = F.col("copy") & (F.col("size") >= length)
    return rows.join(part, ["doc", "t"], "left").select(
        "doc",
        F.col("size").alias("n_bytes"),
        F.when(gone, F.col("size")).when(F.col("copy"), 0).otherwise(F.coalesce("removed", F.lit(0))).alias("n_removed"),
        F.when(gone, F.lit(1)).when(F.col("copy"), 0).otherwise(F.coalesce("spans", F.lit(0))).cast("bigint").alias("n_spans"),
        F.when(gone, F.sha2(F.lit(""), 256)).when(F.col("copy"), F.col("sha")).otherwise(F.coalesce("kept", F.col("sha"))).alias("kept_sha256"),
    )


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = 100, size: str | None = None) -> DataFrame:
    """``docs`` without the bytes that ``repeat_digests`` counts as removed.

    Rows stay, also those left empty; characters that lose some of their bytes go whole.
    ``size``: a column to hold the new number of characters. Other columns stay, null texts too.
    Rows equal in key and text are copies of each other and all keep what the first keeps.
    """
    own, number, cuts, lost = (free_name(docs, c) for c in ("_doc", "_t", "_spans", "_gone"))

    def found() -> DataFrame:
        repeats = Repeats(docs, key, text, length)
        copies = repeats.rows.where(F.col("copy") & (F.col("size") >= length)).select("doc", "t", F.lit(True).alias(lost)).distinct()
        return repeats.spans.withColumnRenamed("spans", cuts).join(copies, ["doc", "t"], "full")

    marks = settle(docs.sparkSession, found, "marks")
    columns = docs.columns
    marked = docs.withColumns(
        {own: F.coalesce(F.col(f"`{key}`").cast("bigint"), F.lit(-(1 << 63))), number: F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit("")))}
    ).join(marks.withColumnsRenamed({"doc": own, "t": number}), [own, number], "left")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        at = batch.schema.get_field_index(text)
        spans = batch.column(batch.schema.get_field_index(cuts)).to_pylist()
        gone = batch.column(batch.schema.get_field_index(lost)).to_pylist()
        new = []
        for raw, s, g in zip(byte_rows(batch.column(at)), spans, gone, strict=True):
            keep = raw if raw is None or not (s or g) else b"" if g else cut(raw, _spans_of(s))
            new.append(None if keep is None else keep.decode("utf-8", "ignore"))
        out = batch.select(columns)
        place = out.schema.get_field_index(text)
        out = out.set_column(place, out.schema.field(place), pa.array(new, out.schema.field(place).type))
        if size:
            n = out.schema.get_field_index(size)
            out = out.set_column(n, out.schema.field(n), pa.array([None if x is None else len(x) for x in new], out.schema.field(n).type))
        return out

    return map_arrow(marked.select(*[f"`{c}`" for c in columns], cuts, lost), run, docs.schema)
