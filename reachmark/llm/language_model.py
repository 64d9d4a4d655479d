"""Language-model scores by a backoff automaton over corpus n-grams."""

from __future__ import annotations

import io
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reachmark.llm.common import KEY, TEXT, mix64
from reachmark.runtime import materialize

#: No word is empty or holds a blank.
END, BEGIN = b"", b" "


@dataclass(frozen=True)
class Automaton:
    """The part of the model that a block of documents needs.

    States are the words (and the start) as last word read, beneath them one root state.
    ``arcs`` has the weight of every arc from a state that was seen in training, by the
    arc's number; -inf where there is none. ``fail`` is the weight of a state's failure arc to
    the root, ``root`` that of the root's arc for a word. Weights are log10 probabilities.
    """

    arcs: np.ndarray
    fail: np.ndarray
    root: np.ndarray

    @classmethod
    def of(cls, states, words, pair_count, count, tokens, distinct, strength):
        """Smoothed weights: a state gives up strength / (count + strength) of its mass to the
        root, whose words have add-half probabilities; seen pairs take part of both."""
        root = (count + 0.5) / (tokens + 0.5 * (distinct + 1))
        seen = np.where(pair_count > 0, pair_count + strength * root[words], 0.0)
        with np.errstate(divide="ignore"):
            arcs = np.log10(seen / (count[states] + strength))
        return cls(arcs, np.log10(strength / (count + strength)), np.log10(root))

    def traverse(self, arc: np.ndarray, state: np.ndarray, word: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Log10 probability of every document, one pass from left to right.

        ``arc, state, word`` per token: the number of the arc it asks for, the state it is read
        in (the word before, which is the state any arc or failure led to) and itself.
        """
        step = self.arcs[arc]
        step = np.where(np.isneginf(step), self.fail[state] + self.root[word], step)
        return np.add.reduceat(step, np.concatenate(([0], ends[:-1]))) if len(ends) else np.zeros(0)


class Tokens:
    """Words of a block's documents as local numbers, and the distinct pairs among them."""

    def __init__(self, texts: list[bytes], learn: np.ndarray):
        known: dict[bytes, int] = {BEGIN: 0, END: 1}
        put = known.setdefault
        parts, sizes = [], []
        for t in texts:
            parts.append(np.array([put(w, len(known)) for w in t.lower().split()], np.int64))
            sizes.append(len(parts[-1]) + 1)
        self.sizes = np.array(sizes, np.int64)
        self.ends = np.cumsum(self.sizes)
        total = int(self.ends[-1]) if sizes else 0
        self.word, self.state = np.ones(total, np.int64), np.zeros(total, np.int64)
        for p, end, size in zip(parts, self.ends.tolist(), sizes, strict=True):
            self.word[end - size : end - 1] = p
            self.state[end - size + 1 : end] = p
        self.learn = np.repeat(learn, self.sizes)
        self.starts = int(learn.sum())
        h = xxhash.xxh64_intdigest
        self.hash = np.array([h(w) for w in known], np.uint64)

    def counts(self) -> np.ndarray:
        """Of every word in training documents; of the start, how many they are."""
        n = np.bincount(self.word[self.learn], minlength=len(self.hash))
        n[0] = self.starts
        return n

    def pairs(self, inverse: bool = False):
        """Distinct (state, word) pairs and their training counts, or else every token's pair number."""
        base = len(self.hash)
        code = self.state * base + self.word
        if inverse:
            keys, at = np.unique(code, return_inverse=True)
            return keys // base, keys % base, at
        code = np.sort(code * 2 + self.learn)
        first = np.flatnonzero(np.diff(code >> 1, prepend=-1))
        n = np.add.reduceat(code & 1, first) if len(first) else code
        keys = code[first] >> 1
        return keys // base, keys % base, n


def _zip(a: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(1).compress(a.tobytes())


def _unzip(b: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(b), kind)


def _blocks(src: DataFrame, block_bytes: int) -> DataFrame:
    """Documents packed into rows of about ``block_bytes`` of text, compressed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = np.cumsum([len(x or "") for x in batch.column(1).to_pylist()])
            cut = np.unique(np.searchsorted(size, np.arange(0, int(size[-1]) if len(size) else 0, block_bytes)))
            for a, b in zip(cut, [*cut[1:], batch.num_rows], strict=True):
                yield packed(batch.slice(a, b - a), int(size[b - 1] - (size[a - 1] if a else 0)))
            if len(size) and not len(cut):
                yield packed(batch, 0)

    def packed(part: pa.RecordBatch, size: int) -> pa.RecordBatch:
        sink = io.BytesIO()
        with pa.ipc.new_stream(sink, part.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
            w.write_batch(part)
        row = [[uuid.uuid4().hex], [size], [sink.getvalue()]]
        return pa.RecordBatch.from_arrays([pa.array(row[0]), pa.array(row[1], pa.int64()), pa.array(row[2], pa.binary())], ["block", "size", "data"])

    return src.mapInArrow(run, "block string, size bigint, data binary")


def _read(data: bytes) -> tuple[pa.Table, Tokens]:
    docs = pa.ipc.open_stream(data).read_all()
    texts = docs.column(TEXT).cast(pa.binary()).to_pylist()
    return docs, Tokens(texts, np.array(docs.column("learn").to_pylist(), bool))


def _asked(t: Tokens, shards: int, inverse: bool = False):
    """What a block asks about: per kind the keys and counts, dealt to shards in a fixed order."""
    s, w, extra = t.pairs(inverse)
    out = {}
    for kind, keys, n in (("word", t.hash, t.counts()), ("pair", mix64(t.hash[s], t.hash[w]), extra)):
        shard = (keys >> np.uint64(33)) % np.uint64(shards)
        order = np.argsort(shard, kind="stable")
        out[kind] = keys[order], n, order, np.searchsorted(shard[order], np.arange(shards + 1))
    return s, w, extra, out


def score_documents(
    docs: DataFrame,
    learn: Column,
    key: str = "doc_id",
    text: str = "text",
    strength: float = 4.0,
    block_bytes: int = 8 << 20,
) -> DataFrame:
    """``_key, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row.

    Words are runs of other than the six ASCII blanks, A-Z lower-cased, and each text ends with
    one end token. Documents where ``learn`` holds (null: it does) give the counts of words and
    pairs, all of them; every document is scored. Null and empty texts are just the end. Null and repeated keys and
    repeated rows give a row each, very long texts are taken whole, other columns are left out, an
    empty table gives no row.

    Documents are packed into blocks once. A block asks for its distinct words and pairs, by
    64-bit hash; shards of the key space sum what all blocks bring and answer in the order they
    were asked, so a frequent word costs a shard one number per block. Each block then
    builds its automaton from the answers and traverses its documents. No task holds more than
    a block or a shard, and shards grow in number with the text.
    """
    src = docs.select(
        F.col(f"`{key}`").alias(KEY), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias(TEXT), F.coalesce(learn, F.lit(True)).alias("learn")
    )
    kind = src.schema[KEY].dataType.simpleString()
    blocks = materialize(_blocks(src, block_bytes), "blocks")
    size = blocks.agg(F.sum("size")).first()[0] or 0
    shards = max(16, size // block_bytes)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                _, _, _, asked = _asked(_read(data)[1], shards)
                rows = [
                    (i, block, name, _zip(keys[a:b]), _zip(n[order[a:b]].astype(np.uint32)))
                    for name, (keys, n, order, edge) in asked.items()
                    for i, (a, b) in enumerate(zip(edge, edge[1:]))
                    if b > a
                ]
                columns = list(zip(*rows, strict=True))
                types = [pa.int32(), pa.string(), pa.string(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["shard", "block", "kind", "keys", "n"])

    def answer(table: pa.Table) -> pa.Table:
        begin = np.uint64(xxhash.xxh64_intdigest(BEGIN))
        out, total = [], [0, 0]
        shard = table.column("shard")[0].as_py()
        for name in ("word", "pair"):
            part = table.filter(pa.compute.equal(table.column("kind"), name))
            if not part.num_rows:
                continue
            keys = [_unzip(x, np.uint64) for x in part.column("keys").to_pylist()]
            flat = np.concatenate(keys)
            n = np.concatenate([_unzip(x, np.uint32) for x in part.column("n").to_pylist()]).astype(np.int64)
            order = np.argsort(flat, kind="stable")
            first = np.flatnonzero(np.concatenate(([True], np.diff(flat[order]) > 0)))
            sums = np.add.reduceat(n[order], first)
            if name == "word":
                mine = sums[flat[order][first] != begin]
                total = [int(mine.sum()), int((mine > 0).sum())]
            back = np.empty(len(flat), np.int64)
            back[order] = np.repeat(sums, np.diff(np.append(first, len(flat))))
            at = np.cumsum([0, *map(len, keys)])
            for block, a, b in zip(part.column("block").to_pylist(), at, at[1:]):
                out.append((block, shard, name, _zip(back[a:b].astype(np.uint64)), 0, 0))
        out.append((None, shard, "total", b"", *total))
        types = [pa.string(), pa.int32(), pa.string(), pa.binary(), pa.int64(), pa.int64()]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=["block", "shard", "kind", "n", "tokens", "distinct"])

    asked = blocks.select("block", "data").mapInArrow(ask, "shard int, block string, kind string, keys binary, n binary")
    answers = materialize(
        asked.groupBy("shard").applyInArrow(answer, "block string, shard int, kind string, n binary, tokens bigint, distinct bigint"), "answers"
    )
    sums = answers.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("n"), F.coalesce(F.sum("distinct"), F.lit(0)).alias("v")).first()
    tokens, distinct = sums["n"], sums["v"]

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        parts = []
        for data in left.column("data").to_pylist():
            docs, t = _read(data)
            s, w, at, mine = _asked(t, shards, inverse=True)
            got = {}
            for name, (keys, _, order, edge) in mine.items():
                flat = np.zeros(len(keys), np.int64)
                rows = right.filter(pa.compute.equal(right.column("kind"), name))
                for i, raw in zip(rows.column("shard").to_pylist(), rows.column("n").to_pylist(), strict=True):
                    flat[edge[i] : edge[i + 1]] = _unzip(raw, np.uint64)
                got[name] = np.empty(len(keys), np.int64)
                got[name][order] = flat
            model = Automaton.of(s, w, got["pair"], got["word"], tokens, distinct, strength)
            known = np.add.reduceat((got["word"][t.word] > 0).astype(np.int64), np.concatenate(([0], t.ends[:-1])))
            base = np.add.reduceat(model.root[t.word], np.concatenate(([0], t.ends[:-1])))
            full = model.traverse(at, t.state, t.word, t.ends)
            parts.append(
                pa.Table.from_arrays(
                    [docs.column(KEY), pa.compute.invert(docs.column("learn")), pa.array(t.sizes), pa.array(known),
                     pa.array(np.full(len(known), tokens, np.int64)), pa.array(base), pa.array(full)], names=names,
                )
            )
        return pa.concat_tables(parts) if parts else empty

    names = [KEY, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    schema = f"{KEY} {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    empty = pa.Table.from_pylist([], pa.schema([(n, pa.int64()) for n in names]))
    return (
        blocks.select("block", "data").groupBy("block")
        .cogroup(answers.where("kind <> 'total'").select("block", "shard", "kind", "n").groupBy("block"))
        .applyInArrow(score, schema)
    )
