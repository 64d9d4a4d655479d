"""Byte-level BPE by a perfect hash of the vocabulary and, for the rest, a heap over linked bytes."""

from __future__ import annotations

import base64
import hashlib
import heapq
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame

from reachmark.llm.common import KEY, blank_chunks, keyed_texts, map_arrow

#: Distinct pieces and pre-tokens whose ids a worker remembers; beyond it starts anew.
REMEMBERED = 400_000


class PerfectHash:
    """Minimal perfect hash over distinct byte strings: string ``i`` of n is the only one in its slot.

    Keys fall into small buckets; buckets are placed from the largest on, each with the first
    displacement that sends all its keys to free slots. The slot holds the key's number, and
    the key itself is compared, so that strings from outside are told apart.
    """

    def __init__(self, keys: list[bytes]):
        self.keys, n = keys, len(keys)
        self.buckets = max(1, n // 2)
        h = np.array([xxhash.xxh3_64_intdigest(k) for k in keys], np.uint64)
        bucket = (h % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        ends = np.searchsorted(bucket[order], np.arange(self.buckets + 1))
        self.shift = [0] * self.buckets
        self.slot = [-1] * n
        free = 0
        for b in sorted(range(self.buckets), key=lambda b: ends[b] - ends[b + 1]):
            members = order[ends[b] : ends[b + 1]].tolist()
            hs = [int(h[i]) for i in members]
            if len(members) < 2:
                if members:  # a lone key gets any free slot, noted as a negative displacement
                    while self.slot[free] >= 0:
                        free += 1
                    self.shift[b], self.slot[free] = -1 - free, members[0]
                continue
            d = 0
            while len(at := {self.place(x, d) for x in hs}) < len(hs) or any(self.slot[s] >= 0 for s in at):
                d += 1
            self.shift[b] = d
            for i, x in zip(members, hs, strict=True):
                self.slot[self.place(x, d)] = i

    def find(self, key: bytes) -> int:
        """The number of ``key``, or -1."""
        if not self.keys:
            return -1
        x = xxhash.xxh3_64_intdigest(key)
        i = self.slot[self.place(x, self.shift[x % self.buckets])]
        return i if self.keys[i] == key else -1

    def place(self, x: int, d: int) -> int:
        """The slot of hash ``x`` under displacement ``d``."""
        return -1 - d if d < 0 else ((x + d * (x >> 19 | 1)) & 0xFFFFFFFFFFFFFFFF) % len(self.keys)


class RankedBpe:
    """Byte-level BPE by the ranks of a vocabulary file."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.tokens = list(ranks)
        self.ids = [ranks[t] for t in self.tokens]
        self.hash = PerfectHash(self.tokens)
        self.bytes_of = dict(zip(self.ids, self.tokens, strict=True))
        self.memo: dict[str, bytes] = {}
        self.words: dict[str, list[int]] = {}

    def merge(self, word: bytes) -> list[int]:
        """Ids of a pre-token that is no vocabulary entry.

        Bytes form a linked list; the heap holds adjacent pairs by rank, then place. A pair
        whose ends have changed since is skipped.
        """
        n = len(word)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        end = list(range(1, n + 1))  # where the part that starts here ends; 0: merged away
        rank = self.ranks.get
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank(word[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = after[i] if end[i] else n
            if j >= n or end[j] != stop:
                continue
            end[i], end[j] = stop, 0
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := rank(word[i : end[k]])) is not None:
                    heapq.heappush(heap, (r, i, end[k]))
            if (k := before[i]) >= 0 and (r := rank(word[k:stop])) is not None:
                heapq.heappush(heap, (r, k, stop))
        out, i = [], 0
        while i < n:
            out.append(self.ranks[word[i : end[i]]])
            i = after[i]
        return out

    def piece(self, text: str) -> list[int]:
        """Ids of a text: each pre-token by the perfect hash, or else merged."""
        out: list[int] = []
        if len(self.words) > REMEMBERED:
            self.words.clear()
        for word in self.pattern.findall(text):
            if (ids := self.words.get(word)) is None:
                raw = word.encode()
                i = self.hash.find(raw)
                ids = self.words[word] = [self.ids[i]] if i >= 0 else self.merge(raw)
            out += ids
        return out

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text. Its parts between single blanks are looked up among those met before."""
        first, *rest = blank_chunks(text)
        memo = self.memo
        parts = list(map(memo.get, rest))
        if None in parts:
            if len(memo) + len(rest) > REMEMBERED:
                memo.clear()
            for i, chunk in enumerate(rest):
                if parts[i] is None and (got := memo.get(chunk)) is None:
                    got = memo[chunk] = np.array(self.piece(" " + chunk), "<u4").tobytes()
                parts[i] = parts[i] or got
        return np.frombuffer(b"".join([np.array(self.piece(first), "<u4").tobytes(), *parts]), "<u4")

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))


@lru_cache(maxsize=4)
def ranked(path: str, pattern: str) -> RankedBpe:
    """The encoder of a file of base64 tokens and ranks; one per worker and file."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return RankedBpe(ranks, pattern)


def encode_documents(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``_key, ids array<int>`` for every row; null and empty texts have none.

    ``path``: a vocabulary file that all workers can open. One narrow pass. Null and repeated keys and
    repeated rows give a row each, very long texts are taken whole, other columns are left out, an
    empty table gives no row.
    """
    src = keyed_texts(docs, key, text)
    kind = src.schema[KEY].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        bpe = ranked(path, pattern)
        ids = [bpe.encode(t).view(np.int32) for t in batch.column(1).to_pylist()]
        offsets = np.concatenate(([0], np.cumsum([len(i) for i in ids]))).astype(np.int32)
        values = np.concatenate(ids) if ids else np.zeros(0, np.int32)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))], [KEY, "ids"])

    return map_arrow(src, run, f"{KEY} {kind}, ids array<int>")


def decode_documents(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """``_key, n_tokens, ids_sha256, decoded``: decoded bytes, and a digest of the ids, little-endian 32-bit."""
    kind = encoded.schema[KEY].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        bpe = ranked(path, pattern)
        ids = batch.column(1)
        offsets, values = ids.offsets.to_numpy(), ids.values.to_numpy(zero_copy_only=False)
        rows = [values[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array([len(r) for r in rows], pa.int64()),
                pa.array([hashlib.sha256(r.astype("<u4").tobytes()).hexdigest() for r in rows]),
                pa.array([bpe.decode(r) for r in rows], pa.binary()),
            ],
            [KEY, "n_tokens", "ids_sha256", "decoded"],
        )

    return map_arrow(encoded, run, f"{KEY} {kind}, n_tokens bigint, ids_sha256 string, decoded binary")
