"""BPE with word ends over a trie of distinct words: shared prefixes are encoded once.

The encoding of a prefix is the encoding of a shorter prefix and one last token, so the state
of a trie node is its last token alone. A token may follow another where the merges of both
together leave the border between them; exactly one token that ends at a node does.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from reachmark.llm.common import KEY, keyed_texts, map_arrow

#: Bytes of chunks that a worker remembers with their ids; beyond it starts anew.
REMEMBERED_BYTES = 160 << 20
#: Pairs of tokens whose border a worker remembers.
REMEMBERED_PAIRS = 1_000_000
#: Longer words get no trie nodes: their prefixes are followed one by one without storing them.
TRIE_DEPTH = 64
#: Characters of text whose new words go into one trie.
SLICE = 4 << 20

#: What words are cut from: blanks never belong to a word.
_CHUNK = re.compile(r"[^\x20\x09-\x0D]+")
#: The split of the vocabulary file for chunks of printable ASCII in lower case.
_ASCII_PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
_PRINTABLE = re.compile(r"[\x21-\x7E]+")

END = ""


class TrieBpe:
    """Encoder and decoder of a BPE file with an end-of-word suffix.

    The library of the file gives the normal form and the pieces of chunks beyond printable
    ASCII; ids come from the merges alone. Special tokens are found in the raw text.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task has one core
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model = file["model"]
        suffix = model.get("end_of_word_suffix")
        if model.get("type") != "BPE" or not suffix or file.get("decoder") or any(model.get(k) for k in ("dropout", "unk_token", "ignore_merges")):
            raise ValueError(f"{path} is no plain BPE file with word ends")
        self.library = Tokenizer.from_file(path)
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.at_special = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")
        # inside a word and at its end, by the characters a token spells
        self.inner = {t: i for t, i in model["vocab"].items() if not t.endswith(suffix)}
        self.final = {t.removesuffix(suffix): i for t, i in model["vocab"].items() if t.endswith(suffix)}
        self.name = {i: t for t, i in (model["vocab"] | self.special).items()}
        self.longest = max(map(len, [*self.inner, *self.final]))
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        vocab = model["vocab"]
        self.merges = {(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in enumerate(merges)}
        self.symbols = {i: [self.inner[c] for c in t] for t, i in self.inner.items()}
        self.symbols |= {i: [*(self.inner[c] for c in t[:-1]), self.final[t[-1]]] for t, i in self.final.items()}
        self.size = {i: len(x) for i, x in self.symbols.items()} | {-1: 0}
        self.alone: dict[int, bool] = {}
        self.border: dict[int, bool] = {}
        self.memo: dict[str, bytes] = {}
        self.held = 0

    def _merged(self, ids: list[int]) -> list[int]:
        """Symbols of one or two tokens after all merges, by rank and then from the left."""
        ids = list(ids)
        none = (len(self.merges), -1)
        while len(ids) > 1:
            ranks = [self.merges.get(p, none) for p in zip(ids, ids[1:])]
            best = min(ranks)
            if best is none:
                break
            i = ranks.index(best)
            ids[i : i + 2] = [best[1]]
        return ids

    def stands(self, before: int, token: int) -> bool:
        """Whether ``token`` may follow ``before`` (-1: the start of a word)."""
        if before < 0:
            if (found := self.alone.get(token)) is None:
                found = self.alone[token] = self._merged(self.symbols[token]) == [token]
            return found
        pair = before << 32 | token
        if (found := self.border.get(pair)) is None:
            if len(self.border) >= REMEMBERED_PAIRS:
                self.border.clear()
            found = self.border[pair] = self._merged(self.symbols[before] + self.symbols[token]) == [before, token]
        return found

    def last(self, prefix: str, depth: int, state: list[int], table: dict[str, int]) -> int:
        """The last token of the first ``depth`` characters of ``prefix``, given the states of shorter ones.

        Mostly the token before, one character longer; as only one fits, the order does not matter.
        """
        border = self.border.get
        grown = self.size[state[depth - 1]] + 1
        for size in (grown, *range(min(depth, self.longest), 0, -1)):
            token = table.get(prefix[depth - size : depth])
            if token is not None:
                before = state[depth - size]
                stands = border(before << 32 | token) if before >= 0 else None
                if stands or stands is None and self.stands(before, token):
                    return token
        raise ValueError(f"no token spells the end of {prefix[max(0, depth - 8) : depth]!r}")

    def _ids(self, word: str, state: list[int]) -> list[int]:
        """Ids of a word whose prefixes' last tokens are ``state``, from its end back."""
        n = len(word)
        out, at = [self.last(word, n, state, self.final)], n
        at -= self.size[out[0]]
        while at:
            out.append(state[at])
            at -= self.size[state[at]]
        return out[::-1]

    def encode_words(self, words: set[str]) -> dict[str, list[int]]:
        """Ids of distinct words, each spelled in the vocabulary's characters."""
        found: dict[str, list[int]] = {}
        root: dict = {}
        for word in words:
            if len(word) > TRIE_DEPTH:
                state = [-1]
                for depth in range(1, len(word)):
                    state.append(self.last(word, depth, state, self.inner))
                found[word] = self._ids(word, state)
                continue
            node = root
            for c in word:
                below = node.get(c)
                if below is None:
                    below = node[c] = {}
                node = below
            node[END] = word
        state = [-1] * (TRIE_DEPTH + 1)
        stack = [(root, "")]
        while stack:
            node, prefix = stack.pop()
            depth = len(prefix)
            if END in node:  # states of all shorter prefixes are those of this path
                found[prefix] = self._ids(prefix, state)
                if len(node) == 1:
                    continue
            if depth:
                state[depth] = self.last(prefix, depth, state, self.inner)
            stack += [(below, prefix + c) for c, below in node.items() if c != END]
        return found

    def pieces(self, chunk: str) -> list[str]:
        """Words of a text without blanks and special tokens, in the vocabulary's characters."""
        if _PRINTABLE.fullmatch(chunk):
            return _ASCII_PIECE.findall(chunk.lower())
        plain = self.library.normalizer.normalize_str(chunk)
        return [p for p, _ in self.library.pre_tokenizer.pre_tokenize_str(plain)]

    def _learn(self, chunks: set[str]) -> dict[str, bytes]:
        """Ids of chunks: their words go into one trie."""
        cut: dict[str, list] = {}
        for chunk in chunks:
            parts = []
            at = 0
            for m in self.at_special.finditer(chunk) if "<" in chunk or "|" in chunk else ():
                parts += self.pieces(chunk[at : m.start()]) if m.start() > at else []
                parts.append(self.special[m.group()])
                at = m.end()
            cut[chunk] = parts + (self.pieces(chunk[at:]) if at < len(chunk) else [])
        ids = self.encode_words({p for parts in cut.values() for p in parts if isinstance(p, str)})
        return {
            chunk: np.array([i for p in parts for i in (ids[p] if isinstance(p, str) else [p])], "<u4").tobytes()
            for chunk, parts in cut.items()
        }

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of whole texts, unsigned 32-bit. Chunks met before are remembered in bounded memory."""
        split = [_CHUNK.findall(t) for t in texts]
        new = {c for chunks in split for c in chunks} - self.memo.keys()
        learnt = self._learn(new) if new else {}
        size = sum(100 + 2 * len(c) + len(b) for c, b in learnt.items())
        seen = self.memo
        if self.held + size > REMEMBERED_BYTES:  # start anew, after this slice
            self.memo, self.held = {}, 0
        if size <= REMEMBERED_BYTES:
            self.held += size
            self.memo.update(learnt)
        out = []
        for chunks in split:
            out.append(np.frombuffer(b"".join([b if (b := learnt.get(c)) is not None else seen[c] for c in chunks]), "<u4"))
        return out

    def decode(self, ids: np.ndarray) -> str:
        """Token strings, special ones included, joined as a file without decoder joins them."""
        return " ".join(map(self.name.__getitem__, ids.tolist()))


@lru_cache(maxsize=2)
def trie_bpe(path: str) -> TrieBpe:
    """One encoder per worker and file."""
    return TrieBpe(path)


def slices(texts: list[str], size: int = SLICE):
    """Runs of texts of about ``size`` characters; a longer text is a run of its own."""
    run, held = [], 0
    for text in texts:
        if run and held + len(text) > size:
            yield run
            run, held = [], 0
        run.append(text)
        held += len(text)
    if run:
        yield run


def encode_documents(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``_key, ids array<int>`` for every row, in one narrow pass; null and empty texts have none.

    ``path``: a vocabulary file that all workers can open. Strings of special tokens in a text
    are special tokens. Null and repeated keys and repeated rows give a row each, very long texts and words are
    encoded whole, other columns are left out, an empty table gives no row.
    """
    src = keyed_texts(docs, key, text)
    kind = src.schema[KEY].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        bpe = trie_bpe(path)
        ids = [i.view(np.int32) for part in slices(batch.column(1).to_pylist()) for i in bpe.encode(part)]
        offsets = np.concatenate(([0], np.cumsum([len(i) for i in ids]))).astype(np.int32)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids)))], [KEY, "ids"])

    return map_arrow(src, run, f"{KEY} {kind}, ids array<int>")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """``_key, ids, text``: the decoded texts of ``encode_documents``."""
    kind = encoded.schema[KEY].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        bpe, ids = trie_bpe(path), batch.column("ids")
        offsets, values = ids.offsets.to_numpy(), ids.values.to_numpy(zero_copy_only=False)
        texts = [bpe.decode(values[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        return pa.RecordBatch.from_arrays([batch.column(KEY), ids, pa.array(texts, pa.string())], [KEY, "ids", "text"])

    return map_arrow(encoded, run, f"{KEY} {kind}, ids array<int>, text string")


def round_trip(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``_key, n_tokens, ids_sha256, decoded_sha256``: digests of the ids, little-endian 32-bit, and of the decoded text.

    Encodes and decodes in the same pass; edge cases are those of ``encode_documents``.
    """
    src = keyed_texts(docs, key, text)
    kind = src.schema[KEY].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        bpe = trie_bpe(path)
        rows = []
        for part in slices(batch.column(1).to_pylist()):
            for ids in bpe.encode(part):
                decoded = hashlib.sha256(bpe.decode(ids).encode()).hexdigest()
                rows.append((len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), decoded))
        n, digest, decoded = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n, pa.int64()), pa.array(digest), pa.array(decoded)], [KEY, "n_tokens", "ids_sha256", "decoded_sha256"]
        )

    return map_arrow(src, run, f"{KEY} {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
