"""Token ids of whole texts by the tokenizers library, in bounded memory."""

from __future__ import annotations

import json
import os
import re
import unicodedata
from functools import lru_cache

import numpy as np

from reachmark.llm.common import BLANK, blank_chunks

REMEMBERED = 400_000

#: Runs of white space that the rank encoder's pattern cannot take; such texts go to the library of the file.
_LONG_BLANKS = re.compile(r"\s{50000}")


def printable_bytes() -> dict[str, int]:
    """The character by which byte-level vocabularies write each byte: itself where it can be printed."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def byte_level_tokens(path: str) -> dict[int, bytes] | None:
    """Bytes of every id of a byte-level file that splits texts by the public pattern, else None."""
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    split, model = file.get("pre_tokenizer") or {}, file["model"]
    plain = not file.get("normalizer") and not any(
        model.get(k) for k in ("end_of_word_suffix", "continuing_subword_prefix", "ignore_merges", "dropout")
    )
    if not plain or split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True):
        return None
    to_byte = printable_bytes()
    return {i: bytes(to_byte[c] for c in t) for t, i in model["vocab"].items()}


class RankEncoder:
    """Encodes by a byte-level file whose ids of merged tokens rise in the order of its merges.

    The ids then serve as ranks, and a compiled merge loop over them gives what the file's own
    library gives, in a quarter of the time. Strings of special tokens are ordinary text.
    """

    def __init__(self, path: str, tokens: dict[int, bytes]):
        import public_tokenizers
        import tiktoken

        self.path, self.tokens = path, tokens
        ranks = {t: i for i, t in tokens.items()}
        self.encoding = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text, unsigned 32-bit."""
        if len(text) >= 50_000 and _LONG_BLANKS.search(text):
            return np.array(chunk_encoder(self.path, True).tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.array(self.encoding.encode_ordinary(text), np.uint32)


class ChunkEncoder:
    """Encodes the parts of a text between single blanks, and remembers parts met before.

    The library splits texts at such blanks before it merges, so parts can be encoded by
    themselves; ``spaced`` tells that the blank belongs to the part behind it. Strings of
    special tokens are ordinary text.
    """

    def __init__(self, path: str, spaced: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.lead = " " if spaced else ""
        self.memo: dict[str, bytes] = {}

    def _raw(self, parts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch(parts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text, unsigned 32-bit."""
        first, *rest = blank_chunks(text)
        memo = self.memo
        parts = list(map(memo.get, rest))
        if None in parts:
            missing = list({c for c, p in zip(rest, parts, strict=True) if p is None})
            if len(memo) + len(missing) > REMEMBERED:
                memo.clear()
                missing = list(set(rest))
            memo.update(zip(missing, self._raw([self.lead + c for c in missing]), strict=True))
            parts = list(map(memo.__getitem__, rest))
        return np.frombuffer(b"".join([*(self._raw([first]) if first else []), *parts]), "<u4")

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of whole texts, unsigned 32-bit."""
        return [self.encode(t) for t in texts]


@lru_cache(maxsize=4)
def chunk_encoder(path: str, spaced: bool) -> ChunkEncoder:
    """One encoder per worker and vocabulary file."""
    return ChunkEncoder(path, spaced)


@lru_cache(maxsize=4)
def encoder(path: str, spaced: bool) -> ChunkEncoder | RankEncoder:
    """The fastest encoder that gives the ids of a file; one per worker and file."""
    tokens = byte_level_tokens(path) if spaced else None
    return RankEncoder(path, tokens) if tokens else chunk_encoder(path, spaced)


#: The steps of a word-level file that ``WordEncoder`` follows by itself.
_WORD_NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
_WORD_SPLIT = [
    {
        "type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
        "behavior": "Removed", "invert": True,
    },
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]

#: Characters that stand by themselves in normal form C, whose lower case does not depend on their
#: place and whose kinds no version of Unicode has changed; texts with others go to the library.
_PLAIN = (
    (0x00, 0x2FF), (0x400, 0x481), (0x48A, 0x52F), (0x2010, 0x2027), (0x2030, 0x205E), (0x20A0, 0x20AC),
    (0x3000, 0x3020), (0x3041, 0x3094), (0x30A1, 0x30FE), (0x4E00, 0x9FA5), (0xAC00, 0xD7A3), (0xFF01, 0xFF5E),
)
_BEYOND = re.compile("[^" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in _PLAIN) + "]")
_BLANK_KIND, _LETTER, _DIGIT, _OTHER = range(4)
#: Characters of texts that are cut into words together; longer texts are cut at single blanks.
SLICE_CHARS = 1 << 20


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """Kinds by code point (blank, letter, digit, other) of plain characters and their lower case."""
    kinds = np.array([{"L": _LETTER, "N": _DIGIT}.get(unicodedata.category(chr(c))[0], _OTHER) for c in range(0x10000)], np.uint8)
    blanks = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
    kinds[blanks] = _BLANK_KIND
    return kinds


def spaced_words(codes: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words of lower-case plain characters of the given kinds, each with one blank behind it and nothing else
    between, and where every character's own output begins (one more than characters).

    A word is a contraction, a run of letters, a digit or a run of others, as the file's pattern
    takes them from the left. A contraction needs an apostrophe that is a run by itself.
    """
    after = np.append(kinds, np.uint8(_BLANK_KIND))[1:]
    ends = (kinds != after) | (kinds == _DIGIT)
    quotes = np.flatnonzero(codes == ord("'"))
    quotes = quotes[(after[quotes] == _LETTER) & ((quotes == 0) | (kinds[quotes - 1] != _OTHER))]
    one = codes[quotes + 1]
    two = codes[np.minimum(quotes + 2, len(codes) - 1)]
    short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
    long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
    long &= quotes + 2 < len(codes)
    ends[quotes[short | long]] = False
    ends[quotes[short] + 1] = True
    ends[quotes[long] + 2] = True
    words = kinds != _BLANK_KIND
    ends &= words
    width = words.view(np.uint8) + ends.view(np.uint8)
    edges = np.concatenate(([0], np.cumsum(width, dtype=np.int64)))
    out = np.repeat(codes, width)
    out[edges[1:][ends] - 1] = ord(" ")
    return out, edges


def cut_text(text: str, size: int) -> list[str]:
    """The text cut before the first single blank behind every ``size`` characters or more; the blanks are dropped."""
    parts, at = [], 0
    while len(text) - at > size and (blank := BLANK.search(text, at + size)):
        parts.append(text[at : blank.start()])
        at = blank.end()
    return [*parts, text[at:]]


class WordEncoder(ChunkEncoder):
    """Encodes by a word-level file with an end-of-word suffix by a compiled merge loop.

    Words are spelled in bytes, a blank for the suffix: no word holds one. Every id is the rank of
    the merge that makes it, and a byte and the suffix merge first, so a merge loop over ranks
    gives what the file's own library gives. Texts with characters beyond ``_PLAIN`` go to the
    library. Strings of special tokens are ordinary text.
    """

    def __init__(self, path: str, ranks: dict[bytes, int]):
        import tiktoken

        super().__init__(path, False)
        # no text holds two blanks: the string of a special token that is never met
        self.ranks = tiktoken.Encoding("words", pat_str="[^ ]+ ", mergeable_ranks=ranks, special_tokens={"  ": len(ranks)})

    def _plain(self, texts: list[str], dtype: str, name: str) -> list[np.ndarray]:
        """Ids of lower-case plain texts, which ``name`` codes with one ``dtype`` a character."""
        data = "\n".join(texts).encode(name)
        codes = np.frombuffer(data, dtype)
        kinds = _kinds().take(codes) if codes.itemsize > 1 else np.frombuffer(data.translate(_kinds()[:256].tobytes()), np.uint8)
        out, edges = spaced_words(codes, kinds)
        ends = np.cumsum([len(t) + 1 for t in texts]) - 1
        cuts = [0, *edges[np.minimum(ends, len(codes))].tolist()]
        spaced = out.tobytes().decode(name)
        return [self.ranks.encode_to_numpy(spaced[a:b], disallowed_special=()) for a, b in zip(cuts, cuts[1:])]

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of whole texts, unsigned 32-bit."""
        parts, owner = [], []
        for i, t in enumerate(texts):
            parts += cut_text(t, SLICE_CHARS)
            owner += [i] * (len(parts) - len(owner))
        found: list = [None] * len(parts)
        plain: dict[tuple[str, str], list[int]] = {("u1", "ascii"): [], ("<u4", "utf-32-le"): []}
        for k, t in enumerate(parts):
            if t.isascii():
                plain["u1", "ascii"].append(k)
            elif not _BEYOND.search(t):
                plain["<u4", "utf-32-le"].append(k)
            else:
                found[k] = self.encode(t)
        for code, places in plain.items():
            if not places:
                continue
            held = np.cumsum([len(parts[k]) for k in places]) // SLICE_CHARS
            for run in np.split(np.array(places, np.int64), np.flatnonzero(np.diff(held)) + 1):
                for k, ids in zip(run.tolist(), self._plain([parts[k].lower() for k in run.tolist()], *code), strict=True):
                    found[k] = ids
        if len(parts) == len(texts):
            return found
        edges = np.searchsorted(owner, np.arange(len(texts) + 1)).tolist()
        return [found[a] if b == a + 1 else np.concatenate(found[a:b]) for a, b in zip(edges, edges[1:])]


def word_ranks(path: str) -> dict[bytes, int] | None:
    """Bytes of every id of a word-level file, a blank for the suffix, if ids rise in the order of merges, else None."""
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    model, suffix = file["model"], file["model"].get("end_of_word_suffix")
    steps = [(file.get(name) or {}).get(many) for name, many in (("normalizer", "normalizers"), ("pre_tokenizer", "pretokenizers"))]
    if steps != [_WORD_NORMALIZER, _WORD_SPLIT] or not suffix or any(
        model.get(k) for k in ("continuing_subword_prefix", "ignore_merges", "dropout", "unk_token", "byte_fallback")
    ):
        return None
    vocab, to_byte = model["vocab"], printable_bytes()
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    letters = len(vocab) - len(merges)
    alphabet = {*to_byte, *(c + suffix for c in to_byte)}
    if {t for t, i in vocab.items() if i < letters} != alphabet or [vocab[a + b] for a, b in merges] != list(range(letters, len(vocab))):
        return None
    spell = lambda t: bytes(map(to_byte.__getitem__, t.removesuffix(suffix))) + b" " * t.endswith(suffix)
    ranks = {spell(t): i for t, i in vocab.items()}
    return ranks if len(ranks) == len(vocab) else None


@lru_cache(maxsize=2)
def word_encoder(path: str) -> ChunkEncoder:
    """The fastest encoder of a file that is no byte-level one; one per worker and file."""
    ranks = word_ranks(path)
    return WordEncoder(path, ranks) if ranks else chunk_encoder(path, False)
