"""Personal data: exact patterns, and a skip-chain conditional random field for what they miss."""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reachmark.llm.common import KEY, TEXT, keyed_texts, map_arrow

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int, int]  # start, end, number of the kind

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# a match can only start where a run of digits does
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    """Whether the check digit of a card number holds."""
    double = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)
    return (sum(map(int, digits[-1::-2])) + sum(double[int(c)] for c in digits[-2::-2])) % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) <= 255


def base_spans(text: str) -> list[Span]:
    """Matches of the four patterns, leftmost and non-overlapping per kind, by start, then kind."""
    out: list[Span] = []
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            out.append((start, m.end(), 0))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    if not _DIGIT.search(text):
        return out
    out += [(m.start(), m.end(), 1) for m in _IP.finditer(text) if all(map(_small, m.group().split(".")))]
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), m.end(), 2))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_DIGIT.findall(m.group())) <= 15:
                out.append((m.start(), m.end(), 3))
    return sorted(out, key=lambda s: (s[0], s[2]))


# ---- the random field -------------------------------------------------------------------

#: Tokens that may be part of an entity; every other token is of no kind for sure, so that it
#: passes a constant message and cuts the chain.
_TOKEN = re.compile(r"[^\x20\x09-\x0D]*[0-9@][^\x20\x09-\x0D]*")
_TRIM = ".,;:!?\"'()[]{}<>"
LABELS = len(KINDS) + 1  # 0: none
GAP = 2
FEATURES = 20


def tokens(text: str) -> list[tuple[int, int, str]]:
    """Start, end and string of candidate tokens, without punctuation around them."""
    out = []
    for m in _TOKEN.finditer(text):
        raw = m.group()
        word = raw.strip(_TRIM)
        if word:
            a = m.start() + raw.index(word)
            out.append((a, a + len(word), word))
    return out


def features(word: str) -> list[float]:
    """What a token looks like."""
    digits = "".join(_DIGIT.findall(word))
    n, letters = len(digits), sum(map(str.isalpha, word))
    plain = not letters and "@" not in word
    dots = word.split(".")
    return [
        1.0, "@" in word, "@" in word and "." in word.rpartition("@")[2].strip("."), letters == 0, letters > 3, "=" in word or '"' in word,
        plain and len(dots) == 4 and all(d.isdigit() and _small(d) for d in dots), plain and len(dots) == 4, len(dots) > 1,
        word.startswith("+"), plain and n <= 2, plain and n == 3, plain and 4 <= n <= 6, plain and n == 7, plain and 8 <= n <= 9, plain and 10 <= n <= 13,
        plain and 14 <= n <= 19, plain and 14 <= n <= 19 and luhn(digits), n > 19, "-" in word and plain,
    ]


def likeness(word: str) -> str | None:
    """Tokens of one likeness are linked wherever they stand: digits alone, or the lower-cased address."""
    if "@" in word:
        return word.lower()
    digits = "".join(_DIGIT.findall(word))
    return digits if len(digits) >= 7 else None


def edges(found: list[tuple[int, int, str]]) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Chain links between neighbours at most ``GAP`` characters apart, and skip links from each
    token to the one of its likeness before it: a chain per likeness, never all its pairs."""
    chain = [(i, i + 1) for i, (a, b) in enumerate(zip(found, found[1:])) if b[0] - a[1] <= GAP + 1]
    last: dict[str, int] = {}
    skip = []
    for i, (_, _, word) in enumerate(found):
        if (k := likeness(word)) is not None:
            if k in last:
                skip.append((last[k], i))
            last[k] = i
    return chain, skip


@dataclass(frozen=True)
class Field:
    """Weights: ``unary`` features x labels, ``chain`` and ``skip`` labels x labels."""

    unary: np.ndarray
    chain: np.ndarray
    skip: np.ndarray

    def beliefs(self, x: np.ndarray, links: np.ndarray, kind: np.ndarray, rounds: int = 12) -> np.ndarray:
        """Label probabilities per token by loopy message passing, all messages at once per round.

        ``links`` holds all links, then all again in the other direction; ``kind`` 0 for chain and 1 for skip links.
        """
        own = x @ self.unary
        if not len(links):
            return _soft(own)
        src, dst = links.T
        half = len(src) // 2
        back = np.concatenate((np.arange(half, 2 * half), np.arange(half)))  # the other direction
        pair = np.where(kind[:, None, None] == 0, self.chain, self.skip)
        pair = np.where((src < dst)[:, None, None], pair, pair.transpose(0, 2, 1))
        msg = np.zeros((len(src), LABELS))
        for _ in range(rounds):
            total = own.copy()
            np.add.at(total, dst, msg)
            out = (total[src] - msg[back])[:, :, None] + pair
            top = out.max(axis=1, keepdims=True)
            new = (top + np.log(np.exp(out - top).sum(axis=1, keepdims=True)))[:, 0]
            msg = 0.5 * msg + 0.5 * (new - new.max(axis=1, keepdims=True))
        total = own.copy()
        np.add.at(total, dst, msg)
        return _soft(total)


def _soft(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def graph(texts: list[str]):
    """Tokens of all texts, their features, and links in both directions with their kinds."""
    where, found, chain, skip = [], [], [], []
    for d, text in enumerate(texts):
        mine = tokens(text)
        c, s = edges(mine)
        n = len(found)
        chain += [(a + n, b + n) for a, b in c]
        skip += [(a + n, b + n) for a, b in s]
        found += mine
        where += [d] * len(mine)
    one = np.array(chain + skip, np.int64).reshape(-1, 2)
    kind = np.array([0] * len(chain) + [1] * len(skip), np.int64)
    x = np.array([features(w) for _, _, w in found], float).reshape(-1, FEATURES)
    return where, found, x, np.concatenate((one, one[:, ::-1])), np.concatenate((kind, kind))


def _mask(found: list[tuple[int, int, str]], spans: list[list[Span]], where: list[int]) -> np.ndarray:
    """The kind (from 1) of the base span that a token overlaps, 0 for none."""
    out, at, doc = np.zeros(len(found), np.int64), 0, -1
    for i, ((a, b, _), d) in enumerate(zip(found, where, strict=True)):
        if d != doc:
            at, doc, mine = 0, d, sorted(spans[d])
        while at < len(mine) and mine[at][1] <= a:
            at += 1
        hit = [s for s in mine[at : at + 4] if s[0] < b and s[1] > a]
        if hit:
            out[i] = hit[0][2] + 1
    return out


def fit_field(x: np.ndarray, y: np.ndarray, links: np.ndarray, kind: np.ndarray, steps: int = 400, ridge: float = 1e-3) -> Field:
    """Weights that maximise the labels' pseudo-likelihood, by accelerated gradient steps."""
    hot = np.eye(LABELS)[y]
    src, dst = (links.T if len(links) else np.zeros((2, 0), np.int64))
    near = np.zeros((len(x), 4 * LABELS))  # what chain and skip neighbours before and after are
    for k in (0, 1):
        for side in (0, 1):
            pick = (kind == k) & ((src < dst) if side == 0 else (src > dst))
            block = np.zeros((len(x), LABELS))
            np.add.at(block, dst[pick], hot[src[pick]])
            near[:, (2 * k + side) * LABELS : (2 * k + side + 1) * LABELS] = block
    u, pair = np.zeros((x.shape[1], LABELS)), np.zeros((2, LABELS, LABELS))
    weight = 1 / np.sqrt(np.bincount(y, minlength=LABELS)[y])  # rare kinds count, too
    weight /= weight.sum()
    vu, vp = np.zeros_like(u), np.zeros_like(pair)
    for _ in range(steps):
        full = np.concatenate([pair[0], pair[0].T, pair[1], pair[1].T])
        r = (_soft(x @ u + near @ full) - hot) * weight[:, None]
        g = near.T @ r
        gp = np.stack([g[2 * k * LABELS : (2 * k + 1) * LABELS] + g[(2 * k + 1) * LABELS : (2 * k + 2) * LABELS].T for k in (0, 1)])
        vu, vp = 0.9 * vu - (x.T @ r + ridge * u), 0.9 * vp - (gp + ridge * pair)
        u, pair = u + vu, pair + vp
    return Field(u, pair[0], pair[1])


#: What a span of a kind needs at least, so that a strong neighbour cannot drag a year or a word in.
_NEEDS = {
    0: lambda w: "@" in w[1:-1],
    1: lambda w: w.count(".") >= 3,
    2: lambda w: 14 <= len(_DIGIT.findall(w)) <= 19,
    3: lambda w: 7 <= len(_DIGIT.findall(w)) <= 15 and not any(map(str.isalpha, w)),
}


def find_spans(texts: list[str], field: Field | None, sure: float = 0.95) -> tuple[list[list[Span]], list[list[Span]]]:
    """Base spans and all spans per text.

    Tokens whose likeliest label is a kind form spans with their chain neighbours of that kind,
    one of which has to be believed at ``sure`` or more; spans that touch a base span or lack what the kind needs are dropped.
    """
    base = [base_spans(t) for t in texts]
    every = [list(b) for b in base]
    some = [i for i, t in enumerate(texts) if field is not None and (_DIGIT.search(t) or "@" in t)]
    where, found, x, links, kind = graph([texts[i] for i in some])
    if found:
        belief = field.beliefs(x, links, kind)
        label, most = belief.argmax(axis=1), belief.max(axis=1)
        label[_mask(found, [base[i] for i in some], where) > 0] = 0
        joined = {a for (a, b), k in zip(links.tolist(), kind.tolist(), strict=True) if k == 0 and b == a + 1 and label[a] == label[b]}
        i = 0
        while i < len(found):
            j = i
            while j in joined:
                j += 1
            if label[i] and most[i : j + 1].max() >= sure:
                d, k = some[where[i]], int(label[i]) - 1
                a, b = found[i][0], found[j][1]
                if _NEEDS[k](texts[d][a:b]) and all(s[1] <= a or s[0] >= b for s in base[d]):
                    every[d].append((a, b, k))
            i = j + 1
    return base, [sorted(s, key=lambda s: (s[0], s[2])) for s in every]


def fit_pii(docs: DataFrame, key: str = "doc_id", text: str = "text", max_docs: int = 20_000) -> Field | None:
    """A field fitted to the base spans of about ``max_docs`` documents at most, those of the
    smallest hashes; None without any span. Only tokens that may be entities reach the driver."""
    src = keyed_texts(docs, key, text)
    total = src.count()
    share = min(1.0, max_docs / max(total, 1))
    picked = src.where(F.pmod(F.xxhash64(KEY), F.lit(1 << 20)) < int(share * (1 << 20))).where(F.col(TEXT).rlike("[0-9@]"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        rows = []
        for t in batch.column(1).to_pylist():
            _, found, x, links, kind = graph([t])
            if found:
                half = len(links) // 2
                y = _mask(found, [base_spans(t)], [0] * len(found))
                rows.append((x.ravel().tolist(), y.tolist(), links[:half].ravel().tolist(), kind[:half].tolist()))
        if not rows:
            return None
        types = [pa.list_(pa.float64()), *[pa.list_(pa.int64())] * 3]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], ["x", "y", "links", "kind"])

    got = sorted(map(tuple, map_arrow(picked, run, "x array<double>, y array<bigint>, links array<bigint>, kind array<bigint>").collect()))
    x = np.array([v for r in got for v in r[0]]).reshape(-1, FEATURES)
    y = np.array([v for r in got for v in r[1]], np.int64)
    if not y.any():
        return None
    starts = np.cumsum([0, *(len(r[1]) for r in got)])
    one = np.concatenate([np.array(r[2], np.int64).reshape(-1, 2) + s for r, s in zip(got, starts)])
    kind = np.array([v for r in got for v in r[3]], np.int64)
    return fit_field(x, y, np.concatenate((one, one[:, ::-1])), np.concatenate((kind, kind)))


def _said(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in spans)


def find_pii(docs: DataFrame, field: Field | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``_key``, base counts per kind, ``base_sha256`` and ``spans`` (kind:start:end, in code
    points, comma-joined) for every row. Null and empty texts have none. One narrow pass. Null and repeated keys and
    repeated rows give a row each, very long texts are taken whole, other columns are left out, an
    empty table gives no row.
    """
    src = keyed_texts(docs, key, text)
    kind = src.schema[KEY].dataType.simpleString()
    names = [KEY, *(f"n_{k}" for k in KINDS), "base_sha256", "spans"]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        base, every = find_spans(batch.column(1).to_pylist(), field)
        counts = [pa.array([sum(s[2] == k for s in b) for b in base], pa.int64()) for k in range(len(KINDS))]
        digest = pa.array([hashlib.sha256(_said(b).encode()).hexdigest() for b in base])
        return pa.RecordBatch.from_arrays([batch.column(0), *counts, digest, pa.array(map(_said, every), pa.string())], names)

    return map_arrow(src, run, f"{KEY} {kind}, " + ", ".join(f"n_{k} bigint" for k in KINDS) + ", base_sha256 string, spans string")


def masked(text: str, spans: list[Span]) -> str:
    """The text with every span, or run of overlapping ones, replaced by its first kind."""
    out, done = [], 0
    for a, b, k in spans:
        if a >= done:
            out += [text[done:a], f"<{KINDS[k].upper()}>"]
        done = max(done, b)
    return "".join([*out, text[done:]])


def mask_pii(docs: DataFrame, field: Field | None, text: str = "text", length: str | None = None) -> DataFrame:
    """``docs`` with personal data in ``text`` masked; ``length``: a column to hold the new
    number of characters. Other columns and null texts stay as they are, whatever their names; repeated
    rows and null keys stay, very long texts are taken whole, an empty table stays empty."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        at = batch.schema.get_field_index(text)
        old = batch.column(at).to_pylist()
        _, every = find_spans([t or "" for t in old], field)
        new = [None if t is None else masked(t, s) if s else t for t, s in zip(old, every, strict=True)]
        batch = batch.set_column(at, batch.schema.field(at), pa.array(new, batch.schema.field(at).type))
        if length:
            n = batch.schema.get_field_index(length)
            sizes = [None if t is None else len(t) for t in new]
            batch = batch.set_column(n, batch.schema.field(n), pa.array(sizes, batch.schema.field(n).type))
        return batch

    return map_arrow(docs, run, docs.schema)
