"""Range coder that mixes three orders of context, for token ids, many blocks in step.

Every block is coded by itself: its contexts start empty and it ends in a checksum. Blocks go
through the same steps side by side, one token of each at a time, so that each step is a few
array operations.

Order 2 and order 1 each hold, per context of two or one ids before (hashed to a slot), the id
seen last and how often it came again; order 0 holds frequencies of ids. The probability of an
id is the sum of what the three orders give it, by weights for every pair of confidences, and
one step of the range coder codes it. Weights and order 0 are a ``Mixture``: learned from the
blocks that are coded together, and needed to decode any of them.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass

import numpy as np

#: Bits of an order-1 or order-2 table's slots, of order 0's frequencies and of what the coder divides its range into.
SLOT_BITS, ZERO_BITS, BITS = 9, 20, 28
SLOTS, ZERO = 1 << SLOT_BITS, 1 << ZERO_BITS
#: An entry of a table is (id + 1) * 8 + confidence; 0: none. Confidences run from 1 to SURE, and start anew at another id.
SURE = 4
#: Pairs of confidences, for two orders that name different ids and for two that name the same.
PAIRS = 128
#: The range stays above this: then 32 bits go out.
_LOW = np.uint64(1 << 32)
_5, _32, _BITS = np.uint64(5), np.uint64(32), np.uint64(BITS)
#: Ids whose intervals are worked out together.
_SPAN = 1 << 16


def _weights(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Share of order 2, and of each unit of order 0, by pair of confidences; order 1 has the rest.

    ``counts``: how many ids order 2, order 1 and none of both gave. An empty entry has no share.
    """
    pair = np.arange(PAIRS)
    has2, has1 = (pair >> 3 & 7) > 0, ((pair & 7) > 0) & (pair < 64)
    two, one = (counts[0] + 0.4) * has2, (counts[1] + 0.4) * has1
    unit = np.clip(np.rint(256 * (counts[2] + 0.4) / (counts[2] + 0.4 + two + one)), 1, 255)
    unit = np.where(has2 | has1, unit, 256).astype(np.int64)
    rest = (1 << BITS) - (unit << ZERO_BITS)
    two = np.where(has1, np.floor(rest * two / np.maximum(two + one, 1e-9)).astype(np.int64), rest)
    return two.astype(np.uint32), unit.astype(np.uint32)


@dataclass
class Mixture:
    """Shares of orders by pair of confidences, and frequencies of ids + 1 in order 0, which add up to ``ZERO``."""

    two: np.ndarray
    unit: np.ndarray
    freq: np.ndarray

    def __post_init__(self):
        self.start = (np.cumsum(self.freq, dtype=np.uint64) - self.freq).astype(np.uint32)

    def shares(self, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of a unit of order 0, of order 2 and of order 1."""
        pair = pair.astype(np.int64)
        unit, two = self.unit.take(pair), self.two.take(pair)
        return unit, two, np.uint32(1 << BITS) - (unit << np.uint32(ZERO_BITS)) - two

    @classmethod
    def plain(cls, top: int = 1 << 16) -> Mixture:
        """Equal frequencies, and weights that rise with the confidence."""
        sure = np.array([0, 1, 3, 15, 60])
        at = np.arange(PAIRS)
        level = lambda c: sure[np.minimum(c, SURE)]
        counts = np.stack([3 * level(at >> 3 & 7), level(at & 7), np.ones(PAIRS)])
        freq = np.full(top + 1, ZERO // top, np.uint32)
        freq[0] = 0
        freq[1] += ZERO - int(freq.sum())
        return cls(*_weights(counts), freq)

    @classmethod
    def learned(cls, counts: np.ndarray, seen: np.ndarray) -> Mixture:
        """From counts by order and pair of confidences, and how often order 0 had to give each id + 1."""
        total, distinct = int(seen.sum()), int(np.count_nonzero(seen))
        freq = np.where(seen > 0, 1 + seen.astype(np.int64) * (ZERO - distinct) // max(total, 1), 0)
        freq[np.argmax(freq)] += ZERO - int(freq.sum())
        return cls(*_weights(counts), freq.astype(np.uint32))

    def to_bytes(self) -> bytes:
        return struct.pack("<I", len(self.freq)) + b"".join(x.astype("<u4").tobytes() for x in (self.two, self.unit, self.freq))

    @classmethod
    def from_bytes(cls, data: bytes) -> Mixture:
        size = struct.unpack_from("<I", data)[0]
        parts = [np.frombuffer(data, "<u4", PAIRS, 4 + 4 * PAIRS * k) for k in range(2)]
        return cls(*parts, np.frombuffer(data, "<u4", size, 4 + 8 * PAIRS))


class _Contexts:
    """The tables of both orders (2, then 1) for every block, and hashes of the ids + 1 before (0: none)."""

    def __init__(self, lanes: int):
        self.tables = np.zeros(2 * lanes * SLOTS, np.uint32)
        self.rows = np.arange(0, 2 * lanes * SLOTS, SLOTS).reshape(2, lanes)
        self.hashes, self.before = np.zeros((2, lanes), np.uint32), np.zeros(lanes, np.uint32)

    def predict(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids + 1 of both orders and the pair of confidences, for the first ``n`` blocks."""
        self.at = (self.hashes[:, :n] >> np.uint32(32 - SLOT_BITS)).astype(np.int64)
        self.at += self.rows[:, :n]
        entries = self.tables.take(self.at)
        self.sure, given = entries & np.uint32(7), entries >> np.uint32(3)
        pair = self.sure[0] << np.uint32(3)
        pair |= self.sure[1]
        pair |= (given[0] == given[1]) << np.uint32(6)
        return given, pair

    def learn(self, n: int, x: np.ndarray, hits: np.ndarray) -> None:
        """``x``: the ids + 1 that came, ``hits``: whether they are those of both orders."""
        sure = np.minimum(self.sure, np.uint32(SURE - 1))
        sure *= hits
        sure += (x << np.uint32(3)) + np.uint32(1)
        self.tables[self.at.ravel()] = sure.ravel()
        h = x * np.uint32(0x9E3779B1)
        self.hashes[0, :n] = h + self.before[:n]
        self.hashes[1, :n] = h
        self.before[:n] = x * np.uint32(0x85EBCA6B)


def _lanes(sizes: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """Blocks in the order of their sizes, the longest first, and how many are in work at each step."""
    order = np.argsort(-sizes, kind="stable")
    steps = np.arange(int(sizes.max(initial=0)))
    return order, np.searchsorted(-sizes[order], -steps, "left").tolist()


def _intervals(mix: Mixture, x: np.ndarray, p2: np.ndarray, p1: np.ndarray, pair: np.ndarray):
    """Where the intervals of ids + 1 start and how wide they are.

    Ids lie in ascending order; that of an order 2 or 1 has its order's share besides order 0's.
    """
    unit, two, one = mix.shares(pair)
    start = unit * mix.start.take(x) + two * (p2 < x) + one * (p1 < x)
    return start, unit * mix.freq.take(x) + two * (p2 == x) + one * (p1 == x)


def encode_blocks(blocks: list[np.ndarray], mixture: Mixture | None = None) -> list[bytes]:
    """Payloads of blocks of ids, coded side by side; without a mixture, of ids below 65536."""
    return _encode(blocks, mixture or Mixture.plain())[0]


def encode_learned(blocks: list[np.ndarray]) -> tuple[list[bytes], Mixture]:
    """Payloads of blocks of ids, and the mixture that is learned from them."""
    return _encode(blocks, None)


def _encode(blocks: list[np.ndarray], mix: Mixture | None) -> tuple[list[bytes], Mixture]:
    sizes = np.array(list(map(len, blocks)), np.int64)
    order, work = _lanes(sizes)
    top = max((int(b.max()) for b in blocks if len(b)), default=0)
    if top >= (ZERO >> 1 if mix is None else len(mix.freq) - 1):
        raise ValueError(f"id {top} is too large")
    if mix is not None and any((mix.freq.take(np.asarray(b, np.int64) + 1) == 0).any() for b in blocks):
        raise ValueError("the mixture was learned without some of the ids")
    x = np.zeros((len(work), len(blocks)), np.uint32)
    for lane, i in enumerate(order.tolist()):
        x[: sizes[i], lane] = blocks[i]
    x += 1
    p2, p1, pairs = np.zeros_like(x), np.zeros_like(x), np.zeros(x.shape, np.uint8)
    contexts = _Contexts(len(blocks))
    for step, n in enumerate(work):
        given, pairs[step, :n] = contexts.predict(n)
        p2[step, :n], p1[step, :n] = given
        contexts.learn(n, x[step, :n], given == x[step, :n])
    del contexts
    if mix is None:
        which = np.where(x == p2, np.uint16(0), np.where(x == p1, np.uint16(PAIRS), np.uint16(2 * PAIRS)))
        counts = np.bincount((which | pairs).ravel(), minlength=3 * PAIRS).reshape(3, PAIRS)
        seen = np.bincount(x[which == 2 * PAIRS], minlength=top + 2)
        outside = x.size - int(sizes.sum())  # behind the ends of blocks: id 0 from order 0, without entries
        counts[2, 0] -= outside
        seen[1] -= outside
        mix = Mixture.learned(counts, seen)
        del which
    low, rng = np.zeros(len(blocks), np.uint64), np.full(len(blocks), np.iinfo(np.uint64).max)
    # 32-bit digits, blocks side by side; a carry stays in the digit before until the end
    lanes = len(blocks)
    out, at = np.zeros((len(work) + 2) * lanes, np.uint64), np.arange(lanes)
    together = max(1, _SPAN // max(len(blocks), 1))
    for step, n in enumerate(work):
        if step % together == 0:
            part = slice(step, step + together)
            starts, widths = (i.astype(np.uint64) for i in _intervals(mix, x[part], p2[part], p1[part], pairs[part]))
        l, to = low[:n], at[:n]
        r = rng[:n] >> _BITS
        add = r * starts[step % together, :n]
        l += add
        if (carry := l < add).any():
            out[to[carry] - lanes] += np.uint64(1)
        r *= widths[step % together, :n]
        out[to] = l >> _32  # overwritten unless the block goes on
        short = r < _LOW
        to += short * lanes
        by = short.astype(np.uint64) << _5
        l <<= by
        rng[:n] = r << by
    # one digit more names a number inside the last range
    last = low + (_LOW - np.uint64(1))
    out[at[last < low] - lanes] += np.uint64(1)
    out[at] = last >> _32
    n = at // max(lanes, 1) + 1
    rows = int(n.max(initial=0))
    out = out[: rows * lanes].reshape(rows, lanes)
    while (over := out >> _32).any():
        out &= np.uint64(0xFFFFFFFF)
        out[:-1] += over[1:]
    back = [b""] * len(blocks)
    digits = np.ascontiguousarray(out.T.astype(">u4"))
    for row, i in enumerate(order.tolist()):
        back[i] = digits[row, : n[row]].tobytes() if sizes[i] else b""
    return back, mix


def decode_blocks(payloads: list[bytes], sizes: list[int], mixture: Mixture | None = None) -> list[np.ndarray]:
    """The ids of blocks of the given sizes."""
    mix = mixture or Mixture.plain()
    size = np.array(sizes, np.int64)
    order, work = _lanes(size)
    lanes = len(payloads)
    data = np.zeros((lanes, max(map(len, payloads), default=0) // 4 + 3), ">u4")
    for row, i in enumerate(order.tolist()):
        digits = np.frombuffer(payloads[i], ">u4", len(payloads[i]) // 4)
        data[row, : len(digits)] = digits
    data = data.T.astype(np.uint64, order="C").ravel()
    code, rng = data[:lanes] << _32 | data[lanes : 2 * lanes], np.full(lanes, np.iinfo(np.uint64).max)
    at = np.arange(2 * lanes, 3 * lanes)
    ids = np.zeros((len(work), len(payloads)), np.uint32)
    contexts = _Contexts(len(payloads))
    freq, start, most = mix.freq, mix.start, np.uint64((1 << BITS) - 1)
    named = np.repeat(np.arange(len(freq), dtype=np.uint32), freq)
    with np.errstate(divide="ignore"):
        for step, n in enumerate(work):
            given, pair = contexts.predict(n)
            unit, two, one = mix.shares(pair)
            r = rng[:n] >> _BITS
            c = code[:n]
            v = np.minimum(c // r, most).astype(np.int32)
            # to order 0 alone: without the share of the greater id, then of the smaller
            less = np.where(given[1] < given[0], one, two).view(np.int32)
            more = (two + one).view(np.int32) - less
            edge = (unit * start.take(given)).view(np.int32)
            v -= np.minimum(np.maximum(v - np.maximum(edge[0], edge[1]) - less, 0), more)
            v -= np.minimum(np.maximum(v - np.minimum(edge[0], edge[1]), 0), less)
            x = named.take(v.view(np.uint32) // unit, mode="clip")
            at_x, hits, below = x.astype(np.int64), given == x, given < x
            begin = unit * start.take(at_x) + two * below[0] + one * below[1]
            width = unit * freq.take(at_x) + two * hits[0] + one * hits[1]
            c -= r * begin
            r *= width
            short = r < _LOW
            by = short.astype(np.uint64) << _5
            to = at[:n]
            code[:n] = c << by | data.take(to, mode="clip") * short  # only a damaged block reads on
            rng[:n] = r << by
            to += short * lanes
            ids[step, :n] = x
            contexts.learn(n, x, hits)
    ids = np.ascontiguousarray(ids.T) - np.uint32(1)
    back: list = [None] * len(payloads)
    for row, i in enumerate(order.tolist()):
        back[i] = ids[row, : size[i]]
    return back


def checksum(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())
