"""Suffix arrays with common-prefix values by induced sorting over queues on disk.

Suffixes are told apart as smaller (S) or larger (L) than the next one. The S suffixes behind an
L suffix are sorted first. From them all L suffixes follow in one ascending sweep, and from those
all S suffixes in one descending sweep: taking a suffix out of the order puts the suffix one
character to its left in. What is put in goes to a queue for its first character. Within a
character, suffixes come in the order of what they were induced from, so a first-in first-out
queue per character is a priority queue, and all its waiting entries can be taken out as one
batch. Entries carry the length of the prefix they share with the entry before: one more than
the least such value between the two suffixes that induced them.
"""

from __future__ import annotations

import tempfile

import numpy as np

#: Bytes a queue set keeps in memory before it writes its entries to disk.
MEMORY = 64 << 20
#: Entries of a batch, at least, where a queue has them.
BATCH = 1 << 19
_ENTRY = np.dtype([("at", "<i8"), ("lcp", "<i2")])


class Queues:
    """First-in first-out queues of entries (place, shared prefix), one per character."""

    def __init__(self, characters: int, memory: int = MEMORY):
        self.parts: list[list] = [[] for _ in range(characters)]
        self.memory, self.held, self.file = memory, 0, None

    def put(self, c: int, entries: np.ndarray) -> None:
        if self.held + entries.nbytes > self.memory:
            if self.file is None:
                self.file = tempfile.TemporaryFile()  # noqa: SIM115  unlinked already; gone with the object
            at = self.file.seek(0, 2)
            self.file.write(entries.tobytes())
            self.parts[c].append((at, len(entries)))
        else:
            self.held += entries.nbytes
            self.parts[c].append(entries)

    def _load(self, part) -> np.ndarray:
        if isinstance(part, np.ndarray):
            return part
        self.file.seek(part[0])
        return np.frombuffer(self.file.read(part[1] * _ENTRY.itemsize), _ENTRY)

    def _batches(self, parts):
        """Consecutive parts joined, up to a bounded size: many queues get a few entries at a time."""
        held: list[np.ndarray] = []
        size = 0
        for p in parts:
            held.append(self._load(p))
            size += len(held[-1])
            if size >= BATCH:
                yield np.concatenate(held)
                held, size = [], 0
        if held:
            yield np.concatenate(held)

    def take(self, c: int):
        """All entries of a queue that are there now, in batches; they leave it."""
        parts, self.parts[c] = self.parts[c], []
        self.held -= sum(p.nbytes for p in parts if isinstance(p, np.ndarray))
        return self._batches(parts)

    def last(self, c: int) -> int:
        return int(self._load(self.parts[c][-1])["at"][-1])

    def peek(self, c: int, backwards: bool = False):
        """Batches of a queue's entries, which stay in it, from its start or from its end."""
        if not backwards:
            return self._batches(self.parts[c])
        return self._batches(self._load(p)[::-1] for p in reversed(self.parts[c]))


class _Minima:
    """Least value of any range of a batch, by tables of doubling width."""

    def __init__(self, values: np.ndarray):
        self.tables = [values]
        while (w := 1 << (len(self.tables) - 1)) * 2 <= len(values):
            t = self.tables[-1]
            self.tables.append(np.minimum(t[:-w], t[w:]))

    def between(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Minimum of values[first..last], elementwise."""
        out = np.empty(len(first), self.tables[0].dtype)
        level = np.frexp((last - first + 1).astype(float))[1] - 1
        for k in np.unique(level).tolist():
            pick = level == k
            a, b = first[pick], last[pick]
            out[pick] = np.minimum(self.tables[k][a], self.tables[k][b - (1 << k) + 1])
        return out


class _Sweep:
    """Induces from batches of suffixes, given in sweep order, into queues."""

    def __init__(self, queues: Queues, characters: int, cap: int):
        self.queues, self.cap = queues, cap
        self.low = np.full(characters, -1, np.int64)  # least value since a character's last entry; -1: none yet

    def induce(self, lcp: np.ndarray, at: np.ndarray, chars: np.ndarray, use: np.ndarray) -> None:
        """``lcp``: shared prefix of every suffix with the one before in the sweep; the suffixes
        ``use`` put the place to their left, which begins with ``chars``, into its queue."""
        if not len(lcp):
            return
        src = np.flatnonzero(use)
        c = chars[src]
        order = np.argsort(c, kind="stable")
        src, c = src[order], c[order]
        first = np.flatnonzero(np.concatenate(([True], c[1:] != c[:-1]))) if len(c) else np.zeros(0, int)
        value = np.zeros(len(src), np.int64)
        total = int(lcp.min())
        seen = np.zeros(len(self.low), bool)
        after = self.low.copy()
        if len(src):
            minima = _Minima(lcp)
            begin = np.concatenate(([0], src[:-1] + 1))
            begin[first] = 0
            value = minima.between(begin, src).astype(np.int64)
            heads = c[first]
            before = self.low[heads]
            value[first] = np.where(before < 0, -1, np.minimum(before, value[first]))
            value = np.minimum(value + 1, self.cap)
            ends = np.append(first[1:], len(src)) - 1
            rest = src[ends] + 1
            inside = rest < len(lcp)
            after[heads] = self.cap
            if inside.any():
                after[heads[inside]] = minima.between(rest[inside], np.full(int(inside.sum()), len(lcp) - 1))
            seen[heads] = True
        others = ~seen & (self.low >= 0)
        after[others] = np.minimum(self.low[others], total)
        self.low = after
        entries = np.empty(len(src), _ENTRY)
        entries["at"], entries["lcp"] = at[src] - 1, value
        for a, b in zip(first.tolist(), [*first[1:].tolist(), len(src)]):
            self.queues.put(int(c[a]), entries[a:b])


def _words(text: np.ndarray) -> np.ndarray:
    """The eight bytes from every place on as one number, zeros behind the end."""
    w = np.zeros(len(text) + 8, np.uint64)
    w[: len(text)] = text
    for k in (1, 2, 4):
        w[:-k] |= w[k:] << np.uint64(8 * k)
    return w


def _shared(words: np.ndarray, a: np.ndarray, b: np.ndarray, cap: int, n: int) -> np.ndarray:
    """Length of the prefix that the suffixes a and b share, up to ``cap``."""
    out = np.zeros(len(a), np.int64)
    live = np.arange(len(a))
    for step in range(0, cap, 8):
        x = words[np.minimum(a[live] + step, n)] ^ words[np.minimum(b[live] + step, n)]
        same = x == 0
        low = x & (~x + np.uint64(1))
        out[live] += np.where(same, 8, np.frexp(low.astype(float))[1] - 1 >> 3)
        live = live[same]
        if not len(live):
            break
    return np.minimum(np.minimum(out, cap), n - np.maximum(a, b))  # zeros behind the end are no text


def _sort_starred(text: np.ndarray, star: np.ndarray, cap: int) -> np.ndarray:
    """Places ``star`` sorted by their suffixes, as far as ``cap`` characters tell.

    Substrings from one place to the next are named in order; the string of names is then
    sorted by doubling: a name at least two characters long stands behind the one before, so
    that cap / 2 names are enough.
    """
    n = len(star)
    if n < 2:
        return star
    ends = np.append(star[1:], len(text) - 1)
    length = np.minimum(ends - star + 1, cap)
    open_end = np.arange(n) == n - 1  # ends with the text, which is smaller than all that goes on
    words = _words(text)
    rank = np.zeros(n, np.int64)
    for step in range(0, int(length.max()), 8):
        left = np.clip(length - step, 0, 8)
        goes_on = np.zeros(int(rank.max()) + 1, bool)
        goes_on[rank[left > 0]] = True
        live = np.flatnonzero(goes_on[rank] & (np.bincount(rank)[rank] > 1))  # only names that still tie
        if not len(live):
            continue
        l = left[live]
        past = np.where(l >= 8, np.uint64(0), ~np.uint64(0) >> (8 * np.minimum(l, 7)).astype(np.uint64))
        chunk = words[np.minimum(star[live] + step, len(text))].byteswap() & ~past
        # a substring that ends where another goes on ends in an S suffix, the other is L there
        chunk = np.where(open_end[live], chunk, chunk | past)
        tail = np.where(open_end[live], l, 16 - l)
        order = np.lexsort((tail, chunk, rank[live]))
        r, k, e = rank[live][order], chunk[order], tail[order]
        new = np.concatenate(([False], (r[1:] != r[:-1]) | (k[1:] != k[:-1]) | (e[1:] != e[:-1])))
        fresh = np.empty(len(live), np.int64)
        fresh[order] = np.cumsum(new)
        pair = rank * (len(live) + 1)
        pair[live] += fresh
        rank = np.unique(pair, return_inverse=True)[1]
    width = 1
    while width * 2 <= cap and int(rank.max()) < n - 1:
        nxt = np.zeros(n, np.int64)
        nxt[: n - width] = rank[width:] + 1
        rank = np.unique(rank * (n + 1) + nxt, return_inverse=True)[1]
        width *= 2
    return star[np.argsort(rank, kind="stable")]


def sorted_suffixes(text: np.ndarray, cap: int, memory: int = MEMORY):
    """Yields (places, shared) batches of all suffixes of a byte string in order.

    ``shared``: length of the prefix a suffix shares with the one before, at most ``cap``.
    Suffixes that agree in ``cap`` characters may come in any order.
    """
    n = len(text)
    if not n:
        return
    chars = 256
    t = text.astype(np.int16)
    # a suffix is S if the next different character is larger; the end is smaller than all
    step = np.sign(np.diff(t, append=-1)).astype(np.int8)
    at = np.where(step != 0, np.arange(n), n)
    nxt = np.minimum.accumulate(at[::-1])[::-1]
    small = step[nxt] > 0
    star = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    star = _sort_starred(text, star, cap)
    words = _words(text)
    star_lcp = np.concatenate(([0], _shared(words, star[:-1], star[1:], cap, n)))[: len(star)]
    edge = np.searchsorted(text[star], np.arange(chars + 1))

    larger = Queues(chars, memory)
    kept = Queues(chars, memory)
    sweep = _Sweep(larger, chars, cap)
    prev = lambda a: text[np.maximum(a - 1, 0)]
    # the last suffix is L unless it is S by nothing behind it: it starts the order of its character
    end = np.zeros(1, _ENTRY)
    end["at"] = n - 1
    larger.put(int(text[-1]), end)
    sweep.low[int(text[-1])] = 0
    for c in range(chars):
        last = -1
        while larger.parts[c]:
            for e in larger.take(c):
                a, l = e["at"], e["lcp"].astype(np.int64)
                kept.put(c, e)
                last = int(a[-1])
                p = prev(a)
                sweep.induce(l, a, p, (a > 0) & (p >= c))
        a, l = star[edge[c] : edge[c + 1]], star_lcp[edge[c] : edge[c + 1]].copy()
        if len(a):
            l[0] = _shared(words, np.array([last]), a[:1], cap, n)[0] if last >= 0 else 0
            sweep.induce(l, a, prev(a), a > 0)

    smaller = Queues(chars, memory)
    ordered = Queues(chars, memory)
    sweep = _Sweep(smaller, chars, cap)
    for c in range(chars - 1, -1, -1):
        last = -1
        while smaller.parts[c]:
            for e in smaller.take(c):
                a, l = e["at"], e["lcp"].astype(np.int64)
                ordered.put(c, e)
                last = int(a[-1])
                p = prev(a)
                sweep.induce(l, a, p, (a > 0) & (p <= c) & small[np.maximum(a - 1, 0)])
        over = int(_shared(words, np.array([kept.last(c)]), np.array([last]), cap, n)[0]) if last >= 0 and kept.parts[c] else 0
        for e in kept.peek(c, backwards=True):
            a, l = e["at"], e["lcp"].astype(np.int64)
            # a value belongs to a suffix and the next smaller one: moved on by one
            l, over = np.concatenate(([over], l[:-1])), int(l[-1])
            p = prev(a)
            sweep.induce(l, a, p, (a > 0) & (p < c))

    for c in range(chars):
        last = -1
        for e in kept.peek(c):
            last = int(e["at"][-1])
            yield e["at"], e["lcp"]
        if not ordered.parts[c]:
            continue
        # the descending sweep's values belong to a suffix and the next larger one
        first = ordered.last(c)
        shift = int(_shared(words, np.array([last]), np.array([first]), cap, n)[0]) if last >= 0 else 0
        for e in ordered.peek(c, backwards=True):
            a, l = e["at"], e["lcp"]
            out, shift = np.concatenate(([shift], l[:-1])), int(l[-1])
            yield a, out.astype(np.int16)
