"""Periodic runs of words: a sparse dynamic program over diagonals of equal words.

The cell (i, q) holds how many words up to word i each equal the word q before it, and follows
the cell of word i - 1 on the same diagonal q. A run of period q and length m is a stretch of
m - q such cells that cannot be extended. Lags below ``DENSE`` are swept word by word. A
longer lag needs at least q equal words in a row, and so a whole aligned block of b words
(2b <= q < 4b) that also stands q words earlier. There the program goes from block to block:
the earlier occurrences of a block lengthen the active lags, and a lag that a block does not
lengthen ends and, at sufficient length, gives its run. A block has less than 2b lags, so that
a text of n words has at most about n log n cells, whatever words it repeats.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from reachmark.llm.common import KEY, keyed_texts, map_arrow

WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Lags below it are compared word by word.
DENSE = 8
#: Words handled together; a longer text is handled by itself.
BATCH_WORDS = 1 << 19


def _stretches(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end (exclusive) of every stretch of true values."""
    edge = np.diff(np.concatenate(([0], mask.view(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _named(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of equal values, and whether each value is repeated."""
    _, number, count = np.unique(pairs, return_inverse=True, return_counts=True)
    return number, count[number] > 1


class Diagonals:
    """All runs of a sequence of numbers in which no number is shared between two texts."""

    def __init__(self, words: np.ndarray, longest: int, least: int):
        self.words, self.longest, self.least = words, longest, least
        self.n = len(words)
        self.found: list[tuple[int, int, int]] = []  # start, end (exclusive), period

    def runs(self) -> np.ndarray:
        """``start, length, period`` of each run, by start and period; a multiple of a run's period is none."""
        for q in range(1, min(DENSE, self.longest // 2 + 1)):
            same = self.words[q:] == self.words[:-q]
            begin, end = _stretches(same)
            enough = end - begin >= max(q, self.least - q)
            self.found += [(s, e + q, q) for s, e in zip(begin[enough].tolist(), end[enough].tolist())]
        self._blocks()
        best: dict[tuple[int, int], int] = {}
        for s, e, q in self.found:
            best[s, e] = min(q, best.get((s, e), q))
        rows = sorted((s, e - s, q) for (s, e), q in best.items())
        return np.array(rows, np.int64).reshape(-1, 3)

    def _blocks(self) -> None:
        """Lags from ``DENSE`` on, by blocks of half the least lag of an octave."""
        # numbers of the windows of b words that start at each place; -1: no window like it
        number, repeated = _named(self.words)
        number = np.where(repeated, number, -1)
        b = 1
        while 2 * b <= self.longest // 2:
            if b >= DENSE // 2:
                self._octave(number, b)
            following = np.full(self.n, -1, np.int64)
            following[: self.n - b] = number[b:]
            at = np.flatnonzero((number >= 0) & (following >= 0))
            if not len(at):
                return
            wide, repeated = _named(number[at] * self.n + following[at])
            number = np.full(self.n, -1, np.int64)
            number[at[repeated]] = wide[repeated]
            b *= 2

    def _octave(self, number: np.ndarray, b: int) -> None:
        """Lags from 2b to 4b - 1: equal windows that far before each aligned block."""
        blocks = np.arange(0, self.n - b + 1, b)
        blocks = blocks[number[blocks] >= 0]
        at = np.flatnonzero(number >= 0)
        if not len(blocks):
            return
        order = at[np.argsort(number[at], kind="stable")]
        keys = number[order] * self.n + order
        key = number[blocks] * self.n
        low = np.searchsorted(keys, key + np.maximum(blocks - 4 * b + 1, 0))
        high = np.searchsorted(keys, key + np.maximum(blocks - 2 * b + 1, 0))
        count = high - low
        source = np.repeat(blocks, count)
        index = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
        self._chains(source - order[index], source, b)

    def _chains(self, lag: np.ndarray, block: np.ndarray, b: int) -> None:
        """Active lags lengthened from block to block; ended ones of sufficient length give runs."""
        order = np.lexsort((block, lag))
        lag, block = lag[order], block[order]
        first = np.ones(len(lag), bool)
        first[1:] = (lag[1:] != lag[:-1]) | (block[1:] != block[:-1] + b)
        starts = np.flatnonzero(first)
        length = np.diff(np.append(starts, len(lag)))
        q, begin = lag[starts], block[starts]
        enough = length >= (q + 1) // b - 1  # whole blocks in any q words
        known = self._covers()
        for q, s, n in zip(q[enough].tolist(), begin[enough].tolist(), length[enough].tolist(), strict=True):
            if not known(s - q, s + n * b, q):
                self._extend(q, s, s + n * b)

    def _covers(self):
        """Whether a run already found holds a stretch and has a period that divides its lag."""
        held: dict[int, list[tuple[int, int]]] = {}
        for s, e, p in self.found:
            held.setdefault(p, []).append((s, e))
        periods = {p: (np.array([x for x, _ in sorted(v)]), np.array([y for _, y in sorted(v)])) for p, v in held.items()}
        divisors: dict[int, list[int]] = {}

        def known(start: int, end: int, q: int) -> bool:
            if q not in divisors:
                divisors[q] = [p for p in periods if q % p == 0]
            for p in divisors[q]:
                starts, ends = periods[p]
                k = int(np.searchsorted(starts, start, side="right")) - 1
                if k >= 0 and ends[k] >= end:
                    return True
            return False

        return known

    def _extend(self, q: int, start: int, end: int) -> None:
        """Whole stretch of lag ``q`` around the words from ``start`` to ``end``, and its run if it suffices."""
        w = self.words
        step = 16
        while end < self.n:
            stop = min(self.n, end + step)
            differ = np.flatnonzero(w[end:stop] != w[end - q : stop - q])
            if len(differ):
                end += int(differ[0])
                break
            end, step = stop, step * 2
        step = 16
        while start > q:
            stop = max(q, start - step)
            differ = np.flatnonzero(w[stop:start] != w[stop - q : start - q])
            if len(differ):
                start = stop + int(differ[-1]) + 1
                break
            start, step = stop, step * 2
        if end - start >= max(q, self.least - q):
            self.found.append((start - q, end, q))


class Text:
    """Words of one text and its runs."""

    def __init__(self, words: list[str], runs: np.ndarray):
        self.words, self.runs = words, runs

    def collapsed(self) -> str:
        """The words joined by blanks, without those behind the first period of a run."""
        if not len(self.runs):
            return " ".join(self.words)
        edge = np.zeros(len(self.words) + 1, np.int64)
        np.add.at(edge, self.runs[:, 0] + self.runs[:, 2], 1)
        np.add.at(edge, self.runs[:, 0] + self.runs[:, 1], -1)
        kept = np.flatnonzero(np.cumsum(edge[:-1]) == 0)
        return " ".join(map(self.words.__getitem__, kept.tolist()))


def text_runs(texts: list[str], least: int) -> Iterator[Text]:
    """Runs of every text, found for several texts at once; none crosses texts."""
    batch: list[list[str]] = []
    held = 0
    for text in texts:
        words = WORD.findall(text)
        if batch and held + len(words) > BATCH_WORDS:
            yield from _batch_runs(batch, least)
            batch, held = [], 0
        batch.append(words)
        held += len(words)
    yield from _batch_runs(batch, least)


def _batch_runs(batch: list[list[str]], least: int) -> Iterator[Text]:
    numbers, used = [], 0
    for words in batch:  # numbers are a text's own
        seen: dict[str, int] = {}
        numbers.append(np.array([seen.setdefault(w, len(seen)) for w in words], np.int64) + used)
        used += len(seen)
    begin = np.concatenate(([0], np.cumsum([len(w) for w in batch]))).astype(np.int64)
    runs = Diagonals(np.concatenate([np.zeros(0, np.int64), *numbers]), max(map(len, batch), default=0), least).runs()
    cut = np.searchsorted(runs[:, 0], begin)
    for i, words in enumerate(batch):
        yield Text(words, runs[cut[i] : cut[i + 1]] - [begin[i], 0, 0])


def find_runs(docs: DataFrame, least: int = 12, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``_key, n_words, runs array<struct<start, length, period>>, collapsed`` for every row of ``docs``.

    A run is a stretch of at least ``least`` words and two periods, by its smallest period, that
    no neighbouring word extends; runs come by start and period and may overlap. ``collapsed``
    holds the words that no run repeats, joined by blanks. One narrow pass. Null and empty texts
    have no words and no run, repeated rows and null keys give a row each, a very long text is
    taken whole in memory proportional to its words, other columns are left out, and an empty
    table gives no row.
    """
    src = keyed_texts(docs, key, text)
    kind = src.schema[KEY].dataType.simpleString()
    cell = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, sizes, runs, collapsed = [], [0], [], []
        for found in text_runs(batch.column(1).to_pylist(), least):
            counts.append(len(found.words))
            sizes.append(len(found.runs))
            runs.append(found.runs)
            collapsed.append(found.collapsed())
        flat = np.concatenate(runs)
        cells = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], fields=list(cell))
        nested = pa.ListArray.from_arrays(pa.array(np.cumsum(sizes).astype(np.int32)), cells)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(counts, pa.int64()), nested, pa.array(collapsed, pa.string())], [KEY, "n_words", "runs", "collapsed"]
        )

    return map_arrow(src, run, f"{KEY} {kind}, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")
