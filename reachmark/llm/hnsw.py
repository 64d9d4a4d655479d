"""Navigable small-world graphs over unit vectors, searched and built in batches."""

from __future__ import annotations

import io
from functools import cached_property

import numpy as np


class Hnsw:
    """Layered neighbour graph. Rows are kept in order of their top layer, so a layer is a prefix."""

    def __init__(self, vec: np.ndarray, seed: int = 0, m: int = 12, beam: int = 48, batch: int = 256):
        n = len(vec)
        rng = np.random.default_rng(seed)
        top = np.minimum((-np.log(rng.random(n)) / np.log(m)).astype(int), 5) if n else np.zeros(0, int)
        self.order = np.argsort(-top, kind="stable")  # row of the input at every place
        self.vec = np.ascontiguousarray(vec[self.order], np.float32)
        top = top[self.order]
        self.layers = [np.full((int((top >= l).sum()), 2 * m if l == 0 else m), -1, np.int32) for l in range(int(top.max(initial=0)) + 1)]
        self.beam = beam
        at = 1
        while at < n:  # small batches first, since those of a batch find each other only by comparison
            end = min(n, at + min(batch, max(1, at // 2)))
            self._insert(np.arange(at, end), m)
            at = end

    def _insert(self, new: np.ndarray, m: int) -> None:
        q = self.vec[new]
        entry = np.zeros((len(new), 1), np.int64)
        among = q @ q.T
        for l in range(len(self.layers) - 1, -1, -1):
            nbr = self.layers[l]
            built = min(int(new[0]), len(nbr))
            here = new < len(nbr)
            ids, sims = self._beam(q, entry, l, self.beam if here.any() else 1)
            entry = np.maximum(ids[:, : min(4, ids.shape[1])], 0)
            if not here.any() or not built:
                continue
            rows = np.flatnonzero(here)
            # earlier rows of the same batch are candidates, too
            mates = np.where(np.tri(len(rows), k=-1, dtype=bool), among[np.ix_(rows, rows)], -np.inf)
            k = min(m, len(rows))
            best = np.argpartition(-mates, k - 1, axis=1)[:, :k]
            best_sims = np.take_along_axis(mates, best, 1)
            cand = np.concatenate((ids[rows], np.where(np.isfinite(best_sims), new[rows][best], -1)), axis=1)
            cs = np.concatenate((sims[rows], best_sims), axis=1)
            chosen = self._choose(cand, cs, m)
            nbr[new[rows], :m] = chosen
            # the chosen ones point back, and thin out their lists
            src = np.repeat(new[rows], m)
            dst = chosen.ravel()
            src, dst = src[dst >= 0], dst[dst >= 0]
            order = np.lexsort((-np.einsum("ij,ij->i", self.vec[src], self.vec[dst]), dst))
            src, dst = src[order], dst[order]
            who, first, count = np.unique(dst, return_index=True, return_counts=True)
            width = nbr.shape[1]
            rank = np.arange(len(dst)) - np.repeat(first, count)
            come = np.full((len(who), width), -1, np.int64)
            ok = rank < width
            come[np.repeat(np.arange(len(who)), count)[ok], rank[ok]] = src[ok]
            both = np.concatenate((nbr[who], come), axis=1)
            s = np.einsum("qmd,qd->qm", self.vec[np.maximum(both, 0)], self.vec[who])
            s[both < 0] = -np.inf
            nbr[who] = self._choose(both, s, width)

    def _choose(self, cand: np.ndarray, sims: np.ndarray, m: int) -> np.ndarray:
        """At most ``m`` candidates per row: those nearer to the row than to any chosen before, then the nearest others."""
        order = np.argsort(-sims, axis=1, kind="stable")
        cand, sims = np.take_along_axis(cand, order, 1), np.take_along_axis(sims, order, 1)
        rows, width = cand.shape
        valid = np.isfinite(sims) & (cand >= 0)
        v = self.vec[np.maximum(cand, 0)]
        pair = np.matmul(v, v.transpose(0, 2, 1))
        taken = np.zeros((rows, width), bool)
        count = np.zeros(rows, int)
        for c in range(width):
            near = np.where(taken, pair[:, c, :], -np.inf).max(axis=1)
            take = valid[:, c] & (near < sims[:, c]) & (count < m)
            taken[:, c] = take
            count += take
        # fill up with the nearest that were passed over
        key = np.where(valid, np.where(taken, 0, 1), 2)
        pick = np.argsort(key, axis=1, kind="stable")[:, :m]
        out = np.where(np.take_along_axis(key, pick, 1) < 2, np.take_along_axis(cand, pick, 1), -1)
        if out.shape[1] < m:
            out = np.pad(out, ((0, 0), (0, m - out.shape[1])), constant_values=-1)
        return out

    def _beam(self, q: np.ndarray, entry: np.ndarray, layer: int, ef: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``ef`` nearest that a beam of that width finds in a layer, per query; -1 pads."""
        nbr = self.layers[layer]
        n = len(q)
        ids = np.full((n, ef), -1, np.int64)
        sims = np.full((n, ef), -np.inf, np.float32)
        done = np.ones((n, ef), bool)
        w = min(entry.shape[1], ef)
        e = np.where(entry[:, :w] < len(nbr), entry[:, :w], 0)
        for c in range(1, w):
            e[:, c][(e[:, :c] == e[:, c : c + 1]).any(axis=1)] = -1
        ids[:, :w] = e
        s = np.einsum("qmd,qd->qm", self.vec[np.maximum(e, 0)], q)
        sims[:, :w] = np.where(e >= 0, s, -np.inf)
        done[:, :w] = e < 0
        live = np.arange(n)
        while len(live):
            score = np.where(done[live], -np.inf, sims[live])
            pick = score.argmax(axis=1)
            go = np.isfinite(score[np.arange(len(live)), pick])
            live, pick = live[go], pick[go]
            if not len(live):
                break
            done[live, pick] = True
            nxt = nbr[ids[live, pick]].astype(np.int64)
            s = np.einsum("qmd,qd->qm", self.vec[np.maximum(nxt, 0)], q[live])
            worst = sims[live].min(axis=1)
            s[(nxt < 0) | (s <= worst[:, None])] = -np.inf
            use = np.flatnonzero(np.isfinite(s).any(axis=1))
            if not len(use):
                continue
            rows = live[use]
            nxt, s = nxt[use], s[use]
            s[(nxt[:, :, None] == ids[rows][:, None, :]).any(axis=2)] = -np.inf
            all_s = np.concatenate((sims[rows], s), axis=1)
            keep = np.argpartition(-all_s, ef - 1, axis=1)[:, :ef]
            sims[rows] = np.take_along_axis(all_s, keep, 1)
            new_ids = np.take_along_axis(np.concatenate((ids[rows], nxt), axis=1), keep, 1)
            ids[rows] = np.where(np.isfinite(sims[rows]), new_ids, -1)
            new_done = np.concatenate((done[rows], np.zeros(s.shape, bool)), axis=1)
            done[rows] = np.take_along_axis(new_done, keep, 1) | ~np.isfinite(sims[rows])
        return ids, sims

    def matches(self, q: np.ndarray, least: float, ef: int, block: int = 1024, wide: int = 8192):
        """Similar places of the queries, in parts: (queries, places, similarities as a matrix).

        Queries whose beam is filled with places of similarity ``least`` or more are taken together, and so are
        the others of a block that found one: all that can be reached over places similar
        to one of them, along links of the graph in either direction, is compared with each of them, as matrices of at most
        ``wide`` places. A place that no place near it points to points to one itself, so narrow beams do. No cap
        on their number, and no list of the pairs.
        """
        for at in range(0, len(q), block):
            part = q[at : at + block]
            entry = np.zeros((len(part), 1), np.int64)
            for l in range(len(self.layers) - 1, 0, -1):
                entry = np.maximum(self._beam(part, entry, l, 1)[0], 0)
            ids, sims = self._beam(part, entry, 0, ef)
            hit = sims >= least
            full = hit.all(axis=1)
            for group in (hit.any(axis=1) & ~full, full):
                rows = np.flatnonzero(group)
                if not len(rows):
                    continue
                asked = part[rows]
                seen = np.zeros(len(self.vec), bool)
                front = np.unique(ids[rows][hit[rows]])
                seen[front] = True
                region = [front]
                while len(front):
                    near = np.unique(np.concatenate((self.layers[0][front].ravel(), self._pointing(front))))
                    near = near[(near >= 0) & ~seen[np.maximum(near, 0)]]
                    seen[near] = True
                    front = near[self._touched(asked, near, least)]
                    region.append(front)
                places = np.concatenate(region).astype(np.int64)
                for k in range(0, len(places), wide):
                    some = places[k : k + wide]
                    yield rows + at, some, asked @ self.vec[some].T

    @cached_property
    def _back(self) -> tuple[np.ndarray, np.ndarray]:
        """Places by the place they point to in the lowest layer, and where those of each place begin."""
        nbr = self.layers[0]
        src, column = np.nonzero(nbr >= 0)
        dst = nbr[src, column]
        order = np.argsort(dst, kind="stable")
        return src[order].astype(np.int32), np.searchsorted(dst[order], np.arange(len(nbr) + 1))

    def _pointing(self, places: np.ndarray) -> np.ndarray:
        """Places that point to one of ``places`` in the lowest layer."""
        src, first = self._back
        count = first[places + 1] - first[places]
        at = np.repeat(first[places] - np.cumsum(count) + count, count) + np.arange(count.sum())
        return src[at]

    def _touched(self, asked: np.ndarray, places: np.ndarray, least: float, step: int = 8192) -> np.ndarray:
        """Whether each place is similar to one of the queries."""
        parts = [(asked @ self.vec[places[k : k + step]].T).max(axis=0) >= least for k in range(0, len(places), step)]
        return np.concatenate(parts) if parts else np.zeros(0, bool)

    def within(self, q: np.ndarray, least: float, ef: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, place) of similarity ``least`` or more that ``matches`` gives, as a list."""
        out = [np.zeros((2, 0), np.int64)]
        for rows, places, sims in self.matches(q, least, ef):
            i, j = np.nonzero(sims >= least)
            out.append(np.stack((rows[i], places[j])))
        a, b = np.concatenate(out, axis=1)
        return a, b

    def audit(
        self, least: float, goal: float, queries: np.ndarray, own: np.ndarray, enough: int = 256, block: int = 256
    ) -> tuple[int, np.ndarray, np.ndarray]:
        """Widen the beam until ``goal`` of the pairs that brute force finds for the ``queries`` are
        found; the beam, and per query the pairs there are and those found.

        ``own`` is a query's place if it is a row of the graph, else -1: its pair with itself is no
        evidence and left out. Queries are used in blocks until ``enough`` pairs were seen. A
        beam as wide as the graph ends it.
        """
        n = len(self.vec)
        truth, seen, used = [np.zeros(0, np.int64)], 0, 0
        while used < len(queries) and seen < enough:
            i, j = np.nonzero(queries[used : used + block] @ self.vec.T >= least)
            i += used
            keep = own[i] != j
            truth.append(i[keep] * n + j[keep])
            seen += int(keep.sum())
            used = min(used + block, len(queries))
        pairs = np.concatenate(truth)
        there = np.bincount(pairs // max(n, 1), minlength=len(queries))
        ef = 24
        while True:
            ask = np.flatnonzero(there)  # the others have nothing to find
            a, b = self.within(queries[ask], least, ef)
            hit = np.isin(pairs, ask[a] * n + b)
            if not len(pairs) or hit.mean() >= goal or ef >= n:
                return ef, there, np.bincount(pairs[hit] // max(n, 1), minlength=len(queries))
            ef *= 2

    def to_bytes(self, **more: np.ndarray) -> bytes:
        sink = io.BytesIO()
        np.savez(sink, order=self.order, vec=self.vec, **{f"layer{i}": l for i, l in enumerate(self.layers)}, **more)
        return sink.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> tuple[Hnsw, dict[str, np.ndarray]]:
        z = dict(np.load(io.BytesIO(data)))
        self = cls.__new__(cls)
        self.order, self.vec = z.pop("order"), z.pop("vec")
        self.layers = [z.pop(f"layer{i}") for i in range(sum(k.startswith("layer") for k in z))]
        return self, z
