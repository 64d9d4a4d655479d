"""Proposals of parameter sets that learn from earlier trials."""

from __future__ import annotations

import math
import random
from collections.abc import Callable

#: Trials before proposals, draws per proposal, and the share of trials that count as good.
STARTUP, CANDIDATES, GOOD_SHARE = 10, 24, 0.25


def draw(space: dict, rng: random.Random) -> dict:
    """One parameter set. ``quniform`` rounds to its step, and never to zero or below."""
    return {name: on_step(how, rng.uniform(how[1], how[2])) for name, how in space.items()}


def on_step(how: tuple, value: float) -> float:
    """A value of a ``uniform`` or ``quniform`` parameter."""
    kind, low, _, *step = how
    return max(round(value / step[0]) * step[0], low) if kind == "quniform" else value


class Density:
    """Mixture of normal densities around observed values of one parameter, and one wide one over its range.

    A value's normal is as wide as the larger gap to its neighbours, within bounds that shrink
    with the number of values; all are cut off at the range.
    """

    def __init__(self, values: list[float], low: float, high: float):
        self.low, self.high = low, high
        span = (high - low) or 1.0
        points = sorted([*values, (low + high) / 2])
        widest, least = span, span / min(100.0, 1.0 + len(points))
        self.parts = []
        prior_placed = False
        for i, v in enumerate(points):
            left = v - points[i - 1] if i else v - low
            right = points[i + 1] - v if i + 1 < len(points) else high - v
            wide = not prior_placed and v == (low + high) / 2
            prior_placed |= wide
            self.parts.append((v, span if wide else min(max(left, right, least), widest)))

    def sample(self, rng: random.Random) -> float:
        center, width = rng.choice(self.parts)
        for _ in range(100):
            value = rng.gauss(center, width)
            if self.low <= value <= self.high:
                return value
        return min(max(value, self.low), self.high)

    def log_pdf(self, value: float) -> float:
        total = 0.0
        for center, width in self.parts:
            inside = _cdf((self.high - center) / width) - _cdf((self.low - center) / width)
            total += math.exp(-0.5 * ((value - center) / width) ** 2) / (width * max(inside, 1e-12))
        return math.log(max(total / len(self.parts), 1e-300))


def _cdf(z: float) -> float:
    return 0.5 * (1 + math.erf(z / math.sqrt(2)))


class Proposer:
    """Next parameter set from the trials so far.

    After ``STARTUP`` random draws the best trials (a share of them) and the rest give a
    density each per parameter; of several draws from the good one, the value with the
    largest ratio of good to rest is taken.
    """

    def __init__(self, space: dict, seed: str | int, startup: int = STARTUP, learns: bool = True):
        self.space, self.rng, self.startup, self.learns = space, random.Random(seed), startup, learns
        self.seen: list[tuple[float, dict]] = []

    def tell(self, params: dict, loss: float) -> None:
        self.seen.append((loss, params))

    def next(self) -> dict:
        if not self.learns or len(self.seen) < self.startup:
            return draw(self.space, self.rng)
        ranked = [p for _, p in sorted(self.seen, key=lambda t: t[0])]
        n = max(1, math.ceil(GOOD_SHARE * math.sqrt(len(ranked)) * 2))
        out = {}
        for name, how in self.space.items():
            good = Density([p[name] for p in ranked[:n]], how[1], how[2])
            rest = Density([p[name] for p in ranked[n:]], how[1], how[2])
            values = [on_step(how, good.sample(self.rng)) for _ in range(CANDIDATES)]
            out[name] = max(values, key=lambda v: good.log_pdf(v) - rest.log_pdf(v))
        return out


def minimize(loss: Callable[[dict], float], space: dict, trials: int, seed: int, learns: bool = True) -> tuple[dict, float]:
    """Best parameter set and loss of a number of trials."""
    proposer = Proposer(space, seed, learns=learns)
    best: tuple[float, dict] | None = None
    for _ in range(trials):
        params = proposer.next()
        got = loss(params)
        proposer.tell(params, got)
        if best is None or got < best[0]:
            best = (got, params)
    return best[1], best[0]
