"""The rules of bars, lateness and signals over whole columns, for tests."""

from __future__ import annotations

from itertools import accumulate

import numpy as np


def _on_time(ms: np.ndarray, size: int) -> np.ndarray:
    """True where a tick's window was still open for its partition: its end lies behind every earlier event time."""
    earlier = np.concatenate(([-1], np.maximum.accumulate(ms)[:-1])) if len(ms) else ms
    return ms - ms % size + size > earlier


def _average(closes: list[float], period: int) -> list[float]:
    weight = 2.0 / (period + 1)
    return list(accumulate(closes, lambda before, close: weight * close + (1 - weight) * before, initial=0.0))


def _side(fast: float, slow: float) -> int:
    return (fast > slow) - (fast < slow)


def closed_points(ticks, size_ms=300_000, drop_late=True):
    """(symbol, partition, ms, price) in arrival order → {symbol: [(start, close, fast, slow, signal)]}."""
    closes: dict[str, dict[int, float]] = {}
    for partition in {t[1] for t in ticks}:
        own = [t for t in ticks if t[1] == partition]
        ms = np.array([t[2] for t in own], np.int64)
        counted = _on_time(ms, size_ms) if drop_late else np.ones(len(ms), bool)
        # a stable sort by event time leaves the last arrival of equal times last, and the last one is the close
        for i in np.argsort(ms, kind="stable"):
            start = int(ms[i] - ms[i] % size_ms)
            if counted[i] and start + size_ms <= ms.max():
                closes.setdefault(own[i][0], {})[start] = own[i][3]
    result = {}
    for symbol, found in closes.items():
        starts = sorted(found)
        prices = [found[s] for s in starts]
        pairs = list(zip(_average(prices, 38), _average(prices, 100)))
        sides = [_side(*p) for p in pairs]
        turn = {1: "BUY", -1: "SELL", 0: None}
        signals = [turn[now] if now != before else None for before, now in zip(sides, sides[1:])]
        result[symbol] = [(s, c, *p, g) for s, c, p, g in zip(starts, prices, pairs[1:], signals)]
    return result
