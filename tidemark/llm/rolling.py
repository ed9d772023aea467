"""Vectorised hashes of all k-grams of a sequence, and the winnowed ones among them.

Winnowing keeps the smallest hash of every ``w`` consecutive k-grams. Two places that agree in
``k + w - 1`` consecutive items agree in those ``w`` hashes and so in the one that is kept: no match
of that length can be missed.
"""

from __future__ import annotations

import numpy as np

MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_A, _B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values, one to one."""
    h = (h ^ (h >> np.uint64(30))) * _A
    h = (h ^ (h >> np.uint64(27))) * _B
    return h ^ (h >> np.uint64(31))


def chain(name: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Names of sequences that are one word longer."""
    with np.errstate(over="ignore"):
        return mix(name * MULTIPLIER + word)


def gram_hashes(items: np.ndarray, k: int, multiplier: np.uint64 = MULTIPLIER) -> np.ndarray:
    """Hashes of the ``len(items) - k + 1`` runs of ``k`` items (uint64), by doubling."""
    n = len(items) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        power, factor, span = items, multiplier, 1
        total, have = None, 0
        rest = k
        while rest:
            if rest & 1:
                piece = power[: len(items) - span + 1]
                if total is None:
                    total, have = piece, span
                else:
                    m = len(items) - (have + span) + 1
                    total = total[:m] * factor + piece[have : have + m]
                    have += span
            rest >>= 1
            if rest:
                m = len(power) - span
                power = power[:m] * factor + power[span : span + m]
                factor = factor * factor
                span *= 2
        return mix(total)


def window_min(h: np.ndarray, w: int) -> np.ndarray:
    """Smallest value of every ``w`` consecutive ones."""
    n = len(h) - w + 1
    if n <= 0:
        return np.empty(0, h.dtype)
    span = 1
    while span * 2 <= w:
        h = np.minimum(h[:-span], h[span:])
        span *= 2
    return h[:n] if span == w else np.minimum(h[:n], h[w - span : w - span + n])
