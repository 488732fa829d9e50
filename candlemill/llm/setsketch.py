"""SetSketch registers: exponentially spaced, truncated minima of hashes.

Register ``i`` of a set holds ``floor(1 - log_b(h))`` of the least exponential variate that hash ``i``
gives its members, cut to ``[0, LEVELS]``. Registers of a union are the maxima (mergeable); equal
registers are about as frequent as shared members (locality-sensitive); how often one set's registers
are above, below or equal to the other's gives the joint likelihood of their similarity.
"""

from __future__ import annotations

import numpy as np

REGISTERS = 128
BASE = 1.001
RATE = 20.0
LEVELS = 65_534
BAND = 4
"""Registers of a band: 4 of 16 bits make one 64-bit key, exactly."""
BANDS = REGISTERS // BAND

_MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))
_S = np.uint64(33)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose every output bit depends on every input bit."""
    x = (x ^ (x >> _S)) * _MIX[0]
    x = (x ^ (x >> _S)) * _MIX[1]
    return x ^ (x >> _S)


_SEEDS = mix(np.arange(1, 2 * REGISTERS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_FACTORS = _SEEDS[:REGISTERS] | np.uint64(1)
_SHIFTS = _SEEDS[REGISTERS:]


def sketch(members: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Registers of several sets (uint16, sets by registers); ``members`` are mixed 64-bit words.

    The sets lie one after the other, none empty; ``starts`` holds where each begins.
    """
    least = np.empty((len(starts), REGISTERS), np.uint64)
    for i in range(REGISTERS):
        least[:, i] = np.minimum.reduceat(members * _FACTORS[i] + _SHIFTS[i], starts)
    uniform = (least.astype(np.float64) + 0.5) / 2.0**64
    variate = -np.log1p(-np.minimum(uniform, 1 - 2.0**-53)) / RATE
    level = np.floor(1 - np.log(variate) / np.log(BASE))
    return np.clip(level, 0, LEVELS).astype("<u2")


def merge(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets."""
    return np.maximum(one, other)


def band_keys(registers: np.ndarray) -> np.ndarray:
    """The register values of each band as signed 64-bit words (sets by bands)."""
    return np.ascontiguousarray(registers).view("<i8")


def _log_b(x: np.ndarray) -> np.ndarray:
    return -np.log1p(-x * (BASE - 1) / BASE) / np.log(BASE)


def log_likelihood(
    above: np.ndarray, below: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, similarity: np.ndarray
) -> np.ndarray:
    """Of a similarity, when ``above`` registers of A exceed B's, ``below`` are exceeded, others equal."""
    share_a = size_a / (size_a + size_b)
    share_b = 1 - share_a
    p = _log_b(np.clip(share_a - share_b * similarity, 1e-12, 1))
    q = _log_b(np.clip(share_b - share_a * similarity, 1e-12, 1))
    rest = np.clip(1 - p - q, 1e-12, 1)
    return above * np.log(p) + below * np.log(q) + (REGISTERS - above - below) * np.log(rest)


def plausible(
    above: np.ndarray, below: np.ndarray, size_a: np.ndarray, size_b: np.ndarray,
    least: float, evidence: float = 18.0,
) -> np.ndarray:
    """Pairs that may reach the similarity ``least``.

    Out go pairs whose sizes exclude it, and pairs whose best similarity is lower and more likely by
    ``evidence`` (in nats: six standard deviations).
    """
    sizes = np.minimum(size_a, size_b) / np.maximum(size_a, size_b)
    at_least = log_likelihood(above, below, size_a, size_b, np.full_like(sizes, least))
    best = np.full_like(sizes, -np.inf)
    best_at = np.zeros_like(sizes)
    for step in range(41):
        here = sizes * step / 40
        value = log_likelihood(above, below, size_a, size_b, here)
        better = value > best
        best, best_at = np.where(better, value, best), np.where(better, here, best_at)
    return (sizes >= least - 1e-9) & ((best_at >= least) | (best - at_least <= evidence))
