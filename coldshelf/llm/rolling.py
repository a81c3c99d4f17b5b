"""Hashes of any stretch of a byte string, from running sums: for all stretches at once."""

from __future__ import annotations

from functools import cache

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


@cache
def _byte_values() -> np.ndarray:
    return np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64)


_known: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, at least n of each."""
    if not _known or len(_known["up"]) < n:
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            made = np.full(max(n, 1 << 20), base, dtype=np.uint64)
            made[0] = 1
            _known[name] = np.cumprod(made, dtype=np.uint64)
    return _known["up"], _known["down"]


def stretch_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of ``data[start:end]``: equal bytes have equal hashes wherever they stand."""
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_byte_values()[data] * up[: len(data)], out=sums[1:])
    mixed = (sums[ends] - sums[starts]) * down[starts]
    return mixed ^ (mixed >> np.uint64(32))
