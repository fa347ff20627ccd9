"""Hashes of many substrings of a byte array at once, by prefix sums."""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Random values of the bytes, powers of the base and of its inverse modulo 2^64."""
    if not _POWERS or len(_POWERS["up"]) < n:
        size = max(n, 1 << 16)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
        _POWERS["value"] = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64)
    return _POWERS["value"], _POWERS["up"], _POWERS["down"]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads their bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """s with s[j] - s[i] = the sum of the bytes of data[i:j], each times the base to its place."""
    value, up, _ = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(value[data] * up[:len(data)], out=sums[1:])
    return sums


def substring_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each substring that depends on its bytes only."""
    down = _powers(len(sums))[2]
    return mixed((sums[ends] - sums[starts]) * down[starts])


def gram_hashes(sums: np.ndarray, gram: int) -> np.ndarray:
    """The hash of the ``gram`` bytes from each place on."""
    down = _powers(len(sums))[2]
    return mixed((sums[gram:] - sums[:-gram]) * down[:len(sums) - gram])
