"""Word hashes, minimizers and runs of windows of many texts at once, with numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

U = np.uint64
_RNG = np.random.default_rng(2024)
_BYTE = _RNG.integers(0, 2**64, 256, dtype=np.uint64)
_STEP = int(_RNG.integers(0, 2**63, dtype=np.uint64)) * 2 + 1
_BACK = pow(_STEP, -1, 2**64)
_PLACE = _RNG.integers(0, 2**64, 64, dtype=np.uint64) | U(1)
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U(32))) * U(0xD6E8FEB86659FD93)
    h = (h ^ (h >> U(29))) * U(0x9E3779B97F4A7C15)
    return h ^ (h >> U(32))


def powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    with np.errstate(over="ignore"):
        np.cumprod(np.full(n - 1, base, np.uint64), out=out[1:])
    return out


class _Powers:
    """base^0, base^1, ... modulo 2^64, as far as they were needed."""

    def __init__(self, base: int) -> None:
        self.base, self.known = base, powers(base, 1 << 12)

    def upto(self, n: int) -> np.ndarray:
        if len(self.known) < n:
            self.known = powers(self.base, n)
        return self.known[:n]


_UP, _DOWN = _Powers(_STEP), _Powers(_BACK)


@dataclass(frozen=True)
class Words:
    """Words of several texts laid end to end: hash, byte range and text of each word."""

    raw: np.ndarray
    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    text: np.ndarray


def words(texts: list[bytes]) -> Words:
    """A word's hash is a sum over its bytes of a random number for the byte times a power for its place in the word."""
    raw = np.frombuffer(b" ".join(texts), np.uint8)
    inside = ~SPACE[raw]
    turn = np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))
    start, end = np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)
    n = len(raw)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[raw] * _UP.upto(n), out=sums[1:])
    h = mix((sums[end] - sums[start]) * _DOWN.upto(max(n, 1))[start] + (end - start).astype(np.uint64))
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    text = np.searchsorted(np.cumsum(sizes), start, side="right")
    return Words(raw, h, start, end, text)


def gram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each n consecutive word hashes."""
    k = len(h) - n + 1
    if k <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(k, np.uint64)
    for j in range(n):
        out += h[j : j + k] * _PLACE[j]
    return mix(out)


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Least of each w consecutive values."""
    have, out = 1, x
    while have * 2 <= w:
        out = np.minimum(out[: len(out) - have], out[have:])
        have *= 2
    if have < w:
        out = np.minimum(out[: len(out) - (w - have)], out[w - have :])
    return out


@dataclass(frozen=True)
class Runs:
    """Longest stretches of windows of one text with one minimizer: first word, windows, key, text."""

    first: np.ndarray
    count: np.ndarray
    key: np.ndarray
    text: np.ndarray


def runs(w: Words, window: int, gram: int) -> Runs:
    """Equal windows have the same minimizer, the least hash of their grams, wherever they stand."""
    none = np.zeros(0, np.int64)
    if len(w.hash) < window:
        return Runs(none, none, none, none)
    key = (sliding_min(gram_hashes(w.hash, gram), window - gram + 1) >> U(16)).astype(np.int64)
    text = w.text[: len(key)]
    fits = text == w.text[window - 1 :]
    new = fits.copy()
    new[1:] &= ~(fits[:-1] & (key[1:] == key[:-1]) & (text[1:] == text[:-1]))
    first = np.flatnonzero(new)
    upto = np.cumsum(fits)
    count = np.append(upto[first[1:] - 1], upto[-1]) - upto[first] + 1 if len(first) else none
    return Runs(first, count, key[first], text[first])
