"""A compressed FM-index over words: order-k sort transform, wavelet matrix with packed bits, backward search."""

from __future__ import annotations

import numpy as np

U = np.uint64


class PackedBits:
    """Bits in 64-bit words with a running count before each word."""

    def __init__(self, bits: np.ndarray) -> None:
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)[:-1]]).astype(np.int32)

    def ones(self, at: np.ndarray) -> np.ndarray:
        """How many ones stand before each place."""
        word = at >> 6
        low = self.words[word] & ((U(1) << (at & 63).astype(np.uint64)) - U(1))
        return self.before[word] + np.bitwise_count(low)


class WaveletMatrix:
    """Rank of any symbol at any place of a sequence, one packed bit row for each bit of the symbols."""

    def __init__(self, seq: np.ndarray, sigma: int) -> None:
        self.depth = max(1, int(sigma - 1).bit_length())
        self.rows: list[PackedBits] = []
        self.zeros: list[int] = []
        for level in range(self.depth - 1, -1, -1):
            bit = (seq >> level & 1).astype(bool)
            self.rows.append(PackedBits(bit))
            self.zeros.append(int(len(seq) - bit.sum()))
            seq = np.concatenate([seq[~bit], seq[bit]])
        all_symbols = np.arange(sigma)
        self.base = self._walk(all_symbols, np.zeros(sigma, np.int64))

    def _walk(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for k, (row, zeros) in enumerate(zip(self.rows, self.zeros, strict=True)):
            one = row.ones(at)
            at = np.where(symbol >> (self.depth - 1 - k) & 1, zeros + one, at - one)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self._walk(symbol, at) - self.base[symbol]


class FmIndex:
    """Index of texts of word hashes that finds stretches of `window` words.

    Suffixes are sorted by their first `window` words only (a sort transform of that order), which is as far as a search
    goes: rows of one group share them. A separator follows each text, so no match crosses texts.
    """

    def __init__(self, hashes: np.ndarray, sizes: np.ndarray, window: int) -> None:
        self.window = window
        self.vocabulary, sym = np.unique(hashes, return_inverse=True)
        n = len(hashes) + len(sizes)
        ends = np.cumsum(sizes + 1) - 1
        seq = np.zeros(n, np.int64)
        words = np.ones(n, bool)
        words[ends] = False
        seq[words] = sym + 1
        self.text_of = np.repeat(np.arange(len(sizes)), sizes + 1)
        rank, have = seq, 1
        while have < window:
            step = min(have, window - have)
            behind = np.zeros(n, np.int64)
            behind[: n - step] = rank[step:] + 1
            both = rank * (n + len(self.vocabulary) + 2) + behind
            rank, have = np.unique(both, return_inverse=True)[1], have + step
        self.rows = np.argsort(rank, kind="stable")
        ordered = rank[self.rows]
        heads = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        self.group = np.cumsum(np.concatenate([[False], ordered[1:] != ordered[:-1]]))
        self.low = heads
        self.high = np.append(heads[1:], n)
        sigma = len(self.vocabulary) + 1
        self.before = np.concatenate([[0], np.cumsum(np.bincount(seq, minlength=sigma))])[:sigma]
        self.tree = WaveletMatrix(seq[self.rows - 1], sigma)
        self.n = n

    def symbols(self, hashes: np.ndarray) -> np.ndarray:
        """Symbols of words, -1 for words that the index doesn't hold."""
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), max(len(self.vocabulary) - 1, 0))
        return np.where(self.vocabulary[at] == hashes, at + 1, -1) if len(self.vocabulary) else np.full(len(hashes), -1)

    def extend(self, low: np.ndarray, high: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One step of backward search: rows that begin with the symbol and then what [low, high) begins with."""
        known = np.maximum(symbol, 0)
        both = self.tree.rank(np.concatenate([known, known]), np.concatenate([low, high]))
        low, high = self.before[known] + both[: len(low)], self.before[known] + both[len(low) :]
        return low, np.where(symbol > 0, high, low)

    def search(self, seq: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Group of each window of seq that begins at start, or -1: a backward search from its last word."""
        out = np.full(len(start), -1)
        at = np.arange(len(start))
        low, high = np.zeros(len(at), np.int64), np.full(len(at), self.n)
        for k in range(self.window - 1, -1, -1):
            low, high = self.extend(low, high, seq[start[at] + k])
            live = low < high
            at, low, high = at[live], low[live], high[live]
        out[at] = self.group[low]
        return out

    def matches(self, hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """For each word of the streamed texts, the group of the window that begins there, or -1 (matching statistic too short).

        Texts go in step from their ends: a match is extended by the word to its left, then let go on its right by
        widening to its group; where that fails, the window is searched from its end.
        """
        seq = self.symbols(hashes)
        out = np.full(len(seq), -1)
        first = np.cumsum(sizes) - sizes
        lanes = np.flatnonzero(sizes >= self.window)
        lanes = lanes[np.argsort(-sizes[lanes], kind="stable")]
        steps = sizes[lanes] - self.window
        where = first[lanes] + steps
        now = self.search(seq, where)
        out[where] = now
        for k in range(1, int(steps.max(initial=0)) + 1):
            live = int(np.searchsorted(-steps, -k, side="right"))
            where, now = where[:live] - 1, now[:live]
            held = now >= 0
            nxt = np.full(live, -1)
            low, high = self.extend(self.low[now[held]], self.high[now[held]], seq[where[held]])
            nxt[held] = np.where(low < high, self.group[np.minimum(low, self.n - 1)], -1)
            anew = np.flatnonzero(nxt < 0)
            if len(anew):
                nxt[anew] = self.search(seq, where[anew])
            now = nxt
            out[where] = now
        return out

    def least(self, value: np.ndarray) -> np.ndarray:
        """Least value of the texts in which each group's windows begin."""
        return np.minimum.reduceat(value[self.text_of[self.rows]], self.low)
