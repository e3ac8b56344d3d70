"""Static 3-wise binary-fuse filters with 16-bit fingerprints, built and asked with numpy."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np

U = np.uint64


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    h = keys + U(seed)
    h = (h ^ (h >> U(33))) * U(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> U(33))) * U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U(33))


@dataclass(frozen=True)
class FuseFilter:
    """Holds a fixed set of 64-bit keys: no false negatives, about 1 false positive in 65,536."""

    seed: int
    segment: int
    count: int
    table: np.ndarray

    @staticmethod
    def slots(h: np.ndarray, segment: int, count: int) -> np.ndarray:
        """Three slots of each hash, in three adjacent segments."""
        mask = U(segment - 1)
        a = ((h >> U(32)) * U(segment * count)) >> U(32)
        b = (a + U(segment)) ^ ((h >> U(18)) & mask)
        c = (a + U(2 * segment)) ^ (h & mask)
        return np.stack([a, b, c]).astype(np.int64)

    @staticmethod
    def prints(h: np.ndarray) -> np.ndarray:
        return (h ^ (h >> U(32))).astype(np.uint16)

    @classmethod
    def build(cls, keys: np.ndarray) -> FuseFilter:
        """Peel keys that are alone in a slot, round by round; on a failure another seed is tried."""
        keys = np.unique(np.asarray(keys).astype(np.uint64))
        n = len(keys)
        segment = 1 << max(2, min(18, math.floor(math.log(max(n, 2)) / math.log(3.33) + 2.25)))
        room = max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(max(n, 2)))
        count = max(1, math.ceil(n * room / segment) - 2)
        for attempt in range(1, 200):
            seed = attempt * 0x9E3779B97F4A7C15 % 2**64
            h = _mix(keys, seed)
            at = cls.slots(h, segment, count)
            size = segment * (count + 2)
            load, whose = np.zeros(size, np.int32), np.zeros(size, np.int64)
            for row in at:
                np.add.at(load, row, 1)
                np.bitwise_xor.at(whose, row, np.arange(n))
            order: list[tuple[np.ndarray, np.ndarray]] = []
            left, alone = n, np.flatnonzero(load == 1)
            while len(alone):
                key, first = np.unique(whose[alone], return_index=True)
                slot = alone[first]
                order.append((key, slot))
                left -= len(key)
                for row in at:
                    np.subtract.at(load, row[key], 1)
                    np.bitwise_xor.at(whose, row[key], key)
                touched = np.unique(at[:, key])
                alone = touched[load[touched] == 1]
            if not left:
                table, fp = np.zeros(size, np.uint16), cls.prints(h)
                for key, slot in reversed(order):
                    table[slot] = 0
                    table[slot] = fp[key] ^ np.bitwise_xor.reduce(table[at[:, key]], axis=0)
                return cls(seed, segment, count, table)
            if attempt % 20 == 0:
                count += 1
        raise ValueError("no binary-fuse filter was found")

    def may_hold(self, keys: np.ndarray) -> np.ndarray:
        h = _mix(np.asarray(keys).astype(np.uint64), self.seed)
        return np.bitwise_xor.reduce(self.table[self.slots(h, self.segment, self.count)], axis=0) == self.prints(h)

    def pack(self) -> bytes:
        return np.array([self.seed, self.segment, self.count], np.uint64).tobytes() + self.table.tobytes()

    @classmethod
    def unpack(cls, raw: bytes) -> FuseFilter:
        seed, segment, count = (int(x) for x in np.frombuffer(raw, np.uint64, 3))
        return cls(seed, segment, count, np.frombuffer(raw, np.uint16, offset=24))
