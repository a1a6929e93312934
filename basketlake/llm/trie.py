"""Elias-Fano levels of an n-gram trie: monotone sequences of bits, memory-mapped, searched in batches.

A level holds, for each context, its followers in ascending order. Counted from the context's own base they
form one monotone sequence; another gives where each context's followers begin. Each follower has a quantised
smoothed log-probability. A query is a successor search in its context's range.
"""

from __future__ import annotations

import json
import mmap

import numpy as np

#: Log10 probabilities from 0 down to -LOWEST are kept in 16 bits.
LOWEST = 16.0


def quantise(logp: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(-logp * (65_535 / LOWEST)), 0, 65_535).astype(np.uint16)


def unquantise(code: np.ndarray) -> np.ndarray:
    return code.astype(np.float64) * (-LOWEST / 65_535)


class EliasFano:
    """``values`` ascending: low bits packed, high bits in unary, and a count of zeros for every 64 bits of these."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, zeros: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.zeros = n, low_bits, low, high, zeros
        self.words = np.ndarray((max(len(low) - 7, 1),), "<u8", buffer=low, strides=(1,))
        self.ones = np.arange(1, len(high) + 1, dtype=np.int64) * 64 - zeros

    @staticmethod
    def arrays(values: np.ndarray) -> tuple[int, int, np.ndarray, np.ndarray, np.ndarray]:
        n, top = len(values), int(values[-1]) + 1 if len(values) else 1
        bits = max(0, (top // max(n, 1)).bit_length() - 1)
        bit = np.zeros(n * bits + 7 >> 3 << 3, np.uint8)
        for k in range(bits):
            bit[k : n * bits : bits] = (values >> np.uint64(k)) & np.uint64(1)
        low = np.concatenate([np.packbits(bit, bitorder="little"), np.zeros(8, np.uint8)])
        up = (values >> np.uint64(bits)).astype(np.int64)
        length = (int(up[-1]) if n else 0) + n + 1
        flags = np.zeros((length + 63) // 64 * 64, np.uint8)
        flags[up + np.arange(n)] = 1
        high = np.packbits(flags, bitorder="little").view("<u8")
        return n, bits, low, high, np.cumsum(64 - np.bitwise_count(high).astype(np.int64))

    def _select(self, k: np.ndarray, ends: np.ndarray, flip: bool) -> np.ndarray:
        """Place of the k-th one (or zero, if ``flip``) of the high bits, from zero."""
        word = np.searchsorted(ends, k, side="right")
        rest = (k - np.where(word > 0, ends[np.maximum(word, 1) - 1], 0)).astype(np.int64)
        w = self.high[word]
        w = ~w if flip else w
        at = np.zeros(len(k), np.int64)
        for step in (32, 16, 8, 4, 2, 1):
            c = np.bitwise_count((w >> at.astype(np.uint64)) & np.uint64((1 << step) - 1)).astype(np.int64)
            go = rest >= c
            rest -= np.where(go, c, 0)
            at += np.where(go, step, 0)
        return word * 64 + at

    def _low(self, i: np.ndarray) -> np.ndarray:
        at = i * self.low_bits
        return (self.words[at >> 3] >> (at & 7).astype(np.uint64)) & np.uint64((1 << self.low_bits) - 1)

    def get(self, i: np.ndarray) -> np.ndarray:
        return ((self._select(i, self.ones, False) - i).astype(np.uint64) << np.uint64(self.low_bits)) | self._low(i)

    def successor(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, hit): of the first value not below x, and whether it equals x."""
        h = (x >> np.uint64(self.low_bits)).astype(np.int64)
        most = int(self.zeros[-1]) - 1
        over = h > most
        h = np.minimum(h, most)
        begin = np.where(h > 0, self._select(np.maximum(h - 1, 0), self.zeros, True) - (h - 1), 0)
        end = self._select(h, self.zeros, True) - h
        want = x & np.uint64((1 << self.low_bits) - 1)
        lo, hi = begin.copy(), end.copy()
        while True:
            live = np.nonzero(lo < hi)[0]
            if not len(live):
                break
            mid = (lo[live] + hi[live]) >> 1
            less = self._low(mid) < want[live]
            lo[live] = np.where(less, mid + 1, lo[live])
            hi[live] = np.where(less, hi[live], mid)
        hit = (lo < end) & ~over
        hit[hit] = self._low(lo[hit]) == want[hit]
        return np.where(over, self.n, lo), hit


class Level:
    """One level of a trie, in a file or not."""

    def __init__(self, followers: EliasFano, pointers: EliasFano, codes: np.ndarray, width: int):
        self.followers, self.pointers, self.codes, self.width = followers, pointers, codes, width

    @classmethod
    def build(cls, context: np.ndarray, follower: np.ndarray, logp: np.ndarray, contexts: int) -> Level:
        """From pairs sorted by context and follower, contexts numbered from zero."""
        width = int(follower.max()) + 1 if len(follower) else 1
        values = context.astype(np.uint64) * np.uint64(width) + follower.astype(np.uint64)
        starts = np.searchsorted(context, np.arange(contexts + 1)).astype(np.uint64)
        return cls(EliasFano(*EliasFano.arrays(values)), EliasFano(*EliasFano.arrays(starts)), quantise(logp), width)

    def save(self, path: str) -> None:
        parts, head = [], {"width": self.width, "ef": [], "arrays": []}
        for ef in (self.followers, self.pointers):
            head["ef"].append([ef.n, ef.low_bits])
            parts += [ef.low, ef.high, ef.zeros]
        parts.append(self.codes)
        at = 0
        for a in parts:
            head["arrays"].append([at, len(a), a.dtype.str])
            at += -(-a.nbytes // 8) * 8
        text = json.dumps(head).encode()
        with open(path, "wb") as f:
            f.write(len(text).to_bytes(8, "little") + text.ljust(-(-len(text) // 8) * 8))
            for a in parts:
                f.write(a.tobytes() + b"\0" * (-a.nbytes % 8))

    @classmethod
    def open(cls, path: str) -> Level:
        with open(path, "rb") as f:
            held = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        n = int.from_bytes(held[:8], "little")
        head, first = json.loads(held[8 : 8 + n]), 8 + -(-n // 8) * 8
        a = [np.frombuffer(held, dtype, count, first + at) for at, count, dtype in head["arrays"]]
        ef = [EliasFano(*head["ef"][k], *a[3 * k : 3 * k + 3]) for k in (0, 1)]
        return cls(ef[0], ef[1], a[6], head["width"])

    def find(self, context: np.ndarray, follower: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(hit, log10 probability where hit) of followers, each within its own context's range."""
        inside = follower < self.width
        x = context.astype(np.uint64) * np.uint64(self.width) + np.where(inside, follower, 0).astype(np.uint64)
        at, hit = self.followers.successor(x)
        begin, end = self.pointers.get(context.astype(np.int64)).astype(np.int64), self.pointers.get(context.astype(np.int64) + 1).astype(np.int64)
        hit &= inside & (at >= begin) & (at < end)
        logp = np.zeros(len(x))
        logp[hit] = unquantise(self.codes[at[hit]])
        return hit, logp
