"""Adaptive context-mixing range coder for token ids, many blocks in lockstep.

Every block starts from the same fresh state, so blocks are independent and numpy can step through all of them at once.
What they share is a model of order 0, the counts of the ids they are made of, which stands before them. At each id,
order-2 and order-1 contexts each name the id that followed them last. How likely each is right is a logistic mix of its
own record, of the other order's agreement, and of the order-0 count of the id named; the weights learn in every block. One
symbol then says which of them holds or, if none does, which id comes, by its share of the order-0 counts. All arithmetic is
on integers, so files are read back alike on any machine.
"""

from __future__ import annotations

import zlib

import numpy as np

from basketlake.llm.packing import pack, unpack

BLOCK = 4096
LANES = 4096
#: Blocks whose ids are turned into places, and back, at a time.
_SOME = 128
#: Hash slots of the contexts of a block; both are powers of two.
_H1, _H2 = 512, 1024
#: Bits of a hit's frequencies and of the order-0 counts: a symbol has 32, and the ranges stay above that.
_HIT, _ID = 12, 20
#: Ids below this are counted and found by a table.
_DENSE = 1 << 22
_HALF, _BITS = np.uint64(32), np.uint64(_ID)
_LEAST, _MASK = np.uint64(1 << 32), np.uint64((1 << 32) - 1)
_SQUASH = np.clip(np.rint(4096 / (1 + np.exp(-np.arange(-2048, 2049) / 256.0))), 16, 4080).astype(np.int32)
_STRETCH = np.clip(np.rint(256 * np.log((np.arange(4096) + 0.5) / (4095.5 - np.arange(4096)))), -2047, 2047).astype(np.int32)


class Model:
    """The ids of some blocks in ascending order, and their counts scaled to 2^20, at least one each."""

    def __init__(self, ids: np.ndarray, freq: np.ndarray):
        self.ids, self.freq = ids.astype(np.int64), freq.astype(np.uint64)
        self.cum = np.concatenate([[0], np.cumsum(freq)]).astype(np.uint64)
        share = np.minimum(4095, np.concatenate([[0], freq.astype(np.int64)]) >> (_ID - 12))
        self.evidence = _STRETCH[share] >> 2
        self.kind = np.uint16 if len(ids) <= 1 << 16 else np.int32  # of places
        self.holder: np.ndarray | None = None
        self.table: np.ndarray | None = None

    @classmethod
    def of(cls, ids: np.ndarray) -> "Model":
        if len(ids) and int(ids.max()) < _DENSE:
            counts = np.zeros(int(ids.max()) + 1, np.int64)
            for k in range(0, len(ids), _SOME * BLOCK):
                part = np.bincount(ids[k : k + _SOME * BLOCK])
                counts[: len(part)] += part
            own = np.nonzero(counts)[0]
            n = counts[own]
        else:
            own, n = np.unique(ids, return_counts=True)
        total = 1 << _ID
        if len(own) >= total:
            raise ValueError(f"blocks of {len(own)} different ids need more than {_ID} bits")
        freq = 1 + n * (total - len(own)) // max(1, int(n.sum()))
        if len(own):
            freq[np.argmax(freq)] += total - int(freq.sum())
        return cls(own, freq)

    def places(self, ids: np.ndarray) -> np.ndarray:
        """Where the ids stand in the list."""
        if len(self.ids) and int(self.ids[-1]) < _DENSE:
            if self.table is None:
                self.table = np.zeros(int(self.ids[-1]) + 1, np.int32)
                self.table[self.ids] = np.arange(len(self.ids), dtype=np.int32)
            return self.table[ids]
        return np.searchsorted(self.ids, ids)

    def find(self, share: np.ndarray) -> np.ndarray:
        """Places of the ids whose part of the counts holds ``share``."""
        if self.holder is None:
            self.holder = np.repeat(np.arange(len(self.ids), dtype=np.int32), self.freq.astype(np.int64))
        return self.holder.take(share, mode="clip")

    def packed(self) -> bytes:
        a, b = pack(np.diff(self.ids, prepend=0)), pack(self.freq)
        return len(a).to_bytes(4, "little") + a + b

    @classmethod
    def unpacked(cls, data: bytes) -> "Model":
        n = 4 + int.from_bytes(data[:4], "little")
        return cls(np.cumsum(unpack(data[4:n]).astype(np.int64)), unpack(data[n:]))


class _Writer:
    """Ranges of 64 bits, of which 32 leave at a time; one that spans a border is cut at it, so nothing carries."""

    def __init__(self, lanes: int, steps: int):
        self.low, self.range = np.zeros(lanes, np.uint64), np.full(lanes, 2**64 - 1, np.uint64)
        width = steps + 4
        self.out, self.at = np.zeros(lanes * width, np.uint32), np.arange(lanes, dtype=np.int64) * width
        self.first = self.at.copy()

    def take(self, n: int, cum: np.ndarray, freq: np.ndarray) -> None:
        """A symbol of 32 bits for each of the first ``n`` lanes."""
        low, rng = self.low[:n], self.range[:n]
        rng >>= _HALF
        low += rng * cum
        rng *= freq
        small = np.flatnonzero(rng < _LEAST)
        if len(small):
            lo, at = low[small], self.at[small]
            self.out[at] = lo >> _HALF
            self.at[small] = at + 1
            low[small], rng[small] = lo << _HALF, _cut(lo, rng[small]) << _HALF

    def done(self) -> list[bytes]:
        for part in (self.low >> _HALF, self.low & _MASK):
            self.out[self.at] = part
            self.at += 1
        return [self.out[a:b].astype("<u4").tobytes() for a, b in zip(self.first.tolist(), self.at.tolist(), strict=True)]


def _cut(low: np.ndarray, rng: np.ndarray) -> np.ndarray:
    spans = ((low ^ (low + rng - np.uint64(1))) >> _HALF) != 0
    return np.where(spans, -low & _MASK, rng)


class _Reader:
    def __init__(self, payloads: list[bytes]):
        words = [np.frombuffer(p[: len(p) // 4 * 4], "<u4") for p in payloads]
        self.data = np.concatenate([*words, np.zeros(4, np.uint32)])
        self.at = np.concatenate([[0], np.cumsum([len(x) for x in words])[:-1]]).astype(np.int64)
        n = len(payloads)
        # The place of the code within the range is kept, not the code itself.
        self.low, self.range = np.zeros(n, np.uint64), np.full(n, 2**64 - 1, np.uint64)
        every = np.arange(n)
        self.offset = (self._next(every) << _HALF) | self._next(every)

    def _next(self, on: np.ndarray) -> np.ndarray:
        at = self.at[on]
        self.at[on] = at + 1
        return self.data.take(at, mode="clip").astype(np.uint64)  # a damaged block may run on

    def target(self, n: int) -> np.ndarray:
        self.range[:n] >>= _HALF
        return np.minimum(self.offset[:n] // self.range[:n], _MASK)

    def take(self, n: int, cum: np.ndarray, freq: np.ndarray) -> None:
        low, rng, offset = self.low[:n], self.range[:n], self.offset[:n]
        step = rng * cum
        low += step
        offset -= step
        rng *= freq
        small = np.flatnonzero(rng < _LEAST)
        if len(small):
            lo = low[small]
            offset[small] = (offset[small] << _HALF) | self._next(small)
            low[small], rng[small] = lo << _HALF, _cut(lo, rng[small]) << _HALF


def _run(lengths: np.ndarray, ids: np.ndarray | None, coder, model: Model) -> np.ndarray | None:
    """Steps all blocks through coder; ``ids``, places in the model's list by step and block, is given when writing. Blocks come longest first."""
    lanes, steps = len(lengths), int(lengths.max(initial=0))
    out = np.zeros((max(steps, 1), lanes), model.kind) if ids is None else None
    # First rows belong to order 1, second ones to order 2. A slot holds the place that followed last, plus one (zero is
    # none), and in its two lowest bits how often in a row.
    every = np.arange(lanes, dtype=np.int64)
    slots, slot_of = np.zeros(lanes * (_H1 + _H2), np.int32), np.stack([every * _H1, lanes * _H1 + every * _H2])
    records, record_of = np.repeat(np.array([1000, 1400], np.int32), lanes * 8), np.stack([every * 8, (lanes + every) * 8])
    w = np.full((2, 3, lanes), 24_000, np.int32)
    a, b = np.zeros(lanes, np.int32), np.zeros(lanes, np.int32)  # the ids before
    alive = np.searchsorted(-lengths, -np.arange(steps), side="left")  # blocks longer than each step
    evidence, cum0, freq0 = model.evidence, model.cum, model.freq
    for j in range(steps):
        n = int(alive[j])
        last, wn = a[:n], w[:, :, :n]
        k = np.empty((2, n), np.int64)
        k[0], k[1] = ((last * 403) >> 4) & (_H1 - 1), ((last * 4051 + b[:n] * 6067) >> 4) & (_H2 - 1)
        k += slot_of[:, :n]
        slot = slots.take(k, mode="clip")
        c, run = slot >> 2, slot & 3
        agree = c[0] == c[1]
        q = ((run << 1) | agree) + record_of[:, :n]
        was = records.take(q, mode="clip")
        x = np.empty((2, 3, n), np.int32)
        x[:, 0] = _STRETCH.take(was, mode="clip")
        np.multiply(x[::-1, 0], agree, out=x[:, 1])
        x[:, 2] = evidence.take(c, mode="clip")
        y = wn * x
        m = _SQUASH.take(((y[:, 0] + y[:, 1] + y[:, 2]) >> 16) + 2048, mode="clip")
        use = c > 0
        f2 = m[1] * use[1]
        use[0] &= ~agree
        f1 = (((4096 - f2) * m[0]) >> 12) * use[0]
        np.greater(f1, 0, out=use[0])
        both = f2 + f1
        if ids is not None:
            now = ids[j, :n].astype(np.int32) + 1
            right = now == c
            hit2 = right[1] & use[1]
            hit1 = right[0] & use[0]
            hit1 &= ~hit2
            lit = np.flatnonzero(~(hit2 | hit1))
            new = now[lit] - 1
        else:
            target = coder.target(n)
            v = (target >> _BITS).astype(np.int32)
            hit2 = v < f2
            miss = v >= both
            hit1 = ~(hit2 | miss)
            now = np.where(hit2, c[1], c[0])
            lit = np.flatnonzero(miss)
        left, over = (4096 - both[lit]).astype(np.uint64), both[lit].astype(np.uint64) << _BITS
        if ids is None:
            new = model.find((target[lit] - over) // left)
            now[lit] = new + 1
            right = now == c
            out[j, :n] = now - 1
        cum, freq = (f2 * hit1).astype(np.uint64) << _BITS, (f2 * hit2 + f1 * hit1).astype(np.uint64) << _BITS
        cum[lit], freq[lit] = over + left * cum0.take(new), left * freq0.take(new)
        coder.take(n, cum, freq)
        # What held is learnt: weights, records, last followers.
        up = right * np.int32(4096)
        err = (up - m) * 6 * use
        x *= err[:, None]
        x += 0x2000
        x >>= 14
        wn += x
        if j % 16 == 15:
            np.clip(w, -150_000, 150_000, out=w)
        records[q] = was + ((up - right - was) >> 4)
        slots[k] = (now << 2) | (np.minimum(run + 1, 3) * right)
        b[:n], a[:n] = last, now - 1
    return out


def encode(ids: np.ndarray, lanes: int = LANES) -> tuple[bytes, list[tuple[int, int, bytes]]]:
    """The packed model, and (number of ids, CRC-32 of them, payload) of each block of ``BLOCK`` ids."""
    model = Model.of(ids)
    out: list[tuple[int, int, bytes]] = []
    for i in range(0, len(ids), lanes * BLOCK):
        part = ids[i : i + lanes * BLOCK]
        n = -(-len(part) // BLOCK)
        lengths = np.full(n, BLOCK)
        lengths[-1] = len(part) - (n - 1) * BLOCK
        grid = np.zeros((int(lengths.max()), n), model.kind)
        for k in range(0, n, _SOME):
            few = model.places(part[k * BLOCK : (k + _SOME) * BLOCK])
            full = len(few) // BLOCK
            grid[:, k : k + full] = few[: full * BLOCK].reshape(full, -1).T if full else 0
            if full * BLOCK < len(few):
                grid[: len(few) - full * BLOCK, k + full] = few[full * BLOCK :]
        writer = _Writer(n, int(lengths.max()))
        _run(lengths, grid, writer, model)
        crcs = [zlib.crc32(part[j * BLOCK : (j + 1) * BLOCK].astype("<u4").tobytes()) for j in range(n)]
        out += zip(lengths.tolist(), crcs, writer.done(), strict=True)
    return model.packed(), out


def decode(packed: bytes, blocks: list[tuple[int, int, bytes]], lanes: int = LANES) -> list[np.ndarray]:
    """The ids of each block as 32-bit integers; a block that fails its checksum raises."""
    model = Model.unpacked(packed)
    order = sorted(range(len(blocks)), key=lambda i: -blocks[i][0])
    out: list[np.ndarray] = [np.zeros(0, "<u4")] * len(blocks)
    for s in range(0, len(order), lanes):
        part = order[s : s + lanes]
        lengths = np.array([blocks[i][0] for i in part])
        places, own = _run(lengths, None, _Reader([blocks[i][2] for i in part]), model), model.ids.astype("<u4")
        for k in range(0, len(part), _SOME):
            got = own.take(places[:, k : k + _SOME].T)
            for row, i in enumerate(part[k : k + _SOME]):
                n, crc, _ = blocks[i]
                out[i] = got[row, :n]
                if zlib.crc32(out[i].tobytes()) != crc:
                    raise ValueError("a block fails its checksum")
    return out
