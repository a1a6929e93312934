"""Suffix sorting by induction through disk-backed bucket queues.

Suffixes leave the queues in order of their first symbol. What leaves induces the suffix one symbol to its left,
which joins the end of its symbol's queue; the queues together are a priority queue whose keys only rise. A whole
queue moves at a time, in rounds over equal symbols. Queues above a budget go to a temporary file. The sorted left-most
smaller suffixes, from which all else follows, come from the same induction, names and a sort of names.
"""

from __future__ import annotations

import tempfile

import numpy as np

#: Bytes that the queues of one sort hold in memory; more goes to disk.
QUEUE_BYTES = 64 << 20


class Queues:
    """First-in-first-out queues of positions, one for each symbol."""

    def __init__(self, symbols: int, budget: int):
        self.parts: list[list] = [[] for _ in range(symbols)]
        self.budget, self.held, self.file = budget, 0, None

    def push(self, symbol: int, positions: np.ndarray) -> None:
        if self.held + positions.nbytes <= self.budget:
            self.held += positions.nbytes
            self.parts[symbol].append(positions)
            return
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        at = self.file.seek(0, 2)
        self.file.write(positions.tobytes())
        self.parts[symbol].append((at, len(positions), positions.dtype))

    def deal(self, symbols: np.ndarray, positions: np.ndarray) -> None:
        """Pushes positions to their symbols' queues in the given order."""
        order = np.argsort(symbols, kind="stable")
        symbols, positions = symbols[order], positions[order]
        cut = np.nonzero(np.diff(symbols))[0] + 1
        for p, s in zip(np.split(positions, cut), symbols[np.concatenate([[0], cut])].tolist() if len(symbols) else [], strict=len(symbols) > 0):
            self.push(s, p)

    def pop(self, symbol: int) -> np.ndarray:
        """All that waits for a symbol; the queue is empty then."""
        out = []
        for p in self.parts[symbol]:
            if isinstance(p, tuple):
                self.file.seek(p[0])
                out.append(np.frombuffer(self.file.read(p[1] * p[2].itemsize), p[2]))
            else:
                self.held -= p.nbytes
                out.append(p)
        self.parts[symbol] = []
        return np.concatenate(out) if out else np.zeros(0, np.int32)

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


def _induce(text: np.ndarray, seeds: np.ndarray, symbols: int, budget: int) -> np.ndarray:
    """All suffixes in the order that the given order of the left-most smaller ones (``seeds``) induces."""
    n = len(text)
    seeds = seeds[seeds < n - 1]
    by = np.argsort(text[seeds], kind="stable")
    seeds, at = seeds[by], np.searchsorted(text[seeds][by], np.arange(symbols + 1))
    larger, kept = Queues(symbols, budget), Queues(symbols, budget)
    # The last suffix is the least of all, so what it induces comes first.
    larger.push(int(text[n - 2]), np.array([n - 2], np.int32))
    for c in range(symbols):
        while len(now := larger.pop(c)):
            kept.push(c, now)
            left = now[now > 0] - 1
            t = text[left]
            larger.deal(t[t >= c], left[t >= c])
        left = seeds[at[c] : at[c + 1]]
        left = left[left > 0] - 1
        larger.deal(text[left], left)
    larger.close()
    smaller = Queues(symbols, budget)
    out: list[np.ndarray] = []
    for c in range(symbols - 1, -1, -1):
        down, mine = kept.pop(c), []
        while len(now := smaller.pop(c)):
            mine.append(now)
            left = now[now > 0] - 1
            t = text[left]
            smaller.deal(t[t <= c], left[t <= c])
        left = down[::-1]
        left = left[left > 0] - 1
        t = text[left]
        smaller.deal(t[t < c], left[t < c])
        out += [*mine, down[::-1]]
    kept.close()
    smaller.close()
    return np.concatenate([*out, np.array([n - 1], np.int32)])[::-1]


def _names(text: np.ndarray, lms: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Ranks of the pieces between left-most smaller positions, in text order; ``order`` sorts them."""
    ends = np.append(lms[1:], len(text) - 1)
    where = np.searchsorted(lms, order)
    length = (ends - lms)[where] + 1
    a, b = order[:-1], order[1:]
    same = length[:-1] == length[1:]
    live, k = np.nonzero(same)[0], 0
    while len(live):
        live = live[length[live] > k]
        differ = text[a[live] + k] != text[b[live] + k]
        same[live[differ]] = False
        live, k = live[~differ], k + 1
    rank = np.zeros(len(lms), np.int64)
    rank[where] = np.concatenate([[0], np.cumsum(~same)])
    return rank


def suffix_order(text: np.ndarray, depth: int, budget: int = QUEUE_BYTES) -> np.ndarray:
    """Positions of ``text`` by their suffixes, exact to ``depth`` symbols. ``text`` ends in 0, its least symbol."""
    n = len(text)
    if n < 3:
        return np.arange(n, dtype=np.int32)[::-1].copy()
    symbols = int(text.max()) + 1
    change = np.nonzero(text[1:] != text[:-1])[0]  # a run has the type that its first change of symbol gives
    nxt = np.searchsorted(change, np.arange(n - 1))
    smaller = np.ones(n, bool)
    ok = nxt < len(change)
    at = change[np.minimum(nxt, max(len(change) - 1, 0))] if len(change) else np.zeros(n - 1, np.int64)
    smaller[:-1] = ok & (text[at] < text[np.minimum(at + 1, n - 1)])
    smaller[-1] = True
    lms = (np.nonzero(smaller[1:] & ~smaller[:-1])[0] + 1).astype(np.int32)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    first = _induce(text, lms, symbols, budget)
    rank = _names(text, lms, first[is_lms[first]])
    step = 1
    while rank.max() + 1 < len(rank) and step < depth:
        ahead = np.zeros(len(rank), np.int64)
        ahead[:-step] = rank[step:] + 1
        _, rank = np.unique(rank * (len(rank) + 1) + ahead, return_inverse=True)
        step *= 2
    return _induce(text, lms[np.argsort(rank, kind="stable")], symbols, budget)


def repeated(pieces: list[bytes], width: int, budget: int = QUEUE_BYTES) -> list[np.ndarray]:
    """For each piece, whether the ``width`` bytes from each of its positions stand anywhere else in the pieces."""
    lens = np.array([len(p) for p in pieces])
    text = np.zeros(int(lens.sum()) + len(pieces), np.int32)
    starts = np.concatenate([[0], np.cumsum(lens + 1)[:-1]])
    raw = np.frombuffer(b"".join(p + b"\0" for p in pieces), np.uint8)
    text[:] = raw
    text += 1
    text[starts + lens] = 0
    order = suffix_order(text, width, budget)
    room = np.zeros(len(text), bool)
    for s, n in zip(starts.tolist(), lens.tolist(), strict=True):
        room[s : s + max(0, n - width + 1)] = True
    order = order[room[order]]
    same = np.ones(max(len(order) - 1, 0), bool)
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    words = np.ndarray((len(padded) - 7,), "<u8", buffer=padded, strides=(1,))
    live = np.arange(len(same))
    for k in [*range(0, width - 7, 8), *([width - 8] if width % 8 and width > 8 else [])] if width >= 8 else []:
        differ = words[order[live] + k] != words[order[live + 1] + k]
        same[live[differ]] = False
        live = live[~differ]
    if width < 8:
        for k in range(width):
            same &= raw[order[:-1] + k] == raw[order[1:] + k]
    hit = np.zeros(len(text), bool)
    hit[order[:-1][same]] = True
    hit[order[1:][same]] = True
    return [hit[s : s + max(0, n - width + 1)] for s, n in zip(starts.tolist(), lens.tolist(), strict=True)]
