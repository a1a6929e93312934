"""Compact binary columns: arrays and texts that tasks hand to each other by the batch."""

from __future__ import annotations

import numpy as np
import zstandard


def compress(data: bytes, level: int = 3) -> bytes:
    return zstandard.compress(data, level)


def expand(data: bytes) -> bytes:
    return zstandard.decompress(data)


def pack(a: np.ndarray, level: int = 3) -> bytes:
    """Unsigned integers byte plane by byte plane, leading zero planes left out, compressed."""
    a = np.ascontiguousarray(a, "<u8").view(np.uint8).reshape(-1, 8)
    planes = max((k + 1 for k in range(8) if a[:, k].any()), default=0)
    return bytes([planes]) + len(a).to_bytes(7, "little") + compress(a[:, :planes].T.tobytes(), level)


def unpack(b: bytes) -> np.ndarray:
    n, planes = int.from_bytes(b[1:8], "little"), b[0]
    a = np.zeros((n, 8), np.uint8)
    a[:, :planes] = np.frombuffer(expand(b[8:]), np.uint8).reshape(planes, n).T
    return a.view("<u8").ravel()


def deal(shard: np.ndarray, shards: int) -> list[tuple[int, np.ndarray]]:
    """(shard, places) of the shards that occur, places ascending."""
    order = np.argsort(shard, kind="stable")
    at = np.searchsorted(shard[order], np.arange(shards + 1))
    return [(j, order[at[j] : at[j + 1]]) for j in range(shards) if at[j] < at[j + 1]]
