"""Nearest neighbours by collision counting over query-aware hashes.

Vectors are dealt to blocks. A block keeps one sorted array for each of ``PROJECTIONS`` random projections.
A query's windows, centred on its own projections, widen step by step (virtual rehashing); a vector inside
the windows of ``COLLISIONS`` projections is verified by its distance. A block's search ends when its k-th
distance is no more than the windows' half width: a vector that near is in a window with probability 0.68, one of
1.4 times that distance with 0.52. The share of collisions asked for, 0.65, lies between the two.
Queries visit every block, streamed past it, and the blocks' answers are merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketlake.llm.common import written

PROJECTIONS, COLLISIONS = 128, 83
#: Half width of the first windows, in deviations of the projections, and what each step multiplies it by.
START, GROWTH = 0.5, 1.1
BLOCK_ROWS, BLOCK_VALUES = 4096, 1 << 20
SEED = 20_11


def usable(v: Column) -> Column:
    """Not null, not empty, every component finite, not all zero."""
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0), F.lit(False))


class BlockIndex:
    """Sorted projections of one block of vectors of equal length; equal vectors are kept once with all their ids."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, projections: int, collisions: int, seed: int):
        order = np.argsort(ids, kind="stable")
        ids, vectors = ids[order], np.ascontiguousarray(vectors[order])
        raw = (vectors + vectors.dtype.type(0)).view(np.dtype((np.void, vectors.dtype.itemsize * vectors.shape[1]))).ravel()
        _, first, of = np.unique(raw, return_index=True, return_inverse=True)
        self.x = vectors[first].astype(np.float64)
        by = np.argsort(of, kind="stable")
        self.ids, self.at = ids[by], np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(first)))])
        self.collisions = collisions
        self.axes = np.random.default_rng(seed).standard_normal((vectors.shape[1], projections))
        p = self.x @ self.axes
        order = np.argsort(p, axis=0, kind="stable").T
        # The arrays of all projections in one, each moved beyond the end of the one before: one search finds all borders.
        self.least, self.most = (float(p.min()), float(p.max())) if len(p) else (0.0, 0.0)
        self.shift = np.arange(projections) * (self.most - self.least + 4.0)
        self.sorted = (np.take_along_axis(p.T, order, axis=1) + self.shift[:, None]).ravel()
        self.order = np.ascontiguousarray(order).ravel()
        spread = float(p.std()) if len(p) > 1 else 0.0
        self.start = max(spread * START, 1e-12)
        self.verified = 0

    def _border(self, at: np.ndarray, side: str) -> np.ndarray:
        return np.searchsorted(self.sorted, np.clip(at, self.least - 1.0, self.most + 1.0) + self.shift, side)

    def search(self, query: np.ndarray, own: int, k: int) -> list[tuple[int, float]]:
        """The k nearest ids and distances, nearest first, ties to smaller ids, without id ``own``."""
        n = len(self.x)
        centre = query @ self.axes
        lo = hi = self._border(centre, "left")
        count, done = np.zeros(n, np.int32), np.zeros(n, bool)
        best: list[tuple[float, int]] = []
        half = self.start
        while True:
            lo2, hi2 = np.minimum(self._border(centre - half, "left"), lo), np.maximum(self._border(centre + half, "right"), hi)
            first, size = np.concatenate([lo2, hi]), np.concatenate([lo - lo2, hi2 - hi])
            new = self.order[np.repeat(first - np.cumsum(size) + size, size) + np.arange(size.sum())]
            count += np.bincount(new, minlength=n).astype(np.int32)
            lo, hi = lo2, hi2
            found = np.nonzero((count >= self.collisions) & ~done)[0]
            if len(found):
                done[found] = True
                self.verified += len(found)
                d = np.sqrt(((self.x[found] - query) ** 2).sum(axis=1))
                if len(best) >= k:
                    near = d <= best[-1][0]
                    found, d = found[near], d[near]
                elif len(found) > 4 * (k + 1):  # ties at the border all stay
                    near = d <= np.partition(d, k)[k]
                    found, d = found[near], d[near]
                for i, x in zip(found.tolist(), d.tolist(), strict=True):
                    # Of equal vectors only the first k + 1 ids can be among the k nearest.
                    best += [(x, v) for v in self.ids[self.at[i] : min(self.at[i + 1], self.at[i] + k + 1)].tolist() if v != own]
                best = sorted(best)[:k]
            if done.all() or (len(best) == k and best[-1][0] <= half):
                return [(v, x) for x, v in best]
            half *= GROWTH


def _searcher(k: int, projections: int, collisions: int, seed: int):
    def vectors(b: pa.RecordBatch) -> np.ndarray:
        v = b.column(3)
        flat = v.flatten().to_numpy(zero_copy_only=False)
        return flat.reshape(b.num_rows, -1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, index = None, [], None
        for b in batches:
            block, kind = b.column(0).to_numpy(), b.column(1).to_numpy()
            cuts = np.nonzero(np.diff(block) | np.diff(kind))[0] + 1
            for s, e in zip([0, *cuts.tolist()], [*cuts.tolist(), b.num_rows], strict=True):
                if e == s:
                    continue
                part = b.slice(s, e - s)
                if block[s] != key:
                    key, held, index = block[s], [], None
                if kind[s] == 0:
                    held.append((part.column(2).to_numpy(), vectors(part)))
                    continue
                if held:
                    index = BlockIndex(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]), projections, collisions, seed)
                    held = []
                if index is None:
                    continue
                q, v, x = [], [], []
                for own, vec in zip(part.column(2).to_pylist(), vectors(part).astype(np.float64), strict=True):
                    for i, d in index.search(vec, own, k):
                        q.append(own)
                        v.append(i)
                        x.append(d)
                yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(v, pa.int64()), pa.array(x, pa.float64())], ["query_id", "vec_id", "score"])

    return run


def nearest(vectors: DataFrame, every: int = 100, k: int = 10, projections: int = PROJECTIONS, collisions: int = COLLISIONS, seed: int = SEED) -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose vec_id is divisible by ``every`` its k nearest others.

    Rows with a null id or an unusable vector take no part, nor do vectors of another length than the
    query's; a row repeated as a whole counts once. Columns vec_id and embedding are read.
    """
    rows = vectors.where(F.col("vec_id").isNotNull() & usable(F.col("embedding"))).select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").alias("v"))
    shape = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n"))
    # A row per length of vectors: how many blocks they fill.
    shape = written(shape.withColumn("blocks", F.ceil(F.col("n") / F.least(F.lit(BLOCK_ROWS), F.greatest(F.lit(64), F.floor(F.lit(BLOCK_VALUES) / F.col("d")))))), "shapes")
    rows = rows.join(shape.select("d", "blocks"), F.size("v") == F.col("d"))
    own = F.xxhash64("d", F.pmod(F.xxhash64("vec_id"), F.col("blocks")))
    base = rows.select(own.alias("_block"), F.lit(0).alias("_kind"), "vec_id", "v").distinct()
    ask = rows.where(F.col("vec_id") % every == 0).select(F.explode(F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1), lambda b: F.xxhash64("d", b))).alias("_block"), F.lit(1).alias("_kind"), "vec_id", "v").distinct()
    total = sum(r[0] for r in shape.select("blocks").collect())
    dealt = base.unionByName(ask).repartition(max(1, total), "_block").sortWithinPartitions("_block", "_kind", "vec_id")
    found = dealt.mapInArrow(_searcher(k, projections, collisions, seed), "query_id bigint, vec_id bigint, score double")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
