"""Hard negatives by segment summaries.

The components of a vector are cut into segments, and of each segment only mean and deviation are kept. For two
vectors a segment's part of the inner product is its length times the product of the means, plus or minus at
most the length times the product of the deviations. Summed up these bound the score from both sides. Pairs that the
bounds of long segments leave open go on to segments of half the length, and what the shortest leave open is
scored exactly, on integers.

Rows lie in blocks that fit a task; anchors are sent to every block and streamed past it. Blocks give their best rows,
which are merged by anchor. The first pass finds the positives, the second the negatives of their score windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketlake.llm.common import written

EVERY, POSITIVES, NEGATIVES = 100, 5, 10
#: Negatives score between these hundredths of their positive's score.
LOW, HIGH = 30, 90
SCALE = 256
#: Lengths of the segments, longest first.
SEGMENTS = (16, 8, 4, 2)
#: Rows of a block at most and, while there are idle cores, at least; components of a block.
BLOCK_ROWS, LEAST_ROWS, BLOCK_VALUES = 32_768, 2_048, 1 << 22
#: Anchors and rows of one matrix of bounds.
TILE = (64, 4_096)
#: Scaled components beyond this count as this; scores beyond 64 bits as the nearest long.
MOST = float(1 << 62)
_FOUND = "anchor bigint, anchor_id bigint, place int, vec_id bigint, score bigint"


def usable(v: Column) -> Column:
    """Not null, every component finite."""
    return F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def scaled(rows: np.ndarray) -> np.ndarray:
    """floor(256 x) of each component, whole numbers held as doubles."""
    return np.clip(np.floor(SCALE * rows.astype(np.float64)), -MOST, MOST)


def summaries(x: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Means and deviations of all segments, each times the root of the segment's length."""
    at = np.arange(0, x.shape[1], length)
    size = np.diff(np.append(at, x.shape[1]))
    mean = np.add.reduceat(x, at, axis=1) / size
    apart = x - np.repeat(mean, size, axis=1)
    return mean * np.sqrt(size), np.sqrt(np.add.reduceat(apart * apart, at, axis=1))


class Rows:
    """Vectors of one length with their summaries; ``x`` holds whole numbers."""

    def __init__(self, ids: np.ndarray, keys: np.ndarray, labels: np.ndarray, x: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.keys, self.labels, self.x = ids[order], keys[order], labels[order], np.ascontiguousarray(x[order])
        self.order = order
        self.levels = [summaries(self.x, s) for s in SEGMENTS if s < x.shape[1]]
        self.norm = np.sqrt((self.x * self.x).sum(axis=1))
        self.most = float(np.abs(self.x).max(initial=0))

    def part(self, s: slice) -> "Rows":
        p = object.__new__(Rows)
        p.ids, p.keys, p.labels, p.x, p.norm, p.most = self.ids[s], self.keys[s], self.labels[s], self.x[s], self.norm[s], self.most
        p.levels = [(m[s], d[s]) for m, d in self.levels]
        return p


def open_pairs(q: Rows, r: Rows, allowed: np.ndarray, low: np.ndarray, high: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(anchors, rows) of the allowed pairs that may score between ``low`` and ``high`` and, with ``k``, among the k best.

    ``low`` and ``high`` are given by anchor. With ``k`` the k-th largest lower bound of an anchor raises its ``low``.
    """
    live, low = allowed, low.copy()
    # Rounding is far below this share of the largest score there can be.
    slack = 1e-9 * q.norm[:, None] * r.norm[None, :]
    a = b = None
    for (qm, qd), (rm, rd) in zip(q.levels, r.levels, strict=True):
        if a is None:
            middle, spread = qm @ rm.T, qd @ rd.T + slack
            if k and live.shape[1] > k:
                least = np.where(live, middle - spread, -np.inf)
                low = np.maximum(low, np.partition(least, -k, axis=1)[:, -k])
            live = live & (middle + spread >= low[:, None]) & (middle - spread <= high[:, None])
            if 8 * np.count_nonzero(live) < live.size:
                a, b = np.nonzero(live)
        else:
            middle = np.einsum("ij,ij->i", qm[a], rm[b])
            spread = np.einsum("ij,ij->i", qd[a], rd[b]) + slack[a, b]
            stay = (middle + spread >= low[a]) & (middle - spread <= high[a])
            a, b = a[stay], b[stay]
    return np.nonzero(live) if a is None else (a, b)


def exact(q: Rows, r: Rows, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The pairs' integer inner products; doubles hold them while all sums stay below 2^53."""
    if q.most * r.most * max(1, q.x.shape[1]) < 2**53:
        return np.einsum("ij,ij->i", q.x[a], r.x[b]).astype(np.int64)
    whole = [sum(int(u) * int(v) for u, v in zip(x, y, strict=True)) for x, y in zip(q.x[a].tolist(), r.x[b].tolist(), strict=True)]
    return np.array([min(max(s, -(1 << 63)), (1 << 63) - 1) for s in whole], np.int64)


class Best:
    """The k best (score, id) of one list; ties to smaller ids."""

    def __init__(self, k: int):
        self.k, self.score, self.ids = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, score: np.ndarray, ids: np.ndarray) -> None:
        if len(self.score) == self.k:
            near = score >= self.score[-1]
            score, ids = score[near], ids[near]
        if not len(score):
            return
        score, ids = np.concatenate([self.score, score]), np.concatenate([self.ids, ids])
        order = np.lexsort((ids, ~score))[: self.k]  # ~score falls as the score rises, without overflow
        self.score, self.ids = score[order], ids[order]

    def least(self) -> float:
        return float(self.score[-1]) - abs(float(self.score[-1])) * 1e-15 if len(self.score) == self.k else -np.inf


def positives(q: Rows, block: Rows, k: int) -> list[list[Best]]:
    """For each anchor one list: its best rows of the same label, without itself."""
    best = [[Best(k)] for _ in range(len(q.ids))]
    for i in range(0, len(q.ids), TILE[0]):
        part = q.part(slice(i, i + TILE[0]))
        for j in range(0, len(block.ids), TILE[1]):
            r = block.part(slice(j, j + TILE[1]))
            allowed = (part.labels[:, None] == r.labels[None, :]) & (part.keys[:, None] != r.keys[None, :])
            low = np.array([x[0].least() for x in best[i : i + TILE[0]]])
            a, b = open_pairs(part, r, allowed, low, np.full(len(low), np.inf), k)
            _deal(part, r, a, b, lambda n, score, ids: best[i + n][0].add(score, ids))  # noqa: B023
    return best


def negatives(q: Rows, block: Rows, windows: list[list[tuple[int, int]]], k: int) -> list[list[Best]]:
    """For each anchor a list per window (least, most score): its best rows of another label within."""
    best = [[Best(k) for _ in w] for w in windows]

    def add(n: int, score: np.ndarray, ids: np.ndarray) -> None:
        for (least, most), found in zip(windows[n], best[n], strict=True):
            inside = (score >= least) & (score <= most)
            found.add(score[inside], ids[inside])

    for i in range(0, len(q.ids), TILE[0]):
        part = q.part(slice(i, i + TILE[0]))
        high = np.array([max((float(m) for _, m in w), default=-np.inf) for w in windows[i : i + TILE[0]]])
        for j in range(0, len(block.ids), TILE[1]):
            r = block.part(slice(j, j + TILE[1]))
            low = np.array([min((max(float(w[0]), f.least()) for w, f in zip(windows[n], best[n], strict=True)), default=np.inf) for n in range(i, i + len(high))])
            a, b = open_pairs(part, r, part.labels[:, None] != r.labels[None, :], low, high, 0)
            _deal(part, r, a, b, lambda n, score, ids: add(i + n, score, ids))  # noqa: B023
    return best


def _deal(q: Rows, r: Rows, a: np.ndarray, b: np.ndarray, give) -> None:
    """Exact scores of the pairs, given anchor by anchor."""
    score = exact(q, r, a, b)
    for n, at in zip(*np.unique(a, return_index=True), strict=True):
        end = np.searchsorted(a, n, side="right")
        give(int(n), score[at:end], r.ids[b[at:end]])


def window(positive: int) -> tuple[int, int]:
    """The least and the largest score of the positive's negatives."""
    return max(-(-LOW * positive // 100), -(1 << 63)), min(HIGH * positive // 100, (1 << 63) - 1)


def _read(b: pa.RecordBatch) -> Rows:
    flat = b.column("v").flatten().to_numpy(zero_copy_only=False)
    return Rows(b.column("vec_id").to_numpy(), b.column("_key").to_numpy(), b.column("label").to_numpy(), scaled(flat.reshape(b.num_rows, len(flat) // b.num_rows)))


def _searcher(k: int):
    """Over rows sorted by block, the block's own rows first: the lists of each anchor that follows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, block = None, [], None
        for whole in batches:
            at, kind = whole.column("_block").to_numpy(), whole.column("_kind").to_numpy()
            cuts = (np.nonzero((np.diff(at) != 0) | (np.diff(kind) != 0))[0] + 1).tolist()
            for s, e in zip([0, *cuts], [*cuts, whole.num_rows], strict=True):
                if e == s:
                    continue
                part = whole.slice(s, e - s)
                if at[s] != key:
                    key, held, block = at[s], [], None
                if kind[s] == 0:
                    held.append(part)
                    continue
                if held:
                    block, held = _read(pa.Table.from_batches(held).combine_chunks().to_batches()[0]), []
                if block is None:
                    continue
                q = _read(part)
                if "scores" in part.schema.names:
                    scores = part.column("scores").to_pylist()
                    found = negatives(q, block, [[window(s) for s in scores[n]] for n in q.order], k)
                else:
                    found = positives(q, block, k)
                rows = [(int(q.keys[n]), int(q.ids[n]), p, int(v), int(x)) for n, lists in enumerate(found) for p, f in enumerate(lists) for x, v in zip(f.score, f.ids, strict=True)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()), strict=True)], ["anchor", "anchor_id", "place", "vec_id", "score"])

    return run


def _search(rows: DataFrame, asks: DataFrame, tasks: int, k: int) -> DataFrame:
    """(anchor, anchor_id, place, vec_id, score, rank): the k best of each list over all blocks."""
    asks = asks.withColumn("_b", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))).withColumn("_block", F.xxhash64("d", "_b")).withColumn("_kind", F.lit(1))
    base = rows.withColumn("_block", F.xxhash64("d", F.pmod(F.xxhash64("_key"), F.col("blocks")))).withColumn("_kind", F.lit(0))
    names = ["_block", "_kind", "_key", "vec_id", "label", "v", *[c for c in asks.columns if c == "scores"]]
    both = base.select(*[c for c in names if c != "scores"]).unionByName(asks.select(*names), allowMissingColumns=True)
    found = both.repartition(tasks, "_block").sortWithinPartitions("_block", "_kind", "_key").mapInArrow(_searcher(k), _FOUND)
    place = F.row_number().over(Window.partitionBy("anchor", "place").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k)


def mine(vectors: DataFrame, every: int = EVERY, n_positives: int = POSITIVES, n_negatives: int = NEGATIVES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose vec_id ``every`` divides. Rows with a null id, a null label, a null vector, or a null or
    non-finite component take no part. Of rows equal in id, label and vector one counts; rows that share an id only
    stand side by side, as anchors too. Vectors meet those of their own length; empty ones score 0 with each
    other. The columns vec_id, label and embedding are read. The result is exact and whole.
    """
    spark = vectors.sparkSession
    own = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("embedding")))
    label = F.col("label").cast("bigint")
    rows = own.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"), F.col("embedding").alias("v")).distinct()
    rows = rows.withColumn("d", F.size("v")).withColumn("_key", F.xxhash64("vec_id", "label", "v"))
    # A row per length of vectors: the blocks they fill, so that a block fits a task and the cores have work.
    most = F.least(F.lit(BLOCK_ROWS), F.greatest(F.lit(64), F.floor(F.lit(BLOCK_VALUES) / F.greatest("d", F.lit(1)))))
    idle = F.least(F.lit(2 * spark.sparkContext.defaultParallelism).cast("bigint"), F.ceil(F.col("n") / LEAST_ROWS))
    shape = written(rows.groupBy("d").agg(F.count("*").alias("n")).withColumn("blocks", F.greatest(F.ceil(F.col("n") / most), idle)).select("d", "blocks"), "shapes")
    tasks = max(1, 4 * sum(r[0] for r in shape.select("blocks").collect()))
    rows = written(rows.join(shape, "d"), "vectors")
    anchors = rows.where(F.col("vec_id") % every == 0)
    near = written(_search(rows, anchors, tasks, n_positives), "positives")
    lists = near.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("rank", "score", "vec_id"))).alias("_l"))
    asks = anchors.join(lists.select(F.col("anchor").alias("_a"), F.expr("transform(_l, x -> x.score)").alias("scores")), F.expr("_key = _a"))
    found = _search(rows, asks, tasks, n_negatives)
    of = near.select(F.col("anchor").alias("_a"), (F.col("rank") - 1).alias("_p"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    full = found.join(of, F.expr("anchor = _a and place = _p"))
    return full.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


SQL = f"""
WITH r AS (
    SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        [floor({SCALE} * CAST(x AS DOUBLE)) for x in embedding] AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len([x for x in embedding if x IS NOT NULL AND isfinite(x)]) = len(embedding)
),
s AS (
    SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
    FROM r a JOIN r b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE a.vec_id % {EVERY} = 0
),
p AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES}
),
n AS (
    SELECT s.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY s.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
        vec_id AS negative_id, positive_score, score AS negative_score
    FROM s JOIN p ON s.anchor_id = p.anchor_id
    WHERE NOT same AND {LOW} * positive_score <= 100 * score AND 100 * score <= {HIGH} * positive_score
)
SELECT * FROM n WHERE rank <= {NEGATIVES}
"""
