"""SimHash near-duplicates by anchor-point covering.

Fingerprints of 64 bits are cut into three blocks; at most four differing bits leave at most one in some
block. The anchors of a block are the words of a covering code, a product of perfect Hamming codes, of
which each block word has exactly one nearest, its home. A fingerprint is filed at its home, and visits every
anchor within the covering radius plus one that is the home of a block word one bit away. So linked
fingerprints meet at an anchor, and only those filed there are compared with its visitors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlake.llm.common import shielded, written

SHINGLE, SEED, DISTANCE = 4, 42, 4
#: (first bit, lengths of the Hamming codes) of each block; 15 + 7, 7 + 7 + 7, 7 + 7 + 7 bits.
BLOCKS = ((0, (15, 7)), (22, (7, 7, 7)), (43, (7, 7, 7)))
#: Rows that one task compares at a time, and rows at an anchor above which it is dealt to several tasks.
CELL_ROWS, HOT_ROWS = 200_000, 40_000


def shingles(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """The XXH64 of all word shingles; texts of fewer words have one shingle, those without words none."""
    words = text.encode().lower().split() if text else []  # bytes: A-Z and ASCII white space only
    if not words:
        return np.zeros(0, np.uint64)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(line[a:b], seed) for a, b in zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist(), strict=True)), np.uint64, len(words) - k + 1)


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Majority bits of the shingles' hashes; a text without words gives zero."""
    return fingerprint_of(shingles(text, shingle, seed))


def fingerprint_of(h: np.ndarray) -> int:
    """Majority bits of hashes."""
    if not len(h):
        return 0
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), 1 << 16):
        ones += np.unpackbits(h[i : i + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, _th, fp): the fingerprint of every row as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.fromiter((fingerprint(t.as_py(), shingle) for t in b.column(2)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp.view(np.int64))], ["doc_id", "_th", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.xxhash64("text").alias("_th"), "text").mapInArrow(run, f"doc_id {kind}, _th bigint, fp bigint")


def _syndrome(word: np.ndarray, n: int) -> np.ndarray:
    """Zero for a code word, else the place (from 1) of the bit to flip to reach the only code word at distance one."""
    out = np.zeros(len(word), np.uint64)
    for i in range(n):
        out ^= ((word >> np.uint64(i)) & np.uint64(1)) * np.uint64(i + 1)
    return out


def _home(word: np.ndarray, lengths: tuple[int, ...]) -> np.ndarray:
    out, at = np.zeros(len(word), np.uint64), 0
    for n in lengths:
        part = (word >> np.uint64(at)) & np.uint64((1 << n) - 1)
        s = _syndrome(part, n)
        part ^= np.where(s > 0, np.uint64(1) << (np.maximum(s, 1) - np.uint64(1)), np.uint64(0))
        out |= part << np.uint64(at)
        at += n
    return out


def anchors(fp: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """(row numbers, anchors, filed) of unsigned fingerprints; a visit follows only where the anchor is not the home."""
    rows = np.arange(len(fp))
    for b, (first, lengths) in enumerate(BLOCKS):
        width = sum(lengths)
        word = (fp >> np.uint64(first)) & np.uint64((1 << width) - 1)
        tag = np.uint64(b << 32)
        home = _home(word, lengths)
        yield rows, home | tag, True
        away = np.stack([_home(word ^ np.uint64(1 << i), lengths) for i in range(width)])
        away.sort(axis=0)
        new = (away != home) & np.concatenate([np.ones((1, len(fp)), bool), away[1:] != away[:-1]])
        i, j = np.nonzero(new)
        yield j, away[i, j] | tag, False


def _file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        every = b.column(0).to_numpy().view(np.uint64)
        for i in range(0, len(every), 20_000):
            fp = every[i : i + 20_000]
            for rows, anchor, filed in anchors(fp):
                yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), pa.array(fp[rows].view(np.int64)), pa.array(np.full(len(rows), filed))], ["anchor", "fp", "filed"])


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """A star for each component of the links between 0..n-1: as many links as nodes at most."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while (label[label] != label).any():
            label = label[label]
        if (label == before).all():
            break
    moved = np.nonzero(label != np.arange(n))[0]
    return moved, label[moved]


def _links(filed: np.ndarray, met: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between filed and met fingerprints, thinned to a spanning forest as they are found."""
    nodes = np.unique(np.concatenate([filed, met]))
    x, y = np.searchsorted(nodes, filed), np.searchsorted(nodes, met)
    a, b = np.zeros(0, np.int64), np.zeros(0, np.int64)
    step = max(1, 2_000_000 // max(len(met), 1))
    for i in range(0, len(filed), step):
        r, c = np.nonzero(np.bitwise_count(filed[i : i + step, None] ^ met[None, :]) <= most)
        a, b = np.concatenate([a, x[i + r]]), np.concatenate([b, y[c]])
        if len(a) > 4 * len(nodes):
            a, b = _forest(a, b, len(nodes))
    if len(a) > len(nodes):
        a, b = _forest(a, b, len(nodes))
    apart = a != b
    return nodes[a[apart]], nodes[b[apart]]


def _compare(most: int):
    def run(t: pa.Table) -> pa.Table:
        anchor, fp, filed = t.column("anchor").to_numpy(), t.column("fp").to_numpy().view(np.uint64), t.column("filed").to_numpy()
        order = np.lexsort((~filed, anchor))
        anchor, fp, filed = anchor[order], fp[order], filed[order]
        edge = np.nonzero(np.concatenate([[True], anchor[1:] != anchor[:-1], [True]]))[0]
        n_filed = np.add.reduceat(filed.astype(np.int64), edge[:-1]) if len(anchor) else np.zeros(0, np.int64)
        out: list[tuple[np.ndarray, np.ndarray]] = []
        for s, e, k in zip(edge[:-1].tolist(), edge[1:].tolist(), n_filed.tolist(), strict=True):
            if k and e - s > 1:
                out.append(_links(fp[s : s + k], fp[s:e], most))
        a, b = (np.concatenate([np.zeros(0, np.uint64), *(o[i] for o in out)]) for i in (0, 1))
        return pa.table({"a": pa.array(a.view(np.int64)), "b": pa.array(b.view(np.int64))})

    return run


def links(distinct: DataFrame, most: int = DISTANCE) -> DataFrame:
    """(a, b), a < b: links that join the same fingerprints as all pairs at most four bits apart would."""
    assert most < 2 * len(BLOCKS), "a block must be left with one differing bit at most"
    filed = written(distinct.select("fp").mapInArrow(_file, "anchor bigint, fp bigint, filed boolean"), "anchors")
    hot = written(filed.groupBy("anchor").agg(F.count("*").alias("_n")).where(F.col("_n") > HOT_ROWS), "hot-anchors")
    rows = filed.withColumn("_cell", F.lit(0))
    if hot.count():
        # At a hot anchor the filed ones are dealt to cells, and every cell is visited by all, in parts.
        n = F.ceil(F.col("_n") / HOT_ROWS).cast("int")
        part = lambda salt: F.pmod(F.xxhash64("fp", F.lit(salt)), n).cast("int")
        h = filed.join(hot.withColumnRenamed("anchor", "_a"), F.expr("anchor = _a"))
        stay = h.where("filed").select("anchor", "fp", "filed", F.explode(F.transform(F.sequence(F.lit(0), n - 1), lambda j: part("home") * n + j)).alias("_cell"))
        come = h.select("anchor", "fp", F.lit(False).alias("filed"), F.explode(F.transform(F.sequence(F.lit(0), n - 1), lambda i: i * n + part("visit"))).alias("_cell"))
        rows = rows.join(hot.withColumnRenamed("anchor", "_a"), F.expr("anchor = _a"), "left_anti").unionByName(stay).unionByName(come)
    tasks = max(1, -(-filed.count() // CELL_ROWS))
    dealt = rows.withColumn("_task", F.pmod(F.xxhash64("anchor", "_cell"), F.lit(tasks)))
    dealt = dealt.withColumn("anchor", F.col("anchor").bitwiseOR(F.shiftleft(F.col("_cell").cast("bigint"), 36)))
    found = dealt.groupBy("_task").applyInArrow(_compare(most), "a bigint, b bigint")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def components(edges: DataFrame, jumps: int = 3) -> DataFrame:
    """(node, root) of every linked node: rounds of hooking to the least neighbour, jumping and contraction.

    Each round is written; nothing is gathered on the driver but the count of links left.
    """
    left = written(edges, "links")
    rounds: list[DataFrame] = []
    while left.count():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("_m")).select("node", F.least("node", "_m").alias("up")), "hooks")
        to = up.select(F.col("node").alias("_k"), F.col("up").alias("_v"))
        for _ in range(jumps):
            up = written(up.join(to, F.expr("up = _k"), "left").select("node", F.coalesce("_v", "up").alias("up")), "jumps")
            to = up.select(F.col("node").alias("_k"), F.col("up").alias("_v"))
        rounds.append(up)
        a, b = to, up.select(F.col("node").alias("_k2"), F.col("up").alias("_v2"))
        moved = left.join(a, F.expr("a = _k")).join(b, F.expr("b = _k2")).select(F.col("_v").alias("a"), F.col("_v2").alias("b"))
        tie = up.select(F.col("up").alias("x")).distinct().join(to, F.expr("x = _k")).select(F.col("x").alias("a"), F.col("_v").alias("b"))
        both = moved.unionByName(tie).where("a <> b")
        left = written(both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    if not rounds:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    out = rounds[-1]
    for up in rounds[-2::-1]:
        later = out.select(F.col("node").alias("_k"), F.col("up").alias("_v"))
        out = up.join(later, F.expr("up = _k"), "left").select("node", F.coalesce("_v", "up").alias("up"))
    return out.select("node", F.col("up").alias("root"))


def clusters(docs: DataFrame, most: int = DISTANCE) -> DataFrame:
    """One row per document row: doc_id, _th, fp, fingerprint, component_id.

    Null and empty texts have fingerprint zero and link like any other. A null id is never the
    component's id unless it holds no other. Only doc_id and text are read.
    """
    rows = written(fingerprints(docs), "fingerprints")
    distinct = written(rows.groupBy("fp").agg(F.min("doc_id").alias("_least")), "distinct")
    roots = components(links(distinct, most)).select(F.col("node").alias("_node"), "root")
    of = written(distinct.join(roots, F.expr("fp = _node"), "left").select("fp", "_least", F.coalesce("root", "fp").alias("_root")), "roots")
    least = of.groupBy(F.col("_root").alias("_r")).agg(F.min("_least").alias("component_id"))
    named = written(of.join(least, F.expr("_root = _r")).select(F.col("fp").alias("_fp"), F.col("_root").alias("root"), "component_id"), "components")
    return rows.join(named, F.expr("fp = _fp")).select("doc_id", "_th", "root", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, most: int = DISTANCE) -> DataFrame:
    """``docs`` with one document of each component, that of the least id; of repeated rows one stays."""
    return keep_first(docs, clusters(docs, most))


def keep_first(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """One of ``docs`` for each root of ``rows`` (doc_id, _th, root)."""
    first = rows.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_th")).alias("_s"), F.count("*").alias("_n"))
    first = written(first.select(F.col("_s.doc_id").alias("_id"), F.col("_s._th").alias("_t")), "kept")
    same = rows.groupBy("doc_id", "_th").agg(F.count("*").alias("_n")).where("_n > 1").select(F.col("doc_id").alias("_id"), F.col("_th").alias("_t"))
    same = written(same, "repeated")
    on = F.expr("doc_id <=> _id and xxhash64(text) = _t")
    own, named = shielded(docs, "doc_id", "text")
    kept = own.join(first, on, "left_semi")
    if not same.count():
        return named(kept)
    again = kept.join(same, on, "left_semi").withColumn("_t", F.xxhash64("text")).dropDuplicates(["doc_id", "_t"]).drop("_t")
    return named(kept.join(same, on, "left_anti").unionByName(again))
