"""Near copies by SimHash, completed to all pairs at a Jaccard similarity of 0.8 or more of five-word shingles.

Candidates come from two sides. Fingerprints of the shingles that meet at an anchor (:mod:`simhash`) give the close
ones. Prefix filtering gives the rest: the shingles of a text are put in one order for all texts, rare ones first, and
texts at similarity 0.8 or more share one of the first ``n - ceil(0.8 n) + 1``. Every candidate is verified on
whole sets. Links that cannot change a component are not looked for: texts at a shingle are first compared with one of
them, then each with one of another component, and last all across components.

Sets differ by at least as many shingles as the parities of their shingles' bits do, which settles most pairs
without their sets; a set travels only for the others. Rarity is the class of a count in a sketch of fixed size: any fixed
order gives the same pairs, a good one gives fewer candidates. Shingles that the sketch shows to be hot are dealt to
cells by a salt, so that no task holds all their texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlake.llm.common import discard, written
from basketlake.llm.packing import compress, deal, expand, pack, unpack
from basketlake.llm.simhash import components, fingerprint_of, keep_first, shingles
from basketlake.llm.simhash import links as fingerprint_links

SHINGLE = 5
#: Bits of a stored shingle; two texts of a thousand shingles have an equal pair of unequal ones once in half a million.
HASH_BITS = 40
#: Counters of the sketch as a power of two, and its blocks.
SKETCH_BITS, BLOCKS = 20, 16
PARITIES = 512
#: Prefix rows that one task takes, rows of a shingle above which it is dealt to cells, and a quarter of the pairs held before they are made distinct.
TASK_ROWS, HOT_ROWS, CELLS = 500_000, 20_000, 2_000_000
#: Sets asked for are found by a broadcast up to this many ids of eight bytes, by a shuffle beyond.
BROADCAST_IDS = 1_000_000
_MEET = "task int, shingle bigint, salts int, node bigint, n int, pos int"
_OPEN_TYPES = [("task", pa.int32()), ("shingle", pa.int64()), ("salts", pa.int32()), ("node", pa.int64()), ("n", pa.int32()), ("pos", pa.int32()), ("other", pa.int64())]


def _buckets(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(HASH_BITS - SKETCH_BITS)).astype(np.int64)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per row the fingerprint, number, parities and sorted hashes of its shingles, and a hash of the whole set."""
    for b in batches:
        node, fp, n, parity, raw = [], [], [], [], []
        for t in b.column(2):
            h = shingles(t.as_py(), SHINGLE)
            fp.append(fingerprint_of(h))
            s = np.unique(h)
            node.append(xxhash.xxh64_intdigest(s.astype("<u8").tobytes()))
            s = np.unique(s >> np.uint64(64 - HASH_BITS))
            n.append(len(s))
            parity.append(np.packbits(np.bincount((s % np.uint64(PARITIES)).astype(np.int64), minlength=PARITIES) & 1).tobytes())
            raw.append(pack(np.diff(s, prepend=np.uint64(0)), 1))
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array(np.array(node, np.uint64).view(np.int64)), pa.array(np.array(fp, np.uint64).view(np.int64)), pa.array(n, pa.int32()), pa.array(parity, pa.binary()), pa.array(raw, pa.binary())],
            ["doc_id", "_th", "node", "fp", "n", "parity", "shingles"],
        )


def _hashes(raw: bytes) -> np.ndarray:
    return np.cumsum(unpack(raw), dtype=np.uint64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(1 << SKETCH_BITS, np.int64)
    for b in batches:
        for s in b.column(0).to_pylist():
            np.add.at(total, _buckets(_hashes(s)), 1)
    parts = np.split(total, BLOCKS)
    yield pa.RecordBatch.from_arrays([pa.array(range(BLOCKS), pa.int32()), pa.array([compress(p.tobytes()) for p in parts], pa.binary())], ["block", "counts"])


def _classes(t: pa.Table) -> pa.Table:
    """A byte per counter: the class of its count. The sum of all counters is in another column, for their mean."""
    total = sum(np.frombuffer(expand(x), np.int64) for x in t.column("counts").to_pylist())
    return pa.table({"block": t.column("block")[:1], "classes": pa.array([np.ceil(np.log2(total + 1)).astype(np.uint8).tobytes()], pa.binary()), "total": pa.array([int(total.sum())], pa.int64())})


def _salts(classes: np.ndarray, total: int) -> np.ndarray:
    """By class: so many cells a side for a shingle of that class, a power of two. What an average counter holds does not count."""
    mean = total >> SKETCH_BITS
    return np.array([1 << max(0, int(np.ceil(np.log2(max(1, ((1 << c) - 2 * mean) / HOT_ROWS))))) for c in range(int(classes.max(initial=0)) + 1)], np.int64)


def _prefixes(classes: bytes, salts: np.ndarray, tasks: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = np.frombuffer(classes, np.uint8)
        for b in batches:
            out, node = [], b.column(0).to_numpy().view(np.uint64)
            for s in b.column(1).to_pylist():
                h = _hashes(s)
                out.append(h[np.argsort(rank[_buckets(h)], kind="stable")[: len(h) - -(-4 * len(h) // 5) + 1]])
            size = np.array([len(x) for x in out], np.int64)
            h = np.concatenate([np.zeros(0, np.uint64), *out])
            of = np.repeat(np.arange(len(size)), size)
            pos = np.arange(len(h)) - np.repeat(np.cumsum(size) - size, size)
            n, k = b.column(2).to_numpy()[of], salts[rank[_buckets(h)]]
            salt = ((node[of] % np.uint64(1 << 30)).astype(np.int64) % k).astype(np.int64)
            task = ((h * np.uint64(0x9E3779B97F4A7C15) + salt.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(20)) % np.uint64(tasks)
            keys, rows = [], []
            for t, at in deal(task.astype(np.int64), tasks):
                at = at[np.argsort(h[at], kind="stable")]
                keys.append(t)
                rows.append([pack(np.diff(h[at], prepend=np.uint64(0)), 1), node[of[at]].tobytes(), pack(n[at], 1), pack(pos[at], 1), pack(k[at], 1)])
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), *(pa.array([r[c] for r in rows], pa.binary()) for c in range(5))], ["task", "h", "node", "n", "pos", "salts"])

    return run


def _shared(t: pa.Table) -> pa.Table:
    """The rows of shingles at which different sets meet here, each once, and all of shingles that are dealt to cells."""
    get = lambda c: np.concatenate([np.zeros(0, np.uint64), *(unpack(x) for x in t.column(c).to_pylist())])
    shingle = np.concatenate([np.zeros(0, np.uint64), *(_hashes(x) for x in t.column("h").to_pylist())])
    node = np.frombuffer(b"".join(t.column("node").to_pylist()), np.uint64)
    order = np.lexsort((node, shingle))
    s, d = shingle[order], node[order]
    once = np.ones(len(s), bool)
    once[1:] = (s[1:] != s[:-1]) | (d[1:] != d[:-1])
    order, s = order[once], s[once]
    same = s[1:] == s[:-1]
    salts = get("salts")[order].astype(np.int32)
    keep = (np.append(False, same) | np.append(same, False))[: len(s)] | (salts > 1)
    order = order[keep]
    task = pa.array(np.full(len(order), t.column("task")[0].as_py() if t.num_rows else 0, np.int32))
    return pa.table({"task": task, "shingle": shingle[order].view(np.int64), "salts": salts[keep], "node": node[order].view(np.int64), "n": get("n")[order].astype(np.int32), "pos": get("pos")[order].astype(np.int32)})


def _may(n: np.ndarray, pos: np.ndarray, n2: np.ndarray, pos2: np.ndarray) -> np.ndarray:
    """Whether sets that first meet at these places may share four ninths of their sizes' sum, which is a similarity of 0.8."""
    return 9 * np.minimum(n - pos, n2 - pos2) >= 4 * (n + n2)


def _grouped(t: pa.Table, columns: list[str]) -> tuple[list[np.ndarray], list[tuple[int, int]]]:
    shingle, node, n = (t.column(c).to_numpy().astype(np.int64) for c in ("shingle", "node", "n"))
    order = np.lexsort((node, n, shingle))
    edge = np.nonzero(np.concatenate([[True], shingle[order][1:] != shingle[order][:-1], [True]]))[0].tolist() if len(order) else [0]
    return [t.column(c).to_numpy().astype(np.int64)[order] for c in columns], list(zip(edge[:-1], edge[1:], strict=True))


def _pair_table(a: list[np.ndarray], b: list[np.ndarray]) -> pa.Table:
    x, y = np.concatenate([np.zeros(0, np.int64), *a]), np.concatenate([np.zeros(0, np.int64), *b])
    pair = np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)]), axis=1)
    return pa.table({"a": pa.array(pair[0]), "b": pa.array(pair[1])})


def _pivots(t: pa.Table) -> pa.Table:
    """Pairs of a pivot and what it may be like, at each shingle. Sizes rise: whoever is too large for the last pivot is the next one."""
    (node, n, pos), groups = _grouped(t, ["node", "n", "pos"])
    a, b = [], []
    for s, e in groups:
        p = s
        while p < e:
            end = s + int(np.searchsorted(n[s:e], 5 * n[p] // 4, side="right"))
            i = np.arange(p + 1, end)
            i = i[_may(n[p], pos[p], n[i], pos[i])]
            a.append(np.full(len(i), node[p]))
            b.append(node[i])
            p = max(end, p + 1)
    return _pair_table(a, b)


def _open(t: pa.Table) -> pa.Table:
    """The rows that another component's row of fitting size meets at their shingle, and for each such a row, drawn by hash, if it may be like it.

    All rows of shingles that are dealt to cells stay, as the others of their shingle are not all here.
    """
    (task, shingle, salts, node, n, pos, root), _ = _grouped(t, ["task", "shingle", "salts", "node", "n", "pos", "root"])
    order = np.lexsort((node, root, n, shingle))
    shingle, salts, node, n, pos, root = (x[order] for x in (shingle, salts, node, n, pos, root))
    at = np.arange(len(n))
    if not len(n):
        return pa.table({c: pa.array([], k) for c, k in _OPEN_TYPES})
    first = np.append(True, shingle[1:] != shingle[:-1])
    # Where the rows of fitting size begin and end, and those of the own component around each row.
    key = ((np.cumsum(first) - 1) << 32) + n
    low, high = np.searchsorted(key, key - n + -(-4 * n // 5)), np.searchsorted(key, key - n + 5 * n // 4, side="right")
    run = np.flatnonzero(first | np.append(True, root[1:] != root[:-1]))
    of = np.searchsorted(run, at, side="right") - 1
    before, after = np.maximum(run[of] - low, 0), np.maximum(high - np.append(run[1:], len(n))[of], 0)
    keep = np.flatnonzero((before + after > 0) | (salts > 1))
    drawn = (node.view(np.uint64) ^ shingle.view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)
    drawn = (drawn % np.maximum(before + after, 1).astype(np.uint64)).astype(np.int64)
    other = np.minimum(np.where(drawn < before, low + drawn, high - 1 - (drawn - before)), len(n) - 1)
    tried = (before + after > 0) & (root != root[other]) & _may(n, pos, n[other], pos[other])
    columns = [task[:1].repeat(len(keep)), shingle[keep], salts[keep], node[keep], n[keep], pos[keep]]
    return pa.table([*(pa.array(x, k) for x, (_, k) in zip(columns, _OPEN_TYPES, strict=False)), pa.array(node[other[keep]], pa.int64(), mask=~tried[keep])], names=[c for c, _ in _OPEN_TYPES])


def _across(t: pa.Table) -> pa.Table:
    """Pairs of different components at each shingle that parities leave; in a cell of two salts only those of one and the other.

    All shingles at once: each row meets the row that stands d places after it, for d = 1, 2, ..., as long as that is
    of its shingle and at most a quarter larger. Sizes rise, so a row that is done stays so.
    """
    t = t.append_column("row", pa.array(np.arange(t.num_rows)))
    (shingle, node, n, pos, root, salt, low, high, row), groups = _grouped(t, ["shingle", "node", "n", "pos", "root", "salt", "low", "high", "row"])
    start = np.array([s for s, _ in groups], np.int64)
    if not len(start):
        return _pair_table([], [])
    parity = np.frombuffer(b"".join(t.column("parity").to_pylist()), np.uint64).reshape(-1, PARITIES // 64)
    mixed = np.minimum.reduceat(root, start) != np.maximum.reduceat(root, start)
    at = np.nonzero(np.repeat(mixed, np.diff(np.append(start, len(root)))))[0]
    a, b, held, d = [], [], 0, 0
    while len(at):
        d += 1
        at = at[at + d < len(n)]
        other = at + d
        on = (shingle[other] == shingle[at]) & (4 * n[other] <= 5 * n[at])
        at, other = at[on], other[on]
        met = (root[at] != root[other]) & _may(n[at], pos[at], n[other], pos[other]) & ((low[at] == high[at]) | (salt[at] != salt[other]))
        x, y = at[met], other[met]
        met = _parity_may(parity[row[x]], parity[row[y]], n[x] + n[y])
        a.append(node[x[met]])
        b.append(node[y[met]])
        held += len(a[-1])
        if held > 4 * CELLS:  # the same pairs meet at many shingles
            done = _pair_table(a, b)
            a, b, held = [done.column("a").to_numpy()], [done.column("b").to_numpy()], 0
    return _pair_table(a, b)


def _parity_may(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Whether sets of these parities and sum of sizes may be at similarity 0.8: they differ by a ninth of the sum at most."""
    return 9 * np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64) <= n


def _near_parity(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint64).reshape(-1, PARITIES // 64) for c in ("pa", "pb"))
        n = b.column("na").to_numpy().astype(np.int64) + b.column("nb").to_numpy()
        yield b.select(["a", "b"]).filter(pa.array(_parity_may(x, y, n)))


def _alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        keep = []
        for x, y in zip(b.column("sa").to_pylist(), b.column("sb").to_pylist(), strict=True):
            x, y = _hashes(x), _hashes(y)
            keep.append(9 * len(np.intersect1d(x, y, assume_unique=True)) >= 4 * (len(x) + len(y)))
        yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _verified(pairs: DataFrame, rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs of sets at similarity 0.8 or more."""
    of = lambda c: nodes.select(F.col("node").alias(f"_{c}"), F.col("n").alias(f"n{c}"), F.col("parity").alias(f"p{c}"))
    both = pairs.distinct().join(of("a"), F.expr("a = _a")).join(of("b"), F.expr("b = _b")).select("a", "b", "na", "nb", "pa", "pb")
    left = written(both.mapInArrow(_near_parity, "a bigint, b bigint"), "near-pairs")
    asked = written(left.select(F.col("a").alias("_k")).unionByName(left.select(F.col("b").alias("_k"))).distinct(), "near-asked")
    ids = F.broadcast(asked) if asked.count() <= BROADCAST_IDS else asked
    sets = written(rows.select("node", "shingles").join(ids, F.expr("node = _k"), "left_semi").dropDuplicates(["node"]), "near-sets")
    x, y = (sets.select(F.col("node").alias(f"_{c}"), F.col("shingles").alias(f"s{c}")) for c in "ab")
    both = left.join(x, F.expr("a = _a")).join(y, F.expr("b = _b")).select("a", "b", "sa", "sb")
    links = written(both.mapInArrow(_alike, "a bigint, b bigint"), "near-links")
    discard(left, asked, sets)
    return links


def clusters(docs: DataFrame) -> DataFrame:
    """(doc_id, _th, root) of every row: equal roots where a chain of similarities of 0.8 or more links the texts.

    Texts of fewer than five words have one shingle, those without words none; these are all one group.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.xxhash64("text").alias("_th"), "text").mapInArrow(_sets, f"doc_id {kind}, _th bigint, node bigint, fp bigint, n int, parity binary, shingles binary")
    rows = written(rows, "near-rows")
    nodes = written(rows.where("n > 0").groupBy("node").agg(F.first("fp").alias("fp"), F.first("n").alias("n"), F.first("parity").alias("parity")), "near-nodes")

    # Fingerprints that meet at an anchor, and sets of one fingerprint.
    least = nodes.groupBy("fp").agg(F.min("node").alias("_least"))
    near = fingerprint_links(least)
    one, other = (least.select(F.col("fp").alias(f"_f{c}"), F.col("_least").alias(f"_n{c}")) for c in "ab")
    close = near.join(one, F.expr("a = _fa")).join(other, F.expr("b = _fb")).select(F.col("_na").alias("a"), F.col("_nb").alias("b"))
    equal = nodes.join(least.select(F.col("fp").alias("_f"), "_least"), F.expr("fp = _f and node <> _least")).select(F.col("_least").alias("a"), F.col("node").alias("b"))
    from_prints = close.unionByName(equal).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))

    sketch = rows.select("shingles").mapInArrow(_count, "block int, counts binary").groupBy("block").applyInArrow(_classes, "block int, classes binary, total bigint")
    found = sorted(sketch.collect())  # a byte per counter, 1 MB in all
    classes, total = b"".join(r.classes for r in found) or bytes(1 << SKETCH_BITS), sum(r.total for r in found)
    tasks = max(1, total // (5 * TASK_ROWS))
    dealt = rows.where("n > 0").select("node", "shingles", "n").mapInArrow(_prefixes(classes, _salts(np.frombuffer(classes, np.uint8), total), tasks), "task int, h binary, node binary, n binary, pos binary, salts binary")
    meet = written(dealt.groupBy("task").applyInArrow(_shared, _MEET), "near-meetings")
    pivots = meet.groupBy("task").applyInArrow(_pivots, "a bigint, b bigint")
    links = _verified(pivots.unionByName(from_prints), rows, nodes)
    roots = written(components(links).select(F.col("node").alias("_node"), "root"), "near-first-roots")

    # Large groups of near copies grow together through one other row for each that meets any, before all pairs across components are looked at.
    rooted = meet.join(roots, F.expr("node = _node"), "left").select("task", "shingle", "salts", "node", "n", "pos", F.coalesce("root", "node").alias("root"))
    left = written(rooted.groupBy("task").applyInArrow(_open, _MEET + ", other bigint"), "near-open")
    tried = left.where("other is not null").select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"))
    links = written(links.unionByName(_verified(tried, rows, nodes)), "near-grown-links")
    roots = written(components(links).select(F.col("node").alias("_node"), "root"), "near-grown-roots")

    bits = nodes.select(F.col("node").alias("_k"), "parity")
    rest = left.join(roots, F.expr("node = _node"), "left").join(bits, F.expr("node = _k")).select("task", "shingle", "salts", "node", "n", "pos", F.coalesce("root", "node").alias("root"), "parity")
    salt = F.pmod(F.pmod("node", F.lit(1 << 30)), "salts").cast("int")
    salted = rest.withColumn("salt", salt).withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    cells = salted.withColumn("low", F.least("salt", "_other")).withColumn("high", F.greatest("salt", "_other"))
    cell = F.when(F.col("salts") == 1, F.col("task").cast("bigint")).otherwise(F.pmod(F.xxhash64("shingle", "low", "high"), F.lit(tasks)))
    # A task may hold several cells of one shingle: the shingle is told apart by its cell.
    own = F.when(F.col("salts") == 1, F.col("shingle")).otherwise(F.xxhash64("shingle", "low", "high"))
    cells = cells.withColumn("_cell", cell).withColumn("shingle", own)
    more = _verified(cells.groupBy("_cell").applyInArrow(_across, "a bigint, b bigint"), rows, nodes)
    both = written(links.unionByName(more), "near-all-links")
    roots = written(components(both).select(F.col("node").alias("_node"), "root"), "near-roots")
    out = written(rows.select("doc_id", "_th", "node").join(roots, F.expr("node = _node"), "left").select("doc_id", "_th", F.coalesce("root", "node").alias("root")), "near-clusters")
    discard(rows, nodes, meet, left, links, more, both, roots)
    return out


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each group of near copies, that of the least id; of repeated rows one stays."""
    return keep_first(docs, clusters(docs))
