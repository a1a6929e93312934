"""Exact-substring deduplication by suffix sorting of shards.

Every ``width``-byte string holds ``width - GRAM + 1`` short grams; the one with the least hash is its anchor, and equal
strings have equal anchors. Strings next to each other mostly share their anchor, and the piece of text they span is
what goes to the shard of the anchor's hash, if that anchor occurs more than once at all. A shard counts equal
pieces, whose strings all repeat; what is left is sorted by suffixes (see ``induced``), where repeated strings are
neighbours. Pieces of very frequent anchors are cut into single strings first, so that no shard has to take them all.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlake.llm.common import written
from basketlake.llm.induced import repeated
from basketlake.llm.packing import compress, deal, expand, pack, unpack

WIDTH, GRAM = 200, 24
#: Bytes of a packed batch, of text that one shard answers for, and of pieces sorted at a time.
BATCH_BYTES, SHARD_BYTES, SORT_BYTES = 4 << 20, 12 << 20, 2 << 20
#: An anchor that occurs more often is very frequent.
FREQUENT = 5_000
#: Low bits of a gram's hash that make room for its position; longer stretches of text are taken in parts.
PLACE_BITS = 24


def _hash_grams(raw: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of the ``k`` bytes from each position, put together from powers of two."""
    out, have, power, base = None, 0, raw.astype(np.uint64) + np.uint64(1), np.uint64(0x9E3779B97F4A7C15)
    size = 1
    while k:
        if k & 1:
            if out is None:
                out, have = power, size
            else:
                n = len(raw) - have - size + 1
                out, have = out[:n] * base ** np.uint64(size) + power[have : have + n], have + size
        k >>= 1
        if k:
            n = len(power) - size
            power = power[:n] * base ** np.uint64(size) + power[size : size + n]
            size *= 2
    out = (out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


def runs(raw: np.ndarray, lens: np.ndarray, width: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first string, number of strings, anchor hash) of the runs of strings with one anchor, texts one after another."""
    start = np.concatenate([[0], np.cumsum(lens)])
    inside = np.zeros(len(raw) + 1, np.int64)
    long = lens >= width
    inside[start[:-1][long]] += 1
    inside[start[1:][long] - width + 1] -= 1
    inside = np.cumsum(inside)
    # A stretch holds as many bytes as positions fit; the next one starts with the first string that did not fit.
    most = 1 << PLACE_BITS
    parts = [_runs(raw[at : at + most], inside[at : at + most], width, gram, at) for at in range(0, max(len(raw) - width + 1, 1), most - width + 1)]
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _runs(raw: np.ndarray, inside: np.ndarray, width: int, gram: int, at: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The runs of one stretch that begins at byte ``at``; ``inside`` tells where a string may start."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    if len(raw) < width:
        return none
    h = _hash_grams(raw, gram)
    low = np.uint64((1 << PLACE_BITS) - 1)
    key = (h & ~low) | np.arange(len(h), dtype=np.uint64)
    window, size = width - gram + 1, 1
    while 2 * size <= window:
        key = np.minimum(key[:-size], key[size:])
        size *= 2
    if size < window:
        key = np.minimum(key[: len(key) - (window - size)], key[window - size :])
    anchor = (key & low).astype(np.int64)
    p = np.nonzero(inside[: len(anchor)])[0]
    if not len(p):
        return none
    a = anchor[p]
    new = np.nonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (p[1:] != p[:-1] + 1)]))[0]
    return p[new] + at, np.diff(np.append(new, len(p))), h[a[new]]


def _batches(batch_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, docs, of, texts, held = TaskContext.get().partitionId(), 0, [], [], {}, 0

        def flush():
            nonlocal docs, of, texts, held, made
            copies = np.bincount(of, minlength=len(texts))
            lens = np.array([len(t) for t in texts], np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([(part << 32) + made], pa.int64()), pa.array([docs], pa.list_(kind)), *(pa.array([x], pa.binary()) for x in (pack(np.array(of)), pack(copies), pack(lens), compress(b"".join(texts)))), pa.array([int(lens.sum())], pa.int64())],
                ["batch", "docs", "of", "copies", "lens", "text", "bytes"],
            )
            docs, of, texts, held, made = [], [], {}, 0, made + 1

        for b in batches:
            kind = b.schema.field(0).type
            for d, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                t = (text.as_py() or "").encode()
                if docs and held + len(t) > batch_bytes:
                    yield from flush()
                if t not in texts:
                    texts[t] = len(texts)
                    held += len(t)
                docs.append(d)
                of.append(texts[t])
        if docs:
            yield from flush()

    return run


def _texts(row: dict) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(expand(row["text"]), np.uint8), unpack(row["lens"]).astype(np.int64)


def _ask_anchors(shards: int, width: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                raw, lens = _texts(row)
                first, _, key = runs(raw, lens, width, gram)
                doc = np.searchsorted(np.cumsum(lens), first, side="right")
                keys, at = np.unique(key, return_inverse=True)
                count = np.bincount(at, unpack(row["copies"])[doc].astype(np.float64), len(keys)).astype(np.int64)
                parts = deal((keys % np.uint64(shards)).astype(np.int64), shards)
                yield pa.RecordBatch.from_arrays([pa.array([j for j, _ in parts], pa.int32()), pa.array([row["batch"]] * len(parts), pa.int64()), pa.array([keys[p].tobytes() for _, p in parts], pa.binary()), pa.array([pack(count[p]) for _, p in parts], pa.binary())], ["shard", "batch", "keys", "counts"])

    return run


def _answer_anchors(frequent: int):
    def run(t: pa.Table) -> pa.Table:
        parts = [np.frombuffer(x, np.uint64) for x in t.column("keys").to_pylist()]
        keys, of = np.unique(np.concatenate(parts), return_inverse=True)
        total = np.bincount(of, np.concatenate([unpack(x) for x in t.column("counts").to_pylist()]).astype(np.float64), len(keys))
        kind = ((total > 1).astype(np.int64) + (total > frequent))[of]
        return pa.table({"batch": t.column("batch"), "shard": t.column("shard"), "kinds": pa.array([pack(k) for k in np.split(kind, np.cumsum([len(p) for p in parts])[:-1])], pa.binary())})

    return run


def _ask_pieces(shards: int, width: int, gram: int):
    def run(t: pa.Table, r: pa.Table) -> pa.Table:
        row = t.to_pylist()[0]
        raw, lens = _texts(row)
        first, n, key = runs(raw, lens, width, gram)
        copies = unpack(row["copies"])[np.searchsorted(np.cumsum(lens), first, side="right")]
        keys, at = np.unique(key, return_inverse=True)
        kind = np.zeros(len(keys), np.int64)
        place = dict(deal((keys % np.uint64(shards)).astype(np.int64), shards))
        for shard, kinds in zip(r.column("shard").to_pylist(), r.column("kinds").to_pylist(), strict=True):
            kind[place[shard]] = unpack(kinds).astype(np.int64)
        text, tail = raw.tobytes(), width - 1
        items: dict[bytes, list] = {}  # piece -> [key, occurrences, runs]
        for i in np.nonzero(kind[at] > 0)[0].tolist():
            s, e = int(first[i]), int(first[i] + n[i])
            if kind[at[i]] == 1:
                x = items.setdefault(text[s : e + tail], [int(key[i]), 0, []])
                x[1] += int(copies[i])
                x[2].append(s)
            else:
                for p in range(s, e):
                    piece = text[p : p + width]
                    x = items.setdefault(piece, [xxhash.xxh64_intdigest(piece), 0, []])
                    x[1] += int(copies[i])
                    x[2].append(p)
        pieces, info = list(items), list(items.values())
        shard = (np.array([x[0] for x in info], np.uint64) % np.uint64(shards)).astype(np.int64)
        out: dict[str, list] = {"shard": [], "data": []}
        for j, p in deal(shard, shards):
            p = p.tolist()
            out["shard"].append(j)
            out["data"].append([np.array([info[q][0] for q in p], np.uint64).tobytes(), pack(np.array([min(info[q][1], 2) for q in p])), pack(np.array([len(pieces[q]) for q in p])), compress(b"".join(pieces[q] for q in p))])
        local = [pack(shard), pack(np.array([len(x) - tail for x in pieces], np.int64)), pack(np.array([len(x[2]) for x in info])), pack(np.array([s for x in info for s in x[2]]))]
        m = len(out["shard"])
        return pa.table({"batch": pa.array([row["batch"]] * (m + 1), pa.int64()), "shard": pa.array([*out["shard"], -1], pa.int32()), "data": pa.array([*out["data"], local], pa.list_(pa.binary()))})

    return run


def _answer_pieces(width: int, sort_bytes: int):
    def run(t: pa.Table) -> pa.Table:
        seen: dict[bytes, list] = {}  # piece -> [key, times, flags]
        order: list[list[bytes]] = []
        for keys, times, lens, text in t.column("data").to_pylist():
            text, at, mine = expand(text), 0, []
            for k, c, n in zip(np.frombuffer(keys, np.uint64).tolist(), unpack(times).tolist(), unpack(lens).tolist(), strict=True):
                piece = text[at : at + n]
                at += n
                seen.setdefault(piece, [k, 0, None])[1] += c
                mine.append(piece)
            order.append(mine)
        groups: dict[int, list[bytes]] = {}
        for piece, x in seen.items():
            groups.setdefault(x[0], []).append(piece)
        batch: list[bytes] = []

        def sort() -> None:
            for piece, flags in zip(batch, repeated(batch, width), strict=True):
                seen[piece][2] = flags
            batch.clear()

        held = 0
        for pieces in groups.values():
            # Strings of pieces that occur twice repeat; the others may repeat within pieces of their anchor.
            if len(pieces) > 1 and any(seen[p][1] < 2 for p in pieces):
                batch += pieces
                held += sum(map(len, pieces))
                if held >= sort_bytes:
                    sort()
                    held = 0
        if batch:
            sort()
        codes, masks = [], []
        for mine in order:
            code, mask = [], []
            for piece in mine:
                _, times, flags = seen[piece]
                if times > 1 or flags is None or not flags.any():
                    code.append(int(times > 1))
                else:
                    code.append(2)
                    mask.append(flags)
            codes.append(pack(np.array(code)))
            masks.append(compress(np.packbits(np.concatenate(mask)).tobytes()) if mask else b"")
        return pa.table({"batch": t.column("batch"), "shard": t.column("shard"), "data": pa.array([[c, m] for c, m in zip(codes, masks, strict=True)], pa.list_(pa.binary()))})

    return run


def _finish(shards: int, width: int, kind: pa.DataType, keep: bool):
    def run(t: pa.Table, r: pa.Table) -> pa.Table:
        row = t.to_pylist()[0]
        raw, lens = _texts(row)
        ends = np.cumsum(lens)
        begins = ends - lens
        change = np.zeros(len(raw) + 1, np.int64)
        answers = dict(zip(r.column("shard").to_pylist(), r.column("data").to_pylist(), strict=True))
        shard, n, times, starts = (unpack(x).astype(np.int64) for x in answers[-1])
        at = np.concatenate([[0], np.cumsum(times)])
        for j, p in deal(shard, shards):
            code, mask = answers[j]
            code = unpack(code).astype(np.int64)
            partly = p[code == 2]
            bits = np.unpackbits(np.frombuffer(expand(mask), np.uint8))[: n[partly].sum()].astype(bool) if len(partly) else None
            whole = p[code == 1]
            for q in whole.tolist():
                s = starts[at[q] : at[q + 1]]
                np.add.at(change, s, 1)
                np.add.at(change, s + n[q] + width - 1, -1)
            done = 0
            for q in partly.tolist():
                hit = np.nonzero(bits[done : done + n[q]])[0]
                done += int(n[q])
                for s in starts[at[q] : at[q + 1]].tolist():
                    np.add.at(change, hit + s, 1)
                    np.add.at(change, hit + s + width, -1)
        gone = np.cumsum(change)[:-1] > 0
        copies = unpack(row["copies"])
        for i in np.nonzero((copies > 1) & (lens >= width))[0].tolist():
            gone[begins[i] : ends[i]] = True
        facts = []
        for a, e in zip(begins.tolist(), ends.tolist(), strict=True):
            g = gone[a:e]
            kept = raw[a:e][~g].tobytes()
            edges = int((np.diff(g.astype(np.int8), prepend=0) == 1).sum()) if e > a else 0
            facts.append((e - a, int(g.sum()), edges, hashlib.sha256(kept).hexdigest(), kept if keep else None))
        of = unpack(row["of"]).tolist()
        types = (("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary()))
        return pa.table({"doc_id": pa.array(row["docs"], kind), **{name: pa.array([facts[i][k] for i in of], typ) for k, (name, typ) in enumerate(types) if keep or name != "kept"}})

    return run


def remove_repeats(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, frequent: int = FREQUENT, keep: bool = False, batch_bytes: int = BATCH_BYTES, shard_bytes: int = SHARD_BYTES, sort_bytes: int = SORT_BYTES) -> DataFrame:
    """One row per document row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, with ``keep`` also the bytes kept.

    Removed is every byte of a ``width``-byte string that starts anywhere else as well. Null texts are empty;
    shorter texts lose nothing; repeated rows of ``width`` bytes or more lose all. Only doc_id and text are read.
    """
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    arrow = spark.createDataFrame([], docs.select("doc_id").schema).toArrow().schema.field(0).type
    t = written(docs.select("doc_id", "text").mapInArrow(_batches(batch_bytes), f"batch bigint, docs array<{kind}>, of binary, copies binary, lens binary, text binary, bytes bigint"), "repeat-batches")
    shards = max(1, -(-(t.agg(F.sum("bytes")).first()[0] or 0) // shard_bytes))
    asked = t.select("batch", "copies", "lens", "text").mapInArrow(_ask_anchors(shards, width, gram), "shard int, batch bigint, keys binary, counts binary")
    anchors = asked.groupBy("shard").applyInArrow(_answer_anchors(frequent), "batch bigint, shard int, kinds binary")
    pieces = t.select("batch", "copies", "lens", "text").groupBy("batch").cogroup(anchors.groupBy("batch")).applyInArrow(_ask_pieces(shards, width, gram), "batch bigint, shard int, data array<binary>")
    pieces = written(pieces, "repeat-pieces")
    answers = pieces.where("shard >= 0").groupBy("shard").applyInArrow(_answer_pieces(width, sort_bytes), "batch bigint, shard int, data array<binary>")
    both = pieces.where("shard = -1").unionByName(answers)
    out = f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + ", kept binary" * keep
    return t.drop("bytes").groupBy("batch").cogroup(both.groupBy("batch")).applyInArrow(_finish(shards, width, arrow, keep), out)
