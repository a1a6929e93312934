"""Language-model scores from an Elias-Fano n-gram trie, built and queried shard by shard.

The model is a bigram with Dirichlet smoothing, P(w|v) = (c(vw) + MU * P(w)) / (c(v) + MU), over the add-one
unigram P(w) = (c(w) + 1) / (N + V + 1). Documents are tokenised into packed batches. Level one: the distinct
words of a batch go to shards by hash, which count them and answer with ids and counts. Level two: bigrams go
to the shard of their context, which builds the trie of the training ones, memory-maps it, looks all of them
up, and answers with a sum for each document. Contexts with a large share of all tokens are dealt by follower.
Pairs of the few most frequent words go the same way, but once a batch with their count, and are answered by the pair.

With order 3 that is smoothed once more, P(w|uv) = (c(uvw) + MU * P(w|v)) / (c(uv) + MU): all pairs go once a batch and
are answered with their count and probability, and level three takes every triple to the shard of its first two words,
where the trie's next level is built and asked in the same way.
"""

from __future__ import annotations

import os
import tempfile
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlake.llm.common import discard, written
from basketlake.llm.packing import deal, pack, unpack
from basketlake.llm.trie import Level, quantise, unquantise

MU = 100.0
FOLD, HELD_OUT = 7, 2
#: Tokens of a packed batch, and tokens that one shard answers for.
BATCH_TOKENS, SHARD_TOKENS = 1_000_000, 1_500_000
#: Words with more than one in so many of all tokens: at most that many words, and that many squared pairs.
TOP = 256
END, START = 0, 1

def held_out(doc_id) -> bool:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % FOLD == HELD_OUT


class _Words(dict):
    def __missing__(self, w: bytes) -> int:
        self[w] = n = len(self)
        return n


def _tokenise(batch_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        docs, seqs, words, held = [], [], _Words({b"": END, b"\0start": START}), 0

        def flush():
            nonlocal docs, seqs, words, held, made
            ids = np.concatenate(seqs).astype(np.uint32)
            lens = np.array([len(s) for s in seqs])
            train = np.repeat([not held_out(d) for d in docs], lens)
            count = np.bincount(ids[train], minlength=len(words))
            count[START] = sum(not held_out(d) for d in docs)
            hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words))
            yield pa.RecordBatch.from_arrays(
                [pa.array([(part << 32) + made], pa.int64()), pa.array([docs], pa.list_(kind)), *(pa.array([x], pa.binary()) for x in (pack(lens), pack(ids, 9), hashes.tobytes(), pack(count))), pa.array([int(len(ids))], pa.int64())],
                ["batch", "docs", "lens", "ids", "hashes", "counts", "tokens"],
            )
            docs, seqs, words, held, made = [], [], _Words({b"": END, b"\0start": START}), 0, made + 1

        for b in batches:
            kind = b.schema.field(0).type
            for d, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                t = text.as_py()
                seq = np.array([*map(words.__getitem__, t.encode().lower().split()), END] if t else [END], np.uint32)
                docs.append(d)
                seqs.append(seq)
                held += len(seq)
                if held >= batch_tokens:
                    yield from flush()
        if docs:
            yield from flush()

    return run


def _ask_words(shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for batch, hashes, counts in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                h, c = np.frombuffer(hashes, np.uint64), unpack(counts)
                parts = deal((h % np.uint64(shards)).astype(np.int64), shards)
                yield pa.RecordBatch.from_arrays([pa.array([j for j, _ in parts], pa.int32()), pa.array([batch] * len(parts), pa.int64()), pa.array([h[p].tobytes() for _, p in parts]), pa.array([pack(c[p]) for _, p in parts]), pa.array([pack(np.diff(p, prepend=0)) for _, p in parts])], ["shard", "batch", "hashes", "counts", "places"])

    return run


def _answer_words(shards: int, frequent: int):
    special = np.array([xxhash.xxh64_intdigest(b"\0start")], np.uint64)

    def run(t: pa.Table) -> pa.Table:
        shard, batch = t.column("shard")[0].as_py(), t.column("batch").to_pylist()
        parts = [np.frombuffer(x, np.uint64) for x in t.column("hashes").to_pylist()]
        words, of = np.unique(np.concatenate(parts), return_inverse=True)
        total = np.zeros(len(words), np.int64)
        np.add.at(total, of, np.concatenate([unpack(x) for x in t.column("counts").to_pylist()]).astype(np.int64))
        known = (total > 0) & ~np.isin(words, special)
        top = np.nonzero(known & (total > frequent))[0]
        cut = np.cumsum([len(p) for p in parts])[:-1]
        is_top = np.zeros(len(words), bool)
        is_top[top] = True
        tops = [[{"word": int(words[o[i]].view(np.int64)), "n": int(i)} for i in np.nonzero(is_top[o])[0]] for o in np.split(of, cut)]
        answers = [(pack(o.astype(np.uint64) * np.uint64(shards) + np.uint64(shard)), pack(total[o])) for o in np.split(of, cut)]
        return pa.table(
            {
                "batch": pa.array([-1, *batch], pa.int64()), "shard": pa.array([shard] * (len(batch) + 1), pa.int32()), "ids": pa.array([b"", *(a for a, _ in answers)]), "counts": pa.array([b"", *(c for _, c in answers)]),
                "n": pa.array([int(total[known].sum()), *[0] * len(batch)], pa.int64()), "v": pa.array([int(known.sum()), *[0] * len(batch)], pa.int64()),
                "top": pa.array([[{"word": int(a), "n": int(b)} for a, b in zip(words[top].view(np.int64), total[top], strict=True)], *tops], _TOPS), "places": pa.array([b"", *t.column("places").to_pylist()]),
            }
        )

    return run


_TOPS = pa.list_(pa.struct([("word", pa.int64()), ("n", pa.int64())]))


def _before(ids: np.ndarray, lens: np.ndarray) -> np.ndarray:
    out = np.concatenate([[START], ids[:-1]])
    out[np.concatenate([[0], np.cumsum(lens)[:-1]])] = START
    return out


def _batch_pairs(shards: int, n: int, v: int, top: np.ndarray, kind: pa.DataType, ask: bool, once: bool = False):
    """Joins a batch with the answers for its words. ``ask``: messages with its pairs for the shards; else a row with all that stays."""

    def run(t: pa.Table, r: pa.Table) -> pa.Table:
        b = _Batch(t, r, n, v, top, once)
        if not ask and once:
            return b.row([], kind)
        if not ask:
            k = len(top)
            key, times = np.unique(b.doc[b.both].astype(np.int64) * (k * k) + b.pairs, return_counts=True)
            top_pairs = [pack(key // (k * k)), pack(key % (k * k)), pack(times)] if k else [pack(key), pack(key), pack(times)]
            return b.row(top_pairs, kind)
        out = []
        for shard, at in deal(b.where(shards, n), shards):
            q, f = b.p[at[at < len(b.p)]], at[at >= len(b.p)] - len(b.p)
            contexts, ci = np.unique(b.first[at], return_inverse=True)
            words, wi = np.unique(b.second[at], return_inverse=True)
            out.append((shard, [pack(x) for x in (b.word[contexts], b.count[contexts], ci, b.word[words], quantise(b.uni)[words], wi, np.diff(b.doc[q], prepend=0), b.train, b.key[f] if not once else b.key[:0], b.times[f])]))
        return b.messages(out)

    return run


class _Batch:
    """A batch joined with the answers for its words.

    Every pair goes to the shard of its context, or of the pair where the context is frequent: one by one with its
    document, those of frequent words, or with ``once`` all, once with how often training has them.
    """

    def __init__(self, t: pa.Table, r: pa.Table, n: int, v: int, top: np.ndarray, once: bool = False):
        row = {k: t.column(k)[0].as_py() for k in ("batch", "docs", "lens", "ids")}
        self.batch, self.docs = row["batch"], row["docs"]
        self.ids, self.lens = unpack(row["ids"]).astype(np.int32), unpack(row["lens"]).astype(np.int64)
        answers = [(np.cumsum(unpack(p).astype(np.int64)), unpack(i), unpack(c), often) for p, i, c, often in zip(*(r.column(k).to_pylist() for k in ("places", "ids", "counts", "top")), strict=True)]
        size = sum(len(a[0]) for a in answers)
        self.word, self.count, self.place = np.zeros(size, np.uint64), np.zeros(size, np.int64), np.full(size, -1)
        for at, i, c, often in answers:
            self.word[at], self.count[at] = i, c.astype(np.int64)
            for x in often:
                self.place[at[x["n"]]] = np.searchsorted(top, np.int64(x["word"]).view(np.uint64))
        self.uni = np.log10((self.count + 1.0) / (n + v + 1.0))
        self.before, self.doc = _before(self.ids, self.lens), np.repeat(np.arange(len(self.lens), dtype=np.int32), self.lens)
        place, before, ids, k = self.place, self.before, self.ids, len(top)
        if once:
            place, k = np.arange(size), size
        self.both = (place[before] >= 0) & (place[ids] >= 0)
        self.pairs = place[before[self.both]] * k + place[ids[self.both]]
        self.p = np.nonzero(~self.both)[0].astype(np.int32)
        self.train = np.array([not held_out(d) for d in self.docs])
        local = np.zeros(k, np.int64)
        local[place[place >= 0]] = np.nonzero(place >= 0)[0]
        self.key, self.of = np.unique(self.pairs, return_inverse=True)
        self.times = np.bincount(self.of[self.train[self.doc[self.both]]], minlength=len(self.key))
        self.first, self.second = np.concatenate([before[self.p], local[self.key // max(k, 1)]]), np.concatenate([ids[self.p], local[self.key % max(k, 1)]])

    def where(self, shards: int, n: int) -> np.ndarray:
        word, first, second = self.word, self.first, self.second
        where = (word[first] % np.uint64(shards)).astype(np.int32)
        spread = np.nonzero(self.count[first] > n // (4 * shards))[0]
        where[spread] = (_mixed(word[first[spread]], word[second[spread]]) % np.uint64(shards)).astype(np.int32)
        return where

    def row(self, top_pairs: list[bytes], kind: pa.DataType) -> pa.Table:
        """All that stays of the batch until its sums come."""
        first = np.concatenate([[0], np.cumsum(self.lens)[:-1]])
        return pa.table(
            {
                "batch": pa.array([self.batch], pa.int64()), "top": pa.array([top_pairs], pa.list_(pa.binary())), "docs": pa.array([self.docs], pa.list_(kind)), "lens": pa.array([self.lens], pa.list_(pa.int64())),
                "known": pa.array([np.add.reduceat((self.count[self.ids] > 0).astype(np.int64), first)], pa.list_(pa.int64())), "base": pa.array([np.add.reduceat(self.uni[self.ids], first)], pa.list_(pa.float64())),
            }
        )

    def messages(self, out: list[tuple[int, list[bytes]]]) -> pa.Table:
        return pa.table({"batch": pa.array([self.batch] * len(out), pa.int64()), "shard": pa.array([j for j, _ in out], pa.int32()), "data": pa.array([x for _, x in out], pa.list_(pa.binary()))})


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a * np.uint64(0x9E3779B97F4A7C15) ^ b * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(20)


def _batch_triples(shards: int, n: int, v: int):
    """Joins a batch with the answers for its words and for its pairs; gives messages with its triples, one by one, for the shards.

    A context is the pair of ids of its two words, exact below 2^32 different words. A text starts after two start marks.
    """

    def run(t: pa.Table, r: pa.Table) -> pa.Table:
        b, pairs = _Batch(t, r.filter(r.column("codes").is_null()), n, v, np.zeros(0, np.uint64), once=True), r.filter(r.column("codes").is_valid())
        answers = {j: (unpack(c), unpack(m)) for j, c, m in zip(*(pairs.column(k).to_pylist() for k in ("shard", "codes", "counts")), strict=True)}
        codes, counts = np.zeros(len(b.key), np.uint64), np.zeros(len(b.key), np.int64)
        for shard, at in deal(b.where(shards, n), shards):
            codes[at], counts[at] = answers[shard]
        code, count = codes[b.of], counts[b.of]
        # The context of a word is the pair before it, which training has as often as the context.
        seen = np.concatenate([[0], count[:-1]])
        seen[np.concatenate([[0], np.cumsum(b.lens)[:-1]])] = b.count[START]
        context = b.word[_before(b.before, b.lens)] << np.uint64(32) ^ b.word[b.before]
        where = (_mixed(context, np.zeros_like(context)) % np.uint64(shards)).astype(np.int32)
        spread = np.nonzero(seen > n // (4 * shards))[0]
        where[spread] = (_mixed(context[spread], b.word[b.ids[spread]]) % np.uint64(shards)).astype(np.int32)
        none, out = np.zeros(0, np.uint64), []
        for shard, at in deal(where, shards):
            contexts, one, ci = np.unique(context[at], return_index=True, return_inverse=True)
            words, wi = np.unique(b.ids[at], return_inverse=True)
            out.append((shard, [pack(x) for x in (np.diff(contexts, prepend=np.uint64(0)), seen[at][one], ci, b.word[words], code[at], wi, np.diff(b.doc[at], prepend=0), b.train, none, none)]))
        return b.messages(out)

    return run


def _smoothed(pair, context, uni_code, mu: float) -> np.ndarray:
    return np.log10((pair + mu * 10 ** unquantise(uni_code)) / (context + mu))


def build_level(context: np.ndarray, contexts: int, follower: np.ndarray, times: np.ndarray, total: np.ndarray, uni_code: np.ndarray, mu: float) -> Level:
    """The trie level of distinct pairs, sorted by context and follower, that training holds ``times`` times."""
    have = times > 0
    return Level.build(context[have], follower[have], _smoothed(times[have], total[have], uni_code[have], mu), contexts)


def _answer_pairs(mu: float, each: bool = False, triples: bool = False):
    """Sums for each document; with ``each`` the probability and the count of every entry instead, in the order of the message.

    A message of ``triples`` has its contexts as differences, and the lower order's probability by entry and not by follower.
    """

    def run(t: pa.Table) -> pa.Table:
        batch, shard = t.column("batch").to_pylist(), t.column("shard")[0].as_py()
        v, cv, w, code, docs, train, keys = [], [], [], [], [], [], []
        for data in t.column("data"):
            m = [unpack(x.as_py()) for x in data]
            v.append((np.cumsum(m[0]) if triples else m[0])[m[2]])
            cv.append(m[1].astype(np.int64)[m[2]])
            w.append(m[3][m[5]])
            code.append(m[4].astype(np.uint16) if triples else m[4].astype(np.uint16)[m[5]])
            docs.append(np.cumsum(m[6].astype(np.int32), dtype=np.int32))
            train.append(np.concatenate([m[7][docs[-1]], m[9]]).astype(np.int64))
            keys.append(m[8])
        v, cv, w, code, train = (np.concatenate(x) for x in (v, cv, w, code, train))
        contexts, c = np.unique(v, return_inverse=True)
        order = np.argsort((c.astype(np.uint64) << np.uint64(40)) | w)
        c, w, cv, code = c[order], w[order], cv[order], code[order]
        new = np.nonzero(np.concatenate([[True], (c[1:] != c[:-1]) | (w[1:] != w[:-1])]))[0]
        copies = np.diff(np.append(new, len(c)))
        c, w, cv, code = c[new], w[new], cv[new], code[new]
        times = np.add.reduceat(train[order], new)
        level = build_level(c, len(contexts), w, times, cv, code, mu)
        handle, path = tempfile.mkstemp(suffix=".trie")
        os.close(handle)
        try:
            level.save(path)
            hit, logp = Level.open(path).find(c, w)
        finally:
            os.unlink(path)
        logp = np.where(hit, logp, _smoothed(0.0, cv, code, mu))
        every = np.empty(len(order))
        every[order] = np.repeat(logp, copies)
        cut = np.cumsum([len(d) + len(k) for d, k in zip(docs, keys, strict=True)])[:-1]
        if each:
            cut = np.cumsum([len(unpack(x[2].as_py())) for x in t.column("data")])[:-1]
            often = np.empty(len(order), np.int64)
            often[order] = np.repeat(times, copies)
            codes, counts = ([pack(x) for x in np.split(a, cut)] for a in (quantise(every), often))
            return pa.table({"batch": pa.array(batch, pa.int64()), "shard": pa.array([shard] * len(batch), pa.int32()), "codes": pa.array(codes), "counts": pa.array(counts)})
        at, sums, logs = [], [], []
        for d, x in zip(docs, np.split(every, cut), strict=True):
            new = np.nonzero(np.diff(d, prepend=-1))[0]
            at.append(pack(d[new]))
            sums.append(np.add.reduceat(x[: len(d)], new).astype("<f8").tobytes())
            logs.append(pack(quantise(x[len(d) :])))
        return pa.table({"batch": pa.array(batch, pa.int64()), "shard": pa.array([shard] * len(batch), pa.int32()), "at": pa.array(at), "sums": pa.array(sums), "pairs": pa.array([pack(k) for k in keys]), "logs": pa.array(logs)})

    return run


def _finish(n: int, v: int, tops: int, kind: pa.DataType):
    def run(d: pa.Table, r: pa.Table) -> pa.Table:
        rows = [{k: d.column(k)[i].as_py() for k in ("docs", "lens", "known", "base", "top")} for i in range(d.num_rows)]
        row = rows[0]
        score, table = np.zeros(len(row["docs"])), np.zeros(tops * tops)
        for _, at, sums, pairs, logs in sorted(zip(*(r.column(k).to_pylist() for k in ("shard", "at", "sums", "pairs", "logs")), strict=True)):
            score[unpack(at).astype(np.int64)] += np.frombuffer(sums, "<f8")
            table[unpack(pairs).astype(np.int64)] = unquantise(unpack(logs))
        if tops:
            doc, pair, times = (unpack(x).astype(np.int64) for x in row["top"])
            np.add.at(score, doc, table[pair] * times)
        return pa.table(
            {
                "doc_id": pa.array(row["docs"], kind), "held_out": pa.array([held_out(x) for x in row["docs"]]), "n_tokens": pa.array(row["lens"], pa.int64()), "n_known": pa.array(row["known"], pa.int64()),
                "train_tokens": pa.array([n] * len(score), pa.int64()), "base_score": pa.array(row["base"], pa.float64()), "score": pa.array(score), "vocabulary": pa.array([v] * len(score), pa.int64()),
            }
        )

    return run


def scores(docs: DataFrame, mu: float = MU, batch_tokens: int = BATCH_TOKENS, shard_tokens: int = SHARD_TOKENS, order: int = 2) -> DataFrame:
    """One row per document row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, vocabulary.

    ``order`` is 2, or 3 for the score of triples smoothed with pairs.

    Null and empty texts are the end token alone; a null id trains; repeated rows each count and each get their
    row. A word is known by its XXH64. Only doc_id and text are read.
    """
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    arrow = spark.createDataFrame([], docs.select("doc_id").schema).toArrow().schema.field(0).type
    t = written(docs.select("doc_id", "text").mapInArrow(_tokenise(batch_tokens), f"batch bigint, docs array<{kind}>, lens binary, ids binary, hashes binary, counts binary, tokens bigint"), "lm-batches")
    tokens = t.agg(F.sum("tokens")).first()[0] or 0
    shards, frequent = max(1, -(-tokens // shard_tokens)), tokens // TOP
    asked = t.select("batch", "hashes", "counts").mapInArrow(_ask_words(shards), "shard int, batch bigint, hashes binary, counts binary, places binary")
    answers = asked.groupBy("shard").applyInArrow(_answer_words(shards, frequent), "batch bigint, shard int, ids binary, counts binary, n bigint, v bigint, top array<struct<word:bigint,n:bigint>>, places binary")
    words = written(answers, "lm-words")
    sums = words.where("batch = -1")
    n, v = sums.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("v"), F.lit(0))).first()
    # Fewer than TOP words have more than one in TOP of all tokens, so this and the number of their pairs are bounded.
    top = np.array(sorted(int(np.int64(r[0]).view(np.uint64)) for r in sums.select(F.explode("top.word")).collect()), np.uint64)

    joined = t.select("batch", "docs", "lens", "ids").groupBy("batch").cogroup(words.where("batch >= 0").select("batch", "shard", "ids", "counts", "top", "places").groupBy("batch"))
    pairs = lambda ask: _batch_pairs(shards, n, v, top, arrow, ask, once=order == 3)
    asked = joined.applyInArrow(pairs(True), "batch bigint, shard int, data array<binary>")
    told = "batch bigint, shard int, at binary, sums binary, pairs binary, logs binary"
    if order == 3:
        each = written(asked.groupBy("shard").applyInArrow(_answer_pairs(mu, each=True), "batch bigint, shard int, codes binary, counts binary"), "lm-pairs")
        both = words.where("batch >= 0").select("batch", "shard", "ids", "counts", "top", "places").unionByName(each, allowMissingColumns=True)
        triples = t.select("batch", "docs", "lens", "ids").groupBy("batch").cogroup(both.groupBy("batch")).applyInArrow(_batch_triples(shards, n, v), "batch bigint, shard int, data array<binary>")
        replies = written(triples.groupBy("shard").applyInArrow(_answer_pairs(mu, triples=True), told), "lm-sums")
        discard(each)
    else:
        replies = asked.groupBy("shard").applyInArrow(_answer_pairs(mu), told)
    rows = joined.applyInArrow(pairs(False), f"batch bigint, top array<binary>, docs array<{kind}>, lens array<bigint>, known array<bigint>, base array<double>")
    out = f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double, vocabulary bigint"
    return rows.groupBy("batch").cogroup(replies.groupBy("batch")).applyInArrow(_finish(n, v, len(top) if order == 2 else 0, arrow), out)
