"""Toxicity grades by cumulative-link ordinal regression.

One weight vector is shared by ordered thresholds: P(grade <= k) = logistic(threshold_k - w.x). Features
are the words of a text and their first letters, as far as a bounded labelled sample tells them apart
from chance, and how many such words a text holds. Labels say toxic or not; the grade of a toxic row of the
sample (1 to 3) is the third its share of marked words falls in.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlake.llm.common import written

#: Labelled rows that the model is fitted on, at most; the ones with the smallest hash of their id.
SAMPLE_ROWS = 12_000
FEATURES = 4_096
#: Least rows with a feature, and least deviation from chance in standard errors, for it to be used.
LEAST_ROWS, LEAST_Z = 5, 6.0
PREFIXES = (4, 5, 6)
GRADES = 4
_EDGE = ".,;:!?\"'()[]{}*%#-_/<>"


def features_of(word: str) -> list[str]:
    w = word.strip(_EDGE)
    return [w, *(f"{w[:n]}*" for n in PREFIXES if len(w) > n)] if w else []


def words_of(text: str | None) -> list[str]:
    return text.lower().split() if text else []


@dataclass(frozen=True)
class Model:
    """Bounded: at most ``FEATURES`` weights, two for the counts of marked words, three thresholds."""

    index: dict[str, int]
    marks: frozenset[str]
    weights: np.ndarray
    thresholds: np.ndarray

    def dense(self, hits: int, n: int) -> tuple[float, float]:
        return math.log1p(hits), math.log1p(100.0 * hits / max(n, 1))


def _sample(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    ids = known.select(F.col("doc_id").alias("_id"), (F.col("toxic") > 0).cast("int").alias("_y")).orderBy(F.xxhash64("_id"), "_id").limit(rows)
    ids = written(ids, "toxic-sample")
    return docs.select("doc_id", "text").join(F.broadcast(ids), F.expr("doc_id = _id")).select("_y", "text")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: tuple[Counter, Counter] = (Counter(), Counter())
    rows = [0, 0]
    for b in batches:
        for y, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            rows[y] += 1
            seen[y].update({f for w in set(words_of(text)) for f in features_of(w)})
    every = list(seen[1].keys() | seen[0].keys())
    seen[0][""], seen[1][""] = rows
    every.append("")
    for i in range(0, len(every), 50_000):
        part = every[i : i + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), pa.array([seen[1][f] for f in part], pa.int64()), pa.array([seen[0][f] for f in part], pa.int64())], ["f", "bad", "good"])


def _encode(index: dict[str, int], marks: frozenset[str]):
    """Text -> (ids of its features, marked words, words); remembers words within a task, up to a bound."""
    memo: dict[str, tuple[tuple[int, ...], bool]] = {}

    def encode(text: str | None) -> tuple[set[int], int, int]:
        words = words_of(text)
        ids: set[int] = set()
        hits = 0
        for w, n in Counter(words).items():
            got = memo.get(w)
            if got is None:
                if len(memo) > 300_000:
                    memo.clear()
                fs = features_of(w)
                got = memo[w] = tuple(index[f] for f in fs if f in index), any(f in marks for f in fs)
            if got[0]:
                ids.update(got[0])
                hits += n * got[1]
        return ids, hits, len(words)

    return encode


def _fit_weights(rows: list[np.ndarray], dense: np.ndarray, grade: np.ndarray, width: int, steps: int = 500, l2: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """Full-batch Adam on the mean negative log-likelihood; deterministic."""
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    ids = np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int64)
    w = np.zeros(width + dense.shape[1])
    raw = np.array([2.0, *[0.5] * (GRADES - 2)])  # first threshold, then logarithms of the steps above it
    p, m, v = np.concatenate([w, raw]), 0.0, 0.0
    for t in range(1, steps + 1):
        w, raw = p[:-GRADES + 1], p[-GRADES + 1 :]
        theta = np.cumsum(np.concatenate([raw[:1], np.exp(raw[1:])]))
        z = np.bincount(owner, w[ids], len(rows)) + dense @ w[width:]
        edge = np.concatenate([[-np.inf], theta, [np.inf]])
        up, lo = 1 / (1 + np.exp(np.clip(z - edge[grade + 1], -60, 60))), 1 / (1 + np.exp(np.clip(z - edge[grade], -60, 60)))
        up[grade == GRADES - 1], lo[grade == 0] = 1.0, 0.0
        prob = np.maximum(up - lo, 1e-12)
        du, dl = up * (1 - up) / prob, lo * (1 - lo) / prob
        gz = (du - dl) / len(rows)
        gt = np.zeros(GRADES - 1)
        np.add.at(gt, grade[grade < GRADES - 1], -du[grade < GRADES - 1] / len(rows))
        np.add.at(gt, grade[grade > 0] - 1, dl[grade > 0] / len(rows))
        graw = np.concatenate([[gt.sum()], np.exp(raw[1:]) * np.cumsum(gt[::-1])[::-1][1:]])
        g = np.concatenate([np.bincount(ids, gz[owner], width) + l2 * w[:width], dense.T @ gz + l2 * w[width:], graw])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p = p - 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    raw = p[-GRADES + 1 :]
    return p[: -GRADES + 1], np.cumsum(np.concatenate([raw[:1], np.exp(raw[1:])]))


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, features: int = FEATURES) -> Model:
    """A model from at most ``sample_rows`` labelled rows. Without toxic labels every text is graded 0."""
    sample = written(_sample(docs, labels, sample_rows), "toxic-rows")
    counts = sample.mapInArrow(_count, "f string, bad bigint, good bigint").groupBy("f").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    counts = written(counts.where((F.col("f") == "") | (F.col("bad") + F.col("good") >= LEAST_ROWS)), "toxic-features")
    totals = counts.where("f = ''").first()
    none = Model({}, frozenset(), np.zeros(2), np.array([50.0, 51.0, 52.0]))
    if totals is None or not totals["bad"] or not totals["good"]:
        return none
    t, c = float(totals["bad"]), float(totals["good"])
    pooled = (F.col("bad") + F.col("good")) / (t + c)
    z = (F.col("bad") / t - F.col("good") / c) / F.sqrt(pooled * (1 - pooled) * (1 / t + 1 / c) + 1e-12)
    best = counts.where("f <> ''").withColumn("z", z).where(F.abs("z") >= LEAST_Z).orderBy(F.desc(F.abs("z")), "f").limit(features).collect()
    index = {r["f"]: i for i, r in enumerate(best)}
    marks = frozenset(r["f"] for r in best if r["z"] > 0 and r["bad"] / t > 10 * r["good"] / c)

    def encoded(batches):
        encode = _encode(index, marks)
        for b in batches:
            got = [encode(x) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int32()), pa.array([sorted(g[0]) for g in got], pa.list_(pa.int32())), pa.array([g[1] for g in got], pa.int64()), pa.array([g[2] for g in got], pa.int64())], ["y", "ids", "hits", "n"])

    got = sample.mapInArrow(encoded, "y int, ids array<int>, hits bigint, n bigint").orderBy("y", "n", "hits", "ids").toArrow()
    y, hits, n = (got.column(k).to_numpy() for k in ("y", "hits", "n"))
    share = hits / np.maximum(n, 1)
    cuts = np.quantile(share[y == 1], [1 / 3, 2 / 3])
    grade = np.where(y == 1, 1 + (share > cuts[0]) + (share > cuts[1]), 0)
    model = Model(index, marks, np.zeros(0), np.zeros(0))
    dense = np.array([model.dense(h, k) for h, k in zip(hits, n, strict=True)])
    weights, thresholds = _fit_weights([np.asarray(r, np.int64) for r in got.column("ids").to_pylist()], dense, grade, len(index))
    return Model(index, marks, weights, thresholds)


def grade(docs: DataFrame, model: Model, keep_clean: bool = False, cut: float = 0.5) -> DataFrame:
    """All columns of ``docs`` for rows that are not toxic, or else one row per document row:
    doc_id, p_toxic, p_grade1, p_grade2, p_grade3, severity (the expected grade), grade, toxic.

    Null and empty texts hold no feature and get the grade of one.
    """
    encode_of, spark = _encode, docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    at = docs.columns.index("text") if keep_clean else 1

    def scores(texts: list[str | None], encode, m: Model) -> np.ndarray:
        z = np.zeros(len(texts))
        for i, text in enumerate(texts):
            ids, hits, n = encode(text)
            a, b = m.dense(hits, n)
            z[i] = sum(m.weights[j] for j in sorted(ids)) + a * m.weights[-2] + b * m.weights[-1]
        return 1 / (1 + np.exp(-np.clip(m.thresholds[None, :] - z[:, None], -60, 60)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        encode = encode_of(m.index, m.marks)
        for b in batches:
            below = scores(b.column(at).to_pylist(), encode, m)
            toxic = 1 - below[:, 0]
            if keep_clean:
                yield b.filter(pa.array(toxic < cut))
                continue
            p = np.diff(np.concatenate([below, np.ones((len(below), 1))], axis=1), axis=1)
            severity = (1 - below).sum(axis=1)
            top = np.argmax(np.concatenate([below[:, :1], p], axis=1), axis=1)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(x) for x in (toxic, p[:, 0], p[:, 1], p[:, 2], severity)), pa.array(top.astype(np.int32)), pa.array(toxic >= cut)], ["doc_id", "p_toxic", "p_grade1", "p_grade2", "p_grade3", "severity", "grade", "toxic"])

    if keep_clean:
        return docs.mapInArrow(run, docs.schema)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, p_toxic double, p_grade1 double, p_grade2 double, p_grade3 double, severity double, grade int, toxic boolean")


def toxicity(docs: DataFrame, labels: DataFrame, **fitted) -> DataFrame:
    """Grades of all ``docs`` by a model fitted on their labelled rows."""
    return grade(docs, fit(docs, labels, **fitted))


def drop_toxic(docs: DataFrame, labels: DataFrame, **fitted) -> DataFrame:
    """``docs`` without the rows judged toxic, all columns kept."""
    return grade(docs, fit(docs, labels, **fitted), keep_clean=True)
