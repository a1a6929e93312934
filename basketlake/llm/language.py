"""Language of web pages by Bayesian fusion of evidence.

The text's likelihood comes from hashed character trigrams, counted on a bounded sample of labelled documents.
What pages declare in their markup and how their address ends counts as far as it has agreed with the texts
of the corpus. The host's prior is its pages' share of a language, smoothed towards its domain's, and that
towards the corpus'. All shares are grouped aggregates over all pages; a page's own text is taken out of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlake.llm.common import written

#: Labelled documents the trigram model is counted on, at most; those with the smallest hash of their id.
SAMPLE_ROWS = 4_000
BINS = 8_192
#: Trigrams overlap and repeat; a longer text says no more than so many independent ones.
TRIGRAMS = 40
KAPPA = 5.0


def bins_of(text: str | None) -> np.ndarray:
    """Bins of the character trigrams; ASCII other than letters is white space."""
    c = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), "<u4").astype(np.int64)
    c = np.where((c < 128) & ((c < 97) | (c > 122)), 32, c)
    c = np.concatenate([[32], c[(c != 32) | (np.concatenate([[0], c[:-1]]) != 32)], [32]])
    if len(c) < 3:
        return np.zeros(0, np.int64)
    h = (c[:-2] * 1_000_003 + c[1:-1]) * 1_000_003 + c[2:]
    return ((h ^ (h >> 17)) & 0x7FFFFFFF) % BINS


def fit(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> tuple[list[str], np.ndarray]:
    """(languages, log-likelihood of each bin by language) from labelled documents."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    ids = written(known.select(F.col("doc_id").alias("_id"), "lang").orderBy(F.xxhash64("doc_id"), "doc_id", "lang").limit(sample_rows).select("_id").distinct(), "lang-sample")
    sample = known.select("doc_id", "lang", "text").join(F.broadcast(ids), F.expr("doc_id <=> _id"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, np.ndarray] = {}
        for b in batches:
            for lang, text in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                seen[lang] = seen.get(lang, 0) + np.bincount(bins_of(text), minlength=BINS)
        for lang, n in seen.items():
            at = np.nonzero(n)[0]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at.astype(np.int32)), pa.array(n[at])], ["lang", "bin", "n"])

    rows = sample.mapInArrow(count, "lang string, bin int, n bigint").groupBy("lang", "bin").agg(F.sum("n").alias("n")).collect()
    langs = sorted({r["lang"] for r in rows})
    n = np.full((len(langs), BINS), 0.5)
    for r in rows:
        n[langs.index(r["lang"]), r["bin"]] += r["n"]
    return langs, np.log(n / n.sum(axis=1, keepdims=True))


def visible_text(html: Column) -> Column:
    """Text outside scripts, styles, comments and tags; references become white space."""
    return F.regexp_replace(F.regexp_replace(html, r"(?is)<(script|style)\b[^>]*+>.*?</\1\s*+>|<!--.*?-->|<[^>]*+>", " "), r"&[#A-Za-z0-9]{1,9};", " ")


def _evidence(pages: DataFrame, langs: list[str], loglik: np.ndarray) -> DataFrame:
    host = F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*+://(?:[^/?#@]*+@)?([^/?#:]++)", 1))
    code = F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*+://[^/?#]++/([A-Za-z]{2})(?:[/?#]|$)", 1))
    said = F.lower(F.regexp_extract("html", r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]+)", 1))
    known = F.array(*[F.lit(x) for x in langs])
    named = lambda c: F.when(F.array_contains(known, c), c).when(F.coalesce(c, F.lit("")) == "", "").otherwise("other")
    p = pages.select(
        "page_id", F.nullif(host, F.lit("")).alias("host"), F.nullif(F.regexp_extract(host, r"[^.]+\.[^.]+$", 0), F.lit("")).alias("domain"),
        named(said).alias("declared"), F.concat_ws("/", F.regexp_extract(host, r"[^.]+$", 0), named(code)).alias("suffix"), visible_text(F.col("html")).alias("text"),
    )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = np.zeros((b.num_rows, len(langs)))
            for i, text in enumerate(b.column(5).to_pylist()):
                x = bins_of(text)
                if len(x):
                    out[i] = loglik[:, x].mean(axis=1) * min(len(x), TRIGRAMS)
            out -= out.max(axis=1, keepdims=True)
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(list(out), pa.list_(pa.float64()))], ["page_id", "host", "domain", "declared", "suffix", "ll"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return p.mapInArrow(score, f"page_id {kind}, host string, domain string, declared string, suffix string, ll array<double>")


def _softmax(ll: Column) -> Column:
    top = F.array_max(ll)
    e = F.transform(ll, lambda x: F.exp(x - top))
    return F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda a, y: a + y))


def language(pages: DataFrame, docs: DataFrame, sample_rows: int = SAMPLE_ROWS, kappa: float = KAPPA) -> DataFrame:
    """One row per page row: page_id, lang, confidence, text_lang, declared, host.

    A null or empty text, markup or address is no evidence, and a page without any gets the corpus' prior.
    Without labelled documents there are no languages and ``lang`` is null. Columns page_id, url and html are read.
    """
    langs, loglik = fit(docs, sample_rows)
    kind = pages.schema["page_id"].dataType.simpleString()
    if not langs:
        return pages.select(F.col("page_id").cast(kind).alias("page_id"), *[F.lit(None).cast(t).alias(c) for c, t in (("lang", "string"), ("confidence", "double"), ("text_lang", "string"), ("declared", "string"), ("host", "string"))])
    m = len(langs)
    e = written(_evidence(pages, langs, loglik).withColumn("p", _softmax(F.col("ll"))), "evidence")
    parts = lambda alias="p": [F.sum(F.get("p", i)).alias(f"{alias}{i}") for i in range(m)]
    array = lambda alias: F.array(*[F.col(f"{alias}{i}") for i in range(m)])

    every = e.groupBy().agg(*parts("g")).select(F.transform(array("g"), lambda x: F.coalesce(x, F.lit(0.0)) + 1.0).alias("g"))  # one row
    g = every.first()["g"]
    share = F.array(*[F.lit(x / sum(g)) for x in g])
    total = F.array(*[F.lit(x) for x in g])

    def agreement(column: str) -> DataFrame:
        """log P(value | language), add-one smoothed; values are few: known languages, endings of addresses."""
        t = e.groupBy(column).agg(*parts("n"))
        return t.select(F.col(column).alias(f"_{column}"), F.transform(F.arrays_zip(array("n").alias("n"), total.alias("t")), lambda x: F.log((x["n"] + 0.5) / (x["t"] + 10.0))).alias(f"w_{column}"))

    hosts = e.where("host is not null").groupBy("host", "domain").agg(*parts("h"))
    domains = hosts.groupBy("domain").agg(*[F.sum(f"h{i}").alias(f"d{i}") for i in range(m)]).select(F.col("domain").alias("_d"), array("d").alias("nd"))
    hosts = hosts.select(F.col("host").alias("_host"), "domain", array("h").alias("nh")).join(domains, F.expr("domain <=> _d")).select("_host", "nh", "nd")
    e = e.join(hosts, F.expr("host = _host"), "left")
    e = e.join(agreement("declared"), F.expr("declared <=> _declared"), "left").join(agreement("suffix"), F.expr("suffix <=> _suffix"), "left")
    size = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    less = lambda a: F.transform(F.arrays_zip(F.col(a).alias("a"), F.col("p").alias("b")), lambda x: F.greatest(F.lit(0.0), x["a"] - x["b"]))
    smooth = lambda n, up: F.transform(F.arrays_zip(n.alias("n"), up.alias("u")), lambda x: (x["n"] + kappa * x["u"]) / (size(n) + kappa))
    e = e.withColumn("u", F.when(F.col("nd").isNull(), share).otherwise(smooth(less("nd"), share)))
    e = e.withColumn("prior", F.when(F.col("nh").isNull(), F.col("u")).otherwise(smooth(less("nh"), F.col("u"))))
    fused = F.transform(F.arrays_zip("ll", "w_declared", "w_suffix", "prior"), lambda x: x["ll"] + x["w_declared"] + x["w_suffix"] + F.log(x["prior"]))
    e = e.withColumn("q", _softmax(fused))
    name = lambda a: F.element_at(F.array(*[F.lit(x) for x in langs]), F.array_position(a, F.array_max(a)).cast("int"))
    return e.select("page_id", name(F.col("q")).alias("lang"), F.round(F.array_max("q"), 6).alias("confidence"), name(F.col("p")).alias("text_lang"), "declared", "host")
