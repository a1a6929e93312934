"""Benchmark decontamination: hash set of benchmark windows, probed by the windows of the documents.

A window is ``window`` consecutive words of an item (a shorter item is one window). The set of windows
is broadcast while it holds no more than ``broadcast_windows`` rows. Beyond, hashes of the windows are
joined by a shuffle, and every hash hit is verified on the words themselves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlake.llm.common import lower_ascii, shielded, small, words_of, written

#: Everything that is neither an ASCII letter or digit nor above ASCII parts words.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 13
#: At 100 bytes a row the broadcast set stays below about 200 MB.
BROADCAST_WINDOWS = 2_000_000


def _words(text):
    return words_of(lower_ascii(text), GAP)


def _windows(words, length: int, make):
    """``make(slice, position)`` for each window of ``length`` words; the words are bound once, as a slice of a row's array would copy it all."""
    starts = lambda w: F.when(F.size(w) >= length, F.sequence(F.lit(1), F.size(w) - (length - 1))).otherwise(F.array().cast("array<int>"))
    return F.element_at(F.transform(F.array(words), lambda w: F.transform(starts(w), lambda i: make(F.slice(w, i, length), i))), 1)


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item_id, len, phrase): the distinct windows of every item; items without words have none."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), _words(F.col("text")).alias("_w")).where(F.size("_w") > 0)
    whole = items.where(F.size("_w") < window).select("item_id", F.size("_w").alias("len"), F.concat_ws(" ", "_w").alias("phrase"))
    cut = items.where(F.size("_w") >= window).select("item_id", F.explode(_windows(F.col("_w"), window, lambda s, i: F.concat_ws(" ", s))).alias("phrase"))
    return whole.unionByName(cut.select("item_id", F.lit(window).alias("len"), "phrase")).distinct()


def _keyed(docs: DataFrame):
    return docs.select("doc_id", F.xxhash64("text").alias("_th"), F.col("text").alias("_text"))


def find_hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """(doc_id, _th, pos, len, item_id): every occurrence of a benchmark window, positions in words from 1."""
    bench = written(benchmark_windows(benchmark, window), "bench")
    lengths = sorted(r[0] for r in bench.select("len").distinct().collect())
    if small(bench, broadcast_windows, "item_id", "phrase"):
        # The set holds the windows' own words, so a hit is verified as it is found.
        found = None
        for n in lengths:
            spans = _keyed(docs).select("doc_id", "_th", F.posexplode(_windows(_words(F.col("_text")), n, lambda s, i: F.concat_ws(" ", s))).alias("_p", "phrase"))
            here = spans.join(F.broadcast(bench.where(F.col("len") == n).drop("len")), "phrase").select("doc_id", "_th", (F.col("_p") + 1).alias("pos"), F.lit(n).alias("len"), "item_id")
            found = here if found is None else found.unionByName(here)
        if found is not None:
            return found.distinct()
    keys = bench.select("len", F.xxhash64(F.split("phrase", " ")).alias("_h")).distinct()
    found = None
    for n in lengths:
        hashes = _keyed(docs).select("doc_id", "_th", F.posexplode(_windows(_words(F.col("_text")), n, lambda s, i: F.xxhash64(s))).alias("_p", "_h"))
        here = hashes.join(keys.where(F.col("len") == n).select("_h"), "_h", "left_semi").select("doc_id", "_th", (F.col("_p") + 1).alias("pos"), F.lit(n).alias("len"))
        found = here if found is None else found.unionByName(here)
    if found is None:
        return docs.sparkSession.createDataFrame([], f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, _th bigint, pos int, len int, item_id string")
    found = written(found.distinct().groupBy("doc_id", "_th").agg(F.collect_list(F.struct("pos", "len")).alias("_hits")), "hits")
    phrases = F.element_at(
        F.transform(F.array(_words(F.col("_text"))), lambda w: F.transform("_hits", lambda x: F.struct(x["pos"].alias("pos"), x["len"].alias("len"), F.concat_ws(" ", F.slice(w, x["pos"], x["len"])).alias("phrase")))), 1
    )
    d, f = _keyed(docs).alias("d"), found.alias("f")
    marks = d.join(f, F.expr("d.doc_id <=> f.doc_id and d._th = f._th")).select("d.doc_id", "d._th", F.explode(phrases).alias("_m")).select("doc_id", "_th", "_m.pos", "_m.len", "_m.phrase")
    return marks.join(bench, ["len", "phrase"]).select("doc_id", "_th", "pos", "len", "item_id").distinct()


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = 20, broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """One row per document row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    Contaminated: at least one word in ``share`` words is hit. Null or empty text has no words and
    is clean; an empty benchmark leaves every document clean; repeated rows each get their row; an
    item with a null id hits words but is in no list. Only doc_id and text are read.
    """
    return _judged(docs, benchmark, window, share, broadcast_windows).drop("_t")


def _judged(docs: DataFrame, benchmark: DataFrame, window: int, share: int, broadcast_windows: int) -> DataFrame:
    """The rows of ``contamination``, and _t, the hash of the row's text: an id alone may stand for several texts."""
    per_doc = (
        find_hits(docs, benchmark, window, broadcast_windows)
        .groupBy("doc_id", "_th")
        .agg(F.sort_array(F.collect_set(F.struct("pos", "len"))).alias("_at"), F.sort_array(F.collect_set("item_id")).alias("_items"))
        .select(
            F.col("doc_id").alias("_id"), "_th",
            F.aggregate(
                "_at", F.struct(F.lit(0).alias("end"), F.lit(0).cast("bigint").alias("n")),
                lambda a, x: F.struct(
                    F.greatest(a["end"], x["pos"] + x["len"]).alias("end"),
                    (a["n"] + F.greatest(F.lit(0), x["pos"] + x["len"] - F.greatest(a["end"], x["pos"]))).alias("n"),
                ),
                lambda a: a["n"],
            ).alias("_hit"),
            F.size("_items").cast("bigint").alias("_n"), F.sha2(F.concat_ws(",", "_items"), 256).alias("_sha"),
        )
    )
    every = docs.select("doc_id", F.xxhash64("text").alias("_t"), F.size(_words(F.col("text"))).cast("bigint").alias("n_words"))
    n_hit = F.coalesce("_hit", F.lit(0).cast("bigint"))
    return every.join(per_doc, F.expr("doc_id <=> _id and _t = _th"), "left").select(
        "doc_id", "_t", "n_words", n_hit.alias("n_hit"), F.coalesce("_n", F.lit(0).cast("bigint")).alias("n_items"),
        F.coalesce("_sha", F.sha2(F.lit(""), 256)).alias("items_sha256"), ((n_hit > 0) & (n_hit * share >= F.col("n_words"))).alias("contaminated"),
    )


def remove_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = 20) -> DataFrame:
    """``docs`` without the contaminated ones, all columns kept."""
    bad = _judged(docs, benchmark, window, share, BROADCAST_WINDOWS).where("contaminated").select(F.col("doc_id").alias("_bad"), F.col("_t").alias("_bt")).distinct()
    bad = written(bad, "contaminated")
    rows, named = shielded(docs, "doc_id", "text")
    return named(rows.join(bad, F.expr("doc_id <=> _bad and xxhash64(text) = _bt"), "left_anti"))


def remove_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with hit words, and the gap after each, cut out of the text."""
    hits = find_hits(docs, benchmark, window).groupBy("doc_id", "_th").agg(
        F.array_distinct(F.flatten(F.collect_set(F.sequence("pos", F.col("pos") + F.col("len") - 1)))).alias("_cut")
    )
    hits = written(hits.withColumnRenamed("doc_id", "_id"), "cuts")
    gap = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"  # capitals belong to words here
    parts, lead = rf"[^{gap}]+[{gap}]*", F.regexp_extract("text", f"^[{gap}]*", 0)
    pieces = F.regexp_extract_all("text", F.lit(parts), F.lit(0))
    kept = F.transform(F.array_except(F.sequence(F.lit(1), F.size(pieces)), "_cut"), lambda i: F.element_at(pieces, i))
    rows, named = shielded(docs, "doc_id", "text")
    joined = rows.join(hits, F.expr("doc_id <=> _id and xxhash64(text) = _th"), "left")
    return named(joined.withColumn("text", F.when(F.col("_cut").isNull(), F.col("text")).otherwise(F.concat(lead, F.array_join(kept, "")))))


SQL = r"""
with dw as (
  select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w from documents),
bw as (
  select item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w from benchmark),
b as (
  select distinct cast(item_id as varchar) as item_id, least(13, len(w)) as n, unnest(list_transform(range(1, len(w) - least(13, len(w)) + 2), lambda i: array_to_string(w[i : i + least(13, len(w)) - 1], ' '))) as phrase
  from bw where len(w) > 0),
lens as (select distinct n from b),
d as (
  select doc_id, n, unnest(range(1, len(w) - n + 2)) as pos, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i : i + n - 1], ' '))) as phrase
  from dw, lens where len(w) >= n),
hit as (select doc_id, pos, d.n, item_id from d join b on d.n = b.n and d.phrase = b.phrase),
cov as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(pos, pos + n)) as p from hit) group by doc_id),
it as (select doc_id, count(distinct item_id) as n_items, sha256(string_agg(distinct item_id, ',' order by item_id)) as sha from hit group by doc_id)
select dw.doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  coalesce(sha, sha256('')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from dw left join cov on dw.doc_id = cov.doc_id left join it on dw.doc_id = it.doc_id
"""
