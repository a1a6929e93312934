"""Mixing sources to target weights over packed fixed-length blocks.

Words of a source, documents in ascending id, are packed into blocks of ``block`` words. Output slots
are dealt to shards of ``shard`` slots; each shard draws its source counts multinomially (one
pseudorandom draw a slot). A source's k-th slot takes the block that a pseudorandom Feistel permutation
of the block indices, another one each time round, gives for k. Slots and blocks then join by index.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketlake.llm.common import WORD, shielded, written

BLOCK = 64
SHARD = 65_536
CELLS = 4_096
#: Rounds of the permutation, and how often an index that falls outside is sent on.
ROUNDS, WALK = 4, 24
_L = lambda v: F.lit(v).cast("bigint")


def sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, _th, size): words of each text, null text none; ``_th`` hashes the text."""
    return docs.select("doc_id", "source", F.xxhash64("text").alias("_th"), F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"))


def targets(sized: DataFrame, most: int = 3, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """(source, source_size, target): sources by code point, null last, weigh 1, 2, 3, repeating.

    Targets share the sum of all sizes by weight. A target above ``most`` times its source's size stops
    there and its excess is reshared by weight until none is above: with the ratios
    ``most * size / weight`` ascending, the sources that stop are a prefix.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    per = per.withColumn("_w", w).withColumn("_cap", F.col("source_size") * most)
    by_ratio = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    everyone = Window.partitionBy()
    left = F.sum("source_size").over(everyone) - F.coalesce(F.sum("_cap").over(by_ratio), _L(0))
    weight = F.sum("_w").over(everyone) - F.coalesce(F.sum("_w").over(by_ratio), _L(0))
    per = per.withColumn("_level", left / weight).withColumn("_stops", F.col("_w") * F.col("_level") >= F.col("_cap"))
    # Levels fall from the first source that does not stop on; its level holds for all after it.
    level = F.max(F.when(~F.col("_stops"), F.col("_level"))).over(everyone)
    target = F.when(F.col("_stops"), F.col("_cap").cast("double")).otherwise(F.col("_w") * level)
    return per.select("source", "source_size", target.alias("target"))


def packed(sized: DataFrame, block: int = BLOCK) -> DataFrame:
    """(doc_id, source, _th, size, start, block, words): the blocks each document's words lie in, and how many lie there.

    Documents of a source follow each other in ascending id, null ids first, equal ids by a hash of their
    texts. All rows are range-partitioned in that order, so a source with a large share of all rows, or ids of any kind, is
    spread over tasks; a document's offset is the sum of the partitions before and the sum within its own. Documents
    without words lie in no block.
    """
    order = ["source", "doc_id", "_th"]
    rows = sized.where("size > 0").repartitionByRange(*order).sortWithinPartitions(*order)
    # Range borders are sampled: the rows are stored once, so that sums and offsets know the same partitions.
    rows = written(rows.withColumn("_run", F.spark_partition_id()), "runs")
    runs = rows.groupBy("source", "_run").agg(F.sum("size").alias("_n"))
    before = Window.partitionBy("source").orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(F.col("source").alias("_s"), F.col("_run").alias("_r"), F.coalesce(F.sum("_n").over(before), _L(0)).alias("_off"))
    within = Window.partitionBy("source", "_run").orderBy("doc_id", "_th").rowsBetween(Window.unboundedPreceding, -1)
    at = rows.withColumn("_in", F.coalesce(F.sum("size").over(within), _L(0))).join(runs, F.expr("source <=> _s and _run = _r"))
    at = at.select("doc_id", "source", "_th", "size", (F.col("_off") + F.col("_in")).alias("start"))
    first, last = F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block)
    one = at.withColumn("block", F.explode(F.sequence(first, last)))
    words = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block) - F.greatest("start", F.col("block") * block)
    return one.select("doc_id", "source", "_th", "size", "start", "block", words.cast("bigint").alias("words"))


def _intervals(wanted: DataFrame) -> DataFrame:
    """(cell, source, lo, hi): each source's share of [0, 1), cut at the borders of ``CELLS`` cells."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    total = F.sum("slots").over(Window.partitionBy())
    cum = wanted.where("slots > 0").withColumn("_hi", F.sum("slots").over(order)).withColumn("lo", (F.col("_hi") - F.col("slots")) / total).withColumn("hi", F.col("_hi") / total)
    last = F.least(F.floor(F.col("hi") * CELLS), _L(CELLS - 1))
    return cum.select("source", "lo", "hi", F.explode(F.sequence(F.floor(F.col("lo") * CELLS), last)).alias("cell"))


def deal(wanted: DataFrame, total: int, shard: int = SHARD, seed: int = 0) -> DataFrame:
    """(shard, slot, source, k): the source of every output slot, and the slot's place among its source's.

    Each shard's counts are multinomial. Over all shards a source's draws miss its number of slots by
    about a square root: draws beyond it are taken back, and missing ones follow in a last shard -1.
    """
    spark = wanted.sparkSession
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), "id"), 11).cast("double") / float(1 << 53))
    drawn = spark.range(total).select(F.floor(F.col("id") / shard).alias("shard"), F.col("id").alias("slot"), u.alias("_u")).withColumn("cell", F.floor(F.col("_u") * CELLS))
    drawn = drawn.join(_intervals(wanted), "cell").where("_u >= lo and _u < hi").select("shard", "slot", "source")
    counts = drawn.groupBy("source", "shard").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("source").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    counts = written(counts.withColumn("_off", F.coalesce(F.sum("_n").over(before), _L(0))), "draws")
    c, d, w = counts.select(F.col("source").alias("_s"), F.col("shard").alias("_h"), "_off"), drawn, wanted.select(F.col("source").alias("_t"), "slots")
    place = F.row_number().over(Window.partitionBy("source", "shard").orderBy("slot")) - 1
    dealt = d.withColumn("_place", place).join(c, F.expr("source <=> _s and shard = _h")).withColumn("k", F.col("_off") + F.col("_place"))
    dealt = dealt.join(w, F.expr("source <=> _t")).where("k < slots").select("shard", "slot", "source", "k")
    have = counts.groupBy("source").agg(F.sum("_n").alias("_have")).select(F.col("source").alias("_s"), "_have")
    short = wanted.join(have, F.expr("source <=> _s"), "left").withColumn("_have", F.coalesce("_have", _L(0))).where("_have < slots")
    more = short.select(_L(-1).alias("shard"), _L(None).alias("slot"), "source", F.explode(F.sequence(F.col("_have"), F.col("slots") - 1)).alias("k"))
    return dealt.unionByName(more)


def permuted(source: Column, k: Column, n: Column) -> Column:
    """The block of a source's k-th slot: each turn of ``n`` slots visits every block once, in an order of its own.

    An index is a pair of numbers below ``a`` and ``b``, ``a * b`` being the least product from ``n`` on with ``a`` the
    root of ``n`` rounded up; each round adds a hash of one number to the other, which can be undone, so pairs are
    permuted. A pair beyond ``n`` is permuted again until it falls inside. There are fewer than ``a`` such pairs, so
    that ``WALK`` times are always enough below ``WALK``^2 blocks, and miss with a chance below ``WALK``^-``WALK`` above.
    Nothing is multiplied that could overflow.
    """
    turn = F.floor(k / n)
    a = F.ceil(F.sqrt(n.cast("double"))).cast("bigint")
    b = F.floor((n + a - 1) / a).cast("bigint")

    def shuffled(i: Column) -> Column:
        # A lambda over a one-element array names the pair, so that each round computes it once.
        state = F.struct(F.floor(i / b).cast("bigint").alias("x"), F.pmod(i, b).alias("y"))
        for r in range(ROUNDS):
            left = lambda s, r=r: F.struct(F.pmod(s["x"] + F.pmod(F.xxhash64(source, turn, s["y"], F.lit(2 * r)), a), a).alias("x"), s["y"].alias("y"))
            right = lambda s, r=r: F.struct(s["x"].alias("x"), F.pmod(s["y"] + F.pmod(F.xxhash64(source, turn, s["x"], F.lit(2 * r + 1)), b), b).alias("y"))
            state = F.element_at(F.transform(F.transform(F.array(state), left), right), 1)
        return F.element_at(F.transform(F.array(state), lambda s: s["x"] * b + s["y"]), 1)

    first = shuffled(F.pmod(k, n))
    return F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), first, lambda at, _: F.when(at < n, at).otherwise(shuffled(at)))


def plan(docs: DataFrame, block: int = BLOCK, most: int = 3) -> tuple[DataFrame, DataFrame]:
    """(sized, wanted): sizes of the documents, and for each source its target in words, slots and number of blocks."""
    sized = written(sizes(docs), "sizes")
    n = F.ceil(F.col("source_size") / block)
    slots = F.when(F.col("source_size") == 0, _L(0)).otherwise(F.least(F.round(F.col("target") * n / F.col("source_size")).cast("bigint"), n * most))
    return sized, written(targets(sized, most).withColumn("n_blocks", n).withColumn("slots", slots), "targets")


def mixed_blocks(wanted: DataFrame, shard: int = SHARD, seed: int = 0) -> DataFrame:
    """(shard, slot, source, k, block): the block index that fills each output slot."""
    total = wanted.agg(F.sum("slots")).first()[0] or 0
    n = wanted.select(F.col("source").alias("_b"), "n_blocks")
    dealt = deal(wanted, total, shard, seed).join(n, F.expr("source <=> _b"))
    return dealt.select("shard", "slot", "source", "k", permuted(F.col("source"), F.col("k"), F.col("n_blocks")).alias("block"))


def _pieces(sized: DataFrame, wanted: DataFrame, block: int, shard: int, seed: int) -> DataFrame:
    """Blocks of the documents, joined by index with how many slots hold each; ``_times`` is null for none."""
    times = mixed_blocks(wanted, shard, seed).groupBy(F.col("source").alias("_s"), F.col("block").alias("_b")).agg(F.count("*").alias("_times"))
    return packed(sized, block).join(times, F.expr("source <=> _s and block = _b"), "left")


def mixed_documents(docs: DataFrame, block: int = BLOCK, shard: int = SHARD, most: int = 3, seed: int = 0) -> DataFrame:
    """The mix as rows with the columns of ``docs``: each document's words in the blocks taken, with their gaps.

    The n-th row of a document holds the blocks that n slots or more hold; ``n_chars``, where there is one,
    counts anew. Documents of which nothing is taken, and those without words, are not in the mix.
    """
    sized, wanted = plan(docs, block, most)
    got = _pieces(sized, wanted, block, shard, seed).where("_times is not null")
    first = F.greatest("start", F.col("block") * block) - F.col("start")
    got = got.select("doc_id", "_th", "start", F.explode(F.sequence(_L(1), F.col("_times"))).alias("_copy"), F.struct(first.cast("int").alias("at"), F.col("words").cast("int").alias("n")).alias("_r"))
    rows = got.groupBy(F.col("doc_id").alias("_id"), F.col("_th").alias("_t"), "start", "_copy").agg(F.sort_array(F.collect_list("_r")).alias("_ranges"))
    same = sized.groupBy("doc_id", "_th").agg(F.count("*").alias("_n")).where("_n > 1").select(F.col("doc_id").alias("_i"), F.col("_th").alias("_h"))
    same = written(same, "repeated")
    own, named = shielded(docs, "doc_id", "source", "text", "n_chars")
    once = own
    if same.count():  # rows of repeated documents are in ``rows`` one by one; their text is taken from one of them
        on = F.expr("doc_id <=> _i and xxhash64(text) = _h")
        again = own.join(same, on, "left_semi").withColumn("_h", F.xxhash64("text")).dropDuplicates(["doc_id", "_h"]).drop("_h")
        once = own.join(same, on, "left_anti").unionByName(again)
    words = F.regexp_extract_all("text", F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), 0)
    cut = F.element_at(F.transform(F.array(words), lambda w: F.transform("_ranges", lambda r: F.array_join(F.slice(w, r["at"] + 1, r["n"]), ""))), 1)
    mixed = once.join(rows, F.expr("doc_id <=> _id and xxhash64(text) = _t")).withColumn("text", F.array_join(cut, ""))
    if "n_chars" in docs.columns:
        mixed = mixed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return named(mixed)


def taken(docs: DataFrame, block: int = BLOCK, shard: int = SHARD, most: int = 3, seed: int = 0) -> DataFrame:
    """One row per document row: doc_id, size, source_size, target, taken (words in the mix, with repeats), source.

    Null or empty text has size 0 and is never taken; a null source is a source of its own; repeated
    rows are documents of their own; a source without words has target 0. Only doc_id, source and
    text are read. The result depends on rows and seed alone, not on partitions.
    """
    sized, wanted = plan(docs, block, most)
    full = _pieces(sized, wanted, block, shard, seed).groupBy("doc_id", "source", "size", "start").agg(F.sum(F.col("words") * F.coalesce("_times", _L(0))).alias("taken")).drop("start")
    every = full.unionByName(sized.where("size = 0").drop("_th").withColumn("taken", _L(0)))
    w = wanted.select(F.col("source").alias("_s"), "source_size", "target")
    return every.join(w, F.expr("source <=> _s")).select("doc_id", "size", "source_size", "target", "taken", "source")
