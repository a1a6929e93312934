"""Spelling variants by a dictionary of trie-node pairs.

The words fill two tries, one forward and one of the reversed words, whose nodes are numbered. A word that is cut at
a place is a pair of integers: the node of what stands before and the node of what follows. Leaving out the
character at the place gives another pair, with the node one step further on. Two words differ by one replaced
character exactly if they have a pair with the same place left out in common, and by one inserted character
exactly if the longer one's pair with a place left out is a cut of the shorter one. Nothing is compared as text.

Words that share such a pair have one free character, so a group holds no more words than the alphabet has
characters, 90 after lower-casing A-Z, and the one word without it, whatever the corpus. Of each group only one
row a word goes on, with the number and the best of its near words in it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlake.llm.common import lower_ascii, written

LETTER = "[A-Za-zÀ-ÿ]"
MIN_CHARS, MIN_COUNT = 6, 5
#: A form is at least so many times as frequent as its variant.
RATIO = 5
#: Every so many-th run loses a character: fixed value of the contract.
DAMAGE = 199


def _without(word: Column, at: Column) -> Column:
    """``word`` without the code point at ``at`` (from 0)."""
    return F.concat(F.left(word, at), F.substr(word, at + 2))


def runs(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, run): every maximal run of letters of at least ``min_chars``, A-Z lower-cased; null text has none."""
    own = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(f"{LETTER}{{{min_chars},}}"), 0)).alias("run"))
    return own.withColumn("run", F.when(F.col("run").rlike("[A-Z]"), lower_ascii(F.col("run"))).otherwise(F.col("run")))


def damaged(rows: DataFrame, every: int = DAMAGE) -> DataFrame:
    """(word): the runs, those whose crc32 of ``doc_id:run`` ``every`` divides without one code point. A null id counts as empty."""
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run")).cast("binary"))
    at = F.pmod(F.col("_h"), F.length("run")).cast("int")
    return rows.withColumn("_h", h).select(F.when(F.col("_h") % every == 0, _without(F.col("run"), at)).otherwise(F.col("run")).alias("word"))


def vocabulary(words: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): distinct words of at least ``min_chars`` code points that occur ``min_count`` times, over all rows."""
    return words.where(F.length("word") >= min_chars).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def _nodes(parts: DataFrame, order: Column, name: str) -> DataFrame:
    """(part, id): the trie's nodes numbered in preorder, which is the sorted order of what leads to them."""
    return written(parts.distinct().orderBy(order).select("part", F.monotonically_increasing_id().alias("id")), name)


def near_words(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of distinct (word, n): (id, word, n), and (id, n_near, best) of the words that have near ones.

    ``best`` holds ``less``, the negated n, and ``id`` of the most frequent near word, ties by code points; ids
    rise with the words. Work and rows grow with the words' total length squared by word, as each part of
    a word is a node's text once.
    """
    places = words.select("word", "n", F.explode(F.sequence(F.lit(0), F.length("word"))).alias("at"))
    places = places.select("word", "n", "at", F.expr("left(word, at)").alias("before"), F.expr("substr(word, at + 1)").alias("after"))
    forward = _nodes(places.select(F.col("before").alias("part")), F.col("part"), "trie-forward")
    backward = _nodes(places.select(F.col("after").alias("part")), F.reverse("part"), "trie-backward")
    known = written(words.join(forward, F.expr("word = part")).select("id", "word", "n"), "spelling-ids")

    cut = places.join(known.select(F.col("id"), F.col("word").alias("_w")), F.expr("word = _w"))
    cut = cut.join(forward.select(F.col("part").alias("_p"), F.col("id").alias("prefix")), F.expr("before = _p"))
    # A place left out: what follows starts one character later. In a run of equal characters each gives the
    # same shorter word, so that only the first one meets it.
    out = F.struct(F.lit(False).alias("whole"), F.expr("substr(word, at + 2)").alias("after"), F.expr("at = 0 or substr(word, at, 1) <> substr(word, at + 1, 1)").alias("first"))
    own = F.struct(F.lit(True).alias("whole"), F.col("after"), F.lit(True).alias("first"))
    pairs = cut.select("prefix", "id", "n", F.explode(F.when(F.expr("at < length(word)"), F.array(own, out)).otherwise(F.array(own))).alias("_k"))
    pairs = pairs.select("prefix", "id", "n", "_k.*").join(backward.select(F.col("part").alias("_s"), F.col("id").alias("suffix")), F.expr("after = _s"))

    member = F.struct((-F.col("n")).alias("less"), "id", "whole", "first")
    groups = pairs.groupBy("prefix", "suffix").agg(F.sort_array(F.collect_list(member)).alias("all")).where("size(all) > 1")
    groups = groups.select(F.filter("all", lambda m: ~m["whole"]).alias("out"), F.filter("all", lambda m: ~m["whole"] & m["first"]).alias("firsts"), F.filter("all", lambda m: m["whole"]).alias("cut"))
    pick = lambda m: F.struct(m["less"].alias("less"), m["id"].alias("id"))
    best = lambda *of: F.array_min(F.filter(F.array(*of), lambda x: x["id"].isNotNull()))
    at = lambda rows, i: F.get(rows, F.lit(i))
    of_out = F.transform("out", lambda m: F.struct(
        m["id"].alias("id"), (F.size("out") - 1 + F.when(m["first"], F.size("cut")).otherwise(0)).alias("n_near"),
        best(pick(F.when(at("out", 0)["id"] == m["id"], at("out", 1)).otherwise(at("out", 0))), pick(F.when(m["first"], at("cut", 0)))).alias("best"),
    ))
    of_cut = F.transform("cut", lambda m: F.struct(m["id"].alias("id"), F.size("firsts").alias("n_near"), best(pick(at("firsts", 0))).alias("best")))
    found = groups.select(F.explode(F.concat(of_out, of_cut)).alias("_m")).select("_m.*").where("n_near > 0")
    return known, found.groupBy("id").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def _roots(forms: DataFrame) -> DataFrame:
    """(id, root) of (id, form): forms followed to the last, by jumping twice as far each round.

    Each step multiplies n by ``RATIO`` at least, so a chain of 64-bit counts ends after 27 steps and five rounds.
    """
    now = written(forms.select("id", F.col("form").alias("root")), "spelling-roots")
    while True:
        on = now.select(F.col("id").alias("_i"), F.col("root").alias("_r"))
        jumped = written(now.join(on, F.expr("root = _i"), "left").select("id", F.coalesce("_r", "root").alias("root"), F.col("_r").isNotNull().alias("moved")), "spelling-roots")
        if not jumped.where("moved").count():
            return jumped.drop("moved")
        now = jumped.drop("moved")


def spelling_forms(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n for each of the distinct (word, n).

    Near words differ by one inserted, deleted or replaced code point. A form is the most frequent near word, ties by
    code points, if it occurs ``ratio`` times as often as the word; the root is the last form of the chain, the
    word itself if it has none.
    """
    known, near = near_words(words)
    near = written(near, "spelling-near")
    rows = known.join(near.withColumnRenamed("id", "_id"), F.expr("id = _id"), "left")
    form = F.when(-F.col("best.less") >= ratio * F.col("n"), F.col("best.id"))
    rows = written(rows.select("id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), form.alias("form_id")), "spelling-forms")
    roots = _roots(rows.where("form_id is not null").select("id", F.col("form_id").alias("form")))
    name = lambda c: known.select(F.col("id").alias(f"_{c}"), F.col("word").alias(c), F.col("n").alias(f"{c}_n"))
    led = roots.join(name("root_word"), F.expr("root = _root_word")).select(F.col("id").alias("_k"), F.col("root_word"))
    full = rows.join(name("form"), F.expr("form_id = _form"), "left").join(led, F.expr("id = _k"), "left")
    return full.select("word", "form", F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n")


def variants(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, ratio: int = RATIO, damage: int = DAMAGE) -> DataFrame:
    """The spelling forms of the words of ``docs``: one row a word, by :func:`spelling_forms`.

    Words are runs of letters up to U+00FF of whole texts, after the contract's damage. Null, empty and letterless
    texts have none; a null id counts as empty in the damage; repeated rows count each time. A word of any
    length is kept whole. Only doc_id and text are read; without words the result is empty.
    """
    return spelling_forms(written(vocabulary(damaged(runs(docs, min_chars), damage), min_chars, min_count), "spelling-words"), ratio)
