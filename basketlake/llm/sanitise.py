"""Information-theoretic sanitisation of personal data.

Base spans are the protected entities: e-mail and IP addresses, card and phone numbers. Corpus
co-occurrence then tells how strongly words reveal them: a term discloses an entity if at least ``support`` different
whole texts hold both, these documents are at least ``certainty`` of all with the term, and the pair's pointwise
mutual information is ``bits`` or more. Every occurrence of a disclosing term, in any text and at any distance,
becomes a span of kind ``term``. Spans are generalised to a class name, or removed.

Positions are not given by Spark's regular expressions; they are sums of the lengths of the matches and
of the pieces that splitting at the matches leaves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketlake.llm.common import lower_ascii, shielded, small, written

KINDS = ("email", "ip", "card", "phone", "term")
#: The contract's patterns. Runs are possessive and start where a run starts (or the last match ended),
#: which finds the same matches in linear time and constant stack.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold before its matches are looked for; matches that fail by length are left out here already.
HINTS = {"email": "@[A-Za-z0-9-]", "ip": r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]", "card": r"[0-9](?:[\x20-]?+[0-9]){13}", "phone": r"\+[0-9]"}
NOT_TERM = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
SUPPORT, CERTAINTY, BITS = 3, 0.5, 4.0
#: Terms, and keys of texts, up to this many rows and 64 MB are broadcast to the texts; beyond, they are joined by shuffle.
BROADCAST_TERMS = 1_000_000


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _valid(kind: str, s: Column) -> Column:
    n = F.length(_digits(s))
    if kind == "ip":
        part = lambda p: F.regexp_replace(p, "^0+", "")
        return F.forall(F.split(s, r"\."), lambda p: (F.length(part(p)) < 3) | ((F.length(part(p)) == 3) & (part(p) <= "255")))
    if kind == "card":
        return n.between(14, 19) & F.call_function("luhn_check", _digits(s))
    return n.between(10, 15) if kind == "phone" else F.lit(True)


def _placed(d: DataFrame, pattern: str) -> DataFrame:
    """(doc_id, _th, _i, gap, len, value): the matches of the pattern in the texts of (doc_id, _th, _text), and the gap before each."""
    pieces, matches = F.split("_text", pattern, -1), F.regexp_extract_all("_text", F.lit(pattern), 0)
    zipped = F.element_at(
        F.transform(
            F.array(F.struct(pieces.alias("p"), matches.alias("m"))),
            lambda x: F.transform(x["m"], lambda m, i: F.struct(F.length(F.get(x["p"], i)).alias("gap"), F.length(m).alias("len"), m.alias("value"))),
        ), 1,
    )
    return d.select("doc_id", "_th", F.posexplode(zipped).alias("_i", "_m")).select("doc_id", "_th", "_i", "_m.*")


def _ends(found: DataFrame, *by: str) -> DataFrame:
    """The matches with start and end in code points."""
    upto = Window.partitionBy("doc_id", "_th", *by).orderBy("_i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.col("len")).over(upto)
    return found.withColumn("end", end.cast("bigint")).withColumn("start", F.col("end") - F.col("len"))


def base_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, _th, kind, start, end, value): valid matches, in code points.

    ``_th`` hashes the text, so that repeated rows give their spans once.
    """
    d = docs.select("doc_id", F.xxhash64("text").alias("_th"), F.col("text").alias("_text"))
    found = None
    for kind, pattern in PATTERNS.items():
        rows = _placed(d.where(F.col("_text").rlike(HINTS[kind])), pattern).withColumn("kind", F.lit(kind))
        found = rows if found is None else found.unionByName(rows)
    found = _ends(found.dropDuplicates(["doc_id", "_th", "kind", "_i"]), "kind")
    ok = F.lit(False)
    for kind in PATTERNS:
        ok = F.when(F.col("kind") == kind, _valid(kind, F.col("value"))).otherwise(ok)
    return found.where(ok).select("doc_id", "_th", "kind", "start", "end", "value")


def _sent(df: DataFrame, rows: int, *texts: str) -> DataFrame:
    """A written table, broadcast if its size allows that."""
    return F.broadcast(df) if small(df, rows, *texts) else df


def disclosing_terms(docs: DataFrame, spans: DataFrame, support: int = SUPPORT, certainty: float = CERTAINTY, bits: float = BITS, broadcast_terms: int = BROADCAST_TERMS) -> DataFrame:
    """(doc_id, _th, kind, start, end): all occurrences of words that reveal an entity."""
    entity = F.xxhash64("kind", F.when(F.col("kind").isin("card", "phone"), _digits(F.col("value"))).otherwise(lower_ascii(F.col("value"))))
    of = written(spans.select(entity.alias("_e"), "_th", "doc_id").distinct(), "entities")
    # An entity of fewer texts than the support cannot have a pair. Support counts different texts, as copies are no
    # evidence; shares count documents.
    per = of.groupBy("_e", "_th").agg(F.count("*").alias("_n")).groupBy("_e").agg(F.count("*").alias("_texts"), F.sum("_n").alias("_n_e"))
    known = written(per.where(F.col("_texts") >= support).select("_e", "_n_e"), "known")
    carriers = written(of.join(known.select(F.col("_e").alias("_k")), F.expr("_e = _k"), "left_semi").groupBy(F.col("doc_id").alias("_id"), F.col("_th").alias("_t")).agg(F.collect_list("_e").alias("_es")), "carriers")
    inside = docs.where(F.col("text").isNotNull()).select("doc_id", F.xxhash64("text").alias("_th"), "text")
    here = inside.join(_sent(carriers, broadcast_terms), F.expr("doc_id <=> _id and _th = _t"))
    words = F.array_remove(F.array_distinct(F.split(lower_ascii(F.col("text")), NOT_TERM)), "")
    pairs = here.dropDuplicates(["doc_id", "_th"]).select("_th", F.explode("_es").alias("_e"), words.alias("_w")).select("_th", "_e", F.explode("_w").alias("term"))
    pairs = pairs.groupBy("_e", "term", "_th").agg(F.count("*").alias("_n"))
    pairs = pairs.groupBy("_e", "term").agg(F.count("*").alias("_texts"), F.sum("_n").alias("_n_et")).where(F.col("_texts") >= support)
    pairs = written(pairs, "pairs")
    terms = written(pairs.select("term").distinct(), "terms")
    every = docs.where(F.col("text").isNotNull()).select("doc_id", F.xxhash64("text").alias("_th"), F.explode(words).alias("term"))
    held = every.join(_sent(terms, broadcast_terms, "term"), "term", "left_semi")
    df = held.groupBy("term").agg(F.count("*").alias("_n_t"))
    n = docs.where(F.col("text").isNotNull()).count()
    pmi = F.log2(F.col("_n_et") * float(n) / (F.col("_n_e") * F.col("_n_t")))
    told = pairs.join(df, "term").join(known, "_e").where((F.col("_n_et") >= certainty * F.col("_n_t")) & (pmi >= bits))
    told = written(told.select("term").distinct(), "told")
    sent = _sent(told, broadcast_terms, "term")
    marked = every.join(sent, "term", "left_semi").groupBy(F.col("doc_id").alias("_id"), F.col("_th").alias("_t")).agg(F.collect_set("term").alias("_told"))
    marked = written(marked.withColumn("_joined", F.array_join("_told", " ")), "marked")
    keys = F.broadcast(marked) if small(marked, broadcast_terms, "_joined") else marked
    texts = inside.join(keys.drop("_joined"), F.expr("doc_id <=> _id and _th = _t")).select("doc_id", "_th", F.col("text").alias("_text"), "_told")
    # Places are summed up within the row, and only the disclosing words leave it.
    words = F.arrays_zip(F.split("_text", TERM, -1).alias("g"), F.regexp_extract_all("_text", F.lit(TERM), 0).alias("w"))
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")

    def step(state: Column, x: Column) -> Column:
        begin = state["at"] + F.length(x["g"])
        end = begin + F.coalesce(F.length(x["w"]), F.lit(0))
        told_here = F.coalesce(F.array_contains("_told", lower_ascii(x["w"])), F.lit(False))
        return F.struct(end.alias("at"), F.when(told_here, F.concat(state["out"], F.array(F.struct(begin.alias("start"), end.alias("end"))))).otherwise(state["out"]).alias("out"))

    start = F.struct(F.lit(0).cast("bigint").alias("at"), none.alias("out"))
    spans_of = F.aggregate(words, start, step, lambda state: state["out"])
    found = texts.select("doc_id", "_th", F.explode(spans_of).alias("_s")).select("doc_id", "_th", F.lit("term").alias("kind"), "_s.start", "_s.end")
    return found.distinct()


def all_spans(docs: DataFrame, support: int = SUPPORT, certainty: float = CERTAINTY, bits: float = BITS, broadcast_terms: int = BROADCAST_TERMS) -> DataFrame:
    """(doc_id, _th, _base, _all): for each text with spans its base and all spans as arrays of (start, rank of kind, end)."""
    base = written(base_spans(docs), "base")
    terms = disclosing_terms(docs, base, support, certainty, bits, broadcast_terms)
    both = base.select("doc_id", "_th", "kind", "start", "end").unionByName(terms)
    rank = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")).cast("int")
    is_term = len(KINDS)
    of = Window.partitionBy("doc_id", "_th").orderBy("start", "rank", "end")
    own = F.col("rank") < is_term
    # A term within a base span is none of its own: the base spans before it must have ended, and the next one not begun.
    reached = F.max(F.when(own, F.col("end"))).over(of.rowsBetween(Window.unboundedPreceding, 0))
    follows = F.min(F.when(own, F.col("start"))).over(of.rowsBetween(0, Window.unboundedFollowing))
    free = F.coalesce(reached <= F.col("start"), F.lit(True)) & F.coalesce(follows >= F.col("end"), F.lit(True))
    both = both.withColumn("rank", rank).withColumn("_free", own | free).where("_free")
    got = both.groupBy("doc_id", "_th").agg(F.sort_array(F.collect_list(F.struct("start", "rank", "end"))).alias("_all"))
    return got.withColumn("_base", F.filter("_all", lambda s: s["rank"] < is_term))


def _joined(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["rank"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def personal_data(docs: DataFrame, **rules) -> DataFrame:
    """One row per document row: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_term.

    Null and empty texts have no spans; repeated rows each get their row. Only doc_id and text are read.
    """
    found = all_spans(docs, **rules)
    count = lambda r: F.coalesce(F.size(F.filter("_base", lambda s: s["rank"] == r)), F.lit(0)).cast("bigint")
    none = F.array().cast("array<struct<start:bigint,rank:int,end:bigint>>")
    rows = docs.select("doc_id", F.xxhash64("text").alias("_t")).join(found.withColumnRenamed("doc_id", "_id"), F.expr("doc_id <=> _id and _t = _th"), "left")
    rows = rows.withColumn("_base", F.coalesce("_base", none)).withColumn("_all", F.coalesce("_all", none))
    return rows.select(
        "doc_id", *[count(i + 1).alias(f"n_{k}") for i, k in enumerate(PATTERNS)],
        F.sha2(_joined(F.col("_base")), 256).alias("base_sha256"), _joined(F.col("_all")).alias("spans"),
        (F.size("_all") - F.size("_base")).cast("bigint").alias("n_term"),
    )


def sanitise(docs: DataFrame, generalise: bool = True, **rules) -> DataFrame:
    """``docs`` with every span replaced by its class, as in ``[EMAIL]``, or cut out; overlapping spans go as one."""
    found = all_spans(docs, **rules).select(F.col("doc_id").alias("_id"), "_th", "_all")
    names = F.array(*[F.lit(f"[{k.upper()}]" if generalise else "") for k in KINDS])
    own, named = shielded(docs, "doc_id", "text")
    rows = own.join(found, F.expr("doc_id <=> _id and xxhash64(text) = _th"), "left")
    done = F.aggregate(
        "_all", F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out")),
        lambda a, s: F.when(s["start"] < a["at"], F.struct(F.greatest(a["at"], s["end"]).alias("at"), a["out"].alias("out"))).otherwise(
            F.struct(s["end"].alias("at"), F.concat(a["out"], F.substring("text", (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int")), F.element_at(names, s["rank"])).alias("out"))
        ),
        lambda a: F.concat(a["out"], F.substring("text", (a["at"] + 1).cast("int"), F.length("text"))),
    )
    return named(rows.withColumn("text", F.when(F.col("_all").isNull(), F.col("text")).otherwise(done)))
