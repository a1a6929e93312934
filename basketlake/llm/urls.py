"""URL filters: a weighted vocabulary found by Aho-Corasick, and host and path rules before it.

All terms are looked for in one pass over the lower-cased URL. An occurrence counts only if it stands alone: the
characters beside it are neither ASCII letters nor digits nor beyond ASCII. Each distinct term found adds its
weight; a strict term's weight reaches the limit alone, soft terms need several distinct ones. A rule that
fits the URL decides in place of the vocabulary.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlake.llm.common import UPPER, lower_ascii

#: Distinct weight from which a URL is blocked.
LIMIT = 2
STRICT = ("adult", "hentai", "phishing", "porn", "spam", "warez", "xxx")
SOFT = ("ads", "bet", "bets", "casino", "cheap", "click", "discount", "free", "loan", "lottery", "pills", "poker", "prize", "replica", "sale", "track", "viagra", "win")
VOCABULARY = {t: LIMIT for t in STRICT} | {t: 1 for t in SOFT}
#: Fixed values of the contract: (verdict, host, path).
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
_LOWER = str.maketrans(UPPER, UPPER.lower())


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return lower_ascii(F.coalesce(F.regexp_extract(_after(url), "^[^/?#]*", 0), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_after(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def _after(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substr(url, at + 3))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule whose host is the URL's or a parent domain, and whose path begins the URL's.

    The rules are literals of the plan, a list for people to write. Of equally long rules the later one in code points wins.
    """
    fits = [
        F.when(((host == h) | F.endswith(host, F.lit(f".{h}"))) & F.startswith(path, F.lit(p)), F.struct(F.lit(len(h + p)).alias("n"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")))
        for v, h, p in rules
    ]
    none = F.lit(None).cast("struct<n:int,rule:string,verdict:string>")
    best = F.array_max(F.array(none, *fits)) if fits else none
    return best["rule"], best["verdict"]


def _alone(text: str, start: int, end: int) -> bool:
    for c in (text[start - 1 : start], text[end : end + 1]):
        if c.isalnum() or c > "\x7f":
            return False
    return True


def hits(text: str | None, found: ahocorasick.Automaton) -> dict[str, int]:
    """How often each term of the automaton stands alone in the lower-cased text."""
    counts: dict[str, int] = {}
    if text:
        text = text.lower() if text.isascii() else text.translate(_LOWER)
        for last, term in found.iter(text):
            if _alone(text, last + 1 - len(term), last + 1):
                counts[term] = counts.get(term, 0) + 1
    return counts


def automaton(terms: Sequence[str]) -> ahocorasick.Automaton:
    made = ahocorasick.Automaton()
    for t in terms:
        made.add_word(t, t)
    made.make_automaton()
    return made


def _scorer(vocabulary: dict[str, int], limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = automaton(list(vocabulary)) if vocabulary else None
        for b in batches:
            rows = [hits(u, found) if found else {} for u in b.column(1).to_pylist()]
            strict = [sum(n for t, n in r.items() if vocabulary[t] >= limit) for r in rows]
            soft = [sum(n for t, n in r.items() if vocabulary[t] < limit) for r in rows]
            weight = [sum(vocabulary[t] for t in r) for r in rows]
            terms = [",".join(sorted(r)) for r in rows]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(strict, pa.int64()), pa.array(soft, pa.int64()), pa.array(weight, pa.int64()), pa.array(terms, pa.string())],
                ["page_id", "url", "strict_hits", "soft_hits", "weight", "terms"],
            )

    return run


def judge(pages: DataFrame, vocabulary: dict[str, int] = VOCABULARY, limit: int = LIMIT, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict, and what the vocabulary found.

    ``strict_hits`` and ``soft_hits`` count occurrences, ``terms`` names the distinct terms found and ``weight`` sums
    theirs; a URL without a rule is blocked from weight ``limit`` on. A null or empty URL, or one without ``://``,
    has empty host and path, fits no rule, and its text is judged by the vocabulary all the same. Ids may be null
    or repeat. Only page_id and url are read. Terms are lower-case; the URL's escapes are not decoded.
    """
    kind = pages.schema["page_id"].dataType.simpleString()
    scored = pages.select("page_id", "url").mapInArrow(_scorer(vocabulary, limit), f"page_id {kind}, url string, strict_hits bigint, soft_hits bigint, weight bigint, terms string")
    named = scored.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "strict_hits", "soft_hits", "weight", "terms")
    rule, ruled = rule_of(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("weight") >= limit, "block").otherwise("allow")
    return named.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(ruled, own).alias("verdict"), "strict_hits", "soft_hits", "weight", "terms")


def keep_allowed(pages: DataFrame, vocabulary: dict[str, int] = VOCABULARY, limit: int = LIMIT, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """``pages`` whose URL is allowed, with all columns; equal URLs are judged once."""
    judged = judge(pages.select(F.col("url").alias("page_id"), "url").distinct(), vocabulary, limit, rules)
    blocked = judged.where("verdict = 'block'").select(F.col("page_id").alias("_blocked_url"))
    return pages.join(blocked, F.col("url") == F.col("_blocked_url"), "left_anti")


def _sql() -> str:
    apart = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
    terms = ", ".join(f"{{'t': '{t}', 'w': {w}, 'n': len(regexp_extract_all(u, '(?:^|{apart}){t}(?:{apart}|$)'))}}" for t, w in sorted(VOCABULARY.items()))
    fits = " ".join(f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{h}{p}'" for _, h, p in sorted(RULES, key=lambda r: -len(r[1] + r[2])))
    says = " ".join(f"WHEN '{h}{p}' THEN '{v}'" for v, h, p in RULES)
    return rf"""
    WITH a AS (SELECT page_id, url, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
    b AS (
        SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{UPPER.lower()}') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
            regexp_replace(coalesce(translate(url, '{UPPER}', '{UPPER.lower()}'), ''), '({apart})', '\1\1', 'g') AS u FROM a
    ),
    c AS (SELECT page_id, host, path, CASE {fits} END AS rule, [x for x in [{terms}] if x.n > 0] AS found FROM b),
    d AS (
        SELECT page_id, host, path, rule,
            CAST(coalesce(list_sum([x.n for x in found if x.w >= {LIMIT}]), 0) AS BIGINT) AS strict_hits,
            CAST(coalesce(list_sum([x.n for x in found if x.w < {LIMIT}]), 0) AS BIGINT) AS soft_hits,
            CAST(coalesce(list_sum([x.w for x in found]), 0) AS BIGINT) AS weight,
            array_to_string([x.t for x in found], ',') AS terms FROM c
    )
    SELECT page_id, host, path, rule, coalesce(CASE rule {says} END, CASE WHEN weight >= {LIMIT} THEN 'block' ELSE 'allow' END) AS verdict, strict_hits, soft_hits, weight, terms FROM d
    """


SQL = _sql()
