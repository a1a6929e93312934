"""URL filter, spelling variants and hard negatives against brute force: nulls, empty and long values, ties, repeats, clashing columns."""

from __future__ import annotations

import collections
import re
import zlib

import numpy as np
import pytest

from basketlake.llm import negatives, spelling, urls

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
URLS = [
    None, "", "no address", "://", "http://", "http://Example.NET/en/1", "https://a.example.net/EN/1", "https://a.example.net/en/1?x=casino-free", "http://notexample.net/en/",
    "http://x.net", "http://x.net/", "http://x.net?/en/", "http://x.net#/", "http://b.example.com/de/casino", "http://b.example.com/fr/", "http://org/fr/x", "http://a.org/fr", "http://a.org/fr/adult",
    "ftp://u@h.com:80/p?q#f", "http://ADULT.com/", "http://adults.com/", "http://h.com/adult_adult-adult", "http://h.com/adulté", "http://h.com/éadult", "http://h.com/free/free/free", "http://h.com/free/win", "http://h.com/FREE?bets#x",
    "http://h.com/" + "free-x" * 5_000 + "/loan", "http://h.com/" + "a" * 200_000, "http://h.com/a://b.net/", "http://h.com/free\nwin", "http://cheap-pills.com/a b", "adult",
]


def judged(url):
    at = (url or "").find("://")
    rest = url[at + 3 :] if url and at >= 0 else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = host.translate(LOWER)
    text = (url or "").translate(LOWER)
    found = {t: n for t in urls.VOCABULARY if (n := len(re.findall(rf"(?<![0-9a-z\x80-\U0010ffff]){t}(?![0-9a-z\x80-\U0010ffff])", text)))}
    weight = sum(urls.VOCABULARY[t] for t in found)
    fits = sorted((len(h + p), h + p, v) for v, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p))
    verdict = fits[-1][2] if fits else "block" if weight >= urls.LIMIT else "allow"
    strict = sum(n for t, n in found.items() if t in urls.STRICT)
    return host, path, fits[-1][1] if fits else None, verdict, strict, sum(found.values()) - strict, weight, ",".join(sorted(found))


def test_url_filter(spark):
    rows = [(i, u, *["clash"] * 4) for i, u in enumerate(URLS)] + [(5, URLS[5], *["clash"] * 4), (None, URLS[25], *["clash"] * 4)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, host string, rule string, verdict string").repartition(3)
    got = urls.judge(pages)
    assert got.columns[:5] == ["page_id", "host", "path", "rule", "verdict"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(((r[0], *judged(r[1])) for r in rows), key=repr)
    kept = urls.keep_allowed(pages)
    assert kept.columns == pages.columns and sorted(map(tuple, kept.collect()), key=repr) == sorted((r for r in rows if judged(r[1])[3] == "allow"), key=repr)
    assert urls.judge(pages.limit(0)).count() == urls.keep_allowed(pages.limit(0)).count() == 0


def test_url_filter_other_words_and_rules(spark):
    pages = spark.createDataFrame([("p", "http://one.two/three-four")], "page_id string, url string")
    row = urls.judge(pages, {"three": 1, "our": 5, "four": 1, "o": 1}, 2, ()).first()
    assert (row.page_id, row.rule, row.verdict, row.terms) == ("p", None, "block", "four,three")
    assert urls.judge(pages, {}, 2, [("block", "two", "/three-")]).first().rule == "two/three-"
    assert urls.judge(pages, {}, 2, ()).first().verdict == "allow"


def variants(rows, least=5):
    count = collections.Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            count[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 199 == 0 else run] += 1
    n = {w: c for w, c in count.items() if len(w) >= 6 and c >= least}

    def near(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    by = {w: [o for o in n if o != w and abs(len(o) - len(w)) < 2 and near(w, o)] for w in n}
    form = {w: f for w, o in by.items() if o and n[f := min(o, key=lambda x: (-n[x], x))] >= 5 * n[w]}
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(by[w]), n.get(form.get(w))))
    return sorted(out, key=repr)


SCHEMA = "doc_id bigint, text string, word string, n string, id string, part string"


def spelled(spark, rows):
    df = spark.createDataFrame([(*r, *["clash"] * 4) for r in rows], SCHEMA).repartition(3)
    return sorted(map(tuple, spelling.variants(df).collect()), key=repr)


def test_spelling(spark):
    rng = np.random.default_rng(3)
    letters = list("abé")
    words = ["".join(rng.choice(letters, k)) for k in rng.integers(5, 9, 160)]
    words += ["aaaaaa", "aaaaaaa", "aaaaaaaa", "Straße", "strasse", "STRASSE", "×÷×÷×÷", "éèêëïî", "éèêëïîx", "zz" * 300, "zz" * 300 + "y", "short"]
    times = [int(5 ** rng.integers(1, 4)) for _ in words]
    rows = [(int(i), " ".join(rng.permutation([w for w, k in zip(words, times, strict=True) for _ in range(k // 5)]))) for i in rng.integers(0, 10_000, 5)]
    rows += [(None, "a-b " + words[0] + "_" + words[1] + "1" + words[2] + "漢" + words[3] + "😀aaaaaa"), (1, None), (2, ""), (3, " 12 ! "), rows[0], rows[0], (9, "aaaaaa " * 3_000)]
    want = variants(rows)
    assert spelled(spark, rows) == want
    assert sum(r[4] for r in want) > 50 and any(r[1] for r in want)


def test_spelling_chains_ties_and_nothing(spark):
    # Each word is a variant of the next; the damage is kept out by a doc_id under which no run is damaged.
    chain = {"aaaaaa": 5, "aaaaab": 25, "aaaabb": 125, "aaabbb": 625, "zzzzzzx": 5, "zzzzzz": 25, "zzzzzzy": 25, "zzzzzzxx": 4}
    at = next(i for i in range(1000) if all(zlib.crc32(f"{i}:{w}".encode()) % 199 for w in chain))
    rows = [(at, " ".join([w] * n)) for w, n in chain.items()]
    got = spelled(spark, rows)
    assert got == variants(rows)
    assert {r[0]: r[2] for r in got} == {"aaaaaa": "aaabbb", "aaaaab": "aaabbb", "aaaabb": "aaabbb", "aaabbb": "aaabbb", "zzzzzzx": "zzzzzz", "zzzzzz": "zzzzzz", "zzzzzzy": "zzzzzzy"}
    assert spelled(spark, [(1, None), (2, "few words")]) == spelled(spark, [(1, "lonely " * 5)])[:0] == []
    assert [r[:3] for r in spelled(spark, [(at, "lonely " * 5)])] == [("lonely", None, "lonely")]


def test_spelling_damage(spark):
    hit = next(i for i in range(10**6) if zlib.crc32(f"{i}:{'abcdefg'}".encode()) % 199 == 0)
    cut = zlib.crc32(f"{hit}:abcdefg".encode()) % 7
    assert [r[0] for r in spelled(spark, [(hit, "ABCDEFG " * 5)])] == ["abcdefg"[:cut] + "abcdefg"[cut + 1 :]]


def mined(rows, every=100):
    ok = [(i, (lab + 1) % 10 if i % 7 == 0 else lab, [int(np.floor(256 * float(x))) for x in v]) for i, lab, v in rows if i is not None and lab is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    ok = [(i, lab, v) for i, lab, v in dict.fromkeys((i, lab, tuple(v)) for i, lab, v in ok)]
    out = []
    for anchor in ok:
        if anchor[0] % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(anchor[2], o[2], strict=True)), o[0], o[1]) for o in ok if o is not anchor and len(o[2]) == len(anchor[2]))
        for s, i, _ in [x for x in scored if x[2] == anchor[1]][:5]:
            fits = [x for x in scored if x[2] != anchor[1] and 30 * -s <= 100 * -x[0] <= 90 * -s][:10]
            out += [(anchor[0], i, k + 1, x[1], -s, -x[0]) for k, x in enumerate(fits)]
    return sorted(out)


VECTORS = "vec_id bigint, embedding array<float>, label int, score string, d string, v string"


def test_hard_negatives(spark, monkeypatch):
    monkeypatch.setattr(negatives, "LEAST_ROWS", 100)
    monkeypatch.setattr(negatives, "TILE", (3, 70))
    rng = np.random.default_rng(5)
    x = rng.standard_normal((900, 24)).astype(np.float32) * 0.2
    x[300:340] = x[7]  # ties
    x[500:520] = 0
    rows = [(i, int(rng.choice([0, 0, 0, 1, 2, 9])), [float(v) for v in x[i]]) for i in range(900)]
    rows += [rows[3], rows[100], (1000, None, [1.0] * 24), (1100, 0, None), (1200, 0, [float("nan")] * 24), (1300, 0, [None, *[1.0] * 23]), (1400, 0, [float("inf")] * 24), (None, 0, [1.0] * 24)]
    rows += [(1500, 0, [0.5, 0.25]), (1501, 0, [0.5, 0.25]), (1502, 1, [0.25, 0.25]), (1700, 3, []), (1702, 3, []), (1703, 4, []), (-200, 0, [float(v) for v in x[8]]), (1800, 5, [float(v) for v in x[1]])]
    df = spark.createDataFrame([(i, v, lab, *["clash"] * 3) for i, lab, v in rows], VECTORS).repartition(3)
    got = negatives.mine(df)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = mined(rows)
    assert sorted(map(tuple, got.collect())) == want and len(want) > 300
    assert negatives.mine(df.limit(0)).count() == 0
    assert negatives.mine(spark.createDataFrame([(0, [1.0], 1, *["clash"] * 3)], VECTORS)).count() == 0


def test_hard_negatives_wide_numbers(spark):
    rng = np.random.default_rng(6)
    x = (rng.standard_normal((60, 6)) * 3e6).astype(np.float32)
    rows = [(i, i % 3, [float(v) for v in x[i]]) for i in range(60)]
    df = spark.createDataFrame([(i, v, lab, *["clash"] * 3) for i, lab, v in rows], VECTORS)
    assert sorted(map(tuple, negatives.mine(df, every=20).collect())) == mined(rows, 20)
    huge = spark.createDataFrame([(i, [3e38 * (1 + i % 2)], i % 2, *["clash"] * 3) for i in range(0, 5)], VECTORS.replace("float", "double"))
    assert negatives.mine(huge).columns and negatives.mine(huge).count() >= 0


@pytest.mark.parametrize("spread", [0.0, 1.0])
def test_segment_bounds_hold_and_prune(spread):
    rng = np.random.default_rng(9)
    centre = rng.standard_normal((20, 64)) * spread
    x = np.floor(256 * (np.repeat(centre, 200, axis=0) + 0.2 * np.repeat(rng.standard_normal((4000, 16)), 4, axis=1) + 0.05 * rng.standard_normal((4000, 64))))
    n = np.arange(4000)
    block, q = negatives.Rows(n, n, n * 0, x), negatives.Rows(n[:10], n[:10], n[:10] * 0, x[:10])
    score = x[:10] @ x.T
    for (qm, qd), (rm, rd) in zip(q.levels, block.levels, strict=True):
        middle, apart = qm @ rm.T, qd @ rd.T + 1e-6
        assert (middle - apart <= score).all() and (score <= middle + apart).all()
    low = np.sort(score, axis=1)[:, -10]
    a, b = negatives.open_pairs(q, block, np.ones(score.shape, bool), low, np.full(10, np.inf), 0)
    assert set(zip(*np.nonzero(score >= low[:, None]), strict=True)) <= set(zip(a, b, strict=True))
    assert len(a) < 0.05 * score.size
    best = negatives.positives(q, block, 10)
    for i, lists in enumerate(best):
        order = sorted((j for j in range(4000) if j != i), key=lambda j: (-score[i, j], j))[:10]
        assert lists[0].ids.tolist() == order
