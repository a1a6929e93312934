"""Every operator against a brute-force version, over nulls, empty and long texts, ties, repeated rows and clashing columns."""

from __future__ import annotations

import collections
import hashlib
import math
import re
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from basketlake.llm import decontaminate, induced, language, lm, mixing, near, neighbours, queries, rangecoder, repeats, sanitise, simhash, tokens, toxicity, trie

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
#: Extra columns carry names that the operators use inside.
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, words string, block string, fp string, batch string, _th string, kind string"
_rng = np.random.default_rng(7)
_VOCAB = ["the", "of", "And", "über", "señor", "night", "x1", "(day)", "row,", "Was", "blue", "9"]


def _prose(n):
    return " ".join(_rng.choice(_VOCAB, n))


PASSAGE = _prose(90)
ITEM = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
TEXTS = [
    None, "", " \t\n ", "one", "the of", PASSAGE, PASSAGE, "Lead " + PASSAGE + " tail", _prose(60) + " " + PASSAGE[:400], _prose(4000), "z" * 700, "ab" * 300, "q" * 199,
    ITEM, "Before, " + ITEM.upper().replace(" ", "; ") + " after", ITEM + " " + _prose(400), "short item", "a short item here", *[_prose(40) for _ in range(12)], PASSAGE[:-1] + "Q",
    "write a@b.com_x@y.org or z@@q, 1.2.3.4.5 256.1.1.1 card 4111 1111 1111 1111 4111-1111-1111-1112 call +49 (30) 123-45-67 890- x", "漢字 me@x.io😀 you@y.io", "tab\there  <|endoftext|>   end \n",
]
ROWS = [(i, t, ["en", "de", None][i % 3], ["a", "b", "é", None, "a"][i % 5], 3, *["clash"] * 6) for i, t in enumerate(TEXTS)]
ROWS += [ROWS[5], ROWS[1], (None, "no id " + _prose(20), None, None, None, *[None] * 6), (10**9, TEXTS[9], "en", "a", 1, *["clash"] * 6)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is not None, r[0] or 0, repr(r[1:])))


def words(text, pattern=SPACED):
    return pattern.findall((text or "").translate(LOWER))


def test_simhash(docs, nothing):
    def finger(text):
        w = words(text)
        h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 4]), 42) for i in range(max(1, len(w) - 3))] if w else []
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    fps = [finger(r[1]) for r in ROWS]
    least = list(range(len(ROWS)))
    for _ in ROWS:
        least = [min([least[j] for j in range(len(ROWS)) if (fps[i] ^ fps[j]).bit_count() <= 4]) for i in range(len(ROWS))]
    ids = collections.defaultdict(list)
    for i, c in enumerate(least):
        ids[c].append(ROWS[i][0])
    want = [(r[0], f"{f:016x}", min((x for x in ids[c] if x is not None), default=None)) for r, f, c in zip(ROWS, fps, least, strict=True)]
    got = simhash.clusters(docs).select("doc_id", "fingerprint", "component_id").collect()
    assert ordered(got) == ordered(want)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r[0] is None, r[0] or 0) for r in kept.select("doc_id").collect()) == sorted({(min(x) if (x := [i for i in v if i is not None]) else None) for v in ids.values()} and [(c is None, c or 0) for c in {min([i for i in v if i is not None], default=None) for v in ids.values()}])
    assert simhash.clusters(nothing).count() == simhash.keep_one(nothing).count() == 0


def test_simhash_links_and_components(spark):
    centre = _rng.integers(0, 1 << 63, 6, dtype=np.uint64)
    fps = {int(c) ^ sum(1 << int(b) for b in _rng.choice(64, k, replace=False)) for c in centre for k in (0, 2, 4, 5, 8) for _ in range(15)}
    signed = [int(np.uint64(f).view(np.int64)) for f in fps]
    edges = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp bigint"))
    root = {f: f for f in signed} | {r.node: r.root for r in simhash.components(edges).collect()}
    label = {f: f for f in fps}
    for _ in range(30):
        label = {f: min(label[g] for g in fps if (f ^ g).bit_count() <= 4) for f in fps}
    groups = lambda d: {frozenset(k for k in d if d[k] == v) for v in d.values()}
    assert {frozenset(np.int64(f).view(np.uint64).item() for f in g) for g in groups(root)} == groups(label)
    chain = spark.createDataFrame([(i, i + 1) for i in range(40)], "a bigint, b bigint")
    assert {r.root for r in simhash.components(chain).collect()} == {0}


def test_simhash_hot_anchors(spark, monkeypatch):
    monkeypatch.setattr(simhash, "HOT_ROWS", 20)
    fps = [int(x) for x in _rng.integers(0, 1 << 12, 300)]
    df = spark.createDataFrame([(f,) for f in set(fps)], "fp bigint")
    got = {f: f for f in fps} | {r.node: r.root for r in simhash.components(simhash.links(df)).collect()}
    assert len(set(got.values())) == 1  # twelve bits: all are linked through each other


def test_near_copies(spark, docs, nothing):
    import corpus_pipeline

    rng = np.random.default_rng(11)
    texts = [r[1] for r in ROWS]
    for _ in range(6):  # copies with changed words, on both sides of the limit, and a passage that many share
        base = [f"w{x}" for x in rng.integers(0, 5_000, 100)]
        for changes in (0, 1, 1, 2, 2, 3, 5, 9):
            other = list(base)
            for at in rng.integers(0, 100, changes):
                other[at] = "changed" + str(rng.integers(0, 9_000))
            texts.append(" ".join(other))
    texts += [" ".join(f"w{x}" for x in rng.integers(0, 5_000, 40)) + " " + PASSAGE[:200] for _ in range(20)]
    rows = [(i, t) for i, t in enumerate(texts)]
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if (w := words(t)) else set() for t in texts]
    alike = [[j for j in range(len(sets)) if sets[i] == sets[j] or 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])] for i in range(len(sets))]
    least = list(range(len(sets)))
    for _ in rows:
        least = [min(least[j] for j in alike[i]) for i in range(len(sets))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert sorted(r.doc_id for r in corpus_pipeline.drop_near_copies(spark, df, "").collect()) == sorted(set(least))
    kept = near.keep_one(docs)
    assert kept.columns == docs.columns and near.keep_one(nothing).count() == 0


def test_near_copies_at_hot_shingles(spark, monkeypatch):
    monkeypatch.setattr(near, "HOT_ROWS", 8)
    monkeypatch.setattr(near, "TASK_ROWS", 100)
    rng = np.random.default_rng(12)
    common = "these five words are common"
    texts = [common + " " + " ".join(f"w{x}" for x in rng.integers(0, 5_000, 8)) for _ in range(150)]
    for i in range(0, 60, 2):  # copies with a word more
        texts.append(texts[i] + " more")
    sets = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in map(words, texts)]
    least = list(range(len(texts)))
    for _ in range(3):
        least = [min(least[j] for j in range(len(texts)) if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])) for i in range(len(texts))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    assert sorted(r.doc_id for r in near.keep_one(df).collect()) == sorted(set(least)) == list(range(150))


def test_near_copies_at_one_shingle_of_many_texts(spark):
    rng = np.random.default_rng(13)
    own = [" ".join(map(str, r)) for r in rng.integers(0, 10**9, (50_000, 6)).tolist()]
    rows = [(i, "these five words are common " + t) for i, t in enumerate(own)] + [(60_000 + i, "these five words are common " + own[i]) for i in range(40)]
    kept = near.keep_one(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(8))
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == list(range(50_000))


def test_near_copies_of_one_text_make_few_pairs(spark, monkeypatch):
    rng = np.random.default_rng(14)
    base, rows = [f"w{x}" for x in rng.integers(0, 5_000, 150)], []
    for i in range(400):  # most are alike, through others all are
        other = list(base)
        for at in rng.integers(0, 150, 2 + i % 3):
            other[at] = "changed" + str(rng.integers(0, 10**9))
        rows.append((i, " ".join(other)))
    made, verified = [], near._verified
    monkeypatch.setattr(near, "_verified", lambda pairs, *more: (made.append(pairs.distinct().count()), verified(pairs, *more))[1])
    got = {r.doc_id: r.root for r in near.clusters(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)).collect()}
    sets = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in (t.split() for _, t in rows)]
    label = list(range(400))
    for i in range(400):
        for j in range(i):
            if label[i] != label[j] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                label = [label[i] if x == label[j] else x for x in label]
    assert len(set(got.values())) == len(set(label)) == len({(got[i], label[i]) for i in range(400)})
    assert sum(made) < 20 * 400


BENCH = [(1, ITEM), (10, "Short item"), (2, None), (3, "..."), (4, PASSAGE), (None, _prose(20)), (1, ITEM)]


@pytest.mark.parametrize("bound", [10**6, 0])
def test_contamination(spark, docs, nothing, bound):
    bench = spark.createDataFrame(BENCH, "item_id bigint, text string")
    token = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = collections.defaultdict(set)
    for i, t in BENCH:
        w = words(t, token)
        for s in range(max(1, len(w) - 12) if w else 0):
            windows[tuple(w[s : s + 13])].add(i)
    want = []
    for r in ROWS:
        w = words(r[1], token)
        hit, items = set(), set()
        for x, owners in windows.items():
            for s in range(len(w) - len(x) + 1):
                if tuple(w[s : s + len(x)]) == x:
                    hit |= set(range(s, s + len(x)))
                    items |= owners - {None}
        names = sorted(map(str, items))
        want.append((r[0], len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    assert ordered(decontaminate.contamination(docs, bench, broadcast_windows=bound).collect()) == ordered(want)
    if bound:
        clean = decontaminate.remove_documents(docs, bench)
        assert clean.columns == docs.columns and clean.count() == sum(not w[5] for w in want)
        cut = decontaminate.remove_spans(docs, bench)
        assert cut.count() == len(ROWS) and decontaminate.contamination(cut, bench).where("n_hit > 0").count() == 0
        assert not decontaminate.contamination(docs, bench.limit(0)).where("n_hit > 0").count()
        assert decontaminate.contamination(nothing, bench).count() == 0


def test_contaminated_rows_go_alone(spark):
    rows = [(None, ITEM), (None, _prose(30)), (None, None), (7, ITEM), (7, _prose(31)), (8, _prose(32))]
    bench = spark.createDataFrame([(1, ITEM)], "item_id bigint, text string")
    kept = decontaminate.remove_documents(spark.createDataFrame(rows, "doc_id bigint, text string"), bench)
    assert ordered(kept.collect()) == ordered(r for r in rows if r[1] != ITEM)


def test_personal_data(docs, nothing):
    kinds = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}

    def valid(k, s):
        d = [int(c) for c in s if c.isdigit()]
        luhn = sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(reversed(d))) % 10 == 0
        return {"email": True, "ip": k != "ip" or all(int(p) <= 255 for p in s.split(".")), "card": 14 <= len(d) <= 19 and luhn, "phone": 10 <= len(d) <= 15}[k]

    want = []
    for r in ROWS:
        spans = sorted((m.start(), j, k, m.end()) for j, (k, p) in enumerate(kinds.items()) for m in re.finditer(p, r[1] or "") if valid(k, m.group()))
        want.append((r[0], *(sum(s[1] == j for s in spans) for j in range(4)), hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, _, k, b in spans).encode()).hexdigest()))
    got = sanitise.personal_data(docs).collect()
    assert ordered(r[:6] for r in got) == ordered(want)
    assert sanitise.personal_data(nothing).count() == 0
    clean = sanitise.sanitise(docs)
    assert clean.columns == docs.columns and not sanitise.personal_data(clean).where("n_email > 0 or n_card > 0").count()


def test_disclosing_terms(spark):
    rows = [(i, f"{_prose(30)} agent Zanzibar mail spy@ring.org tonight {i} {_prose(30)}", None) for i in range(4)] + [(i, _prose(60) + " agent", None) for i in range(4, 160)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, kind string")
    got = {r.doc_id: r for r in sanitise.personal_data(df).collect()}
    for i in range(4):
        terms = [rows[i][1][int(a) : int(b)] for k, a, b in (s.split(":") for s in got[i].spans.split(",")) if k == "term"]
        assert "Zanzibar" in terms and "agent" not in terms and "the" not in terms
    assert all(got[i].spans == "" for i in range(4, 160))
    assert "agent [TERM] [TERM] [EMAIL] [TERM]" in sanitise.sanitise(df).where("doc_id = 1").first().text
    big = sanitise.personal_data(df, broadcast_terms=0).where("doc_id < 4").select("spans").collect()
    assert sorted(r.spans for r in big) == sorted(got[i].spans for i in range(4))


def test_disclosing_terms_far_from_their_entity_against_brute_force(spark):
    rng = np.random.default_rng(21)
    fill = lambda n: " ".join("".join(rng.choice(list("abcdefgh"), 5)) for _ in range(n))
    rows = [(i, f"Krumplitz {fill(90)} spy@ring.org {fill(5)}") for i in range(5)]  # the name stands 500 characters away
    rows += [(10, f"{fill(20)} krumplitz, {fill(10)}"), (11, fill(20)), (12, None), (13, ""), rows[0], (14, "x@y.org " + "spam " * 3000), (15, "x@y.org " * 400 + "spam")]
    rows += [(20 + i, f"call 1.2.3.{i % 2} {fill(10)} Omega") for i in range(6)] + [(30 + i, "omega omega") for i in range(3)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    word = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    base, terms = {}, {}
    for i, t in rows:
        base[i] = {m.group().lower() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+|[0-9]+(?:\.[0-9]+){3}", t or "")}
        terms[i] = {w.lower() for w in word.findall(t or "")}
    told = set()
    texts = [(i, t) for i, t in rows if t is not None]  # documents, copies too
    for e in set().union(*base.values()):
        of = [(i, t) for i, t in texts if e in base[i]]
        for w in set().union(*(terms[i] for i, _ in of)):
            both = [(i, t) for i, t in of if w in terms[i]]
            held = sum(w in terms[i] for i, _ in texts)
            if len({t for _, t in both}) >= 3 and len(both) >= 0.5 * held and math.log2(len(both) * len(texts) / len(of) / held) >= 1:
                told.add(w)
    assert "krumplitz" in told and "omega" not in told
    got = sanitise.personal_data(df, bits=1.0).collect()
    for r in got:
        text = next(t for i, t in rows if i == r.doc_id) or ""
        free = lambda m: not any(m.start() < b.end() and b.start() < m.end() for b in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+|[0-9]+(?:\.[0-9]+){3}", text))  # noqa: B023, E731
        want = [f"term:{m.start()}:{m.end()}" for m in word.finditer(text) if m.group().lower() in told and free(m)]
        assert [s for s in r.spans.split(",") if s.startswith("term")] == want and r.n_term == len(want), r.doc_id
    assert next(r for r in got if r.doc_id == 10).n_term == 1
    many = sanitise.personal_data(df, bits=1.0, broadcast_terms=0).collect()
    assert ordered(many) == ordered(got)


@pytest.mark.parametrize("small", [{}, {"batch_tokens": 300, "shard_tokens": 900}])
def test_language_model(docs, nothing, small):
    held = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2
    every = [(r[0], [*words(r[1]), None]) for r in ROWS]
    c, pair, texts = collections.Counter(), collections.Counter(), 0
    for d, w in every:
        if not held(d):
            c.update(w)
            pair.update(zip(["<s>", *w[:-1]], w, strict=True))
            texts += 1
    n, v = sum(c.values()), len(c)
    p = lambda w: (c[w] + 1) / (n + v + 1)
    q = lambda a, b: (pair[a, b] + lm.MU * p(b)) / ((texts if a == "<s>" else c[a]) + lm.MU)
    want = ordered((d, held(d), len(w), sum(c[x] > 0 for x in w), n, sum(math.log10(p(x)) for x in w), sum(math.log10(q(a, b)) for a, b in zip(["<s>", *w[:-1]], w, strict=True))) for d, w in every)
    got = ordered(r[:7] for r in lm.scores(docs, **small).collect())
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for g, w in zip(got, want, strict=True):
        assert g[5] == pytest.approx(w[5], abs=1e-8) and g[6] == pytest.approx(w[6], abs=1.3e-4 * g[2])
    assert lm.scores(nothing).count() == 0


@pytest.mark.parametrize("small", [{}, {"batch_tokens": 300, "shard_tokens": 900}])
def test_language_model_of_triples(spark, docs, nothing, monkeypatch, small):
    held = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2
    every = [(r[0], [*words(r[1]), None]) for r in ROWS]
    c, pair, triple, texts = collections.Counter(), collections.Counter(), collections.Counter(), 0
    of = lambda w: list(zip(["<s>", "<s>", *w[:-2]], ["<s>", *w[:-1]], w)) if len(w) > 1 else [("<s>", "<s>", w[0])]  # noqa: B905, E731
    for d, w in every:
        if not held(d):
            c.update(w)
            pair.update((b, x) for _, b, x in of(w))
            triple.update(of(w))
            texts += 1
    n, v = sum(c.values()), len(c)
    p = lambda w: (c[w] + 1) / (n + v + 1)
    q = lambda a, b: (pair[a, b] + lm.MU * p(b)) / ((texts if a == "<s>" else c[a]) + lm.MU)
    t = lambda a, b, x: (triple[a, b, x] + lm.MU * q(b, x)) / ((texts if b == "<s>" else pair[a, b]) + lm.MU)
    want = ordered((d, held(d), len(w), sum(x in c for x in w), n, sum(math.log10(p(x)) for x in w), sum(math.log10(t(*x)) for x in of(w))) for d, w in every)
    got = ordered(r[:7] for r in lm.scores(docs, order=3, **small).collect())
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for g, w in zip(got, want, strict=True):
        assert g[5] == pytest.approx(w[5], abs=1e-8) and g[6] == pytest.approx(w[6], abs=2.6e-4 * g[2])
    assert lm.scores(nothing, order=3).count() == 0
    # The query asks for triples.
    monkeypatch.setattr(queries, "table", lambda *a: docs)
    assert [r[6] for r in ordered(r[:7] for r in queries.op4_lm_scores(spark, "").collect())] == pytest.approx([w[6] for w in want], abs=0.3)


def test_the_trie_holds_every_pair_of_training(monkeypatch):
    rows = [(i, _PAIRS[i % 3]) for i in range(60)]
    held = lambda d: zlib.crc32(str(d).encode()) % 7 == 2
    want = {(a, b) for d, t in rows if not held(d) for a, b in zip(["<s>", *t.split()], [*t.split(), "</s>"], strict=True)}
    monkeypatch.setattr(lm.TaskContext, "get", lambda: type("Task", (), {"partitionId": lambda self: 0})())
    rb = pa.RecordBatch.from_pydict({"doc_id": pa.array([d for d, _ in rows], pa.int64()), "text": pa.array([t for _, t in rows])})
    (batch,) = lm._tokenise(10**6)(iter([rb]))
    tokens_ = batch.column("tokens")[0].as_py()
    (asked,) = lm._ask_words(1)(iter([batch.select(["batch", "hashes", "counts"])]))
    words_ = lm._answer_words(1, tokens_ // lm.TOP)(pa.table(asked))
    n, v = words_.column("n")[0].as_py(), words_.column("v")[0].as_py()
    top = np.array(sorted(np.int64(x["word"]).view(np.uint64) for x in words_.column("top")[0].as_py()), np.uint64)
    assert len(top) == v  # all words are frequent ones here
    messages = lm._batch_pairs(1, n, v, top, pa.int64(), True)(pa.table(batch), words_.slice(1))
    built = []
    build = lm.build_level
    monkeypatch.setattr(lm, "build_level", lambda *a: built.append(build(*a)) or built[-1])
    lm._answer_pairs(lm.MU)(messages)
    assert [level.followers.n for level in built] == [len(want)]


_PAIRS = ["a b c a c b b", "c c a d", "d b a"]


def test_trie(tmp_path):
    for n, u in ((0, 10), (1, 1), (5, 3), (800, 500), (800, 10**12)):
        x = np.sort(_rng.integers(0, u, n)).astype(np.uint64)
        e = trie.EliasFano(*trie.EliasFano.arrays(x))
        assert not n or (e.get(np.arange(n)) == x).all()
        q = np.concatenate([_rng.integers(0, u + 5, 500).astype(np.uint64), x])
        at, hit = e.successor(q)
        assert (at == np.searchsorted(x, q)).all() and (hit == np.isin(q, x)).all()
    key = np.unique(_rng.integers(0, 50, 3000) * 10**6 + _rng.integers(0, 10**5, 3000))
    c, w, p = key // 10**6, key % 10**6, -8 * _rng.random(len(key))
    trie.Level.build(c, w, p, 50).save(str(tmp_path / "level"))
    level = trie.Level.open(str(tmp_path / "level"))
    hit, got = level.find(c, w)
    assert hit.all() and np.abs(got - p).max() < 2e-4
    assert (level.find(c, w + 1)[0] == np.isin(key + 1, key)).all()


def test_induced_sort():
    for n, a in ((1, 1), (3, 2), (60, 1), (60, 3), (400, 2), (400, 26)):
        t = np.append(_rng.integers(1, a + 1, n), 0).astype(np.int32)
        for budget in (40, 1 << 20):
            assert induced.suffix_order(t, 10**6, budget).tolist() == sorted(range(n + 1), key=lambda i: tuple(t[i:]))
    for width in (3, 10, 16):
        pieces = [bytes(_rng.integers(0, 3, _rng.integers(1, 60)).astype(np.uint8)) for _ in range(60)] + [b""]
        seen = collections.Counter(x[i : i + width] for x in pieces for i in range(len(x) - width + 1))
        assert [h.tolist() for h in induced.repeated(pieces, width)] == [[seen[x[i : i + width]] > 1 for i in range(len(x) - width + 1)] for x in pieces]


@pytest.mark.parametrize("small", [{}, {"batch_bytes": 3000, "shard_bytes": 4000, "frequent": 2, "sort_bytes": 1000}, {"width": 40}])
def test_repeats(docs, nothing, small):
    width = small.get("width", 200)
    raw = [(r[0], (r[1] or "").encode()) for r in ROWS]
    seen = collections.Counter(b[i : i + width] for _, b in raw for i in range(len(b) - width + 1))
    want = []
    for d, b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - width + 1):
            if seen[b[i : i + width]] > 1:
                gone[i : i + width] = b"\1" * width
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        want.append((d, len(b), sum(gone), sum(bool(g and not (i and gone[i - 1])) for i, g in enumerate(gone)), hashlib.sha256(kept).hexdigest()))
    assert ordered(repeats.remove_repeats(docs, **small).collect()) == ordered(want)
    assert repeats.remove_repeats(nothing).count() == 0


def test_anchors_of_long_texts(monkeypatch):
    n = (1 << 24) + 5_000
    raw = np.random.default_rng(3).integers(0, 256, n, dtype=np.uint8)
    raw[-900:] = raw[:900]  # the copy lies beyond the positions that 24 bits can hold
    first, count, key = repeats.runs(raw, np.array([n]), 200, 24)
    each = np.repeat(key, count)
    assert (np.repeat(first - np.cumsum(count) + count, count) + np.arange(len(each)) == np.arange(n - 199)).all()
    assert (each[:701] == each[-701:]).all()
    raw, lens = raw[:5_000], np.array([150, 1_850, 3_000])
    want = repeats.runs(raw, lens, 200, 24)
    monkeypatch.setattr(repeats, "PLACE_BITS", 9)
    got = repeats.runs(raw, lens, 200, 24)
    spread = lambda r: (np.concatenate([np.arange(a, a + c) for a, c in zip(r[0], r[1], strict=True)]).tolist(), np.repeat(r[2], r[1]).tolist())
    assert spread(got)[0] == spread(want)[0]
    # Fewer bits may name another gram where hashes tie; equal strings still have equal anchors.
    assert len(spread(got)[1]) == 1_850 - 199 + 3_000 - 199


def test_mixing(docs, nothing):
    got = mixing.taken(docs, block=8)
    rows = got.collect()
    size = collections.Counter()
    for r in ROWS:
        size[r[3]] += len(words(r[1]))
    names = sorted([s for s in size if s is not None]) + [None]
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, open_ = {}, set(names)
    while True:
        level = (sum(size.values()) - sum(target.values())) / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level > 3 * size[s]}
        if not full:
            break
        target |= {s: 3.0 * size[s] for s in full}
        open_ -= full
    target |= {s: weight[s] * level for s in open_}
    assert len(rows) == len(ROWS) and sorted((r.size, r.doc_id or -1) for r in rows) == sorted((len(words(r[1])), r[0] or -1) for r in ROWS)
    by = {(r[0], r[1]): r[3] for r in ROWS}
    assert {r.source for r in rows} == set(by.values())
    for s in names:
        mine = [r for r in rows if r.source == s]
        assert mine[0].source_size == size[s] and mine[0].target == pytest.approx(target[s])
        assert abs(sum(r.taken for r in mine) - target[s]) <= 8 * 3
    assert all(r.taken <= 3 * r.size for r in rows)
    again = mixing.taken(docs.repartition(5), block=8).collect()
    assert ordered(again) == ordered(rows)
    mixed = mixing.mixed_documents(docs, block=8)
    assert mixed.columns == docs.columns
    assert mixed.select(F.sum(F.regexp_count("text", F.lit(SPACED.pattern)))).first()[0] == sum(r.taken for r in rows)
    assert mixing.taken(nothing).count() == mixing.mixed_documents(nothing).count() == 0


def test_block_permutation(spark):
    for n in (1, 2, 3, 5, 10, 577, 4096, 5000):
        df = spark.range(3 * n).select(F.lit("a").alias("s"), F.col("id").alias("k"), F.lit(n).cast("bigint").alias("n"))
        got = [r[0] for r in df.select(mixing.permuted(F.col("s"), F.col("k"), F.col("n"))).orderBy("k").collect()]
        turns = [got[i : i + n] for i in range(0, 3 * n, n)]
        assert all(sorted(t) == list(range(n)) for t in turns)
        if n > 500:  # no stride, and another order each time
            steps = collections.Counter(np.diff(turns[0]).tolist())
            assert max(steps.values()) < 0.02 * n and turns[0] != turns[1]
            assert abs(np.corrcoef(turns[0], np.arange(n))[0, 1]) < 0.15
    big = 1 << 40
    df = spark.range(2000).select(F.lit("a").alias("s"), (F.col("id") * 7 + big * 3 - 9000).alias("k"), F.lit(big).alias("n"))
    got = [r[0] for r in df.select(mixing.permuted(F.col("s"), F.col("k"), F.col("n"))).collect()]
    assert len(set(got)) == 2000 and all(0 <= x < big for x in got) and max(got) > big // 2


def test_mix_is_its_draws_joined_to_the_blocks(docs):
    """The words taken follow from slots and blocks, put together by hand."""
    sized, wanted = mixing.plan(docs, 8)
    slots = collections.Counter((r.source, r.block) for r in mixing.mixed_blocks(wanted).collect())
    per = {r.source: r for r in wanted.collect()}
    for s, r in per.items():
        mine = {b: n for (o, b), n in slots.items() if o == s}
        assert sum(mine.values()) == r.slots and all(0 <= b < r.n_blocks for b in mine)
        assert not mine or max(mine.values()) - min(mine.get(b, 0) for b in range(r.n_blocks)) <= 1  # whole turns, and part of one
    want, at = collections.Counter(), collections.Counter()
    key = lambda r: (r.source is not None, r.source or "", r.doc_id is not None, r.doc_id or 0, r._th)
    for r in sorted(sized.collect(), key=key):
        for w in range(at[r.source], at[r.source] + r.size):
            want[r.source, r.doc_id, r._th] += slots[r.source, w // 8]
        at[r.source] += r.size
    got = collections.Counter()
    texts = {(r[0], r[3]): [] for r in ROWS}
    for r in mixing.taken(docs, block=8).collect():
        got[r.source, r.doc_id] += r.taken
        texts[r.doc_id, r.source].append(r.size)
    total = collections.Counter()
    for (s, d, _), n in want.items():
        total[s, d] += n
    assert {k: v for k, v in got.items() if v} == {k: v for k, v in total.items() if v}


def test_mixing_takes_ids_of_any_kind(spark):
    rows = [(f"id-{i % 90}" if i % 3 else None, _prose(1 + i % 30), "a" if i % 4 else "b") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id string, text string, source string").repartition(4)
    got = mixing.taken(df, block=8)
    assert got.columns == ["doc_id", "size", "source_size", "target", "taken", "source"] and got.count() == 300
    assert got.agg(F.max(F.col("taken") - 3 * F.col("size"))).first()[0] <= 0


def test_targets_stop_at_three_times(spark):
    df = spark.createDataFrame([("a", 1000), ("b", 10), ("c", 0), ("d", 40)], "source string, size bigint")
    got = {r.source: r.target for r in mixing.targets(df).collect()}
    assert got == pytest.approx({"a": 900.0, "b": 30.0, "c": 0.0, "d": 120.0})


def test_tokens(docs, nothing):
    from tokenizers import Tokenizer

    t, at, want = Tokenizer.from_file(tokens.TOKENIZER), 0, []
    for r in sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*t.encode(r[1] or "", add_special_tokens=False).ids, 2]
        want.append((r[0], at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert ordered(tokens.token_digest(docs).collect()) == ordered(want)
    assert tokens.token_digest(nothing).count() == 0


def test_chunks_met_once_a_slice_are_remembered():
    encode = tokens.Encoder(tokens.TOKENIZER, remember=8)
    asked, library = [], encode._encode
    encode._encode = lambda chunks: (asked.extend(chunks), library(chunks))[1]
    for text in ("aqua bello", "bello corvus", "aqua corvus", *(f"w{'x' * i} aqua" for i in range(40)), "aqua"):
        ids, sizes = encode(pa.array([text]))
        assert ids.tolist() == encode.tokenizer.encode(text, add_special_tokens=False).ids and sizes.tolist() == [len(ids)]
        assert len(encode.known) <= 8 and len(encode.before) <= 9
    assert asked.count(b" corvus") == asked.count(b" aqua") == 1  # met again often enough to stay


def test_chunks_have_the_ids_of_whole_texts():
    rng, encode = np.random.default_rng(11), tokens.Encoder(tokens.TOKENIZER, remember=50)
    few = [*"abzAZ \n09'.,!-", "'s", "'re", " '", "\n\n"]
    many = [*few, *"\t\r\x1c\x00\x7f\x85\xa0\xad\xb2\xb5\xd7\xf7\xe9\xff\u0131\u03c9\u0416\u0301\u2003\u200b\u3000\u4e2d", "\U0001f642", "<|endoftext|>", "<|"]
    texts = [*("".join(rng.choice(few if i % 3 else many, rng.integers(0, 40))) for i in range(6000)), None, "", " ", "x" * 200, "\tno\xa0", "'s"]
    for size in (1, 5000, 1 << 20):
        got = [*encode.slices(pa.array(["cut off", *texts], pa.string()).slice(1), size)]
        ids, ends = np.concatenate([x for x, _ in got]), np.cumsum(np.concatenate([n for _, n in got]))
        assert len(ends) == len(texts) and len(ids) == ends[-1]
        for t, x in zip(texts, np.split(ids, ends[:-1]), strict=True):
            assert x.tolist() == encode.tokenizer.encode(t or "", add_special_tokens=False).ids, t


@pytest.mark.parametrize("segment", [7, 100, 10**6])
def test_segments_hold_whole_documents(docs, segment, tmp_path):
    tokens.write_tokens(docs, str(tmp_path / "t"), segment_ids=segment)
    rows = docs.sparkSession.read.parquet(str(tmp_path / "t")).collect()
    assert sum(len(r.doc_ids) for r in rows) == docs.count()
    assert all(r.n_ids == sum(r.n_tokens) and (r.n_ids <= segment or len(r.doc_ids) == 1) for r in rows)


def test_coder_takes_one_symbol_and_few_bytes_an_id():
    x = np.minimum(np.random.default_rng(11).zipf(1.2, 300 * rangecoder.BLOCK), 50_000).astype("<u4")
    calls = []

    class Writer(rangecoder._Writer):
        def take(self, n, cum, freq):
            calls.append(n)
            super().take(n, cum, freq)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(rangecoder, "_Writer", Writer)
        model, blocks = rangecoder.encode(x)
    assert len(calls) == rangecoder.BLOCK and sum(calls) == len(x)
    # Beside the ids: numpy tells tracemalloc of all it takes.
    peaks = []
    for work in (lambda: rangecoder.encode(x), lambda: rangecoder.decode(model, blocks)):
        tracemalloc.start()
        work()
        peaks.append(tracemalloc.get_traced_memory()[1] / len(x))
        tracemalloc.stop()
    assert max(peaks) < 16, peaks


def test_range_coder():
    skewed = np.minimum(_rng.zipf(1.2, 60_000), 50_000)
    for x in (np.zeros(0, np.int64), np.array([5]), _rng.integers(0, 65_535, 9000), np.full(5000, 7), np.tile(np.arange(90), 100), skewed, np.repeat(skewed[:9000], 7), _rng.integers(0, 10**6, 30_000), np.array([2**32 - 1, 0, 2**31])):
        model, blocks = rangecoder.encode(x)
        assert (np.concatenate([np.zeros(0, "<u4"), *rangecoder.decode(model, blocks)]) == x).all()
    # Blocks are independent: any of them is read alone.
    model, blocks = rangecoder.encode(skewed)
    assert (rangecoder.decode(model, blocks[3:4])[0] == skewed[3 * rangecoder.BLOCK : 4 * rangecoder.BLOCK]).all()
    assert sum(len(b[2]) for b in blocks) < 2 * len(skewed)
    model, [(n, crc, data)] = rangecoder.encode(np.arange(3000) % 17)
    with pytest.raises(ValueError, match="checksum"):
        rangecoder.decode(model, [(n, crc, data[:9] + bytes([data[9] ^ 255]) + data[10:])])


def test_neighbours(spark):
    x = _rng.standard_normal((1200, 12)).astype(np.float32)
    x[700:760] = x[5]
    rows = [(i, [float(v) for v in x[i]], "clash") for i in range(1200)] + [(3, [float(v) for v in x[3]], "again"), (1300, None, ""), (1400, [0.0] * 12, ""), (1500, [float("nan")] * 12, ""), (1600, [None, *[1.0] * 11], ""), (None, [1.0] * 12, ""), (1700, [1.0, 2.0], "")]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, score string")
    got = collections.defaultdict(list)
    for r in neighbours.nearest(df).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    assert sorted(got) == list(range(0, 1200, 100))
    right = 0
    for q, found in got.items():
        d = np.sqrt(((x.astype(float) - x[q].astype(float)) ** 2).sum(axis=1))
        want = [(i, d[i]) for i in sorted(range(1200), key=lambda i: (d[i], i)) if i != q][:10]
        right += len({i for i, _ in found} & {i for i, _ in want})
        assert found == sorted(found, key=lambda f: (f[1], f[0])) and all(s == pytest.approx(d[i]) for i, s in found)
    assert right >= 0.9 * 120
    assert [i for i, _ in got[700]] == [5, *range(701, 710)]
    assert neighbours.nearest(df.limit(0)).count() == 0
    assert neighbours.nearest(spark.createDataFrame(rows[:4], df.schema)).count() == 3


def test_neighbours_verify_a_fifth_of_a_block():
    rng = np.random.default_rng(17)
    x = rng.standard_normal((4096, 64)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1)[:, None]
    index = neighbours.BlockIndex(np.arange(4096), x, neighbours.PROJECTIONS, neighbours.COLLISIONS, neighbours.SEED)
    right = 0
    for q in range(0, 4096, 200):
        d = ((x.astype(float) - x[q].astype(float)) ** 2).sum(axis=1)
        want = set(sorted((i for i in range(4096) if i != q), key=lambda i: (d[i], i))[:10])
        right += len(want & {i for i, _ in index.search(x[q].astype(float), q, 10)})
    assert right >= 0.9 * 210 and index.verified < 0.25 * 21 * 4096


def test_toxicity(spark, nothing):
    bad = ["scumbag", "idiotic", "moronish"]
    texts = [_prose(30) + (" " + " ".join(_rng.choice(bad, 1 + i % 6)) if i % 4 == 0 else "") for i in range(400)]
    rows = [(i, t, *[None] * 9) for i, t in enumerate(texts)] + [(1000, None, *[None] * 9), (1001, "", *[None] * 9), (None, texts[0], *[None] * 9), (0, texts[0], *[None] * 9)]
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(300)] + [(None, 1, 1), (5, 1, None), (7, 0, 0)], "doc_id bigint, quality int, toxic int")
    got = toxicity.toxicity(docs, labels).collect()
    assert len(got) == len(rows)
    wrong = sum(r.toxic != (r.doc_id % 4 == 0) for r in got if r.doc_id is not None and r.doc_id < 400)
    assert wrong <= 4 and not any(r.toxic for r in got if r.doc_id in (1000, 1001))
    assert all(r.severity == pytest.approx(r.p_grade1 + 2 * r.p_grade2 + 3 * r.p_grade3) for r in got)
    mean = lambda k: np.mean([r.severity for r in got if r.doc_id is not None and r.doc_id < 400 and r.doc_id % 4 == 0 and (r.doc_id % 6) == k])
    assert mean(4) > mean(0)
    clean = toxicity.drop_toxic(docs, labels)
    assert clean.columns == docs.columns and clean.count() == sum(not r.toxic for r in got)
    assert not any(r.toxic for r in toxicity.toxicity(docs, labels.limit(0)).collect())
    assert toxicity.toxicity(nothing, labels).count() == 0


def test_language(spark, docs):
    en, de = "the quick brown fox jumps over the lazy dog and then it sleeps ", "der schnelle braune fuchs springt über den faulen hund und schläft "
    labelled = spark.createDataFrame([(i, (en if i % 2 else de) * (1 + i % 3), "en" if i % 2 else "de") for i in range(40)], "doc_id bigint, text string, lang string")
    page = lambda body, lang: f'<html{f" lang={lang}" if lang else ""}><script>var x="</p>";</script><body><p>{body}</p></body></html>'
    rows = [(i, f"http://h{i % 4}.{'de' if i % 4 < 2 else 'com'}/x", page(de if i % 4 < 2 else en, "de" if i % 4 < 2 else "en"), "clash") for i in range(80)]
    rows += [(100, "http://h0.de/y", page("", "de"), ""), (101, "http://h2.com/y", page("zz", None), ""), (102, None, None, ""), (103, "not an address", "", ""), (None, "http://h0.de/z", page(de, "en"), "")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, host string")
    got = {r.page_id: r for r in language.language(pages, labelled).collect()}
    assert len(got) == 85 and all(got[i].lang == ("de" if i % 4 < 2 else "en") for i in range(80))
    assert got[100].lang == "de" and got[101].lang == "en" and got[None].lang == "de"
    assert got[102].lang in ("de", "en") and got[102].host is None
    assert {r.lang for r in language.language(pages, labelled.limit(0)).collect()} == {None}
    assert language.language(pages.limit(0), labelled).count() == 0


def test_pipeline(spark, docs, tmp_path):
    import corpus_pipeline

    docs.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(BENCH, "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([(0, 1, 0)], "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    now = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, now, str(tmp_path))
        assert out.columns == now.columns, name
        out.write.parquet(str(tmp_path / name))
        now = spark.read.parquet(str(tmp_path / name))
    last = ordered(corpus_pipeline.STAGES[-1][1](spark, now, str(tmp_path)).collect())
    assert last and last == ordered(corpus_pipeline.run(spark, str(tmp_path)).collect())
