"""The fitted models against their definitions, written out row by row."""

from __future__ import annotations

import collections
import math
import re

import numpy as np
import pytest

from basketlake.llm import language, toxicity

L2 = 1e-3


def _objective(w, theta, rows, dense, grade):
    """Mean negative log-likelihood of the cumulative-link model, and the penalty of its weights."""
    total = 0.0
    for ids, d, g in zip(rows, dense, grade, strict=True):
        z = sum(w[i] for i in ids) + float(d @ w[-2:])
        below = [0.0, *(1 / (1 + math.exp(z - t)) for t in theta), 1.0]
        total -= math.log(max(below[g + 1] - below[g], 1e-300))
    return total / len(rows) + L2 / 2 * float(w @ w)


def test_ordinal_fit_is_the_optimum_of_the_written_out_likelihood():
    rng = np.random.default_rng(31)
    rows = [np.nonzero(rng.random(6) < 0.4)[0] for _ in range(300)]
    dense = rng.random((300, 2))
    true = np.array([2.0, -1.5, 1.0, 0.0, 0.5, -0.5])
    z = np.array([true[r].sum() for r in rows]) + dense @ [1.0, -0.5] + rng.logistic(size=300)
    grade = np.searchsorted([0.5, 1.5, 2.5], z)
    assert set(grade) == {0, 1, 2, 3}
    w, theta = toxicity._fit_weights(rows, dense, grade, 6, l2=L2)
    assert len(w) == 8 and len(theta) == 3 and (np.diff(theta) > 0).all()
    best = _objective(w, theta, rows, dense, grade)
    for k in range(11):  # every weight and every threshold, either way
        for step in (-0.05, 0.05):
            p = np.concatenate([w, theta])
            p[k] += step
            assert _objective(p[:8], p[8:], rows, dense, grade) > best - 1e-6
    again = toxicity._fit_weights(rows, dense, grade, 6, l2=L2)
    assert (again[0] == w).all() and (again[1] == theta).all()


def test_grades_are_the_written_out_probabilities(spark):
    index = {"vile": 0, "vile*": 1, "fine": 2, "awfu*": 3}
    model = toxicity.Model(index, frozenset({"vile", "awfu*"}), np.array([1.5, 0.25, -2.0, 0.75, 0.5, 0.125]), np.array([0.5, 1.75, 3.0]))
    texts = [None, "", "fine", "Vile! words", "vilest awfully fine", "vile " * 3 + "fine", "plain " * 200_000 + "vile", "awful " * 100_000, "vile", "vile"]
    rows = [(i if i != 9 else 8, t, "clash", 1.0) for i, t in enumerate(texts)] + [(None, "vile", None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, grade string, severity double").repartition(3)
    got = sorted(toxicity.grade(docs, model).collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    want = []
    for i, t, *_ in rows:
        words = (t or "").lower().split()
        names = [[w.strip(toxicity._EDGE)] for w in words]
        names = [[*x, *(x[0][:n] + "*" for n in (4, 5, 6) if len(x[0]) > n)] for x in names]
        held = {index[f] for x in names for f in x if f in index}
        hits = sum(any(f in model.marks for f in x) for x in names)
        z = sum(model.weights[j] for j in held) + 0.5 * math.log1p(hits) + 0.125 * math.log1p(100 * hits / max(len(words), 1))
        below = [1 / (1 + math.exp(z - c)) for c in model.thresholds]
        p = np.diff([0.0, *below, 1.0])
        want.append((i, 1 - below[0], p[1], p[2], p[3], p[1] + 2 * p[2] + 3 * p[3], int(np.argmax(p)), 1 - below[0] >= 0.5))
    want.sort(key=lambda r: (r[0] is not None, r[0] or 0))
    assert len(got) == len(want)
    for g, w in zip(got, want, strict=True):
        assert g[0] == w[0] and g[6:] == w[6:] and tuple(g[1:6]) == pytest.approx(w[1:6], abs=1e-9)
    clean = toxicity.grade(docs, model, keep_clean=True)
    assert clean.columns == docs.columns
    assert sorted((r.doc_id is not None, r.doc_id or 0) for r in clean.collect()) == sorted((w[0] is not None, w[0] or 0) for w in want if not w[7])


EN, DE = "the quick brown fox jumps over the lazy dog and then it sleeps ", "der schnelle braune fuchs springt über den faulen hund und schläft "


def _pages():
    def page(body, said):
        return f'<!-- {DE} --><html{f" lang={said}" if said else ""}><style>p {{x}}</style><body><p>{body}</p></body></html>'

    rows = []
    for i in range(60):
        host = ["a.x.de", "b.x.de", "www.y.com", "z.org", "only" + str(i) + ".y.com"][i % 5]
        path = ["/en/p", "/p", "/de", "/fr/q"][i % 4]
        body = (EN if i % 7 < 4 else DE)[: 8 + 3 * (i % 17)]
        rows.append((i, f"https://{host}{path}", page(body, ["en", "de", None, "fr-FR", "EN-us"][(i + i // 5) % 5]), "clash", 1.0))
    rows += [rows[3], rows[3], rows[10]]  # repeated rows are pages of their own
    rows += [(100, None, None, None, None), (101, "", "", "", 0.0), (102, "no address", page(DE, "de"), "", 0.0), (103, "http://a.x.de", page("", None), "", 0.0), (None, "http://user@Z.org:80/de/", page(EN, None), "", 0.0)]
    rows.append((104, "http://long.y.com/", page(DE * 20_000, "en"), "", 0.0))
    return rows


def test_fused_evidence_against_brute_force(spark):
    labelled = [(i, (EN if i % 2 else DE) * (1 + i % 3), "en" if i % 2 else "de") for i in range(40)]
    docs = spark.createDataFrame(labelled, "doc_id bigint, text string, lang string")
    rows = _pages()
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, host string, p double").repartition(3)

    langs = ["de", "en"]
    counts = {name: np.full(language.BINS, 0.5) for name in langs}
    for _, text, name in labelled:
        np.add.at(counts[name], language.bins_of(text), 1)
    loglik = np.log([counts[x] / counts[x].sum() for x in langs])

    evidence = []
    for i, url, html, *_ in rows:
        m = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", url or "")
        host = m.group(1).lower() if m else None
        domain = ".".join(host.split(".")[-2:]) if host else None
        m = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+/([A-Za-z]{2})(?:[/?#]|$)", url or "")
        code = m.group(1).lower() if m else ""
        m = re.search(r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]+)", html or "")
        said = m.group(1).lower() if m else ""
        named = lambda c: c if c in langs or not c else "other"
        visible = re.sub(r"(?is)<style\b[^>]*>.*?</style>|<!--.*?-->|<[^>]*>", " ", html or "")
        x = language.bins_of(visible)
        ll = loglik[:, x].mean(axis=1) * min(len(x), language.TRIGRAMS) if len(x) else np.zeros(2)
        p = np.exp(ll - ll.max())
        # Markup that is null declares nothing, like markup without a language; a null address and an empty one are two values.
        ending = None if url is None else ((host.split(".")[-1] if host else ""), named(code))
        evidence.append((i, host, domain, named(said), ending, ll - ll.max(), p / p.sum()))
    total = sum(e[6] for e in evidence) + 1.0
    share = total / total.sum()
    sums = [collections.defaultdict(lambda: np.zeros(2)) for _ in range(5)]
    for e in evidence:
        for k in (1, 2, 3, 4):
            sums[k][e[k]] += e[6]
    smooth = lambda n, up: (n + language.KAPPA * up) / (n.sum() + language.KAPPA)
    want = []
    for i, host, domain, said, ending, ll, p in evidence:
        prior = share
        if host:  # without the page's own text
            prior = smooth(np.maximum(0, sums[1][host] - p), smooth(np.maximum(0, sums[2][domain] - p), share))
        f = ll + np.log(prior) + np.log((sums[3][said] + 0.5) / (total + 10)) + np.log((sums[4][ending] + 0.5) / (total + 10))
        q = np.exp(f - f.max())
        q /= q.sum()
        want.append((i, langs[int(np.argmax(q))], float(q.max()), langs[int(np.argmax(p))], host))
    key = lambda r: (r[0] is not None, r[0] or 0)
    got = sorted(((r.page_id, r.lang, r.confidence, r.text_lang, r.host) for r in language.language(pages, docs).collect()), key=key)
    want.sort(key=key)
    assert len(got) == len(want)
    for g, w in zip(got, want, strict=True):
        assert g[0] == w[0] and g[4] == w[4] and g[1] == w[1] and g[3] == w[3] and g[2] == pytest.approx(w[2], abs=2e-6), (g, w)
    assert any(g[1] != g[3] for g in got)  # the other evidence decides somewhere
    assert all(g[1] in langs and 0.5 <= g[2] <= 1 for g in got)
