"""Quality classifier, spelling variants and collocations against brute force."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tessera.llm import collocations, gam, spelling
from tests.conftest import SMALL

LOWER = {c: c + 32 for c in range(65, 91)}


@pytest.fixture(params=["documents", "small", "no_documents"])
def docs(request):
    return request.getfixturevalue(request.param)


# -- collocations ---------------------------------------------------------------

def brute_counts(rows, longest):
    """f of every phrase by (lang, words), words of each lang."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i:i + k])] += 1
    return f, n


def brute_collocations(rows, longest=3, least=10, top=2000):
    f, n = brute_counts(rows, longest)
    candidates = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= least}
    inside = defaultdict(int)
    for (lang, words), a in candidates.items():
        for k in range(2, len(words)):
            for i in range(len(words) - k + 1):
                inside[lang, words[i:i + k]] = max(inside[lang, words[i:i + k]], a)
    found = defaultdict(list)
    for (lang, words), a in candidates.items():
        if 100 * inside[lang, words] >= 50 * a:
            continue
        cuts = [(1_000_000 * a * a // (f[lang, words[:k]] * f[lang, words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        found[lang].append((-score, -a, " ".join(words).encode(), f[lang, words[:k]], f[lang, words[k:]]))
    return Counter((lang, at + 1, p.decode(), -a, x, y, n[lang], -score) for lang, all_ in found.items()
                   for at, (score, a, p, x, y) in enumerate(sorted(all_)[:top]))


def langs(df):
    return [(r["lang"], r["text"]) for r in df.select("lang", "text").collect()]


def test_collocations_equal_brute_force(docs):
    got = Counter(map(tuple, collocations.report(docs).collect()))
    assert got == brute_collocations(langs(docs))


@pytest.fixture(scope="module")
def babble(spark):
    rng = random.Random(5)
    rows = []
    for i in range(160):
        words = [rng.choice("abcde") if rng.random() < 0.6 else rng.choice(["x\x85y", "É", "STRAẞE", "p q r s t u"])
                 for _ in range(rng.randint(0, 80))]
        text = "".join(w + rng.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\r\n"]) for w in words)
        rows.append((i, text, rng.choice(["en", "en", "de", None, "und"])))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3).cache()


@pytest.mark.parametrize("longest, least", [(2, 10), (3, 3), (4, 5), (5, 10)])
def test_collocations_of_other_lengths(babble, longest, least):
    got = collocations.collocations(babble, longest, least, top=50).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")
    assert Counter(map(tuple, got.collect())) == brute_collocations(langs(babble), longest, least, 50)


def test_collocations_of_hot_nodes_and_small_chunks(babble, monkeypatch):
    monkeypatch.setattr(collocations, "HOT_EVERY", 1)
    assert len(collocations.hot_nodes(babble)) > 5
    got = Counter(map(tuple, collocations.report(babble).collect()))
    assert got == brute_collocations(langs(babble))
    edges = collocations.edge_counts(babble, 3, collocations.hot_nodes(babble))
    assert edges.where("salt > 0").count() > 10
    # chunks of few words give the same grams
    words = np.array([1, 2, 3, 0, 0, 2, 3, 1, 2, 0])
    rows, counts = collocations._grams(words, 2)
    assert dict(zip(map(tuple, rows.tolist()), counts.tolist(), strict=True)) == {
        (1, 2): 2, (2, 3): 2, (3, 0): 1, (3, 1): 1, (2, 0): 1}


def test_collocation_paths(spark):
    def counts(*edges):
        return spark.createDataFrame([("en", 3, e, 10) for e in edges], "lang string, size int, phrase string, f long")

    # one chain of five edges, then a fork; a ring of three, which nothing enters
    chain = ["a b c", "b c d", "c d e", "d e f", "e f g"]
    fork, ring = ["f g x", "f g y"], ["r s t", "s t r", "t r s"]
    got = {r["phrase"]: (r["path"], r["place"]) for r in
           collocations.unary_paths(counts(*chain, *fork, *ring, "z z z")).collect()}
    want = {e: ("a b c", k) for k, e in enumerate(chain)} | {e: (e, 0) for e in fork}
    want |= {"r s t": ("r s t", 0), "s t r": ("r s t", 1), "t r s": ("r s t", 2), "z z z": ("z z z", 0)}
    assert got == want
    long = [f"w{i} w{i + 1} w{i + 2}" for i in range(70)]
    got = {r["phrase"]: (r["path"], r["place"]) for r in collocations.unary_paths(counts(*long)).collect()}
    assert got == {e: (long[0], k) for k, e in enumerate(long)}
    assert collocations.unary_paths(counts("a b c").where("false")).count() == 0


# -- spelling variants ----------------------------------------------------------

def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_variants(counts):
    near = {w: [x for x in counts if one_edit(w, x)] for w in counts}
    form = {}
    for w, n in counts.items():
        best = min(((-counts[x], x) for x in near[w]), default=None)
        form[w] = best[1] if best and -best[0] >= 5 * n else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {(w, form[w], root(w), n, len(near[w]), counts.get(form[w])) for w, n in counts.items()}


def brute_words(rows, least=5):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= least}


@pytest.mark.parametrize("letters", ["a", "ab", "abc"])
def test_spelling_index_finds_all_near_words(letters):
    rng = random.Random(3)
    for size in (1, 2, 40, 300):
        words = sorted({"".join(rng.choice(letters) for _ in range(rng.randint(1, 9))) for _ in range(size)})
        queries = sorted(set(words[::2]) | {"".join(rng.choice("abz") for _ in range(rng.randint(1, 9))) for _ in range(20)})
        q, w = spelling.near_words(spelling.BidirectionalIndex(words), queries)
        assert set(zip(q.tolist(), w.tolist(), strict=True)) == {
            (i, j) for i, a in enumerate(queries) for j, b in enumerate(words) if one_edit(a, b)}


def test_spelling_steps_keep_both_intervals():
    words = ["banana", "bandana", "cabana", "nab"]
    index = spelling.BidirectionalIndex(words)
    text = "#" + "#".join(words)
    codes, _ = index.codes(["ana"])
    a, n, a2 = codes
    state = (np.zeros(1, np.int64), np.zeros(1, np.int64), np.full(1, index.n))
    for left, code in ((False, n), (True, a), (False, a2)):
        state = index.step(left, np.array([code]), *state)
    lo, rlo, size = (int(x[0]) for x in state)
    ends = sorted(i for i in range(len(text)) if (text + text)[i:].startswith("ana"))
    assert size == len(ends) and sorted(index.text.order[lo:lo + size].tolist()) == ends
    assert sorted(len(text) - 3 - p for p in index.reverse.order[rlo:rlo + size].tolist()) == ends


@pytest.mark.parametrize("cell, block", [(8192, 32768), (5, 40)])
def test_spelling_variants_equal_brute_force(spark, monkeypatch, cell, block):
    monkeypatch.setattr(spelling, "CELL", cell)
    monkeypatch.setattr(spelling, "BLOCK_ROWS", block)
    rng = random.Random(9)
    counts = {}
    for _ in range(60):
        w = rng.choice(["pre", "éco", "aaa"]) + "".join(rng.choice("abé") for _ in range(rng.randint(3, 6)))
        for n in (1000, 100, 20, 3, 3):
            counts.setdefault(w, rng.choice([n, n, 5]))
            i = rng.randrange(len(w))
            w = rng.choice([w[:i] + w[i + 1:], w[:i] + "b" + w[i:], w[:i] + "x" + w[i + 1:]])
    counts |= {"a" * 500: 7, "a" * 501: 60, "a" * 502: 600}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = [tuple(r) for r in spelling.variants(words).collect()]
    assert len(got) == len(set(got)) and set(got) == brute_variants(counts)
    assert any(form != root for _, form, root, *_ in got if form)


def test_spelling_report_equals_brute_force(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    counts = brute_words(rows)
    assert {(r["word"], r["n"]) for r in spelling.word_counts(docs).collect()} == set(counts.items())
    got = [tuple(r) for r in spelling.report(docs).collect()]
    assert len(got) == len(counts) and set(got) == brute_variants(counts)


# -- quality classifier ---------------------------------------------------------

def test_classifier_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SMALL.replace('sf0.001', 'sf0.01')}/{t}.parquet") for t in ("documents", "labels"))
    got = gam.report(docs, labels).toPandas()
    assert len(got) == docs.count() and got.score.between(0, 1).all()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got.doc_id]).all()
    assert (got.predicted == (got.score >= 0.7)).all()
    held = got.merge(labels.toPandas(), on="doc_id").query("held_out")
    assert (held.predicted == held.quality).mean() > 0.97


def test_classifier_never_sees_held_out_labels(spark, small):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    other = labels.selectExpr("doc_id", "if(pmod(crc32(cast(doc_id as string)), 4) = 2, 1 - quality, quality) as quality")
    a, b = (sorted(map(tuple, gam.report(small, x).collect())) for x in (labels, other))
    assert a == b
    renamed = small.selectExpr("doc_id", "text", "'xx' as lang", "'y' as source")
    assert sorted(map(tuple, gam.report(renamed, labels).collect())) == a


def test_classifier_of_odd_rows(spark, documents, no_documents):
    labels = spark.createDataFrame([(i, i % 2) for i in range(26)] + [(None, 1), (3, None), (4, 7)],
                                   "doc_id long, quality int")
    for some in (labels, labels.where("false"), labels.where("quality = 1")):
        rows = gam.report(documents, some).collect()
        assert len(rows) == documents.count() and all(0 <= r["score"] <= 1 for r in rows)
        assert all(r["held_out"] is False for r in rows if r["doc_id"] is None)
    assert gam.report(no_documents, labels).count() == 0
    kept = gam.with_scores(documents.withColumn("quality_score", documents.doc_id), labels)
    assert kept.columns == [*documents.columns, "quality_score", "quality_score_"] and kept.count() == documents.count()


def test_classifier_learns_a_pair():
    rng = np.random.default_rng(0)
    x = rng.random((4000, len(gam.FEATURES))).astype(np.float32)
    y = ((x[:, 2] > 0.5) ^ (x[:, 5] > 0.5)).astype(int)  # no feature tells anything alone
    edges = [np.quantile(x[:, k], np.arange(1, 32) / 32).astype(np.float32) for k in range(x.shape[1])]
    model = gam.fit(x[:3000], y[:3000], edges)
    assert (2, 5) in {(i, j) for i, j, _ in model.pairs}
    assert ((model.score(x[3000:]) > 0.5) == y[3000:]).mean() > 0.95
    # a score is the sum of table entries
    bins = gam.binned(x[:1], edges)[0]
    total = model.intercept + sum(t[b] for t, b in zip(model.tables, bins, strict=True)) + sum(
        t[bins[i] * 8 // 32, bins[j] * 8 // 32] for i, j, t in model.pairs)
    assert model.score(x[:1])[0] == pytest.approx(1 / (1 + np.exp(-total)))


def test_classifier_features_read_the_whole_text():
    assert gam.features(None) == gam.features("") == [0.0] * len(gam.FEATURES)
    at = gam.FEATURES.index("repeated_windows")
    assert gam.features(" ".join(f"w{i}" for i in range(5000)))[at] == 0
    assert gam.features(" ".join(f"w{i}" for i in range(2500)) * 2)[at] > 0.45
    assert len(gam.features("\x00\ud800 é" * 3)) == len(gam.FEATURES)
