"""Hubs, hot terms, substring keys and folds against plain computations."""

import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tessera.operators import bayes as B
from tessera.operators import graph as G
from tessera.operators import text as T


@pytest.mark.parametrize("hub_edges", [100_000, 7])
def test_pagerank_of_a_star_with_a_hub(spark, monkeypatch, hub_edges):
    monkeypatch.setattr(G, "HUB_EDGES", hub_edges)
    edges = [("hub", f"n{i}", float(1 + i % 3)) for i in range(60)] + [(f"n{i}", "hub", 1.0) for i in range(0, 60, 2)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    got = {r["node"]: r["rank"] for r in G.pagerank(
        spark.createDataFrame(edges, "src string, dst string, weight double"), fixed_rounds=4, partitions=3).collect()}
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    nodes = sorted({e[0] for e in edges} | {e[1] for e in edges})
    out = Counter()
    for s, _, w in edges:
        out[s] += w
    rank = dict.fromkeys(nodes, 1 / len(nodes))
    for _ in range(4):
        base = (0.85 * sum(rank[n] for n in nodes if not out[n]) + 0.15) / len(nodes)
        new = dict.fromkeys(nodes, base)
        for s, d, w in edges:
            new[d] += 0.85 * rank[s] * w / out[s]
        rank = new
    assert got == pytest.approx(rank)
    assert G.pagerank(spark.createDataFrame([], "src string, dst string, weight double")).count() == 0


def test_pagerank_does_not_shuffle_its_edges_in_a_round(spark, monkeypatch):
    """Edges stand dealt on disk; of the two inputs of a round only the ranks are dealt."""
    plans, cut = [], G.cut_lineage

    def seen(df, *args, path=None, **kwargs):
        if path:
            plans.append(df._jdf.queryExecution().executedPlan().toString().split("\n"))
        return cut(df, *args, path=path, **kwargs)

    monkeypatch.setattr(G, "cut_lineage", seen)
    edges = [(f"n{i}", f"n{(i * 7 + k) % 50}", 1.0) for i in range(50) for k in range(3)]
    ranks = G.pagerank(spark.createDataFrame(edges, "src string, dst string, weight double"), fixed_rounds=2,
                       partitions=4).collect()
    assert len(ranks) == 50 and sum(r["rank"] for r in ranks) == pytest.approx(1)
    assert len(plans) == 3
    for plan in plans[1:]:
        step = next(i for i, line in enumerate(plan) if "FlatMapCoGroupsInArrow" in line)
        scan = next(i for i, line in enumerate(plan) if "InMemoryTableScan" in line)
        assert step < scan and not [line for line in plan[step:scan] if "Exchange" in line]


def test_hot_terms_are_joined_apart(spark, monkeypatch):
    monkeypatch.setattr(T, "HOT_SHARE", 0.2)
    rows = [(d, "the", 2) for d in range(40)] + [(d, f"t{d % 9}", 1) for d in range(40)]
    tf = spark.createDataFrame(rows, "doc_id long, term string, tf long")
    terms = T.document_frequency(tf)
    got = sorted(map(tuple, T.join_terms(tf, terms).select("doc_id", "term", "tf", "df").collect()))
    df = Counter(t for _, t, _ in rows)
    assert got == sorted((d, t, n, df[t]) for d, t, n in rows)


def test_substring_matches_equal_all_pairs(spark):
    rng = random.Random(0)
    words = ["".join(rng.choice("abé") for _ in range(rng.randint(0, 6))) for _ in range(80)]
    terms = words[:60] + ["".join(rng.choice("abé") for _ in range(12)) for _ in range(30)] + [None]
    got = {(r["term"], r["word"]) for r in T.substring_matches(
        spark.createDataFrame([(t,) for t in terms], "term string"),
        spark.createDataFrame([(w,) for w in [*words, None]], "word string")).collect()}
    assert got == {(t, w) for t in terms if t for w in words if w and w in t}


def test_naive_bayes_of_all_folds_and_alphas(spark):
    rng = random.Random(3)
    docs = [(i, rng.choice("xyz"), i % 3, [rng.choice("abcdefgh") + "'" * (i % 2) for _ in range(rng.randint(0, 12))])
            for i in range(45)]
    tf = [(i, t, n, y, f) for i, y, f, ws in docs for t, n in Counter(ws).items()]
    alphas = [0.1, 2.0]
    got = {(r["doc_id"], r["alpha"]): (r["prediction"], {s["label"]: s["jll"] for s in r["scores"]}) for r in B.multinomial_nb(
        spark.createDataFrame(tf, "doc_id long, term string, tf long, label string, fold int"),
        spark.createDataFrame([d[:3] for d in docs], "doc_id long, label string, fold int"), alphas).collect()}
    want = {}
    for fold in range(3):
        train = [d for d in docs if d[2] != fold]
        n = defaultdict(Counter)
        for _, y, _, ws in train:
            n[y].update(ws)
        vocabulary = {t for c in n.values() for t in c}
        for i, _, _, ws in (d for d in docs if d[2] == fold):
            ws = [t for t in ws if t in vocabulary]
            for a in alphas if ws else []:
                scores = {c: math.log(sum(d[1] == c for d in train) / len(train)) + sum(
                    math.log((n[c][t] + a) / (sum(n[c].values()) + a * len(vocabulary))) for t in ws) for c in "xyz"}
                want[i, a] = (min(scores, key=lambda c: (-scores[c], c)), scores)
    assert set(got) == set(want)
    for key, (prediction, scores) in want.items():
        assert got[key][0] == prediction and got[key][1] == pytest.approx(scores)
    one = B.multinomial_nb(spark.createDataFrame(tf, "doc_id long, term string, tf long, label string, fold int"),
                           spark.createDataFrame([d[:3] for d in docs], "doc_id long, label string, fold int"), [1.0], [2])
    assert one.where("fold != 2").count() == 0 and one.count() == sum(k[1] == 0.1 and k[0] % 3 == 2 for k in want)
