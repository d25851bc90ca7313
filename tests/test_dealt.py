"""Texts are dealt by document once, n-grams by their first words, fit tables by rows."""

from collections import Counter

from pyspark.sql import functions as F

from tessera.operators import models as ML
from tessera.operators import text as T
from tessera.session import cut_lineage, dealt


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _docs(spark):
    rows = [(1, "to be or not to be"), (1, "to be is to do"), (2, "not to be"), (3, "be"), (4, ""), (5, None),
            (None, "to be or"), (None, "or not"), (6, "do or"), (6, "do or")]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_counts_and_sums_per_document_take_one_shuffle(spark):
    docs = cut_lineage(_docs(spark))
    per_doc = T.term_counts(docs).groupBy("doc_id").agg(F.sum("tf").alias("n"))
    assert _plan(per_doc).count("Exchange hashpartitioning") == 1
    assert {r.doc_id: r.n for r in per_doc.collect()} == {1: 11, 2: 3, 3: 1, 6: 4, None: 5}


def test_distinct_counts_do_not_multiply_the_rows(spark):
    tf = T.term_counts(_docs(spark))
    report = T.vocabulary_report(tf)
    assert "Expand" not in _plan(report)
    r = report.first()
    assert (r.vocab_size, r.nnz, r.n_docs, r.first_term, r.last_term) == (6, 16, 4, "be", "to")


def test_ngram_sizes_count_documents_by_key(spark):
    cnt, docs = Counter(), {}
    for r in _docs(spark).collect():
        words = (r.text or "").split()
        for n in (1, 2, 3):
            for i in range(len(words) - n + 1):
                g = tuple(words[i:i + n])
                cnt[g] += 1
                docs.setdefault(g, set()).add(r.doc_id)
    wanted = [(n, sum(len(g) == n for g in cnt), sum(c for g, c in cnt.items() if len(g) == n),
               sum(len(g) == n and len(d) > 1 for g, d in docs.items()), max(c for g, c in cnt.items() if len(g) == n))
              for n in (1, 2, 3)]
    x = _docs(spark).select("doc_id", F.split("text", " ").alias("toks"))
    x = x.select("doc_id", F.filter("toks", lambda w: w != "").alias("toks"))
    sizes = T.ngram_sizes(x, "toks")
    assert sorted(map(tuple, sizes.collect())) == wanted
    assert T.ngram_sizes(x.where("false"), "toks").collect() == []


def test_a_lexicon_meets_the_terms_once(spark):
    lex = spark.createDataFrame([("to", 1), ("to", 1), ("be", -1), (None, 1)], "term string, polarity int")
    s = T.lexicon_sentiment(T.term_counts(cut_lineage(_docs(spark))), lex)
    assert _plan(s).count("Exchange hashpartitioning") == 1
    got = {r.doc_id: (r.pos_share, r.neg_share, r.positive) for r in s.collect()}
    assert got == {1: (8 / 11, 3 / 11, 1), 2: (2 / 3, 1 / 3, 1), 3: (0.0, 1.0, 0), 6: (0.0, 0.0, 0), None: (2 / 5, 1 / 5, 1)}


def test_fit_tables_are_dealt_to_parts(spark):
    table = cut_lineage(spark.range(0, 1000, 1, 1).withColumn("x", F.col("id") * 2))
    assert dealt(table, "id", 100).rdd.getNumPartitions() == 10
    assert dealt(table, "id", 1000) is table
    assert sorted(map(tuple, dealt(table, "id", 100).collect())) == [(i, 2 * i) for i in range(1000)]


def test_grid_fits_run_at_a_time(spark):
    import threading

    rows = [(i, float(i % 7), int(i % 7 > 3), f, "train" if i % 2 else "validate") for i in range(60) for f in (1, 2)]
    folds = spark.createDataFrame(rows, "id int, x double, label int, fold int, role string")
    threads = set()

    def pipe_for(max_iter):
        threads.add(threading.get_ident())
        return ML.feature_pipeline(ML.logistic(max_iter=max_iter), [], ["x"])

    out = ML.grid_search(pipe_for, [{"max_iter": 1}, {"max_iter": 5}], folds, score="auc")
    assert [(r.max_iter, r.fold) for r in out.collect()] == [(1, 1), (1, 2), (5, 1), (5, 2)]
    assert all(r.score == 1.0 for r in out.collect()) and len(threads) > 1


def test_vocabulary_share_leaves_the_texts_in_place(spark):
    docs = cut_lineage(_docs(spark))
    vocab = spark.createDataFrame([("to",), ("to",), ("zu",), (None,)], "term string")
    share = T.vocabulary_share(docs, vocab)
    plan = _plan(share)
    assert plan.count("Exchange hashpartitioning") == 1 and "REPARTITION" not in plan
    got = {r.doc_id: r.share for r in share.collect()}
    assert got == {1: 4 / 11, 2: 1 / 3, 3: 0.0, 6: 0.0, None: 1 / 5}


def test_words_are_counted_in_their_row(spark):
    rows = [(1, "en", "to be or not to be"), (2, None, "b a b"), (3, "fr", ""), (4, "fr", None), (None, "en", "be be"),
            (5, "de", "zz zz zz aa")]
    docs = cut_lineage(spark.createDataFrame(rows, "doc_id long, lang string, text string"))
    toks = F.split("text", " ")
    wanted = sorted(((i, l, w, n) for i, l, t in rows for w, n in Counter((t or "").split()).items()), key=str)
    once = T.term_counts(docs.where("text != '' or text is null"), toks=toks, carry=("lang",))
    assert sorted(map(tuple, once.collect()), key=str) == wanted
    assert "Aggregate" not in _plan(once)  # no table of all (document, term) rows
    twice = T.term_counts(docs.where("text != '' or text is null").union(docs.where("doc_id = 1")), toks=toks, carry=("lang",))
    assert {(r.term, r.tf) for r in twice.where("doc_id = 1").collect()} == {("to", 4), ("be", 4), ("or", 2), ("not", 2)}


def test_the_most_frequent_terms_are_not_shuffled(spark, monkeypatch):
    rows = [(d, f"t{i}") for i in range(2_000) for d in range(1 + i % 8)]  # no term has a thousandth of the rows
    tf = cut_lineage(spark.createDataFrame(rows, "doc_id long, term string").withColumn("tf", F.lit(1)))
    terms = cut_lineage(T.document_frequency(tf))
    assert T._hot_df(terms) == 1
    wanted = sorted(map(tuple, tf.join(terms, "term").select("doc_id", "term", "df").collect()))
    for size, least in ((20_000, 8), (100_000, 4), (0, 9)):
        monkeypatch.setattr(T, "LIST_BYTES", size)
        assert T._hot_df(terms) == least
        assert sorted(map(tuple, T.join_terms(tf, terms).select("doc_id", "term", "df").collect())) == wanted


def test_boosted_trees_of_a_large_fold_see_equal_rows_once(spark, monkeypatch):
    rows = [(i, "ab"[i % 5 > 2], float(i % 7), int(i * i % 11 > 4), f, "train" if i % 3 else "validate")
            for i in range(600) for f in (1, 2)]
    folds = cut_lineage(spark.createDataFrame(rows, "id int, c string, x double, label int, fold int, role string"))
    seen, fit = [], ML.GBTClassifier.fit
    monkeypatch.setattr(ML.GBTClassifier, "fit", lambda self, d: seen.append(d.count()) or fit(self, d))

    def pipe_for(iters, step):
        return ML.feature_pipeline(ML.gbt(depth=2, iters=iters, step=step), ["c"], ["x"])

    def scores():
        out = ML.grid_search(pipe_for, [{"iters": 2, "step": s} for s in (0.2, 0.4)], folds, score="auc")
        return {(r.step, r.fold): r.score for r in out.collect()}

    whole = scores()
    assert seen == [400] * 4
    monkeypatch.setattr(ML, "DISTINCT_FROM", 400)
    assert scores() == whole and len(whole) == 4
    assert max(seen[4:]) <= 2 * 7 * 2  # two values of c, seven of x, two labels
