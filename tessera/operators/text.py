"""Document-term work on a long coordinate table ``(doc_id, term, tf)``.

The sparse matrix of the reference is a long table here: every statistic
(document frequency, IDF, norms, vocabulary reports) is an aggregate or an
equi-join on ``term`` or ``doc_id``, so nothing is ever densified, collected or
held per document on one task. Small vocabularies (stop lists, lexicons,
fixed vocabularies) are joined after a bounded size check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.text import tokens as token_array
from tessera.functions.text import word_ngram_starts
from tessera.operators.ranking import counts_with_prefix
from tessera.session import cut_lineage


def term_counts(docs: DataFrame, doc_id: str = "doc_id", text: str | Column = "text",
                toks: Column | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """T-04: (doc_id, carry..., term, tf) from the text's word tokens.

    The texts are dealt by document before they are taken apart, so one shuffle of the
    texts stands for one of all their words, and sums per document need no other. A text's
    words are counted in its own row, by the runs of equal words once they are sorted; only
    where documents come in several rows are these counts added up by a table of terms."""
    keys = [doc_id, *carry]
    t = toks if toks is not None else token_array(text)
    words = docs.repartition(doc_id).select(*keys, F.sort_array(t).alias("_s"))
    starts = F.filter(F.sequence(F.lit(0), F.size("_s") - 1),
                      lambda i: (i == 0) | (F.get("_s", i) != F.get("_s", i - 1)))
    runs = words.select(*keys, "_s", F.when(F.size("_s") > 0, starts).alias("_b"))
    rows = runs.select(*keys, F.inline(F.transform("_b", lambda b, j: F.struct(
        F.get("_s", b).alias("term"),
        (F.coalesce(F.get("_b", j + 1), F.size("_s")) - b).cast("long").alias("tf")))))
    if docs.groupBy(doc_id).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).isEmpty():
        return rows
    return rows.groupBy(*keys, "term").agg(F.sum("tf").alias("tf"))


def ngram_sizes(docs: DataFrame, toks: str, doc_id: str = "doc_id") -> DataFrame:
    """T-07: for n-grams of 1, 2 and 3 words: (n, vocab_size, n_grams, vocab_min_df_2, top_count).

    A row per word, dealt by the two words that start there, is all that is shuffled: the
    grams of three words lie with their two first, and those of one word are summed from
    the counts of two. The least and the largest document tell whether a gram is in two
    (rows without a document's key are one document).
    """
    rows = docs.select(doc_id, F.inline(word_ngram_starts(toks))).repartition("head")
    ends = [F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.max("none").alias("none")]
    in_two = (F.col("lo") < F.col("hi")) | (F.col("none") & F.col("lo").isNotNull())
    facts = ["vocab_size", "n_grams", "vocab_min_df_2", "top_count"]

    def counted(df: DataFrame, n: int, is_gram: Column) -> DataFrame:
        """With the facts of each row as a gram of ``n`` words; zeros if it is none."""
        values = [F.lit(1), F.col("cnt"), F.coalesce(in_two, F.lit(False)).cast("int"), F.col("cnt")]
        return df.withColumns({f"{f}{n}": F.when(is_gram, v.cast("long")).otherwise(0) for f, v in zip(facts, values)})

    def carried(n: int) -> list[Column]:
        return [(F.max if f == "top_count" else F.sum)(f"{f}{m}").alias(f"{f}{m}") for m in range(n, 4) for f in facts]

    three = rows.groupBy("head", "third").agg(
        F.count(F.lit(1)).alias("cnt"), F.min(doc_id).alias("lo"), F.max(doc_id).alias("hi"),
        F.max(F.col(doc_id).isNull()).alias("none"))
    three = counted(three, 3, F.col("third").isNotNull())
    two = three.groupBy("head").agg(F.sum("cnt").alias("cnt"), *ends, *carried(3))
    two = counted(two, 2, F.contains("head", F.lit(" ")))
    one = two.groupBy(F.substring_index("head", " ", 1).alias("head")).agg(F.sum("cnt").alias("cnt"), *ends, *carried(2))
    total = counted(one, 1, F.lit(True)).agg(*carried(1))
    sizes = F.array(*[F.struct(F.lit(n).alias("n"), *[F.col(f"{f}{n}").alias(f) for f in facts]) for n in (1, 2, 3)])
    return total.select(F.inline(sizes)).where(F.col("vocab_size") > 0)


def document_frequency(tf: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """(term, df): number of documents holding the term."""
    return tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def min_df_vocabulary(tf: DataFrame, min_df: int) -> DataFrame:
    """T-08: terms present in at least ``min_df`` documents."""
    return document_frequency(tf).where(F.col("df") >= min_df)


#: Bytes of a list of terms that may be broadcast.
LIST_BYTES = 16 << 20


def _listed(terms: DataFrame) -> DataFrame:
    """A table of terms, written once; broadcast if it is small, so that the rows it meets stay where they are."""
    terms = cut_lineage(terms)
    size = terms.agg(F.sum(F.octet_length("term") + 32)).first()[0] or 0
    return F.broadcast(terms) if size <= LIST_BYTES else terms


def restrict_to_vocabulary(tf: DataFrame, vocab: DataFrame) -> DataFrame:
    """T-05 / T-08: keep only vocabulary terms (semi join, broadcast when small)."""
    return tf.join(_listed(vocab.select("term").distinct()), "term", "left_semi")


def vocabulary_share(docs: DataFrame, vocab: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """T-05: (doc_id, share): share of a document's tokens that ``vocab`` holds; none without tokens.

    The texts are taken apart once where they lie: a small vocabulary is broadcast, and only
    two sums per document (and place) are shuffled."""
    known = _listed(vocab.select("term").distinct()).withColumn("_in", F.lit(True))
    rows = docs.select(doc_id, F.explode(token_array(text)).alias("term")).join(known, "term", "left")
    sums = rows.groupBy(doc_id).agg(F.count("_in").alias("_h"), F.count(F.lit(1)).alias("_n"))
    return sums.select(doc_id, (F.col("_h") / F.col("_n")).alias("share"))


def remove_stop_words(tf: DataFrame, stop: DataFrame) -> DataFrame:
    """T-12: drop stop words (anti join, broadcast when small)."""
    return tf.join(_listed(stop.select("term").distinct()), "term", "left_anti")


def frequent_terms_as_stop_words(tf: DataFrame, max_df_share: float,
                                 n_docs: Column | None = None) -> DataFrame:
    """Stop list by rule: terms found in more than ``max_df_share`` of documents
    (``n_docs``: corpus size; default: documents present in ``tf``)."""
    if n_docs is None:
        n_docs = tf.select(F.count_distinct("doc_id")).scalar()
    return document_frequency(tf).where(F.col("df") > n_docs * max_df_share).select("term")


#: Terms that this share of all (document, term) rows hold are joined apart in any case: at
#: most its inverse in number.
HOT_SHARE = 1 / 1000


def _hot_df(terms: DataFrame) -> float:
    """The least document frequency of the terms that are joined apart: as many of the most
    frequent as a broadcast table may hold, by the number of binary digits of ``df``."""
    size = F.octet_length("term") + 16 * (len(terms.columns) + 2)
    levels = terms.groupBy(F.length(F.bin("df")).alias("digits")).agg(F.sum("df").alias("rows"), F.sum(size).alias("size"))
    levels = sorted(levels.collect(), reverse=True)
    least, held = HOT_SHARE * sum(r["rows"] for r in levels), 0
    for r in levels:
        held += r["size"]
        if held > LIST_BYTES:
            break
        least = min(least, 2 ** (r["digits"] - 1))
    return least


def join_terms(tf: DataFrame, terms: DataFrame) -> DataFrame:
    """Rows of ``tf`` with the values of their term; ``terms`` has one row per term and
    its document frequency ``df``. Both should be tables, they are read twice.

    The rows of hot terms, most of a corpus, meet a broadcast table of bounded size and
    are never shuffled; what is left has no key with more than a small share of the rows.
    """
    least = _hot_df(terms)
    hot = terms.where(F.col("df") >= least)
    rest = terms.where(F.col("df") < least)
    cold = tf.join(F.broadcast(hot.select("term")), "term", "left_anti")
    return tf.join(F.broadcast(hot), "term").unionByName(cold.join(rest, "term"))


def tfidf(tf: DataFrame, doc_id: str = "doc_id", normalize: bool = True,
          n_docs: Column | None = None, written: bool = False) -> DataFrame:
    """T-11: smooth TF-IDF, ``tf * (ln((1 + n) / (1 + df)) + 1)``, rows L2-normalised.

    n is the corpus size (pass the document table's row count, which includes
    documents without any term; default: documents present in ``tf``); df is
    joined on term, hot terms apart; the row norm is a window over the document's
    distinct terms. The counts are written once and read for df and for the join;
    ``written``: they are (but for a cheap filter) a table already.
    """
    tf = tf.select(doc_id, "term", "tf")
    tf = tf if written else cut_lineage(tf)
    if n_docs is None:
        n_docs = tf.select(F.count_distinct(doc_id)).scalar()
    idf = F.log((F.lit(1.0) + n_docs) / (F.lit(1.0) + F.col("df"))) + 1.0
    w = join_terms(tf, cut_lineage(document_frequency(tf, doc_id))).select(doc_id, "term", "tf", (F.col("tf") * idf).alias("w"))
    if not normalize:
        return w
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(doc_id)))
    return w.select(doc_id, "term", "tf", (F.col("w") / F.nullif(norm, F.lit(0.0))).alias("w"))


#: Longest key of a substring match.
KEY_CHARS = 4


def substring_matches(terms: DataFrame, words: DataFrame, term: str = "term", word: str = "word") -> DataFrame:
    """(term, word): the distinct terms that contain each distinct word.

    A word's key is its first characters, up to ``KEY_CHARS``; a term has the keys that
    start at each of its characters, in every length. Terms and words meet by an
    equi-join on the key, and the match is verified. Empty words match nothing.
    """
    t = terms.where(F.col(term).isNotNull()).select(F.col(term).alias("term")).distinct()
    w = words.where(F.length(word) > 0).select(F.col(word).alias("word")).distinct()
    w = w.select("word", F.substring("word", 1, KEY_CHARS).alias("key"))
    starts = F.sequence(F.lit(1), F.length("term"))
    keys = F.array_distinct(F.flatten(F.transform(starts, lambda i: F.transform(
        F.sequence(F.lit(1), F.least(F.lit(KEY_CHARS), F.length("term") - i + 1)), lambda n: F.substring("term", i, n)))))
    keyed = t.where(F.length("term") > 0).select("term", F.explode(keys).alias("key"))
    return keyed.join(w, "key").where(F.contains("term", "word")).select("term", "word").distinct()


def term_vectors(tf: DataFrame, doc_id: str = "doc_id", weight: str = "tf", carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, carry..., vector): the rows of a coordinate table as sparse vectors, structs of
    ascending ``indices`` and ``values``; a term's index is its place in the sorted vocabulary.
    A vector is as long as its document has distinct terms."""
    numbers = counts_with_prefix(tf.select("term").distinct(), "term").select("term", F.col("before").alias("i"))
    rows = tf.join(numbers, "term").groupBy(doc_id, *carry).agg(
        F.array_sort(F.collect_list(F.struct("i", F.col(weight).cast("double").alias("w")))).alias("_v"))
    return rows.select(doc_id, *carry, F.struct(F.col("_v.i").alias("indices"), F.col("_v.w").alias("values")).alias("vector"))


def vocabulary_report(tf: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """T-09: vocabulary size, non-zeros, documents, average non-zeros per
    document, density in percent, first and last term in sort order.

    Terms and documents are counted apart, each by one aggregate per key: distinct
    counts side by side would take every row once per count."""
    terms = tf.groupBy("term").agg(F.count(F.lit(1)).alias("n")).agg(
        F.count("term").alias("vocab_size"), F.coalesce(F.sum("n"), F.lit(0)).alias("nnz"),
        F.min("term").alias("first_term"), F.max("term").alias("last_term"))
    n_docs = tf.select(doc_id).distinct().agg(F.count(doc_id).alias("n_docs")).select("n_docs").scalar()
    return terms.select("vocab_size", "nnz", n_docs.alias("n_docs"), "first_term", "last_term").select(
        "*", (F.col("nnz") / F.nullif(F.col("n_docs"), F.lit(0))).alias("avg_nnz"),
        (F.col("nnz") * 100.0 / F.nullif(F.col("n_docs") * F.col("vocab_size"), F.lit(0))).alias("density_pct"))


def out_of_vocabulary(train_tf: DataFrame, dev_tf: DataFrame) -> DataFrame:
    """T-10: share of dev tokens (and distinct terms) unseen in the training
    vocabulary (J-10 anti join)."""
    vocab = train_tf.select("term").distinct()
    unseen = dev_tf.join(vocab, "term", "left_anti")
    tot = dev_tf.agg(F.sum("tf").alias("dev_tokens"), F.count_distinct("term").alias("dev_terms"))
    oov = unseen.agg(F.coalesce(F.sum("tf"), F.lit(0)).alias("oov_tokens"),
                     F.count_distinct("term").alias("oov_terms"))
    return tot.select(
        "dev_tokens", "dev_terms",
        oov.select("oov_tokens").scalar().alias("oov_tokens"),
        oov.select("oov_terms").scalar().alias("oov_terms"))


def lexicon_sentiment(tf: DataFrame, lexicon: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """T-16: per document, positive and negative token shares from a
    (term, polarity in {1, -1}) lexicon; flag = positive share > negative."""
    signs = lexicon.where(F.col("term").isNotNull()).groupBy("term").agg(
        F.count_if(F.col("polarity") > 0).alias("_p"), F.count_if(F.col("polarity") < 0).alias("_m"))
    x = tf.join(_listed(signs), "term", "left").groupBy(doc_id).agg(
        F.sum("tf").alias("_n"), F.coalesce(F.sum(F.col("tf") * F.col("_p")), F.lit(0)).alias("_pos"),
        F.coalesce(F.sum(F.col("tf") * F.col("_m")), F.lit(0)).alias("_neg"))
    return x.select(doc_id, (F.col("_pos") / F.col("_n")).alias("pos_share"),
                    (F.col("_neg") / F.col("_n")).alias("neg_share"),
                    (F.col("_pos") > F.col("_neg")).cast("int").alias("positive"))
