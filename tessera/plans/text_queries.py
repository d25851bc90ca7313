"""Registered queries for text operators (T), J-10 and O-02.

Topic label = ``documents.lang``; outcome = ``labels.quality``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.functions import text as X
from tessera.operators import text as T
from tessera.operators.split import hash_bucket, hash_bucket_sql
from tessera.plans.registry import register
from tessera.session import cut_lineage
from tessera.sources.tables import Tables

_TOK_SQL = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')"
_TF_SQL = f"""(SELECT doc_id, term, count(*) AS tf FROM
               (SELECT doc_id, unnest({_TOK_SQL}) AS term FROM documents) GROUP BY 1, 2)"""


def _tf(t: Tables) -> DataFrame:
    return T.term_counts(t.documents.select("doc_id", "text"))


_STOPS_SQL = "[" + ", ".join(f"'{w}'" for w in dict.fromkeys(X.STOP_WORDS_A)) + "]"


@register("t01_clean_a", sql=rf"""
SELECT doc_id, array_to_string(list_transform(list_filter(list_filter(
         string_split_regex(trim(regexp_replace(lower(text), '[^a-z]', ' ', 'g')), '\s+'),
         lambda w: w != ''), lambda w: NOT list_contains({_STOPS_SQL}, w)),
         lambda w: substring(w, 1, 6)), ' ') AS cleaned
FROM documents""")
def t01_clean_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = Tables(spark, sf_dir).documents
    return d.select("doc_id", X.clean_a("text").alias("cleaned"))


@register("t02_clean_b", sql=r"""
SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(text),
         '_', ' ', 'g'), '[^\p{L}\p{N}_\s]', ' ', 'g'), '(http|com|www)', '', 'g'),
         '(imgur|jpg|png|picture|pic|youtube)', '', 'g') AS cleaned
FROM documents""")
def t02_clean_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = Tables(spark, sf_dir).documents
    return d.select("doc_id", X.clean_b("text").alias("cleaned"))


@register("t03_clean_c", sql=r"""
SELECT page_id, array_to_string(list_transform(list_transform(list_filter(
         string_split_regex(trim(regexp_replace(regexp_replace(lower(html), '<.*?>', '', 'g'),
                                                '[^\p{L}\p{N}_\s]', '', 'g')), '\s+'),
         lambda w: w != ''), lambda w: CASE WHEN regexp_full_match(w, '\p{Nd}+') THEN '#' ELSE w END),
         lambda w: substring(w, 1, 6)), ' ') AS cleaned
FROM pages""")
def t03_clean_c(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = Tables(spark, sf_dir).pages
    return p.select("page_id", X.clean_c("html").alias("cleaned"))


@register("t04_term_counts", sql=f"SELECT doc_id, term, tf FROM {_TF_SQL}")
def t04_term_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tf(Tables(spark, sf_dir))


@register("t05_fixed_vocabulary", sql=f"""
WITH v AS (SELECT DISTINCT unnest({_TOK_SQL}) AS term FROM benchmark)
SELECT doc_id, term, tf FROM {_TF_SQL} WHERE term IN (SELECT term FROM v)""")
def t05_fixed_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts restricted to a given vocabulary: here the words of ``benchmark``."""
    t = Tables(spark, sf_dir)
    vocab = t.benchmark.select(F.explode(X.tokens("text")).alias("term")).distinct()
    return T.restrict_to_vocabulary(_tf(t), vocab)


@register("t06_char_ngrams", sql=r"""
WITH s AS (SELECT regexp_replace(lower(text), '\s\s+', ' ', 'g') AS s FROM conversations),
g AS (SELECT unnest(list_transform(range(1, length(s) - n + 2), lambda i: substring(s, i, n))) AS gram
      FROM s, (VALUES (2), (3)) v(n) WHERE length(s) >= n)
SELECT gram, count(*) AS n FROM g GROUP BY gram""")
def t06_char_ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = Tables(spark, sf_dir).conversations
    grams = F.concat(X.char_ngrams("text", 2), X.char_ngrams("text", 3))
    return c.select(F.explode(grams).alias("gram")).groupBy("gram").agg(
        F.count(F.lit(1)).alias("n"))


@register("t07_word_ngrams", sql=rf"""
WITH t AS (SELECT regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]{{2,}}') AS toks FROM conversations),
g AS (SELECT n, unnest(list_transform(range(1, len(toks) - n + 2),
                       lambda i: array_to_string(toks[i:i + n - 1], ' '))) AS gram
      FROM t, (VALUES (1), (2)) v(n) WHERE len(toks) >= n)
SELECT CAST(n AS INTEGER) AS n, gram, count(*) AS cnt FROM g GROUP BY 1, 2""")
def t07_word_ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = Tables(spark, sf_dir).conversations.select(X.tokens("text").alias("toks"))
    grams = F.concat(
        F.transform(X.word_ngrams("toks", 1), lambda g: F.struct(F.lit(1).alias("n"), g.alias("gram"))),
        F.transform(X.word_ngrams("toks", 2), lambda g: F.struct(F.lit(2).alias("n"), g.alias("gram"))))
    return c.select(F.inline(grams)).groupBy("n", "gram").agg(F.count(F.lit(1)).alias("cnt"))


# The reference's ranges of n-gram sizes.
NGRAM_RANGES = [(2, 2), (1, 2), (2, 3), (1, 3)]


@register("t07_ngram_ranges", sql=rf"""
WITH t AS (SELECT doc_id, {_TOK_SQL} AS toks FROM documents),
g AS (SELECT doc_id, n, unnest(list_transform(range(1, len(toks) - n + 2),
                       lambda i: array_to_string(toks[i:i + n - 1], ' '))) AS gram
      FROM t, (VALUES (1), (2), (3)) v(n) WHERE len(toks) >= n),
c AS (SELECT n, gram, count(*) AS cnt, count(DISTINCT doc_id) AS df FROM g GROUP BY 1, 2)
SELECT lo, hi, count(*) AS vocab_size, CAST(sum(cnt) AS BIGINT) AS n_grams, count(*) FILTER (WHERE df >= 2) AS vocab_min_df_2,
  max(cnt) AS top_count
FROM c, (VALUES {', '.join(f'({a}, {b})' for a, b in NGRAM_RANGES)}) r(lo, hi) WHERE n BETWEEN lo AND hi GROUP BY lo, hi""")
def t07_ngram_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vocabulary of each n-gram range: every gram is counted once, for all ranges that hold it."""
    sizes = T.ngram_sizes(Tables(spark, sf_dir).documents.select("doc_id", X.tokens("text").alias("toks")), "toks")
    ranges = F.array(*[F.struct(F.lit(a).alias("lo"), F.lit(b).alias("hi")) for a, b in NGRAM_RANGES])
    x = sizes.select("*", F.inline(F.filter(ranges, lambda r: F.col("n").between(r["lo"], r["hi"]))))
    return x.groupBy("lo", "hi").agg(*[F.sum(c).alias(c) for c in ("vocab_size", "n_grams", "vocab_min_df_2")],
                                     F.max("top_count").alias("top_count"))


@register("t08_min_df", sql=f"""
SELECT term, count(*) AS df FROM {_TF_SQL} GROUP BY term HAVING count(*) >= 5""")
def t08_min_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.min_df_vocabulary(_tf(Tables(spark, sf_dir)), 5)


@register("t09_vocab_report", sql=f"""
SELECT count(DISTINCT term) AS vocab_size, count(*) AS nnz, count(DISTINCT doc_id) AS n_docs,
       min(term) AS first_term, max(term) AS last_term,
       round(count(*) / count(DISTINCT doc_id), 6) AS avg_nnz,
       round(count(*) * 100.0 / (count(DISTINCT doc_id) * count(DISTINCT term)), 6) AS density_pct
FROM {_TF_SQL}""")
def t09_vocab_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = T.vocabulary_report(_tf(Tables(spark, sf_dir)))
    return r.select("vocab_size", "nnz", "n_docs", "first_term", "last_term",
                    F.round("avg_nnz", 6).alias("avg_nnz"),
                    F.round("density_pct", 6).alias("density_pct"))


def _split_tf(t: Tables):
    tf = _tf(t)
    side = hash_bucket("doc_id", 100, 0) < 80
    return tf.where(side), tf.where(~side)


_SPLIT_SQL = hash_bucket_sql("doc_id", 100, 0)


@register("t10_oov_rate", sql=f"""
WITH tr AS (SELECT * FROM {_TF_SQL} WHERE {_SPLIT_SQL} < 80),
dv AS (SELECT * FROM {_TF_SQL} WHERE {_SPLIT_SQL} >= 80),
u AS (SELECT * FROM dv WHERE term NOT IN (SELECT term FROM tr))
SELECT (SELECT CAST(sum(tf) AS BIGINT) FROM dv) AS dev_tokens,
       (SELECT count(DISTINCT term) FROM dv) AS dev_terms,
       (SELECT CAST(coalesce(sum(tf), 0) AS BIGINT) FROM u) AS oov_tokens,
       (SELECT count(DISTINCT term) FROM u) AS oov_terms""")
def t10_oov_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, dev = _split_tf(Tables(spark, sf_dir))
    return T.out_of_vocabulary(train, dev)


@register("j10_vocab_difference", sql=f"""
SELECT DISTINCT term FROM {_TF_SQL} WHERE {_SPLIT_SQL} >= 80
EXCEPT SELECT term FROM {_TF_SQL} WHERE {_SPLIT_SQL} < 80""")
def j10_vocab_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, dev = _split_tf(Tables(spark, sf_dir))
    return dev.select("term").distinct().join(train.select("term").distinct(), "term", "left_anti")


@register("t11_tfidf", sql=f"""
WITH tf AS {_TF_SQL}, n AS (SELECT count(*) AS n FROM documents),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
w AS (SELECT doc_id, term, tf * (ln((1.0 + n) / (1.0 + df)) + 1) AS w FROM tf JOIN df USING (term), n),
nm AS (SELECT doc_id, sqrt(sum(w * w)) AS norm FROM w GROUP BY doc_id)
SELECT doc_id, term, round(w / nullif(norm, 0), 9) AS w FROM w JOIN nm USING (doc_id)""")
def t11_tfidf(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    w = T.tfidf(_tf(t), n_docs=t.documents.select(F.count(F.lit(1))).scalar())
    return w.select("doc_id", "term", F.round("w", 9).alias("w"))


@register("t12_stop_words", sql=f"""
WITH tf AS {_TF_SQL}, n AS (SELECT count(*) AS n FROM documents),
stop AS (SELECT term FROM tf GROUP BY term HAVING count(*) > (SELECT n FROM n) * 0.5)
SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n_kept FROM tf WHERE term NOT IN (SELECT term FROM stop)
GROUP BY doc_id""")
def t12_stop_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stop list by rule (document frequency above half the corpus), removed
    with an anti join; the reference's fixed list is a parameter of the same
    operator (``remove_stop_words``)."""
    t = Tables(spark, sf_dir)
    tf = cut_lineage(_tf(t))  # read for the list and for what it leaves
    n_docs = t.documents.select(F.count(F.lit(1))).scalar()
    kept = T.remove_stop_words(tf, T.frequent_terms_as_stop_words(tf, 0.5, n_docs))
    return kept.groupBy("doc_id").agg(F.sum("tf").alias("n_kept"))


@register("t12_stop_list", sql=f"""
SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n_kept FROM {_TF_SQL} WHERE NOT list_contains({_STOPS_SQL}, term)
GROUP BY doc_id""")
def t12_stop_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixed stop list of cleaner A, as a table of words."""
    stop = spark.createDataFrame([(w,) for w in dict.fromkeys(X.STOP_WORDS_A)], "term string")
    return T.remove_stop_words(_tf(Tables(spark, sf_dir)), stop).groupBy("doc_id").agg(F.sum("tf").alias("n_kept"))


def _lang_tf(t: Tables) -> DataFrame:
    """Term counts with the topic of the document."""
    return T.term_counts(t.documents.select("doc_id", "lang", "text"), carry=("lang",))


def _topic_words(tf: DataFrame, k: int = 40) -> DataFrame:
    """Top-k terms per topic (lang) by total count, ties by term."""
    per = tf.groupBy("lang", "term").agg(F.sum("tf").alias("cnt"))
    w = Window.partitionBy("lang").orderBy(F.col("cnt").desc(), "term")
    return per.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


_TOPIC_WORDS_SQL = f"""(SELECT lang, term, cnt, rank FROM (
   SELECT lang, term, cnt, row_number() OVER (PARTITION BY lang ORDER BY cnt DESC, term) AS rank
   FROM (SELECT lang, term, sum(tf) AS cnt FROM {_TF_SQL} JOIN documents USING (doc_id)
         GROUP BY 1, 2)))"""


@register("o02_topk_per_group", sql=f"""
SELECT lang, term, CAST(cnt AS BIGINT) AS cnt, rank FROM {_TOPIC_WORDS_SQL} WHERE rank <= 5""")
def o02_topk_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _topic_words(_lang_tf(Tables(spark, sf_dir)), 5).select(
        "lang", "term", "cnt", F.col("rank").cast("long").alias("rank"))


@register("t15_topic_word_hits", sql=f"""
WITH tw AS (SELECT lang AS topic, term AS word FROM {_TOPIC_WORDS_SQL} WHERE rank <= 40),
m AS (SELECT DISTINCT doc_id, term, tf, topic FROM {_TF_SQL} JOIN tw ON contains(term, word))
SELECT doc_id, topic, CAST(sum(tf) AS BIGINT) AS hits FROM m GROUP BY 1, 2""")
def t15_topic_word_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens containing any of a topic's top-40 words (substring match): distinct terms
    and words meet by character keys, so no word leaves the executors and any number of
    words can be matched. The texts are read once."""
    tf = cut_lineage(_lang_tf(Tables(spark, sf_dir)))
    words = cut_lineage(_topic_words(tf, 40).select(F.col("lang").alias("topic"), F.col("term").alias("word")))
    hits = T.substring_matches(tf, words).join(words, "word").select("term", "topic").distinct()
    return tf.join(hits, "term").groupBy("doc_id", "topic").agg(F.sum("tf").alias("hits"))


# Lexicon is a caller-supplied parameter (term, polarity); this one is small on purpose.
_LEXICON = [("the", 1), ("le", 1), ("der", 1), ("el", 1),
            ("and", -1), ("et", -1), ("und", -1), ("y", -1)]


@register("t16_lexicon_sentiment", sql=f"""
WITH tf AS {_TF_SQL}, lex(term, polarity) AS (VALUES {', '.join(f"('{a}', {b})" for a, b in _LEXICON)}),
tot AS (SELECT doc_id, sum(tf) AS n FROM tf GROUP BY 1),
h AS (SELECT doc_id, sum(CASE WHEN polarity > 0 THEN tf ELSE 0 END) AS pos,
             sum(CASE WHEN polarity < 0 THEN tf ELSE 0 END) AS neg FROM tf JOIN lex USING (term) GROUP BY 1)
SELECT doc_id, round(coalesce(pos, 0) / n, 9) AS pos_share, round(coalesce(neg, 0) / n, 9) AS neg_share,
       CAST(coalesce(pos, 0) > coalesce(neg, 0) AS INTEGER) AS positive
FROM tot LEFT JOIN h USING (doc_id)""")
def t16_lexicon_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    lex = spark.createDataFrame(_LEXICON, "term string, polarity int")
    s = T.lexicon_sentiment(_tf(Tables(spark, sf_dir)), lex)
    return s.select("doc_id", F.round("pos_share", 9).alias("pos_share"),
                    F.round("neg_share", 9).alias("neg_share"), "positive")


