"""Quality rules with adaptive thresholds.

Fixed cutoffs misjudge languages and sources whose texts differ, so each
metric's limits are learnt: KLL quantile sketches of the metric are built per
(language, source), merged into one per language and one for everything, and a
group's fences are its quartiles widened by a multiple of the spread. A group
with few documents takes the fences of its language, or of the whole table.
The fences are joined to the documents, which are kept if every metric is
inside. A hot source costs nothing extra: sketches are built within each task
and only these meet.

All of it is DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import fresh, let
from tessera.session import cut_lineage

SPACE = r"[\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

#: Metrics, each with the least spread that its fences assume: where half of a
#: group has one value, a small difference is no outlier yet.
METRICS = {"mean_word_chars": 0.75, "symbol_rate": 0.05, "dup_line_rate": 0.05, "repeat_rate": 0.03}
#: Widths of the fence in spreads.
FENCE = 5.0
#: Documents that a group needs for fences of its own.
MIN_GROUP = 100
KLL_K = 200


def _repeat_words(hashes: Column, window: int) -> Column:
    """Words inside windows whose hash occurs twice or more, from the hashes of
    all windows in order."""
    def body(h):
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def places(s):
            return F.sort_array(F.transform(
                F.filter(s, lambda e, j: ((j > 0) & (F.get(s, j - 1)["h"] == e["h"]))
                         | ((j + 1 < F.size(s)) & (F.get(s, j + 1)["h"] == e["h"]))), lambda e: e["i"]))

        # a marked window covers its words up to the next marked window
        covered = let(let(pairs, places), lambda p: F.aggregate(
            F.sequence(F.lit(0), F.size(p) - 2), F.lit(window).cast("long"),
            lambda n, j: n + F.least(F.lit(window), F.get(p, j + 1) - F.get(p, j))))
        return F.when(F.size(F.array_distinct(h)) < F.size(h), covered).otherwise(F.lit(0).cast("long"))

    return let(hashes, body)


def base_metrics(docs: DataFrame, text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` plus n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words
    (long) in the struct column ``q``. Windows are compared by 64-bit hashes
    within one text. Null texts have no words."""
    text = F.coalesce(F.col(text_col), F.lit(""))

    def body(words):
        n = F.size(words)
        hashed = F.transform(words, lambda w: F.xxhash64(w))
        windows = F.when(n > window, let(hashed, lambda h: F.transform(
            F.sequence(F.lit(0), n - window), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(window)]))))
        return F.struct(
            n.cast("long").alias("n_words"), F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            F.when(n > window, _repeat_words(windows, window)).otherwise(F.lit(0).cast("long"))
            .alias("n_repeat_words"))

    words = let(F.filter(F.split(text, SPACE + "+"), lambda w: w != ""), body)
    lines = let(F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
                lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")
    return docs.withColumn("q", words).withColumn("q", F.col("q").withField(
        "n_symbols", F.regexp_count(text, F.lit(SYMBOLS)).cast("long")).withField("n_dup_lines", lines))


def _rates() -> dict[str, Column]:
    n = F.col("q.n_words")
    return {
        "mean_word_chars": F.when(n > 0, F.col("q.word_chars") / n),
        "symbol_rate": F.when(n > 0, F.col("q.n_symbols") / n),
        "dup_line_rate": F.when(n > 0, F.col("q.n_dup_lines") / n),
        "repeat_rate": F.when(n > 0, F.col("q.n_repeat_words") / n),
    }


def _base_failed() -> Column:
    return (F.col("q.n_words") < MIN_WORDS) | (
        100 * F.col("q.n_repeat_words") > MAX_REPEAT_PERCENT * F.col("q.n_words"))


def fences(measured: DataFrame, fence: float = FENCE, min_group: int = MIN_GROUP) -> DataFrame:
    """One row per (lang, source) of ``measured``: for each metric the array
    ``limits`` of struct(low, high); null limits reject nothing.

    Sketches are taken over the rows that pass the base rules."""
    rates = _rates()
    good = measured.where(~_base_failed()).select("lang", "source", *[c.alias(m) for m, c in rates.items()])
    local = cut_lineage(good.groupBy("lang", "source").agg(
        F.count(F.lit(1)).alias("n"), *[F.kll_sketch_agg_double(m, F.lit(KLL_K)).alias(m) for m in rates]))

    def merged(*keys):
        return local.groupBy(*keys).agg(
            F.sum("n").alias("n"), *[F.kll_merge_agg_double(m, F.lit(KLL_K)).alias(m) for m in rates])

    def limits(rows, name, least=min_group):
        def one(metric, floor):
            low, mid, high = (F.kll_sketch_get_quantile_double(metric, F.lit(q)) for q in (0.25, 0.5, 0.75))
            spread = F.greatest(high - low, F.lit(floor))
            return F.struct((mid - fence * spread).alias("low"), (mid + fence * spread).alias("high"))

        return rows.select(*[c for c in ("lang", "source") if c in rows.columns], F.when(
            F.col("n") >= least, F.array(*[one(m, f) for m, f in METRICS.items()])).alias(name))

    own = limits(local, "own")
    by_lang = limits(merged("lang"), "by_lang").withColumnRenamed("lang", "l2")
    groups = measured.groupBy("lang", "source").agg(F.lit(1).alias("_")).drop("_")
    own = own.select(F.col("lang").alias("l1"), F.col("source").alias("s1"), "own")
    out = (groups.join(own, F.col("lang").eqNullSafe(F.col("l1")) & F.col("source").eqNullSafe(F.col("s1")), "left")
           .join(by_lang, F.col("lang").eqNullSafe(F.col("l2")), "left"))
    # the last resort, also of a small table: one row of limits
    whole = limits(merged(), "overall", 1).first()["overall"]
    if whole is None:
        return out.select("lang", "source", F.coalesce("own", "by_lang").alias("limits"))
    whole = F.array(*[F.struct(F.lit(x["low"]).cast("double").alias("low"), F.lit(x["high"]).cast("double").alias("high"))
                      for x in whole])
    return out.select("lang", "source", F.coalesce("own", "by_lang", whole).alias("limits"))


def judged(measured: DataFrame) -> DataFrame:
    """``measured`` (lang, source, q, ...) plus base_failed and kept."""
    limits = cut_lineage(fences(measured)).select(
        F.col("lang").alias("lang_"), F.col("source").alias("source_"), "limits")
    rows = measured.join(limits, F.col("lang").eqNullSafe(F.col("lang_"))
                         & F.col("source").eqNullSafe(F.col("source_")), "left")
    inside = F.lit(True)
    for k, rate in enumerate(_rates().values()):
        limit = F.get("limits", F.lit(k))
        inside &= F.coalesce((rate >= limit["low"]) & (rate <= limit["high"]), F.lit(True))
    rows = rows.withColumn("base_failed", _base_failed())
    return rows.withColumn("kept", ~F.col("base_failed") & inside).drop("lang_", "source_", "limits")


def report(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept.

    The texts are read once; their metrics are written, sketched and judged.
    Null languages and sources are groups of their own; repeated rows are kept.
    """
    rows = docs.select("doc_id", "lang", "source", "text")
    measured = cut_lineage(base_metrics(rows).drop("text"))
    return judged(measured).select("doc_id", "q.n_words", "q.word_chars", "q.n_symbols", "q.n_dup_lines",
                                   "q.n_repeat_words", "base_failed", "kept")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    columns = docs.columns
    doc = fresh([*columns, "text", "lang", "source"], "_doc")
    whole = docs.select(F.struct(*[F.col(c) for c in columns]).alias(doc))
    rows = whole.select(doc, *[F.col(f"{doc}.{c}").alias(c) for c in ("text", "lang", "source")])
    measured = cut_lineage(base_metrics(rows).drop("text"))
    return judged(measured).where("kept").select(f"{doc}.*")
