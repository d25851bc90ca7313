"""Line dedup: later copies of repeated line runs are deleted.

The documents are sequences of line ids (blank lines left out). Lines that
occur once end a run, so only the segments of lines that occur twice or more
are kept. Over them a suffix array is built by prefix doubling: the rank of a
suffix at depth 2^k and that of the suffix 2^k lines later, as a pair, give the
rank at depth 2^(k+1). Ranks are places in the sorted order of the suffixes,
so suffixes with equal ranks at a depth form an LCP interval of that depth, and
the interval of any depth m between 2^k and 2^(k+1) is read off two overlapping
ranks, those of the run's first and last 2^k lines.

A repeated run counts from ``min_words`` words on. Every such run is the union
of its least runs: from each line forward, or from each line back, until
``min_words`` words are reached. So the LCP intervals at the depths of the least
runs reveal all of it; in each interval the first place (by document, then
line) stays and the others are deleted. Depths are at most ``min_words`` lines,
which bounds the number of doublings.

All of it is DataFrame expressions. Counting, ranking and the choice of first
places are aggregations that are summed within each task first, and what is
joined back is one row per group, so a line that a third of the documents share
puts no task under load that adaptive execution cannot split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import fresh
from tessera.session import cut_lineage

MIN_WORDS = 50
#: Ranges in which the ids of repeated lines are numbered side by side.
RANGES = 4096

_PLACE = ["d", "th"]


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """d: the id (null: the least number), th: a hash of the text; rows equal in
    both are one document."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("d"),
                       F.xxhash64(text).alias("th"), text.alias("t"))


def _lines(t):
    """Non-blank lines (pos: place among all lines, x: the line without outer blanks)."""
    lines = F.transform(F.split(t, "\n"), lambda x, i: F.struct(i.alias("pos"), F.trim(x).alias("x")))
    return F.filter(lines, lambda s: s["x"].rlike(r"[^\x20\x09-\x0D]"))


def line_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """d, th, seq, pos, h1, h2, words of every non-blank line; words are parted by blanks."""
    hashed = F.transform(_lines(F.col("t")), lambda s: F.struct(
        s["pos"].alias("pos"), F.xxhash64(s["x"]).alias("h1"), F.xxhash64(s["x"], F.lit(1)).alias("h2"),
        (F.length(s["x"]) - F.length(F.replace(s["x"], F.lit(" "), F.lit(""))) + 1).alias("words")))
    return _keyed(docs, id_col, text_col).select("d", "th", F.posexplode(hashed).alias("seq", "s")).select(
        "d", "th", "seq", "s.*")


def _first_ranks(lines: DataFrame) -> DataFrame:
    """h1, h2, r0 of the ids that occur twice or more: r0 - 1 suffixes begin with
    a smaller id. Numbered in ranges of the id, whose totals are summed first."""
    ids = lines.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    ids = cut_lineage(ids.withColumn("part", F.shiftright("h1", 52)))
    totals = ids.groupBy("part").agg(F.sum("n").alias("total"))  # RANGES rows at most
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("part").orderBy("h1", "h2").rowsBetween(Window.unboundedPreceding, -1)
    ids = ids.withColumn("in_part", F.coalesce(F.sum("n").over(within), F.lit(0)))
    return ids.join(F.broadcast(totals), "part").select(
        "h1", "h2", (F.col("start") + F.col("in_part") + 1).alias("r0"))


def _segments(lines: DataFrame, min_words: int) -> DataFrame:
    """Repeated lines with their segment and the least runs that begin (m) or end
    (v) there; 0 where the segment is too short."""
    lines = lines.join(_first_ranks(lines), ["h1", "h2"]).drop("h1", "h2")
    lines = lines.repartition(*_PLACE).dropDuplicates([*_PLACE, "seq"])
    by_doc = Window.partitionBy(*_PLACE).orderBy("seq")
    lines = lines.withColumn("seg", F.col("seq") - F.row_number().over(by_doc))
    seg = Window.partitionBy(*_PLACE, "seg").orderBy("seq")
    lines = lines.withColumn("c", F.sum("words").over(seg.rowsBetween(Window.unboundedPreceding, 0)))
    lines = lines.withColumn("b", F.col("c") - F.col("words"))
    whole = Window.partitionBy(*_PLACE, "seg")
    forward = whole.orderBy("b").rangeBetween(Window.currentRow, min_words - 1)
    back = whole.orderBy("c").rangeBetween(-(min_words - 1), Window.currentRow)

    def least(frame):
        return F.when(F.sum("words").over(frame) >= min_words, F.count(F.lit(1)).over(frame)).otherwise(0).cast("int")

    return lines.select(*_PLACE, "seq", "seg", "pos", "r0", least(forward).alias("m"), least(back).alias("v"))


def _doubled(ranks: DataFrame, k: int) -> DataFrame:
    """Adds r(k+1): suffixes sorted by r(k), then by the r(k) 2^k lines later
    (the end of a segment first)."""
    seg = Window.partitionBy(*_PLACE, "seg").orderBy("seq")
    ranks = ranks.withColumn("s", F.coalesce(F.lead(f"r{k}", 1 << k).over(seg), F.lit(0)))
    pairs = ranks.groupBy(f"r{k}", "s").agg(F.count(F.lit(1)).alias("n"))
    smaller = Window.partitionBy(f"r{k}").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    pairs = pairs.select(F.col(f"r{k}").alias("p"), F.col("s").alias("q"), (
        F.col(f"r{k}") + F.coalesce(F.sum("n").over(smaller), F.lit(0))).alias(f"r{k + 1}"))
    return ranks.join(pairs, (F.col(f"r{k}") == F.col("p")) & (F.col("s") == F.col("q"))).drop("s", "p", "q")


def suffix_ranks(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id",
                 text_col: str = "text") -> tuple[DataFrame, int]:
    """The suffix ranks r0..rK of all repeated lines, and K."""
    lines = cut_lineage(line_table(docs, id_col, text_col))
    ranks = cut_lineage(_segments(lines, min_words))
    deepest = ranks.agg(F.max(F.greatest("m", "v"))).first()[0] or 1
    depth = deepest.bit_length() - 1
    for k in range(depth):
        ranks = cut_lineage(_doubled(ranks, k))
    return ranks, depth


def repeated_runs(ranks: DataFrame, depth: int) -> DataFrame:
    """Least runs at later places: d, th, begin, m (in lines of the document)."""
    run = F.explode(F.array(
        F.struct(F.lit("m").alias("kind"), F.col("seq").alias("begin"), F.col("m").alias("m")),
        F.struct(F.lit("v").alias("kind"), (F.col("seq") - F.col("v") + 1).alias("begin"), F.col("v").alias("m"))))
    runs = ranks.select(*_PLACE, run.alias("run")).select(*_PLACE, "run.*").where("m > 0")
    level = F.lit(0)
    for k in range(1, depth + 1):
        level += F.when(F.col("m") >= 1 << k, 1).otherwise(0)
    runs = runs.withColumn("level", level)
    runs = runs.withColumn("last", F.col("begin") + F.col("m") - F.pow(F.lit(2), "level").cast("int"))
    levels = F.array(*[F.col(f"r{k}") for k in range(depth + 1)])
    table = ranks.select(*_PLACE, F.col("seq").alias("at"), levels.alias("r"))

    def rank_at(rows, place, name):
        return rows.join(table.withColumnRenamed("at", place), [*_PLACE, place]).withColumn(
            name, F.get("r", F.col("level"))).drop("r")

    runs = rank_at(rank_at(runs, "begin", "a"), "last", "z").drop("last", "level")
    interval = ["kind", "m", "a", "z"]
    first = runs.groupBy(*interval).agg(
        F.min(F.struct(*_PLACE, "begin")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    return (runs.join(first, interval).where(F.struct(*_PLACE, "begin") != F.col("first"))
            .select(*_PLACE, "begin", "m"))


def removals(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """d, th, gone: the non-blank lines to delete (by number) of each document that has any."""
    ranks, depth = suffix_ranks(docs, min_words, id_col, text_col)
    gone = repeated_runs(ranks, depth).select(
        *_PLACE, F.explode(F.sequence("begin", F.col("begin") + F.col("m") - 1)).alias("seq")).distinct()
    return cut_lineage(gone.groupBy(*_PLACE).agg(F.collect_list("seq").alias("gone")))


def dedup(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text",
          out_col: str = "clean_text", count_col: str = "n_removed") -> DataFrame:
    """``docs`` plus the text without later copies of repeated runs, and the
    number of lines removed.

    Earlier means the smaller id (null first), then the text's hash, then the
    line. Rows with the same id and text are one document and are edited alike;
    they don't repeat each other. Lines are compared without outer blanks and
    line ends stay as they are. A text with nothing removed is returned as it
    is (null stays null); one of which every line goes becomes empty.
    """
    gone = removals(docs, min_words, id_col, text_col).select(
        F.col("d").alias("_d"), F.col("th").alias("_th"), F.col("gone").alias("_gone"))
    columns = docs.columns
    doc = fresh(columns, "_doc")
    rows = docs.select(F.struct(*[F.col(c) for c in columns]).alias(doc))
    text = F.coalesce(F.col(f"{doc}.{text_col}"), F.lit(""))
    rows = rows.select(
        doc, F.coalesce(F.col(f"{doc}.{id_col}").cast("long"), F.lit(-(1 << 63))).alias("d"),
        F.xxhash64(text).alias("th"))
    # one plan at every size: what is deleted grows with the documents
    rows = rows.join(gone.hint("merge"), (F.col("d") == F.col("_d")) & (F.col("th") == F.col("_th")), "left")
    t = F.col(f"{doc}.{text_col}")
    lines = F.split(t, "\n")
    filled = _lines(t)
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1),
                          F.transform("_gone", lambda s: F.get(filled["pos"], s)))
    clean = F.when(F.col("_gone").isNull(), t).otherwise(
        F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n"))
    return rows.select(f"{doc}.*", clean.alias(out_col),
                       F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias(count_col))


def report(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Per row of ``docs``: doc_id, n_lines (non-blank), n_removed, n_chars and
    sha256 of the remaining text."""
    out = dedup(docs.select("doc_id", "text"), min_words)
    clean = F.coalesce(F.col("clean_text"), F.lit(""))
    return out.select("doc_id", F.size(_lines(F.coalesce("text", F.lit("")))).cast("long").alias("n_lines"),
                      "n_removed", F.length(clean).cast("long").alias("n_chars"),
                      F.sha2(clean, 256).alias("clean_sha256"))


def clean(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with its texts cleaned, all rows and columns kept; ``n_chars``,
    if there is one, follows the text."""
    columns = docs.columns
    new, count = fresh(columns, "_clean_text"), fresh(columns, "_n_removed")
    out = dedup(docs, min_words, out_col=new, count_col=count)
    text = F.col(new)
    return out.select(*[
        text.alias(c) if c == "text" else
        F.when(F.col(count) > 0, F.length(text).cast(docs.schema[c].dataType)).otherwise(F.col(c)).alias(c)
        if c == "n_chars" else F.col(c) for c in columns])


#: DuckDB SQL of ``report``: least runs compared by their text.
REPORT_SQL = r"""
with l as (
  select doc_id, text, i - 1 as pos, trim(s[i]) as x
  from (select doc_id, text, string_split(coalesce(text, ''), chr(10)) as s from documents),
       unnest(range(1, len(s) + 1)) u(i)
), f as (
  select *, length(x) - length(replace(x, ' ', '')) + 1 as w,
         sum(length(x) - length(replace(x, ' ', '')) + 1) over (partition by doc_id order by pos) as c
  from l where regexp_matches(x, '[^ \t\n\v\f\r]')
), r as (
  select doc_id, pos,
    string_agg(x, chr(10) order by pos) over fwd as tm, sum(w) over fwd as wm, max(pos) over fwd as em,
    string_agg(x, chr(10) order by pos) over bck as tv, sum(w) over bck as wv, min(pos) over bck as ev
  from (select *, c - w as b from f)
  window fwd as (partition by doc_id order by b range between current row and 49 following),
         bck as (partition by doc_id order by c range between 49 preceding and current row)
), k as (
  select doc_id, pos as p, em as e, row_number() over (partition by tm order by doc_id, pos) as n from r where wm >= 50
  union all
  select doc_id, ev, pos, row_number() over (partition by tv order by doc_id, pos) from r where wv >= 50
), g as (
  select distinct f.doc_id, f.pos from f join k on f.doc_id = k.doc_id and f.pos between k.p and k.e where k.n > 1
), o as (
  select l.doc_id, count(g.pos) as n_removed,
         coalesce(string_agg(s.raw, chr(10) order by l.pos) filter (where g.pos is null), '') as clean
  from l
  join (select doc_id, i - 1 as pos, s[i] as raw
        from (select doc_id, string_split(coalesce(text, ''), chr(10)) as s from documents),
             unnest(range(1, len(s) + 1)) u(i)) s on s.doc_id = l.doc_id and s.pos = l.pos
  left join g on g.doc_id = l.doc_id and g.pos = l.pos
  group by l.doc_id
)
select o.doc_id, (select count(*) from f where f.doc_id = o.doc_id)::bigint as n_lines, n_removed::bigint as n_removed,
       length(clean)::bigint as n_chars, sha256(clean) as clean_sha256
from o
"""
