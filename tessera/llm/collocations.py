"""Phrase collocation mining on a weighted de Bruijn graph.

The longest grams (``LONGEST`` words) are the edges of a graph whose nodes are
the grams one word shorter; an edge leads from the gram without its last word
to the one without its first. Only edges are counted in the texts. A gram at
the end of a piece has no next word and is counted as an end: every shorter
tail of a piece gives one. Shorter counts then follow without reading a text
again: a gram occurs as often as all that goes on from it, its edges and its
ends, so the counts of each length are the flows out of the nodes.

Tasks count edges within chunks of words before anything is shuffled. Rows are
dealt by node, so that edges and node flows come from one shuffle; the few
nodes that a large share of the words pass (found on a part of the documents,
which changes only the work) are dealt by their next word as well.

Edges that reach the least count form the candidate graph. Its unary paths
(nodes with one edge in and one out) are compacted by pointer doubling; they
are kept as rows (path, place), so a path of any length is never one value.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import cut_lineage

LONGEST = 3
MIN_COUNT = 10
#: A shorter phrase goes if a longer one has this share (percent) of its occurrences.
CONTAINED_PERCENT = 50
TOP = 2_000
SCALE = 1_000_000
#: Words that are counted together within a task, and words that a task remembers.
CHUNK_WORDS = 2_000_000
REMEMBERED = 350_000
#: Nodes that this share of the words pass are dealt by their next word too.
HOT_SHARE = 1 / 1000
HOT_PARTS = 64
#: One document in so many is read to find them.
HOT_EVERY = 64

#: Fixed values: the bytes at which texts are cut into pieces, A-Z to a-z.
_CUTS = b".,;:!?\n\x0b\x0c\r"
_END = 0xFF  # no byte of UTF-8
_TABLE = bytes(_END if b in _CUTS else b + 32 if 65 <= b <= 90 else b for b in range(256))


class _Words:
    """Numbers of the (lang, word) pairs seen so far; 0 stands for the end of a piece."""

    def __init__(self):
        self.clear()

    def clear(self):
        self.names, self.tables = [b""], {}

    def table(self, lang: str) -> dict:
        if lang not in self.tables:
            names = self.names

            class Numbers(dict):
                def __missing__(self, word):
                    at = self[word] = len(names)
                    names.append(word)
                    return at

            self.tables[lang] = Numbers({bytes([_END]): 0})
        return self.tables[lang]


def _numbers(text: str | None, table: dict) -> np.ndarray:
    """The words of a text as numbers; 0 between pieces and at the end."""
    tokens = (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).replace(b"\xff", b" \xff ").split()
    tokens.append(b"\xff")
    return np.fromiter(map(table.__getitem__, tokens), np.int64, len(tokens))


def _grams(words: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows of ``size`` numbers starting at each word, zero from the end
    of its piece on, and their counts. ``words`` ends with zeros."""
    starts = np.flatnonzero(words)
    padded = np.concatenate([words, np.zeros(size, np.int64)])
    bits = max(1, int(words.max(initial=0)).bit_length())
    alive = np.ones(len(starts), bool)

    def columns():
        nonlocal alive
        for j in range(size):
            column = np.where(alive, padded[starts + j], 0)
            alive = column != 0
            yield column

    if bits * size > 63:
        return np.unique(np.stack(list(columns()), 1), axis=0, return_counts=True)
    packed = np.zeros(len(starts), np.int64)
    for column in columns():
        packed = packed << bits | column
    packed, counts = np.unique(packed, return_counts=True)
    mask = (1 << bits) - 1
    rows = np.stack([packed >> bits * (size - 1 - j) & mask for j in range(size)], 1)
    return rows, counts


def _chunks(batches, read):
    """Deal the texts of a task to chunks; ``read(langs)`` gives the batches of a chunk,
    where ``langs`` maps each lang to its words."""
    words, held, n = _Words(), {}, 0
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                numbers = _numbers(text, words.table(lang))
                held.setdefault(lang, []).append(numbers)
                n += len(numbers)
                if n >= CHUNK_WORDS:
                    yield from read(held, words.names)
                    held, n = {}, 0
                    if len(words.names) > REMEMBERED:
                        words.clear()
    if n:
        yield from read(held, words.names)


def _joined(rows: np.ndarray, names: pa.Array) -> pa.Array:
    """The words of each row, blank-joined, without the ends."""
    text = names.take(pa.array(rows[:, 0]))
    for j in range(1, rows.shape[1]):
        there = pa.array(rows[:, j] > 0)
        more = pc.binary_join_element_wise(text, names.take(pa.array(rows[:, j])), " ")
        text = pc.if_else(there, more, text)
    return text


def _named(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                       F.col("text").cast("string").alias("text"))


def hot_nodes(docs: DataFrame, longest: int = LONGEST) -> set[tuple[str, str]]:
    """Nodes that a large share of the words of some documents pass: at most 1 / HOT_SHARE."""

    def run(batches):
        def read(held, names):
            names = pa.array(names, pa.binary()).cast(pa.string())
            for lang, parts in held.items():
                rows, counts = _grams(np.concatenate(parts), longest - 1)
                whole = rows[:, -1] > 0  # shorter ends are no nodes
                often = whole & (counts >= HOT_SHARE / 2 * counts.sum())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * (int(often.sum()) + 1), pa.string()),
                     pa.concat_arrays([_joined(rows[often], names), pa.array([None], pa.string())]),
                     pa.array(np.append(counts[often], counts.sum()))], ["lang", "node", "n"])

        yield from _chunks(batches, read)

    part = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(HOT_EVERY)) == 0)
    found = _named(part).mapInArrow(run, "lang string, node string, n long").groupBy("lang", "node").agg(
        F.sum("n").alias("n"))
    total = found.where("node is null").agg(F.sum("n")).scalar()
    return {(r["lang"], r["node"]) for r in
            found.where(F.col("node").isNotNull() & (F.col("n") >= HOT_SHARE * total)).collect()}


def edge_counts(docs: DataFrame, longest: int = LONGEST, hot: set | frozenset = frozenset()) -> DataFrame:
    """lang, node, next, salt, n: chunk counts of the edges and ends. ``node`` has
    ``longest - 1`` words, or fewer at the end of a piece; ``next`` is null at an end."""
    hot = docs.sparkSession.sparkContext.broadcast(frozenset(hot))

    def run(batches):
        def read(held, names):
            names = pa.array(names, pa.binary()).cast(pa.string())
            for lang, parts in held.items():
                rows, counts = _grams(np.concatenate(parts), longest)
                hot_here = pa.array([n for k, n in hot.value if k == lang], pa.string())
                for at in range(0, len(rows), 50_000):
                    some = rows[at:at + 50_000]
                    node, more = _joined(some[:, :-1], names), some[:, -1]
                    after = pc.if_else(pa.array(more > 0), names.take(pa.array(more)), pa.scalar(None, pa.string()))
                    salt = np.zeros(len(some), np.int32)
                    if len(hot_here):
                        for k in np.flatnonzero(pc.is_in(node, hot_here).to_numpy(zero_copy_only=False)):
                            salt[k] = 1 + zlib.crc32((after[k].as_py() or "").encode()) % HOT_PARTS
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(some), pa.string()), node, after, pa.array(salt),
                         pa.array(counts[at:at + 50_000].astype(np.int64))], ["lang", "node", "next", "salt", "n"])

        yield from _chunks(batches, read)

    return _named(docs).mapInArrow(run, "lang string, node string, next string, salt int, n long")


def _stacked(df: DataFrame, keep: list, names: list[str], *rows: tuple) -> DataFrame:
    """Each row of ``df`` several times, as the tuples of ``rows`` say; those whose
    first value is null fall away."""
    values = [v for row in rows for v in row]
    return df.select(*keep, F.stack(F.lit(len(rows)), *values).alias(*names)).where(F.col(names[0]).isNotNull())


def phrase_counts(docs: DataFrame, longest: int = LONGEST, min_count: int = MIN_COUNT) -> DataFrame:
    """lang, size, phrase, f of all phrases of 1 to ``longest`` (two or more) words
    with at least ``min_count`` occurrences, and a row of size 0 per lang: all its
    words. Null and empty texts have no words; a null lang is ``und``; repeated
    rows count again. An empty table gives no rows. Written as a table.
    """
    edges = edge_counts(docs, longest, hot_nodes(docs, longest))
    edges = edges.repartition("lang", "node", "salt").groupBy("lang", "node", "salt", "next").agg(F.sum("n").alias("n"))
    # An edge adds to the flow of its node, and goes on itself if frequent; dealt as
    # before, so this needs no shuffle.
    frequent = F.col("next").isNotNull() & (F.col("n") >= min_count)
    flows = _stacked(edges, ["lang", "node", "salt"], ["edge", "last", "n"],
                     (F.lit(False), F.lit(None).cast("string"), F.col("n")),
                     (F.when(frequent, F.lit(True)), F.col("next"), F.col("n")))
    flows = flows.groupBy("lang", "node", "salt", "edge", "last").agg(F.sum("n").alias("n"))
    # A node's flow is its count, and adds to the count of its first words.
    size = F.size(F.split("node", " "))
    node = ~F.col("edge") & (size == longest - 1)
    kept = F.col("edge") | (size < longest - 1) | (F.col("n") >= min_count) | (F.col("salt") > 0)
    counts = _stacked(flows, ["lang"], ["size", "phrase", "f"],
                      (F.when(kept, F.when(F.col("edge"), F.lit(longest)).otherwise(size)),
                       F.concat_ws(" ", "node", "last"), F.col("n")),
                      (F.when(node, F.lit(longest - 2)), _first_words(F.col("node"), longest - 2), F.col("n")))
    counts = counts.groupBy("lang", "phrase", "size").agg(F.sum("f").alias("f"))
    for k in range(longest - 2, 0, -1):
        here = F.col("size") == k
        counts = _stacked(counts, ["lang"], ["size", "phrase", "f"],
                          (F.when(~here | (F.col("f") >= min_count), F.col("size")), F.col("phrase"), F.col("f")),
                          (F.when(here, F.lit(k - 1)), _first_words(F.col("phrase"), k - 1), F.col("f")))
        counts = counts.groupBy("lang", "phrase", "size").agg(F.sum("f").alias("f"))
    return cut_lineage(counts.where((F.col("f") >= min_count) | (F.col("size") == 0)))


def _first_words(phrase, k):
    """The first ``k`` words of a phrase; ``k`` may be a column."""
    return F.call_function("substring_index", phrase, F.lit(" "), F.lit(k).cast("int"))


def _but_first(phrase):
    return F.substring(phrase, F.instr(phrase, " ") + F.lit(1), F.length(phrase))


def unary_paths(counts: DataFrame, longest: int = LONGEST) -> DataFrame:
    """lang, path, place, phrase, f: the edges of the candidate graph, compacted.

    ``counts`` is that of ``phrase_counts``. Edges are on one path if they follow
    each other through a unary node; ``path`` is the phrase of the first and
    ``place`` counts from 0. The path's text is its first edge and the last word
    of each further one. A ring of unary nodes starts at its least phrase.
    """
    edges = counts.where(F.col("size") == longest).select("lang", "phrase", "f")
    into = edges.groupBy("lang", _but_first(F.col("phrase")).alias("node")).agg(
        F.count(F.lit(1)).alias("n_in"), F.min("phrase").alias("before"))
    out = edges.groupBy("lang", _first_words(F.col("phrase"), longest - 1).alias("node")).agg(
        F.count(F.lit(1)).alias("n_out"), F.min("phrase").alias("phrase"))
    linked = into.join(out, ["lang", "node"]).where("n_in = 1 and n_out = 1 and before != phrase").select(
        "lang", "phrase", "before")
    linked = cut_lineage(linked)
    places, rings = _places(linked)
    if rings is not None:
        broken = rings.where("phrase != least").select("lang", "phrase").join(linked, ["lang", "phrase"])
        places = places.unionByName(_places(broken)[0])
    return edges.join(places, ["lang", "phrase"], "left").select(
        "lang", F.coalesce("path", "phrase").alias("path"), F.coalesce("place", F.lit(0)).cast("long").alias("place"),
        "phrase", "f")


def _places(linked: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Of (lang, phrase, before): lang, phrase, path (the first of its chain) and
    place, by pointer doubling; and (lang, phrase, least) of those on rings, or None.
    Rounds grow with the logarithm of the longest chain; only counts reach the driver."""
    there = linked.select("lang", F.col("phrase").alias("before"), F.lit(False).alias("at_start"))
    state = cut_lineage(linked.join(there, ["lang", "before"], "left").select(
        "lang", "phrase", F.col("before").alias("path"), F.lit(1).cast("long").alias("place"),
        F.least("phrase", "before").alias("least"), F.coalesce("at_start", F.lit(True)).alias("ended")))
    n, step = state.count(), 1
    while not (moving := state.where(~F.col("ended"))).isEmpty():
        if step > n:  # no chain is that long: what still moves is on rings
            return state.where("ended").select("lang", "phrase", "path", "place"), moving.select(
                "lang", "phrase", "least")
        goals = state.select("lang", F.col("phrase").alias("path"), F.col("path").alias("path2"),
                             F.col("place").alias("place2"), F.col("least").alias("least2"),
                             F.col("ended").alias("ended2"))
        moved = moving.join(goals, ["lang", "path"]).select(
            "lang", "phrase", F.col("path2").alias("path"), (F.col("place") + F.col("place2")).alias("place"),
            F.least("least", "least2").alias("least"), F.col("ended2").alias("ended"))
        state, step = cut_lineage(moved.unionByName(state.where("ended"))), 2 * step
    return state.select("lang", "phrase", "path", "place"), None


def collocations(docs: DataFrame, longest: int = LONGEST, min_count: int = MIN_COUNT, top: int = TOP) -> DataFrame:
    """The best ``top`` phrases of each lang by the least score of their cuts, as
    lang, rank, phrase, a, l, r, n, score, k (the cut), path and place (where the
    phrase, or the first edge that holds it, stands in the compacted graph).

    Exact as long as no count passes 10^16 (decimal arithmetic). Ties of a score
    take the smallest cut; equal phrases cannot be. Fewer candidates give fewer rows.
    """
    counts = phrase_counts(docs, longest, min_count)
    paths = cut_lineage(unary_paths(counts, longest))
    candidates = counts.where("size >= 2")
    # the longer phrase with one word more decides: a still longer one occurs no more often
    but_last = _first_words(F.col("phrase"), F.col("size") - 1)
    longer = candidates.where("size > 2").select(
        "lang", F.explode(F.array(but_last, _but_first(F.col("phrase")))).alias("phrase"), "f")
    longer = longer.groupBy("lang", "phrase").agg(F.max("f").alias("f_longer"))
    kept = candidates.join(longer, ["lang", "phrase"], "left").where(
        F.col("f_longer").isNull() | (100 * F.col("f_longer") < CONTAINED_PERCENT * F.col("f")))

    k = F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")
    cuts = kept.select("lang", "phrase", F.col("f").alias("a"), "size", k)
    first = _first_words(F.col("phrase"), F.col("k"))
    cuts = cuts.withColumn("first", first).withColumn(
        "rest", F.substring(F.col("phrase"), F.length("first") + 2, F.length("phrase")))
    ends = counts.where((F.col("size") >= 1) & (F.col("size") < longest))
    cuts = cuts.join(ends.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"]).join(
        ends.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    score = F.expr(f"({SCALE}BD * cast(a as decimal(16,0)) * cast(a as decimal(16,0))) "
                   "div (cast(l as decimal(16,0)) * cast(r as decimal(16,0)))")
    scored = cuts.withColumn("score", score).groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "k", "l", "r", "a", "size")).alias("cut")).select("lang", "phrase", "cut.*")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)

    words = counts.where("size = 0").select("lang", F.col("f").alias("n"))
    places = paths.select("lang", "phrase", "path", "place")
    return (best.join(words, "lang").join(places, ["lang", "phrase"], "left")
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n",
                    F.col("score").cast("long").alias("score"), F.col("k").cast("int").alias("k"), "path", "place"))


#: DuckDB SQL of the report for small tables.
REPORT_SQL = r"""
with p as (
  select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?

]')) as piece from documents
), w as (
  select lang, list_filter(regexp_split_to_array(piece, '[ 	]+'), lambda x: x <> '') as s from p
), g as (
  select lang, 1 as k, unnest(s) as phrase from w
  union all
  select lang, 2, unnest(list_transform(range(1, len(s)), lambda i: s[i] || ' ' || s[i + 1])) from w
  union all
  select lang, 3, unnest(list_transform(range(1, len(s) - 1), lambda i: s[i] || ' ' || s[i + 1] || ' ' || s[i + 2]))
  from w
), f as (
  select lang, k, phrase, count(*) as f from g group by all
), n as (
  select lang, sum(f)::bigint as n from f where k = 1 group by lang
), c as (
  select lang, k, phrase, f as a, string_split(phrase, ' ') as s from f where k > 1 and f >= 10
), h as (
  select lang, array_to_string(s[1:2], ' ') as phrase, a from c where k = 3
  union all select lang, array_to_string(s[2:3], ' '), a from c where k = 3
), m as (
  select lang, phrase, max(a) as longer from h group by all
), d as (
  select c.* from c left join m on m.lang = c.lang and m.phrase = c.phrase
  where c.k = 3 or m.longer is null or 100 * m.longer < 50 * c.a
), y as (
  select lang, phrase, a, 1 as j, s[1] as p1, array_to_string(s[2:k], ' ') as p2 from d
  union all
  select lang, phrase, a, 2, array_to_string(s[1:2], ' '), s[3] from d where k = 3
), x as (
  select y.lang, y.phrase, y.a, j, l.f as l, r.f as r,
    (1000000::hugeint * y.a * y.a) // (l.f::hugeint * r.f) as score
  from y join f l on l.lang = y.lang and l.phrase = p1 join f r on r.lang = y.lang and r.phrase = p2
), b as (
  select * from x qualify row_number() over (partition by lang, phrase order by score, j) = 1
), o as (
  select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from b
)
select o.lang, o.rank::bigint as rank, o.phrase, o.a::bigint as a, o.l::bigint as l, o.r::bigint as r, n.n,
  o.score::bigint as score
from o join n on n.lang = o.lang where o.rank <= 2000
"""


def report(docs: DataFrame) -> DataFrame:
    """``collocations`` with the contract's columns."""
    return collocations(docs).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
