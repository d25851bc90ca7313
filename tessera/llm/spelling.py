"""Spelling variant grouping by search schemes on bidirectional FM-indexes.

Words with one edit between them agree exactly in one half: cut a word in two,
and of any word one edit away either starts with the first half or ends with
the second. Both halves of a word are looked up exactly, and the search goes on
across the other half with one inserted, deleted or replaced character.

The vocabulary is dealt to blocks by those halves, so that a word meets every
word that can be near it. A half that very many words share is cut into cells
(a chunk of words against a chunk of queries), each of bounded size. Every block
builds one index over the text ``#word#word...#``: the Burrows-Wheeler
transforms of the text and of its reverse, searched in step. A pattern's state
is its rank interval in both suffix orders. ``left`` and ``right`` steps narrow
one interval by the character's rank and move the other by the number of
smaller characters, so a half is matched outwards from the middle up to its
delimiter, and the search then turns round. All queries of a block take each
step together in arrays.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import cut_lineage

#: A word has at least so many code points, and occurs so often.
MIN_LENGTH = 6
MIN_COUNT = 5
#: A form occurs at least so many times as often as its variant.
FORM_RATIO = 5
#: Of so many (document, run) pairs one loses a character, by its hash.
DROP_EVERY = 199
#: Words, and queries, of a half that meet in one cell; rows dealt to a block.
CELL = 8_192
BLOCK_ROWS = 32_768
#: Distinct words counted together within a task, states that are searched at a time.
COUNTED = 300_000
STATES = 1 << 16
RANK_BLOCK = 64

_LOWER = {65 + i: 97 + i for i in range(26)}


def _runs(least: int) -> re.Pattern:
    return re.compile(f"[A-Za-zÀ-ÿ]{{{least},}}")


def word_counts(docs: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """word, n of the words of all documents with at least ``min_count`` occurrences.

    Null and empty texts have no words; a null id counts as the empty text in
    the hash that drops characters; repeated rows count again. Written as a table.
    """

    def run(batches):
        runs, counts = _runs(MIN_LENGTH), Counter()

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()),
                                               pa.array(counts.values(), pa.int64())], ["word", "n"])

        for rows in batches:
            for at in range(0, rows.num_rows, 512):
                part = rows.slice(at, 512)
                for key, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    if not text:
                        continue
                    salt = zlib.crc32(f"{'' if key is None else key}:".encode())
                    for word, n in Counter(runs.findall(text.translate(_LOWER))).items():
                        h = zlib.crc32(word.encode(), salt)
                        if h % DROP_EVERY == 0:
                            drop = h % len(word)
                            word = word[:drop] + word[drop + 1:]
                            if len(word) < MIN_LENGTH:
                                continue
                        counts[word] += n
                if len(counts) >= COUNTED:
                    yield batch()
                    counts.clear()
        if counts:
            yield batch()

    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counts = rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return cut_lineage(counts.where(F.col("n") >= min_count))


# -- the index ------------------------------------------------------------------

def suffix_order(codes: np.ndarray) -> np.ndarray:
    """Order of the rotations of ``codes``, by prefix doubling (all must differ)."""
    rank = np.unique(codes, return_inverse=True)[1].astype(np.int64)
    n, step = len(codes), 1
    while True:
        key = rank * n + np.roll(rank, -step)
        order = np.argsort(key, kind="stable")
        new = np.concatenate([[0], np.cumsum(key[order][1:] != key[order][:-1])])
        rank[order] = new
        if new[-1] == n - 1 or step >= n:
            return order
        step *= 2


class Ranks:
    """Ranks of characters in the Burrows-Wheeler transform of a text's rotations."""

    def __init__(self, codes: np.ndarray, n_codes: int):
        self.order = suffix_order(codes)
        self.n = len(codes)
        self.bwt = codes[self.order - 1]
        # character-major positions: a look-up gives first row of the character + its rank
        self.places = np.sort(self.bwt * (self.n + 1) + np.arange(self.n))
        blocks = -(-self.n // RANK_BLOCK)
        padded = np.full((blocks + 1) * RANK_BLOCK, n_codes, np.int64)
        padded[:self.n] = self.bwt
        self.rows = padded.reshape(-1, RANK_BLOCK)
        per_block = np.zeros((blocks + 2, n_codes + 2), np.int32)
        np.add.at(per_block, (np.arange(self.n) // RANK_BLOCK + 1, self.bwt + 1), 1)
        self.smaller_before = per_block.cumsum(0, dtype=np.int32).cumsum(1, dtype=np.int32)

    def narrow(self, code, lo, hi):
        """Rows lo, hi of the pattern with ``code`` put before it."""
        key = code * (self.n + 1)
        return np.searchsorted(self.places, key + lo), np.searchsorted(self.places, key + hi)

    def _smaller(self, code, at):
        block = at // RANK_BLOCK
        rest = (self.rows[block] < code[:, None]) & (np.arange(RANK_BLOCK) < (at % RANK_BLOCK)[:, None])
        return self.smaller_before[block, code] + rest.sum(1)

    def smaller(self, code, lo, hi):
        """Characters below ``code`` among rows lo to hi."""
        return self._smaller(code, hi) - self._smaller(code, lo)


class BidirectionalIndex:
    """Words (distinct, not empty) as a delimited text, indexed in both directions."""

    def __init__(self, words: list[str]):
        lengths = np.array([len(w) for w in words], np.int64)
        text = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
        self.letters, codes = np.unique(text, return_inverse=True)
        self.starts = np.cumsum(lengths + 1) - (lengths + 1)  # of the delimiters, code 0
        whole = np.zeros(len(text) + len(words), np.int64)
        inside = np.ones(len(whole), bool)
        inside[self.starts] = False
        whole[inside] = codes + 1
        self.n, self.n_codes = len(whole), len(self.letters) + 1
        self.text = Ranks(whole, self.n_codes)
        self.reverse = Ranks(whole[::-1].copy(), self.n_codes)

    def codes(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the words end to end (-1: not in the index) and their lengths."""
        text = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
        at = np.minimum(np.searchsorted(self.letters, text), len(self.letters) - 1)
        return np.where(self.letters[at] == text, at + 1, -1), np.array([len(w) for w in words], np.int64)

    def step(self, left: bool, code, lo, rlo, size):
        """The states (row in the text's order, row in the reverse's, size) of the
        patterns with ``code`` put to their left or right."""
        side, at = (self.text, lo) if left else (self.reverse, rlo)
        below = side.smaller(code, at, at + size)
        a, b = side.narrow(code, at, at + size)
        return (a, rlo + below, b - a) if left else (lo + below, a, b - a)

    def word_at(self, left: bool, row) -> np.ndarray:
        """Numbers of the words whose delimited patterns have these rows."""
        if left:  # the pattern #word# stands at its first delimiter
            place = self.text.order[row]
        else:  # in the reverse text it starts at the delimiter behind the word
            place = self.n - 1 - self.reverse.order[row]
            place = np.where(place == 0, self.n, place) - 1  # within the word
        return np.searchsorted(self.starts, place, "right") - 1


def near_words(index: BidirectionalIndex, queries: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers (query, indexed word) of all pairs that differ by exactly one edit."""
    codes, lengths = index.codes(queries)
    offsets = np.cumsum(lengths) - lengths
    found = [_one_edit(index, codes, offsets, lengths, left) for left in (False, True)]
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def _one_edit(index, codes, offsets, lengths, left: bool):
    """One scheme. ``left`` False: the first half exactly, then to the right with one
    edit; True: the second half exactly, then to the left."""
    half = lengths // 2
    n = len(lengths)
    query = np.arange(n)
    lo, rlo, size = np.zeros(n, np.int64), np.zeros(n, np.int64), np.full(n, index.n, np.int64)
    # the exact half, from the middle outwards and one delimiter further
    exact = lengths - half if left else half
    for j in range(int(exact.max(initial=0)) + 1):
        on = np.flatnonzero((j <= exact[query]) & (size > 0))
        q = query[on]
        at = offsets[q] + (half[q] + j if left else half[q] - 1 - j)
        code = np.where(j < exact[q], codes[np.clip(at, 0, len(codes) - 1)], 0)
        done = (j > exact[query]) & (size > 0)
        known = code >= 0
        on, q, code = on[known], q[known], code[known]
        new = index.step(not left, code, lo[on], rlo[on], size[on])
        query, lo, rlo, size = (np.concatenate([old[done], more]) for old, more in
                                zip((query, lo, rlo, size), (q, *new), strict=True))
        live = size > 0
        query, lo, rlo, size = query[live], lo[live], rlo[live], size[live]

    out = [(np.empty(0, np.int64),) * 2]
    for at in range(0, len(query), STATES):
        part = slice(at, at + STATES)
        out.append(_other_half(index, codes, offsets, lengths, left, query[part],
                               (lo if left else rlo)[part], size[part]))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def _other_half(index, codes, offsets, lengths, left, query, row, size):
    """Go on across the other half: exact states spend their edit at any place.
    From here on the pattern grows on one side, so its interval there is enough."""
    side = index.text if left else index.reverse
    half = lengths // 2
    total = half if left else lengths - half  # characters of the other half

    def code_at(q, j):
        """The j-th character from the middle on; the delimiter behind the last."""
        at = offsets[q] + (half[q] - 1 - j if left else half[q] + j)
        return np.where(j < total[q], codes[np.clip(at, 0, len(codes) - 1)], 0)

    def narrowed(q, j, code, row, size):
        ok = code >= 0
        q, j, code, row, size = q[ok], j[ok], code[ok], row[ok], size[ok]
        a, b = side.narrow(code, row, row + size)
        ok = b > a
        return q[ok], j[ok], a[ok], (b - a)[ok]

    def branched(q, j, row, size):
        """Each state with every character that can come next, delimiters left out."""
        wide = size > index.n_codes
        # few rows: read their characters; many: try all characters
        which = np.repeat(np.flatnonzero(~wide), size[~wide])
        rows = np.arange(len(which)) - np.repeat(np.cumsum(size[~wide]) - size[~wide], size[~wide]) + row[which]
        pair = np.unique(which * index.n_codes + side.bwt[rows])
        every = np.flatnonzero(wide)
        pair = np.concatenate([pair, (every[:, None] * index.n_codes + np.arange(index.n_codes)).ravel()])
        which, code = pair // index.n_codes, pair % index.n_codes
        which, code = which[code > 0], code[code > 0]
        own = code_at(q[which], j[which])
        a, b = side.narrow(code, row[which], row[which] + size[which])
        ok = b > a
        which, code, own, a, b = which[ok], code[ok], own[ok], a[ok], b[ok]
        inserted = (q[which], j[which], a, b - a)
        other = (code != own) & (j[which] < total[q[which]])
        replaced = (q[which][other], j[which][other] + 1, a[other], (b - a)[other])
        return inserted, replaced

    exact = (query, np.zeros(len(query), np.int64), row, size)
    edited = tuple(np.empty(0, np.int64) for _ in range(4))
    found = []
    while len(exact[0]) or len(edited[0]):
        q, j, row, size = exact
        inserted, replaced = branched(q, j, row, size)
        there = j < total[q]
        deleted = (q[there], j[there] + 1, row[there], size[there])
        # with the edit spent: exactly on, up to and with the delimiter
        q2, j2, row2, size2 = edited
        q2, j2, row2, size2 = narrowed(q2, j2 + 1, code_at(q2, j2), row2, size2)
        ended = j2 > total[q2]
        found.append((q2[ended], row2[ended]))
        edited = tuple(np.concatenate(c) for c in zip(
            (q2[~ended], j2[~ended], row2[~ended], size2[~ended]), inserted, replaced, deleted, strict=True))
        exact = narrowed(q[there], j[there] + 1, code_at(q[there], j[there]), row[there], size[there])
    q, row = (np.concatenate(c) for c in zip(*found, strict=True)) if found else (exact[0], exact[0])
    return q, index.word_at(left, row)


# -- grouping -------------------------------------------------------------------

def _dealt(words: DataFrame) -> DataFrame:
    """block, asks, word, n: every word as a query by its two halves, and as an indexed
    word by each half that a near word can have."""
    word, length = F.col("word"), F.length("word")

    def head(m):
        return F.substring(word, F.lit(1), F.floor(m / 2).cast("int"))

    def tail(m):
        k = F.ceil(m / 2).cast("int")
        return F.substring(word, length - k + 1, k)

    def rows(asks, sizes):
        return [F.struct(F.lit(kind).alias("kind"), half(m).alias("half"), F.lit(asks).alias("asks"))
                for kind, half in (("head", head), ("tail", tail)) for m in sizes]

    keys = F.array_distinct(F.array(*rows(True, [length]), *rows(False, [length - 1, length, length + 1])))
    dealt = words.select("word", "n", F.inline(keys))
    # a half that very many words share is dealt to cells
    chunks = [F.ceil(F.count_if(c) / CELL).cast("int").alias(n) for c, n in ((F.col("asks"), "q"), (~F.col("asks"), "w"))]
    hot = dealt.groupBy("kind", "half").agg(*chunks).where("q > 1 or w > 1")
    dealt = dealt.join(hot, ["kind", "half"], "left").na.fill(1, ["q", "w"])
    own, others = F.when(F.col("asks"), F.col("q")).otherwise(F.col("w")), F.when(
        F.col("asks"), F.col("w")).otherwise(F.col("q"))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("word"), own)).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.greatest(others, F.lit(1)) - 1)))
    cell = F.xxhash64("kind", "half", F.when(F.col("asks"), F.col("own")).otherwise(F.col("other")).cast("int"),
                      F.when(F.col("asks"), F.col("other")).otherwise(F.col("own")).cast("int"))
    dealt = cut_lineage(dealt.select(cell.alias("cell"), "asks", "word", "n"))
    blocks = max(1, -(-dealt.count() // BLOCK_ROWS))
    # as many partitions as blocks: small rows that mean much work are not put together
    return dealt.select(F.pmod("cell", F.lit(blocks)).alias("block"), "asks", "word", "n").repartition(blocks, "block")


def near_pairs(words: DataFrame) -> DataFrame:
    """word, near, near_n: all pairs of ``words`` (word, n; distinct) that differ by
    one inserted, deleted or replaced code point, in both directions."""

    def search(rows: pa.Table) -> pa.Table:
        asks = rows["asks"].to_numpy()
        names, n = np.array(rows["word"].to_pylist(), object), rows["n"].to_numpy()
        queries = sorted(set(names[asks]))
        indexed = dict(zip(names[~asks], n[~asks], strict=True))
        held = sorted(indexed)
        pairs = np.empty(0, np.int64)
        if queries and held:
            q, w = near_words(BidirectionalIndex(held), queries)
            pairs = np.unique(q * len(held) + w)
        q, w = (pairs // len(held)).tolist(), (pairs % len(held)).tolist() if held else []
        return pa.table({"word": pa.array([queries[k] for k in q], pa.string()),
                         "near": pa.array([held[k] for k in w], pa.string()),
                         "near_n": pa.array([indexed[held[k]] for k in w], pa.int64())})

    found = _dealt(words).groupBy("block").applyInArrow(search, "word string, near string, near_n long")
    return found.distinct()


def variants(words: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of ``words`` (word, n; distinct).

    A word's form is its most frequent near word (ties: the least), if that occurs
    ``FORM_RATIO`` times as often; its root is the last of the forms that follow
    each other, or itself. An empty table gives no rows.
    """
    best = near_pairs(words).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("best"))
    near = words.join(best, "word", "left").withColumn(
        "form", F.when(-F.col("best.m") >= FORM_RATIO * F.col("n"), F.col("best.near")))
    near = cut_lineage(near.select("word", "form", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                   F.when(F.col("form").isNotNull(), -F.col("best.m")).alias("form_n")))
    # follow the forms by pointer doubling: counts rise fivefold, so chains are short
    linked = near.where("form is not null").select("word", F.col("form").alias("root"))
    more = linked.select(F.col("word").alias("root"), F.lit(False).alias("last"))
    state = cut_lineage(linked.join(more, "root", "left").select(
        "word", "root", F.coalesce("last", F.lit(True)).alias("last")))
    while not (moving := state.where(~F.col("last"))).isEmpty():
        goals = state.select(F.col("word").alias("root"), F.col("root").alias("root2"), F.col("last").alias("last2"))
        moved = moving.join(goals, "root").select("word", F.col("root2").alias("root"), F.col("last2").alias("last"))
        state = cut_lineage(moved.unionByName(state.where("last")))
    return near.join(state.select("word", "root"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def report(docs: DataFrame) -> DataFrame:
    """``variants`` of the words of all documents."""
    return variants(word_counts(docs))
