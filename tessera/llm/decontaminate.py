"""Benchmark decontamination with a generalised suffix automaton.

The normalised word sequences of a block of benchmark items are compiled into
one generalised suffix automaton. A document's words are streamed through it;
the state and the matching length say at each word which part of an item ends
there. A word is hit when it lies inside an occurrence of a window: ``window``
consecutive words of an item, or the whole of a shorter item.

The items are taken in blocks of a bounded number of words, so neither the
driver nor a task holds more than one block; each block is one pass over the
documents.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import fresh, map_rows
from tessera.session import cut_lineage

WINDOW = 10
#: Words of items in one block: bounds the automaton (at most two states a word).
BLOCK_WORDS = 400_000

#: Lower-cases A-Z and blanks every other ASCII character that is no word character.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isdigit() or 97 <= b <= 122 else 32
              for b in range(256))
_WORD = re.compile("[0-9A-Za-z\x80-\U0010ffff]+")


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_FOLD).split()


class ItemAutomaton:
    """Generalised suffix automaton of items, with the windows marked."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.ids = [item_id for item_id, _ in items]
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = [[self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words] for _, words in items]
        for codes in coded:
            last = 0
            for c in codes:
                last = self._extend(last, c)
        #: state -> items with a window that is the state's string of ``window`` words
        self.windows: dict[int, set[int]] = {}
        #: state -> (length, item) of whole short items among the state's strings
        self.short: dict[int, list[tuple[int, int]]] = {}
        for k, codes in enumerate(coded):
            state = 0
            for i, c in enumerate(codes):
                state = self.next[state][c]
                if i + 1 >= window:
                    state = self._reduced(state)
                    self.windows.setdefault(state, set()).add(k)
            if 0 < len(codes) < window:
                self.short.setdefault(state, []).append((len(codes), k))
        self.least = min([window] + [n for found in self.short.values() for n, _ in found])
        #: nearest state up the links, the state itself left out, that holds a short item
        self.above = [-1] * len(self.next)
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            up = self.link[state]
            self.above[state] = up if up in self.short else self.above[up] if up > 0 else -1

    def _reduced(self, state: int) -> int:
        """The state of the last ``window`` words of what ends here."""
        while self.length[self.link[state]] >= self.window:
            state = self.link[state]
        return state

    def _extend(self, last: int, c: int) -> int:
        there = self.next[last].get(c)
        if there is not None and self.length[there] == self.length[last] + 1:
            return there
        if there is not None:
            return self._split(last, c, there)
        new = self._state({}, self.length[last] + 1)
        at = last
        while at >= 0 and c not in self.next[at]:
            self.next[at][c] = new
            at = self.link[at]
        if at < 0:
            self.link[new] = 0
        else:
            there = self.next[at][c]
            self.link[new] = there if self.length[there] == self.length[at] + 1 else self._split(at, c, there)
        return new

    def _split(self, at: int, c: int, there: int) -> int:
        """A copy of ``there`` for the strings that come by way of ``at``."""
        copy = self._state(dict(self.next[there]), self.length[at] + 1)
        self.link[copy], self.link[there] = self.link[there], copy
        while at >= 0 and self.next[at].get(c) == there:
            self.next[at][c] = copy
            at = self.link[at]
        return copy

    def _state(self, arcs: dict[int, int], length: int) -> int:
        self.next.append(arcs)
        self.link.append(-1)
        self.length.append(length)
        return len(self.next) - 1

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Hit runs of words (begin, end; disjoint, ascending) and the items found."""
        code, arcs, link, length = self.vocabulary.get, self.next, self.link, self.length
        least, window, short = self.least, self.window, self.short
        runs: list[tuple[int, int]] = []
        found: set[int] = set()
        state = matched = 0
        for i, word in enumerate(words):
            c = code(word)
            if c is None:
                state = matched = 0
                continue
            to = arcs[state].get(c)
            while to is None and state:
                state = link[state]
                matched = length[state]
                to = arcs[state].get(c)
            if to is None:
                continue
            state, matched = to, matched + 1
            if matched < least:
                continue
            reach = 0
            if matched >= window:
                reach = window
                found |= self.windows[self._reduced(state)]
            if short:
                for n, k in short.get(state, ()):
                    if n <= matched:
                        reach = max(reach, n)
                        found.add(k)
                up = self.above[state]
                while up > 0:
                    for n, k in short[up]:
                        reach = max(reach, n)
                        found.add(k)
                    up = self.above[up]
            if reach:
                begin = i + 1 - reach
                while runs and runs[-1][1] >= begin:
                    begin = min(begin, runs.pop()[0])
                runs.append((begin, i + 1))
        return runs, found


def joined(a: list[tuple[int, int]], b: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The union of two lists of runs."""
    out: list[tuple[int, int]] = []
    for begin, end in sorted([*a, *b]):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((begin, end))
    return out


def _blocks(benchmark: DataFrame, block_words: int) -> Iterator[list[tuple[str, list[bytes]]]]:
    rows = (benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
            .where(F.col("text").isNotNull()).orderBy("item_id", "text"))
    block, n = [], 0
    for row in rows.toLocalIterator():  # one partition at a time
        words = words_of(row["text"])
        if not words:
            continue
        block.append((row["item_id"] if row["item_id"] is not None else "null", words))
        n += len(words)
        if n >= block_words:
            yield block
            block, n = [], 0
    yield block


@lru_cache(maxsize=1)
def _compiled(key: str, window: int, holder) -> ItemAutomaton:
    return ItemAutomaton(holder.items, window)


class _Block:
    """A block of items under a key, so a worker compiles it once."""

    def __init__(self, key: str, items):
        self.key, self.items = key, items

    def __hash__(self):
        return hash(self.key)

    def __eq__(self, other):
        return self.key == other.key


_RUNS = "array<struct<begin:int,end:int>>"


def scan_documents(docs: DataFrame, benchmark: DataFrame, finish: Callable, schema: str, columns: list[str],
                   window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Run every whole text against all items and map each row once.

    ``finish(values, words, runs, items)`` makes the output row from the row's
    ``columns``, its words, the hit runs and the sorted ids of the items found.
    ``columns`` must include ``text``. Null texts have no words; items with a
    null text or no words have no windows; a null item id counts as "null";
    repeated items and ids count once. An empty benchmark hits nothing.
    """
    spark = docs.sparkSession
    at = columns.index("text")
    rows = docs.select(*columns)
    source = rows.schema
    blocks = _blocks(benchmark, block_words)
    block = next(blocks)
    carried = False
    while block is not None:
        after = next(blocks, None)
        key = hashlib.sha256(repr((window, block)).encode()).hexdigest()
        shared = spark.sparkContext.broadcast(_Block(key, block))

        def make(shared=shared, last=after is None, carried=carried):
            held = shared.value
            automaton = _compiled(held.key, window, held)

            def one(*values):
                before, known = (values[-2], values[-1]) if carried else ([], [])
                values = values[:-2] if carried else values
                words = words_of(values[at])
                runs, found = automaton.scan(words)
                if before:
                    runs = joined([(r["begin"], r["end"]) for r in before], runs)
                items = sorted({automaton.ids[k] for k in found} | set(known))
                if last:
                    return finish(values, words, runs, items)
                return (*values, [{"begin": a, "end": b} for a, b in runs], items)

            return one

        if after is None:
            return map_rows(rows, make, schema)
        kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source)
        more = f"`{fresh(columns, '_runs')}` {_RUNS}, `{fresh(columns, '_items')}` array<string>"
        rows = cut_lineage(map_rows(rows, make, f"{kept}, {more}"))
        carried, block = True, after
    raise AssertionError("unreachable: the last block returns")


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256 (of
    the found item ids, sorted as strings, comma-joined), contaminated."""
    def finish(values, words, runs, items):
        n_hit = sum(b - a for a, b in runs)
        digest = hashlib.sha256(",".join(items).encode()).hexdigest()
        return values[0], len(words), n_hit, len(items), digest, n_hit > 0

    return scan_documents(docs, benchmark, finish, "doc_id long, n_words long, n_hit long, n_items long, "
                          "items_sha256 string, contaminated boolean", ["doc_id", "text"], window, block_words)


def cut_runs(text: str, runs: list[tuple[int, int]]) -> str:
    """The text without the characters from each run's first to its last word."""
    places = [m.span() for m in _WORD.finditer(text)]
    out, at = [], 0
    for begin, end in runs:
        out.append(text[at:places[begin][0]])
        at = places[end - 1][1]
    return "".join([*out, text[at:]])


def remove(docs: DataFrame, benchmark: DataFrame, max_coverage: float = 0.5, window: int = WINDOW,
           block_words: int = BLOCK_WORDS) -> DataFrame:
    """The documents without leaked spans.

    Spans of hit words are cut out of the text; a document of whose words more
    than ``max_coverage`` are hit is dropped whole. Untouched rows are returned
    as they are, with all columns; of a changed row the column ``n_chars``, if
    there is one, is set anew.
    """
    columns = docs.columns
    at = columns.index("text")
    size = columns.index("n_chars") if "n_chars" in columns else None

    def finish(values, words, runs, items):
        if not runs:
            return (*values, True)
        n_hit = sum(b - a for a, b in runs)
        values = list(values)
        if n_hit <= max_coverage * len(words):
            values[at] = cut_runs(values[at], runs)
            if size is not None:
                values[size] = len(values[at])
        return (*values, n_hit <= max_coverage * len(words))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    keep = fresh(columns, "_kept")
    return scan_documents(docs, benchmark, finish, f"{schema}, `{keep}` boolean", columns, window,
                          block_words).where(F.col(keep)).drop(keep)
