"""Fuzzy search for short license notices.

A notice is searched with at most k edits. By the pigeonhole principle a match
leaves one of k + 1 pieces of the notice untouched, so the pieces are exact
seeds: one Aho-Corasick automaton finds them all in the normalised text. Around
each seed the regex library's bounded-error matching verifies the notice, and
its best match gives the span and the number of edits.
"""

from __future__ import annotations

from functools import lru_cache

import ahocorasick
import regex
from pyspark.sql import DataFrame

from tessera.llm.common import map_rows
from tessera.llm.decontaminate import words_of

#: Phrases that count where their words stand consecutively.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Short notices and their labels, as normalised words.
NOTICES = {
    "licensed under the apache license version 2 0": "apache-2.0",
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "this work is licensed under the gnu general public license": "gpl",
    "licensed under the gnu lesser general public license": "lgpl",
    "subject to the terms of the mozilla public license": "mpl",
    "licensed under a creative commons attribution": "cc-by",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "released into the public domain": "public-domain",
    "all rights reserved": "reserved",
}

#: Characters of a notice for each edit that is allowed.
CHARS_PER_EDIT = 10


class NoticeFinder:
    def __init__(self, notices: dict[str, str], chars_per_edit: int = CHARS_PER_EDIT):
        self.notices = []
        seeds: dict[str, list[tuple[int, int]]] = {}
        for notice, label in notices.items():
            edits = len(notice) // chars_per_edit
            pattern = regex.compile(f"(?b)(?:{regex.escape(notice, literal_spaces=True)}){{e<={edits}}}")
            bounds = [len(notice) * i // (edits + 1) for i in range(edits + 2)]
            for a, b in zip(bounds, bounds[1:]):
                seeds.setdefault(notice[a:b], []).append((len(self.notices), a))
            self.notices.append((notice, label, edits, pattern))
        self.seeds = ahocorasick.Automaton()
        for seed, places in seeds.items():
            self.seeds.add_word(seed, (len(seed), places))
        self.seeds.make_automaton()

    def find(self, text: str) -> list[tuple[int, int, str, float]]:
        """Spans (begin, end, label, similarity) in a normalised text; where
        matches of one notice overlap, that with the fewest edits."""
        windows: dict[int, list[list[int]]] = {}
        for last, (size, places) in self.seeds.iter(text):
            for k, offset in places:
                notice, _, edits, _ = self.notices[k]
                begin = last + 1 - size - offset
                a, b = max(0, begin - edits), min(len(text), begin + len(notice) + edits)
                spans = windows.setdefault(k, [])
                if spans and a <= spans[-1][1]:
                    spans[-1][0], spans[-1][1] = min(a, spans[-1][0]), max(b, spans[-1][1])
                else:
                    spans.append([a, b])
        found = []
        for k, spans in windows.items():
            notice, label, edits, pattern = self.notices[k]
            while spans:
                a, b = spans.pop()
                if a >= b or b - a < len(notice) - edits or not (m := pattern.search(text, a, b)):
                    continue
                found.append((m.start(), m.end(), label, 1 - sum(m.fuzzy_counts) / len(notice)))
                if m.end() > m.start():  # the best match, so others may stand on both sides
                    spans.append((a, m.start()))
                spans.append((max(m.end(), a + 1), b))
        return sorted(found)


@lru_cache(maxsize=4)
def _finder(notices: tuple[tuple[str, str], ...], chars_per_edit: int) -> NoticeFinder:
    return NoticeFinder(dict(notices), chars_per_edit)


def phrase_places(normal: str) -> list[tuple[int, str]]:
    """(first word, label) of every place of a phrase in a normalised text."""
    padded, places = f" {normal} ", []
    for phrase, label in PHRASES.items():
        at = padded.find(f" {phrase} ")
        while at >= 0:
            places.append((padded.count(" ", 0, at), label))
            at = padded.find(f" {phrase} ", at + 1)
    return places


def scan(docs: DataFrame, notices: dict[str, str] | None = None, chars_per_edit: int = CHARS_PER_EDIT) -> DataFrame:
    """Licenses of every whole text.

    Per row: doc_id, n_words, n_base, first_word, last_word, base_labels,
    labels, score, spans. ``n_base`` counts the places of the phrases;
    ``labels`` has their labels and those of the notices found; ``score`` is 1
    with a phrase, else the best notice's share of characters left unedited,
    else 0; ``spans`` lists the notices as label:first word:end word. A null or
    empty text has no words and no labels. Repeated rows are kept.
    """
    fixed = tuple((NOTICES if notices is None else notices).items())

    def make():
        finder = _finder(fixed, chars_per_edit)

        def one(doc_id, text):
            words = words_of(text)
            normal = b" ".join(words).decode()
            places = phrase_places(normal)
            found = finder.find(normal)
            starts = [p for p, _ in places]
            base = {label for _, label in places}
            spans = [f"{label}:{normal.count(' ', 0, a)}:{normal.count(' ', 0, b) + 1}" for a, b, label, _ in found]
            score = 1.0 if base else max((s for *_, s in found), default=0.0)
            return (doc_id, len(words), len(places), min(starts, default=None), max(starts, default=None),
                    ",".join(sorted(base)), ",".join(sorted(base | {label for _, _, label, _ in found})), score,
                    ",".join(spans))

        return one

    return map_rows(docs.select("doc_id", "text"), make,
                    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
                    "labels string, score double, spans string")
