"""Text cleaning and tokenising as built-in column expressions (no UDFs).

Regex classes are spelled out (``\\p{L}``, ``\\p{N}``) so that Java's regex
engine, RE2 and Python agree on non-ASCII letters: the documents are in four
languages and ``\\w`` is ASCII-only in Java but Unicode in Python.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[\p{L}\p{N}_]"
TOKEN_RE = WORD + "{2,}"                 # CountVectorizer's default token: 2+ word chars
NOT_WORD_OR_SPACE = r"[^\p{L}\p{N}_\s]"  # Python's [^\w\s]

# English stop words used by cleaner A (topic classification).
# Kept verbatim, in their original order (including the repeated 'and').
STOP_WORDS_A = [
    'and', 'hers', 'between', 'but', 'again', 'there', 'about', 'once',
    'during', 'out', 'very', 'having', 'with', 'they', 'own', 'an', 'be', 'some', 'for', 'do',
    'its', 'yours', 'such', 'into', 'of', 'most', 'other', 'off', 'is', 's', 'am', 'or',
    'who', 'as', 'from', 'him', 'each', 'the', 'until', 'below', 'are', 'we', 'these',
    'your', 'his', 'through', 'don', 'nor', 'me', 'were', 'her', 'more', 'himself', 'this', 'down',
    'should', 'our', 'their', 'while', 'above', 'both', 'up', 'to', 'ours', 'had', 'she', 'all',
    'no', 'when', 'at', 'any', 'before', 'them', 'same', 'and', 'been', 'have', 'in', 'will', 'on',
    'does', 'then', 'that', 'because', 'what', 'over', 'why', 'so', 'can', 'did',
    'not', 'now', 'under', 'he', 'you', 'herself', 'has', 'just', 'where', 'too', 'only',
    'which', 'those', 'i', 'after', 'few', 'whom', 't', 'being', 'if', 'theirs', 'my', 'against',
    'a', 'by', 'doing', 'it', 'how', 'further', 'was', 'here', 'than',
]

# Substrings deleted by cleaner B (link words, then image words).
LINK_WORDS = ["http", "com", "www"]
IMAGE_WORDS = ["imgur", "jpg", "png", "picture", "pic", "youtube"]


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_a(text: str | Column, stop_words: Sequence[str] = STOP_WORDS_A, cut: int = 6) -> Column:
    """T-01: lower, non a-z -> space, drop stop words, cut words to ``cut`` letters,
    join with single spaces."""
    s = F.regexp_replace(F.lower(_c(text)), r"[^a-z]", " ")
    words = F.filter(F.split(F.trim(s), r"\s+"), lambda w: w != "")
    stops = list(dict.fromkeys(stop_words))
    # isin over many literals becomes a hash-set lookup (InSet) in Catalyst.
    kept = F.filter(words, lambda w: ~w.isin(stops))
    return F.array_join(F.transform(kept, lambda w: F.substring(w, 1, cut)), " ")


def clean_b(text: str | Column) -> Column:
    """T-02: lower, '_' -> space, punctuation -> space, then delete link words and
    image words wherever they occur (also inside longer words)."""
    s = F.lower(_c(text))
    s = F.regexp_replace(s, "_", " ")
    s = F.regexp_replace(s, NOT_WORD_OR_SPACE, " ")
    s = F.regexp_replace(s, "(" + "|".join(LINK_WORDS) + ")", "")
    return F.regexp_replace(s, "(" + "|".join(IMAGE_WORDS) + ")", "")


def clean_c(text: str | Column, cut: int = 6) -> Column:
    """T-03: lower, strip tags ``<.*?>``, drop punctuation, whole numbers -> '#',
    cut every word to ``cut`` characters, join with single spaces.

    After punctuation removal a token is a run of word characters, so a number
    "between word boundaries" is exactly an all-digit token.
    """
    s = F.regexp_replace(F.lower(_c(text)), "<.*?>", "")
    s = F.regexp_replace(s, NOT_WORD_OR_SPACE, "")
    words = F.filter(F.split(F.trim(s), r"\s+"), lambda w: w != "")
    words = F.transform(words, lambda w: F.when(w.rlike(r"^\p{Nd}+$"), F.lit("#")).otherwise(w))
    return F.array_join(F.transform(words, lambda w: F.substring(w, 1, cut)), " ")


def tokens(text: str | Column, pattern: str = TOKEN_RE) -> Column:
    """T-04: lower-cased word tokens (2+ word characters) as an array."""
    return F.regexp_extract_all(F.lower(_c(text)), F.lit(pattern), 0)


def char_ngrams(text: str | Column, n: int) -> Column:
    """T-06: all character n-grams of the lower-cased text after collapsing runs
    of two or more whitespace characters into one space."""
    s = F.regexp_replace(F.lower(_c(text)), r"\s\s+", " ")
    # A zero-width lookahead yields every overlapping n-gram in one linear scan
    # (substring(s, i, n) in a loop would rescan the string for every i).
    return F.regexp_extract_all(s, F.lit(f"(?s)(?=(.{{{n}}}))"), 1)


def word_ngrams(toks: str | Column, n: int) -> Column:
    """T-07: word n-grams (space-joined) of a token array; empty if too short."""
    t = _c(toks)
    grams = F.transform(F.sequence(F.lit(1), F.size(t) - n + 1),
                        lambda i: F.array_join(F.slice(t, i, n), " "))
    return F.when(F.size(t) >= n, grams).otherwise(F.array().cast("array<string>"))


def word_ngram_range(toks: str | Column, least: int, most: int) -> Column:
    """T-07: the word n-grams of every size from ``least`` to ``most``, as structs (n, gram)."""
    def sized(n: int) -> Column:
        return F.transform(word_ngrams(toks, n), lambda g: F.struct(F.lit(n).alias("n"), g.alias("gram")))

    return F.concat(*[sized(n) for n in range(least, most + 1)])


def word_ngram_starts(toks: str | Column) -> Column:
    """T-07: the word n-grams of one to three words, as structs (head, third) per word: the
    gram of up to two words that starts there, and the word after it, null at the end. Every
    n-gram of the range is the beginning of one of them."""
    t = _c(toks)
    starts = F.transform(F.sequence(F.lit(1), F.size(t)), lambda i: F.struct(
        F.array_join(F.slice(t, i, 2), " ").alias("head"), F.get(t, i + 1).alias("third")))
    return F.when(F.size(t) >= 1, starts)
