"""BPE encoding and decoding with a tokenization automaton.

The merges are compiled, in rank order, into a deterministic automaton over
tokens whose accepted label sequences are exactly the BPE encodings. Start
from the automaton of the base symbols (one state, one loop per symbol). The
gadget of merge ``r: u v -> w``

* cuts the arc labelled ``v`` that leaves the state reached by ``u`` (the state
  is split first, so other ways into it keep that arc);
* adds an arc labelled ``w`` beside every arc ``u`` that can be followed by
  ``v``, leading to a copy of the state reached by ``v``.

After all gadgets a state is named by its last token: the state of ``w`` is the
copy of the state of ``v`` at time ``r``, and the arcs ``w`` are copies of the
arcs ``u`` at time ``r``. So the whole transition table is given by the cuts
with their times and the copy links, and an entry is read off by following the
links back in time. Entries that texts use are kept in a table.

Encoding: every prefix of an accepted path spells the encoding of a prefix of
the word, so each position of the word has at most one state; the path through
the table to the end of the word is searched from left to right, long arcs
first, and is the encoding. Decoding emits the labels of the arcs.
"""

from __future__ import annotations

import hashlib
import json
from functools import lru_cache

import regex
from pyspark.sql import DataFrame

from tessera.llm.common import Memo, flatten, map_rows

#: Fixed value: the split pattern of byte-level BPE files that set ``use_regex``.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

START = -1
BASE = -1
#: Bytes that tell how long the tokens are that begin with them; lengths of shorter tokens.
HEAD, SHORT = 3, (2, 1)


class MergeAutomaton:
    """``symbols``: base token id -> label; ``merges``: (left, right, result)
    ids in rank order. Raises ValueError if a merge makes a token that exists
    already (such files have no deterministic automaton of this form)."""

    def __init__(self, symbols: dict[int, bytes], merges: list[tuple[int, int, int]]):
        self.label = dict(symbols)
        self.made = dict.fromkeys(symbols, BASE)  # token -> time of its gadget
        self.left: dict[int, int] = {}
        self.right: dict[int, int] = {}
        self.cut: dict[tuple[int, int], int] = {}
        self.live = set(symbols)  # tokens that some arc carries
        for time, (u, v, w) in enumerate(merges):
            if w in self.made:
                raise ValueError(f"merge {time} makes token {w} a second time")
            if u in self.live and v in self.live and self._arc(u, v, time):
                self.live.add(w)
            self.made[w], self.left[w], self.right[w] = time, u, v
            self.label[w] = self.label[u] + self.label[v]
            self.cut.setdefault((u, v), time)
        self.token = {self.label[t]: t for t in self.live}
        # first bytes -> lengths of the tokens that begin so, longest first
        self.lengths: dict[bytes, tuple[int, ...]] = {}
        for label in self.token:
            if len(label) >= HEAD:
                self.lengths[label[:HEAD]] = (*self.lengths.get(label[:HEAD], ()), len(label))
        self.lengths = {k: (*sorted(set(v), reverse=True), *SHORT) for k, v in self.lengths.items()}
        self.table = Memo(lambda arc: arc[1] in self.live and self._arc(*arc, len(merges)), 2_000_000)

    def _arc(self, state: int, token: int, time: int) -> bool:
        """Whether the automaton has this arc after the gadgets before ``time``."""
        made, cut = self.made, self.cut
        while True:
            if cut.get((state, token), time) < time:
                return False
            if made[state] > made[token]:  # the state is a copy made by its gadget
                time, state = made[state], self.right[state]
            elif made[token] != BASE:  # the arc is a copy; its gadget cuts before it copies
                time, token = made[token] + 1, self.left[token]
            else:
                return True

    def encode(self, word: bytes) -> list[int]:
        """The path that spells ``word``. The longest arcs are tried first; a position that
        nothing leads on from is left and not tried again, as it can have no other state."""
        token, table, lengths, n = self.token.get, self.table, self.lengths.get, len(word)
        if (whole := token(word)) is not None:
            return [whole]
        ids, ends, dead = [], [0], set()
        state, begin, below = START, 0, n
        while begin < n:
            for size in lengths(word[begin:begin + HEAD], SHORT):
                end = begin + size
                if size < below and end <= n and (t := token(word[begin:end])) is not None \
                        and (state == START or table[state, t]) and end not in dead:
                    ids.append(t)
                    ends.append(end)
                    state, begin, below = t, end, n
                    break
            else:
                if not ids:
                    raise ValueError(f"no path spells {word!r}: a base symbol is missing")
                dead.add(ends.pop())
                ids.pop()
                below = begin - ends[-1]
                state, begin = ids[-1] if ids else START, ends[-1]
        return ids


def _byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabulary files."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(keep)]
    return {chr(b): b for b in keep} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteBpe:
    """Encoder and decoder for a byte-level BPE file of the tokenizers library
    (byte-level pre-tokenizer with its pattern, no normalizer)."""

    def __init__(self, spec: dict):
        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        if model["type"] != "BPE" or pre.get("type") != "ByteLevel" or not pre.get("use_regex", True) \
                or pre.get("add_prefix_space") or spec["normalizer"] is not None:
            raise ValueError("not a byte-level BPE file with the standard split")
        alphabet = _byte_alphabet()
        to_bytes = lambda s: bytes(map(alphabet.__getitem__, s))
        vocab = model["vocab"]
        pairs = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in model["merges"]]
        merged = {a + b for a, b in pairs}
        self.automaton = MergeAutomaton(
            {i: to_bytes(s) for s, i in vocab.items() if s not in merged},
            [(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs])
        added = {a["content"]: a["id"] for a in spec["added_tokens"]}
        self.added = added
        self.label = dict(self.automaton.label) | {i: s.encode() for s, i in added.items()}
        self.split_added = regex.compile("(" + "|".join(
            map(regex.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        self.words = regex.compile(SPLIT).findall
        self.memo = Memo(lambda word: tuple(self.automaton.encode(word.encode())))

    def encode(self, text: str) -> list[int]:
        if self.split_added is None or not any(a in text for a in self.added):
            return list(flatten(map(self.memo.__getitem__, self.words(text))))
        ids: list[int] = []
        for k, piece in enumerate(self.split_added.split(text)):
            ids += [self.added[piece]] if k % 2 else flatten(map(self.memo.__getitem__, self.words(piece)))
        return ids

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.label.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def load(spec: str) -> ByteBpe:
    return ByteBpe(json.loads(spec))


def read_spec(path: str) -> str:
    """The tokenizer file's content; it travels to the tasks by broadcast, so
    executors need not see the driver's path."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def tokenize(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every whole text and decode it again.

    Returns one row per input row: the id, ``ids`` array<int>, ``n_tokens``
    long, ``decoded`` string. Null texts count as empty and give no ids.
    Repeated rows are kept; other columns of ``docs`` are not read.
    """
    spec = docs.sparkSession.sparkContext.broadcast(read_spec(path))

    def make():
        bpe = load(spec.value)

        def one(key, text):
            ids = bpe.encode(text or "")
            return key, ids, len(ids), bpe.decode(ids)

        return one

    kind = docs.schema[id_col].dataType.simpleString()
    return map_rows(docs.select(id_col, text_col), make,
                    f"`{id_col}` {kind}, ids array<int>, n_tokens long, decoded string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Per document the number of tokens and the digests of the ids and of the
    decoded text; the ids themselves don't leave the task. Nulls as in
    :func:`tokenize`."""
    spec = docs.sparkSession.sparkContext.broadcast(read_spec(path))

    def make():
        bpe = load(spec.value)
        decimal = Memo(str, 1 << 20)

        def one(doc_id, text):
            ids = bpe.encode(text or "")
            return (doc_id, len(ids),
                    hashlib.sha256(",".join(map(decimal.__getitem__, ids)).encode()).hexdigest(),
                    hashlib.sha256(bpe.decode(ids).encode()).hexdigest())

        return one

    return map_rows(docs.select("doc_id", "text"), make,
                    "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
