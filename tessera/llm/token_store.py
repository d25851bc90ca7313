"""Token ids in files of directly addressable codes.

A shard holds the ids of a run of documents. An id is cut into chunks of
``bits`` bits, lowest first: level 0 has the lowest chunk of every id, level k
the k-th chunk of the ids that need one. Beside the chunks of a level stands a
continuation bitmap (1: the id goes on in the next level) and its rank
directory (ones before each block of 512 bits). The place of an id in the next
level is the rank of its bit, so any token is read with one rank per level and
without decoding its neighbours.

The store is a Parquet table with one row per shard, written by Spark, so it
can live wherever Spark writes. Shards are numbered (part, seq) in ascending
document order.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.session import cut_lineage, scratch_path

#: Tokens after which a shard is closed (at the end of a document).
SHARD_TOKENS = 1 << 20
BLOCK = 512
#: Bits of a chunk.
BITS = 8

STORE_SCHEMA = ("part long, seq long, n_docs long, n_tokens long, doc_ids array<long>, doc_starts array<long>, "
                "chunks array<binary>, more array<binary>, ranks array<binary>")
_BITS_SET = np.array([bin(i).count("1") for i in range(256)], np.uint8)


def pack(ids: np.ndarray) -> tuple[list[bytes], list[bytes], list[bytes]]:
    """Levels of ``ids`` (unsigned): chunks, continuation bitmaps, rank directories."""
    chunks, more, ranks = [], [], []
    rest = ids.astype(np.uint64)
    while True:
        goes_on = rest >> BITS > 0
        bitmap = np.packbits(goes_on, bitorder="little")
        bitmap = np.pad(bitmap, (0, -len(bitmap) % (BLOCK // 8)))
        ones = _BITS_SET[bitmap].reshape(-1, BLOCK // 8).sum(1, dtype=np.uint64)
        chunks.append((rest & ((1 << BITS) - 1)).astype(np.uint8).tobytes())
        more.append(bitmap.tobytes())
        ranks.append(np.concatenate([[0], np.cumsum(ones)]).astype("<u8").tobytes())
        if not goes_on.any():
            return chunks, more, ranks
        rest = rest[goes_on] >> BITS


class Codes:
    """Random access to a packed run of ids."""

    def __init__(self, chunks: list[bytes], more: list[bytes], ranks: list[bytes]):
        self.chunks = [np.frombuffer(c, np.uint8) for c in chunks]
        self.more = [np.frombuffer(m, np.uint8) for m in more]
        self.ranks = [np.frombuffer(r, "<u8") for r in ranks]

    def __len__(self) -> int:
        return len(self.chunks[0])

    def _rank(self, level: int, i: int) -> int:
        block = i // BLOCK
        first = block * (BLOCK // 8)
        whole = self.more[level][first:i // 8]
        part = int(self.more[level][i // 8]) & ((1 << i % 8) - 1)
        return int(self.ranks[level][block]) + int(_BITS_SET[whole].sum()) + int(_BITS_SET[part])

    def get(self, i: int) -> int:
        """The i-th id: one rank in each level that it needs."""
        if not 0 <= i < len(self):
            raise IndexError(i)
        value = level = 0
        while True:
            value |= int(self.chunks[level][i]) << BITS * level
            if not self.more[level][i // 8] >> i % 8 & 1:
                return value
            i, level = self._rank(level, i), level + 1

    def slice(self, begin: int, end: int) -> np.ndarray:
        """ids[begin:end]; touches only these ids' chunks."""
        values = np.zeros(end - begin, np.uint64)
        where = np.arange(end - begin)
        for level in range(len(self.chunks)):
            values[where] |= self.chunks[level][begin:end].astype(np.uint64) << np.uint64(BITS * level)
            if level + 1 == len(self.chunks):
                break
            bits = np.unpackbits(self.more[level][begin // 8:(end + 7) // 8], bitorder="little")
            bits = bits[begin % 8:begin % 8 + end - begin].astype(bool)
            where = where[bits]
            if not len(where):
                break
            begin = self._rank(level, begin)
            end = begin + len(where)
        return values


# -- encoding -----------------------------------------------------------------

#: Distinct runs that a worker remembers (a cache: it changes the time, never a result),
#: and bytes of text that are encoded at a time.
REMEMBERED = 800_000
ENCODED_BYTES = 4 << 20


#: Letters with signs behind them, and words that the pre-tokenizer surely keeps whole.
_TAIL = re.compile(rb"([a-z]+)([!-/:-@\[-`{-~]+)")
_WHOLE = re.compile("[a-zß-öø-ÿ]+")
#: Words that are handed to the library as one text.
JOINED = 1_000


class _Numbers(dict):
    """Numbers its keys in the order in which they are first looked up."""

    def __missing__(self, key):
        at = self[key] = len(self)
        return at


class _Ids(NamedTuple):
    """Runs of ids end to end: run k is ``flat[starts[k]:starts[k + 1]]``."""

    starts: np.ndarray
    flat: np.ndarray

    def gather(self, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the numbered runs, end to end, and how many each has."""
        lengths = self.starts[runs + 1] - self.starts[runs]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        at = np.arange(total) - np.repeat(ends - lengths, lengths) + np.repeat(self.starts[runs], lengths)
        return self.flat[at], lengths


class _Runs:
    """The ids of runs of text. A new run gets a number when it is first looked up, and
    all new ones are encoded together."""

    def __init__(self, encode_words):
        self.encode_words = encode_words
        self.clear()

    def clear(self):
        new = self.new = []

        class Numbers(_Numbers):
            def __missing__(self, run):
                new.append(run)
                return super().__missing__(run)

        self.numbers, self.used = Numbers(), np.zeros(0, np.int64)
        self.ids = _Ids(np.zeros(1, np.int64), np.empty(0, np.uint32))

    def note(self, numbers: np.ndarray) -> None:
        """Count how often the runs were looked up."""
        used = np.bincount(numbers, minlength=len(self.numbers))
        used[:len(self.used)] += self.used
        self.used = used

    def make_room(self) -> None:
        """Forget the runs seen less often than most, once there are too many."""
        if len(self.numbers) <= REMEMBERED:
            return
        least = np.sort(self.used)[-REMEMBERED // 3]
        keep = np.flatnonzero(self.used > least)
        held = [run for run, k in zip(self.numbers, (self.used > least).tolist(), strict=True) if k]
        flat, lengths = self.ids.gather(keep)
        self.clear()
        for run in held:
            self.numbers[run]
        self.new.clear()
        self.ids = _Ids(np.concatenate([[0], np.cumsum(lengths)]), flat)

    def encode_new(self) -> None:
        """Encode the runs that were looked up first since the last call. Signs behind
        letters are a word of their own, so such a run takes the ids of its two parts."""
        if not self.new:
            return
        known = len(self.ids.starts) - 1
        bare, plain, split, parts = [], [], [], []
        for at, run in enumerate(self.new):  # parts that are new themselves join the list
            letters = run.isalpha()
            tail = None if letters else _TAIL.fullmatch(run)
            if tail and b"<|" not in run:
                split.append(at)
                parts += self.numbers[tail[1]], self.numbers[tail[2]]
            else:
                bare.append(at)
                plain.append(letters)
        words = [self.new[at].decode("utf-8") for at in bare]
        starts, flat = self.encode_words(words, plain)
        both = _Ids(np.concatenate([self.ids.starts, self.ids.starts[-1] + starts[1:]]), np.concatenate([self.ids.flat, flat]))
        # where a run's own ids, or those of its parts, stand among the known and the bare ones
        place = np.arange(known + len(self.new))
        place[known + np.array(bare, np.int64)] = known + np.arange(len(bare))
        sizes = np.ones(len(self.new), np.int64)
        sizes[split] = 2
        first = np.cumsum(sizes) - sizes
        pieces = np.empty(sizes.sum(), np.int64)
        pieces[first[bare]] = place[known + np.array(bare, np.int64)]
        at = first[np.array(split, np.int64)]
        pieces[at], pieces[at + 1] = place[np.array(parts[::2], np.int64)], place[np.array(parts[1::2], np.int64)]
        ids, lengths = both.gather(pieces)
        before = np.concatenate([[0], np.cumsum(lengths)])
        self.ids = _Ids(np.concatenate([self.ids.starts, self.ids.starts[-1] + before[np.cumsum(sizes)]]),
                        np.concatenate([self.ids.flat, ids]))
        self.new.clear()


@lru_cache(maxsize=2)
def _encoder(spec: str):
    """A function from the UTF-8 bytes of texts to their ids, end to end, and the
    number of ids of each.

    Where the file's pre-tokenizer drops white space and cuts at it (a removing
    split whose pattern has no white space), a text's ids are those of its runs
    without ASCII white space, one after another; the library then encodes each
    distinct run once while it is remembered. Else it encodes whole texts.
    """
    import json

    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(spec)
    tokenizer.no_truncation()
    tokenizer.no_padding()

    def encode_batch(texts: list[str]):
        return tokenizer.encode_batch_fast(texts, add_special_tokens=False)

    def flat(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [np.array(e.ids, np.uint32) for e in encode_batch(texts)]
        return np.concatenate([np.empty(0, np.uint32), *found]), np.fromiter(map(len, found), np.int64, len(found))

    if not _cuts_at_space(json.loads(spec)):
        return lambda texts: flat([t.decode("utf-8") for t in texts])
    ends_word = np.zeros(tokenizer.get_vocab_size() + 1, bool)
    suffix = json.loads(spec)["model"].get("end_of_word_suffix") or ""
    ends_word[[i for token, i in tokenizer.get_vocab().items() if suffix and token.endswith(suffix)]] = True

    def encode_words(words: list[str], letters: list[bool]) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ids. Many plain words (ASCII letters, as told, or others that are
        surely kept whole) go to the library as one text; the token that ends a word tells
        where it ends. All others are encoded by themselves."""
        plain = np.fromiter((a or _WHOLE.fullmatch(w) is not None for w, a in zip(words, letters, strict=True)), bool,
                            len(words))
        together = [w for w, p in zip(words, plain.tolist(), strict=True) if p]
        ids, _ = flat([" ".join(together[k:k + JOINED]) for k in range(0, len(together), JOINED)])
        ends = np.flatnonzero(ends_word[ids]) + 1
        if len(ends) != len(together):  # a vocabulary without word ends
            plain[:] = False
            ids, ends = ids[:0], ends[:0]
        own, own_sizes = flat([w for w, p in zip(words, plain.tolist(), strict=True) if not p])
        sizes = np.empty(len(words), np.int64)
        sizes[plain], sizes[~plain] = np.diff(ends, prepend=0), own_sizes
        starts = np.concatenate([[0], np.cumsum(sizes)])
        out = np.empty(starts[-1], np.uint32)
        inside = np.repeat(plain, sizes)
        out[inside], out[~inside] = ids, own
        return starts, out

    table = _Runs(encode_words)

    def by_runs(texts: list[bytes]):
        table.make_room()
        # the library lower-cases, but looks for its special tokens before that
        runs = [(t if b"<|" in t else t.lower()).split() for t in texts]  # cuts at ASCII white space
        n = np.fromiter(map(len, runs), np.int64, len(runs))
        look_up = table.numbers.__getitem__
        numbers = np.concatenate([np.fromiter(map(look_up, r), np.int64, len(r)) for r in runs])
        table.encode_new()
        table.note(numbers)
        ids, lengths = table.ids.gather(numbers)
        before = np.concatenate([[0], np.cumsum(lengths)])
        ends = np.cumsum(n)
        return ids, before[ends] - before[ends - n]

    return by_runs


#: Fixed value: the pattern of the removing split that is known to hold no white space.
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _cuts_at_space(spec: dict) -> bool:
    steps = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
    first = steps[0] if steps else {}
    normal = spec["normalizer"] or {}
    kinds = {n["type"] for n in normal.get("normalizers", [normal] if normal else [])}
    return (first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert") is True
            and first.get("pattern") == {"Regex": _WORDS} and kinds <= {"NFC", "Lowercase", "Replace"}
            and all(a["content"].split() == [a["content"]] and not a["single_word"] and not a["lstrip"]
                    and not a["rstrip"] for a in spec["added_tokens"]))


def write_store(docs: DataFrame, tokenizer_path: str, store: str, end_id: int = 2, partitions: int | None = None,
                id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every whole text, append ``end_id`` and write the shards.

    Documents are dealt by ranges of the id (nulls first; equal ids are ordered
    by their text, repeated rows stay), so parts follow each other in ascending
    order. A null or empty text gives ``end_id`` alone. An empty table gives a
    store without shards.
    """
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encode = _encoder(spec.value)
        part, seq = TaskContext.get().partitionId(), 0
        doc_ids, lengths, runs, n = [], [], [], 0

        def shard():
            ids = np.concatenate(runs)
            starts = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
            chunks, more, ranks = pack(ids)
            row = [part, seq, len(doc_ids), len(ids), doc_ids, starts, chunks, more, ranks]
            kinds = [pa.int64()] * 4 + [pa.list_(pa.int64())] * 2 + [pa.list_(pa.binary())] * 3
            names = ["part", "seq", "n_docs", "n_tokens", "doc_ids", "doc_starts", "chunks", "more", "ranks"]
            return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds, strict=True)], names)

        def encoded():
            """doc_id, ids with the end of each document; texts are encoded by the megabyte."""
            keys, texts, held = [], [], 0

            def some():
                ids, sizes = encode(texts)
                at = np.cumsum(sizes)
                with_ends = np.insert(ids, at, end_id) if len(at) else ids
                return zip(keys, np.split(with_ends, (at + np.arange(1, len(at) + 1))[:-1]), strict=True)

            for batch in batches:
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True):
                    keys.append(doc_id)
                    texts.append(text.as_py() or b"")
                    held += len(texts[-1])
                    if held >= ENCODED_BYTES:
                        yield from some()
                        keys, texts, held = [], [], 0
            if keys:
                yield from some()

        for doc_id, ids in encoded():
            doc_ids.append(doc_id)
            lengths.append(len(ids))
            runs.append(ids)
            n += len(ids)
            if n >= SHARD_TOKENS:
                yield shard()
                seq, doc_ids, lengths, runs, n = seq + 1, [], [], [], 0
        if doc_ids:
            yield shard()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first()]
    rows = (rows.repartitionByRange(partitions, order[0]) if partitions else rows.repartitionByRange(order[0]))
    (rows.sortWithinPartitions(*order).mapInArrow(run, STORE_SCHEMA)
     .write.option("compression", "zstd").mode("errorifexists").parquet(store))


def part_starts(shards: DataFrame) -> DataFrame:
    """First token number of each part: a running sum over one row per part."""
    totals = shards.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("part_start"))


def open_store(spark: SparkSession, store: str) -> DataFrame:
    """The shards with ``start``, the number of tokens before each shard."""
    shards = spark.read.schema(STORE_SCHEMA).parquet(store)
    before = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    places = shards.select("part", "seq", "n_tokens").withColumn(
        "in_part", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    # the manifest is written, so that its size in bytes decides how it is joined
    places = cut_lineage(places.join(part_starts(shards), "part").select(
        "part", "seq", (F.col("part_start") + F.col("in_part")).alias("start")))
    return shards.join(places, ["part", "seq"])


def read_documents(spark: SparkSession, store: str) -> DataFrame:
    """Every document's ids, read back: doc_id, start, n_tokens, ids array<long>."""
    def one(codes, begin, end):
        return codes.slice(begin, end).astype(np.int64)

    return _documents(open_store(spark, store), one, "ids array<long>", pa.list_(pa.int64()))


def read_checksums(spark: SparkSession, store: str) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens and the CRC-32 of
    its ids as little-endian unsigned 32-bit integers."""
    def one(codes, begin, end):
        return zlib.crc32(codes.slice(begin, end).astype("<u4").tobytes())

    return _documents(open_store(spark, store), one, "ids_crc32 long", pa.int64())


def _documents(shards: DataFrame, one, column: str, kind: pa.DataType) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                start, doc_ids, at, *levels = (c[k].as_py() for c in batch.columns)
                codes = Codes(*levels)
                at = np.array(at, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids, pa.int64()), pa.array(start + at[:-1]), pa.array(np.diff(at)),
                     pa.array([one(codes, int(a), int(b)) for a, b in zip(at[:-1], at[1:], strict=True)], kind)],
                    ["doc_id", "start", "n_tokens", column.split()[0]])

    return shards.select("start", "doc_ids", "doc_starts", "chunks", "more", "ranks").mapInArrow(
        run, f"doc_id long, start long, n_tokens long, {column}")


def token_at(shards: DataFrame, position: int) -> int:
    """The token at a position of the whole corpus, by direct addressing."""
    row = (shards.where((F.col("start") <= position) & (F.col("start") + F.col("n_tokens") > position))
           .select("start", "chunks", "more", "ranks").first())
    if row is None:
        raise IndexError(position)
    return Codes(row["chunks"], row["more"], row["ranks"]).get(position - row["start"])


def store_checksums(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Write a store under the shared scratch folder and read it back."""
    spark = docs.sparkSession
    store = scratch_path(spark, "tokens")
    write_store(docs, tokenizer_path, store)
    return read_checksums(spark, store)
