"""N-gram Jaccard join by parity sketches.

A document is the set of its word shingles. Each shingle flips one bit of a
sketch of 2^40 bits (kept sparse), so the Hamming distance of two sketches is
at most the symmetric difference of the sets. Documents that link at a
similarity of 4/5 differ in at most a quarter of the shingles of either.

Candidates come from pigeonholes. Per size band the sketch is cut into blocks;
a document gives the fingerprints (XOR of its odd bits' codes) of its first
``n // 4 + 1`` blocks that are not zero. Of two that link, the one whose prefix
ends first has more such blocks in it than bits can differ, so one of them is
equal in the other, where it is not zero either and lies in its prefix: both
give the same key. A document with fewer non-zero blocks gives them all and, if
needed, its zero blocks too: when only zero blocks agree, both sides are such.

Shingles that a large share of the documents hold would make keys that a large
share holds. The sketches are therefore first built without them; the bound on
the difference holds for what is left as well. A document with too little left
also gives the keys of its whole set, by the same rule. Which shingles count as
frequent changes the work, never the result.

Equal sets are one class from the start, named by a 64-bit fingerprint. Pairs
whose dense sketches differ in more bits than those of linked sets can are
never emitted; all others are verified on the sets themselves. A dense sketch
has about a bit for each shingle, so that it tells long sets apart as well, and
folds to the length of a shorter one by XOR of its halves. First
each class is paired with one hub, the least holder of one of its keys. Then
the holders of a key that these links leave in different components are
compared within the tasks: once each with the nearest before it, and after that
with all. So links within a component that is known already are the only ones
not looked at, and groups of copies give pairs in proportion to their members.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Memo, fresh
from tessera.llm.components import components
from tessera.session import cut_lineage

SHINGLE = 5
#: Similarity 4/5: links have 100 * intersection >= 80 * union.
PERCENT = 80
#: Blocks of a band by its largest size; enough that few documents run short of non-zero blocks.
BLOCKS_PER_SHINGLE = 0.3
#: Share of the documents from which a shingle counts as frequent. At most
#: (mean set size / share) shingles are, which bounds what is broadcast.
FREQUENT_SHARE = 1 / 400
#: Shingles that are counted together within a task: bounds its memory.
COUNT_CHUNK = 1_000_000
#: Least and most bits of a dense sketch (powers of two). Between them it has a
#: bit for each shingle; beyond, fewer pairs are told apart before verification.
SKETCH_BITS = (1 << 10, 1 << 17)
#: Pairs, and words of sketches, that are compared at a time: bounds a task's memory.
COMPARED = 1 << 18
#: Holders of a key that are compared together.
CELL = 4096
#: Pairs of one node that are verified in one cell.
PARTNERS = 512
#: Bits of the map of wanted documents, a filter of fixed size before an exact join.
WANTED_BITS = 1 << 24

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                 0xA0761D6478BD642F], np.uint64)


def _mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit finaliser (splitmix)."""
    x = x + np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def _word_hashes() -> Memo:
    return Memo(xxhash.xxh3_64_intdigest)


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles; empty without words."""
    words = (text or "").encode().translate(_LOWER).split()  # cuts at \x20 and \x09-\x0D
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(_word_hashes().__getitem__, words), np.uint64, n)
    size = min(n, SHINGLE)
    total = hashes[:n - size + 1] * _ODD[0]
    for j in range(1, size):
        total = total + hashes[j:n - size + 1 + j] * _ODD[j]
    return np.unique(_mix(total, size))


def set_class(shingles: np.ndarray) -> int:
    """A 64-bit fingerprint of a set (signed)."""
    total = _mix(shingles, 12).sum(dtype=np.uint64)
    return int(_mix(np.array([total], np.uint64), len(shingles))[0].view(np.int64))


def dense_sketch(shingles: np.ndarray) -> np.ndarray:
    """The parities of the shingles by their lower bits, as 64-bit words (signed)."""
    least, most = SKETCH_BITS
    bits = min(most, max(least, 1 << (len(shingles) - 1).bit_length()))
    odd = np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def _distances(words: np.ndarray, starts: np.ndarray, lengths: np.ndarray, i: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Hamming distances of sketches i and k (arrays of numbers). Sketch number x
    is ``words[starts[x]:starts[x] + lengths[x]]``; the longer one is folded."""
    length = np.minimum(lengths[i], lengths[k])
    out = np.empty(len(i), np.int64)

    def folded(rows, n):
        first = starts[rows][:, None] + np.arange(n)
        got, at = words[first], n
        while (more := lengths[rows] > at).any():
            got[more] ^= words[first[more] + at]
            at += n
        return got

    for n in np.unique(length):
        same = np.flatnonzero(length == n)
        step = max(1, COMPARED // int(n))
        for at in range(0, len(same), step):
            part = same[at:at + step]
            out[part] = np.bitwise_count(folded(i[part], n) ^ folded(k[part], n)).sum(1, dtype=np.int64)
    return out


def _sketch_column(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """words (unsigned: counts of signed ones are of absolute values), starts, lengths."""
    offsets = column.offsets.to_numpy().astype(np.int64)
    words = column.values.to_numpy(zero_copy_only=False)[offsets[0]:offsets[-1]].view(np.uint64)
    return words, offsets[:-1] - offsets[0], np.diff(offsets)


def _blocks(shingles: np.ndarray, n_blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and fingerprints of the sketch's non-zero blocks, in order."""
    if not len(shingles):
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    bits = shingles >> np.uint64(24)
    block = (bits * np.uint64(n_blocks)) >> np.uint64(40)
    first = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
    prints = np.bitwise_xor.reduceat(_mix(bits, 3), first)  # equal bits cancel: parity
    odd = prints != 0
    return block[first][odd], prints[odd]


def sketch_keys(shingles: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """The pigeonhole keys of a set. Sets of three and fewer link only with
    themselves and have none."""
    n = len(shingles)
    need = n // 4 + 1
    if need < 2:
        return np.empty(0, np.uint64)
    band = n.bit_length()
    bands = [band] + [band + 1] * (5 * n >= 4 << band)  # a partner has at most 5n/4 shingles
    if len(frequent):
        at = np.searchsorted(frequent, shingles)
        at[at == len(frequent)] = 0
        rare = shingles[frequent[at] != shingles]
    else:
        rare = shingles
    keys = []
    for b in bands:
        n_blocks = int(np.ceil(BLOCKS_PER_SHINGLE * (1 << b)))
        for kind, held in enumerate((rare, shingles)):
            block, prints = _blocks(held, n_blocks)
            short = len(block) < need
            if kind and short:  # whole set: the zero blocks count as well
                zero = np.setdiff1d(np.arange(n_blocks, dtype=np.uint64), block)
                block, prints = np.concatenate([block, zero]), np.concatenate([prints, np.zeros(len(zero), np.uint64)])
            elif not short:
                block, prints = block[:need], prints[:need]
            keys.append(_mix(prints ^ _mix(block, 100 + 2 * b + kind)))
            if not short:
                break
    return np.concatenate(keys)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            yield from zip(*(c.to_pylist() for c in batch.slice(at, 512).columns), strict=True)


def _signed(a: np.ndarray) -> np.ndarray:
    return a.astype(np.uint64).view(np.int64)


SIGNATURES = "doc_id long, th long, n int, node long, sketch array<long>, shingle long, df long"


def signatures(docs: DataFrame, share: float = FREQUENT_SHARE) -> DataFrame:
    """One row per document (doc_id, th, n, node, sketch), and rows (shingle, df) of the
    shingles that are frequent within a chunk of documents, written as one table."""
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64())]
    names = [c.split()[0] for c in SIGNATURES.split(", ")]

    def run(batches):
        rows, sets, held = [], [], 0

        def batch():
            hashes, counts = np.unique(np.concatenate(sets), return_counts=True) if sets else (np.empty(0), np.empty(0))
            often = counts >= max(4, share * len(rows))
            n, m = len(rows), int(often.sum())
            columns = [list(c) + [None] * m for c in zip(*rows, strict=True)]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
                + [pa.array([None] * n + _signed(hashes[often]).tolist(), pa.int64()),
                   pa.array([None] * n + counts[often].tolist(), pa.int64())], names)

        for doc_id, th, text in _texts(batches):
            shingles = shingle_set(text)
            rows.append((doc_id, th, len(shingles), set_class(shingles), dense_sketch(shingles)))
            sets.append(shingles)
            held += len(shingles)
            if held >= COUNT_CHUNK or len(rows) >= 50_000:
                yield batch()
                rows, sets, held = [], [], 0
        if rows:
            yield batch()

    return cut_lineage(_named(docs).mapInArrow(run, SIGNATURES))


def _named(docs: DataFrame) -> DataFrame:
    """doc_id, th (a hash of the text), text."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), "text")


def _frequent(signed: DataFrame, share: float) -> np.ndarray:
    n_docs = signed.where("df is null").count()
    rows = (signed.where("df is not null").groupBy("shingle").agg(F.sum("df").alias("df"))
            .where(F.col("df") >= max(4, share * n_docs)).select("shingle").toArrow())
    return np.sort(rows.column(0).to_numpy().view(np.uint64))


def _holders(docs: DataFrame, frequent: np.ndarray) -> DataFrame:
    """key, hub, c1: of each key that several classes hold, the least class and
    each of the others. Keys are sorted within partitions and read as a stream."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def emit(batches):
        seen: set[int] = set()  # classes of this task: copies give their keys once
        keys, classes, held = [], [], 0

        def batch():
            return pa.RecordBatch.from_arrays(
                [pa.array(_signed(np.concatenate(keys))),
                 pa.array(np.repeat(np.array(classes, np.int64), [len(k) for k in keys]))], ["key", "c1"])

        for (text,) in _texts(batches):
            shingles = shingle_set(text)
            c1 = set_class(shingles)
            if c1 in seen:
                continue
            if len(seen) < 1_000_000:
                seen.add(c1)
            found = sketch_keys(shingles, shared.value)
            if len(found):
                keys.append(found)
                classes.append(c1)
                held += len(found)
            if held >= 100_000:
                yield batch()
                keys, classes, held = [], [], 0
        if keys:
            yield batch()

    def hubs(batches):
        last_key = last = hub = None
        for b in batches:
            key, c1 = (c.to_numpy(zero_copy_only=False) for c in b.columns)
            if not len(key):
                continue
            new = np.concatenate([[key[0] != last_key], key[1:] != key[:-1]])
            first = np.maximum.accumulate(np.where(new, np.arange(len(key)), -1))
            hub_of = np.where(first >= 0, c1[first], 0 if hub is None else hub)
            other = (c1 != hub_of) & (new | np.concatenate([[c1[0] != last], c1[1:] != c1[:-1]]))
            last_key, last, hub = key[-1], c1[-1], hub_of[-1]
            if other.any():
                yield pa.RecordBatch.from_arrays([pa.array(key[other]), pa.array(hub_of[other]), pa.array(c1[other])],
                                                 ["key", "hub", "c1"])

    rows = docs.select("text").mapInArrow(emit, "key long, c1 long")
    return rows.repartition("key").sortWithinPartitions("key", "c1").mapInArrow(hubs, "key long, hub long, c1 long")


def _sets(docs: DataFrame) -> DataFrame:
    def run(batches):
        classes, sets, held = [], [], 0

        def batch():
            return pa.RecordBatch.from_arrays(
                [pa.array(classes, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], ["node", "items"])

        for (text,) in _texts(batches):
            shingles = shingle_set(text)
            classes.append(set_class(shingles))
            sets.append(_signed(shingles))
            held += len(shingles)
            if held >= 200_000:
                yield batch()
                classes, sets, held = [], [], 0
        if sets:
            yield batch()

    return docs.select("text").mapInArrow(run, "node long, items array<long>")


def _wanted_texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The texts of the documents named in ``wanted`` (rep, th). A map of the
    names' hashes, of fixed size, drops most of the others before the join."""
    def place(doc_id, th):
        return F.pmod(F.xxhash64(doc_id, th), F.lit(WANTED_BITS)) + 1

    at = place("rep", "th")
    maps = wanted.select(F.bitmap_bucket_number(at).alias("k"), F.bitmap_bit_position(at).alias("p")).groupBy(
        "k").agg(F.bitmap_construct_agg("p").alias("bits")).toArrow().to_pylist()
    bits = np.zeros((WANTED_BITS // 32768 + 1) * 4096, np.uint8)
    for m in maps:
        bits[(m["k"] - 1) * 4096:m["k"] * 4096] = np.frombuffer(m["bits"], np.uint8)
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches):
        for batch in batches:
            at = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            hit = shared.value[at >> 3] >> (at & 7).astype(np.uint8) & 1 == 1
            if hit.any():
                yield pa.RecordBatch.from_arrays(
                    [c.filter(pa.array(hit)) for c in batch.columns[1:]], ["doc_id", "th", "text"])

    rows = _named(docs).where("text is not null")
    rows = rows.select((place("doc_id", "th") - 1).alias("at"), "doc_id", "th", "text").mapInArrow(
        run, "doc_id long, th long, text string")
    names = wanted.select("rep", F.col("th").alias("th_"))
    found = rows.join(names, (F.col("th") == F.col("th_")) & F.col("doc_id").eqNullSafe(F.col("rep")), "left_semi")
    return cut_lineage(found)  # one Python step in a stage: a core never holds two workers


def _maybe(pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) of (a, na, sa, b, nb, sb) whose sizes and dense sketches allow a link."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                a, na, b, nb = (c.to_numpy(zero_copy_only=False) for c in batch.columns[:4])
                (x, at_x, len_x), (y, at_y, len_y) = map(_sketch_column, batch.columns[4:])
                i = np.arange(len(a))
                distance = _distances(np.concatenate([x, y]), np.concatenate([at_x, at_y + len(x)]),
                                      np.concatenate([len_x, len_y]), i, i + len(a))
                allowed = 9 * distance <= na.astype(np.int64) + nb
                yield pa.RecordBatch.from_arrays([pa.array(a[allowed]), pa.array(b[allowed])], ["a", "b"])

    return pairs.where(_near_in_size("na", "nb")).select("a", "na", "b", "nb", "sa", "sb").mapInArrow(
        run, "a long, b long")


def _verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes that link, verified on their sets.

    The partners of a node are dealt to chunks of ``PARTNERS`` pairs, and a cell
    holds one node and one chunk: its set comes once per cell, theirs one by one, so
    a node with very many partners is neither copied for each nor sent to one task."""
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = cut_lineage(classes.join(nodes, "node", "left_semi").select("rep", "th").distinct())
    sets = cut_lineage(_sets(_wanted_texts(docs, wanted)))
    many = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PARTNERS).cast("int").alias("chunks")).where("chunks > 1")
    celled = pairs.distinct().join(many, "a", "left").select(
        "a", "b", F.coalesce(F.pmod(F.xxhash64("b"), F.col("chunks")).cast("int"), F.lit(0)).alias("chunk"))
    celled = cut_lineage(celled)
    ask = celled.join(sets.withColumnRenamed("node", "b"), "b").select("a", "chunk", "b", "items")
    own = celled.select("a", "chunk").distinct().join(sets.withColumnRenamed("node", "a"), "a").select(
        "a", "chunk", F.lit(None).cast("long").alias("b"), "items")

    def run(batches):
        cell = mine = None
        for batch in batches:
            a, chunk, b = (c.to_pylist() for c in batch.columns[:3])
            offsets = batch.columns[3].offsets.to_numpy()
            flat = batch.columns[3].values.to_numpy(zero_copy_only=False).view(np.uint64)
            hits = []
            for k in range(batch.num_rows):
                items = flat[offsets[k]:offsets[k + 1]]
                if b[k] is None:  # sorted first: the cell's own set
                    cell, mine = (a[k], chunk[k]), items.copy()
                    continue
                if cell != (a[k], chunk[k]):
                    continue
                common = len(np.intersect1d(mine, items, assume_unique=True))
                if 100 * common >= PERCENT * (len(mine) + len(items) - common):
                    hits.append(k)
            if hits:
                yield pa.RecordBatch.from_arrays([batch.columns[0].take(pa.array(hits)), batch.columns[2].take(pa.array(hits))],
                                                 ["a", "b"])

    rows = own.unionByName(ask).repartition("a", "chunk").sortWithinPartitions("a", "chunk", F.col("b").asc_nulls_first())
    return rows.mapInArrow(run, "a long, b long").distinct()


def _near_in_size(a: str, b: str):
    return (5 * F.col(a) >= 4 * F.col(b)) & (5 * F.col(b) >= 4 * F.col(a))


def join_classes(docs: DataFrame, share: float = FREQUENT_SHARE, all_links: bool = False):
    """``(rows, classes, links)``:

    rows: doc_id, n, node of every document; classes: node, n, sketch, rep
    (least doc_id, null if no row has one) and th (the hash of that row's
    text); links (a, b, a < b) between nodes. With ``all_links`` every
    link between two classes is returned, else enough for the components.
    """
    signed = signatures(docs, share)
    rows = signed.where("df is null").select("doc_id", "n", "node")
    classes = signed.where("df is null and n > 0").groupBy("node").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "th")).alias("first"), F.first("n").alias("n"),
        F.first("sketch").alias("sketch"))
    classes = cut_lineage(classes.select("node", "n", F.col("first.doc_id").alias("rep"), "first.th", "sketch"))
    held = cut_lineage(_holders(docs, _frequent(signed, share)))

    def end(node, n, sketch):
        return classes.select(F.col("node").alias(node), F.col("n").alias(n), F.col("sketch").alias(sketch))

    parts = held.select("key", F.col("c1").alias("node")).unionByName(
        held.select("key", F.col("hub").alias("node")).distinct())
    if all_links:
        pairs = cut_lineage(_across(parts.withColumn("component", F.col("node")), classes).distinct())
        return rows, classes, cut_lineage(_verified(pairs, docs, classes))

    stars = held.select(F.col("hub").alias("a"), F.col("c1").alias("b")).distinct()
    stars = _maybe(stars.join(end("a", "na", "sa"), "a").join(end("b", "nb", "sb"), "b"))
    tried = cut_lineage(stars.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"))
    links = cut_lineage(_verified(tried, docs, classes))
    for nearest in (True, False):
        known = parts.join(components(links), "node", "left").withColumn("component", F.coalesce("component", "node"))
        pairs = _across(known, classes, nearest).distinct().join(tried, ["a", "b"], "left_anti")
        if nearest:  # of a member's pairs with one component, over all its keys, the first to be tried
            pairs = _one_each(pairs, known)
        pairs = cut_lineage(pairs)
        tried = tried.unionByName(pairs)
        links = links.unionByName(cut_lineage(_verified(pairs, docs, classes)))
    return rows, classes, links


def _one_each(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """One pair for each node and component of its partner. The last round looks at all
    pairs that are left between components, so this changes the work alone."""
    of = known.groupBy("node").agg(F.min("component").alias("component"))
    named = pairs.join(of.toDF("a", "ca"), "a").join(of.toDF("b", "cb"), "b")
    return named.groupBy("b", "ca").agg(F.min("a").alias("a")).select("a", "b")


def _across(parts: DataFrame, classes: DataFrame, nearest: bool = False) -> DataFrame:
    """Pairs of nodes of different components that hold a key together and whose
    sizes and sketches allow a link; with ``nearest`` only the nearest earlier
    one of each. The holders of a key are dealt to chunks of ``CELL`` rows, and
    every two chunks meet in one cell, so a task holds two chunks at most."""
    mixed = parts.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"),
                                     F.count(F.lit(1)).alias("m")).where("lo != hi")
    parts = parts.join(mixed.select("key", "m"), "key").join(classes.select("node", "n", "sketch"), "node")
    chunks = F.ceil(F.col("m") / CELL).cast("int")
    rows = parts.withColumn("i", F.pmod(F.xxhash64("node"), chunks).cast("int")).withColumn(
        "j", F.explode(F.sequence(F.lit(0), chunks - 1)))
    rows = rows.select("key", F.least("i", "j").alias("p"), F.greatest("i", "j").alias("q"), "i", "component", "node",
                       "n", "sketch")

    def compared(r, words, starts, lengths, since):
        """Pairs of each row from ``since`` on with those before it in its cell."""
        new = np.concatenate([[True], (r["key"][1:] != r["key"][:-1]) | (r["p"][1:] != r["p"][:-1])
                              | (r["q"][1:] != r["q"][:-1])])
        first = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
        before = np.arange(len(new)) - first
        total = np.concatenate([[0], np.cumsum(before)])
        at = since
        while at < len(new):
            to = max(at + 1, int(np.searchsorted(total, total[at] + COMPARED, "right")) - 1)
            k = np.repeat(np.arange(at, to), before[at:to])
            i = np.arange(total[at], total[to]) - total[k] + first[k]
            at = to
            n, part, chunk = r["n"].astype(np.int64), r["component"], r["i"]
            near = (part[i] != part[k]) & (5 * n[i] >= 4 * n[k]) & (5 * n[k] >= 4 * n[i])
            near &= (r["p"] == r["q"])[k] | (chunk[i] != chunk[k])
            i, k = i[near], k[near]
            distance = _distances(words, starts, lengths, i, k)
            allowed = 9 * distance <= n[i] + n[k]
            i, k, distance = i[allowed], k[allowed], distance[allowed]
            if nearest and len(k):
                order = np.lexsort((distance, k))
                i, k = i[order], k[order]
                least = np.concatenate([[True], k[1:] != k[:-1]])
                i, k = i[least], k[least]
            if len(k):
                x, y = r["node"][i], r["node"][k]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], ["a", "b"])
        return int(first[-1])

    def run(batches):
        names = ["key", "p", "q", "i", "component", "node", "n"]
        r = {c: np.empty(0, np.int64) for c in names}  # the rows so far of the last cell
        words, starts, lengths = np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            since = len(starts)
            more, at, size = _sketch_column(batch.columns[7])
            starts = np.concatenate([starts, at + len(words)])
            words, lengths = np.concatenate([words, more]), np.concatenate([lengths, size])
            r = {c: np.concatenate([r[c], batch.columns[j].to_numpy(zero_copy_only=False)])
                 for j, c in enumerate(names)}
            cell = yield from compared(r, words, starts, lengths, since)
            words, starts, lengths = words[starts[cell]:], starts[cell:] - starts[cell], lengths[cell:]
            r = {c: v[cell:] for c, v in r.items()}

    cell = ["key", "p", "q"]
    return rows.repartition(*cell).sortWithinPartitions(*cell).mapInArrow(run, "a long, b long")


def near_groups(docs: DataFrame, share: float = FREQUENT_SHARE) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id (the least doc_id
    that links reach; the row's own id without words).

    Null and empty texts have no words. Repeated rows are kept and equal sets
    are one class. A null id is not the least unless there is no other.
    """
    rows, classes, links = join_classes(docs.select("doc_id", "text"), share)
    nodes = classes.select("node", "rep").join(components(links), "node", "left").select(
        "node", "rep", F.coalesce("component", "node").alias("component"))
    least = nodes.groupBy("component").agg(F.min("rep").alias("component_id"))
    nodes = nodes.join(least, "component").select("node", "component_id")
    filled = rows.where("n > 0").join(nodes, "node", "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id")
    return filled.unionByName(rows.where("n = 0").select(
        "doc_id", F.lit(0).cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def keep_first(docs: DataFrame) -> DataFrame:
    """The documents that are the least of their group, with all columns. Rows
    without words stay. Of repeated rows of the least id all stay."""
    groups = near_groups(docs).where("doc_id is null or doc_id = component_id").select(
        F.col("doc_id").alias("_id")).distinct()
    doc = fresh([*docs.columns, "_id"], "_doc")
    whole = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias(doc))
    return whole.join(groups, F.col(f"{doc}.doc_id").cast("long").eqNullSafe(F.col("_id")), "left_semi").select(
        f"{doc}.*")


#: DuckDB SQL of ``near_groups`` for small tables.
GROUPS_SQL = r"""
with recursive w as (
  select doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t\n\v\f\r]+'),
    lambda x: x <> '') as s
  from documents
), g as (
  select distinct doc_id, array_to_string(s[i:least(i + 4, len(s))], ' ') as g
  from w, unnest(range(1, greatest(len(s) - 4, 1) + 1)) u(i) where len(s) > 0
), n as (
  select doc_id, count(*) as n from g group by doc_id
), k as (
  select a.doc_id as a, b.doc_id as b, count(*) as c
  from g a join g b on a.g = b.g and a.doc_id < b.doc_id group by all
), e as (
  select k.a, k.b from k join n x on k.a = x.doc_id join n y on k.b = y.doc_id
  where 100 * c >= 80 * (x.n + y.n - c)
), s as (
  select a, b from e union all select b, a from e
), r(doc_id, reached) as (
  select doc_id, doc_id from documents
  union
  select r.doc_id, s.b from r join s on r.reached = s.a
)
select d.doc_id, coalesce(any_value(n.n), 0)::bigint as n_shingles, min(r.reached)::bigint as component_id
from documents d left join n on n.doc_id = d.doc_id join r on r.doc_id = d.doc_id group by d.doc_id
"""
