"""Quality classifier: a generalised additive model with pairwise interactions.

Each text becomes a few numbers (shares of kinds of characters, word and line
lengths, repetition). Every feature is cut into bins at its quantiles over all
documents. The model is one lookup table per feature and one per pair of
features, learnt by cyclic boosting: round after round every feature in turn
gets a small step of a shallow tree on its bins alone; then the pairs that
explain most of what is left are chosen and boosted likewise, with trees that
cut one feature and then the other. Trees on bins add up to tables, so a score
is an intercept plus one table entry per term, added for whole batches at once.

Only the labelled sample of at most ``TRAIN_ROWS`` rows comes to the driver (as
numbers, not texts); bins and scores cover all documents.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import fresh
from tessera.session import cut_lineage

#: Labelled documents that the model is fitted on: those with the least hashes.
TRAIN_ROWS = 20_000
BINS = 32
#: Bins of a feature within a pair, pairs that are boosted, and the least rows of a leaf.
PAIR_BINS = 8
PAIRS = 6
MIN_LEAF = 8
LEAVES = 4
RATE = 0.1
ROUNDS = 300
#: Rounds without a gain on the rows held back from the fit, until it stops.
PATIENCE = 25
#: Models on different held-back parts whose tables are averaged.
BAGS = 4
THRESHOLD = 0.7
#: Documents held out for evaluation: crc32 of the id mod 4.
FOLDS, HELD_OUT = 4, 2
WINDOW = 8

FEATURES = ("log_words", "log_bytes", "mean_word", "sd_word", "long_words", "distinct_words", "repeated_windows",
            "mean_line", "repeated_lines", "short_lines", "upper", "lower", "digit", "space", "period_comma",
            "bang_question", "bracket", "symbol", "other_ascii", "beyond_ascii", "symbol_words", "bang_words",
            "one_letter_words", "control")

_KINDS = np.full(256, 9)  # beyond ASCII, first of the table below that holds the byte wins
for _k, _chars in reversed(list(enumerate((
        b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" \t\n\r\v\f", b".,", b"!?",
        b"()[]{}", b"#*$%&|<>", bytes(range(32, 128)))))):
    _KINDS[list(_chars)] = _k
_KINDS[[b for b in (*range(9), *range(14, 32), 127)]] = 10


def features(text: str | None) -> list[float]:
    """The numbers of a whole text, in the order of ``FEATURES``; zeros where it is empty."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    n, size = len(words), len(data)
    if not size:
        return [0.0] * len(FEATURES)
    kinds = np.bincount(_KINDS, np.bincount(np.frombuffer(data, np.uint8), minlength=256), 11) / size
    lengths = np.fromiter(map(len, words), np.int64, n) if n else np.zeros(1, np.int64)
    lines = [x for x in data.split(b"\n") if x.strip()]
    line_lengths = np.fromiter(map(len, lines), np.int64, len(lines)) if lines else np.zeros(1, np.int64)
    repeated = 0.0
    if n >= 2 * WINDOW:
        numbers = {}
        ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.uint64, n)
        ids = (ids + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        windows = np.zeros(n - WINDOW + 1, np.uint64)
        for j in range(WINDOW):  # order matters: each place has its own odd factor
            windows = windows * np.uint64(0xD6E8FEB86659FD93) + (ids[j:n - WINDOW + 1 + j] ^ ids[j:n - WINDOW + 1 + j]
                                                                >> np.uint64(29))
        repeated = 1 - len(np.unique(windows)) / len(windows)
        distinct = len(numbers)
    else:
        distinct = len(set(words))
    m = max(n, 1)
    upper, lower, digit, space, stop, bang, bracket, symbol, other, beyond, control = kinds.tolist()
    return [float(np.log1p(n)), float(np.log1p(size)), float(lengths.mean()), float(lengths.std()),
            float((lengths > 12).mean()), distinct / m, repeated, float(line_lengths.mean()),
            1 - len(set(lines)) / max(len(lines), 1), float((line_lengths < 20).mean()), upper, lower, digit, space,
            stop, bang, bracket, symbol, other, beyond,
            sum(w[-1] in b"#*$%&|<>" for w in words) / m, sum(w[-1] in b"!?" for w in words) / m,
            float((lengths == 1).mean()), control]


def feature_table(docs: DataFrame) -> DataFrame:
    """doc_id, x (the features) of every row. Written as a table."""

    def run(batches):
        for rows in batches:
            for at in range(0, rows.num_rows, 512):
                part = rows.slice(at, 512)
                x = np.array([features(t) for t in part.column(1).to_pylist()], np.float32).ravel()
                offsets = np.arange(part.num_rows + 1, dtype=np.int32) * len(FEATURES)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(x))], ["doc_id", "x"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return cut_lineage(rows.mapInArrow(run, "doc_id long, x array<float>"))


def bin_edges(table: DataFrame) -> list[np.ndarray]:
    """Upper edges of each feature's bins: distinct quantiles over all rows."""
    shares = [k / BINS for k in range(1, BINS)]
    row = table.agg(*[F.percentile_approx(F.col("x")[k], shares, 2_000).alias(f"f{k}")
                      for k in range(len(FEATURES))]).first()
    return [np.unique(np.array(edges if edges else [], np.float32)) for edges in row]


def binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, x[:, k], "left") for k, e in enumerate(edges)], 1) if len(x) else np.zeros(
        (0, len(edges)), np.int64)


# -- fitting ---------------------------------------------------------------------

def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + 1.0)


def _best_cut(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[float, int]:
    """Gain and place of the best cut of a run of bins (sums of gradients, curvatures, rows)."""
    g, h, n = g.cumsum(), h.cumsum(), n.cumsum()
    gain = _gain(g[:-1], h[:-1]) + _gain(g[-1] - g[:-1], h[-1] - h[:-1]) - _gain(g[-1], h[-1])
    gain = np.where((n[:-1] >= MIN_LEAF) & (n[-1] - n[:-1] >= MIN_LEAF), gain, -1.0)
    return (float(gain.max()), int(gain.argmax()) + 1) if len(gain) else (-1.0, 0)


def shallow_tree(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Step of each bin: the best tree with ``LEAVES`` leaves, grown greedily."""
    leaves = [(0, len(g))]
    while len(leaves) < LEAVES:
        cuts = [(*_best_cut(g[a:b], h[a:b], n[a:b]), k) for k, (a, b) in enumerate(leaves) if b - a > 1]
        gain, at, k = max(cuts, default=(-1.0, 0, 0))
        if gain <= 1e-9:
            break
        a, b = leaves.pop(k)
        leaves += [(a, a + at), (a + at, b)]
    step = np.zeros(len(g))
    for a, b in leaves:
        step[a:b] = g[a:b].sum() / (h[a:b].sum() + 1.0)
    return step


def _cut_tree(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and steps of the best tree on a pair's grid: one cut of the first
    feature, and one of the second on each side of it."""
    best, table = 0.0, np.zeros(g.shape)
    for at in range(1, len(g)):
        gain, step = 0.0, np.zeros(g.shape)
        for side in (slice(0, at), slice(at, None)):
            gs, hs, ns = g[side].sum(0), h[side].sum(0), n[side].sum(0)
            more, cut = _best_cut(gs, hs, ns)
            parts = (slice(0, cut), slice(cut, None)) if more > 0 else (slice(None),)
            for part in parts:
                gain += float(_gain(gs[part].sum(), hs[part].sum()))
                step[side, part] = gs[part].sum() / (hs[part].sum() + 1.0)
        if gain > best:
            best, table = gain, step
    return best, table


@dataclass
class Model:
    """Edges of the bins, the intercept, a table per feature and per pair."""

    edges: list[np.ndarray]
    intercept: float
    tables: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray]]

    def score(self, x: np.ndarray) -> np.ndarray:
        """Scores 0 to 1 of rows of features."""
        return _sigmoid(self.logit(binned(x, self.edges)))

    def logit(self, bins: np.ndarray) -> np.ndarray:
        total = np.full(len(bins), self.intercept)
        for k, table in enumerate(self.tables):
            total += table[bins[:, k]]
        for i, j, table in self.pairs:
            total += table[_coarse(bins[:, i], len(self.tables[i])), _coarse(bins[:, j], len(self.tables[j]))]
        return total


def _coarse(bins: np.ndarray, n: int) -> np.ndarray:
    return bins * min(PAIR_BINS, n) // n


def _boosted(cells: list[np.ndarray], shapes: list[tuple], y, start, fit, held, tree):
    """Cyclic boosting of one table per list of cell numbers; the rounds end when
    the loss of the held-back rows has not fallen for ``PATIENCE`` rounds."""
    tables = [np.zeros(int(np.prod(s))) for s in shapes]
    best, kept, at = np.inf, [t.copy() for t in tables], 0
    z = start.copy()
    counts = [np.bincount(c[fit], minlength=len(t)) for c, t in zip(cells, tables, strict=True)]
    for r in range(ROUNDS):
        for c, table, shape, n in zip(cells, tables, shapes, counts, strict=True):
            p = _sigmoid(z)
            g = np.bincount(c[fit], (y - p)[fit], len(table))
            h = np.bincount(c[fit], (p * (1 - p))[fit], len(table))
            step = RATE * np.clip(tree(g.reshape(shape), h.reshape(shape), n.reshape(shape)).ravel(), -4, 4)
            table += step
            z += step[c]
        p = np.clip(_sigmoid(z[held]), 1e-6, 1 - 1e-6)
        loss = -float(np.mean(y[held] * np.log(p) + (1 - y[held]) * np.log(1 - p)))
        if loss < best - 1e-6:
            best, kept, at = loss, [t.copy() for t in tables], r
        elif r - at >= PATIENCE:
            break
    return kept


def fit(x: np.ndarray, y: np.ndarray, edges: list[np.ndarray]) -> Model:
    """A model of the labels ``y`` (0, 1). Without rows, or with one class alone, it
    is the smoothed share of label 1 for every text."""
    n = len(y)
    share = (float(y.sum()) + 1) / (n + 2)
    sizes = [len(e) + 1 for e in edges]
    model = Model(edges, float(np.log(share / (1 - share))), [np.zeros(s) for s in sizes], [])
    if n < 4 * MIN_LEAF or not 0 < y.sum() < n:
        return model
    bins, y = binned(x, edges), y.astype(float)
    bag = np.arange(n) % BAGS  # rows come in the order of a hash
    start = np.full(n, model.intercept)
    flat = [bins[:, k] for k in range(len(sizes))]
    for b in range(BAGS):
        held = bag == b
        tables = _boosted(flat, [(s,) for s in sizes], y, start, ~held, held, shallow_tree)
        for whole, table in zip(model.tables, tables, strict=True):
            whole += table / BAGS
    z = model.logit(bins)
    # the pairs whose best tree explains most of what the features alone leave
    p = _sigmoid(z)
    coarse = [_coarse(bins[:, k], s) for k, s in enumerate(sizes)]
    shape = [min(PAIR_BINS, s) for s in sizes]
    found = []
    for i in range(len(sizes)):
        for j in range(i + 1, len(sizes)):
            cell, grid = coarse[i] * shape[j] + coarse[j], (shape[i], shape[j])
            sums = [np.bincount(cell, w, grid[0] * grid[1]).reshape(grid) for w in (y - p, p * (1 - p), np.ones(n))]
            found.append((_cut_tree(*sums)[0], i, j))
    chosen = sorted(found, reverse=True)[:PAIRS]
    cells = [coarse[i] * shape[j] + coarse[j] for _, i, j in chosen]
    grids = [(shape[i], shape[j]) for _, i, j in chosen]
    pairs = [np.zeros(g) for g in grids]
    for b in range(BAGS):
        held = bag == b
        tables = _boosted(cells, grids, y, z, ~held, held, lambda *s: _cut_tree(*s)[1])
        for whole, table in zip(pairs, tables, strict=True):
            whole += table.reshape(whole.shape) / BAGS
    model.pairs = [(i, j, t) for (_, i, j), t in zip(chosen, pairs, strict=True)]
    return model


# -- Spark -----------------------------------------------------------------------

def _fold(doc_id):
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(FOLDS))


def train(table: DataFrame, labels: DataFrame, label: str = "quality") -> Model:
    """A model from the labelled rows of a feature table that are not held out. Labels
    other than 0 and 1 count as none; a document with several labels counts as often."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).where(
        "y in (0, 1)").where(_fold(F.col("doc_id")) != HELD_OUT)
    rows = table.where(_fold(F.col("doc_id")) != HELD_OUT).join(known, "doc_id").select(
        F.xxhash64("doc_id").alias("h"), "y", "x").orderBy("h", "y").limit(TRAIN_ROWS).toArrow()
    x = rows.column("x").combine_chunks()
    x = np.asarray(x.flatten() if len(rows) else [], np.float32).reshape(len(rows), len(FEATURES))
    return fit(x, rows.column("y").to_numpy().astype(np.int64), bin_edges(table))


def scored(table: DataFrame, model: Model) -> DataFrame:
    """doc_id, score of a feature table."""
    shared = table.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for rows in batches:
            x = rows.column(1).flatten().to_numpy(zero_copy_only=False).reshape(rows.num_rows, len(FEATURES))
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(shared.value.score(x))], ["doc_id", "score"])

    return table.select("doc_id", "x").mapInArrow(run, "doc_id long, score double")


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``.

    Null and empty texts have zeros for features and are scored like others;
    repeated rows are scored alike; a null id is not held out. Without labels all
    scores are 0.5. Other columns of ``docs`` are never read.
    """
    table = feature_table(docs)
    return scored(table, train(table, labels)).select(
        "doc_id", F.coalesce(_fold(F.col("doc_id")) == HELD_OUT, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def with_scores(docs: DataFrame, labels: DataFrame, name: str = "quality_score") -> DataFrame:
    """``docs`` with a column of scores, in place: the model is fitted on the labelled rows
    and each text is scored where it stands, so rows without or with equal ids keep their own."""
    model = train(feature_table(docs), labels)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    name = fresh(docs.columns, name)

    @F.pandas_udf("double")
    def score(texts):
        import pandas as pd

        x = np.array([features(t) for t in texts], np.float32).reshape(len(texts), len(FEATURES))
        return pd.Series(shared.value.score(x))

    return docs.withColumn(name, score(F.col("text").cast("string")))
