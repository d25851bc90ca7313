"""Secret scan: fixed patterns plus character Markov models.

Two first-order Markov models over characters are trained from labelled
samples: one of random strings (the values that the fixed patterns match in any
document), one of ordinary identifiers (letter runs of a bounded sample of
documents). A candidate, a long run of token characters with a digit, is a
secret if its log-likelihood ratio under the two models passes a threshold.

Everything runs as DataFrame expressions. Texts are read once: the matches are
written with their places, which is little, and the models are trained and
applied on that table.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import let
from tessera.session import cut_lineage

#: The base patterns, the group that is measured and its least length.
BASE = [
    ("assign",
     r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
]
#: What can only hold where a base pattern matches; spares the full patterns elsewhere.
_HINT = {
    "assign": r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]",
    "access": r"AKIA[A-Z0-9]{16}",
    "hex": r"[0-9a-f]{24}",
}
#: Runs that the models judge: 16 token characters or more, a digit among them.
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])[A-Za-z0-9+/_=-]{16,}"
ORDINARY = r"[A-Za-z_]{8,}"
#: Documents from which ordinary identifiers are learnt (those with the smallest hashes).
TRAIN_DOCUMENTS = 2_000
#: Pseudo-count of every character pair.
PRIOR = 0.5
#: Mean log-likelihood ratio per character (nats) from which a run is a secret.
THRESHOLD = 0.5

#: The alphabet of the models; its order gives the codes.
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_.=-"
_N = len(ALPHABET)
_RUN = 64

SPAN = "struct<start:bigint,kind:int,end:bigint,value:string>"


def _starts(sizes: Column) -> Column:
    """Exclusive prefix sums of an array of sizes, in runs of ``_RUN``, so the
    work stays near linear."""
    def total(a):
        return F.aggregate(a, F.lit(0).cast("long"), lambda s, x: s + x)

    def body(a):
        runs = F.transform(F.sequence(F.lit(0), F.floor(F.size(a) / _RUN).cast("int")),
                           lambda k: total(F.slice(a, k * _RUN + 1, F.lit(_RUN))))
        return let(runs, lambda r: let(
            F.transform(r, lambda _, k: total(F.slice(r, F.lit(1), k))),
            lambda before: F.transform(a, lambda _, i: before[F.floor(i / _RUN).cast("int")] + total(
                F.slice(a, F.floor(i / _RUN).cast("int") * _RUN + 1, i % _RUN)))))

    return let(F.transform(sizes, lambda s: s.cast("long")), body)


def matches(text: Column, pattern: str, kind: int, group: int = 0, least: int = 0) -> Column:
    """Spans of the leftmost non-overlapping matches whose ``group`` has
    ``least`` characters or more: the pieces between the matches and the
    matches themselves give the places."""
    def body(t):
        found = F.regexp_extract_all(t, F.lit(pattern), F.lit(0))
        between = F.split(t, pattern, -1)

        def spans(m):
            # piece 0, match 0, piece 1, ...: a match starts after its piece
            steps = F.zip_with(m, F.slice(between, F.lit(1), F.size(m)), lambda x, p: F.length(p) + F.length(x))
            values = F.regexp_extract_all(t, F.lit(pattern), F.lit(group)) if group else m
            return let(_starts(steps), lambda at: F.transform(
                F.arrays_zip(m.alias("m"), values.alias("v"), at.alias("a"),
                             F.slice(between, F.lit(1), F.size(m)).alias("p")),
                lambda x: F.struct(
                    (x["a"] + F.length(x["p"])).alias("start"), F.lit(kind).alias("kind"),
                    (x["a"] + F.length(x["p"]) + F.length(x["m"])).alias("end"), x["v"].alias("value"))))

        return let(found, spans)

    return F.filter(let(text, body), lambda s: F.length(s["value"]) >= least)


def find_matches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, ``base`` spans and ``candidates`` that no base span overlaps."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    none = F.array().cast(f"array<{SPAN}>")
    rows = docs.select(F.col(id_col), text.alias("t"))
    kinds = [F.when(F.col("t").rlike(_HINT[name]), matches(F.col("t"), pattern, k, group, least)).otherwise(none)
             for k, (name, pattern, group, least) in enumerate(BASE)]
    rows = rows.select(
        id_col, F.concat(*kinds).alias("base"),
        F.when(F.col("t").rlike(CANDIDATE), matches(F.col("t"), CANDIDATE, len(BASE))).otherwise(none).alias("c"))
    free = F.filter("c", lambda c: ~F.exists("base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))
    return rows.select(id_col, "base", free.alias("candidates"))


def _pairs(value: Column) -> Column:
    """Codes (256 * first + second) of the character pairs of a string."""
    return F.transform(F.sequence(F.lit(1), F.length(value) - 1),
                       lambda i: F.ascii(F.substring(value, i, F.lit(1))) * 256
                       + F.ascii(F.substring(value, i + 1, F.lit(1))))


def pair_counts(strings: DataFrame) -> DataFrame:
    """Counts of character pairs (pair, n) of the column ``value``."""
    return (strings.where(F.length("value") > 1).select(F.explode(_pairs(F.col("value"))).alias("pair"))
            .groupBy("pair").agg(F.count(F.lit(1)).alias("n")))


def log_ratios(random: DataFrame, ordinary: DataFrame, prior: float = PRIOR) -> list[float]:
    """log P(second | first, random) - log P(second | first, ordinary) at
    256 * first + second. At most one row a pair of the alphabet reaches the driver."""
    import math

    tables = []
    inside = [ord(a) * 256 + ord(b) for a in ALPHABET for b in ALPHABET]
    for counts in (random, ordinary):
        n = {r["pair"]: r["n"] for r in counts.where(F.col("pair").isin(inside)).collect()}
        rows = {a: sum(n.get(ord(a) * 256 + ord(b), 0) for b in ALPHABET) for a in ALPHABET}
        tables.append({(a, b): (n.get(ord(a) * 256 + ord(b), 0) + prior) / (rows[a] + prior * _N)
                       for a in ALPHABET for b in ALPHABET})
    ratio = [0.0] * (128 * 256)
    for a in ALPHABET:
        for b in ALPHABET:
            ratio[ord(a) * 256 + ord(b)] = round(math.log(tables[0][a, b] / tables[1][a, b]), 5)
    return ratio


def mean_ratio(value: Column, ratio: list[float]) -> Column:
    model = F.from_json(F.lit(json.dumps(ratio)), "array<double>")
    total = let(model, lambda m: F.aggregate(_pairs(value), F.lit(0.0), lambda s, p: s + F.get(m, p)))
    return total / (F.length(value) - 1)


def train(found: DataFrame, docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
          train_documents: int = TRAIN_DOCUMENTS) -> list[float]:
    """Fit both models: random strings from all base matches of ``found``,
    identifiers from ``train_documents`` documents."""
    random = found.select(F.explode("base.value").alias("value"))
    some = (docs.select(F.col(id_col).alias("i")).where(F.col("i").isNotNull()).distinct()
            .orderBy(F.xxhash64("i"), "i").limit(train_documents))
    ordinary = (docs.join(F.broadcast(some), F.col(id_col) == F.col("i"), "left_semi")
                .select(F.explode(F.regexp_extract_all(text_col, F.lit(ORDINARY), F.lit(0))).alias("value")))
    return log_ratios(pair_counts(random), pair_counts(ordinary))


def scan(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per row of ``docs``: doc_id, n_assign, n_access, n_hex, base_sha256,
    spans, n_markov.

    Spans are kind:start:end in characters, end exclusive, ordered by start and
    kind (assign, access, hex, markov). A null or empty text has none. Repeated
    rows are kept. Without any base match or identifier the models are flat and
    add nothing.
    """
    docs = docs.select("doc_id", "text")
    found = cut_lineage(find_matches(docs))
    ratio = train(found, docs)
    secret = F.filter("candidates", lambda c: mean_ratio(c["value"], ratio) >= threshold)
    names = F.array(*[F.lit(n) for n, *_ in BASE], F.lit("markov"))

    def listed(spans):
        return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
            ":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def of_kind(k):
        return F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")

    rows = found.select("doc_id", "base", secret.alias("secret"))
    return rows.select(
        "doc_id", of_kind(0).alias("n_assign"), of_kind(1).alias("n_access"), of_kind(2).alias("n_hex"),
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(F.concat("base", "secret")).alias("spans"),
        F.size("secret").cast("long").alias("n_markov"))
