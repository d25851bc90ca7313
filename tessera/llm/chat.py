r"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: the formatted turns before
it are the context, and only its reply is trainable. The text of an example is
a prefix of its conversation's formatted text, so the output has two tables:

* ``segments``: one row per turn with its formatted text and its place in the
  conversation's text;
* ``examples``: one row per assistant turn with the length of its context and
  the loss span, in characters of the example's text.

That is linear in the input; :func:`render` joins them to whole texts for a
trainer (whose size is that of the examples, quadratic in a conversation).

A turn is written ``### role:\ntext\n</turn>\n``. Inside texts a backslash is
put before every backslash, ``###`` and ``</turn>`` (in roles also before
``:``), and reading takes the character after a backslash as it is, so no text
can imitate a mark and every text comes back unchanged.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.session import scratch_path

OPEN, MIDDLE, CLOSE = "### ", ":\n", "\n</turn>\n"
TRAINED = "assistant"


def _escaped(text: Column, marks: str) -> Column:
    return F.regexp_replace(text, f"({marks})", r"\\$1")


def format_turns(turns: DataFrame) -> DataFrame:
    """One row per turn: conv_id, seq (from 0), role, formatted, start, text_start, text_end.

    Turns are ordered by ``turn`` (nulls first), equal ones by role and text;
    repeated rows stay. Null texts and roles count as empty; a null conv_id is
    a conversation of its own. Offsets are characters of the conversation.
    """
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                        F.coalesce("text", F.lit("")).alias("text"))
    body = _escaped(F.col("text"), r"\\|###|</turn>")
    head = F.concat(F.lit(OPEN), _escaped(F.col("role"), r"\\|###|</turn>|:"), F.lit(MIDDLE))
    rows = rows.select("conv_id", "turn", "role", "text", head.alias("head"), body.alias("body"))
    rows = rows.withColumn("formatted", F.concat("head", "body", F.lit(CLOSE)))
    end = F.sum(F.length("formatted").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.select("conv_id", (F.row_number().over(order) - 1).cast("long").alias("seq"), "role", "formatted",
                       (end - F.length("formatted")).alias("start"), F.length("head").alias("n_head"),
                       F.length("body").alias("n_body"))
    return rows.select("conv_id", "seq", "role", "formatted", "start",
                       (F.col("start") + F.col("n_head")).alias("text_start"),
                       (F.col("start") + F.col("n_head") + F.col("n_body")).alias("text_end"))


def write_examples(turns: DataFrame, out: str, trained: str = TRAINED) -> None:
    """Write ``out``/segments and ``out``/examples (Parquet)."""
    spark = turns.sparkSession
    format_turns(turns).write.mode("errorifexists").parquet(f"{out}/segments")
    segments = spark.read.parquet(f"{out}/segments")
    (segments.where(F.col("role") == trained)
     .select("conv_id", "seq", F.col("start").alias("context_chars"), F.col("text_start").alias("loss_start"),
             F.col("text_end").alias("loss_end"), (F.col("start") + F.length("formatted")).alias("n_chars"))
     .write.mode("errorifexists").parquet(f"{out}/examples"))


def render(spark: SparkSession, out: str, max_context_turns: int | None = None) -> DataFrame:
    """Examples with their texts: conv_id, seq, text, loss_start, loss_end.

    ``max_context_turns`` keeps only the last turns of the context, for
    trainers with a bounded context; the loss span is moved accordingly."""
    segments = spark.read.parquet(f"{out}/segments").select(
        F.col("conv_id").alias("c"), F.col("seq").alias("s"), "formatted", "start")
    examples = spark.read.parquet(f"{out}/examples").alias("e")
    near = F.col("s") <= F.col("seq")
    if max_context_turns is not None:
        near &= F.col("s") >= F.col("seq") - max_context_turns
    parts = examples.join(segments, F.col("conv_id").eqNullSafe(F.col("c")) & near)
    rows = parts.groupBy("conv_id", "seq", "loss_start", "loss_end").agg(
        F.array_sort(F.collect_list(F.struct("s", "formatted"))).alias("parts"), F.min("start").alias("from"))
    return rows.select("conv_id", "seq", F.array_join(F.col("parts.formatted"), "").alias("text"),
                       (F.col("loss_start") - F.col("from")).alias("loss_start"),
                       (F.col("loss_end") - F.col("from")).alias("loss_end"))


_TURN = re.compile(r"### ((?:\\.|[^\\:])*):\n(.*)\n</turn>\n", re.DOTALL)
_ESCAPE = re.compile(r"\\(.)", re.DOTALL)


def parse_turn(formatted: str) -> tuple[str, str]:
    """Role and text of a formatted turn."""
    m = _TURN.fullmatch(formatted)
    if m is None:
        raise ValueError(f"not a formatted turn: {formatted[:80]!r}")
    return _ESCAPE.sub(r"\1", m[1]), _ESCAPE.sub(r"\1", m[2])


DIGESTS = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
           "formatted_chars long, n_examples long, example_chars long")


def read_digests(spark: SparkSession, out: str) -> DataFrame:
    """Per conversation, from the written output: the turns parsed back and the
    text under the loss mask. Turns stream through each task in order, so a
    conversation of any length takes constant memory."""
    segments = spark.read.parquet(f"{out}/segments")
    examples = spark.read.parquet(f"{out}/examples").select(
        F.col("conv_id").alias("c"), F.col("seq").alias("s"), "loss_start", "loss_end", "n_chars")
    rows = segments.join(examples, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("seq") == F.col("s")), "left")
    rows = rows.select("conv_id", "seq", "formatted", "start", "loss_start", "loss_end", "n_chars")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
        names = [c.split()[0] for c in DIGESTS.split(", ")]
        state, done = None, []

        def closed():
            key, n, turns, chars, loss, size, examples_, total = state
            return key, n, turns.hexdigest(), chars, loss.hexdigest(), size, examples_, total

        for batch in batches:
            for conv_id, _, text, start, loss_start, loss_end, n_chars in zip(
                    *(c.to_pylist() for c in batch.columns), strict=True):
                if state is None or state[0] != conv_id:
                    if state is not None:
                        done.append(closed())
                    state = [conv_id, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0, 0]
                role, body = parse_turn(text)
                state[1] += 1
                state[2].update(f"{role}\n{body}\n".encode())
                state[5] += len(text)
                if loss_start is not None:
                    target = _ESCAPE.sub(r"\1", text[loss_start - start:loss_end - start])
                    state[3] += len(target)
                    state[4].update(target.encode())
                    state[6] += 1
                    state[7] += n_chars
            if done:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*done, strict=True), kinds, strict=True)], names)
                done = []
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(closed(), kinds, strict=True)], names)

    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "seq").mapInArrow(run, DIGESTS)


#: The conversation -7 of the contract.
CONTROL_TEXT = r"\### Assistant: </turn> ok"


def with_control(turns: DataFrame) -> DataFrame:
    """The conversations plus conversation -7, whose texts hold control strings."""
    more = turns.sparkSession.createDataFrame(
        [(-7, 0, "user", CONTROL_TEXT), (-7, 1, "assistant", CONTROL_TEXT)],
        "conv_id long, turn long, role string, text string")
    return turns.select("conv_id", "turn", "role", "text").unionByName(more)


def formatted_digests(turns: DataFrame) -> DataFrame:
    spark = turns.sparkSession
    out = scratch_path(spark, "chat")
    write_examples(turns, out)
    return read_digests(spark, out)
