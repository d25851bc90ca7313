"""The ``opN_*`` queries: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tessera.llm import (
    bpe,
    chat,
    collocations,
    decontaminate,
    gam,
    html,
    jaccard,
    licenses,
    line_runs,
    quality,
    secrets,
    spelling,
    token_store,
)
from tessera.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn

    return deco


@register("op1_bpe_automaton")
def op1_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@register("op5_token_store")
def op5_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.store_checksums(table(spark, sf_dir, "documents"),
                                       public_tokenizers.path("word_bpe_49k.json"))


@register("op6_suffix_automaton")
def op6_suffix_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op9_license_notices")
def op9_license_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


@register("op10_chat_examples")
def op10_chat_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.formatted_digests(chat.with_control(table(spark, sf_dir, "conversations")))


@register("op2_quality_fences")
def op2_quality_fences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(table(spark, sf_dir, "documents"))


@register("op3_host_paths")
def op3_host_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


@register("op8_secret_markov")
def op8_secret_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


@register("op7_line_runs", line_runs.REPORT_SQL)
def op7_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_runs.report(table(spark, sf_dir, "documents"))


@register("op4_parity_sketch", jaccard.GROUPS_SQL)
def op4_parity_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_groups(table(spark, sf_dir, "documents"))


@register("op13_phrase_graph", collocations.REPORT_SQL)
def op13_phrase_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per lang the best phrases of the gram graph; see ``collocations.collocations``."""
    return collocations.report(table(spark, sf_dir, "documents"))


@register("op12_spelling_fm")
def op12_spelling_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vocabulary of all documents with each word's form and root; see ``spelling.variants``."""
    return spelling.report(table(spark, sf_dir, "documents"))


@register("op11_additive_quality")
def op11_additive_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents; see ``gam.report``."""
    return gam.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
