"""Registered queries of the dealt operators: each runs one over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revtide.llm import (
    ann, bpe, interpolation, mixing, quality_model, repair, rules, secrets, simhash, token_counts, toxicity, trie, warc,
)
from revtide.llm.base import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def split_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


@query("op1_token_counts")
def _(spark, sf):
    counts = token_counts.token_counts(read(spark, sf, "documents"), tokenizer("word_bpe_49k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 2048)


@query("op2_adaptive_scan")
def _(spark, sf):
    found = ann.search(read(spark, sf, "embeddings"), "vec_id", "embedding", F.col("id") % 20 == 0, 20)
    return found.withColumnRenamed("id", "vec_id")


@query("op3_simhash")
def _(spark, sf):
    return simhash.near_duplicates(read(spark, sf, "documents"))


@query("op4_deleted_interpolation")
def _(spark, sf):
    return interpolation.score(read(spark, sf, "documents"))


@query("op5_secret_scan")
def _(spark, sf):
    return secrets.report(read(spark, sf, "documents"))


@query("op6_quality_classifier")
def _(spark, sf):
    return quality_model.predictions(read(spark, sf, "documents"), read(spark, sf, "labels"))


@query("op7_mixing")
def _(spark, sf):
    return mixing.report(read(spark, sf, "documents"))


@query("op8_byte_bpe")
def _(spark, sf):
    return bpe.digests(
        read(spark, sf, "documents"), tokenizer("byte_bpe_multi_50k.tiktoken"), split_pattern()
    )


@query("op9_quality_rules", rules.SQL)
def _(spark, sf):
    return rules.judged(read(spark, sf, "documents"))


@query("op10_warc", warc.SQL)
def _(spark, sf):
    return warc.round_trip(read(spark, sf, "pages"))


@query("op13_structure_repair", repair.SQL)
def _(spark, sf):
    return repair.report(read(spark, sf, "conversations"))


@query("op12_prefix_trie", trie.SQL)
def _(spark, sf):
    return trie.report(read(spark, sf, "conversations"))


@query("op11_toxicity")
def _(spark, sf):
    return toxicity.predictions(read(spark, sf, "documents"), read(spark, sf, "labels"))
