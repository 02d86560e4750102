"""A corpus pipeline: stages of dealt operators over documents, each written and reread."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revtide.llm import bpe, mixing, near, quality_model, secrets, simhash
from revtide.llm.base import prepare, read, stored, unused_name
from revtide.llm.queries import split_pattern, tokenizer


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    model = quality_model.fit(docs, read(spark, sf_dir, "labels"))
    out = unused_name(docs, "quality")
    return quality_model.score(docs, model, out=out).filter(F.col(out) >= 0.5).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (5-word Jaccard 0.8 or more), that with the smallest id.

    SimHash fingerprints of 5-word shingles, compared bit-sliced as in op3 at a wider radius, give
    the candidates, exact Jaccard confirms them. For buckets see `near`: pairs at 0.8 differ in about
    10 of 64 bits, far beyond what op3's segments can tell apart.
    """
    prepare(spark)
    return simhash.first_of_each(docs, near.classified(docs))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced."""
    prepare(spark)
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix of sources takes them."""
    prepare(spark)
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digest of the token ids of every copy, and the digest of the decoded bytes."""
    prepare(spark)
    return bpe.digests(docs, tokenizer("byte_bpe_multi_50k.tiktoken"), split_pattern())


STAGES = [
    ("quality classifier", keep_quality),
    ("near-duplicates", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
    ("byte-level BPE", encode),
]
#: Trained models and the token library cannot be written as SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what lies between them is in the shared folder."""
    docs = read(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{i}")
    return docs
