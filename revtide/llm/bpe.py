"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file.

Nulls count as empty texts, which have no ids. Repeated rows are encoded each.
Only the key columns and the text are read, so other columns cannot clash.
"""

from __future__ import annotations

import re
from base64 import b64decode
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revtide.llm.base import utf8

#: Longer texts are split before they are encoded.
PART_CHARS = 200_000
#: Where no match of the pattern can reach across: before white space that follows
#: something else, and before ASCII punctuation that follows a letter. No alternative of
#: the pattern holds white space or punctuation behind a letter.
_SAFE = re.compile(r"(?<=\S)(?=[ \t\r\n])|(?<=[^\W\d_])(?=[!-/:-@\[-`{-~])")


@cache
def encoding(ranks: str, pattern: str):
    """The library's encoding for a rank file, loaded once in each worker."""
    import tiktoken

    with open(ranks, "rb") as lines:
        merges = {b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding(ranks, pat_str=pattern, mergeable_ranks=merges, special_tokens={})


def safe_parts(text: str, size: int = PART_CHARS) -> Iterator[str]:
    """The text in parts of about `size` characters, cut only where the pattern also cuts.

    A stretch without a safe boundary stays whole, however long it is.
    """
    start = 0
    while len(text) - start > size:
        cut = _SAFE.search(text, start + size)
        if cut is None:
            break
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:]


def ids_of(text: str, ranks: str, pattern: str) -> np.ndarray:
    """The ids of one text as little-endian unsigned 32-bit integers."""
    encode = encoding(ranks, pattern).encode_ordinary
    parts = [np.array(encode(part), "<u4") for part in safe_parts(text)]
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def bytes_of(ids: bytes, ranks: str, pattern: str) -> bytes:
    """The raw bytes that the ids stand for; they need not be valid UTF-8."""
    return encoding(ranks, pattern).decode_bytes(np.frombuffer(ids, "<u4").tolist())


def encode(docs: DataFrame, ranks: str, pattern: str, keys: Iterable[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """The key columns and `ids`, the packed ids of each whole text."""
    source = docs.select(*keys, text)
    out = source.drop(text).withColumn("ids", F.lit(b"")).schema

    def run(batches):
        for batch in batches:
            ids = [ids_of(t.decode(), ranks, pattern).tobytes() for t in utf8(batch.column(text))]
            columns = [batch.column(k) for k in keys] + [pa.array(ids, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, [*keys, "ids"])

    return source.mapInArrow(run, out)


def decode(tokens: DataFrame, ranks: str, pattern: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """All columns and `decoded`, the bytes behind the ids."""
    names = tokens.columns
    out = tokens.withColumn(decoded, F.lit(b"")).schema

    def run(batches):
        for batch in batches:
            texts = [bytes_of(i, ranks, pattern) for i in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary())], [*names, decoded])

    return tokens.mapInArrow(run, out)


def n_ids(ids: Column) -> Column:
    """How many ids a packed column holds."""
    return (F.octet_length(ids) / 4).cast("long")


def digests(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """Per document: the number of ids, their SHA-256 and that of the decoded bytes."""
    coded = decode(encode(docs, ranks, pattern), ranks, pattern)
    return coded.select(
        "doc_id", n_ids(F.col("ids")).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )
