"""Documents in chunks, and the exchange of what chunks ask about their distinct keys.

A chunk is a run of documents of bounded text size that one task has read. What is looked
up or counted over the corpus is asked once per chunk and distinct key, so a key that
fills a third of the corpus costs one row per chunk. Keys are in the order of their
64-bit hashes, and a bucket is a range of hashes: a chunk's questions to a bucket are one
slice, and the answers put together in bucket order line up with the keys.

More buckets than FAN are reached in steps, so that a chunk makes FAN slices at most however
large the corpus is: chunks send to FAN ranges; in a range the slices of as many chunks as
fill a bucket become one node with their distinct keys; nodes send to the FAN parts of their
range, and so on. Answers come back the same way, each node spreading them to its slices.
"""

from __future__ import annotations

import numpy as np
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revtide.llm.base import stored

#: Text bytes in a chunk and, on average, keys in a bucket.
CHUNK_BYTES, BUCKET_KEYS = 16 << 20, 400_000
#: The most slices that a chunk or node makes.
FAN = 512


def pack(values: np.ndarray, kind: str = "<u4") -> bytes:
    """Whole numbers as compressed bytes, those of equal weight side by side."""
    flat = np.ascontiguousarray(values, kind)
    planes = flat.view(np.uint8).reshape(len(flat), flat.itemsize).T
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def unpack(data: bytes, kind: str = "<u4") -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(planes.reshape(size, -1).T).reshape(-1).view(kind)


class Numbering:
    """Gives each chunk of a task its own number."""

    def __init__(self):
        self.next = TaskContext.get().partitionId() << 32

    def __call__(self) -> int:
        self.next += 1
        return self.next - 1


def bucket_count(state: DataFrame, keys: str) -> int:
    """Buckets for so many asked keys; `keys` is the column with each chunk's number."""
    return max(1, -(-int(state.agg(F.sum(keys)).first()[0] or 0) // BUCKET_KEYS))


def exchange(state: DataFrame, keys: str, ask, total, merge, spread, level: int = 0) -> DataFrame:
    """The answers to what the rows of `state` ask, in steps of FAN.

    ask(state, n, level): questions (bucket, chunk, ...) to n buckets. total(questions, level):
    their answers. merge(questions, groups, level): nodes, the state of the next level, each of
    one bucket and of the chunks of one of so many groups. spread(nodes, answers): the answers
    to what the nodes were made of.
    """
    wanted = bucket_count(state, keys)
    n = min(wanted, FAN ** (level + 1))
    questions = ask(state, n, level)
    if n == wanted:
        return total(questions, level)
    nodes = stored(merge(questions, -(-wanted // n), level), "nodes")
    return spread(nodes, stored(exchange(nodes, keys, ask, total, merge, spread, level + 1), "node-answers"))


def node_number(bucket, part, group):
    """A number for a node that no other node of its level has."""
    return (int(bucket) << 32) | (int(part) << 28) | int(group)


def slices(hashes: np.ndarray, n: int):
    """(bucket, start, end) of the buckets that hold any of the sorted unsigned hashes."""
    bucket = ((hashes >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)
    cuts = np.flatnonzero(bucket[1:] != bucket[:-1]) + 1
    if len(hashes):
        for start, end in zip([0, *cuts], [*cuts, len(hashes)]):
            yield int(bucket[start]), int(start), int(end)
