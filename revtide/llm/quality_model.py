"""Quality classifier: supervised subword embeddings.

A document is the average of the learned vectors of its hashed words and character
n-grams. A softmax layer turns the average into class probabilities. Vectors and layer are
trained by stochastic gradient descent in numpy on a bounded number of labelled rows, whole
texts of any length: of a long one the tasks send its buckets' shares, at most 1 MB, and not
its text. The softmax input is linear in the average, so for scoring each bucket's vector is
folded into one number and a document's score is the logistic function of a mean.

Null and empty texts have no features and get the score of the bias. Without any labelled
row the score is 0.5 everywhere. Repeated rows are scored each; a document with several
labels counts once per label. Only the named columns are read.
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revtide.llm.base import crc_fold, smallest_hashes, utf8

#: The training sample: at most so many labelled rows. Texts longer than this come as shares of buckets.
SAMPLE_ROWS, LONG_BYTES = 4_000, 32_768
BITS, DIMENSIONS, SHORTEST, LONGEST = 17, 16, 2, 5
EPOCHS, RATE = 8, 8.0
#: Longer texts are read in pieces that end at a space.
PIECE_CHARS = 1 << 19
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x100000001B3
_SPACE = np.zeros(128, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Hasher:
    """Bucket ids of the words and character n-grams in a run of code points."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def _word_ids(self, chars: np.ndarray, space: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        edge = np.flatnonzero(space[1:] != space[:-1]) + 1
        starts, ends = edge[0::2], edge[1::2]
        if len(chars) > len(self.up):
            n = 2 * len(chars)
            self.up, self.down = _powers(n, _BASE), _powers(n, pow(_BASE, -1, 1 << 64))
        sums = np.cumsum((chars + np.uint64(1)) * self.up[:len(chars)])
        return (sums[ends - 1] - sums[starts - 1]) * self.down[starts], starts

    def features(self, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bucket ids and where each feature starts. The run begins and ends with a space."""
        space = (chars < 128) & _SPACE[np.minimum(chars, 127)]
        chars = np.where(space, 32, chars).astype(np.uint64)
        if space.all():
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        hashes, places = self._word_ids(chars, space)
        out = [(hashes * _MULTIPLIER) >> np.uint64(64 - BITS)], [places]
        rolling, inside = chars * _MULTIPLIER, None
        for n in range(2, LONGEST + 1):
            size = len(chars) - n + 1
            if size <= 0:
                break
            rolling = (rolling[:size] ^ chars[n - 1:]) * _MULTIPLIER
            rolling ^= rolling >> np.uint64(29)
            if n == 2:  # no pair of two spaces
                inside = np.ones(size, bool)
                found = np.flatnonzero(~(space[:size] & space[1:]))
            else:  # a space only at an end
                inside = inside[:size] & ~space[n - 2:n - 2 + size]
                found = np.flatnonzero(inside)
            if n >= SHORTEST:
                out[0].append((rolling[found] * _MULTIPLIER) >> np.uint64(64 - BITS))
                out[1].append(found)
        return np.concatenate(out[0]).astype(np.int64), np.concatenate(out[1])


def pieces(text: str):
    """The text between spaces, in pieces of bounded length where spaces allow."""
    start = 0
    while len(text) - start > PIECE_CHARS:
        cut = text.find(" ", start + PIECE_CHARS)
        if cut < 0:
            break
        yield f" {text[start:cut]} "
        start = cut
    yield f" {text[start:]} "


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), "<u4")


@dataclass
class QualityModel:
    """Vectors of the buckets, the softmax layer and its bias."""

    vectors: np.ndarray
    layer: np.ndarray
    bias: np.ndarray

    def folded(self) -> tuple[np.ndarray, float]:
        """Per bucket, and for no text at all, the log odds of class 1."""
        slope = self.layer[:, 1] - self.layer[:, 0]
        return (self.vectors @ slope).astype(np.float64), float(self.bias[1] - self.bias[0])


def sample(docs: DataFrame, labels: DataFrame, seed: int = 7) -> DataFrame:
    """At most SAMPLE_ROWS labelled documents, those with the smallest hashed ids."""
    marked = labels.select("doc_id", F.col("quality").cast("int").alias("label")).filter(
        F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & (crc_fold(F.col("doc_id"), 3) != 1)
    )
    present = marked.join(docs.select("doc_id"), "doc_id", "left_semi")
    order = [F.xxhash64(F.lit(seed), "doc_id"), "doc_id", "label"]
    chosen = F.broadcast(smallest_hashes(present, SAMPLE_ROWS, "doc_id", "label", seed=seed))  # a bounded side
    return docs.select("doc_id", "text").join(chosen, "doc_id").orderBy(*order, F.xxhash64("text")).limit(SAMPLE_ROWS)


def shares(text: str, hasher: Hasher) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of a text's features and the share of each."""
    total = np.zeros(1 << BITS, np.int64)
    for piece in pieces(text):
        found = hasher.features(_points(piece))[0]
        total += np.bincount(found, minlength=len(total))
    ids = np.flatnonzero(total)
    return ids.astype(np.int32), (total[ids] / max(total.sum(), 1)).astype(np.float32)


def examples(rows: DataFrame) -> DataFrame:
    """(text, ids, weights, label): the text where it is short, else its shares, worked out by the tasks."""
    def run(batches):
        hasher = Hasher()
        for batch in batches:
            texts, ids, weights = [], [], []
            for data in utf8(batch.column("text")):
                long = len(data) > LONG_BYTES
                texts.append(None if long else data.decode())
                pair = shares(data.decode(), hasher) if long else (None, None)
                ids.append(pair[0].tobytes() if long else None)
                weights.append(pair[1].tobytes() if long else None)
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts, pa.string()), pa.array(ids, pa.binary()), pa.array(weights, pa.binary()), batch.column("label")],
                ["text", "ids", "weights", "label"])

    return rows.select("text", "label").mapInArrow(run, "text string, ids binary, weights binary, label int")


@contextmanager
def spooled(rows):
    """How many of (text or pair of ids and shares, label) have features, and a function that reads one of them.

    They lie in a temporary file: features take about ten times the room of their text.
    """
    with tempfile.TemporaryFile() as spool:
        hasher, places = Hasher(), []
        for found, label in rows:
            ids, weights = shares(found, hasher) if isinstance(found, str) else found
            if len(ids):
                places.append((spool.tell(), len(ids), label))
                spool.write(ids.tobytes() + weights.tobytes())

        def known(i: int) -> tuple[np.ndarray, np.ndarray, int]:
            start, n, label = places[i]
            spool.seek(start)
            data = spool.read(8 * n)
            return np.frombuffer(data, np.int32, n), np.frombuffer(data, np.float32, n, 4 * n), label

        yield len(places), known


def train(rows, seed: int = 7) -> QualityModel:
    """Stochastic gradient descent over (text or pair of ids and shares, label)."""
    with spooled(rows) as (count, known):
        return descend(count, known, seed)


def descend(count: int, known: Callable[[int], tuple], seed: int) -> QualityModel:
    random = np.random.default_rng(seed)
    vectors = random.uniform(-1, 1, (1 << BITS, DIMENSIONS)).astype(np.float32) / DIMENSIONS
    layer, bias = np.zeros((DIMENSIONS, 2), np.float32), np.zeros(2, np.float32)
    steps = max(1, EPOCHS * count)
    for step in range(EPOCHS * count):
        if step % count == 0:
            order = random.permutation(count)
        ids, weights, label = known(order[step % count])
        mean = weights @ vectors[ids]
        odds = mean @ layer + bias
        error = np.exp(odds - odds.max())
        error /= error.sum()
        error[label] -= 1
        rate = np.float32(RATE * (1 - step / steps))
        back = layer @ error
        layer -= rate * np.outer(mean, error)
        bias -= rate * np.float32(0.05) * error
        # Divided by the share of squares, so that a step moves the mean by the rate.
        vectors[ids] -= (rate / (weights @ weights)) * np.float32(0.02) * np.outer(weights, back)
    return QualityModel(vectors, layer, bias)


def fit(docs: DataFrame, labels: DataFrame) -> QualityModel:
    """A model of `labels.quality`, learned outside the held-out third of the ids."""
    found = examples(sample(docs, labels)).toLocalIterator()
    return train((row.text if row.ids is None else (np.frombuffer(row.ids, np.int32), np.frombuffer(row.weights, np.float32)), row.label)
                 for row in found)


def score(docs: DataFrame, model: QualityModel, out: str = "score", text: str = "text") -> DataFrame:
    """All columns and the probability of class 1."""
    values, nothing = model.folded()
    shared = docs.sparkSession.sparkContext.broadcast(values)  # one number per bucket
    names = docs.columns
    schema = docs.withColumn(out, F.lit(0.5)).schema

    def odds(hasher: Hasher, texts: list[bytes]) -> np.ndarray:
        total, count = np.zeros(len(texts)), np.zeros(len(texts))

        def add(run: list[np.ndarray], owners: list[int]):
            ids, places = hasher.features(np.concatenate(run))
            owner = np.repeat(owners, [len(r) for r in run])[places]
            total[:] += np.bincount(owner, shared.value[ids], len(texts))
            count[:] += np.bincount(owner, minlength=len(texts))

        run, owners, size = [], [], 0
        for i, data in enumerate(texts):
            for piece in pieces(data.decode()):
                run.append(_points(piece))
                owners.append(i)
                size += len(run[-1])
                if size >= PIECE_CHARS:
                    add(run, owners)
                    run, owners, size = [], [], 0
        if run:
            add(run, owners)
        return total / np.maximum(count, 1) + nothing

    def apply(batches):
        hasher = Hasher()
        for batch in batches:
            scores = 1 / (1 + np.exp(-np.clip(odds(hasher, utf8(batch.column(text))), -500, 500)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], [*names, out])

    return docs.mapInArrow(apply, schema)


def predictions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: fold, score and predicted class."""
    scored = score(docs.select("doc_id", "text"), fit(docs, labels))
    return scored.select(
        "doc_id", (crc_fold(F.col("doc_id"), 3) == 1).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
