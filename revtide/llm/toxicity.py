"""Toxicity by the nearest labelled examples, through a block-max inverted index.

A bounded sample of labelled texts are the examples. Of their words those are terms that
are clearly more frequent among toxic ones; a text is its terms weighed by TF-IDF, document
frequencies counted over all documents. The nearest examples by cosine are exact: examples
lie in blocks, each term knows its greatest weight per block, blocks are opened from the
highest upper bound down until no block left can hold a nearer one. Their votes weigh by
distance and undo the sample's shares of the two kinds; a logistic curve over the
examples' own votes, each without itself, makes them probabilities. The neighbours and the
terms are the evidence. Texts without any term score as the examples without any do.

Null and empty texts have no terms. Ties go to the smaller example number. Labels that are
null or neither 0 nor 1 do not count; a document labelled both ways is an example of each
kind; equal texts are one example of a kind. Without labels of both kinds every score is the
one kind there is, 0 if none. Every row of a repeated document is scored. Rows without
doc_id are scored and never examples; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revtide.llm.base import crc_fold, prepare, smallest_hashes, stored, utf8

#: The most examples, half of each kind, and the most terms.
SAMPLE_ROWS, TERMS = 8_000, 4_096
#: A term is this many times as frequent among toxic examples, and as unlikely by chance (log-likelihood ratio).
LIFT, LEAST_RATIO = 2.0, 16.0
NEIGHBOURS, BLOCK, NEAREST = 16, 64, 0.1
#: Documents that one task scores.
SCORED_ROWS = 20_000
THRESHOLD = 0.3
PIECE_CHARS = 1 << 20
WORD = re.compile(r"[^\W\d_]+")
BREAK = re.compile(r"[\W\d_]")


def words(text: str) -> Counter:
    """How often each lower-case run of letters occurs."""
    found, start = Counter(), 0
    while start < len(text):
        cut = BREAK.search(text, start + PIECE_CHARS) if len(text) - start > PIECE_CHARS else None
        end = cut.start() if cut else len(text)
        found.update(WORD.findall(text[start:end].lower()))
        start = end
    return found


def mark(found: Counter) -> int:
    """The two smallest hashes of the words: near copies mostly agree, other texts hardly ever."""
    two = sorted(zlib.crc32(w.encode()) for w in found)[:2]
    return sum(h << (32 * i) for i, h in enumerate(two)) - (1 << 63)


# --- examples and terms ---------------------------------------------------

def _marked(labels: DataFrame) -> DataFrame:
    rows = labels.select("doc_id", F.col("toxic").cast("int").alias("label")).filter(
        F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & (crc_fold(F.col("doc_id"), 4) != 2))
    return rows.distinct()


def examples(docs: DataFrame, marked: DataFrame) -> DataFrame:
    """(label, digest, mark, words, counts) of at most SAMPLE_ROWS different labelled texts."""
    kinds = [marked.filter(F.col("label") == k) for k in (0, 1)]
    chosen = [smallest_hashes(rows, SAMPLE_ROWS // 2, "doc_id", seed=11) for rows in kinds]
    few = stored(chosen[0].union(chosen[1]), "chosen")  # a bounded side
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(few), "doc_id")
    known = texts.select("label", F.sha2("text", 256).alias("digest"), "text")
    schema = pa.schema([("label", pa.int32()), ("digest", pa.string()), ("mark", pa.int64()), ("words", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))])

    def run(batches):
        for batch in batches:
            found = [words(t.decode()) for t in utf8(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([
                batch.column("label"), batch.column("digest"), pa.array(map(mark, found), pa.int64()),
                pa.array([list(f) for f in found], schema.types[3]), pa.array([list(f.values()) for f in found], schema.types[4])], schema=schema)

    counted = known.mapInArrow(run, "label int, digest string, mark long, words array<string>, counts array<long>")
    found = stored(counted.groupBy("label", "digest").agg(
        *[F.any_value(c).alias(c) for c in ("mark", "words", "counts")]), "examples")  # equal texts, equal words
    kept = [smallest_hashes(found.filter(F.col("label") == k), SAMPLE_ROWS // 2, "digest") for k in (0, 1)]
    return stored(kept[0].union(kept[1]), "examples")


def terms(of: DataFrame) -> list[str]:
    """The words that mark toxic examples, at most TERMS, the clearest first. Near copies count once."""
    totals = of.select("label", "mark").distinct().groupBy("label").count().collect()
    clean, toxic = (sum(r["count"] for r in totals if r.label == k) for k in (0, 1))
    seen = of.select("label", "mark", F.explode("words").alias("word")).distinct().groupBy("word").agg(
        F.sum(F.col("label")).alias("t"), F.sum(1 - F.col("label")).alias("c"))
    n, t, c = clean + toxic, F.col("t").cast("double"), F.col("c").cast("double")

    def part(observed, expected):
        return F.when(observed > 0, observed * F.log(observed / expected)).otherwise(0.0)

    share = (t + c) / n
    ratio = 2 * (part(t, share * toxic) + part(c, share * clean) + part(toxic - t, (1 - share) * toxic) + part(clean - c, (1 - share) * clean))
    clear = seen.withColumn("ratio", ratio).filter((t * clean >= LIFT * c * toxic) & (F.col("ratio") >= LEAST_RATIO))
    return [r.word for r in clear.orderBy(F.desc("ratio"), "word").limit(TERMS).collect()]


def vectors(docs: DataFrame, known: list[str], text: str = "text") -> DataFrame:
    """doc_id, terms (numbers, ascending) and how often each occurs, of every document."""
    number = {w: i for i, w in enumerate(known)}
    schema = pa.schema([("doc_id", pa.int64()), ("terms", pa.list_(pa.int32())), ("counts", pa.list_(pa.int64()))])

    def run(batches):
        for batch in batches:
            ids, counts = [], []
            for t in utf8(batch.column("text")):
                found = words(t.decode())
                pairs = sorted((number[w], n) for w, n in found.items() if w in number)
                ids.append([i for i, _ in pairs])
                counts.append([n for _, n in pairs])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, schema.types[1]), pa.array(counts, schema.types[2])], schema=schema)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, terms array<int>, counts array<long>")


# --- the index ------------------------------------------------------------

def weigh(ids: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF of length 1."""
    raw = (1 + np.log(counts)) * idf[ids]
    return raw / math.sqrt(float((raw * raw).sum()))


class BlockMaxIndex:
    """Postings of unit vectors in blocks of neighbours, with each term's greatest weight per block."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]]):
        """rows: (term numbers ascending, weights), in the order of the example numbers."""
        strongest = [int(ids[np.argmax(w)]) if len(ids) else -1 for ids, w in rows]
        place = sorted(range(len(rows)), key=lambda i: (strongest[i], i))
        self.number = np.array(place, np.int64)
        owner = np.repeat(np.arange(len(rows)), [len(rows[i][0]) for i in place])
        term = np.concatenate([rows[i][0] for i in place]) if rows else np.zeros(0, np.int64)
        weight = np.concatenate([rows[i][1] for i in place]) if rows else np.zeros(0)
        order = np.lexsort((owner, term))
        owner, term, self.weight = owner[order], term[order], weight[order]
        block = owner // BLOCK
        self.within = owner - block * BLOCK
        cut = np.flatnonzero((term[1:] != term[:-1]) | (block[1:] != block[:-1])) + 1
        start = np.concatenate([[0], cut, [len(term)]]).astype(np.int64) if len(term) else np.zeros(1, np.int64)
        self.start, self.block = start, block[start[:-1]]
        self.greatest = np.maximum.reduceat(self.weight, start[:-1]) if len(term) else np.zeros(0)
        runs = term[start[:-1]]
        first = np.flatnonzero(np.concatenate([[True], runs[1:] != runs[:-1]])) if len(runs) else np.zeros(0, np.int64)
        self.of_term = {int(runs[a]): (int(a), int(b)) for a, b in zip(first, [*first[1:], len(runs)])}
        self.blocks = -(-len(rows) // BLOCK)

    def nearest(self, ids, weights, k: int, without: int = -1) -> list[tuple[float, int]]:
        """(cosine, example number) of the k nearest with a term in common; ties to the smaller number."""
        bound, runs = np.zeros(self.blocks), []
        for i, w in zip(ids, weights):
            if (span := self.of_term.get(int(i))) is not None:
                runs.append((span[0], span[1], w))
                bound[self.block[span[0]:span[1]]] += w * self.greatest[span[0]:span[1]]
        found: list[tuple[float, int]] = []
        for b in np.argsort(-bound, kind="stable"):
            if bound[b] <= 0 or (len(found) == k and bound[b] < found[-1][0] * (1 - 1e-9)):
                break
            score = np.zeros(BLOCK)
            for lo, hi, w in runs:
                at = lo + int(np.searchsorted(self.block[lo:hi], b))
                if at < hi and self.block[at] == b:
                    part = slice(self.start[at], self.start[at + 1])
                    score[self.within[part]] += w * self.weight[part]
            hit = np.flatnonzero(score)
            numbers = self.number[hit + b * BLOCK]
            found += [(float(s), int(n)) for s, n in zip(score[hit], numbers) if n != without]
            found = sorted(found, key=lambda x: (-x[0], x[1]))[:k]
        return found


@dataclass
class ToxicityModel:
    """Terms, their inverse document frequencies, the index and how votes become scores."""

    terms: list[str]
    idf: np.ndarray
    index: BlockMaxIndex
    labels: np.ndarray
    digests: list[str]
    weights: tuple[float, float]
    base: float
    curve: tuple[float, float] = (1.0, 0.0)

    def vote(self, found: list[tuple[float, int]]) -> float:
        """The weighted share of toxic examples among the found, drawn a little towards the base."""
        total, toxic = NEAREST, NEAREST * self.base
        for cosine, n in found:
            w = self.weights[self.labels[n]] * NEAREST / (NEAREST + max(0.0, 1 - cosine))
            total += w
            toxic += w * self.labels[n]
        return toxic / total

    def score(self, vote: float) -> float:
        a, b = self.curve
        return 1 / (1 + math.exp(-min(500.0, max(-500.0, a * _logit(vote) + b))))

    def judged(self, ids: list[int], counts: list[int]) -> tuple[float, list[tuple[float, int]]]:
        if not ids:
            return self.score(self.vote([])), []
        ids = np.array(ids)
        found = self.index.nearest(ids, weigh(ids, np.array(counts), self.idf), NEIGHBOURS)
        return self.score(self.vote(found)), found


def _logit(p: float) -> float:
    p = min(max(p, 1e-4), 1 - 1e-4)
    return math.log(p / (1 - p))


def calibration(votes: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve of least weighted log loss, lightly held to (1, 0)."""
    x = np.array([_logit(v) for v in votes])
    at, hold = np.array([1.0, 0.0]), 1.0
    rows = np.stack([x, np.ones_like(x)], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(rows @ at, -500, 500)))
        slope = rows.T @ (weights * (p - labels)) + hold * (at - [1.0, 0.0])
        curve = (rows * (weights * p * (1 - p))[:, None]).T @ rows + hold * np.eye(2)
        step = np.linalg.solve(curve, slope)
        at = at - np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-10:
            break
    return (float(at[0]), float(at[1])) if at[0] > 0 else (1.0, 0.0)


def fit(docs: DataFrame, labels: DataFrame) -> tuple[ToxicityModel | float, DataFrame]:
    """A model of `labels.toxic` outside the held-out ids, or the one kind there is; and the documents' vectors."""
    marked = stored(_marked(labels), "labels")
    totals = {r.label: r["count"] for r in marked.groupBy("label").count().collect()}
    rows = examples(docs, marked) if len(totals) == 2 else None
    sizes = {r.label: r["count"] for r in rows.groupBy("label").count().collect()} if rows else {}
    if len(sizes) < 2:
        return float(max(sizes or totals or {0: 0})), vectors(docs, [])
    known = terms(rows)
    of_docs = stored(vectors(docs, known), "vectors")
    frequency = of_docs.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
    idf = np.full(len(known), 1.0 + of_docs.count())
    for r in frequency:
        idf[r.term] /= 1 + r["count"]
    idf = 1 + np.log(idf)
    number = {w: i for i, w in enumerate(known)}
    listed = F.broadcast(of_docs.sparkSession.createDataFrame(list(number.items()), "word string, term int")) if known else None
    digests, kinds, data = [], [], []
    if known:
        pairs = rows.select("digest", "label", F.explode(F.arrays_zip("words", "counts")).alias("x")).select(
            "digest", "label", F.col("x.words").alias("word"), F.col("x.counts").alias("n"))
        few = pairs.join(listed, "word").groupBy("digest", "label").agg(F.array_sort(F.collect_list(F.struct("term", "n"))).alias("x"))
        for r in sorted(few.collect(), key=lambda r: (r.digest, r.label)):
            ids = np.array([p.term for p in r.x])
            digests.append(r.digest)
            kinds.append(r.label)
            data.append((ids, weigh(ids, np.array([p.n for p in r.x]), idf)))
    kinds = np.array(kinds, np.int64)
    all_rows, all_labels = sizes[0] + sizes[1], totals[0] + totals[1]
    shares = tuple(totals[k] / all_labels / (sizes[k] / all_rows) for k in (0, 1))
    bare = [shares[k] * (sizes[k] - int((kinds == k).sum())) for k in (0, 1)]
    base = (bare[1] + 0.5 * shares[1]) / (sum(bare) + sum(shares))
    model = ToxicityModel(known, idf, BlockMaxIndex(data), kinds, digests, shares, base)
    own = np.array([model.vote(model.index.nearest(*v, NEIGHBOURS, without=i)) for i, v in enumerate(data)])
    empty = [k for k in (0, 1) if bare[k] > 0]
    model.curve = calibration(
        np.concatenate([own, [model.vote([])] * len(empty)]), np.concatenate([kinds, empty]),
        np.concatenate([np.array(shares)[kinds], [bare[k] for k in empty]]))
    return model, of_docs


SCORED = "doc_id long, score double, terms array<string>, neighbours array<struct<cosine:double,example_sha256:string,toxic:int>>"


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, score and its evidence: the text's terms and the nearest examples, of every document."""
    prepare(docs.sparkSession)
    model, of_docs = fit(docs, labels)
    neighbour = pa.struct([("cosine", pa.float64()), ("example_sha256", pa.string()), ("toxic", pa.int32())])
    types = [pa.int64(), pa.float64(), pa.list_(pa.string()), pa.list_(neighbour)]
    shared = of_docs.sparkSession.sparkContext.broadcast(model)  # at most SAMPLE_ROWS examples of TERMS terms

    def judged(ids, counts) -> tuple:
        m = shared.value
        if isinstance(m, float):
            return m, [], []
        value, found = m.judged(ids, counts)
        return value, [m.terms[i] for i in ids], [(c, m.digests[n], int(m.labels[n])) for c, n in found]

    def run(batches) -> Iterator[pa.RecordBatch]:
        known = {}
        for batch in batches:
            out = []
            for ids, counts in zip(batch.column("terms").to_pylist(), batch.column("counts").to_pylist()):
                key = (*ids, *counts)
                if key not in known:
                    if len(known) > 4096:
                        known.clear()
                    known[key] = judged(ids, counts)
                out.append(known[key])
            scores, found, near = zip(*out) if out else ((), (), ())
            near = [[dict(zip(("cosine", "example_sha256", "toxic"), n)) for n in x] for x in near]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(list(c), t) for c, t in zip((scores, found, near), types[1:]))],
                ["doc_id", "score", "terms", "neighbours"])

    # The vectors take little room and long to judge: dealt by number, not by bytes.
    return of_docs.repartition(max(1, -(-of_docs.count() // SCORED_ROWS))).mapInArrow(run, SCORED)


def predictions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: fold, score, predicted class and evidence."""
    return score(docs, labels).select(
        "doc_id", (crc_fold(F.col("doc_id"), 4) == 2).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "terms", "neighbours")
