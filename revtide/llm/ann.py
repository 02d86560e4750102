"""Approximate nearest neighbours by inner product, with an adaptive dimension scan.

Index: every vector joins the list of its nearest centroid (of k-means on a bounded
sample). Lists are packed into blocks of bounded size, a large one into several, and are
scanned as vectors rotated by a random orthogonal matrix.
Rows with the same vector are one entry with the ids of its copies; only as many of the
smallest ids as a result can hold are listed, since copies tie and ties go to smaller ids.

Search: a query visits its nearest lists, as many as the sample's neighbours need. In a block the distances to the entries
grow by column blocks of the rotated dimensions. For a random rotation the distance in d
of D dimensions, times sqrt(D / d), estimates the whole one with a relative error of about
1 / sqrt(d). The inner product that a candidate has to reach is, with both norms, a
distance it has to stay within; it is abandoned when the estimate is so many errors beyond
that. The entries that look best after each column block raise that bar. Survivors are scored on the original vectors in double precision, one dimension
after another, so copies score the same.

Vectors that are null, zero, or hold null or non-finite components take no part, nor do
those of another length than most have (of two the longer). A null id can be neither
query nor result. Repeated rows of one id count once. Only the id and vector columns are
read. Fewer candidates than asked give all that the visited lists hold.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from revtide.llm.base import smallest_hashes, stored

#: The k-means sample and its rounds; vectors per list aimed at, and the most lists.
SAMPLE, ROUNDS, PER_LIST, MOST_LISTS = 16_384, 12, 1_000, 4_096
#: A query visits as many lists as hold this share of the sample's true neighbours.
COVERAGE, TRIALS, NEIGHBOURS = 0.97, 256, 20
#: Entries in a block; queries that search a block together at most; dimensions in a column
#: block; errors that the test allows.
BLOCK, QUERIES, COLUMNS, ERRORS = 16_384, 4_096, 16, 2.1


def usable(vectors: DataFrame, id_column: str, vector: str) -> DataFrame:
    """(id, v) of the rows that take part, as double arrays."""
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = rows.filter(F.col("id").isNotNull() & F.col("v").isNotNull()).filter(fine)
    sizes = rows.groupBy(F.size("v").alias("size")).count()
    size = sizes.orderBy(F.desc("count"), F.desc("size")).first()
    return rows.filter(F.size("v") == (size["size"] if size else 0))


@dataclass
class Index:
    """What every task needs: centroids, the rotation, and how many lists to visit."""

    centroids: np.ndarray
    rotation: np.ndarray
    probes: int

    def lists(self, vectors: np.ndarray, n: int) -> np.ndarray:
        """The n lists with the largest inner product of centroid and vector, for each vector."""
        scores = vectors @ self.centroids.T
        n = min(n, scores.shape[1])
        return np.argpartition(-scores, n - 1, axis=1)[:, :n]


def fit(entries: DataFrame, seed: int = 11) -> Index:
    """Spherical k-means on the entries with the smallest hashed ids."""
    few = smallest_hashes(entries.select("id", "v"), SAMPLE, "id", seed=seed).toPandas()
    rows = np.stack(few["v"]) if len(few) else np.zeros((1, 1))
    n = entries.count()
    k = int(np.clip(n // PER_LIST, 1, min(MOST_LISTS, len(rows))))
    random = np.random.default_rng(seed)
    whole = rows
    rows = rows / np.linalg.norm(rows, axis=1, keepdims=True).clip(1e-300)
    centroids = rows[random.choice(len(rows), k, replace=False)]
    for _ in range(ROUNDS):
        nearest = np.argmax(rows @ centroids.T, axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, rows)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = np.where(norms > 0, sums / norms.clip(1e-300), centroids)
    rotation = np.linalg.qr(random.standard_normal((rows.shape[1],) * 2))[0]
    return Index(centroids, rotation, lists_needed(whole, centroids))


def lists_needed(rows: np.ndarray, centroids: np.ndarray) -> int:
    """How many lists hold COVERAGE of the sample rows with the largest inner products with some of them.

    Lists go by direction, neighbours by the vectors as they are.

    Nearer neighbours, as a fuller table has them, lie in no more lists.
    """
    own, some = np.argmax(rows @ centroids.T, axis=1), rows[:TRIALS]  # a length moves no argmax
    scores = some @ rows.T
    scores[np.arange(len(some)), np.arange(len(some))] = -np.inf
    near = np.argsort(-scores, axis=1)[:, :min(NEIGHBOURS, len(rows))]
    place = np.argsort(np.argsort(-(some @ centroids.T), axis=1), axis=1)
    found = np.sort(np.take_along_axis(place, own[near], axis=1).ravel())
    return int(found[int(np.ceil(COVERAGE * len(found))) - 1]) + 1


def in_lists(rows: DataFrame, index: Index, n: int, groups: int) -> DataFrame:
    """Each row once per group with some of its n lists: columns `group` and `lists`."""
    shared = rows.sparkSession.sparkContext.broadcast(index)  # at most MOST_LISTS centroids
    names = rows.columns

    def run(batches):
        for batch in batches:
            found = shared.value.lists(np.stack(batch.column("v").to_numpy(zero_copy_only=False)), n)
            row, group = np.repeat(np.arange(batch.num_rows), found.shape[1]), found.ravel() % groups
            order = np.lexsort((group, row))
            row, group, found = row[order], group[order], found.ravel()[order]
            start = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (group[1:] != group[:-1])])
            lists = pa.ListArray.from_arrays(pa.array(np.r_[start, len(row)], pa.int32()), pa.array(found, pa.int64()))
            out = batch.take(pa.array(row[start]))
            yield pa.RecordBatch.from_arrays([*out.columns, pa.array(group[start], pa.int64()), lists], [*names, "group", "lists"])

    schema = rows.withColumns({"group": F.lit(0).cast("long"), "lists": F.array(F.lit(0).cast("long"))}).schema
    return rows.mapInArrow(run, schema)


# --- the scan -------------------------------------------------------------

def exact(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products in double precision, summed in the order of the dimensions."""
    out = np.zeros(len(vectors))
    for d in range(vectors.shape[1]):
        out += query[d] * vectors[:, d]
    return out


class Block:
    """Entries of a block: rotated vectors in column blocks, with their squared norms."""

    def __init__(self, vectors: np.ndarray, lists: np.ndarray, rotation: np.ndarray):
        self.vectors, self.lists = vectors, lists
        turned = vectors @ rotation
        self.cuts = list(range(0, turned.shape[1], COLUMNS)) + [turned.shape[1]]
        parts = [turned[:, a:b] for a, b in zip(self.cuts, self.cuts[1:])]
        self.columns = [np.ascontiguousarray(p.T) for p in parts]
        self.norms = [(p * p).sum(axis=1) for p in parts]
        self.whole = (vectors * vectors).sum(axis=1)

    def search(self, query: np.ndarray, turned: np.ndarray, lists: np.ndarray, k: int) -> np.ndarray:
        """Places of the entries of these lists that may be among their k best.

        After each column block the k entries that look best set the inner product that the
        others have to reach; they stay. With all dimensions seen little more than k is left.
        """
        asked = np.zeros(max(self.lists.max(), lists.max(initial=0)) + 1, bool)
        asked[lists] = True
        left, all_dims = np.flatnonzero(asked[self.lists]), self.cuts[-1]
        if len(left) <= k:
            return left
        whole, partial, bar = self.whole[left], np.zeros(len(left)), -np.inf
        for b, (start, end) in enumerate(zip(self.cuts, self.cuts[1:])):
            part, columns = turned[start:end], self.columns[b]
            few = 4 * len(left) < len(self.whole)  # then to pick columns is cheaper than to multiply all
            inner = part @ columns[:, left] if few else (part @ columns)[left]
            partial += part @ part + self.norms[b][left] - 2 * inner
            guess = partial * (all_dims / end)
            first = np.argpartition(guess - whole, k - 1)[:k]
            bar = max(bar, (self.vectors[left[first]] @ query).min())
            size = query @ query + whole
            within = np.maximum(size - 2 * bar, 0) + 1e-9 * size
            error = ERRORS / np.sqrt(end) if end < all_dims else 0.0
            stays = guess <= (1 + error) ** 2 * within
            stays[first] = True
            left, whole, partial = left[stays], whole[stays], partial[stays]
        return left


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy())


def search(vectors: DataFrame, id_column: str, vector: str, queries: Column, k: int) -> DataFrame:
    """(query_id, rank, id, score): the k nearest of each row that `queries` selects.

    `queries` is a condition on the column `id`.
    """
    # One id counts once: the vector that sorts first.
    rows = usable(vectors, id_column, vector).groupBy("id").agg(F.min("v").alias("v"))
    rows = stored(rows, "vectors")
    copies = rows.withColumn("n", F.row_number().over(W.partitionBy("v").orderBy("id"))).filter(F.col("n") <= k + 1)
    entries = stored(copies.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")).withColumn("id", F.get("ids", F.lit(0))), "entries")
    index = fit(entries)
    groups = max(1, -(-entries.count() // BLOCK))
    listed = stored(in_lists(entries, index, 1, groups), "lists").withColumn("list", F.get("lists", F.lit(0)))
    # Groups of lists over the bound, as one with a very full list is, are cut by hash.
    sizes = listed.groupBy("group").agg(F.ceil(F.count("*") / (2 * BLOCK)).cast("long").alias("blocks"))
    spark = vectors.sparkSession
    # Queries with the same vector search once, under the smallest of their ids.
    asked = stored(rows.filter(queries).groupBy("v").agg(F.min("id").alias("q")), "queries")
    # The queries of a block are dealt to shares, each with the block's entries, so that no task
    # holds more than QUERIES and few blocks still make work for all cores.
    sent = stored(in_lists(asked, index, index.probes, groups), "asked")
    spread = max(1, 2 * spark.sparkContext.defaultParallelism // groups)
    shares = sent.groupBy("group").agg(F.greatest(F.ceil(F.count("*") / QUERIES), F.lit(spread)).cast("long").alias("shares"))
    shares = stored(sizes.join(shares, "group"), "shares")

    def all_of(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))

    stocked = listed.join(shares, "group").select(
        "group", F.pmod(F.xxhash64("id"), "blocks").alias("block"), all_of("shares").alias("share"), "list", "id", "ids", "v")
    sent = sent.join(shares, "group").select(
        "group", all_of("blocks").alias("block"), F.pmod(F.xxhash64("q"), "shares").alias("share"), "lists", "q", "v")
    shared = spark.sparkContext.broadcast(index)

    def scan(stock: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(stock) and len(wanted):
            rotation = shared.value.rotation
            held = Block(_matrix(stock["v"]), stock["list"].to_numpy(), rotation)
            ids, first = stock["ids"].to_numpy(), stock["id"].to_numpy()
            for q, lists, v in zip(wanted["q"], wanted["lists"], wanted["v"]):
                query = np.asarray(v)
                left = held.search(query, query @ rotation, lists, k + 1)
                scores = exact(query, held.vectors[left])
                best = np.lexsort((first[left], -scores))[:k + 1]
                out += [(q, ids[left[i]], scores[i]) for i in best]
        return pd.DataFrame(out, columns=["q", "ids", "score"])

    place = ["group", "block", "share"]
    found = stocked.groupBy(*place).cogroup(sent.groupBy(*place)).applyInPandas(
        scan, "q long, ids array<long>, score double")
    # The k + 1 best entries of each query vector hold its k best rows, itself left out.
    place = F.row_number().over(W.partitionBy("q").orderBy(F.desc("score"), F.get("ids", F.lit(0))))
    best = found.withColumn("n", place).filter(F.col("n") <= k + 1)
    near = best.select("q", "score", F.explode("ids").alias("near"))
    place = F.row_number().over(W.partitionBy("q").orderBy(F.desc("score"), "near"))
    near = near.withColumn("n", place).filter(F.col("n") <= k + 1)
    answers = near.groupBy("q").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("far"), "near"))).alias("all"))
    mine = rows.filter(queries).select(F.col("id").alias("query_id"), "v").join(asked, "v").select("query_id", "q")
    others = F.slice(F.filter("all", lambda x: x["near"] != F.col("query_id")), 1, k)
    return mine.join(answers, "q").select("query_id", F.posexplode(others).alias("at", "x")).select(
        "query_id", (F.col("at") + 1).alias("rank"), F.col("x.near").alias("id"), (-F.col("x.far")).alias("score"))
