"""Nearest neighbours: recall, scores and ties against brute force."""

import duckdb
import numpy as np
from pyspark.sql import functions as F

from revtide.llm import ann
from revtide.llm.queries import QUERIES
from tests.llm.helpers import rows

SF_DIR = "/root/testdata/sf0.001"


def exact(ids, vectors, queries, k):
    """{query: [(id, score)]} by all inner products."""
    out = {}
    for q in queries:
        scores = ann.exact(vectors[ids.index(q)], vectors)
        order = sorted((-s, i) for s, i in zip(scores, ids) if i != q)[:k]
        out[q] = [(i, -s) for s, i in order]
    return out


def found(frame):
    out = {}
    for q, _, i, s in sorted(frame.select("query_id", "rank", "id", "score").collect()):
        out.setdefault(q, []).append((i, s))
    return out


def test_query_recall_and_scores(spark):
    data = duckdb.sql(f"select vec_id, embedding from '{SF_DIR}/embeddings.parquet' order by 1").fetchall()
    ids, vectors = [r[0] for r in data], np.array([r[1] for r in data], float)
    want = exact(ids, vectors, [i for i in ids if i % 20 == 0], 20)
    got = found(QUERIES["op2_adaptive_scan"](spark, SF_DIR).withColumnRenamed("vec_id", "id"))
    assert got.keys() == want.keys()
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 20 * len(want)
    for q, best in got.items():
        assert len(best) == 20 and best == sorted(best, key=lambda x: (-x[1], x[0]))
        assert all(s == ann.exact(vectors[ids.index(q)], vectors[[ids.index(i)]])[0] for i, s in best)


def test_several_lists_and_blocks_with_very_many_copies(spark, monkeypatch):
    monkeypatch.setattr(ann, "PER_LIST", 60)
    monkeypatch.setattr(ann, "BLOCK", 25)
    monkeypatch.setattr(ann, "QUERIES", 4)
    rng = np.random.default_rng(4)
    vectors = rng.standard_normal((900, 40)) * rng.uniform(0.2, 3, (900, 1))
    vectors[300:600] = vectors[300]  # a third of all rows
    ids = list(range(900))
    frame = spark.createDataFrame([(i, v.tolist(), 0) for i, v in zip(ids, vectors)], "vec_id long, v array<double>, score int")
    got = found(ann.search(frame, "vec_id", "v", F.col("id") % 10 == 0, 15))
    want = exact(ids, vectors, range(0, 900, 10), 15)
    hits = sum(len(set(got[q]) & set(want[q])) for q in want)
    assert hits >= 0.9 * 15 * len(want)
    assert got[300] == want[300] and got[590] == want[590]


def test_lists_to_visit_hold_the_best_of_clustered_vectors_of_uneven_length(spark, monkeypatch):
    monkeypatch.setattr(ann, "PER_LIST", 100)
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((20, 32))
    vectors = centres[rng.integers(0, 20, 2000)] + 0.3 * rng.standard_normal((2000, 32))
    vectors *= np.exp(rng.standard_normal((2000, 1))) / np.linalg.norm(vectors, axis=1, keepdims=True)
    ids = list(range(2000))
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, vectors)], "vec_id long, v array<double>")
    got = found(ann.search(frame, "vec_id", "v", F.col("id") % 20 == 0, 20))
    want = exact(ids, vectors, range(0, 2000, 20), 20)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.93 * 20 * len(want)


def test_test_never_abandons_the_clearly_best():
    rng = np.random.default_rng(7)
    vectors = rng.standard_normal((500, 64))
    query = vectors[17] + 0.1 * rng.standard_normal(64)
    rotation = np.linalg.qr(rng.standard_normal((64, 64)))[0]
    lists = np.arange(500) % 3
    left = ann.Block(vectors, lists, rotation).search(query, query @ rotation, np.array([0, 1, 2]), 5)
    assert 17 in left and len(left) < 500
    some = ann.Block(vectors, lists, rotation).search(query, query @ rotation, np.array([1]), 5)
    assert set(lists[some]) == {1}


def test_few_are_left_of_vectors_spread_evenly():
    rng = np.random.default_rng(8)
    for length in (np.ones((3000, 1)), np.exp(0.5 * rng.standard_normal((3000, 1)))):
        vectors = rng.standard_normal((3000, 64)) * length
        vectors[100:130] = vectors[100]  # more copies than asked for
        rotation, other = (np.linalg.qr(rng.standard_normal((64, 64)))[0] for _ in range(2))
        block = ann.Block(vectors, np.zeros(3000, int), rotation)
        hits = 0
        for query in vectors[:120]:
            left = block.search(query, query @ other, np.array([0]), 10)
            assert len(left) >= 10  # even where the estimates are wrong
            left = block.search(query, query @ rotation, np.array([0]), 10)
            assert len(left) <= 45
            hits += len(set(np.argsort(-ann.exact(query, vectors), kind="stable")[:10]) & set(left))
        assert hits >= 0.98 * 10 * 120


def test_odd_vectors(spark):
    inf, nan = float("inf"), float("nan")
    data = [(0, [1.0, 2.0], "a"), (20, [1.0, 2.0], "a"), (20, [1.0, 2.0], "a"), (1, None, None), (2, [0.0, 0.0], "b"), (3, [1.0, None], "c"),
            (4, [nan, 1.0], "d"), (5, [inf, 1.0], "e"), (None, [1.0, 1.0], None), (40, [3.0], "f"), (60, [], "g"), (7, [-1.0, 0.5], "h")]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<double>, rank string")
    got = found(ann.search(frame, "vec_id", "embedding", F.col("id") % 20 == 0, 20))
    assert got == {0: [(20, 5.0), (7, 0.0)], 20: [(0, 5.0), (7, 0.0)]}
    assert rows(ann.search(frame.limit(0), "vec_id", "embedding", F.col("id") % 20 == 0, 20)) == []
