"""Language-model scores and the quality classifier."""

import math
import tracemalloc
import zlib
from collections import Counter

import duckdb
import numpy as np
import pandas as pd

from revtide.llm import chunks, interpolation, quality_model
from revtide.llm.queries import QUERIES
from tests.llm.helpers import SF_DIR, lower, odd_documents, rows, texts, words


def base_rows(docs):
    """The contract's columns but the model's score."""
    tokens = [(d, words(lower(t)) + [None], zlib.crc32(str("" if d is None else d).encode()) % 7 == 2) for d, t in docs]
    counts = Counter(w for _, ws, held in tokens if not held for w in ws)
    n, v = sum(counts.values()), len(counts)
    return sorted(((d, held, len(ws), sum(counts[w] > 0 for w in ws), n,
                    round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws), 6)) for d, ws, held in tokens), key=repr)


def scored(frame):
    got = frame.collect()
    return got, sorted(((*tuple(r)[:5], round(r.base_score, 6)) for r in got), key=repr)


def test_base_scores_and_better_than_the_base(spark):
    got, base = scored(QUERIES["op4_deleted_interpolation"](spark, SF_DIR))
    assert base == base_rows(texts().items())
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held) * 0.95
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)


def test_scores_of_odd_rows_in_small_chunks(spark, monkeypatch):
    monkeypatch.setattr(interpolation, "CHUNK_BYTES", 500)
    docs = odd_documents(spark)
    got, base = scored(interpolation.score(docs))
    assert base == base_rows([(r.doc_id, r.text) for r in docs.collect()])
    whole = {}
    for r in got:  # equal texts score the same, whatever chunk they are in
        whole.setdefault((r.n_tokens, round(r.base_score, 6)), set()).add(round(r.score, 9))
    assert all(len(v) == 1 for v in whole.values())
    assert interpolation.score(docs.limit(0)).collect() == []


def test_scores_in_steps(spark, monkeypatch):
    """Several levels of nodes give the counts that one exchange gives; a chunk makes few slices."""
    monkeypatch.setattr(interpolation, "CHUNK_BYTES", 20_000)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").union(odd_documents(spark).select("doc_id", "text", "lang", "source", "n_chars"))
    one = scored(interpolation.score(docs))
    monkeypatch.setattr(chunks, "BUCKET_KEYS", 9000)
    monkeypatch.setattr(chunks, "FAN", 3)
    levels, merge = [], interpolation._merged
    monkeypatch.setattr(interpolation, "_merged", lambda *a: levels.append(a[2]) or merge(*a))
    many = scored(interpolation.score(docs))
    key = lambda r: repr(tuple(round(x, 6) if isinstance(x, float) else x for x in r))
    assert len(levels) > 1 and one[1] == many[1] and sorted(map(key, one[0])) == sorted(map(key, many[0]))
    state = interpolation.tokenized(docs)
    assert max(r["count"] for r in interpolation._questions(state, 3, 0).groupBy("chunk").count().collect()) <= 3


def test_model_equals_brute_force(spark):
    """Score by counts in Python, with the weights that EM gives for the same cells."""
    docs = list(texts().items())
    fold = {d: zlib.crc32(str(d).encode()) % 7 for d, _ in docs}
    tokens = {d: words(lower(t)) + [""] for d, t in docs}

    def counted(keep):
        uni, bi = Counter(), Counter()
        for d, ws in tokens.items():
            if keep(fold[d]):
                uni.update(ws)
                bi.update(zip([None, *ws], ws))
        uni_context = uni.copy()
        uni_context[None] = sum(keep(f) for f in fold.values())
        return uni, bi, uni_context

    def parts(model, before, w):
        uni, bi, context = model
        n, v = sum(uni.values()), len(uni)
        c = context[before]
        return c, bi[before, w] / max(c, 1), uni[w] / n, 1 / (v + 1)

    kept = counted(lambda f: f not in (2, 0))
    cells = []
    for d, ws in tokens.items():
        if fold[d] == 0:
            for before, w in zip([None, *ws], ws):
                c, p2, p1, _ = parts(kept, before, w)
                step = lambda p: math.floor(math.log2(p) * interpolation.STEPS) if p else -10**6
                cells.append((c.bit_length(), step(p2), step(p1), p2, p1, 1))
    frame = pd.DataFrame(cells, columns=["bucket", "s2", "s1", "p2", "p1", "events"])
    weights = interpolation.mixture_weights(frame.groupby(["bucket", "s2", "s1"], as_index=False).sum(), len(kept[0]))
    assert np.allclose(weights.sum(axis=1), 1) and weights[0, 0] == 0
    train = counted(lambda f: f != 2)
    got = {r.doc_id: r.score for r in interpolation.score(
        spark.read.parquet(f"{SF_DIR}/documents.parquet")).collect()}
    for d, ws in tokens.items():
        want = 0.0
        for before, w in zip([None, *ws], ws):
            c, *p = parts(train, before, w)
            want += math.log10(float(np.dot(weights[c.bit_length()], p)))
        assert math.isclose(got[d], want, rel_tol=1e-6)


def test_em_finds_the_mixture():
    """Events drawn from a known mixture bring its weights back."""
    rng = np.random.default_rng(0)
    p = np.array([[0.5, 0.01], [0.0, 0.2], [0.02, 0.05]])
    true = np.array([0.3, 0.6, 0.1])
    share = (np.c_[p, np.full(3, 0.1)] * true).sum(axis=1)
    events = rng.multinomial(200_000, share / share.sum())
    cells = pd.DataFrame({"bucket": 3, "p2": p[:, 0] * events, "p1": p[:, 1] * events, "events": events})
    found = interpolation.mixture_weights(cells, 9)[3]
    worse = lambda m: (events * np.log((np.c_[p, np.full(3, 0.1)] * m).sum(axis=1))).sum()
    assert worse(found) >= worse(true) - 1e-6


def test_quality_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in QUERIES["op6_quality_classifier"](spark, sf).collect()}
    labels = dict(duckdb.sql(f"select doc_id, quality from '{sf}/labels.parquet' where quality is not null").fetchall())
    held = [(got[d], y) for d, y in labels.items() if got[d].held_out]
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 3 == 1) for d, r in got.items())
    assert np.mean([r.predicted == y for r, y in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())


def test_quality_of_odd_rows(spark):
    docs = odd_documents(spark)
    labels = spark.createDataFrame([(4, 1, 0), (4, 0, 0), (11, 0, None), (12, 1, 0), (None, 1, 1), (3, None, 0)],
                                   "doc_id long, quality int, toxic int")
    got = quality_model.predictions(docs, labels)
    assert sorted((r.doc_id for r in got.collect()), key=repr) == sorted((r.doc_id for r in docs.collect()), key=repr)
    assert {r.score for r in quality_model.predictions(docs, labels.limit(0)).collect()} == {0.5}
    assert rows(quality_model.predictions(docs.limit(0), labels)) == []
    passed = quality_model.score(docs, quality_model.fit(docs, labels), out="_q")
    assert passed.columns == [*docs.columns, "_q"] and passed.count() == docs.count()


def test_long_texts_are_read_in_pieces_without_change(monkeypatch):
    text = "Some words, and MORE words. " * 50
    hasher = quality_model.Hasher()
    count = lambda: Counter(x for p in quality_model.pieces(text) for x in hasher.features(quality_model._points(p))[0])
    whole = count()
    monkeypatch.setattr(quality_model, "PIECE_CHARS", 40)
    assert count() == whole


def test_training_features_are_not_held_in_memory(monkeypatch):
    monkeypatch.setattr(quality_model, "EPOCHS", 1)
    rng = np.random.default_rng(3)
    data = [("".join(map(chr, rng.choice([32, *range(97, 123)], 8_000))), i % 2) for i in range(400)]
    hasher = quality_model.Hasher()
    size = sum(8 * len(quality_model.shares(t, hasher)[0]) for t, _ in data)
    tracemalloc.start()
    model = quality_model.train(iter(data))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert model.vectors.any() and 50e6 < size and peak < 0.7 * size
    with quality_model.spooled(iter(data)) as (count, known):
        for i in (399, 0, 150):
            ids, weights = quality_model.shares(data[i][0], hasher)
            got = known(i)
            assert count == 400 and (got[0] == ids).all() and (got[1] == weights).all() and got[2] == i % 2
