"""Nearest labelled examples against brute force, and what they say of held-out texts."""

import hashlib
import math
from collections import Counter

import duckdb
import numpy as np
import pytest

from revtide.llm import toxicity
from revtide.llm.base import read
from revtide.llm.queries import QUERIES
from tests.llm.helpers import odd_documents, rows

SF_DIR = "/root/testdata/sf0.1"


def cosine(a, b):
    return sum(w * b[t] for t, w in sorted(a.items()) if t in b)


@pytest.mark.parametrize("block", [1, 3, 64])
def test_index_finds_the_nearest(monkeypatch, block):
    monkeypatch.setattr(toxicity, "BLOCK", block)
    r = np.random.default_rng(4)
    data = []
    for _ in range(400):
        ids = np.flatnonzero(r.random(30) < r.choice([0.03, 0.1, 0.3]))
        if len(ids):  # small whole counts make many ties
            data.append((ids, toxicity.weigh(ids, r.integers(1, 3, len(ids)), np.ones(30))))
    index = toxicity.BlockMaxIndex(data)
    for me, (ids, w) in enumerate(data[:150]):
        for without in (-1, me):
            scored = [(-round(cosine(dict(zip(ids.tolist(), w)), dict(zip(a.tolist(), b))), 9), n) for n, (a, b) in enumerate(data) if n != without]
            want = sorted(x for x in scored if x[0])[:7]
            got = index.nearest(ids, w, 7, without)
            assert [-round(c, 9) for c, _ in got] == [s for s, _ in want]
            inner = [n for s, n in want if s != want[-1][0]]  # rounding may part equal ones
            assert {*inner} <= {n for _, n in got}


def test_blocks_that_cannot_hold_a_nearer_one_stay_shut():
    data = [(np.array([0]), np.array([1.0]))] * 64 + [(np.array([0, i + 1]), np.array([0.1, 0.995])) for i in range(640)]
    index = toxicity.BlockMaxIndex(data)
    opened, find = [], np.searchsorted
    try:
        np.searchsorted = lambda *a: opened.append(1) or find(*a)
        assert [n for _, n in index.nearest([0], [1.0], 16)] == list(range(16))
    finally:
        np.searchsorted = find
    assert len(opened) == 1


def test_scores_equal_brute_force_over_the_examples(spark):
    docs, labels = read(spark, SF_DIR, "documents").filter("doc_id < 1500"), read(spark, SF_DIR, "labels")
    model, _ = toxicity.fit(docs, labels)
    known, texts = {t: i for i, t in enumerate(model.terms)}, {r.doc_id: r.text or "" for r in docs.collect()}
    counts = {d: {w: n for w, n in toxicity.words(t).items() if w in known} for d, t in texts.items()}
    df = Counter(w for c in counts.values() for w in c)
    idf = {w: 1 + math.log((1 + len(texts)) / (1 + df[w])) for w in known}

    def unit(c):
        raw = {w: (1 + math.log(n)) * idf[w] for w, n in c.items()}
        length = math.sqrt(sum(v * v for v in raw.values()))
        return {w: v / length for w, v in raw.items()}

    examples = {}
    for d, y in [(r.doc_id, r.toxic) for r in toxicity._marked(labels).withColumnRenamed("label", "toxic").collect()]:
        if counts.get(d):
            examples[hashlib.sha256(texts[d].encode()).hexdigest(), y] = unit(counts[d])
    assert sorted(examples) == sorted(zip(model.digests, model.labels.tolist()))
    got = {r.doc_id: r for r in toxicity.score(docs, labels).collect()}
    assert got.keys() == texts.keys()
    for d, c in counts.items():
        assert sorted(got[d].terms) == sorted(c)
        near = sorted(((cosine(unit(c), e), n) for n, e in enumerate(examples[k] for k in sorted(examples))), key=lambda x: (-x[0], x[1])) if c else []
        near = [x for x in near if x[0] > 0][:toxicity.NEIGHBOURS]
        assert [n.cosine for n in got[d].neighbours] == pytest.approx([x for x, _ in near])
        found = [(x.cosine, model.digests.index(x.example_sha256)) for x in got[d].neighbours]
        total = toxic = 0.1
        toxic *= model.base
        for x, n in found:
            weight = model.weights[model.labels[n]] * 0.1 / (0.1 + max(0, 1 - x))
            total, toxic = total + weight, toxic + weight * model.labels[n]
        odds = math.log(toxic / total / (1 - toxic / total))
        assert got[d].score == pytest.approx(1 / (1 + math.exp(-(model.curve[0] * odds + model.curve[1]))), rel=1e-6)


def test_held_out_labels(spark):
    got = {r.doc_id: r for r in QUERIES["op11_toxicity"](spark, SF_DIR).select("doc_id", "held_out", "score", "predicted").collect()}
    labels = duckdb.sql(f"select doc_id, toxic from '{SF_DIR}/labels.parquet'").fetchall()
    held = [(y, got[d]) for d, y in labels if got[d].held_out]
    assert len(held) > 900 and np.mean([r.predicted for y, r in held if y]) > 0.9 and np.mean([r.predicted for y, r in held if not y]) < 0.03
    # As likely as they say, in two halves.
    for part in ([x for x in held if x[1].score < 0.5], [x for x in held if x[1].score >= 0.5]):
        assert abs(np.mean([y for y, _ in part]) - np.mean([r.score for _, r in part])) < 0.1


def test_calibration_finds_the_curve_of_least_loss():
    r = np.random.default_rng(0)
    votes = r.uniform(0.05, 0.95, 4000)
    true = 1 / (1 + np.exp(-(1.7 * np.log(votes / (1 - votes)) - 0.8)))
    a, b = toxicity.calibration(votes, (r.random(4000) < true).astype(int), np.ones(4000))
    assert abs(a - 1.7) < 0.2 and abs(b + 0.8) < 0.2


def test_words_of_long_texts_are_cut_between_words(monkeypatch):
    text = "Über die Maßen stupid, x9y!\n" * 200
    whole = toxicity.words(text)
    monkeypatch.setattr(toxicity, "PIECE_CHARS", 7)
    assert toxicity.words(text) == whole == Counter({w: 200 for w in ("über", "die", "maßen", "stupid", "x", "y")})


def test_odd_documents_and_labels(spark):
    docs = odd_documents(spark)
    marks = spark.createDataFrame([(i, None if i == 2 else i, i % 2 if i else None, "x") for i in range(16)] + [(3, 3, 0, "x"), (3, 3, 1, "x"), (None, 1, 1, "x")],
                                  "doc_id long, quality int, toxic int, text string")
    got = toxicity.predictions(docs, marks)
    assert got.columns[:4] == ["doc_id", "held_out", "score", "predicted"] and got.count() == docs.count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.collect())
    for kinds, want in (([], 0.0), ([0], 0.0), ([1], 1.0)):
        few = spark.createDataFrame([(i, 0, k) for k in kinds for i in range(16)], "doc_id long, quality int, toxic int")
        assert {r.score for r in toxicity.predictions(docs, few).collect()} == {want}
    assert rows(toxicity.predictions(docs.limit(0), marks)) == []


def test_near_copies_do_not_make_terms(spark):
    filler = [f"word{chr(97 + i)}{chr(97 + j)}" for i in range(20) for j in range(20)]
    r = np.random.default_rng(1)
    toxic = [" ".join(["boilerplate", "lines", "of", "one", "page", *r.choice(filler[:3], 1)]) for _ in range(200)]
    toxic += ["vile " + " ".join(r.choice(filler, 30)) for _ in range(60)]
    clean = [" ".join(r.choice(filler, 30)) for _ in range(600)]
    data = [(i, t) for i, t in enumerate([*toxic, *clean])]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    marks = spark.createDataFrame([(i, int(i < len(toxic))) for i, _ in data], "doc_id long, toxic int")
    found = toxicity.examples(docs, toxicity._marked(marks))
    assert toxicity.terms(found) == ["vile"]
