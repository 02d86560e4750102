"""The pipeline's near-duplicates against all pairs of 5-word shingle sets."""

import random

import numpy as np
import pytest

import corpus_pipeline
from revtide.llm import near, simhash
from revtide.llm.base import read
from tests.llm.helpers import lower, odd_documents, words
from tests.llm.test_simhash import roots


def kept_of(docs):
    """The smallest id of each group that pairs at 0.8 or more connect, by an inverted list."""
    sets, seen, near_pairs = {}, {}, []
    for d, text in docs:
        found = words(lower(text))
        sets[d] = frozenset(tuple(found[i:i + 5]) for i in range(max(1, len(found) - 4))) if found else frozenset()
    for d, s in sets.items():
        common = {}
        for x in s or [None]:
            for e in seen.setdefault(x, []):
                common[e] = common.get(e, 0) + 1
            seen[x].append(d)
        near_pairs += [(d, e) for e, n in common.items() if not s or n >= 0.8 * (len(s) + len(sets[e]) - n) - 1e-9]
    return sorted(set(roots(list(sets), near_pairs).values()))


def test_stage_equals_brute_force_jaccard(spark):
    sf = "/root/testdata/sf0.01"
    docs = read(spark, sf, "documents")
    kept = dict(corpus_pipeline.STAGES)["near-duplicates"](spark, docs, sf)
    assert kept.columns == docs.columns
    got = sorted(r.doc_id for r in kept.collect())
    assert got == kept_of([(r.doc_id, r.text) for r in docs.collect()])
    assert not {1, 255} <= set(got)  # 0.831, 7 bits apart


def fingerprint_of(text):
    """The majority of each bit over the different 5-word shingles."""
    import xxhash

    found = words(lower(text))
    hashes = {xxhash.xxh64_intdigest(" ".join(found[i:i + 5]).encode()) for i in range(max(1, len(found) - 4))} if found else set()
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_of_sets(spark):
    docs = odd_documents(spark).filter("doc_id is not null")
    text_of = {r.doc_id: r.text for r in docs.collect()}
    for r in near.signed(docs).collect():
        assert r.print % 2**64 == fingerprint_of(text_of[r.doc_id])


@pytest.mark.parametrize("together, block", [(512, 8192), (1, 8192), (512, 30)])
def test_candidates_are_fingerprints_near_in_a_bucket(spark, monkeypatch, together, block):
    monkeypatch.setattr(simhash, "TOGETHER", together)
    monkeypatch.setattr(simhash, "BLOCK", block)
    rng, rows = random.Random(5), []
    base = [rng.getrandbits(64) for _ in range(12)]
    prints = [base[i % 12] ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(16))) for i in range(150)]
    for c, p in enumerate(prints):  # the first bucket holds 40, over the smaller block
        rows += [(c, p - (1 << 64) * (p >> 63), k) for k in {0 if c < 40 else 99, 1 + rng.randrange(20), 50 + c % 7} if k != 99]
    buckets = {}
    for c, _, k in rows:
        buckets.setdefault(k, []).append(c)
    linked = []
    for inside in buckets.values():
        if len(inside) > block:
            linked += [(min(inside), c) for c in inside]
        else:
            linked += [(c, d) for c in inside for d in inside if c < d and (prints[c] ^ prints[d]).bit_count() <= near.RADIUS]
    got = near.candidates(spark.createDataFrame(rows, "class long, print long, bucket long")).collect()
    assert roots(range(150), [(r.a, r.b) for r in got]) == roots(range(150), linked)
    met = [(min(inside), c) for inside in buckets.values() for c in inside]
    assert len(set(roots(range(150), met).values())) == 1 < len(set(roots(range(150), linked).values()))


def test_pairs_at_the_bound_are_within_the_radius():
    rng, apart = np.random.default_rng(2), []
    for size in (9, 18, 90, 450):  # 8 of 10 shingles common, and so on
        for _ in range(500):
            h = rng.integers(0, 1 << 64, size + size // 9, np.uint64, endpoint=False)
            a, b = near.fingerprint(h[:size]), near.fingerprint(h[size // 9:])
            apart.append((a ^ b).bit_count())
    assert max(apart) <= near.RADIUS and 8 < np.mean(apart) < 11


@pytest.mark.parametrize("part", [4, 16, 256])
def test_groups_over_the_bound(spark, monkeypatch, part):
    monkeypatch.setattr(near, "PART", part)
    rng, data = random.Random(3), []
    for _ in range(3):
        text = [f"w{rng.randrange(9999)}" for _ in range(120)]
        for _ in range(40):
            data.append((len(data), " ".join(text)))
            if rng.random() < 0.9:  # a chain, whose ends are far apart
                text[rng.randrange(120)] = f"n{rng.randrange(9999)}"
            if rng.random() < 0.1:  # below the bound
                for _ in range(5):
                    text[rng.randrange(120)] = "x"
    docs = spark.createDataFrame(data, "doc_id long, text string")
    got = simhash.first_of_each(docs, near.classified(docs))
    assert sorted(r.doc_id for r in got.collect()) == kept_of(data)


def test_odd_rows(spark):
    docs = odd_documents(spark)
    got = [r.doc_id for r in simhash.first_of_each(docs, near.classified(docs)).collect()]
    assert sorted(got) == kept_of([(r.doc_id, r.text) for r in docs.collect() if r.doc_id is not None])
    assert simhash.first_of_each(docs.limit(0), near.classified(docs.limit(0))).collect() == []
