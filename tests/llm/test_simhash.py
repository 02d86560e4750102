"""SimHash: fingerprints, block comparison, buckets and components against brute force."""

import numpy as np
import xxhash
from pyspark.sql import functions as F

from revtide.llm import simhash
from revtide.llm.components import connected_components
from revtide.llm.queries import QUERIES
from tests.llm.helpers import SF_DIR, lower, odd_documents, rows, texts, words


def fingerprint(text):
    found = words(lower(text))
    if not found:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(found[i:i + 4]).encode(), 42) for i in range(max(1, len(found) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(nodes, near):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in near:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def close(prints):
    prints = sorted(prints)
    return [(a, b) for i, a in enumerate(prints) for b in prints[i + 1:] if (a ^ b).bit_count() <= 4]


def expected(docs):
    """(doc_id, fingerprint, component_id) of (doc_id, text) pairs."""
    prints = [(d, fingerprint(t)) for d, t in docs]
    root, least = roots({p for _, p in prints}, close({p for _, p in prints})), {}
    for d, p in prints:
        if d is not None:
            least[root[p]] = min(d, least.get(root[p], d))
    return sorted(((d, f"{p:016x}", least.get(root[p])) for d, p in prints), key=repr)


def test_query_equals_brute_force(spark):
    assert rows(QUERIES["op3_simhash"](spark, SF_DIR)) == expected(texts().items())


def test_odd_rows(spark):
    docs = odd_documents(spark)
    assert rows(simhash.near_duplicates(docs)) == expected([(r.doc_id, r.text) for r in docs.collect()])
    assert rows(simhash.near_duplicates(docs.limit(0))) == []


def chained_prints(seed, groups=30, size=30, others=1500):
    """Random fingerprints among chains of few-bit changes."""
    rng = np.random.default_rng(seed)
    out = [int(x) for x in rng.integers(0, 1 << 63, others)]
    for _ in range(groups):
        value = int(rng.integers(0, 1 << 63))
        for _ in range(size):
            other = value
            for bit in rng.integers(0, 64, rng.integers(0, 5)):
                other ^= 1 << int(bit)
            out.append(other)
            value = other if rng.random() < 0.3 else value
    return sorted(set(out))


def test_bit_sliced_forest_equals_brute_force():
    prints = chained_prints(1)
    a, b = simhash.forest(np.array(prints, np.uint64))
    assert all((x, y) for x, y in zip(a, b) if x > y)
    assert roots(prints, zip(a.tolist(), b.tolist())) == roots(prints, close(prints))


def test_every_link_meets_in_a_bucket_at_any_block_size(spark):
    prints = chained_prints(2, groups=12, size=40, others=300)
    signed = [int(np.uint64(p).astype(np.int64)) for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "print long")
    near = {(x, y) for x, y in close(prints)}
    for block in (8, 64, 8192):  # divided twice and block against block, once, not at all
        met = {}
        for bucket, p in simhash.buckets(frame, block=block).collect():
            met.setdefault(bucket, set()).add(p % (1 << 64))
        assert max(map(len, met.values())) <= 2 * max(block, 40)
        assert all(any(a in group and b in group for group in met.values()) for a, b in near)


def test_components_of_a_star_a_chain_and_bad_links(spark):
    star, chain = [(0, i) for i in range(1, 200)], [(i, i + 1) for i in range(1000, 1040)]
    pairs = star + [(b, a) for a, b in chain] + [(5, 5), (None, 3), (7, None), (0, 1)]
    got = dict(rows(connected_components(spark.createDataFrame(pairs, "a long, b long"))))
    assert got == {**{i: 0 for i in range(200)}, **{i: 1000 for i in range(1000, 1041)}}
    assert rows(connected_components(spark.createDataFrame([], "a long, b long"))) == []


def test_one_row_of_each_group_stays(spark):
    docs = odd_documents(spark)
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    groups = {c for _, _, c in expected([(r.doc_id, r.text) for r in docs.collect()])}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(groups)
    assert rows(simhash.drop_near_duplicates(docs.limit(0))) == []


def test_hex_text(spark):
    got = spark.createDataFrame([(0,), (-1,), (255,)], "v long").select(simhash.hex_text(F.col("v")))
    assert [r[0] for r in got.collect()] == ["0" * 16, "f" * 16, "0" * 14 + "ff"]
