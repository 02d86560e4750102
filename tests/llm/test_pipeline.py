"""The pipeline: every stage's decisions take effect on all that the one before kept."""

import hashlib

import duckdb
import numpy as np
import public_tokenizers

import corpus_pipeline
from revtide.llm import bpe, mixing
from revtide.llm.base import read, stored
from tests.llm.helpers import odd_documents, texts, words
from tests.llm.test_native import planted, water_filling
from tests.llm.test_near import kept_of

SF_DIR = "/root/testdata/sf0.01"


def test_stages(spark):
    stages = dict(corpus_pipeline.STAGES)
    docs = read(spark, SF_DIR, "documents")
    columns, all_texts = docs.columns, texts(SF_DIR)

    def after(name, before):
        out = stored(stages[name](spark, before, SF_DIR), "stage")
        return out, {r.doc_id: r.text for r in out.collect()} if name != "byte-level BPE" else None

    good, kept = after("quality classifier", docs)
    labels = dict(duckdb.sql(f"select doc_id, quality from '{SF_DIR}/labels.parquet' where quality is not null").fetchall())
    assert good.columns == columns and all(all_texts[d] == t for d, t in kept.items())
    assert np.mean([(d in kept) == (y == 1) for d, y in labels.items()]) > 0.97

    unique, single = after("near-duplicates", good)
    assert unique.columns == columns and sorted(single) == kept_of(list(kept.items()))

    clean, safe = after("secrets", unique)
    assert clean.columns == columns and safe.keys() == single.keys()
    for d, t in single.items():
        hidden = t
        for s in planted(t):
            hidden = hidden.replace(s, "[SECRET]")
        assert safe[d] == hidden

    mixed, _ = after("mixing", clean)
    assert mixed.columns == columns
    copies = {d: n for d, n in duckdb.sql("select doc_id, count(*) from x group by 1", connection=_with(mixed.toPandas())).fetchall()}
    sizes, taken = {}, {}
    for r in clean.collect():
        n = len(words(r.text))
        sizes[r.source] = sizes.get(r.source, 0) + n
        taken[r.source] = taken.get(r.source, 0) + n * copies.get(r.doc_id, 0)
    assert max(copies.values()) == 2
    for s, target in water_filling(sizes).items():
        assert abs(taken[s] - target) <= 0.05 * target

    coded = stages["byte-level BPE"](spark, mixed, SF_DIR).collect()
    enc = bpe.encoding(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    assert len(coded) == mixed.count()
    for r in coded[::50]:
        assert r.n_tokens == len(enc.encode_ordinary(safe[r.doc_id]))
        assert r.decoded_sha256 == hashlib.sha256(safe[r.doc_id].encode()).hexdigest()


def _with(frame):
    con = duckdb.connect()
    con.register("x", frame)
    return con


def test_run_goes_through_all_stages(spark):
    sf = "/root/testdata/sf0.001"
    out = corpus_pipeline.run(spark, sf)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert 0 < out.count() <= 2 * len(texts(sf))


def test_stages_take_odd_and_empty_documents(spark):
    for docs in (odd_documents(spark), odd_documents(spark).limit(0)):
        docs = stored(docs, "odd")
        for name, stage in corpus_pipeline.STAGES:
            before, docs = docs, stored(stage(spark, docs, "/root/testdata/sf0.001"), "stage")
            if name != "byte-level BPE":
                assert docs.columns == before.columns


def test_stages_give_clashing_columns_back(spark):
    docs = odd_documents(spark).selectExpr("doc_id", "text", "lang", "source", "n_chars", "'a' as quality", "'b' as found", "'c' as of_key", "'d' as of_id", "'e' as rows", "'f' as place")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "/root/testdata/sf0.001")
        assert out.columns == docs.columns, name
        assert {tuple(r)[5:] for r in out.collect()} <= {("a", "b", "c", "d", "e", "f")}, name
