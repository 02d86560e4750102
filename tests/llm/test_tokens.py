"""Token counts and byte-level BPE against the libraries on whole texts."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from revtide.llm import bpe, chunks, token_counts
from revtide.llm.queries import QUERIES
from tests.llm.helpers import ODD_TEXTS, SF_DIR, odd_documents, rows, texts

WORD_FILE = public_tokenizers.path("word_bpe_49k.json")
RANKS, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    tok = Tokenizer.from_file(WORD_FILE)
    return lambda text: len(tok.encode(text or "", add_special_tokens=False).ids)


def test_token_counts_equal_the_library(spark, library):
    got = rows(QUERIES["op1_token_counts"](spark, SF_DIR))
    want = [(d, len(t.encode()), n := library(t), n > 2048) for d, t in texts().items()]
    assert got == sorted(want, key=repr)


def test_token_counts_of_odd_rows(spark, library, monkeypatch):
    monkeypatch.setattr(token_counts, "CHUNK_BYTES", 1000)
    docs = odd_documents(spark)
    want = [(r.doc_id, len((r.text or "").encode()), library(r.text)) for r in docs.collect()]
    assert rows(token_counts.token_counts(docs, WORD_FILE)) == sorted(want, key=repr)
    assert rows(token_counts.token_counts(docs.limit(0), WORD_FILE)) == []


def test_token_counts_in_steps(spark, library, monkeypatch):
    """Small chunks and buckets, two slices a step: several levels of nodes, the same counts."""
    monkeypatch.setattr(token_counts, "CHUNK_BYTES", 3000)
    monkeypatch.setattr(chunks, "BUCKET_KEYS", 400)
    monkeypatch.setattr(chunks, "FAN", 2)
    levels, merge = [], token_counts._merged
    monkeypatch.setattr(token_counts, "_merged", lambda *a: levels.append(a[2]) or merge(*a))
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").union(odd_documents(spark).select("doc_id", "text", "lang", "source", "n_chars")).limit(60)
    want = [(r.doc_id, len((r.text or "").encode()), library(r.text)) for r in docs.collect()]
    assert rows(token_counts.token_counts(docs, WORD_FILE)) == sorted(want, key=repr) and len(levels) > 1


def test_direct_splitting_equals_the_library():
    random.seed(3)
    fast, slow = token_counts.LowerCaseSplitter(WORD_FILE), token_counts.Splitter(WORD_FILE)
    for _ in range(2000):
        word = "".join(random.choice("aBs'l1.<|-_") for _ in range(random.randint(1, 9))).encode()
        assert fast(word) == slow(word)


def test_packing_and_buckets():
    values = np.array([0, 7, 1 << 31, 5])
    assert chunks.unpack(chunks.pack(values)).tolist() == values.tolist()
    assert chunks.unpack(chunks.pack(np.zeros(0))).tolist() == []
    hashes = np.sort(np.random.default_rng(0).integers(0, 1 << 63, 500).astype(np.uint64) * np.uint64(2))
    cut = list(chunks.slices(hashes, 7))
    assert [s for _, s, _ in cut] == [0] + [e for _, _, e in cut][:-1] and cut[-1][2] == 500
    assert [b for b, _, _ in cut] == list(range(7)) and list(chunks.slices(hashes[:0], 7)) == []


def test_bpe_equals_the_library(spark):
    enc = bpe.encoding(RANKS, PATTERN)

    def row(doc, text):
        ids = enc.encode_ordinary(text or "")
        return (doc, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                hashlib.sha256((text or "").encode()).hexdigest())

    assert rows(QUERIES["op8_byte_bpe"](spark, SF_DIR)) == sorted((row(d, t) for d, t in texts().items()), key=repr)
    docs = odd_documents(spark)
    assert rows(bpe.digests(docs, RANKS, PATTERN)) == sorted((row(r.doc_id, r.text) for r in docs.collect()), key=repr)
    assert rows(bpe.digests(docs.limit(0), RANKS, PATTERN)) == []


def test_long_texts_split_where_the_pattern_splits():
    random.seed(1)
    enc = bpe.encoding(RANKS, PATTERN)
    for _ in range(2000):
        text = "".join(random.choice("ab 1 \t\n'sé.,!%ß中 \x1c　") for _ in range(60))
        parts = list(bpe.safe_parts(text, 7))
        assert "".join(parts) == text
        assert [i for p in parts for i in enc.encode_ordinary(p)] == enc.encode_ordinary(text)
    assert list(bpe.safe_parts("x" * 50, 7)) == ["x" * 50]


def test_raw_bytes_that_are_no_text_come_back():
    enc = bpe.encoding(RANKS, PATTERN)
    some = bpe.ids_of(ODD_TEXTS[8], RANKS, PATTERN)
    assert bpe.bytes_of(some[:1].tobytes(), RANKS, PATTERN) == enc.decode_single_token_bytes(int(some[0]))
