"""Token counts of whole texts without making their ids.

Texts become frequencies of pre-tokens. The pieces of each distinct pre-token are counted
once; the counts are joined to the frequencies and summed. White space of ASCII ends a
pre-token always, so a text is cut into words there and each distinct word is split by the
library's own normalizer and pre-tokenizer. A word that holds one of the library's special
strings stays whole and is counted by the library.

A null text counts as empty: no bytes, no tokens. Repeated rows are counted each. Only the
key column and the text are read.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revtide.llm.base import stored, utf8
from revtide.llm.chunks import CHUNK_BYTES, Numbering, exchange, node_number, pack, slices, unpack

#: Marks a word that the library must encode whole; no pre-token holds a space.
WHOLE = " "


@cache
def library(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class Splitter:
    """The pre-tokens of a word, as the library of a tokenizer file makes them."""

    def __init__(self, path: str):
        self.tok = library(path)
        self.special = [t.content.encode() for t in self.tok.get_added_tokens_decoder().values()]

    def __call__(self, word: bytes) -> list[str]:
        text = word.decode()
        if any(s in word for s in self.special):
            return [WHOLE + text]
        plain = self.tok.normalizer.normalize_str(text) if self.tok.normalizer else text
        return [p for p, _ in self.tok.pre_tokenizer.pre_tokenize_str(plain)]


class LowerCaseSplitter(Splitter):
    """For lower-casing tokenizers whose letters, digits and signs split as below.

    Printable ASCII takes a direct way; all else goes through the library.
    """

    parts = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")

    def __call__(self, word: bytes) -> list[str]:
        if word.isascii() and b"<|" not in word:
            if word.isalpha():
                return [word.decode().lower()]
            text = word.decode()
            if text.isprintable():
                return self.parts.findall(text.lower())
        return super().__call__(word)


def splitter(path: str) -> Splitter:
    """The direct way only where it gives the same as the library on a probe."""
    fast, slow = LowerCaseSplitter(path), Splitter(path)
    probe = bytes(range(33, 127)).split(b"<") + [b"Don't", b"it'Sx", b"WE'LL'd", b"a1b22", b"x--y", b"'''re"]
    return fast if all(fast(w) == slow(w) for w in probe if w) else slow


def count_pieces(path: str, pretoken: str) -> int:
    tok = library(path)
    if pretoken.startswith(WHOLE):
        return len(tok.encode(pretoken[1:], add_special_tokens=False).ids)
    return len(tok.model.tokenize(pretoken))


def hashed(pretoken: str) -> int:
    return xxhash.xxh64_intdigest(pretoken.encode())


def frequencies(docs: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """Chunks of documents: their keys, sizes, pre-token frequencies and distinct pre-tokens."""
    source = docs.select(key, "text")
    schema = (f"chunk long, keys array<{source.schema[key].dataType.simpleString()}>, n_bytes array<long>, "
              "sizes binary, ids binary, counts binary, place binary, pretokens array<string>, n_pretokens long")

    def run(batches):
        split, number, arrow = splitter(path), Numbering(), None

        def chunk():
            hashes = np.fromiter(map(hashed, ids), np.uint64, len(ids))
            order, names = np.argsort(hashes, kind="stable"), list(ids)
            place = np.empty(len(ids), np.int64)
            place[order] = np.arange(len(ids))
            return {
                "chunk": number(), "keys": keys, "n_bytes": n_bytes, "sizes": pack(np.array(sizes)),
                "ids": pack(np.concatenate(found) if found else np.zeros(0)),
                "counts": pack(np.concatenate(counts) if counts else np.zeros(0)), "place": pack(place),
                "pretokens": [names[i] for i in order], "n_pretokens": len(names),
            }

        def fresh():
            return [], [], [], [], [], {}, {}

        keys, n_bytes, sizes, found, counts, ids, words = fresh()
        total = 0
        for batch in batches:
            for doc, data in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
                freq = Counter()
                for word, n in Counter(data.split()).items():
                    mine = words.get(word)
                    if mine is None:
                        mine = words[word] = [ids.setdefault(p, len(ids)) for p in split(word)]
                    for i in mine:
                        freq[i] += n
                at = np.fromiter(freq, np.int64, len(freq))
                order = np.argsort(at)
                keys.append(doc), n_bytes.append(len(data)), sizes.append(len(at))
                found.append(np.diff(at[order], prepend=0))  # small steps pack well
                counts.append(np.fromiter(freq.values(), np.int64, len(freq))[order])
                total += len(data)
                if total >= CHUNK_BYTES:
                    yield [chunk()]
                    keys, n_bytes, sizes, found, counts, ids, words = fresh()
                    total = 0
        if keys:
            yield [chunk()]

    arrow_schema = _arrow(docs, schema)
    return source.mapInArrow(
        lambda batches: (pa.RecordBatch.from_pylist(rows, schema=arrow_schema) for rows in run(batches)), schema)


def _arrow(docs: DataFrame, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def _questions(state: DataFrame, n: int, level: int) -> DataFrame:
    """(bucket, chunk, pretokens): the pre-tokens of a chunk or node per bucket, in the order of their hashes."""
    def ask(batches):
        for batch in batches:
            for i in range(batch.num_rows):  # a chunk is large: one at a time
                chunk, names = batch.slice(i, 1).to_pylist()[0].values()
                hashes = np.fromiter(map(hashed, names), np.uint64, len(names))
                cut = list(slices(hashes, n))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b for b, _, _ in cut], pa.int64()), pa.array([chunk] * len(cut), pa.int64()),
                     pa.array([names[s:e] for _, s, e in cut], pa.list_(pa.string()))],
                    ["bucket", "chunk", "pretokens"])

    return state.select("chunk", "pretokens").mapInArrow(ask, "bucket long, chunk long, pretokens array<string>")


def _merged(questions: DataFrame, groups: int, level: int) -> DataFrame:
    """Nodes: the distinct pre-tokens of the slices of a bucket and group of chunks, with the places of each slice's."""
    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        number: dict[str, int] = {}
        own = [np.fromiter((number.setdefault(p, len(number)) for p in names), np.int64, len(names)) for names in rows["pretokens"]]
        names = list(number)
        order = np.argsort(np.fromiter(map(hashed, names), np.uint64, len(names)), kind="stable")
        place = np.empty(len(names), np.int64)
        place[order] = np.arange(len(names))
        bucket = int(rows["bucket"].iloc[0])
        return pd.DataFrame([{
            "chunk": node_number(bucket, 0, rows["group"].iloc[0]), "bucket": bucket, "pretokens": [names[i] for i in order],
            "n_pretokens": len(names), "members": rows["chunk"].tolist(), "places": [pack(place[i]) for i in own]}])

    dealt = questions.withColumn("group", F.pmod(F.xxhash64("chunk"), F.lit(groups)))
    return dealt.groupBy("bucket", "group").applyInPandas(
        merge, "chunk long, bucket long, pretokens array<string>, n_pretokens long, members array<long>, places array<binary>")


def _spread(nodes: DataFrame, answers: DataFrame) -> DataFrame:
    """The answers to the slices that nodes were made of."""
    def spread(held: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        node = held.iloc[0]
        pieces = np.concatenate([unpack(p) for p in known.sort_values("bucket")["pieces"]])
        return pd.DataFrame([(member, node["bucket"], pack(pieces[unpack(place)])) for member, place in zip(node["members"], node["places"])],
                            columns=["chunk", "bucket", "pieces"])

    own = nodes.select("chunk", "bucket", "members", "places")
    return own.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(spread, "chunk long, bucket long, pieces binary")


def vocabulary_counts(state: DataFrame, path: str) -> DataFrame:
    """(chunk, bucket, pieces): the pieces of each chunk's pre-tokens, in their order.

    All rows with a pre-token meet in its bucket, where its pieces are counted once.
    """
    def count(rows: pd.DataFrame) -> pd.DataFrame:
        pieces: dict[str, int] = {}
        out = []
        for names in rows["pretokens"]:
            for p in names:
                if p not in pieces:
                    pieces[p] = count_pieces(path, p)
            out.append(pack(np.fromiter((pieces[p] for p in names), np.int64, len(names))))
        return pd.DataFrame({"chunk": rows["chunk"], "bucket": rows["bucket"], "pieces": out})

    def total(questions: DataFrame, level: int) -> DataFrame:
        return questions.groupBy("bucket").applyInPandas(count, "chunk long, bucket long, pieces binary")

    return exchange(state, "n_pretokens", _questions, total, _merged, _spread)


def token_counts(docs: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """The key, `n_bytes` and `n_tokens` of every document."""
    state = stored(frequencies(docs, path, key), "frequencies")
    kind = docs.schema[key].dataType.simpleString()

    def total(held: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        known = [unpack(p) for p in answers.sort_values("bucket")["pieces"]]
        row = held.iloc[0]
        sizes, steps, counts = (unpack(row[c]).astype(np.int64) for c in ("sizes", "ids", "counts"))
        ends = np.cumsum(sizes)
        tokens = np.zeros(len(sizes), np.int64)
        if len(steps):
            pieces = np.concatenate(known)[unpack(row["place"])].astype(np.int64)
            owner = np.repeat(np.arange(len(sizes)), sizes)
            run = np.cumsum(steps)
            before = np.concatenate([[0], run])[ends - sizes]
            np.add.at(tokens, owner, pieces[run - before[owner]] * counts)
        return pd.DataFrame({key: pd.Series(list(row["keys"]), dtype=object), "n_bytes": row["n_bytes"], "n_tokens": tokens})

    answers = vocabulary_counts(state, path)
    held = state.select("chunk", "keys", "n_bytes", "sizes", "ids", "counts", "place")
    return held.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(
        total, f"{key} {kind}, n_bytes long, n_tokens long")
