"""Language-model scores by deleted interpolation.

A token's probability mixes maximum-likelihood estimates of the bigram, the unigram and
the uniform distribution:

    P(w | v) = l2 * c(v w) / c(v) + l1 * c(w) / N + l0 / (V + 1)

The weights l depend on the frequency of the context v, in buckets of powers of two. One
fold of the training documents is deleted from the counts, and expectation-maximisation on
the counts of that fold finds each bucket's weights. The scoring model then counts all
training documents.

Every chunk of documents asks once for each of its distinct words and bigrams, and the
counts come back in the same order (see `chunks`): no n-gram is hot, and nothing is cut
off. N-grams are told apart by 63-bit hashes. A document's first token has the context
"start", counted once per document.

A null text counts as empty: its only token is the end. Without training documents every
score is 0. Repeated rows are learned from and scored each. Only doc_id and text are read.
"""

from __future__ import annotations

from itertools import count as counting
from collections import defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revtide.llm.base import crc_fold, stored, utf8
from revtide.llm.chunks import Numbering, exchange, node_number, pack, slices, unpack

FOLDS, HELD_OUT, DELETED = 7, 2, 0
#: Text bytes in a chunk; a task builds one for each of the three parts at once.
CHUNK_BYTES = 8 << 20
KEPT_PART, DELETED_PART, TEST_PART = 0, 1, 2
START, END = 1, 0  # their numbers among a chunk's words
#: Cells per factor of two when held-out events are summed up for the mixture weights.
STEPS, ROUNDS, LEAST_WEIGHT = 4, 60, 1e-6
_MIX = np.uint64(0xD6E8FEB86659FD93)


# --- chunks of documents as numbered tokens -------------------------------

def tokenized(docs: DataFrame) -> DataFrame:
    """Chunks: ids, tokens per document, the words of all tokens, the words' hashes.

    Each chunk belongs to one part: kept, deleted or test.
    """
    fold = crc_fold(F.col("doc_id"), FOLDS)
    part = F.when(fold == HELD_OUT, TEST_PART).when(fold == DELETED, DELETED_PART).otherwise(KEPT_PART)
    source = docs.select("doc_id", "text", part.alias("part"))
    kind = source.schema["doc_id"].dataType
    schema = (f"chunk long, part int, doc_ids array<{kind.simpleString()}>, sizes binary, tokens binary, "
              "hashes binary, n_keys long")
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        number, open_chunks = Numbering(), {}

        def close(part):
            ids, sizes, tokens, words, _ = open_chunks.pop(part)
            hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words))
            flat = np.concatenate(tokens)
            row = {"chunk": number(), "part": part, "doc_ids": ids, "sizes": pack(np.array(sizes)),
                   "tokens": pack(flat), "hashes": hashes.tobytes(), "n_keys": len(flat)}
            return pa.RecordBatch.from_pylist([row], schema=arrow)

        for batch in batches:
            columns = batch.column(0).to_pylist(), utf8(batch.column(1)), batch.column(2).to_pylist()
            for doc, data, part in zip(*columns):
                if part not in open_chunks:
                    words = defaultdict(counting().__next__)
                    words[b" end"], words[b" start"]  # no word holds a space
                    open_chunks[part] = [[], [], [], words, 0]
                held = open_chunks[part]
                number_of = held[3]
                tokens = [number_of[w] for w in data.lower().split()]
                tokens.append(END)
                held[0].append(doc), held[1].append(len(tokens)), held[2].append(np.array(tokens, np.uint32))
                held[4] += len(data)
                if held[4] >= CHUNK_BYTES:
                    yield close(part)
        for part in list(open_chunks):
            yield close(part)

    return source.mapInArrow(run, schema)


class Chunk:
    """The tokens of a chunk and its distinct keys in hash order.

    Keys of words are even, keys of bigrams are odd.
    """

    def __init__(self, row):
        hashes = np.frombuffer(row["hashes"], np.uint64)
        self.sizes = unpack(row["sizes"]).astype(np.int64)
        self.tokens = unpack(row["tokens"]).astype(np.int64)
        first = np.cumsum(self.sizes) - self.sizes
        self.before = np.empty_like(self.tokens)
        self.before[1:] = self.tokens[:-1]
        self.before[first] = START
        words = hashes << np.uint64(1)
        pairs, self.pair_of, pair_counts = np.unique(
            self.before * len(hashes) + self.tokens, return_inverse=True, return_counts=True)
        left, right = hashes[pairs // len(hashes)], hashes[pairs % len(hashes)]
        mixed = (left ^ (left >> np.uint64(31))) * _MIX + right
        mixed = (mixed ^ (mixed >> np.uint64(29))) * _MIX
        keys = np.concatenate([words, mixed | np.uint64(1)])
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]
        counts = np.bincount(self.tokens, minlength=len(hashes))
        self.counts = np.concatenate([counts, pair_counts])[self.order]
        self.n_words = len(hashes)

    def spread(self, answers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts of the words, and of each token's bigram, from those of the sorted keys."""
        back = np.empty(len(answers), np.int64)
        back[self.order] = answers
        return back[:self.n_words], back[self.n_words:][self.pair_of]


# --- counts over the corpus -----------------------------------------------

ANSWER = "chunk long, train binary, kept binary, n long, v long, kept_n long, kept_v long, bucket long"


def _questions(state: DataFrame, n: int, level: int) -> DataFrame:
    """(bucket, chunk, part, steps, counts): the keys of a chunk or node per bucket, and how often each occurs."""
    def ask(batches):
        for batch in batches:
            for i in range(batch.num_rows):  # a chunk is large: one at a time
                (row,) = batch.slice(i, 1).to_pylist()
                if level:
                    keys, counts, kind = np.cumsum(unpack(row["steps"], "<u8")), unpack(row["counts"], "<u8"), "<u8"
                else:
                    chunk = Chunk(row)
                    keys, counts, kind = chunk.keys, chunk.counts, "<u4"
                cut = list(slices(keys, n))
                steps = [pack(np.diff(keys[s:e], prepend=np.uint64(0)), "<u8") for _, s, e in cut]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b for b, _, _ in cut], pa.int64()), pa.array([row["chunk"]] * len(cut), pa.int64()),
                     pa.array([row["part"]] * len(cut), pa.int32()), pa.array(steps, pa.binary()),
                     pa.array([pack(counts[s:e], kind) for _, s, e in cut], pa.binary())], ["bucket", "chunk", "part", "steps", "counts"])

    columns = ["chunk", "part", "steps", "counts"] if level else ["chunk", "part", "sizes", "tokens", "hashes"]
    return state.select(*columns).mapInArrow(ask, "bucket long, chunk long, part int, steps binary, counts binary")


def _joined(rows: pd.DataFrame, level: int):
    """The keys and counts of all slices, and where each slice ends."""
    keys = [np.cumsum(unpack(s, "<u8")) for s in rows["steps"]]
    counts = np.concatenate([unpack(c, "<u8" if level else "<u4") for c in rows["counts"]]).astype(np.float64)  # exact below 2^53
    return np.concatenate(keys), counts, np.cumsum([len(k) for k in keys])


def _merged(questions: DataFrame, groups: int, level: int) -> DataFrame:
    """Nodes: the distinct keys of the slices of a bucket, part and group of chunks, with the places of each slice's keys."""
    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        keys, counts, ends = _joined(rows, level)
        distinct, place = np.unique(keys, return_inverse=True)
        bucket, part = int(rows["bucket"].iloc[0]), int(rows["part"].iloc[0])
        return pd.DataFrame([{
            "chunk": node_number(bucket, part, rows["group"].iloc[0]), "part": part, "bucket": bucket,
            "steps": pack(np.diff(distinct, prepend=np.uint64(0)), "<u8"),
            "counts": pack(np.bincount(place, counts, len(distinct)).astype(np.uint64), "<u8"), "n_keys": len(distinct),
            "members": rows["chunk"].tolist(), "places": [pack(p) for p in np.split(place, ends[:-1])]}])

    dealt = questions.withColumn("group", F.pmod(F.xxhash64("chunk"), F.lit(groups)))
    return dealt.groupBy("bucket", "part", "group").applyInPandas(
        merge, "chunk long, part int, bucket long, steps binary, counts binary, n_keys long, members array<long>, places array<binary>")


def _spread(nodes: DataFrame, answers: DataFrame) -> DataFrame:
    """The answers to the slices that nodes were made of; the bucket's own figures pass through."""
    def spread(held: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        node, known = held.iloc[0], known.sort_values("bucket")
        train, kept = (np.concatenate([unpack(a, "<u8") for a in known[c]]) if known[c].notna().all() else None for c in ("train", "kept"))
        out = [(member, pack(train[place], "<u8"), None if kept is None else pack(kept[place], "<u8"), 0, 0, 0, 0, node["bucket"])
               for member, place in zip(node["members"], map(unpack, node["places"]))]
        return pd.DataFrame(out, columns=["chunk", "train", "kept", "n", "v", "kept_n", "kept_v", "bucket"])

    own = nodes.select("chunk", "bucket", "members", "places")
    mine = answers.filter("chunk >= 0").select("chunk", "bucket", "train", "kept")
    found = own.groupBy("chunk").cogroup(mine.groupBy("chunk")).applyInPandas(spread, ANSWER)
    return found.union(answers.filter("chunk = -1").select(*found.columns))


def _totals(questions: DataFrame, level: int) -> DataFrame:
    def total(rows: pd.DataFrame) -> pd.DataFrame:
        keys, counts, ends = _joined(rows, level)
        starts = np.concatenate([[0], ends[:-1]])
        part = np.repeat(rows["part"].to_numpy(), ends - starts)
        distinct, place = np.unique(keys, return_inverse=True)
        kept = np.bincount(place, counts * (part == KEPT_PART), len(distinct)).astype(np.int64)
        train = kept + np.bincount(place, counts * (part == DELETED_PART), len(distinct)).astype(np.int64)
        word = (distinct & np.uint64(1)) == 0
        out = []
        for chunk, its, start, end in zip(rows["chunk"], rows["part"], starts, ends):
            at = place[start:end]
            out.append((chunk, pack(train[at], "<u8"), pack(kept[at], "<u8") if its == DELETED_PART else None, 0, 0, 0, 0))
        sums = [int(x) for x in (train[word].sum(), (train[word] > 0).sum(), kept[word].sum(), (kept[word] > 0).sum())]
        out.append((-1, None, None, *sums))
        frame = pd.DataFrame(out, columns=["chunk", "train", "kept", "n", "v", "kept_n", "kept_v"])
        frame["bucket"] = rows["bucket"].iloc[0]
        return frame

    return questions.groupBy("bucket").applyInPandas(total, ANSWER)


def corpus_counts(state: DataFrame) -> DataFrame:
    """(chunk, bucket, train, kept, n, v): counts for each chunk's keys, bucket by bucket.

    `kept` is filled for deleted chunks. Rows of chunk -1 hold a bucket's training
    tokens n and distinct training words v, and those without the deleted fold in kept_n
    and kept_v. A bucket holds BUCKET_KEYS keys on average, at most one per chunk or node of each.
    """
    return exchange(state, "n_keys", _questions, _totals, _merged, _spread)


def _looked_up(chunk: Chunk, answers: pd.DataFrame, column: str, n_docs: int):
    """Each token's c(v), c(w) and c(v w)."""
    parts = [unpack(p, "<u8") for p in answers.sort_values("bucket")[column]]
    words, pairs = chunk.spread(np.concatenate(parts).astype(np.int64))
    words = words.copy()
    after = words[chunk.tokens]
    words[START] = n_docs
    return words[chunk.before], after, pairs


def frequency_bucket(counts: np.ndarray) -> np.ndarray:
    """0 for an unseen context, else one bucket per power of two."""
    return np.frexp(counts.astype(np.float64))[1]


def _estimates(context, word, pair, n, v):
    return pair / np.maximum(context, 1), word / max(n, 1), np.full(len(word), 1 / (v + 1))


# --- mixture weights ------------------------------------------------------

def held_out_cells(state: DataFrame, answers: DataFrame, n: int, v: int, n_docs: int) -> DataFrame:
    """Events of the deleted fold in cells of context bucket and estimates.

    A cell's sums give its mean estimates; there are a few thousand cells at any size.
    """
    def cells(held: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        chunk = Chunk(held.iloc[0])
        context, word, pair = _looked_up(chunk, known, "kept", n_docs)
        p2, p1, _ = _estimates(context, word, pair, n, v)
        with np.errstate(divide="ignore"):
            steps = [np.where(p > 0, np.floor(np.log2(p) * STEPS), -1e6).astype(int) for p in (p2, p1)]
        frame = pd.DataFrame({"bucket": frequency_bucket(context), "s2": steps[0], "s1": steps[1], "p2": p2, "p1": p1, "events": 1})
        return frame.groupby(["bucket", "s2", "s1"], as_index=False).sum()

    own = state.filter(F.col("part") == DELETED_PART).drop("doc_ids", "n_keys", "part")
    mine = answers.filter("kept is not null").select("chunk", "bucket", "kept")
    each = own.groupBy("chunk").cogroup(mine.groupBy("chunk")).applyInPandas(
        cells, "bucket int, s2 int, s1 int, p2 double, p1 double, events long")
    return each.groupBy("bucket", "s2", "s1").agg(
        *[F.sum(c).alias(c) for c in ("p2", "p1", "events")])


def mixture_weights(cells: pd.DataFrame, v: int) -> np.ndarray:
    """Weights (bigram, unigram, uniform) of each context bucket, by EM.

    A bucket without held-out events takes the weights of the next lower bucket.
    """
    weights = np.tile([0.0, 0.9, 0.1], (64, 1))
    for bucket in range(64):
        own = cells[cells["bucket"] == bucket]
        if not len(own):
            weights[bucket] = weights[max(bucket - 1, 0)]
            continue
        events = own["events"].to_numpy(float)
        p = np.stack([own["p2"] / events, own["p1"] / events, np.full(len(own), 1 / (v + 1))], axis=1)
        mix = np.array([0.0 if bucket == 0 else 1 / 3, 1 / 3, 1 / 3])
        for _ in range(ROUNDS):
            share = mix * p
            share *= (events / share.sum(axis=1))[:, None]
            mix = share.sum(axis=0) / events.sum()
        mix = np.maximum(mix, [0 if bucket == 0 else LEAST_WEIGHT, LEAST_WEIGHT, LEAST_WEIGHT])
        weights[bucket] = mix / mix.sum()
    return weights


# --- scores ---------------------------------------------------------------

def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of each document."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    state = stored(tokenized(docs), "tokens")
    answers = stored(corpus_counts(state), "counts")
    n, v, kept_n, kept_v = (int(x or 0) for x in answers.filter("chunk = -1").agg(
        *[F.sum(c) for c in ("n", "v", "kept_n", "kept_v")]).first())
    per_part = {row["part"]: row["n"] for row in state.groupBy("part").agg(F.sum(F.size("doc_ids")).alias("n")).collect()}
    kept_docs = per_part.get(KEPT_PART, 0)
    train_docs = kept_docs + per_part.get(DELETED_PART, 0)
    weights = mixture_weights(held_out_cells(state, answers, kept_n, kept_v, kept_docs).toPandas(), kept_v)

    def rate(held: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        row = held.iloc[0]
        chunk = Chunk(row)
        context, word, pair = _looked_up(chunk, known, "train", train_docs)
        estimates = np.stack(_estimates(context, word, pair, n, v), axis=1)
        mixed = (weights[frequency_bucket(context)] * estimates).sum(axis=1) if n else np.ones(len(word))
        owner = np.repeat(np.arange(len(chunk.sizes)), chunk.sizes)
        each = lambda values: np.bincount(owner, values, len(chunk.sizes))
        return pd.DataFrame({
            "doc_id": pd.Series(list(row["doc_ids"]), dtype=object), "held_out": row["part"] == TEST_PART,
            "n_tokens": chunk.sizes, "n_known": each(word > 0).astype(np.int64), "train_tokens": n,
            "base_score": each(np.log10((word + 1) / (n + v + 1))), "score": each(np.log10(mixed)),
        })

    own, mine = state.drop("n_keys"), answers.filter("chunk >= 0").select("chunk", "bucket", "train")
    return own.groupBy("chunk").cogroup(mine.groupBy("chunk")).applyInPandas(
        rate, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
              "base_score double, score double")
