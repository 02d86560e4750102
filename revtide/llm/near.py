"""Near-duplicates by SimHash: pairs whose 5-word Jaccard similarity is LEAST or more.

A document is the set of its 5-word shingles (ASCII lower case; a shorter text is one
shingle), as XXH64 values. Documents with the same set are one class. Its fingerprint is the
majority of each bit over the set. Fingerprints meet in buckets and are compared there by
`simhash`'s bit planes, carry-save counters and abandoned words; those that differ in at most
RADIUS bits are candidates. A pair at 0.8 differs in about 10 of 64 bits and in more than
RADIUS with a probability below 0.00001 (at worst, sets of four and five shingles, 0.0002).
Segments, op3's buckets, would be two or three bits for such a radius, so that nearly
everything meets. Buckets are BANDS bands of ROWS MinHash values instead, one of which a pair
at 0.8 shares with a probability of 1 - (1 - 0.8^4)^20, over 0.9999. In a bucket of more than
simhash.BLOCK classes all are candidates of one of them, without comparison.

What candidates connect is compared exactly, each text
sent once. A connected group of more than PART classes is cut into parts: first each part is
compared in itself and with one common class, then whatever is not in the group's largest
component is compared with all of the group. Pairs that are connected already, or whose MinHash
values agree in less than AGREE, far below LEAST, are not compared.

Texts without a word (null and empty ones too) are one class. Repeated rows give repeated
results. Only the columns doc_id and text are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revtide.llm import simhash
from revtide.llm.base import stored, utf8
from revtide.llm.components import connected_components

SHINGLE, LEAST = 5, 0.8
RADIUS = 24
BANDS, ROWS, AGREE = 20, 4, 0.5
#: Classes in a part of a large group.
PART = 256

_random = np.random.default_rng(17)
_FLIP, _TIMES, _FOLD = (_random.integers(0, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1) for _ in range(3))


# --- sets, fingerprints and MinHash values --------------------------------

def shingles(text: bytes) -> np.ndarray:
    """The different shingle hashes of a UTF-8 text, ascending."""
    import xxhash

    words = text.lower().split()  # bytes: A-Z and the six ASCII spaces only
    if not words:
        return np.zeros(0, np.uint64)
    joined, sizes = b" ".join(words), np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts, ends = (ends - sizes).tolist(), ends[SHINGLE - 1:].tolist() or [len(joined)]
    hash_of = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((hash_of(joined[a:b]) for a, b in zip(starts, ends)), np.uint64, len(ends)))


def minima(found: np.ndarray) -> np.ndarray:
    """BANDS x ROWS MinHash values of a set."""
    least = np.full(BANDS * ROWS, 0xFFFFFFFFFFFFFFFF, np.uint64)
    for at in range(0, len(found), 1 << 12):
        mixed = (found[at:at + (1 << 12), None] ^ _FLIP) * _TIMES
        np.minimum(least, mixed.min(axis=0), out=least)
    return least


def fingerprint(found: np.ndarray) -> int:
    """The unsigned 64-bit fingerprint of a set; without shingles zero."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(found), 1 << 16):
        ones += simhash.set_bits(found[at:at + (1 << 16)])
    return simhash.majority(ones, len(found))


def signed(docs: DataFrame) -> DataFrame:
    """key, doc_id, `class` (a hash of the set), its `print` and `bands`, the buckets of its MinHash values."""
    source = docs.select(F.xxhash64("doc_id", "text").alias("key"), "doc_id", "text")

    def run(batches):
        import xxhash

        for batch in batches:
            classes, prints, bands = [], [], []
            for text in utf8(batch.column(2)):
                found = shingles(text)
                classes.append(xxhash.xxh64_intdigest(found.tobytes()))
                prints.append(fingerprint(found))
                folded = (minima(found) * _FOLD).reshape(BANDS, ROWS).sum(axis=1, dtype=np.uint64) + _FLIP[:BANDS]
                bands.append(folded.view(np.int64) if len(found) else np.zeros(0, np.int64))
            numbers = [pa.array(np.array(n, np.uint64).view(np.int64)) for n in (classes, prints)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *numbers, pa.array(bands, pa.list_(pa.int64()))],
                ["key", "doc_id", "class", "print", "bands"])

    columns = {"class": F.lit(0).cast("long"), "print": F.lit(0).cast("long"), "bands": F.array(F.lit(0).cast("long"))}
    return source.mapInArrow(run, source.drop("text").withColumns(columns).schema)


# --- candidates -----------------------------------------------------------

def near_prints(buckets: np.ndarray, classes: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (class, class) that connect exactly what pairs of a bucket within RADIUS connect."""
    names, node = np.unique(classes, return_inverse=True)
    parent = np.arange(len(names))
    for i, j in simhash.near_pairs(prints, RADIUS):
        met = buckets[i] == buckets[j]
        parent = simhash.join_sets(parent, node[i[met]], node[j[met]])
    moved = np.flatnonzero(parent != np.arange(len(names)))
    return names[moved], names[parent[moved]]


def candidates(keyed: DataFrame) -> DataFrame:
    """Links (a, b) that connect the candidates; rows are (class, print, bucket)."""
    leads = stored(keyed.groupBy("bucket").agg(F.min("class").alias("lead"), F.count("*").alias("n")).filter("n > 1"), "leads")
    met = keyed.join(leads.filter(F.col("n") <= simhash.BLOCK), "bucket").select("bucket", "class", "print")
    full = keyed.join(leads.filter(F.col("n") > simhash.BLOCK), "bucket").filter("class <> lead")

    def run(batches):
        for buckets, classes, prints in simhash.bundles(batches):
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in near_prints(buckets, classes, prints.view(np.uint64))], ["a", "b"])

    dealt = met.repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(run, "a long, b long").union(full.select("class", "lead"))


# --- exact comparison -----------------------------------------------------

def exact_links(texts: list[bytes], labels: np.ndarray) -> list[tuple[int, int]]:
    """Places (i, j) that connect what pairs at LEAST or more connect, beyond equal labels."""
    sets = [shingles(t) for t in texts]
    sizes, signs = np.array([len(s) for s in sets]), np.stack([minima(s) for s in sets])
    label, out = np.unique(labels, return_inverse=True)[1], []
    for i in range(len(sets) - 1):
        rest = np.arange(i + 1, len(sets))
        like = (np.minimum(sizes[rest], sizes[i]) >= LEAST * np.maximum(sizes[rest], sizes[i])) & (label[rest] != label[i])
        rest = rest[like]
        for j in rest[(signs[rest] == signs[i]).mean(axis=1) >= AGREE].tolist():
            if label[i] != label[j]:
                both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if both >= LEAST * (sizes[i] + sizes[j] - both) - 1e-9:
                    out.append((i, j))
                    label[label == label[j]] = label[i]
    return out


def _compared(blocks: DataFrame) -> DataFrame:
    """Links (a, b) between the classes of each block; rows are (block, class, label, text)."""
    def run(batches):
        held, last, out = {}, None, []

        def flush():
            names = list(held)
            texts, labels = [held[c][1] for c in names], np.array([held[c][0] for c in names], np.int64)
            return [(names[i], names[j]) for i, j in exact_links(texts, labels)] if len(names) > 1 else []

        def rows():
            a, b = zip(*out)
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        for batch in batches:
            for block, name, label, text in zip(*[batch.column(i).to_pylist() for i in range(3)], utf8(batch.column(3))):
                if block != last:
                    out += flush()
                    held, last = {}, block
                    if len(out) >= 10_000:
                        yield rows()
                        out = []
                held[name] = (label, text)
        out += flush()
        if out:
            yield rows()

    dealt = blocks.select("block", "class", "label", "text").repartition("block").sortWithinPartitions("block", "class")
    return stored(dealt.mapInArrow(run, "a long, b long"), "near-links")


def _spread(n: str):
    return F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))


def _parts(n: str):
    return F.ceil(F.col(n) / PART).cast("long")


def confirmed(held: DataFrame) -> DataFrame:
    """(node, component) over the exact links within each group; rows are (class, group, parts, text)."""
    own = F.pmod(F.xxhash64("class"), "parts")
    first = held.select("group", own.alias("part"), "class", "text").union(
        held.filter("parts > 1 and class = group").select("group", _spread("parts").alias("part"), "class", "text"))
    found = _compared(first.withColumn("block", F.xxhash64("group", "part")).withColumn("label", F.col("class")))
    component = connected_components(found)
    large = held.filter("parts > 1")
    if not large.head(1):
        return component
    state = stored(large.select("class", "group").join(component, F.col("class") == F.col("node"), "left").select(
        "class", "group", F.coalesce("component", "class").alias("label")), "near-state")
    most = state.groupBy("group", "label").count().groupBy("group").agg(F.max_by("label", F.struct("count", "label")).alias("most"), F.sum("count").alias("n"))
    left = state.join(most, "group").groupBy("group", "most").agg(F.sum((F.col("label") != F.col("most")).cast("long")).alias("n"))
    left = stored(left.filter("n > 0").select("group", "most", _parts("n").alias("others")), "near-left")
    rows = large.join(state.select("class", "label"), "class").join(left, "group")
    other = F.pmod(F.xxhash64("class"), "others")
    second = rows.select("group", own.alias("part"), _spread("others").alias("other"), "class", "label", "text").union(
        rows.filter("label <> most").select("group", _spread("parts").alias("part"), other.alias("other"), "class", "label", "text"))
    more = _compared(second.withColumn("block", F.xxhash64("group", "part", "other")))
    return connected_components(found.union(more))


def classified(docs: DataFrame) -> DataFrame:
    """(key, doc_id, component) of each document; `key` is a hash of id and text."""
    all_docs = stored(signed(docs), "signed")
    classes = stored(all_docs.groupBy("class").agg(F.min("key").alias("key"), F.first("print").alias("print"), F.first("bands").alias("bands")), "near-classes")
    near = candidates(classes.select("class", "print", F.explode("bands").alias("bucket")))
    groups = stored(connected_components(near).select(F.col("node").alias("class"), F.col("component").alias("group")), "near-groups")
    sizes = stored(groups.groupBy("group").agg(F.count("*").alias("n")).select("group", _parts("n").alias("parts")), "near-sizes")
    asked = stored(groups.join(sizes, "group").join(classes.select("class", "key"), "class"), "near-asked")
    texts = docs.select(F.xxhash64("doc_id", "text").alias("key"), "text")
    held = stored(texts.join(asked, "key").select("class", "group", "parts", "text"), "near-texts")
    owner = classes.select("class").join(confirmed(held), F.col("class") == F.col("node"), "left").select(
        "class", F.coalesce("component", "class").alias("component"))
    # Written, so that the join below stands on plain shuffles, whose hot parts Spark splits.
    return all_docs.select("key", "doc_id", "class").join(stored(owner, "near-owners"), "class").select("key", "doc_id", "component")
