"""SimHash near-duplicates by bit-sliced comparison.

Fingerprints: the majority of each bit over the XXH64 values (seed 42) of a document's
4-word shingles, repeats included. Only distinct fingerprints are compared. Two that
differ in at most `RADIUS` bits agree in at least one of RADIUS + 1 segments, so they
meet in the bucket of that segment's value; a bucket with more than `BLOCK` fingerprints
is divided once more by the segments of the other bits, and what is still larger is
compared block against block. Nothing is left out at any size.

Within a block the fingerprints are stored as vertical bit planes. The distances of one
fingerprint to 64 others are counted together by carry-save additions of plane words; a
word is abandoned once all its 64 distances exceed the radius.

Texts without a word (null and empty ones too) have fingerprint zero and are linked like
any other. A null doc_id has a fingerprint and links others, and is never the smallest id
unless all ids of the component are null. Repeated rows give repeated results. Only the
columns doc_id and text are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from revtide.llm.base import stored, unused_name, utf8
from revtide.llm.components import connected_components

SHINGLE, SEED, RADIUS = 4, 42, 4
#: Fingerprints in a block; small buckets are compared together up to TOGETHER.
BLOCK, TOGETHER = 8_192, 512
#: Plane words in work at once.
TILE_WORDS = 1 << 16


# --- fingerprints ---------------------------------------------------------

def fingerprint(text: bytes) -> int:
    """The unsigned 64-bit fingerprint of a UTF-8 text."""
    import xxhash

    words = text.lower().split()  # bytes: A-Z and the six ASCII spaces only
    if not words:
        return 0
    joined, sizes = b" ".join(words), np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts, ends = (ends - sizes).tolist(), ends[SHINGLE - 1:].tolist() or [len(joined)]
    hash_of, ones, count = xxhash.xxh64_intdigest, np.zeros(64, np.int64), len(ends)
    for at in range(0, count, 1 << 16):
        part = list(zip(starts[at:at + (1 << 16)], ends[at:at + (1 << 16)]))
        ones += set_bits(np.fromiter((hash_of(joined[a:b], SEED) for a, b in part), np.uint64, len(part)))
    return majority(ones, count)


def set_bits(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each of the 64 bits, the highest first."""
    return np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)


def majority(ones: np.ndarray, count: int) -> int:
    """The bits that more than half of `count` hashes have."""
    return int.from_bytes(np.packbits(2 * ones > count).tobytes(), "big")


def fingerprints(docs: DataFrame) -> DataFrame:
    """key, doc_id and `print`, the fingerprint as a signed 64-bit integer."""
    source = docs.select(F.xxhash64("doc_id", "text").alias("key"), "doc_id", "text")

    def run(batches):
        for batch in batches:
            prints = np.array([fingerprint(t) for t in utf8(batch.column(2))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(prints)], ["key", "doc_id", "print"])

    return source.mapInArrow(run, source.drop("text").withColumn("print", F.lit(0).cast("long")).schema)


def hex_text(value: Column) -> Column:
    return F.lpad(F.lower(F.hex(value)), 16, "0")


# --- comparison within a block --------------------------------------------

def bit_planes(prints: np.ndarray) -> np.ndarray:
    """64 rows, one for each bit; a word of a row holds that bit of 64 fingerprints."""
    width = -(-len(prints) // 64)
    bits = np.zeros((64, width * 64), np.uint8)
    for p in range(64):
        bits[p, :len(prints)] = (prints >> np.uint64(p)) & np.uint64(1)
    return np.packbits(bits, axis=1, bitorder="little").view("<u8")


def _near(prints: np.ndarray, planes: np.ndarray, low: int, high: int, radius: int):
    """Pairs (i, j), j > i, within the radius for the rows from low to high."""
    first = low // 64
    rows, words = np.meshgrid(np.arange(low, high), np.arange(first, planes.shape[1]), indexing="ij")
    rows, words = rows.ravel(), words.ravel()
    count = [np.zeros(len(rows), np.uint64) for _ in range(radius.bit_length())]
    over = np.zeros(len(rows), np.uint64)
    for p in range(64):
        bit = (prints[low:high] >> np.uint64(p)) & np.uint64(1)
        carry = planes[p][words] ^ (np.uint64(0) - bit)[rows - low]
        for k in range(len(count)):  # carry-save: each word adds to 64 counters
            count[k], carry = count[k] ^ carry, count[k] & carry
        over |= carry
        if p % 8 == 7:
            far = over | _above(count, radius)
            left = np.flatnonzero(far != np.uint64(0xFFFFFFFFFFFFFFFF))
            if len(left) < 0.9 * len(rows) or p == 63:
                rows, words, over = rows[left], words[left], over[left]
                count, far = [c[left] for c in count], far[left]
            if not len(rows):
                break
    if not len(rows):
        return rows, words
    close = np.unpackbits((~far).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    at, bit = np.nonzero(close)
    i, j = rows[at], words[at] * 64 + bit
    real = (j > i) & (j < len(prints))
    return i[real], j[real]


def _above(count: list[np.ndarray], radius: int) -> np.ndarray:
    """Bits whose counter, lowest digit first, is over the radius."""
    more, same = np.zeros_like(count[0]), ~np.zeros_like(count[0])
    for k in reversed(range(len(count))):
        if radius >> k & 1:
            same &= count[k]
        else:
            more |= same & count[k]
            same &= ~count[k]
    return more


def near_pairs(prints: np.ndarray, radius: int):
    """Arrays (i, j), j > i, that hold all pairs within the radius, tile by tile."""
    planes = bit_planes(prints)
    step = max(1, TILE_WORDS // planes.shape[1])
    for low in range(0, len(prints), step):
        yield _near(prints, planes, low, min(low + step, len(prints)), radius)


def join_sets(parent: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    while True:
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent = up
        a, b = parent[i], parent[j]
        apart = a != b
        if not apart.any():
            return parent
        np.minimum.at(parent, np.maximum(a, b)[apart], np.minimum(a, b)[apart])


def forest(prints: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Links (member, root) that connect exactly what links within the radius connect."""
    prints = np.unique(prints)
    parent = np.arange(len(prints))
    for i, j in near_pairs(prints, radius):
        if len(i):
            parent = join_sets(parent, i, j)
    moved = np.flatnonzero(parent != np.arange(len(prints)))
    return prints[moved], prints[parent[moved]]


# --- buckets --------------------------------------------------------------

def segments(low: int, bits: int, parts: int) -> list[tuple[int, int]]:
    """(start, bits) of the nearly equal parts of a run of bits."""
    sizes = [bits // parts + (k < bits % parts) for k in range(parts)]
    return [(low + sum(sizes[:k]), size) for k, size in enumerate(sizes)]


def _value(column: Column, start: int, bits: int) -> Column:
    return F.shiftrightunsigned(column, start).bitwiseAND(F.lit((1 << bits) - 1))


def _keys(column: Column, parts: list[tuple[int, int]]) -> Column:
    """An array of bucket numbers, one for each part; at most 2^13 values in a part."""
    return F.array(*[F.lit(k << 13) + _value(column, *part) for k, part in enumerate(parts)])


def buckets(prints: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """(bucket, print): everything that must be compared meets in a bucket of bounded size."""
    outer = segments(0, 64, radius + 1)
    keyed = prints.select("print", F.explode(_keys(F.col("print"), outer)).alias("key"))
    # At most 2^13 values in each of the segments: a small table at any input size.
    large = F.broadcast(keyed.groupBy("key").count().filter(F.col("count") > block).select("key"))
    small = keyed.join(large, "key", "left_anti").select(F.col("key").alias("bucket"), "print")
    inner = F.lit(None)
    for k, (start, bits) in enumerate(outer):  # the other bits, turned to the low end
        end = start + bits
        turned = F.col("print") if end == 64 else F.shiftrightunsigned("print", end).bitwiseOR(
            F.shiftleft("print", 64 - end))
        inner = F.when(F.shiftright("key", 13) == k, _keys(turned, segments(0, 64 - bits, radius + 1))).otherwise(inner)
    deep = keyed.join(large, "key").select(
        "print", "key", F.explode(inner).alias("sub")
    ).select("print", (F.shiftleft(F.col("key") + 1, 20) + F.col("sub")).alias("bucket"))
    parts = deep.groupBy("bucket").count().filter(F.col("count") > block).select(
        "bucket", F.ceil(F.col("count") / (block // 2)).cast("long").alias("parts"))
    own = F.pmod(F.xxhash64("print"), "parts")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))
    pairs = deep.join(parts, "bucket").select("print", "bucket", own.alias("own"), other.alias("other")).filter(
        "own <> other").select(F.xxhash64("bucket", F.least("own", "other"), F.greatest("own", "other")).alias("bucket"), "print")
    whole = deep.join(parts, "bucket", "left_anti").select("bucket", "print")
    return small.union(whole).union(pairs)


def bundles(batches):
    """The columns of whole buckets, small ones up to TOGETHER rows at once. Rows come sorted by the first column, the bucket."""
    held, size, last = [], 0, None
    for batch in batches:
        columns = [c.to_numpy() for c in batch.columns]
        keys = columns[0]
        cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        for start, end in zip([0, *cuts], [*cuts, len(keys)]):
            if keys[start] != last and size >= TOGETHER:
                yield [np.concatenate(c) for c in zip(*held)]
                held, size = [], 0
            last = keys[start]
            held.append([c[start:end] for c in columns])
            size += end - start
    if size > 1:
        yield [np.concatenate(c) for c in zip(*held)]


def links(prints: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """Links (a, b) between distinct fingerprints that span all links within the radius.

    Rows of other buckets in the same comparison can only add true links.
    """
    def run(batches):
        for _, values in bundles(batches):
            a, b = forest(values.view(np.uint64), radius)
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    dealt = buckets(prints, radius, block).repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(run, "a long, b long")


def classified(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(key, doc_id, print, component, component_id) of each document.

    `key` is a hash of id and text; `component` is the smallest linked fingerprint.
    """
    prints = stored(fingerprints(docs), "prints")
    classes = stored(prints.groupBy("print").agg(F.min("doc_id").alias("first")), "classes")
    component = connected_components(links(classes.select("print"), radius))
    linked = classes.join(component, F.col("print") == F.col("node"))
    least = linked.groupBy("component").agg(F.min("first").alias("component_id"))
    moved = linked.join(least, "component").select("print", "component", "component_id")
    owner = classes.join(moved, "print", "left").select(
        "print", F.coalesce("component", "print").alias("component"), F.coalesce("component_id", "first").alias("component_id"))
    # Written, so that the join below stands on plain shuffles, whose hot parts Spark splits.
    return prints.join(stored(owner, "owners"), "print")


def near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint and component_id, the smallest doc_id that links can reach."""
    return classified(docs, radius).select("doc_id", hex_text(F.col("print")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """One row of each component, that with the smallest id; nulls come last. All columns."""
    return first_of_each(docs, classified(docs, radius))


def first_of_each(docs: DataFrame, component_of: DataFrame) -> DataFrame:
    """The row with the smallest id of each component; rows of `component_of` are (key, doc_id, component)."""
    of_id, of_key, count, place = (unused_name(docs, n) for n in ("of_id", "of_key", "rows", "place"))
    each = component_of.groupBy("component", "doc_id", "key").agg(F.count("*").alias("n"))
    first = F.struct(F.isnull("doc_id"), "doc_id", "key")
    chosen = stored(each.groupBy("component").agg(F.min_by(F.struct("doc_id", "key", "n"), first).alias("x")).select(
        F.col("x.doc_id").alias(of_id), F.col("x.key").alias(of_key), F.col("x.n").alias(count)), "chosen")
    mine = F.xxhash64(docs["doc_id"], docs["text"]) == chosen[of_key]
    kept = docs.join(chosen, mine & docs["doc_id"].eqNullSafe(chosen[of_id]))
    if chosen.filter(F.col(count) > 1).head(1):  # the row itself is repeated
        nth = F.row_number().over(W.partitionBy(of_key, of_id).orderBy(of_id))
        kept = kept.withColumn(place, nth).filter(F.col(place) == 1)
    return kept.select(*[docs[c] for c in docs.columns])
