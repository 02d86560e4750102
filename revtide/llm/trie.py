"""A prefix trie of conversations by vertical bitmaps.

A turn is the digest of its role and text, a conversation the path of its turns. Paths are
sorted over the cluster, copies by conv_id, and cut into shards of bounded size, so that a
shard is a run of neighbours in the trie whatever first turns or whole conversations are
frequent. Within a shard every (position, turn) has a bitset of the conversations that have
it; a node is a bitset, its children are the intersections with the postings of the next
position: the lowest conversation left names a turn, whose intersection is taken off. The
popcount is the number of members; those that end there are the node's end list.

Nodes meet across shards only along the first and the last path of a shard, as far as
these agree with the neighbours. Such open nodes come out of each shard as parts that add
up by node: a node counts as owned where it comes first, as a leaf where it comes last. All
others are whole within their shard.

Bounds: a task holds one shard, SHARD_CONVS conversations and SHARD_TURNS turns, or one
longer conversation (20 bytes a turn and its bitmaps). The members of an open node that
end there are hashed as a stream in the order of their ids: one digest over them is one
task's work.

Null role and text are empty. Turns are ordered null first; equal turn numbers by role and
digest, repeated rows are repeated turns. Rows without conv_id are left out; extra columns
are ignored. An empty table has no nodes, not even a root.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revtide.llm.base import prepare, stored
from revtide.llm.repair import CRC_SQL

#: The most conversations and turns of a shard, and turns to a range of the sort.
SHARD_CONVS, SHARD_TURNS, RANGE_TURNS = 1024, 32_768, 400_000
KEY_BYTES = 16

# --- paths ----------------------------------------------------------------


def paths(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, path): per conversation its turns as (key, chars), in order."""
    said, who = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (text, role))
    digest = F.sha2(F.concat(F.octet_length(who).cast("string"), F.lit(":"), who, said), 256)
    turns = conversations.filter(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"), F.struct(
            F.col(turn).cast("long").alias("turn"), who.alias("role"),
            F.unhex(F.substring(digest, 1, 2 * KEY_BYTES)).alias("key"), F.char_length(said).alias("chars")).alias("x"))
    in_order = F.array_sort(F.collect_list("x"))
    return turns.groupBy("conv_id").agg(in_order.alias("x")).select("conv_id", _turns(F.col("x")).alias("path"))


def _turns(found: Column) -> Column:
    """Nulls last is how structs sort; turns without a number come first here."""
    ordered = F.concat(F.filter(found, lambda t: t["turn"].isNull()), F.filter(found, lambda t: t["turn"].isNotNull()))
    return F.transform(ordered, lambda t: F.struct(t["key"].alias("key"), t["chars"].alias("chars")))


def rebuilt(whole: DataFrame) -> DataFrame:
    """Each conversation c with the first crc32(c) % 6 turns of conversation c - c % 100 for its own."""
    head = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6).cast("int")
    none = F.slice("path", 1, 0)
    bases = whole.filter("conv_id % 100 = 0").select(F.col("conv_id").alias("base"), F.slice("path", 1, 5).alias("start"))
    joined = whole.withColumn("base", F.expr("conv_id - conv_id % 100")).join(bases, "base", "left")
    own = F.slice("path", head + 1, F.greatest(F.size("path") - head, F.lit(0)))
    return joined.select("conv_id", F.concat(F.coalesce(F.slice("start", 1, head), none), own).alias("path"))


# --- shards ---------------------------------------------------------------

SHARD = ("part int, seq long, before int, after int, first array<binary>, last array<binary>, "
         "convs binary, lengths binary, keys binary, chars binary")


def _agree(a, b) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def shards(of_paths: DataFrame) -> DataFrame:
    """Runs of neighbouring paths, packed. before, after: turns in common with the neighbours; null at an end of a range."""
    spark = of_paths.sparkSession
    turns = of_paths.agg(F.sum(F.size("path"))).first()[0] or 0
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-turns // RANGE_TURNS))
    keys = of_paths.select("conv_id", F.col("path.key").alias("keys"), F.col("path.chars").alias("chars"))
    ordered = keys.repartitionByRange(n, "keys", "conv_id").sortWithinPartitions("keys", "conv_id")

    def pack(held, seq, before, after):
        lengths = np.array([len(k) for _, k, _ in held], "<i4")
        return (TaskContext.get().partitionId(), seq, before, after, held[0][1], held[-1][1],
                np.array([c for c, _, _ in held], "<i8").tobytes(), lengths.tobytes(),
                b"".join(b"".join(k) for _, k, _ in held), np.concatenate([np.array(x, "<i4") for _, _, x in held]).tobytes())

    def run(batches):
        held, size, seq, before = [], 0, 0, None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and (len(held) >= SHARD_CONVS or size + len(row[1]) > SHARD_TURNS):
                    after = _agree(held[-1][1], row[1])
                    yield _batch([pack(held, seq, before, after)], _ARROW_SHARD)
                    held, size, seq, before = [], 0, seq + 1, after
                held.append(row)
                size += len(row[1])
        if held:
            yield _batch([pack(held, seq, before, None)], _ARROW_SHARD)

    return ordered.mapInArrow(run, SHARD)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


_ARROW_SHARD = pa.schema([("part", pa.int32()), ("seq", pa.int64()), ("before", pa.int32()), ("after", pa.int32()),
                          ("first", pa.list_(pa.binary())), ("last", pa.list_(pa.binary())),
                          *[(c, pa.binary()) for c in ("convs", "lengths", "keys", "chars")]])


def _range_ends(cut: DataFrame) -> dict[int, int]:
    """Per range that has rows, but the first: the turns its first path has in common with the path before.

    One number per range comes to the driver, and there are as many ranges as the sort was given.
    """
    parts = sorted(r.part for r in cut.select("part").distinct().collect())
    spark = cut.sparkSession
    after = spark.createDataFrame(list(zip(parts, parts[1:])), "part int, next int")
    first = cut.filter("before is null").select(F.col("part").alias("next"), "first")
    last = cut.filter("after is null").select("part", "last")
    same = F.zip_with("last", "first", lambda x, y: F.coalesce(x == y, F.lit(False)))
    differs = F.array_position(same, F.lit(False))
    agree = F.when(differs > 0, differs - 1).otherwise(F.size(same)).cast("int")
    return {r.next: r.n for r in after.join(last, "part").join(first, "next").select("next", agree.alias("n")).collect()}


# --- nodes ----------------------------------------------------------------

NODE = "conv_id:long,depth:long,parent_conv_id:long,parent_slot:int,n_convs:long,n_children:long,n_leaves:long,saved_tokens:long,ends_sha256:string"
OPEN = "slot:int,key:binary,parent_key:binary,conv_id:long,depth:long,n_convs:long,n_children:long,n_leaves:long,saved_tokens:long,ends:binary"
BUILT = f"part int, seq long, closed array<struct<{NODE}>>, open array<struct<{OPEN}>>"
_TYPES = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}


def _struct(fields: str):
    return pa.struct([(n, _TYPES[t]) for n, t in (f.split(":") for f in fields.split(","))])


_ARROW_BUILT = pa.schema([("part", pa.int32()), ("seq", pa.int64()), ("closed", pa.list_(_struct(NODE))), ("open", pa.list_(_struct(OPEN)))])


def bitmaps(lengths, keys: bytes) -> tuple[list[dict[bytes, int]], list[int]]:
    """Per position the bitset of each turn, and per length the bitset of the conversations that end there."""
    members: list[dict[bytes, list[int]]] = [defaultdict(list) for _ in range(int(max(lengths, default=0)))]
    at, ends = 0, [[] for _ in range(len(members) + 1)]
    for i, length in enumerate(lengths):
        for position in range(length):
            members[position][keys[at:at + KEY_BYTES]].append(i)
            at += KEY_BYTES
        ends[length].append(i)
    return [{turn: _bitset(i) for turn, i in at_position.items()} for at_position in members], [_bitset(i) for i in ends]


def _bitset(numbers: list[int]) -> int:
    if len(numbers) < 8:
        return sum(1 << i for i in numbers)
    bits = np.zeros(numbers[-1] + 1, np.uint8)
    bits[numbers] = 1
    return int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")


def _numbers(bitset: int) -> np.ndarray:
    data = np.frombuffer(bitset.to_bytes(bitset.bit_length() // 8 + 1, "little"), np.uint8)
    return np.flatnonzero(np.unpackbits(data, bitorder="little"))


def nodes(convs: np.ndarray, lengths: np.ndarray, keys: bytes, chars: np.ndarray, before: int, after: int) -> tuple[list[tuple], list[tuple]]:
    """The closed nodes of a shard and its parts of the open ones; -1 for no neighbour."""
    postings, ending = bitmaps(lengths.tolist(), keys)
    starts = np.concatenate([[0], np.cumsum(lengths)])
    final = 1 << (len(convs) - 1)
    depth, sets, parent, turn_key, size, owned, passed = [], [], [], [], [], [], []
    stack = [(0, (1 << len(convs)) - 1, -1, b"", 0)]
    while stack:  # depth first, a parent before its children
        d, bitset, above, turn, chars_of = stack.pop()
        me = len(depth)
        depth.append(d)
        sets.append(bitset)
        parent.append(above)
        turn_key.append(turn)
        size.append(chars_of)
        owned.append(not (bitset & 1 and d <= before))
        passed.append(bool(bitset & final and d <= after))
        rest = bitset & ~ending[d] if d < len(ending) else 0
        while rest:
            lowest = (rest & -rest).bit_length() - 1
            place = int(starts[lowest]) + d
            turn = keys[place * KEY_BYTES:(place + 1) * KEY_BYTES]
            child = rest & postings[d][turn]
            stack.append((d + 1, child, me, turn, int(chars[place])))
            rest &= ~child
    n = len(depth)
    counts = [s.bit_count() for s in sets]
    children, leaves, saved = [0] * n, [0] * n, [0] * n
    has_children = [False] * n
    for i in range(n - 1, -1, -1):  # children before their parent
        leaves[i] += not has_children[i] and not passed[i]
        saved[i] += counts[i] * size[i] - (size[i] if owned[i] else 0)
        if (p := parent[i]) >= 0:
            has_children[p] = True
            children[p] += owned[i]
            leaves[p] += leaves[i]
            saved[p] += saved[i]
    closed, opened, slots, chain, least = [], [], {}, {}, [0] * n
    for i in range(n):
        members = convs[_numbers(sets[i])] if counts[i] > 1 else convs[[sets[i].bit_length() - 1]]
        least[i] = int(members.min())
        over = sets[i] & ending[depth[i]]
        ends = b",".join(b"%d" % c for c in np.sort(convs[_numbers(over)])) if over else b""
        p = parent[i]
        if owned[i] and not passed[i]:
            inside = p >= 0 and p not in slots
            closed.append((least[i], depth[i], least[p] if inside else None, None if inside or p < 0 else slots[p],
                           counts[i], children[i], leaves[i], saved[i], hashlib.sha256(ends).hexdigest()))
        else:
            slots[i] = len(opened)
            chain[i] = hashlib.blake2b(chain[p] + turn_key[i], digest_size=KEY_BYTES).digest() if p >= 0 else bytes(KEY_BYTES)
            opened.append((slots[i], chain[i], chain.get(p), least[i], depth[i], counts[i], children[i], leaves[i], saved[i], ends))
    return closed, opened


def _built(cut: DataFrame, agree: dict[int, int]) -> DataFrame:
    following = dict(zip(sorted({*agree}), sorted({*agree})[1:]))
    first = cut.select(F.min("part")).first()[0]
    if agree:
        following[first] = min(agree)

    def run(batches):
        closed_type, open_type = _ARROW_BUILT.field("closed").type.value_type, _ARROW_BUILT.field("open").type.value_type
        for batch in batches:
            for row in batch.select(["part", "seq", "before", "after", "convs", "lengths", "keys", "chars"]).to_pylist():
                before = agree.get(row["part"], -1) if row["before"] is None else row["before"]
                after = agree[following[row["part"]]] if row["after"] is None and row["part"] in following else row["after"]
                found = nodes(
                    np.frombuffer(row["convs"], "<i8"), np.frombuffer(row["lengths"], "<i4"), row["keys"],
                    np.frombuffer(row["chars"], "<i4"), before, -1 if after is None else after)
                lists = [pa.array([[dict(zip([f.name for f in t], x)) for x in rows]], pa.list_(t))
                         for rows, t in zip(found, (closed_type, open_type))]
                yield pa.RecordBatch.from_arrays([pa.array([row["part"]], pa.int32()), pa.array([row["seq"]], pa.int64()), *lists], schema=_ARROW_BUILT)

    return cut.mapInArrow(run, BUILT)


def _end_digests(opened: DataFrame) -> DataFrame:
    """(key, ends_sha256) of the open nodes where conversations end: their parts hashed one after another."""
    parts = opened.filter(F.octet_length("ends") > 0).select("key", "part", "seq", "ends")
    ordered = parts.repartition("key").sortWithinPartitions("key", "part", "seq")

    def run(batches):
        current, digest, out = None, None, []
        for batch in batches:
            for key, _, _, ends in zip(*(c.to_pylist() for c in batch.columns)):
                if key != current:
                    if current is not None:
                        out.append((current, digest.hexdigest()))
                    current, digest = key, hashlib.sha256(ends)
                else:
                    digest.update(b"," + ends)
            if out:
                yield _batch(out, schema)
                out = []
        if current is not None:
            yield _batch([(current, digest.hexdigest())], schema)

    schema = pa.schema([("key", pa.binary()), ("ends_sha256", pa.string())])
    return ordered.mapInArrow(run, "key binary, ends_sha256 string")


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def trie(of_paths: DataFrame) -> DataFrame:
    """One row per node of the trie of (conv_id, path) rows, whose conv_ids differ.

    conv_id is the smallest member, parent_conv_id the parent's (null at the root), n_leaves
    and saved_tokens are sums over the subtree, ends_sha256 is of the ids that end there.
    """
    cut = stored(shards(stored(of_paths, "paths")), "shards")
    built = stored(_built(cut, _range_ends(cut)), "trie")
    opened = built.select("part", "seq", F.inline("open"))
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    merged = opened.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.first("parent_key").alias("parent_key"), *sums)
    merged = stored(merged, "open")
    least = merged.select("key", "conv_id")
    above = least.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    whole = merged.join(above, "parent_key", "left").join(_end_digests(opened), "key", "left").withColumn(
        "ends_sha256", F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())))
    # Each shard learns the smallest members of its open nodes, whose children may lie within it.
    slots = opened.select("part", "seq", "slot", "key").join(least, "key").groupBy("part", "seq").agg(
        F.map_from_entries(F.collect_list(F.struct("slot", "conv_id"))).alias("of_slot"))
    inside = built.join(slots, ["part", "seq"], "left").select("of_slot", F.inline("closed"))
    parent = F.coalesce("parent_conv_id", F.try_element_at("of_slot", F.col("parent_slot"))).alias("parent_conv_id")
    return inside.select("conv_id", "depth", parent, *COLUMNS[3:]).union(whole.select(*COLUMNS))


def report(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations."""
    prepare(conversations.sparkSession)
    return trie(rebuilt(stored(paths(conversations), "conversations")))


SQL = f"""with turns as (
 select conv_id, list({{'k': key, 'n': chars}} order by turn nulls first, role, key) as path from (
  select conv_id, turn, coalesce(role, '') as role, length(coalesce(text, '')) as chars,
   sha256(octet_length(coalesce(role, '')::blob) || ':' || coalesce(role, '') || coalesce(text, '')) as key
  from conversations where conv_id is not null) group by conv_id),
heads as (select *, ({CRC_SQL.format('(conv_id::varchar)')} % 6)::bigint as h from turns),
rebuilt as (
 select c.conv_id, list_concat(coalesce(b.path[1:c.h], []), c.path[c.h + 1:]) as path
 from heads c left join turns b on b.conv_id = c.conv_id - c.conv_id % 100 and b.conv_id % 100 = 0),
members as (
 select conv_id, d, len(path) as total, path[d].n as chars, array_to_string(list_transform(path[1:d], lambda x: x.k), ',') as node
 from (select conv_id, path, unnest(range(0, len(path) + 1)) as d from rebuilt)),
nodes as (
 select d, node, min(conv_id) as conv_id, count(*) as n_convs, any_value(chars) as chars,
  coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where total = d), '') as ends
 from members group by d, node),
above as (
 select n.d, n.node, p.conv_id as parent_conv_id, p.node as parent_node from nodes n
 join members m on m.conv_id = n.conv_id and m.d = n.d - 1 join nodes p on p.d = m.d and p.node = m.node),
children as (select d - 1 as d, parent_node as node, count(*) as n_children from above group by all),
valued as (select n.*, coalesce(c.n_children, 0) as n_children from nodes n left join children c using (d, node)),
sums as (
 select m.d, m.node, count(*) filter (where v.n_children = 0) as n_leaves, sum(case when v.d > 0 then (v.n_convs - 1) * v.chars else 0 end) as saved
 from valued v join members m on m.conv_id = v.conv_id and m.d <= v.d group by m.d, m.node)
select v.conv_id, v.d::bigint as depth, a.parent_conv_id, v.n_convs, v.n_children::bigint as n_children, s.n_leaves::bigint as n_leaves,
 s.saved::bigint as saved_tokens, sha256(v.ends) as ends_sha256
from valued v join sums s using (d, node) left join above a using (d, node)"""
