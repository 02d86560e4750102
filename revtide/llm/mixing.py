"""Mixing sources to target weights by entropy balancing.

Each document gets a rate, how often the mix takes it. Among all rates between 0 and LIMIT
whose expected words meet every source's target, entropy balancing picks those with the
least relative entropy to one copy each: exponentially tilted rates

    rate = min(LIMIT, exp(tilt * size / mean size))

with one tilt per source, the maximiser of a convex dual that Newton iterations find. A
document enters the dual only by its source and size, so the sums run over counts of
equal (source, size) cells. Rates become copies by systematic rounding along each
source's sizes: what is rounded off is carried on to the next cell, and the sum is cut
where the words taken come nearest to the target. They differ from it by less than one
document, as a rule by far less.

Null sources are one source, after all others; null and empty texts have size 0. Repeated
rows are documents of their own. Reruns give the same copies: ties are broken by hash and
id, and rows equal in both are alike: they are counted, never ranked, so a group of equal
rows of any size is one row here. Only the id, source and text columns decide, the others
are carried, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from revtide.llm.base import native_words, stored, unused_name

#: Weights of the sources in code point order, repeating; the share of all words the mix
#: takes; the most often it takes a document.
WEIGHTS, SHARE, LIMIT = (5.0, 2.0, 1.0), 1.5, 2.0
#: Newton iterations at most, and the relative miss of a target at which they end.
ITERATIONS, TOLERANCE = 60, 1e-8
#: Different rows of one (source, size) cell that are ranked together, and neighbours that one window sees of a sum.
RANKED, SUMMED = 1024, 1024
#: Copies that one row is unfolded to at once.
UNFOLDED = 4096
#: Places tried for the cuts of the carried sum.
OFFSETS = 32


def sized(docs: DataFrame, source: str = "source") -> DataFrame:
    """(key, doc_id, source, size, tie) of each document; the key is a hash of the row."""
    return docs.select(
        F.xxhash64("doc_id", source, "text").alias("key"), "doc_id", F.col(source).alias("source"),
        F.size(native_words(F.col("text"))).cast("long").alias("size"), F.xxhash64("text").alias("tie"))


def targets(cells: DataFrame) -> DataFrame:
    """Per source its size, mean size and target; one row per source.

    A source is held at LIMIT times its size if the level of words per weight, at which
    the others end, reaches that high. Sources in the order of size over weight make the
    level of each prefix a running sum.
    """
    sizes = cells.groupBy("source").agg(
        F.sum(F.col("n") * F.col("size")).alias("source_size"), F.sum("n").alias("docs"))
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.get(F.array(*map(F.lit, WEIGHTS)), F.pmod(place, F.lit(len(WEIGHTS))))
    capped = sizes.withColumn("weight", weight).withColumn("cap", LIMIT * F.col("source_size"))
    filling = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    below, everything = filling.rowsBetween(W.unboundedPreceding, -1), W.partitionBy()
    left = SHARE * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(below), F.lit(0.0))
    free = F.sum("weight").over(filling.rowsBetween(W.currentRow, W.unboundedFollowing))
    levels = capped.withColumn("level", left / free)
    full = F.col("cap") <= F.col("level") * F.col("weight")
    # From the first source that is not held the prefix levels fall; its own is that of the rest.
    level = F.max(F.when(~full, F.col("level"))).over(everything)
    return levels.select(
        "source", "source_size", F.when(full, F.col("cap")).otherwise(level * F.col("weight")).alias("target"),
        (F.greatest("source_size", F.lit(1)) / F.col("docs")).alias("mean"))


def _rate(tilt: Column) -> Column:
    return F.least(F.lit(LIMIT), F.exp(F.least(tilt * F.col("size") / F.col("mean"), F.lit(1.0))))


def _with_source(rows: DataFrame, sources: DataFrame) -> DataFrame:
    return rows.join(sources, rows["source"].eqNullSafe(sources["source"])).drop(sources["source"])


def tilts(cells: DataFrame, goals: DataFrame) -> DataFrame:
    """The goals with each source's tilt, the solution of the dual.

    An iteration is one pass over the cells, joined to one row per source, and one
    aggregate. Where every document must be taken LIMIT times the tilt is known; a Newton
    step that leaves the bracket found so far is replaced by the bracket's middle.
    """
    columns = goals.columns
    top = F.col("mean")  # at this tilt even size 1 reaches the limit
    full = F.col("target") >= LIMIT * F.col("source_size")
    state = stored(goals.select(
        *columns, F.when(full, top).otherwise(0.0).alias("tilt"), (-60 * top).alias("low"), top.alias("high")), "tilts")
    for _ in range(ITERATIONS):
        rate = _rate(F.col("tilt"))
        n, size = F.col("n").cast("decimal(12,0)"), F.col("size").cast("decimal(12,0)")
        taken = n * size * rate.cast("decimal(10,9)")
        steep = F.when(rate < LIMIT, n * (size * size).cast("decimal(16,0)") * rate.cast("decimal(10,9)"))
        # Decimal sums are the same in any order of the rows.
        sums = _with_source(cells, state).groupBy(*state.columns).agg(
            F.sum(taken).cast("double").alias("got"),
            (F.coalesce(F.sum(steep).cast("double"), F.lit(0.0)) / F.col("mean")).alias("slope"))
        miss = F.col("target") - F.col("got")
        low = F.when(miss > 0, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(miss < 0, F.col("tilt")).otherwise(F.col("high"))
        step = F.col("tilt") + miss / F.when(F.col("slope") > 0, F.col("slope"))
        done = full | (F.abs(miss) <= TOLERANCE * F.col("target"))
        after = F.when(done, F.col("tilt")).when((step > low) & (step < high), step).otherwise((low + high) / 2)
        state = stored(sums.select(
            *columns, after.alias("tilt"), low.alias("low"), high.alias("high"), done.alias("done")), "tilts")
        open_sources = state.filter("not done").head(1)
        state = state.drop("done")
        if not open_sources:
            break
    return state.select(*columns, "tilt")


def _quota() -> Column:
    """Whole copies of a part, given where the carried sum is cut."""
    return F.least(F.floor(F.col("after") + F.col("offset")) - F.floor(F.col("before") + F.col("offset")),
                   F.col("m") * int(LIMIT))


def offsets(carried: DataFrame) -> DataFrame:
    """Per source the offset of the cuts, of OFFSETS, at which its words come nearest to the target."""
    tried = F.explode(F.array(*[F.lit((k + 0.5) / OFFSETS) for k in range(OFFSETS)])).alias("offset")
    words = carried.select("*", tried).groupBy("source", "target", "offset").agg(
        F.sum(F.col("size") * _quota()).alias("words"))
    miss = F.struct(F.abs(F.col("words") - F.col("target")), "offset")
    return words.groupBy("source").agg(F.min_by("offset", miss).alias("offset"))


def carried_before(cells: DataFrame, partition: str, levels: list[Column], value: Column) -> DataFrame:
    """The cells with `before`, the sum of `value` over all cells of the partition that come earlier.

    `levels` give the order, each within the one before; a level's window sees only the
    groups that share all levels above, so many cells are summed level by level.
    """
    names = [f"level{i}" for i in range(len(levels))]
    rows = cells.select("*", *[c.alias(n) for c, n in zip(levels, names)], value.alias("value"))
    columns, out = cells.columns, rows.withColumn("before", F.lit(0).cast("decimal(38,9)"))
    for i, name in enumerate(names):
        above = [partition, *names[:i]]
        sums = rows.groupBy(*above, name).agg(F.sum("value").alias("total"))
        earlier = W.partitionBy(*above).orderBy(name).rowsBetween(W.unboundedPreceding, -1)
        sums = sums.select(*[F.col(c).alias(f"_{c}") for c in (*above, name)], F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("add"))
        same = [out[c].eqNullSafe(sums[f"_{c}"]) for c in (*above, name)]
        out = out.join(sums, same).withColumn("before", (F.col("before") + F.col("add")).cast("decimal(38,9)")).drop("add", *[f"_{c}" for c in (*above, name)])
    return out.select(*columns, "value", "before")


def decisions(docs: DataFrame, source: str = "source") -> DataFrame:
    """(key, doc_id, size, source_size, target, rate, m, copies) of the different rows.

    m rows are equal, and the mix takes `copies` of them all together.
    """
    light = sized(docs, source)
    light = stored(light.groupBy(*light.columns).agg(F.count("*").alias("m")), "sized")
    cells = stored(light.groupBy("source", "size").agg(F.sum("m").alias("n"), F.count("*").alias("different")), "cells")
    solved = _with_source(cells, tilts(cells.drop("different"), targets(cells))).select(
        F.col("source").alias("s"), F.col("size").alias("z"), "source_size", "target", "different",
        _rate(F.col("tilt")).alias("rate"))
    in_cell = light["source"].eqNullSafe(F.col("s")) & (light["size"] == F.col("z"))
    part = F.pmod(F.xxhash64("tie", "doc_id"), F.ceil(F.col("different") / RANKED).cast("long"))
    rated = light.join(solved, in_cell).withColumn("part", part).drop("s", "z", "different")
    # A part's copies: the carried sum of rates along the source's sizes, cut to whole ones.
    own = ["source", "size", "part"]
    parts = stored(rated.groupBy(*own, "rate", "target").agg(F.sum("m").alias("m")), "parts")
    value = (F.col("m") * F.col("rate").cast("decimal(10,9)")).cast("decimal(38,9)")
    order = [F.floor(F.col("size") / SUMMED), F.col("size"), F.floor(F.col("part") / SUMMED), F.col("part")]
    carried = carried_before(parts, "source", order, value)
    carried = stored(carried.withColumn("after", F.round((F.col("before") + F.col("value")).cast("double"), 6)).withColumn(
        "before", F.round(F.col("before").cast("double"), 6)), "carried")
    quota = _with_source(carried, offsets(carried)).select(
        F.col("source").alias("s"), F.col("size").alias("z"), F.col("part").alias("p"), F.col("m").alias("of_part"), _quota().alias("quota"))
    earlier = W.partitionBy(*own).orderBy("tie", "doc_id", "key").rowsBetween(W.unboundedPreceding, -1)
    ranked = rated.withColumn("start", F.coalesce(F.sum("m").over(earlier), F.lit(0)))
    in_part = ranked["source"].eqNullSafe(F.col("s")) & (ranked["size"] == F.col("z")) & (ranked["part"] == F.col("p"))
    extra = F.least(F.greatest(F.col("quota") % F.col("of_part") - F.col("start"), F.lit(0)), F.col("m"))
    return ranked.join(quota, in_part).select(
        "key", "doc_id", "size", "source_size", "target", "rate", "m",
        (F.col("m") * F.floor(F.col("quota") / F.col("of_part")) + extra).cast("long").alias("copies"))


def _shared(copies: Column, m: Column, start: Column, n: Column) -> Column:
    """Of the copies that m equal rows share, those of n of them that come after `start` others."""
    return n * F.floor(copies / m) + F.least(F.greatest(copies % m - start, F.lit(0)), n)


def mix(docs: DataFrame, source: str = "source") -> DataFrame:
    """The documents as often as the mix takes them. The texts are shuffled once.

    Equal rows become one with their number first, map-side, and are unfolded at the end. Very
    many copies of one row are dealt out in runs before.
    """
    key, number, times, run = (unused_name(docs, c) for c in ("row_key", "rows", "times", "run"))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    dealt = decisions(docs, source).select(F.col("key").alias("decided"), "m", "copies")
    keyed = docs.select("*", F.xxhash64("doc_id", source, "text").alias(key))
    whole = F.struct(*columns)
    variant = [F.col(key), F.xxhash64(whole).alias(run)]
    # Rows that differ in other columns only share what was decided, in the order of their hashes.
    start = F.coalesce(F.sum(number).over(W.partitionBy(key).orderBy(run).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    numbers = keyed.groupBy(*variant).agg(F.count("*").alias(number)).withColumn("start", start)
    shares = numbers.join(dealt, F.col(key) == F.col("decided")).select(
        key, run, _shared(F.col("copies"), F.col("m"), F.col("start"), F.col(number)).cast("long").alias(times)).filter(F.col(times) > 0)
    texts = keyed.groupBy(*variant).agg(F.any_value(whole).alias("row"))
    taken = texts.join(shares, [key, run]).select("row", times)
    few = taken.filter(F.col(times) <= UNFOLDED)
    many = taken.filter(F.col(times) > UNFOLDED).select("row", times, F.explode(
        F.sequence(F.lit(0).cast("long"), F.floor((F.col(times) - 1) / UNFOLDED).cast("long"))).alias(run)).repartition(run)
    runs = many.select("row", F.least(F.lit(UNFOLDED), F.col(times) - F.col(run) * UNFOLDED).alias(times))
    unfolded = few.union(runs).select("row", F.explode(F.array_repeat(F.lit(True), F.col(times).cast("int"))).alias(run))
    return unfolded.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def report(docs: DataFrame) -> DataFrame:
    """Per document its size, its source's size and target, and the words the mix takes.

    Equal documents share their copies: as many as are over take one more than the others.
    """
    each = decisions(docs).select("*", F.floor(F.col("copies") / F.col("m")).alias("least"), (F.col("copies") % F.col("m")).alias("over"))
    runs = [(F.col("over"), F.col("least") + 1), (F.col("m") - F.col("over"), F.col("least"))]
    listed = each.select("*", F.inline(F.array(*[F.struct(n.alias("count"), c.alias("each")) for n, c in runs])))
    most = F.sequence(F.lit(0).cast("long"), F.floor((F.col("count") - 1) / UNFOLDED).cast("long"))
    hot = listed.filter(F.col("count") > UNFOLDED).select("*", F.explode(most).alias("run")).repartition("run")
    hot = hot.withColumn("count", F.least(F.lit(UNFOLDED), F.col("count") - F.col("run") * UNFOLDED)).drop("run")
    rows = listed.filter((F.col("count") > 0) & (F.col("count") <= UNFOLDED)).unionByName(hot)
    return rows.select("doc_id", "size", "source_size", "target", (F.col("each") * F.col("size")).alias("taken"),
                       F.explode(F.array_repeat(F.lit(True), F.col("count").cast("int"))).alias("one")).drop("one")
