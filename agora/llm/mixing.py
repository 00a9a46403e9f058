"""Mixing sources to target weights.

Tokens of each source form one stream (documents in a pseudorandom but
fixed order), packed into blocks of a fixed number of words.  Output
shards draw multinomial source counts; each drawn slot takes the next
index of its source, a pseudorandom permutation per pass over the source
maps it to a block, and blocks join by index.  DataFrame functions only.

Scale: the prefix sums over a source run in salted buckets, the square
root of the documents in number and size, so a source with a third of all
rows is no single task; one window sees the sums per bucket, the counts
per shard, or one row per source.

Defined results: null text has no words and null is a source of its own,
the last; a document without words is taken 0 times; an empty table gives
an empty result; rows that repeat a ``doc_id`` each get their own row;
other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agora.llm.common import WORD, store

ROUNDS = 4
#: Words of a block; blocks of a shard at least; shards at most.
BLOCK_WORDS, SHARD_BLOCKS, MAX_SHARDS = 64, 1024, 4096
#: Slots written out from one row of counts at a time.
CHUNK = 8192


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (1, 2, 3), cap: float = 3.0) -> DataFrame:
    """``source, n`` (its place), ``source_size, target`` from ``source, source_size``.

    Sources in code point order, null last, weigh ``weights`` in turn and
    share all words; a target stops at ``cap`` times its source and the
    excess is shared again by weight.  With sources sorted by cap over
    weight this is one prefix sum: a source is capped if its cap is below
    its share of what the sources before it leave.  One row per source.
    """
    place = Window.orderBy(F.col("source").asc_nulls_last())
    by_room = Window.orderBy("room", "n")
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = sizes.withColumn("n", F.row_number().over(place) - 1)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), F.pmod("n", F.lit(len(weights))).cast("int") + 1)
    s = s.withColumn("weight", w).withColumn("most", cap * F.col("source_size")) \
        .withColumn("room", F.col("most") / F.col("weight"))
    s = s.withColumn("left_words", F.sum("source_size").over(every) - F.coalesce(F.sum("most").over(before), F.lit(0.0))) \
        .withColumn("left_weight", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))) \
        .withColumn("level", F.col("left_words") / F.col("left_weight")) \
        .withColumn("capped", F.col("room") < F.col("level"))
    s = s.withColumn("level", F.min(F.when(~F.col("capped"), F.struct("room", "n", "level"))).over(every)["level"])
    return s.select("source", "n", "source_size",
                    F.when(F.col("capped"), F.col("most")).otherwise(F.col("level") * F.col("weight")).alias("target"))


def permuted(df: DataFrame, i: str, size: str, *seed: Column) -> DataFrame:
    """``df`` with ``i`` put through a pseudorandom permutation of
    0 .. size-1.  A Feistel network over an a x b grid (a = floor(sqrt(size)),
    b = floor(size / a)) permutes all but the last few numbers, which stay;
    a rotation then moves those into the grid, and a second network mixes
    again.  Each step is one-to-one, and a projection of its own, so that no
    expression holds another twice."""
    keep = [F.col(c) for c in df.columns if c != i]
    a, b, hi, lo, x = (F.col(f"__{c}") for c in ("a", "b", "hi", "lo", "x"))
    grid = F.greatest(F.floor(F.sqrt(F.col(size).cast("double"))), F.lit(1)).cast("long")
    df = df.select(*keep, F.col(i).cast("long").alias("__x"), grid.alias("__a")) \
        .select(*keep, x, a, F.floor(F.col(size) / a).cast("long").alias("__b"))
    for first in (0, ROUNDS):
        df = df.select(*keep, x, a, b, F.floor(x / b).cast("long").alias("__hi"), F.pmod(x, b).alias("__lo"))
        for r in range(first, first + ROUNDS):
            if r % 2:
                df = df.select(*keep, x, a, b, F.pmod(hi + F.pmod(F.xxhash64(F.lit(r), lo, *seed), a), a).alias("__hi"), lo)
            else:
                df = df.select(*keep, x, a, b, hi, F.pmod(lo + F.pmod(F.xxhash64(F.lit(r), hi, *seed), b), b).alias("__lo"))
        out = F.when(x < a * b, hi * b + lo).otherwise(x)
        if not first:
            turn = F.floor(F.col(size) / 2) + F.pmod(F.xxhash64(F.lit("turn"), *seed), a)
            out = F.pmod(out + turn, F.col(size))
        df = df.select(*keep, out.cast("long").alias("__x"), a, b)
    return df.select(*keep, x.alias(i))


def packed(docs: DataFrame, weights: tuple[float, ...], cap: float, block_words: int):
    """Documents placed in their source's stream, and the sources.

    places: ``row, doc_id, size, n, start, end``; the words start .. end-1
    of source ``n``'s stream are the document's.  A stream is ordered by a
    hash of id and text, so the files that the rows come in don't matter; rows
    equal in both stand in for one another.  sources: what
    ``source_targets`` returns plus ``blocks`` (of the source) and
    ``slots`` (blocks the mix takes, repeats counted).
    """
    sized = store(docs.select("doc_id", F.col("source").cast("string").alias("source"),
                              F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
                              F.xxhash64(F.col("doc_id").cast("long"), "text").alias("content"))
                  .withColumn("row", F.monotonically_increasing_id()), "mix-sizes")
    sources = source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, cap)
    sources = store(
        sources.withColumn("blocks", F.ceil(F.col("source_size") / block_words).cast("long"))
        .withColumn("slots", F.when(F.col("source_size") > 0, F.round(
            F.col("target") * F.col("blocks") / F.col("source_size"))).otherwise(0).cast("long")), "mix-sources")

    buckets = int(sized.count() ** 0.5) + 1
    named = sources.select(F.col("source").alias("named"), "n")
    rows = sized.join(named, F.col("source").eqNullSafe(F.col("named"))).drop("named", "source") \
        .withColumn("bucket", F.pmod("content", F.lit(buckets)))
    here = Window.partitionBy("n", "bucket").orderBy("content", "size", "row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy("n").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy("n", "bucket").agg(F.sum("size").alias("words")) \
        .withColumn("offset", F.coalesce(F.sum("words").over(earlier), F.lit(0))).drop("words")
    places = rows.withColumn("end", F.sum("size").over(here)).join(offsets, ["n", "bucket"]) \
        .select("row", "doc_id", "size", "n", (F.col("offset") + F.col("end") - F.col("size")).alias("start"),
                (F.col("offset") + F.col("end")).alias("end"))
    return store(places, "mix-places"), sources


def draw_slots(sources: DataFrame, seed: int) -> DataFrame:
    """The mix: ``shard, n, index, block``, one row per slot.

    Each slot of a shard draws a source with the targets as weights, which
    makes a shard's counts multinomial.  The running counts are then scaled
    so that a source's total is its ``slots`` exactly; ``index`` numbers a
    source's slots and the pass-wise permutation turns it into a block.
    """
    total = sources.agg(F.sum("slots")).first()[0] or 0
    shards = min(MAX_SHARDS, max(1, total // SHARD_BLOCKS))
    width = max(1, -(-total // 4096))
    upto = Window.orderBy("n").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranges = sources.where("slots > 0").withColumn("hi", F.sum("slots").over(upto)) \
        .withColumn("lo", F.col("hi") - F.col("slots"))
    cells = ranges.select("n", "lo", "hi", F.explode(F.sequence(
        F.floor(F.col("lo") / width), F.floor((F.col("hi") - 1) / width))).alias("cell"))
    drawn = sources.sparkSession.range(total).select(
        F.floor(F.col("id") * shards / max(1, total)).cast("long").alias("shard"),
        F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(max(1, total))).alias("u")) \
        .withColumn("cell", F.floor(F.col("u") / width)) \
        .join(cells, "cell").where("u >= lo and u < hi").groupBy("shard", "n").agg(F.count("*").alias("drawn"))

    by_source = Window.partitionBy("n")
    running = by_source.orderBy("shard").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    wide = "decimal(19,0)"
    counts = ranges.select("n", "blocks", "slots").join(drawn, "n", "left") \
        .withColumn("shard", F.coalesce("shard", F.lit(0))).withColumn("drawn", F.coalesce("drawn", F.lit(1))) \
        .withColumn("upto", F.sum("drawn").over(running)).withColumn("every", F.sum("drawn").over(by_source)) \
        .withColumn("first", F.expr(f"cast(upto - drawn as {wide}) * cast(slots as {wide}) div cast(every as {wide})")) \
        .withColumn("last", F.expr(f"cast(upto as {wide}) * cast(slots as {wide}) div cast(every as {wide}) - 1"))
    counts = store(counts.where("last >= first").select("shard", "n", "blocks", "first", "last"), "mix-counts")
    index = F.col("index")
    chunks = counts.select("shard", "n", "blocks", "last", F.explode(
        F.sequence(F.col("first"), F.col("last"), F.lit(CHUNK).cast("long"))).alias("lo"))
    slots = chunks.repartition(max(1, total // (16 * CHUNK)), "shard", "n", "lo") \
        .select("shard", "n", "blocks", F.explode(
            F.sequence("lo", F.least("last", F.col("lo") + (CHUNK - 1)))).alias("index")) \
        .withColumn("block", F.pmod(index, F.col("blocks")))
    return permuted(slots, "block", "blocks", F.col("n"), F.floor(index / F.col("blocks")), F.lit(seed)) \
        .select("shard", "n", "index", "block")


def mix_sources(docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), cap: float = 3.0,
                block_words: int = BLOCK_WORDS, seed: int = 42) -> DataFrame:
    """Per document ``doc_id, size, source_size, target, taken, source``:
    ``target`` and ``source_size`` are its source's, ``taken`` the words
    the mix takes of it, repeats counted."""
    places, sources = packed(docs, weights, cap, block_words)
    takes = store(draw_slots(sources, seed).groupBy("n", "block").agg(F.count("*").alias("times")), "mix-takes")
    parts = places.where("end > start").select("row", "n", "start", "end", F.explode(F.sequence(
        F.floor(F.col("start") / block_words), F.floor((F.col("end") - 1) / block_words))).alias("block"))
    words = F.least("end", (F.col("block") + 1) * block_words) - F.greatest("start", F.col("block") * block_words)
    taken = parts.withColumn("words", words).join(takes, ["n", "block"]) \
        .groupBy("row").agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
    return places.join(taken, "row", "left").join(sources, "n").select(
        "doc_id", "size", "source_size", "target",
        F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "source")
