"""Mixing sources to target weights by a low-discrepancy schedule, in DataFrame operations only.

1. Sources, in code point order and null last, weigh 5, 2, 1, repeating, and share all words; a target
   stops at ``most_repeats`` times its source's size, the excess going to the others by weight.
2. Slot i of the schedule has the golden-ratio point frac(i * phi), held as an integer of 32 bits;
   the source whose interval of cumulative targets holds the point owns the slot, and the slots of a
   source are ranked in order.
3. A source's documents are shuffled by the MD5 of their id and repeated end to end. The stream is cut
   into as many blocks of equal size as the source has slots, so that they add up to its target, and
   the block of rank k is joined to the slot of rank k.

No step holds a source in one task: ranks and running sums go over chunks first and then within them.
The only window over all rows of a frame is that over the sources themselves, one row each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayline.llm.store import keep

WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
BLOCK_WORDS = 4096
SLOT_CHUNK = 4096
CELLS = 1024

# floor(2**32 / golden ratio), made odd: its multiples modulo 2**32 visit every number once.
GOLDEN = 2654435769
POINTS = 1 << 32


def words(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def sized(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long"),
        F.col("source").cast("string"),
        words(F.col("text")).alias("size"),
    )


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_repeats: int = MOST_REPEATS) -> DataFrame:
    """source, nth (its place), source_size, target: one row per source.

    Sources sorted by capacity per weight fill up first: with the first k of them at capacity, the
    others share what is left by weight, and the smallest k that leaves nobody above is the answer.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(w) for w in weights])
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    per = per.withColumn("nth", (F.row_number().over(by_name) - 1).cast("long"))
    per = per.withColumn("weight", F.get(cycle, (F.col("nth") % len(weights)).cast("int")).cast("long"))
    per = per.withColumn("capacity", F.col("source_size") * most_repeats)
    filling = Window.orderBy((F.col("capacity") / F.col("weight")).asc(), F.col("nth").asc())
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    onward = filling.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everyone = filling.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    full = F.coalesce(F.sum("capacity").over(before), F.lit(0))
    per = per.withColumn("rest", F.sum("source_size").over(everyone) - full)
    per = per.withColumn("by", F.sum("weight").over(onward))
    exact = lambda c: F.col(c).cast("decimal(19,0)")
    fits = exact("rest") * exact("weight") <= exact("capacity") * exact("by")
    per = per.withColumn("level", F.first(F.when(fits, F.struct("rest", "by")), ignorenulls=True).over(everyone))
    share = F.col("level.rest").cast("double") * F.col("weight") / F.col("level.by")
    target = F.least(share, F.col("capacity").cast("double"))
    return per.select("source", "nth", "source_size", target.alias("target"))


def schedule(goals: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """slot, nth, rank: the owner of every slot and its rank among the owner's slots, from 0.

    A source with words to give owns one slot at least; those that get no point are appended.
    """
    cell = POINTS // CELLS
    quota = goals.select("nth", F.floor("target").alias("quota")).where("quota > 0")
    line = Window.orderBy("nth")
    edges = quota.withColumn("upto", F.sum("quota").over(line))
    edges = edges.withColumn("words", F.sum("quota").over(line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    point_at = "cast((cast({0} as decimal(20,0)) * " + str(POINTS) + ") div words as long)"
    edges = edges.withColumn("low", F.expr(point_at.format("upto - quota"))).withColumn("high", F.expr(point_at.format("upto")))
    owners = edges.where("low < high").select(
        "nth", "low", "high", F.explode(F.expr(f"sequence(low div {cell}, (high - 1) div {cell})")).alias("cell")
    )
    chunks = edges.agg(F.max("words").alias("words")).select(
        "words", F.explode(F.expr(f"sequence(0L, words div {block_words * SLOT_CHUNK}L)")).alias("chunk")
    )
    slots = chunks.repartition("chunk").select(
        F.explode(F.expr(f"transform(sequence(0, {SLOT_CHUNK - 1}), k -> chunk * {SLOT_CHUNK} + k)")).alias("slot"), "words"
    )
    point = F.expr(f"(slot % {POINTS // 2}L) * {GOLDEN}L % {POINTS}L")
    slots = slots.where(f"slot * {block_words} < words").select("slot", point.alias("point"))
    slots = slots.withColumn("cell", F.expr(f"point div {cell}"))
    owned = slots.join(owners, "cell").where("point >= low and point < high")
    owned = owned.select("slot", "nth", F.expr(f"slot div {SLOT_CHUNK}").alias("chunk"))
    counts = owned.groupBy("nth", "chunk").agg(F.count("*").alias("n"))
    so_far = F.sum("n").over(Window.partitionBy("nth").orderBy("chunk"))
    bases = counts.select("nth", "chunk", (so_far - F.col("n")).alias("base"))
    within = F.row_number().over(Window.partitionBy("nth", "chunk").orderBy("slot")) - 1
    ranked = owned.withColumn("k", within).join(bases, ["nth", "chunk"])
    ranked = ranked.select("slot", "nth", (F.col("base") + F.col("k")).alias("rank"))
    missed = edges.join(counts.select("nth").distinct(), "nth", "left_anti")
    appended = missed.select(F.expr(f"(words + {block_words - 1}) div {block_words} + nth").alias("slot"), "nth", F.lit(0).cast("long").alias("rank"))
    return ranked.unionByName(appended)


def streams(sizes: DataFrame, goals: DataFrame) -> DataFrame:
    """The rows of ``sizes`` with nth, source_size, target and offset: the words before the row in its
    source's shuffled stream. Sums go over 4,096 slices of the MD5 first, then within each."""
    joined = sizes.join(goals.withColumnRenamed("source", "named"), F.col("source").eqNullSafe(F.col("named"))).drop("named")
    keyed = joined.withColumn("order", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).withColumn("slice", F.substring("order", 1, 3))
    slices = keyed.groupBy("nth", "slice").agg(F.sum("size").alias("total"))
    so_far = F.sum("total").over(Window.partitionBy("nth").orderBy("slice"))
    slices = slices.select("nth", "slice", (so_far - F.col("total")).alias("base"))
    inside = Window.partitionBy("nth", "slice").orderBy("order", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = keyed.withColumn("inside", F.sum("size").over(inside) - F.col("size")).join(slices, ["nth", "slice"])
    return placed.withColumn("offset", F.col("base") + F.col("inside")).drop("order", "slice", "inside", "base")


def pieces(spans: DataFrame, goals: DataFrame, slots: DataFrame, most_repeats: int = MOST_REPEATS) -> DataFrame:
    """slot, nth, offset, doc_id, repeat, first_word, n_words: what of which document fills each slot."""
    counts = slots.groupBy("nth").agg(F.count("*").alias("blocks"))
    plan = goals.select("nth", F.floor("target").alias("quota")).join(counts, "nth")
    passes = spans.where("size > 0").select(
        "doc_id", "nth", "offset", "size", "source_size", F.explode(F.expr(f"sequence(0, {most_repeats - 1})")).alias("repeat")
    )
    passes = passes.join(plan, "nth").withColumn("begin", F.expr("repeat * source_size + offset"))
    passes = passes.withColumn("end", F.expr("least(begin + size, quota)")).where("begin < end")
    # Block b covers the words [b * quota div blocks, (b + 1) * quota div blocks).
    holds = "((cast({0} as decimal(20,0)) + 1) * blocks - 1) div quota"
    starts = "cast({0} as decimal(20,0)) * quota div blocks"
    cut = passes.select(
        "*", F.explode(F.expr(f"sequence({holds.format('begin')}, {holds.format('(end - 1)')})")).alias("rank")
    )
    cut = cut.withColumn("first", F.expr(f"greatest(begin, {starts.format('rank')})"))
    cut = cut.withColumn("last", F.expr(f"least(end, {starts.format('(rank + 1)')})"))
    return cut.join(slots, ["nth", "rank"]).select(
        "slot",
        "nth",
        "offset",
        "doc_id",
        "repeat",
        (F.col("first") - F.col("begin")).alias("first_word"),
        (F.col("last") - F.col("first")).alias("n_words"),
    )


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    most_repeats: int = MOST_REPEATS,
    block_words: int = BLOCK_WORDS,
) -> tuple[DataFrame, DataFrame]:
    """Every document with its place in its source's stream, and the pieces of the mix by slot.

    First frame: doc_id, source, size, nth, source_size, target, offset. Second: see ``pieces``; it
    joins the first on (nth, offset) among documents with words. A null source is a source of its own;
    null and blank texts have size 0 and give no piece; rows that share a doc_id are separate
    documents. Columns other than doc_id, source and text are ignored; an empty table gives no rows.
    """
    sizes = keep(sized(docs), "sizes")
    goals = keep(targets(sizes, weights, most_repeats), "targets")
    spans = keep(streams(sizes, goals), "streams")
    slots = keep(schedule(goals, block_words), "slots")
    return spans, pieces(spans, goals, slots, most_repeats)


def mix_documents(docs: DataFrame, **settings) -> DataFrame:
    """doc_id, source, size, source_size, target, taken: the words of each document in the mix."""
    spans, parts = mix(docs, **settings)
    taken = parts.groupBy("nth", "offset").agg(F.sum("n_words").alias("taken"))
    found = spans.join(taken, ["nth", "offset"], "left")
    words_taken = F.when(F.col("size") > 0, F.coalesce("taken", F.lit(0))).otherwise(F.lit(0)).cast("long")
    return found.select("doc_id", "source", "size", "source_size", "target", words_taken.alias("taken"))
