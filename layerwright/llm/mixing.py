"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks.

A source's documents are put on a line in a fixed shuffled order (md5 of the id
with a seed); the line is laid twice, so a document can be taken up to two times.
The line is cut into blocks of `block` words, of which a source gives as many as
its target needs, its quota (the last one cut to the target).

The schedule decides which block comes when.  Slot k holds the van der Corput point
of k (its bits reversed); the point falls into one source's share of the cumulative
quotas; a slot's rank among the slots of its source names the block.  Slots are joined
to the blocks of the shuffled lines, and what a document gives is the sum over the
blocks it was joined in.  Points beyond the last share have no slot, so slot
numbers skip some values; every stretch of slots is close to the weights, and the
whole schedule meets every quota exactly.

Only DataFrame functions.  A point finds its source by an equi-join on ranges of
`RANGE` points, running counts and sums go over two levels (source and bucket, then
rows of a bucket), so a source with a third of all rows or slots is not one task.  The
plan of the sources is a small table; its own running sums go over one row per source in
one task.

Defined cases: a NULL text has no words, is never taken and moves nothing;
a NULL source is a source, the last; repeated rows have places of their own;
with no words at all every target is 0; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layerwright.llm.frames import stored

WEIGHTS = (3, 1, 2)
BLOCK = 4096
FEW_SOURCES = 5000
_BUCKET_ROWS = 2000
RANGE = 64  # points: as many sources at most meet one of them in the range lookup
SLOT_BUCKET = 4096


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, percent: int = 150, repeats: int = 2) -> DataFrame:
    """Words each source gives: its share by weight, no more than `repeats` times its size, the excess reshared.

    sources(source, source_size).  In order of size / weight the sources below the
    water level are exactly those that reach their limit; the level follows from
    running sums, in whole numbers.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.row_number().over(by_name) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (place % len(weights) + 1).cast("int"))
    rows = sources.select("source", "source_size", place.alias("place"), weight.cast("bigint").alias("weight"))
    big = "decimal(38,0)"
    everything = Window.partitionBy()
    level = Window.orderBy(F.col("source_size") / F.col("weight"), "place")
    before = level.rowsBetween(Window.unboundedPreceding, -1)
    limit = (F.col("source_size") * repeats).cast(big)
    rows = rows.select(
        "*",
        (F.sum("source_size").over(everything) * percent).cast(big).alias("wanted"),  # in hundredths
        F.coalesce(F.sum(limit).over(before), F.lit(0)).cast(big).alias("filled"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))).cast(big).alias("left"),
    )
    full = limit * F.col("left") * 100 <= F.col("weight") * (F.col("wanted") - 100 * F.col("filled"))
    rows = rows.select("*", full.alias("full"))
    filled = F.sum(F.when(F.col("full"), limit).otherwise(F.lit(0).cast(big))).over(everything)
    left = F.sum(F.when(~F.col("full"), F.col("weight")).otherwise(F.lit(0))).over(everything)
    share = F.col("weight") * (F.col("wanted") - 100 * filled).cast("double") / (left.cast("double") * 100)
    return rows.select("source", "source_size", "place", "weight", F.when(F.col("full"), limit.cast("double")).otherwise(share).alias("target"))


def _line(sized: DataFrame, seed: int) -> DataFrame:
    """doc_id, source, size, text_id, bucket, row, start: each document's place on its source's line."""
    key = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(f":{seed}")))
    digits = max(1, (max(1, sized.count() // _BUCKET_ROWS).bit_length() + 3) // 4)
    rows = sized.withColumn("key", key).withColumn("bucket", F.substring("key", 1, digits))
    order = Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "text_id")
    buckets = rows.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    running = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = buckets.select(F.col("source").alias("s"), F.col("bucket").alias("b"), F.coalesce(F.sum("words").over(running), F.lit(0)).alias("base"))
    inside = F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = rows.select("*", F.row_number().over(order).alias("row"), inside.alias("inside"))
    return placed.join(buckets, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b"))).select(
        "doc_id", "source", "size", "text_id", "bucket", "row", (F.col("base") + F.col("inside")).alias("start"))


def schedule(plan: DataFrame, block: int = BLOCK) -> DataFrame:
    """The plan with words (the target in whole words, halves up), quota (its blocks) and edge (the blocks of the sources before)."""
    rows = plan.withColumn("words", F.floor(F.col("target") + 0.5).cast("bigint"))
    rows = rows.withColumn("quota", F.expr(f"(words + {block - 1}L) div {block}L"))
    before = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("edge", F.coalesce(F.sum("quota").over(before), F.lit(0)))


def slots(plan: DataFrame) -> DataFrame:
    """place, block, slot: the schedule, a row per slot.

    slot k -> point (bits of k reversed) -> source whose share of the quotas holds the
    point -> rank of the slot among its source's, which is the block it takes.
    """
    spark = plan.sparkSession
    total = plan.agg(F.sum("quota").alias("n")).first()["n"] or 0
    bits = max(total - 1, 0).bit_length()
    points = spark.range(1 << bits).select(F.col("id").alias("slot"), van_der_corput(F.col("id"), bits).alias("point")).where(F.col("point") < total)
    shares = plan.where("quota > 0").select("place", "edge", (F.col("edge") + F.col("quota")).alias("end"))
    span = lambda c: F.floor(F.col(c) / RANGE).cast("bigint")
    # A share of many ranges is unfolded in two steps, so no row makes one array of them all.
    coarse = shares.withColumn("far", F.explode(F.sequence(F.floor(F.col("edge") / (RANGE * SLOT_BUCKET)), F.floor((F.col("end") - 1) / (RANGE * SLOT_BUCKET)))))
    first, last = F.greatest(span("edge"), F.col("far") * SLOT_BUCKET), F.least(F.floor((F.col("end") - 1) / RANGE).cast("bigint"), (F.col("far") + 1) * SLOT_BUCKET - 1)
    ranges = coarse.withColumn("range", F.explode(F.sequence(first, last)))
    met = points.withColumn("range", span("point")).join(ranges.select("place", "edge", "end", "range"), "range").where("point >= edge and point < end")
    # Rank in two levels: slots before this bucket of slots, then inside it.
    met = met.select("place", "slot", F.floor(F.col("slot") / SLOT_BUCKET).cast("bigint").alias("bucket"))
    inside = Window.partitionBy("place", "bucket").orderBy("slot")
    running = Window.partitionBy("place").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = met.groupBy("place", "bucket").agg(F.count("*").alias("n")).withColumn("before", F.coalesce(F.sum("n").over(running), F.lit(0))).drop("n")
    ranked = met.withColumn("inside", F.row_number().over(inside) - 1).join(before, ["place", "bucket"])
    return ranked.select("place", (F.col("before") + F.col("inside")).cast("bigint").alias("block"), "slot")


def van_der_corput(number: Column, bits: int) -> Column:
    """The number with its `bits` bits reversed."""
    return F.conv(F.reverse(F.lpad(F.bin(number), bits, F.lit("0"))), 2, 10).cast("bigint") if bits else number


def _pieces(docs: DataFrame, weights: tuple[int, ...], percent: int, repeats: int, block: int, seed: int, doc: str, text: str, source: str) -> tuple[DataFrame, DataFrame]:
    """Every document's row on its line, and the pieces the schedule takes: place, bucket, row, lap, slot, part (words).

    A piece is what one lap of a document has in one scheduled block.
    """
    sized = stored(docs.select(
        F.col(doc).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"), F.md5(F.col(text).cast("binary")).alias("text_id")), "mix-sizes")
    plan_rows = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, percent, repeats)
    plan = stored(schedule(plan_rows, block), "mix-plan")
    shares = plan.select(F.col("source").alias("s"), "place", "source_size", "target", "words", "quota")
    few = plan.count() <= FEW_SOURCES
    line = stored(_line(sized, seed).join(F.broadcast(shares) if few else shares, F.col("source").eqNullSafe(F.col("s"))).drop("s"), "mix-line")
    begin = F.col("start") + F.col("lap") * F.col("source_size")
    laps = line.where("size > 0").withColumn("lap", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1)))).withColumn("from", begin).withColumn("to", begin + F.col("size"))
    first, last = F.floor(F.col("from") / block), F.floor((F.col("to") - 1) / block)
    rows = laps.withColumn("block", F.explode(F.sequence(first, last))).where("block < quota")
    at, end = F.greatest(F.col("from"), F.col("block") * block), F.least("to", (F.col("block") + 1) * block, "words")
    rows = rows.select("place", "bucket", "row", "lap", "block", F.greatest(end - at, F.lit(0)).alias("part"))
    return line, rows.join(slots(plan), ["place", "block"]).where("part > 0")


def mix(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, percent: int = 150, repeats: int = 2, block: int = BLOCK, seed: int = 0,
    doc: str = "doc_id", text: str = "text", source: str = "source",
) -> DataFrame:
    """Per row of docs: doc_id, source, text_id, size, source_size, target, taken (words, repeats counted), first_slot, n_slots."""
    line, pieces = _pieces(docs, weights, percent, repeats, block, seed, doc, text, source)
    taken = pieces.groupBy("place", "bucket", "row").agg(F.sum("part").alias("taken"), F.min("slot").alias("first_slot"), F.count("*").alias("n_slots"))
    zero = F.lit(0).cast("bigint")
    return line.join(taken, ["place", "bucket", "row"], "left").select(
        "doc_id", "source", "text_id", "size", "source_size", "target",
        F.coalesce("taken", zero).cast("bigint").alias("taken"), "first_slot", F.coalesce("n_slots", zero).alias("n_slots"))


def mixed_documents(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, percent: int = 150, repeats: int = 2, block: int = BLOCK, seed: int = 0,
    doc: str = "doc_id", text: str = "text", source: str = "source", slot: str | None = None,
) -> DataFrame:
    """The mix itself, with the columns of docs: a whole document for each lap of which the schedule takes at least half.

    `slot` names a further column: where in the schedule the copy begins.  Rows alike in id,
    source and text share the copies taken of them.
    """
    line, pieces = _pieces(docs, weights, percent, repeats, block, seed, doc, text, source)
    laps = pieces.groupBy("place", "bucket", "row", "lap").agg(F.sum("part").alias("part"), F.min("slot").alias("slot"))
    kept = line.select("place", "bucket", "row", "doc_id", "source", "text_id", "size").join(laps, ["place", "bucket", "row"]).where("2 * part >= size")
    copies = kept.groupBy(F.col("doc_id").alias("_d"), F.col("source").alias("_s"), F.col("text_id").alias("_t")).agg(
        F.count("*").alias("_copies"), *([F.sort_array(F.collect_list("slot")).alias("_slots")] if slot else []))
    same = F.col(doc).eqNullSafe(F.col("_d")) & F.col(source).eqNullSafe(F.col("_s")) & (F.md5(F.col(text).cast("binary")) == F.col("_t"))
    alike = Window.partitionBy("_d", "_s", "_t").orderBy("_copies")
    joined = docs.join(copies, same).withColumn("_row", F.row_number().over(alike) - 1)
    first, end = F.col("_row") * repeats, F.least((F.col("_row") + 1) * repeats, F.col("_copies"))
    out = joined.where(first < end).withColumn("_copy", F.explode(F.sequence(first, end - 1)))
    return out.select(*docs.columns, *([F.element_at("_slots", (F.col("_copy") + 1).cast("int")).alias(slot)] if slot else []))
