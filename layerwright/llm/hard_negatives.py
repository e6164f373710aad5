"""Hard negatives by a vertical scan of vectors, dimension by dimension (BOND).

Vectors become whole numbers, floor(scale * x), and are packed into blocks of columns:
one array per dimension, with the smallest and largest value in the block.  An anchor
reads the dimensions in descending order of its own magnitudes.  After some of them a
candidate's score lies between its partial sum plus the least and plus the most that the
remaining dimensions can add in this block.  Candidates that can't reach the positives
(then: a score window) drop out of the candidate set, until the few left are exact.

1. Positives: the `positives` best other rows of an anchor's label.
2. Windows: scores s with low * p <= 100 * s <= high * p for a positive's score p; of the
   rows of other labels in a window the `negatives` best are wanted.

Anchors are a stated query set (ids divisible by `every`), met with all rows in blocks:
groups of anchors and blocks of rows are dealt to shards, every shard holding some
blocks and each group once, so nothing is broadcast and neither side need fit a task.
A task keeps only the best rows per anchor so far and gives those out.  Labels play no
part in the dealing: a label that a third of all rows hold is no hot key.

Defined cases: rows with a NULL id, label or vector, or a NULL, non-finite or (beyond
2^26 once scaled) too large component take no part; a shorter vector counts as filled up
with zeros; rows alike in id, label and vector are one row, others with one id are
rows of their own; ties go by smaller id; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from layerwright.llm.frames import prepare, stored
from layerwright.llm.text import give_back

BLOCK_CELLS = 1 << 19  # components in a block: 4 MB, and 8,192 rows of 64 dimensions
GROUP_CELLS = 1 << 14  # components in a group of anchors: 256 anchors of 64 dimensions
SHARD_BLOCKS = 4  # blocks that meet one copy of the anchors
STEPS = (1 / 4, 3 / 8, 1 / 2, 5 / 8, 3 / 4, 7 / 8, 1)  # shares of the dimensions after which bounds are taken
LIMIT = float(1 << 26)


def whole_numbers(rows: DataFrame, scale: int, vec: str, label: str, vector: str) -> DataFrame:
    """vec_id, label, cells (array<bigint>) of the rows that take part, each once."""
    usable = F.forall("v", lambda x: F.coalesce((F.abs(x) <= LIMIT) & ~F.isnan(x), F.lit(False)))
    scaled = F.transform(F.col(vector), lambda x: x.cast("double") * F.lit(float(scale)))
    out = rows.select(F.col(vec).cast("bigint").alias("vec_id"), F.col(label).cast("bigint").alias("label"), scaled.alias("v"))
    out = out.where("vec_id is not null and label is not null and v is not null").where(usable).distinct()
    return out.select("vec_id", "label", F.transform("v", lambda x: F.floor(x)).alias("cells"), F.xxhash64("vec_id", "label", "v").alias("row_key"))


def _matrix(cells: pa.ListArray, width: int) -> np.ndarray:
    """Rows by dimensions, shorter rows filled up with zeros."""
    flat, sizes = cells.flatten().to_numpy(zero_copy_only=False).astype(np.int64), cells.value_lengths().to_numpy(zero_copy_only=False)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


_BLOCK = "block bigint, n int, ids binary, labels binary, row_keys binary, cells binary"


def packed_blocks(rows: DataFrame, width: int, block_rows: int) -> DataFrame:
    """Rows in blocks of columns: ids, labels, keys and dimension-major cells as bytes."""

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block, waiting, have = TaskContext.get().partitionId() << 32, [], 0

        def out() -> pa.RecordBatch:
            whole = pa.Table.from_batches(waiting).combine_chunks()
            n = min(block_rows, whole.num_rows)
            part, rest = whole.slice(0, n), whole.slice(n)
            cells = _matrix(part.column("cells").combine_chunks(), width)
            waiting[:] = rest.to_batches()
            as_bytes = [np.ascontiguousarray(part.column(c).to_numpy().astype("<i8")).tobytes() for c in ("vec_id", "label", "row_key")]
            return pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), pa.array([n], pa.int32()), *(pa.array([b], pa.binary()) for b in (*as_bytes, np.ascontiguousarray(cells.T.astype("<i4")).tobytes()))],
                names=[c.split()[0] for c in _BLOCK.split(", ")])

        for batch in batches:
            if batch.num_rows:
                waiting.append(batch)
                have += batch.num_rows
            while have >= block_rows:
                yield out()
                block, have = block + 1, have - block_rows
        if have:
            yield out()
        give_back()

    return rows.select("vec_id", "label", "row_key", "cells").mapInArrow(pack, _BLOCK)


class Block:
    """Rows by dimension."""

    def __init__(self, row: dict, width: int, dtype=np.float64):
        self.n = row["n"]
        self.ids, self.labels, self.keys = (np.frombuffer(row[c], "<i8") for c in ("ids", "labels", "row_keys"))
        self.cells = np.frombuffer(row["cells"], "<i4").reshape(width, self.n)
        self.low, self.high = self.cells.min(axis=1).astype(np.int64), self.cells.max(axis=1).astype(np.int64)
        largest = int(max(abs(self.low.min()), abs(self.high.max()), 1)) if width else 1
        # Doubles are exact up to 2^53, and numpy multiplies them much faster.
        self.values = self.cells.astype(np.float64 if largest * LIMIT * max(width, 1) < 1 << 53 else np.int64)


def scan(block: Block, anchor: np.ndarray, candidates: np.ndarray, stays) -> tuple[np.ndarray, np.ndarray]:
    """Candidates that `stays(least, most)` leaves to the end, with their scores.

    The anchor's dimensions are read by descending magnitude; least and most bound a
    candidate's score by what the dimensions still unread can add.
    """
    order = np.argsort(-np.abs(anchor), kind="stable")
    order = order[: np.count_nonzero(anchor)]
    weights = anchor[order].astype(block.values.dtype)
    a, b = anchor[order] * block.low[order], anchor[order] * block.high[order]
    rest_low = np.append(np.cumsum(np.minimum(a, b)[::-1])[::-1], 0)
    rest_high = np.append(np.cumsum(np.maximum(a, b)[::-1])[::-1], 0)
    sums, done = np.zeros(len(candidates), block.values.dtype), 0
    everyone = len(candidates) == block.n
    for share in STEPS:
        upto = len(order) if share == 1 else int(len(order) * share)
        if upto == done or not len(candidates):
            continue
        columns = block.values[order[done:upto]]
        sums = sums + weights[done:upto] @ (columns if everyone else columns[:, candidates])
        done = upto
        keep = stays(sums + rest_low[done], sums + rest_high[done])
        if not keep.all():
            candidates, sums, everyone = candidates[keep], sums[keep], False
    return candidates, sums.astype(np.int64)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k]


def _met(blocks: DataFrame, anchors: DataFrame, shards: int) -> DataFrame:
    """Every block with every group of anchors, dealt by shard and group."""
    groups = anchors.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    n = anchors.count()
    dealt = blocks.withColumn("shard", F.pmod(F.xxhash64("block"), F.lit(shards)).cast("int")).withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(max(n, 1) - 1))))
    return dealt.join(groups, ["shard", "group"]).select("group", *blocks.columns, "queries")


def _queries(rows: DataFrame, per_group: int) -> DataFrame:
    """Anchor rows in numbered groups: group, queries (array of anchors)."""
    count = rows.count()
    groups = max(1, -(-count // per_group))
    numbered = rows.withColumn("part", F.pmod(F.xxhash64("row_key"), F.lit(groups)))
    packed = numbered.groupBy("part").agg(F.collect_list(F.struct(*rows.columns)).alias("queries"))
    # Parts are few (anchors / per_group) and numbered without gaps.
    return stored(packed.select((F.row_number().over(Window.orderBy("part")) - 1).alias("group"), "queries"), "anchor-groups")


def _positives(batches: Iterable[pa.RecordBatch], width: int, k: int) -> Iterator[pa.RecordBatch]:
    best: dict[tuple, tuple[np.ndarray, np.ndarray]] = {}

    def out() -> pa.RecordBatch:
        rows = [(key, i, s) for key, (s_, i_) in best.items() for s, i in zip(s_.tolist(), i_.tolist())]
        best.clear()
        return pa.RecordBatch.from_pydict({"anchor_key": pa.array([r[0] for r in rows], pa.int64()), "id": pa.array([r[1] for r in rows], pa.int64()), "score": pa.array([r[2] for r in rows], pa.int64())})

    for block, query in _pairs(batches, width):
        key = query["row_key"]
        scores, ids = best.get(key, (np.zeros(0, np.int64), np.zeros(0, np.int64)))
        floor = scores[k - 1] if len(scores) == k else None
        mine = np.flatnonzero((block.labels == query["label"]) & (block.keys != key))

        def stays(least, most, floor=floor):
            bar = floor
            if len(least) > k:
                own = np.partition(least, len(least) - k)[len(least) - k]
                bar = own if bar is None else max(bar, own)
            return np.ones(len(least), bool) if bar is None else most >= bar

        found, sums = scan(block, query["cells"], mine, stays)
        scores, ids = np.append(scores, sums), np.append(ids, block.ids[found])
        order = _best(scores, ids, k)
        best[key] = scores[order], ids[order]
        if len(best) > 20_000:
            yield out()
    yield out()
    give_back()


def _negatives(batches: Iterable[pa.RecordBatch], width: int, k: int, low: int, high: int) -> Iterator[pa.RecordBatch]:
    best: dict[tuple, tuple[np.ndarray, np.ndarray]] = {}

    def out() -> pa.RecordBatch:
        rows = [(*key, i, s) for key, (s_, i_) in best.items() for s, i in zip(s_.tolist(), i_.tolist())]
        best.clear()
        return pa.RecordBatch.from_pydict({c: pa.array([r[j] for r in rows], pa.int64()) for j, c in enumerate(("anchor_key", "positive_score", "id", "score"))})

    for block, query in _pairs(batches, width):
        windows = []  # equal scores of positives have equal windows
        for p in sorted(set(query["positive_scores"])):
            bottom, top = -(-low * p // 100), high * p // 100
            if bottom <= top:
                scores, ids = best.get((query["row_key"], p), (np.zeros(0, np.int64), np.zeros(0, np.int64)))
                windows.append((p, max(bottom, int(scores[k - 1])) if len(scores) == k else bottom, top, scores, ids))
        if not windows:
            continue
        others = np.flatnonzero(block.labels != query["label"])

        def stays(least, most, windows=windows):
            keep = np.zeros(len(least), bool)
            for _, bottom, top, _, _ in windows:
                sure = least[(least >= bottom) & (most <= top)]
                bar = bottom if len(sure) <= k else np.partition(sure, len(sure) - k)[len(sure) - k]
                keep |= (most >= bar) & (least <= top)
            return keep

        found, sums = scan(block, query["cells"], others, stays)
        for p, bottom, top, scores, ids in windows:
            inside = (sums >= bottom) & (sums <= top)
            s, i = np.append(scores, sums[inside]), np.append(ids, block.ids[found[inside]])
            order = _best(s, i, k)
            best[(query["row_key"], p)] = s[order], i[order]
        if len(best) > 20_000:
            yield out()
    yield out()
    give_back()


def _pairs(batches: Iterable[pa.RecordBatch], width: int) -> Iterator[tuple[Block, dict]]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = {c: batch.column(c)[i].as_py() for c in ("n", "ids", "labels", "row_keys", "cells")}
            block, queries = Block(row, width), batch.column("queries")[i].as_py()
            for query in queries:
                cells = np.zeros(width, np.int64)
                cells[: len(query["cells"])] = query["cells"]
                yield block, {**query, "cells": cells}


def hard_negatives(
    rows: DataFrame, every: int = 100, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: int = 256,
    vec: str = "vec_id", label: str = "label", vector: str = "embedding",
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    spark = rows.sparkSession
    prepare(spark)
    cells = stored(whole_numbers(rows, scale, vec, label, vector), "cells")
    shape = cells.agg(F.max(F.size("cells")).alias("width"), F.count("*").alias("n")).first()
    width = shape["width"] or 1
    block_rows = max(1, BLOCK_CELLS // width)
    blocks = stored(packed_blocks(cells, width, block_rows), "blocks")
    shards = max(1, -(-blocks.count() // SHARD_BLOCKS))
    anchors = cells.where(F.col("vec_id") % every == 0)
    per_group = max(1, GROUP_CELLS // width)

    found = _met(blocks, _queries(anchors, per_group), shards).mapInArrow(lambda b: _positives(b, width, positives), "anchor_key bigint, id bigint, score bigint")
    first = Window.partitionBy("anchor_key").orderBy(F.desc("score"), "id")
    chosen = stored(found.withColumn("place", F.row_number().over(first)).where(F.col("place") <= positives), "positives")
    scores = chosen.groupBy("anchor_key").agg(F.collect_list("score").alias("positive_scores"))  # a few per anchor
    asked = anchors.join(scores, F.col("row_key") == F.col("anchor_key")).drop("anchor_key")

    schema = "anchor_key bigint, positive_score bigint, id bigint, score bigint"
    found = _met(blocks, _queries(asked, per_group), shards).mapInArrow(lambda b: _negatives(b, width, negatives, low, high), schema)
    first = Window.partitionBy("anchor_key", "positive_score").orderBy(F.desc("score"), "id")
    mined = found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= negatives)
    mined = mined.select(F.col("anchor_key").alias("k"), F.col("positive_score").alias("p"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    named = chosen.join(anchors.select("row_key", F.col("vec_id").alias("anchor_id")), F.col("anchor_key") == F.col("row_key"))
    return named.join(mined, (F.col("anchor_key") == F.col("k")) & (F.col("score") == F.col("p"))).select(
        "anchor_id", F.col("id").alias("positive_id"), "rank", "negative_id", F.col("score").alias("positive_score"), "negative_score")
