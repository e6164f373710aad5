"""Keep a stream's log small: one folder per grain date instead of one per date and micro-batch.

Every micro-batch adds a folder to each grain date it has rows of.  Compaction folds a
date's folders into one of a new generation (a negative batch number, never used before),
keeping the best row of each key, since on one date no other can ever be chosen.  The old
folders go only once the new ones are whole.  A note says how far a compaction came:

* not written whole: the new folders are dropped, the old ones are all there;
* written: the old folders are dropped, which is safe to repeat.

In between both are there, and rows that occur twice don't matter to a table that keeps one
row per key.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerwright.operators.dedup import keep_best
from layerwright.operators.grain import PART
from layerwright.plans.domains import Domain
from layerwright.sources import files

BATCH = "batch_id"
NOTE = "_compacting"
MAX_FOLDERS = 8


def folders(spark: SparkSession, log: str) -> dict[str, list[int]]:
    """grain date -> its batch folders, by one listing of folders."""
    out: dict[str, list[int]] = {}
    for path, _ in files.list_files(spark, f"{log}/{PART}=*/{BATCH}=*"):
        day, batch = path.rsplit("/", 2)[-2:]
        out.setdefault(day.split("=", 1)[1], []).append(int(batch.split("=", 1)[1]))
    return out


def finish_compaction(spark: SparkSession, log: str) -> None:
    """Bring a compaction that broke off to its end, or undo it."""
    text = files.read_text(spark, f"{log}/{NOTE}")
    if text is None:
        return
    try:
        note = json.loads(text)
    except ValueError:  # broken off before anything was written
        note = {"dates": {}, "generation": 0, "written": False}
    for day, batches in note["dates"].items():
        for batch in batches if note["written"] else [note["generation"]]:
            files.delete(spark, f"{log}/{PART}={day}/{BATCH}={batch}")
    files.delete(spark, f"{log}/{NOTE}")


def compact_log(spark: SparkSession, domain: Domain, log: str, schema, max_folders: int = MAX_FOLDERS) -> int:
    """Fold the grain dates that lie in more than max_folders folders; answers how many dates were.

    To be run while no micro-batch is: the stream may write again a batch it has not committed.
    """
    finish_compaction(spark, log)
    known = folders(spark, log)
    dates = {day: batches for day, batches in known.items() if len(batches) > max_folders}
    if not dates:
        return 0
    generation = min([0, *(b for batches in known.values() for b in batches)]) - 1
    note = {"dates": dates, "generation": generation, "written": False}
    files.write_text(spark, f"{log}/{NOTE}", json.dumps(note))
    folded(spark.read.schema(schema).parquet(log), domain, sorted(dates)).withColumn(BATCH, F.lit(generation)).hint("rebalance", PART).write.mode("append").partitionBy(
        PART, BATCH).parquet(log)
    files.write_text(spark, f"{log}/{NOTE}", json.dumps({**note, "written": True}))
    finish_compaction(spark, log)
    return len(dates)


def folded(log: DataFrame, domain: Domain, days: list[str]) -> DataFrame:
    """The best row of each key on each of these dates, all columns kept."""
    some = log.where(F.coalesce(F.col(PART).cast("string"), F.lit(files.NO_VALUE)).isin(days))
    return keep_best(some.drop(BATCH), [PART, domain.key], domain.best(), [*domain.gold_ties, *domain.other_ties])
