"""Grain partitions that are switched, not overwritten: readers never see a half-moved table.

A dynamic overwrite moves its partitions one by one.  Here a batch is written whole to a
folder of its own first.  Then the batch's map, which folder holds which grain date now, is
written into that folder, and the catalog's partitions are pointed to it.  The newest whole
map is the table: `read_switched` takes its files at once, so a read begun before the
switch keeps seeing the old grains, all of them, whose folders stay for `keep` batches.
SQL users read the catalog table, where one grain after the other changes over.
A note beside the table names a switch in progress: whoever comes next finishes it, which
is the same work again at most, so a lost driver leaves neither gap nor mixture behind.

Dates are kept as text, so any year is a partition, and rows without one are a partition
of their own (`none`).
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerwright.operators.grain import PART
from layerwright.sources import files

UNDATED = "none"
BATCH = "batch"
NOTE = "_switching"
MAP = "_partitions.json"  # readers skip names with an underscore
AT_ONCE = 200  # partitions in one statement


def create_switched(spark: SparkSession, name: str, like: DataFrame, root: str) -> None:
    """A table of like's columns, partitioned by the grain date as text; its partitions lie in the folders of batches."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in like.schema.fields if f.name != PART)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}, {PART} STRING) USING parquet PARTITIONED BY ({PART}) LOCATION '{root}'")


def _root(spark: SparkSession, name: str) -> str:
    return next(r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect() if r["col_name"] == "Location")


def current_map(spark: SparkSession, root: str) -> dict[str, str]:
    """grain date -> batch of the last switch that is whole."""
    for batch in sorted((int(v) for v in files.partition_values(spark, root, BATCH, MAP)), reverse=True):
        try:
            return json.loads(files.read_text(spark, f"{root}/{BATCH}={batch}/{MAP}") or "")
        except ValueError:  # broken off while being written
            continue
    return {}


def current_partitions(spark: SparkSession, name: str) -> list[str]:
    """Grain dates the catalog knows."""
    return [r[0].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()]


def stage_batch(batch: DataFrame, name: str, only: Iterable[str | None] | None = None) -> str:
    """Write whole grains to a new folder and note what is to be switched; nothing is visible yet. Answers the folder.

    `batch` holds every row of the grain dates it has any row for.  Scope: its own dates, or
    `only` (dates in it without rows are to be dropped); None makes the table equal to the batch.
    """
    spark = batch.sparkSession
    root = _root(spark, name)
    finish_switch(spark, name)
    done = [int(v) for v in files.partition_values(spark, root, BATCH)]
    folder = f"{root}/{BATCH}={max(done, default=-1) + 1}"
    dated = batch.withColumn(PART, F.coalesce(F.col(PART).cast("string"), F.lit(UNDATED)))
    dated.hint("rebalance", PART).write.partitionBy(PART).parquet(folder)
    there = files.partition_values(spark, folder, PART)
    scope = list(current_map(spark, root)) if only is None else [UNDATED if d is None else str(d) for d in only]
    gone = sorted(set(scope) - set(there))
    files.write_text(spark, f"{root}/{NOTE}", json.dumps({"folder": folder, "put": there, "drop": gone}))
    return folder


def finish_switch(spark: SparkSession, name: str, keep: int = 2) -> bool:
    """Point the catalog's partitions to the batch last staged; True if there was one. Safe to repeat."""
    root = _root(spark, name)
    note = files.read_text(spark, f"{root}/{NOTE}")
    if note is None:
        return False
    told = json.loads(note)
    batch = told["folder"].rsplit("=", 1)[1]
    places = {d: b for d, b in current_map(spark, root).items() if d not in told["drop"]} | dict.fromkeys(told["put"], batch)
    files.write_text(spark, f"{told['folder']}/{MAP}", json.dumps(places))
    known = set(current_partitions(spark, name))
    new = [d for d in told["put"] if d not in known]
    at = lambda d: f"'{told['folder']}/{PART}={d}'"
    for i in range(0, len(new), AT_ONCE):
        added = " ".join(f"PARTITION ({PART} = '{d}') LOCATION {at(d)}" for d in new[i : i + AT_ONCE])
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {added}")
    for d in told["put"]:
        if d in known:
            spark.sql(f"ALTER TABLE {name} PARTITION ({PART} = '{d}') SET LOCATION {at(d)}")
    for d in told["drop"]:
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({PART} = '{d}')")
    spark.catalog.refreshTable(name)
    files.delete(spark, f"{root}/{NOTE}")
    expire_batches(spark, name, keep)
    return True


def switch_partitions(batch: DataFrame, name: str, only: Iterable[str | None] | None = None, keep: int = 2) -> DataFrame:
    """Stage and switch; answers the table."""
    spark = batch.sparkSession
    stage_batch(batch, name, only)
    finish_switch(spark, name, keep)
    return read_switched(spark, name)


def read_switched(spark: SparkSession, name: str) -> DataFrame:
    """The table as it is now, with its grain date as a DATE again (NULL for rows without one).

    The files are listed here, once: later switches don't show in this frame.
    """
    root, shape = _root(spark, name), spark.table(name).schema
    folders = [f"{root}/{BATCH}={b}/{PART}={d}" for d, b in sorted(current_map(spark, root).items())]
    if not folders:
        return spark.createDataFrame([], shape).withColumn(PART, F.col(PART).cast("date"))
    rows = spark.read.schema(shape.add(BATCH, "long")).option("basePath", root).parquet(*folders).drop(BATCH)
    return rows.withColumn(PART, F.when(F.col(PART) != UNDATED, F.col(PART)).cast("date"))


def expire_batches(spark: SparkSession, name: str, keep: int = 2) -> None:
    """Drop the partition folders that neither the current map nor one of the newest `keep` batches needs."""
    root = _root(spark, name)
    batches = sorted((int(v) for v in files.partition_values(spark, root, BATCH)), reverse=True)
    places = current_map(spark, root)
    for batch in batches[keep:]:
        folder = f"{root}/{BATCH}={batch}"
        days = files.partition_values(spark, folder, PART)
        left = [d for d in days if places.get(d) == str(batch)]
        for d in set(days) - set(left):
            files.delete(spark, f"{folder}/{PART}={d}")
        if not left:
            files.delete(spark, folder)
