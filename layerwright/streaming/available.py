"""Bring gold up to date from whatever has landed since the last run.

Bronze is append-only, so it can be read as a file stream.  Every micro-batch
lands its good rows in a log and its bad rows in quarantine, then
re-aggregates exactly the grains it touched.  There is no event-time
watermark: a watermark would drop late rows, the opposite of what quarantine
and late repair are for.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerwright.operators.grain import PART
from layerwright.operators.incremental import grain_texts, in_grains, read_or_empty, repair_grains
from layerwright.operators.quality import accepted, rejected
from layerwright.plans.changed_keys import HASH, LANDING, KeyIndex, key_hash, touched_entries
from layerwright.plans.domains import Domain
from layerwright.sources import files
from layerwright.sources.bronze import read_bronze, stream_bronze
from layerwright.streaming.compaction import BATCH, compact_log, finish_compaction, folders

MAX_FILES = 10_000  # a backlog is worked off in micro-batches of at most this many files


@dataclass(frozen=True)
class StreamTables:
    """Where one domain's stream keeps its tables.

    index_buckets: keep a key index (plans/changed_keys.py) beside the log, so that the dates of a
    batch's keys come from a join that leaves the index where it lies, instead of a scan of
    every logged key; 0 for none.  max_folders: fold a grain date's batch folders once they
    are more than this (streaming/compaction.py); 0 for never.
    """

    root: str
    index_buckets: int = 0
    max_folders: int = 0

    @property
    def log(self) -> str:
        return f"{self.root}/accepted"

    @property
    def quarantine(self) -> str:
        return f"{self.root}/quarantine"

    @property
    def index(self) -> str:
        return f"{self.root}/index"

    @property
    def gold(self) -> str:
        return f"{self.root}/gold"

    @property
    def checkpoint(self) -> str:
        return f"{self.root}/checkpoint"


def ingest_available(
    spark: SparkSession, bronze_root: str, domain: Domain, tables: StreamTables, max_files: int = MAX_FILES
) -> DataFrame:
    """Process all landed files not seen yet, then stop; answers stored gold."""
    finish_compaction(spark, tables.log)
    query = (
        stream_bronze(spark, bronze_root, domain.source, max_files)
        .writeStream.foreachBatch(lambda batch, number: apply_batch(batch, number, domain, tables))
        .option("checkpointLocation", tables.checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if tables.max_folders and files.partition_values(spark, tables.log, PART):
        compact_log(spark, domain, tables.log, _log_schema(spark, bronze_root, domain), tables.max_folders)
    return read_or_empty(spark, tables.gold, domain.spec, domain.gold_of(domain.stage(read_bronze(spark, bronze_root, domain.source))))


def _log_schema(spark: SparkSession, bronze_root: str, domain: Domain):
    return domain.dated(accepted(domain.classify(domain.stage(read_bronze(spark, bronze_root, domain.source))))).withColumn(BATCH, F.lit(0).cast("bigint")).schema


def apply_batch(batch: DataFrame, number: int, domain: Domain, tables: StreamTables) -> None:
    """One micro-batch.  Replaying it rewrites the same partitions with the same rows."""
    spark = batch.sparkSession
    classified = domain.classify(domain.stage(batch)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        bad = rejected(classified, domain.quarantine_columns)
        _overwrite(bad.withColumn(BATCH, F.lit(number)), tables.quarantine, BATCH)
        good = accepted(classified)
        dated = domain.dated(good).withColumn(BATCH, F.lit(number).cast("bigint"))
        # Even file sizes per grain date, also when one date holds most of the batch.
        _overwrite(dated.hint("rebalance", PART), tables.log, PART, BATCH)
    finally:
        classified.unpersist()
    if files.partition_values(spark, tables.log, PART):
        _refresh(spark.read.schema(dated.schema).parquet(tables.log), number, domain, tables)


def _overwrite(df: DataFrame, path: str, *parts: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", files.CODEC).partitionBy(*parts).parquet(path)


def _refresh(log: DataFrame, number: int, domain: Domain, tables: StreamTables) -> None:
    """Re-aggregate the grains batch `number` touched, from the log alone."""
    arrived = log.where(F.col(BATCH) == number)
    # A correction can move a record to another date, so the dates of the
    # earlier copies of every touched key are affected as well.
    held = folders(log.sparkSession, tables.log)
    if tables.index_buckets:
        grains = _indexed_grains(arrived, number, domain, tables)
    elif all(batches == [number] for batches in held.values()):
        grains = grain_texts(arrived, domain.spec)  # there are no earlier copies
    else:
        # Only the key and the partition column are read for this.
        touched = arrived.select(domain.key).distinct()
        grains = grain_texts(log.select(domain.key, PART).join(touched, domain.key, "left_semi"), domain.spec)
    if not grains:
        return
    # Where every logged date was touched, every logged row competes.
    all_of_it = held.keys() <= {files.NO_VALUE if g is None else g for g in grains}
    silver = domain.to_silver(_logged(log) if all_of_it else _competitors(log, grains, domain), for_gold=True)
    repair_grains(silver, tables.gold, domain.spec, grains)


def _indexed_grains(arrived: DataFrame, number: int, domain: Domain, tables: StreamTables) -> list[str | None]:
    """Grain dates of all logged rows of the batch's keys, oldest first; the batch's own entries are stored on the way."""
    index = KeyIndex(arrived.sparkSession, tables.index, f"stream_{domain.silver}", tables.index_buckets)
    day = F.coalesce(F.col(PART).cast("string"), F.lit(files.NO_VALUE))
    entries = arrived.select(key_hash(domain.key).alias(HASH), day.alias(PART), F.lit(str(number)).alias(LANDING))
    index.replace(entries, [str(number)])
    met = touched_entries(index.read(), arrived.select(key_hash(domain.key).alias(HASH)), tables.index_buckets)
    days = met.select(F.when(F.col(PART) != files.NO_VALUE, F.col(PART)).cast("date").alias(PART))
    return grain_texts(days, domain.spec)


def _logged(log: DataFrame) -> DataFrame:
    return log.drop(PART, BATCH)


def _competitors(log: DataFrame, grains, domain: Domain) -> DataFrame:
    """Every logged row that could be, or could displace, a best row of these grains."""
    keys = in_grains(log, domain.spec, grains).select(domain.key).distinct()
    if domain.newest_wins and grains[0] is not None:
        # Only a later date can displace a row: skip all partitions before the first grain.
        log = log.where(F.col(PART).cast("date") >= F.lit(grains[0]).cast("date"))
    return _logged(log).join(keys, domain.key, "left_semi")
