"""Which landing dates have changed since they were last staged.

A date whose files are the same ones as remembered (path, length and time of
modification of each) holds the same rows: its JSON need not be parsed again.
The listing is taken before the files are read; whatever lands in between
changes the date's fingerprint and is picked up by the next run.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from layerwright.sources import files
from layerwright.sources.bronze import ENDINGS, INGEST_DATE
from layerwright.sources.snapshots import expire, snapshot_read, snapshot_write, versions

Landings = dict[str, tuple[int, int, str, str]]  # date -> (files, bytes, fingerprint, rules the rows were staged by)


def landed(spark: SparkSession, root: str, source: str, rules: str) -> Landings:
    """Every landing date as it is now, rows without a date included.

    Spark lists the files and folds them to one row per date where they are
    listed; no content is read.  The fold does not depend on file order, so no
    date's files meet in one place however many there are.
    """
    folder = f"{root}/{source}"
    if not files.partition_values(spark, folder, INGEST_DATE):
        return {}
    listed = spark.read.format("binaryFile").option("pathGlobFilter", ENDINGS).load(folder)
    if INGEST_DATE not in listed.columns:
        return {}
    one = F.xxhash64("path", "length", "modificationTime")
    per_date = listed.groupBy(F.coalesce(F.col(INGEST_DATE).cast("string"), F.lit(files.NO_VALUE)).alias(INGEST_DATE)).agg(
        F.count("*").alias("files"),
        F.sum("length").alias("bytes"),
        F.concat_ws(":", F.bit_xor(one).cast("string"), F.sum(one.cast("decimal(20,0)")).cast("string")).alias("fingerprint"),
    )
    return {r[INGEST_DATE]: (r["files"], r["bytes"], r["fingerprint"], rules) for r in per_date.collect()}


def remembered(spark: SparkSession, path: str) -> Landings:
    """The dates as they were when last staged (one row per date, so at most a calendar)."""
    if not versions(spark, path):
        return {}
    rows = [r.asDict() for r in snapshot_read(spark, path).collect()]
    return {r["ingest_date"]: (r["files"], r["bytes"], r.get("fingerprint", ""), r["rules"]) for r in rows}


def remember(spark: SparkSession, path: str, landings: Landings) -> None:
    rows = [(d, *numbers) for d, numbers in landings.items()]
    schema = "ingest_date string, files bigint, bytes bigint, fingerprint string, rules string"
    snapshot_write(spark.createDataFrame(rows, schema), path, "landings")
    expire(spark, path, keep=2)


def changed(now: Landings, before: Landings) -> list[str]:
    """Dates that are new, hold other files, are gone, or were staged by other rules."""
    return sorted(d for d in now.keys() | before.keys() if now.get(d) != before.get(d))
