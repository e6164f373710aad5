"""Versioned full-table exports: `<root>/<table>/version=N`, older versions stay readable.

A version counts once its `_SUCCESS` marker exists, which Spark writes last;
a half-written version is never seen.  A group of tables is published by the
manifest that is written after all of them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from layerwright.operators.upsert import upsert_by_key
from layerwright.sources import files
from layerwright.sources.bronze import union_by_name

_DONE = "_SUCCESS"
_AUDIT = "table_name string, version bigint, rows bigint"
MANIFEST = "_manifest"


def versions(spark: SparkSession, path: str) -> list[int]:
    """Committed versions, oldest first."""
    return sorted(int(v) for v in files.partition_values(spark, path, "version", _DONE))


def next_version(spark: SparkSession, path: str) -> str:
    """Folder of the next version; numbers of broken-off writes are not used again."""
    started = [int(v) for v in files.partition_values(spark, path, "version")]
    return f"{path}/version={max(started, default=-1) + 1}"


def expire(spark: SparkSession, path: str, keep: int) -> None:
    """Drop all but the newest `keep` committed versions."""
    for version in versions(spark, path)[:-keep]:
        files.delete(spark, f"{path}/version={version}")


def snapshot_write(df: DataFrame, path: str, table_name: str) -> DataFrame:
    """Write the whole frame as the next version; answer (table_name, version, rows).

    Rows are counted while they are written, then checked against the footers
    of the files that landed.
    """
    spark = df.sparkSession
    target = next_version(spark, path)
    version = int(target.rsplit("=", 1)[1])
    counted = Observation()
    (
        df.observe(counted, F.count(F.lit(1)).alias("rows"))
        .write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true")
        .parquet(target)
    )
    written = counted.get.get("rows", 0)
    landed = spark.read.schema(df.schema).parquet(target).count()
    if landed != written:
        raise RuntimeError(f"{table_name} version {version}: wrote {written} rows, found {landed}")
    return spark.createDataFrame([(table_name, version, landed)], _AUDIT)


def version_path(spark: SparkSession, path: str, version: int | None = None) -> str:
    """Folder of the latest committed version, or of the one asked for."""
    known = versions(spark, path)
    chosen = version if version is not None else (known[-1] if known else None)
    if chosen not in known:
        raise FileNotFoundError(f"{path} has no version {chosen} (committed: {known})")
    return f"{path}/version={chosen}"


def snapshot_read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    return spark.read.parquet(version_path(spark, path, version))


def snapshot_upsert(batch: DataFrame, path: str, keys: Sequence[str], table_name: str) -> DataFrame:
    """Delete + insert by key against the latest version, stored as the next one."""
    spark = batch.sparkSession
    if not versions(spark, path):
        return snapshot_write(batch, path, table_name)
    return snapshot_write(upsert_by_key(snapshot_read(spark, path), batch, keys), path, table_name)


def snapshot_all(spark: SparkSession, frames: Mapping[str, DataFrame], root: str) -> DataFrame:
    """Export several tables, then publish them together by writing their manifest."""
    audit = union_by_name([snapshot_write(df, f"{root}/{name}", name) for name, df in frames.items()])
    snapshot_write(audit, f"{root}/{MANIFEST}", MANIFEST)
    return audit


def published_versions(spark: SparkSession, root: str) -> DataFrame:
    """(table_name, version, rows) of the last export that completed as a whole."""
    return snapshot_read(spark, f"{root}/{MANIFEST}")


def read_published(spark: SparkSession, root: str, table_name: str) -> DataFrame:
    row = published_versions(spark, root).where(F.col("table_name") == table_name).first()
    return snapshot_read(spark, f"{root}/{table_name}", row["version"])


def total_rows(audit: DataFrame) -> DataFrame:
    """The running total a publication reports: tables and rows."""
    return audit.agg(F.count("*").alias("tables"), F.sum("rows").alias("total_rows"))
