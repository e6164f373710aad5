"""Spark helpers of this package: tables in the shared folder, components, importable workers."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerwright.session import run_dir

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def prepare(spark: SparkSession) -> None:
    """Settings the operators rely on, where the session names none.

    Arrow batches are bounded by bytes too, since a text has no size limit, and by
    fewer rows, since texts are long; Python workers of a local session find this package (on a cluster it comes
    with `--py-files`).
    """
    own = spark.sparkContext.getConf()
    for key, value in ((_BATCH_BYTES, 8 << 20), (_BATCH_ROWS, 2000)):
        if not own.contains(key):
            spark.conf.set(key, str(value))
    paths = spark.sparkContext.environment.setdefault("PYTHONPATH", "").split(os.pathsep)
    if _ROOT not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([p for p in paths if p] + [_ROOT])


def stored(df: DataFrame, label: str, partitions: int | None = None) -> DataFrame:
    """Write df to the shared folder and read it back: cuts lineage, survives lost executors.

    The shuffle files of the write are dropped with it, since nothing reads them again.
    """
    spark = df.sparkSession
    path = run_dir(spark, label)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        (df if partitions is None else df.coalesce(partitions)).write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def text_key(text: Column) -> Column:
    """128 bits that stand for a whole text (NULL like empty)."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def components(edges: DataFrame, label: str = "components", rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node reachable over `edges(a, b)`, for nodes that have an edge.

    Alternating large-star and small-star steps: each is a grouped minimum
    (combined before the shuffle) and an equi-join, and the number of rounds
    grows with the logarithm of the longest path.
    """
    current = stored(_down(edges), f"{label}-0")
    before = _state(current)
    for i in range(1, rounds):
        both = current.unionAll(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        parent = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(parent, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        current = stored(small.unionAll(parent.withColumnRenamed("m", "b")).distinct(), f"{label}-{i}")
        now = _state(current)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = current.select(F.col("b").alias("node")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(roots.select("node", F.col("node").alias("component")))


def _down(edges: DataFrame) -> DataFrame:
    return edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("s")).first()
    return row["n"], row["s"]
