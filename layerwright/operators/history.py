"""Verdicts kept over runs, and since when a check has been failing.

Each run's verdicts (a row per declared check) are stored once under the run's number.
Runs of equal outcome are islands of consecutive runs: the number of a run among all of
the check's minus its number among those of equal outcome is the same inside an island.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from layerwright.sources import files

RUN = "run"
VERDICTS = "check_name string, table_name string, failures bigint, passed boolean, run bigint, ran_at timestamp_ntz"


def record_verdicts(verdicts: DataFrame, path: str, ran_at=None) -> int:
    """Store a run's verdicts under the next number; a run that broke off while storing leaves no verdicts."""
    spark = verdicts.sparkSession
    begun = [int(v) for v in files.partition_values(spark, path, RUN)]
    run = max(begun, default=-1) + 1
    moment = F.current_timestamp().cast("timestamp_ntz") if ran_at is None else F.lit(ran_at).cast("timestamp_ntz")
    rows = verdicts.select("check_name", "table_name", F.col("failures").cast("bigint").alias("failures"), "passed", moment.alias("ran_at"))
    rows.coalesce(1).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(f"{path}/{RUN}={run}")
    return run


def check_history(spark: SparkSession, path: str) -> DataFrame:
    """check_name, table_name, failures, passed, run, ran_at of every run that was stored whole."""
    whole = files.partition_values(spark, path, RUN, "_SUCCESS")
    if not whole:
        return spark.createDataFrame([], VERDICTS)
    return spark.read.schema(VERDICTS).parquet(path).where(F.col(RUN).isin([int(r) for r in whole]))


def islands(history: DataFrame) -> DataFrame:
    """Stretches of consecutive runs of a check with one outcome: check_name, passed, first_run, last_run, runs, worst."""
    all_runs, same = Window.partitionBy("check_name").orderBy(RUN), Window.partitionBy("check_name", "passed").orderBy(RUN)
    marked = history.withColumn("_island", F.row_number().over(all_runs) - F.row_number().over(same))
    return marked.groupBy("check_name", "passed", "_island").agg(
        F.min(RUN).alias("first_run"), F.max(RUN).alias("last_run"), F.count("*").alias("runs"), F.max("failures").alias("worst")).drop("_island")


def failing_since(history: DataFrame) -> DataFrame:
    """Checks that failed when they last ran: check_name, first_run of the present failure, runs, worst."""
    newest = history.groupBy("check_name").agg(F.max(RUN).alias("last_run"))
    now = islands(history).where(~F.col("passed"))
    return now.join(newest, ["check_name", "last_run"]).select("check_name", "first_run", "last_run", "runs", "worst")
