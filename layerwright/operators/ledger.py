"""Rejection counts that add up: one row per landing and reason, instead of a scan of all staged rows.

Counts of landings are summed to any rate, so a gate over all history reads a few rows per
landing.  A landing that was rewritten replaces its rows, one withdrawn takes them along.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerwright.functions import ratio
from layerwright.operators.incremental import replace_partitions
from layerwright.operators.quality import REASON
from layerwright.sources import files
from layerwright.sources.bronze import INGEST_DATE

LEDGER = f"{REASON} string, n bigint, {INGEST_DATE} date"


def count_landings(classified: DataFrame) -> DataFrame:
    """rejection_reason (NULL: accepted), n, ingest_date."""
    return classified.groupBy(REASON, INGEST_DATE).agg(F.count("*").alias("n")).select(REASON, "n", INGEST_DATE)


def update_ledger(classified: DataFrame, path: str, landings: Sequence[str] | None = None) -> None:
    """Count these landings anew (all, if None is given); a landing without rows leaves the ledger."""
    rows, only = classified, None
    if landings is not None:
        only = [None if d == files.NO_VALUE else d for d in landings]
        rows = classified.where(F.coalesce(F.col(INGEST_DATE).cast("string"), F.lit(files.NO_VALUE)).isin(list(landings)))
    if only is None or only:
        replace_partitions(count_landings(rows), path, INGEST_DATE, only=only)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    if not files.partition_values(spark, path, INGEST_DATE):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(path)


def ledger_rate(ledger: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """rejected_count, total_count, rejection_rate: overall or by landing, like `rejection_rate` of the rows themselves."""
    zero = F.lit(0).cast("bigint")
    counts = ledger.groupBy(*by).agg(
        F.coalesce(F.sum(F.when(F.col(REASON).isNotNull(), F.col("n"))), zero).alias("rejected_count"), F.coalesce(F.sum("n"), zero).alias("total_count"))
    return counts.withColumn("rejection_rate", ratio(F.col("rejected_count"), F.col("total_count")))


def ledger_summary(ledger: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rejected rows per reason."""
    return ledger.where(F.col(REASON).isNotNull()).groupBy(*by, REASON).agg(F.sum("n").alias("n"))
