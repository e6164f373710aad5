"""Validate and quarantine: every row is either accepted or rejected with a reason."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerwright.functions import ratio

REASON = "rejection_reason"
MALFORMED = "malformed_record"
THRESHOLD = 0.02  # fixed value: share of rejected rows a run may carry

Rule = tuple[str, str]  # (column that must not be null, reason given when it is)


def required(*columns: str) -> list[Rule]:
    return [(c, f"missing_{c}") for c in columns]


def classify(df: DataFrame, rules: Sequence[Rule], text: str | None = None) -> DataFrame:
    """Add `rejection_reason`: that of the first broken rule, NULL for a good row.

    Narrow and row-local, so both outputs of the split come from one pass.  `text` names
    the column that holds a record's text where it could not be read as declared: a row
    with one that breaks a rule does so for that reason.
    """
    reason = F.coalesce(*[F.when(F.col(column).isNull(), F.lit(reason)) for column, reason in rules])
    if text is not None:
        reason = F.when(F.col(text).isNotNull() & reason.isNotNull(), F.lit(MALFORMED)).otherwise(reason)
    return df.withColumn(REASON, reason)


def valid(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The accepted side straight from unclassified rows: plain IS NOT NULL filters, which reach the scan."""
    return df.where(reduce(lambda a, b: a & b, [F.col(column).isNotNull() for column, _ in rules]))


def accepted(classified: DataFrame) -> DataFrame:
    return classified.where(F.col(REASON).isNull()).drop(REASON)


def rejected(classified: DataFrame, columns: Iterable[str]) -> DataFrame:
    return classified.where(F.col(REASON).isNotNull()).select(*columns, REASON)


def split(classified: DataFrame, rejected_columns: Iterable[str]) -> tuple[DataFrame, DataFrame]:
    return accepted(classified), rejected(classified, rejected_columns)


def rejection_summary(classified: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rejected rows per reason."""
    return (
        classified.where(F.col(REASON).isNotNull())
        .groupBy(*by, REASON)
        .agg(F.count("*").alias("n"))
    )


def rejection_rate(classified: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """rejected_count, total_count and their ratio, overall or per batch, in a single pass."""
    counts = classified.groupBy(*by).agg(
        F.count_if(F.col(REASON).isNotNull()).alias("rejected_count"),
        F.count("*").alias("total_count"),
    )
    return _with_rate(counts)


def rejection_rate_of(rejected_rows: DataFrame, staged_rows: DataFrame) -> DataFrame:
    """The same rate when quarantine and staging are separate tables.

    Each side counts itself; only the two counts meet.
    """
    part = rejected_rows.agg(F.count("*").alias("rejected_count"), F.lit(0).cast("bigint").alias("total_count"))
    whole = staged_rows.agg(F.lit(0).cast("bigint").alias("rejected_count"), F.count("*").alias("total_count"))
    counts = part.unionByName(whole).agg(
        F.sum("rejected_count").alias("rejected_count"), F.sum("total_count").alias("total_count")
    )
    return _with_rate(counts)


def _with_rate(counts: DataFrame) -> DataFrame:
    return counts.withColumn("rejection_rate", ratio(F.col("rejected_count"), F.col("total_count")))


def over_threshold(rates: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Violations: rates strictly above the threshold."""
    return rates.where(F.col("rejection_rate") > F.lit(threshold))


def rejection_gate(classified: DataFrame, threshold: float = THRESHOLD, by: Sequence[str] = ()) -> DataFrame:
    return over_threshold(rejection_rate(classified, by), threshold)
