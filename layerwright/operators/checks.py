"""Data checks: each yields its violations, and a run of many yields one verdict table."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerwright.sources.bronze import union_by_name


@dataclass(frozen=True)
class TableChecks:
    """Column checks declared for one table."""

    table: str
    not_null: Sequence[str] = ()
    unique: Sequence[str] = ()


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Violations: columns holding NULLs and how many, all columns in one pass."""
    return _null_counts(df, columns).where(F.col("failures") > 0)


def _null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("failures")) for c in columns])
    return counts.select(F.inline(pairs))


def unique(df: DataFrame, key: str) -> DataFrame:
    """Violations: non-null values that occur more than once, and how often.

    Counting combines before the shuffle, so a hot value costs one row per task.
    """
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count("*").alias("n"))
        .where(F.col("n") > 1)
    )


def _verdict(check_name, table: str, failures: DataFrame) -> DataFrame:
    return failures.select(
        check_name.alias("check_name"), F.lit(table).alias("table_name"), F.col("failures").cast("bigint").alias("failures")
    )


def column_verdicts(df: DataFrame, checks: TableChecks) -> list[DataFrame]:
    verdicts = []
    if checks.not_null:
        name = F.concat(F.lit(f"not_null_{checks.table}_"), F.col("column_name"))
        verdicts.append(_verdict(name, checks.table, _null_counts(df, checks.not_null)))
    for key in checks.unique:
        counted = unique(df, key).agg(F.count("*").alias("failures"))
        verdicts.append(_verdict(F.lit(f"unique_{checks.table}_{key}"), checks.table, counted))
    return verdicts


def relation_verdict(name: str, table: str, violations: DataFrame) -> DataFrame:
    """Verdict of a check given as a relation that must be empty."""
    return _verdict(F.lit(name), table, violations.agg(F.count("*").alias("failures")))


def run_checks(
    tables: Mapping[str, DataFrame],
    columns: Iterable[TableChecks] = (),
    relations: Iterable[tuple[str, str, DataFrame]] = (),
) -> DataFrame:
    """check_name, table_name, failures, passed: one row per check, in one job."""
    verdicts = [v for spec in columns for v in column_verdicts(tables[spec.table], spec)]
    verdicts += [relation_verdict(*relation) for relation in relations]
    return union_by_name(verdicts).withColumn("passed", F.col("failures") == 0)


def unexpected_failures(results: DataFrame, allowlist: Iterable[str]) -> DataFrame:
    """Failed checks that are not known to fail on purpose."""
    known = list(allowlist)
    failed = results.where(~F.col("passed"))
    return failed.where(~F.col("check_name").isin(known)) if known else failed
