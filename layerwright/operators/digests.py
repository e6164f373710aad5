"""Order-free digests of rows: compare large tables by small numbers first.

A digest is a count, a sum and an exclusive-or of 64-bit row hashes: whatever order or
partitioning the rows come in, equal bags of rows have equal digests, and it combines
before the shuffle, so a date of any size moves one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerwright.operators.diff import recompute_diff
from layerwright.operators.grain import GrainSpec, aggregate
from layerwright.operators.incremental import in_grains

DIGITS = 12  # of a double that count: well finer than the tolerance of the diff, far coarser than summation order


def _comparable(df: DataFrame, column: str) -> Column:
    """The value as it is hashed.  Doubles by their leading digits: sums in another order still agree, but for rare edges."""
    kind = df.schema[column].dataType
    value = F.col(f"`{column}`")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.when(value == 0, F.lit("0")).otherwise(F.format_string(f"%.{DIGITS - 1}e", value.cast("double")))
    return value


def row_hash(df: DataFrame, columns: Sequence[str]) -> Column:
    """64 bits of a row; NULLs have places of their own."""
    parts = []
    for c in columns:
        parts += [F.col(f"`{c}`").isNull(), _comparable(df, c)]
    return F.xxhash64(*parts)


def digest(df: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """by..., rows, hash_sum, hash_xor."""
    hashed = df.select(*by, row_hash(df, columns).alias("_h"))
    return hashed.groupBy(*by).agg(
        F.count("*").alias("rows"), F.sum(F.col("_h").cast("decimal(20,0)")).cast("string").alias("hash_sum"), F.bit_xor("_h").alias("hash_xor"))


def differing(left: DataFrame, right: DataFrame, by: str, columns: Sequence[str]) -> DataFrame:
    """The values of `by` (NULL among them) whose rows are not the same bag on both sides."""
    a = digest(left, [by], columns).select(F.col(by).alias("_a"), F.struct("rows", "hash_sum", "hash_xor").alias("da"))
    b = digest(right, [by], columns).select(F.col(by).alias("_b"), F.struct("rows", "hash_sum", "hash_xor").alias("db"))
    joined = a.join(b, F.col("_a").eqNullSafe(F.col("_b")), "full_outer")
    return joined.where(~F.col("da").eqNullSafe(F.col("db"))).select(F.coalesce("_a", "_b").alias(by))


def recompute_diff_digest(silver: DataFrame, gold: DataFrame, spec: GrainSpec) -> DataFrame:
    """`recompute_diff` of whole gold, by digests per grain date first.

    Only the grain dates whose digests differ are aggregated and joined grain by grain;
    the others move one row per date.  The dates reach the driver, so that both scans of
    the second step skip whole partitions.  A double on the edge of its last digit that
    counts sends a date to the second step, which then finds nothing.
    """
    columns = [*spec.keys, *spec.measures]
    dates = differing(aggregate(silver, spec).select(*columns), gold.select(*columns), spec.date_name, columns)
    days = [r[0] for r in dates.select(F.col(spec.date_name).cast("date").cast("string")).collect()]
    return recompute_diff(aggregate(in_grains(silver, spec, days), spec), _on(gold, spec, days), spec.keys, list(spec.measures))


def _on(gold: DataFrame, spec: GrainSpec, days: Sequence[str | None]) -> DataFrame:
    date = F.col(spec.date_name)
    known = [F.lit(d).cast("date").cast(gold.schema[spec.date_name].dataType) for d in days if d is not None]
    wanted = date.isin(*known) if known else F.lit(False)
    return gold.where(wanted | date.isNull() if None in days else wanted)


def relation_diff(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Rows of one relation that the other lacks, copies counted: problem (missing, extra), copies, and the row.

    The form for relations without a key: each row counts +1 on the expected side and -1
    on the actual one, in one grouping that combines before the shuffle, so a row that
    makes up a third of either side moves once per task.  NULLs equal NULLs.
    """
    columns = expected.columns
    signed = expected.select(*columns, F.lit(1).cast("bigint").alias("_sign")).unionByName(actual.select(*columns, F.lit(-1).cast("bigint").alias("_sign")))
    counts = signed.groupBy(*columns).agg(F.sum("_sign").alias("_n")).where("_n != 0")
    problem = F.when(F.col("_n") > 0, F.lit("missing")).otherwise(F.lit("extra"))
    return counts.select(problem.alias("problem"), F.abs("_n").alias("copies"), *columns)
