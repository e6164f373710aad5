"""Keep the best row per key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(column: str) -> Column:
    return F.col(column).desc_nulls_last()


def lowest(column: str) -> Column:
    # Spark sorts NULLs first when ascending; a row without a rank must not win.
    return F.col(column).asc_nulls_last()


MOSTLY_UNIQUE = 0.8  # distinct keys a row from which on counting the repeated ones is worth a pass
REPEATED = 1_000_000  # most repeated keys sent to every executor


def keep_best(df: DataFrame, keys: Sequence[str], order: Sequence[Column], tie_break: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the first under `order`, ties settled by the remaining columns.

    Filtering row_number() = 1 lets Spark keep one candidate per key and task
    before the shuffle (WindowGroupLimit), so a key that holds a third of all
    rows moves at most one row per map task.
    """
    if tie_break is None:
        tie_break = [c for c in df.columns if c not in keys]
    rank = "_best_rank"
    window = Window.partitionBy(*keys).orderBy(*order, *[lowest(c) for c in tie_break])
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) == 1).drop(rank)


def keep_best_stored(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], tie_break: Sequence[str] | None = None, most: int = REPEATED
) -> DataFrame:
    """The same rows as `keep_best`, of stored rows, which can be read more than once.

    Where few keys repeat, only the rows of those keys are shuffled: the keys alone are counted first,
    and all other rows stay where they are.  Where many do (more than `most`, or most rows are
    copies), it is `keep_best`.
    """
    total = df.agg(F.count("*").alias("rows"), F.approx_count_distinct(F.struct(*keys)).alias("distinct")).first()
    if total["distinct"] < MOSTLY_UNIQUE * total["rows"]:
        return keep_best(df, keys, order, tie_break)
    repeated = df.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1").select(*[F.col(k).alias(f"_r_{k}") for k in keys])
    if repeated.limit(most + 1).count() > most:
        return keep_best(df, keys, order, tie_break)
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    best = keep_best(df.join(F.broadcast(repeated), same, "left_semi"), keys, order, tie_break)
    return df.join(F.broadcast(repeated), same, "left_anti").unionByName(best)
