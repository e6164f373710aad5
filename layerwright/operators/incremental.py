"""Keep a stored aggregate right while records arrive late.

Stored gold is Parquet partitioned by the grain's date (a DATE column), and a
run replaces whole grain dates: re-aggregate everything from a cutoff on, then
swap in those partitions.  The cutoff is aligned down to the grain, so no
partition is ever rebuilt from part of its rows.

Dates travel between the tables and the driver as SQL text, never as Python
dates: text can hold any year the tables can.  Rows without a date form a
partition of their own; no window can tell whether they are new, so every run
re-aggregates them.
"""

from __future__ import annotations

import datetime as dt
import json
import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerwright.functions import days_before, ntz_literal
from layerwright.operators.diff import recompute_diff
from layerwright.operators.grain import PART, GrainSpec, aggregate
from layerwright.sources import files

LOOKBACK_DAYS = 3  # fixed value: how late a record may be and still be picked up
FLOOR = "1900-01-01 00:00:00"  # fixed value: watermark of an empty table


# ---- watermark and window ---------------------------------------------------


def watermark_frame(gold: DataFrame, spec: GrainSpec, lookback_days: int = LOOKBACK_DAYS, cap=None) -> DataFrame:
    """One row: the newest stored grain (floor if none) and the grain-aligned cutoff.

    `cap` holds the watermark back to a given date, so that a single row dated
    far in the future cannot hide all normal ones.
    """
    newest = F.coalesce(F.max(spec.date_name).cast("timestamp_ntz"), ntz_literal(FLOOR))
    if cap is not None:
        newest = F.least(newest, ntz_literal(cap))
    top = gold.agg(newest.alias("watermark"))
    return top.withColumn("cutoff", spec.grain_of(days_before("watermark", lookback_days)))


def cutoff_text(gold: DataFrame, spec: GrainSpec, lookback_days: int = LOOKBACK_DAYS, cap=None) -> str:
    """The cutoff as one value, so the window filter is a literal the scan can use."""
    top = watermark_frame(gold, spec, lookback_days, cap)
    return top.select(F.col("cutoff").cast("string")).first()[0]


def cutoff(gold: DataFrame, spec: GrainSpec, lookback_days: int = LOOKBACK_DAYS, cap=None) -> dt.datetime:
    """The same as a Python value, for years up to 9999."""
    return dt.datetime.fromisoformat(cutoff_text(gold, spec, lookback_days, cap))


def _literal_like(df: DataFrame, column: str, value: dt.datetime | str) -> Column:
    """A cutoff (always midnight) in the column's own type, so the comparison needs no cast and is pushed down."""
    literal = ntz_literal(value)
    return literal.cast("date") if isinstance(df.schema[column].dataType, T.DateType) else literal


def since(silver: DataFrame, spec: GrainSpec, start: dt.datetime | str | None, undated: bool = False) -> DataFrame:
    """Rows at or after `start`, with undated=True also those without a date; all rows when there is no start."""
    if start is None:
        return silver
    date = F.col(spec.date_col)
    window = date >= _literal_like(silver, spec.date_col, start)
    if undated:
        window |= date.isNull()
    if PART in silver.columns:
        part = F.col(PART).cast("date")
        pruned = part >= ntz_literal(start).cast("date")
        window &= (pruned | part.isNull()) if undated else pruned
    return silver.where(window)


def before(df: DataFrame, column: str, end: dt.datetime | str) -> DataFrame:
    return df.where(F.col(column) < _literal_like(df, column, end))


def in_grains(silver: DataFrame, spec: GrainSpec, grains: Iterable[dt.date | str | None]) -> DataFrame:
    """Rows that belong to the given grain dates (None: rows without one); prunes partitions where there are any."""
    dates = list(grains)
    if not dates:
        return silver.limit(0)
    part = _grain_date(silver, spec)
    known = [F.lit(str(d)).cast("date") for d in dates if d is not None]
    wanted = part.isin(*known) if known else F.lit(False)
    return silver.where(wanted | part.isNull() if None in dates else wanted)


# ---- storage ----------------------------------------------------------------


def has_gold(spark: SparkSession, path: str) -> bool:
    return bool(files.partition_values(spark, path, PART))


def read_gold(spark: SparkSession, path: str, spec: GrainSpec) -> DataFrame:
    """Stored gold with its date as a zone-less timestamp again."""
    stored = spark.read.parquet(path)
    rest = [c for c in stored.columns if c != PART]
    return stored.select(F.col(PART).cast("date").cast("timestamp_ntz").alias(spec.date_name), *rest)


def replace_partitions(
    batch: DataFrame,
    path: str,
    part: str,
    start: dt.date | str | None = None,
    only: Iterable[dt.date | str | None] | None = None,
    rebalance: bool = True,
) -> None:
    """Make the partitions in scope equal to `batch`, leave all others alone.

    Scope is everything from `start` on and the rows without a date, or just
    the dates in `only`, or the whole table.  A dynamic overwrite replaces each
    partition the batch has rows for.  A partition in scope that still shows a
    file from before has become empty and is dropped; that takes two listings
    of each partition in scope and no second pass over the batch.
    rebalance=False saves the shuffle where each task's rows lie on few dates anyway.
    """
    spark = batch.sparkSession
    wanted = None if only is None else {files.NO_VALUE if d is None else str(d) for d in only}
    first = None if start is None else _calendar_day(str(start))

    def in_scope(value: str) -> bool:
        if wanted is not None:
            return value in wanted
        return first is None or value == files.NO_VALUE or _calendar_day(value) >= first

    def listing() -> set[tuple[str, str]]:
        return files.partition_files(spark, path, part, list(filter(in_scope, files.partition_values(spark, path, part))))

    old = listing()
    rows = batch.hint("rebalance", part) if rebalance else batch
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", files.CODEC).partitionBy(part).parquet(path)
    for value in {v for v, _ in old & listing()}:
        files.delete(spark, f"{path}/{part}={value}")


def _calendar_day(text: str) -> tuple[int, ...]:
    """Year, month, day of an SQL date of any year: as text, year 20240 sorts before 2025."""
    return tuple(map(int, re.match(r"([+-]?\d+)-(\d+)-(\d+)", text).groups()))


INTENT = "_rebuilding"  # readers skip names with an underscore


def _pending(spark: SparkSession, path: str) -> dict | None:
    """Scope of a write that was begun and not finished: {"since": date or None} or {"only": dates}."""
    text = files.read_text(spark, f"{path}/{INTENT}")
    return None if text is None else json.loads(text) if text else {"since": None}


def _covers(scope: dict, other: dict | None) -> bool:
    """Whether redoing `scope` redoes `other` as well."""
    if other is None:
        return True
    if "only" in scope:
        return "only" in other and set(other["only"]) <= set(scope["only"])
    if scope["since"] is None:
        return True
    days = other["only"] if "only" in other else [other["since"]]
    first = _calendar_day(scope["since"])
    return all(d is None and "only" in other or d is not None and _calendar_day(d) >= first for d in days)


def _store(batch: DataFrame, path: str, spec: GrainSpec, scope: dict) -> None:
    """Replace the grain dates in scope under a marker that names the scope.

    A dynamic overwrite moves its partitions one by one, so a driver lost in
    between leaves some of them missing.  The marker then stays behind, and the
    next run starts no later than the scope it names.
    """
    spark = batch.sparkSession
    dated = batch.withColumn(PART, F.col(spec.date_name).cast("date")).drop(spec.date_name)
    left = _pending(spark, path)
    if _covers(scope, left):
        left = None
    # A scope that is not redone here joins this one until it is.
    files.write_text(spark, f"{path}/{INTENT}", json.dumps(scope if left is None else {"since": None}))
    replace_partitions(dated, path, PART, start=scope.get("since"), only=scope.get("only"))
    if left is None:
        files.delete(spark, f"{path}/{INTENT}")
    else:
        files.write_text(spark, f"{path}/{INTENT}", json.dumps(left))


# ---- runs -------------------------------------------------------------------


def incremental_run(
    silver: DataFrame,
    path: str,
    spec: GrainSpec,
    lookback_days: int = LOOKBACK_DAYS,
    full_refresh: bool = False,
    cap=None,
) -> DataFrame:
    """Bring stored gold up to date with silver and return it.

    First run and full refresh rebuild every grain; otherwise only grains from
    the cutoff on are re-aggregated.
    """
    spark = silver.sparkSession
    start = None
    if not full_refresh and has_gold(spark, path):
        start = cutoff_text(read_gold(spark, path, spec), spec, lookback_days, cap)
        start = _reach_back(silver, spec, start, _pending(spark, path))
    batch = aggregate(since(silver, spec, start, undated=True), spec)
    _store(batch, path, spec, {"since": None if start is None else start.split(" ")[0]})
    return read_or_empty(spark, path, spec, batch)


def _reach_back(silver: DataFrame, spec: GrainSpec, start: str, unfinished: dict | None) -> str | None:
    """The start of a run that also redoes the scope of a broken-off one."""
    if unfinished is None or _covers({"since": start}, unfinished):
        return start
    days = unfinished["only"] if "only" in unfinished else [unfinished["since"]]
    if "only" not in unfinished and days[0] is None:
        return None
    # Grain dates are aligned already.
    return f"{min((d for d in days if d is not None), key=_calendar_day)} 00:00:00"


def repair_grains(silver: DataFrame, path: str, spec: GrainSpec, grains: Iterable[dt.date | str | None]) -> DataFrame:
    """Re-aggregate just these grain dates (None: rows without one), however old they are."""
    spark = silver.sparkSession
    dates = [None if d is None else str(d) for d in grains]
    batch = aggregate(in_grains(silver, spec, dates), spec)
    if dates:
        _store(batch, path, spec, {"only": dates})
    return read_or_empty(spark, path, spec, batch)


def read_or_empty(spark: SparkSession, path: str, spec: GrainSpec, like: DataFrame) -> DataFrame:
    """Stored gold; no rows in the shape of `like` where nothing was stored yet."""
    if has_gold(spark, path):
        return read_gold(spark, path, spec)
    return spark.createDataFrame([], like.schema)


def _grain_date(rows: DataFrame, spec: GrainSpec) -> Column:
    return F.col(PART).cast("date") if PART in rows.columns else spec.grain_date(spec.date_col)


def grain_dates(rows: DataFrame, spec: GrainSpec) -> DataFrame:
    """The distinct grain dates these rows fall on."""
    return rows.select(_grain_date(rows, spec).alias(PART)).distinct()


def grain_texts(rows: DataFrame, spec: GrainSpec) -> list[str | None]:
    """Those dates as SQL text, oldest first: never more than the table has partitions."""
    days = grain_dates(rows, spec).orderBy(PART).select(F.col(PART).cast("string"))
    return [row[0] for row in days.collect()]


def collect_grains(rows: DataFrame, spec: GrainSpec) -> list[dt.date | None]:
    """The same as Python values, for years up to 9999."""
    return [None if d is None else dt.date.fromisoformat(d) for d in grain_texts(rows, spec)]


def late_grains(batch: DataFrame, spec: GrainSpec, start: dt.datetime | str) -> DataFrame:
    """Grain dates of newly landed rows that an incremental run from `start` will not reach."""
    return grain_dates(before(batch, spec.date_col, start), spec)


def missed_grains(
    silver: DataFrame, gold: DataFrame, spec: GrainSpec, lookback_days: int = LOOKBACK_DAYS, cap=None
) -> DataFrame:
    """Grains older than the window whose stored values no longer match silver."""
    start = cutoff_text(gold, spec, lookback_days, cap)
    expected = aggregate(before(silver, spec.date_col, start), spec)
    actual = before(gold, spec.date_name, start)
    return recompute_diff(expected, actual, spec.keys, list(spec.measures))
