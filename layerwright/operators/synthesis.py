"""Make demonstration batches out of real rows: samples, defects, late records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

POSITION = "position"
DEFECT = "defect"


@dataclass(frozen=True)
class Nulled:
    """The field is present but null (a dotted path reaches into structs)."""

    path: str


@dataclass(frozen=True)
class Renamed:
    """The value arrives under another field name."""

    path: str
    new_name: str


def _shuffle_key(keys: Sequence[str], seed: int) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))


def sample_rows(df: DataFrame, n: int, keys: Sequence[str], seed: int = 7) -> DataFrame:
    """A uniform sample of n rows, the same on every run, numbered 0..n-1 in `position`.

    Rows are ranked by a seeded hash of their key; each task keeps its n best
    and only those are merged, so the input may be any size.
    """
    order = [_shuffle_key(keys, seed), *[F.col(k).asc_nulls_last() for k in keys]]
    picked = df.orderBy(*order).limit(n)
    # Over the n picked rows only.
    return picked.withColumn(POSITION, F.row_number().over(Window.orderBy(*order)).cast("bigint") - 1)


def in_blocks(size: int, kinds: int) -> Column:
    """Defect number by blocks of `size`; positions past the last block are clean (= kinds)."""
    return F.least(F.expr(f"{POSITION} div {size}"), F.lit(kinds).cast("bigint"))


def in_turn(kinds: int) -> Column:
    """Defect number by turns: 0, 1, .., kinds, 0, 1, ..; the last one is clean."""
    return F.pmod(F.col(POSITION), F.lit(kinds + 1).cast("bigint"))


def inject_defects(numbered: DataFrame, defects: Sequence[Nulled | Renamed], assign: Column) -> DataFrame:
    """Apply the defect each position is assigned; `defect` records which (len(defects) = clean)."""
    out = numbered.withColumn(DEFECT, assign)
    for number, defect in enumerate(defects):
        hit = F.col(DEFECT) == number
        if isinstance(defect, Renamed):
            out = out.withColumn(defect.new_name, F.when(hit, F.col(defect.path)))
        out = _null_where(out, defect.path, hit)
    return out


def _null_where(df: DataFrame, path: str, hit: Column) -> DataFrame:
    top, _, inner = path.partition(".")
    if not inner:
        return df.withColumn(top, F.when(~hit, F.col(top)))
    return df.withColumn(top, F.col(top).withField(inner, F.when(~hit, F.col(path))))


def template_row(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """The first row under a total order, found by a distributed top-1."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in order]).limit(1)


def late_record(df: DataFrame, order: Sequence[str], overrides: Mapping[str, Column], ingest_date: Column) -> DataFrame:
    """A copy of the first row with some fields overridden, landing on a later date."""
    return template_row(df, order).withColumns({**overrides, "ingest_date": ingest_date})
