"""Aggregates at a declared grain."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerwright.functions import trunc_ntz


PART = "grain_date"


@dataclass(frozen=True)
class GrainSpec:
    """One row per (truncated date, dimensions).

    dims and measures map output columns to SQL expressions over the input.
    Stored inputs and stored aggregates are both partitioned by `grain_date`,
    the truncated date as a DATE: window filters are repeated on it so that
    whole partitions are skipped.
    """

    date_name: str
    date_col: str
    grain: str
    dims: Mapping[str, str]
    measures: Mapping[str, str] = field(default_factory=lambda: {"n": "count(*)"})

    @property
    def keys(self) -> list[str]:
        return [self.date_name, *self.dims]

    def grain_of(self, column: str | Column) -> Column:
        return trunc_ntz(self.grain, column)

    def grain_date(self, column: str | Column) -> Column:
        """The partition value: the truncated date as a DATE."""
        return self.grain_of(column).cast("date")


def aggregate(df: DataFrame, spec: GrainSpec) -> DataFrame:
    """Group at the grain.  Counts and averages combine before the shuffle; a
    distinct count is shuffled by (group, value) first, so a hot group is
    spread over its values."""
    keys = [spec.grain_of(spec.date_col).alias(spec.date_name)]
    keys += [F.expr(sql).alias(name) for name, sql in spec.dims.items()]
    measures = [F.expr(sql).alias(name) for name, sql in spec.measures.items()]
    return df.groupBy(*keys).agg(*measures)
