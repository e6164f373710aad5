"""Delete + insert by key, as a set operation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from layerwright.functions import null_safe


def survivors(gold: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key the batch does not bring (NULL keys match NULL keys)."""
    brought = batch.select(*keys).distinct().alias("b")
    return gold.alias("g").join(brought, null_safe(keys, "g", "b"), "left_anti")


def upsert_by_key(gold: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Survivors plus the batch.

    `snapshot_upsert` stores it as a new version; a Parquet path cannot be read
    and overwritten in one plan.
    """
    return survivors(gold, batch, keys).unionByName(batch)
