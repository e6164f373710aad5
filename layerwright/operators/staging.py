"""Staging: rename, reach into nested fields, cast safely; no business logic."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame


def stage(df: DataFrame, mapping: Mapping[str, Column]) -> DataFrame:
    """Project to exactly the mapped columns, in the mapping's order."""
    return df.select(*[column.alias(name) for name, column in mapping.items()])
