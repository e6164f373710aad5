"""Compare a fresh recomputation with what is stored."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerwright.functions import null_safe

TOLERANCE = 1e-9  # relative; averages may be summed in another order


def _differs(left: Column, right: Column, fractional: bool) -> Column:
    same = left.eqNullSafe(right)
    if fractional:
        close = F.abs(left - right) <= F.lit(TOLERANCE) * F.greatest(F.abs(left), F.abs(right))
        same = same | F.coalesce(close, F.lit(False))
    return ~same


def recompute_diff(
    expected: DataFrame,
    actual: DataFrame,
    keys: Sequence[str],
    measures: Sequence[str],
    two_sided: bool = True,
    null_safe_keys: bool = True,
) -> DataFrame:
    """Violations: grains missing from `actual`, changed in it, or (two-sided) extra.

    two_sided=False is the one-directional comparison; null_safe_keys=False
    matches keys by plain equality.  Both sides are one row per grain, and the
    null-safe condition is still an equi-join key, so no side is broadcast
    unless Spark finds it small and no pairs are enumerated.
    """
    doubles = {f.name for f in expected.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    left = expected.select(*keys, *measures, F.lit(True).alias("_here")).alias("e")
    right = actual.select(*keys, *measures, F.lit(True).alias("_here")).alias("a")
    if null_safe_keys:
        condition = null_safe(keys, "e", "a")
    else:
        condition = [F.col(f"e.{k}") == F.col(f"a.{k}") for k in keys]
    joined = left.join(right, condition, "full_outer" if two_sided else "left_outer")

    changed = F.lit(False)
    for m in measures:
        changed = changed | _differs(F.col(f"e.{m}"), F.col(f"a.{m}"), m in doubles)
    problem = (
        F.when(F.col("a._here").isNull(), F.lit("missing"))
        .when(F.col("e._here").isNull(), F.lit("extra"))
        .when(changed, F.lit("changed"))
    )
    # A grain present on both sides has equal keys, so either side's value will do.
    shown_keys = [F.coalesce(F.col(f"e.{k}"), F.col(f"a.{k}")).alias(k) for k in keys]
    shown = [F.col(f"{side}.{m}").alias(f"{name}_{m}") for m in measures for side, name in (("e", "expected"), ("a", "actual"))]
    return joined.select(*shown_keys, *shown, problem.alias("problem")).where(F.col("problem").isNotNull())
