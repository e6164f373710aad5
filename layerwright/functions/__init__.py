"""Column-in, Column-out helpers; all compile to built-in expressions."""

from layerwright.functions.columns import (
    days_before,
    fill,
    first_element,
    headline,
    hours_between,
    is_not,
    null_safe,
    ntz_literal,
    ratio,
    safe_bigint,
    safe_date,
    safe_double,
    safe_timestamp,
    trunc_ntz,
)

__all__ = [
    "days_before",
    "fill",
    "first_element",
    "headline",
    "hours_between",
    "is_not",
    "null_safe",
    "ntz_literal",
    "ratio",
    "safe_bigint",
    "safe_date",
    "safe_double",
    "safe_timestamp",
    "trunc_ntz",
]
