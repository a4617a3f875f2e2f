"""Numeric helpers with IEEE semantics under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ieee_div(a: Column, b: Column) -> Column:
    """``a / b`` giving +-inf or NaN on a zero divisor instead of an error.

    ANSI Spark raises DIVIDE_BY_ZERO and ``try_divide`` returns NULL; the
    checks and comparisons need the float result (inf counts as a large
    move, NaN sorts above every number).
    """
    inf = F.lit(float("inf"))
    return (
        F.when(b != 0, a / b)
        .when(a > 0, inf)
        .when(a < 0, -inf)
        .when(a == 0, F.lit(float("nan")))
    )


def nan_to_null(c: Column) -> Column:
    """NaN -> NULL, so that ``max``/``min`` skip it instead of returning NaN."""
    return F.when(~F.isnan(c), c)


def pct_diff(a: Column, b: Column) -> Column:
    """``|a - b| / a * 100``: asymmetric, relative to the left value."""
    return ieee_div(F.abs(a - b), a) * F.lit(100.0)
