"""Numeric helpers: IEEE results under ANSI mode."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from barlake.functions.numeric import ieee_div, nan_to_null, pct_diff


def test_ieee_div_and_pct_diff(spark):
    rows = [(1.0, 0.0), (-1.0, 0.0), (0.0, 0.0), (3.0, 2.0), (None, 1.0)]
    df = spark.createDataFrame(rows, "a double, b double")
    got = df.select(
        ieee_div(F.col("a"), F.col("b")).alias("q"),
        pct_diff(F.col("b"), F.col("a")).alias("p"),
        nan_to_null(ieee_div(F.col("a"), F.col("b"))).alias("n"),
    ).collect()
    q = [r.q for r in got]
    assert q[0] == math.inf and q[1] == -math.inf and math.isnan(q[2]) and q[3] == 1.5 and q[4] is None
    # |b - a| / b * 100 with b = 0 and a != 0 -> +inf; both 0 -> NaN
    assert got[0].p == math.inf and math.isnan(got[2].p) and math.isclose(got[3].p, 50.0)
    assert got[2].n is None and got[3].n == 1.5
