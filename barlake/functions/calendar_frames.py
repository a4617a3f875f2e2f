"""Calendar frames built from bounds rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.functions.calendar import is_trading_day


def trading_calendar(bounds: DataFrame, start_col: str = "start", end_col: str = "end") -> DataFrame:
    """Explode each bounds row into its weekdays in [start, end] as ``date``.

    ``sequence(later, earlier)`` would count down, so rows with
    start > end produce nothing. The output size is bounded by calendar
    days per bounds row.
    """
    s, e = F.col(start_col), F.col(end_col)
    days = F.when(s <= e, F.sequence(s, e)).otherwise(F.array().cast("array<date>"))
    return bounds.withColumn("date", F.explode(days)).filter(is_trading_day(F.col("date")))
