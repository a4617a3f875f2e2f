"""Weekday trading calendar (Mon-Fri, no holidays) as Column expressions.

Counting uses a closed form instead of exploding a day sequence, so a
range of any length costs O(1) per row.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    if isinstance(c, Column):
        return c
    if isinstance(c, (_dt.date, _dt.datetime)):
        return F.lit(c).cast("date")
    if isinstance(c, str) and len(c) == 10 and c[4] == "-":
        return F.to_date(F.lit(c))
    return F.col(c)


def is_trading_day(d) -> Column:
    """Mon-Fri (``weekday`` is 0 for Monday)."""
    return F.weekday(_col(d)) < 5


def last_trading_day(d) -> Column:
    """Most recent weekday on or before ``d`` (Sat/Sun step back to Fri)."""
    d = _col(d)
    return F.date_sub(d, F.greatest(F.weekday(d) - 4, F.lit(0)))


def previous_trading_day(d) -> Column:
    """Greatest weekday strictly before ``d``."""
    return last_trading_day(F.date_sub(_col(d), 1))


def next_trading_day(d) -> Column:
    """Smallest weekday strictly after ``d``."""
    d1 = F.date_add(_col(d), 1)
    return F.when(F.weekday(d1) >= 5, F.date_add(d1, F.lit(7) - F.weekday(d1))).otherwise(d1)


def _weekdays_before(x: Column) -> Column:
    # Weekdays among day offsets [0, x) when offset 0 is a Monday.
    return F.floor(x / 7) * 5 + F.least(F.pmod(x, F.lit(7)), F.lit(5))


def trading_days_between(start, end) -> Column:
    """Number of weekdays in ``[start, end]`` inclusive; 0 when start > end."""
    s, e = _col(start), _col(end)
    n = F.datediff(e, s) + 1
    ws = F.weekday(s)
    count = _weekdays_before(ws + n) - _weekdays_before(ws)
    return F.when(n > 0, count.cast("int")).otherwise(F.lit(0))
