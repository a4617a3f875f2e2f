"""Column helpers: all built-in expressions, evaluated JVM-side."""

from barlake.functions.calendar import (  # noqa: F401
    is_trading_day,
    last_trading_day,
    next_trading_day,
    previous_trading_day,
    trading_days_between,
)
from barlake.functions.numeric import ieee_div, nan_to_null, pct_diff  # noqa: F401
