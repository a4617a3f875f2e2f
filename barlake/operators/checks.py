"""Data-quality checks over all symbols at once.

Every check is a projection of one shared per-symbol profile:

  1. ``per_day``: group by (symbol, date) -- violation flags summed per day.
     A hot symbol is spread over its dates and pre-aggregated map-side.
  2. ``per_symbol``: group ``per_day`` by symbol (at most one row per
     calendar day and symbol reaches this shuffle).
  3. gap runs: ``lag`` over the distinct dates of a symbol gives the
     *blocks* of missing weekdays between consecutive present dates without
     exploding a calendar; blocks chain into a run when the next block's
     first missing day is <= 3 calendar days after the previous block's last.
     Only the missing dates that are to be listed are materialized.

Check order and names follow ``schema.CHECK_ORDER``. Symbols requested but
absent get a row (gaps/stale fail with "No data for <symbol>").
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlake.functions.calendar import (
    is_trading_day,
    last_trading_day,
    next_trading_day,
    previous_trading_day,
    trading_days_between,
)
from barlake.functions.numeric import ieee_div
from barlake.operators._common import date_lit, restrict_symbols, symbols_frame
from barlake.schema import CHECK_ORDER, STATUS_FAIL, STATUS_ORDER, STATUS_PASS, STATUS_WARN

GAP_CHAIN_DAYS = 3
#: Default number of missing dates that a gap check lists; an argument of the checks.
SHOWN = 20

# Check messages (printf-style formats; %% is a literal %).
MSG_NO_DATA = "No data for %s"
MSG_NO_GAPS = "No gaps found (%d trading days)"
MSG_GAPS = "%d missing trading day(s), longest gap: %d"
MSG_NEGATIVE = "%d rows with negative prices"
MSG_HIGH_LOW = "%d rows where high < low"
MSG_ZERO_CLOSE = "%d rows with zero close"
MSG_NEGATIVE_VOLUME = "%d rows with negative volume"
MSG_SANITY_OK = "All price sanity checks passed"
MSG_FLAT = "%d rows with identical OHLC (possible placeholder)"
MSG_ZERO_VOLUME_MOVE = "%d rows with zero volume but >1%% price movement"
MSG_OHLC_OK = "OHLC consistency checks passed"
MSG_CURRENT = "Data is current (latest: %s)"
MSG_BEHIND = "Data is %d trading day(s) behind (latest: %s)"
ISSUE_SEPARATOR = "; "
SUMMARY_SEPARATOR = ", "


@dataclass(frozen=True)
class Check:
    """A check: its columns (status, message, details) over the profile row of
    a symbol, given the as-of date; and what it needs in that row besides the
    columns that are always there.

    ``daily`` has aggregates over the bars of a (symbol, date), as ``F.max(...)``;
    ``by_symbol`` has aggregates over a symbol's days, which may read the daily
    ones by name. Both join the one pass over the bars. By-symbol names are
    columns of the profile row, NULL for a requested symbol without rows.
    """

    name: str
    columns: Callable[[Column], dict[str, Column]]
    daily: Mapping[str, Column] = field(default_factory=dict)
    by_symbol: Mapping[str, Column] = field(default_factory=dict)


#: Columns of the daily and symbol profiles besides the flags.
_PROFILE_NAMES = {
    "symbol", "date", "n_rows", "n_days", "n_trading_present", "first_date", "latest_date", "n_missing", "longest_gap", "missing_dates",
}


def _as_checks(checks: Sequence) -> list[Check]:
    """Checks, or (name, columns) pairs that need nothing of their own."""
    return [c if isinstance(c, Check) else Check(*c) for c in checks]


def _brought(checks: Sequence[Check], part: str) -> dict[str, Column]:
    """The aggregates that checks bring, by name; two checks may not share a name."""
    taken = _PROFILE_NAMES | set(_flags())
    out: dict[str, Column] = {}
    for check in _as_checks(checks):
        for name, agg in getattr(check, part).items():
            if name in out or name in taken:
                raise ValueError(f"The aggregate '{name}' of check '{check.name}' is taken")
            out[name] = agg
    return out


def _flags() -> dict[str, Column]:
    o, h, lo, c, v = (F.col(x) for x in ("open", "high", "low", "close", "volume"))
    return {
        "n_negative": (o < 0) | (h < 0) | (lo < 0) | (c < 0),
        "n_high_low": h < lo,
        "n_zero_close": c == 0,
        "n_negative_volume": v < 0,
        "n_flat": (o == h) & (h == lo) & (lo == c),
        "n_zero_vol_move": (v == 0) & (ieee_div(F.abs(c - o), o) > F.lit(0.01)),
    }


def daily_profile(bars: DataFrame, symbols=None, checks: Sequence[Check] = ()) -> DataFrame:
    """(symbol, date, n_rows, n_<flag>...) -- one row per present date, with
    the daily aggregates that ``checks`` bring."""
    b = restrict_symbols(bars, symbols)
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    aggs += [F.count_if(cond).alias(name) for name, cond in _flags().items()]
    aggs += [agg.alias(name) for name, agg in _brought(checks, "daily").items()]
    return b.groupBy("symbol", "date").agg(*aggs)


def missing_blocks(per_day: DataFrame) -> DataFrame:
    """Blocks of consecutive missing weekdays between present dates.

    (symbol, first_missing, last_missing, n_missing, run, missing_before)
    where ``run`` numbers the gap runs of a symbol and ``missing_before``
    counts missing days in earlier blocks.
    """
    w = Window.partitionBy("symbol").orderBy("date")
    d = per_day.select("symbol", "date").withColumn("prev", F.lag("date").over(w))
    blocks = d.filter(F.col("prev").isNotNull()).select(
        "symbol",
        next_trading_day(F.col("prev")).alias("first_missing"),
        previous_trading_day(F.col("date")).alias("last_missing"),
        trading_days_between(F.date_add("prev", 1), F.date_sub("date", 1)).alias("n_missing"),
    ).filter(F.col("n_missing") > 0)
    wb = Window.partitionBy("symbol").orderBy("first_missing")
    brk = F.coalesce(
        (F.datediff("first_missing", F.lag("last_missing").over(wb)) > GAP_CHAIN_DAYS).cast("int"), F.lit(1)
    )
    cum = Window.partitionBy("symbol").orderBy("first_missing").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        blocks.withColumn("_brk", brk)
        .withColumn("run", F.sum("_brk").over(cum))
        .withColumn("missing_before", F.sum("n_missing").over(cum) - F.col("n_missing"))
        .drop("_brk")
    )


def _gap_stats(per_day: DataFrame, shown: int | None = SHOWN) -> DataFrame:
    """(symbol, longest_gap, missing_dates) in one pass over the blocks.

    Run lengths come from a window on (symbol, run) -- the blocks are
    already clustered by symbol, so no new shuffle. Blocks that can hold one
    of the first ``shown`` missing dates list their weekdays, cut at the
    whole weeks that always hold so many; ``None`` lists every missing date
    (at most one for each weekday between a symbol's first and last bar).
    """
    blocks = missing_blocks(per_day)
    run_len = F.sum("n_missing").over(Window.partitionBy("symbol", "run"))
    if shown is None:
        last, wanted = F.col("last_missing"), F.lit(True)
    else:
        last = F.least(F.col("last_missing"), F.date_add("first_missing", -(-shown // 5) * 7 - 1))
        wanted = F.col("missing_before") < shown
    head = F.when(wanted, F.filter(F.sequence(F.col("first_missing"), last), lambda d: is_trading_day(d)))
    listed = F.array_sort(F.flatten(F.collect_list("head")))
    return (
        blocks.select("symbol", run_len.alias("run_len"), head.alias("head"))
        .groupBy("symbol")
        .agg(
            F.max("run_len").cast("int").alias("longest_gap"),
            (listed if shown is None else F.slice(listed, 1, shown)).alias("_md"),
        )
        .select(
            "symbol", "longest_gap",
            F.transform("_md", lambda x: F.date_format(x, "yyyy-MM-dd")).alias("missing_dates"),
        )
    )


def symbol_profile(bars: DataFrame, symbols=None, shown: int | None = SHOWN, checks: Sequence[Check] = ()) -> DataFrame:
    """One row per requested symbol with every input the four checks need, and
    what ``checks`` bring; ``missing_dates`` lists the first ``shown`` missing
    dates (None: all)."""
    per_day = daily_profile(bars, symbols, checks)
    brought = _brought(checks, "by_symbol")
    flag_names = list(_flags())
    per_symbol = per_day.groupBy("symbol").agg(
        F.sum("n_rows").alias("n_rows"),
        *[F.sum(n).alias(n) for n in flag_names],
        F.count(F.lit(1)).alias("n_days"),
        F.count_if(is_trading_day(F.col("date"))).alias("n_trading_present"),
        F.min("date").alias("first_date"),
        F.max("date").alias("latest_date"),
        *[agg.alias(name) for name, agg in brought.items()],
    )
    gaps = _gap_stats(per_day, shown)
    if symbols is None:
        # Every symbol present has a per-symbol row: no separate symbol scan.
        p = per_symbol.join(gaps, "symbol", "left")
    else:
        # Requested symbols without rows still get a row (J-4).
        p = symbols_frame(bars, symbols).join(per_symbol, "symbol", "left").join(gaps, "symbol", "left")
    zero = F.lit(0).cast("bigint")
    return p.select(
        "symbol",
        F.coalesce("n_rows", zero).alias("n_rows"),
        *[F.coalesce(n, zero).alias(n) for n in flag_names],
        F.coalesce("n_days", zero).alias("n_days"),
        "first_date",
        "latest_date",
        (trading_days_between(F.col("first_date"), F.col("latest_date")) - F.coalesce("n_trading_present", zero))
        .cast("bigint")
        .alias("n_missing"),
        F.coalesce("longest_gap", F.lit(0)).alias("longest_gap"),
        F.coalesce("missing_dates", F.array().cast("array<string>")).alias("missing_dates"),
        *brought,
    )


def _status(*pairs) -> Column:
    expr = None
    for cond, value in pairs:
        expr = F.when(cond, F.lit(value)) if expr is None else expr.when(cond, F.lit(value))
    return expr


def _no_data(_=None) -> Column:
    return F.col("n_rows") == 0


def _aliased(cols: dict[str, Column]) -> list[Column]:
    """The columns of a single check's own result (its numbers stand beside the message, not in details)."""
    return [c.alias(name) for name, c in cols.items() if name != "details"]


def _gaps_cols() -> dict[str, Column]:
    nd = _no_data(None)
    status = _status(
        (nd, STATUS_FAIL),
        (F.col("n_missing") == 0, STATUS_PASS),
        (F.col("longest_gap") > 3, STATUS_FAIL),
        (F.lit(True), STATUS_WARN),
    )
    message = (
        F.when(nd, F.format_string(MSG_NO_DATA, F.col("symbol")))
        .when(F.col("n_missing") == 0, F.format_string(MSG_NO_GAPS, F.col("n_days")))
        .otherwise(F.format_string(MSG_GAPS, F.col("n_missing"), F.col("longest_gap")))
    )
    details = F.when(F.col("n_missing") > 0, F.to_json(F.struct("missing_dates")))
    return {"status": status, "message": message, "details": details}


def _sanity_parts() -> list[tuple[str, str]]:
    return [
        ("n_negative", MSG_NEGATIVE),
        ("n_high_low", MSG_HIGH_LOW),
        ("n_zero_close", MSG_ZERO_CLOSE),
        ("n_negative_volume", MSG_NEGATIVE_VOLUME),
    ]


def _ohlc_parts() -> list[tuple[str, str]]:
    return [
        ("n_flat", MSG_FLAT),
        ("n_zero_vol_move", MSG_ZERO_VOLUME_MOVE),
    ]


def _issues(parts) -> tuple[Column, Column]:
    texts = [F.when(F.col(c) > 0, F.format_string(fmt, F.col(c))) for c, fmt in parts]
    count = sum((F.col(c) > 0).cast("int") for c, _ in parts)
    return F.concat_ws(ISSUE_SEPARATOR, *texts), count


def _sanity_cols() -> dict[str, Column]:
    msg, count = _issues(_sanity_parts())
    status = F.when(count > 0, F.lit(STATUS_FAIL)).otherwise(F.lit(STATUS_PASS))
    message = F.when(count > 0, msg).otherwise(F.lit(MSG_SANITY_OK))
    details = F.when(count > 0, F.to_json(F.struct(count.alias("issue_count"))))
    return {"status": status, "message": message, "issue_count": count, "details": details}


def _ohlc_cols() -> dict[str, Column]:
    msg, count = _issues(_ohlc_parts())
    status = F.when(count > 0, F.lit(STATUS_WARN)).otherwise(F.lit(STATUS_PASS))
    message = F.when(count > 0, msg).otherwise(F.lit(MSG_OHLC_OK))
    return {"status": status, "message": message, "details": F.lit(None).cast("string")}


def _days_behind(as_of) -> Column:
    return trading_days_between(F.col("latest_date"), last_trading_day(as_of)) - 1


def _stale_cols(as_of) -> dict[str, Column]:
    nd = _no_data(None)
    db = _days_behind(as_of)
    latest = F.col("latest_date").cast("string")
    status = _status((nd, STATUS_FAIL), (db <= 1, STATUS_PASS), (db <= 5, STATUS_WARN), (F.lit(True), STATUS_FAIL))
    message = (
        F.when(nd, F.format_string(MSG_NO_DATA, F.col("symbol")))
        .when(db <= 1, F.format_string(MSG_CURRENT, latest))
        .otherwise(F.format_string(MSG_BEHIND, db, latest))
    )
    details = F.when(~nd, F.to_json(F.struct(F.col("latest_date"), db.alias("days_behind"))))
    return {"status": status, "message": message, "days_behind": F.when(~nd, db), "details": details}


def _as_of(as_of) -> Column:
    if as_of is None:
        return F.current_date()
    return date_lit(as_of)


def check_gaps(bars: DataFrame, symbols=None, profile: DataFrame | None = None) -> DataFrame:
    p = profile if profile is not None else symbol_profile(bars, symbols)
    return p.select(
        "symbol", F.lit("trading_day_gaps").alias("check_name"), *_aliased(_gaps_cols()),
        "n_missing", "longest_gap", "n_days", "missing_dates",
    )


def check_price_sanity(bars: DataFrame, symbols=None, profile: DataFrame | None = None) -> DataFrame:
    p = profile if profile is not None else symbol_profile(bars, symbols)
    return p.select(
        "symbol", F.lit("price_sanity").alias("check_name"), *_aliased(_sanity_cols()),
        *[c for c, _ in _sanity_parts()],
    )


def check_stale(bars: DataFrame, as_of=None, symbols=None, profile: DataFrame | None = None) -> DataFrame:
    """``as_of`` defaults to today; pass a date (or Column) for reproducible runs."""
    p = profile if profile is not None else symbol_profile(bars, symbols)
    return p.select(
        "symbol", F.lit("stale_data").alias("check_name"), *_aliased(_stale_cols(_as_of(as_of))), "latest_date",
        _as_of(as_of).alias("as_of"),
    )


def check_ohlc_consistency(bars: DataFrame, symbols=None, profile: DataFrame | None = None) -> DataFrame:
    p = profile if profile is not None else symbol_profile(bars, symbols)
    return p.select(
        "symbol", F.lit("ohlc_consistency").alias("check_name"), *_aliased(_ohlc_cols()),
        *[c for c, _ in _ohlc_parts()],
    )


#: The checks in the order they are reported; pass a longer or shorter
#: sequence to ``run_checks`` to add, drop or reorder checks.
DEFAULT_CHECKS: tuple[Check, ...] = (
    Check(CHECK_ORDER[0], lambda as_of: _gaps_cols()),
    Check(CHECK_ORDER[1], lambda as_of: _sanity_cols()),
    Check(CHECK_ORDER[2], _stale_cols),
    Check(CHECK_ORDER[3], lambda as_of: _ohlc_cols()),
)


def run_checks(
    bars: DataFrame,
    symbols=None,
    as_of=None,
    profile: DataFrame | None = None,
    checks: Sequence[Check] = DEFAULT_CHECKS,
    shown: int | None = SHOWN,
) -> DataFrame:
    """(symbol, pos, check_name, status, message, details): the checks in
    order, produced from one profile row per symbol (no union of passes).
    A ``profile`` that is given must hold what the checks bring.

    ``details`` is JSON text or NULL: the first ``shown`` missing dates of the
    gap check, the number of kinds of issues of the sanity check, and the
    latest date and days behind of the stale check.
    """
    p = profile if profile is not None else symbol_profile(bars, symbols, shown, checks)
    as_of = _as_of(as_of)

    def row(pos: int, name: str, cols: dict[str, Column]) -> Column:
        return F.struct(
            F.lit(pos).alias("pos"), F.lit(name).alias("check_name"),
            *[cols.get(c, F.lit(None)).cast("string").alias(c) for c in ("status", "message", "details")],
        )

    rows = F.array(*[row(i, check.name, check.columns(as_of)) for i, check in enumerate(_as_checks(checks), 1)])
    return p.select("symbol", F.explode(rows).alias("r")).select("symbol", "r.*")


def validation_summary(bars: DataFrame, symbols=None, as_of=None, checks: DataFrame | None = None) -> DataFrame:
    """Per symbol: worst status, passed/total and the non-passing check names
    in check order ("-" when none)."""
    c = checks if checks is not None else run_checks(bars, symbols, as_of)
    rank = F.array_position(F.array(*[F.lit(s) for s in STATUS_ORDER]), F.col("status"))
    return c.groupBy("symbol").agg(
        F.element_at(F.array(*[F.lit(s) for s in STATUS_ORDER]), F.max(rank).cast("int")).alias("status"),
        F.count_if(F.col("status") == STATUS_PASS).alias("passed"),
        F.count(F.lit(1)).alias("total"),
        F.coalesce(
            F.nullif(
                F.array_join(
                    F.transform(
                        F.array_sort(F.collect_list(F.when(F.col("status") != STATUS_PASS, F.struct("pos", "check_name")))),
                        lambda s: s["check_name"],
                    ),
                    SUMMARY_SEPARATOR,
                ),
                F.lit(""),
            ),
            F.lit("-"),
        ).alias("issues"),
    )


def missing_days(bars: DataFrame, symbols=None) -> DataFrame:
    """Expected weekdays between each symbol's first and last date minus the
    dates present (over all sources): a calendar left-anti join."""
    from barlake.functions.calendar_frames import trading_calendar

    per_day = daily_profile(bars, symbols).select("symbol", "date")
    bounds = per_day.groupBy("symbol").agg(F.min("date").alias("start"), F.max("date").alias("end"))
    cal = trading_calendar(bounds, "start", "end").select("symbol", "date")
    return cal.join(per_day, ["symbol", "date"], "left_anti")
