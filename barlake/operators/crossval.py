"""Cross-validation of sources against each other.

All symbols and all source pairs are evaluated in one plan: one scan with
``source IN (...)``, which is first reduced to *cells*, the distinct copies
of a bar with their number, clustered by (symbol, date). The pair join and
the date sets read the same exchange of cells. Source positions come from
the requested list (an array literal), so no side table is joined, and the
list may have any length: the sources of a date are a sorted array of
positions, dates with the same array are counted before pairs are made, and
only pairs of sources that share a date are. N equal copies never become N x N
joined rows, and N different ones are joined in blocks.

    xval_coverage  rows / first / last date per (symbol, requested source)
    xval_diffs     per-date % differences for every ordered source pair
    xval_pairs     pair summary: date-set sizes, max/avg diffs, exceed count
    xval_matrix    per-symbol rows per source, overlap %, max close diff %
    dates_common / dates_only / dates_union   intersection, differences, union
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barlake.functions.numeric import nan_to_null, pct_diff
from barlake.operators._common import (
    restrict_dates,
    restrict_symbols,
    source_list,
    symbols_frame,
)
from barlake.schema import NO_ADJUSTED_CLOSE_SOURCES, PRICE_COLUMNS


def _require_two(sources) -> list[str]:
    sources = source_list(sources)
    if len(sources) < 2:
        raise ValueError("Need at least 2 sources to compare")
    return sources


def _scoped(bars: DataFrame, sources, symbols=None, start=None, end=None, cols=PRICE_COLUMNS, others=False) -> DataFrame:
    """Requested sources/symbols/dates with ``pos`` = 1-based list position
    (0: another source, kept only with ``others``)."""
    b = bars if others else bars.filter(F.col("source").isin(sources))
    b = restrict_dates(restrict_symbols(b, symbols), start, end)
    pos = F.array_position(F.array(*[F.lit(s) for s in sources]), F.col("source")).cast("int")
    scoped = b.select("symbol", "source", "date", *cols).withColumn("pos", pos)
    # What a join would infer for its sides; stated here, so that joined and unjoined uses are one plan.
    return scoped.filter("symbol IS NOT NULL AND date IS NOT NULL AND pos IS NOT NULL")


def _cells(scoped: DataFrame, cols=PRICE_COLUMNS) -> DataFrame:
    """Distinct copies of a bar and their number ``w`` (a partial aggregate,
    so a hot group of copies is combined map-side). The filter is always true;
    it keeps ``w`` in every consumer, so that all of them share one exchange."""
    return scoped.groupBy("symbol", "date", "source", "pos", *cols).agg(F.count(F.lit(1)).alias("w")).filter("w > 0")


def _dates(cells: DataFrame) -> DataFrame:
    """(symbol, date, m, copies): the sorted source positions of a date, and its number of cells.
    The filter is always true; it keeps both in every consumer, as in ``_cells``."""
    dates = cells.groupBy("symbol", "date").agg(F.sort_array(F.collect_set("pos")).alias("m"), F.count(F.lit(1)).alias("copies"))
    return dates.filter("copies > 0 AND size(m) > 0")


def _pairs_of(items: str, first: int) -> str:
    """SQL: the pairs (x, y) of a sorted array's elements, y from ``first`` places after x."""
    return (
        f"flatten(transform({items}, (x, i) -> transform(slice({items}, i + 1 + {first}, greatest(size({items}) - i - {first}, 0)), "
        "y -> struct(x, y))))"
    )


def _date_sets(dates: DataFrame, sources: list[str]) -> DataFrame:
    """(symbol, pos_a, pos_b, src_a, src_b, common_dates, only_a, only_b) of
    the pairs of sources that both have rows of the symbol.

    Dates with the same sources are counted first; a group of them makes only
    the pairs of its own sources (each with itself too: its number of dates).
    What a source has alone is its dates less the common ones.
    """
    groups = dates.groupBy("symbol", "m").agg(F.count(F.lit(1)).alias("n"))
    met = groups.select("symbol", "n", F.explode(F.expr(_pairs_of("m", 0))).alias("p"))
    met = met.groupBy("symbol", F.col("p.x").alias("pos_a"), F.col("p.y").alias("pos_b")).agg(F.sum("n").alias("common")).filter("common > 0")
    own = met.filter("pos_a = pos_b").groupBy("symbol").agg(F.array_sort(F.collect_list(F.struct(F.col("pos_a").alias("pos"), F.col("common").alias("n")))).alias("own"))
    pairs = own.select("symbol", F.explode(F.expr(_pairs_of("own", 1))).alias("p")).select(
        "symbol", F.col("p.x.pos").alias("pos_a"), F.col("p.y.pos").alias("pos_b"), F.col("p.x.n").alias("n_a"), F.col("p.y.n").alias("n_b")
    )
    name = lambda pos: F.element_at(F.array(*[F.lit(s) for s in sources]), F.col(pos))
    common = F.coalesce("common", F.lit(0).cast("bigint"))
    return pairs.join(met, ["symbol", "pos_a", "pos_b"], "left").select(
        "symbol", "pos_a", "pos_b", name("pos_a").alias("src_a"), name("pos_b").alias("src_b"),
        common.alias("common_dates"), (F.col("n_a") - common).alias("only_a"), (F.col("n_b") - common).alias("only_b"),
    )


def xval_coverage(bars: DataFrame, sources, symbols=None, start=None, end=None) -> DataFrame:
    """Rows, first and last date per (symbol, source), sources in list order.

    A requested source without rows reports 0 rows and NULL dates.
    """
    sources = _require_two(sources)
    scoped = _scoped(bars, sources, symbols, start, end, cols=[])
    agg = scoped.groupBy("symbol", "source").agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("date").alias("min_date"),
        F.max("date").alias("max_date"),
    )
    grid = symbols_frame(bars, symbols).select(
        "symbol", F.posexplode(F.array(*[F.lit(s) for s in sources])).alias("pos0", "source")
    )
    return (
        grid.join(agg, ["symbol", "source"], "left")
        .select(
            "symbol",
            (F.col("pos0") + 1).alias("source_pos"),
            "source",
            F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows"),
            "min_date",
            "max_date",
        )
    )


#: Cells of one (symbol, date) that are joined as one unit. More are cut into blocks of about this size.
BLOCK_CELLS = 256


def _units(cells: DataFrame, dates: DataFrame) -> DataFrame:
    """cells with the unit of work (u, v) in which they meet others, and their block.

    A date of very many cells is cut into blocks by the cells' hash, and each
    pair of blocks u <= v is a unit of its own, so that the pairs of copies
    of one date spread over tasks. Other dates are one block.
    """
    large = dates.filter(F.col("copies") > BLOCK_CELLS).select("symbol", "date", F.ceil(F.col("copies") / BLOCK_CELLS).cast("int").alias("blocks"))
    marked = cells.join(large, ["symbol", "date"], "left")
    marked = marked.withColumn("block", F.coalesce(F.pmod(F.xxhash64("pos", *PRICE_COLUMNS), F.col("blocks")).cast("int"), F.lit(0)))
    other = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("blocks"), F.lit(1)) - 1))
    marked = marked.withColumn("other", other)
    return marked.withColumn("u", F.least("block", "other")).withColumn("v", F.greatest("block", "other")).drop("blocks", "other")


def _side(units: DataFrame, tag: str) -> DataFrame:
    keys = ["symbol", "date", "u", "v"]
    return units.select(*keys, *[F.col(c).alias(f"{c}_{tag}") for c in units.columns if c not in keys])


def xval_diffs(bars: DataFrame, sources, tolerance: float = 1.0, symbols=None, start=None, end=None) -> DataFrame:
    """Per (symbol, date) and ordered pair (a before b in the list):
    ``d_<col> = |a - b| / a * 100`` and ``exceeds`` (any d > tolerance).

    This is the inner equi-join on (symbol, date) in which duplicate dates
    fan out -- but identical copies are joined once: ``weight`` is the number
    of joined rows a result row stands for (1 without duplicates), so a
    group of N copies costs one row instead of N x N. Dates of many different
    copies are joined in blocks (``_units``).
    """
    sources = _require_two(sources)
    cells = _cells(_scoped(bars, sources, symbols, start, end))
    return _diffs(_units(cells, _dates(cells)), tolerance)


def _diffs(units: DataFrame, tolerance: float) -> DataFrame:
    met = F.expr("pos_a < pos_b AND (u = v OR block_a <> block_b)")
    j = _side(units, "a").join(_side(units, "b"), ["symbol", "date", "u", "v"], "inner").filter(met)
    diffs = [pct_diff(F.col(f"{c}_a"), F.col(f"{c}_b")).alias(f"d_{c}") for c in PRICE_COLUMNS]
    out = j.select(
        "symbol", F.col("source_a").alias("src_a"), F.col("source_b").alias("src_b"), "pos_a", "pos_b", "date", *diffs,
        (F.col("w_a") * F.col("w_b")).alias("weight"),
    )
    over = [F.col(f"d_{c}") > F.lit(float(tolerance)) for c in PRICE_COLUMNS]
    return out.withColumn("exceeds", functools.reduce(operator.or_, over))


def xval_pairs(bars: DataFrame, sources, tolerance: float = 1.0, symbols=None, start=None, end=None) -> DataFrame:
    """Pair summary per (symbol, src_a, src_b), pairs in list order.

    common/only_a/only_b count distinct dates; the max/avg diffs and
    ``n_exceed`` are over the joined rows (weighted, so copies count as the
    join would count them; NaN skipped by max, kept by avg). Pairs where
    either side has no rows for the symbol are skipped. ``adj_skipped``
    flags pairs involving a source without adjusted close.
    """
    sources = _require_two(sources)
    cells = _cells(_scoped(bars, sources, symbols, start, end))
    dates = _dates(cells)
    d = _diffs(_units(cells, dates), tolerance)
    w = F.col("weight")
    aggs = []
    for c in PRICE_COLUMNS:
        x = F.col(f"d_{c}")
        aggs.append(F.max(nan_to_null(x)).alias(f"max_{c}_diff"))
        # avg over joined rows = weighted mean over distinct pairs (NULLs skipped, NaN kept)
        aggs.append((F.sum(x * w) / F.sum(F.when(x.isNotNull(), w))).alias(f"avg_{c}_diff"))
    aggs += [F.sum(F.when(F.col("exceeds"), w)).alias("n_exceed"), F.sum(w).alias("joined_rows")]
    stats = d.groupBy("symbol", "pos_a", "pos_b").agg(*aggs)
    no_adj = F.col("src_a").isin(NO_ADJUSTED_CLOSE_SOURCES) | F.col("src_b").isin(NO_ADJUSTED_CLOSE_SOURCES)
    out = _date_sets(dates, sources).join(stats, ["symbol", "pos_a", "pos_b"], "left")
    return out.select(
        "symbol",
        "src_a",
        "src_b",
        "pos_a",
        "pos_b",
        "common_dates",
        "only_a",
        "only_b",
        *[F.col(f"{k}_{c}_diff") for c in PRICE_COLUMNS for k in ("max", "avg")],
        F.coalesce("n_exceed", F.lit(0)).cast("bigint").alias("n_exceed"),
        F.coalesce("joined_rows", F.lit(0)).cast("bigint").alias("joined_rows"),
        no_adj.alias("adj_skipped"),
        F.lit(float(tolerance)).alias("tolerance"),
    )


def xval_matrix(bars: DataFrame, sources, symbols=None) -> DataFrame:
    """Per symbol: plain row count per source (``rows_<source>``), and for the
    first two sources the date overlap % (common / union * 100 of distinct
    dates) and the max close diff %. Both are NULL if either source has no
    rows; the diff is NULL without common dates.
    """
    sources = _require_two(sources)
    # Without a symbol list every symbol is reported, those of other sources with 0 rows: they are
    # kept in the one scan, not looked up by another.
    s = _scoped(bars, sources, symbols, None, None, cols=["close"], others=symbols is None)
    # Distinct closes with their numbers, combined before the shuffle. Other sources only count: theirs are one cell without a date.
    met = F.col("pos").isin(1, 2)
    cells = s.groupBy("symbol", F.when(met, F.col("date")).alias("date"), "pos", F.when(met, F.col("close")).alias("close")).agg(F.count(F.lit(1)).alias("w"))
    # |a - b| / a * 100 is greatest at the b farthest from a > 0 (or 0) and at the nearest to a < 0, where it is
    # negative: the least and greatest b of the date, and the neighbours of a in order, are all it takes. One order
    # serves all of a date's windows, and its first cell counts for the date, so that cells are sorted once and
    # no table of dates is held beside them.
    b = F.when((F.col("pos") == 2) & ~F.isnan("close"), F.col("close"))
    order = Window.partitionBy("symbol", "date").orderBy("close", "pos")
    date = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    found = cells.withColumn("b", b).select(
        "symbol", "pos", "close", "w",
        F.min("b").over(date).alias("low"), F.max("b").over(date).alias("high"),
        F.expr("lag(b) IGNORE NULLS").over(order).alias("before"), F.expr("lead(b) IGNORE NULLS").over(order).alias("after"),
        F.row_number().over(order).alias("nth"), *[F.bool_or(F.col("pos") == i).over(date).alias(f"has{i}") for i in (1, 2)],
    )
    diffs = [nan_to_null(pct_diff(F.col("close"), F.col(c))) for c in ("low", "high", "before", "after")]
    diff = F.when(F.col("pos") == 1, F.greatest(*diffs))
    per_symbol = found.groupBy("symbol").agg(
        *[F.sum(F.when(F.col("pos") == i + 1, F.col("w")).otherwise(F.lit(0))).alias(f"rows_{src}") for i, src in enumerate(sources)],
        F.count_if(F.expr("nth = 1 AND has1 AND has2")).alias("_common"),
        F.count_if(F.expr("nth = 1 AND (has1 OR has2)")).alias("_union"),
        F.max(diff).alias("max_close_diff_pct"),
    )
    first, second = f"rows_{sources[0]}", f"rows_{sources[1]}"
    both = (F.col(first) > 0) & (F.col(second) > 0)
    out = per_symbol if symbols is None else symbols_frame(bars, symbols).join(per_symbol, "symbol", "left")
    both = F.coalesce(both, F.lit(False))
    return out.select(
        "symbol",
        *[F.coalesce(F.col(f"rows_{src}"), F.lit(0)).cast("bigint").alias(f"rows_{src}") for src in sources],
        F.when(both, F.col("_common") / F.col("_union") * 100.0).alias("overlap_pct"),
        F.when(both, F.col("max_close_diff_pct")).alias("max_close_diff_pct"),
    )


def _in_sources(bars: DataFrame, src_a: str, src_b: str, symbols=None, start=None, end=None) -> DataFrame:
    """(symbol, date, in_a, in_b) over the rows of two sources."""
    s = _scoped(bars, [src_a, src_b], symbols, start, end, cols=[])
    return s.groupBy("symbol", "date").agg(
        F.bool_or(F.col("source") == src_a).alias("in_a"), F.bool_or(F.col("source") == src_b).alias("in_b")
    )


def dates_common(bars: DataFrame, src_a: str, src_b: str, symbols=None, start=None, end=None) -> DataFrame:
    """(symbol, date) present in both sources: the date-set intersection."""
    return _in_sources(bars, src_a, src_b, symbols, start, end).filter("in_a AND in_b").select("symbol", "date")


def dates_only(bars: DataFrame, src_a: str, src_b: str, symbols=None, start=None, end=None) -> DataFrame:
    """(symbol, date, only_in) for dates in exactly one of the two sources:
    both set differences, labelled with the source that has the date."""
    d = _in_sources(bars, src_a, src_b, symbols, start, end).filter("in_a <> in_b")
    return d.select("symbol", "date", F.when(F.col("in_a"), F.lit(src_a)).otherwise(F.lit(src_b)).alias("only_in"))


def dates_union(bars: DataFrame, src_a: str, src_b: str, symbols=None, start=None, end=None) -> DataFrame:
    """(symbol, date) present in either source: the date-set union."""
    return _in_sources(bars, src_a, src_b, symbols, start, end).select("symbol", "date")
