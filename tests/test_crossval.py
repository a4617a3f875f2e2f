"""Cross-validation on hand-made frames."""

from __future__ import annotations

import datetime as dt
import math
import random

import pytest
from conftest import BAR_DDL, WEEK, bar, make_bars

from barlake.operators import crossval
from barlake.sources import store

D = [dt.date(2024, 1, d) for d in (2, 3, 4, 5, 8)]


def two_sources(spark):
    a = make_bars(spark, [bar(d, 100, 110, 90, 100) for d in D[:4]], source="yfinance")
    b = make_bars(spark, [bar(d, 101, 110, 90, 100) for d in D[1:]], source="stooq")
    return a.unionByName(b)


def test_pairs_counts_and_diffs(spark):
    r = crossval.xval_pairs(two_sources(spark), "yfinance, stooq", tolerance=0.5).collect()[0]
    assert (r.src_a, r.src_b, r.common_dates, r.only_a, r.only_b) == ("yfinance", "stooq", 3, 1, 1)
    assert math.isclose(r.max_open_diff, 1.0) and r.max_close_diff == 0.0
    assert r.n_exceed == 3 and r.adj_skipped is True


def test_pairs_skip_empty_side_and_need_two_sources(spark):
    df = two_sources(spark)
    assert crossval.xval_pairs(df, ["yfinance", "alpha_vantage"]).count() == 0
    try:
        crossval.xval_pairs(df, ["yfinance"])
    except ValueError:
        pass
    else:
        raise AssertionError


def test_nan_skipped_by_max_kept_by_avg(spark):
    a = make_bars(spark, [bar(D[0], 0, 1, 0, 1), bar(D[1], 10, 11, 9, 10)], source="x")
    b = make_bars(spark, [bar(D[0], 0, 1, 0, 1), bar(D[1], 11, 11, 9, 10)], source="y")
    r = crossval.xval_pairs(a.unionByName(b), ["x", "y"]).collect()[0]
    assert math.isclose(r.max_open_diff, 10.0) and math.isnan(r.avg_open_diff)


def test_duplicate_dates_fan_out(spark):
    a = make_bars(spark, [bar(D[0], 10, 10, 10, 10), bar(D[0], 10, 10, 10, 10)], source="x")
    b = make_bars(spark, [bar(D[0], 10, 10, 10, 10)], source="y")
    r = crossval.xval_pairs(a.unionByName(b), ["x", "y"]).collect()[0]
    assert (r.common_dates, r.joined_rows) == (1, 2)


def test_coverage_and_matrix(spark):
    df = two_sources(spark)
    cov = {(r.symbol, r.source): (r.source_pos, r.rows) for r in
           crossval.xval_coverage(df, ["stooq", "yfinance", "alpha_vantage"]).collect()}
    assert cov == {("QRS", "stooq"): (1, 4), ("QRS", "yfinance"): (2, 4), ("QRS", "alpha_vantage"): (3, 0)}
    m = crossval.xval_matrix(df, ["yfinance", "stooq"], ["QRS", "TUV"]).collect()
    got = {r.symbol: (r.rows_yfinance, r.rows_stooq, r.overlap_pct, r.max_close_diff_pct) for r in m}
    assert got == {"QRS": (4, 4, 60.0, 0.0), "TUV": (0, 0, None, None)}


def test_date_sets(spark):
    df = two_sources(spark)
    assert sorted(r.date for r in crossval.dates_common(df, "yfinance", "stooq").collect()) == D[1:4]
    only = {(r.date, r.only_in) for r in crossval.dates_only(df, "yfinance", "stooq").collect()}
    assert only == {(D[0], "yfinance"), (D[4], "stooq")}


def test_copies_are_weighted_not_fanned_out(spark):
    # 30 identical copies on each side: the join would emit 900 rows.
    a = make_bars(spark, [bar(D[0], 10, 10, 10, 10)] * 30 + [bar(D[1], 10, 10, 10, 10)], source="x")
    b = make_bars(spark, [bar(D[0], 12, 10, 10, 10)] * 30 + [bar(D[1], 10, 10, 10, 10)], source="y")
    df = a.unionByName(b)
    d = crossval.xval_diffs(df, ["x", "y"], tolerance=1.0).collect()
    assert sorted((r.date.day, r.weight) for r in d) == [(2, 900), (3, 1)]
    r = crossval.xval_pairs(df, ["x", "y"], tolerance=1.0).collect()[0]
    assert (r.joined_rows, r.n_exceed) == (901, 900)
    assert math.isclose(r.avg_open_diff, 20.0 * 900 / 901)


@pytest.mark.parametrize("k", [31, 32, 33, 64])
def test_any_number_of_sources(spark, k):
    # Source i has the first day and, if i is even, the second.
    names = [f"f{i}" for i in range(k)]
    rows = [(d, 10.0 + i, 10.0, 10.0, 10.0, 10.0, 1, n, None, "QRS") for i, n in enumerate(names) for d in D[: 2 - i % 2]]
    bars = spark.createDataFrame(rows, BAR_DDL)
    pairs = crossval.xval_pairs(bars, names).collect()
    assert len(pairs) == k * (k - 1) // 2
    for r in pairs:
        a, b = r.pos_a % 2, r.pos_b % 2  # odd positions are even indices
        assert (r.common_dates, r.only_a, r.only_b) == (1 + (a and b), a and not b, b and not a)
    (m,) = crossval.xval_matrix(bars, names).collect()
    assert (m.overlap_pct, m[f"rows_{names[-1]}"]) == (50.0, 2 - (k - 1) % 2)
    assert math.isclose(m.max_close_diff_pct, 0.0)


def test_symbols_are_upper_cased_everywhere(spark):
    df = two_sources(spark)
    for symbols in ("qrs", " qrs , none", ["qrs"]):
        assert [r.symbol for r in crossval.xval_pairs(df, "yfinance, stooq", symbols=symbols).collect()] == ["QRS"]
        assert crossval.xval_diffs(df, "yfinance, stooq", symbols=symbols).count() == 3
        assert {r.symbol for r in crossval.xval_coverage(df, "yfinance, stooq", symbols=symbols).collect()} >= {"QRS"}
        assert {r.symbol for r in crossval.xval_matrix(df, "yfinance, stooq", symbols).collect()} >= {"QRS"}
        assert crossval.dates_union(df, "yfinance", "stooq", symbols).count() == 5


@pytest.mark.parametrize("name", ["xval_pairs", "xval_matrix"])
def test_bars_are_scanned_once(spark, tiers, name):
    store.write_bars(two_sources(spark), tiers.store)
    df = getattr(crossval, name)(store.read_store(spark, tiers.store), "yfinance, stooq", symbols="qrs")
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet") == 1, final
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet") == 1, final


def test_the_matrix_sorts_its_cells_once(spark):
    others = make_bars(spark, WEEK, source="other").union(make_bars(spark, WEEK, source="third"))
    df = crossval.xval_matrix(two_sources(spark).union(others), "yfinance, stooq, third")
    (row,) = df.collect()
    assert (row.rows_yfinance, row.rows_stooq, row.rows_third, row.overlap_pct, row.max_close_diff_pct) == (4, 4, 5, 60.0, 0.0)
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("Sort [") == final.count("Window [") == 1, final
    # No table of dates: the cells and the symbols are all that is aggregated.
    assert {k.split("]")[0].count(",") for k in final.split("HashAggregate(keys=[")[1:]} == {0, 3}, final


def test_a_source_named_twice_counts_once(spark):
    bars = make_bars(spark, WEEK, source="p").union(make_bars(spark, WEEK[:3], source="q"))
    got = crossval.xval_matrix(bars, "p, q,p").first()
    assert (got.rows_p, got.rows_q) == (5, 3) and "rows_p" in got.asDict()
    assert crossval.xval_pairs(bars, ["p", "q", "p"]).count() == 1
    with pytest.raises(ValueError, match="at least 2"):
        crossval.xval_matrix(bars, "p,p")


def test_pairs_of_many_sources_match_sets(spark):
    rnd = random.Random(3)
    dates = {f"s{k}": {dt.date(2021, 1, 1) + dt.timedelta(days=rnd.randrange(40)) for _ in range(rnd.randrange(0, 25))} for k in range(9)}
    bars = make_bars(spark, [], source="s0")
    for source, own in dates.items():
        bars = bars.union(make_bars(spark, [bar(d) for d in sorted(own)], source=source))
    got = {(r.src_a, r.src_b): (r.common_dates, r.only_a, r.only_b) for r in crossval.xval_pairs(bars, list(dates)).collect()}
    names = list(dates)
    want = {
        (a, b): (len(dates[a] & dates[b]), len(dates[a] - dates[b]), len(dates[b] - dates[a]))
        for i, a in enumerate(names) for b in names[i + 1:] if dates[a] and dates[b]
    }
    assert got == want


def test_blocks_meet_every_pair_once(spark, monkeypatch):
    monkeypatch.setattr(crossval, "BLOCK_CELLS", 4)
    rnd = random.Random(4)
    sides = {s: [bar("2021-06-07", round(rnd.uniform(5, 50), 2), v=k) for k in range(n)] for s, n in (("p", 30), ("q", 41))}
    sides["p"] += sides["p"][:7]  # equal copies
    bars = make_bars(spark, sides["p"], source="p").union(make_bars(spark, sides["q"], source="q"))
    (got,) = crossval.xval_pairs(bars, "p,q", tolerance=60.0).collect()
    diffs = [abs(a[1] - b[1]) / a[1] * 100 for a in sides["p"] for b in sides["q"]]
    assert got.joined_rows == 37 * 41 and got.n_exceed == sum(d > 60 for d in diffs)
    assert abs(got.avg_open_diff - sum(diffs) / len(diffs)) < 1e-9 and abs(got.max_open_diff - max(diffs)) < 1e-9
    units = crossval._units(*(lambda c: (c, crossval._dates(c)))(crossval._cells(crossval._scoped(bars, ["p", "q"]))))
    sizes = [r["count"] for r in units.groupBy("u", "v").count().collect()]
    assert len(sizes) > 100 and max(sizes) <= 30
