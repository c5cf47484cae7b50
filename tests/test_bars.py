import pytest
from pyspark.sql import functions as F

from candlewick.operators import bars as B

from candlewick import schemas

from helpers import collect_sorted, raw_with_trades, trades, ts


def _t(spark):
    return trades(
        spark,
        [
            ("2026-03-02T00:01:10.000900", "A", "buy", 100, 1, "1"),
            ("2026-03-02T00:01:10.001100", "A", "sell", 101, 2, "2"),  # crosses a ms boundary: gap 1
            ("2026-03-02T00:01:40", "A", "buy", 99, 1, "3"),
            ("2026-03-02T00:01:40", "A", "sell", 98, 1, "4"),  # tie on time: trade_id decides
            ("2026-03-02T00:04:05", "A", "buy", 105, 1, "5"),
            ("2026-03-02T00:02:30", "B", "buy", 50, 1, "6"),  # single-trade symbol
        ],
    )


def test_trade_bars_ohlc_gap_and_ties(spark):
    rows = collect_sorted(B.trade_bars(_t(spark), 60), "symbol", "bar_time")
    a1 = rows[0]
    assert a1["open"] == 100.0 and a1["close"] == 98.0  # tie broken by trade_id '4' > '3'
    assert a1["high"] == 101.0 and a1["low"] == 98.0
    assert a1["trade_count"] == 4 and a1["volume"] == 5.0
    assert a1["buy_volume"] == 2.0 and a1["sell_volume"] == 3.0
    assert a1["max_trade_gap_ms"] == 30000 - 1  # 10.0011 → 40.000: 40000 - 10001
    assert abs(a1["vwap"] - a1["turnover"] / a1["volume"]) < 1e-12
    b = [r for r in rows if r["symbol"] == "B"][0]
    assert b["max_trade_gap_ms"] == 0 and b["open"] == b["close"] == 50.0


def test_ms_boundary_gap_is_one(spark):
    t = trades(spark, [("2026-03-02T00:00:00.000900", "A", "buy", 1, 1, "1"), ("2026-03-02T00:00:00.001100", "A", "buy", 1, 1, "2")])
    assert B.trade_bars(t, 60).first()["max_trade_gap_ms"] == 1


def test_gap_across_seconds_matches_lag(spark):
    g = B.trade_gaps(_t(spark), 60).filter(F.col("symbol") == "A").orderBy("timestamp", "trade_id").collect()
    assert [r["gap_ms"] for r in g] == [0, 1, 29999, 0, 0]


def test_grid_five_bars_and_leading_bars_dropped(spark):
    raw = raw_with_trades(spark, _t(spark))
    out = B.time_bars(raw, 60, "2026-03-02T00:00:00Z", "2026-03-02T00:05:00Z")
    a = collect_sorted(out.filter(F.col("symbol") == "A"), "bar_time")
    # 00:00 has no trade and no earlier close → dropped; 00:01..00:04 kept
    assert [r["bar_time"].minute for r in a] == [1, 2, 3, 4]
    quiet = a[1]
    assert quiet["trade_count"] == 0 and quiet["open"] == quiet["close"] == 98.0 and quiet["vwap"] == 98.0
    assert quiet["is_time_bar_complete"] == 1 and quiet["volume"] == 0.0
    assert quiet["first_trade_ts"] == quiet["bar_time"]
    b = collect_sorted(out.filter(F.col("symbol") == "B"), "bar_time")
    assert [r["bar_time"].minute for r in b] == [2, 3, 4]
    assert all(r["has_book_data"] == 0 and r["has_open_interest_data"] == 0 for r in a + b)


def test_forward_fill_crosses_chunks(spark):
    raw = raw_with_trades(spark, _t(spark))
    small = B.time_bars(raw, 60, "2026-03-02T00:00:00Z", "2026-03-02T00:10:00Z", chunk_bars=2)
    big = B.time_bars(raw, 60, "2026-03-02T00:00:00Z", "2026-03-02T00:10:00Z")
    assert small.exceptAll(big).count() == 0 and big.exceptAll(small).count() == 0
    assert small.count() == 9 + 8


def test_sparse_variant_only_trade_bars(spark):
    out = B.time_bars(raw_with_trades(spark, _t(spark)), 60)
    assert out.count() == 3  # A: 00:01, 00:04; B: 00:02 — quiet minutes are not generated
    assert out.filter("is_time_bar_complete = 1").count() == 3


def test_unsupported_interval(spark):
    with pytest.raises(ValueError, match="Unsupported interval"):
        B.trade_bars(_t(spark), 90)


def test_unaligned_grid_start_rejected(spark):
    with pytest.raises(ValueError, match="aligned"):
        B.time_bars(raw_with_trades(spark, _t(spark)), 60, "2026-03-02T00:00:30Z", "2026-03-02T00:05:00Z")


def test_gap_ties_only_first_of_timestamp_links(spark):
    t = trades(
        spark,
        [
            ("2026-03-02T00:00:01", "A", "buy", 1, 1, "b"),
            ("2026-03-02T00:00:05", "A", "buy", 1, 1, "d"),
            ("2026-03-02T00:00:05", "A", "buy", 1, 1, "c"),  # same time: 'c' sorts first
            ("2026-03-02T00:00:05", "A", "buy", 1, 1, "e"),
        ],
    )
    g = {r["trade_id"]: r["gap_ms"] for r in B.trade_gaps(t, 60).collect()}
    assert g == {"b": 0, "c": 4000, "d": 0, "e": 0}
    assert B.trade_bars(t, 60).first()["max_trade_gap_ms"] == 4000


def test_grid_with_seeds_chunks_and_an_open_last_bar(spark):
    t = trades(
        spark,
        [
            ("2026-03-02T00:03:10", "A", "buy", 100, 1, "1"),
            ("2026-03-02T00:09:20", "A", "buy", 120, 1, "2"),  # lies in the last bar, which the range cuts
        ],
    )
    seed = spark.createDataFrame([("X", "A", 90.0), ("X", "Q", 7.0)], "exchange string, symbol string, close double")
    row = {f.name: 1.0 for f in schemas.RAW_BOOK_TOPK.fields if f.dataType.simpleString() == "double"}
    row |= {f.name: [1.0] for f in schemas.RAW_BOOK_TOPK.fields if f.dataType.simpleString() == "array<double>"}
    row |= {"timestamp": ts("2026-03-02T00:01:30"), "receipt_ts": ts("2026-03-02T00:01:30"), "exchange": "X", "mid_price": 5.0}
    book = spark.createDataFrame([{**row, "symbol": s} for s in ("A", "N")], schemas.RAW_BOOK_TOPK)
    raw = {**raw_with_trades(spark, t), "book": book}
    for chunk_bars in (None, 2):
        out = collect_sorted(B.time_bars(raw, 60, "2026-03-02T00:00:00Z", "2026-03-02T00:09:30Z", chunk_bars=chunk_bars, seed=seed), "symbol", "bar_time")
        # N has a book but neither trade nor seed: no bars
        assert [(r["symbol"], r["bar_time"].minute) for r in out] == [(s, m) for s in "AQ" for m in range(9)]
        assert [r["close"] for r in out] == [90.0] * 3 + [100.0] * 6 + [7.0] * 9
        assert [r["has_book_data"] for r in out] == [0, 1] + [0] * 16
        assert out[1]["avg_mid_price"] == 5.0 and out[1]["avg_bid1_size"] == 1.0 and out[2]["avg_mid_price"] == 0.0
        assert [r["trade_count"] for r in out] == [0, 0, 0, 1] + [0] * 14


def test_bars_without_any_rows(spark):
    raw = raw_with_trades(spark, trades(spark, []))
    assert B.time_bars(raw, 60).count() == 0
    assert B.time_bars(raw, 60, "2026-03-02T00:00:00Z", "2026-03-02T00:05:00Z").count() == 0
    assert B.time_bars(raw_with_trades(spark, _t(spark)), 60, "2026-03-02T00:01:00Z", "2026-03-02T00:01:30Z").count() == 0
