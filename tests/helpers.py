"""Small frame builders for hand-made edge cases."""

from datetime import datetime, timezone


from candlewick import schemas


def ts(text: str) -> datetime:
    return datetime.fromisoformat(text).replace(tzinfo=timezone.utc)


def trades(spark, rows):
    """rows: (iso time, symbol, side, price, qty, trade_id)."""
    data = [
        {
            "timestamp": ts(t),
            "receipt_ts": ts(t),
            "exchange": "X",
            "symbol": sym,
            "side": side,
            "price": float(px),
            "quantity": float(q),
            "notional": float(px) * float(q),
            "trade_id": tid,
        }
        for t, sym, side, px, q, tid in rows
    ]
    return spark.createDataFrame(data, schemas.RAW_TRADES)


def empty(spark, schema):
    return spark.createDataFrame([], schema)


def raw_with_trades(spark, trade_df):
    return {
        "trades": trade_df,
        "book": empty(spark, schemas.RAW_BOOK_TOPK),
        "open_interest": empty(spark, schemas.RAW_OPEN_INTEREST),
        "funding": empty(spark, schemas.RAW_FUNDING),
        "liquidations": empty(spark, schemas.RAW_LIQUIDATIONS),
    }


def bars_from_closes(spark, closes, start="2026-03-02T00:00:00", interval=60, symbol="S", **extra):
    """Dense synthetic bar series with the given closes (all other columns neutral)."""
    base = ts(start)
    rows = []
    for i, c in enumerate(closes):
        row = {f.name: None for f in schemas.BARS.fields}
        row.update(
            exchange="X", symbol=symbol, bar_interval_sec=interval,
            bar_time=datetime.fromtimestamp(base.timestamp() + i * interval, tz=timezone.utc),
            open=float(c), high=float(c) * 1.001, low=float(c) * 0.999, close=float(c),
            volume=10.0 + (i % 7), turnover=(10.0 + (i % 7)) * c, trade_count=3, buy_volume=5.0, sell_volume=5.0 + (i % 7),
            buy_turnover=5.0 * c, sell_turnover=(5.0 + (i % 7)) * c, signed_sqrt_dollar_volume=float((i % 5) - 2),
            vwap=float(c), large_trade_count=0, large_trade_volume=0.0, ob_snapshot_count=i % 3,
            is_time_bar_complete=1, has_book_data=1 if i % 3 else 0, has_open_interest_data=i % 2,
            has_funding_data=1 if i % 4 == 0 else 0,
            open_interest_open=1000.0 + i, open_interest_close=1000.0 + i * 1.5,
            funding_rate=0.0001 * i if i % 4 == 0 else None,
            liq_buy_volume=float(i % 2), liq_sell_volume=float(i % 3), liq_buy_turnover=0.0, liq_sell_turnover=0.0,
            liq_count=i % 4, first_trade_ts=base, last_trade_ts=base, max_trade_gap_ms=0,
        )
        for m in schemas.BOOK_MEAN_COLUMNS:
            row[m] = 1.0 + (i % 5)
        row.update(extra)
        rows.append(row)
    return spark.createDataFrame(rows, schemas.BARS)


def collect_sorted(df, *keys):
    return [r.asDict() for r in df.orderBy(*keys).collect()]
