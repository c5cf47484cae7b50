"""Test-data adapters: the driver's parquet tables → feed messages → raw frames.

The driver's ``events`` table stands in for a market feed (symbol = event_type,
exchange = 'SIM').  Each channel is a projection / filter of the same scan, so
Catalyst prunes columns and the five frames stay independent, parallel scans.
``lineitem`` is a tie-heavy trade source (one timestamp per ship day).

Channel mapping of the test data (fixed values, from the fixture mapping):
every event is a trade; events whose id is a multiple of 3 also carry a book
snapshot, of 7 an open-interest print, of 11 a funding print, of 5 a
liquidation.  This is how one table stands in for five feeds, not sampling:
every event row reaches the trade channel and every query runs over all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.sources import normalize

EXCHANGE = "SIM"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _event_time(events: DataFrame) -> Column:
    return F.col("ts").cast("timestamp")


def _epoch_seconds(ts: Column) -> Column:
    """Exact decimal epoch seconds (what a feed message carries as a number)."""
    return (F.unix_micros(ts).cast("decimal(20,0)") / F.lit(1_000_000)).cast("decimal(20,6)")


def _k(events_col: str = "props") -> Column:
    return F.get_json_object(F.col(events_col), "$.k").cast("double")


def _side() -> Column:
    return F.when(F.col("event_id") % 2 == 0, F.lit("buy")).otherwise(F.lit("sell"))


def _base(events: DataFrame, where: Column | None = None) -> DataFrame:
    df = events if where is None else events.filter(where)
    return df.withColumn("_t", _epoch_seconds(_event_time(df)))


def trade_messages(events: DataFrame) -> DataFrame:
    return _base(events).select(
        F.col("_t").alias("timestamp"),
        F.col("_t").alias("receipt_timestamp"),
        F.lit(EXCHANGE).alias("exchange"),
        F.col("event_type").alias("symbol"),
        _side().alias("side"),
        (F.col("value") + 1).cast("string").alias("price"),
        (_k() + 1).cast("string").alias("amount"),
        F.col("event_id").cast("string").alias("id"),
    )


def _levels_map(count: Column, px, sz) -> Column:
    entries = F.transform(
        F.sequence(F.lit(0).cast("long"), count),
        lambda i: F.struct(px(i).cast("string").alias("k"), sz(i).cast("string").alias("v")),
    )
    return F.map_from_entries(entries)


def book_messages(events: DataFrame) -> DataFrame:
    v = F.col("value") + 1
    eid = F.col("event_id")
    bids = _levels_map(
        3 + eid % 9,
        lambda i: v - F.lit(0.01) * (i + 1),
        lambda i: ((eid * (i + 3)) % 17 + 1).cast("double"),
    )
    asks = _levels_map(
        3 + eid % 7,
        lambda i: v + F.lit(0.01) * (i + 1),
        lambda i: ((eid * (i + 5)) % 19 + 1).cast("double"),
    )
    return _base(events, eid % 3 == 0).select(
        F.col("_t").alias("timestamp"),
        F.col("_t").alias("receipt_timestamp"),
        F.lit(EXCHANGE).alias("exchange"),
        F.col("event_type").alias("symbol"),
        F.struct(bids.alias("bid"), asks.alias("ask")).alias("book"),
    )


def open_interest_messages(events: DataFrame) -> DataFrame:
    return _base(events, F.col("event_id") % 7 == 0).select(
        F.col("_t").alias("timestamp"),
        F.col("_t").alias("receipt_timestamp"),
        F.lit(EXCHANGE).alias("exchange"),
        F.col("event_type").alias("symbol"),
        (F.lit(1000) + F.col("user_id")).cast("double").alias("open_interest"),
    )


def funding_messages(events: DataFrame) -> DataFrame:
    return _base(events, F.col("event_id") % 11 == 0).select(
        F.col("_t").alias("timestamp"),
        F.col("_t").alias("receipt_timestamp"),
        F.lit(EXCHANGE).alias("exchange"),
        F.col("event_type").alias("symbol"),
        (F.col("value") + 1).alias("mark_price"),
        ((F.col("value") - 100) / 1000000).alias("rate"),
        F.lit(None).cast("double").alias("predicted_rate"),
    )


def liquidation_messages(events: DataFrame) -> DataFrame:
    return _base(events, F.col("event_id") % 5 == 0).select(
        F.col("_t").alias("timestamp"),
        F.col("_t").alias("receipt_timestamp"),
        F.lit(EXCHANGE).alias("exchange"),
        F.col("event_type").alias("symbol"),
        _side().alias("side"),
        (F.col("value") + 1).cast("string").alias("price"),
        (F.col("event_id") % 13 + 1).cast("string").alias("quantity"),
        F.lit("").alias("status"),
        F.col("event_id").cast("string").alias("id"),
    )


def raw_frames(events: DataFrame, book_depth: int = normalize.DEFAULT_BOOK_DEPTH) -> dict[str, DataFrame]:
    """The five raw layer frames derived from the events table."""
    return {
        "trades": normalize.normalize_trades(trade_messages(events)),
        "book": normalize.normalize_book(book_messages(events), depth=book_depth),
        "open_interest": normalize.normalize_open_interest(open_interest_messages(events)),
        "funding": normalize.normalize_funding(funding_messages(events)),
        "liquidations": normalize.normalize_liquidations(liquidation_messages(events)),
    }


def load_raw(spark: SparkSession, sf_dir: str, book_depth: int = normalize.DEFAULT_BOOK_DEPTH) -> dict[str, DataFrame]:
    return raw_frames(read_table(spark, sf_dir, "events"), book_depth=book_depth)


def lineitem_trades(lineitem: DataFrame) -> DataFrame:
    """Tie-heavy trades: symbol = return flag, one timestamp per ship day."""
    qty = F.col("l_quantity")
    price = F.col("l_extendedprice") / qty
    return lineitem.select(
        F.col("l_shipdate").cast("timestamp").alias("timestamp"),
        F.col("l_shipdate").cast("timestamp").alias("receipt_ts"),
        F.lit(EXCHANGE).alias("exchange"),
        F.col("l_returnflag").alias("symbol"),
        F.when((F.col("l_orderkey") + F.col("l_linenumber")) % 2 == 0, F.lit("buy")).otherwise(F.lit("sell")).alias("side"),
        price.alias("price"),
        qty.alias("quantity"),
        (price * qty).alias("notional"),
        F.concat(F.lpad(F.col("l_orderkey").cast("string"), 12, "0"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("trade_id"),
    )


def data_range(events: DataFrame) -> tuple[str, str]:
    """Whole-day UTC range covering every event: [first day, day after the last).

    One global min/max aggregation over the time column; the driver receives a
    single row.
    """
    from datetime import datetime, timezone

    row = events.agg(
        F.unix_seconds(F.date_trunc("day", F.min(F.col("ts").cast("timestamp")))).alias("s"),
        F.unix_seconds(F.date_trunc("day", F.max(F.col("ts").cast("timestamp"))) + F.expr("INTERVAL 1 DAY")).alias("e"),
    ).first()
    fmt = "%Y-%m-%dT%H:%M:%SZ"
    return tuple(datetime.fromtimestamp(int(row[k]), tz=timezone.utc).strftime(fmt) for k in ("s", "e"))
