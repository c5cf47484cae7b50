"""Time-bar sampling (BAR-0..17).

``time_bars`` turns the five raw frames into one bar per (exchange, symbol,
bar_time).  Scale design:

* **Trade bars are a two-level aggregation.**  Level 1 groups trades by
  (exchange, symbol, epoch second) with map-side partial aggregation, so a hot
  symbol is reduced inside every scan task before anything is shuffled.
  Level 2 groups the per-second rows by bar.  The largest in-bar gap needs the
  trades in time order; instead of sorting a whole (possibly huge) bar in one
  task, level 1 keeps the sorted distinct milliseconds of its second (at most
  1000 values) and level 2 links consecutive seconds with a ``lag`` over at
  most ``interval_sec`` rows.  Every buffer is bounded by the interval, never
  by the data volume.
* Book, liquidation, open-interest and funding bars are partial+final
  aggregations; ``min``/``max`` of (ts, value) structs replace
  ``argMin``/``argMax`` (deterministic on ties, partial-aggregatable).
* **No joins.**  ``time_bars`` brings the sources' rows together in one wide
  tagged frame, dealt once by (symbol, chunk of bars); the bar aggregation, the
  as-of fill and the quiet bars all use that partitioning.  Closes come into a
  chunk from a small table with one row per chunk, so no task ever owns a whole
  symbol history.
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick import schemas
from candlewick.functions.exprs import (
    bucket_start,
    epoch_millis,
    flag,
    parse_utc,
    ratio,
    time_range,
)

KEYS3 = ["exchange", "symbol", "bar_time"]
# Bars per generation / forward-fill chunk (one day of minute bars).
GRID_CHUNK_BARS = 1440
DAY_SEC = 86400
LIQ_SUMS = ["liq_buy_volume", "liq_sell_volume", "liq_buy_turnover", "liq_sell_turnover"]
LAST_VALUES = ["open_interest_open", "open_interest_close", "funding_rate", "_has_oi", "_has_funding"]


def _in_range(df: DataFrame, column: str, start, end) -> DataFrame:
    cond = time_range(column, start, end)
    return df if cond is None else df.filter(cond)


def _epoch_seconds(ts: Column) -> Column:
    return F.floor(F.unix_micros(ts) / F.lit(1_000_000)).cast("long")


def _bar_of_seconds(sec: Column, interval_sec: int) -> Column:
    return F.timestamp_seconds(sec - F.pmod(sec, F.lit(int(interval_sec))))


# --------------------------------------------------------------------------- trades


def trade_seconds(trades: DataFrame, start=None, end=None) -> DataFrame:
    """Level 1: one row per (exchange, symbol, second) with mergeable trade stats."""
    t = _in_range(trades, "timestamp", start, end)
    buy = F.col("side") == "buy"
    sell = F.col("side") == "sell"
    root = F.sqrt(F.col("notional"))
    sec = (
        t.select(
            "exchange",
            "symbol",
            _epoch_seconds(F.col("timestamp")).alias("sec"),
            "timestamp",
            "trade_id",
            "price",
            "quantity",
            "notional",
            "side",
        )
        .groupBy("exchange", "symbol", "sec")
        .agg(
            F.min(F.struct("timestamp", "trade_id", "price")).alias("o"),
            F.max(F.struct("timestamp", "trade_id", "price")).alias("c"),
            F.max("price").alias("hi"),
            F.min("price").alias("lo"),
            F.sum("quantity").alias("vol"),
            F.sum("notional").alias("turn"),
            F.count(F.lit(1)).alias("n"),
            F.sum(F.when(buy, F.col("quantity"))).alias("bv"),
            F.sum(F.when(sell, F.col("quantity"))).alias("sv"),
            F.sum(F.when(buy, F.col("notional"))).alias("bt"),
            F.sum(F.when(sell, F.col("notional"))).alias("st"),
            F.sum(F.when(buy, root)).alias("bsq"),
            F.sum(F.when(sell, root)).alias("ssq"),
            F.min("timestamp").alias("first_ts"),
            F.max("timestamp").alias("last_ts"),
            # distinct millisecond marks of this second: at most 1000 values
            F.array_sort(F.collect_set(epoch_millis(F.col("timestamp")))).alias("ms"),
        )
    )
    ms = F.col("ms")
    k = F.size(ms) - 1
    inner_gap = F.array_max(F.zip_with(F.slice(ms, 2, k), F.slice(ms, 1, k), lambda a, b: a - b))
    return sec.select(
        "*",
        F.col("o.price").alias("o_price"),
        F.col("c.price").alias("c_price"),
        F.coalesce(inner_gap, F.lit(0).cast("long")).alias("gap_in"),
        F.element_at(ms, 1).alias("ms_min"),
        F.element_at(ms, -1).alias("ms_max"),
    ).drop("ms", "o", "c")


def trade_bars(trades: DataFrame, interval_sec: int = 60, start=None, end=None) -> DataFrame:
    """BAR-1..8: OHLC, volumes, signed √$ volume, vwap, first/last ts, max gap."""
    schemas.validate_interval(interval_sec)
    secs = trade_seconds(trades, start, end).withColumn("bar_time", _bar_of_seconds(F.col("sec"), interval_sec))
    return _linked(secs, KEYS3).groupBy(*KEYS3).agg(*_second_sums()).select(*KEYS3, *_trade_columns())


def _linked(secs: DataFrame, keys: list[str]) -> DataFrame:
    """``gap_link``: from the last millisecond of the second before in the bar; rows without ``sec`` come first and link nothing."""
    w = Window.partitionBy(*keys).orderBy("sec")
    return secs.withColumn("gap_link", F.col("ms_min") - F.lag("ms_max").over(w))


def _second_sums() -> list[Column]:
    """Level 2: seconds are disjoint in time, so a bar opens with its first
    second's open and closes with its last second's close (no ties on ``sec``,
    fixed-width buffers)."""
    zero = F.lit(0).cast("long")
    return [
        F.min_by("o_price", "sec").alias("open"),
        F.max_by("c_price", "sec").alias("close"),
        F.max("hi").alias("high"),
        F.min("lo").alias("low"),
        F.sum("vol").alias("volume"),
        F.sum("turn").alias("turnover"),
        F.sum("n").alias("trade_count"),
        F.coalesce(F.sum("bv"), F.lit(0.0)).alias("buy_volume"),
        F.coalesce(F.sum("sv"), F.lit(0.0)).alias("sell_volume"),
        F.coalesce(F.sum("bt"), F.lit(0.0)).alias("buy_turnover"),
        F.coalesce(F.sum("st"), F.lit(0.0)).alias("sell_turnover"),
        (F.coalesce(F.sum("bsq"), F.lit(0.0)) - F.coalesce(F.sum("ssq"), F.lit(0.0))).alias("signed_sqrt_dollar_volume"),
        F.min("first_ts").alias("first_trade_ts"),
        F.max("last_ts").alias("last_trade_ts"),
        F.max(F.greatest(F.col("gap_in"), F.coalesce(F.col("gap_link"), zero))).alias("max_trade_gap_ms"),
    ]


def _trade_columns() -> list[Column]:
    plain = ["open", "high", "low", "close", "volume", "turnover", "trade_count", "buy_volume", "sell_volume", "buy_turnover", "sell_turnover"]
    return [
        *[F.col(c) for c in plain],
        F.col("signed_sqrt_dollar_volume"),
        ratio("turnover", "volume").alias("vwap"),
        F.lit(0).cast("long").alias("large_trade_count"),
        F.lit(0.0).alias("large_trade_volume"),
        F.date_trunc("millisecond", "first_trade_ts").alias("first_trade_ts"),
        F.date_trunc("millisecond", "last_trade_ts").alias("last_trade_ts"),
        F.col("max_trade_gap_ms"),
    ]


def trade_gaps(trades: DataFrame, interval_sec: int = 60, start=None, end=None) -> DataFrame:
    """BAR-1 / BAR-1a: per trade, the previous trade time inside the same bar and the gap in ms.

    The first trade of a bar is its own predecessor (gap 0).  Only *distinct*
    timestamps are ever ordered: trades sharing a timestamp with an earlier
    trade (ties, ordered by trade_id) have gap 0, so the first trade of each
    timestamp group links to the previous distinct timestamp.  That ordering
    runs per (symbol, second) over distinct timestamps — at most one row per
    microsecond whatever the trade count — and seconds are linked inside a bar
    through the per-second table (at most ``interval_sec`` rows).  Ties of any
    size collapse in a partial aggregation; the final join back to the trades
    is an equi-join AQE can split when one timestamp is hot.
    """
    t = _in_range(trades, "timestamp", start, end).select(
        "exchange", "symbol", "trade_id", "timestamp", _epoch_seconds(F.col("timestamp")).alias("sec")
    )
    t = t.withColumn("bar_time", _bar_of_seconds(F.col("sec"), interval_sec))
    stamps = t.groupBy("exchange", "symbol", "bar_time", "sec", "timestamp").agg(F.min("trade_id").alias("_first_id"))
    in_sec = Window.partitionBy("exchange", "symbol", "sec").orderBy("timestamp")
    stamps = stamps.withColumn("_prev_in", F.lag("timestamp").over(in_sec))
    secs = stamps.groupBy("exchange", "symbol", "bar_time", "sec").agg(F.max("timestamp").alias("_last"))
    by_bar = Window.partitionBy("exchange", "symbol", "bar_time").orderBy("sec")
    links = secs.select("exchange", "symbol", "sec", F.lag("_last").over(by_bar).alias("_link"))
    stamps = stamps.join(links, ["exchange", "symbol", "sec"], "left").select(
        "exchange",
        "symbol",
        "timestamp",
        "_first_id",
        F.coalesce(F.col("_prev_in"), F.col("_link"), F.col("timestamp")).alias("_prev_distinct"),
    )
    joined = t.join(stamps, ["exchange", "symbol", "timestamp"], "inner")
    # first of its timestamp group (smallest trade_id; an all-NULL-id group is one tie group)
    first = F.col("trade_id").eqNullSafe(F.col("_first_id"))
    prev = F.when(first, F.col("_prev_distinct")).otherwise(F.col("timestamp"))
    return joined.select(
        "exchange",
        "symbol",
        "bar_time",
        "trade_id",
        "timestamp",
        prev.alias("prev_trade_ts"),
        (epoch_millis(F.col("timestamp")) - epoch_millis(prev)).alias("gap_ms"),
    )


# --------------------------------------------------------------------------- other sources


def _bucketed(df: DataFrame, interval_sec: int, start, end) -> DataFrame:
    return _in_range(df, "timestamp", start, end).withColumn("bar_time", bucket_start(F.col("timestamp"), interval_sec))


def _book_rows(book: DataFrame, interval_sec: int, start, end) -> DataFrame:
    one = F.element_at
    return _bucketed(book, interval_sec, start, end).select(
        *KEYS3,
        F.lit(1).alias("_book"),
        F.col("spread_bps").alias("avg_spread_bps"),
        F.col("mid_price").alias("avg_mid_price"),
        F.col("microprice").alias("avg_microprice"),
        one("bid_sz", 1).alias("avg_bid1_size"),
        one("ask_sz", 1).alias("avg_ask1_size"),
        F.col("bid_depth_5").alias("avg_top5_bid_depth"),
        F.col("ask_depth_5").alias("avg_top5_ask_depth"),
        F.col("bid_depth_10").alias("avg_top10_bid_depth"),
        F.col("ask_depth_10").alias("avg_top10_ask_depth"),
        F.col("imbalance_top1").alias("avg_imbalance_top1"),
        F.col("imbalance_top5").alias("avg_imbalance_top5"),
        F.col("imbalance_top10").alias("avg_imbalance_top10"),
    )


def _book_means() -> list[Column]:
    return [F.count("_book").alias("ob_snapshot_count"), *[F.avg(c).alias(c) for c in schemas.BOOK_MEAN_COLUMNS]]


def book_bars(book: DataFrame, interval_sec: int = 60, start=None, end=None) -> DataFrame:
    """BAR-9: snapshot count and plain means of the book statistics."""
    return _book_rows(book, interval_sec, start, end).groupBy(*KEYS3).agg(*_book_means())


def oi_bars(oi: DataFrame, interval_sec: int = 60, start=None, end=None) -> DataFrame:
    """BAR-10: first / last open interest of the bar."""
    o = _bucketed(oi, interval_sec, start, end)
    agg = o.groupBy(*KEYS3).agg(
        F.min(F.struct("timestamp", "open_interest")).alias("f"),
        F.max(F.struct("timestamp", "open_interest")).alias("l"),
    )
    return agg.select(*KEYS3, F.col("f.open_interest").alias("open_interest_open"), F.col("l.open_interest").alias("open_interest_close"))


def funding_bars(funding: DataFrame, interval_sec: int = 60, start=None, end=None) -> DataFrame:
    """BAR-11: last funding rate of the bar."""
    f = _bucketed(funding, interval_sec, start, end)
    agg = f.groupBy(*KEYS3).agg(F.max(F.struct("timestamp", "rate")).alias("l"))
    return agg.select(*KEYS3, F.col("l.rate").alias("funding_rate"))


def _liquidation_rows(liq: DataFrame, interval_sec: int, start, end) -> DataFrame:
    buy = F.col("side") == "buy"
    sell = F.col("side") == "sell"
    px_q = F.col("price") * F.col("quantity")
    return _bucketed(liq, interval_sec, start, end).select(
        *KEYS3,
        F.lit(1).alias("_liq"),
        F.when(buy, F.col("quantity")).alias("liq_buy_volume"),
        F.when(sell, F.col("quantity")).alias("liq_sell_volume"),
        F.when(buy, px_q).alias("liq_buy_turnover"),
        F.when(sell, px_q).alias("liq_sell_turnover"),
    )


def _liquidation_sums() -> list[Column]:
    return [*[F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in LIQ_SUMS], F.count("_liq").alias("liq_count")]


def liquidation_bars(liq: DataFrame, interval_sec: int = 60, start=None, end=None) -> DataFrame:
    """BAR-12: liquidation volume / turnover by side and count."""
    return _liquidation_rows(liq, interval_sec, start, end).groupBy(*KEYS3).agg(*_liquidation_sums())


def _last_values(oi: DataFrame, funding: DataFrame, interval_sec: int, start, end) -> DataFrame:
    """BAR-10 and BAR-11 in one aggregation, with marks of the sources that a bar has."""
    o = _bucketed(oi, interval_sec, start, end).select(*KEYS3, F.struct("timestamp", "open_interest").alias("oi"))
    f = _bucketed(funding, interval_sec, start, end).select(*KEYS3, F.struct("timestamp", "rate").alias("rate"))
    agg = o.unionByName(f, allowMissingColumns=True).groupBy(*KEYS3).agg(F.min("oi").alias("f"), F.max("oi").alias("l"), F.max("rate").alias("r"))
    mark = lambda c: F.when(F.col(c).isNotNull(), F.lit(1))
    return agg.select(
        *KEYS3,
        F.col("f.open_interest").alias("open_interest_open"),
        F.col("l.open_interest").alias("open_interest_close"),
        F.col("r.rate").alias("funding_rate"),
        mark("l").alias("_has_oi"),
        mark("r").alias("_has_funding"),
    )


# --------------------------------------------------------------------------- grid + as-of


def _aligned_grid_bounds(start, end, interval_sec: int) -> tuple[int, int]:
    s = parse_utc(start)
    e = parse_utc(end)
    s_epoch = int((s - datetime(1970, 1, 1, tzinfo=s.tzinfo)).total_seconds())
    if (s - datetime(1970, 1, 1, tzinfo=s.tzinfo)).total_seconds() % interval_sec != 0:
        raise ValueError(f"grid start {start} is not aligned to {interval_sec}s")
    bar_count = max(int((e - s).total_seconds() // interval_sec), 0)
    return s_epoch, bar_count


def time_grid(symbols: DataFrame, start, end, interval_sec: int, chunk_bars: int = GRID_CHUNK_BARS) -> DataFrame:
    """BAR-13: every (exchange, symbol) × bar time in [start, end).

    Generated by two ``explode`` steps (chunks, then bars in a chunk) with the
    chunk rows spread over tasks in between, so generation is distributed and
    no cross join is planned.  Output carries ``_chunk`` for the forward fill.
    """
    start_epoch, bar_count = _aligned_grid_bounds(start, end, interval_sec)
    n_chunks = (bar_count + chunk_bars - 1) // chunk_bars
    if n_chunks == 0:
        return symbols.select("exchange", "symbol", F.lit(None).cast("timestamp").alias("bar_time"), F.lit(0).cast("long").alias("_chunk")).limit(0)
    chunks = symbols.select("exchange", "symbol", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_chunks - 1).cast("long"))).alias("_chunk"))
    chunks = chunks.repartition("exchange", "symbol", "_chunk")
    first = F.col("_chunk") * chunk_bars
    last = F.least(first + chunk_bars, F.lit(bar_count).cast("long")) - 1
    idx = chunks.select("exchange", "symbol", "_chunk", F.explode(F.sequence(first, last)).alias("_k"))
    return idx.select(
        "exchange",
        "symbol",
        F.timestamp_seconds(F.lit(start_epoch).cast("long") + F.col("_k") * F.lit(int(interval_sec))).alias("bar_time"),
        "_chunk",
    )


def forward_fill(df: DataFrame, value: str, out: str, partition: list[str], chunk: str, order: str) -> DataFrame:
    """As-of fill of ``value`` (last non-null at or before the row) in ``out``.

    Two bounded steps instead of one window over a whole series:
    1. fill inside each (partition, chunk);
    2. carry the last non-null value of every earlier chunk through the small
       per-chunk table (one row per chunk) and join it back.
    """
    w_in = Window.partitionBy(*partition, chunk).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = df.withColumn("_local_fill", F.last(value, ignorenulls=True).over(w_in))
    tails = df.groupBy(*partition, chunk).agg(
        F.max(F.when(F.col(value).isNotNull(), F.struct(F.col(order).alias("o"), F.col(value).alias("v")))).alias("_tail")
    )
    w_chunks = Window.partitionBy(*partition).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    carry = tails.select(*partition, chunk, F.last(F.col("_tail.v"), ignorenulls=True).over(w_chunks).alias("_carry"))
    return (
        local.join(carry, [*partition, chunk], "left")
        .withColumn(out, F.coalesce(F.col("_local_fill"), F.col("_carry")))
        .drop("_local_fill", "_carry")
    )


def _assemble(j: DataFrame, grid_mode: bool, interval_sec: int) -> DataFrame:
    z = F.lit(0.0)
    zl = F.lit(0).cast("long")
    if grid_mode:
        pc = F.col("prev_close")
        ohlc = [F.coalesce(F.col(c), pc).alias(c) for c in ("open", "high", "low", "close")]
        vwap = F.coalesce(F.col("vwap"), F.col("close"), pc).alias("vwap")
        first_ts = F.coalesce(F.col("first_trade_ts"), F.col("bar_time")).alias("first_trade_ts")
        last_ts = F.coalesce(F.col("last_trade_ts"), F.col("bar_time")).alias("last_trade_ts")
        complete = F.when((F.coalesce(F.col("trade_count"), zl) > 0) | pc.isNotNull(), F.lit(1)).otherwise(F.lit(0)).alias("is_time_bar_complete")
    else:
        ohlc = [F.col(c) for c in ("open", "high", "low", "close")]
        vwap = F.coalesce(F.col("vwap"), z).alias("vwap")
        complete = F.lit(1).alias("is_time_bar_complete")
        first_ts = F.col("first_trade_ts")
        last_ts = F.col("last_trade_ts")
    out = j.select(
        "exchange",
        "symbol",
        F.lit(int(interval_sec)).alias("bar_interval_sec"),
        "bar_time",
        *ohlc,
        *[F.coalesce(F.col(c), z).alias(c) for c in ("volume", "turnover")],
        F.coalesce(F.col("trade_count"), zl).alias("trade_count"),
        *[F.coalesce(F.col(c), z).alias(c) for c in ("buy_volume", "sell_volume", "buy_turnover", "sell_turnover", "signed_sqrt_dollar_volume")],
        vwap,
        F.coalesce(F.col("large_trade_count"), zl).alias("large_trade_count"),
        F.coalesce(F.col("large_trade_volume"), z).alias("large_trade_volume"),
        F.coalesce(F.col("ob_snapshot_count"), zl).alias("ob_snapshot_count"),
        complete,
        flag(F.coalesce(F.col("ob_snapshot_count"), zl) > 0).alias("has_book_data"),
        flag(F.col("_has_oi").isNotNull()).alias("has_open_interest_data"),
        flag(F.col("_has_funding").isNotNull()).alias("has_funding_data"),
        *[F.coalesce(F.col(c), z).alias(c) for c in schemas.BOOK_MEAN_COLUMNS],
        F.coalesce(F.col("open_interest_open"), z).alias("open_interest_open"),
        F.coalesce(F.col("open_interest_close"), z).alias("open_interest_close"),
        F.col("funding_rate"),
        *[F.coalesce(F.col(c), z).alias(c) for c in ("liq_buy_volume", "liq_sell_volume", "liq_buy_turnover", "liq_sell_turnover")],
        F.coalesce(F.col("liq_count"), zl).alias("liq_count"),
        first_ts,
        last_ts,
        F.coalesce(F.col("max_trade_gap_ms"), zl).alias("max_trade_gap_ms"),
    )
    return schemas.conform(out, schemas.BARS)


def _tagged(raw: dict[str, DataFrame], interval_sec: int, start, end) -> DataFrame:
    """All sources in one wide frame: a row per second of trades, and up to two per bar of the other sources, whose ``sec`` is null."""
    secs = trade_seconds(raw["trades"], start, end).withColumn("bar_time", _bar_of_seconds(F.col("sec"), interval_sec))
    book = _book_rows(raw["book"], interval_sec, start, end)
    flows = book.unionByName(_liquidation_rows(raw["liquidations"], interval_sec, start, end), allowMissingColumns=True)
    flows = flows.groupBy(*KEYS3).agg(*_book_means(), *_liquidation_sums())
    values = _last_values(raw["open_interest"], raw["funding"], interval_sec, start, end)
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), (secs, flows, values))


def _carried(trades: DataFrame, chunk: Column, n_chunks: int, start, end, seed: DataFrame | None) -> DataFrame:
    """(exchange, symbol, _chunk, _carry): the last close before each chunk, for all chunks behind a symbol's first trade or seed."""
    t = _in_range(trades, "timestamp", start, end).where(F.col("price").isNotNull())
    t = t.select("exchange", "symbol", chunk.alias("_chunk"), F.struct("timestamp", "trade_id", "price").alias("t"))
    tails = t.groupBy("exchange", "symbol", "_chunk").agg(F.max("t").alias("t")).select("exchange", "symbol", "_chunk", F.col("t.price").alias("_carry"))
    if seed is not None:
        tails = tails.unionByName(seed.select("exchange", "symbol", F.lit(-1).cast("long").alias("_chunk"), F.col("close").alias("_carry")))
    last = F.lit(n_chunks - 1).cast("long")
    tails = tails.withColumn("_to", F.least(F.lead("_chunk", 1, n_chunks - 1).over(Window.partitionBy("exchange", "symbol").orderBy("_chunk")), last))
    behind = F.when(F.col("_to") > F.col("_chunk"), F.sequence(F.col("_chunk") + 1, F.col("_to")))
    return tails.select("exchange", "symbol", F.explode(behind).alias("_chunk"), "_carry")


def time_bars(
    raw: dict[str, DataFrame],
    interval_sec: int = 60,
    start=None,
    end=None,
    chunk_bars: int | None = None,
    seed: DataFrame | None = None,
) -> DataFrame:
    """BAR-15 (both bounds: dense grid, as-of filled) / BAR-16 (otherwise: sparse).

    ``raw`` maps 'trades', 'book', 'open_interest', 'funding', 'liquidations'
    to raw frames.  Every source is filtered to [start, end) before bucketing.
    ``seed`` (exchange, symbol, close) holds closes from before the grid: such a
    symbol has bars from ``start`` on, with or without a trade in the range.

    The tagged frame is dealt once by (symbol, chunk); a chunk (``chunk_bars``,
    by default a day) bounds what lies in one group.  A grid's chunks each get a
    first row with the close carried in, so a chunk fills itself; the bars up to
    a symbol's next row are generated from that row.
    """
    schemas.validate_interval(interval_sec)
    grid_mode = bool(start and end)
    chunk_bars = chunk_bars or max(1, DAY_SEC // interval_sec)
    first, bar_count = _aligned_grid_bounds(start, end, interval_sec) if grid_mode else (0, 0)
    rows = _tagged(raw, interval_sec, start, end)
    chunk_of = lambda sec: F.floor((sec - F.lit(first)) / F.lit(chunk_bars * interval_sec)).cast("long")
    rows = rows.withColumn("_chunk", chunk_of(F.unix_seconds("bar_time")))
    at = lambda bar: F.timestamp_seconds(F.lit(first).cast("long") + bar * F.lit(int(interval_sec)))
    if grid_mode:
        n_chunks = (bar_count + chunk_bars - 1) // chunk_bars
        heads = _carried(raw["trades"], chunk_of(_epoch_seconds(F.col("timestamp"))), n_chunks, start, end, seed)
        heads = heads.withColumn("bar_time", at(F.col("_chunk") * chunk_bars))
        rows = rows.where(F.col("bar_time") < at(F.lit(bar_count).cast("long"))).unionByName(heads, allowMissingColumns=True)
    keys = ["exchange", "symbol", "_chunk", "bar_time"]
    rows = _linked(rows.repartition("exchange", "symbol", "_chunk"), keys)
    others = ["ob_snapshot_count", *schemas.BOOK_MEAN_COLUMNS, *LIQ_SUMS, "liq_count", *LAST_VALUES]
    carry = [F.max("_carry").alias("_carry")] if grid_mode else []
    bars = rows.groupBy(*keys).agg(*_second_sums(), *[F.max(c).alias(c) for c in others], *carry)
    bars = bars.select(*keys, *_trade_columns(), *others, *(["_carry"] if grid_mode else []))
    traded = F.coalesce(F.col("trade_count"), F.lit(0).cast("long")) > 0
    if not grid_mode:
        return _assemble(bars.where(traded), grid_mode=False, interval_sec=interval_sec)

    # BAR-14: the as-of close includes the bar itself; drop bars before the first trade
    w = Window.partitionBy("exchange", "symbol", "_chunk").orderBy("bar_time")
    filled = F.last(F.coalesce("close", "_carry"), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    stop = F.least((F.col("_chunk") + 1) * chunk_bars, F.lit(bar_count).cast("long"))
    g = bars.withColumn("_bar", ((F.unix_seconds("bar_time") - F.lit(first)) / F.lit(int(interval_sec))).cast("long"))
    g = g.withColumn("prev_close", filled).withColumn("_stop", F.coalesce(F.lead("_bar").over(w), stop))
    g = g.where(traded | F.col("prev_close").isNotNull())
    quiet = F.when(F.col("prev_close").isNotNull(), F.col("_stop") - 1).otherwise(F.col("_bar"))
    g = g.withColumn("_k", F.explode(F.sequence(F.col("_bar"), quiet)))
    own = F.col("_k") == F.col("_bar")
    data = [c for c in bars.columns if c not in (*keys, "_carry")]
    g = g.select("exchange", "symbol", at(F.col("_k")).alias("bar_time"), "prev_close", *[F.when(own, F.col(c)).alias(c) for c in data])
    return _assemble(g, grid_mode=True, interval_sec=interval_sec)
