"""Structured Streaming view of the bar and landing operators (STR-1..4, SRC-6).

* ``land_stream``: file stream of feed messages → normalised raw rows → the raw
  layer.  Each channel and source has one checkpoint, and each micro-batch is one
  commit named by (query, batch), so a later call goes on and a repeated batch adds
  nothing (``availableNow`` for catch-up runs).
* ``streaming_trade_bars_two_level`` (used by ``stream_bars_to``): event-time
  tumbling bars with a watermark equal to the safety lag, as a chained
  aggregation — 1-second windows, then bars of seconds; append mode emits a
  bar once the watermark passes its end.  The in-bar maximum gap needs no
  ``lag``: a second keeps its distinct millisecond marks (at most 1000) and a
  bar keeps one (first ms, last ms, inner gap) struct per non-empty second, so
  state is bounded by the interval whatever the trade rate.
* ``stream_late_repair``: follows the commit logs of the raw channels; each
  micro-batch rebuilds what its new rows touch (``repair_touched``) and appends it
  with a new ``_version``; DED-1 at read time makes the final state equal to a batch run.
"""

from __future__ import annotations

import hashlib
import threading
import uuid
from datetime import datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick import schemas
from candlewick.functions.exprs import EPOCH, bucket_start, epoch_millis, ratio
from candlewick.operators.bars import time_bars
from candlewick.operators.features import LOOKBACK_BARS
from candlewick.operators.labels import LOOKFORWARD_BARS
from candlewick.plans.commits import ENTRIES
from candlewick.plans.incremental import LAYERS, Step, layer_frame
from candlewick.plans.sinks import RAW_TABLES, Store, last_closes, log_of, newest_times, read_layer, write_layer
from candlewick.session import shared_path
from candlewick.sources import fixtures
from candlewick.sources.normalize import NORMALIZERS

DEFAULT_SAFETY_LAG = "120 seconds"
SYMBOL = ["exchange", "symbol"]
# Touched days further apart than this are repaired one after another.
REPAIR_GAP_DAYS = 7

EVENTS_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def event_stream(spark: SparkSession, sf_dir: str, max_files: int | None = None) -> DataFrame:
    """The events file of a folder as a stream (other tables in it are skipped), or all files of a folder ``*.parquet``."""
    reader = spark.readStream.schema(EVENTS_SCHEMA)
    if not sf_dir.endswith(".parquet"):
        reader = reader.option("pathGlobFilter", "events.parquet")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", int(max_files))
    return reader.parquet(sf_dir)


def commit_stream(spark: SparkSession, store: Store, channel: str, max_files: int | None = None) -> DataFrame:
    """The files (channel, path) that the commits of a raw channel add, as a stream of its log."""
    log = log_of(spark, store, RAW_TABLES[channel])
    log.create()
    reader = spark.readStream.schema(ENTRIES)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", int(max_files))
    added = reader.json(log.path("log")).where((F.col("action") == "add") & ~F.coalesce("rewrite", F.lit(False)))
    return added.select(F.lit(channel).alias("channel"), "path")


def streaming_trade_bars_two_level(trades: DataFrame, interval_sec: int = 60, delay: str = DEFAULT_SAFETY_LAG) -> DataFrame:
    """STR-1 with bounded state: per-second windows first, then bars of seconds.

    State per open second holds at most 1000 millisecond marks; state per open
    bar holds one small struct per non-empty second (at most ``interval_sec``),
    whatever the trade rate.  The second windows feed the bar windows through
    ``window_time`` (chained event-time aggregation, append mode).
    """
    schemas.validate_interval(interval_sec)
    buy = F.col("side") == "buy"
    sell = F.col("side") == "sell"
    root = F.sqrt("notional")
    secs = (
        trades.withWatermark("timestamp", delay)
        .groupBy(F.window("timestamp", "1 second"), "exchange", "symbol")
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
            F.array_sort(F.collect_set(epoch_millis(F.col("timestamp")))).alias("ms"),
        )
    )
    ms = F.col("ms")
    k = F.size(ms) - 1
    inner = F.coalesce(F.array_max(F.zip_with(F.slice(ms, 2, k), F.slice(ms, 1, k), lambda a, b: a - b)), F.lit(0).cast("long"))
    secs = secs.select(
        F.window_time("window").alias("sec_time"),
        "exchange",
        "symbol",
        "o", "c", "hi", "lo", "vol", "turn", "n", "bv", "sv", "bt", "st", "bsq", "ssq", "first_ts", "last_ts",
        F.struct(F.element_at(ms, 1).alias("lo_ms"), F.element_at(ms, -1).alias("hi_ms"), inner.alias("gap")).alias("span"),
    )
    bars = secs.groupBy(F.window("sec_time", f"{int(interval_sec)} seconds"), "exchange", "symbol").agg(
        F.min("o").alias("_o"),
        F.max("c").alias("_c"),
        F.max("hi").alias("high"),
        F.min("lo").alias("low"),
        F.sum("vol").alias("volume"),
        F.sum("turn").alias("turnover"),
        F.sum("n").alias("trade_count"),
        F.coalesce(F.sum("bv"), F.lit(0.0)).alias("buy_volume"),
        F.coalesce(F.sum("sv"), F.lit(0.0)).alias("sell_volume"),
        F.coalesce(F.sum("bt"), F.lit(0.0)).alias("buy_turnover"),
        F.coalesce(F.sum("st"), F.lit(0.0)).alias("sell_turnover"),
        F.coalesce(F.sum("bsq"), F.lit(0.0)).alias("_bsq"),
        F.coalesce(F.sum("ssq"), F.lit(0.0)).alias("_ssq"),
        F.min("first_ts").alias("_first"),
        F.max("last_ts").alias("_last"),
        # one entry per non-empty second of the bar (at most interval_sec)
        F.array_sort(F.collect_list("span")).alias("_spans"),
    )
    spans = F.col("_spans")
    m = F.size(spans) - 1
    links = F.zip_with(F.slice(spans, 2, m), F.slice(spans, 1, m), lambda cur, prev: cur["lo_ms"] - prev["hi_ms"])
    inner_max = F.array_max(F.transform(spans, lambda x: x["gap"]))
    gap = F.greatest(F.coalesce(F.array_max(links), F.lit(0).cast("long")), F.coalesce(inner_max, F.lit(0).cast("long")))
    return bars.select(
        "exchange",
        "symbol",
        F.col("window.start").alias("bar_time"),
        F.col("_o.price").alias("open"),
        "high",
        "low",
        F.col("_c.price").alias("close"),
        "volume",
        "turnover",
        "trade_count",
        "buy_volume",
        "sell_volume",
        "buy_turnover",
        "sell_turnover",
        (F.col("_bsq") - F.col("_ssq")).alias("signed_sqrt_dollar_volume"),
        ratio("turnover", "volume").alias("vwap"),
        F.lit(0).cast("long").alias("large_trade_count"),
        F.lit(0.0).alias("large_trade_volume"),
        F.date_trunc("millisecond", "_first").alias("first_trade_ts"),
        F.date_trunc("millisecond", "_last").alias("last_trade_ts"),
        gap.alias("max_trade_gap_ms"),
    )


def run_available_now(df: DataFrame, sink: str, checkpoint: str, fmt: str = "parquet", partition_by: list[str] | None = None, mode: str = "append") -> None:
    writer = df.writeStream.format(fmt).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    query = writer.start(sink)
    query.awaitTermination()


def stream_bars_to(spark: SparkSession, sf_dir: str, root: str, interval_sec: int = 60, delay: str = DEFAULT_SAFETY_LAG) -> DataFrame:
    """Run STR-1 over the events file into ``root`` and return the batch read of the sink."""
    trades = fixtures.trade_messages(event_stream(spark, sf_dir))
    from candlewick.sources.normalize import normalize_trades

    bars = streaming_trade_bars_two_level(normalize_trades(trades), interval_sec, delay)
    run_id = uuid.uuid4().hex[:10]
    sink = f"{root.rstrip('/')}/stream_bars_{run_id}"
    run_available_now(bars, sink, f"{root.rstrip('/')}/_chk/stream_bars_{run_id}")
    return spark.read.parquet(sink)


def land_stream(spark: SparkSession, sf_dir: str, store: Store, channels=tuple(RAW_TABLES), symbols: list[str] | None = None, max_files: int | None = None) -> None:
    """SRC-6 / STR-4: land what the channels of a source have brought since the last call, of all symbols or those listed."""
    messages = {
        "trades": fixtures.trade_messages,
        "book": fixtures.book_messages,
        "liquidations": fixtures.liquidation_messages,
        "funding": fixtures.funding_messages,
        "open_interest": fixtures.open_interest_messages,
    }
    source = hashlib.sha256(sf_dir.rstrip("/").encode()).hexdigest()[:16]
    for channel in channels:
        rows = messages[channel](event_stream(spark, sf_dir, max_files))
        if symbols is not None:
            rows = rows.filter(F.col("symbol").isin(list(symbols)))
        land_rows(NORMALIZERS[channel](rows), store, channel, f"{store.root.rstrip('/')}/_chk/land_{channel}_{source}")


def land_rows(rows: DataFrame, store: Store, channel: str, checkpoint: str) -> None:
    """Append a stream of raw rows to its channel's layer; each micro-batch is committed once, by (query, batch)."""
    started, query_id = threading.Event(), []

    def land(batch: DataFrame, number: int) -> None:
        started.wait()
        write_layer(batch, store, RAW_TABLES[channel], tag=f"{query_id[0]}/{number}")

    query = rows.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query_id.append(query.id)  # stays the same for a checkpoint
    started.set()
    query.awaitTermination()


def _runs(days: list, gap: int = REPAIR_GAP_DAYS) -> list[tuple]:
    """(first, last) of the stretches of days without a gap of more than ``gap`` days."""
    runs: list[list] = []
    for day in sorted(days):
        if runs and (day - runs[-1][1]).days <= gap:
            runs[-1][1] = day
        else:
            runs.append([day, day])
    return [tuple(r) for r in runs]


def _next_trades(spark: SparkSession, store: Store, touched: DataFrame, after: datetime, newest: datetime | None, folder: str) -> DataFrame:
    """(exchange, symbol, until): the first stored bar with a trade behind a symbol's last touched bar ``last``, or ``bound`` if that is earlier.

    The bars are searched forward in ever wider ranges, so a read ends soon after the
    last of the next trades; only symbols without one are searched to the end.
    """
    base, found, days = schemas.BASE_INTERVAL, [], 1
    after += timedelta(seconds=base)
    while newest is not None and after <= newest:
        stop = after + timedelta(days=days)
        bars = read_layer(spark, store, LAYERS["sample"], start=after, end=stop, interval_sec=base).where(F.col("trade_count") > 0)
        hits = bars.join(touched, SYMBOL).where(F.col("bar_time") > F.col("last")).groupBy(*SYMBOL).agg(F.least(F.min("bar_time"), F.min("bound")).alias("until"))
        hits.write.parquet(f"{folder}/found_{len(found)}")
        found.append(spark.read.parquet(f"{folder}/found_{len(found)}"))
        touched = touched.join(found[-1].select(*SYMBOL), SYMBOL, "left_anti")
        if touched.isEmpty():
            break
        after, days = stop, days * 8
    rest = touched.select(*SYMBOL, F.col("bound").alias("until"))
    reduce(DataFrame.unionByName, found, rest).write.parquet(f"{folder}/until")
    return spark.read.parquet(f"{folder}/until")


def repair_touched(spark: SparkSession, store: Store, rows: DataFrame, intervals=()) -> None:
    """STR-3: rebuild what late rows (exchange, symbol, timestamp) touch, from all five raw channels.

    A late trade changes the closes that later bars carry, up to the symbol's next
    trade and no further; so a touched symbol's bars are rebuilt from the day of its
    first touched bar to that trade.  Touched days far apart are repaired one stretch
    after another, and only a stretch's day partitions are read.  Rollups of
    ``intervals`` follow, and their features and labels with the bars that look back
    or forward into the stretch.
    """
    base = timedelta(seconds=schemas.BASE_INTERVAL)
    folder = shared_path(spark, "repair", unique=True)
    marks = rows.groupBy(*SYMBOL, F.to_date("timestamp").alias("day")).agg(F.max(bucket_start(F.col("timestamp"), schemas.BASE_INTERVAL)).alias("last"))
    marks.write.parquet(f"{folder}/marks")
    marks = spark.read.parquet(f"{folder}/marks")
    days = marks.groupBy("day").agg(F.max("last").alias("last")).collect()  # a row for each touched day
    if not days:
        return
    utc = lambda t: t.replace(tzinfo=timezone.utc) if t.tzinfo is None else t
    stored = newest_times(spark, store, LAYERS["sample"]).filter(F.col("bar_interval_sec") == schemas.BASE_INTERVAL).agg(F.max("newest")).first()[0]
    stored = None if stored is None else utc(stored)
    end = max([utc(d["last"]) for d in days] + ([] if stored is None else [stored])) + base
    for number, (first, last) in enumerate(_runs([d["day"] for d in days])):
        touched = marks.where(F.col("day").between(F.lit(first), F.lit(last))).groupBy(*SYMBOL).agg(F.max("last").alias("last"))
        oldest = utc(touched.agg(F.min("last")).first()[0])
        # a symbol's next stretch goes on from its own day
        later = marks.where(F.col("day") > F.lit(last)).groupBy(*SYMBOL).agg(F.min("day").cast("timestamp").alias("later"))
        touched = touched.join(later, SYMBOL, "left").select(*SYMBOL, "last", F.coalesce("later", F.lit(end)).alias("bound"))
        until = _next_trades(spark, store, touched, oldest, stored, f"{folder}/{number}")
        start = datetime.combine(first, datetime.min.time(), tzinfo=timezone.utc)
        _repair_stretch(spark, store, until, start, utc(until.agg(F.max("until")).first()[0]), intervals)


def _repair_stretch(spark: SparkSession, store: Store, until: DataFrame, start: datetime, end: datetime, intervals) -> None:
    base = schemas.BASE_INTERVAL

    def touched(frame: DataFrame) -> DataFrame:
        return frame.join(until, SYMBOL, "left_semi")

    def write(frame: DataFrame, layer: str, seconds: int = 0) -> None:
        bound = F.timestamp_seconds(F.unix_seconds("until") + seconds)
        write_layer(frame.join(until, SYMBOL).where(F.col("bar_time") < bound).drop("until"), store, LAYERS[layer])

    raw = {c: touched(read_layer(spark, store, name, start=start, end=end)) for c, name in RAW_TABLES.items()}
    write(time_bars(raw, base, start, end, seed=touched(last_closes(spark, store, start))), "sample")
    for i in sorted(set(intervals)):
        floor = lambda t, up=0, i=i: EPOCH + timedelta(seconds=(int((t - EPOCH).total_seconds()) + up) // i * i)
        first, stop = floor(start), floor(end, i - 1)
        if i != base:
            write(layer_frame(spark, store, raw, Step("sample", i, first, stop)), "sample")
        # features look back and labels use past volatility: bars behind the stretch change too
        behind = max(LOOKBACK_BARS, LOOKFORWARD_BARS) * i
        for layer in ("feature", "label"):
            step = Step(layer, i, first - timedelta(seconds=LOOKFORWARD_BARS * i), stop + timedelta(seconds=behind))
            write(layer_frame(spark, store, raw, step), layer, behind)


def stream_late_repair(spark: SparkSession, store: Store, checkpoint: str, intervals=(), max_files: int | None = None) -> None:
    """Process the raw rows of all channels that were committed since the checkpoint."""

    def repair(batch: DataFrame, _: int) -> None:
        files: dict[str, list[str]] = {}
        for r in batch.collect():  # names of the new files
            files.setdefault(r["channel"], []).append(r["path"])
        rows = [spark.read.schema(schemas.LAYERS[RAW_TABLES[c]][0]).parquet(*[f"{store.path(RAW_TABLES[c])}/{p}" for p in paths]) for c, paths in files.items()]
        if rows:
            repair_touched(spark, store, reduce(DataFrame.unionByName, [r.select("exchange", "symbol", "timestamp") for r in rows]), intervals)

    streams = [commit_stream(spark, store, channel, max_files) for channel in RAW_TABLES]
    query = reduce(DataFrame.unionByName, streams).writeStream.foreachBatch(repair).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
