"""Message normalisation: feed messages → typed raw rows (SRC-1..5).

Every normaliser is a projection over a DataFrame of messages (batch or
streaming), so it runs inside whole-stage codegen on the executors.  Messages
carry epoch seconds (exact decimal or float), string prices and sizes, and the
order book as price→size maps, as the feed delivers them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick import schemas
from candlewick.functions.exprs import ratio0

# Fixed value: default number of book levels kept per side.
DEFAULT_BOOK_DEPTH = 10


def epoch_to_ts(c: Column) -> Column:
    """Epoch seconds → UTC timestamp (nearest microsecond); falsy (0 / NULL) → NULL."""
    micros = F.round(c.cast("decimal(24,9)") * F.lit(1_000_000)).cast("long")
    return F.when(c.isNotNull() & (c != 0), F.timestamp_micros(micros))


def normalize_trades(msgs: DataFrame) -> DataFrame:
    """SRC-1: trade message → raw.trades row; ``amount`` → quantity, ``id`` → trade_id."""
    price = F.col("price").cast("double")
    quantity = F.col("amount").cast("double")
    out = msgs.select(
        epoch_to_ts(F.col("timestamp")).alias("timestamp"),
        epoch_to_ts(F.col("receipt_timestamp")).alias("receipt_ts"),
        F.col("exchange"),
        F.col("symbol"),
        F.col("side"),
        price.alias("price"),
        quantity.alias("quantity"),
        (price * quantity).alias("notional"),
        F.col("id").cast("string").alias("trade_id"),
    )
    return schemas.conform(out, schemas.RAW_TRADES)


def _levels(c: Column, dtype: T.DataType) -> Column:
    """A book side as array<struct<px,sz>>: from a price→size map or already-parsed levels."""
    if isinstance(dtype, T.MapType):
        return F.transform(
            F.map_entries(c),
            lambda e: F.struct(e["key"].cast("double").alias("px"), e["value"].cast("double").alias("sz")),
        )
    return F.transform(c, lambda e: F.struct(e["px"].cast("double").alias("px"), e["sz"].cast("double").alias("sz")))


def _padded(levels: Column, depth: int, field: str) -> Column:
    values = F.transform(levels, lambda e: e[field])
    return F.concat(values, F.array_repeat(F.lit(0.0), F.lit(depth) - F.size(levels)))


def _prefix_sum(arr: Column, n: int) -> Column:
    return F.aggregate(F.slice(arr, 1, n), F.lit(0.0), lambda acc, x: acc + x)


def normalize_book(msgs: DataFrame, depth: int = DEFAULT_BOOK_DEPTH) -> DataFrame:
    """SRC-2 / SRC-2a: book message → top-``depth`` arrays and level statistics.

    Payload = ``book``, else ``delta``, else empty.  Bids sorted by price
    descending, asks ascending, both cut to ``depth`` and zero-padded.
    """
    payload_fields = {f.name: f.dataType for f in msgs.schema.fields}
    side_type = None
    for name in ("book", "delta"):
        if name in payload_fields:
            side_type = payload_fields[name]["bid"].dataType
            break
    if side_type is None:
        raise ValueError("book message needs a 'book' or 'delta' payload column")

    # The payload of a message is its whole book, or else its whole delta.
    payload = F.coalesce(*[F.col(p) for p in ("book", "delta") if p in payload_fields])

    def side(name: str) -> Column:
        return payload[name]

    empty = F.array().cast(T.ArrayType(T.StructType([T.StructField("px", T.DoubleType()), T.StructField("sz", T.DoubleType())])))
    bids = F.slice(F.sort_array(F.coalesce(_levels(side("bid"), side_type), empty), asc=False), 1, depth)
    asks = F.slice(F.sort_array(F.coalesce(_levels(side("ask"), side_type), empty), asc=True), 1, depth)

    levels = msgs.select(
        F.col("exchange"),
        F.col("symbol"),
        epoch_to_ts(F.col("timestamp")).alias("timestamp"),
        epoch_to_ts(F.col("receipt_timestamp")).alias("receipt_ts"),
        bids.alias("_bids"),
        asks.alias("_asks"),
    )
    staged = levels.select(
        "exchange",
        "symbol",
        "timestamp",
        "receipt_ts",
        _padded(F.col("_bids"), depth, "px").alias("bid_px"),
        _padded(F.col("_bids"), depth, "sz").alias("bid_sz"),
        _padded(F.col("_asks"), depth, "px").alias("ask_px"),
        _padded(F.col("_asks"), depth, "sz").alias("ask_sz"),
    )
    bb = F.element_at("bid_px", 1)
    ba = F.element_at("ask_px", 1)
    b1 = F.element_at("bid_sz", 1)
    a1 = F.element_at("ask_sz", 1)
    with_depth = staged.select(
        "*",
        bb.alias("best_bid"),
        ba.alias("best_ask"),
        F.when((bb != 0) & (ba != 0), (bb + ba) / 2).otherwise(F.lit(0.0)).alias("mid_price"),
        _prefix_sum(F.col("bid_sz"), 5).alias("bid_depth_5"),
        _prefix_sum(F.col("bid_sz"), 10).alias("bid_depth_10"),
        _prefix_sum(F.col("ask_sz"), 5).alias("ask_depth_5"),
        _prefix_sum(F.col("ask_sz"), 10).alias("ask_depth_10"),
        (b1 + a1).alias("_top1"),
        b1.alias("_b1"),
        a1.alias("_a1"),
    )
    out = with_depth.select(
        "*",
        (ratio0(F.col("best_ask") - F.col("best_bid"), F.col("mid_price")) * 10000).alias("spread_bps"),
        ratio0(F.col("_b1") * F.col("best_ask") + F.col("_a1") * F.col("best_bid"), F.col("_top1")).alias("microprice"),
        ratio0(F.col("_b1") - F.col("_a1"), F.col("_top1")).alias("imbalance_top1"),
        ratio0(F.col("bid_depth_5") - F.col("ask_depth_5"), F.col("bid_depth_5") + F.col("ask_depth_5")).alias("imbalance_top5"),
        ratio0(F.col("bid_depth_10") - F.col("ask_depth_10"), F.col("bid_depth_10") + F.col("ask_depth_10")).alias("imbalance_top10"),
    )
    return schemas.conform(out, schemas.RAW_BOOK_TOPK)


def normalize_liquidations(msgs: DataFrame) -> DataFrame:
    """SRC-3: liquidation message → raw.liquidations; status defaults to ''."""
    names = set(msgs.columns)
    out = msgs.select(
        epoch_to_ts(F.col("timestamp")).alias("timestamp"),
        epoch_to_ts(F.col("receipt_timestamp")).alias("receipt_ts"),
        F.col("exchange"),
        F.col("symbol"),
        F.col("side"),
        F.col("price").cast("double").alias("price"),
        F.col("quantity").cast("double").alias("quantity"),
        (F.coalesce(F.col("status"), F.lit("")) if "status" in names else F.lit("")).alias("status"),
        (F.col("id").cast("string") if "id" in names else F.lit(None).cast("string")).alias("order_id"),
    )
    return schemas.conform(out, schemas.RAW_LIQUIDATIONS)


def normalize_funding(msgs: DataFrame) -> DataFrame:
    """SRC-4: funding message → raw.funding; falsy mark / predicted rate → NULL."""
    names = set(msgs.columns)

    def optional(name: str) -> Column:
        if name not in names:
            return F.lit(None).cast("double")
        c = F.col(name)
        value = c.cast("double")
        return F.when(c.isNotNull() & (value != 0), value)

    out = msgs.select(
        epoch_to_ts(F.col("timestamp")).alias("timestamp"),
        epoch_to_ts(F.col("receipt_timestamp")).alias("receipt_ts"),
        F.col("exchange"),
        F.col("symbol"),
        optional("mark_price").alias("mark_price"),
        F.col("rate").cast("double").alias("rate"),
        optional("predicted_rate").alias("predicted_rate"),
    )
    return schemas.conform(out, schemas.RAW_FUNDING)


def normalize_open_interest(msgs: DataFrame) -> DataFrame:
    """SRC-5: open-interest message → raw.open_interest."""
    out = msgs.select(
        epoch_to_ts(F.col("timestamp")).alias("timestamp"),
        epoch_to_ts(F.col("receipt_timestamp")).alias("receipt_ts"),
        F.col("exchange"),
        F.col("symbol"),
        F.col("open_interest").cast("double").alias("open_interest"),
    )
    return schemas.conform(out, schemas.RAW_OPEN_INTEREST)


NORMALIZERS = {
    "trades": normalize_trades,
    "book": normalize_book,
    "liquidations": normalize_liquidations,
    "funding": normalize_funding,
    "open_interest": normalize_open_interest,
}
