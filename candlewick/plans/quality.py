"""Data-quality and reconciliation checks (QC-1..5).

Each check is a DataFrame over the layers.  Scalar checks are one global
aggregation (partial aggregation on every task, one tiny final stage); the
dataset row-count check counts both sides in one pass over a tagged union
instead of cross-joining two scalar subqueries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick import schemas
from candlewick.functions.exprs import bucket_start, time_range
from candlewick.operators.dedupe import latest_version
from candlewick.operators.rollup import source_minutes

KEYS3 = ["exchange", "symbol", "bar_time"]


def _filters(df: DataFrame, column: str, start, end, exchange, symbol) -> DataFrame:
    cond = time_range(column, start, end)
    if cond is not None:
        df = df.filter(cond)
    if exchange:
        df = df.filter(F.col("exchange") == exchange)
    if symbol:
        df = df.filter(F.col("symbol") == symbol)
    return df


def trade_count_reconciliation(trades: DataFrame, bars: DataFrame, start=None, end=None, exchange=None, symbol=None) -> DataFrame:
    """QC-1: raw trades per minute vs bar trade_count; rows that differ, ordered."""
    raw = (
        _filters(trades, "timestamp", start, end, exchange, symbol)
        .groupBy("exchange", "symbol", bucket_start(F.col("timestamp"), 60).alias("bar_time"))
        .agg(F.count(F.lit(1)).alias("raw_trade_count"))
    )
    b = _filters(bars.filter(F.col("bar_interval_sec") == 60), "bar_time", start, end, exchange, symbol)
    if "_version" in b.columns:
        b = latest_version(b, schemas.KEY_COLUMNS)
    counted = (
        b.groupBy(*KEYS3)
        .agg(F.sum("trade_count").alias("bar_trade_count"))
    )
    j = raw.join(counted, KEYS3, "full_outer")
    rc = F.coalesce(F.col("raw_trade_count"), F.lit(0).cast("long"))
    bc = F.coalesce(F.col("bar_trade_count"), F.lit(0).cast("long"))
    return (
        j.select(*KEYS3, rc.alias("raw_trade_count"), bc.alias("bar_trade_count"), (rc - bc).alias("trade_count_delta"))
        .filter(F.col("raw_trade_count") != F.col("bar_trade_count"))
        .orderBy(*KEYS3)
    )


def rollup_gaps(bars: DataFrame, interval_sec: int, start=None, end=None, exchange=None, symbol=None) -> DataFrame:
    """QC-2: rollup buckets whose 60 s source count is not interval/60."""
    multiple = schemas.validate_interval(interval_sec, rolled_up=True) // schemas.BASE_INTERVAL
    src = source_minutes(bars, start, end, exchange, symbol)
    return (
        src.groupBy("exchange", "symbol", bucket_start(F.col("bar_time"), interval_sec).alias("rollup_bar_time"))
        .agg(F.count(F.lit(1)).alias("source_bar_count"))
        .filter(F.col("source_bar_count") != multiple)
        .orderBy("exchange", "symbol", "rollup_bar_time")
    )


def feature_quality(features: DataFrame, interval_sec: int, start=None, end=None, exchange=None, symbol=None) -> DataFrame:
    """QC-3: NULL / non-finite / out-of-range counts over the feature layer."""
    f = _filters(features.filter(F.col("bar_interval_sec") == int(interval_sec)), "bar_time", start, end, exchange, symbol)
    if "_version" in f.columns:
        f = latest_version(f, schemas.KEY_COLUMNS)

    def bad(c: str, name: str):
        col = F.col(c)
        return F.count_if(F.isnan(col) | (F.abs(col) == F.lit(float("inf")))).alias(name)

    return f.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.col("log_return").isNull()).alias("log_return_null"),
        F.count_if(F.col("realized_vol_20").isNull()).alias("realized_vol_20_null"),
        bad("realized_vol_20", "realized_vol_20_bad_rows"),
        bad("volume_zscore_20", "volume_zscore_20_bad_rows"),
        bad("autocorrelation_5", "autocorrelation_5_bad_rows"),
        bad("autocorrelation_20", "autocorrelation_20_bad_rows"),
        bad("oi_zscore_20", "oi_zscore_20_bad_rows"),
        bad("kyle_lambda_approx", "kyle_lambda_bad"),
        bad("amihud_illiquidity", "amihud_bad"),
        bad("vol_ratio_5_20", "vol_ratio_bad"),
        F.count_if((F.col("buy_ratio") < 0) | (F.col("buy_ratio") > 1)).alias("buy_ratio_out_of_range"),
        F.count_if((F.col("close_position") < 0) | (F.col("close_position") > 1)).alias("close_position_out_of_range"),
        F.count_if(F.abs(F.col("log_return")) > 0.5).alias("extreme_return_count"),
        F.count_distinct(F.coalesce(F.col("large_trade_pct"), F.lit(-1.0))).alias("large_trade_pct_distinct_values"),
    )


def label_quality(labels: DataFrame, interval_sec: int, start=None, end=None, exchange=None, symbol=None) -> DataFrame:
    """QC-4: row count, invalid count, first / last invalid bar time (NULL if none)."""
    lab = _filters(labels.filter(F.col("bar_interval_sec") == int(interval_sec)), "bar_time", start, end, exchange, symbol)
    if "_version" in lab.columns:
        lab = latest_version(lab, schemas.KEY_COLUMNS)
    invalid = F.col("is_valid") == 0
    return lab.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(invalid).alias("invalid_row_count"),
        F.min(F.when(invalid, F.col("bar_time"))).alias("first_invalid_bar_time"),
        F.max(F.when(invalid, F.col("bar_time"))).alias("last_invalid_bar_time"),
    )


def dataset_row_count(ds: DataFrame, labels: DataFrame, interval_sec=None, start=None, end=None, exchange=None, symbol=None) -> DataFrame:
    """QC-5: dataset rows with valid labels vs valid label rows, and the delta; both sides under the same filters."""

    def chosen(side: DataFrame, valid: str, mark: int) -> DataFrame:
        if interval_sec is not None:
            side = side.filter(F.col("bar_interval_sec") == int(interval_sec))
        side = _filters(side, "bar_time", start, end, exchange, symbol)
        if "_version" in side.columns:
            side = latest_version(side, schemas.KEY_COLUMNS)
        return side.filter(F.col(valid) == 1).select(F.lit(mark).alias("_d"))

    tagged = chosen(ds, "label_is_valid", 1).unionByName(chosen(labels, "is_valid", 0))
    counts = tagged.agg(
        F.count_if(F.col("_d") == 1).alias("dataset_row_count"),
        F.count_if(F.col("_d") == 0).alias("valid_label_row_count"),
    )
    return counts.select("*", (F.col("dataset_row_count") - F.col("valid_label_row_count")).alias("row_count_delta"))
