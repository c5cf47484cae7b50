"""Past-only bar features (FEA-1..27).

Every rolling frame is ``ROWS BETWEEN N PRECEDING AND 1 PRECEDING``: the bar
itself is never part of its own statistics.  Undefined values are NULL, never
NaN: a ratio with a zero denominator is 0.0 for point-in-time ratios, a value
that needs the previous bar is NULL on the first bar, and a rolling statistic
is NULL until its frame holds enough inputs (2 for standard deviations and
z-scores, 1 for sums and means), else ``coalesce(x, 0.0)``.

All window expressions share one partitioning (series, or series × halo
chunk) and one ordering, so the plan has a single exchange and sort however
many window stages are stacked.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick import schemas
from candlewick.functions.exprs import fixed_weights, is_finite, parse_utc, ratio, ratio0, time_range
from candlewick.operators import windows
from candlewick.operators.dedupe import latest_version

# Look-back of the feature job in bars, frac-diff orders and lag
# count, and the decimals the weights are printed with.
LOOKBACK_BARS = 61
FRAC_DIFF_ORDERS = (0.4, 0.6)
FRAC_DIFF_LAGS = 5
WEIGHT_DECIMALS = 10
# A frame whose deviation is below this share of its largest value is constant up to rounding.
ROUNDING = 1e-13


def frac_diff_weights(d: float) -> list[float]:
    return [round(w, WEIGHT_DECIMALS) for w in fixed_weights(d, FRAC_DIFF_LAGS)]


def lookback_start(start, interval_sec: int, bars: int = LOOKBACK_BARS):
    if not start:
        return None
    return parse_utc(start) - timedelta(seconds=bars * interval_sec)


def _rolling_null(n: Column, need: int, value: Column) -> Column:
    return F.when(n < need, F.lit(None).cast("double")).otherwise(F.coalesce(value, F.lit(0.0)))


def feature_columns(df: DataFrame, layout: windows.SeriesLayout) -> DataFrame:
    """Add all feature columns to a bar frame laid out by ``layout``."""
    w = layout.window()

    def past(n: int):
        return w.rowsBetween(-n, -1)

    # stage 1: previous-bar values and close lags for fractional differencing
    s1 = df.select(
        "*",
        F.lag("close", 1).over(w).alias("_prev_close"),
        F.lag("open_interest_close", 1).over(w).alias("_prev_oi_close"),
        F.lag("has_open_interest_data", 1, 0).over(w).alias("_prev_has_oi"),
        *[F.lag("close", k, 0.0).over(w).alias(f"_close_l{k}") for k in range(1, FRAC_DIFF_LAGS + 1)],
    )
    pc = F.col("_prev_close")
    both_oi = (F.col("has_open_interest_data") == 1) & (F.col("_prev_has_oi") == 1)
    oi_delta = F.col("open_interest_close") - F.col("_prev_oi_close")

    def frac(d: float) -> Column:
        ws = frac_diff_weights(d)
        expr = F.lit(ws[0]) * F.col("close")
        for k in range(1, FRAC_DIFF_LAGS + 1):
            expr = expr + F.lit(ws[k]) * F.col(f"_close_l{k}")
        return expr

    s2 = s1.select(
        "*",
        F.when(pc.isNotNull(), F.coalesce(F.ln(ratio("close", pc)), F.lit(0.0))).alias("log_return"),
        ratio0(F.col("close") - F.col("open"), "open").alias("co_return"),
        ratio0(F.col("high") - F.col("low"), "close").alias("hl_range"),
        F.when(F.col("high") == F.col("low"), F.lit(0.5))
        .otherwise((F.col("close") - F.col("low")) / (F.col("high") - F.col("low")))
        .alias("close_position"),
        F.when(pc.isNotNull(), ratio0(F.col("open") - pc, pc)).alias("gap_return"),
        ratio0("buy_volume", "volume").alias("buy_ratio"),
        (F.col("buy_volume") - F.col("sell_volume")).alias("delta_volume"),
        ratio0("volume", "trade_count").alias("avg_trade_size"),
        F.lit(None).cast("double").alias("large_trade_pct"),
        ratio0(F.col("close") - F.col("vwap"), "vwap").alias("close_vwap_bias"),
        F.col("avg_spread_bps").alias("spread_bps"),
        F.col("avg_imbalance_top1").alias("imbalance_top1"),
        F.col("avg_imbalance_top5").alias("imbalance_top5"),
        ratio0("avg_top5_bid_depth", "avg_top5_ask_depth").alias("depth_ratio_5"),
        ratio0(F.col("avg_microprice") - F.col("avg_mid_price"), "avg_mid_price").alias("microprice_bias"),
        F.col("ob_snapshot_count").cast("double").alias("ob_quality"),
        F.when(both_oi, oi_delta).otherwise(F.lit(0.0)).alias("oi_change"),
        F.when(both_oi, ratio0(oi_delta, "_prev_oi_close")).otherwise(F.lit(0.0)).alias("oi_change_pct"),
        ratio0(F.col("liq_buy_volume") - F.col("liq_sell_volume"), F.col("liq_buy_volume") + F.col("liq_sell_volume")).alias("liq_imbalance"),
        ratio0("liq_count", "trade_count").alias("liq_intensity"),
        ratio0(F.col("liq_buy_volume") + F.col("liq_sell_volume"), "volume").alias("liq_volume_pct"),
        F.hour("bar_time").alias("hour_of_day"),
        (F.weekday("bar_time") + 1).alias("day_of_week"),
        frac(FRAC_DIFF_ORDERS[0]).alias("frac_diff_0_4"),
        frac(FRAC_DIFF_ORDERS[1]).alias("frac_diff_0_6"),
    )

    # stage 2: previous log return
    s3 = s2.withColumn("_prev_lr", F.lag("log_return", 1).over(w))
    lr = F.col("log_return")
    plr = F.col("_prev_lr")
    pair = lr.isNotNull() & plr.isNotNull()
    s3 = s3.select(
        "*",
        F.when(lr.isNotNull(), lr * F.col("signed_sqrt_dollar_volume")).alias("_kx"),
        F.when(lr.isNotNull(), F.col("signed_sqrt_dollar_volume") * F.col("signed_sqrt_dollar_volume")).alias("_kxx"),
        F.when(pair, lr).alias("_ax"),
        F.when(pair, plr).alias("_ay"),
        F.abs("delta_volume").alias("_adv"),
    )

    def stdev(c: str, n: int) -> Column:
        return _rolling_null(F.count(c).over(past(n)), 2, F.stddev_samp(c).over(past(n)))

    def zscore(c: str, n: int) -> Column:
        fr = past(n)
        z = (F.col(c) - F.avg(c).over(fr)) / F.when(F.stddev_samp(c).over(fr) != 0, F.stddev_samp(c).over(fr))
        return _rolling_null(F.count(c).over(fr), 2, z)

    def vpin(n: int) -> Column:
        fr = past(n)
        return _rolling_null(F.count("volume").over(fr), 1, ratio(F.sum("_adv").over(fr), F.sum("volume").over(fr)))

    def autocorr(n: int) -> Column:
        # Central moments (stable); a series that doesn't vary has none.  "Doesn't vary" is
        # judged against the rounding of its own values, not against a fixed size.
        fr = past(n)
        x, y = F.stddev_samp("_ax").over(fr), F.stddev_samp("_ay").over(fr)

        def varies(c: str, sd: Column) -> Column:
            return sd > F.max(F.abs(F.col(c))).over(fr) * F.lit(ROUNDING)

        r = F.covar_samp("_ax", "_ay").over(fr) / (x * y)
        return F.when((F.count("_ax").over(fr) >= 2) & varies("_ax", x) & varies("_ay", y), r)

    f20 = past(20)
    s4 = s3.select(
        "*",
        stdev("log_return", 5).alias("realized_vol_5"),
        stdev("log_return", 20).alias("realized_vol_20"),
        stdev("log_return", 60).alias("realized_vol_60"),
        zscore("volume", 20).alias("volume_zscore_20"),
        _rolling_null(F.count("volume").over(past(5)), 1, ratio(F.avg("volume").over(past(5)), F.avg("volume").over(f20))).alias("volume_ratio_5_20"),
        _rolling_null(F.count("log_return").over(f20), 1, ratio(F.sum("_kx").over(f20), F.sum("_kxx").over(f20))).alias("kyle_lambda_approx"),
        vpin(5).alias("vpin_5"),
        vpin(10).alias("vpin_10"),
        vpin(20).alias("vpin_20"),
        zscore("oi_change", 20).alias("oi_zscore_20"),
        autocorr(5).alias("autocorrelation_5"),
        autocorr(20).alias("autocorrelation_20"),
    )
    rv5 = F.col("realized_vol_5")
    rv20 = F.col("realized_vol_20")
    return s4.select(
        "*",
        F.when(rv5.isNotNull() & rv20.isNotNull(), ratio0(rv5, rv20)).alias("vol_ratio_5_20"),
        F.when(lr.isNotNull(), ratio0(F.abs(lr), "turnover")).alias("amihud_illiquidity"),
        (lr - plr).alias("price_acceleration"),
    )


def time_bar_features(
    bars: DataFrame,
    interval_sec: int,
    start=None,
    end=None,
    chunk_rows: int | None = windows.DEFAULT_CHUNK_ROWS,
) -> DataFrame:
    """Feature layer for one interval over [start, end).

    Reads bars from 61 bars (in time) before ``start`` so the first output bar
    has its full history, then filters the output back to [start, end).
    """
    b = bars.filter(F.col("bar_interval_sec") == int(interval_sec))
    base = time_range("bar_time", lookback_start(start, interval_sec), end)
    if base is not None:
        b = b.filter(base)
    if "_version" in b.columns:
        b = latest_version(b, schemas.KEY_COLUMNS)
    framed, layout = windows.series_frame(b, schemas.SERIES_KEYS, chunk_rows, back=LOOKBACK_BARS, fwd=0)
    out = windows.own_rows(feature_columns(framed, layout), layout)
    target = time_range("bar_time", start, end)
    if target is not None:
        out = out.filter(target)
    return schemas.conform(out, schemas.FEATURES)


def feature_window_ready(prefix: str = "") -> Column:
    cols = ["realized_vol_20", "realized_vol_60", "volume_zscore_20", "oi_zscore_20"]
    cond = None
    for c in cols:
        term = is_finite(F.col(prefix + c))
        cond = term if cond is None else cond & term
    return cond
