"""Future-only bar labels (LAB-1..14), including the triple-barrier signal.

Forward frames are ``ROWS BETWEEN 1 FOLLOWING AND N FOLLOWING``; the
historical volatility that scales thresholds and barriers uses the 60 bars
before the current one.  The job reads ``lookback_bars`` before ``start`` and
60 bars past ``end`` so results do not depend on where a batch starts or ends.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick import schemas
from candlewick.functions.exprs import flag, parse_utc, ratio, ratio0, sign3, time_range
from candlewick.operators import windows
from candlewick.operators.dedupe import latest_version

# Look-ahead bars, forward horizons, the volatility multipliers
# of the two thresholds, and the barrier horizon.
LOOKFORWARD_BARS = 60
HIST_VOL_BARS = 60
HORIZONS = (1, 5, 10, 20, 60)
THRESHOLD_5 = 0.5
THRESHOLD_10 = 0.7
BARRIER_BARS = 20


def label_columns(df: DataFrame, layout: windows.SeriesLayout) -> DataFrame:
    w = layout.window()

    def ahead(n: int):
        return w.rowsBetween(1, n)

    s1 = df.select(
        "*",
        *[F.lead("close", h).over(w).alias(f"_c{h}") for h in HORIZONS],
        F.count(F.lit(1)).over(ahead(LOOKFORWARD_BARS)).alias("_fwd_n"),
        F.max("high").over(ahead(5)).alias("_h5"),
        F.min("low").over(ahead(5)).alias("_l5"),
        F.max("high").over(ahead(10)).alias("_h10"),
        F.min("low").over(ahead(10)).alias("_l10"),
        F.collect_list("high").over(ahead(BARRIER_BARS)).alias("_hs"),
        F.collect_list("low").over(ahead(BARRIER_BARS)).alias("_ls"),
    )
    close = F.col("close")

    def fwd(c: str) -> Column:
        return ratio(c, close) - 1

    s2 = s1.select(
        "*",
        fwd("_c1").alias("_nbr"),
        *[fwd(f"_c{h}").alias(f"fwd_return_{h}") for h in HORIZONS],
    )
    s3 = s2.select(
        "*",
        F.stddev_samp("_nbr").over(w.rowsBetween(-HIST_VOL_BARS, -1)).alias("_hist_vol"),
        F.stddev_samp("_nbr").over(w.rowsBetween(0, 4)).alias("fwd_realized_vol_5"),
    )
    hv = F.col("_hist_vol")
    thr5 = F.coalesce(hv * THRESHOLD_5, F.lit(0.0))
    thr10 = F.coalesce(hv * THRESHOLD_10, F.lit(0.0))
    up5 = F.greatest(ratio("_h5", close) - 1, F.lit(0.0))
    down5 = F.greatest(1 - ratio("_l5", close), F.lit(0.0))
    up10 = F.greatest(ratio("_h10", close) - 1, F.lit(0.0))
    down10 = F.greatest(1 - ratio("_l10", close), F.lit(0.0))
    s4 = s3.select(
        "*",
        sign3("fwd_return_5").alias("fwd_direction_5"),
        sign3("fwd_return_10").alias("fwd_direction_10"),
        thr5.alias("label_threshold_5"),
        thr10.alias("label_threshold_10"),
        up5.alias("fwd_max_up_5"),
        down5.alias("fwd_max_down_5"),
        up10.alias("_up10"),
        down10.alias("_down10"),
        ratio0(F.col("_h5") - F.col("_l5"), close).alias("fwd_range_5"),
        F.array_position(F.transform("_hs", lambda h: h >= close * (1 + thr10)), True).alias("_up_hit"),
        F.array_position(F.transform("_ls", lambda lo: lo <= close * (1 - thr10)), True).alias("_down_hit"),
    )
    d5 = F.col("fwd_direction_5")
    d10 = F.col("fwd_direction_10")
    u = F.col("_up_hit")
    d = F.col("_down_hit")

    def excursion(direction: Column, pos: str, neg: str) -> Column:
        return F.when(direction > 0, F.col(pos)).when(direction < 0, F.col(neg)).otherwise(F.lit(0.0))

    return s4.select(
        "*",
        sign3("fwd_return_5", F.col("label_threshold_5")).alias("fwd_label_3class_5"),
        sign3("fwd_return_10", F.col("label_threshold_10")).alias("fwd_label_3class_10"),
        excursion(d5, "fwd_max_down_5", "fwd_max_up_5").alias("mae_5"),
        excursion(d10, "_down10", "_up10").alias("mae_10"),
        excursion(d5, "fwd_max_up_5", "fwd_max_down_5").alias("mfe_5"),
        excursion(d10, "_up10", "_down10").alias("mfe_10"),
        F.when((u > 0) & ((d == 0) | (u <= d)), F.lit(1))
        .when((d > 0) & ((u == 0) | (d < u)), F.lit(-1))
        .otherwise(F.lit(0))
        .alias("triple_barrier_signal"),
        flag((F.col("_fwd_n") == LOOKFORWARD_BARS) & F.col("_c60").isNotNull()).alias("is_valid"),
    )


def label_read_range(start, end, interval_sec: int, lookback_bars: int = HIST_VOL_BARS):
    lo = parse_utc(start) - timedelta(seconds=lookback_bars * interval_sec) if start else None
    hi = parse_utc(end) + timedelta(seconds=LOOKFORWARD_BARS * interval_sec) if end else None
    return lo, hi


def time_bar_labels(
    bars: DataFrame,
    interval_sec: int,
    start=None,
    end=None,
    lookback_bars: int = HIST_VOL_BARS,
    chunk_rows: int | None = windows.DEFAULT_CHUNK_ROWS,
) -> DataFrame:
    """Label layer for one interval over [start, end)."""
    b = bars.filter(F.col("bar_interval_sec") == int(interval_sec))
    lo, hi = label_read_range(start, end, interval_sec, lookback_bars)
    base = time_range("bar_time", lo, hi)
    if base is not None:
        b = b.filter(base)
    if "_version" in b.columns:
        b = latest_version(b, schemas.KEY_COLUMNS)
    framed, layout = windows.series_frame(b, schemas.SERIES_KEYS, chunk_rows, back=HIST_VOL_BARS, fwd=LOOKFORWARD_BARS)
    out = windows.own_rows(label_columns(framed, layout), layout)
    target = time_range("bar_time", start, end)
    if target is not None:
        out = out.filter(target)
    return schemas.conform(out, schemas.LABELS)
