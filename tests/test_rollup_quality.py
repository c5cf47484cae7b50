from pyspark.sql import functions as F

from candlewick import schemas
from candlewick.operators.dedupe import latest_version
from candlewick.operators.rollup import rollup_bars
from candlewick.plans import quality as QC

from helpers import bars_from_closes, collect_sorted


def test_rollup_complete_partial_and_sums(spark):
    bars = bars_from_closes(spark, [100.0 + i for i in range(13)], start="2026-03-02T00:00:00")
    r = collect_sorted(rollup_bars(bars, 300), "bar_time")
    assert [x["is_time_bar_complete"] for x in r] == [1, 1, 0]  # 5, 5, 3 source bars: partial kept
    total = bars.agg(F.sum("volume")).first()[0]
    assert abs(sum(x["volume"] for x in r) - total) < 1e-9
    assert r[0]["open"] == 100.0 and r[0]["close"] == 104.0


def test_rollup_funding_skips_null_and_weighted_means(spark):
    bars = bars_from_closes(spark, [10.0] * 5)
    r = rollup_bars(bars, 300).first()
    # funding present on bars 0 and 4 only; last non-null wins
    assert abs(r["funding_rate"] - 0.0004) < 1e-15
    counts = [i % 3 for i in range(5)]
    means = [1.0 + (i % 5) for i in range(5)]
    expect = sum(c * m for c, m in zip(counts, means)) / sum(counts)
    assert abs(r["avg_spread_bps"] - expect) < 1e-12


def test_latest_version_wins_before_rollup(spark):
    v1 = bars_from_closes(spark, [10.0] * 5).withColumn("_version", F.lit(1).cast("long")).withColumn("_run_id", F.lit("a"))
    v2 = bars_from_closes(spark, [20.0] * 5).withColumn("_version", F.lit(2).cast("long")).withColumn("_run_id", F.lit("b"))
    latest = latest_version(v1.unionByName(v2), schemas.KEY_COLUMNS)
    assert latest.count() == 5 and latest.filter("close = 20.0").count() == 5
    assert rollup_bars(v1.unionByName(v2), 300).first()["close"] == 20.0


def test_rollup_gap_check(spark):
    bars = bars_from_closes(spark, [1.0] * 13)
    gaps = QC.rollup_gaps(bars, 300).collect()
    assert len(gaps) == 1 and gaps[0]["source_bar_count"] == 3
    try:
        QC.rollup_gaps(bars, 60)
        raise AssertionError("expected ValueError")
    except ValueError:
        pass


def test_latest_symbols_by_updated_at(spark):
    from datetime import date, datetime, timezone

    from candlewick.operators.dedupe import latest_symbols

    def row(tick, ts):
        return ("X", "BTC", "BTC", "USDT", "perp", tick, 0.001, date(2020, 1, 1), 1, 0.0, datetime(2026, 1, ts, tzinfo=timezone.utc))

    df = spark.createDataFrame([row(0.1, 1), row(0.5, 3), row(0.2, 2)], schemas.META_SYMBOLS)
    out = latest_symbols(df).collect()
    assert len(out) == 1 and out[0]["tick_size"] == 0.5


def test_dataset_row_count_filters_both_sides(spark):
    from candlewick.plans.quality import dataset_row_count

    rows = [("X", s, i, f"2031-01-0{d} 00:00:00", 1) for s in "AB" for i in (60, 300) for d in (1, 2, 3)]
    both = spark.createDataFrame(rows, "exchange string, symbol string, bar_interval_sec int, bar_time string, is_valid int")
    both = both.withColumn("bar_time", F.col("bar_time").cast("timestamp"))
    got = dataset_row_count(both.withColumnRenamed("is_valid", "label_is_valid"), both, 300, "2031-01-02", "2031-01-04", symbol="B").first()
    assert tuple(got) == (2, 2, 0)
