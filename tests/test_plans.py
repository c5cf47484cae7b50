"""Plan-shape checks: no Python UDFs, pushdown to the scan, bounded windows."""

from candlewick.operators import bars as B
from candlewick.operators.dataset import dataset_fused
from candlewick.sources import fixtures

from conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_udf_and_pushdown(spark):
    ev = fixtures.read_table(spark, SF_SMALL, "events")
    raw = fixtures.raw_frames(ev)
    s, e = fixtures.data_range(ev)
    grid = B.time_bars(raw, 60, s, e)
    plan = _plan(dataset_fused(grid, 60))
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    scan = _plan(B.trade_bars(raw["trades"], 60, s, e))
    # only the needed event columns are read
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string,value:double,props:string>" in scan


def test_trade_bar_window_is_bounded_by_bar(spark):
    ev = fixtures.read_table(spark, SF_SMALL, "events")
    plan = _plan(B.trade_bars(fixtures.raw_frames(ev)["trades"], 60))
    # the only window partitions by the bar key, over per-second rows
    assert "Window [lag(ms_max" in plan.replace("\n", " ") or "lag(ms_max" in plan


def test_halo_windows_partition_by_chunk_and_no_static_broadcast(spark):
    from candlewick.operators.features import time_bar_features
    from candlewick.session import configure

    from helpers import bars_from_closes

    configure(spark)
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == "-1"
    bars = bars_from_closes(spark, [100.0 + (i % 7) for i in range(300)])
    plan = _plan(time_bar_features(bars, 60, chunk_rows=128))
    windows = [line for line in plan.split("\n") if "Window [" in line]
    # feature windows run per (series, chunk); the only others number rows per time slice
    # (``_ts``: row_number inside a slice, offsets over the small per-slice count table)
    assert any("_part" in line for line in windows)
    assert all("_part" in line or "_ts" in line for line in windows)
    assert "BroadcastHashJoin" not in plan  # initial plan: only AQE may broadcast, from measured sizes


def test_halo_windows_are_dealt_by_chunk_at_run_time(spark):
    from candlewick import schemas
    from candlewick.operators import windows as W
    from pyspark.sql import functions as F

    from helpers import bars_from_closes

    bars = bars_from_closes(spark, [100.0 + (i % 7) for i in range(600)])
    framed, layout = W.series_frame(bars, schemas.SERIES_KEYS, 128, 60, 60)
    df = framed.withColumn("x", F.lead("close", 3).over(layout.window()))
    df.collect()
    final = _plan(df).split("Initial Plan")[0]
    # AQE must not broadcast the bars to the offsets: their partitioning, one task per series, would serve every window
    assert "SortMergeJoin" in final and "BroadcastHashJoin" not in final
    assert any("Exchange hashpartitioning" in line and "_part" in line for line in final.split("\n"))


def test_grid_bars_have_no_join_and_at_most_six_exchanges(spark):
    ev = fixtures.read_table(spark, SF_SMALL, "events")
    s, e = fixtures.data_range(ev)
    plan = _plan(B.time_bars(fixtures.raw_frames(ev), 60, s, e))
    nodes = plan.split("\n")
    assert not any("Join" in n for n in nodes)
    assert sum("Exchange " in n for n in nodes) <= 6
    # fills and links lie inside (symbol, chunk); only the table of chunk closes is ordered by symbol
    windows = [n for n in nodes if "Window [" in n]
    assert len(windows) >= 3 and all("_chunk" in n for n in windows)
