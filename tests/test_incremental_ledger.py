import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from candlewick import schemas
from candlewick.plans import commits as CM
from candlewick.plans import incremental as INC
from candlewick.plans import ledger as LED
from candlewick.plans import sinks as SNK
from candlewick.session import one_machine, shared_path


EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def test_run_windows_follow_the_definition(spark):
    """Start = lowest mark minus the overlap (given start first, bootstrap last); end = given, or now minus the lag."""
    r = random.Random(17)
    marks = []
    for interval in schemas.VALID_INTERVALS:
        times = [None if r.random() < 0.3 else EPOCH + timedelta(seconds=interval * r.randint(10_000, 20_000)) for _ in range(3)]
        marks.append((interval, *times))
    frame = spark.createDataFrame(marks, "bar_interval_sec int, sample_max timestamp, feature_max timestamp, label_max timestamp")
    now, boot, given = (EPOCH + timedelta(days=d, hours=7) for d in (400_000 // 86, 11, 13))
    for overlap, lag, start, end in ((0, 0, None, None), (7, 45, None, None), (120, 120, given, None), (3, 0, None, given)):
        rows = INC.run_windows(frame, overlap, lag, bootstrap_start=boot, start=start, end=end, now=now).collect()
        for row, (interval, *times) in zip(sorted(rows), sorted(marks, key=lambda m: m[0]), strict=True):
            known = [t for t in times if t]
            want = start or (min(known) - timedelta(seconds=overlap * interval) if known else boot)
            assert row.window_start.replace(tzinfo=timezone.utc) == want
            assert row.window_end.replace(tzinfo=timezone.utc) == (end or now - timedelta(seconds=lag))


def test_windows_without_start_or_length_are_refused(spark):
    marks = spark.createDataFrame([(60, None, None, None)], "bar_interval_sec int, sample_max timestamp, feature_max timestamp, label_max timestamp")
    with pytest.raises(INC.WindowError, match="bootstrap"):
        INC.checked_windows(INC.run_windows(marks))
    with pytest.raises(INC.WindowError, match="empty"):
        INC.checked_windows(INC.run_windows(marks, start="2031-05-07", end="2031-05-07"))
    with pytest.raises(INC.WindowError):
        INC.run_windows(marks, overlap_bars=-1)


def test_plans_run_inputs_before_what_needs_them():
    r = random.Random(4)
    for _ in range(30):
        intervals = r.sample(schemas.VALID_INTERVALS, r.randint(1, 5))
        spans = {i: (EPOCH + timedelta(hours=r.randint(0, 50)), EPOCH + timedelta(hours=r.randint(60, 90))) for i in intervals}
        steps = INC.plan(spans)
        assert steps[0][:2] == ("sample", 60) and steps[-1].layer == "dataset"
        assert steps[0].start == min(s for s, _ in spans.values()) and steps[0].end == max(e for _, e in spans.values())
        at = {step[:2]: k for k, step in enumerate(steps)}
        for i, span in spans.items():
            assert at["sample", i] < min(at["feature", i], at["label", i])
            assert steps[at["feature", i]][2:] == steps[at["label", i]][2:] == span
        assert len(at) == len(steps) == 1 + sum(i != 60 for i in intervals) + 2 * len(intervals) + 1
    same = INC.plan_range([900], "2031-01-05", "2031-01-06", refresh_dataset=False)
    assert [s.layer for s in same] == ["sample", "sample", "feature", "label"]
    assert INC.parse_intervals("60, 900,") == [60, 900]


def executed(frame):
    return frame._jdf.queryExecution().executedPlan().toString()  # before it runs: the initial plan alone


def test_reads_prune_and_deduplicate_once(spark):
    from helpers import bars_from_closes

    store = SNK.Store(shared_path(spark, "test_prune", unique=True))
    SNK.write_layer(bars_from_closes(spark, [1.0] * 4), store, "sample.bars_time", version=1)
    SNK.write_layer(bars_from_closes(spark, [2.0] * 4), store, "sample.bars_time", version=2)
    # another month, where no other commit has a row
    SNK.write_layer(bars_from_closes(spark, [5.0] * 4, start="2026-04-02T00:00:00"), store, "sample.bars_time", version=3)
    read = SNK.read_layer(spark, store, "sample.bars_time", start="2026-03-02T00:01:00Z", end="2026-03-02T00:03:00Z", interval_sec=60)
    plan = executed(read)
    assert "_version" not in read.columns and {r.close for r in read.collect()} == {2.0} and read.count() == 2
    scans = [line for line in plan.split("\n") if "FileScan parquet" in line]
    assert len(scans) == 1 and plan.count("Exchange") == 1 and "Join" not in plan
    assert "ym" in scans[0].split("PartitionFilters:")[1].split("]")[0]
    assert "GreaterThanOrEqual(bar_time" in scans[0].split("PushedFilters:")[1]
    # files that no other commit overlaps pass through
    whole = executed(SNK.read_layer(spark, store, "sample.bars_time"))
    assert whole.count("FileScan parquet") == 2 and whole.count("Exchange") == 1
    april = executed(SNK.read_layer(spark, store, "sample.bars_time", start="2026-04-01T00:00:00Z"))
    assert april.count("FileScan parquet") == 1 and "Exchange" not in april
    assert SNK.compact_layer(spark, store, "sample.bars_time") >= 2
    compacted = SNK.read_layer(spark, store, "sample.bars_time")
    assert "Exchange" not in executed(compacted) and sorted(r.close for r in compacted.collect()) == [2.0] * 4 + [5.0] * 4


def test_compaction_interrupted_or_overtaken(spark, monkeypatch):
    from helpers import bars_from_closes

    store = SNK.Store(shared_path(spark, "test_compact", unique=True))
    for version in (1, 2):
        SNK.write_layer(bars_from_closes(spark, [float(version)] * 4), store, "sample.bars_time", version=version)
    log = SNK.log_of(spark, store, "sample.bars_time")
    commit = CM.Log.commit

    def crash(self, *args, **more):
        raise RuntimeError("lost the driver")

    # the new files are written, but never committed: nothing changes
    monkeypatch.setattr(CM.Log, "commit", crash)
    with pytest.raises(RuntimeError, match="lost"):
        SNK.compact_layer(spark, store, "sample.bars_time")
    monkeypatch.setattr(CM.Log, "commit", commit)
    assert SNK.read_layer(spark, store, "sample.bars_time", latest=False).count() == 8
    assert [r.close for r in SNK.read_layer(spark, store, "sample.bars_time").collect()] == [2.0] * 4

    # rows that another run appends while it works stay
    def append_first(self, *args, **more):
        monkeypatch.setattr(CM.Log, "commit", commit)
        SNK.write_layer(bars_from_closes(spark, [9.0] * 6), store, "sample.bars_time", version=3)
        return commit(self, *args, **more)

    monkeypatch.setattr(CM.Log, "commit", append_first)
    assert SNK.compact_layer(spark, store, "sample.bars_time") >= 2
    assert SNK.read_layer(spark, store, "sample.bars_time", latest=False).count() == 10
    assert [r.close for r in SNK.read_layer(spark, store, "sample.bars_time").collect()] == [9.0] * 6

    # two compactions of the same files: the later one commits nothing
    def compact_first(self, *args, **more):
        monkeypatch.setattr(CM.Log, "commit", commit)
        SNK.compact_layer(spark, store, "sample.bars_time")
        return commit(self, *args, **more)

    monkeypatch.setattr(CM.Log, "commit", compact_first)
    with pytest.raises(CM.CommitConflict):
        SNK.compact_layer(spark, store, "sample.bars_time")
    assert [r.close for r in SNK.read_layer(spark, store, "sample.bars_time", latest=False).collect()] == [9.0] * 6
    # files of no commit go, those that are read stay
    assert SNK.vacuum(spark, store, "sample.bars_time") == 0
    assert SNK.vacuum(spark, store, "sample.bars_time", keep_hours=0) > 0
    assert SNK.read_layer(spark, store, "sample.bars_time").count() == 6
    assert log.newest() == log.entries().agg(F.max("seq")).first()[0]


def test_log_snapshots_and_racing_commits(spark, monkeypatch):
    monkeypatch.setattr(CM, "SNAPSHOT_EVERY", 4)
    log = CM.Log(spark, shared_path(spark, "test_log", unique=True))
    log.create()
    live = set()
    for k in range(11):
        removed = {f"f{k - 3}"} if k % 3 == 0 and k else set()
        assert log.commit([{"path": f"f{k}", "n_rows": k}], removed=removed, tag=f"t{k}") == k + 1
        live = (live | {f"f{k}"}) - removed
        assert {r.path for r in log.files().collect()} == live
    assert log._numbers("snapshots") == [4, 8] and all(log.tagged(f"t{k}") for k in range(11))
    assert log.commit([{"path": "again"}], tag="t2") is None and log.newest() == 11
    # a writer that takes the number first makes the other one take the next
    put = CM.Log._put

    def overtaken(self, number, text):
        monkeypatch.setattr(CM.Log, "_put", put)
        assert log.commit([{"path": "first"}]) == number
        return put(self, number, text)

    monkeypatch.setattr(CM.Log, "_put", overtaken)
    assert log.commit([{"path": "second"}]) == 13
    assert {"first", "second"} <= {r.path for r in log.files().collect()}


def test_landing_goes_on_and_batches_join_streams(spark, tmp_path):
    """Two sources in two calls and a batch append give all rows; a repeated call gives none."""
    from conftest import SF_SMALL

    from candlewick.sources import fixtures
    from candlewick.streaming import bars as STR

    events = fixtures.read_table(spark, SF_SMALL, "events")
    third = F.pmod(F.col("event_id"), F.lit(3))
    for k in (0, 1):
        events.filter(third == k).coalesce(1).write.parquet(str(tmp_path / f"s{k}" / "events.parquet"))
    store = SNK.Store(shared_path(spark, "test_landing", unique=True))
    landed = lambda: SNK.read_layer(spark, store, "raw.trades")
    sizes = [events.filter(third == k).count() for k in range(3)]
    source = [str(tmp_path / f"s{k}" / "events.parquet") for k in (0, 1)]
    STR.land_stream(spark, source[0], store, ["trades"])
    assert landed().count() == sizes[0]
    STR.land_stream(spark, source[1], store, ["trades"])
    assert landed().count() == sizes[0] + sizes[1]
    STR.land_stream(spark, source[1], store, ["trades"])
    assert landed().count() == sizes[0] + sizes[1]
    SNK.land_raw({"trades": fixtures.raw_frames(events.filter(third == 2))["trades"]}, store)
    assert landed().exceptAll(fixtures.raw_frames(events)["trades"]).isEmpty() and landed().count() == sum(sizes)
    # new files of a known source
    events.filter(third == 2).limit(7).coalesce(1).write.mode("append").parquet(source[0])
    STR.land_stream(spark, source[0], store, ["trades"], symbols=["click"])
    assert landed().count() == sum(sizes) + events.filter(third == 2).limit(7).filter("event_type = 'click'").count()


def test_a_repeated_batch_is_committed_once(spark):
    from conftest import SF_SMALL

    from candlewick.sources import fixtures

    store = SNK.Store(shared_path(spark, "test_tag", unique=True))
    rows = fixtures.load_raw(spark, SF_SMALL)["funding"]
    assert SNK.write_layer(rows, store, "raw.funding", tag="query/0") == rows.count()
    assert SNK.write_layer(rows, store, "raw.funding", tag="query/0") == 0
    assert SNK.write_layer(rows.limit(0), store, "raw.funding", tag="query/1") == 0
    assert SNK.read_layer(spark, store, "raw.funding").count() == rows.count()


def test_seed_closes_read_one_month_of_bars(spark):
    """Closes before a time, also from months ago, after re-runs, and where a commit's closes are missing."""
    from helpers import bars_from_closes

    store = SNK.Store(shared_path(spark, "test_closes", unique=True))
    put = lambda closes, start, **more: SNK.write_layer(bars_from_closes(spark, closes, start=start, **more), store, "sample.bars_time")
    put([1.0, 2.0], "2026-01-31T23:58:00", symbol="OLD")
    put([3.0, 4.0, 5.0], "2026-02-28T23:57:00", symbol="MID")
    put([6.0, 7.0, 8.0], "2026-02-28T23:57:00", symbol="MID")  # a re-run
    put([9.0], "2026-02-28T23:57:00", symbol="MID")  # a later run over an earlier bar alone
    put([10.0, 11.0, 12.0], "2026-03-02T00:00:00", symbol="NEW")

    def closes(before):
        return {r.symbol: r.close for r in SNK.last_closes(spark, store, before).collect()}

    assert closes("2026-03-02T00:02:00Z") == {"OLD": 2.0, "MID": 8.0, "NEW": 11.0}
    assert closes("2026-02-28T23:59:00Z") == {"OLD": 2.0, "MID": 7.0} and closes("2026-01-31T23:58:00Z") == {}
    files = SNK.last_closes(spark, store, "2026-03-02T00:02:00Z").inputFiles()
    assert {f.split("ym=")[1][:6] for f in files if "bars_time" in f} == {"202603"}
    # a commit of bars whose closes were never written
    write_closes = SNK.write_closes
    SNK.write_closes = lambda *args: None
    try:
        put([20.0, 21.0], "2026-02-28T23:58:00", symbol="MID")
    finally:
        SNK.write_closes = write_closes
    assert closes("2026-03-02T00:02:00Z") == {"OLD": 2.0, "MID": 21.0, "NEW": 11.0}
    SNK.compact_layer(spark, store, "sample.bars_time")
    assert closes("2026-03-02T00:02:00Z") == {"OLD": 2.0, "MID": 21.0, "NEW": 11.0}


def test_backfill_goes_on_after_a_failure(spark, monkeypatch):
    from conftest import SF_SMALL

    from candlewick.sources import fixtures

    raw = fixtures.load_raw(spark, SF_SMALL)
    steps = INC.by_month(INC.plan_range([3600], "2024-01-30T00:00:00Z", "2024-02-02T00:00:00Z", refresh_dataset=False))
    assert [(s.layer, s.interval, s.start.day, s.end.day) for s in steps] == [(a, i, d, e) for a, i in (("sample", 60), ("sample", 3600), ("feature", 3600), ("label", 3600)) for d, e in ((30, 1), (1, 2))]
    store = SNK.Store(shared_path(spark, "test_resume", unique=True))
    frame, calls = INC.layer_frame, []

    def third_fails(spark, store, raw, step, seed=True):
        calls.append(step)
        if len(calls) == 3:
            raise RuntimeError("killed")
        return frame(spark, store, raw, step, seed)

    monkeypatch.setattr(INC, "layer_frame", third_fails)
    with pytest.raises(RuntimeError, match="killed"):
        INC.backfill(spark, store, raw, [3600], "2024-01-30T00:00:00Z", "2024-02-02T00:00:00Z", refresh_dataset=False, job="january")
    INC.backfill(spark, store, raw, [3600], "2024-01-30T00:00:00Z", "2024-02-02T00:00:00Z", refresh_dataset=False, job="january")
    assert calls == steps[:3] + steps[2:]  # finished steps are not written again
    INC.backfill(spark, store, raw, [3600], "2024-01-30T00:00:00Z", "2024-02-02T00:00:00Z", refresh_dataset=False, job="january")
    assert len(calls) == 1 + len(steps)
    other = SNK.Store(shared_path(spark, "test_whole", unique=True))
    monkeypatch.setattr(INC, "layer_frame", frame)
    INC.backfill(spark, other, raw, [3600], "2024-01-30T00:00:00Z", "2024-02-02T00:00:00Z", refresh_dataset=False)
    for name in INC.LAYERS.values():
        a, b = SNK.read_layer(spark, store, name).drop("bid_px"), SNK.read_layer(spark, other, name).drop("bid_px")
        assert a.count() == b.count() > 0 and a.exceptAll(b).isEmpty()


def test_ledger_folds_its_events(spark, monkeypatch):
    monkeypatch.setattr(LED, "FOLD_EVERY", 6)
    store = SNK.Store(shared_path(spark, "test_fold", unique=True))
    ids = [LED.run_layer_job(spark, store, "sample", "bars_time", 60, lambda run_id, k=k: k)[0] for k in range(4)]
    files = SNK.log_of(spark, store, LED.LEDGER).files()
    assert files.count() == 3 and files.agg(F.sum("n_rows")).first()[0] == 5  # folded after three runs, one run since
    state = LED.run_state(SNK.read_layer(spark, store, LED.LEDGER))
    assert {(r.run_id, r.status, r.row_count) for r in state.collect()} == {(i, "done", k) for k, i in enumerate(ids)}
    assert len(SNK.read_layer(spark, store, LED.LEDGER, key=ids[3]).inputFiles()) <= 2


def test_no_machine_local_folder_on_a_cluster():
    assert one_machine("local") and one_machine("local[8]")
    assert not one_machine("spark://host:7077") and not one_machine("yarn") and not one_machine("local-cluster[2,1,1024]")


def test_ledger_failed_run_reraises_and_stale_repair(spark):
    store = SNK.Store(shared_path(spark, "test_ledger", unique=True))

    def boom(run_id):
        raise RuntimeError("statement failed")

    with pytest.raises(RuntimeError):
        LED.run_layer_job(spark, store, "sample", "bars_time", 60, boom)
    LED.run_layer_job(spark, store, "feature", "features_time_bar", 60, lambda rid: 7)
    LED.record_start(spark, store, "label", "labels_time_bar", 60, now="2026-01-01T00:00:00Z")
    state = LED.run_state(SNK.read_layer(spark, store, LED.LEDGER))
    status = {r["layer"]: (r["status"], r["row_count"]) for r in state.collect()}
    assert status == {"sample": ("failed", 0), "feature": ("done", 7), "label": ("running", 0)}
    stale = LED.stale_runs(state, now="2026-01-01T01:00:00Z").collect()
    assert len(stale) == 1 and stale[0]["stale_run_count"] == 1 and stale[0]["layer"] == "label"
    assert LED.repair_stale_runs(spark, store, now="2026-01-01T01:00:00Z") == 1
    again = LED.run_state(SNK.read_layer(spark, store, LED.LEDGER))
    fixed = {r["layer"]: r["status"] for r in again.collect()}
    assert fixed == {"sample": "failed", "feature": "done", "label": "failed"}
    assert LED.repair_stale_runs(spark, store, now="2026-01-01T01:00:00Z") == 0


def test_store_roundtrip_versions_and_export(spark, tmp_path):
    from helpers import bars_from_closes

    store = SNK.Store(shared_path(spark, "test_store", unique=True))
    created = SNK.bootstrap(spark, store)
    assert "sample.bars_time" in created and SNK.bootstrap(spark, store) == []
    b1 = bars_from_closes(spark, [1.0] * 4)
    b2 = bars_from_closes(spark, [2.0] * 4)
    assert SNK.write_layer(b1, store, "sample.bars_time", version=1) == 4
    SNK.write_layer(b2, store, "sample.bars_time", version=2)
    latest = SNK.read_layer(spark, store, "sample.bars_time")
    assert latest.count() == 4 and latest.filter("close = 2.0").count() == 4
    SNK.compact_layer(spark, store, "sample.bars_time")
    assert SNK.read_layer(spark, store, "sample.bars_time", latest=False).count() == 4


def test_export_writes_a_header_and_only_ready_valid_rows(spark, tmp_path):
    from candlewick.operators import dataset as DS

    names = DS.preset_columns("all")
    rows = [tuple({"training_ready": r, "label_is_valid": v}.get(c, k) for c in names) for k, (r, v) in enumerate([(1, 1), (1, 0), (0, 1), (1, 1)])]
    ds = spark.createDataFrame(rows, ", ".join(f"{c} int" for c in names))
    for frame, count in ((ds, 2), (ds.limit(0), 0)):
        out = str(tmp_path / f"csv{count}")
        SNK.export_csv(frame, out)
        read = spark.read.option("header", True).csv(out)
        assert read.columns == DS.preset_columns("train") and read.count() == count
    with pytest.raises(ValueError, match="preset"):
        DS.preset_columns("some")


def test_streamed_closed_bars_equal_batch(spark):
    from pyspark.sql import functions as F

    from candlewick.operators.bars import trade_bars
    from candlewick.sources import fixtures
    from candlewick.streaming import bars as STR

    from conftest import SF_SMALL

    streamed = STR.stream_bars_to(spark, SF_SMALL, shared_path(spark, "test_stream"), 300)
    batch = trade_bars(fixtures.load_raw(spark, SF_SMALL)["trades"], 300)
    last = batch.agg(F.max("last_trade_ts")).first()[0]
    assert streamed.count() > 0
    # every streamed bar is closed and equal to the batch bar (up to summation order)
    joined = streamed.alias("s").join(batch.alias("b"), ["exchange", "symbol", "bar_time"])
    assert joined.count() == streamed.count()
    bad = joined.filter(
        (F.col("s.trade_count") != F.col("b.trade_count"))
        | (F.abs(F.col("s.volume") - F.col("b.volume")) > 1e-9)
        | (F.col("s.open") != F.col("b.open"))
        | (F.col("s.close") != F.col("b.close"))
        | (F.col("s.max_trade_gap_ms") != F.col("b.max_trade_gap_ms"))
    )
    assert bad.count() == 0
    assert streamed.filter(F.col("bar_time") > F.lit(last)).count() == 0


def test_retention_drops_old_day_partitions(spark):
    from conftest import SF_SMALL

    from candlewick.sources import fixtures

    store = SNK.Store(shared_path(spark, "test_retention", unique=True))
    raw = fixtures.load_raw(spark, SF_SMALL)
    SNK.write_layer(raw["book"], store, "raw.book_topk_raw")
    before = SNK.read_layer(spark, store, "raw.book_topk_raw")
    days = sorted(r[0] for r in before.select(F.to_date("timestamp")).distinct().collect())
    now = f"{days[-1].isoformat()}T12:00:00Z"
    dropped = SNK.drop_expired_partitions(spark, store, now=now, days=10)
    kept = SNK.read_layer(spark, store, "raw.book_topk_raw")
    # frames read before the drop are stale; compare against the source rows
    expect = SNK.retention_filter(raw["book"], now=now.replace("T", " ").replace("Z", ""), days=10)
    assert dropped and kept.count() > 0
    # partition drop keeps whole days: every row the row-level filter keeps is still there
    assert expect.exceptAll(kept).count() == 0


def test_late_repair_ends_at_the_next_trade(spark):
    """A late row writes no bar behind its symbol's next trade, and all layers equal a batch run."""
    from candlewick.operators import bars as B
    from candlewick.operators.features import time_bar_features
    from candlewick.operators.labels import time_bar_labels
    from candlewick.operators.rollup import rollup_bars
    from candlewick.streaming import bars as STR
    from helpers import raw_with_trades, trades

    early = [("2026-03-02T00:00:10", "A", "buy", 100, 1, "1"), ("2026-03-02T00:05:20", "A", "sell", 105, 2, "2"), ("2026-03-16T00:04:00", "A", "buy", 110, 1, "3")]
    early += [("2026-03-02T00:01:00", "B", "buy", 50, 1, "4"), ("2026-03-16T00:02:00", "B", "buy", 51, 1, "5")]
    late = [("2026-03-02T00:02:30", "A", "buy", 101, 3, "6"), ("2026-03-16T00:03:00", "B", "sell", 52, 1, "7")]
    store = SNK.Store(shared_path(spark, "test_repair", unique=True))
    span = "2026-03-02T00:00:00Z", "2026-03-16T00:05:00Z"

    def layers(rows):
        grid = B.time_bars(raw_with_trades(spark, trades(spark, rows)), 60, *span)
        hours = rollup_bars(grid, 3600).cache()
        return {("sample", 60): grid, ("sample", 3600): hours, ("feature", 3600): time_bar_features(hours, 3600), ("label", 3600): time_bar_labels(hours, 3600)}

    for (layer, _), frame in layers(early).items():
        SNK.write_layer(frame, store, STR.LAYERS[layer])
    SNK.land_raw(raw_with_trades(spark, trades(spark, early + late)), store)
    STR.repair_touched(spark, store, trades(spark, late), intervals=[3600])
    bars = SNK.read_layer(spark, store, "sample.bars_time", latest=False, interval_sec=60)
    newer = bars.groupBy("symbol", "bar_time").count().where("count > 1").orderBy("symbol", "bar_time").collect()
    # A: from its day's start to the trade at 00:05; B: its last day, as no trade follows
    assert [(r.symbol, r.bar_time.day, r.bar_time.minute) for r in newer] == [("A", 2, m) for m in range(5)] + [("B", 16, m) for m in range(5)]
    for (layer, interval), expected in layers(early + late).items():
        got = SNK.read_layer(spark, store, STR.LAYERS[layer], interval_sec=interval)
        columns = [F.round(c, 7).alias(c) if t == "double" else F.col(c) for c, t in expected.dtypes if c not in ("_version", "_run_id")]
        a, b = got.select(*columns).cache(), expected.select(*columns).cache()
        assert a.count() == b.count() and a.exceptAll(b).isEmpty()
