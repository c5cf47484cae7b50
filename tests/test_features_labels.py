import math
from datetime import timedelta

from pyspark.sql import functions as F

from candlewick import schemas
from candlewick.operators import dataset as DS
from candlewick.operators.features import lookback_start, time_bar_features
from candlewick.operators.labels import label_read_range, time_bar_labels
from candlewick.operators.windows import halo_chunks

from helpers import bars_from_closes, collect_sorted, ts


def _closes(n, seed=7):
    out, x = [], 100.0
    for i in range(n):
        x *= 1 + (((i * seed) % 11) - 5) / 1000.0
        out.append(round(x, 4))
    return out


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_features_strictly_past(spark):
    closes = _closes(150)
    base = time_bar_features(bars_from_closes(spark, closes), 60, chunk_rows=None)
    altered = closes[:100] + [c * 3 for c in closes[100:]]
    changed = time_bar_features(bars_from_closes(spark, altered), 60, chunk_rows=None)
    cutoff = ts("2026-03-02T00:00:00") + timedelta(minutes=99)
    keep = F.col("bar_time") <= F.lit(cutoff)
    assert _same(base.filter(keep), changed.filter(keep))


def test_labels_strictly_future(spark):
    closes = _closes(200)
    base = time_bar_labels(bars_from_closes(spark, closes), 60, chunk_rows=None)
    altered = [c * 2 for c in closes[:20]] + closes[20:]
    changed = time_bar_labels(bars_from_closes(spark, altered), 60, chunk_rows=None)
    # labels at t use bars t-60 .. t+60 only
    cutoff = ts("2026-03-02T00:00:00") + timedelta(minutes=20 + 60)
    keep = F.col("bar_time") >= F.lit(cutoff)
    assert _same(base.filter(keep), changed.filter(keep))


def test_constant_close_has_no_errors_and_null_autocorr(spark):
    f = time_bar_features(bars_from_closes(spark, [50.0] * 80, volume=10.0, turnover=500.0), 60, chunk_rows=None)
    rows = collect_sorted(f, "bar_time")
    last = rows[-1]
    assert last["realized_vol_20"] == 0.0 and last["volume_zscore_20"] == 0.0
    assert last["autocorrelation_5"] is None and last["autocorrelation_20"] is None
    assert rows[0]["log_return"] is None and rows[0]["realized_vol_5"] is None
    assert rows[2]["realized_vol_5"] is None and rows[3]["realized_vol_5"] == 0.0  # needs 2 returns
    assert all(not (isinstance(v, float) and math.isnan(v)) for r in rows for v in r.values())


def test_halo_equals_global_features_and_labels(spark):
    closes = _closes(700)
    bars = bars_from_closes(spark, closes).unionByName(bars_from_closes(spark, _closes(650, seed=3), symbol="T"))
    # make the series sparse: drop some bars so time slices and row chunks differ
    bars = bars.filter((F.minute("bar_time") % 7) != 3)
    for fn in (time_bar_features, time_bar_labels):
        g = fn(bars, 60, chunk_rows=None)
        h = fn(bars, 60, chunk_rows=130)
        assert _same(g, h), fn.__name__


def test_halo_copies_only_the_halo(spark):
    bars = bars_from_closes(spark, _closes(500))
    expanded, layout = halo_chunks(bars, schemas.SERIES_KEYS, chunk_rows=200, back=61, fwd=60)
    assert expanded.filter("_own").count() == 500
    # chunk 0 lends 61 rows forward, chunk 1 lends 61 forward and 60 back, chunk 2 lends 60 back
    assert expanded.filter(~F.col("_own")).count() == 61 + 61 + 60 + 60


def test_label_validity_boundary_and_barrier_tie(spark):
    closes = [100.0] * 130
    bars = bars_from_closes(spark, closes)
    lab = collect_sorted(time_bar_labels(bars, 60, chunk_rows=None), "bar_time")
    valid = [r["is_valid"] for r in lab]
    assert valid[:70] == [1] * 70 and valid[70:] == [0] * 60  # exactly 60 following bars needed
    # flat prices: threshold 0, both barriers hit on the first bar → tie resolves to +1
    assert lab[0]["triple_barrier_signal"] == 1
    assert lab[-1]["fwd_max_up_5"] == 0.0 and lab[-1]["fwd_max_down_5"] == 0.0


def test_lookback_and_lookforward_ranges():
    assert lookback_start("2026-03-02T00:00:00Z", 60).isoformat() == "2026-03-01T22:59:00+00:00"
    lo, hi = label_read_range("2026-03-02T00:00:00Z", "2026-03-02T01:00:00Z", 60)
    assert hi.isoformat() == "2026-03-02T02:00:00+00:00" and lo.isoformat() == "2026-03-01T23:00:00+00:00"


def test_range_run_equals_full_run(spark):
    bars = bars_from_closes(spark, _closes(400))
    s, e = "2026-03-02T02:00:00Z", "2026-03-02T04:00:00Z"
    from candlewick.functions.exprs import time_range

    for fn in (time_bar_features, time_bar_labels):
        full = fn(bars, 60).filter(time_range("bar_time", s, e))
        part = fn(bars, 60, s, e)
        assert _same(full, part), fn.__name__


def test_presets_and_fused_equals_join(spark):
    assert len(DS.preset_columns("train")) == 4 + 4 + 36 + 19
    assert len(DS.preset_columns("all")) == 4 + 4 + 36 + 19 + 8
    try:
        DS.preset_columns("bogus")
        raise AssertionError("expected ValueError")
    except ValueError:
        pass
    bars = bars_from_closes(spark, _closes(300))
    joined = DS.dataset(time_bar_features(bars, 60), time_bar_labels(bars, 60), bars)
    fused = DS.dataset_fused(bars, 60, chunk_rows=128)
    assert _same(joined, fused)
    sel = DS.dataset_select(joined, training_ready_only=True, label_valid_only=True, column_set="train")
    assert sel.columns == DS.TRAIN_COLUMNS
    assert joined.filter("label_is_valid = 0").count() == 60  # invalid labels stay in the view


def test_autocorrelation_is_stable(spark):
    growth = [100.0 * 1.25**k for k in range(40)]  # equal returns: no variance beyond rounding
    rows = collect_sorted(time_bar_features(bars_from_closes(spark, growth), 60, chunk_rows=None), "bar_time")
    assert all(r["autocorrelation_5"] is None and r["autocorrelation_20"] is None for r in rows)
    tiny, x = [], 100.0
    for k in range(60):  # returns of size 1e-9 that alternate
        x *= 1 + (1e-9 if k % 2 else -1e-9) * (1 + k % 3)
        tiny.append(x)
    rows = collect_sorted(time_bar_features(bars_from_closes(spark, tiny), 60, chunk_rows=None), "bar_time")
    assert rows[-1]["autocorrelation_20"] is not None and rows[-1]["autocorrelation_20"] < -0.5
