"""Run ledger (RUN-1..3): append-only run events, current state per run.

Every layer job appends a *start* event, then a *finish* event (done or
failed) carrying the real row count observed while writing.  Repairs append
*correction* events.  Nothing is updated in place: the state of a run is its
newest event (``max_by`` over (event_ts, event_seq)), so concurrent writers and
retried tasks never lose updates.

A finish reads only the files whose run-id range holds its run (from the commit log).
After every ``FOLD_EVERY`` commits the events are folded into the newest one of each run,
so that reading the whole state means one file and a bounded tail.
"""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick import schemas
from candlewick.functions.exprs import parse_utc
from candlewick.plans.commits import CommitConflict
from candlewick.plans.sinks import Store, _put_files, _read_files, log_of, read_layer, write_layer

LEDGER = "meta.pipeline_runs"
# Fixed value: a running record older than this many minutes is stale.
STALE_MINUTES = 30
FOLD_EVERY = 50

_seq = iter(range(1, 1 << 62))


def _now() -> datetime:
    return datetime.now(timezone.utc)


def _event(spark: SparkSession, **fields) -> DataFrame:
    row = {f.name: fields.get(f.name) for f in schemas.PIPELINE_RUN_EVENTS.fields}
    row["symbols"] = row["symbols"] or []
    row["git_commit"] = row["git_commit"] or ""
    row["config_json"] = row["config_json"] or "{}"
    row["row_count"] = row["row_count"] or 0
    row["event_seq"] = next(_seq)
    return spark.createDataFrame([row], schemas.PIPELINE_RUN_EVENTS)


def _naive(value) -> datetime | None:
    if value is None:
        return None
    return parse_utc(value)


def record_start(spark, store: Store, layer: str, table: str, interval_sec: int, start=None, end=None, symbols=None, config=None, now=None) -> str:
    run_id = str(uuid.uuid4())
    ts = _naive(now) if now else _now()
    write_layer(
        _event(
            spark,
            run_id=run_id,
            layer=layer,
            table_name=table,
            bar_interval_sec=int(interval_sec or 0),
            symbols=list(symbols or []),
            time_range_start=_naive(start),
            time_range_end=_naive(end),
            status="running",
            config_json=json.dumps(config or {}),
            started_at=ts,
            event_ts=ts,
        ),
        store,
        LEDGER,
    )
    return run_id


def record_finish(spark, store: Store, run_id: str, row_count: int, status: str = "done", now=None) -> None:
    state = run_state(read_layer(spark, store, LEDGER, key=run_id))
    ts = _naive(now) if now else _now()
    # finish event = previous state with the new status (one tiny row)
    ev = state.select(
        *[
            (F.lit(status) if c == "status" else F.lit(int(row_count)).cast("long") if c == "row_count" else F.lit(ts).cast("timestamp") if c in ("finished_at", "event_ts") else F.col(c)).alias(c)
            for c in [f.name for f in schemas.PIPELINE_RUN_EVENTS.fields if f.name != "event_seq"]
        ],
        F.lit(next(_seq)).cast("long").alias("event_seq"),
    )
    write_layer(ev, store, LEDGER)
    if log_of(spark, store, LEDGER).newest() % FOLD_EVERY < 2:  # its own commit, or the start of another run behind it
        fold_ledger(spark, store)


def fold_ledger(spark, store: Store) -> int:
    """Replace the event files by one with the newest event of each run; returns how many files were replaced."""
    log = log_of(spark, store, LEDGER)
    seen = log.newest()
    old = [r[0] for r in log.files().where(F.col("seq") <= seen).select("path").collect()]  # a bounded tail
    if len(old) < 2:
        return 0
    names = [f.name for f in schemas.PIPELINE_RUN_EVENTS.fields]
    events = _read_files(spark, store, LEDGER, sorted(old)).select(*names)
    ident, added = _put_files(run_state(events).select(*names).coalesce(1), store, LEDGER, rewrite=True)
    try:
        log.commit([{**e, "commit": ident} for e in added], removed=old, seen=seen)
    except CommitConflict:  # another run has folded them
        return 0
    return len(old)


def run_layer_job(spark, store: Store, layer: str, table: str, interval_sec, frame_fn, start=None, end=None, symbols=None, config=None):
    """Ledger wrapper: start event → compute + write → finish event (failed re-raises)."""
    run_id = record_start(spark, store, layer, table, interval_sec, start, end, symbols, config)
    try:
        rows = frame_fn(run_id)
    except Exception:
        record_finish(spark, store, run_id, 0, "failed")
        raise
    record_finish(spark, store, run_id, rows, "done")
    return run_id, rows


def run_state(events: DataFrame) -> DataFrame:
    """RUN-1: newest event per run_id."""
    cols = [c for c in events.columns if c != "run_id"]
    picked = events.groupBy("run_id").agg(F.max_by(F.struct(*cols), F.struct("event_ts", "event_seq")).alias("_s"))
    return picked.select("run_id", *[F.col(f"_s.{c}").alias(c) for c in cols])


def _stale(state: DataFrame, max_age_minutes: int, layer: str | None, now) -> DataFrame:
    ref = F.lit(_naive(now)).cast("timestamp") if now else F.current_timestamp()
    cond = (F.col("status") == "running") & (F.col("started_at") < ref - F.expr(f"INTERVAL {int(max_age_minutes)} MINUTES"))
    if layer:
        cond = cond & (F.col("layer") == layer)
    return state.filter(cond)


def stale_runs(state: DataFrame, max_age_minutes: int = STALE_MINUTES, layer: str | None = None, now=None) -> DataFrame:
    """RUN-2: stale running runs per (layer, table, interval): count and oldest start."""
    return (
        _stale(state, max_age_minutes, layer, now)
        .groupBy("layer", "table_name", "bar_interval_sec")
        .agg(F.count(F.lit(1)).alias("stale_run_count"), F.min("started_at").alias("oldest_started_at"))
        .orderBy("layer", "table_name", "bar_interval_sec")
    )


def repair_events(state: DataFrame, max_age_minutes: int = STALE_MINUTES, layer: str | None = None, now=None) -> DataFrame:
    """RUN-3: correction events marking stale runs failed (append them to the ledger)."""
    ts = F.lit(_naive(now)).cast("timestamp") if now else F.current_timestamp()
    stale = _stale(state, max_age_minutes, layer, now)
    return stale.select(
        *[
            (F.lit("failed") if c == "status" else ts if c in ("finished_at", "event_ts") else F.col(c)).alias(c)
            for c in [f.name for f in schemas.PIPELINE_RUN_EVENTS.fields if f.name != "event_seq"]
        ],
        (F.col("event_seq") + 1).alias("event_seq"),
    )


def repair_stale_runs(spark, store: Store, max_age_minutes: int = STALE_MINUTES, layer: str | None = None, now=None) -> int:
    """RUN-3 on a store: append the correction events; returns how many runs were stale."""
    state = run_state(read_layer(spark, store, LEDGER))
    return write_layer(repair_events(state, max_age_minutes, layer, now), store, LEDGER)


def repaired_state(state: DataFrame, max_age_minutes: int = STALE_MINUTES, layer: str | None = None, now=None) -> DataFrame:
    """Ledger state after applying the repair events."""
    events = state.select(*[f.name for f in schemas.PIPELINE_RUN_EVENTS.fields])
    return run_state(events.unionByName(repair_events(state, max_age_minutes, layer, now)))
